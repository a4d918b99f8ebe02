"""Quality rules: robust multivariate outliers per language and source.

Each text that passes the base rules gives a vector of transformed statistics. For every
(language, source), language, and all documents together, the minimum covariance
determinant estimate is found by concentration steps over all rows: from medians and
median deviations, the part ``CORE`` of the rows with the smallest Mahalanobis distances
gives the next mean and covariance. The covariance is then scaled so that the median
distance is that of normal data. A document is judged by the finest of its groups that
has ``LEAST`` rows, and is rejected beyond ``CUT``.

Every step is a grouped aggregate with map-side partial sums, so hot groups are never
gathered; matrices are inverted one small row per group. ``FLOOR`` keeps statistics
that hardly vary in a group from rejecting small deviations.

Null texts are empty (and fail the base rules); null language or source is a value of its
own; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.store import ship, stored, stored_with
from featurepipe.llm.words import SPACE, U, chunks, mix, word_hashes

LEAST = 60
CORE = 0.75
STEPS = 4
SENT = 10_000  # groups whose estimates are broadcast (8 MB); more are joined by a shuffle
CUT = 9.0  # Mahalanobis distance, in standard deviations of one dimension
STATS = ("size", "word_length", "symbols", "dup_lines", "repeats", "capitals", "marks", "distinct")
FLOOR = (0.30, 0.06, 0.05, 0.25, 0.25, 0.05, 0.05, 0.06)  # least standard deviation of each
D = len(STATS)
CHI_MEDIAN = D * (1 - 2 / (9 * D)) ** 3  # median of the chi-squared distribution (Wilson-Hilferty)

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
MARK = np.zeros(256, bool)
MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
SPACES = " \t\n\r\x0b\x0c"
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _repeats(h: np.ndarray, doc: np.ndarray, n_doc: int) -> np.ndarray:
    """Words per text that lie in a three-word window found more than once in it."""
    if len(h) < 3:
        return np.zeros(n_doc, np.int64)
    w = mix(mix(mix(h[:-2]) ^ h[1:-1]) ^ h[2:])
    at = np.flatnonzero(doc[:-2] == doc[2:])
    w, of = w[at], doc[at]
    order = np.lexsort((w, of))
    same = (w[order][1:] == w[order][:-1]) & (of[order][1:] == of[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(h), bool)
    for i in range(3):
        covered[at[twice] + i] = True
    return np.bincount(doc[covered], minlength=n_doc)


def _dup_lines(raw: bytes) -> int:
    if b"\n" not in raw:
        return 0
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def statistics(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, base counts, vectors) per piece of the array."""
    for i, j, data, off in chunks(text):
        n = j - i
        h, doc = word_hashes(data, off, lower=False)
        words = np.bincount(doc, minlength=n)

        def per_doc(mask):
            return np.diff(np.concatenate(([0], np.cumsum(mask)))[off])

        chars = per_doc(~SPACE[data] & ((data & 0xC0) != 0x80))
        symbols = per_doc(SYMBOL[data])
        high = np.zeros(len(data), bool)  # Latin-1 capitals: 0xC3 0x80-0x9E
        high[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        capitals, marks = per_doc(CAPITAL[data] | high), per_doc(MARK[data])
        raw = data.tobytes()
        dups = np.array([_dup_lines(raw[a:b]) for a, b in zip(off[:-1], off[1:])], np.int64)
        lines = per_doc(data == 10) + 1
        repeats = _repeats(h, doc, n)
        order = np.lexsort((h, doc))
        first = np.ones(len(h), bool)
        first[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        kinds = np.bincount(doc[order][first], minlength=n)
        w, c = np.maximum(words, 1), np.maximum(chars, 1)
        x = np.column_stack([
            np.log1p(words), np.log(c / w), np.log1p(20 * symbols / c), np.log1p(4 * dups / np.maximum(lines, 1)), np.log1p(4 * repeats / w),
            np.log1p(4 * capitals / c), np.log1p(8 * marks / c), np.log((kinds + 1) / np.sqrt(w + 1.0))])
        yield i, np.column_stack([words, chars, symbols, dups, repeats]), x


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, base, x in statistics(b.column("text")):
            n = len(base)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, D * n + 1, D, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(c).slice(i, n) for c in ("doc_id", "lang", "source")] + [pa.array(base[:, k]) for k in range(5)] + [lists],
                                             ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "x"])


def _invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group: sums to mean and inverse covariance."""
    floor = np.diag(np.square(FLOOR))
    for b in batches:
        out = []
        for g, n, s, q in zip(*(b.column(c).to_pylist() for c in ("g", "n", "s", "q"))):
            mean = np.array(s) / n
            cov = np.zeros((D, D))
            cov[np.triu_indices(D)] = np.array(q) / n
            cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
            out.append((g, mean.tolist(), np.linalg.inv(cov + floor).ravel().tolist()))
        g, m, p = zip(*out) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(m, pa.list_(pa.float64())), pa.array(p, pa.list_(pa.float64()))], ["g", "mean", "prec"])


def _distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, m = (b.column(c).values.to_numpy(zero_copy_only=False).reshape(-1, D) for c in ("x", "mean"))
        p = b.column("prec").values.to_numpy(zero_copy_only=False).reshape(-1, D, D)
        d = x - m
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("g"), b.column("x"), pa.array(np.einsum("ni,nij,nj->n", d, p, d))], ["row", "g", "x", "d2"])


def _sums(rows: DataFrame) -> DataFrame:
    """(g, n, s, q): counts, sums and sums of products of the vectors."""
    x = [F.get("x", F.lit(i)) for i in range(D)]
    return rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
                                 F.array(*[F.sum(x[i] * x[j]) for i in range(D) for j in range(i, D)]).alias("q"))


def _per_group(df: DataFrame, name: str) -> DataFrame:
    """A stored table of one small row per group, to be broadcast while there are at most ``SENT`` groups."""
    df, seen = stored_with(df, name)
    return F.broadcast(df) if seen["n"] <= SENT else df


def robust_groups(vectors: DataFrame) -> DataFrame:
    """``vectors`` (row, g, x) with ``d2``: squared robust distance within each group g, scaled to normal data."""
    x = [F.get("x", F.lit(i)) for i in range(D)]
    mid = _per_group(vectors.groupBy("g").agg(F.array(*[F.percentile_approx(v, 0.5, 1000) for v in x]).alias("mean")), "medians")
    dev = vectors.join(mid, "g").groupBy("g").agg(F.first("mean").alias("mean"), F.array(*[F.percentile_approx(F.abs(v - F.get("mean", F.lit(i))), 0.5, 1000) for i, v in enumerate(x)]).alias("dev"))
    scale = [F.greatest(F.lit(FLOOR[i]), F.get("dev", F.lit(i)) * 1.4826) for i in range(D)]
    zero = F.lit(0.0)
    fit = _per_group(dev.select("g", "mean", F.array(*[1 / (scale[i] * scale[i]) if i == j else zero for i in range(D) for j in range(D)]).alias("prec")), "start")
    cols = "row bigint, g string, x array<double>, d2 double"
    for _ in range(STEPS):
        d = vectors.join(fit, "g").select("row", "g", "x", "mean", "prec").mapInArrow(_distance, cols)
        d = stored(d, "distances")
        cut = _per_group(d.groupBy("g").agg(F.percentile_approx("d2", CORE, 1000).alias("cut")), "cuts")
        core = d.join(cut, "g").filter("d2 <= cut")
        fit = _per_group(_sums(core).mapInArrow(_invert, "g string, mean array<double>, prec array<double>"), "fit")
    d = stored(vectors.join(fit, "g").select("row", "g", "x", "mean", "prec").mapInArrow(_distance, cols), "distances")
    mid = _per_group(d.groupBy("g").agg(F.percentile_approx("d2", 0.5, 1000).alias("median"), F.count(F.lit(1)).alias("size")), "medians")
    return d.join(mid, "g").select("row", "g", "size", (F.col("d2") * F.least(F.lit(1.0), F.lit(CHI_MEDIAN) / F.greatest("median", F.lit(1e-9)))).alias("d2"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(doc_id, base counts, base_failed, distance, kept): one row per row of ``docs``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    rows = stored(rows.mapInArrow(_rows, f"doc_id bigint, lang string, source string, {BASE}, x array<double>")
                  .withColumn("row", F.monotonically_increasing_id())
                  .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), "statistics")
    name = F.to_json(F.struct("lang", "source"))
    groups = F.array(F.concat(F.lit("0"), name), F.concat(F.lit("1"), F.to_json(F.struct("lang"))), F.lit("2"))
    vectors = stored(rows.filter("NOT base_failed").select("row", F.explode(groups).alias("g"), "x"), "vectors")
    d = robust_groups(vectors)
    # the finest group of sufficient size; the whole table if none has it
    best = d.groupBy("row").agg(F.min(F.when((F.col("size") >= LEAST) | (F.col("g") == "2"), F.struct("g", "d2"))).alias("best"))
    out = rows.drop("x").join(best, "row", "left").withColumn("distance", F.sqrt("best.d2"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= CUT)).drop("row", "best", "lang", "source")
