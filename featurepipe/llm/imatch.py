"""I-Match fingerprints over randomised lexicon subsets.

The lexicon is every term whose document frequency lies within a band (shares of all
documents; counted over all of them). Its size has a proven bound, the mean number of
distinct terms per document divided by the lower share, so it is broadcast as hashes.
Each of ``SUBSETS`` random parts of it gives one hash: the document's distinct terms in
that part, sorted, hashed. A document without lexicon terms is hashed over all its
distinct terms, one without words over nothing. Likeness of two fingerprints: the share
of equal hashes among the parts in which either has a term; 1 for equal fingerprints.

Every document is also compared with its edited self and its neighbour: ids
descending are cut into ranges at quantiles, each range gets its successor (the first
row of the range below) as one extra row, and tasks stream their sorted range.

Terms are words (no space, 0x09-0x0D) with A-Z lower-cased. Null texts are empty. A null
id comes last in descending order; equal ids are ordered by a hash of their text; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.store import ship, stored
from featurepipe.llm.words import U, chunks, distinct, mix, word_hashes

LOW, HIGH = 0.002, 0.2  # the band, as shares of the documents
SUBSETS = 48
RATE = 1 / 48  # of the lexicon in each part
EMPTY = "-" * 8
RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _terms(text: pa.Array):
    for i, j, data, off in chunks(text):
        h, doc = word_hashes(data, off)
        yield i, *distinct(h, doc, j - i)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, v, _ in _terms(b.column(0)):
            term, n = np.unique(v, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)), pa.array(n)], ["term", "n"])


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms whose document frequency is within the band (at least 2 documents)."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    n = texts.count()
    df = texts.mapInArrow(_frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    band = df.filter((F.col("n") >= max(2.0, low * n)) & (F.col("n") <= max(2.0, high * n))).select("term")
    return np.sort(np.array([r.term for r in band.collect()], np.int64).view(U))


SEEDS = mix(np.arange(SUBSETS, dtype=U) + U(1 << 33))


def _hash(terms: np.ndarray) -> str:
    return hashlib.blake2b(terms.tobytes(), digest_size=4).hexdigest()


def fingerprints(text: pa.Array, lex: np.ndarray) -> list[str]:
    """One string per text: ``SUBSETS`` hashes, or a single one for a text without lexicon terms."""
    out = []
    for _, v, off in _terms(text):
        known = lex[np.minimum(np.searchsorted(lex, v), len(lex) - 1)] == v if len(lex) else np.zeros(len(v), bool)
        part = [(mix(v ^ s) < U(int(RATE * 2**64))) & known for s in SEEDS]
        first = np.array([np.searchsorted(np.flatnonzero(p), off) for p in part])
        picked = [v[p] for p in part]
        any_known = np.add.reduceat(np.append(known, False), np.minimum(off[:-1], len(known))) if len(v) else np.zeros(len(off) - 1, int)
        for d, (a, b) in enumerate(zip(off[:-1], off[1:])):
            if a == b or not any_known[d]:
                out.append(_hash(v[a:b]))
            else:
                out.append("".join(_hash(p[f[d] : f[d + 1]]) if f[d] < f[d + 1] else EMPTY for p, f in zip(picked, first)))
    return out


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if len(a) != len(b):
        return 0.0
    pairs = [(a[i : i + 8], b[i : i + 8]) for i in range(0, len(a), 8)]
    used = [(x, y) for x, y in pairs if (x, y) != (EMPTY, EMPTY)]
    return sum(x == y for x, y in used) / len(used) if used else 0.0


def _compare(lex):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row met: (id, text, is context, range)
        names = [f.split()[0] for f in RESULT.split(", ")]

        def done(pairs):
            texts = [t for _, t, _ in pairs]
            edited = [t[: len(t) - len(t) // 3] + n[: len(t) // 3] for _, t, n in pairs]
            own, other = fingerprints(pa.array(texts, pa.large_string()), lex.value), fingerprints(pa.array(edited, pa.large_string()), lex.value)
            after = fingerprints(pa.array([pairs[-1][2]], pa.large_string()), lex.value)
            near = [likeness(a, b) for a, b in zip(own, [*own[1:], *after])]
            cols = [[i for i, _, _ in pairs], [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited], own, other, [likeness(a, b) for a, b in zip(own, other)], near]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for b in batches:
            for s in range(0, len(b), 500):
                pairs = []
                part = b.slice(s, 500)
                for i, t, c, r in zip(*(part.column(k).to_pylist() for k in ("id", "text", "context", "range"))):
                    if held is not None and held[3] != r:
                        held = None  # rows of another range; a range ends with its context row
                    if held is not None:
                        pairs.append((held[0], held[1], t))
                    held = None if c else (i, t, c, r)
                    if c and pairs:
                        yield done(pairs)  # neighbours inside one range only
                        pairs = []
                if pairs:
                    yield done(pairs)
    return rows


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Rows (range, id, text, context): each range descending by id, closed by its successor as a context row.

    The last document's successor is the first. Ranges are cut at approximate quantiles of
    the ids; a single id never spans two ranges.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cuts = sorted(set(rows.filter("id IS NOT NULL").approxQuantile("id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))))
    spot = F.lit(0)
    if cuts:
        spot = F.expr(f"aggregate(array({', '.join(str(int(c)) + 'L' for c in cuts)}), 0, (n, c) -> n + int(id > c))") if len(cuts) < 64 else None
    if spot is None:
        bounds = F.array(*[F.lit(int(c)).cast("bigint") for c in cuts])
        spot = F.size(F.filter(bounds, lambda c: F.col("id") > c))
    rows = rows.withColumn("range", F.coalesce(spot, F.lit(0)).cast("int"))
    order = F.struct(F.col("id"), F.xxhash64("text").alias("h"))
    heads = rows.groupBy("range").agg(F.max(order).alias("head"))
    heads = sorted(((r.range, r["head"].id, r["head"].h) for r in heads.collect()))  # one row per range
    if not heads:
        return rows.withColumn("context", F.lit(False))
    above = {h[0]: heads[(i + 1) % len(heads)][0] for i, h in enumerate(heads)}  # the range that a head closes
    closes = spark.createDataFrame([(r, i, h, above[r]) for r, i, h in heads], "range int, hid bigint, hh bigint, above int")
    context = rows.join(F.broadcast(closes), "range").filter(F.col("id").eqNullSafe(F.col("hid")) & (F.xxhash64("text") == F.col("hh")))
    context = context.dropDuplicates(["range"]).select(F.col("above").alias("range"), "id", "text", F.lit(True).alias("context"))
    both = rows.select("range", "id", "text", F.lit(False).alias("context")).unionByName(context)
    return both.repartition("range").sortWithinPartitions("range", "context", F.desc_nulls_last("id"), F.desc(F.xxhash64("text")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """See ``RESULT``: fingerprints of each text and its edited form, likeness to it and to the next document."""
    spark = docs.sparkSession
    lex = spark.sparkContext.broadcast(lexicon(docs, text_col, low, high))
    return with_neighbours(docs, id_col, text_col).mapInArrow(_compare(lex), RESULT)
