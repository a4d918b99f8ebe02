"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The model is fitted on a bounded sample of labelled rows (at most ``FIT_ROWS``, the
smallest hashes of id): words that toxic rows hold far more often than others form the
lexicon, with their log-odds as weights; a row's features are densities of lexicon words,
their nearness to second-person words, and rates of capitals, punctuation and
obfuscation (symbols or digits inside words). Rows apart from those of the trees
calibrate their scores. Every text is scored whole, in Spark, by the fitted trees.

Labels serve the fit only; id, language and source are never features. The lexicon is
learned on one part of the sample and the trees on the other, so that densities mean the
same when fitted and when scored.

Null and empty texts have features of 0 and a score; null or repeated ids and labels keep their
rows (a null id is never fitted, conflicting labels each count); without two classes of
labels every score is the share of label 1 (0 without labels); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.store import ship, stored

FIT_ROWS = 20_000
LEXICON = 5_000  # words at most
MET = 4  # toxic rows a lexicon word is met in at least
ODDS = math.log(12)
TREES, DEPTH = 20, 3
NEAR = 5  # words around a second-person word
HELD = 5  # remainders of crc32(id): 0 is never learned from

# fixed values: second-person words
SECOND_PERSON = frozenset("""
you your yours yourself yourselves u ur
tu te toi ton ta tes vous votre vos
du dich dir dein deine deiner euch euer ihr sie ihnen
tú ti usted ustedes tuyo tuya vosotros vuestro
""".split())
FEATURES = ["density", "weight", "most", "kinds", "hit", "second", "near", "capitals", "shouting", "marks", "repeated_marks", "obfuscated"]
EDGE = ".,!?;:\"'()[]{}«»„“”…-"
LETTER_INSIDE = re.compile(r"[^\W\d_][^\w\s'’.,-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
LOUD = re.compile(r"[!?]{2,}")
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")


def words_of(text: str) -> list[str]:
    return [w.strip(EDGE).lower() for w in text.split()]


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        w, y = [], []
        for t, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            own = {x for x in words_of(t or "") if x and len(x) <= 64}
            w.extend(own)
            y.extend([label] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(y, pa.float64())], ["word", "label"])


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Densities are per word, rates per character; 0 for a text without words."""
    raw = (text or "").split()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    words = [w.strip(EDGE).lower() for w in raw]
    hits = [i for i, w in enumerate(words) if w in lexicon]
    hidden = 0
    if not text.isalpha():
        odd = [i for i, w in enumerate(raw) if not w.isalpha() and LETTER_INSIDE.search(w)]
        hidden = len(odd)
        hits = sorted({*hits, *(i for i in odd if words[i].translate(LOOKALIKE) in lexicon)})
    weights = [lexicon.get(words[i]) or lexicon.get(words[i].translate(LOOKALIKE), 0.0) for i in hits]
    you = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON], np.int64)
    near = 0
    if len(you) and hits:
        h = np.array(hits)
        k = np.searchsorted(you, h)
        gap = np.minimum(np.abs(h - you[np.minimum(k, len(you) - 1)]), np.abs(h - you[np.maximum(k - 1, 0)]))
        near = int((gap <= NEAR).sum())
    chars = max(1, len(text))
    loud = LOUD.findall(text) if "!" in text or "?" in text else []
    return [len(hits) / n, sum(weights) / n, max(weights, default=0.0), float(len({words[i] for i in hits})), float(bool(hits)), len(you) / n, near / n,
            sum(map(str.isupper, text)) / chars if not text.islower() else 0.0, sum(map(str.isupper, raw)) / n,
            (text.count("!") + text.count("?")) / chars, sum(map(len, loud)) / chars, hidden / n]


def _feature_rows(lexicon, extra: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        for b in batches:
            x = np.array([features(t.as_py(), lex) for t in b.column("text")], np.float64).reshape(-1, len(FEATURES))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in extra] + [lists], [*extra, "x"])
    return rows


def held_out(id_col: str):
    """crc32 of the id as text leaves no remainder: such rows are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD == 0, F.lit(True))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words with high log-odds of the label; ``sample``: text, label (0.0 or 1.0). At most ``LEXICON`` words."""
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1.0, 0), n.get(0.0, 0)
    met = sample.select("text", "label").mapInArrow(_distinct_words, "word string, label double").groupBy("word").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    top = met.filter(F.col("a") >= MET).withColumn("odds", odds).filter(F.col("odds") >= ODDS).orderBy(F.desc("a"), "word").limit(LEXICON)
    return {r.word: float(r.odds) for r in top.collect()}


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("label")).filter("label IN (0, 1)")
    known = known.filter(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(FIT_ROWS)
    sample = stored(rows.join(stored(known, "labels"), "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5))), "sample")
    shares = sample.agg(F.avg("label").alias("p"), F.min("label").alias("a"), F.max("label").alias("b")).first()
    if shares.p is None or shares.a == shares.b:
        out = rows.select("doc_id", held_out("doc_id").alias("held_out"), F.lit(float(shares.p or 0.0)).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    lexicon = spark.sparkContext.broadcast(learn_lexicon(sample.filter("part < 2")))
    names = ["label", "part"]
    fit = stored(sample.select("text", *names).mapInArrow(_feature_rows(lexicon, names), "label double, part bigint, x array<double>"), "fit")
    fit = fit.select("label", "part", array_to_vector("x").alias("features"))
    trees_rows = fit.filter("part IN (2, 3)").coalesce(2).cache()
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7, stepSize=0.2).fit(trees_rows)
    trees_rows.unpersist()
    raw = trees.transform(fit.filter("part = 4")).select("label", vector_to_array("probability")[1].alias("p"))
    steps = IsotonicRegression(featuresCol="p", labelCol="label").fit(raw)
    x = rows.mapInArrow(_feature_rows(lexicon, ["doc_id", "text"][:1]), "doc_id bigint, x array<double>")
    scored = trees.transform(x.select("doc_id", array_to_vector("x").alias("features"))).select("doc_id", vector_to_array("probability")[1].alias("p"))
    out = steps.transform(scored).select("doc_id", held_out("doc_id").alias("held_out"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction"))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
