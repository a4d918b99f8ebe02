"""Mixing sources by temperature: weights, then budgeted block permutations.

Source shares p (of all token ids, counted with the encoder and vocabulary that packing
uses) become weights p^a / sum p^a. Lower exponents even the mix
out. The exponent is bisected until the weights' entropy reaches its target (a part of
the way from the entropy of p to the uniform mix), and raised again where a source
would be repeated more than ``max_repeats`` times as often as the least repeated one (the
entropy then stays below its target).
Each step sums over the per-source table in Spark; the driver sees two numbers.

A source's budget is its weight times the mix's size, chosen so that the least
repeated source is used once: every document appears, small sources repeat. Whole
epochs repeat every document. The rest of a budget is drawn from a permutation of the
source's hash blocks: blocks in permuted order while they fit, then documents of the
block on the edge in hash order up to the budget. Running sums go over blocks (at
most ``BLOCKS`` per source) and inside edge blocks, so a source that holds a third of
all rows is spread over its blocks.

Null sources are a source of their own. Null and empty texts weigh 0 tokens and appear in
whole epochs. Repeated rows and ids are each counted; an empty table gives an empty
mix; all columns of the input are kept, whatever their names, but for those that the mix adds (``ADDED``).
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurepipe.llm.store import ship, stored
from featurepipe.llm.token_orc import vocabulary_path
from featurepipe.llm.tokens import DEFAULT_VOCABULARY, encoder

BLOCKS = 1024
STEPS = 30
ENTROPY = 0.5
ADDED = ["mix_id", "mix_source", "mix_words", "mix_tokens", "mix_block", "mix_epoch", "mix_weight"]
MAX_REPEATS = 4.0  # a third of all tokens in one source and a thirtieth in each of 20 needs 1.64 to meet the entropy


def source_weights(totals: DataFrame, entropy: float = ENTROPY, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``totals`` (source, tokens) with ``share``, ``weight`` and ``epochs`` (1 for the least repeated; 1 for sources without tokens)."""
    live = totals.filter("tokens > 0")
    p = stored(live, "totals")
    total = p.agg(F.sum("tokens")).first()[0]
    if not total:
        return totals.select("source", "tokens", F.lit(0.0).alias("share"), F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs"))
    share = F.col("tokens") / F.lit(float(total))

    def at(a: float) -> tuple[float, float]:
        """Entropy of the weights, and the most against the least repeated source."""
        w = F.pow(share, F.lit(a))
        r = p.agg(F.sum(w).alias("z"), F.sum(w * F.log(w)).alias("s"), (F.max(w / share) / F.min(w / share)).alias("r")).first()
        return math.log(r.z) - r.s / r.z, float(r.r)

    natural, even = at(1.0)[0], at(0.0)[0]
    goal = natural + entropy * (even - natural)
    low, high = 0.0, 1.0  # entropy falls with the exponent: low meets the goal
    for _ in range(STEPS):
        mid = (low + high) / 2
        e, repeats = at(mid)
        low, high = (mid, high) if e >= goal or repeats > max_repeats else (low, mid)
    a = high if at(low)[1] > max_repeats else low
    z, least = p.agg(F.sum(F.pow(share, F.lit(a))), F.min(F.pow(share, F.lit(a)) / share)).first()
    scored = totals.withColumn("share", share).withColumn("weight", F.when(F.col("tokens") > 0, F.pow(share, F.lit(a)) / F.lit(float(z))).otherwise(0.0))
    epochs = F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(float(z)) / share / F.lit(float(least)), 9)).otherwise(1.0)
    return scored.withColumn("epochs", epochs)


def _tokens(vocabulary: str):
    """Token ids of each text; as a column, it is not computed where nothing reads it."""
    def count(text: pa.Array) -> pa.Array:
        e = encoder(vocabulary_path(vocabulary))
        return pa.array([len(e.encode(t.as_py())) // 4 for t in text], pa.int64())

    return F.arrow_udf(count, "bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", entropy: float = ENTROPY, max_repeats: float = MAX_REPEATS, blocks: int = BLOCKS, seed: int = 17, keep: bool = True, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The mix: rows of ``docs`` with ``mix_source``, ``mix_words``, ``mix_tokens``, ``mix_block``, ``mix_epoch`` (0, 1, ...), ``mix_weight``.

    With ``keep`` all columns stay, else only id and source come along (as ``mix_id``) and the
    texts are read once.
    """
    ship(docs.sparkSession)
    key = F.col(id_col).cast("string")
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")] if keep else []
    draw = F.xxhash64(F.lit(seed), F.coalesce(key, F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(*own, F.col(id_col).alias("mix_id"), F.col(source_col).cast("string").alias("mix_source"), words.alias("mix_words"), _tokens(vocabulary)(F.col(text_col).cast("string")).alias("mix_tokens"), draw.alias("mix_draw"))
    rows = rows.withColumn("mix_block", F.pmod("mix_draw", F.lit(blocks)).cast("int"))
    small = stored(rows.select(*([] if keep else ["mix_id", "mix_words"]), "mix_source", "mix_block", "mix_tokens", "mix_draw"), "drawn")
    if not keep:
        rows = small
    by_block = stored(small.groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("block_tokens")), "blocks")
    totals = by_block.groupBy(F.col("mix_source").alias("source")).agg(F.sum("block_tokens").alias("tokens"))
    weights = stored(source_weights(totals, entropy, max_repeats), "weights")

    # the blocks' permuted order: how much of the budget beyond whole epochs is left where a block begins
    before = Window.partitionBy("mix_source").orderBy(F.xxhash64(F.lit(seed + 1), "mix_source", "mix_block"), "mix_block").rowsBetween(Window.unboundedPreceding, -1)
    plan = by_block.withColumn("done", F.coalesce(F.sum("block_tokens").over(before), F.lit(0)))
    plan = plan.join(weights, F.col("mix_source").eqNullSafe(F.col("source")))
    over = (F.col("epochs") - F.floor("epochs")) * F.col("tokens")
    plan = plan.select(F.col("mix_source").alias("s"), F.col("mix_block").alias("b"), F.floor("epochs").cast("int").alias("full"), F.col("weight").alias("mix_weight"),
                       (over - F.col("done")).alias("room"), "block_tokens")
    plan = stored(plan, "plan")
    # documents of edge blocks, in hash order, while they fit
    edge = small.join(plan.filter("room > 0 AND room < block_tokens"), (F.col("mix_block") == F.col("b")) & F.col("mix_source").eqNullSafe(F.col("s")))
    upto = Window.partitionBy("mix_source", "mix_block").orderBy("mix_draw").rangeBetween(Window.unboundedPreceding, 0)
    cut = edge.withColumn("sum", F.sum("mix_tokens").over(upto)).filter("sum <= room").groupBy("s", "b").agg(F.max("mix_draw").alias("last"))
    plan = stored(plan.join(cut.select(F.col("s").alias("s2"), F.col("b").alias("b2"), "last"), (F.col("b") == F.col("b2")) & F.col("s").eqNullSafe(F.col("s2")), "left").drop("s2", "b2"), "plan")
    # what is joined has names of its own, and the input's columns travel as one struct
    extra = (F.col("room") > 0) & ((F.col("room") >= F.col("block_tokens")) | (F.col("mix_draw") <= F.col("last")))
    copies = F.col("full") + F.when(F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    out = rows.join(plan, (F.col("mix_block") == F.col("b")) & F.col("mix_source").eqNullSafe(F.col("s"))).withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
    back = [F.col("own").getField(c).alias(c) for c in docs.columns if c not in ADDED] if keep else []
    return out.select(*back, *ADDED)
