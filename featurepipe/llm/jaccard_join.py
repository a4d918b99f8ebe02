"""Exact Jaccard self-join of shingle sets as a metric-space join, and its components.

d(x, y) = 1 - |x & y| / |x | y| is a metric, so pivots and the triangle inequality
decide which pairs can be within ``1 - threshold``:

1. Equal sets have distance 0: one class per set, its smallest id stands for it.
2. Between unrelated texts d is close to 1, whatever texts are taken as pivots, so
   windows around document pivots alone would hold every document. The first
   pivots are therefore the singletons {t}: a set's Voronoi region is its first
   shingle in one fixed order, and the triangle inequality bounds how many of its
   shingles a partner can lack: n - ceil(threshold * n). The set is replicated
   into the regions of that many further shingles, and partners meet in one at
   least. Any order is correct; shingles in buckets that are met far more often than
   the mean bucket go last (counted over all sets in a table of fixed size), which
   leaves shared passages out of nearly all windows.
3. Inside a region a document is the pivot: the one that shares most regions. Where two
   members first meet, their places in the order bound what they can share, so members
   that are too late for any partner's size leave the region. The others are compared
   with the pivot first by L1 distance of count sketches (a contraction of the metric:
   never more than the size of the symmetric difference, so it only rejects what
   cannot link), then exactly by their sets. Members within the radius are linked.
4. Regions recurse: those that still hold two components drop their pivot and the
   part of its ball that no outside member's window reaches (lower bound of d to
   the pivot more than the radius away). Regions of at most ``LEAF`` members compare
   their remaining members in different components directly. What is still
   larger after ``LEVELS`` rounds is dealt into blocks of LEAF, and the members outside the
   region's largest component visit all of them, so that no task holds a large region.

Pairs inside one component are not compared again, so a group of n near copies costs
about n comparisons per level. Only ids, sketches of 128 bytes and the sets of
candidate pairs are shuffled.

Rows that share an id are one vertex. Ids that carry several different sets enter the join as
one vertex per text, under numbers that no id has; links go back to the ids afterwards.
Null ids get no component, null or empty texts an empty set linked with nothing. Repeated
rows give repeated output rows; an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.components import components
from featurepipe.llm.store import ship, stored, stored_with
from featurepipe.llm.words import shingle_sets

LEAF = 32  # members of a region compared pair by pair
LEVELS = 1  # rounds of document pivots before blocks
BROADCAST_IDS = 500_000  # ids that select texts by a broadcast (8 MB); more are joined by a shuffle
COUNTERS = 1 << 22  # buckets in which shingles are counted
PART = 1 << 16  # counters of one row
BUCKETS = 128  # counters of a sketch
LATE = np.int64(1 << 62)  # added to the 62-bit hash of a frequent shingle
SETS = "id bigint, n bigint, key binary, part int, counts binary"


def _lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values.astype(np.int64)))


def _windows(n: np.ndarray, percent: int) -> np.ndarray:
    """Regions a set of n shingles is replicated into."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def _heads(values: np.ndarray, off: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = np.arange(len(values)) - np.repeat(off[:-1], np.diff(off)) < np.repeat(take, np.diff(off))
    return values[keep], np.concatenate(([0], np.cumsum(take)))


def _set_rows(k: int):
    """A row per text; then, per task, rows of counters (``part``, ``counts``) of its sets' shingles."""
    names = ["id", "n", "key", "part", "counts"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for b in batches:
            for i, v, off in shingle_sets(b.column(1), k):
                n = np.diff(off)
                met, times = np.unique((v % np.uint64(COUNTERS)).astype(np.int64), return_counts=True)
                counts[met] += times.astype(np.uint32)
                keys = [hashlib.blake2b(v[s:e].tobytes(), digest_size=16).digest() for s, e in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, len(n)), pa.array(n), pa.array(keys, pa.binary()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
        for p in range(0, COUNTERS, PART):
            part = counts[p : p + PART]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([p // PART], pa.int32()), pa.array([part.tobytes()], pa.binary())], names)
    return rows


def _frequent_bits(level: float):
    """mapInArrow: rows (part, counts) sorted by part to one row per part, a bit for each sum of at least ``level``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bits(part, total):
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(total >= level).tobytes()], pa.binary())], ["part", "bits"])

        held, total = None, None
        for b in batches:
            for part, raw in zip(b.column("part").to_pylist(), b.column("counts")):
                if part != held:
                    if held is not None:
                        yield bits(held, total)
                    held, total = part, np.zeros(PART, np.uint64)
                total += np.frombuffer(raw.as_buffer(), np.uint32)
        if held is not None:
            yield bits(held, total)
    return rows


def _frequent(counters: DataFrame, shingles: int) -> np.ndarray:
    """Packed bits of the buckets met far more often than the mean bucket: ``COUNTERS`` / 8 bytes reach the driver."""
    mean = shingles / COUNTERS
    found = counters.repartition("part").sortWithinPartitions("part").mapInArrow(_frequent_bits(mean + 6 * mean**0.5 + 8), "part int, bits binary")
    out = np.zeros(COUNTERS // 8, np.uint8)
    for r in found.collect():
        out[r.part * PART // 8 : (r.part + 1) * PART // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def _ordered_rows(k: int, percent: int, late):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.unpackbits(late.value).astype(bool)
        for b in batches:
            for i, v, off in shingle_sets(b.column(1), k):
                n = np.diff(off)
                of = np.repeat(np.arange(len(n)), n)
                sketch = np.minimum(np.bincount(of * BUCKETS + (v % np.uint64(BUCKETS)).astype(np.int64), minlength=len(n) * BUCKETS), 255).astype(np.uint8)
                t = v.astype(np.int64) + LATE * last[(v % np.uint64(COUNTERS)).astype(np.int64)]
                t = t[np.lexsort((t, of))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, len(n)), pa.array(n), pa.FixedSizeBinaryArray.from_buffers(pa.binary(BUCKETS), len(n), [None, pa.py_buffer(sketch.tobytes())]).cast(pa.binary()),
                     _lists(*_heads(t, off, _windows(n, percent)))],
                    ["id", "n", "sketch", "window"])
    return rows


def _whole_sets(k: int):
    """(id, set as bytes), once per task for repeated rows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for i, v, off in shingle_sets(b.column(1), k):
                out = []
                for one, s, e in zip(b.column(0).slice(i, len(off) - 1).to_pylist(), off[:-1], off[1:]):
                    raw = v[s:e].tobytes()
                    mark = (one, hashlib.blake2b(raw, digest_size=16).digest())
                    if mark not in seen:
                        seen.add(mark)
                        out.append((one, raw))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["id", "members"])
    return rows


def _bound(percent: int):
    """Pairs with a lower bound of their symmetric difference, and whether they can link."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nx, ny = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("nx", "ny"))
            low = np.zeros(len(nx), np.int64)
            for i in range(0, len(nx), 4096):
                x, y = (np.frombuffer(b"".join(b.column(c).slice(i, 4096).to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int16) for c in ("sx", "sy"))
                low[i : i + 4096] = np.abs(x - y).sum(axis=1)
            need = -(-percent * (nx + ny) // (100 + percent))
            can = (low <= nx + ny - 2 * need) & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y"), pa.array(low / np.maximum(1, (nx + ny + low) / 2)), pa.array(can)], ["x", "y", "low", "can"])
    return rows


def _exact(percent: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = np.ones(len(b))
            linked = np.zeros(len(b), bool)
            for i, (p, q) in enumerate(zip(b.column("mx"), b.column("my"))):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (p, q))
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(y) else 0
                either = len(x) + len(y) - both
                d[i] = 1 - both / max(1, either)
                linked[i] = either > 0 and 100 * both >= percent * either
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y"), pa.array(d), pa.array(linked)], ["x", "y", "d", "linked"])
    return rows


def _few(ids: DataFrame, name: str) -> DataFrame:
    """A stored table of ids, to be broadcast while there are at most ``BROADCAST_IDS``."""
    ids, seen = stored_with(ids, name)
    return F.broadcast(ids) if seen["n"] <= BROADCAST_IDS else ids


class _Space:
    """The class representatives with what comparing them needs."""

    def __init__(self, docs: DataFrame, sets: DataFrame, k: int, percent: int):
        self.docs, self.sets, self.k, self.percent = docs, sets.select("id", "n", "sketch"), k, percent

    def compare(self, pairs: DataFrame) -> tuple[DataFrame, int]:
        """(x, y, low, d, linked) of distinct pairs: lower bound of d, d where it had to be computed, the verdict; the number of links."""
        x = self.sets.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx"))
        y = self.sets.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("sketch").alias("sy"))
        bound = stored(pairs.join(x, "x").join(y, "y").select("x", "y", "nx", "ny", "sx", "sy")
                       .mapInArrow(_bound(self.percent), "x bigint, y bigint, low double, can boolean"), "bounds")
        can = bound.filter("can").select("x", "y").distinct()
        ids = _few(can.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "ids")
        # sets are dealt by id once: the distinct and both joins keep that partitioning
        members = self.docs.join(ids, "id", "left_semi").mapInArrow(_whole_sets(self.k), "id bigint, members binary").repartition("id").distinct()
        exact = (can.join(members.select(F.col("id").alias("x"), F.col("members").alias("mx")), "x")
                 .join(members.select(F.col("id").alias("y"), F.col("members").alias("my")), "y").select("x", "y", "mx", "my")
                 .mapInArrow(_exact(self.percent), "x bigint, y bigint, d double, linked boolean")
                 .groupBy("x", "y").agg(F.min("d").alias("d"), F.max("linked").alias("linked")))
        low = bound.groupBy("x", "y").agg(F.min("low").alias("low"))
        tested, seen = stored_with(low.join(exact, ["x", "y"], "left").withColumn("linked", F.coalesce("linked", F.lit(False))), "compared", links=F.count_if("linked"))
        return tested, seen["links"]


def _fits(percent: int, x: str, y: str) -> str:
    """Whether two sets can link that meet first at these places (n: size, pos: place) of the order."""
    both = f"{percent} * (n{x} + n{y})"
    return (f"{100 + percent} * (n{x} - pos{x}) >= {both} AND {100 + percent} * (n{y} - pos{y}) >= {both} "
            f"AND 100 * least(n{x}, n{y}) >= {percent} * greatest(n{x}, n{y})")


def _as(df: DataFrame, side: str, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in ("t", "j") else c + side) for c in cols])


def _pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of members of one small region that lie in different components and can link."""
    cols = ("id", "n", "pos", "component")
    a, b = _as(members, "x", "t", *cols), _as(members, "y", "t", *cols).withColumnRenamed("t", "t2")
    return (a.join(b, F.expr(f"t = t2 AND idx < idy AND componentx <> componenty AND {_fits(percent, 'x', 'y')}"))
            .select(F.col("idx").alias("x"), F.col("idy").alias("y")).distinct())


def _visits(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of members of one large region that lie in different components and can link.

    Members are dealt into blocks of about LEAF. Those outside the region's largest component
    visit every block; the largest component stays at home, since its members are not compared
    with each other. A group of n near copies with o other members costs n + o * (n + o) / LEAF rows.
    """
    sizes = members.groupBy("t", "component").agg(F.count(F.lit(1)).alias("held"))
    homes = sizes.groupBy("t").agg(F.max(F.struct("held", "component")).getField("component").alias("home"))
    blocks = F.ceil(F.col("size") / LEAF).cast("int")
    m = stored(members.join(homes, "t").select("t", "id", "n", "pos", "component", "size", (F.col("component") == F.col("home")).alias("home")), "homes")
    cols = ("id", "n", "pos", "component", "home")
    guests = _as(m.filter("NOT home").withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1))), "x", "t", "j", *cols)
    hosts = _as(m.withColumn("j", F.pmod(F.xxhash64("id"), blocks).cast("int")), "y", "t", "j", *cols).withColumnsRenamed({"t": "t2", "j": "j2"})
    met = guests.join(hosts, F.expr(f"t = t2 AND j = j2 AND (homey OR idx < idy) AND componentx <> componenty AND {_fits(percent, 'x', 'y')}"))
    return met.select(F.least("idx", "idy").alias("x"), F.greatest("idx", "idy").alias("y")).distinct()


def _star(members: DataFrame, percent: int) -> DataFrame:
    """Distinct (x, y) of each member and its region's pivot, where they can link; ``members`` has npivot and pospivot."""
    m = members.filter("id <> pivot").select("id", F.col("n").alias("nx"), F.col("pos").alias("posx"), "pivot", F.col("npivot").alias("ny"), F.col("pospivot").alias("posy"))
    return m.filter(_fits(percent, "x", "y")).select(F.least("id", "pivot").alias("x"), F.greatest("id", "pivot").alias("y")).distinct()


def _with_pivots(members: DataFrame, percent: int) -> DataFrame:
    """``members`` (t, id, n, pos, shared) that can have a partner in their region, with its pivot."""
    cells = members.groupBy("t").agg(F.min("n").alias("least"))
    m = members.join(cells, "t").filter(f"{percent} * least <= {100 + percent} * (n - pos) - {percent} * n").drop("least")
    pivots = m.groupBy("t").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("shared", (-F.col("id")).alias("least"), "n", "pos")).alias("p")).filter("size > 1")
    pivots = pivots.select("t", "size", (-F.col("p.least")).alias("pivot"), F.col("p.n").alias("npivot"), F.col("p.pos").alias("pospivot"))
    return m.join(pivots, "t")


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component): one row per row of ``docs``.

    ``component`` is the smallest id reachable over links, its own id without any. Two
    ids link when ``100 * |x & y| >= percent * |x | y|`` for their sets of k-word shingles.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    first = stored(docs.mapInArrow(_set_rows(k), SETS), "sets")
    sets = first.filter("part IS NULL").select("id", "n", "key")
    mark = F.xxhash64("key")
    several = sets.filter("id IS NOT NULL AND n > 0").groupBy("id").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).filter("low < high")
    several, seen = stored_with(several.select("id"), "several")
    if seen["n"]:
        several = F.broadcast(several) if seen["n"] <= BROADCAST_IDS else several
        vertices, owners = _vertices(docs, several, sets.select("id"))
        comp = _components(vertices, stored(vertices.mapInArrow(_set_rows(k), SETS), "sets"), k, percent)
        # an id's vertices and the vertices of their components, all by the ids that own them; loops hold nothing
        u, v = owners.toDF("id", "u"), owners.toDF("component", "v")
        owned = comp.join(u, "id", "left").join(v, "component", "left").select(F.coalesce("u", "id").alias("u"), F.coalesce("v", "component").alias("v"))
        comp = stored(components(owned, "u", "v"), "components")
    else:
        comp = _components(docs, first, k, percent)
    return sets.join(comp, "id", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))


def _vertices(docs: DataFrame, several: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a number for each text in place of the ids in ``several``, and the table (number, id).

    Numbers are hashes, salted anew until they are distinct and none is an id.
    """
    text = F.coalesce("text", F.lit(""))
    texts = stored(docs.join(several, "id", "left_semi").select("id", F.sha2(text, 256).alias("sha")).distinct(), "texts")
    salt, clash = 0, True
    while clash:
        salt += 1
        owners = stored(texts.select(F.xxhash64(F.lit(salt), "id", "sha").alias("vertex"), "id"), "owners")
        clash = bool(owners.groupBy("vertex").count().filter("count > 1").limit(1).count() or owners.join(ids, owners["vertex"] == ids["id"], "left_semi").limit(1).count())
    number = F.when(F.col("split"), F.xxhash64(F.lit(salt), "id", F.sha2(text, 256))).otherwise(F.col("id"))
    return docs.join(several.withColumn("split", F.lit(True)), "id", "left").select(number.alias("id"), "text"), owners


def _components(docs: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component) of linked ids; ``docs`` (id, text) has one set per id, ``first`` is its ``_set_rows``."""
    spark = docs.sparkSession
    sets = first.filter("part IS NULL").select("id", "n", "key")
    known = sets.filter("id IS NOT NULL AND n > 0")
    classes = stored(known.groupBy("key").agg(F.min("id").alias("rep")), "classes")
    edges = known.join(classes, "key").select(F.col("id").alias("x"), F.col("rep").alias("y"))
    edges = stored(edges.filter("x <> y").distinct(), "links")

    late = spark.sparkContext.broadcast(_frequent(first.filter("part IS NOT NULL").select("part", "counts"), known.agg(F.sum("n")).first()[0] or 0))
    # ids that stand for no class
    copies = _few(edges.select(F.col("x").alias("id")).distinct().join(classes.select(F.col("rep").alias("id")), "id", "left_anti"), "copies")
    space_rows = stored(docs.filter("id IS NOT NULL").mapInArrow(_ordered_rows(k, percent, late), "id bigint, n bigint, sketch binary, window array<bigint>")
                        .filter("n > 0").join(copies, "id", "left_anti"), "space")
    space = _Space(docs, space_rows, k, percent)

    # regions of at least two sets
    placed = space_rows.select("id", "n", F.posexplode("window").alias("pos", "t"))
    met = stored(placed.groupBy("t").count().filter("count > 1").select("t"), "met")
    members = stored(placed.join(met, "t").select("t", "id", "n", "pos"), "regions")
    shared = members.groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    members = stored(_with_pivots(members.join(shared, "id"), percent), "members")

    tested, links = space.compare(stored(_star(members, percent), "pairs"))
    comp = stored(components(edges.unionByName(tested.filter("linked").select("x", "y")), "x", "y"), "components")
    for level in range(1, LEVELS + 1):
        members, pairs = _next_level(members, comp, tested, percent, level == LEVELS)
        pairs, seen = stored_with(pairs, "pairs")
        if not seen["n"]:
            break
        tested, links = space.compare(pairs)
        if links:  # between components: few, whatever the sizes of these
            of = comp.select(F.col("id").alias("x"), F.col("component").alias("cx"))
            joined = tested.filter("linked").join(of, "x", "left").join(of.toDF("y", "cy"), "y", "left")
            joined = stored(components(joined.select(F.coalesce("cx", "x").alias("u"), F.coalesce("cy", "y").alias("v")), "u", "v"), "joined")
            more = comp.join(joined.toDF("component", "low"), "component", "left").select("id", F.coalesce("low", "component").alias("component"))
            alone = joined.join(comp, "id", "left_anti")
            comp = stored(more.unionByName(alone), "components")
    return comp


def _next_level(members: DataFrame, comp: DataFrame, tested: DataFrame, percent: int, last: bool):
    """Regions that still hold two components without their pivots, and the pairs to compare in them."""
    radius = 1 - percent / 100 + 1e-9
    t = tested.select(F.col("x").alias("id"), F.col("y").alias("pivot"), "low", "d", "linked")
    t = t.unionByName(t.select(F.col("pivot").alias("id"), F.col("id").alias("pivot"), "low", "d", "linked"))
    of_pivot = comp.select(F.col("id").alias("pivot"), F.col("component").alias("cp"))
    # a region of two has been compared
    m = stored(members.filter("size > 2").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id")), "placed")
    two = m.groupBy("t").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 < c1").select("t")
    m = m.join(two, "t", "left_semi").filter("id <> pivot").join(of_pivot, "pivot", "left").withColumn("cp", F.coalesce("cp", "pivot"))
    m = stored(m.join(t, ["id", "pivot"], "left"), "around")
    # pairs that cannot link at their places were not compared: nothing is known of their distance
    reach = m.groupBy("t").agg(F.min(F.when(F.col("component") != F.col("cp"), F.coalesce("d", "low", F.lit(0.0)))).alias("outer"))
    # a ball member farther than the radius from every outside member's distance to the pivot is settled
    m = m.join(reach, "t").filter(~F.coalesce("linked", F.lit(False)) | F.col("outer").isNull() | (F.col("d") + radius >= F.col("outer")))
    m = _with_pivots(m.select("t", "id", "n", "pos", "shared", "component"), percent)
    cells = m.groupBy("t").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 < c1").select("t")
    m = stored(m.join(cells, "t", "left_semi"), "level")
    pairs = _pairs(m.filter(F.col("size") <= LEAF), percent)
    large = m.filter(F.col("size") > LEAF)
    if last:
        return large, pairs.unionByName(_visits(large, percent)).distinct()
    return large.drop("component"), pairs.unionByName(_star(large, percent)).distinct()
