"""Packing documents into sequences by linear grouping, then best fit.

Lengths are integers up to ``capacity``, so counts per length (at most ``capacity`` rows)
are all the planning needs, whatever the number of documents:

1. Linear grouping: large pieces, longest first, fall into ``GROUPS`` groups of equal
   cardinality; each length counts as its group's largest, which leaves few sizes.
2. Configurations of these sizes are optimised by a sequential procedure: for the
   largest size left a knapsack finds the fullest combination, which is used as often as
   the counts allow.
3. Actual pieces take the places by their rank in length order, and sequences keep the
   room that rounding up had wasted.
4. Small pieces, longest first, go by best fit into the sequences with the least
   sufficient room, again over counts per room; the rest fills new sequences.

The plan is a list of (rank range, sequence range) of bounded size; ranks are counted in
salted partitions, so a length or a room that a third of all pieces share does not
land in one task. Pieces of one sequence meet only to get their offsets.

Null texts are empty and consist of the end id. Repeated rows and ids are each packed;
null ids too; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurepipe.llm.store import ship, stored
from featurepipe.llm.token_orc import vocabulary_path
from featurepipe.llm.tokens import DEFAULT_VOCABULARY, encoder

CAPACITY = 4096
END_ID = 1
GROUPS = 96
SMALL = 8  # pieces up to capacity / SMALL are placed by best fit
SALTS = 256
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(vocabulary: str, end_id: int, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary_path(vocabulary))
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = e.encode(t.as_py()) + end
                out.extend((i, p, s // 4, len(raw[s : s + step]) // 4, zlib.crc32(raw[s : s + step])) for p, s in enumerate(range(0, len(raw), step)))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return rows


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut after every ``capacity``."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_cut(vocabulary, end_id, capacity), PIECES)


# ------------------------------------------------------------ planning over counts


def group_up(counts: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
    """Linear grouping: (rounded length, first rank, count), longest first, of equal cardinality."""
    total = sum(counts.values())
    lengths = sorted(counts, reverse=True)
    ends = np.cumsum([counts[n] for n in lengths])
    cuts = sorted({round(total * g / groups) for g in range(groups + 1)})
    return [(lengths[int(np.searchsorted(ends, a, side="right"))], a, b - a) for a, b in zip(cuts, cuts[1:])]


def fullest(sizes: list[int], left: list[int], room: int) -> list[int]:
    """How many of each size (at most ``left``) fill ``room`` best: a bounded knapsack on sums."""
    made = np.full(room + 1, -1, np.int64)  # the last size that first reached a sum
    made[0] = len(sizes)
    for k, (s, n) in enumerate(zip(sizes, left)):
        for _ in range(min(n, room // s)):
            reach = np.zeros(room + 1, bool)
            reach[s:] = (made[:-s] >= 0) & (made[s:] < 0)
            if not reach.any():
                break
            made[reach] = k
        if made[room] >= 0:
            break
    used = [0] * len(sizes)
    at = int(np.flatnonzero(made >= 0)[-1])
    while at > 0:
        k = int(made[at])
        used[k] += 1
        at -= sizes[k]
    return used if all(u <= n for u, n in zip(used, left)) else []


def configurations(groups: list[tuple[int, int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Places for all members of the groups: (first rank, end rank, first sequence, members per sequence); sequences used."""
    sizes, rank, left = [g[0] for g in groups], [g[1] for g in groups], [g[2] for g in groups]
    places, bins = [], 0
    for g in range(len(groups)):
        while left[g]:
            most = [min(n, max(1, capacity // s)) for s, n in zip(sizes[g:], left[g:])]
            most[0] -= 1
            use = fullest(sizes[g:], most, capacity - sizes[g])
            if not use:  # a sum made of more members than there are: the largest that fit, one after the other
                use, room = [0] * len(most), capacity - sizes[g]
                for k, s in enumerate(sizes[g:]):
                    use[k] = min(most[k], room // s)
                    room -= use[k] * s
            use[0] += 1
            times = min(n // u for n, u in zip(left[g:], use) if u)
            for k, u in enumerate(use, g):
                if u:
                    places.append((rank[k], rank[k] + u * times, bins, u))
                    rank[k] += u * times
                    left[k] -= u * times
            bins += times
    return places, bins


def best_fit(small: dict[int, int], room: dict[int, int]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int]]:
    """Places of small lengths in sequences with room, and what does not fit.

    ``room``: sequences per free room. A place is (length, first rank, end rank, room, first
    sequence rank among those that started with that room).
    """
    free = {r: [(r, 0, n)] for r, n in room.items() if r > 0}  # room now -> (room at first, first, end)
    places, rest = [], {}
    for length in sorted(small, reverse=True):
        rank, end = 0, small[length]
        for r in sorted(free):
            while r >= length and rank < end and free.get(r):
                first, a, b = free[r].pop()
                n = min(b - a, end - rank)
                places.append((length, rank, rank + n, first, a))
                if a + n < b:
                    free[r].append((first, a + n, b))
                if r > length:
                    free.setdefault(r - length, []).append((first, a, a + n))
                rank += n
        # rooms that this length has just made may take it again
        while rank < end:
            fit = [r for r in free if r >= length and free[r]]
            if not fit:
                break
            r = min(fit)
            first, a, b = free[r].pop()
            n = min(b - a, end - rank)
            places.append((length, rank, rank + n, first, a))
            if a + n < b:
                free[r].append((first, a + n, b))
            if r > length:
                free.setdefault(r - length, []).append((first, a, a + n))
            rank += n
        if rank < end:
            rest[length] = end - rank
    return places, rest


# ------------------------------------------------------------ placing the rows


def ranked(df: DataFrame, key: str, order: list[str], salt: Column) -> DataFrame:
    """``df`` with ``rank``: 0, 1, ... among the rows of equal ``key``, counted in salted partitions."""
    df = stored(df.withColumn("__salt", salt), "salted")
    counts = df.groupBy(key, "__salt").count()
    before = Window.partitionBy(key).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(key, "__salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(key, "__salt").orderBy(*order)
    return df.withColumn("__in", F.row_number().over(inside)).join(base, [key, "__salt"]).withColumn("rank", F.col("__base") + F.col("__in") - 1).drop("__salt", "__in", "__base")


def _found(table: np.ndarray, key: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Index of the place of each (key, rank), or -1; ``table``: rows of (key, first, end, ...) in order, ends below 2^40."""
    if not len(table):
        return np.full(len(rank), -1)
    at = np.searchsorted(table[:, 0] * (1 << 40) + table[:, 1], key * (1 << 40) + rank, side="right") - 1
    ok = (at >= 0) & (table[at, 0] == key) & (rank < table[at, 2])
    return np.where(ok, at, -1)


def _placed(tables, base: dict[int, int]):
    """mapInArrow: the sequence of large pieces (by rank in length order), the room class of small ones."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large, fit, new = tables.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            whole = rank + np.array([base.get(int(n), -(1 << 39)) for n in length], np.int64)
            seq, room, at = np.full(len(rank), -1), np.full(len(rank), -1), np.full(len(rank), -1)
            for table, key, r in ((large, np.zeros_like(rank), whole), (new, length, rank)):
                k = _found(table, key, r)
                ok = k >= 0
                seq[ok] = table[k[ok], 3] + (r[ok] - table[k[ok], 1]) // table[k[ok], 4]
            k = _found(fit, length, rank)
            ok = k >= 0
            room[ok], at[ok] = fit[k[ok], 3], fit[k[ok], 4] + rank[ok] - fit[k[ok], 1]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(x.astype(np.int64)) for x in (seq, room, at))], ["doc_id", "piece", "start", "length", "ids_crc32", "seq", "room", "at"])
    return rows


def _table(rows: list[tuple]) -> np.ndarray:
    t = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return t


def pack(parts: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32; lengths 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    spark = parts.sparkSession
    ship(spark)
    parts = stored(ranked(parts, "length", ["doc_id", "piece", "ids_crc32"], F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))), "ranked")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    big = {n: c for n, c in counts.items() if n * small > capacity}
    places, bins = configurations(group_up(big, groups), capacity)
    base, at = {}, 0
    for n in sorted(big, reverse=True):
        base[n], at = at, at + big[n]
    send = spark.sparkContext.broadcast
    large = _table([(0, a, b, s, u) for a, b, s, u in places])
    none = np.empty((0, 5), np.int64)
    schema = f"{PIECES}, seq bigint, room bigint, at bigint"
    first = stored(parts.filter(F.col("length") * small > capacity).mapInArrow(_placed(send((large, none, none)), base), schema).drop("room", "at"), "large")

    room = first.groupBy("seq").agg((F.lit(capacity) - F.sum("length")).alias("room"))
    rooms = stored(ranked(room, "room", ["seq"], F.pmod(F.xxhash64("seq"), F.lit(SALTS))), "rooms")
    free = {r.room: r.n for r in rooms.groupBy("room").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    tiny = {n: c for n, c in counts.items() if n not in big}
    fits, rest = best_fit(tiny, free)
    # what is left of a length are its last ranks; each length is a group of its own
    left = [(n, 0, c) for n, c in sorted(rest.items(), reverse=True)]
    shift = {n: tiny[n] - c for n, c in rest.items()}
    new, k = [], 0
    starts = {}
    for n, _, c in left:  # ranks over all leftovers, one length after the other
        starts[n], k = k, k + c
    more, _ = configurations([(n, starts[n], c) for n, _, c in left], capacity)
    owner = sorted((s, n) for n, s in starts.items())
    for a, b, s, u in more:
        n = owner[int(np.searchsorted([o[0] for o in owner], a, side="right")) - 1][1]
        new.append((n, a - starts[n] + shift[n], b - starts[n] + shift[n], bins + s, u))
    fit = _table([(n, a, b, r, s) for n, a, b, r, s in fits])
    second = parts.filter(F.col("length") * small <= capacity).mapInArrow(_placed(send((none, fit, _table(new))), {}), schema)
    second = stored(second, "small")
    filled = second.filter("room >= 0").drop("seq").join(rooms.select("room", F.col("rank").alias("at"), "seq"), ["room", "at"]).drop("room", "at")
    rows = first.unionByName(filled).unionByName(second.filter("room < 0").drop("room", "at"))
    inside = Window.partitionBy("seq").orderBy(F.desc("length"), "doc_id", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).withColumnRenamed("seq", "sequence_id")
