"""Hard negatives by exact search over an inverted multi-index.

Vectors become integers (``floor(scale * x)``); a score is an integer inner product. Each half-space
has a codebook (k-means on about ``SAMPLE`` rows); a row's cell is its pair of codes, and every row is
indexed. Cells are dealt into blocks of about ``ROWS`` rows, one packed row per block, so a cell that
holds a third of all rows is many blocks.

For an anchor q the half score of any row of a code is at most ``q1.c + |q1| * R``, with R the
code's largest distance of a row from c. A heap walks the pairs of codes by falling sum of
both bounds (the multi-sequence walk); a pair is skipped where its own radii
show that it holds nothing wanted. Anchors ask for a few cells, then for four times as many,
and so on; each round joins the wanted cells' blocks with the anchors, in tiles of a block
and about ``QUERIES`` anchors, and keeps the best rows per anchor and window. An anchor stops when
its windows are certified: every window is full and its last score, or else its lower end, is above
the bound of the next cell. So results are exact, whatever the codebooks.

Two walks are made: the best rows of the anchor's label (its positives), then for each positive
the best rows of other labels within its window of scores.

Rows with a null label, a null vector, a null or non-finite component, another dimension than most
rows, or a squared norm of more than 2^55 (scores would leave 64 bits) take no part. Rows are told
apart by place: repeated rows count each, as anchors too, and other rows of an anchor's id are other rows. Equal
scores go by id, null ids last. Anchors without positives, and positives without negatives in their window, give no
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurepipe.llm.store import ship, stored, stored_with

SAMPLE = 20_000  # rows that codebooks are fitted on, about
CODES = 8  # entries of a codebook
STEPS = 12  # of k-means
ROWS = 4096  # rows of a block
QUERIES = 2048  # anchors of a tile
FIRST = 4  # cells that an anchor asks for in the first round
GROWTH = 4
TOO_LONG = float(1 << 55)
NO_ID = np.int64((1 << 63) - 1)
VECTOR = "row bigint, id bigint, label bigint, anchor boolean, vec binary"
WINDOWS = "array<struct<w:int,low:bigint,high:bigint>>"
HIT = "row bigint, w int, score bigint, id bigint"
ANY = (-(1 << 62), 1 << 62)  # a window of all scores


# ------------------------------------------------------------ vectors and codebooks


def _scaled(dim: int, scale: int):
    """(row, id, label, anchor, list) to rows that take part, vectors as little-endian int32."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("embedding")
            keep = np.array(v.value_lengths().fill_null(-1)) == dim
            flat = v.filter(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # null components are NaN
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * flat)
                good = np.isfinite(flat).all(axis=1) & ((x * x).sum(axis=1) <= TOO_LONG)
            keep[np.flatnonzero(keep)[~good]] = False
            kept = b.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in ("row", "id", "label", "anchor")), pa.array([r.tobytes() for r in x[good].astype("<i4")], pa.binary())], ["row", "id", "label", "anchor", "vec"])
    return rows


def _ints(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<i4").reshape(-1, dim).astype(np.float64)


def _k_means(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Codebook of the distinct rows of ``x``: Lloyd's steps from spread-out rows."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    r = np.random.default_rng(seed)
    c = x[[r.integers(len(x))]]
    while len(c) < k:
        far = ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1)
        c = np.vstack([c, x[r.choice(len(x), p=far / far.sum())]]) if far.any() else c
        if not far.any():
            break
    for _ in range(STEPS):
        of = _nearest(x, c)
        c = np.array([x[of == i].mean(axis=0) if (of == i).any() else c[i] for i in range(len(c))])
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1)[None] - 2 * x @ c.T).argmin(axis=1)


def _in_cells(books):
    """Adds the cell and both distances from its codes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c1, c2 = books.value
        half, dim = c1.shape[1], c1.shape[1] + c2.shape[1]
        for b in batches:
            x = _ints(b.column("vec").to_pylist(), dim)
            i, j = _nearest(x[:, :half], c1), _nearest(x[:, half:], c2)
            r1, r2 = np.linalg.norm(x[:, :half] - c1[i], axis=1), np.linalg.norm(x[:, half:] - c2[j], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array((i * len(c2) + j).astype(np.int32)), pa.array(r1), pa.array(r2)], [*b.schema.names, "cell", "r1", "r2"])
    return rows


def _packed(batch: pa.Table) -> pa.Table:
    """One row of a block's rows (ids, labels, places, vectors)."""
    def raw(name):
        return batch[name].fill_null(NO_ID).to_numpy().astype("<i8").tobytes()

    return pa.table({"cell": batch["cell"][:1], "block": batch["block"][:1], "ids": [raw("id")], "labels": [raw("label")], "rows": [raw("row")], "vecs": pa.array([b"".join(batch["vec"].to_pylist())], pa.binary())},
                    schema=pa.schema([("cell", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "rows", "vecs"))]))


class Index:
    """The packed blocks, and what the walk needs: codebooks, radii, blocks per cell (at most ``CODES`` squared)."""

    def __init__(self, vectors: DataFrame, n: int, dim: int, rows: int, codes: int):
        spark = vectors.sparkSession
        self.dim, self.spark = dim, spark
        shown = min(n, SAMPLE) / n * (1 << 30)
        sample = _ints([r.vec for r in vectors.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(np.ceil(shown))).select("vec").collect()], dim)
        half = dim // 2
        books = tuple(_k_means(x, codes) if len(x) else np.zeros((1, x.shape[1])) for x in (sample[:, :half], sample[:, half:]))
        placed = stored(vectors.mapInArrow(_in_cells(spark.sparkContext.broadcast(books)), f"{VECTOR}, cell int, r1 double, r2 double"), "cells")
        size = len(books[0]) * len(books[1])
        self.blocks, r1, r2 = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect():
            self.blocks[r.cell], r1[r.cell], r2[r.cell] = -(-r.n // rows), r.r1, r.r2
        self.walk = (books, r1, r2, self.blocks)
        per_cell = spark.createDataFrame([(i, int(b)) for i, b in enumerate(self.blocks)], "cell int, blocks int")
        dealt = placed.join(F.broadcast(per_cell), "cell").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        self.packed = stored(dealt.select("cell", "block", "id", "label", "row", "vec").groupBy("cell", "block").applyInArrow(_packed, "cell int, block int, ids binary, labels binary, rows binary, vecs binary"), "blocks")


# ------------------------------------------------------------ the walk


class Walk:
    """Cells by falling sum of both half-score bounds of one anchor."""

    def __init__(self, walk, vec: np.ndarray):
        (c1, c2), self.r1, self.r2, self.blocks = walk
        self.width = len(c2)
        q = vec[: c1.shape[1]], vec[c1.shape[1] :]
        self.norms = [float(np.linalg.norm(x)) for x in q]
        self.scores = [c @ x for c, x in zip((c1, c2), q)]
        radii = self.r1.reshape(len(c1), -1).max(axis=1), self.r2.reshape(len(c1), -1).max(axis=0)
        self.bounds = [s + n * r for s, n, r in zip(self.scores, self.norms, radii)]
        self.orders = [np.argsort(-u, kind="stable") for u in self.bounds]

    def __iter__(self) -> Iterator[tuple[int, float]]:
        """(cell, bound of its scores and of all later cells'), empty cells too."""
        (u, v), (p, q) = self.bounds, self.orders
        heap, seen = [(-(u[p[0]] + v[q[0]]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield int(p[i]) * self.width + int(q[j]), -bound
            for k in ((i + 1, j), (i, j + 1)):
                if k[0] < len(p) and k[1] < len(q) and k not in seen:
                    seen.add(k)
                    heapq.heappush(heap, (-(u[p[k[0]]] + v[q[k[1]]]), *k))

    def span(self, cell: int) -> tuple[float, float]:
        """Least and greatest score that a row of the cell can have."""
        i, j = divmod(cell, self.width)
        mid, reach = self.scores[0][i] + self.scores[1][j], self.norms[0] * self.r1[cell] + self.norms[1] * self.r2[cell]
        return mid - reach, mid + reach


def _slack(x: float) -> float:
    return 0.01 + 1e-9 * abs(x)  # beyond rounding; scores are integers


def wanted_cells(walk, vec: np.ndarray, windows: list[tuple[float, float]], done: int, limit: int) -> tuple[list[int], int]:
    """The next cells after ``done`` steps that can hold a row of a window (least, greatest score), at most ``limit``; steps done.

    Without cells the windows are certified.
    """
    cells, steps = [], 0
    w = Walk(walk, vec)
    least = min((low for low, _ in windows), default=np.inf)
    for cell, bound in w:
        if bound + _slack(bound) < least or len(cells) == limit:
            break
        steps += 1
        if steps > done and w.blocks[cell]:
            low, high = w.span(cell)
            if any(high + _slack(high) >= a and low - _slack(low) <= b for a, b in windows):
                cells.append(cell)
    return cells, steps


def _asked(walk, dim: int, keep: int, limit: int):
    """State rows to one row per wanted block; ``upto``: steps of the walk after this round."""
    names = ["cell", "block", "part", "row", "label", "vec", "windows", "upto"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = walk.value
        kinds = pa.list_(pa.struct([("w", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]))
        for b in batches:
            out = []
            for r in b.to_pylist():
                least = {}
                for h in r["hits"] or ():
                    least.setdefault(h["w"], []).append(h["score"])
                now = []  # full windows only take what reaches their last score
                for x in r["windows"]:
                    got = least.get(x["w"], ())
                    now.append({**x, "low": max(x["low"], 100 * min(got))} if len(got) >= keep else x)
                cells, upto = wanted_cells(data, _ints([r["vec"]], dim)[0], [(x["low"] / 100, x["high"] / 100) for x in now], r["done"], limit)
                out += [(c, k, r["part"], r["row"], r["label"], r["vec"], now, upto) for c in cells for k in range(data[3][c])]
            types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), kinds, pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 8, types)], names)
    return rows


def _best(score: np.ndarray, ids: np.ndarray, at: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` of the rows ``at`` with the highest scores, smaller ids first among equal ones."""
    if len(at) > keep:
        cut = np.partition(score[at], len(at) - keep)[len(at) - keep]
        at = at[score[at] >= cut]
    return at[np.lexsort((ids[at], -score[at]))[:keep]]


def _tile(dim: int, keep: int, same: bool):
    """Best rows of one block for each window of the anchors that ask for it."""
    def rows(asked: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(block):
            ids, labels, places = (np.frombuffer(block[c][0].as_py(), "<i8") for c in ("ids", "labels", "rows"))
            x, q = _ints([block["vecs"][0].as_py()], dim), _ints(asked["vec"].to_pylist(), dim)
            exact = np.sqrt((x * x).sum(axis=1).max() * (q * q).sum(axis=1).max()) < 1 << 52  # sums of doubles are then whole
            if not exact:
                x, q = x.astype(np.int64), q.astype(np.int64)
            own, label, windows = asked["row"].to_pylist(), asked["label"].to_pylist(), asked["windows"].to_pylist()
            for at in range(0, len(q), 256):
                scores = (q[at : at + 256] @ x.T).astype(np.int64)
                for i, score in enumerate(scores, at):
                    fits = (labels == label[i]) & (places != own[i]) if same else labels != label[i]
                    for w in windows[i]:
                        found = _best(score, ids, np.flatnonzero(fits & (100 * score >= w["low"]) & (100 * score <= w["high"])), keep)
                        out += [(own[i], w["w"], int(score[k]), None if ids[k] == NO_ID else int(ids[k])) for k in found]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, kinds)], names=["row", "w", "score", "id"])
    return rows


def _top(hits: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def search(index: Index, queries: DataFrame, keep: int, same: bool) -> DataFrame:
    """(row, w, score, id, rank): the best ``keep`` rows of each window of each query.

    ``queries``: (row, label, vec, part, windows); windows are (w, low, high) in hundredths of a score. ``same``: rows of the
    query's label other than itself, else rows of other labels.
    """
    spark = index.spark
    walk = spark.sparkContext.broadcast(index.walk)
    state = queries.withColumn("done", F.lit(0))
    hits = spark.createDataFrame([], f"{HIT}, rank int")
    limit = FIRST
    while True:
        known = hits.groupBy("row").agg(F.collect_list(F.struct("w", "score")).alias("hits"))
        asked = state.join(known, "row", "left").select("row", "label", "vec", "part", "windows", "done", "hits")
        asked, seen = stored_with(asked.mapInArrow(_asked(walk, index.dim, keep, limit), f"cell int, block int, part int, row bigint, label bigint, vec binary, windows {WINDOWS}, upto int"), "asked")
        if not seen["n"]:
            return hits
        tiles = index.packed.join(asked.select("cell", "block", F.col("part").alias("of")).distinct(), ["cell", "block"])
        found = asked.groupBy("cell", "block", "part").cogroup(tiles.groupBy("cell", "block", "of")).applyInArrow(_tile(index.dim, keep, same), HIT)
        hits = stored(_top(found.unionByName(hits.drop("rank")), keep), "hits")
        upto = asked.groupBy("row").agg(F.max("upto").alias("done"))
        state = stored(state.drop("done").join(upto, "row"), "state")
        limit *= GROWTH


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: int = 256, block_rows: int = ROWS, tile_queries: int = QUERIES, codes: int = CODES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exactly.

    For each row where ``anchor`` holds and each of its first ``positives`` rows of the same label: the first ``negatives`` rows of
    other labels with ``low * positive <= 100 * negative <= high * positive``.
    """
    spark: SparkSession = rows.sparkSession
    ship(spark)
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    read = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("embedding"))
    read = read.filter("label IS NOT NULL AND embedding IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    dims = read.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dims is None or not dims.dim:
        return spark.createDataFrame([], out)
    vectors, seen = stored_with(read.select("row", "id", "label", "anchor", "embedding").mapInArrow(_scaled(dims.dim, scale), VECTOR), "vectors", anchors=F.count_if("anchor"))
    if not seen["anchors"]:
        return spark.createDataFrame([], out)
    index = Index(vectors, seen["n"], dims.dim, block_rows, codes)
    tiles = -(-seen["anchors"] // tile_queries)
    asking = vectors.filter("anchor").select("row", "id", "label", "vec", F.pmod(F.xxhash64("row"), F.lit(tiles)).cast("int").alias("part"))

    def windows(*at: Column) -> Column:
        return F.struct(*[c.alias(n) for c, n in zip(at, ("w", "low", "high"))])

    every = F.array(windows(F.lit(0), F.lit(ANY[0]).cast("bigint"), F.lit(ANY[1]).cast("bigint")))
    best = search(index, asking.drop("id").withColumn("windows", every), positives, True)
    best = stored(best.select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("w")), "positives")
    each = best.filter("positive_score >= 0").groupBy("row").agg(F.collect_list(windows(F.col("w"), low * F.col("positive_score"), high * F.col("positive_score"))).alias("windows"))
    found = search(index, asking.drop("id").join(each, "row"), negatives, False)
    found = found.select("row", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = asking.select("row", F.col("id").alias("anchor_id")).join(best, "row").join(found, ["row", "w"])
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
