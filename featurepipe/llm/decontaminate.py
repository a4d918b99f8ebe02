"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts and items are normalised alike: A-Z become a-z, a word is a run of the bytes 0-9, a-z
and 0x80-0xFF (so letters beyond ASCII stay whole), all else separates. Every run of ``size``
words of an item is a window, an item of fewer words is one window. The automaton's symbols
are words: a window is a path of at most ``size`` nodes, a word that no item has leads to
the root. A text is scanned once, piece by piece with the automaton's state carried on,
so memory follows a piece and the matches, not the text; matches end at most ``size`` times
per word. Normalisation changes no byte's place, so the words that matches cover are
mapped back to code points of the original text.

The windows are broadcast, at most ``BLOCK`` (window, item) pairs at a time (and never fewer
than one window with its items): a larger benchmark is dealt by hash into several
blocks, each with an automaton and a pass of its own, whose findings are merged per row. Both ways
give the same rows. Documents are not shuffled while there is one block.

Null texts have no words and nothing is hit; null or repeated document ids keep their rows.
Null item texts have no windows; rows that share an item id are one item, and rows without an
id are one item called ``null``. Without windows nothing is hit; an empty table of
documents gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.store import ship, stored

SIZE = 10  # words of a window
BLOCK = 250_000  # (window, item) pairs of one automaton: about 100 MB in a worker
PIECE = 1 << 20  # bytes scanned at once
FOUND = "n_words bigint, items array<string>, runs array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"

SPACE = 0x20
NORMAL = np.full(256, SPACE, np.uint8)
NORMAL[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
NORMAL[0x41:0x5B] = range(0x61, 0x7B)
NORMAL = NORMAL.tobytes()


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def _item_windows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, *texts in zip(*(c.to_pylist() for c in b.columns)):
                seen = set()
                for t in texts:
                    w = normal_words(t)
                    seen.update(b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1)) if w)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(seen), pa.string()), pa.array([x.decode() for x in seen], pa.string())], ["item", "window"])
    return rows


def item_windows(items: DataFrame, id_col: str = "item_id", text_cols: Sequence[str] = ("text",), size: int = SIZE) -> DataFrame:
    """Distinct (item, window) of every text column, words joined by a space."""
    ship(items.sparkSession)
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), *[F.col(c).cast("string").alias(f"text{i}") for i, c in enumerate(text_cols)])
    return rows.mapInArrow(_item_windows(size), "item string, window string").distinct()


class Scanner:
    """The automaton over one block of windows, with the items of each."""

    def __init__(self, windows: list[str], items: list[list[str]]):
        import ahocorasick

        self.items, self.vocabulary, self.lengths = items, {}, []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE) if windows else None
        for k, w in enumerate(windows):
            path = tuple(self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w.encode().split(b" "))
            self.lengths.append(len(path))
            self.automaton.add_word(path, k)
        if windows:
            self.automaton.make_automaton()

    def scan(self, data: bytes) -> tuple[int, list[str], list[tuple[int, int, int, int]]]:
        """Words, items found, and runs of hit words: (first word, end word, first code point, end code point)."""
        plain = data.translate(NORMAL)
        number, n, at, state = self.vocabulary.get, 0, 0, None
        ends, which = [], []
        while at < len(plain):
            cut = plain.find(b" ", at + PIECE)
            cut = len(plain) if cut < 0 else cut
            path = tuple([number(w, 0) for w in plain[at:cut].split()])
            n, at = n + len(path), cut
            if self.automaton is None or not path:
                continue
            if state is None:
                state = self.automaton.iter(path)
            else:
                state.set(path, False)
            for end, k in state:
                ends.append(end + 1)
                which.append(k)
        if not ends:
            return n, [], []
        items = sorted({i for k in set(which) for i in self.items[k]})
        end = np.array(ends)
        first = end - np.array(self.lengths)[which]
        order = np.argsort(first, kind="stable")
        first, reach = first[order], np.maximum.accumulate(end[order])
        head = np.concatenate(([True], first[1:] > reach[:-1]))
        starts, stops = first[head], reach[np.append(np.flatnonzero(head)[1:] - 1, len(reach) - 1)]
        return n, items, list(zip(starts.tolist(), stops.tolist(), *_code_points(data, plain, starts, stops)))


def _code_points(data: bytes, plain: bytes, first: np.ndarray, last: np.ndarray) -> tuple[list[int], list[int]]:
    """Where words ``first`` begin and words before ``last`` end, in code points of the text."""
    inside = np.frombuffer(plain, np.uint8) != SPACE
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return tuple(np.searchsorted(lead, at).tolist() for at in (np.flatnonzero(edge == 1)[first], np.flatnonzero(edge == -1)[last - 1]))


_SCANNERS: OrderedDict[str, Scanner] = OrderedDict()  # of this worker process, the latest two blocks


def _scanner(block) -> Scanner:
    token, windows, items = block
    if token not in _SCANNERS:
        _SCANNERS[token] = Scanner(windows, items)
        while len(_SCANNERS) > 2:
            _SCANNERS.popitem(last=False)
    return _SCANNERS[token]


def _scan_rows(block):
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = _scanner(block.value)
        for b in batches:
            out = [s.scan(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column("text")]
            n, items, runs = zip(*out) if out else ((), (), ())
            runs = [[dict(zip(("first", "last", "start", "end"), r)) for r in x] for x in runs]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(n, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(runs, kind)], ["key", "n_words", "items", "runs"])
    return rows


def _merged(runs):
    """Column: sorted runs of several blocks, those that meet made one."""
    kind = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"

    def step(done, r):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], r["last"]).alias("last"), last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        meets = F.coalesce(last["last"] >= r["first"], F.lit(False))
        return F.when(meets, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.array_sort(runs), F.array().cast(kind), step)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_texts: Sequence[str] = ("text",), size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: (id, n_words, n_hit, items, spans).

    ``items``: ids of the items with a window in the text, sorted as strings. ``spans``: maximal runs of hit
    words, (first, last) in words and (start, end) in code points of the text, ends exclusive.
    """
    spark = docs.sparkSession
    ship(spark)
    windows = stored(item_windows(items, item_id, item_texts, size), "windows")
    blocks = max(1, -(-windows.count() // block))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if blocks > 1:
        rows = stored(rows.withColumn("key", F.monotonically_increasing_id()), "keyed")
    else:
        rows = rows.withColumn("key", F.col("id"))
    found = None
    for k in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).groupBy("window").agg(F.collect_list("item").alias("items")).toArrow()
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, part["window"].to_pylist(), part["items"].to_pylist()))
        one = rows.select("key", "text").mapInArrow(_scan_rows(sent), f"key {rows.schema['key'].dataType.simpleString()}, {FOUND}")
        if blocks > 1:  # one block at a time is on the driver
            one = stored(one, "found")
            sent.destroy()
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        found = found.groupBy("key").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), _merged(F.flatten(F.collect_list("runs"))).alias("runs"))
        found = found.join(rows.select("key", "id"), "key").drop("key")
    else:
        found = found.withColumnRenamed("key", "id")
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["last"] - r["first"])
    return found.select("id", "n_words", n_hit.alias("n_hit"), "items", F.col("runs").alias("spans"))
