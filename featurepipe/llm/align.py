"""Alignment of two tokenizers over whole texts, and how often token ids are linked corpus-wide.

Both tokenizers spell the same bytes, so each token has the byte offset where it ends. A
galloping intersection finds the offsets where tokens of both end: the shorter list of ends
drives an exponential and then a binary search into the longer one, each from
where the last one stopped. The common ends slice both lists into groups; the ranks that
the search leaves behind give, by their differences, the range of longer-list tokens that
overlap each token of the shorter one.

Two tokens are linked where they end together. The bytes of one are then a suffix of the other's, so
the vocabularies bound the number of linked id pairs whatever the corpus: at most two for
every byte of an entry (about a million for vocabularies of 50,000 and 32,000). Pair counts are
summed in each task, then over tasks, and the sums are small enough to be sent to every
task for the second pass, which looks each document's pairs up. Texts are read
and encoded once; documents are never shuffled.

Texts are encoded with a space in front. Strings of special tokens are plain text. Long texts are
encoded and aligned in parts that begin at a space between two ASCII letters: neither tokenizer
merges over it, so both have an end there, and memory follows a part. Nor do they merge over
any single space between words; the words of texts of plain characters are looked up in a bounded
cache, and the libraries encode the words that it lacks, and all other texts.

A text that is null, empty or not spelled exactly by both tokenizers has no tokens: counts
of 0 and an empty digest. Null or repeated ids keep their rows, each counted; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from featurepipe.llm.store import ship, stored
from featurepipe.llm.token_orc import vocabulary_path
from featurepipe.llm.tokens import LETTERS

A = "byte_bpe_50k.json"
B = "piece_bpe_32k.model"
PART = 1 << 18  # characters of a text encoded at once
CACHE_BYTES = 96 << 20  # of words with their ids, about
GROUP = 1 << 20  # characters whose new words are encoded together
HELD = 1 << 20  # pair occurrences held before they are summed

OTHER = re.compile(r"[^\x00-\x1b\x20-\x7e¡-ſ‐-‧€]|[\t-\r] [\t-\r]")  # beyond characters that every version of Unicode classes alike
BREAK = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def parts(text: str, limit: int = PART) -> Iterator[str]:
    """The text, which begins with a space, in parts that do too."""
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + limit)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class ByteLevel:
    """Byte-level BPE of the tokenizers library."""

    cuts = True

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        back = {v: bytes([k]) for k, v in LETTERS.items()}
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = b"".join(back.get(c, c.encode()) for c in token)

    def encode(self, text: str) -> list[int]:
        """Ids of a text that begins with a space."""
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Sentence pieces; the model writes the space in front itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.cuts = not any("▁" in p.lstrip("▁") for p in names)  # no piece has a space after another character

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text[1:], num_threads=1)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """One tokenizer per worker process."""
    t = Pieces(path) if path.endswith(".model") else ByteLevel(path)
    t.lengths = np.array([len(x) for x in t.spelled], np.int64)
    return t


Ids = tuple[np.ndarray, np.ndarray]


class Both:
    """Ids of texts by both tokenizers."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.known: dict[str, tuple[bytes, bytes] | None] = {}  # of words with the space before them; None: not spelled
        self.room = CACHE_BYTES
        self.step = max(len(a.spelled), len(b.spelled))
        self.names = [f"{c}{i}" for c in ",;|" for i in range(self.step)]  # as a further id, the first of A in a group, the first of B

    def parts(self, text: str) -> Iterator[str]:
        return parts(" " + text) if self.a.cuts and self.b.cuts else iter([" " + text])

    def whole(self, text: str) -> Ids | None:
        """Ids of a text that begins with a space, by the libraries."""
        ids = tuple(t.encode(text) for t in (self.a, self.b))
        if any(b"".join(map(t.spelled.__getitem__, i)) != text.encode() for t, i in zip((self.a, self.b), ids)):
            return None
        return tuple(np.array(i, np.int64) for i in ids)

    def _learn(self, words: list[str]) -> None:
        """Ids of new words, in few calls of the libraries: the ids of a run of words, cut where words end."""
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            ids = self.whole(" " + " ".join(some))
            if ids is None:
                for w in some:
                    one = self.whole(" " + w)
                    self.known[w] = one and tuple(x.astype("<i4").tobytes() for x in one)
                continue
            ends = np.cumsum([len(w.encode()) + 1 for w in some])
            raw = [x.astype("<i4").tobytes() for x in ids]
            cut = [[0, *(4 * np.searchsorted(np.cumsum(t.lengths[x]), ends, side="right")).tolist()] for t, x in zip((self.a, self.b), ids)]
            for i, w in enumerate(some):
                self.known[w] = raw[0][cut[0][i] : cut[0][i + 1]], raw[1][cut[1][i] : cut[1][i + 1]]

    def encode(self, some: list[str]) -> list[Ids | None]:
        """Ids of each part; None where a tokenizer does not spell it."""
        plain = [self.a.cuts and self.b.cuts and "  " not in p and p[-1] != " " and not OTHER.search(p) for p in some]
        words = [p[1:].split(" ") if ok else [] for p, ok in zip(some, plain)]
        new = list({w for ws in words for w in ws if w not in self.known})
        self._learn(new)
        out = []
        for p, ok, ws in zip(some, plain, words):
            if ok:
                ids = list(map(self.known.__getitem__, ws))
                out.append(None if None in ids else tuple(np.frombuffer(b"".join([x[i] for x in ids]), "<i4").astype(np.int64) for i in (0, 1)))
            else:
                out.append(self.whole(p))
        for w in new:  # the first words stay, within the bound
            size = 300 + 5 * len(w)
            if self.room >= size and len(w) <= 64:
                self.room -= size
            else:
                del self.known[w]
        return out

    def groups(self, ids: Ids, ends: Ids) -> str:
        """``;a1,a2|b1;a3|b2,b3``: the ids of each group that the common ends cut."""
        size = [len(x) for x in ids]
        starts = [np.concatenate(([0], e[:-1] + 1)) for e in ends]
        of = [np.repeat(np.arange(len(s)), np.diff(s, append=n)) for s, n in zip(starts, size)]
        out = np.empty(sum(size), np.int64)
        at_a, at_b = np.arange(size[0]) + starts[1][of[0]], np.arange(size[1]) + (ends[0] + 1)[of[1]]
        out[at_a], out[at_b] = ids
        out[at_a[starts[0]]] += self.step
        out[at_b[starts[1]]] += 2 * self.step
        return "".join(map(self.names.__getitem__, out.tolist()))


@lru_cache(maxsize=2)
def both(first: str, second: str) -> Both:
    return Both(tokenizer(vocabulary_path(first)), tokenizer(vocabulary_path(second)))


def ends_in(shorter: list[int], longer: list[int]) -> list[int]:
    """For each of the ascending ``shorter``: how many of the ascending ``longer`` are below it."""
    ranks, at, n = [], 0, len(longer)
    longer = [*longer, 1 << 62]
    add = ranks.append
    for x in shorter:
        if longer[at] < x:
            at += 1
            if longer[at] < x:
                low, step = at, 1
                while low + step < n and longer[low + step] < x:
                    low += step
                    step += step
                at = bisect_left(longer, x, low + 1, min(low + step, n))
        add(at)
    return ranks


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indexes of the tokens of A and of B that end together, and each shorter-list token's rank in the longer list."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    ranks = np.array(ends_in(short.tolist(), long.tolist()), np.int64)
    hit = np.flatnonzero(np.append(long, -1)[ranks] == short)
    return (hit, ranks[hit], ranks) if short is a else (ranks[hit], hit, ranks)


def overlaps(ranks: np.ndarray, shorter: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) index in the longer list of the tokens whose bytes overlap each token of the shorter list."""
    last = np.minimum(ranks + 1, len(longer))
    meets = np.append(longer, -1)[ranks] == shorter
    first = np.concatenate(([0], (ranks + meets)[:-1]))
    return first, last


def _aligned_parts(texts: list[str | None], t: Both) -> Iterator[tuple[int, Ids | None, Ids, Ids, np.ndarray]]:
    """(place of the text, ids or None, byte ends, indexes of common ends, ranks) per part, in order; new words are encoded in groups."""
    held, size = [], 0

    def done():
        for (i, _), ids in zip(held, t.encode([p for _, p in held])):
            if ids is None:
                yield i, None, (), (), None
            else:
                ends = np.cumsum(t.a.lengths[ids[0]]), np.cumsum(t.b.lengths[ids[1]])
                ia, ib, ranks = common_ends(*ends)
                yield i, ids, ends, (ia, ib), ranks

    for i, text in enumerate(texts):
        for p in t.parts(text) if text else ():
            held.append((i, p))
            size += len(p)
            if size >= GROUP:
                yield from done()
                held, size = [], 0
    yield from done()


def _sums(codes: list, n: list) -> tuple[np.ndarray, np.ndarray]:
    codes, n = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (codes, n))
    u, at = np.unique(codes, return_inverse=True)
    return u, np.bincount(at, weights=n, minlength=len(u)).astype(np.int64)


class _Digest:
    """What one text's parts add up to."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = 0
        self.sha, self.pairs, self.times = hashlib.sha256(), [], []
        self.spelled = True

    def add(self, t: Both, ids: Ids | None, at: Ids) -> None:
        self.spelled = self.spelled and ids is not None
        if not self.spelled:
            return
        text = t.groups(ids, at)
        self.sha.update((text if self.n_a else text[1:]).encode())
        self.n_a, self.n_b, self.n_groups = self.n_a + len(ids[0]), self.n_b + len(ids[1]), self.n_groups + len(at[0])
        u, n = np.unique(ids[0][at[0]] * len(t.b.spelled) + ids[1][at[1]], return_counts=True)
        self.pairs.append(u)
        self.times.append(n)

    def row(self) -> tuple:
        if not self.spelled or not self.n_a:
            return 0, 0, 0, "", *_sums([], [])
        pairs = (self.pairs[0], self.times[0]) if len(self.pairs) == 1 else _sums(self.pairs, self.times)
        return self.n_a, self.n_b, self.n_groups, self.sha.hexdigest(), *pairs


def _lists(values) -> pa.Array:
    off = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(values)))


def _aligned_rows(first: str, second: str):
    """A row per text with its distinct linked pairs; then, per task, rows (pair, n) of all its links."""
    names = ["id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times", "pair", "n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = both(first, second)
        codes, times, held = [], [], 0
        for whole in batches:
            for start in range(0, len(whole), 256):
                batch = whole.slice(start, 256)
                texts = [_Digest() for _ in range(len(batch))]
                for i, ids, _, at, _ in _aligned_parts(batch.column("text").to_pylist(), t):
                    texts[i].add(t, ids, at)
                n_a, n_b, n_groups, sha, pairs, n = zip(*(x.row() for x in texts))
                codes += pairs
                times += n
                held += sum(map(len, pairs))
                if held >= HELD:
                    codes, times = ([y] for y in _sums(codes, times))
                    held = 0
                none = pa.nulls(len(batch), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(y, pa.int64()) for y in (n_a, n_b, n_groups)), pa.array(sha, pa.string()), _lists(pairs), _lists(n), none, none], names)
        u, n = _sums(codes, times)
        for at in range(0, len(u), 1 << 16):
            k = len(u[at : at + (1 << 16)])
            gone = [pa.nulls(k, pa.int64())] * 4 + [pa.nulls(k, pa.string())] + [pa.nulls(k, pa.list_(pa.int64()))] * 2
            yield pa.RecordBatch.from_arrays([*gone, pa.array(u[at : at + k]), pa.array(n[at : at + k])], names)
    return rows


def _looked_up(table):
    """Adds ``n_best`` and ``count_sum`` from the (sorted pairs, counts, whether best of their B id) sent."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        for b in batches:
            found, times = b.column("pairs"), b.column("times").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(pairs, found.flatten().to_numpy())
            of = np.repeat(np.arange(len(b)), found.value_lengths().to_numpy())
            n_best, total = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            np.add.at(n_best, of, times * best[at])
            np.add.at(total, of, times * counts[at])
            kept = ["id", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(n_best), pa.array(total)], [*kept, "n_best", "count_sum"])
    return rows


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))


def _links(aligned: DataFrame, second: str = B) -> DataFrame:
    """(a_id, b_id, n, best): linked id pairs with their counts over all texts, and whether no other pair of ``b_id`` has more."""
    size = len(tokenizer(vocabulary_path(second)).spelled)
    n = aligned.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    n = n.select(F.expr(f"pair div {size}").alias("a_id"), F.pmod("pair", F.lit(size)).alias("b_id"), "n", "pair")
    return n.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str = A, second: str = B) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of ``docs``."""
    spark = docs.sparkSession
    schema = "id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>, pair bigint, n bigint"
    aligned = stored(_read(docs, id_col, text_col).mapInArrow(_aligned_rows(first, second), schema), "aligned", compression="zstd")
    # bounded by the vocabularies: one of a pair's spellings ends the other
    table = _links(aligned, second).select("pair", "n", "best").toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    rows = aligned.filter("pair IS NULL").mapInArrow(_looked_up(sent), "id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_best bigint, count_sum bigint")
    return rows.withColumn("n_links", F.col("n_groups"))


def aligned_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str = A, second: str = B) -> DataFrame:
    """The alignment itself: (id, part, group, a_ids, b_ids, start, end) per group, bytes of the part.

    ``overlaps``: for each token of the tokenizer with fewer tokens in the part (``shorter``: a or b), the range
    [first, last) of the other's tokens, by place in the group, whose bytes it overlaps. Parts are
    numbered along the text; a text that a tokenizer does not spell has none.
    """
    names = ["id", "part", "group", "a_ids", "b_ids", "start", "end", "shorter", "overlaps"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))]

    def groups(ids, ends, at, ranks):
        short = 0 if len(ids[0]) <= len(ids[1]) else 1
        low, high = overlaps(ranks, ends[short], ends[1 - short])
        p, q, start = 0, 0, 0
        for g, (e, f) in enumerate(zip((at[0] + 1).tolist(), (at[1] + 1).tolist())):
            (s, z), base = ((p, e), q) if short == 0 else ((q, f), p)
            over = [{"first": int(low[k]) - base, "last": int(high[k]) - base} for k in range(s, z)]
            end = int(ends[0][e - 1])
            yield g, ids[0][p:e].tolist(), ids[1][q:f].tolist(), start, end, "ab"[short], over
            p, q, start = e, f, end

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = both(first, second)
        for batch in batches:
            keys = batch.column("id").to_pylist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = list(_aligned_parts([text], t))
                if all(ids is not None for _, ids, *_ in found):
                    out = [(keys[i], k, *g) for k, (_, *x) in enumerate(found) for g in groups(*x)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * len(kinds), kinds)], names)

    return _read(docs, id_col, text_col).mapInArrow(rows, "id bigint, part bigint, `group` bigint, a_ids array<bigint>, b_ids array<bigint>, start bigint, end bigint, shorter string, overlaps array<struct<first:bigint,last:bigint>>")
