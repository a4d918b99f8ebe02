"""Tokenizer alignment, decontamination and hard negatives against brute force on small frames."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurepipe.llm import align, decontaminate, hard_negatives
from featurepipe.llm.queries import REGISTRY
from featurepipe.llm.token_orc import vocabulary_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, id string, key string, n_a int, spans string, items string, row int"


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "x", 1, "x", "x", 1) for i, t in zip(ids, texts)], SCHEMA)


def odd_texts():
    r = np.random.default_rng(1)
    mixed = list("abcXYZ  \n\t019'.,;é ß\xa0 世界<|>s🙂\x00\x1c\x85ﬁ½²ſĲ")
    plain = list("abc   \n\t01'.,é")
    texts = ["".join(r.choice(mixed if i % 2 else plain, r.integers(0, 150)).tolist()) for i in range(120)]
    long = " ".join("w" + str(x) for x in r.integers(0, 5000, 60_000))
    return [*texts, None, "", " ", "  ", "\n", "x ", " x", "a\n \nb", "▁x", "<s> </s> <unk> <|endoftext|>", "<0x41>", "x" * 3000, long, long, texts[3], texts[3]]


# ------------------------------------------------------------ alignment


@pytest.fixture(scope="module")
def pair():
    return align.tokenizer(vocabulary_path(align.A)), align.tokenizer(vocabulary_path(align.B))


def brute_alignment(texts, a, b):
    rows, count = [], Counter()
    for t in texts:
        ids = ([], [])
        if t:
            ids = a.library.encode(" " + t, add_special_tokens=False).ids, b.model.encode(t)
            if any(b"".join(x.spelled[i] for i in y) != (" " + t).encode() for x, y in zip((a, b), ids)):
                ids = ([], [])
        ends = [np.cumsum([len(x.spelled[i]) for i in y]).tolist() for x, y in zip((a, b), ids)]
        links = [(ids[0][ends[0].index(e)], ids[1][ends[1].index(e)]) for e in sorted(set(ends[0]) & set(ends[1]))]
        groups, p, q = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, ids[0][p:x])) + "|" + ",".join(map(str, ids[1][q:y])))
            p, q = x, y
        count.update(links)
        rows.append((len(ids[0]), len(ids[1]), links, groups))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(na, nb, len(g), len(k), sum(count[x] == best[x[1]] for x in k), sum(count[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for na, nb, k, g in rows]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_matches_brute_force(spark, pair, monkeypatch):
    texts = [t for t in odd_texts() if t is None or len(t) < 5000]
    docs = frame(spark, texts, [None if i % 13 == 0 else i for i in range(len(texts))]).repartition(3)
    got = [tuple(r[c] for c in NAMES) for r in align.align(docs).collect()]
    assert sorted(got) == sorted(brute_alignment(texts, *pair))
    assert sum(r[0] == 0 for r in got) < len(texts) / 3


def test_long_texts_are_aligned_in_parts_like_whole_ones(spark, pair):
    long = [t for t in odd_texts() if t and len(t) > 100_000][:1]
    assert len(long[0]) > align.PART
    (got,) = align.align(frame(spark, long)).collect()
    a, b = pair
    ia, ib = a.library.encode(" " + long[0], add_special_tokens=False).ids, b.model.encode(long[0])
    ends = [np.cumsum([len(x.spelled[i]) for i in y]) for x, y in zip(pair, (ia, ib))]
    assert (got.n_a, got.n_b, got.n_groups) == (len(ia), len(ib), len(np.intersect1d(*ends)))


def test_galloping_ranks_equal_searchsorted():
    r = np.random.default_rng(0)
    for n, m in ((1, 1), (1, 500), (20, 500), (300, 300), (0, 5), (5, 0)):
        for _ in range(20):
            a, b = np.sort(r.choice(2000, n, False)), np.sort(r.choice(2000, m, False))
            assert align.ends_in(a.tolist(), b.tolist()) == np.searchsorted(b, a).tolist()


def test_groups_and_overlap_ranges(spark, pair):
    texts = ["Tokenization isn't uniform, naïvely.", None, "▁x", "abc 12345 é\n\nx"]
    rows = align.aligned_groups(frame(spark, texts)).collect()
    assert {r.id for r in rows} == {0, 3}
    for i in (0, 3):
        mine = sorted((r for r in rows if r.id == i), key=lambda r: r.group)
        assert [r.start for r in mine] == [0] + [r.end for r in mine][:-1] and mine[-1].end == len((" " + texts[i]).encode())
        for r in mine:
            sides = dict(zip("ab", ([pair[0].spelled[x] for x in r.a_ids], [pair[1].spelled[x] for x in r.b_ids])))
            assert b"".join(sides["a"]) == b"".join(sides["b"]) == (" " + texts[i]).encode()[r.start : r.end]
            short, long = sides[r.shorter], sides["b" if r.shorter == "a" else "a"]
            cut = [np.concatenate(([0], np.cumsum([len(x) for x in s]))) for s in (short, long)]
            want = [[k for k in range(len(long)) if cut[1][k] < cut[0][j + 1] and cut[1][k + 1] > cut[0][j]] for j in range(len(short))]
            assert [list(range(o["first"], o["last"])) for o in r.overlaps] == want


def test_alignment_of_an_empty_table(spark):
    assert align.align(frame(spark, [])).collect() == [] and align.aligned_groups(frame(spark, [])).collect() == []


# ------------------------------------------------------------ decontamination


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_hits(text, items, size=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        for s in range(max(1, len(x) - size + 1)) if x else ():
            k = x[s : s + size]
            for at in range(len(w) - len(k) + 1):
                if w[at : at + len(k)] == k:
                    hit.update(range(at, at + len(k)))
                    found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog while seven wizards watch quietly"), (2, "short item"), (10, "Short, ITEM!"), (3, None), (4, ""), (5, "  ...  "),
         (None, "nobody owns this"), (6, "été à la plage, où l'eau est bleue et le sable est chaud en août"), (7, "rep rep rep rep rep rep rep rep rep rep rep rep"), (1, "second text of one")]


def hit_texts():
    q = ITEMS[0][1]
    return [q, q.upper().replace(" ", "\n--\n"), "before " + q + " after", " ".join(q.split()[:9]), " ".join(q.split()[2:12]) + " x", "a short item here, short, item.", None, "", "...", "nobody owns this second text of one",
            "xx " + ITEMS[7][1].upper() + " é", ITEMS[7][1], "rep " * 30, "rep " * 9, "shortitem", "short é item", ("filler words go here " * 3000) + q + " filler", q, "\x00short\x1fitem"]


@pytest.mark.parametrize("block", [250_000, 3])
def test_decontamination_matches_brute_force(spark, block):
    texts = hit_texts()
    docs = frame(spark, texts, [None if i == 3 else min(i, 12) for i in range(len(texts))]).repartition(3)
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id bigint, text string, window string")
    got = decontaminate.decontaminate(docs, items, block=block).collect()
    assert sorted((r.n_words, r.n_hit, list(r.items)) for r in got) == sorted(brute_hits(t, ITEMS) for t in texts)
    for r in got:
        assert r.n_hit == sum(s.last - s.first for s in r.spans)
    # spans give the code points of the text that the words came from
    first = [r for r in got if r.id == 2][0]
    assert texts[2][first.spans[0].start : first.spans[0].end] == ITEMS[0][1]
    french = [r for r in got if r.id == 11][0]
    assert texts[11][french.spans[0].start : french.spans[0].end] == ITEMS[7][1]


def test_scanning_in_pieces_keeps_the_automaton_state(spark, monkeypatch):
    text = ("some words " * 40) + ITEMS[0][1] + (" more words" * 40)
    scanner = decontaminate.Scanner([" ".join(words(ITEMS[0][1])[i : i + 10]) for i in range(4)], [["1"]] * 4)
    whole = scanner.scan(text.encode())
    for piece in (1, 7, 50):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        assert scanner.scan(text.encode()) == whole and whole[1] == ["1"]


def test_decontamination_of_empty_tables(spark):
    docs, items = frame(spark, ["some text", None]), spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r.n_hit, r["items"], r.spans) for r in decontaminate.decontaminate(docs, items).collect()] == [(2, 0, [], []), (0, 0, [], [])]
    assert decontaminate.decontaminate(frame(spark, []), items).collect() == []


def test_questions_and_answers_belong_to_one_item(spark):
    items = spark.createDataFrame([("q", "what is the answer", "forty two")], "item string, question string, answer string")
    (r,) = decontaminate.decontaminate(frame(spark, ["it is forty two of course"]), items, item_id="item", item_texts=("question", "answer")).collect()
    assert r["items"] == ["q"] and r.n_hit == 2


# ------------------------------------------------------------ hard negatives


def brute_negatives(rows, dim, anchor, positives=5, negatives=3):
    v = [(k, i, lab, [math.floor(256.0 * float(np.float32(x))) for x in e]) for k, (i, e, lab) in enumerate(rows)
         if lab is not None and e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for k, i, lab, e in v:
        if i is None or not anchor(i):
            continue
        s = [(sum(x * y for x, y in zip(e, f)), j, m) for p, j, m, f in v if p != k]
        for ps, j, _ in sorted((x for x in s if x[2] == lab), key=lambda x: order(x[0], x[1]))[:positives]:
            near = sorted((x for x in s if x[2] != lab and 50 * ps <= 100 * x[0] <= 95 * ps), key=lambda x: order(x[0], x[1]))[:negatives]
            out += [(i, j, r, n, ps, ns) for r, (ns, n, _) in enumerate(near, 1)]
    return sorted(out, key=str)


def vectors(n=400, dim=6, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dim))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 4] + 0.4 * r.normal(size=dim)], int(i % 3)) for i in range(n)]
    hot = [(1000 + i, [0.5] * dim, i % 2) for i in range(120)]  # one vector many times: ties of scores
    odd = [(5, None, 1), (10, [1.0] * dim, None), (15, [float("nan")] * dim, 0), (20, [1.0, None] + [0.0] * (dim - 2), 0), (25, [float("inf")] + [0.0] * (dim - 1), 0), (30, [1.0], 0), (35, [], 0),
           (None, [0.9] * dim, 0), (None, [0.4] * dim, 1), (40, [0.0] * dim, 1), (40, [0.0] * dim, 1), (50, [-1.0] * dim, 2), (50, [0.7] * dim, 2), (55, [1e30] * dim, 1)]
    return rows + hot + odd


def test_hard_negatives_match_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(*x, "c", 0) for x in rows], "vec_id bigint, embedding array<float>, label int, row string, vec int").repartition(5)
    want = brute_negatives([x for x in rows if x[1] != [1e30] * 6], 6, lambda i: i % 5 == 0)
    for options in ({}, {"block_rows": 16, "tile_queries": 7, "codes": 4}, {"codes": 1}):
        got = hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **options)
        assert sorted((tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str) == want
    assert len(want) > 300


def test_walk_bounds_hold_and_stop_early():
    r = np.random.default_rng(4)
    x = np.round(100 * r.normal(size=(600, 8))) + 1000 * np.eye(8)[r.integers(0, 8, 600)]
    books = hard_negatives._k_means(x[:, :4], 6), hard_negatives._k_means(x[:, 4:], 6)
    i, j = hard_negatives._nearest(x[:, :4], books[0]), hard_negatives._nearest(x[:, 4:], books[1])
    size = len(books[0]) * len(books[1])
    cell, r1, r2 = i * len(books[1]) + j, np.zeros(size), np.zeros(size)
    np.maximum.at(r1, cell, np.linalg.norm(x[:, :4] - books[0][i], axis=1))
    np.maximum.at(r2, cell, np.linalg.norm(x[:, 4:] - books[1][j], axis=1))
    walk = books, r1, r2, np.bincount(cell, minlength=size)
    asked = 0
    for q in x[:40]:
        scores, w = x @ q, hard_negatives.Walk(walk, q)
        steps = list(w)
        bounds = [b for _, b in steps]
        assert sorted(c for c, _ in steps) == list(range(size)) and bounds == sorted(bounds, reverse=True)
        for at, (c, bound) in enumerate(steps):
            low, high = w.span(c)
            inside = scores[cell == c]
            assert all(low - 0.01 <= s <= high + 0.01 for s in inside)
            assert all(s <= bound + 0.01 for c2, _ in steps[at:] for s in scores[cell == c2])
        fifth = float(np.sort(scores)[-6])
        cells, _ = hard_negatives.wanted_cells(walk, q, [(fifth, 1e18)], 0, size)
        assert set(cell[scores >= fifth]) <= set(cells)
        asked += len(cells)
    assert asked < 40 * len(set(cell)) / 2  # certified windows leave most cells alone


def test_hard_negatives_of_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives.mine(empty, F.col("vec_id") % 5 == 0).collect() == []
    none = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [], 1), (5, None, 2)], empty.schema)
    assert hard_negatives.mine(none, F.col("vec_id") % 5 == 0).collect() == []


@pytest.mark.parametrize("key", ["op12_benchmark_decontamination", "op13_hard_negatives"])
def test_query_matches_its_sql(spark, key):
    import duckdb

    from featurepipe.llm.queries import SQL

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = REGISTRY[key](spark, SF).toPandas(), con.execute(SQL[key]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].astype(str).to_numpy().tolist())) == sorted(map(tuple, want[cols].astype(str).to_numpy().tolist()))


def test_alignment_query_is_one_row_per_document(spark):
    out = REGISTRY["op11_tokenizer_alignment"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.count() == docs.count() and out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    a, b = (align.tokenizer(vocabulary_path(x)) for x in (align.A, align.B))
    got = [tuple(r[c] for c in NAMES) for r in out.orderBy("doc_id").collect()]
    assert got == brute_alignment(texts, a, b)
