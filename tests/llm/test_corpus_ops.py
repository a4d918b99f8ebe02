"""Corpus operators against brute force on small frames: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featurepipe.llm import imatch, jaccard_join, mixing, packing, quality_rules, secret_scan, token_orc, toxicity, url_filter, warc
from featurepipe.llm.components import components
from featurepipe.llm.queries import REGISTRY
from featurepipe.llm.store import new_path
from featurepipe.llm.tokens import encoder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, t string, n int, size string"
SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(n, seed=0):
    r = np.random.default_rng(seed)
    return ["w" + str(x) for x in r.integers(0, 10**6, n)]


def odd_texts():
    base = words(120, 1)
    near = base[:60] + ["edit"] + base[61:]
    far = base[:60] + words(60, 2)
    return [
        " ".join(base), " ".join(base).upper(), " ".join(near), " ".join(far), None, "", "   \n\t", "one", "one two three", "One  two\nthree",
        " ".join(words(30_000, 3)), "é à ü ß İ Σς " * 30, "x" * 50_000, "token=abcdef123 AKIA" + "A" * 20 + " " + "a1" * 15, "line\nline\n\nline", "pass the the the the",
    ]


def frame(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    rows = [(i, t, "en" if i is None or i % 2 else None, "s" + str(k % 3) if k % 4 else None, 0, "clash", "clash", 1, "clash") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    texts = odd_texts()
    return frame(spark, texts + [texts[0], texts[0], None], [*range(len(texts)), 0, 99, None]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k=4):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows):
    """{id: smallest id reachable}; rows of one id are one vertex."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, x), (b, y) in combinations([s for s in sets if s[1]], 2):
        if 100 * len(x & y) >= 85 * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: find(i) for i in root}


def check_components(rows, out):
    want = brute_components(rows)
    got = [(r.id, r.n_shingles, r.component) for r in out.collect()]
    expected = [(i, len(shingles(t)), want.get(i)) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_join_on_odd_texts(odd, empty):
    check_components([(r.doc_id, r.text) for r in odd.collect()], jaccard_join.link_components(odd))
    assert jaccard_join.link_components(empty).collect() == []


def test_join_on_families_that_recurse(spark, monkeypatch):
    """Copies with ever more edits: regions larger than a leaf, several components each, chains."""
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    r = np.random.default_rng(5)
    base, texts = words(80, 7), []
    for k in range(60):
        w = list(base)
        for p in r.integers(0, 80, int(r.integers(0, 6))):
            w[p] = f"e{k}_{p}" if k % 3 else "same"
        texts.append(" ".join(w[: 80 - k % 5]))
    texts += [" ".join(base[:40] + words(40, 100 + k)) for k in range(20)]
    check_components(list(enumerate(texts)), jaccard_join.link_components(frame(spark, texts)))


def test_join_on_ids_with_several_versions(spark):
    """An id carries a text and an excerpt of it; a near copy of the excerpt is under another id. Some ids chain two texts."""
    rows = []
    for k in range(16):
        whole = words(203, 500 + k)
        part = whole[:53]
        rows += [(100 * k + 7, " ".join(whole)), (100 * k + 7, " ".join(part)), (100 * k + 3 + 9 * (k % 2), " ".join(part[:-1] + ["edit"]))]
        if k % 4 == 0:  # the id also joins the next family's near copy to this one
            rows += [(100 * k + 7, " ".join(words(203, 501 + k)[:53])), (100 * k + 7, None), (100 * k + 7, " ".join(part)), (None, " ".join(part))]
    check_components(rows, jaccard_join.link_components(frame(spark, [t for _, t in rows], [i for i, _ in rows])))


def test_components(spark):
    e = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (20, 21), (7, 7), (None, 1), (21, 20), (9, 5)], "a bigint, b bigint")
    assert {r.id: r.component for r in components(e, "a", "b").collect()} == {3: 3, 4: 3, 5: 3, 9: 3, 20: 20, 21: 20}
    assert components(e.limit(0), "a", "b").collect() == []


def test_quality_base_counts(odd, empty):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(odd).collect()), key=str)
    want = []
    for row in odd.collect():
        t = row.text or ""
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        cover = {i + d for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((row.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    assert got == sorted(want, key=str)
    assert quality_rules.judge(empty).collect() == []


def test_quality_rejects_an_outlier_and_keeps_its_group(spark):
    texts = [" ".join(words(200 + k, k)) + "." for k in range(150)] + [" ".join(w + "###" for w in words(200, 999))]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame(spark, texts)).collect()}
    assert not kept[150] and all(kept[i] for i in range(150))


def test_toxicity(spark, odd, empty):
    r = np.random.default_rng(3)
    texts, labels = [], []
    for k in range(900):
        w = words(60, k)
        if k % 4 == 0:
            w[int(r.integers(0, 60))] = f"insult{k % 3}"
            w[int(r.integers(0, 60))] = "Insult0!"
        texts.append(" ".join(w))
        labels.append((k, 0, int(k % 4 == 0)))
    docs, known = frame(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = toxicity.score(docs, known).collect()
    held = [x for x in rows if x.held_out]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in rows)
    assert sum(x.predicted == int(x.doc_id % 4 == 0) for x in held) >= 0.95 * len(held) > 100
    assert toxicity.score(odd, known.limit(0)).count() == odd.count()
    assert toxicity.score(empty, known).collect() == []


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.A.net/x.html?utm_s=1#f", "https://a.net/x/", "http://a.net/x?b=2&a=1", "http://sub.Example.org/es/1", "http://org/x", "http://a.org", "ftp://x.com/fr/", "http://x.com/de/y?z", "http://a.net:80/x"]
    pages = spark.createDataFrame([(i, u, "c", "d") for i, u in enumerate(urls)] + [(4, "https://a.net/x/", "c", "d")], "page_id bigint, url string, canonical string, words string")
    got = {r.page: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.repeated_urls(pages)).collect()}
    assert got[0] == got[2] == ("", "", None, "allow")
    assert got[3] == ("www.a.net", "/x.html", None, "allow") and got[4][3] == "block" and got[11][3] == "block" and got[5][3] == "allow"
    assert got[6] == ("sub.example.org", "/es/1", "example.org/es/", "block") and got[7][2] == "org/" and got[8][2] is None
    assert got[9][3] == "allow" and got[10][3] == "block"
    # a saturated filter only sends more rows to the exact join
    again = url_filter.filter_urls(pages, url_filter.repeated_urls(pages), blocks=1)
    assert {r.page: r.verdict for r in again.collect()} == {k: v[3] for k, v in got.items()}
    assert url_filter.filter_urls(pages.limit(0), url_filter.repeated_urls(pages)).collect() == []


ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    s = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    s += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(s + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_secrets_ledger(spark, odd, empty):
    extra = ["é😀 Secret = token:abcdefgh", "secret=token:abcdefgh password='x' API_KEY: " + "f" * 40, "toKen=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "AKIA" * 6 + " AKIAshort"]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(200 + i, t) for i, t in enumerate(extra)], "doc_id bigint, text string"))
    path = new_path(spark, "ledger")
    secret_scan.update_ledger(docs.filter("doc_id < 100"), path)
    n = secret_scan.read_ledger(spark, path).count()
    secret_scan.update_ledger(docs, path)
    secret_scan.update_ledger(docs, path)
    ledger = secret_scan.read_ledger(spark, path)
    texts = {r.text or "" for r in docs.collect()}
    assert ledger.count() == ledger.select("blob").distinct().count() == len(texts) > n
    secret_scan.update_ledger(docs, path, rule_version="other")
    assert secret_scan.read_ledger(spark, path).count() == 2 * len(texts)
    rows = secret_scan.findings(docs, path).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert [(s["start"], s["rank"], s["kind"], s["end"]) for s in r.spans if s["rank"] < 3] == base_spans(r.text or "")
    out = secret_scan.findings(docs, path).select("text", "spans", secret_scan.masked(F.col("text"), F.col("spans")).alias("m")).collect()
    for r in out:
        at, want = 0, ""
        if r.spans:
            merged = []
            for s in r.spans:
                if merged and s["start"] < merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["end"])
                else:
                    merged.append([s["start"], s["end"]])
            for a, b in merged:
                want += r.text[at:a] + secret_scan.MASK
                at = b
            assert r.m == want + r.text[at:]
        else:
            assert r.m == r.text
    fresh = new_path(spark, "ledger")
    secret_scan.update_ledger(empty, fresh)
    assert secret_scan.findings(empty, fresh).collect() == []


def test_imatch_edits(odd, empty, spark):
    docs = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in imatch.fingerprint_documents(docs).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        t, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        assert rows[i].n_chars == len(t) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    assert rows[0].fingerprint == rows[99].fingerprint
    assert imatch.fingerprint_documents(odd).count() == odd.count()
    assert imatch.fingerprint_documents(empty).collect() == []


def test_warc_round_trip(spark):
    inside = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    long = "é" * 60
    rows = [(1, "http://a\r\nX: y", long), (2, None, long), (3, "u", inside * 3), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (None, "u", long), (2, None, long), (8, "u", "x" * 300_000), (0, "u", "WARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)
    path = new_path(spark, "warc")
    warc.write_warc(pages, path)
    got = warc.read_warc(spark, path).collect()
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = i is not None and len(raw) >= 100 and i > min(j for j, _, g in rows if j is not None and g == h)
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert sorted(map(str, [(r.page_id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got])) == sorted(map(str, want))
    assert all(r.intact for r in got)
    none = new_path(spark, "warc")
    warc.write_warc(pages.limit(0), none)
    assert warc.read_warc(spark, none).collect() == []


def library_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_encoder_equals_the_library():
    import public_tokenizers

    texts = [*odd_texts(), "a  b\u0085c", "İstanbul ΣΑΣ", "x_y-z's 'S don'T", "<|endoftext|> hi", "é x", "  q", "a\x1cb 12ab__ ½²", "DON'T 's''ll 1990's", "日本語 テスト"]
    e = encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert [np.frombuffer(e.encode(t), "<u4").tolist() for t in texts] == library_ids(texts)


def test_token_files(spark, odd, empty):
    path = new_path(spark, "tokens")
    token_orc.write_token_ids(odd, path)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in token_orc.read_token_index(spark, path).collect()))
    rows = odd.collect()
    ids = [(r.doc_id, np.array([*i, 2], "<u4")) for r, i in zip(rows, library_ids([r.text for r in rows]))]
    want, start = [], 0
    for i, a in sorted(ids, key=lambda x: (x[0] is not None, x[0] or 0)):
        want.append((i is not None, i or 0, start, len(a), zlib.crc32(a.tobytes())))
        start += len(a)
    assert got == want
    none = new_path(spark, "tokens")
    token_orc.write_token_ids(empty, none)
    assert token_orc.read_token_index(spark, none).collect() == []


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing(spark, odd, empty):
    rows = packing.pack(packing.pieces(odd)).collect()
    docs = odd.collect()
    want = []
    for d, ids in zip(docs, library_ids([d.text for d in docs])):
        a = np.array([*ids, 1], "<u4")
        want += [(d.doc_id, p, s, len(a[s : s + 4096]), zlib.crc32(a[s : s + 4096].tobytes())) for p, s in enumerate(range(0, len(a), 4096))]
    assert sorted(map(str, [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows])) == sorted(map(str, want))
    check_packing(rows, 4096)
    assert packing.pack(packing.pieces(empty)).collect() == []


@pytest.mark.parametrize("kind", ["mixed", "small", "large", "one"])
def test_packing_plans(spark, kind):
    r = np.random.default_rng(11)
    n = {"mixed": r.integers(1, 101, 4000), "small": r.integers(1, 12, 3000), "large": r.integers(40, 101, 2000), "one": np.full(999, 33)}[kind]
    parts = spark.createDataFrame([(int(i), 0, 0, int(x), 0) for i, x in enumerate(n)], packing.PIECES)
    rows = packing.pack(parts, capacity=100).collect()
    assert sorted(x.length for x in rows) == sorted(n.tolist()) and len({x.doc_id for x in rows}) == len(n)
    used = check_packing(rows, 100)
    bound = {"one": 333}.get(kind, -(-int(n.sum()) // 100))
    if kind == "large":  # first fit decreasing in plain Python
        bins = []
        for x in sorted(n, reverse=True):
            k = next((k for k, b in enumerate(bins) if b + x <= 100), None)
            bins.append(0) if k is None else None
            bins[len(bins) - 1 if k is None else k] += x
        bound = len(bins)
    assert used <= bound * 1.03 + 1


def test_mixing(spark, odd, empty):
    texts, ids = [], []
    docs = spark.createDataFrame([(k, " ".join(words(20, k)), "big" if k < 700 else "mid" if k < 950 else "tiny", 1) for k in range(1000)], "doc_id bigint, text string, source string, mix_words int")
    out = mixing.mix(docs, max_repeats=3.0, keep=False).groupBy("mix_source").agg(F.sum("mix_words").alias("w"), F.countDistinct("mix_id").alias("d"), F.max("mix_weight").alias("weight"), F.max("mix_epoch").alias("e")).collect()
    got = {r.mix_source: r for r in out}
    assert {k: v.d for k, v in got.items()} == {"big": 700, "mid": 250, "tiny": 50}  # every document appears
    total = sum(v.w for v in got.values())
    assert all(abs(v.w / total - v.weight) < 0.02 for v in got.values())
    assert got["tiny"].w <= 3 * 50 * 20 and got["big"].e == 0
    assert mixing.mix(odd).select(*odd.columns).distinct().count() == odd.distinct().count()
    assert mixing.mix(empty).collect() == [] and not texts and not ids


def test_mixing_deals_token_ids(spark):
    """A source without spaces has its share, whatever the number of its words."""
    r = np.random.default_rng(9)
    texts = [" ".join(words(20, k)) for k in range(300)] + ["".join(chr(c) for c in r.integers(0x4E00, 0x4E80, 120)) for _ in range(300)]
    docs = spark.createDataFrame([(k, t, "spaced" if k < 300 else "dense") for k, t in enumerate(texts)], "doc_id bigint, text string, source string")
    want = [len(i) for i in library_ids(texts)]
    rows = mixing.mix(docs, keep=False).collect()
    assert {r.mix_id: r.mix_tokens for r in rows} == dict(enumerate(want))
    shares = np.array([sum(want[:300]), sum(want[300:])]) / sum(want)
    assert shares.min() > 0.2  # of the words, the dense source has a twentieth
    weight = {r.mix_source: r.mix_weight for r in rows}
    for k, s in enumerate(("spaced", "dense")):
        assert abs(sum(r.mix_tokens for r in rows if r.mix_source == s) / sum(r.mix_tokens for r in rows) - weight[s]) < 0.02
        assert abs(weight[s] - shares[k]) <= abs(0.5 - shares[k]) + 1e-9
    kept = mixing.mix(docs).select("doc_id", "mix_epoch", "mix_tokens").collect()
    assert sorted(map(tuple, kept)) == sorted((r.mix_id, r.mix_epoch, r.mix_tokens) for r in rows)


def test_mixing_meets_its_entropy_with_a_hot_source(spark):
    """Production defaults: one source of a third, 20 of a thirtieth."""
    totals = spark.createDataFrame([("hot", 10**6)] + [(f"s{k}", 10**5) for k in range(20)], "source string, tokens bigint")
    rows = mixing.source_weights(totals).collect()
    w, p = np.array([r.weight for r in rows]), np.array([r.share for r in rows])
    natural = -(p * np.log(p)).sum()
    assert abs(-(w * np.log(w)).sum() - (natural + 0.5 * (np.log(21) - natural))) < 1e-4
    assert 1 < max(r.epochs for r in rows) < mixing.MAX_REPEATS


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    check_packing(rows, 4096)
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    assert not [1 for a, b in combinations(sets.values(), 2) if a and b and 100 * len(a & b) >= 85 * len(a | b) and "[SECRET]" not in str(a | b)]


def test_near_duplicate_stage_at_five_words_and_80_percent(spark):
    import corpus_pipeline

    texts = []
    for k in range(12):  # each base with ever more appended: the copies lie around both thresholds
        base = words(60 + 10 * k, 300 + k)
        texts += [" ".join(base + words(len(base) * add // 100, 400 + 10 * k + add)) for add in (0, 12, 19, 22, 24, 30)]
    sets = [shingles(t, 5) for t in texts]
    root = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, texts), SF).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root))


def test_pipeline_verdicts_stay_on_the_row(spark):
    """Null ids, an id with a clean and a junk text, repeated rows, an id with two unrelated texts."""
    import corpus_pipeline

    a, b, c, d = (" ".join(words(120, 600 + k)) for k in range(4))
    rows = [(1, a), (1, a), (1, "junk " * 90), (2, b), (2, c), (None, d), (None, b), (5, "junk " * 90), (None, "junk " * 90)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clean = [x for x in rows if not x[1].startswith("junk")]
    kept = corpus_pipeline.quality(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, clean))
    stay = corpus_pipeline.near_duplicates(spark, docs.filter("text NOT LIKE 'junk%'"), SF).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, stay))) == sorted(map(str, [(1, a), (2, b), (2, c), (None, d)]))


@pytest.mark.parametrize("name", sorted(k for k in REGISTRY if not k.startswith("op13")))  # op13 returns triples of vectors
def test_queries_cover_their_table(spark, name):
    table = "pages" if name.split("_")[0] in ("op4", "op7") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    out = REGISTRY[name](spark, SF)
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in out.select(key).collect()} == want
    assert pa is not None
