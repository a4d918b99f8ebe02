"""Clashing columns, hostile texts, other vocabularies, files read back, released tables, empty stages."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurepipe.llm import mixing, secret_scan, store, token_orc
from featurepipe.llm.store import new_path
from featurepipe.llm.token_orc import vocabulary_path
from featurepipe.llm.tokens import encoder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["b", "s", "room", "last", "own", "full", "block_tokens", "done", "source2", "tokens", "weight", "epochs", "share", "mix_tokens", "mix_draw"]
    docs = spark.createDataFrame([(k, "a few words", "en" if k % 2 else "es", *range(k, k + len(names))) for k in range(20)], "doc_id bigint, text string, source string, " + ", ".join(f"{n} int" for n in names))
    out = mixing.mix(docs)
    back = out.filter("mix_epoch = 0").select(*[c for c in docs.columns if c not in mixing.ADDED])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.select(*back.columns).collect()))
    assert {r.mix_tokens for r in out.collect()} == {len(encoder(vocabulary_path(mixing.DEFAULT_VOCABULARY)).encode("a few words")) // 4}


def test_findings_replace_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "token=abcdef123", "mine", 7), (2, None, "mine", 8)], "doc_id bigint, text string, blob string, spans int")
    path = new_path(spark, "ledger")
    secret_scan.update_ledger(docs, path)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.findings(docs, path).collect()}
    assert got == {1: [("assign", 0, 15)], 2: []}


def test_runs_of_token_heads_are_scanned_once(spark):
    text = "eyJ" * 350_000 + " eyJhbGciOi.eyJzdWIi.c2lnbmF0dXJl eyJ." + "eyJ_" * 100_000
    path, start = new_path(spark, "ledger"), time.time()
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    secret_scan.update_ledger(docs, path)
    (row,) = secret_scan.findings(docs, path).collect()
    at = 3 * 350_000 + 1
    assert [(s.kind, s.start, s.end) for s in row.spans] == [("signed_token", at, at + 32)]
    assert time.time() - start < 60  # a rule that reads a run from each of its heads takes hours


def test_ledger_scans_only_unseen_blobs_and_stores_no_text(spark):
    path = new_path(spark, "ledger")
    docs = spark.createDataFrame([(i, f"text {i % 3} token=abcdef{i % 3}") for i in range(9)], "doc_id bigint, text string")
    with store.scope() as made:
        secret_scan.update_ledger(docs, path)
        secret_scan.update_ledger(docs.unionByName(spark.createDataFrame([(99, "new"), (100, None)], docs.schema)), path)
    assert made == []
    ledger = secret_scan.read_ledger(spark, path)
    assert ledger.count() == ledger.select("blob").distinct().count() == 5
    assert secret_scan.findings(docs, path).filter(F.size("spans") == 1).count() == 9


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_vocabulary_gives_the_library_s_ids(name):
    e = encoder(vocabulary_path(name))
    r = np.random.default_rng(3)
    letters = list("abcXYZ  \n\t019'.,;_-é ßİıÀſ'<>|s·«€\x7f\x1c")
    for text in ["Hello World", "", None, "x" * 500, "<|endoftext|> a", *("".join(r.choice(letters, r.integers(1, 80)).tolist()) for _ in range(500))]:
        want = e.library.encode(text, add_special_tokens=False).ids if text else []
        assert np.frombuffer(e.encode(text), "<u4").tolist() == want


def test_the_word_cache_is_bounded(monkeypatch):
    from featurepipe.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_BYTES", 5000)
    e = tokens.Encoder(vocabulary_path(tokens.DEFAULT_VOCABULARY))
    text = " ".join(f"word{i}" for i in range(2000))
    assert e.encode(text) == e._spells(text) and len(e.words) < 40 and len(e.pieces) < 40 and e.encode(text) == e._spells(text)


def test_orc_readers_skip_row_groups_by_id(spark):
    path = new_path(spark, "tokens")
    docs = spark.range(6000).select((2 * F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    token_orc.write_token_ids(docs.coalesce(1), path)
    files = spark.read.orc(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("low").collect()
    assert all(a.high < b.low for a, b in zip(files, files[1:]))

    def read(where):
        df = spark.read.schema("doc_id bigint, ids array<int>").orc(path).filter(where)
        rows = df.collect()
        scans, nodes = 0, [df._jdf.queryExecution().executedPlan()]
        while nodes:
            n = nodes.pop()
            if n.nodeName().startswith("Scan"):
                scans += n.metrics().apply("numOutputRows").value()
            if n.nodeName() == "AdaptiveSparkPlan":
                nodes.append(n.executedPlan())
            nodes += [n.children().apply(i) for i in range(n.children().size())]
        return rows, scans

    rows, scanned = read("doc_id = 8642")
    assert [r.doc_id for r in rows] == [8642] and scanned <= 1000  # one row group of the index
    rows, scanned = read("doc_id = 8643")
    assert rows == [] and scanned == 0  # inside the range of a row group: the Bloom filter says no
    assert spark.read.orc(path).count() == 6000


def test_released_tables_are_empty_and_those_still_read_stay(spark):
    with store.scope() as made:
        a, b = (store.stored(spark.range(5), n) for n in "ab")
    assert len(made) == 2
    kept = store.release(spark, made, a)
    assert len(kept) == 1 and a.count() == 5
    gone = next(p for p in made if p not in kept)
    assert spark.read.parquet(gone).count() == 0 and b is not None


def test_arrow_batches_are_bounded_by_bytes(spark):
    spark.conf.set(store.BATCH_CONF, "64m")
    store.ship(spark)
    assert spark.conf.get(store.BATCH_CONF) == f"{store.BATCH_BYTES}b"
    spark.conf.set(store.BATCH_CONF, "1m")
    store.ship(spark)
    assert spark.conf.get(store.BATCH_CONF) == "1m"


def test_stages_of_an_empty_table(spark):
    import corpus_pipeline

    empty = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == [], name


def test_stages_with_nulls_in_every_column(spark):
    import corpus_pipeline

    text = " ".join(f"w{i * 7919 % 1000}" for i in range(80))
    docs = spark.createDataFrame([(None, None, None, None, None), (1, text, None, None, None), (None, text + " more", "en", None, 5), (2, None, "en", "s", 0)], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= 1, name


def test_run_writes_every_stage_and_packs_what_is_left(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    step = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = store.stored(stage(spark, step, SF), "step")
    want = {}
    for r in step.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + len(encoder(vocabulary_path(mixing.DEFAULT_VOCABULARY)).encode(r.text)) // 4 + 1
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want and max(r.offset + r.length for r in rows) <= 4096


def brute_weights(tokens, entropy=0.5, limit=4.0):
    p = np.array([t for t in tokens.values()], float) / sum(tokens.values())
    goal = -(p * np.log(p)).sum() + entropy * (np.log(len(p)) + (p * np.log(p)).sum())
    best = None
    for a in np.linspace(1, 0, 20001):
        w = p**a / (p**a).sum()
        if (w / p).max() / (w / p).min() > limit:
            break
        best = w
        if -(w * np.log(w)).sum() >= goal:
            break
    return dict(zip(tokens, best)), dict(zip(tokens, (best / p) / (best / p).min()))


def test_mix_against_brute_force(spark):
    """Weights by a grid of exponents; whole epochs for every document, the rest of a budget within one document's length."""
    r = np.random.default_rng(8)
    rows = [(k, " ".join(f"w{x}" for x in r.integers(0, 500, r.integers(1, 60))), "abcde"[min(4, int(r.exponential(1.2)))]) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(docs, keep=False).collect()
    size = {}
    for x in out:
        size[x.mix_id] = x.mix_tokens
    tokens = {}
    for k, _, s in rows:
        tokens[s] = tokens.get(s, 0) + size[k]
    weights, epochs = brute_weights(tokens)
    copies = {}
    for x in out:
        copies[x.mix_id] = copies.get(x.mix_id, 0) + 1
        assert abs(x.mix_weight - weights[x.mix_source]) < 2e-3
    assert set(copies) == {k for k, *_ in rows}
    for s, total in tokens.items():
        mine = [k for k, _, x in rows if x == s]
        full = int(epochs[s] + 1e-3)
        assert {copies[k] for k in mine} <= {full, full + 1}
        dealt, budget = sum(copies[k] * size[k] for k in mine), epochs[s] * total
        assert -max(size[k] for k in mine) - 0.005 * total <= dealt - budget <= 0.005 * total
