"""Registered queries of the corpus operators and the pipeline; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm import align, decontaminate, hard_negatives, imatch, jaccard_join, mixing, packing, quality_rules, secret_scan, token_orc, toxicity, url_filter, warc
from featurepipe.llm.store import new_path
from featurepipe.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1(spark: SparkSession, sf: str) -> DataFrame:
    out = jaccard_join.link_components(read_table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op2(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


def op3(spark: SparkSession, sf: str) -> DataFrame:
    out = quality_rules.judge(read_table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    out = url_filter.filter_urls(pages, url_filter.repeated_urls(pages))
    return out.select(F.col("page").alias("page_id"), "host", "path", "rule", "verdict")


def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    ledger = new_path(spark, "ledger")
    secret_scan.update_ledger(docs, ledger)
    out = secret_scan.findings(docs, ledger)
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE))
    n = [F.size(F.filter("spans", lambda s: s["rank"] == i)).cast("bigint").alias(f"n_{r.kind}") for i, r in enumerate(secret_scan.BASE)]
    return out.select("doc_id", *n, F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"))


def op6(spark: SparkSession, sf: str) -> DataFrame:
    return imatch.fingerprint_documents(read_table(spark, sf, "documents"))


def op7(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_warc(read_table(spark, sf, "pages"), path)
    out = warc.read_warc(spark, path)
    return out.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op8(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_orc.write_token_ids(read_table(spark, sf, "documents"), path)
    return token_orc.read_token_index(spark, path)


def op9(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(packing.pieces(read_table(spark, sf, "documents")))


def op10(spark: SparkSession, sf: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf, "documents"), keep=False)
    return out.select(F.col("mix_id").alias("doc_id"), F.col("mix_source").alias("source"), F.col("mix_words").alias("n_words"), F.col("mix_tokens").alias("n_tokens"),
                      F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"), F.col("mix_weight").alias("weight"))


def op11(spark: SparkSession, sf: str) -> DataFrame:
    out = align.align(read_table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12(spark: SparkSession, sf: str) -> DataFrame:
    out = decontaminate.decontaminate(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op13(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


REGISTRY: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1,
    "op2_toxicity": op2,
    "op3_quality_rules": op3,
    "op4_url_filters": op4,
    "op5_secret_scans": op5,
    "op6_document_fingerprints": op6,
    "op7_warc": op7,
    "op8_token_ids": op8,
    "op9_best_fit_packing": op9,
    "op10_source_mixing": op10,
    "op11_tokenizer_alignment": op11,
    "op12_benchmark_decontamination": op12,
    "op13_hard_negatives": op13,
}

_NORMAL = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
SQL: dict[str, str] = {
    "op4_url_filters": f"""
WITH a AS (SELECT page_id, coalesce({_REST}, '') AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS h0, rest FROM a),
c AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(h0) + 1) AS tail FROM b),
d AS (SELECT page_id, host, regexp_extract(tail, '^([^?#]*)', 1) AS path, regexp_extract(tail, '^[^?#]*\\?([^#]*)', 1) AS query FROM c),
e AS (SELECT *, list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_') AND NOT starts_with(p, 'ref='))) AS kept FROM d),
f AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '')
        || regexp_replace(regexp_replace(path, '\\.html$', ''), '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM e),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (SELECT DISTINCT f.host, f.path, r.rhost || r.rpath AS rule, r.verdict FROM (SELECT DISTINCT host, path FROM f) f JOIN rules r
        ON (f.host = r.rhost OR ends_with(f.host, '.' || r.rhost)) AND starts_with(f.path, r.rpath)),
best AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fit GROUP BY host, path),
listed AS (SELECT canonical, min(page_id) AS keeper FROM f WHERE canonical IS NOT NULL GROUP BY canonical HAVING min(page_id) < max(page_id))
SELECT f.page_id, f.host, f.path, best.rule,
  coalesce(best.verdict, CASE WHEN listed.canonical IS NOT NULL AND f.page_id IS DISTINCT FROM listed.keeper THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN best USING (host, path) LEFT JOIN listed USING (canonical)""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html)::bigint AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM r""",
    "op12_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_NORMAL.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id::varchar AS item, coalesce({_NORMAL.format("text")}, []) AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS t
       FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS t
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT r, s, n, item FROM dw JOIN iw USING (n, t)),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(s, s + n)) AS p FROM m)) GROUP BY r),
f AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (r) LEFT JOIN f USING (r)""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::double)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::bigint AS score FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 3""",
}
