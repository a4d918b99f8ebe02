"""URL filter: a blocked Bloom filter over listed canonical URLs, then an exact hash join.

DataFrame functions only. The filter is one array of 64-bit words: ``blocks`` blocks of
512 bits, each key setting ``BITS`` bits of one block. Its size is a parameter (1 MB
with the default), so it reaches the tasks as a scalar subquery with a proven bound
whatever the list's length; a longer list only lets more pages pass to the join.
Pages whose canonical URL misses the filter are certainly not listed and are
decided without a shuffle. Possible hits are joined with the list on the canonical
URL itself, which removes false positives.

Rules (allow or block, host, path) come first: a rule fits its host and all
subdomains when the URL's path starts with the rule's; the longest rule text wins. A
page without a rule is blocked when its canonical URL is listed with another page as
its keeper (no keeper: always), else allowed.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end. A null URL, or one without
``://``, has an empty host and path, no canonical URL and is allowed. Repeated rows
are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.store import stored

BITS = 8
WORDS = 8  # 64-bit words of a block
BLOCKS = 1 << 14  # 1 MB

# fixed values: (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
TRACKING = ("utm_", "ref=")  # query parameters that do not name a page
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(df: DataFrame, url: str) -> DataFrame:
    """``df`` with ``host``, ``path`` and ``canonical`` (null without a host)."""
    u = F.col(url)
    after = F.when(F.instr(u, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    df = df.withColumn("__rest", F.coalesce(after, F.lit("")))
    df = df.withColumn("__host", F.regexp_extract("__rest", r"^([^/?#]*)", 1))
    df = df.withColumn("__tail", F.expr("substring(__rest, length(__host) + 1)"))
    df = df.withColumn("host", F.translate("__host", UPPER, LOWER)).withColumn("path", F.regexp_extract("__tail", r"^([^?#]*)", 1))
    query = F.regexp_extract("__tail", r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit(TRACKING[0])) & ~F.startswith(p, F.lit(TRACKING[1]))))
    site = F.regexp_replace(F.regexp_replace("host", r"^www\.", ""), r":(80|443)$", "")
    page = F.regexp_replace(F.regexp_replace("path", r"\.html$", ""), r"/+$", "")
    canonical = F.concat(site, page, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return df.withColumn("canonical", F.when(F.col("host") != "", canonical)).drop("__rest", "__host", "__tail")


def _slots(key: str, blocks: int) -> tuple[Column, list[tuple[Column, Column]]]:
    """The first word of the key's block; (word in it, bit) of each of the key's bits."""
    h = F.xxhash64(F.col(key))
    g = F.xxhash64(F.col(key), F.lit("bits"))
    first = (F.pmod(h, F.lit(blocks)) * WORDS).cast("int")
    bits = []
    for i in range(BITS):
        nine = F.shiftrightunsigned(g, 7 * i).bitwiseAND(F.lit(511)).cast("int")
        bits.append((F.shiftrightunsigned(nine, 6).cast("int"), nine.bitwiseAND(F.lit(63))))
    return first, bits


def build_filter(listed: DataFrame, key: str = "canonical", blocks: int = BLOCKS) -> DataFrame:
    """One row: ``words``, the filter of the non-null keys. Bits meet in a map-side combined ``bit_or``."""
    first, bits = _slots(key, blocks)
    one = F.lit(1).cast("bigint")
    rows = listed.filter(F.col(key).isNotNull()).select(F.explode(F.array(*[
        F.struct((first + w).alias("at"), F.expr("1L").alias("one"), b.alias("bit")) for w, b in bits])).alias("s"))
    words = rows.groupBy(F.col("s.at").alias("at")).agg(F.bit_or(F.expr("shiftleft(s.one, s.bit)")).alias("word"))
    every = listed.sparkSession.range(blocks * WORDS).select(F.col("id").cast("int").alias("at"))
    return every.join(words, "at", "left").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", one * 0).alias("word")))), lambda s: s["word"]).alias("words"))


def may_contain(words: Column, key: str, blocks: int) -> Column:
    first, bits = _slots(key, blocks)
    test = F.lit(True)
    for w, b in bits:
        test = test & (F.call_function("shiftright", F.get(words, first + w), b).bitwiseAND(F.lit(1)) == 1)
    return F.coalesce(F.col(key).isNotNull() & test, F.lit(False))


def _rule(rules) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule; null without one."""
    fits, verdicts = [], []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fit = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        fits.append(F.when(fit, host + path))
        verdicts.append(F.when(fit, verdict))
    return (F.coalesce(*fits), F.coalesce(*verdicts)) if fits else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def repeated_urls(pages: DataFrame, url: str = "url", page: str = "page_id") -> DataFrame:
    """A list made from the pages: canonical URLs that several page ids carry, kept by the smallest id."""
    seen = with_host_path(pages.select(F.col(page).alias("page"), F.col(url).alias("url")), "url").filter("canonical IS NOT NULL")
    return seen.groupBy("canonical").agg(F.min("page").alias("keeper"), F.max("page").alias("__last")).filter("keeper < __last").drop("__last")


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, page: str = "page_id", url: str = "url", blocks: int = BLOCKS) -> DataFrame:
    """(page, host, path, canonical, rule, verdict): one row per row of ``pages``.

    ``listed``: canonical (distinct) and keeper (the page that stays, or null).
    """
    listed = stored(listed.select("canonical", "keeper"), "listed")
    words = stored(build_filter(listed, blocks=blocks), "filter")
    rows = with_host_path(pages.select(F.col(page).alias("page"), F.col(url).alias("url")), "url")
    rule, verdict = _rule(rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict).withColumn("__words", words.scalar())
    rows = rows.withColumn("possible", F.col("rule").isNull() & may_contain(F.col("__words"), "canonical", blocks)).drop("__words")
    rows = stored(rows.select("page", "host", "path", "canonical", "rule", "verdict", "possible"), "judged")
    sure = rows.filter("NOT possible").withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    hits = rows.filter("possible").join(listed.withColumn("is_listed", F.lit(True)), "canonical", "left")
    hits = hits.withColumn("verdict", F.when(F.col("is_listed") & (F.col("keeper").isNull() | F.col("page").isNull() | (F.col("page") != F.col("keeper"))), "block").otherwise("allow"))
    out = ["page", "host", "path", "canonical", "rule", "verdict"]
    return sure.select(*out).unionByName(hits.select(*out))
