"""Data quality, meanings and reconciliation (Q1-Q8) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..tables import table
from . import register

_NORM = "lower(regexp_replace(translate({x}, '" + Q.ACCENTED + "', '" + Q.UNACCENTED + "'), '\\s+', '', 'g'))"


@register("q01_row_count", "SELECT count(*) AS record_count FROM lineitem")
def q01(spark, d):
    return Q.row_count(table(spark, d, "lineitem"))


@register("q02_metrics", """
SELECT 'c_custkey' AS "column", count(c_custkey) AS count, CAST(count_if(c_custkey IS NULL) AS BIGINT) AS nulls,
       count(DISTINCT c_custkey) AS distinct, CAST(min(c_custkey) AS VARCHAR) AS min, CAST(max(c_custkey) AS VARCHAR) AS max,
       round(avg(c_custkey), 6) AS avg FROM customer
UNION ALL
SELECT 'c_acctbal', count(c_acctbal), CAST(count_if(c_acctbal IS NULL) AS BIGINT), count(DISTINCT c_acctbal),
       CAST(min(c_acctbal) AS VARCHAR), CAST(max(c_acctbal) AS VARCHAR), round(avg(c_acctbal), 6) FROM customer
UNION ALL
SELECT 'c_mktsegment', count(c_mktsegment), CAST(count_if(c_mktsegment IS NULL) AS BIGINT), count(DISTINCT c_mktsegment),
       min(c_mktsegment), max(c_mktsegment), NULL FROM customer""")
def q02(spark, d):
    m = Q.compute_metrics(table(spark, d, "customer"), ["c_custkey", "c_acctbal", "c_mktsegment"])
    return m.withColumn("avg", F.round("avg", 6))


@register("q03_checks", """
SELECT 'not_null(o_orderkey)' AS "check", count_if(o_orderkey IS NULL) = 0 AS passed FROM orders
UNION ALL SELECT 'unique(o_orderkey)', count(o_orderkey) = count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'unique(o_custkey)', count(o_custkey) = count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'in_set(o_orderstatus)', count_if(NOT coalesce(o_orderstatus IN ('F', 'O'), true)) = 0 FROM orders
UNION ALL SELECT 'in_range(o_totalprice)', count_if(coalesce(o_totalprice < 0 OR o_totalprice > 500000, false)) = 0 FROM orders
UNION ALL SELECT 'not_blank(o_orderpriority)', count_if(o_orderpriority IS NULL OR o_orderpriority = '') = 0 FROM orders
UNION ALL SELECT 'non_empty', count(*) > 0 FROM orders
UNION ALL SELECT 'min_rows(1000000)', count(*) >= 1000000 FROM orders""")
def q03(spark, d):
    return Q.check_dataset(table(spark, d, "orders"), [
        Q.not_null("o_orderkey"), Q.unique("o_orderkey"), Q.unique("o_custkey"), Q.in_set("o_orderstatus", ["F", "O"]),
        Q.in_range("o_totalprice", 0, 500000), Q.not_blank("o_orderpriority"), Q.non_empty(), Q.min_rows(1_000_000)])


_LANGS = ["EN", "Fr ", "dé"]


def _values_sql(mode):
    if mode == "EXACT":
        pred = "lang IN ('EN', 'Fr ', 'dé')"
    elif mode == "LOWERCASE":
        pred = "lower(lang) IN (lower('EN'), lower('Fr '), lower('dé'))"
    else:
        pred = _NORM.format(x="lang") + " IN (" + ", ".join(_NORM.format(x=f"'{v}'") for v in _LANGS) + ")"
    return f"""SELECT '{mode}' AS mode, CAST(count_if(lang IS NOT NULL AND {pred}) AS BIGINT) AS valid,
       CAST(count_if(lang IS NOT NULL AND NOT ({pred})) AS BIGINT) AS invalid,
       CAST(count_if(lang IS NULL) AS BIGINT) AS empty FROM documents"""


@register("q04_values_meaning", "\nUNION ALL\n".join(_values_sql(m) for m in ("EXACT", "LOWERCASE", "NORMALIZED")))
def q04(spark, d):
    docs = table(spark, d, "documents")
    parts = [Q.meaning_counts(docs, "lang", Q.values_meaning("lang", _LANGS, m)).withColumn("mode", F.lit(m))
             for m in ("EXACT", "LOWERCASE", "NORMALIZED")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("q05_mapping_meaning", f"""
SELECT doc_id, CASE {_NORM.format(x='lang')} WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' END
       AS lang_name FROM documents""")
def q05(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return Q.mapping_meaning(docs, "lang", {"EN": "English", "fr": "French", "Dé": "German"}, "lang_name",
                             "NORMALIZED").drop("lang")


@register("q06_pattern_meaning", r"""
SELECT CAST(count_if(regexp_full_match(props, '\{"k": [0-9]+\}')) AS BIGINT) AS valid,
       CAST(count_if(NOT regexp_full_match(props, '\{"k": [0-9]+\}')) AS BIGINT) AS invalid,
       CAST(count_if(props IS NULL) AS BIGINT) AS empty FROM events""")
def q06(spark, d):
    ev = table(spark, d, "events")
    return Q.meaning_counts(ev, "props", Q.pattern_meaning("props", r'\{"k": [0-9]+\}'))


@register("q06_pattern_anchors", r"""
SELECT CAST(count_if(regexp_full_match(name, 'Customer#0000[0-9]+')) AS BIGINT) AS valid,
       CAST(count_if(NOT regexp_full_match(name, 'Customer#0000[0-9]+')) AS BIGINT) AS invalid,
       CAST(count_if(name IS NULL) AS BIGINT) AS empty
FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN c_name || ' x' WHEN 1 THEN c_name || chr(10) WHEN 2 THEN NULL ELSE c_name END AS name FROM customer)""")
def q06_anchors(spark, d):
    """A pattern with anchors of its own still has to match the whole value."""
    k = F.col("c_custkey") % 4
    c = table(spark, d, "customer").select(F.when(k == 0, F.concat("c_name", F.lit(" x"))).when(k == 1, F.concat("c_name", F.lit("\n")))
                                           .when(k == 3, F.col("c_name")).alias("name"))
    return Q.meaning_counts(c, "name", Q.pattern_meaning("name", "^Customer#0000[0-9]+$"))


@register("q07_detect_meaning", r"""
SELECT meaning, ratio FROM (
  SELECT 'url' AS meaning, count_if(regexp_full_match(url, 'https?://[^ ]+')) / count(url) AS ratio FROM pages
  UNION ALL SELECT 'secure_url', count_if(regexp_full_match(url, 'https://[^ ]+')) / count(url) FROM pages
  UNION ALL SELECT 'lang_path', count_if(regexp_full_match(url, '.*/(en|fr|de|es)/.*')) / count(url) FROM pages)""")
def q07(spark, d):
    pg = table(spark, d, "pages")
    return Q.detect_meaning(pg, "url", {
        "url": Q.pattern_meaning("url", "https?://[^ ]+"),
        "secure_url": Q.pattern_meaning("url", "https://[^ ]+"),
        "lang_path": Q.pattern_meaning("url", ".*/(en|fr|de|es)/.*"),
    })


@register("q08_reconcile", """
WITH e AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders),
p AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
             o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 50000)
      UNION ALL SELECT o_orderkey + 1000000, o_totalprice, o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW'
                                                                                     AND o_orderstatus = 'P')
SELECT coalesce(e.o_orderkey, p.o_orderkey) AS o_orderkey,
       CASE WHEN p.o_orderkey IS NULL THEN 'missing' WHEN e.o_orderkey IS NULL THEN 'extra'
            WHEN e.o_totalprice IS DISTINCT FROM p.o_totalprice OR e.o_orderstatus IS DISTINCT FROM p.o_orderstatus
            THEN 'changed' ELSE 'same' END AS status,
       CASE WHEN e.o_orderkey IS NOT NULL AND p.o_orderkey IS NOT NULL
            THEN concat_ws(',', CASE WHEN e.o_totalprice IS DISTINCT FROM p.o_totalprice THEN 'o_totalprice' END,
                           CASE WHEN e.o_orderstatus IS DISTINCT FROM p.o_orderstatus THEN 'o_orderstatus' END)
            ELSE '' END AS diff_columns
FROM e FULL OUTER JOIN p ON e.o_orderkey = p.o_orderkey""")
def q08(spark, d):
    o = table(spark, d, "orders")
    e = o.select("o_orderkey", "o_totalprice", "o_orderstatus")
    kept = o.filter(~((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000))).select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"), "o_orderstatus")
    extra = o.filter((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")).select(
        (F.col("o_orderkey") + 1000000).alias("o_orderkey"), "o_totalprice", "o_orderstatus")
    return Q.reconcile(e, kept.unionByName(extra), "o_orderkey")
