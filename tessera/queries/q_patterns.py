"""Pattern clustering, lineage and classification (X1-X3) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import patterns as X
from ..tables import table
from . import register


@register("x01_cluster_patterns", r"""
SELECT regexp_replace(regexp_replace(regexp_replace(url, '[0-9]+', '#', 'g'), '\p{Lu}+', 'A', 'g'), '\p{Ll}+', 'a', 'g')
         AS pattern, count(*) AS n, min(page_id) AS first_pos, max(page_id) AS last_pos, arg_min(url, page_id) AS example
FROM pages GROUP BY 1""")
def x01(spark, d):
    return X.cluster_patterns(table(spark, d, "pages"), "url", "page_id")


@register("x01_cluster_patterns_columns", r"""
WITH s AS (SELECT p_partkey, name AS "column", value FROM part
           UNPIVOT INCLUDE NULLS (value FOR name IN (p_name, p_brand, p_type)))
SELECT "column", regexp_replace(regexp_replace(regexp_replace(value, '[0-9]+', '#', 'g'), '\p{Lu}+', 'A', 'g'), '\p{Ll}+', 'a', 'g')
         AS pattern, count(*) AS n, min(p_partkey) AS first_pos, max(p_partkey) AS last_pos,
       arg_min(value, p_partkey) AS example
FROM s GROUP BY 1, 2""")
def x01c(spark, d):
    return X.cluster_patterns(table(spark, d, "part"), ["p_name", "p_brand", "p_type"], "p_partkey")


@register("x01_cluster_patterns_by_lang", r"""
SELECT lang, regexp_replace(regexp_replace(regexp_replace(source, '[0-9]+', '#', 'g'), '\p{Lu}+', 'A', 'g'), '\p{Ll}+', 'a', 'g')
         AS pattern, count(*) AS n, min(doc_id) AS first_pos, max(doc_id) AS last_pos, arg_min(source, doc_id) AS example
FROM documents GROUP BY 1, 2""")
def x01b(spark, d):
    return X.cluster_patterns(table(spark, d, "documents"), "source", "doc_id", by="lang")


_LINEAGE_SQL = """
WITH steps AS (
  SELECT 'order_step_' || o_orderkey AS step, ['customer_' || o_custkey] AS inputs, ['order_' || o_orderkey] AS outputs FROM orders
  UNION ALL
  SELECT 'line_step_' || l_orderkey || '_' || l_linenumber, ['order_' || l_orderkey, 'part_' || l_partkey],
         ['line_' || l_orderkey || '_' || l_linenumber] FROM lineitem),
edges AS (SELECT unnest(inputs) AS dataset, step, 'consumer' AS role FROM steps
          UNION ALL SELECT unnest(outputs), step, 'producer' FROM steps)
SELECT dataset, CAST(count_if(role = 'producer') AS BIGINT) AS n_producers, CAST(count_if(role = 'consumer') AS BIGINT) AS n_consumers,
       min(CASE WHEN role = 'producer' THEN step END) AS first_producer,
       min(CASE WHEN role = 'consumer' THEN step END) AS first_consumer,
       count_if(role = 'producer') = 0 AS is_source, count_if(role = 'consumer') = 0 AS is_terminal
FROM edges GROUP BY dataset"""


@register("x02_lineage", _LINEAGE_SQL)
def x02(spark, d):
    return X.lineage_summary(_order_edges(spark, d))


@register("x02_lineage_edges", """
SELECT 'customer_' || o_custkey AS dataset, 'order_step_' || o_orderkey AS step, 'consumer' AS role FROM orders
UNION ALL SELECT 'order_' || o_orderkey, 'order_step_' || o_orderkey, 'producer' FROM orders
UNION ALL SELECT 'order_' || l_orderkey, 'line_step_' || l_orderkey || '_' || l_linenumber, 'consumer' FROM lineitem
UNION ALL SELECT 'part_' || l_partkey, 'line_step_' || l_orderkey || '_' || l_linenumber, 'consumer' FROM lineitem
UNION ALL SELECT 'line_' || l_orderkey || '_' || l_linenumber, 'line_step_' || l_orderkey || '_' || l_linenumber, 'producer' FROM lineitem""")
def x02e(spark, d):
    # every producer and consumer of every dataset, as rows
    return _order_edges(spark, d)


def _order_edges(spark, d):
    o = table(spark, d, "orders").select(
        F.concat(F.lit("order_step_"), F.col("o_orderkey").cast("string")).alias("step"),
        F.array(F.concat(F.lit("customer_"), F.col("o_custkey").cast("string"))).alias("inputs"),
        F.array(F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"))).alias("outputs"))
    li = table(spark, d, "lineitem").select(
        F.concat(F.lit("line_step_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("step"),
        F.array(F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")),
                F.concat(F.lit("part_"), F.col("l_partkey").cast("string"))).alias("inputs"),
        F.array(F.concat(F.lit("line_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                         F.col("l_linenumber").cast("string"))).alias("outputs"))
    return X.lineage_edges(o.unionByName(li), "step", "inputs", "outputs")


_RULES = [("the", "en", 1), ("and", "en", 2), ("der", "de", 1), ("und", "de", 2), ("les", "fr", 1),
          ("une", "fr", 2), ("los", "es", 1), ("una", "es", 2), ("is", "en", 3)]
_RULES_SQL = ", ".join(f"('{k}', '{c}', {p})" for k, c, p in _RULES)


@register("x03_classify_words", rf"""
WITH rules(kw, cat, p) AS (VALUES {_RULES_SQL}),
words AS (SELECT DISTINCT conv_id, turn, w FROM (
            SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w FROM conversations)),
best AS (SELECT conv_id, turn, arg_min(cat, struct_pack(p := p, kw := kw)) AS category
         FROM words JOIN rules ON w = kw GROUP BY 1, 2)
SELECT c.conv_id, c.turn, coalesce(best.category, 'unknown') AS category
FROM conversations c LEFT JOIN best ON c.conv_id = best.conv_id AND c.turn = best.turn""")
def x03(spark, d):
    conv = table(spark, d, "conversations").withColumn("__rid", F.struct("conv_id", "turn"))
    rules = spark.createDataFrame(_RULES, "kw string, cat string, p int")
    res = X.classify(conv, "__rid", "text", rules, "kw", "cat", "p", default="unknown")
    return res.select("conv_id", "turn", "category")


@register("x03_classify_substring", """
SELECT doc_id, CASE WHEN contains(lower(text), 'the') THEN 'en' WHEN contains(lower(text), 'der') THEN 'de'
                    WHEN contains(lower(text), 'les') THEN 'fr' WHEN contains(lower(text), 'los') THEN 'es'
                    ELSE 'unknown' END AS category FROM documents""")
def x03s(spark, d):
    rules = spark.createDataFrame([("the", "en", 1), ("der", "de", 2), ("les", "fr", 3), ("los", "es", 4)],
                                  "kw string, cat string, p int")
    docs = table(spark, d, "documents").select("doc_id", "text")
    return X.classify(docs, "doc_id", "text", rules, "kw", "cat", "p", match="substring", default="unknown").drop("text")


@register("x03_classify_many_rules", r"""
WITH r AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}{4,}')) AS kw FROM benchmark),
m AS (SELECT doc_id, kw, row_number() OVER (PARTITION BY doc_id ORDER BY length(kw) DESC, kw) AS rn
      FROM documents JOIN r ON contains(lower(text), kw))
SELECT d.doc_id, coalesce(m.kw, 'none') AS category FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id AND m.rn = 1""")
def x03_many(spark, d):
    """The longest benchmark word that occurs in each document: as many rules as the benchmark has words."""
    words = table(spark, d, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), 0)).alias("kw")).distinct()
    rules = words.select("kw", F.col("kw").alias("cat"), (-F.length("kw")).alias("p"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    return X.classify(docs, "doc_id", "text", rules, "kw", "cat", "p", match="substring", default="none").drop("text")
