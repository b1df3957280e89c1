"""Prepare processors (P1-P34) on the driver tables."""

from __future__ import annotations



from pyspark.sql import functions as F


from ..operators import prepare as P
from ..operators import window as W
from ..tables import table
from . import register


@register("p01_formula", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_tax * 100 AS l_tax
FROM lineitem""")
def p01(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    out = P.with_formula(li, "net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    out = P.with_formula(out, "l_tax", F.col("l_tax") * 100)
    return out.select("l_orderkey", "l_linenumber", "net", "l_tax")


@register("p02_multi_field", """
SELECT l_orderkey, l_linenumber, round(l_quantity * 2, 2) AS l_quantity_x2,
       round(l_extendedprice * 2, 2) AS l_extendedprice_x2
FROM lineitem""")
def p02(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    out = P.multi_field(li, ["l_quantity", "l_extendedprice"], lambda c: F.round(c * 2, 2), suffix="_x2")
    return out.select("l_orderkey", "l_linenumber", "l_quantity_x2", "l_extendedprice_x2")


@register("p03_rename", """
SELECT p_partkey, p_name AS name, p_brand AS brand, p_type, p_size, p_retailprice FROM part""")
def p03(spark, d):
    return P.rename(table(spark, d, "part"), {"p_name": "name", "p_brand": "brand"})


@register("p04_change_type", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio,
       TRY_CAST(o_orderstatus AS INTEGER) AS o_orderstatus
FROM orders""")
def p04(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("prio"), "o_orderstatus")
    return P.change_types(o, {"prio": "int", "o_orderstatus": "int"})


@register("p05_keep_columns", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer")
def p05(spark, d):
    return P.keep_columns(table(spark, d, "customer"), ["c_mktsegment", "c_custkey", "c_acctbal"])


@register("p06_drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def p06(spark, d):
    return P.drop_columns(table(spark, d, "customer"), ["c_name", "c_acctbal"])


@register("p07_select_tool", """
SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS p_size, p_type, p_retailprice FROM part""")
def p07(spark, d):
    return P.select_fields(table(spark, d, "part"), [
        {"field": "p_partkey", "selected": True},
        {"field": "p_name", "selected": True, "rename": "name"},
        {"field": "p_size", "selected": True, "type": "string"},
        {"field": "p_brand", "selected": False},
        {"field": "*Unknown", "selected": True},
    ])


_STATUS_NULLS_SQL = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END AS status FROM orders"""


def _status_with_nulls(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", None)
                    .otherwise(F.col("o_orderstatus")).alias("status"))


@register("p08_filter_value_keep", f"SELECT * FROM ({_STATUS_NULLS_SQL}) WHERE status IN ('F', 'P')")
def p08k(spark, d):
    return P.filter_on_value(_status_with_nulls(spark, d), "status", ["F", "P"], "KEEP")


@register("p08_filter_value_remove",
          f"SELECT * FROM ({_STATUS_NULLS_SQL}) WHERE NOT coalesce(status IN ('F', 'P'), false)")
def p08r(spark, d):
    return P.filter_on_value(_status_with_nulls(spark, d), "status", ["F", "P"], "REMOVE")


@register("p09_filter_formula_keep", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem
WHERE (l_quantity > 30 AND l_discount >= 0.05) OR l_returnflag = 'R'""")
def p09k(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    cond = ((F.col("l_quantity") > 30) & (F.col("l_discount") >= 0.05)) | (F.col("l_returnflag") == "R")
    return P.filter_formula(li, cond, "KEEP")


@register("p09_filter_formula_remove_dates", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE NOT coalesce(l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate <= TIMESTAMP '1997-12-31', false)""")
def p09r(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    cond = (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (
        F.col("l_shipdate") <= F.lit("1997-12-31").cast("timestamp_ntz"))
    return P.filter_formula(li, cond, "REMOVE")


@register("p10_split_column", """
SELECT page_id,
       string_split(url, '/')[1] AS part_1,
       CASE WHEN len(string_split(url, '/')) >= 2 THEN string_split(url, '/')[2] END AS part_2,
       CASE WHEN len(string_split(url, '/')) >= 3 THEN string_split(url, '/')[3] END AS part_3,
       CASE WHEN len(string_split(url, '/')) >= 4
            THEN array_to_string(string_split(url, '/')[4:], '/') END AS part_4
FROM pages""")
def p10(spark, d):
    pg = table(spark, d, "pages").select("page_id", "url")
    return P.split_column(pg, "url", "/", prefix="part", limit=4).drop("url")


@register("p10_split_column_named", """
SELECT c_custkey,
       string_split(c_name, '#')[1] AS kind,
       CASE WHEN len(string_split(c_name, '#')) >= 2 THEN array_to_string(string_split(c_name, '#')[2:], '#') END AS num
FROM customer""")
def p10b(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return P.split_column(c, "c_name", "#", out_columns=["kind", "num"]).drop("c_name")


@register("p11_split_to_rows", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def p11(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return P.split_to_rows(p, "p_name", " ", out="word").drop("p_name")


@register("p12_trim", "SELECT p_partkey, trim('  ' || p_brand || ' ') AS brand FROM part")
def p12(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("brand"))
    return P.trim_columns(p, "brand")


@register("p13_lowercase", "SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment FROM customer")
def p13(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return P.lowercase_columns(c, ["c_name", "c_mktsegment"])


_BLANKS_SQL = """
SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN '' ELSE p_brand END AS brand,
       CASE WHEN p_size > 40 THEN NULL ELSE p_type END AS ptype FROM part"""


def _blanks(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.when(F.col("p_size") < 10, None).when(F.col("p_size") < 20, "").otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") > 40, None).otherwise(F.col("p_type")).alias("ptype"),
    )


@register("p14_fill_empty", f"""
SELECT p_partkey, CASE WHEN brand IS NULL OR brand = '' THEN 'n/a' ELSE brand END AS brand,
       CASE WHEN ptype IS NULL OR ptype = '' THEN 'n/a' ELSE ptype END AS ptype FROM ({_BLANKS_SQL})""")
def p14(spark, d):
    return P.fill_empty(_blanks(spark, d), ["brand", "ptype"], "n/a")


@register("p14_fillna_nulls_only", f"""
SELECT p_partkey, coalesce(brand, 'n/a') AS brand, coalesce(ptype, 'n/a') AS ptype FROM ({_BLANKS_SQL})""")
def p14b(spark, d):
    return P.fillna(_blanks(spark, d), "n/a")


@register("p15_drop_missing_any", f"SELECT * FROM ({_BLANKS_SQL}) WHERE brand IS NOT NULL AND ptype IS NOT NULL")
def p15a(spark, d):
    return P.drop_missing(_blanks(spark, d), "any")


@register("p15_drop_missing_all_subset",
          f"SELECT * FROM ({_BLANKS_SQL}) WHERE brand IS NOT NULL OR ptype IS NOT NULL")
def p15b(spark, d):
    return P.drop_missing(_blanks(spark, d), "all", subset=["brand", "ptype"])


_MIXED_SQL = """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'abc' || c_custkey WHEN c_mktsegment = 'MACHINERY' THEN ''
            ELSE CAST(c_custkey * 3 AS VARCHAR) END AS v1,
       CASE WHEN c_nationkey < 5 THEN 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS v2
FROM customer"""


def _mixed(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("abc"), F.col("c_custkey").cast("string")))
        .when(F.col("c_mktsegment") == "MACHINERY", "").otherwise((F.col("c_custkey") * 3).cast("string")).alias("v1"),
        F.when(F.col("c_nationkey") < 5, "x").otherwise(F.col("c_nationkey").cast("string")).alias("v2"),
    )


@register("p16_remove_bad_type_or", f"""
SELECT * FROM ({_MIXED_SQL})
WHERE NOT ((v1 <> '' AND TRY_CAST(trim(v1) AS DOUBLE) IS NULL) OR (v2 <> '' AND TRY_CAST(trim(v2) AS DOUBLE) IS NULL))""")
def p16a(spark, d):
    return P.remove_bad_type(_mixed(spark, d), ["v1", "v2"], "double", "OR")


@register("p16_remove_bad_type_and", f"""
SELECT * FROM ({_MIXED_SQL})
WHERE NOT ((v1 <> '' AND TRY_CAST(trim(v1) AS DOUBLE) IS NULL) AND (v2 <> '' AND TRY_CAST(trim(v2) AS DOUBLE) IS NULL))""")
def p16b(spark, d):
    return P.remove_bad_type(_mixed(spark, d), ["v1", "v2"], "double", "AND")


@register("p17_filter_true", f"SELECT * FROM ({_STATUS_NULLS_SQL}) WHERE coalesce(status = 'O', false)")
def p17t(spark, d):
    return P.filter_split(_status_with_nulls(spark, d), P.simple_condition("status", "=", "O"))[0]


@register("p17_filter_false", f"SELECT * FROM ({_STATUS_NULLS_SQL}) WHERE NOT coalesce(status = 'O', false)")
def p17f(spark, d):
    return P.filter_split(_status_with_nulls(spark, d), P.simple_condition("status", "=", "O"))[1]


@register("p18_replace_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status
FROM orders""")
def p18(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return P.replace_values(o, "status", {"F": "Finished", "O": "Open"})


@register("p19_range_format", """
SELECT c_custkey, c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 1000 THEN 'low'
            WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS band
FROM customer""")
def p19(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return P.range_format(c, "c_acctbal", [(None, 0, "negative"), (0, 1000, "low"), (1000, 5000, "mid"),
                                             (5000, None, "high")], "band")


def _type_rules(spark):
    return spark.createDataFrame(
        [("ECONOMY", "Eco", 1), ("SMALL", "Sml", 2), ("SMALL", "ignored", 3), ("LARGE", "Lrg", 4)],
        "find string, repl string, ord int")


@register("p20_find_replace_whole", """
WITH rules(find, repl, ord) AS (VALUES ('ECONOMY', 'Eco', 1), ('SMALL', 'Sml', 2), ('SMALL', 'ignored', 3), ('LARGE', 'Lrg', 4)),
best AS (SELECT find, arg_min(repl, ord) AS repl FROM rules GROUP BY find)
SELECT p_partkey, coalesce(best.repl, p_type) AS p_type FROM part LEFT JOIN best ON part.p_type = best.find""")
def p20w(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type")
    return P.find_replace(p, "p_type", _type_rules(spark), "find", "repl", "ord", mode="whole")


def _name_rules(spark):
    return spark.createDataFrame(
        [("ring", "RING", 1), ("red", "RED", 2), ("bolt", "BOLT", 3), ("e", "E", 4)],
        "find string, repl string, ord int")


@register("p20_find_replace_substring", """
WITH rules(find, repl, ord) AS (VALUES ('ring', 'RING', 1), ('red', 'RED', 2), ('bolt', 'BOLT', 3), ('e', 'E', 4)),
hit AS (SELECT p_partkey, arg_min(r.find, r.ord) AS find, arg_min(r.repl, r.ord) AS repl
        FROM part JOIN rules r ON contains(p_name, r.find) GROUP BY p_partkey)
SELECT part.p_partkey, CASE WHEN hit.find IS NULL THEN p_name ELSE replace(p_name, hit.find, hit.repl) END AS p_name
FROM part LEFT JOIN hit ON part.p_partkey = hit.p_partkey""")
def p20s(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return P.find_replace(p, "p_name", _name_rules(spark), "find", "repl", "ord", mode="substring")


@register("p20_find_replace_substring_join", """
WITH rules(find, repl, ord) AS (VALUES ('ring', 'RING', 1), ('red', 'RED', 2), ('bolt', 'BOLT', 3), ('e', 'E', 4)),
hit AS (SELECT p_partkey, arg_min(r.find, r.ord) AS find, arg_min(r.repl, r.ord) AS repl
        FROM part JOIN rules r ON contains(p_name, r.find) GROUP BY p_partkey)
SELECT part.p_partkey, CASE WHEN hit.find IS NULL THEN p_name ELSE replace(p_name, hit.find, hit.repl) END AS p_name
FROM part LEFT JOIN hit ON part.p_partkey = hit.p_partkey""")
def p20j(spark, d):
    # same rules through the large-rule-table path (automaton per task), forced by inline_max=0
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return P.find_replace(p, "p_name", _name_rules(spark), "find", "repl", "ord", mode="substring", inline_max=0)


_URL_RE = r"^(https?)://([^/]+)/([a-z]+)/"


@register("p21_regex_extract", f"""
SELECT page_id,
       regexp_matches(url, '{_URL_RE}') AS is_match,
       CASE WHEN regexp_matches(url, '{_URL_RE}') THEN regexp_extract(url, '{_URL_RE}', 1) END AS scheme,
       CASE WHEN regexp_matches(url, '{_URL_RE}') THEN regexp_extract(url, '{_URL_RE}', 2) END AS host,
       CASE WHEN regexp_matches(url, '{_URL_RE}') THEN regexp_extract(url, '{_URL_RE}', 3) END AS lang,
       regexp_replace(url, '[0-9]+', '#', 'g') AS masked
FROM pages""")
def p21(spark, d):
    pg = table(spark, d, "pages").select("page_id", "url")
    out = P.regex_match(pg, "url", _URL_RE, "is_match")
    out = P.regex_extract(out, "url", _URL_RE, ["scheme", "host", "lang"])
    out = P.regex_replace(out, "url", "[0-9]+", "#", out="masked")
    return out.drop("url")


@register("p21_regex_tokenize", """
SELECT doc_id, count(*) AS n_tokens, count(DISTINCT lower(tok)) AS n_distinct
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS tok FROM documents)
GROUP BY doc_id""")
def p21t(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    # counted from each row's own array: exploding to count per row would shuffle every token
    toks = docs.select("doc_id", F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0).alias("toks"))
    return toks.select("doc_id", F.size("toks").cast("bigint").alias("n_tokens"),
                       F.size(F.array_distinct(F.transform("toks", F.lower))).cast("bigint").alias("n_distinct")
                       ).where("n_tokens > 0")


@register("p22_parse_date", """
SELECT event_id,
       try_strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS parsed,
       try_strptime(strftime(ts, '%d/%m/%Y') || 'x', '%d/%m/%Y') AS bad
FROM events""")
def p22(spark, d):
    ev = table(spark, d, "events").select("event_id", F.date_format("ts", "dd/MM/yyyy").alias("s"))
    ev = ev.withColumn("s2", F.concat("s", F.lit("x")))
    out = P.parse_date(ev, "s", "dd/MM/yyyy", out="parsed")
    out = P.parse_date(out, "s2", "dd/MM/yyyy", out="bad")
    return out.select("event_id", F.col("parsed").cast("timestamp_ntz").alias("parsed"),
                      F.col("bad").cast("timestamp_ntz").alias("bad"))


@register("p23_format_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%d/%m/%Y') AS dmy,
       strftime(o_orderdate, '%a') AS dow
FROM orders""")
def p23(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    o = P.format_date(o, "o_orderdate", "yyyy-MM", out="ym")
    o = P.format_date(o, "o_orderdate", "dd/MM/yyyy", out="dmy")
    o = P.format_date(o, "o_orderdate", "EEE", out="dow")
    return o.drop("o_orderdate")


@register("p24_cleanse", r"""
SELECT p_partkey,
       upper(trim(regexp_replace(regexp_replace(regexp_replace('  ' || p_name || '  ' || p_partkey || '!! ' || p_brand,
             '\p{Nd}', '', 'g'), '\p{P}', '', 'g'), '\s+', ' ', 'g'))) AS txt,
       coalesce(CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice END, 0) AS price
FROM part""")
def p24(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit("  "), F.col("p_partkey").cast("string"), F.lit("!! "), "p_brand").alias("txt"),
        F.when(F.col("p_size") > 45, None).otherwise(F.col("p_retailprice")).alias("price"),
    )
    return P.cleanse(p, ["txt", "price"], remove_digits=True, remove_punctuation=True, collapse_whitespace=True,
                     case="upper")


@register("p25_dynamic_rename", """
SELECT r_regionkey AS x_r_regionkey_v1, r_name AS x_r_name_v1 FROM region""")
def p25(spark, d):
    return P.dynamic_rename(table(spark, d, "region"), prefix="x_", suffix="_v1")


@register("p26_record_id", """
SELECT o_orderkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 999 AS rec_id
FROM orders""")
def p26(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return W.record_id(o, "rec_id", ["o_orderdate", "o_orderkey"], start=1000)


@register("p27_unpivot", """
WITH t AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
                  CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice * 2 END AS dbl FROM part)
SELECT p_partkey, name AS "Name", value AS "Value"
FROM t UNPIVOT INCLUDE NULLS (value FOR name IN (p_size, p_retailprice, dbl))""")
def p27(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice",
        F.when(F.col("p_size") > 45, None).otherwise(F.col("p_retailprice") * 2).alias("dbl"))
    return P.unpivot(p, ["p_partkey"], ["p_size", "p_retailprice", "dbl"])


@register("p28_where_mask", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount < 0.05 THEN l_discount ELSE 0.0 END AS l_discount,
       CASE WHEN l_quantity > 40 THEN -1.0 ELSE l_quantity END AS l_quantity
FROM lineitem""")
def p28(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_quantity")
    li = P.where(li, "l_discount", F.col("l_discount") < 0.05, 0.0)
    return P.mask(li, "l_quantity", F.col("l_quantity") > 40, -1.0)


@register("p29_if_then", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'normal' ELSE 'rich' END AS tier
FROM customer""")
def p29(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    c = P.if_then(c, "tier", [(F.col("c_acctbal") < 0, "debt"), (F.col("c_acctbal") < 5000, "normal")], "rich")
    return P.with_label(c, "tier", label="Customer tier").drop("c_acctbal")


@register("p30_generate_rows", """
SELECT p_partkey, CAST(i AS BIGINT) AS i FROM part, LATERAL (SELECT unnest(range(1, p_size + 1, 5)) AS i)""")
def p30(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"))
    return P.generate_rows(p, "i", F.lit(1).cast("bigint"), F.col("p_size"), F.lit(5).cast("bigint")).drop("p_size")


@register("p30_generate_rows_down", """
SELECT p_partkey, CAST(i AS BIGINT) AS i FROM part, LATERAL (SELECT unnest(range(p_size, 0, -4)) AS i)""")
def p30d(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"))
    return P.generate_rows(p, "i", F.col("p_size"), F.lit(1).cast("bigint"), -4).drop("p_size")


@register("p33_make_struct", """
SELECT p_partkey, p_brand || '/' || p_type AS label, p_size + 1 AS next_size FROM part""")
def p33(spark, d):
    s = P.make_struct(table(spark, d, "part"), "s", ["p_brand", "p_type", "p_size"])
    return s.select("p_partkey", F.concat_ws("/", "s.p_brand", "s.p_type").alias("label"), (F.col("s.p_size") + 1).alias("next_size"))


@register("p30_generate_rows_exclusive", """
SELECT p_partkey, CAST(i AS BIGINT) AS i FROM part, LATERAL (SELECT unnest(range(0, p_size, 7)) AS i)""")
def p30b(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"))
    return P.generate_rows(p, "i", F.lit(0).cast("bigint"), F.col("p_size"), F.lit(7).cast("bigint"),
                           inclusive=False).drop("p_size")


_ROWVALS_SQL = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS a,
       l_tax * 100 AS b, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_discount * 100 END AS c FROM lineitem"""


@register("p31_row_reduce", f"""
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN NULL
                  ELSE coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) END, 6) AS row_sum,
       least(a, b, c) AS row_min, greatest(a, b, c) AS row_max,
       (CASE WHEN a IS NULL THEN 0 ELSE 1 END + CASE WHEN b IS NULL THEN 0 ELSE 1 END
        + CASE WHEN c IS NULL THEN 0 ELSE 1 END) AS row_n
FROM ({_ROWVALS_SQL})""")
def p31(spark, d):
    li = table(spark, d, "lineitem")
    v = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_quantity")).alias("a"),
                  (F.col("l_tax") * 100).alias("b"),
                  F.when(F.col("l_linestatus") == "O", None).otherwise(F.col("l_discount") * 100).alias("c"))
    cols = ["a", "b", "c"]
    out = P.row_reduce(v, cols, "sum", "row_sum")
    out = P.row_reduce(out, cols, "min", "row_min")
    out = P.row_reduce(out, cols, "max", "row_max")
    out = P.row_reduce(out, cols, "n", "row_n")
    return out.select("l_orderkey", "l_linenumber", F.round("row_sum", 6).alias("row_sum"), "row_min", "row_max",
                      F.col("row_n").cast("int").alias("row_n"))


@register("p32_flatten_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def p32(spark, d):
    ev = table(spark, d, "events").select("event_id", "props")
    out = P.flatten_json(ev, "props", "k int", out="j")
    return out.select("event_id", F.col("j.k").alias("k"))


@register("p32_flatten_json_array", """
SELECT event_id, CAST(json_extract(e, '$.k') AS INTEGER) AS k
FROM (SELECT event_id, unnest(json_extract('[' || props || ',' || props || ']', '$[*]')) AS e FROM events)""")
def p32b(spark, d):
    ev = table(spark, d, "events").select("event_id", F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")).alias("arr"))
    out = P.flatten_json(ev, "arr", "array<struct<k:int>>", out="e", explode=True)
    return out.select("event_id", F.col("e.k").alias("k"))


@register("p32_flatten_variant", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'no json' WHEN event_id % 5 = 1 THEN '[' || props || ', 7, null, "x"]'
                                 ELSE '{"a": ' || props || ', "b": [' || event_id || ', 2.5, true]}' END AS j FROM events),
ok AS (SELECT event_id, CAST(j AS JSON) AS j FROM e WHERE event_id % 5 > 0),
parts AS (SELECT event_id, key, value FROM ok, json_each(j))
SELECT event_id, CASE WHEN event_id % 5 = 1 THEN NULL ELSE key END AS key,
       CASE WHEN json_type(value) = 'NULL' THEN NULL ELSE coalesce(value ->> '$', CAST(value AS VARCHAR)) END AS value,
       CAST(json_extract(value, '$.k') AS DOUBLE) AS k
FROM parts""")
def p32v(spark, d):
    i = F.col("event_id")
    text = (F.when(i % 5 == 0, "no json").when(i % 5 == 1, F.concat(F.lit("["), "props", F.lit(', 7, null, "x"]')))
            .otherwise(F.concat(F.lit('{"a": '), "props", F.lit(', "b": ['), i.cast("string"), F.lit(", 2.5, true]}"))))
    flat = P.flatten_variant(table(spark, d, "events").select("event_id", text.alias("j")), "j")
    return flat.select("event_id", "key", P.variant_field("value", "$").alias("value"), P.variant_field("value", "$.k", "bigint").cast("double").alias("k"))


@register("p34_prepare_chain", """
SELECT o_orderkey, lower(o_orderpriority) AS prio, o_totalprice * 1.1 AS gross,
       strftime(o_orderdate, '%Y') AS yr
FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 1000""")
def p34(spark, d):
    o = table(spark, d, "orders")
    steps = [
        {"type": "FilterOnValue", "params": {"column": "o_orderstatus", "values": ["F", "O"], "action": "KEEP"}},
        {"type": "FilterOnCustomFormula", "params": {"formula": F.col("o_totalprice") > 1000}},
        {"type": "CreateColumnWithGREL", "params": {"column": "gross", "expression": F.col("o_totalprice") * 1.1}},
        {"type": "ColumnLowercaser", "params": {"columns": ["o_orderpriority"]}},
        {"type": "ColumnRenamer", "params": {"renamings": [{"from": "o_orderpriority", "to": "prio"}]}},
        {"type": "FormatDate", "params": {"column": "o_orderdate", "format": "yyyy", "outColumn": "yr"}},
        {"type": "ColumnsSelector", "params": {"columns": ["o_orderkey", "prio", "gross", "yr"], "keep": True}},
    ]
    return P.prepare(o, steps)


