"""Spreadsheet functions (FX1-FX22) on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import excel as X
from ..tables import table
from . import as_double, register


@register("fx01_if_ifs_switch", """
SELECT o_orderkey,
       CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS if_v,
       CASE WHEN o_totalprice > 150000 THEN 'xl' WHEN o_totalprice > 50000 THEN 'l' WHEN o_totalprice > 0 THEN 's' END AS ifs_v,
       CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS switch_v
FROM orders""")
def fx01(spark, d):
    o = table(spark, d, "orders")
    p = F.col("o_totalprice")
    return o.select("o_orderkey", X.IF(p > 100000, "big", "small").alias("if_v"),
                    X.IFS(p > 150000, "xl", p > 50000, "l", p > 0, "s").alias("ifs_v"),
                    X.SWITCH("o_orderstatus", "F", "done", "O", "open", default="other").alias("switch_v"))


@register("fx02_iferror", """
SELECT c_custkey, coalesce(TRY_CAST(trim(CASE WHEN c_nationkey < 5 THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END)
                                    AS DOUBLE), -1) AS v FROM customer""")
def fx02(spark, d):
    c = table(spark, d, "customer")
    txt = F.when(F.col("c_nationkey") < 5, "n/a").otherwise(F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", X.IFERROR(X.VALUE(txt), F.lit(-1.0)).alias("v"))


@register("fx03_and_or_not", """
SELECT c_custkey, (c_acctbal > 0 AND c_nationkey < 10) AS a, (c_acctbal > 9000 OR c_nationkey = 1 OR c_nationkey = 2) AS o,
       NOT (c_mktsegment = 'BUILDING') AS n FROM customer""")
def fx03(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", X.AND(F.col("c_acctbal") > 0, F.col("c_nationkey") < 10).alias("a"),
                    X.OR(F.col("c_acctbal") > 9000, F.col("c_nationkey") == 1, F.col("c_nationkey") == 2).alias("o"),
                    X.NOT(F.col("c_mktsegment") == "BUILDING").alias("n"))


@register("fx04_date_overflow", """
SELECT o_orderkey,
       strftime(make_date(year(o_orderdate), 1, 1) + to_months(month(o_orderdate) + 13 - 1)
                + to_days(day(o_orderdate) + 40 - 1), '%Y-%m-%d') AS d
FROM orders""")
def fx04(spark, d):
    o = table(spark, d, "orders")
    dte = X.DATE(F.year("o_orderdate"), F.month("o_orderdate") + 13, F.dayofmonth("o_orderdate") + 40)
    return o.select("o_orderkey", F.date_format(dte, "yyyy-MM-dd").alias("d"))


@register("fx05_edate_eomonth", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS edate1,
       strftime(o_orderdate - INTERVAL 13 MONTH, '%Y-%m-%d') AS edate_m13,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS eom0, strftime(last_day(o_orderdate + INTERVAL 2 MONTH), '%Y-%m-%d') AS eom2
FROM orders""")
def fx05(spark, d):
    o = table(spark, d, "orders")
    dd = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.date_format(X.EDATE(dd, 1), "yyyy-MM-dd").alias("edate1"),
                    F.date_format(X.EDATE(dd, -13), "yyyy-MM-dd").alias("edate_m13"),
                    F.date_format(X.EOMONTH(dd, 0), "yyyy-MM-dd").alias("eom0"),
                    F.date_format(X.EOMONTH(dd, 2), "yyyy-MM-dd").alias("eom2"))


@register("fx06_date_time_parts", """
SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s
FROM events""")
def fx06(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", *[f("ts").cast("bigint").alias(a) for f, a in [
        (X.YEAR, "y"), (X.MONTH, "m"), (X.DAY, "d"), (X.HOUR, "h"), (X.MINUTE, "mi"), (X.SECOND, "s")]])


@register("fx07_today_now", """
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS DOUBLE) AS age_days,
       true AS now_known FROM orders""")
def fx07(spark, d):
    o = table(spark, d, "orders")
    as_of = dt.date(2001, 12, 31)  # TODAY with a fixed as-of date is repeatable; NOW is only checked for a value
    out = o.select("o_orderkey", X.DATEDIF(F.to_date("o_orderdate"), X.TODAY(as_of), "D").alias("age_days"),
                   X.NOW().isNotNull().alias("now_known"))
    return as_double(out, "age_days")


@register("fx08_weekday", """
SELECT o_orderkey, dayofweek(o_orderdate) + 1 AS w1, isodow(o_orderdate) AS w2, isodow(o_orderdate) - 1 AS w3
FROM orders""")
def fx08(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", *[X.WEEKDAY("o_orderdate", t).cast("bigint").alias(f"w{t}") for t in (1, 2, 3)])


_DATEDIF_BASE = """
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS s, CAST(l_shipdate AS DATE) AS e
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@register("fx09_datedif", f"""
WITH b AS ({_DATEDIF_BASE}),
m AS (SELECT *, (year(e) - year(s)) * 12 + (month(e) - month(s)) - CASE WHEN day(e) < day(s) THEN 1 ELSE 0 END AS mm FROM b)
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN s <= e THEN date_diff('day', s, e) END AS DOUBLE) AS d_days,
       CAST(CASE WHEN s <= e THEN mm END AS DOUBLE) AS d_months,
       CAST(CASE WHEN s <= e THEN floor(mm / 12) END AS DOUBLE) AS d_years
FROM m""")
def fx09(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    out = j.select("l_orderkey", "l_linenumber", X.DATEDIF("o_orderdate", "l_shipdate", "D").alias("d_days"),
                   X.DATEDIF("o_orderdate", "l_shipdate", "M").alias("d_months"),
                   X.DATEDIF("o_orderdate", "l_shipdate", "Y").alias("d_years"))
    return as_double(out, "d_days", "d_months", "d_years")


@register("fx10_datevalue", """
SELECT event_id, strftime(try_strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d'), '%Y-%m-%d') AS d1,
       strftime(try_strptime(strftime(ts, '%m/%d/%Y') || '!', '%m/%d/%Y'), '%Y-%m-%d') AS bad
FROM events""")
def fx10(spark, d):
    ev = table(spark, d, "events")
    a = X.DATEVALUE(F.date_format("ts", "yyyy-MM-dd"))
    b = X.DATEVALUE(F.concat(F.date_format("ts", "MM/dd/yyyy"), F.lit("!")), "MM/dd/yyyy")
    return ev.select("event_id", F.date_format(a, "yyyy-MM-dd").alias("d1"), F.date_format(b, "yyyy-MM-dd").alias("bad"))


HOLIDAYS = [dt.date(1996, 12, 25), dt.date(1997, 1, 1), dt.date(1997, 12, 25), dt.date(1998, 1, 1),
            dt.date(1998, 12, 25), dt.date(1999, 1, 1), dt.date(1999, 7, 5), dt.date(2000, 12, 25)]
_HOL_SQL = ", ".join(f"DATE '{h.isoformat()}'" for h in HOLIDAYS)


@register("fx11_networkdays", f"""
WITH b AS ({_DATEDIF_BASE}),
c AS (SELECT l_orderkey, l_linenumber, s, e, least(s, e) AS lo, greatest(s, e) AS hi FROM b)
SELECT l_orderkey, l_linenumber,
       (SELECT count(*) FROM generate_series(lo, hi, INTERVAL 1 DAY) g(x)
        WHERE isodow(x) <= 5 AND CAST(x AS DATE) NOT IN ({_HOL_SQL})) * CASE WHEN s <= e THEN 1 ELSE -1 END AS workdays
FROM c""")
def fx11(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    X.NETWORKDAYS("o_orderdate", "l_shipdate", HOLIDAYS).cast("bigint").alias("workdays"))


@register("fx12_text", """
SELECT p_partkey, strftime(o.d, '%Y-%m-%d') AS t_date, printf('%.2f', p_retailprice) AS t_2dp,
       format('{:,.2f}', p_retailprice * 1000) AS t_grouped, printf('%.0f', p_size / 100 * 100) || '%' AS t_pct
FROM part, (SELECT DATE '2024-03-05' AS d) o""")
def fx12(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.TEXT(F.lit(dt.date(2024, 3, 5)), "yyyy-mm-dd").alias("t_date"),
                    X.TEXT("p_retailprice", "0.00").alias("t_2dp"),
                    X.TEXT(F.col("p_retailprice") * 1000, "#,##0.00").alias("t_grouped"),
                    X.TEXT(F.col("p_size") / 100, "0%").alias("t_pct"))


@register("fx12_text_codes", """
WITH p AS (SELECT p_partkey, p_size, p_retailprice AS x, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
                  DATE '2024-01-01' + CAST(p_partkey % 366 AS INT) AS d,
                  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey * 7919 % 86400) AS t FROM part)
SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 5, '0') AS zeros, '$' || format('{:,.2f}', x) AS money,
       CASE WHEN p_size < 25 THEN '(' || (25 - p_size) || ')' WHEN p_size = 25 THEN '-' ELSE CAST(p_size - 25 AS VARCHAR) END AS parts,
       CASE WHEN p_size % 10 = 0 THEN (p_size // 10) || '.' ELSE (p_size // 10) || '.' || (p_size % 10) END AS optional,
       format('{:,}', CAST(round(x * 1000) AS BIGINT)) || ' m' AS mille, lpad(CAST(p_size AS VARCHAR), 4, ' ') AS spaces,
       substr(lpad(CAST(cents AS VARCHAR), 9, '0'), 1, 3) || '-' || substr(lpad(CAST(cents AS VARCHAR), 9, '0'), 4, 2) || '-' || right(lpad(CAST(cents AS VARCHAR), 9, '0'), 4) AS dashes,
       CASE WHEN p_size >= 40 THEN 'large' WHEN p_size < 10 THEN 'small' ELSE CAST(p_size AS VARCHAR) END AS rules,
       printf('%.1f', CAST(p_size AS DOUBLE)) || '%' AS percent, left(CAST(p_size AS VARCHAR), 1) || '.' || rpad(substr(CAST(p_size AS VARCHAR), 2), 1, '0') || 'E+0' || (length(CAST(p_size AS VARCHAR)) - 1) AS science,
       strftime(d, '%-d/%-m/%y') AS short, strftime(d, '%A, %B %-d, %Y') AS long, strftime(d, '%a %b %d') AS names, left(strftime(d, '%b'), 1) AS letter,
       strftime(t, '%-I:%M %p') AS clock, strftime(t, '%H%M%S') AS plain, strftime(t, '%M:%S') AS minutes, (45292 * 24 + hour(t)) || 'h' AS elapsed
FROM p""")
def fx12_codes(spark, d):
    """Codes of every kind: digits, groups, sections, conditions, exponents, dates and times."""
    p = table(spark, d, "part")
    size, x = F.col("p_size"), F.col("p_retailprice")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("p_partkey") % 366).cast("int"))
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("p_partkey") * 7919 % 86400).cast("timestamp_ntz")
    codes = {
        "zeros": (size, "00000"), "money": (x, "$#,##0.00"), "parts": (size - 25, "0;(0);-"), "optional": (size / 10, "0.#"),
        "mille": (x * 1000000, '#,##0, "m"'), "spaces": (size, "???0"), "dashes": (F.round(x * 100), "000-00-0000"),
        "rules": (size, '[>=40]"large";[<10]"small";0'), "percent": (size / 100, "0.0%"), "science": (size, "0.0E+00"),
        "short": (day, "d/m/yy"), "long": (day, "dddd, mmmm d, yyyy"), "names": (day, "ddd mmm dd"), "letter": (day, "mmmmm"),
        "clock": (at, "h:mm AM/PM"), "plain": (at, "hhmmss"), "minutes": (at, "mm:ss"), "elapsed": (at, '[h]"h"'),
    }
    return p.select("p_partkey", *[X.TEXT(v, code).alias(name) for name, (v, code) in codes.items()])


@register("fx13_left_right_mid_len", """
SELECT c_custkey, left(c_name, 8) AS l, right(c_name, 4) AS r, substr(c_name, 10, 3) AS m, length(c_name) AS n
FROM customer""")
def fx13(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", X.LEFT("c_name", 8).alias("l"), X.RIGHT("c_name", 4).alias("r"),
                    X.MID("c_name", 10, 3).alias("m"), X.LEN("c_name").cast("bigint").alias("n"))


@register("fx14_concat_textjoin", """
WITH b AS (SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN '' ELSE p_brand END AS brand,
                  p_type, p_name FROM part)
SELECT p_partkey, coalesce(brand, '') || coalesce(p_type, '') || coalesce(p_name, '') AS c,
       concat_ws('/', nullif(brand, ''), p_type, p_name) AS tj,
       coalesce(brand, '') || '/' || p_type || '/' || p_name AS tj_all
FROM b""")
def fx14(spark, d):
    p = table(spark, d, "part")
    brand = F.when(F.col("p_size") < 10, None).when(F.col("p_size") < 20, "").otherwise(F.col("p_brand"))
    return p.select("p_partkey", X.CONCAT(brand, "p_type", "p_name").alias("c"),
                    X.TEXTJOIN("/", True, brand, "p_type", "p_name").alias("tj"),
                    X.TEXTJOIN("/", False, brand, "p_type", "p_name").alias("tj_all"))


@register("fx15_trim", """
SELECT p_partkey, regexp_replace(trim('  ' || replace(p_name, ' ', '   ') || ' '), ' +', ' ', 'g') AS t FROM part""")
def fx15(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.TRIM(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" "))).alias("t"))


@register("fx16_upper_lower_proper", r"""
SELECT page_id, upper(url) AS u, lower(url) AS l,
       array_to_string(list_transform(regexp_extract_all(url, '(\p{L}+|\P{L}+)', 1),
                                      lambda t: upper(substr(t, 1, 1)) || lower(substr(t, 2))), '') AS p
FROM pages""")
def fx16(spark, d):
    pg = table(spark, d, "pages")
    return pg.select("page_id", X.UPPER("url").alias("u"), X.LOWER("url").alias("l"), X.PROPER("url").alias("p"))


@register("fx17_substitute_replace", r"""
SELECT page_id, replace(url, '/', '|') AS all_,
       CASE WHEN len(string_split(url, '/')) > 3
            THEN array_to_string(string_split(url, '/')[1:3], '/') || '#' || array_to_string(string_split(url, '/')[4:], '/')
            ELSE url END AS third,
       CASE WHEN length(url) >= 5 THEN left(url, 4) || 'XX' || substr(url, 4 + 3) ELSE url END AS rep
FROM pages""")
def fx17(spark, d):
    pg = table(spark, d, "pages")
    return pg.select("page_id", X.SUBSTITUTE("url", "/", "|").alias("all_"),
                     X.SUBSTITUTE("url", "/", "#", instance=3).alias("third"),
                     F.when(F.length("url") >= 5, X.REPLACE("url", 5, 2, F.lit("XX"))).otherwise(F.col("url")).alias("rep"))


@register("fx18_find_search", """
SELECT p_partkey, CAST(CASE WHEN strpos(p_name, 'e') > 0 THEN strpos(p_name, 'e') END AS DOUBLE) AS f,
       CAST(CASE WHEN strpos(lower(p_name), lower('RING')) > 0 THEN strpos(lower(p_name), lower('RING')) END AS DOUBLE) AS s,
       CAST(CASE WHEN strpos(substr(p_name, 3), 'e') > 0 THEN strpos(substr(p_name, 3), 'e') + 2 END AS DOUBLE) AS f3
FROM part""")
def fx18(spark, d):
    p = table(spark, d, "part")
    return as_double(p.select("p_partkey", X.FIND("e", "p_name").alias("f"), X.SEARCH("RING", "p_name").alias("s"),
                              X.FIND("e", "p_name", 3).alias("f3")), "f", "s", "f3")


@register("fx19_value", """
SELECT event_id, TRY_CAST(trim(substr(props, 7, length(props) - 7)) AS DOUBLE) AS v FROM events""")
def fx19(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", X.VALUE(F.substring(F.col("props"), 7, 1000000).substr(F.lit(1), F.length("props") - 7)).alias("v"))


@register("fx20_round", """
SELECT c_custkey, round(c_acctbal, 0) + 0.0 AS r0, round(c_acctbal, -2) + 0.0 AS rm2,
       sign(c_acctbal) * ceil(round(abs(c_acctbal) * 0.1, 9)) / 0.1 AS up_m1,
       sign(c_acctbal) * floor(round(abs(c_acctbal) * 10.0, 9)) / 10.0 AS down1
FROM customer""")
def fx20(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", X.ROUND("c_acctbal", 0).alias("r0"), X.ROUND("c_acctbal", -2).alias("rm2"),
                    X.ROUNDUP("c_acctbal", -1).alias("up_m1"), X.ROUNDDOWN("c_acctbal", 1).alias("down1"))


@register("fx21_math", """
SELECT c_custkey, CAST(floor(c_acctbal / 7) AS BIGINT) AS i, abs(c_acctbal) AS a,
       c_acctbal - 7.0 * floor(c_acctbal / 7.0) AS mod7, c_acctbal - (-3.0) * floor(c_acctbal / -3.0) AS modm3,
       power(c_nationkey, 2) AS p, round(CASE WHEN c_acctbal >= 0 THEN sqrt(c_acctbal) END, 9) AS sq,
       round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 9) AS ln_,
       round(CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END, 9) AS lg,
       round(exp(c_nationkey / 10.0), 9) AS ex
FROM customer""")
def fx21(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", X.INT(F.col("c_acctbal") / 7).cast("bigint").alias("i"), X.ABS("c_acctbal").alias("a"),
                    X.MOD("c_acctbal", 7).alias("mod7"), X.MOD("c_acctbal", -3).alias("modm3"),
                    X.POWER(F.col("c_nationkey"), F.lit(2)).alias("p"), F.round(X.SQRT("c_acctbal"), 9).alias("sq"),
                    F.round(X.LN("c_acctbal"), 9).alias("ln_"), F.round(X.LOG("c_acctbal"), 9).alias("lg"),
                    F.round(X.EXP(F.col("c_nationkey") / 10.0), 9).alias("ex"))


@register("fx22_rand")
def fx22(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", X.RAND(11).alias("r"), X.RANDBETWEEN(1, 6, 12).alias("die"))
