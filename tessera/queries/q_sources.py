"""Sources and sinks (S1-S14) and the streaming use of narrow steps.

Each query writes a table derived from the driver data to a fresh folder
under the session's shared checkpoint folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as P
from ..sources import io as S
from ..streaming.narrow import read_file_stream, run_available
from ..tables import table
from . import register


@register("s02_csv_with_schema", "SELECT * FROM orders")
def s02(spark, d):
    o = table(spark, d, "orders")
    path = S.scratch_path(spark, "s02")
    S.write(o, path, "csv", header=True)
    return S.read_delimited(spark, path, schema=o.schema)


@register("s01_tsv_infer_types", "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def s01(spark, d):
    p = table(spark, d, "part")
    path = S.scratch_path(spark, "s01")
    S.write(p, path, "csv", header=True, sep="\t")
    return S.read_delimited(spark, path, sep="\t")


@register("s03_json_orc_parquet", """
SELECT 'json' AS fmt, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part
UNION ALL SELECT 'orc', count(*), round(sum(p_retailprice), 2) FROM part
UNION ALL SELECT 'parquet', count(*), round(sum(p_retailprice), 2) FROM part""")
def s03(spark, d):
    p = table(spark, d, "part")
    out = None
    for fmt in ("json", "orc", "parquet"):
        path = S.scratch_path(spark, f"s03-{fmt}")
        S.write(p, path, fmt)
        back = S.read(spark, path, fmt)
        agg = back.agg(F.lit(fmt).alias("fmt"), F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total"))
        out = agg if out is None else out.unionByName(agg)
    return out


@register("s07_sync_upper_case", """
SELECT n_nationkey AS N_NATIONKEY, n_name AS N_NAME, n_regionkey AS N_REGIONKEY FROM nation""")
def s07(spark, d):
    path = S.scratch_path(spark, "s07")
    S.sync(table(spark, d, "nation"), path, upper_case=True)
    return S.read(spark, path)


@register("s09_ctas_table", """
SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1""")
def s09(spark, d):
    name = "tessera_s09_" + S.scratch_path(spark, "x").rsplit("-", 1)[-1]
    path = S.scratch_path(spark, "s09")
    agg = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    agg.write.mode("overwrite").option("path", path).saveAsTable(name)
    return S.read_table(spark, name)


@register("s10_partition_pruned_read", """
SELECT event_id, user_id, value, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE event_type = 'click' AND strftime(ts, '%Y-%m-%d') IN ('2024-01-05', '2024-01-06')""")
def s10(spark, d):
    path = S.scratch_path(spark, "s10")
    S.write_partitioned(table(spark, d, "events").select("event_id", "user_id", "value", "event_type", "ts"),
                        path, discrete=["event_type"], time_column="ts", period="DAY")
    back = S.read(spark, path)
    return back.filter((F.col("event_type") == "click") & F.col("day").isin("2024-01-05", "2024-01-06")).select(
        "event_id", "user_id", "value", "event_type", F.col("day").cast("string").alias("day"))


@register("s11_folder_of_files", """
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1""")
def s11(spark, d):
    path = S.scratch_path(spark, "s11")
    S.write(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, partition_by="o_orderstatus")
    files = S.read_folder(spark, path)
    return files.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("s13_head_records")
def s13(spark, d):
    o = table(spark, d, "orders")
    recs = S.head_records(o, 10)
    return spark.createDataFrame([(len(recs), ",".join(S.column_names(o)), str(S.schema_of(o)))],
                                 "n long, columns string, schema string")


@register("s14_csv_export", """
SELECT 'r_regionkey,r_name' AS line UNION ALL SELECT CAST(r_regionkey AS VARCHAR) || ',' || r_name FROM region""")
def s14(spark, d):
    text = S.to_csv_string(table(spark, d, "region"), limit=100)
    return spark.createDataFrame([(line,) for line in text.splitlines()], "line string")


@register("st01_stream_prepare", """
SELECT event_id, user_id, upper(event_type) AS event_type, value * 2 AS value2 FROM events WHERE value > 10""")
def st01(spark, d):
    schema = table(spark, d, "events").schema
    stream = read_file_stream(spark, d, schema, glob="events.parquet")
    sink = S.scratch_path(spark, "st01")

    def steps(df):
        df = P.filter_formula(df, F.col("value") > 10)
        df = P.with_formulas(df, {"event_type": F.upper("event_type"), "value2": F.col("value") * 2})
        return df.select("event_id", "user_id", "event_type", "value2")

    run_available(stream, steps, sink)
    return S.read(spark, sink)


@register("s08_sql_dialect", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS price,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 7) END AS per_unit,
       CASE WHEN o_custkey % 7 = 0 THEN 0.0 ELSE o_totalprice / (o_custkey % 7) END AS per_unit0,
       o_orderstatus || '/' || o_orderpriority AS tag
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def s08(spark, d):
    S.register_dialect_functions(spark)
    return S.sql_step(spark, """
        SELECT o_orderkey, (o_totalprice::DECIMAL(12, 2))::DOUBLE AS price,
               SAFE_DIVIDE(o_totalprice, o_custkey % 7) AS per_unit, DIV0(o_totalprice, o_custkey % 7) AS per_unit0,
               concat_ws('/', STRUCT(o_orderstatus, o_orderpriority).o_orderstatus, `o`.`o_orderpriority`) AS tag
        FROM ${orders} AS `o` WHERE o_orderdate >= ${start}::TIMESTAMP_NTZ""",
                      views={"orders": table(spark, d, "orders")}, variables={"start": "1998-01-01"})


@register("st02_stream_static_join", """
SELECT e.event_id, e.event_type, c.c_mktsegment, c.c_nationkey FROM events e JOIN customer c ON e.user_id = c.c_custkey""")
def st02(spark, d):
    from ..operators import joins as J

    schema = table(spark, d, "events").schema
    stream = read_file_stream(spark, d, schema, glob="events.parquet")
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    sink = S.scratch_path(spark, "st02")

    def steps(df):
        j = J.join(df.select("event_id", "event_type", "user_id"), cust, [("user_id", "c_custkey")], "INNER")
        return j.select("event_id", "event_type", "c_mktsegment", "c_nationkey")

    run_available(stream, steps, sink)
    return S.read(spark, sink)


@register("s05_inline_table", """
SELECT o_orderpriority, label, count(*) AS n FROM orders
JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('5-LOW', 'later')) AS t(code, label) ON o_orderpriority = code
GROUP BY 1, 2""")
def s05(spark, d):
    labels = S.inline_table(spark, ["code", "label"], [("1-URGENT", "now"), ("2-HIGH", "soon"), ("5-LOW", "later")])
    o = table(spark, d, "orders").select("o_orderpriority")
    return o.join(labels, F.col("o_orderpriority") == F.col("code")).groupBy("o_orderpriority", "label").agg(F.count(F.lit(1)).alias("n"))


@register("ux2_vectorized", """
SELECT p_partkey, length(p_name) + p_size AS score FROM part""")
def ux2(spark, d):
    from pyspark.sql.types import LongType

    from ..plans import custom as UX

    score = UX.vectorized(lambda name, size: name.str.len() + size, LongType())
    return table(spark, d, "part").select("p_partkey", score("p_name", "p_size").alias("score"))


@register("ux3_grouped_map", """
SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS yr, count(*) AS n, min(o_orderkey) AS first_key,
       round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders GROUP BY 1, 2""")
def ux3(spark, d):
    """A step over each customer's orders of a year, in batches; small groups many at a time."""
    import pandas as pd
    import pyarrow as pa

    from ..plans import custom as UX

    def one(batches):
        n, least, low, high = 0, None, None, None
        for b in batches:
            key = (b["o_custkey"].iloc[0], b["yr"].iloc[0])
            n += len(b)
            least = int(b["o_orderkey"].min()) if least is None else min(least, int(b["o_orderkey"].min()))
            low = b["o_totalprice"].min() if low is None else min(low, b["o_totalprice"].min())
            high = b["o_totalprice"].max() if high is None else max(high, b["o_totalprice"].max())
        yield pd.DataFrame({"o_custkey": [key[0]], "yr": [key[1]], "n": [n], "first_key": [least], "spread": [round(high - low, 2)]})

    def many(t):
        price = "o_totalprice"
        g = t.group_by(["o_custkey", "yr"], use_threads=False).aggregate([([], "count_all"), ("o_orderkey", "min"), (price, "min"), (price, "max")])
        spread = (g[f"{price}_max"].to_numpy() - g[f"{price}_min"].to_numpy()).round(2)
        return pa.table({"o_custkey": g["o_custkey"], "yr": g["yr"], "n": g["count_all"], "first_key": g["o_orderkey_min"],
                         "spread": pa.array(spread, from_pandas=True)})

    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("yr"), "o_orderkey", "o_totalprice")
    kind = "o_custkey long, yr int, n long, first_key long, spread double"
    return UX.grouped_stream(o, ["o_custkey", "yr"], one, kind, many=many)
