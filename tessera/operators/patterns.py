"""Pattern clustering, flow lineage tables and keyword classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rule_match import with_first_rule

# Default normalisation rules (pattern, replacement), applied in order.
DEFAULT_RULES = [
    (r"[0-9]+", "#"),
    (r"\p{Lu}+", "A"),
    (r"\p{Ll}+", "a"),
]


def normalize_pattern(c, rules=DEFAULT_RULES) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    for pat, rep in rules:
        x = F.regexp_replace(x, pat, rep)
    return x


def cluster_patterns(df: DataFrame, column, position: str, rules=DEFAULT_RULES, by=()) -> DataFrame:
    """Group values by their normalised shape: count, first/last position, one example.

    One aggregation (partial on the map side); the example is the value at
    the smallest position. A list of columns is stacked first (unpivot) and
    clustered per (column, pattern).
    """
    keys = [by] if isinstance(by, str) else list(by)
    if not isinstance(column, str):
        stacked = df.select(*keys, position, *[F.col(c).cast("string").alias(c) for c in column]).unpivot(
            [*keys, position], list(column), "column", "value")
        return cluster_patterns(stacked, "value", position, rules, [*keys, "column"])
    return df.withColumn("pattern", normalize_pattern(column, rules)).groupBy(*keys, "pattern").agg(
        F.count(F.lit(1)).alias("n"), F.min(position).alias("first_pos"), F.max(position).alias("last_pos"),
        F.min_by(F.col(column), F.col(position)).alias("example"))


def lineage_edges(steps: DataFrame, step_id: str, inputs: str, outputs: str) -> DataFrame:
    """(dataset, step, role) rows from a table of steps with input / output arrays."""
    ins = steps.select(F.explode(inputs).alias("dataset"), F.col(step_id).alias("step"), F.lit("consumer").alias("role"))
    outs = steps.select(F.explode(outputs).alias("dataset"), F.col(step_id).alias("step"), F.lit("producer").alias("role"))
    # two plain explodes (codegen) measured faster than one explode of role-tagged structs
    return ins.unionByName(outs)


def lineage_summary(edges: DataFrame) -> DataFrame:
    """Per dataset, producer and consumer counts, one example of each,
    and whether it is a source (never produced) or a terminal (never consumed).

    Aggregates only: a dataset read by a third of all steps is still one
    partial row per map task.
    """
    prod = F.col("role") == "producer"
    cons = F.col("role") == "consumer"
    s = edges.groupBy("dataset").agg(
        F.count_if(prod).alias("n_producers"), F.count_if(cons).alias("n_consumers"),
        F.min(F.when(prod, F.col("step"))).alias("first_producer"),
        F.min(F.when(cons, F.col("step"))).alias("first_consumer"))
    return s.withColumns({"is_source": F.col("n_producers") == 0, "is_terminal": F.col("n_consumers") == 0})


INLINE_RULES = 128  # larger CASE chains outgrow the generated-method size limit


def classify(df: DataFrame, id_col: str, text_col: str, rules: DataFrame, keyword: str, category: str,
             priority: str, out: str = "category", match: str = "word", default=None, inline_max: int = INLINE_RULES) -> DataFrame:
    """The category of the highest-priority (smallest number, then keyword) rule that matches.

    ``match='word'``: a rule matches when its keyword equals a lower-cased
    word of the text; words are exploded and joined to the rules on the
    keyword, then the smallest priority per record wins (a partial
    aggregation). ``match='substring'``: up to ``inline_max`` rules compile to
    one chained expression; more become automata (``rule_match``), which read
    each text once. Both compare lower-cased text,
    skip rules without a keyword and give the category as text.
    """
    r = rules.select(F.lower(F.col(keyword).cast("string")).alias("__kw"), F.col(category).cast("string").alias("__cat"), F.col(priority).alias("__p"))
    r = r.where(F.length("__kw") > 0)
    fallback = F.lit(default).cast("string")
    if match == "word":
        words = df.select(F.col(id_col).alias("__id"),
                          F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"\p{L}+"), 0)).alias("__kw")).distinct()
        best = words.join(r, "__kw").groupBy("__id").agg(F.min_by("__cat", F.struct("__p", "__kw", "__cat")).alias(out))
        res = df.join(best, df[id_col] == best["__id"], "left").drop("__id")
        return res.withColumn(out, F.coalesce(F.col(out), fallback))
    rows = r.orderBy("__p", "__kw", "__cat").limit(inline_max + 1).collect()
    text = F.lower(F.col(text_col).cast("string"))
    if len(rows) <= inline_max:
        expr = None
        for row in rows:
            cond = F.instr(text, row["__kw"]) > 0
            expr = (F.when if expr is None else expr.when)(cond, F.lit(row["__cat"]))
        return df.withColumn(out, fallback if expr is None else expr.otherwise(fallback))
    res = with_first_rule(df, text, r.select(F.col("__kw").alias("__find"), F.col("__cat").alias("__value"), F.col("__p").alias("__order")))
    return res.withColumn(out, F.when(F.col("__hit").isNull(), fallback).otherwise(F.col("__hit.value"))).drop("__hit")
