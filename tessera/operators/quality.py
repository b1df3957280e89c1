"""Data quality: metrics, checks, semantic types (meanings), reconciliation (Q1-Q8).

Metrics are single-pass aggregates; checks return one pass/fail row per
check; meanings are Column predicates; reconciliation is a full outer join.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blank import is_blank


# Q1, Q2 ------------------------------------------------------------------------
def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def compute_metrics(df: DataFrame, columns=None) -> DataFrame:
    """Per column: count, nulls, distinct, min, max, avg (numeric) in one aggregate.

    Returns one row per column. ``count_distinct`` is exact; several in one
    aggregate are planned with an Expand, so for very wide tables prefer
    ``approx=True`` in :func:`describe`.
    """
    types = dict(df.dtypes)
    cols = list(columns) if columns is not None else [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    exprs = []
    for c in cols:
        x = F.col(c)
        numeric = types[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or types[c].startswith("decimal")
        exprs += [
            F.count(x).alias(f"{c}__n"), F.count_if(x.isNull()).alias(f"{c}__nulls"),
            F.count_distinct(x).alias(f"{c}__distinct"),
            F.min(x).cast("string").alias(f"{c}__min"), F.max(x).cast("string").alias(f"{c}__max"),
            (F.avg(x) if numeric else F.lit(None).cast("double")).alias(f"{c}__avg"),
        ]
    wide = df.agg(*exprs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("count"), F.col(f"{c}__nulls").alias("nulls"),
                 F.col(f"{c}__distinct").alias("distinct"), F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"), F.col(f"{c}__avg").alias("avg"))
        for c in cols])).alias("m")).select("m.*")


# Q3 ---------------------------------------------------------------------------------
def not_null(column: str) -> tuple[str, Column]:
    return f"not_null({column})", F.count_if(F.col(column).isNull()) == 0


def not_blank(column: str) -> tuple[str, Column]:
    return f"not_blank({column})", F.count_if(is_blank(column)) == 0


def unique(column: str) -> tuple[str, Column]:
    return f"unique({column})", F.count(F.col(column)) == F.count_distinct(F.col(column))


def in_set(column: str, values) -> tuple[str, Column]:
    return f"in_set({column})", F.count_if(~F.coalesce(F.col(column).isin(list(values)), F.lit(True))) == 0


def in_range(column: str, lo=None, hi=None) -> tuple[str, Column]:
    x = F.col(column)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (x < F.lit(lo))
    if hi is not None:
        bad = bad | (x > F.lit(hi))
    return f"in_range({column})", F.count_if(F.coalesce(bad, F.lit(False))) == 0


def non_empty() -> tuple[str, Column]:
    return "non_empty", F.count(F.lit(1)) > 0


def min_rows(n: int) -> tuple[str, Column]:
    return f"min_rows({n})", F.count(F.lit(1)) >= n


def check_dataset(df: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    """Evaluate every check in one aggregate; one row per check: (check, passed)."""
    wide = df.agg(*[cond.alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("passed")) for i, (name, _) in enumerate(checks)
    ])).alias("r")).select("r.*")


# Q4-Q7 meanings ------------------------------------------------------------------------
def _latin_folds() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from the Unicode names of the Latin blocks.

    A letter called "LATIN SMALL LETTER L WITH STROKE" folds to "l"; letters
    that are no variant of one base letter (such as the ligatures) stay.
    """
    marked, base = [], []
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00), range(0x2C60, 0x2C80), range(0xA720, 0xA800)):
        for code in block:
            named = re.match(r"LATIN (SMALL|CAPITAL) LETTER (DOTLESS )?([A-Z])( WITH .*)?$", unicodedata.name(chr(code), ""))
            if named:
                marked.append(chr(code))
                base.append(named[3].lower() if named[1] == "SMALL" else named[3])
    return "".join(marked), "".join(base)


ACCENTED, UNACCENTED = _latin_folds()


def normalize(c, mode: str = "EXACT") -> Column:
    """EXACT: as is; LOWERCASE: lower-cased; NORMALIZED: lower, accents folded, spaces removed."""
    x = F.col(c) if isinstance(c, str) else c
    mode = mode.upper()
    if mode == "EXACT":
        return x
    if mode == "LOWERCASE":
        return F.lower(x)
    if mode == "NORMALIZED":
        # combining marks go, so that composed and decomposed spellings agree
        return F.lower(F.regexp_replace(F.translate(x, ACCENTED, UNACCENTED), r"[\s\p{M}]+", ""))
    raise ValueError("mode is EXACT, LOWERCASE or NORMALIZED")


def values_meaning(column: str, values, mode: str = "EXACT") -> Column:
    """True when the normalised value is one of the meaning's values (null for null)."""
    vals = [normalize(F.lit(v), mode) for v in values]
    return F.when(F.col(column).isNotNull(), F.coalesce(normalize(column, mode).isin(vals), F.lit(False)))


def meaning_counts(df: DataFrame, column: str, predicate: Column) -> DataFrame:
    """Valid / invalid / empty counts of a column against a meaning."""
    return df.agg(
        F.count_if(predicate == F.lit(True)).alias("valid"),
        F.count_if(predicate == F.lit(False)).alias("invalid"),
        F.count_if(F.col(column).isNull()).alias("empty"),
    )


def mapping_meaning(df: DataFrame, column: str, mapping: dict, out: str, mode: str = "EXACT") -> DataFrame:
    """Value-mapping meaning: raw value -> display value (null when unmapped)."""
    keys = {}
    for k, v in mapping.items():
        keys.setdefault(k if mode == "EXACT" else _py_normalize(k, mode), v)
    m = F.create_map(*[F.lit(x) for kv in keys.items() for x in kv])
    return df.withColumn(out, F.try_element_at(m, normalize(column, mode)))


def _py_normalize(s: str, mode: str) -> str:
    if mode.upper() == "LOWERCASE":
        return s.lower()
    table = str.maketrans(ACCENTED, UNACCENTED)
    return "".join(c for c in s.translate(table).lower() if not c.isspace() and not unicodedata.category(c).startswith("M"))


def pattern_meaning(column: str, pattern: str) -> Column:
    """Pattern meaning: the whole value matches the regex (null for null), whether or not it has anchors of its own."""
    anchored = rf"\A(?:{pattern})\z"
    return F.when(F.col(column).isNotNull(), F.col(column).rlike(anchored))


def detect_meaning(df: DataFrame, column: str, meanings: dict[str, Column], sample_fraction: float | None = None,
                   seed: int = 17, key: str | None = None) -> DataFrame:
    """Match ratio of each candidate meaning over non-null values, best first.

    ``sample_fraction`` samples rows, not values: those whose ``key`` has a
    hash under it (the same rows each time), or at random from ``seed``.
    """
    src = df
    if sample_fraction is not None and sample_fraction < 1:
        limit = F.lit(int(sample_fraction * 2.0**64) - 2**63)
        src = df.sample(sample_fraction, seed) if key is None else df.filter(F.xxhash64(F.col(key), F.lit(seed)) < limit)
    nn = F.col(column).isNotNull()
    wide = src.agg(F.count_if(nn).alias("__n"), *[F.count_if(p == F.lit(True)).alias(f"m{i}")
                                                   for i, p in enumerate(meanings.values())])
    rows = wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("meaning"), (F.col(f"m{i}") / F.col("__n")).alias("ratio"))
        for i, name in enumerate(meanings)])).alias("r")).select("r.*")
    return rows.orderBy(F.desc("ratio"), "meaning")


# Q8 reconciliation ---------------------------------------------------------------------
def reconcile(expected: DataFrame, produced: DataFrame, keys, compare=None) -> DataFrame:
    """Keyed comparison: one row per key with its status and the differing columns.

    status: ``missing`` (only expected), ``extra`` (only produced),
    ``changed`` (some compared column differs, null-safe) or ``same``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = list(compare) if compare is not None else [c for c in expected.columns if c not in keys and c in produced.columns]
    e = expected.select(*[F.col(k).alias(f"e_k__{k}") for k in keys], *[F.col(c).alias(f"e__{c}") for c in cols],
                        F.lit(True).alias("__e"))
    p = produced.select(*[F.col(k).alias(f"p_k__{k}") for k in keys], *[F.col(c).alias(f"p__{c}") for c in cols],
                        F.lit(True).alias("__p"))
    # left join and the other side's rest: unlike a full join, both can be split at a hot key
    on = reduce(lambda a, b: a & b, [F.col(f"e_k__{k}").eqNullSafe(F.col(f"p_k__{k}")) for k in keys])
    j = e.join(p, on, "left").unionByName(p.join(e, on, "left_anti"), allowMissingColumns=True)
    diffs = F.filter(F.array(*[F.when(~F.col(f"e__{c}").eqNullSafe(F.col(f"p__{c}")), F.lit(c)) for c in cols]),
                     lambda x: x.isNotNull()) if cols else F.array().cast("array<string>")
    status = (F.when(F.col("__p").isNull(), "missing").when(F.col("__e").isNull(), "extra")
              .when(F.size(diffs) > 0, "changed").otherwise("same"))
    return j.select(*[F.coalesce(F.col(f"e_k__{k}"), F.col(f"p_k__{k}")).alias(k) for k in keys],
                    status.alias("status"),
                    F.when(F.col("__e").isNotNull() & F.col("__p").isNotNull(), F.array_join(diffs, ","))
                    .otherwise(F.lit("")).alias("diff_columns"))


def reconcile_summary(expected: DataFrame, produced: DataFrame, keys, compare=None) -> DataFrame:
    """Row counts of both sides, column-set differences, and status counts."""
    r = reconcile(expected, produced, keys, compare)
    counts = r.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    only_e = sorted(set(expected.columns) - set(produced.columns))
    only_p = sorted(set(produced.columns) - set(expected.columns))
    return counts.withColumns({"columns_only_expected": F.lit(",".join(only_e)),
                               "columns_only_produced": F.lit(",".join(only_p))})
