"""Sources and sinks.

Readers return lazy DataFrames (schema inference aside); writers are the
only actions. Bounded extraction helpers always ``limit`` before collecting.
"""

from __future__ import annotations

import csv
import io
import re
import uuid
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir


# S1-S3 -------------------------------------------------------------------------
def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True, infer_types: bool = True,
                   schema: StructType | str | None = None, **options) -> DataFrame:
    """Delimited text with a header row; types detected unless a schema is given.

    Inference reads the data once more; for large inputs pass ``schema``.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer_types).csv(path)


def read_with_schema(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options) -> DataFrame:
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


def read(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Parquet / ORC / JSON / CSV by format name."""
    return spark.read.format(fmt).options(**options).load(path)


# S4 ----------------------------------------------------------------------------
def read_table(spark: SparkSession, name: str, catalog: str | None = None, schema: str | None = None) -> DataFrame:
    """An existing catalog table ``[catalog.][schema.]table``."""
    parts = [p for p in (catalog, schema, name) if p]
    return spark.table(".".join(f"`{p}`" for p in parts))


def read_jdbc(spark: SparkSession, url: str, table_name: str, properties: dict, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """An external SQL table, read in parallel ranges of ``partition_column`` when given."""
    if partition_column:
        return spark.read.jdbc(url, table_name, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table_name, properties=properties)


# S5 ----------------------------------------------------------------------------
def inline_table(spark: SparkSession, columns: list[str], rows: Iterable[Iterable]) -> DataFrame:
    """TextInput: literal rows, every column a string (cast later with change_types)."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    data = [tuple(None if v is None else str(v) for v in r) for r in rows]
    return spark.createDataFrame(data, schema)


# S6, S7, S9, S12 ------------------------------------------------------------------------
def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None, **options) -> None:
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Managed dataset / CTAS with drop-if-exists (overwrite)."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def upper_case_names(df: DataFrame) -> DataFrame:
    """Upper-case column names, refusing two names that collide."""
    new = [c.upper() for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError("column names collide when upper-cased")
    return df.toDF(*new)


def sync(df: DataFrame, path: str, fmt: str = "parquet", upper_case: bool = False, mode: str = "overwrite") -> None:
    """Copy a table to another store, optionally with upper-case column names."""
    write(upper_case_names(df) if upper_case else df, path, fmt, mode)


def append_to(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """PROC APPEND to a stored dataset."""
    write(df, path, fmt, mode="append")


# S8 -----------------------------------------------------------------------------------
def resolve_variables(global_vars: dict | None = None, standard: dict | None = None, local: dict | None = None) -> dict:
    """Project variables: local over standard over global."""
    out: dict = {}
    for d in (global_vars, standard, local):
        out.update(d or {})
    return out


_VAR = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")


def sql_step(spark: SparkSession, query: str, views: dict[str, DataFrame] | None = None, args: dict | None = None,
             variables: dict | None = None) -> DataFrame:
    """SQL as a step.

    ``${name}`` naming a key of ``views`` becomes ``IDENTIFIER(:param)`` bound
    to a fresh temp view; other ``${var}`` become named parameters bound to
    ``variables``. Nothing is pasted into the SQL text as a value.
    """
    params = dict(args or {})
    views = views or {}
    variables = variables or {}
    tag = uuid.uuid4().hex[:10]

    def sub(m: re.Match) -> str:
        name = m.group(1)
        if name in views:
            vname = f"tessera_{name}_{tag}"
            views[name].createOrReplaceTempView(vname)
            params[f"view_{name}"] = vname
            return f"IDENTIFIER(:view_{name})"
        if name in variables:
            params[f"var_{name}"] = variables[name]
            return f":var_{name}"
        raise KeyError(f"no view or variable named {name!r}")

    return spark.sql(_VAR.sub(sub, query), args=params or None)


# SQL dialect functions accepted in SQL steps, as (name, signature, Spark body).
DIALECT_FUNCTIONS = [
    ("safe_divide", "a DOUBLE, b DOUBLE", "DOUBLE", "try_divide(a, b)"),
    ("div0", "a DOUBLE, b DOUBLE", "DOUBLE", "CASE WHEN b = 0 THEN 0D ELSE a / b END"),
]


def register_dialect_functions(spark: SparkSession) -> None:
    """Make common warehouse-dialect functions available to SQL steps.

    They are SQL functions (inlined by the analyzer), not Python UDFs.
    ``x::type`` casts, ``STRUCT(a, b)``, back-quoted names, ``zeroifnull`` and
    ``nullifzero`` are native; a name Spark already defines is left alone.
    """
    builtin = {r[0].split(".")[-1] for r in spark.sql("SHOW SYSTEM FUNCTIONS").collect()}
    for name, params, ret, body in DIALECT_FUNCTIONS:
        if name not in builtin:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")


# S10, S11 -----------------------------------------------------------------------------
def write_partitioned(df: DataFrame, path: str, discrete=(), time_column: str | None = None, period: str = "DAY",
                      fmt: str = "parquet", dynamic_overwrite: bool = True) -> None:
    """Partitioned dataset: discrete dimensions plus an optional time dimension.

    The time dimension is a ``{period}`` column (``YYYY``, ``YYYY-MM`` or
    ``YYYY-MM-DD`` text). Dynamic overwrite replaces only the partitions written.
    """
    cols = list(discrete)
    if time_column:
        fmt_map = {"YEAR": "yyyy", "MONTH": "yyyy-MM", "DAY": "yyyy-MM-dd", "HOUR": "yyyy-MM-dd-HH"}
        name = period.lower()
        df = df.withColumn(name, F.date_format(F.col(time_column), fmt_map[period.upper()]))
        cols.append(name)
    w = df.write.mode("overwrite").format(fmt).partitionBy(*cols)
    if dynamic_overwrite:
        # per-write option: the session setting stays untouched
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys, sort: bool = True,
                   fmt: str = "parquet") -> None:
    """Store a table bucketed (and sorted) on ``keys`` at ``path``, registered as ``name``.

    Tables bucketed on the same keys with the same bucket count join without
    a shuffle (co-located sort-merge join), which pays off when a large table
    is joined on the same key again and again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = df.write.mode("overwrite").format(fmt).option("path", path).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(name)


def read_folder(spark: SparkSession, path: str, fmt: str = "parquet", source_column: str | None = "source_file",
                **options) -> DataFrame:
    """A table over a folder of files; partition folders become columns."""
    df = spark.read.format(fmt).options(**options).load(path)
    if source_column:
        df = df.withColumn(source_column, F.col("_metadata.file_path"))
    return df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


# S13, S14 ------------------------------------------------------------------------------
def head_records(df: DataFrame, limit: int = 100) -> list[dict]:
    """Bounded extraction of records as dicts."""
    return [r.asDict(recursive=True) for r in df.limit(limit).collect()]


def column_names(df: DataFrame) -> list[str]:
    return list(df.columns)


def schema_of(df: DataFrame) -> list[dict]:
    return [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema.fields]


def to_csv_string(df: DataFrame, limit: int = 100, sep: str = ",") -> str:
    """CSV text of at most ``limit`` rows, header first."""
    buf = io.StringIO()
    w = csv.writer(buf, delimiter=sep, lineterminator="\n")
    w.writerow(df.columns)
    for r in df.limit(limit).collect():
        w.writerow(["" if v is None else v for v in r])
    return buf.getvalue()


def write_csv(df: DataFrame, path: str, limit: int | None = None, sep: str = ",") -> None:
    """Export as CSV files with a header, optionally bounded by ``limit`` rows."""
    out = df.limit(limit) if limit else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
