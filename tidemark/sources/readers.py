"""Source readers (S1-S8) and the nested-record flattener (S3).

Every reader returns a lazy DataFrame; nothing is pulled to the driver.
Readers accept ``since`` (the stored watermark) and push ``wm > since`` into
the scan, so a JDBC source receives it in its WHERE clause and a columnar
source prunes row groups with it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.json_array import read_split_array

# The text tokens a pandas CSV reader turns into nulls by default.
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def as_schema(schema):
    """A schema from a StructType, a DDL string or its JSON form (registry
    files carry JSON)."""
    if isinstance(schema, str) and schema.lstrip().startswith("{"):
        return T.StructType.fromJson(json.loads(schema))
    return schema


def _since_filter(df: DataFrame, column: str | None, since) -> DataFrame:
    """Keep rows strictly newer than the watermark (T17: strict '>')."""
    if since is None or column is None:
        return df
    dtype = df.schema[column].dataType
    return df.filter(F.col(f"`{column}`") > F.lit(since).cast(dtype))


# No real field holds this, so only unquoted empty fields read as NULL.
_NO_NULL_TOKEN = "\u0000"


def read_csv_strings(spark: SparkSession, path: str, null_values: Iterable[str] | None = None,
                     **options) -> DataFrame:
    """CSV with header, every column text.

    An unquoted empty field is NULL, a quoted empty field ``""`` is the
    empty string, so a text export round-trips. ``null_values`` adds tokens
    read as NULL (T21: a pandas reader nulls ``""``, ``NA``, ``null``...,
    see ``PANDAS_NULL_TOKENS``). Quoting is that of RFC 4180: a quote inside
    a quoted field is doubled, a backslash is a plain character. Fields that
    hold line breaks need ``multiLine=True`` (a file is then read whole by
    one task, so it is not the default)."""
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("nullValue", _NO_NULL_TOKEN).option("quote", '"').option("escape", '"'))
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    tokens = list(null_values or [])
    if tokens:
        df = df.select([F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
                        .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    multi_line: bool = True) -> DataFrame:
    """A JSON file holding one array of records.

    ``multi_line=True`` reads a whole file per task (it cannot be split);
    big feeds should arrive as JSON lines and use ``multi_line=False``.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    return reader.json(path)


def _jdbc_reader(spark: SparkSession, cfg: dict, table: str):
    reader = spark.read.format("jdbc").option("url", cfg["url"]).option("dbtable", table)
    for key in ("user", "password", "driver", "fetchsize"):
        if key in cfg:
            reader = reader.option(key, cfg[key])
    return reader


def read_jdbc(spark: SparkSession, cfg: dict, since=None) -> DataFrame:
    """Relational table scan (S4) with the watermark predicate pushed.

    With ``partition_column`` the scan is split into ``num_partitions``
    parallel range queries. Missing bounds are fetched first with one
    pushed-down ``min``/``max`` query (two scalars reach the driver).
    Without a partition column one task reads the table.
    """
    table = cfg["table"]
    reader = _jdbc_reader(spark, cfg, table)
    col = cfg.get("partition_column")
    if col:
        lo, hi = cfg.get("lower_bound"), cfg.get("upper_bound")
        if lo is None or hi is None:
            bounds = f"(SELECT min({col}) AS lo, max({col}) AS hi FROM {table}) b"
            row = _jdbc_reader(spark, cfg, bounds).load().first()
            lo, hi = row["lo"], row["hi"]
        if lo is not None and hi is not None:
            reader = (reader.option("partitionColumn", col)
                      .option("lowerBound", lo).option("upperBound", hi)
                      .option("numPartitions", cfg.get("num_partitions", 64)))
    return _since_filter(reader.load(), cfg.get("watermark"), since)


def read_documents(spark: SparkSession, cfg: dict, since=None) -> DataFrame:
    """Document-store collection scan (S6) with ``{wm: {$gt: since}}``.

    Uses the document-store connector when its jar is on the classpath;
    otherwise the collection's JSON-lines export at ``cfg['path']``.
    ``_id`` is dropped.
    """
    if cfg.get("path") is None:
        df = (spark.read.format("mongodb")
              .option("database", cfg["database"])
              .option("collection", cfg["collection"])
              .load())
    else:
        reader = spark.read
        if cfg.get("schema") is not None:
            reader = reader.schema(as_schema(cfg["schema"]))
        fmt = cfg.get("format", "json")
        df = reader.format(fmt).load(cfg["path"])
    if "_id" in df.columns:
        df = df.drop("_id")
    return _since_filter(df, cfg.get("watermark"), since)


def read_parquet(spark: SparkSession, cfg: dict, since=None) -> DataFrame:
    """Columnar files; the watermark filter reaches the scan as a pushed filter."""
    df = spark.read.option("mergeSchema", True).parquet(cfg["path"])
    return _since_filter(df, cfg.get("watermark"), since)


def _csv(spark, cfg, since=None):
    """A configured CSV source reads as a pandas reader does (T21): its null
    tokens, quoted empty fields among them, and line breaks inside quotes. A
    source that needs neither says so (``null_values: []``, ``multi_line:
    false``); its files are then split among tasks."""
    return read_csv_strings(spark, cfg["path"], cfg.get("null_values", PANDAS_NULL_TOKENS), multiLine=cfg.get("multi_line", True))


def _rest(spark, cfg, since=None):
    """A JSON array; with a ``schema`` its files are split among tasks
    (``sources.json_array``), without one a file is one task's, since the
    schema is inferred. ``multi_line: false`` says that it is JSON lines."""
    if cfg.get("schema") is not None and cfg.get("multi_line", True):
        return read_split_array(spark, cfg["path"], as_schema(cfg["schema"]))
    return read_json_array(spark, cfg["path"], cfg.get("schema"), cfg.get("multi_line", True))


# connector type -> reader
READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": _csv,
    "rest": _rest,
    "jdbc": read_jdbc,
    "mongodb": read_documents,
    "parquet": read_parquet,
}


def read_source(spark: SparkSession, cfg: dict, since=None) -> DataFrame:
    kind = cfg["type"]
    if kind not in READERS:
        raise ValueError(f"Unknown type '{kind}'")
    return READERS[kind](spark, cfg, since)


def _leaves(dtype: T.StructType, prefix: list[str]) -> list[tuple[list[str], T.DataType]]:
    out = []
    for field in dtype.fields:
        path = prefix + [field.name]
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            out.extend(_leaves(field.dataType, path))
        else:
            out.append((path, field.dataType))
    return out


def _ref(path: list[str]) -> Column:
    c = F.col(f"`{path[0]}`")
    for name in path[1:]:
        c = c.getField(name)
    return c


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> one column per leaf named ``a.b.c``.

    Arrays and maps are kept as single columns. Dotted names need
    back-ticks when referenced (``col("`a.b`")``).
    """
    return df.select([_ref(p).alias(sep.join(p)) for p, _ in _leaves(df.schema, [])])
