"""Bronze landing.

A bronze table is a folder of Parquet files under a warehouse root (itself
under the cluster's shared folder). Every column is text, plus the lineage
columns ``_source`` and ``_ingested_at``.

Watermarks: a batch's high-water mark lies in a small side table inside the
table folder (``_tidemark_watermark``; names starting with ``_`` are invisible
to the Parquet reader). Rows and watermark are staged together next to the
table and become part of it by one marker file; a crash before the marker
leaves neither, a crash after it is rolled forward by the next run. Without
a side table the watermark is derived from the data itself.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedupe import latest_per_key
from tidemark.sources.readers import flatten, read_source

WATERMARK_DIR = "_tidemark_watermark"
COMMIT_MARKER = "_tidemark_commit"


# ---------------------------------------------------------------- file system
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table exists when its folder holds at least one data file."""
    if not path_exists(spark, path):
        return False
    fs, p = _fs(spark, path)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def drop_table(spark: SparkSession, path: str) -> None:
    """DROP TABLE IF EXISTS."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _swap(spark: SparkSession, stage: str, path: str) -> None:
    """Replace ``path`` by the complete folder ``stage``.

    Steps: move the old table aside (``path__old``), rename the stage in,
    carry the watermark side table over, delete the old table. Every
    intermediate state is recognised by ``recover_table``: a crash leaves
    either the old table or the new one, never none.
    """
    jvm = spark.sparkContext._jvm
    fs, dst = _fs(spark, path)
    _, src = _fs(spark, stage)
    old = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "__old")
    if fs.exists(old):
        fs.delete(old, True)
    if fs.exists(dst):
        fs.rename(dst, old)
    fs.rename(src, dst)
    _finish_swap(spark, path)


def _finish_swap(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    fs, dst = _fs(spark, path)
    old = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "__old")
    if not fs.exists(old):
        return
    wm_old = jvm.org.apache.hadoop.fs.Path(old, WATERMARK_DIR)
    wm_new = jvm.org.apache.hadoop.fs.Path(dst, WATERMARK_DIR)
    if fs.exists(wm_old) and not fs.exists(wm_new):
        fs.rename(wm_old, wm_new)
    fs.delete(old, True)


def _commit_batch(spark: SparkSession, path: str) -> None:
    """Make the staged batch ``path__batch``, rows and watermark, part of the
    table: writing the marker is the commit, moving the files follows it."""
    fs, marker = _fs(spark, path.rstrip("/") + "__batch/" + COMMIT_MARKER)
    fs.create(marker, True).close()
    _finish_batch(spark, path)


def _finish_batch(spark: SparkSession, path: str) -> None:
    """Move a committed batch's files into the table. File names are unique
    to their write, so doing it again after a crash moves what is left."""
    jvm = spark.sparkContext._jvm
    fs, dst = _fs(spark, path)
    batch = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "__batch")
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(batch, COMMIT_MARKER)):
        return
    for src, to in ((batch, dst), (jvm.org.apache.hadoop.fs.Path(batch, WATERMARK_DIR),
                                   jvm.org.apache.hadoop.fs.Path(dst, WATERMARK_DIR))):
        if not fs.exists(src):
            continue
        fs.mkdirs(to)
        for st in fs.listStatus(src):
            name = st.getPath().getName()
            if not name.startswith(("_", ".")):
                if not fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(to, name)):
                    raise OSError(f"cannot move {st.getPath().toString()} into {path}")
    fs.delete(batch, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Complete or roll back a write interrupted by a crash: a committed batch
    is moved in; a committed stage (its ``_SUCCESS`` marker written) replaces
    a missing table, otherwise the old table is put back; leftovers are removed."""
    jvm = spark.sparkContext._jvm
    fs, dst = _fs(spark, path)
    base = path.rstrip("/")
    old = jvm.org.apache.hadoop.fs.Path(base + "__old")
    stage = jvm.org.apache.hadoop.fs.Path(base + "__stage")
    if not fs.exists(dst):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(stage, "_SUCCESS")):
            fs.rename(stage, dst)
        elif fs.exists(old):
            fs.rename(old, dst)
    if fs.exists(dst):
        _finish_swap(spark, path)
    _finish_batch(spark, path)


# ---------------------------------------------------------------- transforms
def to_strings(df: DataFrame) -> DataFrame:
    """Flatten and cast every column to text for landing (S3 + S10).

    Arrays and maps become JSON text."""
    flat = flatten(df)
    cols = []
    for f in flat.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        cols.append(c.cast("string").alias(f.name))
    return flat.select(cols)


def run_timestamp_text(run_ts=None) -> str:
    """ISO-8601 UTC text for one run (one value for the whole batch)."""
    if run_ts is None:
        run_ts = _dt.datetime.now(_dt.timezone.utc)
    if isinstance(run_ts, str):
        return run_ts
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=_dt.timezone.utc)
    return run_ts.astimezone(_dt.timezone.utc).isoformat()


def with_lineage(df: DataFrame, source: str, run_ts) -> DataFrame:
    """Add ``_source`` and ``_ingested_at`` (S11). ``run_ts`` may be a Column
    when rows of several simulated runs are built at once."""
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_timestamp_text(run_ts))
    return df.withColumns({"_source": F.lit(source), "_ingested_at": ts.cast("string")})


def to_bronze(df: DataFrame, source: str, run_ts) -> DataFrame:
    return with_lineage(to_strings(df), source, run_ts)


# ---------------------------------------------------------------- tables
def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a landed table; files of different column sets are merged by
    name, missing columns read as NULL (S13)."""
    return spark.read.option("mergeSchema", True).parquet(path)


def land(spark: SparkSession, df: DataFrame, path: str, mode: str = "append",
         key: list[str] | str | None = None, order_by: str = "_ingested_at") -> None:
    """Write a batch to a bronze table.

    * ``append`` (S15): new files next to the old ones; new columns appear
      at read time through schema merge, old files read them as NULL.
    * ``overwrite`` (S14): the folder is replaced by the batch.
    * ``upsert`` (E1): keyed replace on ``key``, one row per key. Staged,
      then swapped in, because the table is read while it is rewritten.
    """
    if mode == "append":
        df.write.mode("append").parquet(path)
    elif mode == "overwrite":
        df.write.mode("overwrite").parquet(path)
    elif mode == "upsert":
        if key is None:
            raise ValueError("upsert needs a key")
        keys = [key] if isinstance(key, str) else list(key)
        recover_table(spark, path)
        if not table_exists(spark, path):
            upsert_frames(None, df, keys, order_by).write.mode("overwrite").parquet(path)
            return
        merged = upsert_frames(read_table(spark, path), df, keys, order_by)
        stage = path.rstrip("/") + "__stage"
        drop_table(spark, stage)
        merged.write.mode("overwrite").parquet(stage)
        _swap(spark, stage, path)
    else:
        raise ValueError(f"unknown load mode '{mode}'")


def upsert_frames(existing: DataFrame | None, batch: DataFrame, keys: list[str],
                  order_by: str = "_ingested_at") -> DataFrame:
    """One row per key (E1): the batch's row where it has the key, of several
    the one of latest ``order_by``, then of least other values; NULL is a key
    value like any other. Reduced to one row per key and map task before the
    one shuffle."""
    both = batch.withColumn("_new", F.lit(1))
    if existing is not None:
        both = existing.withColumn("_new", F.lit(0)).unionByName(both, allowMissingColumns=True)
    ties = [c for c in both.columns if c not in (*keys, "_new", order_by)]
    order = [F.col("_new").desc(), *([F.col(f"`{order_by}`").desc_nulls_last()] if order_by in both.columns else []),
             *[F.col(f"`{c}`").asc_nulls_last() for c in ties]]
    return latest_per_key(both, [F.col(f"`{k}`") for k in keys], order).drop("_new")


# ---------------------------------------------------------------- watermark
def read_watermark(spark: SparkSession, path: str, column: str | None = None):
    """Stored high-water mark of a table, or None when the table is missing.

    Falls back to ``max(try_cast(column as timestamp))`` over the table."""
    if not table_exists(spark, path):
        return None
    side = path.rstrip("/") + "/" + WATERMARK_DIR
    if path_exists(spark, side):
        # the largest, compared as time or number where it is one: text order is neither
        wm = F.col("watermark")
        row = (spark.read.parquet(side)
               .orderBy(wm.try_cast("timestamp").desc_nulls_last(), wm.try_cast("decimal(38,6)").desc_nulls_last(),
                        wm.desc()).select("watermark").first())
        if row is not None:
            return row[0]
    if column is None:
        return None
    return watermark_of(read_table(spark, path), column)


def watermark_of(df: DataFrame, column: str):
    """max of the column as text (S17), rendered by Spark in the session
    zone, so the later ``wm > since`` comparison reads it back the same way.
    Text columns are compared as timestamps when they parse as such."""
    return _highest(df.agg(*_highest_measures(df, column)).first().asDict())


def _highest_measures(df: DataFrame, column: str) -> list[Column]:
    c = F.col(f"`{column}`")
    text = F.max(c).cast("string").alias("highest")
    if not isinstance(df.schema[column].dataType, T.StringType):
        return [text]
    return [F.max(c.try_cast("timestamp")).cast("string").alias("highest_time"), text]


def _highest(measured: dict):
    at = measured.get("highest_time")
    return at if at is not None else measured.get("highest")


def _write_watermark(spark: SparkSession, path: str, run_ts: str, watermark: str) -> None:
    side = path.rstrip("/") + "/" + WATERMARK_DIR
    (spark.createDataFrame([(run_ts, watermark)], "run_ts string, watermark string")
     .coalesce(1).write.mode("append").parquet(side))


# ---------------------------------------------------------------- ingest
def ingest_source(spark: SparkSession, name: str, cfg: dict, warehouse: str,
                  run_ts=None, lookback=None) -> int:
    """Land one configured source; returns the number of landed rows.

    ``incremental`` reads the stored watermark, pulls ``wm > since``
    (``since - lookback`` when a lookback is given, E6). Rows are counted and
    the new watermark is taken from the typed batch, before the text cast,
    while the batch is written (S17, E5): the source is read once. An empty
    batch leaves the table as it is, in every mode (T18). A full load keeps
    columns that the source has lost, as NULL (S13).
    """
    mode = cfg.get("load_mode", "full")
    path = table_path(warehouse, cfg["target_bronze"])
    recover_table(spark, path)
    since = read_watermark(spark, path, cfg.get("watermark")) if mode == "incremental" else None
    if since is not None and lookback is not None:
        since = str(_dt.datetime.fromisoformat(str(since)) - lookback)
    batch = read_source(spark, cfg, since=since)
    run_text = run_timestamp_text(run_ts)
    seen = Observation(f"landed_{name}")
    measures = [F.count(F.lit(1)).alias("rows")]
    if mode == "incremental":
        measures += _highest_measures(batch, cfg["watermark"])
    rows = to_bronze(batch.observe(seen, *measures), name, run_text)
    if mode == "upsert":
        if not cfg.get("primary_key"):
            raise ValueError("upsert needs a key")
        keys = cfg["primary_key"]
        rows = upsert_frames(read_table(spark, path) if table_exists(spark, path) else None, rows,
                             [keys] if isinstance(keys, str) else list(keys))
    elif mode == "full" and table_exists(spark, path):
        lost = [c for c in read_table(spark, path).columns if c not in rows.columns]
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in lost}) if lost else rows
    stage = path.rstrip("/") + ("__batch" if mode == "incremental" else "__stage")
    drop_table(spark, stage)
    rows.write.parquet(stage)
    measured = seen.get
    landed = int(measured.get("rows", 0))
    if not landed:
        drop_table(spark, stage)
    elif mode == "incremental":
        highest = _highest(measured)
        if highest is not None:
            _write_watermark(spark, stage, run_text, highest)
        _commit_batch(spark, path)
    else:
        _swap(spark, stage, path)
    return landed


def table_path(warehouse: str, identifier: str) -> str:
    """``bronze.crm_contacts`` -> ``<warehouse>/bronze/crm_contacts``."""
    return warehouse.rstrip("/") + "/" + identifier.replace(".", "/")


def ingest(spark: SparkSession, registry: dict, warehouse: str, names=None,
           run_ts=None, lookback=None) -> dict[str, int]:
    """Run one, several or all configured sources, one after the other."""
    chosen = registry if names is None else {n: registry[n] for n in names}
    return {name: ingest_source(spark, name, cfg, warehouse, run_ts, lookback)
            for name, cfg in chosen.items()}


def reset(spark: SparkSession, registry: dict, warehouse: str, only_incremental: bool = True) -> None:
    """Drop the (incremental) bronze tables so the next run reloads from an
    empty watermark (S26-S28)."""
    for cfg in registry.values():
        if only_incremental and cfg.get("load_mode") != "incremental":
            continue
        drop_table(spark, table_path(warehouse, cfg["target_bronze"]))
