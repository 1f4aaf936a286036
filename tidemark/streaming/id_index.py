"""Which folders of a target may hold an id (X2): Bloom filters per bucket.

A target lies in ``run=<run>/_bucket=<b>`` folders by a hash of the id. For
every run and bucket one small bit field is kept under ``<target>/_ids``
(readers of the target do not see it). A trigger meets its ids with the bit
fields of their buckets and reads the ids of those folders only that may hold
one: bytes read of the target follow the copies that a trigger brings, not the
target. A filter never misses an id; that it names a folder in vain happens
once in some 170,000 probes of a folder (``BITS`` per id, ``HASHES`` probes), and
costs that folder's ids, not a row. The ids themselves decide.

The bit fields take 4 to 8 bytes an id, and those of a bucket (all runs) are
one group's memory: choose ``buckets`` so that a bucket stays below some ten
million ids. They become visible with a pointer (``sources.published``) after
their rows; a run folder without them, left by a crash, is read in full. The
bit fields of many runs are gathered into one folder now and then, so that
small files do not pile up.
"""

from __future__ import annotations

import uuid
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import published
from tidemark.sources.landing import _fs, drop_table, path_exists

BITS = 32             # bits per id at least
HASHES = 8
IDS_PER_FILTER = 1 << 20
FILTER_FOLDERS = 32   # more of them are gathered into one
PART = "_bucket"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
FILTER = "run string, bucket int, n_bits long, bits binary, place string"


def id_hash(key: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`").cast("string"))


def bit(h: np.ndarray, probe: int, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and place in it of a hash's bit number ``probe`` in a field of 2^k bits."""
    p = (h + np.uint64(probe) * ((h >> np.uint64(32)) | np.uint64(1))) & np.uint64(n_bits - 1)
    return (p >> np.uint64(3)).astype(np.int64), (p & np.uint64(7)).astype(np.uint8)


def bit_field(h: np.ndarray) -> tuple[int, bytes]:
    n_bits = max(64, 1 << int(BITS * len(h) - 1).bit_length())
    field = np.zeros(n_bits >> 3, dtype=np.uint8)
    for probe in range(HASHES):
        byte, place = bit(h, probe, n_bits)
        np.bitwise_or.at(field, byte, np.left_shift(np.uint8(1), place))
    return n_bits, field.tobytes()


def may_hold(h: np.ndarray, n_bits: int, bits: bytes) -> bool:
    """Whether any of the hashed ids may be among those of the field."""
    field = np.frombuffer(bits, dtype=np.uint8)
    for probe in range(HASHES):
        byte, place = bit(h, probe, n_bits)
        h = h[((field[byte] >> place) & 1).astype(bool)]
        if not len(h):
            return False
    return True


def _fields(keys: tuple, rows: pa.Table) -> pa.Table:
    n_bits, bits = bit_field(rows["h"].to_numpy().astype(np.uint64))
    return pa.table({"run": rows["run"].slice(0, 1), "bucket": rows["bucket"].slice(0, 1), "n_bits": pa.array([n_bits], pa.int64()),
                     "bits": pa.array([bits], pa.binary()), "place": rows["place"].slice(0, 1)})


def _named(keys: tuple, ids: pa.Table, fields: pa.Table) -> pa.Table:
    h = ids["h"].to_numpy().astype(np.uint64)
    runs = sorted({f["run"] for f in fields.to_pylist() if len(h) and may_hold(h, f["n_bits"], f["bits"])})
    return pa.table({"run": pa.array(runs, pa.string()), "bucket": pa.array([keys[0].as_py()] * len(runs), pa.int32())})


class IdIndex:
    """The bit fields of one target, whose folders are named ``<by>=<run>``.
    ``buckets`` is fixed by the first run."""

    def __init__(self, spark: SparkSession, target: str, key: str, buckets: int = 16, by: str = "run"):
        self.spark, self.target, self.key, self.by = spark, target.rstrip("/"), key, by
        self.root = f"{self.target}/_ids"
        self.version = published.current(spark, self.root)
        self.buckets = self.version.facts["buckets"] if self.version else buckets

    def bucket(self) -> Column:
        return F.pmod(id_hash(self.key), F.lit(self.buckets)).cast("int")

    def _places(self) -> dict[str, str]:
        return dict(self.version.places) if self.version else {}

    def fields(self, without: str | None = None) -> DataFrame | None:
        """The valid bit fields (those of the folder that the pointer names for
        a run), those of the run ``without`` left out."""
        valid = {r: p for r, p in self._places().items() if r != without}
        if not valid:
            return None
        rows = self.spark.read.schema(FILTER).parquet(*[f"{self.root}/{p}" for p in sorted(set(valid.values()))])
        return rows.join(self.spark.createDataFrame(list(valid.items()), "run string, place string"), ["run", "place"], "left_semi")

    def unknown(self) -> list[str]:
        """Runs with a folder and without bit fields."""
        if not path_exists(self.spark, self.target):
            return []
        fs, p = _fs(self.spark, self.target)
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted({n[len(self.by) + 1:] for n in names if n.startswith(f"{self.by}=")} - set(self._places()))

    def named(self, batch: DataFrame, without: str | None = None) -> list[tuple[str, int]]:
        """Run and bucket of what may hold an id of ``batch``: at most one for
        each folder there is."""
        fields = self.fields(without)
        if fields is None:
            return []
        ids = batch.select(self.bucket().alias("bucket"), id_hash(self.key).alias("h"))
        found = ids.groupBy("bucket").cogroup(fields.groupBy("bucket")).applyInArrow(_named, "run string, bucket int")
        return sorted((r["run"], r["bucket"]) for r in found.collect())

    def folders(self, batch: DataFrame, run: str) -> list[str]:
        """Folders of other runs that may hold an id of ``batch``: one name for
        each that does, and a run's whole folder where it has no bit fields."""
        return ([f"{self.target}/{self.by}={r}" for r in self.unknown() if r != run]
                + [f"{self.target}/{self.by}={r}/{PART}={b}" for r, b in self.named(batch, run)])

    def missing(self, batch: DataFrame, run: str) -> DataFrame:
        """The rows of ``batch`` whose id no other run's folder holds."""
        folders = self.folders(batch, run)
        if not folders:
            return batch
        held = self.spark.read.schema(batch.select(self.key).schema).option("recursiveFileLookup", True).parquet(*folders)
        held = held.select(F.col(self.key).alias("_held"))
        return batch.join(held, F.col(self.key).eqNullSafe(F.col("_held")), "left_anti")

    def add(self, rows: DataFrame, run: str) -> int:
        """Write a run's rows and then their bit fields; the number of rows.
        A run that is written again loses its old bit fields first."""
        self.forget([run])
        path = f"{self.target}/{self.by}={run}"
        seen = Observation()
        (rows.withColumn(PART, self.bucket()).hint("rebalance", PART).observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").partitionBy(PART).parquet(path))
        n = seen.get["n"]
        if not n:
            drop_table(self.spark, path)    # a folder without rows has no schema to read
            return 0
        self.record(self.spark.read.parquet(path).withColumn(self.by, F.lit(run)), [run], n)
        return n

    def forget(self, runs: list[str]) -> None:
        """The runs' folders are about to change: read them in full until ``record``."""
        places = self._places()
        if set(runs) & set(places):
            self._publish({r: p for r, p in places.items() if r not in runs})

    def record(self, rows: DataFrame, runs: list[str], largest: int) -> None:
        """Bit fields of what the folders of ``runs`` now hold, ``rows`` (with
        the column ``by``); ``largest``: rows of the largest of them."""
        parts = 1 + largest // (self.buckets * IDS_PER_FILTER)
        place = f"fields/{uuid.uuid4().hex[:12]}"
        ids = rows.select(F.coalesce(F.col(self.by).cast("string"), F.lit(NULL_FOLDER)).alias("run"), self.bucket().alias("bucket"),
                          id_hash(self.key).alias("h"), F.lit(place).alias("place"))
        ids = ids.withColumn("part", F.pmod(F.shiftrightunsigned("h", 40), F.lit(parts)))
        ids.groupBy("run", "bucket", "part").applyInArrow(_fields, FILTER).write.parquet(f"{self.root}/{place}")
        self._publish(self._places() | dict.fromkeys(runs, place))
        if len(set(self.version.places.values())) > FILTER_FOLDERS:
            self.gather()

    def gather(self) -> None:
        """All valid bit fields in one folder."""
        place = f"fields/{uuid.uuid4().hex[:12]}"
        self.fields().withColumn("place", F.lit(place)).repartition("bucket").write.parquet(f"{self.root}/{place}")
        self._publish(dict.fromkeys(self.version.places, place))

    def _publish(self, places: dict[str, str]) -> None:
        self.version = published.publish(self.spark, self.root, self.version, places, {"buckets": self.buckets})
        published.clean(self.spark, self.root, "fields")
