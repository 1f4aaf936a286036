"""SCD-2 state in hash buckets (M8, S25): a run rewrites what it touches.

Open versions lie in ``buckets`` folders by a hash of their key, closed ones
in one folder per commit that closed any. A run brings changes, not the whole
source: only the buckets of the changed keys are read, met with the changes in
one grouping, and written anew next to the old ones, open and closed versions
by one write of one plan. The pointer of ``sources.published`` makes all of
them visible at once: a run that dies leaves the state as it was, and the same
run again does its work.

Bytes read and written follow the touched buckets, not the state and not the
history. A key has one open version, so no bucket holds a hot one; choose
``buckets`` so that one of them fits a task (keys / buckets rows).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.scd2 import SCD_COLUMNS, version_id
from tidemark.sources import published
from tidemark.sources.landing import drop_table

OPEN, CLOSED, INCOMING = "open", "closed", "incoming"


@dataclass(frozen=True)
class RunResult:
    """What a run did; ``number`` is None when it changed nothing."""

    number: int | None
    opened: int
    closed: int
    touched: int


class BucketedHistory:
    """One stored history. ``key`` and ``updated_at`` as in ``scd2``; ``ties``
    order changes of one key and time within a run."""

    def __init__(self, spark: SparkSession, root: str, key: str, updated_at: str, buckets: int = 16, ties: tuple[str, ...] = ()):
        self.spark, self.root, self.key, self.updated_at, self.ties = spark, root.rstrip("/"), key, updated_at, ties
        held = published.current(spark, self.root)
        self.buckets = held.facts["buckets"] if held else buckets  # fixed by the first run

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def version(self) -> published.Version | None:
        return published.current(self.spark, self.root)

    def read_open(self, version: published.Version | None = None) -> DataFrame | None:
        version = version or self.version()
        return self._folders(version, [p for t, p in version.places.items() if t.startswith(OPEN)]) if version else None

    def read(self, version: published.Version | None = None) -> DataFrame | None:
        """All versions, open and closed, as of the visible commit (or ``version``)."""
        version = version or self.version()
        return self._folders(version, [p for t, p in version.places.items() if t != INCOMING]) if version else None

    def changed(self, version: published.Version | None = None) -> DataFrame | None:
        """The versions that the visible commit (or ``version``) opened or
        closed: what those downstream have to look at."""
        version = version or self.version()
        if version is None:
            return None
        keys = self.spark.read.parquet(f"{self.root}/{version.places[INCOMING]}").select(self.key, self.updated_at)
        own = version.places[INCOMING].rsplit("/", 1)[0] + "/"
        opened = self._folders(version, [p for t, p in version.places.items() if t.startswith(OPEN) and p.startswith(own)])
        closed = self._folders(version, [p for t, p in version.places.items() if t.startswith(CLOSED) and p.startswith(own)])
        return opened.join(keys, [self.key, self.updated_at], "left_semi").unionByName(closed)

    def _folders(self, version: published.Version, places: list[str]) -> DataFrame:
        schema = version.facts["schema"]
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[f"{self.root}/{p}" for p in places])

    def apply(self, changes: DataFrame, label: str) -> RunResult:
        """One run: of each key's changes the latest counts, and only when
        newer than the open version (which it closes); a key without one gets
        one. Rows without key or time are ignored. Nothing newer: no commit,
        so that the same rows again, under the same ``label`` or another,
        change nothing, and new rows under an old label are never lost."""
        before = self.version()
        payload = changes.columns
        cols = [*payload, *SCD_COLUMNS]
        key, at = F.col(self.key), F.col(self.updated_at)
        folder = f"commits/{uuid.uuid4().hex[:12]}"  # named by a pointer or never seen
        path = f"{self.root}/{folder}"
        incoming = latest_per_key(changes.filter(key.isNotNull() & at.isNotNull()), [self.key],
                                  [at.desc(), *[F.col(c).asc_nulls_last() for c in self.ties]])
        incoming.withColumn("bucket", self._bucket()).write.parquet(f"{path}/incoming")
        incoming = self.spark.read.parquet(f"{path}/incoming")
        touched = [r["bucket"] for r in incoming.select("bucket").distinct().collect()]  # at most ``buckets`` rows
        if not touched:
            drop_table(self.spark, path)
            return RunResult(None, 0, 0, 0)
        new = F.struct(*[F.col(c) for c in payload], version_id(self.key, self.updated_at).alias("scd_id"), at.alias("valid_from"),
                       F.lit(None).cast("timestamp").alias("valid_to"))
        both = incoming.select("bucket", F.lit(True).alias("is_new"), key.alias("k"), new.alias("v"))
        if before is not None:
            held = self._folders(before, [before.places[f"{OPEN}/{b}"] for b in touched if f"{OPEN}/{b}" in before.places])
            both = both.unionByName(held.select(self._bucket().alias("bucket"), F.lit(False).alias("is_new"), key.alias("k"),
                                                F.struct(*[F.col(c) for c in cols]).alias("v")))
        # one exchange by bucket serves the grouping and the writing
        met = both.repartition("bucket").groupBy("bucket", "k").agg(
            F.first(F.when(F.col("is_new"), F.col("v")), True).alias("new"), F.first(F.when(~F.col("is_new"), F.col("v")), True).alias("old"))
        old, fresh = F.col("old"), F.col("new")
        newer = old.isNull() | (fresh[self.updated_at] > old[self.updated_at])
        none = F.lit(None).cast(met.schema["new"].dataType)
        replaced = F.coalesce(fresh.isNotNull() & old.isNotNull() & newer, F.lit(False))
        kept = F.when(F.coalesce(fresh.isNotNull() & newer, F.lit(False)), fresh).otherwise(old)
        rows = met.select("bucket", F.explode(F.array(
            F.struct(F.lit(OPEN).alias("state"), kept.alias("v"), F.coalesce(fresh.isNotNull() & newer, F.lit(False)).alias("counts")),
            F.struct(F.lit(CLOSED).alias("state"), F.when(replaced, old.withField("valid_to", fresh[self.updated_at])).otherwise(none).alias("v"),
                     F.lit(True).alias("counts")))).alias("r")).filter("r.v IS NOT NULL")
        seen = Observation()
        (rows.observe(seen, F.count_if((F.col("r.state") == OPEN) & F.col("r.counts")).alias("opened"),
                      F.count_if(F.col("r.state") == CLOSED).alias("closed"))
         .select("bucket", "r.state", "r.v.*").write.partitionBy("state", "bucket").parquet(f"{path}/rows"))
        done = seen.get
        if not done["opened"]:
            drop_table(self.spark, path)
            return RunResult(None, 0, 0, len(touched))
        places = dict(before.places) if before else {}
        places |= {f"{OPEN}/{b}": f"{folder}/rows/state={OPEN}/bucket={b}" for b in touched}
        places[INCOMING] = f"{folder}/incoming"
        if done["closed"]:
            places[f"{CLOSED}/{folder}"] = f"{folder}/rows/state={CLOSED}"
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema["new"].dataType.fields)
        facts = {"label": label, "buckets": self.buckets, "schema": schema, "opened": done["opened"], "closed": done["closed"]}
        held = before.facts if before else {"n_open": 0, "n_all": 0}
        facts |= {"n_open": held["n_open"] + done["opened"] - done["closed"], "n_all": held["n_all"] + done["opened"]}
        version = published.publish(self.spark, self.root, before, places, facts)
        published.clean(self.spark, self.root, "commits")
        return RunResult(version.number, done["opened"], done["closed"], len(touched))
