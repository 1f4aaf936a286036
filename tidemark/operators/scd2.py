"""Slowly-changing history of subscriptions.

Timestamp strategy on ``key``/``updated_at``:

* a key never seen opens a version (``valid_from = updated_at``);
* a strictly newer ``updated_at`` closes the open version at that time and
  opens a new one;
* anything else (same or older ``updated_at``) changes nothing;
* keys that vanish from the source stay open.

``states_at`` looks up the versions valid at many instants at once.

``snapshot_timestamp`` applies one run to a previous snapshot (a full outer
join of the open versions with the source, both unique per key).
``history_from_log`` rebuilds the same table in one pass from the
append-only change log; with ``batch`` it reproduces exactly what a run per
batch would have produced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.sequence import next_within_key

SCD_COLUMNS = ["scd_id", "valid_from", "valid_to"]
#: instants that ``states_at`` broadcasts
FEW = 100_000


def version_id(key: str, updated_at: str) -> Column:
    """Version key: md5 of ``key|updated_at micros`` (F25); unique per
    (key, updated_at)."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"),
                             F.unix_micros(F.col(updated_at)).cast("string")))


def _with_scd(df: DataFrame, key: str, updated_at: str, valid_to: Column) -> DataFrame:
    return df.withColumns({
        "scd_id": version_id(key, updated_at),
        "valid_from": F.col(updated_at),
        "valid_to": valid_to,
    })


def snapshot_changes(open_rows: DataFrame | None, source: DataFrame, key: str,
                     updated_at: str) -> tuple[DataFrame, DataFrame]:
    """One run against the open versions only: returns (open versions after
    the run, versions closed by the run). Closed history is not read, so a
    run costs O(keys), not O(history)."""
    payload = source.columns
    cols = [*payload, *SCD_COLUMNS]
    if open_rows is None:
        opened = _with_scd(source, key, updated_at, F.lit(None).cast("timestamp")).select(cols)
        return opened, opened.limit(0)
    o = open_rows.select([F.col(c).alias(f"o__{c}") for c in cols])
    s = source.select([F.col(c).alias(f"s__{c}") for c in payload])
    j = o.join(s, F.col(f"o__{key}") == F.col(f"s__{key}"), "full_outer")
    o_upd, s_upd = F.col(f"o__{updated_at}"), F.col(f"s__{updated_at}")
    has_o, has_s = F.col(f"o__{key}").isNotNull(), F.col(f"s__{key}").isNotNull()
    newer = has_o & has_s & (s_upd > o_upd)
    kept_open = j.filter(has_o & ~F.coalesce(newer, F.lit(False))).select(
        [F.col(f"o__{c}").alias(c) for c in cols])
    closing = j.filter(newer).select(
        *[F.col(f"o__{c}").alias(c) for c in payload],
        F.col("o__scd_id").alias("scd_id"), F.col("o__valid_from").alias("valid_from"),
        s_upd.alias("valid_to"))
    opened = _with_scd(
        j.filter(newer | (has_s & ~has_o)).select([F.col(f"s__{c}").alias(c) for c in payload]),
        key, updated_at, F.lit(None).cast("timestamp")).select(cols)
    return kept_open.unionByName(opened), closing.select(cols)


def snapshot_timestamp(previous: DataFrame | None, source: DataFrame, key: str,
                       updated_at: str) -> DataFrame:
    """One snapshot run (M8). ``previous`` is the snapshot so far (or None
    on the first run); ``source`` has one row per key (silver)."""
    if previous is None:
        return snapshot_changes(None, source, key, updated_at)[0]
    closed = previous.filter(F.col("valid_to").isNotNull())
    opened, closing = snapshot_changes(previous.filter(F.col("valid_to").isNull()), source, key, updated_at)
    return closed.select(opened.columns).unionByName(opened).unionByName(closing)


def history_from_log(log: DataFrame, key: str, updated_at: str,
                     batch: str | None = None,
                     tie_break: Sequence[str] = (),
                     partitions: int | None = None) -> DataFrame:
    """The snapshot table rebuilt from a change log in one pass.

    With ``batch`` (the landing run), only the latest change of each run
    counts, and a run's change counts only when newer than every earlier
    run's: exactly the result of applying ``snapshot_timestamp`` run by
    run. Without ``batch`` every distinct (key, updated_at) is a version.
    ``valid_to`` is the next version's ``valid_from``.

    Skew. The first step is a top-1 per (key, run) (or per (key, time)),
    reduced map-side before its shuffle, so a key holding a third of the
    log leaves each map task as one row per run. With ``batch`` a key then
    has at most one row per landing run, a bound set by the schedule, not
    by the data: two windows over the key (one shuffle) finish the job.
    Without ``batch`` the number of versions per key is unbounded, so the
    next version comes from ``sequence.next_within_key``, which splits a hot
    key by time.
    """
    order_tail = [F.col(c).asc_nulls_last() for c in tie_break]
    df = log.filter(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    if batch is not None:
        df = latest_per_key(df, [key, batch], [F.col(updated_at).desc()] + order_tail)
        payload = [c for c in df.columns if c != batch]
        earlier = (Window.partitionBy(key).orderBy(F.col(batch).asc())
                   .rowsBetween(Window.unboundedPreceding, -1))
        kept = (df.withColumn("_prev_max", F.max(updated_at).over(earlier))
                .filter(F.col("_prev_max").isNull() | (F.col(updated_at) > F.col("_prev_max"))))
        nxt = F.lead(F.col(updated_at)).over(Window.partitionBy(key).orderBy(F.col(updated_at)))
        return _with_scd(kept.select(payload), key, updated_at, nxt).select(*payload, *SCD_COLUMNS)

    df = latest_per_key(df, [key, updated_at], order_tail)
    payload = list(df.columns)
    out = next_within_key(df, key, updated_at, "_valid_to", partitions)
    return _with_scd(out, key, updated_at, F.col("_valid_to")).select(*payload, *SCD_COLUMNS)


def state_as_of(history: DataFrame, as_of) -> DataFrame:
    """The version valid at ``as_of`` (J10, N6): ``valid_from <= as_of <
    valid_to`` (open versions have no end). A filter: no shuffle."""
    t = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return history.filter((F.col("valid_from") <= t)
                          & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def states_at(history: DataFrame, instants: DataFrame, at: str, by: Sequence[str] = (), days: int = 31,
              spread: int = 32) -> DataFrame:
    """The versions valid at each of many instants (J10, N6): every row of
    ``instants`` (time column ``at``) with every version that holds then, and
    equal ``by`` columns (none: all keys, a report per instant; the key: each
    probe finds its own key's state).

    An equi-join on time bins instead of a nested loop. Bins of ``days`` are
    level 0, and each further level's are ``spread`` times as wide. A version
    goes to the lowest level at which it lasts less than ``spread`` bins, so
    it is copied at most ``spread`` + 1 times however long it lasts; an
    instant is looked up once per level, and levels are few (the logarithm
    of the span of the instants). With ``by``, a key that holds a large share
    of the versions is dealt out by its bins.

    Instants or versions without a start match nothing; equal instants are
    answered each; columns of ``history`` that ``instants`` has too (beside
    ``by``) are left out. ``history`` is read once, ``instants`` twice. Up to
    ``FEW`` instants go to the versions as a broadcast, so that the copies of
    the versions stay where they are; more are shuffled with them.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    out = [c for c in history.columns if c not in instants.columns]
    probes = instants.withColumn("_t", micros(F.col(at))).filter("_t IS NOT NULL")
    span = probes.agg(F.min("_t").alias("first"), F.max("_t").alias("last"), F.count(F.lit(1)).alias("n")).first()
    first, last = span["first"] or 0, span["last"] or 0
    step, top = days * 86_400_000_000, 0
    while (last - first) // (step * spread ** top) >= spread:
        top += 1
    begin = F.greatest(micros(F.col("valid_from")), F.lit(first))
    end = F.least(F.coalesce(micros(F.col("valid_to")) - 1, F.lit(last)), F.lit(last))
    level = F.lit(top)
    for n in reversed(range(top)):
        level = F.when(F.col("_e") - F.col("_b") < step * spread ** (n + 1), n).otherwise(level)
    # one rising function of time on both sides, so rounding cannot part them
    bin_of = lambda t, lvl: F.floor(t / (F.lit(float(step)) * F.pow(F.lit(float(spread)), lvl)))
    placed = (history.select(*by, *out, begin.alias("_b"), end.alias("_e")).filter("valid_from IS NOT NULL AND _b <= _e")
              .withColumn("_level", level).withColumn("_bin", F.explode(F.sequence(
                  bin_of(F.col("_b"), F.col("_level")), bin_of(F.col("_e"), F.col("_level"))))))
    looked = (probes.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top))))
              .withColumn("_bin", bin_of(F.col("_t"), F.col("_level"))))
    if span["n"] <= FEW:
        looked = F.broadcast(looked)
    met = looked.join(placed, [*by, "_level", "_bin"]).filter((F.col("_b") <= F.col("_t")) & (F.col("_t") <= F.col("_e")))
    return met.select(*instants.columns, *out)
