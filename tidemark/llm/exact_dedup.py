"""Exact duplicates by sorting content.

Rows are range-partitioned on sampled splitters over the normalised bytes
(their opening, then a 128-bit digest of all of them, then the id), sorted
inside each partition by Spark's external sort, and neighbours are compared
in full. The id in the splitter key lets a text that a third of all rows
share cross as many partitions as it needs. A run that touches a partition's
edge, or that was too long to hold at once and came in slices, is completed
from one summary row per part, by the SHA-256 of its text: two per partition
and one per ``HELD`` bytes or rows of one run.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, store, text_batches

PREFIX_BYTES = 24
HELD = 64 << 20, 100_000  # bytes and rows of an open run kept in memory
BROADCAST_ROWS = 200_000  # summary rows of about 150 bytes; more are joined by a shuffle


def normalised(text: pa.Array) -> pa.Array:
    """A-Z to a-z, every other byte as it is; null is empty."""
    return pc.ascii_lower(pc.fill_null(text, ""))


def _keys(schema: pa.Schema):
    def run(batches):
        for b in batches:
            norm = pc.cast(normalised(b.column("text")), pa.binary())
            opening = pc.binary_slice(norm, 0, PREFIX_BYTES)
            digest = [xxhash.xxh3_128_digest(v.as_buffer()) for v in norm]
            yield batch(schema, *b.columns, opening, digest)
    return run


def _runs(schema: pa.Schema, carried: list[str], last_stays: bool, most: tuple[int, int]):
    """One output row per row: its run in this partition, the run's size and
    the id that stays of it. ``edge`` is set on the staying row of the first
    and the last run, which may go on in another partition, and of every
    part of a run that came in slices."""
    def run(batches):
        pid = TaskContext.get().partitionId()
        held, held_norm, number, sliced = [], None, 0, False  # batches of the run still open

        def emit(rows: pa.RecordBatch, norm: list[bytes], starts: np.ndarray, edge: bool) -> pa.RecordBatch:
            """``rows`` hold whole runs (or one part of a run), beginning at ``starts``."""
            nonlocal number
            sizes = np.diff(np.append(starts, rows.num_rows))
            stay = starts + sizes - 1 if last_stays else starts
            of = np.repeat(np.arange(len(starts)), sizes)
            stays = np.zeros(rows.num_rows, bool)
            stays[stay] = True
            sha = pa.array([hashlib.sha256(x).hexdigest() for x in norm])
            out = batch(schema, *[rows.column(c) for c in carried], sha.take(pa.array(of)),
                        np.full(len(of), pid, np.int32), number + of, sizes[of],
                        rows.column("id").take(pa.array(stay[of])), stays, stays & edge)
            number += len(starts)
            return out

        def close(edge: bool):
            """The run held, or its last part. Arrow may give it in several
            batches: each is a part of its own then."""
            nonlocal sliced
            parts = pa.Table.from_batches(held).combine_chunks().to_batches()
            held.clear()
            edge, sliced = edge or sliced or len(parts) > 1, False
            for rows in parts:
                yield emit(rows, [held_norm], np.zeros(1, np.int64), edge)

        def cut():
            """A run too long to hold: give out what there is of it."""
            nonlocal sliced
            if sum(h.nbytes for h in held) > most[0] or sum(h.num_rows for h in held) > most[1]:
                yield from close(True)
                sliced = True

        for b in batches:
            if not b.num_rows:
                continue
            norm = pc.cast(normalised(b.column("text")), pa.binary())
            same = pc.equal(norm.slice(1), norm.slice(0, len(norm) - 1)).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(~same) + 1)
            slim = b.select(carried)
            if (held or sliced) and norm[0].as_py() == held_norm:
                end = int(starts[1]) if len(starts) > 1 else b.num_rows
                held.append(slim.slice(0, end))
                starts = starts[1:]
            if not len(starts):
                yield from cut()
                continue
            if held:
                yield from close(number == 0)
            sliced = False
            inner = starts[:-1]
            if len(inner) and number == 0:  # the partition's first run
                end = int(starts[1])
                yield emit(slim.slice(inner[0], end - inner[0]), [norm[int(inner[0])].as_py()], np.zeros(1, np.int64), True)
                inner = inner[1:]
            if len(inner):
                yield emit(slim.slice(inner[0], starts[-1] - inner[0]), norm.take(pa.array(inner)).to_pylist(),
                           inner - inner[0], False)
            held.append(slim.slice(starts[-1]))
            held_norm = norm[int(starts[-1])].as_py()
            yield from cut()
        if held:
            yield from close(True)
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                carry: bool = False, added: str = "_kept", held: tuple[int, int] = HELD) -> DataFrame:
    """One row per row of ``docs``, dropped ones too.

    Columns: ``id_col``, keep_id, group_size long, kept boolean, text_sha256
    (lowercase hex of the normalised text). ``keep`` is ``smallest`` or
    ``largest`` id. With ``carry`` the rows are those of ``docs``, all its
    columns, with ``kept`` as the one column added (named ``added``, which
    ``docs`` must not have).

    Null text counts as empty. A null id sorts below every other; among
    equal texts exactly one row stays, also when rows repeat whole. Texts
    differing in anything but A-Z/a-z are different. An empty table gives an
    empty result. Other columns are ignored (or carried untouched).
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    names = docs.columns
    cols = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")]
    if carry:
        cols += [F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(names) if c not in (id_col, text_col)]
    rows = text_batches(docs).select(*cols)
    keyed = T.StructType(rows.schema.fields + [T.StructField("opening", T.BinaryType()),
                                               T.StructField("digest", T.BinaryType())])
    key = ["opening", "digest", "id"]
    ranged = (rows.mapInArrow(_keys(to_arrow_schema(keyed)), keyed)
              .repartitionByRange(*key).sortWithinPartitions(*key))
    carried = rows.columns if carry else ["id"]
    out = T.StructType([f for f in rows.schema.fields if f.name in carried] + [
        T.StructField("sha", T.StringType()), T.StructField("pid", T.IntegerType()),
        T.StructField("run", T.LongType()), T.StructField("size", T.LongType()),
        T.StructField("stay_id", rows.schema["id"].dataType), T.StructField("stays", T.BooleanType()),
        T.StructField("edge", T.BooleanType())])
    local = store(ranged.mapInArrow(_runs(to_arrow_schema(out), carried, keep == "largest", held), out), "runs")
    whole, place = Window.partitionBy("sha"), F.struct("pid", "run")
    pick, end = (F.max_by, F.max) if keep == "largest" else (F.min_by, F.min)
    edges = store(local.filter("edge").select(
        F.col("pid").alias("e_pid"), F.col("run").alias("e_run"), F.sum("size").over(whole).alias("e_size"),
        pick("stay_id", place).over(whole).alias("e_id"), end(place).over(whole).alias("e_place")), "edges")
    if edges.count() <= BROADCAST_ROWS:
        edges = F.broadcast(edges)
    joined = local.join(edges, (F.col("pid") == F.col("e_pid")) & (F.col("run") == F.col("e_run")), "left")
    kept = F.col("stays") & (F.col("e_place").isNull() | (F.col("e_place") == place))
    if carry:
        back = {id_col: "id", text_col: "text"} | {c: f"x{i}" for i, c in enumerate(names) if c not in (id_col, text_col)}
        return joined.select(*[F.col(back[c]).alias(c) for c in names], kept.alias(added))
    return joined.select(
        F.col("id").alias(id_col), F.when(F.col("e_pid").isNull(), F.col("stay_id")).otherwise(F.col("e_id")).alias("keep_id"),
        F.coalesce("e_size", "size").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))
