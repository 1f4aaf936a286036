"""Removal of repeated byte strings by suffix arrays.

A byte goes when a window of ``length`` bytes over it also starts anywhere
else. The work is cut so that equal windows meet without any shard having to
be searched against every other:

1. Every window has an anchor: the ``gram``-byte string in it with the least
   hash, the leftmost of equals. Equal windows have equal anchors. Windows
   that follow one another and share their anchor's place form a segment.
2. Segments whose anchor occurs once hold no repeated window. Segments equal
   as a whole are repeated as a whole, however many there are: a count tells.
3. One segment of each different content goes to the shard of its anchor.
   A shard of at most ``SHARD`` bytes gets a suffix array by Larsson-Sadakane
   refinement (only groups not yet told apart are sorted again) and common
   prefixes by Kasai's rule, many segments side by side. An anchor with more
   text than one shard has its shards merged by binary search of one's
   windows in the other's suffix array.
4. An anchor with more than ``MERGED`` shards of different text (a passage in
   a third of all documents, each time in other surroundings) is cut anew
   with longer anchors, the last of them as long as the window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, store, text_batches

SHARD = 1 << 20
MERGED = 4
BLOCK = 1 << 19  # bytes hashed at once
PLACE = np.uint64((1 << 20) - 1)  # low bits of a window minimum: the place
MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0xC2B2AE3D27D4EB4F)


# -- anchors ---------------------------------------------------------------

def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded.data, strides=(1,)).copy()


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from every place on."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, total, done = eights(data), 8, None, 0
    words = gram // 8
    while words:
        if words & 1:
            part = power[done:done + n]
            total = part if total is None else (total ^ (total >> np.uint64(31))) * FOLD + part
            done += size
        words >>= 1
        if words:
            power = (power[:-size] ^ (power[:-size] >> np.uint64(29))) * MIX + power[size:]
            size *= 2
    total = (total ^ (total >> np.uint64(32))) * MIX
    return total ^ (total >> np.uint64(29))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours (block-wise prefix and suffix minima)."""
    n = len(x) - width + 1
    if width == 1:
        return x
    full = -(-len(x) // width) * width
    rows = np.concatenate([x, np.full(full - len(x), np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gram: int, length: int):
    """Segments of the texts data[starts:ends] laid end to end: arrays of the
    text's number, start in it, length, anchor hash and content digest."""
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    if len(hashes) < width:
        return [np.zeros(0, np.int64)] * 5
    least = sliding_least((hashes & ~PLACE) | (np.arange(len(hashes), dtype=np.uint64)), width)
    counts = np.maximum(ends - starts - length + 1, 0)
    of = np.repeat(np.arange(len(starts)), counts)
    if not len(of):
        return [np.zeros(0, np.int64)] * 5
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(of))  # window starts
    place = (least[first] & PLACE).astype(np.int64)
    cut = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (of[1:] != of[:-1])))
    last = np.append(cut[1:], len(of)) - 1
    begin, size = first[cut], last - cut + length
    raw, digest = memoryview(data), xxhash.xxh3_64_intdigest
    digests = np.fromiter((digest(raw[b:b + s]) for b, s in zip(begin.tolist(), size.tolist())), np.uint64, len(cut))
    return of[cut], begin - starts[of[cut]], size, hashes[place[cut]].view(np.int64), digests.view(np.int64)


def _segment(schema: pa.Schema, gram: int, length: int):
    """Rows (id, key, base, data) to rows (id, key, base, start, size, anchor, digest)."""
    def block(ids: pa.Array, keys, bases, texts: list[np.ndarray], at: np.ndarray, shift: np.ndarray):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(size)
        of, start, n, anchor, digest = segments(np.concatenate(texts), ends - size, ends, gram, length)
        take = pa.array(at[of])
        return batch(schema, ids.take(take), keys.take(take), bases.take(take), (start + shift[of]).astype(np.int32),
                     n.astype(np.int32), anchor, digest)

    def run(batches):
        for b in batches:
            texts, at, shift, held = [], [], [], 0
            for k, value in enumerate(b.column(3)):
                data = np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.zeros(0, np.uint8)
                for s in range(0, max(len(data) - length + 1, 0), BLOCK):  # very long texts: blocks of window starts
                    texts.append(data[s:s + BLOCK + length - 1])
                    at.append(k)
                    shift.append(s)
                    held += len(texts[-1])
                    if held >= BLOCK // 2:
                        yield block(*b.columns[:3], texts, np.array(at), np.array(shift))
                        texts, at, shift, held = [], [], [], 0
            if texts:
                yield block(*b.columns[:3], texts, np.array(at), np.array(shift))
    return run


# -- suffix arrays ----------------------------------------------------------

class Shard:
    """Suffix array over texts laid end to end; suffixes end with their text."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.start = np.cumsum(self.size) - self.size
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.n = len(data)
        self.rest = np.repeat(self.start + self.size, self.size) - np.arange(self.n)  # bytes to the text's end
        #: eight bytes from every place on, none of them from the next text
        self.word = eights(data)
        short = self.rest < 8
        self.word[short] &= (np.uint64(1) << (8 * self.rest[short]).astype(np.uint64)) - np.uint64(1)
        self.sort()
        self.marked = np.zeros(self.n, bool)  # window starts that occur elsewhere

    def sort(self) -> None:
        """Larsson-Sadakane: ranks by the first h bytes give ranks by 2h bytes."""
        key = self.word.byteswap()
        self.sa = np.argsort(key, kind="stable")
        key = key[self.sa]
        first = np.append(True, key[1:] != key[:-1])
        self.rank = np.empty(self.n, np.int64)
        self.rank[self.sa] = np.maximum.accumulate(np.where(first, np.arange(self.n), 0))
        single = first & np.append(first[1:], True)
        at, h = np.flatnonzero(~single), 8
        deepest = int(self.rest.max(initial=0))  # to the end: Kasai's rule needs the order of whole suffixes
        while h < deepest and len(at):
            place = self.sa[at]
            group = self.rank[place]
            next_rank = np.where(self.rest[place] > h, self.rank[np.minimum(place + h, self.n - 1)] + 1, 0)
            key = group * (self.n + 1) + next_rank
            order = np.argsort(key, kind="stable")
            key, place = key[order], place[order]
            self.sa[at] = place
            first = np.append(True, key[1:] != key[:-1])
            self.rank[place] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
            at = at[~(first & np.append(first[1:], True))]
            h *= 2

    def common(self, p: np.ndarray, other: Shard, q: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Common bytes of suffixes p here and q of ``other``, at least
        ``known`` of them, up to ``length``."""
        most = np.minimum(np.minimum(self.rest[p], other.rest[q]), self.length)
        out = np.minimum(known, most)
        at = np.flatnonzero(out < most)
        while len(at):
            x = self.word[p[at] + out[at]] ^ other.word[q[at] + out[at]]
            same = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8  # equal low bytes (8 if x is 0)
            out[at] += same
            at = at[(same == 8) & (out[at] < most[at])]
        return np.minimum(out, most)

    def mark_inner(self) -> None:
        """Kasai: from one place of a text to the next, the prefix common with
        the suffix sorted before shrinks by one at most. All texts step together."""
        where = np.empty(self.n, np.int64)
        where[self.sa] = np.arange(self.n)
        order = np.argsort(-self.size, kind="stable")
        start, windows = self.start[order], self.size[order] - self.length + 1
        known = np.zeros(len(order), np.int64)
        for t in range(int(windows.max(initial=0))):
            lanes = int(np.searchsorted(-windows, -t, side="left"))  # texts with a window from t on
            p = start[:lanes] + t
            i = where[p]
            before = self.sa[np.maximum(i - 1, 0)]
            known = self.common(p, self, before, np.maximum(known[:lanes] - 1, 0))
            known[i == 0] = 0
            found = known >= self.length
            self.marked[p[found]] = True
            self.marked[before[found]] = True

    def windows(self) -> np.ndarray:
        """Window starts in suffix order."""
        return self.sa[self.rest[self.sa] >= self.length]

    def merge(self, other: Shard) -> None:
        """Mark what the two shards share: binary search of this one's windows
        among the other's, in suffix order."""
        mine, theirs = self.windows(), other.windows()
        if not len(mine) or not len(theirs):
            return
        low, high = np.zeros(len(mine), np.int64), np.full(len(mine), len(theirs))
        best = np.zeros(len(mine), np.int64)
        zero = np.zeros(len(mine), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            p, q = mine[open_], theirs[mid]
            n = self.common(p, other, q, zero[open_])
            equal = n >= self.length
            best[open_[equal]] = 1
            self.marked[p[equal]] = True
            other.marked[q[equal]] = True
            at = np.minimum(n, self.length - 1)
            less = self.byte(p + at) < other.byte(q + at)  # mine sorts before theirs
            high[open_[less | equal]] = mid[less | equal]
            low[open_[~less & ~equal]] = mid[~less & ~equal] + 1
            low[open_[equal]] = high[open_[equal]]

    def byte(self, place: np.ndarray) -> np.ndarray:
        return self.word[place] & np.uint64(255)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marked runs: the text's number, first window, end of the last."""
        at = np.flatnonzero(self.marked)
        if not len(at):
            return at, at, at
        of = np.searchsorted(self.start, at, side="right") - 1
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])))
        last = np.append(new[1:], len(at)) - 1
        of = of[new]
        return of, at[new] - self.start[of], at[last] - self.start[of] + self.length


def repeated_windows(groups: list[list[bytes]], length: int, shard: int = SHARD):
    """For texts in groups (equal windows only within a group): arrays of the
    text's number over all groups, start and end of runs of repeated windows."""
    out, number, pending, pending_size = [], 0, [], 0

    def close():
        nonlocal pending, pending_size, number
        if pending:
            s = Shard(pending, length)
            s.mark_inner()
            of, a, b = s.found()
            out.append((of + number, a, b))
            number += len(pending)
            pending, pending_size = [], 0

    for g in groups:
        size = sum(map(len, g))
        if size > shard:  # an anchor with several shards
            close()
            shards, part, held = [], [], 0
            for t in g:
                part.append(t)
                held += len(t)
                if held >= shard:
                    shards.append(Shard(part, length))
                    part, held = [], 0
            if part:
                shards.append(Shard(part, length))
            for k, s in enumerate(shards):
                s.mark_inner()
                for other in shards[:k]:
                    s.merge(other)
            for s in shards:
                of, a, b = s.found()
                out.append((of + number, a, b))
                number += len(s.size)
            continue
        if pending_size + size > shard:
            close()
        pending += g
        pending_size += size
    close()
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _search(schema: pa.Schema, length: int, shard: int):
    """Rows (id, key, base, start, anchor, data), sorted by anchor, to marks."""
    def flush(held: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(held).combine_chunks()
        anchor = rows["anchor"].to_numpy()
        data = rows["data"].to_pylist()
        cuts = [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), len(data)]
        groups = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        of, a, b = repeated_windows(groups, length, shard)
        base = rows["base"].to_numpy()[of] + rows["start"].to_numpy()[of]
        take = pa.array(of)
        got = rows.take(take).combine_chunks()
        return batch(schema, got["id"].combine_chunks() if got.num_rows else pa.array([], schema[0].type),
                     got["key"].combine_chunks() if got.num_rows else pa.array([], schema[1].type),
                     (base + a).astype(np.int64), (base + b).astype(np.int64))

    def run(batches):
        held, size = [], 0
        for b in batches:
            while b.num_rows:
                anchor = b.column("anchor").to_numpy()
                if held and size >= shard and anchor[0] != held[-1].column("anchor")[-1].as_py():
                    yield flush(held)
                    held, size = [], 0
                end = b.num_rows
                ends = np.cumsum(pc.binary_length(b.column("data")).to_numpy())
                full = int(np.searchsorted(ends, shard - size))  # where the shard is full
                nxt = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
                later = nxt[nxt > full]
                if len(later):
                    end = int(later[0])
                held.append(b.slice(0, end))
                size += int(ends[end - 1])
                b = b.slice(end)
        if held:
            yield flush(held)
    return run


# -- on documents -----------------------------------------------------------

def _mark_type(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("id", id_type), T.StructField("key", T.LongType()),
                         T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])


def _grams(length: int) -> list[int]:
    """Anchor lengths of the levels: about a third of the window, nearly all, all."""
    return sorted({max(8, length // 3 // 8 * 8), max(8, (length - 16) // 8 * 8), length // 8 * 8})


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, length: int, shard: int = SHARD,
                   merged: int = MERGED) -> DataFrame:
    """Marks (id, key, s, e): bytes s to e of the row with that id and key
    (hash of id and text) lie in repeated windows. Marks may overlap."""
    if length % 8:
        raise ValueError("length is a multiple of 8")
    id_type = docs.schema[id_col].dataType
    marks_type = _mark_type(id_type)
    source = keyed(docs, id_col, text_col).select("id", "key", F.lit(0).alias("base"), F.col("text").cast("binary").alias("data"))
    seg_type = T.StructType([T.StructField("id", id_type), T.StructField("key", T.LongType()),
                             T.StructField("base", T.IntegerType()), T.StructField("start", T.IntegerType()),
                             T.StructField("size", T.IntegerType()), T.StructField("anchor", T.LongType()),
                             T.StructField("digest", T.LongType())])
    same_row = lambda c, p: [c["id"].eqNullSafe(p["id"]), c["key"] == p["key"], c["base"] == p["base"]]
    span = [F.col("id"), F.col("key"), (F.col("base") + F.col("start")).cast("long").alias("s"),
            (F.col("base") + F.col("start") + F.col("size")).cast("long").alias("e")]
    marks = []
    for gram in _grams(length):
        segs = store(source.mapInArrow(_segment(to_arrow_schema(seg_type), gram, length), seg_type), "segments")
        # written, so that the joins deal out both sides themselves and can split a hot anchor
        twice = store(segs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
        again = store(segs.join(twice, "anchor", "left_semi"), "again")
        kinds = store(again.groupBy("anchor", "digest").agg(
            F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("id", "key", "base", "start", "size")]), "kinds")
        whole = kinds.filter("n > 1").select("anchor", "digest")
        marks.append(again.join(whole, ["anchor", "digest"], "left_semi").select(*span))
        if gram == length:  # the anchor is the window: counts tell all
            break
        many = store(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("size").alias("bytes")).filter("kinds > 1"), "anchors")
        chosen = kinds.join(many, "anchor")
        if chosen.isEmpty():
            break
        per_row = chosen.groupBy("id", "key", "base").agg(F.collect_list(
            F.struct("start", "size", "anchor", (F.col("bytes") > shard * merged).alias("hot"))).alias("parts"))
        texts = source.join(per_row.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), F.col("base").alias("c_base"), "parts"),
                            F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")) & (F.col("base") == F.col("c_base")))
        cut = store(texts.dropDuplicates(["id", "key", "base"]).select("id", "key", "base", "data", F.explode("parts").alias("p"))
                    .select("id", "key", "base", "p.start", "p.anchor", "p.hot",
                            F.substring(F.col("data"), F.col("p.start") + 1, F.col("p.size")).alias("data")), "texts")
        total = cut.agg(F.sum(F.length("data")).alias("b"), F.count_if("hot").alias("h")).first()
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total["b"] or 0) // (4 * shard)))
        found = (cut.filter("NOT hot").select("id", "key", "base", "start", "anchor", "data")
                 .repartition(parts, "anchor").sortWithinPartitions("anchor")
                 .mapInArrow(_search(to_arrow_schema(marks_type), length, shard), marks_type))
        marks.append(store(found, "found"))
        if not total["h"]:
            break
        source = cut.filter("hot").select("id", "key", (F.col("base") + F.col("start")).alias("base"), "data")
    out = marks[0]
    for m in marks[1:]:
        out = out.union(m)
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(i.alias("id"), F.xxhash64(i, t).alias("key"), t.alias("text"))


def runs_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that spans cover."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def spans_by_row(marks: DataFrame) -> DataFrame:
    """One row (id, key, spans) for all rows with that id and key. Repeated
    rows give the same marks, each taken once: the spans of a key are bounded
    by its text, however often the row repeats."""
    return marks.groupBy("id", "key").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   carry: bool = False, shard: int = SHARD, merged: int = MERGED, added: str = "_removed") -> DataFrame:
    """Every row with the bytes removed that ``length``-byte strings occurring
    anywhere else cover: ``id_col``, n_bytes, n_removed, n_spans (maximal
    removed runs) long, kept_sha256 (of the bytes left), text (what is left as
    text; a character cut in part goes whole). With ``carry``: all columns of
    ``docs`` with the text cut, and ``added``, the number of bytes removed.

    Strings are judged on the input; matches overlap and lie in the same or
    another row, never across rows. Null text counts as empty (and stays null
    in ``text``). Repeated rows count as each other's copies. Null ids are
    kept. An empty table gives an empty result. ``length``: a multiple of 8.
    """
    cols = docs.columns if carry else []
    extra = [F.col(f"`{c}`").alias(f"x{k}") for k, c in enumerate(cols) if c != text_col]
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = text_batches(docs).select(i.alias("id"), F.xxhash64(i, t).alias("key"), t.cast("binary").alias("data"), *extra)
    spans = spans_by_row(repeated_spans(docs, id_col, text_col, length, shard, merged))
    joined = rows.join(spans.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), "spans"),
                       F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")), "left").drop("c_id", "c_key", "key")
    kept_cols = [f.name for f in joined.schema.fields if f.name.startswith("x")]
    out = T.StructType([f for f in joined.schema.fields if f.name == "id" or f.name in kept_cols] + (
        [T.StructField("text", T.StringType()), T.StructField("removed", T.LongType())] if carry else
        [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType()), T.StructField("text", T.StringType())]))
    schema = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            text, removed, size, count, sha = [], [], [], [], []
            for value, spans in zip(b.column("data"), b.column("spans")):
                data = value.as_py() if value.is_valid else b""
                cuts = runs_of([(s["s"], s["e"]) for s in spans.as_py()]) if spans.is_valid else []
                at, kept = 0, []
                for s, e in cuts:
                    kept.append(data[at:s])
                    at = e
                kept.append(data[at:])
                removed.append(sum(e - s for s, e in cuts))
                text.append(b"".join(k if k is data else k.decode("utf-8", "ignore").encode() for k in kept).decode("utf-8", "replace")
                            if value.is_valid else None)
                if not carry:
                    size.append(len(data))
                    count.append(len(cuts))
                    sha.append(hashlib.sha256(b"".join(kept)).hexdigest())
            fixed = [b.column("id"), *[b.column(c) for c in kept_cols]]
            yield batch(schema, *fixed, *([text, removed] if carry else [size, removed, count, sha, text]))

    result = joined.mapInArrow(run, out)
    if not carry:
        return result.withColumnRenamed("id", id_col)
    back = {c: f"x{k}" for k, c in enumerate(cols)} | {text_col: "text"}
    return result.select(*[F.col(back[c]).alias(c) for c in cols], F.col("removed").alias(added))
