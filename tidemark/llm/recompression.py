"""Removal of word passages that an earlier document holds, by recompression.

A word goes when a window of ``length`` words over it also starts in a
document of smaller id. Equal windows are made to meet through the symbols
of a recompressed text:

1. Rounds replace runs of one word, then pairs of neighbouring symbols, by new
   symbols. A pair is replaced if a bit of its first symbol is 1 and that of
   its second is 0, so every decision looks at neighbours only, and a name is
   a hash of what it stands for: the same name for the same words in every
   document of every partition, without a dictionary to pass around.
   Kept beside a symbol is the stretch of words that decided it. Wherever
   these words occur, the symbol does.
2. A window is known by one symbol whose stretch lies inside it: of those of
   the last rounds the longest, up to ENOUGH words, and of these the one of
   least hash; where there is none, the first one of the highest round that
   has one. Equal windows agree on it. Neighbouring windows known by the same
   name form a segment.
3. Spark counts the names: a segment whose symbol is met in one document
   only holds no repeat. Segments equal as a whole take the smallest id at
   once, however many there are. One of each different content has its
   windows compared by 128-bit digests of their words, counted over all rows
   by partial aggregation; no pairs of documents are formed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, store, text_batches
from tidemark.llm.substrings import keyed, runs_of

ROUNDS = 9
POOLED = 6  # rounds from here on offer their symbols together
ENOUGH = 8  # words of a symbol beyond which longer is not better
BLOCK = 1 << 17  # words parsed at once; longer texts go in blocks that overlap by a window
MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * FOLD
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """64-bit hashes of words, at most ``most`` of them remembered."""

    def __init__(self, seed: int = 0, most: int = 300_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# -- recompression ------------------------------------------------------------

class Symbols:
    """The symbols of texts laid end to end, left to right: name, text ``of``
    it, words ``beg`` to ``end`` under it, and the words ``low`` to ``high``
    that decide it (one beyond the text where its edge decides)."""

    def __init__(self, name, of, beg, end, low, high):
        self.name, self.of, self.beg, self.end, self.low, self.high = name, of, beg, end, low, high

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        first = np.append(True, self.of[1:] != self.of[:-1])
        return first, np.append(first[1:], True)

    def before(self, at: np.ndarray, first: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """From where on the symbol left of ``at`` is decided."""
        return np.where(first[at], starts[self.of[at]] - 1, self.low[np.maximum(at - 1, 0)])

    def after(self, at: np.ndarray, last: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.where(last[at], ends[self.of[at]] + 1, self.high[np.minimum(at + 1, len(self.high) - 1)])


def name_runs(s: Symbols, starts: np.ndarray, ends: np.ndarray) -> Symbols:
    """Runs of one symbol become one; its neighbours decide where it ends."""
    first, last = s.edges()
    a = np.flatnonzero(first | np.append(True, s.name[1:] != s.name[:-1]))
    b = np.append(a[1:], len(s.name)) - 1
    n = (b - a + 1).astype(np.uint64)
    return Symbols(np.where(n > 1, mixed(s.name[a] + mixed(n)), s.name[a]), s.of[a], s.beg[a], s.end[b],
                   s.before(a, first, starts), s.after(b, last, ends))


def name_pairs(s: Symbols, number: int, starts: np.ndarray, ends: np.ndarray) -> Symbols:
    """Neighbours with bits 1 and 0 become one symbol, which nothing else
    decides. A symbol left over with bit 1 also needs its right neighbour's
    bit, one with bit 0 its left neighbour's."""
    first, last = s.edges()
    one = (mixed(s.name ^ mixed(np.full(1, number, np.uint64))) >> np.uint64(63)).astype(bool)
    joins = np.append(one[:-1] & ~one[1:], False) & ~last
    a = np.flatnonzero(~np.append(False, joins[:-1]))
    pair = joins[a]
    b = a + pair
    name = np.where(pair, mixed(s.name[a] * MIX + mixed(s.name[b])), s.name[a])
    low = np.where(pair | one[a], s.low[a], s.before(a, first, starts))
    high = np.where(pair | ~one[a], s.high[b], s.after(a, last, ends))
    return Symbols(name, s.of[a], s.beg[a], s.end[b], low, high)


def window_anchors(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, rounds: int = ROUNDS):
    """For every window start: the name of the symbol it is known by and that
    symbol's place, -1 where no window starts."""
    total = len(words)
    at = np.arange(total)
    of = np.repeat(np.arange(len(starts)), ends - starts)
    levels = [Symbols(words, of, at, at + 1, at, at + 1)]
    levels.append(name_pairs(name_runs(levels[0], starts, ends), 1, starts, ends))
    for number in range(2, rounds + 1):
        levels.append(name_pairs(levels[-1], number, starts, ends))
    name, place = np.zeros(total, np.uint64), np.full(total, -1)
    # the last rounds together: symbols are written over all windows that hold what decides them, the best last
    names, places, lows, highs, sizes = [], [], [], [], []
    for number in range(POOLED, rounds + 1):
        s = levels[number]
        fresh = np.ones(len(s.name), bool)
        if number > POOLED:  # one that stayed as it was is in already
            end = np.zeros(total, np.int64)
            end[levels[number - 1].beg] = levels[number - 1].end
            fresh = end[s.beg] != s.end
        begin, finish = starts[s.of], ends[s.of]
        low, high = np.maximum(s.high - length, begin), np.minimum(s.low, finish - length)
        use = np.flatnonzero(fresh & (low <= high) & (s.low >= begin) & (s.high <= finish))
        for kept, x in zip((names, places, lows, highs, sizes), (s.name, s.beg, low, high, s.end - s.beg)):
            kept.append(x[use])
    names, places, lows, highs, sizes = map(np.concatenate, (names, places, lows, highs, sizes))
    order = np.lexsort((~mixed(names), np.minimum(sizes, ENOUGH)))
    n = (highs - lows + 1)[order]
    fill = np.repeat(lows[order] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    name[fill] = np.repeat(names[order], n)
    place[fill] = np.repeat(places[order], n)
    for s in reversed(levels[:POOLED]):
        # windows that hold what decides a symbol, and not what decides the one before it
        first, _ = s.edges()
        begin, finish = starts[s.of], ends[s.of]
        low = np.maximum(np.maximum(np.where(first, begin, np.append(-1, s.low[:-1]) + 1), s.high - length), begin)
        high = np.minimum(s.low, finish - length)
        open_ = np.append(0, np.cumsum(place < 0))
        use = np.flatnonzero((low <= high) & (s.low >= begin) & (s.high <= finish))
        use = use[open_[high[use] + 1] > open_[low[use]]]
        n = (high - low + 1)[use]
        fill = np.repeat(low[use] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        free = place[fill] < 0
        fill = fill[free]
        name[fill] = np.repeat(s.name[use], n)[free]
        place[fill] = np.repeat(s.beg[use], n)[free]
    return name, place


def segments(texts: list[np.ndarray], length: int):
    """Segments of texts (word hashes): arrays of the text's number, first
    word, count of words, anchor name and digest of the words."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    starts = ends - size
    words = np.concatenate(texts)
    name, place = window_anchors(words, starts, ends, length)
    of = np.repeat(np.arange(len(texts)), size)
    held = place >= 0
    cut = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (held[1:] != held[:-1]) | (of[1:] != of[:-1])))
    last = np.append(cut[1:], len(words)) - 1
    real = held[cut]
    cut, last = cut[real], last[real]
    raw, digest = memoryview(words), xxhash.xxh3_64_intdigest
    digests = np.fromiter((digest(raw[a:b]) for a, b in zip(cut.tolist(), (last + length).tolist())), np.uint64, len(cut))
    return of[cut], cut - starts[of[cut]], last - cut + length, name[cut].view(np.int64), digests.view(np.int64)


def window_digests(first: np.ndarray, second: np.ndarray, length: int) -> np.ndarray:
    """Two 64-bit digests of the ``length`` words from every place on, from
    two independent hashes of each word."""
    out = []
    for h in (first, second):
        n = len(h) - length + 1
        power, size, done, total = mixed(h), 1, 0, None
        left = length
        while left:
            if left & 1:
                part = power[done:done + n]
                total = part if total is None else mixed(total * FOLD + part)
                done += size
            left >>= 1
            if left:
                power = mixed(power[:-size] * MIX + power[size:])
                size *= 2
        out.append(total)
    return out


# -- on documents -----------------------------------------------------------

def _segment(schema: pa.Schema, length: int):
    """Rows (id, key, text) to rows (id, key, start, size, anchor, digest)."""
    def run(batches):
        hashes = WordHashes()

        def close(b, texts, rows, shift):
            of, start, size, anchor, digest = segments(texts, length)
            take = pa.array(rows[of])
            return batch(schema, b.column(0).take(take), b.column(1).take(take), (start + shift[of]).astype(np.int32),
                         size.astype(np.int32), anchor, digest)

        for b in batches:
            texts, rows, shift, held = [], [], [], 0
            for k, value in enumerate(b.column(2)):
                words = value.as_py().split() if value.is_valid else []
                for s in range(0, max(len(words) - length + 1, 0), BLOCK):
                    texts.append(hashes.of(words[s:s + BLOCK + length - 1]))
                    rows.append(k)
                    shift.append(s)
                    held += len(texts[-1])
                    if held >= BLOCK:
                        yield close(b, texts, np.array(rows), np.array(shift))
                        texts, rows, shift, held = [], [], [], 0
            if texts:
                yield close(b, texts, np.array(rows), np.array(shift))
    return run


def _windows(schema: pa.Schema, length: int):
    """Rows (text, parts) to one row per window of a part: first, second, kind, at."""
    def run(batches):
        one, two = WordHashes(), WordHashes(1)

        def close(words, kinds, sizes):
            a, b = window_digests(one.of(words), two.of(words), length)
            sizes = np.array(sizes)
            n = sizes - length + 1
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(np.cumsum(sizes) - sizes, n) + at
            kind = pa.concat_arrays(kinds).take(pa.array(np.repeat(np.arange(len(sizes)), n)))
            return batch(schema, a[place].view(np.int64), b[place].view(np.int64), kind, at.astype(np.int32))

        for b in batches:
            words, kinds, sizes = [], [], []
            starts_at = b.column("parts").offsets.to_numpy() - b.column("parts").offsets[0].as_py()
            parts = b.column("parts").flatten()
            start, size, kind = parts.field("start").to_numpy(), parts.field("size").to_numpy(), parts.field("kind")
            for k in range(b.num_rows):
                text = b.column("text")[k].as_py().split()
                for p in range(starts_at[k], starts_at[k + 1]):
                    words += text[start[p]:start[p] + size[p]]
                    kinds.append(kind.slice(p, 1))
                    sizes.append(size[p])
                    if len(words) >= BLOCK:
                        yield close(words, kinds, sizes)
                        words, kinds, sizes = [], [], []
            if sizes:
                yield close(words, kinds, sizes)
    return run


def earlier_spans(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """Spans (id, key, s, e): words s to e of the row with that id and key lie
    in windows that start in a row of smaller id too. Spans may overlap."""
    id_type = docs.schema[id_col].dataType
    rows = keyed(docs, id_col, text_col).select("id", "key", F.col("text").cast("binary").alias("text"))
    seg_type = T.StructType([T.StructField("id", id_type), *[T.StructField(n, t) for n, t in (
        ("key", T.LongType()), ("start", T.IntegerType()), ("size", T.IntegerType()), ("anchor", T.LongType()), ("digest", T.LongType()))]])
    segs = store(rows.mapInArrow(_segment(to_arrow_schema(seg_type), length), seg_type), "segments")
    who = F.struct(F.col("id").alias("id"))  # a struct sorts null first, and is itself never null
    shared = segs.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max(F.col("id").isNull()).alias("none")).filter(
        "a < b OR (none AND a IS NOT NULL)").select("anchor")
    again = store(segs.join(store(shared, "names"), "anchor", "left_semi"), "again")
    kinds = store(again.groupBy("anchor", "digest").agg(
        F.min(F.struct("id", "key", "start", "size")).alias("at"), F.max(who).alias("most")), "kinds")
    least = F.struct(F.col("at.id").alias("id"))
    whole = kinds.filter(least < F.col("most")).select("anchor", "digest", least.alias("least"))
    span = lambda a, b: (F.col(a).cast("long").alias("s"), F.col(b).cast("long").alias("e"))
    entire = again.join(whole, ["anchor", "digest"]).filter(F.col("least") < who).withColumn("end", F.col("start") + F.col("size")).select(
        "id", "key", *span("start", "end"))
    # symbols with several surroundings: window by window, one segment of each kind
    many = store(kinds.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "names")
    chosen = kinds.join(many, "anchor", "left_semi").select(
        "at.*", F.struct("anchor", "digest", least.alias("least")).alias("kind"))
    parts = chosen.groupBy(F.col("id").alias("c_id"), F.col("key").alias("c_key")).agg(
        F.collect_list(F.struct("start", "size", "kind")).alias("parts"))
    met = rows.join(parts, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key"))).dropDuplicates(
        ["c_id", "c_key"]).select("text", "parts")
    kind_type = met.schema["parts"].dataType.elementType["kind"].dataType
    win_type = T.StructType([T.StructField("first", T.LongType()), T.StructField("second", T.LongType()),
                             T.StructField("kind", kind_type), T.StructField("at", T.IntegerType())])
    windows = store(met.mapInArrow(_windows(to_arrow_schema(win_type), length), win_type).select("first", "second", "kind.*", "at"), "windows")
    before = store(windows.groupBy("first", "second").agg(F.min("least").alias("a"), F.max("least").alias("b")).filter("a < b").select(
        "first", "second", "a"), "repeated")
    covered = windows.join(before, ["first", "second"]).filter("a < least").groupBy("anchor", "digest", "least").agg(
        F.collect_set("at").alias("ats"))
    inner = again.join(covered, ["anchor", "digest"]).filter(who == F.col("least")).select(
        "id", "key", "start", F.explode(_runs(F.sort_array("ats"))).alias("r")).select(
        "id", "key", (F.col("start") + F.col("r.first")).cast("long").alias("s"), (F.col("start") + F.col("r.last") + length).cast("long").alias("e"))
    return entire.union(inner)


def _runs(ats):
    """Runs of consecutive numbers of a sorted array, as (first, last)."""
    opens = F.filter(ats, lambda x: ~F.array_contains(ats, x - 1))
    closes = F.filter(ats, lambda x: ~F.array_contains(ats, x + 1))
    return F.zip_with(opens, closes, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_removed long,
    kept_sha256, text (the words kept, joined by one space).

    Words are maximal runs of other than space and the controls 9 to 13. A
    word goes if a window of ``length`` words that covers it also starts in a
    row of smaller id; windows are judged on the input and never cross rows.
    Null and empty texts have no words. Rows of equal ids keep what they
    share, whole repeats included; a null id is smaller than every other.
    An empty table gives an empty result; other columns are ignored.
    """
    spans = earlier_spans(text_batches(docs), id_col, text_col, length).groupBy("id", "key").agg(
        F.collect_set(F.struct("s", "e")).alias("spans"))
    joined = keyed(docs, id_col, text_col).select("id", "key", F.col("text").cast("binary").alias("data")).join(
        spans.select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), "spans"),
        F.col("id").eqNullSafe(F.col("c_id")) & (F.col("key") == F.col("c_key")), "left").select("id", "data", "spans")
    out = T.StructType([joined.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept_sha256", T.StringType()), T.StructField("text", T.StringType())])
    schema = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            n, removed, kept = [], [], []
            for value, spans in zip(b.column("data"), b.column("spans")):
                words = value.as_py().split() if value.is_valid else []
                stay, at = [], 0
                for s, e in runs_of([(x["s"], x["e"]) for x in spans.as_py()]) if spans.is_valid else []:
                    stay += words[at:s]
                    at = e
                stay += words[at:]
                n.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay))
            yield batch(schema, b.column("id"), n, removed, [hashlib.sha256(k).hexdigest() for k in kept],
                        pa.array(kept, pa.binary()).cast(pa.string()))

    return joined.mapInArrow(run, out).withColumnRenamed("id", id_col)
