"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints within ``max_bits`` differing bits agree whole in at least one
of ``max_bits + 1`` blocks of their 64 bits. For each block a binary trie is
built over the distinct fingerprints that agree in it (the shuffle brings
them together), and the trie is joined with itself: pairs of nodes are
walked together from the root, the bits in which they differ are added up,
and a pair is dropped as soon as the sum passes the budget. What a task
finds leaves it as a spanning forest, never as all pairs. A block value that
very many fingerprints share is cut into sub-tries of bounded size, and
pairs of sub-tries are joined in tasks of their own.

Components over all forests come from contracting hooks: every component
points to its smallest neighbour, pointers are followed to their ends, edges
are renamed, and the edges that remain (ever fewer) go round again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, store, text_batches

SEED = 42
#: most fingerprints of one block value that one task walks in one piece
SUBTRIE = 4096
WORDS_AT_ONCE = 1 << 17


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, repeats included: a bit is
    set if it is in over half of the hashes. No word: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at:at + WORDS_AT_ONCE + shingle - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        h = np.fromiter((digest(g, SEED) for g in grams), "<u8", len(part) - shingle + 1)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    rows = text_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = T.StructType([rows.schema["id"], T.StructField("fp", T.LongType())])
    schema = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield batch(schema, b.column(0), fp.view(np.int64))

    return rows.mapInArrow(run, out)


def block_bounds(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``max_bits + 1`` blocks that make up 64 bits."""
    cuts = [64 * k // (max_bits + 1) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


class Forest:
    """Union-find over 0..n-1 with array operations."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            two = self.up[self.up]
            if (two == self.up).all():
                return self.up
            self.up = two

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            r = self.roots()
            a, b = r[a], r[b]
            differ = a != b
            a, b = np.maximum(a, b)[differ], np.minimum(a, b)[differ]
            np.minimum.at(self.up, a, b)


def trie_join(fps: np.ndarray, units: list[tuple[np.ndarray, np.ndarray | None]], max_bits: int) -> tuple[np.ndarray, Forest]:
    """Self-join of tries. ``fps``: distinct uint64 values; ``units``: index
    arrays of sub-tries to join with themselves (second is None) or with one
    another. Returns the values and a forest that links every two values of
    a unit within ``max_bits`` bits (directly or through others).

    A trie node is an interval of a unit's sorted values: those with a common
    prefix. All node pairs of all units go down one bit a round.
    """
    forest = Forest(len(fps))
    if not units:
        return fps, forest
    sorted_units = [(np.sort(fps[a]), None if b is None else np.sort(fps[b])) for a, b in units]
    values, lo_a, hi_a, lo_b, hi_b, own = [], [], [], [], [], []
    at = 0
    for a, b in sorted_units:
        values.append(a)
        lo_a.append(at)
        at += len(a)
        hi_a.append(at)
        if b is None:
            lo_b.append(lo_a[-1])
        else:
            values.append(b)
            lo_b.append(at)
            at += len(b)
        hi_b.append(at)
        own.append(b is None)
    v = np.concatenate(values)
    node = np.searchsorted(fps, v) if len(fps) > 1 and (fps[1:] > fps[:-1]).all() else None
    if node is None:
        order = np.argsort(fps)
        node = order[np.searchsorted(fps[order], v)]
    la, ha, lb, hb = (np.array(x, np.int64) for x in (lo_a, hi_a, lo_b, hi_b))
    self_pair, spent = np.array(own), np.zeros(len(la), np.int64)
    width = 1 << 20

    def leaves(la, ha, lb, hb, self_pair):
        """Compare all values of small node pairs."""
        na, nb = ha - la, hb - lb
        size = na * nb
        for s in range(0, len(la), max(1, width // 64)):
            cut = slice(s, s + max(1, width // 64))
            of = np.repeat(np.arange(len(size[cut])), size[cut])
            k = np.arange(len(of)) - np.repeat(np.cumsum(size[cut]) - size[cut], size[cut])
            i, j = la[cut][of] + k // nb[cut][of], lb[cut][of] + k % nb[cut][of]
            keep = ~(self_pair[cut][of] & (i >= j))
            i, j = i[keep], j[keep]
            near = np.bitwise_count(v[i] ^ v[j]) <= max_bits
            forest.link(node[i[near]], node[j[near]])

    for bit in range(63, -1, -1):
        if not len(la):
            break
        small = (ha - la) * (hb - lb) <= 64
        if small.any():
            leaves(la[small], ha[small], lb[small], hb[small], self_pair[small])
            la, ha, lb, hb, self_pair, spent = (x[~small] for x in (la, ha, lb, hb, self_pair, spent))
        if not len(la):
            break
        # node pairs whose values are all in one component have nothing to find
        r = forest.roots()[node]
        breaks = np.append(0, np.cumsum(r[1:] != r[:-1]))
        one = (breaks[ha - 1] == breaks[la]) & (breaks[hb - 1] == breaks[lb]) & (r[la] == r[lb])
        la, ha, lb, hb, self_pair, spent = (x[~one] for x in (la, ha, lb, hb, self_pair, spent))
        ones = np.append(0, np.cumsum(v >> np.uint64(bit) & np.uint64(1) == 1))
        ma, mb = ha - (ones[ha] - ones[la]), hb - (ones[hb] - ones[lb])  # the sides' borders between 0 and 1
        parts = [(la, ma, lb, mb, self_pair, spent), (ma, ha, mb, hb, self_pair, spent),
                 (la, ma, mb, hb, np.zeros(len(la), bool), spent + 1)]
        other = ~self_pair
        parts.append((ma[other], ha[other], lb[other], mb[other], self_pair[other], spent[other] + 1))
        la, ha, lb, hb, self_pair, spent = (np.concatenate(x) for x in zip(*parts))
        live = (ha > la) & (hb > lb) & (spent <= max_bits) & ~(self_pair & (ha - la < 2))
        la, ha, lb, hb, self_pair, spent = (x[live] for x in (la, ha, lb, hb, self_pair, spent))
    if len(la):  # equal in all bits: the same value on both sides of a pair
        leaves(la, ha, lb, hb, self_pair)
    return v, forest


EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _walk(max_bits: int):
    """Rows (unit, side, fp) of whole units, sorted by unit, to forest edges."""
    schema = to_arrow_schema(EDGES)

    def flush(unit, side, fp):
        fps, back = np.unique(fp, return_inverse=True)
        starts = np.append(0, np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1)
        units = []
        for s, e in zip(starts.tolist(), np.append(starts[1:], len(fp)).tolist()):
            if e - s > 1:
                sd = side[s:e]
                units.append((back[s:e], None) if (sd == 2).all() else (back[s:e][sd == 0], back[s:e][sd == 1]))
        units = [(a, b) for a, b in units if len(a) and (b is None or len(b))]
        if units:
            _, forest = trie_join(fps, units, max_bits)
            r = forest.roots()
            far = np.flatnonzero(r != np.arange(len(r)))
            yield batch(schema, fps[far].view(np.int64), fps[r[far]].view(np.int64))

    def run(batches):
        held = None
        for b in batches:
            unit = np.stack([b.column(k).to_numpy().astype(np.int64) for k in range(4)], axis=1)
            part = [unit, b.column(4).to_numpy(), b.column(5).to_numpy().view(np.uint64)]
            held = part if held is None else [np.concatenate(x) for x in zip(held, part)]
            if len(held[2]) >= 1 << 17:  # whole units so far; the last may go on
                earlier = np.flatnonzero((held[0] != held[0][-1]).any(axis=1))
                if len(earlier):
                    last = int(earlier[-1]) + 1
                    yield from flush(*(x[:last] for x in held))
                    held = [x[last:] for x in held]
        if held is not None and len(held[2]):
            yield from flush(*held)
    return run


def near_edges(distinct: DataFrame, max_bits: int = 3, subtrie: int = SUBTRIE) -> DataFrame:
    """Forest edges (a, b) over distinct fingerprints ``fp`` (bigint) whose
    components are those of all links within ``max_bits`` bits."""
    blocks = block_bounds(max_bits)
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(F.shiftleft("fp", 64 - w - lo), 64 - w).alias("value"))
        for k, (lo, w) in enumerate(blocks)])).alias("t")).select("fp", "t.block", "t.value")
    # values that more fingerprints share than one task walks: cut into sub-tries
    big = (keyed.groupBy("block", "value").agg(F.count("*").alias("n")).filter(F.col("n") > subtrie)
           .select("block", "value", F.ceil(F.col("n") / subtrie).cast("int").alias("subs")))
    cut = keyed.join(big, ["block", "value"], "left").withColumn("subs", F.coalesce("subs", F.lit(1)))
    # a sub-trie meets itself and every other one: each row goes to ``subs`` units
    sub = F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int")
    units = (cut.withColumn("sub", sub)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
             .select("block", "value", F.least("sub", "o").alias("u"),
                     F.greatest("sub", "o").alias("w"),
                     F.when(F.col("sub") == F.col("o"), 2).when(F.col("sub") < F.col("o"), 0).otherwise(1).alias("side"),
                     "fp"))
    key = ["block", "value", "u", "w"]
    # a self-join unit holds side 2 only, a pair of sub-tries sides 0 and 1
    return units.repartition(*key).sortWithinPartitions(*key).mapInArrow(_walk(max_bits), EDGES)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node reachable. Every round is written under the shared folder."""
    edges = store(edges.filter("a <> b").distinct(), "edges")
    whole = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root"))
        hook = store(hook, "hooks")
        while True:  # follow pointers to their ends
            ends = hook.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
            jumped = store(hook.join(ends, F.col("root") == F.col("n2"), "left").select(
                "node", F.coalesce("r2", "root").alias("root"), (F.col("r2") < F.col("root")).alias("moved")), "hooks")
            moved = not jumped.filter("moved").isEmpty()
            hook = jumped.select("node", "root")
            if not moved:
                break
        ends = hook.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        if whole is None:
            whole = hook
        else:
            whole = store(whole.join(ends, F.col("root") == F.col("n2"), "left").select(
                "node", F.coalesce("r2", "root").alias("root")), "components")
        ea = edges.join(ends, F.col("a") == F.col("n2")).select(F.col("r2").alias("a"), "b")
        left = ea.join(ends, F.col("b") == F.col("n2")).select("a", F.col("r2").alias("b"))
        edges = store(left.filter("a <> b").distinct(), "edges")
        if edges.isEmpty():
            return whole


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, fingerprint (16 lowercase hex
    digits) and component_id, the smallest id reachable over links of
    ``max_bits`` or fewer differing bits, itself included.

    Null and empty texts have fingerprint zero and link like any other. Null
    ids keep their row; they are never a component_id unless every id of the
    component is null. Repeated rows give repeated rows. An empty table gives
    an empty result. Other columns are ignored.
    """
    prints = store(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = store(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    whole = components(near_edges(least, max_bits))
    rooted = least.join(whole, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(of_root, "root").select(F.col("fp").alias("fp2"), "component_id")
    return prints.join(classes, F.col("fp") == F.col("fp2")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that
    of smallest id, then of smallest hash of id and text; of rows alike in
    both one stays. A null id goes before others, as it sorts first. Columns
    may have any names."""
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    named = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), key.alias("key")).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = near_duplicates(named, "row", "text", shingle, max_bits)
    stay = store(found.select(F.col("component_id.id").alias("s_id"), F.col("component_id.key").alias("s_key")).distinct(), "staying")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(docs.columns)], key.alias("key"))
    row_id = f"x{docs.columns.index(id_col)}"
    return (rows.join(stay, F.col(row_id).eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")), "left_semi")
            .dropDuplicates([row_id, "key"]).select(*[F.col(f"x{i}").alias(c) for i, c in enumerate(docs.columns)]))
