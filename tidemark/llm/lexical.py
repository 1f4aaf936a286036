"""Ranked lexical search with per-term geometric blocking.

Documents are cut into shards of bounded size, so that a term that all of
them hold is as many posting lists as there are shards. In a shard the
posting list of every term asked for is clustered by document similarity
(documents as vectors of term impacts, compared in a random projection), and
each block keeps the coordinatewise maximum of its documents' vectors. What a
query scores against that summary is at least what it scores against any
document of the block. A query's blocks, of all its terms, are visited from
the highest bound down until the bound falls below the score of the k-th best
document so far; with equality a block is still visited. Integers throughout:
bounds and scores are exact.

Frequencies come from one pass over the whole table; they and the vectors
hold the terms asked for, the lengths hold all terms. A task keeps the k best
per query over all its shards, so its bar rises from shard to shard; Spark
merges the tasks' lists.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, store, text_batches

SHARD = 8192  # documents
BLOCK = 64  # documents of a block, on average
DIMENSIONS = 16  # of the projection
CELLS = 1 << 22  # summary cells filled at once
AT_ONCE = 16  # blocks visited between two looks at the bar
MOST_TERMS = 1 << 18  # distinct query terms of one search; they are broadcast

#: a-z, 0-9 and bytes of other characters are kept, A-Z lower-cased, the rest parts terms
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


# -- one shard ----------------------------------------------------------------

def _flat(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows' entries in a compressed row table, and the rows' own ends."""
    size = ptr[rows + 1] - ptr[rows]
    ends = np.cumsum(size)
    return np.repeat(ptr[rows] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0), ends


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[ends] - total[np.append(0, ends[:-1])]


class Shard:
    """Documents as rows (ptr, term, impact), their blocks as rows
    (block_ptr, block_term, block_most), blocks of term t from list_ptr[t] on."""

    def __init__(self, ids: list, ptr: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int, weight: np.ndarray):
        self.ids, self.ptr, self.term, self.impact = ids, ptr, term, impact
        n = len(ids)
        doc = np.repeat(np.arange(n), np.diff(ptr))
        order = np.argsort(term, kind="stable")
        lists = doc[order]
        ends = np.searchsorted(term[order], np.arange(n_terms + 1))
        placed = self.project(doc, n, n_terms, weight)
        members, sizes, blocks_of, summaries = [], [], np.zeros(n_terms, np.int64), []
        for t in np.flatnonzero(np.diff(ends)):
            posted = lists[ends[t]:ends[t + 1]]
            of, count = self.cluster(posted, placed)
            order_ = np.argsort(of, kind="stable")
            held = np.bincount(of, minlength=count)
            held = held[held > 0]
            members.append(posted[order_])
            sizes.append(held)
            blocks_of[t] = len(held)
            summaries += self.summarise(posted[order_], held, n_terms)
        self.members = np.concatenate(members) if members else np.zeros(0, np.int64)
        self.member_ends = np.cumsum(np.concatenate(sizes)) if sizes else np.zeros(0, np.int64)
        self.list_ptr = np.append(0, np.cumsum(blocks_of))
        self.block_ptr = np.append(0, np.cumsum([x for s in summaries for x in s[0]])).astype(np.int64)
        self.block_term = np.concatenate([s[1] for s in summaries]) if summaries else np.zeros(0, np.int64)
        self.block_most = np.concatenate([s[2] for s in summaries]) if summaries else np.zeros(0, np.int64)

    def project(self, doc: np.ndarray, n: int, n_terms: int, weight: np.ndarray) -> np.ndarray:
        """Unit vectors of a random projection that keeps similarities, near enough to cluster by."""
        signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (n_terms, DIMENSIONS))
        value = (weight[self.term] * self.impact).astype(np.float32)
        out = np.stack([np.bincount(doc, value * signs[self.term, d], n) for d in range(DIMENSIONS)], axis=1).astype(np.float32)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    @staticmethod
    def cluster(posted: np.ndarray, placed: np.ndarray) -> tuple[np.ndarray, int]:
        """The nearest of evenly chosen members for each of a list; at least one block."""
        count = -(-len(posted) // BLOCK)
        if count == 1:
            return np.zeros(len(posted), np.int64), 1
        heads = placed[posted[np.arange(count) * len(posted) // count]]
        return np.argmax(placed[posted] @ heads.T, axis=1), count

    def summarise(self, members: np.ndarray, held: np.ndarray, n_terms: int) -> list[tuple]:
        """Coordinatewise maxima of the blocks, some blocks at a time."""
        out, step = [], max(1, CELLS // n_terms)
        ends = np.cumsum(held)
        for a in range(0, len(held), step):
            b = min(a + step, len(held))
            first = ends[a] - held[a]
            at, _ = _flat(self.ptr, members[first:ends[b - 1]])
            own = members[first:ends[b - 1]]
            block = np.repeat(np.repeat(np.arange(b - a), held[a:b]), self.ptr[own + 1] - self.ptr[own])
            most = np.zeros((b - a) * n_terms, np.int32)
            np.maximum.at(most, block * n_terms + self.term[at], self.impact[at])
            cells = np.flatnonzero(most)
            out.append((np.bincount(cells // n_terms, minlength=b - a), (cells % n_terms).astype(np.int32), most[cells]))
        return out

    def search(self, query: np.ndarray, times: np.ndarray, worth: np.ndarray, best: list, k: int) -> list:
        """``best``, the k best (-score, id order, id) so far, with this shard's
        documents. ``worth`` is all zero, of a cell per term, and is left so."""
        blocks = np.concatenate([np.arange(self.list_ptr[t], self.list_ptr[t + 1]) for t in query] or [np.zeros(0, np.int64)])
        if not len(blocks):
            return best
        worth[query] = times
        at, ends = _flat(self.block_ptr, blocks)
        bound = _sums(worth[self.block_term[at]] * self.block_most[at], ends)
        order = np.argsort(-bound, kind="stable")
        seen = np.zeros(len(self.ids), bool)
        for a in range(0, len(order), AT_ONCE):
            bar = -best[-1][0] if len(best) == k else 1
            take = order[a:a + AT_ONCE]
            take = take[bound[take] >= bar]
            if not len(take):
                break
            take = blocks[take]
            begin = np.where(take > 0, self.member_ends[take - 1], 0)
            size = self.member_ends[take] - begin
            docs = self.members[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            docs = np.unique(docs[~seen[docs]])
            seen[docs] = True
            at, ends = _flat(self.ptr, docs)
            score = _sums(worth[self.term[at]] * self.impact[at], ends)
            good = score >= bar
            if good.any():
                met = [(-s, self.ids[d] is not None, self.ids[d]) for s, d in zip(score[good].tolist(), docs[good].tolist())]
                best = sorted(best + met, key=lambda x: (x[0], x[1], x[2] if x[1] else 0))[:k]
        worth[query] = 0
        return best


# -- on documents -----------------------------------------------------------

def _vectors(schema: pa.Schema, words):
    """Rows (id, text) to rows (id, n, terms, counts): the count of all terms,
    and the terms asked for with their own counts."""
    def run(batches):
        number = words.value
        for b in batches:
            n, terms, counts, ends = [], [], [], [0]
            for value in b.column(1):
                all_ = terms_of(value.as_py()) if value.is_valid else []
                asked = np.array([t for t in map(number.get, all_) if t is not None], np.int32)
                t, c = np.unique(asked, return_counts=True)
                n.append(len(all_))
                terms.append(t)
                counts.append(c)
                ends.append(ends[-1] + len(t))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int64), pa.int64()).cast(f.type.value_type))
                     if x else pa.array([], f.type) for x, f in ((terms, schema[2]), (counts, schema[3]))]
            yield batch(schema, b.column(0), n, *lists)
    return run


def _search(schema: pa.Schema, asked, k: int, shard: int):
    """Rows (id, n, terms, counts) to the k best of the task for every query."""
    def run(batches):
        weight, total, lengths, queries = asked.value
        n_terms = len(weight)
        worth = np.zeros(n_terms, np.int64)
        best: dict = {}

        def close(rows: pa.Table):
            ids, n = rows["id"].to_pylist(), rows["n"].to_numpy()
            lists = [rows[c].combine_chunks() for c in ("terms", "counts")]
            size = np.append(0, np.cumsum(lists[0].value_lengths().to_numpy()))
            term, tf = (x.flatten().to_numpy() for x in lists)
            tf = tf.astype(np.int64)
            m = 100 - 75 + (75 * n * total) // max(lengths, 1)
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(size)))
            s = Shard(ids, size, term, impact.astype(np.int32), n_terms, weight)
            for q, (terms, times) in enumerate(queries):
                best[q] = s.search(terms, times * weight[terms], worth, best.get(q, []), k)

        held, count = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, shard - count)
                b = b.slice(part.num_rows)
                held.append(part)
                count += part.num_rows
                if count == shard:
                    close(pa.Table.from_batches(held))
                    held, count = [], 0
        if held:
            close(pa.Table.from_batches(held))
        for q, found in best.items():
            if found:
                yield batch(schema, [q] * len(found), [i for *_, i in found], [-s for s, *_ in found])
    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = 10, shard: int = SHARD) -> DataFrame:
    """The ``k`` best documents of each item: ``item_col``, rank int from 1,
    ``id_col``, score long, scores above 0 only.

    Terms are maximal runs of letters a-z, A-Z (lower-cased), digits and all
    characters beyond ASCII. With N the documents that hold a term, L all
    their terms, n a document's terms, df a term's documents and tf its count
    in the document: a term weighs floor(1000*ln((2*N+2)/(2*df+1))), a
    document's m is 25+((75*n*N) div L), its score sums
    weight*((10^9*tf) div (1000*tf+8*m)) over the item's terms, repeats included.

    Null and empty texts have no terms: such documents are never found, such
    items find nothing. Rows are documents each, repeated ones too; equal
    scores rank by ascending id, null first. Repeated items are answered each
    (``rank`` runs per row of ``items``). Empty tables give an empty result;
    other columns are ignored. The items are a stated set: their distinct
    terms, at most MOST_TERMS, go to every task.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    items = store(items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"),
                               F.monotonically_increasing_id().alias("row")), "items")
    rows = [(r["row"], terms_of(bytes(r["text"]))) for r in items.filter("text IS NOT NULL").select("row", "text").toLocalIterator()]
    number: dict[bytes, int] = {}
    queries = []
    for _, words in rows:
        at, times = np.unique(np.array([number.setdefault(w, len(number)) for w in words], np.int64), return_counts=True)
        queries.append((at, times))
        if len(number) > MOST_TERMS:
            raise ValueError(f"the items hold more than {MOST_TERMS} distinct terms; search them in parts")
    vec_type = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                             T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
    source = text_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    vectors = store(source.mapInArrow(_vectors(to_arrow_schema(vec_type), spark.sparkContext.broadcast(number)), vec_type), "vectors")
    total, lengths = vectors.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(len(number), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # one row per query term
        held[r["t"]] = r["count"]
    weight = np.floor(1000 * np.log((2 * total + 2) / (2 * held + 1))).astype(np.int64)
    asked = spark.sparkContext.broadcast((weight, total, lengths, queries))
    out = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())])
    found = vectors.filter(F.size("terms") > 0).select("id", "n", "terms", "counts").mapInArrow(
        _search(to_arrow_schema(out), asked, k, shard), out)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(q, row) for q, (row, _) in enumerate(rows)], "q int, row long")
    return ranked.join(names, "q").join(items.select("row", "item"), "row").select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
