"""Packing documents into sequences: shortest-pack-first over the histogram
of lengths.

Each document's ids (and an end id) are cut into whole sequences and one
remainder. Only the histogram of piece lengths, at most one number per
length, reaches the driver. There lengths are placed longest first, always
into the shortest pack that has room; packs with the same content are one
pattern with a count. Every piece then finds its place by its rank among the
pieces of its length.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.bpe import CACHE_WORDS, SpeculativeBPE
from tidemark.llm.common import batch, pieces_of, store, text_batches, worker_cache

#: pieces of one length ranked by one task, about
RANKED = 100_000


class LibraryIds:
    """Ids as the tokenizers library gives them: its model tokenizes words,
    a bounded cache keeps white-space-free runs."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        own = SpeculativeBPE(path)
        tokenize = Tokenizer.from_file(path).model.tokenize
        find, table, four = own.words.findall, own.to_chars, own.four

        class Runs(dict):
            def __missing__(self, run: str) -> bytes:
                ids = b"".join([four[t.id] for w in find(run)
                                for t in tokenize(w.encode().decode("latin-1").translate(table))])
                if len(self) >= cache_words:  # the older half stays: mostly the frequent runs
                    old = list(islice(self.items(), cache_words // 2))
                    self.clear()
                    self.update(old)
                self[run] = ids
                return ids

        self.own, self.seen = own, Runs()

    def ids(self, text: str | None) -> bytes:
        own, get, out = self.own, self.seen.__getitem__, []
        for k, part in enumerate(own.marks.split(text or "")):
            if k % 2:
                out.append(own.four[own.special[part]])
            elif part:
                for piece in pieces_of(part):
                    out.append(b"".join(map(get, own.runs(own.lowered(piece)))))
        return b"".join(out)


def library_ids(path: str) -> LibraryIds:
    return worker_cache(("library ids", path), lambda: LibraryIds(path))


def pack_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of packs that hold ``histogram`` (length: how many).

    Longest lengths first; each goes into the shortest packs with room, many
    at a time. Every step leaves at most one pattern split, so there are at
    most about two patterns per length, whatever the counts.
    """
    packs: list[tuple[int, tuple[int, ...], int]] = []  # (filled, lengths, count), shortest first
    for length in sorted(histogram, reverse=True):
        left, grown = histogram[length], []
        while left and packs and packs[0][0] + length <= capacity:
            filled, lengths, count = heapq.heappop(packs)
            used = min(count, left)
            if count > used:
                heapq.heappush(packs, (filled, lengths, count - used))
            left -= used
            heapq.heappush(packs, (filled + length, (*lengths, length), used))
        if left:
            grown.append((length, (length,), left))
        for p in grown:
            heapq.heappush(packs, p)
    merged: dict[tuple[int, ...], int] = {}
    for _, lengths, count in packs:
        merged[lengths] = merged.get(lengths, 0) + count
    return sorted(((n, p) for p, n in merged.items()), key=lambda x: (x[1], x[0]), reverse=True)


def places(patterns: list[tuple[int, tuple[int, ...]]], capacity: int) -> tuple[np.ndarray, ...]:
    """Sorted slots: key (length, first rank), first sequence, offset."""
    cursor: dict[int, int] = {}
    rows, base = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = cursor.get(length, 0)
            cursor[length] = first + count
            rows.append((length, first, base, offset))
            offset += length
        base += count
    rows.sort()
    return tuple(np.array([r[k] for r in rows], np.int64) for k in range(4))


def cut_documents(docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens) per piece."""
    rows = text_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = T.StructType([rows.schema["id"], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                        T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())])
    schema, end, step = to_arrow_schema(out), end_id.to_bytes(4, "little"), 4 * capacity

    def run(batches):
        ids_of = library_ids(path).ids
        for b in batches:
            of, start, length, crc, total = [], [], [], [], []
            for k, text in enumerate(b.column(1)):
                ids = ids_of(text.as_py()) + end
                for s in range(0, len(ids), step):
                    part = ids[s:s + step]
                    of.append(k)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(ids) // 4)
            yield batch(schema, b.column(0).take(np.array(of, np.int64)) if of else b.column(0).slice(0, 0), start, length, crc, total)

    return rows.mapInArrow(run, out)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         end_id: int = 1) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (all long).

    Null and empty texts are a document of the end id alone. Pieces are whole
    sequences of ``capacity`` ids and one remainder per row; repeated rows
    are packed each. Null ids are kept. Sequences number from 0 without gaps;
    pieces lie in them without gaps. An empty table gives an empty result.
    Other columns are ignored.
    """
    pieces = store(cut_documents(docs, path, id_col, text_col, capacity, end_id), "pieces")
    counts = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    total = sum(r["count"] for r in counts)
    length, first, base, offset = places(pack_patterns({r["length"]: r["count"] for r in counts}, capacity), capacity)
    # rank among the pieces of a length: a hot length is ranked in salted parts, laid one after another
    salts = max(64, -(-total // RANKED))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(salts)))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("length").alias("p_length"), F.col("salt").alias("p_salt"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = (salted.withColumn("within", F.row_number().over(inside) - 1)
              .join(starts, (F.col("length") == F.col("p_length")) & (F.col("salt") == F.col("p_salt")))
              .select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("within")).alias("rank")))
    out = T.StructType(ranked.schema.fields[:5] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    schema = to_arrow_schema(out)

    def place(batches):
        key = length * (total + 1) + first
        for b in batches:
            n, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(key, n * (total + 1) + rank, side="right") - 1
            yield batch(schema, *b.columns[:5], base[at] + rank - first[at], offset[at])

    return ranked.mapInArrow(place, out).withColumnRenamed("id", id_col)
