"""Quality classifier: hashed word n-grams, logistic regression by
follow-the-regularised-leader, scored as sparse dot products.

Training takes at most ``max_train`` labelled rows (a documented bound; the
ones of smallest hashed id, so the choice never depends on row order). They
are dealt to ``shards`` tasks; each runs FTRL-proximal over its rows and the
models are averaged. Scoring reads every whole text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, pieces_of, text_batches, worker_cache

BITS = 18
CACHE_WORDS = 200_000
WORDS = regex.compile(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]+")


def _codes(run: str) -> bytes:
    """Word hashes of a white-space-free run: letters in lower case (all
    capitals keep a mark), digits by their number, signs by their first two."""
    out = []
    for w in WORDS.findall(run):
        if w[0].isnumeric():
            w = "0" * min(len(w), 8)
        elif w.isalpha():
            w = ("^" if len(w) > 2 and w.isupper() else "") + w.lower()
        else:
            w = w[:2] + ("+" if len(w) > 2 else "")
        out.append(xxhash.xxh64_intdigest(w))
        if w[0] == "^":
            out.append(xxhash.xxh64_intdigest("^"))
    return np.array(out, "<u8").tobytes()


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their values (1 + log count, scaled to
    length one) of a text's words and word pairs (all pairs of a word with
    itself are one feature); feature 0 is the bias."""
    cache = worker_cache("word hashes", dict)
    if len(cache) > CACHE_WORDS:  # the older half stays: mostly the frequent words
        for w in list(cache)[CACHE_WORDS // 2:]:
            del cache[w]
    found = []
    for piece in pieces_of(text or ""):
        runs = piece.split()
        for r in set(runs).difference(cache):
            cache[r] = _codes(r)
        found.append(b"".join(map(cache.__getitem__, runs)))
    h = np.frombuffer(b"".join(found), "<u8").astype(np.uint64)
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    pairs[h[:-1] == h[1:]] = 0  # any word said twice running
    h = np.concatenate([h, pairs ^ (pairs >> np.uint64(29))])
    size = (1 << bits) - 1
    i, n = np.unique((h % np.uint64(size)).astype(np.int64) + 1, return_counts=True)
    v = 1 + np.log(n)
    norm = np.sqrt((v * v).sum())
    return np.append(0, i), np.append(1.0, v / norm if len(v) else v)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int = BITS, epochs: int = 5, alpha: float = 1.0,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal over ``rows``."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(zi, ni):
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for i, v, y in rows:
            zi, ni = z[i], n[i]
            w = weights(zi, ni)
            g = (sigmoid(float(w @ v)) - y) * v
            more = ni + g * g
            z[i] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[i] = more
    return weights(z, n)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_train: int = 16_000, shards: int = 8, bits: int = BITS) -> np.ndarray:
    """Averaged weights learnt from ``labels`` (id, 0/1) of rows in ``docs``.

    Null ids and labels are left out; of an id with several labels the mean
    decides (0.5 and more is 1). No labelled row at all gives zero weights
    (every score 0.5). Of an id that repeats in ``docs`` the text of least
    hash is learnt, so ``max_train`` bounds the rows too. At most
    ``max_train`` ids and ``shards`` weight vectors of 2**bits floats reach
    the driver.
    """
    ids = (labels.select(F.col(f"`{id_col}`").alias("l_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
           .dropna().groupBy("l_id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
           .withColumn("order", F.xxhash64("l_id")).orderBy("order", "l_id").limit(max_train))
    chosen = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
              .join(F.broadcast(ids), F.col("id") == F.col("l_id"))
              .groupBy("order", "id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one row per id
              .select((F.pmod("order", F.lit(shards))).cast("int").alias("shard"), "order", "id", "text", "y"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "id", "text"], na_position="first")
        w = ftrl([(*features(t, bits), y) for t, y in zip(pdf["text"], pdf["y"])], bits)
        return pd.DataFrame({"n": [len(pdf)], "w": [w.astype("<f4").tobytes()]})

    parts = chosen.groupBy("shard").applyInPandas(fit, "n long, w binary").collect()
    total = sum(p["n"] for p in parts)
    mean = np.zeros(1 << bits, np.float64)
    for p in sorted(parts, key=lambda p: p["w"]):
        mean += np.frombuffer(p["w"], "<f4") * (p["n"] / total)
    return mean.astype(np.float32)


def quality_scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                   carry: bool = False, bits: int = BITS, added: str | None = None) -> DataFrame:
    """``id_col`` (with ``carry``: every column of ``docs``) and score, 0 to 1
    (named ``added``, by default ``score`` or, carried, ``_score``; ``docs``
    must not carry one of that name).

    Null and empty texts have only the bias feature; the score depends on the
    text alone, so repeated rows score alike. An empty table gives an empty
    result.
    """
    cols = docs.columns if carry else [id_col, text_col]
    rows = text_batches(docs).select(*[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(cols)])
    at = cols.index(text_col)
    n = len(cols) if carry else 1
    out = T.StructType(rows.schema.fields[:n] + [T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            scores = []
            for text in b.column(at):
                i, v = features(text.as_py(), bits)
                scores.append(float(sigmoid(float(weights[i] @ v))))
            yield batch(schema, *b.columns[:n], pa.array(scores, pa.float64()))

    scored = rows.mapInArrow(run, out)
    return scored.select(*[F.col(f"x{i}").alias(c) for i, c in enumerate(cols[:n])],
                         F.col("score").alias(added or ("_score" if carry else "score")))


def held_out(id_col, folds: int = 5, fold: int = 0):
    """The documents whose labels are never learnt from."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def op_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    w = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = quality_scores(docs, w)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
