"""Language identification by cross-parsing entropy.

Labelled text of each language is compiled into a suffix automaton. A text
is parsed against each: the longest match in that language's text is a
phrase, the next phrase begins where the match ends. Phrases times the bits
of a place in the language's text, over the letters read, estimate the cross
entropy; the language that needs least wins.

Learning takes a bounded sample (documented parameters): for each language
``per_lang`` labelled documents of smallest hashed id among those whose text
has a letter, the first ``excerpt`` characters of each, ``learn_chars`` symbols
in all, taken from the start, the middle and the end of the excerpts. All
languages together learn at most ``all_chars`` symbols: with the defaults each
has 24,000 up to 16 languages and its equal share beyond (1,000 with the most
languages allowed, ``all_chars`` / 1,000). Every text is classified whole.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, text_batches, worker_cache

DENSE = 200  # most different letters for which automata become full tables
CHUNK = 2048  # symbols parsed in one go; a phrase never crosses a chunk
LEAST_CHARS = 1000  # symbols a language learns at least; sets how many languages there may be
SPREAD = 3  # places of an excerpt to learn from
GAP, UNKNOWN = 0, 1  # symbols: a run of other characters, a letter outside the alphabet
BATCH_CHARS = 1 << 20


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton (state 0 is the start)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in nxt[at]:
            nxt[at][c] = new
            at = link[at]
        if at >= 0:
            q = nxt[at][c]
            if length[q] == length[at] + 1:
                link[new] = q
            else:  # q also ends longer strings: split off the shorter ones
                part = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[at] + 1)
                while at >= 0 and nxt[at].get(c) == q:
                    nxt[at][c] = part
                    at = link[at]
                link[q] = link[new] = part
        last = new
    return nxt


def spread_parts(symbols: np.ndarray, most: int) -> list[np.ndarray]:
    """At most ``most`` of the symbols: all, or ``SPREAD`` stretches of equal
    length from the first to the last."""
    if len(symbols) <= most or most < 30 * SPREAD:
        return [symbols[:most]]
    each = most // SPREAD
    return [symbols[a:a + each] for a in np.linspace(0, len(symbols) - each, SPREAD).astype(int)]


class SparseTable:
    """Transitions of many automata by row displacement: those of a state lie
    at its own offset plus their symbols, each place taken by one state. Small
    whatever the alphabet, and found by one look."""

    def __init__(self, states: list[dict[int, int]], size: int):
        room = size + 4 * sum(map(len, states)) + 64
        self.owner = np.full(room + 2 * size, -1, np.int32)
        self.to = np.zeros(room + 2 * size, np.int32)
        self.off = np.zeros(len(states), np.int64)
        rnd = np.random.default_rng(0)
        fan = np.array([len(g) for g in states], np.int64)
        for s in np.argsort(-fan, kind="stable")[:int((fan > 1).sum())].tolist():  # most first, while there is room
            syms = np.fromiter(states[s], np.int64, len(states[s]))
            for _ in range(20):
                tried = rnd.integers(0, room, 32)
                fits = np.flatnonzero((self.owner[tried[:, None] + syms] < 0).all(axis=1))
                if len(fits):
                    at = int(tried[fits[0]])
                    break
            else:  # crowded: room of its own at the end
                at = len(self.owner)
                self.owner = np.append(self.owner, np.full(2 * size, -1, np.int32))
                self.to = np.append(self.to, np.zeros(2 * size, np.int32))
            self.off[s] = at
            self.owner[at + syms] = s
            self.to[at + syms] = np.fromiter(states[s].values(), np.int64, len(syms))
        single = np.flatnonzero(fan == 1)
        syms = np.array([next(iter(states[s])) for s in single.tolist()], np.int64)
        place = np.flatnonzero(self.owner[size:] < 0)[:len(single)] + size
        self.off[single] = place - syms
        self.owner[place] = single
        self.to[place] = [next(iter(states[s].values())) for s in single.tolist()]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after ``symbol``, and where there is no transition."""
        at = self.off.take(state) + symbol
        return self.to.take(at), self.owner.take(at) != state


class CrossParser:
    """All letters of the samples are in the alphabet; one that a language's
    own sample lacks ends a phrase in that language only. Up to ``dense``
    letters the automata are full tables, beyond that sparse ones; both give
    the same costs."""

    def __init__(self, samples: dict[str, list[str]], learn_chars: int, dense: int = DENSE):
        self.langs = sorted(samples)
        letters = {c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}
        alphabet = {c: k + 2 for k, c in enumerate(sorted(letters))}
        self.size = len(alphabet) + 3  # one more symbol separates learnt texts
        self.symbol = np.zeros(0x110000, np.int32)
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        for m in regex.finditer(r"\p{L}+", every):
            for c in m.group():
                self.symbol[ord(c)] = alphabet.get(c.lower()[0], UNKNOWN)
        for c, k in alphabet.items():
            self.symbol[ord(c)] = k
        self.dense = len(alphabet) <= dense
        tables, states, first, self.start, self.bits, base = [], [], [], [], [], 0
        for lang in self.langs:
            learnt: list[int] = []
            texts = samples[lang]
            for t in texts:
                for part in spread_parts(self.symbols(t), max(1, learn_chars // len(texts))):
                    learnt += part.tolist() + [self.size - 1]
            nxt = automaton(learnt)
            self.bits.append(math.log2(len(learnt) + 2))
            if not self.dense:
                states += [{c: base + to for c, to in go.items() if c not in (UNKNOWN, self.size - 1)} for go in nxt]
                first.append(np.full(self.size, base, np.int64))
                first[-1][list(states[base])] = list(states[base].values())
                self.start.append(base)
                base += len(nxt)
                continue
            # a transition is state * size; where a phrase ends, the complement of the start's own
            table = np.full((len(nxt), self.size), 0, np.int32)
            for c in range(self.size):
                known = c not in (UNKNOWN, self.size - 1)
                table[:, c] = ~np.int32((base + nxt[0].get(c, 0) * known) * self.size)
            for s, go in enumerate(nxt):
                for c, to in go.items():
                    if c not in (UNKNOWN, self.size - 1):
                        table[s, c] = (base + to) * self.size
            tables.append(table)
            self.start.append(base * self.size)
            base += len(nxt)
        if self.dense:
            self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        else:
            self.sparse, self.first = SparseTable(states, self.size), np.stack(first)

    def symbols(self, text: str) -> np.ndarray:
        s = self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        gap = s == GAP
        return s[~(gap & np.append(True, gap[:-1]))] if len(s) else s

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits by language and text, and the number of letters of each text."""
        found = [self.symbols(t) for t in texts]
        letters = np.array([int((s != GAP).sum()) for s in found], np.int64)
        if not self.langs:
            return np.zeros((0, len(texts))), letters
        lanes = [(k, s[a:a + CHUNK]) for k, s in enumerate(found) for a in range(0, len(s), CHUNK)]
        lanes.sort(key=lambda x: -len(x[1]))
        size = np.array([len(s) for _, s in lanes], np.int64)
        rows = np.zeros((int(size.max(initial=0)), len(lanes)), np.int64)
        for j, (_, s) in enumerate(lanes):
            rows[:len(s), j] = s
        state = np.repeat(np.array(self.start, np.int64)[:, None], len(lanes), axis=1)
        phrases = np.ones((len(self.langs), len(lanes)), np.int64)
        active = np.searchsorted(-size, -np.arange(1, len(rows) + 1), side="right")
        for t, n in enumerate(active.tolist()):
            if self.dense:
                go = self.table.take(state[:, :n] + rows[t, :n])
                phrases[:, :n] += go < 0
                state[:, :n] = go ^ (go >> 31)
            else:
                go, ends = self.sparse.step(state[:, :n], rows[t, :n])
                phrases[:, :n] += ends
                state[:, :n] = np.where(ends, self.first.take(rows[t, :n], axis=1), go)
        of = np.array([k for k, _ in lanes], np.int64)
        total = np.stack([np.bincount(of, weights=p, minlength=len(texts)) for p in phrases]) if lanes else np.zeros((len(self.langs), len(texts)))
        return total * np.array(self.bits)[:, None], letters

    def classify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score); score is the winner's share of the weights
        2**-(bits, of at most 64 letters at the text's rate)."""
        bits, letters = self.costs([t or "" for t in texts])
        out = []
        for k, n in enumerate(letters.tolist()):
            if not n or not self.langs:
                out.append(("und", 0.0))
                continue
            rate = bits[:, k] * min(n, 64) / n
            best = int(np.argmin(rate))
            out.append((self.langs[best], float(1 / np.exp2(rate[best] - rate).sum())))
        return out


def learning_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int, excerpt: int,
                    most_langs: int = 400) -> dict[str, list[str]]:
    """Texts by language; at most ``per_lang`` * ``excerpt`` characters of each
    of ``most_langs`` languages reach the driver (more are an error). Of an id
    that repeats with a language the least text is taken."""
    good = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                       F.substring(F.col(f"`{text_col}`"), 1, excerpt).alias("t")).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("t").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("id"))
    known = good.select("lang").distinct().limit(most_langs + 1).count()
    if known > most_langs:
        raise ValueError(f"more than {most_langs} languages to learn; raise all_chars or clean the language column")
    # an id counts once, however often it repeats
    order = Window.partitionBy("lang").orderBy("hash", "id")
    ids = (good.groupBy("lang", "hash", "id").agg(F.lit(1).alias("one")).withColumn("k", F.row_number().over(order))
           .filter(F.col("k") <= per_lang).select(F.col("id").alias("s_id"), F.col("lang").alias("s_lang")))
    rows = (good.join(F.broadcast(ids), (F.col("id") == F.col("s_id")) & (F.col("lang") == F.col("s_lang")))
            .groupBy("lang", "hash", "id").agg(F.min("t").alias("t")).collect())
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["hash"], r["t"])):
        out.setdefault(r["lang"], []).append(r["t"])
    return out


def identify(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_lang: int = 64, excerpt: int = 4096, learn_chars: int = 24_000, all_chars: int = 400_000) -> DataFrame:
    """``id_col``, lang_pred and score (0 to 1) for every row of ``docs``,
    learnt from the rows of ``learn`` with a language.

    Null texts and texts without a letter are ``und`` with score 0, as is all
    if nothing was learnt. Equal costs go to the first language by name. Rows
    to learn from with null id or language, or without a letter, are left out
    before the sample is chosen. Repeated rows and null ids are kept; other
    columns never count. Bounds of learning: see the module; more than
    ``all_chars`` / 1,000 languages are an error.
    """
    samples = learning_sample(learn, id_col, text_col, lang_col, per_lang, excerpt, all_chars // LEAST_CHARS)
    learn_chars = min(learn_chars, all_chars // max(1, len(samples)))
    rows = text_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = T.StructType([rows.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    schema = to_arrow_schema(out)

    mark = hash(repr(samples))

    def run(batches):
        parser = worker_cache(("cross-parser", mark), lambda: CrossParser(samples, learn_chars))
        for b in batches:
            texts = b.column(1).to_pylist()
            part = np.cumsum([len(t or "") for t in texts]) // BATCH_CHARS
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if e > s:
                    got = parser.classify(texts[s:e])
                    yield batch(schema, b.column(0).slice(s, e - s), [g[0] for g in got], pa.array([g[1] for g in got], pa.float64()))

    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
