"""Token counts by compiled transducers.

Two deterministic transducers count a byte-level BPE vocabulary's tokens
without making them:

* The splitter reads character classes; its transitions carry the piece
  borders (one before the character read, one a character earlier). A batch
  of texts is cut into chunks; each chunk is a map from start state to end
  state (mostly constant after a few characters), the maps are composed by a
  parallel prefix scan, and then all chunks run side by side from their true
  start states.
* The merger reads the bytes of a piece. Its state holds, for every suffix
  that may still grow into a token, the last token before that suffix and
  how many tokens fewer there are; its transitions carry the change of the
  number of tokens. A token may end a prefix only where it is compatible
  with the token before it (the pair test of the BPE operator), and exactly
  one does. States and transitions are compiled when first met; pieces run
  side by side, one byte a step.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.bpe import Merges, byte_alphabet
from tidemark.llm.common import batch, text_batches, worker_cache

CHUNK = 512
BATCH_CHARS = 1 << 20
MAX_STATES = 100_000

#: character classes of the splitter
LETTER, SINGLE, R, V, E, L, NUMBER, SPACE, BLANK, QUOTE, OTHER, END = range(12)
#: its states: a piece begins next; in letters, numbers, signs; after one
#: space or blank, after several ending so; after a quote that begins a
#: piece, and after that quote and r, v or l
NEXT, LETTERS, NUMBERS, SIGNS, ONE_SPACE, ONE_BLANK, SPACES, BLANKS, QUOTED, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
HERE, BACK = 1, 2  # a piece begins at this character, at the one before


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and borders by state * 12 + class, for the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?signs+|blanks not before a sign|blanks."""
    letters = (LETTER, SINGLE, R, V, E, L)
    run = {**dict.fromkeys(letters, LETTERS), NUMBER: NUMBERS, OTHER: SIGNS}
    fresh = run | {SPACE: ONE_SPACE, BLANK: ONE_BLANK, QUOTE: QUOTED, END: NEXT}  # a piece begins with the class
    after = {s: (fresh, HERE) for s in (NEXT, LETTERS, NUMBERS, SIGNS, QUOTED)}
    table = {s: {c: (to, border) for c, to in kind.items()} for s, (kind, border) in after.items()}
    for c in letters:
        table[LETTERS][c] = (LETTERS, 0)
    table[NUMBERS][NUMBER] = (NUMBERS, 0)
    for s in (SIGNS, QUOTED):
        table[s][OTHER] = table[s][QUOTE] = (SIGNS, 0)
    table[QUOTED] |= {SINGLE: (NEXT, 0), R: (QUOTE_R, 0), V: (QUOTE_V, 0), L: (QUOTE_L, 0)}
    for s, more in ((ONE_SPACE, 0), (ONE_BLANK, 0), (SPACES, BACK), (BLANKS, BACK)):
        blank = s in (ONE_BLANK, BLANKS)
        table[s] = {c: (to, more | HERE * blank) for c, to in fresh.items()}
        if not blank:  # the space belongs to what follows
            table[s][QUOTE] = (SIGNS, more)
        table[s] |= {SPACE: (SPACES, 0), BLANK: (BLANKS, 0), END: (NEXT, HERE)}
    for s, c in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, L)):
        table[s] = {k: (to, border | BACK) for k, (to, border) in table[LETTERS].items()}
        table[s][c] = (NEXT, 0)
    flat = [table[s][c] for s in range(12) for c in range(12)]
    return np.array([t for t, _ in flat], np.uint8), np.array([b for _, b in flat], np.uint8)


def class_table() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            shift = 0x800 * (m.start() >= 0xD800)
            out[m.start() + shift:m.end() + (0x800 * (m.end() > 0xD800))] = kind
    for c in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[c] = BLANK
    for c, kind in [*((x, SINGLE) for x in "stmd"), ("r", R), ("v", V), ("e", E), ("l", L), (" ", SPACE), ("'", QUOTE)]:
        out[ord(c)] = kind
    return out


class Splitter:
    def __init__(self):
        self.next, self.borders = splitter()
        self.classes = class_table()

    def chunk_maps(self, rows: np.ndarray) -> np.ndarray:
        """End state by start state for every chunk (a column of ``rows``).
        The map of a chunk's tail, if constant, is the chunk's; else of more of it."""
        size, n = rows.shape
        maps = np.tile(np.arange(12, dtype=np.uint8)[:, None], (1, n))
        open_, tail = np.arange(n), min(16, size)
        while len(open_):
            m = np.tile(np.arange(12, dtype=np.intp)[:, None], (1, len(open_)))
            for j in range(size - tail, size):
                m = self.next.take(m * 12 + rows[j, open_]).astype(np.intp)
            maps[:, open_] = m
            if tail == size:
                break
            open_ = open_[(m != m[0]).any(axis=0)]
            tail = min(size, tail * 4)
        return maps

    def starts(self, classes: np.ndarray) -> np.ndarray:
        """Places where pieces begin."""
        n = len(classes)
        size = min(CHUNK, max(n, 1))
        count = -(-n // size)
        padded = np.full(count * size, END, np.uint8)
        padded[:n] = classes
        rows = padded.reshape(count, size).T.copy()
        maps = self.chunk_maps(rows)
        step = 1
        while step < count:  # parallel prefix scan: maps[:, k] becomes that of chunks 0..k
            later = np.take_along_axis(maps[:, step:], maps[:, :-step].astype(np.intp), axis=0)
            maps[:, step:] = later
            step *= 2
        state = np.append(np.uint8(NEXT), maps[NEXT, :-1]).astype(np.intp)
        found = np.empty((size, count), np.uint8)
        for j in range(size):
            at = state * 12 + rows[j]
            found[j] = self.borders.take(at)
            state = self.next.take(at).astype(np.intp)
        found = found.T.ravel()[:n]
        begins = (found & HERE).astype(bool)
        begins[:-1] |= (found[1:] & BACK).astype(bool)
        return np.flatnonzero(begins)


class Merger:
    """Transducer over bytes, compiled on demand."""

    SHIFT = 9  # a transition is next state << 9 | change + 256; -1 is not compiled yet

    def __init__(self, vocab: dict[str, int], merges: list):
        self.merges = Merges(vocab, merges)
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for text, t in vocab.items():
            if not self.merges.sound[t] or not all(c in byte for c in text):
                continue
            node = 0
            for c in text:
                nxt = self.children[node].get(byte[c])
                if nxt is None:
                    nxt = self.children[node][byte[c]] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = t
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((0, -1, 0),)
        self.number = {start: 0}
        self.states = [start]
        self.table = np.full((1024, 256), -1, np.int32)

    def compatible(self, a: int, b: int) -> bool:
        key = a * self.merges.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[key] = bool(self.merges.compatible(np.array([a]), np.array([b]))[0])
        return known

    def compile(self, state: np.ndarray, byte: np.ndarray) -> None:
        """Add transitions; all new token pairs are tested at once."""
        ask = set()
        for s, c in zip(state.tolist(), byte.tolist()):
            for node, last, _ in self.states[s]:
                child = self.children[node].get(c)
                if child is not None and last >= 0 and (t := self.token_at[child]) >= 0:
                    ask.add(last * self.merges.size + t)
        new = np.array([k for k in ask if k not in self.pairs], np.int64)
        if len(new):
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            good = self.merges.compatible(new // self.merges.size, new % self.merges.size)
            self.pairs.update(zip(new.tolist(), good.tolist()))
        for s, c in zip(state.tolist(), byte.tolist()):
            grown, ended, change = [], -1, 0
            for node, last, fewer in self.states[s]:
                child = self.children[node].get(c)
                if child is None:
                    continue
                t = self.token_at[child]
                if t >= 0 and (last < 0 or self.compatible(last, t)):
                    ended, change = t, fewer + 1
                if self.children[child]:
                    grown.append((child, last, fewer))
            key = (*((n, a, f - change) for n, a, f in grown), (0, ended, 0))
            to = self.number.get(key)
            if to is None:
                to = self.number[key] = len(self.states)
                self.states.append(key)
                if to >= len(self.table):
                    self.table = np.concatenate([self.table, np.full((len(self.table) // 2, 256), -1, np.int32)])
            self.table[s, c] = to << self.SHIFT | change + 256

    def counts(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of the pieces data[start:start + size]."""
        if len(self.states) > MAX_STATES:
            self.reset()
        order = np.argsort(-size, kind="stable")
        at, left = start[order], size[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        ends = np.searchsorted(-left, -np.arange(1, int(left.max(initial=0)) + 1), side="right")
        for j, lanes in enumerate(ends.tolist()):
            byte = data[at[:lanes] + j]
            key = state[:lanes] * 256 + byte
            go = self.table.ravel().take(key)
            if (miss := np.flatnonzero(go < 0)).size:
                new = np.unique(key[miss])
                self.compile(new >> 8, new & 255)
                go = self.table.ravel().take(key)
            state[:lanes] = go >> self.SHIFT
            total[:lanes] += (go & 511) - 256
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


class TokenCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.split, self.merge = Splitter(), Merger(spec["model"]["vocab"], spec["model"]["merges"])
        marks = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks)))
        self.any_mark = marks

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text; texts of any total size, one batch."""
        parts, of, extra = [], [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if any(m in text for m in self.any_mark):  # their strings are tokens of their own
                cut = self.marks.split(text)
                extra[k] = len(cut) - 1
                parts += cut
                of += [k] * len(cut)
            else:
                parts.append(text)
                of.append(k)
        joined = "\0".join(parts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size + 1) - 1
        classes = self.split.classes[points]
        classes[ends] = END
        begins = self.split.starts(classes)
        doc = np.searchsorted(ends, begins)
        real = begins != ends[doc]
        stops = np.append(begins[1:], len(points))
        begins, stops, doc = begins[real], stops[real], doc[real]
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) != len(points):
            place = np.append(0, np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)))
            begins, stops = place[begins], place[stops]
        n = self.merge.counts(data, begins, stops - begins)
        return extra + np.bincount(np.array(of)[doc], weights=n, minlength=len(texts)).astype(np.int64)


def counter(path: str) -> TokenCounter:
    return worker_cache(("token counter", path), lambda: TokenCounter(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per row: ``id_col``, n_bytes (UTF-8), n_tokens long,
    over_limit boolean (n_tokens > ``limit``).

    Null counts as empty: no bytes, no tokens. Repeated rows and null ids are
    kept; an empty table gives an empty result; other columns are ignored.
    """
    rows = text_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    out = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("over_limit", T.BooleanType())])
    schema = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            n_bytes = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(n_bytes) // BATCH_CHARS
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if e > s:
                    n = counter(path).count(b.column(1).slice(s, e - s).to_pylist())
                    yield batch(schema, b.column(0).slice(s, e - s), n_bytes[s:e], n, pa.array(n > limit))

    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
