"""Byte-pair encoding and decoding: speculate, verify, repair.

For every word not met before, greedy longest match proposes tokens. A
proposal is the word's true encoding exactly when every two neighbouring
tokens are compatible, i.e. no merge would ever have joined pieces across
their border; that test runs in numpy over all distinct neighbour pairs of a
block of words at once. Only words with an incompatible pair go through
exact merging. Words (white-space-free runs) and their encodings are kept in
a bounded cache of the Python worker.

Vocabularies are files of the tokenizers library (JSON): byte-level BPE with
an optional end-of-word suffix. The path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import batch, pieces_of, text_batches, worker_cache

CACHE_WORDS = 500_000
LOW_SEPARATORS = regex.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the tokenizer doesn't


def byte_alphabet() -> str:
    """The 256 characters that stand for the bytes in byte-level vocabularies:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (chr(256 + i) for i in range(256))
    return "".join(chr(b) if b in plain else next(rest) for b in range(256))


class Merges:
    """Merge table as arrays over token ids, ranks in merge order."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        self.size = max(vocab.values()) + 1
        self.rank = np.full(self.size, -1, np.int64)  # of the merge that makes a token
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.ranks: dict[int, int] = {}  # by left id * size + right id
        self.made: list[int] = []  # token that a rank's merge makes
        for r, m in enumerate(merges):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.rank[z], self.left[z], self.right[z] = r, x, y
            self.ranks[x * self.size + y] = r
            self.made.append(z)
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_rank = np.fromiter(self.ranks.values(), np.int64, len(keys))[order]
        made = np.flatnonzero(self.rank >= 0)
        grown = self.rank[made] > np.maximum(self.rank[self.left[made]], self.rank[self.right[made]])
        if not grown.all() or len(set(self.made)) != len(self.made) or len(keys) != len(self.made):
            raise ValueError("every token must come from one merge, of tokens that earlier merges make")
        #: tokens that their own text is encoded to; others never appear
        self.sound = np.ones(self.size, bool)
        for d in self._by_depth(made):
            self.sound[d] = (self.sound[self.left[d]] & self.sound[self.right[d]]
                             & self.compatible(self.left[d], self.right[d], inner=True))

    def _by_depth(self, made: np.ndarray) -> Iterable[np.ndarray]:
        depth = np.zeros(self.size, np.int64)
        for t in made[np.argsort(self.rank[made])]:
            depth[t] = 1 + max(depth[self.left[t]], depth[self.right[t]])
        for k in range(1, int(depth.max(initial=0)) + 1):
            yield np.flatnonzero(depth == k)

    def compatible(self, a: np.ndarray, b: np.ndarray, inner: bool = False) -> np.ndarray:
        """For each pair of tokens: does ``a`` followed by ``b`` stay so?

        Undoes the merges along the border, latest first: ``x`` is the last
        piece of ``a`` and ``y`` the first of ``b`` at some time, ``until_x``
        and ``until_y`` the ranks of the merges that take them up. A merge of
        (x, y) of lower rank would have come first (at equal rank the left
        one does). ``inner``: the pair's own merge, at the end, is allowed.
        """
        x, y = np.array(a, np.int64), np.array(b, np.int64)
        never = np.iinfo(np.int64).max
        until_x, until_y = np.full(len(x), never), np.full(len(x), never)
        good, at, first = np.ones(len(x), bool), np.arange(len(x)), inner
        while len(at):
            key = x[at] * self.size + y[at]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            r = np.where(self.keys[i] == key, self.key_rank[i], never)
            if not first:
                good[at[(r < until_x[at]) & (r <= until_y[at])]] = False
            first = False
            rx, ry = self.rank[x[at]], self.rank[y[at]]
            go = good[at] & ((rx >= 0) | (ry >= 0))
            at, rx, ry = at[go], rx[go], ry[go]
            undo_x = rx > ry
            ax, ay = at[undo_x], at[~undo_x]
            until_x[ax], x[ax] = rx[undo_x], self.right[x[ax]]
            until_y[ay], y[ay] = ry[~undo_x], self.left[y[ay]]
        return good

    def merge(self, tokens: list[int]) -> list[int]:
        """Exact encoding: always the lowest-ranked merge, the leftmost of equals."""
        if len(tokens) > 400:
            return self._merge_long(tokens)
        size, get, made = self.size, self.ranks.get, self.made
        none = size
        tokens = list(tokens)
        ranks = [get(x * size + y, none) for x, y in zip(tokens, tokens[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            tokens[i:i + 2] = [made[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(tokens[i - 1] * size + tokens[i], none)
            if i < len(ranks):
                ranks[i] = get(tokens[i] * size + tokens[i + 1], none)
        return tokens

    def _merge_long(self, tokens: list[int]) -> list[int]:
        """The same with a heap over a linked list, for very long words."""
        size, get, made = self.size, self.ranks.get, self.made
        tokens, n = list(tokens), len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(tokens[i] * size + tokens[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or get(tokens[i] * size + tokens[j]) != r:
                continue  # one of the two has been merged meanwhile
            tokens[i], tokens[j] = made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (q := get(tokens[x] * size + tokens[y])) is not None:
                    heapq.heappush(heap, (q, x))
        return [t for t in tokens if t >= 0]


class SpeculativeBPE:
    """Encoder and decoder for a word vocabulary file (NFC, lower case, white
    space dropped, end-of-word suffix, no decoder: tokens joined by spaces)."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.merges = Merges(vocab, model["merges"], self.suffix)
        self.token = {i: t for t, i in vocab.items()}
        self.byte_char = byte_alphabet()
        self.to_chars = {b: c for b, c in enumerate(self.byte_char)}
        sound = self.merges.sound
        n = len(self.suffix)
        self.last = {t[:-n] if n else t: i for t, i in vocab.items() if t.endswith(self.suffix) and sound[i]}
        self.inside = {t: i for t, i in vocab.items() if not (n and t.endswith(self.suffix)) and sound[i]}
        self.first_symbol = {t: vocab[t] for t in self.byte_char}
        self.last_symbol = {t: vocab[t + self.suffix] for t in self.byte_char}
        self.reach: dict[str, int] = {}  # longest token that begins with two given characters
        for t in (*self.last, *self.inside):
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"].replace(
            r"\s", "\t-\r \x85\xa0  -     　"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.cache_words, self.repaired = cache_words, 0
        self.four = {i: i.to_bytes(4, "little") for i in self.token}
        self.seen: dict[str, tuple[bytes, str]] = {}  # ids and decoded text by word or run

    # -- words ------------------------------------------------------------

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over the byte characters of a word."""
        out, at, n = [], 0, len(word)
        inside, reach = self.inside, self.reach
        while at < n:
            end = at + reach.get(word[at:at + 2], 1)
            if end >= n:
                t = self.last.get(word[at:])
                if t is not None:
                    out.append(t)
                    break
                end = n - 1
            while (t := inside.get(word[at:end])) is None:
                end -= 1
            out.append(t)
            at = end
        return out

    def encode_words(self, words: list[str]) -> list[tuple[bytes, str]]:
        """Exact encodings of regex words (already lower case): ids, decoded."""
        chars = [w.encode().decode("latin-1").translate(self.to_chars) for w in words]
        guess = [self.propose(c) for c in chars]
        size = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter((t for g in guess for t in g), np.int64, int(size.sum()))
        of = np.repeat(np.arange(len(guess)), size)
        near = of[1:] == of[:-1]
        keys, back = np.unique(flat[:-1][near] * self.merges.size + flat[1:][near], return_inverse=True)
        good = self.merges.compatible(keys // self.merges.size, keys % self.merges.size)
        failed = np.unique(of[1:][near][~good[back]])
        self.repaired += len(failed)
        for w in failed.tolist():
            c = chars[w]
            guess[w] = self.merges.merge([*(self.first_symbol[x] for x in c[:-1]), self.last_symbol[c[-1]]])
        token, four = self.token, self.four
        return [(b"".join([four[t] for t in g]), " ".join([token[t] for t in g])) for g in guess]

    def learn(self, runs: list[str]) -> None:
        """Put white-space-free lower-case runs into the cache. Of a full cache
        the older half stays: words met early are mostly the frequent ones."""
        seen, find = self.seen, self.words.findall
        parts = [(r,) if r.isascii() and r.isalpha() else find(r) for r in runs]
        new = list({w for p in parts for w in p if w not in seen})
        if len(seen) + len(new) + len(runs) > self.cache_words:
            old = list(islice(seen.items(), self.cache_words // 2))
            seen.clear()
            seen.update(old)
            new = list({w for p in parts for w in p if w not in seen})
        seen.update(zip(new, self.encode_words(new)))
        for run, p in zip(runs, parts):
            if len(p) != 1 or p[0] != run:
                seen[run] = b"".join([seen[w][0] for w in p]), " ".join([seen[w][1] for w in p])

    # -- texts ------------------------------------------------------------

    @staticmethod
    def lowered(text: str) -> str:
        """NFC, then lower case character by character (no final-sigma rule)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def runs(self, text: str) -> list[str]:
        if LOW_SEPARATORS.search(text):
            return regex.split("[\t-\r \x85\xa0  -     　]+", text)
        return text.split()

    def encode(self, texts: Iterable[str | None], decode: bool = True, block: int = 1 << 20):
        """For each text (null: empty) its ids as little-endian unsigned 32-bit
        bytes and, with ``decode``, the text those ids decode to."""
        held: list[list] = []
        held_size = 0
        for text in texts:
            doc = []
            for k, part in enumerate(self.marks.split(text or "")):
                if k % 2:
                    doc.append(self.special[part])
                elif part:
                    doc += [self.runs(self.lowered(p)) for p in pieces_of(part)]
            held.append(doc)
            held_size += len(text or "")
            if held_size >= block:
                yield from self._joined(held, decode)
                held, held_size = [], 0
        yield from self._joined(held, decode)

    def _joined(self, docs: list[list], decode: bool):
        seen = self.seen
        wanted = set().union(*(p for d in docs for p in d if isinstance(p, list)))
        new = wanted.difference(seen)
        if len(seen) + 2 * len(new) > self.cache_words:
            new = wanted  # older entries may go meanwhile
        self.learn(list(new))
        for d in docs:
            out, words = [], []
            for p in d:
                if isinstance(p, int):
                    out.append(self.four[p])
                    words.append(self.token[p])
                else:
                    out.extend([seen[w][0] for w in p])
                    if decode:
                        words.extend([seen[w][1] for w in p])
            yield b"".join(out), " ".join(filter(None, words)) if decode else ""

    def decode_ids(self, ids: Iterable[int]) -> str:
        return " ".join([self.token[int(i)] for i in ids])


def encoder(path: str) -> SpeculativeBPE:
    """The Python worker's encoder for a file, read once."""
    return worker_cache(("bpe", path), lambda: SpeculativeBPE(path))


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               texts: bool = True) -> DataFrame:
    """Encode and decode every whole text: ``id_col``, n_tokens long,
    ids_sha256, decoded_sha256 and, with ``texts``, ids binary (little-endian
    unsigned 32-bit) and decoded string.

    Null and empty texts have no tokens and decode to the empty string.
    Strings of special tokens inside a text become those tokens. One output
    row per input row, repeated rows and null ids included; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = text_batches(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
                       + [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())] * texts)
    schema = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            for part in (b.slice(i, 1000) for i in range(0, b.num_rows, 1000)):
                n, shas, decoded, kept = [], [], [], []
                for ids, text in encoder(path).encode(part.column(1).to_pylist()):
                    n.append(len(ids) // 4)
                    shas.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
                    if texts:
                        kept.append((ids, text))
                yield batch(schema, part.column(0), n, shas, decoded, *(zip(*kept) if kept else [()] * (2 * texts)))

    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
