"""The manifest, passage removal and ranked search against brute force, with
nulls, empty and long texts, ties, repeated rows, empty tables, other columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import lexical, manifest, recompression

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, place string, id string, `a.b` string"


def frame(spark, rows):
    """rows (doc_id, text, lang, source, n_chars), with columns that clash"""
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], DOCS)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


# -- manifest -----------------------------------------------------------------

def audited(rows):
    """What ``audit`` gives for rows (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def siblings(tree, i):
        for nodes in tree[:-1]:
            yield (nodes[i ^ 1] if i ^ 1 < len(nodes) else None), i & 1
            i >>= 1

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = {lang: levels([leaf(*r) for r in groups[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs]) if langs else []
    out = []
    for g, lang in enumerate(langs):
        for i, (doc_id, text, _, source, n) in enumerate(groups[lang]):
            path = [*siblings(trees[lang], i), *siblings(top, g)]
            hit = doc_id is not None and n is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            node = leaf(doc_id, text, lang, source, n + hit if n is not None else None)
            for d, left in path:
                node = sha(node if d is None else d + node if left else node + d)
            out.append((doc_id, trees[lang][0][i], trees[lang][-1][0], top[-1][0], sha("".join(d for d, _ in path if d)), node, node == top[-1][0]))
    return sorted(map(repr, out))


ODD_ROWS = [(None, None, None, None, None), (7, None, None, "s", None), (7, "", "", "", 0), (7, "", "", "", 0), (9, "x", "zz", "s", 2**63 - 1),
            (-5, "é 🙂", "é", "s", 4), (11, "long " * 50_000, "en", None, 250_000)]


def test_manifest_like_brute_force(spark):
    rows = ODD_ROWS + [(i % 900, f"text {i}", ["en", "de", None][i % 7 % 3], f"s{i % 3}", i if i % 11 else None) for i in range(1100)]
    got = manifest.audit(frame(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == audited(rows)
    for few in (ODD_ROWS[:1], ODD_ROWS[2:4], ODD_ROWS[4:6], []):
        assert sorted(map(repr, map(tuple, manifest.audit(frame(spark, few)).collect()))) == audited(few)


def test_manifest_of_several_tiers(spark):
    """70,000 leaves: three tiers of records; proofs for some leaves only."""
    rows = spark.range(70_000).select(F.lit("g").alias("tree"), F.col("id"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("leaf"))
    m = manifest.build(rows)
    assert len(m.records) == 3
    nodes = [sha(str(i)) for i in range(70_000)]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
    assert m.root == nodes[0]
    proofs = manifest.prove(m, m.leaves.filter("id IN (0, 255, 256, 65535, 65536, 69999)"))
    got = proofs.withColumn("folded", manifest.fold(F.col("leaf"), F.col("siblings"))).collect()
    assert sorted(r["id"] for r in got) == [0, 255, 256, 65535, 65536, 69999]
    assert all(r["folded"] == m.root and len(r["siblings"]) == 17 for r in got)
    assert not proofs.filter("id = 0").withColumn("folded", manifest.fold(F.sha2(F.lit(b"x"), 256), F.col("siblings"))).first()["folded"] == m.root


def test_equal_segments_share_a_record(spark):
    rows = spark.range(1024).select(F.lit("g").alias("tree"), F.lit(1).alias("id"), F.lit(sha("same")).alias("leaf"))
    m = manifest.build(rows)
    assert m.records[0].count() == 1
    assert manifest.prove(m).filter(manifest.fold(F.col("leaf"), F.col("siblings")) == m.root).count() == 1024


# -- passages --------------------------------------------------------------

def passages(rows, length=50):
    texts = [((i is not None, i or 0), (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in texts:
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            least[k] = min(least.get(k, i), i)
    out = []
    for (i, w), (doc_id, _) in zip(texts, rows):
        gone = set()
        for p in range(len(w) - length + 1):
            if least[tuple(w[p:p + length])] < i:
                gone.update(range(p, p + length))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((doc_id, len(w), len(gone), sha(kept), kept))
    return sorted(map(repr, out))


def passage_rows():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["é", "日本語", "a b"]
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    shared, short = some(180), some(50)
    texts = [None, "", " \t\n", "x " * 300, "x " * 180, "a b " * 200, "b a " * 120, "a b c " * 90]
    for k in range(40):
        at = rnd.randrange(100)
        texts.append(rnd.choice([" ", "\n ", "\t"]).join(some(rnd.randrange(90)) + shared[at:at + rnd.randrange(20, 80)] + some(rnd.randrange(60)) + short))
    whole = " ".join(some(300))
    texts += [whole] * 6 + [whole + " end", "begin " + whole]
    rows = list(zip([*rnd.sample(range(1000), len(texts) - 3), None, 17, 17], texts))
    return rows + rows[-4:] + [(rows[10][0], texts[11])]


def test_passages_like_brute_force(spark):
    rows = passage_rows()
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in rows])
    for length in (50, 23):
        got = recompression.remove_earlier(docs, length=length)
        assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "text"]
        assert sorted(map(repr, map(tuple, got.collect()))) == passages(rows, length)
    assert recompression.remove_earlier(frame(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=150), st.lists(st.integers(0, 3), min_size=20, max_size=60),
       st.lists(st.integers(0, 3), max_size=150), st.integers(0, 60), st.integers(0, 60))
def test_equal_windows_agree_on_their_anchor(left, inside, right, a, b):
    """Whatever surrounds a window, and however repetitive it is."""
    length = 20
    one, two = left[:a] + inside + right[:b], right[b:] + inside + left[a:]
    words = recompression.mixed(np.array(one + two, np.uint64))
    starts, ends = np.array([0, len(one)]), np.array([len(one), len(one) + len(two)])
    name, place = recompression.window_anchors(words, starts, ends, length)
    p, q = min(a, len(left)), len(one) + len(right[b:])
    for k in range(len(inside) - length + 1):
        assert place[p + k] >= p + k and name[p + k] == name[q + k] and place[p + k] - p == place[q + k] - q


def test_blocks_of_a_long_text_do_not_matter(spark, monkeypatch):
    rows = [(i, t, "en", "s", 1) for i, t in passage_rows()]
    docs = frame(spark, [(1, " ".join(t or "" for _, t, *_ in rows), "en", "s", 1), *rows])
    whole = sorted(map(repr, recompression.remove_earlier(docs).collect()))
    texts = [[t.encode() for t in (r["text"] or "").split()] for r in docs.select("text").collect()]
    h = recompression.WordHashes(most=10)
    for t in texts:
        x = h.of(t)
        if len(x) < 150:
            continue
        name, place = recompression.window_anchors(x, np.array([0]), np.array([len(x)]), 50)
        for s in range(0, len(x) - 149, 100):
            n, pl = recompression.window_anchors(x[s:s + 149], np.array([0]), np.array([149]), 50)
            assert (n[:100] == name[s:s + 100]).all() and (pl[:100] + s == place[s:s + 100]).all()
    assert whole == sorted(map(repr, recompression.remove_earlier(docs.repartition(5)).collect()))


# -- ranked search --------------------------------------------------------------

def ranking(docs, items, k=10):
    pattern = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: Counter(x.translate(lower) for x in pattern.findall(t or ""))
    held = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 25 + (75 * c.total() * n_docs) // n_terms if n_terms else 0
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t, times in terms(text).items() if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("shard", [8192, 150])
def test_search_like_brute_force(spark, shard):
    rnd = random.Random(9)
    words = [f"t{i}" for i in range(80)] + ["Zażółć", "日本語", "ÀB", "x1Y", "a"]
    common = ["the", "of", "tie"]
    texts = [" ,".join(rnd.choices(words, [1 / (k + 1) for k in range(len(words))], k=rnd.randrange(60)) + common[:rnd.randrange(4)]) for _ in range(700)]
    texts += [None, "", "...", "The THE the", "tie\0tie", "tie tie", "Tie-tie"]
    docs = [*zip(range(len(texts)), texts), (None, "tie tie"), (3, texts[3]), (3, "the the")]
    items = [(1, "the tie of"), (2, None), (3, ""), (4, "nowhere"), (5, "t1 t1 T2 t70 ÀB àb x1y"), (5, "tie"), (None, "日本語 a a"), (7, " ".join(words[:60]))]
    got = lexical.search(frame(spark, [(i, t, "en", "s", 1) for i, t in docs]).repartition(3),
                         spark.createDataFrame([(*x, "clash", 1) for x in items], "item_id long, text string, score string, rank int"), shard=shard)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == ranking(docs, items)


def test_search_of_empty_tables(spark):
    docs, none = frame(spark, [(1, "a b", "en", "s", 1)]), frame(spark, [])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r)[:3] for r in lexical.search(docs, items).collect()] == [(1, 1, 1)]
    assert lexical.search(none, items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(frame(spark, [(1, None, "en", "s", 1)]), items).count() == 0


def test_bounds_are_the_coordinatewise_maxima():
    rnd = np.random.default_rng(1)
    size = rnd.integers(1, 12, 500)
    ptr = np.append(0, np.cumsum(size))
    term = np.concatenate([rnd.choice(40, n, replace=False) for n in size]).astype(np.int32)
    s = lexical.Shard(list(range(500)), ptr, term, rnd.integers(1, 1000, len(term)).astype(np.int32), 40, np.ones(40, np.int64))
    assert s.list_ptr[-1] == len(s.member_ends) and len(s.members) == len(term)
    for b in range(len(s.member_ends)):
        most = Counter()
        for d in s.members[s.member_ends[b - 1] if b else 0:s.member_ends[b]]:
            for t, v in zip(s.term[ptr[d]:ptr[d + 1]], s.impact[ptr[d]:ptr[d + 1]]):
                most[t] = max(most[t], v)
        at = slice(s.block_ptr[b], s.block_ptr[b + 1])
        assert dict(zip(s.block_term[at].tolist(), s.block_most[at].tolist())) == most
