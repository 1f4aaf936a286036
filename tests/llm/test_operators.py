"""Each operator against brute force or the library, and the odd cases:
nulls, empty and long texts, ties, repeated rows, empty tables, other columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, language, neighbours, packing, quality, simhash, substrings, token_counts
from tidemark.llm import exact_dedup as exact
from tidemark.llm.bpe import SpeculativeBPE, bpe_encode
from tidemark.llm.queries import BYTE_BPE, WORD_BPE, vocabulary

DOCS = "doc_id long, text string, lang string, id string, `x0` string"
ODD = ["", None, "A", "a", " \n\t ", "The cat sat on the mat", "the CAT sat on the mat", "Zażółć gęślą jaźń", "ΑΣ don't we'LL 12 ３",
       "<|endoftext|>mid<|startoftext|> <|endoftext|>", "naïve 日本語 🙂", "x" * 5000, "no\0null \x1c sep", "=" * 900]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, [*ODD, *ODD[:3]], [*range(len(ODD)), 0, None, None])


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_like_the_library(odd):
    t = library(WORD_BPE)
    got = [(r["doc_id"], r["n_tokens"], r["ids"], r["decoded"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe_encode(odd, vocabulary(WORD_BPE)).collect()]
    exp = []
    for r in odd.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        raw, text = np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)
        exp.append((r["doc_id"], len(ids), raw, text, hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, got)) == sorted(map(repr, exp))


def test_bpe_random_words_and_small_cache():
    t, e, rnd = library(WORD_BPE), SpeculativeBPE(vocabulary(WORD_BPE), cache_words=50), random.Random(5)
    texts = ["".join(rnd.choice("abehinorst' \n1é") for _ in range(rnd.randint(0, 80))) for _ in range(800)] + ["ab" * 900]
    for text, (ids, back) in zip(texts, e.encode(texts, block=500)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert e.decode_ids(np.frombuffer(ids, "<u4")) == back
    assert e.repaired  # some words needed exact merging


def test_token_counts_like_the_library(odd):
    t = library(BYTE_BPE)
    got = sorted((repr(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(odd, vocabulary(BYTE_BPE)).collect())
    n = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    assert got == sorted((repr(r["doc_id"]), len((r["text"] or "").encode()), n(r["text"] or ""), n(r["text"] or "") > 512) for r in odd.collect())


def test_token_counts_random(spark):
    t, c, rnd = library(BYTE_BPE), token_counts.TokenCounter(vocabulary(BYTE_BPE)), random.Random(7)
    texts = ["".join(rnd.choice("abstrevlmd''  \n\t1é日!\x85") for _ in range(rnd.randint(0, 700))) for _ in range(400)]
    assert c.count(texts).tolist() == [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup(spark, odd, keep):
    rows = odd.collect()
    groups = {}
    for r in rows:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")
        groups.setdefault(key, []).append(r["doc_id"])
    got = exact.exact_dedup(odd, keep=keep).collect()
    pick = max if keep == "largest" else min
    null_low = lambda x: -1 if x is None else x
    exp = {hashlib.sha256(k.encode()).hexdigest(): (pick(v, key=null_low), len(v)) for k, v in groups.items()}
    assert len(got) == len(rows)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == exp[r["text_sha256"]]
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(exp.keys())
    whole = exact.exact_dedup(odd, keep=keep, carry=True)
    assert whole.columns == [*odd.columns, "_kept"] and whole.filter("_kept").count() == len(exp)


def test_exact_dedup_group_over_many_partitions(spark):
    df = frame(spark, ["HOT text" if i % 3 else f"t{i}" for i in range(3000)])
    got = exact.exact_dedup(df, keep="largest").filter("group_size > 1").agg(F.count("*"), F.max("keep_id"), F.min("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (2000, 2999, 2999, 1)


def test_simhash_brute(spark, odd):
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("abcdefghij") * 3 for _ in range(60)) for _ in range(6)]
    texts = [*ODD, *(b + x for b in base for x in ("", " one", " one two", " z"))]
    df = frame(spark, texts)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    fp = [simhash.fingerprint(t) for t in texts]
    up = list(range(len(texts)))
    for _ in texts:
        up = [min(up[j] for j in range(len(fp)) if bin(fp[i] ^ fp[j]).count("1") <= 3) for i in range(len(fp))]
    assert got == {i: (fp[i], up[i]) for i in range(len(texts))}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(up))
    assert simhash.near_duplicates(odd).count() == odd.count()


def test_trie_join_pairs_of_subtries():
    rnd = np.random.default_rng(1)
    for _ in range(20):
        f = rnd.integers(0, 2**64, 4, dtype=np.uint64)
        f = np.unique(np.concatenate([f, *[f ^ (np.uint64(1) << rnd.integers(0, 64, 4, dtype=np.uint64)) for _ in range(8)]]))
        a, b = np.arange(len(f) // 2), np.arange(len(f) // 2, len(f))
        _, forest = simhash.trie_join(f, [(a, b)], 3)
        up = np.arange(len(f))
        for _ in f:
            for i in a:
                for j in b:
                    if bin(int(f[i] ^ f[j])).count("1") <= 3:
                        up[i] = up[j] = min(up[i], up[j])
        r = forest.roots()
        assert [(r == x).nonzero()[0].tolist() for x in r] == [(up == x).nonzero()[0].tolist() for x in up]


def brute_removed(texts, n):
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                cover[i:i + n] = True
        out.append(cover)
    return out


@pytest.mark.parametrize("shard,merged", [(1 << 20, 4), (300, 2), (60, 1)])
def test_substrings_brute(spark, shard, merged):
    rnd = random.Random(shard)
    base = "".join(rnd.choice("abcdé") for _ in range(400))
    texts = ["".join(base[(a := rnd.randint(0, 300)):a + rnd.randint(5, 90)] + str(rnd.random()) for _ in range(3)) for _ in range(25)]
    texts += ["", None, "z" * 70, "short", texts[0], texts[1]]
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.remove_repeats(frame(spark, texts), length=40, shard=shard, merged=merged).collect()}
    data = [(t or "").encode() for t in texts]
    for i, (d, c) in enumerate(zip(data, brute_removed(data, 40))):
        spans = int((c & ~np.append(False, c[:-1])).sum()) if len(c) else 0
        kept = np.frombuffer(d, np.uint8)[~c].tobytes()
        assert got[i][:4] == (len(d), int(c.sum()), spans, hashlib.sha256(kept).hexdigest())
        if texts[i] is None:
            assert got[i][4] is None
        elif texts[i].isascii():
            assert got[i][4] == kept.decode()


def test_substrings_carry_and_repeated_rows(spark, odd):
    cut = substrings.remove_repeats(odd, length=400, carry=True)
    assert cut.columns == [*odd.columns, "_removed"] and cut.count() == odd.count()
    twice = frame(spark, ["q" + "".join(chr(97 + i * i % 23) for i in range(500))] * 2, [7, 7])
    assert [r["n_removed"] for r in substrings.remove_repeats(twice).collect()] == [501, 501]


def test_substrings_spans_of_many_repeats_stay_bounded(spark):
    rnd = random.Random(9)
    long = "".join(rnd.choices("abcdefgh ", k=3000))
    sizes = []
    for k in (2, 60):
        docs = frame(spark, [long] * k + [long] * k + ["other"], [7] * k + [None] * k + [8])
        rows = substrings.spans_by_row(substrings.repeated_spans(docs, "doc_id", "text", 400))
        sizes.append(sorted((str(r["id"]), len(r["spans"])) for r in rows.collect()))
        got = sorted(map(repr, substrings.remove_repeats(docs).select("doc_id", "n_removed", "n_spans").collect()))
        assert len(got) == 2 * k + 1 and sum("n_removed=3000, n_spans=1" in g for g in got) == 2 * k
    assert len(sizes[0]) == 2 and sizes[0] == sizes[1]


def test_language(spark, empty):
    rnd = random.Random(0)
    words = {"aa": ["kalo", "miru", "tesu", "nopa"], "bb": ["strund", "grimf", "wolkt", "brend"]}
    text = lambda lang: " ".join(rnd.choice(words[lang]) for _ in range(40))
    learn = spark.createDataFrame([(i, text(x), x) for i, x in enumerate(["aa", "bb"] * 10)] + [(None, "k", "aa"), (90, None, "bb"), (91, "k", None)], "doc_id long, text string, lang string")
    ask = spark.createDataFrame([(1, text("aa"), "bb"), (2, text("bb").upper(), None), (3, None, None), (4, "12 !", "aa"), (None, "日本", "aa")], learn.schema)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(ask, learn).collect()}
    assert [got[k][0] for k in (1, 2, 3, 4)] == ["aa", "bb", "und", "und"] and got[None][0] in ("aa", "bb")
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in language.identify(ask, empty).collect()} == {"und"}


def test_language_keeps_every_letter_of_large_and_small_scripts(spark):
    rnd = random.Random(3)
    letters = {"zh": [chr(0x4E00 + k) for k in range(2500)], "ja": [chr(0x3042 + k) for k in range(80)] + [chr(0x4E00 + 9 * k) for k in range(250)],
               "hy": [chr(0x561 + k) for k in range(38)], "ka": [chr(0x10D0 + k) for k in range(33)]}
    words = {x: ["".join(rnd.choices(c, k=rnd.randint(2, 6))) for _ in range(800)] for x, c in letters.items()}
    text = lambda x, n: " ".join(rnd.choices(words[x], k=n))
    plan = [*["zh"] * 40, *["ja"] * 30, "hy", "ka", "ka"]
    learn = spark.createDataFrame([(i, text(x, 900 if x in ("zh", "ja") else 300), x) for i, x in enumerate(plan)], "doc_id long, text string, lang string")
    asked = [x for x in letters for _ in range(10)]
    ask = spark.createDataFrame([(i, text(x, 60), None) for i, x in enumerate(asked)], learn.schema)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(ask, learn).collect()}
    assert [got[i] for i in range(len(asked))] == asked


def test_sparse_automata_cost_as_full_tables():
    rnd = random.Random(4)
    make = lambda c, n: "".join(rnd.choices(c, k=n))
    samples = {"a": [make("abcd efAB", 900) for _ in range(4)], "b": [make("bdfhj é", 700)], "c": [make("xyz한日本 ", 500), "ıſẞİ"]}
    full, sparse = language.CrossParser(samples, 1500), language.CrossParser(samples, 1500, dense=0)
    assert full.dense and not sparse.dense
    texts = [make("abcdefhjxyz éAB한日本Ж1ſSıIß", n) for n in (0, 1, 7, 90, 2500, 5000)] + ["ẞ", "S"]
    for x, y in zip(full.costs(texts), sparse.costs(texts)):
        assert (x == y).all()
    assert sparse.symbols("S")[0] == language.UNKNOWN and sparse.symbols("ẞſ").min() > language.UNKNOWN


def test_suffix_automaton_holds_every_substring():
    s = [2, 3, 2, 3, 4, 2, 2, 3]
    nxt = language.automaton(s)
    for a in range(len(s)):
        at = 0
        for c in s[a:]:
            at = nxt[at][c]
    assert 4 not in nxt[nxt[0][4]]


def test_packing(spark, odd, empty):
    got = packing.pack(odd, vocabulary(WORD_BPE), capacity=64).collect()
    t = library(WORD_BPE)
    for r in odd.filter("doc_id > 0").collect():
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        parts = sorted((x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in got if x["doc_id"] == r["doc_id"])
        assert parts == [(s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes()), len(ids)) for s in range(0, len(ids), 64)]
    seqs = {}
    for x in got:
        seqs.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    assert sorted(seqs) == list(range(len(seqs)))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty, vocabulary(WORD_BPE)).count() == 0


def test_pack_patterns_hold_the_histogram():
    rnd = random.Random(3)
    hist = {n: rnd.randint(1, 10**9) for n in range(1, 129)}
    patterns = packing.pack_patterns(hist, 128)
    back = Counter()
    for count, lengths in patterns:
        assert sum(lengths) <= 128 and count > 0
        for n in lengths:
            back[n] += count
    assert back == Counter(hist) and len(patterns) <= 512


def test_quality_learns_and_handles_odd_texts(spark, odd, empty):
    rnd = random.Random(4)
    text = lambda y: " ".join(rnd.choice(["fine", "calm", "prose"] if y else ["###", "$$$", "BUY"]) for _ in range(30))
    rows = [(i, text(i % 2), i % 2) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(None, 1), (3, None)], "doc_id long, quality int")
    w = quality.train(docs, labels)
    for r in quality.quality_scores(docs, w).collect():
        assert (r["score"] >= 0.5) == (r["doc_id"] % 2 == 1)
    assert quality.quality_scores(odd, w, carry=True).columns == [*odd.columns, "_score"]
    assert all(0 <= r["score"] <= 1 for r in quality.quality_scores(odd, w).collect())
    none = quality.train(empty, labels)
    assert [r["score"] for r in quality.quality_scores(frame(spark, ["a"]), none).collect()] == [0.5]


def test_neighbours(spark):
    rnd = random.Random(6)
    vec = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(120)]
    rows = [(i, v) for i, v in enumerate(vec)] + [(200 + i, vec[5]) for i in range(40)]
    odd = [(300, None), (301, [0.0] * 8), (302, [1.0] * 7 + [None]), (303, [float("nan")] * 8), (None, [1.0] * 8), (304, [1.0, 2.0]), (7, vec[7]), (305, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], "vec_id long, embedding array<float>, label int")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q in (i for i in x if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(x[q], v)), i) for i, v in x.items() if i != q)[:10]
        assert [i for _, i in best] == [i for i, _ in got[q]] and np.allclose([-s for s, _ in best], [s for _, s in got[q]], atol=1e-12, rtol=0)
    assert set(got) == {i for i in x if i % 20 == 0}
    assert neighbours.nearest(df.filter("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_chat(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", "hello"), (1, 1, "ann", None), (1, 2, None, "?"), (None, 0, "ann", "x"), (1, None, "bob", "first"), (1, 0, "ann", "hi")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, speaker string")
    got = {}
    for r in chat.rotate(df, turns=2).orderBy("conv_id", "speaker", "piece").collect():
        got.setdefault((r["conv_id"], r["speaker"]), []).append(r)
    said = [("bob", "first"), ("ann", "hi"), ("ann", "hi"), ("ann", ""), ("bob", "hello"), ("unknown", "?")]
    for me in ("ann", "bob", "unknown"):
        exp = [("<|assistant|>\n" if w == me else f"<|user:{w}|>\n") + t + "<|end|>\n" for w, t in said]
        assert "".join(r["rendered"] for r in got[(1, me)]) == "".join(exp)
        learnt = [r["rendered"][int(s):int(s) + int(n)] for r in got[(1, me)] for s, n in (m.split(":") for m in r["mask"].split(",") if m)]
        assert learnt == [t + "<|end|>" for w, t in said if w == me]
        assert [r["n_turns"] for r in got[(1, me)]] == [2, 2, 2]
    assert len(got) == 4
    plan = chat.rotate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert chat.rotate(df.filter("turn > 9")).count() == 0


@pytest.mark.parametrize("run", [
    lambda d: bpe_encode(d, vocabulary(WORD_BPE)), lambda d: token_counts.token_counts(d, vocabulary(BYTE_BPE)), exact.exact_dedup,
    simhash.near_duplicates, simhash.keep_one, substrings.remove_repeats, lambda d: substrings.remove_repeats(d, carry=True)])
def test_empty_table(empty, run):
    assert run(empty).count() == 0
