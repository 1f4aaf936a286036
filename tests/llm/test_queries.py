"""Registered queries: against DuckDB where SQL can say it, the pipeline
against its stages, held-out accuracy of what is learnt."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import quality, simhash, substrings
from tidemark.llm.common import table
from tidemark.session import scratch_path
from tidemark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = QUERIES["op4_language"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    assert found.filter("held_out AND n_chars > 40").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    scored = QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").collect()
    good = [r["score"] for r in scored if r["quality"] == 1]
    bad = [r["score"] for r in scored if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) > 0.95 * len(good) * len(bad)
    assert min(good) >= 0.3


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents").withColumn("extra", F.lit("kept"))
    kept = docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "suffix_array_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF).cache()
        if name != "packing":
            assert kept.columns == docs.columns
        if name == "quality_classifier":
            w = quality.train(before, table(spark, SF, "labels").filter(~quality.held_out(F.col("doc_id"))))
            exp = quality.quality_scores(before, w).filter("score >= 0.3").select("doc_id")
            assert sorted(kept.select("doc_id").collect()) == sorted(exp.collect())
        if name == "exact_dedup":
            low = [(r["text"] or "").translate({c: c + 32 for c in range(65, 91)}) for r in before.collect()]
            after = [(r["text"] or "").translate({c: c + 32 for c in range(65, 91)}) for r in kept.collect()]
            assert sorted(after) == sorted(set(low))
        if name == "simhash_near_dedup":
            exp = simhash.near_duplicates(before).filter("doc_id = component_id").select("doc_id")
            assert sorted(kept.select("doc_id").collect()) == sorted(exp.collect())
        if name == "suffix_array_dedup":
            removed = substrings.remove_repeats(before, length=corpus_pipeline.PASSAGE_BYTES).agg(F.sum("n_removed")).first()[0]
            size = lambda d: d.agg(F.sum(F.octet_length("text"))).first()[0]
            assert kept.count() == before.count() and 0 <= size(before) - removed - size(kept) < 10 * kept.count()
            assert kept.filter("n_chars <> length(text)").isEmpty()
        if name == "packing":
            assert kept.select("doc_id").distinct().count() == before.count()


CLASHES = ["_score", "_kept", "_removed", "_key", "key", "s_id", "s_key", "id", "x0", "x1", "score", "kept", "fp", "stay_id", "e_pid",
           "start", "length", "offset", "rank", "salt", "held_out", "l_id", "y", "hash", "value", "block", "n_removed", "a.b"]
LONG = " ".join(f"word{i * i % 977} of a long text" for i in range(40_000))
TEXTS = [None, "", " \n", "One two three four", "one TWO three four", LONG, LONG + " end", "tie", "tie", "12 !"]


def odd_tables(spark, rows):
    """documents with nulls in every column and clashing names, and their other tables"""
    d = scratch_path(spark, "odd-tables")
    cols = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASHES)
    spark.createDataFrame([(*r, *["clash"] * (len(CLASHES) - 1), None) for r in rows], cols).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (4, None, None), (None, 1, 1), (5, 0, 0), (5, 1, 0)][:len(rows)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(20 * i, [1.0, float(i)], None) for i, _ in enumerate(rows)],
                          "vec_id long, embedding array<float>, rank string").write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([(None if i == 2 else i, r[1], "clash") for i, r in enumerate(rows)],
                          "item_id long, text string, rank string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(None if i == 2 else 1, None if i == 3 else i, None if i == 4 else "ann", r[1], "clash") for i, r in enumerate(rows)],
                          "conv_id long, turn int, role string, text string, piece string").write.parquet(f"{d}/conversations.parquet")
    return d


@pytest.fixture(scope="module")
def odd_dir(spark):
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(TEXTS)]
    return odd_tables(spark, [*rows, rows[3], rows[7], (None, "one two", None, None, None), (None, None, None, None, None)])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_odd_and_empty_tables(spark, odd_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    if name not in ("op5_packing", "op6_neighbours", "op9_chat", "op13_search"):
        assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(map(str, [*range(len(TEXTS)), 3, 7, None, None]))
    else:
        assert rows
    assert QUERIES[name](spark, odd_tables(spark, [])).count() == 0


def test_stages_on_odd_and_empty_tables(spark, odd_dir):
    kept, counts = table(spark, odd_dir, "documents"), []
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, odd_dir).cache()
        counts.append(kept.count())
        if name != "packing":
            assert kept.columns == columns and {r["_score"] for r in kept.collect()} == {"clash"}
        if name == "exact_dedup":
            assert len({(r["text"] or "").lower() for r in kept.collect()}) == counts[-1]
    assert counts[0] >= counts[1] >= counts[2] == counts[3] > 0
    nothing = odd_tables(spark, [])
    docs = table(spark, nothing, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, nothing)
        assert docs.count() == 0
        if name != "packing":
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, nothing).count() == 0
