"""Readers, landing, watermarks, schema evolution, upsert, reset."""

import datetime as dt
import json
import os

import pytest

from tidemark.session import local_path, scratch_path
from tidemark.sources import landing, readers
from tidemark.sources.registry import registry_with


def t(s):
    return dt.datetime.fromisoformat(s)


USERS = "user_id long, email string, created_at timestamp_ntz"


def _reg(src):
    return registry_with({"app_users": {"type": "parquet", "path": src}})


def test_incremental_runs(spark):
    src, wh = scratch_path(spark, "src"), scratch_path(spark, "wh")
    reg = _reg(src)
    path = landing.table_path(wh, "bronze.app_users")
    assert landing.read_watermark(spark, path, "created_at") is None          # no table yet
    spark.createDataFrame([(1, "a@x", t("2025-01-01 00:00:00")), (2, "b@x", t("2025-01-02 00:00:00"))],
                          USERS).write.parquet(src)
    assert landing.ingest(spark, reg, wh, ["app_users"], "2025-01-03T00:00:00+00:00") == {"app_users": 2}
    assert landing.read_watermark(spark, path) == "2025-01-02 00:00:00"
    # nothing new: empty batch returns early, table untouched
    assert landing.ingest(spark, reg, wh, ["app_users"], "2025-01-04T00:00:00+00:00") == {"app_users": 0}
    # a row equal to the watermark is never landed (strict '>', T17); a newer one is,
    # and it brings a new column (schema evolution, S13)
    spark.createDataFrame([(3, "c@x", t("2025-01-02 00:00:00"), "VN"), (4, "d@x", t("2025-01-05 00:00:00"), "US")],
                          USERS + ", country string").write.mode("append").parquet(src)
    assert landing.ingest(spark, reg, wh, ["app_users"], "2025-01-06T00:00:00+00:00") == {"app_users": 1}
    got = {r["user_id"]: r for r in landing.read_table(spark, path).collect()}
    assert set(got) == {"1", "2", "4"}
    assert got["4"]["country"] == "US" and got["1"]["country"] is None
    assert got["4"]["_ingested_at"] == "2025-01-06T00:00:00+00:00" and got["4"]["_source"] == "app_users"
    # lookback re-reads late rows (E6): everything after 2025-01-01 lands again, the
    # late row 3 included; copies of 2 and 4 are absorbed by silver's latest-per-key
    assert landing.ingest(spark, reg, wh, ["app_users"], "2025-01-07T00:00:00+00:00",
                          lookback=dt.timedelta(days=4))["app_users"] == 3
    landing.reset(spark, reg, wh)
    assert not landing.table_exists(spark, path)


def test_full_load_keeps_table_on_empty_source(spark):
    wh = scratch_path(spark, "wh")
    csv_dir = local_path(scratch_path(spark, "csv"))
    os.makedirs(csv_dir)
    with open(f"{csv_dir}/a.csv", "w") as f:
        f.write('contact_email,first_name\na@x,"  Ann"\n,Nobody\n"",Blank\n')
    assert sorted(map(tuple, readers.read_source(spark, registry_with({"crm_contacts": {"path": csv_dir}})["crm_contacts"]).collect()), key=str) == [
        ("a@x", "  Ann"), (None, "Blank"), (None, "Nobody")]        # by default as pandas reads it
    reg = registry_with({"crm_contacts": {"path": csv_dir, "null_values": []}})
    assert landing.ingest(spark, reg, wh, ["crm_contacts"], "r1") == {"crm_contacts": 3}
    path = landing.table_path(wh, "bronze.crm_contacts")
    got = sorted(landing.read_table(spark, path).select("contact_email", "first_name").collect(),
                 key=lambda r: r[1])
    assert [tuple(r) for r in got] == [("a@x", "  Ann"), ("", "Blank"), (None, "Nobody")]
    with open(f"{csv_dir}/a.csv", "w") as f:
        f.write("contact_email,first_name\n")
    assert landing.ingest(spark, reg, wh, ["crm_contacts"], "r2") == {"crm_contacts": 0}
    assert landing.read_table(spark, path).count() == 3


def test_csv_null_tokens(spark):
    d = local_path(scratch_path(spark, "csv"))
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("a,b\nNA,x\nnull,None\n")
    df = readers.read_csv_strings(spark, d, null_values=readers.PANDAS_NULL_TOKENS)
    assert [tuple(r) for r in df.collect()] == [(None, "x"), (None, None)]
    assert [tuple(r) for r in readers.read_csv_strings(spark, d).collect()] == [("NA", "x"), ("null", "None")]


def test_json_array_flatten(spark):
    d = local_path(scratch_path(spark, "json"))
    os.makedirs(d)
    with open(f"{d}/customers.json", "w") as f:
        json.dump([{"id": "cus_1", "created": 86400, "metadata": {"country": "VN", "tier": {"x": 1}}},
                   {"id": "cus_2", "email": "b@x"}], f)
    flat = readers.flatten(readers.read_json_array(spark, d))
    assert sorted(flat.columns) == ["created", "email", "id", "metadata.country", "metadata.tier.x"]
    bronze = landing.to_bronze(readers.read_json_array(spark, d), "stripe_customers", "r1")
    r = {x["id"]: x for x in bronze.collect()}
    assert r["cus_1"]["metadata.country"] == "VN" and r["cus_1"]["created"] == "86400"
    assert r["cus_2"]["metadata.country"] is None


def test_upsert_replaces_keys(spark):
    path = scratch_path(spark, "up")
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    new = spark.createDataFrame([("2", "B"), ("3", "c")], "id string, v string")
    landing.land(spark, old, path, "upsert", key="id")
    landing.land(spark, new, path, "upsert", key="id")
    assert sorted(tuple(r) for r in landing.read_table(spark, path).collect()) == [("1", "a"), ("2", "B"), ("3", "c")]


def test_unknown_connector(spark):
    with pytest.raises(ValueError):
        readers.read_source(spark, {"type": "ftp"})


def test_where_files_go(spark):
    base = spark.sparkContext.getCheckpointDir()
    assert base and scratch_path(spark, "x").startswith(base.rstrip("/"))


def test_document_export_reader(spark):
    d = local_path(scratch_path(spark, "docs"))
    os.makedirs(d)
    with open(f"{d}/events.json", "w") as f:
        for i, ts in enumerate(["2024-01-01T00:00:00", "2024-01-02T00:00:00", "2024-01-03T00:00:00"]):
            f.write(json.dumps({"_id": {"$oid": f"x{i}"}, "event_id": f"e{i}", "timestamp": ts,
                                "properties": {"tags": ["a", "b"], "page": "/p"}}) + "\n")
    cfg = {"type": "mongodb", "path": d, "watermark": "timestamp",
           "schema": "_id struct<`$oid`: string>, event_id string, timestamp timestamp_ntz, "
                     "properties struct<tags: array<string>, page: string>"}
    df = readers.read_source(spark, cfg, since="2024-01-01 12:00:00")
    assert "_id" not in df.columns
    assert sorted(r["event_id"] for r in df.collect()) == ["e1", "e2"]     # strictly newer only
    bronze = landing.to_bronze(df, "app_events", "r1")
    r = bronze.filter("event_id = 'e1'").first()
    assert r["properties.tags"] == '["a","b"]' and r["properties.page"] == "/p"
    assert r["timestamp"] == "2024-01-02 00:00:00"


def test_interrupted_swaps_recover(spark):
    fs_path = lambda p: local_path(p)                                   # noqa: E731
    v1 = spark.createDataFrame([("1",)], "id string")
    v2 = spark.createDataFrame([("1",), ("2",)], "id string")

    # crash after the old table was moved aside, with a complete stage: roll forward
    path = scratch_path(spark, "t")
    v1.write.parquet(path + "__old")
    landing._write_watermark(spark, path + "__old", "r1", "wm1")
    v2.write.parquet(path + "__stage")
    landing.recover_table(spark, path)
    assert landing.read_table(spark, path).count() == 2
    assert landing.read_watermark(spark, path) == "wm1"
    assert not os.path.exists(fs_path(path + "__old"))

    # crash while the stage was being written (no _SUCCESS): roll back
    path = scratch_path(spark, "t")
    v1.write.parquet(path + "__old")
    v2.write.parquet(path + "__stage")
    os.remove(os.path.join(fs_path(path + "__stage"), "_SUCCESS"))
    landing.recover_table(spark, path)
    assert landing.read_table(spark, path).count() == 1

    # crash before the old copy was deleted: finish
    path = scratch_path(spark, "t")
    v2.write.parquet(path)
    v1.write.parquet(path + "__old")
    landing.recover_table(spark, path)
    assert landing.read_table(spark, path).count() == 2 and not os.path.exists(fs_path(path + "__old"))


def test_batch_and_watermark_commit_together(spark):
    src, wh = scratch_path(spark, "src"), scratch_path(spark, "wh")
    reg, path = _reg(src), landing.table_path(wh, "bronze.app_users")
    rows = [(i, f"{i}@x", t(f"2025-01-0{i} 00:00:00")) for i in range(1, 5)]
    spark.createDataFrame(rows[:2], USERS).write.parquet(src)
    landing.ingest(spark, reg, wh, ["app_users"], "r1")

    def stage(ids, watermark):
        batch = landing.to_bronze(spark.createDataFrame([rows[i - 1] for i in ids], USERS), "app_users", "r2")
        batch.write.parquet(path + "__batch")
        landing._write_watermark(spark, path + "__batch", "r2", watermark)

    # stopped before the commit: neither rows nor watermark, the next run lands them
    stage([3], "2025-01-03 00:00:00")
    spark.createDataFrame(rows[2:3], USERS).write.mode("append").parquet(src)
    assert landing.ingest(spark, reg, wh, ["app_users"], "r3") == {"app_users": 1}
    assert landing.read_watermark(spark, path) == "2025-01-03 00:00:00"
    assert landing.read_table(spark, path).count() == 3
    # stopped after it, one file already moved: rolled forward, nothing lands twice
    spark.createDataFrame(rows[3:], USERS).write.mode("append").parquet(src)
    stage([4], "2025-01-04 00:00:00")
    moved = local_path(path + "__batch")
    one = next(f for f in os.listdir(moved) if f.endswith(".parquet"))
    open(os.path.join(moved, landing.COMMIT_MARKER), "w").close()
    os.rename(os.path.join(moved, one), os.path.join(local_path(path), one))
    assert landing.ingest(spark, reg, wh, ["app_users"], "r4") == {"app_users": 0}
    assert sorted(r["user_id"] for r in landing.read_table(spark, path).collect()) == ["1", "2", "3", "4"]
    assert landing.read_watermark(spark, path) == "2025-01-04 00:00:00"
    assert not os.path.exists(moved)


def test_full_load_keeps_lost_columns(spark):
    src, wh = scratch_path(spark, "src"), scratch_path(spark, "wh")
    reg = registry_with({"crm_contacts": {"type": "parquet", "path": src}})
    path = landing.table_path(wh, "bronze.crm_contacts")
    spark.createDataFrame([("a@x", "A", "web")], "contact_email string, `x.name` string, lead string").write.parquet(src)
    landing.ingest(spark, reg, wh, ["crm_contacts"], "r1")
    spark.createDataFrame([("b@x", 3)], "contact_email string, rank int").write.mode("overwrite").parquet(src)
    landing.ingest(spark, reg, wh, ["crm_contacts"], "r2")
    got = landing.read_table(spark, path).collect()
    assert [r.asDict() for r in got] == [{"contact_email": "b@x", "rank": "3", "x.name": None, "lead": None,
                                          "_source": "crm_contacts", "_ingested_at": "r2"}]
