"""The command line over the same functions (in-process)."""

import json


from tidemark import cli
from tidemark.plans.q_io import write_source_files
from tidemark.session import local_path, scratch_path
from tidemark.sources import published

SF = "/root/testdata/sf0.001"


def registry_file(spark):
    reg, _ = write_source_files(spark, SF)
    reg["app_events"]["schema"] = reg["app_events"]["schema"].json()
    path = local_path(scratch_path(spark, "registry")) + ".json"
    with open(path, "w") as f:
        json.dump({"sources": reg}, f)
    return path


def test_cli_ingest_run_check(spark, capsys):
    reg = registry_file(spark)
    wh = scratch_path(spark, "wh")
    assert cli.main(["check", "--registry", reg, "--warehouse", wh, "--layer", "bronze",
                     "--as-of", "2001-09-01 00:00:00"]) == 3          # nothing stored yet
    assert cli.main(["ingest", "--registry", reg, "--warehouse", wh, "--source", "crm_contacts",
                     "--as-of", "2001-08-31 18:00:00"]) == 0
    landed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["landed"]
    assert landed == {"crm_contacts": 135}
    code = cli.main(["run", "--registry", reg, "--warehouse", wh, "--as-of", "2001-09-01 00:00:00",
                     "--scale", "0.15", "--reference-now", "2024-01-10 00:00:00", "--publish-failed"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(out["gates"]) == {"bronze", "silver", "gold"} and code in (0, 2)
    code = cli.main(["check", "--registry", reg, "--warehouse", wh, "--layer", "gold",
                     "--as-of", "2001-09-01 00:00:00", "--scale", "0.15"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert len(lines) == 13 and code == (2 if any(r["outcome"] == "fail" for r in lines) else 0)
    assert published.current(spark, f"{wh}/gold").number == out["published"] == 1
    cli.main(["run", "--registry", reg, "--warehouse", wh, "--as-of", "2001-09-02 00:00:00", "--scale", "50"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["gates"]["bronze"] == "fail" and out["published"] is None        # far too few rows: not shown
    assert published.current(spark, f"{wh}/gold").number == 1
