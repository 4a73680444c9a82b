"""Command line entry points, run in-process on the sf0.001 payload fixture."""

import json

from gridmart.__main__ import main
from gridmart.sources import fixtures

from data_paths import SF001


def test_ingest_test_report(spark, scratch, capsys):
    events = fixtures.read_events(spark, SF001)
    fixtures.payload_documents(events).write.partitionBy("indicator_id").text(f"{scratch}/landing")
    rc = main(["--master", "local[4]", "ingest", "--landing", f"{scratch}/landing", "--root", f"{scratch}/wh",
               "--start", "2024-01-01", "--end", "2024-12-31", "--json-lines"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 1 and out["status"] == 1  # three corrupted indicators fail, the rest load
    assert out["window"] == ["2024-01-01 00:00:00", "2025-01-01 00:00:00"]
    assert sum(c["inserted"] for c in out["counts"]) > 0

    rc = main(["--master", "local[4]", "test", "--root", f"{scratch}/wh"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(res["tests"]) == 17 and res["freshness"]["status"] in {"pass", "warn", "error"}

    assert main(["--master", "local[4]", "report", "price_by_bucket", "--root", f"{scratch}/wh",
                 "--db", "gm_cli_marts"]) == 0
    assert "renewable_bucket" in capsys.readouterr().out

    fixtures.catalogue_documents(events).write.text(f"{scratch}/catalogue")
    assert main(["--master", "local[4]", "catalogue", "--file", f"{scratch}/catalogue", "click"]) == 0
    assert "indicators matched." in capsys.readouterr().out


def test_every_row_is_printed_unless_asked_otherwise(spark, scratch, capsys):
    entries = ",".join(f'{{"id": {i}, "name": "entry {i}"}}' for i in range(1500))
    spark.createDataFrame([(f'{{"indicators": [{entries}]}}',)], "value string").write.text(f"{scratch}/catalogue")
    base = ["--master", "local[4]", "catalogue", "--file", f"{scratch}/catalogue"]
    assert main(base) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 1502 and lines[-1] == "1500 indicators matched."
    assert main([*base, "--rows", "10"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 12
    assert main([*base, "--out", f"{scratch}/found"]) == 0
    assert spark.read.parquet(f"{scratch}/found").count() == 1500


def test_a_chosen_shuffle_width_is_kept(spark):
    from gridmart.session import is_local

    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_build_rebuilds_marts(spark, scratch):
    from gridmart.plans import warehouse

    assert main(["--master", "local[4]", "build", "--root", f"{scratch}/wh"]) == 0
    layout = warehouse.Layout(f"{scratch}/wh")
    assert all(spark.read.parquet(layout.mart(n)).count() == 0 for n in warehouse.MART_NAMES)


def test_shuffle_width_tolerates_non_numeric_settings(spark, monkeypatch):
    from gridmart.plans import warehouse

    class Conf:
        def get(self, key, default=None):
            return "auto"

    class Fake:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert warehouse._shuffle_width(Fake()) == spark.sparkContext.defaultParallelism
