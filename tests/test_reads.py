import pytest
from fixtures import A, RULE, SITE_B, SITE_R, alert, at, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.functions.arguments import page_argument, telemetry_limit
from fleetwatch.operators import reads
from fleetwatch.sources.tables import compact_telemetry_layout, load_tables, read_telemetry, write_telemetry_layout


@pytest.mark.parametrize(
    "raw, limit",
    [(None, 100), (0, 100), ("-1", 100), (1001, 100), ("ten", 100), ("", 100), ("1.5", 100), (1, 1), ("1000", 1000), ("+7", 7), (" 7", 100)],
)
def test_telemetry_limit(raw, limit):
    assert telemetry_limit(raw) == limit


@pytest.mark.parametrize(
    "raw, size, offset",
    [(None, 50, 0), (-1, 50, 0), ("x", 50, 0), (501, 500, 501), (0, 0, 0), (1_000_001, 500, 1_000_000), (2**63, 50, 0), ("", 50, 0)],
)
def test_page_arguments(raw, size, offset):
    assert page_argument(raw, 50, 500) == size
    assert page_argument(raw, 0, 1_000_000) == offset


def test_sites_and_devices(spark):
    tables = seed_tables(spark)
    sites = tables["sites"].withColumn("location", F.when(F.col("id") == SITE_B, F.col("location")))
    assert [(r.name, r.location) for r in reads.list_sites(sites).collect()] == [
        ("Bangkok Data Center", "Bangkok, TH"), ("Rayong Factory", ""),
    ]
    assert [r.name for r in reads.list_devices(tables["devices"], SITE_B.upper()).collect()] == [
        "humidity-sensor-01", "smart-meter-01", "temp-sensor-01", "ups-01",
    ]
    assert reads.list_devices(tables["devices"], "").count() == 7
    assert reads.list_devices(tables["devices"], SITE_R).count() == 3
    assert reads.get_device(tables["devices"], A[1]).first().name == "smart-meter-01"
    assert reads.get_device(tables["devices"], "no id").collect() == []


def test_device_telemetry(spark):
    history = telemetry(spark, [(A[2], {"temperature_c": 20.0 + n}, n) for n in range(5)] + [(A[1], {"power_kw": 1.0}, 9)])

    def temperatures(**kw):
        return [r.readings["temperature_c"] for r in reads.device_telemetry(history, A[2], **kw).collect()]

    assert temperatures(limit=10) == [20, 21, 22, 23, 24]
    assert temperatures(limit=2) == [23, 24]
    assert temperatures(from_="2026-08-08T12:00:01Z", to="2026-08-08T19:00:03+07:00") == [21, 22, 23]
    assert temperatures(from_="2026-08-08 12:00:01", to="tomorrow") == [20, 21, 22, 23, 24]
    assert reads.device_telemetry(history, "unknown").collect() == []
    assert reads.device_telemetry(history, A[2]).columns == ["device_id", "readings", "ts", "received_at"]
    assert rows(reads.latest_telemetry(history, 2), "device_id", "seq") == [(A[1], 5), (A[2], 3), (A[2], 4)]


def test_ties_are_ordered(spark):
    history = telemetry(spark, [(A[2], {"x": float(n)}, 0) for n in range(6)])
    assert [r.readings["x"] for r in reads.device_telemetry(history, A[2], limit=3).collect()] == [3, 4, 5]


def test_list_alerts(spark):
    alerts = spark.createDataFrame(
        [alert(f"{n}", RULE[1], "open" if n % 2 else "resolved", device=A[1] if n < 3 else B1, triggered=n) for n in range(6)], schemas.ALERTS
    )
    devices = seed_tables(spark)["devices"]

    def ids(**kw):
        return [r.id for r in reads.list_alerts(alerts, devices, **kw).collect()]

    assert ids() == list("543210")
    assert ids(site_id=SITE_B) == list("210")
    assert ids(status="open") == list("531")
    assert ids(status="no such status") == []
    assert ids(status="", device_id="") == list("543210")
    assert ids(device_id=B1.upper(), status="resolved", site_id=SITE_R) == ["4"]
    assert ids(limit=2, offset=1) == ["4", "3"]
    assert ids(limit=0) == []
    assert ids(offset=10) == []


B1 = "a2222222-0000-0000-0000-000000000001"


def test_list_rules(spark):
    rules = seed_tables(spark)["alert_rules"].withColumn("enabled", F.lit(False))
    assert [r.id for r in reads.list_rules(rules).collect()] == [RULE[3], RULE[1], RULE[2]]
    assert [r.id for r in reads.list_rules(rules, A[2]).collect()] == [RULE[1], RULE[2]]


def test_tables_from_files(spark, tmp_path):
    for name, df in seed_tables(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
    loaded = load_tables(spark, str(tmp_path))
    assert {n: df.count() for n, df in loaded.items()} == {"sites": 2, "devices": 7, "alert_rules": 3, "users": 1, "alerts": 0}


# -- plans ----------------------------------------------------------------------------------------


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_laid_out_telemetry_prunes_days_and_skips_row_groups(spark, tmp_path, capsys):
    path = str(tmp_path / "layout")
    history = telemetry(spark, [(A[1 + n % 2], {"x": float(n)}, n * 7200) for n in range(60)])
    for _ in range(2):
        write_telemetry_layout(history, path)
    laid_out = read_telemetry(spark, path, laid_out=True)
    assert laid_out.count() == 60
    found = reads.device_telemetry(laid_out, A[2], "2026-08-10T00:00:00Z", "2026-08-10T23:00:00Z")
    assert len(found.collect()) == 6
    found.explain("formatted")
    text = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(ts_date" in text
    assert "EqualTo(device_id," in text and "GreaterThanOrEqual(ts," in text and "LessThanOrEqual(ts," in text
    assert "TakeOrderedAndProject" in text


def test_rewriting_one_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "layout")
    write_telemetry_layout(telemetry(spark, [(A[1], {}, 0), (A[1], {}, 86_400)]), path, "1")
    for _ in range(2):  # late rows, and the same batch again
        write_telemetry_layout(telemetry(spark, [(A[1], {}, 5), (A[1], {}, 86_401)]), path, "2")
    want = [(at(0),), (at(5),), (at(86_400),), (at(86_401),)]
    assert rows(read_telemetry(spark, path), "ts") == want
    compact_telemetry_layout(spark, path, str(tmp_path / "compact"))
    joined = read_telemetry(spark, str(tmp_path / "compact"), laid_out=True)
    assert rows(joined, "ts") == want and joined.select("batch").distinct().count() == 1


def test_batches_without_names_leave_each_other(spark, tmp_path):
    path, compact = str(tmp_path / "layout"), str(tmp_path / "compact")
    late = telemetry(spark, [(A[1], {}, 5)])
    write_telemetry_layout(telemetry(spark, [(A[1], {}, 0), (A[1], {"x": 1.0}, 10)]), path)
    for _ in range(2):
        write_telemetry_layout(late, path)
    want = [(at(0),), (at(5),), (at(10),)]
    assert sorted(rows(read_telemetry(spark, path), "ts")) == want
    for _ in range(2):
        compact_telemetry_layout(spark, path, compact)
    assert sorted(rows(read_telemetry(spark, compact), "ts")) == want
    write_telemetry_layout(telemetry(spark, [(A[1], {}, 7)]), compact)
    write_telemetry_layout(telemetry(spark, [(A[1], {}, 8)]), compact, "all")
    assert sorted(rows(read_telemetry(spark, compact), "ts")) == [(at(0),), (at(5),), (at(7),), (at(8),), (at(10),)]
    name = read_telemetry(spark, compact, laid_out=True).where(F.col("batch").startswith("compacted-")).first()["batch"]
    with pytest.raises(ValueError, match="compactions"):
        write_telemetry_layout(late, compact, name)


def test_top_k_plans(spark, capsys):
    tables = seed_tables(spark)
    history = telemetry(spark, [(A[1], {}, 0)])
    assert plan(reads.latest_telemetry(history, 3), capsys).count("WindowGroupLimit") == 2
    page = plan(reads.list_alerts(tables["alerts"], tables["devices"], limit=5, offset=5), capsys)
    assert "TakeOrderedAndProject" in page and "Join" not in page
