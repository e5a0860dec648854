"""Results do not depend on the session's zone, nor on how an id is spelt."""

from datetime import datetime, timedelta, timezone

import pytest
from fixtures import A, ROOT, RULE, SITE_B, USER, at, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.operators import quality, reads
from fleetwatch.operators.alerts import replay_alerts
from fleetwatch.operators.commands import apply_alert_commands
from fleetwatch.operators.ingest import accepted, parse_messages
from fleetwatch.operators.liveness import last_seen_writes
from fleetwatch.operators.rule_changes import apply_rule_changes
from fleetwatch.sources.messages import encode_messages
from fleetwatch.sources.tables import read_telemetry, write_telemetry_layout

#: Half-hourly readings around 2023-11-05 06:00 UTC, when clocks in New York go back.
EPOCH = datetime(2023, 11, 5, 3, tzinfo=timezone.utc)


def history(spark):
    start = int(EPOCH.timestamp())
    points = [(A[1], "site", "smart_meter", {"power_kw": 60.0 if n % 3 else 20.0}, start + n * 1800, n) for n in range(16)]
    rows_ = spark.createDataFrame(points, "device_id string, site_id string, device_type string, readings map<string,double>, s long, seq long")
    return rows_.select("device_id", "site_id", "device_type", "readings", F.timestamp_seconds("s").alias("ts"), F.timestamp_seconds("s").alias("received_at"), "seq")


def results(spark, folder):
    """Everything as microseconds, so that nothing is shown in the session's zone."""
    found, rules = history(spark), seed_tables(spark)["alert_rules"]
    back = accepted(parse_messages(encode_messages(found, ROOT), ROOT))
    write_telemetry_layout(found, folder)
    laid_out = read_telemetry(spark, folder, laid_out=True)
    micro = lambda df, *cs: sorted(map(tuple, df.select(*[F.unix_micros(c) if df.schema[c].dataType.typeName() == "timestamp" else F.col(c).cast("string") for c in cs]).collect()), key=repr)
    end = (EPOCH + timedelta(hours=4)).isoformat().replace("+00:00", "Z")
    return [
        micro(back, "ts", "received_at", "seq"),
        micro(laid_out, "ts", "ts_date", "seq"),
        micro(reads.device_telemetry(laid_out, A[1], to=end), "ts"),
        micro(replay_alerts(found, rules), "id", "triggered_at", "resolved_at", "status"),
        micro(last_seen_writes(found), "device_id", "written_at"),
    ]


def test_another_zone_changes_nothing(spark, tmp_path):
    want = results(spark, str(tmp_path / "utc"))
    assert all(want) and len(want[2]) == 9
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert results(spark, str(tmp_path / "ny")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_missing_setting_is_refused(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(ValueError, match="allowDuplicateKeys"):
            parse_messages(spark.createDataFrame([], schemas.MESSAGES), ROOT)
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


SPELLINGS = [str.lower, str.upper, lambda x: x.replace("-", ""), lambda x: x.upper().replace("-", "")]


@pytest.mark.parametrize("stored", SPELLINGS[:3])
def test_ids_are_compared_by_value(spark, stored):
    def spelt(df):
        text = F.udf(lambda x: None if x is None else stored(x))
        return df.withColumns({c: text(c) for c in df.columns if c == "id" or c.endswith(("_id", "ed_by"))})

    tables = {name: spelt(df) for name, df in seed_tables(spark).items()}
    alerts = spelt(replay_alerts(telemetry(spark, [(A[1], {"power_kw": 60.0}, 0)]), seed_tables(spark)["alert_rules"]))
    alert = alerts.first()["id"]
    for ask in SPELLINGS:
        assert reads.get_device(tables["devices"], ask(A[1])).count() == 1
        assert reads.list_devices(tables["devices"], ask(SITE_B)).count() == 4
        assert reads.list_alerts(alerts, tables["devices"], site_id=ask(SITE_B), device_id=ask(A[1])).count() == 1
        assert reads.list_rules(tables["alert_rules"], ask(A[2])).count() == 2
        cmds = spark.createDataFrame([(1, at(5), "acknowledge", ask(alert), ask(USER))], schemas.ALERT_COMMANDS)
        assert rows(apply_alert_commands(alerts, tables["users"], cmds)[1], "outcome") == [("ok",)]
        change = spark.createDataFrame([(1, at(5), "delete", ask(RULE[1]), None, None, None, None, None, None)], schemas.RULE_CHANGES)
        assert rows(apply_rule_changes(tables["alert_rules"], tables["devices"], alerts, change)[1], "outcome") == [("ok",)]
    twice = {**tables, "alerts": alerts, "sites": tables["sites"].union(seed_tables(spark)["sites"].limit(1))}
    assert [r.table_name for r in quality.check_unique(twice).collect()] == ["sites"]


def test_the_newest_readings_are_as_many_as_asked(spark):
    found = telemetry(spark, [(A[1], {}, s) for s in range(300)])
    assert reads.latest_telemetry(found, 1001).count() == 300
    assert reads.latest_telemetry(found, 150).count() == 150
    with pytest.raises(ValueError, match="at least 1"):
        reads.latest_telemetry(found, 0)
