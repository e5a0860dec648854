from datetime import datetime

import pytest
from fixtures import A, ROOT, SITE_B, at, payload, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.functions.columns import parse_rfc3339, rfc3339
from fleetwatch.operators.ingest import accepted, parse_messages, reject_counts, rejects
from fleetwatch.sources.messages import encode_messages, from_kafka, read_messages, write_messages
from fleetwatch.sources.tables import read_telemetry, write_telemetry

GOOD_TOPIC = f"{ROOT}/{SITE_B}/{A[2]}/telemetry"
GOOD = payload()
YEAR_ONE = "0001-01-01 00:00:00"
NOON = "2026-08-08 12:00:00"

# payload, reason or None, value or None, ts or None
PAYLOADS = [
    (GOOD, None, 24.8, NOON),
    (f"  {GOOD}\n", None, 24.8, NOON),
    ("", "invalid_json", None, None),
    (None, "invalid_json", None, None),
    (GOOD + " x", "invalid_json", None, None),
    (GOOD + "} x", "invalid_json", None, None),
    (GOOD + "] x }", "invalid_json", None, None),
    (GOOD + "] , [", "invalid_json", None, None),
    (GOOD + GOOD, "invalid_json", None, None),
    (GOOD + "," + GOOD, "invalid_json", None, None),
    (GOOD + ",", "invalid_json", None, None),
    (GOOD[:-1], "invalid_json", None, None),
    ("'" + GOOD[1:], "invalid_json", None, None),
    (f"[{GOOD}]", "invalid_json", None, None),
    ("5", "invalid_json", None, None),
    ('"text"', "invalid_json", None, None),
    ("true", "invalid_json", None, None),
    ("null", "missing_field", None, None),
    ("{}", "missing_field", None, None),
    (payload(readings={"temperature_c": "24.8"}), "invalid_json", None, None),
    (payload(readings={"temperature_c": True}), "invalid_json", None, None),
    (payload(readings={"temperature_c": [1]}), "invalid_json", None, None),
    (payload(readings={"temperature_c": 1, "other": {}}), "invalid_json", None, None),
    (payload(readings=[24.8]), "invalid_json", None, None),
    (payload(readings="none"), "invalid_json", None, None),
    (GOOD.replace("24.8", "NaN"), "invalid_json", None, None),
    (GOOD.replace("24.8", "1e400"), "invalid_json", None, None),
    (GOOD.replace("24.8", "-1e400"), "invalid_json", None, None),
    (GOOD.replace("24.8", "024"), "invalid_json", None, None),
    (GOOD.replace("24.8", "1e3"), None, 1000.0, NOON),
    (GOOD.replace("24.8", "-12345678901234567890123456789012345678901"), None, -1.2345678901234568e40, NOON),
    (payload(device_id=5), "invalid_json", None, None),
    (payload(site_id=["x"]), "invalid_json", None, None),
    (payload(device_type=False), "invalid_json", None, None),
    (payload(device_id=...), "missing_field", None, None),
    (payload(site_id=None), "missing_field", None, None),
    (payload(device_type=""), "missing_field", None, None),
    (payload(readings=...), "empty_readings", None, None),
    (payload(readings=None), "empty_readings", None, None),
    (payload(readings={}), "empty_readings", None, None),
    (payload(device_id=A[1]), "id_mismatch", None, None),
    (payload(site_id="x"), "id_mismatch", None, None),
    (payload(device_id=A[2].upper()), "id_mismatch", None, None),
    (payload(readings={"temperature_c": None}), None, 0.0, NOON),
    (GOOD.replace('"temperature_c": 24.8', '"temperature_c": 1, "temperature_c": 2'), None, 2.0, NOON),
    (payload(device_type="nobody knows"), None, 24.8, NOON),
    (payload(more=[{"a": 1}]), None, 24.8, NOON),
    (payload(more=[{"a": 1}]) + "] }", "invalid_json", None, None),
    (payload(ts=...), None, 24.8, YEAR_ONE),
    (payload(ts=None), None, 24.8, YEAR_ONE),
    (payload(ts=""), "invalid_json", None, None),
    (payload(ts=1754654400), "invalid_json", None, None),
    (payload(ts="2026-08-08 12:00:00Z"), "invalid_json", None, None),
    (payload(ts="2026-08-08"), "invalid_json", None, None),
    (payload(ts="2026-08-08T12:00:00"), "invalid_json", None, None),
    (payload(ts="2026-02-30T12:00:00Z"), "invalid_json", None, None),
    (payload(ts="2026-08-08T12:00:00Z\n"), "invalid_json", None, None),
    (payload(ts="2026-08-08T19:00:00+07:00"), None, 24.8, NOON),
    (payload(ts="2026-08-08T12:00:00.123456789Z"), None, 24.8, NOON + ".123456"),
]


def messages(spark, cases):
    data = [(topic, body, at(n), n) for n, (topic, body) in enumerate(cases)]
    return spark.createDataFrame(data, schemas.MESSAGES)


def test_payload_cases(spark):
    parsed = parse_messages(messages(spark, [(GOOD_TOPIC, c[0]) for c in PAYLOADS]), ROOT)
    got = {
        r.seq: r
        for r in parsed.select(
            "seq", "reject_reason", F.element_at("readings", "temperature_c").alias("v"), F.col("ts").cast("string")
        ).collect()
    }
    for n, (body, reason, value, ts) in enumerate(PAYLOADS):
        assert got[n].reject_reason == reason, body
        if reason is None:
            assert (got[n].v, got[n].ts) == (value, ts), body


def test_topic_is_checked_first(spark):
    s, d = SITE_B, A[2]
    bad = [f"{ROOT}/{s}/{d}", f"{ROOT}/{s}/{d}/telemetry/x", f"other/{s}/{d}/telemetry", f"{ROOT}/{s}/{d}/state", "", None]
    cases = [(t, "not json") for t in bad] + [(f"{ROOT}///telemetry", GOOD), (f"{ROOT}//telemetry", GOOD)]
    parsed = parse_messages(messages(spark, cases), ROOT)
    reasons = [r.reject_reason for r in parsed.orderBy("seq").collect()]
    assert reasons == ["bad_topic"] * 6 + ["id_mismatch", "bad_topic"]


def test_accepted_rejects_and_counts(spark):
    parsed = parse_messages(messages(spark, [(GOOD_TOPIC, GOOD), (GOOD_TOPIC, "x"), ("y", "x"), (GOOD_TOPIC, "")]), ROOT)
    assert accepted(parsed).columns == schemas.TELEMETRY.names
    assert accepted(parsed).count() == 1
    assert {(r.seq, r.reject_reason) for r in rejects(parsed).collect()} == {
        (1, "invalid_json"), (2, "bad_topic"), (3, "invalid_json"),
    }
    assert {tuple(r) for r in reject_counts(parsed).collect()} == {("invalid_json", 2), ("bad_topic", 1)}


def test_filter_on_reason_does_not_repeat_the_decoding(spark, capsys):
    accepted(parse_messages(messages(spark, [(GOOD_TOPIC, GOOD)]), ROOT)).explain()
    plan = capsys.readouterr().out
    assert "Filter isnull(reject_reason" in plan


def test_encoded_messages_parse_back(spark):
    source = telemetry(spark, [(A[2], {"temperature_c": 24.125}, 0.123456), (A[1], {"power_kw": 1.0, "voltage": 2.0}, 1)])
    back = accepted(parse_messages(encode_messages(source, ROOT), ROOT))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, source.collect()))


def test_messages_survive_files_and_kafka_columns(spark, tmp_path):
    sent = messages(spark, [(GOOD_TOPIC, GOOD), (GOOD_TOPIC, "x\ny")])
    write_messages(sent, str(tmp_path / "m"))
    assert sorted(read_messages(spark, str(tmp_path / "m")).collect()) == sorted(sent.collect())
    kafka = sent.select(
        F.col("topic").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
        F.col("received_at").alias("timestamp"),
        F.col("seq").alias("offset"),
        F.lit(0).alias("partition"),
        F.lit(1).alias("timestampType"),
    )
    assert sorted(from_kafka(kafka).collect()) == sorted(sent.collect())
    second = from_kafka(kafka.withColumn("partition", F.lit(3))).select("seq").collect()
    assert {r.seq for r in second}.isdisjoint(r.seq for r in sent.collect())
    with pytest.raises(Exception, match="LogAppendTime"):
        from_kafka(kafka.withColumn("timestampType", F.lit(0))).collect()


def test_telemetry_lands_in_the_store(spark, tmp_path):
    rows = accepted(parse_messages(messages(spark, [(GOOD_TOPIC, GOOD)]), ROOT))
    for _ in range(2):  # delivered twice, stored twice
        write_telemetry(rows, str(tmp_path / "t"))
    stored = read_telemetry(spark, str(tmp_path / "t")).collect()
    assert len(stored) == 2
    assert stored[0].readings == {"temperature_c": 24.8}


@pytest.mark.parametrize(
    "text",
    ["2026-08-08T12:00:00Z", "2026-08-08T1:00:00,5-23:59", "2026-08-08T12:00:00.1234567+24:60", "2026-13-01T00:00:00Z",
     "2026-08-08T24:00:00Z", "2026-08-08t12:00:00z", "2026-08-08T12:00:00+7:00", "2026-08-08T12:00:00+25:00", "",
     "2026-08-08T12:00:00.Z", "2026-08-08T12:00:60Z", "x"],
)
def test_both_time_parsers_agree(spark, text):
    shown = spark.range(1).select(rfc3339(F.lit(text)).cast("timestamp_ntz")).first()[0]
    assert parse_rfc3339(text) == shown


def test_time_parser():
    assert parse_rfc3339("2026-08-08T12:00:00.5+07:00") == datetime(2026, 8, 8, 5, 0, 0, 500000)
    assert parse_rfc3339(None) is None
