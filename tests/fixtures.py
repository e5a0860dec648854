"""Seed rows and small builders shared by the tests."""

import json
from datetime import datetime, timedelta

from fleetwatch import schemas

T0 = datetime(2026, 8, 8, 12)
SITE_B = "11111111-1111-1111-1111-111111111111"
SITE_R = "22222222-2222-2222-2222-222222222222"
A = {n: f"a1111111-0000-0000-0000-00000000000{n}" for n in (1, 2, 3, 4)}
B = {n: f"a2222222-0000-0000-0000-00000000000{n}" for n in (1, 2, 3)}
RULE = {n: f"c0000000-0000-0000-0000-00000000000{n}" for n in (1, 2, 3)}
USER = "d0000000-0000-0000-0000-000000000001"
ROOT = "plant"


def at(seconds=0.0):
    return T0 + timedelta(seconds=seconds)


def seed_tables(spark):
    """Two sites, seven devices, three rules, one user, no alerts."""
    # The seed rows.
    rows = {
        "sites": [
            (SITE_B, "Bangkok Data Center", "data_center", "Bangkok, TH", T0),
            (SITE_R, "Rayong Factory", "factory", "Rayong, TH", T0),
        ],
        "devices": [
            (A[1], SITE_B, "smart-meter-01", "smart_meter", None, T0),
            (A[2], SITE_B, "temp-sensor-01", "temp_sensor", None, T0),
            (A[3], SITE_B, "humidity-sensor-01", "humidity_sensor", None, T0),
            (A[4], SITE_B, "ups-01", "ups", None, T0),
            (B[1], SITE_R, "smart-meter-02", "smart_meter", None, T0),
            (B[2], SITE_R, "temp-sensor-02", "temp_sensor", None, T0),
            (B[3], SITE_R, "hvac-01", "hvac", None, T0),
        ],
        "alert_rules": [
            (RULE[1], A[2], "temperature_c", "gt", 28.0, "warning", True, T0),
            (RULE[2], A[2], "temperature_c", "gt", 32.0, "critical", True, T0),
            (RULE[3], A[1], "power_kw", "gt", 50.0, "warning", True, T0),
        ],
        "users": [(USER, "operator@example.org", "Site Operator", "operator", T0)],
        "alerts": [],
    }
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in schemas.TABLES.items()}


def telemetry(spark, readings):
    """(device, readings, seconds[, seq]) tuples as telemetry received when it was taken."""
    rows = []
    for n, (device, values, seconds, *seq) in enumerate(readings):
        rows.append((device, SITE_B, "temp_sensor", values, at(seconds), at(seconds), seq[0] if seq else n))
    return spark.createDataFrame(rows, schemas.TELEMETRY)


def alert(id, rule, status="open", device=A[2], value=33.0, severity="warning", triggered=0.0, ack=None, end=None):
    return (
        id, rule, device, value, severity, status, at(triggered),
        at(ack[0]) if ack else None, ack[1] if ack else None, at(end[0]) if end else None, end[1] if end else None,
    )


def payload(**changes):
    body = {
        "device_id": A[2],
        "site_id": SITE_B,
        "device_type": "temp_sensor",
        "readings": {"temperature_c": 24.8},
        "ts": "2026-08-08T12:00:00.000Z",
    }
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
