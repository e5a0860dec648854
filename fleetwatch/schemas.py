"""Declared schemas of every table, and the fixed values their columns may take."""

from pyspark.sql import types as T

_S, _D, _L, _B, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _table(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SITES = _table(id=_S, name=_S, type=_S, location=_S, created_at=_TS)
DEVICES = _table(id=_S, site_id=_S, name=_S, type=_S, last_seen_at=_TS, created_at=_TS)
ALERT_RULES = _table(
    id=_S, device_id=_S, metric=_S, operator=_S, threshold=_D, severity=_S, enabled=_B, created_at=_TS
)
USERS = _table(id=_S, email=_S, name=_S, role=_S, created_at=_TS)
ALERTS = _table(
    id=_S,
    alert_rule_id=_S,
    device_id=_S,
    triggered_value=_D,
    severity=_S,
    status=_S,
    triggered_at=_TS,
    acknowledged_at=_TS,
    acknowledged_by=_S,
    resolved_at=_TS,
    resolved_by=_S,
)
READINGS = T.MapType(_S, _D)
TELEMETRY = _table(
    device_id=_S, site_id=_S, device_type=_S, readings=READINGS, ts=_TS, received_at=_TS, seq=_L
)
MESSAGES = _table(topic=_S, payload=_S, received_at=_TS, seq=_L)

# Requests that change alerts: addressed by alert, or by rule on a timeline.
ALERT_COMMANDS = _table(cmd_id=_L, cmd_ts=_TS, action=_S, alert_id=_S, user_id=_S)
RULE_COMMANDS = _table(cmd_id=_L, cmd_ts=_TS, action=_S, alert_rule_id=_S, user_id=_S)
RULE_CHANGES = _table(
    chg_id=_L,
    chg_ts=_TS,
    action=_S,
    rule_id=_S,
    device_id=_S,
    metric=_S,
    operator=_S,
    threshold=_D,
    severity=_S,
    enabled=_B,
)

TABLES = {
    "sites": SITES,
    "devices": DEVICES,
    "alert_rules": ALERT_RULES,
    "users": USERS,
    "alerts": ALERTS,
}

# The words each column admits.
SITE_TYPES = ["data_center", "building", "factory"]
DEVICE_TYPES = ["smart_meter", "temp_sensor", "humidity_sensor", "ups", "hvac"]
OPERATORS = ["gt", "gte", "lt", "lte"]
SEVERITIES = ["warning", "critical"]
STATUSES = ["open", "acknowledged", "resolved"]
ROLES = ["admin", "operator", "viewer"]

# An alert in one of these states keeps its rule from firing again.
ACTIVE_STATUSES = ["open", "acknowledged"]

# Columns that may not be null.
NOT_NULL = {
    "sites": ["id", "name", "type", "created_at"],
    "devices": ["id", "site_id", "name", "type", "created_at"],
    "alert_rules": [
        "id", "device_id", "metric", "operator", "threshold", "severity", "enabled", "created_at",
    ],
    "users": ["id", "email", "name", "role", "created_at"],
    "alerts": [
        "id", "alert_rule_id", "device_id", "triggered_value", "severity", "status", "triggered_at",
    ],
}

# The metrics each device type reports.
READING_KEYS = {
    "smart_meter": ["power_kw", "voltage", "current"],
    "temp_sensor": ["temperature_c"],
    "humidity_sensor": ["humidity_pct"],
    "ups": ["battery_pct", "load_pct"],
    "hvac": ["temperature_c", "setpoint_c"],
}

# The documented range of each metric, both ends included.
READING_BOUNDS = {
    "power_kw": (20.0, 58.0),
    "voltage": (215.0, 240.0),
    "current": (30.0, 65.0),
    "temperature_c": (18.0, 33.0),
    "humidity_pct": (35.0, 70.0),
    "battery_pct": (90.0, 100.0),
    "load_pct": (10.0, 75.0),
    "setpoint_c": (24.0, 24.0),
}

# Id columns are UUIDs, compared without regard to case.
UUID_PATTERN = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"
