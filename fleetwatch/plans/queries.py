"""One query per operator, on the views derived from the given tables.

Results are flat: maps are exploded, so that they compare as plain rows.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.operators import addressed as D
from fleetwatch.operators import alerts as A
from fleetwatch.operators import commands as M
from fleetwatch.operators import deletes as X
from fleetwatch.operators import ingest as I
from fleetwatch.operators import liveness as L
from fleetwatch.operators import quality as C
from fleetwatch.operators import reads as Q
from fleetwatch.operators import rule_changes as R
from fleetwatch.operators import rule_versions as V
from fleetwatch.operators import rules as U
from fleetwatch.plans.views import ID_PATTERN, TOPIC_ROOT, Views
from fleetwatch.session import scratch_path
from fleetwatch.sources import messages as S
from fleetwatch.sources import tables as T
from fleetwatch.streaming import engine as E

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, shared with the SQL they are checked against.
GAP_SECONDS = 43_200
DEVICE = "7"
SITE = "3"
FROM, TO = "2024-01-05T00:00:00Z", "2024-01-20T07:00:00+07:00"
LATEST = 3
PAGE = {"limit": 500, "offset": 40}
CONTRACT = {
    "HOUSEHOLD": ["click", "view"],
    "MACHINERY": ["error"],
    "FURNITURE": ["purchase"],
    "AUTOMOBILE": ["view"],
}
BOUNDS = {"click": (2.0, 60.0), "error": (0.0, 35.5), "purchase": (10.0, 200.0), "view": (1.0, 1.0)}
#: Where streamed histories are cut into batches.
CUTS = ["2024-01-08", "2024-01-18"]
_ALERT_FACTS = ["alert_rule_id", "device_id", "triggered_value", "severity", "status", "triggered_at", "resolved_at"]


def _plain(rows: DataFrame) -> DataFrame:
    """UTC times without a zone, as the given tables have them."""
    return rows.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in rows.schema
        ]
    )


def _flat(telemetry: DataFrame) -> DataFrame:
    """One row per reading."""
    rest = [c for c in telemetry.columns if c != "readings"]
    return _plain(telemetry.select(*rest, F.explode("readings").alias("metric", "value")))


def _parsed(v: Views) -> DataFrame:
    return I.parse_messages(v.messages, TOPIC_ROOT)


def _encode_messages(v: Views) -> DataFrame:
    encoded = S.encode_messages(v.telemetry, TOPIC_ROOT)
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    return encoded.select(
        "topic",
        field("device_id").alias("device_id"),
        field("site_id").alias("site_id"),
        field("device_type").alias("device_type"),
        field("ts").alias("ts_text"),
        F.map_keys(F.from_json(field("readings"), "map<string,double>"))[0].alias("metric"),
        F.map_values(F.from_json(field("readings"), "map<string,double>"))[0].alias("value"),
        "received_at",
        "seq",
    )


def _src_messages(v: Views) -> DataFrame:
    folder = scratch_path(v.spark, "messages")
    S.write_messages(v.messages, folder)
    return S.read_messages(v.spark, folder).select("topic", F.sha2("payload", 256).alias("payload_hash"), "received_at", "seq")


def _telemetry_raw(v: Views) -> DataFrame:
    """Messages followed as a stream, parsed and appended."""
    source, target, checkpoint = (scratch_path(v.spark, n) for n in ("messages", "telemetry", "checkpoint"))
    S.write_messages(v.messages, source)
    stream = S.read_messages(v.spark, source, streaming=True)
    accepted = I.accepted(I.parse_messages(stream, TOPIC_ROOT))
    T.write_telemetry(accepted, target, checkpoint, once=True).awaitTermination()
    return _flat(T.read_telemetry(v.spark, target))


def _telemetry_layout(v: Views) -> DataFrame:
    folder = scratch_path(v.spark, "layout")
    T.write_telemetry_layout(_zoned(v.telemetry), folder)
    return _flat(T.read_telemetry(v.spark, folder, laid_out=True).drop("batch"))


def _telemetry_layout_late(v: Views) -> DataFrame:
    """The layout in two batches, the second of late rows of the same days and written twice; then compacted."""
    folder, whole = scratch_path(v.spark, "layout"), scratch_path(v.spark, "layout")
    late = F.col("seq") % 3 == 0
    T.write_telemetry_layout(_zoned(v.telemetry.where(~late)), folder, "first")
    for _ in range(2):
        T.write_telemetry_layout(_zoned(v.telemetry.where(late)), folder, "late")
    T.compact_telemetry_layout(v.spark, folder, whole)
    return _flat(T.read_telemetry(v.spark, whole, laid_out=True).drop("batch"))


def _zoned(telemetry: DataFrame) -> DataFrame:
    return telemetry.withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "received_at")})


def _alert_stream(v: Views) -> DataFrame:
    """The history arrives in four parts; each resumes the stream where the one before ended."""
    source, root, checkpoint = (scratch_path(v.spark, n) for n in ("messages", "alerts", "checkpoint"))
    store = E.AlertStore(root)
    first, last = v.messages.agg(F.min("received_at"), F.max("received_at")).first()
    for number in range(4):
        since = F.col("received_at") >= F.lit(first + (last - first) * number / 4)
        until = F.lit(number == 3) | (F.col("received_at") < F.lit(first + (last - first) * (number + 1) / 4))
        S.write_messages(v.messages.where(since & until), source)
        stream = S.read_messages(v.spark, source, streaming=True)
        E.run_alert_stream(stream, store, checkpoint, TOPIC_ROOT, lambda: v.rules, once=True).awaitTermination()
    return _plain(E.current_alerts(v.spark, store)).select(*_ALERT_FACTS)


def _alert_stream_rejects(v: Views) -> DataFrame:
    """What the stream keeps aside, with messages that came without a topic among the damage."""
    source, root, checkpoint = (scratch_path(v.spark, n) for n in ("messages", "alerts", "checkpoint"))
    keyless = F.when(F.col("seq") % 70 != 7, F.col("topic"))
    S.write_messages(v.messages.withColumn("topic", keyless), source)
    store = E.AlertStore(root)
    stream = S.read_messages(v.spark, source, streaming=True)
    E.run_alert_stream(stream, store, checkpoint, TOPIC_ROOT, lambda: v.rules, once=True).awaitTermination()
    return store.all(v.spark, "rejects").select("topic", "received_at", "seq", "reject_reason")


def _cut(rows: DataFrame, at: str) -> list[DataFrame]:
    """Rows of each batch, by their time."""
    edges = [None, *[F.lit(c).cast("timestamp_ntz") for c in CUTS], None]
    inside = lambda a, b: (F.lit(True) if a is None else F.col(at) >= a) & (F.lit(True) if b is None else F.col(at) < b)
    return [rows.where(inside(a, b)) for a, b in zip(edges, edges[1:])]


class _Unfinished(Exception):
    """Stands for a failure just before a batch's commit."""


def _alert_stream_commits(v: Views) -> DataFrame:
    """Alerts that a reader finds while each batch is written in full but not committed; the batch then runs again."""
    store, seen = E.AlertStore(scratch_path(v.spark, "alerts")), None

    def fail():
        raise _Unfinished

    for number, part in enumerate(_cut(v.messages, "received_at")):
        try:
            E.process_batch(part, number, store, TOPIC_ROOT, v.rules, before_commit=fail)
        except _Unfinished:
            found = E.current_alerts(v.spark, store).select(F.lit(number).alias("batches"), *_ALERT_FACTS)
            folder = scratch_path(v.spark, "seen")
            found.write.parquet(folder)
            found = v.spark.read.schema(found.schema).parquet(folder)
            seen = found if seen is None else seen.unionByName(found)
        E.process_batch(part, number, store, TOPIC_ROOT, v.rules)
    return seen


def _alert_stream_rules(v: Views) -> DataFrame:
    """Messages and rule changes through one stream, in three batches."""
    store = E.AlertStore(scratch_path(v.spark, "alerts"))
    parts = zip(_cut(v.messages, "received_at"), _cut(v.timed_changes, "chg_ts"))
    for number, (messages, changes) in enumerate(parts):
        rows = E.mark_sources(messages, changes=changes)
        E.process_batch(rows, number, store, TOPIC_ROOT, v.rules, devices=v.devices, id_pattern=ID_PATTERN)
    return E.current_alerts(v.spark, store).select("id", *_ALERT_FACTS)


def _alert_stream_commands(v: Views) -> DataFrame:
    """Messages and commands by alert id through one stream, in three batches."""
    store = E.AlertStore(scratch_path(v.spark, "alerts"))
    parts = zip(_cut(v.messages, "received_at"), _cut(v.alert_commands, "cmd_ts"))
    for number, (messages, commands) in enumerate(parts):
        rows = E.mark_sources(messages, commands)
        E.process_batch(rows, number, store, TOPIC_ROOT, v.rules, v.users, id_pattern=ID_PATTERN)
    return E.current_alerts(v.spark, store)


def _rule_versions(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    return V.replay_with_rule_changes(v.telemetry, v.rules, v.devices, v.timed_changes, id_pattern=ID_PATTERN)


def _addressed(v: Views) -> tuple[DataFrame, DataFrame]:
    return D.replay_addressed(A.judged_readings(v.telemetry, v.rules), v.alert_commands, users=v.users, id_pattern=ID_PATTERN)


def _stream_reject_counts(v: Views) -> DataFrame:
    """Rejects by reason as each batch counted them while it wrote its rows."""
    store = E.AlertStore(scratch_path(v.spark, "alerts"))
    for number, part in enumerate(_cut(v.messages, "received_at")[:2]):
        E.process_batch(part, number, store, TOPIC_ROOT, v.rules)
    rest = E.AlertStore(store.root, run=1)
    E.process_batch(_cut(v.messages, "received_at")[2], 0, rest, TOPIC_ROOT, v.rules)
    return rest.all(v.spark, "reject_counts").groupBy("reject_reason").agg(F.sum("messages").alias("messages"))


def _rule_decisions(v: Views) -> DataFrame:
    return U.decide(
        U.match_rules(v.newest_messages, U.enabled_rules(v.rules)), U.active_rules(v.earlier_alerts)
    )


def _commands(v: Views) -> tuple[DataFrame, DataFrame]:
    return M.apply_alert_commands(v.earlier_alerts, v.users, v.commands, ID_PATTERN)


def _rule_changes(v: Views) -> tuple[DataFrame, DataFrame]:
    return R.apply_rule_changes(v.rules, v.devices, v.alerts, v.rule_changes, ID_PATTERN)


def _after_commands(v: Views, action: str) -> DataFrame:
    """The alerts that commands of one kind lead to."""
    alerts, _ = M.apply_alert_commands(
        v.earlier_alerts, v.users, v.commands.where(F.col("action") == action), ID_PATTERN
    )
    return alerts


def _rules_created(v: Views) -> DataFrame:
    rules, _ = R.apply_rule_changes(
        v.rules, v.devices, v.alerts, v.rule_changes.where(F.col("action") == "create"), ID_PATTERN
    )
    return rules.join(v.rules.select("id"), "id", "left_anti").drop("id")


def _rules_updated(v: Views) -> DataFrame:
    rules, _ = R.apply_rule_changes(
        v.rules, v.devices, v.alerts, v.rule_changes.where(F.col("action") == "update"), ID_PATTERN
    )
    return rules


def _rules_deleted(v: Views) -> DataFrame:
    rules, _ = R.apply_rule_changes(
        v.rules, v.devices, v.alerts, v.rule_changes.where(F.col("action") == "delete"), ID_PATTERN
    )
    return v.rules.join(rules.select("id"), "id", "left_anti").select("id", "device_id", "metric")


def _last_seen(v: Views) -> DataFrame:
    return L.apply_last_seen(v.devices, L.last_written(v.telemetry, gap_seconds=GAP_SECONDS))


def _damaged(v: Views) -> C.Tables:
    """All rows of the tables, some with a new id, a value lost or a twin, so that checks find something."""
    k = F.col("id").cast("long")
    renamed = lambda hit: F.when(hit, F.concat(F.lit("new-"), F.col("id"))).otherwise(F.col("id"))
    copies = F.sequence(F.lit(1), F.when(k % 4 == 0, 2).otherwise(1))
    return {
        "sites": v.sites.withColumn("id", renamed(k % 9 == 4)),
        "devices": v.devices.withColumns({"name": F.when(k % 8 != 5, F.col("name")), "id": renamed(k % 10 == 3)}),
        "alert_rules": v.rules.withColumns(
            {"threshold": F.when(k % 70 != 0, F.col("threshold")), "id": renamed(k % 50 == 1)}
        ),
        "users": v.users.withColumns({"copy": F.explode(copies), "id": renamed(k % 4 == 1)}).drop("copy"),
        "alerts": _commands(v)[0],
    }


def _user_removal(v: Views) -> DataFrame:
    return C.remove_users(_commands(v)[0], v.users.where(F.col("role") == "guest")).select(
        "id", "status", "acknowledged_by", "resolved_by"
    )


def _several_active(v: Views) -> DataFrame:
    """Alerts of two runs kept side by side, where a rule can be active twice."""
    return C.check_single_active(v.alerts.unionByName(v.earlier_alerts))


_QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    "src_messages": _src_messages,
    "encode_messages": _encode_messages,
    "telemetry_raw": _telemetry_raw,
    "telemetry_layout": _telemetry_layout,
    "telemetry_layout_late": _telemetry_layout_late,
    "parse_accepted": lambda v: _flat(I.accepted(_parsed(v))),
    "ingest_rejects": lambda v: _plain(I.rejects(_parsed(v))).drop("payload"),
    "reject_counts": lambda v: I.reject_counts(_parsed(v)),
    "enabled_rules": lambda v: U.enabled_rules(v.rules).drop("created_at"),
    "active_rules": lambda v: U.active_rules(v.alerts),
    "rule_matches": lambda v: U.match_rules(v.telemetry, U.enabled_rules(v.rules)),
    "threshold_eval": lambda v: U.evaluate(U.match_rules(v.telemetry, v.rules)).select(
        "alert_rule_id", "seq", "value", "operator", "threshold", "breached"
    ),
    "rule_decisions": lambda v: _rule_decisions(v).select("alert_rule_id", "device_id", "seq", "value", "decision"),
    "alerts_opened": lambda v: A.open_alerts(_rule_decisions(v)).select("id", *_ALERT_FACTS),
    "alerts_auto_resolved": lambda v: A.auto_resolve(v.earlier_alerts, _rule_decisions(v)).select(*_ALERT_FACTS),
    "alert_replay": lambda v: v.alerts.select("id", *_ALERT_FACTS),
    "alert_transitions": lambda v: A.alert_transitions(v.telemetry, v.rules),
    "alert_lifecycle": lambda v: A.replay_with_commands(v.telemetry, v.rules, v.rule_commands)[0],
    "alert_lifecycle_outcomes": lambda v: A.replay_with_commands(v.telemetry, v.rules, v.rule_commands)[1],
    "alert_stream": _alert_stream,
    "alert_stream_rejects": _alert_stream_rejects,
    "stream_reject_counts": _stream_reject_counts,
    "alert_stream_commits": _alert_stream_commits,
    "alert_stream_rules": _alert_stream_rules,
    "alert_stream_commands": _alert_stream_commands,
    "alert_replay_rule_versions": lambda v: _rule_versions(v)[0].select("id", *_ALERT_FACTS),
    "rule_version_outcomes": lambda v: _rule_versions(v)[2],
    "rules_after_versions": lambda v: _rule_versions(v)[1],
    "alert_replay_by_id": lambda v: _addressed(v)[0],
    "alert_id_outcomes": lambda v: _addressed(v)[1],
    "last_seen_writes": lambda v: L.last_seen_writes(v.telemetry, gap_seconds=GAP_SECONDS),
    "device_last_seen": lambda v: _last_seen(v).select("id", "name", "last_seen_at"),
    "list_sites": lambda v: Q.list_sites(v.sites),
    "list_devices": lambda v: Q.list_devices(_last_seen(v)),
    "list_devices_by_site": lambda v: Q.list_devices(v.devices, SITE),
    "get_device": lambda v: Q.get_device(v.devices, DEVICE),
    "device_telemetry": lambda v: _flat(Q.device_telemetry(v.telemetry, DEVICE, limit=50)),
    "device_telemetry_range": lambda v: _flat(Q.device_telemetry(v.telemetry, DEVICE, FROM, TO, limit=1000)),
    "latest_telemetry_per_device": lambda v: _flat(Q.latest_telemetry(v.telemetry, LATEST)),
    "list_alerts": lambda v: Q.list_alerts(v.alerts, v.devices),
    "list_alerts_by_site": lambda v: Q.list_alerts(v.alerts, v.devices, site_id=SITE, status="open", limit=500),
    "list_alerts_page": lambda v: Q.list_alerts(v.alerts, v.devices, status="resolved", **PAGE),
    "list_rules": lambda v: Q.list_rules(v.rules),
    "list_rules_by_device": lambda v: Q.list_rules(v.rules, DEVICE),
    "acknowledge_alerts": lambda v: _after_commands(v, "acknowledge"),
    "resolve_alerts": lambda v: _after_commands(v, "resolve"),
    "alerts_after_commands": lambda v: _commands(v)[0],
    "command_outcomes": lambda v: _commands(v)[1],
    "rules_created": _rules_created,
    "rules_updated": _rules_updated,
    "rules_deleted": _rules_deleted,
    "rules_after_changes": lambda v: _rule_changes(v)[0].drop("id"),
    "rule_change_outcomes": lambda v: _rule_changes(v)[1],
    "check_domains": lambda v: C.check_domains(v.tables),
    "check_foreign_keys": lambda v: C.check_foreign_keys(_damaged(v)),
    "blocked_deletes": lambda v: C.blocked_deletes(v.tables),
    "parent_delete_outcomes": lambda v: X.apply_deletes(v.tables, v.deletes)[1],
    "devices_after_deletes": lambda v: X.apply_deletes(v.tables, v.deletes)[0]["devices"].select("id", "site_id", "name"),
    "user_removal": _user_removal,
    "check_unique": lambda v: C.check_unique(_damaged(v)),
    "check_not_null": lambda v: C.check_not_null(_damaged(v)),
    "check_single_active": _several_active,
    "check_integrity": lambda v: C.check_integrity(_damaged(v)),
    "table_counts": lambda v: C.table_counts({**v.tables, "telemetry_raw": v.telemetry}),
    "check_reading_keys": lambda v: C.check_reading_keys(v.telemetry, CONTRACT),
    "check_reading_bounds": lambda v: C.check_reading_bounds(v.telemetry, BOUNDS),
}


def queries() -> dict[str, Query]:
    def run(build):
        return lambda spark, sf_dir: _plain(build(Views(spark, sf_dir)))

    return {name: run(build) for name, build in _QUERIES.items()}
