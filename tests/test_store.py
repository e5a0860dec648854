"""The stream's store: commits, crashes between any two writes, segments that grow by what changed."""

import pytest
from fixtures import A, ROOT, RULE, USER, at, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.functions.columns import alert_id
from fleetwatch.operators.alerts import replay_alerts
from fleetwatch.operators.liveness import last_written
from fleetwatch.sources.messages import encode_messages
from fleetwatch.streaming import store as store_module
from fleetwatch.streaming.engine import current_alerts, current_last_seen, current_rules, mark_sources, process_batch
from fleetwatch.streaming.store import AlertStore, BatchWriter

FACTS = schemas.ALERTS.names


def readings(spark, number, value):
    """Batch `number`: one reading each of two devices, two minutes after the batch before."""
    return telemetry(spark, [(A[1], {"power_kw": value}, 120 * number, 2 * number), (A[2], {"temperature_c": 20.0}, 120 * number + 1, 2 * number + 1)])


def snapshot(spark, store):
    return rows(current_alerts(spark, store), *FACTS), rows(current_last_seen(spark, store), "device_id", "written_at"), store.all(spark, "telemetry").count()


def test_a_crash_between_any_two_writes_leaves_the_last_commit(spark, tmp_path, monkeypatch):
    rules, store = seed_tables(spark)["alert_rules"], AlertStore(str(tmp_path))
    process_batch(encode_messages(readings(spark, 0, 60.0), ROOT), 0, store, ROOT, rules)
    before = snapshot(spark, store)
    real, seen = BatchWriter._write, []

    def write(writer, df, schema, folder):
        assert snapshot(spark, store) == before  # readers in the middle of a batch
        if len(seen) == writes:
            raise RuntimeError("crash")
        seen.append(folder.split("/")[0])
        return real(writer, df, schema, folder)

    monkeypatch.setattr(BatchWriter, "_write", write)
    second = encode_messages(readings(spark, 1, 10.0), ROOT)
    for writes in (1, 4):
        seen.clear()
        with pytest.raises(RuntimeError):
            process_batch(second, 1, store, ROOT, rules)
        assert snapshot(spark, store) == before
    monkeypatch.setattr(BatchWriter, "_write", real)
    with pytest.raises(ZeroDivisionError):
        process_batch(second, 1, store, ROOT, rules, before_commit=lambda: 1 / 0)
    assert snapshot(spark, store) == before
    assert seen == ["telemetry", "rejects", "reject_counts", "last_seen_0"]
    for _ in range(2):  # the second run finds its commit and does nothing
        process_batch(second, 1, store, ROOT, rules)
        alerts, last, count = snapshot(spark, store)
        assert [a[5] for a in alerts] == ["resolved"] and count == 4 and last == [(A[1], at(120)), (A[2], at(121))]


def test_segments_hold_what_changed_and_are_merged(spark, tmp_path):
    rules, store = seed_tables(spark)["alert_rules"], AlertStore(str(tmp_path), every=2, fan=2)
    history = [readings(spark, n, 60.0 if n in (0, 1, 2, 5) else 10.0) for n in range(6)]
    for n, part in enumerate(history):
        writer = store.newest(spark)
        process_batch(encode_messages(part, ROOT), n, store, ROOT, rules)
        commit = store.newest(spark)
        assert commit.version == writer.version + 1
        added = [f for s in commit.segments if (f := s[2]) not in {x[2] for x in writer.segments} and s[:2] == ("alerts", 0)]
        changed = spark.read.parquet(*[f"{store.root}/{f}" for f in added]).count() if added else 0
        assert changed == (1 if n in (0, 3, 5) else 0) or not added
        assert len(commit.of("alerts")) <= 3 and len(commit.of("last_seen")) <= 3
    whole = history[0]
    for part in history[1:]:
        whole = whole.union(part)
    assert rows(current_alerts(spark, store), *FACTS) == rows(replay_alerts(whole, rules), *FACTS)
    assert rows(current_last_seen(spark, store), "device_id", "written_at") == rows(last_written(whole), "device_id", "written_at")
    # What the commits before the last replaced is gone; what it replaced itself is still there for readers under way.
    kept = {s[2] for s in commit.segments} | set(commit.replaced)
    there = {str(p.relative_to(tmp_path)) for name in ("alerts_0", "alerts_1", "last_seen_0", "last_seen_1", "last_seen_2") for p in tmp_path.glob(f"{name}/run=0/*/attempt=*")}
    assert there == {f for f in kept if f.split("/")[0] in ("alerts_0", "alerts_1", "last_seen_0", "last_seen_1", "last_seen_2")}


def test_full_blocks_of_commits_become_one_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "COMMIT_BLOCK", 3)
    store = AlertStore(str(tmp_path))
    for n in range(7):
        BatchWriter(spark, store, n).commit()
    files = [len(list((tmp_path / "_commits" / "run=0" / f"block={b}").glob("part-*"))) for b in range(3)]
    assert files == [1, 1, 1] and store.newest(spark).version == 7
    assert store.commits(spark).count() == 7 and store.newest(spark, 2).again and not store.newest(spark, 7).again


def test_rule_changes_and_commands_by_id_through_the_stream(spark, tmp_path):
    tables, store = seed_tables(spark), AlertStore(str(tmp_path))
    read = lambda *data: encode_messages(telemetry(spark, [(A[1], {"power_kw": v}, s, s) for s, v in data]), ROOT)
    change = lambda *data: spark.createDataFrame([(n, at(s), action, rule, A[1], "power_kw", "gt", limit, "critical", True) for n, s, action, rule, limit in data], schemas.RULE_CHANGES)
    ask = lambda *data: spark.createDataFrame([(n, at(s), action, i, USER) for n, s, action, i in data], schemas.ALERT_COMMANDS)
    run = lambda n, m, c, k: process_batch(mark_sources(m, c, k), n, store, ROOT, tables["alert_rules"], tables["users"], tables["devices"])
    one = spark.range(1)
    made = one.select(alert_id(F.lit("rule"), F.lit(at(3)), F.lit(2))).first()[0]
    name = lambda rule, s: one.select(alert_id(F.lit(rule), F.lit(at(s)), F.lit(s))).first()[0]
    run(0, read((0, 45.0), (10, 45.0)), ask(), change((1, 2, "update", RULE[3], 40.0), (2, 3, "create", None, 100.0), (3, 4, "delete", RULE[1], None)))
    first = name(RULE[3], 10)
    assert rows(current_alerts(spark, store), "id", "severity", "status") == [(first, "critical", "open")]
    run(1, read((20, 45.0), (30, 200.0)), ask((1, 15, "resolve", first), (2, 16, "resolve", first), (3, 25, "acknowledge", name(RULE[3], 20))), change((4, 12, "delete", RULE[3], None), (5, 31, "delete", made, None)))
    run(2, read((40, 10.0)), ask((4, 41, "resolve", first), (5, 42, "acknowledge", name(made, 30)), (6, 35, "resolve", name(RULE[3], 20))), change((6, 39, "update", RULE[1], 1.0)))
    assert rows(store.all(spark, "outcomes"), "cmd_id", "outcome") == [(1, "ok"), (2, "conflict"), (3, "ok"), (4, "conflict"), (5, "conflict"), (6, "ok")]
    assert rows(store.all(spark, "rule_outcomes"), "chg_id", "outcome") == [(1, "ok"), (2, "ok"), (3, "ok"), (4, "conflict"), (5, "conflict"), (6, "not_found")]
    assert rows(current_alerts(spark, store), "id", "status", "resolved_by") == sorted([(first, "resolved", USER), (name(RULE[3], 20), "resolved", USER), (name(made, 30), "resolved", None)], key=repr)
    assert rows(current_rules(spark, store, tables["alert_rules"]), "id", "threshold") == sorted([(RULE[2], 32.0), (RULE[3], 40.0), (made, 100.0)], key=repr)
