import random
from datetime import timedelta

import pytest
from fixtures import A, ROOT, RULE, T0, USER, at, rows, seed_tables, telemetry
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.operators.alerts import replay_alerts, replay_with_commands
from fleetwatch.operators.ingest import accepted, parse_messages
from fleetwatch.operators.liveness import last_written
from fleetwatch.sources.messages import encode_messages, read_messages, write_messages
from fleetwatch.sources.tables import read_telemetry, write_telemetry
from fleetwatch.streaming.engine import (
    AlertStore,
    current_alerts,
    current_last_seen,
    mark_sources,
    process_batch,
    run_alert_stream,
)

FACTS = [c for c in schemas.ALERTS.names]


def history(spark, seed=1):
    rnd = random.Random(seed)
    data = [(A[rnd.choice([1, 2, 2])], {rnd.choice(["temperature_c", "power_kw"]): float(rnd.randint(20, 60))}, n * rnd.choice([1, 7]), n) for n in range(120)]
    return telemetry(spark, sorted(data, key=lambda r: (r[2], r[3])))


def parts(spark, messages, cuts):
    ordered = sorted(messages.collect(), key=lambda r: (r.received_at, r.seq))
    edges = [0, *cuts, len(ordered)]
    for a, b in zip(edges, edges[1:]):
        yield spark.createDataFrame(ordered[a:b], schemas.MESSAGES)


def test_stream_equals_batch_and_survives_restarts(spark, tmp_path):
    rules = seed_tables(spark)["alert_rules"]
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    store = AlertStore(str(tmp_path / "store"))
    messages = encode_messages(history(spark), ROOT)
    bad = messages.limit(3).withColumn("payload", F.lit("broken"))
    for part in parts(spark, messages.unionByName(bad), [25, 26, 80]):
        write_messages(part, source)
        stream = read_messages(spark, source, streaming=True)
        run_alert_stream(stream, store, checkpoint, ROOT, lambda: rules, once=True).awaitTermination()
    stored = store.all(spark, "telemetry")
    assert stored.count() == 120 and store.all(spark, "rejects").count() == 3
    assert stored.select("batch_id").distinct().count() == 4
    assert rows(current_alerts(spark, store), *FACTS) == rows(replay_alerts(history(spark), rules), *FACTS)
    assert rows(current_last_seen(spark, store), "device_id", "written_at") == rows(last_written(history(spark)), "device_id", "written_at")


def commanded(spark, part, cmds):
    return mark_sources(part, spark.createDataFrame(cmds, schemas.RULE_COMMANDS))


@pytest.mark.parametrize("seed", [5])
def test_batches_with_commands_equal_one_replay_and_can_be_repeated(spark, tmp_path, seed):
    rnd = random.Random(seed)
    tables = seed_tables(spark)
    store = AlertStore(str(tmp_path))
    events = history(spark, seed)
    cmds = [(n, T0 + timedelta(seconds=rnd.randint(0, 700)), rnd.choice(["acknowledge", "resolve"]), RULE[rnd.randint(1, 3)], rnd.choice([USER, None])) for n in range(60)]
    ordered = sorted(encode_messages(events, ROOT).collect(), key=lambda r: (r.received_at, r.seq))
    edges = [T0, at(90), at(91), at(400), at(10_000)]
    for number, (a, b) in enumerate(zip(edges, edges[1:])):
        part = commanded(
            spark,
            spark.createDataFrame([m for m in ordered if a <= m.received_at < b], schemas.MESSAGES),
            [c for c in cmds if a <= c[1] < b],
        )
        for _ in range(2 if number == 2 else 1):
            process_batch(part, number, store, ROOT, tables["alert_rules"], tables["users"])
    alerts, outcomes = replay_with_commands(events, tables["alert_rules"], spark.createDataFrame(cmds, schemas.RULE_COMMANDS), None, tables["users"])
    assert rows(current_alerts(spark, store), *FACTS) == rows(alerts, *FACTS)
    assert rows(store.all(spark, "outcomes"), "cmd_id", "outcome") == rows(outcomes, "cmd_id", "outcome")


def test_commands_as_a_second_stream(spark, tmp_path):
    tables = seed_tables(spark)
    store = AlertStore(str(tmp_path / "store"))
    write_messages(encode_messages(telemetry(spark, [(A[1], {"power_kw": 60.0}, 0)]), ROOT), str(tmp_path / "m"))
    spark.createDataFrame([(1, at(5), "acknowledge", RULE[3], USER)], schemas.RULE_COMMANDS).write.parquet(str(tmp_path / "c"))
    run_alert_stream(
        read_messages(spark, str(tmp_path / "m"), streaming=True),
        store,
        str(tmp_path / "checkpoint"),
        ROOT,
        lambda: tables["alert_rules"],
        spark.readStream.schema(schemas.RULE_COMMANDS).parquet(str(tmp_path / "c")),
        tables["users"],
        once=True,
    ).awaitTermination()
    assert rows(current_alerts(spark, store), "status", "acknowledged_by") == [("acknowledged", USER)]


def test_a_rule_edit_counts_from_the_next_batch_and_a_new_run_continues(spark, tmp_path):
    rules = seed_tables(spark)["alert_rules"]
    strict = rules.withColumn("threshold", F.lit(100.0))
    part = lambda s: encode_messages(telemetry(spark, [(A[1], {"power_kw": 60.0}, s)]), ROOT)
    store, later = AlertStore(str(tmp_path)), AlertStore(str(tmp_path), run=1)
    process_batch(part(0), 0, store, ROOT, rules)
    process_batch(part(70), 0, later, ROOT, rules)
    assert rows(current_alerts(spark, later), "status", "triggered_at") == [("open", at(0))]
    process_batch(part(80), 1, later, ROOT, strict)
    assert rows(current_alerts(spark, later), "status", "resolved_at") == [("resolved", at(80))]
    process_batch(part(90), 2, later, ROOT, strict)
    assert rows(current_alerts(spark, later), "status", "resolved_at") == [("resolved", at(80))]
    assert rows(current_last_seen(spark, later), "device_id", "written_at") == [(A[1], at(70))]


def test_streamed_telemetry_sink(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_messages(encode_messages(history(spark), ROOT), source)
    stream = accepted(parse_messages(read_messages(spark, source, streaming=True, max_files=1), ROOT))
    write_telemetry(stream, target, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert read_telemetry(spark, target).count() == 120


def test_null_topics_and_null_command_ids_are_reported(spark, tmp_path):
    tables, store = seed_tables(spark), AlertStore(str(tmp_path))
    good = encode_messages(telemetry(spark, [(A[1], {"power_kw": 60.0}, 0)]), ROOT).select(*schemas.MESSAGES.names)
    keyless = good.withColumn("topic", F.lit(None).cast("string"))
    broken = good.withColumn("payload", F.lit(None).cast("string"))
    cmds = [(None, at(5), "acknowledge", RULE[3], USER), (2, at(6), None, RULE[3], USER)]
    process_batch(commanded(spark, good.union(keyless).union(broken), cmds), 0, store, ROOT, tables["alert_rules"], tables["users"])
    assert store.all(spark, "telemetry").count() == 1
    assert rows(store.all(spark, "rejects"), "reject_reason") == [("bad_topic",), ("invalid_json",)]
    assert rows(store.all(spark, "outcomes"), "cmd_id", "outcome") == sorted([(None, "ok"), (2, "bad_request")], key=repr)
    process_batch(good.union(keyless), 1, store, ROOT, tables["alert_rules"])
    assert store.batch(spark, "telemetry", 1).count() == 1 and store.batch(spark, "rejects", 1).count() == 1


def test_a_small_batch_needs_few_tasks_whatever_the_shuffle_partitions(spark, tmp_path):
    """Rows that a batch uses several times are not left in as many pieces as there are shuffle partitions."""
    rules, store, tracker = seed_tables(spark)["alert_rules"], AlertStore(str(tmp_path / "store")), spark.sparkContext.statusTracker()
    messages = encode_messages(history(spark), ROOT)
    spread = messages.join(messages.select("seq").distinct(), "seq").select(*messages.columns)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.sparkContext.setJobGroup("small batch", "small batch")
    try:
        process_batch(spread, 0, store, ROOT, rules)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for job in tracker.getJobIdsForGroup("small batch") for s in tracker.getJobInfo(job).stageIds}
    wide = [s for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks >= 40]
    assert len(wide) <= 1, f"{len(wide)} of {len(stages)} stages"
    assert rows(current_alerts(spark, store), *FACTS) == rows(replay_alerts(history(spark), rules), *FACTS)
    assert not list((tmp_path / "store" / "_held").glob("*/*/*/*")), "nothing that the batch held is left"
