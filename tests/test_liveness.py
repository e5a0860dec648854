import random
from datetime import datetime, timedelta

import pytest
from fixtures import A, T0, at, rows, seed_tables, telemetry

from fleetwatch import schemas
from fleetwatch.operators.liveness import apply_last_seen, last_seen_writes, last_written


def seen(spark, seconds):
    return telemetry(spark, [(A[2], {"temperature_c": 1.0}, s) for s in seconds])


@pytest.mark.parametrize(
    "seconds, written",
    [
        ([0, 5, 61], [0, 61]),
        ([0, 60], [0, 60]),
        ([0, 59.999999], [0]),
        ([0, 0, 0], [0]),
        ([70, 0, 5], [0, 70]),
        ([0, 59, 118, 177], [0, 118]),
    ],
)
def test_debounce(spark, seconds, written):
    assert rows(last_seen_writes(seen(spark, seconds)), "written_at") == [(at(s),) for s in written]


def test_stored_time_is_respected(spark):
    stored = spark.createDataFrame([(A[2], at(100))], "device_id string, written_at timestamp")
    assert rows(last_seen_writes(seen(spark, [0, 120, 159, 160, 219, 220]), stored), "written_at") == [(at(160),), (at(220),)]
    assert rows(last_written(seen(spark, [0, 120]), stored), "written_at") == []


def test_applied_to_devices(spark):
    devices = seed_tables(spark)["devices"].where(f"id in ('{A[1]}', '{A[2]}')")
    history = telemetry(spark, [(A[2].upper(), {}, 0), (A[2], {}, 90), ("stranger", {}, 5)])
    after = apply_last_seen(devices, last_seen_writes(history))
    assert rows(after, "id", "last_seen_at") == [(A[1], None), (A[2], at(90))]
    later = apply_last_seen(after, last_seen_writes(seen(spark, [300])))
    assert rows(later, "id", "last_seen_at") == [(A[1], None), (A[2], at(300))]


def loop(times, gap, last=None):
    out = []
    for t in sorted(times):
        if last is None or t - last >= gap:
            out.append(t)
            last = t
    return out


def random_times(seed):
    """Devices of all kinds: busy ones that never pause, regular ones, ones with long silences."""
    rnd = random.Random(seed)
    times = {}
    for n in range(40):
        t, out = T0 + timedelta(seconds=rnd.uniform(0, 500)), []
        for _ in range(rnd.choice([1, 3, 60, 400])):
            t += timedelta(seconds=rnd.choice([5, 5, rnd.uniform(0, 8), rnd.uniform(0, 90), rnd.choice([60, 600, 7000])]))
            out.append(t)
        times[f"dev{n}"] = out
    times["busy"] = [T0 + timedelta(microseconds=rnd.randint(0, 90_000_000_000)) for _ in range(20_000)]
    times["clock"] = [T0 + timedelta(seconds=5 * n) for n in range(20_000)]
    times["old"] = [datetime(1900, 1, 1) + timedelta(seconds=7 * n) for n in range(50)]
    return times


@pytest.mark.parametrize("seed", [1, 2])
def test_writes_equal_a_loop(spark, seed):
    times = random_times(seed)
    rnd = random.Random(seed + 10)
    data = [(d, "s", "t", {}, t, t, n) for d, ts in times.items() for n, t in enumerate(ts)]
    rnd.shuffle(data)
    history = spark.createDataFrame(data, schemas.TELEMETRY).repartition(5)
    gap = timedelta(seconds=60)

    want = {d: loop(ts, gap) for d, ts in times.items()}
    got = last_seen_writes(history)
    assert rows(got, "device_id", "written_at") == sorted(((d, t) for d, ts in want.items() for t in ts), key=repr)
    assert rows(last_written(history), "device_id", "written_at") == sorted(((d, ts[-1]) for d, ts in want.items()), key=repr)

    stored = {d: T0 + timedelta(seconds=rnd.randint(-100, 20_000)) for d in list(times)[::2]}
    carry = spark.createDataFrame(list(stored.items()), "device_id string, written_at timestamp")
    want = [(d, t) for d, ts in times.items() for t in loop(ts, gap, stored.get(d))]
    assert rows(last_seen_writes(history, carry), "device_id", "written_at") == sorted(want, key=repr)


def test_small_arrow_batches(spark):
    times = {d: ts for d, ts in random_times(3).items() if d not in ("busy", "clock")}
    history = spark.createDataFrame([(d, "s", "t", {}, t, t, 0) for d, ts in times.items() for t in ts], schemas.TELEMETRY)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        got = rows(last_seen_writes(history), "device_id", "written_at")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted(((d, t) for d, ts in times.items() for t in loop(ts, timedelta(seconds=60))), key=repr)


def test_many_partitions_and_adaptive_joins(spark):
    """Order within devices must hold whatever joins and shuffles the optimizer settles on."""
    times = random_times(4)
    history = spark.createDataFrame([(d, "s", "t", {}, t, t, 0) for d, ts in times.items() for t in ts], schemas.TELEMETRY)
    want = sorted(((d, t) for d, ts in times.items() for t in loop(ts, timedelta(seconds=60))), key=repr)
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        # Planned as sort-merge joins, turned into broadcast joins with local reads while running.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert rows(last_seen_writes(history), "device_id", "written_at") == want
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_every_ordered_pass_has_a_shuffle_of_its_own(spark, capsys):
    """A repartition that the planner drops in favour of a join's shuffle could lose its order later."""
    last_seen_writes(seen(spark, [0, 5])).explain()
    plan = capsys.readouterr().out
    assert plan.count("REPARTITION_BY_COL") == plan.count("MapInPandas") == 3
