import random

import pytest
from fixtures import A, RULE, T0, USER, alert, at, rows, seed_tables

from fleetwatch import schemas
from fleetwatch.operators.commands import apply_alert_commands

IDS = [f"e0000000-0000-0000-0000-{n:012d}" for n in range(60)]
OTHER = "e9999999-0000-0000-0000-000000000000"


def run(spark, alerts, cmds):
    return apply_alert_commands(
        spark.createDataFrame(alerts, schemas.ALERTS),
        seed_tables(spark)["users"],
        spark.createDataFrame(cmds, schemas.ALERT_COMMANDS),
    )


def test_acknowledge_twice_then_resolve(spark):
    cmds = [(1, at(1), "acknowledge", IDS[0], USER), (2, at(2), "acknowledge", IDS[0], USER), (3, at(3), "resolve", IDS[0].upper(), USER.upper())]
    alerts, outcomes = run(spark, [alert(IDS[0], RULE[1], value=29.5)], cmds)
    assert rows(outcomes, "cmd_id", "outcome") == [(1, "ok"), (2, "conflict"), (3, "ok")]
    row = alerts.first()
    assert (row.status, row.acknowledged_at, row.acknowledged_by, row.resolved_at, row.resolved_by) == (
        "resolved", at(1), USER, at(3), USER,
    )


def test_precedence_of_outcomes(spark):
    alerts = [alert(IDS[0], RULE[1]), alert(IDS[1], RULE[2], "acknowledged"), alert(IDS[2], RULE[3], "resolved")]
    cases = [
        ("acknowledge", OTHER, None, "bad_request"),
        ("acknowledge", IDS[0], "", "bad_request"),
        ("acknowledge", "no id", None, "bad_request"),
        ("acknowledge", "no id", USER, "invalid_id"),
        ("acknowledge", OTHER, "nobody", "invalid_id"),
        ("acknowledge", OTHER, USER, "not_found"),
        ("acknowledge", OTHER, OTHER, "not_found"),
        ("acknowledge", IDS[1], USER, "conflict"),
        ("acknowledge", IDS[1], OTHER, "conflict"),
        ("resolve", IDS[2], OTHER, "conflict"),
        ("resolve", IDS[0], OTHER, "invalid_user"),
        ("acknowledge", IDS[0], OTHER, "invalid_user"),
        ("resolve", IDS[1], USER, "ok"),
        ("acknowledge", IDS[0], USER, "ok"),
    ]
    _, outcomes = run(spark, alerts, [(n, at(n), a, i, u) for n, (a, i, u, _) in enumerate(cases)])
    by_number = sorted((r.cmd_id, r.outcome) for r in outcomes.collect())
    assert by_number == [(n, c[3]) for n, c in enumerate(cases)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_sequential_application(spark, seed):
    rnd = random.Random(seed)
    initial = [alert(i, RULE[1], rnd.choice(["open", "open", "acknowledged", "resolved"])) for i in IDS]
    cmds = [
        # A third of all commands address one alert, and many come at the same time.
        (n, at(rnd.randint(0, 200)), rnd.choice(["acknowledge", "resolve"]), IDS[0] if rnd.random() < 0.3 else rnd.choice([*IDS, OTHER]),
         rnd.choice([USER, USER, OTHER, None]))
        for n in range(500)
    ]
    state = {a[0]: dict(zip(schemas.ALERTS.names, a)) for a in initial}
    want = []
    for n, when, action, target, user in sorted(cmds, key=lambda c: (c[1], c[0])):
        row = state.get(target)
        allowed = ["open"] if action == "acknowledge" else ["open", "acknowledged"]
        if not user:
            want.append((n, "bad_request"))
        elif row is None:
            want.append((n, "not_found"))
        elif row["status"] not in allowed:
            want.append((n, "conflict"))
        elif user != USER:
            want.append((n, "invalid_user"))
        else:
            want.append((n, "ok"))
            done = "acknowledged" if action == "acknowledge" else "resolved"
            row.update({"status": done, f"{done}_at": when, f"{done}_by": user})
    alerts, outcomes = run(spark, initial, cmds)
    assert rows(outcomes, "cmd_id", "outcome") == sorted(want, key=repr)
    names = schemas.ALERTS.names
    assert rows(alerts, *names) == sorted((tuple(r[c] for c in names) for r in state.values()), key=repr)
