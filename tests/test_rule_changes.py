import random

import pytest
from fixtures import A, RULE, T0, alert, at, rows, seed_tables

from fleetwatch import schemas
from fleetwatch.operators.rule_changes import apply_rule_changes

OTHER = "c9999999-0000-0000-0000-000000000000"
FIELDS = ["device_id", "metric", "operator", "threshold", "severity", "enabled"]


def run(spark, changes, alerts=()):
    tables = seed_tables(spark)
    data = [
        (n, at(c.pop("when", n)), c.get("action"), c.get("rule_id"), *[c.get(f) for f in FIELDS])
        for n, c in enumerate(map(dict, changes))
    ]
    return apply_rule_changes(
        tables["alert_rules"],
        tables["devices"],
        spark.createDataFrame(list(alerts), schemas.ALERTS),
        spark.createDataFrame(data, schemas.RULE_CHANGES),
    )


def outcomes(result):
    return [r.outcome for r in result[1].orderBy("chg_id").collect()]


FULL = dict(device_id=A[3], metric="humidity_pct", operator="gt", threshold=40.0, severity="critical")


def test_create_update_delete(spark):
    created, o = run(spark, [dict(FULL, action="create")])
    assert [r.outcome for r in o.collect()] == ["ok"]
    assert created.count() == 4
    new = created.where("metric = 'humidity_pct'").first()
    assert (new.threshold, new.enabled, new.device_id, len(new.id)) == (40.0, True, A[3], 36)
    change = dict(action="update", rule_id=RULE[3], metric="power_kw", operator="gte", threshold=45.0, severity="critical")
    updated = run(spark, [change])
    assert outcomes(updated) == ["ok"]
    assert rows(updated[0].where(f"id = '{RULE[3]}'"), *FIELDS) == [(A[1], "power_kw", "gte", 45.0, "critical", True)]
    gone = run(spark, [change, dict(action="delete", rule_id=RULE[3].upper()), change, dict(action="delete", rule_id=RULE[3])])
    assert outcomes(gone) == ["ok", "ok", "not_found", "not_found"]
    assert gone[0].count() == 2


def test_create_checks(spark):
    bad = [
        dict(FULL, device_id=None), dict(FULL, device_id=""), dict(FULL, device_id=OTHER), dict(FULL, metric=""),
        dict(FULL, operator="eq"), dict(FULL, operator=None), dict(FULL, severity="fatal"),
    ]
    fine = [dict(FULL, threshold=None), dict(FULL, enabled=False), dict(FULL, rule_id=RULE[1])]
    result = run(spark, [dict(c, action="create") for c in bad + fine])
    assert outcomes(result) == ["bad_request"] * 7 + ["ok"] * 3
    assert rows(result[0].where("metric = 'humidity_pct'"), "threshold", "enabled") == [(0.0, True), (40.0, False), (40.0, True)]


def test_update_replaces_everything(spark):
    result = run(spark, [
        dict(action="update", rule_id=RULE[1], operator="lt", severity="warning", device_id=A[3]),
        dict(action="update", rule_id=RULE[2], metric="m", operator="odd", severity="warning"),
        dict(action="update", rule_id=OTHER, operator="odd"),
        dict(action="update", rule_id="no id", operator="lt", severity="warning"),
    ])
    assert outcomes(result) == ["ok", "bad_request", "not_found", "invalid_id"]
    assert rows(result[0].where(f"id = '{RULE[1]}'"), *FIELDS) == [(A[2], "", "lt", 0.0, "warning", True)]


def test_referenced_rule_cannot_go(spark):
    result = run(spark, [dict(action="delete", rule_id=RULE[1]), dict(action="delete", rule_id=RULE[2])], [alert("x", RULE[1], "resolved")])
    assert outcomes(result) == ["conflict", "ok"]
    assert rows(result[0], "id") == [(RULE[1],), (RULE[3],)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_sequential_application(spark, seed):
    rnd = random.Random(seed)
    changes = [
        dict(
            when=rnd.randint(0, 100),
            action=rnd.choice(["update", "update", "update", "delete", "create"]) if rnd.random() < 0.9 else "update",
            rule_id=rnd.choice([RULE[1]] * 3 + [RULE[2], RULE[3], OTHER]),
            device_id=rnd.choice([A[1], A[2], OTHER, None]),
            metric=rnd.choice(["m", "n", None]),
            operator=rnd.choice(["gt", "lt", "lte", "odd"]),
            threshold=rnd.choice([None, 1.0, 2.0]),
            severity=rnd.choice(["warning", "critical", "critical", None]),
            enabled=rnd.choice([None, True, False]),
        )
        for _ in range(300)
    ]
    used = {RULE[2]}
    state = {
        RULE[1]: [A[2], "temperature_c", "gt", 28.0, "warning", True],
        RULE[2]: [A[2], "temperature_c", "gt", 32.0, "critical", True],
        RULE[3]: [A[1], "power_kw", "gt", 50.0, "warning", True],
    }
    created, want = [], {}
    for n, c in sorted(enumerate(changes), key=lambda e: (e[1]["when"], e[0])):
        words = c["operator"] in schemas.OPERATORS and c["severity"] in schemas.SEVERITIES
        image = [c["metric"] or "", c["operator"], c["threshold"] or 0.0, c["severity"], c["enabled"] is not False]
        rule = c["rule_id"]
        if c["action"] == "create":
            fine = words and c["metric"] and c["device_id"] in (A[1], A[2])
            want[n] = "ok" if fine else "bad_request"
            if fine:
                created.append([c["device_id"], *image])
        elif rule not in state:
            want[n] = "not_found"
        elif c["action"] == "delete":
            want[n] = "conflict" if rule in used else "ok"
            if rule not in used:
                del state[rule]
        else:
            want[n] = "ok" if words else "bad_request"
            if words:
                state[rule] = [state[rule][0], *image]
    result = run(spark, changes, [alert("x", RULE[2])])
    assert outcomes(result) == [want[n] for n in range(len(changes))]
    assert rows(result[0], *FIELDS) == sorted((tuple(r) for r in [*state.values(), *created]), key=repr)
