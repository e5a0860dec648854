"""Integrity and contract checks. Each returns the rows that break a rule; none changes data."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch import schemas
from fleetwatch.functions.columns import canonical_id, is_active

# Which words each column admits.
DOMAINS = [
    ("sites", "type", schemas.SITE_TYPES),
    ("devices", "type", schemas.DEVICE_TYPES),
    ("alert_rules", "operator", schemas.OPERATORS),
    ("alert_rules", "severity", schemas.SEVERITIES),
    ("alerts", "severity", schemas.SEVERITIES),
    ("alerts", "status", schemas.STATUSES),
    ("users", "role", schemas.ROLES),
]

# Child table and column, and the parent they point to.
FOREIGN_KEYS = [
    ("devices", "site_id", "sites"),
    ("alert_rules", "device_id", "devices"),
    ("alerts", "alert_rule_id", "alert_rules"),
    ("alerts", "device_id", "devices"),
    ("alerts", "acknowledged_by", "users"),
    ("alerts", "resolved_by", "users"),
]

# A parent row with rows in these places must not be deleted.
RESTRICTED = [key for key in FOREIGN_KEYS if key[2] != "users"]

# Columns without repeats.
UNIQUE = [(name, "id") for name in schemas.TABLES] + [("users", "email")]

Tables = dict[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _violation(rows: DataFrame, check: str, table: str, key: Column, detail: Column) -> DataFrame:
    return rows.select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        key.cast("string").alias("row_key"),
        detail.cast("string").alias("detail"),
    )


def _labelled(column: str, value: Column) -> Column:
    return F.concat(F.lit(f"{column}="), value.cast("string"))


def _by_table(listed: list[tuple]) -> dict[str, list[tuple]]:
    found: dict[str, list[tuple]] = {}
    for table, *rest in listed:
        found.setdefault(table, []).append(tuple(rest))
    return found


def _found(rows: DataFrame, *columns: Column) -> DataFrame:
    """One row per non-null text among the columns of a row, in one pass."""
    return rows.select("id", F.explode(F.filter(F.array(*columns), lambda x: x.isNotNull())).alias("_detail"))


def check_domains(tables: Tables) -> DataFrame:
    """One pass per table, one row per value that its column does not admit."""
    parts = []
    for t, checks in _by_table(DOMAINS).items():
        odd = [F.when(~F.col(c).isin(words), _labelled(c, F.col(c))) for c, words in checks]
        parts.append(_violation(_found(tables[t], *odd), "allowed_values", t, F.col("id"), F.col("_detail")))
    return _union(parts)


def check_foreign_keys(tables: Tables) -> DataFrame:
    """References to rows that do not exist; a null reference is fine.

    Each child table is read once and its references join each parent once.
    """
    parts = []
    for t, keys in _by_table(FOREIGN_KEYS).items():
        by_parent = _by_table([(parent, c) for c, parent in keys])
        for parent, columns in by_parent.items():
            refs = F.filter(
                F.array(*[F.struct(F.lit(c).alias("c"), canonical_id(F.col(c)).alias("ref")) for (c,) in columns]),
                lambda x: x["ref"].isNotNull(),
            )
            children = tables[t].select("id", F.inline(refs))
            known = tables[parent].select(canonical_id(F.col("id")).alias("ref"))
            orphans = children.join(known, "ref", "left_anti")
            parts.append(_violation(orphans, "foreign_key", t, F.col("id"), F.concat("c", F.lit("="), "ref")))
    return _union(parts)


def blocked_deletes(tables: Tables) -> DataFrame:
    """Parents that cannot be deleted because others depend on them."""
    parts = []
    for t, c, parent in RESTRICTED:
        # Reduced to one row per parent before the join, whatever the number of dependants.
        needed = tables[t].select(canonical_id(F.col(c)).alias("_ref")).distinct()
        held = tables[parent].select("id", canonical_id(F.col("id")).alias("_ref")).join(needed, "_ref", "left_semi")
        parts.append(_violation(held, "blocked_delete", parent, F.col("id"), F.lit(f"{t}.{c}")))
    return _union(parts)


def remove_users(alerts: DataFrame, removed: DataFrame) -> DataFrame:
    """The alerts after users are removed: history stays, references to them become null."""
    for column in ("acknowledged_by", "resolved_by"):
        leaving = removed.select(canonical_id(F.col("id")).alias("_user")).distinct().withColumn("_left", F.lit(True))
        alerts = (
            alerts.join(leaving, canonical_id(F.col(column)) == F.col("_user"), "left")
            .withColumn(column, F.when(F.col("_left").isNull(), F.col(column)))
            .drop("_user", "_left")
        )
    return alerts


def check_unique(tables: Tables) -> DataFrame:
    return _union(
        [
            _violation(
                tables[t].where(F.col(c).isNotNull()).groupBy((canonical_id(F.col(c)) if c == "id" else F.col(c)).alias(c)).agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                "unique",
                t,
                F.col(c),
                F.concat(F.lit(f"{c} x "), F.col("n").cast("string")),
            )
            for t, c in UNIQUE
        ]
    )


def check_not_null(tables: Tables) -> DataFrame:
    """One pass per table, one row per null found."""
    parts = []
    for t, columns in schemas.NOT_NULL.items():
        nulls = _found(tables[t], *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
        parts.append(_violation(nulls, "not_null", t, F.col("id"), F.col("_detail")))
    return _union(parts)


def check_single_active(alerts: DataFrame) -> DataFrame:
    several = (
        alerts.where(is_active(F.col("status")))
        .groupBy("alert_rule_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return _violation(several, "single_active", "alerts", F.col("alert_rule_id"), _labelled("active", F.col("n")))


def check_integrity(tables: Tables) -> DataFrame:
    """All checks on the stored tables together."""
    return _union(
        [
            check_domains(tables),
            check_foreign_keys(tables),
            check_unique(tables),
            check_not_null(tables),
            check_single_active(tables["alerts"]),
        ]
    )


def table_counts(tables: Tables) -> DataFrame:
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def _literal_map(entries: dict, value) -> Column:
    return F.create_map(*[c for k, v in entries.items() for c in (F.lit(k), value(v))])


def check_reading_keys(telemetry: DataFrame, contract: dict[str, list[str]] = schemas.READING_KEYS) -> DataFrame:
    """Readings whose metrics are not exactly those of the device type. Unknown types count too."""
    expected = F.try_element_at(
        _literal_map(contract, lambda keys: F.array(*[F.lit(k) for k in sorted(keys)])), F.col("device_type")
    )
    found = F.array_sort(F.map_keys("readings"))
    return telemetry.where(~F.coalesce(found == expected, F.lit(False))).select(
        F.lit("reading_keys").alias("check_name"),
        F.lit("telemetry_raw").alias("table_name"),
        F.concat_ws("|", "device_id", F.col("seq").cast("string")).alias("row_key"),
        F.concat(F.coalesce("device_type", F.lit("")), F.lit(": "), F.array_join(found, ",")).alias("detail"),
    )


def check_reading_bounds(
    telemetry: DataFrame, bounds: dict[str, tuple[float, float]] = schemas.READING_BOUNDS
) -> DataFrame:
    """Single values outside the documented range of their metric; NaN is outside any range."""
    low = F.try_element_at(_literal_map(bounds, lambda b: F.lit(float(b[0]))), F.col("metric"))
    high = F.try_element_at(_literal_map(bounds, lambda b: F.lit(float(b[1]))), F.col("metric"))
    value = F.col("value")
    return (
        telemetry.select("device_id", "seq", F.explode("readings").alias("metric", "value"))
        .where((value < low) | (value > high))
        .select(
            F.lit("reading_bounds").alias("check_name"),
            F.lit("telemetry_raw").alias("table_name"),
            F.concat_ws("|", "device_id", F.col("seq").cast("string")).alias("row_key"),
            F.col("metric").alias("detail"),
        )
    )
