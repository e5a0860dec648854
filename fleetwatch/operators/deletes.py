"""A batch of deletes across tables that refer to one another, in the order of their time and number.

A rule may go if no alert names it, a device if no alert names it and all its rules went earlier, a site if all its
devices went earlier; a user may always go, and alerts then forget them. So each level follows from the one below: a row
goes with its first delete behind the last of its dependants' own. That is a maximum over dependants and a minimum over
deletes; no task holds the requests of one row, or the dependants of one parent.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import canonical_id
from fleetwatch.operators.quality import remove_users

#: Tables whose rows can be deleted, each with its dependants (table, column): what must be gone first.
LEVELS = {
    "users": [],
    "alert_rules": [("alerts", "alert_rule_id")],
    "devices": [("alerts", "device_id"), ("alert_rules", "device_id")],
    "sites": [("devices", "site_id")],
}


def apply_deletes(tables: dict[str, DataFrame], deletes: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables afterwards, and one outcome per request.

    deletes: del_id, del_ts, table_name, row_id. Outcomes: bad_request (a table whose rows cannot be deleted), not_found
    (no such row, or it went earlier), conflict (a dependant is still there), ok. Alerts are never deleted. A null id
    names nothing.
    """
    asked = deletes.withColumns({"_row": canonical_id(F.col("row_id")), "_at": F.struct("del_ts", "del_id")})
    gone: dict[str, DataFrame] = {}
    for name, dependants in LEVELS.items():
        gone[name] = _gone(tables, asked.where(F.col("table_name") == name), name, dependants, gone)
    whole = None
    for name, rows in gone.items():
        marked = rows.withColumn("table_name", F.lit(name))
        whole = marked if whole is None else whole.unionByName(marked)
    late = F.coalesce(F.col("_when") < F.col("_at"), F.lit(False))
    outcome = (
        F.when(~F.coalesce(F.col("table_name").isin(list(LEVELS)), F.lit(False)), "bad_request")
        .when(F.col("_there").isNull() | late, "not_found")
        .when(F.coalesce(F.col("_when") == F.col("_at"), F.lit(False)), "ok")
        .otherwise("conflict")
    )
    judged = asked.join(whole, ["table_name", "_row"], "left").withColumn("outcome", outcome)
    after = dict(tables)
    for name, rows in gone.items():
        went = rows.where("_when IS NOT NULL").select(F.col("_row").alias("_gone"))
        after[name] = tables[name].join(went, canonical_id(F.col("id")) == F.col("_gone"), "left_anti")
    # Alerts forget the users that went.
    went = gone["users"].where("_when IS NOT NULL").select(F.col("_row").alias("id"))
    after["alerts"] = remove_users(tables["alerts"], went)
    return after, judged.select("del_id", "del_ts", "table_name", "row_id", "outcome")


def _gone(tables: dict[str, DataFrame], asked: DataFrame, name: str, dependants, gone: dict[str, DataFrame]) -> DataFrame:
    """_row, _there and _when (the place of the delete that took it, null if none did) of every row of a table."""
    rows = tables[name].select(canonical_id(F.col("id")).alias("_row")).distinct()
    for place, (table, column) in enumerate(dependants):
        children = tables[table].select(canonical_id(F.col("id")).alias("_child"), canonical_id(F.col(column)).alias("_row"))
        if table in gone:
            went = gone[table].select(F.col("_row").alias("_child"), "_when")
            children = children.join(went, "_child", "left")
        else:
            children = children.withColumn("_when", F.lit(None).cast(asked.schema["_at"].dataType))
        state = children.groupBy("_row").agg(F.max("_when").alias(f"_last_{place}"), F.bool_or(F.col("_when").isNull()).alias(f"_held_{place}"))
        rows = rows.join(state, "_row", "left")
    held, after = F.lit(False), F.lit(True)
    for place in range(len(dependants)):
        held = held | F.coalesce(f"_held_{place}", F.lit(False))
        after = after & (F.col(f"_last_{place}").isNull() | (F.col("_at") > F.col(f"_last_{place}")))
    met = asked.select("_row", "_at").join(rows, "_row").where(~held & after)
    first = met.groupBy("_row").agg(F.min("_at").alias("_when"))
    return rows.select("_row", F.lit(True).alias("_there")).join(first, "_row", "left")
