"""The read requests: lists, one device's telemetry, and the newest readings of every device."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.functions import arguments
from fleetwatch.functions.columns import canonical_id, instant_literal, parse_rfc3339

_DEVICE = ["id", "site_id", "name", "type", "last_seen_at"]
_POINT = ["device_id", "readings", "ts", "received_at"]
_RULE = ["id", "device_id", "metric", "operator", "threshold", "severity", "enabled"]


def _is(column: str, requested: str):
    """Equal ids, whatever the spelling of either."""
    return canonical_id(F.col(column)) == canonical_id(F.lit(requested))


def list_sites(sites: DataFrame) -> DataFrame:
    return sites.select("id", "name", "type", F.coalesce("location", F.lit("")).alias("location")).orderBy("name", "id")


def list_devices(devices: DataFrame, site_id: str | None = None) -> DataFrame:
    if site_id:
        devices = devices.where(_is("site_id", site_id))
    return devices.select(*_DEVICE).orderBy("name", "id")


def get_device(devices: DataFrame, device_id: str) -> DataFrame:
    """One row, or none when the device is unknown or the id malformed."""
    return devices.where(_is("id", device_id)).select(*_DEVICE)


def device_telemetry(
    telemetry: DataFrame, device_id: str, from_: str | None = None, to: str | None = None, limit=None
) -> DataFrame:
    """The newest readings of a device between two times, both included, oldest first.

    Times that are not RFC 3339 are ignored. On the laid-out table the bounds also prune days.
    """
    rows = telemetry.where(F.col("device_id") == device_id)
    at_type = telemetry.schema["ts"].dataType
    start, end = parse_rfc3339(from_), parse_rfc3339(to)
    if start:
        rows = rows.where(F.col("ts") >= instant_literal(start, at_type))
    if end:
        rows = rows.where(F.col("ts") <= instant_literal(end, at_type))
    if "ts_date" in telemetry.columns:
        if start:
            rows = rows.where(F.col("ts_date") >= F.lit(start.date()))
        if end:
            rows = rows.where(F.col("ts_date") <= F.lit(end.date()))
    newest = (
        rows.select(*_POINT, "seq")
        .orderBy(F.desc("ts"), F.desc("received_at"), F.desc("seq"))
        .limit(arguments.telemetry_limit(limit))
    )
    return newest.orderBy("ts", "received_at", "seq").select(*_POINT)


def latest_telemetry(telemetry: DataFrame, limit: int = arguments.TELEMETRY_DEFAULT) -> DataFrame:
    """The newest `limit` readings of every device in one job, any number from 1 on.

    The rank filter runs once before the shuffle, so a busy device sends at most `limit` rows per
    input task.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    newest = Window.partitionBy("device_id").orderBy(F.desc("ts"), F.desc("received_at"), F.desc("seq"))
    return (
        telemetry.select(*_POINT, "seq")
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= limit)
        .select(*_POINT, "seq")
    )


def list_alerts(
    alerts: DataFrame,
    devices: DataFrame,
    site_id: str | None = None,
    status: str | None = None,
    device_id: str | None = None,
    limit=None,
    offset=None,
) -> DataFrame:
    """Newest alerts first, one page. Devices are joined only when a site is asked for."""
    rows = alerts
    if site_id:
        of_site = devices.where(_is("site_id", site_id)).select(canonical_id(F.col("id")).alias("_device"))
        rows = rows.join(of_site, canonical_id(F.col("device_id")) == F.col("_device"))
    if status:
        rows = rows.where(F.col("status") == status)
    if device_id:
        rows = rows.where(_is("device_id", device_id))
    skip = arguments.page_argument(offset, arguments.OFFSET_DEFAULT, arguments.OFFSET_MAX)
    size = arguments.page_argument(limit, arguments.ALERTS_DEFAULT, arguments.ALERTS_MAX)
    return rows.select(*alerts.columns).orderBy(F.desc("triggered_at"), F.desc("id")).offset(skip).limit(size)


def list_rules(rules: DataFrame, device_id: str | None = None) -> DataFrame:
    """Rules by metric, disabled ones included."""
    if device_id:
        rules = rules.where(_is("device_id", device_id))
    return rules.select(*_RULE).orderBy("metric", "id")
