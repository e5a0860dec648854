"""Column expressions shared by the operators."""

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetwatch.schemas import ACTIVE_STATUSES

# Fixed pattern: RFC 3339 with a zone; one-digit hours and a comma before the fraction also occur.
RFC3339 = (
    r"^([0-9]{4})-([0-9]{2})-([0-9]{2})T([0-9]{1,2}):([0-9]{2}):([0-9]{2})"
    r"(?:[.,]([0-9]+))?(Z|[+-](?:[01][0-9]|2[0-4]):(?:[0-5][0-9]|60))"
)


def breached(value: Column, operator: Column, threshold: Column) -> Column:
    """Does the value break the threshold? Unknown operators, nulls and NaN never do."""
    outcome = (
        F.when(operator == "gt", value > threshold)
        .when(operator == "gte", value >= threshold)
        .when(operator == "lt", value < threshold)
        .when(operator == "lte", value <= threshold)
        .otherwise(F.lit(False))
    )
    # Spark sorts NaN above every number; a comparison with NaN must be false instead.
    return F.coalesce(outcome & ~F.isnan(value) & ~F.isnan(threshold), F.lit(False))


def is_active(status: Column) -> Column:
    return status.isin(ACTIVE_STATUSES)


def instant(at: Column) -> Column:
    """The instant of a time column, the same in every session: a time without a zone is UTC."""
    return F.when(F.typeof(at) == "timestamp_ntz", F.timestamp_micros(_clock_micros(at))).otherwise(at.cast("timestamp"))


def micros(at: Column) -> Column:
    """Microseconds since 1970 of the instant."""
    return F.when(F.typeof(at) == "timestamp_ntz", _clock_micros(at)).otherwise(F.unix_micros(at.cast("timestamp")))


def _clock_micros(at: Column) -> Column:
    """Microseconds that a time without a zone lies after the start of 1970, by whole fields: no text, no zone."""
    since = at.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days, hours, minutes, seconds = (F.extract(F.lit(unit), since) for unit in ("DAY", "HOUR", "MINUTE", "SECOND"))
    return ((days.cast("long") * 24 + hours) * 60 + minutes) * 60_000_000 + (seconds * 1_000_000).cast("long")


def utc_date(at: Column) -> Column:
    """The UTC day of a time column, the same in every session."""
    return F.date_from_unix_date(whole(micros(at), 86_400_000_000).cast("int"))


def whole(number: Column, size: int) -> Column:
    """How many times `size` goes into a whole number, rounded down."""
    return F.call_function("div", number - F.pmod(number, F.lit(size)), F.lit(size))


def utc_clock(at: Column) -> Column:
    """What a UTC clock shows at the instant, as a time without a zone."""
    seconds = (micros(at).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def canonical_id(text: Column) -> Column:
    """One spelling for all spellings of an id: lower case, and a UUID with its four hyphens."""
    bare = F.replace(F.lower(text), F.lit("-"), F.lit(""))
    hex32 = F.length(text).between(32, 35) & bare.rlike("^[0-9a-f]{32}$")
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.when(hex32, F.concat_ws("-", *[F.substring(bare, a, n) for a, n in cuts])).otherwise(F.lower(text))


def alert_id(rule_id: Column, at: Column, seq: Column) -> Column:
    """The same reading always opens the alert under the same id, so a rerun adds nothing."""
    digest = F.sha2(F.concat_ws("|", rule_id, micros(at).cast("string"), seq.cast("string")), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def filled(text: Column) -> Column:
    """True for a text that is neither null nor empty."""
    return F.coalesce(text != "", F.lit(False))


def rfc3339(text: Column) -> Column:
    """The instant a full RFC 3339 text names, else null. Digits beyond microseconds are cut."""
    utc = text.endswith("Z")
    local = F.substr(text, F.lit(1), F.length(text) - F.when(utc, 1).otherwise(6))
    instant = F.translate(local, ",", ".").try_cast("timestamp_ntz")
    zone = F.right(text, F.lit(6))
    ahead = F.substr(zone, F.lit(2), F.lit(2)).try_cast("int") * 60 + F.right(zone, F.lit(2)).try_cast("int")
    back = F.when(zone.startswith("-"), ahead).otherwise(-ahead)
    instant = F.when(utc, instant).otherwise(F.timestamp_add("MINUTE", back, instant))
    return F.when(text.rlike(RFC3339 + r"\z"), F.concat(instant.cast("string"), F.lit("Z")).try_cast("timestamp"))


def parse_rfc3339(text: str | None) -> datetime | None:
    """The same rule for one request argument, as a naive UTC time; null when malformed."""
    found = re.fullmatch(RFC3339, text or "")
    if not found:
        return None
    *parts, fraction, zone = found.groups()
    try:
        at = datetime(*map(int, parts), microsecond=int((fraction or "0")[:6].ljust(6, "0")))
        if zone == "Z":
            return at
        ahead = timedelta(hours=int(zone[1:3]), minutes=int(zone[4:6]))
        return at + ahead if zone[0] == "-" else at - ahead
    except (ValueError, OverflowError):
        return None


def instant_literal(at: datetime, like) -> Column:
    """A time literal of the column's own type, so that the comparison reaches the file scan."""
    if at.tzinfo:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    zone = "Z" if like.typeName() == "timestamp" else ""
    return F.lit(at.isoformat(sep=" ") + zone).cast(like)
