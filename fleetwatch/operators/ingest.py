"""Checks every incoming message and splits the stream into telemetry and rejects."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import filled, rfc3339

_FIELDS = "struct<device_id: variant, site_id: variant, device_type: variant, readings: variant, ts: variant>"
_TEXTS = "struct<device_id: string, site_id: string, device_type: string, ts: string>"
_IDS = ["device_id", "site_id", "device_type"]


def _kind(value: Column) -> Column:
    """Type name of a variant; a field that is absent counts like a JSON null."""
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _nothing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def _reading(value: Column) -> Column:
    """A finite number, zero for a JSON null, else null."""
    numeric = F.substring(F.schema_of_variant(value), 1, 3).isin("BIG", "DEC", "DOU", "FLO", "VOI")
    number = F.coalesce(F.try_variant_get(value, "$", "double"), F.lit(0.0))
    return F.when(numeric & (F.abs(number) < F.lit(float("inf"))), number)


def _decode(messages: DataFrame) -> DataFrame:
    """Adds `_message`, the typed fields, or null where the payload is not one fitting JSON object.

    The JSON reader ignores what follows the first value. Wrapped in brackets, anything but a
    closing bracket after the value is an error; wrapped in braces, anything but a closing brace.
    Passing both leaves no room for trailing text, and only a payload with a bracket of its own
    can pass the first test wrongly.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("payload"), F.lit("]")))
    nested = F.try_parse_json(F.concat(F.lit('{"m":'), F.col("payload"), F.lit("}")))
    alone = F.try_variant_get("_listed", "$[1]", "variant").isNull()
    strict = alone & (~F.col("payload").contains("]") | nested.isNotNull())

    kept = {c: F.col(f"_fields.{c}") for c in [*_IDS, "readings", "ts"]}
    year_one = F.lit("0001-01-01 00:00:00Z").cast("timestamp")
    ts = F.when(_nothing(kept["ts"]), year_one).when(
        _kind(kept["ts"]) == "STRING", rfc3339(F.col("_texts.ts"))
    )
    fit = F.col("_ts").isNotNull() & (
        _nothing(kept["readings"])
        | F.coalesce(F.forall(F.map_values("_readings"), lambda x: x.isNotNull()), F.lit(False))
    )
    for c in _IDS:
        fit = fit & _kind(kept[c]).isin("STRING", "VOID")
    message = F.struct(
        *[F.coalesce(F.col(f"_texts.{c}"), F.lit("")).alias(c) for c in _IDS],
        F.col("_readings").alias("readings"),
        F.col("_ts").alias("ts"),
    )
    # JSON null decodes to a message without any field.
    bare = F.struct(
        *[F.lit("").alias(c) for c in _IDS],
        F.lit(None).cast("map<string,double>").alias("readings"),
        year_one.alias("ts"),
    )
    return (
        messages.withColumn("_listed", listed)
        .withColumns(
            {
                "_strict": strict,
                "_bare": F.is_variant_null(F.try_variant_get("_listed", "$[0]", "variant")),
                "_fields": F.try_variant_get("_listed", "$[0]", _FIELDS),
                "_texts": F.try_variant_get("_listed", "$[0]", _TEXTS),
            }
        )
        .withColumns(
            {
                # A null reading decodes to zero, so it can break a lower bound.
                "_readings": F.transform_values(
                    F.try_variant_get(kept["readings"], "$", "map<string,variant>"), lambda _, x: _reading(x)
                ),
                "_ts": ts,
            }
        )
        .withColumn(
            "_message",
            F.when(
                F.col("_strict"),
                F.when(F.col("_bare"), bare).when(F.col("_fields").isNotNull() & fit, message),
            ),
        )
    )


#: Why a message is rejected, in the order of the checks.
REJECT_REASONS = ["bad_topic", "invalid_json", "missing_field", "empty_readings", "id_mismatch"]


def parse_messages(messages: DataFrame, topic_root: str) -> DataFrame:
    """Adds the decoded fields and `reject_reason`, null for accepted messages.

    The first failing check gives the reason: topic, JSON, required fields, readings, ids.
    Devices and metrics nobody registered are accepted.
    """
    parts = F.split("topic", "/")
    topic_ok = (
        (F.size(parts) == 4) & (F.get(parts, F.lit(0)) == topic_root) & (F.get(parts, F.lit(3)) == "telemetry")
    )
    m = "_message"
    complete = filled(F.col(f"{m}.device_id")) & filled(F.col(f"{m}.site_id")) & filled(F.col(f"{m}.device_type"))
    same_ids = (F.col(f"{m}.site_id") == F.get(parts, F.lit(1))) & (
        F.col(f"{m}.device_id") == F.get(parts, F.lit(2))
    )
    reason = (
        F.when(~F.coalesce(topic_ok, F.lit(False)), "bad_topic")
        .when(F.col(m).isNull(), "invalid_json")
        .when(~complete, "missing_field")
        .when(F.coalesce(F.size(f"{m}.readings"), F.lit(0)) <= 0, "empty_readings")
        .when(~same_ids, "id_mismatch")
    )
    result = F.struct(
        reason.alias("reject_reason"), *[F.col(f"{m}.{c}").alias(c) for c in [*_IDS, "readings", "ts"]]
    )
    spark = messages.sparkSession
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        raise ValueError("set spark.sql.variant.allowDuplicateKeys to true: of equal JSON keys the last one counts")
    # Generated columns keep a filter on the reason above the decoding, which then runs once per
    # message; pushed below, the filter would repeat it.
    return _decode(messages).select(*messages.columns, F.inline(F.array(result)))


def accepted(parsed: DataFrame) -> DataFrame:
    """Telemetry rows as they go into the store: the message plus the time of receipt."""
    return parsed.where(F.col("reject_reason").isNull()).select(
        "device_id", "site_id", "device_type", "readings", "ts", "received_at", "seq"
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Messages kept aside with the reason."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        "topic", "payload", "received_at", "seq", "reject_reason"
    )


def reject_counts(parsed: DataFrame) -> DataFrame:
    return rejects(parsed).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))
