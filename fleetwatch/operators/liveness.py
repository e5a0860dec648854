"""Debounced last-seen times of devices.

A device's last-seen time is written on its first message and then whenever a message arrives at
least `gap` after the last *written* time. That is a sequential rule, but the message after a
written one depends on that one alone. So each stretch of a device's history is summed up as a
step function: given the time from which a write is due, which write is the stretch's last? These
functions chain. They are first composed into longer blocks, then one pass over a device's blocks,
and one over each block's stretches, tells every stretch when its first write is due; the writes
within all stretches follow independently. No task holds more than one stretch of messages of a
device, or reads more than one summary per block of it.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions.columns import canonical_id, micros

# The functions below travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GAP_SECONDS = 60
# Lengths of a stretch and of a block of stretches, in gaps.
STRETCH_GAPS, BLOCK_GAPS = 30, 1440

# Stands for "a write is due at once"; and, as the number of a row, for the start of a group.
_AT_ONCE = -(2**62)
_HEADER = -(2**62)

_STEPS = "entries array<long>, exits array<long>"


def last_seen_writes(
    telemetry: DataFrame, carry_in: DataFrame | None = None, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Every last-seen write, as (device_id, written_at). `carry_in` holds earlier last writes."""
    stretches = _stretches(telemetry, carry_in, gap_seconds)
    due = _due(_steps(stretches, gap_seconds), gap_seconds)
    gap = gap_seconds * 1_000_000

    @F.pandas_udf("array<long>")
    def writes(times: pd.Series, due: pd.Series) -> pd.Series:
        return _writes(times, due.to_numpy(), gap)

    return _in_time(
        stretches.join(due, ["device_id", "stretch"]).select(
            "device_id", F.explode(writes("times", "due")).alias("written_at")
        ),
        telemetry,
    )


def last_written(
    telemetry: DataFrame, carry_in: DataFrame | None = None, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Only the last write per device, from the summaries alone."""
    steps = _steps(_stretches(telemetry, carry_in, gap_seconds), gap_seconds)
    blocks = _blocks(steps, gap_seconds)
    last = _walk(blocks, "block", gap_seconds).groupBy("device_id").agg(F.max("last").alias("written_at"))
    return _in_time(last, telemetry)


def apply_last_seen(devices: DataFrame, writes: DataFrame) -> DataFrame:
    """Devices with their newest written time. Writes of unknown devices match nothing."""
    newest = writes.groupBy(canonical_id(F.col("device_id")).alias("_device")).agg(F.max("written_at").alias("_at"))
    return (
        devices.join(newest, canonical_id(F.col("id")) == F.col("_device"), "left")
        .withColumn("last_seen_at", F.coalesce("_at", "last_seen_at"))
        .select(*devices.columns)
    )


def _in_time(rows: DataFrame, telemetry: DataFrame) -> DataFrame:
    kind = telemetry.schema["received_at"].dataType
    return rows.select("device_id", F.timestamp_micros("written_at").cast(kind).alias("written_at"))


def _stretches(telemetry: DataFrame, carry_in: DataFrame | None, gap_seconds: int) -> DataFrame:
    """Sorted distinct times per device and stretch, in microseconds."""
    rows = telemetry.select("device_id", micros(F.col("received_at")).alias("at"))
    rows = rows.where("device_id IS NOT NULL AND at IS NOT NULL")
    if carry_in is not None:
        # Nothing is due until a gap after the stored write; from then on it no longer matters.
        stored = carry_in.select("device_id", micros(F.col("written_at")).alias("_stored"))
        rows = (
            rows.join(stored, "device_id", "left")
            .where(F.col("_stored").isNull() | (F.col("at") >= F.col("_stored") + gap_seconds * 1_000_000))
            .drop("_stored")
        )
    width = gap_seconds * 1_000_000 * STRETCH_GAPS
    return (
        rows.withColumn("stretch", ((F.col("at") - F.pmod("at", F.lit(width))) / F.lit(width)).cast("long"))
        # The joins to come ask for this too; said here, all uses of the stretches share one shuffle.
        .where("stretch IS NOT NULL")
        .groupBy("device_id", "stretch")
        .agg(F.sort_array(F.collect_set("at")).alias("times"))
    )


def _steps(stretches: DataFrame, gap_seconds: int) -> DataFrame:
    gap = gap_seconds * 1_000_000

    @F.pandas_udf(_STEPS)
    def steps(times: pd.Series) -> pd.DataFrame:
        return _step_functions(times, gap)

    return stretches.withColumn("_s", steps("times")).select("device_id", "stretch", "_s.*")


def _blocks(steps: DataFrame, gap_seconds: int) -> DataFrame:
    """One step function per device and block, composed from those of its stretches."""
    gap = gap_seconds * 1_000_000

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, None
        for pdf in batches:
            done = []
            for device, block, entries, exits in zip(pdf.device_id, pdf.block, pdf.entries, pdf.exits):
                if (device, block) == key:
                    held = _compose(held, (entries, exits), gap)
                else:
                    if key is not None:
                        done.append((*key, *held))
                    key, held = (device, block), (entries, exits)
            yield pd.DataFrame(done, columns=["device_id", "block", "entries", "exits"])
        if key is not None:
            yield pd.DataFrame([(*key, *held)], columns=["device_id", "block", "entries", "exits"])

    return (
        _with_block(steps)
        .repartition("device_id", "block")
        .sortWithinPartitions("device_id", "block", "stretch")
        .select("device_id", "block", "entries", "exits")
        .mapInPandas(compose, f"device_id string, block long, {_STEPS}")
    )


def _with_block(steps: DataFrame) -> DataFrame:
    return steps.withColumn("block", F.floor(F.col("stretch") / F.lit(BLOCK_GAPS // STRETCH_GAPS)).cast("long"))


def _walk(steps: DataFrame, unit: str, gap_seconds: int, group: str | None = None) -> DataFrame:
    """Follows the step functions of each device (and group) in time order.

    Adds `due`, the time from which a write is due when the unit begins, and `last`, the last
    write when it has passed. The state between rows is one number. A group may open with a header
    row, which tells when its first write is due.

    The input must come from a union or a Python function, never straight from a join: only then
    is the shuffle asked for here really made and kept.
    """
    gap = gap_seconds * 1_000_000
    keys = ["device_id"] + ([group] if group else [])
    out = keys + [unit, "due", "last"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, due = None, _AT_ONCE
        for pdf in batches:
            rows = []
            for *this, number, entries, exits in zip(*[pdf[k] for k in keys], pdf[unit], pdf.entries, pdf.exits):
                if this != key:
                    key, due = this, _AT_ONCE
                if number == _HEADER:
                    due = int(entries[0])
                    continue
                at = 0 if due <= entries[0] else int(entries.searchsorted(due))
                last = int(exits[at]) if at < len(exits) else due - gap
                rows.append((*this, number, due, last))
                due = last + gap
            yield pd.DataFrame(rows, columns=out)

    fields = ["device_id string"] + ([f"{group} long"] if group else []) + [f"{unit} long", "due long", "last long"]
    return (
        steps.repartition(*keys)
        .sortWithinPartitions(*keys, unit)
        .select(*keys, unit, "entries", "exits")
        .mapInPandas(walk, ", ".join(fields))
    )


def _due(steps: DataFrame, gap_seconds: int) -> DataFrame:
    """When the first write of each stretch is due."""
    headers = _walk(_blocks(steps, gap_seconds), "block", gap_seconds).select(
        "device_id",
        F.lit(_HEADER).alias("stretch"),
        F.array("due").alias("entries"),
        F.array().cast("array<long>").alias("exits"),
        "block",
    )
    return _walk(_with_block(steps).unionByName(headers), "stretch", gap_seconds, "block").select(
        "device_id", "stretch", "due"
    )


def _flat(times: pd.Series, gap: int):
    """All arrays of a batch in one, kept apart by offsets, with the follower of each time.

    The follower is the first time at least a gap later in the same array, if there is one.
    """
    sizes = times.map(len).to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.concatenate([np.asarray(t, dtype=np.int64) for t in times]) if len(sizes) else np.zeros(0, np.int64)
    width = gap * STRETCH_GAPS
    origin = np.floor_divide(at, width) * width
    spread = at - origin + owner * (2 * width)
    follower = np.searchsorted(spread, spread + gap)
    has = follower < (starts + sizes)[owner]
    return at, at - origin, owner, starts, np.where(has, follower, -1)


def _step_functions(times: pd.Series, gap: int) -> pd.DataFrame:
    """Per array: the times at which the stretch can be entered, and the last write each leads to.

    The first write is at most a gap into the stretch, or else the first message after that. Of
    the entries with the same last write only the latest is kept.
    """
    at, offset, owner, starts, follower = _flat(times, gap)
    late = offset >= gap
    first_late = late & ~np.concatenate([[False], late[:-1] & (owner[1:] == owner[:-1])]) if len(at) else late
    entry = np.flatnonzero(~late | first_late)
    exit_ = entry.copy()
    while True:
        onward = follower[exit_]
        if not (onward >= 0).any():
            break
        exit_ = np.where(onward >= 0, onward, exit_)
    keep = np.ones(len(entry), dtype=bool)
    keep[:-1] = exit_[:-1] != exit_[1:]
    entry, exit_ = entry[keep], exit_[keep]
    bounds = np.searchsorted(owner[entry], np.arange(1, len(starts)))
    return pd.DataFrame({"entries": np.split(at[entry], bounds), "exits": np.split(at[exit_], bounds)})


def _compose(first, second, gap: int):
    """The step function of two neighbouring spans, the earlier one given first."""
    (entries, exits), (entries2, exits2) = first, second
    if exits.max() + gap <= entries2[0]:
        # After a pause, whatever came before leads to the same write.
        return entries2[:1], exits2[:1]
    onward = np.searchsorted(entries2, exits + gap)
    through = np.where(onward < len(exits2), exits2[np.minimum(onward, len(exits2) - 1)], exits)
    # A write may also be due only after the earlier span has ended.
    entries = np.append(entries, entries2[0])
    through = np.append(through, exits2[0])
    keep = np.append(through[:-1] != through[1:], True)
    return entries[keep], through[keep]


def _writes(times: pd.Series, due: np.ndarray, gap: int) -> pd.Series:
    """The written times of each stretch, given from when the first write is due."""
    at, offset, owner, starts, follower = _flat(times, gap)
    width = gap * STRETCH_GAPS
    # Where each array's first write is due, on the common scale of all arrays.
    origin = at[starts] - offset[starts]
    lanes = np.arange(len(starts)) * (2 * width)
    first = np.searchsorted(offset + owner * (2 * width), np.clip(due - origin, 0, width) + lanes)
    bounds = np.append(starts[1:], len(at))
    current = first[first < bounds]
    written = np.zeros(len(at), dtype=bool)
    while len(current):
        written[current] = True
        current = follower[current]
        current = current[current >= 0]
    return pd.Series([t[w] for t, w in zip(np.split(at, bounds[:-1]), np.split(written, bounds[:-1]))], index=times.index)
