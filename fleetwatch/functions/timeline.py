"""Looking back and ahead on a per-key timeline whose keys may be very unequal in size.

A plain window over the key would put all rows of a busy key into one task. Here each key is cut
into stretches of time. Windows run within a stretch; what crosses from one stretch to the next is
a single value per stretch, found by an aggregate that combines map-side. No task ever sees more
than one stretch of rows, or one row per stretch, of a key.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fleetwatch.functions.columns import micros, whole

STRETCH_SECONDS = 600
_BEFORE_ALL = -(2**62)
_STRETCH = "_stretch"


def stretch(at: Column, seconds: int) -> Column:
    """Number of the time stretch; rows without a time come before all others."""
    return F.coalesce(whole(micros(at), seconds * 1_000_000), F.lit(_BEFORE_ALL))


def nearest(
    rows: DataFrame,
    key: str,
    order: list[str],
    earlier: dict[str, Column] | None = None,
    later: dict[str, Column] | None = None,
    seconds: int = STRETCH_SECONDS,
) -> DataFrame:
    """Adds the nearest non-null values among the key's earlier and later rows.

    `order` starts with the time column and must order the rows of a key fully. All values wanted
    should be asked for in one call: it reads the rows twice, once to shuffle them and once for
    the aggregate.
    """
    earlier, later = earlier or {}, later or {}
    wanted = {f"_in_{name}": value for name, value in {**earlier, **later}.items()}
    rows = rows.withColumn(_STRETCH, stretch(F.col(order[0]), seconds))

    place = F.struct(*order)
    edges = rows.withColumns(wanted).groupBy(key, _STRETCH).agg(
        *[
            pick(f"_in_{name}", F.when(F.col(f"_in_{name}").isNotNull(), place)).alias(f"_in_{name}")
            for names, pick in ((earlier, F.max_by), (later, F.min_by))
            for name in names
        ]
    )
    up, down = F.col(_STRETCH).asc(), F.col(_STRETCH).desc()
    carried = edges.select(
        key,
        _STRETCH,
        *[_last(name, _before(key).orderBy(up)).alias(f"_out_{name}") for name in earlier],
        *[_last(name, _before(key).orderBy(down)).alias(f"_out_{name}") for name in later],
    )

    forward = _before(key, _STRETCH).orderBy(*[F.col(c).asc() for c in order])
    backward = _before(key, _STRETCH).orderBy(*[F.col(c).desc() for c in order])
    found = {
        name: F.coalesce(_last(name, window), F.col(f"_out_{name}"))
        for names, window in ((earlier, forward), (later, backward))
        for name in names
    }
    # The values wanted are built behind the shuffle, which carries only the rows' own columns.
    dealt = rows.repartition(key, _STRETCH).withColumns(wanted)
    joined = dealt.join(carried, [key, _STRETCH], "left").withColumns(found)
    return joined.drop(_STRETCH, *wanted, *[f"_out_{name}" for name in {**earlier, **later}])


def _before(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)


def _last(name: str, window: WindowSpec) -> Column:
    return F.last(f"_in_{name}", ignorenulls=True).over(window)
