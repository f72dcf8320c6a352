"""Row-based windows over series of any length.

A window partitioned by symbol alone gives one task the whole history of a
symbol, however long. Here a series is cut into calendar chunks and each chunk
also gets the exact rows it needs from its neighbours:

* ``with_halo`` copies the last ``before`` rows of the earlier chunks (and the
  first ``after`` rows of the later ones) into a chunk, marked ``_own = False``.
  Counts are by row, so gaps and nearly empty chunks are handled: a row may be
  copied into several chunks, at most ``before`` of them.
* Windows partitioned by ``(key, _chunk)`` then give the same values as windows
  over the whole series, and the copies are dropped.

The edge rows are found with ``row_number() <= n``, which Spark limits inside
each task before shuffling, so they cost a small shuffle. The rows themselves
are shuffled once, by ``(key, _chunk)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.session import materialise

CHUNK = "_chunk"
OWN = "_own"
# Candles of different widths are different series.
SERIES_KEYS = ["symbol", "interval"]
DEFAULT_CHUNK = "month"
_EPOCH = "0001-01-01 00:00:00"


def keys_of(rows: DataFrame) -> list[str]:
    """The columns that tell series apart: a table without an interval has one width."""
    return [c for c in SERIES_KEYS if c in rows.columns]


def chunk_of(time: str, unit: str = DEFAULT_CHUNK):
    """The calendar chunk of a row; rows without a time form the first one."""
    return F.coalesce(
        F.date_trunc(unit, F.col(time)).cast("timestamp_ntz"), F.lit(_EPOCH).cast("timestamp_ntz")
    )


def attach(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Adds the columns of a per-key table; a NULL key matches itself."""
    renamed = small.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    )
    return rows.join(renamed, match, how).drop(*[f"_key_{k}" for k in keys])


def _spill(rows: DataFrame, by: list[str], order: list[str], rows_needed: int, forward: bool):
    """Edge rows of every chunk, re-labelled with the chunks that need them."""
    keys = [*by, CHUNK]
    towards = (lambda c: F.col(c).desc_nulls_last()) if forward else (lambda c: F.col(c).asc_nulls_first())
    nearest = Window.partitionBy(*keys).orderBy(*[towards(c) for c in order])
    edge = rows.withColumn("_rank", F.row_number().over(nearest)).where(
        F.col("_rank") <= rows_needed
    )
    payload = [c for c in rows.columns if c not in (*keys, OWN)]
    # One line per chunk, holding at most rows_needed rows. Their number stands
    # for the chunk's: a chunk with rows_needed rows already fills a halo.
    chunks = edge.groupBy(*keys).agg(
        F.collect_list(F.struct("_rank", *payload)).alias("_rows"), F.max("_rank").alias("_n")
    )
    chunk_order = F.col(CHUNK).asc() if forward else F.col(CHUNK).desc()
    along = Window.partitionBy(*by).orderBy(chunk_order)
    passed = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.withColumn("_passed", F.coalesce(passed, F.lit(0)))
    ahead = F.collect_list(F.struct(F.col(CHUNK).alias("c"), F.col("_passed").alias("p")))
    lines = chunks.withColumn("_ahead", ahead.over(along.rowsBetween(1, rows_needed))).select(
        *by,
        (F.col("_passed") + F.col("_n")).alias("_end"),
        "_ahead",
        F.explode("_rows").alias("_row"),
    )
    # Distance to a later chunk: own rank plus the rows in the chunks between.
    wanted = F.filter(
        "_ahead", lambda x: F.col("_row._rank") + x["p"] - F.col("_end") <= rows_needed
    )
    target = F.explode(F.transform(wanted, lambda x: x["c"]))
    return lines.select(
        *by,
        *[F.col(f"_row.{c}").alias(c) for c in payload],
        target.alias(CHUNK),
        F.lit(False).alias(OWN),
    )


def _cut(rows: DataFrame, by: list[str], time: str, unit: str, long_rows: int | None):
    """Adds the chunk; with ``long_rows``, shorter series stay in one piece."""
    if long_rows is None:
        return rows.withColumn(CHUNK, chunk_of(time, unit))
    long = (
        rows.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > long_rows)
        .select(*by, F.lit(True).alias("_long"))
    )
    whole = F.lit(_EPOCH).cast("timestamp_ntz")
    chunk = F.when(F.col("_long"), chunk_of(time, unit)).otherwise(whole)
    return attach(rows, long, by, "left").withColumn(CHUNK, chunk).drop("_long")


def with_halo(
    rows: DataFrame,
    by: list[str],
    order: list[str],
    unit: str = DEFAULT_CHUNK,
    before: int = 0,
    after: int = 0,
    needed: list[str] | None = None,
    long_rows: int | None = None,
) -> DataFrame:
    """``rows`` plus neighbour copies, with ``_chunk`` and ``_own`` columns.

    ``order[0]`` is the time column. ``needed`` names the columns the windows
    read; in the copies the others are NULL, and not read from the source.

    A series with fewer than ``before`` rows per chunk has its rows copied
    several times over. Where many series are that thin, set ``long_rows``: one
    more count per key, and only series with more rows than that are cut.
    """
    home = _cut(rows, by, order[0], unit, long_rows).withColumn(OWN, F.lit(True))
    slim = home
    if needed is not None:
        keep = {*by, *order, *needed, CHUNK, OWN}
        slim = home.select(*[c for c in home.columns if c in keep])
    parts = [home]
    if before:
        parts.append(_spill(slim, by, order, before, forward=True))
    if after:
        parts.append(_spill(slim, by, order, after, forward=False))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def chunk_window(by: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*by, CHUNK).orderBy(*order)


def series_window(by: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*order)


def own_rows(rows: DataFrame) -> DataFrame:
    return rows.where(OWN).drop(CHUNK, OWN)


def recent_rows(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows per key; each task keeps at most ``n`` before the shuffle."""
    latest = Window.partitionBy(*by).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (
        rows.withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def latest_row(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return recent_rows(rows, by, order, 1)


def series_index(
    rows: DataFrame, by: str | list[str], order: list[str], unit: str = DEFAULT_CHUNK
) -> DataFrame:
    """Adds positions without a window over a whole series.

    ``series_pos`` and ``series_rows`` count within the key; ``table_pos`` and
    ``table_rows`` count in ``(key, order)`` order over the table. Counts per
    ``(key, chunk)`` are accumulated instead of rows; rows are only numbered
    inside their chunk. ``rows`` is read twice, so pass a stored table.
    """
    by = [by] if isinstance(by, str) else by
    home = rows.withColumn(CHUNK, chunk_of(order[0], unit))
    sizes = home.groupBy(*by, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    per_key = sizes.groupBy(*by).agg(F.sum("_n").alias("series_rows"))
    # One row per key from here on.
    over_keys = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    per_key = per_key.select(
        *by,
        "series_rows",
        F.coalesce(F.sum("series_rows").over(over_keys), F.lit(0)).alias("_key_start"),
        F.sum("series_rows").over(Window.partitionBy()).alias("table_rows"),
    )
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *by, CHUNK, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_chunk_start")
    )
    totals = ["series_rows", "_key_start", "table_rows"]
    starts = attach(starts, per_key, by).withColumn("_kind", F.lit(0))
    # The start of a chunk travels as its first row, so rows need no join.
    marked = home.withColumn("_kind", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    ordered = Window.partitionBy(*by, CHUNK).orderBy("_kind", *order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.select(
        *rows.columns,
        "_kind",
        (F.row_number().over(ordered) - 2).alias("_inside"),
        *[F.first(c).over(so_far).alias(c) for c in ("_chunk_start", *totals)],
    ).where(F.col("_kind") == 1)
    pos = F.col("_chunk_start") + F.col("_inside")
    return numbered.select(
        *rows.columns,
        pos.cast("bigint").alias("series_pos"),
        F.col("series_rows").cast("bigint").alias("series_rows"),
        (F.col("_key_start") + pos).cast("bigint").alias("table_pos"),
        F.col("table_rows").cast("bigint").alias("table_rows"),
    )


def running_totals(
    rows: DataFrame,
    by: list[str],
    order: list[str],
    totals: dict[str, Column],
    unit: str = DEFAULT_CHUNK,
) -> DataFrame:
    """Adds running sums over each series without a window over a whole series.

    Sums per ``(key, chunk)`` are accumulated; what a chunk starts with travels as
    its first row, so no join is needed. ``rows`` is read twice, so pass a
    stored table. Rows of equal ``order`` are taken in any order.
    """
    home = rows.select("*", *[c.alias(n) for n, c in totals.items()], chunk_of(order[0], unit).alias(CHUNK))
    sums = home.groupBy(*by, CHUNK).agg(*[F.sum(n).alias(n) for n in totals])
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *by, CHUNK, F.lit(0).alias("_kind"), *[F.sum(n).over(earlier).alias(n) for n in totals]
    )
    marked = home.withColumn("_kind", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*by, CHUNK).orderBy("_kind", *order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return marked.select(
        *rows.columns, "_kind", *[F.sum(n).over(so_far).alias(n) for n in totals]
    ).where(F.col("_kind") == 1).drop("_kind")


RANGE_SHIFT = 33


def ordered_totals(rows: DataFrame, order: list[Column], totals: dict[str, Column], name: str = "ordered") -> DataFrame:
    """Adds running sums over the whole table in ``order``, without one window over it.

    Rows are cut into ranges of the order and stored. A range's sums are one row, and
    the sums of the ranges before it are what its rows begin with; inside a range
    rows are summed by a window. Rows alike in ``order`` are taken by where they were
    read, so a large group of them is cut too. The result is a stored table.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.select("*", *[c.alias(n) for n, c in totals.items()]).withColumn("_read", F.monotonically_increasing_id())
    sort = [*order, F.col("_read")]
    cut = marked.repartitionByRange(width, *sort).sortWithinPartitions(*sort).drop("_read")
    # The number holds the range in its upper bits and the place in the range below.
    cut = materialise(cut.withColumn("_at", F.monotonically_increasing_id()), name)
    cut = cut.withColumn("_range", F.shiftright("_at", RANGE_SHIFT))
    sums = cut.groupBy("_range").agg(*[F.sum(n).alias(n) for n in totals])
    # One row for each range: as many as the shuffle has partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_start_{n}") for n in totals])
    so_far = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.select(*rows.columns, "_range", *[F.sum(n).over(so_far).alias(n) for n in totals])
    both = inside.join(F.broadcast(starts), "_range")
    done = both.select(*rows.columns, *[(F.col(n) + F.col(f"_start_{n}")).alias(n) for n in totals])
    return materialise(done, name)


def last_before(
    rows: DataFrame,
    marks: DataFrame,
    by: list[str],
    row_time: str,
    mark_time: str,
    name: str,
    unit: str | None = DEFAULT_CHUNK,
) -> DataFrame:
    """Adds struct column ``name``: the latest mark strictly before each row.

    An as-of join as a union and a running ``last``. Rows and marks are ordered
    inside ``(key, chunk)``; what a chunk inherits from earlier ones is one row,
    taken from per-chunk aggregates. With no ``unit`` a key is one window.
    """
    row_cols = [c for c in rows.columns if c not in by]
    mark_cols = [c for c in marks.columns if c not in by]
    left = rows.select(
        *by,
        F.col(row_time).alias("_t"),
        F.lit(0).alias("_kind"),
        F.struct(*row_cols).alias("_row"),
    )
    right = marks.select(
        *by,
        F.col(mark_time).alias("_t"),
        F.lit(1).alias("_kind"),
        F.struct(*mark_cols).alias("_mark"),
    )
    both = left.unionByName(right, allowMissingColumns=True)
    picked = [*by, *[F.col(f"_row.{c}").alias(c) for c in row_cols], F.col("_seen").alias(name)]

    def seen(rows: DataFrame, keys: list[str]) -> DataFrame:
        in_time = F.when(F.col("_kind") >= 0, F.col("_t")).asc_nulls_first()
        w = Window.partitionBy(*keys).orderBy(in_time, "_kind")
        earlier_rows = w.rowsBetween(Window.unboundedPreceding, -1)
        latest = F.last("_mark", ignorenulls=True).over(earlier_rows)
        return rows.withColumn("_seen", latest).where(F.col("_kind") == 0).select(*picked)

    if unit is None:
        return seen(both, by)
    both = both.withColumn(CHUNK, chunk_of("_t", unit))
    # Per chunk: that it has rows, and its last mark. Two small tables.
    present = left.select(*by, chunk_of("_t", unit).alias(CHUNK)).distinct()
    closing = right.groupBy(*by, chunk_of("_t", unit).alias(CHUNK)).agg(
        F.max_by("_mark", "_t").alias("_mark")
    )
    chunks = (
        present.unionByName(closing, allowMissingColumns=True)
        .groupBy(*by, CHUNK)
        .agg(F.first("_mark", ignorenulls=True).alias("_mark"))
    )
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inherited = chunks.select(
        *by,
        CHUNK,
        F.lit(-1).alias("_kind"),
        F.last("_mark", ignorenulls=True).over(earlier).alias("_mark"),
    ).where(F.col("_mark").isNotNull())
    return seen(both.unionByName(inherited, allowMissingColumns=True), [*by, CHUNK])
