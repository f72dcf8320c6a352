"""Column expressions shared by batch jobs and streams. No Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickwork.schemas import CONFIDENCE_THRESHOLD, HIGH, LOW, TIME_LEVELS


def pct_change(new: Column, base: Column) -> Column:
    """``(new - base) / base * 100``; NULL where the base is NULL or zero."""
    return F.when(base.isNotNull() & (base != 0), (new - base) / base * 100)


def log_return(new: Column, prev: Column) -> Column:
    """``ln(new / prev)``; NULL unless both are positive."""
    return F.when((prev > 0) & (new > 0), F.log(new / prev))


def spread(high: Column, low: Column) -> Column:
    return high - low


def epoch_ms(ms: Column, whole_seconds: bool = False) -> Column:
    """Epoch milliseconds to a timestamp, optionally cut to whole seconds."""
    ts = F.timestamp_millis(ms)
    return F.date_trunc("second", ts) if whole_seconds else ts


def minute_of(ts: Column) -> Column:
    """The minute a row belongs to, keeping the input's timestamp type."""
    return F.window(ts, "1 minute")["start"]


def time_parts(ts: Column, levels=tuple(TIME_LEVELS)) -> list[Column]:
    """Zero-padded string partition columns, coarse to fine."""
    return [F.date_format(ts, TIME_LEVELS[level]).alias(level) for level in levels]


def predicted_price(price: Column, predicted_return: Column) -> Column:
    return price * (1 + predicted_return / 100)


def confidence(predicted_return: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    return F.when(F.abs(predicted_return) > threshold, F.lit(HIGH)).otherwise(F.lit(LOW))


def direction_hit(predicted: Column, actual: Column) -> Column:
    """True only where both moved the same way; a flat outcome is a miss."""
    return predicted * actual > 0


def direction(change: Column) -> Column:
    """``up``, ``down`` or ``flat``; NULL stays NULL."""
    return (
        F.when(change > 0, F.lit("up"))
        .when(change < 0, F.lit("down"))
        .when(change == 0, F.lit("flat"))
    )


def split_list(text: Column, upper: bool = False) -> Column:
    """A comma list to an array of trimmed, non-empty names."""
    names = F.transform(F.split(text, ","), lambda s: F.trim(s))
    names = F.filter(names, lambda s: s != "")
    return F.transform(names, lambda s: F.upper(s)) if upper else names


def stream_name(symbol: Column, stream: Column) -> Column:
    """``lower(symbol)@stream``."""
    return F.concat(F.lower(symbol), F.lit("@"), stream)


def sequence_key(ts: Column, tie: Column) -> Column:
    """One sortable fixed-width number for ``(ts, tie)``.

    ``min_by``/``max_by`` over a struct key fall back to a sort-based aggregate;
    over a decimal they stay in the hash aggregate, on both sides of the shuffle.
    A missing ``tie`` counts as 0, so that its row still takes part.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    wide = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    return ((micros * wide).cast("decimal(37,0)") + F.coalesce(tie.cast("decimal(19,0)"), F.lit(0))).cast(
        "decimal(38,0)"
    )
