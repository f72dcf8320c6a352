"""Benchmark decontamination by a prefix-filtered set join, in DataFrame
operations only.

A window is ``size`` consecutive words of an item. It occurs in a document only
if all its shingles do, so joining one of them, the rarest, loses nothing: at a
containment of 1 the prefix has one token. A joined shingle gives the window's
place in the document; places that begin before or end after the document are
dropped, and the words there are compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import ascii_lower, with_rows
from wickwork.session import materialise

SIZE = 10
SHINGLE = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The windows are broadcast up to this size; beyond it shingles are shuffled.
BROADCAST_BYTES = 64 << 20


def word_list(text: Column) -> Column:
    """Lower-cased words; empty without any, as for a missing text."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(parts, "")


def _shingle_key(words: Column, at: Column, width: int) -> Column:
    """A number for ``width`` words from position ``at``; equal words, equal numbers."""
    return F.xxhash64(F.lit(width), *(F.get(words, at + i) for i in range(width)))


def _shingle_width(words: Column, shingle: int) -> Column:
    return F.least(F.size(words), F.lit(shingle))


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(win, window, item): every distinct window of every item, as words and as text."""
    words = items.select(F.col(id_col).alias("item"), word_list(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return (
        words.where(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("at"))
        .select("item", F.slice("w", F.col("at") + 1, size).alias("win"))
        .select("item", "win", F.concat_ws(" ", "win").alias("window"))
        .distinct()
    )


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, win, width, o, key): every shingle of every distinct window."""
    width = _shingle_width(F.col("win"), shingle)
    rows = windows.select("window", "win").distinct().withColumn("width", width)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.size("win") - F.col("width"))).alias("o"))
    key = F.coalesce(
        *(
            F.when(F.col("width") == n, _shingle_key(F.col("win"), F.col("o"), n))
            for n in range(1, shingle + 1)
        )
    )
    return rows.withColumn("key", key)


def _placed(docs: DataFrame, width: int) -> DataFrame:
    """(row, id, words, n, p, key): every position with the shingle of ``width`` from it.

    A document without words has one row with no position.
    """
    rows = docs.select("*", F.size("words").alias("n"), F.posexplode_outer("words").alias("p", "word"))
    return rows.withColumn(
        "key", F.when(F.col("p") + width <= F.col("n"), _shingle_key(F.col("words"), F.col("p"), width))
    )


def _fits(start: Column) -> Column:
    """Length and positional bounds, then the words themselves."""
    return (
        (start >= 0)
        & (start + F.size("win") <= F.col("n"))
        & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("win")) == F.col("win"))
    )


def _matches(docs: DataFrame, windows: DataFrame, shingle: int, limit: int) -> DataFrame:
    """(row, id, n, start, length, window): every place of a window, and for every
    document a row without a window."""
    shingles = materialise(_window_shingles(windows, shingle), "decontaminate-shingles")
    found = shingles.groupBy("width").agg(
        F.sum(F.length("window") * 2 + 40).alias("bytes")
    ).collect()  # at most one row for each shingle width
    small = sum(r.bytes for r in found) <= limit
    if not small:
        docs = materialise(docs, "decontaminate-words")
    start = F.col("p") - F.col("o")
    plain = docs.select(
        "row", "id", F.size("words").alias("n"), F.lit(None).cast("int").alias("start"),
        F.lit(None).cast("int").alias("length"), F.lit(None).cast("string").alias("window"),
    )
    if not found:
        return plain
    parts = [] if small else [plain]
    for number, width in enumerate(sorted(r.width for r in found)):
        own = shingles.where(F.col("width") == width)
        placed = _placed(docs, width)
        # How often a shingle stands in the documents decides which one a window is joined by.
        seen = placed.select("key").join(_maybe_broadcast(own.select("key").distinct(), small), "key")
        often = seen.groupBy("key").agg(F.count("*").alias("c"))
        rarest = (
            own.join(often, "key")
            .groupBy("window")
            .agg(
                F.min(F.struct("c", "key", "o")).alias("k"),
                F.first("win").alias("win"),
                F.count("*").alias("present"),
            )
            # A window with a shingle that no document has is in no document.
            .where(F.col("present") == F.size("win") - width + 1)
            .select("window", "win", "k.key", "k.o")
        )
        rarest = materialise(rarest, "decontaminate-prefix")
        out = ["row", "id", "n", start.alias("start"), F.size("win").alias("length"), "window"]
        if small:
            probe = _maybe_broadcast(rarest.withColumnRenamed("key", "k"), small)
            met = (F.col("key") == F.col("k")) & _fits(start)
            if number:
                parts.append(placed.join(probe, met).select(*out))
            else:
                both = placed.join(probe, met, "left")
                both = both.where(F.col("window").isNotNull() | F.col("p").isNull() | (F.col("p") == 0))
                parts.append(both.select(*out))
        else:
            slim = placed.select("row", "n", "p", "key").join(
                rarest.select("key", "o", "window", F.size("win").alias("length")), "key"
            )
            slim = slim.where((start >= 0) & (start + F.col("length") <= F.col("n")))
            near = slim.select("row", "p", "o", "window").join(docs, "row").withColumn("n", F.size("words"))
            near = near.withColumn("win", F.split("window", " "))
            parts.append(near.where(_fits(start)).select(*out))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SIZE,
    shingle: int = SHINGLE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated), one row for every
    row of ``docs``, repeated rows and missing ids included.

    A word is hit if it lies inside any place of a window of any item; an item
    with fewer than ``size`` words is one window, one without words none.
    Missing and empty texts have no words. Items with a missing id count as hits
    but not as items. Other columns are not read. Without items nothing is hit.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    numbered = with_rows(own, "row").select("row", "id", word_list(F.col("text")).alias("words"))
    windows = materialise(item_windows(items, item_col, item_text_col, size), "decontaminate-windows")
    rows = materialise(_matches(numbered, windows, shingle, broadcast_bytes), "decontaminate-matches")
    places = rows.where(F.col("window").isNotNull())
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(
        Window.unboundedPreceding, -1
    )
    end = F.col("start") + F.col("length")
    covered = places.select("row", "start", "length").distinct().withColumn("last", F.max(end).over(before))
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("last", "start")))
    hits = covered.groupBy("row").agg(F.sum(fresh).alias("n_hit"))
    owners = windows.where(F.col("item").isNotNull()).select("window", F.col("item").cast("string").alias("item"))
    named = places.select("row", "window").distinct().join(owners, "window").groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    base = rows.groupBy("row").agg(F.first("id").alias("id"), F.first("n").alias("n"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return base.join(hits, "row", "left").join(named, "row", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
