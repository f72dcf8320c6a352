"""How far the sources of a language differ from each other in their terms.

Every pair of groups is compared over every term, so the work is a cube of
groups by groups by terms. It is cut into cells of a block of groups, another
block of groups and a block of terms. The counts of a block of groups in a block
of terms are a slice; a slice is copied to each cell that compares its groups
with others, and a cell's sums over its own terms are added up along the axis
of terms. A cell holds two slices, whatever the size of the corpus.

Counts are shuffled once, by language and the term's hash: what is known of a
term in its language is then found inside that partition.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import small_batches
from wickwork.session import materialise

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
GROUP_BLOCK, TERM_BLOCK = 32, 4096
# Terms are dealt by hash into so many parts; a block of terms is some of them.
PARTS = 1 << 14
# A task hands its counts on when it holds so many.
HELD = 400_000
# Terms are runs of ASCII letters and of all beyond ASCII.
_LETTERS = string.ascii_letters.encode()
_BREAKS = bytes(b if b > 0x7F or b in _LETTERS else 0x20 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BREAKS).split()


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each
    group, from rows (lang, source, text), added up in a task's stretch of rows."""
    names = ["lang", "source", "term", "n", "docs"]

    def counted(batches):
        often, seen = defaultdict(Counter), defaultdict(Counter)

        def flush():
            for (lang, source), own in often.items():
                columns = [
                    pa.repeat(pa.scalar(lang), len(own)),
                    pa.repeat(pa.scalar(source), len(own)),
                    pa.array(list(own), pa.binary()).cast(pa.string()),
                    pa.array(list(own.values()), pa.int64()),
                    pa.array([*map(seen[lang, source].__getitem__, own)], pa.int64()),
                ]
                yield pa.record_batch(columns, names=names)
            often.clear()
            seen.clear()

        for batch in small_batches(batches):
            for lang, source, text in zip(*batch.columns, strict=True):
                group, words = (lang.as_py(), source.as_py()), terms_of(text.as_py())
                often[group].update(words)
                seen[group].update(set(words))
            if sum(map(len, often.values())) >= held:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(counted, "lang string, source string, term string, n long, docs long")


def entries_of(counts: DataFrame, least: int) -> DataFrame:
    """(lang, part, source, term, n, total, t) of the kept terms: n in the group, total
    in the language, t the term's number among the kept terms of its part."""
    rows = counts.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")).repartition("lang", "part")
    rows = rows.groupBy("lang", "part", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "part", "term")
    rows = rows.withColumns({"total": F.sum("n").over(of_term), "docs": F.sum("docs").over(of_term)})
    number = F.dense_rank().over(Window.partitionBy("lang", "part").orderBy("term")) - 1
    return rows.where(F.col("docs") >= least).withColumn("t", number).drop("docs")


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), for a count below the total.

    Divided three digits at a time, so that no number exceeds 1000 times the
    total: exact for totals below 9e15.
    """
    parts, left = F.lit(0).cast("long"), count + 1
    for _ in range(3):
        parts = parts * 1000 + F.call_function("div", left * 1000, total)
        left = left * 1000 % total
    return 1 + parts


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for whole arrays."""
    parts, left = np.zeros(np.broadcast_shapes(count.shape, total.shape), dtype=np.int64), count + 1
    for _ in range(3):
        left = left * 1000
        parts = parts * 1000 + left // total
        left = left % total
    return 1 + parts


def excess(p, q):
    """(p - q)^2 / q, floored: at most SCALE^2, so a long holds it."""
    if isinstance(p, Column):
        return F.call_function("div", (p - q) * (p - q), q)
    return (p - q) ** 2 // q


def part_sizes(entries: DataFrame) -> DataFrame:
    """(lang, part, held): the kept terms in each part."""
    return entries.groupBy("lang", "part").agg((F.max("t") + 1).cast("long").alias("held"))


def group_table(docs: DataFrame, entries: DataFrame, sizes: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """One row for each group that occurs: its number g in its language, its block, n
    occurrences of kept terms, and for its language these (lang_n), the kept terms (v)
    and the numbers of blocks of groups and of terms."""
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = sizes.groupBy("lang").agg(F.sum("held").alias("v"))
    rows = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    rows = rows.fillna(0, ["n", "v"]).withColumn("g", number)
    of_lang = Window.partitionBy("lang")
    return rows.withColumns(
        {
            "lang_n": F.sum("n").over(of_lang),
            "gblock": F.floor(F.col("g") / group_block).cast("int"),
            "group_blocks": F.ceil(F.count("*").over(of_lang) / group_block).cast("int"),
            "term_blocks": F.least(F.ceil(F.col("v") / F.lit(term_block)), F.lit(PARTS)).cast("int"),
        }
    )


def slices(groups: DataFrame, entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of the slices, by (lang, gblock, tblock): counts above 0 as (g, t, n), and a
    head with the groups in ``members``, the kept terms v of the language and ``held`` of
    the block. A slice without counts has a head, as other groups have its terms."""
    tblock = F.pmod("part", "term_blocks")
    place = (F.col("part").cast("long") * (1 << 32) + F.col("t")).alias("t")
    named = groups.select("lang", "source", "g", "gblock", "term_blocks", "group_blocks")
    counts = entries.join(named, ["lang", "source"]).select(
        "lang", "gblock", tblock.alias("tblock"), "group_blocks", "g", place, "n"
    )
    langs = groups.select("lang", "term_blocks").distinct()
    blocks = sizes.join(langs, "lang").groupBy("lang", tblock.alias("tblock")).agg(F.sum("held").alias("held"))
    heads = groups.groupBy("lang", "gblock", "group_blocks", "v").agg(F.collect_list(F.struct("g", "n")).alias("members"))
    return counts.unionByName(heads.join(blocks, "lang"), allowMissingColumns=True)


def _cell(table: pa.Table) -> pa.Table:
    """The sums of one cell for every ordered pair of its groups that it compares:
    all of one block, or those of the one with those of the other."""
    whole = table.column("members").is_valid()
    heads, counts = table.filter(whole).sort_by("gblock").combine_chunks(), table.filter(pa.compute.invert(whole))
    v, held = heads.column("v")[0].as_py(), heads.column("held")[0].as_py()
    block_of, g, t, n = (counts.column(c).to_numpy() for c in ("gblock", "g", "t", "n"))
    present = np.unique(t)
    numbers, p, p_absent = [], [], []
    for head in heads.to_pylist():
        own = sorted((m["g"], m["n"]) for m in head["members"])
        own, total = np.array(own, dtype=np.int64).T
        mine = block_of == head["gblock"]
        rows = np.zeros((len(own), len(present)), dtype=np.int64)
        rows[np.searchsorted(own, g[mine]), np.searchsorted(present, t[mine])] = n[mine]
        numbers.append(own)
        p.append(shares(rows, total[:, None] + v))
        p_absent.append(shares(np.zeros(len(own), dtype=np.int64), total + v))
    absent, last = held - len(present), len(numbers) - 1
    out = []
    for one, other in {(0, last), (last, 0)}:
        for i, a in enumerate(numbers[one]):
            sums = excess(p[one][i], p[other]).sum(axis=1) + absent * excess(p_absent[one][i], p_absent[other])
            out.append((np.full(len(sums), a), numbers[other], sums))
    a, b, sums = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
    apart = a != b
    lang = pa.repeat(heads.column("lang")[0], int(apart.sum()))
    return pa.table({"lang": lang, "a": a[apart], "b": b[apart], "value": sums[apart]})


def pair_sums(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every two groups of a language that has kept terms."""
    copied = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
    cells = copied.withColumns({"i": F.least("gblock", "other"), "j": F.greatest("gblock", "other")})
    cells = cells.drop("other", "group_blocks")
    sums = cells.groupBy("lang", "i", "j", "tblock").applyInArrow(_cell, "lang string, a long, b long, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def pair_part(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): each other source of the group's language."""
    named = groups.select("lang", "source", "g")
    one = named.toDF("lang", "source", "a")
    other = named.toDF("lang", "item", "b")
    # The result has a row for every two groups of a language, so this join is its size.
    pairs = one.join(other, "lang").where("a != b").join(sums, ["lang", "a", "b"], "left")
    rows = pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    return ranked(rows)


def term_part(entries: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): the terms a group uses more than its language."""
    both = entries.join(groups.select("lang", "source", F.col("n").alias("group_n"), "lang_n", "v"), ["lang", "source"])
    p = share(F.col("n"), F.col("group_n") + F.col("v"))
    q = share(F.col("total"), F.col("lang_n") + F.col("v"))
    both = both.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    rows = both.select("lang", "source", "item", excess(F.col("p"), F.col("q")).alias("value"))
    return ranked(rows).where(F.col("rank") <= top)


def ranked(rows: DataFrame) -> DataFrame:
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(by_value))


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group (lang, source) in ``docs``.

    Part ``pair`` compares a group with each other source of its language over all
    terms that ``least`` documents of the language have, part ``term`` lists the
    ``top`` terms that set the group apart from its language. Values are sums of
    whole numbers, so they do not depend on how the work was cut. Missing texts,
    languages and sources are empty ones; repeated rows count as documents of
    their own. A group without terms is compared like any other, with value 0 in a
    language that keeps none. Other columns are not read; an empty table gives
    an empty result.
    """
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(lang_col, empty).alias("lang"), F.coalesce(source_col, empty).alias("source"),
        F.coalesce(text_col, empty).alias("text"),
    )
    entries = materialise(entries_of(term_counts(rows), least), "audit-entries")
    sizes = part_sizes(entries)
    groups = materialise(group_table(rows, entries, sizes, group_block, term_block), "audit-groups")
    pair = pair_part(pair_sums(slices(groups, entries, sizes)), groups).withColumn("part", F.lit("pair"))
    term = term_part(entries, groups, top).withColumn("part", F.lit("term"))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
