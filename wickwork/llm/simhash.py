"""SimHash near-duplicates: fingerprints, links by the generalised pigeonhole
principle, and the components that the links form.

Two fingerprints link at ``radius`` or fewer differing bits. The 64 bits are
ordered so that correlated bits stand together and are cut into partitions. A
partition with threshold t is probed with every value within t bits of its own;
if the thresholds plus one sum to radius + 1, a linked pair must meet in some
partition, because otherwise it would differ in radius + 1 bits. Thresholds and
the number of partitions are those with the least estimated work.

Work is on distinct fingerprints, so a group of exact copies is one node. The
join condition verifies a pair as it is probed; only links leave the join. For
components not all links are needed: every node is first compared with the
smallest of each value it probes, and only where a value still joins two
components are its nodes compared with each other, across these.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wickwork.llm.common import small_batches, vector_sum
from wickwork.llm.components import components, spread_join
from wickwork.session import materialise

SEED = 42
SHINGLE = 3
RADIUS = 3
BITS = 64
OCTETS = 8
# Relative costs of making, shuffling and sorting one probe row and of comparing one pair.
PROBE_COST, PAIR_COST = 1.0, 0.01


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text's word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        shingles = zip(*(words[i:] for i in range(size)), strict=False)
        hashes = [digest(b" ".join(shingle), SEED) for shingle in shingles]
    values = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(values), 1 << 16):
        ones += np.unpackbits(values[start : start + (1 << 16)], axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for every row; a missing or empty text has fingerprint 0."""
    rows = docs.select(F.col(id_col), F.col(text_col))
    out = StructType([rows.schema[0], StructField("fp", LongType())])

    def hashed(batches):
        for batch in small_batches(batches):
            fps = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.record_batch([batch.column(0), fps], names=[id_col, "fp"])

    return rows.mapInArrow(hashed, out)


def _bit_rows(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(
        np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )


def _fps(batch) -> np.ndarray:
    return np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)


def bit_order(nodes: DataFrame) -> list[int]:
    """The 64 bit positions, correlated ones in the same run of eight.

    Correlations are over all distinct fingerprints.
    """

    def pair_counts(batch):
        bits = _bit_rows(_fps(batch)).astype(np.float64)
        return np.append((bits.T @ bits).ravel(), len(bits))

    summed = vector_sum(nodes, pair_counts, BITS * BITS + 1)
    n = max(summed[-1], 1)
    both = summed[:-1].reshape(BITS, BITS) / n
    share = np.diag(both)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs((both - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, order = set(range(BITS)), []
    while left:
        group = [max(sorted(left), key=lambda b: related[b, sorted(left)].max())]
        left.remove(group[0])
        while len(group) < BITS // OCTETS:
            group.append(max(sorted(left), key=lambda b: related[b, group].sum()))
            left.remove(group[-1])
        order += group
    return order


def _ordered(values: np.ndarray, order: list[int]) -> np.ndarray:
    """The fingerprints' octets, after their bits are put into ``order``."""
    return np.packbits(_bit_rows(values)[:, order], axis=1, bitorder="little")


def plan_partitions(nodes: DataFrame, order: list[int], radius: int) -> list[tuple[range, int]]:
    """(octets, threshold) of each partition to probe.

    The number of pairs within t bits in a partition is estimated from the
    histograms of its octets over all fingerprints, taken as independent.
    Dynamic programming gives each partition its threshold.
    """

    def histogram(batch):
        octets = _ordered(_fps(batch), order)
        return np.concatenate([np.bincount(octets[:, i], minlength=256) for i in range(OCTETS)])

    counts = vector_sum(nodes, histogram, OCTETS * 256).reshape(OCTETS, 256)
    n = max(counts[0].sum(), 1)
    apart = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
    chance = []  # for each octet, the chance that two fingerprints differ in 0..8 of its bits
    for row in counts / n:
        pairs = np.outer(row, row)
        chance.append(np.array([pairs[apart == d].sum() for d in range(9)]))
    best = None
    for m in range(1, radius + 2):
        cuts = [round(OCTETS * i / m) for i in range(m + 1)]
        parts = [range(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        plans = {0: (0.0, [])}  # by the sum of (threshold + 1) so far
        for part in parts:
            within = np.array([1.0])
            for octet in part:
                within = np.convolve(within, chance[octet])
            width = 8 * len(part)
            cost = {-1: 0.0}
            for t in range(radius + 1):
                probes = n * sum(comb(width, d) for d in range(t + 1))
                cost[t] = PROBE_COST * probes + PAIR_COST * n * n * within[: t + 1].sum()
            step = {}
            for used, (spent, chosen) in plans.items():
                for t in range(-1, radius - used + 1):
                    total = (spent + cost[t], [*chosen, (part, t)])
                    if used + t + 1 not in step or total[0] < step[used + t + 1][0]:
                        step[used + t + 1] = total
            plans = step
        found = plans[radius + 1]
        if best is None or found[0] < best[0]:
            best = found
    return [(part, t) for part, t in best[1] if t >= 0]


def _keys(octets: np.ndarray, part: range) -> np.ndarray:
    padded = np.zeros((len(octets), 8), dtype=np.uint8)
    padded[:, : len(part)] = octets[:, part.start : part.stop]
    return padded.view(np.int64).ravel()


def _masks(width: int, threshold: int) -> list[int]:
    """Every set of at most ``threshold`` of ``width`` bits, as signed numbers."""
    sets = [sum(1 << b for b in c) for d in range(threshold + 1) for c in combinations(range(width), d)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in sets]


def _close(radius: int):
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius


def sides(nodes: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(part, key, a) with every value that a fingerprint probes, and (part, key, b)
    with its own value, of each partition."""
    order = bit_order(nodes)
    plan = plan_partitions(nodes, order, radius)

    def rows(probe: bool):
        def made(batches):
            for batch in batches:
                fps = _fps(batch)
                octets = _ordered(fps, order)
                for number, (part, threshold) in enumerate(plan):
                    keys = _keys(octets, part)
                    for mask in _masks(8 * len(part), threshold) if probe else [0]:
                        yield pa.record_batch(
                            [
                                pa.array(np.full(len(fps), number, dtype=np.int32)),
                                pa.array(keys ^ np.int64(mask)),
                                pa.array(fps),
                            ],
                            names=["part", "key", "a" if probe else "b"],
                        )

        return made

    probes = nodes.mapInArrow(rows(True), "part int, key long, a long")
    return probes, nodes.mapInArrow(rows(False), "part int, key long, b long")


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b: each pair of distinct fingerprints in ``nodes`` (column fp)
    that differ in at most ``radius`` bits, once."""
    probes, index = sides(nodes, radius)
    met = probes.join(index, ["part", "key"]).where((F.col("a") < F.col("b")) & _close(radius))
    return met.select("a", "b").distinct()


def linked(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, root) of every fingerprint in ``nodes`` (column fp) that has a link.

    The same components as those of all ``links``, which are not listed: k near
    copies of one another give about k of them instead of k^2 / 2.
    """
    probes, index = sides(nodes, radius)
    # A value that one fingerprint probes is its own.
    values = index.groupBy("part", "key").agg(F.min("b").alias("b"), F.count("*").alias("own"))
    first = probes.join(values, ["part", "key"]).where((F.col("a") != F.col("b")) & _close(radius))
    found = components(first.select("a", "b").distinct(), "simhash")
    roots = found.toDF("fp", "root")

    def rooted(side: DataFrame, name: str) -> DataFrame:
        own = side.join(roots.withColumnRenamed("fp", name), name, "left")
        return own.withColumn("root", F.coalesce("root", name))

    probes, index = rooted(probes, "a"), rooted(index, "b")
    left = probes.groupBy("part", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    left = left.where("low != high").select("part", "key")
    left = materialise(left.join(index.select("part", "key").distinct(), ["part", "key"], "left_semi"), "simhash-open")
    one = probes.join(left, ["part", "key"], "left_semi").withColumnRenamed("root", "a_root")
    other = index.join(left, ["part", "key"], "left_semi").withColumnRenamed("root", "b_root")
    across = (F.col("a_root") != F.col("b_root")) & _close(radius)
    rest = one.join(other, ["part", "key"]).where(across).select("a", "b").distinct()
    return components(found.toDF("a", "b").union(rest), "simhash")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``, repeated rows included.

    component_id is the smallest id reachable over links, the row's own
    included; missing ids are ignored in that minimum, so a component of only
    such rows has none. Texts without words have fingerprint 0 and link like
    any other. Other columns of ``docs`` are not read. An empty table gives an
    empty result.
    """
    rows = materialise(fingerprints(docs, id_col, text_col), "simhash-fp")
    nodes = materialise(
        rows.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("often")), "simhash-nodes"
    )
    found = linked(nodes.select("fp"), radius)
    rooted = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "least", "often", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(smallest, "root").select("fp", "often", "component_id"), "simhash-named")
    own = rows.select(F.col(id_col).alias("_id"), "fp")
    whole = spread_join(own, named, "fp", "_id", named)
    return whole.select(F.col("_id").alias(id_col), "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
