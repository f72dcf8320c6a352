"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.session import materialise

# A key is frequent if it has more than a SHARE-th of all rows; fewer than SHARE are.
SHARE = 1024
# Below so many rows a key is not worth dealing out.
LEAST = 200
# Links that a task joins in the second pass.
PART = 1 << 18


def spread_join(rows: DataFrame, small: DataFrame, key: str, by: str, counts: DataFrame) -> DataFrame:
    """``rows`` joined with ``small``, which has one row for each key, such that no
    task gets all rows of a frequent key.

    ``counts`` has the number of rows of each key in ``often``. The rows of a frequent
    key are dealt over pieces by a hash of ``by``, and its row of ``small`` is copied
    to each piece. The table of frequent keys is broadcast: it has fewer than SHARE
    rows, of a key and a number.
    """
    sizes = counts.agg(F.sum("often").alias("total"), F.max("often").alias("largest")).first()
    most = max((sizes.total or 0) / SHARE, LEAST)
    if (sizes.largest or 0) <= most:
        return rows.join(small.select(key, *[c for c in small.columns if c not in rows.columns]), key)
    frequent = counts.where(F.col("often") > most).select(
        key, F.ceil(F.col("often") / F.lit(most)).cast("int").alias("_pieces")
    )
    piece = F.coalesce(F.pmod(F.xxhash64(by), F.col("_pieces")), F.lit(0)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces") - 1, F.lit(0))))
    dealt = rows.join(F.broadcast(frequent), key, "left").withColumn("_piece", piece).drop("_pieces")
    extra = [c for c in small.columns if c not in rows.columns or c == key]
    copied = small.select(*extra).join(F.broadcast(frequent), key, "left").withColumn("_piece", copies).drop("_pieces")
    return dealt.join(copied, [key, "_piece"]).drop("_piece")


def _forest(batches):
    """A spanning forest of one task's links, as (node, root) rows.

    Any task's links may be replaced by a forest with the same components, which
    has at most one row for each of its nodes. A task holds its own share of the
    links only.
    """
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in parent]
    pairs = np.array([p for p in pairs if p[0] != p[1]], dtype=np.int64).reshape(-1, 2)
    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` and ``least`` share the key u: a hub's links are dealt over tasks."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("often"))
    joined = spread_join(both, least.drop("often"), "u", "v", least.select("u", "often"))
    return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger node to the smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points to one other, and that to none."""
    tops = edges.select(F.col("b").alias("a")).distinct().withColumn("top", F.lit(True))
    nodes = edges.groupBy("a").agg(F.count("*").alias("n"))
    return nodes.join(tops, "a", "left").where((F.col("n") > 1) | F.col("top")).isEmpty()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node with a link; root is the component's smallest node.

    ``edges`` holds two long columns. The number of rounds grows with the
    logarithm of the number of nodes; each round is written to the shared
    folder, so a lost executor costs that round only. Links always point to the
    smaller node and no round parts what is linked, so stars are the components.

    Before the rounds each task joins its own links, and then, as few are left, each
    task of a second pass those of several: at most about PART, whatever their number.
    """
    edges = materialise(edges.toDF("a", "b").mapInArrow(_forest, "a long, b long"), f"{name}-links")
    parts = max(1, -(-edges.count() // PART))
    edges = materialise(edges.coalesce(parts).mapInArrow(_forest, "a long, b long"), f"{name}-links")
    while not _are_stars(edges):
        edges = materialise(_small_star(_large_star(edges)), f"{name}-links")
    return edges.toDF("node", "root")
