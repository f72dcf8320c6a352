"""MinHash near-duplicates by tensored banding, confirmed on whole shingle sets.

A table key joins a half of one collection with a half of another. Each half is
made of ``rows`` min-hashes and each collection has ``halves`` of them, so
2 * halves * rows min-hashes give halves^2 keys of twice ``rows`` min-hashes.
Two texts of similarity s share a key unless they share no half of a collection,
with a chance of at most

    2 * (1 - s^rows)^halves

which is 1e-5 at 0.8 and falls quickly above. A key can only be shared if both
halves are, so halves that no other text has are dropped before keys are formed.

Work is on distinct sets (nodes), so exact copies are one. In the bucket of a key
every node is compared with one of them, the smallest, and the links found join
nodes into components. Most buckets then lie inside one component and are done.
The others that share nodes are one group, which is compared in blocks: the nodes
outside the group's largest component with all nodes of the group. The nodes of a
group of several blocks first get longer keys, which texts that share little do not
share, and go through the same again; what is left then, say some edits of one text,
is compared in blocks. So no pairs are listed and no task holds a large group.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from wickwork.llm.common import small_batches
from wickwork.llm.components import components, spread_join
from wickwork.session import materialise

SEED = 42
SHINGLE = 4
SIMILARITY = Fraction(4, 5)
# Halves of a collection and min-hashes of a half, of the first keys and the longer ones.
SHAPES = ((12, 2), (24, 4))
# Shingles that are multiplied by all factors at a time.
TILE = 512
# Nodes of a group that a task holds of either side.
BLOCK = 256
# The nodes whose texts are cut again are broadcast up to so many bytes.
BROADCAST_BYTES = 64 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles; a text with fewer
    words is one shingle, and one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    shingles = zip(*(words[i:] for i in range(size)), strict=False)
    return np.unique(np.array([digest(b" ".join(s), SEED) for s in shingles], dtype=np.uint64))


def node_of(shingles: np.ndarray) -> int:
    """The digest of a set, signed."""
    value = xxhash.xxh64_intdigest(shingles.tobytes(), SEED)
    return value - (1 << 64) if value >= 1 << 63 else value


class Halves:
    """The halves of both collections; each level has min-hashes of its own."""

    def __init__(self, level: int = 0):
        self.halves, self.rows = SHAPES[level]
        made = np.random.Generator(np.random.Philox(SEED + level))
        numbers = made.integers(0, 1 << 64, (2, 2 * self.halves * self.rows, 1), dtype=np.uint64)
        self.factor, self.summand = numbers[0] | np.uint64(1), numbers[1]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        """Those of the first collection, then of the second; none for an empty set."""
        if not len(shingles):
            return np.zeros(0, dtype=np.int64)
        least = np.full(len(self.factor), np.iinfo(np.uint64).max)
        for start in range(0, len(shingles), TILE):
            tile = shingles[start : start + TILE] * self.factor + self.summand
            np.minimum(least, tile.min(axis=1), out=least)
        value = np.arange(2 * self.halves, dtype=np.uint64)
        for row in least.reshape(2 * self.halves, self.rows).T:
            value = (value ^ row) * MIX
            value ^= value >> np.uint64(29)
        return value.view(np.int64)


def similar(both, a, b, similarity: Fraction):
    """Whether sets of sizes ``a`` and ``b`` that share ``both`` are similar, exactly."""
    over, under = similarity.numerator, similarity.denominator
    return (over + under) * both >= over * (a + b)


# ------------------------------------------------------------------- tables
def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(id, digest, node, n, halves) for every row (id, digest, text)."""
    added = [StructField("node", LongType()), StructField("n", LongType()), StructField("halves", ArrayType(LongType()))]
    out = StructType([docs.schema["id"], docs.schema["digest"], *added])

    def signed(batches):
        halves = Halves()
        for batch in small_batches(batches):
            sets = [shingle_set(t.as_py(), size) for t in batch.column(2)]
            columns = [
                pa.array([node_of(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([halves(s) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], names=out.names)

    return docs.mapInArrow(signed, out)


def full_sets(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """(node, n, shingles) of the nodes in ``chosen``, cut again from the text of the
    row that ``digest`` and ``least`` name."""
    chosen = materialise(chosen, "minhash-chosen")
    row_bytes = F.lit(24) + F.coalesce(F.octet_length(F.col("least").cast("string")), F.lit(0))
    if (chosen.agg(F.sum(row_bytes)).first()[0] or 0) <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)
    same = (docs.digest == chosen.digest) & docs.id.eqNullSafe(chosen.least)
    own = docs.join(chosen, same).select("node", "text")

    def cut(batches):
        for batch in small_batches(batches):
            sets = [shingle_set(t.as_py(), size) for t in batch.column(1)]
            wanted = batch.column(0).to_pylist()
            found = [(n, s) for n, s in zip(wanted, sets, strict=True) if node_of(s) == n]
            yield pa.record_batch(
                [
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(s) for _, s in found], pa.int64()),
                    pa.array([s.tobytes() for _, s in found], pa.binary()),
                ],
                names=["node", "n", "shingles"],
            )

    return own.mapInArrow(cut, "node long, n long, shingles binary").dropDuplicates(["node"])


def keys_of(nodes: DataFrame, level: int) -> DataFrame:
    """(key, node, n): the keys of every node (node, n, halves) whose two halves other
    nodes have too."""
    each = SHAPES[level][0]
    halves = nodes.select("node", "n", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("often")).where("often > 1")
    shared = materialise(shared, "minhash-halves")
    live = spread_join(halves, shared, "half", "node", shared).groupBy("node", "n")
    both = live.agg(
        F.collect_list(F.when(F.col("place") < each, F.col("half"))).alias("a"),
        F.collect_list(F.when(F.col("place") >= each, F.col("half"))).alias("b"),
    )
    one = both.select("node", "n", "b", F.explode("a").alias("a"))
    two = one.select("node", "n", "a", F.explode("b").alias("b"))
    return two.select(F.xxhash64("a", "b").alias("key"), "node", "n")


def only(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of the nodes in ``wanted``. Sets are not shuffled for it if the nodes'
    numbers can be broadcast."""
    wanted = materialise(wanted.select("node").distinct(), "minhash-wanted")
    if 16 * wanted.count() <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    return sets.join(wanted, "node", "left_semi")


def halves_of(wanted: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """(node, n, halves) of the nodes in ``wanted``, from their full sets."""

    def cut(batches):
        halves = Halves(level)
        for batch in small_batches(batches):
            found = [halves(np.frombuffer(s.as_py(), dtype=np.uint64)) for s in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["node", "n", "halves"]
            )

    return only(sets, wanted).mapInArrow(cut, "node long, n long, halves array<long>")


# ------------------------------------------------------------------ comparing
def verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose sets are similar. b may be frequent."""
    own = only(sets, pairs.select(F.col("a").alias("node")))
    own = own.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    other = only(sets, pairs.select(F.col("b").alias("node")))
    other = other.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    often = pairs.groupBy("b").agg(F.count("*").alias("often"))
    both = spread_join(pairs, other, "b", "a", often).join(own, "a").select("a", "b", "set_a", "set_b")

    def compared(batches):
        for batch in small_batches(batches):
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_py(), dtype=np.uint64) for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(similar(shared, len(x), len(y), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(compared, "a long, b long")


class _Index:
    """The owners of each shingle among some sets."""

    def __init__(self, sets: list[np.ndarray]):
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.n, self.owners = len(sets), owners[order]
        self.values, self.starts, self.counts = np.unique(values[order], return_index=True, return_counts=True)

    def shared(self, own: np.ndarray) -> np.ndarray:
        """How many of ``own`` shingles each set has."""
        at = np.minimum(np.searchsorted(self.values, own), len(self.values) - 1)
        at = at[self.values[at] == own]
        counts = self.counts[at]
        places = np.repeat(self.starts[at] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return np.bincount(self.owners[places], minlength=self.n)


def cross_links(one, other, similarity: Fraction) -> list[tuple[int, int]]:
    """Links between the nodes of two blocks that are in different components, one at
    most for each two components that they join.

    A block is its nodes, their roots and their sets.
    """
    (nodes, roots, sets), (nodes_b, roots_b, sets_b) = one, other
    index, lengths = _Index(sets_b), np.array([len(s) for s in sets_b])
    _, group = np.unique(np.concatenate([roots, roots_b]), return_inverse=True)
    group, group_b, out = group[: len(nodes)], group[len(nodes) :], []
    for i, own in enumerate(sets):
        far = group_b != group[i]
        near = np.flatnonzero(far & similar(index.shared(own), len(own), lengths, similarity))
        for j in near:
            old, new = group_b[j], group[i]
            if old != new:
                group[group == old], group_b[group_b == old] = new, new
                out.append((int(nodes[i]), int(nodes_b[j])))
    return out


def grouped(members: DataFrame) -> DataFrame:
    """(node, group) of the members (node, first) of buckets; those that share a node
    are one group."""
    pairs = members.select("node", "first").where("node != first").distinct()
    groups = components(pairs, "minhash-groups").withColumnRenamed("root", "group")
    nodes = members.select("node").distinct().join(groups, "node", "left")
    return materialise(nodes.select("node", F.coalesce("group", "node").alias("group")), "minhash-groups")


def in_large_groups(members: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """The members of buckets in groups of more than ``most`` nodes."""
    large = groups.groupBy("group").agg(F.count("*").alias("often")).where(F.col("often") > most)
    large = materialise(large, "minhash-large")
    nodes = spread_join(groups, large, "group", "node", large).select("node")
    return members.join(nodes, "node", "left_semi")


def compared_in_blocks(groups: DataFrame, edges: DataFrame, sets: DataFrame, similarity: Fraction, block: int):
    """(a, b): links across components among the nodes (node, group) of a group.

    A task compares a block of the nodes that are not in the group's largest component
    with a block of all its nodes.
    """
    nodes = groups.join(edges, "node", "left").select("node", "group", F.coalesce("root", "node").alias("root"))
    nodes = materialise(nodes, "minhash-group-nodes")
    sizes = nodes.groupBy("group", "root").agg(F.count("*").alias("m"))
    whole = sizes.groupBy("group").agg(
        F.sum("m").alias("often"), F.max("m").alias("most"), F.max_by("root", "m").alias("largest")
    )
    whole = materialise(whole.where("often > most"), "minhash-group-sizes")
    rows = spread_join(nodes, whole, "group", "node", whole)
    rows = rows.withColumns(
        {
            "odd": F.col("root") != F.col("largest"),
            "all_blocks": F.ceil(F.col("often") / F.lit(block)).cast("int"),
            "odd_blocks": F.ceil((F.col("often") - F.col("most")) / F.lit(block)).cast("int"),
        }
    )

    def dealt(side: DataFrame, own: str, other: str, place: str, across: str) -> DataFrame:
        number = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(place)
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(across)
        return side.select("group", "node", "root", number, copies)

    odd = dealt(rows.where("odd"), "odd_blocks", "all_blocks", "i", "j").withColumn("odd", F.lit(True))
    all_rows = dealt(rows, "all_blocks", "odd_blocks", "j", "i").withColumn("odd", F.lit(False))
    cells = odd.unionByName(all_rows).join(sets.select("node", "shingles"), "node")

    def compared(table):
        def side(odd):
            own = table.filter(pa.compute.equal(table.column("odd"), odd))
            held = [np.frombuffer(s.as_py(), dtype=np.uint64) for s in own.column("shingles")]
            return own.column("node").to_numpy(), own.column("root").to_numpy(), held

        one, other = side(True), side(False)
        found = cross_links(one, other, similarity) if len(one[0]) and len(other[0]) else []
        found = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return cells.groupBy("group", "i", "j").applyInArrow(compared, "a long, b long")


def open_members(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, first) of the members of buckets that hold more than one component."""
    roots = edges.select("node", "root")
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    left = rooted.groupBy("key").agg(
        F.count("*").alias("often"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    left = materialise(left.where("low != high").select("key", "often"), "minhash-open")
    return spread_join(members.select("key", "node", "first"), left, "key", "node", left).select("node", "first")


def linked(nodes: DataFrame, sets_of, similarity: Fraction, block: int) -> DataFrame:
    """(node, root) of all nodes with a link.

    ``nodes`` holds (node, n, halves); ``sets_of`` gives the full sets of a table of nodes.
    """
    edges = sets = None
    over, under = similarity.numerator, similarity.denominator
    # Sets whose sizes differ too much cannot be similar.
    fit = F.least("n", "first_n") * under >= F.greatest("n", "first_n") * over
    for level in range(len(SHAPES)):
        keys = materialise(keys_of(nodes, level), "minhash-keys")
        buckets = keys.groupBy("key").agg(
            F.min("node").alias("first"), F.min_by("n", "node").alias("first_n"), F.count("*").alias("often")
        )
        buckets = materialise(buckets.where("often > 1"), "minhash-buckets")
        members = materialise(spread_join(keys, buckets, "key", "node", buckets), "minhash-members")
        if sets is None:
            sets = materialise(sets_of(members.select("node").distinct()), "minhash-sets")
        pairs = members.where((F.col("node") != F.col("first")) & fit)
        pairs = pairs.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
        if edges is not None:
            # Links inside a component tell nothing new.
            for end in ("a", "b"):
                pairs = pairs.join(edges.toDF(end, f"{end}_root"), end, "left")
            apart = F.coalesce("a_root", "a") != F.coalesce("b_root", "b")
            pairs = pairs.where(apart).select("a", "b")
        found = verified(materialise(pairs, "minhash-pairs"), sets, similarity)
        edges = components(found if edges is None else edges.toDF("a", "b").union(found), "minhash")
        rest = materialise(open_members(members, edges).distinct(), "minhash-rest")
        if rest.isEmpty():
            return edges
        groups = grouped(rest)
        if level + 1 < len(SHAPES):
            # Keys of a node take more room than its set, so groups of one block go without.
            rest = materialise(in_large_groups(rest, groups, block), "minhash-rest")
            groups = groups.join(rest.select("node").distinct(), "node", "left_anti")
        found = compared_in_blocks(groups, edges, sets, similarity, block)
        edges = components(edges.toDF("a", "b").union(found), "minhash")
        if level + 1 < len(SHAPES):
            if rest.isEmpty():
                return edges
            nodes = materialise(halves_of(rest, sets, level + 1), "minhash-longer")
    return edges


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    similarity: Fraction = SIMILARITY,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row for every row of ``docs``,
    repeated rows and missing ids included.

    Texts link if the Jaccard similarity of their sets of ``size``-word shingles is
    at least ``similarity``, which is checked on the full sets. component_id is the
    smallest id reachable over links, the row's own included; missing ids are
    ignored in that minimum, so a component of only such rows has none. kept says
    that a row's id is the component's; it is false for a missing id. A missing text
    and one without words have no shingles and are alone. Other columns are not
    read; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    rows = materialise(signatures(own, size), "minhash-rows")
    nodes = rows.where("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("halves").alias("halves"), F.min("id").alias("least"),
        F.coalesce(F.min_by("digest", "id"), F.min("digest")).alias("digest"), F.count("*").alias("often"),
    )
    nodes = materialise(nodes, "minhash-nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        chosen = nodes.join(wanted, "node", "left_semi").select("node", "least", "digest")
        return full_sets(own, chosen, size)

    found = linked(nodes.select("node", "n", "halves"), sets_of, similarity, block)
    rooted = nodes.join(found, "node", "left").select("node", "least", "often", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(smallest, "root").select("node", "often", "component_id"), "minhash-named")
    whole = spread_join(rows.where("n > 0").select("id", "n", "node"), named, "node", "id", named)
    both = whole.select("id", "n", "component_id").unionByName(
        rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
