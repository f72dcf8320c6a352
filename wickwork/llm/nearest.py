"""Nearest neighbours by randomly rotated one-bit codes.

A vector, less its centre and scaled to length 1, is rotated and kept as the
signs of its components. With o the vector, x the code as a unit vector and q
the query, <o, q> is estimated by <x, q> / <x, o>; the error is at most

    EPSILON * sqrt((1 - <x, o>^2) / <x, o>^2 / (d - 1))

but for a chance that falls as exp(-c EPSILON^2). A query's components are rounded
to PLANES bits, one packed plane for each, so <x, q> is a sum of bit counts of the
code and a plane; what rounding leaves out, of length e, adds EPSILON e / sqrt(d) to
the error. The estimate less its error bounds the distance from below; a vector is
compared exactly with the query only if that bound does not exceed the distance of
the k-th nearest so far.

A stated set of queries is compared with all rows: a block of queries goes to
every task, which keeps k rows for each. Rows of one value, however many, are
spread as they were stored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.session import materialise

K = 10
EPSILON = 4.0
SEED = 7
# Queries in a block: with a row of dimension d they take 16 d bytes each in a task.
BLOCK = 4096
ROWS, COLUMNS = 2048, 256
# Bits of a query's components.
PLANES = 4


def usable(vector) -> F.Column:
    """Not missing, not zero, and every component finite."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.Generator(np.random.Philox([SEED, d])).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as rows of doubles, without a copy."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    octets = np.packbits(bits, axis=1)
    wide = np.zeros((len(octets), -(-octets.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : octets.shape[1]] = octets
    return wide.view(np.uint64)


class Planes:
    """Queries with rounded components: low + step * (a number of PLANES bits)."""

    def __init__(self, turned: np.ndarray):
        top = (1 << PLANES) - 1
        self.d = turned.shape[1]
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / top, 1e-300)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.sum = rounded.sum(axis=1)
        self.left = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        self.planes = [packed((level >> j) & 1) for j in range(PLANES)]

    def products(self, words: np.ndarray, part: slice) -> np.ndarray:
        """<x, rounded query> of every code, given as words, with some of the queries."""
        counts = np.zeros((len(words), len(self.low[part])), dtype=np.uint32)
        for plane in reversed(self.planes):
            counts <<= 1
            for w in range(words.shape[1]):
                counts += np.bitwise_count(words[:, w, None] & plane[None, part, w])
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        inside = self.low[part] * ones[:, None] + self.step[part] * counts
        return (2 * inside - self.sum[part]) / np.sqrt(self.d)


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits as words, distance to the centre, and <x, o> of each vector."""
    d = vectors.shape[1]
    rest = vectors - centre
    norm = np.sqrt((rest * rest).sum(axis=1))
    turned = (rest / np.maximum(norm, 1e-300)[:, None]) @ rotation(d)
    return packed(turned > 0), norm, np.abs(turned).sum(axis=1) / np.sqrt(d)


def build_codes(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """(id, dim, vector, code, norm, align): every row of ``vectors`` with its code."""

    def coded(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                own = batch.filter(pa.array(dims == d))
                bits, norm, align = encode(matrix(own.column(2)), centres[int(d)])
                yield pa.record_batch(
                    [
                        *own.columns,
                        pa.array([b.tobytes() for b in bits], pa.binary()),
                        pa.array(norm),
                        pa.array(align),
                    ],
                    names=["id", "dim", "vector", "code", "norm", "align"],
                )

    return vectors.mapInArrow(coded, "id long, dim int, vector array<double>, code binary, norm double, align double")


def centres_of(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean of all vectors of each length; a row for each length and component."""
    means = (
        vectors.select("dim", F.posexplode("vector").alias("i", "x"))
        .groupBy("dim", "i")
        .agg(F.avg("x").alias("x"))
        .orderBy("dim", "i")
        .collect()
    )
    out: dict[int, list[float]] = {}
    for row in means:
        out.setdefault(row.dim, []).append(row.x)
    return {d: np.array(v) for d, v in out.items()}


class _Best:
    """The k nearest rows of each query so far, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.numbers, self.vectors, self.k = ids, numbers, vectors, k
        self.far = np.full(len(ids), np.inf)
        self.found: list[list[tuple[float, int]]] = [[] for _ in ids]

    def offer(self, query: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        gap = vectors - self.vectors[query]
        distance = np.sqrt((gap * gap).sum(axis=1))
        mine = ids != self.ids[query]
        ids, distance = ids[mine], distance[mine]
        order = np.lexsort((ids, distance))[: self.k]
        rows = sorted([*self.found[query], *zip(distance[order].tolist(), ids[order].tolist(), strict=True)])
        self.found[query] = rows = rows[: self.k]
        if len(rows) == self.k:
            self.far[query] = rows[-1][0]


def _search(best: _Best, planes: Planes, norms: np.ndarray, ids, vectors, words, norm, align) -> None:
    """Offers the rows of a tile to the queries whose bounds they pass."""
    d = vectors.shape[1]
    align = np.maximum(align, 1e-9)
    slack = EPSILON * np.sqrt(np.maximum(1 - align * align, 0) / (align * align) / max(d - 1, 1))
    for start in range(0, len(norms), COLUMNS):
        part = slice(start, start + COLUMNS)
        estimate = planes.products(words, part) / align[:, None]
        error = slack[:, None] + EPSILON * planes.left[part] / np.sqrt(d) / align[:, None]
        product = 2 * norm[:, None] * norms[part][None, :]
        middle = norm[:, None] ** 2 + norms[part][None, :] ** 2
        low = middle - product * np.minimum(estimate + error, 1.0)
        high = middle - product * np.maximum(estimate - error, -1.0)
        for column in range(low.shape[1]):
            query = start + column
            if best.far[query] == np.inf and len(ids) > best.k:
                # The k rows of smallest upper bound come first: they set the mark for the others.
                first = np.argpartition(high[:, column], best.k)[: best.k + 1]
                best.offer(query, ids[first], vectors[first])
                best.found[query] = []  # the rows themselves come again below
            mark = best.far[query] ** 2
            near = np.flatnonzero(low[:, column] <= mark * (1 + 1e-5) + 1e-9)
            if len(near):
                best.offer(query, ids[near], vectors[near])


def _block_search(codes: DataFrame, queries: list, centres: dict, k: int) -> DataFrame:
    """(query_id, number, id, score): the k nearest rows of each task to each query
    of a block of (query_id, number, vector)."""
    by_dim: dict[int, tuple] = {}
    for d in {len(v) for *_, v in queries}:
        own = [(i, n, v) for i, n, v in queries if len(v) == d]
        by_dim[d] = tuple(np.array(column) for column in zip(*own, strict=True))
    shared = codes.sparkSession.sparkContext.broadcast(by_dim)

    def searched(batches):
        state = {}
        for d, (ids, numbers, vectors) in shared.value.items():
            rest = vectors - centres[d]
            norms = np.sqrt((rest * rest).sum(axis=1))
            turned = (rest / np.maximum(norms, 1e-300)[:, None]) @ rotation(d)
            state[d] = _Best(ids, numbers, vectors, k), Planes(turned), norms
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                if int(d) not in state:
                    continue
                own = batch.filter(pa.array(dims == d))
                ids = own.column(0).to_numpy(zero_copy_only=False)
                vectors = matrix(own.column(2))
                words = np.frombuffer(b"".join(own.column(3).to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
                norm, align = (own.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
                for start in range(0, len(ids), ROWS):
                    t = slice(start, start + ROWS)
                    _search(*state[int(d)], ids[t], vectors[t], words[t], norm[t], align[t])
        for best, _, _ in state.values():
            asked = zip(best.ids.tolist(), best.numbers.tolist(), best.found, strict=True)
            rows = [(q, n, i, s) for q, n, found in asked for s, i in found]
            if rows:
                q, n, i, s = zip(*rows, strict=True)
                yield pa.record_batch(
                    [*(pa.array(x, pa.int64()) for x in (q, n, i)), pa.array(s, pa.float64())],
                    names=["query_id", "number", "id", "score"],
                )

    return codes.mapInArrow(searched, "query_id long, number long, id long, score double")


def nearest(
    table: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows to each row of ``table`` for
    which the condition ``is_query`` holds, by Euclidean distance in doubles.

    A row is not its own neighbour: no row with the query's id is. Ties go to
    the smaller id. With fewer than k candidates all are returned. Vectors that
    are missing, zero or with a component missing or not finite take no part,
    nor do rows without an id; vectors of another length than the query's are no
    candidates. A query row that is repeated is answered once for each distinct
    vector it has; repeated candidates are each returned. Other columns are not
    read.
    """
    spark = table.sparkSession
    rows = table.select(
        F.col(id_col).cast("long").alias("id"),
        F.size(vector_col).alias("dim"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        is_query.alias("query"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    vectors = rows.select("id", "dim", "vector")
    centres = centres_of(vectors)
    codes = materialise(build_codes(vectors, centres), "nearest-codes")
    asked = rows.where("query").select("id", "vector").distinct().sortWithinPartitions("id")
    asked = materialise(asked, "nearest-queries")
    parts, now = [], []
    for number, row in enumerate(asked.toLocalIterator()):
        now.append((row.id, number, row.vector))
        if len(now) == block:
            parts.append(materialise(_block_search(codes, now, centres, k), "nearest-block"))
            now = []
    if now or not parts:
        parts.append(_block_search(codes, now, centres, k))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    order = Window.partitionBy("query_id", "number").orderBy("score", "id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
