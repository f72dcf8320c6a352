"""MinHash near-duplicates against all pairs on small tables with odd rows."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from wickwork.llm import components, minhash

DOCS = "doc_id long, text string"


def plain_set(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1))


def plain_duplicates(rows, size=4, similarity=Fraction(4, 5)):
    sets = [plain_set(r[1], size) for r in rows]
    distinct = sorted({s for s in sets if s}, key=len)
    up = {s: s for s in distinct}

    def find(s):
        while up[s] != s:
            s = up[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if len(b) * 5 >= len(a) * 3 and len(a & b) >= similarity * len(a | b):
                up[find(a)] = find(b)
    least = {}
    for (i, *_), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    out = []
    for (i, *_), s in zip(rows, sets, strict=True):
        own = least.get(find(s)) if s else i
        out.append((i, len(s), own, i is not None and i == own))
    return sorted(out, key=repr)


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"new{rnd.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(13)
    out = []
    for base in range(12):
        words = [f"w{rnd.randrange(60)}" for _ in range(rnd.randint(30, 300))]
        out += [edited(rnd, words, rnd.randint(0, 9)) for _ in range(12)]
    hub = [f"h{i}" for i in range(200)]
    out += [edited(rnd, hub, 1 + i % 9) for i in range(80)]
    shared = " ".join(f"p{i}" for i in range(60))
    out += [shared + " " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(i)) for i in range(0, 120, 2)]
    out += [None, "", " \t\n", "one", "ONE", "two words", "Two\tWords", "a b c", "a b c d", "É é", "é é", "x\x85y z\xa0"]
    out += [out[0]] * 25 + ["  " + out[1].upper(), "word " * 3000]
    rows = [(i * 3 % 1009, t) for i, t in enumerate(out)]
    return rows + [rows[4], rows[4], (None, out[0]), (None, "nobody's own text of six words"), (None, None), (None, "")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    names = ("id", "node", "n", "key", "digest", "root", "a", "b", "size", "often")
    return spark.createDataFrame(rows, DOCS).withColumns({n: F.lit(1) for n in names}).repartition(4)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bounds", [{}, {"block": 16}])
def test_near_duplicates_equal_all_pairs(docs, rows, bounds):
    found = minhash.near_duplicates(docs, **bounds)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert bag(found) == plain_duplicates(rows)


def test_groups_of_one_block_get_no_longer_keys(docs, rows, monkeypatch):
    """They are compared at once, whose sets take less room than their longer keys."""
    compared, blocks = [], minhash.compared_in_blocks
    monkeypatch.setattr(minhash, "compared_in_blocks", lambda *a: compared.append(a[0].count()) or blocks(*a))
    monkeypatch.setattr(minhash, "halves_of", None)
    assert bag(minhash.near_duplicates(docs, block=1 << 20)) == plain_duplicates(rows)
    assert len(compared) == 1 and compared[0] > 0


def test_sets_are_not_shuffled_to_choose_among_them(spark):
    sets = spark.range(100).select(F.col("id").alias("node"), F.lit(b"x").alias("shingles"))
    found = minhash.only(sets, spark.createDataFrame([(3,), (3,), (500,)], "node long"))
    assert [r.node for r in found.collect()] == [3]
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().toString()


def test_other_sizes_and_similarities(docs, rows):
    found = minhash.near_duplicates(docs, size=5, similarity=Fraction(9, 10))
    assert bag(found) == plain_duplicates(rows, 5, Fraction(9, 10))


def test_empty_and_lonely_tables(spark, docs):
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    rows = [(1, "a text that nothing else is like"), (2, None), (3, "")]
    assert bag(minhash.near_duplicates(spark.createDataFrame(rows, DOCS))) == plain_duplicates(rows)


@pytest.mark.parametrize("level", [0, 1])
def test_links_at_the_bound_are_found(level):
    """Pairs with a similarity of exactly 0.8 share a key, but for a few in 100,000."""
    rnd = np.random.default_rng(3)
    halves, missed = minhash.Halves(level), 0
    for _ in range(1500):
        both = rnd.integers(0, 1 << 64, 80, dtype=np.uint64)
        own = rnd.integers(0, 1 << 64, 20, dtype=np.uint64)
        a, b = halves(np.concatenate([both, own[:10]])), halves(np.concatenate([both, own[10:]]))
        missed += not (a == b).reshape(2, halves.halves).any(axis=1).all()
    assert missed <= 1


def test_blocks_are_compared_across_components_only():
    sets = [np.arange(i, i + 40, dtype=np.uint64) for i in (0, 1, 2, 100, 101, 300)]
    nodes = np.arange(6) * 10

    def found(roots, one, other):
        roots = np.array(roots)
        sides = [(nodes[x], roots[x], [sets[i] for i in x]) for x in (one, other)]
        links = minhash.cross_links(*sides, Fraction(4, 5))
        return sorted(tuple(sorted(x)) for x in links)

    every = list(range(6))
    assert found([7] * 6, every, every) == []
    assert len(found(every, every, every)) == 3
    assert found([1, 1, 1, 3, 4, 5], every, every) == [(30, 40)]
    assert found(every, [0, 5], [3, 4]) == []
    # One link is enough for two components.
    assert len(found([0, 0, 2, 3, 4, 5], [0, 1], [2, 3])) == 1


def test_frequent_keys_are_dealt_over_pieces(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    counts = rows.groupBy("k").agg(F.count("*").alias("often"))
    small = rows.select("k").distinct().withColumn("v", F.col("k") * 2)
    joined = components.spread_join(rows, small, "k", "x", counts)
    assert sorted(map(tuple, joined.collect())) == sorted((k, x, 2 * k) for k, x in rows.collect())


@pytest.mark.parametrize("seed", range(3))
def test_components_of_hubs_and_chains(spark, seed):
    rnd = random.Random(seed)
    links = [(0, i) for i in range(1, 600)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(200)]
    rnd.shuffle(links)
    links = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in links if a != b]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(8), "test")
    assert {(r.node, r.root) for r in found.collect()} == {(x, find(x)) for x in up if find(x) != x}
