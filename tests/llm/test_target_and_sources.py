"""Resampling and the audit of sources against brute force on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wickwork.llm import divergence, importance

DOCS = "doc_id long, text string, lang string, source string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    words = "alpha Beta gamma delta eps1 zeta ÉTA 漢字 theta iota x9 kappa".split()
    out = []
    for i in range(240):
        text = " ".join(rnd.choice(words[: 3 + i % 10]) for _ in range(rnd.randint(0, 60)))
        out.append((i, text, "abc"[i % 3], f"s{i % 7 if i % 2 else 0}"))
    out += [(500, None, "a", "s0"), (501, "", None, None), (502, "123 !! ...", "d", "x"), (503, "só É", "d", "y"),
            (504, "word " * 5000, None, "s0"), (505, "only one", "e", "z"), (506, "a-b_c's\x85d", "", ""),
            (None, "no id at all " * 9, "a", None), (None, None, None, None)]
    return out + [out[7]] * 30 + [(7, out[8][1], "b", "s1"), out[-2]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    names = ("id", "row", "term", "n", "g", "score", "rank", "place", "part")
    return spark.createDataFrame(rows, DOCS).withColumns({n: F.lit(1) for n in names}).repartition(5)


ITEMS = ["alpha beta GAMMA delta", None, "", "x9 kappa x9 kappa", "漢字 new words here"]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in enumerate(ITEMS)], "item_id long, text string, row int")


def features(text):
    w = WORD.findall(lowered(text))
    return w, [" ".join(w[s : s + n]) for n in (1, 2, 3) for s in range(len(w) - n + 1)]


def plain_draw(rows, items, percent):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s, t = Counter(), Counter()
    for r in rows:
        s.update(map(bucket, features(r[1])[1]))
    for text in items:
        t.update(map(bucket, features(text)[1]))
    all_s, all_t = s.total(), t.total()
    out = []
    for doc_id, text, *_ in rows:
        w, f = features(text)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
            for b in map(bucket, f)
        )
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None, len(w)])
    fit = [r for r in out if r[5] >= 20]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("percent", [5, 37, 100, 0])
def test_resampling(docs, items, rows, percent):
    found = importance.resample(docs, items, percent=percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_draw(rows, ITEMS, percent)


def test_resampling_takes_empty_tables(docs, items, rows):
    assert importance.resample(docs.limit(0), items).count() == 0
    got = sorted(map(tuple, importance.resample(docs, items.limit(0)).collect()), key=repr)
    assert got == plain_draw(rows, [], 5)


def test_bisection_cuts_ties_by_the_next_column(spark):
    rnd = random.Random(5)
    values = [(rnd.choice([-(10**15), -3, 0, 0, 0, 7, 10**12]), rnd.randint(-2, 2), i) for i in range(200)]
    table = spark.createDataFrame(values, "a long, b long, c long").repartition(4)
    for wanted in (0, 1, 17, 60, 101, 199, 200):
        taken = table.where(importance.first_rows(table, [F.col("a"), F.col("b"), F.col("c")], wanted))
        assert sorted(map(tuple, taken.collect())) == sorted(values)[:wanted]
    v, below, equal = importance.threshold(table, F.col("a"), 30)
    assert below < 30 <= below + equal and sum(r[0] < v for r in values) == below


def plain_audit(rows, least=3, top=200):
    rows = [[x or "" for x in r[1:]] for r in rows]
    seen, often, group = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        w = TERM.findall(lowered(text))
        often[lang].update(w)
        seen[lang].update(set(w))
        group[lang, source].update(w)
    kept = {lang: sorted(t for t in seen[lang] if seen[lang][t] >= least) for lang in seen}

    def share(counts, terms):
        total = sum(counts[t] for t in terms)
        return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(terms)) for t in terms}

    p = {g: share(group[g], kept[g[0]]) for g in group}
    out = []
    for lang, source in group:
        own, q = p[lang, source], share(often[lang], kept[lang])
        pairs = [
            (sum((own[t] - x) ** 2 // x for t, x in p[g].items()), g[1]) for g in group if g[0] == lang and g[1] != source
        ]
        terms = [((own[t] - q[t]) ** 2 // q[t], t) for t in q if group[lang, source][t] and own[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(32, 4096), (2, 3), (1, 1)])
def test_audit(docs, rows, blocks):
    found = divergence.audit(docs, group_block=blocks[0], term_block=blocks[1])
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain_audit(rows)


def test_audit_limits(docs, rows):
    assert sorted(map(tuple, divergence.audit(docs, least=1, top=2).collect())) == plain_audit(rows, 1, 2)
    none = divergence.audit(docs, least=10**6)
    assert {r.value for r in none.collect()} == {0} and {r.part for r in none.collect()} == {"pair"}
    assert divergence.audit(docs.limit(0)).count() == 0


def test_counts_are_handed_on_in_parts(docs, rows):
    few = divergence.term_counts(docs.fillna("", ["text", "lang", "source"]).select("lang", "source", "text"), held=1)
    want = Counter()
    for _, text, lang, source in rows:
        for t in TERM.findall(lowered(text)):
            want[lang or "", source or "", t] += 1
    got = Counter()
    for r in few.collect():
        got[r.lang, r.source, r.term] += r.n
    assert got == want


def test_shares_are_exact(spark):
    rnd = random.Random(9)
    totals = [rnd.randint(1, 9 * 10**15) for _ in range(200)] + [1, 2, 1000]
    pairs = [(rnd.randint(0, t - 1), t) for t in totals]
    want = [1 + 10**9 * (c + 1) // t for c, t in pairs]
    c, t = np.array(pairs, dtype=np.int64).T
    assert divergence.shares(c, t).tolist() == want
    table = spark.createDataFrame(pairs, "c long, t long")
    got = table.select("c", "t", divergence.share(F.col("c"), F.col("t")).alias("p")).collect()
    assert sorted((r.c, r.t, r.p) for r in got) == sorted((c, t, p) for (c, t), p in zip(pairs, want, strict=True))
