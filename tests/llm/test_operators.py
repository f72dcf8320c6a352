"""Corpus operators against brute force on small tables with odd rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wickwork.llm import (
    byte_bpe,
    decontaminate,
    html_text,
    language_id,
    language_model,
    near_copies,
    nearest,
    shard,
    simhash,
    token_counts,
    warc,
)
from wickwork.session import BATCH_BYTES, MAX_BYTES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCES = {
    "en": "the quick brown fox jumps over the lazy dog while the old man reads a long book about ships",
    "fr": "le chat noir dort sur la grande table pendant que les enfants jouent dans le jardin ensoleillé",
    "de": "der kleine hund läuft schnell über die straße und die kinder spielen gerne im großen garten",
}


def sentence(rnd, lang, n):
    words = SENTENCES[lang].split()
    return " ".join(rnd.choice(words) for _ in range(n))


def texts():
    rnd = random.Random(3)
    out = [sentence(rnd, lang, rnd.randint(5, 60)) for lang in SENTENCES for _ in range(25)]
    out += [None, "", "   ", "\n\t", "123 !!", "one", "Two Words", "É Ä ß 漢字 كتاب \U0001d400 ԰ա",
            "<|endoftext|> a<|endoftext|>", "x" * 20000, "word " * 5000, "a　b\x85c\x1cd", "İSTANBUL"]
    out += [out[0]] * 40 + [out[1] + " again", out[1].upper()]
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, ["en", "fr", "de"][i // 25] if i < 75 else None, "s", 0) for i, t in enumerate(texts())]
    return [*out, out[3], out[3], (None, "no id here", "en", None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = spark.createDataFrame(rows, DOCS)
    names = ("row", "id", "key", "fp", "words", "h", "n", "piece", "window", "label")
    return table.withColumns({name: F.lit(1) for name in names}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def bag(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def expected(rows, of):
    return sorted([of(r[0], r[1]) for r in rows], key=repr)


# ------------------------------------------------------------------ BPE
def library():
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_equals_the_library(docs, rows, empty):
    own = library()

    def of(i, text):
        ids = own.encode_ordinary(text or "")
        return i, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode()), ids

    found = byte_bpe.encode_documents(docs, with_ids=True)
    assert bag(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == expected(rows, of)
    assert byte_bpe.encode_documents(empty).count() == 0


def test_bpe_edits_and_appends():
    own, encoder = library(), byte_bpe.encoder(public_tokenizers.path(byte_bpe.VOCABULARY))
    rnd = random.Random(1)
    letters = "ab thei  \n\t's'llé1 2漢ß!?-　"
    for _ in range(300):
        text = byte_bpe.EditableText(encoder, "".join(rnd.choices(letters, k=rnd.randint(0, 60))))
        for _ in range(4):
            a = rnd.randint(0, len(text.text))
            b = rnd.randint(a, min(len(text.text), a + 5))
            new = "".join(rnd.choices(letters, k=rnd.randint(0, 5)))
            want = text.text[:a] + new + text.text[b:]
            text.edit(a, b, new)
            assert text.text == want and text.ids() == own.encode_ordinary(want)
        text.append("end")
        assert text.ids() == own.encode_ordinary(text.text)


def test_an_edit_recomputes_near_it_only():
    encoder = byte_bpe.encoder(public_tokenizers.path(byte_bpe.VOCABULARY))
    data = bytes(random.Random(2).choices(b"abcdefghij", k=5000))
    table = encoder.table(data)
    after, changed, done = encoder.edited(data, table, 2500, 2502, b"xyz")
    assert changed == encoder.table(after) and done < 500


def test_token_counts_equal_the_library(docs, rows, empty):
    own = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))

    def of(i, text):
        n = len(own.encode(text or "", add_special_tokens=False).ids)
        return i, len((text or "").encode()), n, n > 1024

    for limit in (token_counts.LIMIT, 20, 1):
        found = token_counts.count_tokens(docs, limit=limit)
        assert bag(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected(rows, of)
    assert token_counts.count_tokens(empty).count() == 0


# ------------------------------------------------------- language model
def held_out(i, n, r):
    return zlib.crc32(str("" if i is None else i).encode()) % n == r


def lm_words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_encoder_keeps_a_bounded_number_of_encodings(monkeypatch):
    """Forgetting changes no ids, whatever the order in which chunks come back."""
    for name in ("CHUNK_CACHE", "PIECE_CACHE", "PAIR_CACHE"):
        monkeypatch.setattr(byte_bpe, name, 8)
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    own, wide = byte_bpe.encoder.__wrapped__(path), byte_bpe.encoder(path)
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdeé,.", k=rnd.randint(1, 9))) for _ in range(60)]
    for word in rnd.choices(words, k=600):
        assert list(own.chunk(word)) == wide.encode(word)
        for kept in (own.chunk_cache, own.piece_cache):
            assert len(kept.new) <= 8 and len(kept.old) <= 8
        assert len(own.follows) <= 8


def test_idle_workers_keep_no_encodings(spark, docs):
    """Workers are used again by later stages, which would run beside what is kept."""
    for _ in range(2):
        byte_bpe.encode_documents(docs.repartition(8)).collect()
    path = public_tokenizers.path(byte_bpe.VOCABULARY)

    def held(batches):
        own = byte_bpe.encoder(path)
        kept = (own.chunk_cache, own.piece_cache)
        n = len(own.follows) + sum(len(x.new) + len(x.old) for x in kept)
        yield from (language_model.pa.record_batch([[n]], names=["n"]) for _ in batches)

    found = spark.range(0, 64, 1, 8).mapInArrow(held, "n long").collect()
    assert found and all(r.n == 0 for r in found)


@pytest.mark.parametrize("options", [{}, {"limit": 3}, {"order": 3, "segments": 16}])
def test_language_model(docs, rows, options):
    train = Counter(w for i, t, *_ in rows if not held_out(i, 5, 1) for w in lm_words(t))
    n, v = train.total(), len(train)
    found = language_model.score_documents(docs, **options).collect()
    by_text = {}
    for i, t, *_ in rows:
        own = lm_words(t)
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        by_text.setdefault(i, []).append((held_out(i, 5, 1), len(own), sum(train[w] > 0 for w in own), n, base))
    assert len(found) == len(rows)
    for r in found:
        near = [b for b in by_text[r.doc_id] if b[:4] == (r.held_out, r.n_tokens, r.n_known, r.train_tokens)]
        assert any(b[4] == pytest.approx(r.base_score, rel=1e-9) for b in near)
        assert r.score <= 0
    known = [r for r in found if not r.held_out and r.n_tokens > 10]
    assert sum(r.score for r in known) > sum(r.base_score for r in known)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model_takes_texts_in_blocks(monkeypatch, order):
    """A block's n-grams are those of its texts, and each of its distinct words is hashed once."""
    texts = [None, "", "a b a", "B a", "c " * 50, "a"]
    (block,) = language_model._blocks(texts, order, 1 << 20)
    hashed, plain = [], language_model.xxhash.xxh64_intdigest
    digest = lambda word: hashed.append(word) or plain(word)
    monkeypatch.setattr(language_model.xxhash, "xxh64_intdigest", digest)
    words, *longer = block.ngram_hashes(order)
    monkeypatch.undo()
    assert sorted(w for w in hashed if w != b" ") == [b"", b"a", b"b", b"c"]
    found = [words[block.codes], *longer]
    by_gram = [{} for _ in range(order)]
    for text, start, n in zip(texts, block.starts, block.lengths, strict=True):
        own = [b" "] * (order - 1) + language_model.words_of(text)
        assert n == len(own) - order + 1
        for k in range(n):
            for length in range(order):
                gram = tuple(own[k + order - 1 - length : k + order])
                by_gram[length].setdefault(gram, set()).add(int(found[length][start + k]))
    hashes = [h for grams in by_gram for h in grams.values()]
    assert all(len(h) == 1 for h in hashes) and len(set.union(*hashes)) == len(hashes)


def test_language_model_cuts_words_as_bytes(monkeypatch):
    """Words of many texts at once are those of each, whatever parts they are cut in."""
    odd = [None, "", " ", "a", " A  b\x1cc\x0bd ", "É Ä\u3000ß\x85x\r\n", "\x0b\x0c", "x " * 9, *texts()]
    monkeypatch.setattr(language_model, "CUT_BYTES", 40)
    array = language_model.pa.array(["before", *odd]).slice(1)
    parts = list(language_model.cut_texts(array))
    assert [t for part in parts for t in part.to_pylist()] == odd and len(parts) > 20
    found = [language_model.cut_words(part) for part in parts]
    plain = [[*(t or "").encode().lower().split(), b""] for t in odd]
    assert [w for words, _ in found for w in words.to_pylist()] == [w for own in plain for w in own]
    assert [n for _, lengths in found for n in lengths] == [len(own) for own in plain]


def test_language_model_counts_go_as_a_row_for_each_slot(docs, rows):
    """A block's n-gram counts are not shuffled as a row for each n-gram."""
    found = language_model.ngram_counts(docs.coalesce(1).select("text"), 2, 16).collect()
    assert len(found) == len({r.slot for r in found}) <= 16
    counts = {}
    for r in found:
        h, c = np.frombuffer(r.h, dtype=np.uint64), np.frombuffer(r.c, dtype=np.uint32)
        assert len(h) == len(c) and (language_model.segment_of(h, 16) == r.slot).all()
        for x, n in zip(h.tolist(), c.tolist(), strict=True):
            counts[x] = counts.get(x, 0) + n
    grams = Counter()
    for _, t, *_ in rows:
        own = [b" ", *language_model.words_of(t)]
        grams.update([(b" ",), *((w,) for w in own[1:]), *zip(own, own[1:], strict=False)])
    assert sorted(counts.values()) == sorted(grams.values())


def test_packed_rows_are_cut_at_a_number_of_ngrams(monkeypatch):
    monkeypatch.setattr(language_model, "PACKED", 3)
    slot = np.array([0, 0, 0, 0, 2, 2, 5], dtype=np.uint16)
    h, c = np.arange(7, dtype=np.uint64), np.arange(7, dtype=np.uint32) + 1
    found = [r for batch in language_model._packed(slot, h, c) for r in batch.to_pylist()]
    assert [r["slot"] for r in found] == [0, 0, 2, 5]
    assert b"".join(r["h"] for r in found) == h.tobytes() and b"".join(r["c"] for r in found) == c.tobytes()


def test_language_model_filter_in_several_passes(docs):
    one = bag(language_model.score_documents(docs, segments=16), "doc_id", "n_tokens", "score")
    many = bag(language_model.score_documents(docs, segments=16, held_bytes=600), "doc_id", "n_tokens", "score")
    assert one == many


def test_language_model_counts_and_empty_table(empty):
    assert language_model.score_documents(empty).count() == 0
    values, c = language_model.level_values(), np.arange(1, 5000)
    q = language_model.levels(c)
    assert (np.diff(q) >= 0).all() and values[1] == 1.0
    assert (np.abs(values[q] / c - 1) < 0.5).all()


# ------------------------------------------------------------- nearest
def test_nearest_equals_brute_force(spark):
    rnd = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in rnd.normal(size=(400, 16)).astype(np.float32)]
    table = [(i, v) for i, v in enumerate(vectors)] + [(400 + i, vectors[7]) for i in range(60)]
    good = list(table)
    table += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None, *vectors[0][1:]]),
              (904, [float("inf"), *vectors[0][1:]]), (None, vectors[1]), (905, []), (1000, [1.0, 2.0])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>").withColumn("id", F.lit(0))
    want = []
    for q, v in good:
        if q % 20 == 0:
            near = sorted((math.dist(v, w), i) for i, w in good if i != q)[:10]
            want += [(q, k + 1, i, d) for k, (d, i) in enumerate(near)]
    for block in (4096, 7):
        found = nearest.nearest(df, F.col("vec_id") % 20 == 0, block=block).collect()
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)
        hits = {x[:1] + x[2:3] for x in got} & {x[:1] + x[2:3] for x in want}
        assert len(got) == len(want) and len(hits) >= 0.99 * len(want)
        for a, b in zip(got, sorted(want), strict=True):
            assert a[3] == pytest.approx(b[3], abs=1e-6)
    assert nearest.nearest(df.limit(0), F.lit(True)).count() == 0
    assert nearest.nearest(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2


@pytest.mark.parametrize("block", [4096, 1])
def test_nearest_answers_each_vector_of_a_repeated_query(spark, block):
    table = [(0, [0.0, 1.0]), (0, [9.0, 1.0]), (0, [9.0, 1.0]), *((i, [float(i), 1.0]) for i in range(1, 9))]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    found = nearest.nearest(df, F.col("vec_id") == 0, k=3, block=block).collect()
    want = [(1, 1, 1.0), (1, 8, 1.0), (2, 2, 2.0), (2, 7, 2.0), (3, 3, 3.0), (3, 6, 3.0)]
    assert sorted((r["rank"], r.vec_id, round(r.score, 6)) for r in found) == want


def test_codes_bound_inner_products():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(2000, 64))
    words, norm, align = nearest.encode(x, np.zeros(64))
    bits = np.unpackbits(words.view(np.uint8), axis=1, count=64)
    q = x[0] / np.linalg.norm(x[0]) @ nearest.rotation(64)
    estimate = (bits * 2.0 - 1) @ q / 8 / align
    true = x @ x[0] / norm / np.linalg.norm(x[0])
    slack = nearest.EPSILON * np.sqrt((1 - align**2) / align**2 / 63)
    assert (np.abs(estimate - true) <= slack + 1e-9).mean() > 0.999


@pytest.mark.parametrize("d", [1, 7, 64, 100])
def test_bit_counts_are_products_with_the_rounded_query(d):
    rnd = np.random.default_rng(8)
    x, q = rnd.normal(size=(500, d)), rnd.normal(size=(40, d))
    q /= np.linalg.norm(q, axis=1)[:, None]
    words, _, align = nearest.encode(x, np.zeros(d))
    signs = np.unpackbits(words.view(np.uint8), axis=1, count=d) * 2.0 - 1
    planes = nearest.Planes(q)
    got = np.hstack([planes.products(words, slice(i, i + 16)) for i in range(0, 40, 16)])
    error = np.abs(got - signs @ q.T / np.sqrt(d))
    assert (error <= nearest.EPSILON * planes.left / np.sqrt(d) + 1e-9).mean() > 0.999
    # What is left of a query is what rounding to so many bits leaves.
    assert (planes.left <= planes.step * np.sqrt(d) / 2 + 1e-12).all()


# ---------------------------------------------------- decontamination
def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination_equals_brute_force(spark, docs, rows, empty, limit):
    long = next(t for _, t, *_ in rows if t and len(t.split()) > 30)
    items = [(1, long), (10, " ".join(long.split()[3:16]).upper()), (2, "Two, words"), (3, "one"), (4, ""),
             (5, None), (6, "nothing like it anywhere at all in any of these texts here"), (7, "word " * 12),
             (None, "no id"), (1, long), (8, "Ä ß")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1))
    windows = {}
    for i, t in items:
        w = plain_words(t)
        for s in range(max(len(w) - 10, 0) + 1) if w else ():
            windows.setdefault(tuple(w[s : s + 10]), set()).add(i)
    sizes = {len(w) for w in windows}

    def of(i, text):
        w, hit, owners = plain_words(text), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if found := windows.get(tuple(w[s : s + size])):
                    hit |= set(range(s, s + size))
                    owners |= found
        names = sorted(str(x) for x in owners - {None})
        return i, len(w), len(hit), len(names), sha(",".join(names).encode()), bool(hit)

    found = decontaminate.decontaminate(docs, table, broadcast_bytes=limit)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert bag(found, *names) == expected(rows, of)
    assert decontaminate.decontaminate(empty, table).count() == 0
    none = decontaminate.decontaminate(docs, table.limit(0))
    assert none.count() == len(rows) and none.where("contaminated").count() == 0


# ------------------------------------------------------------- sharding
def test_sharding(docs, rows, empty):
    found = shard.shard(docs).collect()
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows]
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in found], key=repr) == sorted(want, key=repr)
    by = {}
    for r in found:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(24)) and len(by) == 24
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted(r.row_number for r in found) == list(range(len(rows)))
    permutation = shard.Permutation(len(rows))
    assert all(permutation.row_at(r.shard, r.slot) == r.row_number for r in found)
    assert bag(shard.shard(docs.repartition(5)), "doc_id", "text_crc32", "shard", "slot") == sorted(
        [(r.doc_id, r.text_crc32, r.shard, r.slot) for r in found], key=repr
    )
    assert shard.shard(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutations_are_bijections(n):
    permutation = shard.Permutation(n)
    places = permutation(np.arange(n))
    assert sorted(places) == list(range(n))
    assert (permutation(places, back=True) == np.arange(n)).all()


# ---------------------------------------------------------- language ID
def test_language_id(docs, rows, empty, spark):
    found = language_id.identify(docs, keep=["doc_id"]).select("row.doc_id", "held_out", "lang_pred", "score", "languages").collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1 and r.held_out == held_out(r.doc_id, 4, 2)
        if r.doc_id is not None and r.doc_id < 75:
            assert r.lang_pred == ["en", "fr", "de"][r.doc_id // 25]
    texts_of = {i: t for i, t, *_ in rows}
    und = {r.doc_id for r in found if r.lang_pred == "und"} - {None}
    assert und == {i for i, t in texts_of.items() if i is not None and not re.search(r"[^\W\d_]", t or "")}
    assert language_id.identify(empty).count() == 0
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}
    rnd = random.Random(9)
    both = sentence(rnd, "en", 300) + " " + sentence(rnd, "de", 100)
    mixed = docs.select("doc_id", "text", "lang").union(
        spark.createDataFrame([(-1, both, None)], "doc_id long, text string, lang string")
    )
    row = language_id.identify(mixed).where("row.doc_id = -1").first()
    assert row.lang_pred == "en" and set(row.languages) == {"en", "de"} and 0.6 < row.score < 0.9


# -------------------------------------------------------------- SimHash
def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def plain_components(fps, radius):
    label = {f: f for f in fps}

    def find(f):
        while label[f] != f:
            f = label[f]
        return f

    ordered = sorted(fps)
    for x, a in enumerate(ordered):
        for b in ordered[x + 1 :]:
            if (a ^ b).bit_count() <= radius:
                label[find(b)] = find(a)
    return {f: find(f) for f in fps}


def test_simhash_groups(docs, rows, empty):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    root = plain_components(set(fps), 3)
    least = {}
    for (i, *_), fp in zip(rows, fps, strict=True):
        if i is not None:
            least[root[fp]] = min(i, least.get(root[fp], i))
    want = sorted([(i, f"{fp:016x}", least.get(root[fp])) for (i, *_), fp in zip(rows, fps, strict=True)], key=repr)
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_fingerprint("fp").alias("f"), "component_id")
    assert bag(found, "doc_id", "f", "component_id") == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("radius", [1, 3])
def test_links_equal_all_pairs(spark, radius):
    rnd = random.Random(4)
    values = {rnd.getrandbits(64) for _ in range(300)}
    for centre in (rnd.getrandbits(64), 0):
        values |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for _ in range(150)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {(r.a, r.b) for r in simhash.links(nodes, radius).collect()}
    ordered = sorted(signed)
    want = {(a, b) for x, a in enumerate(ordered) for b in ordered[x + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    assert found == want
    # The components of all links, from about one link for each node.
    up = {v: v for v in signed}
    for a, b in want:
        old, new = max(up[a], up[b]), min(up[a], up[b])
        up = {v: new if u == old else u for v, u in up.items()}
    linked = {r.node: r.root for r in simhash.linked(nodes, radius).collect()}
    assert linked == {v: u for v, u in up.items() if u != v}


# ---------------------------------------------------------- near copies
def word_shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def plain_groups(sets):
    """Components of the pairs with Jaccard similarity of 0.8 or more, by all pairs."""
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def partition(names, groups):
    out = {}
    for name, g in zip(names, groups, strict=True):
        out.setdefault(g, set()).add(name)
    return {frozenset(s) for s in out.values()}


def edited_texts():
    rnd = random.Random(11)
    base = [[f"w{rnd.randint(0, 400)}" for _ in range(n)] for n in (60, 150, 400)]
    out = [None, "", "one two", "ONE  two", "one two three"]
    for words in base:
        for _ in range(30):
            new = list(words)
            for at in rnd.sample(range(len(new)), rnd.randint(0, max(len(new) // 25, 2))):
                new[at] = f"n{rnd.randint(0, 999)}"
            out.append(" ".join(new))
    return out


def test_near_copies_equal_all_pairs(spark):
    items = [(f"k{i}", t) for i, t in enumerate(edited_texts())]
    df = spark.createDataFrame([*items, items[10], items[10]], "key string, text string").repartition(3)
    found = near_copies.near_copies(df).collect()
    sets = [word_shingles(t) for _, t in items]
    want = partition([k for k, _ in items], plain_groups(sets))
    assert partition([r.key for r in found], [r.group for r in found]) == want
    assert len(found) == len(items) and 5 < len(want) < len(items)


def test_near_duplicates_stage_equals_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    groups = partition([i for i, _ in rows], plain_groups([word_shingles(t) for _, t in rows]))
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, folder)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(map(min, groups))


def test_pipeline_drops_near_copies_with_a_few_edits(spark, folder):
    """A similarity of 0.8 or more on five words is enough, whatever the fingerprints."""
    words = [f"w{i}" for i in range(250)]
    edits = {1: [], 2: [30, 80, 130, 180, 230], 3: [20, 60, 100, 140], 4: range(10, 250, 20)}
    rows = [(i, " ".join(f"x{i}" if k in at else w for k, w in enumerate(words))) for i, at in edits.items()]
    apart = [(plain_fingerprint(rows[0][1]) ^ plain_fingerprint(t)).bit_count() for _, t in rows[1:]]
    assert min(apart) > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, folder)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


# ----------------------------------------------------------------- pages
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">One</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site.</div><!-- x --><div class="ad">Buy this now today.</div>
<article><header><h1>The title &amp; more</h1></header><p><b>First  paragraph of the text with
several words in it.<br><p>Second one has a <a href="/x">link</a> within the words of it.</p>
<form><label>Your mail</label><input></form><p>Short end.</p></article>
<aside>Other stories of the day are listed here.</aside>
<section id="comments"><p>I liked this article very much, thank you for it.</p></section>
<footer>&copy; 2024 example.com &middot; all rights</footer></body>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>"),
            (4, "x", "<article>" + "<p>some words of a text here</p>" * 500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = bag(html_text.extract(df), "page_id", "url", "text", "n_chars")
    main = ("The title & more First paragraph of the text with several words in it. "
            "Second one has a link within the words of it. Short end.")  # fmt: skip
    want = [(1, "u", main), (1, "u", main), (2, None, ""), (None, "v", ""), (3, "w", ""),
            (4, "x", " ".join(["some words of a text here"] * 500))]
    assert found == sorted([(*w, len(w[2])) for w in want], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("body", ["<body>", "", "<body class=x>"])
def test_an_open_head_ends_at_the_body(body):
    head = "<html><head><meta charset=utf-8><title>T</title><script>var a;</script>"
    page = f"{head}{body}<article><h1>A title</h1><p>Some words of a text here.</p></article>"
    tree = html_text.trained_tree()
    assert html_text.main_text(page, tree) == "A title Some words of a text here."
    unseen = page.replace("<script>", "<template><p>Unseen words</p></template><script>")
    assert html_text.main_text(unseen, tree) == html_text.main_text(page, tree)


@pytest.mark.parametrize(
    "wrapper, kept",
    [("<div class='content has-sidebar'>", True), ("<div id='page' class='with-sidebar'>", True),
     ("<aside>", False), ("<div role=navigation>", False)],
)
def test_a_name_of_a_wrapper_does_not_lose_the_article(wrapper, kept):
    words = "Some words of a text here."
    page = f"<body>{wrapper}<article><h1>A title</h1><p>{words}</p></article></div>"
    tree = html_text.trained_tree()
    assert html_text.main_text(page, tree) == (f"A title {words}" if kept else "")
    comment = f"<body><div id=comments><article class=comment><p>{words}</p></article></div>"
    assert html_text.main_text(comment, tree) == ""


def test_the_tree_fits_its_table():
    tree = html_text.trained_tree()
    assert all((html_text.classify(tree, r[:-1]) >= 0.5) == r[-1] for r in html_text.ROWS)


# ------------------------------------------------------------------ WARC
def test_archives(spark):
    big, odd = "é" * 600, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60
    rows = [(1, "http://a", big), (2, None, big), (5, "http://c\r\nX: y", big), (3, "http://d", "small"),
            (4, "http://d", "small"), (6, "e", None), (7, "f", ""), (8, "g", odd), (9, "g", odd), (None, "h", odd),
            (9, "g", odd)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).repartition(3)
    found = warc.archive_pages(df).collect()
    want = []
    seen = set()
    for i, _, html in rows:
        data = (html or "").encode()
        top = max((r[0] or -1 for r in rows if r[2] == html), default=None)
        again = len(data) >= 1000 and (i != top or (i, html) in seen)
        seen.add((i, html))
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top if again else None))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_transactions_link_either_way(spark):
    fields = "warc_type string, record_id string, concurrent_to array<string>, body string"
    rows = [("response", "r1", [], None), ("request", "q1", ["r1"], "a"), ("metadata", "m1", ["r1"], "b"),
            ("response", "r2", ["q2"], None), ("request", "q2", [], "c"), ("metadata", "m9", ["lost"], "d"),
            ("revisit", "r3", None, None)]
    found = warc.transactions(spark.createDataFrame(rows, fields)).collect()
    got = {r.capture: (r.request and r.request.record_id, r.metadata and r.metadata.record_id) for r in found}
    assert got == {"r1": ("q1", "m1"), "r2": ("q2", None), "r3": (None, None)}


def test_records_cut_off_raise():
    good = b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, _, b in warc.parse_records(good * 2)] == [b"abc"] * 2
    for bad in (good[:-6], b"junk" + good):
        with pytest.raises(ValueError):
            list(warc.parse_records(bad))


# -------------------------------------------------------------- pipeline
def test_pipeline_equals_its_stages_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    named = language_id.identify(docs).where("lang_pred != 'und' and score >= 0.5").select("row.doc_id")
    kept = sorted(r.doc_id for r in named.collect())
    first = map(min, partition(kept, plain_groups([word_shingles(rows[i]) for i in kept])))
    windows = {tuple(w[s : s + 10]) for w in map(plain_words, items) for s in range(max(len(w) - 10, 0) + 1) if w}

    def clean(text):
        w = plain_words(text)
        return not any(tuple(w[s : s + 10]) in windows for s in range(len(w)))

    own = library()
    want = [(i, own.encode_ordinary(rows[i])) for i in sorted(first) if clean(rows[i])]
    found = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.ids) for r in found.collect()) == want
    assert 0 < len(want) < len(rows)


@pytest.mark.parametrize("number", [0, 1, 3])
def test_pipeline_sends_texts_in_bounded_batches(spark, folder, number):
    """A batch is not as many MB as 10000 texts have, unless the session says so."""
    own = spark.newSession()
    docs = own.read.parquet(f"{folder}/documents.parquet")
    corpus_pipeline.STAGES[number][1](own, docs, folder)

    def size(batches):
        yield from (language_model.pa.record_batch([[b.nbytes]], names=["n"]) for b in batches)

    wide = own.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
    sizes = [r.n for r in wide.mapInArrow(size, "n long").collect()]
    assert sum(sizes) > 6000 * 5000 and max(sizes) < 1.1 * BATCH_BYTES
    other = spark.newSession()
    other.conf.set(MAX_BYTES, "1m")
    corpus_pipeline.STAGES[number][1](other, other.read.parquet(f"{folder}/documents.parquet"), folder)
    assert other.conf.get(MAX_BYTES) == "1m"


def test_language_id_sends_a_kept_text_once(docs):
    whole = language_id.identify(docs, keep=["doc_id", "text"])
    sent = whole._jdf.queryExecution().analyzed().children().apply(0).schema().fieldNames()
    assert list(sent) == ["row", "held_out"]
    only = language_id.identify(docs, keep=["doc_id"])
    both = [sorted((str(r.row.doc_id), r.held_out, r.lang_pred, r.score) for r in x.collect()) for x in (whole, only)]
    assert both[0] == both[1]


def test_signs_that_are_no_letters_have_no_language(spark, docs):
    signs = ["½ ² ³", "Ⅷ Ⅻ", "① ② 3", "1234 -- !!", "_ _"]
    more = spark.createDataFrame([(9000 + i, t, None, "s", 0) for i, t in enumerate([*signs, "é"])], DOCS)
    found = language_id.identify(docs.select(*more.columns).union(more), keep=["doc_id"])
    got = {r.row.doc_id: (r.lang_pred, r.score) for r in found.where("row.doc_id >= 9000").collect()}
    assert [got[9000 + i] for i in range(len(signs))] == [("und", 0.0)] * len(signs)
    assert got[9000 + len(signs)][0] in SENTENCES


def test_pipeline_stages_take_empty_tables(spark, folder, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_pipeline_stages_take_repeated_rows_missing_ids_and_clashing_names(spark, folder):
    words = " ".join(f"w{i}" for i in range(40))
    near = [(5, words, "x"), (5, words, "x"), (3, words, "y"), (3, words, "z"), (None, words, "x")]
    other = [(None, "quite another text here", "x")] * 2 + [(9, None, "x"), (7, "", "x")]
    docs = spark.createDataFrame(near + other, "doc_id long, text string, key string").withColumns(
        {"row": F.lit(1), "id": F.lit(2)}
    )
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, words), (None, "quite another text here"), (7, "")], key=str
    )
    item = spark.read.parquet(f"{folder}/benchmark.parquet").where("length(text) > 100").first().text
    mixed = docs.unionByName(docs.limit(1).withColumn("text", F.lit("so " + item)))
    clean = corpus_pipeline.drop_contaminated(spark, mixed, folder)
    assert clean.columns == docs.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))


# ------------------------------------------------------------- row keys
def test_results_do_not_depend_on_how_files_are_cut(spark, folder, tmp_path):
    """Two reads of one table, cut in different places, number its rows alike."""
    from wickwork.llm.common import with_rows

    docs = spark.read.parquet(f"{folder}/documents.parquet").union(spark.read.parquet(f"{folder}/documents.parquet"))
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def keys(bytes_):
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        try:
            rows = with_rows(spark.read.parquet(str(tmp_path / "docs")).select("doc_id", "text"), "_at")
            return rows.rdd.getNumPartitions(), bag(rows, "doc_id", "_at")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)

    (one, few), (many, small) = keys("128m"), keys("16k")
    assert one < many and few == small and len({at for _, at in few}) == len(few)
    # any other table is stored first
    made = with_rows(docs.groupBy("doc_id").agg(F.min("text").alias("text")), "_at")
    assert made.select("_at").distinct().count() == made.count()
