"""n-gram language model whose counts are in a log-frequency Bloom filter.

An n-gram with count c is put into the filter with each level 1 to
1 + log_base(c); its count is read back by asking for level 1, 2, ... until one
is missing. The filter errs to higher levels only, and seldom by more than one.

The filter is cut into segments by the n-gram's hash, and segments are dealt over
SLOTS. Counts of a block of texts are shuffled as one row for each slot. A slot's
segments are built together from all of its n-grams and sized by their number, so
building needs no merging and no size guessed before. Workers hold as many segments at a time as
fit ``HELD_BYTES``; a larger filter takes several passes, each of which adds
what it finds to the counts that the documents carry.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from wickwork.llm.common import first_row_number, fold, small_batches
from wickwork.llm.frequent import LIMIT, frequent
from wickwork.session import materialise

FOLDS, HELD_OUT = 5, 1
ORDER = 2
BASE = 1.5
SEGMENTS = 1 << 12
# Segments are dealt over so many rows of a block's counts.
SLOTS = 1 << 10
# N-grams that are packed into rows at a time.
PACKED = 1 << 24
BITS_PER_LEVEL = 6
PROBES = 4
PRIOR = 8.0
HELD_BYTES = 256 << 20
# Texts that are scored at a time.
TEXTS = 2048
# Bytes of texts that are cut into words at a time, or one text.
CUT_BYTES = 1 << 20
# No word is empty, so the empty word is the end; none holds a space.
START = b" "

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts, each text's followed by the end, and how many
    each text has."""
    texts = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    # A split after a last space leaves an empty word, as one of an empty text does: the end.
    last = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ")
    words = pc.ascii_split_whitespace(pc.binary_join_element_wise(pc.ascii_lower(texts), last, ""))
    return words.flatten().cast(pa.binary()), pc.list_value_length(words).to_numpy(zero_copy_only=False)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words and the end of one text."""
    return cut_words(pa.array([text], pa.string()))[0].to_pylist()


def cut_texts(texts: pa.Array):
    """Parts of at most CUT_BYTES, or one text."""
    sizes = pc.fill_null(pc.binary_length(texts.cast(pa.string())), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CUT_BYTES, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX2
    return h ^ (h >> np.uint64(29))


class Block:
    """Some texts as numbers: ``words`` has their distinct words, ``codes`` the word at
    each place of the texts laid end to end, ``starts`` each text's first place."""

    def __init__(self, parts: list[pa.Array], lengths: list[np.ndarray]):
        coded = pa.concat_arrays(parts).dictionary_encode()
        self.words, self.codes = coded.dictionary, coded.indices.to_numpy()
        self.lengths = np.concatenate(lengths).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def plain_words(self) -> list[bytes]:
        return self.words.to_numpy(zero_copy_only=False).tolist()

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of each text; none is empty, as each has its end."""
        return np.add.reduceat(values, self.starts)

    def ngram_hashes(self, order: int) -> list[np.ndarray]:
        """The hash of each distinct word, then for each length 2..order that of the
        n-gram that ends at each place. Words before a text's first are START."""
        each = map(xxhash.xxh64_intdigest, self.plain_words())
        each = np.fromiter(each, dtype=np.uint64, count=len(self.words))
        out, unit = [scramble(each)], each[self.codes]
        last = out[0][self.codes]
        place = np.arange(len(unit)) - np.repeat(self.starts, self.lengths)
        for n in range(1, order):
            back = np.full(len(unit), xxhash.xxh64_intdigest(START), dtype=np.uint64)
            back[n:] = unit[:-n]
            back[place < n] = xxhash.xxh64_intdigest(START)
            last = scramble(last * MIX + back + np.uint64(n))
            out.append(last)
        return out


def start_hashes(order: int) -> np.ndarray:
    """Hashes of START, START START, ...: the contexts before the first word."""
    start = np.uint64(xxhash.xxh64_intdigest(START))
    out = [scramble(np.array([start]))]
    for n in range(1, order - 1):
        out.append(scramble(out[-1] * MIX + start + np.uint64(n)))
    return np.concatenate(out)[: order - 1]


def levels(counts: np.ndarray, base: float = BASE) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def level_values(base: float = BASE, most: int = 128) -> np.ndarray:
    """The mean count of each level; 0 for level 0."""
    values = [0.0]
    for q in range(1, most):
        low, high = int(np.ceil(base ** (q - 1) - 1e-9)), int(np.ceil(base**q - 1e-9)) - 1
        values.append((low + max(low, high)) / 2)
    return np.array(values)


def _bits(h: np.ndarray, level: int, size: np.ndarray, probes=range(PROBES)) -> list[np.ndarray]:
    """The places of an n-gram at a level in a segment of ``size`` bits."""
    with np.errstate(over="ignore"):
        a = scramble(h + np.uint64(level) * MIX)
        b = scramble(a + MIX) | np.uint64(1)
        return [(a + np.uint64(i) * b) % size for i in probes]


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return (h >> np.uint64(40)) % np.uint64(segments)


def build_segments(counts: DataFrame, segments: int, base: float) -> DataFrame:
    """(segment, bits): filters from the rows (slot, h, c) of ``ngram_counts``."""

    def built(table):
        h, c = (
            np.concatenate([np.frombuffer(b.as_py(), dtype=kind) for b in table.column(name)])
            for name, kind in (("h", np.uint64), ("c", np.uint32))
        )
        order = np.argsort(h)
        h, first = np.unique(h[order], return_index=True)
        q = levels(np.add.reduceat(c[order].astype(np.int64), first), base).astype(np.uint8)
        seg = segment_of(h, segments).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        numbers, bits = [], []
        for part in np.split(order, np.flatnonzero(np.diff(seg[order])) + 1):
            own, own_q = h[part], q[part]
            size = max(64, -(-int(own_q.sum()) * BITS_PER_LEVEL // 64) * 64)
            flags = np.zeros(size, dtype=bool)
            for level in range(1, int(own_q.max()) + 1):
                for place in _bits(own[own_q >= level], level, np.uint64(size)):
                    flags[place] = True
            numbers.append(int(seg[part[0]]))
            bits.append(np.packbits(flags, bitorder="little").tobytes())
        return pa.table({"segment": pa.array(numbers, pa.int32()), "bits": pa.array(bits, pa.binary())})

    return counts.groupBy("slot").applyInArrow(built, "segment int, bits binary")


class Filter:
    """Some segments of the filter, as one array with the place of each."""

    def __init__(self, parts: list[tuple[int, bytes]], segments: int):
        self.segments = segments
        self.start = np.full(segments, -1, dtype=np.int64)
        self.size = np.ones(segments, dtype=np.uint64)
        at = 0
        for number, bits in parts:
            self.start[number], self.size[number] = at, len(bits) * 8
            at += len(bits)
        self.data = np.frombuffer(b"".join(bits for _, bits in parts), dtype=np.uint8)

    def levels_of(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram; 0 also for those in a segment that is not here."""
        seg = segment_of(h, self.segments).astype(np.int64)
        out = np.zeros(len(h), dtype=np.uint8)
        # Those of one segment follow each other, so that its bits are in the cache.
        alive = np.argsort(seg.astype(np.uint16) if self.segments <= 1 << 16 else seg, kind="stable")
        alive = alive[self.start[seg[alive]] >= 0]
        level = 1
        while len(alive):
            # About half of all bits are set: few n-grams that are missing pass two probes.
            for probes in (range(PROBES // 2), range(PROBES // 2, PROBES)):
                for_now, own = h[alive], seg[alive]
                start, size = self.start[own], self.size[own]
                here = np.ones(len(alive), dtype=bool)
                for place in _bits(for_now, level, size, probes):
                    place = place.astype(np.int64)
                    here &= (self.data[start + (place >> 3)] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                alive = alive[here]
            out[alive] = level
            level += 1
        return out


def _blocks(texts, order: int, most: int):
    """Blocks of texts, each of about ``most`` n-grams or one text."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    return _blocks_across([texts], order, most)


def _blocks_across(columns, order: int, most: int):
    """The same for the texts of several arrays; a block may go on from one to the next."""
    parts, lengths, size = [], [], 0
    for column in columns:
        for texts in cut_texts(column):
            words, own = cut_words(texts)
            parts.append(words)
            lengths.append(own)
            size += order * len(words) + (order - 1) * len(own)
            if size >= most:
                yield Block(parts, lengths)
                parts, lengths, size = [], [], 0
    if lengths:
        yield Block(parts, lengths)


def _packed(slot: np.ndarray, h: np.ndarray, c: np.ndarray):
    """Rows (slot, h, c) of n-grams in the order of their slots, the last two as bytes
    of all the slot's n-grams."""
    for start in range(0, len(slot), PACKED):
        own, *values = (x[start : start + PACKED] for x in (slot, h, c))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
        packed = [
            pa.Array.from_buffers(
                pa.binary(), len(cuts) - 1,
                [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))],
            )
            for x in values
        ]
        yield pa.record_batch([pa.array(own[cuts[:-1]], pa.int32()), *packed], names=["slot", "h", "c"])


def ngram_counts(texts: DataFrame, order: int, segments: int) -> DataFrame:
    """(slot, h, c): how often each n-gram of each length stands in a block of texts,
    one row for each slot of the block; h and c are the bytes of its n-grams' hashes
    (unsigned, 64 bits) and counts (unsigned, 32 bits)."""

    def counted(batches):
        for block in _blocks_across((batch.column(0) for batch in batches), order, 1 << 22):
            words, *longer = block.ngram_hashes(order)
            starts = start_hashes(order)
            h, c = np.unique(np.concatenate([starts, *longer]), return_counts=True)
            c[np.searchsorted(h, starts)] += len(block.starts) - 1
            h = np.concatenate([words, h])
            c = np.concatenate([np.bincount(block.codes, minlength=len(words)), c])
            slot = (segment_of(h, segments) % np.uint64(SLOTS)).astype(np.uint16)
            by_slot = np.argsort(slot, kind="stable")
            yield from _packed(slot[by_slot], h[by_slot], c[by_slot].astype(np.uint32))

    return texts.mapInArrow(counted, "slot int, h binary, c binary")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, often): the exact count of every word and of the end, as bytes."""

    def counted(batches):
        for block in _blocks_across((batch.column(0) for batch in batches), 1, 1 << 21):
            yield pa.record_batch(
                [block.words, pa.array(np.bincount(block.codes, minlength=len(block.words)))], names=["word", "often"]
            )

    rows = texts.mapInArrow(counted, "word binary, often long")
    return rows.groupBy("word").agg(F.sum("often").alias("often"))


def _groups(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Segments in groups of at most ``most`` bytes."""
    groups, room = [], 0
    for number, size in sizes:
        if not groups or size > room:
            groups.append([])
            room = most
        groups[-1].append(number)
        room -= size
    return groups or [[]]


def _held(filters: DataFrame, numbers: list[int]) -> list[tuple[int, bytes]]:
    own = filters.where(F.col("segment").between(numbers[0], numbers[-1])) if numbers else filters.limit(0)
    return [(r.segment, bytes(r.bits)) for r in own.toLocalIterator()]


def _log_probabilities(block: Block, found: np.ndarray, start: np.ndarray, order: int, n: int, v: int) -> np.ndarray:
    """Of each text the sum of log10 P(word | words before), each length smoothed by
    the next shorter.

    P(w | h) = (c(h w) + PRIOR * P(w | shorter h)) / (c(h) + PRIOR), from
    (c(w) + 0.5) / (n + 0.5 (v + 1)) for single words. c(h w) is at most c(h).
    """
    p = (np.minimum(found[0], n) + 0.5) / (n + 0.5 * (v + 1))
    for length in range(1, order):
        # The context of a word is the n-gram that ends one word before.
        context = np.roll(found[length - 1], 1)
        context[block.starts] = start[length - 1]
        p = (np.minimum(found[length], context) + PRIOR * p) / (context + PRIOR)
    return block.sums(np.log10(np.minimum(p, 1.0)))


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    base: float = BASE,
    segments: int = SEGMENTS,
    held_bytes: int = HELD_BYTES,
    limit: int = LIMIT,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row
    for every row of ``docs``, repeated rows and missing ids included.

    Learns from rows whose crc32(id) modulo 5 is not 1; a missing id counts as
    empty text. A missing text is an empty one, whose only token is the end.
    base_score is exact. Without training rows N and V are 0, every word is
    unknown and base_score is 0. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
    )
    learned = rows.where(~F.col("held_out")).select("text")
    words = materialise(word_counts(learned), "lm-words")
    total = words.agg(F.sum("often").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v
    filters = materialise(build_segments(ngram_counts(learned, order, segments), segments, base), "lm-filter")
    sizes = filters.select("segment", F.octet_length("bits").alias("b")).orderBy("segment").collect()
    groups = _groups([(r.segment, r.b) for r in sizes], held_bytes)

    known = frequent(words, "word", "often", "often", limit)
    gains = {bytes(w): float(np.log10((c + 0.5) / (n + 0.5 * (v + 1)))) for w, c in known.items()}
    numbered = rows
    for number, group in enumerate(groups):
        model = Filter(_held(filters, group), segments), level_values(base), order, n, v
        numbered = _scoring_pass(
            numbered, model, gains if not number else None, number == len(groups) - 1
        )
        numbered = materialise(numbered, "lm-documents")
    rare = numbered.select("row", F.explode(F.arrays_zip("words", "times")).alias("p")).select(
        "row", F.col("p.words").alias("word"), F.col("p.times").alias("times")
    )
    gain = F.log10((F.col("often") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    sums = (
        rare.join(words, "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("rare_known"),
            F.sum(F.col("times") * (gain - F.lit(_unseen(n, v)))).alias("rare_gain"),
        )
    )
    return (
        numbered.drop("words", "times")
        .join(sums, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.col("base_score") + F.coalesce("rare_gain", F.lit(0.0))).alias("base_score"),
            "score",
        )
    )


def _unseen(n: int, v: int) -> float:
    return float(np.log10(0.5 / (n + 0.5 * (v + 1))))


def _exact_part(block: Block, gain_of, unseen: float) -> dict[str, pa.Array]:
    """The part of the base score that comes from words the worker holds.

    Other words are scored as unseen and listed; the join with all counts then
    adds what they gain if they are known.
    """
    gains = np.fromiter(map(gain_of, block.plain_words(), repeat(np.nan)), dtype=np.float64, count=len(block.words))
    held = ~np.isnan(gains)
    gain = np.where(held, gains, unseen)
    there = held[block.codes]
    # Each text's other words, with how often it has them.
    text = np.repeat(np.arange(len(block.starts)), block.lengths)[~there]
    other, times = np.unique(text * len(gains) + block.codes[~there], return_counts=True)
    offsets = pa.array(np.searchsorted(other, np.arange(len(block.starts) + 1) * len(gains)), pa.int32())
    words = block.words.take(pa.array(other % len(gains)))
    return {
        "n_tokens": pa.array(block.lengths, pa.int64()),
        "n_known": pa.array(block.sums(there.astype(np.int64))),
        "base_score": pa.array(block.sums(gain[block.codes])),
        "words": pa.ListArray.from_arrays(offsets, words),
        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
    }


def _levels(block: Block, own: Filter, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The levels of the n-grams of each length at each place, and of the contexts
    before a first word."""
    words, *longer = block.ngram_hashes(order)
    found = [own.levels_of(words)[block.codes]]
    if longer:
        unique, where = np.unique(np.concatenate(longer), return_inverse=True)
        found += np.split(own.levels_of(unique)[where], order - 1)
    return np.stack(found), own.levels_of(start_hashes(order))


def _scoring_pass(docs: DataFrame, model, gains: dict | None, last: bool) -> DataFrame:
    """Looks up the documents' n-grams in the segments held.

    The first pass (``gains`` given) numbers the rows and adds the exact part.
    All but the last pass carry the text and a byte for each n-gram on; the last
    one scores.
    """
    own, values, order, n, v = model
    shared = docs.sparkSession.sparkContext.broadcast((own, gains))
    unseen, first = _unseen(n, v), gains is not None
    fields = [f for f in docs.schema if f.name not in ("text", "levels")]
    if first:
        fields = [
            StructField("row", LongType()), *fields, StructField("n_tokens", LongType()),
            StructField("n_known", LongType()), StructField("base_score", DoubleType()),
            StructField("words", ArrayType(BinaryType())), StructField("times", ArrayType(IntegerType())),
        ]
    if last:
        fields.append(StructField("score", DoubleType()))
    else:
        fields += [docs.schema["text"], StructField("levels", BinaryType())]
    out = StructType(fields)

    def looked_up(batches):
        own, gains = shared.value
        row = first_row_number()
        for batch in small_batches(batches, TEXTS):
            at = 0
            for block in _blocks(batch.column("text"), order, 1 << 20):
                size = len(block.starts)
                part, at = batch.slice(at, size), at + size
                frame = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                if first:
                    frame |= _exact_part(block, gains.get, unseen)
                    frame["row"] = pa.array(range(row, row + size), pa.int64())
                    row += size
                found, start = _levels(block, own, order)
                if not first:
                    before = [np.frombuffer(b, dtype=np.uint8) for b in frame["levels"].to_pylist()]
                    places = [b[: order * m].reshape(order, m) for b, m in zip(before, block.lengths, strict=True)]
                    found = np.maximum(found, np.concatenate(places, axis=1))
                    start = np.maximum(start, before[0][order * block.lengths[0] :])
                if last:
                    scores = _log_probabilities(block, values[found], values[start], order, n, v)
                    frame["score"] = pa.array(scores)
                else:
                    ends = zip(block.starts, block.starts + block.lengths, strict=True)
                    both = [found[:, s:e].tobytes() + start.tobytes() for s, e in ends]
                    frame["levels"] = pa.array(both, pa.binary())
                yield pa.record_batch([frame[f.name] for f in out], names=out.names)

    return docs.mapInArrow(looked_up, out)
