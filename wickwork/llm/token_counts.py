"""Token counts from counted pieces: no text's ids are made.

Every distinct pre-token of the corpus is tokenized once. A document's count is
the sum, over its distinct pre-tokens, of their frequency in it times their
number of tokens.
"""

from __future__ import annotations

import os
from collections import Counter
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wickwork.llm.common import first_row_number
from wickwork.llm.frequent import LIMIT, frequent
from wickwork.llm.pieces import chunks, pieces
from wickwork.session import materialise

VOCABULARY = "byte_bpe_50k.json"
TOKENS_ALLOWED = 1024
CACHE = 500_000
# From this character on, releases of Unicode differ in what is a letter or number.
SETTLED = "Ԁ"


@lru_cache(maxsize=2)
def library(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


@lru_cache(maxsize=2)
def special_strings(vocabulary: str) -> tuple[str, ...]:
    """Strings that the library takes out of a text as one token each."""
    return tuple(t.content for t in library(vocabulary).get_added_tokens_decoder().values())


def chunk_pieces(chunk: str, vocabulary: str) -> list[str]:
    """A chunk's pre-tokens, by the library's own rules.

    Where characters are newer than every release of Unicode in question, the
    library itself splits.
    """
    if chunk.isascii() or max(chunk) < SETTLED:
        return pieces(chunk)
    split = library(vocabulary).pre_tokenizer.pre_tokenize_str(chunk)
    return [chunk[a:b] for _, (a, b) in split]


def text_chunks(text: str, vocabulary: str) -> tuple[Counter, int]:
    """How often each chunk stands in a text, and the number of special strings."""
    parts, special = [text], 0
    for content in special_strings(vocabulary):
        split = [p.split(content) for p in parts]
        special += sum(len(p) - 1 for p in split)
        parts = [x for p in split for x in p]
    counted = Counter(chunks(parts[0]))
    for part in parts[1:]:
        counted.update(chunks(part))
    return counted, special


def piece_totals(docs: DataFrame, text_col: str, vocabulary: str) -> DataFrame:
    """(piece, often): every distinct pre-token and its occurrences in all texts."""

    def counted(batches):
        for batch in batches:
            found, totals = Counter(), Counter()
            for text in batch.column(0).to_pylist():
                found.update(text_chunks(text or "", vocabulary)[0])
            for chunk, n in found.items():
                for piece in chunk_pieces(chunk, vocabulary):
                    totals[piece] += n
            yield pa.record_batch(
                [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())],
                names=["piece", "often"],
            )

    rows = docs.select(text_col).mapInArrow(counted, "piece string, often long")
    return rows.groupBy("piece").agg(F.sum("often").alias("often"))


def piece_tokens(totals: DataFrame, vocabulary: str) -> DataFrame:
    """(piece, often, tokens): the library's number of tokens of every pre-token."""

    def tokenized(batches):
        own = library(vocabulary)
        for batch in batches:
            encoded = own.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)
            tokens = pa.array([len(e) for e in encoded], pa.int64())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), tokens], names=["piece", "often", "tokens"]
            )

    return totals.mapInArrow(tokenized, "piece string, often long, tokens long")


def _documents(rows: DataFrame, known: dict[str, int], vocabulary: str) -> DataFrame:
    """A row for each document: its tokens in ``known`` pieces, and its other pieces."""
    shared = rows.sparkSession.sparkContext.broadcast(known)
    out = [
        StructField("row", LongType()),
        rows.schema[0],
        StructField("n_bytes", LongType()),
        StructField("n_known", LongType()),
        StructField("pieces", ArrayType(StringType())),
        StructField("times", ArrayType(IntegerType())),
    ]

    def counted(batches):
        held, row, cache = shared.value, first_row_number(), {}
        for batch in batches:
            columns = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                text = text or ""
                found, total = text_chunks(text, vocabulary)
                other = Counter()
                for chunk, n in found.items():
                    split = cache.get(chunk)
                    if split is None:
                        parts = chunk_pieces(chunk, vocabulary)
                        split = sum(held.get(p, 0) for p in parts), [p for p in parts if p not in held]
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[chunk] = split
                    total += split[0] * n
                    for piece in split[1]:
                        other[piece] += n
                values = row, len(text.encode()), total, list(other), list(other.values())
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                row += 1
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.record_batch([arrays[0], batch.column(0), *arrays[1:]], names=[f.name for f in out])

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())]
    return rows.mapInArrow(counted, StructType(out))


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    allowed: int = TOKENS_ALLOWED,
    limit: int = LIMIT,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit), one row for every row of ``docs``,
    repeated rows and missing ids included.

    Special strings inside a text are one token each, as is the library's
    default; none are added. A missing text is an empty one: 0 bytes, 0 tokens.
    Other columns are not read.
    """
    totals = piece_totals(docs, text_col, vocabulary)
    counts = materialise(piece_tokens(totals, vocabulary), "token-counts-pieces")
    known = frequent(counts, "piece", "tokens", "often", limit)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    per_doc = materialise(_documents(rows, known, vocabulary), "token-counts-documents")
    rare = per_doc.select("row", F.explode(F.arrays_zip("pieces", "times")).alias("p")).select(
        "row", F.col("p.pieces").alias("piece"), F.col("p.times").alias("times")
    )
    sums = (
        rare.join(counts.select("piece", "tokens"), "piece")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("tokens")).alias("n_rare"))
    )
    n = (F.col("n_known") + F.coalesce("n_rare", F.lit(0))).cast("long")
    return (
        per_doc.drop("pieces", "times")
        .join(sums, "row", "left")
        .select(F.col("id").alias(id_col), "n_bytes", n.alias("n_tokens"), (n > allowed).alias("over_limit"))
    )
