"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

Every prefix of a byte string has one valid encoding, and an encoding is valid
if each two neighbours are. So it is enough to keep, for every prefix, the last
token of its encoding: the one token that ends there and may follow the last
token of the prefix before it. Appending bytes extends the table; an edit
recomputes it from the edit until it agrees with the old one over the length of
the longest token.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wickwork.llm.common import small_batches
from wickwork.llm.pieces import PIECE, chunks, pieces

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# A worker's memory is bounded by these, as a corpus has any number of different
# chunks: while a task runs it keeps the encodings of these to twice as many chunks and pieces ...
CHUNK_CACHE, PIECE_CACHE = 1 << 18, 1 << 16
# ... and so many comparisons of two tokens, which it forgets when full.
PAIR_CACHE = 1 << 19
NEVER = 1 << 62


class Kept:
    """The encodings asked for last: ``most`` to twice as many, the rest is forgotten."""

    def __init__(self, most: int):
        self.most = most
        self.new: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def get(self, key: str) -> tuple[int, ...] | None:
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: tuple[int, ...]) -> None:
        if len(self.new) >= self.most:
            self.new, self.old = {}, self.new
        self.new[key] = value

    def clear(self) -> None:
        self.new, self.old = {}, {}


class PrefixEncoder:
    """Encodes byte strings with the ranks of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.bytes = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens a token is merged from
        self.follows: dict[tuple[int, int], bool] = {}
        self.chunk_cache, self.piece_cache = Kept(CHUNK_CACHE), Kept(PIECE_CACHE)
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and (pair := self._merged_from(token, rank)):
                self.parts[rank] = pair
        # Tokens that merges can make; others only stand for a whole piece.
        self.made = {b: r for b, r in ranks.items() if len(b) == 1 or r in self.parts}
        self.ends = ahocorasick.Automaton()
        for token, rank in self.made.items():
            self.ends.add_word(token.decode("latin-1"), (len(token), rank))
        self.ends.make_automaton()

    def _merged_from(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The last two tokens of ``token`` under merges of lower rank, if just two are left."""
        ids = [self.rank[token[i : i + 1]] for i in range(len(token))]
        while len(ids) > 2:
            best, at = rank, -1
            for i in range(len(ids) - 1):
                r = self.rank.get(self.bytes[ids[i]] + self.bytes[ids[i + 1]], NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            ids[at : at + 2] = [best]
        return ids[0], ids[1]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``left right`` stays two tokens when their bytes are merged.

        Both are taken apart at their common border, the latest merge first. A
        merge across the border happens if its rank comes before those that
        take its two sides elsewhere; of equal ranks the left one is first.
        """
        known = self.follows.get((left, right))
        if known is not None:
            return known
        if len(self.follows) >= PAIR_CACHE:
            self.follows.clear()
        x, y, x_goes, y_goes, answer = left, right, NEVER, NEVER, True
        while True:
            across = self.rank.get(self.bytes[x] + self.bytes[y])
            if across is not None and across < x_goes and across <= y_goes:
                answer = False
                break
            take_x = x in self.parts and (x > y or y not in self.parts)
            if take_x:
                x_goes, x = x, self.parts[x][1]
            elif y in self.parts:
                y_goes, y = y, self.parts[y][0]
            else:
                break
        self.follows[left, right] = answer
        return answer

    def extend(self, data: bytes, last: list[int], end: int | None = None) -> None:
        """Adds the last tokens of the prefixes of ``data`` longer than ``len(last)``."""
        made, width, may_follow = self.made, self.longest, self.may_follow
        for i in range(len(last) + 1, (len(data) if end is None else end) + 1):
            for j in range(max(0, i - width), i):
                token = made.get(data[j:i])
                if token is not None and (not j or may_follow(last[j - 1], token)):
                    last.append(token)
                    break

    def table(self, data: bytes) -> list[int]:
        """The last tokens of all prefixes; the automaton names the tokens that end at each."""
        last, follows, may_follow = [], self.follows, self.may_follow
        for end, (width, token) in self.ends.iter(data.decode("latin-1")):
            if len(last) > end:
                continue
            if width > end:
                last.append(token)
                continue
            before = last[end - width]
            good = follows.get((before, token))
            if good or (good is None and may_follow(before, token)):
                last.append(token)
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The tokens of the whole string, from the last one backwards."""
        out, i = [], len(last)
        while i:
            out.append(last[i - 1])
            i -= len(self.bytes[last[i - 1]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]
        return self.walk(self.table(data))

    def encode(self, text: str) -> list[int]:
        return [t for p in pieces(text) for t in self.encode_piece(p.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def edited(self, data: bytes, last: list[int], start: int, stop: int, new: bytes):
        """(bytes, last tokens, prefixes recomputed) after ``data[start:stop]`` becomes ``new``."""
        after = data[:start] + new + data[stop:]
        shift = len(after) - len(data)
        table, border = last[:start], start + len(new)
        self.extend(after, table, border)
        same = 0
        while len(table) < len(after) and same < self.longest:
            self.extend(after, table, len(table) + 1)
            same = same + 1 if table[-1] == last[len(table) - 1 - shift] else 0
        done = len(table) - start
        return after, table + last[len(table) - shift :], done

    def forget(self) -> None:
        """Gives the memory of all that was kept back."""
        for kept in (self.chunk_cache, self.piece_cache, self.follows):
            kept.clear()

    def chunk(self, text: str) -> tuple[int, ...]:
        """The ids of a chunk; chunks and pieces up to 64 characters are kept."""
        found = self.chunk_cache.get(text)
        if found is None:
            split = pieces(text)
            if len(split) == 1:  # not kept twice
                found = tuple(self.encode_piece(text.encode()))
            else:
                found = tuple([t for p in split for t in self._piece(p)])
            if len(text) <= 64:
                self.chunk_cache.put(text, found)
        return found

    def _piece(self, text: str) -> tuple[int, ...]:
        found = self.piece_cache.get(text)
        if found is None:
            found = tuple(self.encode_piece(text.encode()))
            if len(text) <= 64:
                self.piece_cache.put(text, found)
        return found


class EditableText:
    """A text whose encoding is kept while it is appended to or edited.

    Only pieces from two characters before an edit to where the old borders are
    met again are split anew. An edit inside one piece, as in a long run without
    spaces, also keeps that piece's prefix table.
    """

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text = encoder, text
        self.pieces = [self._row(p) for p in pieces(text)]

    def _row(self, piece: str):
        data = piece.encode()
        return piece, data, self.encoder.table(data)

    def ids(self) -> list[int]:
        out = []
        for _, data, last in self.pieces:
            whole = self.encoder.rank.get(data)
            out += [whole] if whole is not None else self.encoder.walk(last)
        return out

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replaces characters ``start`` to ``stop`` by ``new``."""
        text = self.text[:start] + new + self.text[stop:]
        shift, at, keep = len(text) - len(self.text), 0, 0
        # A piece depends on its characters, on the rest of a run of space, and on one more.
        safe = start
        while safe and self.text[safe - 1].isspace():
            safe -= 1
        while keep < len(self.pieces) and at + len(self.pieces[keep][0]) + 2 <= safe:
            at += len(self.pieces[keep][0])
            keep += 1
        olds, place = {}, at
        for number in range(keep, len(self.pieces)):
            if place >= stop:
                olds[place + shift] = number
            place += len(self.pieces[number][0])
        fresh, rest, here = [], len(self.pieces), at
        for match in PIECE.finditer(text, at):
            if match.start() >= start + len(new) and match.start() in olds:
                rest = olds[match.start()]
                break
            fresh.append(match.group())
        rows = []
        old = self.pieces[keep] if keep < len(self.pieces) else None
        for piece in fresh:
            rows.append(self._near(old, piece) if here == at and old else self._row(piece))
            here += len(piece)
        self.pieces[keep:rest] = rows
        self.text = text

    def _near(self, old, piece: str):
        """The table of ``piece``, made from that of ``old`` if they share ends."""
        _, before, last = old
        data = piece.encode()
        head = 0
        while head < min(len(data), len(before)) and data[head] == before[head]:
            head += 1
        tail = 0
        while tail < min(len(data), len(before)) - head and data[-1 - tail] == before[-1 - tail]:
            tail += 1
        after, table, _ = self.encoder.edited(
            before, last, head, len(before) - tail, data[head : len(data) - tail]
        )
        return piece, after, table


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    """One encoder a worker process; ``path`` holds a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return PrefixEncoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), and the ids if asked for, for
    every row of ``docs``, repeated rows and missing ids included.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the
    bytes that the ids decode to. A missing text is an empty one: no ids, both
    hashes those of the empty string. Other columns are not read. The vocabulary
    is a file of the installed tokenizer package, opened by each worker.
    """
    rows = docs.select(F.col(id_col), F.col(text_col))
    out = [rows.schema[0], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
           StructField("decoded_sha256", StringType())]
    if with_ids:
        out.append(StructField("ids", ArrayType(IntegerType())))

    def encoded(batches):
        bpe = encoder(public_tokenizers.path(vocabulary))
        chunk, decimal = bpe.chunk, {i: str(i) for i in bpe.bytes}.__getitem__
        try:
            for batch in small_batches(batches):
                counts, ids_hash, text_hash, kept = [], [], [], []
                for text in batch.column(1).to_pylist():
                    ids = list(chain.from_iterable(map(chunk, chunks(text or ""))))
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    if with_ids:
                        kept.append(np.array(ids, dtype=np.int32))
                columns = [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_hash, pa.string()),
                    pa.array(text_hash, pa.string()),
                ]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.record_batch(columns, names=[f.name for f in out])
        finally:
            # Spark keeps idle workers, several for each core if a stage has two steps
            # in Python; they would hold this beside the work of later stages.
            bpe.forget()

    return rows.mapInArrow(encoded, StructType(out))
