"""Byte-pair encoding and decoding of whole texts, with the merge loop written here.

A word is held as an array of part boundaries and one of the ranks of adjacent pairs. The least rank is
looked up by a scan, its boundary deleted, and the ranks of both neighbours refreshed, until no
pair has a rank. Words are short, so scans beat a heap; a word of more than `LONG` bytes (a text
without white space) takes a heap instead, with the same order of merges.

Null texts are empty: no ids, the empty text. Repeated rows are kept. Empty tables give empty
tables. Added columns replace input columns of the same name; all others are kept as they are.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from holdfast.llm.common import map_batches
from holdfast.llm.words import WordTable, token_bytes

#: Bytes up to which a word is merged by scans.
LONG = 400
NONE = 1 << 60
#: Documents that a task encodes or decodes at once.
ROWS = 2000

#: How the byte-level pre-tokenizer cuts text, on characters mapped to one of their class.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


class CharacterClasses(dict):
    """For `str.translate`: every character as one of its class (letter, number, white space, other).

    The tokenizer file names no Unicode version, so the class of a character beyond printable
    ASCII is asked of the library's pre-tokenizer, once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        super().__init__({c: c for c in (*range(32, 127), 10)})

    def __missing__(self, code: int) -> int:
        for like in "a1!":
            if len(self.cut(like + chr(code))) == 1:
                break
        else:
            like = "\t"
        self[code] = ord(like)
        return self[code]


class BytePairs(WordTable):
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocabulary = stored["model"]["vocab"]
        self.tokens = token_bytes(path)
        self.byte_ids = [0] * 256
        for i, token in enumerate(self.tokens):
            if len(token) == 1:
                self.byte_ids[token[0]] = i
        # (left id, right id) in one integer -> rank; rank -> id of the merged part
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(stored["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left] << 32 | vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        self.added = {entry["content"]: entry["id"] for entry in stored["added_tokens"]}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.classes = CharacterClasses(path)
        super().__init__(list(self.added))

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > LONG:
            return self._merge_long(ids)
        rank = self.ranks.get
        bounds = list(range(len(ids)))  # where each part starts
        part = ids  # the id of the part that starts at a bound, by byte position
        adjacent = [rank(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while adjacent:
            least = min(adjacent)
            if least == NONE:
                break
            i = adjacent.index(least)
            start = bounds[i]
            part[start] = self.merged[least]
            del bounds[i + 1], adjacent[i]
            if i < len(adjacent):
                adjacent[i] = rank(part[start] << 32 | part[bounds[i + 1]], NONE)
            if i:
                adjacent[i - 1] = rank(part[bounds[i - 1]] << 32 | part[start], NONE)
        return [part[start] for start in bounds]

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, rank = len(ids), self.ranks.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := rank(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [i for i in ids if i >= 0]

    def _pieces(self, text: str) -> list[str]:
        if text.isascii() and text.isprintable():
            return PIECES.findall(text)
        return [text[m.start() : m.end()] for m in PIECES.finditer(text.translate(self.classes))]

    def encode_text(self, text: str) -> bytes:
        ids: list[int] = []
        for part in self.added_pattern.split(text) if self.added_pattern else [text]:
            if part in self.added:
                ids.append(self.added[part])
            else:
                for piece in self._pieces(part):
                    ids += self.merge(piece.encode())
        return np.array(ids, dtype="<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        return [self.encode_text(" " + word) for word in words]

    @functools.cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens one after the other, and where each ends."""
        return np.frombuffer(b"".join(self.tokens), np.uint8), np.cumsum([len(t) for t in self.tokens])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each run of `ids` up to an end; unknown ids are skipped."""
        flat, stops = self.table
        known = (ids >= 0) & (ids < len(stops))
        safe = np.where(known, ids, 0)
        sizes = np.where(known, np.diff(stops, prepend=0)[safe], 0)
        total = np.cumsum(sizes)
        begins = stops[safe] - np.diff(stops, prepend=0)[safe]
        spread = np.repeat(begins - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)
        raw = flat[spread].tobytes()
        cuts = np.concatenate([[0], total])[np.concatenate([[0], ends])].tolist()
        return [raw[a:b].decode("utf-8", errors="replace") for a, b in zip(cuts, cuts[1:])]


@functools.cache
def byte_pairs(path: str) -> BytePairs:
    """One table per worker and file."""
    return BytePairs(path)


def _extended(df: DataFrame, name: str, kind: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name]
    return ", ".join([*fields, f"`{name}` {kind}"])


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [i for i, other in enumerate(batch.schema.names) if other != name]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(i) for i in kept], column], [*[batch.schema.names[i] for i in kept], name]
    )


def _encoded(column: pa.Array, tokenizer: str) -> pa.Array:
    found, ends = byte_pairs(tokenizer).encode(column)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(found.astype(np.int32)))


def _decoded(column: pa.Array, tokenizer: str) -> pa.Array:
    sizes = np.diff(column.offsets.to_numpy().astype(np.int64))
    sizes[column.is_null().to_numpy(zero_copy_only=False)] = 0
    found = column.flatten().to_numpy(zero_copy_only=False)
    return pa.array(byte_pairs(tokenizer).decode(found, np.cumsum(sizes)), pa.string())


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the token ids of its texts as a list column."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _with(batch, ids, _encoded(batch.column(text), tokenizer))

    return map_batches(df, each, _extended(df, ids, "array<int>"), rows=ROWS)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the texts of its id lists; bytes that are no UTF-8 become U+FFFD. A null list is empty."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _with(batch, text, _decoded(batch.column(ids), tokenizer))

    return map_batches(df, each, _extended(df, text, "string"), rows=ROWS)


def round_trip(
    df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """`encode` and then `decode`, in one pass of one worker per task; `ids` and `decoded` differ."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        batch = _with(batch, ids, _encoded(batch.column(text), tokenizer))
        return _with(batch, decoded, _decoded(batch.column(ids), tokenizer))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in (ids, decoded)]
    return map_batches(df, each, ", ".join([*fields, f"`{ids}` array<int>", f"`{decoded}` string"]), rows=ROWS)
