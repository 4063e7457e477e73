"""Packing documents into token sequences along a Hilbert curve.

Each document becomes a hashed vector of its token counts, projected to `DIMENSIONS` numbers. Documents
are ordered by the position of that point on a Hilbert curve, so that neighbours in a sequence
resemble each other, and laid end to end in that order. Sequences are cut from that line every
`length` tokens, whatever document is there, so no token of padding is needed but at the end: what is
left there is cut into sequences whose sizes are the powers of two of its binary form.

Null and empty texts hold the end id alone. Documents with the same point (copies) follow by doc_id; repeated
rows are packed each on their own. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import arrow_rows, map_batches, materialize, running_total
from holdfast.llm.words import encoder

DIMENSIONS = 4
BITS = 12
BUCKETS = 1024
#: Documents that a task encodes or cuts at once.
ROWS = 3000
SEED = 42

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (n, dimensions) with `bits` bits per axis."""
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(axes)):
            is_set = axes[i] >> bit & 1 == 1
            swap = np.where(is_set, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(is_set, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] >> bit & 1 == 1, (1 << bit) - 1, 0)
    keys = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = keys << 1 | ((axis ^ turn) >> bit & 1)
    return keys


@functools.cache
def projection(vocabulary: int) -> np.ndarray:
    """What one token adds to a document's point: its hashed bucket and sign, projected."""
    random = np.random.default_rng(SEED)
    directions = random.standard_normal((BUCKETS, DIMENSIONS))
    bucket = random.integers(0, BUCKETS, vocabulary)
    sign = random.choice([-1.0, 1.0], vocabulary)
    return directions[bucket] * sign[:, None]


def document_keys(ids: np.ndarray, ends: np.ndarray, vocabulary: int) -> np.ndarray:
    """The curve position of each run of ids; a run must not be empty."""
    begins = np.concatenate([[0], ends[:-1]])
    table = projection(vocabulary)
    sums = np.stack([np.add.reduceat(table[:, i][ids], begins) for i in range(DIMENSIONS)], axis=1)
    means = sums / (ends - begins)[:, None]
    unit = np.arctan(means * 4) / np.pi + 0.5
    return hilbert_keys((unit * (1 << BITS)).astype(np.int64), BITS)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(row, doc_id, key, n_tokens, packed): ids with the end id, two bytes each where that is enough."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = encoder(tokenizer)
        ids, ends = words.encode(batch.column("text"))
        ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
        vocabulary = len(words.lengths)
        keys = document_keys(ids, ends, max(vocabulary, end_id + 1))
        narrow = ids.astype("<u2" if vocabulary <= 1 << 16 and end_id < 1 << 16 else "<u4")
        raw, width = narrow.tobytes(), narrow.itemsize
        bounds = [0, *(ends * width).tolist()]
        packed = pa.array([raw[a:b] for a, b in zip(bounds, bounds[1:])], pa.binary())
        sizes = pa.array(np.diff(ends, prepend=0).astype(np.int64))
        columns = [batch.column("row"), batch.column("doc_id"), pa.array(keys), sizes, packed]
        return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "key", "n_tokens", "packed"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = "row long, doc_id long, key long, n_tokens long, packed binary"
    return map_batches(numbered, encode, schema, rows=ROWS)


def sequence_bounds(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one start, and where the last of them ends."""
    full, rest = divmod(total, length)
    bounds = [full * length]
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            bounds.append(bounds[-1] + (1 << bit))
    return bounds


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of `docs` (doc_id, text).

    `ids` are little-endian unsigned 32-bit integers. Only (key, doc_id, row, size) is sorted for the
    running total; the ids are shuffled once, to meet their start.
    """
    with arrow_rows(docs.sparkSession, ROWS):
        rows = materialize(tokenized(docs, tokenizer, end_id))
    starts = running_total(rows, ["key", "doc_id", "row"], "n_tokens", "place").select("row", "place")
    total = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    tail = np.array(sequence_bounds(total, length), dtype=np.int64)
    full = int(tail[0]) // length

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[] for _ in range(7)]
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "place", "packed"))
        for doc, size, place, packed in zip(*columns):
            kind = "<u2" if len(packed) == 2 * size else "<u4"
            raw = np.frombuffer(packed, kind).astype("<u4").tobytes()
            at = 0
            while at < size:
                here = place + at
                if here < tail[0]:
                    sequence, offset = divmod(here, length)
                    room = length - offset
                else:
                    i = int(np.searchsorted(tail, here, side="right"))
                    sequence, offset, room = full + i - 1, here - int(tail[i - 1]), int(tail[i]) - here
                taken = min(room, size - at)
                piece = (doc, at, taken, size, sequence, offset, raw[4 * at : 4 * (at + taken)])
                for column, value in zip(out, piece):
                    column.append(value)
                at += taken
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    placed = rows.select("row", "doc_id", "n_tokens", "packed").join(starts, "row")
    return map_batches(placed.select("doc_id", "n_tokens", "place", "packed"), cut, PIECES, rows=ROWS)
