"""Repeated passages across documents, found with Aho-Corasick automata.

A window is `window` consecutive words. Each word of a document that is covered by a window which also
stands in a document of smaller doc_id is removed; windows are judged on the input.

1. Documents are packed into compressed batches, which all later steps share.
2. Every window has a minimizer, the least hash of its `SEED_WORDS`-word phrases. Equal windows have
   equal minimizers, so windows whose minimizer is found in one document only cannot recur. Batches
   send their minimizers out by hash and learn which of them recur.
3. Runs of windows with one recurring minimizer go, as words, to the shard of that minimizer, each
   distinct run once per batch. For very frequent minimizers each window goes to a shard of its own hash.
4. A shard confirms which windows stand in two documents, word by word; compiles them into an
   automaton over words (one character stands for a word); and streams all its runs through it.
   Every occurrence after the first document is answered to its batch as a range of words.
5. Batches take the ranges out.

Null texts have no words. Rows without a doc_id keep all words and repeat nothing. Rows that share a
doc_id are one document in two rows: neither is smaller. Texts of fewer words than a window keep all.
An empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_batches, materialize, partitions, ship

SEED_WORDS = 6
#: Text and rows of a batch.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096
#: Batches with a minimizer, from which on its windows are spread over the shards.
FREQUENT = 64
SHARDS_PER_PARTITION = 2
#: Runs, about, whose passages go into one automaton: building slows down where many differ in their first word.
AUTOMATON_RUNS = 512

FIRST_CHARACTER = 0x100
SURROGATES = 0xD800, 0xE000
CHARACTERS = 0x110000 - FIRST_CHARACTER - (SURROGATES[1] - SURROGATES[0])


def packed(columns: dict[str, pa.Array], level: int = 3) -> bytes:
    """Columns of one length as a compressed Arrow stream."""
    batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(payload: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(payload)))


def batched(docs: DataFrame) -> DataFrame:
    """(batch, payload): documents packed in their order within each task."""
    ship(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            start = 0
            while start < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(sizes[start : start + BATCH_ROWS]), BATCH_BYTES, side="right"))
                part = batch.slice(start, max(1, fits))
                # Stored once and shuffled twice, so worth some time.
                payload = packed({"doc_id": part.column("doc_id"), "text": part.column("text")}, level=5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([payload], pa.binary())], ["batch", "payload"]
                )
                number, start = number + 1, start + part.num_rows

    return docs.select("doc_id", "text").mapInArrow(each, "batch long, payload binary")


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def phrase_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each `length` consecutive word hashes."""
    n = max(0, len(words) - length + 1)
    out, factor = np.zeros(n, np.uint64), 1
    for i in range(length):
        out += words[i : i + n] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    return mixed(out)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = max(0, len(values) - width + 1)
    least = values[:n].copy()
    for i in range(1, width):
        np.minimum(least, values[i : i + n], out=least)
    return least


@dataclass
class Words:
    """The words of a batch: `codes` into `table`, and where each document's begin (`bounds`)."""

    table: pa.Array
    codes: np.ndarray
    bounds: np.ndarray
    ids: pa.Array

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Words:
        split = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
        words = split.flatten()
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        real = pc.greater(pc.binary_length(words), 0)
        before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
        coded = words.filter(real).dictionary_encode()
        return cls(coded.dictionary, coded.indices.to_numpy(), before[bounds], batch.column("doc_id"))

    def hashes(self) -> np.ndarray:
        table = [xxhash.xxh64_intdigest(word.encode()) for word in self.table.to_pylist()]
        return np.array(table, dtype=np.uint64)[self.codes]

    def documents(self) -> np.ndarray:
        """The number of the document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, minimizer, hash) of each window within one document that has an id."""
        hashes = self.hashes()
        if len(hashes) < window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        least = sliding_least(phrase_hashes(hashes, SEED_WORDS), window - SEED_WORDS + 1)
        document = self.documents()
        whole = document[: len(least)] == document[window - 1 :]
        whole &= self.ids.is_valid().to_numpy(zero_copy_only=False)[document[: len(least)]]
        at = np.flatnonzero(whole)
        return at, least[at], phrase_hashes(hashes, window)[at]


def minimizers(batches: DataFrame, window: int, buckets: int) -> DataFrame:
    """(bucket, batch, once, twice): hashes in one document of the batch, and in several."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for number, payload in zip(batch.column("batch").to_pylist(), batch.column("payload").to_pylist()):
            words = Words.of(unpacked(payload))
            at, least, _ = words.windows(window)
            document = words.documents()[at] if len(at) else at
            change = np.ones(len(at), dtype=bool)
            change[1:] = (least[1:] != least[:-1]) | (document[1:] != document[:-1])
            least, document = least[change], document[change]
            order = np.lexsort((document, least))
            least, document = least[order], document[order]
            first = np.ones(len(least), dtype=bool)
            first[1:] = least[1:] != least[:-1]
            starts = np.flatnonzero(first)
            hashes = least[starts]
            ends = np.append(starts[1:], len(least)) - 1
            several = document[ends] != document[starts] if len(starts) else np.zeros(0, dtype=bool)
            place = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(buckets + 1))
            rows = [(b, order[cuts[b] : cuts[b + 1]]) for b in range(buckets) if cuts[b] < cuts[b + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in rows], pa.int32()),
                    pa.array([number] * len(rows), pa.int64()),
                    pa.array([hashes[i[~several[i]]].tobytes() for _, i in rows], pa.binary()),
                    pa.array([hashes[i[several[i]]].tobytes() for _, i in rows], pa.binary()),
                ],
                ["bucket", "batch", "once", "twice"],
            )

    return map_batches(batches, each, "bucket int, batch long, once binary, twice binary", rows=1)


def by_group(key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[-1].column(key)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def recurring(sent: DataFrame) -> DataFrame:
    """(batch, found, frequent): per batch and bucket its minimizers that recur, and those that are frequent."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group("bucket", batches):
            numbers = group.column("batch").to_numpy()
            parts = [
                np.frombuffer(once + twice, np.uint64)
                for once, twice in zip(group.column("once").to_pylist(), group.column("twice").to_pylist())
            ]
            sent_twice = np.frombuffer(b"".join(group.column("twice").to_pylist()), np.uint64)
            together = np.concatenate(parts)
            hashes, place, counts = np.unique(together, return_inverse=True, return_counts=True)
            again = counts > 1
            again[np.searchsorted(hashes, sent_twice)] = True
            often = (counts >= FREQUENT)[place]
            again = again[place] & ~often
            cuts = np.cumsum([0, *map(len, parts)])
            out = [
                (n, together[a:b][again[a:b]], together[a:b][often[a:b]])
                for n, a, b in zip(numbers.tolist(), cuts, cuts[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _, _ in out], pa.int64()),
                    pa.array([part.tobytes() for _, part, _ in out], pa.binary()),
                    pa.array([part.tobytes() for _, _, part in out], pa.binary()),
                ],
                ["batch", "found", "frequent"],
            )

    ordered = sent.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(each, "batch long, found binary, frequent binary")


def runs(batches: DataFrame, window: int, shards: int) -> DataFrame:
    """(shard, batch, payload): the distinct runs of candidate windows of each batch, and where they stand.

    `batches` are joined with what recurs in them: (batch, payload, found, frequent) with lists of binaries.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            found = np.sort(np.frombuffer(b"".join(row["found"]), np.uint64))
            frequent = np.sort(np.frombuffer(b"".join(row["frequent"]), np.uint64))
            words = Words.of(unpacked(row["payload"]))
            at, least, whole = words.windows(window)
            alone = np.isin(least, frequent)
            candidate = alone | np.isin(least, found)
            at, least, whole, alone = at[candidate], least[candidate], whole[candidate], alone[candidate]
            if not len(at):
                continue
            document = words.documents()[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = alone[1:] | (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | (document[1:] != document[:-1])
            start = np.flatnonzero(new)
            last = np.append(start[1:], len(at)) - 1
            begin, end, document = at[start], at[last] + window, document[start]
            key = np.where(alone[start], whole[start], least[start])
            sizes = end - begin
            ends = np.cumsum(sizes)
            flat = np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1])
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()), words.table.take(pa.array(words.codes[flat]))
            )
            distinct = pc.binary_join(lists, " ").dictionary_encode()
            run = distinct.indices.to_numpy()
            ids = words.ids.to_numpy(zero_copy_only=False)[document].astype(np.int64)
            shard = (mixed(key) % np.uint64(shards)).astype(np.int64)
            order = np.lexsort((document, run, shard))
            cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
            sent = []
            for a, b in zip(cuts, cuts[1:]):
                rows = order[a:b]
                own, place = np.unique(run[rows], return_inverse=True)
                listing = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), distinct.dictionary.take(pa.array(own)))
                columns = {
                    "texts": listing,
                    **{
                        name: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.array(values))
                        for name, values in (
                            ("run", place.astype(np.int32)),
                            ("document", document[rows].astype(np.int32)),
                            ("doc_id", ids[rows]),
                            ("start", (begin - words.bounds[document.astype(np.int64)])[rows].astype(np.int32)),
                        )
                    },
                }
                sent.append((int(shard[rows[0]]), packed(columns)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _ in sent], pa.int32()),
                    pa.array([row["batch"]] * len(sent), pa.int64()),
                    pa.array([payload for _, payload in sent], pa.binary()),
                ],
                ["shard", "batch", "payload"],
            )

    return map_batches(batches, each, "shard int, batch long, payload binary", rows=1)


def as_characters(codes: np.ndarray, distinct: int) -> tuple[str, int]:
    """Words as a text in which `width` characters stand for each; equal words get equal ones."""
    half = CHARACTERS // 2
    if distinct < CHARACTERS:
        width, points = 1, codes.astype(np.int64)
    else:  # the halves differ, so that no match starts within a word
        width, points = 2, np.stack([codes // half, half + codes % half], axis=1).ravel().astype(np.int64)
    points += FIRST_CHARACTER
    points[points >= SURROGATES[0]] += SURROGATES[1] - SURROGATES[0]
    return points.astype("<u4").tobytes().decode("utf-32-le"), width


def shard_matches(texts: pa.Array, least: np.ndarray, most: np.ndarray, window: int):
    """What repeats in the distinct runs of a shard: (run, place, words, first document) arrays.

    `least` and `most` are the smallest and greatest document with each run. All runs with a
    minimizer are here. Where they are one run, it repeats as a whole or not at all; where they
    differ, their windows are counted one by one.
    """
    split = pc.split_pattern(texts, " ")
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    hashes = np.array([xxhash.xxh64_intdigest(word.encode()) for word in coded.dictionary.to_pylist()], np.uint64)[codes]
    in_first = phrase_hashes(hashes, SEED_WORDS)[bounds[:-1, None] + np.arange(window - SEED_WORDS + 1)]
    _, group, sizes = np.unique(in_first.min(axis=1), return_inverse=True, return_counts=True)
    alone = sizes[group] == 1
    # Runs of one group are only in each other's way, so each automaton takes the groups of a block.
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], group[order[::AUTOMATON_RUNS]]) if len(order) else []
    blocks = np.split(order, np.unique(starts)[1:])
    text, width = as_characters(codes, len(coded.dictionary))
    span = window * width
    cuts = (bounds * width).tolist()

    sizes_of, first_of = [], []
    runs_found, ends_found, passages = [], [], []
    for block in blocks:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        first: dict[str, int] = {}
        latest: dict[str, int] = {}
        for i in block[~alone[block]].tolist():
            low, high = int(least[i]), int(most[i])
            for at in range(cuts[i], cuts[i + 1] - span + 1, width):
                phrase = text[at : at + span]
                known = first.get(phrase)
                if known is None:
                    first[phrase], latest[phrase] = low, high
                else:
                    if low < known:
                        first[phrase] = low
                    if high > latest[phrase]:
                        latest[phrase] = high
        confirmed = [(phrase, low) for phrase, low in first.items() if low < latest[phrase]]
        whole = block[alone[block] & (least[block] < most[block])]
        confirmed += [(text[cuts[i] : cuts[i + 1]], int(least[i])) for i in whole.tolist()]
        if not confirmed:
            continue
        for passage, document in confirmed:
            automaton.add_word(passage, len(first_of))
            sizes_of.append(len(passage) // width)
            first_of.append(document)
        automaton.make_automaton()
        for i in block.tolist():
            for end, passage in automaton.iter(text[cuts[i] : cuts[i + 1]]):
                runs_found.append(i)
                ends_found.append(end)
                passages.append(passage)
    passages = np.array(passages, dtype=np.int64)
    words = np.array(sizes_of, dtype=np.int64)[passages]
    place = (np.array(ends_found, dtype=np.int64) + 1) // width - words
    return np.array(runs_found, dtype=np.int64), place, words, np.array(first_of, dtype=np.int64)[passages]


def matched(sent: DataFrame, window: int) -> DataFrame:
    """(batch, document, start, end): ranges of words to take out, arrays per batch and shard."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group("shard", batches):
            parts = [unpacked(payload) for payload in group.column("payload").to_pylist()]
            listed = [part.column("texts").flatten() for part in parts]
            distinct = pa.concat_arrays(listed).dictionary_encode()
            own = distinct.indices.to_numpy()
            before = np.cumsum([0, *map(len, listed)])

            def together(name: str) -> np.ndarray:
                return np.concatenate([part.column(name).flatten().to_numpy() for part in parts])

            counts = [len(part.column("run").flatten()) for part in parts]
            run = own[together("run") + np.repeat(before[:-1], counts)]
            number = np.repeat(group.column("batch").to_numpy(), counts)
            document, ids, start = together("document"), together("doc_id"), together("start")
            order = np.argsort(run, kind="stable")
            cuts = np.searchsorted(run[order], np.arange(len(distinct.dictionary) + 1))
            least = np.minimum.reduceat(ids[order], cuts[:-1])
            most = np.maximum.reduceat(ids[order], cuts[:-1])
            found, place, words, first = shard_matches(distinct.dictionary, least, most, window)
            # Each passage of a run, in every document that has the run.
            times = (cuts[1:] - cuts[:-1])[found]
            total = np.cumsum(times)
            rows = order[np.repeat(cuts[found] - total + times, times) + np.arange(total[-1] if len(total) else 0)]
            hit = np.repeat(np.arange(len(found)), times)
            later = ids[rows] > first[hit]
            rows, hit = rows[later], hit[later]
            if not len(rows):
                continue
            begin = start[rows] + place[hit]
            end = begin + words[hit]
            order = np.lexsort((begin, document[rows], number[rows]))
            rows, begin, end = rows[order], begin[order], end[order]
            edges = np.flatnonzero(np.diff(number[rows], prepend=-1, append=-1))
            payloads = [
                packed(
                    {
                        "document": pa.array(document[rows[a:b]], pa.int32()),
                        "start": pa.array(begin[a:b], pa.int32()),
                        "end": pa.array(end[a:b], pa.int32()),
                    }
                )
                for a, b in zip(edges, edges[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[rows[edges[:-1]]], pa.int64()), pa.array(payloads, pa.binary())], ["batch", "ranges"]
            )

    ordered = sent.repartition("shard").sortWithinPartitions("shard")
    return ordered.mapInArrow(each, "batch long, ranges binary")


def without_ranges(batches: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) from (batch, payload, ranges: list of binaries)."""

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            words = Words.of(unpacked(row["payload"]))
            edge = np.zeros(len(words.codes) + 1, dtype=np.int32)
            for payload in row["ranges"] or []:
                found = unpacked(payload)
                shift = words.bounds[found.column("document").to_numpy()]
                np.add.at(edge, shift + found.column("start").to_numpy(), 1)
                np.add.at(edge, shift + found.column("end").to_numpy(), -1)
            stays = np.cumsum(edge[:-1]) == 0
            kept = words.table.take(pa.array(words.codes[stays]))
            before = np.concatenate([[0], np.cumsum(stays)])[words.bounds]
            lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), kept)
            n_words = np.diff(words.bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    words.ids,
                    pa.array(n_words, pa.int64()),
                    pa.array(n_words - np.diff(before), pa.int64()),
                    pc.binary_join(lists, " "),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return map_batches(batches, each, "doc_id long, n_words long, n_removed long, kept string", rows=1)


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: `kept` are the words that stay, joined by a space."""
    if window < SEED_WORDS:
        raise ValueError(f"a window has at least {SEED_WORDS} words")
    n = partitions(docs.sparkSession)
    batches = materialize(batched(docs))
    found = recurring(minimizers(batches, window, n * 2))
    lists = found.groupBy("batch").agg(F.collect_list("found").alias("found"), F.collect_list("frequent").alias("frequent"))
    sent = runs(batches.join(lists, "batch").select("batch", "payload", "found", "frequent"), window, n * SHARDS_PER_PARTITION)
    ranges = matched(sent, window).groupBy("batch").agg(F.collect_list("ranges").alias("ranges"))
    return without_ranges(batches.join(ranges, "batch", "left").select("payload", "ranges"))
