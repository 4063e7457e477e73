"""Encoding whole texts with the tokenizers library, each distinct word once per worker."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Words that a worker remembers; beyond it forgets all and starts anew.
REMEMBERED = 2_000_000
#: Bytes of a word up to which it is remembered.
LONGEST = 64

#: White space beside a space, or a space at an end: such texts are not cut.
WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
UNCUT = f" {WHITE}|{WHITE} |^ | $"

# Fixed value: how the byte-level pre-tokenizer of this family cuts text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters below this code point are asked whether PIECES and the library agree on them; words with
#: those above go to the library.
KNOWN_FROM = 0x500
#: A byte that no text holds.
DELIMITER = 0xFF


def byte_symbols() -> dict[str, int]:
    """The printable symbol that byte-level vocabularies write for each byte, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary, added tokens included."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    symbols = byte_symbols()
    added = {entry["id"]: entry["content"].encode() for entry in stored["added_tokens"]}
    vocabulary = stored["model"]["vocab"]
    table = [b""] * (max([*vocabulary.values(), *added]) + 1)
    for token, i in vocabulary.items():
        table[i] = bytes(symbols[c] for c in token)
    for i, content in added.items():
        table[i] = content
    return table


class WordMemory:
    """Ids of words in flat arrays, found by two independent 64-bit hashes (about 30 bytes a word).

    A word's hashes are sums of its bytes times random numbers of their places. Slots are probed
    one after the other, for all words of a batch at once.
    """

    def __init__(self):
        random = np.random.default_rng(7)
        self.factors = random.integers(0, 1 << 63, (2, LONGEST), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._clear(1 << 16)

    def _clear(self, slots: int) -> None:
        self.count, self.used = 0, 0
        self.slots = np.full(slots, -1, np.int32)
        self.hashes = np.zeros((2, slots // 2), np.uint64)
        self.begins, self.sizes = np.zeros(slots // 2, np.int32), np.zeros(slots // 2, np.int32)
        self.ids = np.zeros(slots * 2, np.uint32)

    def hash(self, words: pa.Array) -> np.ndarray:
        """(2, words) of words that are neither empty nor longer than LONGEST."""
        _, offsets, data = words.buffers()
        bounds = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
        if not len(words):
            return np.zeros((2, 0), np.uint64)
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].astype(np.uint64)
        starts = bounds[:-1] - bounds[0]
        place = np.arange(len(raw), dtype=np.int32) - np.repeat(starts, np.diff(bounds))
        sums = np.stack([np.add.reduceat(raw * factors[place], starts) for factors in self.factors])
        return sums ^ (sums >> np.uint64(31)) ^ np.diff(bounds).astype(np.uint64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it is not known."""
        found = np.full(hashes.shape[1], -1, np.int32)
        mask = len(self.slots) - 1
        slot = (hashes[0] & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(slot))
        while len(left):
            number = self.slots[slot[left]]
            there = number >= 0
            left, number = left[there], number[there]
            hit = (self.hashes[:, number] == hashes[:, left]).all(axis=0)
            found[left[hit]] = number[hit]
            left = left[~hit]
            slot[left] = (slot[left] + 1) & mask
        return found

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> np.ndarray:
        """The numbers of words that are not known yet and differ."""
        if self.count + len(ids) > REMEMBERED:
            self._clear(1 << 16)
        raw = np.frombuffer(b"".join(ids), dtype="<u4")
        while self.count + len(ids) > len(self.slots) // 2:
            self._grow()
        if self.used + len(raw) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(raw), np.uint32)])
        numbers = np.arange(self.count, self.count + len(ids), dtype=np.int32)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        self.hashes[:, numbers] = hashes
        self.sizes[numbers], self.begins[numbers] = sizes, self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(raw)] = raw
        self.count, self.used = self.count + len(ids), self.used + len(raw)
        self._place(numbers)
        return numbers

    def _place(self, numbers: np.ndarray) -> None:
        mask = len(self.slots) - 1
        slot = (self.hashes[0, numbers] & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            free = self.slots[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            taken = np.flatnonzero(free)[first]
            self.slots[slot[taken]] = numbers[taken]
            left = np.ones(len(numbers), dtype=bool)
            left[taken] = False
            numbers, slot = numbers[left], (slot[left] + 1) & mask

    def _grow(self) -> None:
        size = len(self.slots)
        self.hashes = np.concatenate([self.hashes, np.zeros((2, size // 2), np.uint64)], axis=1)
        self.begins = np.concatenate([self.begins, np.zeros(size // 2, np.int32)])
        self.sizes = np.concatenate([self.sizes, np.zeros(size // 2, np.int32)])
        self.slots = np.full(2 * size, -1, np.int32)
        self._place(np.arange(self.count, dtype=np.int32))


class WordTable:
    """Ids of whole texts by way of their distinct words, each encoded once and remembered.

    A byte-level tokenizer starts a new piece at a space between two characters that are not white
    space, so a batch of texts is cut at such spaces. Texts with other white space beside a space,
    or with the text of an added token, are encoded whole. Subclasses say how.
    """

    def __init__(self, added: list[str]):
        self.uncut = "|".join([UNCUT, *map(re.escape, added)])
        self.memory = WordMemory()

    def encode_text(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        raise NotImplementedError

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of words as they stand after a space."""
        raise NotImplementedError

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after the other, and how many each has."""
        memory = self.memory
        hashes = memory.hash(words)
        numbers = memory.find(hashes)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            made = self.encode_words(words.take(pa.array(new)).to_pylist())
            if memory.count + len(new) > REMEMBERED:
                memory.add(hashes[:, new], made)  # forgets the others: encode those of this batch again
                return self._ids(words) if len(words) <= REMEMBERED else self._unremembered(words)
            numbers[new] = memory.add(hashes[:, new], made)
        ids, _ = gathered(memory.ids, memory.begins, memory.sizes, numbers)
        return ids, memory.sizes[numbers]

    def _unremembered(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = self.encode_words(words.to_pylist()) if len(words) else []
        sizes = np.fromiter(map(len, made), np.int32, len(made)) // 4
        return np.frombuffer(b"".join(made), dtype="<u4"), sizes

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other (null: none), and where each text's end."""
        batch = pc.fill_null(batch, "")
        whole = pc.match_substring_regex(batch, self.uncut)
        cut = pc.split_pattern(pc.if_else(whole, "", batch), " ")
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        distinct = cut.flatten().dictionary_encode()
        codes = distinct.indices.to_numpy()
        # The first word of a text has no space before it, and a text that is not cut is one word.
        first = bounds[:-1]
        table = distinct.dictionary
        spaced = np.bincount(codes, minlength=len(table)) > np.bincount(codes[first], minlength=len(table))
        short = pc.binary_length(table).to_numpy() <= LONGEST
        ids, sizes = self._ids(table.filter(pa.array(spaced & short)))
        more_ids, more_sizes = self._unremembered(table.filter(pa.array(spaced & ~short)))
        place = np.where(short, np.cumsum(spaced & short), np.cumsum(spaced & ~short) + len(sizes))
        place = (place - 1).astype(np.int32)[codes]
        heads: dict[str, int] = {}
        stored: list[bytes] = []
        starts = table.take(pa.array(codes[first])).to_pylist()
        known = len(sizes) + len(more_sizes)
        for at, start, text in zip(first.tolist(), starts, pc.if_else(whole, batch, None).to_pylist()):
            text = start if text is None else text
            if text not in heads:
                heads[text] = known + len(stored)
                stored.append(self.encode_text(text) if text else b"")
            place[at] = heads[text]
        head_sizes = np.fromiter(map(len, stored), np.int32, len(stored)) // 4
        sizes = np.concatenate([sizes, more_sizes, head_sizes])
        flat = np.concatenate([ids, more_ids, np.frombuffer(b"".join(stored), dtype="<u4")])
        out, ends = gathered(flat, np.cumsum(sizes) - sizes, sizes, place)
        return out, np.concatenate([[0], ends])[bounds[1:]]


class WordEncoder(WordTable):
    """By the tokenizers library: equal to its `encode(text, add_special_tokens=False)`.

    Of the new words of a batch, the distinct pieces are encoded by the library's model in one call,
    already written in byte symbols, which saves the library the alignment of each character with
    its source. The byte lengths of the tokens tell where pieces and words end.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.library = Tokenizer.from_file(path)
        self.symbols = Tokenizer(self.library.model)
        self.symbols.pre_tokenizer = CharDelimiterSplit(" ")
        self.mapping = {byte: ord(symbol) for symbol, byte in byte_symbols().items()} | {DELIMITER: ord(" ")}
        self.lengths = np.array([len(token) for token in token_bytes(path)], dtype=np.int64)
        cut = self.library.pre_tokenizer.pre_tokenize_str
        probes = {c: f"a{c}a1{c}1 {c} {c}" for c in map(chr, range(KNOWN_FROM))}
        odd = [c for c, probe in probes.items() if [probe[a:b] for _, (a, b) in cut(probe)] != PIECES.findall(probe)]
        self.odd = re.compile(f"[{re.escape(''.join(odd))}{chr(KNOWN_FROM)}-{chr(0x10FFFF)}]")
        super().__init__([token.content for token in self.library.get_added_tokens_decoder().values()])

    def encode_text(self, text: str) -> bytes:
        found = self.library.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype="<u4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        joined = " " + " ".join(words)
        if not self.odd.search(joined):
            return self._by_pieces(joined, words)
        plain = [word for word in words if not self.odd.search(word)]
        found = dict(zip(plain, self._by_pieces(" " + " ".join(plain), plain))) if plain else {}
        return [found[word] if word in found else self.encode_text(" " + word) for word in words]

    def _by_pieces(self, joined: str, words: list[str]) -> list[bytes]:
        pieces = PIECES.findall(joined)
        number = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
        raw = [piece.encode() for piece in number]
        written = bytes([DELIMITER]).join(raw).decode("latin-1").translate(self.mapping)
        ids = np.array(self.symbols.encode_batch_fast([written], add_special_tokens=False)[0].ids, dtype="<u4")
        begins, sizes = cuts(np.cumsum(self.lengths[ids]), np.cumsum(list(map(len, raw))))
        place = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        flat, _ = gathered(ids, begins, sizes, place)
        begins, sizes = cuts(np.cumsum(self.lengths[flat]), np.cumsum([len(word.encode()) + 1 for word in words]))
        stored, ends = flat.tobytes(), (4 * (begins + sizes)).tolist()
        return [stored[a:b] for a, b in zip([0, *ends], ends)]


def cuts(ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of tokens begin, and of how many they are: tokens end at bytes `ends`, runs at `wanted`."""
    last = np.searchsorted(ends, wanted, side="left") + 1
    if len(last) and (last[-1] > len(ends) or not np.array_equal(ends[last - 1], wanted)):
        raise ValueError("a token crosses two words: not a byte-level vocabulary")
    sizes = np.diff(last, prepend=0)
    return last - sizes, sizes


def gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, place: np.ndarray):
    """The runs `place` of `flat` one after the other, and where each ends."""
    counts = sizes[place]
    ends = np.cumsum(counts)
    spread = np.repeat((begins[place] - ends + counts).astype(np.int32), counts)
    spread += np.arange(len(spread), dtype=np.int32)
    return flat[spread], ends


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    return WordEncoder(path)
