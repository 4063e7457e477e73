"""Personal data: rules, and a character tagger trained on what the rules find and on other spellings of it.

Base spans come from four rules over the whole text. The tagger (bidirectional LSTM with CRF transitions, see
`tagger`) is trained on windows around base spans and on plain windows of a bounded sample: at most
`DOCUMENTS` documents (those whose ids hash lowest) and `WINDOWS` windows of them. Each span is also spelled anew
there as the rules do not know it: `(at)` and `dot` in addresses, other separators of numbers, a missing plus sign, two
card numbers side by side. Plain windows get numbers that are nothing: dates, order numbers, versions. The tagger then
reads every text in overlapping windows. A span that it finds is added when it touches no base span, stands free
of letters and digits, and passes the check of its kind on its digits or its parts; several card numbers in one
are told apart by their check digits.

Offsets count code points, ends are exclusive. Null texts are empty and have no spans. Rows without
an id are read like others, but not learnt from; texts of any length are. Repeated rows are kept. An empty table gives
an empty one; without base spans in the sample nothing is added. Other columns are carried along by
`mask`, and not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import tagger
from holdfast.llm.common import lowest_hashes, map_batches

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DOTTED = re.compile(r"[0-9]\.[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

#: The sample that the tagger is trained on.
DOCUMENTS, WINDOWS, LENGTH, STEPS = 6000, 4000, 80, 500
#: Other spellings of each span that it sees.
RESPELLED = 4
#: Characters around tagged ones in which a span that they point at lies.
REACH = 40

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: found from the @, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def is_kind(kind: str, text: str) -> bool:
    """The check that a match must pass."""
    digits = NOT_DIGITS.sub("", text)
    if kind == "ip":
        return all(int(part) <= 255 if len(part) < 9 else False for part in (p.lstrip("0") or "0" for p in text.split(".")))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def base_spans(text: str) -> list[Span]:
    """The rules' spans by start, then kind."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if DOTTED.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if is_kind("ip", m[0])]
    found += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 14 and is_kind("card", m[0])]
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if is_kind("phone", m[0])]
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def digest(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def tag_array(spans: list[Span], length: int) -> np.ndarray:
    tags = np.zeros(length, dtype=np.int8)
    for kind, start, end in reversed(spans):
        tags[start:end] = KINDS.index(kind) + 1
    return tags


# Other spellings of the parts of a span.
ATS = ("@", " at ", "(at)", " (at) ", "[at]", " [at] ")
DOTS = (".", " dot ", "(dot)", " (dot) ", "[dot]", "[.]", "(.)")
ENDINGS = ("com", "org", "net", "edu", "io", "de", "fr", "es", "co.uk")
SEPARATORS = (" ", "-", ".", "/", "_", "  ", " - ", "\u2013", "\u00a0")

AT, DOT = (r"(?:%s)" % "|".join(map(re.escape, sorted(texts, key=len, reverse=True))) for texts in (ATS, DOTS))
GAP = r"(?:[\x20\u00a0]?[-./_\u2013][\x20\u00a0]?|[\x20\u00a0]{1,2})"

#: What a span must look like as a whole, beside the check of its kind; matched in linear time, from starts of runs on.
SHAPES = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++", re.I),
    "ip": re.compile(rf"(?<![0-9])[0-9]{{1,3}}+(?:{DOT}[0-9]{{1,3}}+){{3}}", re.I),
    "card": re.compile(rf"(?<![0-9])[0-9]++(?:{GAP}[0-9]++)*+"),
    "phone": re.compile(rf"(?<![0-9])[+]?[(]?[0-9]++[)]?(?:{GAP}?[(]?[0-9]++[)]?)*+"),
}


def cards(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The card numbers that a run of digits and separators consists of, none where it does not: pieces of 14 to 19 digits
    that pass the check, together all digits, of which the first is as near to 16 as can be, and so on."""
    at = [i for i in range(start, end) if text[i].isdigit()]
    digits = "".join(text[i] for i in at)
    if len(digits) > 200:
        return []
    sizes = (16, 15, 17, 14, 18, 19)
    pieces: dict[int, list[tuple[int, int]] | None] = {len(at): []}
    for i in range(len(at) - 14, -1, -1):
        for size in sizes:
            rest = pieces.get(i + size)
            # A number starts at the beginning of a group of digits.
            if rest is not None and (i == 0 or at[i] > at[i - 1] + 1) and luhn(digits[i : i + size]):
                pieces[i] = [(at[i], at[i + size - 1] + 1), *rest]
                break
    return pieces.get(0) or []


def checked(kind: str, text: str, start: int, end: int) -> list[Span]:
    """The spans that a piece of a text with the shape of its kind is."""
    if kind == "card":
        return [(kind, a, b) for a, b in cards(text, start, end)]
    piece = re.sub(DOT, ".", text[start:end], flags=re.I) if kind == "ip" else text[start:end]
    return [(kind, start, end)] if is_kind(kind, piece) else []


def added_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """What the tagger points at: pieces near tagged characters that have the shape of a kind, at least half of their characters
    tagged, no letter or digit beside them and no base span in them, and pass the check of the kind."""
    tagged = np.flatnonzero(tags)
    if not len(tagged):
        return []
    taken = tag_array(base, len(text)) > 0
    counts = np.concatenate([[0], np.cumsum(tags > 0)])
    breaks = np.flatnonzero(np.diff(tagged) > 2 * REACH)
    out = []
    for a, b in zip(tagged[np.r_[0, breaks + 1]].tolist(), tagged[np.r_[breaks, len(tagged) - 1]].tolist()):
        for kind in KINDS:
            for match in SHAPES[kind].finditer(text, max(0, a - REACH), b + REACH):
                start, end = match.span()
                pointed = 2 * (counts[end] - counts[start]) >= end - start
                alone = not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum())
                if pointed and alone and not taken[start:end].any():
                    for span in checked(kind, text, start, end):
                        out.append(span)
                        taken[span[1] : span[2]] = True
    return out


def respelled(kind: str, piece: str, random: np.random.Generator) -> str:
    """A span as the rules would not find it."""

    def one(texts: tuple[str, ...]) -> str:
        return texts[int(random.integers(len(texts)))]

    if kind == "email":
        at, dot = one(ATS[1:]), one(DOTS)
        local, _, domain = piece.partition("@")
        if random.random() < 0.7:  # other names too
            letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
            words = ["".join(random.choice(letters, int(random.integers(2, 9)))) for _ in range(4)]
            local = words[0] + one(("", ".", "_")) + one(("", words[1], str(int(random.integers(100)))))
            domain = ".".join([*words[2 : int(random.integers(3, 5))], one(ENDINGS)])
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return piece.replace(".", one(DOTS[1:]))
    digits = NOT_DIGITS.sub("", piece)
    if kind == "card":
        gap = one(SEPARATORS[2:]) if random.random() < 0.6 else one(SEPARATORS[:2])
        grouped = gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
        return grouped if gap not in SEPARATORS[:2] else grouped + " " + grouped
    gap = one(SEPARATORS)
    last = (len(digits) - 4) // 3 * 3
    parts = [digits[i : i + 3] for i in range(0, last, 3)] + [digits[last:]]
    if random.random() < 0.3:
        parts[0] = f"({parts[0]})"
    return one(("", "", "00")) + gap.join(parts)


def decoy(random: np.random.Generator) -> str:
    """Numbers and words that are no personal data."""

    def number(low: int, high: int) -> str:
        return str(int(random.integers(low, high)))

    kinds = (
        lambda: f"{number(1990, 2030)}-{number(10, 13)}-{number(10, 29)}",
        lambda: f"{number(1, 29)}.{number(1, 13)}.{number(1990, 2030)}",
        lambda: ".".join(number(0, 30) for _ in range(int(random.integers(2, 4)))),
        lambda: number(1, 10 ** int(random.integers(2, 9))),
        lambda: f"{number(1, 24)}:{number(10, 60)} at the dot",
        lambda: f"{number(1, 900)},{number(100, 999)}.{number(10, 99)}",
        lambda: f"{number(1, 900)} {number(100, 999)}",
    )
    return kinds[int(random.integers(len(kinds)))]()


def training_windows(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(windows, tags) of character numbers and of 0 or the kind, from the sampled documents; shorter texts are
    filled up with the number 0, of nothing."""
    chosen = lowest_hashes(docs.where("text is not null"), "doc_id", DOCUMENTS)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        orders, windows, labels = [], [], []

        def learn(order: int, text: str, tags: np.ndarray) -> None:
            coded = tagger.numbers(text)[:LENGTH]
            orders.append(order)
            windows.append(np.pad(coded, (0, LENGTH - len(coded))).tobytes())
            labels.append(np.pad(tags[:LENGTH], (0, LENGTH - len(tags[:LENGTH]))).tobytes())

        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            random = np.random.default_rng(doc_id & 0x7FFFFFFF)
            spans = base_spans(text)
            tags = tag_array(spans, len(text))
            for n, (kind, start, end) in enumerate(spans):
                for new in [text[start:end], *[respelled(kind, text[start:end], random) for _ in range(RESPELLED)]]:
                    left = max(0, start - int(random.integers(0, 40)))
                    mark = np.full(len(new), KINDS.index(kind) + 1, np.int8)
                    after = slice(end, end + LENGTH)
                    learn(n, text[left:start] + new + text[after], np.concatenate([tags[left:start], mark, tags[after]]))
            digits = [m.start() for m in CARD.finditer(text)]
            starts = [max(0, at - 30) for at in digits[:1]] + [int(random.integers(0, max(1, len(text) - LENGTH)))]
            for start in starts:
                at = min(len(text), start + int(random.integers(0, LENGTH)))
                new = f" {decoy(random)} " if random.random() < 0.7 and not tags[at - 1 : at + 1].any() else ""
                plain = np.zeros(len(new), np.int8)
                rest = slice(at, at + LENGTH)
                learn(-1, text[start:at] + new + text[rest], np.concatenate([tags[start:at], plain, tags[rest]]))
        columns = [pa.array(orders, pa.int32()), pa.array(windows, pa.binary()), pa.array(labels, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["place", "window", "tags"])

    sampled = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = map_batches(sampled, each, "place int, window binary, tags binary", rows=200)
    rows = rows.withColumn("tagged", F.col("place") >= 0)
    # Half of the windows around spans, half others, each in the order of their hash.
    halves = [
        rows.where(F.col("tagged") == kind).orderBy(F.xxhash64("window"), "window", "tags").limit(WINDOWS // 2)
        for kind in (True, False)
    ]
    found = [row for half in halves for row in half.select("window", "tags").collect()]
    windows = np.frombuffer(b"".join(bytes(row.window) for row in found), np.uint8).reshape(-1, LENGTH)
    tags = np.frombuffer(b"".join(bytes(row.tags) for row in found), np.int8).reshape(-1, LENGTH)
    return windows, tags


def train(docs: DataFrame) -> tagger.Tagger | None:
    windows, tags = training_windows(docs)
    if not tags.any():
        return None
    model = tagger.Tagger.fresh(len(KINDS) + 1)
    model.train(windows, tags, STEPS)
    return model


def spans_of(texts: list[str], narrow) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    tags = tagger.tag_texts(narrow, texts) if narrow else [None] * len(texts)
    for text, tag in zip(texts, tags):
        base = base_spans(text)
        added = added_spans(text, tag, base) if tag is not None and tag.any() else []
        yield base, ordered(base + added)


def find(docs: DataFrame, model: tagger.Tagger | None) -> DataFrame:
    """(doc_id, base, spans): lists of (kind, start, end) of every row."""
    narrow = model.narrow() if model else None
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        found = list(spans_of(texts, narrow))
        columns = [
            pa.array([[dict(zip(("kind", "start", "end"), s)) for s in side[i]] for side in found], pa.list_(span))
            for i in (0, 1)
        ]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "spans"])

    kind = "array<struct<kind:string,start:int,end:int>>"
    return map_batches(docs.select("doc_id", "text"), each, f"doc_id long, base {kind}, spans {kind}", rows=200)


def masked(text: str, spans: list[Span]) -> str:
    """`text` with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        else:
            out.append("")
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, model: tagger.Tagger | None) -> DataFrame:
    """`docs` with personal data masked in `text`; null texts stay null, other columns as they are."""
    narrow = model.narrow() if model else None
    place = docs.columns.index("text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(place).to_pylist()
        found = spans_of([text or "" for text in texts], narrow)
        new = [None if text is None else masked(text, spans) for text, (_, spans) in zip(texts, found)]
        columns = [batch.column(i) if i != place else pa.array(new, pa.string()) for i in range(batch.num_columns)]
        return pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_batches(docs, each, docs.schema, rows=200)
