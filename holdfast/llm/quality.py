"""Document quality by Bradley-Terry ranking.

A document's worth is a weighted sum of features of its text. The weights come from preference pairs, a
document of label 1 over one of label 0, by logistic loss on the difference of their features. The
threshold is a quantile of the scores: the share of label 0 among the labels. Scores are mapped to 0
to 1 so that the threshold is `THRESHOLD`.

The fit sees a bounded sample: at most `LABELLED` documents of each label (those whose ids hash lowest) and
`PAIRS` pairs of them. The share of labels, and the threshold, are of all labelled documents that are not held
out. Labels of documents that are not in the table count nowhere. Features, and scores, are of every whole text.

Null texts are empty; all features of an empty text are 0 and it is scored like any other. Rows
without an id are scored but never learnt from; rows that repeat an id are learnt from once, by the
least features, and labels of one id count once, the greater one. Where the documents do not have labels
of both kinds there is a warning and every score is 0.5. An empty table gives an empty one.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import lowest_hashes, map_batches, materialize, numbered

#: Labelled rows of each kind, and pairs of them, that a fit sees at most.
LABELLED = 5000
PAIRS = 200_000
THRESHOLD = 0.3
#: The score of everything where there is nothing to learn from.
UNKNOWN = 0.5
RIDGE = 1e-3
SEED = 42
#: Bits of a score that one histogram tells apart.
DIGIT = 16

FEATURES = (
    "words",
    "word_length",
    "word_length_spread",
    "upper_words",
    "title_words",
    "plain_words",
    "digits",
    "symbols",
    "marks",
    "word_variety",
    "top_word",
    "repeated_neighbours",
    "repeated_lines",
    "line_words",
    "stop_marks",
    "long_words",
)

DIGITS = bytes(range(48, 58))
STOPS = b".,;:?'\""
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in STOPS)
NOT_DIGITS = bytes(b for b in range(256) if b not in DIGITS)
NOT_STOPS = bytes(b for b in range(256) if b not in STOPS)
NOT_MARKS = bytes(b for b in range(256) if b not in MARKS)


def features(text: str) -> list[float]:
    """The features of one text, in the order of FEATURES."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size, raw = len(words), len(text), text.encode("utf-8", "surrogatepass")
    lengths = np.fromiter(map(len, words), np.float64, n)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    marks = len(raw.translate(None, NOT_MARKS))
    return [
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        sum(map(str.isalpha, words)) / n,
        len(raw.translate(None, NOT_DIGITS)) / size,
        marks / n,
        np.log1p(marks),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        len(raw.translate(None, NOT_STOPS)) / n,
        float((lengths > 20).mean()),
    ]


def document_features(docs: DataFrame, row: Sequence[str] = ()) -> DataFrame:
    """(doc_id, features) of every row, and the columns `row` (long) before."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [features(text or "") for text in batch.column("text").to_pylist()]
        values = pa.array(rows, pa.list_(pa.float64()))
        columns = [*[batch.column(c) for c in row], batch.column("doc_id"), values]
        return pa.RecordBatch.from_arrays(columns, [*row, "doc_id", "features"])

    schema = ", ".join([*[f"`{c}` long" for c in row], "doc_id long, features array<double>"])
    return map_batches(docs.select(*row, "doc_id", "text"), each, schema, rows=500)


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % 5 == 0


@dataclass(frozen=True)
class Ranking:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float

    def worth(self, rows: np.ndarray) -> np.ndarray:
        """The weighted sums, added up row by row so that none depends on the rows beside it."""
        return ((rows - np.array(self.mean)) / np.array(self.scale) * np.array(self.weights)).sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        shifted = np.clip(self.worth(rows) - self.threshold, -500, 500) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-shifted))


def fit_pairs(good: np.ndarray, bad: np.ndarray, bad_share: float) -> Ranking:
    """Newton's method on the mean logistic loss of pairs, then the threshold at the quantile of these rows."""
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale == 0] = 1
    good, bad = (good - mean) / scale, (bad - mean) / scale
    random = np.random.default_rng(SEED)
    differences = good[random.integers(0, len(good), PAIRS)] - bad[random.integers(0, len(bad), PAIRS)]
    weights = np.zeros(len(mean))
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(differences @ weights, -500, 500)))
        slope = differences.T @ (chance - 1) / PAIRS + RIDGE * weights
        curve = (differences * (chance * (1 - chance))[:, None]).T @ differences / PAIRS
        step = np.linalg.solve(curve + RIDGE * np.eye(len(mean)), slope)
        weights -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    # The quantile of the scores of all labels, from those of these rows by their weight.
    worth = np.concatenate([good @ weights, bad @ weights])
    weight = np.concatenate([np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad))])
    order = np.argsort(worth, kind="stable")
    at = int(np.searchsorted(np.cumsum(weight[order]), bad_share - 1e-12))
    above = order[min(at + 1, len(order) - 1)]
    threshold = (worth[order[at]] + worth[above]) / 2
    return Ranking(mean.tolist(), scale.tolist(), weights.tolist(), float(threshold))


def ordinals(values: np.ndarray) -> np.ndarray:
    """Integers that sort, and differ, as the numbers do."""
    raw = (values + 0.0).view(np.int64)  # no negative zero
    return np.where(raw < 0, raw ^ np.int64((1 << 63) - 1), raw)


def number(ordinal: int) -> float:
    raw = np.int64(ordinal)
    return float((raw ^ np.int64((1 << 63) - 1) if raw < 0 else raw).view(np.float64))


def exact_threshold(learned: DataFrame, ranking: Ranking, counts: dict[int, int]) -> float:
    """The quantile of the worths of all rows of `learned` (quality, features), at the share of label 0 in `counts`.

    Histograms over the next `DIGIT` bits of the worths tell in which range the quantile lies, until the
    range is one number.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
        columns = [pa.array(ordinals(ranking.worth(values))), batch.column("quality")]
        return pa.RecordBatch.from_arrays(columns, ["worth", "quality"])

    scored = materialize(map_batches(learned, each, "worth long, quality int", rows=10_000))
    wanted, below, inside = counts[0], 0, scored
    for shift in range(64 - DIGIT, -1, -DIGIT):
        digit = F.shiftright("worth", shift)
        histogram = inside.groupBy(digit.alias("digit")).count()
        for at, n in sorted(tuple(row) for row in histogram.collect()):
            if below + n >= wanted:
                break
            below += n
        inside = scored.where(digit == at)
    # As in `fit_pairs`: halfway to the row that sorts after the one that reaches the share.
    last = below + n == wanted
    above = scored.where(F.col("worth") > at).agg(F.min("worth")).first()[0] if last else None
    return (number(at) + number(at if above is None else above)) / 2


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, features) of every document of `rows` (doc_id, features) that `labels` (doc_id, quality) tells of and
    that is not held out, one row each: of rows that share an id, the one with the least features."""
    known = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("quality") > 0).cast("int").alias("quality"))
    )
    return rows.join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min("features").alias("features"))


def fit(rows: DataFrame, labels: DataFrame) -> Ranking | None:
    """Learn from `rows` (doc_id, features) and `labels` (doc_id, quality), held-out ids aside; None, and a warning, where
    the documents do not have labels of both kinds."""
    learned = materialize(labelled(rows, labels))
    counts = {row.quality: row["count"] for row in learned.groupBy("quality").count().collect()}
    if set(counts) != {0, 1}:
        warnings.warn(f"no quality ranking: labelled documents by label are {counts}, so every score is {UNKNOWN}", stacklevel=2)
        return None
    kinds = []
    for kind in (0, 1):
        mine = learned.where(F.col("quality") == kind)
        chosen = mine.join(F.broadcast(lowest_hashes(mine, "doc_id", LABELLED)), "doc_id").orderBy("doc_id")
        kinds.append(np.array(chosen.select("features").toPandas().features.tolist(), dtype=np.float64))
    ranking = fit_pairs(kinds[1], kinds[0], counts[0] / (counts[0] + counts[1]))
    return replace(ranking, threshold=exact_threshold(learned, ranking, counts))


def score(docs: DataFrame, labels: DataFrame, row: Sequence[str] = ()) -> DataFrame:
    """(doc_id, score, predicted) of every row, and the columns `row` (long) before; `predicted` is 1 from
    THRESHOLD on."""
    rows = materialize(document_features(docs, row))
    ranking = fit(rows, labels)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
        scores = ranking.score(values) if ranking else np.full(batch.num_rows, UNKNOWN)
        predicted = (scores >= THRESHOLD).astype(np.int32)
        columns = [*[batch.column(c) for c in row], batch.column("doc_id"), pa.array(scores), pa.array(predicted)]
        return pa.RecordBatch.from_arrays(columns, [*row, "doc_id", "score", "predicted"])

    schema = ", ".join([*[f"`{c}` long" for c in row], "doc_id long, score double, predicted int"])
    return map_batches(rows, each, schema, rows=10_000)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows predicted 0, each by itself, whether or not it has an id or shares it."""
    rows = numbered(docs)
    rejected = score(rows.select("row", "doc.doc_id", "doc.text"), labels, ["row"]).where("predicted = 0").select("row")
    return rows.join(rejected, "row", "left_anti").select("doc.*")
