"""Vector codes against plain Lloyd rounds, and the cover trees' own rules."""

import hashlib

import numpy as np
import pytest

from holdfast.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, code string, part string"


def plain(vectors, entries, rounds, parts=16):
    """(codes, errors, codebooks) of integer vectors, sorted by id, by comparing everything with everything."""
    cut = vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2)
    books = cut[:, :entries].copy()
    for step in range(rounds + 1):
        distance = ((cut[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        codes, least = distance.argmin(axis=2), distance.min(axis=2)
        if step < rounds:
            for part in range(parts):
                for entry in range(books.shape[1]):
                    mine = cut[part][codes[part] == entry]
                    if len(mine):
                        books[part, entry] = mine.sum(axis=0) // len(mine)
    return codes.T, least.sum(axis=0), books


def run(table, entries=64, rounds=2):
    blocks = vector_codes.VectorBlocks(table)
    books = vector_codes.fit(blocks, entries, rounds)
    return vector_codes.with_label_errors(blocks.encoded(books), blocks.rows).collect(), books


@pytest.mark.parametrize("width,entries", [(16, 5), (32, 64), (80, 20)])
def test_codes_equal_plain_rounds(spark, monkeypatch, width, entries):
    monkeypatch.setattr(vector_codes, "BLOCK", 150)
    random = np.random.default_rng(width)
    centres = random.normal(size=(12, width))
    vectors = (centres[random.integers(0, 12, 700)] + random.normal(size=(700, width)) * random.choice([0, 0.02, 0.3], (700, 1))).astype(np.float32)
    ids = random.permutation(5000)[:700]
    rows = [(int(i), v.tolist(), int(i) % 3 if i % 7 else None, "v", "c", "p") for i, v in zip(ids, vectors)]
    found, books = run(spark.createDataFrame(rows, SCHEMA).repartition(3), entries)
    order = np.argsort(ids)
    whole = np.floor(vectors[order].astype(np.float64) * 256).astype(np.int64)
    codes, errors, expected = plain(whole, entries, 2)
    assert (books.array == expected).all()
    found = {row.vec_id: row for row in found}
    labels = {}
    for at, row in zip(order, errors):
        labels[rows[at][2]] = labels.get(rows[at][2], 0) + int(row)
    for place, at in enumerate(order):
        row = found[int(ids[at])]
        assert (list(row.code), row.error) == (codes[place].tolist(), errors[place])
        assert (row.label, row.label_error) == (rows[at][2], labels[rows[at][2]])


def test_odd_vectors(spark):
    one = [0.5] * 16
    rows = [
        (4, one, 1), (4, one, 1), (2, None, 1), (3, [0.1, None], 1), (5, [float("nan")] * 16, None), (6, [float("inf")] * 16, 2), (None, [1.0] * 20, None),
        (7, [], None), (8, [-0.001] * 3, 3), (1, [0.25] * 32, 3),
    ]
    table = spark.createDataFrame([(*row, "v", "c", "p") for row in rows], SCHEMA).repartition(3)
    found, books = run(table)
    # In order of ids, the null one last; filled up to 32 components.
    vectors = np.zeros((6, 32), np.int64)
    vectors[0], vectors[1, :16], vectors[2, :16], vectors[4, :3], vectors[5, :20] = 64, 128, 128, -1, 256
    codes, errors, expected = plain(vectors, 64, 2)
    assert (books.array == expected).all()
    ids = [1, 4, 4, 7, 8, None]
    assert sorted((str(row.vec_id), list(row.code), row.error) for row in found) == sorted((str(i), c.tolist(), e) for i, c, e in zip(ids, codes, errors))
    for none in (table.limit(0), table.where("embedding IS NULL")):
        assert run(none)[0] == []
    with pytest.raises(ValueError):
        run(spark.createDataFrame([(1, [3e7], 1, "v", "c", "p")], SCHEMA))


def test_cover_trees_keep_their_rules():
    random = np.random.default_rng(3)
    parts = np.concatenate([random.integers(-300, 300, (1, 900, 3)), random.integers(0, 3, (1, 900, 3)), np.zeros((1, 900, 3), np.int64)])
    trees = vector_codes.cover_trees(parts)
    assert sorted(trees.vector[900:1800]) == list(range(900))
    assert (trees.points == parts[np.repeat(range(3), 900), trees.vector]).all()
    inner = np.flatnonzero(trees.children)
    assert len(inner) > 30
    for node in range(len(trees.part)):
        points = trees.points[trees.start[node] : trees.end[node]]
        assert ((points - points[0]) ** 2).sum(axis=1).max() == trees.far[node]
        if trees.children[node]:
            below = np.arange(trees.child[node], trees.child[node] + trees.children[node])
            assert trees.start[below[0]] == trees.start[node] and trees.end[below[-1]] == trees.end[node]
            assert (trees.end[below[:-1]] == trees.start[below[1:]]).all()
            power = 1
            while power < trees.far[node]:
                power *= 4
            centres = trees.points[trees.start[below]]
            apart = ((centres[:, None] - centres[None]) ** 2).sum(axis=2)[~np.eye(len(below), dtype=bool)]
            assert (4 * trees.far[below] <= power).all() and (4 * apart > power).all()
        else:
            assert trees.far[node] == 0 or len(points) <= vector_codes.LEAF


def test_whole_subtrees_are_assigned():
    """Tight groups far apart are decided at few nodes, by running sums."""
    random = np.random.default_rng(5)
    centres = random.integers(-5000, 5000, (1, 20, 4))
    parts = centres[:, np.arange(4000) % 20] + random.integers(-3, 4, (1, 4000, 4))
    trees = vector_codes.cover_trees(parts)
    ranges = list(vector_codes.assign(trees, parts[:, :20].copy()))
    assert sum((end - start).sum() for _, start, end, _ in ranges) == 4000
    assert sum(len(start) for _, start, _, _ in ranges) < 100


def test_query_codes_are_sound(query):
    rows = query("op13_vector_codes")
    assert len({row.codebooks_sha256 for row in rows}) == 1 and all(len(row.code) == 32 for row in rows)
    assert hashlib.sha256(b"").hexdigest() != rows[0].codebooks_sha256
    assert all(row.error >= 0 for row in rows)
