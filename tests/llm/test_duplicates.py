import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from check import rows as comparable
from holdfast.llm import embedding_dedup, exact_dedup, registry, simhash, substring_dedup

from .test_common import components


def test_op9_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(registry.ORACLES["op9_exact_dedup"]).df()
    found = registry.QUERIES["op9_exact_dedup"](spark, sf_dir).toPandas()
    assert comparable(found) == comparable(expected)
    assert found.dtypes.sort_index().to_dict() == expected.dtypes.sort_index().to_dict()


def test_exact_groups_of_odd_documents(odd_docs, no_docs):
    rows = exact_dedup.exact_groups(odd_docs).collect()
    groups = {}
    for row in odd_docs.collect():
        groups.setdefault(re.sub(r"[ \t-\r]+", " ", row.text or ""), []).append(row.doc_id)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(rows) == odd_docs.count()
    for row in rows:
        ids = by_hash[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids) and row.keep_id == (min(known) if known else None)
    assert sum(row.kept for row in rows) == len(groups)
    assert exact_dedup.exact_groups(no_docs).collect() == []


def test_frequent_texts_are_salted_and_joined_up(spark):
    rows = [(i, "same  text" if i % 3 else "same text", "x") for i in range(3000)] + [(5000, "other", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, salt string").repartition(5)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 5000]
    assert {(r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs).collect()} == {(0, 3000), (5000, 1)}


def test_exact_dedup_is_native(spark, sf_dir):
    plan = registry.QUERIES["op9_exact_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and not re.search("Python|Arrow|Pandas", plan)


def slow_fingerprint(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius=3):
    n = len(prints)
    return [(i, j) for i in range(n) for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius) + i + 1]


def test_op8_against_brute_force(query, plain_docs):
    rows = sorted(query("op8_simhash"))
    assert [r.doc_id for r in rows] == sorted(plain_docs)
    for row in rows[:300]:
        assert row.fingerprint == f"{slow_fingerprint(plain_docs[row.doc_id]):016x}"
    ids = [r.doc_id for r in rows]
    prints = np.array([int(r.fingerprint, 16) for r in rows], dtype=np.uint64)
    expected = components([(i, i) for i in ids] + [(ids[i], ids[j]) for i, j in linked(prints)])
    assert {r.doc_id: r.component_id for r in rows} == expected


def test_simhash_of_odd_documents(odd_docs, no_docs):
    found = {}
    for row in simhash.near_groups(odd_docs).collect():
        found.setdefault(row.doc_id, []).append(row)
    by_id = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    for doc_id, text in by_id.items():
        assert all(r["print"] & (1 << 64) - 1 == slow_fingerprint(text or "") for r in found[doc_id])
    assert {found[i][0].component_id for i in (2, 3, 4)} == {2}
    assert {r.component_id for i in (1, 7, 8) for r in found[i]} == {1}
    assert {r.component_id for r in found[None]} == {None, 2}  # the empty one is like other empty ones
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, 6, 9, None, None], key=str)
    assert simhash.near_groups(no_docs).collect() == []


def test_texts_that_share_an_id_are_kept_apart(spark):
    """The text without a copy stays although another row of its id goes, and so does a group of its own."""
    one, two, three = ("".join(f"{w}{i} " for i in range(60)) for w in "abc")
    rows = [(1, one), (2, one), (2, two), (3, three), (3, two), (4, three), (5, "x y z"), (5, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [(1, one), (2, two), (3, three), (5, "x y z")]


@pytest.mark.parametrize("distinct", [10, 10**6, 10**9])
def test_block_masks_miss_no_pair(distinct):
    masks = simhash.block_masks(distinct, 3)
    rng = np.random.default_rng(1)
    for _ in range(2000):
        differ = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(differ & mask == 0 for mask in masks)


def test_bit_slices_equal_counted_bits():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 30, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64) for _ in range(3)]
    prints = base[rng.integers(0, 30, 900)] ^ flips[0] ^ flips[1] ^ np.where(rng.random(900) < 0.5, flips[2], np.uint64(0))
    groups = np.sort(rng.integers(0, 5, 900))
    for radius in (0, 1, 2, 3, 5):
        pairs = [(i, j) for i, j in linked(prints, radius) if groups[i] == groups[j]]
        alone = [(i, i) for i in range(900)]
        assert components(alone + simhash.forest(groups, prints, radius)) == components(alone + pairs)


def test_crowded_blocks_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 40)
    rng = np.random.default_rng(3)
    prints = np.unique(np.uint64(7 << 40) ^ (np.uint64(1) << rng.integers(0, 30, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 30, 400).astype(np.uint64)))
    rows = [(int(p), i) for i, p in enumerate(prints.tolist())]
    found = simhash.links(spark.createDataFrame(rows, "print long, representative long"), 3).collect()
    alone = [(i, i) for i in range(len(rows))]
    assert components(alone + [tuple(r) for r in found]) == components(alone + linked(prints))


def brute_vectors(vectors, labels, ids, threshold=0.93):
    x = np.stack(vectors).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = (x @ x.T >= threshold) & (labels[:, None] == labels)
    np.fill_diagonal(close, False)
    return close.sum(axis=1), components([(i, i) for i in ids] + [(ids[i], ids[j]) for i, j in zip(*np.nonzero(close))])


def test_op4_against_brute_force(spark, query, sf_dir):
    table = duckdb.sql(f"SELECT * FROM '{sf_dir}/embeddings.parquet' ORDER BY vec_id").df()
    counts, classes = brute_vectors(table.embedding.values, table.label.values, table.vec_id.tolist())
    rows = sorted(query("op4_embedding_dedup"))
    assert [r.n_links for r in rows] == counts.tolist()
    assert {r.vec_id: r.component_id for r in rows} == classes
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_pairs_at_the_threshold(spark, kind):
    rng = np.random.default_rng(5)
    n = 700
    a, b = rng.standard_normal((2, n, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    near = rng.uniform(0.9, 0.97, n)[:, None]
    vectors = np.concatenate([a, a * near + b * np.sqrt(1 - near**2)]).astype(np.float32 if kind == "float" else float)
    rows = [(i, v.tolist(), i % n % 2) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    found = sorted(embedding_dedup.near_vectors(table).collect())
    counts, _ = brute_vectors(vectors, np.arange(2 * n) % n % 2, list(range(2 * n)))
    links = np.array([r.n_links for r in found])
    assert (links <= counts).all() and links.sum() >= 0.97 * counts.sum()


def test_odd_vectors(spark):
    one = [1.0] * 64
    rows = [
        (1, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [0.0] * 64, 1), (7, [float("nan")] * 64, 1),
        (8, [float("inf")] * 64, 1), (9, [None, 1.0], 1), (10, [], 1), (None, one, 1), (11, [1e300, 1e300], 1), (12, [3.0, 3.0], 1),
        (2, one, 1), (13, one[:63], 1),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, row string")
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(table).collect()), key=str)
    alone = {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 13)}
    assert alone <= set(found) and (None, 0, None, True) in found
    assert found.count((2, 2, 1, False)) == 2 and (1, 2, 1, True) in found
    assert (11, 1, 11, True) in found and (12, 1, 11, False) in found
    assert embedding_dedup.near_vectors(table.where("false")).collect() == []


def test_equal_vectors_are_one_class(spark):
    """Copies link with each other and with all copies of near vectors, and cost no pairs."""
    rng = np.random.default_rng(11)
    base, far = rng.standard_normal((2, 64))
    near = base + rng.normal(0, 0.05, 64)
    n, m = 20_000, 300
    rows = [(i, base.tolist(), 1) for i in range(10, 10 + n)] + [(i, near.tolist(), 1) for i in range(50_000, 50_000 + m)]
    rows += [(7, far.tolist(), 1), (3, base.tolist(), 2), (50_000, far.tolist(), 1), (8, [0.0, -0.0, 1.0], 3), (9, [-0.0, 0.0, 1.0], 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    numbered = table.select(F.monotonically_increasing_id().alias("row"), "*")
    assert embedding_dedup.classes(embedding_dedup.usable(numbered)).count() == 5
    found = embedding_dedup.near_vectors(table).groupBy("n_links", "component_id", "kept").count()
    assert {tuple(r) for r in found.collect()} == {
        (n + m - 1, 7, False, n + m), (1, 7, True, 1), (1, 7, False, 1), (0, 3, True, 1), (1, 8, True, 1), (1, 8, False, 1),
    }


def test_crowded_vectors_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 50)
    rng = np.random.default_rng(6)
    vectors = np.concatenate([np.ones(64) + rng.normal(0, 0.2, (300, 64)), rng.standard_normal((200, 64))])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    found = sorted(embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    counts, classes = brute_vectors(vectors, np.zeros(500), list(range(500)))
    links = np.array([r.n_links for r in found])
    assert (links <= counts).all() and links.sum() >= 0.97 * counts.sum()
    assert {r.vec_id: r.component_id for r in found} == classes


@pytest.mark.parametrize("width", [12, 15, 18])
def test_recall_of_wide_keys(spark, monkeypatch, width):
    """Keys as wide as those of labels of 200,000 to 12 million vectors; another label is compared in full."""
    rng = np.random.default_rng(8)
    n = 1500
    a, b = rng.standard_normal((2, n, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    near = 0.9301
    vectors, labels = np.concatenate([a, a * near + b * np.sqrt(1 - near**2)]), np.zeros(2 * n)
    labels[:300] = labels[n : n + 300] = 1
    monkeypatch.setattr(embedding_dedup, "TILE", 1000)
    monkeypatch.setattr(embedding_dedup, "CROWD", 2400 / 2**width)
    rows = [(i, v.tolist(), int(label)) for i, (v, label) in enumerate(zip(vectors, labels))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(embedding_dedup.near_vectors(table).collect())
    counts, _ = brute_vectors(vectors, labels, list(range(2 * n)))
    links = np.array([r.n_links for r in found])
    assert (links <= counts).all() and links[labels == 0].sum() >= 0.98 * counts[labels == 0].sum()
    assert (links == counts)[labels == 1].all()


def brute_passages(docs, k=13):
    first, split = {}, [(i, (t or "").encode().split()) for i, t in docs]
    for i, words in split:
        for j in range(len(words) - k + 1 if i is not None else 0):
            window = b" ".join(words[j : j + k])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, words in split:
        gone = np.zeros(len(words), bool)
        for j in range(len(words) - k + 1 if i is not None else 0):
            if first[b" ".join(words[j : j + k])] < i:
                gone[j : j + k] = True
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(docs):
    rows = substring_dedup.remove_repeats(docs).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows), key=str)


def test_op5_against_brute_force(query, plain_docs):
    found = sorted((tuple(r) for r in query("op5_substring_dedup")), key=str)
    assert found == brute_passages(plain_docs.items())
    assert sum(n for _, _, n, _ in found) > 10_000


def test_passages_of_odd_documents(odd_docs, no_docs):
    assert passages(odd_docs) == brute_passages([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert substring_dedup.remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("frequent", [2, 64])
@pytest.mark.parametrize("small", [True, False])
def test_shared_passages(spark, monkeypatch, frequent, small):
    """Overlapping, nested and self-repeating passages; a passage in a third of all documents."""
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    if small:
        monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 2000)
        monkeypatch.setattr(substring_dedup, "CHARACTERS", 50)  # two characters to a word
    rng = np.random.default_rng(7)
    common = [f"c{i}" for i in range(60)]
    docs = []
    for i in range(200):
        words = [f"x{rng.integers(0, 5)}" if i % 7 == 0 else f"u{rng.integers(0, 2000)}" for _ in range(rng.integers(0, 80))]
        if i % 3 == 0:
            a = int(rng.integers(0, 40))
            words[5:5] = common[a : a + int(rng.integers(5, 40))]
        if i % 11 == 0:
            words += ["q"] * 40
        docs.append((i, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert passages(table) == brute_passages(docs)


@pytest.mark.parametrize("id", [None, 7])
def test_equal_texts_without_ids_of_their_own_are_spread(spark, tmp_path, id):
    """40,000 equal texts with null ids, or one id, are in many tasks, and one row of them stays."""
    path = str(tmp_path / "docs")
    same = spark.range(40_000).select(F.lit(id).cast("long").alias("doc_id"), F.lit("the  same").alias("text"), "id")
    other = spark.createDataFrame([(9, "else", 0), (8, "the same", 1)], "doc_id long, text string, id long")
    same.unionByName(other).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = spark.read.parquet(path)
    found = exact_dedup.sorted_groups(docs)
    tasks = found.where("row.text = 'the  same'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    kept = found.where("kept").select("row.doc_id", "row.text", "group_size").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) >= 4 and max(row["count"] for row in tasks) <= 40_000 / 2
    least = 8 if id is None else 7
    assert sorted(tuple(row) for row in kept) == [(least, "the same" if id is None else "the  same", 40_001), (9, "else", 1)]
    assert exact_dedup.drop_copies(docs).count() == 2
