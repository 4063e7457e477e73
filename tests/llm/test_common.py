import random

import pytest

from holdfast.llm import common


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("n, m, seed", [(40, 30, 1), (400, 380, 2)])
def test_components(spark, n, m, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    edges += [(0, i) for i in range(1, 30)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5)]  # a hub, a chain, a loop
    found = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = components(edges)
    assert all(expected[node] == component for node, component in found.items())
    assert {x for x in expected if x not in found} == {x for x, c in expected.items() if c == x}


def test_no_edges(spark):
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_unsettled_components_are_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(70)], "a long, b long")
    with pytest.raises(RuntimeError):
        common.connected_components(chain, rounds=1)


def test_running_total(spark):
    rows = [(i * 7 % 101, i % 5 + 1) for i in range(101)]
    found = common.running_total(spark.createDataFrame(rows, "k long, n long").repartition(5), ["k"], "n", "start")
    total = 0
    for row, (k, n) in zip(sorted(found.collect()), sorted(rows)):
        assert tuple(row) == (k, n, total)
        total += n


def test_lowest_hashes_do_not_depend_on_the_layout(spark):
    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    first = common.lowest_hashes(ids, "doc_id", 50).collect()
    assert len(first) == 50
    again = common.lowest_hashes(ids.unionByName(ids).repartition(9), "doc_id", 50).collect()
    assert set(first) >= set(again) and len(again) == 50


def test_batches_are_bounded(spark):
    def sizes(batch):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    found = common.map_batches(spark.range(1000, numPartitions=2), sizes, "n long", rows=64).collect()
    assert sum(r.n for r in found) == 1000 and max(r.n for r in found) <= 64
