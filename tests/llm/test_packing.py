import random

import pytest
from telarium.llm import packing as P


def least(sizes, cap):
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= cap and bins[b] not in bins[:b]:
                bins[b] += sizes[i]
                go(i + 1, bins)
                bins[b] -= sizes[i]
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


def test_near_the_optimum_and_bound_below_it():
    r, over = random.Random(2), 0
    for _ in range(300):
        cap = r.randint(2, 30)
        sizes = sorted((r.randint(1, cap) for _ in range(r.randint(1, 9))), reverse=True)
        bins = P.fill_bins(sizes, cap)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= cap for b in bins)
        o = least(sizes, cap)
        assert P.least_bins(sizes, cap) <= o
        over += len(bins) > o
    assert over <= 3


def test_search_empties_a_bin_that_best_fit_leaves():
    sizes = [6, 5, 5, 4, 4, 3, 3]  # best fit decreasing needs 4 bins of 10, 3 hold all
    start = [[0], [1, 3], [2, 4], [5, 6]]
    assert len(P.improve([list(b) for b in start], sizes, 10)) == 3


@pytest.mark.parametrize("sizes", [[], [0], [0, 0, 0], [5] * 7])
def test_small(sizes):
    bins = P.fill_bins(sizes, 5)
    assert sum(map(len, bins)) == len(sizes)


def test_pack(spark):
    items = spark.createDataFrame([(1, 3, "a"), (2, 25, "b"), (3, None, "c"), (4, 0, "d"), (5, 7, "e"), (5, 7, "e"), (6, 10, None)], "doc_id long, n_tokens int, kind string")
    kinds = spark.createDataFrame([("s", 10), ("m", 100), ("none", None), ("zero", 0)], "container_kind string, capacity int")
    got = P.pack(items, kinds).collect()
    assert {r.container_kind for r in got} == {"s", "m"}
    for kind, cap in (("s", 10), ("m", 100)):
        rows = [r for r in got if r.container_kind == kind]
        load = {}
        for r in rows:
            load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
        assert max(load.values()) <= cap and sum(load.values()) == 52
        assert sorted({r.doc_id for r in rows}) == [1, 2, 3, 4, 5, 6]
        split = [r for r in rows if r.doc_id == 2]
        assert len(split) == (3 if cap == 10 else 1) and sorted(r.start for r in split) == [k * cap for k in range(len(split))]
        assert all(len([r for r in rows if r.doc_id == d]) == n for d, n in ((1, 1), (5, 2), (6, 1)))
    f = {r.container_kind: r for r in P.fills(P.pack(items, kinds), kinds).collect()}
    assert f["s"].containers == 6 and f["m"].containers == 1 and f["s"].bound == 6


def test_empty_tables(spark):
    none, kinds = spark.createDataFrame([], "doc_id long, n_tokens int"), spark.createDataFrame([("s", 10)], "container_kind string, capacity int")
    assert P.pack(none, kinds).count() == 0
    assert P.pack(spark.createDataFrame([(1, 2)], "doc_id long, n_tokens int"), kinds.limit(0)).count() == 0


def test_groups_hold_all_items(spark):
    r = random.Random(1)
    items = spark.createDataFrame([(i, r.randint(0, 60)) for i in range(3000)], "doc_id long, n_tokens int")
    kinds = spark.createDataFrame([("s", 50)], "container_kind string, capacity int")
    got = P.pack(items, kinds, group=500)
    assert got.select("doc_id").distinct().count() == 3000
    f = P.fills(got, kinds).first()
    assert f.fullest <= 50 and f.unused < 0.02


def test_fill_needs_the_search():
    """Packings that neither start finds, but the exchanges do."""
    r, won = random.Random(7), 0
    for _ in range(200):
        sizes = [r.randint(20, 60) for _ in range(60)]
        won += min(len(P.quick_fill(sizes, 100)), len(P.best_fit(sizes, 100))) > len(P.fill_bins(sizes, 100))
    assert won > 5
    sizes = [r.randint(20, 500) for _ in range(3000)]
    quick = P.quick_fill(sizes, 1024)
    found = P.improve(quick, sizes, 1024)
    assert sorted(i for b in found for i in b) == list(range(3000)) and max(sum(sizes[i] for i in b) for b in found) <= 1024
    assert len(quick) - len(found) >= 0.5 * (len(quick) - P.least_bins(sizes, 1024)) > 0
    assert quick == P.quick_fill(sizes, 1024)  # the start is left as it was


def test_many_equal_and_tiny_items():
    assert len(P.fill_bins([1] * 20_000 + [3] * 5_000 + [0] * 100, 4096)) == 9
    assert len(P.fill_bins([7] * 5_000, 20)) == 2_500
