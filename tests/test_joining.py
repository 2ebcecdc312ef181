from telarium.operators.joining import LEAST, lookup


def test_hot_keys_are_not_shuffled(spark):
    n = 3 * LEAST
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(n)] + [(-1, None)], "id long, k string")
    values = spark.createDataFrame([("hot", 2 * LEAST, "a"), ("k0", 1, "b"), ("absent", 1, "c")], "k string, n long, v string")
    got = lookup(rows, values, ["k"], "n", n)
    assert sorted(got.columns) == ["id", "k", "v"] and got.count() == 2 * LEAST + 1
    cold = lookup(rows, values.where("k <> 'hot'"), ["k"], "n", n)
    assert [tuple(r) for r in cold.select("id", "v").collect()] == [(0, "b")]
    assert lookup(rows.limit(0), values, ["k"], "n", n).count() == 0
