import json

from telarium.operators import shred as S
from telarium.session import settle

BODY = {
    "metadata": {"total_oas": "3"},
    "levels": {
        "1_medio": {"level_id": "1_medio", "subjects": {"mat": {"learning_objectives": [{"code": "a"}, None, {"code": "b"}], "modules": [None, {"expected_learnings": {"10": {"number": 10}, "2": {"number": 2, "criteria": "2.1 solo"}}}]}, "len": None}},
        "2_medio": {"subjects": {"mat": {"modules": json.dumps([{"expected_learnings": json.dumps([{"criteria": [{"label": "1.1", "text": "x"}, None, "1.3 y"]}])}]), "learning_objectives": None}}},
    },
}


def shredded(spark, *bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "record_id long, body string")
    adj = settle(S.shred(df))
    got = {i: [] for i in range(len(bodies))}
    for r in S.found_nodes(S.entities(adj)).collect():
        got[r.record_id].append((r.node, r.path, r.parent_path))
    return [sorted(x) for x in got.values()]


def paths(spark, body):
    return shredded(spark, body)[0]


def test_paths(spark):
    assert paths(spark, json.dumps(BODY)) == sorted([
        ("record", "root", ""), ("level", "root/1_medio", "root"), ("subject", "root/1_medio/mat", "root/1_medio"), ("objective", "root/1_medio/mat/o0", "root/1_medio/mat"), ("objective", "root/1_medio/mat/o2", "root/1_medio/mat"),
        ("module", "root/1_medio/mat/m1", "root/1_medio/mat"), ("learning", "root/1_medio/mat/m1/l0", "root/1_medio/mat/m1"), ("criterion", "root/1_medio/mat/m1/l0/c0", "root/1_medio/mat/m1/l0"), ("learning", "root/1_medio/mat/m1/l1", "root/1_medio/mat/m1"),
        ("level", "root/2_medio", "root"), ("subject", "root/2_medio/mat", "root/2_medio"), ("module", "root/2_medio/mat/m0", "root/2_medio/mat"), ("learning", "root/2_medio/mat/m0/l0", "root/2_medio/mat/m0"),
        ("criterion", "root/2_medio/mat/m0/l0/c0", "root/2_medio/mat/m0/l0"), ("criterion", "root/2_medio/mat/m0/l0/c2", "root/2_medio/mat/m0/l0"),
    ])


def test_bodies_that_are_none(spark):
    assert S.nodes(None) == [] and S.nodes("{") == [] and S.nodes("") == [] and S.nodes('{"a": ') == []
    root = ("record", "root", "")
    got = shredded(spark, "null", "[1, 2]", "{}", '{"modules": {}}', '{"modules": {"module_number": 1}}', '{"metadata": {"modules": [{}]}, "criteria": [1]}', '{"modules": "", "levels": [{"level_id": "a"}, 3, null, {"level_id": null}]}', '{"modules": {"-1": {}, "10": {}, "9": null}}', '"text"', "", None)
    assert got[:4] == [[root]] * 4 and got[4] == sorted([root, ("module", "root/m0", "root")]) and got[5] == [root]
    assert got[6] == sorted([root, ("level", "root/a", "root"), ("level", "root/1", "root"), ("level", "root/3", "root")])
    assert got[7] == sorted([root, ("module", "root/m0", "root"), ("module", "root/m2", "root")]) and got[8:] == [[root], [], []]


def test_parents_come_first_and_are_right():
    n = S.nodes(json.dumps(BODY))
    assert [x[0] for x in n] == list(range(len(n))) and all(x[1] is None or x[1] < x[0] for x in n)
    label = {x[0]: x[2] for x in n}
    assert next(label[x[1]] for x in n if x[2] == "total_oas") == "metadata"


def test_tables(spark):
    rows = [(1, json.dumps(BODY), "z", 5), (2, None, "z", 5), (3, "no json", "z", 5), (1, json.dumps({"modules": [{"module_number": 7, "module_name": "m", "text": "t"}]}), "z", 5)]
    df = spark.createDataFrame(rows, "record_id long, body string, path string, node_id int")
    adj = settle(S.shred(df))
    found = S.entities(adj)
    assert S.found_nodes(found).where("record_id <> 1").count() == 0 and S.found_nodes(found).count() == 17
    crit = {(r.path, r.text, r.label, r.f_text) for r in S.entity_table(adj, found, "criterion", S.FIELDS["criterion"]).collect()}
    assert ("root/2_medio/mat/m0/l0/c0", None, "1.1", "x") in crit and ("root/2_medio/mat/m0/l0/c2", "1.3 y", None, None) in crit and len(crit) == 3


def test_totals_and_empty(spark):
    df = spark.createDataFrame([(1, json.dumps(BODY)), (2, json.dumps({"metadata": {"total_oas": 0}})), (3, json.dumps({"metadata": {"total_oas": [1]}}))], "record_id long, body string")
    adj = settle(S.shred(df))
    assert sorted((r.record_id, r.total_oas, r.objectives, r.stale) for r in S.totals(adj, S.entities(adj)).collect()) == [(1, 3, 2, True), (2, 0, 0, False), (3, None, 0, None)]
    assert S.shred(df.limit(0)).count() == 0


def test_long_and_deep(spark):
    deep = '{"a":' * 5000 + "1" + "}" * 5000
    long, low = shredded(spark, json.dumps({"modules": [{}] * 20_000}), deep)
    assert len(long) == 20_001 and low in ([("record", "root", "")], [])


def test_refused(spark):
    df = spark.createDataFrame([(1, None), (2, "{"), (3, "{}"), (4, "[" * 100_000 + "]" * 100_000), (5, "3")], "record_id long, body string")
    assert sorted(map(tuple, S.refused(df).collect())) == [(1, "null"), (2, "not_json"), (4, "too_deep")]
