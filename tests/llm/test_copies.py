from telarium.llm import copies as C
from pyspark.sql import functions as F

SCHEMA = "row_id long, statement string, code string, h1 string, id string, keep_id string"


def run(spark, rows, schema=SCHEMA):
    kept, dup = C.objective_copies(spark.createDataFrame(rows, schema))
    return sorted(map(tuple, kept.collect())), sorted(map(tuple, dup.select("keep_id", "copy_id").collect()))


def test_formatting_case_and_punctuation_dont_count(spark):
    rows = [(3, "Medir  el agua.", "MA1 OA 1", "x", "y", "z"), (1, "medir EL agua", "ma1-oa-1", None, None, None), (2, "Medir el agua!", "MA1 OA 2", None, None, None), (4, "Medír el agua", "MA1OA1", None, None, None)]
    kept, dup = run(spark, rows)
    assert kept == [(1, 2)] and dup == [(1, 3)]  # another code and another accent are no copies


def test_nulls_blanks_and_signs_are_in_no_set(spark):
    rows = [(i, s, None, None, None, None) for i, s in enumerate([None, None, "", "", " ", "...", "...", "123", "123"])]
    assert run(spark, rows) == ([], [])


def test_null_code_equals_empty_code_and_repeated_rows(spark):
    rows = [(1, "Leer", None, None, None, None), (2, "leer", "", None, None, None), (2, "leer", "", None, None, None)]
    kept, dup = run(spark, rows)
    assert kept == [(1, 3)] and dup == [(1, 2), (1, 2)]


def test_empty_table(spark):
    assert run(spark, []) == ([], [])


def test_long_texts(spark):
    long = "palabra " * 50_000
    kept, dup = run(spark, [(1, long, None, None, None, None), (2, long.upper(), None, None, None, None), (3, long + "x", None, None, None, None)])
    assert dup == [(1, 2)]


def test_hot_group_goes_another_way_with_the_same_result(spark):
    rows = [(i, "Medir el agua" if i % 2 else f"Leer {i}", None, None, None, None) for i in range(5000)]
    kept, dup = run(spark, rows)
    assert kept == [(1, 2500)] and len(dup) == 2499 and {a for a, _ in dup} == {1}


def test_fields_in_any_order(spark):
    schema = "row_id long, statement string, code string, attrs string"
    rows = [(1, "Leer", "a", '{"x": 1, "y": true}'), (2, "leer.", "A", '{"y":true,"x":1}'), (3, "Leer", "a", '{"x": "1", "y": true}'), (4, "Leer", "a", None), (5, "Leer", "a", None), (6, "Leer", "a", "no json"), (7, "Leer", "a", '{"x": 1}')]
    _, dup = C.table_row_copies(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, dup.collect())) == [(1, 2), (4, 5)]


def test_collisions_are_resolved_by_text(spark):
    rows = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "bbb"), (4, "bbb"), (5, "c")], "id long, c string").select("id", F.lit(1).cast("long").alias("h1"), F.lit(2).cast("long").alias("h2"), F.crc32("c").alias("h3"), F.length("c").alias("n"), "c")
    groups = rows.groupBy("h1", "h2").agg(F.min("id").alias("keep_id"), F.count("*").alias("n_rows"), F.min("h3").alias("a"), F.max("h3").alias("b"), F.min("n").alias("d"), F.max("n").alias("e")).where("n_rows > 1")
    kept, dup = C._resolve(rows, rows.drop("c"), groups)
    assert sorted(map(tuple, dup.collect())) == [(1, 2), (3, 4)] and sorted(map(tuple, kept.collect())) == [(1, 2), (3, 2)]


def test_accents_count_however_they_are_written(spark):
    rows = [(1, "Educación física", "á", None, None, None), (2, "Educacio\u0301n fi\u0301sica", "a\u0301", None, None, None), (3, "Educacion fisica", "a", None, None, None), (4, "Educacion fisica", "á", None, None, None)]
    assert run(spark, rows) == ([(1, 2)], [(1, 2)])


def test_hot_groups_are_not_shuffled(spark):
    """The rows of a hot group are taken away by a broadcast before the rest is shuffled."""
    df = spark.createDataFrame([(i, "Medir el agua" if i % 2 else f"Leer {i}", None, None, None, None) for i in range(5000)], SCHEMA)
    plan = C.objective_copies(df)[1]._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.index("LeftAnti") < plan.rindex("BroadcastHashJoin")
