import hashlib

from tidemark.functions.comparison import row_fingerprint, rows_differ
from tidemark.names import col
from tidemark.operators.snapshot_diff import new_rows


def prints(df, **options):
    return [r[0] for r in df.select(row_fingerprint(df, **options)).collect()]


def test_fingerprint_tells_null_places_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", "")], "x string, y string, z string")
    assert len(set(prints(df))) == 3
    assert len(set(prints(df, legacy=True))) == 2  # 'a_b' twice, 'a_b_' once


def test_fingerprint_tells_separators_apart(spark):
    df = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), ("a|1:b", "c")], "x string, y string")
    assert len(set(prints(df))) == 3
    assert len(set(prints(df.limit(2), legacy=True))) == 1


def test_legacy_fingerprint_value(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert prints(df, legacy=True) == [hashlib.sha256(b"1_x").hexdigest()]


def test_fingerprint_of_nested_and_zero(spark):
    df = spark.createDataFrame(
        [(0.0, {"a": 1, "b": 2}, [1], (1,)), (-0.0, {"b": 2, "a": 1}, [1], (1,))],
        "d double, m map<string,int>, l array<int>, s struct<v:int>",
    )
    assert len(set(prints(df))) == 1


def test_rows_differ_sees_value_moving_between_nulls(spark):
    df = spark.createDataFrame([(1, None, None, 1), (1, None, 1, None)], "a int, b int, c int, d int")
    types = {f.name: f.dataType for f in df.schema.fields}
    differ = rows_differ([(col("a"), col("c"), types["a"]), (col("b"), col("d"), types["b"])])
    assert [r[0] for r in df.select(differ).collect()] == [True, False]


def test_rows_differ_on_documents_ignores_key_order(spark):
    df = spark.sql("""SELECT parse_json('{"a":1,"b":2}') x, parse_json('{"b":2,"a":1}') y, parse_json('{"a":1,"b":3}') z""")
    kind = df.schema["x"].dataType
    got = df.select(rows_differ([(col("x"), col("y"), kind)]), rows_differ([(col("x"), col("z"), kind)])).first()
    assert tuple(got) == (False, True)


def test_new_rows_keeps_copies(spark, as_rows):
    current = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (3, "c")], "k int, v string")
    snapshot = spark.createDataFrame([(1, "a"), (2, "x"), (1, "a")], "k int, v string")
    assert as_rows(new_rows(current, snapshot)) == [(2, None), (3, "c"), (3, "c")]
