from pyspark.sql import functions as F

from folioscope.functions import text as X


def test_text_functions(spark):
    df = spark.createDataFrame([("é", "a"), ("abc", None), (None, "b")], "s string, t string")
    assert [r[0] for r in df.select(X.nfc(F.col("s"))).collect()] == ["\xe9", "abc", None]
    got = [r[0] for r in df.select(X.canonical_json(F.struct(F.col("t").alias("z"), F.col("s").alias("a")))).collect()]
    assert got == ['{"a":"é","z":"a"}', '{"a":"abc","z":null}', '{"a":null,"z":"b"}']
    assert X.path_key("a/b \xe9") == "a~2Fb~20~C3~A9" and len(X.path_key("x" * 500)) == X.MOST_KEY and X.path_key("x" * 500) != X.path_key("x" * 501)
    assert [r[0] for r in df.select(X.path_safe("s")).collect()][1:] == ["abc", None]
    r = spark.range(1).select(X.entity_key(F.lit("m:A1")).alias("a"), X.entity_key(F.lit("z:1")).alias("b"), X.cut_percent(F.lit(999), F.lit(1000)).alias("c"), X.cut_percent(F.lit(0), F.lit(0)).alias("d"), X.cut_percent(F.lit(5), F.lit(5)).alias("e")).first()
    assert (r.a.kind, r.a.id, r.b, r.c, r.d, r.e) == ("m", "A1", None, 99.9, None, 100.0)
