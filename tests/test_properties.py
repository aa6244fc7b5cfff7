"""Property tests (hypothesis) of the custom operators against brute force:
random sizes, skew (one group or key holding most rows), ties and NULLs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordwave.operators.dedup import first_per_key
from ordwave.operators.sequence import dense_sequence

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_seq = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 200), st.integers(0, 3)), min_size=1, max_size=300)


@settings(**SETTINGS)
@given(rows=rows_seq, block=st.sampled_from([1, 2, 3, 16, 1024]))
def test_dense_sequence_property(spark, rows, block):
    # skew: most random draws land in group 0 when the list is long
    df = spark.createDataFrame([(g if i % 3 else 0, k, t, i) for i, (g, k, t) in enumerate(rows)],
                               "g int, k long, t int, i int")
    got = dense_sequence(df, "g", ["k", "t", "i"], "k", block=block, out="seq")
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("k", "t", "i")) - 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


rows_dedup = st.lists(st.tuples(st.sampled_from(["", "a", "b", None]), st.one_of(st.none(), st.integers(0, 5)),
                                st.one_of(st.none(), st.text("xyz", max_size=2))), min_size=1, max_size=200)


@settings(**SETTINGS)
@given(rows=rows_dedup)
def test_first_per_key_property(spark, rows):
    df = spark.createDataFrame(rows, "key string, ts int, other string")
    got = sorted(map(tuple, first_per_key(df, "key", ["ts"]).select("key", "ts", "other").collect()),
                 key=repr)
    w = Window.partitionBy("key", F.when(F.coalesce(F.col("key"), F.lit("")) == "", F.struct("ts", "other"))).orderBy(F.col("ts").asc_nulls_first(), F.col("other").asc_nulls_first())
    want = sorted(map(tuple, df.withColumn("rn", F.row_number().over(w)).where("rn = 1")
                      .select("key", "ts", "other").collect()), key=repr)
    assert got == want
