"""The hot-key path must return exactly what a plain window returns."""

from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.operators import skew
from freshet.operators.selection import beyond_cap, cap_per_key, request_batches
from freshet.operators.skew import first_per_key, fits_broadcast, hot_keys, sequence_number, with_previous
from freshet.operators.state import collect_ids
from freshet.plans.layers import growth, name_history


def order():
    return [F.col("t").desc(), F.col("id").asc()]



def skewed(spark, n=400):
    """Key 'a' holds three quarters of the rows; t has many ties and some NULLs."""
    return spark.range(n).select(
        F.when(F.col("id") % 4 != 0, "a").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        "id",
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919 % 23)).alias("t"),
        (F.col("id") % 3).cast("string").alias("name"),
    )


def test_hot_keys_found(spark):
    hot = hot_keys(skewed(spark), ["k"], hot_rows=100)
    assert rows(hot.frame) == [("a",)] and hot.rows == 300
    assert hot_keys(skewed(spark), ["k"]).frame is None
    assert hot_keys(skewed(spark).where("false"), ["k"], hot_rows=1).frame is None


def test_sequence_number_hot(spark):
    df = skewed(spark)
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order())).cast("bigint"))
    hot = hot_keys(df, ["k"], hot_rows=100)
    got = sequence_number(df, ["k"], order(), hot=hot, segment_rows=40)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_spread_over_tasks(spark):
    df = skewed(spark)
    hot = hot_keys(df, ["k"], hot_rows=100)
    large, _ = hot.split(df)
    cut = skew._segments(large, hot, order(), 40)
    sizes = [r["count"] for r in cut.groupBy("__segment").count().collect()]
    assert len(sizes) > 3 and max(sizes) < 150


def test_with_previous_hot(spark):
    df = skewed(spark)
    window = Window.partitionBy("k").orderBy(*order())
    plain = df.withColumn("p", F.lag("t").over(window)).withColumn("q", F.lag("name").over(window))
    hot = hot_keys(df, ["k"], hot_rows=100)
    got = with_previous(df, ["k"], order(), {"p": "t", "q": "name"}, hot=hot, segment_rows=40)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_first_per_key_hot(spark):
    df = skewed(spark)
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order()))).where("rn <= 5")
    got = first_per_key(df, ["k"], order(), 5, ["id"], hot=hot_keys(df, ["k"], hot_rows=100))
    assert rows(got, "k", "id", "rn") == rows(plain, "k", "id", "rn")


def test_first_per_key_beyond_the_group_limit(spark, monkeypatch):
    monkeypatch.setattr(skew, "GROUP_LIMIT", 3)
    df = skewed(spark)
    hot = hot_keys(df, ["k"], hot_rows=100)
    got = first_per_key(df, ["k"], order(), 5, ["id"], hot=hot)
    assert rows(got, "k", "id", "rn") == rows(first_per_key(df, ["k"], order(), 5, ["id"]), "k", "id", "rn")


def test_history_and_growth_hot(spark):
    df = skewed(spark).withColumn("t", F.col("id"))
    hot = hot_keys(df, ["k"], hot_rows=100)
    plain = name_history(df, "k", "name", "t")
    assert sorted(map(str, name_history(df, "k", "name", "t", hot=hot).collect())) == sorted(map(str, plain.collect()))
    by_time = [F.col("t").asc()]
    assert sorted(map(str, growth(df, "k", by_time, ["id"], hot).collect())) == sorted(
        map(str, growth(df, "k", by_time, ["id"]).collect())
    )


def test_batches_hot(spark):
    df = skewed(spark)
    hot = hot_keys(df, ["k"], hot_rows=100)
    plain, split = request_batches(df, "k", "id", order(), 7), request_batches(df, "k", "id", order(), 7, hot)
    assert rows(split) == rows(plain)
    assert max(r["n"] for r in plain.collect()) == 7


def test_documents_are_bounded(spark):
    documents = collect_ids(skewed(spark), "k", "id", 50).collect()
    assert max(len(d["video_ids"]) for d in documents) == 50
    assert sorted(i for d in documents for i in d["video_ids"]) == list(range(400))


def test_fits_broadcast(spark):
    df = skewed(spark)
    assert fits_broadcast(df) and not fits_broadcast(df, max_rows=399) and not fits_broadcast(df, max_bytes=100)
    assert fits_broadcast(df.where("false"))
    assert not fits_broadcast(df.groupBy("k").agg(F.collect_list("id")))


def test_size_check_moves_no_rows(spark):
    assert "Limit" not in plan_of(hot_keys(skewed(spark), ["k"], 100).frame)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5)), min_size=1, max_size=30),
    st.integers(1, 6),
)
def test_cap_conserves_ids(spark, pairs, n):
    df = spark.createDataFrame([(k, i, t) for i, (k, t) in enumerate(pairs)], "k string, id int, t int")
    selected = cap_per_key(df, "k", "id", order(), n, hot=hot_keys(df, ["k"], hot_rows=4))
    pending = beyond_cap(df, selected, ["k", "id"])
    taken, left = rows(selected, "k", "id"), rows(pending, "k", "id")
    assert sorted(taken + left) == rows(df, "k", "id")
    expected = []
    for key in {k for k, _ in pairs}:
        own = sorted((-t, i) for i, (k, t) in enumerate(pairs) if k == key)
        expected += [(key, i) for _, i in own[:n]]
    assert taken == sorted(expected)
