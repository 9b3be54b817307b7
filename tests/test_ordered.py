"""Split and unsplit groups give the same order-dependent columns."""
import random

from pyspark.sql import functions as F

from ledgerloom.operators.ordered import OrderedRows, first, following, last, previous, running


def _carried(df, block_rows):
    seq = OrderedRows.of(df, ["k"], ["a", "b"], block_rows).carry(
        l_in=last(F.col("v")), l_ex=last(F.col("v"), inclusive=False), f=first(F.col("v")),
        s_in=running(F.col("n")), s_ex=running(F.col("n"), inclusive=False),
        p=previous(F.col("v")), nx=following(F.col("v")),
    )
    again = seq.with_columns(changed=F.coalesce(F.col("p") != F.col("l_in"), F.lit(True))).carry(
        group=running(F.col("changed").cast("bigint"))
    )
    return seq.split, sorted(tuple(r) for r in again.number("rn").rows().fillna(-1).fillna("~").collect())


def test_split_equals_plain(spark):
    rnd = random.Random(5)
    # one group holds most rows; the leading order column has ties
    rows = [
        (1 if rnd.random() < 0.7 else rnd.randint(2, 9), rnd.randint(0, 120), i, rnd.choice([None, None, "x", "y"]), rnd.choice([0, 1, 2]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k int, a int, b int, v string, n bigint")
    plain_split, plain = _carried(df, 1_000_000)
    hot_split, hot = _carried(df, 150)
    assert (plain_split, hot_split) == (False, True)
    assert plain == hot


def test_only_large_groups_are_split(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 50 + 2).alias("k"), F.col("id").cast("string").alias("a"))
    seq = OrderedRows.of(df, ["k"], ["a"], 500)
    assert seq.hot.select("k").distinct().count() == 1 and seq.hot.count() == 2000 and seq.df.count() == 1000
    assert seq.hot.select("__blk").distinct().count() > 2  # text orders too
    numbers = seq.number("rn").rows().groupBy("k").agg(F.max("rn") - F.count("*"), F.countDistinct("rn") - F.count("*"))
    assert all(r[1] == 0 and r[2] == 0 for r in numbers.collect())


def test_blocks_are_bounded(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    seq = OrderedRows.of(df, ["k"], ["a"], 1000)
    biggest = seq.hot.groupBy("__blk").count().agg(F.max("count")).first()[0]
    assert biggest <= 2000
    got = seq.number("rn").rows().filter("rn != a + 1").count()
    assert got == 0


def test_large_groups_are_set_apart_without_a_sort(spark, monkeypatch):
    """A large group is joined with its few bounds where its rows are; no task takes it whole."""
    from ledgerloom.operators import ordered

    plans = []
    kept = ordered.cut
    monkeypatch.setattr(ordered, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    rows = spark.range(500).selectExpr("if(id < 400, null, 'small') k", "id", "concat('v', id) v")
    seq = OrderedRows.of(rows, ["k"], ["id"], block_rows=150)
    assert seq.split and seq.hot.count() == 400 and seq.df.count() == 100
    assert seq.hot.select("__blk").distinct().count() > 2
    assert not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
    assert "SortMergeJoin" not in seq.df._jdf.queryExecution().executedPlan().toString()
    done = seq.number("n").rows()
    assert done.filter("k is null and n <> id + 1").count() == 0 and done.count() == 500
