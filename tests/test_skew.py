"""Hot groups: the split paths must give what one window gives."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.operators.ranking import ALL, rank_within, windows_within
from lectern.operators.skew import first_n_per_key, slice_cuts, slice_number, sliced, spread_position, surrogate_key
from lectern.session import stage


def skewed(spark, n=4000):
    """A third of the rows in one key, many ties, one NULL key."""
    return spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 40).alias("k"),
        ((F.col("id") * 7919) % 51 / 5).cast("decimal(5,2)").alias("v"),
        F.concat(F.lit("n"), (F.col("id") * 31) % 17).alias("name"),
        "id",
    )


def same(left, right):
    cols = sorted(left.columns)
    key = lambda r: str(r)
    return sorted(left.select(cols).collect(), key=key) == sorted(right.select(cols).collect(), key=key)


def test_spread_position(spark):
    df = skewed(spark)
    order = [F.col("v").desc(), F.col("name"), F.col("id")]
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert same(spread_position(df, ["k"], order, "p"), want)


def test_ranking_slices_equal_windows(spark):
    df = skewed(spark)
    whole = windows_within(df, "k", "v", ["name", "id"])
    for slice_rows in (40, 333, 500_000):
        assert same(rank_within(df, "k", "v", ["name", "id"], slice_rows=slice_rows), whole)
    for measure in ALL:
        one = rank_within(df, "k", "v", ["name", "id"], want=[measure], slice_rows=150)
        assert same(one, whole.drop(*[m for m in ALL if m != measure]))


def test_ranking_with_one_value_many_values_and_nulls(spark):
    df = skewed(spark).withColumn("v", F.when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 1999).cast("int"))
    for rows in (df, df.withColumn("v", F.lit(7)), df.withColumn("v", F.lit(None).cast("int")), df.filter("k = 0"), df.limit(0)):
        assert same(rank_within(rows, "k", "v", ["id"], slice_rows=100), windows_within(rows, "k", "v", ["id"]))


def test_ranking_moves_the_rows_once(spark):
    """The rows cross one exchange; a hot key lies in many slices; only the wanted windows are there."""
    df = skewed(spark)
    ranked = rank_within(df, "k", "v", ["name", "id"], want=["RowNumberTurma"], slice_rows=200)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") == 1 and "rank(" not in plan.replace("dense_rank(", "rank(")
    text = ranked._jdf.queryExecution().executedPlan().toString()
    by_slice = [line for line in text.splitlines() if "Exchange hashpartitioning(_slice" in line and "id#" in line]
    assert text.count("Window") >= 1 and text.count("SortMergeJoin") == 0
    place = F.struct(F.col("k").alias("key"), F.col("v").isNull().alias("none"), (-F.col("v")).alias("value"), "name", "id")
    cuts = slice_cuts(df, place, 200)
    slices = df.withColumn("c", cuts.scalar()).withColumn("s", slice_number(place, F.col("c"), 1 << 16)).groupBy("k").agg(F.countDistinct("s").alias("n"))
    assert slices.filter("k = 0").first()["n"] > 4
    assert len(by_slice) <= 1


def test_slice_numbers(spark):
    cuts = spark.createDataFrame([([(2,), (2,), (5,)],)], "cuts array<struct<v: int>>")
    rows = spark.range(8).select(F.col("id").cast("int").alias("v"))
    got = rows.withColumn("c", cuts.scalar()).withColumn("s", slice_number(F.struct("v"), F.col("c"), 3)).orderBy("v").collect()
    assert [r["s"] for r in got] == [0, 0, 2, 2, 2, 3, 3, 3]


def test_tiles_with_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 5, i) for i in range(3)] + [(2, 1, 9)], "k int, v int, id int")
    for slice_rows in (1, 500_000):
        assert same(rank_within(df, "k", "v", ["id"], slice_rows=slice_rows), windows_within(df, "k", "v", ["id"]))


def test_surrogate_keys_are_dense_and_stable(spark):
    df = spark.range(500, numPartitions=5).select((F.col("id") * 3).alias("n"))
    first = surrogate_key(df, "n", "k")
    assert [r["k"] for r in first.orderBy("n").collect()] == list(range(1, 501))
    more = df.unionByName(spark.createDataFrame([(1,), (4,)], "n long"))
    second = {r["n"]: r["k"] for r in surrogate_key(more, "n", "k", first).collect()}
    assert second[1] == 501 and second[4] == 502 and second[0] == 1 and len(second) == 502


def test_first_n_per_key(spark):
    df = skewed(spark).withColumn("free", (F.coalesce("k", F.lit(1)) % 7).cast("int") * 5)
    w = Window.partitionBy("k").orderBy("name", "id")
    for rows in (df, df.withColumn("free", F.lit(700)), df.withColumn("free", F.lit(None).cast("int")), df.limit(0)):
        want = rows.withColumn("p", F.row_number().over(w)).filter("p <= free").drop("p")
        for slice_rows in (100, 500_000):
            assert same(first_n_per_key(rows, "k", ["name", "id"], "free", slice_rows=slice_rows), want)


def test_orders_by_columns_named_as_the_parts_of_a_place(spark):
    """Large keys are also cut where the order has a column called as the key or the value of a place."""
    df = skewed(spark).select("k", "v", F.col("name").alias("value"), F.col("id").alias("key"), F.lit(300).alias("free"))
    w = Window.partitionBy("k").orderBy("value", "key")
    want = df.withColumn("p", F.row_number().over(w)).filter("p <= free").drop("p")
    assert same(first_n_per_key(df, "k", ["value", "key"], "free", slice_rows=100), want)
    whole = windows_within(df, "k", "v", ["value", "key"])
    assert same(rank_within(df, "k", "v", ["value", "key"], slice_rows=100), whole)


def test_selection_ranks_only_the_slices_it_needs(spark):
    """One key with all rows: the slices beyond its allowance are not ranked, and none holds all rows."""
    rows = spark.range(6000, numPartitions=5).select(F.lit(1).alias("k"), ((F.col("id") * 7919) % 6007).alias("t"), F.lit(250).alias("free"))
    rows = stage(rows, "one-key")
    first = first_n_per_key(rows, "k", ["t"], "free", slice_rows=400)
    assert sorted(r["t"] for r in first.collect()) == sorted(r["t"] for r in rows.collect())[:250]
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("row_number()"):]
    assert "<" in below[: below.index("Join")]  # the cut-off is tested before the ranking
    place = F.struct(F.col("k").alias("key"), "t")
    sizes = [r["n"] for r in sliced(rows, place, slice_cuts(rows, place, 400)).groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 1500


def test_skewed_joins_are_split(spark):
    """The session settings let AQE split a hot join key, also where a grouping on that key follows."""
    import contextlib
    import io

    small = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        fact = spark.range(1_500_000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50_000).alias("k"), F.col("id").alias("v")
        )
        dim = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
        for how in ("inner", "left", "left_semi"):
            out = fact.join(dim, "k", how).groupBy("k").agg(F.sum("v").alias("s"))
            assert out.collect()
            plan = io.StringIO()
            with contextlib.redirect_stdout(plan):
                out.explain()
            assert "skew=true" in plan.getvalue(), how
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v in (None, "<undefined>") else spark.conf.set(k, v)


def test_only_large_keys_are_cut(spark):
    """Keys that fit a slice get no cuts, so a table of such keys is ranked without any; a large key keeps its own."""
    place = F.struct(F.col("k").alias("key"), "id")
    small = stage(spark.range(4000).select((F.col("id") % 400).alias("k"), "id"), "small-keys")
    assert slice_cuts(small, place, 100) is None
    mixed = stage(small.unionByName(spark.range(4000, 6000).select(F.lit(7).cast("long").alias("k"), "id")), "mixed-keys")
    cuts = slice_cuts(mixed, place, 100)
    assert {r["k"] for r in cuts.select(F.explode("cuts.key").alias("k")).collect()} == {7}
    spread = sliced(mixed, place, cuts).groupBy("k").agg(F.countDistinct("_slice").alias("n"))
    assert {r["k"] for r in spread.filter("n > 1").collect()} == {7} and spread.filter("k = 7").first()["n"] > 10
    want = windows_within(mixed, "k", "id", [])
    assert same(rank_within(mixed, "k", "id", [], slice_rows=100), want)
