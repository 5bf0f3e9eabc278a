import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import batch, conf, frame, plan_of, shuffle_joins, stored, tuples
from tidemark.operators import (
    affected_partitions,
    changed_rows,
    classify_changes,
    current_snapshot,
    dedupe_batch,
    few_keys,
    fits_broadcast,
    fits_by_rows,
    new_rows,
    salted_left_join,
    skew,
)
from tidemark.operators.changes import rows_without

TABLE = [(1, "a", "Y", 0, None), (2, "b", "Y", 0, None), (2, "old", "N", 0, 1), (3, "c", "Y", 0, None)]


def kinds(df):
    return tuples(df, "k", "v", "rowType")


def test_new_changed_unchanged_and_absent(spark):
    got = classify_changes(batch(spark, [(1, "a"), (2, "x"), (9, "n")]), stored(spark, TABLE), ["k"])
    assert kinds(got) == [(2, "x", "CurrentRows"), (9, "n", "NewRows")]


def test_both_joins_agree_with_and_without_broadcast(spark):
    rows = [(1, "a"), (2, "x"), (9, "n")]
    table = stored(spark, TABLE)

    def all_ways():
        b = batch(spark, rows)
        return (
            kinds(classify_changes(b, table, ["k"])),
            tuples(new_rows(b, table, ["k"]), "k"),
            tuples(changed_rows(b, table, ["k"]), "k"),
        )

    few = all_ways()
    with shuffle_joins(spark):
        assert all_ways() == few
    assert few[1:] == ([(9,)], [(2,)])


def test_only_closed_versions_make_a_key_new(spark):
    table = stored(spark, [(1, "a", "N", 0, 1)])
    assert kinds(classify_changes(batch(spark, [(1, "a")]), table, ["k"])) == [(1, "a", "NewRows")]


def test_null_stored_hash_counts_as_changed(spark):
    table = stored(spark, TABLE).withColumn(
        "rowHash", F.when(F.col("k") == 1, None).otherwise(F.col("rowHash"))
    )
    b = batch(spark, [(1, "a"), (3, "c")])
    assert kinds(classify_changes(b, table, ["k"])) == [(1, "a", "CurrentRows")]
    assert tuples(changed_rows(b, table, ["k"]), "k") == [(1,)]


def test_several_open_versions_give_one_row_and_all_partitions(spark):
    table = stored(
        spark,
        [(1, "a", "Y", 0, None, 10), (1, "b", "Y", 1, None, 11), (1, "c", "Y", 2, None, 12)],
        partitioned=True,
    )
    got = classify_changes(batch(spark, [(1, "b"), (5, "n")], partition=20), table, ["k"])
    assert tuples(got, "k", "rowType", "pKey", "firstPKey", "openVersions") == [
        (1, "CurrentRows", 12, 10, 3),
        (5, "NewRows", 20, 20, 0),
    ]
    assert tuples(affected_partitions(got)) == [(10,), (12,), (20,)]
    assert tuples(affected_partitions(got, table, ["k"])) == [(10,), (11,), (12,), (20,)]


def test_equal_open_copies_are_unchanged(spark):
    table = stored(spark, [(1, "a", "Y", 0, None), (1, "a", "Y", 0, None)])
    assert kinds(classify_changes(batch(spark, [(1, "a")]), table, ["k"])) == []


def test_null_key_fails_by_default(spark):
    b = batch(spark, [(None, "n"), (1, "a")])
    with pytest.raises(PySparkException, match="NULL in merge key"):
        classify_changes(b, stored(spark, TABLE), ["k"]).collect()
    with pytest.raises(PySparkException, match="NULL in merge key"):
        classify_changes(dedupe_batch(b, ["k"]), stored(spark, TABLE), ["k"]).collect()


def test_null_keys_kept_are_new_and_all_stay(spark):
    b = batch(spark, [(None, "n"), (None, "n"), (None, "m"), (1, "a")])
    table = stored(spark, [*TABLE, (None, "n", "Y", 0, None)])
    b = dedupe_batch(b, ["k"], "error", null_keys="keep")
    got = classify_changes(b, table, ["k"], null_keys="keep")
    assert kinds(got) == [(None, v, "NewRows") for v in ("m", "n", "n")]


def test_partly_null_composite_key_never_matches(spark):
    schema = "a int, b int, v string, current string, rowHash string"
    table = frame(spark, [(1, None, "x", "Y", "h"), (1, 2, "y", "Y", "h")], schema)
    b = frame(spark, [(1, None, "x", "Y", "h"), (1, 2, "z", "Y", "g")], schema)
    got = classify_changes(b, table, ["a", "b"], null_keys="keep")
    assert tuples(got, "a", "b", "rowType") == [(1, 2, "CurrentRows"), (1, None, "NewRows")]


def test_duplicates_fail_by_default(spark):
    with pytest.raises(PySparkException, match="duplicate merge key"):
        dedupe_batch(batch(spark, [(1, "a"), (1, "b")]), ["k"]).collect()
    assert tuples(dedupe_batch(batch(spark, [(1, "a"), (2, "b")]), ["k"]), "k") == [(1,), (2,)]


def test_last_duplicate_wins_and_ties_are_settled(spark):
    rows = [(1, "a"), (1, "c"), (1, "b"), (2, "z")]
    assert tuples(dedupe_batch(batch(spark, rows), ["k"], "last", ["v"]), "k", "v") == [
        (1, "c"),
        (2, "z"),
    ]
    for order in (rows, rows[::-1]):
        tied = frame(spark, order).withColumn("day", F.lit(1)).repartition(4)
        assert tuples(dedupe_batch(tied, ["k"], "last", ["day"]), "k", "v") == [(1, "c"), (2, "z")]


def test_ties_between_nested_values_are_settled(spark):
    rows = spark.sql("SELECT 1 AS k, 1 AS day, map('a', id) AS m FROM range(3)")
    assert [r.m for r in dedupe_batch(rows, ["k"], "last", ["day"]).collect()] == [{"a": 2}]


def test_duplicates_kept_are_each_classified_once(spark):
    rows = [(5, "p"), (5, "q"), (5, "q"), (1, "x"), (1, "y"), (1, "a"), (1, "x")]
    b = dedupe_batch(batch(spark, rows), ["k"], "keep")
    got = classify_changes(b, stored(spark, TABLE), ["k"], unique_keys=False)
    assert kinds(got) == sorted(
        [(5, v, "NewRows") for v in "pqq"] + [(1, v, "CurrentRows") for v in "xxy"], key=repr
    )


def test_dedupe_arguments(spark):
    with pytest.raises(ValueError, match="order_by"):
        dedupe_batch(batch(spark, []), ["k"], "last")
    with pytest.raises(ValueError, match="on_duplicate"):
        dedupe_batch(batch(spark, []), ["k"], "first")
    with pytest.raises(ValueError, match="null_keys"):
        classify_changes(batch(spark, []), stored(spark, []), ["k"], null_keys="drop")


def test_salted_join_equals_plain_join(spark):
    # key 0 holds a third of the rows, keys 1000.. have no partner
    left = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    right = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with shuffle_joins(spark):
        got = salted_left_join(left, right, ["k"], heavy_rows=100)
        assert tuples(got, "k", "n", "w") == tuples(left.join(right, "k", "left"), "k", "n", "w")
    with shuffle_joins(spark), conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        # the heavy key is spread over several tasks
        got = salted_left_join(left, right, ["k"], heavy_rows=100)
        assert got.where("k = 0").select(F.spark_partition_id()).distinct().count() > 1


def one_hot_key(spark, rows=20_000):
    """Equal rows of one key, dealt over several files' worth of tasks."""
    return spark.range(0, rows, 1, 4).select(F.lit(7).alias("k"), F.lit("x").alias("v"))


def busiest(df):
    """Rows of the task with most of them, and of all."""
    counts = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    return max(counts), sum(counts)


def test_hot_and_null_keys_are_spread(spark):
    right = frame(spark, [(7,), (8,)], "k int")
    hot = one_hot_key(spark)
    null = hot.withColumn("k", F.lit(None).cast("int"))
    one_task = spark.range(0, 20_000, 1, 1).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    with shuffle_joins(spark), conf(
        spark,
        spark__sql__adaptive__enabled="false",
    ):
        for how in ("left", "left_semi"):
            for left in (hot, one_task):
                got = skew.salted_left_join(left, right, ["k"], heavy_rows=500, how=how)
                most, rows = busiest(got)
                assert rows == 20_000 and most < 0.6 * rows
        # equal rows of one map task are parted as well
        equal = spark.range(0, 200_000, 1, 1).select(F.lit(7).alias("k"), F.lit("x").alias("v"))
        with conf(spark, spark__sql__shuffle__partitions="64"):
            got = skew.salted_left_join(equal, right, ["k"], heavy_rows=10_000)
            assert got.groupBy(F.spark_partition_id()).count().count() >= 10
            assert busiest(got)[1] == 200_000 and busiest(got)[0] < 0.3 * 200_000
        assert skew.salted_left_join(hot, right, ["k"], heavy_rows=500, how="left_anti").count() == 0
        most, rows = busiest(rows_without(null, right, ["k"]))
        assert rows == 20_000 and most < 0.6 * rows
        # keys that no sketch has named are joined unsalted, and still right
        assert skew.salted_left_join(hot, right, ["k"], heavy_rows=500, heavy={}).count() == 20_000


def test_heavy_keys_come_from_a_sketch(spark):
    """No key is shuffled to find the heavy ones, and without any the join is a plain one."""
    rows = spark.range(0, 9000, 1, 4).select((F.col("id") % 900).alias("k"), F.col("id").alias("n"))
    hot = rows.union(spark.range(0, 5000, 1, 4).select(F.lit(3).cast("long"), F.col("id"))).withColumn("d", F.col("k") * -0.0)
    assert len(skew.heavy_keys(hot, ["k"], 1000)) == 1 and list(skew.heavy_keys(hot, ["k"], 1000).values()) == [6]
    assert skew.heavy_keys(rows, ["k"], 1000) == skew.heavy_keys(rows.where("false"), ["k"], 1000) == {}
    plan = plan_of(hot.agg(skew.key_sketch(hot, ["k"])))
    assert "hashpartitioning" not in plan and "approx_top_k" in plan
    right = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    with shuffle_joins(spark):
        plain = plan_of(skew.salted_left_join(rows, right, ["k"]))
        assert plain.count("Exchange hashpartitioning") == 2 and "Broadcast" not in plain
        # floating keys: 0.0 and -0.0 are one, and types that differ meet as in a join
        zeros = spark.createDataFrame([(-0.0, 1)] * 30 + [(0.0, 2)] * 30, "k double, n int")
        other = spark.createDataFrame([(0, "zero"), (5, "five")], "k long, w string")
        got = skew.salted_left_join(zeros, other, ["k"], heavy_rows=20)
        assert got.where("w = 'zero'").count() == 60
        spread = skew.salted_left_join(hot, right, ["k"], heavy_rows=1000)
        assert tuples(spread, "k", "n", "w") == tuples(hot.join(right, "k", "left"), "k", "n", "w")


def test_few_keys_are_counted_not_guessed(spark, tmp_path):
    """Small files of many rows are not broadcast row by row."""
    path = str(tmp_path / "rows")
    spark.range(0, 3_000_000).select(F.lit(7).alias("k"), F.col("id").alias("n")).select("k").write.parquet(path)
    spark.range(0, 3_000_000, 1, 1).select((F.col("id") % 500_000).alias("k")).write.option("compression", "gzip").parquet(path + "2")
    once, many = spark.read.parquet(path), spark.read.parquet(path + "2")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="10000000"):
        assert fits_broadcast(once) and fits_broadcast(many) and not fits_by_rows(once)
        assert few_keys(once, ["k"]).count() == 1
        assert few_keys(many, ["k"]) is None
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert few_keys(once, ["k"]) is None


def test_stored_hashes_are_reduced_without_a_sort(spark):
    plan = plan_of(classify_changes(batch(spark, [(1, "a")]), stored(spark, TABLE), ["k"]))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rank_is_cut_before_the_shuffle(spark):
    plan = plan_of(dedupe_batch(batch(spark, [(1, "a")]), ["k"], "last", ["v"]))
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_current_snapshot(spark):
    assert tuples(current_snapshot(stored(spark, TABLE)), "k") == [(1,), (2,), (3,)]
