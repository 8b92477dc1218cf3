import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edge_rows import row_set, rows
from orderloom.operators.dedupe import distinct_values, first_appearance, keep_first
from orderloom.operators.integrity import duplicate_key_count, duplicate_keys, orphan_keys, orphan_rows
from orderloom.operators.lookup import MATCHED, left_lookup
from orderloom.operators.rollup import measure_by, roll_up, sums_by_each
from orderloom.operators.surrogate import dense_keys
from orderloom.schemas import POSITION

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def positioned(spark, keys, per_part=3):
    """Rows (key, nth) at shuffled places, with their true position attached."""
    table = [(key, nth, nth // per_part, nth) for nth, key in enumerate(keys)]
    random.Random(1).shuffle(table)
    frame = spark.createDataFrame(table, "key string, nth int, part int, row int")
    place = F.struct(F.col("part"), F.col("row")).alias(POSITION)
    return frame.select("key", "nth", place).repartition(5)


@FEW
@given(st.lists(st.sampled_from(["a", "b", "c", "d", None]), min_size=1, max_size=40))
def test_keep_first_and_dense_keys_follow_source_order(spark, keys):
    frame = positioned(spark, keys)
    firsts = {}
    for nth, key in enumerate(keys):
        firsts.setdefault(key, nth)
    assert dict(rows(keep_first(frame, "key").select("key", "nth"))) == firsts
    named = [key for key in firsts if key is not None]
    numbered = dense_keys(first_appearance(frame, "key"), "id").select("key", "id")
    assert dict(rows(numbered)) == {key: nth + 1 for nth, key in enumerate(named)}
    assert row_set(distinct_values(frame, "key")) == sorted((key,) for key in named)


def test_dense_keys_over_many_parts(spark):
    keys = [f"k{n % 997:04d}" for n in range(5000)]
    frame = positioned(spark, keys, per_part=7)
    numbered = dict(rows(dense_keys(first_appearance(frame, "key"), "id").select("key", "id")))
    assert numbered == {f"k{n:04d}": n + 1 for n in range(997)}


def test_keep_first_with_one_hot_key(spark):
    frame = positioned(spark, ["hot" if n % 3 == 0 else f"k{n}" for n in range(1, 3000)])
    found = dict(rows(keep_first(frame, "key").select("key", "nth")))
    assert found["hot"] == 2 and len(found) == 2001


def test_lookup_tells_a_miss_from_a_null(spark):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    found = left_lookup(left, F.col("k"), right, "id").select("k", "v", MATCHED)
    assert row_set(found) == sorted([(1, "x", True), (2, None, True), (3, None, None), (None, None, None)], key=repr)


def test_orphans_ignore_null_keys_on_both_sides(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(orphan_keys(child, "k", parent, "id")) == [(2, 2)]
    assert rows(orphan_rows(child, "k", parent, "id")) == [(2,)]
    assert rows(orphan_rows(child.where("k = 1"), "k", parent, "id")) == [(0,)]


def test_duplicates(spark):
    frame = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert row_set(duplicate_keys(frame, "k")) == [(1, 3), (3, 2)]
    assert rows(duplicate_key_count(frame, "k")) == [(2,)]
    assert rows(duplicate_key_count(frame.limit(0), "k")) == [(0,)]


@pytest.mark.parametrize("partitions", [1, 16])
def test_roll_up_equals_join_then_group(spark, partitions):
    facts = [(n % 7 if n % 3 else 0, n if n % 5 else None) for n in range(500)] + [(None, 1), (99, 1)]
    fact = spark.createDataFrame(facts, "k int, q bigint").repartition(partitions)
    dim = spark.createDataFrame([(k, f"city{k % 2}") for k in range(7)], "k int, city string")
    measures = {"n": F.count("q"), "units": F.sum("q")}
    found = roll_up(measure_by(fact, ["k"], measures), dim, "k", ["city"], measures)
    direct = fact.join(dim, "k").groupBy("city").agg(F.count("q").alias("n"), F.sum("q").alias("units"))
    assert row_set(found) == row_set(direct)


def test_roll_up_keeps_all_null_sums_null(spark):
    fact = spark.createDataFrame([(1, None)], "k int, q bigint")
    dim = spark.createDataFrame([(1, "x")], "k int, city string")
    measures = {"n": F.count("q"), "units": F.sum("q")}
    assert rows(roll_up(measure_by(fact, ["k"], measures), dim, "k", ["city"], measures)) == [("x", 0, None)]


def test_first_appearance_hashes_plain_minima(spark):
    rows = spark.range(0, 3000, 1, 6).select(
        (F.col("id") % 7).cast("string").alias("name"),
        F.struct((9 - F.col("id") % 10).alias("part"), F.col("id").alias("row")).alias(POSITION),
    )
    rows = rows.withColumn("name", F.when(F.col("name") != "6", F.col("name")))
    found = first_appearance(rows, "name")
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    expected = {}
    for i in range(3000):
        if i % 7 != 6:
            place = (9 - i % 10, i)
            expected[str(i % 7)] = min(expected.get(str(i % 7), place), place)
    assert {r["name"]: tuple(r[POSITION]) for r in found.collect()} == expected


def test_sums_by_each_key_in_one_pass(spark):
    rows = spark.range(200).select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 3).alias("a"),
        (F.col("id") % 4).cast("string").alias("b"),
        "id",
    )
    sums = sums_by_each(rows, ["a", "b"], {"n": F.count(F.lit(1)), "total": F.sum("id")})
    assert sums._jdf.queryExecution().executedPlan().toString().count("Range") == 1
    for key in ("a", "b"):
        own = sums.where(F.col("grain") == key).select(key, "n", "total")
        plain = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("total"))
        assert sorted(map(str, own.collect())) == sorted(map(str, plain.collect()))
