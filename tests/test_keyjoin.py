from collections import Counter

import pytest
from pyspark.sql import functions as F

from salaria.plans import keyjoin, ordering
from salaria.plans.scratch import materialize


def test_measure_is_exact(spark):
    keys = spark.createDataFrame([("a", "xyz", 3), ("bb", None, 5)], "k string, v string, n long")
    size = keyjoin.measure(keys, "n")
    assert (size.keys, size.payload_bytes, size.total_rows) == (2, 1 + 3 + 2 + 0, 8)
    assert size.estimated_bytes == 6 + 2 * keyjoin.ROW_OVERHEAD_BYTES


def test_strategy_follows_the_budget(spark):
    size = keyjoin.KeyTableSize(keys=10, payload_bytes=100, total_rows=50)
    assert keyjoin.choose_strategy(size, size.estimated_bytes) == keyjoin.BROADCAST
    assert keyjoin.choose_strategy(size, size.estimated_bytes - 1) == keyjoin.SALTED


def _skewed(spark):
    """20 keys with 50 to 1000 rows, and their key table."""
    rows = spark.range(0, 20).select(F.col("id").alias("k0")).select(
        F.concat(F.lit("K"), F.col("k0").cast("string")).alias("k"),
        F.explode(F.sequence(F.lit(1), (F.col("k0") + 1) * 50)).alias("rid"),
    ).withColumn("rid", F.monotonically_increasing_id())
    keys = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("attr", F.length("k"))
    return rows, keys


def test_hot_list_is_measured_in_bytes(spark):
    _, keys = _skewed(spark)
    size = keyjoin.measure(keys, "n", "k", rows_per_task=900)
    assert size.hot_bytes == sum(len(f"K{i}") + keyjoin.ROW_OVERHEAD_BYTES for i in range(20) if (i + 1) * 50 > 900)
    assert keyjoin.measure(keys, "n", "k", rows_per_task=10**6).hot_bytes == 0


def test_hot_list_too_large_to_broadcast_is_shuffled_and_results_are_whole(spark):
    rows, keys = _skewed(spark)
    total = rows.count()
    for budget, broadcasts in ((1 << 20, 2), (0, 0)):
        joined = keyjoin.attach_by_key(rows, keys, "k", "n", "rid", max_broadcast_bytes=0,
                                       rows_per_task=100, max_hot_bytes=budget, join_partitions=7)
        plan = joined._jdf.queryExecution().simpleString()
        assert plan.count("BroadcastHashJoin") == broadcasts
        got = joined.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("rid").alias("d"), F.max("attr").alias("a")).collect()
        assert {r.k: (r.c, r.d, r.a) for r in got} == {f"K{i}": ((i + 1) * 50,) * 2 + (len(f"K{i}"),) for i in range(20)}
        assert sum(r.c for r in got) == total


@pytest.mark.parametrize("parts,small_parts,hot_bytes", [(5, False, 1 << 20), (40, False, 0), (1, False, 1 << 20), (13, True, 1 << 20)])
def test_ordered_salted_join_from_counts(spark, tmp_dir, monkeypatch, parts, small_parts, hot_bytes):
    """One wide exchange, no range sampling; part files in order and of even size, also where one key spans many."""
    rows, keys = _skewed(spark)
    keys = materialize(keys, f"{tmp_dir}/keys")
    rows = materialize(rows.withColumn("pad", F.lit("x")), f"{tmp_dir}/rows")
    if small_parts:  # running sums over several ranges of keys
        monkeypatch.setattr(keyjoin.sizing, "MIN_BYTES", 8)
    staged = []

    def stage(df, name):
        staged.append(name)
        return materialize(df, f"{tmp_dir}/{name}")

    out = keyjoin.attach_by_key(rows, keys, "k", "n", "rid", max_broadcast_bytes=0, rows_per_task=100, join_partitions=7,
                                order_by=("k", "rid"), order_partitions=parts, max_hot_bytes=hot_bytes, stage=stage)
    assert staged == ["report_starts"] * small_parts + ["report_chunks"] * (parts > 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("SortMergeJoin") >= 1
    assert plan.count("Exchange shufflepartitionidpassthrough") == (parts > 1) and plan.count("Exchange hashpartitioning(k") >= 2
    got = [tuple(r) for r in out.select("k", "rid", "attr", "pad", F.spark_partition_id()).collect()]
    assert [r[:2] for r in got] == sorted(tuple(r) for r in rows.select("k", "rid").collect())
    assert all(r[2] == len(r[0]) and r[3] == "x" for r in got)
    sizes = Counter(r[4] for r in got)
    # A key that is not hot lies in one part, and a range of a hot key's ids is an eighth of a part.
    assert len(sizes) <= parts and max(sizes.values()) <= 2.2 * len(got) / parts


def test_ordered_salted_join_of_nothing(spark):
    rows, keys = _skewed(spark)
    out = keyjoin.attach_by_key(rows.limit(0), keys.limit(0), "k", "n", "rid", max_broadcast_bytes=0, order_by=("k", "rid"))
    assert out.count() == 0 and out.columns == ["k", "rid", "attr"]
    with pytest.raises(ValueError):
        keyjoin.attach_by_key(rows, keys, "k", "n", "rid", order_by=("rid",))


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_running_sums(spark, tmp_dir, parts):
    df = spark.createDataFrame([(f"k{i * 7 % 100:03d}", i % 5) for i in range(100)], "k string, n long")
    got = ordering.running_sums(df, ["k"], "n", parts, lambda d, name: materialize(d, f"{tmp_dir}/{name}"), "s").collect()
    total = 0
    for r in sorted(got):
        assert r["_before"] == total
        total += r.n
    assert ordering.running_sums(df.limit(0), ["k"], "n", parts, lambda d, name: materialize(d, f"{tmp_dir}/e{name}"), "s").count() == 0
