"""Plans: hot keys are split or combined early, pruning reaches the scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from histlake.operators import history
from histlake.operators.dedupe import last_per_key
from histlake.operators.facts import lookup_or_unknown
from histlake.operators.history import asof_link
from histlake.operators.numbering import number_rows
from histlake.plans import serving
from histlake.plans.state import build_versions
from histlake.plans.warehouse import Warehouse
from histlake.schema import KEY
from histlake.session import cut_lineage

from .helpers import frame, returns


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_splits(spark):
    """Thresholds low enough for test data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.files.maxPartitionBytes": "60000",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, hot="0"):
    """Half of the rows have one key."""
    return cut_lineage(
        spark.range(40000, numPartitions=8).select(
            "id",
            F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
            F.lit("2024-02-01").cast("date").alias("day"),
            F.lit(9).alias("seq"),
        )
    )


def ran(df):
    """Execute like a caller who reads every row; return the count and the final plan."""
    counted = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns) % 1000))
    n = counted.collect()[0][0]
    return n, plan_of(counted)


def test_hot_key_of_a_lookup_is_split(spark, small_splits):
    members = cut_lineage(spark.range(600).select(F.col("id").cast("string").alias("k")))
    n, plan = ran(lookup_or_unknown(skewed(spark), members, "k"))
    assert n == 40000 and "SortMergeJoin(skew=true)" in plan


def test_missing_keys_of_a_lookup_are_split(spark, small_splits):
    members = cut_lineage(spark.range(600).select(F.col("id").cast("string").alias("k")))
    n, plan = ran(lookup_or_unknown(skewed(spark, None), members, "k"))
    assert n == 40000 and "SortMergeJoin(skew=true)" in plan


def test_hot_key_of_an_asof_link_is_split(spark, monkeypatch):
    """Half of the facts have one key: no task gets more than its share of them."""
    monkeypatch.setattr(history, "HOT_FACTS", 1000)
    versions = spark.range(1000).select(
        F.col("id").cast("string").alias("k"),
        F.lit(1).alias("opened_seq"),
        F.col("id").alias("sk"),
        F.lit("2024-01-01").cast("date").alias("valid_from"),
        F.lit("9999-12-31").cast("date").alias("valid_to"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        linked = asof_link(skewed(spark), versions, "day", "seq", "k", "sk", many_per_key=True)
        rows = linked.groupBy(F.spark_partition_id()).count().collect()
        wrong = linked.where("NOT sk <=> CAST(k AS BIGINT)").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in rows) == 40000 and not wrong
    assert max(r["count"] for r in rows) < 8000


def test_asof_link_gathers_no_versions(spark):
    """One shuffle for facts and versions alike, no array or join per key, and a key with
    100,000 versions and as many facts is no problem."""
    n = 100_000
    day = F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int"))
    versions = cut_lineage(
        spark.range(n).select(
            F.lit("k").alias("k"), F.col("id").cast("int").alias("opened_seq"), F.col("id").alias("sk"), day.alias("valid_from"),
            F.when(F.col("id") < n - 1, F.date_add(day, 1)).otherwise(F.lit("9999-12-31").cast("date")).alias("valid_to"),
        )
    )
    facts = cut_lineage(spark.range(n, numPartitions=8).select(F.lit("k").alias("k"), "id", day.alias("day"), F.lit(n).alias("seq")))
    linked = asof_link(facts, versions, "day", "seq", "k", "sk", "hit")
    assert linked.where("hit AND sk = id").count() == n
    plan = plan_of(linked)
    assert "Join" not in plan and "collect_list" not in plan
    assert plan.count("Exchange hashpartitioning") == 2  # the versions are ordered once by themselves


def test_last_row_per_key_combines_before_the_shuffle(spark):
    plan = plan_of(last_per_key(skewed(spark), ["k"], ["id"]))
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_history_needs_one_shuffle_after_deduplication(spark):
    log = cut_lineage(frame(spark, returns({}, {"record_type": "update"})))
    plan = plan_of(build_versions(log))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Python") == 0
    assert "annual_income_sgd" not in plan[plan.index("ReadSchema") :]


def test_summary_aggregates_before_the_join(spark, small_splits):
    facts = cut_lineage(
        spark.range(1000).selectExpr(
            "id % 3 AS taxpayer_sk", "CAST(id AS double) AS tax_payable_sgd", "1.0D AS annual_income_sgd"
        )
    )
    dim = cut_lineage(spark.range(3).selectExpr("id AS taxpayer_sk", "'x' AS occupation"))
    df = serving.summary(facts, dim, "occupation")
    plan = plan_of(df)
    assert plan.index("Join") < plan.index("partial_count(1)")
    row = df.first()
    assert (row.num_returns, row.total_tax_payable, row.avg_annual_income) == (1000, 499500.0, 1.0)


def test_filters_reach_the_scan(spark):
    dim = cut_lineage(frame(spark, returns({})).withColumn("is_current", F.lit(True)))
    plan = plan_of(serving.profile(dim, "P1"))
    assert f"EqualTo({KEY},P1)" in plan and "EqualTo(is_current,true)" in plan
    assert "annual_income_sgd" not in plan


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 37 % 1000).alias("k"))
    got = number_rows(df, ["k"], "n", 50).orderBy("k").collect()
    assert [r.n for r in got] == list(range(51, 1051))
    assert number_rows(df.limit(0), ["k"], "n").count() == 0


def test_jobs_do_not_depend_on_the_number_of_batches(spark, tmp_path):
    """Three batches or nine: one step runs the same jobs."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        log = cut_lineage(
            frame(spark, [r for b in range(1, n + 1) for r in returns({"taxpayer_id": f"P{b}", "batch": f"day{b}", "batch_seq": b}, {"occupation": f"O{b}", "record_type": "update", "batch": f"day{b}", "batch_seq": b, "row_pos": 9})])
        )
        w = Warehouse(spark, f"{tmp_path}/{n}", buckets=2)
        spark.sparkContext.setJobGroup(f"step-{n}", "several batches")
        try:
            reports = w.load_batches(log, [f"day{b}" for b in range(1, n + 1)])
        finally:
            spark.sparkContext.setJobGroup("other", "other")
        assert [r.batch_seq for r in reports] == list(range(1, n + 1)) and w.batch_log().count() == n
        assert w.table("dim_taxpayer").where("taxpayer_id = 'P1'").count() == n
        return len(tracker.getJobIdsForGroup(f"step-{n}"))

    few, many = jobs(3), jobs(9)
    assert 0 < many <= few + 6, (few, many)
