"""Gold laid out by location: the same rows, and a question about an area reads a small part of them."""

import random

import pytest
from pyspark.sql import functions as F

from contrail.functions.space import space_key
from contrail.plans import airborne
from contrail.plans.jobs import read_gold, run_gold
from contrail.plans.layers import silver_latest
from contrail.sinks import Commit, TableStore, with_country_part
from test_quality_status import NOW, frame, state

BOX = (10.0, 14.0, 100.0, 106.0)


def slow_key(lat, lon):
    cells = [min(max(int((x - lo) / w * 65536), 0), 65535) for x, lo, w in ((lat, -90, 180), (lon, -180, 360))]
    out = 0
    for b in range(15, -1, -1):
        out = out << 2 | (cells[0] >> b & 1) << 1 | cells[1] >> b & 1
    return out


def test_key_interleaves_the_bits(spark):
    rng = random.Random(6)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0)]
    df = spark.createDataFrame(places, "latitude double, longitude double")
    assert [r.k for r in df.select(space_key().alias("k")).collect()] == [slow_key(*p) for p in places]
    odd = spark.createDataFrame([(None, 5.0), (95.0, None), (float("nan"), 200.0)], "latitude double, longitude double")
    assert all(0 <= r.k < 1 << 32 for r in odd.select(space_key().alias("k")).collect())


def _scanned(df):
    """Rows that the scans of an executed query put out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    rows = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            leaf = leaf.plan().collectLeaves().apply(0)
        rows += leaf.metrics().apply("numOutputRows").value()
    return rows


def test_area_question_reads_a_part_of_the_table(spark, scratch):
    one = silver_latest(frame(spark, state(icao="a")), NOW, run_ts="20231114_220000")
    n = 60_000
    spread = spark.range(n).select("id", F.rand(3).alias("u"), F.rand(4).alias("v"), (F.col("id") % 3 == 0).alias("hot"))
    row = one.first().asDict()
    rows = spread.withColumns({c: F.lit(row[c]).cast(one.schema[c].dataType) for c in one.columns}).withColumns({
        "icao24": F.format_string("%06x", "id"),
        "latitude": F.when(F.col("hot"), F.lit(51.5)).otherwise(F.col("u") * 180 - 90),  # a third of all rows in one place
        "longitude": F.when(F.col("hot"), F.lit(-0.1)).otherwise(F.col("v") * 360 - 180),
    }).select(*one.columns)
    store = TableStore(spark, f"{scratch}/store")
    v, path = store.write_version(with_country_part(rows), "silver", partition_by="country_part")
    store.commit(Commit("silver", v, path, n, run_ts="20231114_220000"))
    assert run_gold(spark, store).record_count == run_gold(spark, store, by_location=True).record_count == n
    plain, located = read_gold(store, 1), read_gold(store, 2)
    assert plain.exceptAll(located).count() == 0 and plain.columns == located.columns
    answers, scans = [], []
    for table in (plain, located):
        q = airborne(table, bbox=BOX)
        answers.append(q.collect())
        scans.append(_scanned(q))
    assert answers[0] == answers[1] and answers[0][0].n_airborne > 0
    assert scans[1] < scans[0] / 4, scans
    with pytest.raises(ValueError):
        run_gold(spark, store, by_location=True, partition_by="status")
