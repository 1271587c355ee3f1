"""Plan-shape checks for the scale claims: map-side partial aggregation before
each shuffle, no Python in the hot path, no window sorts for winners."""

import pytest
from pyspark.sql import functions as F

from contrail.operators import dedup_states, latest_per_aircraft
from contrail.operators.quality import clean_rows
from contrail.plans import gold, silver_latest
from contrail.sources import read_states, state_vectors
from contrail.sources.bronze import DataQualityError
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [
    lambda sv: dedup_states(clean_rows(sv)),
    lambda sv: latest_per_aircraft(clean_rows(sv)),
    lambda sv: silver_latest(sv, 1706659199),
])
def test_winner_is_partial_aggregate_then_one_exchange(spark, build):
    plan = _plan(build(state_vectors(spark, SF_SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max" in plan  # map-side combine before the shuffle
    assert "Window" not in plan and "Python" not in plan


def test_gold_scan_prunes_and_pushes(spark, scratch):
    silver_latest(state_vectors(spark, SF_SMALL), 1706659199).write.parquet(scratch)
    df = gold(spark.read.parquet(scratch)).groupBy("origin_country").count()
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(status), Not(EqualTo(status,EXPIRED))]" in plan
    assert "ReadSchema: struct<origin_country:string,status:string>" in plan


def test_failfast_mode_raises_on_malformed(spark, scratch):
    spark.createDataFrame([("[1, 2",)], "value string").write.text(scratch)
    with pytest.raises(DataQualityError):
        read_states(spark, scratch, mode="failfast")
    assert read_states(spark, scratch).filter(F.col("_decode_error") == "unparsable").count() == 1


def test_event_rows_are_dealt_before_the_work_on_them(spark, capsys):
    """A small file is one row group, so one task reads it; the work on its rows begins after a shuffle."""
    state_vectors(spark, SF_SMALL).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.index("Generate") < plan.index("RebalancePartitions") < plan.index("Relation")
