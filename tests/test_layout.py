import pytest

from snapkeep.operators.layout import shape_output


def test_shape_output_modes(spark):
    df = spark.range(1000).repartition(8)
    assert shape_output(df, 3, "coalesce").rdd.getNumPartitions() == 3
    assert shape_output(df, 5, "repartition").rdd.getNumPartitions() == 5
    assert shape_output(df, how="none") is df
    plan = shape_output(df, None, "rebalance", by=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    with pytest.raises(ValueError):
        shape_output(df, None, "coalesce")
    with pytest.raises(ValueError):
        shape_output(df, 2, "spread")
    with pytest.raises(ValueError):
        shape_output(df, 2, "none")
