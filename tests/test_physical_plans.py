"""The physical plans keep the properties the design relies on."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    df = E.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = _plan(spark, "impute_median")
    assert "FileScan parquet [l_orderkey#" in p and "l_extendedprice#" in p
    assert "l_comment" not in p and "l_shipdate" not in p and "l_quantity" not in p


def test_ordered_series_never_single_partition(spark):
    for key in ("fill_forward", "interpolate_linear", "stationarity"):
        p = _plan(spark, key)
        assert "SinglePartition" not in p, key
        assert "Window" in p, key


def test_dedup_and_aggregates_combine_map_side(spark):
    assert "partial_min" in _plan(spark, "dedup_signal")
    agg = _plan(spark, "entity_aggregate_events")
    assert "partial_sum" in agg and "partial_count" in agg
    conf = _plan(spark, "drop_conflicting_labels")
    assert "partial_min" in conf and "LeftAnti" in conf
