"""Physical-plan properties the design relies on (checked on sf0.001)."""
import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_one_chunk_exchange_no_whole_series_window(spark):
    p = plan(spark, "w09_build_features")
    chunk_ex = re.findall(r"Exchange hashpartitioning\(asset#\d+, _chunk#\d+", p)
    assert len(chunk_ex) == 1, p
    # every window over the bars is partitioned by (asset, _chunk[, _sub]); only the
    # small (asset, time bucket) offsets table is windowed by asset alone, and rows are numbered by (asset, bucket)
    specs = [m.split(" ASC")[0] for m in re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", p)]
    assert specs
    for spec in specs:
        assert "_chunk" in spec or "_bkt" in spec, spec


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(spark, "f01_equality_filter")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "k01_top_n")


def test_no_cartesian_products(spark):
    for name in ["m23_confusion_matrix", "j11_portfolio_contribution", "a11_label_share", "k02_top_groups_rows",
                 "p11_percent_scale"]:
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_align_outer_is_one_aggregate_not_chained_joins(spark):
    p = plan(spark, "j01_align_outer")
    assert "FullOuter" not in p and "SortMergeJoin" not in p
