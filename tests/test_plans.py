"""Plan-shape checks: the properties the design relies on at scale, read
from `explain("formatted")`."""

from conftest import SF_SMALL


def _plan(spark, key, capsys):
    import __spark_entry__ as entry

    df = entry.queries()[key](spark, SF_SMALL)
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_filter_pushed_and_columns_pruned(spark, capsys):
    p = _plan(spark, "filter_eq", capsys)
    assert "EqualTo(event_type,purchase)" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p


def test_word_count_partial_aggregation(spark, capsys):
    p = _plan(spark, "word_count", capsys)
    assert "partial_count" in p
    assert "ReadSchema: struct<text:string>" in p


def test_range_lookup_is_hash_join(spark, capsys):
    p = _plan(spark, "ip_region_lookup", capsys)
    assert "BroadcastHashJoin" in p or "SortMergeJoin" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_running_aggregate_windows_are_split_by_range(spark, capsys):
    # rows meet in a window over (range, key); only the carry, two rows a range, is by key
    p = _plan(spark, "running_max", capsys)
    specs = [line for line in p.splitlines() if "windowspecdefinition(_scan_part" in line]
    assert specs and all("user_id" in line for line in specs)
    assert "BroadcastHashJoin" in p and "MapInPandas" not in p and "Python" not in p


def test_global_number_has_no_single_task_window(spark, capsys):
    p = _plan(spark, "win_count_tumbling", capsys)
    assert "windowspecdefinition(_scan_part" in p
    assert "MapInPandas" not in p


def test_report_filter_reaches_the_scan(spark, capsys):
    p = _plan(spark, "report_global", capsys)
    assert "EqualTo(o_orderstatus,O)" in p
    assert "from_json" not in p
