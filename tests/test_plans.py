"""Physical-plan properties the design relies on."""

import re

import pytest

import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for inputs of cluster size."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["j03_category_pivot", "j03_category_pivot_wide"])
def test_pivot_is_one_plan_for_any_width(spark, small_dir, name):
    p = plan(E.QUERIES[name](spark, small_dir))
    assert "PivotFirst" not in p and "partial_sum(CASE WHEN" in p


@pytest.mark.parametrize("name", ["j12_keep_best", "j19_best_id_lookup"])
def test_a_hot_entry_is_limited_before_its_exchange(spark, small_dir, no_broadcast, name):
    """The partial limit stands below the exchange on the entry, and no join
    on the entry below that."""
    p = plan(E.QUERIES[name](spark, small_dir))
    final = p.index("WindowGroupLimit")
    assert re.search(r"Exchange hashpartitioning\(Entryid#\d+L?, \d+\)[^\n]*\n[\s:]*\+- WindowGroupLimit[^\n]*Partial", p[final:]), p


def test_j06_plan_joins_once(spark, small_dir, no_broadcast):
    assert len(re.findall(r"Exchange hashpartitioning", plan(E.QUERIES["j06_category_drift"](spark, small_dir)))) <= 6


def test_latest_per_key_uses_window_group_limit(spark, small_dir):
    df = E.QUERIES["j23_latest_per_key"](spark, small_dir)
    df.explain()  # plan must build
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in text


def test_mark_filter_reaches_the_scan(spark, small_dir):
    p = plan(E.QUERIES["j21_changed_since"](spark, small_dir))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_orderdate", p), p


@pytest.mark.parametrize("name", sorted(n for n in E.QUERIES if not n.startswith("j36_")))
def test_no_python_udf_no_cartesian(spark, small_dir, name):
    p = plan(E.QUERIES[name](spark, small_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_scan_prunes_columns(spark, small_dir):
    p = plan(E.QUERIES["j16_snapshot_diff"](spark, small_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("o_totalprice" not in s for s in schemas), schemas


@pytest.mark.parametrize("name", ["j03_category_counts_long", "j03_category_pivot_wide"])
def test_counts_shuffle_the_bridge_once_for_each_key(spark, small_dir, no_broadcast, name):
    """Bridge rows are counted map-side before they are shuffled on the id."""
    p = plan(E.QUERIES[name](spark, small_dir))
    assert re.search(r"HashAggregate\(keys=\[id#\d+L?, Category#\d+\], functions=\[partial_count", p), p
    assert len(re.findall(r"Exchange hashpartitioning", p)) <= 6, p
