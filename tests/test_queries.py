import __spark_entry__ as entry
import pytest
from tests import oracle

SF = "/root/testdata/sf0.001"
SQL = entry.plans.SQL


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    assert oracle.differences(spark, con, entry.plans.QUERIES[name], SQL[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(entry.plans.QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert entry.plans.QUERIES[name](spark, SF).count() > 0


def test_signflip_takes_every_unit(spark, con):
    rows = entry.plans.QUERIES["paired_effects_signflip"](spark, SF).collect()
    assert all((r.exact_signflip_p_mean_difference is not None) == (r.n_paired_units >= 2) for r in rows)
    got = {}
    for r in rows:
        n, higher = got.get((r.compartment, r.metric), (0, 0))
        got[r.compartment, r.metric] = (n + r.n_paired_units, higher + r.n_higher_in_comparison)
    whole = con.execute(SQL["paired_effects"]).fetchall()
    assert whole and all(got[c, m] == (n, higher) for c, m, n, higher, *_ in whole)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and "h_score" not in df.columns and "tissue_area_px" in df.columns


def test_regions_have_tasks_by_lines(spark, con, monkeypatch):
    """With a fixed number of tasks a task's sorts grew with the lines."""
    from tessella.plans import stand_ins

    monkeypatch.setattr(stand_ins, "TASK_LINES", 500, raising=False)
    lines = con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    assert lines > 500 * 4 and stand_ins.regions(spark, SF).rdd.getNumPartitions() == -(-lines // 500)
    for name in ("primary_long", "exact_signflip"):
        assert oracle.differences(spark, con, entry.plans.QUERIES[name], SQL[name], SF) == ""


def test_smallest_gap_shuffles_once(spark, con, monkeypatch):
    """A nucleus was shuffled to nine buckets, so that the disk ran out."""
    from tessella.plans import stand_ins

    monkeypatch.setattr(stand_ins, "TASK_LINES", 500)
    found, lines = entry.plans.QUERIES["smallest_gap"](spark, SF), con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert lines > 500 * 4 and found.rdd.getNumPartitions() == -(-lines // 500)
    assert oracle.differences(spark, con, entry.plans.QUERIES["smallest_gap"], SQL["smallest_gap"], SF) == ""
