"""Scale guards on the physical plans of every registered query: no
cartesian products or nested-loop joins (no all-pairs work), no window
without a partition key (one task for all rows), and scans that read only
the columns a query needs."""
import contextlib
import io
import re

import __spark_entry__ as E

from .conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_no_all_pairs_or_global_windows(spark):
    bad = {}
    for name, fn in E.queries().items():
        plan = _plan(fn(spark, SF_SMALL))
        hits = [f for f in FORBIDDEN if f in plan]
        if re.search(r"Window \[[^\]]*\], \[\]", plan) or "SinglePartition, ENSURE_REQUIREMENTS" in plan and "Window" in plan:
            hits.append("unpartitioned window")
        if hits:
            bad[name] = hits
    assert bad == {}


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["unit_year_panel"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(set(x.split(":")[0] for x in s.split(",")) <= {"l_orderkey", "l_quantity"}
                            for s in lineitem)
    plan = _plan(E.queries()["zero_share"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in "".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))


def test_scans_of_one_pass_plans(spark):
    """How often a query reads its largest table (plans before reuse of exchanges)."""
    def scans(name, t):
        return len(re.findall(rf"Location: [^\n]*/{t}\.parquet", _plan(E.queries()[name](spark, SF_SMALL))))

    assert scans("repair_totals", "lineitem") <= 3
    assert scans("downballot_shares", "events") == 1
    assert scans("links_by_year", "pages") == 1
    assert scans("ols_fitted", "lineitem") <= 3
