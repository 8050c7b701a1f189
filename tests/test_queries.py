"""Registered survey queries against their SQL in DuckDB. SKYLEDGER_ALL=1 runs them all, else one of each module's light ones."""

import os
from collections import Counter

import duckdb
import pytest

from skyledger import plans

TABLES = "region nation customer supplier part orders lineitem events".split()
LIGHT = [
    "radius_pairs", "mutual_nearest", "unambiguous_match", "parse_obs_id", "parse_filters", "mjd_iso", "tan_project", "position_valid", "obs_scope", "unmeasurable_reason", "hist_mode",
    "binned_stat", "weighted_median", "nan_accounting", "diff_events", "state_after_poll", "actionable", "deferred_state", "pointings", "best_catalogue", "layout_choice", "covering_verdict",
    "release_gate", "sticky_checklist", "provenance_digest", "aperture_flux", "band_limits", "two_colour", "plateau_peak", "stage_presence", "stage_precision", "match_file", "header_store",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{round(float(v), 6) + 0.0:.6f}"
    return str(v)


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()) if os.environ.get("SKYLEDGER_ALL") else LIGHT)
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = plans.queries()[name](spark, sf_dir)
    want = duck.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert bag([tuple(r) for r in got.collect()], got.columns) == bag(want.fetchall(), columns)


@pytest.mark.parametrize("name", ["title_lines", "odd_titles"])
def test_titles_of_programs_with_over_five_digits(spark, sf_dir, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"copy (select * replace (o_custkey + 899990 as o_custkey) from '{sf_dir}/orders.parquet') to '{tmp_path}/orders.parquet'")
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    got, want = plans.queries()[name](spark, str(tmp_path)), con.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert bag([tuple(r) for r in got.collect()], got.columns) == bag(want.fetchall(), columns)


def test_queries_load_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) > 150 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True, timeout=120)
