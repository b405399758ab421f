"""Every registered query against its DuckDB oracle on the smallest tables,
plus invariants of the composite pipelines."""

import math
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake.plans.registry import ORACLE, QUERIES
from ledgerlake.sources.adapters import TABLES

from .conftest import SF_MED, SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.12g}")
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    a = Counter(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    b = Counter(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    out = entry.entry(spark)
    assert set(out.columns) == {"cost_category", "total_cost", "records", "valid_records", "unsummed_rows"}
    assert out.count() >= 1


def test_pipeline_invariants(spark):
    from ledgerlake.operators.validate import REASON, split_valid_quarantine
    from ledgerlake.plans.registry import all_records
    from ledgerlake.sources.adapters import adapter, billing_raw
    recs = all_records(spark, SF_MED)
    valid, quarantine = split_valid_quarantine(recs)
    n_in = (billing_raw(spark, SF_MED).count()
            + adapter(spark, SF_MED, "v_accounts").filter("Type = 'Customer'").count()
            + adapter(spark, SF_MED, "v_opportunities").filter("CloseDate >= date'2001-02-02'").count())
    assert recs.count() == n_in
    assert valid.count() + quarantine.count() == n_in
    assert quarantine.filter(F.col(REASON).isNull()).count() == 0


def test_spot_values_sf001(spark):
    """Spot values from FIXTURES.md, computed independently of the oracle SQL."""
    out = {r.cost_category: (round(r.total_cost, 4), r.records)
           for r in entry.queries()["billing_cost_by_category"](spark, SF_MED).collect()}
    assert out == {"production": (114663957.0721, 12030), "staging": (128808612.5734, 12072),
                   "development": (115084588.8194, 12023), "unallocated": (239694299.9830, 23875)}
    trips = {r.sink_id: r.trips for r in entry.queries()["trips_per_sink"](spark, SF_MED).collect()}
    assert [trips[i] for i in range(8)] == [25, 31, 25, 28, 20, 40, 16, 26]
    assert entry.queries()["join_on_correlation"](spark, SF_MED).count() == 12117
