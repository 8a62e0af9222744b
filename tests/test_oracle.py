"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import digest

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[key])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows) == digest(dcols, drows)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    assert len(sdf.columns) > 0
    assert sdf.count() >= 1


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["STATE", "median_prediction"]
    assert df.count() > 0


def test_every_survey_id_has_registered_queries():
    from tools.coverage import COVERAGE
    from claimlake.plans.catalogue import QUERIES as own
    missing = [(sid, k) for sid, (_, keys) in COVERAGE.items() for k in keys if k not in own]
    assert not missing
    covered = {k for _, keys in COVERAGE.values() for k in keys}
    assert covered == set(own)
