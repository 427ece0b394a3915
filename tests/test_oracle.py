"""Every query of the archive part against its DuckDB oracle (rows, columns,
values, type families), as the driver checks it - here on the smallest tables.
The corpus queries have their own tests."""

import pytest

import __spark_entry__ as E
from tidemark.oracle import ORACLE
from tidemark.registry import QUERIES
from tools.compare import digest, duck, duck_family, spark_family

from conftest import SF001

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "__rowMarker__" and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert len(srows) == len(drows)
    hs, sc = digest(df.columns, srows)
    hd, dc = digest(dcols, drows)
    assert sc == dc
    assert hs == hd
    dtypes = {r[0]: duck_family(r[1]) for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {f.name: spark_family(f.dataType) for f in df.schema.fields} == dtypes
