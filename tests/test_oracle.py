"""Every registered query against its DuckDB oracle on the smallest scale factor
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from oracle_harness import compare, duck

# The training-data operators have their own tests.
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
# The file hashes' SQL names the folder of the driver's correctness run, as views don't tell their files.
ORACLE = {k: v.replace(SF_ORACLE, SF_SMALL) for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, QUERIES[key], ORACLE[key], SF_SMALL, con)
    assert r["ok"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "peso_raca" in df.columns


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "float": "FLOAT"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_types_match_oracle(spark, con, key):
    spark_types = dict(QUERIES[key](spark, SF_SMALL).dtypes)
    duck_types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {ORACLE[key]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types


def test_file_hashes_match_hashlib(spark):
    import hashlib
    import os
    got = {r.tabela: r.sha256 for r in QUERIES["man_file_hashes"](spark, SF_SMALL).collect()}
    for name in ("region", "orders"):
        data = open(os.path.join(SF_SMALL, f"{name}.parquet"), "rb").read()
        assert got[name] == hashlib.sha256(data).hexdigest()
