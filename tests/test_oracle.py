"""Every query against its SQL counterpart: on the sample tables, and on tables made awkward on purpose."""

from __future__ import annotations

import sys
from dataclasses import replace
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import connect, difference  # noqa: E402
from martloom.plans import workload  # noqa: E402
from martloom.plans.oracle import oracle_sql  # noqa: E402
from martloom.plans.workload import DATASETS, money_as_double, queries, sample_warehouse  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"

# One customer owns a third of all orders and one order a third of all payments; ids occur in several rows,
# equal and different; names, statuses and dates are missing; orders and payments refer to nothing.
AWKWARD = {
    "customer": """
        SELECT * FROM base
        UNION ALL SELECT * FROM base WHERE c_custkey IN (7, 8)
        UNION ALL SELECT * REPLACE ('Renamed#' || c_custkey AS c_name) FROM base WHERE c_custkey IN (3, 7)
        UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS c_name, 900000 + c_custkey AS c_custkey)
            FROM base WHERE c_custkey < 5""",
    "orders": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 31 = 0 THEN 777777
            ELSE o_custkey END AS o_custkey) FROM base
        UNION ALL SELECT * FROM base WHERE o_orderkey IN (10, 11)
        UNION ALL SELECT * REPLACE ('F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice)
            FROM base WHERE o_orderkey IN (10, 20, 21)
        UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderstatus, 800000 + o_orderkey AS o_orderkey)
            FROM base WHERE o_orderkey < 5
        UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS o_orderkey) FROM base WHERE o_orderkey < 3""",
    "lineitem": """
        SELECT * REPLACE (CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN 10 ELSE l_orderkey END AS l_orderkey)
            FROM base
        UNION ALL SELECT * REPLACE (700000 + l_orderkey AS l_orderkey) FROM base WHERE l_orderkey < 20
        UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS l_shipdate) FROM base WHERE l_orderkey < 20""",
    "events": "SELECT * FROM base",
}


def _awkward(folder: Path) -> str:
    con = duckdb.connect()
    for name, sql in AWKWARD.items():
        con.execute(f"CREATE OR REPLACE VIEW base AS SELECT * FROM read_parquet('{SAMPLE}/{name}.parquet')")
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def awkward(tmp_path_factory) -> str:
    return _awkward(tmp_path_factory.mktemp("awkward"))


@pytest.fixture(scope="module")
def sql() -> dict[str, str]:
    return oracle_sql()


def test_every_query_has_sql(sql):
    assert set(queries()) == set(sql)


@pytest.mark.parametrize("name", sorted(queries()))
def test_sample(spark, sql, name):
    assert difference(queries()[name](spark, SAMPLE), connect(SAMPLE), sql[name]) is None


@pytest.mark.parametrize("name", DATASETS)
def test_awkward(spark, sql, awkward, name):
    df = money_as_double(sample_warehouse(spark, awkward, unique_ids=False).ref(name))
    assert difference(df, connect(awkward), sql[name]) is None


@pytest.mark.parametrize("name", [n for n in queries() if n.startswith("dq_") and not n.endswith("_violated")])
def test_awkward_checks(spark, sql, awkward, name, monkeypatch):
    monkeypatch.setattr(workload, "SAMPLE_PARAMS", replace(workload.SAMPLE_PARAMS, unique_ids=False))
    assert difference(queries()[name](spark, awkward), connect(awkward), sql[name]) is None
