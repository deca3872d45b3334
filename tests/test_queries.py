"""Every query beside its check SQL on the smallest test tables, and on a skewed copy of them."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from spinmart.given.checks import CHECK_SQL as CHECKS
from spinmart.given.queries import QUERIES
from spinmart.operators import ranking

SMALL = Path("/root/testdata/sf0.001")
SKEWED = ("pair_credits_wins", "rank_credits", "wins_with_failed", "mart_game", "mart_game_codes", "latest_per_key",
          "pair_by_code", "agent_report")

pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="no test tables")


def connect(folder):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def bag(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(str(r[i]) for i in order) for r in found)


def check(spark, con, name, folder, plan_of):
    df = QUERIES[name](spark, str(folder))
    plan = plan_of(df)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    answer = con.execute(CHECKS[name])
    want = bag([c[0] for c in answer.description], answer.fetchall())
    assert bag(df.columns, map(tuple, df.collect())) == want
    assert want[1]


def test_every_query_has_a_check():
    assert QUERIES.keys() == CHECKS.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_check(spark, plan_of, name):
    check(spark, connect(SMALL), name, SMALL, plan_of)


@pytest.fixture(scope="module")
def skewed_folder(tmp_path_factory):
    """The small tables with a third of orders, events and lines moved to one key."""
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(SMALL)
    moved = {
        "orders": ("o_custkey", "o_orderkey % 3 = 0", 0),
        "events": ("user_id", "event_id % 3 = 0", 0),
        "lineitem": ("l_orderkey", "l_suppkey % 3 = 0", 1),
    }
    for file in SMALL.glob("*.parquet"):
        replaced = ""
        if file.stem in moved:
            column, which, value = moved[file.stem]
            replaced = f"REPLACE (CASE WHEN {which} THEN {value} ELSE {column} END AS {column})"
        con.execute(f"COPY (SELECT * {replaced} FROM {file.stem}) TO '{folder / file.name}' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", SKEWED)
def test_query_on_skewed_tables_through_slices(spark, plan_of, skewed_folder, monkeypatch, name):
    """A low group limit sends the hot groups the sliced way."""
    found = []
    real = ranking.heavy_groups

    def low_limit(frames, keys, limit=0, estimate=0):
        found.append(real(frames, keys, 20))
        return found[-1]

    monkeypatch.setattr(ranking, "heavy_groups", low_limit)
    monkeypatch.setattr("spinmart.operators.pairing.heavy_groups", low_limit)
    check(spark, connect(skewed_folder), name, skewed_folder, plan_of)
    if name in ("pair_credits_wins", "rank_credits", "mart_game"):
        assert any(heavy is not None for heavy in found)
