import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spinmart.operators import ranking
from spinmart.operators.ranking import heavy_groups, rank_within, split_groups
from spinmart.operators.staging import stage

SCHEMA = "uid string, game int, id int, tag string"


def skewed(seed, size=3000):
    """One user holds a third of the rows, NULL users another tenth; ids and tags tie at times."""
    draw = random.Random(seed)
    out = []
    for _ in range(size):
        share = draw.random()
        uid = "hot" if share < 1 / 3 else None if share < 0.43 else f"u{draw.randrange(200)}"
        number = draw.randrange(size // 2) if draw.random() < 0.95 else None
        out.append((uid, draw.choice([20, 21]), number, draw.choice("abc")))
    return out


def brute_force(data, keys):
    groups = defaultdict(list)
    for row in data:
        groups[tuple(row[k] for k in keys)].append(row)
    ranked = []
    for group in groups.values():
        group.sort(key=lambda r: (r[2] is None, r[2] or 0, r[3], r[0] is None, r[0] or "", r[1]))
        ranked += [(*row, n) for n, row in enumerate(group, 1)]
    return ranked


def as_set(ranked):
    return sorted(ranked, key=str)


@pytest.mark.parametrize("limit", [50, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_brute_force_with_and_without_slices(spark, seed, limit):
    data = skewed(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = rank_within(df, ["uid", "game"], ["id", "tag"], limit=limit)
    assert as_set(map(tuple, got.collect())) == as_set(brute_force(data, (0, 1)))


@pytest.mark.parametrize("limit", [50, 10_000])
def test_one_global_group(spark, limit):
    data = skewed(3, 700)
    got = rank_within(spark.createDataFrame(data, SCHEMA), [], ["id", "tag"], limit=limit)
    ranked = sorted(map(tuple, got.collect()), key=lambda r: r[-1])
    assert [r[-1] for r in ranked] == list(range(1, 701))
    assert [r[:4] for r in ranked] == [r[:4] for r in sorted(brute_force(data, ()), key=lambda r: r[-1])]


def test_descending_order_through_slices(spark):
    data = [("hot", 1, n, "x") for n in range(400)]
    got = rank_within(spark.createDataFrame(data, SCHEMA), ["uid"], [F.desc("id")], limit=10)
    assert {(r.id, r.rn) for r in got.collect()} == {(n, 400 - n) for n in range(400)}


def test_heavy_groups_list_only_the_large_ones(spark, rows):
    df = spark.createDataFrame([("a", 1)] * 5 + [(None, 1)] * 4 + [("b", 1)] * 3, "uid string, game int")
    assert rows(heavy_groups([df], ["uid"], 3)) == [("a",), (None,)]
    assert heavy_groups([df], ["uid"], 5) is None


def test_heavy_in_any_frame(spark, rows):
    left = spark.createDataFrame([("a",)] * 5 + [("b",)], "uid string")
    right = spark.createDataFrame([("b",)] * 5 + [("a",)] * 5 + [("c",)], "uid string")
    assert rows(heavy_groups([left, right], ["uid"], 4)) == [("a",), ("b",)]
    assert heavy_groups([left, right], ["uid"], 5) is None


def test_every_heavy_group_is_sliced_however_many_there_are(spark, monkeypatch):
    """Nothing bounds the list, and nothing collects it; a broadcast limit of 0 bytes changes no row."""
    data = [(f"u{u}", 1, n, "x") for u in range(300) for n in range(4)] + [("small", 1, 0, "x")]
    df = spark.createDataFrame(data, SCHEMA)
    assert heavy_groups([df], ["uid"], 3).count() == 300
    sliced = []
    real = ranking.rank_by_slices
    monkeypatch.setattr(ranking, "rank_by_slices", lambda part, *rest: sliced.append(part.count()) or real(part, *rest))
    for limit in (64 << 20, 0):
        monkeypatch.setattr("spinmart.operators.sizing.BROADCAST_BYTES", limit)
        got = rank_within(df, ["uid"], ["id"], limit=3)
        assert {(r.uid, r.id, r.rn) for r in got.collect()} == {(u, n, n + 1) for u, _, n, _ in data}
    assert sliced == [1200, 1200]


def test_rows_without_keys_are_ranked_by_slices(spark, monkeypatch, plan_of):
    df = spark.createDataFrame([("u", 1, n * 7 % 900, "x") for n in range(900)], SCHEMA)
    got = rank_within(df, [], [F.desc("id")])
    assert "SinglePartition" not in plan_of(got)
    assert {(r.id, r.rn) for r in got.collect()} == {(n, 900 - n) for n in range(900)}


def test_split_keeps_every_row_once(spark):
    df = spark.createDataFrame(skewed(4, 500), SCHEMA)
    rest, large = split_groups(df, heavy_groups([df], ["uid", "game"], 15), ["uid", "game"])
    assert rest.count() + large.count() == 500
    assert sorted({r.uid for r in large.collect()}, key=str) == [None, "hot"]


def test_slices_hold_about_the_limit(spark, monkeypatch):
    """One user's 8,000 rows and a limit of 500: sixteen slices of about equal size."""
    staged = []

    def keep(df, label):
        table = stage(df, label)
        if label == "slices":
            staged.append(table)
        return table

    monkeypatch.setattr(ranking, "stage", keep)
    df = spark.createDataFrame([("hot", 1, n, "x") for n in range(8000)], SCHEMA).repartition(6)
    got = rank_within(df, ["uid", "game"], ["id"], limit=500)
    assert got.where("rn <> id + 1").count() == 0 and got.count() == 8000
    sizes = [r["count"] for r in staged[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1000


def test_estimate_finds_large_groups_and_leaves_small_ones(spark, rows):
    df = spark.range(0, 400_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('u', id % 50000) END AS uid", "id")
    assert rows(heavy_groups([df], ["uid"], 50_000)) == [("hot",)]
    got = rank_within(df, ["uid"], ["id"], limit=50_000)
    wrong = got.where("uid = 'hot' AND rn <> id / 3 + 1")
    assert wrong.count() == 0 and got.where("uid = 'hot'").count() == 133_334
