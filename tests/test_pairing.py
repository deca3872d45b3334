import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spinmart.operators.pairing import full_join, pair_by_key, pair_nth

CREDITS = "uid string, game_id int, credit int"
WINS = "uid string, game_id int, win int"


def pair(spark, credits, wins, **options):
    return pair_nth(spark.createDataFrame(credits, CREDITS), spark.createDataFrame(wins, WINS),
                    ["uid", "game_id"], ["credit"], ["win"], **options)


def test_nth_credit_meets_nth_win(spark, rows):
    credits = [("a", 20, 11), ("a", 20, 12), ("a", 20, 13), ("b", 20, 21), ("c", 20, 31), ("e", 20, 41), ("e", 21, 42)]
    wins = [("a", 20, 1), ("b", 20, 2), ("b", 20, 3), ("b", 20, 4), ("d", 20, 5), ("e", 21, 6)]
    assert rows(pair(spark, credits, wins), "uid", "game_id", "credit", "rn", "win") == [
        ("a", 20, 11, 1, 1), ("a", 20, 12, 2, None), ("a", 20, 13, 3, None),
        ("b", 20, 21, 1, 2), ("b", 20, None, None, 3), ("b", 20, None, None, 4),
        ("c", 20, 31, 1, None), ("d", 20, None, None, 5),
        ("e", 20, 41, 1, None), ("e", 21, 42, 1, 6),
    ]


def test_null_users_are_kept_but_never_meet(spark, rows):
    got = rows(pair(spark, [(None, 20, 1)], [(None, 20, 2)]), "credit", "win")
    assert got == [(1, None), (None, 2)]


def random_streams(seed):
    draw = random.Random(seed)

    def user():
        share = draw.random()
        return "hot" if share < 1 / 3 else None if share < 0.4 else f"u{draw.randrange(60)}"

    credits = [(user(), draw.choice([20, 21]), n) for n in range(1500)]
    wins = [(user(), draw.choice([20, 21]), n) for n in range(900)]
    return credits, wins


def expected_pairs(credits, wins):
    def grouped(stream):
        groups = {}
        for uid, game, number in stream:
            groups.setdefault((uid, game), []).append(number)
        return {k: sorted(v) for k, v in groups.items()}

    left, right, out = grouped(credits), grouped(wins), []
    for key in left.keys() | right.keys():
        c, w = left.get(key, []), right.get(key, [])
        if key[0] is None:
            out += [(*key, n, i, None) for i, n in enumerate(c, 1)] + [(*key, None, None, n) for n in w]
            continue
        for i in range(max(len(c), len(w))):
            out.append((*key, c[i] if i < len(c) else None, i + 1 if i < len(c) else None, w[i] if i < len(w) else None))
    return Counter(out)


@pytest.mark.parametrize("limit", [40, 100_000])
@pytest.mark.parametrize("seed", [5, 6])
def test_pairing_loses_and_repeats_nothing(spark, seed, limit):
    credits, wins = random_streams(seed)
    want = expected_pairs(credits, wins)
    random.Random(seed).shuffle(credits)
    got = pair(spark, credits, wins, limit=limit).select("uid", "game_id", "credit", "rn", "win").collect()
    assert Counter(map(tuple, got)) == want
    matched = sum(1 for r in got if r.credit is not None and r.win is not None)
    assert len(got) == len(credits) + len(wins) - matched


def test_one_side_heavy_only(spark):
    credits = [("hot", 20, n) for n in range(300)] + [("x", 20, 1000)]
    wins = [("hot", 20, 5), ("x", 20, 6), ("x", 20, 7)]
    got = pair(spark, credits, wins, limit=50).select("uid", "game_id", "credit", "rn", "win").collect()
    assert Counter(map(tuple, got)) == expected_pairs(credits, wins)


def test_session_setting_saves_two_exchanges(spark, tmp_path):
    credits, wins = random_streams(7)
    spark.createDataFrame(credits, CREDITS).write.parquet(str(tmp_path / "c"))
    spark.createDataFrame(wins, WINS).write.parquet(str(tmp_path / "w"))
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    counts, results = {}, {}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for value in ("true", "false"):
            spark.conf.set(setting, value)
            df = pair_nth(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "w")),
                          ["uid", "game_id"], ["credit"], ["win"])
            counts[value] = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
            results[value] = Counter(map(tuple, df.collect()))
    finally:
        spark.conf.set(setting, "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert counts == {"true": 4, "false": 2}
    assert results["true"] == results["false"]


def test_rank_keys_may_differ_from_pair_keys(spark, rows):
    """Two site users share a phone: ranks restart per site user, so a rank comes twice."""
    credits = spark.createDataFrame(
        [("p", 23, 1, "s1"), ("p", 23, 2, "s2"), ("p", 23, 3, "s1")], CREDITS + ", site_user string")
    wins = spark.createDataFrame([("p", 23, 9)], WINS)
    by_site = pair_nth(credits, wins, ["uid", "game_id"], ["credit"], ["win"], left_rank_keys=["site_user", "game_id"])
    assert rows(by_site, "credit", "rn", "win") == [(1, 1, 9), (2, 1, 9), (3, 2, None)]
    by_phone = pair_nth(credits, wins, ["uid", "game_id"], ["credit"], ["win"])
    assert rows(by_phone, "credit", "rn", "win") == [(1, 1, 9), (2, 2, None), (3, 3, None)]


def test_ties_are_settled_by_the_other_columns(spark, rows):
    codes = [("a", 25, 5, "z"), ("a", 25, 5, "y"), ("a", 25, None, "x")]
    wins = spark.createDataFrame([("a", 25, 1), ("a", 25, 2), ("a", 25, 3)], WINS)
    for order in (codes, codes[::-1]):
        df = spark.createDataFrame(order, CREDITS + ", code string")
        got = rows(pair_nth(df, wins, ["uid", "game_id"], ["credit"], ["win"]), "code", "win")
        assert got == [("x", 3), ("y", 1), ("z", 2)]


LEFT, RIGHT = "code string, l int", "code string, r int"


def codes_brute_force(left, right):
    out = [(a, n, m) for a, n in left for b, m in right if a is not None and a == b]
    held = {b for b, _ in right if b is not None}, {a for a, _ in left if a is not None}
    out += [(a, n, None) for a, n in left if a is None or a not in held[0]]
    out += [(b, None, m) for b, m in right if b is None or b not in held[1]]
    return Counter(out)


@pytest.mark.parametrize("limit", [30, 100_000])
def test_pair_by_code(spark, limit):
    draw = random.Random(8)
    left = [("left-hot", n) for n in range(200)] + [("both", n) for n in range(60)] + [(None, n) for n in range(100)]
    left += [(f"c{draw.randrange(120)}", n) for n in range(150)]
    right = [("right-hot", n) for n in range(200)] + [("both", n) for n in range(50)] + [(None, n) for n in range(90)]
    right += [(f"c{draw.randrange(120)}", n) for n in range(150)] + [("", 1)]
    got = pair_by_key(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "code", limit)
    assert Counter(map(tuple, got.select("code", "l", "r").collect())) == codes_brute_force(left, right)


def test_defaults_fill_a_missing_side_only(spark, rows):
    left = spark.createDataFrame([(1, None, 5), (2, "x", None)], "id int, name string, n int")
    right = spark.createDataFrame([(1, None), (3, "r")], "id int, note string")
    got = full_join(left, right, ["id"], {"name": "", "n": 0}, {"note": ""})
    assert rows(got, "id", "name", "n", "note") == [(1, None, 5, None), (2, "x", None, ""), (3, "", 0, "r")]


def test_pairing_with_defaults(spark, rows):
    credits = spark.createDataFrame([("a", 20, 1), ("a", 20, 2)], CREDITS)
    wins = spark.createDataFrame([("a", 20, None), ("b", 20, 7)], WINS)
    got = pair_nth(credits, wins, ["uid", "game_id"], ["credit"], ["win"],
                   left_defaults={"credit": 0, "rn": 0}, right_defaults={"win": 0})
    assert rows(got, "uid", "credit", "rn", "win") == [("a", 1, 1, None), ("a", 2, 2, 0), ("b", 0, 0, 7)]


def test_heavy_codes_skip_the_full_join(spark):
    left = spark.createDataFrame([("hot", n) for n in range(100)] + [("a", 1)], LEFT)
    right = spark.createDataFrame([("a", 2), ("b", 3)], RIGHT)
    got = pair_by_key(left, right, "code", 50)
    assert got.where(F.col("r").isNull()).count() == 100 and got.count() == 102


@pytest.mark.parametrize("limit", [3, 1000])
def test_codes_with_defaults(spark, rows, limit):
    left = spark.createDataFrame([("a", 1), ("b", None), (None, 3)] + [("hot", 4)] * 5, LEFT)
    right = spark.createDataFrame([("b", 2), ("c", None)] + [("cold", 5)] * 4, RIGHT)
    got = pair_by_key(left, right, "code", limit, {"l": 0}, {"r": -1})
    assert rows(got, "code", "l", "r") == sorted(
        [("a", 1, -1), ("b", None, 2), ("c", 0, None), (None, 3, -1)] + [("cold", 0, 5)] * 4 + [("hot", 4, -1)] * 5,
        key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.fixture
def plain_shuffles(spark):
    """Small partitions are not merged, and small sides not broadcast, as with large tables."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_task(df):
    """Rows of the fullest partition of a result."""
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_hot_user_ranked_by_other_keys_is_cut_up(spark, plain_shuffles):
    """Many site users share one user id, so all their rows have rank 1: no task gets them all."""
    credits = [("hot" if n % 10 else f"u{n}", 1, f"s{n}", n) for n in range(40_000)]
    wins = [("hot", 1, n) for n in range(50)]
    left = spark.createDataFrame(credits, "uid string, game_id int, site string, credit int")
    right = spark.createDataFrame(wins, "uid string, game_id int, win int")
    got = pair_nth(left, right, ["uid", "game_id"], ["credit"], ["win"], left_rank_keys=["site"], limit=5_000)
    assert largest_task(got) <= 8_000
    assert got.where("rn = 1 AND uid = 'hot' AND win = 0").count() == 36_000
    assert got.where("rn IS NULL").count() == 49 and got.count() == 40_049


def test_fertile_code_is_cut_up(spark, plain_shuffles):
    """300 rows on each side are 90,000 pairs, far below the limit per side."""
    left = spark.createDataFrame([("c", n) for n in range(300)] + [(None, -1), ("l", -2)], "code string, a int")
    right = spark.createDataFrame([("c", n) for n in range(300)] + [(None, -1), ("r", -2)], "code string, b int")
    got = pair_by_key(left, right, "code", limit=10_000)
    assert got.count() == 90_004 and got.where("code = 'c'").distinct().count() == 90_000
    assert largest_task(got) <= 40_000
