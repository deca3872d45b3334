"""The marts on hand-made source rows; expected values are written by hand."""

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spinmart.plans import marts
from spinmart.plans.gamestreams import (
    GameSources,
    counted_wins,
    failed_wins,
    reward_catalog,
    spin_credits,
)
from spinmart.sinks.tables import append_to_mart
from spinmart.sources import schemas

AS_OF = datetime(2024, 9, 1, 3, 30)  # rows up to 02:00 UTC count


def when(text):
    return datetime.fromisoformat(text)


def order(number, site=1020, user="u1", phone="p1", created="2024-03-01 00:00:00", tx=None, status=2, pay=2, delivery=1):
    tx = f"o{number}" if tx is None else tx
    return (number, tx, site, user, phone, when(created), 900 + number, status, pay, delivery, Decimal(f"{number}.50"))


def win(number, user="u1", reward=1, tx="", created="2024-03-01 00:00:00", state=1, code=None, metadata=None, region=None):
    return (number, user, reward, tx, when(created), state, code, metadata, region)


TABLES = {
    "orders": schemas.ORDERS, "order_lines": schemas.ORDER_LINES, "gifts": schemas.GIFTS,
    "provinces": schemas.PROVINCES, "games": schemas.GAMES, "rewards": schemas.REWARDS,
    "reward_quantities": schemas.REWARD_QUANTITIES, "wins": schemas.WINS, "game_codes": schemas.GAME_CODES,
    "payment_orders": schemas.PAYMENT_ORDERS, "unidentified_cards": schemas.UNIDENTIFIED_CARDS,
    "excluded_wins": schemas.EXCLUDED_WINS,
}
GIFT_IDS = (11025, 12728, 12917, 12987, 13821, 14050, 14176, 15097)
GAMES = (20, 21, 23, 24, 25, 27, 29, 30, 31)
DEFAULTS = {
    "gifts": [(gift, f"gift {gift}") for gift in GIFT_IDS],
    "games": [(game,) for game in GAMES],
    # Reward n belongs to game n, reward 1 to game 20.
    "rewards": [(1, 20, 701, "one"), *[(game, game, 700 + game, f"reward {game}") for game in GAMES]],
    "reward_quantities": [(1, 50)],
}


def sources(spark, **tables):
    data = {**DEFAULTS, **tables}
    return GameSources(**{name: spark.createDataFrame(data.get(name, []), schema) for name, schema in TABLES.items()})


def line(number, cart, gift=12728, status=2, pay=2, delivery=1):
    return (number, cart, gift, status, pay, delivery)


def test_game_mart_pairs_credits_and_wins(spark):
    src = sources(
        spark,
        orders=[order(1, tx="t1"), order(2), order(3, user="u2"), order(77, tx="w9")],
        order_lines=[line(12, 1), line(11, 1), line(21, 2), line(31, 3, 12917)],
        wins=[win(9, tx="w9", created="2024-03-01 18:30:00"), win(8), win(5, user="u3", reward=21)],
    )
    got = marts.mart_game(src, AS_OF).orderBy("uid", "game_id", F.asc_nulls_last("rn")).collect()
    assert got[0].asDict() == {
        "uid": "u1", "cart_detail_id": 11, "cart_id": 1, "transaction_id": "t1",
        "credited_at": when("2024-03-01 07:00:00"), "ncart_id": 901, "gift_name": "gift 12728", "app_id": 1020,
        "rn": 1, "rewarded_at": when("2024-03-01 07:00:00"), "reward_id": 1, "gift_id": 701, "gift_label": "one",
        "gift_value": None, "customer_rewards_id": 8, "game_id": 20, "is_test": 0, "configured_qty": 50, "ref_id": "",
        "credit_is_test": 1,
    }
    assert (got[1].cart_detail_id, got[1].customer_rewards_id, got[1].gift_value) == (12, 9, Decimal("77.50"))
    assert (got[1].rewarded_at, got[1].ref_id) == (when("2024-03-02 01:30:00"), "w9")
    assert [(r.uid, r.game_id, r.cart_detail_id, r.rn, r.customer_rewards_id) for r in got] == [
        ("u1", 20, 11, 1, 8), ("u1", 20, 12, 2, 9), ("u1", 20, 21, 3, None),
        ("u2", 21, 31, 1, None), ("u3", 21, None, None, 5)]
    assert tuple(got[0].asDict()) == marts.GAME_COLUMNS


def test_stored_credit_times_on_request(spark):
    src = sources(spark, orders=[order(1)], order_lines=[line(11, 1)])
    got = marts.mart_game(src, AS_OF, local_credits=False).collect()
    assert [r.credited_at for r in got] == [when("2024-03-01 00:00:00")]


def test_only_paid_current_lines_of_the_sites_are_credits(spark, rows):
    src = sources(
        spark,
        orders=[
            order(1), order(2, site=1), order(3, status=1), order(4, pay=1), order(5, delivery=4),
            order(6, created="2024-09-01 02:00:00"), order(7, created="2024-09-01 02:00:01"), order(8, site=127)],
        order_lines=[
            *[line(n * 10, n) for n in range(1, 9)], line(11, 1, status=1), line(12, 1, pay=3), line(13, 1, 11025),
            line(14, 1, 15097), *[line(20 + n, 1, delivery=code) for n, code in enumerate((4, 4011, 4012, 4021, 4022))],
            line(30, 1, delivery=5)],
    )
    assert rows(marts.mart_game(src, AS_OF), "cart_detail_id") == [(10,), (30,), (60,), (80,)]


def test_credit_filters_reach_the_scans(spark, tmp_path, plan_of):
    src = sources(spark)
    for name in ("orders", "order_lines"):
        getattr(src, name).write.parquet(str(tmp_path / name))
        src = replace(src, **{name: spark.read.parquet(str(tmp_path / name))})
    plan = plan_of(spin_credits(src, AS_OF, marts.ALL_SITES, marts.GAME_GIFTS, F.lit(0)))
    for pushed in ("In(gift_detail_id, [", "EqualTo(pay_status,2)", "LessThanOrEqual(created,", "In(site_id, ["):
        assert pushed in plan


def test_phone_is_the_user_on_one_site(spark, rows):
    """Two site users share a phone: by default ranks go on over both, as the pairing does."""
    src = sources(
        spark,
        orders=[order(1, site=1060, user="s1", phone="0900"), order(2, site=1060, user="s2", phone="0900")],
        order_lines=[line(11, 1, 12987), line(21, 2, 12987)],
        wins=[win(5, user="0900", reward=23), win(6, user="0900", reward=23)],
    )
    columns = ("uid", "cart_detail_id", "rn", "customer_rewards_id")
    assert rows(marts.mart_game(src, AS_OF), *columns) == [("0900", 11, 1, 5), ("0900", 21, 2, 6)]
    assert rows(marts.mart_game(src, AS_OF, by_site_user=True), *columns) == [
        ("0900", 11, 1, 5), ("0900", 21, 1, 5), ("0900", None, None, 6)]


@pytest.mark.parametrize("site, gift, created, flag", [
    (1060, 12987, "2023-11-13 16:59:59", 1), (1060, 12987, "2023-11-13 17:00:00", 0), (127, 12987, "2024-03-10 00:00:00", 1),
    (1020, 13821, "2024-01-14 16:59:59", 1), (1020, 13821, "2024-01-14 17:00:00", 0),
    (1020, 14050, "2024-02-06 16:59:59", 1), (1020, 14050, "2024-02-25 16:59:59", 0), (1020, 14050, "2024-02-25 17:00:00", 1),
    (1020, 14050, "2024-03-21 16:59:59", 0), (1020, 14050, "2024-03-21 17:00:00", 1),
    (1020, 14176, "2024-03-13 17:00:00", 0), (1020, 14176, "2024-03-13 16:59:59", 1), (1020, 12728, "2024-03-14 00:00:00", 1),
])
def test_credit_windows(spark, site, gift, created, flag):
    src = sources(spark, orders=[order(1, site=site, created=created)], order_lines=[line(11, 1, gift)])
    assert [r.credit_is_test for r in marts.mart_game(src, AS_OF).collect()] == [flag]


def test_win_windows_and_test_names(spark):
    cases = [
        (1, "2023-10-10 23:00:00", 1), (1, "2023-10-10 23:00:01", 0), (21, "2023-10-31 17:00:00", 1),
        (21, "2023-10-31 17:00:01", 0), (27, "2024-03-10 16:59:59", 0), (27, "2024-03-10 17:00:00", 1),
        (27, "2024-04-05 16:59:59", 0), (29, "2024-03-21 16:59:59", 1), (29, "2024-03-21 17:00:00", 0),
    ]
    wins = [win(n, user="TestUser", reward=reward, created=created) for n, (reward, created, _) in enumerate(cases)]
    got = marts.mart_game(sources(spark, wins=wins), AS_OF).orderBy("customer_rewards_id").collect()
    assert [r.is_test for r in got] == [flag for _, _, flag in cases]


def test_wins_that_count(spark, rows):
    wins = [win(1), win(2, state=3), win(3, state=4), win(4, state=2), win(5, created="2024-09-01 02:00:01"),
            win(6, created="2024-09-01 02:00:00"), win(7), win(8, reward=999), win(9, reward=31)]
    src = sources(spark, wins=wins, excluded_wins=[(7,), (None,)])
    assert rows(marts.mart_game(src, AS_OF), "customer_rewards_id") == [(1,), (2,), (6,)]


def test_repeated_quantities_and_orders_repeat_a_win(spark, rows):
    src = sources(
        spark, wins=[win(1, tx="t"), win(2)], reward_quantities=[(1, 50), (1, 60)],
        orders=[order(1, tx="t", site=9), order(2, tx="t", site=9), order(3, tx="", site=9)])
    columns = ("customer_rewards_id", "configured_qty", "gift_value")
    assert rows(marts.mart_game(src, AS_OF), *columns) == [
        (1, 50, Decimal("1.50")), (1, 50, Decimal("2.50")), (1, 60, Decimal("1.50")), (1, 60, Decimal("2.50")),
        (2, 50, None), (2, 60, None)]
    assert rows(marts.mart_game(src, AS_OF, dedupe=True), *columns) == [(1, 60, Decimal("2.50")), (2, 60, None)]


FAILED = dict(
    wins=[
        win(1, user="0900", reward=23, created="2023-11-13 16:59:59"),
        win(2, user="0900", reward=23, tx="f2", state=4, created="2030-01-01 00:00:00"),
        win(3, user="0900", reward=23, tx="f3", state=4), win(4, user="0900", reward=23, tx="f4", state=4),
        win(5, user="my_test", reward=23)],
    payment_orders=[(92, "f2", 1, Decimal("7.00")), (93, "f3", 2, Decimal("8.00")), (94, "f4", 1, None)],
    unidentified_cards=[
        (1, 92, 5, when("2024-01-01 00:00:00")), (1, 92, 5, when("2024-01-01 00:00:00")),
        (2, 92, 5, when("2024-01-01 00:00:00")), (3, 93, 5, when("2024-01-01 00:00:00"))],
    orders=[order(1, site=1060, phone="0900", created="2023-11-13 16:59:59"), order(2, site=127, user="z"),
            order(3, site=1060, phone="0900"), order(4, site=1020, user="z")],
    order_lines=[line(10 * n, n, 12987) for n in (1, 2, 3, 4)],
)


def test_failed_requests_count_once_per_distinct_card(spark, rows):
    src = sources(spark, **FAILED)
    got = marts.mart_game_failed_included(src, AS_OF)
    columns = ("uid", "cart_detail_id", "rn", "customer_rewards_id", "gift_value", "is_test", "credit_is_test")
    assert rows(got, *columns) == [
        ("0900", 10, 1, 1, Decimal("0.00"), 1, 1), ("0900", 30, 2, 2, Decimal("7.00"), 0, 0),
        ("0900", None, None, 2, Decimal("7.00"), 0, None), ("my_test", None, None, 5, Decimal("0.00"), 1, None),
        ("z", 20, 1, None, Decimal("0.00"), None, 1)]
    catalog = reward_catalog(src, (23,))
    assert rows(failed_wins(src, catalog, F.lit(0)), "customer_rewards_id") == [(2,), (2,)]
    assert rows(counted_wins(src, AS_OF, catalog, F.lit(0)), "customer_rewards_id") == [(1,), (5,)]


def code(game, user, created, state=1, link="https://x.example/0123456789", name=None, turns=1):
    return (game, user, when(created), turns, state, link, name)


def test_code_mart_ranks_codes_by_time(spark, rows):
    src = sources(
        spark,
        game_codes=[
            code(25, "a", "2024-01-03 00:00:00", -2, "short"), code(25, "a", "2024-01-02 00:00:00", 1, "x" * 20 + "SUFFIX1234"),
            code(30, "a", "2024-01-01 00:00:00"), code(25, "b", "2024-01-01 00:00:00", link=None)],
        wins=[win(7, user="a", reward=25, tx="t7"), win(8, user="a", reward=25), win(9, user="c", reward=25)],
        excluded_wins=[(7,)])
    got = marts.mart_game_codes(src, AS_OF)
    assert rows(got, "uid", "lucky_code", "customer_rewards_id", "transaction_id", "is_test", "state") == [
        ("a", "SUFFIX1234", 7, "t7", 0, 1), ("a", "short", 8, "", 1, -2),
        ("b", None, None, None, 0, 1), ("c", None, 9, "", 0, None)]
    assert got.columns == list(marts.CODE_COLUMNS)
    assert {r.credited_at for r in got.where("uid = 'b'").collect()} == {when("2024-01-01 07:00:00")}


def test_by_code_mart_reads_the_place(spark, rows):
    place = '{"city_id": "3", "store": {"name": "Dealer", "district": "Q1"}}'
    src = sources(
        spark,
        game_codes=[code(30, "a", "2024-01-01 00:00:00", 1, name="C1"), code(30, "a", "2024-01-01 00:00:00", 3, name="C2"),
                    code(30, "a", "2024-01-01 00:00:00", 2, name="C3"), code(30, "a", "2024-01-01 00:00:00", 1, name=None)],
        wins=[win(1, user="w", reward=30, code="C1", metadata=place), win(2, user="w", reward=30, code="C3", state=3),
              win(3, user="w", reward=30, code=None), win(4, user="w", reward=30, code="C2", state=4, tx="f", metadata="{}")],
        payment_orders=[(9, "f", 1, Decimal("3.00"))], unidentified_cards=[(1, 9, 1, None)],
        provinces=[(3, "Three")])
    got = marts.mart_game_by_code(src, AS_OF)
    assert rows(got, "uid", "lucky_code", "state", "customer_rewards_id", "is_test", "province", "district", "dealer",
                "game_id") == [
        ("w", "C1", 1, 1, 1, "Three", "Q1", "Dealer", 30), ("w", "C2", 3, 4, 0, None, "", "", 30),
        ("w", None, None, 2, 0, None, "", "", 30), ("w", None, None, 3, 1, None, "", "", 30),
        (None, None, 1, None, None, None, None, None, 30)]
    assert got.columns == list(marts.BY_CODE_COLUMNS)


def test_region_mart(spark, rows):
    src = sources(
        spark,
        orders=[order(1, user="a", created="2024-07-03 16:59:59"), order(2, user="a", created="2024-07-03 17:00:00"),
                order(3, user="b")],
        order_lines=[line(10, 1, 15097), line(20, 2, 15097), line(30, 3, 12728)],
        wins=[win(1, user="a", reward=31, created="2024-07-03 17:00:00", region="north"),
              win(2, user="a", reward=31, created="2024-10-15 17:00:00", state=4, tx="f", region="south"),
              win(3, user="a", reward=31, created="2024-07-03 16:59:59")],
        payment_orders=[(9, "f", 1, None)], unidentified_cards=[(1, 9, 1, None)])
    got = marts.mart_game_region(src, AS_OF)
    assert rows(got, "cart_detail_id", "credit_is_test", "customer_rewards_id", "is_test", "region", "gift_value") == [
        (10, 1, 1, 0, "north", None), (20, 0, 2, 1, "south", None), (None, None, 3, 1, None, None)]


def test_marts_do_not_depend_on_the_group_limit(spark, rows):
    """One user holds most rows; sliced ranking gives the same mart."""
    src = sources(
        spark,
        orders=[order(n, user="u1" if n % 3 else "u2", site=1060 if n % 2 else 127, phone="p1") for n in range(1, 61)],
        order_lines=[line(1000 - n, n, 12987) for n in range(1, 61)],
        wins=[win(n, user=("u1", "p1", "u2")[n % 3], reward=23) for n in range(1, 91)],
        game_codes=[code(30, "a", "2024-01-01 00:00:00", name=f"C{n % 4}") for n in range(40)])
    src_codes = replace(src, wins=spark.createDataFrame(
        [win(n, reward=30, code=f"C{n % 6}") for n in range(30)], schemas.WINS))
    for mart, data in ((marts.mart_game, src), (marts.mart_game_failed_included, src),
                       (marts.mart_game_by_code, src_codes)):
        assert rows(mart(data, AS_OF, limit=5)) == rows(mart(data, AS_OF))


def test_defaults_of_a_missing_side(spark, rows):
    src = sources(spark, orders=[order(1), order(2, user="u2")], order_lines=[line(11, 1), line(21, 2)],
                  wins=[win(5, user="u1"), win(6, user="u3")])
    got = marts.mart_game(src, AS_OF, left_defaults={"rn": 0, "cart_id": 0, "gift_name": ""},
                          right_defaults={"customer_rewards_id": 0, "gift_value": 0})
    assert rows(got, "uid", "rn", "cart_id", "gift_name", "customer_rewards_id", "gift_value") == [
        ("u1", 1, 1, "gift 12728", 5, None), ("u2", 1, 2, "gift 12728", 0, 0), ("u3", 0, 0, "", 6, None)]


def test_mart_load_can_be_repeated(spark, rows, tmp_path):
    src = sources(spark, orders=[order(1), order(2)], order_lines=[line(11, 1), line(21, 2)], wins=[win(5)])
    result = marts.mart_game(src, AS_OF)
    columns = ", ".join(f"c{n} {kind}" for n, (_, kind) in enumerate(result.dtypes))
    spark.sql(f"CREATE TABLE mart_reload ({columns}) USING parquet LOCATION '{tmp_path / 'mart'}'")
    try:
        for mode, count in (("append", 2), ("append", 4), ("replace", 2), ("replace", 2)):
            append_to_mart(marts.mart_game(src, AS_OF), "mart_reload", mode)
            assert spark.table("mart_reload").count() == count
        assert rows(spark.table("mart_reload")) == rows(result)
    finally:
        spark.sql("DROP TABLE mart_reload")


def test_sources_from_catalog_tables(spark, rows):
    src = sources(spark, orders=[order(1)], order_lines=[line(11, 1)])
    for name in TABLES:
        getattr(src, name).createOrReplaceTempView(f"shop_{name}")
    named = GameSources.from_tables(spark, {name: f"shop_{name}" for name in TABLES})
    assert rows(marts.mart_game(named, AS_OF), "cart_detail_id") == [(11,)]


def test_each_mart_may_exclude_its_own_wins(spark, rows):
    src = sources(spark, wins=[win(1), win(2), win(3)], excluded_wins=[(1,)])
    own = spark.createDataFrame([(3,)], "id long")
    assert rows(marts.mart_game(src, AS_OF), "customer_rewards_id") == [(2,), (3,)]
    assert rows(marts.mart_game(src, AS_OF, excluded=own), "customer_rewards_id") == [(1,), (2,)]


def test_dedupe_covers_failed_wins(spark, rows):
    src = sources(spark, **FAILED)
    catalog = reward_catalog(src, (23,))
    assert rows(failed_wins(src, catalog, F.lit(0), dedupe=True), "customer_rewards_id") == [(2,)]
    got = marts.mart_game_failed_included(src, AS_OF, dedupe=True)
    assert rows(got.where("customer_rewards_id = 2"), "customer_rewards_id") == [(2,)]


def test_few_jobs_run_while_a_mart_is_planned(spark):
    """Sizes and counts are taken while tables are staged, and plain scans are not staged."""
    src, context = sources(spark, **FAILED), spark.sparkContext
    for build, most in ((marts.mart_game, 24), (marts.mart_game_failed_included, 34)):
        context.setJobGroup(build.__name__, build.__name__)
        build(src, AS_OF)
        assert len(context.statusTracker().getJobIdsForGroup(build.__name__)) <= most
    context.setLocalProperty("spark.jobGroup.id", None)
