"""The five marts that put spin credits and prize wins side by side.

``excluded`` lists the wins that a mart leaves out, by default those of its sources; marts may exclude different
wins. Times are local wall clock. With ``local_credits=False`` the credit time stays as stored. ``dedupe``
keeps one row per win where quantities or orders repeat it. Columns of a missing side are NULL unless
defaults are given. The streams are joins and are read twice (group sizes, then ranks), so they are
staged first.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinmart.functions.texts import code_suffix, contains_word
from spinmart.functions.timerules import CampaignWindow, local_time, window_flag
from spinmart.operators.pairing import pair_by_key, pair_nth
from spinmart.operators.staging import stage
from spinmart.plans.gamestreams import (
    COUNTED_STATES,
    GameSources,
    counted_wins,
    failed_wins,
    reward_catalog,
    spin_credits,
    with_place,
)
from spinmart.sinks.paired import BUCKETS, PairedMart
from spinmart.sources.changes import changed_between

# Sites, gift-to-game tables, games and campaign windows of each mart.
ALL_SITES = (127, 1020, 1060)

GAME_GIFTS = {12728: 20, 12917: 21, 12987: 23, 13821: 24, 14050: 27, 14176: 29}
GAME_IDS = (20, 21, 23, 24, 27, 29)
GAME_CREDIT_WINDOWS = (
    CampaignWindow(0, "2023-11-13 23:59:59", None, {"app_id": 1060}),
    CampaignWindow(0, "2024-01-14 23:59:59", None, {"app_id": 1020, "gift_detail_id": 13821}),
    CampaignWindow(0, "2024-02-06 23:59:59", "2024-02-25 23:59:59", {"app_id": 1020, "gift_detail_id": 14050}),
    CampaignWindow(0, "2024-03-07 23:59:59", "2024-03-21 23:59:59", {"app_id": 1020, "gift_detail_id": 14050}),
    CampaignWindow(0, "2024-03-13 23:59:59", "2024-03-21 23:59:59", {"app_id": 1020, "gift_detail_id": 14176}),
)
GAME_WIN_WINDOWS = (
    CampaignWindow(0, "2023-10-11 06:00:00", None, {"game_id": 20}),
    CampaignWindow(0, "2023-11-01 00:00:00", None, {"game_id": 21}),
    CampaignWindow(0, "2023-11-13 23:59:59", None, {"game_id": 23}),
    CampaignWindow(0, "2024-01-14 23:59:59", None, {"game_id": 24}),
    CampaignWindow(0, "2024-02-25 23:59:59", "2024-03-10 23:59:59", {"game_id": 27}),
    CampaignWindow(0, "2024-03-21 23:59:59", "2024-04-05 23:59:59", {"game_id": 27}),
    CampaignWindow(0, "2024-03-21 23:59:59", "2024-04-05 23:59:59", {"game_id": 29}),
)

FAILED_GIFTS = {12987: 23}
FAILED_SITES = (127, 1060)
FAILED_CREDIT_WINDOWS = (
    CampaignWindow(1, None, "2023-11-13 23:59:59", {"app_id": 1060}),
    CampaignWindow(1, None, None, {"app_id": 127}),
)
FAILED_WIN_WINDOWS = (CampaignWindow(1, None, "2023-11-13 23:59:59", {"game_id": 23}),)

RANKED_CODE_GAME = 25
TEST_CODE_STATE = -2
REDEEMED_CODE_GAME = 30

REGION_GIFTS = {15097: 31}
REGION_CREDIT_WINDOWS = (CampaignWindow(0, "2024-07-03 23:59:59", None),)
REGION_WIN_WINDOWS = (CampaignWindow(0, "2024-07-03 23:59:59", "2024-10-15 23:59:59", {"game_id": 31}),)

GAME_COLUMNS = (
    "uid", "cart_detail_id", "cart_id", "transaction_id", "credited_at", "ncart_id", "gift_name",
    "app_id", "rn", "rewarded_at", "reward_id", "gift_id", "gift_label", "gift_value",
    "customer_rewards_id", "game_id", "is_test", "configured_qty", "ref_id", "credit_is_test",
)
CODE_COLUMNS = (
    "uid", "transaction_id", "credited_at", "rewarded_at", "reward_id", "gift_id", "gift_label",
    "gift_value", "customer_rewards_id", "game_id", "is_test", "configured_qty", "ref_id", "turns",
    "state", "lucky_code",
)
BY_CODE_COLUMNS = (
    "uid", "transaction_id", "code_created_at", "rewarded_at", "reward_id", "gift_id", "gift_label",
    "gift_value", "customer_rewards_id", "game_id", "is_test", "configured_qty", "ref_id", "turns",
    "state", "lucky_code", "province", "district", "dealer",
)


def named_test_or(default: int) -> Column:
    """1 for a customer named as a test, else ``default``."""
    return F.when(contains_word(F.col("customer_id"), "test"), 1).otherwise(default)


def _pair(credit_rows: DataFrame, win_rows: DataFrame, by_site_user: bool = False, **options) -> DataFrame:
    """n-th credit beside n-th win of the same user and game.

    The rank follows the paired user id. ``by_site_user`` ranks credits by the site's own user id
    and gift instead, which can repeat a rank where several of those share a phone. The other
    options go to ``pair_nth``: ``limit``, and ``left_defaults`` and ``right_defaults`` for the
    columns of a missing credit or win.
    """
    rank_keys = ["site_user_id", "gift_detail_id"] if by_site_user else None
    return pair_nth(
        stage(credit_rows, "credits"), stage(win_rows, "wins"), ["uid", "game_id"],
        ["cart_detail_id"], ["customer_rewards_id"], left_rank_keys=rank_keys, **options,
    )


def game_streams(src: GameSources, as_of: datetime, *, dedupe: bool = False, local_credits: bool = True,
                 excluded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Credits and wins of all campaign games. Rows are test rows unless a campaign window holds them."""
    local_at = F.col("local_at")
    credit_rows = spin_credits(src, as_of, ALL_SITES, GAME_GIFTS, window_flag(local_at, GAME_CREDIT_WINDOWS, 1),
                          local_credits)
    win_rows = counted_wins(src, as_of, reward_catalog(src, GAME_IDS),
                            window_flag(local_at, GAME_WIN_WINDOWS, named_test_or(1)),
                            dedupe=dedupe, excluded=excluded)
    return credit_rows, win_rows


def mart_game(src: GameSources, as_of: datetime, *, dedupe: bool = False, local_credits: bool = True,
              excluded: DataFrame | None = None, **pairing) -> DataFrame:
    """All campaign games, computed from all history."""
    streams = game_streams(src, as_of, dedupe=dedupe, local_credits=local_credits, excluded=excluded)
    return _pair(*streams, **pairing).select(*GAME_COLUMNS)


def game_in_increments(src: GameSources, as_of: datetime, root: str, buckets: int = BUCKETS, **options) -> PairedMart:
    """The stored mart of all campaign games, to be filled by ``add_to_game``."""
    credit_rows, win_rows = game_streams(src, as_of, **options)
    return PairedMart(credit_rows.sparkSession, root, credit_rows.schema, win_rows.schema, ["uid", "game_id"],
                      ["cart_detail_id"], ["customer_rewards_id"], buckets)


def add_to_game(mart: PairedMart, src: GameSources, as_of: datetime, lo: datetime, hi: datetime, holes: bool = False,
                **options) -> int:
    """Load the orders and wins created in ``[lo, hi)`` (UTC) that are settled at ``as_of``; the new version.

    An interval is loaded once, so it should be settled whole: no time before ``hi`` may be later than the cutoff of ``as_of``.
    Orders that are paid and rewards that are set up later than that are not seen again, as in any run that appends.
    """
    def created(rows: DataFrame) -> DataFrame:
        return rows.where(changed_between(["created"], "timestamp", lo, hi))

    credit_rows, _ = game_streams(replace(src, orders=created(src.orders)), as_of, **options)
    _, win_rows = game_streams(replace(src, wins=created(src.wins)), as_of, **options)
    return mart.load(credit_rows, win_rows, lo, hi, holes)


def mart_game_failed_included(src: GameSources, as_of: datetime, *, dedupe: bool = False,
                              local_credits: bool = True, excluded: DataFrame | None = None,
                              **pairing) -> DataFrame:
    """One game, wins whose request failed included. A win without a value shows 0."""
    local_at = F.col("local_at")
    catalog = reward_catalog(src, tuple(FAILED_GIFTS.values()))
    win_test = window_flag(local_at, FAILED_WIN_WINDOWS, named_test_or(0))
    credit_rows = spin_credits(src, as_of, FAILED_SITES, FAILED_GIFTS,
                          window_flag(local_at, FAILED_CREDIT_WINDOWS, 0), local_credits)
    win_rows = counted_wins(src, as_of, catalog, win_test, dedupe=dedupe, excluded=excluded).unionByName(
        failed_wins(src, catalog, win_test, dedupe=dedupe))
    paired = _pair(credit_rows, win_rows, **pairing)
    return paired.withColumn("gift_value", F.coalesce("gift_value", F.lit(0))).select(*GAME_COLUMNS)


def mart_game_codes(src: GameSources, as_of: datetime, *, dedupe: bool = False,
                    local_credits: bool = True, excluded: DataFrame | None = None, **pairing) -> DataFrame:
    """One game whose credits are lucky codes; the code's state marks test rows. Excludes no wins unless asked to."""
    created = F.col("created")
    code_rows = src.game_codes.where(F.col("game_id") == RANKED_CODE_GAME).select(
        F.col("customer_id").alias("uid"), "game_id",
        (local_time(created) if local_credits else created).alias("credited_at"),
        "turns", "state", code_suffix(F.col("link")).alias("lucky_code"),
    )
    catalog = reward_catalog(src, (RANKED_CODE_GAME,))
    win_rows = counted_wins(src, as_of, catalog, F.lit(0), exclude=excluded is not None, dedupe=dedupe, excluded=excluded)
    paired = pair_nth(code_rows, stage(win_rows.drop("is_test"), "wins"), ["uid", "game_id"],
                      ["credited_at"], ["customer_rewards_id"], **pairing)
    return (
        paired.withColumn("transaction_id", F.col("ref_id"))
        .withColumn("is_test", F.when(F.col("state") == TEST_CODE_STATE, 1).otherwise(0))
        .select(*CODE_COLUMNS)
    )


def mart_game_by_code(src: GameSources, as_of: datetime, *, dedupe: bool = False, local_credits: bool = True,
                      excluded: DataFrame | None = None, **pairing) -> DataFrame:
    """One game whose wins name the code they redeemed; wins carry the dealer's place. Excludes no wins unless asked to."""
    created = F.col("created")
    code_rows = src.game_codes.where(
        (F.col("game_id") == REDEEMED_CODE_GAME) & F.col("state").isin(*COUNTED_STATES)
    ).select(
        F.col("code").alias("redeemed"), F.col("code").alias("lucky_code"),
        F.col("game_id").alias("code_game_id"),
        (local_time(created) if local_credits else created).alias("code_created_at"), "turns", "state",
    )
    catalog, is_test = reward_catalog(src, (REDEEMED_CODE_GAME,)), F.when(F.col("state") == 1, 1).otherwise(0)
    carry = ("metadata", "code_redeem")
    win_rows = counted_wins(src, as_of, catalog, is_test, carry, excluded is not None, dedupe, excluded).unionByName(
        failed_wins(src, catalog, is_test, carry, dedupe))
    placed = with_place(win_rows, src.provinces).withColumnRenamed("code_redeem", "redeemed")
    paired = pair_by_key(code_rows, stage(placed, "wins"), "redeemed", **pairing)
    return (
        paired.withColumn("game_id", F.coalesce("code_game_id", "game_id"))
        .withColumn("transaction_id", F.col("ref_id"))
        .select(*BY_CODE_COLUMNS)
    )


def mart_game_region(src: GameSources, as_of: datetime, *, dedupe: bool = False,
                     local_credits: bool = True, excluded: DataFrame | None = None, **pairing) -> DataFrame:
    """One game with the region of each win, failed requests included."""
    local_at = F.col("local_at")
    catalog = reward_catalog(src, tuple(REGION_GIFTS.values()))
    win_test = window_flag(local_at, REGION_WIN_WINDOWS, named_test_or(1))
    credit_rows = spin_credits(src, as_of, ALL_SITES, REGION_GIFTS,
                          window_flag(local_at, REGION_CREDIT_WINDOWS, 1), local_credits)
    win_rows = counted_wins(src, as_of, catalog, win_test, ("region",), dedupe=dedupe, excluded=excluded).unionByName(
        failed_wins(src, catalog, win_test, ("region",), dedupe))
    return _pair(credit_rows, win_rows, **pairing).select(*GAME_COLUMNS, "region")
