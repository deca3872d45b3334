"""The two streams every mart pairs: spin credits and prize wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spinmart.functions.texts import code_map, json_int, json_text
from spinmart.functions.timerules import local_time, settled
from spinmart.operators.latest import latest_per_key
from spinmart.operators.lookups import (
    exclude_ids,
    left_join_derived,
    left_join_present,
)
from spinmart.operators.sizing import broadcast_if_small
from spinmart.operators.staging import stage
from spinmart.sources.readers import read_table

# Status codes of the sources.
PAID = 2
CANCELLED_ORDER = 4
CANCELLED_LINES = (4, 4011, 4012, 4021, 4022)
COUNTED_STATES = (1, 3)
FAILED_STATE = 4
FAILED_PAYMENT = 1
PHONE_SITE = 1060

@dataclass(frozen=True)
class GameSources:
    """The source tables as DataFrames, in the schemas of ``sources.schemas``."""

    orders: DataFrame
    order_lines: DataFrame
    gifts: DataFrame
    provinces: DataFrame
    games: DataFrame
    rewards: DataFrame
    reward_quantities: DataFrame
    wins: DataFrame
    game_codes: DataFrame
    payment_orders: DataFrame
    unidentified_cards: DataFrame
    excluded_wins: DataFrame

    @classmethod
    def from_tables(cls, spark: SparkSession, names: Mapping[str, str]) -> GameSources:
        """Read every source from the catalog table that ``names`` gives for it."""
        return cls(**{source.name: read_table(spark, names[source.name]) for source in fields(cls)})


def spin_credits(src: GameSources, as_of: datetime, sites: Sequence[int], gift_games: dict[int, int],
                 is_test: Column, local_credits: bool = True) -> DataFrame:
    """Spin credits: paid lines of the listed gifts on the listed sites.

    ``is_test`` may use ``app_id``, ``gift_detail_id``, ``game_id`` and ``local_at``.
    """
    orders = src.orders.where(
        F.col("site_id").isin(*sites) & (F.col("status") == PAID) & (F.col("pay_status") == PAID)
        & (F.col("delivery") != CANCELLED_ORDER) & settled(F.col("created"), as_of)
    ).select(
        F.col("id").alias("cart_id"),
        F.when(F.col("site_id") == PHONE_SITE, F.col("phone")).otherwise(F.col("site_user_id")).alias("uid"),
        "site_user_id", "transaction_id", "created", "ncart_id", F.col("site_id").alias("app_id"),
    )
    lines = src.order_lines.where(
        F.col("gift_detail_id").isin(*gift_games) & (F.col("status") == PAID) & (F.col("pay_status") == PAID)
        & ~F.col("delivery").isin(*CANCELLED_LINES)
    ).select(F.col("id").alias("cart_detail_id"), "cart_id", "gift_detail_id")
    gifts = broadcast_if_small(src.gifts.where(F.col("id").isin(*gift_games)).select(
        F.col("id").alias("gift_detail_id"), F.col("title").alias("gift_name")), staged=False)
    return (
        lines.join(gifts, "gift_detail_id").join(orders, "cart_id")
        .withColumn("game_id", code_map(F.col("gift_detail_id"), gift_games).cast("long"))
        .withColumn("local_at", local_time(F.col("created")))
        .select(
            "uid", "game_id", "cart_detail_id", "cart_id", "transaction_id",
            F.col("local_at" if local_credits else "created").alias("credited_at"),
            "ncart_id", "gift_name", "app_id", is_test.alias("credit_is_test"),
            "site_user_id", "gift_detail_id",
        )
    )


def reward_catalog(src: GameSources, game_ids: Sequence[int]) -> DataFrame:
    """Rewards of the games with their configured quantities; several quantities repeat a reward."""
    games = src.games.where(F.col("id").isin(*game_ids)).select(F.col("id").alias("game_id"))
    rewards = src.rewards.select(
        F.col("id").alias("reward_id"), "game_id", "gift_id", F.col("name").alias("gift_label"))
    quantities = src.reward_quantities.select("reward_id", F.col("quantity").alias("configured_qty"))
    return broadcast_if_small(
        games.join(rewards, "game_id", "left").join(quantities, "reward_id", "left"))


def _win_source(won: DataFrame, carry: Sequence[str]) -> DataFrame:
    return won.select(
        F.col("id").alias("win_id"), "customer_id", "reward_id", "transaction_id", "state",
        local_time(F.col("created")).alias("local_at"), *carry)


def _win_row(rows: DataFrame, is_test: Column, carry: Sequence[str]) -> DataFrame:
    return rows.select(
        F.col("customer_id").alias("uid"), "game_id", "reward_id", "gift_id", "gift_label", "gift_value",
        F.col("local_at").alias("rewarded_at"), is_test.alias("is_test"),
        F.col("win_id").alias("customer_rewards_id"), "configured_qty",
        F.col("transaction_id").alias("ref_id"), *carry,
    )


def counted_wins(src: GameSources, as_of: datetime, catalog: DataFrame, is_test: Column,
                 carry: Sequence[str] = (), exclude: bool = True, dedupe: bool = False,
                 excluded: DataFrame | None = None) -> DataFrame:
    """Wins of the catalog's games that count, with the ``carry`` columns of the wins.

    ``excluded`` lists the ids to leave out, by default those of the sources. ``is_test`` may use ``game_id``, ``local_at``, ``customer_id`` and ``state``. A reward with
    several quantities, or several orders under one transaction id, repeat a win; ``dedupe`` keeps
    one row per win.
    """
    won = src.wins.where(F.col("state").isin(*COUNTED_STATES) & settled(F.col("created"), as_of))
    if exclude:
        won = exclude_ids(won, src.excluded_wins if excluded is None else excluded, "id")
    orders = src.orders.select("transaction_id", F.col("money_total").alias("gift_value"))
    rows = _win_source(won, carry).join(catalog, "reward_id")
    out = _win_row(left_join_present(rows, orders, "transaction_id"), is_test, carry)
    return latest_per_key(out, "customer_rewards_id", []) if dedupe else out


def failed_wins(src: GameSources, catalog: DataFrame, is_test: Column,
                carry: Sequence[str] = (), dedupe: bool = False) -> DataFrame:
    """Wins whose request failed and whose payment call failed, one row per distinct card.

    Several cards, payments or quantities repeat a win; ``dedupe`` keeps one row per win.

    Such wins are few beside the payments and cards, so these are cut down by broadcast lists where
    the counts allow it, and only the cards in question are made distinct.
    """
    failed = _win_source(src.wins.where(F.col("state") == FAILED_STATE), carry).join(catalog, "reward_id")
    payments = src.payment_orders.where(F.col("status") == FAILED_PAYMENT).select(
        F.col("id").alias("payment_id"), "transaction_id", F.col("money_total").alias("gift_value"))
    paid = stage(payments.join(broadcast_if_small(failed), "transaction_id"), "paid")
    cards = src.unidentified_cards.select(
        "id", F.col("ncart_id").alias("payment_id"), "campaign_id", "created_at")
    asked = broadcast_if_small(paid.select("payment_id"), staged=False)
    cards = cards.join(asked, "payment_id", "left_semi").distinct().select("payment_id")
    out = _win_row(paid.join(cards, "payment_id"), is_test, carry)
    return latest_per_key(out, "customer_rewards_id", []) if dedupe else out


def with_place(rows: DataFrame, provinces: DataFrame) -> DataFrame:
    """Province, district and dealer of a win, read from its JSON metadata."""
    names = provinces.select("id", F.col("title").alias("province"))
    metadata = F.col("metadata")
    return (
        left_join_derived(rows, json_int(metadata, "$.city_id"), names, "id")
        .withColumn("district", json_text(metadata, "$.store.district"))
        .withColumn("dealer", json_text(metadata, "$.store.name"))
        .drop("metadata")
    )
