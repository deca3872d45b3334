"""The given tables in the shape of the source tables.

Orders and lines stand in for orders and their lines, parts for gifts, events for wins and chat
messages, nations for provinces. Every mapping covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinmart.plans.gamestreams import GameSources

K = "cast(get_json_object(props, '$.k') as int)"
BAND = "CASE WHEN value < 10 THEN 0 WHEN value < 35 THEN 1 WHEN value < 60 THEN 2 WHEN value < 100 THEN 3 ELSE 4 END"
KIND = ("CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3"
        " WHEN 'signup' THEN 4 ELSE 5 END")
REWARD = f"cast(({KIND}) * 10 + ({BAND}) as bigint)"
GAME = """cast(CASE
    WHEN reward_id = 40 THEN 29
    WHEN reward_id % 10 = 2 THEN 25
    WHEN reward_id % 10 = 3 THEN 30
    WHEN reward_id % 10 = 4 THEN 31
    WHEN reward_id < 20 THEN 20
    WHEN reward_id < 30 THEN 21
    WHEN reward_id < 40 THEN 23
    WHEN reward_id < 50 THEN 24
    ELSE 27 END as bigint)"""
GIFT = """cast(CASE
    WHEN p_size > 40 THEN 15097
    WHEN p_size <= 5 THEN 11025
    WHEN p_type = 'ECONOMY' THEN 12728
    WHEN p_type = 'SMALL' THEN 12917
    WHEN p_type = 'LARGE' THEN 12987
    WHEN p_type = 'STANDARD' THEN 13821
    WHEN p_type = 'MEDIUM' THEN 14050
    ELSE 14176 END as bigint)"""
ORDER_TIME = "o_orderdate + make_dt_interval(8470, cast(o_orderkey % 24 as int))"


# Schemas of the given tables; naming them saves a job per read that would look them up.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def orders_src(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderstatus = 'P' THEN '' ELSE concat('T', o_orderkey) END AS transaction_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 127 WHEN '2-HIGH' THEN 1020"
        " WHEN '4-NOT SPECIFIED' THEN 1 ELSE 1060 END AS site_id",
        "cast(o_custkey as string) AS site_user_id",
        "concat('0', o_custkey) AS phone",
        f"{ORDER_TIME} AS created",
        "o_orderkey + 7 AS ncart_id",
        "CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS status",
        "2 AS pay_status",
        "CASE WHEN o_totalprice > 450000 THEN 4 ELSE 1 END AS delivery",
        "o_totalprice AS money_total",
    )


def order_lines_src(spark, folder) -> DataFrame:
    parts = table(spark, folder, "part").selectExpr("p_partkey AS l_partkey", f"{GIFT} AS gift_detail_id")
    return table(spark, folder, "lineitem").join(parts, "l_partkey").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey AS cart_id",
        "gift_detail_id",
        "CASE WHEN l_quantity >= 45 THEN 1 ELSE 2 END AS status",
        "CASE l_linestatus WHEN 'F' THEN 2 ELSE 1 END AS pay_status",
        "CASE l_returnflag WHEN 'R' THEN 4011 ELSE 1 END AS delivery",
    )


def gifts_src(spark, folder) -> DataFrame:
    return table(spark, folder, "part").groupBy(F.expr(GIFT).alias("id")).agg(F.min("p_name").alias("title"))


def provinces_src(spark, folder) -> DataFrame:
    return table(spark, folder, "nation").selectExpr("n_nationkey AS id", "n_name AS title")


def rewards_src(spark, folder) -> DataFrame:
    return (
        table(spark, folder, "events")
        .selectExpr(f"{REWARD} AS reward_id", "event_type").distinct()
        .selectExpr("reward_id AS id", f"{GAME} AS game_id", "reward_id + 1000 AS gift_id",
                    "concat(event_type, ' ', reward_id) AS name")
    )


def games_src(spark, folder) -> DataFrame:
    return rewards_src(spark, folder).selectExpr("game_id AS id").distinct()


def reward_quantities_src(spark, folder) -> DataFrame:
    """One quantity per reward, a second one for clicks, none for errors."""
    events = table(spark, folder, "events").selectExpr(f"{REWARD} AS reward_id", "event_type", "user_id")
    counted = events.where("event_type <> 'error'").groupBy("reward_id").agg(F.count(F.lit(1)).alias("quantity"))
    users = events.where("event_type = 'click'").groupBy("reward_id").agg(F.countDistinct("user_id").alias("quantity"))
    return counted.unionByName(users)


def wins_src(spark, folder) -> DataFrame:
    return table(spark, folder, "events").selectExpr("*", f"{K} AS k", f"{REWARD} AS reward_id").selectExpr(
        "event_id AS id",
        "CASE WHEN k = 7 THEN concat('TEST', user_id) WHEN event_type = 'view' THEN concat('0', user_id)"
        " ELSE cast(user_id as string) END AS customer_id",
        "reward_id",
        "CASE event_type WHEN 'click' THEN '' WHEN 'error' THEN NULL ELSE concat('T', event_id) END AS transaction_id",
        "ts + make_dt_interval(k + CASE WHEN value >= 100 THEN 180 ELSE 0 END) AS created",
        "CASE WHEN k < 70 THEN 1 WHEN k < 85 THEN 3 WHEN k < 95 THEN 4 ELSE 2 END AS state",
        "CASE WHEN event_type = 'view' THEN NULL ELSE concat('C', event_id) END AS code_redeem",
        "CASE event_type WHEN 'view' THEN props WHEN 'click' THEN NULL ELSE concat('{\"city_id\": \"',"
        " CASE WHEN event_type = 'error' THEN 'x' ELSE '' END, k, '\", \"store\": {\"name\": \"D', user_id,"
        " '\", \"district\": \"Q', k, '\"}}') END AS metadata",
        "event_type AS region",
    )


def excluded_wins_src(spark, folder) -> DataFrame:
    return table(spark, folder, "events").where(f"{K} = 50").selectExpr("event_id AS id")


def game_codes_src(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "cast(CASE o_orderstatus WHEN 'F' THEN 25 WHEN 'O' THEN 30 ELSE 24 END as bigint) AS game_id",
        "cast(o_custkey as string) AS customer_id",
        f"{ORDER_TIME} AS created",
        "cast(substr(o_orderpriority, 1, 1) as int) AS turns",
        "CASE o_orderpriority WHEN '1-URGENT' THEN -2 WHEN '2-HIGH' THEN 3 ELSE 1 END AS state",
        "concat('https://x.example/', o_orderkey) AS link",
        "concat('C', o_orderkey) AS code",
    )


def payment_orders_src(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS id",
        "concat('T', o_orderkey) AS transaction_id",
        "CASE WHEN o_orderpriority < '4' THEN 1 ELSE 2 END AS status",
        "o_totalprice AS money_total",
    )


def unidentified_cards_src(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_suppkey AS id", "l_orderkey AS ncart_id", "l_linenumber AS campaign_id", "l_shipdate AS created_at")


def game_sources(spark: SparkSession, folder: str) -> GameSources:
    return GameSources(
        orders=orders_src(spark, folder),
        order_lines=order_lines_src(spark, folder),
        gifts=gifts_src(spark, folder),
        provinces=provinces_src(spark, folder),
        games=games_src(spark, folder),
        rewards=rewards_src(spark, folder),
        reward_quantities=reward_quantities_src(spark, folder),
        wins=wins_src(spark, folder),
        game_codes=game_codes_src(spark, folder),
        payment_orders=payment_orders_src(spark, folder),
        unidentified_cards=unidentified_cards_src(spark, folder),
        excluded_wins=excluded_wins_src(spark, folder),
    )


def chat_messages_src(spark, folder) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "user_id AS conversation_id", "event_type AS content",
        "CASE WHEN value < 100 THEN 'user' ELSE 'assistant' END AS role", "ts AS created_at")


def chat_conversations_src(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS id", "o_custkey AS user_id")


def chat_users_src(spark, folder) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey ELSE c_custkey END AS id",
        "concat(lower(c_name), '@example.com') AS email")


def recipients_src(spark, folder) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "cast(c_nationkey as bigint) AS id",
        "CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment = 'BUILDING' THEN NULL"
        " ELSE concat(lower(c_name), '@example.com') END AS email")


def roles_src(spark, folder) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "cast(n_nationkey as bigint) AS id", "CASE WHEN n_nationkey = 6 THEN NULL ELSE n_regionkey END AS level")


def changed_src(spark, folder) -> DataFrame:
    """Events with change stamps, as times and as epoch seconds; sign-ups were never updated."""
    return (
        table(spark, folder, "events")
        .selectExpr("event_id AS id", "user_id", "value",
                    "CASE WHEN event_type <> 'signup' THEN ts END AS updated_at",
                    f"ts - make_dt_interval({K}) AS created_at")
        .selectExpr("*", *[
            f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {c}_at) AS {c}"
            for c in ("updated", "created")])
    )
