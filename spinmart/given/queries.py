"""One query per operator or job, over the given tables."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.functions.texts import code_suffix, json_int, json_text, matches_any
from spinmart.functions.timerules import hour_lag_cutoff, hour_start, local_time, settled, window_flag
from spinmart.given import tables as given
from spinmart.operators.latest import latest_per_key, upsert_latest
from spinmart.operators.lookups import exclude_ids, flag_by_window_table, left_join_derived, windows_table
from spinmart.operators.pairing import pair_by_key, pair_nth
from spinmart.operators.ranking import rank_within
from spinmart.operators.staging import stage, staging_path
from spinmart.plans import admin_units as crawl
from spinmart.plans import level_outbox as outbox
from spinmart.plans import marts, report
from spinmart.plans.gamestreams import counted_wins, failed_wins, reward_catalog, spin_credits
from spinmart.plans.incremental_load import incremental_load, incremental_load_partitioned, load_all
from spinmart.sinks.paired import PairedMart
from spinmart.sinks.tables import append_to_mart, write_export
from spinmart.sinks.versions import VersionedTable
from spinmart.sources import schemas
from spinmart.sources.changes import LoadConfig, changed_between, extract_changes
from spinmart.sources.pages import html_rows, html_rows_nested
from spinmart.sources.readers import read_sheet, read_table

AS_OF = datetime(2024, 9, 1, 3, 30)
CHAT_AS_OF = datetime(2024, 1, 10, 3, 30)
# The cutoff itself counts, and intervals leave out their end.
MART_CUTS = [datetime(1970, 1, 1), datetime(2023, 6, 1), datetime(2024, 1, 15),
             hour_lag_cutoff(AS_OF) + timedelta(microseconds=1)]
PAIR_CUTS = [datetime(1970, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2100, 1, 1)]
PATTERN = "click|view|sign"
FIRST_DAY, LAST_DAY = date(2024, 1, 5), date(2024, 1, 6)


# Streams and pairing.

def _slice_credits(spark, folder) -> DataFrame:
    """Order lines of three kinds of parts, as credits of three games, staged for the ranking."""
    parts = given.table(spark, folder, "part").where(F.col("p_type").isin("ECONOMY", "SMALL", "LARGE"))
    games = F.expr("CASE p_type WHEN 'ECONOMY' THEN 20 WHEN 'SMALL' THEN 21 ELSE 23 END")
    lines = given.table(spark, folder, "lineitem").where("l_returnflag <> 'R'")
    orders = given.table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    rows = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("uid"), games.alias("game_id"), "l_orderkey", "l_linenumber",
                "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    )
    return stage(rows, "credits")


def _slice_wins(spark, folder) -> DataFrame:
    games = F.expr("CASE event_type WHEN 'purchase' THEN 20 WHEN 'click' THEN 21 ELSE 23 END")
    return given.table(spark, folder, "events").where(
        F.col("event_type").isin("purchase", "click", "view")
    ).select(F.col("user_id").alias("uid"), games.alias("game_id"), "event_id", "ts", "value")


def pair_credits_wins(spark: SparkSession, folder: str) -> DataFrame:
    return pair_nth(
        _slice_credits(spark, folder), _slice_wins(spark, folder), ["uid", "game_id"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"], ["event_id"])


def rank_credits(spark, folder):
    return rank_within(_slice_credits(spark, folder), ["uid", "game_id"],
                       ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


def credits_flagged(spark, folder):
    flag = window_flag(F.col("local_at"), marts.GAME_CREDIT_WINDOWS, 1)
    return spin_credits(given.game_sources(spark, folder), AS_OF, marts.ALL_SITES, marts.GAME_GIFTS, flag)


def wins_window_table(spark, folder):
    wins = given.wins_src(spark, folder).join(
        given.rewards_src(spark, folder).selectExpr("id AS reward_id", "game_id"), "reward_id")
    keys = T.StructType([T.StructField("game_id", T.LongType())])
    windows = windows_table(spark, marts.GAME_WIN_WINDOWS, keys)
    timed = wins.select("id", "game_id", local_time(F.col("created")).alias("rewarded_at"))
    return flag_by_window_table(timed, windows, ["game_id"], "rewarded_at", 1, "is_test")


def credits_window_table(spark, folder):
    """Credits flagged by windows on site and gift, on site alone, and on nothing."""
    credits = _credits(spark, folder)
    keys = T.StructType([T.StructField("app_id", T.IntegerType()), T.StructField("gift_detail_id", T.LongType())])
    windows = windows_table(spark, (*marts.GAME_CREDIT_WINDOWS, *marts.REGION_CREDIT_WINDOWS), keys)
    return flag_by_window_table(credits.select("cart_detail_id", "app_id", "gift_detail_id", "credited_at"), windows,
                                ["app_id", "gift_detail_id"], "credited_at", 1, "is_test")


def _credits(spark, folder) -> DataFrame:
    gifts = {**marts.GAME_GIFTS, **marts.REGION_GIFTS}
    return spin_credits(given.game_sources(spark, folder), AS_OF, marts.ALL_SITES, gifts, F.lit(0))


def _game_wins(spark, folder, **options) -> DataFrame:
    src = given.game_sources(spark, folder)
    flag = window_flag(F.col("local_at"), marts.GAME_WIN_WINDOWS, marts.named_test_or(1))
    return counted_wins(src, AS_OF, reward_catalog(src, marts.GAME_IDS), flag, **options)


def wins_chain(spark, folder):
    return _game_wins(spark, folder)


def wins_chain_deduped(spark, folder):
    return _game_wins(spark, folder, dedupe=True)


def wins_with_failed(spark, folder):
    src = given.game_sources(spark, folder)
    catalog = reward_catalog(src, (23, 31))
    flag = window_flag(F.col("local_at"), marts.FAILED_WIN_WINDOWS, marts.named_test_or(0))
    both = counted_wins(src, AS_OF, catalog, flag, ("region",)).unionByName(
        failed_wins(src, catalog, flag, ("region",)))
    return rank_within(stage(both, "wins"), ["uid", "game_id"], ["customer_rewards_id"])


def pair_codes(spark, folder):
    codes = given.game_codes_src(spark, folder).select(F.col("code").alias("lucky_code"), "turns", "state")
    wins = given.wins_src(spark, folder).select(F.col("code_redeem").alias("lucky_code"), "id", "customer_id")
    return pair_by_key(codes, wins, "lucky_code")


def pair_default_fill(spark, folder):
    orders = given.orders_src(spark, folder).selectExpr(
        "id", "transaction_id", "CASE WHEN site_id <> 127 THEN money_total END AS money_total")
    wins = given.wins_src(spark, folder).select("id", "customer_id", "code_redeem")
    return pair_by_key(orders, wins, "id", left_defaults={"transaction_id": "", "money_total": 0.0},
                       right_defaults={"customer_id": "", "code_redeem": ""})


# Filters, lookups and scalar rules.

def hour_lag_cutoff(spark, folder):
    events = given.table(spark, folder, "events").where(settled(F.col("ts"), CHAT_AS_OF))
    local = local_time(F.col("ts"))
    return events.select("event_id", local.alias("local_ts"), hour_start(local).alias("local_hour"),
                         F.to_date(local).alias("local_day"))


def exclude_listed(spark, folder):
    return exclude_ids(given.table(spark, folder, "events"), given.excluded_wins_src(spark, folder), "event_id")


def exclude_long_list(spark, folder):
    """Events whose id no line's order, part and supplier add up to; the list is taken for one beyond the bound."""
    lines = given.table(spark, folder, "lineitem").selectExpr("l_orderkey + l_partkey + l_suppkey AS id")
    return exclude_ids(given.table(spark, folder, "events"), lines, "event_id", limit=0)


def windows_in_bins(spark, folder):
    """Events flagged by a window for the minute of every seventh event, else one for the afternoon of every third day,
    else by one from the 21st on. No window names the key that the table knows."""
    events = given.table(spark, folder, "events").select("event_id", "event_type", "ts")
    marked = events.where("event_id % 7 = 0").selectExpr("date_trunc('minute', ts) AS lo").distinct()
    minutes = marked.selectExpr(
        "lo", "lo + INTERVAL 40 SECOND AS hi", "minute(lo) AS flag", "datediff(lo, DATE'2000-01-01') * 1440 + hour(lo) * 60 + minute(lo) AS place")
    days = events.selectExpr("date_trunc('day', ts) AS day").distinct().where("dayofmonth(day) % 3 = 0").selectExpr(
        "day + INTERVAL 12 HOUR AS lo", "day + INTERVAL 18 HOUR AS hi", "100 AS flag",
        "100000000 + datediff(day, DATE'2000-01-01') AS place")
    late = spark.range(1).selectExpr("TIMESTAMP_NTZ'2024-01-21 00:00:00' AS lo", "CAST(NULL AS TIMESTAMP_NTZ) AS hi", "200 AS flag",
                                     "200000000 AS place")
    columns = ["CAST(NULL AS STRING) AS _w_event_type", "CAST(lo AS TIMESTAMP_NTZ) AS _lo", "CAST(hi AS TIMESTAMP_NTZ) AS _hi",
               "flag AS _flag", "place AS _place"]
    windows = minutes.union(days).union(late).selectExpr(*columns)
    return flag_by_window_table(events, windows, ["event_type"], "ts", 0, "flag", most=0)


def json_dim_join(spark, folder):
    wins = given.wins_src(spark, folder).select("id", "metadata")
    provinces = given.provinces_src(spark, folder).selectExpr("id AS province_id", "title AS province")
    return (
        left_join_derived(wins, json_int(F.col("metadata"), "$.city_id"), provinces, "province_id")
        .select("id", "province", json_text(F.col("metadata"), "$.store.district").alias("district"),
                json_text(F.col("metadata"), "$.store.name").alias("dealer"))
    )


def url_suffix(spark, folder):
    pages = read_table(spark, f"{folder}/pages.parquet", schemas.PAGES)
    return pages.select("page_id", code_suffix(F.col("url")).alias("suffix"))


# Marts.

def _mart(build, **options):
    return lambda spark, folder: build(given.game_sources(spark, folder), AS_OF, **options)


def mart_game_in_increments(spark, folder):
    """``mart_game`` filled by three loads; ids do not follow the time, so most groups have late rows."""
    src = given.game_sources(spark, folder)
    mart = marts.game_in_increments(src, AS_OF, staging_path(spark, "mart"), buckets=8)
    for lo, hi in zip(MART_CUTS, MART_CUTS[1:]):
        marts.add_to_game(mart, src, AS_OF, lo, hi)
    return mart.read().select(*marts.GAME_COLUMNS)


def pair_in_increments(spark, folder):
    """n-th click beside n-th purchase of each user in order of time, loaded by parts of the month, so no row is late."""
    events = given.table(spark, folder, "events")
    clicks = events.where("event_type = 'click'").selectExpr("user_id AS uid", "event_id AS click_id", "ts AS clicked_at")
    bought = events.where("event_type = 'purchase'").selectExpr(
        "user_id AS uid", "event_id AS purchase_id", "ts AS bought_at", "value")
    mart = PairedMart(spark, staging_path(spark, "mart"), clicks.schema, bought.schema, ["uid"],
                      ["clicked_at"], ["bought_at"], buckets=8)
    for lo, hi in zip(PAIR_CUTS, PAIR_CUTS[1:]):
        mart.load(clicks.where(changed_between(["clicked_at"], "timestamp", lo, hi)),
                  bought.where(changed_between(["bought_at"], "timestamp", lo, hi)), lo, hi)
    return mart.read()


# Report.

def _chat(spark, folder):
    return (given.chat_messages_src(spark, folder), given.chat_conversations_src(spark, folder),
            given.chat_users_src(spark, folder), PATTERN)


def agent_report(spark, folder):
    return report.most_asked_first(report.agent_report(*_chat(spark, folder), FIRST_DAY, LAST_DAY))


def agent_report_half_open(spark, folder):
    return report.agent_report(*_chat(spark, folder), FIRST_DAY, LAST_DAY, half_open=True)


def agent_total(spark, folder):
    return report.report_total(report.agent_report(*_chat(spark, folder), FIRST_DAY, LAST_DAY))


def agent_report_with_total(spark, folder):
    return report.report_with_total(*_chat(spark, folder), FIRST_DAY, LAST_DAY)


def report_backfill(spark, folder):
    return report.report_backfill(*_chat(spark, folder), date(2024, 1, 1), date(2024, 1, 30))


def report_text(spark, folder):
    agents = report.agent_report(*_chat(spark, folder), FIRST_DAY, LAST_DAY)
    return report.report_message(agents, LAST_DAY)


def report_text_in_parts(spark, folder):
    agents = report.agent_report(*_chat(spark, folder), FIRST_DAY, LAST_DAY)
    return report.report_message(agents, LAST_DAY, agents_per_message=50)


def report_line_rows(spark, folder):
    _, lines = report.report_lines(report.agent_report(*_chat(spark, folder), FIRST_DAY, LAST_DAY))
    return lines


def daily_notes(spark, folder):
    days = given.table(spark, folder, "events").select(F.to_date("ts").alias("day")).distinct()
    return report.daily_note(days, "day")


def chat_keyword_report(spark, folder):
    chat = given.table(spark, folder, "conversations")
    return (
        chat.where(matches_any(F.col("text"), "der|que|the "))
        .groupBy("role").agg(F.count(F.lit(1)).alias("n_questions"))
    )


# Loads.

LO, HI = datetime(2024, 1, 10), datetime(2024, 1, 12)


def incremental_extract(spark, folder):
    config = LoadConfig.for_source("postgres", "shop", "events")
    return extract_changes(given.changed_src(spark, folder), config, LO, HI).select("id", "updated_at", "created_at")


def incremental_extract_epoch(spark, folder):
    config = LoadConfig.for_source("mariadb", "shop", "events")
    return extract_changes(given.changed_src(spark, folder), config, LO, HI).select("id", "updated", "created")


def latest_event(spark, folder):
    return latest_per_key(given.table(spark, folder, "events"), "user_id", ["ts", "event_id"])


def upsert_events(spark, folder):
    """Clicks upserted into the latest other event of each user."""
    events = given.table(spark, folder, "events")
    target = stage(latest_per_key(events.where("event_type <> 'click'"), "user_id", ["ts", "event_id"]), "target")
    return upsert_latest(target, events.where("event_type = 'click'"), "user_id", ["ts", "event_id"])


def _load_case(spark, folder) -> tuple[DataFrame, LoadConfig, DataFrame]:
    """Source, config, and a target that lacks new rows of two days and has older values elsewhere."""
    source = given.changed_src(spark, folder).select("id", "user_id", "value", "updated_at", "created_at")
    config = LoadConfig.for_source("postgres", "shop", "events")
    changed = changed_between(config.timestamp_columns, config.timestamp_column_type, LO, HI)
    older = F.col("created_at") < F.col("updated_at")
    target = source.where(older.eqNullSafe(F.lit(True)) | ~F.coalesce(changed, F.lit(False))).withColumn(
        "value", F.when(older, -F.col("value")).otherwise(F.col("value")))
    return source, config, target


def incremental_load_job(spark, folder):
    """Extract, stage and upsert the changes of two days into the target."""
    source, config, target = _load_case(spark, folder)
    path = staging_path(spark, "target")
    target.write.parquet(path)
    return incremental_load(spark, source, config, LO, HI, staging_path(spark, "extract"), path,
                            staging_path(spark, "target"))


def incremental_load_by_day(spark, folder):
    """The same load into a target laid out by creation day."""
    source, config, target = _load_case(spark, folder)
    path, day = staging_path(spark, "target"), F.to_date("created_at")
    laid_out = target.withColumn("created_day", day).hint("rebalance", "created_day")
    laid_out.write.partitionBy("created_day").parquet(path)
    loaded = incremental_load_partitioned(
        spark, source.withColumn("created_day", day), config, LO, HI, staging_path(spark, "extract"), path,
        "created_day")
    return loaded.drop("created_day")


def _versioned(spark, folder) -> VersionedTable:
    """The same target with versions: the later day loaded first, then the gap before it, then both again."""
    source, config, target = _load_case(spark, folder)
    day = F.to_date("created_at")
    table = VersionedTable(spark, staging_path(spark, "versions"), "created_day")
    table.create(target.withColumn("created_day", day), [(LO - timedelta(days=1), LO)])
    source = source.withColumn("created_day", day)
    table.load(source, config, LO + timedelta(days=1), HI, holes=True)
    table.load(source, config, *table.next_interval(HI))
    table.load(source, config, LO, HI)
    return table


def versioned_load(spark, folder):
    """Three loads with a gap and an overlap into a target with versions."""
    return _versioned(spark, folder).read().drop("created_day")


def versioned_history(spark, folder):
    """Rows and sums of two versions by day, read after both were made, and what each has loaded."""
    table, found = _versioned(spark, folder), []
    for version in (2, 4):
        loaded = [f"{lo:%Y-%m-%d}/{hi:%Y-%m-%d}" for lo, hi in table.intervals(version)]
        found.append(table.read(version).groupBy("created_day").agg(
            F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 4).alias("total")).select(
            F.lit(version).alias("version"), F.lit(" ".join(loaded)).alias("loaded"), "created_day", "n_rows", "total"))
    return found[0].unionByName(found[1])


def load_chosen_tables(spark, folder):
    """Two of three tables loaded in one run, one by partial choice, one by what a full load leaves."""
    root, loaded = staging_path(spark, "tables"), []
    sources = {"events": _load_case(spark, folder), "orders": _orders_case(spark, folder)}
    for table, (_, _, target) in sources.items():
        target.write.parquet(f"{root}/{table}/v1")
    for chosen, mode in ((["orders"], "partial"), (["orders", "parts"], "full")):
        tables = load_all(spark, lambda table: sources[table][0], "postgres", "shop", [*sources, "parts"], chosen, mode,
                          LO, HI, staging_path(spark, "extracts"), root, "v1", "v2")
        loaded += [rows.select(F.lit(table).alias("source_table"), "id", "value", "updated_at")
                   for table, rows in tables.items()]
    return loaded[0].unionByName(loaded[1])


def _orders_case(spark, folder) -> tuple[DataFrame, None, DataFrame]:
    """Orders with change stamps, and a target that holds only those not changed in the two days."""
    source = given.orders_src(spark, folder).select(
        "id", F.col("money_total").alias("value"), (F.col("created") - F.expr("INTERVAL 1 HOUR")).alias("created_at"),
        F.when(F.col("id") % 3 != 0, F.col("created")).alias("updated_at"))
    changed = changed_between(("updated_at", "created_at"), "timestamp", LO, HI)
    return source, None, source.where(~F.coalesce(changed, F.lit(False)))


def append_by_position(spark, folder):
    """Two loads, one for each half of the sites, into a mart table whose columns bear other names than the result's."""
    path, name = staging_path(spark, "mart"), f"spinmart_append_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (order_id BIGINT, uid STRING, amount DOUBLE) USING parquet LOCATION '{path}'")
    try:
        orders = given.orders_src(spark, folder)
        first = F.coalesce(F.col("site_id").isin(127, 1060), F.lit(False))
        for half in (first, ~first):
            append_to_mart(orders.where(half).select("id", "site_user_id", "money_total"), name)
        schema = spark.table(name).schema
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


def sheet_export(spark, folder):
    """Recipients exported as a sheet, replaced once, and read back by header."""
    path = staging_path(spark, "sheet")
    people = given.recipients_src(spark, folder)
    write_export(people.select("email"), path)
    write_export(people, path, order=["id", "email"])
    return read_sheet(spark, path, schemas.RECIPIENTS)


# Pages.

def _pages(spark, folder):
    return read_table(spark, f"{folder}/pages.parquet", schemas.PAGES)


def list_rows(spark, folder):
    rows = html_rows(_pages(spark, folder), "ul", "li")
    return rows.select("page_id", F.posexplode("cells").alias("cell", "text"))


def list_rows_nested(spark, folder):
    rows = html_rows_nested(_pages(spark, folder), "ul", "li", table_tag=None)
    return rows.select("page_id", F.posexplode("cells").alias("cell", "text"))


def admin_units(spark, folder):
    return crawl.admin_units(_pages(spark, folder), "ul", "li")


def admin_units_export(spark, folder):
    """The ordered export of the units, read back by header and counted, as some are equal."""
    path = staging_path(spark, "units")
    crawl.export_admin_units(_pages(spark, folder), path, "ul", "li")
    sheet = read_sheet(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in crawl.UNIT_CELLS]))
    return sheet.groupBy(*sheet.columns).agg(F.count(F.lit(1)).alias("n_rows"))


# Messages.

def _people(spark, folder):
    return outbox.recipients_with_level(given.recipients_src(spark, folder), given.roles_src(spark, folder))


def level_outbox(spark, folder):
    return outbox.level_outbox(_people(spark, folder))


def level_outbox_lenient(spark, folder):
    return outbox.level_outbox(_people(spark, folder), strict=False)


def level_outbox_pairs(spark, folder):
    return outbox.level_outbox_all_pairs(_people(spark, folder))


QUERIES = {
    "pair_credits_wins": pair_credits_wins,
    "rank_credits": rank_credits,
    "credits_flagged": credits_flagged,
    "wins_window_table": wins_window_table,
    "credits_window_table": credits_window_table,
    "wins_chain": wins_chain,
    "wins_chain_deduped": wins_chain_deduped,
    "wins_with_failed": wins_with_failed,
    "pair_by_code": pair_codes,
    "pair_default_fill": pair_default_fill,
    "hour_lag_cutoff": hour_lag_cutoff,
    "exclude_ids": exclude_listed,
    "exclude_long_list": exclude_long_list,
    "windows_in_bins": windows_in_bins,
    "json_dim_join": json_dim_join,
    "code_suffix": url_suffix,
    "mart_game": _mart(marts.mart_game),
    "mart_game_in_increments": mart_game_in_increments,
    "pair_in_increments": pair_in_increments,
    "mart_game_by_site_user": _mart(marts.mart_game, by_site_user=True),
    "mart_game_failed_included": _mart(marts.mart_game_failed_included),
    "mart_game_codes": _mart(marts.mart_game_codes),
    "mart_game_by_code": _mart(marts.mart_game_by_code),
    "mart_game_by_code_deduped": _mart(marts.mart_game_by_code, dedupe=True),
    "mart_game_region": _mart(marts.mart_game_region),
    "agent_report": agent_report,
    "agent_report_half_open": agent_report_half_open,
    "agent_total": agent_total,
    "agent_report_with_total": agent_report_with_total,
    "report_backfill": report_backfill,
    "report_text": report_text,
    "report_text_in_parts": report_text_in_parts,
    "report_lines": report_line_rows,
    "daily_note": daily_notes,
    "chat_keyword_report": chat_keyword_report,
    "incremental_extract": incremental_extract,
    "incremental_extract_epoch": incremental_extract_epoch,
    "latest_per_key": latest_event,
    "upsert_latest": upsert_events,
    "incremental_load": incremental_load_job,
    "incremental_load_by_day": incremental_load_by_day,
    "versioned_load": versioned_load,
    "versioned_history": versioned_history,
    "load_chosen_tables": load_chosen_tables,
    "append_by_position": append_by_position,
    "sheet_export": sheet_export,
    "html_rows": list_rows,
    "html_rows_nested": list_rows_nested,
    "admin_units": admin_units,
    "admin_units_export": admin_units_export,
    "level_outbox": level_outbox,
    "level_outbox_lenient": level_outbox_lenient,
    "level_outbox_pairs": level_outbox_pairs,
}
