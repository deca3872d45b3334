"""The check SQL of each query, written for DuckDB over the given tables.

The SQL states the expected rows in its own way: plain windows, CASE chains and full outer joins.
"""

from __future__ import annotations

LOCAL = "INTERVAL 7 HOUR"

SOURCES = {
    "orders_src": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'T' || o_orderkey END AS transaction_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 127 WHEN '2-HIGH' THEN 1020
                    WHEN '4-NOT SPECIFIED' THEN 1 ELSE 1060 END AS site_id,
               CAST(o_custkey AS VARCHAR) AS site_user_id, '0' || o_custkey AS phone,
               o_orderdate + INTERVAL 8470 DAY + to_hours(o_orderkey % 24) AS created,
               o_orderkey + 7 AS ncart_id,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS status, 2 AS pay_status,
               CASE WHEN o_totalprice > 450000 THEN 4 ELSE 1 END AS delivery,
               o_totalprice AS money_total
        FROM orders""",
    "part_gift": """
        SELECT p_partkey, p_name, CAST(CASE WHEN p_size > 40 THEN 15097 WHEN p_size <= 5 THEN 11025
               WHEN p_type = 'ECONOMY' THEN 12728 WHEN p_type = 'SMALL' THEN 12917
               WHEN p_type = 'LARGE' THEN 12987 WHEN p_type = 'STANDARD' THEN 13821
               WHEN p_type = 'MEDIUM' THEN 14050 ELSE 14176 END AS BIGINT) AS gift_detail_id
        FROM part""",
    "lines_src": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS cart_id, gift_detail_id,
               CASE WHEN l_quantity >= 45 THEN 1 ELSE 2 END AS status,
               CASE l_linestatus WHEN 'F' THEN 2 ELSE 1 END AS pay_status,
               CASE l_returnflag WHEN 'R' THEN 4011 ELSE 1 END AS delivery
        FROM lineitem JOIN part_gift ON l_partkey = p_partkey""",
    "gifts_src": "SELECT gift_detail_id AS id, min(p_name) AS title FROM part_gift GROUP BY gift_detail_id",
    "wins_all": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(CASE event_type WHEN 'purchase' THEN 10 WHEN 'click' THEN 20 WHEN 'view' THEN 30
                    WHEN 'signup' THEN 40 ELSE 50 END
                  + CASE WHEN value < 10 THEN 0 WHEN value < 35 THEN 1 WHEN value < 60 THEN 2
                    WHEN value < 100 THEN 3 ELSE 4 END AS BIGINT) AS reward_id
        FROM events""",
    "rewards_src": """
        SELECT DISTINCT reward_id AS id, reward_id + 1000 AS gift_id, event_type || ' ' || reward_id AS name,
               CAST(CASE WHEN reward_id = 40 THEN 29 WHEN reward_id % 10 = 2 THEN 25
                    WHEN reward_id % 10 = 3 THEN 30 WHEN reward_id % 10 = 4 THEN 31
                    WHEN reward_id < 20 THEN 20 WHEN reward_id < 30 THEN 21 WHEN reward_id < 40 THEN 23
                    WHEN reward_id < 50 THEN 24 ELSE 27 END AS BIGINT) AS game_id
        FROM wins_all""",
    "quantities_src": """
        SELECT reward_id, count(*) AS quantity FROM wins_all WHERE event_type <> 'error' GROUP BY 1
        UNION ALL
        SELECT reward_id, count(DISTINCT user_id) FROM wins_all WHERE event_type = 'click' GROUP BY 1""",
    "wins_src": """
        SELECT event_id AS id,
               CASE WHEN k = 7 THEN 'TEST' || user_id WHEN event_type = 'view' THEN '0' || user_id
                    ELSE CAST(user_id AS VARCHAR) END AS customer_id,
               reward_id,
               CASE event_type WHEN 'click' THEN '' WHEN 'error' THEN NULL ELSE 'T' || event_id END AS transaction_id,
               ts + to_days(k + CASE WHEN value >= 100 THEN 180 ELSE 0 END) AS created,
               CASE WHEN k < 70 THEN 1 WHEN k < 85 THEN 3 WHEN k < 95 THEN 4 ELSE 2 END AS state,
               CASE WHEN event_type <> 'view' THEN 'C' || event_id END AS code_redeem,
               CASE WHEN event_type IN ('view', 'click', 'error') THEN NULL ELSE k END AS city_id,
               CASE WHEN event_type IN ('view', 'click') THEN '' ELSE 'D' || user_id END AS dealer,
               CASE WHEN event_type IN ('view', 'click') THEN '' ELSE 'Q' || k END AS district,
               event_type AS region, k
        FROM wins_all""",
    "codes_src": """
        SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 25 WHEN 'O' THEN 30 ELSE 24 END AS BIGINT) AS game_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderdate + INTERVAL 8470 DAY + to_hours(o_orderkey % 24) AS created,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS turns,
               CASE o_orderpriority WHEN '1-URGENT' THEN -2 WHEN '2-HIGH' THEN 3 ELSE 1 END AS state,
               'https://x.example/' || o_orderkey AS link, 'C' || o_orderkey AS code
        FROM orders""",
    "credits": """
        SELECT CASE WHEN o.site_id = 1060 THEN o.phone ELSE o.site_user_id END AS uid,
               CAST(CASE l.gift_detail_id WHEN 12728 THEN 20 WHEN 12917 THEN 21 WHEN 12987 THEN 23
                    WHEN 13821 THEN 24 WHEN 14050 THEN 27 WHEN 14176 THEN 29 WHEN 15097 THEN 31 END AS BIGINT) AS game_id,
               l.id AS cart_detail_id, o.id AS cart_id, o.transaction_id,
               o.created + INTERVAL 7 HOUR AS credited_at, o.ncart_id, g.title AS gift_name,
               o.site_id AS app_id, o.site_user_id, l.gift_detail_id
        FROM orders_src o JOIN lines_src l ON l.cart_id = o.id JOIN gifts_src g ON g.id = l.gift_detail_id
        WHERE o.status = 2 AND o.pay_status = 2 AND o.delivery <> 4 AND l.status = 2 AND l.pay_status = 2
          AND l.delivery NOT IN (4, 4011, 4012, 4021, 4022) AND o.site_id IN (127, 1020, 1060)
          AND l.gift_detail_id <> 11025
          AND o.created + INTERVAL 7 HOUR <= TIMESTAMP '2024-09-01 09:00:00'""",
    # Campaign windows as (site, gift or NULL for any, after, until), (game, after, until).
    "credit_windows": """
        SELECT * FROM (VALUES
            (1060, NULL, TIMESTAMP '2023-11-13 23:59:59', TIMESTAMP '9999-01-01'),
            (1020, 13821, TIMESTAMP '2024-01-14 23:59:59', TIMESTAMP '9999-01-01'),
            (1020, 14050, TIMESTAMP '2024-02-06 23:59:59', TIMESTAMP '2024-02-25 23:59:59'),
            (1020, 14050, TIMESTAMP '2024-03-07 23:59:59', TIMESTAMP '2024-03-21 23:59:59'),
            (1020, 14176, TIMESTAMP '2024-03-13 23:59:59', TIMESTAMP '2024-03-21 23:59:59')
        ) AS v(site, gift, after, until)""",
    "win_windows": """
        SELECT * FROM (VALUES
            (20, TIMESTAMP '2023-10-11 06:00:00', TIMESTAMP '9999-01-01'),
            (21, TIMESTAMP '2023-11-01 00:00:00', TIMESTAMP '9999-01-01'),
            (23, TIMESTAMP '2023-11-13 23:59:59', TIMESTAMP '9999-01-01'),
            (24, TIMESTAMP '2024-01-14 23:59:59', TIMESTAMP '9999-01-01'),
            (27, TIMESTAMP '2024-02-25 23:59:59', TIMESTAMP '2024-03-10 23:59:59'),
            (27, TIMESTAMP '2024-03-21 23:59:59', TIMESTAMP '2024-04-05 23:59:59'),
            (29, TIMESTAMP '2024-03-21 23:59:59', TIMESTAMP '2024-04-05 23:59:59')
        ) AS v(game, after, until)""",
    "game_credits": """
        SELECT *, CAST(NOT EXISTS (
            SELECT 1 FROM credit_windows WHERE site = app_id AND coalesce(gift, gift_detail_id) = gift_detail_id
               AND credited_at > after AND credited_at <= until) AS INTEGER) AS credit_is_test
        FROM credits WHERE gift_detail_id <> 15097""",
    "wins": """
        SELECT w.customer_id AS uid, r.game_id, r.id AS reward_id, r.gift_id, r.name AS gift_label,
               o.money_total AS gift_value, w.created + INTERVAL 7 HOUR AS rewarded_at, w.id AS customer_rewards_id,
               q.quantity AS configured_qty, w.transaction_id AS ref_id, w.state AS win_state, w.region,
               w.code_redeem, w.city_id, w.district, w.dealer, w.k
        FROM rewards_src r LEFT JOIN quantities_src q ON q.reward_id = r.id JOIN wins_src w ON w.reward_id = r.id
        LEFT JOIN orders_src o ON o.transaction_id = w.transaction_id AND o.transaction_id <> ''
        WHERE w.state IN (1, 3) AND w.created + INTERVAL 7 HOUR <= TIMESTAMP '2024-09-01 09:00:00'""",
    "failed": """
        SELECT w.customer_id AS uid, r.game_id, w.reward_id, r.gift_id, r.name AS gift_label,
               o.o_totalprice AS gift_value, w.created + INTERVAL 7 HOUR AS rewarded_at, w.id AS customer_rewards_id,
               q.quantity AS configured_qty, w.transaction_id AS ref_id, w.state AS win_state, w.region,
               w.code_redeem, w.city_id, w.district, w.dealer, w.k
        FROM rewards_src r LEFT JOIN quantities_src q ON q.reward_id = r.id JOIN wins_src w ON w.reward_id = r.id
        JOIN orders o ON 'T' || o.o_orderkey = w.transaction_id
        JOIN (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM lineitem) c
          ON c.l_orderkey = o.o_orderkey
        WHERE w.state = 4 AND o.o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "game_wins": """
        SELECT *, CAST(NOT EXISTS (
            SELECT 1 FROM win_windows WHERE game = game_id AND rewarded_at > after AND rewarded_at <= until
            ) AS INTEGER) AS is_test
        FROM wins WHERE game_id IN (20, 21, 23, 24, 27, 29) AND k <> 50""",
    "failed_flag_wins": """
        SELECT *, CASE WHEN game_id = 23 AND rewarded_at <= TIMESTAMP '2023-11-13 23:59:59' THEN 1
               WHEN lower(uid) LIKE '%test%' THEN 1 ELSE 0 END AS is_test
        FROM (SELECT * FROM wins WHERE k <> 50 UNION ALL SELECT * FROM failed)
        WHERE game_id IN (23, 31)""",
    "region_wins": """
        SELECT *, CASE WHEN rewarded_at <= TIMESTAMP '2024-10-15 23:59:59'
               AND rewarded_at > TIMESTAMP '2024-07-03 23:59:59' THEN 0 ELSE 1 END AS is_test
        FROM (SELECT * FROM wins WHERE k <> 50 UNION ALL SELECT * FROM failed)
        WHERE game_id = 31""",
    "messages": """
        SELECT user_id AS conversation_id, event_type AS content, ts AS created_at,
               CASE WHEN value < 100 THEN 'user' ELSE 'assistant' END AS role FROM events""",
    "chat_users": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS conversation_id,
               lower(c_name) || '@example.com' AS email
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment <> 'BUILDING'""",
    "asked": """
        SELECT m.created_at, u.email FROM messages m LEFT JOIN chat_users u ON u.conversation_id = m.conversation_id
        WHERE m.role = 'user' AND regexp_matches(lower(m.content), 'click|view|sign')""",
    "agents": """
        SELECT email, count(*) AS n_questions FROM asked
        WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' GROUP BY email""",
    "changed": """
        SELECT event_id AS id, user_id, value, CASE WHEN event_type <> 'signup' THEN ts END AS updated_at,
               ts - to_days(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS created_at
        FROM events""",
    "items": """
        SELECT page_id, l.pos - 1 AS pos, regexp_extract_all(l.item, '<li[^>]*>(.*?)</li>', 1) AS cells
        FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<ul[^>]*>(.*?)</ul>', 1)) AS item,
                     generate_subscripts(regexp_extract_all(html, '(?s)<ul[^>]*>(.*?)</ul>', 1), 1) AS pos
              FROM pages) l""",
    "people": """
        SELECT CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment = 'BUILDING' THEN NULL
                    ELSE lower(c_name) || '@example.com' END AS email,
               CASE WHEN n_nationkey <> 6 THEN n_regionkey END AS level
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
}
# Each source with the ones it reads, in order.
NEEDS = {
    "lines_src": ["part_gift"], "gifts_src": ["part_gift"], "rewards_src": ["wins_all"],
    "quantities_src": ["wins_all"], "wins_src": ["wins_all"],
    "credits": ["orders_src", "lines_src", "gifts_src"], "game_credits": ["credits", "credit_windows"],
    "wins": ["rewards_src", "quantities_src", "wins_src", "orders_src"],
    "failed": ["rewards_src", "quantities_src", "wins_src"],
    "game_wins": ["wins", "win_windows"], "failed_flag_wins": ["wins", "failed"], "region_wins": ["wins", "failed"],
    "asked": ["messages", "chat_users"], "agents": ["asked"],
}


def _with(query: str, *sources: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for source in sources:
        add(source)
    ctes = ",\n".join(f"{name} AS ({SOURCES[name]})" for name in ordered)
    return f"WITH {ctes}\n{query}"


def _nulls_last(columns: str) -> str:
    return ", ".join(f"{c.strip()} NULLS LAST" for c in columns.split(","))


WIN_COLUMNS = ("uid, game_id, reward_id, gift_id, gift_label, gift_value, rewarded_at, is_test, customer_rewards_id,"
               " configured_qty, ref_id")
WIN_ORDER = _nulls_last("customer_rewards_id, reward_id, gift_id, gift_label, gift_value, rewarded_at, is_test,"
                        " configured_qty, ref_id")
ONE_PER_WIN = """QUALIFY row_number() OVER (PARTITION BY customer_rewards_id
                          ORDER BY gift_value DESC NULLS LAST, configured_qty DESC NULLS LAST) = 1"""
CREDIT_ORDER = _nulls_last("cart_detail_id, cart_id, transaction_id, credited_at, ncart_id, gift_name, app_id,"
                           " credit_is_test, site_user_id, gift_detail_id")
CREDIT_COLUMNS = ("uid, game_id, cart_detail_id, cart_id, transaction_id, credited_at, ncart_id, gift_name, app_id,"
                  " credit_is_test, site_user_id, gift_detail_id")


def _mart(credit_rows: str, win_rows: str, sources: tuple[str, ...], rank_by: str = "uid, game_id",
          gift_value: str = "w.gift_value", extra: str = "") -> str:
    return _with(f"""
    SELECT coalesce(c.uid, w.uid) AS uid, c.cart_detail_id, c.cart_id, c.transaction_id, c.credited_at, c.ncart_id,
           c.gift_name, c.app_id, c.rn, w.rewarded_at, w.reward_id, w.gift_id, w.gift_label,
           {gift_value} AS gift_value, w.customer_rewards_id, coalesce(c.game_id, w.game_id) AS game_id,
           w.is_test, w.configured_qty, w.ref_id, c.credit_is_test{extra}
    FROM (SELECT *, row_number() OVER (PARTITION BY {rank_by} ORDER BY {CREDIT_ORDER}) AS rn FROM ({credit_rows})) c
    FULL OUTER JOIN (SELECT *, row_number() OVER (PARTITION BY uid, game_id ORDER BY {WIN_ORDER}) AS rn
                     FROM ({win_rows})) w
      ON c.uid = w.uid AND c.game_id = w.game_id AND c.rn = w.rn""", *sources)


SLICE = """
    credits AS (
        SELECT o_custkey AS uid, CASE p_type WHEN 'ECONOMY' THEN 20 WHEN 'SMALL' THEN 21 ELSE 23 END AS game_id,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
        WHERE p_type IN ('ECONOMY', 'SMALL', 'LARGE') AND l_returnflag <> 'R' AND o_orderstatus <> 'P'),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY uid, game_id ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_quantity, l_extendedprice) AS rn
        FROM credits)"""

CHECK_SQL = {
    "pair_credits_wins": f"""
        WITH {SLICE},
        wins AS (
            SELECT user_id AS uid, CASE event_type WHEN 'purchase' THEN 20 WHEN 'click' THEN 21 ELSE 23 END AS game_id,
                   event_id, ts, value
            FROM events WHERE event_type IN ('purchase', 'click', 'view')),
        ranked_wins AS (SELECT *, row_number() OVER (PARTITION BY uid, game_id ORDER BY event_id) AS rn FROM wins)
        SELECT coalesce(c.uid, w.uid) AS uid, coalesce(c.game_id, w.game_id) AS game_id, l_orderkey, l_linenumber,
               l_partkey, l_suppkey, l_quantity, l_extendedprice, c.rn, event_id, ts, value
        FROM ranked c FULL OUTER JOIN ranked_wins w ON c.uid = w.uid AND c.game_id = w.game_id AND c.rn = w.rn""",
    "pair_in_increments": """
        WITH clicks AS (
            SELECT user_id AS uid, event_id AS click_id, ts AS clicked_at,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
            FROM events WHERE event_type = 'click'),
        bought AS (
            SELECT user_id AS uid, event_id AS purchase_id, ts AS bought_at, value,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth
            FROM events WHERE event_type = 'purchase')
        SELECT coalesce(c.uid, b.uid) AS uid, click_id, clicked_at, rn, purchase_id, bought_at, value
        FROM clicks c FULL OUTER JOIN bought b ON c.uid = b.uid AND rn = nth""",
    "rank_credits": f"WITH {SLICE} SELECT * FROM ranked",
    "credits_flagged": _with(f"SELECT {CREDIT_COLUMNS} FROM game_credits", "game_credits"),
    "wins_window_table": _with("""
        SELECT w.id, r.game_id, w.created + INTERVAL 7 HOUR AS rewarded_at, CAST(NOT EXISTS (
               SELECT 1 FROM win_windows WHERE game = game_id AND w.created + INTERVAL 7 HOUR > after
               AND w.created + INTERVAL 7 HOUR <= until) AS INTEGER) AS is_test
        FROM wins_src w JOIN rewards_src r ON r.id = w.reward_id""", "wins_src", "rewards_src", "win_windows"),
    "credits_window_table": _with("""
        SELECT cart_detail_id, app_id, gift_detail_id, credited_at, CAST(NOT EXISTS (
               SELECT 1 FROM (SELECT * FROM credit_windows
                              UNION ALL SELECT NULL, NULL, TIMESTAMP '2024-07-03 23:59:59', TIMESTAMP '9999-01-01')
               WHERE coalesce(site, app_id) = app_id AND coalesce(gift, gift_detail_id) = gift_detail_id
               AND credited_at > after AND credited_at <= until) AS INTEGER) AS is_test
        FROM credits""", "credits", "credit_windows"),
    "wins_chain": _with(f"SELECT {WIN_COLUMNS} FROM game_wins", "game_wins"),
    "wins_chain_deduped": _with(f"""
        SELECT {WIN_COLUMNS} FROM game_wins
        QUALIFY row_number() OVER (PARTITION BY customer_rewards_id ORDER BY
            {", ".join(f"{c.strip()} DESC NULLS LAST" for c in WIN_COLUMNS.split(",") if "customer" not in c)}) = 1""",
        "game_wins"),
    "wins_with_failed": _with(f"""
        SELECT {WIN_COLUMNS}, region, row_number() OVER (PARTITION BY uid, game_id ORDER BY {WIN_ORDER}) AS rn
        FROM failed_flag_wins""", "failed_flag_wins"),
    "pair_by_code": _with("""
        SELECT coalesce(c.code, w.code_redeem) AS lucky_code, c.turns, c.state, w.id, w.customer_id
        FROM codes_src c FULL OUTER JOIN wins_src w ON c.code = w.code_redeem""", "codes_src", "wins_src"),
    "pair_default_fill": _with("""
        SELECT coalesce(o.id, w.id) AS id,
               CASE WHEN o.id IS NULL THEN '' ELSE o.transaction_id END AS transaction_id,
               CASE WHEN o.id IS NULL THEN 0 WHEN o.site_id <> 127 THEN o.money_total END AS money_total,
               CASE WHEN w.id IS NULL THEN '' ELSE w.customer_id END AS customer_id,
               CASE WHEN w.id IS NULL THEN '' ELSE w.code_redeem END AS code_redeem
        FROM orders_src o FULL OUTER JOIN wins_src w ON o.id = w.id""", "orders_src", "wins_src"),
    "hour_lag_cutoff": f"""
        SELECT event_id, ts + {LOCAL} AS local_ts, date_trunc('hour', ts + {LOCAL}) AS local_hour, CAST(ts + {LOCAL} AS DATE) AS local_day
        FROM events WHERE ts + {LOCAL} <= date_trunc('hour', TIMESTAMP '2024-01-10 03:30:00' + {LOCAL}) - INTERVAL 1 HOUR""",
    "exclude_ids": "SELECT * FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) <> 50",
    "exclude_long_list": """
        SELECT * FROM events
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey + l_partkey + l_suppkey = event_id)""",
    "windows_in_bins": """
        SELECT event_id, event_type, ts, CASE
            WHEN ts > date_trunc('minute', ts) AND ts <= date_trunc('minute', ts) + INTERVAL 40 SECOND
                 AND date_trunc('minute', ts) IN (SELECT date_trunc('minute', ts) FROM events WHERE event_id % 7 = 0)
            THEN CAST(minute(ts) AS INTEGER)
            WHEN day(ts) % 3 = 0 AND ts > date_trunc('day', ts) + INTERVAL 12 HOUR
                 AND ts <= date_trunc('day', ts) + INTERVAL 18 HOUR THEN 100
            WHEN ts > TIMESTAMP '2024-01-21 00:00:00' THEN 200 ELSE 0 END AS flag
        FROM events""",
    "json_dim_join": _with("""
        SELECT w.id, n_name AS province, w.district, w.dealer
        FROM wins_src w LEFT JOIN nation ON n_nationkey = w.city_id""", "wins_src"),
    "code_suffix": "SELECT page_id, right(url, 10) AS suffix FROM pages",
    "mart_game": _mart("SELECT * FROM game_credits", "SELECT * FROM game_wins", ("game_credits", "game_wins")),
    "mart_game_by_site_user": _mart("SELECT * FROM game_credits", "SELECT * FROM game_wins",
                                    ("game_credits", "game_wins"), rank_by="site_user_id, gift_detail_id"),
    "mart_game_failed_included": _mart(
        """SELECT *, CASE WHEN app_id = 1060 AND credited_at <= TIMESTAMP '2023-11-13 23:59:59' THEN 1
                  WHEN app_id = 127 THEN 1 ELSE 0 END AS credit_is_test
           FROM credits WHERE gift_detail_id = 12987 AND app_id <> 1020""",
        "SELECT * FROM failed_flag_wins WHERE game_id = 23", ("credits", "failed_flag_wins"),
        gift_value="coalesce(w.gift_value, 0)"),
    "mart_game_region": _mart(
        """SELECT *, CASE WHEN credited_at > TIMESTAMP '2024-07-03 23:59:59' THEN 0 ELSE 1 END AS credit_is_test
           FROM credits WHERE gift_detail_id = 15097""",
        "SELECT * FROM region_wins", ("credits", "region_wins"), extra=", w.region"),
    "mart_game_codes": _with(f"""
        SELECT coalesce(c.uid, w.uid) AS uid, w.ref_id AS transaction_id, c.credited_at, w.rewarded_at, w.reward_id,
               w.gift_id, w.gift_label, w.gift_value, w.customer_rewards_id, coalesce(c.game_id, w.game_id) AS game_id,
               CASE WHEN c.state = -2 THEN 1 ELSE 0 END AS is_test, w.configured_qty, w.ref_id, c.turns, c.state,
               c.lucky_code
        FROM (SELECT customer_id AS uid, game_id, created + {LOCAL} AS credited_at, turns, state,
                     right(link, 10) AS lucky_code,
                     row_number() OVER (PARTITION BY customer_id ORDER BY created, turns, state, right(link, 10)) AS rn
              FROM codes_src WHERE game_id = 25) c
        FULL OUTER JOIN (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY
                {WIN_ORDER.replace(" is_test NULLS LAST,", "")}) AS rn FROM wins WHERE game_id = 25) w
          ON c.uid = w.uid AND c.rn = w.rn""", "codes_src", "wins"),
    "mart_game_by_code": _with(f"""
        SELECT w.uid, w.ref_id AS transaction_id, c.created + {LOCAL} AS code_created_at, w.rewarded_at, w.reward_id,
               w.gift_id, w.gift_label, w.gift_value, w.customer_rewards_id, coalesce(c.game_id, w.game_id) AS game_id,
               CASE WHEN w.win_state = 1 THEN 1 WHEN w.win_state IS NOT NULL THEN 0 END AS is_test, w.configured_qty,
               w.ref_id, c.turns, c.state, c.code AS lucky_code, w.province, w.district, w.dealer
        FROM (SELECT * FROM codes_src WHERE game_id = 30 AND state IN (1, 3)) c
        FULL OUTER JOIN (SELECT b.*, n_name AS province
                         FROM (SELECT * FROM wins UNION ALL SELECT * FROM failed) b
                         LEFT JOIN nation ON n_nationkey = b.city_id WHERE game_id = 30) w
          ON c.code = w.code_redeem""", "codes_src", "wins", "failed"),
    "mart_game_by_code_deduped": _with(f"""
        SELECT w.uid, w.ref_id AS transaction_id, c.created + {LOCAL} AS code_created_at, w.rewarded_at, w.reward_id,
               w.gift_id, w.gift_label, w.gift_value, w.customer_rewards_id, coalesce(c.game_id, w.game_id) AS game_id,
               CASE WHEN w.win_state = 1 THEN 1 WHEN w.win_state IS NOT NULL THEN 0 END AS is_test, w.configured_qty,
               w.ref_id, c.turns, c.state, c.code AS lucky_code, w.province, w.district, w.dealer
        FROM (SELECT * FROM codes_src WHERE game_id = 30 AND state IN (1, 3)) c
        FULL OUTER JOIN (SELECT b.*, n_name AS province
                         FROM (FROM (SELECT * FROM wins {ONE_PER_WIN}) UNION ALL FROM (SELECT * FROM failed {ONE_PER_WIN})) b
                         LEFT JOIN nation ON n_nationkey = b.city_id WHERE game_id = 30) w
          ON c.code = w.code_redeem""", "codes_src", "wins", "failed"),
    "agent_report": _with("SELECT * FROM agents", "agents"),
    "agent_report_half_open": _with(
        "SELECT email, count(*) AS n_questions FROM asked WHERE CAST(created_at AS DATE) = DATE '2024-01-05' GROUP BY 1",
        "asked"),
    "agent_total": _with("SELECT CAST(sum(n_questions) AS BIGINT) AS n_questions FROM agents", "agents"),
    "agent_report_with_total": _with("""
        SELECT email, n_questions, 0 AS is_total FROM agents
        UNION ALL SELECT NULL, CAST(sum(n_questions) AS BIGINT), 1 FROM agents""", "agents"),
    "report_backfill": _with("""
        SELECT CAST(run.d AS DATE) AS run_date, email, count(*) AS n_questions
        FROM asked JOIN (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS d) run
          ON CAST(created_at AS DATE) BETWEEN CAST(run.d AS DATE) AND CAST(run.d + INTERVAL 1 DAY AS DATE)
        GROUP BY 1, 2""", "asked"),
    "report_text": _with("""
        SELECT CAST(0 AS BIGINT) AS part,
               '<b>Dear team CSKH,</b>' || chr(10) || repeat(' ', 16) || chr(10)
               || 'Data gửi thông tin số lượng check bot ngày 2024-01-06: <b>' || any_value(total) || '</b>' || chr(10)
               || repeat(' ', 16) || chr(10) || '<pre>'
               || lpad('email_agent', any_value(w1), ' ') || ' ' || lpad('so_luot_hoi_bot', any_value(w2), ' ') || chr(10)
               || string_agg(lpad(name, w1, ' ') || ' ' || lpad(CAST(n_questions AS VARCHAR), w2, ' '), chr(10) ORDER BY pos)
               || '</pre>' AS body
        FROM (SELECT *, coalesce(email, 'None') AS name, CAST(sum(n_questions) OVER () AS BIGINT) AS total,
                     row_number() OVER (ORDER BY n_questions DESC, email NULLS LAST) AS pos,
                     CAST(greatest(11, max(length(coalesce(email, 'None'))) OVER ()) AS INTEGER) AS w1,
                     CAST(greatest(16, max(length(CAST(n_questions AS VARCHAR))) OVER ()) AS INTEGER) AS w2
              FROM agents)
        GROUP BY 1""", "agents"),
    "report_text_in_parts": _with("""
        SELECT CAST((pos - 1) // 50 AS BIGINT) AS part,
               '<b>Dear team CSKH,</b>' || chr(10) || repeat(' ', 16) || chr(10)
               || 'Data gửi thông tin số lượng check bot ngày 2024-01-06: <b>' || any_value(total) || '</b>' || chr(10)
               || repeat(' ', 16) || chr(10) || '<pre>'
               || lpad('email_agent', any_value(w1), ' ') || ' ' || lpad('so_luot_hoi_bot', any_value(w2), ' ') || chr(10)
               || string_agg(lpad(name, w1, ' ') || ' ' || lpad(CAST(n_questions AS VARCHAR), w2, ' '), chr(10) ORDER BY pos)
               || '</pre>' AS body
        FROM (SELECT *, coalesce(email, 'None') AS name, CAST(sum(n_questions) OVER () AS BIGINT) AS total,
                     row_number() OVER (ORDER BY n_questions DESC, email NULLS LAST) AS pos,
                     CAST(greatest(11, max(length(coalesce(email, 'None'))) OVER ()) AS INTEGER) AS w1,
                     CAST(greatest(16, max(length(CAST(n_questions AS VARCHAR))) OVER ()) AS INTEGER) AS w2
              FROM agents)
        GROUP BY 1""", "agents"),
    "report_lines": _with("""
        SELECT pos, lpad(name, w1, ' ') || ' ' || lpad(CAST(n_questions AS VARCHAR), w2, ' ') AS line
        FROM (SELECT *, coalesce(email, 'None') AS name, row_number() OVER (ORDER BY n_questions DESC, email NULLS LAST) AS pos,
                     CAST(greatest(11, max(length(coalesce(email, 'None'))) OVER ()) AS INTEGER) AS w1,
                     CAST(greatest(16, max(length(CAST(n_questions AS VARCHAR))) OVER ()) AS INTEGER) AS w2
              FROM agents)""", "agents"),
    "daily_note": """
        SELECT day, '<b>Dear team CSKH,</b>' || chr(10) || repeat(' ', 16) || chr(10)
               || 'Data gửi thông tin số lượng check bot ngày ' || strftime(day, '%d/%m/%Y') || chr(10)
               || repeat(' ', 16) || chr(10) || '<b>xincamon!</b>' AS body
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""",
    "chat_keyword_report": """
        SELECT role, count(*) AS n_questions FROM conversations
        WHERE regexp_matches(lower(text), 'der|que|the ') GROUP BY role""",
    "incremental_extract": _with("""
        SELECT id, updated_at, created_at FROM changed
        WHERE (updated_at >= TIMESTAMP '2024-01-10' AND updated_at < TIMESTAMP '2024-01-12')
           OR (created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-12')""", "changed"),
    "incremental_extract_epoch": _with("""
        SELECT id, CAST(floor(epoch(updated_at)) AS BIGINT) AS updated, CAST(floor(epoch(created_at)) AS BIGINT) AS created
        FROM changed
        WHERE (updated_at >= TIMESTAMP '2024-01-10' AND updated_at < TIMESTAMP '2024-01-12')
           OR (created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-12')""", "changed"),
    "latest_per_key": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_latest": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "incremental_load": _with("""
        SELECT id, user_id, updated_at, created_at, CASE WHEN created_at < updated_at AND NOT coalesce(
                   (updated_at >= TIMESTAMP '2024-01-10' AND updated_at < TIMESTAMP '2024-01-12')
                OR (created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-12'), false)
               THEN -value ELSE value END AS value
        FROM changed""", "changed"),
    "versioned_history": _with("""
        SELECT * FROM (WITH days AS (
            SELECT *, coalesce(created_at < updated_at, false) AS older,
                   coalesce((updated_at >= TIMESTAMP '2024-01-10' AND updated_at < TIMESTAMP '2024-01-12')
                         OR (created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-12'), false) AS both_days,
                   coalesce((updated_at >= TIMESTAMP '2024-01-11' AND updated_at < TIMESTAMP '2024-01-12')
                         OR (created_at >= TIMESTAMP '2024-01-11' AND created_at < TIMESTAMP '2024-01-12'), false) AS last_day
            FROM changed
        ), versions AS (
            SELECT 2 AS version, '2024-01-09/2024-01-10 2024-01-11/2024-01-12' AS loaded, created_at,
                   CASE WHEN older AND NOT last_day THEN -value ELSE value END AS value
            FROM days WHERE older OR NOT both_days OR last_day
            UNION ALL
            SELECT 4, '2024-01-09/2024-01-12', created_at, CASE WHEN older AND NOT both_days THEN -value ELSE value END
            FROM days
        )
        SELECT version, loaded, CAST(created_at AS DATE) AS created_day, count(*) AS n_rows, round(sum(value), 4) AS total
        FROM versions GROUP BY ALL)""", "changed"),
    "load_chosen_tables": _with("""
        SELECT 'orders' AS source_table, id, money_total AS value, CASE WHEN id % 3 <> 0 THEN created END AS updated_at
        FROM orders_src
        UNION ALL
        SELECT 'events', id, CASE WHEN created_at < updated_at AND NOT coalesce(
                   (updated_at >= TIMESTAMP '2024-01-10' AND updated_at < TIMESTAMP '2024-01-12')
                OR (created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-12'), false)
               THEN -value ELSE value END, updated_at
        FROM changed""", "orders_src", "changed"),
    "append_by_position": _with(
        "SELECT id AS order_id, site_user_id AS uid, money_total AS amount FROM orders_src", "orders_src"),
    "sheet_export": """
        SELECT CAST(c_nationkey AS BIGINT) AS id, CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment <> 'BUILDING'
               THEN lower(c_name) || '@example.com' END AS email
        FROM customer""",
    "html_rows": _with("""
        SELECT page_id, CAST(unnest(range(len(cells))) AS INTEGER) AS cell, unnest(list_transform(cells, lambda c:
               trim(replace(regexp_replace(c, '<[^>]*>', '', 'g'), '&amp;', '&')))) AS text
        FROM items""", "items"),
    "admin_units": _with("""
        SELECT page_id, CAST(pos AS INTEGER) AS pos, t[7] AS province_code, t[8] AS province, t[5] AS district_code,
               t[6] AS district, t[1] AS ward_code, t[2] AS ward
        FROM (SELECT page_id, pos, list_transform(cells, lambda c:
              trim(replace(regexp_replace(c, '<[^>]*>', '', 'g'), '&amp;', '&'))) AS t FROM items)""", "items"),
    "admin_units_export": _with("""
        SELECT t[7] AS province_code, t[8] AS province, t[5] AS district_code, t[6] AS district, t[1] AS ward_code,
               t[2] AS ward, count(*) AS n_rows
        FROM (SELECT list_transform(cells, lambda c:
              trim(replace(regexp_replace(c, '<[^>]*>', '', 'g'), '&amp;', '&'))) AS t FROM items WHERE len(cells) > 0)
        GROUP BY ALL""", "items"),
    "level_outbox": _with("""
        SELECT email AS recipient, 'Thông báo kết quả' AS subject,
               CASE level WHEN 1 THEN 'Thành công' WHEN 2 THEN 'Thất bại' END AS body
        FROM people WHERE email <> '' AND level IN (1, 2)""", "people"),
    "level_outbox_lenient": _with("""
        SELECT email AS recipient, 'Thông báo kết quả' AS subject,
               CASE WHEN level = 1 THEN '<p>Thành công</p>' ELSE '<p>Thất bại</p>' END AS body
        FROM people""", "people"),
    "level_outbox_pairs": _with("""
        SELECT a.email AS recipient, 'Thông báo kết quả' AS subject, b.body, b.copies
        FROM people a, (SELECT CASE level WHEN 1 THEN 'Thành công' ELSE 'Thất bại' END AS body, count(*) AS copies
                        FROM people WHERE level IN (1, 2) GROUP BY 1) b
        WHERE a.email <> ''""", "people"),
}
CHECK_SQL["versioned_load"] = CHECK_SQL["incremental_load"]
CHECK_SQL["incremental_load_by_day"] = CHECK_SQL["incremental_load"]
CHECK_SQL["html_rows_nested"] = CHECK_SQL["html_rows"]
CHECK_SQL["mart_game_in_increments"] = CHECK_SQL["mart_game"]
