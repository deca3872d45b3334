"""Schemas of the source tables. All times are UTC wall clock."""

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(), "money": T.DecimalType(18, 2),
}


def _schema(columns: str) -> T.StructType:
    """``name type, ...`` as a schema; needs no running session, unlike DDL parsing."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


ORDERS = _schema(
    "id bigint, transaction_id string, site_id int, site_user_id string, phone string,"
    " created timestamp_ntz, ncart_id bigint, status int, pay_status int, delivery int,"
    " money_total money"
)
ORDER_LINES = _schema(
    "id bigint, cart_id bigint, gift_detail_id bigint, status int, pay_status int, delivery int"
)
GIFTS = _schema("id bigint, title string")
PROVINCES = _schema("id int, title string")
GAMES = _schema("id bigint")
REWARDS = _schema("id bigint, game_id bigint, gift_id bigint, name string")
REWARD_QUANTITIES = _schema("reward_id bigint, quantity bigint")
WINS = _schema(
    "id bigint, customer_id string, reward_id bigint, transaction_id string, created timestamp_ntz,"
    " state int, code_redeem string, metadata string, region string"
)
GAME_CODES = _schema(
    "game_id bigint, customer_id string, created timestamp_ntz, turns int, state int, link string,"
    " code string"
)
PAYMENT_ORDERS = _schema("id bigint, transaction_id string, status int, money_total money")
UNIDENTIFIED_CARDS = _schema(
    "id bigint, ncart_id bigint, campaign_id bigint, created_at timestamp_ntz"
)
EXCLUDED_WINS = _schema("id bigint")

CHAT_MESSAGES = _schema("conversation_id bigint, content string, role string, created_at timestamp_ntz")
CHAT_CONVERSATIONS = _schema("id bigint, user_id bigint")
CHAT_USERS = _schema("id bigint, email string")

RECIPIENTS = _schema("id bigint, email string")
ROLES = _schema("id bigint, level int")
RECIPIENT_LEVELS = _schema("email string, level int")

PAGES = _schema("page_id bigint, url string, html string")
