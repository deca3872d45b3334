"""Messages to recipients by their level code: rows to deliver, not the delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinmart.functions.texts import (
    NOTICE_FAILURE,
    NOTICE_SUBJECT,
    NOTICE_SUCCESS,
    has_level,
    has_text,
    level_message,
    paragraph,
)
from spinmart.operators.lookups import left_join_present


def recipients_with_level(recipients: DataFrame, roles: DataFrame, limit: int | None = None) -> DataFrame:
    """Recipients with the level their role sheet gives them, if any.

    A sheet has few rows for any one id. For one that may not, ``limit`` is the rows of an id from which on they are split.
    """
    return left_join_present(recipients, roles, "id", limit=limit)


def _subject() -> Column:
    return F.lit(NOTICE_SUBJECT).alias("subject")


def level_outbox(people: DataFrame, strict: bool = True) -> DataFrame:
    """(recipient, subject, body), one message per row of ``people`` (email, level).

    Strict drops rows without address or level and levels without a message. Otherwise every row
    gets a message, wrapped in a paragraph tag.
    """
    body = level_message(F.col("level"), strict)
    if not strict:
        return people.select(F.col("email").alias("recipient"), _subject(), paragraph(body).alias("body"))
    return (
        people.where(has_text(F.col("email")) & has_level(F.col("level")))
        .select(F.col("email").alias("recipient"), _subject(), body.alias("body"))
        .where(F.col("body").isNotNull())
    )


def level_outbox_all_pairs(people: DataFrame) -> DataFrame:
    """Every address with the message of every row's level, as (recipient, subject, body, copies).

    Only two bodies exist, so the levels are counted first and each address gets at most two rows.
    ``copies`` says how many equal messages the pairing of all addresses and levels holds.
    """
    copies = (
        people.select(level_message(F.col("level"), strict=True).alias("body"))
        .where(F.col("body").isNotNull())
        .groupBy("body").agg(F.count(F.lit(1)).alias("copies"))
    )
    bodies = F.array(F.lit(NOTICE_SUCCESS), F.lit(NOTICE_FAILURE))
    return (
        people.where(has_text(F.col("email")))
        .select(F.col("email").alias("recipient"), _subject(), F.explode(bodies).alias("body"))
        .join(F.broadcast(copies), "body")
        .select("recipient", "subject", "body", "copies")
    )
