"""Text, JSON and message rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts the recipients know.
NOTICE_SUBJECT = "Thông báo kết quả"
NOTICE_SUCCESS = "Thành công"
NOTICE_FAILURE = "Thất bại"


def contains_word(text: Column, word: str) -> Column:
    """Case-blind substring test; NULL text gives NULL, which a ``when`` treats as false."""
    return F.lower(text).contains(word.lower())


def matches_any(text: Column, pattern: str) -> Column:
    """Case-blind, unanchored regular-expression test."""
    return F.lower(text).rlike(pattern)


def json_text(document: Column, path: str) -> Column:
    """Text at a JSON path, ``''`` where the path is missing or holds an object or array."""
    text = F.get_json_object(document, path)
    nested = text.rlike(r"^[\[{]") & (F.json_object_keys(text).isNotNull() | F.json_array_length(text).isNotNull())
    return F.when(text.isNull() | nested, F.lit("")).otherwise(text)


def json_int(document: Column, path: str) -> Column:
    """Integer at a JSON path; NULL where it is missing or not a number."""
    return F.get_json_object(document, path).try_cast("int")


def code_suffix(link: Column, length: int = 10) -> Column:
    """Last ``length`` characters; a shorter text is kept whole."""
    return F.right(link, F.lit(length))


def has_text(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def has_level(level: Column) -> Column:
    return F.coalesce(level, F.lit(0)) != 0


def level_message(level: Column, strict: bool) -> Column:
    """Message for a level code.

    Strict: 1 is success, 2 is failure, anything else has no message. Otherwise everything but 1,
    a missing level too, is a failure.
    """
    success = F.when(level == 1, F.lit(NOTICE_SUCCESS))
    if strict:
        return success.when(level == 2, F.lit(NOTICE_FAILURE))
    return success.otherwise(F.lit(NOTICE_FAILURE))


def paragraph(text: Column) -> Column:
    return F.concat(F.lit("<p>"), text, F.lit("</p>"))


def code_map(code: Column, table: dict[int, int]) -> Column:
    """Code-to-code lookup for a short table kept in code; unknown codes give NULL."""
    chain = F.lit(None).cast("int")
    for source, target in reversed(table.items()):
        chain = F.when(code == source, F.lit(target)).otherwise(chain)
    return chain
