"""A filter of bits over listed ids: tells nearly all rows that are not listed without a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.operators.staging import stage

# Bits per listed id; with two places an id, one of about seventy ids that are not listed passes.
BITS_PER_ID = 16
# 32 MB, the most that a filter takes; what it is sent to the tasks as.
MOST_BITS = 1 << 28
# Words of 64 bits in a row of the filter.
ROW_WORDS = 1 << 12
# Types whose equal values have equal hashes.
HASHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


def filter_bits(rows: int) -> int:
    """A power of two with ``BITS_PER_ID`` bits for each of ``rows`` ids, within bounds."""
    return min(max(1 << 18, 1 << (rows * BITS_PER_ID - 1).bit_length()), MOST_BITS)


def can_filter(ids: DataFrame, rows: int, kind: T.DataType) -> bool:
    """Whether a filter tells ids apart: values of one type whose hash says all, and four bits an id at least."""
    return ids.schema[0].dataType == kind and isinstance(kind, HASHED) and rows * 4 <= MOST_BITS


def _places(value: Column, bits: int) -> list[Column]:
    """Two bits of a value: the low and the high end of its hash."""
    hashed = F.xxhash64(value)
    return [hashed.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(hashed, 64 - bits.bit_length() + 1)]


def _mask(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def listed_filter(ids: DataFrame, rows: int) -> Callable[[Column], Column]:
    """A test that holds for every value of the only column of ``ids`` and for few others; NULL gives NULL.

    The bits are set by shuffled partial aggregates, staged as rows of ``ROW_WORDS`` words and enter the plan as one
    scalar of ``filter_bits(rows) / 8`` bytes, ``MOST_BITS / 8`` at most.
    """
    (listed,) = ids.columns
    bits = filter_bits(rows)
    place = F.col("_place")
    words = (ids.select(F.explode(F.array(*_places(F.col(listed), bits))).alias("_place"))
             .groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(_mask(place)).alias("_set")))
    # Words without a bit are zero, so that a word is found by its position.
    dense = (ids.sparkSession.range(bits // 64).withColumnRenamed("id", "_word").join(words, "_word", "left")
             .select("_word", F.coalesce("_set", F.lit(0).cast("long")).alias("_set")))
    table = stage(dense.groupBy((F.col("_word") / ROW_WORDS).cast("int").alias("_row")).agg(
        F.array_sort(F.collect_list(F.struct("_word", "_set")))["_set"].alias("words")), "filter")
    held = table.agg(F.array_sort(F.collect_list(F.struct("_row", "words")))["words"]).scalar()

    def possible(value: Column) -> Column:
        tests = []
        for at in _places(value, bits):
            word = F.shiftright(at, 6)
            row = F.get(held, F.shiftright(word, ROW_WORDS.bit_length() - 1).cast("int"))
            found = F.get(row, word.bitwiseAND(F.lit(ROW_WORDS - 1)).cast("int"))
            tests.append(found.bitwiseAND(_mask(at)) != 0)
        return F.when(value.isNotNull(), tests[0] & tests[1])

    return possible
