"""Ask a corpus-wide table about the keys of each block of documents, without joining rows.

Documents are dealt into blocks of a few MB by a hash of their id and text. A block names its distinct
64-bit keys once, sorted, cut into hash ranges ("shards") and delta-packed. A shard sees the keys of all
blocks, works out an answer per key, and sends each block an array aligned with the keys that block
sent. The block derives the same sorted keys again and reads its answers off by position. So a key
costs about six bytes per block that holds it, a frequent key is one entry per block however often it
occurs, shards are even by construction, and the documents themselves are shuffled once per plan (the
exchange is reused by every round).

Keys are 64-bit hashes; where equal keys must mean equal content, a 32-bit check value travels along.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinmart.llm import ship_with_tasks

# Bytes of text in a block. A block is what one Python task holds at a time; a longer text is a block of its own size.
BLOCK_BYTES = 4 << 20
ANSWER = "block int, shard int, answer binary"
QUESTION = "shard int, block int, keys binary, extra binary"


# ---------------------------------------------------------------- blocks

def count_blocks(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """As many blocks as the texts fill, at least one for each shuffle partition."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    return max(math.ceil(total / block_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def deal(docs: DataFrame, blocks: int, text: str = "text") -> DataFrame:
    """Add ``_block``. It depends on id and text only, so a recomputed task deals the same way."""
    return docs.withColumn("_block", F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int"))


def texts_of(table: pa.Table, name: str = "text") -> list[bytes | None]:
    """The texts as UTF-8 bytes."""
    return table.column(name).cast(pa.binary()).to_pylist()


def ids_of(table: pa.Table) -> np.ndarray:
    """``doc_id`` as int64; a NULL id counts as the largest."""
    return table.column("doc_id").cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()


# ---------------------------------------------------------------- hashes

def hash_all(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two, order matters."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` consecutive words that start at each position; short at the end."""
    if len(words) < width:
        return words[:0]
    done, level, size, left = None, words, 1, width
    offset = 0
    while left:
        if left & 1:
            part = level[offset:]
            done = part if done is None else mix(done[: len(part)], part[: len(done)])
            offset += size
        left >>= 1
        if left:
            level = mix(level[:-size], level[size:])
            size *= 2
    return done[: len(words) - width + 1]


def split_words(texts: list[bytes | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in a row, number of words of each text). Words end at ASCII white space."""
    lists = [(t.lower() if lower else t).split() if t else [] for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    total = int(counts.sum())
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(lists)), np.uint64, total), counts


def inside(counts: np.ndarray, width: int) -> np.ndarray:
    """Which of the windows over all words in a row stay within one text."""
    total = int(counts.sum())
    ends = np.repeat(np.cumsum(counts), counts)
    return (np.arange(total) + width <= ends)[: max(0, total - width + 1)]


def owners(counts: np.ndarray) -> np.ndarray:
    """Index of the text of each word."""
    return np.repeat(np.arange(len(counts)), counts)


# ---------------------------------------------------------------- questions and answers

def pack(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as differences, byte planes apart: the high planes compress to nothing."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def planes(values: np.ndarray) -> bytes:
    """Values with their byte planes apart, after the size of one: small numbers leave planes of zeros."""
    size = values.dtype.itemsize
    return bytes([size]) + np.ascontiguousarray(values).view(np.uint8).reshape(-1, size).T.tobytes()


def unplanes(data: bytes) -> bytes:
    return np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1).T.tobytes()


def cut(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range starts and ends within sorted keys."""
    edges = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def questions(block: int, keys: np.ndarray, extra: np.ndarray, shards: int) -> pa.Table:
    """One row per shard that has keys of this block. ``keys`` sorted and distinct, ``extra`` aligned."""
    at = cut(keys, shards)
    used = np.flatnonzero(np.diff(at))
    return pa.table({
        "shard": pa.array(used.astype(np.int32)),
        "block": pa.array(np.full(len(used), block, np.int32)),
        "keys": pa.array([pack(keys[at[s]:at[s + 1]]) for s in used], pa.binary()),
        "extra": pa.array([planes(extra[at[s]:at[s + 1]]) for s in used], pa.binary()),
    })


def ask(dealt: DataFrame, question: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
        reply: Callable[[np.ndarray, np.ndarray], np.ndarray], extra: np.dtype, shards: int,
        before: DataFrame | None = None) -> DataFrame:
    """Answers per block and shard.

    ``question(rows)`` gives a block's sorted distinct keys and a value for each; ``question(rows,
    answer)`` does with the answers of an earlier round, ``before``. ``reply(keys, values)`` gets the keys
    and values of all blocks in a row and gives one answer for each entry.
    """

    def emit(key, table):
        return questions(key[0].as_py(), *question(table), shards)

    def emit_again(key, table, answers):
        return questions(key[0].as_py(), *question(table, joined(answers)), shards)

    def answer(table):
        keys = [unpack(x) for x in table.column("keys").to_pylist()]
        values = [np.frombuffer(unplanes(x), extra) for x in table.column("extra").to_pylist()]
        replies = reply(np.concatenate(keys), np.concatenate(values))
        ends = np.cumsum([len(x) for x in keys])[:-1]
        return pa.table({
            "block": table.column("block"), "shard": table.column("shard"),
            "answer": pa.array([planes(x) for x in np.split(replies, ends)], pa.binary()),
        })

    grouped = dealt.groupBy("_block")
    asked = (grouped.applyInArrow(emit, QUESTION) if before is None else
             grouped.cogroup(before.groupBy("block")).applyInArrow(emit_again, QUESTION))
    return asked.groupBy("shard").applyInArrow(answer, ANSWER)


def joined(answers: pa.Table) -> bytes:
    """The answers of a block in the order of its sorted keys."""
    order = np.argsort(answers.column("shard").to_numpy())
    parts = answers.column("answer").to_pylist()
    return b"".join(unplanes(parts[i]) for i in order)


def finish(dealt: DataFrame, answers: DataFrame, function: Callable[[pa.Table, bytes], pa.Table], schema) -> DataFrame:
    """``function(rows of a block, its answers)`` for every block."""

    def close(key, table, replies):
        return function(table, joined(replies)) if table.num_rows else function(table, b"")

    return dealt.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(close, schema)


def same_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts the keys, number of the group of each sorted entry)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.cumsum(new) - 1


def shard_sums(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each entry the sum of the values over all entries with its key."""
    order, group = same_keys(keys)
    sums = np.zeros(len(keys), np.int64)
    sums[order] = np.bincount(group, weights=values[order])[group].astype(np.int64) if len(keys) else 0
    return sums


def conform(table: pa.Table, schema: pa.Schema) -> pa.Table:
    return table.select(schema.names).cast(schema)


ship_with_tasks(__name__)
