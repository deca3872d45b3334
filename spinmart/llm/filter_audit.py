"""Filter interaction audit: what every order of five filters keeps, removes and repeats, over a document-term matrix.

Words are dictionary-encoded over the whole corpus: each block of documents names its distinct words by hash, shards
number the distinct ones they get, and the block reads the numbers back. With them a block becomes one shard of the
sparse document-term matrix in CSR form (row starts, term numbers, counts). Row sums are the words of a document and the
nonzero entries of a row its distinct words, which decide filters A and B. C and D are read off the same texts; for E
the smallest id of every text comes back by the same exchange. The five bits of a document meet its labels, are counted
per part and bit pattern, and only these few patterns are put through the orders.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks
from spinmart.llm.blocks import ask, count_blocks, cut, deal, finish, hash_all, ids_of, mix, texts_of

FILTERS = "ABCDE"
UPPER = bytes(range(0x41, 0x5B))
CONTINUED = bytes(range(0x80, 0xC0))
# A term's number is that of its shard, shifted, and its rank there.
RANK_BITS = 40
NAME = np.dtype([("check", "<u4"), ("block", "<i4")])
COPY = np.dtype([("id", "<i8"), ("check", "<u4")])


@dataclass(frozen=True)
class Limits:
    """Where the filters fail a document."""

    min_words: int = 100
    distinct_percent: int = 80
    upper_percent: int = 10
    symbols: bytes = b"#$%&*|"


def checks(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, parts), np.uint32, len(parts))


def pairs(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts entries by key and check, number of the distinct pair of each sorted entry)."""
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return order, np.cumsum(new) - 1


# Words of a chunk of text are hashed together; a longer text is a chunk of its own.
CHUNK = 1 << 18
SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_pick = np.random.default_rng(12)
BYTE_VALUES = _pick.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """[powers of ``BASE``, powers of its inverse] modulo 2^64, ``n`` at least."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps))
    return _powers


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, key and check of every word of a text), without touching words one by one.

    A word's hash is the sum of a random value of each of its bytes times a power of the base by its place in the word. Running
    sums over the whole text give that of every word by one difference, moved to its start by the inverse power.
    """
    space = SPACE[data]
    inside = np.concatenate([[True], space, [True]])
    starts = np.flatnonzero(inside[:-2] & ~space)
    ends = np.flatnonzero(~space & inside[2:]) + 1
    up, down = powers(max(len(data), CHUNK))
    found = []
    for values in BYTE_VALUES:
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values[data] * up[: len(data)])])
        found.append((sums[ends] - sums[starts]) * down[starts])
    return starts, ends, mix(found[0], (ends - starts).astype(np.uint64)), (found[1] >> np.uint64(32)).astype(np.uint32)


def chunks(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        part.append(t or b"")
        size += len(part[-1]) + 1
        if size >= CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


class Terms:
    """The words of a block: distinct words in the order of their keys, and each word as its place among them."""

    def __init__(self, texts: list[bytes | None], words: bool = False) -> None:
        counts, keys, checked, named = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], []
        for part in chunks(texts):
            joined = b" ".join(part)
            starts, ends, key, check = hash_words(np.frombuffer(joined, np.uint8))
            offsets = np.cumsum([0] + [len(t) + 1 for t in part])
            counts.append(np.diff(np.searchsorted(starts, offsets)))
            keys.append(key)
            checked.append(check)
            if words:
                named += [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        self.counts = np.concatenate([np.zeros(0, np.int64), *counts])
        key, check = np.concatenate(keys), np.concatenate(checked)
        order = np.argsort(key, kind="stable")
        k, c = key[order], check[order]
        same = k[1:] == k[:-1]
        if (same & (c[1:] != c[:-1])).any():  # two words with one key
            order, group = pairs(key, check)
        else:
            group = np.cumsum(np.concatenate([np.ones(min(1, len(k)), bool), ~same])) - 1
        first = np.flatnonzero(np.diff(group, prepend=-1))
        self.key, self.check = key[order][first], check[order][first]
        self.words = [named[i] for i in order[first].tolist()] if words else []
        self.places = np.empty(len(key), np.int64)
        self.places[order] = group

    def numbers(self, ranks: np.ndarray, shards: int) -> np.ndarray:
        """Corpus-wide number of every distinct word; rises with the key."""
        at = cut(self.key, shards)
        return (np.repeat(np.arange(shards, dtype=np.int64), np.diff(at)) << RANK_BITS) + ranks

    def csr(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row starts, places of the distinct words of each row in rising order, their counts)."""
        width = max(1, len(self.key))
        row = np.repeat(np.arange(len(self.counts)), self.counts)
        cells, n = np.unique(row * width + self.places, return_counts=True)
        return np.searchsorted(cells, np.arange(len(self.counts) + 1) * width), cells % width, n


def text_keys(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(key, check) of whole texts; a NULL text is an empty one."""
    full = [t or b"" for t in texts]
    return hash_all(full), checks(full)


def copies(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys of the distinct texts of a block, smallest id and check of each, place of each row)."""
    key, check = text_keys(texts_of(table))
    ids = ids_of(table)
    order, group = pairs(key, check)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    out = np.empty(len(first), COPY)
    out["id"] = np.minimum.reduceat(ids[order], first) if len(first) else []
    out["check"] = check[order][first]
    place = np.empty(len(key), np.int64)
    place[order] = group
    return key[order][first], out, place


MATRIX = T.StructType([
    T.StructField("block", T.IntegerType()), T.StructField("doc_id", T.ArrayType(T.LongType())),
    T.StructField("part", T.ArrayType(T.StringType())), T.StructField("row_start", T.ArrayType(T.LongType())),
    T.StructField("term", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.IntegerType())),
    T.StructField("upper", T.ArrayType(T.LongType())), T.StructField("code_points", T.ArrayType(T.LongType())),
    T.StructField("symbols", T.ArrayType(T.LongType())), T.StructField("copy", T.ArrayType(T.BooleanType())),
    T.StructField("words", T.ArrayType(T.StructType([
        T.StructField("term", T.LongType()), T.StructField("word", T.StringType())])))])


def build_matrix(docs: DataFrame, part: str | None = "lang", symbols: bytes = Limits.symbols,
                 words: bool = False) -> DataFrame:
    """The document-term matrix, one row per CSR shard.

    ``doc_id``, ``part`` and the counts ``upper`` (A-Z), ``code_points``, ``symbols`` and ``copy`` (equal to the text of a
    smaller id) are aligned with the rows of the shard; row i has the terms ``term[row_start[i]:row_start[i + 1]]``, each
    ``n`` times. Term numbers hold over all shards. With ``words`` a shard also lists the terms it names for the
    dictionary, each term in one shard.

    Words are runs without ASCII white space, case-sensitive. A NULL text is an empty one, a NULL ``part`` an empty
    string. A NULL id is larger than any other; rows with equal ids hold nothing smaller for each other. An empty
    table has no shards. Other columns are not used whatever their names.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.coalesce(F.col(part).cast("string") if part else F.lit(None), F.lit("")).alias("part"))
    blocks = count_blocks(docs)
    shards = max(1, blocks // 4)
    dealt = deal(docs, blocks)

    def texts(table):
        return copies(table)[:2]

    def smallest(keys, values):
        order, group = pairs(keys, values["check"])
        out = np.empty(len(keys), np.int64)
        out[order] = np.minimum.reduceat(values["id"][order], np.flatnonzero(np.diff(group, prepend=-1)))[group]
        return out

    def names(table):
        terms = Terms(texts_of(table))
        extra = np.empty(len(terms.key), NAME)
        extra["check"], extra["block"] = terms.check, table.column("_block")[0].as_py()
        return terms.key, extra

    def ranks(keys, values):
        """Rank of each word in the shard, and whether its block is the lowest that has it."""
        order, group = pairs(keys, values["check"])
        least = np.minimum.reduceat(values["block"][order], np.flatnonzero(np.diff(group, prepend=-1)))
        out = np.empty(len(keys), np.int64)
        out[order] = group * 2 + (values["block"][order] == least[group])
        return out

    def shard(table, answer):
        found = texts_of(table)
        if not found:
            return MATRIX_ARROW.empty_table()
        key, _, place = copies(table)
        least = np.frombuffer(answer, np.int64)[place]
        replies = np.frombuffer(answer, np.int64)[len(key):]
        terms = Terms(found, words)
        numbers = terms.numbers(replies >> 1, shards)
        start, at, n = terms.csr()
        own = np.flatnonzero(replies & 1).tolist() if words else []
        full = [t or b"" for t in found]

        def without(chars):
            return np.array([len(t) - len(t.translate(None, chars)) for t in full])

        row = {
            "block": table.column("_block")[0].as_py(), "doc_id": table.column("doc_id").to_pylist(),
            "part": table.column("part").to_pylist(), "row_start": start, "term": numbers[at], "n": n.astype(np.int32),
            "upper": without(UPPER), "code_points": np.array([len(t) for t in full]) - without(CONTINUED),
            "symbols": without(symbols), "copy": least < ids_of(table),
            "words": [{"term": t, "word": terms.words[i].decode("utf-8", "replace")}
                      for i, t in zip(own, numbers[own].tolist())]}
        return pa.table({f.name: pa.array([row[f.name]], f.type) for f in MATRIX_ARROW})

    first = ask(dealt, texts, smallest, COPY, shards)
    numbered = ask(dealt, names, ranks, NAME, shards)
    # Answers on texts first, then those on words.
    both = first.withColumn("shard", F.col("shard") - shards).unionByName(numbered)
    return finish(dealt, both, shard, MATRIX)


MATRIX_ARROW = pa.schema([
    ("block", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("part", pa.list_(pa.string())),
    ("row_start", pa.list_(pa.int64())), ("term", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())),
    ("upper", pa.list_(pa.int64())), ("code_points", pa.list_(pa.int64())), ("symbols", pa.list_(pa.int64())),
    ("copy", pa.list_(pa.bool_())), ("words", pa.list_(pa.struct([("term", pa.int64()), ("word", pa.string())])))])


def dictionary(matrix: DataFrame) -> DataFrame:
    """``term`` and ``word`` of every distinct word of a matrix that was built with its words."""
    return matrix.select(F.explode("words").alias("w")).select("w.term", "w.word")


FLAGS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.StringType()),
                      T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType()),
                      T.StructField("fails", T.IntegerType())])


def judge(matrix: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per document ``doc_id``, ``part``, ``n_words``, ``n_distinct`` and ``fails``, bit 0 for A to bit 4 for E."""

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                column = {name: batch.column(name)[i].values for name in batch.schema.names}
                start, n, upper, points, symbols = (
                    column[c].to_numpy() for c in ("row_start", "n", "upper", "code_points", "symbols"))
                copy = column["copy"].to_numpy(zero_copy_only=False)
                sums = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
                words, distinct = np.diff(sums[start]), np.diff(start)
                bits = [words < limits.min_words, 100 * distinct < limits.distinct_percent * words,
                        100 * upper > limits.upper_percent * points, symbols > 0, copy]
                fails = sum(b.astype(np.int32) << k for k, b in enumerate(bits))
                yield pa.RecordBatch.from_arrays(
                    [column["doc_id"], column["part"], pa.array(words), pa.array(distinct), pa.array(fails, pa.int32())],
                    names=FLAGS.names)

    return matrix.select("doc_id", "part", "row_start", "n", "upper", "code_points", "symbols", "copy").mapInArrow(rows, FLAGS)


def attach_labels(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """``flags`` with ``good`` (quality 1) and ``toxic`` (toxic 1). Several labels of a document count as their largest;
    unlabelled documents and those without an id are neither."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Rows without an id match nothing and are spread; without this they would meet in one task.
    spread = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(0)
    right = known.select(F.col("_id").alias("doc_id"), F.lit(0).cast("long").alias("_spread"), "good", "toxic")
    return flags.withColumn("_spread", spread.cast("long")).join(right, ["doc_id", "_spread"], "left").drop(
        "_spread").fillna(False, ["good", "toxic"])


def audit(judged: DataFrame, filters: str = FILTERS, orders: Sequence[str] | None = None) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step``, zeros included: ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``.

    ``judged`` has ``part``, ``fails`` (bit k for the k-th filter), ``good`` and ``toxic``. Orders are all permutations
    unless given. ``shapley`` sums what a filter removes over all permutations: a document that fails k filters is
    removed by each of them in one k-th of these. No documents give no rows.
    """
    orders = ["".join(p) for p in permutations(filters)] if orders is None else orders
    every = len(list(permutations(filters)))
    patterns = judged.groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    bit = {f: 1 << k for k, f in enumerate(filters)}
    steps = [(o, k + 1, bit[f], sum(bit[g] for g in o[:k])) for o in orders for k, f in enumerate(o)]
    names = ("filter_order", "step", "own", "before")
    # A few thousand constant rows at most, met by every bit pattern of a part.
    listed = F.explode(F.from_json(F.lit(json.dumps([dict(zip(names, s)) for s in steps])),
                                   "array<struct<filter_order string, step int, own int, before int>>"))
    cells = patterns.select("*", listed.alias("s")).select("part", "docs", "good", "toxic", "fails", "s.*")
    own, before = F.expr("fails & own <> 0"), F.expr("fails & before <> 0")

    def docs(condition, column="docs"):
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).cast("long")

    return cells.groupBy("part", "filter_order", "step").agg(
        docs(F.expr("fails & (own | before) = 0")).alias("kept"), docs(own & ~before).alias("removed"),
        docs(own & before).alias("redundant"), docs(F.expr("fails = own")).alias("unique_fails"),
        docs(own & ~before, "good").alias("good_lost"), docs(own & ~before, "toxic").alias("toxic_lost"),
        F.sum(F.when(own, F.expr(f"docs * {every} div bit_count(fails)")).otherwise(0)).cast("long").alias("shapley"))


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Five filters over all documents by language, in all orders."""
    flags = judge(build_matrix(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return audit(attach_labels(flags, spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP12_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), judged AS (
    SELECT doc_id, part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
        regexp_matches(text, '[#$%&*|]'), doc_id > least] AS fails
    FROM texts
), known AS (
    SELECT j.*, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
    FROM judged j LEFT JOIN labels l ON j.doc_id = l.doc_id
), orders(filter_order) AS (
    SELECT '' UNION ALL
    SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(filter_order, f)
), steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, instr('ABCDE', filter_order[step]) AS own,
           list_transform(string_split(filter_order[1:step - 1], ''), lambda x: instr('ABCDE', x)) AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS step) WHERE length(filter_order) = 5
), patterns AS (
    SELECT part, fails, count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
    FROM known GROUP BY ALL
), cells AS (
    SELECT *, fails[own] AS fails_own, step > 1 AND len(list_filter(before, lambda x: fails[x])) > 0 AS gone
    FROM patterns, steps
), counted AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN NOT fails_own AND NOT gone THEN docs ELSE 0 END) AS kept,
           sum(CASE WHEN fails_own AND NOT gone THEN docs ELSE 0 END) AS removed,
           sum(CASE WHEN fails_own AND gone THEN docs ELSE 0 END) AS redundant,
           sum(CASE WHEN fails_own AND len(list_filter(fails, lambda x: x)) = 1 THEN docs ELSE 0 END) AS unique_fails,
           sum(CASE WHEN fails_own AND NOT gone THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN fails_own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

ship_with_tasks(__name__)
