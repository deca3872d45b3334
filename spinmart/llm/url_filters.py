"""Judge URLs by path rules and by an exact blocklist held in a cascade of Bloom filters.

Level 1 encodes the listed keys. The keys of the corpus that it takes for listed by mistake are encoded in level 2, the
listed keys that level 2 takes for mistakes in level 3, and so on until a level errs on no key. A key's
membership is told by the first level that lacks it: an odd one means not listed, an even one listed. For every key
of the universe the answer is exact, and no page is joined to the list.

Level 1 has an error rate of listed to other keys, the next ones 1/16, so the cascade's size follows the listed keys
and not the corpus. Each level is cut into shards by the key's hash, each a dense array of 64-bit words.
Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinmart.llm.names import step_aside
from spinmart.operators.staging import stage

# Keys of a level in one shard, about 48 KB of bits at most in the later levels.
SHARD_KEYS = 1 << 16
# Bytes of a cascade that are put into the plan as a constant; a larger one is met shard by shard.
CONSTANT_BYTES = 32 << 20
LATER_HASHES = 4

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Host labels of the listed sites.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits, else NULL."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _bits(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    """Places of a key in a filter of a level."""
    return [F.pmod(F.xxhash64(F.lit(level * 64 + j), key), F.lit(bits)).cast("int") for j in range(hashes)]


def _filled(keys: DataFrame, level: int, hashes: int, bits: int, shards: int) -> DataFrame:
    """One row per shard: its bits as a dense array of words."""
    spark, words = keys.sparkSession, bits // 64
    places = keys.select("_shard", F.explode(F.array(*_bits(F.col("key"), level, hashes, bits))).alias("_bit"))
    empty = spark.range(shards * words).select(
        (F.col("id") / words).cast("int").alias("_shard"), (F.col("id") % words).cast("int").alias("_word"),
        F.lit(0).cast("long").alias("_mask"))
    masks = places.select(
        "_shard", F.floor(F.col("_bit") / 64).cast("int").alias("_word"),
        F.expr("shiftleft(1L, _bit % 64)").alias("_mask")).unionByName(empty)
    return (masks.groupBy("_shard", "_word").agg(F.bit_or("_mask").alias("_mask"))
            .groupBy("_shard").agg(F.array_sort(F.collect_list(F.struct("_word", "_mask")))["_mask"].alias("words"))
            .select(F.lit(level).alias("level"), "_shard", "words"))


def _holds(words: Column, key: Column, level: int, hashes: int, bits: int) -> Column:
    """Whether all bits of the key are set."""
    held = F.lit(True)
    for bit in _bits(key, level, hashes, bits):
        word = F.get(words, F.floor(bit / 64).cast("int"))
        held = held & (F.getbit(word, bit % 64) == 1)
    return held


class Cascade:
    """Exact membership of the keys of a universe in a list."""

    def __init__(self, listed: DataFrame, universe: DataFrame) -> None:
        """``listed`` and ``universe`` have one column ``key``; listed keys outside the universe are ignored."""
        marks = (universe.select("key", F.lit(0).alias("_in")).unionByName(listed.select("key", F.lit(1).alias("_in")))
                 .groupBy("key").agg(F.max("_in").alias("_listed"), F.min("_in").alias("_outside"))
                 .where("_outside = 0 AND key IS NOT NULL").drop("_outside"))
        marks = stage(marks, "url-keys")
        n_all, n_listed = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum("_listed"), F.lit(0))).first()
        self.shards = max(1, math.ceil(n_listed / SHARD_KEYS))
        self.levels: list[tuple[int, int]] = []  # (hashes, bits) of each level
        self.filters: list[DataFrame] = []
        mine = marks.withColumn("_shard", self._shard(F.col("key")))
        mine, other = mine.where("_listed = 1").drop("_listed"), mine.where("_listed = 0").drop("_listed")
        n_mine, n_other = n_listed, n_all - n_listed
        while n_mine:
            hashes = LATER_HASHES if self.levels else max(1, math.ceil(math.log2(max(2, n_other / n_mine))))
            bits = 64 * (math.ceil(1.45 * hashes * n_mine / self.shards / 64) + 1)
            level = len(self.levels) + 1
            filled = stage(_filled(mine, level, hashes, bits, self.shards), "url-filter")
            self.levels.append((hashes, bits))
            self.filters.append(filled)
            # The other side's keys that this level holds are the keys of the next one.
            wrong = stage(self._with_words(other, filled).where(
                _holds(F.col("words"), F.col("key"), level, hashes, bits)).select("key", "_shard"), "url-errors")
            mine, other = wrong, mine
            n_mine, n_other = wrong.count(), n_mine

    @property
    def n_bytes(self) -> int:
        return sum(bits // 8 * self.shards for _, bits in self.levels)

    def _shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(self.shards)).cast("int")

    def _with_words(self, keys: DataFrame, filled: DataFrame) -> DataFrame:
        table = filled.select("_shard", "words")
        largest = max((bits // 8 * self.shards for _, bits in self.levels), default=0)
        return keys.join(F.broadcast(table) if largest <= CONSTANT_BYTES else table, "_shard")

    def _answer(self, held: Sequence[Column]) -> Column:
        """Listed or not, told by the first level that lacks the key."""
        answer = F.lit(len(held) % 2 == 1)
        for i in range(len(held), 0, -1):
            answer = F.when(~held[i - 1], F.lit(i % 2 == 0)).otherwise(answer)
        return answer

    def add_membership(self, rows: DataFrame, key: str, name: str, limit: int = CONSTANT_BYTES) -> DataFrame:
        """``rows`` with a boolean ``name``. A cascade of up to ``limit`` bytes is a constant of the plan; of a
        larger one each row meets its own shard. Other columns stay, whatever their names; one called ``name`` is replaced."""
        if not self.levels:
            return rows.withColumn(name, F.lit(False))
        columns = {f"_words{i}": table for i, table in enumerate(self.filters)}
        rows, own = step_aside(rows if name == key else rows.drop(name), ("_shard", *columns))
        key = next((free for free, was in own.items() if was == key), key)
        if self.n_bytes <= limit:
            shard = F.col("_shard")
            words = {c: F.get(t.agg(F.array_sort(F.collect_list(F.struct("_shard", "words")))["words"]).scalar(), shard)
                     for c, t in columns.items()}
            out = rows.withColumn("_shard", self._shard(F.col(key)))
        else:
            out = rows.withColumn("_shard", self._shard(F.col(key)))
            for c, t in columns.items():
                out = out.join(t.select("_shard", F.col("words").alias(c)), "_shard")
            words = {c: F.col(c) for c in columns}
        held = [_holds(w, F.col(key), i + 1, *self.levels[i]) for i, w in enumerate(words.values())]
        asked = self._answer(held).alias(name)
        return out.select(*[c for c in rows.columns if c != name], asked).withColumnsRenamed(own)


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row: ``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` ("allow" or "block").

    The longest rule that fits decides; ``rule`` is then its host and path. Else a page is blocked if its
    host and path in a row are a ``key`` of ``listed``. A NULL url or one without ``://`` has an empty host and
    path and is allowed unless the empty key is listed. Repeated rows are judged each.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed = parts.withColumn("_key", F.concat("host", "path"))
    cascade = Cascade(listed.select("key"), keyed.select(F.col("_key").alias("key")))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return cascade.add_membership(keyed, "_key", "_listed").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"))


def listed_pages(pages: DataFrame) -> DataFrame:
    """Keys (host and path) of all pages on listed sites."""
    host = host_of(F.col("url"))
    bad = F.arrays_overlap(F.split(host, "[.]"), F.array(*[F.lit(x) for x in LISTED_LABELS]))
    return pages.where(bad).select(F.concat(host, path_of(F.col("url"))).alias("key"))


def op5_url_filters(spark, sf_dir: str) -> DataFrame:
    """All pages against the rules and the list of pages on listed sites."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, listed_pages(pages))


OP5_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), rules(kind, rule_host, rule_path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best AS (
    SELECT page_id, arg_max(kind, length(rule_host || rule_path)) AS kind,
           arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(kind, CASE WHEN list_has_any(string_split(host, '.'), [
    'adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b ON p.page_id = b.page_id
"""
