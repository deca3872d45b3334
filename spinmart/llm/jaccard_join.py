"""Jaccard self-join of documents on word shingles: universe partition with a pigeonhole, verified exactly.

Two sets with similarity of at least 0.8 differ in at most (|r| + |s|) / 9 shingles. The universe of
shingles is cut by hash into segments, their number chosen per size band. If r has more segments in use
than it may differ in, it agrees with s on one of them, so equal segments meet in an index. Where sets are
small, segments are fewer and met with one deletion: there a segment with at most one difference is sure to be
found, either whole or with one shingle left out, and counts twice. Which of the two a band uses, and how many
segments, is the cheaper of the two by a cost estimate. A set whose shingles fall too unevenly is cut again by another
hash until it has the segments it needs, and is listed under each.

Allocation is by cost as well: the index first tells each document how long the lists of its segments are, and
the document asks only in its rarest segments, as many as the bound needs. A document whose rarest
segments are its own alone has no partner and drops out; so common passages cost little.

Documents with equal sets are one class and are compared once. Within a list, classes are first compared with one
hub, and what links becomes a component; only classes of different components that share a list are compared
further, in chunks, after an exact bound on their difference (bucket parities). So every link between different
components is found, while a large group of near copies costs one comparison per member. An entry of the index carries a sketch of fixed
limited size, whatever its set; only pairs that these leave meet the full parities, and only what is left then the
texts, on whose shingles each link is verified.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks
from spinmart.llm.blocks import (
    ask,
    count_blocks,
    deal,
    finish,
    inside,
    mix,
    owners,
    same_keys,
    shard_sums,
    split_words,
    texts_of,
    window_hashes,
)
from spinmart.llm.components import connect
from spinmart.llm.names import step_aside
from spinmart.operators.lookups import broadcast_if_small
from spinmart.operators.staging import stage

SHINGLE_WORDS = 5
# Links have 100 * intersection >= 80 * union; two sets then differ in at most (|r| + |s|) / NINTH elements, and the
# larger is at most 5/4 of the smaller.
NINTH = 9
MIN_PARITY_BITS = 7
# Rounds in which lists are compared with one hub, another one each time.
HUB_ROUNDS = 2
# Rows of one list that one task compares with each other.
CHUNK = 512
# Bytes of bucket parities and smallest keys of a set that travel with each of its entries, at most.
SKETCH = 512
FIRST_KEYS = 16
# Expected cost of a segment that holds one shingle only, against one index entry.
WEAK_COST = 8
PLANS: dict[int, tuple[bool, int]] = {}


def larger_partner(n):
    return n * 5 // 4


def bands() -> tuple[tuple[int, int], ...]:
    """(least, largest) sizes; a set also joins the band below if its smallest partner can be there."""
    found, low = [], 1
    while low < 1 << 40:
        high = max(low, low * 3 // 2)
        found.append((low, high))
        low = high + 1
    return tuple(found)


def plan(band: int) -> tuple[bool, int]:
    """(with one deletion, number of segments) of a band."""
    if band not in PLANS:
        PLANS[band] = cheapest_plan(*bands()[band])
    return PLANS[band]


def cheapest_plan(low: int, high: int) -> tuple[bool, int]:
    bound = (high + larger_partner(high)) // NINTH
    if bound == 0:
        return False, 1

    def used(m: int, least: int) -> float:
        """Segments expected to hold at least ``least`` of ``low`` shingles."""
        x = low / m
        return m * (1 - math.exp(-x) * (1 if least == 1 else 1 + x))

    def choose(need: float, least: int) -> int | None:
        if need <= 1:
            return 1
        aim = min(1.1 * need + 1, 0.85 * low if least == 1 else max(need, 0.3 * low))
        return next((m for m in range(need, 2 * low) if used(m, least) >= aim), None) if aim >= need else None

    plain, deleted = choose(bound + 1, 1), choose((bound + 2) // 2, 2)
    if plain is None:
        return True, deleted or 1
    x = low / plain
    cost = plain + WEAK_COST * plain * x * math.exp(-x)
    if deleted is not None:
        y = low / deleted
        if low + deleted + WEAK_COST * deleted * y * y * math.exp(-y) < cost:
            return True, deleted
    return False, plain


class Sets:
    """Distinct shingles of the documents of a block, in a row, by document and hash."""

    def __init__(self, texts: list[bytes | None]) -> None:
        words, counts = split_words(texts, lower=True)
        starts = np.cumsum(counts) - counts
        keep = inside(counts, SHINGLE_WORDS)
        hashes = [window_hashes(words, SHINGLE_WORDS)[keep]]
        docs = [owners(counts)[: len(keep)][keep]]
        for length in range(1, SHINGLE_WORDS):  # shorter texts are one shingle
            short = np.flatnonzero(counts == length)
            if len(short):
                value = window_hashes(words, length)[starts[short]]
                hashes.append(mix(value, np.full(len(value), length, np.uint64)))
                docs.append(short)
        h, d = np.concatenate(hashes), np.concatenate(docs)
        if len(hashes) > 1:
            order = np.argsort(d, kind="stable")
            h, d = h[order], d[order]
        ends = np.searchsorted(d, np.arange(len(texts) + 1)).tolist()
        for a, b in zip(ends, ends[1:]):
            h[a:b].sort()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        self.h, self.d = h[new], d[new]
        self.n = np.bincount(self.d, minlength=len(texts))
        self.start = np.cumsum(self.n) - self.n
        self.id = mix(self.total(mix(self.h, np.full(len(self.h), 11, np.uint64))),
                      self.total(mix(self.h, np.full(len(self.h), 12, np.uint64))) ^ self.n.astype(np.uint64))

    def total(self, values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
        return sums[self.start + self.n] - sums[self.start]

    def of(self, doc: int) -> np.ndarray:
        return self.h[self.start[doc]:self.start[doc] + self.n[doc]]

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted ids of the sets of this block, a document with each); empty sets have no class."""
        full = np.flatnonzero(self.n)
        ids, first = np.unique(self.id[full], return_index=True)
        return ids, full[first]

    def parity(self, doc: int) -> bytes:
        """Of each bucket whether it holds an odd number of shingles, one bit, with two to four buckets a shingle. Two sets' bits
        differ in at most as many places as the sets in shingles, also after buckets are put together by exclusive or."""
        bits = max(MIN_PARITY_BITS, int(self.n[doc]).bit_length() + 1)
        at = (self.of(doc) >> np.uint64(64 - bits)).astype(np.int64)
        return np.packbits(np.bincount(at, minlength=1 << bits).astype(np.uint8) & 1).tobytes()


class Entries:
    """Index entries of some documents of a block: key, document, unit (segment) and what the unit is for."""

    def __init__(self, sets: Sets, docs: np.ndarray) -> None:
        lows = np.array([low for low, _ in bands()])
        highs = np.array([high for _, high in bands()])
        own = np.searchsorted(lows, sets.n[docs], "right") - 1
        below = own - 1
        also = (below >= 0) & (sets.n[docs] <= larger_partner(highs[np.maximum(below, 0)]))
        self.parts: dict[str, list[np.ndarray]] = {c: [] for c in ("key", "doc", "unit", "group", "usable")}
        self.needed: list[np.ndarray] = []  # units a group must ask in; 0 for a group cut again
        self.n_units = self.n_groups = 0
        for band in range(int(own.max()) + 1 if len(own) else 0):
            members = docs[(own == band) | (also & (below == band))]
            attempt = 0
            while len(members):
                members = members[~self.cut(sets, members, band, attempt)]
                attempt += 1
        join = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in self.parts.items()}
        self.key, self.doc, self.unit = join["key"].astype(np.uint64), join["doc"], join["unit"]
        self.group, self.usable = join["group"], join["usable"].astype(bool)
        self.need = np.concatenate(self.needed) if self.needed else np.zeros(0, np.int64)

    def cut(self, sets: Sets, docs: np.ndarray, band: int, attempt: int) -> np.ndarray:
        """List the documents under one cut; which of them have the segments they need."""
        deletion, m = plan(band)
        n = sets.n[docs]
        partner = np.minimum(larger_partner(n), larger_partner(bands()[band][1]))
        need = (n + partner) // NINTH + 1
        if deletion:
            need = (need + 1) // 2
        at = np.repeat(np.cumsum(n) - n, n)
        which = np.arange(int(n.sum())) - at + np.repeat(sets.start[docs], n)
        local = np.repeat(np.arange(len(docs)), n)
        seed = np.uint64(1 + attempt + (band << 8))
        value = mix(sets.h[which], np.full(len(which), seed, np.uint64))
        segment = local * m + (value % np.uint64(m)).astype(np.int64)
        value = mix(value, np.full(len(value), 13, np.uint64))
        order = np.argsort(segment, kind="stable")
        segment, value = segment[order], value[order]
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        size = np.diff(np.append(first, len(segment)))
        sums = np.add.reduceat(value, first)
        unit = segment[first]
        usable = size >= (2 if deletion else 1)
        enough = np.bincount((unit // m)[usable], minlength=len(docs)) >= need
        name = (seed << np.uint64(32)) + (unit % m).astype(np.uint64)
        keys, units, good = [mix(sums, name)], [unit], [usable]
        if deletion:
            inner = np.repeat(np.arange(len(first)), size)
            several = size[inner] > 1
            inner = inner[several]
            keys.append(mix(sums[inner] - value[several], name[inner]))
            units.append(unit[inner])
            good.append(usable[inner])
        unit = np.concatenate(units)
        self.parts["key"].append(np.concatenate(keys).view(np.int64))
        self.parts["doc"].append(docs[unit // m])
        self.parts["unit"].append(unit + self.n_units)
        self.parts["group"].append(unit // m + self.n_groups)
        self.parts["usable"].append(np.concatenate(good))
        self.needed.append(np.where(enough, need, 0))
        self.n_units += m * len(docs)
        self.n_groups += len(docs)
        return enough

    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct keys, documents under each, place of every entry)."""
        order, group = same_keys(self.key)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.empty(len(order), np.int64)
        place[order] = group
        return self.key[order][first], np.bincount(group, minlength=len(first)).astype(np.uint32), place

    def asked(self, lengths: np.ndarray) -> np.ndarray:
        """Which entries their document asks in, given the list length of every entry: those of the rarest units."""
        units, place = np.unique(self.unit, return_inverse=True)
        cost = np.bincount(place, weights=lengths.astype(np.float64) - 1)
        first = np.unique(place, return_index=True)[1]
        group, usable = self.group[first], self.usable[first]
        order = np.lexsort((np.where(usable, cost, np.inf), group))
        rank = np.arange(len(order)) - np.searchsorted(group[order], group[order])
        chosen = np.zeros(len(units), bool)
        chosen[order] = (rank < self.need[group[order]]) & usable[order]
        return chosen[place]


MEMBER = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
    T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("parity", T.BinaryType()),
    T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("asks", T.ArrayType(T.BooleanType()))])


def list_sets(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``text_hash``, ``n_shingles`` and ``set_id``; for one document of each set that may have a partner also its
    ``text``, bucket parities and shared index ``keys``, with ``asks`` for those it asks in. Staged."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    blocks = count_blocks(docs)
    shards = max(1, blocks // 4)
    dealt = deal(docs, blocks)

    def classes(table):
        ids, _ = Sets(texts_of(table)).classes()
        return ids, np.full(len(ids), table.column("_block")[0].as_py(), np.int32)

    def owner(keys, block):
        """The lowest block with a set answers for it."""
        order, group = same_keys(keys)
        least = np.minimum.reduceat(block[order], np.flatnonzero(np.diff(group, prepend=-1)))
        out = np.empty(len(keys), bool)
        out[order] = block[order] == least[group]
        return out

    def entries(table, answer):
        sets = Sets(texts_of(table))
        _, first = sets.classes()
        return Entries(sets, first[np.frombuffer(answer, bool)]).index()[:2]

    def lengths(keys, counts):
        return np.minimum(shard_sums(keys, counts), 255).astype(np.uint8)

    def listed(table, answer):
        texts = texts_of(table)
        sets = Sets(texts)
        _, first = sets.classes()
        found = Entries(sets, first[np.frombuffer(answer[: len(first)], bool)])
        length = np.frombuffer(answer[len(first):], np.uint8)[found.index()[2]]
        asked = found.asked(length)
        shared = length > 1
        stays = np.zeros(len(texts), bool)
        # A document cut again may be met under its first cuts, where it does not ask.
        stays[found.doc[shared & (asked | (found.need[found.group] == 0))]] = True
        rows = shared & stays[found.doc]
        order = np.argsort(found.doc[rows], kind="stable")
        doc, key, ask_ = found.doc[rows][order], found.key[rows][order].view(np.int64), asked[rows][order]
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        at = np.flatnonzero(stays)
        columns = {name: [None] * len(texts) for name in ("text", "parity", "keys", "asks")}
        for i in at.tolist():
            columns["text"][i] = texts[i]
            columns["parity"][i] = sets.parity(i)
            columns["keys"][i] = key[ends[i]:ends[i + 1]]
            columns["asks"][i] = ask_[ends[i]:ends[i + 1]]
        return pa.table({
            "doc_id": table.column("doc_id"), "text_hash": table.column("text_hash"), "n_shingles": pa.array(sets.n),
            "set_id": pa.array(sets.id.view(np.int64), mask=sets.n == 0),
            "text": pa.array(columns["text"], pa.binary()).cast(pa.string()),
            "parity": pa.array(columns["parity"], pa.binary()), "keys": pa.array(columns["keys"], pa.list_(pa.int64())),
            "asks": pa.array(columns["asks"], pa.list_(pa.bool_()))})

    owned = ask(dealt, classes, owner, np.dtype(np.int32), shards)
    counted = ask(dealt, entries, lengths, np.dtype(np.uint32), shards, before=owned)
    both = owned.withColumn("shard", F.col("shard") - shards).unionByName(counted)
    return stage(finish(dealt, both, listed, MEMBER), "jaccard-sets")


def folded(parity: bytes, size: int) -> np.ndarray:
    """Parities of ``size`` bytes of buckets, from as many or more. Both are powers of two; neighbours are put together."""
    bits = np.frombuffer(parity, np.uint8)
    if len(bits) == size:
        return bits
    return np.packbits(np.bitwise_xor.reduce(np.unpackbits(bits).reshape(size * 8, -1), axis=1))


def beside(pairs: DataFrame, members: DataFrame, *columns: str) -> DataFrame:
    """The pairs with the named columns of both sets, as ``set_a`` and ``set_b``."""
    those = members.select(F.col("set_id").alias("_id"), F.struct(F.col("n_shingles").alias("n"), *columns).alias("_set"))
    return (pairs.join(those.withColumnRenamed("_set", "set_a"), F.col("a") == F.col("_id")).drop("_id")
            .join(those.withColumnRenamed("_set", "set_b"), F.col("b") == F.col("_id")).drop("_id"))


def kept_rows(batch: pa.RecordBatch, keep: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])


def verify(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of set ids that link: by bucket parities first, then those left by the shingles of both texts."""

    def close(batches):
        for batch in batches:
            a, b = ([batch.column(c).field(f) for f in ("n", "parity")] for c in ("set_a", "set_b"))
            sizes = [x[0].to_numpy(zero_copy_only=False) for x in (a, b)]
            most = ((sizes[0] + sizes[1]) // NINTH).tolist()
            keep = []
            for i in range(batch.num_rows):
                x, y = a[1][i].as_py(), b[1][i].as_py()
                least = min(len(x), len(y))
                if np.bitwise_count(folded(x, least) ^ folded(y, least)).sum() <= most[i]:
                    keep.append(i)
            yield kept_rows(batch, keep)

    def link(batches):
        last, mine = None, None
        for batch in batches:
            a, b = (batch.column(c).field("text") for c in ("set_a", "set_b"))
            keep = []
            for i in range(batch.num_rows):
                text = a[i].as_py()
                if text != last:
                    last, mine = text, Sets([text.encode()]).h
                other = Sets([b[i].as_py().encode()]).h
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if 100 * both >= 80 * (len(mine) + len(other) - both):
                    keep.append(i)
            yield kept_rows(batch, keep)

    # Staged, so that no task holds the Python workers of both steps.
    left = stage(beside(pairs, members, "parity").mapInArrow(close, "a long, b long"), "jaccard-near")
    return beside(left, members, "text").mapInArrow(link, "a long, b long")


def sketch(parity: bytes, n: int) -> bytes:
    """The parities with one or two buckets a shingle, and ``SKETCH`` bytes at most."""
    size = min(len(parity), SKETCH, max(1 << MIN_PARITY_BITS, 1 << int(n).bit_length()) // 8)
    return folded(parity, size).tobytes()


def near(key: int, rows: pa.StructArray) -> list[tuple[int, int]]:
    """Pairs of one list that are of different components, asked for, and not excluded by size or sketch.

    ``first`` holds the smallest keys of a set, a fixed number, ``turns`` in which of them it asks. Where two sets have such a key
    in common in which one asks, both are in its list, and the smallest of these alone gives the pair; other pairs are given in
    every list that they share."""
    n, label, asked, chunk, name = (
        rows.field(c).to_numpy(zero_copy_only=False) for c in ("n", "label", "asks", "chunk", "set_id"))
    first, turns = (rows.field(c).flatten().to_numpy(zero_copy_only=False) for c in ("first", "turns"))
    ends = np.concatenate([[0], np.cumsum(rows.field("first").value_lengths().to_numpy())])
    bits = rows.field("sketch").to_pylist()
    least = min(map(len, bits))  # longer ones are folded to the shortest
    bits = np.stack([folded(b, least) for b in bits])
    two = len(np.unique(chunk)) > 1
    found = []
    for i in range(len(n) - 1):
        rest = np.arange(i + 1, len(n))
        rest = rest[(label[rest] != label[i]) & (asked[rest] | asked[i]) & (n[rest] * 5 >= n[i] * 4) & (n[i] * 5 >= n[rest] * 4)]
        if two:
            rest = rest[chunk[rest] != chunk[i]]
        if len(rest):
            apart = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1, dtype=np.int64)
            mine = slice(ends[i], ends[i + 1])
            for j in rest[apart <= (n[rest] + n[i]) // NINTH].tolist():
                other = slice(ends[j], ends[j + 1])
                common, x, y = np.intersect1d(first[mine], first[other], assume_unique=True, return_indices=True)
                common = common[turns[mine][x] | turns[other][y]]
                if not len(common) or common[0] == key:
                    found.append((min(name[i], name[j]), max(name[i], name[j])))
    return found


def open_entries(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries of the lists in which someone asks and that hold more than one component, with their labels. Staged."""
    labelled = entries.withColumn("label", F.col("set_id"))
    if labels is not None:
        labelled = entries.drop("label").join(labels, F.col("set_id") == F.col("node"), "left").select(
            "key", "asks", "set_id", "n", F.coalesce("label", "set_id").alias("label"))
    lists = labelled.groupBy("key").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), F.max("asks").alias("_asks"))
    return stage(labelled.join(lists.where("_low <> _high AND _asks").select("key"), "key"), "jaccard-entries")


def hub_pairs(entries: DataFrame, turn: int) -> DataFrame:
    """Each entry with its list's hub, where the two are of different components and sizes allow a link."""
    order = F.col("set_id") if turn == 0 else F.xxhash64("set_id", F.lit(turn))
    hubs = entries.groupBy("key").agg(F.min_by(F.struct("set_id", "n", "label"), order).alias("hub"))
    return entries.join(hubs, "key").where(
        (F.col("label") != F.col("hub.label")) & (F.col("n") * 5 >= F.col("hub.n") * 4)
        & (F.col("hub.n") * 5 >= F.col("n") * 4)).select(
        F.col("hub.set_id").alias("a"), F.col("set_id").alias("b")).distinct()


def cross_pairs(entries: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of sets in different components that share a list in which one of them asks.

    An entry carries a sketch and a few keys of its set, of fixed size, so an index of k entries moves k rows of that size."""
    chunks = entries.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_chunks"))
    own = F.slice(F.array_sort(F.collect_list(F.struct("key", "asks"))), 1, FIRST_KEYS)
    first = entries.groupBy("set_id").agg(own.alias("_own")).select(
        "set_id", F.col("_own.key").alias("first"), F.col("_own.asks").alias("turns"))

    def shrink(batches):
        for batch in batches:
            sketches = [sketch(b.as_py(), n) for b, n in zip(batch.column("parity"), batch.column("n_shingles").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sketches, pa.binary())], names=["_id", "sketch"])

    sketches = members.select(F.col("set_id").alias("_id"), "n_shingles", "parity").mapInArrow(shrink, "_id long, sketch binary")
    profiles = first.join(sketches, F.col("set_id") == F.col("_id")).drop("_id")
    rows = entries.join(chunks, "key").join(profiles, "set_id")
    chunk = F.pmod(F.xxhash64("set_id"), F.col("_chunks")).cast("int")
    # A list of several chunks is compared chunk by chunk, each pair of chunks by itself.
    rows = rows.withColumn("_chunk", chunk).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).select(
        "key", F.least("_chunk", "_other").alias("_i"), F.greatest("_chunk", "_other").alias("_j"),
        F.struct("n", "label", "asks", F.col("_chunk").alias("chunk"), "sketch", "first", "turns", "set_id").alias("row"))
    groups = rows.groupBy("key", "_i", "_j").agg(F.collect_list("row").alias("rows")).where(F.size("rows") > 1)

    def compare(batches):
        for batch in batches:
            found = []
            for key, rows in zip(batch.column("key").to_pylist(), batch.column("rows")):
                found += near(key, rows.values)
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return groups.select("key", "rows").mapInArrow(compare, "a long, b long").distinct()


def link_sets(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verified links ``a``, ``b`` that span every component, labels ``node``, ``label``)."""
    members = found.where("keys IS NOT NULL")
    entries = members.select(
        "set_id", F.col("n_shingles").alias("n"), F.explode(F.arrays_zip("keys", "asks")).alias("_e")).select(
        F.col("_e.keys").alias("key"), F.col("_e.asks").alias("asks"), "set_id", "n")
    links = labels = None
    for turn in range(HUB_ROUNDS + 1):
        entries = open_entries(entries, labels)  # lists of one component are done with
        pairs = hub_pairs(entries, turn) if turn < HUB_ROUNDS else cross_pairs(entries, members)
        more = stage(verify(pairs, members), "jaccard-links")
        links = more if links is None else links.unionByName(more)
        if labels is None or not more.isEmpty():
            labels = stage(connect(links), "jaccard-labels")
    return links, labels


def find_components(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``label`` (one per component).

    A-Z are lower-cased. A document's set holds its distinct 5-word shingles, or its whole sequence if it has fewer
    words; NULL texts and texts without words have an empty set and are linked with nothing (label NULL).
    Documents link when 100 * intersection >= 80 * union. ``component_id`` is the smallest id that links
    lead to; a NULL id only where all are NULL. Repeated rows are of one component. Other columns are not used.
    """
    found = list_sets(docs)
    _, labels = link_sets(found)
    sets = found.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("_least"))
    sets = sets.join(labels, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "_least", F.coalesce("label", "set_id").alias("label"))
    least = sets.groupBy("label").agg(F.min("_least").alias("component_id"))
    classes = sets.join(least, "label").select(F.col("set_id").alias("_id"), "component_id", "label")
    rows = found.select("doc_id", "text_hash", "n_shingles", "set_id")
    with_set = rows.where("set_id IS NOT NULL").join(classes, F.col("set_id") == F.col("_id")).drop("_id", "set_id")
    without = rows.where("set_id IS NULL").drop("set_id").withColumns(
        {"component_id": F.col("doc_id"), "label": F.lit(None).cast("long")})
    return with_set.unionByName(without)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest id, with its own columns, whatever their names.

    Texts without words all stay.
    """
    docs, own = step_aside(docs, ("_id", "_hash"))
    rows = stage(find_components(docs).where("label IS NOT NULL").groupBy("label", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("copies")), "jaccard-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = rows.groupBy("label").agg(F.min(rank).alias("_kept"))
    judged = rows.join(kept, "label").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), (rank == F.col("_kept")).alias("_stays"), "copies")
    listed = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    # Rows to drop, and kept rows that are there several times: these are made one and added again.
    aside = broadcast_if_small(judged.where("NOT _stays OR copies > 1").select("_id", "_hash"))
    repeated = broadcast_if_small(judged.where("_stays AND copies > 1").select("_id", "_hash"))
    return docs.join(aside, listed, "left_anti").unionByName(
        docs.join(repeated, listed, "left_semi").dropDuplicates(["doc_id", "text"])).withColumnsRenamed(own)


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents with the component of their set."""
    return find_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


ship_with_tasks(__name__)
