"""Remove passages that an earlier document holds: relative Lempel-Ziv parsing against an indexed corpus.

The reference of a document is every document with a smaller id. Its index is cut into reference
blocks, the shards, each holding for its share of all windows the smallest document with that window.
A document is parsed from left to right: where the window at a word is found in a reference block, a
factor begins, and it grows word by word as long as the next window is found there too. Windows that straddle
the boundary of two factors are looked up like all others, so nothing is lost where one factor ends and the
next begins. Factors are at least one window long; shorter matches are never looked for.

Only windows that can have a partner are indexed. Each window names an anchor, the smallest hash of the
8-word grams in it. Equal windows have equal anchors, so windows whose anchor occurs in one document only are
left out, exactly; anchors are about a twentieth of all words.
"""

from __future__ import annotations

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
    ids_of,
    inside,
    mix,
    owners,
    shard_sums,
    split_words,
    texts_of,
    window_hashes,
)

WINDOW_WORDS = 50
ANCHOR_WORDS = 8
FACTOR = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("words", T.LongType()),
    T.StructField("reference", T.LongType())]))
OWNER = np.dtype([("check", np.uint32), ("doc", np.int64)])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, level = 1, values
    while size * 2 <= width:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    return np.minimum(level[: len(values) - width + 1], level[width - size:]) if len(values) >= width else values[:0]


class Windows:
    """All windows of the documents of a block."""

    def __init__(self, table: pa.Table, width: int) -> None:
        self.width, self.ids = width, ids_of(table)
        self.words, self.counts = split_words(texts_of(table), lower=False)
        gram = min(ANCHOR_WORDS, width)
        keep = inside(self.counts, width)
        self.at = np.flatnonzero(keep)
        self.doc = owners(self.counts)[self.at]
        self.anchor = sliding_min(window_hashes(self.words, gram), width - gram + 1)[self.at]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct anchors, documents of this block that hold each)."""
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.doc[1:] != self.doc[:-1])
        anchor, doc = self.anchor[new], self.doc[new]
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        once = np.ones(len(anchor), bool)
        once[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        keys, counts = np.unique(anchor[once], return_counts=True)
        return keys, counts.astype(np.uint32)

    def shared(self, keys: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Indexes of the windows whose anchor is flagged."""
        if not flags.any():
            return np.zeros(0, np.int64)
        return np.flatnonzero(flags[np.searchsorted(keys, self.anchor)])

    def index(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct keys, their checks and smallest ids, place of each of ``some`` among them)."""
        if not len(some):
            return np.zeros(0, np.uint64), np.zeros(0, OWNER), some
        at = self.at[some]
        key = window_hashes(self.words, self.width)[at]
        other = mix(self.words, np.full(len(self.words), 0x5851F42D4C957F2D, np.uint64))
        check = (window_hashes(other, self.width)[at] >> np.uint64(32)).astype(np.uint32)
        order, group = same_windows(key, check)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        owner = np.empty(len(first), OWNER)
        owner["check"] = check[order][first]
        owner["doc"] = np.minimum.reduceat(self.ids[self.doc[some]][order], first)
        place = np.empty(len(some), np.int64)
        place[order] = group
        return key[order][first], owner, place


def same_windows(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((check, key))
    k, c = key[order], check[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return order, np.cumsum(new) - 1


def remove_earlier_passages(docs: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` and ``factors``.

    Words are runs without ASCII white space, unchanged. A word is removed if a window of
    ``window_words`` consecutive words of its document covers it that also occurs in a document with a
    smaller id; windows are judged on the input. ``kept_text`` joins the other words by one space.
    ``factors`` lists the parse: first word, length in words and the smallest document that holds the
    factor's windows. Rows with equal ids hold nothing earlier for each other. A NULL id is larger than any
    other. NULL, empty or short texts keep all their words; other columns of ``docs`` are not used.
    """
    docs = docs.select("doc_id", "text")
    blocks = count_blocks(docs)
    shards = max(1, blocks // 4)
    dealt = deal(docs, blocks)

    def anchors(table):
        return Windows(table, window_words).anchors()

    def twice(keys, counts):
        return shard_sums(keys, counts) >= 2

    def windows(table, answer):
        found = Windows(table, window_words)
        keys, _ = found.anchors()
        return found.index(found.shared(keys, np.frombuffer(answer, bool)))[:2]

    def smallest(keys, values):
        order, group = same_windows(keys, values["check"])
        least = np.minimum.reduceat(values["doc"][order], np.flatnonzero(np.diff(group, prepend=-1)))
        out = np.empty(len(keys), np.int64)
        out[order] = least[group]
        return out

    def parse(table, answer):
        found = Windows(table, window_words)
        keys, _ = found.anchors()
        some = found.shared(keys, np.frombuffer(answer[: len(keys)], bool))
        place = found.index(some)[2]
        owner = np.frombuffer(answer[len(keys):], np.int64)[place]
        earlier = owner < found.ids[found.doc[some]]
        at, doc, owner = found.at[some][earlier], found.doc[some][earlier], owner[earlier]
        return factored(table, found, at, doc, owner, window_words)

    shared = ask(dealt, anchors, twice, np.dtype(np.uint32), shards)
    owned = ask(dealt, windows, smallest, OWNER, shards, before=shared)
    # Answers on anchors first, then those on windows.
    both = shared.withColumn("shard", F.col("shard") - shards).unionByName(owned)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
                           T.StructField("factors", FACTOR)])
    return finish(dealt, both, parse, schema)


def factored(table: pa.Table, found: Windows, at: np.ndarray, doc: np.ndarray, owner: np.ndarray,
             width: int) -> pa.Table:
    """Output rows, given the windows that an earlier document holds: first word, row, that document."""
    total = len(found.words)
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    covered = np.cumsum(steps)[:total] > 0
    starts = np.concatenate([[0], np.cumsum(found.counts)])
    begins = np.ones(len(at), bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(begins)
    lengths = np.diff(np.append(first, len(at))) + width - 1
    factors: list[list[dict]] = [[] for _ in range(table.num_rows)]
    for row, start, length, reference in zip(doc[first].tolist(), (at[first] - starts[doc[first]]).tolist(),
                                             lengths.tolist(), owner[first].tolist()):
        factors[row].append({"start": start, "words": length, "reference": reference})
    kept, removed = [], []
    for row, text in enumerate(texts_of(table)):
        words, gone = (text or b"").split(), covered[starts[row]:starts[row + 1]]
        n = int(gone.sum())
        kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if n else words))
        removed.append(n)
    return pa.table({
        "doc_id": table.column("doc_id"), "n_words": pa.array(found.counts), "n_removed": pa.array(removed, pa.int64()),
        "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
        "factors": pa.array(factors, pa.list_(pa.struct([
            ("start", pa.int64()), ("words", pa.int64()), ("reference", pa.int64())]))),
    })


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents: words, words removed and a digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_earlier_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"),
        F.size("factors").cast("long").alias("n_factors"))


ship_with_tasks(__name__)
