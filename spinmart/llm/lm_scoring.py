"""Score texts by a bigram model, a backoff automaton learned from the corpus itself.

Every known word is a state, and there is a root. From the state of word u, an arc for each word w that
followed u in training leads to the state of w, with weight
``log10(BIGRAM c(uw)/c(u) + (1 - BIGRAM) p(w))``. A failure arc with weight ``log10(1 - BIGRAM)`` leads to the
root, which has an arc ``log10 p(w)`` for every word; an unknown word leads to the root itself. ``p(w)`` is the
add-one unigram probability with one place for unknown words, so the weights out of a state sum to one.
A text is one walk from left to right from the start state to the end token; its score is the sum of
the weights.

The automaton of a large corpus fits nowhere whole. Its arcs and states are kept in shards by hash; a
block of documents sends the words and word pairs it holds, once each, with its training counts, and gets the
corpus counts back: the part of the automaton that its walks can touch.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinmart.llm import ship_with_tasks
from spinmart.llm.blocks import (
    ask,
    count_blocks,
    deal,
    finish,
    hash_all,
    mix,
    questions,
    same_keys,
    shard_sums,
    split_words,
    texts_of,
    unpack,
    unplanes,
)

# Share of the bigram in a state's arcs.
BIGRAM = 0.2
FOLDS, HELD_OUT = 7, 2
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out_rows(table: pa.Table, folds: int, held_out: int) -> np.ndarray:
    ids = ["" if x is None else str(x) for x in table.column("doc_id").to_pylist()]
    return np.fromiter((zlib.crc32(x.encode()) % folds == held_out for x in ids), bool, len(ids))


class Tokens:
    """Tokens of a block: for each text its words and one end. ``before`` is the state's word or the start."""

    def __init__(self, table: pa.Table, folds: int, held_out: int) -> None:
        words, n = split_words(texts_of(table), lower=True)
        self.counts = n + 1
        ends = np.cumsum(self.counts) - 1
        self.start, self.end = hash_all([b" start", b" end"])  # no word holds a space
        total = int(self.counts.sum())
        is_word = np.ones(total, bool)
        is_word[ends] = False
        self.word = np.full(total, self.end, np.uint64)
        self.word[is_word] = words
        self.before = np.empty(total, np.uint64)
        self.before[1:] = self.word[:-1]
        self.before[ends - n] = self.start
        self.first = ends - n
        self.held = held_out_rows(table, folds, held_out)
        self.train = ~np.repeat(self.held, self.counts)
        self.pair = mix(self.before, self.word)


def add_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, sum of each, place of every entry)."""
    order, group = same_keys(keys)
    place = np.empty(len(keys), np.int64)
    place[order] = group
    first = np.flatnonzero(np.diff(group, prepend=-1))
    sums = np.bincount(group, weights=values[order], minlength=len(first)) if len(keys) else np.zeros(0)
    return keys[order][first], sums.astype(np.uint32), place


def training_size(docs: DataFrame, shards: int, folds: int = FOLDS, held_out: int = HELD_OUT) -> tuple[int, int]:
    """(tokens, distinct tokens) of the training texts."""

    def count(batches):
        for batch in batches:
            tokens = Tokens(pa.Table.from_batches([batch]), folds, held_out)
            keys, counts, _ = add_up(tokens.word[tokens.train], np.ones(int(tokens.train.sum())))
            yield from questions(0, keys, counts, shards).to_batches()

    def total(table):
        keys = np.concatenate([unpack(x) for x in table.column("keys").to_pylist()])
        n = sum(int(np.frombuffer(unplanes(x), np.uint32).sum(dtype=np.int64)) for x in table.column("extra").to_pylist())
        return pa.table({"n": pa.array([n], pa.int64()), "v": pa.array([len(np.unique(keys))], pa.int64())})

    sums = (docs.select("doc_id", "text").mapInArrow(count, "shard int, block int, keys binary, extra binary")
            .groupBy("shard").applyInArrow(total, "n long, v long").agg(F.sum("n"), F.sum("v")).first())
    return sums[0] or 0, sums[1] or 0


def score_texts(docs: DataFrame, bigram: float = BIGRAM, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model learns from rows whose crc32 of the id as text is not ``held_out`` modulo ``folds`` (a NULL id
    counts as an empty text). A-Z are lower-cased; tokens are the words and one end per text. ``base_score``
    is the text under the add-one unigrams alone, ``score`` under the automaton, both log10. ``n_known``
    counts the tokens seen in training. A NULL or empty text has one token, the end. With no training rows
    every token is unknown and has probability one. Repeated rows are scored and counted each.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = count_blocks(docs)
    shards = max(1, blocks // 2)  # a block has more word pairs than other keys
    n_train, n_distinct = training_size(docs, shards, folds, held_out)
    dealt = deal(docs, blocks)

    def grams(tokens):
        """Distinct words and pairs with training counts, and the place of each token's word, state and pair."""
        total = len(tokens.word)
        keys, counts, place = add_up(np.concatenate([tokens.word, tokens.pair, tokens.before[tokens.first]]),
                                     np.concatenate([tokens.train, tokens.train, ~tokens.held]).astype(np.float64))
        return keys, counts, place[:total], place[total:2 * total], place[2 * total:]

    def question(table):
        return grams(Tokens(table, folds, held_out))[:2]

    def walk(table, answer):
        tokens = Tokens(table, folds, held_out)
        _, _, word, pair, start = grams(tokens)
        counts = np.frombuffer(answer, np.int64)
        seen = counts[word]
        state = np.empty(len(word), np.int64)
        state[1:] = seen[:-1]
        state[tokens.first] = counts[start]
        unigram = (seen + 1) / (n_train + n_distinct + 1)
        followed = np.divide(counts[pair], state, out=np.zeros(len(word)), where=state > 0)
        weight = np.where(state > 0, bigram * followed + (1 - bigram) * unigram, unigram)

        def per_text(values):
            return np.add.reduceat(values, tokens.first) if len(values) else values

        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": pa.array(tokens.held), "n_tokens": pa.array(tokens.counts),
            "n_known": pa.array(per_text((seen > 0).astype(np.int64))),
            "base_score": pa.array(per_text(np.log10(unigram))), "score": pa.array(per_text(np.log10(weight))),
        })

    answers = ask(dealt, question, shard_sums, np.dtype(np.uint32), shards)
    return finish(dealt, answers, walk, SCORE).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score", "score")


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """All documents under the model of the training part of the same table."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ship_with_tasks(__name__)
