"""Byte-level BPE: merges replayed over all words of a partition at once.

The words (pattern matches) of a partition's texts are listed once each; their bytes lie in one array with links to
the neighbours. An inverted index leads from a token pair, named by the rank of its merge, to the positions where
that pair stands. Ranks are taken in order; each merge is applied at all its positions in one step, and only the
neighbours it touched get new index entries. Texts then read their tokens off word by word.

Words that occur in several partitions are encoded in each: their tokens do not depend on other words, and
a lookup table of all words would have to be moved to every text.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks

NO_MERGE = np.int64(1 << 40)
# Words remembered by a task; beyond, it starts a new list. This bounds memory and changes no result.
WORDS_KEPT = 200_000
# Bytes of text whose new words are merged together.
REPLAY_BYTES = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with one ``base64 rank`` pair per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.fromiter(pairs.values(), np.int64, len(pairs))[order]

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NO_MERGE`` if there is none."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_MERGE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_MERGE)

    def encode(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers."""
        whole = [self.ranks.get(w) for w in words]
        rest = [w for w, rank in zip(words, whole) if rank is None]
        replayed = iter(self.replay(rest))
        return [next(replayed) if rank is None else rank.to_bytes(4, "little") for rank in whole]

    def replay(self, words: Sequence[bytes]) -> list[bytes]:
        """Apply all merges in rank order to all words."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        last = np.cumsum(lengths) - 1
        after = np.arange(1, n + 1)
        after[last[lengths > 0]] = -1
        before = np.arange(-1, n - 1)
        before[(last - lengths + 1)[lengths > 0]] = -1
        alive = np.ones(n, bool)
        merge = np.full(n, NO_MERGE)  # the merge of the pair that starts here
        has = np.flatnonzero(after >= 0)
        merge[has] = self.merge_of(token[has], token[after[has]])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(positions: np.ndarray) -> None:
            ranks = merge[positions]
            positions, ranks = positions[ranks < NO_MERGE], ranks[ranks < NO_MERGE]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            starts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for rank, part in zip(ranks[starts].tolist(), np.split(positions, starts[1:])):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(heap, rank)

        add(has)
        late: list[np.ndarray] = []  # positions where a lower rank came up after a higher one
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(rank)))
            at = at[merge[at] == rank]
            if not len(at):
                continue
            # In a run of overlapping pairs (aaa) the first, third, ... are merged.
            chained = np.zeros(len(at), bool)
            chained[1:] = after[at[:-1]] == at[1:]
            if chained.any():
                place = np.arange(len(at))
                place -= np.maximum.accumulate(np.where(chained, 0, place))
                at = at[place % 2 == 0]
            gone = after[at]
            beside = np.flatnonzero(after[gone[:-1]] == at[1:])  # two merges next to each other: the left one is first
            if len(beside):
                half = self.merge_of(np.full(len(beside), rank), token[at[beside + 1]])
                late.append(at[beside[half <= rank]])
            token[at] = rank
            after[at] = after[gone]
            alive[gone] = False
            merge[gone] = NO_MERGE
            follows = after[at] >= 0
            before[after[at[follows]]] = at[follows]
            left = before[at]
            touched = np.unique(np.concatenate([at, left[left >= 0]]))
            merge[touched] = NO_MERGE
            paired = touched[after[touched] >= 0]
            merge[paired] = self.merge_of(token[paired], token[after[paired]])
            if (merge[paired] <= rank).any():
                late.append(paired[merge[paired] <= rank])
            add(paired)

        ends = np.cumsum(np.concatenate([[0], alive.astype(np.int64)]))
        stops = ends[np.cumsum(lengths)]
        data = token[alive].astype("<u4").tobytes()
        out = [data[a * 4:b * 4] for a, b in zip(np.concatenate([[0], stops[:-1]]).tolist(), stops.tolist())]
        if late:  # there the order within a word decides
            for i in np.unique(np.searchsorted(last, np.concatenate(late))).tolist():
                out[i] = self.one_word(words[i])
        return out

    def one_word(self, word: bytes) -> bytes:
        """The merge of least rank, leftmost first, until none is left."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NO_MERGE) for a, b in zip(parts, parts[1:])]
            i = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[i] == NO_MERGE:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return b"".join(self.ranks[p].to_bytes(4, "little") for p in parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


class Encoder:
    """Encodes texts batch by batch, remembering words."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.place: defaultdict[str, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.ids: list[bytes] = []

    def __call__(self, texts: Sequence[bytes | None]) -> list[bytes]:
        done, part, size = [], [], 0
        for text in texts:
            part.append(text)
            size += len(text or b"")
            if size >= REPLAY_BYTES:
                done += self.encode(part)
                part, size = [], 0
        return done + self.encode(part)

    def encode(self, texts: Sequence[bytes | None]) -> list[bytes]:
        if len(self.ids) > WORDS_KEPT:
            self.forget()
        number = self.place.__getitem__
        words = [np.array([number(w) for w in self.find((t or b"").decode("utf-8", "replace"))], np.int64) for t in texts]
        new = list(self.place)[len(self.ids):]
        self.ids += self.vocabulary.encode([w.encode() for w in new])
        ids = self.ids
        return [b"".join([ids[i] for i in w.tolist()]) for w in words]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, carry: Sequence[str] = ("doc_id",),
                 decoded: bool = False) -> DataFrame:
    """Per row: the ``carry`` columns, ``n_tokens`` and ``ids``; with ``decoded`` also the bytes the ids stand for.

    ``ids`` holds little-endian unsigned 32-bit integers. Every match of ``pattern`` is encoded by itself; there are no
    special tokens. A NULL or empty text has no tokens. A carried column named like one of the result is replaced by it. The vocabulary file is read once, on the driver, and goes to the tasks with the job (1 MB).
    """
    ranks = read_ranks(ranks_path)
    made = ("n_tokens", "ids", "decoded") if decoded else ("n_tokens", "ids")
    carry = [name for name in carry if name.lower() not in made]
    kept = docs.select(*dict.fromkeys([*carry, "text"])).schema
    schema = T.StructType([*[kept[name] for name in carry], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()),
                           *([T.StructField("decoded", T.BinaryType())] if decoded else [])])

    def encoded(batches):
        vocabulary = Vocabulary(ranks)
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            ids = encoder(batch.column("text").cast(pa.binary()).to_pylist())
            arrays = [batch.column(name) for name in carry]
            arrays += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                arrays.append(pa.array([vocabulary.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(*kept.names).mapInArrow(encoded, schema)


def decode_ids(encoded: DataFrame, ranks_path: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row: the ``carry`` columns and ``decoded``, the bytes the ``ids`` stand for; NULL ids give no bytes."""
    ranks = read_ranks(ranks_path)
    kept = encoded.select(*dict.fromkeys([*carry, "ids"])).schema
    schema = T.StructType([*[kept[name] for name in carry], T.StructField("decoded", T.BinaryType())])

    def decoded(batches):
        vocabulary = Vocabulary(ranks)
        for batch in batches:
            found = [vocabulary.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in carry] + [pa.array(found, pa.binary())], names=schema.names)

    return encoded.select(*kept.names).mapInArrow(decoded, schema)


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents: number of tokens and digests of the ids and of the decoded text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_texts(docs, path, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


ship_with_tasks(__name__)
