"""Drop lines found in many documents: a sharded minimal perfect hash with count arrays.

Every document's distinct lines are hashed. Shards, each a range of hash values, build a minimal perfect
hash (MPH) over their distinct line hashes; it indexes two compact arrays, a 32-bit fingerprint and the number
of documents. Blocks of documents probe these arrays with their own line hashes and read counts back, so
no line is joined and no line text leaves its document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks
from spinmart.llm.blocks import ask, count_blocks, deal, finish, hash_all, mix, same_keys, texts_of
from spinmart.llm.names import step_aside

MIN_DOCUMENTS = 10
MIN_CHARS = 1


class LineIndex:
    """Minimal perfect hash of distinct 64-bit line hashes over fingerprint and count arrays.

    Level by level, keys hash into a bit array of ``GAMMA`` bits per key; a key alone in its bit is
    settled, the others go on. The rank of the bit is the key's place in the arrays.
    """

    GAMMA = 2.0

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (bits, ranks before each bit)
        left, settled = keys, 0
        while len(left):
            at = self.place(left, len(self.levels), int(self.GAMMA * len(left)) + 1)
            bits = np.bincount(at, minlength=int(self.GAMMA * len(left)) + 1) == 1
            rank = np.cumsum(bits) - bits + settled
            self.levels.append((bits, rank))
            settled += int(bits.sum())
            left = left[~bits[at]]
        self.fingerprints = np.zeros(len(keys), np.uint32)
        self.counts = np.zeros(len(keys), np.int64)
        at = self.slots(keys)
        self.fingerprints[at] = self.fingerprint(keys)
        self.counts[at] = counts

    @staticmethod
    def place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (mix(keys, np.full(len(keys), level + 1, np.uint64)) % np.uint64(bits)).astype(np.int64)

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mix(keys, np.zeros(len(keys), np.uint64)) >> np.uint64(32)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the arrays; -1 for a key that no level settles."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(self.levels):
            at = self.place(keys[open_], level, len(bits))
            hit = bits[at]
            found[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return found

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Documents per key; 0 where the fingerprint differs."""
        at = self.slots(keys)
        known = (at >= 0) & (self.fingerprints[at] == self.fingerprint(keys)) if len(self.counts) else at >= 0
        return np.where(known, self.counts[at] if len(self.counts) else 0, 0)


def line_keys(text: bytes | None, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """(lines, key of each line or None if it is too short)."""
    lines = (text or b"").split(b"\n")
    keys = [x.strip().lower() for x in lines]
    if min_chars <= 1:
        return lines, [k if len(k) >= min_chars else None for k in keys]
    return lines, [k if len(k.decode("utf-8", "replace")) >= min_chars else None for k in keys]


def drop_common_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` without the common lines, and ``n_lines``, ``n_dropped``.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Keys of at least
    ``min_chars`` code points found in at least ``min_documents`` documents lose their lines in every
    document; the rest is joined by line feeds. A NULL or empty text is one empty line and becomes an
    empty text. A document's own repetitions count once; repeated rows are documents of their own. All
    other columns pass unchanged, whatever their names; columns named ``n_lines`` and ``n_dropped`` are replaced by
    the result. An empty table gives an empty table.
    """
    docs, own = step_aside(docs.drop("n_lines", "n_dropped"), ("_block",))
    blocks = count_blocks(docs)
    dealt = deal(docs, blocks)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema],
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def hashes(table):
        parts = [line_keys(t, min_chars) for t in texts_of(table)]
        return parts, [hash_all([k for k in keys if k is not None]) for _, keys in parts]

    def question(table):
        _, each = hashes(table)
        each = [np.unique(h) for h in each]  # once per document
        return tuple(x.astype(t) for x, t in zip(
            np.unique(np.concatenate([np.zeros(0, np.uint64), *each]), return_counts=True), (np.uint64, np.uint32)))

    def reply(keys, counts):
        order, group = same_keys(keys)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        index = LineIndex(keys[order][first], np.bincount(group, weights=counts[order]).astype(np.int64))
        return index.probe(keys) >= min_documents

    def drop(table, answer):
        parts, each = hashes(table)
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *each]))
        common = keys[np.frombuffer(answer, bool)]
        kept, n_lines, n_dropped = [], [], []
        for (lines, names), found in zip(parts, each):
            out = iter(np.isin(found, common).tolist())
            stay = [line for line, name in zip(lines, names) if name is None or not next(out)]
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        out = {name: table.column(name) for name in table.column_names if name != "_block"}
        out["text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(out | {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())})

    answers = ask(dealt, question, reply, np.dtype(np.uint32), max(1, blocks // 4))
    return finish(dealt, answers, drop, schema).withColumnsRenamed(own)


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents: lines, dropped lines and a digest of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c USING (key)
GROUP BY doc_id
"""

ship_with_tasks(__name__)
