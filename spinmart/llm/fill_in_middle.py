"""Fill-in-middle transformation: documents cut into prefix, middle and suffix at unit ends, and put in another order.

Units are lines. A text is laid out in fixed blocks of bytes; per block two numbers are counted, the units that end in
it and its code points, and each is kept in a Fenwick tree. A cut after k units is found by binary lifting: the descent
halves its step and skips every run of blocks that holds fewer than k ends, which names the block of the cut and
the units and code points before it; the byte itself is then looked for within that one block. So a cut touches
O(log blocks) tree nodes and one block, however long the text is.

Which units are cut at, and which form a document takes, follows from a hash of the seed and its id alone; a
recomputed task gives the same rows. ``restored`` undoes the transformation from output and form.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks

BLOCK = 1 << 10
SEED = 7
OUT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])


@dataclass(frozen=True)
class Marks:
    """The marks before each piece. No end of a mark may be the start of one, or pieces could not be told apart."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        for a in marks:
            if not a or marks.count(a) > 1 or any(a in b for b in marks if b != a):
                raise ValueError("marks must be different and none a part of another")
            if any(a[-k:] == b[:k] for b in marks for k in range(1, min(len(a), len(b)))):
                raise ValueError("the end of a mark must not be the start of a mark")


class Fenwick:
    """Prefix sums over the counts of fixed blocks, with a descent to the block that a rank lies in."""

    def __init__(self, counts: np.ndarray) -> None:
        sums = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(1, len(counts) + 1)
        self.tree = np.concatenate([[0], sums[at] - sums[at & (at - 1)]]).tolist()
        self.top = 1 << len(counts).bit_length()

    def before(self, block: int) -> int:
        """Sum of the counts of the blocks before ``block``."""
        total = 0
        while block:
            total += self.tree[block]
            block &= block - 1
        return total

    def descend(self, rank: int) -> tuple[int, int]:
        """(block in which the count reaches ``rank``, sum before it); ``rank`` is 1 at least."""
        block, total, step = 0, 0, self.top
        while step:
            reached = block + step
            if reached < len(self.tree) and total + self.tree[reached] < rank:
                block, total = reached, total + self.tree[reached]
            step >>= 1
        return block, total


class Layout:
    """A text in blocks of bytes, with trees over the unit ends and the code points of each."""

    def __init__(self, text: bytes, block: int = BLOCK) -> None:
        self.data, self.block = np.frombuffer(text, np.uint8), block
        starts = np.arange(0, len(text), block)
        ends = self.data == 0x0A
        if len(text):
            ends[-1] = True  # the last unit may lack its line feed
        self.ends = ends
        self.begins = (self.data & 0xC0) != 0x80  # first bytes of code points
        counts = [np.add.reduceat(x, starts, dtype=np.int64) if len(text) else np.zeros(0, np.int64)
                  for x in (ends, self.begins)]
        self.units, self.points = map(Fenwick, counts)
        self.n = int(counts[0].sum())

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``units`` units."""
        if not units:
            return 0, 0
        block, before = self.units.descend(units)
        start = block * self.block
        end = start + int(np.flatnonzero(self.ends[start:start + self.block])[units - before - 1]) + 1
        return end, self.points.before(block) + int(np.count_nonzero(self.begins[start:end]))


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the seed and the id; a NULL id counts as an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def transform(text: bytes | None, doc_id: int | None, seed: int, rate: int, spm: int, marks: Marks,
              block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """The row of one document."""
    text = text or b""
    layout = Layout(text, block)
    h1, h2, h3, h4 = draws(seed, doc_id)
    p, s, m = (x.encode() for x in (marks.prefix, marks.suffix, marks.middle))
    if not text or any(x in text for x in (p, s, m)) or h3 % 100 >= rate:
        return layout.n, "plain", None, None, text
    low, high = sorted((h1 % (layout.n + 1), h2 % (layout.n + 1)))
    (a, a_points), (b, b_points) = layout.cut(low), layout.cut(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        form, output = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return layout.n, form, a_points, b_points - a_points, output


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = 100, spm: int = 50, marks: Marks = Marks()) -> DataFrame:
    """Per row: ``doc_id``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` percent of the documents are cut, ``spm`` percent of these are put as suffix, prefix, middle, the others as
    prefix, suffix, middle. A unit is a line with its line feed. A NULL text is an empty one; empty texts and texts that
    hold a mark stay as they are (``form`` is plain, the counts NULL). Rows are independent: repeated rows give equal
    rows, a NULL id draws by itself, an empty table gives an empty one, other columns are not used whatever their names.
    A task holds one Arrow batch; a text of any length is one of its rows.
    """
    docs = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *OUT.fields])

    def cut(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            rows = [transform(t.as_py(), i, seed, rate, spm, marks) for i, t in zip(ids, texts)]
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)

    return docs.mapInArrow(cut, schema)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output of ``fill_in_middle`` was made of, read from the marks alone."""

    def pieces(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows each of the marks ``first``, ``second`` and ``marks.middle``."""
        two, three = F.instr(output, F.lit(second)), F.instr(output, F.lit(marks.middle))
        start = len(first) + 1
        after = two + len(second)
        return (F.substr(output, F.lit(start), two - start), F.substr(output, after, three - after),
                F.substr(output, three + len(marks.middle)))

    prefix, suffix, middle = pieces(marks.prefix, marks.suffix)
    suffix_2, prefix_2, middle_2 = pieces(marks.suffix, marks.prefix)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(prefix_2, middle_2, suffix_2)).otherwise(output))


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """All documents: units, form, cuts, digests of the output and of the text rebuilt from it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS c1,
           CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS c2, CAST('0x' || h[25:32] AS BIGINT) % 100 AS kind
    FROM units
), cut AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                WHEN kind < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(lines[1:least(c1, c2)], '') AS prefix,
           array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(lines[greatest(c1, c2) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

ship_with_tasks(__name__)
