"""Quality classifier: kernel ridge regression on document statistics by random Fourier features, calibrated.

Each text becomes a short vector of statistics (lengths, shares of kinds of characters, repetition). Random cosines of
the standardised vector approximate a Gaussian kernel; on them a ridge regression of the label is linear, so all that it
needs of the rows are sums: every partition adds up its normal equations, one small matrix per fold, and only these
are gathered. Cosines are rounded to whole multiples of 1/4096, whose sums of products are exact integers. So the
sums, and with them the model, do not depend on how the rows are cut into partitions or which task is run again.

Raw scores are calibrated by an isotonic regression. It is fitted on scores that the model without the fold of a
document gives it, counted on a fine grid, so that no label calibrates a model that has seen it; equal texts are in
one fold. Solving and pooling happen on the driver, on matrices and grids of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinmart.llm import ship_with_tasks
from spinmart.operators.staging import stage

STATISTICS = ("log_words", "word_length", "longest_word", "symbols", "capitals", "digits", "punctuation", "marks", "markup",
              "other_bytes", "vocabulary", "most_frequent", "repeated_lines", "line_words", "letterless")
SYMBOLS, PUNCTUATION, MARKS, MARKUP = b"#$%&*|@^~", b".,;:'\"()-", b"!?", b"<>{}[]/\\=_+`"
CAPITALS, DIGITS, OTHER = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A)), bytes(range(0x80, 0x100))
LETTERLESS = bytes(range(0x21, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))

HELD_OUT, PARTS = 1, 3
FOLDS = 4
COSINES = 256
BANDWIDTH = 0.7  # of the kernel, in units of the usual distance of two standardised vectors
RIDGE = 1e-4
CLIP = 5.0
UNIT = 4096  # cosines are whole multiples of its inverse
SEED = 13
# Grid of raw scores for the calibration.
LEAST, MOST, CELLS = -0.5, 1.5, 2048


def statistics_of(text: bytes | None) -> tuple[float, ...]:
    """The vector of one text, in the order of ``STATISTICS``. NULL and empty texts are zeros."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    joined = b"".join(words)
    size = len(joined)

    def share(chars: bytes) -> float:
        return (size - len(joined.translate(None, chars))) / size

    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (np.log1p(n), size / n, np.log1p(max(map(len, counts))), share(SYMBOLS), share(CAPITALS), share(DIGITS),
            share(PUNCTUATION), share(MARKS), share(MARKUP), share(OTHER), np.log1p(len(counts)) / np.log1p(n),
            max(counts.values()) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
            sum(c for w, c in counts.items() if not w.strip(LETTERLESS)) / n)


def document_statistics(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``fold`` (equal texts share one) and ``stats``.

    NULL and empty texts have a vector of zeros. Rows are independent of each other, repeated rows stay, an empty table gives an
    empty one. Only ``doc_id`` and ``text`` are used, whatever other columns are there and however they are named.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int").alias("fold"))

    def measured(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [np.array(statistics_of(t.as_py()), np.float32) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), lists(rows)],
                                             names=["doc_id", "fold", "stats"])

    return docs.mapInArrow(measured, "doc_id long, fold int, stats array<float>")


def lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.float32()))


def vectors(column: pa.Array, width: int = len(STATISTICS)) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


@dataclass(frozen=True)
class Cosines:
    """Standardisation and the random directions; the last column is constant."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, n: int = COSINES, bandwidth: float = BANDWIDTH,
             seed: int = SEED) -> Cosines:
        pick = np.random.default_rng(seed)
        spread = bandwidth * np.sqrt(len(mean))
        return cls(mean, scale, pick.standard_normal((len(mean), n)) / spread, pick.uniform(0, 2 * np.pi, n))

    def of(self, stats: np.ndarray) -> np.ndarray:
        """Whole numbers, as floats: ``UNIT`` times each cosine, then ``UNIT``."""
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        z = np.rint(UNIT * np.cos(x @ self.directions + self.phases))
        return np.hstack([z, np.full((len(z), 1), float(UNIT))])


@dataclass(frozen=True)
class QualityModel:
    cosines: Cosines
    weights: np.ndarray  # of the model of all folds
    grid: np.ndarray  # raw scores, rising
    levels: np.ndarray  # calibrated scores, not falling

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines.of(stats) @ self.weights

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.grid, self.levels), 0.0, 1.0)


def standardisation(statistics: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every statistic over all documents; a constant one is not scaled."""
    columns = [F.col("stats")[i].cast("double") for i in range(len(STATISTICS))]
    row = statistics.agg(*[F.round(f(c), 6) for f in (F.avg, F.stddev_pop) for c in columns]).first()
    mean, scale = np.array([x or 0.0 for x in row], float).reshape(2, -1)
    return mean, np.where(scale > 0, scale, 1.0)


def normal_equations(train: DataFrame, cosines: Cosines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(products, products with the label, rows) of each fold, exact: per partition first, then over partitions."""
    width = len(cosines.phases) + 1

    def partial(batches):
        total = np.zeros((FOLDS, width + 1, width), np.int64)
        for batch in batches:
            z = cosines.of(vectors(batch.column("stats")))
            y = batch.column("label").to_numpy()
            fold = batch.column("fold").to_numpy()
            for k in np.unique(fold).tolist():
                mine = z[fold == k]
                # Products of up to 2^24 over an Arrow batch stay below 2^53.
                total[k, :width] += (mine.T @ mine).astype(np.int64)
                total[k, width] += (y[fold == k] @ mine).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(FOLDS, dtype=np.int32), width + 1)),
             pa.array(np.tile(np.arange(width + 1, dtype=np.int32), FOLDS)),
             pa.array(list(total.reshape(-1, width)), pa.list_(pa.int64()))], names=["fold", "line", "sums"])

    def add(table):
        sums = table.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, width).sum(axis=0)
        return pa.table({"fold": table.column("fold")[:1], "line": table.column("line")[:1],
                         "sums": pa.array([sums], pa.list_(pa.int64()))})

    form = "fold int, line int, sums array<long>"
    rows = train.select("fold", "stats", "label").mapInArrow(partial, form).groupBy("fold", "line").applyInArrow(add, form)
    total = np.zeros((FOLDS, width + 1, width))
    for row in rows.collect():  # folds times cosines, whatever the data
        total[row.fold, row.line] = row.sums
    unit = float(UNIT) ** 2
    return total[:, :width] / unit, total[:, width] / UNIT, total[:, width - 1, width - 1] / unit


def solve(products: np.ndarray, with_label: np.ndarray, rows: float, ridge: float) -> np.ndarray:
    """Ridge weights of the whole-number cosines. The constant is not held back; no rows give one half everywhere."""
    if not rows:
        return np.concatenate([np.zeros(len(with_label) - 1), [0.5 / UNIT]])
    penalty = np.full(len(with_label), ridge * rows)
    penalty[-1] = 1e-9 * rows
    return np.linalg.solve(products + np.diag(penalty), with_label) / UNIT


def pool(mean: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic regression: neighbours that fall are pooled until none does."""
    blocks: list[list[float]] = []  # mean, weight, cells
    for m, w in zip(mean.tolist(), weight.tolist()):
        blocks.append([m, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, n2 = blocks.pop()
            m1, w1, n1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def fit(statistics: DataFrame, train: DataFrame, cosines: int = COSINES, bandwidth: float = BANDWIDTH,
        ridge: float = RIDGE, seed: int = SEED) -> QualityModel:
    """The model of ``train`` (``stats``, ``fold``, ``label`` 0 or 1), standardised over all of ``statistics``.

    All rows of ``train`` are used. Without any, or with labels of one kind, the model gives every text the same score:
    one half, or that label.
    """
    drawn = Cosines.draw(*standardisation(statistics), cosines, bandwidth, seed)
    products, with_label, rows = normal_equations(train, drawn)
    weights = solve(products.sum(axis=0), with_label.sum(axis=0), rows.sum(), ridge)
    # Each fold is scored by the model of the others.
    others = [solve(products.sum(axis=0) - products[k], with_label.sum(axis=0) - with_label[k], rows.sum() - rows[k], ridge)
              for k in range(FOLDS)]

    def cells(batches):
        for batch in batches:
            z, fold = drawn.of(vectors(batch.column("stats"))), batch.column("fold").to_numpy()
            raw = (z * np.stack(others)[fold]).sum(axis=1)
            at = np.clip((raw - LEAST) * (CELLS / (MOST - LEAST)), 0, CELLS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["cell", "label"])

    counted = train.select("fold", "stats", "label").mapInArrow(cells, "cell int, label double").groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).orderBy("cell").collect()  # ``CELLS`` rows at most
    if not counted:
        return QualityModel(drawn, weights, np.array([0.0]), np.array([0.5]))
    n = np.array([r.n for r in counted], float)
    levels = pool(np.array([r.good for r in counted]) / n, n)
    grid = LEAST + (np.array([r.cell for r in counted]) + 0.5) * ((MOST - LEAST) / CELLS)
    return QualityModel(drawn, weights, grid, levels)


def score(statistics: DataFrame, model: QualityModel) -> DataFrame:
    """Per row ``doc_id``, ``raw``, ``score`` from 0 to 1 and ``predicted`` (1 from one half on)."""

    def scored(batches):
        for batch in batches:
            raw = model.raw(vectors(batch.column("stats")))
            found = model.calibrated(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=["doc_id", "raw", "score", "predicted"])

    return statistics.select("doc_id", "stats").mapInArrow(
        scored, "doc_id long, raw double, score double, predicted int")


def held_out_rows(doc_id="doc_id"):
    """Whether a row is kept from training; a NULL id counts as an empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % PARTS == HELD_OUT


def labelled(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the documents with a label that are not held out, with it. Staged.

    A document with several labels takes the largest, one whose label is NULL has none; rows without an id have none."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out_rows()).groupBy(
        F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("quality").cast("double")).alias("label"))
    return stage(statistics.join(known, F.col("doc_id") == F.col("_id")).select("fold", "stats", "label"), "quality-train")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` ``doc_id``, ``held_out``, ``raw``, ``score`` and ``predicted``; the text is read once."""
    statistics = stage(document_statistics(docs), "quality-statistics")
    model = fit(statistics, labelled(statistics, labels))
    return score(statistics, model).select("doc_id", held_out_rows().alias("held_out"), "raw", "score", "predicted")


def op13_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All documents scored by the labels of those not held out."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "held_out", "score", "predicted")


ship_with_tasks(__name__)
