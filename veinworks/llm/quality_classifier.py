"""Quality scores: kernel ridge through random Fourier features, calibrated.

The statistics of a document go through random Fourier features, whose inner
products approximate a Gaussian kernel. A ridge regression of the labels is
fitted from normal equations that partitions sum on their own, so any number of
labelled rows takes one pass. Raw scores of rows held out in turn (fold sums
are subtracted from the total) are calibrated by isotonic regression.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from veinworks.llm.base import crc_fold, map_arrow, query, table, texts, written
from veinworks.llm.charclass import SYMBOLS, class_counts, class_table

STATS = (
    "log_chars", "log_words", "word_length", "lower", "upper", "letter", "digit", "space", "line", "stop", "mark",
    "symbol", "other", "upper_of_letters", "stops_per_word", "symbols_per_word", "symbol_ended", "type_token",
    "top_word", "repeated_lines", "log_line_length", "loud", "compressed",
)
RAW_LOW, RAW_HIGH, RAW_BINS = -0.5, 1.5, 4000


def text_stats(text: str, classes: np.ndarray) -> list[float]:
    """The statistics named in ``STATS``, of a whole text; all finite, also for an empty text."""
    counts = class_counts(text, classes)
    n = max(1, len(text))
    words = text.split()
    n_words = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(1, len(lines))
    raw = text.encode("utf-8", "surrogatepass")
    top = Counter(words).most_common(1)
    letters = max(1, counts[0] + counts[1] + counts[2])
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(sum(map(len, words)) / n_words),
        *(counts / n).tolist(), counts[1] / letters, math.log1p(counts[6] / n_words), math.log1p(counts[8] / n_words),
        sum(w[-1] in SYMBOLS for w in words) / n_words, math.log1p(len(set(words))) / math.log1p(n_words),
        (top[0][1] if top else 0) / n_words, 1 - len(set(lines)) / n_lines, math.log1p(len(text) / n_lines),
        (text.count("!") + text.count("?")) / n_words, len(zlib.compress(raw, 1)) / (len(raw) + 32),
    ]


def stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats): statistics of every whole text; a null text counts as empty."""

    def run(batches):
        classes = class_table()
        for batch in batches:
            rows = np.array([text_stats(t, classes) for t in texts(batch.column(1))], float).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(rows)], ["doc_id", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(chosen, run, f"doc_id {kind}, stats array<double>")


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32)[: len(rows) + 1]
    return pa.ListArray.from_arrays(offsets, rows.ravel())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Model:
    """Means and widths of the statistics, the random features, weights and calibration."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores
    values: np.ndarray  # calibrated scores at the knots

    def features(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.waves + self.shift) * math.sqrt(2 / self.waves.shape[1])
        return np.hstack([np.ones((len(z), 1)), z, waves])

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.features(rows) @ self.weights, self.knots, self.values)


def fit(
    stats: DataFrame, labels: DataFrame, features: int = 256, ridge: float = 1e-3, folds: int = 4, seed: int = 7
) -> Model:
    """Learn from the rows of ``stats`` (doc_id, stats) that ``labels`` (doc_id, label) name.

    Rows with a null id or label teach nothing; repeated labels of an id are
    averaged, repeated rows count each. Without a labelled row every score is 0.5.
    """
    marks = labels.where("doc_id is not null and label is not null").groupBy("doc_id")
    rows = stats.join(marks.agg(F.avg("label").alias("label")), "doc_id")
    rows = written(rows.select("stats", "label", F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int").alias("fold")), "quality-rows")
    width, rng = len(STATS), np.random.default_rng(seed)
    of = [F.col("stats")[i] for i in range(width)]
    found = rows.agg(F.count(F.lit(1)), *map(F.avg, of), *map(F.stddev_pop, of)).first()
    waves = rng.normal(size=(width, features)) / math.sqrt(width)
    shift = rng.uniform(0, 2 * math.pi, features)
    if not found[0]:
        flat = np.array([0.5])
        return Model(np.zeros(width), np.ones(width), waves, shift, np.zeros(1 + width + features), flat * 0, flat)
    mean, scale = np.array(found[1 : 1 + width], float), np.array(found[1 + width :], float)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), waves, shift, np.zeros(0), np.zeros(1), np.zeros(1))
    gram, moment = _normal_equations(rows, model, folds)
    size = gram.shape[1]

    def solve(left_out: int | None) -> np.ndarray:
        keep = [f for f in range(folds) if f != left_out]
        total, goal = gram[keep].sum(0), moment[keep].sum(0)
        penalty = np.full(size, ridge * max(1.0, total[0, 0]))
        penalty[0] = 1e-9
        return np.linalg.solve(total + np.diag(penalty + 1e-9), goal)

    by_fold = np.array([solve(f) for f in range(folds)])
    model.knots, model.values = _calibrate(rows, model, by_fold)
    model.weights = solve(None)
    return model


def _normal_equations(rows: DataFrame, model: Model, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Per fold, features' products with each other and with the label.

    Each partition sends its sums, one row per feature; a group adds up one
    short row per partition.
    """
    width = len(STATS)
    size = 1 + width + model.waves.shape[1]

    def run(batches):
        sums = np.zeros((folds, size, size + 1))
        for batch in batches:
            z, y, fold = model.features(_matrix(batch.column(0), width)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for f in np.unique(fold):
                own = z[fold == f]
                sums[f] += own.T @ np.hstack([own, y[fold == f, None]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(folds, dtype=np.int32), size)),
                pa.array(np.tile(np.arange(size, dtype=np.int32), folds)), _lists(sums.reshape(-1, size + 1)),
            ],
            ["fold", "i", "sums"],
        )

    def add(part: pa.Table) -> pa.Table:
        total = _matrix(part["sums"].combine_chunks(), size + 1).sum(0, keepdims=True)
        return pa.Table.from_arrays([part["fold"][:1], part["i"][:1], _lists(total)], ["fold", "i", "sums"])

    schema = "fold int, i int, sums array<double>"
    parts = map_arrow(rows, run, schema).groupBy("fold", "i").applyInArrow(add, schema)
    sums = np.zeros((folds, size, size + 1))
    for fold, i, values in parts.collect():  # folds x features rows
        sums[fold, i] = values
    return sums[:, :, :size], sums[:, :, size]


def _calibrate(rows: DataFrame, model: Model, by_fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of the labels on raw scores, in ``RAW_BINS`` bins of equal width."""
    width = len(STATS)

    def run(batches):
        for batch in batches:
            z, fold = model.features(_matrix(batch.column(0), width)), batch.column(2).to_numpy()
            raw = np.clip((z * by_fold[fold]).sum(1), RAW_LOW, RAW_HIGH)
            bins = np.minimum((raw - RAW_LOW) / (RAW_HIGH - RAW_LOW) * RAW_BINS, RAW_BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(raw), batch.column(1)], ["bin", "raw", "label"])

    binned = map_arrow(rows, run, "bin int, raw double, label double").groupBy("bin")
    found = binned.agg(F.avg("raw").alias("x"), F.avg("label").alias("y"), F.count(F.lit(1)).alias("n"))
    return isotonic([(r["x"], r["y"], r["n"]) for r in found.orderBy("bin").collect()])  # at most RAW_BINS rows


def isotonic(points: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators of (x, y, weight) in order of x: mean x and y of the pools."""
    pools: list[list[float]] = []
    for x, y, n in points:
        pools.append([x * n, y * n, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def score_stats(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for rows of (doc_id, stats)."""

    def run(batches):
        for batch in batches:
            scores = model.score(_matrix(batch.column(1), len(STATS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return map_arrow(stats, run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")


def score_rows(docs: DataFrame, model: Model, score_col: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the score of the text; a column named ``score_col`` is replaced."""
    docs = docs.drop(score_col)
    at = docs.columns.index(text_col)

    def run(batches):
        classes = class_table()
        for batch in batches:
            rows = np.array([text_stats(t, classes) for t in texts(batch.column(at))], float).reshape(-1, len(STATS))
            scores = pa.array(model.score(rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, score_col])

    return map_arrow(docs, run, StructType(docs.schema.fields[:]).add(score_col, "double"))


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from: crc32(doc_id) mod 5 is not 0."""
    return labels.where(crc_fold(F.col("doc_id")) != 0).select("doc_id", F.col("quality").cast("double").alias("label"))


@query("op1_quality_classifier")
def op1(spark, sf_dir):
    """Quality of every document; labels of held-out documents are never learned from.

    Null ids have no fold, so they are not held out.
    """
    found = written(stats(table(spark, sf_dir, "documents")), "quality-stats")
    model = fit(found, training_labels(table(spark, sf_dir, "labels")))
    held_out = F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False))
    scores = score_stats(found, model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
