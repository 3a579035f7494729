"""Linear text classifier on indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import texts

# A featuriser gives the feature numbers of a UTF-8 text, each once, below the given count.
Featuriser = Callable[[bytes | None], np.ndarray]


def each_once(ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """`ids` without repeats, in linear time; `place` is any scratch array over all ids."""
    at = np.arange(len(ids), dtype=np.int32)
    place[ids] = at
    return ids[place[ids] == at]


@dataclass(frozen=True)
class Model:
    """Weights over features (ratio times learned weight), a bias, and a logistic curve for scores."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum(dtype=np.float64)) / _norm(len(features)) + self.bias

    def score(self, margin: float) -> float:
        z = self.slope * margin + self.shift
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _norm(n: int) -> float:
    """Long texts have more indicators by chance alone: margins are per root of their number."""
    return math.sqrt(n) if n else 1.0


def log_count_ratios(labelled: DataFrame, featurise: Featuriser, size: int, smoothing: float) -> np.ndarray:
    """ln((p / |p|) / (q / |q|)) per feature, over all rows of `labelled` (text, label).

    p and q are the numbers of texts of either class that hold the feature, plus `smoothing`. Each task
    adds up its rows and sends one row per feature met; what reaches the driver is one array of
    `size` features however many rows there are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, size), np.int64)
        for batch in batches:
            for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                held[label, featurise(text)] += 1
        met = np.flatnonzero(held.any(axis=0))
        for at in range(0, len(met), 50_000):
            ids = met[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(held[0, ids]), pa.array(held[1, ids])], ["feature", "n0", "n1"]
            )

    partial = labelled.mapInArrow(count, "feature bigint, n0 bigint, n1 bigint")
    found = partial.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    counts = np.full((2, size), float(smoothing))
    ids = found["feature"].to_numpy()
    counts[0, ids] += found["n0"].to_numpy()
    counts[1, ids] += found["n1"].to_numpy()
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def fit_rows(
    rows: list[tuple[np.ndarray, int]], ratios: np.ndarray, cost: float, epochs: int, seed: int = 7
) -> Model:
    """Hinge-loss fit of ratio-scaled indicators by dual coordinate descent, then a logistic curve.

    Each step solves one row's dual variable exactly within [0, cost of its class] and moves the
    weights with it. Classes have equal total cost. The curve is fitted on a fifth of the rows that
    the weights have not seen, or on all rows where there are under 100. A class without rows
    gives constant scores.
    """
    part = np.random.default_rng(seed).random(len(rows)) < 0.2
    aside = [row for row, out in zip(rows, part, strict=True) if out]
    if len(rows) >= 100:
        rows = [row for row, out in zip(rows, part, strict=True) if not out]
    labels = np.array([label for _, label in rows], np.int64)
    ones = int(labels.sum())
    if not 0 < ones < len(rows):
        share = (ones + 1) / (len(rows) + 2)
        return Model(np.zeros(len(ratios), np.float32), 0.0, 0.0, math.log(share / (1 - share)))
    weights, bias = np.zeros(len(ratios)), 0.0
    square = np.array([float(ratios[f] @ ratios[f]) / max(1, len(f)) + 1 for f, _ in rows])
    limit = cost * len(rows) / 2 / np.where(labels == 1, ones, len(rows) - ones)
    dual, order = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            features, sign = rows[i][0], 2 * labels[i] - 1
            scaled = ratios[features] / _norm(len(features))
            gradient = sign * (float(weights[features] @ scaled) + bias) - 1
            updated = min(max(dual[i] - gradient / square[i], 0.0), limit[i])
            if updated != dual[i]:
                change = (updated - dual[i]) * sign
                weights[features] += change * scaled
                bias += change
                moved = max(moved, abs(gradient))
                dual[i] = updated
        if moved < 1e-3:
            break
    model = Model((weights * ratios).astype(np.float32), bias, 1.0, 0.0)
    judged = aside if 0 < sum(label for _, label in aside) < len(aside) else rows
    margins = np.array([model.margin(f) for f, _ in judged])
    return Model(model.weights, bias, *_logistic(margins, np.array([label for _, label in judged])))


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that fits the classes' probabilities best, both classes weighing alike."""
    ones = int(labels.sum())
    weight = np.where(labels == 1, 0.5 / ones, 0.5 / (len(labels) - ones))
    sign = 2 * labels - 1
    middles = np.unique(np.quantile(margins, np.linspace(0, 1, 201)))
    gap = (margins[sign < 0].max() + margins[sign > 0].min()) / 2  # the middle, where the classes part
    best = (math.inf, 1.0, 0.0)
    for middle in [0.0, gap, *middles]:
        for slope in np.geomspace(0.25, 16, 25):
            loss = float(weight @ np.logaddexp(0, -slope * sign * (margins - middle)))
            if loss < best[0] - 1e-12:
                best = (loss, float(slope), float(-slope * middle))
    return best[1:]


def fit(
    labelled: DataFrame,
    featurise: Featuriser,
    size: int,
    smoothing: float = 1.0,
    cost: float = 1.0,
    epochs: int = 20,
    sample_rows: int = 4_000,
    sample_bytes: int = 128_000_000,
) -> Model:
    """Model of `labelled` (doc_id, text, label 0 or 1).

    The log-count ratios cover all labelled rows. The hinge-loss fit takes a sample of about
    `sample_rows` rows and `sample_bytes` of text by a hash of the id, and all rows where there are no more; it runs in
    one task, whose memory these bounds fix. Rows whose label is null or neither 0 nor 1 are left out.
    """
    labelled = labelled.where("label IN (0, 1)").select(
        "doc_id", F.col("text").cast("string"), F.col("label").cast("int")
    )
    ratios = log_count_ratios(labelled.select("text", "label"), featurise, size, smoothing)
    total = labelled.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    share = min(1.0, sample_rows / max(1, total.rows), sample_bytes / max(1, total.bytes or 0))
    # Compared in double precision: a share is never cut to none.
    place = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 53)).cast("double")
    chosen = labelled.where(place < share * 2.0**53)
    sampled = chosen.select("doc_id", "text", "label")
    shared = labelled.sparkSession.sparkContext.broadcast(ratios)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [featurise(t).astype(np.int32).tobytes() for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), batch.column(2)], ["doc_id", "found", "label"]
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for doc, found, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append((doc, np.frombuffer(found, np.int32), label))
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[2], r[1].tobytes()))
        model = fit_rows([r[1:] for r in rows], shared.value, cost, epochs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary())]
            + [pa.array([v], pa.float64()) for v in (model.bias, model.slope, model.shift)],
            ["weights", "bias", "slope", "shift"],
        )

    one = sampled.mapInArrow(features, "doc_id bigint, found binary, label int").repartition(1)
    row = one.mapInArrow(train, "weights binary, bias double, slope double, shift double").first()
    if row is None:  # no labelled rows at all
        return fit_rows([], ratios, cost, epochs)
    return Model(np.frombuffer(row.weights, np.float32), row.bias, row.slope, row.shift)


def scored(docs: DataFrame, model: Model, featurise: Featuriser, name: str = "score") -> DataFrame:
    """Every column of `docs` (which has text) and the score under `name`: one narrow pass over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.score(known.margin(featurise(t))) for t in texts(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, name])

    if name in docs.columns:
        raise ValueError(f"docs already has a column {name}")
    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def fold(modulus: int) -> F.Column:
    """crc32 of the id as text, modulo `modulus`."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, most_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, text, label) of labelled documents; labels of at most `most_rows` rows are broadcast.

    The size is counted first. More labels are joined by a shuffle. Repeated ids count once per pair.
    """
    wanted = labels.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint"), F.col(label).alias("label")
    )
    wanted = wanted.where("label IN (0, 1)")
    if wanted.count() <= most_rows:
        wanted = F.broadcast(wanted)
    return docs.select(F.col("doc_id").cast("bigint"), "text").join(wanted, "doc_id")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    featurise: Featuriser,
    size: int,
    held_out: F.Column | None = None,
    **options,
) -> DataFrame:
    """docs with score, predicted and held_out (which rows of labels the model never saw).

    `held_out` is a condition on doc_id; None learns from all labels. A row whose condition is null
    (null id) is not held out and has no label.
    """
    unseen = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    model = fit(labelled_texts(docs, labels.where(~unseen), label), featurise, size, **options)
    out = scored(docs, model, featurise).withColumn("held_out", unseen)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
