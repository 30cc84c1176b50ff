"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

The n-grams of a text, of several lengths, are hashed into a fixed number of cells; a cell counts
as present or absent. Over the labelled texts each cell gets the ratio r of its smoothed
frequencies in toxic and other texts, in logarithms. A logistic model is fitted on the cells'
presence times r, and its weights times r are one table that scores any text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows, utf8

SIZES = (4, 5, 6)  # ascending
CELLS = 1 << 18
TRAIN_ROWS = 4_000
THRESHOLD = 0.5
_BYTES = 1 << 20


def _mixers(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_LETTERS = _mixers(20)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def cells(text: str | None) -> np.ndarray:
    """The cells of a text's n-grams, sorted, each once. N-grams are of bytes of the lower-cased text,
    with a space before and after it; white space counts as one space. Long texts go in blocks."""
    data = b" " + b" ".join(utf8((text or "").lower()).split()) + b" "
    flags = np.zeros(CELLS, bool)
    most = max(SIZES)
    for at in range(0, len(data), _BYTES):
        block = _LETTERS[np.frombuffer(data[at : at + _BYTES + most - 1], np.uint8)]
        code, done = block, 1
        for size in SIZES:
            count = len(block) - size + 1
            if count <= 0:
                break
            code = code[:count].copy()
            for i in range(done, size):
                code *= _STEP
                code += block[i : i + count]
            done = size
            spread = code ^ (code >> np.uint64(29))
            spread *= _STEP
            flags[spread >> np.uint64(64 - 18)] = True
    return np.flatnonzero(flags)


@dataclass(frozen=True)
class Model:
    """A weight per cell, zero for most, and an intercept."""

    places: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, found: np.ndarray) -> float:
        """Probability from the sorted cells of a text."""
        at = np.searchsorted(found, self.places)
        inside = at < len(found)
        inside[inside] = found[at[inside]] == self.places[inside]
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[inside].sum(), -40, 40))))


def fit(texts: list[np.ndarray], labels: np.ndarray, *, rounds: int = 150, ridge: float = 1.0) -> Model:
    """Naive Bayes ratios, then a ridge logistic model of the scaled cells by accelerated gradient steps.

    Without both labels the model is the labels' smoothed mean.
    """
    labels = np.asarray(labels, float)
    positive = int(labels.sum())
    prior = float(np.log((positive + 0.5) / (len(labels) - positive + 0.5))) if len(labels) else 0.0
    if not positive or positive == len(labels):
        return Model(np.empty(0, np.int64), np.empty(0), min(prior, -1e-9) if not positive else prior)
    counts = np.zeros((2, CELLS))
    for found, label in zip(texts, labels.astype(int).tolist(), strict=True):
        counts[label, found] += 1
    q, p = counts
    ratio = np.log((p + 0.5) / (positive + 1)) - np.log((q + 0.5) / (len(labels) - positive + 1))
    # A cell whose ratio is within the noise of its counts can add nothing but noise.
    error = np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
    used = np.flatnonzero((p + q >= 3) & (np.abs(ratio) > 3 * error))
    place = np.full(CELLS, -1)
    place[used] = np.arange(len(used))
    columns = [inside[inside >= 0] for inside in (place[found] for found in texts)]
    row = np.repeat(np.arange(len(texts)), [len(found) for found in columns])
    column = np.concatenate(columns)
    value = ratio[used][column]
    count = len(labels)
    # The largest singular value of the scaled presence, for the step size, by power iteration.
    vector = np.ones(len(used))
    for _ in range(15):
        image = np.bincount(row, value * vector[column], count)
        vector = np.bincount(column, value * image[row], len(used))
        norm = np.linalg.norm(vector) or 1.0
        vector /= norm
    step = 1 / (0.25 * (norm + count) + ridge)
    weight, bias = np.zeros(len(used)), prior
    ahead, ahead_bias, momentum = weight, bias, 1.0
    for _ in range(rounds):
        z = np.bincount(row, value * ahead[column], count) + ahead_bias
        wrong = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels
        new = ahead - step * (np.bincount(column, value * wrong[row], len(used)) + ridge * ahead)
        new_bias = ahead_bias - step * wrong.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        ahead, ahead_bias = new + pull * (new - weight), new_bias + pull * (new_bias - bias)
        weight, bias, momentum = new, new_bias, following
    return Model(used, weight * ratio[used], float(bias))


def held_out(key) -> bool:
    """Whether a row is kept from learning, by the checksum of its id as text."""
    return zlib.crc32(str(key).encode()) % 5 == 0


def training_rows(
    documents: DataFrame, labels: DataFrame, target: str, *, doc_id: str, text: str, rows: int
) -> DataFrame:
    """``text, label`` of at most about ``rows`` labelled rows that are not held out, chosen by a hash of their id.

    Only ids and labels are counted; the texts of the chosen rows are looked up. An id that is there
    several times gives one row, the text with the smallest hash, so the bound holds for any input. An id with
    labels of both kinds has label 1.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(target).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("_id").isNotNull())
    known = known.where(F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(5)) != 0)
    known = known.groupBy("_id").agg(F.max("label").alias("label"))
    count = known.count()
    share = 1_000_000 if count <= rows else int(1_000_000 * rows / count)
    chosen = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < share)
    body = documents.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # The bound on the rows is the parameter, so the few ids and labels can be broadcast.
    found = body.join(F.broadcast(chosen), "_id").select("_id", "label", F.struct(F.xxhash64("text"), "text").alias("one"))
    # Reduced in the tasks before the shuffle: of a repeated id each sends one row.
    return found.groupBy("_id", "label").agg(F.min("one").alias("one")).select("_id", "one.text", "label")


def train(
    documents: DataFrame,
    labels: DataFrame,
    *,
    target: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = TRAIN_ROWS,
) -> Model:
    """A model from about ``rows`` labelled rows, fitted in one task; the tasks before find their cells.

    Empty labels, or labels of one kind, give a constant model.
    """
    chosen = training_rows(documents, labels, target, doc_id=doc_id, text=text, rows=rows)

    def features(given):
        for key, body, label in given:
            yield key, cells(body).astype("<u4").tobytes(), label

    def learn(given):
        every = sorted((key, label, found) for key, found, label in given)
        model = fit(
            [np.frombuffer(found, "<u4") for _, _, found in every],
            np.array([label for _, label, _ in every]),
        )
        yield model.places.astype("<i8").tobytes(), model.weights.astype("<f8").tobytes(), model.intercept

    found = map_rows(chosen, features, "id bigint, cells binary, label int").repartition(1)
    learned = map_rows(found, learn, "places binary, weights binary, intercept double").first()
    if learned is None:
        return fit([], np.empty(0))
    return Model(np.frombuffer(learned[0], "<i8"), np.frombuffer(learned[1], "<f8"), learned[2])


def score(
    documents: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The columns of ``documents``, then ``score`` and ``predicted``; columns of these names are replaced.

    A null text is scored as an empty one. Every row is answered, whatever its id.
    """
    source = documents.drop("score", "predicted")
    at = source.columns.index(text)
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in source.schema)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(rows):
        for row in rows:
            value = shared.value.score(cells(row[at]))
            yield (*row, value, int(value >= threshold))

    return map_rows(source, work, f"{fields}, score double, predicted int")
