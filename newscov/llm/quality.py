"""Quality grades by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import freeing, stored

#: Grades from worst to best: toxic, poor, good.
GRADES = 3
#: The fit uses at most so many rated rows, those with the smallest hash of their id.
MOST_RATED = 20_000
#: Weights that all thresholds share.
BUCKETS = 1 << 20
EPOCHS = 10
RATE, L1, L2 = 0.15, 2.0, 1.0
SEED = 3
#: A document stays if it is at least this likely to have the best grade.
LEAST_LIKELY = 0.5
#: Letters of a word's beginning that count as well as the whole word.
STEMS = (5, 7)
REMEMBERED = 250_000
#: Levels of the shares that describe a text, and how often such a description counts.
LEVELS = (0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
SHAPE_WEIGHT = 4
EDGE = re.compile(r"^\W+|\W+$")


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def described(token: str) -> tuple:
    """What a token stands for: its buckets, and whether it is decorated, in capitals or no word."""
    core = EDGE.sub("", token)
    decorated = len(token) - len(core) >= 2 and bool(core)
    capitals = len(core) >= 2 and core.isupper()
    word = core.lower()
    found = (bucket("word " + word), *(bucket(f"stem {word[:n]}") for n in STEMS)) if word else ()
    return found, decorated, capitals, not core


class Tokens(dict):
    """Described tokens, remembered up to a limit."""

    def __missing__(self, token: str) -> tuple:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = value = described(token)
        return value


def _shape(words: list[str], decorated: int, capitals: int, symbols: int, types: int) -> list[int]:
    """Buckets that describe the whole text: shares, each with all levels it reaches, and the length."""
    if not words:
        return [bucket("empty")]
    shares = {
        "decorated": decorated / types,
        "capitals": capitals / types,
        "symbols": symbols / types,
        "repeats": sum(a == b for a, b in zip(words, words[1:])) / len(words),
        "bars": words.count("|") / len(words),
    }
    reached = [bucket(f"{name} {level}") for name, share in shares.items() for level in LEVELS if share >= level]
    return reached + [bucket(f"length {len(words).bit_length()}")]


def features(text: str | None, tokens: Tokens) -> np.ndarray:
    """Buckets of a text, one entry for each distinct token's word and stem, and those of its shape."""
    words = text.split() if text else []
    kinds = [tokens[t] for t in set(words)]
    found = [b for k in kinds for b in k[0]]
    shape = _shape(words, sum(k[1] for k in kinds), sum(k[2] for k in kinds), sum(k[3] for k in kinds), len(kinds))
    return np.array(sorted(found) + shape * SHAPE_WEIGHT, np.int32)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit(rows: list[np.ndarray], grades: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds for P(grade <= k) = sigmoid(threshold_k - weights . x).

    Follow-the-regularised-leader steps keep the weights of uninformative buckets at zero, and no
    weight is positive: words can only lower a grade, so that a long text of ordinary words neither
    gains by its length nor makes up for a few bad ones.
    Thresholds are a first one and positive steps, so that their order cannot break.
    """
    shares = np.cumsum(np.bincount(grades, minlength=GRADES) + 1) / (len(grades) + GRADES)
    theta = np.log(shares[:-1] / (1 - shares[:-1]))
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    steps = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    slopes = np.zeros(len(steps))
    random = np.random.default_rng(seed)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        return -np.maximum(z[at] - L1, 0) / (L2 + np.sqrt(n[at]) / RATE)

    unique = [np.unique(r, return_counts=True) for r in rows]
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            at, x = unique[i]
            w = weights(at)
            theta = np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(steps[1:]))])
            score, y = float(w @ x), int(grades[i])
            low = _sigmoid(theta[y - 1] - score) if y else 0.0
            high = _sigmoid(theta[y] - score) if y < len(theta) else 1.0
            slope = (1 - low - high) * x
            spread = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / RATE
            z[at] += slope - spread * w
            n[at] += slope * slope
            likely = max(high - low, 1e-9)
            by_theta = np.zeros(len(theta))
            if y < len(theta):
                by_theta[y] -= high * (1 - high) / likely
            if y:
                by_theta[y - 1] += low * (1 - low) / likely
            by_step = np.array([by_theta[k:].sum() * (np.exp(steps[k]) if k else 1.0) for k in range(len(steps))])
            slopes += by_step**2
            steps -= 0.05 * by_step / np.sqrt(slopes + 1)
    theta = np.concatenate([steps[:1], steps[0] + np.cumsum(np.exp(steps[1:]))])
    return weights(slice(None)).astype(np.float32), theta


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens = Tokens()
    for batch in batches:
        found = [features(text.as_py(), tokens).tobytes() for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("grade"), pa.array(found, pa.binary())], ["id", "grade", "x"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, grades = [], []
    for batch in batches:
        rows += [np.frombuffer(x, np.int32) for x in batch.column("x").to_pylist()]
        grades += batch.column("grade").to_pylist()
    weights, theta = fit(rows, np.array(grades, np.int64)) if rows else (np.zeros(BUCKETS, np.float32), np.array([-1.0, 0.0]))
    at = np.flatnonzero(weights).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array([at.tobytes()], pa.binary()), pa.array([weights[at].tobytes()], pa.binary()), pa.array([theta.tolist()], pa.list_(pa.float64()))],
        ["buckets", "weights", "thresholds"],
    )


def rating(quality: Column, toxic: Column) -> Column:
    """Grade 0 for toxic rows, 1 for other rows of poor quality, 2 for good ones; null where either is null."""
    known = quality.isNotNull() & toxic.isNotNull()
    return F.when(known, F.when(toxic != 0, 0).when(quality == 0, 1).otherwise(2))


def fit_grades(docs: DataFrame, rated: DataFrame, most: int = MOST_RATED) -> DataFrame:
    """A row with the model's ``buckets, weights, thresholds`` from ``docs(id, text)`` and ``rated(id, grade)``.

    ``most`` bounds the rated rows of the fit and with them what the one fitting task holds: the
    buckets of their texts. Several ratings of a document count as its worst. Rows without
    a grade or id, and grades whose document is missing, are left out; without any rated row the
    model is empty and finds nothing to be poor.
    """
    rated = rated.where("grade IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("grade").alias("grade"))
    rated = rated.orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.join(F.broadcast(stored(rated, "quality-ratings")), "id")  # at most ``most`` rows
    rows = stored(rows.select("id", "grade", "text").mapInArrow(freeing(_featured), "id LONG, grade INT, x BINARY"), "quality-features")
    rows = rows.orderBy(F.xxhash64("id"), F.xxhash64("x")).limit(most).coalesce(1)
    return stored(rows.mapInArrow(freeing(_fitted), "buckets BINARY, weights BINARY, thresholds ARRAY<DOUBLE>"), "quality-model")


def _scored(text_column: str, buckets: bytes, values: bytes, thresholds: list[float]):
    """Adds the expected grade and the probabilities of at least each grade."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS, np.float32)
        weights[np.frombuffer(buckets, np.int32)] = np.frombuffer(values, np.float32)
        known: dict[str, tuple] = {}

        def value(token: str) -> tuple[float, list | None]:
            if len(known) >= REMEMBERED:
                known.clear()
            found, *flags = described(token)
            known[token] = kind = (float(sum(weights[b] for b in found)), flags if any(flags) else None)
            return kind

        for batch in batches:
            rows = batch.column("row")
            scores = np.empty(len(rows))
            for i, text in enumerate(rows.field(text_column)):
                text = text.as_py()
                words = text.split() if text else []
                total, decorated, capitals, symbols, types = 0.0, 0, 0, 0, set(words)
                for token in types:
                    weight, flags = known.get(token) or value(token)
                    total += weight
                    if flags:
                        decorated += flags[0]
                        capitals += flags[1]
                        symbols += flags[2]
                shape = _shape(words, decorated, capitals, symbols, len(types))
                scores[i] = total + SHAPE_WEIGHT * sum(float(weights[b]) for b in shape)
            tails = 1 / (1 + np.exp(np.clip(np.array(thresholds)[None, :] - scores[:, None], -60, 60)))
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))], ["row", "grade", "tails"]
            )

    return score


def grades(docs: DataFrame, model: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns and ``rated(grade, tails)``: the expected grade and P(grade >= k) for k from 1.

    Null texts count as empty, which is a text of its own kind. An empty table gives an empty
    result; repeated rows get equal grades; a column called ``rated`` is replaced.
    """
    fitted = model.first()  # one row of bounded size
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "rated"]
    rows = docs.select(F.struct(*kept).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(
        freeing(_scored(text_column, bytes(fitted.buckets), bytes(fitted.weights), list(fitted.thresholds))),
        f"row {kind}, grade DOUBLE, tails ARRAY<DOUBLE>",
    )
    return scored.select("row.*", F.struct("grade", "tails").alias("rated"))


def selected(tails: Column, least: float = LEAST_LIKELY) -> Column:
    """Whether the best grade is likely enough."""
    return F.element_at(tails, -1) >= least
