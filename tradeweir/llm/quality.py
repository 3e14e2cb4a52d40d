"""Quality classifier by random Fourier features (operator 6).

Statistics of each whole text are scaled and mapped to random cosines whose products approximate a
Gaussian kernel. Ridge regression on them needs only sums over rows (normal equations), taken per
partition and added up in a tree. Isotonic regression on labelled rows that the ridge did not
see turns its output into a probability.

At most ``max_rows`` labelled rows, chosen by a hash of their id, are used to fit; every document is
scored. Defined results: a null text is an empty one, and an empty text has a score; rows with a null
id are scored but never learned from; a repeated label row weighs twice; equal texts have equal scores;
without labels of both kinds every score is the share of good labels, 0.5 without any label. Only the
text is ever an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import id_and_text, passes, stored
from tradeweir.llm.words import grams, mix, utf8, words_of

FEATURES = 256
RIDGE = 1e-3
MAX_ROWS = 200_000
BINS = 2000
_SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#$%&*@^~<>{}[]=+\\/_"])
_PUNCTUATION = np.isin(np.arange(256), [ord(c) for c in ".,;:!?'\"()-"])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text."""
    data, bounds = utf8(texts)
    words = words_of(texts)
    n = len(bounds) - 1
    size, count = np.diff(bounds), np.diff(words.first)

    def of_bytes(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[bounds[1:]] - total[bounds[:-1]]

    def of_words(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[words.first[1:]] - total[words.first[:-1]]

    def different(hashes: np.ndarray, document: np.ndarray) -> np.ndarray:
        _, at = np.unique(mix(hashes + document.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        return np.bincount(document[at], minlength=n)

    document = np.repeat(np.arange(n), count)
    inner = document[1:] == document[:-1] if len(document) else np.zeros(0, bool)
    again = np.zeros(len(document), bool)
    again[1:] = inner & (words.hashes[1:] == words.hashes[:-1])
    pairs = grams(words.hashes, 2)[inner] if len(words.hashes) > 1 else np.zeros(0, np.uint64)
    length = words.ends - words.starts
    per_word, per_byte = np.maximum(count, 1), np.maximum(size, 1)
    lines = of_bytes(data == 10)
    columns = [
        np.log1p(size),
        np.log1p(count),
        of_words(length) / per_word,
        np.sqrt(np.maximum(of_words(length**2) / per_word - (of_words(length) / per_word) ** 2, 0)),
        different(words.hashes, document) / per_word,
        different(pairs, document[1:][inner]) / per_word if len(pairs) else np.zeros(n),
        of_words(again) / per_word,
        of_bytes((data >= 65) & (data <= 90)) / per_byte,
        of_bytes((data >= 48) & (data <= 57)) / per_byte,
        of_bytes(data == 33) / per_word,
        of_bytes(data == 124) / per_word,
        of_bytes(_SYMBOLS[data]) / per_word,
        of_bytes(_PUNCTUATION[data]) / per_word,
        of_bytes(data == 32) / per_byte,
        of_bytes(data >= 128) / per_byte,
        lines / per_word,
        np.log1p(lines),
    ]
    return np.column_stack(columns)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phases: np.ndarray
    beta: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def lift(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.cos(x @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        # A thousandth of a smooth rise keeps order inside the steps.
        return 0.999 * np.interp(raw, *self.knots) + 0.001 / (1 + np.exp(-4 * (raw - 0.5)))


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step values for points in order of ``x``, as knots to draw lines between."""
    blocks: list[list[float]] = []
    for a, s, w in zip(x, total, weight, strict=True):
        blocks.append([a * w, s, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    xs, values, sizes = (np.array(v) for v in zip(*((a / w, s, w) for a, s, w in blocks), strict=True))
    return xs, (values + 0.5 * values.sum() / sizes.sum()) / (sizes + 0.5)


def document_statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            stats = pa.array(list(statistics(batch.column(1))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, stats array<double>")


def held_out(column: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text is 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded(labels: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` labelled rows at most, chosen by a hash of the id."""
    share = min(1.0, max_rows / max(labels.count(), 1))
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 20)) < int(share * (1 << 20)))


def fit(stats: DataFrame, labels: DataFrame, features: int = FEATURES, max_rows: int = MAX_ROWS, seed: int = 6) -> Model:
    """``stats``: doc_id and statistics of documents; ``labels``: doc_id and a label of 0 or 1 named ``y``."""
    own = labels.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    rows = stored(stats.join(bounded(own, max_rows), "doc_id").select("doc_id", "stats", F.col("y").cast("double")), "fit")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    width = statistics(pa.array([""])).shape[1]
    spread = rows.select(
        *(F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(width)),
        *(F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(width)),
        F.avg("y"),
        F.count_distinct("y"),
    ).first()
    rng = np.random.default_rng(seed)
    mean = np.array([spread[i] or 0.0 for i in range(width)])
    scale = np.array([spread[width + i] or 1.0 for i in range(width)])
    model = Model(
        mean,
        scale,
        rng.normal(0, 1 / np.sqrt(width), (width, features)),
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        (np.array([0.0]), np.array([0.5 if spread[2 * width] is None else spread[2 * width]])),
    )
    if spread[2 * width + 1] < 2:
        return model

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((features + 1, features + 2))
        for frame in frames:
            z = model.lift(np.stack(frame["stats"].to_numpy()))
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ frame["y"].to_numpy()
        yield pd.DataFrame({"part": [TaskContext.get().partitionId() % 16], "sums": [total.tobytes()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [sum(np.frombuffer(b) for b in frame["sums"]).tobytes()]})

    partial = rows.where(~part).mapInPandas(sums, "part int, sums binary")
    partial = partial.groupBy("part").applyInPandas(add, "sums binary")
    total = sum(np.frombuffer(r[0]) for r in partial.collect()).reshape(features + 1, features + 2)
    ridge = RIDGE * total[-1, -2] * np.eye(features + 1) / features
    ridge[-1, -1] = 0
    model.beta = np.linalg.solve(total[:, :-1] + ridge + 1e-9 * np.eye(features + 1), total[:, -1])

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = np.clip(model.raw(np.stack(frame["stats"].to_numpy())), -1, 2)
            yield pd.DataFrame({"bin": ((raw + 1) / 3 * BINS).astype(int), "raw": raw, "y": frame["y"]})

    steps = rows.where(part).mapInPandas(binned, "bin int, raw double, y double").groupBy("bin")
    steps = sorted(steps.agg(F.avg("raw"), F.sum("y"), F.count("*")).collect())
    if steps:
        model.knots = isotonic(*(np.array([r[i] for r in steps], float) for i in (1, 2, 3)))
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["doc_id", "held_out"]].copy()
            out["score"] = model.score(np.stack(frame["stats"].to_numpy())) if len(frame) else np.zeros(0)
            out["predicted"] = (out["score"] >= 0.5).astype("int32")
            yield out

    marked = stats.withColumn("held_out", held_out())
    return marked.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document row; ``labels`` has doc_id and ``y``."""
    stats = stored(document_statistics(docs), "statistics")
    return scored(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns, whose score is ``threshold`` or more; texts are not shuffled."""
    model = fit(stored(document_statistics(docs), "statistics"), labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, f"c{at}"):
            yield batch.filter(pa.array(model.score(statistics(batch.column(at))) >= threshold))

    named = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return named.mapInArrow(run, named.schema).toDF(*docs.columns)
