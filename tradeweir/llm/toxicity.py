"""Toxicity by a chain of linear models (operator 10).

The categories (columns of the labels) are predicted one after another: the model of each category sees
the words of the text and the probabilities of all categories before it. While the chain is
trained, those probabilities come from models that did not see the row (out of fold), as they will
when texts are scored.

A feature is a word, or its first four or five bytes, that occurs in a text at all. Of the features of
the labelled sample those are kept whose rate differs between a category's two classes by more than
chance explains. At most ``max_rows`` labelled rows, chosen by a hash of their id, are used to fit; all texts
are scored whole.

Defined results: a null or empty text has no features and gets the models' base rates; rows with a null
id are scored but never learned from; a null label leaves the row out of that category only; equal
texts have equal scores; a category without both classes has the probability of its single class (0
without labels).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import id_and_text, passes, stored
from tradeweir.llm.quality import bounded, held_out
from tradeweir.llm.words import hash_runs, mix, words_of

MAX_ROWS = 40_000
MIN_TEXTS = 3
MIN_Z = 4.5
FOLDS = 3
L2 = 0.005
STEPS = 300
BLOCK = 1 << 19  # features of one numpy pass of the fit


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) for every different feature of every text."""
    words = words_of(texts)
    document = np.repeat(np.arange(len(texts)), np.diff(words.first))
    found = [words.hashes]
    for size in (4, 5):
        ends = np.minimum(words.ends, words.starts + size)
        found.append(mix(hash_runs(words.data, words.starts, ends) + np.uint64(size)))
    hashes, document = np.concatenate(found), np.tile(document, 3)
    _, at = np.unique(mix(hashes ^ mix(document.astype(np.uint64))), return_index=True)
    return document[at], hashes[at].view(np.int64)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def logistic(sizes: np.ndarray, column: np.ndarray, width: int, extra: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on a sparse 0/1 matrix, row by row, with dense columns and a constant beside it."""
    n = len(y)
    dense = np.column_stack([extra, np.ones(n)])
    w = np.zeros(width + dense.shape[1])
    base = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    w[-1] = np.log(base / (1 - base))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + BLOCK, BLOCK)).clip(0, n))
    cuts = np.unique(np.concatenate(([0], cuts, [n])))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        grad = L2 * w
        grad[-1] = 0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own, full = column[ends[a] : ends[b]], np.flatnonzero(sizes[a:b])
            logit = dense[a:b] @ w[width:]
            if len(full):
                logit[full] += np.add.reduceat(w[own], ends[a:b][full] - ends[a])
            error = probability(logit) - y[a:b]
            grad[:width] += np.bincount(own, weights=np.repeat(error, sizes[a:b]), minlength=width)
            grad[width:] += error @ dense[a:b]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        rate = 0.3 / (1 + 4 * step / STEPS)
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w


class Chain:
    """Kept features and the models of all categories."""

    def __init__(self, kept: np.ndarray, models: list[np.ndarray]) -> None:
        self.kept, self.models = kept, models

    def columns(self, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.kept) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.kept, feature), len(self.kept) - 1)
        known = self.kept[at] == feature
        return row[known], at[known]

    def apply(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        row, column = self.columns(row, feature)
        out = np.zeros((n, 0))
        for w in self.models:
            out = np.column_stack([out, linear(w, row, column, len(self.kept), out)])
        return out


def linear(w: np.ndarray, row: np.ndarray, column: np.ndarray, width: int, extra: np.ndarray) -> np.ndarray:
    words = np.bincount(row, weights=w[column], minlength=len(extra))
    return probability(words + extra @ w[width:-1] + w[-1])


def train(rows: pd.DataFrame, name: str, earlier: list[list[np.ndarray]], width: int) -> np.ndarray:
    """A model of category ``name``. ``rows``: fold, kept feature columns as bytes, and a column for each category.

    ``earlier`` has the models of each category before, one for each fold, made without that fold's rows.
    """
    rows = rows.sort_values("doc_id")
    column = np.frombuffer(b"".join(rows["columns"]), np.int32)
    sizes = rows["columns"].map(len).to_numpy() // 4
    y, fold = rows[name].to_numpy(float), rows["fold"].to_numpy()
    if not 0 < y.mean() < 1:
        return constant(y.mean() == 1, width + len(earlier))
    before, row = np.zeros((len(rows), 0)), np.repeat(np.arange(len(rows)), sizes)
    for models in earlier:
        unseen = np.zeros(len(rows))
        for k, w in enumerate(models):
            unseen = np.where(fold == k, linear(w, row, column, width, before), unseen)
        before = np.column_stack([before, unseen])
    del row
    return logistic(sizes, column, width, before, y)


def _trainer(name: str, shared: Broadcast, width: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def task(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [rows["k"].iloc[0]], "w": [train(rows, name, shared.value, width).tobytes()]})

    return task


def constant(one: bool, width: int) -> np.ndarray:
    return np.array([0.0] * width + [35.0 if one else -35.0])


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], max_rows: int = MAX_ROWS) -> Chain:
    """``labels``: doc_id and a column of 0, 1 or null for each category, earlier ones first."""
    own = labels.select("doc_id", *(F.col(c).cast("double") for c in categories))
    own = bounded(own.where(F.col("doc_id").isNotNull() & ~held_out()), max_rows)
    # The sample has about max_rows rows whatever the corpus, so it can go to every task.
    sample = id_and_text(docs).join(F.broadcast(own), "doc_id").repartition("doc_id")
    names = ", ".join(f"{c} double" for c in categories)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            row, feature = features(batch.column(1))
            found, which = np.unique(feature, return_inverse=True)
            out = [pa.array(found)]
            for i in range(len(categories)):
                y = batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float)
                for value in (1, 0):
                    out.append(pa.array(np.bincount(which[y[row] == value], minlength=len(found))))
            yield pa.RecordBatch.from_arrays(out, ["feature", *(f"c{i}_{v}" for i in range(len(categories)) for v in (1, 0))])

    counts = sample.mapInArrow(count, "feature long" + "".join(f", c{i}_1 long, c{i}_0 long" for i in range(len(categories))))
    counts = counts.groupBy("feature").agg(*(F.sum(c).alias(c) for c in counts.columns[1:]))
    of = own.agg(*(F.count(F.when(F.col(c) == v, 1)) for c in categories for v in (1, 0))).first()
    z = F.lit(0.0)
    for i in range(len(categories)):
        n1, n0 = of[2 * i], of[2 * i + 1]
        if n1 and n0:
            a, b = F.col(f"c{i}_1"), F.col(f"c{i}_0")
            rate = (a + b) / F.lit(float(n1 + n0))
            chance = F.sqrt(rate * (1 - rate) * F.lit(1 / n1 + 1 / n0)) + 1e-9
            enough = F.when(a + b >= MIN_TEXTS, F.abs(a / n1 - b / n0) / chance).otherwise(0.0)
            z = F.greatest(z, enough)
    # Every feature that passes: rare words of one category are never crowded out by another's.
    kept = np.sort(np.array([r[0] for r in counts.select("feature").where(z > MIN_Z).collect()], np.int64))
    chain = Chain(kept, [])

    def slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            row, column = chain.columns(*features(batch.column(1)))
            order = np.lexsort((column, row))
            ends = np.searchsorted(row[order], np.arange(len(batch) + 1))
            column = column[order].astype(np.int32)
            lists = pa.array([column[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, *batch.columns[2:]], ["doc_id", "columns", *categories])

    slimmed = sample.mapInArrow(slim, f"doc_id long, columns binary, {names}")
    slimmed = stored(slimmed.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(FOLDS)).cast("int")), "slim")
    # A task for each model of a category: without fold k, and with all rows (k = FOLDS).
    every = slimmed.withColumn("k", F.explode(F.array(*map(F.lit, range(FOLDS + 1))))).where("k <> fold")
    earlier: list[list[np.ndarray]] = []
    for i, name in enumerate(categories):
        shared = docs.sparkSession.sparkContext.broadcast(earlier)
        # More ranges than models, or the sampled bounds put two models in one.
        own = every.where(F.col(name).isNotNull()).repartitionByRange(8 * (FOLDS + 1), "k").groupBy("k")
        own = own.applyInPandas(_trainer(name, shared, len(kept)), "k int, w binary")
        found = {r.k: np.frombuffer(r.w) for r in own.collect()}
        models = [found.get(k, constant(False, len(kept) + i)) for k in range(FOLDS + 1)]
        chain.models.append(models[FOLDS])
        earlier = [*earlier, models[:FOLDS]]
    return chain


def score(docs: DataFrame, chain: Chain, categories: list[str]) -> DataFrame:
    """doc_id and a probability ``p_<category>`` for each category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            p = shared.value.apply(*features(batch.column(1)), len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in p.T)], ["doc_id", *(f"p_{c}" for c in categories)]
            )

    return id_and_text(docs).mapInArrow(run, "doc_id long" + "".join(f", p_{c} double" for c in categories))


def predict(docs: DataFrame, labels: DataFrame, categories: list[str]) -> DataFrame:
    """Probabilities of all categories; ``toxic`` says whether the last one is 0.5 or more."""
    scores = score(docs, fit(docs, labels, categories), categories)
    return scores.withColumn("toxic", (F.col(f"p_{categories[-1]}") >= 0.5).cast("int"))
