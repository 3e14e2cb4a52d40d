"""Benchmark decontamination by winnowing (operator 4).

A window of ``span`` benchmark words (a whole item if it is shorter) is contaminated text. Of the
k-grams in each window the one with the smallest hash is kept on both sides (winnowing), so that any
window which the two sides share has the same fingerprint in both; fingerprints are joined, and each hit
is extended to its windows and compared word by word.

Defined results: a null or empty text has no words and no hits; a benchmark item without words has no
windows; an item with a null id makes words hit but is never listed; equal rows give equal results,
one each; ids that occur in several items are listed once; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import hash128, id_and_text, passes, stored
from tradeweir.llm.words import Words, grams, words_of

SPAN = 10
GRAM = 5
# Windows up to so many bytes are sent to every task; more are joined by a shuffle.
SMALL_BYTES = 16 << 20
WINDOW_SCHEMA = "fp long, words int, place int, window string, item_id string"
RESULT_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def fingerprints(words: Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of ``span`` words in a document: its first word, and place and hash of its kept k-gram."""
    gram = min(gram, span)
    hashes = grams(words.hashes, gram)
    counts = np.maximum(np.diff(words.first) - span + 1, 0)
    offset = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
    starts = np.arange(counts.sum()) + np.repeat(words.first[:-1] - offset, counts)
    place = starts.copy()
    best = hashes[starts] if len(starts) else np.zeros(0, np.uint64)
    for i in range(1, span - gram + 1):
        other = hashes[starts + i]
        take = other <= best
        best = np.where(take, other, best)
        place = np.where(take, starts + i, place)
    return starts, place, best


def benchmark_windows(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Every window with its fingerprint, the place of the k-gram in it, and the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            words = words_of(batch.column(1))
            sizes = np.diff(words.first)
            for length in sorted(set(np.minimum(sizes, span).tolist()) - {0}):
                own = sizes >= span if length == span else sizes == length
                starts, place, fp = fingerprints(words, length, gram)
                document = np.searchsorted(words.first, starts, side="right") - 1
                rows = np.flatnonzero(own[document])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(fp[rows].view(np.int64)),
                        pa.array(np.full(len(rows), length, np.int32)),
                        pa.array((place - starts)[rows].astype(np.int32)),
                        pa.array([" ".join(words.text(s, s + length)) for s in starts[rows]], pa.string()),
                        batch.column(0).take(pa.array(document[rows])),
                    ],
                    ["fp", "words", "place", "window", "item_id"],
                )

    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return items.mapInArrow(run, WINDOW_SCHEMA)


class Matcher:
    """Windows by length and fingerprint, and what they hit in a batch of documents."""

    def __init__(self, rows: list[tuple]) -> None:
        self.items: dict[str, set[str]] = defaultdict(set)
        self.at: dict[int, dict[int, set[tuple[int, str]]]] = defaultdict(lambda: defaultdict(set))
        for fp, length, place, window, item in rows:
            self.at[length][fp].add((place, window))
            self.items[window] |= {item} - {None}

    def hits(self, words: Words, gram: int) -> Iterator[tuple[int, int, str]]:
        """First word, number of words and text of each window that occurs."""
        for length, table in self.at.items():
            starts, place, fp = fingerprints(words, length, gram)
            known = np.sort(np.fromiter(table, np.int64, len(table)))
            fp = fp.view(np.int64)
            at = np.minimum(np.searchsorted(known, fp), len(known) - 1)
            found = np.flatnonzero(known[at] == fp)
            for row in found.tolist():
                start = int(starts[row])
                own = " ".join(words.text(start, start + length))
                if (int(place[row]) - start, own) in table[int(fp[row])]:
                    yield start, length, own


def _report(ids: pa.Array, words: Words, hits: Iterator[tuple[int, int, set[str]]]) -> pa.RecordBatch:
    n = len(words.first) - 1
    hit = np.zeros(len(words.hashes) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for start, length, names in hits:
        hit[start : start + length] = 1
        items[int(np.searchsorted(words.first, start, side="right")) - 1] |= names
    total = np.concatenate(([0], np.cumsum(hit)))
    n_hit = total[words.first[1:]] - total[words.first[:-1]]
    listed = [sorted(items.get(i, ())) for i in range(n)]
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(np.diff(words.first).astype(np.int64)),
            pa.array(n_hit),
            pa.array([len(x) for x in listed], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed]),
            pa.array(n_hit > 0),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """One row per document row: its words, hit words, and the benchmark items that occur in it."""
    windows, small = _windows(benchmark, span, gram, small_bytes)
    way = _by_broadcast if small else _by_join
    return way(id_and_text(docs), windows, gram)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """Rows of ``docs``, all columns, without those that hold a window of the benchmark."""
    windows, small = _windows(benchmark, span, gram, small_bytes)
    if small:
        table = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in windows.collect()])
        at = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(table.value)
            for batch in passes(batches, f"c{at}"):
                words = words_of(batch.column(at))
                clean = np.ones(len(batch), bool)
                for start, _, _ in matcher.hits(words, gram):
                    clean[np.searchsorted(words.first, start, side="right") - 1] = False
                yield batch.filter(pa.array(clean))

        named = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
        return named.mapInArrow(run, named.schema).toDF(*docs.columns)
    marked = _by_join(id_and_text(docs), windows, gram, keys=True).where("contaminated").select("h1", "h2").distinct()
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    id_, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    own = own.withColumns(dict(zip(("k1", "k2"), _row_key(id_.cast("long"), text.cast("string")), strict=True)))
    kept = own.join(marked, (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left_anti")
    return kept.select(*names).toDF(*docs.columns)


def _windows(benchmark: DataFrame, span: int, gram: int, small_bytes: int) -> tuple[DataFrame, bool]:
    """Stored windows, and whether all of them together are small."""
    windows = stored(benchmark_windows(benchmark, span, gram), "windows")
    size = windows.agg(F.sum(F.octet_length("window") + F.octet_length(F.coalesce("item_id", F.lit(""))) + 64)).first()
    return windows, (size[0] or 0) <= small_bytes


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    return hash128(F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))


def _by_broadcast(docs: DataFrame, windows: DataFrame, gram: int) -> DataFrame:
    """No shuffle at all: the windows are small enough (checked) to be in every task."""
    table = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in windows.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(table.value)
        for batch in passes(batches):
            words = words_of(batch.column(1))
            found = ((s, n, matcher.items[w]) for s, n, w in matcher.hits(words, gram))
            yield _report(batch.column(0), words, found)

    return docs.mapInArrow(run, RESULT_SCHEMA)


def _by_join(docs: DataFrame, windows: DataFrame, gram: int, keys: bool = False) -> DataFrame:
    """Fingerprints of both sides meet by a shuffle; hits come back to their documents."""
    lengths = sorted(r[0] for r in windows.select("words").distinct().collect())
    keyed = docs.select(*_row_key(F.col("doc_id"), F.col("text")), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            words = words_of(batch.column(3))
            for length in lengths:
                starts, place, fp = fingerprints(words, length, gram)
                kept = np.unique(place, return_index=True)[1]
                document = pa.array(np.searchsorted(words.first, starts[kept], side="right") - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(fp[kept].view(np.int64)),
                        pa.array(np.full(len(kept), length, np.int32)),
                        batch.column(0).take(document),
                        batch.column(1).take(document),
                    ],
                    ["fp", "words", "h1", "h2"],
                )

    shared = windows.groupBy("fp", "words", "place", "window").agg(F.collect_set("item_id").alias("items"))
    prints = keyed.mapInArrow(run, "fp long, words int, h1 long, h2 long").distinct()
    candidates = prints.join(shared, ["fp", "words"]).groupBy("h1", "h2")
    candidates = candidates.agg(F.collect_list(F.struct("fp", "words", "place", "window", "items")).alias("found"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            for i in range(len(batch)):
                words = words_of(batch.column(1).slice(i, 1))
                found = batch.column(2)[i].as_py() or []
                matcher = Matcher([(*list(x.values())[:4], item) for x in found for item in x["items"] or [None]])
                hits = ((s, n, matcher.items[w]) for s, n, w in matcher.hits(words, gram))
                report = _report(batch.column(0).slice(i, 1), words, hits)
                for k, name in enumerate(("h1", "h2") if keys else ()):
                    report = report.append_column(name, batch.column(3 + k).slice(i, 1))
                yield report

    whole = keyed.join(candidates, ["h1", "h2"], "left").select("doc_id", "text", "found", "h1", "h2")
    return whole.mapInArrow(verify, RESULT_SCHEMA + ", h1 long, h2 long" * keys)
