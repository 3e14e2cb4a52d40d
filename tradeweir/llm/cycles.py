"""Periodic runs of words by seeds and diagonals (operator 13).

A run is a stretch of consecutive words with smallest period q, at least ``max(6, 4 q)`` words long, that no neighbouring
word extends. On the diagonal of lag q (word i beside word i + q) it is at least ``max(5, 3 q)`` equal pairs in a row.

1. Periods are taken in scales ``low`` to ``high``. A scale's seeds are k-grams with k = 5 for lags 1 and 2, and 3 ``low`` after that:
   the overlap that the shortest run of the scale guarantees. ``high`` is k // 2, and then a k-gram inside of a run of the scale
   occurs next exactly one period later (a nearer place would give the k-gram two periods, and by the theorem of Fine
   and Wilf the run a smaller one). So the pairs of a place and the next one with the same k-gram are enough, at most one a place.
2. A k-gram can only repeat where the shorter one of the scale before does: each scale sorts the places the last one left.
3. Pairs with a lag of the scale are taken by lag and place. A table of the furthest place covered on each lag leaves out
   seeds in a stretch that is known; others are extended to both sides word by word, which also checks the seed itself.

Seeds are found by 64-bit hashes for a batch of documents at a time, stretches are decided on the words. Memory is a few
numbers a word; documents never meet, so nothing is shuffled.

Defined results: a null or empty text, or one of white space, has no words, no runs and the hashes of nothing; repeated rows and
equal or null ids are judged row by row; a very long text is one document, whose words are numbered in parts; other
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import passes
from tradeweir.llm.words import mix

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
_BASE = np.uint64(0xD6E8FEB86659FD93)
_PART = 1 << 20  # bytes of a text whose words are numbered at a time
_STEP = 256  # first length of a word-by-word comparison; it doubles
_SPACES = b" \t\n\x0b\x0c\r"
_RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_sha256 string"


@dataclass
class Numbered:
    """Words of a batch as numbers, where each document's begin, and the words themselves by number."""

    words: np.ndarray
    bounds: list[int]
    table: list[bytes]


def number_words(texts: list[bytes]) -> Numbered:
    """Words are runs of bytes outside of ASCII white space, as ``bytes.split`` has them."""
    known: dict[bytes, int] = {}
    found: list[np.ndarray] = []
    bounds = [0]
    for text in texts:
        n = 0
        for part in _parts(text):
            own = [known.setdefault(w, len(known)) for w in part.split()]
            found.append(np.array(own, np.int32))
            n += len(own)
        bounds.append(bounds[-1] + n)
    return Numbered(np.concatenate(found) if found else np.zeros(0, np.int32), bounds, list(known))


def _parts(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > _PART:
        end = at + _PART
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def planted(words: np.ndarray, h: int | None) -> np.ndarray:
    """A document's words, made periodic from one place on if its number says so."""
    n = len(words)
    if h is None or h % 10 or n == 0:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((words[:a], words[a + np.arange(n - a) % p]))


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """Smallest and largest lag and the length of the k-grams of each scale that a document of so many words can need."""
    low, k = 1, LEAST - 1
    while max(LEAST, TIMES * low) <= longest:
        yield low, k // 2, k
        low = k // 2 + 1
        k = (TIMES - 1) * low


def find_runs(words: np.ndarray, bounds: list[int]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each document, by start and period."""
    edges = np.asarray(bounds, np.int64)
    sizes = np.diff(edges)
    runs: list[dict[tuple[int, int], int]] = [{} for _ in sizes]
    if len(words) == 0:
        return [[] for _ in sizes]
    document = np.repeat(np.arange(len(sizes)), sizes)
    value = mix(words.astype(np.uint64) + np.uint64(1))
    power = np.full(len(words) + 1, _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    # Sums of word values times falling powers: the hash of any k words is one product and one difference.
    back = np.full(len(words) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    back[0] = 1
    back = np.multiply.accumulate(back)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * power[:-1], dtype=np.uint64)))
    places = np.flatnonzero(sizes[document] >= LEAST)
    for low, high, k in scales(int(sizes.max())):
        places = places[places + k <= edges[document[places] + 1]]
        if len(places) < 2:
            break
        gram = mix((total[places + k] - total[places]) * back[places])
        order = np.argsort(gram, kind="stable")  # places come in order, and stay so within a gram
        gram, at = gram[order], places[order]
        same = (gram[1:] == gram[:-1]) & (document[at[1:]] == document[at[:-1]])
        lag = at[1:] - at[:-1]
        seed = np.flatnonzero(same & (lag >= low) & (lag <= high))
        _extend(words, edges, document, at[seed], lag[seed], runs)
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        places = np.sort(at[again])
    return [sorted((start, length, q) for (start, length), q in own.items()) for own in runs]


def _extend(words: np.ndarray, edges: np.ndarray, document: np.ndarray, at: np.ndarray, lag: np.ndarray, runs: list[dict]) -> None:
    """Extend seeds along their diagonals and keep what is long enough."""
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    fresh = np.ones(len(at), bool)  # a seed one place after another on its lag lies in the same stretch
    fresh[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]) | (document[at[1:]] != document[at[:-1]])
    covered: dict[int, int] = {}
    for i, q in zip(at[fresh].tolist(), lag[fresh].tolist(), strict=True):
        if i < covered.get(q, -1):
            continue
        doc = int(document[i])
        low, high = int(edges[doc]), int(edges[doc + 1])
        end = i + _equal(words[i : high - q], words[i + q : high])
        start = i - _equal(words[low:i][::-1], words[low + q : i + q][::-1])
        covered[q] = end
        length = end + q - start
        if length >= max(LEAST, TIMES * q):
            key = (start - low, length)
            runs[doc][key] = min(q, runs[doc].get(key, q))


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two stretches share from their beginning."""
    done, step = 0, _STEP
    while done < len(a):
        differ = a[done : done + step] != b[done : done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, step * 2
    return len(a)


def collapse(words: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int32)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return words[np.cumsum(edge[:-1]) == 0]


def _joined(words: np.ndarray, table: list[bytes]) -> Iterator[bytes]:
    for at in range(0, len(words), 1 << 16):
        own = b" ".join([table[w] for w in words[at : at + (1 << 16)].tolist()])
        yield b" " + own if at else own


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: Column | None = None, with_text: bool = False) -> DataFrame:
    """One row per document: words, every run, and the hash of the collapsed text (and that text, if asked for).

    ``plant`` is a number per row that :func:`planted` takes to make words periodic before the search; null or none leaves all as
    they are.
    """
    h = (plant if plant is not None else F.lit(None)).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), h.alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            numbered = number_words(texts)
            del texts
            bounds = numbered.bounds
            own = [planted(numbered.words[a:b], h) for a, b, h in zip(bounds, bounds[1:], batch.column(2).to_pylist(), strict=False)]
            found = find_runs(np.concatenate(own) if own else numbered.words, bounds)
            out = {"doc_id": batch.column(0), "n_words": pa.array([len(w) for w in own], pa.int64())}
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            out["runs"] = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], kind)
            hashes, kept = [], []
            for words, runs in zip(own, found, strict=True):
                digest, parts = hashlib.sha256(), []
                for part in _joined(collapse(words, runs), numbered.table):
                    digest.update(part)
                    if with_text:
                        parts.append(part)
                hashes.append(digest.hexdigest())
                kept.append(b"".join(parts).decode())
            out["collapsed_sha256"] = pa.array(hashes)
            if with_text:
                out["collapsed"] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return rows.mapInArrow(run, f"doc_id long, {_RESULT}" + (", collapsed string" if with_text else ""))


def crc_of(column: Column) -> Column:
    """CRC of the decimal writing of a number, unsigned; null for null."""
    return F.crc32(column.cast("long").cast("string").cast("binary"))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run with the greatest length for its period, and a hash of the list."""
    # length / period as a pair that compares exactly: a before b if a.length * b.period > b.length * a.period.
    better = lambda a, b: (
        F.when(b["period"].isNull(), a)
        .when(a["period"].isNull(), b)
        .when(a["length"] * b["period"] > b["length"] * a["period"], a)
        .when(a["length"] * b["period"] < b["length"] * a["period"], b)
        .when(F.struct(a["start"], a["period"]) <= F.struct(b["start"], b["period"]), a)
        .otherwise(b)
    )
    none = F.struct(*(F.lit(None).cast("long").alias(n) for n in ("start", "length", "period")))
    best = F.aggregate("runs", none, better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col("best")[n].alias(n) for n in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
