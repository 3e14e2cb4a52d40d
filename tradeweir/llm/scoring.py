"""Stupid-backoff scores of documents (operator 1).

The score of a word after another is count(pair) / count(first word) if the pair occurs ``min_count`` times or
more in the corpus, else ``alpha`` times count(word) / number of words; the first word of a document has no
context and takes the latter without ``alpha``. All counts are over all documents.

Documents are dealt into chunks by a hash. Each chunk sends every different n-gram once, with its own count, to
the n-gram table's partition (by the n-gram's hash); the table adds the counts up and answers each chunk in
the order asked; the chunk, whose documents are already in place, adds logarithms per document. A frequent
n-gram is one row per chunk, however often it occurs.

Defined results: a null or empty text has no words and a null score; equal rows are scored each and both
count; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import id_and_text
from tradeweir.llm.words import grams, words_of

ALPHA = 0.4
MIN_COUNT = 2
CHUNK_BYTES = 4 << 20
TABLE_BYTES = 16 << 20
_ALL = np.uint64(0xA5A5A5A5A5A5A5A5)  # stands for any word in the table


def planes(values: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers by significance, so that leading zeros compress away."""
    return values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


class Chunk:
    """N-grams of the documents of a chunk and where each is used."""

    def __init__(self, texts: pa.Array, tables: int) -> None:
        self.words = words_of(texts)
        h = self.words.hashes
        document = np.repeat(np.arange(len(texts)), np.diff(self.words.first))
        self.paired = np.zeros(len(h), bool)
        self.paired[1:] = document[1:] == document[:-1]
        pairs = np.zeros(len(h), np.uint64)
        pairs[1:] = grams(h, 2) if len(h) > 1 else 0
        keys = np.concatenate([h, pairs[self.paired], np.full(len(h), _ALL)])
        self.keys, self.use, self.counts = np.unique(keys, return_inverse=True, return_counts=True)
        self.table = ((self.keys >> np.uint64(20)) % np.uint64(tables)).astype(np.int64)
        self.order = np.argsort(self.table, kind="stable")
        self.bounds = np.searchsorted(self.table[self.order], np.arange(tables + 1))

    def scores(self, totals: np.ndarray) -> list[float | None]:
        """Sums of logarithms; ``totals`` are the corpus' counts of ``keys``."""
        n, of = len(self.words.hashes), totals[self.use].astype(float)
        word, pair, everything = of[:n], np.zeros(n), of[-1:]
        pair[self.paired] = of[n : n + self.paired.sum()]
        before = np.concatenate([np.ones(1), word[:-1]])[:n]
        alone = np.log(np.where(self.paired, ALPHA, 1.0)) + np.log(word) - np.log(everything)
        logs = np.where(pair > 0, np.log(np.maximum(pair, 1)) - np.log(before), alone)
        first = self.words.first
        each = [logs[a:b].sum() for a, b in zip(first[:-1], first[1:], strict=True)]
        return [float(s) if b > a else None for s, a, b in zip(each, first[:-1], first[1:], strict=True)]


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, table_bytes: int = TABLE_BYTES, min_count: int = MIN_COUNT) -> DataFrame:
    """One row per document row: its words, the sum of log scores, and their mean."""
    docs = id_and_text(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, tables = size // chunk_bytes + 1, size // table_bytes + 1
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def ask(rows: pa.Table) -> pa.Table:
        chunk = Chunk(rows.column("text"), tables)
        out = []
        for t in np.flatnonzero(np.diff(chunk.bounds)).tolist():
            own = chunk.order[chunk.bounds[t] : chunk.bounds[t + 1]]
            keys = chunk.keys[own]
            out.append((t, planes(np.diff(keys, prepend=np.uint64(0))), planes(chunk.counts[own])))
        number = rows.column("chunk")[0].as_py()
        columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))]
        return pa.table([*columns, pa.array([number] * len(out), pa.int64())], ["ngrams", "keys", "counts", "chunk"])

    def answer(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(from_planes(x), dtype=np.uint64) for x in rows.column("keys").to_pylist()]
        counts = np.concatenate([from_planes(x) for x in rows.column("counts").to_pylist()])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(which, weights=counts)[which].astype(np.uint64)
        ends = np.cumsum([len(k) for k in keys])
        replies = [planes(x) for x in np.split(totals, ends[:-1])]
        return pa.table([rows.column("chunk"), rows.column("ngrams"), pa.array(replies, pa.binary())], ["chunk", "ngrams", "totals"])

    def finish(rows: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(rows.column("text"), tables)
        totals = np.zeros(len(chunk.keys), np.uint64)
        for t, data in zip(replies.column("ngrams").to_pylist(), replies.column("totals").to_pylist(), strict=True):
            totals[chunk.order[chunk.bounds[t] : chunk.bounds[t + 1]]] = from_planes(data)
        n = len(chunk.words.hashes)
        pairs = np.unique(chunk.use[n : n + int(chunk.paired.sum())])
        totals[pairs] = np.where(totals[pairs] >= min_count, totals[pairs], 0)
        sums = pa.array(chunk.scores(totals) if n else [None] * len(rows), pa.float64())
        count = pa.array(np.diff(chunk.words.first).astype(np.int64))
        return pa.table([rows.column("doc_id"), count, sums], ["doc_id", "n_words", "log_score"])

    asked = dealt.groupBy("chunk").applyInArrow(ask, "ngrams long, keys binary, counts binary, chunk long")
    told = asked.groupBy("ngrams").applyInArrow(answer, "chunk long, ngrams long, totals binary")
    out = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(finish, "doc_id long, n_words long, log_score double")
    return out.withColumn("mean_log_score", F.col("log_score") / F.when(F.col("n_words") > 0, F.col("n_words")))
