"""Removal of repeated byte strings by a merge sort of suffixes that knows common prefixes (operator 5).

Every string of ``window`` bytes that also starts earlier (smaller doc_id, or earlier in the same document) is
removed. A window's anchor is the place of its smallest 24-byte hash, so equal windows have equal anchors
at equal distances, and only suffixes at anchors are needed.

1. Consecutive windows with one anchor are a run. Runs meet by the hash of the anchor's 24 bytes. Of runs with
   the same bytes all but the earliest are repeats as they stand; what is left is alone with its 24 bytes, or
   a candidate whose windows may be partly repeated.
2. The suffixes at candidate anchors are sorted within a task, dealt by their first 24 bytes, front-coded (length of the prefix
   shared with the suffix before, and the rest) and exchanged as runs. Each range merges its sorted runs with a
   loser tree that carries common prefix lengths and never compares a known prefix again.
3. From the common prefixes of neighbours to the right of the anchor, and those to its left, windows of a range
   fall into classes of equal strings; all but the earliest of a class are repeats.
4. Where more than ``HOT`` candidates share their 24 bytes, 2 and 3 are left out: each of their windows meets
   its equals by the MD5 of its own bytes.

Anchors only leave out what can't repeat: every decision in 2 and 3 is on bytes, those in 1 and 4 on 128 bits of hash. Runs
repeated within one pass of a task are settled there, so that a group of copies sends a row per pass; 24 bytes with
many different surroundings in a pass are dealt out further.

Defined results: a null or empty text has no bytes and nothing removed; rows with equal ids and equal texts have the
same result and don't remove each other; a null id comes before all others; strings never cross documents;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.anchors import GRAM, anchors
from tradeweir.llm.common import id_and_text, passes, stored
from tradeweir.llm.words import mix, utf8

WINDOW = 100
PASS = 1 << 20  # bytes of text of one numpy pass, which takes a worker to about 150 MB; longer texts are cut
CROWD = 16  # different surroundings of 24 bytes in a pass from which on they are dealt out further
RANGE = 30_000  # suffixes that one task merges
HOT = 30_000  # candidates with equal 24 bytes from which on their windows meet one by one
_NULL_ID = -(1 << 63)
_RUN = "deal long, gram long, context long, d long, th long, first long, last int, place int, kind int"


def _keyed(docs: DataFrame, carry: dict[str, str]) -> DataFrame:
    """Id without nulls, text and its hash (what identifies a row), and other columns under new names."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
    return docs.select(d.alias("d"), F.xxhash64(text).alias("th"), text.alias("text"), *(F.col(c).alias(n) for c, n in carry.items()))


def _firsts(keys: list[np.ndarray], d: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, then id and place; and in that order, which rows come later than the first of their keys."""
    order = np.lexsort((start, d, *keys[::-1]))
    same = np.ones(len(order), bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[order][1:] == k[order][:-1]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    later = same & ((d[order] != d[order][head]) | (start[order] != start[order][head]))
    return order, later


def _runs(docs: DataFrame, window: int) -> DataFrame:
    """Kind 0: a run to compare (``last`` and ``place`` count from ``first``). Kind 1: bytes ``first`` to ``first + last`` repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, limit=PASS):
            data, bounds = utf8(batch.column(2))
            if len(data) > PASS:  # one long text, in parts that overlap by a window
                for part, part_bounds, offset in _parts(data, bounds, window):
                    yield from one(part, part_bounds, batch, offset)
            else:
                yield from one(data, bounds, batch, None)

    def one(data: np.ndarray, bounds: np.ndarray, batch: pa.RecordBatch, offset) -> Iterator[pa.RecordBatch]:
        a = anchors(data, bounds, window)
        if len(a.first) == 0:
            return
        row, shift = (a.document, -bounds[a.document]) if offset is None else (np.full(len(a.first), offset[0]), offset[1])
        d = batch.column(0).to_numpy()[row]
        th = batch.column(1).to_numpy()[row]
        gram, context = a.gram.view(np.int64), a.context.view(np.int64)
        first = a.first + shift
        order, later = _firsts([gram, context], d, first)
        keep = order[~later]
        crowd = gram[keep]
        begins = np.flatnonzero(np.concatenate(([True], crowd[1:] != crowd[:-1])))
        size = np.diff(begins, append=len(crowd))
        many = np.repeat(size > CROWD, size)
        nth = np.arange(len(crowd)) - np.repeat(begins, size)
        deal = np.where(many, mix(gram[keep].view(np.uint64) ^ mix(a.context[keep])).view(np.int64), gram[keep])
        kind = np.where(many, 2, 0)
        scouts = np.flatnonzero(many & (nth < 2))  # tell the others that these 24 bytes are shared
        gone = np.sort(order[later])
        starts = first[gone]
        ends = (a.last - a.first)[gone] + window + starts
        new = np.ones(len(gone), bool)
        new[1:] = (row[gone][1:] != row[gone][:-1]) | (starts[1:] > ends[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(gone))[: len(head)] - 1
        at = np.concatenate((keep, keep[scouts], gone[head]))
        none = np.zeros(len(head), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((deal, gram[keep][scouts], mix(np.arange(len(head), dtype=np.uint64)).view(np.int64)))),
                pa.array(np.concatenate((gram[keep], gram[keep][scouts], none))),
                pa.array(np.concatenate((context[keep], context[keep][scouts], none))),
                pa.array(d[at]),
                pa.array(th[at]),
                pa.array(first[at]),
                pa.array(np.concatenate(((a.last - a.first)[keep], (a.last - a.first)[keep][scouts], ends[tail] - starts[head])).astype(np.int32)),
                pa.array((a.place - a.first)[at].astype(np.int32)),
                pa.array(np.concatenate((kind, np.zeros(len(scouts), int), none + 1)).astype(np.int32)),
            ],
            ["deal", "gram", "context", "d", "th", "first", "last", "place", "kind"],
        )

    return docs.mapInArrow(run, _RUN)


def _parts(data: np.ndarray, bounds: np.ndarray, window: int) -> Iterator[tuple]:
    step = max(PASS - window, 1)
    for i in range(len(bounds) - 1):
        for at in range(int(bounds[i]), max(int(bounds[i + 1]) - window + 1, int(bounds[i]) + 1), step):
            part = data[at : min(at + step + window - 1, int(bounds[i + 1]))]
            yield part, np.array([0, len(part)]), (i, at - int(bounds[i]))


def _met(runs: DataFrame, window: int) -> DataFrame:
    """Rows (d, th, kind, first, last, place, gram): kind 1 repeated bytes, kind 0 candidates."""

    def judge(frame: pa.Table) -> pa.Table:
        gram, context, d, first, last, kind = (
            frame.column(c).to_numpy() for c in ("gram", "context", "d", "first", "last", "kind")
        )
        order, later = _firsts([gram, context], d, first)
        new = np.ones(len(order), bool)
        new[1:] = gram[order][1:] != gram[order][:-1]
        group = np.cumsum(new) - 1
        low = np.full(group[-1] + 1, np.iinfo(np.int64).max)
        high = np.full(group[-1] + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, group, context[order])
        np.maximum.at(high, group, context[order])
        shared = (low < high)[group] | (kind[order] == 2)
        use = order[later | shared]
        is_later = later[later | shared]
        out = frame.take(pa.array(use))
        length = np.where(is_later, last[use] + window, last[use]).astype(np.int32)
        columns = [out.column("d"), out.column("th"), pa.array(is_later.astype(np.int32)), out.column("first"), pa.array(length), out.column("place"), out.column("gram")]
        return pa.table(columns, ["d", "th", "kind", "first", "last", "place", "gram"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            spans = batch.filter(pa.compute.equal(batch.column(8), 1))
            if len(spans):
                yield spans.select(["d", "th", "kind", "first", "last", "place", "gram"])
            batch = batch.filter(pa.compute.not_equal(batch.column(8), 1))
            if len(batch) == 0:
                continue
            # Rows come sorted by gram; the last gram of a batch may go on in the next.
            gram = batch.column(1).to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))
            if cut == 0 and held and held[-1].column(1)[-1].as_py() == gram[-1]:
                held.append(batch)
                continue
            held.append(batch.slice(0, cut))
            table = pa.Table.from_batches(held)
            if len(table):
                yield from judge(table).to_batches()
            held = [batch.slice(cut)]
        table = pa.Table.from_batches(held) if held else None
        if table is not None and len(table):
            yield from judge(table).to_batches()

    dealt = runs.repartition("deal").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, "d long, th long, kind int, first long, last int, place int, gram long")


class Run:
    """A sorted run of front-coded strings, read one by one."""

    __slots__ = ("prefix", "rest", "at", "n", "string", "lcp", "base")

    def __init__(self, prefix: bytes, rest: list[bytes], base: int) -> None:
        self.prefix, self.rest, self.n, self.base = prefix, rest, len(rest), base
        self.at, self.lcp, self.string = 0, 0, rest[0]

    def advance(self) -> bool:
        self.at += 1
        if self.at == self.n:
            return False
        # Its prefix shared with the string just given out, the last winner, is known from the code.
        self.lcp = self.prefix[self.at]
        self.string = self.string[: self.lcp] + self.rest[self.at]
        return True


def front_code(strings: list[bytes]) -> tuple[bytes, list[bytes]]:
    """Length of the prefix shared with the string before, and the rest, of sorted strings of at most 255 bytes."""
    prefix, rest, before = bytearray(), [], b""
    for s in strings:
        n = common(before, s, 0)
        prefix.append(n)
        rest.append(s[n:])
        before = s
    return bytes(prefix), rest


def common(a: bytes, b: bytes, n: int) -> int:
    """Length of the common prefix of strings that are known to share ``n`` bytes."""
    end = min(len(a), len(b))
    if a[n:end] == b[n:end]:
        return end
    x = int.from_bytes(a[n:end], "big") ^ int.from_bytes(b[n:end], "big")
    return end - (x.bit_length() + 7) // 8


def merge(runs: list[Run]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all strings in sorted order and the prefix that each shares with the one before."""
    k = 1
    while k < len(runs):
        k *= 2
    players: list[Run | None] = [*runs, *[None] * (k - len(runs))]
    losers: list[Run | None] = [None] * k

    def play(a: Run | None, b: Run | None) -> tuple[Run | None, Run | None]:
        """Winner and loser. Both prefixes are known against the last winner: the longer one is the smaller string."""
        if a is None or b is None:
            return (a, b) if b is None else (b, a)
        if a.lcp != b.lcp:
            return (a, b) if a.lcp > b.lcp else (b, a)
        n = common(a.string, b.string, a.lcp)
        if a.string[n:] <= b.string[n:]:
            b.lcp = n
            return a, b
        a.lcp = n
        return b, a

    def build(node: int) -> Run | None:
        if node >= k:
            return players[node - k]
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    place = {id(r): k + i for i, r in enumerate(runs)}
    winner = build(1)
    total = sum(r.n for r in runs)
    order, shared = np.empty(total, np.int64), np.empty(total, np.int64)
    for i in range(total):
        order[i], shared[i] = winner.base + winner.at, winner.lcp
        node = place[id(winner)] >> 1
        now: Run | None = winner if winner.advance() else None
        while node:
            now, losers[node] = play(now, losers[node])
            node >>= 1
        winner = now
    return order, shared


def _repeated(order: np.ndarray, shared: np.ndarray, left: list[bytes], least: np.ndarray, most: np.ndarray, d: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """For each suffix (row) and distance of the anchor from the window's start (column): is the window a repeat?"""
    n, width = len(order), int(most.max()) + 1
    right_of = np.empty(n, np.int64)
    right_of[order] = shared
    padded = np.zeros((n, max(width, 1)), np.uint8)
    for i, s in enumerate(left):
        padded[i, : len(s)] = np.frombuffer(s, np.uint8)
    by_left = np.lexsort(padded.T[::-1]) if width else np.arange(n)
    ranked = padded[by_left]
    differ = ranked[1:] != ranked[:-1]
    left_shared = np.zeros(n, np.int64)
    left_shared[1:] = np.where(differ.any(1), differ.argmax(1), padded.shape[1])
    _, rank = np.unique(np.rec.fromarrays([d, place]), return_inverse=True)
    out = np.zeros((n, width), bool)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(width):
        valid = np.flatnonzero((least <= o) & (o <= most))
        if len(valid) < 2:
            continue
        right_class[order] = np.cumsum(shared < window - o)
        left_class[by_left] = np.cumsum(left_shared < o)
        key = right_class[valid] * (n + 1) + left_class[valid]
        own = np.lexsort((rank[valid], key))
        same = np.zeros(len(own), bool)
        same[1:] = key[own][1:] == key[own][:-1]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(own))))
        r = rank[valid][own]
        out[valid[own], o] = same & (r > r[head])
    return out


def _suffix_runs(joined: DataFrame, ranges: int, window: int) -> DataFrame:
    """Sorted front-coded runs of the candidates' suffixes, one row for each pass and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, limit=8 << 20):
            found = []
            for d, text, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not rows:
                    continue
                data = text.encode()
                th = rows[0]["th"]
                for r in rows:
                    if r["hot"]:
                        continue
                    first, last, at = r["first"], r["first"] + r["last"], r["first"] + r["place"]
                    found.append((data[at : last + window], data[first:at][::-1], d, th, at, at - last, at - first))
            # Suffixes that share the anchor's 24 bytes must meet; more order between ranges isn't needed.
            found = sorted((zlib.crc32(f[0][:GRAM]) % ranges, *f) for f in found)
            own = [f[0] for f in found]
            for r in sorted(set(own)):
                part = found[bisect_left(own, r) : bisect_right(own, r)]
                prefix, rest = front_code([f[1] for f in part])
                numbers = np.array([f[3:] for f in part], np.int64)
                left = [f[2] for f in part]
                run = {"range": r, "prefix": prefix, "rests": lengths(rest), "rest": b"".join(rest)}
                run |= {"lefts": lengths(left), "left": b"".join(left), "numbers": np.ascontiguousarray(numbers.T).tobytes()}
                yield pa.RecordBatch.from_pylist([run], schema=_ARROW_RUN)

    return joined.mapInArrow(run, "range int, prefix binary, rests binary, rest binary, lefts binary, left binary, numbers binary")


_ARROW_RUN = pa.schema([("range", pa.int32()), *((n, pa.binary()) for n in ("prefix", "rests", "rest", "lefts", "left", "numbers"))])


def lengths(strings: list[bytes]) -> bytes:
    return np.array([len(s) for s in strings], np.uint8).tobytes()


def _split(data: bytes, sizes: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(sizes, np.uint8), dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _merged(runs: DataFrame, window: int) -> DataFrame:
    """Repeated bytes found among the suffixes of each range."""

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        sorted_runs, left, numbers, base = [], [], [], 0
        for row in rows.itertuples():
            sorted_runs.append(Run(row.prefix, _split(row.rest, row.rests), base))
            left += _split(row.left, row.lefts)
            numbers.append(np.frombuffer(row.numbers, np.int64).reshape(5, -1))
            base += len(row.prefix)
        d, th, place, least, most = np.concatenate(numbers, axis=1)
        order, shared = merge(sorted_runs)
        again = _repeated(order, shared, left, least, most, d, place, window)
        edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edge == 1)
        _, high = np.nonzero(edge == -1)
        return pd.DataFrame({"d": d[row], "th": th[row], "first": place[row] - high + 1, "last": (high - low - 1 + window).astype(np.int32)})

    return runs.groupBy("range").applyInPandas(task, "d long, th long, first long, last int")


def _hot_repeats(joined: DataFrame, window: int) -> DataFrame:
    """Repeated bytes among the hot candidates: their windows meet one by one, by a hash of their own bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, limit=1 << 20):
            found: list[tuple] = []
            for d, text, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                for r in rows:
                    if r["hot"]:
                        for p in range(r["first"], r["first"] + r["last"] + 1):
                            found.append((hashlib.md5(data[p : p + window]).digest(), d, r["th"], p))
                if len(found) >= 1 << 16:
                    yield of(found)
                    found = []
            if found:
                yield of(found)

    def of(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["own", "d", "th", "p"])

    hot = joined.where(F.exists("rows", lambda r: r["hot"]))
    windows = stored(hot.mapInArrow(run, "own binary, d long, th long, p long"), "hot")
    # Sums come before the shuffle, and a window that many hold is split by the join: no task gets all of its places.
    at = F.struct("d", "p")
    least = windows.groupBy("own").agg(F.min(at).alias("least"), F.max(at).alias("most")).where("least <> most")
    later = windows.join(least.select("own", "least"), "own").where(at != F.col("least"))
    return later.select("d", "th", F.col("p").alias("first"), F.lit(window).alias("last"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: bytes, removed bytes and spans, hash of what is left, and what is left.

    ``kept_text`` leaves out bytes of a character that was cut. Columns named in ``carry`` follow.
    """
    names = {c: f"carry_{i}" for i, c in enumerate(carry)}
    rows = _keyed(docs, names)
    met = stored(_met(_runs(rows.select("d", "th", "text"), window), window), "met")
    spans, candidates = met.where("kind = 1"), met.where("kind = 0").distinct()
    # At most one in HOT candidates is another such gram.
    crowds = [r.gram for r in candidates.groupBy("gram").count().where(F.col("count") > HOT).collect()]
    hot = F.col("gram").isin(crowds) if crowds else F.lit(False)
    grouped = candidates.groupBy("d", "th").agg(F.collect_list(F.struct("th", "first", "last", "place", hot.alias("hot"))).alias("rows"))
    joined = rows.join(grouped, ["d", "th"], "left").select("d", "text", "rows")
    # Equal rows would meet as one place twice, which is not a repeat, so that they may stay.
    ranges = max(1, -(-candidates.count() // RANGE))
    found = _merged(_suffix_runs(joined, ranges, window), window)
    if crowds:
        found = found.union(_hot_repeats(joined, window))
    every = spans.select("d", "th", "first", "last").union(found).groupBy("d", "th")
    every = every.agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, limit=PASS):
            out = []
            for d, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                kept, removed, n, end = [], 0, 0, 0
                for first, last in sorted((s["first"], s["first"] + s["last"]) for s in found or ()):
                    if first > end or n == 0:
                        kept.append(data[end:first])
                        n += 1
                        start = first
                    else:
                        start = end
                    if last > start:
                        removed += last - start
                    end = max(end, last)
                kept.append(data[end:])
                left = b"".join(kept)
                out.append((None if d == _NULL_ID else d, len(data), removed, n, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[3:]], [*_RESULT, *names.values()])

    whole = rows.join(every, ["d", "th"], "left").select("d", "text", "spans", *names.values())
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    schema += "".join(f", {n} {docs.schema[c].dataType.simpleString()}" for c, n in names.items())
    return whole.mapInArrow(finish, schema).toDF(*_RESULT, *carry)


_RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
