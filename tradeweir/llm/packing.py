"""Best-fit packing by a grouping genetic algorithm (operator 7).

Texts become token ids plus an end id; documents longer than a sequence are cut into pieces of one
full sequence, of which the first may be shorter. A full piece is a sequence by itself. All others are
dealt at random into blocks of bounded size, and each block is packed by several islands of
solutions. A crossover injects well-filled bins of one parent whole into the other, removes the bins
that hold the same documents, and best-fits the documents this displaces; after each epoch every island
receives the best solution of its neighbour. The worst-filled bins of a block are opened again and
packed together with those of seven other blocks, level by level, until one group is left, so that
badly filled bins do not add up with the number of blocks.

Defined results: a null or empty text is the end id alone; equal rows are packed separately; a long text is encoded in
parts that end where the tokenizer ends a word; other columns are ignored. Only lengths are shuffled, never texts or ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweir.llm.common import id_and_text, passes, stored
from tradeweir.llm.tokens import PART, text_parts, vocabulary

CAPACITY = 2048
BLOCK = 4096
FAN = 8
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 16
POPULATION = 6
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False, part: int = PART
) -> DataFrame:
    """Pieces of every document; ``with_ids`` adds their ids as a binary column. Texts of over ``part`` characters are encoded in parts."""
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer)
        for batch in passes(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            all_ids, of = vocab.ids([text if len(text) <= part else "" for text in texts])
            out = []
            for i, doc in enumerate(batch.column(0).to_pylist()):
                own = [all_ids[of[i] : of[i + 1]]]
                if len(texts[i]) > part:
                    own = [vocab.ids([p])[0] for p in text_parts(texts[i], part)]
                ids = np.concatenate((*own, end)).astype("<u4")
                first = len(ids) - (len(ids) - 1) // capacity * capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    own = ids[a:b].tobytes()
                    out.append((doc, k, a, b - a, zlib.crc32(own), *([own] if with_ids else [])))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], names[: len(columns)]
            )

    return id_and_text(docs).mapInArrow(run, PIECE_SCHEMA + ", ids binary" * with_ids)


def best_fit(order, lengths, bin_of, rooms: list[int], capacity: int) -> None:
    """Put the documents of ``order`` each into the fullest bin that has room; extends ``rooms``."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for k, room in enumerate(rooms):
        by_room[room].append(k)
    for room in range(capacity + 1):
        if by_room[room]:
            mask |= 1 << room
    for i in order:
        size = lengths[i]
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, k = capacity, len(rooms)
            rooms.append(capacity)
        room -= size
        rooms[k] = room
        bin_of[i] = k
        by_room[room].append(k)
        mask |= 1 << room


def quality(bin_of: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Larger is better: fewer bins, then bins filled more unequally."""
    fill = np.bincount(bin_of, weights=lengths)
    fill = fill[fill > 0]
    return -len(fill), float(np.mean((fill / capacity) ** 2))


def first_solutions(lengths: np.ndarray, capacity: int, n: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit of falling lengths, and of lengths falling only roughly."""
    out, sizes = [], lengths.tolist()
    for k in range(n):
        noise = rng.uniform(0, 0.08 * k * capacity, len(lengths))
        bin_of = [0] * len(lengths)
        best_fit(np.argsort(-(lengths + noise), kind="stable").tolist(), sizes, bin_of, [], capacity)
        out.append(np.array(bin_of))
    return out


def crossover(
    into: np.ndarray, donor: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator
) -> np.ndarray:
    """``into`` with some well-filled bins of ``donor``; what that displaces goes where it fits best."""
    fill = np.bincount(donor, weights=lengths)
    well = np.flatnonzero(fill >= np.median(fill[fill > 0]))
    injected = np.zeros(len(fill), bool)
    injected[well[rng.random(len(well)) < rng.uniform(0.1, 0.5)]] = True
    given = injected[donor]
    own_fill = np.bincount(into, weights=lengths)
    broken = np.zeros(len(own_fill), bool)
    broken[into[given]] = True
    # Mutation: some of the emptier bins are opened too.
    emptier = np.argsort(own_fill)[: max(2, len(own_fill) // 20)]
    broken[emptier[rng.random(len(emptier)) < 0.5]] = True
    keys = np.where(given, len(own_fill) + donor, into)
    loose = ~given & broken[into]
    used, dense = np.unique(keys[~loose], return_inverse=True)
    child = np.full(len(lengths), -1)
    child[~loose] = dense
    rooms = (capacity - np.bincount(dense, weights=lengths[~loose], minlength=len(used))).astype(int).tolist()
    order = np.flatnonzero(loose)
    order = order[np.argsort(-lengths[order], kind="stable")].tolist()
    bin_of = child.tolist()
    best_fit(order, lengths.tolist(), bin_of, rooms, capacity)
    return np.array(bin_of)


def evolve(
    population: list[np.ndarray], lengths: np.ndarray, capacity: int, generations: int, rng: np.random.Generator
) -> list[np.ndarray]:
    """Best first. A child takes the place of the worst solution if it is better."""
    ranked = sorted(((quality(s, lengths, capacity), k, s) for k, s in enumerate(population)), reverse=True)
    for g in range(generations if len(lengths) > 1 else 0):
        a, b = sorted(rng.choice(len(ranked), 2, replace=False))
        child = crossover(ranked[a][2], ranked[b][2], lengths, capacity, rng)
        entry = (quality(child, lengths, capacity), -1 - g, child)
        if entry[0] > ranked[-1][0]:
            ranked = sorted([*ranked[:-1], entry], reverse=True, key=lambda x: x[:2])
    return [x[2] for x in ranked]


_STATE = "block long, island int, uids binary, lengths binary, bins binary"


def _pack(rows: DataFrame, level: int, capacity: int, release: bool) -> DataFrame:
    """Pack (uid, length, block) in each block; bins to be opened again have ``open``."""

    def begin(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid")
        lengths = rows["length"].to_numpy(np.int64)
        rng = np.random.default_rng([level, key[0], key[1]])
        found = first_solutions(lengths, capacity, POPULATION, rng)
        return state(*key, rows["uid"].to_numpy(np.int64), lengths, evolve(found, lengths, capacity, GENERATIONS, rng))

    def state(block, island, uids, lengths, population) -> pd.DataFrame:
        bins = np.concatenate(population).astype(np.int32).tobytes()
        return pd.DataFrame(
            {"block": [block], "island": [island], "uids": [uids.tobytes()], "lengths": [lengths.tobytes()], "bins": [bins]}
        )

    def go_on(epoch: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for row in frame.itertuples():
                    uids, lengths = np.frombuffer(row.uids, np.int64), np.frombuffer(row.lengths, np.int64)
                    own = list(np.frombuffer(row.bins, np.int32).reshape(POPULATION, -1))
                    own[-1] = np.frombuffer(row.elite, np.int32)
                    rng = np.random.default_rng([level, row.block, row.island, epoch])
                    yield state(row.block, row.island, uids, lengths, evolve(own, lengths, capacity, GENERATIONS, rng))

        return run

    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("island")
        lengths = np.frombuffer(rows["lengths"].iloc[0], np.int64)
        best = max(
            (np.frombuffer(b, np.int32)[: len(lengths)] for b in rows["bins"]), key=lambda s: quality(s, lengths, capacity)
        )
        used, bins = np.unique(best, return_inverse=True)
        fill = np.bincount(bins, weights=lengths)
        size = np.bincount(bins)
        worst = np.argsort(fill, kind="stable")
        opened = np.zeros(len(used), bool)
        if release:
            opened[worst[np.cumsum(size[worst]) <= BLOCK // FAN]] = True
            opened[fill == capacity] = False
        out = pd.DataFrame(
            {"uid": np.frombuffer(rows["uids"].iloc[0], np.int64), "length": lengths, "bin": bins, "open": opened[bins]}
        ).sort_values(["bin", "uid"])
        out["place"] = out.groupby("bin")["length"].cumsum() - out["length"]
        out["block"] = key[0]
        return out[["uid", "length", "block", "bin", "open", "place"]]

    islands = rows.withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
    now = islands.groupBy("block", "island").applyInPandas(begin, _STATE)
    everyone = Window.partitionBy("block").orderBy("island").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    one = F.substring("bins", 1, (F.octet_length("lengths") / 2).cast("int"))
    for epoch in range(1, EPOCHS):
        elites = F.collect_list(one).over(everyone)
        from_island = F.pmod(F.col("island") - 1, F.lit(ISLANDS)) + 1
        now = now.withColumn("elite", F.element_at(elites, from_island.cast("int"))).mapInPandas(go_on(epoch), _STATE)
    packed = now.groupBy("block").applyInPandas(
        finish, "uid long, length long, block long, bin long, open boolean, place long"
    )
    return stored(packed, "packed")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (any columns, ``length`` among them)."""
    table = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = table.where(F.col("length") >= capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = table.where(F.col("length") < capacity).select("uid", "length")
    blocks = max(1, -(-rest.count() // BLOCK))
    rows = rest.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    placed, level = full, 0
    while True:
        packed = _pack(rows, level, capacity, release=blocks > 1)
        number = ((F.lit(level) * (1 << 38)) + F.col("block")) * (1 << 16) + F.col("bin")
        placed = placed.union(
            packed.where("not open").select("uid", number.alias("sequence_id"), F.col("place").alias("offset"))
        )
        if blocks == 1:
            break
        blocks, level = -(-blocks // FAN), level + 1
        rows = packed.where("open").select("uid", "length", (F.col("block") % blocks).alias("block"))
    return table.join(placed, "uid").drop("uid")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)
