"""Near-duplicate vectors by tiled comparison in principal-axis order (operator 9).

Equal vectors are one class. Unit vectors are turned to their principal axes, so that leading
coordinates hold most of the length. Vectors within the threshold differ by at most sqrt(2 - 2t) in every
coordinate: cells of that side on the two first axes need only be compared with their neighbours. The
cells are dealt into blocks of bounded size by a hash, and each pair of blocks is one task. There
leading dimensions are multiplied first; a pair goes on only while its product so far plus
the product of what is left of both lengths can reach the threshold. The cosine that decides is computed
from the given components in double precision.

A task returns numbers of links per class and a spanning forest of its links, never all pairs. Defined results: null
and zero vectors, and those with null or non-finite components, have no links; vectors of different length
are not compared; equal vectors under equal or different ids are linked rows; a null id is never the smallest; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import components, stored

THRESHOLD = 0.95
BLOCK = 4096
TILE = 1024
LEADING = (8, 24)
SLACK = 1e-9


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of links that join everything which a 0/1 matrix of links joins."""
    rows_left, columns_left = linked.any(1), linked.any(0)
    a, b = [], []
    while rows_left.any():
        row = np.array([np.argmax(rows_left)])
        rows_left[row] = False
        while len(row):
            part = linked[row] & columns_left
            column = np.flatnonzero(part.any(0))
            if len(column) == 0:
                break
            a.append(row[part[:, column].argmax(0)])
            b.append(column)
            columns_left[column] = False
            part = linked[:, column] & rows_left[:, None]
            row = np.flatnonzero(part.any(1))
            a.append(row)
            b.append(column[part[row].argmax(1)])
            rows_left[row] = False
    return np.concatenate([*a, np.zeros(0, int)]), np.concatenate([*b, np.zeros(0, int)])


def tile_links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, xt: np.ndarray, yt: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``x`` and ``y`` (unit vectors; ``xt``, ``yt`` turned) have the cosine."""
    near = None
    done, product = 0, np.zeros((len(x), len(y)))
    for upto in (*LEADING, x.shape[1]):
        upto = min(upto, x.shape[1])
        if upto == done:
            continue
        if near is None or near.mean() > 0.02:
            product += xt[:, done:upto] @ yt[:, done:upto].T
            rest_x, rest_y = (np.sqrt(np.maximum((v[:, upto:] ** 2).sum(1), 0)) for v in (xt, yt))
            near = product + rest_x[:, None] * rest_y >= threshold - SLACK
            done = upto
            continue
        break
    if not near.any():
        return near
    if near.mean() > 0.02:
        exact = x @ y.T
        near &= exact >= threshold - SLACK
        edge = near & (np.abs(exact - threshold) < SLACK)
        i, j = np.nonzero(edge)
    else:
        i, j = np.nonzero(near)
    for at in range(0, len(i), 100_000):
        p, q = i[at : at + 100_000], j[at : at + 100_000]
        near[p, q] = (x[p] * y[q]).sum(1) >= threshold
    return near


def compare(key: tuple, rows: pd.DataFrame, axes: np.ndarray, threshold: float) -> pd.DataFrame:
    """Links between the two sides of a pair of blocks, as counts (b null) and forest edges."""
    same = key[0] == key[2] and key[1] == key[3]
    sides = []
    for left in (True, False):
        own = rows[rows["on_left"] == (left or same)]
        x = np.stack(own["x"].to_numpy()).astype(float) if len(own) else np.zeros((0, len(axes)))
        x = x / np.sqrt((x**2).sum(1, keepdims=True)) if len(own) else x
        turned = x @ axes
        order = np.argsort(turned[:, 0], kind="stable")
        sides.append((own["class"].to_numpy()[order], own["n"].to_numpy()[order], x[order], turned[order]))
    (ca, na, xa, ta), (cb, nb, xb, tb) = sides
    reach = np.sqrt(2 - 2 * threshold) + SLACK
    links: dict[int, np.ndarray] = {0: np.zeros(len(ca), np.int64), 1: np.zeros(len(cb), np.int64)}
    edges = []
    for i in range(0, len(ca), TILE):
        a = slice(i, i + TILE)
        for j in range(i if same else 0, len(cb), TILE):
            b = slice(j, j + TILE)
            if tb[b][0, 0] > ta[a][-1, 0] + reach or tb[b][-1, 0] < ta[a][0, 0] - reach:
                continue
            near = tile_links(xa[a], xb[b], axes, ta[a], tb[b], threshold)
            if same and i == j:
                np.fill_diagonal(near, False)
            links[0][a] += near @ nb[b]
            if not (same and i == j):
                links[1][b] += na[a] @ near
            p, q = forest(near)
            edges.append(np.column_stack([ca[a][p], cb[b][q]]))
    pairs = np.concatenate([*edges, np.zeros((0, 2), np.int64)])
    counts = [(c, n) for own, n_links in ((ca, links[0]), (cb, links[1])) for c, n in zip(own, n_links, strict=True) if n]
    return pd.DataFrame(
        {
            "a": np.concatenate([pairs[:, 0], np.array([c for c, _ in counts], np.int64)]),
            "b": pd.array([*pairs[:, 1].tolist(), *[None] * len(counts)], "Int64"),
            "links": np.concatenate([np.zeros(len(pairs), np.int64), np.array([n for _, n in counts], np.int64)]),
        }
    )


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the second moments of the unit vectors; each partition adds one dim x dim matrix."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy()).astype(float)
                x /= np.sqrt((x**2).sum(1, keepdims=True))
                total += x.T @ x
        yield pd.DataFrame({"part": [TaskContext.get().partitionId() % 16], "sums": [total.tobytes()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [sum(np.frombuffer(b) for b in frame["sums"]).tobytes()]})

    parts = classes.select("x").mapInPandas(sums, "part int, sums binary")
    parts = parts.groupBy("part").applyInPandas(add, "sums binary").collect()
    values, axes = np.linalg.eigh(sum(np.frombuffer(r[0]) for r in parts).reshape(dim, dim))
    return np.ascontiguousarray(axes[:, np.argsort(-values)])


def links(classes: DataFrame, dim: int, threshold: float, block: int) -> DataFrame:
    """Counts and forest edges between classes of one length."""
    axes = principal_axes(classes, dim)
    side = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + SLACK

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["x"].to_numpy()).astype(float)
                turned = (x / np.sqrt((x**2).sum(1, keepdims=True))) @ axes[:, :2]
                cell = np.floor((np.column_stack([turned, np.zeros((len(x), 2 - turned.shape[1]))]) + 1) / side)
                frame = frame.assign(cell=(cell[:, 0] * 100_000 + cell[:, 1]).astype(np.int64))
                yield frame[["class", "n", "x", "cell"]]

    # The side is fixed, and coordinates of unit vectors are within -1 and 1: at most (2 / side + 2)^2 cells.
    placed = classes.select("class", "n", "x").mapInPandas(place, "class long, n long, x array<float>, cell long")
    blocks = {r[0]: -(-r[1] // block) for r in placed.groupBy("cell").count().collect()}
    pairs = []
    for cell in blocks:
        for other in (cell, cell + 1, cell + 99_999, cell + 100_000, cell + 100_001):
            if other in blocks:
                pairs.append((cell, blocks[cell], other, blocks[other]))
    spark = classes.sparkSession
    table = F.broadcast(spark.createDataFrame(pairs, "c1 long, n1 long, c2 long, n2 long"))
    own = placed.withColumn("h", F.xxhash64("class"))
    left = own.join(table, F.col("cell") == F.col("c1")).withColumn("i", F.pmod("h", "n1"))
    left = left.withColumn("j", F.explode(F.when(F.col("c1") == F.col("c2"), F.sequence("i", F.col("n2") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("n2") - 1))))
    right = own.join(table, F.col("cell") == F.col("c2")).withColumn("j", F.pmod("h", "n2"))
    right = right.withColumn("i", F.explode(F.when(F.col("c1") == F.col("c2"), F.sequence(F.lit(0).cast("long"), "j")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("n1") - 1))))
    right = right.where("not (c1 = c2 and i = j)")
    columns = ["c1", "i", "c2", "j", "class", "n", "x"]
    sides = left.select(*columns, F.lit(True).alias("on_left")).union(right.select(*columns, F.lit(False).alias("on_left")))
    # A block has about ``block`` vectors, so that a group has twice as many, whatever the table.
    return sides.groupBy("c1", "i", "c2", "j").applyInPandas(
        lambda key, rows: compare(key, rows, axes, threshold), "a long, b long, links long"
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``vectors``: vec_id and embedding. One row per row: n_links, component_id, kept."""
    x = F.col("embedding").cast("array<float>")
    rows = vectors.select(F.col("vec_id").cast("long"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("x").isNotNull() & finite & F.exists("x", lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    classes = rows.where("usable").groupBy("x").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    found = None
    for dim in sorted(r[0] for r in classes.select(F.size("x")).distinct().collect()):
        own = links(classes.where(F.size("x") == dim), dim, threshold, block)
        found = own if found is None else found.union(own)
    if found is None:
        found = classes.select(F.col("class").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(0).cast("long").alias("links")).limit(0)
    found = stored(found, "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    named = classes.join(roots, F.col("class") == F.col("node"), "left").join(counts, F.col("class") == F.col("a"), "left")
    named = named.withColumn("root", F.coalesce("root", "class")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(smallest, "root").select("x", "links", "component")
    out = rows.where("usable").join(named, "x").select("vec_id", "links", "component")
    out = out.union(rows.where("not usable").select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.select(
        "vec_id",
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"),
    )
