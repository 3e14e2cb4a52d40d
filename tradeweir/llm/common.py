"""What several operators share: batches of bounded size, stored intermediate tables, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweir.session import scratch_folder

# Texts of one numpy pass; a longer single text is a pass of its own.
PASS_BYTES = 2 << 20
# Edges of which one task finds the components by itself.
PIECE_EDGES = 1 << 20


def passes(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each piece have about ``limit`` bytes at most."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
        sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that operators read, under their own names, whatever else there is."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and lost executors take nothing along."""
    spark = frame.sparkSession
    path = scratch_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def hash128(*columns: Column) -> list[Column]:
    """Two 64-bit halves of an MD5 over the columns, cheaper to group by than its text."""
    digest = F.md5(F.concat_ws("\x1f", *columns))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return [half(1).alias("h1"), half(17).alias("h2")]


def components(edges: DataFrame) -> DataFrame:
    """Connected components: pieces of the edges shrink to stars by themselves, then star steps join the pieces.

    ``edges`` has two long columns ``a`` and ``b``. Returns ``node`` and ``root`` (the smallest node
    of the component) for every node that has an edge to another. The steps between pieces are alternating
    large-star and small-star steps; stars are found with a grouped minimum that is joined
    back, so that no neighbourhood is ever gathered in one row.
    """
    now = stored(_shrunk(edges.where("a <> b").select("a", "b")), "edges")
    while not _only_stars(now):
        # a > b in every edge. Large star: neighbours above a node go to its smallest neighbour.
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b")
        # Small star: a node and its neighbours below go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low)
        now = stored(_shrunk(stored(_shrunk(small.where("a <> b")), "edges")), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Has every node one neighbour below it at most, and that one none?"""
    below = edges.select("a", "b", F.lit(False).alias("top"))
    ends = below.union(edges.select("b", F.lit(None).cast("long"), F.lit(True)))
    seen = ends.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.max("top").alias("top"))
    return seen.where("low <> high OR (top AND low IS NOT NULL)").isEmpty()


def _shrunk(edges: DataFrame, piece: int = PIECE_EDGES) -> DataFrame:
    """Edges (a, b), a > b, from each node to the smallest it is connected with by its piece of the edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= piece:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ends = [table.column(i).to_numpy() for i in (0, 1)]
        nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
        a, b = at[: len(ends[0])], at[len(ends[0]) :]
        root = np.arange(len(nodes))
        while (apart := root[a] != root[b]).any():
            x, y = root[a[apart]], root[b[apart]]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
        moved = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as a cluster without an installed copy needs; once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(), "tradeweir.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(application)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
