"""Merkle fixity audit of WARC replicas (operator 2).

Records lie in files at offsets. Each record is hashed; the digests of a fixed range of offsets, in order,
make a leaf, ranges of ``fan`` children make the nodes above, and a file's root stands over its last level.
Two replicas are compared at the roots, then only below nodes that differ, down to the records. Payloads are
read once to hash them and never shuffled; a node has at most ``fan`` children.

Defined results: a null payload is an empty one; equal rows at one place are counted; a record at the same place
with another digest is ``changed``, one that only the first replica has is ``missing``, one that only the second
has is ``extra``; two empty replicas have no findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweir.llm.common import stored

RANGE_BYTES = 1 << 16
FAN = 16
FILE_PAGES = 1024


def warc_records(pages: DataFrame, file_pages: int = FILE_PAGES) -> DataFrame:
    """Pages as response records: ``file``, ``offset``, ``page_id`` and the digest of the whole record."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(F.col("url").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    record = F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "UTF-8")
    number = F.coalesce(F.col("page_id").cast("long"), F.lit(-1))
    small = pages.select(
        F.floor(number / file_pages).alias("file"),
        F.col("page_id").cast("long"),
        F.octet_length(record).cast("long").alias("size"),
        F.sha2(record, 256).alias("digest"),
    )
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return small.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))


def _node(key: list[str], place: str, digest: str) -> Column:
    parts = F.sort_array(F.collect_list(F.struct(F.col(place), F.col(digest))))
    return F.sha2(F.concat_ws(",", F.transform(parts, lambda p: F.concat_ws(":", p[place].cast("string"), p[digest]))), 256)


def levels(records: DataFrame, range_bytes: int, fan: int) -> list[DataFrame]:
    """Level 0 has the leaves (``file``, ``node``, ``hash``), each next one a ``fan``-th of them."""
    leaves = records.withColumn("node", F.floor(F.col("offset") / range_bytes))
    out = [stored(leaves.groupBy("file", "node").agg(_node(["file"], "offset", "digest").alias("hash")), "leaves")]
    last = out[0].agg(F.max("node")).first()[0] or 0
    while last > 0:
        last //= fan
        up = out[-1].withColumn("up", F.floor(F.col("node") / fan)).groupBy("file", "up")
        up = up.agg(_node(["file"], "node", "hash").alias("hash")).withColumnRenamed("up", "node")
        out.append(stored(up, "nodes"))
    return out


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.withColumnRenamed("hash", "x").join(b.withColumnRenamed("hash", "y"), ["file", "node"], "full")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select("file", "node")


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """Records in which two replicas (``file``, ``offset``, ``page_id``, ``digest``) differ."""
    first, second = stored(first, "records"), stored(second, "records")
    trees = [levels(first, range_bytes, fan), levels(second, range_bytes, fan)]
    depth = max(map(len, trees))
    for tree in trees:
        while len(tree) < depth:  # the shallower replica's roots are carried up
            up = tree[-1].withColumn("node", F.floor(F.col("node") / fan)).groupBy("file", "node")
            tree.append(up.agg(F.min("hash").alias("hash")))
    wrong = _differing(trees[0][-1], trees[1][-1])
    for level in range(depth - 2, -1, -1):
        below = [t[level].withColumn("up", F.floor(F.col("node") / fan)) for t in trees]
        parents = wrong.select("file", F.col("node").alias("up"))
        a, b = (x.join(parents, ["file", "up"], "left_semi").select("file", "node", "hash") for x in below)
        wrong = stored(_differing(a, b), "wrong")
    sides = []
    for name, records in (("a", first), ("b", second)):
        own = records.withColumn("node", F.floor(F.col("offset") / range_bytes)).join(wrong, ["file", "node"], "left_semi")
        own = own.groupBy("file", "offset", "digest").agg(F.count("*").alias(f"n_{name}"), F.min("page_id").alias(f"page_{name}"))
        sides.append(own)
    both = sides[0].join(sides[1], ["file", "offset", "digest"], "full").where(~F.col("n_a").eqNullSafe(F.col("n_b")))
    place = both.groupBy("file", "offset").agg(
        F.coalesce(F.min("page_a"), F.min("page_b")).alias("page_id"), F.count("n_a").alias("in_a"), F.count("n_b").alias("in_b")
    )
    kind = F.when(F.col("in_b") == 0, "missing").when(F.col("in_a") == 0, "extra").otherwise("changed")
    return place.select("page_id", "file", "offset", kind.alias("kind"))
