"""Near-duplicate documents by Order MinHash (operator 3).

A document is the sequence of its shingles of five words, each labelled with its occurrence number. For each of
``sketches`` hash functions the ``ell`` smallest labelled shingles are taken and hashed in the order in which they
stand in the text, so that a sketch agrees with a probability of about similarity ** ell and depends
on order. Documents that agree in a sketch are candidates; an alignment of the shingle sequences within a band decides.

Similarity is L / (n1 + n2 - L), where L is the longest common subsequence of the two sequences of n1 and n2 shingles:
the Jaccard similarity of shingles that keep their order. The band is exact: outside of it the threshold can't be reached.

Texts with the same words are one class, and only one of each is sketched and aligned. In small groups of candidates all
pairs are aligned. Larger ones are dealt into blocks, each with the group's smallest class as well, and a block aligns
those of its pairs that no links join yet. Groups that then still hold several components (texts that share a common
passage, say) are regrouped by single labelled shingles: of a text of n shingles, those n - ceil(threshold n) + 1 that
are rarest by a histogram of fixed size. Similar texts share one of them, so nothing is lost, and a common
passage groups nothing any more. The new groups are treated as before, and what one of them still holds outside of its
largest component is aligned, block by block, with all its members of other components. So every pair
of candidates is either aligned or joined by links: no component is missed.
With the default parameters a pair at the threshold shares no sketch with a probability of 6e-7.

Defined results: texts without words are never near anything; texts of fewer than five words are one shingle; a null
text has no words; rows with equal ids and texts are one another's copies, and one is kept; a null id sorts first;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.llm.common import components, id_and_text, passes, stored
from tradeweir.llm.words import Words, grams, mix, words_of

SHINGLE = 5
THRESHOLD = 0.8
SKETCHES = 20
ELL = 3
SMALL_GROUP = 16
STAR_BLOCK = 32
BLOCK = 128
HISTOGRAM_BITS = 20  # 8 MB, whatever the number of texts
_SEEDS = mix(np.arange(1, 1025, dtype=np.uint64))


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and where each document's begin; a document of fewer words is one shingle."""
    count = np.diff(words.first)
    number = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    first = np.concatenate(([0], np.cumsum(number)))
    start = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], number)
    out = np.zeros(first[-1], np.uint64)
    full = np.repeat(count >= size, number)
    out[full] = grams(words.hashes, size)[start[full]] if full.any() else 0
    for i in np.flatnonzero((count > 0) & (count < size)):
        h = words.hashes[words.first[i] : words.first[i + 1]]
        out[first[i]] = mix(grams(h, len(h)) + np.uint64(len(h)))[0]
    return out, first


def labelled(own: np.ndarray) -> np.ndarray:
    """Hashes of one document's shingles with their occurrence numbers."""
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    begins = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    occurrence = np.empty(len(own), np.uint64)
    occurrence[order] = np.arange(len(own)) - np.repeat(begins, np.diff(begins, append=len(own)))
    return mix(own + mix(occurrence))


def sketch(own: np.ndarray, sketches: int, ell: int) -> np.ndarray:
    """Order MinHash of one document's shingles."""
    marks = labelled(own)
    value = mix(marks[None, :] ^ _SEEDS[:sketches, None])
    ell = min(ell, len(own))
    least = np.sort(np.argpartition(value, ell - 1, axis=1)[:, :ell], axis=1)
    out = np.arange(sketches, dtype=np.uint64)
    for i in range(ell):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + marks[least[:, i]])
    return out


def two_hashes(words: Words) -> np.ndarray:
    """128 bits of every document's word sequence, as two columns."""
    out = []
    for seed in (3, 5):
        place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], np.diff(words.first))
        value = mix(words.hashes ^ mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed)))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
        out.append(mix(total[words.first[1:]] - total[words.first[:-1]] + np.diff(words.first).astype(np.uint64)))
    return np.column_stack(out)


def common_length(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> int:
    """Longest common subsequence within the band, one bit for each shingle of ``a``; 0 if too short to matter."""
    n, m = len(a), len(b)
    least = threshold / (1 + threshold) * (n + m)
    if min(n, m) < least - 1e-9:
        return 0
    band = int(n + m - 2 * least + 1e-9)
    short = min(n, m)
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    rest = short - head
    same = a[n - rest :][::-1] == b[m - rest :][::-1]
    tail = rest if same.all() else int(np.argmin(same))
    a, b = a[head : n - tail].tolist(), b[head : m - tail].tolist()
    if not a or not b:
        return head + tail
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    if head + tail + sum(map(where.__contains__, b)) < least - 1e-9:
        return 0
    full = (1 << len(a)) - 1
    open_ = (1 << (2 * band + 1)) - 1
    row = full
    for j, x in enumerate(b):
        hit = where.get(x)
        if hit:
            hit &= open_ << (j - band) if j >= band else open_ >> (band - j)
            u = row & hit
            row = ((row + u) | (row - u)) & full
    return head + tail + len(a) - row.bit_count()


def near(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    n = common_length(a, b, threshold)
    return n > 0 and n >= threshold * (len(a) + len(b) - n) - 1e-9


def overlaps(lists: list[np.ndarray], piece: int = 1 << 14) -> np.ndarray:
    """Labelled shingles that each two documents share, in whatever order: no alignment can be longer."""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    marks = [labelled(x.astype(np.uint64)) for x in lists]
    names, at = np.unique(np.concatenate(marks) if marks else np.zeros(0, np.uint64), return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    shared = np.zeros((len(lists), len(lists)), np.float32)
    for start in range(0, len(names), piece):
        low, high = np.searchsorted(at, (start, start + piece))
        has = np.zeros((len(lists), min(piece, len(names) - start)), np.float32)
        has[owner[low:high], at[low:high] - start] = 1
        shared += has @ has.T
    return shared


def _sketched(docs: DataFrame, sketches: int, ell: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            words = words_of(batch.column(1))
            own, first = shingles(words)
            pairs = two_hashes(words).view(np.int64)
            each = [
                sketch(own[a:b], sketches, ell).view(np.int64) if b > a else np.zeros(0, np.int64)
                for a, b in zip(first[:-1], first[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.ascontiguousarray(pairs[:, 0])),
                    pa.array(np.ascontiguousarray(pairs[:, 1])),
                    pa.array(np.diff(first)),
                    pa.array(each, pa.list_(pa.int64())),
                ],
                ["doc_id", "h1", "h2", "size", "sketches"],
            )

    return docs.mapInArrow(run, "doc_id long, h1 long, h2 long, size long, sketches array<long>")


def _shingled(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            words = words_of(batch.column(1))
            own, first = shingles(words)
            pairs = two_hashes(words).view(np.int64)
            short = (own >> np.uint64(33)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(short))
            columns = [pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, lists], ["h1", "h2", "shingles"])

    return docs.mapInArrow(run, "h1 long, h2 long, shingles array<int>")


def _aligned(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            yes = [near(x[i].values.to_numpy(), y[i].values.to_numpy(), threshold) for i in range(len(batch))]
            yield batch.select([0, 1]).filter(pa.array(yes, pa.bool_()))

    left = texts.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    right = texts.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    spark = pairs.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "500")
    try:
        return stored(both.mapInArrow(run, "a long, b long"), "near")
    finally:
        spark.conf.set(key, before)


def _blocks(many: DataFrame, block: int) -> DataFrame:
    """Members of large groups dealt into blocks by a hash; the group's smallest class is in all of its blocks."""
    number = F.ceil(F.col("n") / block)
    own = many.where("class <> least").withColumn("at", F.pmod(F.xxhash64("class"), number))
    centre = many.where("class = least").withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))
    both = own.unionByName(centre).withColumns({"with": F.lit(0).cast("long"), "asks": F.lit(True)})
    return both.select("band", "value", "at", "with", "class", "root", "asks")


def _apart(many: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots, of the large groups that hold several components."""
    held = many.select("band", "value", "least", "class").join(roots, F.col("class") == F.col("node"), "left")
    held = held.select("band", "value", "least", "class", F.coalesce("root", "class").alias("root"))
    parts = held.groupBy("band", "value", "root").agg(F.count("*").alias("n"))
    parts = parts.groupBy("band", "value").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top")
    )
    return held.join(parts.where("parts > 1").drop("parts"), ["band", "value"])


def _histogram(texts: DataFrame) -> np.ndarray:
    """How many labelled shingles of the texts have each of 2 ** HISTOGRAM_BITS leading bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << HISTOGRAM_BITS, np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.bincount(_cells(labelled(one.values.to_numpy().astype(np.uint64))), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    cells = texts.select("shingles").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << HISTOGRAM_BITS, np.int64)
    out[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return out


def _cells(marks: np.ndarray) -> np.ndarray:
    return (marks >> np.uint64(64 - HISTOGRAM_BITS)).astype(np.int64)


def _rarest(texts: DataFrame, threshold: float) -> DataFrame:
    """The labelled shingles of a text of which similar texts share one, as ``value``; any order would do, rare ones are best."""
    counts = texts.sparkSession.sparkContext.broadcast(_histogram(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare = []
            for one in batch.column(2):
                marks = labelled(one.values.to_numpy().astype(np.uint64))
                wanted = len(marks) - int(np.ceil(threshold * len(marks) - 1e-9)) + 1
                rare.append(marks[np.lexsort((marks, counts.value[_cells(marks)]))[:wanted]].view(np.int64))
            at = pa.array(np.repeat(np.arange(len(batch)), [len(x) for x in rare]))
            values = pa.array(np.concatenate(rare) if rare else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), values], ["class", "root", "value"])

    return texts.select("class", "root", "shingles").mapInArrow(run, "class long, root long, value long")


def _regrouped(rest: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Members of groups by a rare shingle, without groups of one component."""
    chosen = stored(texts.join(rest.select("class", "root").distinct(), "class"), "apart-shingles")
    rare = stored(_rarest(chosen, threshold), "rarest")
    groups = rare.groupBy("value").agg(
        F.count("*").alias("n"), F.min("class").alias("least"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    groups = groups.where("low < high").select("value", "n", "least")
    return stored(rare.join(groups, "value").withColumn("band", F.lit(0)), "members")


def _block_pairs(rest: DataFrame, block: int) -> DataFrame:
    """Every block of members outside of a group's largest component beside every block of the group."""
    asking = F.ceil((F.col("n") - F.col("top.n")) / block)
    asked = F.ceil(F.col("n") / block)
    each = lambda number: F.explode(F.sequence(F.lit(0).cast("long"), number - 1))
    left = rest.where(F.col("root") != F.col("top.root")).withColumn("at", F.pmod(F.xxhash64("class"), asking))
    left = left.withColumn("with", each(asked)).withColumn("asks", F.lit(True))
    right = rest.withColumn("with", F.pmod(F.xxhash64("class"), asked)).withColumn("at", each(asking))
    right = right.withColumn("asks", F.lit(False))
    return left.unionByName(right).select("band", "value", "at", "with", "class", "root", "asks")


def _linked(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links that join the components of a block; a pair with neither row asking is not looked at."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("class")
        classes, roots, asks = (block.column(c).to_pylist() for c in ("class", "root", "asks"))
        lists = [x.values.to_numpy() for x in block.column("shingles")]
        joined = {r: r for r in roots}

        def top(r: int) -> int:
            while joined[r] != r:
                joined[r] = r = joined[joined[r]]
            return r

        size = np.array([len(x) for x in lists])
        least = threshold / (1 + threshold) * (size[:, None] + size[None, :]) - 1e-9
        asking = np.array(asks, bool)
        possible = (overlaps(lists) >= least) & (asking[:, None] | asking[None, :])
        a, b = [], []
        for i, j in np.argwhere(np.tril(possible, -1)).tolist():
            x, y = top(roots[i]), top(roots[j])
            if x != y and near(lists[i], lists[j], threshold):
                joined[x] = y
                a.append(classes[i])
                b.append(classes[j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    whole = rows.join(texts, "class").groupBy("band", "value", "at", "with")
    return stored(whole.applyInArrow(run, "a long, b long"), "near")


def _divided(member: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of different components in small groups, and the members of the larger groups."""
    few = member.where(F.col("n") <= small).select("band", "value", "class", "root")
    other = few.select("band", "value", F.col("class").alias("b"), F.col("root").alias("root_b"))
    pairs = few.withColumnRenamed("class", "a").join(other, ["band", "value"]).where("a < b AND root <> root_b")
    return stored(pairs.select("a", "b").distinct(), "pairs"), member.where(F.col("n") > small)


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    sketches: int = SKETCHES,
    ell: int = ELL,
    small: int = SMALL_GROUP,
    star: int = STAR_BLOCK,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document row: ``class_id`` (smallest doc_id of its class), size of the class, and ``kept``."""
    docs = id_and_text(docs)
    rows = stored(_sketched(docs, sketches, ell).withColumn("row", F.monotonically_increasing_id()), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "row"))
    classes = rows.where("size > 0").groupBy("h1", "h2").agg(first.alias("first"), F.min("sketches").alias("sketches"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    member = classes.select("class", F.posexplode("sketches").alias("band", "value"))
    groups = member.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("class").alias("least")).where("n > 1")
    member = stored(member.join(groups, ["band", "value"]), "members")
    pairs, many = _divided(member.withColumn("root", F.col("class")), small)

    used = pairs.select("a").union(pairs.select("b")).union(many.select("class")).distinct().withColumnRenamed("a", "class")
    wanted = classes.join(used, "class", "left_semi").select(F.col("first.doc_id").alias("doc_id"), "class", "h1", "h2")
    own = docs.join(wanted.select(F.col("doc_id").alias("d")).distinct(), F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    texts = _shingled(own).join(wanted.drop("doc_id"), ["h1", "h2"]).dropDuplicates(["class"]).select("class", "shingles")
    texts = stored(texts, "shingles")

    found = _aligned(pairs, texts, threshold).union(_linked(_blocks(many, star), texts, threshold))
    roots = stored(components(found), "roots")
    rest = stored(_apart(many, roots), "apart")
    if not rest.isEmpty():
        pairs, many = _divided(_regrouped(rest, texts, threshold), small)
        found = _aligned(pairs, texts, threshold).union(_linked(_blocks(many, star), texts, threshold))
        roots = stored(components(roots.toDF("a", "b").union(found)), "roots")
        rest = stored(_apart(many, roots), "apart")
    if not rest.isEmpty():
        found = _linked(_block_pairs(rest, block), texts, threshold)
        roots = stored(components(roots.toDF("a", "b").union(found)), "roots")
    named = classes.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    named = named.join(best, "root").select("h1", "h2", "root", "best")
    out = rows.select("doc_id", "h1", "h2", "row", "size").join(named, ["h1", "h2"], "left")
    alone = F.col("root").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
        "h1",
        "h2",
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """Rows of ``docs``, all columns, without near duplicates of a kept row."""
    decided = near_duplicates(docs, **parameters).where("kept").select("doc_id", "h1", "h2")
    decided = stored(decided.groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n")), "kept")
    at = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, f"c{at}"):
            pairs = two_hashes(words_of(batch.column(at))).view(np.int64)
            both = [pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *both], [*names, "h1", "h2"])

    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))
    id_ = f"c{docs.columns.index('doc_id')}"
    marked = docs.toDF(*names).mapInArrow(run, f"{kinds}, h1 long, h2 long")
    joined = marked.join(
        decided.select(F.col("doc_id").alias("d"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n"),
        F.col(id_).cast("long").eqNullSafe(F.col("d")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")),
    )
    # A text without words is never a duplicate; of equal rows with words one is left.
    empty = two_hashes(words_of(pa.array([""]))).view(np.int64)[0]
    wordless = (F.col("h1") == int(empty[0])) & (F.col("h2") == int(empty[1]))
    one = joined.where(~wordless).dropDuplicates(["d", "k1", "k2"])
    return one.select(*names).union(joined.where(wordless).select(*names)).toDF(*docs.columns)
