"""Order-independent fingerprints of a Silver dataset.

Each row becomes canonical JSON and a SHA-256. The dataset is the multiset of these hashes, so row
order does not count and every duplicate does.

Two digests of that multiset exist. They differ in value, so keep the mode next to a stored digest.

``tree``    Hash pairs are digested per hash prefix, then prefix digests are digested again up to
            one root. Every step is a grouped aggregate of bounded groups; use it for real data.
``stream``  One SHA-256 over all pairs in hash order. SHA-256 cannot be split, so the pairs pass
            one process in order, whatever their number.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.contracts import SILVER_12
from tradeweir.errors import CopyMismatchError, PipelineError
from tradeweir.functions.text import canonical_silver_json, length_prefixed

# Hex digits of the leaf prefix: 16**6 leaves, so a trillion distinct rows put about 60,000 pairs
# (5 MB) in a leaf. SHA-256 spreads them evenly and equal rows are one pair, so no leaf is hot.
LEAF_DIGITS = 6
FAN_DIGITS = 3
# Copies of a surplus row that are listed from one array.
REPEATS = 1 << 12


def canonical_rows(silver: DataFrame) -> DataFrame:
    """The canonical JSON text of every row, as ``canonical_row``."""
    SILVER_12.require_names(silver, "fingerprinted frame")
    return silver.select(canonical_silver_json().alias("canonical_row"))


def row_hash_counts(silver: DataFrame) -> DataFrame:
    """Distinct row hashes with their number of occurrences (A5)."""
    return _binary_counts(silver).select(F.lower(F.hex("hash")).alias("row_hash"), "multiplicity")


def _binary_counts(silver: DataFrame) -> DataFrame:
    """Hashes are shuffled as 32 bytes, half the size of their hex text, and equal rows are counted before."""
    binary = canonical_rows(silver).select(_row_hash())
    return binary.groupBy("hash").agg(F.count("*").alias("multiplicity"))


def _row_hash() -> Column:
    return F.unhex(F.sha2("canonical_row", 256)).alias("hash")


def tree_fingerprint(
    silver: DataFrame, *, leaf_digits: int = LEAF_DIGITS, fan_digits: int = FAN_DIGITS
) -> DataFrame:
    """One row, one column ``fingerprint``: the ``tree`` digest.

    ``leaf_digits`` and ``fan_digits`` shape the tree and so are part of the digest's identity.
    """
    return _tree(_binary_counts(silver), {"fingerprint": "multiplicity"}, leaf_digits, fan_digits)


def stream_fingerprint(silver: DataFrame, *, max_pairs: int | None = None) -> str:
    """The ``stream`` digest, computed partition by partition on the driver.

    There is no limit unless the caller sets ``max_pairs``.
    """
    ordered = row_hash_counts(silver).orderBy("row_hash")
    digest = hashlib.sha256()
    pairs = ordered.select(length_prefixed(F.col("row_hash"), F.col("multiplicity")).alias("part"))
    for seen, row in enumerate(pairs.toLocalIterator(prefetchPartitions=True)):
        if max_pairs is not None and seen >= max_pairs:
            raise PipelineError(
                f"more than {max_pairs} distinct rows: use tree_fingerprint, which is distributed"
            )
        digest.update(row.part.encode("ascii"))
    return digest.hexdigest()


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row hashes whose number of occurrences differs between two Silver frames."""
    counts = _two_sided_counts(left, right).where("left_count <> right_count")
    return counts.select(F.lower(F.hex("hash")).alias("row_hash"), "left_count", "right_count")


def except_all_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Surplus rows of either side, duplicates included: an independent check of A6.

    Each side is scanned once: its rows count +1 or -1 in one grouping of whole rows, summed before the only
    exchange, and what is left of a row's sum is how often it is repeated, in blocks of bounded size.
    """
    columns = left.columns
    if right.columns != columns:
        raise PipelineError(f"rows of {columns} cannot be compared with rows of {right.columns}")
    both = left.withColumn("_sign", F.lit(1)).union(right.withColumn("_sign", F.lit(-1)))
    surplus = both.groupBy(*columns).agg(F.sum("_sign").alias("_surplus")).where("_surplus <> 0")
    blocks = surplus.withColumn("_block", F.explode(F.expr(f"sequence(0L, (abs(_surplus) - 1) div {REPEATS})")))
    here = F.expr(f"least({REPEATS}L, abs(_surplus) - _block * {REPEATS})")
    repeated = blocks.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), here)))
    return repeated.select(*columns, F.when(F.col("_surplus") > 0, "left").otherwise("right").alias("side"))


@dataclass(frozen=True)
class RowComparison:
    """Digest and rows of two datasets, and the columns in which either holds a null."""

    left: str
    right: str
    left_rows: int
    right_rows: int
    null_columns: tuple[str, ...]


def compare_rows(left: DataFrame, right: DataFrame) -> RowComparison:
    """One pass over both datasets."""
    found = _compared(left, right).first()
    nulls = tuple(c for i, c in enumerate(SILVER_12.columns) if (found.null_mask or 0) >> i & 1)
    return RowComparison(found.left, found.right, found.left_rows or 0, found.right_rows or 0, nulls)


def _compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both trees and row counts, with one exchange of rows: a row's hash goes to the task of its branch of the tree.

    That task counts the rows of the branch and digests its leaves and itself. There are 4096 branches, and SHA-256
    spreads rows over them evenly. Copies of one row meet in one task, which counts them without keeping them.
    """
    rows = _two_sided_hashes(left, right)
    branch = F.left(F.hex(F.substring("hash", 1, LEAF_DIGITS // 2)), F.lit(LEAF_DIGITS - FAN_DIGITS))
    # Dealt out by the expression: its text is not shuffled but read off the hash again behind the exchange.
    counts = _count_sides(rows.repartition(branch).select("*", branch.alias("branch")), "branch")
    leaves = {"left": "left_count", "right": "right_count"}
    return _tree(counts, leaves, LEAF_DIGITS, FAN_DIGITS, totals=True, within=("branch",))


def require_same_rows(left: DataFrame, right: DataFrame) -> str:
    """The common ``tree`` fingerprint of two datasets, or an error if they differ."""
    found = compare_rows(left, right)
    if found.left != found.right:
        raise CopyMismatchError(f"row fingerprints differ: {found.left} and {found.right}")
    return found.left


def _two_sided_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each binary row hash with its number of occurrences on either side, and which of its columns are null."""
    return _count_sides(_two_sided_hashes(left, right))


def _two_sided_hashes(left: DataFrame, right: DataFrame) -> DataFrame:
    """The binary hash of every row of both frames, its side, and which of its columns are null."""
    sides = []
    for frame, tag in ((left, True), (right, False)):
        SILVER_12.require_names(frame, "fingerprinted frame")
        mask = [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(SILVER_12.columns)]
        row = frame.select(canonical_silver_json().alias("canonical_row"), sum(mask, F.lit(0)).alias("null_mask"))
        sides.append(row.select(_row_hash(), "null_mask", F.lit(tag).alias("from_left")))
    return sides[0].union(sides[1])


def _count_sides(hashes: DataFrame, *within: str) -> DataFrame:
    return hashes.groupBy(*within, "hash").agg(
        F.count_if("from_left").alias("left_count"),
        F.count_if(~F.col("from_left")).alias("right_count"),
        F.max("null_mask").alias("null_mask"),
    )


def _tree(
    counts: DataFrame,
    sides: dict[str, str],
    leaf_digits: int,
    fan_digits: int,
    *,
    totals: bool = False,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """One row with a digest per side; ``sides`` maps its name to its column of occurrences.

    A prefix without rows of a side has no part in that side's tree. Leaves collect 32 bytes and a number for each
    distinct row; their text, twice as long, is only written where it is digested. With ``totals`` the rows of each
    side are summed, and the columns with nulls united, on the way up. ``within`` names columns by which the rows
    are already dealt out and which a prefix of any level determines, so that no level but the root is shuffled.
    """
    sums = [f"{side}_rows" for side in sides] if totals else []
    if leaf_digits < 1 or fan_digits < 1:
        raise PipelineError("leaf_digits and fan_digits must be at least 1")
    leaves = counts.select(
        *within,
        F.lower(F.left(F.hex("hash"), F.lit(leaf_digits))).alias("prefix"),
        F.struct("hash", *[F.col(n).alias(side) for side, n in sides.items()]).alias("pair"),
        *[F.col(sides[s.removesuffix("_rows")]).alias(s) for s in sums],
        *(["null_mask"] if totals else []),
    )
    added = [F.sum(s).alias(s) for s in sums] + ([F.bit_or("null_mask").alias("null_mask")] if totals else [])
    collected = leaves.groupBy(*within, "prefix").agg(F.sort_array(F.collect_list("pair")).alias("pairs"), *added)
    digests = _leaf_digests(collected, list(sides))
    digits = leaf_digits
    while True:
        digits = max(0, digits - fan_digits)
        level = digests.select(
            *within,
            F.left("prefix", F.lit(digits)).alias("prefix"),
            *[F.concat("prefix", side).alias(side) for side in sides],
            *sums,
            *(["null_mask"] if totals else []),
        )
        if digits == 0:
            break
        digests = level.groupBy(*within, "prefix").agg(*[_ordered_digest(side).alias(side) for side in sides], *added)
    nothing = F.sha2(F.lit(""), 256)
    return level.agg(*[F.coalesce(_ordered_digest(side), nothing).alias(side) for side in sides], *added)


def _leaf_digests(leaves: DataFrame, sides: list[str]) -> DataFrame:
    """SHA-256 of each leaf's pairs in hash order for every side, null without any. Equal sides are digested once."""

    def digest(side: str) -> Column:
        pairs = F.filter("pairs", lambda p: p[side] > 0)
        parts = F.transform(pairs, lambda p: length_prefixed(F.lower(F.hex(p["hash"])), p[side]))
        return F.when(F.size(pairs) > 0, F.sha2(F.array_join(parts, ""), 256))

    def same(side: str, other: str) -> Column:
        return F.forall("pairs", lambda p: p[side] == p[other])

    first, *others = sides
    digests = leaves.withColumn(first, digest(first))
    for side in others:
        digests = digests.withColumn(side, F.when(same(first, side), F.col(first)).otherwise(digest(side)))
    return digests.drop("pairs")


def _ordered_digest(part: str) -> Column:
    """SHA-256 of a group's parts in order, null without any. Parts begin with their prefix."""
    parts = F.sort_array(F.collect_list(part))
    return F.when(F.size(parts) > 0, F.sha2(F.array_join(parts, ""), 256))
