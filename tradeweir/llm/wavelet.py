"""Token files as wavelet matrices: one compressed file a shard, with access, counting and lookup (operator 11).

Texts are dealt by ranges of ``doc_id``, sorted, encoded, closed by an end id and written in that order, a file
for about ``SHARD`` ids. A shard's ids are numbered by falling frequency; the numbers' bits, highest first, are the levels
of a wavelet matrix: a level holds a bit of every number, and the next level has those with a 0 before those with a 1, each
in the order they had. Planes are cut into blocks of ``BLOCK`` bits, compressed one by one, with a directory of the ones
before each block, so that reading an id, counting an id and finding an id's k-th place read a few blocks of each level.

A task writes its files under names of its own attempt and reports them; only reported files count, so a lost or repeated
attempt leaves nothing but files that nobody reads. Files go to the folder the caller names or the shared scratch folder, through
Arrow's file systems (local paths, ``file``, ``hdfs``, ``s3``).

Defined results: a null or empty text is the end id alone; null ids come first; rows with equal ids lie next to
each other by the hash of their texts, then by place in the table; a document longer than a shard goes on in the files that
follow, and its reader follows it; a long text is encoded in parts that end where the tokenizer ends a word; an empty table
makes no file; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweir.llm.common import id_and_text, passes, stored
from tradeweir.llm.tokens import PART, Vocabulary, bytes_of, text_parts
from tradeweir.session import scratch_folder

MAGIC = b"WAVMAT01"
SHARD = 1 << 20
BLOCK = 1 << 15
_MANIFEST = "part int, seq int, path string, n_tokens long, n_docs long, carried long"


class _Library:
    """Ids of single words by the tokenizers library: its model, on the characters that stand for the word's bytes.

    Cutting a word that is cut already, and offsets that nobody reads, would double the time.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model
        self.characters = {byte: character for character, byte in bytes_of().items()}

    def encode_ordinary(self, word: str) -> list[int]:
        return [token.id for token in self.model.tokenize(word.encode().decode("latin-1").translate(self.characters))]


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    vocabulary = Vocabulary(path)
    vocabulary.encoding = _Library(path)
    return vocabulary


# ---- the file


def build(ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray, carried: int, block: int = BLOCK) -> bytes:
    """A shard's file: ids, the documents that begin in it, and how many ids at its head belong to an earlier one."""
    counts = np.bincount(ids)
    symbols = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    number = np.zeros(len(counts), np.uint32)
    number[symbols] = np.arange(len(symbols))
    levels = max(1, int(len(symbols) - 1).bit_length())
    codes = number[ids].astype(np.uint16 if levels <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=1).compress
    body, sizes, before, zeros = [], [], [], []
    for level in range(levels):
        bits = (codes >> (levels - 1 - level) & 1).astype(bool)
        ones = 0
        for at in range(0, len(bits), block):
            own = bits[at : at + block]
            raw = np.packbits(own, bitorder="little").tobytes()
            small = pack(raw)
            body.append(small if len(small) < len(raw) else raw)
            sizes.append(len(body[-1]))
            before.append(ones)
            ones += int(np.count_nonzero(own))
        zeros.append(len(bits) - ones)
        codes = np.concatenate((codes[~bits], codes[bits]))
    known = [0 if d is None else d for d in doc_ids]
    nulls = [d is None for d in doc_ids]
    head = [len(ids), levels, len(symbols), len(doc_ids), carried, block]
    directory = pack(np.concatenate([np.asarray(x, "<i8") for x in (head, symbols, known, nulls, starts, zeros, before, sizes)]).tobytes())
    return b"".join((MAGIC, len(directory).to_bytes(8, "little"), directory, *body))


class Shard:
    """A shard's file, of which only the directory and the blocks asked for are read."""

    def __init__(self, file) -> None:
        self.file = file
        file.seek(0)
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        size = int.from_bytes(file.read(8), "little")
        values = np.frombuffer(zstandard.ZstdDecompressor().decompress(file.read(size)), "<i8")
        self.n, self.levels, n_symbols, self.n_docs, self.carried, self.block = values[:6].tolist()
        blocks = -(-self.n // self.block)
        cuts = np.cumsum([6, n_symbols, self.n_docs, self.n_docs, self.n_docs, self.levels, self.levels * blocks])
        _, self.symbols, known, nulls, self.starts, self.zeros, before, sizes = np.split(values, cuts)
        self.doc_ids = [None if null else d for d, null in zip(known.tolist(), nulls.tolist(), strict=True)]
        self.before = before.reshape(self.levels, blocks)
        self.sizes = sizes.reshape(self.levels, blocks)
        self.places = (16 + size + np.cumsum(sizes) - sizes).reshape(self.levels, blocks)
        self.number = {s: i for i, s in enumerate(self.symbols.tolist())}
        self._blocks: dict[tuple[int, int], np.ndarray] = {}

    def bits(self, level: int, k: int) -> np.ndarray:
        """Block ``k`` of a plane, kept while the shard is open."""
        if (level, k) not in self._blocks:
            self.file.seek(int(self.places[level, k]))
            raw = self.file.read(int(self.sizes[level, k]))
            count = min(self.block, self.n - k * self.block)
            if len(raw) < (count + 7) // 8:
                raw = zstandard.ZstdDecompressor().decompress(raw)
            self._blocks[level, k] = np.unpackbits(np.frombuffer(raw, np.uint8), count=count, bitorder="little").view(bool)
        return self._blocks[level, k]

    def _plane(self, level: int) -> np.ndarray:
        """A whole plane, for which the file is read once and nothing is kept."""
        self.file.seek(int(self.places[level, 0]))
        raw = memoryview(self.file.read(int(self.sizes[level].sum())))
        out, at, unpack = np.empty(self.n, bool), 0, zstandard.ZstdDecompressor().decompress
        for k, size in enumerate(self.sizes[level].tolist()):
            own, at = raw[at : at + size], at + size
            count = min(self.block, self.n - k * self.block)
            data = unpack(own) if size < (count + 7) // 8 else own
            out[k * self.block : k * self.block + count] = np.unpackbits(np.frombuffer(data, np.uint8), count=count, bitorder="little")
        return out

    def _bit_and_ones(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits at places (false behind the end) and the ones before them."""
        bit, ones = np.zeros(len(at), bool), np.zeros(len(at), np.int64)
        behind = at >= self.n
        ones[behind] = self.n - self.zeros[level]
        block = np.where(behind, -1, at // self.block)
        for k in np.unique(block[~behind]).tolist():
            own = np.flatnonzero(block == k)
            plane = self.bits(level, k)
            inside = at[own] - k * self.block
            total = np.concatenate(([0], np.cumsum(plane, dtype=np.int64)))
            bit[own], ones[own] = plane[inside], self.before[level, k] + total[inside]
        return bit, ones

    def access(self, places) -> np.ndarray:
        """Ids at places."""
        at = np.asarray(places, np.int64)
        if len(at) and not (0 <= at.min() and at.max() < self.n):
            raise IndexError("no such place in this shard")
        code = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            bit, ones = self._bit_and_ones(level, at)
            code = code * 2 + bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return self.symbols[code]

    def tokens(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """Ids of a stretch; a large one is undone level by level from the last plane up."""
        end = self.n if end is None else end
        if (end - first) * 16 < self.n:
            return self.access(np.arange(first, end))
        codes = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            bits, up = self._plane(level), np.empty_like(codes)
            up[~bits] = codes[: self.zeros[level]]
            up[bits] = codes[self.zeros[level] :] | (1 << (self.levels - 1 - level))
            codes = up
        return self.symbols[codes[first:end]]

    def _range(self, token: int, first: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` between two places stand below the last level."""
        code = self.number.get(token)
        if code is None:
            return 0, 0
        at = np.array([first, end], np.int64)
        for level in range(self.levels):
            _, ones = self._bit_and_ones(level, at)
            at = self.zeros[level] + ones if code >> (self.levels - 1 - level) & 1 else at - ones
        return int(at[0]), int(at[1])

    def count(self, token: int, first: int = 0, end: int | None = None) -> int:
        """Occurrences of an id between two places (rank)."""
        low, high = self._range(token, first, self.n if end is None else end)
        return high - low

    def find(self, token: int, first: int = 0, limit: int | None = None) -> np.ndarray:
        """Places of an id's occurrences, from number ``first`` on (select)."""
        low, high = self._range(token, 0, self.n)
        at = np.arange(low + first, high if limit is None else min(high, low + first + limit))
        code = self.number.get(token, 0)
        for level in reversed(range(self.levels)):
            one = bool(code >> (self.levels - 1 - level) & 1)
            at = self._select(level, one, at - self.zeros[level] if one else at)
        return at

    def _select(self, level: int, one: bool, nth: np.ndarray) -> np.ndarray:
        """Places of the zeros or ones with the given numbers on a level."""
        before = self.before[level]
        if not one:
            before = np.arange(len(before)) * self.block - before
        block = np.searchsorted(before, nth, side="right") - 1
        out = np.empty(len(nth), np.int64)
        for k in np.unique(block).tolist():
            own = np.flatnonzero(block == k)
            plane = self.bits(level, k)
            out[own] = k * self.block + np.flatnonzero(plane if one else ~plane)[nth[own] - before[k]]
        return out


def open_shard(path: str) -> Shard:
    system, place = fs.FileSystem.from_uri(path)
    return Shard(system.open_input_file(place))


# ---- the operator


class _Writer:
    """Collects a task's ids and writes a file when a shard is full; gives out the row that reports it."""

    def __init__(self, folder: str, part: int, shard: int) -> None:
        self.folder, self.part, self.shard = folder, part, shard
        self.name, self.seq = f"{part:06d}-{uuid.uuid4().hex}", 0
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self._fresh(0)

    def _fresh(self, carried: int) -> None:
        self.ids, self.size, self.doc_ids, self.starts, self.carried = [], 0, [], [], carried

    def begin(self, doc_id: int | None) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.size)

    def add(self, ids: np.ndarray) -> Iterator[tuple]:
        """Ids of the document that has begun last."""
        while len(ids):
            if self.size >= self.shard:
                yield self.close()
            own, ids = ids[: self.shard - self.size], ids[self.shard - self.size :]
            self.ids.append(own)
            self.size += len(own)
            if not self.doc_ids:
                self.carried += len(own)

    def close(self) -> tuple:
        path = f"{self.name}-{self.seq:06d}.wavelet"
        data = build(np.concatenate(self.ids), self.doc_ids, np.array(self.starts, np.int64), self.carried)
        with self.system.open_output_stream(f"{self.root}/{path}") as out:
            out.write(data)
        row = (self.part, self.seq, f"{self.folder}/{path}", self.size, len(self.doc_ids), self.carried)
        self.seq += 1
        self._fresh(0)
        return row


def write_shards(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2, shard: int = SHARD, part: int = PART) -> DataFrame:
    """Write the files; one row per file: its task, number, path, ids, documents that begin in it and ids at its head of an earlier one."""
    spark = docs.sparkSession
    folder = (folder or scratch_folder(spark, "wavelet")).rstrip("/")
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokenizer)
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        writer = _Writer(folder, TaskContext.get().partitionId(), shard)
        for batch in passes(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            ids, of = vocabulary.ids(["" if len(text) > part else text for text in texts])
            rows = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                n = int(of[i + 1] - of[i]) + 1
                if writer.size and writer.size + n > shard:
                    rows.append(writer.close())
                writer.begin(doc_id)
                if len(texts[i]) > part:
                    for own in text_parts(texts[i], part):
                        rows += writer.add(vocabulary.ids([own])[0])
                else:
                    rows += writer.add(ids[of[i] : of[i + 1]])
                rows += writer.add(end)
            if rows:
                yield _reports(rows)
        if writer.size:
            yield _reports([writer.close()])

    keys = ("doc_id", "hash", "place")
    rows = id_and_text(docs).withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return stored(dealt.mapInArrow(run, _MANIFEST), "shards")


def _reports(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    names = ("part", "seq", "path", "n_tokens", "n_docs", "carried")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _placed(manifest: DataFrame) -> DataFrame:
    """The files with the number of ids before each, dealt out a few to a task.

    What passes the driver is a sum for each task that wrote files.
    """
    sums = sorted(manifest.groupBy("part").agg(F.sum("n_tokens"), F.count("*")).collect())
    base, total = [], 0
    for part, n, _ in sums:
        base.append((part, total))
        total += n
    parts = manifest.sparkSession.createDataFrame(base, "part int, base long")
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("own", F.coalesce(own, F.lit(0))).join(parts, "part")
    files = files.select("path", (F.col("base") + F.col("own")).alias("first"))
    return files.repartition(max(1, sum(s[2] for s in sums) // 3), "path")


def _after(path: str) -> str:
    """The file that goes on where this one ends."""
    stem, number = re.fullmatch(r"(.*-)(\d+)\.wavelet", path).groups()
    return f"{stem}{int(number) + 1:06d}.wavelet"


def _rest(path: str, system: fs.FileSystem) -> Iterator[np.ndarray]:
    """Ids of a file's last document in the files that follow."""
    while True:
        path = _after(path)
        place = fs.FileSystem.from_uri(path)[1]
        if system.get_file_info(place).type == fs.FileType.NotFound:
            return
        with system.open_input_file(place) as file:
            shard = Shard(file)
            if shard.carried:
                yield shard.tokens(0, shard.carried)
            if shard.carried < shard.n:
                return


def read_documents(manifest: DataFrame) -> DataFrame:
    """From the files: every document with the ids of all documents before it, its own number of ids, and their CRC."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    shard = Shard(file)
                    if not shard.n_docs:
                        continue
                    data = shard.tokens().astype("<u4")
                bounds = [*shard.starts.tolist(), len(data)]
                sums = [zlib.crc32(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
                sizes = np.diff(bounds)
                for more in _rest(path, system):
                    sums[-1] = zlib.crc32(more.astype("<u4"), sums[-1])
                    sizes[-1] += len(more)
                columns = [pa.array(shard.doc_ids, pa.int64()), pa.array(shard.starts + first), pa.array(sizes), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _placed(manifest).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_tokens(manifest: DataFrame, tokens: list[int]) -> DataFrame:
    """How often each id occurs in all files, by rank on the planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                shard = open_shard(path)
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([shard.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return _placed(manifest).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def find_token(manifest: DataFrame, token: int) -> DataFrame:
    """Every place of an id, counted over all files as ``start`` is, by select on the planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(open_shard(path).find(token) + first, pa.int64())], ["place"])

    return _placed(manifest).mapInArrow(run, "place long")


def encode_documents(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2, shard: int = SHARD) -> DataFrame:
    """Write all texts, then report every document as the files give it back."""
    return read_documents(write_shards(docs, tokenizer, folder, end_id, shard))
