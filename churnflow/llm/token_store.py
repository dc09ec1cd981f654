"""Token ids in files: canonical length-limited Huffman codes from global counts.

A file is a magic number, the compressed code lengths, then blocks, then a footer with the documents and
the place of every block. A block has whole documents with about ``BLOCK_IDS`` ids. Blocks and documents start at
a byte, so blocks decode alone; a checkpoint every ``STRIDE`` ids of a document gives the bit of the block
where the next id starts. Codes are at most ``LIMIT`` bits (more only for vocabularies that need them), so
one table look-up decodes an id; all checkpoints of a block advance side by side.

Documents are coded where they are, and only codes are shuffled into order. Files follow each other in
ascending document order: document id (nulls first), then number of ids, then their checksum, so repeated
rows have a defined order among themselves. A null document id is kept. Empty texts have the end id alone;
an empty table makes no file. Other columns are not stored.

Tasks hold one block, and a document at a time. Code lengths are computed on the driver from one count per
id of the vocabulary, which bounds them; of the documents, only one row per file gets there.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from churnflow.llm.bpe import ID
from churnflow.llm.columns import delete, require, shared_path, stored
from churnflow.llm.files import RangeReader, writing
from churnflow.llm.textmap import pieces

LIMIT = 18
STRIDE = 256
BLOCK_IDS = 1 << 18
_MAGIC = b"HUFIDS01"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code lengths of least total size under ``limit``, by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)  # exact up to 2**53 ids; beyond, still a valid code
    levels, weights = [], leaves
    for _ in range(limit - 1):
        paired = len(weights) // 2 * 2
        packages = weights[0:paired:2] + weights[1:paired:2]
        merged = np.argsort(np.concatenate([leaves, packages]), kind="stable")
        levels.append(merged)
        weights = np.concatenate([leaves, packages])[merged]
    depth = np.zeros(len(order), np.int64)
    take = 2 * len(order) - 2
    for merged in reversed(levels):  # which leaves the cheapest ``take`` entries of each level hold
        chosen = merged[:take]
        own = chosen[chosen < len(order)]
        depth[own] += 1
        take = 2 * int((chosen >= len(order)).sum())
    depth[:take] += 1
    lengths[order] = depth
    return lengths


class Codebook:
    """Canonical codes: by length, then by id."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.argsort(lengths[used], kind="stable")]
        self.top = int(lengths.max()) if len(used) else 1
        widths = np.left_shift(1, self.top - self.lengths[order])
        starts = np.cumsum(widths) - widths
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = starts >> (self.top - self.lengths[order])
        #: For every bit string of ``top`` bits: the id it begins with, and that id's length.
        self.ids = np.zeros(1 << self.top, ID)
        self.ids[: int(widths.sum())] = np.repeat(order, widths)
        self.sizes = np.ones(1 << self.top, np.int64)
        self.sizes[: int(widths.sum())] = np.repeat(self.lengths[order], widths)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Packed codes, ended by a whole byte, and the bit where each stride of ids starts."""
        (packed,), (marks,) = self.encode_many(ids, np.array([len(ids)]))
        return packed, marks

    def encode_many(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """``encode`` of documents that follow each other in ``ids``, all at once; each begins at a 32-bit word of its own."""
        lengths, codes = self.lengths[ids], self.codes[ids]
        if len(ids) and not lengths.all():
            raise ValueError("an id has no code")
        ends = np.concatenate(([0], np.cumsum(lengths)))
        last = np.cumsum(sizes)
        first = last - sizes
        bits = ends[last] - ends[first]
        words = (bits + 31) >> 5
        begin = np.cumsum(words) - words
        starts = ends[:-1] - np.repeat(ends[first], sizes)
        # A code lies in a 32-bit word and at most the next; no two codes share a bit, so sums unite them.
        word, room = (starts >> 5) + np.repeat(begin, sizes), 64 - (starts & 31) - lengths
        shifted = codes << room
        total = int(words.sum())
        low = np.bincount(word, (shifted >> 32).astype(np.float64), total + 1)
        high = np.bincount(word + 1, (shifted & 0xFFFFFFFF).astype(np.float64), total + 1)
        packed = (low[: total + 1] + high[: total + 1]).astype(">u4")[:total].tobytes()
        at, size = (4 * begin).tolist(), ((bits + 7) >> 3).tolist()
        marks = [starts[a:b:STRIDE] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        return [packed[a : a + n] for a, n in zip(at, size, strict=True)], marks

    def decode(self, packed: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of all lanes, one after the other: lane k has ``sizes[k]`` ids from bit ``starts[k]`` on."""
        data = np.frombuffer(packed + bytes(8), np.uint8).astype(np.int64)
        windows = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        order = np.argsort(-sizes, kind="stable")  # so that the lanes still running are the first ones
        at, left = starts[order].astype(np.int64), sizes[order]
        places = (np.cumsum(sizes) - sizes)[order]
        out = np.empty(int(sizes.sum()), ID)
        mask, down = (1 << self.top) - 1, 32 - self.top
        for step in range(int(left[0]) if len(left) else 0):
            lanes = int(np.searchsorted(-left, -step, "left"))
            here = at[:lanes]
            found = (windows[here >> 3] >> (down - (here & 7))) & mask
            out[places[:lanes] + step] = self.ids[found]
            at[:lanes] = here + self.sizes[found]
        return out


def _lanes(sizes: np.ndarray) -> np.ndarray:
    """Ids of each lane of documents with so many ids: full strides and a rest."""
    lanes = -(-sizes // STRIDE)
    out = np.full(int(lanes.sum()), STRIDE, np.int64)
    last = np.cumsum(lanes)[lanes > 0] - 1
    out[last] = (sizes - (lanes - 1) * STRIDE)[lanes > 0]
    return out


class FileWriter:
    """Writes one file of coded documents; ``add`` them in order, then ``finish``."""

    def __init__(self, out, lengths: np.ndarray) -> None:
        self._out, self._place, self._first = out, 0, 0
        self._parts: list[bytes] = []
        self._marks: list[np.ndarray] = []
        self._size = self._bytes = self.ids = 0
        self._blocks: list[tuple[int, int, int, int]] = []
        self._documents: list[tuple[int | None, int]] = []
        packed = zlib.compress(lengths.astype(np.uint8).tobytes(), 9)
        self._write(_MAGIC + struct.pack("<II", len(lengths), len(packed)) + packed)

    def _write(self, data: bytes) -> None:
        self._out.write(data)
        self._place += len(data)

    def add(self, document: int | None, n: int, packed: bytes, marks: np.ndarray) -> None:
        self._documents.append((document, n))
        self._parts.append(packed)
        self._marks.append(marks.astype(np.int64) + 8 * self._bytes)
        self._bytes += len(packed)
        self._size += n
        self.ids += n
        if self._size >= BLOCK_IDS:
            self._flush()

    def _flush(self) -> None:
        """Place, first document, checkpoints and bytes of codes of a block go to the footer."""
        marks, codes = np.concatenate(self._marks).astype("<u8"), b"".join(self._parts)
        self._blocks.append((self._place, self._first, len(marks), len(codes)))
        # Differences of neighbouring checkpoints are small.
        packed = zlib.compress(np.diff(marks, prepend=np.uint64(0)).astype("<u4").tobytes(), 6)
        self._write(struct.pack("<Q", len(packed)) + packed + codes)
        self._first, self._size, self._bytes = len(self._documents), 0, 0
        self._parts, self._marks = [], []

    def finish(self) -> None:
        if self._parts:
            self._flush()
        none = -(1 << 63)
        table = np.array([(none if d is None else d, n) for d, n in self._documents], "<i8").reshape(-1, 2).tobytes()
        packed = zlib.compress(json.dumps({"blocks": self._blocks}).encode(), 6), zlib.compress(table, 6)
        self._write(packed[0] + packed[1] + struct.pack("<QQ", *map(len, packed)) + _MAGIC)


class FileReader:
    """Documents, block places and ids of one file."""

    def __init__(self, file: RangeReader) -> None:
        self._file = file
        head = file.read(0, 16)
        foot = file.read(file.size - 24, 24)
        if head[:8] != _MAGIC or foot[16:] != _MAGIC:
            raise ValueError("not a file of Huffman-coded ids, or cut short")
        n, size = struct.unpack("<II", head[8:])
        self._book = Codebook(np.frombuffer(zlib.decompress(file.read(16, size)), np.uint8)[:n])
        sizes = struct.unpack("<QQ", foot[:16])
        start = file.size - 24 - sum(sizes)
        self._blocks = json.loads(zlib.decompress(file.read(start, sizes[0])))["blocks"]
        table = np.frombuffer(zlib.decompress(file.read(start + sizes[0], sizes[1])), "<i8").reshape(-1, 2)
        self.documents = [(None if d == -(1 << 63) else d, n) for d, n in table.tolist()]
        self._sizes = table[:, 1]

    def __len__(self) -> int:
        return len(self._blocks)

    def _head(self, number: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """First document, place of the codes, checkpoints and sizes of the lanes of a block."""
        place, first, _, _ = self._blocks[number]
        last = self._blocks[number + 1][1] if number + 1 < len(self._blocks) else len(self.documents)
        size = struct.unpack("<Q", self._file.read(place, 8))[0]
        steps = np.frombuffer(zlib.decompress(self._file.read(place + 8, size)), "<u4")
        return first, place + 8 + size, np.cumsum(steps, dtype=np.int64), self._sizes[first:last]

    def block(self, number: int) -> list[np.ndarray]:
        """The ids of each document of a block."""
        _, place, marks, sizes = self._head(number)
        ids = self._book.decode(self._file.read(place, self._blocks[number][3]), marks, _lanes(sizes))
        return np.split(ids, np.cumsum(sizes)[:-1])

    def ids(self, document: int, start: int = 0, n: int | None = None) -> np.ndarray:
        """``n`` ids of the ``document``-th document from ``start`` on, reading from the checkpoint before them."""
        number = max(i for i, (_, first, _, _) in enumerate(self._blocks) if first <= document)
        first, place, marks, sizes = self._head(number)
        own = int(sizes[document - first])
        end = own if n is None else min(own, start + n)
        if start >= end:
            return np.zeros(0, ID)
        before = int((-(-sizes[: document - first] // STRIDE)).sum())
        low, high = before + start // STRIDE, before + -(-end // STRIDE)
        begin = int(marks[low]) // 8
        stop = -(-int(marks[high]) // 8) if high < len(marks) else self._blocks[number][3]
        lanes = _lanes(np.array([own]))[start // STRIDE : -(-end // STRIDE)]
        found = self._book.decode(self._file.read(place + begin, stop - begin), marks[low:high] - 8 * begin, lanes)
        return found[start % STRIDE : start % STRIDE + end - start]


def counts(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """How often each id occurs: counted within tasks, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for part in pieces(batch, batch.column(0)):
                found = np.bincount(np.frombuffer(b"".join(part.column(0).drop_null().to_pylist()), ID))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return encoded.select(F.col(f"`{ids}`")).mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _place(document: int | None, n: int, check: int) -> tuple:
    """What documents are ordered by: nulls first."""
    return document is not None, document or 0, n, check


def _bounds(encoded: DataFrame, doc_id: str, ids: str) -> list[tuple]:
    """Places that cut the documents into about equal files, as many as shuffle partitions.

    Taken from a sample of about 100 documents a file. It only decides where files end: a range exchange would
    code all documents twice, once for its own sample.
    """
    files = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, 100 * files / max(1, encoded.count()))
    sampled = encoded.sample(share, 1).select(F.col(f"`{doc_id}`").cast("long"), F.length(ids), F.crc32(F.col(f"`{ids}`")))
    places = sorted(_place(d, (n or 0) // ID.itemsize, check or 0) for d, n, check in sampled.collect())
    return sorted({places[i * len(places) // files] for i in range(1, files)}) if places else []


def write(encoded: DataFrame, folder: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Write ids (little-endian unsigned 32-bit, as binary) below ``folder``; returns a row per file.

    ``encoded`` is read twice, for the counts and to be written, and should be a stored table.
    """
    require(encoded, doc_id, ids)
    found = counts(encoded, ids).collect()  # a row per id of the vocabulary at most
    table = np.zeros(max((r.id for r in found), default=0) + 1, np.int64)
    table[[r.id for r in found]] = [r.n for r in found]
    limit = max(LIMIT, int(np.ceil(np.log2(max(2, len(found))))) + 1)
    shared = encoded.sparkSession.sparkContext.broadcast(code_lengths(table, limit))

    bounds = _bounds(encoded, doc_id, ids)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(shared.value)
        for whole in batches:
            for batch in pieces(whole, whole.column(1)):
                values = [v or b"" for v in batch.column(1).to_pylist()]
                sizes = np.array([len(v) // ID.itemsize for v in values], np.int64)
                checks = [zlib.crc32(v) for v in values]
                packed, marks = book.encode_many(np.frombuffer(b"".join(values), ID), sizes)
                parts = [bisect_right(bounds, _place(*d)) for d in zip(batch.column(0).to_pylist(), sizes.tolist(), checks, strict=True)]
                out = [parts, sizes, checks, packed, [m.astype("<u8").tobytes() for m in marks]]
                arrays = [pa.array(c, pa.int64()) for c in out[:3]] + [pa.array(c, pa.binary()) for c in out[3:]]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["document", "part", "n", "check", "codes", "marks"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for part, own in groupby(rows, key=lambda row: row[0]):
            path, documents = f"{folder}/part-{part:06d}.ids", 0
            with writing(path) as out:
                writer = FileWriter(out, shared.value)
                for _, document, n, codes, marks in own:
                    writer.add(document, n, codes, np.frombuffer(marks, "<u8"))
                    documents += 1
                writer.finish()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([path]), pa.array([documents], pa.int64()), pa.array([writer.ids], pa.int64())],
                names=["part", "path", "documents", "ids"],
            )

    rows = encoded.select(F.col(f"`{doc_id}`").cast("long").alias("document"), F.col(f"`{ids}`").alias("ids"))
    rows = rows.mapInArrow(code, "document long, part long, n long, check long, codes binary, marks binary")
    rows = rows.repartition("part").sortWithinPartitions("part", "document", "n", "check")
    rows = rows.select("part", "document", "n", "codes", "marks")
    return stored(rows.mapInArrow(fill, "part long, path string, documents long, ids long"), "token-files")


def read(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A file's own start is the sum over the files before it, taken from the list of files.
    """
    spark = files.sparkSession
    base, listed = 0, []
    for row in sorted(files.collect(), key=lambda r: r.part):  # a row per file
        listed.append(Row(path=row.path, base=base))
        base += row.ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not listed:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in (pair for b in batches for pair in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            with RangeReader(path) as opened:
                file = FileReader(opened)
                checks = [zlib.crc32(ids.tobytes()) for number in range(len(file)) for ids in file.block(number)]
                sizes = np.array([n for _, n in file.documents], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([d for d, _ in file.documents], pa.int64()), pa.array(base + np.cumsum(sizes) - sizes, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(checks, pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    paths = spark.createDataFrame(listed, "path string, base long").repartition(len(listed))
    return paths.mapInArrow(run, schema)


def round_trip(encoded: DataFrame, end_id: int, spent: str | None = None) -> DataFrame:
    """Append ``end_id`` to the ids of each document, write the files, and read them back.

    ``spent`` names a folder that ``encoded`` is made from, deleted as soon as the ids are stored.
    """
    spark = encoded.sparkSession
    tail = F.unhex(F.lit(int(end_id).to_bytes(4, "little").hex()))
    rows = encoded.select("doc_id", F.concat(F.coalesce("ids", F.lit(b"")), tail).alias("ids"))
    rows = stored(rows, "token-ids")
    if spent:
        delete(spark, spent)
    return read(write(rows, shared_path(spark, "token-store")))
