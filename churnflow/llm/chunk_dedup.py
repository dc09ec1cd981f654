"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends after a byte whose hash is the greatest within
``REACH`` bytes to both sides. Cuts depend on the bytes around them alone, so the same passage is cut in the
same way wherever it stands, and an insertion moves no cut beyond its neighbourhood. Cuts move on to the
next character, so no character is split.

Compared are windows: the ``MIN_RUN`` bytes that lie around a cut, from ``LEADS`` bytes before it on, and chunks
that are longer. Of the windows with one digest, the first stays: that of the smallest document id (nulls
last), then of the smallest offset. The bytes of later ones are removed, but for parts of characters at their
ends. So all that goes stands in one piece of ``MIN_RUN`` bytes at one earlier place, which may overlap it;
shorter repeats, such as stock phrases and lines, stay in whatever order they come. Texts of less than that
are never changed. The windows of a text leave no gap, so a copy of a whole text is left empty. Other repeats
of ``MIN_RUN`` bytes and little more may hold no window and stay; the README has how many.

Tasks collect blocks of about ``BLOCK_BYTES`` of text and send each digest once a block to its bucket, with the
first document that has it. Buckets answer each block with one bit a digest: whether the first window is
here. So a window that a third of all documents have is one row a block, and no task sees all its copies.
Blocks are written to the shared folder, so that the answers always meet the blocks they were made for.

Null texts stay null and have no bytes. Repeated rows: the first one in a block stays, blocks in order of
their name. Empty tables give empty results. Other columns pass through; one with the name of a result
column is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from churnflow.llm.columns import require, stored
from churnflow.llm.textmap import pieces

REACH = 12
MIN_RUN = 160
# A cut depends on 28 bytes before it and 12 after. A repeat of n bytes is found if one of its cuts lies between
# a lead and n - MIN_RUN bytes more; with two leads one may lie in either of two stretches.
LEADS = (28, 88)
BLOCK_BYTES = 16 << 20
_DIGEST = np.dtype("<u8")
_LAST = np.iinfo(np.int64).max

# One random number a byte value, from a fixed seed.
_GEAR = np.random.default_rng(20_260_101).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte, over the last 16 bytes: h = (h << 2) + gear[byte] in 32 bits, by doubling."""
    h = _GEAR[data]
    for shift in (1, 2, 4, 8):
        h[shift:] += h[:-shift] << np.uint32(2 * shift)
    return h


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of ``data``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    values = np.frombuffer(data, np.uint8)
    h = gear(values)
    low = np.zeros(n + 2 * REACH, np.uint32)
    low[REACH : REACH + n] = h
    # Greatest of the REACH values before, and of those after: windows of 8, then two of them overlapping.
    wide, size = low, 1
    while size * 2 <= REACH:
        wide = np.maximum(wide[:-size], wide[size:])
        size *= 2
    wide = np.maximum(wide[: len(wide) - (REACH - size)], wide[REACH - size :])
    top = np.flatnonzero((h > wide[:n]) & (h >= wide[REACH + 1 : REACH + 1 + n]))
    ends = top + 1
    inside = (values & 0xC0) == 0x80  # bytes that go on a character
    for _ in range(3):
        on = ends[ends < n]
        ends[ends < n] = on + inside[on]
    return np.unique(np.append(ends, n))


def windows(ends: np.ndarray, size: int) -> np.ndarray:
    """Byte ranges [start, end) to compare, in a text with these chunks; none if it has less than ``size`` bytes."""
    if not len(ends) or ends[-1] < size:
        return np.zeros((0, 2), np.int64)
    at = np.concatenate(([0], ends))
    starts = np.unique(np.clip(at - np.array(LEADS)[:, None], 0, at[-1] - size))
    long = np.flatnonzero(np.diff(at) > size)  # windows around its ends would leave a gap
    return np.concatenate((np.stack((starts, starts + size), 1), np.stack((at[long], at[long + 1]), 1)))


def digests(data: bytes, ranges: np.ndarray) -> np.ndarray:
    from xxhash import xxh3_64_digest

    return np.frombuffer(b"".join([xxh3_64_digest(data[a:b]) for a, b in ranges.tolist()]), ">u8").astype(_DIGEST)


def _squeeze(values: np.ndarray) -> bytes:
    """64-bit values as compressed planes of bytes."""
    data = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _expand(data: bytes, kind: str) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


class _Block:
    def __init__(self, min_run: int) -> None:
        self.min_run = min_run
        self.size = self.digest = 0
        self.parts: list[pa.Array] = []
        self.found: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []

    def add(self, documents: pa.Array, ids: pa.Array, texts: pa.Array) -> None:
        for number, value in zip(ids.to_pylist(), texts, strict=True):
            text = value.as_py() or b""
            self.size += len(text)
            self.digest = zlib.crc32(text, zlib.crc32(len(text).to_bytes(8, "little"), self.digest))
            found = np.unique(digests(text, windows(cuts(text), self.min_run)))
            self.found.append(found)
            self.owners.append(np.full(len(found), _LAST if number is None else number, np.int64))
        self.parts.append(documents)

    def rows(self, name: str, buckets: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        fields = ["block", "bucket", "digests", "owners", "documents"]
        for documents in self.parts:
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents).cast(kind),
            ], names=fields)
        found, owners = np.concatenate(self.found), np.concatenate(self.owners)
        order = np.lexsort((owners, found))
        found, owners = found[order], owners[order]
        first = np.append(True, found[1:] != found[:-1])[: len(found)]
        found, owners = found[first], owners[first]
        # Buckets are ranges of digests, so a sorted list is sorted by bucket as well.
        bucket = ((found >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        named, starts = np.unique(bucket, return_index=True)
        bounds = [*starts.tolist(), len(found)]
        steps = [np.diff(found[a:b], prepend=np.uint64(0)) for a, b in zip(bounds, bounds[1:])]
        n = len(named)
        yield pa.RecordBatch.from_arrays([
            pa.array([name] * n, pa.string()), pa.array(named, pa.int32()), pa.array([_squeeze(s) for s in steps], pa.binary()),
            pa.array([_squeeze(owners[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()), pa.nulls(n, kind),
        ], names=fields)


def _blocks(documents: DataFrame, doc_id: str, text: str, buckets: int, min_run: int) -> DataFrame:
    source = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"),
        F.col(f"`{doc_id}`").cast("long").alias("number"), F.col(f"`{text}`").cast("binary").alias("text"),
    )
    schema = StructType([
        StructField("block", StringType()), StructField("bucket", IntegerType()), StructField("digests", BinaryType()),
        StructField("owners", BinaryType()), StructField("documents", ArrayType(source.schema["document"].dataType)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, made, block = TaskContext.get().partitionId(), 0, _Block(min_run)
        kind = to_arrow_type(schema["documents"].dataType)
        for whole in batches:
            for batch in pieces(whole, whole.column(2)):
                block.add(*batch.columns)
                if block.size >= BLOCK_BYTES:
                    yield from block.rows(f"{partition:06d}-{made:06d}-{block.digest:08x}", buckets, kind)
                    made, block = made + 1, _Block(min_run)
        if block.parts:
            yield from block.rows(f"{partition:06d}-{made:06d}-{block.digest:08x}", buckets, kind)

    return source.mapInArrow(run, schema)


def _own(group: pa.Table) -> pa.Table:
    """For the blocks of one bucket, bits: whether the block has the first window of each of its digests."""
    group = group.sort_by("block")
    found = [np.cumsum(_expand(v, "<u8"), dtype=_DIGEST) for v in group.column("digests").to_pylist()]
    owners = np.concatenate([_expand(v, "<i8") for v in group.column("owners").to_pylist()])
    sizes = [len(f) for f in found]
    every = np.concatenate(found)
    order = np.lexsort((np.repeat(np.arange(len(sizes)), sizes), owners, every))
    first = np.empty(len(every), bool)
    first[order] = np.append(True, every[order][1:] != every[order][:-1])[: len(every)]
    bits = [np.packbits(part).tobytes() for part in np.split(first, np.cumsum(sizes)[:-1])]
    return pa.table({
        "block": group.column("block"), "bucket": group.column("bucket"),
        "n": pa.array(sizes, pa.int32()), "bits": pa.array(bits, pa.binary()),
    })


def removed_runs(data: bytes, later: np.ndarray) -> np.ndarray:
    """Byte ranges [start, end) that the windows ``later`` cover, of whole characters."""
    if not len(later):
        return later
    later = later[np.argsort(later[:, 0], kind="stable")]
    reach = np.maximum.accumulate(later[:, 1])
    fresh = np.flatnonzero(np.append(True, later[1:, 0] > reach[:-1]))
    runs = np.stack((later[fresh, 0], reach[np.append(fresh[1:], len(later)) - 1]), 1)
    inside = np.append((np.frombuffer(data, np.uint8) & 0xC0) == 0x80, False)
    for _ in range(3):
        runs[:, 0] += inside[runs[:, 0]]
        runs[:, 1] -= inside[runs[:, 1]]
    return runs


def dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", *, min_run: int = MIN_RUN) -> DataFrame:
    """``documents`` with repeated windows cut out of ``text``, and ``n_bytes`` (before), ``n_chunks``,
    ``n_removed`` (bytes) and ``n_spans`` (removed runs)."""
    require(documents, doc_id, text)
    counted = ["n_bytes", "n_chunks", "n_removed", "n_spans"]
    documents = documents.drop(*counted)
    spark = documents.sparkSession
    blocks = stored(_blocks(documents, doc_id, text, int(spark.conf.get("spark.sql.shuffle.partitions")), min_run), "chunk-blocks")
    sent = blocks.filter("bucket IS NOT NULL").select("block", "bucket", "digests", "owners")
    answers = sent.groupBy("bucket").applyInArrow(_own, "block string, bucket int, n int, bits binary")
    columns = documents.columns
    ids_at, text_at = columns.index(doc_id), columns.index(text)

    def cut(mine: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for n, b in zip(answers.column("n").to_pylist(), answers.column("bits").to_pylist(), strict=True)]
        first_here = np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)
        whole = pa.concat_arrays([c.flatten() for c in mine.column("documents").chunks])
        fields = whole.flatten()
        ids, texts = fields[ids_at].to_pylist(), fields[text_at]
        ends, ranges, found = [], [], []
        for value in texts:
            data = (value.as_py() or "").encode("utf-8")
            ends.append(cuts(data))
            ranges.append(windows(ends[-1], min_run))
            found.append(digests(data, ranges[-1]))
        sizes = [len(f) for f in found]
        every = np.concatenate(found)
        named, number = np.unique(every, return_inverse=True)
        if len(named) != len(first_here):
            raise RuntimeError("a block and the answers to it differ")
        owner = np.repeat(np.array([_LAST if i is None else i for i in ids], np.int64), sizes)
        order = np.lexsort((np.arange(len(every)), owner, number))
        kept = np.zeros(len(every), bool)
        kept[order] = np.append(True, number[order][1:] != number[order][:-1])[: len(every)]
        kept &= first_here[number]
        out = {name: [] for name in counted}
        new, low = [], 0
        for value, own_ends, own_ranges in zip(texts, ends, ranges, strict=True):
            later = own_ranges[~kept[low : low + len(own_ranges)]]
            low += len(own_ranges)
            value = value.as_py()
            data = (value or "").encode("utf-8") if len(later) else b""
            runs = removed_runs(data, later)
            out["n_bytes"].append(int(own_ends[-1]) if len(own_ends) else 0)
            out["n_chunks"].append(len(own_ends))
            out["n_removed"].append(int((runs[:, 1] - runs[:, 0]).sum()))
            out["n_spans"].append(len(runs))
            if len(runs):
                parts, at = [], 0
                for start, end in runs.tolist():
                    parts.append(data[at:start])
                    at = end
                value = b"".join([*parts, data[at:]]).decode("utf-8")
            new.append(value)
        fields[text_at] = pa.array(new, texts.type)
        return pa.table([*fields, *(pa.array(out[n], pa.int64()) for n in counted)], names=[*columns, *counted])

    schema = StructType(documents.schema.fields + [StructField(n, LongType()) for n in counted])
    rows = blocks.filter("bucket IS NULL").select("block", "documents")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, schema)
