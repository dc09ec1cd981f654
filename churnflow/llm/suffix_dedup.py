"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts anywhere else go.

Texts are their UTF-8 bytes; no match crosses documents, overlapping matches in one document count, and
strings are judged on the input.

1. A string has a fingerprint: the least hash of the 64-byte strings (grams) in it. It is a function of the
   string alone. Starts with one least gram are a run, and equal strings are in different runs, so only starts
   whose fingerprint several runs have can be repeated. Blocks of documents count the runs of fingerprints, in buckets.
2. The bytes of a run of starts with one repeated fingerprint are a piece. Equal strings have equal
   fingerprints, so their pieces meet in one bucket, each different piece once with the number of its copies.
   The pieces of a few fingerprints make a shard; its suffix array, by induced sorting, and the
   common prefixes of neighbours in it tell which strings are repeated. All starts of a piece with a copy are.
3. A line shorter than a string, in very many different texts, gives them all one fingerprint but no equal strings.
   So a fingerprint of more than ``CROWDED`` runs is refined by the whole strings: starts of its runs are dealt by a
   128-bit digest of their string, each digest once a block, and those with a digest that comes again are repeated.
   Equal digests count as equal strings.
4. Each block gets its answers and removes what the repeated strings cover.

No step is a sample: pieces hold all of a text but what has a fingerprint of its own. Blocks are written to
the shared folder, and each later step answers exactly the block that asked. A passage that a third of all
documents hold is one piece a block, or one digest a start and block. What meets in one task are the different pieces around one
fingerprint, ``CROWDED`` at most, and one entry a block of each digest. Texts of any length pass; a task holds a block and
its longest text several times over.

Null texts stay null and have no bytes. Texts of less than ``LENGTH`` bytes are never changed. Repeated rows
remove each other like any other copies. Empty tables give empty results. Other columns pass through; one
with the name of a result column is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from churnflow.llm.columns import delete, require, shared_path, stored
from churnflow.llm.suffix_array import repeated_starts
from churnflow.llm.textmap import pieces as slices

LENGTH = 200
GRAM = 64
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
CROWDED = 4096  # runs of one fingerprint whose pieces meet in one shard, of about 300 bytes each
_COUNT, _MANY = np.dtype("<u2"), (1 << 16) - 1
_CHUNK = 4 << 20  # starts of a long text that are fingerprinted at once
_PLACE = np.uint64((1 << 23) - 1)  # low bits of a ranked hash that hold its place in a chunk

_random = np.random.default_rng(11)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64)
_ODD = _random.integers(0, 1 << 62, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_grams(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``GRAM``-byte strings, and for each start the place of the least one in its string.

    Of equal ones the first is taken, so equal strings at two starts have theirs at two places.
    """
    h = _BYTE[data]
    for i, size in enumerate((1, 2, 4, 8, 16, 32)):
        h = h[:-size] * _ODD[i] + h[size:]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    ranked = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    window, size = length - GRAM + 1, 1
    while size * 2 <= window:
        ranked = np.minimum(ranked[:-size], ranked[size:])
        size *= 2
    rest = window - size
    ranked = np.minimum(ranked[:-rest], ranked[rest:]) if rest else ranked
    return h, (ranked & _PLACE).astype(np.int64)


def runs(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, first start and number of starts of each run of starts with one least gram."""
    values = np.frombuffer(data, np.uint8)
    found, starts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, max(0, len(values) - length + 1), _CHUNK):
        h, place = least_grams(values[low : low + _CHUNK + length - 1], length)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        found.append(h[place[first]])
        starts.append(first + low)
        counts.append(np.diff(np.append(first, len(place))))
    return np.concatenate(found), np.concatenate(starts), np.concatenate(counts)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of fingerprints' mixed bits; the least hashes themselves crowd near zero."""
    mixed = values * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """A stable order by bucket, and (bucket, low, high) of each in that order."""
    order = np.argsort(bucket, kind="stable")
    named, first = np.unique(bucket[order], return_index=True)
    return order, list(zip(named.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)][: len(named)], strict=True))


def _rows(fields: StructType, **columns) -> pa.RecordBatch:
    size = max(len(v) for v in columns.values())
    types = {f.name: to_arrow_type(f.dataType) for f in fields.fields}
    arrays = [v if isinstance(v := columns.get(n), pa.Array) else pa.nulls(size, t) if v is None else pa.array(v, t) for n, t in types.items()]
    return pa.RecordBatch.from_arrays(arrays, names=fields.names)


class _Dealer:
    """Numbers a block's fingerprints, and finds its answers again in the same order."""

    def __init__(self, found: list[np.ndarray], buckets: int) -> None:
        every = np.concatenate(found) if found else np.zeros(0, np.uint64)
        self.values, self.number, self.counts = np.unique(every, return_inverse=True, return_counts=True)
        self.order, self.bounds = _by_bucket(_bucket(self.values, buckets))


def _blocks(documents: DataFrame, text: str, length: int, buckets: int, document: StructField) -> DataFrame:
    schema = StructType([
        StructField("block", StringType()), StructField("bucket", IntegerType()),
        StructField("values", BinaryType()), StructField("counts", BinaryType()), StructField("documents", ArrayType(document.dataType)),
    ])

    def flush(parts: list, found: list, name: str) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_type(schema["documents"].dataType)
        for part in parts:
            packed = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part).cast(kind)
            yield _rows(schema, block=[name], documents=packed)
        dealt = _Dealer(found, buckets)
        for bucket, low, high in dealt.bounds:
            mine = dealt.order[low:high]
            yield _rows(schema, block=[name], bucket=[bucket], values=[_squeeze(dealt.values[mine].tobytes())], counts=[_squeeze(np.minimum(dealt.counts[mine], _MANY).astype(_COUNT).tobytes())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, made = TaskContext.get().partitionId(), 0
        parts, found, size, check = [], [], 0, 0
        for whole in batches:
            for batch in slices(whole, whole.column(1)):
                for value in batch.column(1):
                    data = value.as_py() or b""
                    size += len(data)
                    check = zlib.crc32(data, zlib.crc32(len(data).to_bytes(8, "little"), check))
                    found.append(runs(data, length)[0])
                parts.append(batch.column(0))
                if size >= BLOCK_BYTES:
                    yield from flush(parts, found, f"{partition:06d}-{made:06d}-{check:08x}")
                    made, parts, found, size = made + 1, [], [], 0
        if parts:
            yield from flush(parts, found, f"{partition:06d}-{made:06d}-{check:08x}")

    source = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"), F.col(f"`{text}`").cast("binary").alias("text"))
    return source.mapInArrow(run, schema)


def _repeated(crowded: int):
    def run(group: pa.Table) -> pa.Table:
        """For the blocks of one bucket, bits: whether a fingerprint occurs in several runs, and whether in very many."""
        found = [np.frombuffer(_expand(v), np.uint64) for v in group.column("values").to_pylist()]
        counts = np.concatenate([np.frombuffer(_expand(v), _COUNT) for v in group.column("counts").to_pylist()])
        _, number = np.unique(np.concatenate(found), return_inverse=True)
        total = np.bincount(number, counts)[number]
        ends = np.cumsum([len(f) for f in found])[:-1]
        bits = [[np.packbits(b).tobytes() for b in np.split(total > least, ends)] for least in (1, crowded)]
        return pa.table({
            "block": group.column("block"), "bucket": group.column("bucket"), "bits": pa.array(bits[0], pa.binary()), "crowded": pa.array(bits[1], pa.binary()),
        })

    return run


def digests(data: bytes, starts: np.ndarray, counts: np.ndarray, length: int) -> list[bytes]:
    """128-bit digests of the strings that begin in these runs, in order."""
    from xxhash import xxh3_128_digest

    return [xxh3_128_digest(data[i : i + length]) for a, n in zip(starts.tolist(), counts.tolist(), strict=True) for i in range(a, a + n)]


def _string_rows(counted: dict[bytes, int], buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, digests, bits: whether the block has one several times); sorted digests are sorted by bucket, too."""
    listed = sorted(counted)
    if not listed:
        return
    heads = np.array([int.from_bytes(d[:4], "big") for d in listed], np.uint64)
    bucket = (heads * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    named, first = np.unique(bucket, return_index=True)
    for number, low, high in zip(named.tolist(), first.tolist(), [*first[1:].tolist(), len(listed)], strict=True):
        yield number, b"".join(listed[low:high]), np.packbits([counted[d] > 1 for d in listed[low:high]]).tobytes()


def _strings_again(group: pa.Table) -> pa.Table:
    """For the blocks of one bucket, bits: whether a digest comes again anywhere."""
    total: dict[bytes, int] = {}
    asked = []
    for packed, twice in zip(group.column("strings").to_pylist(), group.column("twice").to_pylist(), strict=True):
        mine = [packed[i : i + 16] for i in range(0, len(packed), 16)]
        for digest, more in zip(mine, np.unpackbits(np.frombuffer(twice, np.uint8), count=len(mine)).tolist(), strict=True):
            total[digest] = total.get(digest, 0) + 1 + more
        asked.append(mine)
    bits = [np.packbits([total[d] > 1 for d in mine]).tobytes() for mine in asked]
    n = len(asked)
    return pa.table({
        "block": group.column("block"), "bucket": group.column("bucket"), "sizes": pa.nulls(n, pa.binary()),
        "bits": pa.array(bits, pa.binary()), "strings": pa.array([len(m) for m in asked], pa.int32()),
    })


_ASKED = [StructField(n, BinaryType()) for n in ("values", "sizes", "copies", "bytes")]


def _ask(length: int, buckets: int, text_at: int, schema: StructType):
    """Per block: its documents with their candidate runs, and its different pieces by bucket."""

    def run(mine: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        whole = pa.concat_arrays([c.flatten() for c in mine.column("documents").chunks])
        block = mine.column("block")[0].as_py()
        texts = [(v.as_py() or "").encode("utf-8") for v in whole.flatten()[text_at]]
        found = [runs(t, length) for t in texts]
        dealt = _Dealer([f[0] for f in found], buckets)
        again, crowded = np.zeros(len(dealt.values), bool), np.zeros(len(dealt.values), bool)
        for (_, low, high), *bits in zip(dealt.bounds, answers.column("bits").to_pylist(), answers.column("crowded").to_pylist(), strict=True):
            for flags, packed in zip((again, crowded), bits, strict=True):
                flags[dealt.order[low:high]] = np.unpackbits(np.frombuffer(packed, np.uint8), count=high - low)
        again &= ~crowded
        strings: dict[bytes, int] = {}
        many = []
        numbers: dict[bytes, int] = {}
        values, copies, candidates, at = [], [], [], 0
        for data, (own, starts, counts) in zip(texts, found, strict=True):
            number_of = dealt.number[at : at + len(own)]
            take, hot = np.flatnonzero(again[number_of]), np.flatnonzero(crowded[number_of])
            at += len(own)
            many.append(_squeeze(np.array([starts[hot], counts[hot]], "<i8").tobytes()) if len(hot) else None)
            for digest in digests(data, starts[hot], counts[hot], length):
                strings[digest] = strings.get(digest, 0) + 1
            index = []
            for i in take.tolist():
                piece = data[starts[i] : starts[i] + counts[i] + length - 1]
                number = numbers.setdefault(piece, len(numbers))
                if number == len(copies):
                    copies.append(0)
                    values.append(own[i])
                copies[number] = min(2, copies[number] + 1)
                index.append(number)
            candidates.append(_squeeze(np.array([starts[take], counts[take], index], "<i8").tobytes()) if len(take) else None)
        listed = list(numbers)
        values = np.array(values, np.uint64)
        order, bounds = _by_bucket(_bucket(values, buckets))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows = [_rows(schema, block=[block] * len(whole), document=whole, candidates=candidates, many=many, places=[None] * len(whole))]
        for bucket, packed, twice in _string_rows(strings, buckets):
            rows.append(_rows(schema, block=[block], bucket=[bucket], strings=[packed], twice=[twice]))
        # The pieces go by bucket; ``places`` tells where a number of the candidates is in that order.
        rows.append(_rows(schema, block=[block], places=[_squeeze(place.tobytes())]))
        for bucket, low, high in bounds:
            own = order[low:high].tolist()
            rows.append(_rows(
                schema, block=[block], bucket=[bucket], values=[_squeeze(values[own].tobytes())],
                sizes=[_squeeze(np.array([len(listed[i]) for i in own], "<i4").tobytes())],
                copies=[np.array([copies[i] for i in own], np.uint8).tobytes()], bytes=[_squeeze(b"".join([listed[i] for i in own]))],
            ))
        return pa.Table.from_batches(rows)

    return run


def _judge(length: int):
    """For the blocks of one bucket, bits: which starts of each piece are repeated."""

    def run(group: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        values, weights, asked = [], [], []
        for packed_values, sizes, copies, data in zip(*(group.column(f.name).to_pylist() for f in _ASKED), strict=True):
            data, at, mine = _expand(data), 0, []
            for value, size, weight in zip(np.frombuffer(_expand(packed_values), np.uint64).tolist(), np.frombuffer(_expand(sizes), "<i4").tolist(), copies, strict=True):
                number = numbers.setdefault(data[at : at + size], len(numbers))
                at += size
                if number == len(values):
                    values.append(value)
                    weights.append(0)
                weights[number] = min(2, weights[number] + weight)
                mine.append(number)
            asked.append(mine)
        listed = list(numbers)
        order = np.argsort(np.array(values, np.uint64), kind="stable").tolist()
        found: list[np.ndarray | None] = [None] * len(listed)
        shard: list[int] = []
        held = 0
        for i, number in enumerate(order):
            shard.append(number)
            held += len(listed[number])
            last = i + 1 == len(order)
            # A shard ends between two fingerprints, since equal strings have equal ones.
            if last or held >= SHARD_BYTES and values[order[i + 1]] != values[number]:
                for n, starts in zip(shard, repeated_starts([listed[n] for n in shard], length), strict=True):
                    found[n] = starts if weights[n] < 2 else np.ones(len(starts), bool)
                shard, held = [], 0
        bits = [_squeeze(np.packbits(np.concatenate([found[n] for n in mine])).tobytes()) for mine in asked]
        return pa.table({
            "block": group.column("block"), "bucket": group.column("bucket"), "sizes": group.column("sizes"),
            "bits": pa.array(bits, pa.binary()), "strings": pa.nulls(len(bits), pa.int32()),
        })

    return run


_COUNTED = ["n_bytes", "n_removed", "n_spans"]


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Ranges [start, end) of the bytes that strings of ``length`` bytes at these starts cover."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    starts = np.unique(starts)
    new = np.append(True, starts[1:] > starts[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return np.stack([starts[first], np.minimum(n, starts[last] + length)], axis=1)


def _remove(length: int, schema: StructType):
    def run(mine: pa.Table, answers: pa.Table) -> pa.Table:
        documents = mine.filter(pa.compute.is_null(mine.column("places")))
        whole = pa.concat_arrays(documents.column("document").chunks)
        fields = dict(zip([whole.type.field(i).name for i in range(whole.type.num_fields)], whole.flatten(), strict=True))
        ranges, starts_of = [], None
        of_strings = answers.filter(pa.compute.is_valid(answers.column("strings"))).sort_by("bucket")
        answers = answers.filter(pa.compute.is_null(answers.column("strings")))
        texts = [(v.as_py() or "").encode("utf-8") for v in fields[schema.names[0]]]
        many = [None if m is None else np.frombuffer(_expand(m), "<i8").reshape(2, -1) for m in documents.column("many").to_pylist()]
        strings = [digests(data, *m, length) if m is not None else [] for data, m in zip(texts, many, strict=True)]
        listed = sorted({d for own in strings for d in own})
        flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(of_strings.column("bits").to_pylist(), of_strings.column("strings").to_pylist(), strict=True)]
        repeated = dict(zip(listed, np.concatenate([np.zeros(0, np.uint8), *flags]).tolist(), strict=True))
        if answers.num_rows:
            answers = answers.sort_by("bucket")
            place = np.frombuffer(_expand(mine.filter(pa.compute.is_valid(mine.column("places"))).column("places")[0].as_py()), np.int64)
            sizes = np.concatenate([np.frombuffer(_expand(v), "<i4") for v in answers.column("sizes").to_pylist()]).astype(np.int64) - length + 1
            bits, low = [], 0
            for packed, v in zip(answers.column("bits").to_pylist(), answers.column("sizes").to_pylist(), strict=True):
                n = len(_expand(v)) // 4
                bits.append(np.unpackbits(np.frombuffer(_expand(packed), np.uint8), count=int(sizes[low : low + n].sum())))
                low += n
            bits, first = np.concatenate(bits), np.cumsum(sizes) - sizes
            starts_of = lambda i: np.flatnonzero(bits[first[place[i]] : first[place[i]] + sizes[place[i]]])
        out = {name: [] for name in _COUNTED}
        text, new = fields[schema.names[0]], []
        for value, data, candidates, crowded, own in zip(text, texts, documents.column("candidates").to_pylist(), many, strings, strict=True):
            starts = []
            if candidates is not None:
                begin, _, index = np.frombuffer(_expand(candidates), "<i8").reshape(3, -1)
                starts += [b + starts_of(i) for b, i in zip(begin.tolist(), index.tolist(), strict=True)]
            if crowded is not None:
                places = np.concatenate([np.arange(a, a + n) for a, n in crowded.T.tolist()])
                starts.append(places[np.array([repeated[d] for d in own], bool)])
            ranges = covered(np.concatenate(starts), len(data), length) if starts else np.zeros((0, 2), np.int64)
            parts, at = [], 0
            for low, high in ranges.tolist():
                parts.append(data[at:low])
                at = high
            new.append(b"".join([*parts, data[at:]]) if value.is_valid else None)
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int((ranges[:, 1] - ranges[:, 0]).sum()))
            out["n_spans"].append(len(ranges))
        names = schema.names[1 : -len(_COUNTED)]
        arrays = [pa.array(new, pa.binary()), *(fields[n] for n in names), *(pa.array(out[n], pa.int64()) for n in _COUNTED)]
        return pa.table(arrays, names=schema.names)

    return run


def dedup(documents: DataFrame, text: str = "text", *, length: int = LENGTH) -> DataFrame:
    """``documents`` with ``text`` as its remaining bytes (binary: a removal may split a character), and
    ``n_bytes`` (before), ``n_removed`` and ``n_spans`` (runs of removed bytes)."""
    require(documents, text)
    documents = documents.drop(*_COUNTED)
    spark = documents.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = StructType([documents.schema[c] for c in documents.columns])
    document = StructField("document", kind)
    blocks_at = shared_path(spark, "suffix-blocks")
    blocks = stored(_blocks(documents, text, length, buckets, document), "suffix-blocks", blocks_at)
    counted = blocks.filter("bucket IS NOT NULL").select("block", "bucket", "values", "counts")
    again = counted.groupBy("bucket").applyInArrow(_repeated(CROWDED), "block string, bucket int, bits binary, crowded binary")
    asked = StructType([
        StructField("block", StringType()), StructField("bucket", IntegerType()), document,
        *[StructField(n, BinaryType()) for n in ("candidates", "many", "places", "strings", "twice")], *_ASKED,
    ])
    rows = blocks.filter("bucket IS NULL").select("block", "documents").groupBy("block").cogroup(again.groupBy("block"))
    pieces = stored(rows.applyInArrow(_ask(length, buckets, documents.columns.index(text), asked), asked), "suffix-pieces")
    delete(spark, blocks_at)  # ``pieces`` holds the documents from here on
    answer = "block string, bucket int, sizes binary, bits binary, strings int"
    answers = pieces.filter("values IS NOT NULL").select("block", "bucket", *[f.name for f in _ASKED]).groupBy("bucket").applyInArrow(_judge(length), answer)
    strings = pieces.filter("strings IS NOT NULL").select("block", "bucket", "strings", "twice").groupBy("bucket").applyInArrow(_strings_again, answer)
    result = StructType([
        StructField(text, BinaryType()), *[f for f in kind.fields if f.name != text], *[StructField(n, LongType()) for n in _COUNTED],
    ])
    mine = pieces.filter("bucket IS NULL").select("block", "document", "candidates", "many", "places").groupBy("block")
    return mine.cogroup(answers.union(strings).groupBy("block")).applyInArrow(_remove(length, result), result).select(*documents.columns, *_COUNTED)
