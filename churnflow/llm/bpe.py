"""Byte-pair encoding through a table of distinct words, and decoding through a table of pieces.

1. Tasks cut texts at ASCII white space into words and collect blocks of about ``BLOCK_BYTES`` of text. A
   block has its distinct words once, dealt into buckets by hash, and its documents as word numbers.
2. A bucket holds a share of all distinct words. Its task encodes each distinct word once and answers
   every block with the ids of that block's words.
3. Blocks and answers meet, and word numbers become ids by position.

This needs a tokenizer whose words never reach across white space and which makes no ids of it, as
``word_bpe_49k.json``; the file and its normaliser, splitter and added tokens do the encoding, so results
are those of encoding the whole text (``add_special_tokens=False``).

The step between 1 and 2 is written to the shared folder, so both readers see the same numbering. A third
of all rows in one source, or one hot word, makes no hot task: blocks are equal in size, and a word occurs
once a block at most. Memory of a task: a block while it is made, the distinct words of one bucket, or the
distinct words of a block with one piece of its documents.

Null and empty texts, and texts of white space, have no ids. Rows are encoded one by one: repeated rows
give repeated results, an empty table an empty one. Other columns pass through; one with the name of the
result column is replaced by it.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from churnflow.llm.columns import require, stored
from churnflow.llm.textmap import pieces, release

BLOCK_BYTES = 32 << 20
ID = np.dtype("<u4")


_LINE = 256
_PLAIN = re.compile(rb"(?:[\x21-\x7e]|\xc3[\x80-\xbf])+")


class WordEncoder:
    """Ids of words by a tokenizer given as the text of its file."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()

    def __call__(self, words: list[bytes]) -> list[bytes]:
        """Little-endian ids of each word.

        Words of ASCII and Latin-1 letters, which normalising leaves as many characters, go in lines of ``_LINE`` words, which takes half the time:
        an id belongs to the word in which it starts. Others go one by one.
        """
        plain = [i for i, w in enumerate(words) if _PLAIN.fullmatch(w)]
        out: list[bytes] = [b""] * len(words)
        lines = [plain[i : i + _LINE] for i in range(0, len(plain), _LINE)]
        texts = [b"\n".join([words[i] for i in line]).decode("utf-8") for line in lines]
        for line, text, found in zip(lines, texts, self._tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            begins = np.cumsum([0, *map(len, text.split("\n"))]) + np.arange(len(line) + 1)
            places = np.fromiter([a for a, _ in found.offsets], np.int64, len(found))
            ends = np.searchsorted(places, begins[1:]).tolist()
            data, at = array("I", found.ids).tobytes(), 0
            for i, end in zip(line, ends, strict=True):
                out[i] = data[at * ID.itemsize : end * ID.itemsize]
                at = end
        others = sorted(set(range(len(words))).difference(plain)) if len(plain) < len(words) else []
        alone = self._tokenizer.encode_batch_fast([words[i].decode("utf-8") for i in others], add_special_tokens=False)
        for i, found in zip(others, alone, strict=True):
            out[i] = array("I", found.ids).tobytes()
        return out

    def pieces(self) -> list[str | None]:
        size = max(self._tokenizer.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        return [self._tokenizer.id_to_token(i) for i in range(size)]


@lru_cache(2)
def _encoder(tokenizer: str) -> WordEncoder:
    """One a worker process, which many tasks share one after the other: reading the file takes longer than some tasks."""
    return WordEncoder(tokenizer)


# Word numbers of a block go by classes of frequency, so that frequent words have small numbers.
_CLASSES = 4 ** np.arange(2, 11)
_FIELDS = ["block", "bucket", "classes", "words", "documents", "lengths", "numbers"]


def _squeeze(data: bytes, level: int = 6) -> bytes:
    """Compressed, with the length before it."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def _level(compact: bool) -> int:
    return 6 if compact else 1


def _expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _pack(numbers: np.ndarray, level: int = 6) -> bytes:
    """32-bit numbers as four planes of bytes, compressed: the high ones are nearly all zero."""
    return _squeeze(np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), level)


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_expand(data), np.uint8).reshape(4, -1).T).view("<i4").reshape(-1)


class _Block:
    """Documents as numbers of words, and the words."""

    def __init__(self, compact: bool) -> None:
        self.compact, self.level = compact, _level(compact)
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        self.size = 0
        self.digest = 0

    def add(self, documents: pa.Array, texts: pa.Array) -> None:
        number, coded, lengths = self.numbers.__getitem__, [], []
        for value in texts:
            text = value.as_py() or b""
            self.size += len(text)
            self.digest = zlib.crc32(text, zlib.crc32(len(text).to_bytes(8, "little"), self.digest))
            words = text.split()
            coded.append(np.fromiter(map(number, words), np.int32, len(words)))
            lengths.append(len(words))
        self.parts.append((documents, np.array(lengths, np.int32), np.concatenate([np.zeros(0, np.int32), *coded])))

    def rows(self, name: str, buckets: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        words = list(self.numbers)
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
        often = sum((np.bincount(c, minlength=len(words)) for _, _, c in self.parts), np.zeros(len(words), np.int64))
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(-often, kind="stable")] = np.arange(len(words))
        group = np.searchsorted(_CLASSES, rank, "right")
        # Words are numbered by class, then bucket; a bucket lists its words by class. Among these, alphabetic
        # order makes both words and their ids take least room.
        spelling = np.arange(len(words))
        if self.compact:
            spelling[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        place = np.empty(len(words), np.int32)
        place[np.lexsort((spelling, bucket, group))] = np.arange(len(words), dtype=np.int32)
        listed = np.lexsort((spelling, group, bucket))
        for documents, lengths, coded in self.parts:
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents).cast(kind),
                pa.array([lengths.tobytes()], pa.binary()), pa.array([_pack(place[coded], self.level)], pa.binary()),
            ], names=_FIELDS)
        found, first = np.unique(bucket[listed], return_index=True)
        bounds = [*first.tolist(), len(words)]
        classes, packed = [], []
        for low, high in zip(bounds, bounds[1:]):
            mine = listed[low:high]
            classes.append(np.bincount(group[mine], minlength=len(_CLASSES) + 1).astype("<i4").tobytes())
            packed.append(_squeeze(b"\n".join([words[i] for i in mine.tolist()]), self.level))
        n = len(packed)
        yield pa.RecordBatch.from_arrays([
            pa.array([name] * n, pa.string()), pa.array(found, pa.int32()), pa.array(classes, pa.binary()), pa.array(packed, pa.binary()),
            pa.nulls(n, kind), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
        ], names=_FIELDS)


def _blocks(documents: DataFrame, text: str, kept: list[str], buckets: int, compact: bool) -> DataFrame:
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    source = documents.select(whole.alias("document"), F.col(f"`{text}`").cast("binary").alias("text"))
    schema = StructType([
        StructField("block", StringType()), StructField("bucket", IntegerType()),
        StructField("classes", BinaryType()), StructField("words", BinaryType()),
        StructField("documents", ArrayType(source.schema["document"].dataType)),
        StructField("lengths", BinaryType()), StructField("numbers", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, made, block = TaskContext.get().partitionId(), 0, _Block(compact)
        kind = to_arrow_type(schema["documents"].dataType)
        for whole in batches:
            for batch in pieces(whole, whole.column(1)):
                block.add(batch.column(0), batch.column(1))
                if block.size >= BLOCK_BYTES:
                    yield from block.rows(f"{partition}-{made}-{block.digest:08x}", buckets, kind)
                    made, block = made + 1, _Block(compact)
        if block.parts:
            yield from block.rows(f"{partition}-{made}-{block.digest:08x}", buckets, kind)
        del block
        release()

    return source.mapInArrow(run, schema)


def encode(
    documents: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", *, blocks_at: str | None = None, compact: bool = True
) -> DataFrame:
    """``documents`` without ``text`` and with ``ids``: little-endian unsigned 32-bit ids as binary.

    ``tokenizer`` is the content of a tokenizer file. ``blocks_at`` names the folder of the blocks, for a caller
    that stores the result and deletes them. Blocks that are not ``compact`` take less time and more room.
    """
    require(documents, text)
    spark = documents.sparkSession
    kept = [c for c in documents.columns if c not in (text, ids)]
    blocks = stored(_blocks(documents, text, kept, int(spark.conf.get("spark.sql.shuffle.partitions")), compact), "bpe-blocks", blocks_at)
    shared = spark.sparkContext.broadcast(tokenizer)
    level = _level(compact)

    def encode_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known, current = _encoder(shared.value), {}, None
        for batch in batches:
            for block, bucket, classes, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    known, current = {}, bucket
                words = _expand(packed).split(b"\n")
                if new := [w for w in words if w not in known]:
                    known.update(zip(new, encoder(new), strict=True))
                values = [known[w] for w in words]
                counts = np.fromiter(map(len, values), np.int32, len(values)) // ID.itemsize
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([bucket], pa.int32()), pa.array([classes], pa.binary()),
                    pa.array([_pack(counts, level)], pa.binary()), pa.array([_pack(np.frombuffer(b"".join(values), "<i4"), level)], pa.binary()),
                ], names=["block", "bucket", "classes", "counts", "ids"])

    words = blocks.filter("bucket IS NOT NULL").select("block", "bucket", "classes", "words")
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    answers = words.mapInArrow(encode_bucket, "block string, bucket int, classes binary, counts binary, ids binary")

    document = blocks.schema["documents"].dataType.elementType
    schema = StructType([StructField("document", document), StructField("ids", BinaryType())])

    def put_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The answers to a block come before its documents, which then pass piece by piece."""
        current, answers, counts, table, first = None, [], None, None, None
        for batch in batches:
            for i, (block, bucket) in enumerate(zip(batch.column("block").to_pylist(), batch.column("bucket").to_pylist(), strict=True)):
                if block != current:
                    current, answers, counts = block, [], None
                if bucket is not None:
                    answers.append(tuple(batch.column(c)[i].as_py() for c in ("classes", "counts", "ids")))
                    continue
                if counts is None:
                    counts, table = _by_number(answers)
                    first = np.cumsum(counts, dtype=np.int64) - counts
                    answers = []
                every = _unpack(batch.column("numbers")[i].as_py())
                n = counts[every]
                ends = np.cumsum(n, dtype=np.int64)
                total = int(ends[-1]) if len(ends) else 0
                data = table[np.repeat(first[every] - ends + n, n) + np.arange(total)].tobytes()
                words = np.cumsum(np.frombuffer(batch.column("lengths")[i].as_py(), np.int32), dtype=np.int64)
                places = (np.concatenate(([0], ends))[np.concatenate(([0], words))] * ID.itemsize).tolist()
                documents = batch.column("documents").slice(i, 1).flatten()
                out = pa.array([data[a:b] for a, b in zip(places, places[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([documents, out], names=schema.names)
        release()

    rows = blocks.filter("bucket IS NULL").select("block", "bucket", "documents", "lengths", "numbers")
    both = answers.unionByName(rows, allowMissingColumns=True)
    result = both.repartition("block").sortWithinPartitions("block", F.col("bucket").asc_nulls_last()).mapInArrow(put_back, schema)
    return result.select(*[F.col(f"document.`{c}`").alias(c) for c in kept], F.col("ids").alias(ids))


def _by_number(answers: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids of a block's words, and all their ids, in the order of the words' numbers."""
    counts = [[np.zeros(0, np.int32)] for _ in range(len(_CLASSES) + 1)]
    ids = [[np.zeros(0, np.int32)] for _ in range(len(_CLASSES) + 1)]
    for classes, packed_counts, packed_ids in answers:
        own_counts, own_ids = _unpack(packed_counts), _unpack(packed_ids)
        ends = np.concatenate([[0], np.cumsum(own_counts)])
        low = 0
        for group, size in enumerate(np.frombuffer(classes, "<i4").tolist()):
            counts[group].append(own_counts[low : low + size])
            ids[group].append(own_ids[ends[low] : ends[low + size]])
            low += size
    return np.concatenate(sum(counts, [])), np.concatenate(sum(ids, [])).astype(ID)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with ``text``, the decoded ids (special tokens kept); null ids decode to an empty text.

    The id-to-piece table has one row per id of the vocabulary, which bounds what is sent to the tasks;
    ids meet it by position. A tokenizer without a decoder puts one space between pieces. Ids that are
    not in the table are left out, as the library does.
    """
    require(encoded, ids)
    table = [p if p is None else p.encode() for p in WordEncoder(tokenizer).pieces()]
    shared = encoded.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in encoded.columns if c != text]
    schema = StructType([encoded.schema[c] for c in kept] + [StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        whole = None not in table
        at = kept.index(ids)
        for batch in batches:
            for part in pieces(batch, batch.column(at)):
                out = []
                for value in part.column(at):
                    numbers = np.frombuffer(value.as_py() or b"", ID)
                    if not whole or (numbers.size and numbers.max() >= len(table)):
                        numbers = [i for i in numbers.tolist() if i < len(table) and table[i] is not None]
                    else:
                        numbers = numbers.tolist()
                    out.append(b" ".join([table[i] for i in numbers]))
                decoded = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=schema.names)
        release()

    return encoded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
