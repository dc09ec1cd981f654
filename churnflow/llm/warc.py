"""WARC records in ZIP packages: written from pages, read back by ranges without extraction.

A package has, as stored members, ``archive/data.warc.gz`` with one gzip member a record, and
``indexes/index.cdxj`` with a line a record: where it lies, and what it is. Reading parses the central
directory (ZIP64 too), finds both members, and reads each record's range.

Payload: the page's HTML in UTF-8 (null: empty). Of records with equal payloads of at least
``REVISIT_BYTES`` bytes, those with the smallest page id are responses and the others revisit it; all
smaller ones are responses. Repeated rows with one page id and payload get the same kind. A row with a
null page id is a response and is not referred to. A null URL has no header and is read as null; line
breaks in a URL are percent-encoded. No pages make no packages and no records.

Only narrow rows (id, digest) are grouped, with partial minima, so a payload that a third of all pages
share is no hot group; the join that follows splits. Tasks hold one record and the index of one package,
which is bounded by ``PACKAGE_RECORDS``; reading tasks are as many as ``TASK_BYTES`` go into the records. Payloads of any length
pass whole, each within the memory of one task.
"""

from __future__ import annotations

import hashlib
import json
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from churnflow.llm.columns import require, shared_path, stored
from churnflow.llm.files import RangeReader, writing
from churnflow.llm.textmap import pieces
from churnflow.llm.zip_archive import members, stored_range

REVISIT_BYTES = 100
PACKAGE_BYTES = 256 << 20
PACKAGE_RECORDS = 100_000
READ_AHEAD = 1 << 20
TASK_BYTES = 64 << 20  # of packed records that a task reads, and of a run of neighbours among them
RUN_BYTES = 4 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP headers and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])


def parse(data: bytes) -> dict:
    """The parts of one record. A response whose payload does not have its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["WARC-Payload-Digest"].removeprefix("sha256:")
    kind, size = warc["WARC-Type"], int(_fields(http)["Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{warc['WARC-Record-ID']}: the payload does not have its digest")
    page, first = (warc.get(n, "").removeprefix("<urn:page:").removesuffix(">") for n in ("WARC-Record-ID", "WARC-Refers-To"))
    return {
        "page_id": int(page) if page else None, "url": warc.get("WARC-Target-URI"), "record_type": kind,
        "payload_bytes": size, "payload_digest": digest, "refers_to": int(first) if first else None,
        "payload": payload if kind == "response" else None,
    }


class _Plain:
    """A stream without seek or tell, which makes zipfile write sizes after the data."""

    def __init__(self, out) -> None:
        self.write, self.flush = out.write, out.flush


def _member(name: str) -> zipfile.ZipInfo:
    return zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))


def write_package(path: str, records: Iterator[tuple[dict, bytes]]) -> int:
    """Write records with their index entries as one package; returns their number."""
    lines, offset = [], 0
    with writing(path) as out, zipfile.ZipFile(_Plain(out), "w", zipfile.ZIP_STORED) as package:
        with package.open(_member(_DATA), "w", force_zip64=True) as data:
            for entry, content in records:
                deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
                packed = deflate.compress(content) + deflate.flush()
                data.write(packed)
                lines.append((entry["url"] or "", json.dumps(entry | {"offset": offset, "length": len(packed), "filename": _DATA})))
                offset += len(packed)
        with package.open(_member(_INDEX), "w", force_zip64=True) as index:
            for key, line in sorted(lines):
                index.write(f"{''.join(key.split())} 19700101000000 {line}\n".encode())
    return len(lines)


def revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (page, digest, first) of the pages whose payload an earlier page has."""
    narrow = pages.select(F.col(f"`{page_id}`").alias("page"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"))
    narrow = narrow.filter(F.length("payload") >= REVISIT_BYTES).select("page", F.sha2("payload", 256).alias("digest"))
    pairs = narrow.groupBy("digest", "page").agg(F.count("*").alias("n"))
    first = narrow.groupBy("digest").agg(F.min("page").alias("first"), F.max("page").alias("last")).filter("last > first").drop("last")
    return pairs.join(first, "digest").filter("page > first").select("page", "digest", "first")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` as packages below ``folder``; returns the packages written (package, records)."""
    require(pages, page_id, url, html)
    source = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    again = revisits(pages, page_id, html)
    # A null page never has a partner here, and stays by the left join.
    source = source.join(again, ["page", "digest"], "left").select("page", "url", "payload", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, made = TaskContext.get().partitionId(), 0

        def rows() -> Iterator[tuple]:
            for whole in batches:
                for batch in pieces(whole, whole.column(2)):
                    yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        waiting = rows()
        row = next(waiting, None)
        while row is not None:
            path, size = f"{folder}/part-{partition:06d}-{made:04d}.zip", 0

            def filling() -> Iterator[tuple[dict, bytes]]:
                nonlocal row, size
                for _ in range(PACKAGE_RECORDS):
                    page, url, payload, digest, first = row
                    yield {"url": url, "mime": "text/html", "digest": f"sha256:{digest}"}, record(page, url, payload, digest, first)
                    size += len(payload)
                    row = next(waiting, None)
                    if row is None or size >= PACKAGE_BYTES:
                        return

            records = write_package(path, filling())
            made += 1
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], names=["package", "records"])

    # Stored at once: a second reading of the list must not write the packages again.
    return stored(source.mapInArrow(run, "package string, records long"), "warc-packages")


def index(packages: DataFrame) -> DataFrame:
    """One row per indexed record: package, whether it is compressed, start and length in the package file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            with RangeReader(path) as file:
                found = {m.name: m for m in members(file)}
                archives = {n: stored_range(file, m) for n, m in found.items() if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))}
                for name in (n for n in found if n.startswith("indexes/") and n.endswith(".cdxj")):
                    start, left = stored_range(file, found[name])
                    rest = b""
                    while left or rest:
                        part = min(left, 4 << 20)
                        *lines, rest = (rest + file.read(start, part)).split(b"\n") if part else [rest, b""]
                        start, left = start + part, left - part
                        out: list[list] = [[], [], []]
                        for line in filter(None, lines):
                            entry = json.loads(line.split(b" ", 2)[2])
                            first, size = archives[entry["filename"]]
                            if int(entry["offset"]) + int(entry["length"]) > size:
                                raise ValueError(f"{path}: an index entry reaches past {entry['filename']}")
                            out[0].append(entry["filename"].endswith(".gz"))
                            out[1].append(first + int(entry["offset"]))
                            out[2].append(int(entry["length"]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(out[0]), pa.string()), pa.array(out[0], pa.bool_()), *(pa.array(c, pa.int64()) for c in out[1:])],
                            names=["package", "packed", "start", "length"],
                        )

    return packages.select("package").mapInArrow(run, "package string, packed boolean, start long, length long")


_RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read(packages: DataFrame, *, payload: bool = True) -> DataFrame:
    """The records of all packages; revisits have a null payload."""
    entries = index(packages)
    # As many tasks as there are bytes to read, not as the narrow index has. Neighbouring records of a package go to one
    # task, in order, so reading ahead pays off.
    total = entries.agg(F.sum("length")).first()[0] or 0
    cores = packages.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-total // TASK_BYTES), min(cores, -(-total // RUN_BYTES)))
    entries = entries.repartition(tasks, "package", F.floor(F.col("start") / RUN_BYTES)).sortWithinPartitions("package", "start")
    schema = _RECORD + (", payload binary" if payload else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, path, low, buffer = None, None, 0, b""
        for batch in batches:
            out: list[dict] = []
            held = 0
            for package, packed, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if package != path:
                    if file:
                        file.close()
                    file, path, low, buffer = RangeReader(package), package, 0, b""
                if start < low or start + length > low + len(buffer):
                    low, buffer = start, file.read(start, min(max(length, READ_AHEAD), file.size - start))
                data = buffer[start - low : start - low + length]
                out.append(parse(zlib.decompress(data, 31) if packed else data))
                held += out[-1]["payload_bytes"]
                if held > 4 << 20:
                    yield _batch(out, names)
                    out, held = [], 0
            yield _batch(out, names)
        if file:
            file.close()

    return entries.mapInArrow(run, schema)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to packages in the shared folder and read the records back, without payloads."""
    packages = write(pages, shared_path(pages.sparkSession, "warc"))
    return read(packages, payload=False)
