"""Arrow batches of texts through a Python function, other columns passing through untouched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from churnflow.llm.columns import require

# Rows are handed on in pieces of about so many bytes of text, so a piece is a few long texts or many short ones.
PIECE_BYTES = 4 << 20

_TEXT = "input text of the map"


def pieces(batch: pa.RecordBatch, texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of ``texts`` each; a longer text is alone."""
    if not len(batch):
        return
    if texts.nbytes <= limit:
        yield batch
        return
    start, size = 0, 0
    for i, n in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)


def release() -> None:
    """Give back what Arrow keeps of freed memory, since a worker process outlives its task."""
    pa.default_memory_pool().release_unused()


def with_text_columns(
    df: DataFrame, text: str, added: StructType, factory: Callable[[], Callable[[list[str]], list[list]]]
) -> DataFrame:
    """``df`` with the columns ``added``, computed from its texts (null: empty).

    ``factory`` runs once a task and returns a function from the texts of a piece to one list of
    values per added column. A column of ``df`` with the name of an added one is replaced.
    """
    require(df, text)
    kept = [c for c in df.columns if c not in added.names]
    schema = StructType([df.schema[c] for c in kept] + added.fields)
    types = [to_arrow_type(f.dataType) for f in added.fields]

    reads = kept.index(text) if text in kept else len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for whole in batches:
            for batch in pieces(whole, whole.column(reads)):
                values = work([t or "" for t in batch.column(reads).to_pylist()])
                arrays = [pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(batch.columns[: len(kept)] + arrays, names=schema.names)
        release()

    extra = [] if text in kept else [F.col(f"`{text}`").alias(_TEXT)]
    return df.select(*[F.col(f"`{c}`") for c in kept], *extra).mapInArrow(run, schema)
