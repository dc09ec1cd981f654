"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z in lower case. A window is
ten consecutive words of one item; an item of fewer words, but not none, is one window. A document
word inside any occurrence of a window is hit. Documents stream through the automaton word by word; it
keeps the longest match that ends at the current word.

The automaton of at most about ``SHARD_WORDS`` item words is sent to the tasks. More items make more
automata, and the documents then pass each of them in turn, without a shuffle; what one has found is written before
the next is sent, so a task holds one automaton. Items of more
than ``PIECE_WORDS`` words are cut into pieces that overlap by nine words, which loses no window.

Null and empty texts have no words and nothing is hit. Items without words match nothing. Repeated items
with one id count once; items with a null id hit words but have no id to report. Repeated documents get
equal results. An empty item table leaves all documents clean. Other document columns pass through; one
with the name of a result column is replaced. Texts are read whole, one at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from churnflow.llm.columns import delete, require, shared_path, stored
from churnflow.llm.textmap import with_text_columns

WINDOW = 10
PIECE_WORDS = 50_000
SHARD_WORDS = 400_000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_NORMAL = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of every window.

    ``steps[s]`` maps a word number to the next state, ``link[s]`` is the state of the longest suffix that
    is not in the class of ``s``, ``length[s]`` the longest string of ``s``.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.words: dict[bytes, int] = {}
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [(item, [self.words.setdefault(w, len(self.words)) for w in words]) for item, words in items if words]
        for _, sequence in numbered:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        #: State of a window -> length of the window -> ids of the items that have it.
        self.ends: list[dict[int, set[str]]] = [{} for _ in self.steps]
        self.shortest = min((min(len(s), window) for _, s in numbered), default=window)
        for item, sequence in numbered:
            size, state, length = min(window, len(sequence)), 0, 0
            for word in sequence:
                state, length = self._step(state, length, word)
                if length >= size:
                    while self.length[self.link[state]] >= size:
                        state = self.link[state]
                    length = size
                    self.ends[state].setdefault(size, set()).update([item] if item is not None else [])
        #: The nearest state at or above a state, by suffix links, where a window ends.
        self.nearest = [-1] * len(self.steps)
        for state in sorted(range(1, len(self.steps)), key=self.length.__getitem__):
            self.nearest[state] = state if self.ends[state] else self.nearest[self.link[state]] if self.link[state] > 0 else -1

    def _extend(self, last: int, word: int) -> int:
        steps, link, length = self.steps, self.link, self.length
        if word in steps[last]:  # an earlier item has this string already
            there = steps[last][word]
            return there if length[there] == length[last] + 1 else self._split(last, word, there)
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and word not in steps[state]:
            steps[state][word] = new
            state = link[state]
        if state >= 0:
            there = steps[state][word]
            link[new] = there if length[there] == length[state] + 1 else self._split(state, word, there)
        return new

    def _split(self, state: int, word: int, there: int) -> int:
        copy = len(self.steps)
        self.steps.append(dict(self.steps[there]))
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[there])
        self.link[there] = copy
        while state >= 0 and self.steps[state].get(word) == there:
            self.steps[state][word] = copy
            state = self.link[state]
        return copy

    def _step(self, state: int, length: int, word: int) -> tuple[int, int]:
        steps = self.steps
        while state and word not in steps[state]:
            state = self.link[state]
            length = self.length[state]
        return (steps[state][word], length + 1) if word in steps[state] else (0, 0)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Runs [start, end) of hit words, in order and apart, and the ids of the items found."""
        found: set[str] = set()
        spans: list[list[int]] = []
        known = np.fromiter((w in self.words for w in words), bool, len(words)) if self.words else np.zeros(len(words), bool)
        # Only a run of known words as long as the shortest window can hold one.
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False]))))
        for begin, end in edges.reshape(-1, 2)[np.diff(edges.reshape(-1, 2), axis=1)[:, 0] >= self.shortest].tolist():
            state = length = 0
            for at in range(begin, end):
                state, length = self._step(state, length, self.words[words[at]])
                above = self.nearest[state]
                reach = 0
                while above > 0:
                    for size, items in self.ends[above].items():
                        if size <= length:
                            reach = max(reach, size)
                            found |= items
                    above = self.nearest[self.link[above]]
                if reach:
                    if spans and spans[-1][1] >= at + 1 - reach:
                        spans[-1][0], spans[-1][1] = min(spans[-1][0], at + 1 - reach), at + 1
                        while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                            low, _ = spans.pop(-2)
                            spans[-1][0] = min(low, spans[-1][0])
                    else:
                        spans.append([at + 1 - reach, at + 1])
        return np.array(spans, np.int64).reshape(-1, 2), found


_SPANS = ArrayType(StructType([StructField("start", IntegerType(), False), StructField("end", IntegerType(), False)]), False)
_FOUND = StructType([
    StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("spans", _SPANS), StructField("items", ArrayType(StringType(), False)),
])


def _pieces(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Item words in pieces of bounded size that overlap by a window less one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(value or "")
                for start in range(0, max(1, len(words) - WINDOW + 1), PIECE_WORDS - WINDOW + 1):
                    part = words[start : start + PIECE_WORDS]
                    if part:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([item], pa.string()), pa.array([b" ".join(part)], pa.binary()), pa.array([len(part)], pa.int64())],
                            names=["item", "words", "n"],
                        )

    return items.select(F.col(f"`{item_id}`").cast("string"), F.col(f"`{text}`")).mapInArrow(run, "item string, words binary, n long")


def automata(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Automaton]:
    """Automata of bounded size for all items, one at a time."""
    require(items, item_id, text)
    parts = _pieces(items, item_id, text)
    total = parts.agg(F.sum("n")).first()[0] or 0
    shards = math.ceil(total / SHARD_WORDS)
    for shard in range(shards):
        mine = parts.filter(F.pmod(F.xxhash64("item", "words"), F.lit(shards)) == shard) if shards > 1 else parts
        # Sorted, so that the automaton does not depend on the order of arrival.
        rows = sorted(((r.item, bytes(r.words).split()) for r in mine.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        yield Automaton(rows)


def find(documents: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``documents`` with ``n_words``, ``n_hit``, ``spans`` (word ranges) and ``items`` (ids as text, sorted)."""
    require(documents, text)
    spark = documents.sparkSession
    result = shared = at = None
    for automaton in automata(items, item_id, item_text):
        if result is not None:
            # Written, so that no task ever holds two automata, however many items there are.
            done, at = at, shared_path(spark, "decontaminated")
            result = stored(result, "", at)
            shared.unpersist()
            if done:
                delete(spark, done)
        shared = spark.sparkContext.broadcast(automaton)

        def factory(shared=shared):
            automaton = shared.value

            def work(texts: list[str]) -> list[list]:
                n_words, n_hit, spans, found = [], [], [], []
                for value in texts:
                    words = words_of(value)
                    runs, names = automaton.scan(words)
                    n_words.append(len(words))
                    n_hit.append(int((runs[:, 1] - runs[:, 0]).sum()))
                    spans.append([{"start": a, "end": b} for a, b in runs.tolist()])
                    found.append(sorted(names))
                return [n_words, n_hit, spans, found]

            return work

        if result is None:
            result = with_text_columns(documents, text, _FOUND, factory)
        else:
            before = ("spans before", "items before")
            result = result.withColumnsRenamed(dict(zip(("spans", "items"), before)))
            result = _merged(with_text_columns(result, text, _FOUND, factory), *before)
    if result is None:  # no item has a word
        nothing = Automaton([])
        return with_text_columns(documents, text, _FOUND, lambda: lambda texts: _nothing(nothing, texts))
    return result


def _nothing(automaton: Automaton, texts: list[str]) -> list[list]:
    return [[len(words_of(t)) for t in texts], [0] * len(texts), [[]] * len(texts), [[]] * len(texts)]


def _merged(found: DataFrame, spans: str, items: str) -> DataFrame:
    """Joins the runs of two automata in one row: sorted by start, then united where they touch."""
    united = F.expr(f"""
        aggregate(array_sort(concat(`{spans}`, spans)), cast(array() as array<struct<start: int, end: int>>), (done, s) ->
          if(size(done) > 0 and element_at(done, -1).end >= s.start,
             concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))),
             concat(done, array(s))))""")
    found = found.withColumn("spans", united).withColumn("items", F.expr(f"array_sort(array_union(`{items}`, items))"))
    return found.withColumn("n_hit", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)")).drop(spans, items)


def report(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: words, hit words, items found with a digest of their ids, and the verdict."""
    found = find(documents.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), items, text)
    return found.select(
        F.col(f"`{doc_id}`"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(text: str, spans: list[dict]) -> str:
    data = text.encode("utf-8", "surrogatepass")
    places = [(m.start(), m.end()) for m in _WORD.finditer(data)]
    kept, at = [], 0
    for span in spans:
        kept.append(data[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def clean(
    documents: DataFrame, items: DataFrame, text: str = "text", *, shortest: int = 1, max_coverage: float = 0.5
) -> DataFrame:
    """``documents`` without item text: runs of at least ``shortest`` hit words are cut out of the text,
    and a document with more than ``max_coverage`` of its words hit is dropped as a whole."""
    columns = documents.columns
    others = F.struct(*[F.col(f"`{c}`") for c in columns if c != text]) if len(columns) > 1 else F.lit(None).cast("string")
    found = find(documents.select(others.alias("others"), F.col(f"`{text}`").alias("text")), items, "text")
    found = found.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))
    found = found.select("others", "text", F.filter("spans", lambda s: s.end - s.start >= shortest).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, texts, spans = batch.columns
            if pa.compute.any(pa.compute.greater(pa.compute.list_value_length(spans), 0)).as_py():
                pairs = zip(texts.to_pylist(), spans.to_pylist(), strict=True)
                texts = pa.array([_cut(t, s) if s else t for t, s in pairs], texts.type)
            yield pa.RecordBatch.from_arrays([rest, texts], names=["others", "text"])

    cut = found.mapInArrow(run, found.drop("spans").schema)
    return cut.select(*[F.col("text" if c == text else f"others.`{c}`").alias(c) for c in columns])
