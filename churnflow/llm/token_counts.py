"""Word-piece token counts by a linear longest-match automaton, without building the pieces.

The vocabulary's trie has a failure link per node: where matching goes on once the longest pieces so far are
taken, and how many pieces are popped on the way. A word is read once, character by character, and the
popped counts add up to the number of pieces that greedy longest-match-first splitting gives. A word that
cannot be split as a whole counts as one unknown token.

Words are runs of characters other than space and the controls 9 to 13. Null and empty texts count zero.
Texts are read whole; rows are counted one by one, so repeated rows get equal counts and an empty table
gives an empty result. Other columns pass through; one with the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from churnflow.llm.textmap import with_text_columns

REMEMBERED = 200_000  # distinct words a task keeps counts of; the rest are counted again

_COUNTS = StructType([StructField(n, LongType()) for n in ("n_words", "n_tokens", "n_unknown", "n_bytes")])


class Automaton:
    """``initial`` pieces start a word, ``inner`` ones go on inside it."""

    def __init__(self, initial: Iterable[str], inner: Iterable[str]) -> None:
        #: Node 0 is the start of a word, node 1 the place after a piece.
        self.next: list[dict[str, int]] = [{}, {}]
        self.final: list[bool] = [False, False]
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                node = root
                for char in piece:
                    if char not in self.next[node]:
                        self.next[node][char] = len(self.next)
                        self.next.append({})
                        self.final.append(False)
                    node = self.next[node][char]
                if node > 1:
                    self.final[node] = True
        self._link()

    def _link(self) -> None:
        """Failure links and popped counts, breadth first: those of a node need those of shorter strings."""
        self.fail: list[int] = [-1] * len(self.next)
        self.popped: list[int] = [0] * len(self.next)
        level = [0, 1]
        while level:
            below = []
            for parent in level:
                for char, node in self.next[parent].items():
                    below.append(node)
                    if self.final[node]:
                        self.fail[node], self.popped[node] = 1, 1
                        continue
                    at, count = self.fail[parent], self.popped[parent]
                    while at >= 0 and char not in self.next[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.next[at][char], count
            level = below

    def count(self, word: str) -> int:
        """Number of pieces of ``word``; -1 if it has no full split."""
        following, fail, popped = self.next, self.fail, self.popped
        node = count = 0
        for char in word:
            while char not in following[node]:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = following[node][char]
        while node != 1:
            count += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return count


def vocabulary(model: bytes) -> tuple[list[str], list[str]]:
    """Initial and inner pieces of a sentencepiece model: those with and without the word mark.

    Control, unknown, byte and unused pieces are no text and are left out.
    """
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_proto=model)
    initial, inner = [], []
    for i in range(processor.get_piece_size()):
        if processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i):
            continue
        piece = processor.id_to_piece(i)
        if piece.startswith("▁"):
            initial.append(piece[1:])
        else:
            inner.append(piece)
    return [p for p in initial if p], inner


def count(documents: DataFrame, initial: list[str], inner: list[str], text: str = "text") -> DataFrame:
    """``documents`` with ``n_words``, ``n_tokens`` (an unknown word is one), ``n_unknown`` and ``n_bytes``.

    The vocabulary bounds the automaton that is sent to the tasks.
    """
    shared = documents.sparkSession.sparkContext.broadcast((initial, inner))

    def factory():
        automaton = Automaton(*shared.value)
        remembered: dict[bytes, int] = {}

        def work(texts: list[str]) -> list[list[int]]:
            n_words, n_tokens, n_unknown, n_bytes = [], [], [], []
            for value in texts:
                data = value.encode("utf-8")
                words = data.split()
                for word in set(words).difference(remembered):
                    remembered[word] = automaton.count(word.decode("utf-8"))
                counts = np.fromiter(map(remembered.__getitem__, words), np.int64, len(words))
                n_words.append(len(words))
                n_tokens.append(int(np.abs(counts).sum()))
                n_unknown.append(int((counts < 0).sum()))
                n_bytes.append(len(data))
                if len(remembered) > REMEMBERED:
                    remembered.clear()
            return [n_words, n_tokens, n_unknown, n_bytes]

        return work

    return with_text_columns(documents, text, _COUNTS, factory)
