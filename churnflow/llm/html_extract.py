"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

Each block is article or not. Features are the tags and names (class, id, role) of the elements around it,
and the shape of its text: length, links, punctuation. The chain has a weight for each pair of neighbours'
labels. Weights are fitted on ``TRAINING_PAGES`` labelled pages, laid out at random by ``page_samples``; the
best labels of a page are found by Viterbi. The corpus itself has no labelled pages. Names that no labelled page has
tell nothing and are not looked at.

The text of a page is that of its article blocks in page order, one a line; nothing is cut or capped. Null
and empty pages, and pages without article, have an empty text. Rows are handled one by one, so repeated
rows repeat their results, and an empty table gives an empty one. Other columns pass through; one with the
name of a result column is replaced. A page of any length, or with any number of elements inside each other, takes time in proportion
to its length, and memory for a few times its text.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from churnflow.llm.html_blocks import Block, blocks
from churnflow.llm.page_samples import NAMES, Page
from churnflow.llm.textmap import with_text_columns

TRAINING_PAGES = 900
_STEPS = 800
_DECAY = 0.005
_ENDS = ".!?:\"'…”’»)。！？：」』؟۔।॥።"
_COMMAS = re.compile("[,،、，;；]")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _words(text: str) -> int:
    """Words, or half the characters of scripts that put no spaces between them."""
    return max(text.count(" ") + 1, 0 if text.isascii() else len(_UNSPACED.findall(text)) // 2)


def text_features(block: Block) -> list[str]:
    words = _words(block.text)
    size = len(block.text)
    return [
        f"words:{min(6, int(np.log2(words)))}" if words < 128 else "words:7",
        f"links:{int(4 * min(1.0, block.linked / size))}",
        f"ends:{block.text[-1] in _ENDS}",
        f"commas:{min(2, len(_COMMAS.findall(block.text)))}",
        f"mark:{block.text[0] in '©|»'}",
    ]


def features(found: list[Block]) -> list[list[str]]:
    """Features of each block; the innermost block tag counts once more as such."""
    out = []
    for block in found:
        inner = next((f for f in reversed(block.path) if f.startswith("tag:")), "tag:")
        out.append([*block.path, f"in:{inner}", *text_features(block)])
    return out


class Model:
    """Weights of features for the article label, and of pairs of neighbouring labels."""

    def __init__(self, weights: dict[str, float], pairs: np.ndarray) -> None:
        self.weights, self.pairs = weights, pairs

    def labels(self, found: list[Block]) -> list[bool]:
        """The most probable labels, by Viterbi."""
        if not found:
            return []
        weights, known = self.weights, {}
        (stay_out, enter), (leave, stay_in) = self.pairs.tolist()
        best_out = best_in = 0.0
        back: list[tuple[bool, bool]] = []
        for i, block in enumerate(found):
            if block.path not in known:
                inner = next((f for f in reversed(block.path) if f.startswith("tag:")), "tag:")
                known[block.path] = sum(weights.get(f, 0.0) for f in (*block.path, f"in:{inner}"))
            score = known[block.path] + weights["bias"] + sum(weights.get(f, 0.0) for f in text_features(block))
            if i:
                out_in, in_in = best_out + enter, best_in + stay_in
                out_out, in_out = best_out + stay_out, best_in + leave
                back.append((in_out > out_out, in_in > out_in))
                best_out, best_in = max(out_out, in_out), max(out_in, in_in) + score
            else:
                best_in = score
        label = best_in > best_out
        labels = [label]
        for from_in_if_out, from_in_if_in in reversed(back):
            label = from_in_if_in if label else from_in_if_out
            labels.append(label)
        return labels[::-1]


def fit(pages: list[tuple[list[Block], list[bool]]], steps: int = _STEPS, decay: float = _DECAY) -> Model:
    """Maximum likelihood with a quadratic penalty, by gradient steps with momentum and own scales (Adam)."""
    pages = [(features(found), labels) for found, labels in pages if found]
    names = {f: i for i, f in enumerate(sorted({f for page, _ in pages for block in page for f in block}))}
    longest = max(len(p) for p, _ in pages)
    shape = (len(pages), longest)
    mask, gold = np.zeros(shape, bool), np.zeros(shape, np.int64)
    where, which = [], []
    for i, (page, labels) in enumerate(pages):
        mask[i, : len(page)], gold[i, : len(page)] = True, labels
        for j, block in enumerate(page):
            where += [i * longest + j] * len(set(block))
            which += [names[f] for f in set(block)]
    where, which = np.array(where), np.array(which)
    value = np.zeros(len(names) + 5)  # feature weights, bias, then pairs of labels
    first, second = np.zeros_like(value), np.zeros_like(value)
    pair_gold = np.zeros((2, 2))
    both = mask[:, 1:]
    np.add.at(pair_gold, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    for step in range(1, steps + 1):
        pairs = value[-4:].reshape(2, 2)
        score = np.bincount(where, value[which], mask.size).reshape(shape) + value[-5]
        local = np.stack([np.zeros(shape), score], axis=2)
        ahead = np.zeros((*shape, 2))
        ahead[:, 0] = local[:, 0]
        for j in range(1, longest):
            moved = np.logaddexp(ahead[:, j - 1, :1] + pairs[0], ahead[:, j - 1, 1:] + pairs[1]) + local[:, j]
            ahead[:, j] = np.where(mask[:, j, None], moved, ahead[:, j - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        behind = np.zeros((*shape, 2))
        for j in range(longest - 2, -1, -1):
            later = local[:, j + 1] + behind[:, j + 1]
            moved = np.logaddexp(pairs[:, 0] + later[:, :1], pairs[:, 1] + later[:, 1:])
            behind[:, j] = np.where(mask[:, j + 1, None], moved, 0)
        chance = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]) * mask
        joint = np.exp(ahead[:, :-1, :, None] + pairs + (local + behind)[:, 1:, None, :] - total[:, None, None, None])
        excess = (gold * mask - chance).reshape(-1)
        slope = np.concatenate([
            np.bincount(which, excess[where], len(names)), [excess.sum()], (pair_gold - joint[both].sum(axis=0)).reshape(-1),
        ]) / len(pages) - decay * value / len(pages) * 10
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        value += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = {f: float(value[i]) for f, i in names.items()}
    return Model({**weights, "bias": float(value[-5])}, value[-4:].reshape(2, 2))


def sample(seeds: range) -> list[tuple[list[Block], list[bool]]]:
    pages = [Page(seed) for seed in seeds]
    found = [(blocks(page.html, NAMES), page.labels) for page in pages]
    for have, labels in found:
        if len(have) != len(labels):
            raise ValueError("a labelled page has other blocks than labels")
    return found


@functools.cache
def trained(pages: int = TRAINING_PAGES) -> Model:
    return fit(sample(range(pages)))


def main_text(html: str, model: Model) -> str:
    found = blocks(html, NAMES)
    return "\n".join(block.text for block, article in zip(found, model.labels(found), strict=True) if article)


def extract(pages: DataFrame, html: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points."""
    # A weight a feature of the labelled pages, which bounds what is sent to the tasks.
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())

    def factory():
        model = shared.value

        def work(values: list[str]) -> list[list]:
            texts = [main_text(v, model) for v in values]
            return [texts, [len(t) for t in texts]]

        return work

    return with_text_columns(pages, html, StructType([StructField("text", StringType()), StructField("n_chars", LongType())]), factory)
