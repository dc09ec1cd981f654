"""N-gram Jaccard join: a MinHash LSH forest of sorted prefix tries, then exact verification.

Words are runs of characters other than ASCII white space, in ASCII lower case; a shingle is five
consecutive words, and a text of fewer words, but not none, is one shingle. Two documents are linked if
their shingle sets have a Jaccard similarity of at least ``SIMILARITY``.

1. Documents with one shingle set are one node. A node has a signature in each of ``TREES`` trees: its least
   shingle hashes in ``DEEPEST`` orders. A tree is a prefix trie laid out flat: its signatures in order, dealt to tasks by
   ranges, where each has its longest matched prefix with the one before. Matches of all ``DEEPEST`` values are taken, and
   shorter ones down to the length at which a pair at the very bound is found with the probability ``RECALL``, and no
   further. A run of matches is joined to its first node, also across tasks, so a crowded prefix costs a row a
   member and is read by as many tasks as it fills.
2. Connected nodes may be linked; all pairs inside a candidate component are verified, not only those that met.
   Sets are compared exactly, as bit rows over the shingles that two of them share, ``STRIPE_BITS`` at a time. Components of more
   than ``BLOCK_NODES`` nodes or ``BLOCK_BYTES`` of text are compared block against block, and only sums per
   node leave a task, never pairs. This work grows with the square of the *different* texts of
   one component, as their links do; copies are one node and cost a row.
   Candidates, prefixes and texts meet in sorted shuffles at any size: their tables grow with the documents.
3. Classes are the connected components of verified links, named by their smallest document id.

A document's links are counted with copies: the other documents of its node, and all those of linked nodes.

Null and empty texts, and texts of white space, have no shingles: they have no links, and each is a class
of its own, with class id null where the document id is null. Repeated rows are documents of one node. Texts of any length
are compared whole; a task holds a block of texts, or its longest one, and bounded bit rows.
Columns other than the two named are not read. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from churnflow.llm.columns import require, stored
from churnflow.llm.components import components
from churnflow.llm.textmap import pieces, release

WORDS = 5
SIMILARITY = 0.8
TREES = 24
DEEPEST = 6
RECALL = 0.99999
BLOCK_NODES = 2048
BLOCK_BYTES = 24 << 20
STRIPE_BITS = 1 << 29  # of the bit rows of a block
_NODE = "decimal(38,0)"
_LOWER = bytes(range(256)).lower()


def recall(depth: int, similarity: float, trees: int) -> float:
    """Probability that a pair of this similarity matches in the first ``depth`` values of one of the trees."""
    return 1 - (1 - similarity**depth) ** trees


def depth_for(similarity: float, trees: int = TREES, target: float = RECALL, deepest: int = DEEPEST) -> int:
    """Matched prefixes are shortened from ``deepest`` on until the recall is reached."""
    depth = deepest
    while depth > 1 and recall(depth, similarity, trees) < target:
        depth -= 1
    return depth


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the shingles."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - WORDS + 1)
    return np.unique(np.array([xxh3_64_intdigest(b" ".join(words[i : i + WORDS])) for i in range(n)], np.uint64))


def node_of(values: np.ndarray) -> int:
    """A 126-bit name of a shingle set."""
    from xxhash import xxh3_128_intdigest

    return xxh3_128_intdigest(values.tobytes()) >> 2


def _nodes(names: list[int | None]) -> pa.Array:
    data = b"".join((n or 0).to_bytes(16, "little") for n in names)
    found = pa.Array.from_buffers(pa.decimal128(38, 0), len(names), [None, pa.py_buffer(data)])
    return pa.compute.if_else(pa.array([n is not None for n in names], pa.bool_()), found, pa.scalar(None, found.type))


class Forest:
    """The signatures of a node, one a tree: ``DEEPEST`` values of 16 bits each."""

    def __init__(self, trees: int = TREES) -> None:
        random = np.random.default_rng(7)
        self._odd = random.integers(0, 1 << 63, trees * DEEPEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._mixed = random.integers(0, 1 << 63, trees * DEEPEST, dtype=np.uint64)

    def signatures(self, values: np.ndarray) -> bytes:
        least = np.full(len(self._odd), np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(values), 512):  # stays in the cache, and bounds memory for long texts
            part = values[start : start + 512]
            mixed = (part ^ self._mixed[:, None]) * self._odd[:, None]
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            np.minimum(least, mixed.min(axis=1), out=least)
        return ((least * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(">u2").tobytes()


def mark(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per document: id, a hash of the text, its bytes, its node and its signatures (null without words)."""
    require(documents, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for whole in batches:
            for batch in pieces(whole, whole.column(2)):
                names, signatures, sizes = [], [], []
                for value in batch.column(2):
                    value = value.as_py() or ""
                    found = shingles(value)
                    names.append(node_of(found) if len(found) else None)
                    signatures.append(forest.signatures(found) if len(found) else None)
                    sizes.append(len(value) if value.isascii() else len(value.encode("utf-8")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), _nodes(names), pa.array(signatures, pa.binary())],
                    names=["doc_id", "text_hash", "size", "node", "signatures"],
                )
        release()

    source = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(run, f"doc_id long, text_hash long, size long, node {_NODE}, signatures binary")


def _matched(tree: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """Length of the prefix that each signature shares with the one before, 0 in another tree and for the first."""
    equal = np.cumprod(signature[1:] == signature[:-1], axis=1, dtype=np.int32).sum(axis=1)
    return np.concatenate(([0], np.where(tree[1:] == tree[:-1], equal, 0)))


def matches(nodes: DataFrame, shortest: int) -> DataFrame:
    """Rows (a, b, depth): node ``a`` follows node ``b``, the first of its run of prefixes of at least ``shortest`` values;
    ``depth`` is what it shares with the one just before it."""
    size = 2 * DEEPEST
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring("signatures", t * size + 1, F.lit(size)))
    entries = nodes.select("node", F.posexplode(trees).alias("tree", "signature"))
    entries = entries.repartitionByRange("tree", "signature", "node").sortWithinPartitions("tree", "signature", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs that may go on in the tasks before and after are told by the ends of the partition, as rows with ``part``."""
        from pyspark import TaskContext

        part, last, ends = TaskContext.get().partitionId(), None, []

        def rows(a, b, depth, signature=None, tree=None) -> pa.RecordBatch:
            n = len(a)
            of_end = tree is not None
            return pa.RecordBatch.from_arrays([
                a, b, pa.array(depth, pa.int32()), pa.array([part] * n if of_end else [None] * n, pa.int32()),
                pa.array(tree if of_end else [None] * n, pa.int32()), pa.array(signature if of_end else [None] * n, pa.binary()),
            ], names=["a", "b", "depth", "part", "tree", "signature"])

        for batch in batches:
            nodes, tree, signature = batch.columns
            if not len(nodes):
                continue
            if last is None:
                ends = [(nodes.slice(0, 1), tree[0].as_py(), signature[0].as_py())]
            else:  # the batch goes on from the last entry, named by the head of its run
                nodes = pa.concat_arrays([last[0], nodes])
                tree, signature = pa.concat_arrays([pa.array([last[1]], tree.type), tree]), pa.concat_arrays([pa.array([last[2]], signature.type), signature])
            values = np.frombuffer(b"".join(signature.to_pylist()), ">u2").reshape(-1, DEEPEST)
            depth = _matched(tree.to_numpy(), values)
            head = np.maximum.accumulate(np.where(depth < shortest, np.arange(len(depth)), 0))
            joined = np.flatnonzero(depth >= shortest)
            yield rows(nodes.take(pa.array(joined)), nodes.take(pa.array(head[joined])), depth[joined])
            last = (nodes.slice(int(head[-1]), 1), tree[-1].as_py(), signature[-1].as_py())
        if last is not None:
            for node, own_tree, own_signature in (*ends, last):
                yield rows(node, node, [0], [own_signature], [own_tree])
        release()

    schema = f"a {_NODE}, b {_NODE}, depth int, part int, tree int, signature binary"
    found = stored(entries.select("node", "tree", "signature").mapInArrow(run, schema), "matches")
    ends = found.filter("part IS NOT NULL").select("part", "a", "tree", "signature").collect()  # two rows a partition
    by_part: dict[int, list] = {}
    for r in ends:
        by_part.setdefault(r.part, []).append(r)
    across, before, head = [], None, None  # the last entry so far, and the head of the run it is in
    for part in sorted(by_part):
        of_first, of_last = (order(by_part[part], key=lambda r: (r.tree, bytes(r.signature))) for order in (min, max))
        depth = 0
        if before is not None and before.tree == of_first.tree:
            depth = next((i for i in range(DEEPEST) if before.signature[2 * i : 2 * i + 2] != of_first.signature[2 * i : 2 * i + 2]), DEEPEST)
        if depth >= shortest:
            across.append((of_first.a, head, depth))
        if depth < shortest or of_last.a != of_first.a:  # else the whole partition goes on with the run
            head = of_last.a
        before = of_last
    inside = found.filter("part IS NULL").select("a", "b", "depth")
    if not across:
        return inside
    return inside.union(nodes.sparkSession.createDataFrame(across, f"a {_NODE}, b {_NODE}, depth int"))


def _candidates(marked: DataFrame, similarity: float) -> DataFrame:
    """Nodes with a candidate partner: node, component, copies, size, and one document (doc_id, text_hash)."""
    nodes = marked.filter("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.max("size").alias("size"),
        F.min(F.struct("doc_id", "text_hash")).alias("one"), F.any_value("signatures").alias("signatures"),
    )
    nodes = stored(nodes, "nodes")
    edges = matches(nodes, depth_for(similarity)).select("a", "b")
    found = components(edges)
    return found.join(nodes.drop("signatures"), "node").select("node", "component", "copies", "size", "one.*")


def _compare(similarity: float, stripe_bits: int):
    def run(group: pa.Table) -> pa.Table:
        """Verified links of one block with itself or with another: per node its linked documents and a root."""
        one, other = (group.column(c)[0].as_py() for c in ("low", "high"))
        side = np.array(group.column("side").to_pylist())
        order = np.argsort(side, kind="stable")
        side = side[order]
        texts = group.column("text").take(pa.array(order)).to_pylist()
        names = group.column("node").take(pa.array(order))
        copies = np.array(group.column("copies").to_pylist(), np.int64)[order]
        sets = [shingles(t or "") for t in texts]
        sizes = np.array([len(s) for s in sets], np.int64)
        every, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        _, column, often = np.unique(every, return_inverse=True, return_counts=True)
        shared = often > 1  # a shingle of one set alone is in no intersection
        number = np.cumsum(shared) - 1
        use = shared[column]
        rows, columns, n_shared = rows[use], number[column[use]], int(shared.sum())
        stripe = max(64, stripe_bits // len(sets) // 64 * 64)
        several = n_shared > stripe
        counted = np.zeros((len(sets), len(sets)), np.int32) if several else None
        for low in range(0, max(1, n_shared), stripe):  # nearly always one
            mine = (columns >= low) & (columns < low + stripe)
            at = columns[mine] - low
            width = -(-max(1, min(stripe, n_shared - low)) // 64)
            bits = np.zeros((len(sets), width * 64 // 8), np.uint8)
            np.bitwise_or.at(bits, (rows[mine], at >> 3), np.left_shift(1, at & 7).astype(np.uint8))
            bits = bits.view(np.uint64)
            if several:
                for i in range(len(sets)):
                    for part in range(i, len(sets), 256):
                        counted[i, part : part + 256] += np.bitwise_count(bits[part : part + 256] & bits[i]).sum(axis=1, dtype=np.int32)

        def common_with(i: int, part: np.ndarray) -> np.ndarray:
            return counted[i, part].astype(np.int64) if several else np.bitwise_count(bits[part] & bits[i]).sum(axis=1, dtype=np.int64)

        links = np.zeros(len(sets), np.int64)
        root = np.arange(len(sets))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        border = int(np.searchsorted(side, other)) if one != other else 0
        for i in range(border if one != other else len(sets)):
            start = border if one != other else i + 1
            # A pair can only be as similar as its sizes are.
            near = start + np.flatnonzero(np.minimum(sizes[i], sizes[start:]) >= similarity * np.maximum(sizes[i], sizes[start:]))
            for part in np.split(near, range(256, len(near), 256)) if len(near) else []:
                common = common_with(i, part)
                linked = part[common >= similarity * (sizes[i] + sizes[part] - common)]
                links[i] += copies[linked].sum()
                links[linked] += copies[i]
                for j in linked.tolist():
                    a, b = top(i), top(j)
                    root[max(a, b)] = min(a, b)
        roots = names.take(pa.array([top(i) for i in range(len(sets))], pa.int64()))
        release()
        return pa.table({"node": names, "root": roots, "links": pa.array(links, pa.int64())})

    return run


def links(documents: DataFrame, marked: DataFrame, doc_id: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """Per verified block: node, root (a node it is connected to, or itself) and links (documents)."""
    found = stored(_candidates(marked, similarity), "candidates")
    blocks = found.groupBy("component").agg(F.count("*").alias("nodes"), F.sum("size").alias("bytes")).select(
        "component", F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    )
    texts = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"))
    on = texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["text_hash"] == found["text_hash"])
    rows = texts.join(found.hint("merge"), on).select("node", "component", "copies", "text").join(blocks, "component")
    # Repeated rows of one id and text would come more than once. Names are of the shingles, so any will do.
    rows = rows.groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("component", "copies", "text", "blocks")])
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("side")
    rows = rows.select("*", side).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner"))
    rows = rows.select("component", F.least("side", "partner").alias("low"), F.greatest("side", "partner").alias("high"), "side", "node", "copies", "text")
    return rows.groupBy("component", "low", "high").applyInArrow(_compare(similarity, STRIPE_BITS), f"node {_NODE}, root {_NODE}, links long")


def classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per document: doc_id, text_hash, component, class_id and n_links.

    ``component`` tells classes apart even where different texts have one document id; it is null
    without words.
    """
    marked = stored(mark(documents, doc_id, text, similarity), "marked")
    found = stored(links(documents, marked, doc_id, text, similarity), "links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # Nodes without a link stay out of both and are classes of their own.
    names = marked.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    names = names.join(joined, "node", "left").join(counted, "node", "left")
    names = names.withColumn("component", F.coalesce("component", "node"))
    first = names.groupBy("component").agg(F.min("first").alias("class_id"))
    names = names.join(first, "component").select("node", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows = marked.select("doc_id", "text_hash", "node").join(names, "node", "left")
    return rows.select(
        "doc_id", "text_hash", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "component",
    )


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class: that with the smallest id, nulls last. Documents without words all stay."""
    found = classes(documents, doc_id, text, similarity)
    chosen = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("chosen")
    chosen = found.filter("component IS NOT NULL").groupBy("component").agg(chosen).select(F.col("chosen.doc_id").alias("doc_id"), F.col("chosen.text_hash").alias("text_hash"))
    kept = chosen.withColumn("alone", F.lit(True)).union(found.filter("component IS NULL").select("doc_id", "text_hash", F.lit(False)).distinct())
    row = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("text_hash"))
    on = row["doc_id"].eqNullSafe(kept["doc_id"]) & (row["text_hash"] == kept["text_hash"])
    rows = row.join(kept.hint("merge"), on).select("document", row["doc_id"], row["text_hash"], "alone")
    # Repeated rows of the chosen document are all found; the first of them stays.
    number = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy(F.lit(0)))
    return rows.withColumn("number", number).filter("number = 1 OR NOT alone").select("document.*")
