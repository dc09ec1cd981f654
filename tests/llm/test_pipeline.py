"""The pipeline on a small table against plain Python, stage by stage."""

from __future__ import annotations

import hashlib
import os
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from churnflow.llm import chunk_dedup, decontaminate, near_duplicates, quality
from churnflow.llm.queries import tokenizer_file


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "and", *("".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(4))]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    item, passage = sentence(rng, 30), sentence(rng, 60)
    texts = [sentence(rng, 120) for _ in range(8)]
    near = texts[1].split()
    near[50] = "altered"
    rows = [
        (0, texts[0]), (1, texts[1]), (2, texts[1]), (3, " ".join(near)), (4, f"{texts[2]} {passage} {texts[3]}"), (5, f"{texts[4]}\n{passage}\n{texts[5]}"),
        (6, f"{texts[6]} {item} {texts[7]}"), (7, item), (8, "too short"), (9, None), (10, " ".join(w + "***" for w in texts[0].split())), (None, sentence(rng, 90)),
    ]
    path = tmp_path_factory.mktemp("corpus")
    documents = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), dict(rows), item, passage


def test_stages(spark, folder):
    path, given, item, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    assert kept["quality_rules"] == {i: t for i, t in given.items() if i not in (8, 9, 10)}
    assert kept["near_duplicates"] == {i: t for i, t in kept["quality_rules"].items() if i not in (2, 3)}
    after = kept["substring_dedup"]
    assert {i for i, t in after.items() if t != kept["near_duplicates"][i]} >= {5} and after[4] == given[4] and passage not in after[5]
    assert all(after[i] == given[i] for i in (0, 1, None)) and len(after[5]) > 2 * len(passage)
    clean = kept["decontamination"]
    assert item not in clean[6] and clean[0] == given[0] and 7 not in clean and clean[None] == given[None]


def test_run(spark, folder):
    path, given, _, _ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    tokenizer = Tokenizer.from_str(tokenizer_file())
    by_id = {r.doc_id: r for r in rows}
    ids = np.array(tokenizer.encode(given[0], add_special_tokens=False).ids, "<u4")
    assert bytes(by_id[0].ids) == ids.tobytes() and by_id[0].n_tokens == len(ids)
    assert by_id[0].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
    assert by_id[0].decoded_sha256 == hashlib.sha256(tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()


def test_ties_repeats_long_texts_and_clashing_names(spark, tmp_path):
    """Columns named like results of the operators keep their values; a long text passes whole."""
    rng = random.Random(3)
    base, passage, long = sentence(rng, 120), sentence(rng, 70), sentence(rng, 40_000)
    rows = [(1, base), (1, base), (2, base), (None, base), (5, f"{passage} {sentence(rng, 60)}"), (6, f"{sentence(rng, 60)} {passage}"), (7, long), (8, None), (9, "")]
    schema = "doc_id long, text string, n_bytes long, n_removed long, spans string, others string, document string, ids string, n_chars long"
    given = [(i, t, 111 if i is None else 100 + i, 7, "own", "mine", "doc", "x", 0) for i, t in rows]
    spark.createDataFrame(given, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, sentence(rng, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.dtypes == spark.read.parquet(f"{tmp_path}/documents.parquet").dtypes
    found = {r.doc_id: r for r in docs.collect()}
    assert set(found) == {1, 5, 6, 7} and docs.count() == 4
    assert all((r.n_bytes, r.n_removed, r.spans, r.others, r.document, r.ids) == (100 + i, 7, "own", "mine", "doc", "x") for i, r in found.items())
    assert found[7].text == long and found[7].n_chars == len(long) and len(found[6].text) < len(found[5].text)
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last.columns == ["doc_id", "n_bytes", "n_removed", "spans", "others", "document", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert {r.doc_id: r.n_bytes for r in last.collect()} == {i: 100 + i for i in found}


def test_empty_table_and_no_scratch_left(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = set(os.listdir(f"{root}/llm")) if os.path.isdir(f"{root}/llm") else set()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(f"{root}/llm")) - before}
    assert left <= {"decontamination", "bpe-blocks"}  # what the result is still read from


def test_order_of_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "decontamination", "bpe"]
    assert all(m for m in (quality, near_duplicates, chunk_dedup, decontaminate))
    assert set(__spark_entry__.queries()) >= {"pipeline", *(n for n in __spark_entry__.queries() if n.startswith("op"))}
    assert sum(n.startswith("op") for n in __spark_entry__.queries()) == 13
