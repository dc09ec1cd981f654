"""Text operators on small tables with nulls, repeats, ties, empty tables and clashing columns, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models

from churnflow.llm import bpe, chunk_dedup, decontaminate, near_duplicates, quality, suffix_dedup, token_counts, token_store
from churnflow.llm.columns import shared_path
from churnflow.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, n_words long, spans string, n_bytes long, ids string, words string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [words(rng, 80) for _ in range(6)]
    passage = words(rng, 70)
    edited = base[0].split()
    edited[40] = "changed"
    rows = [
        (1, base[0]), (2, base[0]), (3, " ".join(edited)), (4, base[1]), (5, f"{base[2]} {passage} {base[3]}"),
        (6, f"{words(rng, 33)}\n{passage}\n{words(rng, 12)}"), (7, None), (8, ""), (9, " \n\t "), (10, "one two"), (11, "one two"),
        (None, base[4]), (None, base[4]), (None, None), (12, base[5]), (12, base[5]), (12, "same id, other text " + words(rng, 30)),
        (13, "abc " * 400), (14, "x" * 1000), (15, "word-'s don't <|endoftext|> 12 ÉÀ ｆｕｌｌ  é 日本語 \U0001f600"),
        (16, words(rng, 4000)), (17, "a\nb\na\n\n \nb"),
    ]
    return rows


@pytest.fixture(scope="module")
def documents(spark, texts):
    rows = [(i, t, "xx", 7, "own", 5, "mine", "w") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_counts(documents, texts, nothing):
    got = collections.Counter(
        (r.doc_id, r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality.judge(documents).collect()
    )
    want = collections.Counter()
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        seen = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want[i, t, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit),
             len(w) < 20 or 100 * len(hit) > 30 * len(w)] += 1
    assert got == want
    assert quality.judge(nothing).count() == 0


def test_quality_verdict_and_filter(spark):
    good = "The mill by the river was old, and for many years nobody had been in it but the owls of the wood."
    rows = [(1, good), (2, " ".join(w + "***" for w in good.split())), (3, good.upper() + "!!"), (4, "menu | item | " * 12), (5, None)]
    kept = quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == ["doc_id", "text"]


def test_encode_and_decode(documents, texts, nothing):
    content = tokenizer_file()
    tokenizer = Tokenizer.from_str(content)
    encoded = bpe.encode(documents, content)
    assert encoded.columns == ["doc_id", "lang", "n_words", "spans", "n_bytes", "words", "ids"]
    got = collections.Counter((r.doc_id, bytes(r.ids), r.text) for r in bpe.decode(encoded, content).collect())
    want = collections.Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want[i, np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.encode(nothing, content).count() == 0


def test_encode_in_many_blocks(documents, texts, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 1000)
    content = tokenizer_file()
    tokenizer = Tokenizer.from_str(content)
    got = collections.Counter((r.doc_id, len(r.ids) // 4) for r in bpe.encode(documents.coalesce(1), content).collect())
    assert got == collections.Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in texts)


def test_token_files(spark, documents, texts, nothing):
    content = tokenizer_file()
    tokenizer = Tokenizer.from_str(content)
    encoded = bpe.encode(documents, content)
    rows = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_store.round_trip(encoded, 2).collect()]
    made = []
    for i, t in texts:
        data = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        made.append((i is not None, i or 0, len(data) // 4, zlib.crc32(data)))
    want, start = [], 0
    for known, i, n, check in sorted(made):
        want.append((i if known else None, start, n, check))
        start += n
    assert sorted(rows, key=lambda r: r[1]) == want
    assert token_store.round_trip(bpe.encode(nothing, content), 2).count() == 0


@pytest.mark.parametrize("n, limit", [(1, 3), (2, 4), (5, 3), (300, 9), (3000, 12)])
def test_huffman_codes(n, limit):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(0.6, n) * 9).astype(np.int64) + 1
    lengths = token_store.code_lengths(counts, limit)
    assert lengths.max() <= limit and (n == 1 or (0.5 ** lengths.astype(float)).sum() == 1)
    book = token_store.Codebook(lengths)
    sizes = np.array([0, 1, 256, 257, 3000])
    parts, marks, place, ids = [], [], 0, [rng.integers(0, n, s).astype("<u4") for s in sizes]
    for own in ids:
        packed, at = book.encode(own)
        marks.append(at + 8 * place)
        parts.append(packed)
        place += len(packed)
    got = book.decode(b"".join(parts), np.concatenate(marks), token_store._lanes(sizes))
    assert (got == np.concatenate(ids)).all()


def test_token_file_ranges(tmp_path):
    from churnflow.llm.files import RangeReader, writing

    rng = np.random.default_rng(0)
    own = [rng.integers(0, 50, n).astype("<u4") for n in (0, 700, 5, 3000)]
    lengths = token_store.code_lengths(np.ones(50, np.int64))
    with writing(str(tmp_path / "a.ids")) as out:
        writer, book = token_store.FileWriter(out, lengths), token_store.Codebook(lengths)
        for number, ids in enumerate(own):
            writer.add(number, len(ids), *book.encode(ids))
        writer.finish()
    with RangeReader(str(tmp_path / "a.ids")) as file:
        reader = token_store.FileReader(file)
        for number, ids in enumerate(own):
            for start, n in ((0, None), (255, 3), (511, 700), (2999, 5)):
                want = ids[start:] if n is None else ids[start : start + n]
                assert (reader.ids(number, start, n) == want).all()


@pytest.mark.parametrize("block", [800, None])
def test_near_duplicates(spark, documents, texts, nothing, block, monkeypatch):
    if block:
        monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", block)
    sets = [frozenset(near_duplicates.shingles(t or "").tolist()) for _, t in texts]
    linked = [[j for j, b in enumerate(sets) if j != i and a and b and len(a & b) >= 0.8 * len(a | b)] for i, a in enumerate(sets)]
    root = list(range(len(sets)))
    for _ in sets:
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(len(sets))]
    want = collections.Counter()
    for i, (number, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if root[j] == root[i] and texts[j][0] is not None]
        want[number, min(ids) if sets[i] and ids else number, len(linked[i])] += 1
    got = collections.Counter((r.doc_id, r.class_id, r.n_links) for r in near_duplicates.classes(documents).collect())
    assert got == want
    kept = near_duplicates.keep_one(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len({root[i] for i in range(len(sets)) if sets[i]}) + sum(not s for s in sets)
    assert near_duplicates.classes(nothing).count() == 0


@pytest.mark.parametrize("stripe", [1 << 29, 64])
def test_large_group_of_different_near_copies(spark, monkeypatch, stripe):
    monkeypatch.setattr(near_duplicates, "STRIPE_BITS", stripe)
    rng = random.Random(1)
    base = words(rng, 150).split()
    rows = [(k, " ".join([*base[:k], "new", *base[k + 1 :]])) for k in range(60)]
    found = near_duplicates.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in found} == {(0, 59)}


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_matches_are_the_runs_of_sorted_signatures(spark, partitions):
    """Also where a run goes on over many partitions: its first entry in each is joined to the first of all."""
    rng = np.random.default_rng(2)
    heads = rng.integers(0, 5, (400, near_duplicates.TREES, near_duplicates.DEEPEST)).astype(">u2")
    heads[:200, :3] = heads[0, :3]  # a third of the trees' entries are alike
    rows = [(i, heads[i].tobytes()) for i in range(400)]
    nodes = spark.createDataFrame(rows, "node long, signatures binary").selectExpr("cast(node as decimal(38,0)) node", "signatures")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for shortest in (3, 5):
            found = {(int(r.a), int(r.b)) for r in near_duplicates.matches(nodes, shortest).collect()}
            want, heads_of = set(), collections.defaultdict(set)
            for tree in range(near_duplicates.TREES):
                first = {}
                for sig, node in sorted((heads[i, tree].tobytes(), i) for i in range(400)):
                    head = first.setdefault(sig[: 2 * shortest], node)
                    heads_of[node].add(head)
                    if head != node:
                        want.add((node, head))
            if partitions == 1:
                assert found == want
            assert all(heads_of[a] & heads_of[b] for a, b in found)  # both in one run
            joined = found | {(a, c) for a, b in found for d, c in found if b == d}
            assert want <= joined
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_recall_decides_the_depth():
    depth = near_duplicates.depth_for(0.8)
    assert near_duplicates.recall(depth, 0.8, 24) >= near_duplicates.RECALL > near_duplicates.recall(depth + 1, 0.8, 24)


def test_a_line_in_very_many_texts_makes_no_large_shard(spark, monkeypatch):
    """Its least gram gives all strings around it one fingerprint; beyond ``CROWDED`` runs they are dealt by digest."""
    rng = random.Random(4)
    line = "".join(rng.choices("abcdefgh ", k=150))
    noise = lambda n: "".join(rng.choices("ijklmnopqrstuvwxyz ", k=n))
    passage = line + noise(120)
    rows = [(i, f"{noise(150)}{line}{noise(150)}") for i in range(700)] + [(1000 + i, noise(80) + passage) for i in range(3)]
    monkeypatch.setattr(suffix_dedup, "CROWDED", 64)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20_000)
    kept, store = {}, suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name, path=None: kept.setdefault(name, store(df, name, path)))
    found = {r.doc_id: r for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    often = collections.Counter()
    for r in kept["suffix-pieces"].filter("values IS NOT NULL").collect():
        often.update(np.frombuffer(suffix_dedup._expand(r["values"]), np.uint64).tolist())
    assert max(often.values(), default=0) <= 64
    assert all(found[i].n_removed == 0 for i in range(700)) and all(found[1000 + i].n_removed == 270 for i in range(3))


@pytest.mark.parametrize(("block", "crowded"), [(900, 4096), (900, 3), (900, 1), (None, 4096), (None, 1)])
def test_suffix_dedup(documents, texts, nothing, block, crowded, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    if block:
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
    datas = [(t or "").encode() for _, t in texts]
    often = collections.Counter(d[k : k + 200] for d in datas for k in range(len(d) - 199))
    want = collections.Counter()
    for (i, t), d in zip(texts, datas, strict=True):
        hit = {j for k in range(len(d) - 199) if often[d[k : k + 200]] > 1 for j in range(k, k + 200)}
        kept = bytes(b for j, b in enumerate(d) if j not in hit)
        want[i, None if t is None else kept, len(d), len(hit), sum(j - 1 not in hit for j in hit)] += 1
    got = suffix_dedup.dedup(documents)
    assert collections.Counter((r.doc_id, r.text if r.text is None else bytes(r.text), r.n_bytes, r.n_removed, r.n_spans) for r in got.collect()) == want
    assert suffix_dedup.dedup(nothing).count() == 0


def test_chunk_dedup(documents, texts, nothing, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "BLOCK_BYTES", 1200)
    found = chunk_dedup.dedup(documents)
    assert found.columns == ["doc_id", "text", "lang", "n_words", "spans", "ids", "words", "n_bytes", "n_chunks", "n_removed", "n_spans"]
    rows = found.collect()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (None, 12)}
    given = dict(texts)
    assert by_id[1].text == given[1] and by_id[2].text == "" and by_id[4].text == given[4] and by_id[7].text is None
    passage = given[6].split("\n")[1]
    assert passage in by_id[5].text and passage not in by_id[6].text
    assert by_id[6].n_removed > 0.6 * len(passage.encode())
    assert by_id[10].text == by_id[11].text == "one two"  # too short to be a run
    assert sorted(len(r.text or "") for r in rows if r.doc_id is None)[:2] == [0, 0]
    for r in rows:
        assert r.n_bytes - r.n_removed == len((r.text or "").encode())
    assert chunk_dedup.dedup(nothing).count() == 0


def covered_by_earlier(texts, size):
    """Brute force: bytes of each text inside a string of ``size`` bytes that starts at an earlier place, too."""
    seen, out = set(), []
    for data in texts:
        hit = np.zeros(len(data), bool)
        for k in range(len(data) - size + 1):
            if data[k : k + size] in seen:
                hit[k : k + size] = True
            seen.add(data[k : k + size])
        out.append(hit)
    return out


def test_chunks_of_stock_lines_in_a_new_order_stay(spark, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "BLOCK_BYTES", 20_000)
    rng = random.Random(12)
    stock = [words(rng, rng.randint(6, 14)) for _ in range(200)]
    texts = ["\n".join(rng.choices(stock, k=30)) for _ in range(150)]
    texts[70] = texts[20][300:1100] + "\n" + texts[70]
    rows = chunk_dedup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    hits = covered_by_earlier([t.encode() for t in texts], chunk_dedup.MIN_RUN)
    for r in rows:
        left, given, hit = iter(r.text.encode()), texts[r.doc_id].encode(), hits[r.doc_id]
        assert r.n_removed <= hit.sum() and len(r.text.encode()) == len(given) - r.n_removed
        # What cannot go is still there, in its order.
        assert all(b in left for b in (g for g, h in zip(given, hit, strict=True) if not h))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[70].n_removed > 700 and sum(r.n_removed == 0 for r in rows) == sum(not h.any() for h in hits) > 50


def test_repeats_little_longer_than_a_window_go(spark):
    rng = random.Random(6)

    def some(n, longest):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, longest))) for _ in range(n))

    passages = [some(51, 5) for _ in range(150)] + [some(80, 6)[:180] for _ in range(150)]
    rows = [(2 * i + k, f"{some(30, 8)} {p} {some(30, 8)}") for i, p in enumerate(passages) for k in (0, 1)]
    removed = {r.doc_id: r.n_removed for r in chunk_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [removed[2 * i + 1] > 0 for i in range(len(passages))]
    assert not any(removed[2 * i] for i in range(len(passages)))
    assert sum(found[:150]) >= 148 and sum(found[150:]) >= 138


def test_cuts_follow_insertions():
    rng = random.Random(5)
    data = words(rng, 3000).encode()
    cut = set(chunk_dedup.cuts(data).tolist())
    moved = {c - 7 for c in chunk_dedup.cuts(data[:4000] + b"1234567" + data[4000:]).tolist()}
    assert {c for c in cut if c > 4100} == {c for c in moved if c > 4100}
    assert all(chunk_dedup.cuts(data)[:-1] < len(data)) and chunk_dedup.cuts(b"").size == 0


def test_many_automata_are_never_in_one_stage(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, words(rng, 30)) for i in range(10)]
    documents = spark.createDataFrame([(i, f"{words(rng, 20)} {t} {words(rng, 9)}") for i, t in items], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    once = {r.doc_id: (r.n_hit, r.items_sha256) for r in decontaminate.report(documents, benchmark).collect()}
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 30)
    assert len(list(decontaminate.automata(benchmark))) == 10
    found = decontaminate.report(documents, benchmark)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: (r.n_hit, r.items_sha256) for r in found.collect()} == once and all(n >= 30 for n, _ in once.values())


@pytest.mark.parametrize("shard", [10, None])
def test_decontaminate(spark, documents, texts, nothing, shard, monkeypatch):
    if shard:
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", 40)
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", 25)
    given = dict(texts)
    shouted = re.sub("[a-z]", lambda m: m[0].upper(), given[4])
    items = [
        ("a", " ".join(given[5].split()[70:110])), ("b", shouted), ("b", shouted), ("c", "one, TWO"), ("d", None), ("e", "!!"),
        (None, " ".join(given[16].split()[100:130])), ("f", words(random.Random(9), 40)),
    ]
    table = spark.createDataFrame(items, "item_id string, text string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = pattern.findall(lower(t))
        for k in range(len(w) - min(10, len(w)) + 1) if w else []:
            windows.setdefault(tuple(w[k : k + min(10, len(w))]), set()).update([i] if i else [])
    want = collections.Counter()
    for i, t in texts:
        w, hit, named = pattern.findall(lower(t)), set(), set()
        for window, ids in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    named |= ids
        want[i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)] += 1
    assert collections.Counter(map(tuple, decontaminate.report(documents, table).collect())) == want
    clean = decontaminate.clean(documents, table)
    assert clean.columns == documents.columns
    assert not decontaminate.report(clean, table).filter("contaminated").count()
    assert {r.doc_id: r.text for r in clean.collect()}[1] == given[1]
    assert 4 not in {r.doc_id for r in clean.collect()}
    assert decontaminate.report(nothing, table).count() == 0
    assert not decontaminate.report(documents, table.limit(0)).filter("contaminated").count()


def test_word_piece_counts(spark, documents, texts, nothing):
    rng = random.Random(2)
    pieces = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(150)]
    initial, inner = pieces[:80], pieces[60:]
    names: dict[str, int] = {}
    for piece in ["[UNK]", *initial, *("##" + p for p in inner)]:
        names.setdefault(piece, len(names))
    model = Tokenizer(models.WordPiece(names, unk_token="[UNK]", max_input_chars_per_word=10**9))
    want = collections.Counter()
    for i, t in texts:
        found = [model.encode(w).tokens for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        want[i, len(found), sum(map(len, found)), sum(f == ["[UNK]"] for f in found)] += 1
    got = token_counts.count(documents, initial, inner)
    assert collections.Counter((r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in got.collect()) == want
    assert token_counts.count(nothing, initial, inner).count() == 0


def test_shared_folders_differ(spark):
    assert shared_path(spark, "a") != shared_path(spark, "a")
