"""Sharding, conversation repair and the filter audit on small tables, against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from churnflow.llm import conversation_repair as repair, filter_audit, queries, sharding

DOCUMENTS = "doc_id long, text string, lang string, quality int, shard string, slot string, part string, mask int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, l, 0, "own", "mine", "p", 1) for i, t, l in rows], DOCUMENTS)


# --- sharding


def sized(df):
    from pyspark.sql import functions as F

    text = F.coalesce("text", F.lit(""))
    return df.withColumn("size", (F.octet_length(text) + 16).cast("long")).withColumn("key", F.xxhash64(text))


def test_shards_hold_nearly_equal_bytes_though_a_third_of_the_rows_are_copies(spark):
    rng = random.Random(1)
    rows = [(i, "the same text " * 20 if i % 3 == 0 else "x" * rng.randint(0, 900) + str(i), "en") for i in range(6000)]
    rows += [(None, None, None), (None, None, None), (5, "", "en"), (7, "long " * 3000, "fr"), (7, "long " * 3000, "fr")]
    placed = sharding.assign(sized(documents(spark, rows)).repartition(7), 40).collect()
    assert len(placed) == len(rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in placed:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean, longest = sum(size.values()) / 40, max(r.size for r in placed)
    assert set(size) == set(range(40)) and all(abs(s - mean) <= longest for s in size.values())
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert collections.Counter((r.doc_id, r.text, r.lang, r.part) for r in placed) == collections.Counter((*r, "p") for r in rows)


def test_shards_follow_from_exact_sums_whatever_the_layout(spark):
    rows = [(i % 900, f"text {i % 50} " * (i % 50), "en") for i in range(1500)]
    table = sized(documents(spark, rows))
    one = {(r.doc_id, r.key): r.shard for r in sharding.assign(table.repartition(2), 8).collect()}
    two = {(r.doc_id, r.key): r.shard for r in sharding.assign(table.repartition(13), 8).collect()}
    total, before, want = table.agg({"size": "sum"}).first()[0], 0, {}
    for r in sorted(table.collect(), key=lambda r: (r.key, r.doc_id)):
        want[r.doc_id, r.key] = min(7, (2 * before + r.size) * 8 // (2 * total))
        before += r.size
    assert one == two == want


def test_an_overfull_range_is_subdivided(spark):
    """One text holds nearly all rows: without subdivision it would be one range, and one task."""
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(100).alias("size"), F.when(F.col("id") < 100, F.col("id")).otherwise(7).alias("key"))
    seen = []
    found = sharding._with_range

    def watched(frame, splitters):
        out = found(frame, splitters)
        if "row" in frame.columns:
            seen.append(max(r["count"] for r in out.groupBy("range").count().collect()))
        return out

    sharding._with_range = watched
    try:
        placed = sharding.assign(rows, 10)
    finally:
        sharding._with_range = found
    assert seen[0] > 19_000 and seen[-1] < 2 * 2_000
    assert sorted(r["count"] for r in placed.groupBy("shard").count().collect()) == [2_000] * 10


def test_shards_of_few_and_of_no_rows(spark):
    few = sharding.assign(sized(documents(spark, [(1, None, "en"), (2, "ab", "en")])), 5).collect()
    assert [(r.doc_id, r.slot) for r in sorted(few, key=lambda r: r.doc_id)] == [(1, 0), (2, 0)]
    nothing = sharding.assign(sized(documents(spark, [])), 5)
    assert nothing.count() == 0 and nothing.schema["shard"].dataType.simpleString() == "int"


def test_shards_are_written_in_slot_order(spark, tmp_path):
    placed = sharding.assign(sized(documents(spark, [(i, f"t{i}" * i, "en") for i in range(200)])), 4)
    sharding.write(placed, str(tmp_path / "shards"), rows_per_file=20)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 200 and sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    for r in back.groupBy("shard").agg({"slot": "max", "*": "count"}).collect():
        assert r["max(slot)"] == r["count(1)"] - 1


# --- conversation repair


def brute(rows):
    """All repairs by dynamic programming over whole (cost, letters) pairs; rows are (role, text)."""
    seen, kinds = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    allowed = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {(0, ""): (0, "", [])}
    for i in range(len(rows) + 1):
        for _ in range(4):  # inserts
            for (at, state), (cost, letters, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    if at == i and (state, role[0]) in allowed:
                        key, new = (i, role[0]), (cost + 2, letters + "I", [*lines, f"{role}:"])
                        if key not in best or new[:2] < best[key][:2]:
                            best[key] = new
        if i == len(rows):
            break
        role, text = rows[i]
        for (at, state), (cost, letters, lines) in list(best.items()):
            if at != i:
                continue
            options = [(3, "D", state, lines)]
            if kinds[i] not in ("b", "d"):
                late = kinds[i] == "t"
                if (state, role[:1]) in allowed and role:
                    options.append((late, "K", role[0], [*lines, f"{role}:{text}"]))
                options += [(2 + late, "R", new[0], [*lines, f"{new}:{text}"]) for new in ("user", "assistant") if (state, new[0]) in allowed]
            for more, letter, to, out in options:
                key, new = (i + 1, to), (cost + more, letters + letter, out)
                if key not in best or new[:2] < best[key][:2]:
                    best[key] = new
    cost, audit, lines = min((best[len(rows), s] for s in ("", "a") if (len(rows), s) in best), key=lambda b: b[:2])
    return kinds, cost, audit, lines


ROLES = ["user", "assistant", "system", "tool", "", "u", "Assistant"]
TEXTS = ["a.", "b!", "c", "", " \n", "d?  ", "e. f", "g."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), st.sampled_from(TEXTS)), max_size=7), st.integers(1, 3))
def test_pieces_give_the_least_repair(rows, width):
    """The steps of the operator without Spark, with pieces of a few rows."""
    kinds, cost, audit, lines = brute(rows)
    code = bytes(repair.BLANK if k == "b" else repair.DUPLICATE if k == "d" else repair._kind(*row) for k, row in zip(kinds, rows, strict=True))
    pieces = [(code[i : i + width], rows[i : i + width]) for i in range(0, len(code), width)] or [(b"", [])]
    ends = [repair.SPECULATIVE] * (len(pieces) - 1) + [repair.END]
    starts = [repair.vectors(k, e)[0] for (k, _), e in zip(pieces, ends, strict=True)]
    while (wanted := [*starts[1:], repair.END]) != ends:
        starts = [repair.rerun(k, e, s, w) if e != w else s for (k, _), e, s, w in zip(pieces, ends, starts, wanted, strict=True)]
        ends = wanted
    by_matrix = repair.END
    for k, _ in reversed(pieces):
        costs = [min(row[t] + by_matrix[t] for t in range(4)) for row in repair.transfer(k)]
        by_matrix = tuple(c - min(costs) for c in costs)
    assert by_matrix == starts[0]
    state, got_cost, got_audit, got_lines = 0, 0, "", []
    for n, ((k, own), end) in enumerate(zip(pieces, ends, strict=True)):
        letters, reached = repair.trace(k, end, state, n == len(pieces) - 1)
        roles, texts = repair.apply_edits(letters, [r for r, _ in own], [t for _, t in own], state)
        got_cost, got_audit, state = got_cost + repair._cost(letters, k), got_audit + "".join(letters), reached
        got_lines += [f"{r}:{t}" for r, t in zip(roles, texts, strict=True)]
    assert (got_cost, got_audit, got_lines) == (cost, audit, lines)


CONVERSATIONS = "conv_id long, turn long, role string, text string, audit string, cost string, piece string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "own", "mine", "x") for r in rows], CONVERSATIONS)


def expected(rows):
    """By conversation, from all its rows in order."""
    found = {}
    blank = lambda v: " " if v is None else v
    key = lambda r: (r[1] is not None, r[1] or 0, blank(r[2]), hashlib.md5(blank(r[3]).encode()).hexdigest())
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        pairs = [(blank(r[2]), blank(r[3])) for r in own]
        kinds, cost, audit, lines = brute(pairs)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(pairs))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, digest)
    return found


@pytest.mark.parametrize(("piece_bytes", "passes"), [(1 << 20, 4), (200, 4), (1, 0), (1, 1)])
def test_repair_of_nulls_ties_repeats_long_texts_and_a_hot_conversation(spark, piece_bytes, passes):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS)) for c in range(12) for t in range(rng.randint(1, 7))]
    rows += [(50, t, rng.choice(ROLES[:3]), f"m{rng.randint(0, 30)}" + rng.choice([".", ""])) for t in range(60)]  # a hot one
    rows += [(51, t, "user", f"only users {t}.") for t in range(41)]  # keeps its parity over all pieces
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", None), (52, None, "user", "x."), (52, None, "assistant", "y.")]
    rows += [(53, 0, "user", "long " * 30_000 + "."), (53, 1, "assistant", "z."), (53, 1, "assistant", "z."), (54, 3, "user", "same."), (54, 3, "user", "same."), (54, 9, "assistant", "k!")]
    found = repair.summary(repair.repair(conversations(spark, rows).repartition(5), None, piece_bytes, passes)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected(rows) and len(found) == len({r[0] for r in rows})


def test_repair_keeps_conversations_without_rows_and_takes_an_empty_table(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "a."), (2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    times = F.when(F.col("conv_id") == 1, 0).otherwise(1)
    found = {r.conv_id: tuple(r)[1:] for r in repair.summary(repair.repair(conversations(spark, rows), times)).collect()}
    assert found[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[2][5:7] == (0, "KK")
    assert repair.summary(repair.repair(conversations(spark, []))).count() == 0


def test_repaired_messages_are_whole(spark):
    found = repair.repair(conversations(spark, [(1, 0, "tool", "a."), (1, 1, "user", "b")])).collect()
    assert [(r.audit, r.roles, r.texts) for r in found] in ([("RR", ["user", "assistant"], ["a.", "b"])], [("DKI", ["user", "assistant"], ["b", ""])])
    assert sum(r.cost for r in found) == 5


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(20) for t in range(10)] + [(None, None, None, None)]
    for r in queries.damaged(conversations(spark, rows)).collect():
        name = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        fault = zlib.crc32(name.encode()) % 20
        text = "One. Two!" if r.conv_id is not None else " "
        role = "assistant" if r.conv_id is not None else None
        assert (r.times, r.text, r.role) == (
            {0: 0, 3: 2}.get(fault, 1), {1: "", 2: text.replace(".", "").replace("!", "")}.get(fault, text), "user" if fault == 4 else role)


# --- filter audit


def test_removal_steps_are_a_minimum_over_failed_filters():
    rng = np.random.default_rng(3)
    masks = rng.random((40, 4)) < 0.4
    orders = list(itertools.permutations(range(4)))
    positions = np.array([[order.index(f) + 1 for f in range(4)] for order in orders])
    got = filter_audit.removal_steps(masks, positions)
    assert all(got[m, o] == min((positions[o, f] for f in range(4) if masks[m, f]), default=5) for m in range(40) for o in range(len(orders)))


def test_filter_audit_replays_every_order(spark):
    rng = random.Random(2)
    word = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    base = [word(120), word(30), "same " * 150, "LOUD " * 40 + word(100), word(110) + " #", word(99) + " $", "", word(3000)]
    rows = [(rng.choice([*range(60), None]), rng.choice([*base, None, word(105)]), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    rows += [(3, base[0], "en"), (3, base[0], "en"), (3, base[0], None)]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(40)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = collections.defaultdict(list)
    for i, t, lang in rows:
        text = t or ""
        words = text.split()
        capitals = sum("A" <= c <= "Z" for c in text)
        failed = "".join(
            name for name, broken in (
                ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)), ("C", 100 * capitals > 10 * len(text)),
                ("D", any(c in "#$%&*|" for c in text)), ("E", i is not None and i > least[text])) if broken)
        good, toxic = (any(m[0] == i and i is not None and m[k] == 1 for m in marks) for k in (1, 2))
        parts[lang or ""].append((failed, good, toxic))
    want = {}
    for part, own in parts.items():
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            alive = own
            for step, f in enumerate(order, 1):
                lost = [d for d in alive if f in d[0]]
                alive = [d for d in alive if f not in d[0]]
                shapley[f] += len(lost)
                want[part, "".join(order), step] = [
                    len(alive), len(lost), sum(f in d[0] for d in own) - len(lost), sum(d[0] == f for d in own), sum(d[1] for d in lost), sum(d[2] for d in lost)]
        for (p, order, step), counts in want.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    found = filter_audit.audit(documents(spark, rows).repartition(4), labels).collect()
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in found} == want and len(found) == len(want)


def test_filter_audit_of_no_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), labels).count() == 0
