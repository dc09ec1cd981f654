"""SQL with the same results as the queries that another engine's SQL can express."""

from __future__ import annotations

from churnflow.llm import near_duplicates, quality
from churnflow.llm.queries import SHARDS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

WARC = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
    FROM f"""

# Pairs that share a shingle are counted, and classes found by following links.
JACCARD_JOIN = f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
    s AS (SELECT DISTINCT r, array_to_string(w[i : i + {near_duplicates.WORDS - 1}], ' ') AS shingle
      FROM d, unnest(range(1, greatest(2, len(w) - {near_duplicates.WORDS - 2}))) AS t(i) WHERE len(w) > 0),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    shared AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE c >= {near_duplicates.SIMILARITY} * (x.n + y.n - c)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a, min(doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY a),
    counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
    SELECT doc_id, coalesce(least(class_id, doc_id), doc_id) AS class_id, coalesce(n_links, 0) AS n_links
    FROM d LEFT JOIN least ON least.a = r LEFT JOIN counted ON counted.a = r"""

_BARE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = f"""
    WITH b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_BARE}') AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id::VARCHAR AS item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
      FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
    d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_BARE}') AS w FROM documents),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
      FROM d, sizes, unnest(range(1, greatest(1, len(w) - n + 2))) AS t(i)),
    found AS (SELECT r, i, places.n, item_id FROM places JOIN windows ON windows.g = places.g AND windows.n = places.n),
    hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY r),
    items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""


def _quality() -> str:
    stop_words = ", ".join(f"'{w}'" for w in dict.fromkeys([*quality.STOP_WORDS, *map(str.capitalize, quality.STOP_WORDS)]))
    words, lines, chars = ("greatest(n_words, 1)", "greatest(n_lines, 1)", "greatest(word_chars, 1)")
    measures = {
        "words": "n_words", "repeated_percent": f"100.0::DOUBLE * n_repeat_words / {words}", "mean_word_chars": f"word_chars::DOUBLE / {words}",
        "symbols_per_word": f"n_symbols::DOUBLE / {words}", "exclamations_per_word": f"n_exclamations::DOUBLE / {words}",
        "capitals_per_char": f"n_capitals::DOUBLE / {chars}", "stop_words_per_word": f"n_stop::DOUBLE / {words}",
        "stutters_per_word": f"n_stutters::DOUBLE / {words}", "duplicate_lines_per_line": f"n_dup_lines::DOUBLE / {lines}",
    }
    broken = [(r.base, f"{measures[r.measure]} {sign} {bound}") for r in quality.RULES for sign, bound in (("<", r.low), (">", r.high)) if bound is not None]
    without = lambda characters: f"length(t) - length(regexp_replace(t, '[{characters}]+', '', 'g'))"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w, [l for l in string_split(t, chr(10)) if regexp_matches(l, '{_WORD}')] AS lines FROM d),
    grams AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS g FROM w, unnest(range(1, greatest(1, len(w) - 6))) AS t(i)),
    again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
    gaps AS (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS n FROM again),
    repeats AS (SELECT r, sum(n)::BIGINT AS n FROM gaps GROUP BY r),
    counted AS (SELECT doc_id, len(w) AS n_words, list_sum([length(x) for x in w])::BIGINT AS chars_or_null,
      coalesce(chars_or_null, 0) AS word_chars, {without("#*$%&|<>")} AS n_symbols, len(lines) AS n_lines,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
      {without("!")} AS n_exclamations, {without("A-ZÀ-ÖØ-Þ")} AS n_capitals,
      len([x for x in w if x IN ({stop_words})]) AS n_stop, len([i for i in range(2, len(w) + 1) if w[i] = w[i - 1]]) AS n_stutters
      FROM w LEFT JOIN repeats USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      ({' OR '.join(x for base, x in broken if base)}) AS base_failed, NOT ({' OR '.join(x for _, x in broken)}) AS kept
    FROM counted"""


_BYTES = "list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)"
_TABLE = "range(256)"
for _ in range(8):  # the table of the checksum, from its rule
    _TABLE = f"list_transform({_TABLE}, lambda c: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"

# Ranges decide only who does the work, so the shards follow from the sums of the sizes before each row.
SHARDING = f"""
    WITH k AS (SELECT {_TABLE} AS crc),
    d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    s AS (SELECT doc_id, (octet_length(encode(t)) + 16)::BIGINT AS size, substr(sha256(t), 1, 15) AS key,
      xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}), lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)])))::BIGINT AS text_crc32
      FROM d, k),
    p AS (SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS r, sum(size) OVER () AS total
      FROM s WINDOW w AS (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
    q AS (SELECT *, least({SHARDS - 1}, ((2 * upto - size) * {SHARDS}) // (2 * total))::INTEGER AS shard FROM p)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY r) - 1 AS slot, NULL::INTEGER AS grown_shard
    FROM q"""

FILTER_AUDIT = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w FROM d),
    good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
    fails AS (SELECT r, part, doc_id IN (FROM good) IS TRUE AS good, doc_id IN (FROM toxic) IS TRUE AS toxic,
      concat(CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
        CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
        CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
        CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
      FROM w),
    sets AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    orders AS (SELECT concat(a.f, b.f, c.f, d.f, e.f) AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
    steps AS (SELECT filter_order, s::INTEGER AS step, filter_order[s] AS f FROM orders, range(1, 6) AS t(s)),
    judged AS (SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS own, failed = f AS alone,
      length(translate(filter_order[1 : step - 1], failed, '')) < step - 1 AS earlier FROM sets, steps),
    counted AS (SELECT part, filter_order, step, f, sum(n) FILTER (NOT own AND NOT earlier) AS kept, sum(n) FILTER (own AND NOT earlier) AS removed,
      sum(n) FILTER (own AND earlier) AS redundant, sum(n) FILTER (alone) AS unique_fails,
      sum(good) FILTER (own AND NOT earlier) AS good_lost, sum(toxic) FILTER (own AND NOT earlier) AS toxic_lost FROM judged GROUP BY ALL)
    SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
      coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
      coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
      coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
    FROM counted"""


def _conversation_repair() -> str:
    """Backward costs b0 to b3 of the four states (nothing, after s, after u, after a), then the least letters forward."""
    insert = lambda own, to: f"least({own}, 2 + {to})"
    kept = {0: "WHEN c = 's' THEN t + b1 WHEN c = 'u' THEN t + b2", 1: "WHEN c = 'u' THEN t + b2", 2: "WHEN c = 'a' THEN t + b3", 3: "WHEN c = 'u' THEN t + b2"}
    row = ", ".join(
        f"least(3 + b{q}, CASE WHEN must THEN 1e9::BIGINT ELSE least(2 + t + b{3 if q == 2 else 2}, CASE {kept[q]} ELSE 1e9::BIGINT END) END) AS e{q}" for q in range(4))
    after = "[n.b0, n.b1, n.b2, n.b3]"
    return rf"""
    WITH RECURSIVE k AS (SELECT {_TABLE} AS crc),
    named AS (SELECT *, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS t FROM conversations),
    hit AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}), lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)]))) % 20 AS fault FROM named, k),
    bad AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, fault,
      CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
      CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text FROM hit),
    r AS (SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, md5(text)) AS i
      FROM bad, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS x(time)),
    f AS (SELECT *, left(role, 1) AS c, NOT regexp_matches(text, '{_WORD}') AS blank,
      row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
      lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS previous FROM r),
    judged AS (SELECT *, blank OR again AS must, (cut AND NOT blank AND NOT again)::BIGINT AS t FROM f),
    ends AS (SELECT g, count(*) AS n FROM judged GROUP BY g),
    b(g, i, b0, b1, b2, b3) AS (SELECT g, n + 1, 0::BIGINT, 4::BIGINT, 2::BIGINT, 0::BIGINT FROM ends UNION ALL
      SELECT g, i, {insert('e0', insert('e2', 'e3'))}, {insert('e1', insert('e2', 'e3'))}, {insert('e2', 'e3')}, {insert('e3', 'e2')}
      FROM (SELECT b.g, judged.i, {row} FROM b JOIN judged ON judged.g = b.g AND judged.i = b.i - 1)),
    steps AS (SELECT a.g, a.i, [a.b0, a.b1, a.b2, a.b3] AS now, {after} AS later, must, t, role, text, c
      FROM b a LEFT JOIN b n ON n.g = a.g AND n.i = a.i + 1 LEFT JOIN judged ON judged.g = a.g AND judged.i = a.i),
    walk(g, i, q, audit, lines) AS (SELECT g, 1::BIGINT, 1, '', []::VARCHAR[] FROM ends UNION ALL
      SELECT g, CASE WHEN letter = 'I' THEN i ELSE i + 1 END, CASE WHEN letter = 'D' THEN q WHEN letter = 'K' THEN CASE c WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END ELSE fits END,
        audit || letter, CASE letter WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
          ELSE list_append(lines, CASE fits WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE letter WHEN 'R' THEN text ELSE '' END) END
      FROM (SELECT walk.*, role, text, c, CASE q WHEN 3 THEN 4 ELSE 3 END AS fits,
          CASE WHEN steps.later[1] IS NOT NULL AND 3 + later[q] = now[q] THEN 'D' WHEN 2 + now[CASE q WHEN 3 THEN 4 ELSE 3 END] = now[q] THEN 'I'
            WHEN NOT must AND ((c = 's' AND q = 1 AND t + later[2] = now[q]) OR (c = 'u' AND q <> 3 AND t + later[3] = now[q]) OR (c = 'a' AND q = 3 AND t + later[4] = now[q])) THEN 'K'
            WHEN must IS NOT NULL THEN 'R' END AS letter
        FROM walk JOIN steps ON steps.g = walk.g AND steps.i = walk.i)
      WHERE letter IS NOT NULL),
    done AS (SELECT walk.g, audit, lines FROM walk JOIN ends ON ends.g = walk.g AND i = n + 1 AND q IN (1, 4) QUALIFY row_number() OVER (PARTITION BY walk.g ORDER BY length(audit)) = 1),
    counted AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
      count(*) FILTER (again AND NOT blank) AS duplicate, sum(t)::BIGINT AS truncated,
      count(*) FILTER (previous IS NOT NULL AND previous || c NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY g)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce(b0, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT g, conv_id FROM bad) LEFT JOIN counted USING (g) LEFT JOIN done USING (g) LEFT JOIN b ON b.g = done.g AND b.i = 1"""


ORACLE_SQL = {
    "op1_warc": WARC,
    "op4_jaccard_join": JACCARD_JOIN,
    "op7_decontaminate": DECONTAMINATE,
    "op10_quality_rules": _quality(),
    "op11_sampled_splitters": SHARDING,
    "op12_conversation_repair": _conversation_repair(),
    "op13_filter_audit": FILTER_AUDIT,
}
