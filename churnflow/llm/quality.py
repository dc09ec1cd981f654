"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Words are runs of characters other than space and the controls 9 to 13; lines end at line feeds. All
counts cover the whole text. A text without words (null, empty, white space) has zero counts and fails
the word-count rule. Rows are judged one by one, so repeated rows and ties get equal verdicts, an empty
table gives an empty result, and other columns of the input pass through; a column that has the name
of a result column is replaced by it.

Windows of eight words are compared by a 64-bit hash built up from their words' 64-bit hashes, within
one text. Stop words are matched as they stand or capitalised, without punctuation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from churnflow.llm.columns import require

WINDOW = 8  # by three doublings, see ``measure``

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to a in is it that for on with as was by this be are from or at an have not he you but "
    "le la de et les des un une en du que qui dans pour par sur est au avec il ce ne pas se plus "
    "der die das und ist den von zu mit sich auf für als dem nicht ein eine auch es werden aus er "
    "el y los del las por para con no su al lo como más o"
).split()


@dataclass(frozen=True)
class Rule:
    """A bound on one measure; ``base`` rules also count as the base verdict."""

    measure: str
    low: float | None = None
    high: float | None = None
    base: bool = False

    def broken(self, measures: dict[str, str]) -> str:
        value = measures[self.measure]
        sides = [f"{value} < {self.low}D"] if self.low is not None else []
        sides += [f"{value} > {self.high}D"] if self.high is not None else []
        return "(" + " OR ".join(sides) + ")"


RULES = (
    Rule("words", low=20, base=True),
    Rule("repeated_percent", high=30, base=True),
    Rule("mean_word_chars", low=2, high=14),
    Rule("symbols_per_word", high=0.1),
    Rule("exclamations_per_word", high=0.1),
    Rule("capitals_per_char", high=0.4),
    Rule("stop_words_per_word", low=0.04),
    Rule("stutters_per_word", high=0.2),
    Rule("duplicate_lines_per_line", high=0.5),
)

# Each measure over the counted columns; every one is only compared where the base rule holds or fails alone.
_PER_WORD = "(CAST({0} AS DOUBLE) / greatest(n_words, 1))"
MEASURES = {
    "words": "n_words",
    "repeated_percent": "(100D * n_repeat_words / greatest(n_words, 1))",
    "mean_word_chars": _PER_WORD.format("word_chars"),
    "symbols_per_word": _PER_WORD.format("n_symbols"),
    "exclamations_per_word": _PER_WORD.format("n_exclamations"),
    "capitals_per_char": "(CAST(n_capitals AS DOUBLE) / greatest(word_chars, 1))",
    "stop_words_per_word": _PER_WORD.format("n_stop_words"),
    "stutters_per_word": _PER_WORD.format("n_stutters"),
    "duplicate_lines_per_line": "(CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1))",
}

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_exclamations", "n_capitals", "n_stop_words", "n_stutters",
]


def _without(text: str, characters: str) -> str:
    return f"CAST(length({text}) - length(regexp_replace({text}, r'[{characters}]+', '')) AS BIGINT)"


def _rows_of(names: str) -> list[Column]:
    return [F.expr(part.strip()) for part in names.strip().split("\n")]


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents`` with the counts of ``COUNTS``.

    The word list and the window hashes are built once each and then only counted over: every step
    that two others use is a projection of its own.
    """
    require(documents, text)
    kept = [c for c in documents.columns if c not in COUNTS]
    stop_words = ", ".join(f"'{w}'" for w in dict.fromkeys([*STOP_WORDS, *map(str.capitalize, STOP_WORDS)]))
    work = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    work = work.select("row", "t", *_rows_of(r"""
        filter(split(t, r'[\x20\x09-\x0D]+'), w -> w <> '') AS w
        filter(split(t, r'\n'), l -> l rlike r'[^\x20\x09-\x0D]') AS lines"""))
    work = work.select("row", "t", "w", *_rows_of(f"""
        CAST(size(w) AS BIGINT) AS n_words
        CAST(size(lines) AS BIGINT) AS n_lines
        CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines
        transform(w, x -> xxhash64(x)) AS h
        CAST(size(filter(w, x -> x IN ({stop_words}))) AS BIGINT) AS n_stop_words"""))
    work = work.drop("w").withColumn("n_stutters", F.expr("CAST(size(filter(h, (x, i) -> x = get(h, i - 1))) AS BIGINT)"))
    for width in (1, 2, 4):  # hashes of 2, 4, then 8 words, each of two halves; the last ones run past the end
        work = work.withColumn("h", F.expr(f"transform(h, (x, i) -> xxhash64(x, get(h, i + {width})))"))
    work = work.withColumn("windows", F.expr(f"slice(h, 1, greatest(0, size(h) - {WINDOW - 1}))")).drop("h")
    # Nearly all texts have no window twice, and end here with a hash set; the others sort their windows.
    work = work.withColumn("found", F.expr("""
        IF(size(array_distinct(windows)) = size(windows), array(), array_sort(transform(windows, (x, i) -> struct(x AS x, i AS i))))""")).drop("windows")
    work = work.withColumn("starts", F.expr("""
        sort_array(transform(filter(found, (p, j) -> p.x <=> get(found, j - 1).x OR p.x <=> get(found, j + 1).x), p -> p.i))""")).drop("found")
    counted = _rows_of(f"""
        n_words
        {_without("t", r"^\x20\x09-\x0D")} AS word_chars
        {_without("t", r"#*$%&|<>")} AS n_symbols
        n_dup_lines
        CAST(aggregate(transform(starts, (s, j) -> least({WINDOW}, coalesce(get(starts, j + 1), s + {WINDOW}) - s)), 0, (a, x) -> a + x) AS BIGINT) AS n_repeat_words
        n_lines
        {_without("t", "!")} AS n_exclamations
        {_without("t", "A-ZÀ-ÖØ-Þ")} AS n_capitals
        n_stop_words
        n_stutters""")
    # A filter on a count stops at a generator. Pushed below the projections it would be taken apart into them,
    # and each step would be written out as often as all later ones use it.
    work = work.select("row", F.inline(F.array(F.struct(*[c.alias(n) for c, n in zip(counted, COUNTS, strict=True)]))))
    return work.select("row.*", *COUNTS)


def judge(documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measure`` plus ``base_failed`` and ``kept``: true where no rule at all is broken."""
    measured = measure(documents, text)
    measured = measured.drop("base_failed", "kept")
    base = " OR ".join(r.broken(MEASURES) for r in rules if r.base) or "false"
    every = " OR ".join(r.broken(MEASURES) for r in rules) or "false"
    return measured.select("*", F.expr(base).alias("base_failed"), F.expr(f"NOT ({every})").alias("kept"))


def keep_good(documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that break no rule, with their own columns only."""
    judged = judge(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"), F.col(f"`{text}`").alias("text")), "text", rules)
    return judged.filter("kept").select("document.*")
