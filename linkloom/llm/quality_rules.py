"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every rule compares two whole-number measures of a text, ``100 * part > percent * whole``,
so no rounding decides. Measures of a null, empty or blank text are 0 and the text fails
``few_words``. Repeated rows each get their own verdict. Columns of the input other than the
text pass through untouched; measures replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import SPACES, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "on", "with", "as", "was", "it",
    "by", "at", "be", "this", "from", "or", "are", "an",
    "der", "die", "das", "und", "von", "zu", "den", "mit", "ist", "ein", "im", "auf", "nicht",
    "für", "des", "sich", "dem",
    "le", "la", "les", "de", "et", "du", "un", "une", "est", "que", "dans", "qui", "au", "sur",
    "pour", "pas", "par",
    "el", "los", "las", "y", "en", "es", "por", "con", "para", "se", "una", "no", "del",
)


@dataclass(frozen=True)
class Rule:
    """A text of at least ``least_words`` words fails if ``part`` is more than ``percent``
    (with ``below``: less than ``percent``) hundredths of ``whole``."""

    name: str
    part: str
    percent: int
    whole: str
    below: bool = False
    least_words: int = 0
    base: bool = False

    def sql(self) -> str:
        sign = "<" if self.below else ">"
        test = f"100 * {self.part} {sign} {self.percent} * {self.whole}"
        return f"(n_words >= {self.least_words} AND {test})" if self.least_words else f"({test})"


RULES = (
    Rule("few_words", "n_words", 2000, "1", below=True, base=True),
    Rule("repeated_words", "n_repeat_words", 30, "n_words", base=True),
    Rule("symbols", "n_symbols", 30, "n_words"),
    Rule("shouting", "n_marks", 50, "n_words"),
    Rule("few_stop_words", "n_stop_words", 2, "n_words", below=True, least_words=50),
    Rule("long_words", "word_chars", 2500, "n_words"),
    Rule("repeated_lines", "n_dup_lines", 50, "n_lines", least_words=20),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_marks", "n_stop_words", "n_lines", "n_dup_lines",
    "n_repeat_words",
)


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _repeat_words(hashes: Column, order: Column) -> Column:
    """Words covered by windows that occur twice or more; ``order`` holds (hash, place) sorted."""

    def same(at: Column, item: Column) -> Column:
        return F.coalesce(F.get(order, at)["h"] == item["h"], F.lit(False))

    found = F.filter(order, lambda x, i: same(i - 1, x) | same(i + 1, x))
    places = F.sort_array(F.transform(found, lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")
        ),
    )["n"]
    measured = F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)
    # A filter on this measure must not be pushed below the projections it is built on: there the
    # hashes would be computed again for each window. A row number, always 0 or more, keeps it above.
    return F.when(F.monotonically_increasing_id() >= 0, measured)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of each text as columns.

    Words are hashed once; a window is the 64-bit hash of its eight word hashes.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in docs.columns if c not in MEASURES]
    words, lines = F.col("_words"), F.col("_lines")
    step = docs.select(
        *keep,
        whole.alias("_whole"),
        words_of(F.col(text)).alias("_words"),
        F.filter(
            F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0
        ).alias("_lines"),
    )
    step = step.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    # The hashes are used more than once, so they stay a column and are not computed again for
    # each element; slice() would copy the whole array for each window.
    windows = F.when(
        F.size("_hashes") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("_windows", windows)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(
        F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    step = step.withColumn("_order", F.when(repeated, pairs))
    return step.select(
        *keep,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate("_whole", SPACES, "")).cast("long").alias("word_chars"),
        _count_of(F.col("_whole"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("_whole"), "!").alias("n_marks"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_windows"), F.col("_order")).cast("long").alias("n_repeat_words"),
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with measures, ``failed`` (names of the rules broken), ``base_failed``, ``kept``."""
    measured = measures(docs, text)
    names = F.array_compact(F.array(*[F.when(F.expr(r.sql()), F.lit(r.name)) for r in rules]))
    base = F.expr(" OR ".join(r.sql() for r in rules if r.base) or "false")
    any_rule = F.expr(" OR ".join(r.sql() for r in rules) or "false")
    return measured.withColumns({"failed": names, "base_failed": base, "kept": ~any_rule})


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that break no rule, with the columns of ``docs``."""
    return judge(docs, text).filter("kept").select(*docs.columns)


def sql(source: str = "documents") -> str:
    """The verdicts in DuckDB SQL."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    following = ", ".join(["w"] + [f"lead(w, {k}) OVER o" for k in range(1, WINDOW)])
    base = " OR ".join(r.sql() for r in RULES if r.base)
    every = " OR ".join(r.sql() for r in RULES)
    return f"""
WITH told AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM {source}
), seen AS (
  SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM told
), windows AS (
  SELECT doc_id, i, concat_ws(' ', {following}) AS w
  FROM seen WINDOW o AS (PARTITION BY doc_id ORDER BY i)
  QUALIFY lead(w, {WINDOW - 1}) OVER o IS NOT NULL
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
  SELECT doc_id, sum(least({WINDOW}, step)) AS n FROM (
    SELECT doc_id, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - {WINDOW}) AS step
    FROM twice) GROUP BY doc_id
), measured AS (
  SELECT t.doc_id, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(whole, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(whole, '[^!]', '', 'g')) AS n_marks,
         len(list_filter(words, lambda w: lower(w) IN ({stop}))) AS n_stop_words,
         list_filter(string_split(whole, chr(10)),
                     lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM told t LEFT JOIN covered c ON c.doc_id = t.doc_id
), ready AS (
  SELECT *, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({base}) AS base_failed, NOT ({every}) AS kept
FROM ready"""
