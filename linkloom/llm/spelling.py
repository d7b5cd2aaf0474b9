"""Spelling variants: group words that differ by one edit under the more frequent spelling.

Method, reduced-alphabet generation: every letter is hashed to one of ``SYMBOLS`` symbols, so a
word has a short reduced form. A word's full one-edit neighbourhood *in the reduced alphabet*
(each deletion, each substitution by every symbol, each insertion of every symbol; the reduced
form itself included, since a substitution between two letters of one symbol leaves it as it is)
is generated with SQL higher-order functions and equi-joined with the reduced vocabulary. Two
words one edit apart always have reduced forms one edit apart or equal, so no pair is lost; the
join proposes a few false pairs, which Spark's built-in ``levenshtein`` verifies on the original
strings. Everything runs as DataFrame expressions: no user function, no pair inside a group.

Skew: occurrences are counted with a partial (map-side) aggregate, so a word in a third of all
documents is one row per task before the shuffle. The join sides are distinct words, not
occurrences; a reduced key holds the words that hash to it, and the neighbourhood rows are
``(2 * SYMBOLS + 1) * length + SYMBOLS`` per word, linear in the vocabulary.

Roots: a form has at least twice the count of its word, so a chain has at most log2(max n / 3)
links; pointer doubling resolves it in log2 of that many joins, each written to the shared
scratch folder.

Edge cases (all defined, all tested): a null text or one without letters gives no run; empty
tables give an empty result; repeated rows count once per row; runs keep letters outside A-Z as
they are; ties of the form's count go to the smallest word in code-point order (UTF-8 byte order,
which Spark's string order is); extra input columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.scratch import stage

# Fixed values of the contract: the run pattern, the deletion modulus, the vocabulary bounds.
RUN = "[A-Za-zÀ-ÿ]+"
DELETE_MODULUS = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_FACTOR = 2

#: Size of the reduced alphabet; more symbols, fewer false candidates, longer neighbourhoods.
SYMBOLS = 6
#: Letters a run can hold after A-Z are lower-cased: a-z and U+00C0 to U+00FF.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x100))


def _symbol_of(letter: str) -> str:
    return "0123456789"[zlib.crc32(letter.encode("utf-8")) % SYMBOLS]


REDUCED = "".join(_symbol_of(c) for c in LETTERS)
ALPHABET = "".join(sorted(set(REDUCED)))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, word) of every run of every text, after the contract's deletion rule."""
    lower = F.translate(F.col("run"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(
        F.col("doc_id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(RUN), 0)).alias("run"),
    ).select("doc_id", lower.alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    deleted = F.expr("concat(substring(run, 1, cut), substring(run, cut + 2))")
    return (
        runs.withColumn("h", h)
        .withColumn("cut", (F.col("h") % F.char_length("run")).cast("int"))
        .select("doc_id", F.when(F.col("h") % DELETE_MODULUS == 0, deleted).otherwise(F.col("run")).alias("word"))
    )


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): distinct words of at least MIN_LENGTH code points seen MIN_COUNT times or more."""
    counted = occurrences(docs).filter(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.filter(F.col("n") >= MIN_COUNT)


def reduce_word(word: Column) -> Column:
    return F.translate(word, LETTERS, REDUCED)


def _neighbourhood() -> Column:
    """All strings one edit from column ``r`` in the reduced alphabet, ``r`` itself included."""
    symbols = ", ".join(f"'{s}'" for s in ALPHABET)
    sql = f"""array_distinct(flatten(array(
        array(r),
        transform(sequence(0, char_length(r) - 1), i -> concat(substring(r, 1, i), substring(r, i + 2))),
        flatten(transform(sequence(0, char_length(r) - 1), i ->
            transform(array({symbols}), s -> concat(substring(r, 1, i), s, substring(r, i + 2))))),
        flatten(transform(sequence(0, char_length(r)), i ->
            transform(array({symbols}), s -> concat(substring(r, 1, i), s, substring(r, i + 1)))))
    )))"""
    return F.expr(sql)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every pair of vocabulary words exactly one edit apart, both ways."""
    keyed = words.select("word", "n", reduce_word(F.col("word")).alias("r"))
    probes = keyed.select("word", F.explode(_neighbourhood()).alias("key"))
    targets = keyed.select(F.col("r").alias("key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    joined = probes.join(targets, "key")
    return joined.filter(
        (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    ).select("word", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form) links."""
    now = stage(forms.select("word", F.coalesce("form", "word").alias("to")), "spelling-roots")
    while True:
        jumped = now.alias("a").join(now.alias("b"), F.col("a.to") == F.col("b.word"), "left").select(
            F.col("a.word").alias("word"), F.coalesce(F.col("b.to"), F.col("a.to")).alias("to")
        )
        jumped = stage(jumped, "spelling-roots")
        moved = jumped.alias("x").join(now.alias("y"), "word").filter(F.col("x.to") != F.col("y.to")).limit(1).count()
        now = jumped
        if not moved:
            return now.select("word", F.col("to").alias("root"))


def group_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every vocabulary word of ``docs`` (doc_id, text)."""
    words = stage(vocabulary(docs.select("doc_id", "text")), "spelling-words")
    pairs = near_pairs(words)
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("near"))).alias("best"),
    )
    forms = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.k") >= FORM_FACTOR * F.col("n"), F.col("best.near")).alias("form"),
    )
    forms = stage(forms, "spelling-forms")
    forms = forms.join(words.select(F.col("word").alias("form"), F.col("n").alias("form_n")), "form", "left")
    return forms.join(_roots(forms), "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", F.col("form_n").cast("long").alias("form_n")
    )
