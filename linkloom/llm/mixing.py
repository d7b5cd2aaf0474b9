"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic) with their tokens. The cells' weights
are raked in turn to the marginals of source, language and topic. A cell's documents are then
kept with a probability in proportion to weight over tokens, calibrated so that the expected
number of tokens is ``keep`` of all and no probability passes 1 (cells that would are kept
whole, and the rest share what is left). Kept rows carry the weight that makes up for that.

Targets: the natural shares raised to ``TEMPER`` and scaled to 1, or shares given per value;
values without a given share split what is left in proportion to their natural shares.

A document is drawn by the hash of its key, so equal keys share their fate and a rerun draws
the same rows. Built-in functions only.

Defined cases: null source, language or text count as ``unknown``, ``unknown`` and no tokens;
cells without tokens are kept whole with weight 1; a null key is hashed as an empty one; an
empty table gives no rows; all input columns pass through, but input columns named like an
output column are replaced.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkloom.llm.common import words_of
from linkloom.scratch import stage

ROUNDS = 10
TOLERANCE = 1e-4
_MOST_PASSES = 100
KEEP = 0.8
TEMPER = {"source": 0.5, "language": 0.7, "topic": 1.0}
SEED = "mix-1"
DIMENSIONS = ("source", "language", "topic")
# A topic is the first whose pattern is found; the last holds the rest.
TOPICS = (
    ("legal", "(?i)licen[sc]e|copyright"),
    ("contact", "@"),
    ("figures", "[0-9]{4}"),
)
REST = "prose"
_FEW_CELLS = 20_000
OUTPUT = ("language", "topic", "n_tokens", "probability", "weight")


def topic_of(text: Column) -> Column:
    out = F.lit(REST)
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def described(key: str, text: str, source: str, lang: str) -> list[Column]:
    """Cell and tokens of a document, and its draw in [0, 1)."""
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{SEED}")))
    return [
        F.coalesce(F.col(source).cast("string"), F.lit("unknown")).alias("_source"),
        F.coalesce(F.col(lang).cast("string"), F.lit("unknown")).alias("_language"),
        topic_of(F.coalesce(F.col(text), F.lit(""))).alias("_topic"),
        F.size(words_of(F.col(text))).cast("long").alias("_tokens"),
        (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(16.0**13)).alias("_draw"),
    ]


def _targets(cells: DataFrame, name: str, power: float, given: dict[str, float] | None) -> DataFrame:
    """Adds ``_to_<name>``, the share the cell's value of that dimension is to have."""
    by, everything = W.partitionBy(f"_{name}"), W.partitionBy()
    own = F.try_divide(F.sum("_tokens").over(by), F.sum("_tokens").over(everything))
    cells = cells.withColumn("_raw", F.pow(own, F.lit(power))).withColumn(
        "_in_value", F.count(F.lit(1)).over(by)
    )
    if given:
        share = F.lit(None).cast("double")
        for value, part in given.items():
            share = F.when(F.col(f"_{name}") == value, F.lit(float(part))).otherwise(share)
        rest = max(0.0, 1.0 - sum(given.values()))
        cells = cells.withColumn("_given", share)
        free = F.when(F.col("_given").isNull(), F.col("_raw") / F.col("_in_value"))
        to = F.coalesce("_given", F.lit(rest) * F.try_divide("_raw", F.sum(free).over(everything)))
        return cells.withColumn(f"_to_{name}", to).drop("_raw", "_in_value", "_given")
    total = F.sum(F.col("_raw") / F.col("_in_value")).over(everything)
    return cells.withColumn(f"_to_{name}", F.try_divide("_raw", total)).drop("_raw", "_in_value")


def rake(cells: DataFrame, rounds: int = ROUNDS, given: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``cells`` (``_source``, ``_language``, ``_topic``, ``_tokens``) with their fitted ``_share``."""
    for name in DIMENSIONS:
        cells = _targets(cells, name, TEMPER[name], (given or {}).get(name))
    out = cells.withColumn("_share", F.try_divide("_tokens", F.sum("_tokens").over(W.partitionBy())))
    return _raked(out, rounds)


def _raked(out: DataFrame, rounds: int) -> DataFrame:
    for _ in range(rounds):
        for name in DIMENSIONS:
            now = F.sum("_share").over(W.partitionBy(f"_{name}"))
            out = out.withColumn(
                "_share", F.when(now > 0, F.col("_share") * F.col(f"_to_{name}") / now).otherwise(0.0)
            )
    return out


def marginal_error(raked: DataFrame) -> float:
    """The largest distance of a marginal share from its target; 0 without cells."""
    most = 0.0
    for name in DIMENSIONS:
        by = raked.groupBy(f"_{name}").agg(F.sum("_share").alias("is"), F.sum("_tokens").alias("n"), F.first(f"_to_{name}").alias("to"))
        most = max(most, by.filter("n > 0").agg(F.max(F.abs(F.col("is") - F.col("to")))).first()[0] or 0.0)
    return most


def rake_until(
    cells: DataFrame,
    tolerance: float,
    rounds: int = ROUNDS,
    given: dict[str, dict[str, float]] | None = None,
    few: bool = True,
) -> DataFrame:
    """As ``rake``, in passes of ``rounds`` until the largest marginal error is within ``tolerance``."""
    out = stage(rake(cells, rounds, given), "raked")
    error = marginal_error(out)
    for _ in range(_MOST_PASSES):
        if error <= tolerance:
            return out
        out = stage(_raked(out.coalesce(1) if few else out, rounds), "raked")
        before, error = error, marginal_error(out)
        if error > 0.999 * before:
            break
    if error > tolerance:
        warnings.warn(f"targets cannot all be met: the largest marginal error is {error:.6f}", stacklevel=2)
    return out


def calibrate(raked: DataFrame, keep: float = KEEP) -> DataFrame:
    """Adds ``_probability`` and ``_weight``: cells fill up in the order of tokens over share."""
    live = (F.col("_tokens") > 0) & (F.col("_share") > 0)
    out = raked.withColumn("_ratio", F.when(live, F.col("_tokens") / F.col("_share")))
    order = W.orderBy(F.col("_ratio").asc_nulls_last(), *[f"_{d}" for d in DIMENSIONS])
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    full = F.coalesce(F.sum("_tokens").over(before), F.lit(0))
    gone = F.coalesce(F.sum("_share").over(before), F.lit(0.0))
    out = out.withColumn(
        "_scale",
        F.try_divide(F.lit(keep) * F.sum("_tokens").over(everything) - full, F.lit(1.0) - gone),
    ).withColumn("_place", F.row_number().over(order))
    fits = F.when(F.col("_scale") <= F.col("_ratio"), F.struct("_place", "_scale"))
    out = out.withColumn("_scale", F.coalesce(F.min(fits).over(everything)["_scale"], F.max("_ratio").over(everything)))
    p = F.least(F.lit(1.0), F.col("_scale") / F.col("_ratio"))
    out = out.withColumn("_probability", F.coalesce(p, F.lit(1.0)))
    return out.withColumn(
        "_weight",
        F.coalesce(F.try_divide(F.col("_scale") / F.col("_ratio"), "_probability"), F.lit(1.0)),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    keep: float = KEEP,
    rounds: int = ROUNDS,
    given: dict[str, dict[str, float]] | None = None,
    with_text: bool = True,
    tolerance: float | None = None,
    repeat: bool = False,
) -> DataFrame:
    """The sampled rows of ``docs`` with cell, tokens, probability and weight.

    Without ``with_text`` the text is left out of the result.
    """
    told = described(key, text, source, lang)
    cells = docs.select(*told).groupBy("_source", "_language", "_topic").agg(F.sum("_tokens").alias("_tokens"))
    cells = stage(cells, "cells")
    few = cells.count() <= _FEW_CELLS
    # Raking totals use windows over all cells (no key), which Spark runs in one task at any cell
    # count; with few cells they are put in one partition first, so no exchange is needed.
    cells = cells.coalesce(1) if few else cells
    raked = rake(cells, rounds, given) if tolerance is None else rake_until(cells, tolerance, rounds, given, few)
    fitted = stage(calibrate(raked.coalesce(1) if few else raked, keep), "fitted")
    fitted = fitted.select("_source", "_language", "_topic", "_probability", "_weight")
    carried = [c for c in docs.columns if c not in OUTPUT and (with_text or c != text)]
    joined = docs.select(*carried, *told).join(F.broadcast(fitted) if few else fitted, ["_source", "_language", "_topic"])
    joined = joined.filter(F.col("_draw") < F.col("_probability"))
    if repeat:
        # A weight above 1 comes with the probability 1, so the draw is still free.
        whole = F.floor("_weight")
        copies = whole + F.when(F.col("_draw") < F.col("_weight") - whole, 1).otherwise(0)
        copies = F.when(F.col("_probability") < 1, F.lit(1)).otherwise(F.greatest(copies, F.lit(1)))
        joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).withColumn("_weight", F.lit(1.0))
    return joined.select(
        *carried,
        F.col("_language").alias("language"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_probability", 6).alias("probability"),
        F.round("_weight", 6).alias("weight"),
    )


def sql(source: str = "documents") -> str:
    """The sample in DuckDB SQL, with natural targets."""
    topic = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps = []
    for name in DIMENSIONS:
        steps.append(f"""own_{name} AS (
  SELECT {name}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {TEMPER[name]}) AS raw
  FROM cells GROUP BY {name}
), to_{name} AS (SELECT {name}, raw / (SELECT sum(raw) FROM own_{name}) AS aim FROM own_{name})""")
    steps.append("s0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS share FROM cells)")
    for k in range(ROUNDS * len(DIMENSIONS)):
        name = DIMENSIONS[k % len(DIMENSIONS)]
        steps.append(f"""s{k + 1} AS MATERIALIZED (
  SELECT s.* REPLACE (CASE WHEN n.total > 0 THEN share * aim / n.total ELSE 0 END AS share)
  FROM s{k} s JOIN to_{name} USING ({name})
  JOIN (SELECT {name}, sum(share) AS total FROM s{k} GROUP BY {name}) n USING ({name}))""")
    last = f"s{ROUNDS * len(DIMENSIONS)}"
    chain = ",\n".join(steps)
    return f"""
WITH told AS (
  SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS language,
         {topic} ELSE '{REST}' END AS topic,
         len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS tokens,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT
           / pow(16.0, 13) AS draw
  FROM (SELECT *, coalesce(text, '') AS t FROM {source})
), cells AS (
  SELECT source, language, topic, sum(tokens)::DOUBLE AS tokens FROM told GROUP BY ALL
), {chain}, ordered AS (
  SELECT *, CASE WHEN tokens > 0 AND share > 0 THEN tokens / share END AS ratio FROM {last}
), filled AS (
  SELECT *, ({KEEP} * sum(tokens) OVER () - coalesce(sum(tokens) OVER b, 0))
            / (1 - coalesce(sum(share) OVER b, 0)) AS scale,
         row_number() OVER (ORDER BY ratio NULLS LAST, source, language, topic) AS place
  FROM ordered WINDOW b AS (ORDER BY ratio NULLS LAST, source, language, topic
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), scaled AS (
  SELECT source, language, topic, ratio,
         coalesce((SELECT arg_min(scale, place) FROM filled WHERE scale <= ratio),
                  (SELECT max(ratio) FROM filled)) AS scale
  FROM filled
), fitted AS (
  SELECT *, coalesce(least(1, scale / ratio), 1) AS p FROM scaled
)
SELECT doc_id, source, language, topic, tokens AS n_tokens, round(p, 6) AS probability,
       round(coalesce(scale / ratio / p, 1), 6) AS weight
FROM told JOIN fitted USING (source, language, topic) WHERE draw < p"""
