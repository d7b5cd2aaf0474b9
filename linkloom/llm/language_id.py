"""Language identification with hyperdimensional profiles.

Method: every letter gets a random bipolar vector of ``DIMENSIONS`` components, drawn from a
generator seeded by (``SEED``, code point), so all tasks agree without a shared table. A letter
trigram (a, b, c) is bound into one vector, rho^2(A) * rho(B) * C, where rho rotates by one place
and * multiplies componentwise; a text's profile bundles (adds) the vectors of all its trigrams,
counted with repetition. A language's prototype bundles the unit profiles of its training texts.
A text is given the language whose prototype is nearest by cosine.

Text: lower-cased; every run of characters that are not letters (Unicode, ``str.isalpha``)
becomes one space, and the text is framed by spaces, so word edges are trigrams too.

Spark: training texts (crc32 of doc_id as text mod 4 is not 2, lang not null) are profiled in
Arrow batches; each task adds its profiles by language and emits one vector per language, which a
grouped sum over (lang, component) merges. The prototypes (languages x DIMENSIONS doubles, checked
below ``MAX_PROTOTYPE_BYTES``) travel to the scoring tasks with the function. Scoring reads each
text once; no shuffle of texts. Nothing is capped: every training text counts, whole.

Defined cases: null or letter-free text gives lang_pred ``und`` and score 0.0 (and teaches
nothing); a training text with null lang teaches nothing; a table with no training text predicts
``und`` everywhere; ties of cosine go to the smallest lang value; score is the best cosine,
clipped to [0, 1]. Repeated rows count as often as they appear; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 512
SEED = 20240611
N = 3
#: Largest prototype table sent to the scoring tasks.
MAX_PROTOTYPE_BYTES = 64 << 20
HELD_OUT_MODULUS, HELD_OUT_REST = 4, 2
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Letters of the Basic Multilingual Plane as a lookup table; other planes go through ``re``.
_BMP_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)], dtype=bool)
_SPACE = np.uint32(32)
#: Cells of the (pairs x letters) count matrix built at once.
_CELLS = 1 << 20


class Profiler:
    """Profiles of texts; letter vectors are made on first use and kept for the task."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.points = np.zeros(0, dtype=np.uint32)
        self.plain = np.zeros((0, dimensions), dtype=np.float32)

    def _letters(self, points: np.ndarray) -> None:
        new = np.setdiff1d(points, self.points)
        if not len(new):
            return
        made = [
            (np.random.default_rng([self.seed, int(p)]).integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1)
            for p in new
        ]
        points = np.concatenate([self.points, new])
        plain = np.concatenate([self.plain, np.asarray(made, dtype=np.float32)]).astype(np.float32)
        order = np.argsort(points)
        self.points, self.plain = points[order], plain[order]
        self.once = np.roll(self.plain, 1, axis=1)
        self.twice = np.roll(self.plain, 2, axis=1)

    def profile(self, text: str | None) -> np.ndarray | None:
        """The bundled trigram vector of ``text``; None without a letter."""
        if not text:
            return None
        points = self._normal(text.lower())
        if points is None:
            return None
        present = np.unique(points)
        self._letters(present)
        rows = np.searchsorted(self.points, present)  # rows of the letter tables
        local = np.searchsorted(present, points).astype(np.int64)
        k = len(present)
        grams, counts = np.unique((local[:-2] * k + local[1:-1]) * k + local[2:], return_counts=True)
        # Bundle by the first two letters: sum_ab rho2(A) rho(B) (sum_c n_abc C). The inner sums
        # are one matrix product (pairs x letters) @ (letters x dimensions).
        pair, third = grams // k, grams % k
        pairs, starts = np.unique(pair, return_index=True)
        ends = np.append(starts[1:], len(grams))
        plain = self.plain[rows]
        out = np.zeros(self.dimensions, dtype=np.float64)
        step = max(1, _CELLS // k)
        for lo in range(0, len(pairs), step):
            hi = min(lo + step, len(pairs))
            first, last = starts[lo], ends[hi - 1]
            counts_by_pair = np.zeros((hi - lo, k), dtype=np.float32)
            owner = np.repeat(np.arange(hi - lo), ends[lo:hi] - starts[lo:hi])
            counts_by_pair[owner, third[first:last]] = counts[first:last]
            inner = counts_by_pair @ plain
            a, b = rows[pairs[lo:hi] // k], rows[pairs[lo:hi] % k]
            out += (self.twice[a] * self.once[b] * inner).sum(axis=0, dtype=np.float64)
        return out

    @staticmethod
    def _normal(lower: str) -> np.ndarray | None:
        """Code points of ``lower`` with runs of non-letters as one space, framed by spaces."""
        points = np.frombuffer(lower.encode("utf-32-le"), dtype=np.uint32)
        if len(points) and points.max() >= 0x10000:
            points = np.frombuffer(_NOT_LETTERS.sub(" ", lower).encode("utf-32-le"), dtype=np.uint32)
            letter = points != _SPACE
        else:
            letter = _BMP_LETTER[points]
        if not letter.any():
            return None
        points = np.where(letter, points, _SPACE)
        after_letter = np.concatenate([[False], letter[:-1]])
        points = points[letter | after_letter]  # a letter, or the first space after one
        if points[-1] == _SPACE:
            points = points[:-1]
        return np.concatenate([[_SPACE], points, [_SPACE]]).astype(np.uint32)


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MODULUS == HELD_OUT_REST


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    profiler, sums = Profiler(), {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            vector = profiler.profile(text)
            if vector is None:
                continue
            norm = np.linalg.norm(vector)
            if norm > 0:
                sums[lang] = sums.get(lang, 0) + vector / norm
    if sums:
        langs = list(sums)
        yield pa.RecordBatch.from_pydict(
            {"lang": langs, "vector": [sums[lang].tolist() for lang in langs]},
            schema=pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.float64()))]),
        )


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes by language from all training texts of ``docs`` (doc_id, text, lang)."""
    train = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    partial = train.select("text", "lang").mapInArrow(_sums, "lang string, vector array<double>")
    merged = (
        partial.select("lang", F.posexplode("vector").alias("pos", "x"))
        .groupBy("lang", "pos")
        .agg(F.sum("x").alias("x"))
    )
    n_langs = merged.select("lang").distinct().count()
    if n_langs * DIMENSIONS * 8 > MAX_PROTOTYPE_BYTES:
        raise ValueError(f"{n_langs} languages: prototypes above {MAX_PROTOTYPE_BYTES} bytes")
    prototypes: dict[str, np.ndarray] = {}
    for lang, pos, x in merged.collect():
        prototypes.setdefault(lang, np.zeros(DIMENSIONS))[pos] = x
    return prototypes


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    langs = sorted(prototypes)
    table = np.array([prototypes[lang] for lang in langs]).reshape(len(langs), DIMENSIONS)
    norms = np.linalg.norm(table, axis=1)
    unit = table / np.where(norms > 0, norms, 1)[:, None]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler()
        for batch in batches:
            preds, scores = [], []
            for text in batch.column("text").to_pylist():
                vector = profiler.profile(text)
                norm = 0.0 if vector is None else np.linalg.norm(vector)
                if not langs or norm == 0:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = unit @ (vector / norm)
                best = int(np.argmax(cosines))  # first of equal ones: the smallest lang
                preds.append(langs[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    scored = docs.select("doc_id", "text").mapInArrow(work, "doc_id long, lang_pred string, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def identify(docs: DataFrame) -> DataFrame:
    """Learn prototypes from the training rows of ``docs`` and predict every row."""
    return predict(docs, learn(docs))
