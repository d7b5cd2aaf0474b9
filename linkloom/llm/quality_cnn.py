"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes move over the UTF-8 bytes of a text in steps of ``STEP``. The text is
covered whole by chunks of ``CHUNK`` bytes that overlap by ``OVERLAP``; each filter is
max-pooled over a chunk, and the mean and the maximum over the chunks go through one logistic
unit, which gives one probability.

Learning takes a bounded sample: at most ``SAMPLE`` documents of each label, chosen by a hash of
their key, of which texts above ``EXCERPT`` characters give one excerpt of that length from a
place set by the hash. Rows held out are never in it. Scoring reads every byte of every text.
Byte embeddings and filters are multiplied out into tables for scoring.

Defined cases: a null or empty text gets the score of no evidence; repeated rows are scored each;
null labels and keys with contradicting labels are not learned from; without labels of both
kinds all scores are the share of label 1 (0.5 without any); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_texts

WIDTH, STEP, DEPTH, FILTERS = 6, 2, 8, 24
CHUNK, OVERLAP = 1024, 64
SAMPLE = {0: 1500, 1: 2500}
EXCERPT = 16_384
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.01, 1e-5
TRAIN_CHUNKS = 4
THRESHOLD = 0.3
FOLDS = 5


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    mean_weight: np.ndarray
    max_weight: np.ndarray
    offset: float

    def score(self, raw: bytes) -> float:
        if not raw:
            return _sigmoid(self.offset)
        total, top, chunks = np.zeros(FILTERS), np.zeros(FILTERS), 0
        piece = (CHUNK - OVERLAP) * 64
        for at in range(0, len(raw), piece):
            part = np.frombuffer(raw[at : at + piece + OVERLAP], np.uint8)
            if at and len(part) <= OVERLAP:
                break  # the chunk before has these bytes
            pooled = np.maximum(self._pooled(part) + self.bias, 0)
            total += pooled.sum(0)
            top = np.maximum(top, pooled.max(0))
            chunks += len(pooled)
        return _sigmoid(self.offset + float(self.mean_weight @ (total / chunks) + self.max_weight @ top))

    def _pooled(self, a: np.ndarray) -> np.ndarray:
        """Each filter's maximum over each chunk of ``a``."""
        places = max(1, -(-(len(a) - WIDTH) // STEP) + 1)  # the last filter reaches the last byte
        a = np.pad(a, (0, max(0, places * STEP + WIDTH - len(a))))
        got = np.full((places + 1, FILTERS), -np.inf, np.float32)
        np.take(self.tables[0], a[: places * STEP : STEP], axis=0, out=got[:places])
        for k in range(1, WIDTH):
            got[:places] += self.tables[k][a[k : k + places * STEP : STEP]]
        begins = np.arange(0, max(1, places - OVERLAP // STEP), (CHUNK - OVERLAP) // STEP)
        ends = np.minimum(begins + CHUNK // STEP, places)
        return np.maximum.reduceat(got, np.stack([begins, ends], 1).ravel(), axis=0)[::2]


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def _chunks(raw: bytes) -> list[np.ndarray]:
    a = np.frombuffer(raw, np.uint8)
    step = CHUNK - OVERLAP
    return [a[s : s + CHUNK] for s in range(0, max(1, len(a) - OVERLAP), step)]


def train(texts: list[bytes], labels: list[int], seed: int = 11) -> Model:
    """Fit on texts and 0/1 labels by Adam on the logistic loss."""
    rng = np.random.default_rng(seed)
    prior = float(np.clip(np.mean(labels), 0.01, 0.99)) if labels else 0.5
    offset = float(np.log(prior / (1 - prior)))
    if len(set(labels)) < 2:
        zero = np.zeros(FILTERS)
        return Model(np.zeros((WIDTH, 256, FILTERS), np.float32), zero, zero, zero, offset)
    size = {"E": (256, DEPTH), "W": (WIDTH * DEPTH, FILTERS), "b": (FILTERS,), "m": (FILTERS,), "x": (FILTERS,), "o": (1,)}
    scale = {"E": 0.5, "W": 0.2, "m": 0.1, "x": 0.1}
    p = {k: (rng.normal(0, scale.get(k, 0), s)).astype(np.float32) for k, s in size.items()}
    p["o"][:] = offset
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    places = (CHUNK - WIDTH) // STEP + 1
    window = np.arange(places)[:, None] * STEP + np.arange(WIDTH)
    all_chunks = [_chunks(t) for t in texts]
    y = np.array(labels, np.float32)
    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            owner, rows = [], []
            for j, d in enumerate(docs):
                own = all_chunks[d]
                for c in rng.permutation(len(own))[:TRAIN_CHUNKS]:
                    owner.append(j)
                    rows.append(np.pad(own[c], (0, CHUNK - len(own[c]))))
            valid = np.array([max(1, (len(r.nonzero()[0]) and int(r.nonzero()[0][-1]) + STEP - WIDTH) // STEP + 1) for r in rows])
            owner, a = np.array(owner), np.stack(rows)[:, window]  # chunk, place, byte
            x = p["E"][a].reshape(len(rows), places, -1)
            z = x @ p["W"]
            z[np.arange(places)[None, :] >= valid[:, None]] = -np.inf
            best = z.argmax(1)  # chunk, filter
            pooled = np.take_along_axis(z, best[:, None, :], 1)[:, 0] + p["b"]
            h = np.maximum(pooled, 0)
            n = np.bincount(owner, minlength=len(docs)).astype(np.float32)
            mean = np.zeros((len(docs), FILTERS), np.float32)
            np.add.at(mean, owner, h)
            mean /= n[:, None]
            top = np.zeros((len(docs), FILTERS), np.float32)
            np.maximum.at(top, owner, h)
            out = mean @ p["m"] + top @ p["x"] + p["o"]
            g = (1 / (1 + np.exp(-out)) - y[docs]) / len(docs)
            dh = g[owner, None] * (p["m"] / n[owner, None] + p["x"] * (h == top[owner]))
            dh = dh * (pooled > 0)
            at_best = np.take_along_axis(x, best[:, :, None], 1)  # chunk, filter, WIDTH * DEPTH
            dx = (dh[:, :, None] * p["W"].T[None]).reshape(-1, WIDTH, DEPTH)
            dE = np.zeros_like(p["E"])
            np.add.at(dE, np.take_along_axis(a, best[:, :, None], 1).reshape(-1, WIDTH), dx)
            grads = {
                "E": dE, "W": np.einsum("cf,cfk->kf", dh, at_best), "b": dh.sum(0),
                "m": mean.T @ g, "x": top.T @ g, "o": np.array([g.sum()], np.float32),
            }
            t += 1
            for k, d in grads.items():
                d = d + DECAY * p[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                p[k] -= RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    filters = p["W"].reshape(WIDTH, DEPTH, FILTERS)
    tables = np.einsum("bd,kdf->kbf", p["E"], filters).astype(np.float32)
    return Model(np.ascontiguousarray(tables), p["b"], p["m"], p["x"], float(p["o"][0]))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    known = known.filter(F.col("_label").isin(0, 1) & F.col("_key").isNotNull() & ~held_out(F.col("_key")))
    known = known.groupBy("_key").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
    known = known.filter(F.col("_label") == F.col("_other")).select("_key", "_label")
    drawn = None
    for value, most in SAMPLE.items():
        part = known.filter(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    length = F.length("_text")
    start = F.pmod(F.xxhash64("_key"), F.greatest(length - EXCERPT, F.lit(1))).cast("int") + 1
    excerpt = F.when(length <= EXCERPT, F.col("_text")).otherwise(
        F.col("_text").substr(start, F.lit(EXCERPT))
    )
    rows = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(drawn), "_key")
        .select("_key", "_label", excerpt.alias("_text"))
        .filter(length > 0)
        .dropDuplicates(["_key"])
        .collect()  # at most the sizes of SAMPLE, each below EXCERPT
    )
    rows.sort(key=lambda r: r["_key"])
    return train([r["_text"].encode("utf-8", "replace") for r in rows], [r["_label"] for r in rows])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``held_out``, ``score`` and ``predicted``."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [model.score((t.as_py() or "").encode("utf-8", "replace")) for t in batch.column(1)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], [key, "score"]
            )

        return step

    out = map_texts(docs, [key, text], f"`{key}` {kind}, score double", make)
    return out.select(
        key,
        held_out(F.col(key)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
