"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover it whole.
Learned filters slide over every byte of a chunk; each filter's largest
response in the chunk, rectified, is averaged over the chunks of the document,
and a logistic unit turns these averages into one probability.

A filter of width w over one-hot bytes is a sum of w table look-ups, so a
convolution is w gathers from tables of 256 rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes per pooling block; a chunk is two blocks, the next starts one later.
BLOCK = 256
WIDTH = 5
FILTERS = 16

#: Bounds of the training sample (labelled documents, chunks of each).
TRAIN_DOCS = 4000
TRAIN_CHUNKS = 8
STEPS = 600
BATCH = 64
RATE = 0.01
DECAY = 1e-4
SEED = 7

#: Bytes convolved at a time, so that responses stay in cache.
SLAB = 1 << 14


@dataclass
class Model:
    tables: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (FILTERS,)
    offset: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every byte; ``data`` has WIDTH - 1 bytes more."""
        n = len(data) - WIDTH + 1
        out = np.take(self.tables[0], data[:n], axis=0)
        for j in range(1, WIDTH):
            out += np.take(self.tables[j], data[j:j + n], axis=0)
        return out


def _padded(data: bytes) -> np.ndarray:
    """Bytes followed by zeros up to whole blocks and the filters' width."""
    blocks = max(2, -(-len(data) // BLOCK))
    out = np.zeros(blocks * BLOCK + WIDTH - 1, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out


def pooled(model: Model, data: bytes) -> np.ndarray:
    """Average over the chunks of each filter's largest response."""
    x = _padded(data)
    n = len(x) - WIDTH + 1
    tops = []
    for k in range(0, n, SLAB):
        z = model.responses(x[k:min(k + SLAB, n) + WIDTH - 1])
        tops.append(z.reshape(-1, BLOCK, FILTERS).max(axis=1))
    top = np.concatenate(tops)
    chunk = np.maximum(top[:-1], top[1:]) + model.bias
    return np.maximum(chunk, 0).mean(axis=0)


def probability(model: Model, text: str | None) -> float:
    """Probability of label 1; null counts as empty, empty as zero bytes."""
    z = float(pooled(model, (text or "").encode("utf-8", "surrogatepass")) @ model.weights + model.offset)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sample_chunks(text: str | None) -> bytes:
    """At most TRAIN_CHUNKS chunks, spread evenly over the whole text."""
    x = _padded((text or "").encode("utf-8", "surrogatepass"))
    starts = np.arange(0, len(x) - WIDTH + 1 - BLOCK, BLOCK)
    if len(starts) > TRAIN_CHUNKS:
        starts = starts[np.linspace(0, len(starts) - 1, TRAIN_CHUNKS).astype(int)]
    size = 2 * BLOCK + WIDTH - 1
    return b"".join(x[s:s + size].tobytes() for s in starts)


def fit(samples: list[bytes], labels: np.ndarray) -> Model:
    """Train by Adam on chunk samples of whole documents."""
    rng = np.random.default_rng(SEED)
    size = 2 * BLOCK + WIDTH - 1
    chunks = [np.frombuffer(s, np.uint8).reshape(-1, size) for s in samples]
    params = [rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
              rng.normal(0, 0.3, FILTERS).astype(np.float32), np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    # both labels weigh the same, however rare one is
    good = float(np.mean(labels))
    weight = np.where(labels > 0, 0.5 / max(good, 1e-6), 0.5 / max(1 - good, 1e-6)).astype(np.float32)
    step = 0
    while step < STEPS:
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), BATCH):
            rate = RATE * max(1 - step / STEPS, 0.0)
            pick = order[at:at + BATCH]
            x = np.concatenate([chunks[i] for i in pick])
            doc = np.repeat(np.arange(len(pick)), [len(chunks[i]) for i in pick])
            per_doc = np.bincount(doc, minlength=len(pick)).astype(np.float32)
            model = Model(*params[:3], float(params[3][0]))
            arg = np.empty((len(x), FILTERS), np.int64)
            top = np.empty((len(x), FILTERS), np.float32)
            for k, row in enumerate(x):
                z = model.responses(row)
                arg[k] = z.argmax(axis=0)
                top[k] = z[arg[k], np.arange(FILTERS)]
            act = np.maximum(top + params[1], 0)
            feats = np.zeros((len(pick), FILTERS), np.float32)
            np.add.at(feats, doc, act / per_doc[doc][:, None])
            p = 1 / (1 + np.exp(-np.clip(feats @ params[2] + params[3][0], -30, 30)))
            err = ((p - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
            d_act = (err[:, None] * params[2])[doc] / per_doc[doc][:, None] * (act > 0)
            d_tab = np.zeros_like(params[0])
            for j in range(WIDTH):
                hit = np.take_along_axis(x, arg + j, axis=1)
                np.add.at(d_tab[j], (hit, np.arange(FILTERS)[None, :]), d_act)
            grads = [d_tab + DECAY * params[0], d_act.sum(axis=0), feats.T @ err, err.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(grads):
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] = (params[k] - rate * (m / (1 - 0.9 ** step))
                             / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Model(params[0], params[1], params[2], float(params[3][0]))


def held_out(id_col: str):
    """The fold that is never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_docs: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``max_docs`` labelled rows outside the held-out fold.

    The rows are those with the smallest hash of their id, so the sample does
    not depend on the order of the input.  Only their chunk samples reach the
    driver (at most ``max_docs`` x TRAIN_CHUNKS x 2 x BLOCK bytes).  Of rows
    that repeat an id one is used, of repeated labels the larger; rows without
    an id or a label teach nothing.  Without a label the model gives 0.5
    everywhere.
    """
    pick = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label"))
            .orderBy(F.xxhash64("_id"), "_id").limit(max_docs))
    cut = F.pandas_udf(lambda s: s.map(sample_chunks), "binary")
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(pick), "_id")  # pick has at most max_docs rows
            .select("_id", "_label", cut("_text").alias("chunks"))
            # of rows that repeat an id one counts, so max_docs rows are collected at most
            .groupBy("_id").agg(F.max("_label").alias("_label"), F.min("chunks").alias("chunks"))
            .orderBy("_id").collect())
    if not rows:
        zero = np.zeros(FILTERS, np.float32)
        return Model(np.zeros((WIDTH, 256, FILTERS), np.float32), zero, zero, 0.0)
    return fit([bytes(r["chunks"]) for r in rows], np.array([float(r["_label"]) for r in rows], np.float32))


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([probability(model, t) for t in batch], dtype="float64")
    return score


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null text counts as empty, and empty ones are scored like any other.
    Rows that repeat an id or a text are each scored; equal texts have equal
    scores.  A null id is in no way special but for its fold.
    """
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        scorer(model)(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns.

    Null, empty and repeated texts are judged by their score as in
    ``classify``; an empty table gives an empty one.
    """
    scored = docs.select(scorer(model)(F.col(text_col)).alias("score"), F.struct("*").alias("row"))
    return scored.where(F.col("score") >= threshold).select("row.*")
