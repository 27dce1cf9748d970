"""Language identification with averaged hashed subword embeddings (operator 6).

A text is the average of the embeddings of its subwords: byte grams of ``GRAMS`` lengths over its
lower-cased letters, words set apart by one space, hashed into ``BUCKETS`` rows. A linear softmax
over that average gives the languages. Both are trained by stochastic gradient descent in numpy on at
most ``MAX_ROWS`` labelled rows (those of the smallest hash of their doc_id; equal rows count once), whose subword counts are taken
from whole texts in Spark tasks. The average is linear, so a task needs only each bucket's class scores
(embedding times output weights), a table of fixed size.

Confidence is calibrated on training rows that the fit has not seen: a temperature by likelihood, and
a rejection score, the least above which held-back rows are right ``PRECISION`` of the time.

Edge cases: text that is null or has no letter is ``und`` with score 0. Labels that are null are not
learned; with no labelled row at all every text is ``und``. Rows are predicted one by one,
so repeated and missing doc_ids are kept; a row without doc_id is neither learned from nor held out. Only
doc_id, text and lang are read, and lang in training rows alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import store

BUCKETS, GRAMS, DIMENSION = 1 << 14, (3, 4), 16
MAX_ROWS, EPOCHS, RATE, BATCH = 4_000, 8, 40.0, 64
PRECISION = 0.99
UNKNOWN = "und"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOW = W.rule(lower=True).byte


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every subword of every text."""
    raw, offsets = W.text_buffer(texts)
    n = len(offsets) - 1
    letter = _LETTER[raw]
    # runs of other bytes become one space, and each text is set between spaces
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    of = np.repeat(np.arange(n), np.diff(offsets))[keep]
    byte = np.where(letter, _LOW[raw], 0x20)[keep]
    total = np.concatenate([[0], np.cumsum(keep)])[offsets]
    ends = np.stack([total[:-1], total[1:]], 1).ravel()
    byte = np.insert(byte, ends, 0x20).astype(np.uint32)
    of = np.insert(of, ends, np.repeat(np.arange(n), 2))
    out_of, out_bucket = [], []
    for size in GRAMS:
        m = len(byte) - size + 1
        if m <= 0:
            continue
        value = np.zeros(m, np.uint32)
        for k in range(size):
            value = value * np.uint32(0x01000193) ^ byte[k: k + m]
        # no gram spans two texts, or two words
        ok = of[:m] == of[size - 1:]
        for k in range(1, size - 1):
            ok &= byte[k: k + m] != 0x20
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out_of.append(of[:m][ok])
        out_bucket.append((value[ok] >> np.uint32(18)).astype(np.int64))
    if not out_of:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_of), np.concatenate(out_bucket)


@dataclass
class Model:
    names: list[str]
    scores: np.ndarray  # class scores of every bucket
    bias: np.ndarray
    temperature: float
    reject: float

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of every text."""
        n = len(texts)
        found = has_letter(texts)
        if not self.names:
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        of, bucket = subwords(texts)
        count = np.maximum(np.bincount(of, minlength=n), 1)
        logit = np.stack([np.bincount(of, self.scores[:, c][bucket], n) for c in range(len(self.names))], 1)
        p = softmax((logit / count[:, None] + self.bias) / self.temperature)
        best = p.argmax(1)
        score = np.where(found, p[np.arange(n), best], 0.0)
        return [self.names[b] if f else UNKNOWN for b, f in zip(best, found, strict=True)], score, ~found | (score < self.reject)


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether a text holds a letter of any script."""
    raw, offsets = W.text_buffer(texts)
    plain = np.concatenate([[0], np.cumsum(_LETTER[raw] & (raw < 0x80))])[offsets]
    other = np.concatenate([[0], np.cumsum(raw >= 0x80)])[offsets]
    out = np.diff(plain) > 0
    for i in np.flatnonzero(~out & (np.diff(other) > 0)):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def training_counts(docs: DataFrame, learn: F.Column) -> DataFrame:
    """(doc_id, sig, lang, buckets, counts) of the training rows' subwords: at most MAX_ROWS rows, equal rows once."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).withColumn("sig", F.xxhash64("text", "lang"))
    chosen = rows.select("doc_id", "sig", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id", "sig").limit(MAX_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # at most MAX_ROWS
        for part in W.slices(batches):
            new = []
            for row in zip(part.column("doc_id").to_pylist(), part.column("sig").to_pylist(), strict=True):
                new.append(row not in seen)
                seen.add(row)
            if not any(new):
                continue
            part = part.filter(pa.array(new, pa.bool_()))
            of, bucket = subwords(part.column("text"))
            key, count = np.unique(of * BUCKETS + bucket, return_counts=True)
            bound = np.searchsorted(key, np.arange(part.num_rows + 1) * BUCKETS)
            both = list(zip(bound[:-1], bound[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("sig"), part.column("lang"),
                    pa.array([(key[a:b] % BUCKETS).astype(np.int32) for a, b in both], pa.list_(pa.int32())),
                    pa.array([count[a:b].astype(np.int32) for a, b in both], pa.list_(pa.int32())),
                ],
                ["doc_id", "sig", "lang", "buckets", "counts"],
            )

    own = rows.join(F.broadcast(chosen.select("doc_id", "sig")), ["doc_id", "sig"], "left_semi").select("doc_id", "sig", "lang", "text")
    found = own.mapInArrow(run, "doc_id long, sig long, lang string, buckets array<int>, counts array<int>")
    return found.dropDuplicates(["doc_id", "sig"])


def train(spark: SparkSession, docs: DataFrame, learn: F.Column, seed: int = 7) -> Model:
    """Fit and calibrate on the rows for which ``learn`` holds."""
    rows = store(spark, training_counts(docs, learn), "subwords").toPandas().sort_values(["doc_id", "sig"], ignore_index=True)
    rows = rows[rows["buckets"].map(len) > 0].reset_index(drop=True)
    names = sorted(rows["lang"].unique())
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    label = np.searchsorted(names, rows["lang"].to_numpy(str))
    index = [np.asarray(b, np.int64) for b in rows["buckets"]]
    share = [np.asarray(c, np.float32) / np.sum(c) for c in rows["counts"]]
    held = rng.random(len(rows)) < 0.2
    if held.all() or not held.any():
        held = np.arange(len(rows)) % 5 == 4
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    emb = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    out = np.zeros((DIMENSION, len(names)), np.float32)
    out += rng.normal(0, 0.1, out.shape).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for some in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            at = np.concatenate([index[i] for i in some])
            weight = np.concatenate([share[i] for i in some])
            ends = np.cumsum([0] + [len(index[i]) for i in some])
            mean = np.add.reduceat(emb[at] * weight[:, None], ends[:-1])
            error = softmax(mean @ out + bias)
            error[np.arange(len(some)), label[some]] -= 1
            error /= len(some)
            back = error @ out.T
            np.subtract.at(emb, at, rate * weight[:, None] * np.repeat(back, np.diff(ends), 0))
            out -= 0.05 * rate * mean.T @ error
            bias -= 0.01 * rate * error.sum(0)
    scores = (emb @ out).astype(np.float64)
    check = np.flatnonzero(held) if held.any() else fit
    logit = np.stack([(scores[index[i]] * share[i][:, None]).sum(0) for i in check]) + bias
    own = label[check]
    temperature = min(
        np.geomspace(0.05, 20, 60), key=lambda t: -np.log(softmax(logit / t)[np.arange(len(own)), own] + 1e-12).mean()
    )
    p = softmax(logit / temperature)
    best, top = p.argmax(1), p.max(1)
    order = np.argsort(-top)
    good = np.cumsum((best == own)[order]) / np.arange(1, len(order) + 1) >= PRECISION
    reject = float(top[order][np.flatnonzero(good).max()]) if good.any() else 1.0
    return Model([str(x) for x in names], scores, bias.astype(np.float64), float(temperature), reject)


def predict(docs: DataFrame, model: Model, held_out: F.Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            name, score, rejected = model.predict(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(name, pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Train on documents whose crc32(doc_id) modulo 4 is not 2, and predict all of them."""
    fold = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 4
    model = train(spark, docs, fold != 2)
    return predict(docs, model, F.coalesce(fold == 2, F.lit(False)))
