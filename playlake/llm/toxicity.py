"""Severity of toxic text by cumulative-link ordinal regression (operator 2).

P(grade > k) = sigmoid(w . x - theta_k): all thresholds share the weights w and are kept in order. x is sparse
and binary: which words of the learned vocabulary a text holds, however long it is. The result is
the expected severity, the sum of the threshold probabilities.

Training rows are the labelled documents, at most ``MAX_ROWS`` of them (those of the smallest hash of
their doc_id), whose distinct words are counted in Spark. A word enters the vocabulary if the
toxic rows hold it more often and the likelihood ratio passes ``MIN_G2``, the best ``MAX_WORDS`` of
them; so the model broadcast to the tasks is bounded whatever the input. Labels say toxic or
not; the grades of toxic rows follow from how many words of the vocabulary they hold: up to the
lower third of toxic rows 1, up to the upper third 2, else 3.

Edge cases: a null or empty text holds no words, so its severity is that of the bare thresholds. Labels
that are null or name no document are left out; a doc_id with several labels counts as toxic if
any says so. Without a toxic and a clean training row, every text gets severity 0. Only doc_id, text and
toxic are read; each row is scored on its own, so repeated and missing doc_ids are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import store

MAX_ROWS, MAX_WORDS = 20_000, 2_000
MIN_G2 = 20.0
GRADES = 3
#: Expected severity from which a text is rejected.
REJECT = 0.5
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: list[float]

    def severity(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > k) of every text, one column a threshold."""
        get, find = self.weights.get, _WORD.findall
        score = np.array([sum(filter(None, map(get, set(find((t or "").lower()))))) for t in texts], np.float64)
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None] - score[:, None], -40, 40)))


def training_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, toxic, word): the distinct words of each training row."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most MAX_ROWS ids and marks: a bound that lets them be broadcast, so that texts stay where they are
    rows = rows.join(F.broadcast(marks.select("doc_id", F.col("toxic").cast("int").alias("toxic"))), "doc_id")
    rows = rows.withColumn("same", F.xxhash64("text")).dropDuplicates(["same"])  # copies teach once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            for d, text, toxic in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True):
                words = sorted(set(_WORD.findall((text or "").lower()))) or [None]  # a row without words counts too
                n = len(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, d)), pa.array(np.full(n, int(toxic > 0), np.int32)), pa.array(words, pa.string())],
                    ["row", "toxic", "word"],
                )

    return rows.select("doc_id", "text", "toxic").mapInArrow(run, "row long, toxic int, word string")


def _vocabulary(held: DataFrame) -> DataFrame:
    """(word) of the words that toxic rows hold far more often than others, the best MAX_WORDS."""
    sizes = {r["toxic"]: r["n"] for r in held.groupBy("toxic").agg(F.countDistinct("row").alias("n")).collect()}
    t, c = float(sizes[1]), float(sizes[0])
    counts = held.where("word is not null").groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count("*").alias("n"))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, n, all_ = F.col("a").cast("double"), F.col("n").cast("double"), F.lit(t + c)
    g2 = 2 * (
        part(a, n * t / all_) + part(n - a, n * c / all_)
        + part(t - a, (all_ - n) * t / all_) + part(c - (n - a), (all_ - n) * c / all_)
    )
    chosen = counts.where(a / t > n / all_).withColumn("g2", g2).where(F.col("g2") >= MIN_G2)
    return chosen.orderBy(F.desc("g2"), "word").limit(MAX_WORDS).select("word")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the model; what comes to the driver is at most MAX_ROWS rows' share of MAX_WORDS words."""
    held = store(spark, training_words(docs, labels), "words")
    sizes = {r["toxic"] for r in held.select("toxic").distinct().collect()}
    if sizes != {0, 1}:
        return Model({}, [40.0] * GRADES)
    chosen = store(spark, _vocabulary(held), "vocabulary")
    words = [r["word"] for r in chosen.orderBy("word").collect()]
    marked = held.join(F.broadcast(chosen), "word").groupBy("row").agg(F.sort_array(F.collect_list("word")).alias("words"))
    rows = held.select("row", "toxic").distinct().join(marked, "row", "left").toPandas().sort_values(["row", "toxic"])
    place = {w: i for i, w in enumerate(words)}
    index = [np.array([place[w] for w in ws] if ws is not None else [], np.int64) for ws in rows["words"]]
    held_words = np.array([len(i) for i in index])
    toxic = rows["toxic"].to_numpy() == 1
    found = held_words[toxic & (held_words > 0)]
    cuts = np.quantile(found, [1 / 3, 2 / 3]) if len(found) else [0, 0]
    grade = np.where(toxic, 1 + (held_words > cuts[0]) + (held_words > cuts[1]), 0)
    weights, thresholds = fit(index, grade, len(words))
    return Model({w: float(v) for w, v in zip(words, weights, strict=True) if v}, thresholds.tolist())


def fit(index: list[np.ndarray], grade: np.ndarray, n_words: int, steps: int = 800, l2: float = 0.02, l1: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by adaptive gradient steps on all rows' penalised log likelihood.

    The likelihood of grade g is P(> g - 1) - P(> g). Differences of thresholds are kept
    positive through their logarithms. Weights are not negative, since every word of the vocabulary
    marks toxic rows; the l1 share keeps those of idle words near nothing.
    """
    row = np.repeat(np.arange(len(index)), [len(i) for i in index])
    col = np.concatenate([*index, np.empty(0, np.int64)]).astype(np.int64)
    k = GRADES
    n = len(grade)
    w = np.zeros(n_words)
    first, gaps = 2.0, np.zeros(k - 1)
    m_w, v_w, m_t, v_t = np.zeros(n_words), np.zeros(n_words), np.zeros(k), np.zeros(k)
    for step in range(1, steps + 1):
        theta = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        z = np.bincount(row, w[col], n)
        p = 1 / (1 + np.exp(np.clip(theta[None] - z[:, None], -40, 40)))  # P(> k)
        d = p * (1 - p)
        upper = np.concatenate([np.ones((n, 1)), p], 1)[np.arange(n), grade]
        lower = np.concatenate([p, np.zeros((n, 1))], 1)[np.arange(n), grade]
        like = np.maximum(upper - lower, 1e-12)
        d_up = np.concatenate([np.zeros((n, 1)), d], 1)[np.arange(n), grade] / like
        d_low = np.concatenate([d, np.zeros((n, 1))], 1)[np.arange(n), grade] / like
        g_w = np.bincount(col, (d_up - d_low)[row], n_words) - l2 * w - l1
        g_theta = np.array([-(d_up[grade == j + 1]).sum() + d_low[grade == j].sum() for j in range(k)])
        g_t = np.concatenate([[g_theta.sum()], [g_theta[j:].sum() * np.exp(gaps[j - 1]) for j in range(1, k)]])
        rate = 0.1 / (1 + step / 200)
        m_w, v_w = 0.9 * m_w + 0.1 * g_w, 0.999 * v_w + 0.001 * g_w ** 2
        m_t, v_t = 0.9 * m_t + 0.1 * g_t, 0.999 * v_t + 0.001 * g_t ** 2
        fix1, fix2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        w = np.maximum(w + rate * (m_w / fix1) / (np.sqrt(v_w / fix2) + 1e-8), 0)
        move = rate * (m_t / fix1) / (np.sqrt(v_t / fix2) + 1e-8)
        first, gaps = first + move[0], np.clip(gaps + move[1:], -10, 4)
    return np.where(w < 0.01, 0.0, w), first + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, severity, grade, p1, p2, p3, toxic) of every row of docs, with the columns in keep."""
    keep = keep or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.released(W.slices(batches), 4):
            p = model.severity(part.column("text").to_pylist())
            severity = p.sum(1)
            grade = (p >= 0.5).sum(1).astype(np.int32)
            columns = [*(part.column(c) for c in ("doc_id", *keep)), pa.array(severity), pa.array(grade)]
            columns += [pa.array(p[:, k].copy()) for k in range(GRADES)] + [pa.array(severity >= REJECT)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *keep, *_SCORES])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), *keep)
    kept = "".join(f"{rows.schema[c].name} {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(run, f"doc_id long, {kept}severity double, grade int, p1 double, p2 double, p3 double, toxic boolean")


_SCORES = ["severity", "grade", "p1", "p2", "p3", "toxic"]


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose expected severity is below REJECT, all columns as they are."""
    model = train(spark, docs, labels)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    text = names[docs.columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.released(W.slices(batches, text), 4):
            yield part.filter(pa.array(model.severity(part.column(text).to_pylist()).sum(1) < REJECT))

    kept = rows.mapInArrow(run, rows.schema)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
