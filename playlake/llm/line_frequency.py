"""Quality rules with cross-document line frequency (operator 7).

Lines are normalised (words lower-cased in A-Z and joined by one space) and hashed. For each host, here
the source of a document, the distinct documents that hold a line are counted; copies of one text
count once, so a repeated document does not turn its own lines into boilerplate. Lines held by more than
``SHARE`` of a host's documents, and by more than ``LEAST``, are removed. A document that loses more than
``DEPLETED`` of its words is rejected, as is one that fails the base rules (too few words, or too
many words in repeated 5-word windows).

Edge cases: a null or empty text has no words and no lines and fails the base rules. A null source is a host of
its own. Rows that repeat a doc_id, or lack one, are rows of their own, told apart by partition and row
number. Only doc_id, text and source are read, whatever other columns are named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import store

SHARE, LEAST = 0.01, 10
DEPLETED = 0.5
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
WINDOW = 5
_RULE, _LOWER = W.rule(), W.rule(lower=True)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_COLUMNS = ["row", "doc_id", "host", "sig", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line", "words"]
_SCHEMA = (
    "row long, doc_id long, host long, sig long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, line long, words int"
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _grouped(of: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): an order by text and value, stable, and where in it a new value begins."""
    order = np.lexsort((value, of))
    new = np.ones(len(order), bool)
    new[1:] = (value[order][1:] != value[order][:-1]) | (of[order][1:] != of[order][:-1])
    return order, new


def _repeat_words(words: W.Words) -> np.ndarray:
    """Words of each text inside windows that the text holds twice or more."""
    at = W.window_starts(words, WINDOW)
    if not len(at):
        return np.zeros(len(words.first) - 1, np.int64)
    of = words.text_of()
    order, new = _grouped(of[at], W.window_hashes(W.hashes(words), WINDOW)[at])
    group = np.cumsum(new) - 1
    twice = np.bincount(group)[group] > 1
    mark = np.zeros(len(words) + 1, np.int64)
    begin = at[order[twice]]
    np.add.at(mark, begin, 1)
    np.add.at(mark, begin + WINDOW, -1)
    return np.bincount(of[np.cumsum(mark[:-1]) > 0], minlength=len(words.first) - 1)


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash as written, hash normalised, words) of every line that has a word."""
    low = W.split(texts, _LOWER)
    breaks = np.flatnonzero(low.raw == 0x0A)
    starts = np.unique(np.concatenate([low.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(low.raw)]
    ends = np.append(starts[1:], len(low.raw))
    of = np.searchsorted(low.offsets, starts, "right") - 1
    ends = np.minimum(ends - (low.raw[ends - 1] == 0x0A), low.offsets[of + 1]) if len(ends) else ends
    first, last = np.searchsorted(low.start, starts), np.searchsorted(low.start, ends)
    own = last > first
    of, starts, ends, first, last = of[own], starts[own], ends[own], first[own], last[own]
    line = W.Words(low.raw, low.offsets, starts, ends, np.searchsorted(starts, low.offsets), _RULE)
    h = W.hashes(low)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * W.powers(len(h), W._MUL))])
    back = W.powers(len(h) + 1, W._INV)
    normal = W.mix((total[last] - total[first]) * back[first] + (last - first).astype(np.uint64))
    return of, W.hashes(line), normal, (last - first).astype(np.int32)


def statistics(docs: DataFrame) -> DataFrame:
    """One row for each row of docs with its base figures, and one for each of its distinct lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 40
        for part in W.slices(batches):
            n = part.num_rows
            texts = part.column("text")
            words = W.split(texts, _RULE)
            raw, offsets = words.raw, words.offsets
            chars = words.rule.inside[raw] & ((raw & 0xC0) != 0x80)
            of, exact, normal, count = _lines(texts)
            order, new = _grouped(of, exact)
            dup = np.bincount(of[order[~new]], minlength=n)
            rows = np.arange(row, row + n)
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows), part.column("doc_id"), part.column("host"), part.column("sig"),
                    *(
                        pa.array(x.astype(np.int64))
                        for x in (np.diff(words.first), _per_text(chars, offsets), _per_text(_SYMBOL[raw], offsets), dup, _repeat_words(words))
                    ),
                    none, pa.nulls(n, pa.int32()),
                ],
                _COLUMNS,
            )
            order, new = _grouped(of, normal)
            head = order[new]
            sums = np.add.reduceat(count[order], np.flatnonzero(new)) if len(order) else np.empty(0, np.int64)
            none = pa.nulls(len(head), pa.int64())
            host, sig = (part.column(c).to_numpy(zero_copy_only=False)[of[head]] for c in ("host", "sig"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[of[head]]), none, pa.array(host), pa.array(sig), none, none, none, none, none,
                    pa.array(normal[head].view(np.int64)), pa.array(sums.astype(np.int32)),
                ],
                _COLUMNS,
            )
            row += n

    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"),
        F.xxhash64("source").alias("host"), F.xxhash64("text").alias("sig"),
    )
    return rows.mapInArrow(run, _SCHEMA)


def frequent_lines(stats: DataFrame) -> DataFrame:
    """(host, line, n_docs) of the lines that too many distinct documents of a host hold."""
    sizes = stats.where("line is null").groupBy("host").agg(F.count_distinct("sig").alias("n_host"))
    counts = stats.where("line is not null").select("host", "line", "sig").distinct()
    counts = counts.groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > LEAST)
    return counts.join(sizes, "host").where(F.col("n_docs") > SHARE * F.col("n_host")).select("host", "line", "n_docs")


def quality(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed_words)."""
    stats = store(spark, statistics(docs), "lines")
    frequent = store(spark, frequent_lines(stats), "frequent")
    lines = stats.where("line is not null").select("row", "host", "line", "words")
    removed = lines.join(frequent, ["host", "line"]).groupBy("row").agg(F.sum("words").alias("removed"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    n_removed = F.coalesce("removed", F.lit(0)).cast("long")
    return (
        stats.where("line is null")
        .join(removed, "row", "left")
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
            (~base_failed & (n_removed <= DEPLETED * F.col("n_words"))).alias("kept"), n_removed.alias("n_removed_words"),
        )
    )
