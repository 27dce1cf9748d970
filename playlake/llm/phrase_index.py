"""Benchmark decontamination over a distributed positional inverted index (operator 8).

``build_index`` stores the postings of the corpus: a row holds the positions of one term in one
block of documents, as differences of word numbers, and each block has a directory of its
documents. The index is written without a shuffle, in blocks of bounded size, and every term
of every text is in it.

``matches`` takes test phrases and intersects offset-adjusted lists. The rarest terms of a phrase
come first: its two rarest terms (by their counts over the whole index) give candidate places in
each block; the other terms' lists are only read in blocks that still have a candidate, once a
block. Exact phrases need every term at its offset in one text; proximity needs every term inside
``span`` consecutive words of one text, in any order.

``decontaminate`` cuts benchmark items into windows, looks them up and marks the words they hit.

Edge cases: null or empty texts have no words and are never hit; an item without words has no
window; an item of fewer words than a window is one window. Equal windows are looked up once.
Rows that repeat a doc_id or lack one keep rows of their own in the index, told apart by their place
in a block, so each row gets its own result. Only doc_id, item_id and text are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import store

WINDOW = 10
#: Size of an index block, in slices.
SCALE = 3
#: Phrases that are looked up at a time. They hold at most so many terms, which bounds what is broadcast.
PHRASES = 20_000
_RULE = W.rule(W.ALNUM, lower=True)
_INDEX = "block long, term binary, n int, positions binary"
_COLUMNS = ["block", "term", "n", "positions"]
#: A document in a block's directory.
_ENTRY = np.dtype([("doc_id", "<i8"), ("named", "<i8"), ("sig", "<i8"), ("n_words", "<i8")])


def build_index(docs: DataFrame) -> DataFrame:
    """(block, term, n, positions) of all words of docs (doc_id, text).

    Positions are int32 differences of word numbers in the block. The directory of a block has
    a null term, one ``_ENTRY`` for each document as positions, and their number as n.
    A block is one slice of one task, named by both, and so the same in a retried task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        block = (task.partitionId() if task else 0) << 32
        for part in W.released(W.slices(batches, scale=SCALE), 2):
            words = W.split(part.column("text"), _RULE)
            coded = words.values().dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable").astype(np.int32)
            count = np.bincount(code, minlength=len(coded.dictionary)).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(count)])
            step = np.diff(order, prepend=np.int32(0)).astype("<i4")
            step[ends[:-1]] = order[ends[:-1]]
            lists = pa.Array.from_buffers(
                pa.large_binary(), len(count), [None, pa.py_buffer(ends * 4), pa.py_buffer(step)]
            )
            ids = part.column("doc_id")
            directory = np.zeros(part.num_rows, _ENTRY)
            directory["doc_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            directory["named"] = ids.is_valid().to_numpy(zero_copy_only=False)
            directory["sig"] = part.column("sig").to_numpy(zero_copy_only=False)
            directory["n_words"] = np.diff(words.first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int64()), pa.array([None], pa.binary()),
                    pa.array([part.num_rows], pa.int32()), pa.array([directory.tobytes()], pa.binary()),
                ],
                _COLUMNS,
            )
            if len(count):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(count), block)), coded.dictionary.cast(pa.binary()),
                        pa.array(count.astype(np.int32)), lists.cast(pa.binary()),
                    ],
                    _COLUMNS,
                )
            block += 1

    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("sig")
    )
    return rows.mapInArrow(run, _INDEX)


def documents_of(index: DataFrame) -> DataFrame:
    """(block, ord, doc_id, sig, n_words) of every document of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("positions").to_pylist(), strict=True):
                entry = np.frombuffer(raw, _ENTRY)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(entry), block)), pa.array(np.arange(len(entry), dtype=np.int32)),
                        pa.array(entry["doc_id"].copy(), mask=entry["named"] == 0), pa.array(entry["sig"].copy()),
                        pa.array(entry["n_words"].copy()),
                    ],
                    ["block", "ord", "doc_id", "sig", "n_words"],
                )

    heads = index.where("term is null").select("block", "positions")
    return heads.mapInArrow(run, "block long, ord int, doc_id long, sig long, n_words long")


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, phrase, terms) of every distinct window of every item."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    cut = items.select("item_id", words.alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    rows = cut.select("item_id", "w", F.explode(starts).alias("i"))
    rows = rows.select("item_id", F.slice("w", F.col("i"), size).alias("terms")).distinct()
    return rows.select("item_id", F.sha2(F.array_join("terms", " "), 256).alias("phrase"), "terms")


def _rarest(lists: DataFrame, phrases: DataFrame, terms: DataFrame) -> DataFrame:
    """phrases with their two rarest terms: t1 at offset o1, and t2, ``gap`` words after t1.

    A phrase that repeats one word has no t2. Phrases with a term that the index lacks are gone.
    """
    listed = phrases.select("phrase", F.posexplode("terms").alias("at", "term"))
    listed = listed.groupBy("phrase", F.col("term").cast("binary").alias("term")).agg(F.min("at").alias("at"))
    counts = lists.join(F.broadcast(terms), "term").groupBy("term").agg(F.sum("n").alias("total"))
    rank = F.row_number().over(Window.partitionBy("phrase").orderBy(F.col("total").asc_nulls_first(), "at"))
    ranked = listed.join(counts, "term", "left").withColumn("rank", rank).where("rank <= 2")
    two = ranked.groupBy("phrase").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("term", "at", "total"))).alias("a"),
        F.max(F.when(F.col("rank") == 2, F.struct("term", "at"))).alias("b"),
    )
    return (
        two.where("a.total is not null")
        .join(phrases, "phrase")
        .select(
            "phrase", "terms", F.col("a.term").alias("t1"), F.col("a.at").alias("o1"), F.col("b.term").alias("t2"),
            (F.col("b.at") - F.col("a.at")).alias("gap"),
        )
    )


def _word_numbers(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i4"), dtype=np.int64)


def _candidates(lists: DataFrame, pairs: DataFrame, span: int | None) -> DataFrame:
    """(t1, t2, gap, block, places): where in a block t1 has t2 at its gap, or near it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            places = []
            for p1, p2, gap in zip(x["p1"], x["p2"], x["gap"], strict=True):
                own = _word_numbers(p1)
                if p2 is not None:
                    other = _word_numbers(p2)
                    if span is None:
                        own = own[np.isin(own + int(gap), other, assume_unique=True)]
                    else:
                        own = own[np.searchsorted(other, own - span, "right") < np.searchsorted(other, own + span)]
                places.append(own.astype("<i8").tobytes() if len(own) else None)
            x = x[["t1", "t2", "gap", "block"]].assign(places=places)
            yield x[x["places"].notna()]

    pairs = F.broadcast(pairs)
    one = lists.select(F.col("term").alias("t1"), "block", F.col("positions").alias("p1")).join(pairs, "t1")
    alone = one.where("t2 is null").select("t1", "t2", "gap", "block", "p1", F.lit(None).cast("binary").alias("p2"))
    other = lists.select(F.col("term").alias("t2"), "block", F.col("positions").alias("p2")).join(pairs, "t2")
    two = one.where("t2 is not null").join(other, ["t1", "t2", "gap", "block"])
    both = alone.union(two.select("t1", "t2", "gap", "block", "p1", "p2"))
    return both.mapInPandas(run, "t1 binary, t2 binary, gap int, block long, places binary")


def _exact(x: pd.DataFrame, code_at: np.ndarray, text_at: np.ndarray, codes: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(row, starts) of the phrases whose terms all stand at their offsets in one text."""
    for k, (terms, o1, places) in enumerate(zip(x["terms"], x["o1"], x["places"], strict=True)):
        want = np.array([codes.get(t.encode(), -1) for t in terms])
        starts = np.frombuffer(places, "<i8") - int(o1)
        starts = starts[(starts >= 0) & (starts + len(want) <= len(code_at))]
        ok = text_at[starts] == text_at[starts + len(want) - 1]
        for j, code in enumerate(want):
            ok &= code_at[starts + j] == code
        if (want >= 0).all() and ok.any():
            yield k, starts[ok]


def _near(x: pd.DataFrame, lists: dict, text_at: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, places) of rarest-term places inside ``span`` words of one text that hold every term."""
    n = len(text_at)
    first = np.searchsorted(text_at, text_at)
    last = np.searchsorted(text_at, text_at, "right")
    for k, (terms, places) in enumerate(zip(x["terms"], x["places"], strict=True)):
        held = [lists.get(t.encode()) for t in set(terms)]
        if any(h is None for h in held):
            continue
        at = np.frombuffer(places, "<i8")
        found = np.zeros(len(at), bool)
        for back in range(span):
            low = np.maximum(at - back, first[at])
            high = np.minimum(low + span, last[at])
            ok = np.ones(len(at), bool)
            for h in held:
                ok &= np.searchsorted(h, low) < np.searchsorted(h, np.minimum(high, n))
            found |= ok
        if found.any():
            yield k, at[found]


def matches(spark: SparkSession, index: DataFrame, phrases: DataFrame, span: int | None = None) -> DataFrame:
    """(block, ord, ranges, phrases) of every document that holds a phrase (phrase, terms).

    Exact phrases if span is None: ranges are the document's words inside any occurrence, each
    ``first * 2**32 + last + 1``. Else proximity: ranges are the places of rarest terms around which all
    terms lie in span words. At most ``PHRASES`` phrases are asked for at a time.
    """
    blocks = max(1, -(-phrases.count() // PHRASES))
    found = None
    for k in range(blocks):
        some = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k)
        part = store(spark, _matches(spark, index, some, span), "matches")
        found = part if found is None else found.unionByName(part)
    return found


def _matches(spark: SparkSession, index: DataFrame, phrases: DataFrame, span: int | None) -> DataFrame:
    terms = phrases.select(F.explode("terms").alias("term")).distinct().select(F.col("term").cast("binary").alias("term"))
    lists = index.where("term is not null")
    rare = store(spark, _rarest(lists, phrases, terms), "rarest")
    pairs = rare.select("t1", "t2", "gap").distinct()
    found = store(spark, _candidates(lists, pairs, span), "candidates")
    same = rare["t1"].eqNullSafe(found["t1"]) & rare["t2"].eqNullSafe(found["t2"]) & rare["gap"].eqNullSafe(found["gap"])
    asked = found.join(F.broadcast(rare), same).select("block", "phrase", "terms", "o1", "places")
    # the lists of every term asked for in a block, and the block's directory
    need = asked.select("block", F.explode("terms").alias("term")).distinct()
    need = need.select("block", F.col("term").cast("binary").alias("term"))
    # need has no repeats; a semi join would be moved below the broadcast one, and shuffle the whole index
    held = lists.join(F.broadcast(terms), "term").join(need, ["block", "term"])
    held = held.select("block", "term", "positions")
    heads = index.where("term is null").select("block", "term", "positions")
    held = held.unionByName(heads.join(need.select("block").distinct(), "block", "left_semi"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        head = right["term"].isna()
        if not len(left) or not head.any():
            return pd.DataFrame(columns=["block", "ord", "ranges", "phrases"])
        entry = np.frombuffer(right["positions"][head].iat[0], _ENTRY)
        first = np.concatenate([[0], np.cumsum(entry["n_words"])])
        text_at = np.repeat(np.arange(len(entry)), entry["n_words"])
        numbers = {t: _word_numbers(p) for t, p in zip(right["term"][~head], right["positions"][~head], strict=True)}
        hit = np.zeros(len(text_at) + 1, np.int64)
        named: dict[int, set[str]] = {}
        if span is None:
            code_at = np.full(len(text_at), -1, np.int32)
            codes = {t: c for c, t in enumerate(numbers)}
            for t, p in numbers.items():
                code_at[p] = codes[t]
            got = _exact(left, code_at, text_at, codes)
        else:
            got = _near(left, numbers, text_at, span)
        for k, starts in got:
            np.add.at(hit, starts, 1)
            np.add.at(hit, starts + (len(left["terms"].iat[k]) if span is None else 1), -1)
            for t in np.unique(text_at[starts]):
                named.setdefault(int(t), set()).add(left["phrase"].iat[k])
        inside = np.cumsum(hit[:-1]) > 0
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # neighbouring hits of two texts are one run here, and are cut at the border
        out = []
        for t, p in named.items():
            a, b = first[t], first[t + 1]
            lo, hi = np.searchsorted(end, a, "right"), np.searchsorted(begin, b)
            runs = (np.maximum(begin[lo:hi], a) - a << 32) + np.minimum(end[lo:hi], b) - a
            out.append((left["block"].iat[0], t, runs.tolist(), sorted(p)))
        return pd.DataFrame(out, columns=["block", "ord", "ranges", "phrases"])

    return (
        asked.groupBy("block")
        .cogroup(held.groupBy("block"))
        .applyInPandas(run, "block long, ord int, ranges array<bigint>, phrases array<string>")
    )


def _covered(ranges: DataFrame) -> DataFrame:
    """(block, ord, n_hit): words of a document inside any of its ranges."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            n = []
            for parts in x["parts"]:
                runs = np.sort(np.concatenate([np.asarray(p, np.int64) for p in parts]))
                begin, end = runs >> 32, np.maximum.accumulate(runs & 0xFFFFFFFF)
                reached = np.concatenate([[0], end[:-1]])
                n.append(int(np.maximum(end - np.maximum(begin, reached), 0).sum()))
            yield x[["block", "ord"]].assign(n_hit=n)

    parts = ranges.groupBy("block", "ord").agg(F.collect_list("ranges").alias("parts"))
    return parts.mapInPandas(run, "block long, ord int, n_hit long")


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, sig) of every row of docs.

    sig is xxhash64 of the text, which tells rows of one doc_id apart.
    """
    index = store(spark, build_index(docs), "index")
    windows = store(spark, windows_of(items, size), "windows")
    found = matches(spark, index, windows.select("phrase", "terms").dropDuplicates(["phrase"]))
    listed = (
        found.select("block", "ord", F.explode("phrases").alias("phrase"))
        .join(windows.select("phrase", "item_id"), "phrase")
        .select("block", "ord", F.col("item_id").cast("string").alias("item_id"))
        .distinct()
        .groupBy("block", "ord")
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    hits = _covered(found.select("block", "ord", "ranges")).join(listed, ["block", "ord"])
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return (
        documents_of(index)
        .join(hits, ["block", "ord"], "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "sig",
        )
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of docs in which no window of an item occurs."""
    bad = decontaminate(spark, docs, items, size).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("sig").alias("_bad_sig")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_bad_sig"))
    return docs.join(bad, same, "left_anti")
