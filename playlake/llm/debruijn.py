"""Removal of long repeated spans over a compacted de Bruijn graph of tokens (operator 5).

An edge of the graph is a window of ``size`` consecutive words; its nodes are the window's
first and last ``size - 1`` words. The table of all edges would be several times the corpus, so
edges travel in buckets, as in minimizer-based graph compaction: the smallest hash among
the ``gram``-word sequences of a window, its minimizer, depends on its content alone, so equal
windows meet in one bucket, and a run of neighbouring windows with one minimizer travels as
one row.

1. ``edge_runs``: runs of edges by minimizer. Within a slice of documents a run equal to an
   earlier one is settled at once (a map-side combine), so a passage that a third of all
   documents hold reaches its bucket once a slice, not once a document.
   ``hot_minimizers`` counts the edges that stay; a minimizer with more than ``HOT_EDGES`` has its edges dealt to several
   buckets by their own hashes.
2. ``repeated_edges``: buckets are sorted by minimizer and coordinates. The first holder of an
   edge is its source; each later occurrence is reported with the source's coordinates, in
   runs on one diagonal (same source document, constant distance).
3. ``compact``: runs that continue each other on one diagonal form a nonbranching path and
   become one span. The source coordinates verify it: every run must start where the last
   one ended, in its document and in the source alike.
4. ``remove_repeats``: spans are joined to their documents, and the words they cover go.

An edge is known by the hashes of its minimizer (64 bits) and of the window (56 bits).

Edge cases: null or empty texts have no words; a text of fewer words than a window loses
none. A row without doc_id has no place in the order: it loses nothing and is no source.
Rows that repeat a doc_id are told apart by a 64-bit signature of the text, which orders them; equal
rows hold the same coordinates, so neither is a repeat of the other, and their spans are kept once. Only doc_id and text are
read; other columns pass through under any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.llm import words as W
from playlake.llm.common import IdFilter, store

SIZE, GRAM = 20, 7
#: Edges of a minimizer from which its bucket is split by the windows' hashes, and the most minimizers that are split
#: (the bound rises with the corpus, so the list that goes to every task stays small).
HOT_EDGES, MOST_HOT = 200_000, 100_000
#: Slices of the usual size that are cut into runs at a time.
_SLICE = 0.5
_RULE = W.rule()
_RUNS = "anchor long, doc_id long, sig long, start int, windows binary"
_REPEATS = "doc_id long, sig long, start int, len int, src_doc long, src_sig long, src_start int"
#: A run whose source is known already carries this record in place of its hashes. Its 26 bytes tell it apart.
_TOLD = np.dtype([("doc", "<i8"), ("sig", "<i8"), ("start", "<i4"), ("len", "<i4"), ("mark", "<u2")])
#: Bytes of an edge's own hash that travel; with its minimizer's hash an edge is known by 120 bits.
WIDTH = 7


def _signature(text: str) -> F.Column:
    return F.xxhash64(F.col(text))


def _pack(edge: np.ndarray) -> bytes:
    return edge.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = np.frombuffer(raw, np.uint8).reshape(-1, WIDTH)
    return out.view("<u8").ravel()


def _minimizers(h: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The smallest gram hash inside the window that starts at each word."""
    grams = W.window_hashes(h, gram)
    n = max(0, len(h) - size + 1)
    low = grams[:n].copy()
    for k in range(1, size - gram + 1):
        np.minimum(low, grams[k: k + n], out=low)
    return low


def hot_minimizers(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(anchor, parts) of the minimizers with more than HOT_EDGES edges that are not settled in their slice, MOST_HOT at most.

    A slice that holds a minimizer in a single run does not report it, so few rows are shuffled; a bucket may exceed the bound by those.
    """

    def tally(slices: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices:
            anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
            n = pa.compute.binary_length(batch.column("windows")).to_numpy(zero_copy_only=False)
            anchor, n = anchor[n != _TOLD.itemsize], n[n != _TOLD.itemsize] // WIDTH
            name, of, runs = np.unique(anchor, return_inverse=True, return_counts=True)
            edges = np.bincount(of, n, len(name)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(name[runs > 1]), pa.array(edges[runs > 1])], ["anchor", "edges"])

    counts = edge_runs(docs, size, gram, tally=tally)  # in the same Python process, which a second step would double
    total = store(docs.sparkSession, counts.groupBy("anchor").agg(F.sum("edges").alias("edges")), "anchors")
    bound = max(HOT_EDGES, (total.agg(F.sum("edges")).first()[0] or 0) // MOST_HOT)
    return total.where(F.col("edges") > bound).select("anchor", F.ceil(F.col("edges") / HOT_EDGES).alias("parts"))


def edge_runs(
    docs: DataFrame, size: int = SIZE, gram: int = GRAM, hot: tuple[np.ndarray, np.ndarray] | None = None, tally=None
) -> DataFrame:
    """Runs of edges with one minimizer; windows holds WIDTH bytes of hash for each edge.

    hot has minimizers in order and the parts of each: their edges are dealt by (minimizer, window hash modulo
    parts), so equal windows still meet, and ``compact`` joins the shorter runs again. tally, if given, turns the runs
    of each slice into (anchor, edges).
    """
    gram = min(gram, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.released(W.slices(batches, scale=_SLICE)):
            words = W.split(part.column("text"), _RULE)
            at = W.window_starts(words, size)
            if not len(at):
                continue
            h = W.hashes(words)
            edge = W.window_hashes(h, size)[at]
            low = _minimizers(h, size, gram)[at]
            text = words.text_of()[at]
            new = np.ones(len(at), bool)
            new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(new)
            stop = np.append(begin[1:], len(at))
            doc, sig = (part.column(c).to_numpy(zero_copy_only=False)[text[begin]] for c in ("doc_id", "sig"))
            start = words.place()[at[begin]].astype(np.int32)
            anchor = low[begin]
            rank = np.lexsort((start, sig, doc, anchor))
            # equal runs: same minimizer, same length, same first edge and same sum over all edges
            total = np.zeros(len(edge) + 1, np.uint64)
            np.cumsum(W.mix(edge), out=total[1:])
            name = np.stack([anchor, edge[begin], total[stop] - total[begin], (stop - begin).astype(np.uint64)], 1)
            order = rank[np.lexsort(tuple(name[rank].T[::-1]))]
            named = name[order]
            first = np.ones(len(order), bool)
            first[1:] = (named[1:] != named[:-1]).any(1)
            source = np.empty(len(order), np.int64)
            source[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            known = (doc != doc[source]) | (sig != sig[source]) | (start != start[source])
            told = np.zeros(len(order), _TOLD)
            told["doc"], told["sig"], told["start"] = doc[source], sig[source], start[source]
            told["len"] = stop - begin
            del rank, total, name, order, named, first, source, h, low  # before the hashes are packed
            if hot is not None and len(hot[0]):
                names, parts = hot
                at_hot = np.minimum(np.searchsorted(names, anchor.view(np.int64)), len(names) - 1)
                split = (names[at_hot] == anchor.view(np.int64)) & ~known
                of_run = np.cumsum(new) - 1
                part_of = np.where(split[of_run], W.mix(edge) % parts[at_hot][of_run].astype(np.uint64) + np.uint64(1), np.uint64(0))
                new[1:] |= part_of[1:] != part_of[:-1]
                begin = np.flatnonzero(new)
                stop = np.append(begin[1:], len(at))
                of_run, part_of = of_run[begin], part_of[begin]
                doc, sig, told, known = doc[of_run], sig[of_run], told[of_run], known[of_run]
                start = words.place()[at[begin]].astype(np.int32)
                anchor = np.where(part_of > 0, W.mix(anchor[of_run] ^ W.mix(part_of)), anchor[of_run])
            told, raw, wide = told.tobytes(), _pack(edge), _TOLD.itemsize
            windows = [
                told[wide * i: wide * i + wide] if k else raw[WIDTH * a: WIDTH * b]
                for i, (k, a, b) in enumerate(zip(known.tolist(), begin.tolist(), stop.tolist(), strict=True))
            ]
            # settled runs need no bucket: their own coordinates spread them
            own = W.mix(doc.astype(np.uint64) * np.uint64(1 << 32) + start.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(known, own, anchor).view(np.int64)), pa.array(doc.astype(np.int64)),
                    pa.array(sig.astype(np.int64)), pa.array(start), pa.array(windows, pa.binary()),
                ],
                ["anchor", "doc_id", "sig", "start", "windows"],
            )

    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), _signature("text").alias("sig")
    )
    if tally is not None:
        return rows.mapInArrow(lambda batches: tally(run(batches)), "anchor long, edges long")
    return rows.mapInArrow(run, _RUNS)


def _settle(anchor: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(source, first) of every edge occurrence, given in the order of coordinates."""
    order = np.lexsort((edge, anchor))  # stable: the earliest of equal edges comes first
    a, e = anchor[order], edge[order]
    first = np.ones(len(order), bool)
    first[1:] = (a[1:] != a[:-1]) | (e[1:] != e[:-1])
    source = np.empty(len(order), np.int64)
    source[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    return source, source == np.arange(len(order))


def repeated_edges(runs: DataFrame) -> DataFrame:
    """Runs of repeated edges with the coordinates of their sources.

    Each task reads its buckets in order. Only the distinct edges of the bucket that
    the last batch left open are kept for the next one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.uint64)]
        for batch in W.released(batches):
            if not batch.num_rows:
                continue
            column = batch.column("windows")
            size = pa.compute.binary_length(column).to_numpy(zero_copy_only=False)
            anchor, doc, sig, start = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "doc_id", "sig", "start")
            )
            known = size == _TOLD.itemsize
            values = column.to_pylist() if known.any() else None
            if known.any():
                told = np.frombuffer(b"".join(v for v, k in zip(values, known, strict=True) if k), _TOLD)
                yield _rows(
                    doc[known], sig[known], start[known], told["len"], told["doc"], told["sig"], told["start"]
                )
                edge = _unpack(b"".join(v for v, k in zip(values, known, strict=True) if not k))
            else:
                edge = _unpack(b"".join(column.to_pylist()))
            anchor, doc, sig, start, count = (x[~known] for x in (anchor, doc, sig, start, size // WIDTH))
            if not len(anchor):
                continue
            row = np.repeat(np.arange(len(anchor)), count)
            step = np.arange(len(edge)) - np.repeat(np.cumsum(count) - count, count)
            old = len(kept[0])
            cols = [
                np.concatenate([k, x])
                for k, x in zip(
                    kept, (anchor[row], doc[row], sig[row], (start[row] + step).astype(np.int32), edge), strict=True
                )
            ]
            a, d, g, s, e = cols
            source, first = _settle(a, e)
            yield from _diagonals(d, g, s, source, old)
            last = first & (a == a[-1])
            kept = [x[last] for x in cols]

    return runs.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "sig", "start").mapInArrow(run, _REPEATS)


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int32)
    names = ["doc_id", "sig", "start", "len", "src_doc", "src_sig", "src_start"]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)], names)


def _diagonals(d, g, s, source, old: int) -> Iterator[pa.RecordBatch]:
    """Repeated occurrences from number ``old`` on, as runs whose sources run alongside."""
    sd, sg, ss = d[source], g[source], s[source]
    again = (d != sd) | (g != sg) | (s != ss)
    again[:old] = False
    at = np.flatnonzero(again)
    if not len(at):
        return
    p, q = at[1:], at[:-1]
    new = np.ones(len(at), bool)
    new[1:] = (
        (p != q + 1) | (d[p] != d[q]) | (g[p] != g[q]) | (s[p] != s[q] + 1)
        | (sd[p] != sd[q]) | (sg[p] != sg[q]) | (ss[p] != ss[q] + 1)
    )
    head = at[new]
    length = np.diff(np.append(np.flatnonzero(new), len(at)))
    yield _rows(d[head], g[head], s[head], length, sd[head], sg[head], ss[head])


def compact(repeats: DataFrame) -> DataFrame:
    """Spans (doc_id, sig, start, len in edges, source) of the nonbranching paths of repeated edges.

    A run continues a path if it starts where the last one ended, in the document and in
    the source. All runs of a document meet in one task, so the same partitioning serves
    the join to the documents.
    """
    by = Window.partitionBy("doc_id", "sig").orderBy("start", "src_doc", "src_sig", "src_start", "len")
    goes_on = (
        (F.lag("src_doc").over(by) == F.col("src_doc"))
        & (F.lag("src_sig").over(by) == F.col("src_sig"))
        & (F.lag("start").over(by) + F.lag("len").over(by) == F.col("start"))
        & (F.lag("src_start").over(by) + F.lag("len").over(by) == F.col("src_start"))
    )
    # rows that repeat a document repeat its runs; equal ones are neighbours in this order, and one of them stays
    run = F.struct("start", "len", "src_doc", "src_sig", "src_start")
    repeats = repeats.withColumn("same", F.coalesce(F.lag(run).over(by) == run, F.lit(False))).where("not same").drop("same")
    headed = repeats.withColumn("head", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    return (
        headed.withColumn("path", F.sum("head").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "sig", "path")
        .agg(
            F.min("start").alias("start"), F.sum("len").cast("int").alias("len"), F.first("src_doc").alias("src_doc"),
            F.min("src_start").alias("src_start"),
        )
        .select("doc_id", "sig", "start", "len", "src_doc", "src_start")
    )


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """All spans of at least one window that start earlier elsewhere, with their sources."""
    found = hot_minimizers(docs, size, gram).toPandas().sort_values("anchor")
    hot = found["anchor"].to_numpy(np.int64), found["parts"].to_numpy(np.int64)
    return compact(repeated_edges(edge_runs(docs, size, gram, hot)))


def remove_repeats(spark: SparkSession, docs: DataFrame, size: int = SIZE, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """The rows of docs with the covered words cut out of text.

    Each covered word goes with the white space after it; all else stays as it is. With
    ``digest`` the result is (doc_id, n_words, n_removed, kept_sha256, n_spans) instead. Only rows that
    may have spans are shuffled to them; the others are finished where they are read.
    """
    packed = F.shiftleft(F.col("start").cast("long"), 32) + F.col("len")
    spans = repeated_spans(docs, size, gram).groupBy("doc_id", "sig").agg(F.collect_list(packed).alias("spans"))
    spans = store(spark, spans, "spans")
    held = IdFilter(spark, spans.select("doc_id"))
    # the text itself goes along once, as _text; other columns under numbers, so that no name can clash
    others = [] if digest else [c for c in docs.columns if c != "text"]
    names = [f"_c{i}" for i in range(len(others))]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_doc_id"), F.col("text").cast("string").alias("_text"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(others, names, strict=True)],
    ).withColumn("_key", IdFilter.key("_doc_id"))

    def chosen(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = held.may_hold(batch.column("_key").to_numpy(zero_copy_only=False))
            some &= batch.column("_doc_id").is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(some == wanted))

    shuffled = rows.mapInArrow(lambda batches: chosen(batches, True), rows.schema).withColumn("_sig", _signature("_text"))
    on = (F.col("_doc_id") == F.col("doc_id")) & (F.col("_sig") == F.col("sig"))
    shuffled = shuffled.join(spans, on, "left").select("_doc_id", "_text", "spans", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.released(W.slices(batches, "_text", _SLICE)):
            words = W.split(part.column("_text"), _RULE)
            n = np.diff(words.first)
            mark = np.zeros(len(words) + 1, np.int64)
            lists = part.column("spans")
            places = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            count = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            begin = np.repeat(words.first[:-1], count) + (places >> 32)
            np.add.at(mark, begin, 1)
            np.add.at(mark, begin + (places & 0xFFFFFFFF) + size - 1, -1)
            gone = np.cumsum(mark[:-1]) > 0
            removed = np.bincount(words.text_of()[gone], minlength=len(n))
            if digest:
                yield _digests(part, words, gone, n, removed, count)
            else:
                text = _cut(words, gone) if gone.any() else part.column("_text")
                text = pa.compute.if_else(pa.array(removed > 0), text, part.column("_text"))
                yield pa.RecordBatch.from_arrays([text, *[part.column(c) for c in names]], ["_text", *names])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows without spans, chosen and finished in one Python process."""
        kinds = ["_doc_id", "_text", "spans", *names]
        for part in chosen(batches, False):
            none = pa.nulls(part.num_rows, pa.list_(pa.int64()))
            columns = [none if c == "spans" else part.column(c) for c in kinds]
            yield from run(iter([pa.RecordBatch.from_arrays(columns, kinds)]))

    if digest:
        schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long"
        return shuffled.mapInArrow(run, schema).unionByName(rows.mapInArrow(alone, schema))
    schema = T.StructType([T.StructField("_text", T.StringType()), *[shuffled.schema[c] for c in names]])
    out = shuffled.mapInArrow(run, schema).unionByName(rows.mapInArrow(alone, schema))
    back = dict(zip(others, names, strict=True))
    return out.select(*[F.col(back.get(c, "_text")).alias(c) for c in docs.columns])


def _digests(part, words: W.Words, gone: np.ndarray, n, removed, held) -> pa.RecordBatch:
    raw = words.raw.copy()
    keep = np.zeros(len(raw) + 1, np.int8)
    start, end = words.start[~gone], words.end[~gone]
    keep[start] = 1
    keep[end] -= 1
    keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    last = np.repeat(words.offsets[1:], n)[~gone]
    after = end[end < last]  # the byte after a word that does not end its text becomes the space
    keep[after] = True
    raw[after] = 0x20
    bound = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
    text = raw[keep].tobytes()
    sha = [
        hashlib.sha256(text[a:b].removesuffix(b" ")).hexdigest() for a, b in zip(bound[:-1], bound[1:], strict=True)
    ]
    columns = [part.column("_doc_id"), pa.array(n.astype(np.int64)), pa.array(removed.astype(np.int64))]
    columns += [pa.array(sha), pa.array(held.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans"])


def _cut(words: W.Words, gone: np.ndarray) -> pa.Array:
    keep = np.zeros(len(words.raw) + 1, np.int64)
    until = np.minimum(np.append(words.start[1:], len(words.raw)), np.repeat(words.offsets[1:], np.diff(words.first)))
    np.add.at(keep, words.start[gone], 1)
    np.add.at(keep, until[gone], -1)
    keep = np.cumsum(keep[:-1]) == 0
    bound = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
    letters = words.raw[keep]
    return pa.Array.from_buffers(
        pa.large_string(), len(bound) - 1, [None, pa.py_buffer(bound.astype(np.int64)), pa.py_buffer(letters)]
    ).cast(pa.string())
