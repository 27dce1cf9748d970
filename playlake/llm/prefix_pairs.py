"""Pairs of shingle sets that may be similar, by prefixes, for buckets too large for all their pairs (operator 10).

All sets are ordered in one way: first the shingles that one component alone holds, then the others, those with
fewest holders first. Two sets of n_a <= n_b shingles at a similarity of pct percent share at least pct (n_a + n_b) / (100 + pct)
of them, so both hold their first common shingle so early that as many are left from there on. A pair that fails this at every
common shingle is not similar; which order is taken does not change the pairs that are, it only keeps the others few.

1. ``dealt``: the shingles of slices of sets go out by hash bucket, one row for each (slice, bucket).
2. ``shared``: a bucket finds the shingles that several components hold and returns them, with the number of holders, to their slices.
3. ``prefixes``: each slice orders its sets and keeps the shingles early enough to be a pair's first common one.
   A shingle that was not returned is known to lead to no other component.
4. ``meetings``: sets that meet at a shingle, with room for a similar pair, are pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import words as W

#: Shingles of a hash bucket, about, and least and most buckets as powers of two.
BUCKET, LEAST_BITS, MOST_BITS = 1 << 20, 10, 16
_REST = 7  # bytes of a shingle that travel beside its bucket
_GROUPED = 1 << 15  # marks a row of a slice whose set has been linked
_MOVED = "key long, slice long, kind int, a binary, b binary, c binary"
_SHARED = pa.schema([("slice", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_PREFIX = pa.schema([("token", pa.int64()), ("rep", pa.int64()), ("label", pa.int64()), ("n", pa.int64()), ("p", pa.int64())])


def bits(shingles: int) -> int:
    """Buckets for so many shingles, as a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, (shingles // BUCKET).bit_length()))


def dealt(sets: DataFrame, bits: int) -> DataFrame:
    """What travels from slices of sets (doc_id, label, alone, shingles) to buckets; alone is true for a component of one.

    Kind 0: a = row numbers, b = _REST bytes of each shingle, c = labels of those of linked sets; key is the bucket. Kind 1:
    a = sizes, b = doc_ids, c = labels of the slice's sets, for the slice itself; its key only spreads it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, part in enumerate(W.released(W.slices(batches, text="shingles", scale=2))):
            first: dict[tuple[int, bytes], int] = {}  # rows that come twice go once
            for i, own in enumerate(zip(part.column("doc_id").to_pylist(), part.column("shingles").to_pylist(), strict=True)):
                first.setdefault(own, i)
            at = list(first.values())
            ids, labels = (part.column(c).to_numpy()[at].astype("<i8") for c in ("doc_id", "label"))
            linked = ~part.column("alone").to_numpy(zero_copy_only=False)[at].astype(bool)
            sizes = np.array([len(v) // 8 for _, v in first], "<i8")
            value = np.frombuffer(b"".join(v for _, v in first), np.uint64)
            row = np.repeat(np.arange(len(at)), sizes)
            bucket = (value >> np.uint64(64 - bits)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            bucket, value, row = bucket[order].astype(np.int64), value[order], row[order]
            head = np.flatnonzero(np.diff(bucket, prepend=-1))
            spans = np.stack([head, np.append(head[1:], len(bucket))], 1).tolist() if len(head) else []
            named = np.concatenate([[0], np.cumsum(linked[row])]).tolist()
            a = np.where(linked[row], row | _GROUPED, row).astype("<u2").tobytes()
            b = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_REST].tobytes()
            c = labels[row[linked[row]]].tobytes()
            n, own = len(spans), task + number
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*bucket[head].tolist(), own % (1 << bits)], pa.int64()), pa.array([own] * (n + 1), pa.int64()), pa.array([0] * n + [1], pa.int32()),
                    pa.array([a[2 * i: 2 * j] for i, j in spans] + [sizes.tobytes()], pa.binary()),
                    pa.array([b[_REST * i: _REST * j] for i, j in spans] + [ids.tobytes()], pa.binary()),
                    pa.array([c[8 * named[i]: 8 * named[j]] for i, j in spans] + [labels.tobytes()], pa.binary()),
                ],
                ["key", "slice", "kind", "a", "b", "c"],
            )

    return sets.select("doc_id", "label", "alone", "shingles").mapInArrow(run, _MOVED)


def shared(moved: DataFrame, bits: int) -> DataFrame:
    """The shingles that several components hold, back at their slices: kind 0 has a = row numbers, b = shingles, c = holders."""

    def run(bucket: pa.Table) -> pa.Table:
        rows = bucket.to_pylist()
        out = [r for r in rows if r["kind"] == 1]
        rows = [r for r in rows if r["kind"] == 0]
        if rows:
            row = np.frombuffer(b"".join(r["a"] for r in rows), "<u2").astype(np.int64)
            of = np.repeat(np.arange(len(rows)), [len(r["a"]) // 2 for r in rows])
            raw = np.zeros((len(row), 8), np.uint8)
            raw[:, :_REST] = np.frombuffer(b"".join(r["b"] for r in rows), np.uint8).reshape(-1, _REST)
            value = raw.view("<u8").ravel() | (np.uint64(rows[0]["key"]) << np.uint64(64 - bits))
            linked = row >= _GROUPED
            names, own = np.unique(np.frombuffer(b"".join(r["c"] for r in rows), "<i8"), return_inverse=True)
            row &= _GROUPED - 1
            component = of * _GROUPED + row + len(names)
            component[linked] = own
            order = np.argsort(value, kind="stable")
            head = np.flatnonzero(np.diff(value[order], prepend=~value[order[:1]]))
            held = np.diff(np.append(head, len(value)))
            several = np.minimum.reduceat(component[order], head) < np.maximum.reduceat(component[order], head)
            holders = np.empty(len(value), np.int64)
            holders[order] = np.repeat(np.where(several, held, 0), held)
            back = np.flatnonzero(holders)
            cut = np.searchsorted(of[back], np.arange(len(rows) + 1))
            for r, i, j in zip(rows, cut[:-1], cut[1:], strict=True):
                if i < j:
                    at = back[i:j]
                    out.append({"slice": r["slice"], "kind": 0, "a": row[at].astype("<u2").tobytes(), "b": value[at].tobytes(), "c": holders[at].astype("<u4").tobytes()})
        return pa.Table.from_pylist(out, _SHARED)

    return moved.groupBy("key").applyInArrow(run, "slice long, kind int, a binary, b binary, c binary")


def prefixes(back: DataFrame, pct: int) -> DataFrame:
    """(token, rep, label, n, p): the shingles of each set of n that may be a similar pair's first common one, with their places from 0."""

    def run(own: pa.Table) -> pa.Table:
        rows = own.to_pylist()
        facts = next(r for r in rows if r["kind"] == 1)
        sizes, ids, labels = (np.frombuffer(facts[c], "<i8") for c in "abc")
        rows = [r for r in rows if r["kind"] == 0]
        row = np.frombuffer(b"".join(r["a"] for r in rows), "<u2").astype(np.int64)
        token = np.frombuffer(b"".join(r["b"] for r in rows), "<u8")
        held = np.frombuffer(b"".join(r["c"] for r in rows), "<u4")
        order = np.lexsort((token, held, row))
        row, token = row[order], token[order]
        count = np.bincount(row, minlength=len(sizes))
        place = (sizes - count)[row] + np.arange(len(row)) - (np.cumsum(count) - count)[row]
        keep = 100 * (sizes[row] - place) >= pct * sizes[row]
        row, token, place = row[keep], token[keep], place[keep]
        return pa.Table.from_arrays([pa.array(v) for v in (token.view(np.int64), ids[row], labels[row], sizes[row], place)], schema=_PREFIX)

    return back.groupBy("slice").applyInArrow(run, "token long, rep long, label long, n long, p long")


def tokens(prefix: DataFrame) -> DataFrame:
    """(token, c) of the shingles where several components meet; c is the number of rows there."""
    facts = prefix.groupBy("token").agg(F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    return facts.where("lo <> hi").select("token", "c")


def meetings(held: DataFrame, pct: int, block: int) -> DataFrame:
    """(token, c, a, b) for prefixes with their tokens' c: pairs across components with room for the threshold from their place at a common shingle on.

    One side is the set with fewer shingles, which must hold the shingle the earlier. A shingle with many rows is dealt by blocks of these.
    """
    blocks = F.expr(f"(c + {block - 1}) div {block}")
    first = held.where(f"{100 + pct} * (n - p) >= {2 * pct} * n").select(
        "token", "c", F.pmod(F.xxhash64("rep"), blocks).alias("i"), F.col("rep").alias("a"), F.col("label").alias("l_a"), F.col("n").alias("n_a"), F.col("p").alias("p_a")
    )
    second = held.select(
        "token", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("i"), F.col("rep").alias("b"), F.col("label").alias("l_b"), F.col("n").alias("n_b"), F.col("p").alias("p_b")
    )
    room = f"(n_a < n_b or n_a = n_b and a < b) and 100 * n_a >= {pct} * n_b and {100 + pct} * least(n_a - p_a, n_b - p_b) >= {pct} * (n_a + n_b)"
    met = first.join(second, ["token", "i"]).where(f"l_a <> l_b and {room}")
    return met.select("token", "c", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
