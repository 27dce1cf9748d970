"""Similarity join of shingle sets by adaptive multi-match prefixes (operator 11).

All sets are ordered in one way, rarest shingle first. A set of n shingles may lack d = n - ceil(t n) of them
in a partner at similarity t, so two linked sets share at least l shingles among the first
d + l of each. A longer prefix (larger l) reads longer lists, but asks for more matches, so fewer
candidates must be verified: each set takes the l of the least estimated cost.

1. ``shingle_facts``: size and digest of every set. Equal sets form a class, one document stands for it. Shingles
   that repeat within slices are counted for the order's end (``frequent``).
2. ``holdings``: the shingles of each slice of documents go out by hash bucket, one row for each
   (slice, bucket). A bucket finds the shingles that several documents hold and returns them, with the
   number of holders, to their slices. A shingle without a second holder is not returned: it is known to be unique.
3. ``prefixes``: each slice orders its sets: unique shingles, shared ones by holders, frequent ones last. A set with
   more than d unique shingles has no partner. For the others l is chosen, and the prefix and all shared shingles
   are kept: shared shingles alone decide every intersection, so they confirm links exactly.
4. ``buckets``: shingles with the same holders become one bucket.
5. Links are searched in two passes, so that a large group does not become all its pairs: each set with the
   three smallest holders it shares most prefix shingles with; then all pairs across the components found so far, by a
   join in buckets of up to ``SMALL`` sets, in larger ones in blocks of ``BLOCK`` sets a side, which return a spanning
   forest of the links they confirm. Pairs that share fewer prefix shingles than their two prefixes ask for are
   not verified; the others are, on full intersections.

Every pair that could join two components is looked at, so components are those of all links.

Edge cases: a null or empty text has no shingles, forms its own component and links with nothing. A text
of fewer words than a shingle has one, its whole word sequence. Rows that repeat a doc_id are one document, linked by any of
their texts. A row without doc_id has a null component and is no link's end. Only doc_id and
text are read; other columns may have any names. Shingles are known by 58 to 64 hash bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import IdFilter, store
from playlake.llm.components import connected_components
from playlake.llm.hyperminhash import shingle_sets

SIZE, PCT = 4, 85
#: Longest choice of l; cost of looking at a list entry, and of verifying a candidate for each of its shingles.
MOST, SCAN, VERIFY = 16, 1.0, 0.1
#: Shingles of a hash bucket, about, and least number of buckets as a power of two.
BUCKET, LEAST_BITS = 1 << 22, 10
#: Frequent shingles are at most so many (their counts add up to at most all shingles), and held by at least so many.
FREQUENT, LEAST_FREQUENT = 500_000, 1000
#: Sets of a bucket up to which its pairs are joined, and of a block of a larger one.
SMALL, BLOCK = 32, 1000
#: Shingles of the sets of a block, about.
BLOCK_SHINGLES = 1 << 20
_REST = 6  # bytes of a shingle that travel beside its bucket
_MOVED = "key long, slice binary, kind int, a binary, b binary, c binary"


def _need(n_a, n_b, p_a, p_b, pct: int):
    """Prefix shingles that two linked sets of n and prefixes of p shingles must share."""
    overlap = -(-pct * (n_a + n_b) // (100 + pct))
    return overlap - np.maximum(n_a - p_a, n_b - p_b)


def shingle_facts(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n, digest) of every row, and rows (token, count) of shingles that three texts of a slice hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            rows = part.num_rows
            of, value = shingle_sets(part.column("text"), size)
            count, digest = _digests(of, value, rows)
            none = pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(count), pa.array(digest, pa.binary()), none, none], ["doc_id", "n", "digest", "token", "held"]
            )
            token, held = np.unique(value, return_counts=True)
            token, held = token[held > 2], held[held > 2]
            none = pa.nulls(len(token), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.nulls(len(token), pa.binary()), pa.array(token.view(np.int64)), pa.array(held)], ["doc_id", "n", "digest", "token", "held"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, digest binary, token long, held long")


def _digests(of: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, list[bytes | None]]:
    """Sizes and 128-bit names of the sets; null for an empty one."""
    count = np.bincount(of, minlength=rows).astype(np.int64)
    bound = np.concatenate([[0], np.cumsum(count)])
    halves = []
    for seed in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(W.mix(value ^ np.uint64(seed)), out=total[1:])
        halves.append(total[bound[1:]] - total[bound[:-1]])
    raw = np.stack(halves, 1).astype(">u8").tobytes()
    return count, [raw[16 * i: 16 * i + 16] if c else None for i, c in enumerate(count)]


def frequent(facts: DataFrame, shingles: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts), ordered by shingle: at most FREQUENT, whatever the corpus, as the counts add up to at most ``shingles``."""
    least = max(LEAST_FREQUENT, -(-shingles // FREQUENT))
    found = facts.where("token is not null").groupBy("token").agg(F.sum("held").alias("held")).where(F.col("held") >= least).toPandas()
    token, held = found["token"].to_numpy(np.int64).view(np.uint64), found["held"].to_numpy(np.int64)
    order = np.argsort(token)
    return token[order], held[order]


def _name(value: np.ndarray, bits: int) -> np.ndarray:
    """The part of a shingle's hash that names it: its bucket and _REST bytes."""
    return value >> np.uint64(64 - 8 * _REST - bits)


def _is_in(value: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether, where) each value stands in an ordered table."""
    if not len(table):
        return np.zeros(len(value), bool), np.zeros(len(value), np.int64)
    at = np.minimum(np.searchsorted(table, value), len(table) - 1)
    return table[at] == value, at


def holdings(docs: DataFrame, chosen: IdFilter, often, bits: int, size: int = SIZE) -> DataFrame:
    """What travels from slices to buckets: rows of kind 0 (shingles) and 1 (facts of the slice's sets, for the slice itself).

    Kind 0: a = row numbers, b = _REST bytes of each shingle; key is the bucket. Kind 1: a = sizes, b = digests,
    c = (row number, frequent shingle) pairs; its key only spreads it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_often, _ = often.value
        some = (b.filter(pa.array(chosen.may_hold(b.column("key").to_numpy(zero_copy_only=False)))) for b in batches)
        for part in W.slices(some):
            of, value = shingle_sets(part.column("text"), size)
            count, digest = _digests(of, value, part.num_rows)
            first: dict[bytes, int] = {}
            for i, d in enumerate(digest):
                if d is not None:
                    first.setdefault(d, i)
            keep = np.zeros(part.num_rows, bool)  # equal sets of a slice go once
            keep[list(first.values())] = True
            if not keep.any():
                continue
            of, value = of[keep[of]], value[keep[of]]
            of = (np.cumsum(keep) - 1)[of].astype("<u2")
            sizes, digests = count[keep].astype("<i8"), b"".join(first)
            own = hashlib.blake2b(digests, digest_size=16).digest()
            last, at = _is_in(value, token_often)
            pairs = np.stack([of[last].astype("<i8"), at[last].astype("<i8")], 1)
            rare, row = value[~last], of[~last]
            bucket = (rare >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, row = bucket[order], row[order]
            rest = _name(rare[order], bits).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_REST].tobytes()
            row = row.tobytes()
            head = np.flatnonzero(np.diff(bucket, prepend=-1))
            stop = [*head[1:].tolist(), len(bucket)]
            keys = [*bucket[head].tolist(), int.from_bytes(own[:4], "little") % (1 << bits)]
            spans = list(zip(head.tolist(), stop, strict=True)) if len(head) else []
            n = len(spans)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()), pa.array([own] * (n + 1), pa.binary()), pa.array([0] * n + [1], pa.int32()),
                    pa.array([row[2 * i: 2 * j] for i, j in spans] + [sizes.tobytes()], pa.binary()),
                    pa.array([rest[_REST * i: _REST * j] for i, j in spans] + [digests], pa.binary()),
                    pa.array([None] * n + [pairs.tobytes()], pa.binary()),
                ],
                ["key", "slice", "kind", "a", "b", "c"],
            )

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("key", IdFilter.key()).mapInArrow(run, _MOVED)


def _by_key(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[list[dict]]:
    """The rows of each key, which come as neighbours."""
    open_: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if open_ and row[name] != open_[0][name]:
                yield open_
                open_ = []
            open_.append(row)
    if open_:
        yield open_


def shared_shingles(moved: DataFrame, bits: int) -> DataFrame:
    """The shingles that several sets hold, back at their slices: kind 0 has a = row numbers, b = names, c = holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches, "key"):
            out = [r for r in rows if r["kind"] == 1]
            rows = [r for r in rows if r["kind"] == 0]
            if rows:
                row = np.frombuffer(b"".join(r["a"] for r in rows), "<u2")
                raw = np.zeros((len(row), 8), np.uint8)
                raw[:, :_REST] = np.frombuffer(b"".join(r["b"] for r in rows), np.uint8).reshape(-1, _REST)
                rest = raw.view("<u8").ravel()
                of = np.repeat(np.arange(len(rows)), [len(r["a"]) // 2 for r in rows])
                order = np.argsort(rest, kind="stable")
                head = np.flatnonzero(np.diff(rest[order], prepend=~rest[order[:1]]))
                held = np.diff(np.append(head, len(rest)))
                holders = np.empty(len(rest), np.int64)
                holders[order] = np.repeat(held, held)
                several = np.flatnonzero(holders > 1)
                names = (np.uint64(rows[0]["key"]) << np.uint64(8 * _REST)) | rest[several]
                cut = np.searchsorted(of[several], np.arange(len(rows) + 1))
                for k, r in enumerate(rows):
                    i, j = cut[k], cut[k + 1]
                    if i < j:
                        at = several[i:j]
                        out.append({"slice": r["slice"], "kind": 0, "a": row[at].tobytes(), "b": names[i:j].tobytes(), "c": holders[at].tobytes()})
            if out:
                columns = [pa.array([r[c] for r in out], pa.int32() if c == "kind" else pa.binary()) for c in ("slice", "kind", "a", "b", "c")]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "kind", "a", "b", "c"])

    return moved.repartition("key").sortWithinPartitions("key").mapInArrow(run, "slice binary, kind int, a binary, b binary, c binary")


def prefixes(shared: DataFrame, often, bits: int, pct: int = PCT) -> DataFrame:
    """(sid, n, p, prefix, shingles) of the sets that may have partners; sid is the digest.

    p is the prefix's length, unique shingles included; prefix lists its other shingles; shingles are all that
    other sets hold too, in order, 8 bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_often, held_often = often.value
        for rows in _by_key(batches, "slice"):
            facts = next(r for r in rows if r["kind"] == 1)
            sizes = np.frombuffer(facts["a"], "<i8")
            pairs = np.frombuffer(facts["c"], "<i8").reshape(-1, 2)
            rows = [r for r in rows if r["kind"] == 0]
            row = np.concatenate([*[np.frombuffer(r["a"], "<u2") for r in rows], pairs[:, 0]]).astype(np.int64)
            name = np.concatenate([*[np.frombuffer(r["b"], np.uint64) for r in rows], _name(token_often[pairs[:, 1]], bits)])
            held = np.concatenate([*[np.frombuffer(r["c"], np.int64) for r in rows], held_often[pairs[:, 1]]])
            last = np.arange(len(row)) >= len(row) - len(pairs)
            order = np.lexsort((name, np.where(last, 0, held), last, row))
            row, name, held = row[order], name[order], held[order]
            new = np.ones(len(row), bool)  # slices of equal content come together under one name
            new[1:] = (row[1:] != row[:-1]) | (name[1:] != name[:-1])
            row, name, held = row[new], name[new], held[new]
            bound = np.searchsorted(row, np.arange(len(sizes) + 1))
            out = []
            for k, (i, j) in enumerate(zip(bound[:-1], bound[1:], strict=True)):
                n = int(sizes[k])
                own = _choose(n, n - (j - i), held[i:j], pct)
                if own:
                    p, listed = own
                    out.append((facts["b"][16 * k: 16 * k + 16], n, p, name[i: i + listed].view(np.int64), np.sort(name[i:j]).tobytes()))
            if out:
                columns = list(zip(*out, strict=True))
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["sid", "n", "p", "prefix", "shingles"])

    dealt = shared.repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(run, "sid binary, n long, p long, prefix array<long>, shingles binary")


def _choose(n: int, unique: int, held: np.ndarray, pct: int) -> tuple[int, int] | None:
    """(prefix length, listed shingles in it) of the least estimated cost, or None if no partner is possible."""
    lack = n - -(-pct * n // 100)
    if unique > lack:
        return None
    most = min(MOST, n - lack)
    listed = lack - unique + np.arange(1, most + 1)  # shingles with other holders in the prefix, for each l
    reads = np.cumsum(held - 1, dtype=np.float64)[listed - 1]
    cost = SCAN * reads + VERIFY * n * reads / np.arange(1, most + 1)  # a candidate is met l times at least
    best = int(np.argmin(cost))
    return lack + best + 1, int(listed[best])


def buckets(sets: DataFrame) -> DataFrame:
    """(bucket, w, c, m, hub, sid, n, p): w shingles have these c holders, with m shingles together; hub is the smallest."""
    rows = sets.select("sid", "n", "p", F.explode("prefix").alias("token"))
    holders = rows.groupBy("token").agg(
        F.count("*").alias("c"), F.sum("n").alias("m"), F.min("sid").alias("hub"),
        F.bit_xor(F.xxhash64("sid")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "sid")).alias("y"),
    ).where("c > 1")
    alike = holders.groupBy("c", "m", "hub", "x", "y").agg(F.min("token").alias("token"), F.count("*").alias("w"))
    return rows.join(alike.select("token", "w", "c", "m", "hub"), "token").withColumnRenamed("token", "bucket")


def _hub_pairs(held: DataFrame) -> DataFrame:
    """Each set with the three smallest holders of its buckets that it shares most prefix shingles with."""
    counts = held.where("sid <> hub").groupBy("sid", "hub").agg(F.sum("w").alias("shared"))
    best = F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("shared"), "hub"))
    return counts.withColumn("k", best).where("k <= 3").select(F.col("hub").alias("a"), F.col("sid").alias("b"))


def _open_buckets(held: DataFrame, label: DataFrame) -> DataFrame:
    """The rows of buckets whose sets lie in several components so far, with their labels."""
    named = held.join(label, F.col("sid") == F.col("node"), "left").withColumn("label", F.coalesce("component", "sid")).drop("node", "component")
    several = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return named.join(several.select("bucket"), "bucket")


def _small_pairs(open_: DataFrame, pct: int) -> DataFrame:
    one = open_.where(F.col("c") <= SMALL).select("bucket", F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("l_a"))
    two = one.toDF("bucket", "b", "n_b", "l_b")
    near = 100 * F.least("n_a", "n_b") >= pct * F.greatest("n_a", "n_b")
    return one.join(two, "bucket").where((F.col("a") < F.col("b")) & (F.col("l_a") != F.col("l_b")) & near).select("a", "b").distinct()


def _large_links(open_: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Confirmed links that join the components of larger buckets, compared in pairs of blocks.

    A first look at the prefixes names the sets that have candidates; only those bring their shingles.
    """
    on = ["bucket", "i", "j"]
    members = (
        open_.where(F.col("c") > SMALL)
        .withColumn("blocks", F.ceil(F.greatest(F.col("c") / BLOCK, F.col("m") / BLOCK_SHINGLES)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "label")
    )

    def look(x: pd.DataFrame) -> pd.DataFrame:
        a, b = _candidates(x, pct)
        return x.loc[x.index[np.unique([*a, *b]).astype(np.int64)], [*on, "own", "sid", "label"]]

    def confirm(x: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_joining(x, pct), columns=["a", "b"])

    some = members.join(sets.select("sid", "n", "p", "prefix"), "sid").groupBy(*on).applyInPandas(
        look, "bucket long, i int, j int, own int, sid binary, label binary"
    )
    return some.join(sets, "sid").groupBy(*on).applyInPandas(confirm, "a binary, b binary").distinct()


def _candidates(x: pd.DataFrame, pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs across components, between the two blocks, that share as many prefix shingles as they need.

    A pair belongs to the bucket of its first common shingle, so it is looked at once.
    """
    _, label = np.unique([bytes(v).hex() for v in x["label"]], return_inverse=True)
    n, p, own = (x[c].to_numpy(np.int64) for c in ("n", "p", "own"))
    bucket, i, j = (int(x[c].iloc[0]) for c in ("bucket", "i", "j"))
    lists = [np.asarray(v, np.int64) for v in x["prefix"]]
    ok = (label[:, None] != label[None, :]) & (own[:, None] == i) & (own[None, :] == j)
    ok &= 100 * np.minimum(n[:, None], n[None, :]) >= pct * np.maximum(n[:, None], n[None, :])
    if not ok.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ok &= _matches(lists) >= _need(n[:, None], n[None, :], p[:, None], p[None, :], pct)
    ok &= _matches([v[v < bucket] for v in lists]) == 0
    if i == j:
        ok = np.triu(ok, 1)
    return np.nonzero(ok)


def _joining(x: pd.DataFrame, pct: int) -> list[tuple[bytes, bytes]]:
    """Links among the candidates of a block, confirmed on whole sets; a spanning forest of them joins what they join."""
    a, b = _candidates(x, pct)
    if not len(a):
        return []
    n = x["n"].to_numpy(np.int64)
    both = _matches([np.frombuffer(v, np.int64) for v in x["shingles"]])[a, b]
    linked = 100 * both >= pct * (n[a] + n[b] - both)
    sid = [bytes(s) for s in x["sid"]]
    _, root = np.unique([bytes(v).hex() for v in x["label"]], return_inverse=True)
    out = []
    for k, m in zip(a[linked], b[linked], strict=True):
        if root[k] != root[m]:
            out.append((min(sid[k], sid[m]), max(sid[k], sid[m])))
            root[root == root[m]] = root[k]
    return out


def _matches(lists: list[np.ndarray]) -> np.ndarray:
    """How many values each two lists share, by products of parts of their incidence matrix."""
    of = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
    _, column, held = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    several = held > 1  # the others add nothing
    of, column = of[several[column]], (np.cumsum(several) - 1)[column[several[column]]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    total = np.zeros((len(lists), len(lists)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        lo, hi = np.searchsorted(column, [begin, begin + 2048])
        part = np.zeros((len(lists), 2048), np.float32)
        part[of[lo:hi], column[lo:hi] - begin] = 1
        total += part @ part.T
    return total


def _confirm(sets: DataFrame, pairs: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose prefixes match often enough and whose whole sets reach the threshold."""
    one = sets.select(*[F.col(c).alias(f"{c}_a") for c in ("sid", "n", "p", "prefix", "shingles")]).withColumnRenamed("sid_a", "a")
    two = sets.select(*[F.col(c).alias(f"{c}_b") for c in ("sid", "n", "p", "prefix", "shingles")]).withColumnRenamed("sid_b", "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            need = _need(*(x[c].to_numpy(np.int64) for c in ("n_a", "n_b", "p_a", "p_b")), pct)
            ok = []
            for n_a, n_b, f_a, f_b, s_a, s_b, m in zip(*(x[c] for c in ("n_a", "n_b", "prefix_a", "prefix_b", "shingles_a", "shingles_b")), need, strict=True):
                if np.intersect1d(f_a, f_b, assume_unique=True).size < m:
                    ok.append(False)
                    continue
                both = np.intersect1d(np.frombuffer(s_a, np.uint64), np.frombuffer(s_b, np.uint64), assume_unique=True).size
                ok.append(100 * both >= pct * (n_a + n_b - both))
            yield x.loc[ok, ["a", "b"]]

    return pairs.join(one, "a").join(two, "b").mapInPandas(run, "a binary, b binary")


def links(spark: SparkSession, sets: DataFrame, pct: int = PCT) -> DataFrame:
    """Links (a, b) between sets that have the components of all links."""
    held = store(spark, buckets(sets), "buckets")
    tried = store(spark, _hub_pairs(held), "pairs")
    found = store(spark, _confirm(sets, tried, pct), "links")
    open_ = store(spark, _open_buckets(held, connected_components(spark, found)), "open")
    rest = _small_pairs(open_, pct).join(tried, ["a", "b"], "left_anti")
    return found.unionByName(_confirm(sets, rest, pct)).unionByName(_large_links(open_, sets, pct))


def similar_sets(spark: SparkSession, docs: DataFrame, size: int = SIZE, pct: int = PCT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over links of sets with 100 * shared >= pct * union.
    """
    facts = store(spark, shingle_facts(docs, size), "facts")
    rows = facts.where("token is null")
    full = rows.where("digest is not null and doc_id is not null")
    classes = store(spark, full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    bits = min(16, max(LEAST_BITS, (shingles // BUCKET).bit_length()))
    often = spark.sparkContext.broadcast(frequent(facts, shingles))
    moved = holdings(docs, IdFilter(spark, classes.select(F.col("rep").alias("doc_id"))), often, bits, size)
    # a set may come from several slices; one row of it is enough
    sets = store(spark, prefixes(shared_shingles(moved, bits), often, bits, pct).dropDuplicates(["sid"]), "sets")
    found = links(spark, sets, pct)
    named = classes.select("digest", "rep")
    ends = found.join(named.toDF("a", "u"), "a").join(named.toDF("b", "v"), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    same = full.select("digest", "doc_id").distinct().join(named, "digest").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = connected_components(spark, ends.unionByName(same))
    return rows.join(final, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
