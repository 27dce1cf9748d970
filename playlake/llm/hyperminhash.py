"""Near duplicates by HyperMinHash sketches, confirmed on full shingle sets (operator 10).

A document is the set of its distinct word shingles. Each shingle hash picks a register;
the register keeps the smallest second hash as its leading-zero count and ten mantissa
bits. Documents with equal sets form a class, and one document stands for the class.
Registers are cut into bands; representatives that share a band are candidates. A pair goes
on if the collision-corrected Jaccard estimate is not far below the threshold, and becomes a
link if the full sets confirm it.

Links are searched in two passes, so that a large group does not become all its pairs:

1. each representative is compared with the smallest members of its buckets (the three with
   which it shares most bands); confirmed links give first components;
2. members of buckets that still hold several components are compared across components: by a
   join in small buckets. A large bucket, of documents that share a passage or that are so short that
   few registers are full, grows with the corpus, and all its pairs with the square of it. So members of
   large buckets are paired by the rarest shingles of their sets instead (``prefix_pairs``), which
   leaves out no pair at the threshold. Where most sets that meet at a shingle remain pairs, they are compared in blocks of
   ``BLOCK`` members a side, on whole sets (thinned by a hash threshold beyond ``THIN`` shingles), of which only links that
   join components leave the task. All are confirmed on full sets.

The second pass covers every pair that the first left out and that could join two
components, so components are those of all links among banded pairs, and of any others among members of
large buckets. With 48 bands of 5 registers a pair at similarity 0.8 shares no band with probability 5e-9.

Edge cases: a null or empty text has no shingles, forms its own component and is kept. A
text of fewer words than a shingle has one shingle, its whole word sequence. Rows that
repeat a doc_id are one document, linked by any of their texts. A row without doc_id is
kept, has a null component and is no link's end. Only doc_id and text are read; other
columns pass through ``keep_one`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm import prefix_pairs as P
from playlake.llm import words as W
from playlake.llm.common import IdFilter, store
from playlake.llm.components import connected_components

BANDS, ROWS = 48, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Standard deviations by which an estimate may fall short of the threshold and still be confirmed. Pairs below are never
#: confirmed, so a link may be lost with about 1e-8, in line with the bands.
SIGMAS = 6.0
#: Members of a bucket up to which all its pairs are joined, and pairs for each set that meets others at a shingle up to which they are
#: confirmed one by one; members of the blocks that more are cut into.
SMALL, BLOCK = 8, 4000
#: Slices of the usual size that sets are made of at a time.
_SLICE = 0.5
#: Codec of the tables of sketches and bands; registers have some 12 of 16 bits of information.
PACKED = "zstd"
#: Hashes of a thinned set.
THIN = 4096
_RULE = W.rule(lower=True)
_EC = 0.16991948715973909  # expected collisions, HyperMinHash paper (Yu and Weber), section on bias


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every distinct shingle of every text, ordered by both.

    The sort key has the text number in its upper 12 bits and 52 bits of the hash below.
    """
    words = W.split(texts, _RULE)
    counts = np.diff(words.first)
    h = W.hashes(words)
    starts = W.window_starts(words, size)
    text = words.text_of()
    own = W.window_hashes(h, size)[starts] if len(starts) else np.empty(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.array([_short(h[words.first[t]: words.first[t + 1]]) for t in short], np.uint64)
    value = np.concatenate([own, extra])
    of = np.concatenate([text[starts], short])
    order = np.lexsort((value, of)) if len(counts) > 4096 else np.argsort(
        (of.astype(np.uint64) << np.uint64(52)) | (value >> np.uint64(12)))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return of[new], value[new]


def _short(h: np.ndarray) -> np.uint64:
    out = np.array([len(h)], np.uint64)
    for x in h:
        out = W.mix(out * np.uint64(0x9E3779B97F4A7C15) + x)
    return out[0]


def registers(of: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The n sketches: per register 0 if empty, else (leading zeros + 1) * 2**MANTISSA + mantissa."""
    bucket = ((value >> np.uint64(40)) * np.uint64(REGISTERS)) >> np.uint64(24)
    rest = W.mix(value ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(11)
    low = np.full(n * REGISTERS, 1 << 53, np.uint64)
    np.minimum.at(low, of * REGISTERS + bucket.astype(np.int64), rest)
    full = low < (1 << 53)
    low[~full] = 1
    width = np.frexp(np.maximum(low, 1).astype(np.float64))[1].astype(np.uint64)
    mantissa = ((low << (np.uint64(53) - width)) & np.uint64((1 << 52) - 1)) >> np.uint64(52 - MANTISSA)
    out = ((np.uint64(54) - width) << np.uint64(MANTISSA)) | mantissa
    return np.where(full, out, 0).astype(np.uint16).reshape(n, REGISTERS)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of sketch rows, and the registers each rests on."""
    used = np.maximum(((a > 0) | (b > 0)).sum(-1), 1)
    equal = ((a == b) & (a > 0)).sum(-1)
    ratio = np.minimum(n_a, n_b) / np.maximum(np.maximum(n_a, n_b), 1)
    chance = _EC * REGISTERS / 2 ** MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return (equal - chance) / used, used


def _allowed(est, used, n_a, n_b, threshold: float) -> np.ndarray:
    """Pairs that full sets must confirm: sizes allow the threshold, the estimate comes near it."""
    low = threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / used)
    return (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9) & (est >= low)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch) of every row; digest names the set, null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.released(W.slices(batches, scale=_SLICE)):
            n = part.num_rows
            of, value = shingle_sets(part.column("text"), size)
            count = np.bincount(of, minlength=n).astype(np.int64)
            bound = np.concatenate([[0], np.cumsum(count)])
            halves = []
            for seed in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
                total = np.zeros(len(value) + 1, np.uint64)
                np.cumsum(W.mix(value ^ np.uint64(seed)), out=total[1:])
                halves.append(total[bound[1:]] - total[bound[:-1]])
            digest = np.stack(halves, 1).astype(">u8").tobytes()
            sketch = registers(of, value, n).astype(">u2").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(count),
                    pa.array([digest[16 * i: 16 * i + 16] if c else None for i, c in enumerate(count)], pa.binary()),
                    pa.array([sketch[2 * REGISTERS * i: 2 * REGISTERS * (i + 1)] if c else None for i, c in enumerate(count)], pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, sketch binary"
    )


def _bands(reps: DataFrame) -> DataFrame:
    """(band, rep, n_shingles): one row for each band of a sketch that has a full register."""
    width = 2 * ROWS
    empty = F.lit(bytes(width))
    own = [
        F.when(part != empty, F.xxhash64(F.lit(b), part))
        for b in range(BANDS)
        for part in [F.substring("sketch", 1 + b * width, width)]
    ]
    return reps.select(F.explode(F.array_compact(F.array(*own))).alias("band"), F.col("doc_id").alias("rep"), "n_shingles")


def _pairs_near(reps: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sketches come near the threshold."""
    one = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    two = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                a, b = (np.frombuffer(b"".join(x[c]), ">u2").reshape(len(x), REGISTERS) for c in ("s_a", "s_b"))
                n_a, n_b = x["n_a"].to_numpy(), x["n_b"].to_numpy()
                yield x.loc[_allowed(*estimate(a, b, n_a, n_b), n_a, n_b, threshold), ["a", "b"]]

    return pairs.join(one, "a").join(two, "b").mapInPandas(run, "a long, b long")


def _pack(values: np.ndarray) -> bytes:
    return values.astype("<u8").tobytes()


def _thin(values: np.ndarray) -> tuple[int, bytes]:
    """(level, hashes): the set's hashes in order; of a long set those below 2**-level of their range."""
    short = np.sort(values)
    level = 0
    while len(short) > THIN:
        level += 1
        short = _below(short, level)
    return level, _pack(short)


def _below(values: np.ndarray, level: int) -> np.ndarray:
    """The hashes below 2**-level of their range."""
    return values[values < np.uint64(1 << (64 - level))] if level else values


def _shingles_of(spark: SparkSession, docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) of the documents named in ids, and of few others.

    shingles are sorted 8-byte hashes. A Bloom filter picks the documents where they are
    read, so that no text is shuffled; those that it lets through by chance do no harm.
    """
    wanted = IdFilter(spark, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = (b.filter(pa.array(wanted.may_hold(b.column("key").to_numpy(zero_copy_only=False)))) for b in batches)
        for part in W.released(W.slices(chosen, scale=_SLICE)):
            of, value = shingle_sets(part.column("text"), size)
            bound = np.searchsorted(of, np.arange(part.num_rows + 1))
            own = [np.sort(value[i:j]) for i, j in zip(bound[:-1], bound[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([v.tobytes() for v in own], pa.binary())], ["doc_id", "shingles"]
            )

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("key", IdFilter.key()).mapInArrow(
        run, "doc_id long, shingles binary"
    )


def _thin_sets(sets: DataFrame, wanted: IdFilter) -> DataFrame:
    """(doc_id, level, thin) of the wanted sets, see ``_thin``, and of few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = (b.filter(pa.array(wanted.may_hold(b.column("key").to_numpy(zero_copy_only=False)))) for b in batches)
        for batch in W.released(chosen):
            thin = [_thin(np.frombuffer(v, np.uint64)) for v in batch.column("shingles").to_pylist()]
            levels, values = pa.array([t[0] for t in thin], pa.int32()), pa.array([t[1] for t in thin], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), levels, values], ["doc_id", "level", "thin"])

    return sets.select("doc_id", "shingles", IdFilter.key().alias("key")).mapInArrow(run, "doc_id long, level int, thin binary")


def _confirm(sets: DataFrame, pairs: DataFrame, threshold_pct: int) -> DataFrame:
    """The pairs (a, b) with 100 * shared >= threshold_pct * union on full sets."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in W.released(batches):
            ok = []
            for s_a, s_b in zip(x["s_a"], x["s_b"], strict=True):
                a, b = np.frombuffer(s_a, np.uint64), np.frombuffer(s_b, np.uint64)
                both = np.intersect1d(a, b, assume_unique=True).size
                ok.append(100 * both >= threshold_pct * (len(a) + len(b) - both))
            yield x.loc[ok, ["a", "b"]]

    return pairs.join(one, "a").join(two, "b").mapInPandas(run, "a long, b long")


def _shared_bands(bands: DataFrame) -> DataFrame:
    """(band, rep, n_shingles, hub, hub_shingles, n) of the bands that several representatives share; hub is the smallest."""
    rows = bands.repartition("band")  # dealt once for both sides
    ends = rows.groupBy("band").agg(F.min(F.struct("rep", "n_shingles")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    return rows.join(ends, "band").select(
        "band", "rep", "n_shingles", F.col("hub.rep").alias("hub"), F.col("hub.n_shingles").alias("hub_shingles"), "n"
    )


def _sizes_allow(one: str, two: str, threshold_pct: int) -> Column:
    return 100 * F.least(one, two) >= threshold_pct * F.greatest(one, two)


def _first_pairs(shared: DataFrame, threshold_pct: int) -> DataFrame:
    """Each representative with the three hubs of its buckets that it shares most bands with, of those whose sizes allow the threshold."""
    near = shared.where((F.col("rep") != F.col("hub")) & _sizes_allow("n_shingles", "hub_shingles", threshold_pct))
    counts = near.groupBy("rep", "hub").agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("n"), "hub"))
    return counts.withColumn("k", best).where("k <= 3").select(F.col("hub").alias("a"), F.col("rep").alias("b"))


def _open_buckets(shared: DataFrame, label: DataFrame) -> DataFrame:
    """(band, rep, label, alone, n, n_shingles, wide) of the buckets whose members lie in several components so far.

    alone is true for a component of one, wide for members of any such bucket of more than SMALL.
    """
    held = shared.join(label, F.col("rep") == F.col("node"), "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("label"), F.col("component").isNull().alias("alone"), "n", "n_shingles"
    )
    several = held.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    most = F.max("n").over(Window.partitionBy("rep"))
    return held.join(several.select("band"), "band").withColumn("wide", most > SMALL)


def _small_pairs(open_: DataFrame, threshold_pct: int) -> DataFrame:
    """All pairs across components in buckets of at most SMALL members whose sizes allow the threshold, but for those of two wide members."""
    small = open_.where(F.col("n") <= SMALL)
    two = small.select("band", F.col("rep").alias("b"), F.col("label").alias("l_b"), F.col("n_shingles").alias("n_b"), F.col("wide").alias("w_b"))
    across = (F.col("rep") < F.col("b")) & (F.col("label") != F.col("l_b")) & ~(F.col("wide") & F.col("w_b"))
    pairs = small.join(two, (small["band"] == two["band"]) & across & _sizes_allow("n_shingles", "n_b", threshold_pct))
    return pairs.select(F.col("rep").alias("a"), "b").distinct()


def _wide_pairs(spark: SparkSession, open_: DataFrame, sets: DataFrame, threshold_pct: int) -> tuple[DataFrame, DataFrame]:
    """Pairs across the components of wide members that their prefixes allow, and pairs of crowds of them that join their components."""
    wide = open_.where("wide").groupBy(F.col("rep").alias("doc_id"), "label", "alone").agg(F.max("n_shingles").alias("size"))
    bits = P.bits(wide.agg(F.sum("size")).first()[0] or 0)
    moved = P.dealt(sets.join(wide.drop("size"), "doc_id"), bits)
    prefix = store(spark, P.prefixes(P.shared(moved, bits), threshold_pct), "prefix", PACKED)
    tokens = store(spark, P.tokens(prefix), "tokens", PACKED)  # joined as a table of its own, a token of many rows can be split
    held = store(spark, prefix.join(tokens, "token"), "held", PACKED)
    met = P.meetings(held, threshold_pct, BLOCK)
    many = P.meetings(held.where(F.col("c") > 2 * SMALL), threshold_pct, BLOCK)
    crowds = store(spark, many.groupBy("token", "c").agg(F.count("*").alias("m")).where(F.col("m") > SMALL * F.col("c")).select("token"), "crowds")
    crowd = held.join(crowds, "token", "left_semi").select(
        F.col("token").alias("band"), "rep", "label", F.col("c").alias("n"), F.col("n").alias("n_shingles")
    )
    return met.join(crowds, "token", "left_anti").select("a", "b").distinct(), _large_pairs(spark, crowd, sets, threshold_pct)


def _large_pairs(spark: SparkSession, crowd: DataFrame, sets: DataFrame, threshold_pct: int) -> DataFrame:
    """Pairs of crowds (band, rep, label, n, n_shingles) that join their components, compared in pairs of blocks."""
    members = (
        crowd.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .join(_thin_sets(sets, IdFilter(spark, crowd, "rep")).withColumnRenamed("doc_id", "rep"), "rep")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            "own", "rep", "label", "n_shingles", "level", "thin",
        )
    )

    def run(x: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_joining(x, threshold_pct), columns=["a", "b"], dtype="int64")

    return members.groupBy("band", "i", "j").applyInPandas(run, "a long, b long").distinct()


def _joining(x: pd.DataFrame, threshold_pct: int) -> list[tuple[int, int]]:
    """Pairs between two blocks of a bucket that link different components.

    Whole sets of the same 64-bit hashes that confirm links give the same similarities here, so a spanning forest stands for all links among them. Where
    a set is thinned the similarity is an estimate, and every pair near the threshold is returned.
    """
    x = x.drop_duplicates("rep")
    rep, n, level, label = (x[c].to_numpy() for c in ("rep", "n_shingles", "level", "label"))
    left, right = ((x["own"] == x[c]).to_numpy() for c in ("i", "j"))
    names, counts = np.unique(label, return_counts=True)
    if len(names) < 2:
        return []
    outside = label != names[counts.argmax()]  # every pair across components has a member here
    values = [np.frombuffer(v, np.uint64) for v in x["thin"]]
    root = label.copy()
    out: list[tuple[int, int]] = []
    for top in np.unique(level):
        use = np.flatnonzero((level == top) | (level == top - 1))
        held = [_below(values[k], int(top)) for k in use]
        shared = _intersections(held, outside[use])
        size = np.array([len(v) for v in held])
        of = {k: len(v) for k, v in zip(use, held, strict=True)}
        for row, k in zip(shared, use[outside[use]], strict=True):
            ok = (label[use] != label[k]) & ((left[k] & right[use]) | (right[k] & left[use]))
            ok &= np.maximum(level[k], level[use]) == top
            if top == 0:
                ok &= 100 * row >= threshold_pct * (n[k] + n[use] - row)
            else:  # the thinned union is a sample of the union, so its shared part is binomial
                union = np.maximum(of[k] + size - row, 1)
                margin = SIGMAS * np.sqrt(threshold_pct / 100 * (1 - threshold_pct / 100) / union)
                ok &= row / union >= threshold_pct / 100 - margin
                ok &= 100 * np.minimum(n[k], n[use]) >= threshold_pct * np.maximum(n[k], n[use])
            far = use[ok]
            if top:
                out += [(min(rep[k], rep[f]), max(rep[k], rep[f])) for f in far]
                continue
            far = far[root[far] != root[k]]
            while len(far):
                f = far[0]
                out.append((min(rep[k], rep[f]), max(rep[k], rep[f])))
                root[root == root[f]] = root[k]
                far = far[root[far] != root[k]]
    return list(dict.fromkeys(out))


def _intersections(values: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Shared shingles of the marked sets with every set, by matrix products."""
    of = np.repeat(np.arange(len(values)), [len(v) for v in values])
    name, column, counts = np.unique(np.concatenate([*values, np.empty(0, np.uint64)]), return_inverse=True, return_counts=True)
    often = counts > 1  # a shingle of one set alone adds nothing
    number = np.cumsum(often) - 1
    keep = often[column]
    of, column = of[keep], number[column[keep]]
    total = np.zeros((int(rows.sum()), len(values)), np.float32)
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    for begin in range(0, int(often.sum()), 2048):
        a, b = np.searchsorted(column, [begin, begin + 2048])
        dense = np.zeros((len(values), 2048), np.float32)
        dense[of[a:b], column[a:b] - begin] = 1
        total += dense[rows] @ dense.T
    return total


def near_duplicates(spark: SparkSession, docs: DataFrame, size: int = 5, threshold_pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text).

    component_id is the smallest doc_id reachable over links of a shingle Jaccard similarity of
    at least threshold_pct percent; kept is true for that document.
    """
    threshold = threshold_pct / 100
    rows = store(spark, sketches(docs, size), "sketch", PACKED)
    full = rows.where("digest is not null and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = store(
        spark, full.select("digest", "doc_id").distinct().join(classes, "digest").select("doc_id", "rep"), "classes"
    )
    reps = full.join(member.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    reps = store(spark, reps.select("doc_id", "n_shingles", "sketch"), "reps", PACKED)
    shared = store(spark, _shared_bands(_bands(reps)), "bands", PACKED)
    sets = store(spark, _shingles_of(spark, docs, shared.select(F.col("rep").alias("doc_id")).distinct(), size), "sets")
    first = store(spark, _pairs_near(reps, _first_pairs(shared, threshold_pct), threshold), "pairs")
    links = store(spark, _confirm(sets, first, threshold_pct), "links")
    label = connected_components(spark, links)
    open_ = store(spark, _open_buckets(shared, label), "open", PACKED)
    some, crowds = _wide_pairs(spark, open_, sets, threshold_pct)
    rest = _pairs_near(reps, _small_pairs(open_, threshold_pct).union(some), threshold).union(crowds)
    rest = rest.distinct().join(first, ["a", "b"], "left_anti")
    links = links.unionByName(_confirm(sets, rest, threshold_pct))
    same = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    final = connected_components(spark, links.unionByName(same))
    return (
        rows.select("doc_id", "n_shingles")
        .join(final, F.col("doc_id") == F.col("node"), "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
            (F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
        )
    )


def keep_one(spark: SparkSession, docs: DataFrame, size: int = 5, threshold_pct: int = 80) -> DataFrame:
    """The rows of docs without those that another document of their group stands for."""
    verdict = near_duplicates(spark, docs, size, threshold_pct)
    gone = verdict.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")
