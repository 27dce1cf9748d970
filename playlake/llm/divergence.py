"""Audit of how the sources of a language differ in their terms, over collapsed copies (operator 12).

1. ``collapse``: equal texts of a language become one class with the number of copies in each
   source. A class is known by the SHA-256 of its text.
2. ``term_counts``: each class is tokenised once; its terms are added with the multiplicities of
   its copies, as occurrences and as documents of each (lang, source).
3. ``profiles``: terms in at least ``LEAST_DOCS`` documents of their language are kept, and every
   (lang, source, term) that occurs gets its smoothed share in parts per billion.
4. ``source_pairs``: a source without a term has its base share for it, so the distance of two sources is
   that of their bases over all terms, corrected at the terms that one of them has. Corrections
   come from sorted shares and prefix sums, and from the terms that both have; no table of sources
   by terms is made. Sources are cut into blocks and terms into buckets, so a task holds two
   blocks of ``SIDE`` sources and about ``TERMS`` terms, however many there are of either.
5. ``leading_terms``: terms by which a source exceeds its language, the first ``TOP`` by excess.

A text that a third of all rows hold is combined before the shuffle; a class reaches its task as
rows of at most a ``CHUNKS``-th of its sources. Shares are computed in whole numbers (decimals of 38 digits).

Edge cases: null text, lang or source is an empty one. A text without letters has no terms, its source is
still a group. A language that keeps no term has distances 0 and no leading terms; a language with one source has no pairs;
an empty table gives no rows. Rows that repeat a doc_id are documents of their own. Only text, lang and
source are read; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import store

LEAST_DOCS, TOP = 30, 50
SMOOTH, SCALE = 5, 1_000_000_000
#: Groups of its sources that a class is cut into; sources of a block; terms of a bucket, about.
CHUNKS, SIDE, TERMS = 64, 256, 2048
#: Cells (class, source, term) that are expanded at a time.
_CELLS = 1 << 21
#: Letters: a-z after lower-casing, and every byte of a character beyond ASCII.
_RULE = W.rule(bytes([*range(0x61, 0x7B), *range(0x80, 0x100)]), lower=True)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def collapse(docs: DataFrame) -> DataFrame:
    """(lang, digest, text, held) of every class of equal texts; held lists (source, n).

    A class with many sources is several rows, each with other sources.
    """
    rows = _rows(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    held = copies.groupBy("lang", "digest", F.pmod(F.xxhash64("source"), F.lit(CHUNKS)).alias("chunk")).agg(
        F.collect_list(F.struct("source", "n")).alias("held")
    )
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(held, ["lang", "digest"]).select("lang", "digest", "text", "held")


def term_counts(classes: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, copies included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            yield from _slice_counts(part)

    cells = classes.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _slice_counts(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    names = list(zip(part.column("lang").to_pylist(), part.column("digest").to_pylist(), strict=True))
    new = np.array([not i or name != names[i - 1] for i, name in enumerate(names)])  # rows of a class are neighbours
    first, of_row = np.flatnonzero(new), np.cumsum(new) - 1
    words = W.split(part.column("text").take(pa.array(first)), _RULE)
    if not len(words):
        return
    coded = words.values().dictionary_encode()
    terms = coded.dictionary.cast(pa.large_string()).cast(pa.string())
    width = len(terms)
    cell, count = np.unique(words.text_of() * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    term = cell % width
    bound = np.searchsorted(cell, np.arange(len(first) + 1) * width)

    lists = part.column("held")
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    entries = lists.flatten()
    copies = entries.field("n").to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(names)), sizes)
    numbers: dict[tuple[str, str], int] = {}
    group = np.array(
        [numbers.setdefault((names[r][0], s), len(numbers)) for r, s in zip(row, entries.field("source").to_pylist(), strict=True)], np.int64
    )
    lang, source = (pa.array([k[i] for k in numbers], pa.string()) for i in (0, 1))
    begin, n_terms = bound[of_row[row]], np.diff(bound)[of_row[row]]
    cuts = np.flatnonzero(np.diff(np.cumsum(n_terms) // _CELLS)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(row)], strict=True):
        long = n_terms[a:b]
        total = int(long.sum())
        if not total:
            continue
        at = np.arange(total) + np.repeat(begin[a:b] - (np.cumsum(long) - long), long)
        key = np.repeat(group[a:b], long) * width + term[at]
        weight = np.repeat(copies[a:b], long)
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.diff(key, prepend=-1))
        n, docs = (np.add.reduceat(x[order], head) for x in (weight * count[at], weight))
        own = key[head]
        yield pa.RecordBatch.from_arrays(
            [lang.take(pa.array(own // width)), source.take(pa.array(own // width)), terms.take(pa.array(own % width)), pa.array(n), pa.array(docs)],
            ["lang", "source", "term", "n", "docs"],
        )


def _share(n: Column | str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)), null without terms."""
    n = F.col(n) if isinstance(n, str) else n
    whole = F.expr(f"nullif(cast({total} + {SMOOTH} * {terms} as decimal(19,0)), 0)")
    parts = (n + F.lit(SMOOTH)).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + ((parts - parts % whole) / whole).cast("long")


def profiles(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, groups): shares of the kept terms that occur, and every (lang, source).

    cells: lang, source, term, p, q (the language's share), bucket, tid (number of the term in its
    bucket), block, gid. groups: lang, source, terms (kept by the language), blocks, buckets, base, block, gid.
    """
    counts = store(spark, term_counts(collapse(docs)), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= LEAST_DOCS)
    kept = store(spark, kept.select("lang", "term", "lang_n"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    cells = store(spark, counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = _rows(docs).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    sizes = sources.groupBy("lang").agg(F.ceil(F.count("*") / SIDE).alias("blocks"))
    zero = F.lit(0).cast("long")
    groups = sources.join(sizes, "lang").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"),
        F.coalesce("lang_total", zero).alias("lang_total"), "blocks",
        F.greatest(F.lit(1).cast("long"), F.ceil(F.coalesce("terms", zero) / TERMS)).alias("buckets"),
        F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block"),
    )
    groups = groups.withColumn("gid", F.row_number().over(Window.partitionBy("lang", "block").orderBy("source")).cast("long"))
    groups = groups.withColumn("gid", F.col("block") * (1 << 32) + F.col("gid"))
    groups = store(spark, groups.withColumn("base", F.coalesce(_share(zero, "total", "terms"), zero)), "groups")
    placed = kept.select("lang", "term").join(langs.select("lang", F.ceil(F.col("terms") / TERMS).alias("buckets")), "lang")
    placed = placed.select("lang", "term", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket")).repartition("lang", "bucket")
    placed = placed.withColumn("tid", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("term")).cast("long"))
    shares = (
        cells.join(groups.select("lang", "source", "total", "terms", "lang_total", "blocks", "block", "gid"), ["lang", "source"])
        .withColumn("p", _share("n", "total", "terms"))
        .withColumn("q", _share("lang_n", "lang_total", "terms"))
        .join(placed, ["lang", "term"])
    )
    cells = store(spark, shares.select("lang", "source", "term", "p", "q", "bucket", "tid", "blocks", "block", "gid"), "shares")
    return cells, groups


def _for_each_block(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows once for every pair of blocks (i, j) that their block is part of."""
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return other.select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "bucket", "gid", *columns)


def source_pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    left = _for_each_block(cells, "tid", "p")
    bases = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))
    right = _for_each_block(bases, "base", "terms", "block")
    on = ["lang", "i", "j", "bucket"]
    parts = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(_block, "lang string, a long, b long, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one = groups.select("lang", F.col("gid").alias("a"), "source")
    two = groups.select("lang", F.col("gid").alias("b"), F.col("source").alias("item"))
    return sums.join(one, ["lang", "a"]).join(two, ["lang", "b"]).select("lang", "source", "item", "value")


def _block(cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """What one bucket of terms adds to the distances between two blocks of sources."""
    empty = pd.DataFrame({"lang": pd.Series(dtype=str), "a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "value": pd.Series(dtype="int64")})
    if not len(groups):
        return empty
    lang, i, j, bucket = (groups[c].iloc[0] for c in ("lang", "i", "j", "bucket"))
    if bucket and not len(cells):
        return empty
    groups = groups.sort_values("gid")
    ids, base, block = (groups[c].to_numpy(np.int64) for c in ("gid", "base", "block"))
    apart = np.abs(base[:, None] - base[None, :])
    total = apart * int(groups["terms"].iloc[0]) if bucket == 0 else np.zeros_like(apart)
    if len(cells):
        total = total + _corrections(np.searchsorted(ids, cells["gid"].to_numpy(np.int64)), cells["tid"].to_numpy(np.int64),
                                     cells["p"].to_numpy(np.int64), base, apart)
    wanted = ((block[:, None] == i) & (block[None, :] == j)) | ((block[:, None] == j) & (block[None, :] == i))
    a, b = np.nonzero(wanted & ~np.eye(len(ids), dtype=bool))
    return pd.DataFrame({"lang": lang, "a": ids[a], "b": ids[b], "value": total[a, b]})


def _corrections(source: np.ndarray, term: np.ndarray, p: np.ndarray, base: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """By how much the terms that occur change the distances of the bases."""
    out = np.zeros_like(apart)
    order = np.lexsort((p, source))
    s, x = source[order], p[order]
    for own, lo, hi in zip(*_runs(s), strict=True):  # terms of one source against the bases of all
        held = x[lo:hi]
        below = np.searchsorted(held, base)
        total = np.concatenate([[0], np.cumsum(held)])
        far = base * below - total[below] + (total[-1] - total[below]) - base * (len(held) - below)
        far -= len(held) * apart[own]
        out[own] += far
        out[:, own] += far
    order = np.lexsort((source, term))
    s, t, x = source[order], term[order], p[order]
    for step in range(1, len(t)):  # terms that two sources have
        both = np.flatnonzero(t[step:] == t[:-step])
        if not len(both):
            break
        a, b, p_a, p_b = s[both], s[both + step], x[both], x[both + step]
        v = np.abs(p_a - p_b) - np.abs(p_a - base[b]) - np.abs(p_b - base[a]) + apart[a, b]
        np.add.at(out, (a, b), v)
        np.add.at(out, (b, a), v)
    return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    head = np.flatnonzero(np.diff(values, prepend=-1))
    return values[head], head, np.append(head[1:], len(values))


def leading_terms(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) of the first TOP terms by which a source exceeds its language."""
    over = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(over).where(F.col("rank") <= TOP)


def _ranked(rows: DataFrame) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(by))


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``, see the module's text."""
    cells, groups = profiles(spark, docs)
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = _ranked(source_pairs(cells, groups)).withColumn("part", F.lit("pair"))
    terms = leading_terms(cells).withColumn("part", F.lit("term"))
    return pairs.select(*columns).unionByName(terms.select(*columns))


#: The same rows in DuckDB, for documents with columns text, lang and source.
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}),
v AS (SELECT lang, count(*) AS terms, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
cell AS (SELECT t.lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cell GROUP BY ALL),
share AS (
  SELECT g.lang, g.source, kept.term, coalesce(cell.n, 0) AS n,
         1 + ({SCALE}::HUGEINT * (coalesce(cell.n, 0) + {SMOOTH})) // (coalesce(total, 0) + {SMOOTH} * terms) AS p,
         1 + ({SCALE}::HUGEINT * (lang_n + {SMOOTH})) // (lang_total + {SMOOTH} * terms) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN total ON total.lang = g.lang AND total.source = g.source
  LEFT JOIN cell ON cell.lang = g.lang AND cell.source = g.source AND cell.term = kept.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
), term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM share WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= {TOP}
"""
