"""Token counts from distinct pre-tokens (operator 9).

A byte-level BPE splits a text into pre-tokens and merges each on its own, so a pre-token has
the same number of pieces wherever it stands. Each distinct pre-token of the corpus is counted
once; counts are joined to the pre-token frequencies of the documents and summed. No ids are made.

Frequent pre-tokens hold most of the text. ``head_table`` gives the counts of the ``HEAD`` most frequent
ones, a table of bounded size that each task gets; their share of a document is summed where the text
is read. All other pre-tokens, however many, travel with their frequencies to the bucket of their hash,
packed by slice of documents and compressed; there each distinct one is counted once, the counts are joined to
the frequencies, and sums return by document.

Special strings inside a text are matched first, as the library does by default, and count one.

Edge cases: a null or empty text has no tokens. Texts and pre-tokens of any length are counted
whole. Rows that repeat a doc_id, or lack one, are rows of their own, told apart by partition and row number.
Only doc_id and text are read.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import words as W

#: Pre-tokens whose counts every task gets; they are at most HEAD_CHARS long, so the table has a bound.
HEAD, HEAD_CHARS = 50_000, 32
#: Occurrences in one slice of SCALE times the usual size that make a pre-token a candidate for the head.
OFTEN, SCALE = 8, 4
#: Documents whose sums a task holds before it hands them on.
HELD = 4_000_000
LIMIT = 512
#: A document of a slice: its id, if it has one, its bytes and the pieces counted so far.
_ENTRY = np.dtype([("doc_id", "<i8"), ("named", "<i8"), ("n_bytes", "<i8"), ("n", "<i8")])
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The byte-level pre-tokeniser's pattern, with the white space of Unicode spelt out.
_SPLIT = regex.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


@lru_cache(maxsize=2)
def specials(path: str) -> tuple[str, ...]:
    """Special strings of the tokenizer, the longest first."""
    import json

    names = [t["content"] for t in json.loads(_library(path).to_str())["added_tokens"] if t["special"]]
    return tuple(sorted(names, key=len, reverse=True))


def _alphabet() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_LETTERS = _alphabet()


def pieces(path: str, pre: str) -> int:
    """Number of pieces of one pre-token."""
    return len(_library(path).model.tokenize(pre.encode().decode("latin-1").translate(_LETTERS)))


def pre_tokens(text: str, special: tuple[str, ...]) -> tuple[list[str], int]:
    """(pre-tokens, special strings found) of a whole text."""
    if not any(s in text for s in special):
        return _SPLIT.findall(text), 0
    parts = regex.split("|".join(map(regex.escape, special)), text)
    return [t for p in parts for t in _SPLIT.findall(p)], len(parts) - 1


def head_table(docs: DataFrame, path: str) -> dict[str, int]:
    """Pieces of frequent pre-tokens: those that some slice holds OFTEN times, the most frequent HEAD of them.

    Which pre-tokens are here affects only how far they travel, never a count.
    """
    special = specials(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, scale=SCALE):
            total: Counter = Counter()
            for text in part.column("text").to_pylist():
                total.update(pre_tokens(text or "", special)[0])
            often = [(p, n) for p, n in total.items() if n >= OFTEN and len(p) <= HEAD_CHARS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())], ["pre", "n"]
            )

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "pre string, n long")
    best = counted.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(HEAD)
    return {r["pre"]: pieces(path, r["pre"]) for r in best.select("pre").collect()}


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _tail(pre: list[str], order: list[int], n: list[int], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed (pre, ord, n)) of a slice's rare pre-tokens, sorted so that equal ones lie together."""
    bucket = np.fromiter((xxhash.xxh32_intdigest(p) % buckets for p in pre), np.int32, len(pre))
    table = pa.table({"b": bucket, "pre": pa.array(pre, pa.string()), "ord": np.array(order, np.int32), "n": np.array(n, np.int32)})
    table = table.sort_by([("b", "ascending"), ("pre", "ascending"), ("ord", "ascending")]).combine_chunks()
    bucket = table.column("b").to_numpy()
    for b in np.unique(bucket):
        lo, hi = np.searchsorted(bucket, [b, b + 1])
        yield int(b), _pack(table.slice(lo, hi - lo).select(["pre", "ord", "n"]))


def token_counts(spark: SparkSession, docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of docs."""
    special = specials(path)
    head = spark.sparkContext.broadcast(head_table(docs, path))
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each slice of documents (key below 0), and one for each of its buckets of rare pre-tokens."""
        from pyspark import TaskContext

        known = head.value
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 40
        for part in W.slices(batches, scale=SCALE):
            sizes, sums, tail = [], [], ([], [], [])
            for i, text in enumerate(part.column("text").to_pylist()):
                text = text or ""
                found, total = pre_tokens(text, special)
                for pre, n in Counter(found).items():
                    own = known.get(pre)
                    if own is not None:
                        total += own * n
                    else:
                        tail[0].append(pre)
                        tail[1].append(i)
                        tail[2].append(n)
                sizes.append(len(text.encode()))
                sums.append(total)
            ids = part.column("doc_id")
            head_rows = np.zeros(part.num_rows, _ENTRY)
            head_rows["doc_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            head_rows["named"] = ids.is_valid().to_numpy(zero_copy_only=False)
            head_rows["n_bytes"], head_rows["n"] = sizes, sums
            packed = list(_tail(*tail, buckets))
            keys = [-1 - zlib.crc32(str(base).encode()) % buckets, *(b for b, _ in packed)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int32()), pa.array(np.full(len(keys), base)),
                    pa.array([head_rows.tobytes(), *[None] * len(packed)], pa.binary()),
                    pa.array([None, *(v for _, v in packed)], pa.binary()),
                ],
                ["bucket", "base", "head", "tail"],
            )
            base += part.num_rows

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count each distinct pre-token of a bucket once, and join the counts to its frequencies.

        What a task has counted for a slice of documents leaves as one row of sums.
        """
        bucket, counted = None, {}
        sums: dict[int, np.ndarray] = {}

        def row(base, head, total):
            arrays = [pa.array([base], pa.int64()), pa.array([head], pa.binary()), pa.array([total], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["base", "head", "sums"])

        def flush():
            for base, total in sums.items():
                yield row(base, None, total.tobytes())
            sums.clear()

        for batch in batches:
            for key, base, head_rows, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if raw is None:
                    yield row(base, head_rows, None)
                    continue
                if key != bucket:
                    bucket, counted = key, {}
                table = pa.ipc.open_stream(raw).read_all()
                coded = table.column("pre").combine_chunks().dictionary_encode()
                names = coded.dictionary.to_pylist()
                for name in names:
                    if name not in counted:
                        counted[name] = pieces(path, name)
                own = np.fromiter((counted[name] for name in names), np.int64, len(names))
                n = own[coded.indices.to_numpy()] * table.column("n").to_numpy()
                sums[base] = _add(sums.get(base), np.bincount(table.column("ord").to_numpy(), n).astype(np.int64))
            if sum(map(len, sums.values())) > HELD:
                yield from flush()
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add the sums of each slice of documents, whose rows come one after the other."""
        current, entry, total = None, None, None

        def documents():
            n = entry["n"].copy()
            if total is not None:
                n[: len(total)] += total
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(entry["doc_id"].copy(), mask=entry["named"] == 0), pa.array(entry["n_bytes"].copy()),
                    pa.array(n), pa.array(n > limit),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        for batch in batches:
            for base, head_rows, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if base != current:
                    if current is not None:
                        yield documents()
                    current, entry, total = base, None, None
                if head_rows is not None:
                    entry = np.frombuffer(head_rows, _ENTRY)
                else:
                    total = _add(total, np.frombuffer(raw, np.int64))
        if current is not None:
            yield documents()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    split = rows.mapInArrow(read, "bucket int, base long, head binary, tail binary")
    parts = split.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "base long, head binary, sums binary")
    return (
        parts.repartition("base").sortWithinPartitions("base")
        .mapInArrow(merge, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
    )


def _add(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """Sum of two arrays, the shorter one continued by zeros."""
    if a is None:
        return b
    if len(a) < len(b):
        a, b = b, a
    out = a.copy()
    out[: len(b)] += b
    return out
