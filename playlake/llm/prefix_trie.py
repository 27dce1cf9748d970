"""Prefix trie of conversations, its subtrees summed by time-forward processing (operator 13).

1. ``ordered_turns``: turns get their places by range partitions of (conversation, turn), so that a
   conversation may span several tasks; only a digest and the size of each turn go on.
2. ``rebuilt``: a conversation starts with the first h turns of its base conversation, then come its
   own turns after its first h (h and base follow from its number).
3. ``paths``: each place of a rebuilt conversation gets the key of its prefix, the exclusive or of
   128-bit digests of (depth, turn). Keys of long conversations are put together from blocks of ``STEP`` turns.
4. ``nodes``: equal prefixes are one node, named by its smallest member and its depth.
5. ``subtrees``: a node with at most ``SHARD`` members whose parent has more is the root of a unit. Units are dealt to
   shards. Each shard sorts its nodes by reverse level order (Spark's sort, which spills) and
   passes what a subtree adds up to to the parent through a priority queue that
   spills sorted runs (``Queue``). What unit roots send goes to the nodes above them, which form a
   smaller tree; they are summed by node before the shuffle and sharded in the same way, with units ``GROWTH`` times as large,
   until the root itself is in a unit. So no shard grows with the trie, and a prefix that a third of
   all conversations share is split into units of bounded size.
6. ``ends``: the numbers of conversations that end at a node are sorted by range partitions,
   written out in pieces, and the pieces go through SHA-256 in order.

Edge cases: rows without conv_id belong to no conversation. Null turns come first; turns with equal
numbers are ordered by role, then by text, and equal rows stay two turns. A null role or text is an empty one.
A base conversation that is not there, or is shorter, lends fewer turns; a conversation left without
turns ends at the root. For negative numbers remainders keep the sign of the dividend, as in SQL. An empty table
has no root. Only conv_id, turn, role and text are read.

One path is not split: a conversation of n turns that no other shares is n nodes of one unit, which pass
through a task in order, in bounded memory.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm.common import store

#: Turns a conversation may take from its base, and how many conversations share a base.
HEADS, FAMILY = 9, 5
#: Turns of a conversation whose prefix keys one window adds up.
STEP = 512
#: Members of a unit in the first round, and by how much units grow with each round.
SHARD, GROWTH = 250, 64
#: Messages that a queue holds in memory, and numbers in a piece of an end list.
HELD, PIECE = 500_000, 8192
_KEY = ["depth", "x1", "x2"]
_SUMS = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean"


def ordered_turns(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, pid, place, d1, d2, bytes): the turns in order; place counts within (pid, conv_id)."""
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv_id", "turn", "role", "text", "tie"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, conv, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            convs, places, digests, sizes = batch.column("conv_id").to_pylist(), [], [], []
            for c, role, text in zip(convs, batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                place = place + 1 if c == conv else 0
                conv = c
                role, text = role.encode(), text.encode()
                places.append(place)
                sizes.append(len(text))
                digests.append(hashlib.blake2b(b"%d:%b%b" % (len(role), role, text), digest_size=16).digest())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), pa.array(np.full(len(convs), pid, np.int32)), pa.array(places, pa.int64()),
                    pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(sizes, pa.int64()),
                ],
                ["conv_id", "pid", "place", "d1", "d2", "bytes"],
            )

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # stored once: later steps must see the same range partitions
    return store(spark, ranged.mapInArrow(run, "conv_id long, pid int, place long, d1 long, d2 long, bytes long"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, rows): convs (c, size) of every conversation, rows (c, depth, d1, d2, bytes) of its rebuilt turns."""
    parts = turns.groupBy("conv_id", "pid").agg(F.count("*").alias("m"))
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.withColumn("shift", F.sum("m").over(before)).where("shift is not null").select("conv_id", "pid", "shift")
    # a conversation goes on in another partition at most once for each partition
    placed = turns.join(F.broadcast(shift), ["conv_id", "pid"], "left").withColumn("place", F.col("place") + F.coalesce("shift", F.lit(0)))
    sizes = parts.groupBy("conv_id").agg(F.sum("m").alias("m"))
    convs = sizes.select(
        F.col("conv_id").alias("c"), "m", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"),
    )
    lent = sizes.select(F.col("conv_id").alias("base"), F.col("m").alias("base_m"))
    convs = convs.join(lent, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_m", F.lit(0))))
    own = placed.join(convs.select(F.col("c").alias("conv_id"), "h", "taken"), "conv_id").where("place >= h")
    own = own.select(F.col("conv_id").alias("c"), (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "d1", "d2", "bytes")
    given = placed.where(F.col("place") < HEADS - 1).join(convs.select("c", F.col("base").alias("conv_id"), "h"), "conv_id").where("place < h")
    given = given.select("c", (F.col("place") + 1).alias("depth"), "d1", "d2", "bytes")
    convs = convs.select("c", (F.col("taken") + F.greatest(F.col("m") - F.col("h"), F.lit(0))).cast("int").alias("size"))
    return convs, own.unionByName(given).withColumn("depth", F.col("depth").cast("int"))


def paths(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(c, depth, x1, x2, bytes): the key of the prefix that ends at each turn of a conversation."""
    rows = rows.select(
        "c", "depth", "bytes", (F.col("depth") / STEP).cast("int").alias("block"),
        F.xxhash64("depth", "d1", "d2").alias("e1"), F.xxhash64("d2", "depth", "d1").alias("e2"),
    )
    so_far = Window.partitionBy("c", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = store(spark, rows.select("c", "depth", "bytes", "block", *[F.bit_xor(e).over(so_far).alias(x) for e, x in (("e1", "x1"), ("e2", "x2"))]), "blocks")
    # the last turn of each full block has the block's key; most conversations have no full block
    full = rows.where((F.col("depth") + 1) % STEP == 0).select("c", (F.col("block") + 1).alias("block"), F.col("x1").alias("o1"), F.col("x2").alias("o2"))
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = full.select("c", "block", *[F.bit_xor(o).over(earlier).alias(o) for o in ("o1", "o2")])
    zero = F.lit(0).cast("long")
    return rows.join(offsets, ["c", "block"], "left").select(
        "c", "depth", "bytes", *[F.col(x).bitwiseXOR(F.coalesce(o, zero)).alias(x) for x, o in (("x1", "o1"), ("x2", "o2"))]
    )


def nodes(spark: SparkSession, keys: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, depth, conv_id, n, bytes): the node at each place of each conversation, the root included."""
    keys = store(spark, keys, "paths")
    found = keys.groupBy(*_KEY).agg(F.min("c").alias("conv_id"), F.count("*").alias("n"))
    below = keys.join(found, _KEY).select("c", "depth", "conv_id", "n", "bytes")
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n")).first()
    zero = F.lit(0).cast("long")
    top = convs.select("c", F.lit(0).alias("depth"), F.lit(root["conv_id"]).cast("long").alias("conv_id"), F.lit(root["n"]).cast("long").alias("n"), zero.alias("bytes"))
    return store(spark, below.unionByName(top), "nodes")


class Queue:
    """A priority queue of messages (level, conv, children, leaves, saved) that spills sorted runs.

    A run is an anonymous file of this task alone, read again in blocks; it ends with the task, and a task
    that is run again starts anew.
    """

    def __init__(self, held: int | None = None):
        self.held, self.heap, self.runs = held or HELD, [], []

    def push(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) >= self.held:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        run.write(np.array(sorted(self.heap), np.int64).tobytes())
        run.seek(0)
        self.heap = []
        self._next(self._read(run))

    @staticmethod
    def _read(run) -> Iterator[tuple]:
        with run:
            while block := run.read(40 * 4096):
                yield from map(tuple, np.frombuffer(block, np.int64).reshape(-1, 5).tolist())

    def _next(self, run: Iterator[tuple]) -> None:
        if (message := next(run, None)) is not None:
            heapq.heappush(self.runs, (message, id(run), run))

    def take(self, level: int, conv: int) -> tuple[int, int, int]:
        """Sums (children, leaves, saved) of all messages to a node, which leave the queue."""
        children = leaves = saved = 0
        while True:
            if self.heap and self.heap[0][:2] == (level, conv):
                message = heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:2] == (level, conv):
                message, _, run = heapq.heappop(self.runs)
                self._next(run)
            else:
                return children, leaves, saved
            children, leaves, saved = children + message[2], leaves + message[3], saved + message[4]


def _time_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a shard in reverse level order, with the sums of their subtrees."""
    queue = Queue()
    for batch in batches:
        names = ("conv_id", "depth", "parent", "n", "bytes", "children", "leaves", "saved", "top")
        out = []
        for conv, depth, parent, n, size, children, leaves, saved, top in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            more = queue.take(-depth, conv)
            children, leaves, saved = children + more[0], leaves + more[1], saved + more[2] + (n - 1) * size
            leaves = leaves if children else 1
            if not top:
                queue.push((1 - depth, parent, 1, leaves, saved))
            out.append((conv, depth, parent, n, children, leaves, saved, top))
        kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_())
        names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "top")
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], list(names))


def subtrees(spark: SparkSession, held: DataFrame, total: int) -> DataFrame:
    """One row for each node of ``nodes`` with its parent and the sums of its subtree."""
    above = held.select("c", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent"))
    tree = store(spark, held.where("c = conv_id").join(above, ["c", "depth"], "left").drop("c"), "tree")
    done: DataFrame | None = None
    low, bound = 0, SHARD
    zero = F.lit(0).cast("long")
    while low < total:
        band = (F.col("n") > low) & (F.col("n") <= bound)
        units = held.where(band).groupBy("c").agg(F.min(F.struct("depth", "conv_id")).alias("unit"))
        part = tree.where(band).join(units, F.col("conv_id") == F.col("c")).drop("c")
        if done is None:
            part = part.withColumns({"children": zero, "leaves": zero, "saved": zero})
        else:
            sent = done.where("top").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
                F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
            )
            part = part.join(sent, ["conv_id", "depth"], "left").fillna(0, ["children", "leaves", "saved"])
        top = (F.col("unit.conv_id") == F.col("conv_id")) & (F.col("unit.depth") == F.col("depth"))
        shards = part.withColumn("top", top).repartition("unit").sortWithinPartitions(F.desc("depth"), "conv_id")
        shards = shards.select("conv_id", "depth", "parent", "n", "bytes", "children", "leaves", "saved", "top")
        found = store(spark, shards.mapInArrow(_time_forward, _SUMS), "sums")
        done = found if done is None else done.unionByName(found)
        low, bound = bound, bound * GROWTH
    return done.drop("top")


def ends(held: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end."""
    last = held.join(convs.select("c", F.col("size").alias("depth")), ["c", "depth"]).select("conv_id", "depth", "c")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, depth, c = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("conv_id", "depth", "c"))
            new = np.ones(len(c), bool)
            new[1:] = (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])
            run = np.flatnonzero(new)
            cuts = [k for a, b in zip(run, [*run[1:], len(c)], strict=True) for k in range(a, b, PIECE)]
            text = [",".join(map(str, c[a:b].tolist())) for a, b in zip(cuts, [*cuts[1:], len(c)], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[cuts]), pa.array(depth[cuts]), pa.array(c[cuts]), pa.array(text, pa.string())],
                ["conv_id", "depth", "first", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for conv, depth, ids in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "depth", "ids")), strict=True):
                if (conv, depth) != node:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield _digest_rows(out)
        if node:
            yield _digest_rows([(*node, sha.hexdigest())])

    order = ["conv_id", "depth", "c"]
    parts = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "conv_id long, depth int, first long, ids string")
    parts = parts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return parts.mapInArrow(digests, "conv_id long, depth int, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "depth", "ends_sha256"])


def trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rows = rebuilt(ordered_turns(spark, conversations))
    convs = store(spark, convs, "convs")
    held = nodes(spark, paths(spark, rows), convs)
    sums = subtrees(spark, held, max(1, convs.count()))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return sums.join(ends(held, convs), ["conv_id", "depth"], "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


#: The same rows in DuckDB, for conversations with columns conv_id, turn, role and text. The number of
#: lent turns is a CRC-32 of the decimal number, by bits, as DuckDB has no such function.
ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
                            ORDER BY turn NULLS FIRST, encode(coalesce(role, '')), encode(coalesce(text, ''))) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), k AS (
  SELECT c, w, c - c % 5 AS base, c::VARCHAR AS s FROM t
), hashed AS (
  SELECT c, w, base, xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                               lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)),
      4294967295::BIGINT) % 9 AS h
  FROM k
), own AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.w, 1, a.h), []), coalesce(list_slice(a.w, a.h + 1, len(a.w)), [])) AS w
  FROM hashed a LEFT JOIN t b ON b.c = a.base
), p AS (
  SELECT c, len(w) AS size, unnest(range(0, len(w) + 1)) AS depth, w FROM own
), q AS (
  SELECT c, size, depth, sha256(list_slice(w, 1, depth)::VARCHAR || '#' || to_json(list_slice(w, 1, depth))::VARCHAR) AS node,
         CASE WHEN depth = 0 THEN 0 ELSE strlen(w[depth].x) END AS bytes
  FROM p
), n AS (
  SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM q GROUP BY depth, node
), placed AS (
  SELECT q.c, q.depth, n.conv_id FROM q JOIN n USING (depth, node)
), up AS (
  SELECT n.conv_id, n.depth, placed.depth AS above, placed.conv_id AS above_conv, (n.n_convs - 1) * n.bytes AS saved
  FROM n JOIN placed ON placed.c = n.conv_id AND placed.depth <= n.depth
), kids AS (
  SELECT above_conv AS conv_id, above AS depth, count(*) AS n_children FROM up WHERE depth = above + 1 GROUP BY ALL
), sums AS (
  SELECT above_conv AS conv_id, above AS depth, sum(saved)::BIGINT AS saved_tokens,
         count(*) FILTER (WHERE kids.n_children IS NULL) AS n_leaves
  FROM up LEFT JOIN kids ON kids.conv_id = up.conv_id AND kids.depth = up.depth GROUP BY ALL
)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent.above_conv AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(kids.n_children, 0)::BIGINT AS n_children, sums.n_leaves::BIGINT AS n_leaves, sums.saved_tokens, n.ends_sha256
FROM n JOIN sums ON sums.conv_id = n.conv_id AND sums.depth = n.depth
LEFT JOIN kids ON kids.conv_id = n.conv_id AND kids.depth = n.depth
LEFT JOIN up parent ON parent.conv_id = n.conv_id AND parent.depth = n.depth AND parent.above = n.depth - 1
"""
