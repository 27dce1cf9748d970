"""SentencePiece BPE encoding with byte offsets, and decoding (operator 4).

The model file is read as a protocol buffer: pieces, scores, and the normaliser with its
compiled character map. ``Normalizer`` applies the map by longest prefix (a double-array trie)
and records, for each byte it writes, the source byte it came from. BPE merges never
cross from a piece's letters to a following space mark (checked when the model is loaded), so the
normalised text falls into chunks (space marks and the letters after them) that are encoded on
their own; a worker remembers the ids of chunks in ``CACHE_BYTES``. Piece lengths
summed over a text and looked up in the alignment give each piece's span of source bytes.

Edge cases: a null or empty text has no pieces, and its decoded text is empty. Texts of any
length are encoded whole; a long chunk is merged with a heap. Rows are independent, so
repeated or missing doc_ids change nothing. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import words as W

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5
#: Bytes of chunks that a worker remembers (two generations of half of it), and of the longest chunk.
CACHE_BYTES, CACHE_BYTES_EACH = 24 << 20, 96
#: What a remembered chunk takes beside its letters and ids: two objects and a place in the dictionary.
_ENTRY = 200
#: Characters up to which chunks are merged many at a time, in groups of like length; the rank of a pair that is no piece.
GROUPS, _NEVER = (4, 8, 12, 16, 24, 48), 1 << 30
_MARK = SPACE.encode()
#: Characters that are no piece get numbers from here on, so that no pair with them is found.
_STRANGE = 1 << 21
#: Size of what a worker encodes at a time, in slices, and after how many of them it gives freed memory back.
_SLICE, _EVERY = 0.5, 4


class Normalizer:
    """Longest-prefix rewriting by a compiled character map, with alignment to the source."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool):
        self.dummy_prefix, self.squeeze, self.escape = dummy_prefix, squeeze, escape
        self.units = np.empty(0, np.uint32)
        self.strings = b""
        if charsmap:
            size = int.from_bytes(charsmap[:4], "little")
            self.units = np.frombuffer(charsmap[4: 4 + size], "<u4")
            self.strings = charsmap[4 + size:]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(source bytes, replacement) of the longest mapped prefix at a place."""
        units, node, best = self.units, 0, None
        node ^= self._offset(units[0])
        for k in range(at, len(raw)):
            node ^= raw[k]
            unit = int(units[node])
            if unit & 0x800000FF != raw[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                value = int(units[node]) & 0x7FFFFFFF
                best = (k + 1 - at, self.strings[value: self.strings.index(0, value)])
        return best

    @staticmethod
    def _offset(unit: int) -> int:
        unit = int(unit)
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def rewrite(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """(mapped bytes, source byte of each, with the source's length at the end)."""
        if not len(self.units):
            return raw, np.arange(len(raw) + 1, dtype=np.int32 if len(raw) < 1 << 31 else np.int64)
        out, source, k = bytearray(), [], 0
        while k < len(raw):
            found = self.longest(raw, k)
            if found:
                step, new = found
            else:
                step = 1 if raw[k] < 0x80 else 2 if raw[k] < 0xE0 else 3 if raw[k] < 0xF0 else 4
                new = raw[k: k + step]
            out += new
            source += [k] * len(new)
            k += step
        return bytes(out), np.array([*source, len(raw)])

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """(normalised text, source byte of each of its bytes, with the source's length at the end)."""
        raw, source = self.normalise(text)
        return raw.decode(), source

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised text in UTF-8, source byte of each of its bytes, with the source's length at the end)."""
        raw, source = self.rewrite(text.encode())
        if self.squeeze:
            keep = np.frombuffer(raw, np.uint8) != 0x20
            first = keep.copy()
            first[1:] |= keep[:-1]  # a space after a letter stays, unless nothing follows it
            first[: int(keep.argmax()) if keep.any() else len(keep)] = False
            last = len(keep) - int(keep[::-1].argmax()) if keep.any() else 0
            first[last:] = False
            raw = np.frombuffer(raw, np.uint8)[first].tobytes()
            source = np.append(source[:-1][first], source[-1])
        if not raw:
            return b"", source[-1:]
        if self.dummy_prefix:
            raw, source = b" " + raw, np.concatenate([source[:1], source])
        if self.escape:
            wide = np.where(np.frombuffer(raw, np.uint8) == 0x20, 3, 1)
            source = np.append(np.repeat(source[:-1], wide), source[-1])
            raw = raw.replace(b" ", SPACE.encode())
        return raw, source


@dataclass
class Codec:
    """Pieces, scores and normaliser of a model file."""

    ids: dict[str, int]
    scores: list[float]
    surface: list[bytes]
    byte_ids: list[int]
    unknown: int
    normalizer: Normalizer
    young: dict[bytes, bytes] = field(default_factory=dict)
    old: dict[bytes, bytes] = field(default_factory=dict)
    held: int = 0

    def __post_init__(self):
        self.kind = np.dtype("<u2" if len(self.surface) <= 1 << 16 else "<u4")
        sizes = np.ones(len(self.surface), np.uint8)  # a byte piece stands for one byte
        for piece, i in self.ids.items():
            sizes[i] = len(piece.encode())
        self.sizes = sizes
        self.decimals = [str(i).encode() for i in range(len(self.surface))]
        letters = sorted((ord(p), i) for p, i in self.ids.items() if len(p) == 1)
        self.letter, self.letter_id = (np.array([x[k] for x in letters], np.int64) for k in (0, 1))
        # every way to join two pieces to one, by the rank of the joined piece's score; equal scores have equal ranks
        rank = {c: k for k, c in enumerate(sorted({-self.scores[i] for i in self.ids.values()}))}
        get, joins = self.ids.get, []
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = get(p[:k]), get(p[k:])
                if a is not None and b is not None:
                    joins.append((a << 32 | b, rank[-self.scores[i]], i))
        joins.sort()
        self.pair, self.pair_rank, self.pair_id = (np.array([x[k] for x in joins], np.int64) for k in (0, 1, 2))

    @classmethod
    def load(cls, path: str) -> Codec:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        ids, surface, byte_ids, unknown = {}, [], [-1] * 256, 0
        for i, p in enumerate(model.pieces):
            if p.type in (_NORMAL, _USER, _UNUSED):
                ids[p.piece] = i
            if p.type == _BYTE:
                byte_ids[int(p.piece[3:5], 16)] = i
                surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == _CONTROL:
                surface.append(b"")
            elif p.type == _UNKNOWN:
                unknown = i
                surface.append(model.trainer_spec.unk_surface.encode())
            else:
                surface.append(p.piece.replace(SPACE, " ").encode())
        plain = all(p.type not in (_USER, _UNUSED) for p in model.pieces)
        if model.trainer_spec.model_type != 2 or not plain or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback and without user-defined or unused pieces is needed")
        if any(len(p.encode()) > 255 for p in ids):
            raise ValueError("a piece is longer than 255 bytes")
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece holds a space mark after letters, so chunks cannot be encoded alone")
        normalizer = Normalizer(
            spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        )
        return cls(ids, [p.score for p in model.pieces], surface, byte_ids, unknown, normalizer)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the piece that each two numbers join to, or _NEVER."""
        if not len(self.pair):
            return np.full(a.shape, _NEVER)
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], _NEVER)

    def merge_rows(self, part: np.ndarray) -> np.ndarray:
        """BPE on every row (numbers, then -1): join the neighbouring pair of the best rank, the leftmost of equals, until none is a piece."""
        part = np.pad(part, ((0, 0), (0, 1)), constant_values=-1)  # a last column that stays empty
        cost = np.where(part[:, 1:] >= 0, self._rank(part[:, :-1], part[:, 1:]), _NEVER)
        cost = np.pad(cost, ((0, 0), (0, 1)), constant_values=_NEVER)
        out, rows = part.copy(), np.arange(len(part))
        width = np.arange(part.shape[1] - 1)
        while len(rows):
            k = cost.argmin(1)
            here = np.arange(len(rows))
            low = cost[here, k]
            going = low < _NEVER
            if not going.all():
                out[rows[~going]] = part[~going]
                rows, part, cost, k = rows[going], part[going], cost[going], k[going]
                here = here[: len(rows)]
                if not len(rows):
                    break
            part[here, k] = self.pair_id[np.searchsorted(self.pair, (part[here, k] << 32) | part[here, k + 1])]
            rest = width[None, :]  # what stands after the joined pair moves one place to the left
            part[:, :-1] = np.take_along_axis(part, rest + (rest > k[:, None]), 1)
            cost[:, :-1] = np.take_along_axis(cost, rest + (rest >= k[:, None]), 1)
            joined, after = part[here, k], part[here, k + 1]
            cost[here, k] = np.where(after >= 0, self._rank(joined, after), _NEVER)
            before = np.flatnonzero(k > 0)
            cost[before, k[before] - 1] = self._rank(part[before, k[before] - 1], joined[before])
        return out

    def merge_all(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk, ``kind`` each."""
        text = [c.decode() for c in chunks]
        long = np.array([len(t) for t in text], np.int64)
        out: list[bytes] = [b""] * len(chunks)
        low = 0
        for high in GROUPS:
            some = np.flatnonzero((long > low) & (long <= high))
            low = high
            if not len(some):
                continue
            letters = np.frombuffer("".join([text[i] for i in some]).encode("utf-32-le"), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(self.letter, letters), max(0, len(self.letter) - 1))
            number = np.where(self.letter[at] == letters, self.letter_id[at], _STRANGE + letters)
            part = np.full((len(some), high), -1, np.int64)
            part[np.arange(high)[None, :] < long[some][:, None]] = number
            done = self.merge_rows(part)
            odd = (done >= _STRANGE).any(1)
            for i, numbers in zip(some[odd].tolist(), done[odd].tolist(), strict=True):
                out[i] = self._spelt([x if x < _STRANGE else chr(x - _STRANGE) for x in numbers if x >= 0])
            some, done = some[~odd], done[~odd]
            filled = done >= 0
            raw, wide = done[filled].astype(self.kind).tobytes(), self.kind.itemsize
            begin = 0
            for i, end in zip(some.tolist(), (wide * np.cumsum(filled.sum(1))).tolist(), strict=True):
                out[i] = raw[begin:end]
                begin = end
        for i in np.flatnonzero(long > low):
            out[i] = self._spelt([self.ids.get(p, p) for p in self._merge_long(text[i])])
        return out

    def _spelt(self, pieces: list) -> bytes:
        """Ids of pieces; a character that is no piece is spelt in bytes."""
        numbers: list[int] = []
        for p in pieces:
            numbers += [p] if isinstance(p, int) else [self.byte_ids[b] for b in p.encode()]
        return np.array(numbers, self.kind).tobytes()

    def _merge_long(self, chunk: str) -> list[str]:
        """The same by a heap of pairs, in time that grows with n log n."""
        ids, scores = self.ids, self.scores
        part: list[str] = list(chunk)
        n = len(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int]] = []

        def offer(left: int, right: int) -> None:
            own = part[left] + part[right]
            if (i := ids.get(own)) is not None:
                heapq.heappush(heap, (-scores[i], left, len(own)))

        for k in range(n - 1):
            offer(k, k + 1)
        while heap:
            _, left, size = heapq.heappop(heap)
            right = after[left] if part[left] else n
            if right >= n or len(part[left]) + len(part[right]) != size:
                continue  # one side has been joined to another meanwhile
            part[left] += part[right]
            part[right] = ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [p for p in part if p]

    def chunks(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks, ``kind`` each.

        Chunks met lately are remembered in two generations: when the young one is full it takes the
        old one's place, and chunks that are met again move up, so frequent ones stay.
        """
        young, old = self.young.get, self.old.get
        out = [young(c) or old(c) for c in chunks]
        new = [i for i, found in enumerate(out) if found is None]
        for i, found in zip(new, self.merge_all([chunks[i] for i in new]), strict=True):
            out[i] = found
        for c, found in zip(chunks, out, strict=True):
            if len(c) <= CACHE_BYTES_EACH and c not in self.young:
                self.held += _ENTRY + len(c) + len(found)
                if self.held > CACHE_BYTES // 2:
                    self.old, self.young, self.held = self.young, {}, 0
                self.young[c] = found
        return out

    def numbers(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of normalised texts. All of them are cut into chunks at once; each distinct chunk is looked up once."""
        raw = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not len(raw):
            return [np.empty(0, self.kind)] * len(texts)
        new = np.zeros(len(raw) + 1, bool)
        mark = np.zeros(len(raw), bool)
        mark[:-2] = (raw[:-2] == _MARK[0]) & (raw[1:-1] == _MARK[1]) & (raw[2:] == _MARK[2])
        at = np.flatnonzero(mark)
        new[at[(at < 3) | ~mark[at - 3]]] = True  # the first of neighbouring marks
        new[offsets] = True
        start = np.flatnonzero(new[:-1])
        values = pa.Array.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(raw)).astype(np.int64)), pa.py_buffer(raw)]
        ).dictionary_encode()
        which = values.indices.to_numpy(zero_copy_only=False)
        found = self.chunks(values.dictionary.to_pylist())
        wide = self.kind.itemsize
        flat = np.frombuffer(b"".join(found), self.kind)
        size = np.array([len(f) for f in found], np.int64) // wide
        begin = np.cumsum(size) - size
        size, begin = size[which], begin[which]
        ends = np.cumsum(size)
        every = flat[np.arange(int(ends[-1])) + np.repeat(begin - (ends - size), size)]
        cuts = np.concatenate([[0], ends])[np.searchsorted(start, offsets)]
        return [every[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def ends(self, numbers: np.ndarray) -> np.ndarray:
        """Where each piece ends in the normalised bytes, after a 0."""
        return np.concatenate([[0], np.cumsum(self.sizes[numbers], dtype=np.int64)])

    def decode_part(self, numbers: list[int]) -> str:
        return b"".join([self.surface[i] for i in numbers]).decode("utf-8", "replace")

    def decode(self, numbers: list[int]) -> str:
        """Text of a whole sequence: the prefix space that encoding adds is taken off."""
        text = self.decode_part(numbers)
        return text[1:] if self.normalizer.dummy_prefix and text.startswith(" ") else text

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """(ids, spans): spans[k] is the pair of source bytes that piece k covers."""
        normal, source = self.normalizer.normalise(text)
        numbers = self.numbers([normal])[0]
        ends = self.ends(numbers)
        return numbers.tolist(), np.stack([source[ends[:-1]], source[ends[1:]]], 1).astype(np.int64)

    def forget(self) -> None:
        """Drop the remembered chunks: a worker that a task has ended in may stay for other work."""
        self.young, self.old, self.held = {}, {}, 0


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec.load(path)


def _open(path: str) -> Codec:
    """The model by its path, or by name among the files that the job has shipped."""
    import os

    return codec(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def _slices(batches: Iterator[pa.RecordBatch], own: Codec) -> Iterator[pa.RecordBatch]:
    """Slices of a task's batches; what was freed is given back meanwhile, and the remembered chunks at the end."""

    def parts() -> Iterator[pa.RecordBatch]:
        yield from W.slices(batches, scale=_SLICE)
        own.forget()

    return W.released(parts(), _EVERY)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, spanned) of every row of docs.

    spanned counts the source bytes that the pieces' spans cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _open(model)
        sha, decimal, surface = hashlib.sha256, own.decimals.__getitem__, own.surface.__getitem__
        for part in _slices(batches, own):
            out = []
            normal = [own.normalizer.normalise(t.as_py() or "") for t in part.column("text")]
            numbers_of = own.numbers([n[0] for n in normal])
            for (_, source), numbers in zip(normal, numbers_of, strict=True):
                ends = own.ends(numbers)
                # the heads of bytes written from one source byte: their distance is what a span covers
                covered = int((source[ends[1:]] - source[ends[:-1]]).sum())
                numbers = numbers.tolist()
                decoded = b"".join(map(surface, numbers)).decode("utf-8", "replace")
                if own.normalizer.dummy_prefix and decoded.startswith(" "):
                    decoded = decoded[1:]
                ids = b",".join(map(decimal, numbers))
                out.append((len(numbers), sha(ids).hexdigest(), sha(decoded.encode()).hexdigest(), int(source[-1]), covered))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c) for c in columns)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spanned"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spanned long"
    )


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, starts, ends) of every row of docs: each piece's id and span of source bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _open(model)
        for part in _slices(batches, own):
            got = [own.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                    pa.array([g[1][:, 0] for g in got], pa.list_(pa.int64())),
                    pa.array([g[1][:, 1] for g in got], pa.list_(pa.int64())),
                ],
                ["doc_id", "ids", "starts", "ends"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, starts array<long>, ends array<long>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of every row of encoded (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _open(model)
        for batch in batches:
            text = [own.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
