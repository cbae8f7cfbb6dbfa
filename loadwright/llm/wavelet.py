"""Token ids of a corpus in wavelet-matrix files.

Documents are sorted by ``doc_id`` over range partitions, tokenised, and
written in shards of about ``SHARD_TOKENS`` ids; a document is never cut.  A
shard is one compressed file image: a document table and, for each bit of an
id, a bit-plane with a rank directory.  It supports access, counting and
occurrence lookup without being unpacked to ids.  The images are written by
Spark as rows of a Parquet table below the shared folder, so a lost executor's
shards are written again and only committed ones are seen.

Image: ``WVM1``, then (little-endian) levels u32, n u64, docs u64; doc ids i64;
doc-is-null bytes; ends u64; per level the zeros u64, a packed-size u64 and the
zstd-compressed plane, whose rank directory (u32 per ``BLOCK`` bits) follows.

Defined results: a null or empty text is its end id alone; a null ``doc_id``
sorts first and stays null; rows that repeat a ``doc_id`` are ordered by a hash
of their text and written each; an empty table gives no shard and no row.
Only the id and text columns are read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadwright.llm.common import map_batches, settle, small_batches
from loadwright.llm.tokens import END_ID, default_path, encoder

MAGIC = b"WVM1"
SHARD_TOKENS = 1 << 20
BLOCK = 512
#: Characters of the texts that are encoded together, and pieces that a worker remembers (about 130 MB), also from task to task.
CHUNK_CHARS = 8 << 20
CACHE_PIECES = 600_000


def _top(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The first ``bits`` (0 to 63) bits of 64-bit words."""
    return words >> np.uint64(1) >> (63 - bits).astype(np.uint64)


class WaveletShard:
    """Succinct bit-planes of one shard, most significant bit first."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray], n: int,
                 doc_ids: list[int | None], ends: np.ndarray):
        self.planes, self.zeros, self.ranks, self.n = planes, zeros, ranks, n
        self.doc_ids, self.ends = doc_ids, ends
        self._wide: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray) -> "WaveletShard":
        n = len(ids)
        levels = max(1, int(ids.max()).bit_length()) if n else 1
        seq = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for level in range(levels - 1, -1, -1):
            ones = (seq & seq.dtype.type(1 << level)) != 0
            plane = np.packbits(ones)
            low = np.compress(~ones, seq)
            seq = np.concatenate([low, np.compress(ones, seq)])
            planes.append(plane)
            zeros.append(len(low))
            ranks.append(cls._directory(plane))
        return cls(planes, zeros, ranks, n, doc_ids, np.asarray(ends, np.int64))

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        """Ones before each block of ``BLOCK`` bits."""
        step = BLOCK // 8
        padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
        padded[:len(plane)] = plane
        per = np.bitwise_count(padded).reshape(-1, step).sum(axis=1, dtype=np.uint32)
        return np.concatenate([[0], np.cumsum(per)]).astype("<u4")

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1).compress
        known = [0 if d is None else d for d in self.doc_ids]
        out = [MAGIC, struct.pack("<IQQ", len(self.planes), self.n, len(known)), np.array(known, "<i8").tobytes(),
               bytes(d is None for d in self.doc_ids), self.ends.astype("<u8").tobytes()]
        for plane, zero, rank in zip(self.planes, self.zeros, self.ranks):
            packed = pack(plane.tobytes())
            out += [struct.pack("<QQ", zero, len(packed)), packed, rank.tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, image: bytes) -> "WaveletShard":
        if image[:4] != MAGIC:
            raise ValueError("not a wavelet-matrix image")
        levels, n, docs = struct.unpack_from("<IQQ", image, 4)
        at = 24
        known = np.frombuffer(image, "<i8", docs, at).tolist()
        null = image[at + 8 * docs:at + 9 * docs]
        ends = np.frombuffer(image, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        planes, zeros, ranks = [], [], []
        blocks = -(-(-(-n // 8)) // (BLOCK // 8)) + 1
        unpack = zstandard.ZstdDecompressor().decompress
        for _ in range(levels):
            zero, size = struct.unpack_from("<QQ", image, at)
            planes.append(np.frombuffer(unpack(image[at + 16:at + 16 + size]), np.uint8) if n else np.zeros(0, np.uint8))
            zeros.append(zero)
            ranks.append(np.frombuffer(image, "<u4", blocks, at + 16 + size))
            at += 16 + size + 4 * blocks
        return cls(planes, zeros, ranks, n, [None if x else d for d, x in zip(known, null)], ends)

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        block = at // BLOCK
        first, last = block * BLOCK // 8, at // 8
        count = int(self.ranks[level][block]) + int(np.bitwise_count(self.planes[level][first:last]).sum())
        return count + (int(self.planes[level][last] >> (8 - at % 8)).bit_count() if at % 8 else 0)

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at // 8]) >> (7 - at % 8) & 1

    def access(self, at: int) -> int:
        """The id at a position."""
        out = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, at)
            out = out << 1 | bit
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if bit else at - ones
        return out

    def _range(self, symbol: int, at: int) -> tuple[int, int]:
        """(start, end) on the lowest level of the symbol's copies before ``at``."""
        lo, hi, levels = 0, at, len(self.planes)
        if symbol >> levels:
            return 0, 0
        for level in range(levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if symbol >> (levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, at: int) -> int:
        """Copies of an id before position ``at``."""
        lo, hi = self._range(symbol, at)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _find(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) zero or one of a plane: select."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK, self.n) - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8:(block + 1) * BLOCK // 8])[:self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - before[block]])

    def select(self, symbol: int, k: int) -> int:
        """Position of the ``k``-th copy (from 0) of an id."""
        lo, hi = self._range(symbol, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at, levels = lo + k, len(self.planes)
        for level in range(levels - 1, -1, -1):
            bit = symbol >> (levels - 1 - level) & 1
            at = self._find(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, symbol: int) -> list[tuple[int | None, int]]:
        """(doc_id, place in the document) of every copy of an id."""
        at = np.array([self.select(symbol, k) for k in range(self.count(symbol))], np.int64)
        doc = np.searchsorted(self.ends, at, side="right")
        starts = np.concatenate([[0], self.ends])
        return [(self.doc_ids[d], int(a - starts[d])) for d, a in zip(doc, at)]

    def _words(self, level: int) -> np.ndarray:
        """A plane as 64-bit words, filled up to whole blocks and beyond its last bit."""
        if level not in self._wide:
            padded = np.zeros((self.n // BLOCK + 1) * BLOCK // 8, np.uint8)
            padded[:len(self.planes[level])] = self.planes[level]
            self._wide[level] = padded.view(">u8").astype(np.uint64)
        return self._wide[level]

    def _ones_many(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position: the directory, then the words of the block."""
        words, block, word = self._words(level), at // BLOCK, at // 64
        count = self.ranks[level][block].astype(np.int64)
        for j in range(BLOCK // 64 - 1):
            w = block * (BLOCK // 64) + j
            count += np.where(w < word, np.bitwise_count(words[w]), 0)
        return count + np.bitwise_count(_top(words[word], at % 64))

    def access_many(self, at: np.ndarray) -> np.ndarray:
        """The ids at many positions."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level in range(len(self.planes)):
            bit = (self._words(level)[at // 64] >> (63 - at % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            ones = self._ones_many(level, at)
            out = out << 1 | bit
            at = np.where(bit > 0, self.zeros[level] + ones, at - ones)
        return out

    def _starts_many(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` goes on the lowest level when it is led along each symbol's bits."""
        levels = len(self.planes)
        for level in range(levels):
            ones = self._ones_many(level, at)
            at = np.where(symbols >> (levels - 1 - level) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rank_many(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Copies of each id before each position."""
        symbols, at = np.asarray(symbols, np.int64), np.asarray(at, np.int64)
        count = self._starts_many(symbols, at) - self._starts_many(symbols, np.zeros_like(at))
        return np.where(symbols >> len(self.planes) > 0, 0, count)

    def select_many(self, symbols: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Position of the ``k``-th copy (from 0) of each id; the copies must exist."""
        symbols, levels, per = np.asarray(symbols, np.int64), len(self.planes), BLOCK // 64
        at = self._starts_many(symbols, np.zeros_like(symbols)) + k
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> (levels - 1 - level) & 1).astype(bool)
            ones = self.ranks[level].astype(np.int64)
            zeros = np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
            left = np.where(bit, at - self.zeros[level], at)
            block = np.where(bit, np.searchsorted(ones, left, side="right"), np.searchsorted(zeros, left, side="right")) - 1
            left = left - np.where(bit, ones[block], zeros[block])
            word, words = block * per, self._words(level)
            for _ in range(per - 1):
                here = np.bitwise_count(np.where(bit, words[word], ~words[word])).astype(np.int64)
                later = left >= here
                if not later.any():
                    break
                left, word = left - np.where(later, here, 0), word + later
            value, place = np.where(bit, words[word], ~words[word]), np.zeros_like(at)
            for step in (32, 16, 8, 4, 2, 1):
                place += np.where(np.bitwise_count(_top(value, place + step)) <= left, step, 0)
            at = word * 64 + place
        return at

    def decode(self) -> np.ndarray:
        """All ids: the planes are undone from the lowest level up."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for low, level in enumerate(range(len(self.planes) - 1, -1, -1)):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            above = np.empty_like(out)
            above[np.flatnonzero(~ones)] = out[:self.zeros[level]]
            above[np.flatnonzero(ones)] = out[self.zeros[level]:] | out.dtype.type(1 << low)
            out = above
        return out


def write_shards(docs: DataFrame, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the corpus; returns the written table (part, shard, n_docs, n_tokens, image)."""
    path = tokenizer or default_path()
    small_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    schema = "part int, shard int, n_docs long, n_tokens long, image binary"

    def run(batches):
        enc, end = encoder(path, CACHE_PIECES), np.array([END_ID], "<u4").tobytes()
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids, parts, size = [], [], 0

        def image():
            ids = np.frombuffer(b"".join(parts), "<u4")
            built = WaveletShard.build(ids, doc_ids, np.cumsum([len(p) // 4 for p in parts]))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                                               pa.array([len(ids)], pa.int64()), pa.array([built.to_bytes()], pa.binary())],
                                              ["part", "shard", "n_docs", "n_tokens", "image"])

        def encoded():
            docs, texts, chars = [], [], 0
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    docs.append(doc)
                    texts.append(text)
                    chars += len(text or "") + 1
                    if chars >= CHUNK_CHARS:
                        yield from zip(docs, enc.ids_many(texts))
                        docs, texts, chars = [], [], 0
            yield from zip(docs, enc.ids_many(texts))

        for doc, ids in encoded():
            doc_ids.append(doc)
            parts.append(ids + end)
            size += len(parts[-1]) // 4
            if size >= shard_tokens:
                yield image()
                shard, doc_ids, parts, size = shard + 1, [], [], 0
        if doc_ids:
            yield image()
        enc.rest(CACHE_PIECES)

    return settle(ordered.mapInArrow(run, schema), "wavelet")


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, first_id, first_id_count, first_id_last) of every document, from the images.

    The ids' checksum needs all of them, so it is taken from the undone planes.  The document's
    first id, its copies in the document and the place of the last one are looked up by access, rank and select.
    """
    small_batches(shards.sparkSession)
    schema = "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long, first_id long, first_id_count long, first_id_last long"

    def run(batches):
        for b in batches:
            for part, shard, data in zip(*(b.column(i) for i in range(3))):
                w = WaveletShard.from_bytes(data.as_py())
                ids, starts = w.decode().astype("<u4"), np.concatenate([[0], w.ends])
                crc = [zlib.crc32(ids[a:e]) for a, e in zip(starts, w.ends)]
                n = len(crc)
                begin, end = starts[:-1].astype(np.int64), w.ends
                first = w.access_many(begin)
                before, upto = w.rank_many(first, begin), w.rank_many(first, end)
                last = w.select_many(first, upto - 1) - begin
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([shard.as_py()] * n, pa.int32()), pa.array(w.doc_ids, pa.int64()),
                     pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64()), pa.array(first), pa.array(upto - before), pa.array(last)],
                    ["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32", "first_id", "first_id_count", "first_id_last"])

    rows = shards.select("part", "shard", "image").mapInArrow(run, schema)
    sizes = shards.select("part", "shard", "n_tokens")
    # one row per range partition is small enough for a single running sum
    per_part = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before_part = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    before = sizes.select("part", "shard", inside.alias("inside")).join(before_part, "part").select(
        "part", "shard", (F.col("inside") + F.col("before_part")).alias("before"))
    return rows.join(before, ["part", "shard"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                                                     "first_id", "first_id_count", "first_id_last")
