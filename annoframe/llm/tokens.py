"""Token-id files of directly addressable codes.

Ids are cut into chunks of eight bits. Level 0 holds the lowest chunk of every id and a bitmap that says which ids go
on; level 1 holds the next chunk of those, and so on. A rank directory per bitmap counts the set bits before each block
of 512, so the place of an id's next chunk is one directory entry and at most 64 bytes of bitmap away: any token is read
with one small range read per level and table, without decoding what lies around it.

A file holds documents in key order and a bounded number of ids; files follow each other in key order too (the table is range partitioned). Layout,
all numbers little-endian::

    8 bytes   b"DACTOK1\\n"
    4 x u64   documents, tokens, levels, bytes of the end of the header
    i64[n]    keys          u8[n]  1 where the key is null          u64[n+1]  first token of each document, and the end
    per level u64 ids in it; u8[ids] chunks; u8[ceil(ids / 8)] bitmap (lowest bit first); u64[ceil(ids / 512)] ranks

Files are written beside their name and renamed, so a lost task leaves no part file and a second one gives the same
bytes. They lie in the shared folder, through any file system pyarrow knows.

Defined cases: a null or empty text is the end id alone. A null key sorts first. Rows with equal keys follow each other
by a hash of their text. Other columns are not read. An empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annoframe.llm.common import partitions
from annoframe.session import scratch_dir

MAGIC = b"DACTOK1\n"
BLOCK = 512
END_ID = 1
TABLE_WORDS, TABLE_CHARS = 800_000, 24_000_000
GROUP_BYTES = 4_000_000
#: Ids after which a file is closed.
FILE_TOKENS = 1 << 24


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- the code --------------------------------------------------------------------------------------------------------


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap and rank directory of each level."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        chunks, rest = rest.astype(np.uint8), rest >> np.uint32(8)
        on = rest > 0
        counts = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.uint64) if len(on) else np.empty(0, np.uint64)
        ranks = np.cumsum(counts, dtype=np.uint64) - counts
        out.append((chunks, np.packbits(on, bitorder="little"), ranks))
        if not on.any():
            return out
        rest = rest[on]


def pack(keys: list[int | None], flat: np.ndarray, counts: np.ndarray) -> bytes:
    """A file of documents: their keys, all ids, and how many ids each document has."""
    starts = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    levels = levels_of(flat)
    parts = [
        np.array([k or 0 for k in keys], "<i8").tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(),
        starts.tobytes(),
    ]
    end = len(MAGIC) + 32 + sum(map(len, parts))
    head = np.array([len(keys), len(flat), len(levels), end], "<u8").tobytes()
    for chunks, bitmap, ranks in levels:
        parts += [np.array([len(chunks)], "<u8").tobytes(), chunks.tobytes(), bitmap.tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join([MAGIC, head, *parts])


class Reader:
    """Random access to one file; what is asked for is read, nothing else."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        if self._read(0, 8) != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        self.docs, self.tokens, depth, at = (int(x) for x in np.frombuffer(self._read(8, 32), "<u8"))
        self.levels = []
        for _ in range(depth):
            n = int(np.frombuffer(self._read(at, 8), "<u8")[0])
            chunks, bitmap = at + 8, at + 8 + n
            ranks = bitmap + -(-n // 8)
            self.levels.append((n, chunks, bitmap, ranks))
            at = ranks + -(-n // BLOCK) * 8

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _array(self, at: int, count: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._read(at, count * np.dtype(kind).itemsize), kind)

    def keys(self) -> list[int | None]:
        keys = self._array(40, self.docs, "<i8").tolist()
        null = self._array(40 + 8 * self.docs, self.docs, "u1").tolist()
        return [None if z else k for k, z in zip(keys, null)]

    def starts(self) -> np.ndarray:
        return self._array(40 + 9 * self.docs, self.docs + 1, "<u8").astype(np.int64)

    def _ones_before(self, level: int, i: int) -> int:
        n, _, bitmap, ranks = self.levels[level]
        block = i // BLOCK
        if block * BLOCK >= n:  # at the very end, on a block's edge
            return self.levels[level + 1][0] if level + 1 < len(self.levels) else 0
        bits = np.unpackbits(self._array(bitmap + block * BLOCK // 8, -(-(i - block * BLOCK) // 8), "u1"), bitorder="little")
        return int(self._array(ranks + block * 8, 1, "<u8")[0]) + int(bits[: i - block * BLOCK].sum())

    def token(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        return int(self.slice(i, i + 1)[0])

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """The ids from ``lo`` to before ``hi``."""
        out = np.zeros(max(0, hi - lo), "<u4")
        where = np.arange(len(out))
        for level, (n, chunks, bitmap, _) in enumerate(self.levels):
            if not len(where):
                break
            out[where] |= self._array(chunks + lo, hi - lo, "u1").astype("<u4") << np.uint32(8 * level)
            first = lo // 8
            bits = np.unpackbits(self._array(bitmap + first, -(-hi // 8) - first, "u1"), bitorder="little")
            on = bits[lo - first * 8 : hi - first * 8].astype(bool)
            if level + 1 < len(self.levels) and on.any():
                lo = self._ones_before(level, lo)
                hi = lo + int(on.sum())
            where = where[on]
        return out


# --- encoding --------------------------------------------------------------------------------------------------------


class Encoder:
    """The tokenizers library on the distinct pieces between blanks; its rules never join pieces over a blank.

    New pieces go to the library many at a time, with a NUL between them, whose own id marks where each ends.
    """

    TOGETHER = 2000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.table: dict[str, bytes] = {"": b""}
        self.chars = 0
        mark = self.ids("\0")
        self.mark = mark[0] if len(mark) == 1 else None

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _learn(self, names: list[str]) -> None:
        for at in range(0, len(names), self.TOGETHER):
            part = names[at : at + self.TOGETHER]
            flat = np.array(self.library.encode_batch_fast([" \0 ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(flat == self.mark) if self.mark is not None else []
            if len(ends) != len(part) - 1:  # the mark is not told apart here: one by one
                self.table.update((w, np.array(self.ids(w), "<u4").tobytes()) for w in part)
                continue
            raw, start = flat.tobytes(), 0
            for name, end in zip(part, [*(ends * 4).tolist(), len(raw)]):
                self.table[name] = raw[start:end]
                start = end + 4

    def _spelled(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.table]
        if len(self.table) + len(new) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self.table, self.chars, new = {"": b""}, 0, words
        if new:
            self._learn([w for w in new if "\0" not in w])
            self.table.update((w, np.array(self.ids(w), "<u4").tobytes()) for w in new if "\0" in w)
            self.chars += sum(map(len, new))
        return list(map(self.table.__getitem__, words))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text closed by ``end_id``, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)  # the rules do so too, but for added tokens; fewer pieces to learn
        lists = pc.ascii_split_whitespace(texts)
        pieces = lists.flatten().dictionary_encode()
        spelled = self._spelled(pieces.dictionary.to_pylist())
        at = pieces.indices.to_numpy()
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        pool, first = np.frombuffer(b"".join(spelled), "<u4"), np.cumsum(sizes) - sizes
        n, words = sizes[at], pc.list_value_length(lists).to_numpy()
        doc = np.repeat(np.arange(len(words)), words)
        counts = np.bincount(doc, weights=n, minlength=len(words)).astype(np.int64) + 1
        before, run = np.cumsum(n) - n, np.arange(n.sum())
        out = np.empty(len(run) + len(words), "<u4")
        out[np.repeat(doc, n) + run] = pool[np.repeat(first[at] - before, n) + run]
        out[np.cumsum(counts) - 1] = end_id
        return out, counts


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# --- files -----------------------------------------------------------------------------------------------------------


def _put(uri: str, data: bytes) -> None:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(beside) as out:
        out.write(data)
    system.move(beside, path)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about GROUP_BYTES."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        base = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, base + GROUP_BYTES)))
        yield texts.slice(lo, hi - lo)
        lo = hi


def write(
    docs: DataFrame, home: str, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Write token files under ``home`` and return their list: ``shard``, ``part``, ``uri``, ``docs``, ``tokens`` in key order.

    A task closes a file once it has ``file_tokens`` ids, so that writer and reader hold that many and one group of texts.
    """
    path = path or default_path()
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        shard, part = TaskContext.get().partitionId(), 0

        def put() -> pa.RecordBatch:
            uri, n = f"{home}/tokens-{shard:06d}-{part:05d}.dac", np.concatenate(counts)
            _put(uri, pack(keys, np.concatenate(ids), n))
            row = {"shard": [shard], "part": [part], "uri": [uri], "docs": [len(keys)], "tokens": [int(n.sum())]}
            for held in (keys, ids, counts):
                held.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            at = 0
            for texts in _slices(batch.column("text")):
                flat, n = encoder(path).encode(texts, end_id)
                keys += batch.column("key").slice(at, len(texts)).to_pylist()
                at += len(texts)
                ids.append(flat.astype(np.uint16) if flat.max(initial=0) < 1 << 16 else flat)
                counts.append(n)
                if sum(map(len, ids)) >= file_tokens:
                    yield put()
                    part += 1
        if keys:
            yield put()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, "shard long, part long, uri string, docs long, tokens long").write.parquet(f"{home}/list")
    return spark.read.parquet(f"{home}/list")


def read(spark: SparkSession, home: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files under ``home``: key, ``start`` over all files, ``n_tokens`` and ``ids_crc32``."""
    files = spark.read.parquet(f"{home}/list")
    # One row per file; a running sum over so few rows is fine in one task.
    before = F.sum("tokens").over(Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("base", F.coalesce(before, F.lit(0))).select("uri", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist()):
                file = Reader(uri)
                starts = file.starts()
                raw = file.slice(0, file.tokens).tobytes()
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                columns = [pa.array(file.keys(), pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "start", "n_tokens", "ids_crc32"])

    rows = files.repartition(partitions(spark))
    return rows.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def new_home(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    home = new_home(docs.sparkSession)
    write(docs, home, key, text)
    return read(docs.sparkSession, home, key)
