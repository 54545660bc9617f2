"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of whole documents, one after another, in blocks of ``BLOCK``. A block stores its
minimum, and the differences to it packed at the width that holds ``SHARE`` of them; the high bits of the
others follow as exceptions with their places. An index of block starts lets a reader go to any id.

    file    = "PFOR1" | blocks | block starts (uint64 each) | document lengths (uint32 each) | footer
    block   = count (uint16) | width (uint8) | exceptions (uint16) | minimum (uint32) | packed low bits
              | places (uint16 each) | high bits (uint32 each)
    footer  = ids (uint64) | blocks (uint64) | documents (uint64) | place of the index (uint64) | "PFOR1"

All numbers are little-endian. Documents are dealt to tasks by ranges of ids and each task writes files of about
``FILE_IDS`` ids or at most ``FILE_DOCS`` documents. A document is written and read in runs of ids, so neither a task's memory nor a file
grows with the table or with a document's length.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from parcelflow.llm import bpe
from parcelflow.llm.common import released, stored
from parcelflow.llm.shared import Target, opened
from parcelflow.session import workdir

MAGIC = b"PFOR1"
BLOCK = 256
SHARE = 0.9
FILE_IDS = 64_000_000
FILE_DOCS = 100_000
#: Rows of digests that are given back at a time.
OUT_ROWS = 10_000
#: Ids that are held in memory before their blocks are written.
HELD_IDS = 1 << 18
END = 0
MAX_CHUNKS = 1_200_000

_HEAD = struct.Struct("<HBHI")
_FOOT = struct.Struct("<QQQQ5s")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of the values of each row, one after another."""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(*values.shape, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def unpack(rows: np.ndarray, n: int, width: int) -> np.ndarray:
    """``n`` values of each row of packed bytes."""
    bits = np.zeros((len(rows), n, 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(rows, axis=1, count=n * width, bitorder="little").reshape(len(rows), n, width)
    return np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view("<u4")


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of ids that are given as rows of equal length."""
    low = ids.min(axis=1)
    over = (ids - low[:, None]).astype(np.uint32)
    rank = int(SHARE * (ids.shape[1] - 1))
    widths = np.ceil(np.log2(np.partition(over, rank, axis=1)[:, rank] + 1.0)).astype(int)
    out: list[bytes] = [b""] * len(ids)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        packed = pack(over[rows], width)
        high = over[rows] >> np.uint32(width) if width < 32 else np.zeros_like(over[rows])
        for row, bits, rest in zip(rows, packed, high, strict=True):
            places = np.flatnonzero(rest)
            out[row] = b"".join([
                _HEAD.pack(ids.shape[1], width, len(places), low[row]), bits.tobytes(), places.astype("<u2").tobytes(),
                rest[places].astype("<u4").tobytes(),
            ])
    return out


def decode_blocks(data: bytes) -> np.ndarray:
    """The ids of some blocks that follow each other."""
    alike: dict[tuple[int, int], list[tuple]] = {}
    at = start = 0
    while at < len(data):
        n, width, odd, low = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        size = (n * width + 7) // 8
        alike.setdefault((n, width), []).append((start, low, odd, at, size))
        at += size + 6 * odd
        start += n
    ids, source = np.zeros(start, np.uint32), np.frombuffer(data, np.uint8)
    for (n, width), blocks in alike.items():
        over = unpack(np.stack([source[place : place + size] for *_, place, size in blocks]), n, width)
        for row, (first, low, odd, place, size) in zip(over, blocks, strict=True):
            if odd:
                places = np.frombuffer(data, "<u2", odd, place + size)
                row[places] |= np.frombuffer(data, "<u4", odd, place + size + 2 * odd) << np.uint32(width)
            ids[first : first + n] = row + np.uint32(low)
    return ids


class Writer:
    """One file; documents are added in their order."""

    def __init__(self, uri: str):
        self.target = Target(uri)
        self.target.write(MAGIC)
        self.starts: list[int] = []
        self.lengths: list[int] = []
        self.held: list[np.ndarray] = []
        self.waiting = self.ids = 0

    def add(self, ids: np.ndarray) -> None:
        """A whole document."""
        self.begin()
        self.extend(ids)

    def begin(self) -> None:
        """A new document, of no ids yet."""
        self.lengths.append(0)

    def extend(self, ids: np.ndarray) -> None:
        """More ids of the last document."""
        self.lengths[-1] += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= HELD_IDS:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) // BLOCK * BLOCK
        whole = end // BLOCK * BLOCK
        blocks = encode_blocks(ids[:whole].reshape(-1, BLOCK)) if whole else []
        for block in blocks + (encode_blocks(ids[whole:end][None, :]) if whole < end else []):
            self.starts.append(self.target.size)
            self.target.write(block)
        self.held, self.waiting = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(last=True)
        index = self.target.size
        self.target.write(np.array(self.starts, "<u8").tobytes() + np.array(self.lengths, "<u4").tobytes())
        self.target.write(_FOOT.pack(self.ids, len(self.starts), len(self.lengths), index, MAGIC))
        self.target.close()


class Reader:
    """One file; reads the index at once and blocks when they are asked for."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        foot = self.file.read_at(_FOOT.size, size - _FOOT.size)
        self.ids, blocks, documents, index, magic = _FOOT.unpack(foot)
        if magic != MAGIC:
            raise ValueError(f"{uri} is no file of token ids")
        data = self.file.read_at(size - _FOOT.size - index, index)
        self.starts = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(index)).astype(np.int64)
        self.lengths = np.frombuffer(data, "<u4", documents, 8 * blocks).astype(np.int64)

    def read(self, start: int, n: int) -> np.ndarray:
        """Ids from a place on, as many as there are up to ``n``; only their blocks are read."""
        n = min(n, self.ids - start)
        if n <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (start + n - 1) // BLOCK
        at = int(self.starts[first])
        data = self.file.read_at(int(self.starts[last + 1]) - at, at)
        return decode_blocks(data)[start - first * BLOCK :][:n]

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document, with one read for every run of documents of about ``HELD_IDS`` ids."""
        parts: list[np.ndarray] = []
        for _, ids, last in self.runs():
            parts.append(ids)
            if last:
                yield np.concatenate(parts)
                parts = []

    def runs(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document, some ids of it, whether they are its last), in order; one read for about ``HELD_IDS`` ids, whatever a document's length."""
        ends = np.cumsum(self.lengths)
        k = 0
        for at in range(0, max(self.ids, 1), HELD_IDS):
            ids, place = self.read(at, HELD_IDS), at
            while k < len(ends) and (place < at + len(ids) or self.lengths[k] == 0):
                stop = min(int(ends[k]), at + len(ids))
                yield k, ids[place - at : stop - at], stop == ends[k]
                place = stop
                k += int(stop == ends[k])

    def close(self) -> None:
        self.file.close()


#: A chunk that every byte-level pattern takes for one piece: Latin letters, with one space before them or none.
LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class Chunks(dict):
    """Chunk of text to its ids; the tokenizer's own pattern parts a text at every border of chunks.

    As in the library, names of added tokens in a text are these tokens, and what is between them is parted by itself. A chunk
    that is one piece goes to the library's BPE model as it is; where the tokenizer's steps before the model are not the plain byte-level
    ones, all chunks go through all steps.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Tokens that look at what stands beside them, or at a changed text, leave no place to part it.
        self.whole = any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added)
        names = sorted((re.escape(t.content) for t in added if t.content), key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(names)})") if names else None
        steps = self.tokenizer.pre_tokenizer
        kind = json.loads(steps.__getstate__()) if steps is not None else {}
        plain = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space") and self.tokenizer.normalizer is None
        self.model = self.tokenizer.model if plain else None
        self.letters = byte_letters()

    def _encoded(self, chunk: str) -> list[int]:
        if self.model is not None and LETTERS.fullmatch(chunk):
            return [t.id for t in self.model.tokenize(chunk.encode().decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def __missing__(self, chunk: str) -> bytes:
        ids = array("I", self._encoded(chunk)).tobytes()
        if len(chunk) <= bpe.LONGEST_KEPT:
            if len(self) >= MAX_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def ids_of(self, text: str) -> Iterator[bytes]:
        if self.whole:
            yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            return
        for k, piece in enumerate(self.added.split(text) if self.added else [text]):
            if k % 2:  # the name of an added token
                yield self[piece]
                continue
            for part in bpe.segments(piece):
                yield b"".join(map(self.__getitem__, bpe.CHUNK.findall(part)))


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    return Chunks(path)


def _write(folder: str, tokenizer: str, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, task, number, writer, ids_of_file = chunks(tokenizer), TaskContext.get().partitionId(), 0, None, []

        def closed() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_arrays([
                pa.array([task], pa.int64()), pa.array([number], pa.int64()), pa.array([name]), pa.array([writer.ids], pa.int64()),
                pa.array([ids_of_file], pa.list_(pa.int64())),
            ], ["task", "number", "file", "ids", "doc_ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if writer is None:
                    name = f"{folder}/{task:06d}-{number:06d}.pfor"
                    writer, ids_of_file = Writer(name), []
                writer.begin()
                for part in known.ids_of(text.as_py() or ""):
                    writer.extend(np.frombuffer(part, "<u4"))
                writer.extend(np.array([END], "<u4"))
                ids_of_file.append(doc_id.as_py())
                if writer.ids >= file_ids or len(ids_of_file) >= FILE_DOCS:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    return released(run, "chunks", chunks.cache_clear)


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents in ascending order of their ids; one row (task, number, file, start, ids, doc_ids) per file.

    ``start`` is the number of ids in all files before. The order of a null id is first; rows that
    repeat an id follow each other, ordered by their texts. A null text is empty and holds the end id alone.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ranged = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    files = stored(ranged.mapInArrow(_write(folder, tokenizer, file_ids), "task bigint, number bigint, file string, ids bigint, doc_ids array<bigint>"))
    tasks = files.groupBy("task").agg(F.sum("ids").alias("sum")).withColumn(
        "before", F.coalesce(F.sum("sum").over(Window.partitionBy().orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(tasks.select("task", "before"), "task").withColumn(
        "start", F.col("before") + F.coalesce(F.sum("ids").over(inside), F.lit(0))
    ).select("task", "number", "file", "start", "ids", "doc_ids")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            reader, start = Reader(row["file"]), row["start"]
            out, crc = [], 0
            for k, ids, last in reader.runs():
                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                if last:
                    n = int(reader.lengths[k])
                    out.append((row["doc_ids"][k], start, n, crc))
                    start, crc = start + n, 0
                if len(out) >= OUT_ROWS:
                    yield _digest_rows(out)
                    out = []
            reader.close()
            if out:
                yield _digest_rows(out)


def _digest_rows(out: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) per document, read back from the files of ``write``."""
    # A task per file: by the sizes of these rows, adaptive execution would give all files to one task.
    return files.repartition(max(1, files.count()), "file").select("file", "start", "doc_ids").mapInArrow(
        _read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    ).withColumnRenamed("doc_id", id_col)


def round_trip(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` to a new folder of the shared place and read its digests back. An empty table gives no row."""
    folder = workdir(docs.sparkSession, "tokens")
    return digests(write(docs, folder, tokenizer or default_tokenizer(), id_col, text_col), id_col)
