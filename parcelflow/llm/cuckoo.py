"""Exact dedup through an index of live digests: one cuckoo filter per bucket of the digest space.

A row of the index is either a stored key (digest, smallest id, number of rows) or the filter of a
bucket. A change meets the filter first. A miss is certain and is inserted without looking at the
stored keys; a hit is verified against the keys of the bucket, so that a false positive costs a
look-up and never a document. When an insertion finds no slot, the filter is rebuilt at twice the
size from the stored keys. Deleting a digest takes its fingerprint out of the filter and the key out
of the bucket.

Equal texts of one task are combined before the shuffle, so a group that holds a third of all rows
sends one row per task. A bucket is chosen by the leading bits of SHA-256 and holds about
``KEYS_PER_BUCKET`` keys at any input size.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.common import stored, text_or_empty

KEYS_PER_BUCKET = 8192
SLOTS = 4
KICKS = 200
#: Rows that a task gathers before it combines them.
GATHER = 200_000

ADD, DELETE, KEY, FILTER = "add", "delete", "key", "filter"
INDEX_SCHEMA = "bucket int, kind string, digest binary, keep_id bigint, n bigint, filter binary"


class CuckooFilter:
    """Two candidate buckets of four 16-bit fingerprints for each 64-bit hash."""

    def __init__(self, buckets: int = 64, slots: array | None = None):
        self.mask = buckets - 1
        self.slots = slots if slots is not None else array("H", bytes(2 * SLOTS * buckets))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        slots = array("H")
        slots.frombytes(data)
        return cls(len(slots) // SLOTS, slots)

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, h: int) -> tuple[int, int, int]:
        mark = (h >> 48) or 1
        first = h & self.mask
        return mark, first, first ^ (mark * 0x5BD1E995 & self.mask)

    def _find(self, mark: int, bucket: int) -> int:
        """The slot of the bucket that holds the mark, or -1."""
        at = SLOTS * bucket
        for i in range(at, at + SLOTS):
            if self.slots[i] == mark:
                return i
        return -1

    def contains(self, h: int) -> bool:
        mark, one, two = self._places(h)
        return self._find(mark, one) >= 0 or self._find(mark, two) >= 0

    def insert(self, h: int) -> bool:
        """False if no slot was found; the filter must then be rebuilt."""
        mark, bucket, other = self._places(h)
        for b in (bucket, other):
            if (i := self._find(0, b)) >= 0:
                self.slots[i] = mark
                return True
        for kick in range(KICKS):
            i = SLOTS * other + kick % SLOTS
            mark, self.slots[i] = self.slots[i], mark
            other ^= mark * 0x5BD1E995 & self.mask
            if (i := self._find(0, other)) >= 0:
                self.slots[i] = mark
                return True
        return False

    def delete(self, h: int) -> bool:
        mark, one, two = self._places(h)
        for b in (one, two):
            if (i := self._find(mark, b)) >= 0:
                self.slots[i] = 0
                return True
        return False


class Bucket:
    """Stored keys of one bucket behind their filter."""

    def __init__(self, size: int = 64):
        self.filter, self.keys = CuckooFilter(size), {}

    @staticmethod
    def _hash(digest: bytes) -> int:
        return int.from_bytes(digest[-8:], "little")

    def live(self, digest: bytes) -> bool:
        return self.filter.contains(self._hash(digest)) and digest in self.keys

    def add(self, digest: bytes, keep_id: int | None, n: int) -> None:
        if self.live(digest):
            old, count = self.keys[digest]
            least = min((x for x in (old, keep_id) if x is not None), default=None)
            self.keys[digest] = (least, count + n)
            return
        self.keys[digest] = (keep_id, n)
        if not self.filter.insert(self._hash(digest)):
            self.rebuild()

    def rebuild(self) -> None:
        size = self.filter.mask + 1
        while True:
            size *= 2
            self.filter = CuckooFilter(size)
            if all(self.filter.insert(self._hash(d)) for d in self.keys):
                return

    def delete(self, digest: bytes) -> None:
        if self.live(digest):
            self.filter.delete(self._hash(digest))
            del self.keys[digest]


def _change(table: pa.Table) -> pa.Table:
    """One bucket after its changes: first what is stored, then deletions, then additions."""
    bucket = Bucket()
    rows = list(zip(*(table[c].to_pylist() for c in ("kind", "digest", "keep_id", "n", "filter")), strict=True))
    for kind, digest, keep_id, n, data in rows:
        if kind == KEY:
            bucket.keys[digest] = (keep_id, n)
        elif kind == FILTER:
            bucket.filter = CuckooFilter.load(data)
    for kind, digest, *_ in rows:
        if kind == DELETE:
            bucket.delete(digest)
    for kind, digest, keep_id, n, _ in rows:
        if kind == ADD:
            bucket.add(digest, keep_id, n)
    out = [(KEY, d, k, n, None) for d, (k, n) in bucket.keys.items()] + [(FILTER, None, None, None, bucket.filter.dump())]
    kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
    at = pa.array([table["bucket"][0].as_py()] * len(out), pa.int32())
    return pa.table([at, *columns], ["bucket", "kind", "digest", "keep_id", "n", "filter"])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and task, or more where a task meets very many digests."""
    held, rows = [], 0

    def folded() -> pa.Table:
        both = pa.concat_tables(held).group_by("digest").aggregate([("keep_id", "min"), ("n", "sum")])
        return both.rename_columns(["digest", "keep_id", "n"])

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows > GATHER:
            held = [folded()]
            rows = held[0].num_rows
            if rows > GATHER // 2:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from folded().to_batches()


def _bucket(digest: Column, buckets: int) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint") .bitwiseAND(buckets - 1).cast("int")


def buckets_for(rows: int) -> int:
    """A power of two that leaves about ``KEYS_PER_BUCKET`` keys to each bucket."""
    return 1 << max(0, (max(rows, 1) - 1) // KEYS_PER_BUCKET).bit_length()


def combined(digests: DataFrame) -> DataFrame:
    """(digest, keep_id) rows as additions, equal digests of a task in one row."""
    rows = digests.select("digest", "keep_id", F.lit(1).cast("bigint").alias("n"))
    return rows.mapInArrow(_combine, "digest binary, keep_id bigint, n bigint")


def change(index: DataFrame | None, buckets: int, add: DataFrame | None = None, delete: DataFrame | None = None) -> DataFrame:
    """The index after deletions and then additions; ``None`` starts a new one.

    ``add`` has (digest, keep_id, n), ``delete`` has (digest). Deleting a digest that is not live
    does nothing; adding a live one lowers its keep_id and adds to its count. A null digest is left
    out. All calls on one index must use the same number of buckets.
    """
    none = {c: F.lit(None).cast(t) for c, t in (("keep_id", "bigint"), ("n", "bigint"), ("filter", "binary"))}
    parts = [] if index is None else [index]
    for kind, rows in ((ADD, add), (DELETE, delete)):
        if rows is not None:
            rows = rows.filter("digest is not null").withColumns({c: v for c, v in none.items() if c not in rows.columns})
            parts.append(rows.select(_bucket(F.col("digest"), buckets).alias("bucket"), F.lit(kind).alias("kind"), "digest", "keep_id", "n", "filter"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("bucket").applyInArrow(_change, INDEX_SCHEMA)


def keys(index: DataFrame) -> DataFrame:
    """The live digests: (digest, keep_id, n)."""
    return index.filter(F.col("kind") == KEY).select("digest", "keep_id", "n")


def normalised(text: str) -> Column:
    """The text with each run of white space as one space; null counts as empty.

    Single spaces are what they become, so only other runs are matched.
    """
    return F.regexp_replace(text_or_empty(text), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digest(text: str) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when they agree after ``normalised``; null, empty and no-word texts follow that
    rule. The smallest id of a group stays. Rows that repeat an id with an equal text count in
    group_size and are kept together; a null id stays only where its group has no other. Other
    columns are not read. An empty table gives an empty result.
    """
    rows = stored(docs.select(F.col(id_col).cast("bigint").alias("keep_id"), digest(text_col).alias("digest")))
    index = change(None, buckets_for(rows.count()), add=combined(rows))
    groups = keys(index).select("digest", F.col("keep_id").alias("_keep"), F.col("n").alias("group_size"))
    return rows.join(groups, "digest").select(
        F.col("keep_id").alias(id_col), F.col("_keep").alias("keep_id"), "group_size",
        F.col("keep_id").eqNullSafe(F.col("_keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows that repeat an id and a text, one."""
    def key(text_digest: Column, own_id: Column) -> Column:
        return F.concat(text_digest, F.coalesce(own_id.cast("string"), F.lit("")).cast("binary"))  # a digest has 32 bytes

    found = exact_dedup(docs, id_col, text_col).filter("kept").select(key(F.unhex("text_sha256"), F.col("keep_id")).alias("key")).distinct()
    # One key for the join and the repeats, so texts are shuffled once; the row is one column, so no name clashes.
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key(digest(text_col), F.col(id_col).cast("bigint")).alias("key"))
    return marked.join(found, "key").dropDuplicates(["key"]).select("row.*")
