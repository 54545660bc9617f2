"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most three bits meet at a variant: one flips at most two bits,
the other at most one. Every distinct fingerprint emits such variants, the variants are shuffled,
and fingerprints that meet are linked. Two facts keep the balls small and lose no pair:

* Parity. Flips of one bit change the parity of the number of set bits. Pairs at distance 2 have the
  same parity and meet one flip from either. Pairs at distance 1 or 3 differ in parity: the even one
  flips none or two bits, the odd one flips one. So only even fingerprints flip two bits.
* Of three bits, two lie in the same half of the word, so only pairs of flips within a half are needed.

An odd fingerprint emits 64 variants, an even one 1 + 64 + 992. At an even variant every odd
fingerprint is within three bits of all others there, and at an odd variant all are within two, so a
star links them all: links grow with the number of variants, never with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import re
from pyspark.sql import Column, DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest

from parcelflow.llm.common import released, stored
from parcelflow.llm.components import components, forest

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Variants that one group of the meeting holds on average.
VARIANTS_PER_GROUP = 1_500_000
#: Fingerprints whose variants a task makes at a time.
SLICE = 2048
#: Bytes of a text that are parted into words at a time.
SEGMENT = 1 << 22

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ONE = np.array([1 << i for i in range(64)], np.uint64)
_TWO = np.array([1 << i | 1 << j for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)], np.uint64)
#: Flips by their code: none, one bit, two bits of a half.
MASKS = np.concatenate([np.zeros(1, np.uint64), _ONE, _TWO])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shingles(data: bytes) -> Iterator[bytes]:
    """Word shingles of a lower-cased text; segments overlap by two words."""
    carry: list[bytes] = []
    start, none = 0, True
    while start < len(data):
        end = start + SEGMENT
        if end < len(data):
            cut = _BLANK.search(data, end)
            end = cut.start() if cut else len(data)
        words = carry + data[start:end].lower().split()
        if len(words) >= SHINGLE:
            none = False
            yield from map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
        carry, start = words[1 - SHINGLE :], end
    if none and carry:
        yield b" ".join(carry)


def fingerprint(data: bytes | None) -> int:
    """The 64-bit fingerprint of a UTF-8 text; null, empty and blank texts give zero.

    Only A-Z are lower-cased. A text with fewer words than a shingle is one shingle.
    """
    ones, n, each = np.zeros(64, np.int64), 0, _shingles(data or b"")
    while len(h := np.fromiter(map(xxh64_intdigest, islice(each, 65536), repeat(SEED)), "<u8")):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "mark"])


def _own_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.fromiter((fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(marks.view(np.int64))], ["row", "own"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark) of each row; mark is the fingerprint as a signed whole number."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(released(_fingerprints), "doc_id bigint, mark bigint")


def _variants(bits: int):
    """Rows (part, variants): the variants of a slice that meet in one part, as values and flip codes."""
    even, odd = np.arange(len(MASKS), dtype=np.uint16), np.arange(1, 65, dtype=np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("mark").to_numpy().view(np.uint64)
            for marks in (every[i : i + SLICE] for i in range(0, len(every), SLICE)):
                is_odd = np.bitwise_count(marks) & 1 == 1
                values, codes = [], []
                for some, kinds in ((marks[is_odd], odd), (marks[~is_odd], even)):
                    values.append((some[:, None] ^ MASKS[kinds]).ravel())
                    codes.append(np.tile(kinds, len(some)))
                v, c = np.concatenate(values), np.concatenate(codes)
                part = ((v * _MIX) >> np.uint64(64 - bits)).astype(np.uint32) if bits else np.zeros(len(v), np.uint32)
                order = np.argsort(part, kind="stable")
                v, c, part = v[order], c[order], part[order]
                starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(v) else []
                ends = [*starts[1:], len(v)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[starts].astype(np.int32), pa.int32()),
                    pa.array([v[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                    pa.array([c[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ], ["part", "v", "code"])

    return run


def _meet(group: pa.Table) -> pa.Table:
    """Links between the fingerprints that share a variant, as a spanning forest of the part."""
    v = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in group["v"]])
    code = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in group["code"]])
    order = np.argsort(v)
    v = v[order]
    same = v[1:] == v[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    v, code = v[shared], code[order[shared]]
    mark = v ^ MASKS[code]
    a = b = np.zeros(0, np.uint64)
    if len(v):
        first = np.concatenate([[True], v[1:] != v[:-1]])
        starts, run = np.flatnonzero(first), np.cumsum(first) - 1
        centre = (np.bitwise_count(v) & 1 == 1) | (np.bitwise_count(mark) & 1 == 1)
        at = np.minimum.reduceat(np.where(centre, np.arange(len(v)), len(v)), starts)[run]
        linked = at < len(v)
        a, b = mark[at[linked]], mark[linked]
        near = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
        a, b = forest(a[near].view(np.int64), b[near].view(np.int64)) if near.any() else (a[:0], b[:0])
    return pa.table({"u": pa.array(a.view(np.int64)), "v": pa.array(b.view(np.int64))})


def links(marks: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column mark) that connect all within ``RADIUS`` bits."""
    n = marks.count()
    bits = (n * (2 * 64 + 1 + len(_TWO)) // 2 // VARIANTS_PER_GROUP).bit_length()
    dealt = marks.select("mark").repartition(max(1, n // SLICE), "mark")  # few bytes that make many
    return dealt.mapInArrow(released(_variants(bits)), "part int, v binary, code binary").groupBy("part").applyInArrow(
        _meet, "u bigint, v bigint"
    )


def hex_mark(mark: Column) -> Column:
    return F.lower(F.lpad(F.hex(mark), 16, "0"))


def classes_of(rows: DataFrame) -> DataFrame:
    """(mark, root, component_id) of each distinct fingerprint in ``rows`` (doc_id, mark)."""
    marks = stored(rows.groupBy("mark").agg(F.min("doc_id").alias("least")))
    roots = components(links(marks))
    placed = marks.join(roots, marks["mark"] == roots["node"], "left").select(
        "mark", "least", F.coalesce("root", "mark").alias("root")
    )
    lowest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(lowest, "root").select("mark", "root", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest id that is reachable over links of at most ``RADIUS`` bits, the row
    itself included. Null, empty and blank texts have fingerprint zero and are linked like any
    other. Equal fingerprints are one node, however many rows share them. A null id gets the
    smallest id of its component, or null where there is none. Other columns are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col))
    return rows.join(classes_of(rows), "mark").select(
        F.col("doc_id").alias(id_col), hex_mark(F.col("mark")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each component, the one with the smallest id, with its columns.

    Of rows of a component that repeat its smallest id, one stays. A component in which no row has an id keeps one
    of its rows. Only for these, and for smallest ids that rows with different texts repeat, are texts read again.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = stored(fingerprints(docs, id_col, text_col))
    classes = stored(classes_of(rows))
    placed = rows.join(classes, "mark")
    heads = stored(
        placed.filter("doc_id is not null").groupBy("doc_id")
        .agg(F.min("mark").alias("mark"), F.max("mark").alias("most"), F.max(F.expr("doc_id = component_id")).alias("head")).filter("head")
    )
    own_id = F.col(id_col).cast("bigint")
    single = heads.filter("mark = most").select(F.col("doc_id").alias("head"))
    whole = docs.select(F.struct(*columns).alias("row"), own_id.alias("head"), F.col(text_col).cast("binary").alias("text"))
    named = whole.select("row", "head").join(single, "head").dropDuplicates(["head"]).select("row.*")
    # The id alone does not tell these rows' component, so their texts do.
    many = heads.filter("mark <> most").select(F.col("doc_id").alias("head"))
    wanted = classes.filter("component_id is null").select(F.lit(None).cast("bigint").alias("head"), "mark", "root").unionByName(
        placed.join(many, F.col("doc_id") == F.col("head")).filter("doc_id = component_id").select("head", "mark", "root").distinct()
    )
    loose = whole.filter("head IS NULL").select("row", "text").unionByName(whole.join(many, "head").select("row", "text"))
    kind = loose.schema["row"].dataType
    loose = loose.mapInArrow(released(_own_marks), T.StructType([T.StructField("row", kind), T.StructField("own", T.LongType())]))
    known = (F.col("own") == F.col("mark")) & F.col("row").getField(id_col).cast("bigint").eqNullSafe(F.col("head"))
    return named.unionByName(loose.join(wanted, known).dropDuplicates(["root"]).select("row.*"))
