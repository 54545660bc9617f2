"""Centroid clustering of whole-number vectors by bit planes and popcounts.

A component x becomes the whole number floor(scale * x) in two's complement of as many bits as the table needs. Bit plane b of
a vector is one 64-bit word whose bit i is bit b of component i, so a vector of 64 components is a handful of words. With plane
weights w (2**b, the top one negative) the dot product with a centroid is the sum over pairs of planes of
w_b * w_c * popcount(plane_b & plane_c), which is exact, and so is |x|^2 - 2 x.c + |c|^2.

Vectors are packed once and stored. A round sends the centroids, which are ``k`` rows, to the tasks; each task returns one row
per centroid with the number of its vectors and their sums by component, taken from counts of set bits. Nothing of a
vector's size times the table's ever leaves a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from parcelflow.llm.common import released, stored

DIM = 64
K = 16
ROUNDS = 3
SCALE = 64
SEED = 1
#: Whole numbers lie in -2**LIMIT_BITS to 2**LIMIT_BITS - 1: 64 squares of their differences fit a long.
LIMIT_BITS = 27
#: Vectors that are compared with all centroids at a time.
SLICE = 8192


def plane_weights(bits: int) -> np.ndarray:
    """What a set bit of each plane is worth in two's complement."""
    w = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def pack(numbers: np.ndarray, bits: int) -> np.ndarray:
    """(rows, 64) whole numbers as (rows, bits) words; bit i of word b is bit b of component i."""
    planes = (numbers.astype(np.int64)[:, None, :] >> np.arange(bits)[:, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0].astype(np.uint64)


def set_bits(planes: np.ndarray) -> np.ndarray:
    """(bits, 64): in how many rows each bit of each plane is set."""
    flat = np.ascontiguousarray(planes.astype("<u8")).view(np.uint8)
    return np.unpackbits(flat, axis=1, bitorder="little").reshape(len(planes), -1, DIM).sum(axis=0, dtype=np.int64)


def dots(planes: np.ndarray, centroid: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact dot products of packed rows with one packed centroid."""
    total = np.zeros(len(planes), np.int64)
    for b, w in enumerate(weights):
        for c, v in enumerate(weights):
            if centroid[c]:
                total += w * v * np.bitwise_count(planes[:, b] & centroid[c]).astype(np.int64)
    return total


class Centroids:
    """Packed centroids with their squared lengths."""

    def __init__(self, numbers: np.ndarray, bits: int):
        self.numbers, self.weights = numbers, plane_weights(bits)
        self.planes, self.squares = pack(numbers, bits), (numbers * numbers).sum(axis=1)

    def nearest(self, planes: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the nearest centroid, the smaller number among equals, and the squared distance."""
        best, distance = np.zeros(len(planes), np.int32), np.full(len(planes), np.iinfo(np.int64).max)
        for k, (plane, square) in enumerate(zip(self.planes, self.squares, strict=True)):
            d = squares - 2 * dots(planes, plane, self.weights) + square
            closer = d < distance
            best[closer], distance[closer] = k, d[closer]
        return best, distance


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("numbers").flatten().to_numpy().reshape(-1, DIM)


def _packing(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                numbers = _numbers(batch)
                planes = pack(numbers, bits).astype("<u8")
                blob = pa.array([p.tobytes() for p in planes], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), blob, pa.array((numbers * numbers).sum(axis=1))], ["id", "planes", "square"])

    return released(run)


def _planes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(b"".join(batch.column("planes").to_pylist()), "<u8").reshape(batch.num_rows, -1)
    return planes.astype(np.uint64), batch.column("square").to_numpy()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _summing(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, sums = np.zeros(len(centroids.numbers), np.int64), np.zeros(centroids.numbers.shape, np.int64)
        for batch in _slices(batches):
            planes, squares = _planes(batch)
            cluster, _ = centroids.nearest(planes, squares)
            for k in np.unique(cluster):
                own = planes[cluster == k]
                size[k] += len(own)
                sums[k] += centroids.weights @ set_bits(own)
        some = np.flatnonzero(size)
        if len(some):
            sums_ = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * DIM), pa.array(sums[some].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(size[some]), sums_], ["cluster", "n", "sums"])

    return released(run)


def _assigning(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            cluster, distance = centroids.nearest(*_planes(batch))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster), pa.array(distance)], ["id", "cluster", "distance"])

    return released(run)


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, numbers): the vectors that can be clustered, as whole numbers."""
    v = F.col(vector_col).cast("array<double>")
    floors = F.transform(v, lambda x: F.floor(x * scale))
    limit = 1 << LIMIT_BITS
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (x * scale < -limit) | (x * scale >= limit))
    fit = F.coalesce((F.size(v) == DIM) & ~odd, F.lit(False))
    return vectors.select(F.col(id_col).cast("bigint").alias("id"), F.when(fit, floors).alias("numbers")).filter("numbers IS NOT NULL")


def start_order(seed: int = SEED) -> list[Column]:
    """The order in which vectors are taken as first centroids: by hash of the id, rows without an id last."""
    return [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), F.col("numbers").asc()]


def moved(centroids: np.ndarray, found: list[Row]) -> np.ndarray:
    """Centroids after a round, from the numbers and sums of their vectors; those without vectors stay."""
    out = centroids.copy()
    for row in found:
        out[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
    return out


def _as_long(n: int) -> int | None:
    """Null where a long cannot hold a sum."""
    return n if n < 1 << 63 else None


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that can be clustered.

    Taken are vectors of exactly 64 components, none null or not finite. floor(scale * x) must lie in -2**27 to
    2**27 - 1, or squared distances would not fit a long; vectors beyond it have no row. With fewer than ``k`` vectors each is
    a centroid at first. Rows that repeat an id count as rows; those that tie as first centroids come by their
    numbers. A row without an id is clustered, and is a first centroid only where others do not suffice. Equal distances
    go to the smaller cluster. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    whole = stored(whole_numbers(vectors, id_col, vector_col, scale))
    low, high = whole.agg(F.min(F.array_min("numbers")), F.max(F.array_max("numbers"))).first()
    bits = 1 + max(1, int(max(high or 0, -1 - (low or 0))).bit_length())
    packed = stored(whole.mapInArrow(_packing(bits), "id bigint, planes binary, square bigint"))
    first = whole.orderBy(*start_order(seed)).limit(k).collect()  # k rows of 64 numbers
    centroids = np.array([r["numbers"] for r in first], np.int64).reshape(-1, DIM)
    for _ in range(rounds if len(centroids) else 0):
        sums = packed.mapInArrow(_summing(Centroids(centroids, bits)), "cluster int, n bigint, sums array<bigint>")
        by_component = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(DIM)]
        centroids = moved(centroids, sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*by_component).alias("sums")).collect())  # k rows
    assigned = stored(packed.mapInArrow(_assigning(Centroids(centroids, bits)), "id bigint, cluster int, distance bigint"))
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # k rows
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    every = sum(int(r["d"]) for r in totals)
    rows = [(r["cluster"], _as_long(int(r["d"])), _as_long(every), sha[r["cluster"]]) for r in totals]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(  # k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
