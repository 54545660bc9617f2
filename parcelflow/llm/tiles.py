"""Embedding near-dedup by int8 tile products with error bounds.

Equal vectors of a label are one class, with a number of its own. The classes of a label are dealt into tiles, and each pair of
tiles is one group: a label that holds a third of all rows is spread over as many tasks as any other
work. A tile goes to as many tasks as its label has tiles, so tiles are large, and a product is worked off in strips of rows. A unit vector u is stored as q * scale with int8 q, so u = q * scale + e with a known length of
e. For two vectors, |u.v - qu.qv * scales| is at most |eu||v'| + |u'||ev| + |eu||ev| (u', v': the
quantised vectors). Products of int8 tiles are exact sums. A pair whose bound cannot reach the
threshold is dropped, one whose bound cannot fall below it is linked, and only the pairs between are
computed again from the full vectors in double precision.

A pair of tiles returns one row per class with its number of links and the smallest class it is
linked to, never one row per pair of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.common import stored
from parcelflow.llm.components import components

THRESHOLD = 0.93
#: Classes in a tile, on average.
TILE = 4096
#: Rows of a product at a time.
STRIP = 256
#: Allowance for the rounding of the bounds themselves.
SLACK = 1e-9
#: Pairs that are computed again at a time.
AGAIN = 65_536

TILE_SCHEMA = "label string, dim int, tile int, tiles int, ids binary, sizes binary, q binary, bounds binary, vectors binary"


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double; scaled first, so that large components do not overflow."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 codes, and per row: scale, length of the quantised vector, length of the error."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    near = q * scale[:, None]
    lengths = np.sqrt((near * near).sum(axis=1)), np.sqrt(((u - near) ** 2).sum(axis=1))
    return q, np.stack([scale, *lengths], axis=1)


def _pack(group: pa.Table) -> pa.Table:
    """One tile as one row."""
    dim = group["dim"][0].as_py()
    flat = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(-1, dim)  # as given, in four or eight bytes
    q, bounds = quantise(unit(vectors.astype(np.float64)))
    blob = lambda x: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
    return pa.table({
        "label": group["label"].slice(0, 1), "dim": group["dim"].slice(0, 1), "tile": group["tile"].slice(0, 1),
        "tiles": group["tiles"].slice(0, 1), "ids": blob(group["class_id"].to_numpy()), "sizes": blob(group["size"].to_numpy()),
        "q": blob(q), "bounds": blob(bounds), "vectors": blob(vectors),
    })


class Tile:
    def __init__(self, row: dict):
        dim = row["dim"]
        self.ids, self.sizes = (np.frombuffer(row[c], np.int64) for c in ("ids", "sizes"))
        self.q = np.frombuffer(row["q"], np.int8).reshape(-1, dim)
        self.scale, self.length, self.error = np.frombuffer(row["bounds"], np.float64).reshape(-1, 3).T
        width = len(row["vectors"]) // (len(self.ids) * dim)
        self.vectors = np.frombuffer(row["vectors"], f"f{width}").reshape(-1, dim).astype(np.float64)


def linked(a: Tile, b: Tile, threshold: float, rows: slice = slice(None)) -> tuple[np.ndarray, int]:
    """Which pairs of some rows of ``a`` with ``b`` reach the threshold, and how many had to be computed in full precision."""
    # Sums of products of int8 are whole numbers; float32 holds them exactly up to 2**24.
    exact = np.float32 if 127 * 127 * a.q.shape[1] < 1 << 24 else np.float64
    error, length, vectors = a.error[rows, None], a.length[rows, None], a.vectors[rows]
    near = (a.q[rows].astype(exact) @ b.q.astype(exact).T).astype(np.float64) * a.scale[rows, None] * b.scale
    slack = error * b.length + length * b.error + error * b.error + SLACK
    sure = near - slack >= threshold
    i, j = np.nonzero((near + slack >= threshold) & ~sure)
    for at in range(0, len(i), AGAIN):
        x, y = i[at : at + AGAIN], j[at : at + AGAIN]
        sure[x, y] = np.einsum("ij,ij->i", unit(vectors[x]), unit(b.vectors[y])) >= threshold
    return sure, len(i)


class Links:
    """The links of two tiles, a bit each, in strips of rows."""

    def __init__(self, a: Tile, b: Tile, threshold: float, same: bool):
        self.width, self.strips = len(b.ids), []
        for at in range(0, len(a.ids), STRIP):
            links, _ = linked(a, b, threshold, slice(at, at + STRIP))
            if same:
                own = np.arange(at, at + len(links))
                links[own - at, own] = False
            self.strips.append((at, len(links), np.packbits(links, axis=1)))

    def __iter__(self) -> Iterator[tuple[slice, np.ndarray]]:
        for at, n, bits in self.strips:
            yield slice(at, at + n), np.unpackbits(bits, axis=1, count=self.width).astype(bool)


def _roots(links: Links, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest class that each row and column reaches inside this pair of tiles."""
    top = np.iinfo(np.int64).max
    left, right = left.copy(), right.copy()
    changed = True
    while changed:
        changed = False
        for rows, found in links:
            new = np.minimum(left[rows], np.where(found, right, top).min(axis=1, initial=top))
            back = np.minimum(right, np.where(found, new[:, None], top).min(axis=0, initial=top))
            changed = changed or (new != left[rows]).any() or (back != right).any()
            left[rows], right = new, back
    return left, right


def _product(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["tile"])
        if len(rows) == 1 and rows[0]["low"] != rows[0]["high"]:  # no class was dealt to the other tile
            return pa.table({c: pa.array([], pa.int64()) for c in ("class_id", "n", "root")})
        a, b = Tile(rows[0]), Tile(rows[-1])
        links = Links(a, b, threshold, len(rows) == 1)
        n_left, n_right = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        for part, found in links:
            n_left[part] = found @ b.sizes
            n_right += a.sizes[part] @ found
        left, right = _roots(links, a.ids, b.ids)
        parts = [(a.ids, n_left, left)]
        if len(rows) == 2:
            parts.append((b.ids, n_right, right))
        ids, n, root = (np.concatenate(x) for x in zip(*parts, strict=True))
        some = n > 0
        return pa.table({"class_id": ids[some], "n": n[some].astype(np.int64), "root": root[some]})

    return run


def near_dedup(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, tile: int = TILE,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``vectors``.

    Rows are linked when their labels are equal and not null, their vectors have equal length, and
    their cosine in double precision is at least ``threshold`` (which must be above zero). Vectors that
    are null, empty, zero or hold null or non-finite components have no link and are their own
    component, as are rows without a label. n_links counts other rows, copies included. A row without
    an id has no link and no component and is not kept. Rows that repeat an id count as rows: each has the links and the
    component of its own vector. An empty table gives an empty result; other columns are not read.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"),
    ).withColumn("fit", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull())
    classes = stored(
        rows.filter("fit").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size"))
        .withColumns({"dim": F.size("vector"), "class_id": F.monotonically_increasing_id()})  # stored, so it stays
    )
    tiles = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = classes.join(tiles, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("class_id"), F.col("tiles")).cast("int"))
    packed = stored(dealt.groupBy("label", "dim", "tile", "tiles").applyInArrow(_pack, TILE_SCHEMA))
    pairs = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns(
        {"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}
    )
    found = stored(
        pairs.groupBy("label", "dim", "low", "high").applyInArrow(_product(threshold), "class_id bigint, n bigint, root bigint")
    )
    roots = components(found.select(F.col("class_id").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("class_id").agg(F.sum("n").alias("links"))
    placed = (
        classes.select("class_id", "least", "size").join(counts, "class_id", "left")
        .join(roots.select(F.col("node").alias("class_id"), "root"), "class_id", "left")
        .select("class_id", "least", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("root", "class_id").alias("class_root"))
    )
    lowest = placed.groupBy("class_root").agg(F.min("least").alias("root"))
    result = classes.select("label", "vector", "class_id").join(placed.join(lowest, "class_root").select("class_id", "n_links", "root"), "class_id")
    joined = rows.filter("fit").join(result, ["label", "vector"]).select("id", "n_links", "root")
    alone = rows.filter("not fit").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("root"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", F.col("root").alias("component_id"),
        F.coalesce(F.col("id") == F.col("root"), F.lit(False)).alias("kept"),
    )
