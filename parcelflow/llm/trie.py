"""The prefix trie of conversations, by union-find over the shared prefixes of sorted neighbours.

Conversations are sequences of turns. Distinct sequences are sorted; the longest common prefix (LCP) of each two neighbours is
an edge between them. Taking edges from the deepest up, every merge of components is a branching node of the trie at the
depth of the edge, and the turns between two merges are its nodes with one child. No trie is walked from the root.

The sequences are sorted by range into partitions, each of which does this on its own. What can still grow over a
boundary is its forest's left and right rim. It is contracted: of the edges only those that are the deepest that
lead on to the rim remain, at most two per depth, and all that lies between them is merged into one part with its sums.
Contracted forests of neighbouring partitions are joined, ``FAN`` at a time, by the same procedure until one is left. A task
holds a batch of sequences and its contracted forest, never a whole partition.

Sequences are compared ``PIECE`` turns at a time, so that a sort key has a bounded length whatever a conversation's: round s takes turns
PIECE * s + 1 to PIECE * (s + 1) of those sequences that share their first PIECE * s turns with another one. Rounds run from the
deepest up, and what a deeper one finds below a node is that node's start in the next. Turns behind the last shared piece
have no branch and are written straight from their piece.

Turns are told apart by 128 bits of SHA-256, whole prefixes by two sums of 56 bits of SHA-256 of place and turn: these add up in any order, so a
conversation is never held in one row or task.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelflow.llm.common import released, stored
from parcelflow.operators import skew

PIECE = 256
#: Sequences in a partition of a round.
PART_ROWS = 20_000
#: Contracted forests that are joined at a time.
FAN = 32
TURN_BYTES = 16

# What the query rebuilds: conversations in a block share up to MOST_SHARED - 1 first turns of the block's first one.
BLOCK = 100
MOST_SHARED = 6

NODE_SCHEMA = (
    "path binary, part int, ctx string, ref string, conv_id bigint, depth bigint, parent_conv_id bigint, parent_ref string, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_ARROW = pa.schema([
    ("path", pa.binary()), ("part", pa.int32()), ("ctx", pa.string()), ("ref", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("parent_ref", pa.string()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
])
NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass
class Part:
    """A component: the node at its top and the sums of all that is below this node."""

    ctx: str  # what the sequences share before this piece
    key: bytes  # TURN_BYTES for each turn of the piece down to the node
    chars: np.ndarray  # code points of the piece down to each depth, from 0
    n: int
    lo: int
    children: int
    under: int  # leaves below the node
    below: int  # saved tokens below the node
    ends: str | None
    referred: bool = False  # children of this node were written before its smallest member was known

    @property
    def top(self) -> int:
        return len(self.key) // TURN_BYTES

    @property
    def leaves(self) -> int:
        return self.under if self.children else 1

    def saved(self, depth: int) -> int:
        """Saved tokens of the subtree whose top node lies behind ``depth`` on the way to this node."""
        return self.below + (self.n - 1) * int(self.chars[self.top] - self.chars[depth])


def shared_turns(a: Part, b: Part) -> int:
    """LCP in turns; -1 where the parts do not share what comes before the piece."""
    if a.ctx != b.ctx:
        return -1
    at, end = 0, min(len(a.key), len(b.key))
    while at < end and a.key[at : at + TURN_BYTES] == b.key[at : at + TURN_BYTES]:
        at += TURN_BYTES
    return at // TURN_BYTES


def _ref(part: Part, depth: int) -> str:
    return hashlib.sha256(part.ctx.encode() + b"|" + part.key[: depth * TURN_BYTES]).hexdigest()[:32]


def _linked(paths: list[tuple[list[Part], list[int]]], depth: int) -> tuple[list[Part], list[int]]:
    """Contracted forests side by side, with an edge of ``depth`` between each two."""
    parts, edges = [], []
    for more, inside in paths:
        edges += ([depth] if parts else []) + inside
        parts = parts + more
    return parts, edges


class Forest:
    """Merges parts along their edges; finished nodes are collected as rows."""

    def __init__(self, base: int):
        self.base, self.rows = base, []

    def _chain(self, part: Part, depth: int, parent: int | None) -> None:
        """The nodes from below ``depth`` down to the top of a part; all have the same members."""
        for at in range(depth + 1, part.top + 1):
            last, first = at == part.top, at == depth + 1
            self.rows.append((
                None, None, None, _ref(part, at) if last and part.referred else None, part.lo, self.base + at, parent if first else part.lo,
                _ref(part, depth) if first and parent is None else None, part.n, part.children if last else 1, part.leaves,
                part.saved(at - 1), (last and part.ends) or NOTHING,
            ))

    def _joined(self, parts: list[Part], depth: int, whole: bool) -> Part:
        """One part with its top at ``depth``. Where it is not ``whole`` more may join its node later."""
        lo = min(p.lo for p in parts)
        node = Part(parts[0].ctx, parts[0].key[: depth * TURN_BYTES], parts[0].chars[: depth + 1], 0, lo, 0, 0, 0, None)
        for p in parts:
            node.n += p.n
            if p.top == depth:
                node.children, node.under, node.below = node.children + p.children, node.under + p.under, node.below + p.below
                node.ends, node.referred = node.ends or p.ends, node.referred or p.referred
            else:
                self._chain(p, depth, lo if whole else None)
                node.children, node.under, node.below = node.children + 1, node.under + p.leaves, node.below + p.saved(depth)
                node.referred = node.referred or not whole
        return node

    def merge(self, parts: list[Part], edges: list[int], left: bool, right: bool) -> tuple[list[Part], list[int]]:
        """Merge a run of sorted parts; ``left`` and ``right`` tell whether the run may go on there.

        Returns the contracted forest: the parts on the rims and the edges between them.
        """
        last = len(parts) - 1
        boss, end = list(range(len(parts))), list(range(len(parts)))  # a component is named by its first part
        path: dict[int, tuple[list[Part], list[int]]] = {i: ([p], []) for i, p in enumerate(parts)}

        def find(i: int) -> int:
            while boss[i] != i:
                boss[i] = boss[boss[i]]
                i = boss[i]
            return i

        def is_open(c: int) -> bool:
            return (left and c == 0) or (right and end[c] == last)

        def unite(run: list[int], depth: int) -> None:
            on_rim = [c for c in run if is_open(c)]
            inner = [path[c][0][0] for c in run if not is_open(c)]
            pieces = [([self._joined(inner, depth, not on_rim)], [])] if inner else []
            if run[0] in on_rim:
                pieces.insert(0, path[run[0]])
            if run[-1] in on_rim:
                pieces.append(path[run[-1]])
            for c in run[1:]:
                boss[c] = run[0]
                del path[c]
            path[run[0]] = _linked(pieces, depth)
            end[run[0]] = end[run[-1]]

        run: list[int] = []
        depth = -1
        for at in sorted((i for i, e in enumerate(edges) if e >= 0), key=lambda i: (-edges[i], i)):
            if run and edges[at] == depth and find(at) == run[-1]:
                run.append(find(at + 1))
            else:
                if run:
                    unite(run, depth)
                depth, run = edges[at], [find(at), find(at + 1)]
        if run:
            unite(run, depth)
        rims = []
        for c in sorted(path):
            if is_open(c):
                rims.append(path[c])
            else:
                group = self._joined(path[c][0], 0, True)
                self.rows.append((
                    None, None, group.ctx, _ref(group, 0), group.lo, self.base, None, None, group.n, group.children, group.under, group.below, group.ends,
                ))
        return _linked(rims, -1)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _batches(rows: list[tuple], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        columns = zip(*rows[at : at + size], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _path_row(part: int, path: tuple[list[Part], list[int]]) -> tuple:
    return (pickle.dumps(path), part, *[None] * (len(_ARROW) - 2))


def _partition_forests(base: int):
    """The forest of each partition of sorted items, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forest, path = Forest(base), ([], [])
        for batch in batches:
            items = [
                Part(r["ctx"], r["key"], np.cumsum([0, *r["chars"]]), r["n"], r["lo"], r["children"], r["under"], r["below"], r["ends"])
                for r in batch.to_pylist()
            ]
            if items:
                parts, edges = path[0] + items, list(path[1])
                edges += [shared_turns(a, b) for a, b in zip(parts[len(edges) :], parts[len(edges) + 1 :])]
                path = forest.merge(parts, edges, True, True)
                yield from _batches(forest.taken())
        if path[0]:
            yield from _batches([_path_row(TaskContext.get().partitionId(), path)])

    return released(run)


def _joined_forests(base: int, fan: int, last: bool):
    """One forest from up to ``fan`` neighbouring ones."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["part"].to_pylist(), group["path"].to_pylist()))
        paths = [pickle.loads(p) for _, p in rows]
        parts, edges = [], []
        for more, inside in paths:
            edges += ([shared_turns(parts[-1], more[0])] if parts else []) + inside
            parts = parts + more
        forest = Forest(base)
        path = forest.merge(parts, edges, not last, not last)
        out = forest.taken()
        if path[0]:
            out.append(_path_row(rows[0][0] // fan, path))
        return pa.Table.from_batches(_batches(out), _ARROW)

    return run


def _grown(items: DataFrame, base: int, part_rows: int, fan: int) -> DataFrame:
    """Rows of nodes and of finished groups, from the items of a round."""
    columns = ("ctx", "key", "chars", "n", "lo", "children", "under", "below", "ends")
    items = stored(items.select(*columns))
    parts = max(1, -(-items.count() // part_rows))
    ranged = items.repartitionByRange(parts, "ctx", "key").sortWithinPartitions("ctx", "key")
    found = stored(ranged.mapInArrow(_partition_forests(base), NODE_SCHEMA))
    done = [found.filter("path IS NULL")]
    while True:
        groups = -(-parts // fan)
        paths = found.filter("path IS NOT NULL").select("part", "path").withColumn("g", F.floor(F.col("part") / fan))
        found = stored(paths.groupBy("g").applyInArrow(_joined_forests(base, fan, groups == 1), NODE_SCHEMA))
        done.append(found.filter("path IS NULL"))
        if groups == 1:
            break
        parts = groups
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, i, dig, chars): the turns of each conversation in order, from 1, as digests and code points.

    The order is by turn, null first, then by role and text. Rows without a conversation belong to none and are left out.
    """
    rows = conversations.select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((role_col, "role"), (text_col, "text"))],
    ).filter("conv IS NOT NULL")
    marked = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return skew.row_number(rows, ["conv"], ["turn", "role", "text"], "i").select(
        "conv", F.col("i").cast("bigint").alias("i"), F.substring(F.sha2(marked, 256), 1, 2 * TURN_BYTES).alias("dig"),
        F.length("text").cast("bigint").alias("chars"),
    )


def _shared(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, dig, chars) and (conv) of conversations that begin with the first turns of their block's first one.

    Conversation c takes the first h turns of c - c % BLOCK (% as in SQL, with the sign of c), as many as there are, and
    goes on with its own turns behind its h-th, h = crc32(c) % MOST_SHARED. The second table has every conversation, also those that keep no turn.
    """
    first = F.col("conv") - F.col("conv") % BLOCK
    heads = turns.filter((F.col("conv") % BLOCK == 0) & (F.col("i") < MOST_SHARED)).select(F.col("conv").alias("first"), "i", "dig", "chars")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).select("conv", first.alias("first"))
    long = heads.groupBy("first").agg(F.max("i").alias("most"))
    convs = convs.join(long, "first", "left").select("conv", "first", F.least(_shared(F.col("conv")), F.coalesce("most", F.lit(0))).alias("taken"))
    own = turns.filter(F.col("i") > _shared(F.col("conv"))).join(convs.select("conv", "taken"), "conv").select(
        "conv", (F.col("taken") + F.col("i") - _shared(F.col("conv"))).alias("depth"), "dig", "chars"
    )
    taken = convs.join(heads, "first").filter(F.col("i") <= F.col("taken")).select("conv", F.col("i").alias("depth"), "dig", "chars")
    return own.unionByName(taken), convs.select("conv")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by sequence and conversation: runs of ids of one sequence as text, with the first id and their number."""
    names = ("cls", "first", "n", "ids")
    for batch in batches:
        rows = []
        for cls, members in itertools.groupby(zip(batch.column("cls").to_pylist(), batch.column("conv").to_pylist(), strict=True), lambda r: r[0]):
            ids = [conv for _, conv in members]
            rows.append((cls, ids[0], len(ids), ",".join(map(str, ids))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], names)


def _ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of such runs in order: how many conversations a sequence has, the first, and the hash of the list."""
    names = ("cls", "n", "lo", "ends")
    now, n, lo, sha = None, 0, None, None

    for batch in batches:
        rows = []
        for cls, first, more, ids in zip(*(batch.column(c).to_pylist() for c in ("cls", "first", "n", "ids")), strict=True):
            if cls != now:
                if sha is not None:
                    rows.append((now, n, lo, sha.hexdigest()))
                now, n, lo, sha = cls, 0, first, hashlib.sha256()
            sha.update(f",{ids}".encode() if n else ids.encode())
            n += more
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], names)
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (now, n, lo, sha.hexdigest())], names)


def _tails(piece: int):
    """The nodes of pieces that no other sequence shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                before, rows = r["total"] - r["seen"] + sum(r["chars"]), []
                for depth, chars in enumerate(r["chars"], r["s"] * piece + 1):
                    end = depth == r["len"]
                    rows.append((
                        None, None, None, None, r["lo"], depth, r["lo"], None, r["n"], 0 if end else 1, 1, (r["n"] - 1) * before, r["ends"] if end else NOTHING,
                    ))
                    before -= chars
                yield from _batches(rows)

    return released(run)


def trie(turns: DataFrame, convs: DataFrame | None = None, piece: int = PIECE, part_rows: int = PART_ROWS, fan: int = FAN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has (conv, depth, dig, chars) with depths 1, 2, ... per conversation, ``convs`` every conversation (default: those
    of ``turns``). The root has depth 0 and no parent. A node's conv_id is its smallest member. Equal sequences are one sequence
    with several members. SHA-256 takes their ids one after another: they are sorted and joined to runs in many tasks, and one task
    hashes the runs of a sequence in order without holding them. An empty table gives no node, not even a root.
    """
    mark = F.sha2(F.concat_ws(":", "depth", "dig"), 256)
    lanes = [F.conv(F.substring(mark, at, 14), 16, 10).cast("decimal(18,0)").alias(name) for at, name in ((1, "a"), (15, "b"))]
    rows = stored(turns.select("conv", "depth", "dig", "chars", *lanes))
    zero = F.lit(0).cast("decimal(28,0)")
    sums = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("len"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    if convs is not None:
        sums = convs.join(sums, "conv", "left")
    name = F.concat_ws(":", F.coalesce("len", F.lit(0)), F.coalesce("a", zero), F.coalesce("b", zero))
    members = stored(sums.select("conv", name.alias("cls"))).repartitionByRange("cls", "conv").sortWithinPartitions("cls", "conv")
    runs = members.mapInArrow(released(_packed), "cls string, first bigint, n bigint, ids string").repartition("cls").sortWithinPartitions("cls", "first")
    classes = stored(
        runs.mapInArrow(released(_ending), "cls string, n bigint, lo bigint, ends string")
        .withColumn("len", F.substring_index("cls", ":", 1).cast("bigint"))
    )
    pieces = _pieces(rows, classes, piece)
    contexts = stored(pieces.filter("s > 0").groupBy("s", "ctx").agg(F.count(F.lit(1)).alias("seqs")).filter("seqs > 1").select("s", "ctx"))
    rounds = contexts.agg(F.max("s")).first()[0] or 0
    shared = stored(pieces.filter("s = 0").unionByName(pieces.filter("s > 0").join(contexts, ["s", "ctx"], "left_semi")))
    nodes, below = [], None
    for s in range(rounds, -1, -1):
        grown = _grown(_items(shared.filter(F.col("s") == s), below, (s + 1) * piece), s * piece, part_rows, fan)
        nodes.append(grown)
        below = grown.filter("ctx IS NOT NULL")
    last = shared.groupBy("cls").agg(F.max("s").alias("last"))
    alone = pieces.filter("s > 0").join(last, "cls").filter("s > last").select("s", "chars", "seen", "total", "len", "lo", "n", "ends")
    return _complete(nodes, alone.mapInArrow(_tails(piece), NODE_SCHEMA))


def _pieces(rows: DataFrame, classes: DataFrame, piece: int) -> DataFrame:
    """The pieces of each distinct sequence, taken from its smallest member; one that ends with a piece has an empty one behind it."""
    reps = rows.join(classes.select(F.col("lo").alias("conv"), "cls"), "conv")
    filled = reps.groupBy("cls", F.floor((F.col("depth") - 1) / piece).alias("s")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "dig", "chars"))).alias("turns"),  # at most ``piece``
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("chars").alias("sum"),
    )
    every = classes.withColumn("s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("len") / piece))))
    joined = every.join(filled, ["cls", "s"], "left")
    until = Window.partitionBy("cls").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("cls").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("cls").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(28,0)")

    def prefix(depth: Column, over) -> Column:
        return F.concat_ws(":", depth, *[F.coalesce(F.sum(c).over(over), zero).cast("decimal(38,0)") for c in ("a", "b")])

    return stored(joined.select(
        "cls", "s", "n", "lo", "ends", "len", prefix(F.col("s") * piece, before).alias("ctx"),
        prefix(F.least(F.col("len"), (F.col("s") + 1) * piece), until).alias("next_ctx"),
        F.unhex(F.coalesce(F.array_join("turns.dig", ""), F.lit(""))).alias("key"),
        F.coalesce("turns.chars", F.array().cast("array<bigint>")).alias("chars"),
        F.coalesce(F.sum("sum").over(until), F.lit(0)).alias("seen"), F.coalesce(F.sum("sum").over(whole), F.lit(0)).alias("total"),
    ))


def _items(pieces: DataFrame, below: DataFrame | None, end: int) -> DataFrame:
    """The distinct pieces of a round, with what lies below each."""
    same = pieces.groupBy("ctx", "next_ctx").agg(
        F.count(F.lit(1)).alias("seqs"), *[F.min(c).alias(c) for c in ("key", "chars", "n", "lo", "ends", "len", "seen", "total")]
    )
    goes_on = F.col("len") > end
    single = same.filter("seqs = 1").select(
        "ctx", "key", "chars", "n", "lo", *[F.when(goes_on, 1).otherwise(0).cast("bigint").alias(c) for c in ("children", "under")],
        F.when(goes_on, (F.col("n") - 1) * (F.col("total") - F.col("seen"))).otherwise(F.lit(0)).cast("bigint").alias("below"),
        F.when(~goes_on, F.col("ends")).alias("ends"),
    )
    if below is None:
        return single
    sums = below.select(
        F.col("ctx").alias("next_ctx"), F.col("n_convs").alias("n"), F.col("conv_id").alias("lo"), F.col("n_children").alias("children"),
        F.col("n_leaves").alias("under"), F.col("saved_tokens").alias("below"), F.col("ends_sha256").alias("ends"),
    )
    return single.unionByName(same.filter("seqs > 1").select("ctx", "next_ctx", "key", "chars").join(sums, "next_ctx").select(*single.columns))


def _complete(rounds: list[DataFrame], tails: DataFrame) -> DataFrame:
    """All nodes, with the parents that were not known when a node was written, and the root."""
    rows = tails
    for grown in rounds:
        rows = rows.unionByName(grown.filter("ctx IS NULL"))
    groups = rounds[0].filter("ctx IS NOT NULL")
    for grown in rounds[1:]:
        groups = groups.unionByName(grown.filter("ctx IS NOT NULL"))
    known = rows.unionByName(groups).filter("ref IS NOT NULL").select(F.col("ref").alias("parent_ref"), F.col("conv_id").alias("found"))
    late = rows.filter("parent_ref IS NOT NULL").join(known, "parent_ref", "left").withColumn("parent_conv_id", F.col("found"))
    root = rounds[-1].filter("ctx IS NOT NULL").withColumn("n_leaves", F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))
    )
    out = rows.filter("parent_ref IS NULL").select(*NODE_COLUMNS)
    return out.unionByName(late.select(*NODE_COLUMNS)).unionByName(root.select(*NODE_COLUMNS))


def rebuilt_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", **limits: int,
) -> DataFrame:
    """The trie of the rebuilt conversations of a table; see ``numbered``, ``rebuilt`` and ``trie``.

    Null roles and texts are empty. Turns that repeat in all of turn, role and text stay repeated. Other columns are not read.
    """
    return trie(*rebuilt(stored(numbered(conversations, conv_col, turn_col, role_col, text_col))), **limits)
