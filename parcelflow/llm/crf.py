"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line is described by shares of character classes, by its words and their
repetition, and by the same figures of the lines before and after it. The field adds weights between
neighbouring labels. A document's score is the mean of its lines' probabilities to be good
(forward-backward marginals), weighted by their lengths.

Chains are cut into blocks of ``BLOCK_LINES``. What a block does to the message that comes in is a 2 x 2 matrix; with these the messages are carried
from block to block in both directions, and all blocks of all texts are then worked off side by side. Figures and features are made
for ``LINES_AT_A_TIME`` lines at a time: a long text keeps one weight and one length per line, and messages are carried over its parts.

Labels are known per document; in training each line has the label of its document. The fit takes whole texts of at
most ``SAMPLE`` documents of each label, those with the smallest hash of the id, up to ``SAMPLE_LINES`` lines of each label in all; documents of more
than ``LONGEST_SAMPLED`` lines are not taken. So its cost does not depend on the size of the tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.llm.common import released, stored

SAMPLE = 2000
SAMPLE_LINES = 75_000
LONGEST_SAMPLED = 5000
SAMPLE_SEED = 11
ROUNDS = 120
RATE = 0.12
DECAY = 1e-3
BINS = 8
HELD_OUT_MOD = 5
#: A document is taken for good from this score on.
GOOD = 0.3
#: Bytes that are classified at a time, and of short texts that are scored together.
SEGMENT = 1 << 20
#: Lines whose figures are held at a time, and lines of a chain that are stepped through one after another.
LINES_AT_A_TIME = 1 << 14
BLOCK_LINES = 64
#: From this length on the words of a line are counted without a list of them.
LONG_LINE = 1 << 20

# Classes of bytes: lower case, upper case, digits, blanks, stops, exclamation, bars, brackets and quotes, other signs, not ASCII.
LOWER, UPPER, DIGIT, BLANK, STOP, CRY, BAR, QUOTE, SIGN, HIGH = range(10)
CLASSES = 10


def _classes() -> np.ndarray:
    table = np.full(256, SIGN, np.uint8)
    table[128:] = HIGH
    for kind, chars in ((LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, b"0123456789"),
                        (BLANK, b" \t\n\v\f\r"), (STOP, b".,;:?-"), (CRY, b"!"), (BAR, b"|"), (QUOTE, b"\"'()[]")):
        table[np.frombuffer(chars, np.uint8)] = kind
    return table


_CLASS = _classes()
FIGURES = 16


_WORD = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


def _word_counts(line: bytes) -> tuple[int, int, int]:
    """Words, distinct words, and words that repeat the one before."""
    if len(line) < LONG_LINE:
        w = line.split()
        return len(w), len(set(w)), sum(map(eq, w, w[1:]))
    n = again = 0
    distinct: set[int] = set()
    last = None
    for m in _WORD.finditer(line):
        word = hash(m[0])
        n, again, last = n + 1, again + (word == last), word
        distinct.add(word)
    return n, len(distinct), again


def figures_of(lines: list[bytes], copied: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Figures and lengths of lines; ``copied`` tells which have come before in their text."""
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    lengths = np.diff(ends, prepend=-1) - 1
    counts = np.zeros((len(ends), CLASSES))
    for at in range(0, len(data), SEGMENT):
        part = data[at : at + SEGMENT]
        first = np.searchsorted(ends, at)
        line = np.zeros(len(part), np.int64)
        line[1:] = np.cumsum(part[:-1] == 10)
        found = np.bincount(line * CLASSES + _CLASS[part]).astype(float)
        found = np.pad(found, (0, -len(found) % CLASSES)).reshape(-1, CLASSES)
        counts[first : first + len(found)] += found
    counts[:, BLANK] -= 1  # the line break itself
    n, distinct, again = np.array([_word_counts(line) for line in lines], float).reshape(-1, 3).T
    letters = counts[:, LOWER] + counts[:, UPPER] + counts[:, HIGH]
    signs = counts[:, STOP] + counts[:, CRY] + counts[:, BAR] + counts[:, QUOTE] + counts[:, SIGN]
    size, some, with_letters = np.maximum(lengths, 1), np.maximum(n, 1), np.maximum(letters, 1)
    figures = np.stack([
        np.log1p(lengths), letters / size, counts[:, UPPER] / with_letters, counts[:, DIGIT] / size, counts[:, HIGH] / size,
        counts[:, STOP] / some, counts[:, CRY] / some, counts[:, BAR] / some, counts[:, QUOTE] / some, counts[:, SIGN] / some,
        np.minimum(signs / some, 8), np.minimum(lengths / some, 40), distinct / some, again / some, np.array(copied, float), n == 0,
    ], axis=1)
    return figures, lengths


def line_runs(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of all lines of some texts, at most ``LINES_AT_A_TIME`` at a time: their figures, their lengths, and which begin a text.

    A text without a line break is one line, an empty text one empty line. The lines of a run hold about ``SEGMENT`` bytes where one of them does
    not hold more.
    """
    lines: list[bytes] = []
    copied: list[bool] = []
    firsts: list[bool] = []
    held = 0
    for text in texts:
        seen: set[int] = set()
        at = 0
        while at >= 0:
            end = text.find(b"\n", at)
            line = text[at:end] if end >= 0 else text[at:]
            mark = hash(line)
            lines.append(line)
            copied.append(mark in seen)
            firsts.append(at == 0)
            seen.add(mark)
            held += len(line)
            at = end + 1 if end >= 0 else -1
            if len(lines) >= LINES_AT_A_TIME or held >= SEGMENT:
                yield *figures_of(lines, copied), np.array(firsts)
                lines, copied, firsts, held = [], [], [], 0
    if lines:
        yield *figures_of(lines, copied), np.array(firsts)


@dataclass
class Model:
    """Bin edges of the figures, weights of the features for a good line, and weights between labels."""

    edges: np.ndarray
    weights: np.ndarray
    between: np.ndarray
    start: np.ndarray

    def own(self, figures: np.ndarray) -> np.ndarray:
        """How far each figure of a line has passed each of its bins."""
        low, high = self.edges[:, :-1], self.edges[:, 1:]
        width = np.where(high > low, high - low, 1)
        return np.clip((figures[:, :, None] - low) / width, 0, 1).reshape(len(figures), -1).astype(np.float32)


def weighed(own: np.ndarray, weights: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, float, float]:
    """The weights of lines for good, from their own figures and their neighbours'; and what the run adds to the line before and behind it.

    ``weights`` are those of a line's own figures, of the line before, of the line behind, of a first line, of a last one, and a constant.
    """
    k = own.shape[1]
    good = own @ weights[:k] + firsts * weights[-3] + lasts * weights[-2] + weights[-1]
    forth, back = own @ weights[k : 2 * k], own @ weights[2 * k : 3 * k]
    good[1:] += np.where(firsts[1:], 0, forth[:-1])
    good[:-1] += np.where(lasts[:-1], 0, back[1:])
    return good, 0.0 if firsts[0] else float(back[0]), 0.0 if lasts[-1] else float(forth[-1])


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(
    good: np.ndarray, per_text: np.ndarray, between: np.ndarray, start: np.ndarray, of_text: np.ndarray | None = None,
    enter: np.ndarray | None = None, leave: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """P(good) of each line; with weights of the texts the expected number of each pair of neighbouring labels; and the
    messages of each text to what follows and to what comes before.

    Texts have a line at least. ``enter`` and ``leave`` (two numbers a text) are the messages that reach its first and last line from outside; by default
    a text begins with the weights ``start`` and ends with nothing.
    """
    n_texts = len(per_text)
    score = np.stack([-good / 2, good / 2], axis=1)
    local = np.exp(score - score.max(axis=1, keepdims=True))
    move = np.exp(between)
    enter = np.tile(np.exp(start), (n_texts, 1)) if enter is None else enter
    leave = np.ones((n_texts, 2)) if leave is None else leave
    # Blocks of each text; the longest lie first, so that those with a line at a step are a prefix.
    per_block = -(-per_text // BLOCK_LINES)
    text_of = np.repeat(np.arange(n_texts), per_block)
    number = np.arange(len(text_of)) - np.repeat(np.cumsum(per_block) - per_block, per_block)
    first = (np.cumsum(per_text) - per_text)[text_of] + number * BLOCK_LINES
    size = np.minimum(BLOCK_LINES, per_text[text_of] - number * BLOCK_LINES)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, BLOCK_LINES + 1), side="right")
    active = active[active > 0]
    # What each block makes of a message for bad and of one for good, up to a common factor.
    through = np.zeros((len(text_of), 2, 2))
    for t, n in enumerate(active):
        b = order[:n]
        step = np.eye(2)[None] * np.ones((n, 1, 1)) if t == 0 else through[b] @ move
        step = step * local[first[b] + t][:, None, :]
        through[b] = step / step.sum(axis=(1, 2), keepdims=True)
    block = np.cumsum(per_block) - per_block
    came, went = np.empty((len(text_of), 2)), np.empty((len(text_of), 2))
    ahead, behind = _scaled(enter), _scaled(leave)
    for k in range(int(per_block.max(initial=0))):
        some = np.flatnonzero(per_block > k)
        at = block[some] + k
        came[at] = ahead[some]
        ahead[some] = _scaled(np.einsum("ti,tij->tj", ahead[some], through[at]) @ move)
        at = block[some] + per_block[some] - 1 - k
        went[at] = behind[some]
        behind[some] = _scaled(np.einsum("tij,tj->ti", through[at], behind[some]) @ move.T)
    forward, backward = np.empty_like(local), np.empty_like(local)
    for t, n in enumerate(active):
        b = order[:n]
        at = first[b] + t
        forward[at] = _scaled(local[at] * (came[b] if t == 0 else forward[at - 1] @ move))
    for t in range(len(active) - 1, -1, -1):
        b = order[: active[t]]
        at = first[b] + t
        ends = size[b] == t + 1
        backward[at[ends]] = went[b[ends]]
        rest = at[~ends]
        backward[rest] = _scaled((local[rest + 1] * backward[rest + 1]) @ move.T)
    pairs = np.zeros((2, 2))
    if of_text is not None:
        inner = np.ones(len(good), bool)
        inner[np.cumsum(per_text) - per_text] = False
        at = np.flatnonzero(inner)
        joint = forward[at - 1][:, :, None] * move * (local[at] * backward[at])[:, None, :]
        pairs = np.einsum("n,nij->ij", np.repeat(of_text, per_text)[at], joint / joint.sum(axis=(1, 2), keepdims=True))
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), pairs, ahead, behind


def train(figures: np.ndarray, per_text: np.ndarray, label: np.ndarray) -> Model:
    """Weights of most likelihood, with decay, by Adam. Both labels weigh alike."""
    edges = np.quantile(figures, np.linspace(0, 1, BINS + 1), axis=0).T
    # A share that is zero nearly everywhere has its bins between zero and its largest value.
    flat = edges[:, -2] <= edges[:, 0]
    edges[flat] = np.linspace(edges[flat, 0], edges[flat, -1], BINS + 1).T
    model = Model(edges, np.zeros(0), np.zeros((2, 2)), np.zeros(2))
    own = np.concatenate([model.own(figures[at : at + LINES_AT_A_TIME]) for at in range(0, len(figures), LINES_AT_A_TIME)])
    y = np.repeat(label, per_text)
    share = np.bincount(label, minlength=2) / len(label)
    of_text = 0.5 / np.maximum(share, 1e-9)[label]
    weight = np.repeat(of_text, per_text)
    last = np.cumsum(per_text)
    first = last - per_text
    firsts, lasts = np.zeros(len(y), bool), np.zeros(len(y), bool)
    firsts[first], lasts[last - 1] = True, True
    same = np.array([[((per_text - 1) * of_text)[label == 0].sum(), 0], [0, ((per_text - 1) * of_text)[label == 1].sum()]])
    theta, m, v = np.zeros(3 * own.shape[1] + 3 + 6), 0, 0
    for step in range(1, ROUNDS + 1):
        w, between, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        good, _, _ = weighed(own, w.astype(np.float32), firsts, lasts)
        p, pair, _, _ = marginals(good.astype(float), per_text, between, start, of_text)
        r = (weight * (y - p)).astype(np.float32)
        behind, before = np.append(np.where(firsts[1:], 0, r[1:]), 0), np.insert(np.where(lasts[:-1], 0, r[:-1]), 0, 0)
        grad_w = np.concatenate([own.T @ r, own.T @ behind.astype(np.float32), own.T @ before.astype(np.float32), [r[firsts].sum(), r[lasts].sum(), r.sum()]])
        grad_start = np.array([(of_text * ((label == k) - np.where(k, p[first], 1 - p[first]))).sum() for k in (0, 1)])
        grad = np.concatenate([grad_w, (same - pair).ravel(), grad_start]) / weight.sum() - DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(edges, theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:])


def line_weights(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of some texts: the weight for good, the length, and where texts begin; the figures are held run by run."""
    good, lengths, firsts, carried = [], [], [], 0.0
    runs = line_runs(texts)
    run = next(runs, None)
    while run is not None:
        behind = next(runs, None)
        begins = run[2]
        ends = np.append(begins[1:], True if behind is None else behind[2][0])
        own, to_before, to_behind = weighed(model.own(run[0]), model.weights, begins, ends)
        if good:
            good[-1][-1] += to_before
        own[0] += carried
        carried = to_behind
        good.append(own)
        lengths.append(run[1].astype(np.int32))
        firsts.append(begins)
        run = behind
    return np.concatenate(good), np.concatenate(lengths), np.concatenate(firsts)


def _means(p: np.ndarray, lengths: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """(sum of p by weight, sum of weights) of each text."""
    starts = np.cumsum(per_text) - per_text
    weight = lengths + 1.0  # so that empty lines count, and an empty text has a score
    return np.stack([np.add.reduceat(weight * p, starts), np.add.reduceat(weight, starts)], axis=1)


def score_texts(texts: list[bytes], model: Model | None) -> np.ndarray:
    """Score of each text, 0 to 1; without a model 0.5."""
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    good, lengths, firsts = line_weights(texts, model)
    starts = np.flatnonzero(firsts)
    per_text = np.diff(np.append(starts, len(good)))
    if len(texts) == 1 and len(good) > LINES_AT_A_TIME:
        return _long_score(good, lengths, model)
    p, *_ = marginals(good, per_text, model.between, model.start)
    sums = _means(p, lengths, per_text)
    return np.clip(sums[:, 0] / sums[:, 1], 0, 1)


def _long_score(good: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Score of one long text: messages forward over its parts, then backward with the marginals of each part."""
    places = [slice(at, at + LINES_AT_A_TIME) for at in range(0, len(good), LINES_AT_A_TIME)]
    enters = [np.exp(model.start)[None]]
    for part in places[:-1]:
        enters.append(marginals(good[part], np.array([len(good[part])]), model.between, model.start, enter=enters[-1])[2])
    leave, sums = np.ones((1, 2)), np.zeros(2)
    for part, enter in zip(reversed(places), reversed(enters), strict=True):
        n = np.array([len(good[part])])
        p, _, _, leave = marginals(good[part], n, model.between, model.start, enter=enter, leave=leave)
        sums += _means(p, lengths[part], n)[0]
    return np.clip(sums[:1] / sums[1], 0, 1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_MOD == 0


def _in_parts(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    """Short texts together, a text of ``SEGMENT`` bytes or more alone."""
    part, size = [], 0
    for text in texts:
        text = text or b""
        if part and size + len(text) >= SEGMENT:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The figures of all lines of each sampled text, in four bytes each."""
    for batch in batches:
        rows = [b"".join(f.astype("<f4").tobytes() for f, _, _ in line_runs([text.as_py() or b""])) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("quality"), pa.array(rows, pa.binary())], ["h", "quality", "figures"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """A model from labelled rows that are not held out; None where a label has no row.

    Rows of ``labels`` without id or label are left out, and so is an id with both labels.
    """
    ids = (
        labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("quality"))
        .filter(F.col("_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
        .withColumn("h", F.xxhash64("_id", F.lit(SAMPLE_SEED)))
    )
    some = [ids.filter(F.col("quality") == k).orderBy("h").limit(SAMPLE).select("_id", "quality", "h") for k in (0, 1)]
    sample = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * SAMPLE rows of three whole numbers
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("binary").alias("text")).join(sample, "_id")
    lines = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("\n")) + 1
    texts = stored(texts.select("h", "quality", "text", lines.alias("lines")).filter(F.col("lines") <= LONGEST_SAMPLED))
    sizes = texts.groupBy("quality", "h").agg(F.sum("lines").alias("lines")).orderBy("quality", "h").collect()  # at most 2 * SAMPLE rows of numbers
    until = {}
    for k in (0, 1):
        held = np.cumsum([r["lines"] for r in sizes if r["quality"] == k])
        hashes = [r["h"] for r in sizes if r["quality"] == k]
        n = int(np.searchsorted(held, SAMPLE_LINES, side="right"))
        if n:
            until[k] = hashes[n - 1]
    if len(until) < 2:
        return None
    taken = texts.filter(" OR ".join(f"(quality = {k} AND h <= {h})" for k, h in until.items()))
    rows = taken.select("h", "quality", "text").mapInArrow(_figures, "h bigint, quality int, figures binary").collect()  # SAMPLE_LINES of each label
    rows = sorted({(r["h"], r["quality"], bytes(r["figures"])) for r in rows})
    label = np.array([q for _, q, _ in rows], int)
    figures = [np.frombuffer(f, "<f4").reshape(-1, FIGURES) for *_, f in rows]
    return train(np.vstack(figures), np.array([len(f) for f in figures]), label)


def score_all(texts: Iterable[bytes | None], model: Model | None) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(score_texts(part, model) for part in _in_parts(texts))])


def _scores(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_all((t.as_py() for t in batch.column("text")), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return released(run)


def scored(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of ``docs``.

    Null texts count as empty, and an empty text is one empty line. A null id is held_out = null.
    Repeated rows get equal scores; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id bigint, score double").select(
        F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``GOOD``, with their columns."""
    score = F.pandas_udf(lambda texts: pd.Series(score_all((t if t is None else bytes(t) for t in texts), model)), "double")
    return docs.filter(score(F.col(text_col).cast("binary")) >= GOOD)
