"""Toxicity by a weighted finite-state grammar over clauses.

Two layers of transducers are composed. The lower one reads letters: the words of every class (insult, harm, intention, target,
negation, report) are one Aho-Corasick automaton, which gives each word its class and an insult its weight; an entry that ends
in ``*`` is a stem and takes any word that begins with it. The upper one reads classes. Five small machines,

* insult: takes a weight at each insult;
* threat: an intention, a verb of harm and a target in this order, at most ``REACH`` words apart;
* target: a person addressed or named near an insult makes it heavier, before or after it;
* negation: a negated insult or threat weighs little, up to ``REACH`` words behind the negation or to the next comma;
* reported speech: what somebody is said to have said weighs less, up to the end of the clause;

are composed into one deterministic machine whose arcs carry a factor for the insult at hand and a weight of their own. A clause's score is the weight
of its path. A document's score is a logistic function of its heaviest clause, the sum over clauses and their number, so that a word
counts by the clause that it stands in. Clauses without an insult or a threat weigh nothing and are not walked.

The insults are learned: words and stems of 4 to 7 letters that occur in more toxic than other labelled documents, weighed by smoothed
log odds, where a likelihood ratio test leaves no doubt and they stand among ever other words, not in copies of one text. At most ``SAMPLE`` labelled documents of each kind are read for it, those with the
smallest hash of the id; at most ``MAX_INSULTS`` entries, the most certain ones, make the model. A short list of general insults
is part of the grammar in any case, as are the closed classes in English, French, German and Spanish.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.common import released, stored
from parcelflow.llm.crf import held_out

#: Documents of each label, clean and toxic, that the model learns from.
SAMPLE = (20_000, 4000)
SAMPLE_SEED = 12
MAX_INSULTS = 5000
STEMS = (4, 5, 6, 7)
#: Words whose class a task keeps.
KNOWN = 200_000
#: Longer words are no features of their own.
LONGEST = 32
#: Entries of a text that are counted at a time; a longer text counts as several.
PASSAGE = 200_000
MIN_WEIGHT = 3.0
#: Likelihood ratio from which an entry is taken: chance gives it once in about two million.
CERTAIN = 25.0
#: Places, by the words beside it, that an entry must have for each toxic text that holds it. Words of a text that was copied often fall short.
VARIED = 0.25
TOXIC = 0.5
REACH = 4
#: What becomes of an insult's weight, and the weight of a threat.
NEGATED, REPORTED, TARGETED, THREAT, GENERAL = 0.1, 0.4, 1.5, 6.0, 4.0
ROUNDS, RATE, DECAY = 1000, 0.2, 1e-4

OTHER, INSULT, HARM, INTENT, TARGET, NEGATION, REPORT, COMMA = range(8)
# The closed classes of the grammar, and general insults.
WORDS = {
    INSULT: "idiot idiots moron morons imbecile scum worthless pathetic disgusting trash loser losers stupid vermin filth abruti connard ordure crétin "
            "dummkopf abschaum idioten arschloch imbécil basura estúpido escoria",
    HARM: "kill hurt destroy beat stab shoot burn punch crush murder tuer frapper détruire brûler töten schlagen verletzen umbringen matar golpear "
          "destruir quemar",
    INTENT: "will gonna shall going i'll we'll vais allons va werde werden will voy vamos",
    TARGET: "you your you're yourself he she they them him her his their u tu vous toi te il elle ils eux du ihr dich euch sie er ihn ella usted "
            "ustedes ellos él",
    NEGATION: "not no never isn't aren't don't doesn't didn't won't can't cannot wasn't weren't nobody pas jamais aucun nicht kein keine nie niemals nunca "
              "jamás ningún ninguna",
    REPORT: "said says say told tells wrote writes claimed claims called alleged reported quoted dit disait écrit affirme sagte sagt schrieb behauptet dijo "
            "dice escribió afirmó",
}
SINGLE_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[,]")
CLAUSE_END = re.compile(r"[.!?;:\n]")


def compose() -> list[list[tuple[int, float, float, float]]]:
    """By state and class: next state, and the factors of this insult's weight, of the last insult's weight, and of ``THREAT``.

    The five machines run side by side; only states that can be reached are made, and state 0 begins a clause. A state is (words
    that a negation still covers, reported, words that a target still covers, stage of a threat, steps left of it, words that the last
    insult still waits for its target).
    """
    start = (0, False, 0, 0, 0, 0)
    names, table, queue = {start: 0}, [], [start]
    for state in queue:
        arcs = []
        for kind in range(8):
            negated, reported, near, stage, left, wait = state
            soft = (NEGATED if negated else 1.0) * (REPORTED if reported else 1.0)
            insult = soft * (TARGETED if near else 1.0) if kind == INSULT else 0.0
            again = soft * (TARGETED - 1) if kind == TARGET and wait else 0.0
            threat = soft if kind == TARGET and stage == 2 else 0.0
            if kind == INTENT:
                stage, left = 1, REACH
            elif kind == HARM and stage:
                stage, left = 2, REACH
            elif threat or kind == COMMA or left <= 1:
                stage, left = 0, 0
            else:
                left -= 1
            wait = REACH if kind == INSULT and not near else 0 if kind in (TARGET, COMMA) else max(0, wait - 1)
            near = REACH if kind == TARGET else max(0, near - 1)
            negated = REACH if kind == NEGATION else 0 if kind == COMMA else max(0, negated - 1)
            new = (negated, reported or kind == REPORT, near, stage, left, wait)
            if new not in names:
                names[new] = len(names)
                queue.append(new)
            arcs.append((names[new], insult, again, threat))
        table.append(arcs)
    return table


@dataclass
class Model:
    """Insults with their weights (stems end in ``*``), and the logistic function of a document's figures."""

    insults: dict[str, float]
    bias: float = -4.0
    weights: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.5, 0.5]))


class Grammar:
    """The composed transducer over texts."""

    def __init__(self, insults: dict[str, float]):
        self.arcs = compose()
        self.words: dict[str, tuple[int, float]] = {}
        for kind, listed in WORDS.items():
            self.words |= {w: (kind, GENERAL if kind == INSULT else 0.0) for w in listed.split()}
        self.words |= {w: (INSULT, v) for w, v in insults.items() if not w.endswith("*")}
        self.stems = {w[:-1]: v for w, v in insults.items() if w.endswith("*")}
        self.sizes = sorted({len(s) for s in self.stems})
        # Only insults and verbs of harm open a clause.
        self.seek = ahocorasick.Automaton()
        for w in {w for w, (kind, _) in self.words.items() if kind in (INSULT, HARM)} | set(self.stems):
            self.seek.add_word(w, len(w))
        self.seek.make_automaton()
        self.known: dict[str, tuple[int, float]] = {}

    def read(self, word: str) -> tuple[int, float]:
        """The class of a lower-case word, and its weight as an insult: the heaviest way through the lower layer."""
        if word == ",":
            return COMMA, 0.0
        kind, weight = self.words.get(word, (OTHER, 0.0))
        if kind in (OTHER, INSULT):
            for n in self.sizes:
                if n < len(word) and self.stems.get(word[:n], 0.0) > weight:
                    kind, weight = INSULT, self.stems[word[:n]]
        return kind, weight

    def clause(self, text: str, start: int, end: int) -> float:
        """The weight of a clause's path."""
        state, total, last = 0, 0.0, 0.0
        for m in SINGLE_WORD.finditer(text, start, end):
            word = m.group()
            found = self.known.get(word)
            if found is None:
                found = self.read(word.replace("’", "'"))
                if len(self.known) < KNOWN and len(word) <= LONGEST:
                    self.known[word] = found
            state, insult, again, threat = self.arcs[state][found[0]]
            total += insult * found[1] + again * last + threat * THREAT
            if insult:
                last = found[1]
        return total

    def figures(self, text: str) -> tuple[float, float, float]:
        """Of a text: its heaviest clause, the sum over clauses, and how many clauses weigh anything, the last two as logarithms."""
        text = text.lower()
        heaviest, total, n, done = 0.0, 0.0, 0, -1
        for last, size in self.seek.iter(text):
            at = last - size + 1
            if at <= done or (at and (text[at - 1].isalnum())):
                continue
            ends = CLAUSE_END.search(text, last + 1)
            end = ends.start() if ends else len(text)
            start = max(text.rfind(c, max(done, 0), at) for c in ".!?;:\n") + 1
            weight = self.clause(text, max(start, done + 1), end)
            done = end
            if weight > 0:
                heaviest, total, n = max(heaviest, weight), total + weight, n + 1
        return heaviest, float(np.log1p(total)), float(np.log1p(n))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _entries(text: str) -> Iterator[set[str]]:
    """The distinct words and stems of a text, in parts of about ``PASSAGE``."""
    found: set[str] = set()
    for m in SINGLE_WORD.finditer(text.lower()):
        word = m.group().replace("’", "'")
        if word != "," and len(word) <= LONGEST:
            found.add(word)
            found.update(word[:n] + "*" for n in STEMS if n < len(word))
            if len(found) >= PASSAGE:
                yield found
                found = set()
    if found:
        yield found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic, n): in how many texts of the batch each entry stands."""
    for batch in batches:
        counts: dict[tuple[str, int], int] = {}
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            for part in _entries(text.as_py() or ""):
                for entry in part:
                    counts[entry, toxic] = counts.get((entry, toxic), 0) + 1
                if len(counts) > 2 * PASSAGE:
                    yield _count_rows(counts)
                    counts = {}
        if counts:
            yield _count_rows(counts)


def _count_rows(counts: dict[tuple[str, int], int]) -> pa.RecordBatch:
    entries, toxic = zip(*counts, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(entries), pa.array(toxic, pa.int32()), pa.array(list(counts.values()), pa.int64())], ["entry", "toxic", "n"])


def certain(counts: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(entry, a, weight, certainty) of entries (entry, a, b: texts that have it) that toxic texts have more often than clean ones beyond doubt."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = toxic / (toxic + clean)

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / ((a + b) * expected))).otherwise(0.0)

    weight = F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (clean + 1.0))
    return counts.select("entry", "a", weight.alias("weight"), (2 * (part(a, share) + part(b, 1 - share))).alias("certainty")).filter(
        (F.col("weight") >= MIN_WEIGHT) & (F.col("certainty") >= CERTAIN)
    )


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(h, toxic, text) of the labelled rows to learn from; rows without id or label, and ids with both labels, are left out."""
    ids = (
        labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("toxic"))
        .filter(F.col("_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most")
        .withColumn("h", F.xxhash64("_id", F.lit(SAMPLE_SEED)))
    )
    some = [ids.filter(F.col("toxic") == k).orderBy("h").limit(SAMPLE[k]).select("_id", "toxic", "h") for k in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # at most 24,000 rows of three whole numbers
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(chosen, "_id").select("h", "toxic", "text")


def _placed(entries: set[str]):
    """(entry, place) for each of the entries in a text; a place is the words before and behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                rows: set[tuple[str, int]] = set()
                before = word = ""
                for m in itertools.chain(SINGLE_WORD.finditer((text.as_py() or "").lower()), [None]):
                    behind = m.group() if m else ""
                    for entry in (word, *(word[:n] + "*" for n in STEMS if n < len(word))):
                        if entry in entries:
                            rows.add((entry, zlib.crc32(f"{before} {behind}".encode())))
                    before, word = word, behind
                    if len(rows) >= PASSAGE or (m is None and rows):
                        names, places = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(places, pa.int64())], ["entry", "place"])
                        rows = set()

    return released(run)


def _figured(insults: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults)
        for batch in batches:
            figures = [grammar.figures(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), pa.array(figures, pa.list_(pa.float64()))], ["h", "toxic", "figures"])

    return released(run)


def calibrated(figures: np.ndarray, toxic: np.ndarray, insults: dict[str, float]) -> Model:
    """A logistic function of the figures by gradient ascent with decay. Weights never fall below zero."""
    top = np.maximum(figures.max(axis=0), 1e-9)
    x = np.hstack([figures / top, np.ones((len(figures), 1))])
    theta, m, v = np.zeros(x.shape[1]), 0, 0
    for step in range(1, ROUNDS + 1):
        grad = x.T @ (toxic - _logistic(x @ theta)) / len(x) - DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)
    return Model(insults, float(theta[-1]), theta[:-1] / top)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from labelled rows that are not held out; without rows of both labels the grammar with its general insults alone."""
    texts = stored(sample(docs, labels, id_col, text_col, label_col))
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Model({})
    counts = texts.select("toxic", "text").mapInArrow(released(_counted), "entry string, toxic int, n bigint").groupBy("entry").agg(
        *[F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(name) for k, name in ((1, "a"), (0, "b"))]
    )
    likely = certain(counts, n[1], n[0]).orderBy(F.desc("certainty"), "entry").limit(MAX_INSULTS).collect()
    found = texts.filter("toxic = 1").mapInArrow(_placed({r["entry"] for r in likely}), "entry string, place bigint")
    places = {r["entry"]: r["n"] for r in found.groupBy("entry").agg(F.countDistinct("place").alias("n")).collect()}  # MAX_INSULTS rows
    insults = {r["entry"]: r["weight"] for r in likely if places.get(r["entry"], 0) >= VARIED * r["a"]}
    rows = texts.mapInArrow(_figured(insults), "h bigint, toxic int, figures array<double>").collect()  # three numbers a sampled document
    rows = sorted((r["h"], r["toxic"], tuple(r["figures"])) for r in rows)
    return calibrated(np.array([f for *_, f in rows]), np.array([t for _, t, _ in rows]), insults)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.insults)
        for batch in batches:
            figures = np.array([grammar.figures(t.as_py() or "") for t in batch.column("text")]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_logistic(figures @ model.weights + model.bias))], ["doc_id", "score"])

    return released(run)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts have the score of a text without any clause. A null id is held_out = null. Repeated rows get equal
    scores; an empty table gives an empty result; other columns are not read. Texts are read whole, a clause at a time.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scores(model), "doc_id bigint, score double").select(
        F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )
