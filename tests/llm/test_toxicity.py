"""The toxicity grammar: clauses, an independent walk, learned insults, held-out rows, odd texts."""

import math
import re

import pytest

from parcelflow.llm import toxicity
from parcelflow.llm.common import table

G = toxicity.Grammar({"grumb*": 5.0, "plonk": 7.0})


def test_clauses_weigh_more_than_words():
    weight = lambda text: G.figures(text)[0]
    assert weight("You are an idiot.") == 6 == weight("Idiot, you left") + 2 and weight("Idiot you are") == 6
    assert weight("the idiot left") == 4 and weight("you grumbly thing") == 7.5
    assert math.isclose(weight("You are not an idiot"), 0.6) and weight("not you, idiot") == 6
    assert math.isclose(weight("He said that you are an idiot"), 2.4) and weight("He said so. You are an idiot") == 6
    assert weight("I will kill you") == 6 and weight("They will kill the lights") == 0 and weight("kill you") == 0
    assert math.isclose(weight("I will not kill you"), 0.6)
    assert weight("grumb") == 0 and weight("plonks") == 0 and weight("xplonk") == 0 and weight("PLONK") == 7
    assert weight("") == 0 == weight("a quiet day")


def plain_clause(words):
    """A clause's weight from the distances between its words, without states."""
    total = 0.0
    kinds = [G.read(w) for w in words]
    R = toxicity.REACH
    comma = lambda a, b: any(k == toxicity.COMMA for k, _ in kinds[a:b])
    for i, (kind, weight) in enumerate(kinds):
        negated = any(kinds[j][0] == toxicity.NEGATION and not comma(j, i) for j in range(max(0, i - R), i))
        reported = any(k == toxicity.REPORT for k, _ in kinds[:i])
        soft = (toxicity.NEGATED if negated else 1) * (toxicity.REPORTED if reported else 1)
        if kind == toxicity.INSULT:
            near = any(kinds[j][0] == toxicity.TARGET for j in range(max(0, i - R), i))
            total += soft * weight * (toxicity.TARGETED if near else 1)
    return total


def test_walk_equals_plain_distances():
    import random

    rng = random.Random(3)
    vocabulary = ["plonk", "grumbler", "not", "said", ",", "tree", "house", "your", "walks", "never"]
    for _ in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 14))]
        text = " ".join(words)
        # A target behind an insult adds to it; this part is left to the test above.
        if any(a in ("plonk", "grumbler") and "your" in words[i + 1 : i + 1 + toxicity.REACH] for i, a in enumerate(words)):
            continue
        assert math.isclose(G.clause(text, 0, len(text)), plain_clause(words), abs_tol=1e-9), text


def test_every_clause_with_an_insult_is_walked_once():
    text = "plonk. nothing here; you plonk\nplonk, plonk! xplonk grumbling? " * 50
    clauses = [c for c in re.split(r"[.!?;:\n]", text) if G.clause(c.lower(), 0, len(c)) > 0]
    heaviest, total, n = G.figures(text)
    assert math.isclose(math.expm1(n), len(clauses)) and math.isclose(math.expm1(total), sum(G.clause(c, 0, len(c)) for c in clauses))


def test_long_texts():
    assert G.figures("word " * 2_000_000 + "plonk")[0] == 7
    assert G.figures("plonk " * 300_000)[1] == pytest.approx(math.log1p(7 * 300_000))


def test_odd_documents(llm, odd_docs, no_docs):
    model = toxicity.fit(no_docs, llm.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert model.insults == {} and toxicity.scored(no_docs, model).count() == 0
    rows = toxicity.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[4].score == by_id[5].score == by_id[8].score and by_id[None].held_out is None


def test_copies_teach_nothing(llm):
    """A toxic text with a thousand copies does not make its own words insults; words in ever other places are."""
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abdefgiklmnoprstu") for _ in range(7))
    common = [word() for _ in range(60)]
    say = lambda n: [rng.choice(common) for _ in range(n)]
    copied = " ".join(say(20) + ["zzcopied"] + say(20))
    rows = [(i, copied, 1) for i in range(0, 300)] + [(i, " ".join([*say(15), "wyrm", *say(15)]), 1) for i in range(300, 600)]
    rows += [(i, " ".join(say(30)), 0) for i in range(600, 1200)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert "wyrm" in model.insults and not any(k.startswith("zzco") for k in model.insults)


def test_held_out_accuracy(llm):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(llm, sf_dir, "documents"), table(llm, sf_dir, "labels")
    rows = toxicity.scored(docs, toxicity.fit(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert len(rows) > 500 and sum(r.predicted for r in toxic) / len(toxic) > 0.85 and sum(r.predicted for r in clean) / len(clean) < 0.01
