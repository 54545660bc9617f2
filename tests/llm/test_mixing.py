"""Apportionment and the mix against plain versions."""

import heapq
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from parcelflow.llm import mixing


def plain_seats(weights, seats):
    heap = [(-Fraction(w), k, 1) for k, w in weights.items() if w > 0]
    heapq.heapify(heap)
    won = defaultdict(int)
    for _ in range(seats if heap else 0):
        _, k, n = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-Fraction(weights[k], 2 * n + 1), k, n + 1))
    return {k: won[k] for k in weights}


@pytest.mark.parametrize("weights,seats", [
    ({1: 53, 2: 24, 3: 23}, 7), ({1: 1, 2: 1, 3: 1}, 2), ({1: 1000, 2: 1, 3: 0}, 50), ({k: k * k for k in range(1, 40)}, 123), ({1: 5}, 0),
    ({1: 0, 2: 0}, 0),
])
def test_apportion(llm, weights, seats):
    df = llm.createDataFrame([("g", k, w, seats) for k, w in weights.items()], "g string, k bigint, w bigint, seats bigint")
    got = {r.k: r.out for r in mixing.apportion(df, ["g"], "k", "w", "seats", "out").collect()}
    assert got == plain_seats(weights, seats)


def plain_targets(sizes):
    """By sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(k % 3 + 1) for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {s: float(share[s]) if s in share else float(3 * sizes[s]) for s in order}
        full |= over


@pytest.mark.parametrize("table", ["docs", "odd_docs", "no_docs"])
def test_mix(table, request):
    df = request.getfixturevalue(table)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = df.select("doc_id", "source", "text").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
    want = plain_targets(sizes)
    out = mixing.mix(df).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in out) == sorted((str(r.doc_id), size(r.text)) for r in rows)
    taken = defaultdict(int)
    for r in out:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    wanted, sources = defaultdict(float), defaultdict(int)
    for s, t in want.items():
        wanted[sizes[s], round(t, 6)] += t
        sources[sizes[s], round(t, 6)] += 1
    assert {*taken} == {*wanted}
    assert all(abs(taken[k] - wanted[k]) <= sources[k] for k in wanted), "within a word a source"
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(df.repartition(3)).collect()))


def test_shards_stay_near_the_target(docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs).collect():
        taken[r.source_size, r.target] += r.taken
        target[r.source_size, r.target] = r.target
    assert all(abs(taken[k] - target[k]) <= 1 for k in target)


@pytest.mark.parametrize("sizes", [
    [5000, 40, 70], [33] * 200, [1 + 37 * k % 100 for k in range(200)], [1, 1, 1, 2], [32, 31, 33, 64, 65, 1], [100_000, 1],
])
def test_many_small_sources(llm, sizes):
    """Every source comes within a word of its target, and all words of the mix are there."""
    rows = [(1000 * k + i, f"s{k:04d}", " ".join(["w"] * n)) for k, size in enumerate(sizes) for i, n in enumerate(([7] * (size // 7)) + [size % 7])]
    out = mixing.mix(llm.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()
    want = plain_targets({f"s{k:04d}": size for k, size in enumerate(sizes)})
    taken = defaultdict(int)
    for r in out:
        taken[f"s{r.doc_id // 1000:04d}"] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    if max(sizes) < 7000:
        assert all(abs(taken[s] - t) <= 1 for s, t in want.items())
        assert abs(sum(taken.values()) - sum(sizes)) <= 1


def test_rows_without_an_id_are_spread_over_shards(llm, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 100)
    docs = llm.createDataFrame([(None, "s", f"a b c d {k}") for k in range(200)], "doc_id bigint, source string, text string")
    rows = mixing.stored(mixing._sized(docs, "doc_id", "text", "source"))
    assert mixing.plan(rows)[1].count() == 10


@pytest.mark.parametrize("table", ["docs", "odd_docs", "no_docs"])
def test_mixed_rows_hold_what_is_taken(table, request):
    df = request.getfixturevalue(table)
    taken = defaultdict(int)
    for r in mixing.mix(df).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed(df)
    assert out.columns == df.columns
    held = defaultdict(int)
    texts = defaultdict(set)
    for r in df.collect():
        texts[r.doc_id].add(r.text)
    for r in out.collect():
        held[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.text in texts[r.doc_id] or (r.n_chars == len(r.text) and {*r.text.split()} <= {w for t in texts[r.doc_id] for w in (t or "").split()})
    assert held == {k: v for k, v in taken.items() if v}


def test_no_python_in_the_plan(docs):
    for df in (mixing.mix(docs), mixing.mixed(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
