"""Exact and near dedup against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from parcelflow.llm import cuckoo, simhash
from parcelflow.llm.components import components, forest
from pyspark.sql import functions as F

ALL = ["docs", "odd_docs", "no_docs"]


def plain_roots(nodes, edges):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("table", ALL)
def test_exact_dedup(table, request):
    df = request.getfixturevalue(table)
    groups = defaultdict(list)
    rows = [(r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in df.collect()]
    for i, d in rows:
        groups[d].append(i)
    keep = {d: min((i for i in ids if i is not None), default=None) for d, ids in groups.items()}
    want = sorted(repr((i, keep[d], len(groups[d]), i == keep[d], d)) for i, d in rows)
    got = cuckoo.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(repr(tuple(r)) for r in got) == want


def test_drop_copies_keeps_columns_and_one_row(odd_docs, no_docs):
    left = cuckoo.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r.doc_id for r in left.collect()]
    # 2, 3 and the row without id repeat 1; 5 and 4 are both empty; 6 and 7 are one space; 12 is given twice.
    assert sorted(ids, key=str) == sorted([1, 4, 6, 8, 9, 10, 11, 12, 13, None, 14, 15, 16], key=str)
    assert cuckoo.drop_copies(no_docs).count() == 0


def test_stages_take_any_column_names(llm):
    names = ["__keep", "__head", "__digest", "__text_digest", "key", "row", "head", "mark", "own", "root", "text_sha256", "component_id", "a.b"]
    rows = [(i, t, *[str(i)] * len(names)) for i, t in [(1, "a b c d"), (2, "a b  c d"), (3, "other words are here"), (None, "a b c d"), (3, "other words are here")]]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    for drop in (cuckoo.drop_copies, simhash.drop_near_copies):
        left = drop(docs)
        assert left.columns == docs.columns and sorted((r.doc_id, r["a.b"]) for r in left.collect()) == [(1, "1"), (3, "3")]


def test_texts_are_shuffled_once(llm, docs):
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cuckoo.drop_copies(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        llm.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    assert len(exchanges) == 2, "the marked rows once, and the keys that stay"


def test_filter_never_misses_and_deletes():
    rng = random.Random(3)
    bucket = cuckoo.Bucket(1)
    live = {}
    for _ in range(4000):
        digest = hashlib.sha256(str(rng.randrange(1500)).encode()).digest()
        if rng.random() < 0.4:
            bucket.delete(digest)
            live.pop(digest, None)
        else:
            bucket.add(digest, rng.randrange(100), 1)
            live[digest] = live.get(digest, 0) + 1
        assert bucket.live(digest) == (digest in live)
    assert {d: n for d, (_, n) in bucket.keys.items()} == live
    assert bucket.filter.mask > 0, "the filter has grown from its one bucket"
    gone = cuckoo.CuckooFilter.load(bucket.filter.dump())
    assert all(gone.contains(bucket._hash(d)) for d in live)


def test_equal_fingerprints_overflow_and_are_rebuilt():
    bucket = cuckoo.Bucket(2)
    # Equal last eight bytes: one fingerprint in one pair of places, more than eight times.
    digests = [bytes([i]) * 24 + b"\x01" * 8 for i in range(8)]
    for d in digests:
        bucket.add(d, 1, 1)
    assert all(bucket.live(d) for d in digests)
    assert not bucket.live(bytes(24) + b"\x02" * 8)


def test_index_changes_in_batches(llm):
    def frame(names):
        rows = [(bytearray(hashlib.sha256(n.encode()).digest()), i, 1) for i, n in enumerate(names)]
        return llm.createDataFrame(rows, "digest binary, keep_id bigint, n bigint")

    index = cuckoo.change(None, 4, add=frame("abcda"))
    index = cuckoo.change(index, 4, add=frame("ax"), delete=frame("bz").select("digest"))
    names = {hashlib.sha256(n.encode()).digest(): n for n in "abcdxz"}
    live = {names[bytes(r.digest)]: (r.keep_id, r.n) for r in cuckoo.keys(index).collect()}
    assert live == {"a": (0, 3), "c": (2, 1), "d": (3, 1), "x": (1, 1)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def test_segments_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(random.Random(1).choices(["aa", "Bb", "c", "dddd", "ß"], k=900))
    want = plain_fingerprint(text)
    for size in (1, 7, 50, 10_000):
        monkeypatch.setattr(simhash, "SEGMENT", size)
        assert simhash.fingerprint(text.encode()) == want
        assert simhash.fingerprint(b"  one\n") == plain_fingerprint("one")


@pytest.mark.parametrize("table", ALL)
def test_near_dedup(table, request):
    df = request.getfixturevalue(table)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in df.collect()]
    marks = sorted({m for _, m in rows})
    edges = [(a, b) for i, a in enumerate(marks) for b in marks[:i] if (a ^ b).bit_count() <= 3]
    root = plain_roots(marks, edges)
    least = {}
    for i, m in rows:
        if i is not None:
            least[root[m]] = min(i, least.get(root[m], i))
    want = sorted(repr((i, f"{m:016x}", least.get(root[m]))) for i, m in rows)
    got = simhash.near_dedup(df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(repr(tuple(r)) for r in got) == want


def test_no_link_is_lost(llm):
    rng = random.Random(5)
    marks = set()
    for _ in range(60):
        m = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):  # chains and clouds around a point, 1 to 5 flips apart
            marks.add(m)
            m ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6)))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    df = llm.createDataFrame([(m,) for m in signed], "mark bigint")
    got = {r.node: r.root for r in components(simhash.links(df)).collect()}
    edges = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    want = plain_roots(signed, edges)
    assert edges and {m: got.get(m, m) for m in signed} == want


def test_a_dense_group_gives_few_links(llm):
    marks = [sum(1 << b for b in range(12) if k >> b & 1) for k in range(4096)]  # all within 12 bits
    links = simhash.links(llm.createDataFrame([(m,) for m in marks], "mark bigint"))
    assert links.count() < 20 * len(marks)
    assert components(links).agg(F.countDistinct("root")).first()[0] == 1


def test_drop_near_copies(llm, odd_docs, no_docs):
    left = simhash.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert len(ids) == len({*ids}) and ids.count(None) == 1 and {1, 4, 8, 9, 10, 12} <= {*ids} and not {2, 3, 5, 6, 7} & {*ids}
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_an_id_that_two_components_share_stands_for_both(llm):
    a, b, c = ("the old house by the river was sold", "BUY NOW cheap watches and pills here", "a third text about trees and gardens of spring")
    rows = [(1, a, "x"), (1, b, "y"), (1, b, "y"), (2, a, "z"), (3, b, "z"), (4, c, "v"), (5, c, "w"), (5, "not at all like it, this one stands alone", "u"), (None, a, "n")]
    left = simhash.drop_near_copies(llm.createDataFrame(rows, "doc_id bigint, text string, note string"))
    assert sorted(map(tuple, left.collect())) == sorted({rows[0], rows[1], rows[5], rows[7]})
    one = simhash.drop_near_copies(llm.createDataFrame([(4, c, "v"), (3, a, "a"), (4, a, "b")], "doc_id bigint, text string, note string"))
    assert sorted(map(tuple, one.collect())) == [(3, a, "a"), (4, c, "v")]


def test_components_of_odd_tables(llm):
    frame = lambda rows: llm.createDataFrame(rows, "u bigint, v bigint")
    assert components(frame([])).count() == 0
    chain = [(i, i + 1) for i in range(200)] + [(None, 3), (5, 5), (7, 6), (7, 6), (900, 901)]
    got = {r.node: r.root for r in components(frame(chain)).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_forest_of_one_task():
    a, b = np.array([5, 4, 9, 2]), np.array([4, 3, 8, 2])
    nodes, roots = forest(a, b)
    assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == {4: 3, 5: 3, 9: 8}
