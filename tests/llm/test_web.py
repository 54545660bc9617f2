"""URL rules, archives and embeddings against plain versions."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from parcelflow.llm import tiles, urlfilter, warc
from parcelflow.llm.shared import Target
from parcelflow.session import workdir
from test_dedup import plain_roots

URLS = [
    "http://example.net/en/1?x=/fr/", "https://A.Example.NET/de/2", "http://notexample.net", "http://example.net/en", "net/", None, "", "no scheme",
    "ftp://org/fr/x", "http://sub.org/FR/", "http://a.example.com/de/#b", "http://example.com?de/", "x://y://net/z", "http://org.net:80/fr/", "http:///fr/",
    "http://b.c.org/fr/ü", "http://net//", "http://.net/",
]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


@pytest.mark.parametrize("blocks", [1, urlfilter.MAX_BLOCKS])
def test_url_rules(llm, blocks):
    rng = random.Random(7)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    rules += [(f"h{rng.randrange(60)}.com", f"/{'ab'[k % 2] * (k % 5)}", rng.choice(["allow", "block"])) for k in range(200)]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = URLS + [f"http://{rng.choice(['', 'www.'])}h{rng.randrange(80)}.com/{rng.choice('ab') * rng.randrange(7)}" for _ in range(400)]
    rows = [(k if k % 50 else None, u, "x") for k, u in enumerate(urls)] + [(1, urls[1], "x")] * 2
    pages = llm.createDataFrame(rows, "page_id bigint, url string, hits string")
    ruled = llm.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block"), ("com", "/", None)], urlfilter.RULE_SCHEMA)
    got = urlfilter.judge(pages, ruled, max_blocks=blocks).collect()
    want = [(i, *plain_verdict(u, rules)) for i, u, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_no_rules_and_no_pages(llm):
    pages = llm.createDataFrame([(1, "http://a/b")], "page_id bigint, url string")
    none = llm.createDataFrame([], urlfilter.RULE_SCHEMA)
    assert [tuple(r) for r in urlfilter.judge(pages, none).collect()] == [(1, "a", "/b", None, "allow")]
    some = llm.createDataFrame([("a", "/", "block")], urlfilter.RULE_SCHEMA)
    assert urlfilter.judge(pages.limit(0), some).count() == 0
    assert [tuple(r) for r in urlfilter.judge(pages, some, "block").collect()] == [(1, "a", "/b", "a/", "block")]


def test_filter_passes_every_listed_key(llm):
    keys = [f"host{k}.org/{k % 7}" for k in range(5000)]
    found = urlfilter.bloom(llm.createDataFrame([(k,) for k in keys], "key string"))
    assert all(k in found for k in keys)
    assert sum(f"other{k}.org/" in found for k in range(5000)) < 250


BIG = "".join(random.Random(8).choices("abcdefgh <>", k=3_000_000))
PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "http://b\r\nWARC-Type: x", "é漢😀"), (5, "u", None), (6, "u", ""),
    (7, "u", BIG), (8, "u", "WARC/1.1\r\n\r\n\x1f\u008b\x08 not a record"), (None, "u", "same"), (None, "u", "nameless"), (None, "v", "nameless"),
    (9, "u", "twice"), (9, "u", "twice"), (10, "u", BIG + "x"),
]


def plain_records(rows, least=0):
    last = {}
    for i, _, body in rows:
        if i is not None:
            last[body or ""] = max(i, last.get(body or "", i))
    out = []
    for i, _, body in rows:
        data, top = (body or "").encode(), last.get(body or "")
        again = len(data) >= least and top is not None and i != top
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("least,split,file_bytes", [(0, 1 << 22, 1 << 26), (5, 4096, 1000), (0, 97, 1 << 26)])
def test_warc_round_trip(llm, least, split, file_bytes):
    rows = PAGES if split > 1000 else [(i, u, b and b[:40_000]) for i, u, b in PAGES]
    pages = llm.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as size", "2 as last")
    files = warc.write(warc.with_revisits(pages, min_bytes=least), workdir(llm, "test-warc"), file_bytes)
    got = warc.read(files, split, with_payload=True).collect()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == plain_records(rows, least)
    bodies = {i: b or "" for i, _, b in rows}
    assert all(r.payload.decode() == bodies[r.page_id] for r in got if r.record_type == "response" and r.page_id)
    assert {r.target_uri for r in got if r.page_id == 4} == {"http://b%0D%0AWARC-Type:%20x".replace("%20", "%20")}


def test_one_reading_task_for_each_split(llm):
    """Adaptive execution leaves the splits apart, although their rows are few bytes."""
    assert llm.conf.get("spark.sql.adaptive.enabled") == "true"
    pages = llm.range(200).selectExpr("id AS page_id", "'u' AS url", "sha2(cast(id as string), 512) || sha2(cast(id + 7 as string), 512) AS html")
    files = warc.write(warc.with_revisits(pages), workdir(llm, "test-warc"))
    size = files.agg({"bytes": "sum"}).first()[0]
    split = size // 12
    found = warc.read(files, split).selectExpr("page_id", "spark_partition_id() AS task").collect()
    assert sorted(r.page_id for r in found) == list(range(200)) and len({r.task for r in found}) >= 12


def test_copies_of_a_payload_lie_in_many_tasks(llm):
    pages = llm.range(4000).selectExpr("id AS page_id", "'u' AS url", "'the same' AS html")
    rows = warc.with_revisits(pages.repartition(8)).selectExpr("spark_partition_id() AS task", "revisit").collect()
    assert sum(not r.revisit for r in rows) == 1 and len(rows) == 4000
    plan = warc.with_revisits(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("payload") >= 1


def test_no_pages(llm):
    assert warc.round_trip(llm.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_a_record_with_a_very_long_head_is_found_in_any_split(tmp_path):
    url = "http://a/" + "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz0123456789", k=3_000_000))
    records = [warc.record(k, u, b"body", "D", 4, None, False) for k, u in enumerate(["u", url, "v"])]
    name = str(tmp_path / "a.warc.gz")
    target = Target(name)
    target.write(b"".join(records))
    target.close()
    source, size, second = warc.Bytes(name), sum(map(len, records)), len(records[0])
    for cuts in ((0, second, size), (0, second - 1, second + 1, size), (0, size)):
        found = [(at, warc.parsed(d)[:3:2]) for a, b in zip(cuts, cuts[1:]) for at, d in warc.members(source, a, b)]
        assert found == [(0, (0, "u")), (second, (1, url)), (second + len(records[1]), (2, "v"))]


def test_damaged_records_are_told(tmp_path):
    members = [warc.record(k, "u", f"body {k}".encode() * 50, "D", 1, None, False) for k in range(6)]
    broken = members[2][:-20] + b"\0" * 12 + members[2][-8:]
    data = b"junk\x1f\x8b\x08junk" + b"".join([*members[:2], broken, *members[3:5], members[5][:30]])
    name = str(tmp_path / "a.warc.gz")
    target = Target(name)
    target.write(data)
    target.close()
    for step in (len(data), 64, 7):
        found = [(at, d) for s in range(0, len(data), step) for at, d in warc.members(warc.Bytes(name), s, min(s + step, len(data)))]
        whole = [warc.parsed(d)[0] for _, d in found if d is not None]
        assert whole == [0, 1, 3, 4]
    assert zlib.decompress(members[0], 31).startswith(b"WARC/1.1\r\n")


def test_embeddings(llm):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 16))
    rows = []
    for k in range(500):
        v = centres[k % 12] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35])
        rows.append((k, [float(x) for x in v], [0, 1, None][k % 3] if k % 7 else 0))
    rows += [(500 + k, rows[3][1], 0) for k in range(40)]  # copies
    rows += [(600, None, 0), (601, [0.0] * 16, 0), (602, [float("nan")] * 16, 0), (603, [None] * 16, 0), (604, [], 0), (605, [1e30] * 16, 0), (606, [2e30] * 16, 0)]
    rows += [(607, [1.0, 2.0], 0), (608, [2.0, 4.0], 0), (609, [float("inf")] * 16, 0), (None, rows[3][1], 0)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 as n", "2 as size", "'x' as tile")
    ok = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    fit = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows if i is not None and lab is not None and ok(v)]
    edges = [
        (a[0], b[0]) for x, a in enumerate(fit) for b in fit[:x]
        if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt(a[1] @ a[1]) / np.sqrt(b[1] @ b[1]) >= tiles.THRESHOLD
    ]
    root = plain_roots([r[0] for r in rows if r[0] is not None], edges)
    n = defaultdict(int)
    for a, b in edges:
        n[a] += 1
        n[b] += 1
    want = sorted(repr((i, n[i], root.get(i), i is not None and root[i] == i)) for i, *_ in rows)
    for tile in (16, 10_000):
        assert sorted(repr(tuple(r)) for r in tiles.near_dedup(df, tile=tile).collect()) == want
    assert tiles.near_dedup(df.limit(0)).count() == 0


def test_vectors_that_repeat_an_id(llm):
    """Each row has the links of its own vector, whatever other vectors have its id."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, -0.01], 0), (1, [0.0, 1.0], 1), (4, [0.0, 1.0], 1), (5, [0.0, 2.0], 0)]
    df = llm.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    for tile in (1, 2, 100):
        got = sorted(map(tuple, tiles.near_dedup(df, tile=tile).collect()))
        assert got == sorted([(1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (3, 2, 1, False), (1, 1, 1, True), (4, 1, 1, False), (5, 1, 1, False)])


def test_strips_give_the_same_links(monkeypatch):
    rng = np.random.default_rng(12)
    v = rng.normal(size=(4, 8))[rng.integers(0, 4, 90)] + rng.normal(size=(90, 8)) * 0.2
    q, b = tiles.quantise(tiles.unit(v))
    tile = tiles.Tile({"dim": 8, "ids": np.arange(90).tobytes(), "sizes": np.ones(90, np.int64).tobytes(), "q": q.tobytes(), "bounds": b.tobytes(), "vectors": v.tobytes()})
    want = tiles.unit(v) @ tiles.unit(v).T >= 0.93
    np.fill_diagonal(want, False)
    for strip in (1, 7, 256):
        monkeypatch.setattr(tiles, "STRIP", strip)
        links = tiles.Links(tile, tile, 0.93, True)
        assert (np.concatenate([found for _, found in links]) == want).all()


def test_bounds_hold():
    rng = np.random.default_rng(10)
    u = tiles.unit(rng.normal(size=(200, 64)) * rng.lognormal(size=(200, 1)))
    q, b = tiles.quantise(u)
    near = (q.astype(int) @ q.T.astype(int)) * b[:, 0][:, None] * b[:, 0]
    slack = b[:, 2][:, None] * b[:, 1] + b[:, 1][:, None] * b[:, 2] + b[:, 2][:, None] * b[:, 2] + tiles.SLACK
    assert (np.abs(near - u @ u.T) <= slack).all() and slack.max() < 0.05


def test_only_pairs_near_the_threshold_are_computed_again():
    rng = np.random.default_rng(11)
    v = np.concatenate([rng.normal(size=(300, 64)), np.ones((100, 64)) + rng.normal(size=(100, 64)) * 0.01])
    q, b = tiles.quantise(tiles.unit(v))
    row = {"dim": 64, "ids": np.arange(400).tobytes(), "sizes": np.ones(400, np.int64).tobytes(), "q": q.tobytes(), "bounds": b.tobytes(), "vectors": v.tobytes()}
    links, again = tiles.linked(tiles.Tile(row), tiles.Tile(row), 0.93)
    assert links[300:, 300:].all() and again == 0
