"""Line quality, licences, tokens and token files against plain versions, libraries and round trips."""

import functools
import hashlib
import itertools
import pickle
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from parcelflow.llm import bpe, crf, licenses, tokenfile
from parcelflow.session import workdir

ALL = ["docs", "odd_docs", "no_docs"]
RANKS = bpe.default_ranks()


@pytest.fixture(scope="module")
def model(llm, docs):
    return crf.fit(docs, llm.read.parquet("/root/testdata/sf0.001/labels.parquet"))


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(2)
    per_text = np.array([3, 1, 4])
    good, between, start = rng.normal(size=8), rng.normal(size=(2, 2)), rng.normal(size=2)
    got, pairs, *_ = crf.marginals(good, per_text, between, start, np.ones(3))
    at, want_pairs = 0, np.zeros((2, 2))
    for n in per_text:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        score = [start[p[0]] + sum((y - 0.5) * g for y, g in zip(p, good[at : at + n], strict=True)) + sum(between[a, b] for a, b in itertools.pairwise(p)) for p in paths]
        weight = np.exp(score) / np.exp(score).sum()
        for t in range(n):
            assert got[at + t] == pytest.approx(sum(w for w, p in zip(weight, paths, strict=True) if p[t]))
        for w, p in zip(weight, paths, strict=True):
            for a, b in itertools.pairwise(p):
                want_pairs[a, b] += w
        at += n
    assert pairs == pytest.approx(want_pairs)


def test_figures_do_not_depend_on_the_cut(monkeypatch):
    texts = [b"", b"\n", b"a b\nC d!", "été | x\n\n".encode(), b"x" * 300, b"a a b\na a b\n"]

    def whole():
        return [np.concatenate(parts) for parts in zip(*crf.line_runs(texts), strict=True)]

    want = whole()
    assert np.flatnonzero(want[2]).tolist() == [0, 1, 3, 5, 8, 9] and want[1].tolist() == [0, 0, 0, 3, 4, 9, 0, 0, 300, 5, 5, 0]
    assert want[0][:, 14].tolist() == [0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 1, 0], "lines that came before in their text"
    monkeypatch.setattr(crf, "LONG_LINE", 3)
    for segment, lines in ((7, 1 << 14), (1 << 20, 2), (3, 1)):
        monkeypatch.setattr(crf, "SEGMENT", segment)
        monkeypatch.setattr(crf, "LINES_AT_A_TIME", lines)
        for a, b in zip(want, whole(), strict=True):
            assert (a == b).all()


def test_scores_equal_all_paths_at_any_cut(model, docs, monkeypatch):
    """The document score against every labelling of its lines, with features taken line by line."""
    texts = [t.text.encode() for t in docs.limit(300).collect()]
    texts = [b"\n".join(t.split(b"\n")[:9]) for t in texts][:60] + [b"", b"\n", b"one line", b"x!!\n\nx!!"]
    k = crf.FIGURES * crf.BINS

    def plain(text):
        figures = np.concatenate([f for f, *_ in crf.line_runs([text])])
        own = [model.own(f[None])[0].astype(float) for f in figures]
        w, n = model.weights, len(figures)
        good = [
            own[t] @ w[:k] + (own[t - 1] @ w[k : 2 * k] if t else 0) + (own[t + 1] @ w[2 * k : 3 * k] if t + 1 < n else 0)
            + (w[-3] if t == 0 else 0) + (w[-2] if t == n - 1 else 0) + w[-1] for t in range(n)
        ]
        paths = list(itertools.product((0, 1), repeat=n))
        score = np.array([
            model.start[p[0]] + sum((y - 0.5) * g for y, g in zip(p, good, strict=True)) + sum(model.between[a, b] for a, b in itertools.pairwise(p)) for p in paths
        ])
        chance = np.exp(score - score.max())
        p_good = chance @ np.array(paths) / chance.sum()
        weight = np.array([len(line) + 1 for line in text.split(b"\n")])
        return weight @ p_good / weight.sum()

    want = [plain(t) for t in texts]
    for lines, block, segment in ((1 << 14, 64, 1 << 20), (4, 3, 200), (1, 1, 1), (3, 2, 50)):
        monkeypatch.setattr(crf, "LINES_AT_A_TIME", lines)
        monkeypatch.setattr(crf, "BLOCK_LINES", block)
        monkeypatch.setattr(crf, "SEGMENT", segment)
        assert crf.score_all(texts, model) == pytest.approx(want, abs=1e-5)


def test_long_texts_in_bounded_memory(model, tmp_path):
    """Two megabytes of line breaks, and one line of twenty, each in a process of its own."""
    (tmp_path / "model").write_bytes(pickle.dumps(model))
    code = (
        "import pickle, resource, sys; from parcelflow.llm import crf; model = pickle.load(open(sys.argv[1], 'rb')); text = eval(sys.argv[2]);"
        "start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; score = crf.score_all([text], model)[0];"
        "assert 0 <= score <= 1; print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) // 1024)"
    )
    for text in ("b'\\n' * 2_000_000", "b'ab cd efg ' * 2_000_000"):
        done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "model"), text], capture_output=True, text=True, check=True)
        assert int(done.stdout) < 500


def test_the_sample_takes_whole_texts_up_to_its_lines(llm, monkeypatch):
    rows = [(i, "\n".join(["Good line, here."] * 10 if i % 2 else ["$$$ ### !!!"] * 10)) for i in range(60)] + [(99, "x\n" * 6000)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    labels = llm.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(crf, "train", lambda figures, per_text, label: seen.append((per_text, label)))
    crf.fit(docs, labels)
    assert {*seen[-1][0]} == {10} and len(seen[-1][0]) > 30
    monkeypatch.setattr(crf, "SAMPLE_LINES", 35)
    crf.fit(docs, labels)
    assert seen[-1][0].tolist() == [10] * 6 and sorted(seen[-1][1].tolist()) == [0, 0, 0, 1, 1, 1]


def test_quality_of_held_out_documents(llm):
    folder = "/root/testdata/sf0.01"
    docs, labels = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = crf.scored(docs, crf.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in out) / len(out)
    assert right > 0.95
    assert all(r.predicted for r in out if r.quality), "good documents are kept"


def test_labels_of_held_out_rows_have_no_effect(llm, docs, model):
    labels = llm.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    other = crf.fit(docs, turned)
    assert (other.weights == model.weights).all() and (other.between == model.between).all()


@pytest.mark.parametrize("table", ALL)
def test_every_row_has_a_score(table, request, model):
    df = request.getfixturevalue(table)
    rows = crf.scored(df, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in df.collect())
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = crf.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in rows)


def test_without_labels(llm, odd_docs):
    model = crf.fit(odd_docs, llm.createDataFrame([(1, 1), (None, 0), (2, None), (3, 1), (3, 0)], "doc_id bigint, quality int"))
    assert model is None
    assert {r.score for r in crf.scored(odd_docs, model).collect()} == {0.5}


def test_license_wordings(llm, odd_docs, no_docs):
    rows = [
        (1, "Words before. Released under the\nMIT License. Words behind."), (2, "This work is licenced under the GNU General Public License version 3"),
        (3, "This work is licensed under the GNU General Public License, version 1."), (4, "Released under the ABC License."),
        (5, "He holds a driving licence and a permission."), (6, licenses.TEMPLATES["Apache-2.0-header"] + " " + licenses.TEMPLATES["MIT-notice"]),
        (7, "x " * 50_000 + licenses.TEMPLATES["CC-BY-NC-4.0-notice"] + " y" * 50_000), (8, None), (1, "Released under the MIT License."),
        (9, licenses.TEMPLATES["MIT-grant"].replace("any person", "anyone").replace("without restriction", "with no restriction").upper()),
    ]
    out = licenses.scan(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted((r.doc_id, r.license, r.changed_words) for r in out)
    assert found == [
        (1, "MIT-notice", 0), (1, "MIT-notice", 0), (2, "GPL-3.0-notice", 1), (6, "Apache-2.0-header", 0), (6, "MIT-notice", 0),
        (7, "CC-BY-NC-4.0-notice", 0), (9, "MIT-grant", 4),
    ]
    texts = [dict(rows[:8])[r.doc_id] for r in out if r.doc_id in (2, 6, 7)]
    assert all(t[r.start : r.end] == r.wording for t, r in zip(texts, [r for r in out if r.doc_id in (2, 6, 7)], strict=True))
    assert next(r.changes for r in out if r.doc_id == 2) == "licensed -> licenced"
    assert [r.doc_id for r in licenses.scan(odd_docs).collect()] == [16]
    assert licenses.scan(no_docs).count() == 0
    with pytest.raises(ValueError, match="anchor"):
        licenses.scan(odd_docs, {"bare": "do what you want"})


FAMILIES = licenses.compiled(tuple(licenses.TEMPLATES.items()))

# Of each wording: a reworded notice that is one, and a text worded like it that is not.
POSITIVE = {
    "MIT-notice": "released under The MIT licence", "Apache-2.0-notice": "Licensed under Apache License, version 2.0",
    "GPL-3.0-notice": "This program is licensed under the GNU General Public License version 3", "CC-BY-NC-4.0-notice": "licensed under CC BY-NC 4.0",
    "CC-BY-4.0-notice": "This text is licensed under a Creative Commons Attribution 4.0 International Licence",
    "GPL-2.0-notice": "This code is licensed under the GNU General Public License, version 2", "BSD-notice": "released under a BSD license",
    "CC-BY-SA-4.0-notice": "This book is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC0-1.0-notice": "To the extent possible under law, Jane Roe has waived all copyright and related or neighboring rights to this text",
}
LOOK_ALIKE = {
    "MIT-notice": "Released under the terms of his parole, with a driving license", "Apache-2.0-notice": "Licensed under the Apache License, Version 1.1",
    "GPL-3.0-notice": "This work is licensed under the general terms of the public library, floor 3", "CC-BY-NC-4.0-notice": "Licensed under CC BY 3.0",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 4", "BSD-notice": "Released under the new license",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivs 4.0 International License",
    "CC0-1.0-notice": "To the extent possible under law, the author has kept all copyright and related rights to this work",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the house", "BSD-grant": "Redistribution of source and binary forms is not permitted",
    "Apache-2.0-header": "you may not use this file except in compliance with the License", "MIT-grant": "Permission is hereby granted to any person to enter the house",
    "ISC-grant": "Permission to use this software for any purpose is hereby refused", "Unlicense": "This is free software in the public domain",
    "BSD-conditions": "Redistributions must retain the above copyright notice", "GPL-3.0-header": "This program is free software: you can redistribute it",
    "GPL-2.0-header": "This program is free software; ask for a license", "LGPL-2.1-header": "This library is free software; see its license",
    "LGPL-3.0-header": "This library is free software: see its license", "AGPL-3.0-header": "The Affero license is a general public license",
}


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_family(name):
    found = lambda text: [f[0] for f in licenses.notices(f"Some words of a text before. {text}. And some words behind it.", FAMILIES)]
    assert found(licenses.TEMPLATES[name]) == [name]
    if name in POSITIVE:
        assert found(POSITIVE[name]) == [name]
    else:
        words = licenses.TEMPLATES[name].split()
        assert found(" ".join([*words[:-4], "here", *words[-3:]])) == [name]
    assert name not in found(LOOK_ALIKE[name])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["released", "under", "the", "mit", "license", "a", "of"]), min_size=1, max_size=14), st.sampled_from(["MIT-notice", "BSD-notice"]))
def test_places_equal_plain_alignment(words, name):
    """The least changes of any run of words that ends at a word, against a table of edit distances for every run."""
    t = next(t for t in FAMILIES if t.name == name)

    def distance(run):
        row = list(range(len(run) + 1))
        for k, a in enumerate(t.words, 1):
            new = [k]
            for j, b in enumerate(run, 1):
                new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    want = {}
    for end in range(1, len(words) + 1):
        least = min(distance(words[start:end]) for start in range(end + 1))
        start = max(s for s in range(end + 1) if distance(words[s:end]) == least)
        if 1 - least / len(t.words) >= 0.5 and start < end and t.keys <= set(words[start:end]):
            want[end] = (least, start)
    got = {end: (changed, start) for _, changed, start, end, _ in t.places(words, 0, len(words), 0.5)} if len(words) / len(t.words) >= 0.5 else {}
    assert got == (want if len(words) / len(t.words) >= 0.5 else {})


def test_templates_are_ranked_by_what_they_save():
    """The winner of an exact notice saves most of its class; ranks are places in the order of savings."""
    for some in licenses.classes_of(FAMILIES):
        for t in some:
            data = t.text.encode()
            alone = len(licenses._ALONE.compress(data))
            savings = {o.name: o.saving(data, alone) for o in some}
            order = sorted(savings, key=lambda n: (-savings[n], n))
            [(name, *_, saving, rank, changed, _, _, _)] = licenses.notices(t.text, FAMILIES)
            assert (name, changed) == (t.name, 0) and rank == order.index(name) + 1 and saving == pytest.approx(savings[name])


def test_license_lines_of_the_table(docs):
    """Every line of one of the fixed wordings is found, and nothing else."""
    short = [t for n, t in licenses.TEMPLATES.items() if n.endswith("notice")]
    want = sum(any(t in (r.text or "") for t in short) for r in docs.select("text").collect())
    assert licenses.scan(docs).select("doc_id").distinct().count() == want


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_long_lists_of_notices(name):
    """Every exact notice of a list is found, however long the list is."""
    lines = [f"pkg{i}x{i * 7919 % 1000} 1.{i}.0 {licenses.TEMPLATES[name]}" for i in range(1000)]
    found = licenses.notices("\n".join(lines), licenses.compiled(tuple(licenses.TEMPLATES.items())))
    assert [(f[0], f[5]) for f in found] == [(name, 0)] * 1000


def test_notices_in_a_text_that_is_dense_in_anchors():
    rng = random.Random(1)
    words = ["license", "copyright", "permission", "warranty", "redistribute", *(f"w{i}" for i in range(60))]
    parts, want = [], []
    for i in range(520):
        name = rng.choice(list(licenses.TEMPLATES))
        parts += [" ".join(rng.choices(words, k=rng.randint(20, 180))), f"x{i}", licenses.TEMPLATES[name], f"y{i}"]
        want.append((name, 0))
    text = " ".join(parts)
    assert len(text) > 300_000
    found = licenses.notices(text, licenses.compiled(tuple(licenses.TEMPLATES.items())))
    assert [(f[0], f[5]) for f in found] == want


def test_a_refused_place_does_not_refuse_the_template():
    known = licenses.compiled(tuple(licenses.TEMPLATES.items()))
    gpl = "licensed under the GNU General Public License, version"
    for text, want in (
        ("alpha is released under the BSD License and beta is licensed under the MIT License", [("MIT-notice", 1, "under the MIT License")]),
        (f"This work is {gpl} 2 and this program is {gpl} 3", [("GPL-3.0-notice", 1, f"this program is {gpl} 3")]),
        (f"This program is {gpl} 3, this work is {gpl} 2, this work is {gpl} 3",
         [("GPL-3.0-notice", 1, f"This program is {gpl} 3"), ("GPL-3.0-notice", 0, f"this work is {gpl} 3")]),
        (f"This work is {gpl} 2 or 3", [("GPL-3.0-notice", 2, f"This work is {gpl} 2 or 3")]),
    ):
        assert [(f[0], f[4], f[6]) for f in licenses.notices(text, known)] == want


@pytest.fixture(scope="module")
def pieces():
    return bpe.encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def ids_of(text, pieces):
    return np.frombuffer(b"".join(bpe.encode_text(text, pieces)), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abethEÉßéñ '’s\n\t\r\x1c\x85\xa0\u2003\u3000٣1²漢字ひ😀👩‍👩!?.,$%#&*|-_ "), max_size=80))
def test_ids_equal_the_library(text):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert ids_of(text, bpe.encoder(RANKS, public_tokenizers.PATTERN)) == library.encode_ordinary(text)


def test_long_pieces_segments_and_resets(pieces, library, monkeypatch):
    rng = random.Random(4)
    texts = ["a" * 3000, "ab" * 2000, " " * 500 + "x", "".join(rng.choices("abcdeth", k=4000)), "漢" * 1000, " ".join(rng.choices(["the", "of,", "it's"], k=2000))]
    for text in texts:
        assert ids_of(text, pieces) == library.encode_ordinary(text)
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 20)
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    few = bpe.Pieces(bpe.Transducer(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    for text in texts:
        assert ids_of(text, few) == library.encode_ordinary(text)
        assert b"".join(b"".join(few[c] for c in bpe.CHUNK.findall(p)) for p in bpe.segments(text, 40)) == b"".join(bpe.encode_text(text, pieces))


def test_tokens_come_before_the_end(pieces):
    out = list(pieces.transducer.stream(b"thequickbrownfoxjumpsoverthelazydogandsoon"))
    assert len(out) > 3, "tokens are emitted while the piece is read"
    assert [i for part in out for i in part] == pieces.transducer.encode(b"thequickbrownfoxjumpsoverthelazydogandsoon")


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(0, 40)))
def test_utf8_stream_equals_one_decode(data, cuts):
    cuts = sorted({0, len(data), *(c for c in cuts if c <= len(data))})
    stream = bpe.Utf8Stream()
    out = "".join(stream.feed(data[a:b]) for a, b in itertools.pairwise(cuts)) + stream.finish()
    assert out == data.decode("utf-8", "replace")


@pytest.mark.parametrize("table", ALL)
def test_encoded_and_decoded(table, request, library):
    df = request.getfixturevalue(table)
    texts = [(r.doc_id, r.text or "") for r in df.collect()]
    want = []
    for i, t in texts:
        ids = np.array(library.encode_ordinary(t), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    out = bpe.encoded(df, RANKS, with_ids=True)
    assert sorted(map(repr, (tuple(r)[:4] for r in out.collect()))) == sorted(map(repr, want))
    assert sorted(map(repr, map(tuple, bpe.decoded(out, RANKS).collect()))) == sorted(map(repr, texts))


def test_digests_are_of_what_the_stream_decodes(monkeypatch):
    fed, feed = [], bpe.Utf8Stream.feed
    monkeypatch.setattr(bpe.Utf8Stream, "feed", lambda self, data: fed.append(feed(self, data)) or fed[-1])
    texts = ["été 漢字 😀 don't", "", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": texts})
    out = pa.Table.from_batches(bpe._encoded(RANKS, public_tokenizers.PATTERN, False)(iter([batch]))).to_pylist()
    assert "".join(fed) == texts[0]
    assert [r["decoded_sha256"] for r in out] == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]


@functools.lru_cache
def plain_tokenizer():
    return Tokenizer.from_file(tokenfile.default_tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "ab", "é漢", " ", "  ", "\n", "'s", "!", "12"]), max_size=12).map("".join))
def test_names_of_added_tokens_are_tokens(text):
    known = tokenfile.chunks(tokenfile.default_tokenizer())
    for t in (text, f"a  <|endoftext|>{text}"):
        assert np.frombuffer(b"".join(known.ids_of(t)), "<u4").tolist() == plain_tokenizer().encode(t, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text("abcXYZ éßÀÖØöøÿ×÷ıƀɏɐ'-_1漢ʰª", max_size=20) | st.lists(st.sampled_from([" the", "tion", " été", "ß", " ", "'s"]), max_size=8).map("".join))
def test_chunks_of_letters_go_to_the_model_alone(text):
    known = tokenfile.Chunks.__new__(tokenfile.Chunks)
    known.__dict__.update(tokenfile.chunks(tokenfile.default_tokenizer()).__dict__)
    assert known.model is not None
    assert np.frombuffer(b"".join(known.ids_of(text)), "<u4").tolist() == plain_tokenizer().encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60), min_size=1, max_size=300))
def test_blocks_round_trip(ids):
    a = np.array(ids, np.uint32)
    assert (tokenfile.decode_blocks(b"".join(tokenfile.encode_blocks(a[None, :]))) == a).all()


def test_outliers_go_to_the_exceptions():
    a = np.full((1, tokenfile.BLOCK), 7, np.uint32)
    a[0, 3] = 2**32 - 1
    assert len(tokenfile.encode_blocks(a)[0]) == tokenfile._HEAD.size + 6


@pytest.mark.parametrize("held", [7, 256, 1000])
def test_documents_in_runs(tmp_path, monkeypatch, held):
    monkeypatch.setattr(tokenfile, "HELD_IDS", held)
    rng = np.random.default_rng(held)
    docs = [rng.integers(0, 50_257, n, dtype=np.uint32) for n in (0, 3, 0, 4000, 7, 7, 0)]
    writer = tokenfile.Writer(str(tmp_path / "a.pfor"))
    for d in docs:
        writer.begin()
        for at in range(0, len(d), 50):
            writer.extend(d[at : at + 50])
    writer.close()
    reader = tokenfile.Reader(str(tmp_path / "a.pfor"))
    assert all((a == b).all() for a, b in zip(reader.documents(), docs, strict=True))
    assert max(len(ids) for _, ids, _ in reader.runs()) <= held


def test_a_document_of_very_many_ids_in_bounded_memory(tmp_path):
    """Eight million ids written and read in a process of its own."""
    code = (
        "import resource, sys, zlib; import numpy as np; from parcelflow.llm import tokenfile;"
        "start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; w = tokenfile.Writer(sys.argv[1]); w.begin();"
        "[w.extend(np.arange(k, k + 1000, dtype=np.uint32) % 50257) for k in range(0, 8_000_000, 1000)]; w.close();"
        "n = sum(len(ids) for _, ids, _ in tokenfile.Reader(sys.argv[1]).runs()); assert n == 8_000_000;"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) // 1024)"
    )
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "a.pfor")], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 200


def test_files_end_by_documents_too(llm, monkeypatch):
    monkeypatch.setattr(tokenfile, "FILE_DOCS", 3)
    docs = llm.createDataFrame([(i, "a b") for i in range(10)], "doc_id bigint, text string").coalesce(1)
    files = tokenfile.write(docs, workdir(llm, "test-tokens"), tokenfile.default_tokenizer()).collect()
    assert max(len(f.doc_ids) for f in files) <= 3 and sum(len(f.doc_ids) for f in files) == 10


def test_random_access(tmp_path):
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 50_257, n, dtype=np.uint32) for n in (1, 0, 700, 256, 3, 90_000)]
    writer = tokenfile.Writer(str(tmp_path / "a.pfor"))
    for d in docs:
        writer.add(d)
    writer.close()
    reader, whole = tokenfile.Reader(str(tmp_path / "a.pfor")), np.concatenate(docs)
    assert all((a == b).all() for a, b in zip(reader.documents(), docs, strict=True))
    for start in (0, 1, 255, 256, 50_000, len(whole) - 1):
        assert (reader.read(start, 600) == whole[start : start + 600]).all()
    runs = list(reader.runs())
    assert [k for k, _, last in runs if last] == list(range(6))
    assert all((np.concatenate([ids for j, ids, _ in runs if j == k]) == d).all() for k, d in enumerate(docs))
    empty = tokenfile.Writer(str(tmp_path / "b.pfor"))
    empty.close()
    assert list(tokenfile.Reader(str(tmp_path / "b.pfor")).documents()) == []


@pytest.mark.parametrize("table", ALL)
def test_token_files(table, request):
    df = request.getfixturevalue(table)
    plain = Tokenizer.from_file(tokenfile.default_tokenizer())
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for i, t in rows:
        ids = [*plain.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    files = tokenfile.write(df, workdir(df.sparkSession, "test-tokens"), tokenfile.default_tokenizer(), file_ids=5000)
    got = [tuple(r) for r in tokenfile.digests(files).collect()]
    # Rows that repeat an id may follow each other in either order.
    single = [w for w in want if [x[0] for x in want].count(w[0]) == 1]
    assert {*single} <= {*got} and sorted((str(a), c, d) for a, _, c, d in got) == sorted((str(a), c, d) for a, _, c, d in want)
    spans = sorted((s, s + n) for _, s, n, _ in got)
    assert all(a[1] == b[0] for a, b in itertools.pairwise(spans)) and (not spans or spans[0][0] == 0)
