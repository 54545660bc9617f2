"""Registered queries against SQL, and the pipeline against its own operators' plain versions."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
import tiktoken

import __spark_entry__ as entry
import check
import corpus_pipeline
import public_tokenizers
from parcelflow.llm import bpe, crf, mixing
from parcelflow.llm.queries import QUERIES, SQL
from test_dedup import plain_fingerprint, plain_roots

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(llm, name):
    ok, note = check.compare(llm, check.connect(SF_DIR), name, SF_DIR)
    assert ok, note


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_is_registered_and_reads_no_subset(llm, name):
    df = entry.queries()[name](llm, SF_DIR)
    table = "pages" if name.startswith(("op7_", "op10_")) else "embeddings" if name.startswith(("op9_", "op13_")) else "documents"
    if name not in ("op2_license_scan", "op11_prefix_trie"):
        assert df.count() == llm.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def plain_pipeline(spark, docs):
    """Each stage but the model's scores in plain Python."""
    model = crf.fit(*(spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels")))
    score = dict(zip([d.doc_id for d in docs], crf.score_all((d.text.encode() for d in docs), model), strict=True))
    docs = [d for d in docs if score[d.doc_id] >= 0.3]
    first = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        first.setdefault(" ".join(d.text.replace("\r", " ").split(" ")).replace("\n", " "), d)
    docs = list(first.values())
    marks = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    ids = sorted(marks)
    root = plain_roots(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (marks[a] ^ marks[b]).bit_count() <= 3])
    docs = [d for d in docs if root[d.doc_id] == d.doc_id]
    taken = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")).collect()}
    return docs, taken


def test_pipeline(llm):
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    kept, taken = plain_pipeline(llm, docs)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_ranks()), special_tokens={})
    whole = {d.doc_id: hashlib.sha256(d.text.encode()).hexdigest() for d in kept}
    ids = {d.doc_id: hashlib.sha256(np.array(library.encode_ordinary(d.text), "<u4").tobytes()).hexdigest() for d in kept}
    size = {d.doc_id: len(d.text.split()) for d in kept}
    rows = defaultdict(list)
    for r in corpus_pipeline.run(llm, SF_DIR).collect():
        rows[r.doc_id].append(r)
    assert {*rows} == {i for i, n in taken.items() if n}
    assert all(library.decode(np.frombuffer(r.ids, "<u4").tolist()) == d.text for d in kept for r in rows[d.doc_id] if r.ids_sha256 == ids[d.doc_id])
    assert all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and len(r.ids) == 4 * r.n_tokens for found in rows.values() for r in found)
    for i, found in rows.items():
        full = [r for r in found if r.decoded_sha256 == whole[i]]
        assert len(full) == taken[i] // size[i] and len(found) - len(full) == (taken[i] % size[i] > 0)
        assert all(r.ids_sha256 == ids[i] for r in full)


def test_stages_keep_the_columns_and_stand_odd_rows(llm, odd_docs, no_docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "encode"]
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(llm, docs, SF_DIR)
            if name != "encode":
                assert out.columns == docs.columns
            assert out.count() <= 3 * docs.count()
