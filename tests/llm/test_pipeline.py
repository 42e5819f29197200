"""The corpus pipeline against plain computations, and on odd and empty tables."""

import re
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from bandsaw.llm import queries, segment_bpe, stages
from tests.llm.test_copies import plain_components, plain_lines

WORD = re.compile(r"\w+")


@pytest.fixture(scope="module")
def library():
    ranks = segment_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_pipeline(rows, items):
    """{id: text} that is left of (id, text) rows; every text with a letter has a language that can be told."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    cut = plain_lines(rows)
    rows = [(key, cut[key, text][0]) for key, text in rows if not cut[key, text][2] or cut[key, text][2] < cut[key, text][1]]
    _, component = plain_components(rows, 5)
    rows = [r for i, r in enumerate(rows) if r[0] == component[i]]
    grams = {}
    for key, text in items:
        w = WORD.findall(text.lower())
        grams[key] = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
    out = {}
    for key, text in rows:
        w = WORD.findall(text.lower())
        own = {tuple(w[i : i + 8]) for i in range(len(w) - 7)}
        if not any(g and 2 * len(g & own) >= len(g) for g in grams.values()):
            out[key] = text
    return out


def test_pipeline_equals_plain_computation(spark, sf, documents, library):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain_pipeline([(d.doc_id, d.text) for d in documents.collect()], items)
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(want)
    assert len(got) == len(want) < documents.count()
    for r in got:
        assert r.ids == library.encode_ordinary(want[r.doc_id]) and r.round_trip


def test_names_and_columns():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and all(callable(f) for _, f in corpus_pipeline.STAGES)
    assert not [name for name in queries.QUERIES if not re.fullmatch(r"op([1-9]|1[0-3])_\w+", name)]
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages_on_odd_and_empty_tables(spark, odd_documents, sf):
    for start in (odd_documents, odd_documents.limit(0)):
        docs = start
        seen = defaultdict(int)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.saved(stage(spark, docs, sf), f"test-{name}")
            seen[name] = docs.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == stages.COLUMNS
        if start is odd_documents:
            ids = [r.doc_id for r in docs.collect()]
            assert set(ids) >= {9, 10, 5} and 2 not in ids and 3 not in ids and 7 not in ids and 8 not in ids
            assert ids.count(1) == 1 and 6 not in ids
        else:
            assert not any(seen.values())
