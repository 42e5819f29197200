"""Byte-level BPE, id files and edit-aware counts against the libraries and plain recounts."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from bandsaw.llm import edit_counts, queries, repair, segment_bpe
from bandsaw.llm.text import CharacterClasses

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=segment_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def cache():
    return segment_bpe.WordCache(CharacterClasses(segment_bpe.pattern_class), segment_bpe.SegmentTreeBpe(segment_bpe.read_ranks(RANKS)))


def random_texts(n):
    draw = random.Random(7)
    signs = ["a", "the", "'s", "'", "'ll", " ", "  ", "\n", "\t", "1", "23", "é", "日本", "!", "...", "\u00a0", "\u3000", "🙂", "x", "Ⅷ", "'re", "RE"]
    return ["".join(draw.choice(signs) for _ in range(draw.randint(0, 30))) for _ in range(n)]


def test_pretokens_and_merges_equal_the_library(cache, library):
    texts = [*random_texts(2000), "", "z" * 5000, " " * 300, "ab" * 2000 + " 's"]
    flat, count = cache.ids(pa.array(texts))
    for text, ids in zip(texts, np.split(flat, np.cumsum(count)[:-1]), strict=True):
        assert ids.tolist() == library.encode_ordinary(text), text


def test_a_full_cache_starts_anew(library):
    small = segment_bpe.WordCache(CharacterClasses(segment_bpe.pattern_class), segment_bpe.SegmentTreeBpe(segment_bpe.read_ranks(RANKS)), kept=40)
    for text in random_texts(60):
        assert small.ids(pa.array([text]))[0].tolist() == library.encode_ordinary(text)


def swapped_words(least=256, most=4096):
    """Pairs of words of doubled and swapped letters, which polynomials of their bytes do not tell apart."""
    a, b = "a", "b"
    while len(a) < most:
        a, b = a + b, b + a
        if len(a) >= least:
            yield a, b


def test_swapped_words_stay_apart(spark, cache, library):
    texts = [w for pair in swapped_words() for w in pair]
    flat, count = cache.ids(pa.array(texts))
    for text, ids in zip(texts, np.split(flat, np.cumsum(count)[:-1]), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in segment_bpe.decode(segment_bpe.encode(docs, RANKS), RANKS).collect():
        assert r.ids == library.encode_ordinary(r.text) and bytes(r.decoded).decode() == r.text
    for r in edit_counts.count_tokens(docs, RANKS).collect():
        assert r.n_tokens == len(library.encode_ordinary(r.text))
    got = [tuple(r) for r in repair.tokenized(spark, docs, JSON, 2).orderBy("start").collect()]
    assert got == expected_files(list(enumerate(texts)))


def test_words_of_one_hash_stay_apart(library, monkeypatch):
    """Hashes of two bits: nearly all words meet others, in their chunk and among those that are held."""
    real = segment_bpe.segment_hashes
    texts = random_texts(300)
    for mask in (3, 0x3FF):
        monkeypatch.setattr(segment_bpe, "segment_hashes", lambda *args: real(*args) & np.uint64(mask))
        cache = segment_bpe.WordCache(CharacterClasses(segment_bpe.pattern_class), segment_bpe.SegmentTreeBpe(segment_bpe.read_ranks(RANKS)))
        for part in (texts[:1], texts[1:2], texts[2:40], texts[40:]):
            flat, count = cache.ids(pa.array(part))
            for text, ids in zip(part, np.split(flat, np.cumsum(count)[:-1]), strict=True):
                assert ids.tolist() == library.encode_ordinary(text)


def test_encode_and_decode(spark, odd_documents, library):
    rows = segment_bpe.decode(segment_bpe.encode(odd_documents, RANKS), RANKS).collect()
    assert len(rows) == 12
    for r in rows:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.n_tokens == "kept" and r.score == "kept"


def test_tokens_of_an_empty_table(spark, odd_documents):
    none = odd_documents.limit(0)
    assert segment_bpe.encode(none, RANKS).count() == 0
    assert edit_counts.count_tokens(none, RANKS).count() == 0
    assert repair.tokenized(spark, none, JSON, 2).count() == 0


def test_op10_query(spark, sf, library, documents):
    got = {r.doc_id: r for r in queries.op10_segment_tree_bpe(spark, sf).collect()}
    for d in documents.collect():
        ids = library.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def expected_files(rows):
    tokenizer = Tokenizer.from_file(JSON)
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op5_query(spark, sf, documents):
    got = [tuple(r) for r in queries.op5_repair_ids(spark, sf).orderBy("start").collect()]
    assert got == expected_files([(d.doc_id, d.text) for d in documents.collect()])


def test_id_files_of_odd_documents(spark, odd_documents):
    got = [tuple(r) for r in repair.tokenized(spark, odd_documents, JSON, 2).orderBy("start").collect()]
    assert got == expected_files([(d.doc_id, d.text) for d in odd_documents.collect()])


def test_added_tokens_get_their_ids(spark):
    """Against the library in its default state."""
    mark, draw = "<|endoftext|>", random.Random(9)
    texts = [f"a{mark}b", mark, mark * 3, f" {mark} ", f"{mark}\n", "<|endoftext|", f"<|{mark}|>", f"it{mark}'s 12{mark}3  {mark}  x", "", None, "none"]
    texts += ["".join(draw.choice([mark, *random_texts(1)]) for _ in range(draw.randint(0, 9))) for _ in range(200)]
    tokenizer = Tokenizer.from_file(JSON)
    start, want = 0, []
    for key, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [tuple(r) for r in repair.tokenized(spark, docs, JSON, 2).orderBy("start").collect()] == want


def test_repair_is_lossless_and_reads_parts():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 900, (50, 6))
    counts = np.array([0, 1, 2, 0, 40_000, 3, 10_000, 0])
    ids = words[draw.integers(0, 50, counts.sum() // 6 + 1)].ravel()[: counts.sum()].astype(np.int32)
    data = repair.pack(np.arange(8), np.zeros(8, bool), ids, counts)
    assert len(data) < 2 * ids.size
    block = repair.Block(data)
    assert (block.all_ids() == ids).all()
    edges = np.concatenate([[0], np.cumsum(counts)])
    for k in range(8):
        assert (block.document(k) == ids[edges[k] : edges[k + 1]]).all()
        for a, b in ((0, 1), (5, 77), (999, 1000), (0, 10**6)):
            assert (block.part(k, a, b) == ids[edges[k] : edges[k + 1]][a:b]).all()
    assert block.lengths.max() > 2
    with pytest.raises(ValueError):
        repair.Block(b"nope" + data[4:])


def plain_edit(text, start, removed, inserted):
    start = min(max(0, start or 0), len(text))
    return text[:start] + (inserted or "") + text[start + max(0, removed or 0) :]


def test_random_edits_equal_a_recount(cache, library):
    draw = random.Random(5)
    counter = edit_counts.Counter(cache)
    texts = [" ".join(random_texts(40)) for _ in range(30)] + ["", "a", " " * 500, "\n" * 90 + "x"]
    trees = counter.trees(texts)
    for _ in range(12):
        edits = [(draw.randint(0, len(t) + 2), draw.choice([0, 1, 3, 50, 400]), draw.choice(["", "'", "s", " ", "\n\n", "word " * 90, "日"])) for t in texts]
        counter.edit(trees, edits)
        texts = [plain_edit(t, *e) for t, e in zip(texts, edits, strict=True)]
        for text, tree in zip(texts, trees, strict=True):
            assert tree.text() == text
            assert tree.tokens == len(library.encode_ordinary(text))
            assert sum(x["tokens"] for x in tree.leaves()) == tree.tokens


def test_edits_on_odd_documents(spark, odd_documents, library):
    rows = odd_documents.selectExpr("*", f"""CAST(array(named_struct('start', 3L, 'removed', 2L, 'inserted', 'né '), NULL,
        named_struct('start', NULL, 'removed', NULL, 'inserted', NULL), named_struct('start', 999999L, 'removed', 5L, 'inserted', ' end')) AS {edit_counts.EDITS}) AS edits""")
    got = edit_counts.apply_edits(edit_counts.count_tokens(rows, RANKS), RANKS).select("text", "n_tokens", "n_encoded", "leaves", "score").collect()
    assert len(got) == 12 and {r.score for r in got} == {"kept"}
    for r in got:
        assert r.n_tokens == len(library.encode_ordinary(r.text))
    unedited = edit_counts.apply_edits(edit_counts.count_tokens(rows.selectExpr("text", f"CAST(NULL AS {edit_counts.EDITS}) AS edits"), RANKS), RANKS)
    assert {r.n_encoded for r in unedited.collect()} == {0}


def test_a_small_edit_encodes_little(cache):
    counter = edit_counts.Counter(cache)
    tree = counter.trees(["some words here " * 20_000])[0]
    assert counter.edit([tree], [(100_000, 3, "X")])[0] < 4 * edit_counts.LEAF


def test_op4_query(spark, sf, library, documents):
    got = {r.doc_id: r for r in queries.op4_edit_counts(spark, sf).collect()}
    for d in documents.collect():
        text, h = d.text or "", zlib.crc32(str(d.doc_id).encode())
        n = len(text) + 1
        assert got[d.doc_id].n_before == len(library.encode_ordinary(text))
        second = " ".join(["", *[x for x in (d.lang, d.source) if x is not None], "2nd"])
        for edit in ((h % n, 5, " edited"), (h // 7 % n, 0, second), (h // 49 % n, 40, "")):
            text = plain_edit(text, *edit)
        assert got[d.doc_id].text_crc32 == zlib.crc32(text.encode())
        assert got[d.doc_id].n_after == len(library.encode_ordinary(text))
