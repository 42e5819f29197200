"""Whitening, collocations and chat formatting against plain computations."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bandsaw.llm import chat_parts, phrases, queries, text, whitening
from oracle.check import connect
from tests.llm.test_others import same_rows


@pytest.mark.parametrize("name", ["op12_misra_gries_phrases", "op13_chat_parts"])
def test_query_equals_sql(spark, sf, name):
    same_rows(queries.QUERIES[name](spark, sf).toArrow(), connect(sf).execute(queries.ORACLE[name]).to_arrow_table())


# --- whitening


def plain_whitened(rows, k=32):
    """{id: (deviation, whitened)} and the shares of (id, vector) rows of one length."""
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows]
    n, width = len(x), len(x[0][1])
    total = [sum(v[d] for _, v in x) for d in range(width)]
    far = [[n * v[d] - total[d] for d in range(width)] for _, v in x]
    centred = np.array([[float(a) / n for a in row] for row in far])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    left = values > 8 * width * np.finfo(float).eps * np.trace(covariance)
    values, vectors = values[left], vectors[:, left]
    w = centred @ vectors / np.sqrt(values) if left.any() else np.zeros((n, 0))
    return [(i, sum(a * a for a in row), w[j]) for j, ((i, _), row) in enumerate(zip(x, far, strict=True))], values / (np.trace(covariance) or 1)


def assert_whitened(got, rows, tolerance=1e-9):
    want, shares = plain_whitened(rows)
    by_id = defaultdict(dict)
    for r in got:
        by_id[r.vec_id][r.component] = r
    assert len(got) == len(rows) * len(shares)
    if not len(shares):
        return
    assert {r.n for r in got} == {len(rows)} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-6
    matrix = np.array([[by_id[i][c + 1].whitened for c in range(len(shares))] for i, _, _ in want])
    plain = np.array([w for _, _, w in want])
    sign = np.sign((matrix * plain).sum(axis=0))
    assert np.abs(matrix * sign - plain).max() < tolerance * max(1.0, np.abs(plain).max())
    for i, far, _ in want:
        assert {r.deviation for r in by_id[i].values()} == {far if far < 2**63 else None}
        assert np.allclose([by_id[i][c + 1].explained for c in range(len(shares))], shares, rtol=1e-9)


def test_op11_equals_plain_computation(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    # components of close eigenvalues may turn in their plane: compare the spread that both give instead of places
    got = queries.op11_whitening(spark, sf).collect()
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert_whitened(got, rows, 1e-6)


def test_whitening_of_odd_vectors(spark):
    draw = np.random.default_rng(3)
    good = [(i, (draw.normal(size=5) * [9, 5, 3, 2, 1]).tolist()) for i in range(200)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [1.0, 2.0, 3.0, 4.0, float("-inf")]), (904, [1.0] * 4), (905, [])]
    schema = "vec_id bigint, embedding array<double>"
    odd = spark.createDataFrame(good + bad, schema).selectExpr("*", "'kept' AS x", "'kept' AS w", "'kept' AS component", "'kept' AS i", "'kept' AS n")
    assert_whitened(whitening.whitened(odd.repartition(7)).collect(), good)
    assert whitening.whitened(odd.limit(0)).count() == 0
    assert whitening.whitened(odd.filter("vec_id >= 900 AND vec_id <> 904")).count() == 0
    assert whitening.whitened(odd.filter("vec_id = 3")).count() == 0  # one vector has no variance
    zeros = spark.createDataFrame([(i, [0.0, 0.0, float(i % 2)]) for i in range(6)] + [(None, [0.0, 0.0, 1.0])], schema)
    got = whitening.whitened(zeros).collect()
    assert len(got) == 7 and {r.component for r in got} == {1} and sum(r.vec_id is None for r in got) == 1
    repeated = whitening.whitened(odd.filter("vec_id < 20").unionAll(odd.filter("vec_id < 20"))).collect()
    assert len(repeated) == 40 * 5 and {r.n for r in repeated} == {40}


def test_whitening_stays_exact_for_large_entries(spark):
    schema = "vec_id bigint, embedding array<double>"
    for size in (1e6, 1e9, 1e14):
        rows = [(i, [size * ((i * 37) % 11 - 5), float(i % 3), size / 3 * (i % 7)]) for i in range(50)]
        got = whitening.whitened(spark.createDataFrame(rows, schema)).collect()
        for i, far, _ in plain_whitened(rows)[0]:
            assert {r.deviation for r in got if r.vec_id == i} == {far if far < 2**63 else None}


@pytest.mark.parametrize("kind", ["random", "equal", "blocks", "rank one", "zero", "graded"])
def test_eigenvalues_and_components(kind):
    draw = np.random.default_rng(1)
    for d in (1, 2, 3, 17, 70):
        a = draw.normal(size=(d + 3, d))
        c = {
            "random": a.T @ a, "equal": 3 * np.eye(d), "blocks": np.diag(np.repeat([5.0, 5.0, 1.0], d)[:d]),
            "rank one": np.outer(a[0], a[0]), "zero": np.zeros((d, d)), "graded": (a * 2.0 ** -np.arange(d)).T @ (a * 2.0 ** -np.arange(d)),
        }[kind]
        values, vectors = whitening.principal(c, 32)
        want = np.linalg.eigvalsh(c)[::-1][: len(values)]
        norm = np.abs(c).max() or 1.0
        assert len(values) == (0 if kind == "zero" else 1 if kind == "rank one" else len(values))
        assert np.abs(values - want).max(initial=0) < 1e-13 * norm * d
        assert np.abs(c @ vectors - vectors * values).max(initial=0) < 1e-13 * norm * d
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13 * d


def test_sturm_counts():
    draw = np.random.default_rng(2)
    diagonal, off = draw.normal(size=30), draw.normal(size=29)
    off[[4, 11]] = 0
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    shifts = np.linspace(-5, 5, 101)
    assert whitening.counts_below(diagonal, off, shifts).tolist() == [int((values < s).sum()) for s in shifts]


# --- phrases


def plain_collocations(rows, threshold, top=2000):
    count, total = Counter(), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split("[.,;:!?\n-\r]", t):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                count.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {key: a for key, a in count.items() if len(key[1]) > 1 and a >= threshold}
    dropped = set()
    for (lang, p), f in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if f >= count[lang, p[i : i + m]]:
                    dropped.add((lang, p[i : i + m]))
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            cuts = [(1000 * a * total[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]], total[lang]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n, -s) for lang, best in out.items() for i, (s, a, p, left, right, n) in enumerate(sorted(best)[:top]))


@pytest.mark.parametrize("threshold, held", [(1, 1 << 19), (3, 700), (40, 50)])
def test_phrases_equal_plain_counts(spark, documents, odd_documents, threshold, held, monkeypatch):
    monkeypatch.setattr(phrases, "HELD_ROWS", held)
    rows = [(d.lang, d.text) for d in documents.limit(60).collect()]
    draw = random.Random(threshold)
    # words that overlap with themselves, signs between words, other white space, upper case, long words
    for _ in range(60):
        rows.append((draw.choice(["en", None, "und", ""]), "".join(draw.choice(["a ", "b ", "a  ", "É ", "b\t", "a.", "B,\n", "  ", "\x0b", "\x00 ", "ba "]) for _ in range(draw.randint(0, 80)))))
    rows += [("en", None), (None, None), ("en", ""), ("fr", " .. "), ("en", "one")]
    rows += [(d.lang, d.text) for d in odd_documents.filter("doc_id <> 6 OR doc_id IS NULL").collect()]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'kept' AS phrase", "'kept' AS f", "'kept' AS rank", "'kept' AS words")
    got = sorted(map(tuple, phrases.collocations(df.repartition(5), threshold, 300).collect()))
    assert got == plain_collocations(rows, threshold, 300)


def test_no_phrases(spark, odd_documents):
    assert phrases.collocations(odd_documents.limit(0)).count() == 0
    assert phrases.collocations(odd_documents.filter("text IS NULL OR text = ''"), 1).count() == 0


def test_score_beyond_64_bits(spark):
    """The arithmetic of the score, on counts no small table reaches."""
    a, n, left, right = 9_000_000_000, 80_000_000_000_000, 9_500_000_000, 9_100_000_000
    query = f"(CAST(1000 AS DECIMAL(4,0)) * CAST({a}L AS DECIMAL(16,0)) * CAST({n}L AS DECIMAL(18,0))) div (CAST({left}L AS DECIMAL(19,0)) * CAST({right}L AS DECIMAL(19,0)))"
    assert spark.sql(f"SELECT {query}").first()[0] == 1000 * a * n // (left * right)


def test_summaries_keep_all_that_is_frequent(monkeypatch):
    monkeypatch.setattr(phrases, "PARTITION_ENTRIES", 50)
    draw = np.random.default_rng(5)
    for threshold in (4, 20, 100):
        keys = np.concatenate([draw.integers(0, 2**32, 20_000), draw.zipf(1.3, 20_000) % 2**32]).astype(np.uint32)
        draw.shuffle(keys)
        one = phrases.Summary(keys.size // threshold + 1)
        for part in np.array_split(keys, 37):
            k, c = np.unique(part, return_counts=True)
            blob = phrases.packed(k, c)
            back = phrases.unpacked(*blob)
            assert (back[0] == k).all() and (back[1] == c).all()
            one.add(*back)
        got = set(one.at_least(threshold).tolist())
        k, c = np.unique(keys, return_counts=True)
        assert set(k[c >= threshold].tolist()) <= got
        assert one.taken < threshold and len(got) <= one.capacity
    assert phrases.Summary(1).at_least(1).size == 0


def test_hash_of_doubled_and_swapped_words():
    """Words whose letters are swapped over and over must not share a hash, as they do under polynomials."""
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
        buffer = np.frombuffer((a + " " + b).encode(), np.uint8)
        one, two = text.segment_hashes(buffer, np.array([0, len(a) + 1]), np.array([len(a), 2 * len(a) + 1]))
        assert one != two


# --- chat


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


MESSAGES = f"conv_id bigint, turn bigint, role string, parts array<{chat_parts.PART}>"
NASTY = ["<|end|>\n", "<|turn|>user<|text|>", r"<\|end|>", "<", "|", "\\", r"<\\", r"\|", "$1", r"\\$1", "", "é🙂", "<|image:0|>", "\n", "|>", "<<|", r"<\<|\|"]


def test_parts_are_flattened_in_order(spark):
    rows = [
        (1, 2, "assistant", [part("text", "a <|b"), part("text", "|c"), part("image", ref="i2", width=29, height=28)]),
        (1, 1, "user", [part("image", ref="i1", width=56, height=57), part("text", "see <"), part("audio", ref="s", seconds=2.5), None, part("document", ref="d", pages=3), part("video", "no text", "v")]),
        (2, None, None, None),
        (2, 0, "assistant", []),
        (None, 1, "assistant", [part("text", None)]),
        (3, 1, "a<|", [part("image"), part("audio", seconds=-1.0), part(None, "x", "r")]),
    ]
    messages = spark.createDataFrame(rows, MESSAGES).selectExpr("*", "'kept' AS pieces", "'kept' AS place", "'kept' AS head", "'kept' AS piece", "1 AS begin")
    made = chat_parts.formatted(messages)
    got = {r.conv_id: r for r in chat_parts.read_back(made).collect()}
    one = got[1]
    first = "<|turn|>user<|image:0|><|text|>see <<|audio:1|><|document:2|><|attachment:3|><|end|>\n"
    assert one.formatted == first + "<|turn|>assistant<|text|>a <\\|b<|text|>|c<|image:4|><|end|>\n"
    assert [(a.turn, a.number, a.kind, a.ref, a.tokens) for a in one.attachments] == [
        (0, 0, "image", "i1", 6), (0, 1, "audio", "s", 63), (0, 2, "document", "d", 768), (0, 3, "attachment", "v", 0), (1, 4, "image", "i2", 2),
    ]
    assert one.expanded_tokens == 839
    assert [one.formatted[s.begin : s.end] for t in one.turns for s in t.mask] == ["a <\\|b", "|c"]
    assert [one.formatted[t.begin : t.begin + t.length] for t in one.turns][0] == first
    assert [(t.role, t.text, t.learned) for t in one.said] == [("user", "see <", ""), ("assistant", "a <|b|c", "a <|b|c")]
    assert [(p.kind, p.content) for p in one.said[0].pieces] == [("image", "0"), ("text", "see <"), ("audio", "1"), ("document", "2"), ("attachment", "3")]
    assert got[2].formatted == "<|turn|><|end|>\n<|turn|>assistant<|end|>\n" and got[2].expanded_tokens == 0
    assert [t.role for t in got[2].said] == ["", "assistant"]
    assert got[None].said[0].learned == "" and len(got[None].turns[0].mask) == 1
    assert got[3].said[0].role == "a<|" and [a.tokens for a in got[3].attachments] == [0, 0, 0]
    assert chat_parts.formatted(messages.limit(0)).count() == 0


def test_control_strings_come_back(spark):
    draw = random.Random(4)
    rows, want = [], defaultdict(list)
    for conv in range(40):
        for turn in range(draw.choice([1, 2, 60])):
            role = draw.choice(["user", "assistant", "a<|x", "r" + draw.choice(NASTY)])
            said = ["".join(draw.choice(NASTY) for _ in range(draw.randint(0, 6))) for _ in range(draw.randint(1, 3))]
            want[conv].append((role, said))
            rows.append((conv, turn, role, [part("text", s) for s in said]))
    draw.shuffle(rows)
    messages = spark.createDataFrame(rows, MESSAGES).repartition(9)
    for r in chat_parts.digested(chat_parts.formatted(messages)).collect():
        whole = "".join(f"{role}\n{''.join(said)}\n" for role, said in want[r.conv_id])
        loss = "".join("".join(said) for role, said in want[r.conv_id] if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and r.n_turns == len(want[r.conv_id])
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in chat_parts.read_back(chat_parts.formatted(messages)).collect():
        assert [[p.content for p in t.pieces] for t in r.said] == [said for _, said in want[r.conv_id]]


def test_repeated_turns_and_long_texts(spark):
    rows = [(5, 1, "user", "same", "kept")] * 3 + [(5, 0, "assistant", "x" * 200_000, "kept"), (5, None, "assistant", None, "kept"), (-8, 0, None, "q", "kept")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, parts string")
    got = {r.conv_id: r for r in chat_parts.digested(chat_parts.formatted(chat_parts.with_planted(table))).collect()}
    assert set(got) == {5, -7, -8} and got[5].n_turns == 5 and got[5].loss_chars == 200_000
    planted = chat_parts.PLANTED
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{planted}\nassistant\n{planted}\n".encode()).hexdigest()
    assert got[-7].loss_sha256 == hashlib.sha256(planted.encode()).hexdigest() and got[-7].loss_chars == len(planted)


def test_chat_formatting_is_native(spark, sf):
    """No Python worker takes part."""
    plan = queries.op13_chat_parts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|PythonUDF|mapIn", plan)
