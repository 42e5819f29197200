"""URLs, languages, nearest neighbours and archives."""

import base64
import gzip
import hashlib
import io
import math
import random
import zlib

import numpy as np
import pytest
import regex

from bandsaw.llm import langid, permutation_index, queries, url_templates, warc
from bandsaw.llm.shards import new_folder, saved
from oracle.check import connect
from tests.helpers import shuffled_bytes


def same_rows(mine, theirs):
    def rows(table):
        return sorted(str([None if v is None or v != v else v for v in r.values()]) for r in table.to_pylist())

    assert sorted(mine.column_names) == sorted(theirs.column_names)
    assert rows(mine.select(sorted(mine.column_names))) == rows(theirs.select(sorted(theirs.column_names)))


@pytest.mark.parametrize("name", ["op1_url_templates", "op9_warc"])
def test_query_equals_sql(spark, sf, name):
    same_rows(queries.QUERIES[name](spark, sf).toArrow(), connect(sf).execute(queries.ORACLE[name]).to_arrow_table())


URLS = {
    1: ("HTTP://Www.Example.ORG:80/es/x?a=/b#c", "www.example.org:80", "/es/x", None, None),
    2: ("http://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
    3: ("https://A.example.org/en/17#top", "a.example.org", "/en/17", "example.org/en/1", "block"),
    4: ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    5: ("x://notorg/", "notorg", "/", None, "allow"),
    6: ("x://shop.com/fr/a", "shop.com", "/fr/a", "com/fr/", "allow"),
    7: ("x://com/de/", "com", "/de/", "com/de/", "block"),
    8: ("x://example.org", "example.org", "", None, "allow"),
    9: ("no url", "", "", None, "allow"),
    10: (None, "", "", None, "allow"),
    11: ("", "", "", None, "allow"),
    12: ("a://b://c/d", "b:", "//c/d", None, "allow"),
    13: ("http://example.org?x://y/z", "example.org", "", None, "allow"),
    14: ("http://host.net/" + "/".join("abcdefghijkl") + "/" + "y" * 5000, "host.net", None, None, "allow"),
}


def test_hosts_paths_and_rules(spark):
    rows = [(k, v[0], "kept", "kept") for k, v in URLS.items()] * 2 + [(None, "x://h.net/a", "kept", "kept")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, template string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "key bigint, bad int")
    got = url_templates.judged(pages, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None and r.page_id != 1:
            _, host, path, rule, verdict = URLS[r.page_id]
            assert (r.host, r.rule, r.verdict) == (host, rule, verdict), r
            assert path is None or r.path == path
    assert url_templates.judged(pages.limit(0), labels).count() == 0
    assert url_templates.judged(pages, labels.limit(0)).filter("purity IS NOT NULL").count() == 0


def test_bad_branches_are_rejected_and_like_ones_merged(spark):
    pages, labels = [], []
    for i in range(400):
        section = ["spam", "news", "blog", "misc"][i % 4]
        pages.append((i, f"http://h.net/{section}/{i}/view"))
        labels.append((i, int(section == "spam")))
    pages += [(1000 + i, f"http://h.net/spam/{9000 + i}/view") for i in range(5)]
    got = url_templates.judged(spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(labels, "key bigint, bad int")).collect()
    assert {r.verdict for r in got if "/spam/" in r.path} == {"block"}
    assert {r.verdict for r in got if "/spam/" not in r.path} == {"allow"}
    assert {r.template for r in got} == {"/*0/{n}/view", "/spam/{n}/view"}


def plain_templates(pages, labels):
    """(path: template) of one host, by recursion over plain lists."""

    def apart(l, b, l2, b2):
        if not l or not l2:
            return False
        p = (b + b2) / (l + l2)
        return (b / l - b2 / l2) ** 2 > 6.635 * p * (1 - p) * (1 / l + 1 / l2)

    out = {}

    def sums(rows):
        known = [labels[k] for k, *_ in rows if k in labels]
        return len(known), sum(known)

    def divide(rows, template):
        for _, path, rest in rows:
            if not rest:
                out[path] = template
        rows = [r for r in rows if r[2]]
        if len(rows) < 8:
            out.update((path, template + "/**") for _, path, _ in rows)
            return
        children = {}
        for r in rows:
            children.setdefault(r[2][0], []).append((r[0], r[1], r[2][1:]))
        merged, outstanding = {}, []
        for name, mine in children.items():
            others = [r for n in children if n != name for r in children[n]]
            if name.startswith("{") or len(children) == 1:
                merged[name] = mine
            elif len(mine) >= 8 and apart(*sums(mine), *sums(others)):
                l, b = sums(mine)
                outstanding.append((10 * b // l, name))
            else:
                merged.setdefault("*", []).extend(mine)
        last, runs = None, []
        for tenth in sorted({t for t, _ in outstanding}):
            names = [n for t, n in outstanding if t == tenth]
            known = sums([r for n in names for r in children[n]])
            if last is None or apart(*known, *last):
                runs.append((tenth, []))
            runs[-1][1].extend(names)
            last = known
        for lowest, names in runs:
            merged[names[0] if len(names) == 1 else f"*{lowest}"] = [r for n in names for r in children[n]]
        for name, mine in merged.items():
            divide(mine, f"{template}/{name}")

    divide([(k, path, ["{n}" if s.isdigit() else s for s in path[1:].split("/")]) for k, path in pages], "")
    return out


def verdicts(spark, pages, labels):
    urls = [(k, f"http://h.net{path}") for k, path in pages]
    return url_templates.judged(spark.createDataFrame(urls, "page_id bigint, url string"), spark.createDataFrame(list(labels.items()), "key bigint, bad int")).collect()


def letters(i):
    return "".join(chr(97 + int(d)) for d in str(i))


def test_children_of_merged_branches_are_one_node(spark):
    """Names of two pages each: one good, one bad; the bad ones are a branch below ``*``."""
    pages = [(2 * i + k, f"/{letters(i)}/{name}") for i in range(300) for k, name in enumerate(["about", "spam"])]
    got = verdicts(spark, pages, {k: k % 2 for k, _ in pages})
    assert {(r.template, r.verdict) for r in got} == {("/*/about", "allow"), ("/*/spam", "block")}


def test_like_branches_merge_and_deep_paths_are_read_whole(spark):
    rare = [(i, f"/{letters(i % 30)}/{i}") for i in range(360)]  # bad names of twelve pages: too few to be rejected alone
    deep = [(1000 + i, "/deep" + "/d" * 12 + ("/good" if i % 2 else "/ill") + "/x" * 5) for i in range(200)]
    labels = {k: int(k % 30 < 6) for k, _ in rare} | {k: int(k % 2 == 0) for k, _ in deep}
    got = verdicts(spark, rare + deep, labels)
    assert {r.verdict for r in got if r.page_id < 1000 and r.page_id % 30 < 6} == {"block"}
    assert {r.verdict for r in got if r.page_id < 1000 and r.page_id % 30 >= 6} == {"allow"}
    assert all(r.verdict == ("allow" if r.page_id % 2 else "block") for r in got if r.page_id >= 1000)


def test_templates_equal_a_plain_recursion(spark):
    draw = random.Random(4)
    names = ["a", "b", "c", "spam", "list", "*", "", "17", "9"]
    shares = {n: draw.random() for n in names}
    pages, labels = [], {}
    for k in range(3000):
        path = [draw.choice(names[: 9 - d]) for d in range(draw.randint(1, 5))]
        pages.append((k, "/" + "/".join(path)))
        if draw.random() < 0.7:
            labels[k] = int(draw.random() < shares[path[-1]] * shares[path[0]] * 2)
    want = plain_templates([(k, p.replace("*", "{s}")) for k, p in pages], labels)
    got = {r.path: r.template for r in verdicts(spark, pages, labels)}
    assert got == {p: want[p.replace("*", "{s}")] for _, p in pages}


def test_op3_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op3_error_correcting_codes(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and len(held) > 20
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    changed = documents.withColumn("lang", url_templates.F.when(langid.held_out(), url_templates.F.lit("xx")).otherwise(url_templates.F.col("lang")))
    changed = changed.withColumn("source", url_templates.F.lit("none"))
    rows = [sorted(map(tuple, langid.predicted(d).collect())) for d in (documents, changed)]
    assert rows[0] == rows[1]


def test_languages_of_odd_documents(spark, odd_documents):
    model = langid.train(odd_documents)
    got = langid.predict(odd_documents, model).collect()
    assert len(got) == 12
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr")
        assert r.n_lines == "kept"
    nothing = odd_documents.limit(0)
    assert langid.train(nothing) is None
    assert {r.lang_pred for r in langid.predict(odd_documents, None).collect()} == {"und"}
    assert langid.predict(nothing, model).count() == 0
    one = langid.train(odd_documents.filter("lang = 'en'"))
    assert {r.lang_pred for r in langid.predict(odd_documents, one).collect()} == {"en", "und"}


def test_codewords_are_apart():
    for n in (2, 4, 9, 40):
        code = langid.codewords(n)
        assert ((code.sum(axis=0) > 0) & (code.sum(axis=0) < n)).all()
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(apart) >= 5


def plain_neighbours(rows, k=5):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in usable:
        if i % 50 == 0:
            scores = [(-float(q @ c / np.sqrt((q @ q) * (c @ c))), j) for j, c in usable if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def test_op7_recall(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = plain_neighbours([(r.vec_id, r.embedding) for r in table.collect()])
    got = {}
    for r in queries.op7_permutation_index(spark, sf).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(x) == [1, 2, 3, 4, 5] for x in got.values())
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, found in got.items():
        assert [found[i][1] for i in sorted(found)] == sorted((x[1] for x in found.values()), reverse=True)
        scores = dict(want[q])
        assert all(abs(scores[v] - s) < 1e-12 for v, s in found.values() if v in scores)


def test_vectors_with_ties_and_gaps(spark):
    draw = np.random.default_rng(0)
    same = draw.normal(size=4).tolist()
    rows = [(i, same) for i in range(40, 140)] + [(200 + i, draw.normal(size=4).tolist()) for i in range(60)]
    rows += [(300, None), (350, [0.0] * 4), (400, [1.0, None, 2.0, 3.0]), (450, [1.0, float("nan"), 2.0, 3.0]), (500, [float("inf")] * 4)]
    rows += [(550, [1.0, 2.0]), (600, []), (None, same)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'kept' AS v", "'kept' AS ids", "'kept' AS block")
    got = {}
    for r in permutation_index.search(df.repartition(6), lambda i: i % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = plain_neighbours([r for r in rows if r[0] not in (550, 600)])
    assert set(got) == set(want)
    for q, best in want.items():
        assert [v for _, v, _ in sorted(got[q])] == [v for v, _ in best]
    assert [v for _, v, _ in sorted(got[50])] == [40, 41, 42, 43, 44]
    assert permutation_index.search(df.limit(0), lambda i: i % 50 == 0).count() == 0
    two = permutation_index.search(df.filter("vec_id IN (100, 201)"), lambda i: i % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in two] == [(100, 1, 201)]


def test_op7_sends_a_query_to_lanes_and_not_to_every_block(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(6000, 4)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    settings = dict(pivots=16, prefix=8, block=64)
    found = permutation_index.search(df, lambda i: i % 2 == 0, **settings)
    best = sorted(map(tuple, found.collect()))
    assert len(best) == 3000 * 5
    tasks = max(8, 2 * spark.sparkContext.defaultParallelism)
    assert max(shuffled_bytes(found)) < 150 * (6000 + tasks * 3000)  # 94 blocks
    # neither the number of lanes nor how queries are cut shows in the result
    for held, queries_at_once in ((1, 100), (1 << 13, 7)):
        monkeypatch.setattr(permutation_index, "HELD", held)
        monkeypatch.setattr(permutation_index, "QUERIES", queries_at_once)
        some = permutation_index.search(df, lambda i: i % 50 == 0, **settings).collect()
        assert sorted(map(tuple, some)) == [r for r in best if r[0] % 50 == 0]
    exact = permutation_index.search(df, lambda i: i % 50 == 0, reranked=1.0, **settings).collect()
    want = {(q, rank, v) for q, near in plain_neighbours(rows).items() for rank, (v, _) in enumerate(near, 1)}
    assert {(r.query_id, r.rank, r.vec_id) for r in exact} == want


def test_archives_of_odd_pages(spark):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 40_000), (1, "u", "same"), (None, "u", "same"), (None, "u", "own"), (9, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'kept' AS payload", "'kept' AS digest", "'kept' AS first")
    got = warc.archived(spark, pages).collect()
    seen = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in got)
    assert seen == sorted([("1", "response", "None", 4), ("1", "response", "None", 4), ("2", "revisit", "1", 4), ("None", "revisit", "1", 4), ("3", "response", "None", 0), ("4", "revisit", "3", 0), ("5", "response", "None", 80_000), ("None", "response", "None", 3), ("9", "response", "None", 6)])
    assert all(r.verified for r in got)
    digest = base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert {r.payload_digest for r in got if r.payload_bytes == 4} == {digest}
    assert warc.archived(spark, pages.limit(0)).count() == 0
    alone = warc.archived(spark, pages, least=5).collect()
    assert sum(r.record_type == "revisit" for r in alone) == 0


def test_payloads_come_back_from_several_files(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 500) for i in range(40)], "page_id bigint, url string, html string")
    manifest = saved(warc.write_warc(pages, new_folder(spark, "warc"), file_bytes=20_000), "manifest")
    assert manifest.count() >= 8
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_warc(manifest).collect()}
    assert got == {i: f"page {i} " * 500 for i in range(40)}


def test_reader_frames_and_verifies():
    one = warc.record(1, "u", b"payload" * 9000, None, False, "1970-01-01T00:00:00Z")
    two = warc.record(2, None, b"payload", 1, True, "1970-01-01T00:00:00Z")
    data = gzip.compress(one) + gzip.compress(two)
    for step in (1, 7, 64 << 10):
        records = list(warc.SequentialReader(io.BytesIO(data if step > 1 else gzip.compress(two)), step))
        assert [r.errors for r in records] == [[]] * len(records)
    first, second = warc.SequentialReader(io.BytesIO(data))
    assert first.payload == b"payload" * 9000 and second.fields["warc-type"] == "revisit"
    together = list(warc.SequentialReader(io.BytesIO(gzip.compress(one + two))))
    assert "gzip member" in together[0].errors and len(together) == 2
    broken = one.replace(b"payloadpayload", b"payloadPayload", 1)
    assert list(warc.SequentialReader(io.BytesIO(gzip.compress(broken))))[0].errors == ["block digest", "payload digest"]
    for cut in (data[:-20], data[:100]):
        with pytest.raises(ValueError):
            list(warc.SequentialReader(io.BytesIO(cut)))
    with pytest.raises(ValueError):
        list(warc.SequentialReader(io.BytesIO(gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"))))
    assert list(warc.SequentialReader(io.BytesIO(b""))) == []


def plain_grams(text):
    """Counts of hashed byte 2- and 3-grams, letter by letter."""
    data, letters = bytearray(), []
    for c in text:
        is_letter = regex.match(r"\p{L}", c) is not None
        if is_letter or (letters and letters[-1]):
            part = (c.lower() if c.isascii() else c).encode() if is_letter else b" "
            data += part
            letters += [is_letter] * len(part)
    data += b" "
    letters.append(False)
    counts = {}
    for size in (2, 3):
        for i in range(len(data) - size + 1):
            if letters[i] or letters[i + size - 1]:
                gram = 0
                for byte in data[i : i + size]:
                    gram = gram * 257 + byte
                slot = ((gram + size) * 2654435761 % 2**32) >> 20
                counts[slot] = counts.get(slot, 0) + 1
    return counts, any(letters)


def test_op3_against_a_plain_rendering(spark, sf):
    """Counts, weights of the bits, trust and loss, written out; every document of the table."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    grams = {d.doc_id: plain_grams(d.text or "") for d in docs}
    learned = [d for d in docs if d.lang is not None and zlib.crc32(str(d.doc_id).encode()) % 5]
    languages = sorted({d.lang for d in learned})
    code = langid.codewords(len(languages))
    n_bits = code.shape[1]
    ones = [{} for _ in range(n_bits)]
    zeros = [{} for _ in range(n_bits)]
    for d in learned:
        for b in range(n_bits):
            side = (ones if code[languages.index(d.lang)][b] else zeros)[b]
            for slot, n in grams[d.doc_id][0].items():
                side[slot] = side.get(slot, 0) + n
    totals = [[sum(x.values()) + langid.SMOOTHING * langid.FEATURES for x in side] for side in (ones, zeros)]

    def margin(counts, b):
        said = 0.0
        for slot, n in counts.items():
            p, q = ((side[b].get(slot, 0) + langid.SMOOTHING) / total[b] for side, total in zip((ones, zeros), totals, strict=True))
            said += n * (math.log(p) - math.log(q))
        return said / max(1, sum(counts.values()))

    margins = {i: [margin(counts, b) for b in range(n_bits)] for i, (counts, _) in grams.items()}
    tried = [d for d in learned if grams[d.doc_id][1]]
    scale = [sum(abs(margins[d.doc_id][b]) for d in tried) / len(tried) for b in range(n_bits)]
    trust = []
    for i, name in enumerate(languages):
        mine = [margins[d.doc_id] for d in tried if d.lang == name]
        right = [max(0.01, sum((m[b] > 0) == (code[i][b] == 1) for m in mine) / len(mine)) for b in range(n_bits)]
        trust.append([r / sum(right) for r in right])
    got = {r.doc_id: r for r in queries.op3_error_correcting_codes(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        row = got[d.doc_id]
        assert row.held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        if not grams[d.doc_id][1]:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        losses = []
        for i, name in enumerate(languages):
            agreed = [margins[d.doc_id][b] / scale[b] * (1 if code[i][b] else -1) for b in range(n_bits)]
            losses.append((sum(t * math.exp(-2 * min(4, max(-4, a))) for t, a in zip(trust[i], agreed, strict=True)), name))
        (first, name), (second, _) = sorted(losses)[:2]
        assert row.score == pytest.approx(second / (first + second), abs=2e-4)
        assert row.lang_pred == name or second - first < 1e-4 * second
