"""Near copies, repeated lines and benchmark leaks against plain computations."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandsaw.llm import line_windows, queries, superminhash, templates
from oracle.check import connect, difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def plain_components(rows, k):
    """{row index: smallest id reachable} by comparing all pairs."""
    sets = [plain_set(t, k) for _, t in rows]
    near = defaultdict(set)
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            near[i].add(j)
            near[j].add(i)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = min(ids) if ids else None
    return sets, out


def compare(got, rows, k):
    sets, component = plain_components(rows, k)
    want = sorted(((r[0], len(sets[i]), component[i]) for i, r in enumerate(rows)), key=str)
    assert sorted(((r.key, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.key == r.component_id) for r in got)


def near_copies(n, seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = draw.choices(vocabulary, k=draw.choice([3, 8, 60, 300]))
        for _ in range(draw.choice([1, 1, 3, 9])):
            other = [w if draw.random() > 0.015 else draw.choice(vocabulary) for w in words]
            rows.append((len(rows) * 7 % 1009, " ".join(other)))
    return rows


def test_op2_query(spark, sf, documents):
    got = queries.op2_superminhash(spark, sf).withColumnRenamed("doc_id", "key").collect()
    compare(got, [(d.doc_id, d.text) for d in documents.collect()], 4)


def test_components_of_many_near_copies(spark):
    rows = near_copies(60)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    compare(superminhash.components(df).collect(), rows, 5)


def test_chains_and_a_large_group(spark):
    """Neighbours in a chain are linked, its ends are not; the group is one nevertheless."""
    base = [f"t{i}" for i in range(200)]
    chain = [" ".join(base[k * 6 :] + [f"n{i}" for i in range(k * 6)]) for k in range(30)]
    same = ["one text that is repeated over and over again here"] * 300
    rows = list(enumerate(chain + same))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    compare(superminhash.components(df).collect(), rows, 5)


@pytest.mark.parametrize("local_links", [0, 1 << 18])
def test_a_wide_group(spark, monkeypatch, local_links):
    """Copies of one text with ever more changes: many are near each other, many near none; in several small blocks."""
    draw = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(w if draw.random() > i % 40 / 500 else f"x{draw.randint(0, 99)}" for w in base)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    monkeypatch.setattr(superminhash, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(superminhash, "LOCAL_LINKS", local_links)
    got = superminhash.components(df, k=4).collect()
    compare(got, rows, 4)
    assert len({r.component_id for r in got}) > 20


def test_components_of_odd_documents(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    compare(superminhash.components(odd_documents).collect(), rows, 5)
    assert superminhash.components(odd_documents.limit(0)).count() == 0


def test_superminhash_estimates_and_stops_early():
    texts = ["a b c d e", " ".join(f"u{i}" for i in range(3000)), " ".join(f"u{i}" for i in range(300, 3300))]
    keys, count = superminhash.shingle_sets(pa.array(texts), 1)
    values = superminhash.signatures(keys, 3)
    share = (values[1] == values[2]).mean()
    assert abs(share - 2700 / 3300) < 0.12
    assert (values[1] >> 32).max() == 0 and count.tolist() == [5, 3000, 3000]
    # a plain rendering: one permutation per element, its j-th slot gets a value in [j, j + 1)
    element = keys[keys >> superminhash.ELEMENT_BITS == 0]
    want = np.full(superminhash.SIZE, np.iinfo(np.int64).max)
    for e in element.tolist():
        order = list(range(superminhash.SIZE))
        for j in range(superminhash.SIZE):
            x = int(superminhash.mix(np.array([(e + int(superminhash.STEP) * (j + 1)) % 2**64], np.uint64))[0])
            pick = j + ((x >> 32) * (superminhash.SIZE - j) >> 32)
            order[j], order[pick] = order[pick], order[j]
            want[order[j]] = min(want[order[j]], j << 32 | x & 0xFFFFFFFF)
    assert (values[0] == want).all()


def plain_lines(rows, window=3):
    """{(id, text): kept text} by looking at every window in order."""
    first, out = {}, {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = (text or "").split("\n") if text else []
        content = [i for i, x in enumerate(lines) if x.strip(" \t\r\f\v")]
        gone = set()
        for p in range(max(1, len(content) - window + 1) if content else 0):
            span = content[p : p + window]
            name = tuple(lines[i].strip(" \t\r\f\v") for i in span)
            if first.setdefault(name, (key, p, text)) != (key, p, text):
                gone |= set(span)
        out[key, text] = (text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(content), len(gone))
    return out


def test_op6_query(spark, sf):
    mine = queries.op6_line_windows(spark, sf).toPandas()
    assert difference(mine, connect(sf).execute(queries.ORACLE["op6_line_windows"]).df()) is None


def test_lines_of_odd_documents(spark, odd_documents):
    got = line_windows.drop_repeated(odd_documents).collect()
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    want = plain_lines(rows)
    assert sorted((str(r.doc_id), str(r.text), r.n_lines, r.n_removed, r.score) for r in got) == sorted((str(k[0]), str(want[k][0]), *want[k][1:], "kept") for k in rows)
    assert line_windows.drop_repeated(odd_documents.limit(0)).count() == 0


def test_overlapping_windows(spark):
    draw = random.Random(2)
    rows = [(i, "\n".join(draw.choice(["a", "b", " c ", "", "d e", "f"]) for _ in range(draw.randint(0, 12)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_windows.drop_repeated(df).collect()}
    assert got == {k[0]: v for k, v in plain_lines(rows).items()}


QUESTION = "A train leaves Boston at noon and travels 120 km in 2 hours while another leaves for Boston after 30 min of waiting"


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in templates.leaked_items(spark, docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()}


def test_reparameterised_questions(spark):
    before, behind = "Some words in front of it, with no end, then ", " and a lot of other words behind."
    texts = [
        before + QUESTION + behind,
        before + QUESTION.replace("120", "450").replace("Boston", "Denver").replace("30", "45") + behind,
        before + QUESTION.replace("for Boston", "for Denver") + behind,  # one name becomes two, all else is the same
        before + " ".join(QUESTION.split()[:7]) + behind,
        before + QUESTION.upper() + behind,
        QUESTION.replace(" ", "\n\t "),
        "5 6 7 8 9 10 11 12 13 14 15 16 17 18",
    ]
    got = found(spark, texts, [(70, QUESTION), (71, "too short to tell"), (72, None), (73, ""), (74, "1 2 3 4 5 6 7 8 9 10 11")])
    assert {k for k in got if k[0] != 4} == {(0, 70), (1, 70), (2, 70), (5, 70)}
    assert got[0, 70].changed == 0 and got[1, 70].changed >= 3
    assert got[2, 70].changed == 0 and got[2, 70].matched < got[2, 70].windows


def test_a_clash_costs_its_own_windows_only(spark):
    """Near-verbatim copies, with one of several occurrences of a value changed, and values that become equal."""
    rest = " the keeper counted every animal twice before the doors were closed and wrote the sums into a large book that nobody ever read again"
    item = "They brought 7 goats and 9 sheep and then 7 more goats came over from the hills" + rest
    apples = "A child holds 3 apples and 4 pears and gives 3 apples and then 4 pears to a friend who eats them all"
    texts = [
        item.replace("then 7", "then 8"),
        item.replace("7", "5").replace("9", "5"),
        apples.replace("3", "5").replace("4", "5"),
        "Nothing like it" + rest[:40],
        item,
    ]
    got = found(spark, texts, [(1, item), (2, apples)])
    assert set(got) == {(0, 1), (1, 1), (2, 2), (4, 1)}
    words = [t.split() for t in (item, texts[0])]
    grams = [[tuple(w[i : i + 8]) for i in range(len(w) - 7)] for w in words]
    # all that match word for word, those that hold the clashing value too
    same = {a for a, b in zip(*grams, strict=True) if a == b}
    assert got[0, 1].matched == len(same) and got[0, 1].changed == 0
    assert got[4, 1].matched == got[4, 1].windows == len(words[0]) - 7
    assert got[2, 2].changed == 2 and got[2, 2].matched == got[2, 2].windows


def test_items_without_template_windows(spark):
    """Exact copies of short items and of items of numbers and names are found, against a plain search for runs of words."""
    draw = random.Random(6)
    items = [(1, "What is 7 times 8?"), (2, "12 + 30 = 42 and 17 - 9 = 8 or 5 * 6 = 30 or 81 / 9 = 9"), (3, "Which is larger: Oslo Bergen Trondheim Stavanger Drammen Tromso Bodo Molde Hamar"), (4, "yes"), (5, "??"), (6, "name the sea")]
    texts = [f"Some words first, then {t} and others, which go on and on." for _, t in items if t != "??"]
    texts += [texts[1].replace("42", "43").replace("17", "18").replace("30", "31").replace("81", "82").replace("5 *", "4 *"), texts[0].replace("8", "9"), "the sea name", "What is", " ".join(["yes yes"] * 50)]
    texts += [" ".join(draw.choice(["7", "8", "times", "is", "What", "yes", "sea", "the", "name"]) for _ in range(12)) for _ in range(30)]

    def plain(text):
        return [x for w in text.split() if (x := re.sub(r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", w).lower())]

    def runs(text, n):
        w = plain(text)
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for i, t in enumerate(texts):
        for key, item in items:
            n = min(8, len(plain(item)))
            if n and 2 * len(runs(item, n) & runs(t, n)) >= len(runs(item, n)):
                want.add((i, key))
    got = found(spark, texts, items)
    assert set(got) == want and {(0, 1), (1, 2), (2, 3), (3, 4), (4, 6)} <= want
    assert (got[3, 4].matched, got[3, 4].windows, got[3, 4].changed) == (1, 1, 0)


def test_short_items_do_not_remove_documents_that_say_them(spark):
    texts = ["I said yes to all of it", "Yes!", "yes, yes", "What is 7 times 8?", "She asked: what is 7 times 8? Nobody knew, and they went home", None, ""]
    rows = [(i, t, "kept", "kept", "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __key string, __same_text string, key string")
    items = spark.createDataFrame([(1, "yes"), (2, "What is 7 times 8?")], "item_id bigint, text string")
    covers = {(r.key, r.item_id): r.covers for r in templates.leaks(docs, items).collect()}
    assert covers == {(0, 1): 1 / 7, (1, 1): 1.0, (2, 1): 0.5, (3, 2): 1.0, (4, 2): 5 / 13}
    got = templates.clean(docs, items)
    assert got.columns == docs.columns
    assert sorted(got.collect(), key=lambda r: r.doc_id) == [r for r in docs.collect() if r.doc_id in (0, 4, 5, 6)]
    assert templates.clean(docs, items.limit(0)).count() == len(texts)


def test_items_of_one_id_are_judged_apart(spark):
    """Three texts under one id, or under none; a document that holds one of them whole is a leak."""
    three = [" ".join(f"{c}{w}" for w in "abcdefghijklmnop") for c in "xyz"]
    texts = ["before it " + three[1] + " behind it", "nothing of them is in here at all, not even in part"]
    got = found(spark, texts, [(5, t) for t in three] + [(None, t) for t in three])
    assert {k: (r.matched, r.windows) for k, r in got.items()} == {(0, 5): (9, 9), (0, None): (9, 9)}


def test_leaks_of_odd_documents(spark, odd_documents):
    items = spark.createDataFrame([(1, " ".join(f"word{i % 977} of{i % 13}" for i in range(100, 140))), (None, "an item without an id that nothing holds at all, really")], "item_id bigint, text string")
    items = items.selectExpr("*", "'kept' AS doc_id", "'kept' AS h")
    got = templates.leaks(odd_documents, items).collect()
    assert {r.key for r in got} <= {5, 6}
    left = templates.clean(odd_documents, items)
    assert left.columns == odd_documents.columns and left.count() == 12 - len({r.key for r in got})
    for a, b in ((odd_documents.limit(0), items), (odd_documents, items.limit(0))):
        assert templates.leaks(a, b).count() == 0


def test_op8_query_finds_every_passage(spark, documents, sf):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.op8_benchmark_templates(spark, sf).collect()}
    grams = defaultdict(set)
    word = re.compile(r"\w+")
    for key, text in items.items():
        w = word.findall(text.lower())
        for i in range(len(w) - 7):
            grams[tuple(w[i : i + 8])].add(key)
    want = set()
    for d in documents.collect():
        w = word.findall(d.text.lower())
        want |= {(d.doc_id, key) for i in range(len(w) - 7) for key in grams.get(tuple(w[i : i + 8]), ())}
    assert got == want


@pytest.mark.parametrize("text,kinds", [("In 5 km, Mr Smith saw 3 cats. The end", [0, 1, 3, 2, 2, 0, 1, 0, 0, 0])])
def test_kinds_of_words(text, kinds):
    words = templates.Canonical(pa.array([text]), templates._unit_hashes())
    assert words.kind.tolist() == kinds


def test_texts_are_sent_few_times(spark, monkeypatch):
    """Near copies that fall apart, beside other texts: what blocks exchange stays within twice the input."""
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [draw.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(3000):
        copy = list(base)
        for _ in range(draw.choice([1, 2, 3, 4])):
            copy[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
        rows.append((10_000 + i, " ".join(draw.choice(vocabulary) for _ in range(120))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    sent = []

    def measured(meetings, k, share):
        sent.append(meetings.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
        return probed(meetings, k, share)

    probed = superminhash._probed
    monkeypatch.setattr(superminhash, "_probed", measured)
    got = superminhash.components(docs, k=5).collect()
    assert len(got) == 6000 and 3000 < sum(r.kept for r in got) < 5500
    assert sent[0] <= 2 * sum(len(t) for _, t in rows)


def test_swapped_words_are_no_copies(spark):
    """Texts of one word each, doubled and swapped, share nothing."""
    a, b = "a", "b"
    rows = []
    while len(a) < 4096:
        a, b = a + b, b + a
        rows += [(len(rows), a), (len(rows) + 1, b)] if len(a) >= 1024 else []
    got = superminhash.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(rows) == 6 and all(r.kept and r.n_shingles == 1 for r in got)


def test_two_hashes_tell_sets_apart(spark, monkeypatch):
    """Sets whose first hashes agree stay nodes of their own."""
    real = superminhash.set_ids
    monkeypatch.setattr(superminhash, "set_ids", lambda keys, count: (real(keys, count)[0] * 0, real(keys, count)[1]))
    rows = [(i, f"text number {i} of its own with words {i * i} and more {i + 7}") for i in range(12)] + [(20, "text number 3 of its own with words 9 and more 10")]
    got = {r.key: r for r in superminhash.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[20].component_id == 3 and sum(r.kept for r in got.values()) == 12
