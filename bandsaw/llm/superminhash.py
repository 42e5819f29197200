"""Near-duplicate groups by SuperMinHash, banding, verification on full sets and union-find.

A text's set holds its distinct ``k``-word shingles (fewer words: all of them as
one). SuperMinHash gives every element a random permutation of the ``SIZE`` slots; its
j-th slot gets a value in [j, j + 1). Stage j is done for all elements of a chunk
at once, and a text is ready when no slot holds j + 1 or more, which later stages
could lower. Bands of ``ROWS`` slots make buckets.

Equal sets (by two hashes) are one node. In a bucket members are first compared with its
smallest node, then those that stay apart from the largest group with one of that group. What
is still apart is dealt to blocks, groups that share buckets side by side, and two
blocks meet if they share a bucket: a task holds an inverted index of their full sets and
probes it with the outsiders, so that no link between two members of a bucket is lost,
pairs never become rows, and a text is sent once for each block that its own must meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsaw.llm.shards import frugal, passing, saved
from bandsaw.llm.text import chunks, joined, lowered, mix, per_row, rows_of, segment_hashes, words
from bandsaw.operators.graph import star_components
from bandsaw.operators.skew import lookup
from bandsaw.session import cut_lineage, shuffle_partitions

SHINGLE = 5
SHARE = (4, 5)  # a link needs SHARE[1] * intersection >= SHARE[0] * union
SIZE = 128
ROWS = 4
EXTRA_ROUNDS = 1
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 2048  # about, of a block of members or of outsiders
PIECE_ROWS, PIECE_BYTES = 2048, 8 << 20
FOREST_NODES = 1 << 20
LOCAL_LINKS = FOREST_NODES // 4  # a forest of so many edges is one small task; results do not depend on it
ROW_BITS = 14
ELEMENT_BITS = np.uint64(64 - ROW_BITS)
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row << 50 | 50-bit element, ascending and distinct; elements per row) of at most 2^14 texts."""
    buffer, row_starts, _ = joined(column)
    buffer = lowered(buffer)
    starts, ends = words(buffer)
    n = row_starts.size
    if n > 1 << ROW_BITS:
        raise ValueError(f"more than {1 << ROW_BITS} texts at once")
    row = rows_of(starts, row_starts)
    word = segment_hashes(buffer, starts, ends)
    first, count = per_row(row, n)
    shingles = np.where(count > 0, np.maximum(1, count - k + 1), 0)
    of_row = np.repeat(np.arange(n), shingles)
    begin = np.repeat(first - (np.cumsum(shingles) - shingles), shingles) + np.arange(int(shingles.sum()))
    length = np.minimum(k, count)[of_row]
    h = mix(length.astype(np.uint64) + STEP)
    for j in range(k):
        used = j < length
        at = begin[used] + j
        h[used] = mix(h[used] * STEP + word[at])
    keys = np.unique(of_row.astype(np.uint64) << ELEMENT_BITS | h >> np.uint64(ROW_BITS))
    return keys, np.bincount((keys >> ELEMENT_BITS).astype(np.int64), minlength=n)


def signatures(keys: np.ndarray, n: int, size: int = SIZE) -> np.ndarray:
    """(n, size) SuperMinHash values; a slot's value is stage << 32 | 32 random bits. Empty sets keep the greatest value."""
    values = np.full(n * size, np.iinfo(np.int64).max, np.int64)
    element = keys & ((np.uint64(1) << ELEMENT_BITS) - np.uint64(1))
    base = (keys >> ELEMENT_BITS).astype(np.int64) * size
    places = None
    for stage in range(size):
        if not element.size:
            break
        x = mix(element + np.uint64(int(STEP) * (stage + 1) % 2**64))
        pick = stage + ((x >> np.uint64(32)) * np.uint64(size - stage) >> np.uint64(32)).astype(np.int64)
        if stage == 0:
            slot = pick
        else:
            if places is None:  # after the first stage: slot 0 was exchanged with the first pick
                places = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.int32), (element.size, 1))
                one = np.arange(element.size)
                places[one, before] = 0
                places[one, 0] = before
            one = np.arange(element.size)
            slot = places[one, pick].astype(np.int64)
            places[one, pick] = places[one, stage]
            places[one, stage] = slot
        np.minimum.at(values, base + slot, (x & np.uint64(0xFFFFFFFF)).astype(np.int64) | np.int64(stage) << 32)
        open_rows = values.reshape(n, size).max(axis=1) >> 32 > stage
        left = open_rows[base // size]
        if stage == 0:
            element, base, before = element[left], base[left], pick[left]
        elif np.count_nonzero(left) < 0.7 * left.size:
            element, base, places = element[left], base[left], places[left]
    return values.reshape(n, size)


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(n, size // rows) bucket keys; the band's number is part of the hash."""
    n, size = values.shape
    count = size // rows
    parts = values[:, : count * rows].reshape(n, count, rows).astype(np.uint64)
    h = np.broadcast_to(mix(np.arange(1, count + 1, dtype=np.uint64)), (n, count)).copy()
    for j in range(rows):
        h = mix(h * STEP + parts[:, :, j])
    return h.view(np.int64)


def set_ids(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set, free of order."""
    element = keys & ((np.uint64(1) << ELEMENT_BITS) - np.uint64(1))
    held = np.flatnonzero(count)
    one, two = np.zeros(count.size, np.uint64), np.zeros(count.size, np.uint64)
    if held.size:
        starts = (np.cumsum(count) - count)[held]
        one[held] = mix(np.add.reduceat(mix(element ^ STEP), starts) + count[held].astype(np.uint64))
        two[held] = mix(np.bitwise_xor.reduceat(mix(element + STEP), starts) + np.uint64(1))
    return one.view(np.int64), two.view(np.int64)


def _parts(batch: pa.RecordBatch, *texts: str) -> Iterator[pa.RecordBatch]:
    """Slices of bounded bytes and rows."""
    for part in chunks(batch, texts[0]):
        for other in chunks(part, texts[-1]):
            for first in range(0, other.num_rows, 1 << ROW_BITS):
                yield other.slice(first, 1 << ROW_BITS)


SIGNED = "key bigint, same_text bigint, n_shingles bigint, node bigint, check bigint, bands array<bigint>"


def signed(docs: DataFrame, key: str, text: str, k: int, size: int = SIZE, rows: int = ROWS) -> DataFrame:
    """One row per document: set size, the set's hashes (``node`` and ``check``) and its bucket keys."""
    names = [x.split()[0] for x in SIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "text"):
                keys, count = shingle_sets(part.column("text"), k)
                n = count.size
                made = bands(signatures(keys, n, size), rows)
                made = made[count > 0]
                lists = np.concatenate([[0], np.cumsum(np.where(count > 0, size // rows, 0))]).astype(np.int32)
                one, two = set_ids(keys, count)
                columns = [part.column("key"), part.column("same_text"), pa.array(count), pa.array(one), pa.array(two)]
                columns.append(pa.ListArray.from_arrays(pa.array(lists), pa.array(made.ravel())))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("same_text"), F.col(text).alias("text")).mapInArrow(frugal(run), SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """The (u, v) of ``pairs`` whose full sets reach ``share``; ``texts`` is (node, text)."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "a", "b"):
                one, n = shingle_sets(part.column("a"), k)
                two, m = shingle_sets(part.column("b"), k)
                all_ = np.sort(np.concatenate([one, two]))
                common = all_[1:][all_[1:] == all_[:-1]]
                met = np.bincount((common >> ELEMENT_BITS).astype(np.int64), minlength=n.size)
                linked = pa.array(share[1] * met >= share[0] * (n + m - met))
                yield part.select(["u", "v"]).filter(linked)

    return both.mapInArrow(frugal(run), "u bigint, v bigint")


def local_forests(edges: DataFrame, roots: bool = False) -> DataFrame:
    """Edges (u, v) as (node, smallest node of its tree) by union-find in each task; the components stay the same.

    With ``roots`` the smallest nodes have rows too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        def forest() -> pa.RecordBatch:
            pairs = [(x, root(x)) for x in list(parent)]
            pairs = pairs if roots else [p for p in pairs if p[0] != p[1]]
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > FOREST_NODES:  # a forest of what was read so far; the next one begins anew
                yield forest()
                parent.clear()
        yield forest()

    return edges.select("u", "v").mapInArrow(frugal(run), "u bigint, v bigint")


def grouped(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links``; the label is the smallest node of the component.

    The forests of all tasks are joined by one more union-find if they have at most
    ``LOCAL_LINKS`` edges together, and by star contraction, in rounds of joins, if they have more.
    """
    forest = cut_lineage(local_forests(links))
    if forest.count() <= LOCAL_LINKS:
        return cut_lineage(local_forests(forest.coalesce(1), roots=True)).toDF("node", "label")
    return star_components(forest.withColumn("graph", F.lit(0)), "graph").select("node", F.col("root").alias("label"))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))


def _open_members(members: DataFrame) -> DataFrame:
    """Members (bucket, node, label, main) of buckets with several labels; ``main`` is the label with the most members."""
    sizes = members.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    several = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels"))
    return lookup(members, several.filter("labels > 1").drop("labels"), ["bucket"])


def _meetings(open_: DataFrame, texts: DataFrame, keep) -> DataFrame:
    """(i, j, b, probe, node, label, text): the open members of blocks that must meet; ``b`` is the row's own of both.

    Of two members of a bucket with different labels one at least is an outsider, a
    ``probe``: its label is not the bucket's main one. Labels that share buckets
    form a union; its small labels are dealt whole to blocks of the union, large ones to blocks of their own.
    """
    outside = F.max(F.col("label") != F.col("main")).alias("probe")
    nodes = open_.groupBy("node", "label").agg(outside).join(texts.select("node", "n"), "node")
    unions = grouped(open_.filter("label <> main").select(F.col("main").alias("u"), F.col("label").alias("v")).distinct())
    blocks = F.ceil((F.sum("n") + 1) / BLOCK_BYTES + F.count("*") / BLOCK_ROWS).cast("int")
    sizes = nodes.groupBy("label").agg(blocks.alias("blocks"), F.sum("n").alias("n"), F.count("*").alias("rows"))
    sizes = sizes.join(unions.withColumnsRenamed({"label": "union", "node": "label"}), "label")
    shared = sizes.filter("blocks = 1").groupBy("union").agg(F.ceil((F.sum("n") + 1) / BLOCK_BYTES + F.sum("rows") / BLOCK_ROWS).cast("int").alias("shared"))
    sizes = sizes.join(shared, "union", "left").select("label", "union", "blocks", "shared")
    own = F.xxhash64(F.lit(1), F.col("label"), F.pmod(F.xxhash64("node"), F.col("blocks")))
    common = F.xxhash64(F.lit(2), F.col("union"), F.pmod(F.xxhash64("label"), F.col("shared")))
    placed = lookup(nodes, sizes, ["label"]).select("node", "label", "probe", F.when(F.col("blocks") > 1, own).otherwise(common).alias("b"))
    placed = keep(placed, "placed")
    members = open_.select("bucket", "node", F.col("label") != F.col("main")).toDF("bucket", "node", "outside").join(placed.select("node", "b"), "node")
    members = members.groupBy("bucket", "b").agg(F.max("outside").alias("outside"))
    met = members.filter("outside").select("bucket", F.col("b").alias("x")).join(members.select("bucket", F.col("b").alias("y")), "bucket")
    met = met.select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")).distinct()
    both = met.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("b"))
    rows = placed.join(texts.select("node", "text"), "node").join(both, "b")
    return rows.select("i", "j", "b", "probe", "node", "label", "text")


def _linked(probe: np.ndarray, member: np.ndarray, sets: list[np.ndarray], node: np.ndarray, label: np.ndarray, block: np.ndarray, share: tuple[int, int]) -> list[tuple[int, int]]:
    """Links of each probe to members of other labels, one for every label, by an inverted index of the members.

    Where two blocks meet, a probe is compared with the other block; where a block meets itself, with all of it.
    """
    if not probe.size or not member.size:
        return []
    apart = np.unique(block[member]).size > 1
    element = np.concatenate([sets[m] for m in member])
    size = np.array([sets[m].size for m in member])
    owner = np.repeat(np.arange(member.size), size)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    out = []
    for p in probe.tolist():
        low = np.searchsorted(element, sets[p], side="left")
        n = np.searchsorted(element, sets[p], side="right") - low
        found = owner[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        met = np.bincount(found, minlength=member.size)
        other = label[member] != label[p]
        if apart:
            other &= block[member] != block[p]
        near = np.flatnonzero((share[1] * met >= share[0] * (size + sets[p].size - met)) & other)
        for one in {int(label[member[q]]): int(member[q]) for q in near.tolist()}.values():
            out.append((int(node[p]), int(node[one])))
    return out


def _probed(meetings: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """The links (u, v) found in the meetings."""
    parts = shuffle_partitions(meetings.sparkSession)
    ordered = meetings.repartition(parts, "i", "j").sortWithinPartitions("i", "j")

    def solve(piece: pa.Table) -> pa.RecordBatch:
        keys, count = shingle_sets(piece.column("text").combine_chunks(), k)
        element = keys & ((np.uint64(1) << ELEMENT_BITS) - np.uint64(1))
        sets = np.split(element, np.cumsum(count)[:-1])
        node, label, probe, block = (piece.column(c).to_numpy() for c in ("node", "label", "probe", "b"))
        out: list[tuple[int, int]] = []
        edges = _edges(piece)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            rows = np.arange(a, b)
            out += _linked(rows[probe[a:b]], rows, sets, node, label, block, share)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole groups and the unfinished last one
        rows = size = 0
        for batch in batches:
            edges = _edges(batch)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                if held and (rows >= PIECE_ROWS or size >= PIECE_BYTES) and _key(held[-1], -1) != _key(part, 0):
                    yield solve(pa.Table.from_batches(held))
                    held, rows, size = [], 0, 0
                held.append(part)
                rows += b - a
                size += pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0
        if held:
            yield solve(pa.Table.from_batches(held))

    return ordered.mapInArrow(frugal(run), "u bigint, v bigint")


def _key(rows: pa.RecordBatch, at: int) -> list:
    at = at % rows.num_rows
    return [rows.column(c)[at].as_py() for c in ("i", "j")]


def _edges(rows: pa.RecordBatch | pa.Table) -> list[int]:
    """Where groups begin, and the end."""
    n = rows.num_rows
    if not n:
        return [0]
    new = np.zeros(n, bool)
    new[0] = True
    for c in ("i", "j"):
        values = rows.column(c).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(c).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return [*np.flatnonzero(new).tolist(), n]


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, share: tuple[int, int] = SHARE, size: int = SIZE, rows: int = ROWS) -> DataFrame:
    """(key, same_text, n_shingles, component_id, kept), one row per row of ``docs``; ``same_text`` is a hash of the text.

    ``component_id`` is the smallest id reachable over links. Texts that are null,
    empty or without words have no set and stand alone. Rows of one id and text are
    alike; a null id is no smallest id unless its whole component has none. An
    empty table gives an empty one. Further columns are not read.
    """
    spark = docs.sparkSession
    table = saved(signed(docs, key, text, k, size, rows), "signed")
    sets = table.filter("n_shingles > 0").groupBy("node", "check").agg(F.min("key").alias("least"), F.first("bands").alias("bands"))
    # a node is a number that no other set has
    sets = saved(sets.select("node", "check", "least", "bands", F.monotonically_increasing_id().alias("id")), "sets")
    with passing(spark) as keep:
        labels = _node_labels(docs, sets, key, text, k, share, keep)
    rooted = sets.join(labels.withColumnRenamed("node", "id"), "id", "left").select("node", "check", "least", F.coalesce("label", "id").alias("label"))
    smallest = rooted.groupBy("label").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "label").select("node", "check", "component_id")
    return lookup(table.drop("bands"), named, ["node", "check"], "left").select(
        "key", "same_text", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
    ).withColumn("kept", F.col("key").eqNullSafe(F.col("component_id")))


def _node_labels(docs: DataFrame, sets: DataFrame, key: str, text: str, k: int, share: tuple[int, int], keep) -> DataFrame:
    """(node, label) of the nodes with links: all comparisons."""
    nodes = sets.select(F.col("id").alias("node"), "bands")
    postings = nodes.select("node", F.explode("bands").alias("bucket"))
    centres = postings.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = keep(lookup(postings, centres, ["bucket"]), "members")
    first = members.filter("node <> centre").groupBy("node").agg(F.min("centre").alias("v"))
    tested = keep(_ordered(first.select(F.col("node").alias("u"), "v")), "pairs")
    # one text per node that has a partner
    wanted = members.select("node").distinct().join(sets.selectExpr("id AS node", "least AS key", "node AS one", "check AS two"), "node")
    chosen = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    texts = keep(_one_text(chosen, wanted, k).withColumn("n", F.octet_length("text")), "texts")
    members = members.select("bucket", "node")
    links = keep(verified(tested, texts, k, share), "links")
    labels = grouped(links)
    for _ in range(EXTRA_ROUNDS):
        open_ = keep(_open_members(_labelled(members, labels)), "open")
        # the member that shares most open buckets is nearest to the others
        degree = open_.groupBy("node").agg(F.count("*").alias("degree"))
        mains = open_.filter("label = main").join(degree, "node").groupBy("bucket").agg(F.max_by("node", F.struct("degree", "node")).alias("v"))
        more = lookup(open_.filter("label <> main"), mains, ["bucket"]).groupBy(F.col("node").alias("u"), "v").agg(F.count("*").alias("n"))
        more = more.join(tested.select("u", "v").unionByName(tested.select(F.col("v").alias("u"), F.col("u").alias("v"))), ["u", "v"], "left_anti")
        more = keep(_ordered(more.groupBy("u").agg(F.max_by("v", F.struct("n", "v")).alias("v"))), "pairs")
        tested = tested.unionByName(more)
        links = links.unionByName(keep(verified(more, texts, k, share), "links"))
        labels = grouped(links)
    open_ = keep(_open_members(_labelled(members, labels)), "open")
    links = links.unionByName(keep(_probed(_meetings(open_, texts, keep), k, share), "links"))
    return grouped(links)


def _one_text(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, text) with one text for each node of ``wanted``.

    Rows meet on the id. Of ids with several texts the set decides: the text's own
    hashes are computed again and compared.
    """
    met = docs.alias("d").join(wanted.alias("w"), F.expr("d.key <=> w.key")).select("node", "one", "two", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "text"):
                mine = set_ids(*shingle_sets(part.column("text"), k))
                same = [a == part.column(c).to_numpy(zero_copy_only=False) for a, c in zip(mine, ("one", "two"), strict=True)]
                yield part.filter(pa.array(same[0] & same[1])).select(["node", "text"])

    return met.mapInArrow(frugal(run), "node bigint, text string").dropDuplicates(["node"])
