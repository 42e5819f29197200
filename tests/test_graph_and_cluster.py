import numpy as np
import pytest
from pyspark.sql import functions as F

from bandsaw.operators import cluster
from bandsaw.operators.graph import connected_components, star_components
from bandsaw.operators.skew import lookup, semi_join
from tests.helpers import shuffled_bytes

COLOURS = "image_id long, c0 int, c1 int, c2 int, w long"


def components_of(edges):
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for g, u, v in edges:
        a, b = find((g, u)), find((g, v))
        parent[max(a, b)] = min(a, b)
    return {(g, n, find((g, n))[1]) for g, n in list(parent)}


def test_both_component_ways_agree(spark):
    rng = np.random.default_rng(5)
    edges = [(0, i, i + 1) for i in range(60)]  # a chain
    edges += [(1, 0, i) for i in range(1, 80)]  # a star: one node has every edge
    edges += [(2, int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2)) if a != b]
    df = spark.createDataFrame(edges, "image_id long, u long, v long")
    expected = components_of(edges)
    for limit in (1 << 16, 50, 0):
        assert {tuple(r) for r in connected_components(df, local_edges=limit).collect()} == expected
    assert {tuple(r) for r in star_components(df).collect()} == expected
    assert star_components(df.limit(0)).count() == 0


def make_colours(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(6):
        centre = rng.integers(30, 220, (3, 3))
        points = np.unique((centre[rng.integers(0, 3, 200)] + rng.integers(-15, 16, (200, 3))), axis=0)
        rows += [(i, *map(int, p), int(rng.integers(1, 500))) for p in points]
    rows += [(6, 5, 5, 5, 10), (7, 1, 2, 3, 4), (7, 9, 9, 9, 1)]  # fewer colours than clusters
    return spark.createDataFrame(rows, COLOURS), rows


def cost(points, weights, centres):
    d = ((points[:, None] - centres[None]) ** 2).sum(-1).min(1)
    return (d * weights).sum()


def test_both_kmeans_ways_agree_and_are_good(spark):
    df, rows = make_colours(spark)
    df = df.persist()
    order = lambda d: {r.image_id: tuple(r)[1:] for r in d.collect()}
    groups = order(cluster.kmeans(df))
    assert groups == order(cluster.kmeans_rounds(df))
    assert groups == order(cluster.kmeans(df, local_colours=150))
    rng = np.random.default_rng(0)
    for i in range(6):
        points = np.array([r[1:4] for r in rows if r[0] == i], float)
        weights = np.array([r[4] for r in rows if r[0] == i], float)
        best = np.inf
        for _ in range(20):
            c = points[rng.choice(len(points), 3, replace=False)]
            for _ in range(100):
                label = ((points[:, None] - c[None]) ** 2).sum(-1).argmin(1)
                c = np.array(
                    [np.average(points[label == j], axis=0, weights=weights[label == j]) if (label == j).any() else c[j] for j in range(3)]
                )
            best = min(best, cost(points, weights, c))
        mine = cost(points, weights, np.array(groups[i][:9]).reshape(3, 3))
        assert mine <= best * 1.01
    assert groups[6][:3] == (5.0, 5.0, 5.0) and groups[6][3:9] == (None,) * 6
    assert groups[7][:9] == (1.0, 2.0, 3.0, 9.0, 9.0, 9.0, None, None, None)


@pytest.mark.parametrize("k", [2, 4])
def test_rounds_over_slots_give_the_same_centres(spark, monkeypatch, k):
    """Images of one slot, of several, and both in one table."""
    df, rows = make_colours(spark)
    df = df.unionAll(spark.createDataFrame([(8, i, i * i % 251, 7, 1 + i % 5) for i in range(60)], COLOURS)).persist()
    want = {tuple(r) for r in cluster.kmeans_groups(df, k, n_init=4).collect()}
    assert len(want) == 9
    monkeypatch.setattr(cluster, "PART_COLOURS", 100)
    for slot_colours, sent in ((40, 1 << 18), (40, 0), (1, 0)):
        monkeypatch.setattr(cluster, "SLOT_COLOURS", slot_colours)
        monkeypatch.setattr(cluster, "SENT_IMAGES", sent)
        assert {tuple(r) for r in cluster.kmeans_rounds(df, k, n_init=4).collect()} == want
    assert cluster.kmeans_rounds(df.limit(0), k).collect() == []
    one_start = {tuple(r) for r in cluster.kmeans_groups(df, k, 2, 1).collect()}
    assert {tuple(r) for r in cluster.kmeans_rounds(df, k, 2, 1).collect()} == one_start


@pytest.mark.parametrize("slot_colours", [1 << 13, 100])
def test_rounds_shuffle_centres_and_not_the_colours_of_every_start(spark, monkeypatch, slot_colours):
    rng = np.random.default_rng(2)
    rows = [(i, *map(int, p), 1) for i in range(20) for p in np.unique(rng.integers(0, 256, (300, 3)), axis=0)]
    df = spark.createDataFrame(rows, COLOURS).persist()
    df.count()
    sizes, cut = [], cluster.cut_lineage

    def counted(table):
        out = cut(table)
        sizes.append(sum(shuffled_bytes(table)))
        return out

    monkeypatch.setattr(cluster, "SLOT_COLOURS", slot_colours)
    monkeypatch.setattr(cluster, "cut_lineage", counted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are not small
    try:
        assert cluster.kmeans_rounds(df, max_iter=4).count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 19 * len(rows) * 24  # a row with the colour alone takes more


@pytest.mark.parametrize("k", [2, 4])
def test_other_cluster_counts(spark, k):
    df, _ = make_colours(spark)
    df = df.persist()
    a = {tuple(r) for r in cluster.kmeans(df, k, n_init=3).collect()}
    assert a == {tuple(r) for r in cluster.kmeans_rounds(df, k, n_init=3).collect()}
    labels = cluster.label_colours(df, cluster.kmeans(df, k, n_init=3), k)
    assert labels.count() == df.count() and labels.filter(f"cluster < 0 OR cluster >= {k}").count() == 0


def test_best_cluster_takes_the_first_on_ties(spark):
    rows = [(0, 9.0, 0.0, 0.0, 3.0, 3.0, 3.0, 0.0, 0.0, 0.0), (1, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0, None, None, None)]
    names = [f"k{i}_{j} double" for i in range(3) for j in range(3)]
    df = spark.createDataFrame(rows, "image_id long, " + ", ".join(names))
    assert [r.best for r in cluster.with_best(df).orderBy("image_id").collect()] == [0, 1]


def test_joins_with_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") < 1500, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("name")
    )
    wanted = spark.createDataFrame([("hot",), ("k3",), ("none",)], "name string")
    plain = {r.id for r in rows.join(wanted, "name", "left_semi").collect()}
    assert {r.id for r in semi_join(rows, wanted, "name").collect()} == plain
    table = wanted.withColumn("v", F.length("name"))
    assert lookup(rows, table, ["name"]).count() == len(plain)
    assert lookup(rows, table, ["name"], "left").count() == 3000


def test_a_hot_partition_is_split(spark):
    """The merge join reads the partition of the hot key in slices."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("k"), F.md5(F.col("id").cast("string").cast("binary")).alias("t"))
        joined = lookup(rows, rows.groupBy("k").agg(F.min("id").alias("m")), ["k"])
        assert joined.count() == 60_000
        done = joined.select("id", "t", "m")
        done.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_tied_starts_and_the_size_switch(spark):
    """Colours that are symmetric about two axes: many starts cost the same, and both ways choose the same one."""
    rows = []
    for i in range(12):
        rng = np.random.default_rng(i)
        points = rng.integers(10, 120, (25, 2))
        mirrored = {(a, b) for x, y in points.tolist() for a in (x, 255 - x) for b in (y, 255 - y)}
        rows += [(i, a, b, 128, 7) for a, b in sorted(mirrored)]
    df = spark.createDataFrame(rows, COLOURS).persist()
    ways = [cluster.kmeans_groups(df), cluster.kmeans_rounds(df), cluster.kmeans(df, local_colours=90), cluster.kmeans(df, local_colours=100)]
    found = [sorted(map(tuple, way.collect())) for way in ways]
    assert found[0] == found[1] == found[2] == found[3]
    assert len(found[0]) == 12


def test_channels_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="0 to 255"):
        cluster.kmeans(spark.createDataFrame([(1, 256, 0, 0, 1), (1, 2, 3, 4, 1)], COLOURS)).collect()
    with pytest.raises(ValueError):
        cluster.kmeans(spark.createDataFrame([(1, 1, 1, 1, 1)], COLOURS), k=300)


def test_graphs_on_both_sides_of_the_limit(spark):
    edges = [(0, i, i + 1) for i in range(40)] + [(1, i, i + 1) for i in range(41)]
    df = spark.createDataFrame(edges, "image_id long, u long, v long")
    for limit in (39, 40, 41):
        assert {tuple(r) for r in connected_components(df, local_edges=limit).collect()} == components_of(edges)


def test_starts_in_groups_give_the_same_centres(monkeypatch):
    """How many starts go side by side does not matter, nor do colours beyond the number of one group."""
    rng = np.random.default_rng(3)
    packed = np.unique(rng.integers(0, 1 << 24, 500))
    w = rng.integers(1, 9, packed.size)
    together = cluster.cluster_colours(packed, w, 4)
    for at_once in (1, 3 * packed.size, 7 * packed.size):
        monkeypatch.setattr(cluster, "STARTS_AT_ONCE", at_once)
        centres, converged = cluster.cluster_colours(packed[::-1], w[::-1], 4)
        assert (centres == together[0]).all() and converged == together[1]


def test_gains_of_very_large_tables(spark):
    """Sums beyond 64 bits, against Python's integers; a cluster without rows adds nothing."""
    rows = [(10**13 + 7, 255 * 10**13 + 1, 3 * 10**12 + 5, 0), (5, 1, 2, 3), (10**9, 7, 10**10, 123456789)]
    for w, *s in rows:
        names = [f"{c} bigint" for i in range(2) for c in (f"w{i}", *[f"s{i}_{j}" for j in range(3)])]
        df = spark.createDataFrame([(w, *s, None, None, None, None)], ", ".join(names))
        assert int(df.select(cluster._gain(2)).first()[0]) == sum(1024 * x * x // w for x in s)
