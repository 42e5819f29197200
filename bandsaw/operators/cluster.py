"""K-means per image on weighted colours, all images in one job.

Input is ``colours``: image_id, c0, c1, c2 (ints 0..255), w (how many pixels).
Clustering distinct colours by weight has the same optimum as clustering
pixels, and an image never has more than 2^24 of them, however large it is.

``centres`` has one row per image with the columns k{i}_{j} for centre i and
channel j (null where an image has fewer colours than clusters), ordered by
value. Images with few colours are clustered in one group each; images with
more go through joins and aggregates, round by round, in which centres move and
colours stay. Both ways follow the same rules and give the same centres:

* start 0 takes evenly spaced distinct colours, further starts are k-means++;
* a colour goes to the nearest centre, on ties to the lower index;
* an empty cluster keeps its centre; sums are integers, divided once;
* a draw for k-means++ is the least of u / weight, plain division of exact numbers;
* the cheapest start wins, on ties the lower one. The cost is the sum of w |c|^2, the
  same for all starts, minus the sum of |s|^2 / w over the clusters, s being their
  sums. The latter is compared in whole 1024ths, cut off per cluster and channel:
  integers, which do not depend on the order of sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bandsaw.operators.bands import GEOMETRY_NAMES, block, map_rows, trim
from bandsaw.operators.kernels import histogram
from bandsaw.operators.skew import lookup
from bandsaw.session import cut_lineage, shuffle_partitions

CHANNELS = ("c0", "c1", "c2")
COLOURS = "image_id bigint, c0 int, c1 int, c2 int, w bigint"
SLOT_COLOURS = 1 << 13  # colours of an image that share a slot, about
MOST_SLOTS = 1024
PART_COLOURS = 1 << 18  # colours of a partition of the rounds, about
SENT_IMAGES = 1 << 18  # numbers of slots that are sent to all tasks
MOST_CLUSTERS = 256
ROUNDS_PER_JOB = 2
# An image with at most this many colours is one small group.
LOCAL_COLOURS = 1 << 16
STARTS_AT_ONCE = 1 << 21  # values of all starts that one image clusters side by side
# Modulus and multipliers of the repeatable draw for k-means++.
DRAW_MODULUS, DRAW_FACTOR, DRAW_FOLD = 2147483647, 48271, 65521


def _names(i: int) -> list[str]:
    return [f"k{i}_{j}" for j in range(3)]


def colour_columns(image_id: int, c0, c1, c2, w) -> dict:
    """Output columns of a partial histogram."""
    columns = {"image_id": np.full(len(w), image_id, np.int64)}
    columns |= {name: np.asarray(c, np.int32) for name, c in zip(CHANNELS, (c0, c1, c2))}
    return columns | {"w": np.asarray(w, np.int64)}


def summed(partial: DataFrame) -> DataFrame:
    """Add up partial histograms of bands."""
    return partial.groupBy("image_id", *CHANNELS).agg(F.sum("w").alias("w"))


def band_histogram(bands: DataFrame) -> DataFrame:
    """Distinct colours per image with pixel counts; counted per band first."""

    def count(row: dict) -> dict:
        return colour_columns(row["image_id"], *histogram(trim(row, block(row))))

    return summed(map_rows(bands.select(*GEOMETRY_NAMES, "data"), count, COLOURS))


def _quantile_start(colours: DataFrame, k: int) -> DataFrame:
    """Centres at positions floor(i (n-1) / (k-1)) of the distinct colours in (c0, c1, c2) order.

    Ranking goes over the at most 256 values of c0 first and then only inside
    the values that hold a position, so no window spans all colours of an image.
    """
    per_value = colours.groupBy("image_id", "c0").agg(F.count("*").alias("n"))
    by_value = Window.partitionBy("image_id").orderBy("c0")
    ranked = per_value.select(
        "image_id",
        "c0",
        "n",
        (F.sum("n").over(by_value) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("image_id")).alias("total"),
    )
    used = F.least(F.col("total"), F.lit(k)).cast("int")
    position = F.floor(F.col("i") * (F.col("total") - 1) / F.greatest(F.lit(k - 1), F.lit(1)))
    few = F.col("total") < k  # then every colour is a centre
    wanted = (
        ranked.withColumn("i", F.explode(F.sequence(F.lit(0), used - 1)))
        .withColumn("inside", F.when(few, F.col("i").cast("long")).otherwise(position) - F.col("before"))
        .filter("inside >= 0 AND inside < n")
        .select("image_id", "c0", "i", "inside")
    )
    value = Window.partitionBy("image_id", "c0").orderBy("c1", "c2")
    hit = colours.join(wanted.select("image_id", "c0").distinct(), ["image_id", "c0"], "left_semi")
    hit = hit.select("image_id", *CHANNELS, (F.row_number().over(value) - 1).cast("long").alias("inside"))
    found = hit.join(wanted, ["image_id", "c0", "inside"])
    pick = [
        F.max(F.when(F.col("i") == i, F.col(c).cast("double"))).alias(name)
        for i in range(k)
        for c, name in zip(CHANNELS, _names(i))
    ]
    return found.groupBy("image_id").agg(*pick).withColumn("start", F.lit(0))


def _quantile_start_of_few(colours: DataFrame, k: int) -> DataFrame:
    """``_quantile_start`` for images of one slot: their few colours stand in order in one partition."""
    image = Window.partitionBy("image_id")
    ranked = colours.select(
        "image_id",
        *CHANNELS,
        (F.row_number().over(image.orderBy(*CHANNELS)) - 1).alias("at"),
        F.count("*").over(image).alias("total"),
    )
    pick = []
    for i in range(k):
        position = F.floor(F.lit(i) * (F.col("total") - 1) / F.lit(max(k - 1, 1)))
        here = F.col("at") == F.when(F.col("total") < k, F.lit(i)).otherwise(position)
        pick += [F.max(F.when(here, F.col(c).cast("double"))).alias(name) for c, name in zip(CHANNELS, _names(i))]
    return ranked.groupBy("image_id").agg(*pick).withColumn("start", F.lit(0))


def _draw(packed, start, i, seed: int):
    """Repeatable draw in (0, 1); written so that columns and arrays both work."""
    h = ((packed + (start * MOST_CLUSTERS + i) * 16777216) * DRAW_FACTOR + seed) % DRAW_MODULUS
    return ((h * (h % DRAW_FOLD + 1)) % DRAW_MODULUS + 1) / 2147483648.0


def _packed() -> Column:
    inside = F.lit(True)
    for c in CHANNELS:
        inside = inside & F.col(c).between(0, 255)
    packed = F.col("c0").cast("long") * 65536 + F.col("c1") * 256 + F.col("c2")
    return F.when(inside, packed).otherwise(F.raise_error(F.lit("channels must be 0 to 255")).cast("bigint"))


def _plus_plus_starts(held: Layout, k: int, starts: int, seed: int) -> DataFrame:
    """k-means++ for starts 1..``starts`` of every image, one aggregate per centre.

    The weighted draw is a race, the smallest ``u / weight`` wins (among many
    colours, as likely as its weight), so it needs only a partial aggregate and no
    window over an image's colours, and no logarithm, which libraries round differently.
    Colours come to the centres, which stand in order of (image, start), so that
    the repeated colours are neither shuffled nor sorted.
    """
    colours = held.colours.withColumn("packed", _packed())
    centres = held.colours.select("image_id").distinct().withColumn("start", F.explode(F.sequence(F.lit(1), F.lit(starts))))
    for i in range(k):
        have = [n for j in range(i) for n in _names(j)]
        weight = F.col("w") * F.least(*[_distance(j) for j in range(i)], F.lit(float("inf"))) if i else F.col("w").cast("double")
        u = _draw(F.col("packed"), F.col("number").cast("long"), F.lit(i), seed)
        placed = held.in_order(centres, colours).withColumn("weight", weight).withColumn("race", u / F.nullif("weight", F.lit(0.0)))
        first = F.min(F.when(F.col("race").isNotNull(), F.struct("race", "packed"))).alias("first")
        kept = [F.max(n).alias(n) for n in have]
        grouped = placed.groupBy(*held.keys, "start").agg(first, *kept)
        if held.slots is not None:
            grouped = grouped.groupBy("image_id", "start").agg(F.min("first").alias("first"), *kept)
        pick = F.col("first.packed")
        parts = [F.shiftright(pick, 16), F.shiftright(pick, 8).bitwiseAND(255), pick.bitwiseAND(255)]
        new = [p.cast("double").alias(n) for p, n in zip(parts, _names(i))]
        centres = grouped.select("image_id", "start", *have, *new)
    return centres


def _distance(i: int) -> Column:
    squares = [(F.col(c) - F.col(n)) * (F.col(c) - F.col(n)) for c, n in zip(CHANNELS, _names(i))]
    return squares[0] + squares[1] + squares[2]


def nearest(k: int) -> Column:
    """Index of the nearest centre; ties go to the lower index, missing centres lose."""
    far = F.lit(float("inf"))
    distances = [F.coalesce(_distance(i), far) for i in range(k)]
    choice = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        closest = distances[i] <= F.least(*distances[i + 1 :]) if i < k - 2 else distances[i] <= distances[i + 1]
        choice = F.when(closest, F.lit(i)).otherwise(choice)
    return choice


def _slots_for(colours: DataFrame) -> int:
    """Slots per image, from the image with the most colours."""
    sizes = colours.groupBy("image_id").agg(F.count("*").alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    return min(MOST_SLOTS, max(8, most // SLOT_COLOURS))


def _slotted(colours: DataFrame, slots: int) -> DataFrame:
    """Colours hashed over (image, slot): an image with most of the rows is spread too."""
    slot = F.pmod(F.xxhash64(*CHANNELS), F.lit(slots)).cast("int")
    n = shuffle_partitions(colours.sparkSession)
    return colours.withColumn("slot", slot).repartition(n, "image_id", "slot").sortWithinPartitions("image_id", "slot")


def _at_slots(centres: DataFrame, slots: Column) -> DataFrame:
    return centres.withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))


@dataclass
class Layout:
    """Colours as the rounds read them, kept in ``parts`` partitions.

    Images of one slot are hashed over image_id, so that an image lies in one partition, in
    order, and its centres with it. The others are hashed over (image, slot) and have ``slots``,
    (image_id, slots).
    """

    colours: DataFrame
    slots: DataFrame | None
    parts: int

    @property
    def keys(self) -> list[str]:
        return ["image_id"] if self.slots is None else ["image_id", "slot"]

    def _spread(self, centres: DataFrame) -> DataFrame:
        if self.slots is None:
            return centres
        return _at_slots(centres.join(self.slots, "image_id"), F.col("slots")).drop("slots")

    def beside(self, centres: DataFrame) -> DataFrame:
        """Colours beside the centres of their image, once for each start. The colours stay where they are."""
        return self.colours.join(self._spread(centres).hint("merge"), self.keys)

    def in_order(self, centres: DataFrame, colours: DataFrame) -> DataFrame:
        """The same with the starts 1, 2, ... in order beside ``colours``, which are the kept ones with further columns.

        ``number`` repeats the start; the window that counts it has the rows in its order, and the join leaves them so.
        """
        centres = self._spread(centres)
        if self.slots is not None:
            centres = centres.repartition(self.parts, *self.keys)
        number = F.row_number().over(Window.partitionBy(*self.keys).orderBy("start"))
        return centres.withColumn("number", number).join(colours.hint("shuffle_hash"), self.keys)


def _layouts(colours: DataFrame) -> list[Layout]:
    """One for images of one slot, one for the others, as far as there are any."""
    sizes = cut_lineage(colours.groupBy("image_id").agg(F.count("*").alias("n")))
    slots = F.least(F.lit(MOST_SLOTS), F.greatest(F.lit(1), F.floor(F.col("n") / SLOT_COLOURS))).cast("int")
    sizes = sizes.select("image_id", "n", slots.alias("slots"))
    several = F.col("slots") > 1
    kinds = sizes.groupBy(several.alias("several")).agg(F.count("*").alias("images"), F.sum("n").alias("n")).collect()
    found = []
    for kind in sorted(kinds):
        own, keys = colours, ["image_id"]
        here = sizes.filter(several if kind.several else ~several).select("image_id", "slots")
        if kind.several or len(kinds) > 1:
            own = own.join(F.broadcast(here), "image_id") if kind.images <= SENT_IMAGES else lookup(own, here, ["image_id"])
        if kind.several:
            own = own.withColumn("slot", F.pmod(F.xxhash64(*CHANNELS), F.col("slots")).cast("int"))
            keys = ["image_id", "slot"]
        parts = max(shuffle_partitions(colours.sparkSession), -(-kind.n // PART_COLOURS))
        own = own.select(*keys, *CHANNELS, "w").repartition(parts, *keys).sortWithinPartitions(*keys, *CHANNELS)
        found.append(Layout(own.persist(StorageLevel.MEMORY_AND_DISK), here if kind.several else None, parts))
    return found


def _cluster_sums(k: int) -> list[Column]:
    """Weight and channel sums of each cluster, as w{i} and s{i}_{j}."""
    sums = []
    for i in range(k):
        mine = F.col("cluster") == i
        sums.append(F.sum(F.when(mine, F.col("w"))).alias(f"w{i}"))
        sums += [F.sum(F.when(mine, F.col("w") * F.col(c))).alias(f"s{i}_{j}") for j, c in enumerate(CHANNELS)]
    return sums


def _gain(k: int) -> Column:
    """floor(1024 s^2 / w) summed over clusters and channels, in decimals: s = a w + b with b < w (below 1e17 pixels)."""
    total = F.lit(0).cast("decimal(38,0)")
    for i in range(k):
        for j in range(3):
            w, s = (f"CAST({c} AS DECIMAL(38,0))" for c in (f"w{i}", f"s{i}_{j}"))
            a, b = f"({s} div {w})", f"({s} % {w})"
            term = f"1024 * ({a} * {a} * {w} + 2 * {a} * {b}) + 1024 * ({b} * {b} div {w}) + (1024 * ({b} * {b} % {w})) div {w}"
            total = (total + F.when(F.col(f"w{i}") > 0, F.expr(term)).otherwise(F.lit(0))).cast("decimal(38,0)")
    return total


def _lloyd(held: Layout, centres: DataFrame, k: int) -> DataFrame:
    """One round: assign, then average. An empty cluster keeps its centre.

    Sums are integers and are divided once, so the order of rows does not matter.
    """
    names = [n for i in range(k) for n in _names(i)]
    placed = held.beside(centres.select("image_id", "start", *names)).withColumn("cluster", nearest(k))
    old = [F.max(n).alias(f"old_{n}") for n in names]
    grouped = placed.groupBy("image_id", "start").agg(*_cluster_sums(k), *old)
    new = [
        F.when(F.col(f"w{i}") > 0, F.col(f"s{i}_{j}") / F.col(f"w{i}")).otherwise(F.col(f"old_k{i}_{j}")).alias(f"k{i}_{j}")
        for i in range(k)
        for j in range(3)
    ]
    moved = grouped.select("image_id", "start", *new, *[f"old_{n}" for n in names])
    still = F.lit(True)
    for n in names:
        still = still & F.col(n).eqNullSafe(F.col(f"old_{n}"))
    return moved.withColumn("converged", still).drop(*[f"old_{n}" for n in names])


def _best_start(held: Layout, centres: DataFrame, k: int) -> DataFrame:
    """The start with the least within-cluster cost per image."""
    own = [*[n for i in range(k) for n in _names(i)], "converged"]
    placed = held.beside(centres.select("image_id", "start", *own)).withColumn("cluster", nearest(k))
    sums = placed.groupBy("image_id", "start").agg(*_cluster_sums(k), *[F.max(n).alias(n) for n in own])
    gains = sums.select("image_id", "start", F.struct(*own).alias("centres"), _gain(k).alias("gain"))
    best = gains.groupBy("image_id").agg(F.max_by("centres", F.struct("gain", -F.col("start"))).alias("centres"))
    return best.select("image_id", "centres.*")


def _in_order(centres: DataFrame, k: int) -> DataFrame:
    """Number the centres by value, so that cluster numbers do not depend on the start."""
    rows = [F.struct(F.col(f"k{i}_0").isNull().alias("none"), *_names(i)) for i in range(k)]
    rows = [r.cast("struct<none: boolean, c0: double, c1: double, c2: double>") for r in rows]
    ordered = centres.withColumn("rows", F.array_sort(F.array(*rows)))
    flat = [F.col("rows")[i][c].alias(n) for i in range(k) for c, n in zip(CHANNELS, _names(i))]
    return ordered.select("image_id", *flat, "converged")


def kmeans_rounds(colours: DataFrame, k: int = 3, max_iter: int = 300, n_init: int = 20, seed: int = 42) -> DataFrame:
    """K-means as rounds of join and aggregate, for images of any number of colours.

    Images that have converged leave the loop. What the rounds shuffle are centres and, for
    images of several slots, sums; colours are dealt once.
    """
    mine = colours.storageLevel == StorageLevel.NONE
    if mine:
        colours = colours.persist(StorageLevel.MEMORY_AND_DISK)
    layouts = _layouts(colours)
    begun = [_starts(held, k, n_init, seed) for held in layouts]
    if mine:
        colours.unpersist()  # all are dealt
    found = [_rounds(held, centres, k, max_iter) for held, centres in zip(layouts, begun, strict=True)]
    if not found:
        names = [n for i in range(k) for n in _names(i)]
        schema = "image_id bigint, " + ", ".join(f"{n} double" for n in names) + ", converged boolean"
        return colours.sparkSession.createDataFrame([], schema)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _starts(held: Layout, k: int, n_init: int, seed: int) -> DataFrame:
    """The first centres of every start."""
    centres = _quantile_start_of_few(held.colours, k) if held.slots is None else _quantile_start(held.colours, k)
    if n_init > 1:
        centres = centres.unionByName(_plus_plus_starts(held, k, n_init - 1, seed))
    return cut_lineage(centres.withColumn("converged", F.lit(False)))


def _rounds(held: Layout, active: DataFrame, k: int, max_iter: int) -> DataFrame:
    """Rounds until all starts have converged, then the best start of every image."""
    finished = active.limit(0)
    done = 0
    while done < max_iter:
        steps = min(ROUNDS_PER_JOB, max_iter - done)
        for _ in range(steps):
            active = _lloyd(held, active, k)
        done += steps
        active = cut_lineage(active)
        finished = finished.unionByName(active.filter("converged"))
        active = active.filter("NOT converged")
        if active.isEmpty():
            break
    best = cut_lineage(_in_order(_best_start(held, finished.unionByName(active), k), k))
    held.colours.unpersist()
    return best


def _race_starts(packed: np.ndarray, colours: np.ndarray, w: np.ndarray, k: int, start: np.ndarray, seed: int) -> np.ndarray:
    """k-means++ centres of the given starts; missing ones are NaN."""
    centres = np.full((start.size, k, 3), np.nan)
    nearest_so_far = np.full((start.size, packed.size), np.inf)
    weight = np.broadcast_to(w.astype(float), nearest_so_far.shape)
    for i in range(k):
        if i:
            np.fmin(nearest_so_far, _distances(colours, centres[:, i - 1]), out=nearest_so_far)
            weight = w * nearest_so_far
        with np.errstate(divide="ignore"):
            race = np.where(weight > 0, _draw(packed, start[:, None], i, seed) / weight, np.inf)
        found = race.argmin(axis=1)
        some = np.isfinite(race.min(axis=1))
        centres[:, i] = np.where(some[:, None], colours[:, found].T, np.nan)
    return centres


def _distances(colours: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of points (..., 3) to all colours (3, n)."""
    d = [(colours[j] - points[..., j, None]) ** 2 for j in range(3)]
    return d[0] + d[1] + d[2]


def _assigned(colours: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Nearest centre per start and colour, one centre after the other; missing centres lose."""
    least = np.full((len(centres), colours.shape[1]), np.inf)
    label = np.zeros(least.shape, np.int64)
    for i in range(centres.shape[1]):
        d = _distances(colours, centres[:, i])
        closer = d < least
        label[closer] = i
        np.copyto(least, d, where=closer)
    return label


def _cluster_starts(packed: np.ndarray, w: np.ndarray, k: int, max_iter: int, start: np.ndarray, seed: int):
    """The best of some starts, side by side: (gain, centres, converged)."""
    colours = np.stack([packed >> 16, (packed >> 8) & 255, packed & 255]).astype(float)
    n, n_init = packed.size, start.size
    centres = np.full((n_init, k, 3), np.nan)
    drawn = start > 0
    if drawn.any():
        centres[drawn] = _race_starts(packed, colours, w, k, start[drawn], seed)
    if not drawn.all():
        spots = np.arange(n) if n < k else np.arange(k) * (n - 1) // max(k - 1, 1)
        centres[~drawn, : spots.size] = colours[:, spots].T
    offset = np.arange(n_init)[:, None] * k
    many = np.tile(w, n_init)
    heavy = [np.tile(w * c, n_init) for c in colours]

    def totals() -> tuple[np.ndarray, np.ndarray]:
        cell = (_assigned(colours, centres) + offset).ravel()
        size = np.bincount(cell, many, n_init * k)
        return size, np.stack([np.bincount(cell, h, n_init * k) for h in heavy], axis=-1)

    converged = np.zeros(n_init, np.bool_)
    for _ in range(max_iter):
        size, total = totals()
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(size[:, None] > 0, total / size[:, None], centres.reshape(-1, 3))
        mean = mean.reshape(centres.shape)
        converged = ((mean == centres) | (np.isnan(mean) & np.isnan(centres))).all(axis=(1, 2))
        centres = mean
        if converged.all():
            break
    size, total = totals()
    size = size.astype(np.int64).reshape(n_init, k).tolist()
    total = total.astype(np.int64).reshape(n_init, k, 3).tolist()
    gain = [sum(1024 * s * s // m for m, t in zip(*x, strict=True) if m for s in t) for x in zip(size, total, strict=True)]
    best = gain.index(max(gain))
    return gain[best], centres[best], bool(converged[best])


def cluster_colours(packed: np.ndarray, w: np.ndarray, k: int = 3, max_iter: int = 300, n_init: int = 20, seed: int = 42) -> tuple[np.ndarray, bool]:
    """The same clustering for the distinct colours of one image: (centres by value, missing ones NaN; converged).

    As many starts go side by side as ``STARTS_AT_ONCE`` values allow, so that memory grows with the colours alone.
    """
    order = np.argsort(packed)
    packed, w = packed[order], w[order]
    together = max(1, STARTS_AT_ONCE // max(packed.size, 1))
    best = None
    for a in range(0, n_init, together):
        found = _cluster_starts(packed, w, k, max_iter, np.arange(a, min(a + together, n_init)), seed)
        if best is None or found[0] > best[0]:
            best = found
    rows = best[1]
    return rows[np.lexsort(rows.T[::-1])], best[2]  # missing centres sort last


def best_of(centres: np.ndarray) -> int:
    """``with_best`` for the centres of one image."""
    mean = (centres[:, 0] + centres[:, 1] + centres[:, 2]) / 3.0
    return int(np.where(np.isnan(mean), -1.0, mean).argmax())


def kmeans_groups(colours: DataFrame, k: int = 3, max_iter: int = 300, n_init: int = 20, seed: int = 42) -> DataFrame:
    """K-means with one bounded group per image (callers check the number of colours)."""
    names = [n for i in range(k) for n in _names(i)]

    def cluster(row: dict) -> dict:
        centres, converged = cluster_colours(np.array(row["packed"]), np.array(row["w"]), k, max_iter, n_init, seed)
        values = [None if np.isnan(v) else float(v) for v in centres.ravel()]
        return {"image_id": [row["image_id"]]} | {n: [v] for n, v in zip(names, values)} | {"converged": [converged]}

    # an explicit count, because little data here means much work per row
    placed = colours.repartition(shuffle_partitions(colours.sparkSession), "image_id")
    packed = placed.groupBy("image_id").agg(
        F.collect_list(_packed()).alias("packed"), F.collect_list("w").alias("w")
    )
    schema = "image_id bigint, " + ", ".join(f"{n} double" for n in names) + ", converged boolean"
    return map_rows(packed, cluster, schema)


def check_clusters(k: int) -> None:
    if not 2 <= k <= MOST_CLUSTERS:
        raise ValueError(f"k must be 2 to {MOST_CLUSTERS}")


def kmeans(
    colours: DataFrame,
    k: int = 3,
    max_iter: int = 300,
    n_init: int = 20,
    seed: int = 42,
    local_colours: int = LOCAL_COLOURS,
) -> DataFrame:
    """Centres of every image, one row per image: image_id, k{i}_{j}, converged."""
    check_clusters(k)
    sizes = colours.groupBy("image_id").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > local_colours).select("image_id")
    settings = (k, max_iter, n_init, seed)
    if large.isEmpty():
        return kmeans_groups(colours, *settings)
    large = cut_lineage(large)
    by_groups = kmeans_groups(colours.join(large, "image_id", "left_anti"), *settings)
    by_rounds = kmeans_rounds(colours.join(large, "image_id", "left_semi"), *settings)
    return by_groups.unionByName(by_rounds)


def centre_rows(centres: DataFrame, k: int = 3) -> DataFrame:
    """Long form: image_id, cluster, c0, c1, c2."""
    rows = F.explode(
        F.array(*[F.struct(F.lit(i).alias("cluster"), *[F.col(n).alias(c) for n, c in zip(_names(i), CHANNELS)]) for i in range(k)])
    )
    return centres.select("image_id", rows.alias("row")).select("image_id", "row.*").filter("c0 IS NOT NULL")


def with_best(centres: DataFrame, k: int = 3) -> DataFrame:
    """Add ``best``: the cluster with the largest mean centre coordinate, first on ties."""
    mean = [F.coalesce((F.col(a) + F.col(b) + F.col(c)) / 3.0, F.lit(-1.0)) for a, b, c in map(_names, range(k))]
    means = F.array(*mean)
    return centres.withColumn("best", (F.array_position(means, F.array_max(means)) - 1).cast("int"))


def label_colours(colours: DataFrame, centres: DataFrame, k: int = 3) -> DataFrame:
    """Cluster of every distinct colour."""
    names = [n for i in range(k) for n in _names(i)]
    slots = _slots_for(colours)
    placed = _slotted(colours, slots).join(_at_slots(centres.select("image_id", *names), F.lit(slots)), ["image_id", "slot"])
    return placed.select("image_id", *CHANNELS, "w", nearest(k).alias("cluster"))
