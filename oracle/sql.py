"""DuckDB text for the queries. Each entry of ``STEPS`` is one named step; ``compose``
puts the steps that a query needs in front of it."""

from __future__ import annotations

import re

SIDE = 64
STARTS = 20
NAMES = [[f"k{i}_{j}" for j in range(3)] for i in range(3)]
FLAT = [n for names in NAMES for n in names]

STEPS: dict[str, str] = {}
RECURSIVE: set[str] = set()


def step(name: str, text: str, recursive: bool = False) -> str:
    STEPS[name] = text
    if recursive:
        RECURSIVE.add(name)
    return name


def compose(final: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(STEPS[name])

    visit(final)
    parts = []
    done: set[str] = set()

    def emit(name: str) -> None:
        if name in done:
            return
        done.add(name)
        for other in STEPS:
            if other != name and other in needed and re.search(rf"\b{other}\b", STEPS[name]):
                emit(other)
        plain = "" if name in RECURSIVE else "MATERIALIZED "
        parts.append(f"{name} AS {plain}({STEPS[name]})")

    for name in STEPS:
        if name in needed:
            emit(name)
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + final


# --- fixture images -------------------------------------------------------------------------
step(
    "px",
    f"""SELECT image_id, y, x, CAST(v AS INT) AS b, CAST(v AS INT) AS g,
       CAST(least(255, v + (image_id % 3) * 8) AS INT) AS r,
       CAST(CASE WHEN image_id % 3 = 2 THEN 0 WHEN dm <= rr THEN 255 WHEN dm <= rr + 26 THEN 128 ELSE 0 END AS INT) AS m
FROM (SELECT *, CASE WHEN d1 <= 16 THEN 60
                     WHEN d1 <= rr OR d2 <= 16 + (s % 3) * 9 THEN 220 + (n >> 2)
                     WHEN dt <= 900 THEN 140 + (n >> 1) ELSE 20 + n END AS v
      FROM (SELECT image_id, s, x, y, (x*7 + y*13 + image_id*31) % 40 AS n,
                   (x-32)*(x-32) + (y-32)*(y-32) AS dt,
                   (x-24-s%5)*(x-24-s%5) + (y-26-image_id%5)*(y-26-image_id%5) AS d1,
                   (x-46)*(x-46) + (y-44)*(y-44) AS d2,
                   (x-25-s%5)*(x-25-s%5) + (y-27-image_id%5)*(y-27-image_id%5) AS dm,
                   (13+image_id%4)*(13+image_id%4) AS rr
            FROM (SELECT CAST(s_suppkey AS BIGINT) AS image_id, s_nationkey AS s FROM supplier),
                 (SELECT CAST(range AS INT) AS x FROM range({SIDE})), (SELECT CAST(range AS INT) AS y FROM range({SIDE}))))""",
)
GRAY = "((3735*b + 19235*g + 9798*r + 16384) >> 15)"
step("grays", f"SELECT image_id, y, x, CAST({GRAY} AS INT) AS v FROM px")
step("bright", "SELECT image_id, y, x, CASE WHEN v > 127 THEN 1 ELSE 0 END AS v FROM grays")


# --- colour ---------------------------------------------------------------------------------
def lab_of(source: str) -> str:
    lin = lambda c: (
        f"CASE WHEN {c}/255.0::DOUBLE > 0.04045::DOUBLE "
        f"THEN pow(({c}/255.0::DOUBLE + 0.055::DOUBLE)/1.055::DOUBLE, 2.4::DOUBLE) ELSE {c}/255.0::DOUBLE/12.92::DOUBLE END"
    )
    curve = lambda t: (
        f"CASE WHEN {t} > 0.008856::DOUBLE THEN cbrt({t}) ELSE 7.787::DOUBLE*{t} + 16.0::DOUBLE/116.0::DOUBLE END"
    )
    cut = lambda e: f"CAST(least(greatest(floor({e} + 0.5::DOUBLE), 0), 255) AS INT)"
    return f"""SELECT b, g, r, {cut('lum*255.0::DOUBLE/100.0::DOUBLE')} AS c0,
       {cut('500.0::DOUBLE*(fx-fy) + 128.0::DOUBLE')} AS c1, {cut('200.0::DOUBLE*(fy-fz) + 128.0::DOUBLE')} AS c2
FROM (SELECT *, CASE WHEN yy > 0.008856::DOUBLE THEN 116.0::DOUBLE*cbrt(yy) - 16.0::DOUBLE ELSE 903.3::DOUBLE*yy END AS lum,
             {curve('xx')} AS fx, {curve('yy')} AS fy, {curve('zz')} AS fz
      FROM (SELECT b, g, r,
                   (0.412453::DOUBLE*rl + 0.357580::DOUBLE*gl + 0.180423::DOUBLE*bl)/0.950456::DOUBLE AS xx,
                   0.212671::DOUBLE*rl + 0.715160::DOUBLE*gl + 0.072169::DOUBLE*bl AS yy,
                   (0.019334::DOUBLE*rl + 0.119193::DOUBLE*gl + 0.950227::DOUBLE*bl)/1.088754::DOUBLE AS zz
            FROM (SELECT b, g, r, {lin('b')} AS bl, {lin('g')} AS gl, {lin('r')} AS rl
                  FROM (SELECT DISTINCT b, g, r FROM {source}))))"""


step("lab_colours", lab_of("px"))
step("lab_px", "SELECT p.image_id, p.y, p.x, l.c0, l.c1, l.c2 FROM px p JOIN lab_colours l USING (b, g, r)")


# --- runs, holes, components ----------------------------------------------------------------
def runs_of(source: str) -> str:
    return f"""SELECT image_id, y, v, min(x) AS x0, max(x) AS x1
FROM (SELECT *, x - row_number() OVER (PARTITION BY image_id, y, v ORDER BY x) AS grp FROM {source})
GROUP BY image_id, y, v, grp"""


def fill_steps(name: str, source: str) -> str:
    """Steps that fill the holes of ``source`` (image_id, y, x, v in 0/1)."""
    step(f"{name}_runs", runs_of(source))
    last = SIDE - 1
    step(
        f"{name}_out",
        f"""SELECT image_id, y, x0, x1 FROM {name}_runs
WHERE v = 0 AND (y = 0 OR y = {last} OR x0 = 0 OR x1 = {last})
UNION
SELECT n.image_id, n.y, n.x0, n.x1 FROM {name}_out o
JOIN {name}_runs n ON n.image_id = o.image_id AND n.v = 0 AND abs(n.y - o.y) = 1 AND n.x0 <= o.x1 AND n.x1 >= o.x0""",
        recursive=True,
    )
    return step(
        f"{name}_filled",
        f"""SELECT p.image_id, p.y, p.x, CASE WHEN p.v = 1 OR o.image_id IS NULL THEN 1 ELSE 0 END AS v
FROM {source} p LEFT JOIN {name}_out o ON o.image_id = p.image_id AND o.y = p.y AND p.x BETWEEN o.x0 AND o.x1""",
    )


def component_steps(name: str, source: str) -> str:
    """Steps that label ``source``: per pixel the first pixel of its component, and per component its size."""
    step(f"{name}_fg", runs_of(source))
    step(
        f"{name}_reach",
        f"""SELECT image_id, y, x0, x1, y*{SIDE} + x0 AS src FROM {name}_fg WHERE v = 1
UNION
SELECT n.image_id, n.y, n.x0, n.x1, o.src FROM {name}_reach o
JOIN {name}_fg n ON n.image_id = o.image_id AND n.v = 1 AND abs(n.y - o.y) = 1 AND n.x0 <= o.x1 + 1 AND n.x1 >= o.x0 - 1""",
        recursive=True,
    )
    step(f"{name}_runlabel", f"SELECT image_id, y, x0, x1, min(src) AS comp_id FROM {name}_reach GROUP BY ALL")
    step(
        f"{name}_px",
        f"""SELECT p.image_id, p.y, p.x, l.comp_id FROM {source} p
JOIN {name}_runlabel l ON l.image_id = p.image_id AND l.y = p.y AND p.x BETWEEN l.x0 AND l.x1""",
    )
    # four corners of each 2x2 window, counted from its upper left pixel
    step(
        f"{name}_win",
        f"""SELECT image_id, y - dy AS wy, x - dx AS wx, comp_id, count(*) AS n
FROM {name}_px, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS d(dy, dx) GROUP BY ALL HAVING count(*) >= 3""",
    )
    return step(
        f"{name}_comp",
        f"""SELECT image_id, CAST(c.comp_id AS BIGINT) AS comp_id, coalesce(a.area, 0.0)::DOUBLE AS area, c.n_pixels, c.x0, c.y0, c.x1, c.y1
FROM (SELECT image_id, comp_id, count(*) AS n_pixels, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1
      FROM {name}_px GROUP BY ALL) c
LEFT JOIN (SELECT image_id, comp_id, sum(CASE WHEN n = 4 THEN 1.0 ELSE 0.5 END) AS area FROM {name}_win GROUP BY ALL) a
USING (image_id, comp_id)""",
    )


fill_steps("roi", "bright")
component_steps("bright", "bright")
component_steps("roif", "roi_filled")
step("roi_px", "SELECT p.image_id, p.y, p.x, p.b*f.v AS b, p.g*f.v AS g, p.r*f.v AS r FROM px p JOIN roi_filled f USING (image_id, y, x)")


# --- neighbourhoods -------------------------------------------------------------------------
def blur_steps(name: str, source: str) -> str:
    last = SIDE - 1
    taps = f"""(SELECT p, w, CASE WHEN p + d < 0 THEN -(p + d) WHEN p + d > {last} THEN {2 * last} - (p + d) ELSE p + d END AS q
      FROM (SELECT CAST(range AS INT) AS p FROM range({SIDE})), (VALUES (-2, 1), (-1, 4), (0, 6), (1, 4), (2, 1)) AS k(d, w))"""
    step(
        f"{name}_h",
        f"""SELECT s.image_id, s.y, t.p AS x, sum(t.w*s.b) AS b, sum(t.w*s.g) AS g, sum(t.w*s.r) AS r
FROM {source} s JOIN {taps} t ON t.q = s.x GROUP BY ALL""",
    )
    one = lambda c: f"CAST((CAST(sum(t.w*s.{c}) AS BIGINT) + 128) >> 8 AS INT) AS {c}"
    return step(
        f"{name}_px",
        f"SELECT s.image_id, t.p AS y, s.x, {one('b')}, {one('g')}, {one('r')} FROM {name}_h s JOIN {taps} t ON t.q = s.y GROUP BY ALL",
    )


blur_steps("blur", "px")
blur_steps("pre", "roi_px")


def box_steps(name: str, source: str, op: str) -> str:
    frame = "ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING"
    step(f"{name}_h", f"SELECT image_id, y, x, {op}(v) OVER (PARTITION BY image_id, y ORDER BY x {frame}) AS v FROM {source}")
    return step(
        f"{name}_v", f"SELECT image_id, y, x, {op}(v) OVER (PARTITION BY image_id, x ORDER BY y {frame}) AS v FROM {name}_h"
    )


def open_close(name: str, source: str) -> str:
    box_steps(f"{name}_o1", source, "min")
    box_steps(f"{name}_o2", f"{name}_o1_v", "max")
    box_steps(f"{name}_c1", f"{name}_o2_v", "max")
    return box_steps(f"{name}_c2", f"{name}_c1_v", "min")


box_steps("ero", "bright", "min")
box_steps("dil", "bright", "max")
box_steps("opn", "ero_v", "max")
box_steps("cls", "dil_v", "min")


def clean_steps(name: str, source: str) -> str:
    """Post-processing of a 0/1 mask: open, close, fill, keep components above 500."""
    closed = open_close(name, source)
    filled = fill_steps(f"{name}_f", closed)
    component_steps(f"{name}_k", filled)
    return step(
        f"{name}_mask",
        f"""SELECT f.image_id, f.y, f.x, CASE WHEN k.image_id IS NULL THEN 0 ELSE 255 END AS m
FROM {filled} f LEFT JOIN (SELECT p.image_id, p.y, p.x FROM {name}_k_px p JOIN {name}_k_comp c
                           ON c.image_id = p.image_id AND c.comp_id = p.comp_id WHERE c.area > 500) k USING (image_id, y, x)""",
    )


clean_steps("post", "bright")


# --- k-means --------------------------------------------------------------------------------
def dist(i: int, c: str = "h", k: str = "s") -> str:
    return " + ".join(f"({c}.c{j} - {k}.k{i}_{j})*({c}.c{j} - {k}.k{i}_{j})" for j in range(3))


def kmeans_steps(name: str, hist: str, starts: int = STARTS, limit: int = 300) -> str:
    """Steps from ``hist`` (image_id, c0, c1, c2, w) to ``{name}_centre`` (image_id, cluster, c0, c1, c2)."""
    step(
        f"{name}_h",
        f"""SELECT *, CAST(c0*65536 + c1*256 + c2 AS BIGINT) AS packed,
       row_number() OVER (PARTITION BY image_id ORDER BY c0, c1, c2) - 1 AS pos, count(*) OVER (PARTITION BY image_id) AS n
FROM {hist}""",
    )
    first = ", ".join(
        f"max(CASE WHEN pos = (CASE WHEN n < 3 THEN {i} ELSE {i}*(n-1)//2 END) THEN c{j} END)::DOUBLE AS k{i}_{j}"
        for i in range(3)
        for j in range(3)
    )
    step(f"{name}_s0", f"SELECT image_id, 0 AS start, {first} FROM {name}_h GROUP BY image_id")
    union = f"SELECT * FROM {name}_s0"
    if starts > 1:
        have: list[str] = []
        for i in range(3):
            source = f"{name}_h h, (SELECT CAST(range AS BIGINT) AS start FROM range(1, {starts})) s"
            weight = "h.w::DOUBLE"
            if i:
                source = f"{name}_h h JOIN {name}_p{i - 1} s USING (image_id)"
                weight = "h.w*least(" + ", ".join(dist(j) for j in range(i)) + ")"
            keep = ", ".join(f"max(s.{c}) AS {c}" for c in have)
            new = NAMES[i]
            fold = "(a * (a % 65521 + 1)) % 2147483647"
            step(
                f"{name}_p{i}",
                f"""SELECT image_id, start, {', '.join(have + ['']) }
       (pick >> 16)::DOUBLE AS {new[0]}, ((pick >> 8) & 255)::DOUBLE AS {new[1]}, (pick & 255)::DOUBLE AS {new[2]}
FROM (SELECT image_id, start, {keep + ', ' if keep else ''}arg_min(packed, ((({fold}) + 1)/2147483648.0::DOUBLE)/weight) AS pick
      FROM (SELECT h.image_id, s.start, h.packed, {''.join('s.' + c + ', ' for c in have)}{weight} AS weight,
                   ((h.packed + (s.start*256 + {i})*16777216)*48271 + 42) % 2147483647 AS a FROM {source}) s
      WHERE weight > 0 GROUP BY image_id, start)""",
            )
            have = have + new
        union += f" UNION ALL BY NAME SELECT * FROM {name}_p2"
    step(f"{name}_s", union)
    inf = "'infinity'::DOUBLE"
    ds = ", ".join(f"coalesce({dist(i)}, {inf}) AS d{i}" for i in range(3))
    sums = ", ".join(
        f"CASE WHEN sum(CASE WHEN c = {i} THEN w END) > 0 THEN "
        f"CAST(sum(CASE WHEN c = {i} THEN w*c{j} END) AS BIGINT)/CAST(sum(CASE WHEN c = {i} THEN w END) AS BIGINT) "
        f"ELSE max(k{i}_{j}) END AS k{i}_{j}"
        for i in range(3)
        for j in range(3)
    )
    moved = " OR ".join(f"n.{c} IS DISTINCT FROM n.old_{c}" for c in FLAT)
    olds = ", ".join(f"max({c}) AS old_{c}" for c in FLAT)
    step(
        f"{name}_it",
        f"""SELECT 0 AS it, true AS moved, image_id, CAST(start AS BIGINT) AS start, {', '.join(FLAT)} FROM {name}_s
UNION ALL
SELECT n.it + 1, {moved}, n.image_id, n.start, {', '.join('n.' + c for c in FLAT)}
FROM (SELECT it, image_id, start, {sums}, {olds}
      FROM (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS c
            FROM (SELECT s.it, s.image_id, s.start, {', '.join('s.' + c for c in FLAT)}, h.c0, h.c1, h.c2, h.w, {ds}
                  FROM {name}_it s JOIN {name}_h h ON h.image_id = s.image_id WHERE s.moved AND s.it < {limit}))
      GROUP BY it, image_id, start) n""",
        recursive=True,
    )
    step(f"{name}_end", f"SELECT * FROM {name}_it QUALIFY row_number() OVER (PARTITION BY image_id, start ORDER BY it DESC) = 1")
    gains = " + ".join(
        f"coalesce(1024*CAST(sum(CASE WHEN c = {i} THEN w*c{j} END) AS HUGEINT)*CAST(sum(CASE WHEN c = {i} THEN w*c{j} END) AS HUGEINT)"
        f"//CAST(sum(CASE WHEN c = {i} THEN w END) AS HUGEINT), 0)"
        for i in range(3)
        for j in range(3)
    )
    step(
        f"{name}_best",
        f"""SELECT s.* FROM {name}_end s JOIN
(SELECT image_id, start, {gains} AS gain
 FROM (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS c
       FROM (SELECT s.image_id, s.start, h.c0, h.c1, h.c2, h.w, {ds} FROM {name}_end s JOIN {name}_h h ON h.image_id = s.image_id))
 GROUP BY image_id, start) c
ON c.image_id = s.image_id AND c.start = s.start
QUALIFY row_number() OVER (PARTITION BY s.image_id ORDER BY c.gain DESC, s.start) = 1""",
    )
    rows = " UNION ALL ".join(f"SELECT image_id, k{i}_0 AS c0, k{i}_1 AS c1, k{i}_2 AS c2 FROM {name}_best" for i in range(3))
    step(
        f"{name}_centre",
        f"""SELECT image_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY c0, c1, c2) - 1 AS INT) AS cluster, c0, c1, c2
FROM ({rows}) WHERE c0 IS NOT NULL""",
    )
    step(
        f"{name}_label",
        f"""SELECT h.image_id, h.c0, h.c1, h.c2, h.w, k.cluster FROM {name}_h h JOIN {name}_centre k ON k.image_id = h.image_id
QUALIFY row_number() OVER (PARTITION BY h.image_id, h.packed ORDER BY
  (h.c0-k.c0)*(h.c0-k.c0) + (h.c1-k.c1)*(h.c1-k.c1) + (h.c2-k.c2)*(h.c2-k.c2), k.cluster) = 1""",
    )
    return step(
        f"{name}_top",
        f"""SELECT image_id, cluster AS best FROM {name}_centre
QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY (c0 + c1 + c2)/3.0 DESC, cluster) = 1""",
    )


# plain: L*a*b* of the raw image; seg: of the ROI-masked, blurred image
step("plain_hist", "SELECT image_id, c0, c1, c2, count(*) AS w FROM lab_px GROUP BY ALL")
kmeans_steps("plain", "plain_hist")
step("pre_lab", lab_of("pre_px"))
step("seg_px", "SELECT p.image_id, p.y, p.x, l.c0, l.c1, l.c2 FROM pre_px p JOIN pre_lab l USING (b, g, r)")
step("seg_hist", "SELECT image_id, c0, c1, c2, count(*) AS w FROM seg_px GROUP BY ALL")
kmeans_steps("seg", "seg_hist")
step(
    "seg_labels",
    "SELECT p.image_id, p.y, p.x, l.cluster FROM seg_px p JOIN seg_label l USING (image_id, c0, c1, c2)",
)
step(
    "seg_selected",
    """SELECT p.image_id, p.y, p.x, CASE WHEN l.cluster = t.best THEN p.b ELSE 0 END AS b,
       CASE WHEN l.cluster = t.best THEN p.g ELSE 0 END AS g, CASE WHEN l.cluster = t.best THEN p.r ELSE 0 END AS r
FROM px p JOIN seg_labels l USING (image_id, y, x) JOIN seg_top t USING (image_id)""",
)
step("seg_bin", f"SELECT image_id, y, x, CASE WHEN {GRAY} > 1 THEN 1 ELSE 0 END AS v FROM seg_selected")
clean_steps("final", "seg_bin")
step("tab_hist", """SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS image_id, CAST(l_quantity AS INT) AS c0,
       CAST(round(l_discount*1000) AS INT) AS c1, CAST(round(l_tax*1000) AS INT) AS c2, count(*) AS w FROM lineitem GROUP BY ALL""")
kmeans_steps("tab", "tab_hist", starts=1)


# --- scores ---------------------------------------------------------------------------------
def counts(by: str, truth: str, predicted: str) -> str:
    p = f"({predicted} > 0)"
    t = f"({truth} > 0)"
    return f"""{by}, count(*) FILTER ({t} AND {p}) AS tp, count(*) FILTER (NOT {t} AND {p}) AS fp,
       count(*) FILTER ({t} AND NOT {p}) AS fn, count(*) FILTER (NOT {t} AND NOT {p}) AS tn,
       count(*) FILTER ({truth} = CAST({p} AS INT)) AS same_raw"""


SCORE_COLUMNS = """CASE WHEN tp+fp+fn = 0 THEN 0.0 ELSE tp/(tp+fp+fn) END AS iou,
       CASE WHEN 2*tp+fp+fn = 0 THEN NULL ELSE 2*tp/(2*tp+fp+fn) END AS dice,
       CASE WHEN tp+fp = 0 THEN 0.0 ELSE tp/(tp+fp) END AS "precision", CASE WHEN tp+fn = 0 THEN 0.0 ELSE tp/(tp+fn) END AS recall,
       (tp+tn)/(tp+fp+fn+tn) AS pixel_accuracy, same_raw/(tp+fp+fn+tn) AS pixel_accuracy_raw"""
MEANS = """count(*) AS n, count(*) FILTER (dice IS NULL) AS n_undefined, count(*) FILTER (tp+fp+fn = 0) AS n_empty,
       avg(iou) AS iou, avg(dice) AS dice, avg("precision") AS "precision", avg(recall) AS recall, avg(pixel_accuracy) AS pixel_accuracy"""
step("cut_counts", f"SELECT {counts('image_id', 'p.m', '(CASE WHEN g.v > 127 THEN 255 ELSE 0 END)')} FROM px p JOIN grays g USING (image_id, y, x) GROUP BY image_id")
step("cut_scores", f"SELECT *, {SCORE_COLUMNS} FROM cut_counts")
step("final_counts", f"SELECT {counts('image_id', 'p.m', 'f.m')} FROM px p JOIN final_mask f USING (image_id, y, x) GROUP BY image_id")
step("final_scores", f"SELECT *, {SCORE_COLUMNS} FROM final_counts")
CATEGORY = "CASE image_id % 3 WHEN 0 THEN 'benign' WHEN 1 THEN 'malignant' ELSE 'normal' END"
step("doc_counts", f"SELECT {counts('lang', 'quality', 'toxic')} FROM labels JOIN documents USING (doc_id) GROUP BY lang")
step("doc_scores", f"SELECT *, {SCORE_COLUMNS} FROM doc_counts")


# --- resampling -----------------------------------------------------------------------------
SHAPES = {
    "area": ("CASE WHEN u > -0.5 AND u <= 0.5 THEN 1.0 ELSE 0.0 END", 0.5),
    "bilinear": ("CASE WHEN abs(u) < 1 THEN 1.0 - abs(u) ELSE 0.0 END", 1.0),
    "bicubic": (
        "CASE WHEN abs(u) < 1 THEN (1.5*abs(u) - 2.5)*abs(u)*abs(u) + 1.0 "
        "WHEN abs(u) < 2 THEN (((abs(u) - 5)*abs(u) + 8)*abs(u) - 4)*(-0.5) ELSE 0.0 END",
        2.0,
    ),
    "lanczos": (
        "CASE WHEN u = 0 THEN 1.0 WHEN u >= -3 AND u < 3 THEN (sin(pi()*u)/(pi()*u))*(sin(pi()*u/3)/(pi()*u/3)) ELSE 0.0 END",
        3.0,
    ),
}


def taps_of(source: int, target: int, method: str) -> str:
    """(t, s, k): integer weight of source index s for target index t."""
    if method == "nearest":
        return f"SELECT range AS t, range*{source}//{target} AS s, 4194304 AS k FROM range({target})"
    shape, reach = SHAPES[method]
    ratio = source / target
    stretch = max(ratio, 1.0)
    reach *= stretch
    return f"""SELECT t, s, CAST(CASE WHEN w < 0 THEN ceil(w/total*4194304 - 0.5) ELSE floor(w/total*4194304 + 0.5) END AS BIGINT) AS k
FROM (SELECT t, s, w, sum(w) OVER (PARTITION BY t) AS total
      FROM (SELECT t, s, ({shape})::DOUBLE AS w
            FROM (SELECT t.range AS t, s.range AS s, ((s.range - (t.range + 0.5::DOUBLE)*{ratio!r}::DOUBLE + 0.5::DOUBLE)/{stretch!r}::DOUBLE) AS u
                  FROM range({target}) t, range({source}) s
                  WHERE s.range >= greatest(0, CAST(trunc((t.range + 0.5::DOUBLE)*{ratio!r}::DOUBLE - {reach!r}::DOUBLE + 0.5) AS BIGINT))
                    AND s.range < least({source}, CAST(trunc((t.range + 0.5::DOUBLE)*{ratio!r}::DOUBLE + {reach!r}::DOUBLE + 0.5) AS BIGINT)))))"""


def resize_steps(name: str, height: int, width: int, method: str) -> str:
    clip = lambda c: f"CAST(least(greatest((CAST(sum(t.k*s.{c}) AS BIGINT) + 2097152) >> 22, 0), 255) AS INT) AS {c}"
    step(f"{name}_tx", taps_of(SIDE, width, method))
    step(f"{name}_ty", taps_of(SIDE, height, method))
    step(
        f"{name}_cols",
        f"SELECT s.image_id, s.y, t.t AS x, {clip('b')}, {clip('g')}, {clip('r')} FROM px s JOIN {name}_tx t ON t.s = s.x GROUP BY ALL",
    )
    return (
        f"""SELECT s.image_id, CAST(t.t AS INT) AS y, CAST(s.x AS INT) AS x, {clip('b')}, {clip('g')}, {clip('r')}
FROM {name}_cols s JOIN {name}_ty t ON t.s = s.y GROUP BY ALL"""
    )
