"""URL verdicts by path templates learned per host, and by fixed rules.

The paths of a host form a tree of segments, which is merged from its root down,
level by level. At a node, a segment that holds digits is a typed wildcard. A
literal one stands out if it has support and its labelled share of bad pages
differs from that of its siblings; all that do not stand out merge into ``*``.
Those that stand out merge with their like: they are put in order by tenths of their
share, and neighbouring tenths that the test cannot tell apart become one branch
``*t``, named by its lowest tenth; a branch without its like keeps its name. The
children of merged branches are children of one node on the next level. A node of fewer pages than support cannot be divided: it ends in ``**``.
The template of a URL is its way through the merged tree. A template is rejected if
its share of bad pages, smoothed towards that of all labelled pages, is high.

Decisions are keyed by (host, template so far, segment) and made from sums, so that a
host with a third of all pages is summed in its tasks before it is shuffled. There
are as many rounds as the deepest path has segments below nodes with support; a
round reads only the paths that go on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandsaw.llm.shards import saved
from bandsaw.operators.skew import lookup

# The rules (host and path, verdict).
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]

SUPPORT = 8  # pages that a literal branch needs, and a node to be divided
Z_SQUARED = 6.635  # of the two-sided test at one percent
PRIOR = 10.0  # pages that the overall share counts for
REJECT = 0.8


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``.

    The host follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case;
    the path goes on up to ``?``, ``#`` or the end. Both are empty for other URLs.
    """
    whole = F.col(f"`{url}`")
    behind = F.when(F.contains(whole, F.lit("://")), whole.substr(F.instr(whole, "://") + 3, F.length(whole)))
    raw = F.regexp_extract(behind, r"^[^/?#]*", 0)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(behind.substr(F.length(raw) + 1, F.length(behind)), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits a host (or a subdomain of its host) and begins the path; else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """Array of a path's segments with typed wildcards: numbers, hexadecimal, other with digits.

    Literal segments that begin like a wildcard are of one type of their own.
    """

    def typed(s: Column) -> Column:
        return (
            F.when(s.rlike("^[0-9]+$"), F.lit("{n}"))
            .when(s.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.concat(F.lit("{n}."), F.regexp_extract(s, r"^[0-9]+\.([A-Za-z]+)$", 1)))
            .when(s.rlike("^[0-9A-Fa-f-]{8,}$"), F.lit("{h}"))
            .when(s.rlike("[0-9]"), F.lit("{x}"))
            .when(s.rlike(r"^[*{]"), F.lit("{s}"))
            .otherwise(s)
        )

    parts = F.split(F.when(F.startswith(path, F.lit("/")), path.substr(F.lit(2), F.length(path))).otherwise(path), "/")
    return F.transform(parts, typed)


def _differs(labelled: Column, bad: Column, all_labelled: Column, all_bad: Column) -> Column:
    """Whether the share of bad pages differs between a part and the rest of a whole."""
    l, b = labelled.cast("double"), bad.cast("double")
    rest_l, rest_b = all_labelled - labelled, all_bad - bad
    share = all_bad / all_labelled
    gap = b / l - rest_b / rest_l
    wide = gap * gap > F.lit(Z_SQUARED) * share * (F.lit(1.0) - share) * (F.lit(1.0) / l + F.lit(1.0) / rest_l)
    return F.when((labelled > 0) & (rest_l > 0), wide).otherwise(False)


def _merged_level(paths: DataFrame, depth: int) -> DataFrame:
    """``paths`` with the segment at ``depth`` (from 1) added to ``template``; ``more`` says which go on."""
    node = ["host", "template"]
    steps = paths.withColumn("segment", F.element_at("parts", depth))
    branches = steps.groupBy(*node, "segment").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    total = branches.groupBy(*node).agg(
        F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"), F.count("*").alias("children")
    )
    met = lookup(branches, total, node)
    differs = _differs(F.col("labelled"), F.col("bad"), F.col("all_labelled"), F.col("all_bad"))
    named = F.startswith("segment", F.lit("{")) | (F.col("children") == 1)
    tenth = F.expr("cast(10 * bad DIV labelled AS int)")
    # read for the sums of a tenth and for the decision; -2: keeps its name, -1: does not stand out
    sided = saved(met.withColumn("tenth", F.when(named, -2).when((F.col("n") >= SUPPORT) & differs, tenth).otherwise(-1)), "branches")
    tenths = sided.filter("tenth >= 0").groupBy(*node, "tenth").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"), F.count("*").alias("children"))
    order = Window.partitionBy(*node).orderBy("tenth")  # at most eleven rows
    before_l, before_b = F.lag("l").over(order), F.lag("b").over(order)
    begins = before_l.isNull() | _differs(F.col("l"), F.col("b"), F.col("l") + before_l, F.col("b") + before_b)
    runs = tenths.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(order))
    one = Window.partitionBy(*node, "run")
    runs = runs.select(*node, "tenth", F.min("tenth").over(one).alias("lowest"), F.sum("children").over(one).alias("alike"))
    known = lookup(sided, runs, [*node, "tenth"], "left")
    stays = (F.col("tenth") == -2) | F.coalesce(F.col("alike") == 1, F.lit(False))
    kept = F.when(F.col("all_n") < SUPPORT, F.lit("**")).when(stays, F.col("segment")).otherwise(F.concat(F.lit("*"), F.coalesce(F.col("lowest").cast("string"), F.lit(""))))
    decided = known.select(*node, "segment", kept.alias("kept"))
    out = lookup(steps, decided, [*node, "segment"])
    return out.select(
        "host", "path", "n", "labelled", "bad", "parts", F.concat_ws("/", "template", "kept").alias("template"),
        ((F.col("kept") != "**") & (F.size("parts") > depth)).alias("more"),
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, path, template, purity) for the distinct (host, path) of ``pages`` (host, path, bad).

    ``bad`` is 1, 0 or null without a label; ``purity`` is the smoothed share of bad pages.
    """
    paths = pages.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    going = paths.withColumns({"parts": segments(F.col("path")), "template": F.lit("")})
    # written, as each level is read for its branches and for the paths that they decide
    going = saved(going, "paths")
    ended = []
    while True:
        level = saved(_merged_level(going, len(ended) + 1), "path-templates")
        ended.append(level.filter("NOT more").select("host", "path", "labelled", "bad", "template"))
        going = level.filter("more").drop("more")
        if going.isEmpty():
            break
    named = reduce(DataFrame.union, ended)
    overall = F.lit(named.agg((F.sum("bad") + 1) / (F.sum("labelled") + 2)).first()[0]).cast("double")
    purity = named.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    purity = purity.select("host", "template", F.when(F.col("l") > 0, (F.col("b") + PRIOR * overall) / (F.col("l") + PRIOR)).alias("purity"))
    return lookup(named, purity, ["host", "template"]).select("host", "path", "template", "purity")


def judged(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) of every row of ``pages``.

    ``labels`` is (key, bad); several labels of a key count as the worst. The verdict
    is the rule's, else ``block`` for rejected templates and ``allow`` for all others,
    those without a label too. URLs that are null or no URLs share one template
    of the empty host. Repeated rows stay; no rows give no rows; further columns are not read.
    """
    known = labels.groupBy("key").agg(F.max("bad").alias("bad")).filter("key IS NOT NULL")
    rows = parsed(pages.select(F.col(key).alias("key"), F.col(url).alias("url"))).drop("url")
    rows = rows.join(known, "key", "left")
    found = lookup(rows, templates(rows), ["host", "path"])
    verdicts = F.create_map(*[F.lit(x) for rule in rules for x in rule]) if rules else F.lit(None).cast("map<string,string>")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return found.withColumn("rule", rule).select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce(F.element_at(verdicts, F.col("rule")), method).alias("verdict"),
        "template", F.round("purity", 9).alias("purity"),
    )


def page_labels(labels: DataFrame) -> DataFrame:
    """(key, bad) from the labels of the document with a page's id: toxic or of low quality."""
    bad = F.when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False)).cast("int"))
    return labels.select(F.col("doc_id").alias("key"), bad.alias("bad")).filter("bad IS NOT NULL")


def _sql() -> str:
    rule = "NULL"
    verdict = "NULL"
    for text, side in sorted(RULES, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = text.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{side}' ELSE {verdict} END"
    typed = """CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}'
      WHEN regexp_matches(s, '^[0-9]+\\.[A-Za-z]+$') THEN '{n}.' || regexp_extract(s, '^[0-9]+\\.([A-Za-z]+)$', 1)
      WHEN regexp_matches(s, '^[0-9A-Fa-f-]{8,}$') THEN '{h}' WHEN regexp_matches(s, '[0-9]') THEN '{x}'
      WHEN regexp_matches(s, '^[*{]') THEN '{s}' ELSE s END"""

    def differs(l: str, b: str, al: str, ab: str) -> str:
        return f"""({l} > 0 AND {al} - {l} > 0 AND ({b} / {l} - ({ab} - {b}) / ({al} - {l})) * ({b} / {l} - ({ab} - {b}) / ({al} - {l}))
    > {Z_SQUARED} * ({ab} / {al}) * (1.0 - {ab} / {al}) * (1.0 / {l} + 1.0 / ({al} - {l})))"""

    return f"""
WITH RECURSIVE known AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM cut),
parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(coalesce(rest, ''), length(raw) + 1), '^[^?#]*') AS path FROM split),
page AS (SELECT parts.*, bad FROM parts LEFT JOIN known USING (page_id)),
paths AS (
  SELECT host, path, count(*) AS n, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad,
    str_split(CASE WHEN starts_with(path, '/') THEN substr(path, 2) ELSE path END, '/') AS raw FROM page GROUP BY host, path),
walk AS (
  SELECT host, path, n, labelled, bad, list_transform(raw, lambda s: {typed}) AS parts, 0 AS depth, '' AS template, true AS more FROM paths
  UNION ALL
  (WITH here AS (SELECT host, path, n, labelled, bad, parts, depth + 1 AS depth, template, parts[depth + 1] AS segment FROM walk WHERE more),
  branches AS (
    SELECT host, template, segment, sum(n) AS n, CAST(sum(labelled) AS BIGINT) AS l, CAST(sum(bad) AS BIGINT) AS b FROM here GROUP BY ALL),
  met AS (
    SELECT *, sum(n) OVER p AS all_n, CAST(sum(l) OVER p AS BIGINT) AS al, CAST(sum(b) OVER p AS BIGINT) AS ab, count(*) OVER p AS children
    FROM branches WINDOW p AS (PARTITION BY host, template)),
  sided AS (
    SELECT *, CASE WHEN starts_with(segment, '{{') OR children = 1 THEN -2 WHEN n >= {SUPPORT} AND {differs("l", "b", "al", "ab")}
      THEN 10 * b // l ELSE -1 END AS tenth FROM met),
  tenths AS (
    SELECT host, template, tenth, sum(l) AS l, sum(b) AS b, count(*) AS children FROM sided WHERE tenth >= 0 GROUP BY ALL),
  follows AS (
    SELECT *, l + lag(l) OVER o AS al, b + lag(b) OVER o AS ab FROM tenths WINDOW o AS (PARTITION BY host, template ORDER BY tenth)),
  runs AS (
    SELECT *, sum(CASE WHEN al IS NULL OR {differs("l", "b", "al", "ab")} THEN 1 ELSE 0 END) OVER (PARTITION BY host, template ORDER BY tenth) AS run
    FROM follows),
  alike AS (
    SELECT host, template, tenth, min(tenth) OVER w AS lowest, sum(children) OVER w AS alike FROM runs WINDOW w AS (PARTITION BY host, template, run)),
  decided AS (
    SELECT host, template, segment, CASE WHEN all_n < {SUPPORT} THEN '**' WHEN tenth = -2 OR alike = 1 THEN segment
      ELSE '*' || coalesce(CAST(lowest AS VARCHAR), '') END AS kept FROM sided LEFT JOIN alike USING (host, template, tenth))
  SELECT host, path, n, labelled, bad, parts, depth, template || '/' || kept, kept <> '**' AND len(parts) > depth
  FROM here JOIN decided USING (host, template, segment))),
templates AS (SELECT host, path, labelled, bad, template FROM walk WHERE NOT more),
overall AS (SELECT (sum(bad) + 1) / (sum(labelled) + 2) AS o FROM templates),
purity AS (
  SELECT host, template, CASE WHEN sum(labelled) > 0 THEN (sum(bad) + {PRIOR} * (SELECT o FROM overall)) / (sum(labelled) + {PRIOR}) END AS purity
  FROM templates GROUP BY host, template)
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
  template, round(purity, 9) AS purity
FROM page JOIN templates USING (host, path) JOIN purity USING (host, template)
"""


#: DuckDB text for ``judged`` over ``pages`` and ``labels``.
SQL = _sql()
