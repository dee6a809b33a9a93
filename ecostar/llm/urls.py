"""URL filter: rules by longest match, else a path-template tree judged by labelled purity.

DataFrame operations only. ``tree_sql`` states the same rules for DuckDB, down to DEPTH levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ecostar.llm.common import ascii_lower, spread_join, staged

#: Fixed values: (host and path prefix, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Levels that ``tree_sql`` spells out, with deeper segments as one tail; ``judge_urls`` reads all levels.
DEPTH = 3
#: A branch with fewer pages than this is variable; one whose labels differ by less than CHI2 from its siblings' merges.
SUPPORT, CHI2 = 5, 3.84
#: Weight of the corpus' purity in a template's, and the purity below which a template is rejected.
PRIOR, PURITY = 10, 0.5


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none; the first of equally long ones."""
    found = F.lit(None)
    chosen = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        at, _, prefix = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + prefix)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return found if chosen is None else chosen


def templates(shapes: DataFrame, support: int, chi2: float, prior: float, purity: float) -> DataFrame:
    """(shape, host, template, verdict) from (shape, host, segs, n, known, good), one row per shape.

    A node is settled where it has fewer than ``support`` pages or labels of one kind at
    most: everything below is variable then, and its paths get their wildcards at once.
    """
    now, done, k = shapes.withColumn("template", F.lit("")), [], 0
    while True:
        done.append(now.filter(F.size("segs") <= k))
        inner = now.filter(F.size("segs") > k).withColumn("seg", F.get("segs", F.lit(k)))
        branch = inner.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(f"b_{c}") for c in ("n", "known", "good")])
        node = branch.groupBy("host", "template").agg(*[F.sum(f"b_{c}").alias(f"t_{c}") for c in ("n", "known", "good")])
        judged = spread_join(branch, node, ["host", "template"], ["seg"])
        rest = F.col("t_known") - F.col("b_known")
        share = F.try_divide("t_good", "t_known")
        apart = F.try_divide("b_good", "b_known") - F.try_divide(F.col("t_good") - F.col("b_good"), rest)
        spread = share * (1 - share) * (F.try_divide(F.lit(1.0), "b_known") + F.try_divide(F.lit(1.0), rest))
        alike = (F.col("b_known") == 0) | (rest == 0) | (spread == 0) | (apart * apart < F.lit(chi2) * spread)
        variable = F.col("seg").contains("#") | (F.col("b_n") < support) | alike
        settled = (F.col("t_n") < support) | (F.col("t_good") == 0) | (F.col("t_good") == F.col("t_known"))
        judged = judged.select("host", "template", "seg", F.when(variable, "*").otherwise(F.col("seg")).alias("token"), settled.alias("settled"))
        named = spread_join(inner, judged, ["host", "template", "seg"], ["shape"])
        below = F.when(F.col("settled"), F.repeat(F.lit("/*"), F.size("segs") - k - 1)).otherwise("")
        named = named.withColumn("template", F.concat("template", F.lit("/"), "token", below)).drop("token", "seg")
        named = staged(named, "url-tree")
        done.append(named.filter("settled").drop("settled"))
        now, k = named.filter("NOT settled").drop("settled"), k + 1
        if now.isEmpty():
            break
    now = staged(reduce(DataFrame.unionByName, done), "url-templates")
    total = now.agg(F.try_divide(F.sum("good"), F.sum("known")).alias("p")).first()["p"]  # one number
    share = 0.5 if total is None else total
    leaf = now.groupBy("host", "template").agg(F.sum("known").alias("l_known"), F.sum("good").alias("l_good"))
    smooth = (F.col("l_good") + F.lit(float(prior) * share)) / (F.col("l_known") + F.lit(float(prior)))
    leaf = leaf.select("host", "template", smooth.alias("purity"), F.when(smooth < purity, "block").otherwise("allow").alias("verdict"))
    return spread_join(now.select("shape", "host", "template"), leaf, ["host", "template"], ["shape"])


def judge_urls(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id",
    label_col: str = "quality", rules=RULES, support: int = SUPPORT, chi2: float = CHI2,
    prior: float = PRIOR, purity: float = PURITY,
) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity), one row per row of ``pages``.

    Every page's path becomes a shape (digits as #); shapes are counted per host before
    anything else, so the tree works on them, not on pages. Level by level a branch
    becomes the wildcard * if it holds digits, has fewer than ``support`` pages, or its
    labels don't differ from its siblings' (chi-square of two shares); the others stay.
    This goes on down to the last segment of every path.
    A template whose labelled purity, smoothed towards the corpus', is below ``purity``
    is rejected. A label is ``label_col`` of the page's id (the larger of two; others than
    0 and 1 are none). The verdict is the rule's where one fits.

    Null urls and those without :// have an empty host and path. Repeated rows are judged
    each and count each; null ids have no label; no labels mean purity 0.5 everywhere.
    """
    url = F.col(url_col)
    base = pages.select(F.col(id_col).alias("id"), url_host(url).alias("host"), url_path(url).alias("path"))
    shape = F.regexp_replace("path", "[0-9]+", "#")
    base = base.withColumn("shape", shape)
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("long").alias("y")).filter("y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    base = staged(base.join(known, "id", "left"), "page-shapes")
    counts = base.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("y").alias("known"), F.coalesce(F.sum("y"), F.lit(0)).alias("good"))
    segs = F.filter(F.split("shape", "/"), lambda s: s != "")
    found = staged(templates(counts.withColumn("segs", segs), support, chi2, prior, purity), "url-verdicts")
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    judged = spread_join(base, found.withColumnRenamed("verdict", "tree_verdict"), ["host", "shape"], ["id", "path"])
    judged = judged.withColumn("_rule", rule)
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "tree_verdict").alias("verdict"), "template", "purity",
    )


def tree_sql(rules=RULES, depth=DEPTH, support=SUPPORT, chi2=CHI2, prior=PRIOR, purity=PURITY) -> str:
    """DuckDB SQL for ``judge_urls`` over pages and labels."""
    levels = []
    for k in range(1, depth + 1):
        levels.append(f"""
i{k} AS (SELECT *, segs[{k}] AS seg FROM t{k - 1}),
b{k} AS (SELECT host, template, seg, sum(n) AS bn, sum(known) AS bk, sum(good) AS bg FROM i{k} WHERE seg IS NOT NULL GROUP BY ALL),
m{k} AS (SELECT *, CAST(sum(bk) OVER (PARTITION BY host, template) AS DOUBLE) AS tk, CAST(sum(bg) OVER (PARTITION BY host, template) AS DOUBLE) AS tg FROM b{k}),
j{k} AS (SELECT host, template, seg, CASE WHEN contains(seg, '#') OR bn < {support} OR bk = 0 OR tk - bk = 0
    OR (tg / tk) * (1 - tg / tk) * (1.0::DOUBLE / bk + 1.0::DOUBLE / (tk - bk)) = 0
    OR pow(bg / bk::DOUBLE - (tg - bg) / (tk - bk), 2) < {chi2}::DOUBLE * ((tg / tk) * (1 - tg / tk) * (1.0::DOUBLE / bk + 1.0::DOUBLE / (tk - bk)))
    THEN '*' ELSE seg END AS token FROM m{k}),
t{k} AS (SELECT i.host, i.shape, i.segs, i.n, i.known, i.good,
    i.template || CASE WHEN i.seg IS NULL THEN '' ELSE '/' || j.token END AS template
  FROM i{k} i LEFT JOIN j{k} j ON i.host = j.host AND i.template = j.template AND i.seg = j.seg)""")
    cases = "".join(
        f"WHEN (p.host = '{h}' OR ends_with(p.host, '.{h}')) AND starts_with(p.path, '/{p}') THEN '{r}' "
        for r, _ in sorted(rules, key=lambda r: -len(r[0])) for h, _, p in [r.partition("/")]
    )
    verdicts = "".join(f"WHEN '{r}' THEN '{v}' " for r, v in rules)
    return f"""
WITH y AS (SELECT doc_id, max(quality) AS y FROM labels WHERE quality IN (0, 1) GROUP BY 1),
raw AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
p AS (SELECT raw.*, regexp_replace(path, '[0-9]+', '#', 'g') AS shape, y.y FROM raw LEFT JOIN y ON page_id = doc_id),
t0 AS (SELECT host, shape, list_filter(string_split(shape, '/'), lambda s: s <> '') AS segs, count(*) AS n, count(y) AS known,
  coalesce(sum(y), 0) AS good, '' AS template FROM p GROUP BY host, shape),{",".join(levels)},
f AS (SELECT host, shape, known, good, template || CASE WHEN len(segs) > {depth} THEN '/**' ELSE '' END AS template FROM t{depth}),
g AS (SELECT coalesce(CAST(sum(good) AS DOUBLE) / sum(known), 0.5) AS share FROM f),
l AS (SELECT host, template, (sum(good) + {float(prior)}::DOUBLE * any_value(share)) / (sum(known) + {float(prior)}::DOUBLE) AS purity
  FROM f, g GROUP BY host, template),
r AS (SELECT p.page_id, p.host, p.path, CASE {cases}END AS rule, f.template, l.purity
  FROM p JOIN f ON p.host = f.host AND p.shape = f.shape JOIN l ON f.host = l.host AND f.template = l.template)
SELECT page_id, host, path, rule, CASE rule {verdicts}ELSE CASE WHEN purity < {purity} THEN 'block' ELSE 'allow' END END AS verdict,
  template, purity FROM r"""
