"""License notices: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

DataFrame operations only. ``scan_sql`` states the result for DuckDB by brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ecostar.llm.common import ascii_lower, let

#: License and its notice, as publishers print them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
WORDS, CONTAINMENT = 5, 0.8
#: Shingles of a window (they overlap by all but one) and bands, of one value each.
WINDOW, BANDS = 2, 8
#: Words looked at beyond a template's own length, as a share of it, on either side.
SLACK = 4


def _words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _mixed(value: Column, band: int) -> Column:
    """Another order of 64-bit hashes for each band."""
    return value.bitwiseXOR(F.lit((0x9E3779B97F4A7C15 * (band + 1) % (1 << 64)) - (1 << 63)))


def _hashes(words: Column) -> Column:
    """Hash of each shingle; a text with fewer words is one shingle."""
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]))


def _window(hashes: Column, i: Column, band: int) -> Column:
    """MinHash of the window at i; a window beyond the last shingle holds fewer."""
    return F.least(*[_mixed(F.coalesce(F.get(hashes, i + k), F.get(hashes, i)), band) for k in range(WINDOW)])


def _shingles(words: Column) -> Column:
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))
    return F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice(words, i + 1, WORDS), " ")))


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """(id, license, containment, word_start), one row per document and template found in it.

    A window is two neighbouring five-word shingles (six words), so any shingle lies in
    two windows. A window that shares one of its shingles with a template's window has a
    Jaccard similarity of 1/3 at least and collides in one of eight bands with probability
    1 - (2/3)^8 = 0.96; a run of k shared shingles has k + 1 such windows, and whole windows
    always collide. A collision aligns the text with the template; of the region there (a
    quarter of the template more on either side), the share of the template's distinct
    shingles that occur is the containment, kept from ``containment`` on. The best
    alignment counts, the first of equally good ones; word_start is its place (from 0, may
    be negative where a template's start is cut).

    Words are runs of a-z and 0-9 after lower-casing A-Z. All work on a text happens in its
    row, so hot sources or repeated texts move nothing. Templates (some dozens, a parameter)
    are literals of the plan. Null and blank texts match nothing, repeated rows are
    reported each, templates without words are refused.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    if not templates:
        return docs.select(F.col(id_col), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("word_start")).limit(0)
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string").withColumn("w", _words(F.col("text")))
    hashed = rows.withColumn("h", _hashes(F.col("w"))).withColumn("s", _shingles(F.col("w")))
    windows = hashed.withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.size("h") - 2, F.lit(0)))))
    bands = [_window(F.col("h"), F.col("i"), b).alias(f"b{b}") for b in range(BANDS)]
    known = windows.select("license", "i", F.size("w").alias("n"), "s", F.slice("h", F.col("i") + 1, WINDOW).alias("h"), *bands).orderBy("license", "i").collect()
    if any(not r["n"] for r in known):
        raise ValueError("a template has no words")
    values = [sorted({r[f"b{b}"] for r in known}) for b in range(BANDS)]
    marks = [F.create_map(*[F.lit(x) for r in _by_value(known, b) for x in r]) for b in range(BANDS)]

    window = F.array(*[
        F.struct(F.lit(r["license"]).alias("license"), F.lit(r["i"]).alias("o"), F.lit(r["n"]).alias("n"), F.array(*[F.lit(x) for x in r["s"]]).alias("s"), F.array(*[F.lit(x) for x in r["h"]]).alias("h"))
        for r in known
    ])

    def hits(hashes: Column) -> Column:
        """Template window k and start of the template in the text, for each shingle shared by colliding windows."""
        at = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 2, F.lit(0)))

        def collides(i):
            out = F.lit(False)
            for b in range(BANDS):
                out = out | _window(hashes, i, b).isin(values[b])
            return out

        def aligned(i, k):
            t = F.get(window, k)
            pairs = [(x, y) for x in range(WINDOW) for y in range(WINDOW)]
            same = [F.when(F.get(hashes, i + x) == F.get(t["h"], F.lit(y)), i + x - t["o"] - y) for x, y in pairs]
            return F.transform(F.filter(F.array(*same), lambda s: s.isNotNull()), lambda s: F.struct(k.alias("k"), s.alias("start")))

        def retrieved(i):
            ks = F.array(*[F.try_element_at(marks[b], _window(hashes, i, b)) for b in range(BANDS)])
            ks = F.array_distinct(F.flatten(F.filter(ks, lambda x: x.isNotNull())))
            return F.flatten(F.transform(ks, lambda k: aligned(i, k)))

        return F.flatten(F.transform(F.filter(at, collides), retrieved))

    split = docs.select(F.col(id_col).alias("id"), _words(F.coalesce(text_col, F.lit(""))).alias("words")).filter(F.size("words") > 0)
    found = split.select("id", let(F.col("words"), lambda w: F.struct(w.alias("words"), let(_hashes(w), hits).alias("hits"))).alias("x"))
    found = found.select("id", "x.words", "x.hits").filter(F.size("hits") > 0)

    def aligned(words: Column) -> Column:
        """Distinct (template, start) of the hits, with the containment there."""
        starts = F.array_distinct(
            F.transform("hits", lambda h: let(F.get(window, h["k"]), lambda t: F.struct(t["license"].alias("license"), t["n"].alias("n"), t["s"].alias("s"), h["start"].alias("start"))))
        )

        def judged(t):
            slack = F.floor(t["n"] / SLACK).cast("int")
            first = F.greatest(t["start"] - slack, F.lit(0))
            region = F.slice(words, first + 1, F.greatest(t["start"] + t["n"] + slack - first, F.lit(0)))
            share = F.size(F.array_intersect(_shingles(region), t["s"])).cast("double") / F.size(t["s"])
            return F.struct(t["license"].alias("license"), share.alias("containment"), t["start"].cast("long").alias("word_start"))

        return F.filter(F.transform(starts, judged), lambda m: m["containment"] >= containment)

    matches = found.select("id", aligned(F.col("words")).alias("matches"))

    def best(ms: Column) -> Column:
        return F.filter(ms, lambda m: ~F.exists(ms, lambda o: (o["license"] == m["license"]) & (
            (o["containment"] > m["containment"]) | ((o["containment"] == m["containment"]) & (o["word_start"] < m["word_start"])))))

    return matches.withColumn("m", F.explode(let(F.col("matches"), best))).select(
        F.col("id").alias(id_col), "m.license", "m.containment", "m.word_start"
    )


def _by_value(known, band: int) -> list[tuple]:
    out: dict[int, list[int]] = {}
    for k, r in enumerate(known):
        out.setdefault(r[f"b{band}"], []).append(k)
    return sorted(out.items())


def scan_sql(templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> str:
    """DuckDB SQL for ``scan`` over documents: every shared shingle aligns, without bands."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted((templates or TEMPLATES).items()))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "list_filter(string_split_regex({}, '[^a-z0-9]+'), lambda w: w <> '')"
    shingle = "list_transform(range(0, greatest(len(w) - {n}, 0) + 1), lambda i: array_to_string(w[i + 1 : i + {n}], ' '))".format(n=WORDS)
    return f"""
WITH raw(license, body) AS (VALUES {values}),
tw AS (SELECT license, {words.format(lower.format("body"))} AS w FROM raw),
t AS (SELECT license, len(w) AS n, {shingle} AS s FROM tw),
ts AS (SELECT license, n, len(list_distinct(s)) AS m, list_distinct(s) AS s, unnest(s) AS sh, generate_subscripts(s, 1) - 1 AS o FROM t),
dw AS (SELECT doc_id, {words.format(lower.format("coalesce(text, '')"))} AS w FROM documents),
d AS (SELECT doc_id, {shingle} AS s FROM dw WHERE len(w) > 0),
ds AS (SELECT doc_id, unnest(s) AS sh, generate_subscripts(s, 1) - 1 AS i FROM d),
al AS (SELECT DISTINCT ds.doc_id, ts.license, ts.n, ts.m, ts.s, ds.i - ts.o AS start FROM ds JOIN ts USING (sh)),
r AS (SELECT al.*, dw.w[greatest(start - n // {SLACK}, 0) + 1 : start + n + n // {SLACK}] AS region FROM al JOIN dw USING (doc_id)),
x AS (SELECT doc_id, license, m, start, s, (SELECT list_distinct({shingle}) FROM (SELECT region AS w)) AS rs FROM r),
c AS (SELECT doc_id, license, len(list_intersect(rs, s))::DOUBLE / m AS containment, start FROM x)
SELECT doc_id, license, containment, min(start) AS word_start FROM c WHERE containment >= {containment}
AND containment = (SELECT max(c2.containment) FROM c c2 WHERE c2.doc_id = c.doc_id AND c2.license = c.license)
GROUP BY doc_id, license, containment"""
