"""Article text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ecostar.llm import dom
from ecostar.llm.common import spread_join, staged
from ecostar.llm.urls import url_host

#: Pages of a host whose trees the others are aligned with, as a host may have several layouts.
REFERENCES = 3
#: A text is of the template where it stands at a node in this share of the pages and in this many different ones.
SHARE, LEAST = 0.8, 4
#: Wrappers of all hosts are sent to every task up to this size; beyond, pages meet them in a join.
SENT_BYTES = 32 << 20

_WRAPPER = "array<struct<tree: string, fixed: array<struct<node: int, hash: long>>>>"


class Wrapper:
    """The reference trees of a host and, per tree, the (node, text hash) pairs of its template."""

    def __init__(self, references):
        self.trees = [dom.Tree.load(r["tree"]) for r in references]
        self.fixed = [{(f["node"], f["hash"]) for f in r["fixed"]} for r in references]

    def align(self, page: dom.Page) -> tuple[int, list[int]]:
        """(reference, its node per element of the page, -1 where none): the tree that matches best, the first of equal ones."""
        tree, number = page.tree()
        best, at, to = -1.0, 0, {}
        for i, reference in enumerate(self.trees):
            found = dom.simple_tree_matching(tree, reference)
            score = 2 * len(found) / (len(tree.labels) + len(reference.labels))
            if score > best:
                best, at, to = score, i, found
        return at, [to.get(n, -1) for n in number]

    def content(self, page: dom.Page) -> list[str]:
        """Texts of the page's region that are not of the template; all where nothing varies, as nothing tells them apart then."""
        if any(self.fixed):
            at, to = self.align(page)
            varying = [text for e, text in page.kept if (to[e], dom.digest(text)) not in self.fixed[at]]
            if varying:
                return varying
        return [text for _, text in page.kept]


def _pages(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, dom.Page, Wrapper]]:
    """Each row with its page and the wrapper of its host, which is read once per host and batch."""
    for pdf in batches:
        known: dict = {}
        for row in pdf.itertuples(index=False):
            if row.host not in known:
                known[row.host] = Wrapper([] if row.wrapper is None else row.wrapper)
            yield row, dom.Page(row.html), known[row.host]


def _rows(rows: Iterator[tuple], names: list[str], held: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """Frames of bounded size; a text counts with its length."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, str))
        if size > held:
            yield pd.DataFrame(out, columns=names)
            out, size = [], 0
    if out:
        yield pd.DataFrame(out, columns=names)


def _met(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Pages with the wrapper of their host, null where it has none."""
    if (wrappers.agg(F.sum("bytes")).first()[0] or 0) <= SENT_BYTES:
        return pages.join(F.broadcast(wrappers.drop("bytes")), "host", "left")
    return spread_join(pages, wrappers.drop("bytes"), ["host"], ["id", "url"], "left")


def _references(pages: DataFrame) -> DataFrame:
    """(host, reference, tree) of the pages with the smallest hashes per host; chosen by urls, only theirs are read."""
    keyed = pages.withColumn("draw", F.xxhash64("id", "url"))
    first = W.partitionBy("host").orderBy("draw")
    chosen = keyed.select("host", "draw").distinct().withColumn("reference", F.row_number().over(first)).filter(F.col("reference") <= REFERENCES)

    def trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["host", "reference", "tree"]
        yield from _rows(((r.host, r.reference, dom.Page(r.html).tree()[0].dump()) for pdf in batches for r in pdf.itertuples(index=False)), names)

    chosen = staged(chosen, "reference-pages")  # its size is known now, so that pages needn't be shuffled for a few of them
    found = keyed.join(chosen, ["host", "draw"]).select("host", "reference", "html").mapInPandas(trees, "host string, reference int, tree string")
    return staged(found.groupBy("host", "reference").agg(F.min("tree").alias("tree")), "page-trees")


def _templates(pages: DataFrame, trees: DataFrame) -> DataFrame:
    """(host, reference, fixed): the texts that stand at one node of a reference in nearly all pages aligned with it.

    Pages count once per set of texts, so that copies prove nothing.
    """
    none = F.array().cast("array<struct<node: int, hash: long>>")
    bare = F.array_sort(F.collect_list(F.struct("reference", "tree")))
    wrappers = trees.groupBy("host").agg(F.transform(bare, lambda r: F.struct(r["tree"].alias("tree"), none.alias("fixed"))).alias("wrapper"))

    def observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def seen():
            for row, page, wrapper in _pages(batches):
                at, to = wrapper.align(page)
                hashes = [dom.digest(text) for _, text in page.kept]
                page_hash = dom.digest(" ".join(map(str, hashes)))
                yield row.host, at, page_hash, -2, 0
                for node, h in {(to[e], h) for (e, _), h in zip(page.kept, hashes, strict=True)}:
                    if node >= 0:
                        yield row.host, at, page_hash, node, h

        yield from _rows(seen(), ["host", "at", "page", "node", "hash"])

    met = _met(pages, _sized(wrappers)).filter("wrapper IS NOT NULL")
    seen = met.select("host", "html", "wrapper").mapInPandas(observe, "host string, at int, page long, node int, hash long")
    counts = seen.distinct().groupBy("host", "at", "node", "hash").agg(F.count("*").alias("n"))
    often = staged(counts.filter((F.col("n") >= LEAST) | (F.col("node") == -2)), "page-texts")
    total = often.filter("node = -2").select("host", "at", F.col("n").alias("total"))
    fixed = often.filter("node >= 0").join(total, ["host", "at"]).filter(F.col("n") >= F.col("total") * SHARE)
    return fixed.groupBy("host", "at").agg(F.collect_list(F.struct("node", "hash")).alias("fixed"))


def _sized(wrappers: DataFrame) -> DataFrame:
    return staged(wrappers.withColumn("bytes", F.octet_length(F.to_json("wrapper"))), "wrappers")


def _host(url: Column) -> Column:
    return F.nullif(url_host(url), F.lit(""))


def articles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars): the main text of every row of ``pages``.

    Folded DOM trees of a host's pages are aligned, by simple tree matching, with the trees
    of up to REFERENCES of its pages. Texts that stand at one node in nearly all of them are
    the template, the varying ones content, whatever their number of pages: counts are taken
    over all pages. Within a page the region is its article (else its main or content
    element, else the body) without elements whose kind, role or name says that they are
    something else. Blocks are joined by two line breaks, white space in one becomes a space.

    Pages are read twice and not shuffled; per text a hash and a node number is. Hosts with
    fewer than LEAST different pages, pages without a host and pages that nothing varies in
    keep all texts of their region. A null or empty html gives an empty text, broken markup
    is read as browsers do for open and stray tags; a null url has no host. Repeated rows
    are read each. No rows give no rows; other columns, whatever their names, are not read.
    """
    base = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(F.col(url_col)).alias("host")
    )
    hosted = base.filter("host IS NOT NULL")
    trees = _references(hosted)
    templates = _templates(hosted, trees)
    both = trees.withColumn("at", F.col("reference") - 1).join(templates, ["host", "at"], "left")
    none = F.array().cast("array<struct<node: int, hash: long>>")
    parts = F.array_sort(F.collect_list(F.struct("reference", "tree", F.coalesce("fixed", none).alias("fixed"))))
    wrappers = both.groupBy("host").agg(F.transform(parts, lambda r: F.struct(r["tree"].alias("tree"), r["fixed"].alias("fixed"))).alias("wrapper"))
    # a host without a template needs no alignment
    wrappers = _sized(wrappers.filter(F.exists("wrapper", lambda r: F.size(r["fixed"]) > 0)))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = ((row.id, row.url, "\n\n".join(wrapper.content(page))) for row, page, wrapper in _pages(batches))
        for out in _rows(found, ["id", "url", "text"]):
            yield out.astype({"id": "Int64"}) if whole else out

    kind = base.schema["id"].dataType.simpleString()
    whole = kind in ("bigint", "int")
    texts = _met(base, wrappers).select("id", "url", "host", "html", "wrapper").mapInPandas(extract, f"id {kind}, url string, text string")
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
