"""SimHash near-dedup over a hierarchical index of fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ecostar.llm.common import drop_staged, let_go, spread_join, staged
from ecostar.llm.graph import components

WORDS, SEED, DISTANCE = 4, 42, 4
#: Blocks that linked fingerprints share exactly: any two within ``DISTANCE`` agree on so many of DISTANCE + SHARED.
SHARED = 2
#: Fingerprints of one cell of the index; a larger cell is searched in pairs of its chunks, each this large.
CHUNK = 50_000
#: Children of a node, and queries per cell between two looks at what is linked already.
FANOUT, FIRST = 8, 64


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all shingles; no words: 0."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    whole = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = min(words, len(parts)) - 1
    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(parts) - last
    for at in range(0, total, 4096):  # bounded memory for any length
        spans = zip(starts[at : min(at + 4096, total)].tolist(), ends[last:][at : at + 4096].tolist(), strict=True)
        h = np.fromiter((digest(whole[a:b], seed) for a, b in spans), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    let_go()
    for pdf in batches:
        prints = np.array([fingerprint(t) for t in pdf["text"]], np.uint64).view(np.int64)
        yield pd.DataFrame({"id": pdf["id"], "fp": prints, "text_key": pdf["text_key"]})


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the order of the binary reflected Gray code."""
    rank = fp.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    return rank


class Index:
    """Forest over cells of fingerprints sorted by Gray rank.

    A node holds the bits that all fingerprints below it share and that no node above
    it holds yet (mask and value). Searching adds up the differences in those masks
    from the root down; a node whose sum is beyond the distance goes with all below it.
    """

    def __init__(self, cell: np.ndarray, fp: np.ndarray):
        """``cell``: number of each fingerprint's cell, ascending; in a cell fp is in Gray order."""
        self.first, self.ones, self.zeros, self.cells = [np.arange(len(fp))], [fp], [~fp], [cell]
        while len(self.cells[-1]) and (self.cells[-1][1:] == self.cells[-1][:-1]).any():
            cells = self.cells[-1]
            start = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
            within = np.arange(len(cells)) - np.repeat(start, np.diff(np.append(start, len(cells))))
            heads = np.flatnonzero(within % FANOUT == 0)
            self.first.append(heads)
            self.ones.append(np.bitwise_and.reduceat(self.ones[-1], heads))
            self.zeros.append(np.bitwise_and.reduceat(self.zeros[-1], heads))
            self.cells.append(cells[heads])
        self.ends = [np.append(h[1:], len(below)) for h, below in zip(self.first[1:], self.cells, strict=False)]
        self.parent = [np.repeat(np.arange(len(h)), e - h) for h, e in zip(self.first[1:], self.ends, strict=True)]
        self.mask = [o | z for o, z in zip(self.ones, self.zeros, strict=True)]
        for level, up in enumerate(self.parent):
            self.mask[level] = self.mask[level] & ~(self.ones[level + 1] | self.zeros[level + 1])[up]
        self.last = [np.arange(len(fp))]  # last leaf below each node
        for e in self.ends:
            self.last.append(self.last[-1][e - 1])

    def search(self, queries: np.ndarray, fp: np.ndarray, distance: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later leaf) within ``distance``; nodes linked to the query as a whole already are left out."""
        low, high = [label], [label]
        for h in self.first[1:]:
            low.append(np.minimum.reduceat(low[-1], h))
            high.append(np.maximum.reduceat(high[-1], h))
        top = len(self.mask) - 1
        q, node = queries, np.searchsorted(self.cells[top], self.cells[0][queries])
        sums = np.zeros(len(q), np.int64)
        for level in range(top, -1, -1):
            sums = sums + np.bitwise_count((fp[q] ^ self.ones[level][node]) & self.mask[level][node])
            known = (low[level][node] == label[q]) & (high[level][node] == label[q])
            go = (sums <= distance) & (self.last[level][node] > q) & ~known
            q, node, sums = q[go], node[go], sums[go]
            if level:
                first, end = self.first[level][node], self.ends[level - 1][node]
                n = end - first
                q, sums = np.repeat(q, n), np.repeat(sums, n)
                node = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return q, node


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least label of each group after linking a and b; labels are positions of group heads."""
    a, b = label[a], label[b]
    while True:
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            break
        low, high = low[open_], high[open_]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
        a, b = label[low], label[high]
    return label


def link_cells(cell: np.ndarray, fp: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within cells: (fingerprint, another of its group)."""
    order = np.lexsort((gray_rank(fp), cell))
    cell, fp = cell[order], fp[order]
    start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(start, len(cell)))
    more = np.repeat(size > 1, size)
    cell, fp = cell[more], fp[more]
    if not len(fp):
        return fp, fp
    index, label = Index(cell, fp), np.arange(len(fp))
    start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    within = np.arange(len(cell)) - np.repeat(start, np.diff(np.append(start, len(cell))))
    for at in range(0, int(within.max()) + 1, FIRST):
        queries = np.flatnonzero((within >= at) & (within < at + FIRST)) if at else np.flatnonzero(within < FIRST)
        for part in np.array_split(queries, -(-len(queries) // 4096)):
            label = _merge(label, *index.search(part, fp, distance, label))
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by cell; the last cell of a batch waits for the next one."""
    held: list[pd.DataFrame] = []

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        names = rows[["key", "i", "j"]].to_numpy()
        cell = np.append(0, np.cumsum((names[1:] != names[:-1]).any(axis=1)))
        a, b = link_cells(cell, rows["fp"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    for pdf in batches:
        if not len(pdf):
            continue
        last = (pdf[["key", "i", "j"]] == pdf[["key", "i", "j"]].iloc[-1]).all(axis=1).to_numpy()
        if not last.all() or (held and (held[-1][["key", "i", "j"]].iloc[-1] != pdf[["key", "i", "j"]].iloc[0]).any()):
            done = pd.concat([*held, pdf[~last]])
            held = []
            if len(done):
                yield solve(done)
            held = [pdf[last]]
        else:
            held.append(pdf)
    if held:
        yield solve(pd.concat(held))


def near_links(prints: DataFrame, distance: int = DISTANCE, shared: int = SHARED, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (fp) within ``distance``, by a forest per cell.

    64 bits make distance + shared blocks; fingerprints within the distance agree on
    some ``shared`` of them, so a cell per choice of blocks and their bits has each
    linked pair. ``shared`` raises the number of cells with the corpus. A cell with more
    than ``chunk`` fingerprints is dealt to chunks and searched per pair of chunks, which
    misses no pair.
    """
    blocks = distance + shared
    bounds = [64 * i // blocks for i in range(blocks + 1)]

    def value(i):
        return F.shiftrightunsigned("fp", bounds[i]).bitwiseAND(F.lit((1 << bounds[i + 1] - bounds[i]) - 1))

    keys = []
    for n, chosen in enumerate(combinations(range(blocks), shared)):
        key = F.lit(n).cast("long")
        for i in chosen:
            key = F.shiftleft(key, bounds[i + 1] - bounds[i]).bitwiseOR(value(i))
        keys.append(key)
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = staged(keyed.groupBy("key").count().filter(F.col("count") > chunk), "large-cells")
    if large.isEmpty():
        cells = keyed.withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    else:
        n = F.coalesce(F.ceil(F.col("count") / chunk), F.lit(1)).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        others = F.when(F.col("n") > 1, F.array_remove(F.sequence(F.lit(0), F.col("n") - 1), F.col("own"))).otherwise(F.array(F.lit(0)))
        cells = keyed.join(large, "key", "left").withColumn("n", n).withColumn("own", own)
        cells = cells.withColumn("other", F.explode(others)).select(
            "key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
        )
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(_links, "a long, b long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """(id, fingerprint, component_id, text_key), one row per row of ``docs``; text_key is a hash of the text.

    component_id is the least id reachable by links of at most ``distance`` bits. Null and
    empty texts have fingerprint zero and link like any other; null ids never become a
    component's id unless no other is in it (then null). Repeated rows get the same
    component. Equal fingerprints are one node of the graph, and documents meet their
    node over a spread join, so a text with any number of copies stays spread.
    """
    prints = staged(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
        .mapInPandas(_fingerprints, "id long, fp long, text_key long"), "fingerprints"
    )
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    links = staged(near_links(nodes.select("fp"), distance), "near-links")
    roots = components(links).withColumnRenamed("node", "fp")
    drop_staged(links)
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    found = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = spread_join(rooted, found, ["root"], ["fp"]).select("fp", "component_id")
    return spread_join(prints, named, ["fp"], ["id"]).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_key"
    )
