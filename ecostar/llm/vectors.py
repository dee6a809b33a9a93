"""Embedding near-dedup over a robust-pruned flat graph built on overlapping cluster shards."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ecostar.llm.common import drop_staged, spread_join, staged
from ecostar.llm.graph import components

COSINE = 0.93
#: Only vectors of equal label and length are compared.
GROUP = ["label", "dim"]
#: Vectors per centre (a shard holds ``OVERLAP`` times as many), shards that a vector goes to, most centres of a label.
SHARD_ROWS, OVERLAP, CENTRES = 300, 3, 8192
#: A centre this near to an earlier one is left out, so that a dense group shares its shards.
APART = 0.9
#: Vectors of a chunk; a larger shard is searched in pairs of its chunks, so a cell holds two at most.
CHUNK = 3000
#: Out-degree, pruning slack, beam, nodes expanded per step (more where many lie in range), queries per block.
DEGREE, ALPHA, BEAM, STEP, WIDE, BLOCK = 16, 1.2, 16, 8, 64, 256
#: Vectors of one task when centres are looked up.
PART = 50_000
#: Up to this many centres ``OVERLAP`` is as given; a shard more for every doubling, as near pairs share fewer of many cells.
FEW_CENTRES = 16
#: Planted vectors of a label at most and per so many of its own, the range of their cosines, and the share that must be found.
AUDIT, AUDIT_SHARE, PLANTED, RECALL = 256, 8, (0.932, 0.97), 0.95


def usable(embedding: Column, label: Column, id_: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(embedding, lambda x: x != 0)
    return F.coalesce(id_.isNotNull() & label.isNotNull() & embedding.isNotNull() & finite & some, F.lit(False))


def unit(embeddings) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows."""
    v = np.stack([np.asarray(e, float) for e in embeddings])
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def apart(c: np.ndarray, cosine: float = APART) -> np.ndarray:
    """Positions of the unit vectors that have no earlier kept one at ``cosine`` or more."""
    kept = np.empty(0, int)
    for at in range(0, len(c), 512):
        block = np.arange(at, min(at + 512, len(c)))
        block = block[(c[block] @ c[kept].T < cosine).all(axis=1)]
        near, free = c[block] @ c[block].T >= cosine, np.ones(len(block), bool)
        for i in range(len(block)):
            if free[i]:
                free[i + 1 :] &= ~near[i, i + 1 :]
        kept = np.append(kept, block[free])
    return kept


def nearest_centres(v: np.ndarray, c: np.ndarray, overlap: int) -> list[list[int]]:
    """Ascending numbers of each vector's nearest centres; one shard for all where every vector would go to every centre's."""
    kept = apart(c)
    if len(kept) <= overlap:
        return [[0]] * len(v)
    shards, rows = [], max(1, (1 << 22) // len(kept))  # bounded memory for any number of centres
    for at in range(0, len(v), rows):
        near = np.argpartition(-(v[at : at + rows] @ c[kept].T), overlap - 1, axis=1)[:, :overlap]
        shards += np.sort(kept[near], axis=1).tolist()
    return shards


def reach(overlap: int, centres: int) -> int:
    """Shards of a vector: ``overlap``, and one more for every doubling of the centres."""
    return overlap + max(0, int(np.ceil(np.log2(max(centres, 1) / FEW_CENTRES))))


def _assign(left: pd.DataFrame, right: pd.DataFrame, overlap: int) -> pd.DataFrame:
    """Each vector with its shards: its nearest centres, by their places in the order of ids."""
    shards = [[0]] * len(left)
    if len(left) and len(right):
        shards = nearest_centres(unit(left["embedding"]), unit(right.sort_values("rep")["embedding"]), reach(overlap, len(right)))
    return left.assign(shards=shards)[["rep", "planted", "label", "dim", "embedding", "copies", "shards"]]


def robust_prune(sims: np.ndarray, near: np.ndarray, v: np.ndarray) -> list[int]:
    """Of candidates ``near`` (nearest first, similarity ``sims``) those not shadowed by a kept nearer one."""
    kept, alive = [], np.ones(len(near), bool)
    far = 1 - sims
    among = 1 - v[near] @ v[near].T
    for i in range(len(near)):
        if alive[i]:
            kept.append(int(near[i]))
            if len(kept) == DEGREE:
                break
            alive &= ALPHA * among[i] > far
            alive[: i + 1] = False
    return kept


def build_graph(v: np.ndarray) -> list[list[int]]:
    """Out-neighbours of each vector of a cell: robust pruning of its nearest and some spread-out ones, then back links."""
    n, out = len(v), []
    spread = np.unique(np.linspace(0, n - 1, min(n, DEGREE)).astype(int))
    for at in range(0, n, 512):
        sims = v[at : at + 512] @ v.T
        width = min(2 * DEGREE + 1, n)
        nearest = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        for row, (s, near) in enumerate(zip(sims, nearest, strict=True)):
            near = np.setdiff1d(np.append(near, spread), [at + row])
            near = near[np.argsort(-s[near], kind="stable")]
            out.append(robust_prune(s[near], near, v))
    back: list[list[int]] = [[] for _ in range(n)]
    for a, links in enumerate(out):
        for b in sorted(links, key=lambda b: len(back[b]))[: DEGREE // 2]:  # the least referred to, so that all are reached
            back[b].append(a)
    return [list(dict.fromkeys([*o, *b])) for o, b in zip(out, back, strict=True)]


def flat(graph: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(first, to): node i's neighbours are to[first[i] : first[i + 1]], so that hubs widen no other node."""
    first = np.append(0, np.cumsum([len(links) for links in graph]))
    return first, np.fromiter((b for links in graph for b in links), np.int64, int(first[-1]))


def range_search(v: np.ndarray, graph: tuple[np.ndarray, np.ndarray], queries: np.ndarray, starts: np.ndarray, cosine: float) -> np.ndarray:
    """(queries, n) booleans: members met at ``cosine`` or more; ``graph`` as of ``flat``.

    Greedy search from the medoids and the query's own node expands the best open members
    of the beam; whatever lies in range is expanded too, beam or not, until nothing in
    either is open.
    """
    n, (first, to_) = len(v), graph
    sims = np.full((len(queries), n), -2.0)
    open_ = np.zeros((len(queries), n), bool)
    sims[:, starts] = v[queries] @ v[starts].T
    open_[:, starts] = True
    own = np.arange(len(queries))
    sims[own, queries], open_[own, queries] = 1.0, True
    active = np.arange(len(queries))
    while len(active):
        s = sims[active]
        beam = np.partition(s, n - min(BEAM, n), axis=1)[:, n - min(BEAM, n)]
        still = open_[active]
        go = np.where(still & (s >= np.minimum(beam, cosine)[:, None]), s, -3.0)
        k = min(n, max(STEP, min(WIDE, int((still & (s >= cosine)).sum(axis=1).max()))))
        best = np.argpartition(-go, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(active), 1))
        picked = np.take_along_axis(go, best, axis=1) > -3.0
        rows = np.repeat(active, picked.sum(axis=1))
        nodes = best[picked]
        open_[rows, nodes] = False
        degree = first[nodes + 1] - first[nodes]
        q = np.repeat(rows, degree)
        to = to_[np.repeat(first[nodes] - (np.cumsum(degree) - degree), degree) + np.arange(len(q))]
        new = sims[q, to] == -2.0
        codes = np.unique(q[new] * n + to[new])
        q, to = codes // n, codes % n
        sims[q, to] = np.einsum("ij,ij->i", v[queries[q]], v[to])
        open_[q, to] = True
        active = active[picked.any(axis=1)]
    found = sims >= cosine
    found[np.arange(len(queries)), queries] = False
    return found


def _chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["planted", "rep"], ignore_index=True)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = _chunks(pdf)
    reps, planted = pdf["rep"].to_numpy(), pdf["planted"].to_numpy()
    graph = build_graph(unit(pdf["embedding"]))
    a, b = (np.array(x, np.int64) for x in (np.repeat(np.arange(len(reps)), [len(g) for g in graph]), [b for g in graph for b in g]))
    out = pd.DataFrame({"rep": reps[a], "planted": planted[a], "near": reps[b], "near_planted": planted[b]})
    return out.assign(label=pdf["label"].iloc[0], dim=pdf["dim"].iloc[0])[["rep", "planted", "label", "dim", "near", "near_planted"]]


def _search(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of a cell that are counted here (the pair's lowest common shard, and of its chunk pairs one) and groups by all links found.

    Planted vectors are searched like others; only whether their source was met is told.
    """
    pdf = _chunks(pdf)
    v, reps, planted = unit(pdf["embedding"]), pdf["rep"].to_numpy(), pdf["planted"].to_numpy()
    n, own = len(v), int((~planted).sum())  # the planted ones come last
    place, place_planted = {r: i for i, r in enumerate(reps[:own])}, {r: i for i, r in enumerate(reps[own:], own)}
    found = np.zeros((n, n), bool)
    lists = [
        [at[x] for near, at in ((a, place), (b, place_planted)) if near is not None for x in near if x in at]
        for a, b in zip(pdf["near"], pdf["near_planted"], strict=True)
    ]
    graph = flat(lists)
    means = [m.mean(axis=0) for m in np.array_split(v, -(-n // 256))]
    starts = np.unique([int((v @ m).argmax()) for m in (v.mean(axis=0), *means)])
    for at in range(0, n, BLOCK):
        queries = np.arange(at, min(at + BLOCK, n))
        found[queries] = range_search(v, graph, queries, starts, cosine)
    found |= found.T
    shards, here = pdf["shards"].map(list).to_list(), int(pdf["shard"].iloc[0])
    width = max(map(len, shards))
    of = np.array([[*s, *[-1 - i] * (width - len(s))] for i, s in enumerate(shards)], np.int64)
    chunk, parts = pdf["own"].to_numpy(), int(pdf["parts"].iloc[0])
    i_, j_ = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    other = np.where(chunk == i_, j_, i_)
    whole = (parts == 1) | (other == (chunk + 1) % parts)
    copies, links, met = pdf["copies"].to_numpy(), np.zeros(n, np.int64), np.zeros(n, bool)
    for a in np.flatnonzero(found.any(axis=1)):
        near = np.flatnonzero(found[a])
        common = (of[a][None, :, None] == of[near][:, None, :]).any(axis=2)
        first = np.where(common, of[a][None], np.iinfo(np.int64).max).min(axis=1)
        ours = (first == here) & ((chunk[near] != chunk[a]) | whole[a])
        links[a], met[a] = copies[near[ours]].sum(), bool(planted[a]) and place.get(reps[a], -1) in near[ours]
    found[own:], found[:, own:] = False, False
    root = np.full(n, -1)
    for a in range(n):  # ascending ids: the first of a group is its least
        if root[a] < 0:
            group = np.array([a])
            root[a] = a
            while len(group):
                group = np.flatnonzero(found[group].any(axis=0) & (root < 0))
                root[group] = a
    return pd.DataFrame({"rep": reps, "planted": planted, "label": pdf["label"], "dim": pdf["dim"], "links": links, "met": met, "root": reps[root]})


def _planted(distinct: DataFrame, sizes: DataFrame) -> DataFrame:
    """Vectors at known cosines from some of each label's, to be found again; their ``rep`` is that of their source."""

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rep, v in zip(pdf["rep"], unit(pdf["embedding"]) if len(pdf) else [], strict=True):
                rng = np.random.default_rng(int(rep) & (1 << 63) - 1)
                aside = rng.normal(size=len(v))
                aside -= (aside @ v) * v
                c = rng.uniform(*PLANTED)
                out.append((c * v + (1 - c * c) ** 0.5 * aside / np.linalg.norm(aside)).tolist())
            yield pdf.assign(embedding=out)

    rated = spread_join(distinct.filter("dim > 1"), sizes.select(*GROUP, "n"), GROUP, ["rep"])
    share = F.least(F.lit(float(AUDIT)), F.col("n") / AUDIT_SHARE) / F.col("n")
    drawn = F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(1 << 30)) < share * (1 << 30)
    some = rated.filter(drawn).select("rep", F.lit(True).alias("planted"), *GROUP, "embedding", F.lit(0).cast("long").alias("copies"))
    return some.mapInPandas(turn, some.schema)


def _shards(distinct: DataFrame, overlap: int, shard_rows: int) -> DataFrame:
    """The distinct vectors and the planted ones with the shards each goes to."""
    group = GROUP
    sizes = distinct.groupBy(*group).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("centres", F.least(F.ceil(F.col("n") / shard_rows), F.lit(CENTRES)))
    sizes = staged(sizes.withColumn("pieces", F.ceil(F.col("n") / PART)), "label-sizes")
    own = distinct.select("rep", F.lit(False).alias("planted"), *group, "embedding", "copies")
    planted = staged(_planted(distinct, sizes), "planted-vectors")
    rated = spread_join(own.unionByName(planted), sizes, group, ["rep"])
    drawn = ~F.col("planted") & (F.col("centres") > 1) & (F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(1 << 30)) * F.col("n") < F.col("centres") * F.lit(1 << 30))
    centres = rated.filter(drawn).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    parts = rated.withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces"))).drop("n", "centres", "pieces")
    centres = staged(centres.select(*group, "piece", "rep", "embedding"), "centres")
    schema = "rep long, planted boolean, label string, dim int, embedding array<double>, copies long, shards array<int>"
    near = parts.groupBy(*group, "piece").cogroup(centres.groupBy(*group, "piece")).applyInPandas(lambda a, b: _assign(a, b, overlap), schema)
    assigned = staged(near, "vector-shards")
    for used in (sizes, centres, planted):
        drop_staged(used)
    return assigned


def _links(distinct: DataFrame, cosine: float, overlap: int, shard_rows: int, chunk: int) -> DataFrame:
    """(rep, planted, label, dim, links, met, root): the counted links of each vector and the least of its group, per cell."""
    group = GROUP
    assigned = _shards(distinct, overlap, shard_rows)
    dealt = assigned.withColumn("shard", F.explode("shards"))
    counts = dealt.groupBy(*group, "shard").agg(F.count("*").alias("n")).select(*group, "shard", F.ceil(F.col("n") / chunk).alias("parts"))
    dealt = spread_join(dealt, counts, [*group, "shard"], ["rep"]).withColumn("own", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts")))
    others = F.when(F.col("parts") > 1, F.array_remove(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), F.col("own")))
    dealt = dealt.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0).cast("long")))))
    cells = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
    key, node = [*group, "shard", "i", "j"], ["rep", "planted", *group]
    graph = cells.groupBy(*key).applyInPandas(_build, "rep long, planted boolean, label string, dim int, near long, near_planted boolean")
    two = (F.collect_set(F.when(F.col("near_planted") == which, F.col("near"))).alias(name) for which, name in ((False, "near"), (True, "near_planted")))
    lists = staged(graph.groupBy(*node).agg(*two), "vector-graph")
    schema = "rep long, planted boolean, label string, dim int, links long, met boolean, root long"
    out = staged(cells.join(lists, node, "left").groupBy(*key).applyInPandas(lambda pdf: _search(pdf, cosine), schema), "vector-links")
    drop_staged(lists)
    drop_staged(assigned)
    return out


def audit(found: DataFrame) -> DataFrame:
    """(label, dim, planted, recall): the share of each label's planted vectors whose link with their source was counted."""
    each = found.filter("planted").groupBy("rep", *GROUP).agg(F.max("met").alias("met"))
    return each.groupBy(*GROUP).agg(F.count("*").alias("planted"), F.avg(F.col("met").cast("double")).alias("recall"))


def _of(df: DataFrame, labels: DataFrame) -> DataFrame:
    return spread_join(df, labels.select(*GROUP), GROUP, ["rep"])


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = COSINE, overlap: int = OVERLAP, shard_rows: int = SHARD_ROWS, chunk: int = CHUNK,
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors of equal label and length link at ``cosine`` or more. Equal vectors are one
    node that counts each of them. Every vector goes to the shards of its ``overlap``
    nearest centres (vectors drawn by a hash, one per ``shard_rows``, less those that are
    nearer than APART to another, so that a dense group stays together); graphs are built per
    shard, adjacency lists of a vector united, and searched in every shard it is in. A
    pair is counted in one place only, so links need no list of pairs. A shard larger
    than ``chunk`` is built and searched in pairs of chunks, which leaves out no pair.
    Links found are exact in double precision. The audit plants, in every label, vectors
    at known cosines from some of its own and looks how many are found again, so recall is
    known however few links a label has, and the check grows with the label only up to
    AUDIT vectors. A label below RECALL is built again with twice the overlap, until its
    vectors go to every centre.

    Vectors that are null, empty, zero or hold null or non-finite components, null labels
    and null ids link with nothing and are their own component. Repeated rows of an id
    count once and get the same result.
    """
    base = vectors.select(F.col(id_col).alias("rep"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    base = staged(base.withColumn("ok", usable(F.col("embedding"), F.col("label"), F.col("rep"))), "vectors")
    good = base.filter("ok").drop("ok")
    same = good.groupBy("label", "embedding").agg(F.min("rep").alias("rep"), F.count_distinct("rep").alias("copies"))
    distinct = staged(same.select("rep", "label", F.size("embedding").alias("dim"), "embedding", "copies"), "distinct-vectors")
    todo, parts = distinct, []
    while True:
        found = _links(todo, cosine, overlap, shard_rows, chunk)
        short = staged(audit(found).filter(F.col("recall") < RECALL), "audit")
        if overlap >= CENTRES or short.isEmpty():
            parts.append(found)
            break
        parts.append(spread_join(found, short.select(*GROUP, F.lit(True).alias("again")), GROUP, ["rep"], "left").filter("again IS NULL").drop("again"))
        todo, overlap = staged(_of(todo, short), "vectors-again"), overlap * 2
    found = reduce(DataFrame.unionByName, parts).filter("NOT planted")
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = distinct.join(totals, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = spread_join(good, named, ["label", "embedding"], ["rep"])
    alone = base.filter("NOT ok").select("rep", F.lit(0).cast("long").alias("n_links"), F.col("rep").alias("component_id"))
    return linked.select("rep", "n_links", "component_id").unionByName(alone).select(
        F.col("rep").alias(id_col), "n_links", "component_id", F.col("rep").eqNullSafe(F.col("component_id")).alias("kept")
    )
