"""Corpus operators against brute force, and the cases every operator must stand: nulls, blanks, ties, repeats, no rows."""

import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ecostar.llm import exact, graph, language, licenses, mixing, packing, simhash, tokenfiles, toxicity, urls, vectors
from ecostar.llm import queries as q
from ecostar.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, run string"
LONG = "long words go on " * 20_000
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 1, 7, "x"),
    (2, "ALPHA beta gamma delta epsilon zeta", "en", "a", 1, 7, "x"),
    (3, None, None, None, None, None, None),
    (4, "", "en", "b", 0, 7, "x"),
    (4, "", "en", "b", 0, 7, "x"),
    (5, LONG, None, None, 5, None, "x"),
    (6, " \t\n ", "en", "b", 0, 7, "x"),
    (7, "été 123 <|endoftext|> it's fine.\n\nReleased under the MIT License. End", "fr", "b", 0, 7, "x"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def tokenizer(name):
    return pytest.importorskip("public_tokenizers").path(name)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(q.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({q.ORACLE[name]})").fetchall()
    assert rows(df, *columns) == sorted(want, key=str)


# exact


def test_exact_groups(docs, none):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(docs, fan=2, run_rows=2).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (3, 4, 3, False), (4, 4, 3, True), (6, 6, 1, True)} <= got
    least = {r.doc_id: r.keep_id for r in exact.exact_groups(docs, keep="smallest").collect()}
    assert (least[2], least[4], least[5]) == (1, 3, 5)
    assert exact.exact_groups(none).count() == 0


# SimHash


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in (ROWS[0][1], LONG, "one two", "É A é\x1c b\x0bc d e", "", None, "a a a a a a a"):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
        counts = [sum(h >> b & 1 for h in hashes) for b in range(64)]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if counts[b] * 2 > len(hashes))


def closure(near):
    label = np.arange(len(near))
    while True:
        after = np.array([label[row].min() for row in near])
        if (after == label).all():
            return label
        label = after


@pytest.mark.parametrize(("centres", "flips"), [(300, 3), (1, 4), (4, 2), (40, 6)])
def test_index_links_whatever_is_near(centres, flips):
    rng = np.random.default_rng(centres)
    fp = rng.integers(0, 2**64, centres, dtype=np.uint64)[rng.integers(0, centres, 400)]
    for _ in range(flips):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    fp = np.unique(fp)
    want = closure(np.bitwise_count(fp[:, None] ^ fp[None]) <= 4)
    a, b = simhash.link_cells(np.zeros(len(fp), int), fp)
    place = {int(f): i for i, f in enumerate(fp)}
    near = np.eye(len(fp), dtype=bool)
    for x, y in zip(a, b, strict=True):
        near[place[int(x)], place[int(y)]] = near[place[int(y)], place[int(x)]] = True
    assert (closure(near) == want).all()


@pytest.mark.parametrize("chunk", [50_000, 7])
def test_near_links_lose_no_component(spark, chunk):
    rng = np.random.default_rng(5)
    fp = rng.integers(0, 2**64, 6, dtype=np.uint64)[rng.integers(0, 6, 150)]
    for _ in range(3):
        fp = fp ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    fp = np.unique(fp)
    frame = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    links = [tuple(r) for r in simhash.near_links(frame, chunk=chunk).collect()]
    place = {int(f): i for i, f in enumerate(fp.view(np.int64))}
    near = np.eye(len(fp), dtype=bool)
    for x, y in links:
        near[place[x], place[y]] = near[place[y], place[x]] = True
    assert (closure(near) == closure(np.bitwise_count(fp[:, None] ^ fp[None]) <= 4)).all()


def test_near_groups(docs, none):
    got = rows(simhash.near_groups(docs), "doc_id", "component_id")
    assert [c for _, c in got] == [1, 1, 3, 3, 3, 5, 3, 7]
    assert {r.fingerprint for r in simhash.near_groups(docs).filter("doc_id IN (3, 4, 6)").collect()} == {"0" * 16}
    assert simhash.near_groups(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}


# classifiers


def test_toxicity_on_held_out_rows(spark):
    """A third of the toxic rows of this table share no word with the others; clean rows must be left alone."""
    sf = "/root/testdata/sf0.1"
    got = q.op1_toxicity(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    shares = {r.toxic: r.share for r in got.groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()}
    assert shares[1] > 0.5 and shares[0] < 0.01


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 2), (7, 0), (7, 0)], "doc_id long, toxic int")
    for fit_on, known in ((docs, labels), (none, labels), (docs, labels.limit(0))):
        model = toxicity.train(fit_on, known, F.lit(True))
        scored = rows(toxicity.score(docs, model), "doc_id", "score", "predicted")
        assert len(scored) == 8 and all(0 <= s <= 1 and p == (s >= 0.5) for _, s, p in scored)
        by_id = {i: s for i, s, _ in scored}
        assert by_id[3] == by_id[4]
    assert toxicity.score(none, model).count() == 0


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = q.op6_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95


def test_language_edges(docs, none):
    model = language.train(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert got[3] == got[4] == got[6] == ("und", 0.0) and got[7][0] == "fr" and got[1][0] == "en"
    assert all(0 <= s <= 1 for _, s in got.values())
    nothing = language.train(none, F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(none, model).count() == 0


# licenses and urls


def test_licenses(docs, none, spark):
    assert rows(licenses.scan(docs), "doc_id", "license", "containment") == [(7, "MIT", 1.0)]
    assert licenses.scan(none).count() == 0
    assert licenses.scan(docs, {}).count() == 0
    notice = licenses.TEMPLATES["GPL-3.0"].replace("work", "thing")  # 8 shingles, 3 of them changed: below 0.8
    cut = licenses.TEMPLATES["BSD-3-Clause"].rsplit(" ", 1)[0]
    texts = spark.createDataFrame([(1, notice), (2, f"see: {cut} now"), (3, "mit license")], "doc_id long, text string")
    assert [(i, name) for i, name in rows(licenses.scan(texts), "doc_id", "license")] == [(2, "BSD-3-Clause")]


def test_url_rules(spark, none):
    pages = spark.createDataFrame(
        [
            (1, "HTTP://A.Example.ORG/es/1?q"), (2, "x://org/"), (3, "x://org"), (4, "x://forg/"), (5, None), (6, "no scheme"),
            (7, "x://b.com/fr/1#t"), (8, "x://com/de/"), (9, "x://example.org/en/17"), (9, "x://example.org/en/17"), (None, "x://e.net/a"),
        ], "page_id long, url string",
    )
    labels = spark.createDataFrame([(i, 0) for i in (4, None)], "doc_id long, quality int")
    got = urls.judge_urls(pages, labels)
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert got.count() == 11
    assert by_id[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert by_id[2][2:] == ("org/", "allow") and by_id[3][2] is None and by_id[4][2] is None
    assert by_id[5][:3] == ("", "", None) == by_id[6][:3]
    assert by_id[7][2:] == ("com/fr/", "allow") and by_id[8][2:] == ("com/de/", "block") and by_id[9][2] == "example.org/en/1"
    assert urls.judge_urls(pages.limit(0), labels).count() == 0


def test_url_tree_reads_all_segments(spark):
    paths = [(f"x://h.net/a/b/c/d{j}/e/{kind}/{n}", int(kind == "good")) for j in range(2) for n in range(40) for kind in ("good", "bad")]
    paths += [("x://h.net/a/b/c/d0/e/rare/1/2/3", 1), ("x://h.net", 1)]
    pages = spark.createDataFrame([(i, url) for i, (url, _) in enumerate(paths)], "page_id long, url string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(paths)], "doc_id long, quality int")
    got = {r.page_id: (r.verdict, r.template) for r in urls.judge_urls(pages, labels).collect()}
    assert {got[i][0] for i, (url, _) in enumerate(paths) if "/good/" in url} == {"allow"}
    assert {got[i][0] for i, (url, _) in enumerate(paths) if "/bad/" in url} == {"block"}
    assert got[160][1] == "/*/*/*/*/*/*/*/*/*" and got[161][1] == "" and len(got) == len(paths)


# embeddings


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 16))
    some = [(i, (base[i % 12] + rng.normal(size=16) * (0.3 if i % 3 else 0.05)).tolist(), i % 2) for i in range(300)]
    some += [(300, some[0][1], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0), (304, some[0][1], None), (305, [], 1), (306, [None] * 16, 1)]
    frame = spark.createDataFrame(some, "vec_id long, embedding array<double>, label int")
    fine = some[:301]
    v, label = vectors.unit([e for _, e, _ in fine]), np.array([x for *_, x in fine])
    near = (v @ v.T >= 0.93) & (label[:, None] == label[None])
    for sizes in ({}, {"shard_rows": 40}, {"shard_rows": 100, "chunk": 30}):
        got = {r.vec_id: r for r in vectors.near_vectors(frame, **sizes).collect()}
        links = sum(got[i].n_links for i in range(301))
        assert links >= 0.95 * (near.sum() - 301) and all(got[i].n_links <= near[i].sum() - 1 for i in range(301))
        assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(301, 307))
    assert [got[i].component_id for i in range(301)] == closure(near).tolist()
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def pairs_and_a_group(pairs, group, dim=64, cosine=0.935):
    """Isotropic unit vectors in pairs at ``cosine``, then one dense group."""
    rng = np.random.default_rng(21)
    a, b = vectors.unit(rng.normal(size=(pairs, dim))), rng.normal(size=(pairs, dim))
    b = vectors.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    dense = rng.normal(size=dim) + rng.normal(size=(group, dim)) * 0.02
    return np.vstack([a, cosine * a + (1 - cosine**2) ** 0.5 * b, vectors.unit(dense)])


def test_search_counts_links_whatever_the_type_of_shards():
    """Pairs that share some of their shards, which arrive as 32-bit numbers."""
    v = pairs_and_a_group(40, 1)[:80]
    rng = np.random.default_rng(4)
    shards = [np.array(sorted({1, *rng.choice(np.arange(2, 9), 2, replace=False)}), np.int32) for _ in v]
    graph = vectors.build_graph(v)
    cell = pd.DataFrame({
        "rep": range(80), "planted": False, "label": "a", "dim": 64, "embedding": list(v), "copies": 1, "shards": shards, "shard": 1, "own": 0,
        "parts": 1, "i": 0, "j": 0, "near": graph, "near_planted": None,
    })
    got = vectors._search(cell, 0.93)
    assert got.links.tolist() == [1] * 80 and got.root.tolist() == [*range(40)] * 2 and not got.met.any()


def test_audit_sees_what_was_lost(spark):
    rows = [(i, True, lab, 8, 0, lab == "y" or i % 4 == 0, i) for i in range(40) for lab in "xy"] + [(i, False, "x", 8, 1, False, i) for i in range(9)]
    found = spark.createDataFrame(rows, "rep long, planted boolean, label string, dim int, links long, met boolean, root long")
    assert {r.label: (r.planted, r.recall) for r in vectors.audit(found).collect()} == {"x": (40, 0.25), "y": (40, 1.0)}


@pytest.mark.parametrize("pairs", [0, 30, 700])
def test_links_of_several_densities_beyond_a_chunk(spark, pairs):
    """A label without, with few and with many isolated pairs, in more shards and chunks than one."""
    rng = np.random.default_rng(pairs)
    v = np.vstack([pairs_and_a_group(max(pairs, 1), 150)[0 if pairs else 2 :], vectors.unit(rng.normal(size=(1500, 64)))])
    data = [(i, e.tolist(), 0) for i, e in enumerate(v)]
    near = v @ v.T >= 0.93
    for sizes in ({"shard_rows": 60}, {"shard_rows": 400, "chunk": 300}):
        got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), **sizes).collect()}
        lone = slice(0, 2 * pairs)
        assert sum(got[i].n_links for i in range(2 * pairs)) >= 0.9 * (near[lone].sum() - 2 * pairs)
        assert sum(got[i].n_links for i in range(len(v))) >= 0.95 * (near.sum() - len(v))
        assert all(got[i].n_links <= near[i].sum() - 1 for i in range(len(v)))


def test_near_vectors_keep_isolated_pairs(spark):
    v = pairs_and_a_group(300, 200)
    frame = spark.createDataFrame([(i, e.tolist(), 0) for i, e in enumerate(v)], "vec_id long, embedding array<double>, label int")
    near = v @ v.T >= 0.93
    got = {r.vec_id: r for r in vectors.near_vectors(frame, overlap=1, shard_rows=4).collect()}
    assert sum(got[i].n_links for i in range(600)) >= 0.95 * (near[:600].sum() - 600)
    assert all(got[i].n_links <= near[i].sum() - 1 for i in range(len(v)))


def test_overlap_grows_with_the_centres():
    assert [vectors.reach(3, n) for n in (0, 1, 16, 32, 8192)] == [3, 3, 3, 4, 12]


def test_vector_shards_and_search():
    rng = np.random.default_rng(8)
    v = vectors.unit(np.vstack([rng.normal(size=(1, 24)) + rng.normal(size=(500, 24)) * 0.05, rng.normal(size=(700, 24))]))
    c = v[rng.permutation(len(v))[:900]]
    kept = vectors.apart(c)
    sims = c @ c[kept].T
    assert (sims.max(axis=1) >= vectors.APART).all() and ((sims[kept] >= vectors.APART).sum() == len(kept))
    shards = vectors.nearest_centres(v, c, 3)
    assert set(sum(shards, [])) <= set(kept.tolist()) and all(sorted(set(s)) == s and len(s) == 3 for s in shards)
    assert vectors.nearest_centres(v, c[:2], 3) == [[0]] * len(v)
    found = vectors.range_search(v, vectors.flat(vectors.build_graph(v)), np.arange(len(v)), np.array([0]), 0.93)
    truth = v @ v.T >= 0.93
    np.fill_diagonal(truth, False)
    assert (found <= truth).all() and found.sum() >= 0.99 * truth.sum()
    lonely = vectors.range_search(v[:3], vectors.flat([[], [], []]), np.arange(3), np.array([0]), 0.93)
    assert lonely.shape == (3, 3)


# packing, mixing, token files

TEXTS = ["\u0130stanbul \u0131I \u01c5 \u01c6ungla \u017ftra\u00dfe \ufb01ne \u0152UVRE \u1e00", "a\u0301b e\u0308", "\u00aa\u00ba word_x x2y", "a  b", " a", "a ", "x <|endoftext|> y", "it's we'll  they 're", "é\u0301 \u0301b", "\x1c a \x1c b", "ΣΣ Σa AΣ", "한국 12 345 !!! ...a", "a\t.b,\r\nc", "), x.\n\nY"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    encode = Encoder(tokenizer(name))
    rng = np.random.default_rng(0)
    odd = ["".join(rng.choice(["a", "B", " ", "  ", "\n", "'s", "1", ".", ",", "é", "\u0301", "\u3000", "<|endoftext|>", "\x85", "\0"], 30)) for _ in range(2000)]
    letters = [chr(c) for c in range(0x41, 0x260) if chr(c).isalpha()]
    odd += [" ".join("".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(40)) for _ in range(100)]
    for text in [*TEXTS, *odd, LONG, ""]:
        assert np.frombuffer(encode(text), "<u4").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing(docs, none, spark):
    path = tokenizer("byte_bpe_50k.json")
    encode = Encoder(path)
    for shard_docs in (4096, 2):
        packed = packing.pack(docs, path, capacity=64, shard_docs=shard_docs)
        got = packed.toPandas()
        for doc_id, text, *_ in ROWS:
            ids = encode(text) + b"\0\0\0\0"
            mine = got[got.doc_id == doc_id].drop_duplicates("piece").sort_values("piece")
            assert b"".join(mine.ids) == ids
            assert mine.ids_crc32.tolist() == [zlib.crc32(x) for x in mine.ids]
            assert mine.start.tolist() == [a for a, _ in packing.cut(len(ids) // 4, 64)]
        for _, one in got.groupby("sequence_id"):
            one = one.sort_values("offset")
            assert one.offset.tolist() == np.append(0, one.length.cumsum())[:-1].tolist() and one.length.sum() <= 64
    whole = packing.sequences(packed).toPandas()
    assert (whole.ids.map(len) == 4 * whole.n_tokens).all() and whole.n_tokens.sum() == got.length.sum()
    assert packing.pack(none, path).count() == 0


def plain_packing(lengths, capacity):
    """Sum of squares by trying every open bin in turn, longest first."""
    bins, made, out = {}, 0, [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]

        def squares(changed, left):
            gaps = [g for b, g in bins.items() if b != changed] + [left]
            return sum(gaps.count(g) ** 2 for g in set(gaps) if g)

        fits = [b for b, g in bins.items() if g >= n] if n < capacity else []
        if fits:
            best = min(fits, key=lambda b: (squares(b, bins[b] - n), bins[b]))
            same = [b for b in fits if bins[b] == bins[best]]
            out[i] = (bins[best], len(same))
            gap = bins[best]
        else:
            best, gap, made = made, capacity, made + 1
            out[i] = (capacity, 0)
        bins[best] = gap - n
    return out, made


def test_packing_equals_a_plain_sum_of_squares():
    """The gap that each piece is put into, and the number of bins."""
    for seed in range(6):
        lengths = np.random.default_rng(seed).integers(1, 33, 60)
        to, offset = packing.place(lengths, 32)
        want, made = plain_packing(lengths.tolist(), 32)
        assert (32 - offset).tolist() == [gap for gap, _ in want] and to.max() + 1 == made


def test_packing_wastes_little():
    lengths = np.random.default_rng(1).integers(1, 2049, 5000)
    to, _ = packing.place(lengths)
    assert np.bincount(to, lengths).max() <= 2048 and to.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1


def test_mixing(spark, none):
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 60, 900)
    source = [None if i % 9 == 8 else "abcz"[min(i % 9, 3)] for i in range(900)]
    frame = spark.createDataFrame([(i, "w " * int(n) if n else None, s) for i, (n, s) in enumerate(zip(sizes, source, strict=True))], "doc_id long, text string, source string")
    got = mixing.mix(frame, block=32).toPandas().sort_values("doc_id")
    assert got["size"].tolist() == sizes.tolist() and (got.taken <= 3 * got["size"]).all()
    total = {s: sum(n for n, x in zip(sizes, source, strict=True) if x == s) for s in ("a", "b", "c", "z", None)}
    weight, target, open_ = dict(zip(total, (1, 2, 3, 1, 2), strict=True)), {}, set(total)
    while True:
        left = sum(total.values()) - sum(target[s] for s in target)
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * total[s]
            open_.remove(s)
    target |= {s: weight[s] * level for s in open_}
    for s in total:
        mine = got[[x == s for x in source]]
        assert mine.target.iloc[0] == pytest.approx(target[s]) and abs(mine.taken.sum() - target[s]) <= max(60, 0.01 * target[s])
    again = mixing.mix(frame.repartition(3), block=32).toPandas().sort_values("doc_id")
    assert again.taken.tolist() == got.taken.tolist()
    assert mixing.mix(none).count() == 0


def test_token_files(docs, none, spark):
    path = tokenizer("word_bpe_49k.json")
    manifest, folder = tokenfiles.write_files(docs, path, length=16)
    got = sorted(map(tuple, tokenfiles.read_files(spark, manifest, folder).collect()))
    encode, at = Encoder(path), 0
    for (doc_id, start, n, crc), (want, text, *_) in zip(got, ROWS, strict=True):
        ids = encode(text) + np.array([2], "<u4").tobytes()
        assert (doc_id, start, n, crc) == (want, at, len(ids) // 4, zlib.crc32(ids))
        at += n
    for one in manifest.collect():
        shard, last = tokenfiles.Shard(folder, one["file"]), -(-one["tokens"] // 16) - 1
        for i in {0, last}:
            ids, mask = shard.sequence(i)
            used = min(16, one["tokens"] - 16 * i)
            assert mask.tolist() == [True] * used + [False] * (16 - used) and len(ids) == 16 and not ids[used:].any()
            assert not ids.flags.owndata and np.shares_memory(mask, shard.mask)
    manifest, folder = tokenfiles.write_files(none, path)
    assert tokenfiles.read_files(spark, manifest, folder).count() == 0


# pipeline


def test_pipeline_stages(spark, docs):
    keys = {(r.doc_id, r.text) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and {(r.doc_id, r.text) for r in out.collect()} <= keys
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert rows(corpus_pipeline.drop_copies(spark, docs, SF), "doc_id") == [(2,), (4,), (5,), (6,), (7,)]
    assert rows(corpus_pipeline.drop_near_copies(spark, docs, SF), "doc_id") == [(1,), (3,), (5,), (7,)]


def test_pipeline_tells_rows_of_one_id_apart(spark):
    """Null and repeated ids: a near copy goes although its id stays elsewhere, copies don't multiply."""
    text, other = "one two three four five six seven eight", "other words that stand for themselves in here now"
    made = [(1, text), (5, text.replace("eight", "eight ")), (5, other), (None, text + " "), (None, "a b c d e f g h i")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1, "x") for i, t in made], DOCS)
    assert rows(corpus_pipeline.drop_near_copies(spark, docs, SF), "doc_id", "text") == sorted([(1, text), (5, other), (None, "a b c d e f g h i")], key=str)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.count() <= 3 * len(made)


def test_pipeline_edges(spark, docs):
    """Toxicity and packing stand the same rows as the other stages, and none."""
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS)
    assert corpus_pipeline.drop_toxic(spark, docs.limit(0), SF).count() == 0
    packed = corpus_pipeline.pack_sequences(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r[0] for r in ROWS}
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), SF).count() == 0


def test_pipeline_run(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF)
    ids = got.select("doc_id").distinct()
    assert ids.join(documents, "doc_id", "left_anti").count() == 0
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    rejected = q.op1_toxicity(spark, SF).filter("predicted = 1").select("doc_id")
    copies = exact.exact_groups(documents.join(rejected, "doc_id", "left_anti")).filter("NOT kept").select("doc_id")
    assert ids.join(rejected, "doc_id").count() == ids.join(copies, "doc_id").count() == 0
    assert rejected.count() <= 0.1 * documents.count()


def test_workers_let_go_of_remembered_pieces():
    """A worker that goes on with a task of another kind holds no pieces of the packing before, and encodes as before."""
    encode = Encoder.of(tokenizer("byte_bpe_50k.json"))
    text = "some words here, and others there"
    want = encode(text)
    assert encode.known and encode.kept
    for task in (
        lambda: list(simhash._fingerprints(iter([pd.DataFrame({"id": [1], "text": [text], "text_key": [1]})]))),
        lambda: list(toxicity._features(iter([pd.DataFrame({"y": [1], "fit": [0], "text": [text]})]))),
        lambda: mixing._fly(pd.DataFrame({"rank": [1, 2], "id": [1, 2], "size": [3, 4], "p": [0.5, 0.5]}), 0, 2),
    ):
        assert encode(text) == want and encode.kept
        task()
        assert not encode.known and not encode.other and not encode.kept
    assert encode(text) == want
