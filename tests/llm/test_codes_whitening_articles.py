"""Vector codes, whitening and article text against brute force, and the cases they must stand."""

import hashlib
import html

import numpy as np
import pytest
from pyspark.sql import functions as F

from ecostar.llm import codes, dom, whitening, wrapper
from ecostar.llm import queries as q

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>, label int, id long, v string, dim int, code string, n long, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, lab, 1, "x", 3, "y", 4, "z") for i, e, lab in rows], VECTORS)


# vector codes


def coded(rows, entries=64, rounds=2):
    """Plain k-means of each part in Python integers; rows (id, vector, label) of one length."""
    x = {j: [int(np.floor(256 * c)) for c in e] for j, (_, e, _) in enumerate(rows)}
    width = len(rows[0][1]) // 16
    cut = lambda j, p: x[j][p * width : (p + 1) * width]
    first = []
    for j in sorted(x, key=lambda j: (rows[j][0] is None, rows[j][0])):
        if rows[j][0] not in [rows[k][0] for k in first]:
            first.append(j)
    books = [[cut(j, p) for j in first[:entries]] for p in range(16)]
    far = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b, strict=True))
    for r in range(rounds + 1):
        to = {j: [min(range(len(b)), key=lambda e: (far(cut(j, p), b[e]), e)) for p, b in enumerate(books)] for j in x}
        if r < rounds:
            for p, book in enumerate(books):
                for e in range(len(book)):
                    own = [cut(j, p) for j in x if to[j][p] == e]
                    if own:
                        book[e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return {j: ("".join(f"{e:02x}" for e in to[j]), sum(far(cut(j, p), books[p][to[j][p]]) for p in range(16))) for j in x}, sha


def test_codes_equal_plain_k_means(spark):
    rng = np.random.default_rng(4)
    fine = [(int(i), rng.normal(size=32).round(3).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(150)]
    fine += [fine[0], fine[0], (None, [0.5] * 32, 1)]  # repeated rows, a null id
    broken = [(900, None, 1), (901, [NAN] + [0.0] * 31, 1), (902, [None] * 32, 1), (903, [INF] + [0.0] * 31, None)]
    want, sha = coded(fine)
    got = codes.encode(frame(spark, fine + broken).repartition(5)).collect()
    assert sorted((str(r.vec_id), r.code, r.error) for r in got) == sorted((str(fine[j][0]), *want[j]) for j in want)
    assert {r.codebooks_sha256 for r in got} == {sha}
    totals = {}
    for j in want:
        totals[fine[j][2]] = totals.get(fine[j][2], 0) + want[j][1]
    label = {str(i): lab for i, _, lab in fine}
    assert all(r.label_error == totals[label[str(r.vec_id)]] for r in got)


def test_codes_edges(spark):
    assert codes.encode(frame(spark, [(1, [1.0] * 16, 1)]).limit(0)).count() == 0
    assert codes.encode(frame(spark, [(1, None, 1)])).count() == 0
    few = [(1, [0.0] * 16, 1), (2, [1.0] * 16, 1), (3, [0.25] * 16, 2), (4, [], 1), (5, [0.5] * 5, 1), (6, [1e300] * 16, 3), (7, [-1e300] * 16, 3)]
    got = {r.vec_id: r for r in codes.encode(frame(spark, few), entries=4).collect()}
    assert len(got) == 7 and all(r.error >= 0 for r in got.values()) and got[1].code != got[2].code
    assert (got[4].code, got[4].error) == ("00" * 16, 0) and got[5].error == 0
    assert got[4].codebooks_sha256 != got[1].codebooks_sha256


def test_nearest_takes_the_first_of_equal_entries():
    entry, far = codes.nearest(np.array([[5, 5], [0, 9]]), np.array([[4, 5], [6, 5], [0, 9]]))
    assert entry.tolist() == [0, 2] and far.tolist() == [1, 0]


# whitening


def test_components_of_any_spectrum():
    rng = np.random.default_rng(0)
    for values in (np.arange(1, 41.0), np.repeat([3.0, 2.0, 1.0], 10), np.append(1e7, np.linspace(1, 1.1, 30)), np.zeros(6), np.ones(5), np.ones(1), [2.0, 1.0], [0.0] * 20 + [1.0] * 3):
        d = len(values)
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        cov = turn @ np.diag(values) @ turn.T
        e, v = whitening.top_components(cov)
        assert np.allclose(e, np.sort(values)[::-1][:8], rtol=1e-12, atol=1e-12 * max(values))
        assert np.allclose(v.T @ v, np.eye(min(8, d)), atol=1e-13) and np.allclose(cov @ v, v * e, atol=1e-13 * max(np.max(values), 1))


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    values = np.append(rng.normal(size=28), [1e-9, -1e-9])
    assert np.allclose(whitening.polar(turn @ np.diag(values) @ turn.T), turn @ np.diag(np.sign(values)) @ turn.T, atol=1e-5)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(2)
    e = (rng.normal(size=(400, 12)) * np.linspace(1, 3, 12)).round(4)
    rows = [(i, x.tolist(), None) for i, x in enumerate(e)] + [(None, e[0].tolist(), 1), (5, e[5].tolist(), 1), (900, None, 1), (901, [NAN] * 12, 1), (902, [None] * 12, 1)]
    got = whitening.whiten(frame(spark, rows).repartition(3)).toPandas()
    used = [x for _, x, _ in rows[:402]]
    x = (np.floor(np.array(used) * 1024) + 100000).astype(np.int64)
    y = x - x.mean(axis=0)
    cov = y.T @ y / len(x)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    want = y @ vectors / np.sqrt(values)
    assert len(got) == 402 * 8 and (got.n == 402).all() and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    table = got[got.vec_id.notna() & (got.vec_id != 5)].pivot(index="vec_id", columns="component", values="whitened").sort_index()
    mine = np.array([w for (i, *_), w in zip(rows, want, strict=False) if i not in (None, 5)])
    sign = np.sign(table.to_numpy()[0] * mine[0])
    assert np.allclose(table.to_numpy(), mine * sign, atol=1e-9)
    one = got[got.component == 1].dropna(subset=["vec_id"]).drop_duplicates("vec_id").set_index("vec_id").deviation
    exact = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert all(one[i] == exact[i] for i in range(400))
    share = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(share, values / np.trace(cov), rtol=1e-10)


def test_whitening_edges(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0], 1)]).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 1)])).count() == 0
    same = whitening.whiten(frame(spark, [(i, [0.5, 0.25], 1) for i in range(4)] + [(9, [], 1)])).toPandas()
    assert len(same) == 8 and (same[["whitened", "explained", "deviation", "identity_error"]] == 0).all().all()
    mixed = whitening.whiten(frame(spark, [(1, [0.0, 1.0], 1), (2, [1.0, 0.0], 1), (3, [1.0], 1), (4, [3.0], 1), (5, [1e300, 0.0], 1)])).toPandas()
    assert set(mixed[mixed.vec_id.isin([3, 4])].whitened.round(9)) == {-1.0, 1.0} and len(mixed) == 8


def test_deviations_are_exact_or_null():
    x = np.array([[100000, 100001], [2**41, 5]])
    sums = [100000 * 3, 100000 * 3]
    assert whitening.deviations(x[:1], 3, sums) == [9]
    assert whitening.deviations(x, 3, sums) == [9, None]
    near = np.array([[100000 + 2**30, 100000]])
    assert whitening.deviations(near, 2, [200000, 200000]) == [2**62]


# articles


def shell(body, head="", nav="", foot=""):
    return f"<!doctype html><html><head><title>t</title>{head}</head><body><nav>{nav}</nav>{body}<footer>{foot}</footer></body></html>"


def texts(source):
    return [t for _, t in dom.Page(source).kept]


def test_page_regions():
    page = shell("<div class='ad'>Buy</div><article><header><h1>T &amp; U</h1></header><p>a  b\n c<p><b>d <br>e<ul><li>x<li>y</ul><form>f</form><section id='comments'><article class=comment>no</article></section></article>", nav="<a href=/>Home</a>", foot="(c)")
    assert texts(page) == ["T & U", "a b c", "d e", "x", "y"]
    assert texts("<div id=cookie-notice>We</div><div class=post-content><p>One</p>two<script>if (a < '</p>') x</script> three</div><div class=sidebar>S</div>") == ["One", "two three"]
    assert texts("<main><h1>T</h1><p>p</p><aside>no</aside></main>") == ["T", "p"]
    assert texts("<form id=aspnet><div role=navigation>n</div><article>a</article></form>") == ["a"]
    assert texts("<ul><li><a href=1>Home</a></li><li><a href=2>More</a></li></ul><p>text with <a href=3>link</a></p>") == ["text with link"]
    assert texts("<p hidden>h</p><p style='display: none'>i</p><p aria-hidden=true>j</p><p>k<span class=ad>l</span></p>") == ["k"]
    assert texts("<!-- <p>no</p> --><p>a<!-- x -->b</p><style>p{}</style><textarea>t</textarea>") == ["ab"]


def test_broken_markup():
    assert texts(None) == texts("") == texts("   ") == [] and texts("<") == ["<"]
    assert texts("a < b &lt; c") == ["a < b < c"]
    assert texts("<p>a</div></b>b</p></p>c") == ["ab", "c"]
    assert texts("<p>a<script>var x = '<p>no'") == ["a"]
    assert texts("<p class=\"x>a</p><p>b") in (["b"], ["a", "b"], [])
    assert texts("<![CDATA[x & y]]>&nbsp;&#233;&bogus;") == ["x & y é&bogus;"]
    assert texts("<article><p>cut off") == ["cut off"]
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert texts(deep) == ["x"] and len(dom.Page(deep).tree()[0].labels) <= dom.DEPTH + 1
    long = "<article>" + "<p>word &amp; word</p>" * 60_000 + "</article>"
    assert texts(long) == ["word & word"] * 60_000 and len(dom.Page(long).tree()[0].labels) == 3


def literal_matching(a, b, x=0, y=0):
    """Size of the best alignment by trying all of them."""
    if a.labels[x] != b.labels[y]:
        return 0
    rows, columns = a.children()[x], b.children()[y]

    def rest(i, j):
        if i == len(rows) or j == len(columns):
            return 0
        return max(rest(i + 1, j), rest(i, j + 1), literal_matching(a, b, rows[i], columns[j]) + rest(i + 1, j + 1))

    return 1 + rest(0, 0)


def test_tree_matching_is_largest_and_in_order():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = (dom.Tree(["r", *rng.choice(list("abc"), 7)], [-1, *(int(rng.integers(0, i)) for i in range(1, 8))]) for _ in range(2))
        found = dom.simple_tree_matching(a, b)
        assert len(found) == literal_matching(a, b) and all(a.labels[x] == b.labels[y] for x, y in found.items())
        assert all(x == 0 or found[a.parents[x]] == b.parents[y] for x, y in found.items())


PAGES = "page_id long, url string, html string, host string, text string, wrapper string, id long"


def test_template_texts_go_and_varying_ones_stay(spark, monkeypatch):
    def page(i):
        return f"<div><p>All rights of the house</p></div><div><h2>News {i}</h2><p>Story number {i} of many</p><p>Write to us</p></div>"

    rows = [(i, f"http://a.org/{i}", page(i), "x", "y", "z", 7) for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", "<p>Same copy</p>", "x", "y", "z", 7) for i in range(6)]
    rows += [(200 + i, f"http://c.org/{i}", page(i), "x", "y", "z", 7) for i in range(2)]  # too few pages to tell
    rows += [(300, None, page(1), None, None, None, None), (None, "http://a.org/1", None, None, None, None, None), (1, "http://a.org/1", page(1), "x", "y", "z", 7)]
    got = wrapper.articles(spark.createDataFrame(rows, PAGES))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    by_id = {r.page_id: r for r in got.collect()}
    assert all(by_id[i].text == f"News {i}\n\nStory number {i} of many" for i in range(12))
    assert all(by_id[100 + i].text == "Same copy" for i in range(6))
    assert by_id[200].text.startswith("All rights") and by_id[300].text.startswith("All rights")
    assert (by_id[None].text, by_id[None].n_chars) == ("", 0)
    assert wrapper.articles(spark.createDataFrame([], PAGES)).count() == 0
    monkeypatch.setattr(wrapper, "SENT_BYTES", -1)  # wrappers by a join
    assert sorted(map(str, wrapper.articles(spark.createDataFrame(rows, PAGES)).collect())) == sorted(map(str, got.collect()))


def test_articles_of_the_table(spark):
    """The pages' articles, cut out by their one known mark-up."""
    got = {r.page_id: r for r in q.op13_articles(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = page.html.split("<article>")[1].split("</article>")[0]
        for tag in ("<p>", "</p>", "<h1>", "</h1>", "<b>", "</b>", "<br>"):
            inner = inner.replace(tag, "\0" if tag not in ("<b>", "</b>") else "")
        want = "\n\n".join(b for b in (" ".join(html.unescape(x).split()) for x in inner.split("\0")) if b)
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)


@pytest.mark.parametrize("name", ["op12_whitening"])
def test_query_over_the_table(spark, name):
    got = q.QUERIES[name](spark, SF)
    assert got.count() == 8 * spark.read.parquet(f"{SF}/embeddings.parquet").filter(F.col("embedding").isNotNull()).count()
