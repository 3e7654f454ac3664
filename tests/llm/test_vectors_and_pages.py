"""Vector search against brute force, and extraction of main texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import html_extraction as H
from tessera.llm import queries
from tessera.llm import vector_search as V


def brute(ids, x, asked, k):
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in asked:
        s = (x @ x[i]) / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("hot", [0, 400])
def test_recall(spark, hot):
    rng = np.random.default_rng(hot)
    x = rng.standard_normal((60, 16))[rng.integers(0, 60, 1500)] + 0.5 * rng.standard_normal((1500, 16))
    if hot:
        x[:hot] = x[0] * rng.integers(1, 9, hot)[:, None]  # one direction many times
    ids = rng.permutation(1500) + 10
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = found(V.search(df, df.where("vec_id % 50 = 0"), plan=V.Plan(posting=64, block=100)))
    want = brute(ids, x, np.flatnonzero(ids % 50 == 0), 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = [len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 5 for q in want]
    near = [min(s for _, s in got[q]) >= min(s for _, s in want[q]) - 1e-9 for q in want]
    assert np.mean(near if hot else hits) >= 0.9  # of equal vectors brute force and search may name others


def test_recall_on_the_table(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    got = found(queries.op1_vectors(spark, str(data)))
    rows = [r for r in V.usable(table, "vec_id", "embedding").collect()]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.vector for r in rows])
    want = brute(ids, x, np.flatnonzero(ids % 50 == 0), 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_shares_of_queries(spark, data):
    """However the queries of a list are dealt out, the result is the same."""
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    whole, dealt = (found(V.search(table, table.where("vec_id % 10 = 0"), plan=V.Plan(block=100, asked=n))) for n in (16384, 7))
    assert whole == dealt


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (2, [2.0, 0.0]), (9, [1.0, 2.0, 3.0]), (10, []), (11, [1e300, 1e300]), (12, [1e-300, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, query_id string")
    got = found(V.search(df, k=5))
    assert set(got) == {1, 2, 3, 11, 12}
    assert [i for i, _ in got[1]][:2] == [2, 12] and all(len(v) == 4 for v in got.values())
    assert got[1][0][1] == pytest.approx(1.0)
    assert V.search(df.where("false")).count() == 0
    assert found(V.search(df.where("vec_id = 1"))) == {}


@pytest.mark.parametrize("step", [0.0, 0.001])
def test_ids_that_repeat(spark, step):
    """An id with k rows or more near the query, equal or not, takes one place; the others follow, in small tables and in larger ones."""
    rows = [(0, [1.0, 0.0])] + [(7, [1.0, 0.01 + i * step]) for i in range(6)] + [(i, [1.0, 0.1 * i]) for i in range(1, 6)]
    got = found(V.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5))
    assert [i for i, _ in got[0]] == [7, 1, 2, 3, 4] and set(got) == {0, 1, 2, 3, 4, 5, 7} and all(len(v) == 5 for v in got.values())
    rng = np.random.default_rng(3)
    x = rng.standard_normal((200, 8))
    rows = [(int(i), (v + step * rng.standard_normal(8)).tolist()) for i, v in enumerate(x) for _ in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(V.search(df, df.where("vec_id % 20 = 0"), plan=V.Plan(posting=16, block=64)))
    want = brute(np.arange(200), x, np.arange(0, 200, 20), 5)
    assert all(len(v) == 5 for v in got.values()) and np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_common_subsequence():
    rng = random.Random(1)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    for _ in range(500):
        a, b = (rng.sample(range(12), rng.randrange(0, 10)) for _ in range(2))
        assert len(H.shared_lines(a, b)) == length(a, b) == len(H.shared_lines(a, b, 0))
    assert H.shared_lines([1, 1, 2], [1, 2, 2]) == {1, 2}


def test_common_subsequence_is_the_same_at_every_size():
    rng = random.Random(2)
    assert H.shared_lines([1, 1, 2], [1, 2, 2], 0) == {1, 2}
    for _ in range(300):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(0, 60))] for _ in range(2))
        assert H.shared_lines(a, b, rng.choice([0, 99, 500])) == H.shared_lines(a, b)
    a = [x for i in range(7000) for x in (i, -1, -2)]  # past the limit, with lines that repeat
    b = [x for i in range(7000) for x in (i if i % 3 else -i - 9, -1, -2)]
    assert H.shared_lines(a, b) == {-1, -2, *(i for i in range(7000) if i % 3)}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>gone</p> --><div class="cookie-notice"><p>We use cookies</p></div>
<div class="ad">Buy</div><article class="post"><header><h1>Title &amp; more</h1></header><p><b>First\n  line.<br><p>Second &eacute;&#x20AC; line<ul><li>one<li>two</ul><aside>Pull</aside><table><tr><td>c1<td>c2</table>
<p>1 &lt; 2 and <a href="x>y">a link</a>.</p></article><section id="comments"><article class="comment"><p>Nice!</p></article></section><form><p>Name</p></form><footer>&copy; 2024</footer></body></html>"""


def test_blocks():
    assert [t for t, place in H.blocks(PAGE) if place == H.IN_MAIN] == ["Title & more", "First line.", "Second é€ line", "one", "two", "c1", "c2", "1 < 2 and a link."]
    assert not [t for t, place in H.blocks(PAGE) if place == H.UNKNOWN]
    assert [t for t, place in H.blocks("<p>a</p><nav>b</nav><p>c &am") if place == H.UNKNOWN] == ["a", "c &am"]
    assert H.blocks("<article><p>text</p><p cut") == [("text", H.IN_MAIN)]
    assert H.blocks("") == H.blocks(None) == []
    H.blocks("<" * 50_000)
    H.blocks("<p>" * 50_000)


def test_differencing(spark):
    """Pages without marks: what neighbours share is the template, what they don't is the text."""
    page = lambda i: f"<div>Welcome to the site</div><div>Story {i}</div><div>It happened on day {i}.</div><div>All rights kept</div>"
    rows = [(i, f"https://h.example.com/en/{i:03d}", page(i), 1) for i in range(40)] + [(100, "https://other.example.com/a", page(7), 1), (101, None, None, 1), (102, "u", "", None), (None, "https://h.example.com/en/zz", page(99), 1)]
    df = spark.createDataFrame(rows + [rows[3]], "page_id long, url string, html string, key int")
    got = {}
    for r in H.main_texts(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert all(got[i] == [f"Story {i}\nIt happened on day {i}."] * (2 if i == 3 else 1) for i in range(40))
    assert got[100] == ["Welcome to the site\nStory 7\nIt happened on day 7.\nAll rights kept"]  # no neighbour in its host
    assert got[101] == got[102] == [""] and got[None] == ["Story 99\nIt happened on day 99."]
    assert H.main_texts(df.where("false")).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_copies_of_pages(spark, parts):
    """Equal and nearly equal pages beside each other keep their text and lose the template that other pages of the host show."""
    body = lambda i: f"<div>Story {i} is a long one, and its text is told here at some length.</div><div>It happened on day {i}, as was said by those who were there at the time.</div>"
    page = lambda i, day=0: f"<div>Welcome to us</div>{body(i)}<div>Read {day}</div><div>All rights kept</div>"
    text = lambda i, day=0: "\n".join(body(i).replace("</div>", "\n").replace("<div>", "").split("\n")[:2]) + f"\nRead {day}"
    rows, want = [], {}
    for i in range(12):
        for k in range(1 + i * 7 % 5 * 3):  # runs of up to 13, equal or nearly
            rows.append((100 * i + k, f"https://h.example.com/{i:03d}?v={k:02d}", page(i, k * (i % 2) + 100 * i)))
            want[100 * i + k] = text(i, k * (i % 2) + 100 * i)
    rows += [(9000 + k, f"https://copies.example.com/{k}", page(99)) for k in range(7)]
    want |= {9000 + k: f"Welcome to us\n{text(99)}\nAll rights kept" for k in range(7)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.page_id: r.text for r in H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want


def texts_of(spark, pages):
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)]
    return [r.text for r in sorted(H.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())]


def test_articles_keep_what_is_in_them(spark):
    """Names that sound like menus, and mathematics, don't cost an article its text; adverts and comments inside it go."""
    inside = '<p>x</p><math><mi>y</mi></math><div class="share price"><p>Shares fell</p></div><div class="related-work"><p>Others did</p></div><div class="ad-box">Buy</div><ol id="comments-list"><li class="comment odd"><p>First!</p></ol>'
    assert texts_of(spark, [("http://a.example.com/1", f"<article>{inside}</article>")]) == ["x\ny\nShares fell\nOthers did"]
    doubtful = lambda i: f'<article><p>Story {i}</p><div class="share price">Tell your friends</div><div class="share price">{i} up</div></article>'
    assert texts_of(spark, [(f"http://a.example.com/{i}", doubtful(i)) for i in range(5)]) == [f"Story {i}\n{i} up" for i in range(5)]


def test_a_story_that_two_pages_share_is_no_template(spark):
    story = "<div>The same story, told at length on both of these pages.</div><div>And its end.</div>"
    more = lambda n: "".join(f"<div>Read on about {n} and {k}</div>" for k in range(9))
    got = texts_of(spark, [("http://a.example.com/1", story + more(1)), ("http://a.example.com/2", story + more(2))])
    assert all(t.startswith("The same story, told at length on both of these pages.\nAnd its end.\n") for t in got)
    # nor does a page lose all its text
    page = lambda *x: "".join(f"<div>{y}</div>" for y in x)
    got = texts_of(spark, [(f"http://a.example.com/{i}", page("a", "b", *([f"own {i} " * 9] if i else []))) for i in range(6)])
    assert got == ["a\nb", *((f"own {i} " * 9).strip() for i in range(1, 6))]


def test_differencing_finds_the_template_of_pages_with_markup(spark):
    """Of what is deleted, most is found by differencing where the template recurs; markup tells the rest."""
    page = lambda i: f"<nav><a>Home</a> <a>News</a></nav><header><p>The Daily</p></header><article><p>Story {i}</p><p>Hm.</p></article><div class=ad>Offer {i}</div><footer><p>All rights kept</p></footer>"
    df = spark.createDataFrame([(i, f"http://b.example.com/{i % 7}/{i}", page(i)) for i in range(60)], "page_id long, url string, html string")
    got = H.main_texts(df).collect()
    assert {r.text for r in got} == {f"Story {i}\nHm." for i in range(60)}
    assert {(r.n_shared, r.n_apart) for r in got} == {(3, 1)}


@pytest.mark.parametrize("parts", [1, 13])
def test_template_by_brute_force(spark, parts):
    """The template of each host equals that of a plain loop over its pages in order."""
    rng = random.Random(parts)
    rows = []
    for i in range(330):
        lines = [rng.choice(["top", "menu a", "menu b", f"own {i}", f"own {i} again", "foot", f"seen {rng.randrange(40)}"]) for _ in range(rng.randrange(1, 9))]
        rows.append((i, f"http://{'hot' if i % 3 else 'h%d' % (i % 5)}.example.com/{i:04d}", "".join(f"<div>{x}</div>" for x in lines)))
    hosts = {}
    for _, u, h in sorted(rows, key=lambda r: r[1]):
        hosts.setdefault(H._url_key(u)[0], []).append([x for x, _ in H.blocks(h)])
    want = set()
    for host, pages in hosts.items():
        held = [H._Page([H._hash(x) for x in p], [len(x) for x in p]) for p in pages]
        shares = {}
        for i, a in enumerate(held):
            for j in range(max(0, i - 8), i):
                if not a.copies(held[j]):
                    for x in H.shared_lines(held[j].lines, a.lines):
                        shares.setdefault(x, set()).update((i, j))
        want |= {(host, x) for x, s in shares.items() if len(s) >= 3}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    lines = df.mapInArrow(H._lines, "key long, host string, path string, lines array<long>, sizes array<int>")
    got = {(r.host, r.line) for r in H.template_lines(lines, block=32).collect()}
    # runs of copies count once, so a line that only they and one page share may be missing
    assert got <= want and len(want - got) <= 0.05 * len(want) and len(got) > 20


def test_pages_of_the_table(spark, data):
    """The generator's pages put the text in an article; everything in it and nothing else comes out."""
    import html
    import re

    pages = spark.read.parquet(f"{data}/pages.parquet")
    want = {}
    for r in pages.collect():
        raw = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)
        raw = re.sub(r"<[^>]*$", "", raw[1]) if raw else ""
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>|<br>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", raw))
        want[r.page_id] = "\n".join(x for x in parts if x)
    got = {r.page_id: r.text for r in H.main_texts(pages.withColumn("extra", F.lit(1))).collect()}
    assert got == want


def test_centroids_grow_with_the_root_of_the_rows():
    plan = V.Plan()
    assert V.sizes_of(1000, 64, plan) == V.sizes_of(16_000_000, 64, plan) == (1 << 15, 4096)
    assert V.sizes_of(10**9, 64, plan) == (8 * 31_622, 31_622)
    sample, most = V.sizes_of(10**12, 64, plan)
    assert sample * 64 * 8 <= plan.sample_bytes and most == sample // 8
    assert V.sizes_of(10**12, 4096, plan) == (1 << 15, 4096)
    small = V.Plan(sample=256, most_centroids=8, posting=4)
    x = np.random.default_rng(3).standard_normal((V.sizes_of(40_000, 8, small)[0], 8))
    at = V.fit(x / np.linalg.norm(x, axis=1, keepdims=True), 40_000, small)
    assert len(x) == 1600 and 100 <= len(at.centroids) <= 200
