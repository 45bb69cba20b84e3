"""Main text of pages: tree matching against a plain alignment, and texts that only the wrapper can tell."""

import random
import re

import pytest

from geoloom.llm import pages

BARE = re.compile(r"<(/?)(?:article|main|nav|footer|header|aside)\b|\s(?:class|id)=(?:'[^']*'|\"[^\"]*\"|\S+?(?=[\s>]))")


def plain_matching(a, b):
    """Size of the largest order-keeping mapping, by the textbook recursion."""
    if a.label != b.label:
        return 0
    x, y = a.below, b.below
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + plain_matching(x[i], y[j]))
    return 1 + m[-1][-1]


def tree(rng, depth=0):
    kids = "".join(tree(rng, depth + 1) for _ in range(rng.randint(0, 5 if depth < 3 else 0)))
    tag = rng.choice(["div", "span", "b"])
    return f"<{tag}>{kids}</{tag}>"


def test_matching_equals_a_plain_alignment():
    rng = random.Random(3)
    shapes = pages.Shapes()
    for _ in range(150):
        a, b = (pages.parse("<div>" + tree(rng) + tree(rng) + "</div>") for _ in range(2))
        shapes.add(a), shapes.add(b)
        want = plain_matching(a[0], b[0])
        assert shapes.score(a[0].shape, b[0].shape) == want
        pairs, todo = 0, [(a[0], b[0])]
        while todo:  # the mapping itself has that size and keeps the order
            x, y = todo.pop()
            pairs += 1
            found = shapes.aligned(x, y)
            for side, kids in ((0, x.below), (1, y.below)):
                places = [[id(k) for k in kids].index(id(p[side])) for p in found]
                assert places == sorted(set(places))
            todo += found
        assert pairs == want


def test_matching_of_deep_and_wide_trees():
    shapes = pages.Shapes()
    a, b = pages.parse("<div>" * 5000 + "x"), pages.parse("<div>" * 4990 + "<p>y<p>z")
    wide = pages.parse("<div>" + "<p>a" * 3000 + "<b>c</b>"), pages.parse("<div>" + "<p>a" * 2000 + "<b>c</b>")
    for x in (a, b, *wide):
        shapes.add(x)
    assert shapes.score(a[0].shape, b[0].shape) == 4991
    assert shapes.score(wide[0][0].shape, wide[1][0].shape) == 2003
    made = pages.induce(["<div>" * 1500 + f"text {k} " * 5 for k in range(4)])
    assert pages.extract("<div>" * 1500 + "other", [pages.Wrapper(w, shapes) for w in made], shapes) == "other"


def site(rng, n, parts):
    """A page whose menu, advert and footer change too; no name tells them from the article if BARE is taken out."""
    words = lambda k: " ".join(rng.choice(["lo", "ka", "mi", "re", "sun", "tor"]) + str(rng.randint(0, 99)) for _ in range(k))
    article = [words(rng.randint(1, 40)) for _ in range(parts)]
    html = (
        f"<html><body><nav><ul>{''.join(f'<li><a>{words(1)}</a></li>' for _ in range(4))}</ul></nav><div class='ad'>{words(6)}</div><article><h1>{words(3)}</h1>"
        + "".join(f"<p>{x}</p>" for x in article[: parts // 2]) + "<p>Read on at our shop</p>" + "".join(f"<p>{x}</p>" for x in article[parts // 2 :])
        + f"</article><footer>{words(12)}</footer></body></html>"
    )
    title = re.search("<h1>(.*?)</h1>", html)[1]
    return html, "\n".join([title, *article])


def test_wrapper_tells_what_no_name_tells(spark):
    rng = random.Random(5)
    made = [site(rng, n, 1 if n % 4 == 0 else rng.randint(2, 9)) for n in range(40)]
    bare = [(BARE.sub(lambda m: f"<{m[1]}div" if m[0][0] == "<" else "", h), t) for h, t in made]
    assert not any(x in h for h, _ in bare for x in ("article", "class", "nav", "footer"))
    df = spark.createDataFrame([(n, "http://h.example/x", h) for n, (h, _) in enumerate(bare)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert got == {n: t for n, (_, t) in enumerate(bare)}
    alone = [pages.extract(h, [], pages.Shapes()) for h, _ in bare]
    assert sum(a != t for a, (_, t) in zip(alone, bare)) == len(bare)  # the shop's line at least stays without a wrapper
    lone = [pages.extract(h.replace("<p>Read on at our shop</p>", ""), [], pages.Shapes()) for h, _ in bare]
    assert any(a != t for a, (_, t) in zip(lone, bare))  # and menus stay on short pages


def test_two_layouts_of_a_host(spark):
    rng = random.Random(6)
    first = [site(rng, n, 5) for n in range(12)]
    words = lambda k: " ".join(f"x{rng.randint(0, 999)}" for _ in range(k))
    other = [(f"<section><dl><dt>{words(2)}<dd>{words(2)}</dl></section><section><table><tr><td>{(a := words(30))}<td>{(b := words(20))}</table></section>", f"{a}\n{b}") for _ in range(12)]
    df = spark.createDataFrame([(n, "http://h.example/x", h) for n, (h, _) in enumerate(first + other)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df, pages_per_host=24).collect()}
    assert got == {n: t for n, (_, t) in enumerate(first + other)}


def test_copies_say_nothing_about_a_template(spark):
    rows = [(n, "http://h.example/x", f"<nav>{n}</nav><article><h1>Same</h1><p>{'the same long article ' * 5}</p></article>") for n in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in pages.main_text(df).collect()} == {"Same\n" + ("the same long article " * 5).strip()}


def test_odd_pages(spark):
    page = lambda n: f"<html><body><header>Site</header><div class='cookie-bar'>We</div><nav><a>m</a></nav><main><article><h1>T{n} &amp; x</h1><p>One {n}  two\n<p>More {n * 7}<ul><li>a{n}</ul><div>Read on at our shop</div><form>f</form></article></main><div id=comments>c{n} and a long remark by reader {n}</div><footer>z</footer>"
    rows = [(n, "http://h.example/x", page(n), "a", "b") for n in range(8)]
    rows += [(20, None, None, "", ""), (21, "http://o.example", "", "", ""), (22, "http://o.example", "plain  text", "", ""), (23, "bad url", "<div>a<div>b</div>c</div><p", "", "")]
    rows += [(24, "http://one.example", "<p>" + "long words " * 40_000, "", ""), (3, "http://h.example/x", page(3), "a", "b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, `a.b` string, wrappers string").withColumnRenamed("wrappers", "host").withColumnRenamed("a.b", "draw.x")
    out = pages.main_text(df)
    assert out.columns == [*df.columns, "text"]
    found = out.collect()
    got = {r.page_id: r.text for r in found}
    assert len(found) == len(rows) and sum(r.page_id == 3 for r in found) == 2
    assert {n: got[n] for n in range(8)} == {n: f"T{n} & x\nOne {n} two\nMore {n * 7}\na{n}" for n in range(8)}  # the shop's line is the template's
    assert (got[20], got[21], got[22], got[23]) == ("", "", "plain text", "a\nb\nc") and len(got[24]) == 11 * 40_000 - 1
    assert pages.main_text(df.where("false")).count() == 0


@pytest.mark.parametrize("pages_of", [1, 2, 5])
def test_hosts_of_few_pages(spark, pages_of):
    rng = random.Random(pages_of)
    made = [site(rng, n, 4) for n in range(pages_of)]
    df = spark.createDataFrame([(n, "http://h.example/x", h.replace("<p>Read on at our shop</p>", "")) for n, (h, _) in enumerate(made)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.main_text(df).collect()} == {n: t for n, (_, t) in enumerate(made)}
