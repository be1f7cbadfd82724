"""Pages as literals with the text that a reader would call the article."""

from __future__ import annotations

import random

import pytest

from corpusloom.llm import extract

PAGES = "page_id long, url string, html string"


def text_of(page: str) -> str:
    return extract.content(extract.parse(page), set())


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>one<p>two</p>three", "one two three"),
        ("<article><h1>T</h1><p><b>a<br><p>b  \n c</p></article><footer>f</footer>", "T a b c"),
        ("<nav><ul><li>x</ul></nav><main><p>y</p><aside>z</aside></main>", "y"),
        ("<body><header>h</header><div class='content'>c</div><div class='sidebar left'>s</div></body>", "c"),
        ("<div id=comments><p>first!</p></div><p>text</p><form><input value=q>go</form>", "text"),
        ("<p>a &amp; b &lt;c&gt; &#233;&nbsp;d</p>", "a & b <c> é d"),
        ("<script>var t='</p>';</script><style>p{}</style><p>x</p><!-- y --><!-- open", "x"),
        ("<p>in<b>line</b>d<i> words</i></p><div>block</div>", "inlined words block"),
        ("<p>1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<div class='cookie-notice'>ok?</div><div role='navigation'>m</div><p hidden>h</p><p>v</p>", "v"),
        ("<article>a</article><article>b</article><p>c</p>", "a b"),
        ("<div class='ad'>buy</div><p class='lead'>read on</p>", "read on"),
        ("<a href=\"x>y\">link</a> end", "link end"),
        ("</div></p>stray<br/>x", "stray x"),
    ],
)
def test_main_text(page, want):
    assert text_of(page) == want


def test_matching_keeps_order_and_ancestors():
    a = extract.parse("<div><p>1</p><ul><li>x</li></ul><p>2</p></div>")
    b = extract.parse("<div><h1>t</h1><p>1</p><p>0</p><ul><li>y</li><li>z</li></ul></div>")
    pairs = [(x.tag, y.tag, extract.own_text(x), extract.own_text(y)) for x, y in extract.match(a, b)]
    assert ("ul", "ul", "", "") in pairs and ("li", "li", "x", "y") in pairs and all(p[0] == p[1] for p in pairs)
    na, nb = extract.numbered(a), extract.numbered(b)
    numbers = sorted((na[id(x)], nb[id(y)]) for x, y in extract.match(a, b))
    assert [y for _, y in numbers] == sorted(y for _, y in numbers)


def shop(k: int) -> str:
    return f"<body><div><p>Welcome to our shop</p><div><h2>Item {k}</h2><p>Story {k} is told here</p></div><p>Call us any time</p></div></body>"


def test_constant_nodes_become_template(spark):
    rows = [(k, f"http://Shop.example/{k}", shop(k)) for k in range(8)]
    # Too few pages to learn from; copies of one page; a page with more than the reference has.
    rows += [(100 + k, f"https://user@few.example:80/{k}", shop(k)) for k in range(3)]
    rows += [(200 + k, "http://copies.example/", shop(1)) for k in range(9)]
    rows += [(300, "http://shop.example/new", shop(300).replace("</h2>", "</h2><p>More of it</p>"))]
    rows += [(400, None, shop(4)), (401, "nonsense", None), (402, "http://shop.example/e", ""), (403, None, None), rows[0]]
    out = {r.page_id: r for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[3].text == "Item 3 Story 3 is told here" and out[300].text == "Item 300 More of it Story 300 is told here"
    assert out[101].text == "Welcome to our shop Item 1 Story 1 is told here Call us any time" == out[205].text
    assert out[401].text == out[402].text == out[403].text == "" and out[401].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert extract.main_text(spark.createDataFrame(rows, PAGES)).count() == len(rows)


def test_large_references_go_by_join(spark, monkeypatch):
    rows = [(k, f"http://shop{k % 2}.example/{k}", shop(k)) for k in range(20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES + ", host string, n_pages int")
    a = sorted(map(str, extract.main_text(df).collect()))
    monkeypatch.setattr(extract, "BROADCAST_BYTES", -1)
    assert sorted(map(str, extract.main_text(df).collect())) == a and "Welcome" not in "".join(a)


@pytest.mark.parametrize("name", ["no-sidebar", "layout with-sidebar", "has-menu", "search-results"])
def test_marked_wrappers_hide_nothing(spark, name):
    assert text_of(f"<body><div class='{name}'><article>the story</article><div class='sidebar'>s</div></div></body>") == "the story"
    assert text_of(f"<body><h1>T</h1><div class='{name}'><p>a story that is long</p><nav>n</nav></div></body>") == "T a story that is long"
    page = "<body><div class='{0}'><p>Our menu</p><div><p>Story {1} is told at length</p></div><div class='ad'>ad {1}</div></div></body>"
    rows = [(k, f"http://a.example/{k}", page.format(name, k)) for k in range(9)]
    out = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[4] == "Story 4 is told at length"


def test_slots_outside_of_the_article_are_content(spark):
    page = "<body><p>Our menu</p><article>Teaser {0}</article><div><p>The body of page {0} is told here at some length</p></div><p>Call us</p></body>"
    rows = [(k, f"http://a.example/{k}", page.format(k)) for k in range(9)]
    rows += [(100, "http://few.example/", "<article>Teaser</article><div>The body of a page is told here at some length</div>")]
    out = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[4] == "Teaser 4 The body of page 4 is told here at some length"
    assert "The body of a page" in out[100]


def test_hosts_with_two_kinds_of_pages(spark):
    forum = "<body><section><table><tr><td>Board rules apply</td></tr><tr><td>Thread {0} goes on and on</td></tr></table></section></body>"
    rows = [(k, f"http://a.example/{k}", shop(k) if k % 5 < 3 else forum.format(k)) for k in range(40)]
    rows += [(100 + k, f"http://a.example/x{k}", f"<p>Please log in {k}") for k in range(2)]
    out = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[1] == "Item 1 Story 1 is told here" and out[4] == "Thread 4 goes on and on"
    assert len(out) == 42 and out[100] == "Please log in 0"


def test_long_lists_are_aligned():
    kinds = [f"<li class='{'ab'[k % 2]}'>{'<b>x</b>' * (k % 7)}{'<i>y</i>' * (k % 3)}</li>" for k in range(400)]
    a, b = (extract.parse(f"<ul>{''.join(x)}</ul>").children()[0] for x in (kinds, ["<li class='c'>new</li>", "<li class='a'>new</li>", *kinds, "<li class='c'>new</li>"]))
    pairs = [(x, y) for x, y in extract.match(a, b) if x.tag == "li"]
    left, right = ({id(n): k for k, n in enumerate(r.children())} for r in (a, b))
    # Nearly all items meet their copies two places later.
    assert len(pairs) == 400 and sum(right[id(y)] - left[id(x)] == 2 for x, y in pairs) > 390


def test_copies_of_an_article_stay(spark):
    same = "<nav>{0}</nav><article><h1>One story</h1><p>The same everywhere</p></article>"
    rows = [(k, "http://mirror.example/", same.format(k)) for k in range(10)]
    assert {r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()} == {"One story The same everywhere"}


def test_empty_table_and_long_pages(spark):
    assert extract.main_text(spark.createDataFrame([], PAGES)).count() == 0
    deep = "<div>" * 5000 + "x" + "<p>y" * 20_000
    (r,) = extract.main_text(spark.createDataFrame([(1, "http://a.b/", deep)], PAGES)).collect()
    assert r.text == "x" + " y" * 20_000


def random_tree(rng: random.Random, size: int) -> str:
    """Markup of nested b and i elements, which do not end each other."""
    if size <= 0:
        return ""
    inner = rng.randint(0, size - 1)
    tag = rng.choice("bi")
    return f"<{tag}>{random_tree(rng, inner)}</{tag}>{random_tree(rng, size - 1 - inner)}"


def largest(a, b) -> int:
    """The size of a largest matching of two subtrees, by the plain recursion over heads of the lists of children."""
    if a.label != b.label:
        return 0
    left, right = a.children(), b.children()

    def best(i, j):
        if i == len(left) or j == len(right):
            return 0
        return max(best(i + 1, j), best(i, j + 1), largest(left[i], right[j]) + best(i + 1, j + 1))

    return 1 + best(0, 0)


@pytest.mark.parametrize("seed", range(60))
@pytest.mark.parametrize("cells", [1, 40_000])
def test_matching_has_the_greatest_size(seed, cells, monkeypatch):
    monkeypatch.setattr(extract, "MAX_CELLS", cells)
    rng = random.Random(seed)
    a, b = (extract.parse(random_tree(rng, rng.randint(1, 9))) for _ in range(2))
    pairs = extract.match(a, b)
    assert len(pairs) == largest(a, b) == extract.Matcher().weight(a, b)
    assert all(x.label == y.label for x, y in pairs) and len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def test_optional_blocks_do_not_shift_the_template(spark):
    page = "<body>{0}<div><a>Home</a><a>Shop</a><a>Help</a></div><div><h1>Story {1}</h1><p>It is told <b>here</b> {1}</p></div><div><p>All rights</p><p>with the firm</p></div></body>"
    rows = [(k, f"http://a.example/{k}", page.format("<div><p>Flash {0}</p></div>".format(k) if k % 3 == 0 else "", k)) for k in range(60)]
    out = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all("Home" not in t and "All rights" not in t and f"Story {k}" in t for k, t in out.items())


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>A <a title=don't>Hello it's me</a> B</p>", "A Hello it's me B"),
        ("<p>A <a title=don't>Hello me</a> B</p>", "A Hello me B"),
        ("<p title='a>b' class = x data=\"c>d\">in</p> out", "in out"),
        ("<p it's>in</p> out", "in out"),
        ("<p title=\"open>in</p> out", "in out"),
        ("<article><p class='share-price'>Up</p><section class='legal-analysis'>Law</section><div class='share'>tell</div></article>", "Up Law"),
        ("<p title='class=ad'>kept</p><div class='site-header'>h</div><div id='comment_list'>c</div>", "kept"),
    ],
)
def test_attributes_and_names(page, want):
    assert text_of(page) == want


def test_clashing_columns(spark):
    rows = [(k, f"http://shop.example/{k}", shop(k)) for k in range(8)]
    extra = ", host string, refs string, kind int, constant string, text string, hash int, shape int, n_pages int, n int"
    df = spark.createDataFrame([(*r, "h", "r", 1, "c", "t", 2, 3, 4, 5) for r in rows], PAGES + extra)
    want = sorted(map(str, extract.main_text(spark.createDataFrame(rows, PAGES)).collect()))
    assert sorted(map(str, extract.main_text(df).collect())) == want


def test_deep_trees_that_differ():
    a, b = (extract.parse("<div>" * 3000 + x) for x in ("<b>x</b>", "<i>y</i><b>x</b>"))
    assert len(extract.match(a, b)) == 3002
