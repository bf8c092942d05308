"""Main text of pages."""

from vitrine.llm.main_text import extract_main_text, main_blocks, match, parse, slots_of


def blocks(html):
    return main_blocks(parse(html), set())


def test_blocks_of_an_article():
    page = (
        "<html><head><title>T<b></title></head><body class=x><header><h1>Site</h1></header><div class='sidebar-left'>s</div>"
        "<article><header><h1>A &amp; B</h1></header><p>one<br>two   <i>three</i>&nbsp;four<ul><li>a<li>b</ul><aside>no</aside>"
        "<form>f<input></form><script>if(a<b){'</p>'}</script><p>x < y<table><tr><td>c1<td>c2</table>"
        "<section id='comments'><p>bad</section></article><footer>f</footer>"
    )
    assert blocks(page) == ["A & B", "one two three four", "a", "b", "x < y", "c1", "c2"]


def test_broken_pages():
    assert blocks("") == [] and blocks("plain <b>text") == ["plain text"] and blocks("<p>a &copy &#233; &am") == ["a © é &am"]
    assert blocks("<div>" * 5000 + "deep") == ["deep"] and blocks("<!-- open <p>x") == [] and blocks("<p>a<p class='x") == ["a"]
    assert blocks("<article><p><b>one<br><p>two</b></article>") == ["one", "two"]
    assert blocks("<script>x") == [] and blocks("<nav>menu</nav><p>text</p>") == ["text"]
    assert blocks("<ul><li><a href=x>home</a><li><a>next</a></ul><p>text</p>") == ["text"]


def test_tree_matching_keeps_order():
    one = slots_of(parse("<div><h1>a</h1><p>b</p><p>c</p><span>d</span></div>"))
    two = slots_of(parse("<div><p>x</p><h1>y</h1><p>z</p><span>w</span></div>"))
    score, pairs = match(one, two)
    assert score == 4 and sorted(a.kind for a, _ in pairs) in (["div|", "h1|", "p|", "span|"], ["div|", "p|", "p|", "span|"])
    assert all(a.kind == b.kind for a, b in pairs)


def own_text(n):
    return " ".join(f"word{n}x{k}" for k in range(12))


def page(n, article, extra="<p>Sign up for our letter.</p>"):
    return f"<body><div><p>Shop of the day</p></div><article><h1>Title {n}</h1><p>{article}</p><div>{extra}</div></article></body>"


def test_what_all_pages_of_a_host_have_is_template(spark):
    rows = [(n, f"http://shop.example.com/{n}", page(n, own_text(n))) for n in range(8)]
    rows += [(20, "http://one.example.com/", page(1, "Only page.")), (21, None, None), (22, "x", ""), (None, "http://shop.example.com/z", page(9, "No id."))]
    rows += [(3, "http://shop.example.com/3", rows[3][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as tree", "3 as text")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    texts = {r.page_id: r.text for r in got.collect()}
    assert all(texts[n] == f"Title {n}\n{own_text(n)}" for n in range(8))
    assert texts[None] == "Title 9\nNo id."
    # a host with one page shows no template
    assert texts[20] == "Title 1\nOnly page.\nSign up for our letter."
    assert texts[21] == texts[22] == ""
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_copies_of_a_page_are_no_template(spark):
    rows = [(n, "http://a.example.com/", page(1, "The same long text on every page of this host, word by word.")) for n in range(6)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text.split("\n")[1] for r in got.collect()} == {"The same long text on every page of this host, word by word."}


def test_no_pages(spark):
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, rows):
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r.page_id: r.text for r in got.collect()}


def test_boilerplate_longer_than_the_article_is_template(spark):
    notice = " ".join(f"notice{k}" for k in range(60))
    html = "<body><div class=x>{}</div><p>{}</p></body>".format
    rows = [(n, "http://long.example.com/", html(notice, own_text(n))) for n in range(12)]
    # copies of one page count once, and make nothing of its own text template
    rows += [(n, "http://long.example.com/", html(notice, own_text(0))) for n in range(100, 300)]
    texts = texts_of(spark, rows)
    assert all(texts[n] == own_text(n if n < 100 else 0) for n in texts)


def test_template_that_the_first_page_lacks(spark):
    block = "<div class=y><p>Write to us at any time.</p></div>"
    rows = [(0, "http://home.example.com/", "<body><table><tr><td>Nothing here</td></tr></table></body>")]
    rows += [(n, "http://home.example.com/", f"<body><section><p>{own_text(n)}</p>{block}</section></body>") for n in range(1, 30)]
    texts = texts_of(spark, rows)
    assert texts[0] == "Nothing here" and all(texts[n] == own_text(n) for n in range(1, 30))


def test_pages_of_any_depth(spark):
    deep = "<font>" * 3000
    assert blocks(f"{deep}<nav>menu</nav><article><p>one</p><form>f</form></article>") == ["one"]
    assert blocks("<ul>" * 3000 + "<li><a>x</a>") == [] and blocks("<div>" * 3000 + "<main>two</main>") == ["two"]
    rows = [(n, "http://deep.example.com/", f"{deep}<article><p>{own_text(n)}</p><div>Sign up.</div></article>") for n in range(6)]
    assert texts_of(spark, rows) == {n: own_text(n) for n in range(6)}
