import random

from quayside.llm.html_text import extract, page_lines, shared


def texts(spark, rows):
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, row int")
    out = extract(d)
    assert out.columns == ["page_id", "url", "text"]
    return [(r.page_id, r.url, r.text) for r in out.collect()]


def one(html):
    return "\n".join(page_lines(html)[0])


def test_blocks_and_markup():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:b}</style></head><body class="page">
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>Two</ul></nav><div id="cookie-notice"><p>We use</p></div>
      <div><p>One <b>bold</b>  &lt;x&gt; a&nbsp;b<br>next<p>Two<script>var t="</p>";</script> more <!-- c <p> -->end
      <table><tr><td>a<td>b</tr></table><form><p>Name<input></form><ul><li>i<li>j</ul></div>
      <section class="comments"><div>Nice!</div></section><aside>Side</aside><footer>&copy; x</footer></body></html>"""
    assert one(page) == "One bold <x> a b next\nTwo more end\na b\ni\nj"
    assert one(None) == one("") == one("<p> </p>") == ""
    assert one("a < b &amp c <i") == "a < b & c"
    assert one("<article><h1>H</h1><div class='ad'>buy</div><p>x</article> after")== "H\nx\nafter"
    assert page_lines("<p>out<article><p>in</article>out")[1] == [False, True, False]
    assert one("<nav>never closed <p>x") == ""
    assert one("<p title='a>b'>x</p><p title=\"unclosed>y") .startswith("x")


def test_shared_is_a_longest_common_subsequence():
    rng = random.Random(3)

    def brute(a, b):
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        return d[-1][-1]

    for cells in (1 << 28, 6):
        for _ in range(200):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
            at = shared(a, b, 0, cells)
            assert at == sorted(set(at)) and len(at) == brute(a, b)
            it = iter(b)
            assert all(a[i] in it for i in at)


def test_nearest_page_gives_the_template(spark):
    def page(body, site="x"):
        return f"<body><p>Menu of {site}<p>Log in</p><div>{body}</div><p>All rights reserved by {site}</body>"

    rows = [(i, f"http://h.org/a/{i}", page(f"Story {i} is long enough to count as a story.</div><div>Told by {i} and friends."), None, 1) for i in range(8)]
    rows += [(20, "http://h.org/b/1", page("Elsewhere on the host.", "other"), None, 1)]
    rows += [(30, "http://lone.org/z", page("Only page."), None, 1), (30, "http://lone.org/z", page("Only page."), None, 1)]
    rows += [(40, "http://art.org/1", "<p>Top<article><p>Same line</article>", None, 1), (41, "http://art.org/2", "<p>Top<article><p>Same line<p>Other</article>", None, 1)]
    rows += [(None, None, None, None, None), (50, "", "<p>x", None, 2), (51, "odd url", "", None, 2)]
    got = sorted(texts(spark, rows), key=str)
    want = [(i, f"http://h.org/a/{i}", f"Story {i} is long enough to count as a story.\nTold by {i} and friends.") for i in range(8)]
    menu = "Menu of x\nLog in\nOnly page.\nAll rights reserved by x"
    want += [(30, "http://lone.org/z", menu)] * 2
    want += [(40, "http://art.org/1", "Same line"), (41, "http://art.org/2", "Same line\nOther"), (None, None, ""), (50, "", "x"), (51, "odd url", "")]
    want += [(20, "http://h.org/b/1", "Menu of other\nElsewhere on the host.\nAll rights reserved by other")]
    assert got == sorted(want, key=str)


def test_names_only_supplement_the_difference(spark):
    def page(i):
        return (f"<div class=site><p>Welcome to the site</div><div id=content><p>The long story {i} is told outside of any article here.</div>"
                f"<article><p>Read more<p>Teaser {i}</article><div class=comment>Comment {i}</div>")

    rows = [(i, f"http://d.org/a/{i}", page(i), None, 1) for i in range(3)]
    rows += [(10, "http://form.org/", "<form><nav>Home</nav><div class=widget><p>All of the story</div><p>and more.</form>", None, 1)]
    rows += [(11, "http://parts.org/", "<p>Hi" + "".join(f"<div class=widget>Part {i} of the story</div>" for i in range(4)), None, 1)]
    rows += [(12, "http://lone.org/", "<div>The story of a lone page.</div><article>Teaser</article><footer>Foot</footer>", None, 1)]
    want = [(i, f"http://d.org/a/{i}", f"The long story {i} is told outside of any article here.\nTeaser {i}") for i in range(3)]
    want += [(10, "http://form.org/", "All of the story\nand more."), (11, "http://parts.org/", "Hi")]
    want += [(12, "http://lone.org/", "The story of a lone page.\nTeaser")]
    assert sorted(texts(spark, rows)) == want


def test_empty_table(spark):
    assert texts(spark, []) == []


def test_boilerplate_that_outweighs_the_story(spark):
    story = "<p>A short story of a few words only.</p>"
    comments = "".join(f"<div class='comment'><p>Reader {i} says something long about the matter at hand.</p></div>" for i in range(20))
    around = ("<nav>" + "menu item " * 40 + "</nav><div class=advert>" + "buy now " * 40 + "</div><aside>" + "side " * 50 + "</aside><form>"
              + "field " * 30 + "</form><footer>" + "imprint " * 30 + "</footer>")
    pages = [story + f"<div id=comments>{comments}</div>", around + story, f"<div class='layout sidebar'><h1>Title</h1>{story}{around}</div>",
             f"<div class='sidebar'>{story}<nav>Home</nav></div>", f"<form><main>{story}</main><div class=search>Find</div></form>"]
    rows = [(i, f"http://h{i}.org/x", html, None, 1) for i, html in enumerate(pages)]
    text = "A short story of a few words only."
    assert [t for _, _, t in sorted(texts(spark, rows))] == [text, text, f"Title\n{text}", text, text]
