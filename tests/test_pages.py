"""Page text as a reader sees it: nested markup, encoded characters, any quotes."""

import random
import time

from tablewright.operators import markup, matching, pages

HTML = (
    "<h4 class=x><i>Top</i> Notes</h4><SPAN class='note pyramid-note-label'><b>Rose</b> Absolute</SPAN>"
    '<span class="pyramid-note-label">Salt &amp; P&#233;pper &#x2014; &lt;b&gt; &amp;lt; &#bad;</span><span class="other">no</span>'
    "<h4>Base</h4><div class=\"pyramid-note-label\"><span>Oak</span><span>moss</span></div><h4>Reviews</h4>"
    '<span class="pyramid-note-label">stray</span>'
)
LINKS = (
    "<a href=\"/perfume/a?x=1&amp;y=2\">A <b>one</b></a><a class=z HREF = '/perfume/b'>B &quot;two&quot;</a >"
    "<a id=q href=/perfume/c target=t>C</a><abbr href='/perfume/d'>D</abbr><a data-href='/perfume/e'>E</a><a href=''>F</a>"
)
RATING = (
    "<p><span class=v itemprop=ratingValue><b> 4.2</b></span></p><meta content='1024' itemprop='ratingCount'>"
    "<span itemprop=\"ratingValueOther\">9</span>"
)


def test_sections_hold_all_visible_text(spark):
    df = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "id int, html string")
    found = pages.extract_sections(df, "id", "html", sections=matching.SECTION_WORDS).orderBy("position").collect()
    assert [(r.heading, r.section, r.label) for r in found] == [
        ("Top Notes", "top", "Rose Absolute"), ("Top Notes", "top", "Salt & Pépper — <b> &lt; &#bad;"),
        ("Base", "base", "Oakmoss"), ("Base", "base", "stray"),
    ]
    long = spark.createDataFrame([(1, f"<h1>T</h1><p>{'x' * 20_000}</p>")], "id int, html string")
    for limit, n in ((60, 0), (None, 1)):
        assert pages.extract_sections(long, "id", "html", "h1", None, "p", None, limit).count() == n


def test_links_with_any_quotes(spark):
    df = spark.createDataFrame([(1, LINKS), (2, None)], "id int, html string")
    found = pages.extract_links(df, "id", "html").orderBy("position").collect()
    assert [(r.position, r.href, r.text) for r in found] == [
        (0, "/perfume/a?x=1&y=2", "A one"), (1, "/perfume/b", 'B "two"'), (2, "/perfume/c", "C"),
    ]


def test_rating_inside_markup(spark):
    df = spark.createDataFrame([(1, RATING), (2, "<p>none</p>"), (3, None)], "id int, html string")
    got = sorted(tuple(r) for r in pages.extract_rating(df, "id", "html").collect())
    assert got == [(1, 4.2, 1024), (2, None, None), (3, None, None)]


NESTED = (
    "<!-- <h4>Top</h4><span class='pyramid-note-label'>ghost</span><a href='/perfume/no'>x</a> -->"
    "<script>if (a < b) t = \"<h4>Top</h4><a href='/perfume/no'>x</a>\"</script><style>a::before{content:'<a href=/perfume/no>'}</style>"
    "<h4>Top <h5>notes</h5></h4><div class=pyramid-note-label><div>Rose</div> Absolute <div>of <div>May</div></div></div>"
    "<p>one<p class=pyramid-note-label>two<div>three</div><ul><li class=pyramid-note-label>four<ul><li>in</li></ul><li>five</ul>"
    "<div itemprop=ratingValue><div>4.2</div> of <div>5</div></div><A HREF=/perfume/a>1<a href=/perfume/b>2</a></a>"
    "<a title='>' href='/perfume/c?a=1&amp;b'>3 < 4<br/>5</A><b>unclosed <i class=pyramid-note-label>six"
)


def test_elements_end_at_their_own_tags(spark):
    df = spark.createDataFrame([(1, NESTED)], "id int, html string")
    found = pages.extract_sections(df, "id", "html", sections=matching.SECTION_WORDS).orderBy("position").collect()
    assert [r.label for r in found] == ["Rose Absolute of May", "two", "fourin", "six"]
    assert {r.heading for r in found} == {"Top notes"}
    links = pages.extract_links(df, "id", "html").orderBy("position").collect()
    assert [(r.href, r.text) for r in links] == [("/perfume/a", "1"), ("/perfume/b", "2"), ("/perfume/c?a=1&b", "3 < 45")]
    assert [e[1] for e in markup.find_elements(NESTED, [markup.Rule("r", attribute="itemprop", word="ratingValue")])] == ["4.2 of 5"]


def test_elements_next_to_a_tree():
    """Random well-formed trees: the text of an element is that of everything below it."""
    pick = random.Random(2)

    def tree(depth):
        tag = pick.choice(["div", "span", "b", "section"])
        marked = pick.random() < 0.5
        parts, texts, inner = [], [], []
        for _ in range(pick.randrange(4) if depth else 0):
            html, text, below = tree(depth - 1)
            word = pick.choice(["w", "x &amp; y", "", "<!-- <b id=n> -->", "<br>", "<img alt='>'>"])
            parts += [html, word]
            texts += [text, {"w": "w", "x &amp; y": "x & y"}.get(word, "")]
            inner += below
        text = "".join(texts) + f"t{depth}"
        html = f"<{tag}{' id=n' if marked else ''}>{''.join(parts)}t{depth}</{tag}>"
        return html, text, ([text] if marked else []) + inner

    for _ in range(200):
        html, _, want = tree(5)
        assert [e[1] for e in markup.find_elements(html, [markup.Rule("n", attribute="id", word="n")])] == [w.strip() for w in want]


def test_odd_markup_takes_linear_time():
    began = time.time()
    for page in ("<a " * 100_000, "<" * 300_000, "<b>" * 100_000 + "</i>" * 100_000, '<a "' * 100_001, "<!--" * 100_000, "<p><i>" * 50_000, "<a x" + "=" * 300_000):
        markup.find_elements(page, [markup.Rule("a", "a|b", "href")])
    assert time.time() - began < 20
