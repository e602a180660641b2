from tidemark.llm import pages
from tidemark.llm.pages import Weights, extract

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>T words</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">one</a></li><li><a href="/b">two</a></li></ul></nav><!-- x --><div class="ad">buy this now please</div>
%s<h1>Head   &amp; line</h1><p>First <b>bold</b>&nbsp;text<br>goes on.<p>Second\n one</p><div class="comments"><p>I think so</p></div>%s
<footer>&copy; all rights <a href="/c">c</a></footer></body></html>"""
TEXT = "Head & line\nFirst bold text goes on.\nSecond one"


def test_region_with_and_without_marks():
    weights = pages.learn(pages.count_labels(PAGE % ("<article>", "</article>")))
    assert extract(PAGE % ("<article>", "</article>"), weights) == TEXT
    assert extract(PAGE % ("<div>", "</div>"), weights) == TEXT
    assert extract(PAGE % ("<article>", "</article>"), Weights()) == TEXT


def test_only_pages_with_one_mark_are_labels():
    assert pages.count_labels(PAGE % ("", "")) == {}
    assert pages.count_labels("<article>a</article><article>b</article>") == {}
    counts = pages.count_labels("<main><p>a b<nav>c</nav></p></main>")
    assert counts["word", "p", 1] == 2 and counts["word", "nav!", 0] == 1


def test_best_region_is_the_greatest_of_all():
    """Against all stretches of a page's tokens."""
    page = PAGE % ("<article>", "</article>")
    weights = Weights(word={"p": 0.9}, tag={"p": 0.3, "h1": 0.4, "div": 1.2})
    found, _ = pages.tokens(page)
    score = [weights.of_tag(t.kind) if t.text is None else weights.of_word(t.kind) * len(pages.html.unescape(t.text).split()) for t in found]
    best = max((sum(score[i:j]), -i) for i in range(len(score)) for j in range(i, len(score) + 1))
    text = extract(page, weights)
    begin = -best[1]
    assert text.split()[0] in "".join(t.text or " " for t in found[begin : begin + 3]).split()


def test_odd_pages():
    for page in (None, "", "<", "<p", "</p></p>", "<!-- never closed", "<script>x", "<p>&#x;</p>", "<a href='>'>x</a>", "<P CLASS=x>a</P>" * 3000):
        assert isinstance(extract(page, Weights()), str)
    assert extract("plain &lt;words&gt; &eacute;", Weights()) == "plain <words> é"
    assert extract("<p>a  b<br/>c</p><p></p><p> d </p>", Weights()) == "a b c\nd"
    assert extract("<script>if (a < b) {}</script><p>x y z</p><textarea>no</textarea>", Weights()) == "x y z"


def test_raw_text_ends_only_at_its_own_end_tag():
    article = "<article><p>one two three</p></article>"
    for raw in (
        "<script>for(var i=0;i<n;i++){f(i)}</script>",
        "<script>s = a<b ? \"'\" : 'x</p>'</script >",
        "<SCRIPT>var c = '<!-- ';</script>",
        "<script><!-- w('<script src=y></script>') --></script>",
        "<script><!--> w('<script>')</script>",
        "<style>a::before{content:'<b'}</style>",
        "<title>a <!-- b</title>",
        "<noscript>i<n'</noscript>",
        "<textarea>i<n' </textarea>",
        "<svg><style>i<n'</style></svg>",
        "<datalist><option value=a><option value=b></datalist>",
    ):
        for page in (f"<body>{raw}{article}</body>", f"<body>{raw}{article}<script>x</script>"):
            assert extract(page, Weights()) == "one two three", page
    found, marks = pages.tokens(f"<script>i<n</script>{article}")
    assert marks == 1 and [t.text for t in found if t.label and t.text] == ["one two three"]


def test_head_may_have_no_end_tag():
    head = "<html><head><meta charset=x><title>t i</title><!-- c --><style>p{}</style>\n<template><p>no</p></template>"
    body = "<article><p>one two three</p></article>"
    for end in ("<body>", "</head><body>", "</head>", "", "<body class=x><div>"):
        assert extract(head + end + body, Weights()) == "one two three", end
    assert extract("<head><title>t</title>one two <b>three</b>", Weights()) == "one two three"
    assert extract("<head><title>t</title><link href=a></p><meta>", Weights()) == ""


def test_classes_of_layout_are_no_boilerplate():
    text = "<p>one two three</p><div class='ad-slot'><p>buy</p></div>"
    for page in (
        f"<body class='has-sidebar'><article>{text}</article></body>",
        f"<body class='sidebar'><main id=comments>{text}</main></body>",
        f"<html class='cookie-banner'><body><article class='post comments-open'>{text}</article></body></html>",
        f"<body><article class='related'>{text}</article></body>",
        f"<div id='main' class='no-banner'><article>{text}</article></div>",
        f"<div class='banner'><div role='menu'><article>{text}</article></div></div>",
        f"<main><div class='promo'><article>{text}</article></div></main>",
        f"<div data-class='ad'><article>{text}</article></div>",
    ):
        found, marks = pages.tokens(page)
        assert marks and not extract(page, Weights()).startswith("buy") and extract(page, Weights()).startswith("one two three"), page
        assert [t.text for t in found if t.text and t.label] == ["one two three"], page
        assert [t.text for t in found if t.text and t.kind == "p!"] == ["buy"], page
    assert extract("<div id='main' class='no-banner'><p>one two</p></div>", Weights()) == "one two"
    assert extract("<div class='comments-open'><p>one two</p></div>", Weights()) == "one two"


def test_comments_and_teasers_in_articles_are_boilerplate():
    story = "<p>one two three four five</p>"
    for rest in ("<div id='comments'><article><p>I think</p></article></div>", "<div class='related-posts'><article><p>more</p></article></div>"):
        for page in (f"<main>{story}{rest}</main>", f"<article>{story}</article>{rest}", f"<div class='promo'><article>{story}</article></div>{rest}"):
            words = {t.text: t.kind for t in pages.tokens(page)[0] if t.text}
            assert sorted(words.values()) == ["p", "p!"] and words["one two three four five"] == "p", page


def test_boilerplate_inside_the_region_is_left_out():
    long = " ".join(["word"] * 60)
    for own in ('<div class="ad">buy <b>this</b></div>', "<aside>see also</aside>", '<form>mail <p>now</p></form>', '<section class="comments"><p>I think</p></section>'):
        page = f"<article><p>{long}</p>{own}<p>{long}</p></article>"
        for weights in (Weights(), pages.learn(pages.count_labels(page))):
            assert extract(page, weights) == f"{long}\n{long}", own
    assert extract(f"<p>{long}<span class=ad>buy</span>{long}</p>", Weights()) == f"{long} {long}"
    assert extract(f"<p>{long}</p>in<div class=share>it</div>between<p>{long}</p>", Weights()) == f"{long}\nin\nbetween\n{long}"


def test_tables(spark):
    raw = spark.read.parquet(f"{SF}/pages.parquet")
    weights = pages.fit(raw, 100)
    got = {r.page_id: r for r in pages.extracted(raw, weights).collect()}
    for r in raw.collect():
        marked = r.html.partition("<article>")[2].partition("</article>")[0]
        blocks = pages.re.split("</?(?:p|h1)>", marked)
        wanted = [" ".join(pages.html.unescape(pages.re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        assert got[r.page_id].text == "\n".join(b for b in wanted if b) and got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = spark.createDataFrame([(None, "u", None), (1, None, ""), (1, None, "<p>x")], "page_id long, url string, html string")
    rows = pages.extracted(odd.selectExpr("*", "1 as text"), Weights()).collect()
    assert sorted((r.text, r.n_chars) for r in rows) == [("", 0), ("", 0), ("x", 1)]
    none = raw.limit(0)
    assert pages.fit(none) == Weights() and pages.extracted(none, Weights()).collect() == []


def test_rare_kinds_lose_both_sides_together(spark, monkeypatch):
    monkeypatch.setattr(pages, "KINDS", 3)
    html = "<p>out</p><article>" + "<p>in in in</p>" * 5 + "<em>rare</em></article><em>more</em>"
    weights = pages.fit(spark.createDataFrame([(html,)], "html string"))
    whole = pages.learn(pages.count_labels(html))
    assert weights.word == {"p": whole.word["p"]} and weights.word["p"] < 1
    assert all(whole.tag[k] == v for k, v in weights.tag.items())
