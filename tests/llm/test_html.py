import re

import pyarrow.parquet as pq
import pytest

from quire.llm import html as H

SCHEMA = "page_id bigint, url string, html string, text string, host string"


def page(i, body, extra=""):
    return f"""<!DOCTYPE html><html><head><title>t{i}</title><style>p {{}}</style><script>var a = "<p>no</p>";</script></head><body>
<div class="top"><ul><li><a href="/">Home</a><li><a href="/a">About us</a></ul></div><div class="box"><h1>Title {i}</h1>{body}</div>{extra}
<div class="cookie-notice"><p>We use cookies</p></div><div class="comments"><p>Nice one {i}</p></div><footer><p>&copy; 2024</p></footer></body></html>"""


BODIES = [
    "<p>First &amp; <b>second</b>\n part of a fairly long article text.</p><p>More text follows here, with caf&eacute; &#8212; and so on.",
    "<p>Another article, of one paragraph, that is long enough to be the main text of a page.</p><ul><li>point one is here<li>point two is there</ul>",
    "<p>A third article has this to say about the weather of the day in the town.</p><blockquote>Quoted words of somebody</blockquote>",
    "<p>The fourth article is about the trains that no longer stop in the village.</p><table><tr><td>cell a<td>cell b</table>",
]
TEXTS = [
    "Title 0\n\nFirst & second part of a fairly long article text.\n\nMore text follows here, with café — and so on.",
    "Title 1\n\nAnother article, of one paragraph, that is long enough to be the main text of a page.\n\npoint one is here\n\npoint two is there",
    "Title 2\n\nA third article has this to say about the weather of the day in the town.\n\nQuoted words of somebody",
    "Title 3\n\nThe fourth article is about the trains that no longer stop in the village.\n\ncell a\n\ncell b",
]


def test_articles_of_one_host(spark):
    rows = [(i, f"https://a.example/{i}", page(i, b), "x", "y") for i, b in enumerate(BODIES)]
    rows += [(9, None, None, "x", "y"), (10, "https://a.example/e", "", "x", "y"), (None, "https://b.example/", "<p>only text here", "x", "y"), (2, "https://a.example/2", page(2, BODIES[2]), "x", "y"), (11, "no url", "< not > html & all", "x", "y")]
    out = H.extracted(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    text = {r.page_id: r.text for r in out}
    assert [text[i] for i in range(4)] == TEXTS
    assert text[9] == text[10] == "" and text[None] == "only text here"


def test_empty_table(spark):
    assert H.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mismatches_become_slots_optional_and_repeated_groups():
    whole = H.merged(H.lifted(H.parsed("<ul><li>a</li><li>b</li></ul><p>same</p>")), H.lifted(H.parsed("<ul><li>c</li></ul><h2>new</h2><p>same</p>")))
    assert H.written(whole).strip() == "<><ul>(<li>#TEXT</li>)+</ul> (<h2>new</h2>)? <p>same</p></>"


def test_very_deep_and_long_pages():
    deep = "<div>" * 5000 + "<p>" + "word " * 50_000
    assert H.main_text(deep, None) == ("word " * 50_000).strip()


def bare(i, name="wrap"):
    """A page without any telling element: menu, teaser and notice are plain boxes."""
    return f"""<html><head><title>t{i}</title></head><body><div><a href="/">Home</a> <a href="/n">News of the day</a></div>
<div class="{name}"><div class="c1"><h1>Headline {i} about things</h1><p>Paragraph one of page {i} goes on for quite some time indeed.</p><p class="alert">Alarm {i} was raised.</p>
<h2 id="related-work">Related work {i}</h2><h2>Sources</h2><p>More on {i}: text continues with many words.</p><p hidden>Kept {i}.</p><p>Read our terms of use here.</p></div>
<div class="c2"><p>Teaser {i * 7}: something else happened</p><a href="/x{i}">go on {i}</a></div></div><div>Copyright notice by us</div></body></html>"""


def test_the_wrapper_tells_the_article_where_no_element_does(spark):
    rows = [(i, f"https://c.example/{i}", bare(i), "x", "y") for i in range(12)] + [(100 + i, f"https://c.example/{i}", bare(3), "x", "y") for i in range(5)]
    text = {r.page_id: r.text for r in H.extracted(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()}
    want = lambda i: f"Headline {i} about things\n\nParagraph one of page {i} goes on for quite some time indeed.\n\nAlarm {i} was raised.\n\nRelated work {i}\n\nSources\n\nMore on {i}: text continues with many words.\n\nKept {i}."
    assert all(text[i] == want(i) for i in range(12)) and text[104] == want(3)
    # Without the wrapper menu, teaser, notice and template texts stay in.
    assert "Teaser" in H.main_text(bare(5), None) and "terms of use" in H.main_text(bare(5), None)


def test_a_page_that_the_sample_does_not_hold():
    wrapper = H.inferred([bare(i) for i in range(6)])
    assert H.main_text(bare(999), wrapper).startswith("Headline 999") and "Teaser" not in H.main_text(bare(999), wrapper)
    other = "<html><body><main><p>Another template.</p></main><footer>foot</footer></body></html>"
    assert H.main_text(other, wrapper) == "Another template."


def test_pages_that_are_all_alike_keep_their_text():
    wrapper = H.inferred([bare(1)] * 12)
    assert "Headline 1 about things" in H.main_text(bare(1), wrapper)
    assert H.main_text(f"<article><p>Same text.</p></article><p>{1}</p>", H.inferred(["<article><p>Same text.</p></article><p>1</p>"] * 4)) == "Same text."


def test_what_all_articles_say_stays_in_them():
    said = "All figures are given in euros."
    for tag in ("article", "main"):
        for inner in ("", "div"):
            box = (f"<{inner}>", f"</{inner}>") if inner else ("", "")
            pages = [f"<body><nav>Home</nav><{tag}>{box[0]}<h1>Report {i}</h1><p>Sales of the year {i} were up again.</p><p>{said}</p><p>Costs of the year {i} fell.</p>{box[1]}</{tag}><footer>f</footer></body>" for i in range(8)]
            wrapper = H.inferred(pages[:6])
            assert all(H.main_text(p, wrapper) == f"Report {i}\n\nSales of the year {i} were up again.\n\n{said}\n\nCosts of the year {i} fell." for i, p in enumerate(pages))


def test_names_count_for_boxes_only():
    page = '<article><h2 id="search-methods">Search</h2><p class="comment">A remark of the author.</p><div class="comments"><p>Reader says</p></div><div class="cookie-notice">Cookies</div><section id="related-work"><p>Kept.</p></section><form><p>Name</p></form></article>'
    assert H.main_text(page, None) == "Search\n\nA remark of the author.\n\nKept."


def test_given_pages_without_telling_elements():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    hosts = {}
    for p in pages:
        hosts.setdefault(p["url"].split("/")[2], []).append(p["html"])
    plain = lambda x: re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", x).replace('<div class="ad">', "<div>")
    own = [(x, H.main_text(x, None), plain(x), H.inferred([plain(y) for y in group[: H.SAMPLES]])) for group in hosts.values() if len(group) >= 3 for x in group]
    assert len(own) > 100 and all(H.main_text(bare_page, wrapper) == true for _, true, bare_page, wrapper in own)
    assert not any(H.main_text(bare_page, None) == true for _, true, bare_page, _ in own)


def test_all_pages_of_a_host_count(spark):
    """Two hundred articles, of which every fiftieth has a list of links that the others haven't."""
    more = lambda i: f'<ul class="more"><li><a href="/m{i}">Further reading number {i}</a></li><li><a href="/n{i}">Still more of it, {i}</a></li></ul>' if i % 50 == 7 else ""
    rows = [(i, f"https://w.example/{i}", bare(i).replace("use here.</p>", "use here.</p>" + more(i)), "x", "y") for i in range(200)]
    rows += [(i, f"https://w.example/{i}", rows[0][2], "x", "y") for i in range(200, 220)] + [(None, "https://w.example/", rows[57][2], "x", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(r.host, r.n_pages) for r in H.wrappers(df).collect()] == [("w.example", 200)]
    want = lambda i: f"Headline {i} about things\n\nParagraph one of page {i} goes on for quite some time indeed.\n\nAlarm {i} was raised.\n\nRelated work {i}\n\nSources\n\nMore on {i}: text continues with many words.\n\nKept {i}."
    for parts in (1, 7):
        text = {r.page_id: r.text for r in H.extracted(df.repartition(parts)).collect()}
        assert [text[i] for i in range(200)] == [want(i) for i in range(200)] and text[210] == want(0) and text[None] == want(57)


@pytest.mark.parametrize("broadcast", [H.BROADCAST_BYTES, -1])
def test_wrappers_of_the_cluster_are_those_of_one_place(spark, monkeypatch, broadcast):
    monkeypatch.setattr(H, "BROADCAST_BYTES", broadcast)
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    hosts = {}
    for p in pages:
        hosts.setdefault(p["url"].split("/")[2], []).append(re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", p["html"]))
    df = spark.createDataFrame([(i, f"https://{h}/{i}", x, "x", "y") for h, own in hosts.items() for i, x in enumerate(own)], SCHEMA)
    found = {r.host: (H.json.loads(r.wrapper)["parts"], r.n_pages) for r in H.wrappers(df.repartition(5)).collect()}
    assert found == {h: (H.inferred(own)["parts"], len(set(own))) for h, own in hosts.items()}


def test_one_page_in_ten_may_differ():
    pages = [bare(i) for i in range(39)] + ["<html><body><p>Not found</p></body></html>"]
    wrapper = H.inferred(pages)
    text = H.main_text(bare(5), wrapper)
    assert text.startswith("Headline 5") and text.endswith("Kept 5.") and "terms of use" not in text and "Teaser" not in text


def test_wrappers_stay_small_where_names_never_repeat():
    pages = [f'<body><div class="top">Home</div><div class="post-{i}"><h1>Title {i}</h1><p>Text of the article {i}, of some length.</p></div><div class="ad"><p>Buy</p></div></body>' for i in range(3 * H.WIDE)]
    wrapper = H.inferred(pages)
    assert len(H.json.dumps(wrapper)) < 2000
    assert all(H.main_text(p, wrapper).endswith(f"Title {i}\n\nText of the article {i}, of some length.") for i, p in enumerate(pages))
    long = "<body><article>" + "".join(f"<h2>Part {i}</h2><p>Text {i}</p>" for i in range(3000)) + "</article></body>"
    own = H.inferred([long, long.replace("Text", "Words")])
    assert H.main_text(long, own) == "\n\n".join(x for i in range(3000) for x in (f"Part {i}", f"Text {i}"))
