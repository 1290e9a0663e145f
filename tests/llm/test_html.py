import random
from collections import defaultdict
from html.parser import HTMLParser

import pytest

from areatab.llm import html as H

ARTICLE = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use</div>
<nav><ul><li><a href=/>Home</a></ul></nav><form><main><h1>T&eacute;st&nbsp; x</h1><article class="post has-sidebar"><header><h2>Sub</h2></header>
<p>One <a href=x>two</a>
three<p>four &lt;b&gt; &#233; &amp; &copy<div class=ad>BUY</div><ul><li>a<li>b</ul><form><label>mail</label></form><span class="share">tweet</span> tail
<!-- <p>no</p> --><script>if (a</b) "</p>"</script><table><tr><td>c1<td>c2</table><pre>x  y</pre></article>
<section id="comments"><article><p>nice</p></article></section></main></form><aside>side</aside><footer>f</footer>"""


def content(page):
    return [t for t, v in H.blocks(page) if v == H.CONTENT]


def test_article_without_what_surrounds_it():
    assert content(ARTICLE) == ["Sub", "One two three", "four <b> é & ©", "a", "b", "tail", "c1", "c2", "x y"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []), ("plain text", []), ("<", []), ("<article>cut &am", ["cut &am"]), ("<article>a <p>b</p> c<br>d</article>e", ["a", "b", "c", "d"]),
        ("<article><p>x</p><p class='un", ["x"]), ("<article><b>bold<p>next</b> one</article>", ["bold", "next one"]),
        ('<article><p title="a>b" data-x=\'<p>\'>quoted</article>', ["quoted"]), ("<ARTICLE><P>Upper</P></ARTICLE>", ["Upper"]),
        ("<main><p>m</p><aside>s</aside></main><p>o</p>", ["m"]), ('<div id="content"><p>c</p></div><div id="sidebar">s</div>', ["c"]),
        ("<article><textarea>t</textarea><noscript>n</noscript>a &lt;script&gt; 1 < 2</article>", ["a <script> 1 < 2"]),
        ("<article></b></i></div>stray</article>", ["stray"]), ("<article><p>a<p>a</article>", ["a", "a"]),
    ],
)
def test_small_pages(page, want):
    assert content(page) == want


def test_a_teaser_beside_the_body_does_not_hide_it():
    page = "<article class=teaser>card</article><div><p>Real body one two three</p></div><div class=sidebar>side</div>"
    assert H.main_text(H.blocks(page), None)[0] == "card\nReal body one two three"
    assert [v for _, v in H.blocks(page)] == [H.CONTENT, H.OPEN, H.OUT]


def test_apostrophes_in_unquoted_values():
    assert content("<article><p>A</p><a title=it's>B</a><p>C it's D</p><p>E</p></article>") == ["A", "B", "C it's D", "E"]
    assert content("<article><p title=a'b>one</p><p data-x=\"q'q\" y='z\"z'>two</p><p x = 'a>b' >three</p><p\">four</article>") == ["one", "two", "three", "four"]
    assert content("<article><p>x</p><p class='un>rest</p></article>") == ["x"]


def test_one_word_of_a_name_is_not_enough_inside_an_article():
    page = "<article><p>a</p>{}</article>"
    for kept in ("<section class='promotion-history'>b</section>", "<div id=form-of-government>b</div>", "<div class='ad-hoc-networks'>b</div>", "<p class='share-prices'>b</p>"):
        assert content(page.format(kept)) == ["a", "b"], kept
    for gone in ("<div class=ad>b</div>", "<div class='ad-slot-2'>b</div>", "<div id=social-share-buttons>b</div>", "<p class='newsletter'>b</p>", "<div class='relatedPosts'>b</div>"):
        assert content(page.format(gone)) == ["a"], gone


class Plain(HTMLParser):
    """Article text by the standard library's parser: an extraction of its own, enough for the given pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.path, self.lines, self.held = [], [], ""

    def flush(self):
        if self.held.split():
            self.lines.append(" ".join(self.held.split()))
        self.held = ""

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b", "i", "em", "strong", "span", "code", "small"):
            self.flush()
        if tag not in ("br", "hr", "img", "input", "meta", "link"):
            names = set((dict(attrs).get("class") or "").split()) | set((dict(attrs).get("id") or "").split())
            out = tag in ("nav", "footer", "aside", "form", "script", "style") or bool(
                names & {"ad", "ads", "advert", "sidebar", "cookie", "cookie-banner", "comments", "comment", "menu", "nav", "notice", "related", "share", "newsletter", "breadcrumb"}
            )
            self.path.append((tag, out))

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i", "em", "strong", "span", "code", "small"):
            self.flush()
        while any(t == tag for t, _ in self.path) and self.path.pop()[0] != tag:
            pass

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.path) and not any(out for _, out in self.path):
            self.held += data


def test_given_pages_against_another_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        p = Plain()
        p.feed(r.html or "")
        p.close()
        p.flush()
        want[r.page_id] = "\n".join(p.lines)
    found = {r.page_id: r.text for r in H.extract(pages).collect()}
    assert found == want and sum(map(bool, want.values())) > 40


def test_deep_and_long_pages():
    assert content("<article>" + "<div>" * 20_000 + "deep" + "</p></b>" * 20_000) == ["deep"]
    assert len(content("<article>" + "<p>w w</p>" * 50_000)[0]) == 3


def test_hosts():
    for url, host in {"https://a.Example.org:80/x": "a.example.org", "http://u@b/": "b", "//c?q": "c", "x": "", None: "", "ftp://d#e": "d"}.items():
        assert H.host_of(url) == host


def brute(rows):
    """Every run of tokens of every distinct stream, by host."""
    pages = [(H.host_of(u), H.blocks(h or "")) for _, u, h in rows]
    seen = defaultdict(set)
    for host, found in pages:
        tokens = tuple(w for w, _ in H.stream(found))
        for k in range(len(tokens) - H.LENGTH + 1):
            seen[host, tokens[k : k + H.LENGTH]].add(tokens)
    out = []
    for (i, u, _), (host, found) in zip(rows, pages, strict=True):
        tokens = tuple(w for w, _ in H.stream(found))
        hit = [k for k in range(len(tokens) - H.LENGTH + 1) if len(seen[host, tokens[k : k + H.LENGTH]]) >= H.PAGES]
        text, repeated = H.main_text(found, [{"lo": k, "hi": k} for k in hit])
        out.append((i, u, text, len(text), repeated))
    return sorted(out, key=str)


def site(rng):
    """Pages without an article, so that the host's repeated runs decide."""
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(40))
    words = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for host in ("one", "two", "three"):
        shared = [words(n) for n in (3, 6, 9, 20, 40)]
        for k in range(rng.choice([2, 14])):
            top = "".join(f"<div>{s}</div>" for s in shared if rng.random() < 0.8)
            own = "".join(f"<p>{words(rng.randint(0, 30))}</p>" for _ in range(3))
            tail = f"<p>{words(5)} {shared[3]} {words(5)}</p>" if rng.random() < 0.3 else ""
            rows.append((len(rows), f"http://{host}/{k}", top + own + tail))
    mirrors = [(900 + k, f"http://one/m{k}", rows[0][2]) for k in range(5)]
    return rows + mirrors + [rows[1], (None, None, None), (901, "x", ""), (902, None, ARTICLE)]


@pytest.mark.parametrize("seed", [1, 2])
def test_extract_equals_brute_force(spark, seed):
    rows = site(random.Random(seed))
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, text string, key int")
    found = sorted((tuple(r[:5]) for r in H.extract(frame).collect()), key=str)
    assert found == brute(rows)
    assert sum(r[4] for r in found) > 200  # the hosts do repeat runs
    assert H.extract(frame.limit(0)).count() == 0
