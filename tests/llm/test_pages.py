import random
import time
from html.parser import HTMLParser

from rosterline.llm.pages import Page, best_path, extract_main_text, main_text

SCHEMA = "page_id long, url string, html string, text string, path int"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="home page-7">
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad-12">Buy now</div>
<div id="wrap"><div class="post-%d"><h1>Head &amp; line</h1><p>First  para\ngraph with <b>bold</b> text.<p>Second &eacute; one<br>more, of enough length to count.
<aside>Related things</aside><ul><li>item one of the list</li><li>item two</li></ul></div><div id="comments"><p>A reader says something rather long here, longer than the rest of the page, again and again and again.</p></div></div>
<form><label>Mail</label></form><footer>&copy; us</footer></body></html>"""
WANT = "Head & line\nFirst para graph with bold text.\nSecond é one more, of enough length to count.\nitem one of the list\nitem two"


def test_one_page():
    text, path = main_text(PAGE % 3, [])
    assert text == WANT and path.endswith("div.wrap/div.post-#")


def test_broken_markup():
    assert main_text("", []) == ("", "") and main_text("just < text & more", [])[0] == "just < text & more"
    assert main_text("<div><p>open <b>never closed<div>inner</div></i></section> tail", [])[0] == "open never closed\ninner\ntail"
    assert main_text("<p>a<!-- <p>b --><script>x<p>y", [])[0] == "a"
    assert main_text("<article><p>cut off in a ta<span cla", [])[0].startswith("cut off")
    assert main_text("<p>a<!-->b<!-- c --><![CDATA[x>y]]>d</p>", [])[0] == "abd"
    assert best_path(Page("<nav>only menu</nav>")) is None
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000, [])[0] == "deep"


def test_hosts_agree(spark):
    odd = "<html><body class='home page-1'><div id='wrap'><div class='post-9'><p>Short.</p></div><div class='box'><p>A long box that would win on this page alone, but is not where the host has its texts.</p></div></div></body></html>"
    rows = [(i, f"https://h.org/{i}", PAGE % i, "x", 1) for i in range(5)] + [(9, "https://H.org:80/x", odd, None, None), (10, "https://h.org/o", odd, None, None), (11, None, None, None, None), (12, "no host", "<p>text</p>", None, None), (None, "https://h.org/2", PAGE % 2, None, None), (None, "https://h.org/2", PAGE % 2, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in extract_main_text(docs, least_share=0.2).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert all(got[i] == [WANT] for i in range(5)) and got[None] == [WANT] * 2
    assert got[10] == ["Short."] and got[9][0].startswith("A long box") and got[11] == [""] and got[12] == ["text"]
    assert extract_main_text(docs.limit(0)).count() == 0


def test_text_beside_nested_containers_stays(spark):
    long = "A sentence of the article that is long enough to count for much. " * 20
    want = lambda *parts: "\n".join(" ".join(p.split()) for p in parts)
    shapes = {
        "a": (f"<article><h1>Title</h1><p>Lead here.</p><div class='entry-content'><p>{long}</p></div></article>", want("Title", "Lead here.", long)),
        "b": (f"<article><section class='intro'><p>Short one.</p></section><section class='details'><p>{long}</p></section></article>", want("Short one.", long)),
        "c": (f"<div class='post'><div class='top'><h1>Title</h1></div><div class='text'><p>{long}</p></div></div>", want("Title", long)),
        "d": (f"<div class='x'><h1>Title</h1><p>Lead here.</p><div><p>{long}</p></div></div>", want("Title", "Lead here.", long)),
        "e": (f"<h1>Title</h1><p>Lead here.</p><div><p>{long}</p></div>", want("Title", "Lead here.", long)),
    }
    rows = [(i, f"https://{k}.org/{i}", f"<html><body><nav><a href='/'>Home</a></nav>{page}<footer>us</footer></body></html>", "x", 1) for k, (page, _) in shapes.items() for i in range(3)]
    got = extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert [(r["url"], r["text"][:60]) for r in got if r["text"] != shapes[r["url"][8]][1]] == []


def test_names_of_layouts_do_not_hide_the_article():
    long = "A sentence of the article that is long enough to count for much. " * 20
    said = "A reader says more than the article itself does. " * 60
    around = "<nav>Menu</nav><div class='%s'><article><h1>Title</h1><p>" + long + "</p></article><div class='left-sidebar'><p>Beside.</p></div></div>"
    want = "Title\n" + " ".join(long.split())
    for names in ("content with-sidebar", "no-sidebar", "page has-menu", "wide-nav", "fixed-header", "sidebar-right", "page-header"):
        for rest in ("<footer>us</footer>", f"<div id='comments'><p>{said}</p></div>"):
            assert main_text(f"<html><body>{around % names}{rest}</body></html>", [])[0] == want, names
    assert main_text(f"<div class='menu'><p>{long}</p></div>", [])[0] == " ".join(long.split())
    assert main_text(f"<div class='comments'><p>{said}</p></div><nav>x</nav>", [])[0] == " ".join(said.split())
    related = "<div class='related'><article><p>Another text.</p></article></div><div class='site-header'><p>Us.</p></div>"
    assert main_text(f"<body><div class='post'><p>{long}</p></div>{related}<div class='post-comments'><p>{said}</p></div></body>", [])[0] == " ".join(long.split())


class Plain(HTMLParser):
    """The blocks inside elements that carry ``mark``, by the standard library: the plain reading of well-formed pages."""

    BLOCK = {"p", "h1", "h2", "li", "div", "section", "article", "main", "ul", "blockquote", "aside", "body", "html", "nav", "footer", "header", "form", "pre"}
    OUT = {"nav", "footer", "header", "form", "aside", "script", "style"}

    def __init__(self, page, mark):
        super().__init__(convert_charrefs=True)
        self.mark, self.stack, self.out, self.text = mark, [], [], ""
        self.feed(page)
        self.close()
        self.end()

    def end(self):
        said = " ".join(self.text.split())
        if said and any(m for _, m in self.stack) and not any(t in self.OUT for t, _ in self.stack):
            self.out.append(said)
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
        elif tag in self.BLOCK | self.OUT:
            self.end()
            self.stack.append((tag, ("data-main", self.mark) in attrs))

    def handle_endtag(self, tag):
        if tag in self.BLOCK | self.OUT:
            self.end()
            self.stack.pop()

    def handle_data(self, data):
        self.text += data


def test_generated_pages_of_several_layouts_equal_a_plain_reading(spark):
    r = random.Random(21)
    words = ["alpha", "b&eacute;ta", "gam&amp;ma", "<b>delta</b>", "eps&#105;lon", "z&lt;eta", "<i>eta</i>\n theta", "<!-- note -->iota", '<a href="/x?a=1>2">kappa</a>', "l<br>m"]
    say = lambda n: " ".join(r.choices(words, k=n))
    layouts = {
        "blog": '<div class="page"><header><p>{o}</p></header><div class="post post-{i}" data-main="1">{body}</div><div class="sidebar"><p>{o}</p></div></div>',
        "news": '<nav><ul><li><a href="/">{o}</a></li></ul></nav><main data-main="1"><h1>{o}</h1><section class="text">{body}</section></main><div id="comments"><p>{o} {o}</p></div>',
        "wiki": '<div id="top" class="menu"><a href="/">{o}</a></div><article data-main="1"><h1>{o}</h1>{body}<aside><p>{o}</p></aside></article><form><p>{o}</p></form>',
        "old": '<div class="ad-banner"><p>{o}</p></div><div class="content" data-main="1"><h1>{o}</h1>{body}</div><div class="related"><ul><li>{o}</li></ul></div>',
    }
    rows, want = [], {}
    for i in range(160):
        host = r.choice(["one.org", "two.org"])
        layout = r.choice(["blog", "news"] if host == "one.org" else ["wiki", "old"])
        body = "".join(r.choice(["<p>%s</p>", "<blockquote><p>%s</p></blockquote>", "<ul><li>%s</li></ul>", "<p class='x'>%s</p>", "<p class='ad-hoc'>%s</p>", "<h2 class='section-header'>%s</h2>", "<section class='post-header'><p>%s</p></section>", "<ul class='list'><li class='notice'>%s</li></ul>"]) % say(r.randint(12, 60)) for _ in range(r.randint(2, 9)))
        body = f"<p>{say(40)}</p>" + body
        page = f"<!DOCTYPE html><html><head><title>t</title><style>p {{}}</style></head><body><script>if (1 < 2) '</p>'</script>{layouts[layout].format(i=i, o=say(4), body=body)}<footer><p>{say(5)}</p></footer></body></html>"
        rows.append((i, f"https://{host}/{i}", page, "x", 1))
        want[i] = "\n".join(Plain(page, "1").out)
    got = {x["page_id"]: x["text"] for x in extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(rows[i][2], got[i], want[i]) for i in want if got[i] != want[i]] == []


def test_time_follows_the_length_of_a_page():
    n = 400_000
    pages = {
        "tags cut off": "<a " * (n // 3), "nested": "<div>x" * (n // 6), "quotes": '"' * n, "values": "<a b='" * (n // 6), "open values": '<p class="' * (n // 10), "ends": "<div>" * (n // 10) + "</p>" * (n // 8),
        "raw": "<script></script" * (n // 16), "hints": "<div class='menu'>x" * (n // 19), "paragraphs": "<pre>x" * (n // 6), "comments": "<!--" * (n // 4), "marks": "<" * n, "spaces": "<p class" + " " * n,
        "siblings": "<div>" * 5000 + "<section class=s>x</section>" * (n // 28), "references": "&" * n,
    }
    for name, page in pages.items():
        for before in ("<article><p>Start.</p>", "<p>Start.</p>", "<div class=a><div class=b>"):
            began = time.time()
            best_path(Page(before + page))
            main_text(before + page, ["html/article", "html/div/div"])
            assert time.time() - began < 15, (name, before)


def test_names_of_parts_of_an_article_do_not_cut_it():
    say = lambda k: f"Sentence {k} of the article, long enough to count for something."
    page = f"""<body><div class="site-header"><p>Us</p></div><article><div class="post-header"><h1>Title</h1></div><h2 class="section-header">One</h2><p>{say(1)}</p>
<p class="ad-hoc">{say(2)}</p><div class="share-price"><p>{say(3)}</p></div><h2 class="section-header banner">Two</h2><ul class="menu-of-the-day"><li class="notice">{say(4)}</li></ul>
<table class="related-work"><tr><td class="header">{say(5)}</td></tr></table><div class="ad">Buy</div><div class="share-buttons"><a href="/s">Send</a></div><ul class="nav-links"><li><a href="/n">Next</a></li></ul>
<div class="comments-and-notes"><a href="/c">All that readers said</a></div></article></body>"""
    assert main_text(page, [])[0].split("\n") == ["Title", "One", say(1), say(2), say(3), "Two", say(4), say(5)]
    assert main_text(page.replace("<article>", "<div class='post'>").replace("</article>", "</div>"), [])[0].split("\n") == ["Title", "One", say(1), say(2), say(3), "Two", say(4), say(5)]
