import html
import random

import pytest
from pyspark.sql import functions as F

from tamiz.llm import template

PAGE = "page_id long, url string, html string"


def render(rng, host, body, number, shape="article"):
    """A page of a host, and the text that belongs to its article."""
    words = lambda n: " ".join(rng.choice(["river", "stone", "a&b", "<i>", "ü", "mill", "tree"]) for _ in range(n))
    paragraphs = [words(rng.randrange(3, 30)) for _ in range(body)]
    inner = "".join(f"<p>{html.escape(p)}</p>\n" for p in paragraphs)
    nav = "".join(f'<li><a href="/{i}">link {words(1)}</a></li>' for i in range(rng.randrange(2, 5)))
    box = {"article": f"<article><h1>Title {number}</h1>{inner}<div class='comments'><p>reader {number}</p></div></article>",
           "div": f"<div id=content><h1>Title {number}</h1>{inner}</div><div class='sidebar'><p>{html.escape(words(5))}</p></div>"}[shape]
    page = (
        f"<!DOCTYPE html><html><head><title>T {number}</title><script>var x = '</p><p>no';</script><style>p{{}}</style></head><body>"
        f"<header>Welcome to {host}</header><nav><ul>{nav}</ul></nav><!-- note {number} --><div class=\"ad box\">Buy {number}</div>"
        f"<form><input name=q><p>Search here</p></form>{box}<footer>&copy; {host} number {number}</footer></body></html>"
    )
    return page, "\n".join([f"Title {number}", *(" ".join(p.split()) for p in paragraphs)])


@pytest.fixture(scope="module")
def site():
    rng = random.Random(5)
    rows, want = [], {}
    for number in range(60):
        host = ["one.example", "two.example", f"lone{number}.example"][min(2, number // 20)] if number < 45 else "two.example"
        shape = "div" if host == "two.example" else "article"
        page, text = render(rng, host, rng.randrange(1, 6), number, shape)
        rows.append((number, f"https://{host}/p{number}", page))
        want[number] = text
    return rows, want


def test_articles(spark, site):
    rows, want = site
    got = {r["page_id"]: r for r in template.extract_articles(spark.createDataFrame(rows, PAGE).repartition(4)).collect()}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_template_of_a_host(spark, site):
    rows = spark.createDataFrame(site[0], PAGE).where("url like '%one.example%'")
    named = rows.select(F.lit("one").alias("host"), F.col("page_id").alias("row"), "html")
    classes = template.occurrence_classes(named)
    once = classes.where("once").collect()
    assert len(once) == 1  # one vector, so one class
    valid = template.valid_classes(named, classes)
    assert valid.where("once").count() == 1
    words = {template.token("w", w, "/html/body/footer") for w in ("©", "one.example", "number")}
    assert words <= set(once[0]["tokens"])
    assert template.token("w", "7", "/html/body/footer") not in set(once[0]["tokens"])
    # list items occur as often as their links on each page, but not once a page
    repeated = {t for r in valid.where("not once").collect() for t in r["tokens"]}
    assert template.token("<", "li", "/html/body/nav/ul") in repeated


def test_order_decides_validity(spark):
    pages = [(i, "http://h/", "<body><section></section><aside></aside></body>" if i % 2 else "<body><aside></aside><section></section></body>") for i in range(6)]
    named = spark.createDataFrame(pages, PAGE).select(F.lit("h").alias("host"), F.col("page_id").alias("row"), "html")
    classes = template.occurrence_classes(named)
    assert classes.count() == 1
    assert template.valid_classes(named, classes).count() == 0


def test_awkward_pages(spark):
    rows = [
        (1, None, "<p>no url"), (2, "http://a.b/", None), (3, "http://a.b/", ""), (3, "http://a.b/", ""), (None, "", "plain &amp; text"),
        (4, "not a url", "<article><p>cut off &copy <b>here<br>and <script>x"), (5, "HTTP://Q.R:80/", "<a href='>'>link</a><p title=\">\">kept</p>"),
        (6, "http://long/", "<p>" + "long " * 50_000 + "</p>" * 1000), (7, "http://broken/", '<p class="never closed>x</p> tail'),
    ]
    done = template.extract_articles(spark.createDataFrame(rows, PAGE).withColumn("host", F.lit("mine")).withColumn("slots", F.lit(1)))
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in done.collect()]
    assert len(got) == len(rows)
    by_id = {i: t for i, _, t, _ in got}
    assert by_id[2] == by_id[3] == "" and by_id[None] == "plain & text" and by_id[4] == "cut off © here and"
    assert by_id[6] == ("long " * 50_000).strip() and by_id[1] == "no url" and "kept" in by_id[5]
    assert template.extract_articles(spark.createDataFrame([], PAGE)).count() == 0


def extracted(spark, pages):
    rows = [(i, f"http://site/{i}", page) for i, page in enumerate(pages)]
    return [r["text"] for r in template.extract_articles(spark.createDataFrame(rows, PAGE)).orderBy("page_id").collect()]


def prose(rng, n=20):
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(10_000)) for _ in range(n))


def test_per_page_ids_and_split_articles(spark):
    rng = random.Random(3)
    texts = [(prose(rng), prose(rng, 30)) for _ in range(10)]
    nav = "<ul><li><a href=/>home page</a></li><li><a href=/b>all posts</a></li></ul>"
    one = [f'<body>{nav}<div id="post-{i}" class="entry c{i}"><p>{a}</p><p>{b}</p></div></body>' for i, (a, b) in enumerate(texts)]
    assert extracted(spark, one) == [f"{a}\n{b}" for a, b in texts]
    for box in ('<div class="lead">{}</div><div class="body">{}</div>', '<section id="s1">{}</section><section id="s2">{}</section>'):
        assert extracted(spark, [f"<body>{nav}{box.format(a, b)}</body>" for a, b in texts]) == [f"{a}\n{b}" for a, b in texts]


def test_class_words_need_evidence(spark):
    rng = random.Random(4)
    texts = [[prose(rng, 8) for _ in range(6)] for _ in range(10)]
    related = '<div class="related-posts"><a href=/1>first other</a> <a href=/2>second other</a></div>'
    pages = [
        f'<body><div class="content has-sidebar"><article><div class="article-header"><h1>{a}</h1></div><p>{b}</p><section id="related-work"><p>{c}</p>'
        f'</section><div class="social-history">{d}</div>{related}<div class="post-comments">{e}</div></article>'
        f'<article class="comment">{f}</article><article class="teaser">{e}</article></div></body>'
        for a, b, c, d, e, f in texts
    ]
    assert extracted(spark, pages) == ["\n".join(t[:4]) for t in texts]
    # without article elements: the enclosing container stays, the marked one beside the text goes
    pages = [f'<body><div class="content has-sidebar"><div class="lead">{a}</div><div class="text">{b} {c}</div><div class="sidebar">{d}</div></div></body>' for a, b, c, d, *_ in texts]
    assert extracted(spark, pages) == [f"{a}\n{b} {c}" for a, b, c, *_ in texts]


def test_template_decides(spark, monkeypatch):
    rng = random.Random(6)
    texts = [prose(rng) for _ in range(12)]
    pages = [f"<body><div><p>Read all of our stories</p><p>Published {i}: {t}</p><p>Thanks for reading</p></div></body>" for i, t in enumerate(texts)]
    want = [f"Published {i}: {t}" for i, t in enumerate(texts)]
    assert extracted(spark, pages) == want
    found = template.pieces(pages[0])
    slots = frozenset(template._key(g, p) for g, p in template._gaps(found, frozenset()))
    whole = template.article_text(found, frozenset(), frozenset(), slots)
    assert whole == f"Read all of our stories\n{want[0]}\nThanks for reading"
    # copies of one page have no template
    assert extracted(spark, [pages[0]] * 9) == [whole] * 9


def test_template_decides_in_articles_too(spark):
    rng = random.Random(7)
    texts = [(prose(rng, 6), prose(rng), prose(rng)) for _ in range(12)]
    box = "<article><div class=lead><p>Read all of our stories</p></div><h1>{}</h1><p>{}</p><p>{}</p><p>Thanks for reading</p></article>"
    pages = [f"<body><nav><a href=/>home</a></nav>{box.format(*t)}</body>" for t in texts]
    assert extracted(spark, pages) == ["\n".join(t) for t in texts]
    # too few pages to tell a template: the article is whole
    assert extracted(spark, pages[:2]) == ["\n".join(["Read all of our stories", *t, "Thanks for reading"]) for t in texts[:2]]
    # one article on all pages but one is no template of the host's articles
    copies = [pages[0].replace("home", f"home {i}") for i in range(11)] + [pages[1]]
    assert extracted(spark, copies) == ["\n".join(texts[0])] * 11 + ["\n".join(texts[1])]


def plain_classes(pages):
    """Tokens of one host by their exact occurrence vectors, and which classes keep their order and one gap."""
    found = [template.pieces(page) for page in pages]
    counts = [dict.fromkeys((), 0) for _ in found]
    words = set()
    for count, page in zip(counts, found):
        tags = {t for _, t in template.tokens(page, with_words=False)}
        for _, t in template.tokens(page):
            count[t] = count.get(t, 0) + 1
            if t not in tags:
                words.add(t)
    every = {t for c in counts for t in c}
    vectors = {}
    for t in every:
        support = sum(t in c for c in counts)
        copies = {page for page, c in zip(pages, counts) if t in c}
        if t & 1 and any(c.get(t) != 1 for c in counts):
            continue
        if support >= template.LEAST_SHARE * len(pages) and (t not in words or len(pages) >= template.PAGES_FOR_WORDS and len(copies) > 1):
            vectors.setdefault(tuple(c.get(t, 0) for c in counts), set()).add(t)
    classes = {v: ts for v, ts in vectors.items() if len(ts) > 1}
    base = classes.get((1,) * len(pages), set())
    valid = {}
    for v, ts in classes.items():
        orders, gaps, whole = set(), set(), True
        for page in found:
            gap, order = 0, []
            for _, t in template.tokens(page):
                if t in ts:
                    order.append(t)
                    if ts is not base:
                        gaps.add(gap)
                gap += t in base
            if order:
                cycle = len(set(order))
                whole &= all(order[i] == order[i % cycle] for i in range(len(order)))
                orders.add(tuple(order[:cycle]))
        if whole and len(orders) == 1 and len(gaps) <= 1:
            valid[v] = ts
    return classes, valid


def test_classes_against_plain_deduction(spark, site):
    for host in ("one.example", "two.example"):
        rows = [r for r in site[0] if f"//{host}/" in r[1]]
        classes, valid = plain_classes([page for _, _, page in rows])
        named = spark.createDataFrame(rows, PAGE).select(F.lit(host).alias("host"), F.col("page_id").alias("row"), "html").repartition(3)
        got = template.occurrence_classes(named)
        as_sets = lambda df: {frozenset(r["tokens"]) for r in df.collect()}
        assert as_sets(got) == {frozenset(t) for t in classes.values()} and len(classes) > 2
        assert as_sets(template.valid_classes(named, got)) == {frozenset(t) for t in valid.values()}


def test_hot_host(spark):
    """A third of all pages and more are one host's, with lists that are long beside its pages."""
    rng = random.Random(9)
    items = "".join(f"<li class=i{i}>item number {i}</li>" for i in range(300))
    texts = [prose(rng) for _ in range(300)]
    pages = [(i, f"http://{'hot' if i % 3 else f'h{i}'}/{i}", f"<body><ul>{items}</ul><article><p>{t}</p></article></body>") for i, t in enumerate(texts)]
    got = template.extract_articles(spark.createDataFrame(pages, PAGE).repartition(6)).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict(enumerate(texts))
