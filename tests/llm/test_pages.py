"""Deep pages, and hosts with several layouts."""

import random

from tillweave.llm import extract

PAGE = "page_id long, url string, html string"


def texts(spark, data):
    return {r["page_id"]: r["text"] for r in extract.main_text(spark.createDataFrame(data, PAGE).repartition(3)).collect()}


def test_text_after_deep_elements(spark):
    """End tags of elements below any depth close those elements only; regions far down are still no article."""
    page = lambda n: f"<body><div><article><p>start</p>{'<div>' * n}core<nav>menu</nav>{'</div>' * n}<p>rest</p></article></div><div>footer</div>"
    got = texts(spark, [(n, f"http://{n}.example/", page(n)) for n in (3, 190, 250, 6000)] + [(k, "http://same.example/", page(300 + k)) for k in (1, 2)])
    assert set(got.values()) == {"start\ncore\nrest"} and len(got) == 6
    # unclosed and unmatched tags in great number
    assert texts(spark, [(1, "http://a.example/", "<article>" + "<b>" * 20_000 + "</i>" * 20_000 + "x</article>")]) == {1: "x"}


MARKED = "<body><div class=top>Site name</div><article><h1>Title {0}</h1><p>Marked text {0} of the story.</p></article><div class=foot>All rights</div></body>"
POST = "<body><div class=top>Site name</div><div class=post><h2>Post {0}</h2><p>Plain text {0} that is the story here.</p></div><div class=foot>All rights</div></body>"
ENTRY = "<body><div class=top>Site name</div><div class=entry><h2>Entry {0}</h2><p>Other text {0} that is a story too.</p></div><div class=foot>All rights</div></body>"
WANT = {MARKED: "Title {0}\nMarked text {0} of the story.", POST: "Post {0}\nPlain text {0} that is the story here.",
        ENTRY: "Entry {0}\nOther text {0} that is a story too."}


def test_layouts_of_a_host(spark):
    """Each layout gives its own article, whether it is common or rare, marked or not."""
    hosts = {"marked": [(MARKED, 12), (POST, 5)], "one": [(MARKED, 12), (POST, 1)], "rare": [(POST, 20), (ENTRY, 2)], "even": [(POST, 6), (ENTRY, 6)],
             "three": [(MARKED, 9), (POST, 9), (ENTRY, 3)]}
    data, want = [], {}
    for host, kinds in hosts.items():
        for kind, n in kinds:
            for _ in range(n):
                k = len(data)
                data.append((k, f"http://{host}.example/{k}", kind.format(k)))
                want[k] = WANT[kind].format(k)
    assert texts(spark, data) == want


def test_layouts_without_a_host(spark):
    """Null and odd urls share a host; none of their pages comes out empty for the layout of others."""
    kinds = [MARKED] * 9 + [POST] * 9 + [ENTRY] * 3
    got = texts(spark, [(k, ["nonsense", None, ""][k % 3], kind.format(k)) for k, kind in enumerate(kinds)])
    assert got == {k: WANT[kind].format(k) for k, kind in enumerate(kinds)}


def test_constant_blocks_among_paragraphs(spark):
    """Lines that stand on all pages of a host are template, also where their markup is that of the story; the same lines on a few pages stay."""
    line = "<p>Subscribe to our letter now</p>"
    marked = "<body><article><h1>Title {0}</h1><p>Story {0} begins.</p>" + line + "<p>It goes on {0}.</p><p>All rights reserved</p></article></body>"
    plain = marked.replace("article", "div")
    data, want = [], {}
    for host, kind, n in (("many", marked, 30), ("plain", plain, 30), ("few", marked, 5)):
        for _ in range(n):
            k = len(data)
            data.append((k, f"http://{host}.example/{k}", kind.format(k)))
            want[k] = f"Title {k}\nStory {k} begins.\n" + ("Subscribe to our letter now\n" if n == 5 else "") + f"It goes on {k}." + ("\nAll rights reserved" if n == 5 else "")
    # a line on half of the pages is the article's own, however often it stands there
    for k in range(100, 140):
        data.append((k, "http://half.example/", f"<article><p>Story {k}.</p>{line if k % 2 else ''}<p>End {k}.</p></article>"))
        want[k] = f"Story {k}.\n" + ("Subscribe to our letter now\n" if k % 2 else "") + f"End {k}."
    assert texts(spark, data) == want


def irregular(r, k):
    """A page without a landmark: some of several regions in any order, several times, with constant and varying text."""
    tags = ["div class=a", "div class=b", "section", "p", "ul", "div"]
    body = ""
    for _ in range(r.randint(2, 8)):
        tag = r.choice(tags)
        inner = "".join(f"<p>{r.choice(['Always this', f'text {k} {r.randint(0, 99)} of the page'])}</p>" for _ in range(r.randint(1, 3)))
        body += f"<{tag}>{inner}</{tag.split()[0]}>"
    return f"<body><div class=top>Site</div>{body}<div class=foot>All rights</div></body>"


def test_any_order_and_partitions(spark):
    """The wrappers of a host do not depend on the order of its pages nor on the tasks that read them."""
    r = random.Random(5)
    data = [(k, f"http://h{k % 40}.example/{k}", irregular(r, k)) for k in range(400)]
    one = spark.createDataFrame(data, PAGE).coalesce(1)
    turned = spark.createDataFrame(data[::-1], PAGE).repartition(37)
    read = lambda df: {x["page_id"]: x["text"] for x in extract.main_text(df).collect()}
    assert read(one) == read(turned)


def test_generated_labels(spark):
    """Rules of a host do not grow with labels that each page makes up for itself."""
    letters = lambda k: "".join(chr(97 + int(c)) for c in str(k + 1000))
    size = {}
    for n in (50, 400):
        data = [(k, "http://g.example/", f"<body><article><h1>T {k}</h1><div class=x{letters(k)}><p>Story {k}</p></div><div class=y{letters(k)}>more {k}</div></article></body>")
                for k in range(n)]
        size[n] = extract.induce(spark.createDataFrame(data, PAGE)).selectExpr("length(rules)").first()[0]
        assert texts(spark, data) == {k: f"T {k}\nStory {k}\nmore {k}" for k in range(n)}
    assert size[400] < 1.2 * size[50]
