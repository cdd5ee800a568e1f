"""Main text and URL verdicts."""

import pytest

from rillflow.llm import htmlblocks, urls


@pytest.fixture(scope="module")
def tree():
    return htmlblocks.Tree.train(*htmlblocks.labelled_blocks())


LONG = "All the long winter the lake was frozen and the boats lay in their sheds by the shore."


def test_labelled_table_is_learned(tree):
    rows, labels = htmlblocks.labelled_blocks()
    assert ((tree.scores(rows) >= 0.5) == (labels > 0.5)).mean() == 1.0


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<html><body></body></html>", ""),
    (f"<nav><a href='/'>Home</a></nav><article><h1>Ice &amp; snow</h1><p>{LONG}</p><p>Cold.</p>",
     f"Ice & snow\n\n{LONG}\n\nCold."),
    (f"<article><p>a&lt;b&#39;s\n\t x&nbsp;y</p><script>var t='</p>';</script><p><b>{LONG}<br><p>"
     f"in<i>line</i></p></article><footer>&copy; us</footer>",
     f"a<b's x y\n\n{LONG}\n\ninline"),
    (f"<article><p>{LONG}</p><div class='ad'>{LONG} {LONG}</div><p>Short.</p></article>"
     f"<section id='comments'><p>{LONG}</p></section>", f"{LONG}\n\nShort."),
    (f"<!-- <p>no</p> --><main><p>{LONG}</p><aside>{LONG}</aside><form>{LONG}</form></main>", LONG),
    (f"<article><p title='a > b' class=\"x\">{LONG}</p><p>1 < 2 and 3 > 2</p></article>",
     f"{LONG}\n\n1 < 2 and 3 > 2"),
    (f"<header><p>{LONG}</p></header><article><p>{LONG}</p></article", LONG),
    ("<article><p>" + "word " * 50_000 + "</p></article>", " ".join(["word"] * 50_000)),
])
def test_main_text(tree, page, text):
    assert htmlblocks.main_text(page, tree)[0] == text


def test_extract_keeps_every_row(spark):
    rows = [(1, None, None, 1), (None, "u", f"<article><p>{LONG}</p></article>", 2), (1, None, None, 3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    out = htmlblocks.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in out) == sorted(
        [(1, None, "", 0), (1, None, "", 0), (0, "u", LONG, len(LONG))], key=str
    )
    assert htmlblocks.extract(pages.limit(0)).count() == 0


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host.translate(lower), path


def rule_for(host, path):
    best = None
    for verdict, rule in urls.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


URLS = [
    None, "", "no-scheme.net/en/", "http://", "HTTP://WWW.Example.NET/en/1?x=1#y", "https://a.net",
    "https://net/", "https://xnet/", "ftp://u.example.com/de/2", "http://example.com/DE/2",
    "http://m.org/fr/?a=b", "http://m.org?fr/", "http://m.org#/fr/", "http://a.b/c://d.net/",
    "https://ÄÖ.example.com/de/é?ü", "http://example.com/de", "x://y//z?q?r#s#t",
]


@pytest.fixture(scope="module")
def model(spark):
    return urls.UrlModel.train(urls.labelled_urls(spark))


def test_hosts_paths_and_rules(spark, model):
    rows = [(i, u, "x", 1.0) for i, u in enumerate(URLS)] + [(0, None, "y", 2.0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, _rule double")
    out = urls.judge(pages, model, urls.RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path = split_url(URLS[r["page_id"]])
        rule = rule_for(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule[1] if rule else None)
        assert r["verdict"] == (rule[0] if rule else r["verdict"])
        assert r["verdict"] in ("allow", "block") and 0 <= r["url_score"] <= 1
    assert urls.judge(pages.limit(0), model, urls.RULES).count() == 0


def scores(spark, model, found):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(found)], "page_id int, url string")
    out = {r["page_id"]: r["url_score"] for r in urls.judge(pages, model, []).collect()}
    return [out[i] for i in range(len(found))]


def test_trees_judge_unseen_urls(spark, model):
    good = [
        "https://www.valley.example.com/en/8", "http://birds.example.org/es/77.html",
        "https://www.long-running-society.example.org/en/5", "http://abc.example.com/docs/tool.pdf",
    ]
    bad = [
        "http://friendly.top/en/4", "http://abc.example.com/dl/tool.exe",  # suffix of host, of path
        "http://z9x8c7v6b5.example.org/en/1",  # digits and entropy of the host
        "https://www.gallery.example.net/sale?aff=1&sub=2&c=3&d=4&e=5",  # parameters
    ]
    out = scores(spark, model, good + bad)
    assert all(x < 0.5 for x in out[:4]) and all(x > 0.5 for x in out[4:])


def test_trees_use_many_features(model):
    shares = sorted(model.trees.featureImportances.toArray(), reverse=True)
    assert shares[0] < 0.5 and sum(x > 0.04 for x in shares) >= 5


def test_held_out_hosts_and_paths(spark):
    """URLs whose host and path are both unseen."""
    from pyspark.sql import functions as F

    table = urls.labelled_urls(spark)
    host, path = (F.pmod(F.xxhash64(c), F.lit(4)) == 0 for c in ("host", "path"))
    held = table.where(host & path).select("url", "label").collect()
    learned = urls.UrlModel.train(table.where(~host & ~path))
    out = scores(spark, learned, [r["url"] for r in held])
    right = sum((x >= 0.5) == (r["label"] == 1) for x, r in zip(out, held))
    assert len(held) > 40 and right >= 0.8 * len(held)


def words(n, seed=0):
    return " ".join(f"w{seed}x{i}" for i in range(n))


BARE_PAGES = {
    "paragraphs": (f"<p>{words(40)}</p><p>{words(70)}</p>", [words(40), words(70)]),
    "post": (f"<div class='post'><p>{words(60)}</p><p>{words(13)}</p><p>{words(80)}</p></div>",
             [words(60), words(13), words(80)]),
    "with-sidebar": (
        "<div class='page with-sidebar'><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul>"
        f"<p>{words(50)}</p><p>{words(33)}</p></div>", [words(50), words(33)]),
    "legal-news": (f"<section id='legal-news'><h1>Judge rules</h1><p>{words(35)}</p><p>{words(66)}</p></section>",
                   ["Judge rules", words(35), words(66)]),
    "social-policy": (f"<div class='post social-policy'><p>{words(35)}</p><p>{words(66)}</p></div>",
                      [words(35), words(66)]),
    "form around all": (
        f"<form><nav><a href=1>a</a></nav><h1>Title of it</h1><p>{words(35)}</p><p>{words(66)}</p></form>",
        ["Title of it", words(35), words(66)]),
    "article-header": (
        f"<article><div class='article-header'><h1>Headline here</h1></div><p>{words(35)}</p></article>",
        ["Headline here", words(35)]),
    "sidebar beside": (
        f"<div><p>{words(35)}</p><p>{words(66)}</p><p>{words(50)}</p></div><div class='sidebar'><p>{words(30, 1)}</p></div>",
        [words(35), words(66), words(50)]),
    "links only": ("<ul><li><a href=1>One two</a></li><li><a href=2>Three</a></li></ul>", []),
}


@pytest.mark.parametrize("name", BARE_PAGES)
def test_pages_without_an_article_element(name):
    tree = htmlblocks.Tree.train(*htmlblocks.labelled_blocks())
    page, kept = BARE_PAGES[name]
    assert htmlblocks.main_text(page, tree)[0] == "\n\n".join(kept)


def test_the_tree_splits_on_words_and_links():
    used = set()

    def walk(tree):
        if tree.feature >= 0:
            used.add(htmlblocks.FEATURES[tree.feature])
            walk(tree.low)
            walk(tree.high)

    walk(htmlblocks.Tree.train(*htmlblocks.labelled_blocks()))
    assert {"words", "link_density", "words_before", "words_after", "density_before"} <= used
