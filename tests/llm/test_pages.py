import random

import pytest
from pyspark.sql import functions as F

from coursepulse.llm import queries, urls, wrappers
from coursepulse.llm.wrappers import Wrapper, fold, page_nodes, tokens

TEMPLATE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='</p><article>';</script></head><body>"
    "<header>Site {n}</header><nav><ul>{menu}</ul></nav>{notice}<article id=post-{n}><h1>Head {n}</h1>"
    "{body}<form><label>Mail</label></form><div class='share-bar'>Share</div></article>"
    "<aside>Side {n}</aside><section class=comments><p>First!</p></section>"
    "<footer>Foot</footer></body></html>")


def _page(n, paragraphs, links=3, notice=""):
    return TEMPLATE.format(
        n=n, menu="".join(f"<li><a href=/{i}>L{i}</a></li>" for i in range(links)), notice=notice,
        body="".join(f"<p>{text}</p>" for text in paragraphs))


def _want(n, paragraphs):
    return " ".join([f"Head {n}", *paragraphs])


PAGES = [_page(1, ["one two", "three"], 3), _page(2, ["four"], 2),
         _page(3, ["five", "six", "seven"], 5, "<div class=cookie-notice>We use cookies</div>")]


def test_infers_slots_repeats_and_optionals():
    found = Wrapper.infer(PAGES)
    pattern = found.pattern()
    assert "( <li> <a> #PCDATA </a> </li> )+" in pattern
    assert "( <p> #PCDATA </p> )+" in pattern
    assert "( <div cookie-notice> )? ( 'We use cookies' )? ( </div> )?" in pattern
    assert "<footer> 'Foot' </footer>" in pattern  # a fixed text
    assert "<h1> #PCDATA </h1>" in pattern
    assert found.holder == "<article post-0>"


@pytest.mark.parametrize("given", [PAGES, PAGES[:1], PAGES[1:] + PAGES[:1]])
def test_extracts_the_article(given):
    found = Wrapper.infer(given)
    assert found.extract(PAGES[0]) == _want(1, ["one two", "three"])
    assert found.extract(PAGES[2]) == _want(3, ["five", "six", "seven"])
    unseen = _page(9, ["a &amp; b\n\t c", "x<b>y</b>z<br>w", "<!-- no -->"], 1,
                   "<div class=ad>Buy</div>")
    assert found.extract(unseen) == "Head 9 a & b c xyz w"
    cut = unseen[: unseen.index("x<b>y") + 3]
    assert found.extract(cut) == "Head 9 a & b c x"


def test_without_an_article_element():
    page = ("<body><div id=top><a>{n}</a><a>Home</a></div><div class=content><p>A long first text "
            "here {n}</p><p>And more</p></div><div id=comments><p>Nope</p></div></body>")
    found = Wrapper.infer([page.format(n=1), page.format(n=2)])
    assert found.extract(page.format(n=7)) == "A long first text here 7 And more"


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!--", "<script>x", "a < b", "</p></p>",
                                  "<p title='x", "&#0;&bogus;", "<p>" * 3000, "x" * 200_000,
                                  "<p>t</p>" * 5000])
def test_odd_markup_does_not_fail(page):
    for found in (Wrapper.infer([page]), Wrapper.infer(PAGES), Wrapper([], None)):
        assert isinstance(found.extract(page), str)


@pytest.mark.parametrize("other", ["article class='post featured'", "div class=story"])
@pytest.mark.parametrize("sampled", [0, 1, 2])
def test_hosts_with_two_templates(other, sampled):
    """Pages of the template that doesn't have the wrapper's holder keep their article."""
    def second(n, paragraphs):
        return _page(n, paragraphs).replace(f"article id=post-{n}", other).replace(
            "</article><aside>", f"</{other.split()[0]}><aside>")

    given = [second(n, ["long first text", f"more {n}"]) for n in range(sampled)]
    found = Wrapper.infer(PAGES + given)
    assert found.extract(PAGES[0]) == _want(1, ["one two", "three"])
    assert found.extract(second(7, ["a text of its own", "two"])) == _want(
        7, ["a text of its own", "two"])


@pytest.mark.parametrize("element", ["article", "div class=story"])
def test_article_behind_a_long_list(element):
    """More tokens than are aligned come before the article."""
    links = "".join(f"<li><a href=/{n}>L{n}</a></li>" for n in range(1400))
    page = ("<body><div class=top><ul>" + links + "</ul></div><" + element + "><p>Long text {n} "
            + "of the article " * 1000 + "</p></" + element.split()[0] + "></body>")
    found = Wrapper.infer([page.format(n=1), page.format(n=2)])
    assert found.extract(page.format(n=3)) == "Long text 3 " + " ".join(["of the article"] * 1000)


def test_whole_long_article():
    paragraphs = [f"word{n} and more" for n in range(5000)]
    page = _page(4, paragraphs)
    assert Wrapper.infer(PAGES).extract(page) == _want(4, paragraphs)


NEUTRAL = ("<html><body><div class=cell><a href=/a>Start</a> <a href=/b>World news</a></div>"
           "<div class=wrap><h1>Title {n}</h1>{body}<div class=legal>Copyright 2020, see the imprint.</div>"
           "</div><div class=cell2><ul><li><a href=/1>More</a></li><li><a href=/2>Less {n}</a></li></ul></div>"
           "</body></html>")


def _neutral(n):
    return NEUTRAL.format(n=n, body="".join(
        f"<p>Paragraph {n}-{i} " + "some words of it " * (n + i + 1) + "</p>" for i in range(n % 3 + 1)))


def test_the_template_is_what_pages_have_in_common():
    """Menus and notices of no telling class go by the wrapper; without its nodes they stay."""
    found = Wrapper.infer([_neutral(n) for n in range(6)])
    assert "'Copyright 2020, see the imprint.'" in found.pattern()
    for n in (0, 3, 20):
        text = found.extract(_neutral(n))
        assert text.startswith(f"Title {n} Paragraph {n}-0 some words")
        assert not any(word in text for word in ("Start", "World news", "Copyright", "More", "Less"))
    emptied = Wrapper([], found.holder)
    assert "Copyright" in emptied.extract(_neutral(3))
    assert Wrapper.infer([_neutral(1)]).extract(_neutral(1)).count("Paragraph") == 2  # nothing to compare


@pytest.mark.parametrize("name", ["ad-hoc", "search-results", "social-history", "related-work",
                                  "share-price", "notice-period", "reply"])
def test_class_names_count_as_a_whole(name):
    pages = [_page(n, [f"first {n}", f"second {n}"]).replace("<p>", f"<p class={name}>", 1)
             for n in range(5)]
    found = Wrapper.infer(pages)
    assert found.extract(pages[2]) == "Head 2 first 2 second 2"
    alone = Wrapper.infer(pages[:1])
    assert alone.extract(pages[0]) == "Head 0 first 0 second 0"


def test_notices_inside_an_article_element():
    pages = [f"<article><h1>T{n}</h1><p>Words of {n} {'and so on ' * 9}</p><div class=x7>Read our letter"
             f"</div><p>The end of {n}</p></article>" for n in range(4)]
    found = Wrapper.infer(pages)
    assert all("letter" not in found.extract(page) and f"The end of {n}" in found.extract(page)
               for n, page in enumerate(pages))


@pytest.mark.parametrize("others", [0, 1, 3])
def test_copies_of_an_article_keep_their_text(others):
    """What is the same because pages are copies of each other is no template."""
    copy = _page(1, ["The very same", "on many pages of the host"])
    pages = [copy.replace("Site 1", f"Site {n}") for n in range(5)]
    pages += [_page(9 + n, [f"text {n}", f"other {n}"]) for n in range(others)]
    found = Wrapper.infer(pages)
    assert found.extract(copy) == "Head 1 The very same on many pages of the host"


def test_long_lists_are_matched_between_what_stands_once():
    rng = random.Random(5)
    for size in (10, 400):
        a = [rng.choice("abcdefgh") for _ in range(size)] + ["X"] + [rng.choice("abc") for _ in range(size)]
        b = a[:3] + ["new"] + a[5:]
        for limit in (3000, 20, 1):
            wrappers.ALIGNED, before = limit, wrappers.ALIGNED
            try:
                runs = wrappers.matching(a, b)
            finally:
                wrappers.ALIGNED = before
            assert all(a[x : x + n] == b[y : y + n] for x, y, n in runs)
            assert all(x + n <= u and y + n <= v for (x, y, n), (u, v, _) in zip(runs, runs[1:]))
            assert ("X" in [a[x] for x, _, n in runs for x in range(x, x + n)])


def test_fold_keeps_every_token():
    found = tokens(PAGES[2])
    nodes = fold(page_nodes(found))
    places = sorted(p for node in wrappers._leaves(nodes) for _, p in node.places)
    assert places == list(range(len(found)))


def test_main_text_of_odd_rows(spark):
    rows = spark.createDataFrame(
        [(n, f"http://h.org/{n}", PAGES[n % 3], "w") for n in range(9)]
        + [(20, None, PAGES[0], None), (21, "http://h.org/x", None, None), (22, "http://new.org/", "", ""),
           (None, "http://h.org/", PAGES[1], ""), (3, "http://h.org/3", PAGES[0], "")],
        "page_id long, url string, html string, wrapper string")
    found = wrappers.main_text(rows).collect()
    assert len(found) == 14
    by_id = {r["page_id"]: r for r in found}
    assert by_id[0]["text"] == by_id[20]["text"] == _want(1, ["one two", "three"])
    assert by_id[None]["text"] == _want(2, ["four"])
    assert by_id[21]["text"] == by_id[22]["text"] == "" and by_id[21]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert wrappers.main_text(rows.filter(F.lit(False))).collect() == []


def test_main_text_of_all_pages_is_the_article(spark, sf_dir):
    import html
    import re

    def plain(page):  # the tables' pages have one article each
        body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
        body = re.sub(r"</?b>", "", body)
        return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())

    given = {r["page_id"]: r["html"] for r in queries.read(spark, sf_dir, "pages").collect()}
    found = queries.op3_main_text(spark, sf_dir).collect()
    assert {r["page_id"]: r["text"] for r in found} == {k: plain(v) for k, v in given.items()}


def _table(spark, pages, host="h.org"):
    return spark.createDataFrame([(n, f"http://{host}/{n}", page) for n, page in enumerate(pages)],
                                 "page_id long, url string, html string")


def _hashed_first(spark, number, of):
    """The ids that a hash orders first: no choice of pages may stand for the others."""
    rows = spark.range(of).orderBy(F.xxhash64("id"), "id").limit(number).collect()
    return {row["id"] for row in rows}


def test_all_pages_of_a_host_count(spark):
    """Six pages agree on a paragraph, and differ in a notice, unlike the host's other pages."""
    odd = _hashed_first(spark, 6, 100)

    def page(n):
        text = "The mayor spoke at length" if n in odd else f"Somebody spoke {n} {'at length ' * 4}"
        note = f"Written by {n}" if n in odd else "Read our letter every week"
        return (f"<body><div class=cell><a href=/>Start</a></div><div class=wrap><h1>Title {n}</h1><p>{text}"
                f"</p><div class=x7>{note}</div><ul><li>Point of {n}</li></ul></div></body>")

    pages = [page(n) for n in range(100)]
    found = {r["page_id"]: r["text"] for r in wrappers.main_text(_table(spark, pages)).collect()}
    for n, text in found.items():
        assert ("The mayor spoke" if n in odd else f"Somebody spoke {n}") in text
        assert f"Title {n}" in text and f"Point of {n}" in text
        assert "letter" not in text and "Start" not in text


@pytest.mark.parametrize("parts", [64, 3])
def test_wrappers_of_a_table_are_those_of_the_pages(spark, monkeypatch, parts):
    """One round of aligning, or several; each host for itself."""
    monkeypatch.setattr(wrappers, "PARTS", parts)
    rng = random.Random(7)

    def page(n, kind):
        blocks = [rng.choice(("<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</li><li>x</li></ul>",
                              "<table><tr><td>{}</td></tr></table>")).format(f"block {n} {i} of text")
                  for i in range(rng.randrange(1, 7))]
        return _neutral(n).replace("<h1>", f"<{kind}>").replace("</h1>", f"</{kind}>" + "".join(blocks))

    hosts = {"a.org": [page(n, "h1") for n in range(30)], "b.org": [page(n, "h3") for n in range(12)],
             "c.org": [_page(n, [f"one {n}", f"two {n}"]) for n in range(5)], "d.org": [_neutral(1)],
             "e.org": [""]}
    given = [(n, f"http://{host}/{n}", page) for host, pages in hosts.items()
             for n, page in enumerate(pages)]
    rows = spark.createDataFrame(given + given[:20], "page_id long, url string, html string")
    found = {r["host"]: wrappers.pickle.loads(r["wrapper"]) for r in wrappers.infer_wrappers(rows).collect()}
    assert found.keys() == hosts.keys()
    for host, pages in hosts.items():
        alone = Wrapper.infer(pages)
        assert found[host].holder == alone.holder
        assert [found[host].extract(page) for page in pages] == [alone.extract(page) for page in pages]
        if parts == 64:
            assert found[host].slots == alone.slots
            assert [node.key for node in found[host].nodes] == [node.key for node in alone.nodes]
    assert any(slot.fixed for slot in found["a.org"].slots.values())
    assert all("Copyright" not in found["a.org"].extract(page) for page in hosts["a.org"])


def test_copies_of_a_page_count_once(spark):
    """Their text isn't the template, though most pages of the host have it."""
    pages = [_neutral(1)] * 60 + [_neutral(n) for n in range(2, 9)]
    found = {r["page_id"]: r["text"] for r in wrappers.main_text(_table(spark, pages)).collect()}
    assert len(found) == 67
    for n in range(60):
        assert found[n].startswith("Title 1 Paragraph 1-0 some words") and "Copyright" not in found[n]
    for n in range(2, 9):
        assert found[58 + n].startswith(f"Title {n} Paragraph {n}-0") and "World" not in found[58 + n]


def test_partitions_without_pages(spark):
    rows = spark.createDataFrame(spark.sparkContext.parallelize(
        [(n, "http://h.org/", page) for n, page in enumerate(PAGES)], 20),
        "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in wrappers.main_text(rows).collect()}
    assert found == {0: _want(1, ["one two", "three"]), 1: _want(2, ["four"]),
                     2: _want(3, ["five", "six", "seven"])}


def test_what_few_pages_have_is_no_part_of_the_wrapper():
    pages = [_neutral(n).replace("<h1>", f"<h6 class=c{'abcdefghij'[n % 10] * (n // 10 + 1)}>x</h6><h1>")
             for n in range(100)]
    found = Wrapper.infer(pages)
    assert len(found.nodes) < 2 * len(fold(page_nodes(tokens(pages[0]))))
    for n in (0, 57, 99):
        text = found.extract(pages[n])
        assert f"Title {n}" in text and f"Paragraph {n}-0" in text and "Copyright" not in text


# --- URLs -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return urls.fit_urls(spark)


CASES = {
    "http://A.Example.COM/en/1?q=/x": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "https://www.example.com/en/x#y": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "http://x.www.example.com/en/": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://example.com/en": ("example.com", "/en", "com/", "allow"),
    "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
    "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
    "http://a.net/fr/": ("a.net", "/fr/", "net/fr/", "block"),
    "http://a.com": ("a.com", "", None, None),  # no path, so no rule starts it
    "http://a.com?x=http://b.net/es/": ("a.com", "", None, None),
    "ftp://com/": ("com", "/", "com/", "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"),
    "://net/es/": ("net", "/es/", "net/es/", "block"),
    "http://ÄB.NET/ES/": ("Äb.net", "/ES/", None, None),
    "a\nb://h.com/\nz": ("h.com", "/\nz", "com/", "allow"),
}


def test_rules_and_parts(spark, model):
    rows = list(enumerate(CASES)) + [(99, None), (99, None), (None, "http://a.net/es/")]
    given = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("?"))
    found = urls.judge(given, queries.URL_RULES, model).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    for at, (host, path, rule, verdict) in enumerate(CASES.values()):
        row = by_id[at]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == verdict if verdict else row["verdict"] in ("allow", "block")
    assert (by_id[99]["host"], by_id[99]["path"], by_id[99]["rule"]) == ("", "", None)
    assert by_id[None]["verdict"] == "block"


def test_regression_tells_hosts_apart(spark, model):
    rows = [(1, "http://www.casino-win.example.org/en/4"), (2, "http://m.cheap-pills.example.net/de/"),
            (3, "http://therin.example.org/en/770"), (4, "https://blog.tionsh.example.net/en/7")]
    found = {r["page_id"]: r["verdict"] for r in urls.judge(
        spark.createDataFrame(rows, "page_id long, url string"), queries.URL_RULES, model).collect()}
    assert found == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_regression_is_the_logistic_of_hashed_grams(spark, model):
    import math

    row = urls._ngrams(spark.createDataFrame([("a.org", "/x")], "host string, path string"))
    hashed = model.stages[0].transform(row).first()["features"]
    fitted = model.stages[1]
    raw = fitted.intercept + sum(fitted.coefficients[int(i)] for i in hashed.indices)
    score = urls.judge(spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string"),
                       [], model).first()["score"]
    assert math.isclose(score, 1 / (1 + math.exp(-raw)), rel_tol=1e-9)


def test_empty_pages(spark, model):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none, queries.URL_RULES, model).collect() == []


def test_blocked_words_count_in_paths(spark, model):
    cases = {
        "https://www.river.example.org/casino/free-poker-slots-bonus.html": "block",
        "https://www.forest.example.org/porn/xxx-sex-cams": "block",
        "https://www.tovima.org/viagra/cheap-pills": "block",
        "https://www.poker.example.org/en/12.html": "block",
        "https://www.river.example.org/history/bridge-museum-poetry.html": "allow",
        "https://en.wikipedia.org/wiki/Photosynthesis": "allow",
        "https://www.bbc.co.uk/news/world-europe-1234": "allow",
        "https://thereon.example.org/en/12.html": "allow",
    }
    rows = list(enumerate(cases))
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), [], model).collect()
    assert {rows[r["page_id"]][1]: r["verdict"] for r in found} == cases


def test_paths_and_hosts_vary_by_themselves(spark):
    """The table has every combination of a kind of host and a kind of path."""
    table = urls.labelled_urls(spark).toPandas()
    bad = table["host"].str.contains("|".join(urls.BLOCKED_WORDS))
    wrong = table["path"].str.contains("|".join(urls.BLOCKED_WORDS))
    assert ((bad | wrong) | (table["label"] == 0)).all()
    for host in (True, False):
        for path in (True, False):
            assert ((bad == host) & (wrong == path)).sum() > 80
