"""Operators 5, 6, 8, 9, 10 and the pipeline."""

import html
import random
import re
import textwrap
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retentio.llm import (decontaminate, html_extract, language_id, license_scan, simhash,
                          url_filter)

from .conftest import SF
from .test_dedup import brute_components, brute_lines, brute_print


# -- operator 5 ------------------------------------------------------------
@pytest.fixture(scope="module")
def licences(spark):
    return license_scan.fit(spark)


def test_licence_lines_are_found(docs, licences):
    rows = [(1, "Some words here.\nReleased under the MIT License.\nand so on"),
            (2, "Licensed under the Apache License, Version 2.0."),
            (3, "This work is licensed under the GNU General Public License, version 2."),
            (4, "x\n\nLicensed under CC BY-NC 3.0."), (5, None), (6, ""), (7, "\n \n"),
            (8, "She had not expected an answer so soon, and read the letter twice."),
            (9, "word " * 30000), (2, "Licensed under the Apache License, Version 2.0."),
            (None, "MIT License"),
            (10, "Licensed under the terms of the secret house agreement, all rights reserved.")]
    got = license_scan.scan(docs(rows), licences).collect()
    found = {(r["doc_id"], r["line"]): r["family"] for r in got}
    assert len(found) == len(got)
    known = {k: v for k, v in found.items() if v != "unknown"}
    assert known == {(1, 1): "mit", (2, 0): "apache", (3, 0): "gpl", (4, 2): "cc",
                     (None, 0): "mit"}
    assert found.get((10, 0), "unknown") == "unknown"
    assert not any(k[0] in (8, 9) for k in found)
    assert license_scan.scan(docs([]), licences).count() == 0


def wrapped(text, width, lead=""):
    return "\n".join(lead + x for x in textwrap.wrap(text, width))


def test_wrapped_licence_texts_are_found(docs, licences):
    from retentio.llm.license_examples import EXAMPLES
    long = {f: max(EXAMPLES[f], key=len) for f in ("mit", "apache", "bsd", "gpl") if f in EXAMPLES}
    prose = "She had not expected an answer so soon, and read the letter twice."
    rows, want = [], {}
    for i, (family, text) in enumerate(long.items()):
        for j, (width, lead) in enumerate(((72, ""), (60, " * "), (50, "# "))):
            body = wrapped(text, width, lead)
            rows.append((10 * i + j, f"{prose}\n\n{body}\n\n{prose}\n{prose}"))
            want[10 * i + j] = (family, 2, 1 + len(body.split("\n")))
    got = license_scan.scan(docs(rows + [(99, f"{prose}\n{prose}\n{prose}")]), licences).collect()
    known = {r["doc_id"]: (r["family"], r["line"], r["last_line"]) for r in got if r["family"] != "unknown"}
    assert known == want
    assert len([r for r in got if r["family"] != "unknown"]) == len(want)


def brute_score(model, text):
    """Family and probability by hand, from the fitted numbers."""
    import math
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    grams = spark.createDataFrame([(text,)], "t string").select(
        license_scan._grams(license_scan.words(F.col("t")))).first()[0]
    place = {g: i for i, g in enumerate(model.vectors.vocabulary)}
    at = [place[str(g)] for g in grams if str(g) in place]
    w, b = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray()
    z = [math.exp(b[c] + sum(w[c][i] for i in at)) for c in range(len(model.classes))]
    best = max(range(len(z)), key=lambda c: (z[c], model.classes[c]))
    return model.classes[best], z[best] / sum(z)


def test_scores_equal_a_computation_by_hand(docs, licences):
    texts = ["Released under the MIT License.", "Licensed under CC BY-NC 3.0 by the house.",
             "GNU General Public License, some version", "the software is provided by us"]
    got = {r["doc_id"]: r for r in license_scan.scan(docs(list(enumerate(texts))), licences).collect()}
    for i, text in enumerate(texts):
        family, p = brute_score(licences, text)
        if family == "none":
            assert i not in got
        else:
            assert got[i]["probability"] == pytest.approx(p)
            assert got[i]["family"] in (family, "unknown")
    assert 0 < licences.threshold < 1


def test_every_planted_licence_line(spark, licences):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {(r["doc_id"], i) for r in rows.collect() for i, x in enumerate(r["text"].split("\n"))
            if re.search(r"[Ll]icense", x)}
    got = license_scan.scan(rows, licences).filter("family != 'unknown'").collect()
    assert {(r["doc_id"], r["line"]) for r in got} == want and len(want) > 20


# -- operator 6 ------------------------------------------------------------
def test_held_out_accuracy_and_edges(spark, docs):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(rows)
    out = language_id.identify(rows, model).filter(
        language_id.held_out(rows["doc_id"])).filter("length(text) >= 200").collect()
    right = sum(r["lang"] == r["language"]["lang_pred"] for r in out)
    assert len(out) > 100 and right >= 0.98 * len(out)
    edge = language_id.identify(docs([(1, None), (2, ""), (3, "12 !?"), (4, "é"), (None, "the"),
                                      (5, "the and of " * 50000)]), model).collect()
    got = {r["doc_id"]: r["language"] for r in edge}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0.0 for i in (1, 2, 3))
    assert got[4]["lang_pred"] != "und" and got[5]["lang_pred"] == "en"
    assert all(0.0 <= g["score"] <= 1.0 for g in got.values())
    empty = language_id.identify(docs([])).collect()
    assert empty == []


def test_repeated_rows_are_sampled_once(spark):
    rows = [(1, "the same words", "en")] * 3000 + [(i, f"le mot {i}", "fr") for i in range(2, 400)]
    sample = language_id.training_sample(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=5000)
    assert {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}["en"] == 1


def test_predictions_reach_the_kept_rows(docs, spark):
    """A document without a language gets the model's; another model changes it."""
    fr = "le chat et la souris dans la maison avec les enfants"
    rows = [(i, f"the cat and the mouse in the house with them {i}", "en") for i in range(40)]
    rows += [(100 + i, f"{fr} {i}", "fr") for i in range(40)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(known)
    new = spark.createDataFrame([(1, fr, None), (2, fr, "xx"), (3, "12", None), (4, None, "fr")],
                                "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang"] for r in language_id.keep_identified(new, model).collect()}
    assert got == {1: "fr", 2: "xx"}
    other = language_id.fit(known.withColumn("lang", F.when(F.col("lang") == "fr", "es").otherwise("de")))
    assert language_id.keep_identified(new, other).filter("doc_id = 1").first()["lang"] == "es"


def test_every_language_is_sampled(spark):
    """A frequent language is thinned; none is left out, however many."""
    rows = [(i, f"word {i}", f"l{i % 230}") for i in range(230 * 6)]
    rows += [(10_000 + i, f"more {i}", "l0") for i in range(2000)]
    sample = language_id.training_sample(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=50)
    got = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    known = {x for d, _, x in rows if zlib.crc32(str(d).encode()) % 4 != 2}
    assert set(got) == known and len(known) > 200
    assert 25 <= got["l0"] <= 100


# -- operator 8 ------------------------------------------------------------
def test_article_text_of_other_page_forms(spark):
    pages = [
        (1, "<html><body><header><h1>Site</h1></header><div class='menu'><a href=x>A</a></div>"
            "<main><h1>Title &amp; more</h1><p>One  two\n three.</p><p>Four.</p></main>"
            "<div class='comments'><article><p>Reader says a long thing about it all.</p></article>"
            "</div><script>var a='<p>no</p>'</script><div id='cookie-banner'>We use cookies</div>"
            "</body></html>", "Title & more\nOne two three.\nFour."),
        (2, None, ""), (3, "", ""), (4, "<div class=ad>Buy</div><!-- <p>x</p> -->", ""),
        (5, "<article><p>A&nbsp;b<br>c <b>d</b></p><form><p>mail</p></form><p>e", "A b c d\ne"),
        (6, "<nav><ul><li><a href='/'>Home</a><article><p>In an unclosed menu.</p></article>",
         "In an unclosed menu."),
        (7, "<article>" + "<p>long words here</p>" * 20000 + "</article>",
         "\n".join(["long words here"] * 20000)),
        (7, "<article><p title='a>b'>x</p></article>", "x"),
    ]
    df = spark.createDataFrame([(i, f"http://a/{i}", h, "c") for i, h, _ in pages],
                               "page_id long, url string, html string, _row string")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "html", "_row", "main_text"]
    got = Counter((r["page_id"], r["main_text"]) for r in out.collect())
    assert got == Counter((i, t) for i, _, t in pages)
    assert html_extract.html_query(df.limit(0)).count() == 0


def test_names_inside_other_attributes_do_not_hide(spark):
    """`hidden`, id, role and style count as whole attribute names only."""
    long = "The river rose again in the night and the lower road was closed by morning."
    seen = ["href='/hidden-valley/'", 'title="The hidden lake"', "data-state='not hidden'",
            'data-hidden="false"', "data-id=footer", "data-role='navigation'",
            "title='my role=navigation'", 'data-style="display:none"', "title=a/hidden",
            "class='x' data-class='ad'"]
    gone = ["hidden", "HIDDEN=''", "title='a'hidden", "aria-hidden=true", "id=menu",
            "style='display: none'", "data-role=x role='navigation'"]
    pages = [(i, f"<article><p>{long}</p><section {a}><p>{long} <a {a}>It's here</a>.</p></section>"
              f"<p>{long}</p></article>") for i, a in enumerate(seen + gone)]
    got = {r["page_id"]: r["main_text"] for r in html_extract.extract(
        spark.createDataFrame(pages, "page_id long, html string")).collect()}
    full = f"{long}\n{long} It's here.\n{long}"
    assert {a: got[i] for i, a in enumerate(seen)} == dict.fromkeys(seen, full)
    assert {a: got[len(seen) + i] for i, a in enumerate(gone)} == dict.fromkeys(
        gone, f"{long}\n{long}")


def test_unwanted_words_in_an_articles_names(spark):
    """A name with an unwanted part does not cost an article its text."""
    long = "Rain fell on the town all day and the market closed two hours early for once."
    kept = ["div class='content with-sidebar'", "article class='post category-social'",
            "div id='main-content' class='no-sidebar'", "article class='has-share'"]
    gone = ["div class='sidebar'", "div class='site-sidebar'", "article class='comment'",
            "div class='cookie-notice'"]
    pages = [(i, f"<body><{a}><p>{long}</p><p>{long}</p><p>{long}</p></{a.split()[0]}>")
             for i, a in enumerate(kept + gone)]
    got = [r["main_text"] for r in html_extract.extract(spark.createDataFrame(
        pages, "page_id long, html string")).orderBy("page_id").collect()]
    assert got == ["\n".join([long] * 3)] * len(kept) + [""] * len(gone)


def test_labelled_table_is_learned(spark):
    tree = html_extract.fit(spark)
    rows = html_extract.labelled_blocks(spark)
    wrong = rows.filter(html_extract.tree_column(tree, rows["x"]) != rows["label"]).count()
    assert wrong <= 0.03 * rows.count() and rows.count() > 500
    used = {html_extract.FEATURES[int(f)] for f in re.findall(r"feature (\d+)", tree)}
    assert used & {"link_density"} and used & {"density_before", "density_after"}
    assert used & {"words", "words_before", "words_after"}
    assert re.search(r"feature (\d+)", tree)[1] == str(html_extract.FEATURES.index("link_density"))


def test_held_out_pages_without_names(spark, monkeypatch):
    """Fitted on the pages of every other article; on the other ones all
    class, id and role names are removed: most blocks are still told apart."""
    per = len(html_extract.PAGES) // 6
    pages = html_extract.PAGES
    fit_on = [p for i, p in enumerate(pages) if i // per % 2 == 0]
    rest = [re.sub(r" (class|id|role)=('[^']*'|[^ >]*)", "", p)
            for i, p in enumerate(pages) if i // per % 2]
    monkeypatch.setattr(html_extract, "PAGES", fit_on)
    tree = html_extract.fit(spark)
    monkeypatch.setattr(html_extract, "PAGES", rest)
    rows = html_extract.labelled_blocks(spark)
    good = rows.filter(html_extract.tree_column(tree, rows["x"]) == rows["label"]).count()
    kept = rows.filter("label = 1").filter(html_extract.tree_column(tree, rows["x"]) == 1).count()
    assert good >= 0.85 * rows.count() and kept >= 0.95 * rows.filter("label = 1").count()


RIVER = ("The river rose again in the night and by morning the lower road was closed, so the "
         "school bus went round by the mill and came late.")


def test_articles_without_telling_names(spark):
    p = f"<p>{RIVER}</p>"
    pages = [(f"<body><h2>The lower road</h2>{p * 3}</body>", "The lower road\n" + "\n".join([RIVER] * 3)),
             (f"<div id=x1>{p * 4}</div>", "\n".join([RIVER] * 4)), (RIVER, RIVER),
             (f"<article>{p}<section id='legal'>{p}</section>{p}</article>", "\n".join([RIVER] * 3)),
             (f"<article>{p}<section class='reply'>{p}</section>{p}</article>", "\n".join([RIVER] * 3)),
             (f"<article>{p}<div class=ad>Buy two pairs of boots.</div>{p}</article>", f"{RIVER}\n{RIVER}"),
             (f"<!-->{p * 3}", "\n".join([RIVER] * 3)),
             (f"<article>{p}<noscript>{p}</noscript><select><option>one</select></article>",
              f"{RIVER}\n{RIVER}\none"),
             (f"<p>a < b</p>{p * 2}<p class='x", f"a < b\n{RIVER}\n{RIVER}\n<p class='x")]
    got = html_extract.extract(spark.createDataFrame(
        [(i, h) for i, (h, _) in enumerate(pages)], "page_id long, html string"))
    assert [r["main_text"] for r in got.orderBy("page_id").collect()] == [t for _, t in pages]


@pytest.mark.parametrize("page", [
    "<a x=' \"" * 120_000, "<a " * 300_000, "<div>" * 90_000 + "</span>" * 90_000,
    "<i><div>" + "<b>" * 90_000 + "</i>" * 90_000, "<a b='>' " * 90_000 + "c=\"",
    "<!--" * 200_000, "<p>&" * 200_000, "<" * 900_000 + ">", "<script>" * 100_000])
def test_broken_pages_take_linear_time(page):
    start = time.process_time()
    html_extract.blocks_of(page)
    assert time.process_time() - start < 8


def article_of(page):
    """The text of the given pages' only article element, by patterns."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inside = re.sub(r"</?b>", "", inside.replace("<br>", " "))
    blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", inside)]
    return "\n".join(b for b in blocks if b)


def test_whole_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = html_extract.html_query(pages).select("page_id", "text", "n_chars").collect()
    html_by = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(got) == 2500
    for r in got:
        assert r["text"] == article_of(html_by[r["page_id"]]) and r["n_chars"] == len(r["text"])


# -- operator 9 ------------------------------------------------------------
def _words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def _grams(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute_matches(docs, items):
    found = set()
    for d, t in docs:
        w = _words(t)
        for i, x in items:
            want = _grams(_words(x))
            size = len(_words(x))
            if not set(want) & {tuple(w[j:j + min(5, size)]) for j in range(len(w))}:
                continue                # no window can share a shingle
            for s in range(1 - size, len(w)) if size else ():
                have = _grams(w[max(s, 0):s + size]) if s + size > 0 else Counter()
                top = sum((have | want).values())
                if have and len(next(iter(have))) == min(5, size) \
                        and sum((have & want).values()) >= 0.8 * top:
                    found.add((d, i))
                    break
    return found


def test_matches_equal_brute_force(spark, docs):
    item = " ".join(f"w{i}" for i in range(30))
    near = item.replace("w1 ", "zz ")               # loses two of 26 shingles
    far = item.replace("w10", "zz").replace("w20", "zz")
    bench = [(1, item), (2, "one two three"), (3, None), (4, ""), (5, "solo"),
             (6, "a b c d e f g"), (7, item + " " + " ".join(f"v{i}" for i in range(20)))]
    rows = [(1, "x " * 50 + item.upper() + ". y z"), (2, "p " + near + " q"), (3, far),
            (4, "say One, two -- THREE!"), (5, None), (6, ""), (7, "a solo act"), (None, item),
            (8, "a b c d e f g a b c d e f g"), (9, "b c d e f g"), (10, "filler " * 5000 + item),
            (1, "x " * 50 + item.upper() + ". y z")]
    df = spark.createDataFrame(bench, "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in
           decontaminate.contamination_query(docs(rows), df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_matches(rows, bench)
    left = decontaminate.decontaminate(docs(rows), df)
    assert left.columns == docs(rows).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6, 9]
    assert decontaminate.decontaminate(docs([]), df).count() == 0
    assert decontaminate.decontaminate(docs(rows), df.limit(0)).count() == len(rows)


def cut_passage(seed):
    """An item, and prose that holds it without its first words: as many
    are cut as similarity 0.8 allows."""
    r = random.Random(seed)
    size = r.randint(14, 40)
    item = [f"w{r.randrange(1000)}" for _ in range(size)]
    cut = next(c for c in range(size - 5, 0, -1) if size - 4 - c >= 0.8 * (size - 4 + c))
    before, after = ([f"p{r.randrange(1000)}" for _ in range(30)] for _ in range(2))
    return " ".join(item), " ".join(before + item[cut:] + after)


def test_passages_cut_to_the_bound_equal_brute_force(spark, docs):
    """The first seeds' windows are 16 to 18 bits from their items."""
    seeds = [3006, 2473, 1700, 3940, 3863, 2989, *range(30)]
    cuts = [cut_passage(s) for s in seeds]
    bench = [(i, x) for i, (x, _) in enumerate(cuts)]
    rows = [(i, t) for i, (_, t) in enumerate(cuts)]
    want = brute_matches(rows, bench)
    assert want >= {(i, i) for i in range(len(seeds))}
    got = decontaminate.contamination_query(
        docs(rows), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


def changed_passage(seed):
    """An item, and prose that holds it swapped, cut or edited."""
    r = random.Random(seed)
    size = r.randint(12, 60)
    item = [f"w{r.randrange(3000)}" for _ in range(size)]
    kind, a = seed % 4, r.randint(1, size - 1)
    text = list(item)
    if kind == 0:
        text = item[a:] + item[:a]
    elif kind == 1:
        text = item[:-max(1, size // 10)]
    elif kind == 2:
        text[a] = "changed"
    else:
        b, c = sorted(r.sample(range(size), 2))
        text = item[:b] + item[c:] + item[b:c]
    prose = [f"p{r.randrange(1000)}" for _ in range(25)]
    return " ".join(item), " ".join(prose + text + prose[::-1])


def test_swapped_and_edited_passages_are_found(spark, docs):
    """Recall 1 on 200 passages: every one that some window of the document
    matches is returned, whatever the order of the item's parts."""
    made = [changed_passage(s) for s in range(200)]
    parts = [" ".join(f"{x}{i}" for i in range(30)) for x in "ab"]
    made.append((" ".join(parts), f"prose {parts[1]} {parts[0]} prose"))
    want = {(i, i) for i, (x, t) in enumerate(made) if brute_matches([(i, t)], [(i, x)])}
    assert (200, 200) in want and len(want) > 80
    got = decontaminate.contamination_query(
        docs([(i, t) for i, (_, t) in enumerate(made)]),
        spark.createDataFrame([(i, x) for i, (x, _) in enumerate(made)], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


# -- operator 10 -----------------------------------------------------------
def test_url_edges(spark):
    urls = ["http://WWW.Example.com/en/a?b#c", "https://m.example.com/en/", "http://a.com",
            "http://a.com/", None, "no scheme", "ftp://x.net/es/../q", "http://xnet/es/",
            "http://net/fr/x", "http://a.com/://b.net/es/", "http://example.com/en", "://com/",
            "http://a.com:80/", "http://x.net/es/1", "http://x.net/es/1"]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)],
                               "page_id long, url string, best string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in
           url_filter.judge(df, url_filter.rule_table(spark)).collect()}
    def brute(u):
        if u is None or "://" not in u:
            return None, "allow"
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fit = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[1:] if fit else (None, "allow")
    assert got == {i: brute(u) for i, u in enumerate(urls)}
    assert url_filter.judge(df.limit(0), url_filter.rule_table(spark)).count() == 0
    part = spark.createDataFrame([("a.com", "/x", "block"), (None, "/", "block"),
                                  ("a.com", None, "allow")], "host string, path string, verdict string")
    one = spark.createDataFrame([(1, "http://b.a.com/xy"), (2, "http://a.com/y"), (3, "http://a.com")],
                                "page_id long, url string")
    assert {r["page_id"]: r["rule"] for r in url_filter.judge(one, part).collect()} == {
        1: "a.com/x", 2: "a.com", 3: "a.com"}


def test_long_urls_and_deep_rules(spark):
    """Paths of thousands of steps; rules deeper than most URLs."""
    deep = "/" + "x/" * 40
    rules = [("com", "/", "allow"), ("a.b.c.d.com", deep, "block"), ("com", "/x/x/", "block"), ("net", None, "block")]
    urls = ["http://com" + "/s" * 60_000, "http://z.a.b.c.d.com" + deep + "y", "http://" + "h." * 3000 + "com/q",
            "http://a.b.c.d.com" + deep[:-1], "http://e.net", "http://com/x/x/y", "http://com/x/xy/"] + [
            "http://com/" + "p/" * i for i in range(300, 400)]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(
        spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"),
        spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    want = [("com/", "allow"), (f"a.b.c.d.com{deep}", "block"), ("com/", "allow"), ("com/x/x/", "block"),
            ("net", "block"), ("com/x/x/", "block"), ("com/", "allow")] + [("com/", "allow")] * 100
    assert got == dict(enumerate(want))


# -- pipeline --------------------------------------------------------------
def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in rows if any(map(str.isalpha, r["text"] or ""))]
    left = brute_lines(docs)
    texts = {d: left[d, t] for d, t in docs}
    reach = brute_components([(d, brute_print(t)) for d, t in sorted(texts.items())])
    texts = {d: t for d, t in texts.items() if reach[d] == d}
    bad = {d for d, _ in brute_matches(texts.items(), items)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(texts) - bad)
    from retentio.llm import bpe
    from retentio.llm.tokenizer_files import tokenizer_path
    own = bpe.model_of(open(tokenizer_path(), encoding="utf-8").read())
    for r in got:
        assert bytes(r["token_ids"]) == own.encode(texts[r["doc_id"]])
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and simhash.BITS == 3
