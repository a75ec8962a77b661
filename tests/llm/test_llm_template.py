"""Template deduction and main text on made pages and on the given table."""

import html
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from fraudspark.llm import queries, template
from fraudspark.llm.markup import TEXT, TOKEN, walk


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def plain(page):
    """The article of a given page: blocks end at paragraph and heading tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_extraction_of_the_table(spark):
    folder = "/root/testdata/sf0.01"
    pages = queries.table(spark, folder, "pages").collect()
    found = queries.op13_html_extraction(spark, folder).collect()
    assert [(r.page_id, r.url) for r in sorted(found, key=lambda r: r.page_id)] == sorted((p.page_id, p.url) for p in pages)
    expected = {p.page_id: plain(p.html) for p in pages}
    assert {r.page_id: r.text for r in found} == expected
    assert all(r.n_chars == len(r.text) for r in found)
    assert sum(r.n_template >= 20 for r in found) > 0.95 * len(found)  # html to footer, most of it


def page(rng, i, comments=False):
    say = lambda n: " ".join(rng.choice("red blue green black white grey".split()) + str(rng.randint(0, 99)) for _ in range(n))
    body = [f"Heading {i}", *(say(12) for _ in range(rng.randint(1, 5)))]
    inner = f"<h1>{body[0]}</h1>" + "".join(f"<p class=x{rng.randint(0, 9)}>{b}" for b in body[1:])
    talk = f"<div class='reader-comments'><p>{say(9)}</p></div>" if comments else ""
    links = "".join(f"<li><a href=/{k}>{say(1)}</a></li>" for k in range(rng.randint(2, 5)))
    return body, inner, talk, links


def test_slots_without_named_parts(spark):
    """A host of bare div elements: constant slots and lists of links go because the host's template shows them."""
    rng = random.Random(1)
    rows, expected = [], {}
    for i in range(30):
        body, inner, talk, links = page(rng, i, comments=i % 4 == 0)
        rows.append((i, "http://Plain.example/%d" % i, f"<html><body><div><div>Welcome to our site</div><ul>{links}</ul></div><div>{inner}{talk}</div><div>All rights &copy; us</div></body></html>"))
        expected[i] = "\n\n".join(body)
    for i in range(30, 42):
        body, inner, talk, links = page(rng, i, comments=True)
        rows.append((i, "https://u:p@named.example:80/x", f"<header>Top</header><nav><ul>{links}</ul></nav><main><aside>Side</aside>{inner}{talk}<form>Send</form></main><div id=cookie-notice>Cookies</div><footer>End"))
        expected[i] = "\n\n".join(body)
    clash = {c: F.lit(1) for c in ("host", "token", "tokens", "text", "page", "number")}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(clash).repartition(5)
    for limit in (template.BROADCAST_TOKENS, 0):  # both ways to bring templates to pages
        before, template.BROADCAST_TOKENS = template.BROADCAST_TOKENS, limit
        assert texts(template.extract(df)) == expected
        template.BROADCAST_TOKENS = before


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, None, ""), (3, "x", "no markup &lt;here&gt;  at\tall"), (4, "http://a.b/", "<p>one<p>two<br>three<hr>four<div>five"),
        (5, "http://a.b/", "<article>a<script>if (1 < 2) '</p>'</script>b <b>c</b>d<style>p{}</style></article><p>rest"),
        (6, "http://c.d", "<article><h1>T</h1><p>x &amp;amp; y&nbsp;&eacute; &#x41;<!-- <p>no</p> --></p><ul><li>l1<li>l2</ul><table><tr><td>a<td>b<tr><td>c</table>"),
        (7, "http://c.d", "<body class='no-sidebar comments-open'><article><p>stays</p><article class=comment>goes</article></article>"),
        (8, "http://c.d", "<article title='a > b'><p>cut off <a href='/x"), (9, "http://c.d", "<div>" * 3000 + "deep"), (9, "http://c.d", "<div>" * 3000 + "deep"),
        (None, "http://c.d", "<article></article><p>outside"), (10, "http://e.f", "<article>" + "<p>" + "word " * 100_000),
        (11, "http://g.h", "<noscript>n</noscript><textarea>t</textarea><button>b</button><article>5 < 6 & 7 > 3</article>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = texts(template.extract(df))
    assert found == {
        1: "", 2: "", 3: "no markup <here> at all", 4: "one\n\ntwo three\n\nfour\n\nfive", 5: "ab cd",
        6: "T\n\nx &amp; y é A\n\nl1\n\nl2\n\na b\n\nc", 7: "stays", 8: "cut off", 9: "deep", None: "", 10: ("word " * 100_000).strip(), 11: "5 < 6 & 7 > 3",
    }
    assert template.extract(df.limit(0)).count() == 0
    assert template.extract(df).count() == len(rows)


def test_classes_are_those_of_equal_vectors(spark):
    rng = random.Random(5)
    rows = [(i, f"http://h{i % 2}.example/", "<div><ul>" + "<li>x</li>" * rng.randint(1, 4) + "</ul>" + "<p>y</p>" * (i % 3 > 0) + "</div><div id=end>z</div>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = df.select("html", template.host_of(F.col("url")).alias("host"), F.xxhash64("page_id").alias("page"))
    vectors = template.token_vectors(got)
    expected = {}
    for i, url, text in rows:
        for token, n in Counter(t for kind, t, _ in walk(text) if kind == TOKEN).items():
            expected.setdefault((url[7:-1], token), {})[i] = n
    groups = {}
    for (host, token), vector in expected.items():
        groups.setdefault((host, tuple(sorted(vector.items()))), set()).add(token)
    expected_classes = {(host, frozenset(g)) for (host, vector), g in groups.items() if len(g) >= 2 and len(vector) >= 3}
    found = set()
    for r in template.candidate_classes(vectors, 2, 3, 0.05).collect():
        for number in set(r.classes):
            found.add((r.host, frozenset(t for t, c in zip(r.tokens, r.classes, strict=True) if c == number)))
    assert found == expected_classes and len(found) >= 8


def test_broken_classes():
    known = {1: (0, 0, 3), 2: (0, 1, 3), 3: (0, 2, 3), 4: (1, 0, 3), 5: (1, 1, 3), 6: (1, 2, 3)}
    broken = lambda tokens: template.broken_classes([(TOKEN, t, 0) for t in tokens], known)[1]
    assert broken([1, 4, 5, 6, 4, 5, 6, 2, 3]) == set()
    assert broken([1, 3, 2]) == {0}
    assert broken([1, 4, 5, 2, 6, 3]) == {0}  # they cross: that of less support goes
    assert broken([4, 1, 2, 5, 6, 3]) == {0}
    assert broken([1, 2]) == {0}
    assert walk("a<p>b")[0] == (TEXT, "a", 0)
