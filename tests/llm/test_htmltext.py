import html
import itertools
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import htmltext as h
from folioforge.llm.q_htmltext import op2_html_text


def test_decoding_is_the_best_consistent_choice():
    r = random.Random(3)
    for _ in range(60):
        n = r.randint(1, 9)
        parent = [-1] + [r.randrange(i) for i in range(1, n)]
        p = np.array([r.uniform(0.02, 0.98) for _ in range(n)])
        best, top = None, -1e9
        for c in itertools.product((False, True), repeat=n):
            if any(c[i] and not c[parent[i]] for i in range(1, n)):
                continue
            value = sum(np.log(p[i] if c[i] else 1 - p[i]) for i in range(n))
            if value > top:
                best, top = c, value
        assert tuple(h.decode(parent, p)) == best


def test_parse():
    texts = lambda s: [t for t in h.parse(s).text if t]
    assert texts("<p>a &amp; b<br>c <b>d</b>\n e<p>f<ul><li>x<li>y</ul>z") == ["a & b c d e", "f", "x", "y", "z"]
    assert texts("<script>if (a<b) '</p>'</script><style>p{}</style>t<!-- no > -->u<title>n</title>") == ["tu"]
    assert texts("<div title='a>b'>x</div><table><tr><td>1<td>2<tr><td>3</table>") == ["x", "1", "2", "3"]
    assert texts("a < b <i>c") == ["a < b c"] and texts("<p>a</p><p>cut <a href='") == ["a", "cut"]
    assert texts(None) == texts("") == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/pabi!-\"'= &;#x1\n")), max_size=80))
def test_any_string_parses(s):
    page = h.parse(s)
    assert all(p < i for i, p in enumerate(page.parent)) and len(h.features(page)) == len(page.tag)


def test_deep_and_long_pages():
    m = h.model()
    for s in ("<div>" * 20_000 + "x", "<p>" * 50_000, "<b>" * 3000 + "t", "<a \"" * 20_000, "x" * 500_000, "<!--" * 20_000, "&am" * 50_000, "<" * 50_000):
        h.extract([s], m)


def test_held_out_pages():
    r = random.Random(4321)
    exact = 0
    for _ in range(150):
        source, main = h._build(r)
        exact += h.extract([source], h.model())[0] == "\n\n".join(" ".join(b.split()) for b in main)
    assert exact >= 143, exact


def test_real_pages(spark):
    d = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in op2_html_text(spark, d).collect()}
    for r in spark.read.parquet(f"{d}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", body))
        assert got[r.page_id].text == "\n\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_edge_rows(spark, tmp_path):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", "<article><h1>Title words</h1><p>Some text here, as it is.</p></article>", "t"), (1, "u", None, "t")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in op2_html_text(spark, str(tmp_path)).collect()), key=str)
    text = "Title words\n\nSome text here, as it is."
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (2, None, "", 0), (None, "v", text, len(text))], key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert op2_html_text(spark, str(tmp_path)).collect() == []


def plain_tag_end(s):
    """Where the opening tag at the start of s ends, by the states of the HTML standard; None if it does not."""
    white, k, state = " \t\n\r\f", 2, "before"
    while k < len(s):
        c = s[k]
        if state in "\"'":
            if c == state:
                state = "before"
        elif state == "value" and c in "\"'":
            state = c
        elif c == ">":
            return k + 1
        elif state == "value":
            state = state if c in white else "unquoted"
        elif state == "unquoted":
            state = "before" if c in white else state
        elif state == "before":
            state = state if c in white + "/" else "name"
        else:  # in a name, or behind one
            if c == "=":
                state = "value"
            elif c == "/":
                state = "before"
            elif c in white:
                state = "after"
            else:
                state = "name"
        k += 1
    return None


def test_stray_quotes_open_no_value():
    text = lambda s: [t for t in h.parse(s).text if t]
    assert text("<p title=don't>One.</p><p>Two.</p>") == ["One.", "Two."]
    assert text('<img alt=5" src=x><p>All the article.</p>') == ["All the article."]
    assert text('<p class="a"">one two</p><p class="b">three</p>') == ["one two", "three"]
    assert text('<p a="1>2"=b c = \'>\' d=>x</p>') == ["x"]


def test_tags_end_where_html_ends_them():
    import random

    r = random.Random(0)
    for _ in range(100_000):
        s = "<p" + r.choice(" /\n") + "".join(r.choice("ab=='\"\"> />") for _ in range(r.randrange(14)))
        m = h._TAG.match(s)
        assert (m.end() if m else None) == plain_tag_end(s), s
