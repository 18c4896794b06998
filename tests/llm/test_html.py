import pytest

from revlens.llm import html, registry
from tests.llm.helpers import save


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"),
    ("<p>a<p>b", "a\n\nb"), ("<p>a</p>\n<p>b</p>c", "a\n\nb\n\nc"),
    ("<div>a</div><div>b</div>", "a\nb"), ("a<br>b<br/>c", "a\nb\nc"),
    ("<b>bo</b>ld <i> it</i>", "bold it"), ("<h1>T</h1>x", "T\n\nx"),
    ("<ul><li>x<li>y</ul>", "- x\n- y"),
    ("<ol start=3><li>x<li>y<ul><li>z</ul></ol>", "3. x\n4. y\n\n   - z"),
    ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n    b\nc\n    d"),
    ("<pre>\n a\n   b </pre>", " a\n   b"),
    ("<title>t</title><style>s</style><script>if (a</b) '</p>'</script>x", "x"),
    ("<head><title>t</title></head><body>x", "x"), ("<title>t</head><body>x", ""), ("<head><meta charset=x><p>x", "x"),
    ("a<div hidden>no<p>no</div>b", "ab"), ("a<span style='color:red;display : none'>n</span>b", "ab"),
    ("<p style='visibility:hidden'>x</p>y", "y"), ("<input type=hidden value=x>a", "a"),
    ("<noscript><p>n</noscript>a", "a"), ("<template><p>n</template>a", "a"),
    ("a<!-- <p>x --> b<!DOCTYPE x><![CDATA[c]]>", "a bc"),
    ("&lt;p&gt; &amp;amp; &nbsp;x &bogus; &#65;", "<p> &amp;  x &bogus; A"),
    ("<a title='x>y' href=\"a'>b\">t</a>", "t"), ("1 < 2 > 1 <3 </ x>", "1 < 2 > 1 <3"),
    ("</div></p>x</table>", "x"), ("<p>a</b></i>b</p>", "ab"),
    ("<details><summary>s</summary>no</details>y", "s\ny"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<textarea>a &lt;b\n c</textarea>", "a <b\n c"),
    ("x<script>", "x"), ("x<!-- open", "x"), ("x<p", "x"), ("\x00x", "x"),
])
def test_layout(page, text):
    assert html.render(page) == text


def test_table_columns_are_aligned():
    page = ("<table><caption>Cap</caption><thead><tr><th>Name<th>N</thead><tr><td>漢字<td>1"
            "<tr><td>long name<td>22<tr><td colspan=2>both</table>after")
    assert html.render(page).split("\n") == [
        "Cap", "Name       N", "漢字       1", "long name  22", "both", "", "after"]


@pytest.mark.parametrize("rows, lines", [
    ("<tr><td rowspan=2>A<td>b1<td>c1<tr><td>b2<td>c2", ["A  b1  c1", "   b2  c2"]),
    ("<tr><td colspan=2>a long heading<td>x<tr><td>1<td>2<td>y", [
        "a long heading  x", "1  2            y"]),
    ("<tr><td rowspan=0>A<td>1<tr><td>2<tr><td>3", ["A  1", "   2", "   3"]),
    ("<tbody><tr><td rowspan=9>A<td>1</tbody><tbody><tr><td>2<td>3</tbody>", ["A  1", "2  3"]),
    ("<tr><td rowspan=2>a<br>b<br>c<td>1<tr><td>2<tr><td>x<td>3", ["a  1", "b  2", "c", "x  3"]),
    ("<tr><td>1<td rowspan=2 colspan=2>wide cell<td>2<tr><td>3<td>4", [
        "1  wide cell  2", "3             4"]),
    ("<tr><td colspan=0>a<td rowspan=-3>b", ["a  b"]),
])
def test_spans_hold_their_places(rows, lines):
    assert html.render(f"<table>{rows}</table>").split("\n") == lines


def test_places_equal_a_grid_filled_slot_by_slot():
    import random

    chance = random.Random(7)
    for _ in range(300):
        rows = [None if chance.random() < 0.1 else [
            ([f"t{n}"], chance.randint(1, 3), chance.randint(0, 4))
            for n in range(chance.randint(0, 4))] for _ in range(chance.randint(0, 7))]
        slots, expected, first = {}, [], 0
        parts = [[]]
        for row in rows:
            parts.append([]) if row is None else parts[-1].append(row)
        for group in parts:
            for y, row in enumerate(group):
                x = 0
                for lines, wide, high in row:
                    while (first + y, x) in slots:
                        x += 1
                    high = min(high, len(group) - y) if high else len(group) - y
                    for dy in range(high):
                        for dx in range(wide):
                            slots[first + y + dy, x + dx] = True
                    expected.append((first + y, high, x, wide, lines))
                    x += wide
            first += len(group)
        assert html._placed(rows) == (expected, first)


@pytest.mark.parametrize("page, text", [
    ("<ol start=1234567890><li>x</ol>", "1234567890. x"), ("<ol start=99999999999><li>x</ol>", "1. x"),
    ("<ol start=-5><li>x</ol>", "-5. x"), (f"<ol start={'0' * 5000}7><li>x</ol>", "7. x"),
    ("a<span style='display:block'>b</span>c", "a\nb\nc"),
    ("a<div style='color:red; display: inline-block'>b</div>c", "abc"),
    ("<ul style='display:inline'><li>x</ul>", "- x"),
])
def test_numbers_and_display(page, text):
    assert html.render(page) == text


def test_empty_pages_and_repeated_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, html string")
    assert registry.op2_html(spark, save(tmp_path / "a", empty, "pages")).count() == 0
    twice = spark.createDataFrame([(1, "<p>x"), (1, "<p>x"), (2, "<p>x")], "page_id long, html string")
    got = registry.op2_html(spark, save(tmp_path / "b", twice, "pages")).collect()
    assert sorted(tuple(r) for r in got) == [(1, "x"), (1, "x"), (2, "x")]


def test_nested_table_and_lines_in_cells():
    page = "<table><tr><td>a<br>b<td><table><tr><td>x<td>y</table><tr><td>c</table>"
    assert html.render(page).split("\n") == ["a  x  y", "b", "c"]


def test_deep_nesting_and_long_pages():
    assert html.render("<div>" * 100_000 + "x" + "</div>" * 100_000 + "y") == "x\ny"
    assert html.render("<b>" * 3000 + "x").strip() == "x"
    assert len(html.render("<p>word word</p>" * 50_000)) == 50_000 * 11 - 2


def test_query(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    got = {r.page_id: r.text for r in registry.op2_html(spark, sf_dir).collect()}
    assert got == {i: html.render(h) for i, h in pages}
    rows = spark.createDataFrame([(1, None, "c"), (1, "<p>x", "c"), (None, "", "c")],
                                 "page_id long, html string, text string")
    got = registry.op2_html(spark, save(tmp_path, rows, "pages")).collect()
    assert sorted([tuple(r) for r in got], key=str) == [(1, ""), (1, "x"), (None, "")]


def test_every_visible_word_of_the_sample_is_kept(spark, sf_dir):
    import re

    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        bare = re.sub(r"(?s)<(title|style|script)[^>]*>.*?</\1>|<!--.*?-->", " ", row.html or "")
        words = html.unescape(re.sub(r"(?s)<[^>]*>", " ", bare)).split()
        shown = [w for w in html.render(row.html).split() if w != "-"]
        assert sorted("".join(shown)) == sorted("".join(w for w in words if w != "-"))


@pytest.mark.parametrize("tag", ["div", "span", "font", "b"])
def test_rules_hold_at_every_depth(tag):
    for depth in (10, 149, 150, 151, 3000):
        deep = f"<{tag}>" * depth
        for hidden in ("<div style='display:none'>no</div>", "<p hidden>no</p>",
                       "<svg><text>no</text></svg>", "<template>no</template>"):
            assert html.render(f"{deep}a{hidden}").strip() == "a"
        assert html.render(f"{deep}<table><tr><td>a<td>b</table>").strip() == "a  b"
        assert html.render(f"{deep}<ul><li>a<li>b</ul>").strip() == "- a\n- b"
        # a stray end tag changes nothing, and what follows the deep spot is as before
        after = f"</i></em><p hidden>no</p></{tag}>" + f"</{tag}>" * (depth - 1)
        assert html.render(f"{deep}a{after}<ol><li>x<li>y</ol>").split() == [
            "a", "1.", "x", "2.", "y"]
    assert html.render("<pre>" + "<b>" * 3000 + "a\n  b") == "a\n  b"
    assert html.render("<table><tr><td>" * 500 + "x") == "x"


def test_open_tags_cost_no_search():
    import time

    started = time.monotonic()
    assert html.render("<div><span>" * 50_000 + "<p>x" * 2) == "x\n\nx"
    assert time.monotonic() - started < 30
