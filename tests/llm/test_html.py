import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm.html import extract, extract_pages

CASES = {
    "<p>One<p>Two <b>bold": "One\n\nTwo bold",
    "a<br>b<div>c</div>d": "a\nb\nc\nd",
    "<ul><li>x<li>y<ol start=3><li>z<li>w</ol></ul>": "- x\n- y\n\n  3. z\n  4. w",
    "<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td>fig<td>12</table>": "Name       Qty\napple pie  3\nfig        12",
    "<table><tr><td rowspan=2>two<td>1<tr><td>2</table>after": "two  1\n     2\n\nafter",
    "<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>": "wide cell\na  b",
    "<pre>\n  keep   this\n    too</pre>": "  keep   this\n    too",
    "<head><title>t</title><style>p{x:y}</style></head><body>seen<script>var t='</p>'</script>": "seen",
    "<style>.no{display:none} @media print{p{display:none}}</style><p class='a no'>x</p><p>y": "y",
    "<div style='visibility:hidden'>h<span style='visibility: visible'>seen</span></div>": "seen",
    "<div hidden>x</div><template>y</template><noscript>z</noscript>w": "w",
    "<details><summary>Sum</summary>closed</details><details open>open</details>": "Sum\n\nopen",
    "<select><option>A<option selected>B</select>": "B",
    "1 &lt; 2 &amp; 3&nbsp;4 <!-- no --> x < y": "1 < 2 & 3 4 x < y",
    "<dl><dt>T<dd>D<dd>E</dl>": "T\n  D\n  E",
    "<blockquote>q<p>r</blockquote>s": "  q\n\n  r\n\ns",
    "<a title='<b>no</b>' href=x>link</a>": "link",
    "": "",
    "<p": "<p",
    "<div>" * 5000 + "deep": "deep",
    "<div>" * 160 + "seen<div style='display:none'>HIDDEN</div>": "seen",
    "<div>" * 5000 + "seen<div style='visibility:hidden'>HIDDEN</div>": "seen",
    "<svg><text>chart label</text></svg><select multiple><option>A<option>B</select>": "chart label\nA\nB",
    "<svg><title>t</title><defs><text>no</text></defs><rect/>x<g><text>a <tspan>b</tspan></text></g></svg>c": "a b\nc",
    "<svg><path/><p>after the drawing": "after the drawing",
    "<select size=2><optgroup label=G><option>A<option hidden>B</select>": "G\nA",
    "<blockquote>" * 3000 + "q": "  " * 40 + "q",
}


@pytest.mark.parametrize("source", list(CASES), ids=range(len(CASES)))
def test_layout(source):
    assert extract(source) == CASES[source]


def test_no_visible_word_is_lost():
    words = [f"w{i}" for i in range(3000)]
    page = "".join(f"<{t}>{w} " for t, w in zip(["p", "div", "li", "td", "b", "h2", "dd", "tr", "ul", "table", "section", "span"] * 250, words))
    assert set(words) <= set(extract(page).replace("-", " ").split())


def test_pages(spark):
    rows = [(1, None, "t"), (2, "", "t"), (2, "<p>a", "t"), (3, "<td>" * 20000 + "x", "t")]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert got.columns == ["page_id", "html", "text"]
    assert sorted((r.page_id, r.text) for r in got.collect() if r.text is not None) == [(2, ""), (2, "a"), (3, "x")]
    assert extract_pages(got.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ("<style>.tab{display:none} .tab.active{display:block}</style><p class=tab>x<p class='tab active'>y", "y"),
        ("<style>.a{display:none} .a{display:block}</style><p class=a>y", "y"),
        ("<style>.a{display:block} .a{display:none}</style><p class=a>x<p>y", "y"),
        ("<style>.a{display:none}</style><p class=a style='display:block'>y", "y"),
        ("<style>.a{display:none!important}</style><p class=a style='display:block'>x<p>y", "y"),
        ("<style>#i{display:none} .a{display:block}</style><p class=a id=i>x<p>y", "y"),
        ("<style>.b{display:none} #a .b{display:block}</style><div id=a><p class=b>y</div>", "y"),
        ("<style>.a{display:none}</style><style>@media (min-width:9px){.a{display:flex}}</style><p class=a>y", "y"),
        ("<style>.a{display:none} @media print{.a{display:block}} .a:hover{display:block}</style><p class=a>x<p>y", "y"),
        ("<style>.a{visibility:hidden} p.a{visibility:visible}</style><p class=a>y", "y"),
        ("<style>div .a{display:none}</style><p class=a>y", "y"),
    ],
)
def test_rules_that_show_again(page, want):
    assert extract(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<style>.a{display:none;content:'}'} /* .b{display:none} */</style><p class=a>x<p class=b>y", "y"),
        ("<style>@import 'a.css'; .a{display:none}</style><p class=a>x<p>y", "y"),
        ("<style>@media screen{.c{display:block}} .c{display:none}</style><p class=c>x<p>y", "y"),
        ("<style>.a{color:red; &.b{display:none}} .c{display:none</style><p class='a b'>y<p class=c>x", "y"),
        ("<style>@media print{.a{x:y} @media screen{.b{display:block}}} .b{display:none}</style><p class=b>x<p>y", "y"),
    ],
)
def test_sheets_are_read_in_one_pass(page, want):
    assert extract(page) == want


@pytest.mark.parametrize(
    "part",
    ["x", "/*", "[", "a{", ".a", "@media{", "\\\"", "'"],
)
def test_a_broken_sheet_of_a_megabyte_takes_no_time(part):
    began = time.perf_counter()
    assert extract("<style>.a{display:none}" + part * (1_000_000 // len(part))) == ""
    assert time.perf_counter() - began < 6


@pytest.mark.parametrize("part", ["<div>", "<blockquote>x", "<ul><li>x", "<table><tr><td>x", "<svg>", "<p><b>", "<dl><dd>x", "<option>x"])
def test_deep_pages_take_time_in_proportion(part):
    def seconds(n):
        began = time.perf_counter()
        extract(part * n)
        return time.perf_counter() - began

    assert seconds(40_000) < 10 * max(seconds(10_000), 0.05)


# A page as a tree: (tag, attributes, children), and what a reader sees of it by plain recursion.
WORDS = st.from_regex(r"[a-z]{2,6}", fullmatch=True)
LOOKS = {"": None, " style='display:none'": "none", " hidden": "none", " style='visibility:hidden'": False, " style='visibility:visible'": True, " class=gone": "none", " class='gone back'": None}
INLINE, BLOCK = ("b", "i", "span", "q", "em"), ("div", "section", "blockquote", "ul", "ol", "details open", "fieldset", "table")


def _tree(children):
    return st.tuples(st.sampled_from(INLINE + BLOCK + ("svg", "menu-box", "template", "details")), st.sampled_from(list(LOOKS)), st.lists(children, max_size=4))


TREES = st.recursive(WORDS, _tree, max_leaves=25)


def _written(node):
    if isinstance(node, str):
        return f" {node} "
    tag, look, children = node
    inner = "".join(map(_written, children))
    name = tag.split()[0]
    if tag in ("ul", "ol"):
        inner = "".join(f"<li>{_written(c)}" for c in children)
    elif tag == "table":
        inner = "<tr>" + "".join(f"<td>{_written(c)}" for c in children)
    elif tag == "svg":
        inner = "<rect/>lost" + "".join(f"<text>{c}</text>" if isinstance(c, str) else f"<foreignObject>{_written(c)}</foreignObject>" for c in children)
    elif tag == "menu-box":
        words = [c for c in children if isinstance(c, str)]
        name, inner, look = "select", "".join(f"<option{look if k % 2 else ''}>{w}" for k, w in enumerate(words)), " multiple"
    elif tag == "details":
        inner = "<summary>head</summary>" + inner
    return f"<{tag if name != 'select' else name}{look}>{inner}</{name}>"


def _seen(node, shown):
    """The words a reader sees."""
    if isinstance(node, str):
        return [node] if shown else []
    tag, look, children = node
    effect = LOOKS[look]
    if tag == "menu-box":
        words = [c for c in children if isinstance(c, str)]
        states = [effect if k % 2 else None for k in range(len(words))]
        return [w for w, e in zip(words, states) if e != "none" and (shown if e is None else e)]
    if effect == "none" or tag == "template":
        return []
    now = shown if effect is None else effect
    if tag == "details":
        return ["head"] if now else []
    return [w for c in children for w in _seen(c, now)]


@settings(max_examples=400, deadline=None)
@given(st.lists(TREES, max_size=4), st.integers(0, 300))
def test_words_equal_those_of_plain_recursion(trees, depth):
    page = "<style>.gone{display:none} .gone.back{display:block}</style>" + "<div>" * depth + "".join(map(_written, trees))
    want = [w for t in trees for w in _seen(t, True)]
    got = re.findall("[a-z]+", extract(page))
    assert sorted(got) == sorted(want)
    if "<table" not in page:
        assert got == want
