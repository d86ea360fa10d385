import time

import pytest

from lading.llm.html_text import extract_text, page_text

CASES = {
    "<p>a<p>b": "a\n\nb",
    "<ul><li>a<li>b<ul><li>c</ul></ul>": "- a\n- b\n  - c",
    "<ol start=9><li>x<li>y</ol>": "9. x\n10. y",
    "<table><tr><th>Name<th>Qty<tr><td>fig<td>12</table>": "Name  Qty\nfig   12",
    "<table><td>1<td>2</table>": "1  2",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "x <b>bold</b><i> it</i>alic": "x bold italic",
    "<pre>\n a\n  b</pre>": " a\n  b",
    "<div>a</div>b<div>c</div>": "a\nb\nc",
    "<p hidden>no</p><p style='display : none'>no</p><span style=visibility:hidden>no</span>yes": "yes",
    "<title>no</title><script>var x='<p>no'</script><style>no</style><!-- no -->yes<noscript>no</noscript>": "yes",
    "a &lt;b&gt; &eacute; &#228; &amp;amp;": "a <b> é ä &amp;",
    "1 < 2 <": "1 < 2 <",
    "<a title='>'>x</a>": "x",
    "<dl><dt>T<dd>D</dl>": "T\n  D",
    "<p>a<table><tr><td>c</table>b": "a\n\nc\n\nb",
    "<textarea><b>t</textarea>": "<b>t",
    "</p></div>ok<p": "ok",
    "so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding=t>x=2 tex</annotation></semantics></math> holds": "so x=2 holds",
    "a <svg><title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><g><text x=1>North</text><text>South</text></g></svg> b": "a North South b",
    "<svg><defs/><title/><path d='M0 0'/><text>L</text><g display=none><g></g><text>no</text></g></svg><p>after": "L\n\nafter",
    "<svg><foreignObject><div>in</div></foreignObject></svg><svg/>out": "in\nout",
    "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e</table>": "a  b  c\n   d  e",
    "<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d<td>e</table>": "a  b\n   c\n   d  e",
    "<table><tr><td colspan=2>wide<td>x<tr><td>1<td>2<td>3</table>": "wide     x\n1     2  3",
    "<table><tr><td colspan=2 rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>": "a     b\n      c\nd  e  f",
    "<div style='visibility:hidden'>no<span style='visibility:visible'>yes</span>no<p>no</div>on": "yes\n\non",
    "<pre style='visibility:hidden'>no<b style='visibility:visible'>yes</b></pre>": "yes",
    "<table style='visibility:hidden'><tr><td>no<tr style='visibility:visible'><td>yes</table>": "yes",
    "<ul style='visibility:collapse'><li>no<li style='visibility:visible'>yes</ul>": "- yes",
    "<details>no<summary>title</summary><p>no</details><details open><summary>t</summary>body</details>": "title\nt\nbody",
    "<dialog>no<p>no</dialog><dialog open>yes</dialog>": "yes",
    "<div>" * 210 + "<div hidden>no</div><ul><li>a<li>b</ul><table><td>1<td>2</table>": "- a\n- b\n\n1  2",
    "": "",
}


@pytest.mark.parametrize("page", list(CASES))
def test_layout(page):
    assert page_text(page) == CASES[page]


def test_hard_pages_stay_fast_and_whole():
    began = time.process_time()
    deep = page_text("<div>" * 50_000 + "deep" + "</div>" * 50_000 + "tail")
    assert deep.split() == ["deep", "tail"]
    hidden = page_text("<div>" * 30_000 + "<p hidden>no</p><b style='display:none'>no</b>yes" + "<blockquote>" * 3_000 + "end")
    assert hidden.split() == ["yes", "end"]
    assert page_text("<table><tr><td>x" * 2_000).count("x") == 2_000
    assert page_text("<table>" + "<tr><td colspan=1000 rowspan=60000>x" * 3_000).count("x") == 3_000
    wide = page_text("<table>" + "<tr><td>a<td>b" * 2_000 + "<tr><td>" + "w" * 100_000 + "<td>c</table>")
    assert len(wide) < 1_000_000 and wide.endswith("w  c")
    assert page_text("<span hidden>a</span>b" * 20_000).replace("\n", "").replace(" ", "") == "b" * 20_000
    for page in ("<!--" * 100_000, '<a "' * 100_000, "<td>x" * 50_000, "</p>" * 100_000):
        page_text(page)
    assert time.process_time() - began < 30


def test_table_with_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "<p>a", "t"), (1, "<p>a", "t"), (2, None, "t"), (None, "x", None), (3, "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((tuple(r) for r in extract_text(pages).collect()), key=str)
    assert got == sorted([(1, "a", 1), (1, "a", 1), (2, None, None), (None, "x", 1), (3, "", 0)], key=str)
    assert extract_text(pages.limit(0)).collect() == []
