"""Main text of pages of shapes that the training pages don't have, of held-out generated pages, and the docstring's cases."""

import pytest

from lodestack.llm import html_blocks as hb

MENU = '<div class="gnb"><a href="/">Home</a> <a href="/b">Blog</a></div>'
SIDE = '<div class="col-4"><ul><li><a href="/1">Other story</a></li><li><a href="/2">More</a></li></ul></div><div class="btm">&copy; 2020 Company</div>'
ONE, TWO = "This is a long paragraph of ordinary prose, which tells the reader about something that happened yesterday in town.", "Another paragraph follows here and gives more detail on the matter, with numbers and names."
SHAPES = {
    "unknown classes": (f'<html><body>{MENU}<div class="col-8"><h1>A title of things</h1><p>{ONE}</p><p>{TWO}</p></div>{SIDE}</body></html>', ["A title of things", ONE, TWO]),
    "one paragraph": (f"<body><p>{ONE}</p></body>", [ONE]),
    "unclosed": (f"<body><article><h1>Title of it<p>{ONE}<p>{TWO}", ["Title of it", ONE, TWO]),
    "inner markup": (
        f"<body><nav><a href=/>Home</a></nav><article><h1>How to compare</h1><p>{ONE}</p><pre>x &lt; y and 3 &gt; 2</pre><p>if x < y and 3 > 2 then it holds for all of them.</p><details><summary>More</summary>{TWO}</details>"
        "<dl><dt>Term</dt><dd>The definition of the term in plain words.</dd></dl><table><tr><th>Name</th><th>Value</th></tr><tr><td>alpha</td><td>1</td></tr></table><script>var x = 1;</script><style>p {}</style></article><footer>Copyright</footer></body>",
        ["How to compare", ONE, "x < y and 3 > 2", "if x < y and 3 > 2 then it holds for all of them.", "More", TWO, "Term", "The definition of the term in plain words.", "Name", "Value", "alpha", "1"],
    ),
}


def texts(spark, pages):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string, text string, n_blocks string")
    return {r.page_id: (r.text, r.n_chars) for r in hb.extract(rows).collect()}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(shape):
    page, want = SHAPES[shape]
    found = hb.blocks(page)
    labels = hb.trained().labels([hb.Vectors().page(found)])[0]
    assert [b[1] for b, p in zip(found, labels) if p >= 0.5] == want


def test_held_out_generated_pages():
    pages = hb.training_pages(300, seed=977)
    labels = hb.trained().labels([x for x, _ in pages])
    right = sum(int(((p >= 0.5) == (y >= 0.5)).sum()) for p, (_, y) in zip(labels, pages))
    assert right >= 0.985 * sum(len(y) for _, y in pages)


def test_cases(spark):
    long = "<article>" + "".join(f"<p>Sentence number {i} of a very long page, which goes on.</p>" for i in range(5000)) + "</article>"
    got = texts(spark, [(1, "u", None, "x", "y"), (2, None, "", "x", "y"), (3, "u", long, "x", "y"), (3, "u", long, "x", "y"), (None, "u", "<p>" + ONE, "x", "y"), (5, "u", "plain words without any tag, which are a sentence of their own.", "x", "y")])
    assert got[1] == got[2] == ("", 0)
    assert got[3][0].count("\n") == 4999 and got[3][1] == len(got[3][0])
    assert got[None][0] == ONE
    assert hb.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_with_an_article_element(spark):
    """On the driver's pages with one article element, the text is that of its paragraphs, headings and cells."""
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in hb.extract(rows).collect()}
    checked = 0
    for r in rows.collect():
        inside = re.findall(r"<article[^>]*>(.*?)</article>", r.html or "", re.S)
        if len(inside) == 1 and not re.search(r"<(aside|nav|form|section|script|style|div|footer)\b", inside[0]):
            want = [b[1] for b in hb.blocks(f"<article>{inside[0]}</article>")]
            assert got[r.page_id].split("\n") == want
            checked += 1
    assert checked >= 20
