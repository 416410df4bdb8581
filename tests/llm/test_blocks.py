import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import blocks

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in blocks.read_blocks(page)]


def test_blocks_of_a_page():
    page = ("<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class='x'>loose &amp; free<nav><ul><li><a href=x>One</a><li>Two</ul></nav>"
            "<script>var t='</p>';</script><!-- gone <p>never</p> --><div id=main>A <b>bold</b>\n  word<br>next<p>para <i>one<p>para&nbsp;two &lt;x&gt; &eacute;</div>"
            "<form>Name <input value='>'><button>Go</button></form><noscript>no</noscript><p title=\"a > b\">last")
    assert texts(page) == ["loose & free", "One", "Two", "A bold word next", "para one", "para two <x> é", "last"]
    found = blocks.read_blocks(page)
    assert found[1].linked == 3 and found[2].linked == 0 and found[3].path[-2:] == ("div", ".main")


@pytest.mark.parametrize(("page", "want"), [
    (None, []), ("", []), ("just text", ["just text"]), ("<p>", []), ("</p></div>x", ["x"]), ("<p>a</div>b", ["a", "b"]), ("a < b and c > d", ["a < b and c > d"]),
    ("<div" + " x" * 2000, ["<div" + " x" * 2000]), ("<p>" * 3000 + "deep", ["deep"]), ("<div>" * 2000 + "deep" + "</div>" * 2000 + "after", ["deep", "after"]),
    ("<script>never ends <p>x", []), ("<p class=\"broken>text</p>more", ["text", "more"]), ("&#0;&#x41;&unknown;", ["\ufffdA&unknown;"]),
])
def test_odd_pages(page, want):
    assert texts(page) == want


def test_gradients_equal_differences():
    fit = blocks.Fit(hidden=3)
    model = blocks.fresh(fit)
    rng = np.random.default_rng(0)
    rows = [rng.normal(size=(n, blocks.WIDTH)) for n in (2, 5, 4)]
    x, mask = blocks.padded(rows)
    y = (rng.random(mask.shape) < 0.5).astype(float)
    _, grads = blocks.gradients(model, x, mask, y)
    for name, value in model.items():
        for at in rng.integers(0, value.size, 6):
            step = np.zeros(value.size)
            step[at] = 1e-6
            up, down = ({**model, name: value + s * step.reshape(value.shape)} for s in (1, -1))
            want = (blocks.gradients(up, x, mask, y)[0] - blocks.gradients(down, x, mask, y)[0]) / 2e-6
            assert grads[name].ravel()[at] == pytest.approx(want, abs=1e-7)


def test_padding_changes_nothing():
    model = blocks.fresh(blocks.Fit())
    rng = np.random.default_rng(1)
    rows = [rng.normal(size=(n, blocks.WIDTH)) for n in (3, 9)]
    x, mask = blocks.padded(rows)
    alone = blocks.judge(model, *blocks.padded(rows[:1]))
    assert np.allclose(blocks.judge(model, x, mask)[:3, 0], alone[:, 0])


@pytest.fixture(scope="module")
def split_pages(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]
    return pages[:120], pages[120:]


def test_held_out_pages_and_layouts(split_pages):
    known, unseen = split_pages
    fit = blocks.Fit()
    model = blocks.fit_model(blocks.lessons(known, fit), fit)
    read = [blocks.read_blocks(p) for p in unseen]
    want = ["\n".join(b.text for b in page if blocks.told(b) == 1) for page in read]
    assert np.mean([a == b for a, b in zip(blocks.main_texts(model, unseen), want, strict=True)]) >= 0.98
    rng, right = np.random.default_rng(99), []
    for page in read:
        moved, labels = blocks.relaid([b.text for b in page if blocks.told(b) == 1], [b.text for b in page if blocks.told(b) == 0], rng)
        share = blocks.judge(model, *blocks.padded([blocks.vectors(moved)]))[:, 0]
        right += list((share >= 0.5) == np.array(labels))
    assert np.mean(right) >= 0.97


def test_pages_written_otherwise(split_pages):
    known, _ = split_pages
    fit = blocks.Fit()
    model = blocks.fit_model(blocks.lessons(known, fit), fit)
    story = "<h1>A title of the story</h1><p>The first part of it, with some words in it.</p><p>And then the second part, as long as the first one.</p>"
    want = "A title of the story\nThe first part of it, with some words in it.\nAnd then the second part, as long as the first one."
    for around in ("<main>%s</main>", "<div class='content'>%s</div>", "<article>%s</article>"):
        page = ("<html><body><header><a href=/>Home</a></header><div class='menu'><ul><li><a href=a>News</a></li></ul></div>" + around % story
                + "<aside>Read more about it</aside><div class='cookie notice'>We use cookies.</div><section class=comments><p>Nice one!</p></section>"
                "<form>Mail <input></form><footer>Imprint</footer></body></html>")
        assert blocks.main_texts(model, [page]) == [want]


def test_defined_cases(spark):
    story = "<nav><a href=x>Menu</a></nav><article><p>%s</p></article><footer>End</footer>"
    rows = [(i, f"u{i}", story % f"Text number {i} of the page, which says something.") for i in range(30)]
    rows += [(40, "u", None), (41, "u", ""), (42, None, story % ("word " * 100_000)), (3, "u3", rows[3][2]), (None, "u", rows[5][2])]
    frame = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], "page_id bigint, url string, html string, text string, place int, page string")
    got = blocks.extracted(frame).select("page.page_id", "page.text", F.col("text").alias("found")).collect()
    by = {r.page_id: r.found for r in got}
    assert len(got) == len(rows) and {r.text for r in got} == {"clash"}
    assert by[40] == by[41] == "" and by[3] == "Text number 3 of the page, which says something." and by[42] == ("word " * 100_000).strip()
    assert blocks.extracted(frame.where("false")).count() == 0
