"""Blocks of broken markup, main text of made pages that were not trained on, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import blocks, made_pages


@pytest.fixture(scope="module")
def labeller():
    return blocks.Labeller().fit(made_pages.training(blocks.PAGES, blocks.SEED))


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        (None, []),
        ("", []),
        ("just &amp; text", ["just & text"]),
        ("<p>a<p>b <b>c</b>\n\td<br>e</div><p>f", ["a", "b c d e", "f"]),
        ("<script>var t='<p>x</p>'</script><p>y</p><style>p{}</style><!-- <p>z --> w", ["y", "w"]),
        ("<ul><li>one<li>two <i>x</i></ul><table><tr><td>a<td>b<tr><td>c</table>", ["one", "two x", "a", "b", "c"]),
        ("<p>a<script>never closed <p>b", ["a"]),
        ("<p>a<!-- never closed <p>b", ["a"]),
        ("<P CLASS=x>1 &lt; 2 &#233;&nbsp;!</P><p title='a>b'>q", ["1 < 2 é !", "q"]),
        ("<title>t</title><noscript>n</noscript><body>x</body>", ["x"]),
    ],
)
def test_blocks(page, texts):
    assert [b[0] for b in blocks.blocks_of(page)] == texts


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = blocks.Labeller(1)
    x = rng.normal(size=(4, 3, blocks.INPUT)).astype(np.float32)
    mask, truth = np.ones((4, 3), np.float32), (rng.random((4, 3)) > 0.5).astype(np.float32)
    mask[3, 1] = 0

    def loss():
        p = model.chances(x, mask)
        return float(-(mask * (truth * np.log(p) + (1 - truth) * np.log(1 - p))).sum() / mask.sum())

    for weight, gradient in zip(model.weights(), model.gradients(x, mask, truth), strict=True):
        place = np.unravel_index(int(np.abs(gradient).argmax()), weight.shape)
        before = weight[place]
        weight[place] = before + 1e-2
        up = loss()
        weight[place] = before - 1e-2
        down = loss()
        weight[place] = before
        assert abs((up - down) / 2e-2 - gradient[place]) < 0.05 * abs(gradient[place]) + 1e-4


def test_held_out_pages(labeller):
    right = wrong = 0
    for x, truth in made_pages.training(200, 12345):
        p = labeller.chances(x[:, None], np.ones((len(truth), 1), np.float32))[:, 0] >= 0.5
        right += int((p == (truth > 0)).sum())
        wrong += int((p != (truth > 0)).sum())
    assert right / (right + wrong) > 0.98


def test_pages_of_the_table(spark, labeller):
    """The article of these pages is one element, which the labeller is not told."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("text", F.lit("clash"))
    found = blocks.extracted(rows, labeller).collect()
    same = 0
    pages = {r.page_id: r.html for r in rows.collect()}
    for row in found:
        page = pages[row.page_id]
        article = page[page.index("<article>") : page.index("</article>")]
        same += row.text == "\n\n".join(b[0] for b in blocks.blocks_of(article))
        assert row.n_chars == len(row.text)
    assert len(found) == len(pages) and same >= 0.97 * len(pages)


def test_odd_rows(spark, labeller):
    frame = spark.createDataFrame([(1, None, None), (2, "u", ""), (3, "u", "<p>Some words of prose here.</p>"), (3, "u", "<p>Some words of prose here.</p>"), (None, "v", "<div>" * 3000)], "page_id long, url string, html string")
    found = blocks.extracted(frame, labeller).collect()
    assert sorted((str(r.page_id), r.text) for r in found) == [("1", ""), ("2", ""), ("3", "Some words of prose here."), ("3", "Some words of prose here."), ("None", "")]
    assert blocks.extracted(frame.limit(0), labeller).count() == 0


@pytest.mark.parametrize(
    "page,texts",
    [
        ("<head><title>t</title><p>Text without body</p>", ["Text without body"]),
        ("<head><meta charset=x><script>s</script>bare text", ["bare text"]),
        ("<p class=it's>one</p><p>two isn't</p>", ["one", "two isn't"]),
        ('<p title="a>b">x</p><p title = \'c>d\'>y</p>', ["x", "y"]),
        ('<p title="never closed>one</p><p>two</p>', ["one", "two"]),
    ],
)
def test_legal_and_broken_tags(page, texts):
    assert [b[0] for b in blocks.blocks_of(page)] == texts


@pytest.mark.parametrize("part,end", [("<a ", '"'), ("<a b=", "'"), ('<a b="', ""), ("<!--", ""), ("<", ""), ("<b = ", ""), ("</", ">")])
def test_a_megabyte_of_unclosed_tags(part, end):
    import time

    start = time.perf_counter()
    blocks.blocks_of(part * (1_000_000 // len(part)) + end)
    assert time.perf_counter() - start < 6


def test_all_name_parts_are_kept():
    names = [f"c{chr(97 + i)}" for i in range(20)]
    assert blocks.split_names(f'class="{" ".join(names)}"') == names
