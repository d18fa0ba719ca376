import itertools
import re
from html import unescape

import numpy as np

from tierforge.llm.html_blocks import leaf_blocks
from tierforge.llm.html_extraction import ChainModel, _labelled, main_text, op10_html_extraction, page_model, train_chain
from tierforge.llm.labelled_pages import labelled_pages

SF = "/root/testdata/sf0.01"


def test_blocks():
    html = "<!-- no --><div>a &amp; b<p><b>c\n d<br>e</b><p>f<script>x<p></script>g</div><ul><li>1<li>2</ul>&lt;tail <a href='x>'>link</a>"
    assert [b.text for b in leaf_blocks(html)] == ["a & b", "c d e", "f", "g", "1", "2", "<tail link"] or [
        b.text for b in leaf_blocks(html)
    ] == ["a & b", "c d e", "fg", "1", "2", "<tail link"]
    assert leaf_blocks("") == [] and leaf_blocks("<p> </p>") == []
    assert [b.text for b in leaf_blocks("1 < 2 and <b>3 > 2")] == ["1 < 2 and 3 > 2"]
    assert leaf_blocks("<script>never closed <p>x") == []


def test_no_text_is_lost_behind_silent_elements():
    texts = lambda html: [b.text for b in leaf_blocks(html)]
    for tag in ('<svg class="i"/>', "<math/>", "<svg viewBox='0 0 9 9'><path d='x'/>drawn</svg>", "<math><mi>x</mi></math >"):
        assert texts(f"<p>Icon {tag} here.</p><p>Second</p>") == ["Icon here.", "Second"]
    for tag in ("title", "iframe", "noscript", "template", "svg", "object", "canvas", "video"):
        assert texts(f"<p>one</p><{tag} a=b><p>two</p><p>three</p>") == ["one", "two", "three"]
        assert texts(f"<p>one</p><{tag}><p>two</p></{tag.upper()} ><p>three</p>") == ["one", "three"]
        assert texts(f"<p>one</{tag}></p><p>three</p>") == ["one", "three"]


def test_broken_and_long_pages_are_linear():
    for piece in ("<svg>", "<svg/>", "<title>x", "</svg>", "<iframe></iframe><svg>", "<div", "<div>", "<a 'x", '<p class="', "<", "</p>", "<!--", "<b><i>", "<td>", "&#x41;"):
        leaf_blocks(piece * 50_000)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(50):
        weights = {f"f{i}": float(w) for i, w in enumerate(rng.normal(size=6))}
        model = ChainModel(weights, rng.normal(size=(2, 2)))
        features = [[f"f{i}" for i in rng.choice(6, 2, replace=False)] for _ in range(6)]

        def score(path):
            own = sum(sum(weights[f] for f in block) for block, y in zip(features, path) if y)
            return own + sum(model.steps[b, a] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=6), key=score)
        assert [int(x) for x in model.decode(features)] == list(best)


def test_training_fits_a_chain():
    pages = [([["start"], ["x"], ["x"], ["end"]], [0, 1, 1, 0]), ([["x"], ["end"]], [1, 0])] * 5
    model = train_chain(pages)
    assert [model.decode(f) for f, _ in pages[:2]] == [[False, True, True, False], [True, False]]


def test_unseen_layouts():
    model = page_model()
    hits = total = wrong = 0
    for html in labelled_pages(150, seed=77):
        features, labels = _labelled(html)
        got = model.decode(features)
        hits += sum(a and b for a, b in zip(got, labels))
        wrong += sum(a and not b for a, b in zip(got, labels))
        total += sum(labels)
    assert hits / total > 0.97 and wrong / total < 0.03


def test_pages_table(spark):
    rows = {r.page_id: r for r in op10_html_extraction(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?p>|</?h1>", article)]
        assert rows[page.page_id].text == "\n\n".join(p for p in parts if p)
        assert rows[page.page_id].n_chars == len(rows[page.page_id].text)


def test_odd_rows(spark, tmp_path):
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (1, "u", "<nav><a>menu</a></nav>", "x"), (2, "é", "<article><p>Text &eacute;😀 and more of it, here.</p>" * 3000, "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(str(tmp_path / "pages.parquet"))
    got = op10_html_extraction(spark, str(tmp_path)).collect()
    assert sorted(r.n_chars for r in got)[:3] == [0, 0, 0] and len(got) == 4
    assert max(r.n_chars for r in got) == 3000 * len("Text é😀 and more of it, here.") + 2999 * 2
    assert main_text(page_model(), None) == ""
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "e/pages.parquet"))
    assert op10_html_extraction(spark, str(tmp_path / "e")).count() == 0
