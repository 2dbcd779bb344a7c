import itertools
import re
from html import unescape

import numpy as np
import pytest

from rawstrata.llm import op13_html_extraction as op13

PROSE = (
    "The committee met on Tuesday to discuss the budget. It was a long meeting, and several"
    " members spoke at length about the plans."
)
WORDS = "river stone market letter garden window summer evening paper street".split()


def blocks(html):
    tree = op13.parse(html)
    return [s for s, k in zip(tree.text, tree.kind, strict=True) if k]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<p>a<b>b</b>c<p> d \n e&nbsp;&amp;&lt;", ["abc", "d e &<"]),
        ("<div>x<p>y</p>z</div>", ["x", "y", "z"]),
        ("<p>a<br>b<br/>c</p>", ["a b c"]),
        ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>", ["1", "2", "3", "4"]),
        ("<table><tr><td>a<td>b<tr><th>c</th><td>d</table>e", ["a b", "c d", "e"]),
        ("<title>no</title><style>p</style><script>var t='</p>';</script>yes", ["yes"]),
        ("<head><meta charset=x><p>body begins", ["body begins"]),
        ("a<!-- <p>no</p> -->b<!--x-->c<!-->d", ["abcd"]),
        ("1 < 2 <3 <p title='a>b' it's>c</p>d", ["1 < 2 <3", "c", "d"]),
        ("cut <p class='x", ["cut"]),
        ("cut &am", ["cut &am"]),
        ("<p>x</p></div></b>y<noscript>z</noscript><select><option>1</select>", ["x", "y"]),
        ("<dl><dt>t<dd>d<dt>u</dl><h1>h<h2>i</h2>", ["t", "d", "u", "h", "i"]),
        ("&#x41;&eacute;&#128512;&copy", ["Aé😀©"]),
        ("", []),
        (None, []),
        ("no markup", ["no markup"]),
    ],
)
def test_blocks(html, want):
    assert blocks(html) == want


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(3)
    trees = [op13.parse(h) for h in (
        f"<div><p>{PROSE}</p><ul><li><a href=x>l</a></li></ul>t</div><p>x</p>",
        "<article><p>a</p></article>",
        "",
    )]
    model = op13.TreeModel()
    model.node = draw.normal(0, 1, len(op13.FEATURES))
    model.pair = draw.normal(0, 1, (2, 2, 2))
    pages = op13.stacked(trees)
    got, joint = model.marginals(pages)
    unary, pair = pages.x @ model.node, model.potentials()
    start = 0
    for tree in trees:
        n = len(tree.parent)
        total, held, both = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product((0, 1), repeat=n):
            e = sum(unary[start + i] * y[i] for i in range(n))
            e += sum(pair[tree.kind[i], y[p], y[i]] for i, p in enumerate(tree.parent) if p >= 0)
            w = np.exp(e)
            total += w
            held += w * np.array(y)
            for i, p in enumerate(tree.parent):
                if p >= 0:
                    both[i, y[p], y[i]] += w
        assert np.allclose(got[start : start + n], held / total, atol=1e-9)
        assert np.allclose(joint[start + 1 : start + n], both[1:] / total, atol=1e-9)
        start += n


def test_gradient_raises_the_likelihood():
    tree = op13.parse(f"<article><h1>t</h1><p>{PROSE}</p></article><div><p>{PROSE}</p></div>")
    label = op13.node_labels(tree, f"t\n{PROSE}")
    texts = [s for s, y, k in zip(tree.text, label, tree.kind, strict=True) if y and k]
    assert texts == ["t", PROSE]
    assert label[0] == 1


def page(i, *, names=True):
    draw = np.random.default_rng(i)

    def sentence():
        return " ".join(draw.choice(WORDS, 14)).capitalize() + "."

    paragraphs = [" ".join(sentence() for _ in range(draw.integers(1, 5))) for _ in range(4)]
    title = " ".join(draw.choice(WORDS, 5)).capitalize()
    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in draw.choice(WORDS, 5))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    kinds = ("nav", "article", "footer") if names else ("div", "div", "div")
    html = (
        f"<html><head><title>{title}</title></head><body><{kinds[0]}><ul>{links}</ul></{kinds[0]}>"
        f"<{kinds[1]}>{body}</{kinds[1]}><{kinds[2]}>&copy; {draw.choice(WORDS)}</{kinds[2]}></body></html>"
    )
    return html, "\n".join([title, *paragraphs])


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "u", page(i)[0]) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return op13.fit(op13.self_labelled(pages, most_pages=30))


def test_unseen_pages_with_and_without_names(model):
    for names in (True, False):
        held_out = [page(i, names=names) for i in range(100, 130)]
        got = op13.main_texts([h for h, _ in held_out], model)
        right = sum(a == b for a, (_, b) in zip(got, held_out, strict=True))
        assert right >= (30 if names else 28)


OTHERS = {
    "menu": f"<div class='top-menu'><p>{PROSE}</p></div>",
    "header": f"<header><h1>Site</h1><p>{PROSE}</p></header>",
    "footer": f"<footer><p>{PROSE}</p></footer>",
    "sidebar": f"<div id='rightSidebar'><p>{PROSE}</p><p>{PROSE}</p></div>",
    "aside": f"<aside><p>{PROSE}</p></aside>",
    "notice": f"<div class='cookie-notice'>{PROSE}</div>",
    "advert": f"<div class='ad'>{PROSE}</div>",
    "form": f"<form action=x><p>{PROSE}</p><input></form>",
    "script": "<script>var x = '<p>no</p>';</script><style>p {}</style>",
    "comments": f"<section class='comments'><div class='comment'><p>{PROSE}</p></div>"
    f"<article class='comment'><p>{PROSE}</p><p>{PROSE}</p></article></section>",
    "hidden": f"<div style='display: none'><p>{PROSE}</p></div>",
    "role": f"<div role='dialog'><p>{PROSE}</p></div>",
}


@pytest.mark.parametrize("kind", OTHERS)
@pytest.mark.parametrize("of", ["article", "main", "div class='post-content'", "div"])
def test_parts_that_are_not_main_text(model, kind, of):
    own = f"<h1>Title of it</h1><p>{PROSE} One.</p><ul><li>First of the points.</li></ul><p>{PROSE} Two.</p>"
    end = of.split()[0]
    outside = f"{OTHERS[kind]}<{of}>{own}</{end}>{OTHERS[kind]}"
    inside = f"<{of}>{own}{OTHERS[kind]}<p>{PROSE} Last.</p></{end}>"
    text = f"Title of it\n{PROSE} One.\nFirst of the points.\n{PROSE} Two."
    if kind == "header" and of != "div":
        inside = f"<{of}>{own}</{end}>"  # a heading inside an article is a part of it
        text_inside = text
    else:
        text_inside = f"{text}\n{PROSE} Last." if inside.endswith(f"Last.</p></{end}>") else text
    assert op13.main_texts([f"<body>{outside}", f"<body>{inside}"], model) == [text, text_inside]


@pytest.mark.parametrize(
    "of",
    [
        "article class='post-12 post hentry category-news comment-open'",
        "div class='content has-sidebar no-comments'",
        "main id='mainContent' class='with_widgets'",
        "section class='story-body comments-closed'",
    ],
)
def test_names_that_only_mention_other_parts(model, of):
    end = of.split()[0]
    page = f"<body class='has-sidebar'><nav>Home</nav><{of}><h1>Title</h1><p>{PROSE}</p></{end}><aside><p>{PROSE}</p></aside>"
    assert op13.main_texts([page], model) == [f"Title\n{PROSE}"]


def test_odd_pages(spark, model):
    rows = [
        (1, "a", None), (1, "a", ""), (None, None, "<p"), (2, "b", "<nav>x</nav>"),
        (3, "c", "<article><p>" + "long words. " * 60_000), (3, "c", "<div>" * 3000 + PROSE),
        (4, "d", "<b>" * 3000 + "</i>" * 3000), (5, "e", "<article><p>One sentence here.</article>"),
        (5, "e", "<article><p>One sentence here.</article>"),
    ]
    schema = "page_id long, url string, html string, text string, n_chars long"
    pages = spark.createDataFrame([(*r, "own", 3) for r in rows], schema)
    got = [tuple(r) for r in op13.extract(pages, model).collect()]
    assert sorted(map(repr, ((a, b) for a, b, _ in got))) == sorted(repr(r[:2]) for r in rows)
    texts = [t for _, _, t in got]
    assert texts.count("One sentence here.") == 2 and texts.count("") == 5
    assert ("long words. " * 60_000).strip() in texts
    empty = pages.limit(0)
    assert op13.extract(empty, op13.fit(op13.self_labelled(empty))).count() == 0


def test_pages_beyond_the_node_budget_are_left_out(spark):
    pages = spark.createDataFrame([(page(i)[0], page(i)[1]) for i in range(9)], "html string, text string")
    prior = op13.TreeModel()
    assert (op13.fit(pages, most_nodes=5).node == prior.node).all()
    assert (op13.fit(pages, most_nodes=60).node != prior.node).any()


def test_whole_table_against_its_markup(spark):
    """The test tables' pages mark their article; a plain expression finds the same blocks."""
    sf_dir = "/root/testdata/sf0.001"
    rows = {r.page_id: r for r in op13.op13_html_extraction(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inside = re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)
        held = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", "", inside[1])) if inside else []
        want = "\n".join(filter(None, (" ".join(unescape(t).split()) for t in held)))
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want)
