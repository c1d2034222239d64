import json

import pytest

from postweave.llm import webtext as W
from tests.llm.fixtures import clashing

FRAME = (
    '<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>{top}'
    '<nav><ul>{menu}</ul></nav><!-- x --><div class="ad">Buy {i}</div>{main}'
    '<aside>Side</aside><section class="comments"><p>Reader {i} says</p></section><form><input>Send</form><footer>&copy; {i}</footer></body></html>'
)


def page(i, paragraphs=2, article=True, extra=""):
    menu = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(2 + i % 3))
    body = f"<h1>Title {i}</h1>" + "".join(f"<p>Text {i}, part <b>{k}</b>\n with&nbsp;&amp;  words.</p>" for k in range(paragraphs)) + extra
    main = f"<article>{body}</article>" if article else f'<div id="c{i}" class="story"><div class="body">{body}</div><div class="share">Share</div></div>'
    return FRAME.format(i=i, top="<header>Site</header>" if i % 2 else "", menu=menu, main=main)


def want(i, paragraphs=2, extra=()):
    return "\n".join([f"Title {i}", *(f"Text {i}, part {k} with & words." for k in range(paragraphs)), *extra])


@pytest.mark.parametrize("article", [True, False])
def test_pages_of_a_host(spark, article):
    rows = [(i, f"http://u@Site.example:80/{i}", page(i, i % 5 + 1, article)) for i in range(40)]
    got = {r.page_id: r.text for r in W.main_text(clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    assert got == {i: want(i, i % 5 + 1) for i in range(40)}


def test_optional_and_repeated_parts(spark):
    extra = "<ul><li>one</li><li>two</li></ul><p>Unclosed<br>line<p>next"
    rows = [(i, "http://b.example/", page(i, i % 4, True, extra if i % 2 else "")) for i in range(12)]
    for most in (W.MOST_BROADCAST, 0):
        got = {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), most=most).collect()}
        assert got == {i: want(i, i % 4, ("one", "two", "Unclosed line", "next") if i % 2 else ()) for i in range(12)}


def test_awkward_pages(spark):
    rows = [
        (1, "http://a/", None), (2, None, ""), (3, None, "plain &lt;text&gt; &#233;&amp"), (4, "http://a/", "<article><p>cut of"), (5, "http://a/", "<p>Only &copy; this <i"),
        (6, "", "<div></div><script>x<p>y"), (7, "http://c/", "<article>" + "<p>w </p>" * 20_000 + "</article>"), (7, "http://c/", "<article><p>same</p></article>"),
        (None, "http://c/", "<article><p>1 < 2 and 3 > 2</p></article>"), (8, "http://c/", "<main><p a='>' b=\">\">quoted</p></main><div class='cookie-notice'>ok</div>"),
    ]
    got = sorted(((r.page_id, r.text, r.n_chars) for r in W.main_text(clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()), key=repr)
    texts = [(1, ""), (2, ""), (3, "plain <text> é&"), (4, "cut of"), (5, "Only © this"), (6, ""), (7, "\n".join(["w"] * 20_000)), (7, "same"), (None, "1 < 2 and 3 > 2"), (8, "quoted")]
    assert got == sorted(((i, t, len(t)) for i, t in texts), key=repr)
    assert W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").limit(0)).count() == 0


def test_wrapper_is_union_free():
    wrapper = W.infer([page(i, i % 3 + 1) for i in range(6)])
    keys = [x["k"] for x in wrapper["nodes"]]
    assert sum(k.startswith("(<li>") for k in keys) == 1 and sum(k.startswith("(<p>") for k in keys) >= 1
    optional = [x["k"] for x in wrapper["nodes"] if x["o"]]
    assert "<header>" in optional and "<article>" not in optional
    kept = [x for x, _ in W._slots(wrapper["nodes"]) if x["v"]]
    assert kept and all(x["p"][2] == "article" for x in kept) and json.loads(json.dumps(wrapper)) == wrapper


def test_copies_of_a_page_are_no_frame():
    same = page(1, 4, article=False)
    assert W.extract(same, W.infer([same, same.replace("Title 1", "Title 9"), same.replace("©", "c")]), {}) == want(1, 4)


def test_wrappers_come_from_all_pages(spark):
    """What one page in 300 has, or changes, is in the wrapper; however the rows are dealt, it is the same."""
    rows = [(f"http://all.example/{i}", page(i, 2, extra={70: "<pre>once</pre>", 140: "<dl><dt>two</dt></dl>", 210: "<table><tr><td>3</td></tr></table>"}.get(i, ""))) for i in range(300)]
    df = spark.createDataFrame([(u, h.replace("Side", "Other side") if i == 33 else h) for i, (u, h) in enumerate(rows)], "url string, html string")
    (made,) = [json.loads(r.wrapper) for r in W.wrappers(df).collect()]
    optional = {x["k"] for x in made[0]["nodes"] if x["o"]}
    assert len(made) == 1 and {"<pre>", "<dl>", "<table>"} <= optional and "<article>" not in optional
    assert [x["t"] for x, _ in W._slots(made[0]["nodes"]) if x["p"][-1] == "aside"] == [None]
    assert [json.loads(r.wrapper) for r in W.wrappers(df.repartition(7), held=50).collect()] == [made]


def test_two_templates_of_a_host(spark):
    """One template has an article element, the other has none: neither decides for the other."""
    rows = [(i, "http://two.example/", page(i, i % 3 + 1, article=i % 20 == 0)) for i in range(60)]
    got = {r.page_id: r.text for r in W.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: want(i, i % 3 + 1) for i in range(60)}
