"""Toxicity, main text, mixing, the pipeline and the registered queries."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import html_text, mixing, queries, toxicity
from tests.llm.conftest import ODD
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def brute_segments(values):
    """All maximal-scoring segments by definition: the best span, then the same left and right of it."""
    def best(a, b):
        spans = [(sum(values[i : j + 1]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i, b) if sum(values[i : j + 1]) > 0]
        if not spans:
            return []
        s, _, _, i, j = max(spans)
        return best(a, i) + [(i, j, s)] + best(j + 1, b)

    return best(0, len(values))


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.choice([-1, -1, -1, 2, 3, 1]) for _ in range(rng.randint(0, 18))]
        places = [i for i, v in enumerate(values) if v > 0]
        got = toxicity.maximal_segments(places, [float(values[i]) for i in places], 1.0)
        assert sum(s for *_, s in got) == sum(s for *_, s in brute_segments(values))
        assert all(a2 > b1 for (_, b1, _), (a2, _, _) in zip(got, got[1:], strict=False))
        assert max((s for *_, s in got), default=0) == max((s for *_, s in brute_segments(values)), default=0)


def test_toxicity_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in scored if r.toxic == 1], [r for r in scored if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_toxicity_learns_from_training_rows_only(spark):
    rows = [(i, f"plain text number {i} " + ("vile foul nasty" if i % 4 == 0 else "kind fair nice"), int(i % 4 == 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("_held", toxicity.held_out("doc_id"))
    model = toxicity.fit(frame, frame.select("doc_id", "toxic"))
    flipped = frame.selectExpr("doc_id", "case when _held then 1 - toxic else toxic end as toxic")
    assert toxicity.fit(frame, flipped) == model
    got = toxicity.score_documents(frame, model).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in got)
    assert [p.first for p in next(r for r in got if r.doc_id == 4).passages] == [4]
    assert toxicity.without_toxic(frame, model).count() == 300


def test_toxicity_of_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    for rows in (odd, none):
        model = toxicity.fit(rows, labels)
        scored = toxicity.score_documents(rows, model).collect()
        assert len(scored) == rows.count() and all(0 <= r.score <= 1 for r in scored)
        assert toxicity.without_toxic(rows, model).columns == rows.columns
    assert toxicity.fit(odd, labels.limit(0)).weights == {}


ARTICLE = "This is the story of a man and of the sea, as it was told to us by the people who live in the town near the old harbour."
PAGE = f"""<html><head><title>no</title><script>var a="</p><p>no";</script><style>p{{}}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy the best of all, it is for you and it is the one you want to have in the house.</div>
<article><h1>Title &amp; more</h1><p><b>{ARTICLE}<br>{ARTICLE}</b><p>Short\n\t line&nbsp;here</p><aside>See also</aside><ul><li>one<li>two</ul>
<div class="comments"><p>{ARTICLE}</p></div><footer>share</footer></article><form><p>{ARTICLE}</p></form><div id=cookie-notice>{ARTICLE}</div><footer>&copy; x</footer>"""


def test_main_text():
    assert html_text.main_text(PAGE) == f"Title & more\n\n{ARTICLE} {ARTICLE}\n\nShort line here\n\none\n\ntwo"
    bare = f"<div>Home</div><div><a href=x>One link</a></div><p>{ARTICLE} {ARTICLE}</p><p>Short.</p><p>{ARTICLE} {ARTICLE}</p><div class=footer>{ARTICLE}</div>"
    assert html_text.main_text(bare).split("\n\n")[-3:] == [f"{ARTICLE} {ARTICLE}", "Short.", f"{ARTICLE} {ARTICLE}"]
    for broken in ("", "<", "<p", "</div></p>", "<script>x", "<!--", "<article>", "<a href='", "&#xZZ; &am", "<head><p>x"):
        assert isinstance(html_text.main_text(broken), str)
    assert html_text.main_text("<article><p>x &am &quot; &lt;b&gt;</article>") == 'x &am " <b>'


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "no-sidebar", "with-header", "page has-sidebar", "menu-page"])
def test_main_text_inside_named_wrappers(name):
    nav = "<nav><a href=x>Menu</a></nav>"
    side = f"<div class=sidebar><p>{ARTICLE}</p></div>"
    text = f"<p>{ARTICLE} {ARTICLE}</p><p>Short.</p><p>{ARTICLE}</p>"
    want = f"{ARTICLE} {ARTICLE}\n\nShort.\n\n{ARTICLE}"
    for page in (f"<main><article>{text}</article></main>{side}", f"<article class='post has-menu'>{text}</article>{side}", text):
        assert html_text.main_text(f"<body>{nav}<div class='{name}'>{page}</div></body>") == want
    assert html_text.main_text(f"<main>{nav}<div id='{name}'><article>{text}</article>{side}</div></main>") == want
    if name != "menu-page":
        assert html_text.main_text(f"<p>{ARTICLE}</p><div class='{name}'>{text}{side}</div>") == f"{ARTICLE}\n\n{want}"


def test_main_text_leaves_comments_and_hidden_articles_out():
    text = f"<article><p>{ARTICLE}</p><div class=comments><article><p>{ARTICLE}</p></article></div></article>"
    comment = f"<div id=comments><article class='comment even'><p>{ARTICLE}</p></article></div>"
    assert html_text.main_text(text + comment) == ARTICLE
    for certain in ("<nav>", "<form>", "<div hidden>", "<div style='display:none'>"):
        assert html_text.main_text(f"{certain}<div class=menu><article><p>{ARTICLE}</p></article></div>") == ""
    assert html_text.main_text(f"<div class=ad>{ARTICLE}</div><article><p>Short.</p></article>") == "Short."


def test_main_text_of_real_pages_and_odd_rows(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert rows[page.page_id].text == want and rows[page.page_id].n_chars == len(want)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", PAGE, "x"), (2, "u", PAGE, "x"), (3, "u", "<p>" * 50_000, "x")], "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in html_text.extract_text(odd).collect())[:3] == [0, 0, 0]
    assert html_text.extract_text(odd.limit(0)).count() == 0


def brute_targets(totals, weights, most=3):
    target, free, left = {}, dict(weights), sum(totals.values())
    while free:
        level = left / sum(free.values())
        full = [s for s in free if level * free[s] > most * totals[s]]
        if not full:
            return target | {s: level * w for s, w in free.items()}
        for s in full:
            target[s] = most * totals[s]
            left -= target[s]
            del free[s]
    return target


def test_mixing_of_odd_rows(odd, none):
    rows = mixing.document_demand(odd).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in ODD]
    assert sorted(r["size"] for r in rows) == sorted(size)
    totals: dict = {}
    for (_, _, _, source, _), n in zip(ODD, size, strict=True):
        totals[source] = totals.get(source, 0) + n
    ordered = sorted(s for s in totals if s is not None) + [None]
    want = brute_targets(totals, {s: i % 3 + 1 for i, s in enumerate(ordered)})
    for source in ordered:
        own = [r for r in rows if r["source"] == source]
        assert own[0].target == pytest.approx(want[source])
        assert abs(sum(r.taken for r in own) - want[source]) <= 1
        assert all(r.taken <= 3 * r["size"] for r in own)
    assert mixing.document_demand(none).count() == 0
    assert mixing.mixed_rows(none).count() == 0
    empty = odd.where("doc_id in (2, 3, 4)")
    assert {(r.target, r.taken) for r in mixing.document_demand(empty).collect()} == {(0.0, 0)}


def test_mixing_many_sources_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 40), f"s{min(rng.randint(0, 12), rng.randint(0, 12)):02d}") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    demand = mixing.document_demand(frame)
    got = {r["source"]: (r.target, r.taken) for r in demand.groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    totals: dict = {}
    for _, t, s in rows:
        totals[s] = totals.get(s, 0) + t.count("w")
    want = brute_targets(totals, {s: i % 3 + 1 for i, s in enumerate(sorted(totals))})
    for s, t in want.items():
        assert got[s][0] == pytest.approx(t) and abs(got[s][1] - t) <= 1


def test_curriculum_positions(spark):
    rows = [(i, "w " * 10, "early" if i % 2 else "late") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    demand = mixing.document_demand(frame, schedule=[[3, 1], [1, 3]])  # "early" is class 0
    order = [r["source"] for r in mixing.training_order(demand).select("doc_id", "position").join(frame, "doc_id").orderBy("position").collect()]
    first, second = order[: len(order) // 2], order[len(order) // 2 :]
    assert first.count("early") > 2 * first.count("late") and second.count("late") > 2 * second.count("early")
    places = [r.position for r in mixing.training_order(demand).collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    with pytest.raises(ValueError):
        mixing.document_demand(frame, schedule=[[1, 0]])


def test_mixed_rows_repeat_whole_documents(spark, odd):
    rows = [(i, "w " * 10, "a" if i < 10 else "b" if i < 300 else "c") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = {r["source"]: r["count"] for r in mixing.mixed_rows(frame).groupBy("source").count().collect()}
    want = brute_targets({"a": 100, "b": 2900, "c": 3000}, {"a": 1, "b": 2, "c": 3})
    assert {s: abs(counts[s] - t / 10) <= 1 for s, t in want.items()} == {"a": True, "b": True, "c": True}
    mixed = mixing.mixed_rows(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_cover_their_table(spark, name):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    table = "pages" if name.startswith("op4") else "documents"
    want = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count()
    assert (got.count() if not name.startswith("op5") else got.selectExpr("explode(doc_ids) d").distinct().count()) == want


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(spark, frames[-1], SF).cache())
        assert frames[-1].columns == docs.columns
    toxic, exact, near, mixed = ([r.doc_id for r in f.collect()] for f in frames[1:])
    assert sum(labels.get(i, 0) for i in toxic) < 0.4 * sum(labels.values())
    norms = [re.sub(r"\s", "", seen[i]) for i in exact]
    assert len(norms) == len(set(norms)) == len({re.sub(r"\s", "", seen[i]) for i in toxic})
    assert set(near) <= set(exact) and len(near) == len(set(near)) and set(mixed) <= set(near)
    assert corpus_pipeline.STAGES[-1][1](spark, frames[-1], SF).count() == len(mixed)
    for f in frames[1:]:
        f.unpersist()


TURKISH = "Sabahları erkenden uyanan çocuklar bahçede koşarken komşular kahvelerini içip gazetelerini okuyordu. " * 4
CHINESE = "春天来了，花园里的树木都长出了新的叶子，孩子们在阳光下奔跑，老人们坐在长椅上聊天。" * 5


@pytest.mark.parametrize("body", [TURKISH.strip(), CHINESE])
def test_main_text_in_other_languages(body):
    nav = "<ul class=menu>" + "".join(f"<li><a href=/{i}>Sayfa {i}</a>" for i in range(12)) + "</ul>"
    page = f"<html><body>{nav}<div><p>{body}</p><p>{body}</p></div><div id=footer><p>{body}</p></div></body></html>"
    assert html_text.main_text(page) == f"{body}\n\n{body}"


def test_nested_inline_furniture_stays_closed():
    for inner in ("<span>now</span>", "<b><span>now</span></b>", "<span><span>now</span> and</span>", "<span/>"):
        page = f"<article><p>{ARTICLE}</p><p>Keep <span class='ad'>Buy {inner} cheap pills</span> this.</p></article>"
        assert html_text.main_text(page) == f"{ARTICLE}\n\nKeep\n\nthis."
    page = f"<p>{ARTICLE}<span class=comment>He said <span>no</span> to <em>it <span>all</span></em> today</span></p>"
    assert html_text.main_text(page) == ARTICLE.strip()


def test_tags_end_outside_quotes():
    assert html_text.main_text("<p title='a > b'>x</p>") == ""
    assert [t[3:] for t in html_text.tags("<p a='>'>x<b \">y</b>")] == [("p", " a='>'"), ("b", ' "'), ("b", "")]
    assert [t[3] for t in html_text.tags("a < b <3 <!-- <p> --> <!x> <i")] == ["", ""]


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<a '\"", "<div></p>", "<div><span></b>", "<", "<!--", "<!", "<b>", "&amp;", "<p class='", "<a \">\"", "<script ", "</x"])
def test_time_grows_with_the_page(piece):
    import time

    def seconds(size: int) -> float:
        page = piece * (size // len(piece))
        start = time.perf_counter()
        html_text.page_blocks(page)
        return time.perf_counter() - start

    small, large = min(seconds(100_000) for _ in range(2)), seconds(800_000)
    assert large < 2 or large < 20 * small


def test_mixed_rows_answer_for_themselves(spark):
    rows = [(1, "a b c", "x", 1), (1, "a b c", "y", 2), (1, "a b c", "y", 3), (1, "a b c", "y", 3), (None, "d e", None, 4), (None, "d e", None, 5), (2, "f", "x", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(3)
    runs = [sorted(map(str, mixing.mixed_rows(f, schedule=[[1]], most_passes=1).collect())) for f in (frame, frame.repartition(1))]
    assert runs[0] == runs[1] == sorted(map(str, frame.collect()))  # every source is asked for all its words once
    twice = mixing.mixed_rows(frame.where("source is not null"), schedule=[[1, 1]]).collect()
    assert {r.extra for r in twice} >= {1, 6}


def test_registered_schedule_has_several_steps_with_the_asked_integrals():
    assert len(mixing.CURRICULUM) > 1 and [sum(s[i] for s in mixing.CURRICULUM) / 2 for i in range(3)] == [1, 2, 3]
    assert mixing.CURRICULUM[0] != mixing.CURRICULUM[1]


def test_training_rows_are_bounded_by_ids(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(0, 1)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"text {i} {k}") for i in range(12) for k in range(50)], "doc_id long, text string")
    all_rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 100)
    free = [r._id for r in labels.select(F.col("doc_id").alias("_id"), toxicity.held_out("doc_id").alias("h")).where("not h").distinct().collect()]
    assert all_rows.count() == len(free)
    assert toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", 3).count() == 3


def test_copies_of_one_text_are_one_witness(spark):
    rng = random.Random(2)
    clean = [" ".join(rng.choice("the cat sat on a mat and dog ran far".split()) for _ in range(40)) for _ in range(300)]
    copied = "unrelated words stand in this copied toxic text " + " ".join(rng.choice("the cat sat".split()) for _ in range(30))
    toxic = [copied] * 100 + [f"{rng.choice(clean)} vilest {rng.choice(clean)}" for _ in range(40)]
    rows = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in clean], "_text string, _toxic int")
    weights = toxicity.feature_weights(rows)
    assert " vilest" in weights and not {" unrelated", " copied", " stand"} & set(weights)
