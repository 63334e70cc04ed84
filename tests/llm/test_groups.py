"""Exact copies, SimHash groups, Order MinHash and url aliases beside brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
import xxhash

from tarmac.llm import components, exact_dedup, order_minhash, simhash, url_rules
from tests.llm.conftest import ODD


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, k) for k in range(1, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    frame = spark.createDataFrame(edges + [(5, 5), (None, 3)], "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(frame).collect()}
    pairs = {frozenset(e) for e in edges if e[0] != e[1]}
    want = brute_components({n for p in pairs for n in p}, lambda a, b: frozenset((a, b)) in pairs)
    assert got == want
    assert components.connected_components(frame.limit(0)).count() == 0


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_near(rows, texts):
    prints = {t: brute_fingerprint(t) for _, t in texts}
    of = brute_components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    least: dict = {}
    for i, t in texts:
        if i is not None:
            root = of[prints[t]]
            least[root] = min(i, least.get(root, i))
    want = sorted((str(i), f"{prints[t]:016x}", str(least.get(of[prints[t]]))) for i, t in texts)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def test_near_groups_of_odd_rows(odd, none):
    check_near(simhash.near_groups(odd).collect(), [(i, t) for i, t, *_ in ODD])
    assert simhash.near_groups(none).count() == 0
    assert simhash.without_near_copies(none).count() == 0


@pytest.mark.parametrize("hot", [1000, 2])
def test_near_groups_of_variants(spark, hot):
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(120)) for _ in range(4)]
    texts = [(i, " ".join("zz" if rng.random() < 0.01 else w for w in base[i % 4].split())) for i in range(160)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    check_near(simhash.near_groups(frame, hot=hot).collect(), texts)
    kept = simhash.without_near_copies(frame, hot=hot).collect()
    groups = {r.component_id for r in simhash.near_groups(frame, hot=hot).collect()}
    assert {r.doc_id for r in kept} == groups and len(kept) == len(groups)


def test_flipped_values(spark):
    found = simhash._flipped(spark.createDataFrame([(0,), (-1,), (1 << 62,)], "_fp long")).collect()
    assert len({(r._fp, r._v) for r in found}) == len(found) == 3 * (1 + 64 + 64 * 63 // 2)
    assert all(((r._fp ^ r._v) & (1 << 64) - 1).bit_count() == r._flips for r in found)


@pytest.mark.parametrize("hot", [1000, 1])
def test_links_of_planted_fingerprints(spark, hot):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base}
    for _ in range(60):
        v = rng.choice(sorted(values))
        for b in rng.sample(range(64), rng.randint(1, 4)):
            v ^= 1 << b
        values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "_fp long"), hot)
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    want = brute_components([v for (v,) in signed], lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {n: got.get(n, n) for (n,) in signed} == want


def brute_exact(texts):
    groups: dict = {}
    for i, t in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        out += [(str(i), str(best[0]), len(rows), hashlib.sha256(norm.encode()).hexdigest()) for i, _ in rows]
    return sorted(out), len(groups)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_exact_groups(odd, none, monkeypatch, bound):
    monkeypatch.setattr("tarmac.llm.joins.BROADCAST_BYTES", bound)
    rows = exact_dedup.exact_groups(odd, digest_all=True).collect()
    want, groups = brute_exact([(i, t) for i, t, *_ in ODD])
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows) == want
    assert sum(r.kept for r in rows) == groups
    assert all(r.kept <= (r.doc_id == r.keep_id) for r in rows)
    assert exact_dedup.exact_groups(none).count() == 0


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_rows_without_copies(odd, none, monkeypatch, bound):
    monkeypatch.setattr("tarmac.llm.joins.BROADCAST_BYTES", bound)
    kept = exact_dedup.without_copies(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    _, groups = brute_exact([(i, t) for i, t, *_ in ODD])
    norms = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in rows]
    assert len(norms) == len(set(norms)) == groups
    assert exact_dedup.without_copies(none).count() == 0


def test_order_minhash_of_odd_rows(odd, none):
    rows = order_minhash.fingerprints(odd).collect()
    ordered = sorted(((i, t or "") for i, t, *_ in ODD if i is not None), key=lambda r: -r[0])
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows if r.doc_id is not None)
    want = []
    for (i, text), (_, following) in zip(ordered, ordered[1:], strict=False):
        half = len(text) // 2
        want.append((i, len(text), hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()))
    assert [g for g in got if g[0] != 1] == sorted(want)  # the next of the smallest id has a null id
    assert len(rows) == len(ODD)
    same = {r.fingerprint for r in rows if r.doc_id in (1, 8)}
    assert len(same) == 1
    assert by_id[2].fingerprint == "" and by_id[4].near_next == 1.0  # followed by an empty text
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert order_minhash.fingerprints(none).count() == 0


def test_single_document_follows_itself(spark):
    row = order_minhash.fingerprints(spark.createDataFrame([(7, "a b c d e f g h")], "doc_id long, text string")).first()
    assert row.near_next == 1.0


def test_likeness_falls_with_edits_and_order(spark):
    rng = random.Random(6)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(2000)]
    few = ["x" if i % 200 == 7 else w for i, w in enumerate(words)]
    many = ["x" if i % 10 == 7 else w for i, w in enumerate(words)]
    shuffled = [w for _, w in sorted(zip([rng.random() for _ in range(20)] * 100, words, strict=True))]
    rows = [(i, " ".join(w)) for i, w in enumerate((words, few, many, shuffled))]
    frame = order_minhash.with_sketch(spark.createDataFrame(rows, "i long, t string"), "t", "s").select("i", "s")
    base = frame.where("i = 0").selectExpr("s as b")
    got = {r.i: r.near for r in frame.crossJoin(base).select("i", order_minhash.likeness("s", "b").alias("near")).collect()}
    assert got[0] == 1.0 and got[0] > got[1] > got[2] and got[1] > 0.5 > got[3]


def test_repeats_are_numbered(spark):
    rows = [(0, "a b c d e " * 3), (1, "a b c d e " * 4), (2, "a b c d e " * 3)]
    got = {r.i: r.s for r in order_minhash.with_sketch(spark.createDataFrame(rows, "i long, t string"), "t", "s").collect()}
    assert got[0] == got[2] != got[1]


def test_fingerprints_do_not_depend_on_blocks(odd, monkeypatch):
    one = {tuple(r) for r in order_minhash.fingerprints(odd).collect()}
    monkeypatch.setattr(order_minhash, "BLOCK_IDS", 2)
    assert {tuple(r) for r in order_minhash.fingerprints(odd).collect()} == one


PAGES = [
    (1, "http://a.net/x", '<link rel="canonical" href="http://b.info/y">'),
    (2, "http://b.info/y#q", None),
    (3, "http://c.info/", "<META http-equiv=refresh content='0; url=http://b.info/y'>"),
    (4, "http://d.info/p/q?x=1", '<link href="/z" rel="canonical">'),
    (5, "http://d.info/z", "<link href=http://example.net/en/1 rel=canonical>"),
    (6, None, None),
    (7, "nourl", ""),
    (8, "HTTP://E.Net", ""),
    (9, "https://sub.Example.com/de/x?y", ""),
    (10, "http://d.info/p/r", '<link rel=canonical href="q2">'),
    (11, "http://d.info/p/q2", '<link rel=canonical href="//k.net/">'),
    (1, "http://a.net/x", None),
    (12, "http://notnet/", ""),
    (13, "http://x.org/fr/", ""),
]


def test_urls(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumnRenamed("page_id", "page_id")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(frame).collect()}
    assert got == {
        1: ("a.net", "/x", "net/", "block"), 2: ("b.info", "/y", None, "block"), 3: ("c.info", "/", None, "block"),
        4: ("d.info", "/p/q", None, "allow"), 5: ("d.info", "/z", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("e.net", "", None, "allow"), 9: ("sub.example.com", "/de/x", "example.com/de/", "block"), 10: ("d.info", "/p/r", None, "block"),
        11: ("d.info", "/p/q2", None, "block"), 12: ("notnet", "/", None, "allow"), 13: ("x.org", "/fr/", "org/fr/", "allow"),
    }
    assert url_rules.judge_urls(frame).count() == len(PAGES)
    assert url_rules.judge_urls(frame.limit(0)).count() == 0


def test_urls_explicit_allow_and_crawl_log(spark):
    frame = spark.createDataFrame([(1, "http://a.info/", None), (2, "http://b.info/", None)], "page_id long, url string, html string")
    log = spark.createDataFrame([("http://a.info", "http://x.net/"), ("http://x.net/", "http://example.net/en/"), ("http://b.info/", "http://y.net/q")], "src string, dst string")
    assert {r.page_id: r.verdict for r in url_rules.judge_urls(frame, redirects=log).collect()} == {1: "allow", 2: "block"}
    with pytest.raises(ValueError):
        url_rules.judge_urls(frame, rules=[("a", "/", "maybe")])


@pytest.mark.parametrize(
    "url, base, link, src, dst",
    [
        ("http://a.net/p/q/r", "", "../x", "http://a.net/p/q/r", "http://a.net/p/x"),
        ("http://a.net/p/q", "", "./x", "http://a.net/p/q", "http://a.net/p/x"),
        ("http://a.net/p/q", "", "../../%2E%2e/x/./y/..", "http://a.net/p/q", "http://a.net/x/"),
        ("http://a.net/p/q?old=1", "", "?id=5", "http://a.net/p/q?old=1", "http://a.net/p/q?id=5"),
        ("http://a.net", "", "?id=5", "http://a.net/", "http://a.net/?id=5"),
        ("http://a.net/p/q", "/b/c/", "x", "http://a.net/p/q", "http://a.net/b/c/x"),
        ("http://a.net/p/q", "http://b.net/d/e", "../x", "http://a.net/p/q", "http://b.net/x"),
        ("http://a.net/p/q", "", "/x?a=1&#38;b&#x3d;2&amp;c=3&d&#0;", "http://a.net/p/q", "http://a.net/x?a=1&b=2&c=3&d\ufffd"),
        ("http://a.net/p/q", "", "/caf&eacute;&#x1F642;&no;", "http://a.net/p/q", "http://a.net/café🙂&no;"),
        ("http://a.net/p/q", "", "/in?next=http://b.net/z", "http://a.net/p/q", "http://a.net/in?next=http://b.net/z"),
        ("http://a.net/a/../b", "", "/c", "http://a.net/b", "http://a.net/c"),
    ],
)
def test_link_targets(spark, url, base, link, src, dst):
    head = f'<base href="{base}">' if base else ""
    for tag in (f'<link rel="canonical" href="{link}">', f'<meta http-equiv="refresh" content="0; url={link}">'):
        pages = spark.createDataFrame([(1, url, head + tag)], "page_id long, url string, html string")
        assert [tuple(r) for r in url_rules.alias_edges(pages).select("src", "dst").collect()] == [(src, dst)]


@pytest.mark.parametrize("as_table", [False, True])
def test_long_rule_lists_are_joined_with_the_same_result(spark, monkeypatch, as_table):
    rng = random.Random(4)
    hosts = ["net", "example.net", "a.example.net", "org", "b.org", "com"]
    rules = sorted({(rng.choice(hosts), rng.choice(["", "/", "/a", "/a/", "/a/b", "/é/"]), rng.choice(["allow", "block"])) for _ in range(25)})
    urls = [f"http://{rng.choice(['', 'x.', 'www.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/ab/c', '/a/b/c', '/é/x'])}?q" for _ in range(150)] + ["", None, "no url", "http:///a"]
    pages = spark.createDataFrame([(i, u, f"<link rel=canonical href='{urls[i - 1]}'>" if i % 9 == 1 else None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    inline = sorted(str(tuple(r)) for r in url_rules.judge_urls(pages, rules).collect())
    monkeypatch.setattr(url_rules, "INLINE_RULES", 0)
    listed = spark.createDataFrame(rules, "host string, path string, verdict string") if as_table else rules
    assert sorted(str(tuple(r)) for r in url_rules.judge_urls(pages, listed).collect()) == inline
    with pytest.raises(ValueError):
        url_rules.judge_urls(pages, [("a", "/", "maybe")])


def test_only_markup_and_immediate_redirects_make_links(spark):
    link = '<link rel="canonical" href="http://bad.net/">'
    hidden = [f"<!-- {link} -->", f"<!-- {link}", f"<script>var a = '{link}';</script>", f"<script src=x>{link}", f"<textarea>{link}</textarea>", f"<STYLE>{link}</sTyle >", "<meta http-equiv=refresh content='5; url=http://bad.net/'>", f"<title>{link}</title>"]
    shown = [link, f"<!-- x --> {link}", f"<script></script>{link}<!-- y -->", "<meta http-equiv=refresh content='0; url=http://bad.net/'>", "<meta http-equiv=Refresh content='0.5;URL=http://bad.net/'>"]
    rows = [(i, f"http://p{i}.com/", h) for i, h in enumerate(hidden + shown)]
    got = {r.page_id: r.verdict for r in url_rules.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "allow" if i < len(hidden) else "block" for i in range(len(rows))}


def test_chains_and_hubs_of_links(spark):
    """A long chain and a hub of many pages, with repeated links; the block at one end reaches all."""
    n = 300
    rows = [(i, f"http://c{i}.com/", f"<link rel=canonical href=http://c{i + 1}.com/>" * 2) for i in range(n)] + [(n, f"http://c{n}.com/", "<link rel=canonical href=http://x.net/>")]
    rows += [(1000 + i, f"http://h{i}.com/", "<link rel=canonical href=http://hub.org/fr/a>") for i in range(n)] + [(5000, "http://alone.com/", None)]
    got = {r.page_id: r.verdict for r in url_rules.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_id", F.lit("clash")).withColumn("verdict", F.lit("clash"))).collect()}
    assert {got[i] for i in range(n + 1)} == {"block"} and {got[1000 + i] for i in range(n)} == {"allow"} and got[5000] == "allow"
