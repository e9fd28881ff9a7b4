"""Operators that compare rows: line dedup, URL filter, wrappers, n-gram join,
top-k search, packing, and the pipeline over them."""

import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P

from quillfeed.llm import line_dedup, ngram_join, packing, topk, url_filter, wrapper
from quillfeed.session import cut_lineage

DOCS = "doc_id long, text string"


# -- line dedup -------------------------------------------------------------------
def brute_lines(docs):
    """Exact masked lines only (no two lines of the data share a leaf otherwise)."""
    first = {}
    for i, t in docs:
        for x in (t or "").encode().split(b"\n"):
            k = b" ".join(line_dedup.masked_tokens(x))
            if i is not None and len(k.split()) >= line_dedup.MIN_TOKENS:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        keep = [x for x in (t or "").encode().split(b"\n")
                if i is None or first.get(b" ".join(line_dedup.masked_tokens(x)), i) == i]
        out.append((i, b"\n".join(keep).decode()))
    return sorted(out, key=repr)


def test_line_dedup_matches_brute_force_with_edge_rows(spark):
    docs = [
        (5, "alpha beta gamma delta epsilon\nshort one\nversion 3 of the tool came out"),
        (2, "version 17 of the tool came out\nalpha beta gamma delta epsilon"),
        (9, "alpha beta gamma delta epsilon"), (9, "alpha beta gamma delta epsilon"),
        (1, None), (3, ""), (None, "alpha beta gamma delta epsilon"), (7, "only here stands this line\n\n"),
        (11, "z " * 5000 + "\nalpha beta gamma delta epsilon"),
    ]
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], DOCS + ", key int, leaf string")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.dedup_lines(frame).collect()), key=repr)
    assert got == brute_lines(docs)
    kept = line_dedup.filter_documents(frame)
    assert kept.columns == frame.columns
    assert 9 not in {r.doc_id for r in kept.collect()}  # lost all its text
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_line_dedup_generalises_variable_fields(spark):
    lines = [f"today a user {n} logged in from the office" for n in ("alice", "bob", "carol", "dave")]
    docs = [(i, f"{x}\na line of its own number {chr(97 + i) * 5} {chr(98 + i) * 4} here") for i, x in enumerate(lines)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert [i for i in sorted(got) if "logged in" in got[i].text] == [0]
    assert [i for i in sorted(got) if "line of its own" in got[i].text] == [0]  # two fields of nine tokens


def test_line_dedup_has_one_similarity_for_all_lengths(spark):
    """The same share of differing tokens decides alike for short, middling and long lines."""
    for n, step in ((8, 1), (12, 1), (15, 1), (16, 1), (17, 1), (32, 2), (160, 10)):
        words = ["the", "same", "start", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n - 3))]
        for few, drops in ((0.2, True), (0.3, False)):
            other = [*words]
            # Differences side by side, in whole segments from the end.
            changed = int(few * n) // step if drops else -(-(int(few * n) + 1) // step)
            for k in range(max(1, changed) * step):
                other[-1 - k] = f"x{other[-1 - k]}"
            docs = [(1, " ".join(words)), (2, " ".join(other))]
            got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(docs, DOCS)).collect()}
            assert got == {1: 0, 2: int(drops)}, (n, few)
    apart = ["in the morning the cat sat quietly beside the warm stove and looked at the grey rain",
             "in the morning the cat sat quietly beside an old man who told us about his war"]
    alike = ["today a user {} logged in from {} office".format(*x) for x in (("ann", "paris"), ("bob", "rome"))]
    docs = list(enumerate(apart + alike))
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1}


def test_line_dedup_several_fields_and_short_lines(spark):
    long = [f"t{i}" for i in range(200)]
    long = ["some", "long", "line", *("".join(chr(97 + int(c)) for c in x[1:]) + "w" for x in long)]
    other = [*long]
    other[50], other[150] = "changed", "words"
    text = "today a user {} logged in from the {} office by way of the {} gate and stayed there"
    groups = [
        [text.format("alice", "paris", "north"), text.format("bob", "london", "south")],
        [" ".join(long), " ".join(other)],
        ["All rights reserved.", "All  rights reserved."],
    ]
    apart = [["today a user alice was sent home again early and then nobody saw them for a long time"],
             ["Chapter 12 ends", "Chapter 13 ends"], ["Yes.", "Yes."]]
    docs = [(2 * k + i, x) for k, pair in enumerate(groups + apart[1:]) for i, x in enumerate(pair)]
    docs += [(100, apart[0][0])]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert sorted(i for i, n in got.items() if n) == [1, 3, 5]


def brute_templates(lines):
    """Numbers of the lines (number = doc_id) of one leaf that are alike the first
    line of one of their templates, on the tokens themselves."""
    words = [x.split() for x in lines]
    n = len(words[0])
    m = min(n, 16)
    segs = [[tuple(w[i * n // m:(i + 1) * n // m]) for i in range(m)] for w in words]
    place = [i * min(m, 8) // m for i in range(m)]
    may_differ = m - -(-3 * m // 4)
    found = set()
    for out in itertools.combinations(range(max(place) + 1), may_differ):
        first = {}
        for i, s in enumerate(segs):
            f = first.setdefault(tuple(x for x, g in zip(s, place) if g not in out), i)
            if f != i and sum(x == y for x, y in zip(s, segs[f])) >= m - may_differ:
                found.add(i)
    return sorted(found)


def test_line_dedup_large_leaf_matches_brute_force(spark):
    rng = random.Random(8)
    for n in (8, 40):
        lines = []
        for k in range(1500):
            words = [f"{rng.choice('abcdefgh')}{rng.choice('xyz')}q"[:3] for _ in range(n - 3)]
            lines.append(" ".join(["server", "log", "entry", *words]))
            if k % 5 == 0:
                words[rng.randrange(n - 3)] = "other"
                lines.append(" ".join(["server", "log", "entry", *words]))
        rng.shuffle(lines)
        want = brute_templates(lines)
        assert 200 < len(want) < len(lines)
        rows = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), DOCS)).collect()
        assert sorted(r.doc_id for r in rows if r.n_dropped) == want


# -- URL filter --------------------------------------------------------------------
def test_url_filter_rules_and_exact_listing(spark):
    urls = [None, "", "no scheme", "http://A.example.ORG/es/x", "http://example.org/en/12", "http://b.com/fr/1", "http://b.com/de/1",
            "http://com/de/", "http://xcom/de/", "http://www.bad.net/p/?utm_source=a&b=2&a=1#f", "https://bad.net/p?a=1&b=2",
            "http://bad.net/q", "http://x.org", "ftp://q.org/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("http://bad.net/p?b=2&a=1",), (None,), ("http://bad.net/p?b=2&a=1",)], "url string")
    for blocks in (1, 64):  # with one block nearly everything is a possible hit
        got = {r.page_id: r for r in url_filter.filter_urls(pages, listed, blocks=blocks).collect()}
        assert len(got) == len(urls)
        want = {3: ("example.org/es/", "block"), 4: ("example.org/en/1", "block"), 5: ("com/fr/", "allow"), 6: ("com/de/", "block"),
                7: ("com/de/", "block"), 8: (None, "allow"), 9: (None, "block"), 10: (None, "block"), 11: (None, "allow"),
                12: (None, "allow"), 13: ("org/", "allow"), 0: (None, "allow"), 1: (None, "allow"), 2: (None, "allow")}
        assert {i: (r.rule, r.verdict) for i, r in got.items()} == want
        assert got[0].host == "" and got[2].path == "" and got[3].host == "a.example.org"
        assert [i for i, r in got.items() if r.listed] == [9, 10]
    empty = spark.createDataFrame([], "url string")
    assert url_filter.filter_urls(pages, empty).where("listed").count() == 0


# -- wrappers ----------------------------------------------------------------------
def test_extract_page_drops_furniture_and_keeps_the_article():
    page = ('<html><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><main><article class="post">'
            '<h1>Title &amp; more</h1><p>One<br>two &lt;b&gt; 1 < 2</p><aside>rel</aside><ul><li>a<li>b</ul>'
            '<section class="comments"><p>nice</p></section><p>Last&nbsp;one <b>bold</i></p></article></main>'
            '<footer>f</footer><script>if(a<b){"</p>"}</script></body></html>')
    assert wrapper.extract_page(page) == "Title & more\n\nOne two <b> 1 < 2\n\na\n\nb\n\nLast one bold"
    assert wrapper.extract_page(None) == wrapper.extract_page("") == ""
    assert wrapper.extract_page("plain words") == "plain words"


def test_extract_page_keeps_text_in_wrappers_named_like_furniture():
    article = "<article><p>The text of the article, with some words.</p></article>"
    body = "<p>The text of the article, with some words.</p>"
    for inner in (article, body):
        for wrap in ('class="content no-sidebar"', 'id="page" class="has-banner"', 'class="post tags-on"', 'class="withComments page"'):
            page = f'<body><header>Site</header><div {wrap}>{inner}<div class="banner">Buy</div></div><footer>f</footer></body>'
            assert wrapper.extract_page(page) == "The text of the article, with some words."
    page = f'<body><div class="tags-on"><main>{body}</main></div><div>{"A list of links. " * 20}</div></body>'
    assert wrapper.extract_page(page) == "The text of the article, with some words."
    page = f'<body>{body}<div class="comments"><p>{"A long comment. " * 20}</p></div><div class="sidebar">Links</div></body>'
    assert wrapper.extract_page(page) == "The text of the article, with some words."


def test_simple_tree_matching_equals_brute_force():
    def best(a, b):
        if a[0] != b[0]:
            return 0
        table = np.zeros((len(a[1]) + 1, len(b[1]) + 1), int)
        for i, j in itertools.product(range(len(a[1])), range(len(b[1]))):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + best(a[1][i], b[1][j]))
        return 1 + table[-1, -1]

    rng = random.Random(5)

    def tree(depth):
        return [rng.choice("ab"), [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []]

    def flat(t):
        signs, parents, todo = [], [], [(t, -1)]
        while todo:
            node, parent = todo.pop()
            todo += [(c, len(signs)) for c in reversed(node[1])]
            signs.append(node[0])
            parents.append(parent)
        return signs, parents

    for _ in range(100):
        a, b = tree(3), tree(3)
        pairs = wrapper.simple_tree_matching(flat(a), flat(b))
        assert len(pairs) == best(a, b)
        assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)


def test_wrapper_drops_text_that_is_the_same_on_all_pages(spark):
    page = '<body><div><p>{}</p></div><div id="x"><span>Same slogan on every page</span></div></body>'
    rows = [(i, f"http://h.org/{i}", page.format(f"Body text number {i}")) for i in range(5)]
    rows += [(10 + i, f"http://copies.org/{i}", page.format("One and the same text")) for i in range(4)]
    rows += [(20, None, None), (21, "http://h.org/9", ""), (None, "http://h.org/9", page.format("No id"))]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in wrapper.extract_main_text(pages).collect()}
    assert got[3] == "Body text number 3" and got[None] == "No id"
    assert got[11] == "One and the same text\n\nSame slogan on every page"  # all template: kept
    assert got[20] == got[21] == ""
    assert wrapper.extract_main_text(spark.createDataFrame([], pages.schema)).count() == 0


def texts_of(spark, pages, **more):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrapper.extract_main_text(df, **more).collect()}


def test_pages_may_be_nested_to_any_depth(spark):
    deep = "<body>" + "<div>" * 50_000 + "<p>at the bottom</p>" + "</div>" * 50_000
    pages = [(i, f"http://deep.org/{i}", deep) for i in range(4)] + [(9, "http://deep.org/x", "<ul><li>" * 20_000 + "<p>x</p>"),
                                                                   (10, None, "<article>" * 3_000 + "<p>y</p>")]
    got = texts_of(spark, pages)
    assert got == {0: "at the bottom", 1: "at the bottom", 2: "at the bottom", 3: "at the bottom", 9: "x", 10: "y"}


def test_each_layout_of_a_host_has_its_own_wrapper(spark):
    one = "<body><table><tr><td>Read this notice of layout one</td></tr></table><div><p>Story {0}</p><p>More of {0}</p></div></body>"
    two = "<body><div><p>Tale {0}</p></div><ul><li>Read this notice of layout two</li></ul></body>"
    pages = [(i, f"http://two.org/{i}", (one if i % 3 else two).format(i)) for i in range(30)]
    got = texts_of(spark, pages)
    assert got == {i: f"Story {i}\n\nMore of {i}" if i % 3 else f"Tale {i}" for i in range(30)}
    off = texts_of(spark, pages, min_pages=10 ** 9)  # without induction the notices stay
    assert off[1].startswith("Read this notice") and off[0].endswith("layout two")


def test_one_page_of_two_hundred_that_words_its_notice_differently(spark):
    page = "<body><div><p>Story {0}</p><p>{1}</p><p>End of {0}</p></div></body>"
    pages = [(i, f"http://many.org/{i}", page.format(i, "Please subscribe to our letter" if i != 77 else "Subscribe now!")) for i in range(200)]
    got = texts_of(spark, pages)
    assert {i for i, t in got.items() if t == f"Story {i}\n\nEnd of {i}"} == set(range(200)) - {77}
    assert got[77] == "Story 77\n\nSubscribe now!\n\nEnd of 77"


def test_extraction_equals_brute_force_on_templated_hosts(spark):
    """Own parser, paths instead of alignments: blocks that stand at one path on nine tenths of a layout's pages go."""
    from collections import Counter
    from html.parser import HTMLParser

    rng = random.Random(8)
    pages = []
    for host in range(4):
        before = [f"<div><p>Constant {host} {k}</p></div>" for k in range(rng.randint(1, 3))]
        for i in range(25):
            story = "".join(f"<p>{rng.choice(['one', 'two'])} {host} {i} {k}</p>" for k in range(rng.randint(1, 4)))
            odd = f"<ol><li>{'Sometimes' if rng.random() < 0.7 else f'Else {i}'}</li></ol>"
            end = f"<ul><li>End of host {host}</li></ul>" if host % 2 else ""
            pages.append((host * 100 + i, f"https://h{host}.net/p/{i}", f"<html><body>{''.join(before)}<blockquote>{story}</blockquote>{odd}{end}</body></html>"))

    class Blocks(HTMLParser):
        def __init__(self):
            super().__init__()
            self.path, self.found, self.top = [], [], []

        def handle_starttag(self, tag, _):
            self.path.append(tag)
            if len(self.path) == 3:
                self.top.append(tag)

        def handle_endtag(self, _):
            self.path.pop()

        def handle_data(self, data):
            self.found.append((tuple(self.path), data))

    parsed, groups, counts = {}, Counter(), Counter()
    for i, url, html in pages:
        p = Blocks()
        p.feed(html)
        runs = tuple(t for k, t in enumerate(p.top) if not k or p.top[k - 1] != t)
        parsed[i] = (url.split("/")[2], runs), p.found
        groups[parsed[i][0]] += 1
        counts.update((parsed[i][0], b) for b in set(p.found))
    want = {i: "\n\n".join(t for path, t in found if counts[g, (path, t)] < max(3, 0.9 * groups[g])) for i, (g, found) in parsed.items()}
    assert texts_of(spark, pages) == want
    assert any("Sometimes" in t for t in want.values()) and not any("Constant" in t or "End of" in t for t in want.values())


# -- n-gram join ---------------------------------------------------------------------
def brute_components(docs, size=3, percent=90):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and docs[i][0] is not None and docs[j][0] is not None and 100 * both >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(docs):
        out.append((d, len(sets[i]), min((docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None), default=None)))
    return sorted(out, key=repr)


def test_ngram_join_matches_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    docs, n = [], 0
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(rng.choice([1, 3, 14])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append((n, " ".join(copy)))
            n += 1
    docs += [(900, None), (901, ""), (902, "one two"), (903, "ONE  two"), (None, docs[0][1]), (904, "É x y"), (905, "é x y"), (docs[0][0], docs[0][1])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], DOCS + ", n int")
    want = [(d, k, c if d is not None else None) for d, k, c in brute_components(docs)]
    for sizes in ({}, {"tile": 8, "small_block": 3}):  # also with blocks that go through the tree and several tiles
        got = sorted((tuple(r) for r in ngram_join.near_duplicates(frame, **sizes).collect()), key=repr)
        assert got == sorted(want, key=repr)
    kept = ngram_join.filter_documents(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for d, _, c in want if d is not None and c is not None}) and ids.count(None) == 1
    assert ngram_join.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


# -- top-k ---------------------------------------------------------------------------
def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)]) for i in range(230)]
    rows += [(300 + i, rows[0][1]) for i in range(8)]  # ties
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")]), (550, [float("inf")]), (None, [1.0]), (600, []), (650, [0.5, 1e9])]
    rows.append(rows[50])
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    good = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (i for i in good if i % 50 == 0):
        s = sorted((-sum(a * b for a, b in zip(good[q], good[d])), d) for d in good if d != q)[:5]
        want += [(q, r + 1, d, -x) for r, (x, d) in enumerate(s)]
    assert sorted(tuple(r) for r in topk.top_k(frame, unit=40, block=7).collect()) == sorted(want)
    assert sorted(tuple(r) for r in topk.top_k(frame.repartition(7), unit=16, block=4).collect()) == sorted(want)
    assert topk.top_k(frame.where("vec_id = 50")).count() == 0
    assert topk.top_k(spark.createDataFrame([], frame.schema)).count() == 0


def test_top_k_keeps_bounds_in_their_tasks(spark, monkeypatch):
    written = []

    def counted(df):
        out = cut_lineage(df)
        written.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(topk, "cut_lineage", counted)
    rng = np.random.default_rng(4)
    middle = rng.normal(0, 1, (20, 6)) * 3  # each unit of ids around its own point
    rows = [(i, [float(x) for x in middle[i // 100] + rng.normal(0, 0.05, 6)]) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    assert topk.top_k(frame, unit=100, block=10).count() == 40 * 5
    home = next(n for c, n in written if "home" in c)
    pairs = [n for c, n in written if c == ["q_unit", "unit", "wanted", "floors"]]
    assert home == 40  # one row a query
    assert len(pairs) == 1 and pairs[0] <= 20  # one query block: at most a row a unit


# -- packing -------------------------------------------------------------------------
def test_pack_is_first_fit_decreasing_and_whole():
    def first_fit(sizes, room):
        bins = []
        for s in sizes:
            for b in bins:
                if sum(b) + s <= room:
                    b.append(s)
                    break
            else:
                bins.append([s])
        return [sum(b) for b in bins]

    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 100) for _ in range(200)), reverse=True)
    tree, used = packing.TournamentTree(len(sizes), 100), [0] * len(sizes)
    for s in sizes:
        used[tree.first_fit(s)] += s
    assert [u for u in used if u] == first_fit(sizes, 100)

    lengths = [rng.choice([1, 3, 50, 64, 200, 777]) for _ in range(60)]
    sequences = packing.pack(lengths, 64)
    spans = sorted((d, a, n) for s in sequences for d, a, n in s)
    for d, n in enumerate(lengths):
        at = 0
        for _, a, m in (x for x in spans if x[0] == d):
            assert a == at and m > 0
            at += m
        assert at == n
    for s in sequences:
        total = sum(n for _, _, n in s)
        assert total <= 64 and total & (total - 1) == 0  # no padding at all


def test_pack_documents_gives_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    docs = [(1, "Hello world, it's a test.\n\n Ünïcode 中文"), (2, None), (3, ""), (4, "long words " * 1500), (None, "no id"), (4, "again")]
    frame = spark.createDataFrame([(i, t, 7) for i, t in docs], DOCS + ", start int")
    rows = packing.pack_documents(frame, path, group_tokens=700).collect()
    ids = {(i, t): [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs}
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (i, t), x in ids.items():
        pieces = sorted(by_doc[i, len(x)], key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        assert sum(r.length for r in pieces) % len(x) == 0
        for r in pieces:
            part = np.array(x[r.start:r.start + r.length], dtype="<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32 or (i, len(x)) in {(2, 1), (3, 1)}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack_documents(spark.createDataFrame([], DOCS), path).count() == 0


def test_encoder_gives_added_tokens_their_own_ids(tmp_path):
    import json

    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    spec = json.load(open(path, encoding="utf-8"))
    spec["normalizer"] = {"type": "NFC"}  # such a file is not run as a rank table
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    texts = [f"end {t['content']} more{t['content']}" for t in spec["added_tokens"]] + ["no such <| text |>", ""]
    for file in (path, str(other)):
        encode, _ = packing.encoder(file)
        whole = Tokenizer.from_file(file)
        assert [encode(t) for t in texts] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in packing.encoder(path)[0]("end <|endoftext|> more")


# -- the pipeline ----------------------------------------------------------------------
def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline
    from quillfeed.llm import quality

    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    names = docs.columns
    before = docs.collect()
    out = corpus_pipeline.STAGES[0][1](spark, docs, base)
    assert out.columns == names
    judged = {r.doc_id: quality.judge_text(r.text) for r in before}
    assert {r.doc_id: r.text for r in out.collect()} == {i: v[10] for i, v in judged.items() if v[6]}
    n = out.count()
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, out, base)
        assert out.columns == names and out.count() <= n
        n = out.count()
    left = [(r.doc_id, r.text) for r in out.collect()]
    components = brute_components(left)
    assert all(d == c for d, _, c in components)  # one document of each group
    pieces = corpus_pipeline.STAGES[4][1](spark, out, base)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {i for i, _ in left}


def test_pipeline_near_duplicates_are_five_words_at_80_percent(spark):
    import corpus_pipeline

    rng = random.Random(4)
    docs = []
    for k in range(8):
        words = [f"w{k}x{i}" for i in range(100)]
        docs.append((10 * k, " ".join(words)))
        for j in range(1, 4):
            for at in rng.sample(range(100), j):
                words[at] = f"new{k}x{j}x{at}"
            docs.append((10 * k + j, " ".join(words)))
    frame = spark.createDataFrame(docs, DOCS)
    near = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    want = sorted(d for d, _, c in brute_components(docs, 5, 80) if d == c)
    assert want != sorted(d for d, _, c in brute_components(docs) if d == c)
    assert sorted(r.doc_id for r in near(spark, frame, "").collect()) == want
