"""Operators over the whole corpus, against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from quillframe.llm import common, components, html, jaccard, lines, packing, queries, vectors, warc
from tests.llm import helpers


def brute_lines(rows):
    """(doc_id, n_lines, n_dropped, text left) of each row."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(d)
    order = lambda d: (d is not None, d or 0)
    keeper = {k: max(v, key=order) for k, v in holders.items() if len(v) >= 3}
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if key(x) not in keeper or keeper[key(x)] == d]
        out.append((d, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_rows(spark):
    common = "A line that many documents share, in many ways"
    texts = [f"{helpers.prose(k)}\n{common if k % 2 else '  ' + common.upper() + chr(9)}\nshort\n{helpers.prose(k % 4 + 100, 9, 1)}" for k in range(30)]
    texts += [common + "\n" + common + "\n" + common, "ÄÖ line with letters not in ASCII\n" * 3, *(["ÄÖ line with letters not in ASCII"] * 3)]
    return helpers.docs(spark, *texts).union(helpers.awkward(spark))


@pytest.mark.parametrize("parts", ["1", "3", "64"])
def test_line_dedup(spark, parts):
    rows = line_rows(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = lines.applied(helpers.clashing(rows, "row", "keep"), "doc_id", "row").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = sorted(((r["doc_id"], r["__n_lines"], r["__n_dropped"], r["__sha256"]) for r in out), key=str)
    assert got == brute_lines([(r["doc_id"], r["text"]) for r in rows.collect()])


def test_line_stream_across_batches():
    rng = np.random.default_rng(1)
    rows = sorted((int(h), -int(d), int(p)) for h, d, p in zip(rng.integers(0, 6, 400), rng.integers(0, 5, 400), rng.integers(0, 50, 400)))
    table = pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([0] * 400, pa.int64()), pa.array([-r[1] for r in rows], pa.int64()), pa.array([False] * 400), pa.array([0] * 400, pa.int64()), pa.array([r[2] for r in rows], pa.int32())], names=list(lines._COLUMNS))
    def dropped(size):
        return sorted((a, b) for x in lines._streamed({})(iter([table.slice(k, size) for k in range(0, 400, size)])) for a, b in zip(x.column(0).to_pylist(), x.column(3).to_pylist()))
    want = dropped(400)
    assert want and all(dropped(size) == want for size in (1, 2, 7, 50))


def test_line_bitmaps_and_stage(spark):
    rows = line_rows(spark)
    maps = lines.keep_bitmaps(rows).collect()
    assert maps and all(zlib.decompress(r["keep"]) for r in maps)
    out = lines.deduplicated(helpers.clashing(rows, "n_lines", "pos"))
    assert out.columns == rows.columns + ["n_lines", "pos"] and out.count() == rows.count()
    assert out.where("text IS NOT NULL AND n_chars <> length(text)").isEmpty()
    assert lines.deduplicated(helpers.empty(spark)).count() == 0


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    name = lambda i: min((d for d in least[root(i)] if d is not None), default=None)
    return sorted(((d, name(i), links[i]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block,blocks,hot", [(4, 64, 1000), (4, 2, 1), (256, 64, 1000)])
def test_jaccard_join(spark, monkeypatch, block, blocks, hot):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCKS", blocks)
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rows = helpers.corpus(spark).union(helpers.awkward(spark))
    found = jaccard.classes(helpers.clashing(rows, "f", "sig", "key")).collect()
    got = sorted(((None if r["no_id"] else r["d"], r["class_id"], r["n_links"]) for r in found), key=str)
    assert got == brute_links([(r["doc_id"], r["text"]) for r in rows.collect()])


def test_bayesian_pruning():
    assert jaccard.least_matches(25) < 20 and jaccard.least_matches(125) < 100
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (3, jaccard.VALUES)).astype(np.uint16)
    near = a[:1].copy()
    near[0, ::7] += 1
    i, j = jaccard.likely(np.concatenate([a, near]), np.concatenate([a, near]), True)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 3)]


def test_jaccard_stage(spark):
    rows = helpers.corpus(spark).union(helpers.awkward(spark))
    out = jaccard.one_of_each(helpers.clashing(rows, "label", "t", "d"))
    want = brute_links([(r["doc_id"], r["text"]) for r in rows.collect()])
    worded = {d for d, t in ((r["doc_id"], r["text"]) for r in rows.collect()) if (t or "").split()}
    got = Counter(r["doc_id"] for r in out.collect())
    assert {d for d in got if d in worded and d is not None} == {c for d, c, _ in want if d in worded and c is not None}
    assert got[2] == got[3] == got[4] == 1 and max(got.values()) == 1
    assert out.columns == rows.columns + ["label", "t", "d"]
    assert jaccard.one_of_each(helpers.empty(spark)).count() == 0
    assert jaccard.classes(helpers.empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [1, 1000])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = components.labelled(spark.createDataFrame(chain, "a int, b int"))
    assert sorted((r["node"], r["label"]) for r in found.collect()) == sorted([(k, 0) for k in range(41)] + [(100, 100), (101, 100), (102, 100)])
    assert components.labelled(spark.createDataFrame([], "a int, b int")).count() == 0


def check_packing(rows, out):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_file(queries.WORD_TOKENIZER))
    want = []
    for d, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(d, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted(((r["doc_id"], r["__piece"], r["__start"], r["__length"], r["__crc32"]) for r in out), key=str) == sorted(want, key=str)
    places = defaultdict(list)
    for r in out:
        places[r["__sequence"]].append((r["__offset"], r["__length"]))
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    return len(places), -(-sum(r["__length"] for r in out) // 4096)


def test_packing(spark):
    extra = helpers.docs(spark, *(helpers.prose(k, 30 * (k % 40 + 1)) for k in range(200)), "a <|endoftext|>, b.", "J̌ it's É, é. DON'T x😀, 1,2 a.,b", first=200)
    rows = helpers.clashing(helpers.awkward(spark).union(extra), "length", "rank")
    out = packing.packed(rows, queries.tokenizer_file(queries.WORD_TOKENIZER), "doc_id", "length").collect()
    n, least = check_packing([(r["doc_id"], r["text"]) for r in rows.collect()], out)
    assert n <= least + 1
    assert packing.packed(helpers.empty(spark), queries.tokenizer_file(queries.WORD_TOKENIZER), "doc_id").count() == 0


def test_packing_plan():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 4097, 500), rng.integers(1300, 1400, 300), np.array([4096] * 5), np.array([1] * 10000), np.array([2048] * 7 + [2049] * 3), np.array([], dtype=int)):
        counts = Counter(lengths.tolist())
        plan = packing.plan(counts)
        used = Counter()
        for _, times, parts in plan:
            assert sum(x * k for x, k in parts) <= 4096
            for x, k in parts:
                used[x] += k * times
        assert used == counts
    exact = packing.plan(Counter({4000: 3, 90: 3, 6: 3, 3000: 1, 1096: 1, 2000: 1, 1000: 1, 500: 1, 596: 1}))
    assert sum(times for _, times, _ in exact) == 5


def test_packed_sequences_hold_the_ids(spark):
    rows = helpers.awkward(spark)
    path = queries.tokenizer_file(queries.WORD_TOKENIZER)
    whole = b"".join(r["ids"] for r in packing.sequences(rows, path).collect())
    made = b"".join(r["__ids"] for r in packing.pieces(rows, path, with_ids=True).collect())
    assert Counter(np.frombuffer(whole, "<u4").tolist()) == Counter(np.frombuffer(made, "<u4").tolist())


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8).astype("float32").tolist()) for k in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (301, rows[0][1]), (302, None), (303, [float("nan")] * 8), (304, [None] * 8), (305, [1.0, 2.0]), (310, [1.0, 3.0]), (None, rows[3][1]), (320, [float("inf")] * 8), (400, []), (350, [1e30] * 8), (351, [-1e30] * 8)]
    frame = helpers.clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "score", "dim")
    got = defaultdict(list)
    for r in vectors.top_k(frame.where("vec_id % 10 = 0"), frame, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {}
    for k, v in rows:
        if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(k, []).append([max(-(2**62), min(2**62, int(np.floor(256 * float(np.float32(x)))))) for x in v])
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    for q in [k for k in whole if k % 10 == 0]:
        scores = sorted((-clip(sum(a * b for a, b in zip(whole[q][0], v))), k) for k, vs in whole.items() if k != q for v in vs if len(v) == len(whole[q][0]))
        assert got[q] == [(i + 1, k, -s) for i, (s, k) in enumerate(scores[:5])], q
    assert vectors.top_k(frame.limit(0), frame, 5).count() == 0


def test_top_k_with_repeated_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=8).astype("float32").tolist()) for k in range(200)]
    rows += [r for r in rows if r[0] % 10 == 0 for _ in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    got = defaultdict(list)
    for r in vectors.top_k(frame.where("vec_id % 10 = 0"), frame, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    whole = [(k, np.floor(256 * np.array(v, dtype="float32").astype(float)).astype(int)) for k, v in rows]
    for q, v in whole[:200:10]:
        assert got[q] == sorted((-int(v @ w), k) for k, w in whole if k != q)[:5], q


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<article><header><h1>Title &amp; more</h1></header><p>First&nbsp;para <b>bold</b>text<br>next.<p>Second</p><div class="advert">Buy</div><aside>Side</aside><form><input>Send</form>
<section id="comments"><article><p>A reader</p></article></section><table><tr><td>1<td>2</table><p>1 < 2 &lt; 3 &am</p></article><footer>&copy; x</footer></body></html>"""


def test_page_structure():
    assert [b.text for b in html.blocks(PAGE)] == ["Title & more", "First para boldtext next.", "Second", "1", "2", "1 < 2 < 3 &am"]
    assert [b.text for b in html.blocks("<article class='post has-comments no-sidebar'><p>Kept</p><div class='comment-list'>c</div></article>")] == ["Kept"]
    assert html.blocks("") == [] and [b.text for b in html.blocks("just text")] == ["just text"]
    assert [b.text for b in html.blocks("<div class='cookie-notice'>We</div><div class=content><p>Body</p></div><div role=navigation>x</div><p hidden>h</p>")] == ["Body"]
    assert html.blocks("<p>" * 5000 + "x" + "</div>" * 5000)[0].text == "x"


def plain_page(k, words=40):
    menu = "<div><a href=/a>Home page of the site</a> <a href=/b>All of our topics</a> <a href=/c>About us and more</a></div>"
    return f"<html><body>{menu}<h1>Story number {k}</h1><p>{helpers.prose(k, words, 1)}</p><p>All rights reserved by the site, do not copy any of this text.</p></body></html>"


def test_host_repetition(spark):
    pages = [(k, "http://www.x.org/%d" % k, plain_page(k)) for k in range(8)] + [(20, "http://one.org/", plain_page(20)), (21, None, None), (22, "http://y.org/", ""), (23, "bad url", PAGE)]
    pages += [(30, "http://copy.org/1", plain_page(30)), (31, "http://copy.org/2", plain_page(30))]
    frame = helpers.clashing(spark.createDataFrame(pages, "page_id long, url string, html string"), "text", "host")
    out = {r["page_id"]: r["__main"] for r in html.main_text(frame, "page_id", "url", "text").collect()}
    assert len(out) == len(pages)
    for k in range(8):
        assert out[k] == f"Story number {k}\n{helpers.prose(k, 40, 1)}"
    assert "Home page" in out[20] and out[21] == "" and out[22] == "" and out[23].startswith("Title & more")
    assert helpers.prose(30, 40, 1) in out[30] and out[30] == out[31]  # copies are no boilerplate
    assert html.main_text(frame.limit(0), "page_id").count() == 0


def test_wrappers_keep_the_article():
    text = lambda source: [b.text for b in html.blocks(source)]
    for page in ("<div class='page-with-sidebar'><article><p>A</p></article></div>", "<div class='layout sidebar-right'><nav>n</nav><main><p>A</p></main></div>", "<form id=aspnetForm><nav>n</nav><article><p>A</p></article></form>", "<div class='theme-no-banner'><p>A</p></div>", "<aside><article>A</article></aside>"):
        assert text(page) == ["A"], page
    assert text("<article><p class='notice-period'>A</p><p class=related-work>B</p><div class=related-posts>no</div></article>") == ["A", "B"]
    assert text("<form><nav>menu</nav><h1>T</h1><p>Most of the page</p></form><p>x</p>") == ["T", "Most of the page", "x"]
    assert text("<div class=related><article>tease</article></div><article>real<div class='post-comments'>c</div></article>") == ["real"]
    assert text("<div id=comments><article>one</article></div><p>page</p>") == ["page"]


@pytest.mark.parametrize("piece", ['<a "', '<a ="', "<a ='>' ", "<svg>", "<p>", "<div class='sidebar'>x", "<", "<!--", "<a b='x", "<article>", "<h1 class=sidebar>t"])
def test_broken_pages_take_linear_time(piece):
    import time

    began = time.perf_counter()
    html.blocks(piece * (1_000_000 // len(piece)) + '="')
    assert time.perf_counter() - began < 5  # a megabyte is under a second where nothing else runs


def test_short_and_unspaced_blocks_repeat():
    story = lambda k: "".join(chr(0x4E00 + (k * 7919 + i * i * 31 + i * 17) % 5000) for i in range(60))
    notice = "版权所有未经许可不得转载本站内容"
    body = lambda k: [f"Unique{k} opening", "Powered by WordPress", f"Other{k} words", "版权所有", story(k), notice + f"第{k}页", f"Last{k}", "Share"]
    pages = [(body(k), [0] * 8) for k in range(50)]
    got = html.unique_text(pages)
    assert got == ["\n".join((f"Unique{k} opening", f"Other{k} words", story(k), f"Last{k}")) for k in range(50)]
    assert html.unique_text(pages[:1]) == ["\n".join(body(0))] and html.unique_text(pages[:1] * 3) == ["\n".join(body(0))] * 3


def brute_host(pages):
    """Texts of one host's pages (lists of blocks) by counting every string of RUN tokens in a dictionary."""
    stream = lambda page: [None] + [t for b in page for t in [*html._tokens(b), None]]
    prints = [tuple(stream(p)) for p in pages]
    runs, holders = defaultdict(set), defaultdict(set)
    for p, s in zip(pages, prints):
        for i in range(len(s) - html.RUN + 1):
            runs[s[i : i + html.RUN]].add(s)
        for b in p:
            holders[b].add(s)
    out = []
    for p, s in zip(pages, prints):
        often, at, kept = [0] * len(s), 1, []
        for i in range(len(s) - html.RUN + 1):
            n = len(runs[s[i : i + html.RUN]])
            for k in range(i, i + html.RUN):
                often[k] = max(often[k], n if n >= 2 else 0)
        for b in p:
            n = len(html._tokens(b))
            run = sorted(often[at : at + n])
            seen = max(run[0 if n < html.RUN else int(n * (1 - html.COVERED))], len(holders[b]))
            if seen < (max(3, len(set(prints)) / 2) if n >= html.PROSE_WORDS else 2):
                kept.append(b)
            at += n + 1
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("parts,most", [("1", None), ("2", None), ("8", None), ("8", 0), ("3", 0)])
def test_host_texts_against_brute_force(spark, monkeypatch, parts, most):
    """Whatever the partitions, and whether a host is one task or comes together in exchanges."""
    rng = np.random.default_rng(7)
    parts_of = [helpers.prose(900 + k, n, 1) for k, n in enumerate((3, 5, 9, 14, 14, 14, 35, 60))]
    hosts = defaultdict(list)
    for k in range(240):
        body = [f"Title {k}", *(parts_of[i] for i in sorted(rng.choice(8, int(rng.integers(0, 4)), replace=False))), helpers.prose(k // 2, 50, 1) if k % 5 else helpers.prose(k % 3, 40, 1)]
        hosts["big" if k % 3 else f"h{k % 4}"].append((k, body))
    hosts["big"] += [(1000 + k, hosts["big"][0][1]) for k in range(5)]
    want = {k: t for pages in hosts.values() for (k, _), t in zip(pages, brute_host([b for _, b in pages]))}
    rows = [(k, f"http://{h}.org/{k}", "".join(f"<p>{b}</p>" for b in body)) for h, pages in hosts.items() for k, body in pages]
    if most is not None:
        monkeypatch.setattr(html, "HOST_TOKENS", most)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r[0]: r[1] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want and any(len(t) < len("\n".join(b)) for pages in hosts.values() for (k, b) in pages for t in [got[k]])


def brute_stories(pages):
    """Texts of one host's pages, lists of (block, part, whether it is a link), by the rules alone. Parts below 0 are beside the stories; all are None where there is none."""
    stream = lambda page: tuple([None] + [t for b, _, _ in page for t in [*html._tokens(b), None]])
    distinct = {stream(p): p for p in pages}
    runs, holders = defaultdict(set), defaultdict(set)
    for s, p in distinct.items():
        for i in range(len(s) - html.RUN + 1):
            runs[s[i : i + html.RUN]].add(s)
        for b, _, _ in p:
            holders[b].add(s)
    half, out = max(3, len(distinct) / 2), []
    for p in pages:
        s, at, rows = stream(p), 1, []
        for b, part, link in p:
            n = len(html._tokens(b))
            over = [max((len(runs[s[i : i + html.RUN]]) for i in range(max(0, k - html.RUN + 1), min(k, len(s) - html.RUN) + 1)), default=0) for k in range(at, at + n)]
            often = max(sorted(over)[0 if n < html.RUN else int(n * (1 - html.COVERED))], len(holders[b]))
            prose = n >= html.PROSE_WORDS and not link
            rows.append((b, part, link, prose, often < (half if prose or part is not None and part >= 0 else 2)))
            at += n + 1
        own = {part for _, part, _, _, o in rows if o and part is not None and part >= 0}
        beside = [r for r in rows if r[1] is None or r[1] == -1]
        if own:
            kept = [r for r in rows if r[1] in own and (r[4] or not r[2])]
        elif all(part is None for _, part, _, _, _ in rows):
            kept = [r for r in rows if r[4]]
        elif not any(r[3] and r[1] >= 0 for r in rows) and any(r[3] and r[4] for r in beside):
            kept = [r for r in beside if r[4]]
        else:
            kept = [r for r in rows if r[1] >= 0]
        out.append("\n".join(r[0] for r in kept))
    return out


@pytest.mark.parametrize("parts,most", [("1", None), ("8", None), ("8", 0), ("3", 0)])
def test_hosts_of_articles_against_brute_force(spark, monkeypatch, parts, most):
    """Pages with an article or a main element are compared with their host like all others."""
    rng = np.random.default_rng(11)
    teasers = [helpers.prose(700 + k, n, 1) for k, n in enumerate((3, 6, 12, 12, 45))]
    menu, notice, shared = "Home Topics About", helpers.prose(720, 12, 1), helpers.prose(721, 50, 1)
    hosts = defaultdict(list)
    for k in range(160):
        kind, host = int(rng.integers(0, 6)), ("big" if k % 3 else f"h{k % 4}")
        body = [(f"Title {k}", 1, False), (helpers.prose(k, 40, 1) if k % 7 else shared, 1, False), (menu, 1, True)]
        if kind == 0:  # neither article nor main element
            page = [(b, None, link) for b, _, link in [*body, (notice, None, False)]]
        elif kind == 1:  # only a teaser is an article; some pages have text beside it
            page = [(teasers[2 if k % 5 else 0], 1, False), (helpers.prose(k, 40 if k % 4 else 5, 1), -1, False), (notice, -1, False)]
        elif kind == 2:  # one story, with nothing beside it
            page = body[:2]
        else:
            page = [*body, *((teasers[i], 2 + j, False) for j, i in enumerate([2] * (k % 11 > 0) + rng.choice((0, 1, 3, 4), int(rng.integers(0, 3)), replace=False).tolist())), (notice, -1, False)]
        hosts[host].append((k, kind, page))
    hosts["quiet"] = [(1000 + k, 2, [(f"Title {k % 2}", 1, False), (shared, 1, False)]) for k in range(5)]

    def source(kind, page):
        out = ""
        for part in dict.fromkeys(p for _, p, _ in page):
            inside = "".join(f"<p><a href=/>{b}</a></p>" if link else f"<p>{b}</p>" for b, p, link in page if p == part)
            out += f"<article>{inside}</article>" if part is not None and part >= 0 else inside
        return f"<html><body>{out}</body></html>"

    want = {k: t for pages in hosts.values() for (k, _, _), t in zip(pages, brute_stories([p for _, _, p in pages]))}
    rows = [(k, f"http://{h}.org/{k}", source(kind, page)) for h, pages in hosts.items() for k, kind, page in pages]
    if most is not None:
        monkeypatch.setattr(html, "HOST_TOKENS", most)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r[0]: r[1] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), "page_id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == want
    told = [(kind, [b for b, p, _ in page if p is None or p >= 0], got[k].split("\n")) for pages in hosts.values() for k, kind, page in pages]
    assert all(named == text for kind, named, text in told if kind == 2)  # an only story is whole, whatever others share
    assert {text == named for kind, named, text in told if kind == 1} == {teasers[2] in text for kind, _, text in told if kind > 2} == {True, False}
    assert all(menu not in text for _, _, text in told)


def test_host_of_articles(spark):
    """A page without an article is compared with those that have one; teasers and menus that structure does not name go, what is shared in a story stays."""
    notice, shared, promo = "<p>All rights reserved by the site, do not copy.</p>", helpers.prose(800, 40, 1), "<article><h2>Our shop has it all</h2><p>Come and see</p></article>"
    share = "<p><a href=/s>Share this story</a></p>"
    story = lambda k: f"<article><h1>Story {k}</h1><p>{shared}</p>{share}</article>"
    pages = [(k, f"<main>{story(k)}{promo}</main>{notice}") for k in range(5)]
    pages += [(5, f"<p>{helpers.prose(805, 40, 1)}</p>{notice}"), (6, f"{promo}<div><p>{helpers.prose(806, 40, 1)}</p></div>{notice}"), (7, f"{promo}{notice}")]
    frame = spark.createDataFrame([(k, f"http://a.org/{k}", h) for k, h in pages], "page_id long, url string, html string")
    got = {r[0]: r[1] for r in html.main_text(frame, "page_id").collect()}
    assert got == {k: f"Story {k}\n{shared}" for k in range(5)} | {5: helpers.prose(805, 40, 1), 6: helpers.prose(806, 40, 1), 7: "Our shop has it all\nCome and see"}


def test_suffix_order():
    rng = np.random.default_rng(2)
    streams = [rng.integers(0, 2, int(n)) for n in rng.integers(0, 40, 12)] + [np.zeros(33, np.int64)] * 2
    order, shared, left = html.suffix_order(streams)
    suffixes = [tuple(s[i:]) for s in streams for i in range(len(s))]
    assert [suffixes[k] for k in order.tolist()] == sorted(suffixes)
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert left.tolist() == [len(x) for x in suffixes]


def test_repeated_runs_against_brute_force():
    rng = np.random.default_rng(3)
    streams = [rng.integers(0, 3, int(rng.integers(1, 60))) for _ in range(6)]
    streams.append(streams[0].copy())
    got, at = html.repeated(streams), 0
    runs = defaultdict(set)
    for s in streams:
        for i in range(len(s) - html.RUN + 1):
            runs[tuple(s[i : i + html.RUN])].add(s.tobytes())
    for s in streams:
        for i in range(len(s)):
            near = [len(runs[tuple(s[k : k + html.RUN])]) for k in range(max(0, i - html.RUN + 1), min(i, len(s) - html.RUN) + 1)]
            most = max(near, default=0)
            assert got[at + i] == (most if most >= 2 else 0)
        at += len(s)


def brute_revisit(headers, base):
    """(verdict, headers) of a revisit and the response before it, by the rules alone."""
    low = lambda h: {a.lower(): b for a, b in sorted((h or {}).items())}
    own = low(headers)
    if base is None:
        return "no_base", own
    stored = low(base)
    for field, bad in (("etag", "etag_mismatch"), ("last-modified", "date_mismatch")):
        if field in own and field in stored:
            if own[field].replace("W/", "") != stored[field].replace("W/", ""):
                return bad, own
            hop = [x.strip().lower() for x in own.get("connection", "").split(",")]
            body = "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate proxy-authorization te trailer transfer-encoding upgrade".split()
            return "resolved", stored | {k: v for k, v in own.items() if k not in hop and k not in body}
    return "unchecked", own


@pytest.mark.parametrize("parts", ["1", "5", "40"])
def test_revisits(spark, parts):
    rng = np.random.default_rng(4)
    records = []
    for k in range(300):
        revisit = bool(rng.random() < 0.5)
        headers = {"X-%d" % (k % 3): str(k), "Content-Length": str(k), "x-trace": "t", "Connection": "close, X-Trace" if k % 2 else "close"}
        tag = rng.choice([0, 1, 2], p=[0.15, 0.55, 0.3])
        if tag == 1:
            headers |= {"ETag": '"none"', "etag": f'{"W/" if revisit else ""}"{rng.integers(0, 2)}"'}
        elif tag == 2:
            headers["Last-Modified"] = str(rng.integers(0, 2))
        url = [None, "http://A.org:80/x/?b=2&a=1&utm_source=q#f", "https://www.a.org:443/x?a=1&b=2", "http://b.org/", "http://b.org:443/"][rng.choice(5, p=[0.05, 0.45, 0.35, 0.1, 0.05])]
        ts = None if k % 50 == 49 else int(rng.integers(0, 60))
        records.append((k, url, ts, "revisit" if revisit else "response", 304 if revisit else int(rng.choice([200, 200, 404, 206])), None if k % 40 == 39 else headers))
    frame = helpers.clashing(spark.createDataFrame(records, warc.RECORD), "key", "revisit")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = warc.resolved(frame.unionAll(frame.where("record_id = 7"))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {r["record_id"]: (r["base_id"], r["verdict"], r["status"], dict(r["headers"])) for r in found}
    key = {None: None, "http://b.org/": "b", "http://b.org:443/": "b443"}
    seen = Counter()
    for k, url, ts, kind, status, headers in records:
        if kind != "revisit":
            continue
        place = key.get(url, "a")
        earlier = [r for r in records if r[3] == "response" and r[4] == 200 and place is not None and key.get(r[1], "a") == place and None not in (ts, r[2]) and r[2] <= ts]
        base = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        verdict, fields = brute_revisit(headers, None if base is None else base[5] or {})
        seen[verdict] += 1
        assert got[k] == ((base[0], verdict, 200, fields) if verdict == "resolved" else (None, verdict, 304, fields))
    assert len(seen) == 5 and len(found) == sum(seen.values()) + (records[7][3] == "revisit")
    assert warc.resolved(frame.limit(0)).count() == 0


def test_captures_have_every_verdict(spark):
    found = queries.QUERIES["op2_revisits"](spark, "/root/testdata/sf0.01")
    by_verdict = {r[0]: r for r in found.groupBy("verdict").agg({"*": "count", "base_id": "max"}).collect()}
    assert set(by_verdict) == {"resolved", "unchecked", "no_base", "etag_mismatch", "date_mismatch"}
    assert not found.where("verdict = 'resolved' AND base_id <> record_id - 1").isEmpty()  # the latest earlier response is not always the page's own


def test_warc_records_as_rows(spark):
    import gzip

    block = b"HTTP/1.1 200 OK\r\nETag: \"x\"\r\n\r\nbody"
    fields = lambda kind, n: {"WARC-Type": kind, "WARC-Record-ID": f"<urn:{n}>", "WARC-Date": f"2024-01-0{n}T00:00:00Z", "WARC-Target-URI": "http://a/"}
    parts = [warc.written(fields("response", 1), block), warc.written(fields("revisit", 2), b'HTTP/1.1 304 Not Modified\r\nETag: "x"\r\n\r\n')]
    files = [(b"".join(parts),), (b"".join(map(gzip.compress, parts)),), (gzip.compress(parts[0])[:-20],), (b"",), (b"junk",)]
    rows = warc.records(spark.createDataFrame(files, "content binary"))
    assert sorted((r["warc_type"], r["status"], bytes(r["payload"])) for r in rows.collect()) == sorted([("response", 200, b"body"), ("revisit", 304, b"")] * 2)
    assert {r["verdict"] for r in warc.resolved(rows).collect()} == {"resolved"}


def test_warc_files_round_trip():
    block = b"HTTP/1.1 200 OK\r\nETag: \"x\"\r\nContent-Type: text/html\r\n\r\nbody \r\n\r\n WARC/1.1"
    data = warc.written({"WARC-Type": "response", "WARC-Target-URI": "http://a/"}, block) + warc.written({"WARC-Type": "revisit"}, b"")
    found = list(warc.read(data + b"WARC/1.1\r\nContent-Length: 99\r\n\r\ncut"))
    assert [f["warc-type"] for f, _ in found] == ["response", "revisit"] and found[0][1] == block
    assert warc.http_message(block) == (200, {"etag": '"x"', "content-type": "text/html"}, b"body \r\n\r\n WARC/1.1")


def test_pipeline(spark, tmp_path):
    rows = helpers.corpus(spark).union(helpers.awkward(spark)).union(helpers.docs(spark, "mail me@x.org now, " + helpers.prose(77), "spam " * 50, first=900))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "personal_data", "packing"]
    ids = {r["doc_id"] for r in out}
    assert 900 in ids and 901 not in ids and 5 not in ids
    want, kept = stage_by_stage(rows)
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in out) == want
    assert len(ids) == len(kept)


def stage_by_stage(frame):
    """The pipeline in plain Python."""
    from tokenizers import Tokenizer

    from tests.llm.test_rows import brute_pii, brute_quality

    rows = []
    for r in frame.collect():
        n_words, _, _, _, repeated = brute_quality(r["text"])
        if n_words >= 10 and 100 * repeated <= 20 * n_words:
            rows.append((r["doc_id"], r["text"]))
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    order = lambda d: (d is not None, d or 0)
    for d, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(d)
    keeper = {k: max(v, key=order) for k, v in holders.items() if len(v) >= 3}
    rows = [(d, "\n".join(x for x in t.split("\n") if key(x) not in keeper or keeper[key(x)] == d)) for d, t in rows]
    classes = brute_classes(rows)
    kept = []
    for members in classes:
        kept.append(min((rows[i] for i in members), key=lambda r: (r[0] is None, r[0] or 0)) if rows[members[0]][1].split() else None)
    kept = [k for k in kept if k] + [r for r in rows if not r[1].split()]
    whole = Tokenizer.from_file(queries.tokenizer_file(queries.WORD_TOKENIZER))
    out = Counter()
    for d, t in kept:
        spans, at, text = [x.split(":") for x in brute_pii(t).split(",") if x], 0, ""
        for kind, a, b in spans:
            if int(a) >= at:
                text += t[at : int(a)] + f"[{kind.upper()}]"
                at = int(b)
        ids = np.array([*whole.encode(text + t[at:], add_special_tokens=False).ids, 1], dtype="<u4")
        for k in range(0, len(ids), 4096):
            out[d, k // 4096, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())] += 1
    return out, kept


def brute_classes(rows):
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w := t.split()) >= 5 else frozenset([tuple(w)] if w else []) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    out = defaultdict(list)
    for i in range(len(rows)):
        out[root(i)].append(i)
    return list(out.values())


@pytest.mark.parametrize("number,stage", list(enumerate(corpus_pipeline.STAGES)))
def test_stages_take_anything(spark, number, stage):
    rows = helpers.clashing(helpers.awkward(spark), "length", "label", "kept", "spans", "f", "__sha")
    for some in (rows, rows.limit(0), rows.where("text IS NULL"), rows.where("doc_id = 6")):
        out = stage[1](spark, some, "/nowhere")
        found = out.collect()
        assert number == 4 or out.columns == rows.columns
        assert len(found) <= max(some.count() * 30, 0)
