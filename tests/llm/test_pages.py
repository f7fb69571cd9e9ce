"""URL filter, WARC archives and HTML extraction."""

import gzip
import random
import re

import pytest

from bronzeway.llm import html, urls, warc
from bronzeway.llm.queries import URL_RULES

# --- URLs --------------------------------------------------------------------

PLACES = [
    "http://a.example.com/en/1", "https://WWW.Example.COM/en/x?y=/fr/", "http://www.example.com/de/",
    "http://x.net/es/a#b", "http://x.net/esx", "http://net/es/", "http://xnet/es/", "http://a.b.net/fr/",
    "http://example.com", "http://example.com?x", "ftp://example.com/en/", "no scheme.com/en/", "://com/",
    "http:///es/", "", None, "http://x.net/ES/", "http://a..net/es/", "http://É.COM/\n/en/", "a://b://c.com/",
]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), h + p, action)
        for h, p, action in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, action = max(fits)[1:] if fits else (None, "allow")
    return host, path, rule, action


@pytest.mark.parametrize("words", [urls.FILTER_WORDS, 1])
def test_urls_equal_a_plain_reading(spark, words):
    rules = spark.createDataFrame(
        [*URL_RULES, (None, "/", "block"), ("x.net", None, "block")], "host string, path string, action string"
    )
    rows = spark.createDataFrame([(u, "kept", "own") for u in PLACES + PLACES[:3]], "url string, verdict string, best string")
    got = urls.filter_urls(rows, rules, words=words)
    assert sorted(map(repr, got.select("url", "host", "path", "rule", "verdict").collect())) == sorted(
        repr(got.sparkSession.createDataFrame([(u, *judged(u, URL_RULES))], "url string, host string, path string, rule string, verdict string").first())
        for u in PLACES + PLACES[:3]
    )
    assert {r.best for r in got.collect()} == {"own"}


def test_urls_without_rules_or_rows(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    rows = spark.createDataFrame([("http://a.com/",)], "url string")
    assert [tuple(r) for r in urls.filter_urls(rows, none).collect()] == [("http://a.com/", "a.com", "/", None, "allow")]
    assert urls.filter_urls(rows.limit(0), none).collect() == []


def test_filter_has_no_false_negatives_and_few_hits(spark):
    keys = spark.range(3000).selectExpr("cast(id as string) as k")
    words = urls.bloom_words(keys, "k", 1 << 12)
    probe = spark.range(9000).selectExpr("id", "cast(id as string) as k")
    hits = {r.id for r in probe.filter(urls.may_contain(words.scalar(), probe["k"], 1 << 12)).collect()}
    assert hits >= set(range(3000)) and len(hits) < 3300


# --- WARC ----------------------------------------------------------------------


def pages(spark):
    big, rng = "é" * 700, random.Random(2)
    rows = [(1, "http://a/%\r\n", big), (5, None, big), (5, "http://b", big), (None, "http://c", big),
            (7, "http://d", "small"), (8, "http://e", "small"), (9, "http://f", None), (10, "", "")]
    rows += [(20 + i, f"http://h/{i}", "".join(rng.choice("abc<>\n") for _ in range(rng.randint(0, 4000)))) for i in range(40)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archives_round_trip(spark):
    rows, frame = pages(spark)
    mono = warc.write_monolithic(warc.plan_records(frame), size=20_000)
    archives = mono.collect()
    assert len(archives) > 2
    assert all(len(gzip.decompress(a.data).split(b"WARC/1.1")) > 1 for a in archives)
    normal = warc.normalise(mono)
    found = warc.read_records(normal).collect()
    got = sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes) for r in found), key=repr)
    expected = []
    for page_id, url, text in rows:
        size = len((text or "").encode())
        revisit = text == rows[0][2] and page_id != 5
        expected.append((page_id, url, "revisit" if revisit else "response", 5 if revisit else None, size))
    assert got == sorted(expected, key=repr)
    stored = {r.page_id: r.payload for r in found if r.record_type == "response"}
    assert all(bytes(stored[i]) == (t or "").encode() for i, _, t in rows if i is not None and i > 5)


def test_members_stand_alone_and_index_finds_them(spark):
    _, frame = pages(spark)
    normal = warc.normalise(warc.write_monolithic(warc.plan_records(frame), size=20_000))
    data = {r.archive: bytes(r.data) for r in normal.collect()}
    entries = warc.offset_index(normal).collect()
    assert sum(e.length for e in entries) == sum(map(len, data.values()))
    for e in entries:
        record = gzip.decompress(data[e.archive][e.offset : e.offset + e.length])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert warc.parse_record(record)["page_id"] == e.page_id
    again = warc.normalise(normal.select("archive", "data")).collect()  # many members in
    assert {r.archive: bytes(r.data) for r in again} == data


def test_export_writes_files_and_sidecars(spark, tmp_path):
    _, frame = pages(spark)
    normal = warc.normalise(warc.write_monolithic(warc.plan_records(frame)))
    done = warc.export_files(normal, tmp_path.as_uri()).collect()
    for r in done:
        lines = open(f"{r.path}.idx").read().splitlines()
        assert len(lines) == r.records and gzip.open(r.path).read().count(b"WARC/1.1") >= r.records
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


def test_broken_and_empty_archives(spark):
    assert warc.normalise_archive(b"") == (b"", [])
    with pytest.raises(ValueError, match="inside a record"):
        warc.normalise_archive(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.normalise(warc.write_monolithic(warc.plan_records(empty)))).collect() == []


# --- HTML ------------------------------------------------------------------------


def text_of(page):
    return html.join_blocks(html.page_blocks(page), [])


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &lt;text&gt;  here", "plain <text> here"),
        ("<nav>menu</nav><article><h1>T</h1><p>a<br>b <p>c&amp;d&#33;</article><footer>f</footer>", "T\n\na b\n\nc&d!"),
        ("<article><p><b>x.<br><p>y</p></article><aside>no</aside>", "x.\n\ny"),
        ('<div class="ad">buy</div><main><p>one</p><div class="cookie-notice"><p>no</p></div><p>two</main>', "one\n\ntwo"),
        ("<article><p>a</p><section id=comments><article class=comment><p>no</p></article></section><p>b</article>", "a\n\nb"),
        ("<script>var t='</p>';if(a<b)track()</script><article><p>a<script>x</script>b</p></article>", "ab"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>whole</p><p>cut <a hre", "whole\n\ncut"),
        ("<header>site</header><article><header><h1>T</h1></header><ul><li>1<li>2</ul><form>q</form></article>", "T\n\n1\n\n2"),
        ('<a title="a>b">x</a><!-- <p>no</p> -->y', "xy"),
        ("<body><div hidden>no</div><div style='display: none'>no</div><p>yes", "yes"),
        ("<article><pre>a\n  b</pre><table><tr><td>1<td>2<tr><td>3</table></article>", "a b\n\n1 2\n\n3"),
        ("a < b and 3 > 2", "a < b and 3 > 2"),
        ('<article class="post widget social"><p>kept <b class="banner">words</b> too</article>', "kept words too"),
        ('<article class="comment"><p>no</p></article><article><p>yes</p></article>', "yes"),
    ],
)
def test_article_text(page, text):
    assert text_of(page) == text


def test_repeats_across_a_host_go(spark):
    boiler = "we use all of this text on every page of ours to fill it"
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    rows = [(i, f"http://h.org/{i}", f"<div>{boiler}</div><div>{words(i)}</div><div>{words(i)}</div>", "mine") for i in range(6)]
    rows += [(10, "http://other.org/", f"<div>{boiler}</div>", "m"), (11, None, None, "m"), (12, "http://h.org/a", "", "m")]
    rows += [(13, "http://h.org/b", f"<article><p>{boiler}</p></article>", "m"), (14, "http://two.org/", f"<div>{words(99)}</div>", "m")]
    rows.append(rows[-1])
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract_text(frame).collect()
    found = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    for i in range(6):  # a page's own repeats stay
        assert found[i] == f"{words(i)}\n\n{words(i)}"
    assert found[10] == boiler and found[11] == found[12] == "" and found[13] == boiler
    assert found[14] == words(99)  # twice the same page is one page
    counted = {r.page_id: r.text for r in html.extract_text(frame, limit=1).collect()}
    assert counted == found


def texts_by_hand(rows, tokens):
    """Texts of pages (id, host, html): open blocks that strings of three other streams cover go."""
    parsed = {i: html.page_blocks(page) for i, _, page in rows}
    stream = {i: tuple(t for b in parsed[i] if b.open for t in b.text.split()) for i, _, _ in rows}
    pages = {}
    for _, host, streams in {(0, host, stream[i]) for i, host, _ in rows}:
        for k in range(len(streams) - tokens + 1):
            pages.setdefault((host, streams[k : k + tokens]), set()).add(streams)
    out = {}
    for i, host, _ in rows:
        words, gone = stream[i], set()
        for k in range(len(words) - tokens + 1):
            if len(pages[host, words[k : k + tokens]]) >= html.LEAST_PAGES:
                gone.update(range(k, k + tokens))
        kept, at = [], 0
        for block in parsed[i]:
            n = len(block.text.split()) if block.open else 0
            if not block.open or len(gone & set(range(at, at + n))) < html.COVERED_SHARE * n:
                kept.append(block.text)
            at += n
        out[i] = "\n\n".join(kept)
    return out


def test_texts_equal_brute_force(spark):
    rng = random.Random(6)
    pool = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randint(3, 14))) for _ in range(25)]
    rows = []
    for i in range(80):
        blocks = [rng.choice(pool) for _ in range(rng.randint(0, 5))] + [f"own{i} " * rng.randint(0, 9)]
        rng.shuffle(blocks)
        tag = rng.choice(["div", "div", "div", "p"])
        around = ("<article>", "</article>") if rng.random() < 0.2 else ("", "")
        page = around[0] + "".join(f"<{tag}>{b}</{tag}>" for b in blocks) + around[1]
        rows.append((i, f"h{i % 3}.org", page))
    rows += [(80 + i, rows[i][1], rows[i][2]) for i in range(10)]
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", p) for i, h, p in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_text(frame, tokens=4).collect()}
    expected = texts_by_hand(rows, 4)
    assert got == expected
    whole = {i: html.join_blocks(html.page_blocks(p), []) for i, _, p in rows}
    assert sum(got[i] != whole[i] for i in got) > 20 and sum(got[i] == whole[i] for i in got) > 10


def test_pages_take_clashing_names_and_long_pages(spark):
    names = ["copies", "spans", "_key", "_stream", "_blocks", "_host", "host", "blocks", "stream", "key", "runs", "short"]
    ddl = "page_id long, url string, html string, " + ", ".join(f"`{n}` string" for n in names)
    long = "<article>" + "<p>some words of a long page</p>" * 150_000 + "</article>"
    rows = [(1, "http://a.org/", long), (2, "http://a.org/", "<div>x y z</div>"), (3, None, None)]
    got = html.extract_text(spark.createDataFrame([(*r, *names) for r in rows], ddl)).collect()
    assert all(tuple(r[n] for n in names) == tuple(names) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert texts[1].count("some words") == 150_000 and (texts[2], texts[3]) == ("x y z", "")


def test_no_pages(spark):
    assert html.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
