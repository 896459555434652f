import base64
import hashlib
import html
import re
import time

import pytest

from aeroskein.llm.arc_warc import arc_records, arc_to_warc, archive_round_trip, arc_version_block, read_arc, read_warc, w3c_date, warc_records, write_arc
from aeroskein.llm.site_style_tree import extract_main_text, main_text, read_page

DATA = "/root/testdata/sf0.01"


def article(page):
    """Text of an article of headings and paragraphs."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = (html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))) for x in re.split(r"</?(?:h1|p)>", m[1]))
    return "\n".join(x for x in (re.sub(r"\s+", " ", b).strip() for b in blocks) if x)


def test_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    for r in extract_main_text(pages).collect():
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def site(i, body):
    menu = "".join(f"<li><a href=/{k}>Menu {k}</a></li>" for k in range(5))
    return f"""<!doctype html><html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
<div id=top><h1>My site</h1><ul>{menu}</ul></div><div class=cookie-notice><p>We use cookies</p></div>
<div class=box>{body}</div><div class=comments><p>Nice one {i}!</p></div><div class=bottom>Imprint &amp; contact</div><form><p>Search {i}</p></form></body>"""


def test_tree_finds_what_repeats(spark):
    """No element says article: what all pages of the site share goes."""
    rows = [(i, f"http://a.example/{i}", site(i, f"<h2>Story {i}</h2><p>Text &lt;{i}&gt; of\n  the <b>story</b><p>More {i}")) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Story {i}\nText <{i}> of the story\nMore {i}" for i in range(30)}


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_tree_overrules_names(spark):
    """A site whose stories stand in a box of a listed name, or outside an article that only repeats."""
    story = lambda i: f"Story {i} " + f"tells what happened on day {i} " * 20
    menu = "<nav><a href=/>Home</a></nav><div class=ad>Buy it</div>"
    rows = [(i, f"http://a.example/{i}", f"<body>{menu}<h1>Title {i}</h1><div class=notice><p>{story(i)}</p><ul><li>Point {i}</ul></div></body>") for i in range(20)]
    rows += [(100 + i, f"http://b.example/{i}", f"<body>{menu}<article><p>About us</p></article><div class=box><p>{story(i)}</p></div></body>") for i in range(20)]
    rows += [(200 + i, f"http://c.example/{i}", f"<body>{menu}<article><p>Teaser {i}</p></article><div class=box><p>{story(i)}</p></div><div class=ad>Ad {i}</div></body>") for i in range(20)]
    got = extracted(spark, rows)
    for i in range(20):
        assert got[i] == f"Title {i}\n{story(i).strip()}\nPoint {i}"
        assert got[100 + i] == story(i).strip() and got[200 + i] == f"Teaser {i}\n{story(i).strip()}"


def test_copies_are_no_evidence(spark):
    page = "<body><div class=box><h2>Story</h2><p>It happened once</p></div></body>"
    rows = [(i, f"http://a.example/{i % 10}", page) for i in range(30)]
    assert extracted(spark, rows) == dict.fromkeys(range(30), "Story\nIt happened once")


def test_extra_columns_of_clashing_names(spark):
    rows = [(i, f"http://a.example/{i}", f"<p>Text {i}</p>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as site", "'x' as host", "2 as part", "array(1) as low", "'y' as text", "0 as heavy")
    assert {r["page_id"]: r["text"] for r in extract_main_text(df).collect()} == {i: f"Text {i}" for i in range(5)}
    got = archive_round_trip(df.selectExpr("*", "'z' as record_id", "0 as payload", "1 as digest"))
    assert sorted(r["page_id"] for r in got.collect()) == list(range(5))


def test_odd_pages(spark):
    same = "<article><p>Same text</p></article>"
    rows = [(1, None, None), (2, "x", ""), (3, "http://b/", "<p>a<br>b&nbsp;c<p>d"), (4, "http://b/", "<"), (5, "http://c/", same), (6, "http://c/", same), (7, None, "<!-- <p>x</p> --><div>y"), (None, "http://d/", "<p title='>'>z</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_main_text(df).collect()}
    assert got == {1: "", 2: "", 3: "a b c\nd", 4: "<", 5: "Same text", 6: "Same text", 7: "y", None: "z"}
    assert extract_main_text(df.limit(0)).count() == 0


def test_names_of_elements():
    page = """<div class="page has-sidebar"><div id=sidebar>no</div><article><div class="post-header"><header class=header><h1>Title</h1></header></div><p>Text</p>
    <div class="share-buttons">no</div><section id="comments"><p>no</p></section><aside>no</aside></article><div role=navigation>no</div><p hidden>no</p></div>"""
    assert [b.text for b in read_page(page)[0] if not b.apart] == ["Title", "Text"]


def test_unclosed_markup():
    blocks, _ = read_page("<div><p>one<p>two<ul><li>x<li>y</ul>three</div><table><tr><td>a<td>b</table>")
    assert [b.text for b in blocks] == ["one", "two", "x", "y", "three", "a", "b"]


def test_broken_pages_take_time_in_proportion():
    for page in ("<a " * 350_000, "a<b'" * 250_000, "<a\"<b'" * 150_000, "<!x" * 330_000, "<p class=" * 110_000, "<div>" * 100_000 + "</nav>" * 100_000, "<div>" * 2_000 + "<p>x" * 60_000, "<p title='" * 100_000, "</script " * 100_000, "<a =" * 200_000):
        start = time.perf_counter()
        main_text(read_page(page)[0], {}, frozenset(), {1, 2})
        assert time.perf_counter() - start < 15, page[:8]


def test_open_ends_and_stray_quotes():
    texts = lambda page: [b.text for b in read_page(page)[0]]
    assert texts("<p>a<p class='x>b</p>") == ["a"]  # a value that never ends
    assert texts("<p>a <b x</p>c") == ["a c"] and texts("<p class=x\">a</p>\"b") == ["a", '"b']
    assert texts("<p title='>'>z<p a = \"1>2\">y") == ["z", "y"] and texts("1 < 2 <p>3<4") == ["1 < 2", "3<4"]
    deep = "<div>" * 600 + "deep" + "</div>" * 600 + "<p>after"
    assert texts(deep) == ["deep", "after"] and len(read_page(deep)[0][1].line) == 1


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    rows = [(1, "http://a/ b\n", "x\r\n\r\nWARC/1.1\r\ny"), (2, None, None), (3, "", ""), (4, "http://c/", "ü😀" * 5000), (5, "http://c/", "ü😀" * 5000), (6, "http://d/", "http://e/ 1.2.3.4 20200101000000 text/html 5\nabcde"), (7, "u", "ü😀" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in archive_round_trip(df, version).collect()}
    top: dict = {}
    for i, _, t in rows:
        top[t or ""] = i
    for i, _, t in rows:
        r, first = got[i], top[t or ""]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((t or "").encode()), digest(t))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == i else ("revisit", first))
    assert len(got) == len(rows)


def test_headers_follow_the_version(spark, tmp_path):
    """A file whose version block names the fields of version 2, with a binary payload and a plain resource."""
    http = b"HTTP/1.0 404 Not Found\r\nContent-Type: text/plain\r\n\r\n\xff\xfe\x00"
    lines = arc_version_block(2, "a.arc", "19990102030405").encode() + b"\n"
    lines += b"http://a/ 1.2.3.4 19990102030405 text/html; charset=x 404 - - 10 a.arc %d\n" % len(http) + http + b"\n"
    lines += b"dns:a 1.2.3.4 1999 text/dns 200 - - 20 a.arc 3\nabc\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.arc").write_bytes(lines)
    assert [(f["url"], f["content-type"], len(b)) for _, f, b in arc_records(lines)] == [("http://a/", "text/html; charset=x", len(http)), ("dns:a", "text/dns", 3)]
    rows = {r["url"]: r for r in read_arc(spark, f"file://{tmp_path}/in").collect()}
    assert rows["http://a/"]["status"] == 404 and bytes(rows["http://a/"]["payload"]) == b"\xff\xfe\x00"
    arc_to_warc(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    found = {r["url"]: r for r in read_warc(spark, f"file://{tmp_path}/out").collect()}
    assert found["http://a/"]["date"] == "1999-01-02T03:04:05Z" and found["dns:a"]["date"] == "1999-01-01T00:00:00Z"
    assert found["dns:a"]["record_type"] == "resource" and found["http://a/"]["payload_digest"] == base64.b32encode(hashlib.sha1(b"\xff\xfe\x00").digest()).decode()


def test_same_files_give_same_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string").coalesce(1)
    write_arc(df, f"file://{tmp_path}/arc")
    ids = []
    for k in range(2):
        arc_to_warc(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc{k}")
        ids.append(sorted((r["record_id"], r["refers_to_id"] or "") for r in read_warc(spark, f"file://{tmp_path}/warc{k}").collect()))
    assert ids[0] == ids[1] and len(ids[0]) == 2


def test_dates_and_broken_files():
    assert w3c_date("20200101000000") == "2020-01-01T00:00:00Z" and w3c_date(None) == "1970-01-01T00:00:00Z" and w3c_date("20201399") == "1970-01-01T00:00:00Z"
    assert list(arc_records(b"")) == [] and list(arc_records(b"garbage")) == [] and list(warc_records(b"WARC/1.1\r\nno end")) == []


def test_no_pages(spark):
    assert archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_trees_decide_at_several_depths(spark):
    """No name and no tag tells anything: nested boxes of what repeats go whole, with what varies in them."""
    rows = []
    for i in range(40):
        story = f"Story {i} " + f"tells what happened on day {i} in town {i * 7} " * 12
        bar = "".join(f"<div class=q{k}><div class=z>Entry number {k} of the bar that is the same everywhere</div></div>" for k in range(6))
        rows.append((i, f"http://a.example/{i}", f"""<body><div class=x1><div class=x2>{bar}<div class=w><div>You are at {i}</div></div></div></div>
<div class=x3><div class=x4><h2>Title {i}</h2><div class=x5><p>{story}</p><p>Another part {i * 3}</p></div></div><div class=x6><span>All of this is ours and stays ours, whoever reads it</span></div></div></body>"""))
    got = extracted(spark, rows)
    assert all(got[i].split("\n")[0] == f"Title {i}" and got[i].endswith(f"Another part {i * 3}") and len(got[i].split("\n")) == 3 for i in range(40))


def test_without_the_trees_all_of_it_stays():
    """The same page, read without evidence, keeps what only trees can tell."""
    from aeroskein.llm import site_style_tree as S

    blocks, _ = S.read_page("<body><div class=a><div class=b>Same</div><div>Varies 1</div></div><div class=c><p>Text 1</p></div></body>")
    assert S.main_text(blocks, {}) == "Same\nVaries 1\nText 1"
    branch = blocks[0].line[1]
    assert branch == blocks[1].line[1] and S.main_text(blocks, {}, low={branch}) == "Text 1"
    assert S.main_text(blocks, {blocks[0].path: (0.0, 0.0)}) == "Varies 1\nText 1"


def test_all_class_names_tell_nodes_apart():
    at = lambda names: read_page(f'<div class="{names}">x</div>')[0][0].path
    assert at("a b c d") != at("a b c e") and at("d c b a") == at("a b c d") and at("post-1234 a") == at("a post-777") and at("x1") != at("x2")


def test_a_host_of_many_pages_is_dealt(spark):
    """One host among many: its pages meet its own list wherever they are dealt."""
    box = lambda i: f"<body><div class=m>Menu of the site</div><div class=t><p>Text {i} of the page</p></div></body>"
    rows = [(i, f"http://big.example/{i}", box(i)) for i in range(300)] + [(1000 + i, f"http://s{i}.example/", f"<p>alone {i}") for i in range(50)]
    got = extracted(spark, rows)
    assert all(got[i] == f"Text {i} of the page" for i in range(300)) and got[1007] == "alone 7"


def test_files_are_bounded(spark, tmp_path, monkeypatch):
    """Large payloads make more files, and the longest has one of its own."""
    from aeroskein.llm import arc_warc as W

    records = [b"x" * n for n in (10, 20, 5, 100, 1, 1, 1, 1, 1)]
    monkeypatch.setattr(W, "FILE_BYTES", 40)
    monkeypatch.setattr(W, "FILE_RECORDS", 4)
    files = [f["value"][0].split(b"\n") for f in W._files(iter(records), [b"head"])]
    assert [len(f) - 1 for f in files] == [3, 1, 4, 1] and all(f[0] == b"head" for f in files)
    assert [r for f in files for r in f[1:]] == records


def test_large_payloads_come_back(spark):
    rows = [(i, f"http://a/{i}", chr(97 + i % 3) * 3_000_000 + str(i // 2)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in archive_round_trip(df).collect()}
    assert {i: (r["payload_bytes"], r["payload_digest"]) for i, r in got.items()} == {i: (len(t), digest(t)) for i, _, t in rows}
