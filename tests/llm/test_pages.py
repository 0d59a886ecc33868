import base64
import gzip
import hashlib
import io
import json
import random
import struct
import time
import zipfile

import pytest

from newscov.llm import html_text as H
from newscov.llm import url_filter as U
from newscov.llm import warc as W

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


# --- URL filters --------------------------------------------------------------------


def judged(spark, urls, rules=RULES, **more):
    df = spark.createDataFrame([(i, u, "h", "s") for i, u in urls], "page_id LONG, url STRING, host STRING, stack STRING")
    table = spark.createDataFrame(rules, "host STRING, path STRING, verdict STRING")
    return sorted((tuple(r) for r in U.judge_urls(df, table, **more).collect()), key=repr)


def expected(urls, rules=RULES):
    out = []
    for ident, url in urls:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len((h + p).encode()), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        out.append((ident, host, path, rule, verdict))
    return sorted(out, key=repr)


def test_urls(spark):
    rng = random.Random(0)
    hosts = ["net", "a.net", "EXAMPLE.net", "b.c.example.net", "notexample.net", "example.com", "x.example.com", "org", "q.org", "other", "a..b.net", ".net", "net.", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/1", "/fr/", "/fr", "/EN/", "?q=/en/", "#/de/", "/é/\U0010ffff", "/en/?a://b", "/en/#x"]
    urls = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(300)]
    urls += [(1000, None), (1001, ""), (1002, "no scheme/en/"), (1003, "://net/x"), (1004, "http://" + "a." * 3000 + "net/x"), (5, urls[5][1]), (5, urls[5][1]), (None, "x://net/")]
    assert judged(spark, urls) == expected(urls)


def test_nested_rules_and_ties(spark):
    rules = [("net", "/", "block"), ("net", "/a", "allow"), ("net", "/ab", "block"), ("x.net", "/", "allow"), ("net", "/a", "block"), ("com", "", "block"), (None, "/", "block")]
    urls = [(i, f"h://{h}{p}") for i, (h, p) in enumerate((h, p) for h in ("net", "x.net", "y.x.net", "com", "z.com") for p in ("", "/", "/a", "/abc", "/b"))]
    got = judged(spark, urls, rules)
    kept = [("net", "/", "block"), ("net", "/a", "allow"), ("net", "/ab", "block"), ("x.net", "/", "allow"), ("com", "", "block")]
    assert [r[:3] for r in got] == [r[:3] for r in expected(urls, kept)]
    rule = {r[0]: r[3:] for r in got}
    assert rule[2] == ("net/a", "allow") and rule[3] == ("net/ab", "block") and rule[15] == ("com", "block")


def test_empty_tables(spark):
    assert judged(spark, []) == []
    empty = spark.createDataFrame([], "host STRING, path STRING, verdict STRING")
    df = spark.createDataFrame([(1, "http://net/")], "page_id LONG, url STRING")
    assert [tuple(r) for r in U.judge_urls(df, empty).collect()] == [(1, "net", "/", None, "allow")]


# --- WARC ------------------------------------------------------------------------------


def archived(spark, rows, **more):
    df = spark.createDataFrame([(*r, "d") for r in rows], "page_id LONG, url STRING, html STRING, digest STRING")
    archives, folder = W.write_archives(df, **more)
    return archives, W.read_archives(archives, folder, with_payload=True).collect()


def test_round_trip(spark):
    rng = random.Random(1)
    pages = ["", None, "é" * 50, "<p>x</p>", "\r\n\r\nWARC/1.0\r\n", "z" * 300_000]
    rows = [(i, rng.choice(["http://a/", None, "http://a/\r\nX: y é"]), rng.choice(pages)) for i in rng.sample(range(500), 60)]
    archives, got = archived(spark, rows, member_bytes=500, archive_bytes=2_000, force_zip64=True)
    assert archives.count() > 2
    first = {}
    for ident, _, html in sorted(rows):
        first.setdefault(html or "", ident)
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for ident, _, html in rows:
        payload, r = (html or "").encode(), by_id[ident]
        response = first[html or ""] == ident
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if response else ("revisit", first[html or ""]))
        assert r.payload == (payload if response else None)


def test_archives_are_stored_zips(spark):
    archives, _ = archived(spark, [(i, "http://a/", f"page {i}") for i in range(20)], force_zip64=True)
    for row in archives.collect():
        with zipfile.ZipFile(row.path) as z:
            assert z.testzip() is None
            assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            assert {i.filename.split("/")[0] for i in z.infolist()} == {"archive", "indexes"}


def test_small_payloads_may_stay_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough"), (None, "u", "long enough"), (3, "u", "long enough")]
    _, got = archived(spark, rows, least_bytes=5)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=repr)
    assert kinds == sorted([(1, "response", None), (2, "response", None), (3, "response", None), (3, "response", None), (4, "revisit", 3), (None, "revisit", 3)], key=repr)


def test_no_pages(spark):
    archives, got = archived(spark, [])
    assert archives.count() == 0 and got == []


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\5\6 not the end", b"x" * 65_535])
def test_members_by_the_central_directory(wide, comment):
    out = io.BytesIO(b"")
    writer = W.ZipWriter(out, wide)
    places = {f"m{i}": (writer.add(f"m{i}", bytes([i]) * i), i) for i in range(40)}
    writer.close()
    data = out.getvalue()
    data = data[:-2] + struct.pack("<H", len(comment)) + comment
    found = {n: (at, size) for n, method, at, size in W.zip_members(io.BytesIO(data), len(data))}
    assert found == places


def test_compressed_members_are_refused(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data-00000.warc.gz", b"x" * 100)
    df = spark.createDataFrame([(str(tmp_path / "a.zip"), (tmp_path / "a.zip").stat().st_size)], "path STRING, bytes LONG")
    with pytest.raises(Exception, match="not stored"):
        W.read_archives(df, f"file://{tmp_path}").collect()


# --- main text ------------------------------------------------------------------------------


def extracted(spark, rows):
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id LONG, url STRING, html STRING, container STRING")
    return {r.page_id: (r.text, r.n_chars) for r in H.main_text(df).collect()}


def template(i, body):
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>"
        f"<div class='navBar'><a href='/'>Home</a> <a href='/{i}'>n{i}</a></div><div class=content>{body}</div>"
        f"<div class='x1'>Read our rules</div><form><p>Mail</p></form><section id=comments><p>Comment {i}</p></section>"
        f"<script>var a='<p>no</p>';</script><div role=contentinfo>c {i}</div></body></html>"
    )


def test_template_without_article(spark):
    rows = [(i, f"http://h.org/{i}", template(i, f"<h2>Title {i}</h2><p>Some long text of page {i} &amp; more.<br>End&nbsp;{i}")) for i in range(6)]
    got = extracted(spark, rows)
    for i in range(6):
        text = f"Title {i}\n\nSome long text of page {i} & more. End {i}"
        assert got[i] == (text, len(text))


def test_constant_text_in_the_article_is_template(spark):
    page = "<article><p class=lead>Share this story</p><h1>{0}</h1><p>Text {0}</p><aside>see {0}</aside><p>More {0}</article><p>after"
    rows = [(i, "http://a.com/x", page.format(f"no {i}")) for i in range(5)] + [(9, "http://b.com/", page.format("alone"))]
    got = extracted(spark, rows)
    assert got[3][0] == "no 3\n\nText no 3\n\nMore no 3"
    assert got[9][0] == "Share this story\n\nalone\n\nText alone\n\nMore alone"  # one page of a host shows no template


def test_copies_do_not_make_a_template(spark):
    page = "<article><h1>One</h1><p>Same text everywhere</p></article>"
    got = extracted(spark, [(i, "http://a.com/", page) for i in range(8)])
    assert set(got.values()) == {("One\n\nSame text everywhere", 25)}


ARTICLE = "<h1>The one title</h1><h2>Part</h2><p>{0} quick brown foxes jump over the lazy dogs of this town every day.</p>"
WHOLE = "The one title\n\nPart\n\n{0} quick brown foxes jump over the lazy dogs of this town every day."


@pytest.mark.parametrize("around", ["<script>var n={0}</script>{1}", "<div class=ad>Buy {0}</div>{1}", "<!-- {0} -->{1}", "<div class=x>Offer {0}</div>{1}"])
def test_near_copies_around_an_article_do_not_make_it_a_template(spark, around):
    rows = [(i, "http://a.com/", around.format(i, f"<article>{ARTICLE.format('Many')}</article>")) for i in range(6)]
    assert {t for t, _ in extracted(spark, rows).values()} == {WHOLE.format("Many")}


def test_near_copies_of_an_article_do_not_make_its_title_a_template(spark):
    rest = "".join(f"<p>Paragraph {i} says that nothing new has happened in place {i * i}.</p>" for i in range(20))
    for head in ("<article>", "<article id='post-ab1'>"):
        rows = [(i, "http://a.com/", f"<p>before</p>{head}{ARTICLE.format(f'Some{i}')}{rest}</article>") for i in range(40)]
        if "id" in head:  # other articles on the host
            rows += [(100 + i, "http://a.com/", f"<article id='p{i}x'><h1>Title {i}</h1><p>Text of number {i}") for i in range(5)]
        got = extracted(spark, rows)
        for i in range(40):
            assert got[i][0].startswith(WHOLE.format(f"Some{i}") + "\n\nParagraph 0 says")


def test_articles_that_all_have_a_copy_still_show_the_template(spark):
    page = "<article><p class=lead>Share this story</p><h1>{0}</h1><p>Text {0}</p></article><!-- {1} -->"
    rows = [(10 * i + k, "http://a.com/x", page.format(f"of the day {i}", k)) for i in range(3) for k in range(2)]
    assert extracted(spark, rows)[21][0] == "of the day 2\n\nText of the day 2"


AROUND = "<body><header>Site</header><div class=wrap><div class=content>{}</div><div class=sidebar><p>Seen {}</p></div></div><p>at {}</p>"
LONG = "<p>This is sentence {} of {} and it says as much as it can.</p>"


@pytest.mark.parametrize("between", ["", "<div class=ad>Buy</div>"])
def test_what_stands_beside_the_body_of_an_article_stays(spark, between):
    def page(i):
        first, second = ("".join(LONG.format(k, i) for k in r) for r in (range(6), range(6, 9)))
        body = f"<h1>T{i}</h1><p class=lead>Lead {i}</p>{between}<div class=b1>{first}</div>{between}<div class=b2>{second}</div>"
        return AROUND.format(body, i, i)

    got = extracted(spark, [(i, "http://a.com/", page(i)) for i in range(6)])
    for i in range(6):
        sentences = [f"This is sentence {k} of {i} and it says as much as it can." for k in range(9)]
        assert got[i][0].split("\n\n") == [f"T{i}", f"Lead {i}", *sentences]


def test_a_title_outside_the_container_stays(spark):
    page = "<body><nav>Home</nav><h1>T{0}</h1><div class=body>" + LONG.format("{0}", "{0}") * 3 + "</div><p>at {0}</p><footer>f</footer>"
    got = extracted(spark, [(i, "http://a.com/", page.format(i)) for i in range(5)])
    assert got[2][0].split("\n\n") == ["T2"] + ["This is sentence 2 of 2 and it says as much as it can."] * 3


def test_one_declared_article_leaves_other_pages_their_container(spark):
    rows = [(i, "http://a.com/", AROUND.format(f"<h2>T{i}</h2>" + LONG.format(i, i) * 3, i, i)) for i in range(6)]
    got = extracted(spark, [*rows, (9, "http://a.com/", "<article><p>declared</p></article><p>not")])
    assert got[9][0] == "declared"
    assert got[4][0].split("\n\n") == ["T4"] + ["This is sentence 4 of 4 and it says as much as it can."] * 3


def test_odd_pages(spark):
    rows = [
        (1, "http://a/", None), (2, None, ""), (3, "http://a/", "plain text"), (4, "x", "<nav>menu</nav>"), (5, "http://a/", "<p>" * 3000 + "deep"),
        (6, "http://a/", "<div>" * 3000 + "deep" + "</span></b>" * 3000), (7, "http://a/", "<article><p>cut &am"), (8, "http://a/", "<article><p>a<!-- x <p>b"),
        (9, "http://a/", "<article><ul><li>one<li>two</ul><p hidden>no</p><div style='display: none'>no</div><table><tr><td>c1<td>c2</table>"),
        (10, "http://a/", "<article><p title='a>b'>quoted</p><textarea>no</textarea>&lt;b&gt; &#233;&#x1F600;  \n x"), (None, "http://a/", "<p>null id"),
        (11, "http://a/", "<article><header><h1>Own head</h1></header><p>t</p><footer>no</footer></article>"), (3, "http://a/", "plain text"),
    ]
    got = extracted(spark, rows)
    assert got[1] == got[2] == got[4] == ("", 0)
    assert got[3][0] == "plain text" and got[5][0] == got[6][0] == "deep"
    assert got[7][0] == "cut &am" and got[8][0] == "a"
    assert got[9][0] == "one\n\ntwo\n\nc1\n\nc2"
    assert got[10][0] == "quoted\n\n<b> é😀 x" and got[11][0] == "Own head\n\nt" and got[None][0] == "null id"


def test_no_rows(spark):
    assert extracted(spark, []) == {}


def test_markup_of_unclosed_tags_is_linear():
    for piece in ("<a b ", "<a '\" ", '<a ">" ', "<script ", "<", "<!", "</p "):
        page = piece * ((1 << 20) // len(piece))
        start = time.time()
        list(H.markup(page))
        assert time.time() - start < 5, piece


def test_markup():
    page = """a<p class="x>y">b<!-- <i> -->c<br/><SCRIPT a='>'>if (a<b) "</p>"</Script >d<>e< f</p>g<q r"""
    found = [(page[a:b], slash, name, attributes) for a, b, slash, name, attributes in H.markup(page)]
    assert found == [
        ('<p class="x>y">', "", "p", ' class="x>y"'), ("<!-- <i> -->", "", None, ""), ("<br/>", "", "br", "/"),
        ("""<SCRIPT a='>'>if (a<b) "</p>"</Script >""", "", None, ""), ("</p>", "/", "p", ""),
    ]
    assert list(H.markup("")) == [] and [m[:2] for m in H.markup("<!-- open")] == [(0, 9)]


@pytest.mark.parametrize("packed", [False, True])
def test_one_index_over_two_archives(spark, tmp_path, packed):
    """A package of another make: its index has another name than its archives and may be gzipped."""
    pages = spark.createDataFrame([(i, f"http://e.net/{i}", f"<p>{i}</p>") for i in range(6)], "page_id LONG, url STRING, html STRING")
    written, folder = W.write_archives(pages.coalesce(1), str(tmp_path / "own"), member_bytes=1)
    with zipfile.ZipFile(written.first()["path"]) as own:
        archives = {n: own.read(n) for n in own.namelist() if n.startswith("archive/")}
        lines = b"".join(own.read(n) for n in own.namelist() if n.startswith("indexes/"))
    assert len(archives) == 6
    names = sorted(archives)
    both = {"archive/first.warc.gz": names[:3], "archive/second.warc.gz": names[3:]}
    entries = []
    (tmp_path / "foreign").mkdir()
    path = tmp_path / "foreign" / "package.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        for name, parts in both.items():
            out.writestr(name, b"".join(archives[p] for p in parts))
            at = 0
            for part in parts:
                line = next(x for x in lines.splitlines() if part.rpartition("/")[2].encode() in x)
                head = line.split(b" ", 2)[:2]
                entry = {"offset": str(at), "length": str(len(archives[part])), "filename": name.rpartition("/")[2]}
                entries.append(b" ".join([*head, json.dumps(entry).encode()]))
                at += len(archives[part])
        index = b"\n".join(entries) + b"\n"
        out.writestr("indexes/index.cdx.gz" if packed else "indexes/index.cdx", gzip.compress(index) if packed else index)
        out.writestr("indexes/index.idx", b"com,example)/ 2024 index.cdx.gz\t0\t1\n")
    foreign = spark.createDataFrame([(str(path), path.stat().st_size)], "path STRING, bytes LONG")
    got = sorted((r["page_id"], r["payload"]) for r in W.read_archives(foreign, str(tmp_path / "foreign"), with_payload=True).collect())
    assert got == [(i, f"<p>{i}</p>".encode()) for i in range(6)]
