"""HTML extraction and WARC archives."""

import gzip
import hashlib
import io
import random

import pytest

from tests.llm.helpers import clashing
from tradepulse.llm import html_text, warc

ARTICLE = "<h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b>&nbsp;text and a <a href='/x'>link</a>.<p>Second one, unclosed.<br>After a break."
WANT = "Title & more\nFirst paragraph with bold text and a link.\nSecond one, unclosed. After a break."
AROUND = [
    ("<html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>", "<footer>&copy; x</footer></body></html>"),
    ("<body><header><h2>Site</h2></header><div class='cookie-notice'>We use cookies to track you all the time.</div><main>", "</main><aside>Related: many other things to read here</aside></body>"),
    ("<div id=sidebar><p>Some long sidebar text that goes on and on for a while.</p></div><div class='post'>", "<div class='comments'><p>Nice post, dear author, thanks a lot for it!</p></div></div>"),
    ("<!-- x --><div class=ad>Buy now, it is cheap and good and you need it.</div><article>", "<form><label>Mail</label><input><button>Go</button></form></article><footer>end</footer>"),
]


@pytest.mark.parametrize("before, after", AROUND)
def test_article_without_its_surroundings(before, after):
    assert html_text.main_text(before + ARTICLE + after) == WANT


def test_whole_text_of_a_long_page():
    paragraphs = [f"Paragraph number {i} tells a little more than the one before it." for i in range(3000)]
    html = "<nav>a b c</nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert html_text.main_text(html) == "\n".join(paragraphs)


@pytest.mark.parametrize("html, want", [(None, ""), ("", ""), ("   ", ""), ("<nav>only menu</nav>", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"),
                                        ("<article><p>cut <b>off", "cut off"), ("</div></p>x<!--", "x"), ("<p>&lt;tag&gt; &#233;&#x41;</p>", "<tag> éA")])
def test_odd_pages(html, want):
    assert html_text.main_text(html) == want


SOME = "This sentence of the article is as long as such sentences are, and tells something."


@pytest.mark.parametrize("parts", [("<h1>", "Heading", "</h1><p>", "A lead.", "</p><div class=content>", *["<p>", SOME, "</p>"] * 9, "</div>"),
                                   ("<section>", *["<p>", SOME, "</p>"] * 16, "</section><section>", *["<p>", SOME, "</p>"] * 3, "</section>")])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_whole_article_around_its_containers(tag, parts):
    html = f"<body><div><a href=/>Home</a></div><div><{tag}>{''.join(parts)}</{tag}></div><div><a href=/a>Next</a></div></body>"
    assert html_text.main_text(html) == "\n".join(x for x in parts if not x.startswith(("<", ">")))


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div class='post comments-open'", "div id=page-header-layout", "form method=post",
                                     "section aria-label='Legal history'", "div class='menu-page'"])
def test_wrappers_are_no_surroundings(wrapper):
    end = wrapper.split()[0]
    inside = f"<div class=sidebar><p>{SOME}</div><div class=body>{f'<p>{SOME}' * 5}</div><form class=search><p>Search this site</form>"
    html = f"<body><nav>Home</nav><{wrapper}>{inside}</{end}><div class=comments><p>{SOME}</div></body>"
    assert html_text.main_text(html) == "\n".join([SOME] * 5)


def test_named_section_beside_others():
    html = f"<article><section>{f'<p>{SOME}' * 9}</section><section aria-label='Legal history'><p>{SOME}</section><section class=no-sidebar><p>{SOME}</section></article>"
    assert html_text.main_text(html) == "\n".join([SOME] * 11)


def test_whole_cluster_without_an_article():
    html = f"<div><div>{f'<p>{SOME}' * 16}</div><div>{f'<p>{SOME}' * 3}</div></div>"
    assert html_text.main_text(html) == "\n".join([SOME] * 19)


@pytest.mark.parametrize("html", [
    f"<article><p>{SOME}</p></article><section class=comments>{f'<p>{SOME} Really.' * 8}</section>",
    f"<div><p>{SOME}</p></div><div id=respond><ol class=commentlist>{f'<li class=comment><article><p>{SOME} Really.</article>' * 8}</ol></div>",
    f"<div class='menu-page'><p>{SOME}</p></div><div class=comments>{f'<p>{SOME} Really.' * 8}</div>",
    f"<main><p>{SOME}</p></main><aside>{f'<p>{SOME}' * 9}</aside><div class=sidebar>{f'<p>{SOME} Aside.' * 9}</div>",
])
def test_a_short_article_under_long_comments(html):
    assert html_text.main_text(f"<body>{html}</body>") == SOME


@pytest.mark.parametrize("end", ["<div>&copy; 2024 Example</div>", "<div><p>Imprint</p><p>Mail us</p></div>", "<div><a href=/a>About</a> <a href=/b>Us</a></div>", ""])
@pytest.mark.parametrize("menu", ["<div><a href=/>Home</a><a href=/n>News</a></div>", "<div><span>Home</span><span>News</span></div>",
                                  "<div><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div>", "<ul><li><a href=/>Home</a><li><a href=/n>News</a></ul>"])
def test_unmarked_menus_and_footers(menu, end):
    """Nothing but the layout tells the article: what surrounds it stands in containers of its own."""
    body = f"<div><h1>The heading</h1>{f'<p>{SOME}' * 4}<p>The end.</div>"
    want = "\n".join(["The heading", *[SOME] * 4, "The end."])
    assert html_text.main_text(f"<body>{menu}{body}{end}</body>") == want
    apart = f"<div><h1>The heading</h1></div><div>{f'<p>{SOME}' * 4}<p>The end.</div>"
    assert html_text.main_text(f"<body>{menu}{apart}{end}</body>") == want


def test_header_of_an_article_and_labels_in_a_sentence():
    html = f"<header><h2>Site</h2></header><article><header><h1>Title</h1></header><p>{SOME} With a <label>label</label>.<form><label>Mail</label><input></form></article>"
    assert html_text.main_text(html) == f"Title\n{SOME} With a label."


def test_deep_pages_take_time_and_memory_by_their_length():
    import time
    import tracemalloc

    used = []
    for depth in (2000, 16000):
        html = "<div>" * depth + f"<p>{SOME}</p>" + "</section>" * depth + "x</div>" * depth
        tracemalloc.start()
        started = time.perf_counter()
        assert SOME in html_text.main_text(html)
        used.append((time.perf_counter() - started, tracemalloc.get_traced_memory()[1]))
        tracemalloc.stop()
    assert used[1][0] < 8 * 4 * used[0][0] + 0.5 and used[1][1] < 8 * 2 * used[0][1]


PAGES = "page_id bigint, url string, html string"


def test_extract_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (2, None, None), (None, "u", ""), (3, "u", "<article><p>" + "x " * 200_000 + "</article>")]
    got = html_text.extract(clashing(spark.createDataFrame(rows, PAGES))).collect()
    assert sorted(str((r.page_id, r.url, len(r.text))) for r in got) == sorted(str(x) for x in [(1, "u", 1), (1, "u", 1), (2, None, 0), (None, "u", 0), (3, "u", 399_999)])
    assert html_text.extract(spark.createDataFrame([], PAGES)).count() == 0


def records(n=6, seed=1):
    r = random.Random(seed)
    return [warc.record("response", f"urn:x-page:{i}", f"https://x/{i}", "2024-01-01T00:00:00Z", bytes(r.choices(b"abc \r\n", k=r.randrange(0, 5000)))) for i in range(n)]


def salvaged(data):
    rows = list(warc.salvage(io.BytesIO(data), "f"))
    at = 0
    for row in rows:  # records and gaps tile the archive
        assert row["offset"] == at
        at += row["length"]
    assert at == len(data)
    return [r["record_id"] for r in rows if r["error"] is None], [(r["offset"], r["length"]) for r in rows if r["error"]]


NAMES = [f"urn:x-page:{i}" for i in range(6)]


@pytest.mark.parametrize("pack", [gzip.compress, bytes])
def test_salvage(pack):
    parts = [pack(x) for x in records()]
    whole = b"".join(parts)
    assert salvaged(whole) == (NAMES, [])
    start, n = sum(map(len, parts[:2])), len(parts[2])
    lost = (NAMES[:2] + NAMES[3:], [(start, n)])
    middle = start + n // 2
    assert salvaged(whole[:middle] + bytes([whole[middle] ^ 255]) + whole[middle + 1:]) == lost
    assert salvaged(whole[:start] + bytes(n) + whole[start + n:]) == lost
    junk = b"\x1f\x8b\x08 WARC/1.1 no record \r\n\r\n" * 50
    assert salvaged(junk + whole) == (NAMES, [(0, len(junk))])
    got, gaps = salvaged(whole[:-10])
    assert got == NAMES[:5] and gaps == [(len(whole) - len(parts[5]), len(parts[5]) - 10)]
    assert salvaged(b"") == ([], []) and salvaged(junk) == ([], [(0, len(junk))])


def test_salvage_across_reads(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 97)
    parts = [gzip.compress(x) for x in records(seed=3)]
    assert salvaged(b"".join(parts)) == (NAMES, [])
    junk = random.Random(5).randbytes(5000)
    assert salvaged(b"".join(parts[:3]) + junk + b"".join(parts[3:])) == (NAMES, [(sum(map(len, parts[:3])), 5000)])


def test_salvage_bounds_a_record():
    bomb = gzip.compress(warc.record("response", "urn:x-page:9", "u", "d", bytes(1 << 20)))
    good = gzip.compress(records()[0])
    rows = list(warc.salvage(io.BytesIO(bomb + good), longest=10_000))
    assert [r["error"] for r in rows] == ["member too long", None]


@pytest.mark.parametrize("pack", [gzip.compress, bytes])
def test_salvage_of_a_long_header(monkeypatch, pack):
    monkeypatch.setattr(warc, "READ_BYTES", 10_000)
    long = warc.record("response", "urn:x-page:8", "data:" + "u" * 100_000, "2024-01-01T00:00:00Z", b"page")
    assert salvaged(b"".join(map(pack, [*records(2), long, *records(2)]))) == (NAMES[:2] + ["urn:x-page:8"] + NAMES[:2], [])


def test_round_trip(spark):
    same, small = "same " * 300, "small"
    rows = [(1, "u1", same), (5, "u5", same), (3, "u3", same), (2, "u", small), (4, "u", small), (6, None, None), (7, "u r l\n", ""),
            (8, "u", "é" * 600), (9, "u", "z" * 3_000_000), (10, "u", "twice " * 300), (10, "u", "twice " * 300), (None, "u", same)]
    got = warc.archive_round_trip(clashing(spark.createDataFrame(rows, PAGES))).collect()
    assert all(r.error is None for r in got)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = max((j for j, _, h in rows if h == html and j is not None), default=None) if len(data) >= 1000 and i is not None else i
        kind = "revisit" if first != i else "response"
        want.append(str((f"urn:x-page:{'' if i is None else i}", kind, len(data), hashlib.sha1(data).hexdigest(), f"urn:x-page:{first}" if kind == "revisit" else None)))
    assert sorted(str((r.record_id, r.type, r.payload_bytes, r.payload_digest, r.refers_to)) for r in got) == sorted(want)
    assert {bytes(r.payload) for r in got if r.type == "response"} == {(h or "").encode() for _, _, h in rows}


def test_round_trip_of_nothing(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0
