"""Pages: URL rules and model, WARC packages, main text; FLAC streams."""

from __future__ import annotations

import datetime
from decimal import Decimal
import base64
import hashlib
import io
import re
import struct
import time
import zipfile
import zlib

import numpy as np
import pytest

from cohortix.llm import flac, html_text, url_filter, warc
from cohortix.llm.common import shared_dir


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, verdict string, text string")


# ---- URLs ------------------------------------------------------------------------------------------


def test_rules_and_parts(spark):
    urls = {
        1: ("http://WWW.Example.COM/en/a?b#c", "www.example.com", "/en/a", "www.example.com/en/", "allow"), 2: ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        3: ("x://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), 4: ("http://a.net/es/?q", "a.net", "/es/", "net/es/", "block"), 5: ("http://a.net/esx", "a.net", "/esx", None, None),
        6: (None, "", "", None, None), 7: ("no scheme", "", "", None, None), 8: ("http://com", "com", "", None, None), 9: ("http://h.org#a/b", "h.org", "", None, None), 10: ("://b.com/", "b.com", "/", "com/", "allow"),
    }
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages(spark, [(i, v[0], "") for i, v in urls.items()])).collect()}
    for i, (_, host, path, rule, verdict) in urls.items():
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] in ("allow", "block") and (verdict is None or got[i]["verdict"] == verdict)


def test_scores_equal_a_plain_model(spark):
    rows = [(f"{h}/{w}", y) for y, h, ws in ((True, "good.com", "abc abd abe bcd".split()), (False, "bad.net/es", "zzx zzy zyx".split())) for w in ws]
    train = spark.createDataFrame([(t, y, 2) for t, y in rows], "text string, yes boolean, n long")
    test = spark.createDataFrame([("good.com/zz",), ("bad.org/abc",), ("q",)], "text string")
    order = 2
    import math
    from collections import Counter, defaultdict

    cnt = {y: defaultdict(Counter) for y in (True, False)}
    for t, y in rows:
        s = "\x02" * order + t + "\x03"
        for i in range(order, len(s)):
            for k in range(order + 1):
                cnt[y][s[i - k : i]][s[i]] += 2

    def p(y, ctx, c):
        out = 1 / 256
        for k in range(order + 1):
            own = cnt[y][ctx[len(ctx) - k :]]
            if own:
                out = (own[c] + len(own) * out) / (sum(own.values()) + len(own))
        return out

    for r in url_filter.lm_scores(test, train, order, shared_dir(spark)).collect():
        s = "\x02" * order + r["text"] + "\x03"
        want = [math.log(p(True, s[i - order : i], s[i]) / p(False, s[i - order : i], s[i])) for i in range(order, len(s))]
        assert r["score"] == pytest.approx(sum(want) / len(want), abs=1e-9)


def test_very_long_urls_take_time_in_proportion(spark):
    import time

    train = spark.createDataFrame([("good.com/a", True, 1), ("bad.net/es/b", False, 1)], "text string, yes boolean, n long")
    took = []
    for n in (1_000, 25_000, 100_000):  # the first warms up
        start = time.perf_counter()
        got = url_filter.lm_scores(spark.createDataFrame([("h.org/" + "é=%20x" * (n // 6),)], "text string"), train, 4, shared_dir(spark)).collect()
        took.append(time.perf_counter() - start)
        assert len(got) == 1 and len(got[0]["text"]) > n * 0.9
    assert took[2] < 4 * took[1] + 5


def test_url_filter_is_native(spark):
    plan = url_filter.judge_urls(pages(spark, [(1, "http://a.com/x", ""), (2, "http://a.net/es/x", ""), (3, "http://a.org/x", "")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "Cartesian"))


# ---- WARC --------------------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    rows = [(1, "http://a/", "same"), (5, "http://b/\n", "same"), (3, None, "same"), (2, "u", ""), (4, "u", None), (9, "u", "ü" * 5000)]
    got = {r["page_id"]: tuple(r)[1:5] for r in warc.archive_and_read(pages(spark, rows)).collect()}
    for i, _, h in rows:
        p = (h or "").encode()
        top = max(j for j, _, t in rows if (t or "") == (h or ""))
        assert got[i] == (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if i == top else "revisit", None if i == top else top)
    assert warc.archive_and_read(pages(spark, [])).collect() == []
    small = {r["page_id"]: r["record_type"] for r in warc.archive_and_read(pages(spark, rows), least=5).collect()}
    assert set(small.values()) == {"response"}


def test_ids_and_urls_of_any_kind(spark):
    odd = ["http://h/\u2028x", "http://h/\x85", "a\x0cb\x1c c", "http://h/\r\nWARC-Type: x", "", None, "http://h/ü?%20"]
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_and_read(pages(spark, [(i, u, f"p{i}") for i, u in enumerate(odd)])).collect()}
    assert got == {i: ("response", None) for i in range(len(odd))}
    rows = spark.createDataFrame([("a:b", "u", "x"), ("c:b", "u", "x"), ("", "u", "y"), (None, "u", "z"), ("=%é\n", "u", "w")], "page_id string, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_and_read(rows).collect()}
    assert got == {"a:b": ("revisit", "c:b"), "c:b": ("response", None), "": ("response", None), None: ("response", None), "=%é\n": ("response", None)}
    ints = warc.archive_and_read(spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id int, url string, html string"))
    assert dict(ints.dtypes)["page_id"] == dict(ints.dtypes)["refers_to"] == "int" and {r["page_id"]: r["refers_to"] for r in ints.collect()} == {1: 2, 2: None}


def test_packages_keep_payloads_and_offsets(tmp_path):
    path = f"file://{tmp_path}/p.wacz"
    p = warc.Package(path)
    for i in range(50):
        body = f"<p>{i}</p>".encode() * i
        p.add(warc.record("response", f"urn:x:{i}", f"http://h/{i}", body, warc.digest(body), None), {"urlkey": str(i), "id": i, "payload_bytes": len(body)})
    p.close()
    got = {e["id"]: block.partition(b"\r\n\r\n")[2] for e, _, block in warc.records(path, near=300)}
    assert got == {i: f"<p>{i}</p>".encode() * i for i in range(50)}
    z, f = warc.open_package(path)
    with f, zipfile.ZipFile(f"{tmp_path}/p.wacz") as ref:
        assert set(z.members) == set(ref.namelist()) and z.whole(warc.INDEX) == ref.read(warc.INDEX)


@pytest.mark.parametrize("kind,ids", [("double", [1.5, 1.25, 10.0, 9.0]), ("date", [datetime.date(2024, 1, d) for d in (2, 1, 30, 9)]), ("binary", [bytearray(b"b\xff"), bytearray(b"a:"), bytearray(b"z"), bytearray(b"\x00")]), ("decimal(5,2)", [Decimal("2.50"), Decimal("2.25"), Decimal("10.00"), Decimal("9.00")])])
def test_ids_of_other_types_keep_value_and_order(spark, kind, ids):
    rows = spark.createDataFrame([(ids[0], "u", "x"), (ids[1], "u", "x"), (ids[2], "u", "y"), (ids[3], "u", "y")], f"page_id {kind}, url string, html string")
    out = warc.archive_and_read(rows)
    assert dict(out.dtypes)["page_id"] == kind
    plain = lambda x: bytes(x) if isinstance(x, bytearray) else x
    got = {plain(r["page_id"]): (r["record_type"], plain(r["refers_to"])) for r in out.collect()}
    a, b, c, d = map(plain, ids)
    assert got == {a: ("response", None), b: ("revisit", a), c: ("response", None), d: ("revisit", c)}


def test_zip64_and_bad_archives():
    data = b"stored bytes"
    local = struct.pack("<4s5HIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + b"m" + struct.pack("<HHQQ", 1, 16, len(data), len(data))
    central = struct.pack("<4s6HIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, 1, 28, 0, 0, 0, 0, 0xFFFFFFFF) + b"m" + struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    at = len(local) + len(data)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    loc = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 7) + b"comment"
    raw = local + data + central + end64 + loc + end
    z = warc.ZipRanges(len(raw), lambda o, n: raw[o : o + n])
    assert z.whole("m") == data and z.range("m", 7, 5) == b"bytes"
    with pytest.raises(ValueError):
        z.range("m", 7, 6)
    with pytest.raises(ValueError):
        warc.ZipRanges(4, lambda o, n: b"nope")
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as w:
        w.writestr("m", b"x" * 100)
    raw2 = packed.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        warc.ZipRanges(len(raw2), lambda o, n: raw2[o : o + n]).whole("m")
    with pytest.raises(ValueError):
        warc.parse_record(warc.record("response", "urn:x", "u", b"abc", warc.digest(b"abc"), None).replace(b"abc", b"abd"))


# ---- main text -----------------------------------------------------------------------------------------

ARTICLE = "<h1>A title</h1><p>First paragraph of the story with <a href=/x>a link</a> and more words.<p>Second &amp; last,\n one  <b>bold</b> word.</p>"
TEXT = "A title\n\nFirst paragraph of the story with a link and more words.\n\nSecond & last, one bold word."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class='ad'>Buy this now.</div><article>{ARTICLE}</article><footer>&copy; us</footer></body></html>",
        f"<body><header><div>Site name</div><a href=/>Home</a></header><main>{ARTICLE}<aside>Related things to read</aside></main><div id=comments><p>I think this is a fine comment that is long.</p></div>",
        f"<div class='cookie-notice'><p>We use cookies to improve your experience on this site today.</p></div><div class=sidebar><p>Follow us for more of these interesting stories.</p></div><div class=content>{ARTICLE}<form><label>Mail</label><input><button>Send</button></form></div>",
        f"<article><header><!-- x --></header>{ARTICLE}<div class='advertisement'>A very long advert text that talks about many things you could buy.</div><section class='comment-list'><p>Reader says hello to everybody here.</p></section></article>",
        f"<article>{ARTICLE}</article><script>unclosed",
    ],
)
def test_main_text(page):
    assert html_text.text_of(page) == TEXT


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<"), (4, "u", "<p>a < b &lt; c &#x41;&nbsp;d</p>"), (5, "u", "<article><p>x" + " y" * 50_000), (1, "u", None)]
    got = sorted((r["page_id"], r["n_chars"]) for r in html_text.extract_text(pages(spark, rows)).collect())
    assert [i for i, _ in got] == [1, 1, 2, 3, 4, 5] and got[0][1] == got[1][1] == got[2][1] == 0 and got[5][1] == 100_001
    assert html_text.text_of("<article><p>a < b &lt; c &#x41;&nbsp;d</p></article>") == "a < b < c A d"


def test_tree_fits_its_table():
    x, y = html_text.table()

    def go(node, row):
        while not isinstance(node, float):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node >= 0.5

    assert np.mean([go(html_text.tree(), r) == t for r, t in zip(x, y, strict=True)]) > 0.97


# ---- FLAC ----------------------------------------------------------------------------------------------


def test_streams_round_trip_and_are_checked():
    r = np.random.default_rng(0)
    texts = [b"", b"a", b"Lorem ipsum " * 500, r.integers(0, 256, 7000, np.uint8).tobytes(), b"\x00" * 400, bytes(range(256)) * 20, b"\xff\x00" * 3000]
    payloads = [flac.payload_of(t) for t in texts]
    media = flac.encode(payloads)
    assert flac.decode(media) == payloads and all(len(p) % 192 == 0 and p.startswith(t) for p, t in zip(payloads, texts, strict=True))
    total, _, at, points = flac._stream(media[2])
    assert total == len(payloads[2]) and flac._frames(media[2], at, [], total) == flac._frames(media[2], at, points, total)
    bad = bytearray(media[2])
    bad[at + 40] ^= 1
    with pytest.raises(ValueError, match="checksum|frames"):
        flac.decode([bytes(bad)])


def frame(body_bits: str, n: int) -> bytes:
    head = bytes([0xFF, 0xF8, (7 << 4), 0x02, 0]) + struct.pack(">H", n - 1)
    head += bytes([flac.crc8(head)])
    bits = body_bits + "0" * (-len(body_bits) % 8)
    raw = head + int(bits, 2).to_bytes(len(bits) // 8, "big")
    crc = int(flac.crc16_lanes(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0])
    return raw + crc.to_bytes(2, "big")


def stream(frames: bytes, total: int) -> bytes:
    info = struct.pack(">HH", 16, 16) + bytes(6) + ((8000 << 44) | (7 << 36) | total).to_bytes(8, "big") + bytes(16)
    return b"fLaC\x80" + len(info).to_bytes(3, "big") + info + frames


def test_other_subframes_are_decoded():
    b8 = lambda v: format(v & 0xFF, "08b")
    x = [3, -4, 7, 100, -128, 127, 0, 1] * 2
    constant = frame("0" + "000000" + "0" + b8(-5), 16)
    verbatim = frame("0" + "000001" + "0" + "".join(map(b8, x)), 16)
    wasted = frame("0" + "000001" + "1" + "01" + "".join(format((v >> 2) & 63, "06b") for v in [4 * v for v in range(16)]), 16)
    escaped = frame("0" + "001001" + "0" + b8(10) + "00" + "0000" + "1111" + "00101" + "".join(format(v & 31, "05b") for v in [1, -1] * 7 + [3]), 16)
    long_run = frame("0" + "001000" + "0" + "00" + "0000" + "0000" + "0" * 60 + "1" + "1" * 15, 16)
    got = flac.decode([stream(constant + verbatim + wasted + escaped + long_run, 80)])[0]
    s = (np.frombuffer(got, np.uint8).astype(int) - 128).tolist()
    assert s[:16] == [-5] * 16 and s[16:32] == x and s[32:48] == [4 * v for v in range(16)]
    assert s[48:64] == np.cumsum([10] + [1, -1] * 7 + [3]).tolist() and s[64:80] == [30] + [0] * 15


def test_media_columns(spark, docs):
    rows = [(1, "héllo"), (2, None), (3, ""), (4, "x" * 10_000), (5, "héllo"), (None, "héllo")]
    media = flac.store_texts(docs(rows))
    got = {r["doc_id"]: r for r in flac.media_features(media).collect()}
    for i, t in rows:
        raw = (t or "").encode()
        p = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        g = got[i]
        assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    assert got[1]["media_sha256"] == got[5]["media_sha256"] == got[None]["media_sha256"] and got[2]["feature"] == got[3]["feature"]
    blocks = sorted((r["sample_offset"], bytes(r["pcm"])) for r in flac.pcm_blocks(media.where("doc_id = 4")).collect())
    assert b"".join(p for _, p in blocks) == bytes([ord("x") ^ 0x80]) * 10_000 + bytes([ord(" ") ^ 0x80]) * (-10_000 % 192) and blocks[1][0] == flac.BLOCK
    assert flac.media_features(flac.store_texts(docs([]))).collect() == []


def test_samples_are_sought_by_offset(spark, docs, monkeypatch):
    r = np.random.default_rng(3)
    text = r.integers(97, 123, 20_000, np.uint8).tobytes().decode()
    payload = flac.payload_of(text.encode())
    stream_ = flac.encode([payload])[0]
    for start, count in ((0, 1), (1151, 2), (5000, 3000), (19_990, 500), (0, 30_000), (40_000, 5), (7, 0)):
        assert flac.seek(stream_, start, count) == payload[start : start + count]
    decoded = []
    lanes = flac._decode_lanes
    monkeypatch.setattr(flac, "_decode_lanes", lambda frames, heads, n: decoded.append(len(frames)) or lanes(frames, heads, n))
    flac.seek(stream_, 5000, 100)
    assert sum(decoded) == 1  # one frame of eighteen
    media = flac.store_texts(docs([(1, text), (2, None), (None, "x")]))
    ranges = spark.createDataFrame([(1, 3000, 40), (1, 3000, 40), (2, 100, 200), (9, 0, 1), (None, 0, 1)], "doc_id long, start int, count int")
    got = sorted((r["doc_id"], r["start"], bytes(r["samples"])) for r in flac.read_samples(media, ranges).collect())
    assert got == [(1, 3000, payload[3000:3040])] * 2 + [(2, 100, b" " * 92)]
    stored = flac.pcm_blocks(media, block=1000).where("doc_id = 1 and sample_offset = 3000").collect()
    assert [bytes(x ^ 0x80 for x in r["pcm"]) for r in stored] == [payload[3000:4000]] and stored[0]["block"] == 3
    assert flac.pcm_blocks(flac.store_texts(docs([]))).collect() == []


def test_pages_are_whole_without_end_tags_and_inside_wrappers():
    body = "One long paragraph of the article with quite a few words in it, so that it is clearly text."
    art = f"<article><h1>Head</h1><p>{body}</p></article>"
    want = f"Head\n\n{body}"
    assert html_text.text_of(f"<html><head><title>x</title><meta name=a><body>{art}") == want
    assert html_text.text_of(f"<head><title>x<body>{art}") == want
    assert html_text.text_of(f"<body><svg width='1' /><p></p>{art}<svg><text>no</text></svg>") == want
    assert html_text.text_of(f"<body><iframe src=x>{art}") == want
    for wrap in ("content-sidebar-wrap", "site has-sidebar", "page with-comments"):
        page = f'<body><div class="{wrap}"><div class="sidebar"><p>{body} Not this.</p></div>{art}<div class="comments"><article><p>Not {body}</p></article></div></div>'
        assert html_text.text_of(page) == want
    assert html_text.text_of(f"<body>{art}<aside><article><p>Not {body}</p></article></aside>") == want
    assert html_text.text_of(f'<body><div hidden>{art}</div><p>x</p>') == ""
    assert html_text.text_of(f"<article><h1>Head</h1><p>{body} <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p></article>") == f"{want} x=1"
    assert html_text.text_of(f"<body>{art}<script>var a = '<p>{body}</p>'") == want


@pytest.mark.parametrize(
    "part,kept",
    [
        ('<h2 id="related-work">Related work</h2>', "Related work"), ('<section id="discussion"><p>We discuss what was found.</p></section>', "We discuss"), ('<p class="share-price">The price of a share rose.</p>', "The price"),
        ('<div class="article-header"><h1>Own header</h1></div>', "Own header"), ('<table><tr><td class="label">Label of a row</td></tr></table>', "Label of"), ('<p id="search">Search for meaning goes on.</p>', "Search for"),
        ('<blockquote class="notice-of-meeting">A meeting was announced.</blockquote>', "A meeting"),
        ('<p class="cookie-notice">We use cookies.</p>', None), ('<section class="comments"><p>First comment of a reader.</p></section>', None), ('<div id="related"><p>More to read elsewhere.</p></div>', None),
    ],
)
def test_names_of_running_text_do_not_drop_it(part, kept):
    long = lambda w: f"<p>{(w + ' words of the article, and then some more of them. ') * 4}</p>"
    got = html_text.text_of(f"<body><nav><a href=x>Home</a></nav><article><h1>Title</h1>{long('Opening')}{part}{long('Closing')}</article></body>")
    inner = re.sub("<[^>]*>", "", part)
    assert (inner in got) == (kept is not None)
    assert "Opening words" in got and "Closing words" in got


@pytest.mark.parametrize("page", ["<article>" + "<div>x " * 100_000, "<article><div class=menu>y " * 50_000, "<div class=menu>" * 30_000 + "<h1>z" * 30_000, "<div><p>" * 50_000 + "</div>" * 50_000])
def test_deep_nesting_takes_linear_time(page):
    start = time.process_time()
    html_text.text_of(page)
    assert time.process_time() - start < 20
