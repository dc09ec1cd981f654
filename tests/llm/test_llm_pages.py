"""Archives and page extraction on small tables, against the standard library and held-out pages."""

from __future__ import annotations

import collections
import hashlib
import io
import struct
import time
import zipfile

import pytest

from churnflow.llm import html_extract, warc
from churnflow.llm.columns import shared_path
from churnflow.llm.files import RangeReader
from churnflow.llm.html_blocks import blocks
from churnflow.llm.zip_archive import ZipError, members, stored_range

LONG = "<p>" + "same text " * 20 + "</p>"
PAGES = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (None, "http://a/n", LONG), (4, "u\r\nX: y", "<p>short</p>"),
    (6, "http://a/6", "<p>short</p>"), (7, "http://a/7", None), (8, "http://a/8", ""), (3, "http://a/3", LONG), (3, "other", "é" * 90), (2, "x", "é" * 90),
]
SCHEMA = "page_id long, url string, html string, digest string, first long, text string, n_chars long"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "own", 1, "mine", 2) for p in PAGES], SCHEMA).repartition(3)


def expected():
    least: dict[bytes, int] = {}
    for i, _, html in PAGES:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            least[data] = min(i, least.get(data, i))
    out = collections.Counter()
    for i, _, html in PAGES:
        data = (html or "").encode()
        again = i is not None and data in least and least[data] < i
        out[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", least[data] if again else None] += 1
    return out


def test_warc_round_trip(spark, pages):
    packages = warc.write(pages, shared_path(spark, "warc-test"))
    rows = warc.read(packages).collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == expected()
    for r in rows:
        assert (r.payload is None) == (r.record_type == "revisit")
    assert {r.url for r in rows if r.page_id == 4} == {"u%0D%0AX: y"} and {r.url for r in rows if r.page_id == 9} == {None}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_packages_are_read_in_tasks_by_their_bytes(spark, monkeypatch):
    rows = [(i, f"u{i}", hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(60)]
    packages = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), shared_path(spark, "warc-test"))
    monkeypatch.setattr(warc, "TASK_BYTES", 1000)
    monkeypatch.setattr(warc, "RUN_BYTES", 500)
    found = warc.read(packages, payload=False)
    packed = sum(r.length for r in warc.index(packages).collect())
    assert found.rdd.getNumPartitions() == -(-packed // 1000) > 10 and {r.page_id for r in found.collect()} == set(range(60))


def test_packages_are_cut_and_read_by_other_tools(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_RECORDS", 2)
    packages = warc.write(pages.coalesce(1), shared_path(spark, "warc-test"))
    assert sum(r.records for r in packages.collect()) == len(PAGES) and packages.count() > 3
    for r in packages.collect():
        with zipfile.ZipFile(r.package.removeprefix("file:")) as archive:
            assert archive.testzip() is None and {i.compress_type for i in archive.infolist()} == {zipfile.ZIP_STORED}
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(packages).collect()) == expected()


def test_damaged_payload_is_an_error():
    data = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None)
    assert warc.parse(data)["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parse(data.replace(b"abc", b"abd"))


def archive(tmp_path, comment=b"", **kinds):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as out:
        for name, kind in kinds.items():
            out.writestr(zipfile.ZipInfo(name), name.encode() * 50, compress_type=kind)
        out.comment = comment
    return str(path)


def test_central_directory(tmp_path):
    path = archive(tmp_path, b"PK\x05\x06 a comment that looks like an end", one=zipfile.ZIP_STORED, two=zipfile.ZIP_DEFLATED, naïve=zipfile.ZIP_STORED)
    with RangeReader(path) as file:
        found = {m.name: m for m in members(file, chunk=10)}
        assert list(found) == ["one", "two", "naïve"]
        assert file.read(*stored_range(file, found["naïve"])) == "naïve".encode() * 50
        with pytest.raises(ZipError, match="two is not stored"):
            stored_range(file, found["two"])
        with pytest.raises(ValueError, match="outside a file"):
            file.read(file.size - 1, 2)


def test_zip64_directory(tmp_path):
    """Sizes, offset and counts stand in the ZIP64 fields, as in archives beyond 4 GB."""
    data, name = b"payload", b"m"
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + name + struct.pack("<HHQQ", 1, 16, 7, 7)
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    entry = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(local) + len(data)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(entry), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    whole = local + data + entry + end64 + locator + end
    assert zipfile.ZipFile(io.BytesIO(whole)).namelist() == ["m"]
    (tmp_path / "z.zip").write_bytes(whole)
    with RangeReader(str(tmp_path / "z.zip")) as file:
        (member,) = members(file)
        assert file.read(*stored_range(file, member)) == data


@pytest.mark.parametrize("content", [b"", b"no archive", b"PK\x05\x06" + bytes(18) + b"x"])
def test_no_archive(tmp_path, content):
    (tmp_path / "z").write_bytes(content)
    with RangeReader(str(tmp_path / "z")) as file, pytest.raises(ZipError):
        list(members(file))


def test_blocks():
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body>loose<p>one <b>two<br>three&nbsp;&amp;\n four<p>five</b></p>"
        "<!-- no --><script>if (a < b) {'<p>x</p>'}</script><ul><li>a<li><a href=x>b</a></ul><table><tr><td>c<td>d</table>&lt;p&gt;"
    )
    assert [b.text for b in blocks(html)] == ["loose", "one two three & four", "five", "a", "b", "c", "d", "<p>"]
    assert blocks("") == [] and [b.text for b in blocks("<p>cut short <b")] == ["cut short"]


def test_head_without_end_tag():
    for start in ("<body>", "", "<body class=x>\n"):
        page = f"<html><head>\n<meta charset=utf-8><title>t</title><style>p{{}}</style><noscript>n</noscript>\n{start}<article><h1>One</h1><p>Two three, four.</article></html>"
        assert [b.text for b in blocks(page)] == ["One", "Two three, four."]
        assert html_extract.main_text(page, html_extract.trained()) == "One\nTwo three, four."
    assert [b.text for b in blocks("<head><title>t</title>\nloose <i>text</i></head><p>one")] == ["loose text", "one"]
    assert [b.text for b in blocks("<head><title>t</title> <script>x</script> </head> <p>one")] == ["one"]


def test_formulas_stay_but_not_their_annotations():
    formula = '<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding="t">x = {2}</annotation><annotation-xml><p>no</p></annotation-xml></semantics></math>'
    assert [b.text for b in blocks(f"<p>So {formula} holds.<p>End")] == ["So x=2 holds.", "End"]


PARTS = {
    "ol": ("<ol><li>Peel the apples<li>Cut them into slices.</ol>", ["Peel the apples", "Cut them into slices."]),
    "h4": ("<h4>What to buy</h4><p>Six apples, and some flour.</p>", ["What to buy", "Six apples, and some flour."]),
    "h5": ("<h5>A note</h5>", ["A note"]),
    "h6": ("<h6>Sources</h6>", ["Sources"]),
    "dl": ("<dl><dt>Flour<dd>Ground grain, white or brown.<dt>Salt<dd>A pinch</dl>", ["Flour", "Ground grain, white or brown.", "Salt", "A pinch"]),
    "figure": ('<figure><img src="a.png"><figcaption>The pie after an hour</figcaption></figure>', ["The pie after an hour"]),
    "table": ("<table><caption>Amounts</caption><tr><th>What<th>Grams<tr><td>Flour<td>300</table>", ["Amounts", "What", "Grams", "Flour", "300"]),
}


@pytest.mark.parametrize("around", ["article", 'div class="entry-content"', "main"])
@pytest.mark.parametrize("part", PARTS)
def test_parts_of_articles(part, around):
    html, texts = PARTS[part]
    page = (
        f'<html><head><title>x</title></head><body><nav class="menu"><ul><li><a href="/">Home</a><li><a href="/b">Blog</a></ul></nav><{around}><h1>Apple pie</h1>'
        f"<p>My aunt made this pie every autumn, and we all liked it.</p>{html}<p>Let it cool before you eat it.</p></{around.split()[0]}>"
        '<section class="comments"><ol><li><p>So good, thanks!</p></li></ol></section><aside class="sidebar"><h4>Popular</h4><p>Ten cakes to try.</p></aside>'
        '<footer class="footer"><p>© Pies. All rights reserved.</p></footer></body></html>'
    )
    want = ["Apple pie", "My aunt made this pie every autumn, and we all liked it.", *texts, "Let it cool before you eat it."]
    assert html_extract.main_text(page, html_extract.trained()).split("\n") == want


NAV = '<nav class="menu"><ul><li><a href="/">Home</a><li><a href="/b">Blog</a></ul></nav>'
PIE = "<h1>Apple pie</h1><p>My aunt made this pie every autumn, and we all liked it.</p><p>Let it cool before you eat it.</p>"
PIE_TEXT = "Apple pie\nMy aunt made this pie every autumn, and we all liked it.\nLet it cool before you eat it."


@pytest.mark.parametrize("footer", [
    "<footer><p>All rights reserved.</p></footer>", "<footer><p>Published by the Example Company in Rome.</p></footer>", "<footer>Contact us at the office.</footer>",
    "<footer>&copy; 2020 Pies</footer>", "<footer><div>Terms</div><div>Write to us.</div></footer>"])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<main><article>{}</article></main>", '<div class="content">{}</div>'])
def test_footers_go_without_mark_or_name(around, footer):
    assert html_extract.main_text(f"<html><body>{NAV}{around.format(PIE)}{footer}</body></html>", html_extract.trained()) == PIE_TEXT


LAYOUTS = {
    "responses": (f'{NAV}<article>{PIE}</article><section class="responses"><h3>Two answers</h3><div><p>So good, thanks!</p></div><div><p>I tried it twice, it was fine.</p></div></section>', PIE_TEXT),
    "bare div": (f"{NAV}<div><h1>Apple pie</h1><div>My aunt made this pie every autumn, and we all liked it.</div><div>Let it cool before you eat it.</div></div><footer><p>© Pies</p></footer>", PIE_TEXT),
    "line breaks": (f"{NAV}<div id=content>My aunt made this pie every autumn, and we all liked it.<br><br>Let it cool before you eat it.</div><footer>© Pies</footer>", PIE_TEXT.split("\n", 1)[1].replace("\n", " ")),
    "menu cell": (f"<table><tr><td><a href=/>Home</a><br><a href=/b>Blog</a><br><a href=/c>Shop</a></td><td>{PIE}</td></tr></table>", PIE_TEXT),
    "menu cell with a list": (f"<table><tr><td width=150><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></td><td>{PIE}</td></tr></table>", PIE_TEXT),
    "footer inside": (f"{NAV}<article>{PIE}<footer><p>Filed under cakes by the editor.</p></footer></article>", PIE_TEXT),
    "Japanese": (f"{NAV}<article><h1>りんごのパイ</h1><p>叔母は毎年秋にこのパイを作り、私たちは皆それが好きでした。</p></article><footer>お問い合わせは事務所まで。</footer>", "りんごのパイ\n叔母は毎年秋にこのパイを作り、私たちは皆それが好きでした。"),
    "Russian": (f"{NAV}<article><h1>Пирог</h1><p>Моя тётя пекла этот пирог каждую осень, и мы все его любили.</p></article><footer><p>Все права защищены.</p></footer>", "Пирог\nМоя тётя пекла этот пирог каждую осень, и мы все его любили."),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, want = LAYOUTS[name]
    assert html_extract.main_text(f"<html><body>{page}</body></html>", html_extract.trained()) == want


@pytest.mark.parametrize("page", [
    "<div>" * 200_000 + "x", "<span>" * 200_000 + "</b>" * 200_000, "<p><table><tr><td>" + "<div>" * 200_000 + "y",
    "".join(f"<div class=c{i}>" for i in range(200_000)) + "z", "<ul>" + "<li>a" * 200_000])
def test_time_grows_with_the_length_of_a_page(page):
    model, start = html_extract.trained(), time.process_time()
    html_extract.main_text(page, model)
    assert time.process_time() - start < 40


def test_extraction_of_held_out_pages():
    model = html_extract.trained()
    right = total = whole = 0
    for found, labels in html_extract.sample(range(50_000, 50_200)):
        got = model.labels(found)
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
        whole += got == labels
    assert right / total > 0.99 and whole > 180


def test_viterbi_is_the_best_path():
    import itertools

    model = html_extract.trained()
    for found, _ in html_extract.sample(range(60_000, 60_030)):
        found = found[:9]
        local = [model.weights["bias"] + sum(model.weights.get(f, 0) for f in fs) for fs in html_extract.features(found)]

        def score(path, local=local):
            return sum(s for s, y in zip(local, path, strict=True) if y) + sum(model.pairs[int(a)][int(b)] for a, b in itertools.pairwise(path))

        best = max(map(score, itertools.product((False, True), repeat=len(found))))
        assert score(model.labels(found)) == pytest.approx(best)


def test_extract_pages(spark):
    page = "<body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Title</h1><p>Some text,  of\nan article.<p>More &eacute;.</article><footer>&copy; x</footer></body>"
    rows = [(1, page, "old", "u"), (2, None, None, None), (3, "", "", ""), (1, page, "old", "u"), (4, "<article>" + "<p>word one. </p>" * 5000 + "</article>", "", "")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, html string, text string, url string"))
    assert got.columns == ["page_id", "html", "url", "text", "n_chars"]
    by_id = {r.page_id: r for r in got.collect()}
    assert by_id[1].text == "Title\nSome text, of an article.\nMore é." and by_id[1].n_chars == len(by_id[1].text)
    assert by_id[2].text == by_id[3].text == "" and by_id[4].text == "\n".join(["word one."] * 5000)
    assert got.count() == 5 and html_extract.extract(got.limit(0)).count() == 0
