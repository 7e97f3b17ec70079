import gzip
import hashlib

import pytest

from tuneloom.llm import arc


def brute(rows):
    out, least = [], {}
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    order = lambda k: (k is None, k or 0)
    for key, _, html in rows:
        least[digest(html)] = min(least.get(digest(html), order(key)), order(key))
    for key, _, html in rows:
        n = len((html or "").encode())
        first = least[digest(html)]
        again = n >= 100 and order(key) != first
        out.append((key, n, digest(html), "revisit" if again else "response", first[1] if again else None))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a.example/x y", "<p>" + "é" * 60), (5, "http://b.example/", "<p>" + "é" * 60), (3, None, "<p>" + "é" * 60),
    (7, "http://c.example/", None), (8, "http://c.example/", ""), (9, "dns:x", "short"), (10, "u", "short"),
    (11, "u\tv\nw", "line\r\n\r\nline\n\n" * 20), (12, "http://d.example/ü", "x" * 100), (13, "u", "x" * 100), (14, "u", "x" * 99),
    (15, "u", "x" * 99), (None, "n", "y" * 200), (None, "n", "y" * 200), (20, "u", "z" * 200), (None, "u", "z" * 200),
    (21, "same", "w" * 300), (21, "same", "w" * 300), (22, "same", "w" * 300), (30, "u", "long " * 400_000),
]


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.selectExpr("*", "1 AS key", "'x' AS head", "2 AS payload", "3 AS record_id", "4 AS text", "5 AS name")


@pytest.mark.parametrize("size", [arc.ARCHIVE_BYTES, 500])
def test_pages_come_back(spark, size):
    archives = arc.to_archives(pages(spark, PAGES).repartition(4), archive_bytes=size)
    got = arc.converted(archives).collect()
    assert sorted(map(tuple, got), key=str) == brute(PAGES)


def test_no_pages(spark):
    assert arc.converted(arc.to_archives(pages(spark, []))).count() == 0


def test_records_are_whole_warc(spark):
    archives = arc.to_archives(pages(spark, PAGES).coalesce(1), archive_bytes=700)
    assert archives.count() > 2  # of both versions
    versions = {bytes(r.content).split(b"\n")[1].split()[0] for r in archives.collect()}
    assert versions == {b"1", b"2"}
    ids, revisits = set(), []
    for row in arc.to_warc(archives).collect():
        for fields, block in arc.warc_records(row.content):
            assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
            assert fields["Content-Type"] == arc.HTTP_TYPE and fields["WARC-Date"] == "1970-01-01T00:00:00Z"
            ids.add(fields["WARC-Record-ID"])
            revisits += [fields["WARC-Refers-To"]] if fields["WARC-Type"] == "revisit" else []
            assert ("WARC-Target-URI" in fields) == (b"X-Page-Id: 3\r" not in block)
    assert revisits and set(revisits) <= ids


V1 = (
    b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 Alexa Internet\n"
    b"URL IP-address Archive-date Content-type Archive-length\n\n"
)


def test_lines_of_version_1():
    line = b"http://x.example/a b c 1.2.3.4 19970502061022 text/html 30\n"
    block = b"HTTP/1.0 200 OK\nServer: s\n\n<p>x"
    line = line.replace(b" 30\n", f" {len(block)}\n".encode())
    raw = b"gopher://y.example/ 1.2.3.4 1997 text/plain 4\nab\n\n"
    [(fields, one), (second, two)] = arc.arc_records(V1 + line + block + b"\n" + raw)
    assert fields["URL"] == "http://x.example/a b c" and one == block
    made = arc._converted(fields, one, "X-Page-Id", True)
    assert made["payload"] == b"<p>x" and made["warc_type"] == "response" and made["key"] is None
    assert made["warc_date"] == "1997-05-02T06:10:22Z" and made["ip"] == "1.2.3.4"
    other = arc._converted(second, two, "X-Page-Id", True)
    assert other["warc_type"] == "resource" and other["content_type"] == "text/plain" and other["payload"] == b"ab\n\n"
    assert other["warc_date"] == "1997-01-01T00:00:00Z"
    assert arc._converted(fields, one, "X-Page-Id", True)["record_id"] == made["record_id"] != other["record_id"]


def test_lines_of_version_2():
    names = " ".join(arc.FIELDS[2]).encode()
    body = b"2 0 someone\n" + names + b"\n"
    head = b"filedesc://n.arc 0.0.0.0 20000101000000 text/plain 200 - - 0 n.arc %d\n" % len(body) + body + b"\n"
    line = b"http://z.example/ 5.6.7.8 20000101000001 text/html 404 abc http://to.example/ 99 n.arc 3\nxyz\n"
    [(fields, block)] = arc.arc_records(head + line)
    assert block == b"xyz" and fields["Result-code"] == "404" and fields["Location"] == "http://to.example/"


@pytest.mark.parametrize(
    "content",
    [
        b"http://x 1.1.1.1 1997 text/html 3\nabc\n",
        V1 + b"http://x 1.1.1.1 1997 text/html 9\nabc\n",
        V1 + b"http://x text/html\n",
        V1 + b"no line",
        V1.replace(b"1 0 Alexa", b"3 0 Alexa"),
    ],
)
def test_broken_archives_are_errors(content):
    with pytest.raises(ValueError):
        list(arc.arc_records(content))


def test_cut_or_changed_warc_is_an_error():
    whole = arc.warc_record({"WARC-Type": "resource", "WARC-Record-ID": "<a>", "WARC-Payload-Digest": "sha256:0"}, b"abc")
    with pytest.raises(ValueError):
        list(arc.warc_records(whole[:-12]))
    with pytest.raises(ValueError):
        list(arc.warc_records(gzip.compress(b"other")))
    [(fields, block)] = arc.warc_records(whole)
    with pytest.raises(ValueError):
        arc._read(fields, block, "X-Page-Id")


def test_keys_of_64_bits(spark):
    top = 2**63 - 1
    rows = [(top, "u", "k" * 200), (top - 1, "u", "k" * 200), (-top - 1, "u", "m" * 200), (10**18, "u", "m" * 200), (-top, "u", "m" * 200)]
    got = arc.converted(arc.to_archives(pages(spark, rows))).collect()
    assert sorted(map(tuple, got), key=str) == [
        *sorted(((k, 200, hashlib.sha256(h.encode()).hexdigest(), *way) for k, h, way in [
            (top, "k" * 200, ("revisit", top - 1)), (top - 1, "k" * 200, ("response", None)),
            (-top - 1, "m" * 200, ("response", None)), (10**18, "m" * 200, ("revisit", -top - 1)), (-top, "m" * 200, ("revisit", -top - 1)),
        ]), key=str)
    ]


@pytest.mark.parametrize("named, key", [(b"9223372036854775807", 2**63 - 1), (b"9223372036854775808", None), (b"-9223372036854775808", -(2**63)), (b"-9223372036854775809", None)])
def test_keys_beyond_64_bits_are_null(named, key):
    [(fields, block)] = arc.arc_records(V1 + b"http://x 1.2.3.4 1997 text/html %d\n" % (len(named) + 33) + b"HTTP/1.0 200 OK\nX-Page-Id: " + named + b"\n\n<p>x\n")
    assert arc._converted(fields, block, "X-Page-Id", True)["key"] == key


def test_archives_of_gzip_members(spark, make):
    import gzip

    head = arc.arc_head(1, "x", "19970101000000")
    blocks = [b"HTTP/1.0 200 OK\r\nX-Page-Id: %d\r\n\r\n%s" % (i, b"x" * (i * 7000)) for i in range(5)]
    lines = [arc.arc_line(1, f"http://a/{i}", "19970101000000", "text/html", len(b), 0, "x") for i, b in enumerate(blocks)]
    plain = head + b"".join(line + block + b"\n" for line, block in zip(lines, blocks))
    members = gzip.compress(head) + b"".join(gzip.compress(line + block + b"\n") for line, block in zip(lines, blocks))
    assert list(arc.arc_records(members)) == list(arc.arc_records(plain)) == list(arc.arc_records(gzip.compress(plain)))
    assert [b for _, b in arc.arc_records(members)] == blocks
    with pytest.raises(ValueError, match="cut off"):
        list(arc.arc_records(members[:-3]))


def test_archives_from_elsewhere():
    block = b"HTTP/1.1 200 OK\r\nX-Page-Id: many\r\n\r\nbody"
    record = arc.warc_record({"WARC-Type": "response", "WARC-Record-ID": "<urn:a>", "WARC-Payload-Digest": "sha1:ABC"}, block)
    again = arc.warc_record({"WARC-Type": "revisit", "WARC-Record-ID": "<urn:b>"}, b"")
    rows = [arc._read(f, b, "X-Page-Id") for f, b in arc.warc_records(record + again)]
    assert [(r["key"], r["payload_bytes"], r["refers_id"]) for r in rows] == [(None, 4, None), (None, None, "")]
    assert rows[0]["payload_digest"] == hashlib.sha256(b"body").hexdigest() and rows[1]["payload_digest"] is None
