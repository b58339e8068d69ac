import hashlib
import struct

import pytest

from terrapipe.llm.warc import BadArchive, archive, frames, leading_frame, read_archive, read_warc, record, write_warc


def test_round_trip_and_revisits(spark):
    page = "<p>" + "größer " * 40
    rows = [(1, "http://a/ b%c\n", page), (2, None, page), (0, "http://z", "x"), (3, "u", "x"), (4, "u", None), (5, None, ""), (None, "n", page),
            (1, "other", page), (6, "u", "y" * 99), (7, "u", "y" * 99), (8, "u", "z" * 100), (9, "u", "z" * 100)]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, payload int")
    got = archive(pages, archive_bytes=2000).collect()
    long = {page: 1, "z" * 100: 8}
    want = []
    for i, url, html in rows:
        first = long.get(html or "")
        again = first is not None and i != first
        raw = (html or "").encode()
        want.append((i, url, None if again else raw, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert sorted(map(repr, want)) == sorted(repr((r[0], r[1], None if r[2] is None else bytes(r[2]), *r[3:7])) for r in got)
    assert len({r.record_id for r in got}) == len(rows) and len({r.date for r in got}) == 1


def test_empty_table(spark):
    assert archive(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def made(dictionary=b""):
    import zstandard

    encode = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True).compress
    records = [record(i, "u", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None, False, f"<urn:uuid:{i}>", "2024-01-01T00:00:00Z") for i in range(3)]
    return leading_frame(dictionary), [encode(r) for r in records]


def test_frames_tile_the_file():
    lead, parts = made()
    data = lead + b"".join(parts)
    assert [data[a:b] for a, b in frames(data)] == parts
    assert [r[0] for r in read_archive(data)] == [0, 1, 2]


@pytest.mark.parametrize("harm", ["cut", "junk", "flipped", "length"])
def test_damage_is_refused(harm):
    import zstandard

    lead, parts = made()
    data = lead + b"".join(parts)
    if harm == "cut":
        data = data[:-3]
    elif harm == "junk":
        data += b"junk bytes"
    elif harm == "flipped":
        raw = zstandard.ZstdDecompressor().decompress(parts[0]).replace(b"payload 0", b"payload 7")
        data = lead + zstandard.ZstdCompressor().compress(raw)
    else:
        raw = zstandard.ZstdDecompressor().decompress(parts[0]).replace(b"Content-Length: ", b"Content-Length: 1")
        data = lead + zstandard.ZstdCompressor().compress(raw)
    with pytest.raises(BadArchive):
        list(read_archive(data))


@pytest.mark.parametrize("cut", range(0, 900, 7))
def test_every_cut_and_flip_is_a_bad_archive_or_reads_right(cut):
    lead, parts = made(b"a dictionary of some words " * 20)
    data = lead + b"".join(parts)
    whole = list(read_archive(data))
    at = cut % len(data)
    for broken in (data[:at], data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1:]):
        try:
            got = list(read_archive(broken))
        except BadArchive:
            continue
        assert got == whole[:len(got)]


def foreign(head, block, version="WARC/1.0", end="\r\n"):
    lines = [version, *head, f"Content-Length: {len(block)}"]
    return end.join(lines).encode() + 2 * end.encode() + block + b"\r\n\r\n"


BASE = ["WARC-Type: response", "WARC-Record-ID: <urn:uuid:92283950-ef2f-4d72-b224-f54c6ec90bb0>", "WARC-Date: 2006-09-19T17:20:24Z",
        "Content-Type: application/http; msgtype=response"]
BODY = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hello</p>"


def read_one(raw, **options):
    import zstandard

    return list(read_archive(options.get("lead", b"") + zstandard.ZstdCompressor(write_content_size=options.get("sized", True)).compress(raw)))


def test_archives_of_other_tools():
    import base64
    import zstandard

    sha1 = base64.b32encode(hashlib.sha1(b"<p>hello</p>").digest()).decode()
    block = base64.b64encode(hashlib.sha256(BODY).digest()).decode()
    records = [
        foreign(["WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:1>", "WARC-Date: 2006-09-19T17:20:14Z", "Content-Type: application/warc-fields",
                 "WARC-Filename: a.warc"], b"software: other 1.0\r\n"),
        foreign([*BASE, "WARC-Target-URI: <http://x.org/a%20b?c=%25>", f"warc-payload-digest:sha1:{sha1}", f"WARC-BLOCK-DIGEST: sha256:{block}", "X-Long: one",
                 "  two", "\tthree"], BODY),
        foreign(["WARC-Type: request", *BASE[1:3], "Content-Type: application/http; msgtype=request"], b"GET / HTTP/1.1\r\n\r\n", "WARC/1.1", "\n"),
        foreign(["WARC-Type: revisit", *BASE[1:], f"WARC-Payload-Digest: sha1:{sha1}", "WARC-Target-URI: http://x.org/é"], b"HTTP/1.1 304\r\n\r\n"),
        foreign(["WARC-Type: resource", *BASE[1:3], "Content-Type: text/plain", "WARC-Payload-Digest: blake9:zzz"], b"plain"),
        foreign([*BASE, "WARC-Payload-Digest: sha1:AAAA"], b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n1\r\nx\r\n0\r\n\r\n"),
    ]
    encode = zstandard.ZstdCompressor().compress
    want = [("warcinfo", None, b"software: other 1.0\r\n"), ("response", "http://x.org/a%20b?c=%25", b"<p>hello</p>"), ("request", None, b""),
            ("revisit", "http://x.org/é", None), ("resource", None, b"plain"), ("response", None, b"1\r\nx\r\n0\r\n\r\n")]
    skip = struct.pack("<II", 0x184D2A53, 5) + b"other"
    unsized = zstandard.ZstdCompressor(write_content_size=False)
    for data in (b"".join(map(encode, records)), encode(b"".join(records)), skip + b"".join(skip + encode(r) for r in records), b"".join(map(unsized.compress, records))):
        got = list(read_archive(data))
        assert [(r[5], r[1], r[2]) for r in got] == want
        assert all(r[0] is None and r[6] is None for r in got) and got[1][4] == hashlib.sha256(b"<p>hello</p>").hexdigest() and got[3][4] == f"sha1:{sha1}"
    words = zstandard.train_dictionary(2000, [r * 3 + bytes([k]) for k in range(200) for r in records])
    for shown in (words.as_bytes(), zstandard.ZstdCompressor().compress(words.as_bytes())):  # plain or compressed
        lead = struct.pack("<II", 0x184D2A5D, len(shown)) + shown
        got = list(read_archive(lead + b"".join(zstandard.ZstdCompressor(dict_data=words).compress(r) for r in records)))
        assert [(r[5], r[1], r[2]) for r in got] == want


@pytest.mark.parametrize("old,new", [
    (b"WARC/1.0", b"WARC/9.9"), (b"WARC-Date: 2006-09-19T17:20:24Z", b"WARC-Date: yesterday"), (b"WARC-Date: 2006-09-19T17:20:24Z\r\n", b""),
    (b"<urn:uuid:92283950-ef2f-4d72-b224-f54c6ec90bb0>", b"none"), (b"<urn:uuid:92283950-ef2f-4d72-b224-f54c6ec90bb0>", b"<urn:page:>x"),
    (b"Content-Length: ", b"Content-Length: x"), (b"Content-Length: ", b"Content-Length: -"), (b"Content-Length: ", b"No-Length: "),
    (b"WARC-Type: response", b"no field at all"), (b"WARC-Type: response\r\n", b""), (b"WARC/1.0\r\n", b"WARC/1.0\r\n folded first\r\n"), (b"hello", b"hell"),
    (b"\r\n\r\n", b"\r\n")])
def test_bad_records_are_bad_archives(old, new):
    good = foreign([*BASE, f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'<p>hello</p>').hexdigest()}"], BODY)
    assert len(read_one(good)) == 1 and old in good
    with pytest.raises(BadArchive):
        read_one(good.replace(old, new))


def test_urls_stay_as_they_are():
    for url in ("http://x.org/a%20b", "http://x.org/%", "http://x.org/a b\n\u2028", "<odd>", "", "é", "\u00a0x\u00a0"):
        raw = record(1, url, b"x", hashlib.sha256(b"x").hexdigest(), None, False, "<urn:uuid:1>", "2024-01-01T00:00:00Z")
        assert read_one(raw)[0][1] == url
        if " " not in url:
            assert f"WARC-Target-URI: {url}\r\n".encode() in raw


def test_dictionary_shrinks_files(spark, sf_small, scratch):
    from terrapipe.llm.warc import train_dictionary

    pages = spark.read.parquet(f"{sf_small}/pages.parquet").coalesce(1)
    n = pages.count()
    trained = train_dictionary(pages, size=4096)
    assert trained
    total = []
    for name, dictionary in (("with", trained), ("without", b"")):
        folder = f"{scratch}/{name}"
        assert sum(r.records for r in write_warc(pages, folder, dictionary).collect()) == n
        assert read_warc(spark, folder).count() == n
        total.append(spark.read.format("binaryFile").load(folder).selectExpr("sum(length)").first()[0])
    assert total[0] < total[1]
