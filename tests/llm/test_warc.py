"""WARC derivatives: links between records, digests and the file round trip."""
import base64
import glob
import gzip
import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from trafficwatch.llm import warc
from trafficwatch.llm.base import table
from conftest import SF_SMALL

PAGE = ('<html lang="de"><head><title>A &amp; B</title><meta charset="utf-8"><style>x{}</style></head><body>'
        "<p>one <b>two</b>&nbsp;three</p><!-- no --><script>var a='</p>';</script><div>caf&eacute;<br>next</div>"
        '<a href="/x?a=1&amp;b=2">l</a><a href=\'http://other/\'>m</a><a href="#top">n</a><a href="/x?a=1&amp;b=2">o</a></body></html>')
ROWS = [(1, "http://host/dir/page", PAGE), (2, None, None), (3, "http://host/", ""), (None, "u", "<p>no id"),
        (1, "http://host/dir/page", PAGE), (4, "http://h/ü\nx", "<p>" + "long text " * 50_000 + "<script>never closed")]


def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string") \
        .withColumn("type", F.lit("clash")).withColumn("block", F.lit(1))


def test_text_and_links():
    assert warc.visible_text(PAGE) == "A & B\none two three\ncafé\nnext\nlmno"
    assert warc.links(PAGE, "http://host/dir/page") == ["http://host/x?a=1&b=2", "http://other/"]
    assert warc.visible_text("a < b and <p>c") == "a < b and\nc"


def test_records_are_linked_and_round_trip(spark, tmp_dir):
    records = warc.derive(warc.responses(pages(spark)))
    warc.write_warc(records, f"{tmp_dir}/warc")
    read = warc.read_warc(spark, f"{tmp_dir}/warc")
    made, back = ([tuple(r) for r in df.collect()] for df in (records, read))
    assert len(made) == 3 * len(ROWS)
    plain = lambda rows: sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows), key=str)
    one_line = [tuple(" ".join(v.split()) if isinstance(v, str) else v for v in r) for r in made]
    empty_url = lambda rows: [tuple(v or None if isinstance(v, str) else v for v in r) for r in rows]
    assert plain(empty_url(back)) == plain(empty_url(one_line))
    rows = read.collect()
    responses = {r.record_id: r for r in rows if r.type == "response"}
    assert len(responses) == len(ROWS) - 1  # the repeated row has the same records
    for r in rows:
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block).digest()).decode()
        assert r.content_length == len(r.block)
        if r.type != "response":
            source = responses[r.refers_to]
            assert (r.refers_to_target_uri, r.refers_to_date, r.payload_digest) == (source.target_uri, source.date, source.payload_digest)
    metadata = next(r for r in rows if r.type == "metadata" and r.page_id == 1).block.decode()
    assert "title: A & B\r\n" in metadata and "WARC-Source-Header: HTTP/1.1 200 OK\r\n" in metadata
    assert "outlink: http://host/x?a=1&b=2\r\n" in metadata and "languages-declared: de\r\n" in metadata
    assert warc.derive(warc.responses(pages(spark).limit(0))).count() == 0


def test_an_archive_can_be_derived_again_with_its_ids(spark):
    first = warc.derive(warc.responses(pages(spark)))
    again = warc.derive(warc.captured(first))
    ids = lambda df: sorted(r.record_id for r in df.collect())
    assert ids(first) == ids(again)


def plain_parse(data):
    """Another reader: one member after the other by gzip's own file class, headers by the email
    package."""
    import email
    import io

    found, stream = [], io.BytesIO(data)
    whole = gzip.GzipFile(fileobj=stream).read()
    at = 0
    while at < len(whole):
        head, _, rest = whole[at:].partition(b"\r\n\r\n")
        fields = email.message_from_bytes(head.partition(b"\r\n")[2])
        size = int(fields["Content-Length"])
        found.append((fields, rest[:size]))
        at += len(head) + 4 + size + 4
    return found


def test_archives_keep_foreign_bytes_and_digests(spark, tmp_dir):
    latin = "<html><p>caf\xe9 <a href='/\xfc'>x</a>".encode("latin-1")
    japanese = "<meta charset=shift_jis><p>\u65e5\u672c".encode("shift_jis")
    blocks = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\nX-N: \xe9\r\n\r\n" + latin,
              b"HTTP/1.0 200 OK\r\n\r\n" + japanese, b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=no-such\r\n\r\n\xff<p>y",
              b"only headers", b"", None]
    own = ["sha256:" + hashlib.sha256(blocks[0]).hexdigest(), None, "md5:" + hashlib.md5(blocks[2]).hexdigest(), None, None, None]
    payload = ["sha256:stated by the source", None, None, None, None, None]
    rows = [(i, f"<urn:uuid:{i}>", "http://h/d/", "2020-02-02T00:00:00Z", b, o, p, "response", "clash")
            for i, (b, o, p) in enumerate(zip(blocks, own, payload))] + [
        (9, "<urn:uuid:9>", "u", "d", b"x", None, None, "request", "clash")]
    source = spark.createDataFrame(rows, "page_id long, record_id string, target_uri string, date string, block binary, "
                                         "block_digest string, payload_digest string, type string, headers string")
    warc.write_warc(warc.derive(warc.captured(source)), f"{tmp_dir}/warc")
    found = {(r.page_id, r.type): r for r in warc.read_warc(spark, f"{tmp_dir}/warc").collect()}
    assert len(found) == 3 * len(blocks)
    for i, block in enumerate(blocks):
        block = block or b""
        kept = found[i, "response"]
        assert (kept.record_id, bytes(kept.block)) == (f"<urn:uuid:{i}>", block)
        assert kept.block_digest == (own[i] or warc.digest(block))
        assert kept.payload_digest == (payload[i] or warc.digest(block.partition(b"\r\n\r\n")[2]))
        for kind in ("metadata", "conversion"):
            assert (found[i, kind].refers_to, found[i, kind].payload_digest) == (kept.record_id, kept.payload_digest)
    text = {i: bytes(found[i, "conversion"].block).decode() for i in range(len(blocks))}
    assert text == {0: "caf\xe9 x", 1: "\u65e5\u672c", 2: "\ufffd\ny", 3: "", 4: "", 5: ""}
    about = bytes(found[0, "metadata"].block).decode()
    assert "outlink: http://h/\xfc\r\n" in about and "WARC-Source-Header: X-N: \xe9\r\n" in about
    files = [r for b in spark.read.parquet(f"{tmp_dir}/warc").collect() for r in plain_parse(bytes(b.warc))]
    assert sorted((f["WARC-Record-ID"], b) for f, b in files) == sorted((r.record_id, bytes(r.block)) for r in found.values())


def test_plain_links_resolve_as_the_library_says():
    from urllib.parse import urljoin

    targets = ["/a", "/a/b", "/a/../b", "//host/x", "/a;b?c#d", "/\u00fc", "/a.", "/", "?q", "c/./d", "/a%20b&c", "/x\\y"]
    for base in ("http://host/d/e", "https://host:8080", "ftp://host/d", "u", "", "http://[bad/"):
        page = "".join(f'<a href="{t}">' for t in targets)
        expected = []
        for t in targets:
            try:
                expected.append(urljoin(base, t))
            except ValueError:
                pass
        assert warc.links(page, base) == list(dict.fromkeys(expected))


def test_members_are_read_one_by_one():
    parts = [b"", b"x" * 200_000, b"y", bytes(range(256)) * 900]
    assert list(warc.members(b"".join(gzip.compress(p, 1) for p in parts))) == parts
    with pytest.raises(ValueError):
        list(warc.members(gzip.compress(b"z" * 1000)[:-3]))


def test_damaged_archives_are_refused():
    row = {key: None for _, key in warc._FIELDS} | {"type": "conversion", "block": b"text", "block_digest": warc.digest(b"text")}
    good = warc.record_bytes(row)
    assert [r["block"] for r in warc.parse_records(gzip.decompress(gzip.compress(good) * 2))] == [b"text"] * 2
    for bad in (good[:-1], good.replace(b"text\r", b"tExt\r"), b"junk" + good):
        with pytest.raises(ValueError):
            list(warc.parse_records(bad))


def test_query_reads_every_page(spark):
    own = table(spark, SF_SMALL, "pages")
    assert warc.derivative_report(own).count() == 3 * own.count()


@pytest.mark.parametrize("write", [warc.write_derivatives, lambda rows, path: warc.write_warc(warc.derive(rows), path)])
def test_an_archive_is_held_in_small_groups(spark, tmp_dir, write):
    """However many blocks a task writes, a writer or reader holds a few MB of them."""
    hashes = F.transform(F.sequence(F.lit(1), F.lit(8000)), lambda x: F.sha2((F.col("page_id") * 8000 + x).cast("string"), 256))
    own = spark.range(0, 40, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://h/").alias("url"))
    write(warc.responses(own.withColumn("html", F.array_join(hashes, ""))), f"{tmp_dir}/warc")
    files = [pq.read_metadata(f) for f in glob.glob(f"{tmp_dir}/warc/*.parquet")]
    groups = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert sum(groups) > 20 << 20 and max(groups) < 8 << 20
    assert sorted(r.page_id for r in warc.read_warc(spark, f"{tmp_dir}/warc").select("page_id").collect()) == \
        sorted([*range(40)] * 3)
