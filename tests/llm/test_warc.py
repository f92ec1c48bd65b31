import gzip
import io

import pytest
from pyarrow import fs

from linkhoard.llm import files, warc

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a/é?x=1 2", "<p>one</p>"), (2, None, "<p>two\r\n\r\nWARC/1.1\r\n</p>"), (3, "http://b/", "<p>one</p>"), (4, "", None), (5, "http://c/", ""),
    (0, "http://d/", "<p>two\r\n\r\nWARC/1.1\r\n</p>"), (6, "http://e/\r\nX: y", "x" * 3_000_000), (7, "http://f/", "日本語"), (3, "http://b/", "<p>one</p>"), (None, "http://n/", "<p>one</p>"),
]


def expected(pages, least=0):
    first = {}
    for page_id, _, html in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html or "", page_id)
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        origin = first.get(html or "", page_id)
        revisit = page_id is not None and origin != page_id and len(data) >= least
        out.append((page_id, len(data), warc.digest(data), "revisit" if revisit else "response", origin if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("least", [0, 11])
def test_records_match_brute_force(spark, least):
    pages = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "1 as first", "'x' as sha1", "2 as n")
    index = warc.normalise(warc.write(pages, least))
    rows = warc.read(index)
    assert found(rows) == expected(PAGES, least)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in rows.filter("record_type = 'response'").collect()}
    assert payloads[7] == "日本語".encode() and payloads[6] == b"x" * 3_000_000


def test_every_record_is_a_member_of_its_own(spark):
    archives = warc.write(spark.createDataFrame(PAGES, SCHEMA).coalesce(1))
    index = warc.normalise(archives).collect()
    for row in index:
        (member,) = files.read_spans([(row["file"], row["offset"], row["length"])])
        record = gzip.decompress(member)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    wholes = []
    for row in archives.collect():
        system, path = fs.FileSystem.from_uri(row["file"])
        data = system.open_input_file(path).read()
        wholes.append(gzip.decompress(data))
        assert data.count(b"\x1f\x8b\x08") >= 1
    joined = {}
    for row in index:
        (member,) = files.read_spans([(row["file"], row["offset"], row["length"])])
        joined.setdefault(row["file"], []).append(gzip.decompress(member))
    assert sorted(b"".join(m) for m in joined.values()) == sorted(wholes)


def test_streams_of_any_cut_and_damaged_ones():
    records = [warc._record(i, f"http://x/{i}", bytes([65 + i % 26]) * (i * 97), None) for i in range(60)]
    whole = gzip.compress(b"".join(records))
    members = b"".join(map(gzip.compress, records))
    for data in (whole, members):
        assert [r for _, r in warc.records(io.BytesIO(data))] == records
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(io.BytesIO(whole[: len(whole) // 2])))
    with pytest.raises(ValueError, match="ends within a record"):
        list(warc.records(io.BytesIO(gzip.compress(records[5][:-10]))))
    assert list(warc.records(io.BytesIO(b""))) == []


def test_empty_table(spark):
    assert warc.read(warc.normalise(warc.write(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_rows_of_one_page_with_other_payloads_keep_them(spark):
    pages = [(1, None, "same"), (2, None, "same"), (2, None, "other"), (3, None, "other")]
    rows = warc.read(warc.normalise(warc.write(spark.createDataFrame(pages, SCHEMA)))).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"], bytes(r["payload"] or b"")) for r in rows) == [
        (1, "response", None, b"same"), (2, "response", None, b"other"), (2, "revisit", 1, b""), (3, "revisit", 2, b""),
    ]
