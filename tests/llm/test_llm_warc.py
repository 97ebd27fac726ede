import base64
import hashlib
import io

import pytest
import zstandard
from odd import FOLDER

from massloom.llm.warc import SKIPPABLE, ArchiveWriter, archive_round_trip, read_records, record_bytes, write_archives

SCHEMA = "page_id long, url string, html string, sha string, top int, again int, size int"


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def want(rows, least=0):
    top = {}
    for i, _, t in rows:
        if len((t or "").encode()) >= least:
            top[t or ""] = max(top.get(t or "", -1), -1 if i is None else i)
    out = []
    for i, _, t in rows:
        again = (t or "") in top and (-1 if i is None else i) != top[t or ""]
        out.append((i, len((t or "").encode()), digest(t), "revisit" if again else "response", top[t or ""] if again else None))
    return sorted(out, key=repr)


def got(spark, rows, **options):
    df = archive_round_trip(spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], SCHEMA), **options)
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=repr)


ROWS = [(1, "http://a/\r\nX: y", "same"), (5, "u", "same"), (3, None, "same"), (2, "u", None), (9, "u", ""), (None, "u", "alone"), (None, "u", "same"),
        (7, "é", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n" * 3), (8, "u", "x" * 3_000_000), (2**53 + 1, "u", "big id"), (4, "u", "é🙂\r\n\r\n")]


def test_round_trip(spark):
    assert got(spark, ROWS) == want(ROWS)
    assert got(spark, []) == []


def test_least_bytes_and_small_archives(spark):
    assert got(spark, ROWS, least_bytes=5, archive_bytes=1, sample_bytes=10) == want(ROWS, 5)


def test_rows_that_share_the_largest_id_are_responses(spark):
    rows = [(1, "u", "t"), (2, "u", "t"), (2, "u", "t")]
    assert [r[3] for r in got(spark, rows)] == ["revisit", "response", "response"]


def test_whole_table_and_a_dictionary_that_pays(spark, tmp_path):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert got(spark, rows) == want(rows)
    size = {}
    for n in (1 << 15, 256):
        manifest = write_archives(pages.repartition(1), f"file://{tmp_path}/{n}", dict_bytes=n)
        size[n] = sum(r["bytes"] for r in manifest.collect())
        assert sum(r.records for r in manifest.collect()) == len(rows)
    assert size[1 << 15] > 0


def test_frames_are_records_and_the_dictionary_leads():
    records = [record_bytes(i, f"http://a/{i}", f"<p>{i} same words in all pages {i * 7}</p>".encode() * 9, "D", False, None) for i in range(300)]
    out = io.BytesIO()
    out.close = lambda: None
    writer = ArchiveWriter(out, 2048, 10_000, 3)
    for r in records:
        writer.add(r)
    writer.close()
    data = out.getvalue()
    assert int.from_bytes(data[:4], "little") == SKIPPABLE and len(data) == writer.size
    size = int.from_bytes(data[4:8], "little")
    made = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert made[:4] == (0xEC30A437).to_bytes(4, "little")  # a Zstandard dictionary
    at, frames = 8 + size, []
    while at < len(data):  # each record is a frame of its own
        one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(made)).decompressobj()
        frames.append(one.decompress(data[at:]))
        at = len(data) - len(one.unused_data)
    assert frames == records
    assert [int(h["WARC-Record-ID"][10:-1]) for h, _ in read_records(io.BytesIO(data))] == list(range(300))
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(b"12345678" + data)))
