import hashlib
import io

import pyarrow.parquet as pq
import zstandard

from colloquy.llm import warc
from colloquy.llm.common import table
from tests.conftest import SF_DIR


def digest(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def want(pages):
    first = {}
    for p in pages:
        if p["page_id"] is not None and len((p["html"] or "").encode()) >= 100:
            first[p["html"]] = min(p["page_id"], first.get(p["html"], p["page_id"]))
    out = []
    for p in pages:
        at = first.get(p["html"], p["page_id"])
        revisit = p["page_id"] is not None and at != p["page_id"]
        out.append(
            (p["page_id"], len((p["html"] or "").encode()), digest(p["html"]), "revisit" if revisit else "response", at if revisit else None)
        )
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    got = warc.archive_round_trip(table(spark, SF_DIR, "pages")).collect()
    assert sorted(map(tuple, got), key=str) == want(pages)


def test_copies_nulls_and_repeats(spark, tmp_path):
    long = "é" * 60
    rows = [(9, "http://a/", long, 1), (3, None, long, 2), (5, "u\r\nx", long, 3), (4, "u", "short", 4), (2, "u", "short", 5),
            (6, "u", None, 6), (7, "u", "", 7), (None, "u", long, 8), (None, None, None, None), (3, None, long, 2), (9, "v", long, 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    pages = [dict(zip(("page_id", "url", "html"), r)) for r in rows]
    folder = f"file://{tmp_path}/x"
    index = warc.write_archive(df, folder, bundle_bytes=300)
    assert index.select("bundle").distinct().count() >= 2
    assert sorted(map(tuple, warc.read_archive(index, folder).collect()), key=str) == want(pages)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_bundle_is_plain_zstandard_and_seekable():
    class Out(io.BytesIO):
        def close(self):
            pass

    out = Out()
    writer = warc.BundleWriter(out)
    records = [warc.record("response", i, f"http://h/{i}", digest("x"), bytes([i]) * 300_000, None) for i in range(9)]
    places = [writer.add(r) for r in records]
    writer.close()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(records)

    class In(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = warc.BundleReader(In(out.getvalue()))
    assert len(reader.frames) > 2
    for i in (8, 0, 5):
        headers, block, _ = warc.parse_record(reader.frame(places[i][0]), places[i][1])
        assert headers["X-Page-Id"] == str(i) and block == bytes([i]) * 300_000
