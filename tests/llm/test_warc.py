"""Archives: exact round trip."""
import gzip
import hashlib

from tollgate.llm import warc
from tollgate.llm.queries import op5_warc

SF = "/root/testdata/sf0.001"


def expected(rows):
    first = {}
    for page, html in rows:
        if len(html.encode()) >= 100:
            first[html] = min(page, first.get(html, page))
    out = []
    for page, html in rows:
        lead = first.get(html, page)
        out.append((page, len(html.encode()), hashlib.sha256(html.encode()).hexdigest(), "response" if lead == page else "revisit", None if lead == page else lead))
    return sorted(out)


def test_tables(spark):
    rows = [(r.page_id, r.html or "") for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op5_warc(spark, SF).collect())
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_odd_payloads(spark, tmp_path):
    odd = ["", "x", "\r\n\r\n", "\r\n\r\n" * 50, "a\r\n\r\n", "\r\n", "\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n" * 5, "é" * 50, "y" * 99, "y" * 100, "\r\r\n\r\n\n" * 40, "z" * 3_000_000,
           "\x00 binary \x01\r\n" * 20, "end\r", "end\r\n\r"]
    pages = [(i, f"http://x/{i}", h, "e") for i, h in enumerate(odd)] + [(100 + i, "u", h, "e") for i, h in enumerate(odd)]
    pages += [(200, None, None, "e"), (201, "a\r\nb", "q" * 100, "e"), (None, "n", "q" * 100, "e"), (-5, "m", "q" * 100, "e"), (3, "http://x/3", odd[3], "again")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest string").repartition(3)
    warc.write_archive(df, f"{tmp_path}/a")
    got = warc.assemble(warc.read_records(spark, f"{tmp_path}/a")).collect()
    want = sorted(((p, h or "") for p, _, h, _ in pages), key=lambda x: (x[0] is None, x[0] or 0))
    least = {}
    for p, h in reversed(want):
        least[h] = p
    ids = {r.capture_id: int(r.metadata.fields.split()[1]) if r.metadata.fields.split()[1:] else None for r in got}
    assert len(got) == len(want) == len(ids) and sorted(ids.values(), key=str) == sorted((p for p, _ in want), key=str)
    responses = {}
    for r in got:
        page, digest = ids[r.capture_id], r.response.payload_digest
        html = next(h for p, h in want if p == page and f"sha256:{hashlib.sha256(h.encode()).hexdigest()}" == digest)
        assert r.response.payload_bytes == len(html.encode())
        assert bytes(r.response.payload) == (html.encode() if r.record_type == "response" else b"")
        assert r.request.http.startswith("GET ") and r.request.record_id != r.metadata.record_id
        if len(html.encode()) < 100:
            assert r.record_type == "response"
        elif r.record_type == "response":
            assert page == least[html] and responses.setdefault(html, r.capture_id) == r.capture_id
        else:
            assert ids[r.response.refers_to] == least[html]
    assert set(responses) == {h for _, h in want if len(h.encode()) >= 100}  # one each; the others revisit it
    raw = b"".join(gzip.open(p).read() for p in sorted((tmp_path / "a").glob("part-*.gz")))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and raw.count(b"WARC-Type: request") == len(want)


def test_query_joins_every_record(spark, tmp_path):
    pages = [(1, "http://a", "x" * 200), (2, "http://b", "x" * 200), (2, "http://b", "x" * 200), (None, None, "x" * 200), (4, "http://d", "short"), (5, "http://e", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = op5_warc(spark, str(tmp_path))
    rows = sorted((r.page_id or 0, r.record_type, r.refers_to, r.request_line, r.metadata_fields) for r in out.collect())
    assert rows == [(0, "revisit", 1, "GET  HTTP/1.1", "page-id:"), (1, "response", None, "GET http://a HTTP/1.1", "page-id: 1"),
                    *[(2, "revisit", 1, "GET http://b HTTP/1.1", "page-id: 2")] * 2, (4, "response", None, "GET http://d HTTP/1.1", "page-id: 4"),
                    (5, "response", None, "GET http://e HTTP/1.1", "page-id: 5")]
    captures = warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string"), f"{tmp_path}/b")
    plan = captures.select("record_type", "request.http", "metadata.fields")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2 and "request" in plan


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(df, f"{tmp_path}/e").collect() == []
