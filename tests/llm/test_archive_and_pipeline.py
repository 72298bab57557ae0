"""WARC round trips, and the pipeline's stages on awkward tables."""

import base64
import gzip
import hashlib
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402

import corpus_pipeline  # noqa: E402
from strata.llm import warc  # noqa: E402
from strata.llm.queries import read  # noqa: E402


def pages(spark):
    long = "".join(f"<p>é{i}\r\n\r\nWARC/1.1\r\n</p>" for i in range(9000))
    rows = [(1, "http://a/", "<p>one</p>"), (2, "http://b/\r\nx: y", "<p>one</p>"), (3, None, None), (4, "u", ""), (5, "u", long), (6, "u", long + "!"), (7, "u", "0\r\n\r\n"),
            (None, "u", "<p>one</p>"), (9, "u", "twice"), (9, "u", "twice")]
    return rows, spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, digest string")


@pytest.mark.parametrize("segment,least", [(1 << 30, 0), (1000, 0), (65_536, 6)])
def test_archives_come_back(spark, segment, least):
    rows, table = pages(spark)
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archive(table, path, segment_bytes=segment, min_bytes=least)
    got = warc.read_payloads(spark, path).collect()
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    want = []
    for i, b in raw:
        last = max((j for j, c in raw if c == b and j is not None), default=None)
        again = i is not None and last != i and len(b) >= least
        want.append((i or 0, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", last if again else None, None if again else b))
    assert sorted(want, key=repr) == sorted(((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]) or (b"" if r["payload"] is not None else None)) for r in got), key=repr)


def test_segments_are_checked(spark):
    _, table = pages(spark)
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archive(table.where("page_id = 5"), path, segment_bytes=1000)
    assert warc.read_records(spark, path).where("number > 100").count() == 1
    file = next(Path(path).glob("*.gz"))
    data = gzip.decompress(file.read_bytes())
    first, second = data.index(b"WARC-Segment-Number: 2\r\n"), data.index(b"WARC-Segment-Number: 3\r\n")
    start, end = data.rindex(b"WARC/1.1\r\nWARC-Type", 0, first), data.rindex(b"WARC/1.1\r\nWARC-Type", 0, second)
    broken = tempfile.mkdtemp(prefix="warc-") + "/b"
    Path(broken).mkdir()
    (Path(broken) / "part.gz").write_bytes(gzip.compress(data[:start] + data[end:]))
    with pytest.raises(Exception, match="segments are missing"):
        warc.read_records(spark, broken).collect()


def test_chunked_framing():
    for n in (0, 1, 8192, 8193, 50_000):
        body = bytes(i % 251 for i in range(n))
        assert warc.unchunked(warc.chunked(body)) == body
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"2\r\nabc\r\n0\r\n\r\n")


def test_empty_archive(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archive(pages(spark)[1].limit(0), path)
    assert warc.read_payloads(spark, path).count() == 0


@pytest.fixture(scope="module")
def folder():
    """A data folder with labels that mark some of the cases' documents."""
    out = tempfile.mkdtemp(prefix="sf-")
    import pandas as pd
    pd.DataFrame({"doc_id": range(40), "quality": 1, "toxic": 0}).to_parquet(f"{out}/labels.parquet")
    return out


@pytest.mark.parametrize("rows", ["cases", "none"])
def test_stages_carry_awkward_tables(spark, folder, rows):
    docs = cases.frame(spark, None if rows == "cases" else [])
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = tempfile.mkdtemp(prefix="stage-") + "/x"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        if name in ("line_dedup", "substring_dedup"):
            assert docs.count() == n
        assert docs.where("rest <> 'x' or key <> 7 or component_id <> 'c' or n_chars <> length(text)").count() == 0
        n = docs.count()
    ids = {r["doc_id"] for r in docs.collect()}
    if rows == "cases":
        assert {None, 3, 400, 401, 402, 403, 404} <= ids and not ids & {100, 101, 102, 103, 104, 105}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).select("doc_id").distinct().count() == len(ids)


def test_pipeline_runs_whole(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert out.columns[:8] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier"]
    assert 100 < out.select("doc_id").distinct().count() <= read(spark, sf, "documents").count()
