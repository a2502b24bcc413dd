import hashlib

import pytest

from aerolith.llm import warc as W
from aerolith.llm.common import work_dir


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, url string, html string, file string, offset long")


LONG = "é" * 60  # 120 bytes


def test_round_trip(spark):
    rows = [(3, "http://a/\r\nX: y", LONG), (1, "u1", LONG), (2, None, "short"), (4, "u", "short"), (5, "", None), (6, "u6", "<p>" + "x" * 300_000), (None, "n", LONG), (7, "u7", "a\r\n\r\nb" * 40)]
    folder = work_dir(spark, "t")
    index = W.write_archives(pages(spark, *[(*r, "clash", 0) for r in rows]), folder)
    got = {(r.page_id, r.url): r for r in W.read_records(index, folder).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        r, raw = got[i, url], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        revisit = html == LONG and i != 1
        assert (r.record_type, r.refers_to) == (("revisit", 1) if revisit else ("response", None))
        assert r.payload == (None if revisit else bytearray(raw))
    some = W.read_records(index.filter("page_id = 6"), folder).collect()
    assert [r.page_id for r in some] == [6]


def test_index_is_exact(spark):
    folder = work_dir(spark, "t")
    index = W.write_archives(pages(spark, *[(k, "u", f"page {k}" * 30, "", 0) for k in range(50)]), folder).collect()
    by_file = {}
    for r in index:
        by_file.setdefault(r.file, []).append((r.offset, r.length))
    for spans in by_file.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length


def test_damage_is_noticed():
    good = W.record_bytes(1, "u", b"abc", "d", None, False)
    with pytest.raises(ValueError):
        W.parse_record(good[:-6])


def test_ranges_are_merged_within_bounds():
    spans = [(0, 10), (10, 10), (W.GAP_BYTES + 21, 5), (W.GAP_BYTES + 26, W.RANGE_BYTES), (3 * W.RANGE_BYTES, 1)]
    got = list(W.coalesced(spans))
    assert [x[2] for x in got] == [[0, 1], [2], [3], [4]]
    assert list(W.coalesced([(0, 10), (5, 2), (20, 5)])) == [(0, 25, [0, 1, 2])] and list(W.coalesced([])) == []


def test_empty(spark):
    folder = work_dir(spark, "t")
    index = W.write_archives(pages(spark), folder)
    assert index.count() == 0 and W.read_records(index, folder).count() == 0


def test_query_against_sql(spark):
    import duckdb

    duckdb.sql("CREATE OR REPLACE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    want = duckdb.sql(W.OP2_SQL).fetchall()
    cols = [d[0] for d in duckdb.sql(W.OP2_SQL).description]
    got = W.op2_warc(spark, "/root/testdata/sf0.001").select(*cols).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
