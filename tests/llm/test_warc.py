"""WARC round trips, revisits, segments and damage."""

from __future__ import annotations

import gzip
import glob
import random
from collections import Counter

import pytest

from playerlake.llm import warc
from playerlake.session import local_path

PAGES = "page_id long, url string, html string"


def page_rows() -> list[tuple]:
    rng = random.Random(4)
    rows = [(k, f"http://h/{k}", "".join(rng.choice("abc \r\n<>é0") for _ in range(rng.randint(0, 3000)))) for k in range(40)]
    rows += [(50, None, rows[3][2]), (51, "http://x y\r\nWARC-Type: fake", rows[3][2]), (52, "u", None), (53, "u", ""), (None, "u", rows[4][2]), (None, "u", "only here")]
    rows += [(60, "u", "twice"), (60, "u", "twice"), (61, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 20), (62, "u", "é" * 200_000), (63, "u", "\r\n\r\n"), (64, "u", "ends with\r\n")]
    return rows


@pytest.mark.parametrize("segment_bytes, records", [(warc.SEGMENT_BYTES, warc.RECORDS_PER_FILE), (700, 5)])
@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, scratch, segment_bytes, records, least):
    rows = page_rows()
    warc.write_archives(spark.createDataFrame([(*r, 1) for r in rows], PAGES + ", payload int"), scratch, min_payload=least, segment_bytes=segment_bytes, records_per_file=records)
    got = Counter((r.page_id, bytes(r.payload) if r.payload is not None else None, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.complete) for r in warc.read_archives(spark, scratch).collect())
    newest: dict = {}
    for i, _, html in rows:
        newest.setdefault(html or "", []).append(i)
    want = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        same = newest[html or ""]
        top = max((x for x in same if x is not None), default=None)
        revisit = len(body) >= least and len(same) > 1 and i != top
        want[i, None if revisit else body, len(body), warc.digest_of(body), "revisit" if revisit else "response", top if revisit else None, True] += 1
    assert got == want


def test_damage_is_reported_not_dropped(spark, scratch):
    warc.write_archives(spark.createDataFrame([(1, "u", "x" * 5000), (2, "u", "short")], PAGES).coalesce(1), scratch, segment_bytes=1000)
    path, = glob.glob(f"{local_path(scratch)}/part-*")
    raw = gzip.decompress(open(path, "rb").read())
    at = raw.index(b"WARC-Segment-Number: 3")
    start, end = raw.rindex(b"WARC/1.1", 0, at), raw.index(b"WARC/1.1", at)
    other = f"{scratch}-damaged"
    import os

    os.makedirs(local_path(other))
    with gzip.open(f"{local_path(other)}/part-0.txt.gz", "wb") as f:
        f.write(raw[:start] + raw[end:])
    got = {r.page_id: (r.payload_bytes, r.complete) for r in warc.read_archives(spark, other).collect()}
    assert got == {1: (None, False), 2: (5, True)}


def test_empty_table(spark, scratch):
    warc.write_archives(spark.createDataFrame([], PAGES), scratch)
    assert warc.read_archives(spark, scratch).count() == 0


def test_chunked_framing():
    for n in (0, 1, 8192, 20_000):
        assert warc.dechunked(warc.chunked(b"y" * n)) == b"y" * n
    assert warc.dechunked(b"3;name=v\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"4\r\nabc\r\n0\r\n\r\n")
