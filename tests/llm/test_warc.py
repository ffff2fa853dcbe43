import base64
import hashlib

from scriptorium.llm.warc_bundle import Bundle, read_bundles, write_bundles
from tests.llm.helpers import frame

SCHEMA = "page_id long, url string, html string"


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_round_trip(spark):
    rows = [(i, f"http://h/{i}\r\nX: y", t) for i, t in enumerate(["<p>a", "b" * 400_000, "<p>a", "", None, "é😀\r\n\r\n", "WARC/1.1\r\n", "<p>a"])]
    df = frame(spark, rows, SCHEMA, ["digest", "first", "frame"])
    index = write_bundles(df)
    got = {r.page_id: r for r in read_bundles(index).collect()}
    assert len(got) == len(rows)
    for i, _, t in rows:
        first = min(j for j, _, x in rows if (x or "") == (t or ""))
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len((t or "").encode()), digest(t))
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
    place = index.where("record_id = 'urn:page:5'").first()
    warc, _, payload = Bundle(place.bundle).record(place.frame, place.offset, place.length)
    assert payload == rows[5][2].encode() and warc["WARC-Record-ID"] == "<urn:page:5>"


def test_edges(spark):
    assert read_bundles(write_bundles(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(None, None, "x"), (None, "u", "x"), (1, None, "x"), (1, None, "x"), (2, None, "x")]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in read_bundles(write_bundles(spark.createDataFrame(rows, SCHEMA))).collect()), key=str)
    assert got == [(1, "response", None), (1, "revisit", 1), (2, "revisit", 1), (None, "response", None), (None, "response", None)]
    small = [(1, None, "x"), (2, None, "x"), (3, None, "y" * 50), (4, None, "y" * 50)]
    got = {r.page_id: r.refers_to for r in read_bundles(write_bundles(spark.createDataFrame(small, SCHEMA), min_revisit_bytes=10)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}
