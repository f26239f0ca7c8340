"""Archives: what is written can be read, equal payloads are stored once."""

import glob
import gzip
import hashlib

from grainmill.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, refers_to string"
LONG = "<p>" + "x" * 200 + "\r\n\r\n" + "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + "</p>"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "p", "r") for r in rows], SCHEMA)


def test_round_trip(spark, tmp_path):
    rows = [
        (7, "http://a/\r\nx", LONG), (3, None, LONG), (9, "u", LONG), (3, "again", LONG), (1, "u", None), (2, "u", ""), (4, "u", "short"), (5, "u", "short"),
        (6, "é", "é" * 100 + "\r\n"), (8, "é", "é" * 100 + "\r\n"), (10, "u", "\r\n\r\n" * 60), (11, "u", "y" * 3_000_000), (None, "u", LONG), (12, "u", "z" * 99 + "\r"),
        (13, "u", "z" * 99 + "\r"),
    ]
    path = str(tmp_path / "archive")
    got = warc.archived(pages(spark, rows), path).collect()
    assert len(got) == len(rows)
    want = []
    for i, _, html in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        again = len(payload) >= 100 and i != min(same)
        want.append((str(i), len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    have = [(str(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    stored = b"".join(gzip.open(f).read() for f in glob.glob(path + "/*.gz"))
    assert stored.count(b"x" * 200) == 2 and stored.startswith(b"WARC/1.1\r\nWARC-Type: ")
    records = warc.read_archives(spark, path).collect()
    assert all(r.digest_read == r.payload_digest for r in records if r.record_type == "response")
    assert all(r.n_read == 0 for r in records if r.record_type == "revisit")


def test_empty(spark, tmp_path):
    assert warc.archived(pages(spark, []), str(tmp_path / "none")).count() == 0


def test_payloads_that_end_in_line_breaks(spark, tmp_path):
    """As only, last and middle records of files, several of which one task reads."""
    ends = ["\r\n", "\n", "\r", "\r\n\r", "\r\n\r\n", "\r\n\r\n\r\n", "\n\r\n", "\r\n\n", "\r\r\n"]
    rows = [(i, "u", "x" * 100 + str(i) + end) for i, end in enumerate(ends)] + [(50 + i, "u", end) for i, end in enumerate(ends)]
    for files in (1, 4, len(rows)):
        path = str(tmp_path / f"archive{files}")
        frame = pages(spark, rows).repartitionByRange(files, "page_id") if files > 1 else pages(spark, rows[:1])
        warc.write_archives(warc.resolve_revisits(frame), path)
        for reader in (warc.read_archives(spark, path), warc.read_archives(spark, path).coalesce(1)):
            got = {r.record_id: (r.n_read, r.digest_read) for r in reader.collect()}
            want = rows if files > 1 else rows[:1]
            assert got == {i: (len(p), hashlib.sha256(p.encode()).hexdigest()) for i, _, p in want}


def test_hot_payload(spark, tmp_path):
    """A third of the pages with one payload, some of them without an id, and copies in pairs."""
    rows = [(i if i % 30 else None, "u", LONG if i % 3 == 0 else "y" * 100 + str(i // 6)) for i in range(3000)]
    got = warc.archived(pages(spark, rows), str(tmp_path / "hot")).collect()
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html] = min(i, first.get(html, i))
    want = [(i, len(html), None if i == first[html] else first[html]) for i, _, html in rows]
    assert sorted(((r.record_id, r.payload_bytes, r.refers_to) for r in got), key=str) == sorted(want, key=str)
