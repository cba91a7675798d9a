import gzip
import hashlib
import random
import re

from pyspark.sql import functions as F

from foldwise.frame import work_folder
from foldwise.llm import warc


def reader(data):
    return lambda at, n: data[at: at + n]


def records(n, packed, size=300):
    rng = random.Random(n)
    out = []
    for i in range(n):
        body = bytes(rng.choices(range(256), k=size)) + b"\r\n\r\nWARC/1.1\r\n"
        raw = warc.record_bytes(f"urn:page:{i}", f"http://x/{i}", body, hashlib.sha1(body).hexdigest(), "2024-01-01T00:00:00Z")
        out.append(gzip.compress(raw) if packed else raw)
    return out


def read(data):
    found = list(warc.entries(reader(data), len(data)))
    ids = [int(f.record_id.rpartition(":")[2]) for _, _, f in found if not isinstance(f, str)]
    return ids, [(a, b, f) for a, b, f in found if isinstance(f, str)]


def test_whole_archives():
    for packed in (True, False):
        assert read(b"".join(records(9, packed))) == (list(range(9)), [])
    assert read(gzip.compress(b"".join(records(4, False)))) == ([0, 1, 2, 3], [])
    assert read(b"") == ([], [])


def test_damage_costs_only_the_damaged_records():
    for packed in (True, False):
        parts = records(6, packed)
        starts = [sum(map(len, parts[:i])) for i in range(7)]
        data = b"".join(parts)
        for at, lost in ((starts[2] + len(parts[2]) // 2, 2), (starts[0], 0), (starts[5] + (60 if packed else 5), 5)):
            broken = data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]
            ids, gaps = read(broken)
            assert ids == [i for i in range(6) if i != lost], (packed, at)
            assert [(a, b) for a, b, _ in gaps] == [(starts[lost], starts[lost + 1])]
        ids, gaps = read(b"noise" + data[: starts[3]] + b"\x00" * 70_000 + data[starts[3]: starts[5] + 20])
        assert ids == [0, 1, 2, 3, 4] and len(gaps) == 3
        assert gaps[0][:2] == (0, 5) and gaps[1][1] - gaps[1][0] == 70_000 and gaps[2][1] - gaps[2][0] == 20


def test_wrong_lengths_and_digests():
    one, two, three = records(3, False)
    longer = re.sub(rb"Content-Length: (\d+)\r\n\r\nHTTP", lambda m: b"Content-Length: 99999\r\n\r\nHTTP", two)
    swapped = two.replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:" + b"A" * 32 + b"\r\nX: ")
    unnamed = two.replace(b"WARC-Date: ", b"no colon here\r\nWARC-Date: ").replace(b"no colon here", b"nothing")
    for bad, reason in ((longer, "cut short"), (swapped, "block digest"), (unnamed, "without a name")):
        ids, gaps = read(one + bad + three)
        assert ids == [0, 2] and len(gaps) == 1 and reason in gaps[0][2]
        assert gaps[0][:2] == (len(one), len(one + bad))


def test_pages_round_trip(spark):
    big = "é" * 700
    rows = [(1, "http://a\r\nX: 1", big), (7, None, big), (3, "u", big), (4, "u", None), (5, "u", "small"), (6, "u", "small"),
            (None, "u", big), (7, "again", big), (8, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    for packed in (True, False):
        files = warc.write_warc(pages, f"{work_folder(spark)}/warc-test-{packed}", packed=packed)
        assert files.agg(F.sum("records")).first()[0] == len(rows)
        found = warc.read_warc(files)
        assert warc.gaps(found).count() == 0
        got = {}
        for r in warc.resolved(found).collect():
            got.setdefault(r.record_id, []).append((r.type, r.payload_bytes, r.payload_digest, r.refers_to))
        whole = hashlib.sha1(big.encode()).hexdigest()
        assert got["urn:page:1"] == [("revisit", 1400, whole, "urn:page:7")] == got["urn:page:3"]
        assert got["urn:page:7"] == [("response", 1400, whole, None)] * 2
        assert got["urn:page:None"] == [("response", 1400, whole, None)]
        assert got["urn:page:4"] == got["urn:page:8"] == [("response", 0, hashlib.sha1(b"").hexdigest(), None)]
        assert got["urn:page:5"][0][0] == got["urn:page:6"][0][0] == "response"
        texts = {r.record_id: bytes(r.payload).decode() for r in found.filter("type = 'response'").collect()}
        assert texts["urn:page:7"] == big
    assert warc.read_warc(warc.find_archives(spark, f"{work_folder(spark)}/warc-test-True")).count() == len(rows)
    empty = warc.write_warc(pages.limit(0), f"{work_folder(spark)}/warc-test-none")
    assert warc.read_warc(empty).count() == 0


def test_records_before_the_damage_of_a_member(monkeypatch):
    whole = b"".join(records(40, False, size=9000))
    data = gzip.compress(whole)
    at = len(data) * 9 // 10
    broken = data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]
    for kept in (warc.KEEP_BYTES, 1000):
        monkeypatch.setattr(warc, "KEEP_BYTES", kept)
        for bad in (broken, data[:at]):
            ids, gaps = read(bad)
            assert ids[:34] == list(range(34)) and len(gaps) == 1 and gaps[0][:2] == (0, len(bad))
        assert read(data + gzip.compress(records(1, False)[0])) == ([*range(40), 0], [])
        ids, gaps = read(broken + gzip.compress(records(1, False)[0]))
        assert ids[:34] == list(range(34)) and ids[-1] == 0 and gaps[0][:2] == (0, len(broken))


def test_impossible_lengths():
    one, two, three = records(3, False)

    def strict(data):
        def at_most(at, n):
            assert n <= len(data) + warc.PIECE + 8
            return data[at: at + n]
        return at_most

    for length in (b"9" * 16, b"9" * 31, b"9" * 6000):
        bad = re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"Content-Length: " + length + b"\r\n\r\nHTTP", two)
        data = one + bad + three
        found = list(warc.entries(strict(data), len(data)))
        assert [isinstance(f, str) for _, _, f in found] == [False, True, False]
        assert read(gzip.compress(data))[0] == [0, 2]
