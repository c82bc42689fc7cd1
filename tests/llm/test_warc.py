import gzip
import hashlib
import random
from collections import Counter

import pytest

from variantrank.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, digest string, record_id string, best string, value string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(4)
    word = lambda n: "".join(pick.choice("ab é字\r\n🙂") for _ in range(n))
    out = [(i, f"http://h/{i}", word(pick.choice([0, 3, 400, 900, 3000, 20_000]))) for i in range(60)]
    same = ["s" * 1000, "t" * 999, "é" * 500, "é" * 499 + "x", "u" * 70_000]
    out += [(100 + i, f"http://h/{i}", same[i % 5]) for i in range(40)]
    out += [(139, "http://h/zz", same[4]), (139, None, same[4])]  # ties of the largest page
    out += [(7, "http://h/7", out[7][2])] * 2 + [(139, "http://h/zz", same[4])]  # repeated rows
    out += [(None, "http://h/n", same[0]), (None, None, None), (200, None, None), (201, "a b\r\nX: y", "")]
    out += [(None, "http://h/only", "v" * 2000), (None, "http://h/also", "v" * 2000)]
    fake = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-ID: 9\r\nContent-Length: 3\r\n\r\nabc"
    out += [(300, "http://h/f", f"x\r\n\r\n{fake}\r\n\r\n{fake}\r\n\r\n"), (301, "http://h/g", fake), (302, "http://h/h", "\r\n\r\n" * 900 + "WARC/1.")]
    return out + [(303, "http://h/i", "0\r\n\r\n" * 300), (304, "http://h/long", word(300_000))]


def expected(rows):
    text = [(r[0], r[1] or "", r[2] or "") for r in rows]
    rank = lambda p, u, known: (p is not None, p or 0, known, u)
    out = Counter()
    for (page, url, said), (_, real, _) in zip(text, rows, strict=True):
        data = said.encode()
        same = [rank(p, u, r[1] is not None) for (p, u, s), r in zip(text, rows, strict=True) if s == said]
        revisit = len(data) >= 1000 and max(same) != rank(page, url, real is not None)
        refers = (max(same)[1] if max(same)[0] else None) if revisit else None
        out[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", refers)] += 1
    return out


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize(("segment", "chunk"), [(16_384, 4096), (100, 7)])
def test_round_trip(spark, rows, tmp_path, segment, chunk):
    keep = rows if segment > 100 else [r for r in rows if r[0] != 304]
    warc.write(table(spark, keep).repartition(3), f"{tmp_path}/a", segment, chunk)
    back = warc.read(spark, f"{tmp_path}/a").cache()
    assert back.where("problem is not null").count() == 0
    assert Counter(tuple(r) for r in back.select(*COLUMNS).collect()) == expected(keep)
    payloads = {(r.page_id, bytes(r.payload)) for r in back.where("record_type = 'response'").collect()}
    assert payloads <= {(p, (t or "").encode()) for p, _, t in keep}


def test_joined_by_shuffles(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_BROADCAST", -1)
    warc.write(table(spark, rows), f"{tmp_path}/a")
    assert Counter(tuple(r) for r in warc.read(spark, f"{tmp_path}/a").select(*COLUMNS).collect()) == expected(rows)


def test_segments_out_of_order_and_broken(spark, rows, tmp_path):
    """Segments may lie in any order and file; missing, repeated and changed ones are told."""
    warc.write(table(spark, [(i, f"http://h/{i}", "word " * (400 + i)) for i in range(6)]), f"{tmp_path}/a", 500, 64)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "a").glob("part-*")))
    records = [b"WARC/1.1" + x for x in data.split(b"WARC/1.1")[1:]]
    held = {i: [r for r in records if b"http://h/%d\r\n" % i in r] for i in range(6)}
    assert all(len(r) > 3 for r in held.values())
    held[1].pop(2)
    held[2] = held[2][1:]
    held[3][1] = held[3][1].replace(b"word", b"ward", 1)
    held[4] += [held[4][2]]
    held[5] = held[5][:-1]
    mixed = sum(held.values(), [])
    random.Random(1).shuffle(mixed)
    (tmp_path / "b").mkdir()
    for i in range(3):
        (tmp_path / "b" / f"{i}.warc").write_bytes(b"".join(mixed[i::3]))
    (tmp_path / "b" / "cut.warc.gz").write_bytes(gzip.compress(records[0][:-200]))
    (tmp_path / "b" / "other.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:r>\r\nX-Page-ID: 50\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhi\r\n\r\n")
    got = {r.page_id: (r.problem, r.payload_bytes) for r in warc.read(spark, f"{tmp_path}/b").collect()}
    assert got[0] == ("truncated", None)
    assert got[1] == ("missing segment", None) and got[3] == ("other digest", 2015) and got[4] == (None, 2020)
    assert got[None] == ("missing segment", None) and got[5] == ("missing segment", None) and got[50] == (None, 2)


def test_framing():
    for size in (1, 3, 1000):
        assert warc.dechunked(warc.chunked(b"abc\r\n0\r\n\r\n", size)) == b"abc\r\n0\r\n\r\n"
    assert warc.dechunked(b"3;a=b\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    assert all(warc.dechunked(x) is None for x in (b"", b"3\r\nab", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n"))


def test_empty(spark, tmp_path):
    warc.write(table(spark, []), f"{tmp_path}/a")
    assert warc.read(spark, f"{tmp_path}/a").collect() == []
