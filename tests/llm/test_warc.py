import gzip
import hashlib
import random
from pathlib import Path

import pytest

from orderlens.llm import warc as op

SCHEMA = "page_id long, url string, html string, digest string"


@pytest.fixture
def stored(session, tmp_path):
    """What page_captures says after a round trip, and the folder."""

    def run(rows, schema=SCHEMA, **options):
        path = str(tmp_path / f"archive{len(list(tmp_path.iterdir()))}")
        table = session.createDataFrame([(*r, "x") for r in rows], schema).repartition(3)
        op.write(table, path, **options)
        return [tuple(r) for r in op.page_captures(op.records(session, path)).collect()], path

    return run


def brute_force(rows, least=op.LEAST_BYTES):
    raw = lambda x: b"" if x is None else x if isinstance(x, (bytes, bytearray)) else x.encode()
    last: dict = {}
    for i, _, x in rows:
        last[raw(x)] = max(last.get(raw(x), i), i)
    out = []
    for i, _, x in rows:
        again = len(raw(x)) >= least and last[raw(x)] != i
        out.append((str(i), "revisit" if again else "response", len(raw(x)), hashlib.sha1(raw(x)).hexdigest(), str(last[raw(x)]) if again else None))
    return sorted(out)


def pages(seed, count):
    rng = random.Random(seed)
    shared = ["s" * 999, "t" * 1000, "é" * 500, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0" * 20, "\r\n\r\n" * 400]
    kinds = [lambda: rng.choice(shared), lambda: None, lambda: "".join(rng.choice("WARC/1.\r\n ") for _ in range(rng.randrange(3000))), lambda: "x" * rng.randrange(1500)]
    urls = ["http://a.b/c?d#e", None, "no url", "https://h.example", "http://x/y\r\nContent-Length: 5\r\n\r\n", "http://é.example/ü"]
    return [(i, rng.choice(urls), rng.choice(kinds)()) for i in rng.sample(range(-count, 10 * count), count)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(stored, session, compression):
    rows = pages(1, 150)
    before = session.conf.get("spark.sql.files.maxPartitionBytes")
    session.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        found, _ = stored(rows, compression=compression)
    finally:
        session.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(found) == brute_force(rows)


def test_a_third_of_all_rows_alike(stored):
    rows = [(i, f"http://h/{i}", "same " * 300 if i % 3 == 0 else f"{i} " * 300 if i % 3 == 1 else f"pair {i // 6} " * 200) for i in range(600)]
    found, path = stored(rows)
    assert sorted(found) == brute_force(rows)
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*"))
    assert text.count(b"same " * 300) == 1 and text.count(b"WARC-Type: ") == 3 * len(rows)


def test_bytes_that_are_no_text(stored):
    rng = random.Random(2)
    rows = [(i, "http://h/", bytes(rng.randrange(256) for _ in range(rng.choice([0, 5, 2000])))) for i in range(40)]
    rows += [(i + 100, u, bytes(x)) for i, u, x in rows[::2]]
    found, path = stored(rows, "page_id long, url string, body binary, html string", payload="body")
    assert sorted(found) == brute_force(rows)


def test_captures_hold_what_was_written(stored, session):
    long_page = "<p>\r\n\r\n" * 300_000
    _, path = stored([(5, "http://h.example/a?b#c", long_page), (None, None, "z" * 1200)])
    found = {r["target_uri"]: r for r in op.captures(op.records(session, path)).collect()}
    first, second = found["http://h.example/a?b#c"], found[None]
    assert (first["payload"].decode(), first["n_bytes"], first["truncated"]) == (long_page, len(long_page), False)
    assert first["requests"][0]["block"] == b"GET /a?b HTTP/1.1\r\nHost: h.example\r\n\r\n"
    assert first["metadata"][0]["block"] == b"page_id: 5\r\n" and second["metadata"][0]["block"] == b""
    assert len({r["record_id"] for r in op.records(session, path).collect()}) == 6


def test_rows_that_repeat(stored):
    big = "b" * 2000
    found, _ = stored([(7, "u", big), (7, "u", big), (3, "u", big), (None, None, big), (None, None, big), (None, "u", "s"), (None, "u", "s")])
    digest = hashlib.sha1(big.encode()).hexdigest()
    assert sorted(r[1] for r in found if r[3] == digest) == ["response"] + ["revisit"] * 4
    assert [r for r in found if r[1] == "response" and r[3] == digest] == [("7", "response", 2000, digest, None)]
    assert {r[4] for r in found if r[1] == "revisit"} == {"7"}
    assert [r[:3] for r in found if r[2] == 1] == [(None, "response", 1)] * 2
    assert stored([])[0] == []


def test_other_archives(session, tmp_path):
    """Both versions, several concurrent ids, lower-case fields, records apart from their response, and what is broken."""
    block = "HTTP/1.1 200 OK\r\n\r\nWARC/1.0\r\ncontent-length: 1\r\n\r\n"
    record = lambda kind, name, body, *more: "\r\n".join([f"WARC/1.0\r\nWARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"content-length: {len(body)}", *more, "", body, "", ""])
    http = "Content-Type: application/http; msgtype=response"
    one = record("warcinfo", "i", "software: x\r\n") + record("request", "q", "GET", "WARC-Concurrent-To: <r>", "WARC-Concurrent-To: <lost>") + record("resource", "x", "plain")
    two = record("response", "r", block, http) + record("revisit", "v", "HTTP/1.1 200 OK\r\nContent-Length: 77\r\n\r\n", http, "WARC-Refers-To: <gone>", "WARC-Payload-Digest: sha1:abc")
    (tmp_path / "one.warc").write_bytes(one.encode())
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(two.encode()) + gzip.compress(record("metadata", "m", "", "WARC-Concurrent-To: <r>").encode()[:-4] + b"\r\n\r\nWARC/1.1\r\nnothing"))
    found = op.records(session, str(tmp_path))
    assert sorted((r["type"] or "", r["record_id"] or "") for r in found.collect()) == sorted(
        [("warcinfo", "<i>"), ("request", "<q>"), ("resource", "<x>"), ("response", "<r>"), ("revisit", "<v>"), ("metadata", "<m>"), ("", "")])
    by = {r["record_id"]: r for r in op.captures(found).collect()}
    assert by["<r>"]["payload"] == b"WARC/1.0\r\ncontent-length: 1\r\n\r\n" and by["<r>"]["n_bytes"] == 31
    assert [len(by["<r>"][c]) for c in ("requests", "metadata")] == [1, 1]
    assert (by["<lost>"]["type"], len(by["<lost>"]["requests"])) == (None, 1) and by["<x>"]["payload"] == b"plain"
    told = {r["record_type"]: tuple(r) for r in op.page_captures(found).collect()}
    assert told["revisit"] == (None, "revisit", 77, "abc", None)
