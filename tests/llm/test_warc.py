"""WARC round trips, and salvage of damaged archives."""
import io
import random

import pytest

from cellscope.llm import warc

PAGES = "page_id long, url string, html string"


def brute(rows):
    top = {}
    for i, _, html in rows:
        p = (html or "").encode()
        top[p] = max(top.get(p, -1), -1 if i is None else i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        first = i == top[p] or top[p] == -1
        out.append((i, len(p), warc.digest(p), "response" if first else "revisit", None if first else top[p]))
    return sorted(out, key=str)


def rows_of():
    rng = random.Random(1)
    rows = [(i, f"http://x.example/{i}", "".join(rng.choices("abc <>é\r\n\0", k=rng.randint(0, 400)))) for i in range(60)]
    rows += [(100 + i, None, "same") for i in range(40)]                     # a hot payload
    rows += [(200, "u\r\nX: y\x01", None), (201, "http://é", ""), (202, "a", ""), (5, "again", rows[5][2])]
    rows += [(None, "n", "same"), (None, "n", "alone"), (None, "n2", "alone")]
    rows += [(300, "v", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (301, "g", "\x1f\x08 " * 9)]
    rows += [(302, "long", "x" * 3_000_000)]
    return rows


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip(spark, tmp_path, compressed):
    rows = rows_of()
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    manifest = warc.write(df, f"file://{tmp_path}/a", compressed, roll_bytes=2000)
    assert sum(r["records"] for r in manifest.collect()) == len(rows) and manifest.count() > 3
    got = [tuple(r) for r in warc.records(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                           "refers_to").collect()]
    assert sorted(got, key=str) == brute(rows)
    assert warc.gaps(manifest).count() == 0
    payloads = {r["page_id"]: r["payload"] for r in warc.records(manifest, True).where("record_type='response'").collect()}
    assert bytes(payloads[300]).decode() == dict((i, h) for i, _, h in rows)[300]
    found = warc.files_under(spark, f"file://{tmp_path}/a")
    assert {r["file"] for r in found.collect()} == {r["file"] for r in manifest.collect()}


def test_empty_table(spark, tmp_path):
    manifest = warc.write(spark.createDataFrame([], PAGES), f"file://{tmp_path}/e")
    assert warc.records(manifest).count() == 0


def parts(compressed, n=12):
    data = [warc.record(i, "u", (f"page {i} " + "WARC/1.1 in text \x1f " * 5).encode(), None, False) for i in range(n)]
    return [warc.member(x) if compressed else x for x in data]


def run(data):
    out = list(warc.salvage(io.BytesIO(data), len(data)))
    ids = [x["page_id"] for kind, _, _, x in out if kind == "record"]
    spans = [(a, b) for _, a, b, _ in out]
    assert spans == sorted(spans) and (not spans or (spans[0][0] == 0 and spans[-1][1] == len(data)))
    assert all(b == c for (_, b), (c, _) in zip(spans, spans[1:]))            # every byte is told
    return ids, [(a, b) for kind, a, b, _ in out if kind == "gap"]


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_goes_on_behind_damage(compressed):
    p = parts(compressed)
    starts = [sum(map(len, p[:i])) for i in range(len(p) + 1)]
    whole = b"".join(p)
    assert run(whole) == (list(range(12)), [])
    cut = whole[:starts[3]] + whole[starts[3]:][:len(p[3]) // 2] + whole[starts[4]:]     # half a record is missing
    ids, gaps = run(cut)
    assert ids == [0, 1, 2, *range(4, 12)] and gaps == [(starts[3], starts[3] + len(p[3]) // 2)]
    flipped = bytearray(whole)
    flipped[starts[6] + len(p[6]) - 30] ^= 0xFF
    ids, gaps = run(bytes(flipped))
    assert ids == [x for x in range(12) if x != 6] and gaps == [(starts[6], starts[7])]
    noise = b"\x00garbage\x1f\x8b\x08WARC/1.x" * 3
    ids, gaps = run(whole[:starts[2]] + noise + whole[starts[2]:])
    assert ids == list(range(12)) and gaps == [(starts[2], starts[2] + len(noise))]
    ids, gaps = run(whole[:-5])                                               # cut off at the end
    assert ids == list(range(11)) and gaps == [(starts[11], len(whole) - 5)]
    assert run(b"") == ([], []) and run(b"nothing here") == ([], [(0, 12)])


def test_every_single_byte_change_is_told(compressed=True):
    p = parts(True, 3)
    whole = b"".join(p)
    rng = random.Random(5)
    for k in rng.sample(range(len(p[0]), len(p[0]) + len(p[1])), 60):
        bad = bytearray(whole)
        bad[k] ^= 1 << rng.randint(0, 7)
        ids, gaps = run(bytes(bad))
        assert ids in ([0, 2], [0, 1, 2]) and (ids == [0, 1, 2] or gaps == [(len(p[0]), len(p[0]) + len(p[1]))])


def test_wrong_content_with_sound_checksum():
    good = warc.record(1, "u", b"abc", None, False)
    bad = good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd")
    data = warc.member(bad) + warc.member(good)
    assert run(data) == ([1], [(0, len(warc.member(bad)))])


def test_members_of_several_records():
    r = [warc.record(i, "u", f"page {i}".encode(), None, False) for i in range(7)]
    nested = warc.record(9, "u", r[0], None, False)
    wrong = nested.replace(b"page 0", b"page X")             # digest differs, extent is known
    short = r[5].replace(b"page 5", b"page")                  # shorter than it says
    parts = [warc.member(b"".join(x)) for x in (r[:3], [r[3], wrong, r[4]], [short, r[6]], [b"no record"])]
    at = [sum(map(len, parts[:i])) for i in range(5)]
    data = b"".join(parts)
    out = list(warc.salvage(io.BytesIO(data), len(data)))
    assert [x["page_id"] for kind, _, _, x in out if kind == "record"] == [0, 1, 2, 3, 4, 6]
    assert [(a, b) for kind, a, b, _ in out if kind == "gap"] == [(at[1], at[2]), (at[2], at[3]), (at[3], at[4])]
    assert all((a, b) == (at[0], at[1]) for _, a, b, _ in out[:3])


@pytest.mark.parametrize("n", [100, 70_000, 3_000_000])
def test_long_headers(n):
    r = [warc.record(i, "u" * (n if i == 1 else 1), b"abc", None, False) for i in range(3)]
    assert run(b"".join(r)) == ([0, 1, 2], [])
    assert run(b"".join(map(warc.member, r))) == ([0, 1, 2], [])
    noise = b"WARC/1.1\r\nno name " + b"x" * n + b"\r\n"
    assert run(r[0] + noise + r[1]) == ([0, 1], [(len(r[0]), len(r[0]) + len(noise))])
