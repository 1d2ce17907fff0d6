import hashlib
import random
import zlib

import pytest

from corpusloom.llm import transport_stream as ts


def plain_read(media):
    """The payload, by the shortest way: every packet of the stream's identifier, without its headers."""
    out, unit = b"", b""
    for lo in range(0, len(media), 188):
        p = media[lo : lo + 188]
        assert p[0] == 0x47
        if (p[1] & 31) << 8 | p[2] != ts.STREAM_PID:
            continue
        body = p[5 + p[4] :] if p[3] & 0x20 else p[4:]
        if p[1] & 0x40:
            out, unit = out + unit[14:], b""
        unit += body
    return out + unit[14:]


def media_of(spark, streams):
    return spark.createDataFrame([(i, m, "x", 1) for i, m in enumerate(streams)], "doc_id long, media binary, payload string, at int").repartition(2)


def test_round_trip(spark, docs, rows):
    want = sorted(
        (i, len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-16:]), len(m), hashlib.sha256(m).hexdigest())
        for i, t, *_ in rows for raw in [(t or "").encode()] for pay in [raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))] for m in [ts.write_stream(pay)] if plain_read(m) == pay and i is not None
    )
    got = ts.round_trip(docs).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r)[:7] for r in got if r.doc_id is not None) == want
    assert all(r.feature.endswith("continuity_errors=0 damage=0") for r in got)
    assert ts.round_trip(docs.limit(0)).count() == 0


def test_known_bytes():
    """Check value of sections, tables, timestamps and counters, by the standard's own numbers."""
    assert ts.section_crc(b"123456789") == 0x0376E6E7
    m = ts.write_stream(b"a" * 192 * 8 * 9)
    assert m[:17] == bytes.fromhex("474000100000b00d0001c100000001e100")
    assert len(m) % 188 == 0
    u = list(ts.Reader().units(m))
    assert [x.pts for x in u] == [90_000 + 17_280 * k for k in range(9)]
    assert [k for k, x in enumerate(u) if x.random_access] == [0, 8]


def test_damage(spark):
    rng = random.Random(3)
    pay = bytes(rng.randrange(256) for _ in range(192 * 70))
    m = ts.write_stream(pay)
    packets = [m[lo : lo + 188] for lo in range(0, len(m), 188)]
    lost = b"".join(packets[:6] + packets[7:])  # a packet of the stream
    twice = b"".join(packets[:6] + packets[5:])
    noise = b"".join(packets[:4]) + b"\1\2\3" + b"".join(packets[4:])
    filler = b"".join(packets[:3] + [bytes([0x47, 0x1F, 0xFF, 0x10]) + b"\xff" * 184] + packets[3:])
    table = bytearray(m)
    table[15] ^= 1
    got = {r.doc_id: r for r in ts.read_media(media_of(spark, [m, lost, twice, noise, filler, bytes(table), m[:-50], b"", None, b"nothing of the kind" * 50])).collect()}
    counts = {i: (r.continuity_errors, r.lost_sync, r.bad_sections, r.cut_units) for i, r in got.items()}
    assert counts[0] == (0, 0, 0, 0) and bytes(got[0].payload) == pay
    assert counts[1][0] == 1 and counts[1][3] == 1 and len(got[1].payload) < len(pay)
    assert counts[2] == (0, 0, 0, 0) and bytes(got[2].payload) == pay  # a repeated packet is no error
    assert counts[3] == (0, 1, 0, 0) and bytes(got[3].payload) == pay
    assert counts[4] == (0, 0, 0, 0) and bytes(got[4].payload) == pay
    assert counts[5][2] == 1  # the stream is found by the table of the next point
    assert len(got[5].points) == len(got[0].points) - 1
    assert counts[6][1] == 1 and counts[6][3] == 1
    for i in (7, 8, 9):
        assert bytes(got[i].payload) == b"" and got[i].points == [] and got[i].streams == []


def test_packets_and_points(spark):
    pay = bytes(i % 251 for i in range(192 * 8 * 20 + 192))
    df = media_of(spark, [ts.write_stream(pay)])
    units = sorted(ts.elementary_packets(df).collect(), key=lambda r: r.number)
    assert b"".join(bytes(u.data) for u in units) == pay
    assert [(u.program, u.stream_type, u.pid) for u in units] == [(1, 6, 0x101)] * 21
    points = ts.read_media(df).first().points
    assert [(p.first, p.pts) for p in points] == [(192 * 64 * k, 90_000 + 138_240 * k) for k in range(3)]
    late = ts.read_media(df, from_pts=points[1].pts + 5).first()
    assert bytes(late.payload) == pay[points[1].first :] and late.continuity_errors == 0
    assert bytes(ts.read_media(df, from_pts=0).first().payload) == pay


def test_times_go_on_past_their_range(monkeypatch):
    monkeypatch.setattr(ts, "FIRST_PTS", ts.PTS_RANGE - 20_000)
    u = list(ts.Reader().units(ts.write_stream(b"b" * 192 * 8 * 4)))
    assert [x.pts - u[0].pts for x in u] == [0, 17_280, 34_560, 51_840]


def test_sections_over_packets():
    """A table longer than a packet, and one that begins behind the end of another."""
    streams = b"".join(bytes([6]) + (0xE000 | 0x200 + k).to_bytes(2, "big") + b"\xf0\0" for k in range(60))
    pmt = ts.section(2, 1, b"\xe2\0\xf0\0" + streams)
    again = ts.section(2, 2, b"\xe3\0\xf0\0" + bytes([15]) + b"\xe3\0\xf0\0")
    first = b"\0" + pmt[:183]
    rest = pmt[183:]
    second = bytes([len(rest)]) + rest + again
    packets = [bytes([0x47, 0x40, 0, 0x10]) + ts.PAT, bytes([0x47, 0x41, 0, 0x10]) + first, bytes([0x47, 0x41, 0, 0x11]) + second.ljust(184, b"\xff")]
    r = ts.Reader()
    assert list(r.units(b"".join(packets))) == []
    assert r.streams == {0x200 + k: (1, 6) for k in range(60)} | {0x300: (2, 15)}
    assert r.bad_sections == 0


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 200])
def test_every_length(n):
    pay = bytes(random.Random(n).randrange(256) for _ in range(192 * n))
    m = ts.write_stream(pay)
    assert len(m) % 188 == 0 and plain_read(m) == pay
    r = ts.Reader()
    assert b"".join(bytes(u.data) for u in r.units(m)) == pay
    assert (r.continuity_errors, r.lost_sync, r.bad_sections, r.cut_units) == (0, 0, 0, 0)
