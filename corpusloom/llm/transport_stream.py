"""Media columns: payloads stored as MPEG transport streams, and transport streams read back.

A stream is written as ISO/IEC 13818-1 has it: packets of 188 bytes, a program association table and a program map table
before every random-access point, elementary packets with presentation timestamps, continuity counters, stuffing.  The
reader takes any such stream: it finds its sync again after damage, parses the program tables, checks continuity
counters, puts elementary packets together and notes at which byte of the stream each random-access point lies, so
that reading can begin there.  Damage is counted in the row, it never fails it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import tidy

#: Fixed values of the format: the size of a packet, its first byte, the identifiers of the association table and of filler packets.
PACKET, SYNC, PAT_PID, NULL_PID = 188, 0x47, 0, 0x1FFF
#: What is written: one program with one private stream of 8-bit samples, 8000 a second, in frames of 192.
PROGRAM, PMT_PID, STREAM_PID, STREAM_TYPE, STREAM_ID = 1, 0x100, 0x101, 0x06, 0xBD
FRAME, RATE, CLOCK = 192, 8000, 90_000
#: Frames in an elementary packet, elementary packets from one random-access point to the next, the first timestamp, and how far the program clock is behind it.
FRAMES, POINTS, FIRST_PTS, DELAY = 8, 8, 90_000, 9_000
PTS_RANGE = 1 << 33


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c >> 31 else c << 1) & 0xFFFFFFFF
        table.append(c)
    return table


_CRC = _crc_table()


@functools.lru_cache(1024)
def section_crc(data: bytes) -> int:
    """The check value of sections: zero for a section with its own check value at its end."""
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 ^ _CRC[c >> 24 ^ b]) & 0xFFFFFFFF
    return c


def section(table: int, extension: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + extension.to_bytes(2, "big") + b"\xc1\0\0"
    return head + body + section_crc(head + body).to_bytes(4, "big")


#: The two tables of what is written, each behind its pointer and filled up to a packet.
PAT = (b"\0" + section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))).ljust(184, b"\xff")
PMT = (b"\0" + section(2, PROGRAM, (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\0" + bytes([STREAM_TYPE]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\0")).ljust(184, b"\xff")


def timestamp(kind: int, t: int) -> bytes:
    """A time of 33 bits in five bytes; ``kind``: 2 for a presentation time by itself."""
    return bytes([kind << 4 | t >> 29 & 14 | 1, t >> 22 & 255, t >> 14 & 254 | 1, t >> 7 & 255, t << 1 & 254 | 1])


def clock_field(t: int) -> bytes:
    return (t << 15 | 0x7E00).to_bytes(6, "big")


def write_stream(payload: bytes) -> bytes:
    """A payload, whose length 192 divides, as a transport stream."""
    out, tables, counter = [], 0, 0
    size, ticks = FRAME * FRAMES, FRAME * CLOCK // RATE
    for number, lo in enumerate(range(0, len(payload), size)):
        data = payload[lo : lo + size]
        t = (FIRST_PTS + number * FRAMES * ticks) % PTS_RANGE
        unit = b"\0\0\1" + bytes([STREAM_ID]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\5" + timestamp(2, t) + data
        extra = b""
        if number % POINTS == 0:
            for pid, table in ((PAT_PID, PAT), (PMT_PID, PMT)):
                out.append(bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10 | tables & 15]) + table)
            tables += 1
            extra = b"\x50" + clock_field((t - DELAY) % PTS_RANGE)  # random access, and the program clock
        at, start = 0, 0x40
        while at < len(unit):
            room = 184 - (len(extra) + 1 if extra else 0)
            own = unit[at : at + room]
            head = bytes([SYNC, start | STREAM_PID >> 8, STREAM_PID & 255])
            if not extra and len(own) == 184:
                out.append(head + bytes([0x10 | counter & 15]) + own)
            else:
                fill = room - len(own)
                if extra:
                    extra += b"\xff" * fill
                elif fill > 1:
                    extra = b"\0" + b"\xff" * (fill - 2)
                out.append(head + bytes([0x30 | counter & 15, len(extra)]) + extra + own)
            at, start, counter, extra = at + len(own), 0, counter + 1, b""
    return b"".join(out)


@dataclass
class Unit:
    """An elementary packet: where its first transport packet stands, whether it can be reached at random, whether all of it is there."""

    pid: int
    at: int
    random_access: bool
    data: bytearray = field(default_factory=bytearray)
    stream_id: int = 0
    pts: int | None = None
    dts: int | None = None
    whole: bool = True


class Reader:
    """Elementary packets of a stream, and what was found on the way."""

    def __init__(self) -> None:
        #: Program number to the identifier of its table; stream to program and type.
        self.programs: dict[int, int] = {}
        self.streams: dict[int, tuple[int, int]] = {}
        self.continuity_errors = self.lost_sync = self.bad_sections = self.cut_units = 0
        self._counters: dict[int, tuple[int, bytes]] = {}
        self._sections: dict[int, bytearray] = {}
        self._open: dict[int, Unit] = {}
        self._clock: dict[int, int] = {}

    def packets(self, data: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
        """Whole packets, from byte ``at``; after a byte that is no sync the next place with two of them is searched for."""
        n = len(data)
        while at + PACKET <= n:
            if data[at] == SYNC:
                yield at, data[at : at + PACKET]
                at += PACKET
                continue
            self.lost_sync += 1
            at += 1
            while at + PACKET <= n and not (data[at] == SYNC and (at + PACKET == n or at + PACKET < n and data[at + PACKET] == SYNC)):
                at += 1
        if at < n:
            self.lost_sync += 1

    def units(self, data: bytes, at: int = 0) -> Iterator[Unit]:
        """Elementary packets in the order in which they end; ``at``: where to begin, such as a random-access point."""
        for place, p in self.packets(data, at):
            pid = (p[1] & 31) << 8 | p[2]
            if pid == NULL_PID:
                continue
            if p[1] & 0x80:  # damaged, by the word of whoever received it
                self.continuity_errors += 1
                continue
            extra = p[4] if p[3] & 0x20 else -1
            flags = p[5] if extra > 0 else 0
            body = p[5 + extra :] if p[3] & 0x10 else b""
            if not p[3] & 0x10 or extra > 182:
                continue
            count = p[3] & 15
            before = self._counters.get(pid)
            self._counters[pid] = count, body
            if before is not None and not flags & 0x80:
                if before == (count, body):
                    continue  # a packet may be sent twice
                if count != before[0] + 1 & 15:
                    self.continuity_errors += 1
                    self._sections.pop(pid, None)
                    if pid in self._open:
                        self._open[pid].whole = False
            if pid in self.streams:
                yield from self._stream(pid, place, bool(p[1] & 0x40), bool(flags & 0x40), body)
            elif pid == PAT_PID or pid in self.programs.values():
                self._tables(pid, bool(p[1] & 0x40), body)
        for pid in list(self._open):
            yield from self._end(pid)

    def _stream(self, pid: int, place: int, start: bool, random_access: bool, body: bytes) -> Iterator[Unit]:
        if start:
            yield from self._end(pid)
            self._open[pid] = Unit(pid, place, random_access)
        unit = self._open.get(pid)
        if unit is None:  # the beginning is lost
            self.cut_units += start is False and pid in self._clock
            return
        unit.data += body
        if len(unit.data) >= 6 and (size := unit.data[4] << 8 | unit.data[5]) and len(unit.data) >= size + 6:
            del unit.data[size + 6 :]
            yield from self._end(pid)

    def _end(self, pid: int) -> Iterator[Unit]:
        unit = self._open.pop(pid, None)
        if unit is None:
            return
        d = unit.data
        if len(d) < 9 or d[:3] != b"\0\0\1":
            self.cut_units += 1
            return
        size = d[4] << 8 | d[5]
        unit.whole &= not size or len(d) == size + 6
        self.cut_units += not unit.whole
        unit.stream_id = d[3]
        flags, head = d[7] >> 6, d[8]
        if flags & 2 and len(d) >= 14:
            unit.pts = self._time(pid, d[9:14])
            unit.dts = self._time(pid, d[14:19]) if flags == 3 and len(d) >= 19 else None
        del d[: 9 + head]
        yield unit

    def _time(self, pid: int, b: bytes) -> int:
        """A time of 33 bits, carried on past its range: as near as can be to the last one of the stream."""
        t = (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1
        last = self._clock.get(pid, t)
        t += (last - t + PTS_RANGE // 2) // PTS_RANGE * PTS_RANGE
        self._clock[pid] = t
        return t

    def _tables(self, pid: int, start: bool, body: bytes) -> None:
        """Sections may begin anywhere in a packet and run over several."""
        if start and body:
            pointer = body[0]
            if pid in self._sections:
                self._sections[pid] += body[1 : 1 + pointer]
                self._take(pid)
            self._sections[pid] = bytearray(body[1 + pointer :])
        elif pid in self._sections:
            self._sections[pid] += body
        self._take(pid)

    def _take(self, pid: int) -> None:
        got = self._sections.get(pid, bytearray())
        while len(got) >= 3 and got[0] != 0xFF and len(got) >= (size := ((got[1] & 15) << 8 | got[2]) + 3):
            own = bytes(got[:size])
            del got[:size]
            if size < 12 or section_crc(own):
                self.bad_sections += 1
            elif own[0] == 0 and pid == PAT_PID:
                body = own[8:-4]
                entries = [(body[i] << 8 | body[i + 1], (body[i + 2] & 31) << 8 | body[i + 3]) for i in range(0, len(body) - 3, 4)]
                self.programs.update({n: p for n, p in entries if n})  # 0 names the network's table
            elif own[0] == 2:
                number, i, end = own[3] << 8 | own[4], 12 + ((own[10] & 15) << 8 | own[11]), len(own) - 4
                while i + 5 <= end:
                    self.streams[(own[i + 1] & 31) << 8 | own[i + 2]] = number, own[i]
                    i += 5 + ((own[i + 3] & 15) << 8 | own[i + 4])
        if got[:1] == b"\xff":
            got.clear()


# Columns --------------------------------------------------------------------------------------------------------

#: Bytes of streams a task has at once before it sends them on.
AT_ONCE = 4 << 20


def _each(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], weight: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes; ``weight``: the column that has them."""
    own, size = [], 0
    for r in rows:
        own.append(r)
        size += 64 + len(r[weight] or b"")
        if size >= AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own, strict=True), types, strict=True)], names=names)
            own, size = [], 0
    if own:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own, strict=True), types, strict=True)], names=names)


def _kind(df: DataFrame, id_col: str) -> tuple[str, pa.DataType]:
    kind = df.schema[id_col].dataType.simpleString()
    return kind, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def store_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``n_bytes`` of each text as UTF-8, and ``media``: a transport stream with these bytes, filled with blanks up to a positive multiple of 192.

    A null text counts as empty.  A text of any length is taken whole.  Equal texts give equal streams; rows that repeat
    an id and rows with a null id are rows like others.  An empty table gives no rows; other columns are ignored.
    """
    kind, arrow = _kind(df, id_col)

    def rows(batches):
        for b in batches:
            for i, text in zip(b.column(0), b.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                yield i.as_py(), len(raw), write_stream(raw.ljust(max(1, -(-len(raw) // FRAME)) * FRAME))

    def run(batches):
        return _each(rows(batches), [id_col, "n_bytes", "media"], [arrow, pa.int64(), pa.binary()], 2)

    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(tidy(run), f"`{id_col}` {kind}, n_bytes bigint, media binary")


def elementary_packets(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each elementary packet: the id, ``program``, ``stream_type``, ``pid``, ``number`` (in its stream, from 0), ``pts``, ``dts``, ``random_access``, ``at`` (byte of the stream where it begins), ``whole``, ``data``.

    A null, empty or damaged stream gives the packets that can be found in it, maybe none.
    """
    kind, arrow = _kind(df, id_col)
    names = [id_col, "program", "stream_type", "pid", "number", "pts", "dts", "random_access", "at", "whole", "data"]
    types = [arrow, *[pa.int32()] * 3, *[pa.int64()] * 3, pa.bool_(), pa.int64(), pa.bool_(), pa.binary()]

    def rows(batches):
        for b in batches:
            for i, media in zip(b.column(0), b.column(1), strict=True):
                reader, numbers = Reader(), {}
                for u in reader.units(media.as_py() or b""):
                    n = numbers[u.pid] = numbers.get(u.pid, -1) + 1
                    yield i.as_py(), *reader.streams[u.pid], u.pid, n, u.pts, u.dts, u.random_access, u.at, u.whole, bytes(u.data)

    ddl = f"`{id_col}` {kind}, program int, stream_type int, pid int, number bigint, pts bigint, dts bigint, random_access boolean, at bigint, whole boolean, data binary"
    return df.select(id_col, media_col).mapInArrow(tidy(lambda batches: _each(rows(batches), names, types, 10)), ddl)


POINT = "struct<pid:int,pts:bigint,at:bigint,first:bigint>"
STREAM = "struct<program:int,pid:int,stream_type:int,packets:bigint,first_pts:bigint,last_pts:bigint>"


def read_media(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", from_pts: int | None = None) -> DataFrame:
    """A row for each stream: the id, ``payload``, ``streams``, ``points``, ``continuity_errors``, ``lost_sync``, ``bad_sections``, ``cut_units``.

    ``payload``: the data of whole and cut elementary packets of all streams, in their order.  ``streams``: what the program tables
    list, with the number of elementary packets and the first and last presentation time.  ``points``: random-access
    points, with the byte of the stream to begin at and the first byte of the payload that is reached from there.
    ``from_pts``: read on from the last point whose time is not after it, on the first stream that has points; the tables
    in front of a point are found there, too.  A null or empty stream has no payload and no points.
    """
    kind, arrow = _kind(df, id_col)
    streams_type = pa.list_(pa.struct([("program", pa.int32()), ("pid", pa.int32()), ("stream_type", pa.int32()), ("packets", pa.int64()), ("first_pts", pa.int64()), ("last_pts", pa.int64())]))
    points_type = pa.list_(pa.struct([("pid", pa.int32()), ("pts", pa.int64()), ("at", pa.int64()), ("first", pa.int64())]))
    counts = ["continuity_errors", "lost_sync", "bad_sections", "cut_units"]

    def read(media: bytes, at: int) -> tuple:
        reader, payload, points, seen = Reader(), bytearray(), [], {}
        for u in reader.units(media, at):
            if u.random_access:
                points.append({"pid": u.pid, "pts": u.pts, "at": u.at, "first": len(payload)})
            n, first, last = seen.get(u.pid, (0, u.pts, u.pts))
            seen[u.pid] = n + 1, first if first is not None else u.pts, u.pts if u.pts is not None else last
            payload += u.data
        streams = [
            dict(zip(("program", "pid", "stream_type", "packets", "first_pts", "last_pts"), (program, pid, type_, *seen.get(pid, (0, None, None))), strict=True))
            for pid, (program, type_) in sorted(reader.streams.items())
        ]
        return bytes(payload), streams, points, *(getattr(reader, c) for c in counts)

    def one(media: bytes) -> tuple:
        found = read(media, 0)
        if from_pts is None or not found[2]:
            return found
        pid = found[2][0]["pid"]
        before = [p for p in found[2] if p["pid"] == pid and p["pts"] is not None and p["pts"] <= from_pts]
        if not before:
            return found
        # The tables stand in the packets just in front of the point.
        return read(media, max(0, before[-1]["at"] - 2 * PACKET))

    def rows(batches):
        for b in batches:
            for i, media in zip(b.column(0), b.column(1), strict=True):
                yield i.as_py(), *one(media.as_py() or b"")

    types = [arrow, pa.binary(), streams_type, points_type, *[pa.int64()] * 4]
    ddl = f"`{id_col}` {kind}, payload binary, streams array<{STREAM}>, points array<{POINT}>, " + ", ".join(f"{c} bigint" for c in counts)
    return df.select(id_col, media_col).mapInArrow(tidy(lambda batches: _each(rows(batches), [id_col, "payload", "streams", "points", *counts], types, 1)), ddl)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored and read back, as digests: what went in, the stored form, what came out, and a line on the stream.

    Rows are as in :func:`store_media`; a row is stored and read in one task, so nothing is joined.
    """
    kind, arrow = _kind(df, id_col)
    stored = store_media(df, id_col, text_col)
    # What is known of the stored form goes along with it as one column.
    key = F.struct(F.col(id_col).alias("id"), "n_bytes", F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"))
    named = stored.select(F.to_json(key, {"ignoreNullFields": "false"}).alias("key"), "media")
    back = read_media(named, "key", "media")
    known = F.from_json("key", f"id {kind}, n_bytes bigint, media_bytes bigint, media_sha256 string")
    s = F.element_at("streams", 1)
    feature = F.format_string(
        "program=%d pid=%d type=%d packets=%d pts=%d-%d points=%d continuity_errors=%d damage=%d",
        s["program"], s["pid"], s["stream_type"], s["packets"], s["first_pts"], s["last_pts"], F.size("points"), F.col("continuity_errors"), F.col("lost_sync") + F.col("bad_sections") + F.col("cut_units"),
    )
    return back.withColumn("known", known).select(
        F.col("known.id").alias(id_col), "known.n_bytes", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16)")).alias("tail_crc32"), "known.media_bytes", "known.media_sha256", feature.alias("feature"),
    )
