"""Media columns: bytes as MPEG-2 transport streams (ISO/IEC 13818-1), written and parsed with numpy over whole streams.

A payload is cut into access units of ``UNIT`` bytes. Each unit is one packetized elementary stream (PES) packet with a
presentation time, split over 188-byte transport packets, of which the first has the program's clock; every ``EVERY``-th unit
is a random-access point. Program association and map tables stand first. Reading parses the tables, checks the
continuity counters of each PID (a packet may come twice, and a flagged jump is allowed), reassembles the PES packets and
returns payload, timestamps and random-access points.

Odd input: a null text is an empty one; an empty payload is one unit of padding; repeated rows give equal streams; an
empty table gives an empty table. A damaged stream (lost sync, gap in a counter, bad table CRC) raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import map_texts

PACKET, SYNC, PAT_PID, PMT_PID, ES_PID = 188, 0x47, 0, 0x1000, 0x0100
#: Bytes to which payloads are filled up, of an access unit (48 of those), ticks of 90 kHz between units, units between random-access points.
ALIGN, UNIT, TICKS, EVERY = 192, 9216, 3600, 8
#: Bytes of an adaptation field with a clock.
CLOCK = 8
#: stream_type of private data in PES packets, and stream_id of a private stream with an optional header.
STREAM_TYPE, STREAM_ID = 0x06, 0xBD


def _crc_table() -> list[int]:
    out = []
    for k in range(256):
        c = k << 24
        for _ in range(8):
            c = (c << 1 ^ (0x04C11DB7 if c & 1 << 31 else 0)) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def mpeg_crc(data: bytes) -> int:
    """CRC-32 of sections: polynomial 04C11DB7, not reflected, all ones at first. 0 over a section with its CRC."""
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, extension: int, body: bytes) -> bytes:
    head = bytes([table_id, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 255, extension >> 8, extension & 255, 0xC1, 0, 0]) + body
    return head + mpeg_crc(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    return (bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section).ljust(PACKET, b"\xff")


TABLES = _table_packet(PAT_PID, _section(0, 1, bytes([0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 255]))) + _table_packet(
    PMT_PID, _section(2, 1, bytes([0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0, STREAM_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 255, 0xF0, 0]))
)


def pes_header(length: int, pts: int) -> bytes:
    """Header of a PES packet of ``length`` payload bytes with a presentation time (33 bits, 90 kHz)."""
    stamp = bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 255, pts >> 14 & 0xFE | 1, pts >> 7 & 255, pts << 1 & 0xFE | 1])
    return b"\0\0\1" + bytes([STREAM_ID]) + (length + 8).to_bytes(2, "big") + b"\x84\x80\x05" + stamp


def clock(ticks: int) -> bytes:
    """Program clock reference: 33 bits of 90 kHz, six reserved, and nine of 27 MHz, which are 0."""
    base = ticks & (1 << 33) - 1
    return bytes([base >> 25, base >> 17 & 255, base >> 9 & 255, base >> 1 & 255, (base & 1) << 7 | 0x7E, 0])


def mux(payload: bytes) -> bytes:
    """Transport stream of one program with one private elementary stream that carries ``payload``."""
    out, counter = [TABLES], 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        unit = payload[at : at + UNIT]
        pes = pes_header(len(unit), k * TICKS & (1 << 33) - 1) + unit
        key = k % EVERY == 0
        # the first packet has an adaptation field with flags and a clock; the last one is stuffed
        first = 184 - CLOCK
        n = 1 + max(0, -(-(len(pes) - first) // 184))
        room = n * 184 - CLOCK - len(pes)
        packets = np.zeros((n, PACKET), np.uint8)
        packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, ES_PID >> 8, ES_PID & 255
        packets[0, 1] |= 0x40
        packets[:, 3] = 0x10 | (np.arange(counter, counter + n) & 15).astype(np.uint8)
        counter += n
        body = packets[:, 4:]
        body[:] = 0xFF
        data = np.frombuffer(pes, np.uint8)
        used = np.zeros(n, np.int64)  # bytes of adaptation field
        used[0] += CLOCK
        used[-1] += room
        if n > 2:
            head = 184 - used[0]
            middle = data[head : head + (n - 2) * 184]
            body[0, used[0] :] = data[:head]
            body[1:-1] = middle.reshape(n - 2, 184)
            body[-1, used[-1] :] = data[head + len(middle) :]
        elif n == 2:
            head = 184 - used[0]
            body[0, used[0] :] = data[:head]
            body[1, used[1] :] = data[head:]
        else:
            body[0, used[0] :] = data
        for row in {0, n - 1}:
            if used[row]:
                packets[row, 3] |= 0x20
                body[row, 0] = used[row] - 1
                if row == 0:
                    body[row, 1] = 0x50 if key else 0x10
                    body[row, 2:CLOCK] = np.frombuffer(clock(k * TICKS), np.uint8)
                elif used[row] > 1:
                    body[row, 1] = 0
        out.append(packets.tobytes())
    return b"".join(out)


def _tables(packets: np.ndarray, pids: np.ndarray) -> list[int]:
    """PIDs of the elementary streams: association table, then the map table of each program."""

    def section(pid: int) -> bytes:
        rows = np.flatnonzero((pids == pid) & (packets[:, 1] & 0x40 != 0))
        if not len(rows):
            raise ValueError(f"no table on PID {pid}")
        p = packets[rows[0]].tobytes()
        at = 4 + (1 + p[4] if p[3] & 0x20 else 0)
        at += 1 + p[at]
        whole = p[at : at + 3 + ((p[at + 1] & 15) << 8 | p[at + 2])]
        if mpeg_crc(whole):
            raise ValueError(f"bad CRC on PID {pid}")
        return whole

    pat, found = section(PAT_PID), []
    for k in range(8, len(pat) - 4, 4):
        if pat[k] << 8 | pat[k + 1]:
            pmt = section((pat[k + 2] & 31) << 8 | pat[k + 3])
            at = 12 + ((pmt[10] & 15) << 8 | pmt[11])
            while at < len(pmt) - 4:
                found.append((pmt[at + 1] & 31) << 8 | pmt[at + 2])
                at += 5 + ((pmt[at + 3] & 15) << 8 | pmt[at + 4])
    return found


def demux(media: bytes) -> tuple[bytes, list[int], list[int]]:
    """(payload, presentation time of each unit, byte offset in the stream of each random-access point)."""
    if len(media) % PACKET:
        raise ValueError("not a whole number of packets")
    packets = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
    if not (packets[:, 0] == SYNC).all():
        raise ValueError("sync lost")
    pids = (packets[:, 1].astype(np.int64) & 31) << 8 | packets[:, 2]
    if (packets[:, 1] & 0x80).any():
        raise ValueError("transport error")
    payload, stamps, points = [], [], []
    for pid in _tables(packets, pids):
        rows = np.flatnonzero(pids == pid)
        own = packets[rows]
        # a packet may come twice, once repeated; a flag of the adaptation field allows a jump
        same = np.append(False, (own[1:] == own[:-1]).all(axis=1)) if len(own) else np.zeros(0, bool)
        if (same[1:] & same[:-1]).any():
            raise ValueError(f"continuity broken on PID {pid}")
        rows, own = rows[~same], own[~same]
        counters = own[:, 3] & 15
        allowed = (own[:, 3] & 0x20 != 0) & (own[:, 4] > 0) & (own[:, 5] & 0x80 != 0)
        if (((counters[1:] - counters[:-1]) & 15 != 1) & ~allowed[1:]).any():
            raise ValueError(f"continuity broken on PID {pid}")
        field = np.where(own[:, 3] & 0x20, 1 + own[:, 4].astype(np.int64), 0)
        flags = np.where(field > 1, own[:, 5], 0)
        points += (rows[flags & 0x40 != 0] * PACKET).tolist()
        keep = np.arange(184)[None, :] >= field[:, None]
        stream = own[:, 4:][keep].tobytes()
        starts = np.concatenate([[0], np.cumsum(184 - field)])[:-1][own[:, 1] & 0x40 != 0].tolist()
        for a, b in zip(starts, [*starts[1:], len(stream)]):
            if stream[a : a + 3] != b"\0\0\1":
                raise ValueError("no PES start code")
            length, head = int.from_bytes(stream[a + 4 : a + 6], "big"), 9 + stream[a + 8]
            if length and a + 6 + length != b:
                raise ValueError("PES packet cut short")
            if stream[a + 7] & 0x80:
                t = stream[a + 9 : a + 14]
                stamps.append((t[0] & 14) << 29 | t[1] << 22 | (t[2] & 254) << 14 | t[3] << 7 | t[4] >> 1)
            payload.append(stream[a + head : b])
    return b"".join(payload), stamps, points


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(1, -(-len(raw) // ALIGN)) * ALIGN, b" ")


def store(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text as a transport stream."""

    def run(_, texts, ids):
        raw = [padded(t) for t in texts]
        return {"doc_id": ids, "n_bytes": [n for n, _ in raw], "media": [mux(p) for _, p in raw]}

    return map_texts(documents, [F.col(f"`{text_col}`"), F.col(f"`{id_col}`")], run, "doc_id long, n_bytes long, media binary")


def features(stored: DataFrame) -> DataFrame:
    """Reads the streams of :func:`store` back: payload, timestamps and random-access points with digests of them."""

    def run(_, media, ids, lengths):
        out = {k: [] for k in ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "timestamps", "random_access")}
        for m, i, n in zip(media, ids, lengths):
            payload, stamps, points = demux(m)
            feature = f"packets={len(m) // PACKET};units={len(stamps)};last_pts={stamps[-1]};points={len(points)};index={zlib.crc32(repr((stamps, points)).encode())}"
            for k, v in zip(out, (i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature, stamps, points)):
                out[k].append(v)
        return out

    return map_texts(stored, [F.col("media"), F.col("doc_id"), F.col("n_bytes")], run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, timestamps array<long>, random_access array<long>")


def query(spark, sf_dir):
    return features(store(spark.read.parquet(f"{sf_dir}/documents.parquet"))).drop("timestamps", "random_access")
