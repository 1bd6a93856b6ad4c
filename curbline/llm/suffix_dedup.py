"""Removal of passages that occur more than once, by depth-limited radix sort of suffixes.

Every byte covered by a ``length``-byte window that also starts anywhere else is removed. Hashes only route: which
windows are repeated is decided on their bytes.

1. Each window is filed under an anchor: the place in it whose ``length // 2``-gram has the smallest hash. Equal windows
   have their anchor at the same place, and neighbouring windows share theirs. Each chunk of texts files the hashes of its
   anchors' grams; a gram that occurs once in the corpus proves that its windows are unique.
2. Of the other grams each chunk sends its distinct stretches (the bytes that an anchor's windows cover) to their gram. Grams
   with ``HOT`` occurrences are split: windows at a like distance from the anchor have all but a few bytes in common,
   and are sent to these; beyond ``HOTTEST`` occurrences to all their bytes, so that no place gathers unlike windows
   without bound.
3. There equal stretches are merged byte by byte, and all suffixes that begin a window are ordered by
   most-significant-digit passes of eight bytes through the threshold; after each pass groups of one leave. Groups left
   at the threshold, and the windows of merged stretches, are exactly the repeated windows.
4. Each chunk gets its repeated windows back by place, and bytes under them go.

Odd input: null text is empty; texts shorter than the threshold keep all; matches never cross texts; repeated rows are
occurrences of their own, so copies of a long text lose everything; null ids stay null; an empty table gives an empty
table; columns of any name can be carried. A worker holds a chunk (2 MiB of text or one longer text, some ten times its bytes)
and works on blocks of ``BLOCK`` bytes, which overlap by a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import dropped, written
from curbline.llm.exchange import chunked, per_chunk, unpack

LENGTH = 200
#: Occurrences of a gram from which its windows are split by distance and bytes in common, and from which by all their bytes.
HOT, HOTTEST = 512, 1 << 17
#: Windows that are filed at a time, and that are ordered at a time.
BLOCK, SLICE = 1 << 19, 200_000
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xC2B2AE3D27D4EB4F)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Roller:
    """Hashes of the grams of a block, from running sums of byte codes times powers of an odd base, modulo 2**64."""

    def __init__(self, gram: int):
        self.gram, self.codes = gram, mixed(np.arange(1, 257, dtype=np.uint64))
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.up) < n:
            self.up, self.down = (_powers(b, n) for b in (_BASE, _INVERSE))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.codes[data] * self.up[: n - 1], out=self.sums[1:])

    def every(self) -> np.ndarray:
        return mixed((self.sums[self.gram :] - self.sums[: -self.gram]) * self.down[: len(self.sums) - self.gram] + np.uint64(self.gram))

    def at(self, begin: np.ndarray) -> np.ndarray:
        return mixed((self.sums[begin + self.gram] - self.sums[begin]) * self.down[begin] + np.uint64(self.gram))


def _block_anchors(roller: Roller, data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor) of each anchor of the valid windows of a block."""
    roller.load(data)
    grams = roller.every()
    width = length - roller.gram + 1
    bits = np.uint64(22)
    key = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)  # ties go to the place further left
    whole = -(-len(key) // width) * width
    key = np.concatenate([key, np.full(whole - len(key), 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(valid)
    at = np.flatnonzero(valid)
    anchor = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
    return at[new], last, anchor[new]


def _blocks(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    for a in range(0, len(data) - length + 1, BLOCK):
        yield a, data[a : a + BLOCK + length - 1]


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, first window, last window, anchor) of each anchor, in order of place."""
    roller, begins = Roller(length // 2), np.concatenate([[0], ends[:-1]])
    out = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    for a, part in _blocks(data, length):
        windows = len(part) - length + 1
        lo, hi = np.clip(begins - a, 0, windows), np.clip(ends - length + 1 - a, 0, windows)  # windows that lie within one text
        some = hi > lo
        turn = np.zeros(windows + 1, np.int64)
        np.add.at(turn, lo[some], 1)
        np.add.at(turn, hi[some], -1)
        first, last, anchor = _block_anchors(roller, part, np.cumsum(turn[:-1]) > 0, length)
        out.append((roller.at(anchor), first + a, last + a, anchor + a))
    return tuple(np.concatenate(x) for x in zip(*out))


def _stored(first: np.ndarray, last: np.ndarray, anchor: np.ndarray) -> bytes:
    body = np.diff(first, prepend=0).astype("<u4").tobytes() + (last - first).astype("<u2").tobytes() + (anchor - first).astype("<u2").tobytes()
    return len(first).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def _restored(extra: bytes, data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    n, body = int.from_bytes(extra[:8], "little"), unpack(extra[8:])
    first = np.cumsum(np.frombuffer(body, "<u4", n).astype(np.int64))
    last = first + np.frombuffer(body, "<u2", n, 4 * n)
    anchor = first + np.frombuffer(body, "<u2", n, 6 * n)
    roller, h = Roller(length // 2), np.zeros(n, np.uint64)
    for a, part in _blocks(data, length):
        lo, hi = np.searchsorted(first, [a, a + BLOCK])
        roller.load(part)
        h[lo:hi] = roller.at(anchor[lo:hi] - a)
    return h, first, last, anchor


def repeated_windows(text: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes of ``text`` from ``starts`` equal another of their group through ``length`` bytes.

    Most-significant-digit radix passes of eight bytes; a pass only looks at suffixes that still have company."""
    out = np.zeros(len(starts), bool)
    live = np.arange(len(starts))
    group = groups.astype(np.int64)
    for depth in range(0, length, 8):
        at, digit = starts[live] + depth, np.zeros(len(live), np.uint64)
        for k in range(min(8, length - depth)):
            digit = digit << np.uint64(8) | text[at + k]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.ones(len(order), bool)
        new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
        number = np.cumsum(new) - 1
        company = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
        live, group = live[order][company], number[company]
        if not len(live):
            break
    out[live] = True
    return out


def stretches(data: bytes, h, first, last, anchor, level, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(key, distance of the first window to the anchor, begin, end) of what is sent for each anchor, by the gram's heat."""
    step = max(1, length // 20)
    for g, a, b, c, heat in zip(h.tolist(), first.tolist(), last.tolist(), anchor.tolist(), level.tolist()):
        if not heat:
            yield g, c - a, a, b + length
            continue
        wide = 1 if heat > 1 else step
        for far in range((c - b) // wide * wide, c - a + 1, wide):
            lo, hi = max(a, c - far - wide + 1), min(b, c - far)
            # what all windows at these distances have in common
            yield xxhash.xxh64_intdigest(data[c - far : c - far + length - wide + 1], seed=(g + far) & (1 << 64) - 1), c - lo, lo, hi + length


def compare(keys: list[int], before: list[int], many: list[int], data: list[bytes], length: int) -> list[np.ndarray]:
    """For each stretch, which of its windows are repeated; stretches of one key are compared."""
    number: dict[tuple, int] = {}
    of = [number.setdefault(x, len(number)) for x in zip(keys, before, data)]  # equal stretches are one, by their bytes
    total = np.bincount(of, many, len(number)) > 1
    size = np.array([len(d) for _, _, d in number], np.int64)
    key_number: dict[int, int] = {}
    group = np.array([key_number.setdefault(k, len(key_number)) for k, _, _ in number], np.int64)
    windows = size - length + 1
    found = [np.ones(n, bool) if t else np.zeros(n, bool) for n, t in zip(windows.tolist(), total)]
    unlike = np.flatnonzero(np.bincount(group)[group] > 1)
    if len(unlike):
        every = list(number)
        text = np.frombuffer(b"".join(every[k][2] for k in unlike), np.uint8)
        begin = np.cumsum(size[unlike]) - size[unlike]
        n = windows[unlike]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        far = np.array([every[k][1] for k in unlike], np.int64)
        # equal windows lie at one distance from their anchor
        met = repeated_windows(text, np.repeat(begin, n) + inside, np.repeat(group[unlike] * (1 << 32) + far, n) - inside, length)
        for k, part in zip(unlike.tolist(), np.split(met, np.cumsum(n)[:-1])):
            found[k] |= part
    return [found[k] for k in of]


FILED = "gram long, chunk long, times int"
SENT = "key long, chunk long, before int, many int, places binary, data binary"


def _marked(documents: DataFrame, id_col: str, text_col: str, length: int, carry: bool):
    """(chunks, repeated windows by chunk: places and bits)."""

    def file(ends, data):
        return _stored(*anchors(np.frombuffer(data, np.uint8), ends, length)[1:])

    chunks = chunked(documents, id_col, text_col, extra=file, carry=carry)

    def grams(c):
        gram, times = np.unique(_restored(c.extra, np.frombuffer(c.data, np.uint8), length)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(np.full(len(gram), c.number)), pa.array(np.minimum(times, 1 << 20).astype(np.int32))], names=["gram", "chunk", "times"])

    total = F.sum("times").over(Window.partitionBy("gram"))
    met = per_chunk(chunks, grams, FILED).withColumn("total", total).where("total > 1")
    heat = F.when(F.col("total") >= HOTTEST, 2).when(F.col("total") >= HOT, 1).otherwise(0)
    met = written(met.select("chunk", "gram", heat.alias("heat")), "passage-grams")

    def send(c):
        if c.answers is None:
            return
        known, heat = c.answers.field("gram").to_numpy(zero_copy_only=False).view(np.uint64), c.answers.field("heat").to_numpy(zero_copy_only=False)
        order = np.argsort(known)
        known, heat = known[order], heat[order]
        h, first, last, anchor = _restored(c.extra, np.frombuffer(c.data, np.uint8), length)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        use = np.flatnonzero(known[at] == h)
        places: dict[tuple, list[int]] = {}
        for key, before, a, b in stretches(c.data, h[use], first[use], last[use], anchor[use], heat[at[use]], length):
            places.setdefault((key, before, c.data[a:b]), []).append(a)
        items = list(places.items())
        for k in range(0, len(items), 8192):
            part = items[k : k + 8192]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([x[0] for x, _ in part], np.uint64).view(np.int64)), pa.array(np.full(len(part), c.number)), pa.array([x[1] for x, _ in part], pa.int32()), pa.array([min(2, len(p)) for _, p in part], pa.int32()),
                    pa.array([np.array(p, "<u4").tobytes() for _, p in part], pa.binary()), pa.array([x[2] for x, _ in part], pa.binary()),
                ],
                names=["key", "chunk", "before", "many", "places", "data"],
            )

    sent = per_chunk(chunks, send, SENT, met)

    def order(batches):
        held, windows = [], 0

        def answers():
            keys, number, before, many, places, data = zip(*held)
            found = compare(keys, before, many, data, length)
            some = [k for k, f in enumerate(found) if f.any()]
            return pa.RecordBatch.from_arrays([pa.array([number[k] for k in some], pa.int64()), pa.array([places[k] for k in some], pa.binary()), pa.array([len(found[k]) for k in some], pa.int32()), pa.array([np.packbits(found[k]).tobytes() for k in some], pa.binary())], names=["chunk", "places", "windows", "bits"])

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if windows >= SLICE and held[-1][0] != row[0]:
                    yield answers()
                    held, windows = [], 0
                held.append(row)
                windows += len(row[5]) - length + 1
        if held:
            yield answers()

    found = written(sent.repartition("key").sortWithinPartitions("key").mapInArrow(order, "chunk long, places binary, windows int, bits binary"), "passages")
    dropped(met)
    return chunks, found


def _gone(c, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Removed runs of a chunk's bytes: where each begins and ends."""
    starts = np.zeros(len(c.data) + 1, bool)
    if c.answers is not None:
        for places, n, bits in zip(*[c.answers.field(x).to_pylist() for x in ("places", "windows", "bits")]):
            found = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
            for a in np.frombuffer(places, "<u4").tolist():
                starts[a : a + n] |= found
    turn = np.flatnonzero(np.diff(starts, prepend=False))
    lo, hi = turn[::2], turn[1::2] - 1 + length  # runs of windows, in order: their bytes overlap or touch if the next begins by the end
    apart = lo[1:] > hi[:-1]
    return lo[np.append(True, apart)] if len(lo) else lo, hi[np.append(apart, True)] if len(hi) else hi


def _kept(c, length: int) -> Iterator[tuple[int | None, int, int, bytes]]:
    """(id, bytes, removed runs, what is left) of each text."""
    lo, hi = _gone(c, length)
    a = 0
    for id_, b in zip(c.ids, c.ends.tolist()):
        # a run of windows ends within its text, but bytes of two texts may touch
        k, m = np.searchsorted(hi, a, "right"), np.searchsorted(lo, b)
        begin, end = np.maximum(lo[k:m], a), np.minimum(hi[k:m], b)
        edges = [a, *np.stack([begin, end], 1).ravel().tolist(), b]
        yield id_, b - a, len(begin), b"".join(c.data[x:y] for x, y in zip(edges[::2], edges[1::2]))
        a = b


def removals(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    chunks, windows = _marked(documents, id_col, text_col, length, False)

    def mark(c):
        rows = [(id_, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()) for id_, n, spans, kept in _kept(c, length)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return per_chunk(chunks, mark, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", windows)


def kept_texts(documents: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``documents`` with what is left of each text, and all other columns; rows that lose everything stay, with an empty text.

    What is left of UTF-8 can be cut within a character; bytes of such a character are left out of the text. A null text becomes empty."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = documents.columns
    renamed = documents.toDF(*[f"c{k}" for k in range(len(names))])
    at = names.index(text_col)
    chunks, windows = _marked(renamed.withColumn("none", F.lit(None).cast("long")), "none", f"c{at}", length, True)
    schema = to_arrow_schema(renamed.schema)

    def mark(c):
        rest = pa.ipc.open_stream(c.carried).read_all()
        texts = pa.array([kept.decode(errors="ignore") for *_, kept in _kept(c, length)], pa.string())
        columns = [texts if k == at else rest.column(f"c{k}").combine_chunks() for k in range(len(names))]
        yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, schema)], schema=schema)

    return per_chunk(chunks, mark, renamed.schema, windows, carried=True).toDF(*names)


def query(spark, sf_dir):
    return removals(spark.read.parquet(f"{sf_dir}/documents.parquet"))
