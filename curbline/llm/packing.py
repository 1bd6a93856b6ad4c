"""Harmonic packing of token sequences.

A sequence holds ``capacity`` tokens. A document that fits into one belongs to the reciprocal-capacity class k of its
length: more than ``capacity / (k + 1)`` tokens, at most ``capacity / k``; each bin of class k takes exactly k whole documents. What
a full bin has left is filled with tokens cut from fillers: rests of documents that are longer than a sequence (these first
fill whole sequences), or, where more than ``KEPT`` bins wait for one, a short document. Workers (tasks) fill their own
bins, without a shuffle: no group of rows ever meets anywhere, so one source or a hot group can't skew it. What a worker
has left at its end is cut into full sequences and then into sequences whose lengths are powers of two, which need no
padding.

Odd input: null text is empty; an empty document has one token (the separator); a null id stays null; repeated rows are
packed each; an empty table gives an empty table; other columns don't matter. A worker keeps the token ids of its open
and waiting bins (under a hundred sequences of documents, and ``KEPT`` bins and fillers), and one long text's.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from curbline.llm.common import slices, small_batches
from curbline.llm.tokens import byte_bpe

CAPACITY, SEPARATOR = 1024, 0
#: Full bins that wait for a filler, and fillers that wait for a bin.
KEPT = 64
#: Of a sequence's id, the bits for its number within its worker.
LOCAL_BITS = 36


class Packer:
    """Bins of one worker. ``add`` returns nothing; ``rows`` collects what is placed: (item, start, length, sequence, offset)."""

    def __init__(self, worker: int, capacity: int = CAPACITY):
        self.capacity, self.next, self.open, self.rows = capacity, worker << LOCAL_BITS, {}, []
        self.waiting: deque[tuple[list, int]] = deque()
        self.fillers: deque[tuple] = deque()

    def _sequence(self, pieces: Iterable[tuple]) -> None:
        offset, sequence = 0, self.next
        self.next += 1
        for item, start, n in pieces:
            self.rows.append((item, start, n, sequence, offset))
            offset += n

    def add(self, item, length: int) -> None:
        start = length // self.capacity * self.capacity
        for a in range(0, start, self.capacity):
            self._sequence([(item, a, self.capacity)])
        if length > start:
            piece = (item, start, length - start)
            if start:
                self.fillers.append(piece)
            else:
                self._file(piece)
        self._fill()
        if len(self.fillers) > KEPT:
            self._file(self.fillers.popleft())
            self._fill()

    def _file(self, piece: tuple) -> None:
        """Puts a piece whole into the bin of its class."""
        k = self.capacity // piece[2]
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            del self.open[k]
            room = self.capacity - sum(n for _, _, n in bin_)
            if room:
                self.waiting.append((bin_, room))
            else:
                self._sequence(bin_)

    def _fill(self) -> None:
        while self.waiting and (self.fillers or len(self.waiting) > KEPT and self.open):
            if not self.fillers:
                k = max(self.open, key=lambda k: len(self.open[k]))
                self.fillers.append(self.open[k].pop())
                if not self.open[k]:
                    del self.open[k]
            (pieces, room), (item, start, n) = self.waiting.popleft(), self.fillers.popleft()
            take = min(room, n)
            pieces.append((item, start, take))
            if take < n:
                self.fillers.appendleft((item, start + take, n - take))
            if take < room:
                self.waiting.appendleft((pieces, room - take))
            else:
                self._sequence(pieces)

    def close(self) -> None:
        """What is left, longest pieces first, in full sequences and then in powers of two."""
        left = [*self.fillers, *[p for pieces, _ in self.waiting for p in pieces], *[p for pieces in self.open.values() for p in pieces]]
        left.sort(key=lambda p: -p[2])
        self.open, self.waiting, self.fillers = {}, deque(), deque()
        total = sum(n for _, _, n in left)
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in range(self.capacity.bit_length() - 1, -1, -1) if total % self.capacity >> b & 1]
        k = used = 0
        for size in sizes:
            pieces = []
            while size:
                item, start, n = left[k]
                take = min(size, n - used)
                pieces.append((item, start + used, take))
                size -= take
                used += take
                if used == n:
                    k, used = k + 1, 0
            self._sequence(pieces)


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ``ids`` little-endian uint32."""
    from public_tokenizers import path

    return _packed(documents, id_col, text_col, tokenizer or path("byte_bpe_50k.json"), capacity, False)


def _packed(documents: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, digest: bool) -> DataFrame:
    small_batches(documents.sparkSession)
    schema = "doc_id long, start long, length long, " + ("ids_crc32 long" if digest else "ids binary") + ", doc_tokens long, sequence_id long, offset long"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        from pyspark import TaskContext

        encode, packer = byte_bpe(tokenizer), Packer(TaskContext.get().partitionId(), capacity)
        end = SEPARATOR.to_bytes(4, "little")

        def drain():
            rows, packer.rows = packer.rows, []
            out = [[] for _ in arrow]
            for (doc, ids), start, n, sequence, offset in rows:
                part = memoryview(ids)[4 * start : 4 * (start + n)]
                for column, v in zip(out, (doc, start, n, zlib.crc32(part) if digest else bytes(part), len(ids) // 4, sequence, offset)):
                    column.append(v)
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow)], schema=arrow)

        for batch in batches:
            for a, b in slices(batch.column(0)):
                part = batch.slice(a, b - a)
                for doc, text in zip(part.column(1).to_pylist(), part.column(0).to_pylist()):
                    ids = encode(text or "") + end
                    packer.add((doc, ids), len(ids) // 4)
                yield drain()
        packer.close()
        yield drain()

    return documents.select(F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("long")).mapInArrow(run, schema)


def query(spark, sf_dir):
    from public_tokenizers import path

    return _packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", path("byte_bpe_50k.json"), CAPACITY, True)
