"""Questions from chunks of texts to shards of keys, and answers back.

A chunk packs the texts of some rows into one compressed value; chunks are written once, so their numbers stay true when
executors are lost. What a chunk learns from the whole corpus comes back to it by an equi-join on its number, for which
chunks lie in buckets and are not moved again. A chunk
asks about each of its distinct keys once, so a hot key counts once per chunk, whatever its rows. Nothing about keys
reaches the driver.

Questions are rows of any table, or, where numpy packs them much smaller, messages: a chunk sends each shard of keys one
blob, and a shard answers each blob in its order. Messages number chunks times shards, as the blocks of a shuffle do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbline.llm.common import bucketed, small_batches

#: Text bytes of a chunk (a longer text is a chunk of its own), and rows of it at most.
CHUNK_BYTES, CHUNK_ROWS = 2 << 20, 1 << 16
CHUNK = "chunk long, ids array<long>, ends array<long>, data binary, extra binary, carried binary"
MESSAGE = "shard long, chunk long, blob binary"


@dataclass
class Chunk:
    """Ids and ends of its texts, their bytes, what was made of them when they were packed, and answers (a struct array, or None)."""

    number: int
    ids: list
    ends: np.ndarray
    data: bytes
    extra: bytes | None
    carried: bytes | None
    answers: pa.StructArray | None


def _murmur(number: int, seed: int = 42) -> int:
    """Spark's hash of a long, by which buckets are dealt."""

    def turn(x, n):
        return (x << n | x >> 32 - n) & 0xFFFFFFFF

    h = seed
    for part in (number & 0xFFFFFFFF, number >> 32 & 0xFFFFFFFF):
        k = turn(part * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = turn(h ^ k, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (h >> 31 << 32)


def buckets_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def chunk_numbers(task: int, buckets: int) -> Iterator[int]:
    """Numbers of a task's chunks, chosen so that chunks come to the buckets in turn."""
    number, slot = task << 36, task
    while True:
        while _murmur(number) % buckets != slot % buckets:
            number += 1
        yield number
        number, slot = number + 1, slot + 1


def chunked(documents: DataFrame, id_col: str, text_col: str, target: int = CHUNK_BYTES, extra: Callable[[np.ndarray, bytes], bytes] | None = None, pack: Callable[[np.ndarray, bytes], tuple] | None = None, carry: bool = False) -> DataFrame:
    """Chunks of whole texts in UTF-8 (null: empty): ids, where each text ends, and the compressed concatenation; written.

    ``extra(ends, data)`` is stored beside them; ``pack(ends, data)`` gives (ends, data, extra) to be stored instead; with
    ``carry`` all other columns are kept as an Arrow stream."""
    small_batches(documents.sparkSession)
    others = [c for c in documents.columns if c not in (id_col, text_col)] if carry else []
    buckets = buckets_of(documents)

    def run(batches):
        from pyspark import TaskContext

        numbers = chunk_numbers(TaskContext.get().partitionId(), buckets)
        number, ids, ends, parts, size, rows = next(numbers), [], [], [], 0, []
        press = zstandard.ZstdCompressor(level=3)

        def out():
            data, at = b"".join(parts), np.array(ends, np.int64)
            stops, body, more = pack(at, data) if pack else (at, data, extra(at, data) if extra else None)
            carried = None
            if carry:
                sink = pa.BufferOutputStream()
                table = pa.Table.from_batches(rows)
                with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                    stream.write_table(table.combine_chunks())
                carried = sink.getvalue().to_pybytes()
            columns = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([stops], pa.list_(pa.int64())), *[pa.array([x], pa.binary()) for x in (press.compress(body), more, carried)]]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "ends", "data", "extra", "carried"])

        for batch in batches:
            rest, from_ = batch.select(others) if carry else None, 0
            for k, (text, id_) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                raw = (text or "").encode()
                if ids and (size + len(raw) > target or len(ids) == CHUNK_ROWS):
                    if carry:
                        rows.append(rest.slice(from_, k - from_))
                        from_ = k
                    yield out()
                    number, ids, ends, parts, size, rows = next(numbers), [], [], [], 0, []
                size += len(raw)
                ids.append(id_)
                ends.append(size)
                parts.append(raw)
            if carry:
                rows.append(rest.slice(from_))
        if ids:
            yield out()

    chosen = documents.select(F.col(f"`{text_col}`").alias("_t"), F.col(f"`{id_col}`").cast("long").alias("_i"), *[F.col(f"`{c}`") for c in others])
    return bucketed(chosen.mapInArrow(run, CHUNK), "chunks", "chunk", buckets)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def per_chunk(chunks: DataFrame, f: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str | StructType, answers: DataFrame | None = None, carried: bool = False) -> DataFrame:
    """Runs ``f`` for each chunk; it yields batches of ``schema``.

    Each chunk meets its own ``answers`` (chunk, and other columns) by an equi-join; those of one chunk are bounded by its size."""
    small_batches(chunks.sparkSession)
    if answers is None:
        both = chunks.withColumn("answers", F.lit(None).cast("array<struct<a:int>>"))
    else:
        own = answers.groupBy("chunk").agg(F.collect_list(F.struct(*[c for c in answers.columns if c != "chunk"])).alias("answers"))
        both = chunks.join(own, "chunk", "left")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids, ends, data, extra, rest, got = (batch.column(k)[row] for k in range(7))
                yield from f(Chunk(number.as_py(), ids.as_py(), ends.values.to_numpy(), unpack(data.as_py()), extra.as_py(), rest.as_py(), got.values))

    more = F.col("carried") if carried else F.lit(None).cast("binary").alias("carried")
    return both.select("chunk", "ids", "ends", "data", "extra", more, "answers").mapInArrow(run, schema)


def repacked(c: Chunk, extra: bytes) -> pa.RecordBatch:
    """The chunk's row with another ``extra``, and nothing carried."""
    columns = [pa.array([c.number]), pa.array([c.ids], pa.list_(pa.int64())), pa.array([c.ends], pa.list_(pa.int64())), *[pa.array([x], pa.binary()) for x in (zstandard.ZstdCompressor(level=3).compress(c.data), extra, None)]]
    return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "ends", "data", "extra", "carried"])


def messages(number: int, blobs: dict[int, bytes]) -> pa.RecordBatch:
    """The messages of a chunk, by shard."""
    return pa.RecordBatch.from_arrays([pa.array(list(blobs), pa.int64()), pa.array([number] * len(blobs), pa.int64()), pa.array(list(blobs.values()), pa.binary())], names=["shard", "chunk", "blob"])


def per_shard(sent: DataFrame, f: Callable[[int, list[int], list[bytes]], list[tuple[int, bytes]]]) -> DataFrame:
    """Runs ``f(shard, chunks, blobs)`` for each shard with all its messages in order of their chunk; it returns (chunk, blob) answers."""

    def run(table: pa.Table) -> pa.Table:
        order = table.sort_by("chunk")
        shard = order.column("shard")[0].as_py()
        out = f(shard, order.column("chunk").to_pylist(), order.column("blob").to_pylist())
        return pa.table([pa.array([shard] * len(out), pa.int64()), pa.array([c for c, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["shard", "chunk", "blob"])

    return sent.groupBy("shard").applyInArrow(run, MESSAGE)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each uint64 key: equal ranges of the keys' upper half."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
