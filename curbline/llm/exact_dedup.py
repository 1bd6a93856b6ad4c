"""Exact deduplication with Patricia-trie owners.

Texts are equal when identical after lower-casing A-Z. Workers first group the texts of a slice of rows, so that a
group of copies of any size enters the shuffle as one row per slice. Rows are then dealt by length and content hash;
each partition inserts the full byte strings into a compressed radix trie, whose terminal nodes hold the owner (largest
or smallest id) and have a number, under which each local group is filed as it arrives. A trie that outgrows its budget
gives up its heaviest subtree at the first place where keys part: what was there, and what comes later, goes
into a table in the shared folder, which the next pass deals by subtree. Owners then return to the local groups by
equi-joins of small rows.

Odd input: null text counts as empty, and empty texts are copies of each other; null ids lose to any other id, and a
group without ids has a null ``keep_id``; of equal ids in a group one row stays (the first of its slice); an empty table
gives an empty table; columns of any name can be carried; a worker holds its trie and a slice of rows (4 MiB of texts or
one longer text).
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from curbline.llm.common import dropped, rows_with, slices, small_batches, text_key, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that a worker's trie holds before it gives up a subtree, and what a node takes besides its label.
TRIE_BYTES, NODE_BYTES = 96 << 20, 300
#: Of a terminal's and a subtree's number, the bits for its place in its task; the pass stands above the task.
LOCAL_BITS, TASK_BITS = 32, 24


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving comparisons."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Node:
    __slots__ = ("label", "children", "value", "gone")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value, self.gone = label, {}, value, None


class PatriciaTrie:
    """Compressed radix trie of byte strings. ``merge(old, new)`` joins the values of equal keys, ``old`` is None at first.

    Beyond ``budget`` bytes a subtree is given up: its keys, and later ones below it, go to ``spill(subtree, rest of key, value)``."""

    def __init__(self, merge: Callable, budget: int = TRIE_BYTES, spill: Callable | None = None):
        self.root, self.merge, self.budget, self.spill, self.bytes, self.subtrees = Node(b""), merge, budget, spill, 0, 0

    def insert(self, key: bytes, value):
        """The merged value, or None if the key went to a subtree that was given up."""
        node, at = self.root, 0
        while True:
            if node.gone is not None:
                self.spill(node.gone, key[at:], value)
                return None
            if at == len(key):
                node.value = out = self.merge(node.value, value)
                return out
            child = node.children.get(key[at])
            if child is None:
                out = self.merge(None, value)
                node.children[key[at]] = Node(key[at:], out)
                self.bytes += len(key) - at + NODE_BYTES
                if self.bytes > self.budget and self.spill:
                    self._give_up()
                return out
            rest = key[at:]
            n = common_prefix(child.label, rest)
            if n < len(child.label):
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
                self.bytes += NODE_BYTES
            node, at = child, at + n

    def _give_up(self) -> None:
        """Hands over the heaviest subtree that holds no other one and has others beside it; a lone key stays."""
        size = lambda top: sum(len(n.label) + NODE_BYTES for n, _ in self._walk(top))
        node = self.root
        while held := [c for c in node.children.values() if c.gone is None]:
            top = max(held, key=size)
            if len(node.children) > 1 and not any(n.gone is not None for n, _ in self._walk(top)):
                break
            node = top
        else:
            return
        self.bytes -= size(top) - len(top.label) - NODE_BYTES
        for n, rest in self._walk(top):
            if n.value is not None:
                self.spill(self.subtrees, rest, n.value)
        top.children, top.value, top.gone = {}, None, self.subtrees
        self.subtrees += 1

    @staticmethod
    def _walk(top: Node) -> Iterator[tuple[Node, bytes]]:
        """Nodes of a subtree with the rest of their keys behind its edge."""
        stack = [(top, b"")]
        while stack:
            node, rest = stack.pop()
            yield node, rest
            stack += [(c, rest + c.label) for c in node.children.values()]

    def values(self) -> Iterator:
        for node, _ in self._walk(self.root):
            if node.value is not None:
                yield node.value


def normal(text: str | None) -> bytes:
    return (text or "").encode().lower()  # bytes.lower() changes A-Z only


def local_groups(documents: DataFrame, id_col: str, text_col: str, keep: str) -> DataFrame:
    """One row per slice of rows and distinct text in it, with the ids of its rows and the local owner's text."""
    small_batches(documents.sparkSession)
    schema = T.StructType([T.StructField(n, t) for n, t in (("slice", T.LongType()), ("grp", T.LongType()), ("length", T.LongType()), ("hash", T.LongType()), ("text", T.StringType()), ("members", T.ArrayType(T.LongType())), ("owner_pos", T.LongType()), ("sha256", T.StringType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in slices(batch.column(0)):
                part = batch.slice(a, b - a)
                groups: dict[bytes, list[int]] = {}
                texts, ids = part.column(0).to_pylist(), part.column(1).to_pylist()
                for k, text in enumerate(texts):
                    groups.setdefault(normal(text), []).append(k)
                best = max if keep == "max" else min
                owners = []
                for rows in groups.values():
                    known = [k for k in rows if ids[k] is not None]
                    owners.append(best(known, key=lambda k: (ids[k], -k if keep == "max" else k)) if known else rows[0])
                values = [
                    pa.array([number] * len(groups), pa.int64()),
                    pa.array(range(len(groups)), pa.int64()),
                    pa.array([len(g) for g in groups], pa.int64()),
                    pa.array([xxhash.xxh64_intdigest(g) - (1 << 63) for g in groups], pa.int64()),
                    pa.array([texts[k] for k in owners], pa.string()),
                    pa.array([[ids[k] for k in rows] for rows in groups.values()], pa.list_(pa.int64())),
                    pa.array([rows.index(o) for o, rows in zip(owners, groups.values())], pa.int64()),
                    pa.array([hashlib.sha256(g).hexdigest() for g in groups], pa.string()),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, arrow)], schema=arrow)

    return documents.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{id_col}`").cast("long").alias("i")).mapInArrow(run, schema)


#: Rows of a pass. Filed: slice, grp and their terminal. Terminal: owner and size. Spilled: subtree, rest of the key, and either.
PASSED = "slice long, grp long, terminal long, keep_id long, owner_slice long, owner_grp long, group_size long, subtree long, rest binary"


def owners(groups: DataFrame, keep: str, budget: int = TRIE_BYTES) -> DataFrame:
    """Owner of each local group: (slice, grp, keep_id, owner_slice, owner_grp, group_size)."""

    def better(a, b):
        """Of two owners (id, slice, group): nulls lose, then by id, then the first slice."""
        if a[0] is None or b[0] is None:
            return a if b[0] is None and (a[0] is not None or a[1:] < b[1:]) else b
        if a[0] == b[0]:
            return min(a, b)
        return max(a, b) if keep == "max" else min(a, b)

    def trie_pass(number: int):
        def run(batches):
            from pyspark import TaskContext

            task = number << TASK_BITS + LOCAL_BITS | TaskContext.get().partitionId() << LOCAL_BITS
            out: list[tuple] = []
            terminals = 0

            def merge(old, new):
                nonlocal terminals
                if old is None and new[2] is None:
                    terminals += 1
                    return new[0], new[1], task + terminals
                return (new if old is None else (better(old[0], new[0]), old[1] + new[1], old[2] if new[2] is None else new[2]))

            def spill(subtree, rest, value):
                (owner, s, g), n, terminal = value[:3]
                # a local group that has no terminal yet goes on as it is
                out.append((*(value[3] if terminal is None else (None, None)), terminal, owner, s, g, n, task + subtree, rest))

            def batch_of():
                nonlocal out
                rows, out = out, []
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

            def close(trie):
                for (owner, s, g), n, terminal in (v[:3] for v in trie.values()):
                    out.append((None, None, terminal, owner, s, g, n, None, None))

            trie = below = None
            given_up = 0
            for batch in batches:
                for slice_, grp, key, owner, n, s, g, terminal, subtree in zip(*[c.to_pylist() for c in batch.columns]):
                    if trie is None or subtree != below:
                        if trie is not None:
                            close(trie)
                            given_up = trie.subtrees
                        trie, below = PatriciaTrie(merge, budget, spill), subtree
                        trie.subtrees = given_up
                    met = trie.insert(key, ((owner, s, g), n, terminal, (slice_, grp)))
                    if met is not None and slice_ is not None:
                        out.append((slice_, grp, met[2], None, None, None, None, None, None))
                    if len(out) >= 10_000:
                        yield batch_of()
            if trie is not None:
                close(trie)
            if out:
                yield batch_of()

        return run

    names = [x.split()[0] for x in PASSED.split(", ")]
    types = [pa.binary() if x.endswith("binary") else pa.int64() for x in PASSED.split(", ")]
    own = F.element_at("members", (F.col("owner_pos") + 1).cast("int"))
    key = F.encode(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), "UTF-8")
    dealt = groups.select("slice", "grp", key.alias("key"), own.alias("owner"), F.size("members").cast("long").alias("n"), F.col("slice").alias("s"), F.col("grp").alias("g"), F.lit(None).cast("long").alias("terminal"), F.lit(None).cast("long").alias("subtree"), "length", "hash").repartition("length", "hash").drop("length", "hash")
    done = None
    for number in itertools.count():
        passed = written(dealt.mapInArrow(trie_pass(number), PASSED), "owners")
        done = passed if done is None else done.unionByName(passed)
        spilled = passed.where("subtree is not null")
        if spilled.isEmpty():
            break
        # terminals of a subtree come before the groups that look for one
        dealt = spilled.repartition("subtree").sortWithinPartitions("subtree", F.col("terminal").isNull()).select("slice", "grp", F.col("rest").alias("key"), F.col("keep_id").alias("owner"), F.col("group_size").alias("n"), F.col("owner_slice").alias("s"), F.col("owner_grp").alias("g"), "terminal", "subtree")
    filed = done.where("subtree is null and slice is not null").select("slice", "grp", "terminal")
    ends = done.where("subtree is null and slice is null").select("terminal", "keep_id", "owner_slice", "owner_grp", "group_size")
    return filed.join(ends, "terminal").drop("terminal")


def _owned(documents: DataFrame, id_col: str, text_col: str, keep: str, budget: int, *more) -> DataFrame:
    """Local groups with their owners, and ``more`` of the groups' columns, written; their texts are not."""
    groups = written(local_groups(documents, id_col, text_col, keep), "exact-groups")
    owned = owners(groups, keep, budget)
    out = written(groups.select("slice", "grp", *more).join(owned, ["slice", "grp"]), "owned")
    dropped(groups)
    return out


def dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256)."""
    owned = _owned(documents, id_col, text_col, keep, budget, "members", "owner_pos", "sha256")
    rows = owned.select("*", F.posexplode("members").alias("pos", "doc_id"))
    mine = (F.col("slice") == F.col("owner_slice")) & (F.col("grp") == F.col("owner_grp")) & (F.col("pos") == F.col("owner_pos"))
    return rows.select("doc_id", "keep_id", "group_size", mine.alias("kept"), F.col("sha256").alias("text_sha256"))


def _normal_key(text: Column) -> Column:
    return text_key(F.translate(text, UPPER, LOWER))


def kept_rows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    text = F.col("text")
    owned = _owned(documents, id_col, text_col, keep, TRIE_BYTES, text_key(text).alias("key"), _normal_key(text).alias("normal")).where("slice = owner_slice AND grp = owner_grp AND group_size > 1")
    return rows_with(documents, id_col, text_col, owned.select("normal"), _normal_key, owned.select("keep_id", "key"))


def query(spark, sf_dir):
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep="max")


ORACLE = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
