"""Near-duplicate groups by an exact n-gram Jaccard join over prefix trees.

A document is the set of its distinct word n-grams in one global order: n-grams that a count sketch of fixed size shows
as rare come first, ties by hash. Two sets with Jaccard similarity of at least ``PERCENT`` percent then share an n-gram
in the first ``n - ceil(PERCENT * n / 100) + 1`` of each (its prefix), whatever the order, so candidates lose no link.

1. Equal sets are one node. Each node files its prefix n-grams; an n-gram that one node filed alone says nothing.
2. Each node is compared with one node of its n-grams' groups, the one that stands for most of them: a group's head is the
   node with the fewest n-grams before the common one, so copies with few edits are the heads of their kind. Links make
   components, and a large group of copies is settled by as many comparisons as it has members.
3. Only n-grams whose nodes lie in several components are left. Of these, nodes drop out that can be linked with no other of
   the group, by sizes, by how many n-grams either set has from this one on, and by a map of the parities of their n-grams (sets differ by as many
   n-grams as their maps by bits, at least). For the others a prefix tree holds the rest of
   each node's prefix from the common n-gram on, and every node of the group traverses it. What a pair shares is counted
   once for all sets below a tree node; a subtree is left when the overlap so far and the n-grams that remain in either set
   can't make a link with any set in it, or when it lies in the traversing node's own component. A pair that is linked
   passes at the first n-gram that it shares. Pairs that pass are compared in full, by trees over whole sets.

Both trees are one: sequences are sorted, common beginnings become compressed edges, and a whole block of traversals moves
down level by level on arrays. A group of more than ``GROUP`` nodes is split by member; each part is traversed by all.

N-grams are told apart by 8 bits of the order and 56 of a hash, sets by 64 bits of a digest, or the other 64 for the few
that those don't tell apart. Odd input: null text, no words: an empty set, linked with nothing; fewer words than n: the
whole sequence is the one n-gram; null ids stay null and count for no component's id; repeated rows are members each; an
empty table gives an empty table; other columns don't matter. A worker holds the n-grams of a few MB of texts, or of one
longer text (about 60 bytes for each word of it).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import dropped, in_map, key_map, rows_with, slices, small_batches, text_key, written

#: Words of an n-gram, least similarity in percent, candidates of a head that are compared together.
WORDS, PERCENT, BLOCK = 4, 85, 256
#: Counters of the sketch (fixed: a byte each reaches every worker), and ranges of them that are summed apart.
COUNTERS, RANGES = 1 << 22, 256
#: Nodes of an n-gram's group that one tree holds, and bits of a set's map of parities.
GROUP, PARITIES = 4096, 512
#: Sequences and n-grams that a worker puts into one tree; pairs that move down at once; n-grams of an edge per step.
TREE_ROWS, TREE_GRAMS, FRONTIER, STRIDE = 16_384, 2_000_000, 400_000, 32


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct word n-grams of each text."""
    index: dict[bytes, int] = {}
    tokens, stops = [], []
    for raw in texts:
        own = raw.lower().split()  # bytes: A-Z, and the six ASCII blanks, only
        for w in own:
            if w not in index:
                index[w] = len(index)
        tokens += map(index.__getitem__, own)
        stops.append(len(tokens))
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in index], np.uint64)
    word = hashes[np.array(tokens, np.int64)] if tokens else np.zeros(0, np.uint64)
    gram = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        gram = _finish(gram + word[k : k + len(gram)] + np.uint64(k + 1))
    out, a = [], 0
    for b in stops:
        if b - a >= words:
            out.append(np.unique(gram[a : b - words + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = _finish(short + word[k : k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        a = b
    return out


def _digest(grams: np.ndarray, twice: frozenset = frozenset()) -> tuple[int, int]:
    """(node, other half) of a set; ``twice``: first halves that don't tell sets apart."""
    a, b = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), "<i8").tolist()
    return (b if a in twice else a), b


def _text_key(raw: bytes) -> int:
    """Spark's ``xxhash64`` of a text."""
    return int(np.uint64(xxhash.xxh64_intdigest(raw, seed=42)).astype(np.int64))


def _arranged(grams: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A set in the global order: rarity in the upper 8 bits, hash in the others."""
    return np.sort(codes[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | grams >> np.uint64(8))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _may_link(overlap, a, b, percent: int):
    """Whether sets of sizes a and b with this overlap (or bound of it) are linked (or may be); numbers, arrays or columns."""
    return overlap * (100 + percent) >= (a + b) * percent


# ---- prefix trees


class Forest:
    """Prefix trees of sorted sequences, one for each key, as arrays of compressed edges.

    Rows: ``key``; the sequence ``flat[start:stop]`` of gram numbers in ascending order; ``rest``, the elements that the
    set has from the sequence's first on (the sequence may end early); ``size`` of the whole set; ``label`` and ``node``."""

    def __init__(self, key, start, stop, flat, rest, size, label, node, members):
        self.flat, self.start, self.stop, self.rest, self.size, self.label, self.node = flat, start, stop, rest, size, label, node
        words = flat.astype(">u4")
        order = sorted(members.tolist(), key=lambda r: (key[r], words[start[r] : stop[r]].tobytes()))
        self.order = np.array(order, np.int64)
        edges = []  # [first row in order, depth where the edge begins, depth where it ends, parent]
        stack: list[int] = []
        previous = None
        at_end = np.empty(len(order), np.int64)
        for k, r in enumerate(order):
            n = int(stop[r] - start[r])
            if previous is not None and key[previous] == key[r]:
                m = min(n, int(stop[previous] - start[previous]))
                differ = flat[start[previous] : start[previous] + m] != flat[start[r] : start[r] + m]
                common = int(differ.argmax()) if m and differ.any() else m
            else:
                common, stack = 0, []
            last = -1
            while stack and edges[stack[-1]][2] > common:
                last = stack.pop()
            if last >= 0 and edges[last][1] < common:  # an edge parts here: its upper part becomes an edge of its own
                e = edges[last]
                edges.append([e[0], e[1], common, e[3]])
                e[1], e[3] = common, len(edges) - 1
                stack.append(len(edges) - 1)
            if n > common or not stack:
                edges.append([k, common, n, stack[-1] if stack else -1])
                stack.append(len(edges) - 1)
            at_end[k] = stack[-1]
            previous = r
        e = np.array(edges, np.int64).reshape(-1, 4)
        self.begin, self.end, self.parent = e[:, 1], e[:, 2], e[:, 3]
        self.source = self.start[self.order[e[:, 0]]] if len(e) else np.zeros(0, np.int64)
        self.key = np.array([key[order[k]] for k in e[:, 0].tolist()])
        # members of each edge's end, children of each edge, and bounds of what is below
        self.member = self.order[np.argsort(at_end, kind="stable")]
        self.member_at = np.searchsorted(np.sort(at_end), np.arange(len(e) + 1))
        self.child = np.argsort(self.parent, kind="stable")
        self.child_at = np.searchsorted(self.parent[self.child], np.arange(len(e) + 1))
        low, high = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        self.least, self.first, self.low = (np.full(len(e), low) for _ in range(3))
        self.most, self.high = (np.full(len(e), high) for _ in range(2))
        rows = self.order
        for f, out, of in ((np.minimum, self.least, size), (np.minimum, self.first, node), (np.minimum, self.low, label), (np.maximum, self.high, label), (np.maximum, self.most, rest)):
            f.at(out, at_end, of[rows])
        for i in np.argsort(-self.begin, kind="stable").tolist():  # an edge's parent begins above it
            p = self.parent[i]
            if p >= 0:
                self.least[p], self.first[p], self.low[p] = min(self.least[p], self.least[i]), min(self.first[p], self.first[i]), min(self.low[p], self.low[i])
                self.most[p], self.high[p] = max(self.most[p], self.most[i]), max(self.high[p], self.high[i])

    def linked(self, probes: np.ndarray, roots_of, percent: int, once: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (probe row, member row) that may be linked; that are, if sequences are whole sets. Pairs of one node, and of one label, are left out; ``once``: pairs are named with the greater node as probe."""
        found_a, found_b = [], []
        at = 0
        while at < len(probes):
            # a block of probes that can't have more than FRONTIER pairs at the start
            block, edge, total = [], [], 0
            while at < len(probes) and (not block or total < FRONTIER):
                r = roots_of(probes[at])
                block.append(np.full(len(r), probes[at]))
                edge.append(r)
                total += len(r)
                at += 1
            for a, b in self._descend(np.concatenate(block), np.concatenate(edge), percent, once):
                found_a.append(a)
                found_b.append(b)
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *found_a]), np.concatenate([empty, *found_b])

    def _descend(self, probe, edge, percent, once) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        spread = int(self.flat.max()) + 1 if len(self.flat) else 1
        rows = np.unique(probe)
        lengths = self.stop[rows] - self.start[rows]
        place = np.searchsorted(rows, probe)
        inside = np.repeat(self.start[rows] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        keyed = np.repeat(np.arange(len(rows)), lengths) * spread + self.flat[inside]  # sorted: rows in turn, each ascending
        base, known = (np.cumsum(lengths) - lengths)[place], lengths[place]
        last = np.where(known > 0, self.flat[self.stop[probe] - 1], -1)
        work = [(probe, place, base, known, last, edge, np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64), np.zeros(len(probe), np.int64))]
        while work:
            probe, place, base, known, last, edge, overlap, decided, rank, offset = work.pop()
            keep = self._open(probe, edge, overlap, decided, rank, percent, once)
            probe, place, base, known, last, edge, overlap, decided, rank, offset = (x[keep] for x in (probe, place, base, known, last, edge, overlap, decided, rank, offset))
            if not len(probe):
                continue
            if len(probe) > FRONTIER:  # by halves, so that memory stays bounded
                half = len(probe) // 2
                both = (probe, place, base, known, last, edge, overlap, decided, rank, offset)
                work += [tuple(x[:half] for x in both), tuple(x[half:] for x in both)]
                continue
            length = self.end[edge] - self.begin[edge]
            n = np.minimum(STRIDE, length - offset)
            grams = self.flat[np.repeat(self.source[edge] + self.begin[edge] + offset - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            pair = np.repeat(np.arange(len(n)), n)
            sure = grams <= last[pair]
            wanted = place[pair] * spread + grams
            found = np.searchsorted(keyed, wanted)
            hit = sure & (keyed[np.minimum(found, max(0, len(keyed) - 1))] == wanted) if len(keyed) else np.zeros(len(wanted), bool)
            overlap = overlap + np.bincount(pair[hit], minlength=len(n))
            now = np.bincount(pair[sure], minlength=len(n))
            decided = decided + now
            # how far the probe's own sequence is passed
            passed = np.zeros(len(n), np.int64)
            np.maximum.at(passed, pair[sure], (found + hit)[sure] - base[pair[sure]])
            rank = np.where(now < n, known, np.maximum(rank, passed))
            offset = offset + n
            more = offset < length
            if more.any():
                work.append(tuple(x[more] for x in (probe, place, base, known, last, edge, overlap, decided, rank, offset)))
            done = ~more
            probe, place, base, known, last, edge, overlap, decided, rank = (x[done] for x in (probe, place, base, known, last, edge, overlap, decided, rank))
            # sets that end here
            count = self.member_at[edge + 1] - self.member_at[edge]
            if count.any():
                who = np.repeat(np.arange(len(edge)), count)
                member = self.member[np.repeat(self.member_at[edge] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
                p = probe[who]
                most = overlap[who] + np.minimum(self.rest[member] - decided[who], self.rest[p] - rank[who])
                ok = _may_link(most, self.size[member], self.size[p], percent) & (self.label[member] != self.label[p])
                ok &= self.node[member] < self.node[p] if once else self.node[member] != self.node[p]
                if ok.any():
                    yield p[ok], member[ok]
            # sets below
            count = self.child_at[edge + 1] - self.child_at[edge]
            if count.any():
                who = np.repeat(np.arange(len(edge)), count)
                child = self.child[np.repeat(self.child_at[edge] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
                work.append((probe[who], place[who], base[who], known[who], last[who], child, overlap[who], decided[who], rank[who], np.zeros(len(who), np.int64)))

    def _open(self, probe, edge, overlap, decided, rank, percent, once):
        """Which (probe, edge) pairs can still find a link below."""
        bound = overlap + np.minimum(self.most[edge] - decided, self.rest[probe] - rank)
        ok = _may_link(bound, self.least[edge], self.size[probe], percent)
        ok &= (self.low[edge] != self.high[edge]) | (self.low[edge] != self.label[probe])
        if once:
            ok &= self.first[edge] < self.node[probe]
        return ok


def _tree_pairs(key: list, grams: list[np.ndarray], rest, size, label, node, member, probe, percent: int, once: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of the pairs that the forest of ``member`` rows finds for ``probe`` rows."""
    stop = np.cumsum([len(g) for g in grams])
    start = np.append(0, stop[:-1])
    _, flat = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]), return_inverse=True)
    forest = Forest(key, start, stop, flat.astype(np.int64), rest, size, label, node, np.flatnonzero(member))
    roots: dict = {}
    for e in np.flatnonzero(forest.parent < 0).tolist():
        roots.setdefault(int(forest.key[e]), []).append(e)
    roots = {k: np.array(v, np.int64) for k, v in roots.items()}
    none = np.zeros(0, np.int64)
    return forest.linked(np.flatnonzero(probe), lambda r: roots.get(key[r], none), percent, once)


def _arrays(column: pa.Array) -> list[np.ndarray]:
    flat, edges = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.append(0, np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))).tolist()
    return [flat[a:b].copy() for a, b in zip(edges, edges[1:])]


def _grouped(rows: DataFrame, f, schema: str) -> DataFrame:
    """Runs ``f(keys, key number, grams, parities, role, node, size, rest, label)`` over ``rows`` of those names and ``part``: role 0 is a member of its group and asks about it, 1 is a member only, 2 asks only.

    Rows are dealt by (key, part) and sorted, members first, so a worker streams them and holds a few groups, or the members of one."""
    small_batches(rows.sparkSession)

    def run(batches):
        held: list[tuple] = []
        size = 0

        def found():
            key, role, node, n, rest, label, grams, maps = zip(*held)
            numbers: dict = {}
            number = np.array([numbers.setdefault(k, len(numbers)) for k in key], np.int64)
            return f(list(numbers), number, grams, maps, *(np.array(x, np.int64) for x in (role, node, n, rest, label)))

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for row in zip(keys, *[batch.column(k).to_pylist() for k in range(2, 7)], _arrays(batch.column(7)), _arrays(batch.column(8))):
                if (len(held) >= TREE_ROWS or size >= TREE_GRAMS) and (held[-1][0] != row[0] or row[1] == 2):
                    yield found()
                    # a group goes on: its members stay, to be asked about by the rest
                    held = [(h[0], 1, *h[2:]) for h in held if h[0] == row[0] and h[1] < 2]
                    size = sum(len(h[6]) for h in held)
                held.append(row)
                size += len(row[6])
        if held:
            yield found()

    none = F.array().cast("array<long>")
    more = [F.col(c) if c in rows.columns else none.alias(c) for c in ("grams", "parities")]
    chosen = rows.select("key", "part", "role", "node", "size", "rest", "label", *more)
    return chosen.repartition("key", "part").sortWithinPartitions("key", "part", "role").mapInArrow(run, schema)


def _grouped_trees(rows: DataFrame, percent: int, once: bool) -> DataFrame:
    """Links (a, b) that the trees of ``rows`` with ``grams`` find, and that ``parities``, where given, allow."""

    def links(_, number, grams, maps, role, node, size, rest, label):
        a, b = _tree_pairs(number.tolist(), list(grams), rest, size, label, node, role < 2, role != 1, percent, once)
        if len(maps[0]) and len(a):
            maps = np.stack(maps)
            ok = _alike(maps, size, a, b, percent)
            a, b = a[ok], b[ok]
        both = np.unique(np.stack([node[a], node[b]], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return _grouped(rows, links, "a long, b long")


def _alike(maps: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether maps of parities allow a link: what sets share is at most half of what is left of their sizes without the bits that differ."""
    differ = np.zeros(len(a), np.int64)
    for k in range(maps.shape[1]):
        differ += np.bitwise_count(maps[a, k] ^ maps[b, k])
    return _may_link((size[a] + size[b] - differ) // 2, size[a], size[b], percent)


def possible_pairs(number, maps: np.ndarray, role, node, size, rest, label, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asking row, member row) of one group that sizes, rests and maps of parities allow to be linked; by blocks, each pair once."""
    member = np.flatnonzero(role < 2)
    member = member[np.argsort(number[member], kind="stable")]
    asks = np.flatnonzero(role != 1)
    lo, hi = (np.searchsorted(number[member], number[asks], side) for side in ("left", "right"))
    blocks = np.searchsorted(np.cumsum(hi - lo), np.arange(1, int((hi - lo).sum()) // FRONTIER + 1) * FRONTIER) + 1
    for part in np.split(np.arange(len(asks)), np.unique(blocks)):
        n = (hi - lo)[part]
        a = np.repeat(asks[part], n)
        b = member[np.repeat(lo[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ok = (node[b] < node[a]) & (label[a] != label[b]) & _may_link(np.minimum(rest[a], rest[b]), size[a], size[b], percent)
        a, b = a[ok], b[ok]
        ok = _alike(maps, size, a, b, percent)
        yield a[ok], b[ok]


def _possible(rows: DataFrame, percent: int) -> DataFrame:
    """(key, node) of ``rows`` that may be linked with another node of their group, by ``rest`` and, where given, ``parities``."""

    def entries(keys, number, _, maps, role, node, size, rest, label):
        maps = np.stack(maps)
        some = np.zeros(len(node), bool)
        for a, b in possible_pairs(number, maps, role, node, size, rest, label, percent):
            some[a] = some[b] = True
        key = np.array([k for k, _ in keys], np.int64)[number[some]]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node[some])], names=["key", "node"])

    return _grouped(rows, entries, "key long, node long")


# ---- components


def components(links: DataFrame) -> DataFrame:
    """(node, label, old), written: label is the least node that ``links`` (a, b) reach, by minima of neighbours and jumps over labels until nothing changes."""
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"), F.lit(0).cast("long").alias("old")).withColumnRenamed("a", "node"), "labels")
    while True:
        known = labels.select("node", "label")
        near = edges.join(known, edges.b == known.node).groupBy("a").agg(F.min("label").alias("near"))
        jump = known.select(F.col("node").alias("_n"), F.col("label").alias("far"))
        step = known.join(near, known.node == near.a, "left").join(jump, known.label == jump._n, "left")
        new = written(step.select("node", F.least("label", "near", "far").alias("label"), F.col("label").alias("old")), "labels")
        settled = new.where("label <> old").isEmpty()
        dropped(labels)
        labels = new
        if settled:
            dropped(edges)
            return labels


# ---- passes over the texts


def _raw(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(documents.sparkSession)
    return documents.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{id_col}`").cast("long").alias("i"))


ROWS = "doc_id long, size long, node long, other long, text_key long, sketch binary"


def _sets_of(texts: DataFrame, words: int) -> DataFrame:
    """A row for each text, and at a task's end rows of its counters: size is -1, doc_id the range."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                part = batch.slice(a, b - a)
                raw = [(t or "").encode() for t in part.column(0).to_pylist()]
                sets = shingle_sets(raw, words)
                halves = [_digest(s) if len(s) else (None, None) for s in sets]
                counts += np.bincount((np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in halves], pa.int64()), pa.array([x for _, x in halves], pa.int64()), pa.array([_text_key(r) for r in raw], pa.int64()), pa.nulls(len(raw), pa.binary())],
                    names=names,
                )
        press = zstandard.ZstdCompressor(level=1)
        blobs = [press.compress(c.tobytes()) for c in np.split(counts, RANGES) if counts.any()]
        none = pa.nulls(len(blobs), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blobs)), pa.int64()), pa.array([-1] * len(blobs), pa.int64()), none, none, none, pa.array(blobs, pa.binary())], names=names)

    names = [x.split()[0] for x in ROWS.split(", ")]
    return written(texts.mapInArrow(run, ROWS), "sets")


def _codes(rows: DataFrame) -> np.ndarray:
    """Rarity of each counter in steps of an eighth of a power of two. Counters are summed by range as they stream in; COUNTERS bytes come to the driver, for a corpus of any size."""
    width = COUNTERS // RANGES

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                totals[r] = totals.get(r, 0) + np.frombuffer(unpress.decompress(blob), np.uint32).astype(np.int64)
        codes = [np.minimum(255, np.rint(8 * np.log2(1 + t))).astype(np.uint8).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int64()), pa.array(codes, pa.binary())], names=["doc_id", "sketch"])

    out = np.zeros(COUNTERS, np.uint8)
    for r in rows.where("size = -1").select("doc_id", "sketch").repartition(32, "doc_id").mapInArrow(add, "doc_id long, sketch binary").collect():
        out[r.doc_id * width : (r.doc_id + 1) * width] = np.frombuffer(r.sketch, np.uint8)
    return out


def _prefixes(texts: DataFrame, words: int, percent: int, codes, twice: frozenset) -> DataFrame:
    """(node, size, prefix, parities) of the distinct sets of each task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for a, b in slices(batch.column(0)):
                nodes, sizes, parts, maps = [], [], [], []
                for s in shingle_sets([(t or "").encode() for t in batch.column(0).slice(a, b - a).to_pylist()], words):
                    if len(s) and (node := _digest(s, twice)[0]) not in seen:
                        seen.add(node)
                        nodes.append(node)
                        sizes.append(len(s))
                        parts.append(_arranged(s, codes.value)[: prefix_length(len(s), percent)])
                        maps.append(parities(s))
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(parts), _lists(maps)], names=["node", "size", "prefix", "parities"])

    return written(texts.mapInArrow(run, "node long, size long, prefix array<long>, parities array<long>"), "prefixes")


def parities(grams: np.ndarray) -> np.ndarray:
    """One bit for each class of n-grams: whether the set has an odd number of them."""
    odd = np.bincount((grams >> np.uint64(24) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(p) for p in parts])), pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))


def _whole_sets(texts: DataFrame, words: int, codes, twice: frozenset, asked) -> DataFrame:
    """(node, size, grams) of the texts whose key is marked in the map ``asked``, and of some more."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for a, b in slices(batch.column(0)):
                raw = [(t or "").encode() for t in batch.column(0).slice(a, b - a).to_pylist()]
                wanted = in_map(asked.value, np.array([_text_key(r) for r in raw], np.int64))
                nodes, sizes, parts = [], [], []
                for s in shingle_sets([r for r, w in zip(raw, wanted) if w], words):
                    if len(s) and (node := _digest(s, twice)[0]) not in seen:
                        seen.add(node)
                        nodes.append(node)
                        sizes.append(len(s))
                        parts.append(_arranged(s, codes.value))
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(parts)], names=["node", "size", "grams"])

    return texts.mapInArrow(run, "node long, size long, grams array<long>")


class Join:
    """The passes of one run, with what they share."""

    def __init__(self, documents: DataFrame, id_col: str, text_col: str, words: int, percent: int):
        self.texts, self.words, self.percent = _raw(documents, id_col, text_col), words, percent
        self.spark = documents.sparkSession
        sets = _sets_of(self.texts, words)
        self.codes = self.spark.sparkContext.broadcast(_codes(sets))
        # counters are most of the table's bytes; they are not kept while the rest runs
        self.rows = docs = written(sets.where("size >= 0").drop("sketch"), "rows")
        dropped(sets)
        # sets whose first halves agree and others don't: about n * n / 2 ** 65 of n, so few at any size
        unlike = docs.groupBy("node").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).where("lo <> hi")
        self.twice = frozenset(r.node for r in unlike.select("node").collect())
        self.docs = docs.withColumn("node", F.when(F.col("node").isin(*self.twice), F.col("other")).otherwise(F.col("node"))) if self.twice else docs

    def labels(self) -> DataFrame:
        """(node, label) of the nodes that are linked."""
        p = self.percent
        prefixes = _prefixes(self.texts, self.words, p, self.codes, self.twice)
        entries = prefixes.select(F.col("node"), F.col("size").cast("int").alias("size"), F.posexplode("prefix").alias("pos", "gram"))
        group = Window.partitionBy("gram")
        shared = entries.withColumn("head", F.min(F.struct("pos", "size", "node")).over(group)).withColumn("lo", F.min("node").over(group)).withColumn("hi", F.max("node").over(group)).where("lo <> hi")
        shared = written(shared.select("gram", "node", "size", "pos", F.col("head.node").alias("head"), F.col("head.size").alias("head_size"), F.col("head.pos").alias("head_pos")).distinct(), "shared")

        bound = F.least("pos", "head_pos") + 1 + F.least(F.col("size") - F.col("pos"), F.col("head_size") - F.col("head_pos")) - 1
        fits = (F.col("node") != F.col("head")) & _may_link(bound, F.col("size"), F.col("head_size"), p)
        stars = shared.groupBy("node", "head").agg(F.count("*").alias("all"), F.count_if(fits).alias("times"), F.first("size").alias("size"), F.first("head_size").alias("head_size"))
        best = F.max(F.when(F.col("times") > 0, F.struct("times", "head", "head_size")))
        # what a set has in common, by and large: what lies behind its prefix, and what is shared within
        most = (F.ceil(F.lit(p) * F.first("size") / 100) - 1 + F.sum("all")).cast("long")
        nodes = written(stars.groupBy("node").agg(F.first("size").alias("size"), most.alias("most"), best.alias("best")), "nodes")
        # a guess of which pairs are worth whole sets: what they share of the prefixes, twice what is known of it; what both can share; and their parities
        guess = nodes.where("best is not null").select("node", "size", "most", "best.*").join(nodes.select(F.col("node").alias("head"), F.col("most").alias("head_most")), "head")
        rest = F.least(*[F.ceil(F.lit(p) * F.col(c) / 100) - 1 for c in ("size", "head_size")])
        guess = guess.where(_may_link(F.least(2 * F.col("times") + rest, "most", "head_most"), F.col("size"), F.col("head_size"), p))
        maps = prefixes.select("node", "parities").dropDuplicates(["node"])
        guess = guess.join(maps, "node").join(maps.select(F.col("node").alias("head"), F.col("parities").alias("head_parities")), "head")
        differ = F.aggregate(F.zip_with("parities", "head_parities", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
        tried = guess.where(_may_link(F.floor((F.col("size") + F.col("head_size") - differ) / 2), F.col("size"), F.col("head_size"), p))
        tried = written(tried.select(F.col("head").alias("center"), F.col("node").alias("member")), "stars")
        links = self.verified(tried)
        labels = components(links)

        placed = shared.select("gram", "node", "size", "pos").join(labels.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        # what a set can have in common from an n-gram on, if none before is: a prefix's n-gram may stand behind another's prefix
        placed = placed.withColumn("bound", F.col("size") - F.col("pos"))
        left = placed.withColumn("lo", F.min("label").over(group)).withColumn("hi", F.max("label").over(group)).withColumn("many", F.count("*").over(group)).where("lo <> hi")
        left = written(left.select(F.col("gram").alias("key"), "node", F.col("size").cast("long").alias("size"), F.col("bound").cast("long").alias("rest"), "pos", "label", "many"), "open")
        dropped(shared, nodes)
        fits = written(_possible(_parted(left), p).distinct(), "fits")
        some = written(left.join(fits, ["key", "node"]), "open")
        own = written(prefixes.join(some.select("node").distinct(), "node", "left_semi").select("node", "prefix", "parities").dropDuplicates(["node"]), "own")
        dropped(left, fits, prefixes)
        near = written(_possible(_parted(some.join(own.select("node", "parities"), "node")), p).distinct(), "near")
        # counted before the prefixes come along, so that these are moved once, to their trees
        counted = near.join(near.groupBy("key").agg(F.count("*").alias("many")), "key")
        rest = some.drop("many").join(counted, ["key", "node"]).join(own, "node")
        tails = rest.withColumn("grams", F.slice("prefix", F.col("pos") + 1, F.size("prefix") - F.col("pos"))).withColumn("rest", (F.col("size") - F.col("pos")).cast("long"))
        possible = written(_grouped_trees(_parted(tails), p, True).distinct(), "possible")
        dropped(some, own, near)
        more = self.verified(possible.select(F.col("a").alias("center"), F.col("b").alias("member")))
        if more.isEmpty():
            out = labels
        else:
            out = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))
            dropped(labels)
        dropped(tried, possible, links, more)
        return out

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Links (a, b), written, among ``pairs`` (center, member): whole sets meet in trees, at most about ``BLOCK`` members with their center."""
        asked = pairs.select(F.col("center").alias("node")).unionByName(pairs.select(F.col("member").alias("node"))).distinct()
        texts = self.docs.join(asked, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("k"))
        sets = _whole_sets(self.texts, self.words, self.codes, self.twice, self.spark.sparkContext.broadcast(key_map(texts.select("k"))))
        many = pairs.groupBy("center").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
        dealt = pairs.join(many, "center").select("center", "member", F.pmod(F.xxhash64("member"), F.col("parts")).alias("part"))
        sends = dealt.select(F.col("member").alias("node"), F.col("center").alias("key"), "part", F.lit(1).alias("role")).unionByName(dealt.select(F.col("center").alias("node"), F.col("center").alias("key"), "part", F.lit(2).alias("role")).distinct())
        rows = sets.join(sends, "node").select("key", "part", "role", "node", "size", F.col("size").alias("rest"), F.col("node").alias("label"), "grams")
        return written(_grouped_trees(rows, self.percent, False).distinct(), "verified")


def _parted(rows: DataFrame) -> DataFrame:
    """Rows of groups (key) of ``many`` nodes; a group of more than ``GROUP`` is split by member: each node is a member of one part, and asks about all."""
    parts = F.ceil(F.col("many") / GROUP)
    out = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return out.withColumn("role", F.when(F.col("part") == F.pmod(F.xxhash64("node"), parts), 0).otherwise(2))


def _members(documents: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(doc_id, size, text_key, label), written; the label of an empty set is null."""
    join = Join(documents, id_col, text_col, words, percent)
    labels = join.labels()
    out = written(join.docs.join(labels.select("node", "label"), "node", "left").select("doc_id", "size", "text_key", F.coalesce("label", "node").alias("label")), "members")
    dropped(join.rows, labels)
    return out


def groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id)."""
    rows = _members(documents, id_col, text_col, words, percent)
    ids = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return rows.join(ids, "label", "left").select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def kept_rows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns: of each group the row with the least id (nulls lose; ties by hash of the text, then any one), and all rows with an empty set."""
    rows = _members(documents, id_col, text_col, words, percent)
    groups_ = rows.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key")).alias("r"), F.count("*").alias("n")).where("n > 1")
    groups_ = written(groups_, "first")
    members = rows.join(groups_.select("label"), "label", "left_semi")
    again = members.groupBy("doc_id", "text_key").count().where("count > 1").drop("count")
    return rows_with(documents, id_col, text_col, members.select("text_key"), text_key, groups_.select("r.doc_id", "r.text_key"), again)


def query(spark, sf_dir):
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * o >= 85 * (na + nb - o)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = s.doc_id
"""
