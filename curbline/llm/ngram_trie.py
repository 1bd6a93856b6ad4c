"""Language-model scoring with an Elias-Fano n-gram trie of order 3.

Tokens are words and one end per document; a document's first word follows an end. The vocabulary is dealt to shards by
hash; a word's id is its rank there plus the words of the shards before. A shard of the trie holds the bigrams of
its first words, and the trigrams below them (very frequent first words are split by the residue of the second, so that no
shard grows with one word). It is built once from the training documents and written into the shared folder as a buffer
that is laid out to be memory-mapped. Each level has its contexts and their monotone pointers into the successors, the
successors themselves made monotone by adding each context's rank times the vocabulary, all in Elias-Fano form, a
16-bit code of each smoothed log probability, and one of each context's back-off. The contexts of the first level are
words; those of the second are places of the first. A query finds its context's range by the pointers and then the
first stored value at or after the successor, relative to the context (successor search in one Elias-Fano bucket).

Smoothing: P(w|v) = (c(vw) + m(c(v)) * P(w)) / (c(v) + m(c(v))); P(w|uv) = (t(uvw) + r(uv) * P(w|v)) / (c(uv) + k(c(uv))) for pairs uv
met ``LEAST_PAIR`` times at least, else P(w|v). t is the count of trigrams met ``LEAST_TRIPLE`` times at least, which alone are
stored, and 0 for others; r(uv) = k(c(uv)) and the counts of the others. m(c) = ``PRIOR`` * c ** ``GROWTH``, k likewise by
``PAIR_PRIOR`` and ``PAIR_GROWTH``, and P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)), so that each context's distribution sums to
one. Everything counted covers all training documents; vocabulary and levels grow with the corpus and stay in shards.

Words are told apart by 64-bit hashes. Odd input: null text is empty and has the end only; a null id counts as an empty
id text for the split; repeated rows are counted and scored each; an empty table gives an empty table; other columns
don't matter. A worker holds the tokens of a chunk (10 MiB of text or one longer text, about 100 bytes for each word).
"""

from __future__ import annotations

import mmap
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import bucketed, dropped, written
from curbline.llm.exchange import CHUNK as CHUNKS
from curbline.llm.exchange import MESSAGE, buckets_of, chunked, messages, per_chunk, per_shard, repacked, shard_of, unpack

#: Strength of the prior for a context met c times: PRIOR * c ** GROWTH; the same for pairs, and least counts of pairs as contexts and of stored trigrams. Set on held-out text of the smaller tables.
PRIOR, GROWTH = 3.0, 0.85
PAIR_PRIOR, PAIR_GROWTH, LEAST_PAIR, LEAST_TRIPLE = 1.0, 0.6, 2, 2
#: Tokens of a context for each residue class of its successors.
CONTEXT_TOKENS = 1 << 16
#: Steps of the probability code per unit of log10: a code is off by a quarter of a hundredth at most.
STEPS = 200
#: Questions for each element from which a sequence is decoded once instead of searched bucket by bucket: one in so many.
BATCH = 4
#: Text bytes of a chunk, and tokens of the corpus per shard.
CHUNK, SHARD_TOKENS, LEAST_SHARDS = 10 << 20, 1 << 20, 32


_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_ZERO_AT = np.array([([k for k in range(8) if not b >> k & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)
_ONE_AT = np.array([([k for k in range(8) if b >> k & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence of integers under 2 ** 56: low bits packed, high bits in unary. Made by ``pack``, read from any buffer."""

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> bytes:
        values = values.astype(np.uint64)
        n = len(values)
        low = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        highs = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(highs[-1]) + 2 if n else 1) + 7 & ~7, np.uint8)
        bits[highs] = 1
        upper = np.packbits(bits, bitorder="little")
        if low:
            each = (values[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
            lower = np.packbits(each.ravel(), bitorder="little")
        else:
            lower = np.zeros(0, np.uint8)
        spare = np.zeros(9 + (-(len(lower) + 9 + len(upper)) % 8), np.uint8)
        return np.array([n, low, len(lower), len(upper)], "<i8").tobytes() + upper.tobytes() + lower.tobytes() + spare.tobytes()

    def __init__(self, buffer, offset: int = 0):
        self.n, self.low, lower, upper = (int(x) for x in np.frombuffer(buffer, "<i8", 4, offset))
        at = offset + 32
        self.upper = np.frombuffer(buffer, np.uint8, upper, at)
        spare = 9 + (-(lower + 9 + upper) % 8)
        # 64 bits from each byte on
        self.lower = np.ndarray((lower + spare - 7,), "<u8", np.frombuffer(buffer, np.uint8, lower + spare, at + upper), 0, (1,))
        self.end = at + upper + lower + spare
        self.ones = np.concatenate([[0], np.cumsum(_ONES[self.upper], dtype=np.int64)])
        self.zeros = 8 * np.arange(upper + 1) - self.ones
        self.decoded = None

    def values(self) -> np.ndarray:
        """The whole sequence, decoded once: for batches that ask for a good part of it."""
        if self.decoded is None:
            places = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
            self.decoded = self._joined(np.arange(self.n), places)
        return self.decoded

    def _joined(self, k: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Elements k, whose high bits end at these places."""
        value = (place - k).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bit = k * self.low
            value |= self.lower[bit >> 3] >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low) - 1)
        return value

    def get(self, k: np.ndarray) -> np.ndarray:
        if len(k) * BATCH >= self.n:
            return self.values()[k]
        byte = np.searchsorted(self.ones, k, "right") - 1
        return self._joined(k, 8 * byte + _ONE_AT[self.upper[byte], k - self.ones[byte]])

    def successor(self, value: np.ndarray) -> np.ndarray:
        """Index of the first element at or after each value; ``n`` if there is none."""
        value = value.astype(np.uint64)
        if len(value) * BATCH >= self.n:
            return np.searchsorted(self.values(), value)
        high = (value >> np.uint64(self.low)).astype(np.int64)
        lo, hi = self._before_zero(high - 1), self._before_zero(high)
        # elements of a bucket are in order: halve until all searches end
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            middle = (lo[todo] + hi[todo]) >> 1
            less = self.get(middle) < value[todo]
            lo[todo[less]] = middle[less] + 1
            hi[todo[~less]] = middle[~less]
            todo = todo[lo[todo] < hi[todo]]
        return lo

    def _before_zero(self, k: np.ndarray) -> np.ndarray:
        """Elements that stand before the k-th zero (from 0) of the upper bits; none before zero -1, all beyond the last."""
        out = np.where(k < 0, 0, self.n).astype(np.int64)
        inside = np.flatnonzero((k >= 0) & (k < self.zeros[-1]))
        h = k[inside]
        byte = np.searchsorted(self.zeros, h, "right") - 1
        zero = 8 * byte + _ZERO_AT[self.upper[byte], h - self.zeros[byte]]
        out[inside] = np.minimum(zero - h, self.n)
        return out


class Level:
    """N-grams of one order: contexts, pointers, context-relative successors, and codes of probabilities and back-offs."""

    @staticmethod
    def pack(context: np.ndarray, successor: np.ndarray, codes: np.ndarray, backoff: np.ndarray, vocabulary: int, universe: int, contexts: np.ndarray | None = None) -> bytes:
        """From pairs sorted by context (under ``universe``) and successor; ``backoff`` has a code for each of ``contexts``, or for each that has pairs."""
        contexts = np.unique(context) if contexts is None else contexts
        pointers = np.append(np.searchsorted(context, contexts), len(context))
        relative = np.searchsorted(contexts, context).astype(np.uint64) * np.uint64(vocabulary) + successor.astype(np.uint64)
        body = b"".join([EliasFano.pack(contexts, universe), EliasFano.pack(pointers, len(context) + 1), EliasFano.pack(relative, len(contexts) * vocabulary), codes.astype("<u2").tobytes(), backoff.astype("<u2").tobytes()])
        return np.array([vocabulary, len(context), len(contexts), len(body)], "<i8").tobytes() + body + bytes(-len(body) % 8)

    def __init__(self, buffer, offset: int = 0):
        self.vocabulary, n, contexts, size = (int(x) for x in np.frombuffer(buffer, "<i8", 4, offset))
        self.contexts = EliasFano(buffer, offset + 32)
        self.pointers = EliasFano(buffer, self.contexts.end)
        self.successors = EliasFano(buffer, self.pointers.end)
        self.codes = np.frombuffer(buffer, "<u2", n, self.successors.end)
        self.backoff = np.frombuffer(buffer, "<u2", contexts, self.successors.end + 2 * n)
        self.end = offset + 32 + size + -size % 8

    def find(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of each context or -1, place of each pair among the codes or -1)."""
        ranks, out = np.full(len(context), -1, np.int64), np.full(len(context), -1, np.int64)
        if not self.contexts.n:
            return ranks, out
        rank = self.contexts.successor(np.maximum(context, 0))
        known = np.flatnonzero((context >= 0) & (rank < self.contexts.n))
        known = known[self.contexts.get(rank[known]) == context[known].astype(np.uint64)]
        r = ranks[known] = rank[known]
        wanted = r.astype(np.uint64) * np.uint64(self.vocabulary) + successor[known].astype(np.uint64)
        begin, end = self.pointers.get(r).astype(np.int64), self.pointers.get(r + 1).astype(np.int64)
        at = self.successors.successor(wanted)
        inside = np.flatnonzero((at >= begin) & (at < end))
        hit = inside[self.successors.get(at[inside]) == wanted[inside]]
        out[known[hit]] = at[hit]
        return ranks, out

    def score(self, context: np.ndarray, successor: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Codes of the pairs: stored, else the context's back-off and the code of the lower order, else that alone."""
        rank, place = self.find(context, successor)
        code = lower.astype(np.int64)
        code[rank >= 0] += self.backoff[rank[rank >= 0]]
        code[place >= 0] = self.codes[place[place >= 0]]
        return np.minimum(code, 65535).astype("<u2")


def mapped(blob: bytes) -> mmap.mmap:
    """A level's bytes in a map of their own, outside the worker's heap."""
    out = mmap.mmap(-1, max(1, len(blob)))
    out[: len(blob)] = blob
    return out


def encode_log(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) * STEPS), 0, 65535).astype("<u2")


def decode_log(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) / -STEPS


def smoothed(count, total, lower, prior: float, growth: float, rest=0) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the probability of successors met ``count`` times after a context met ``total`` times, ``rest`` of them before successors that aren't stored, and of the context's back-off."""
    m = prior * total.astype(np.float64) ** growth
    return encode_log((count + (rest + m) * 10 ** decode_log(lower)) / (total + m)), encode_log((rest + m) / (total + m))


def held_out(id_: int | None, folds: int = 5, fold: int = 1) -> bool:
    return zlib.crc32(str("" if id_ is None else id_).encode()) % folds == fold


def _press(*arrays: np.ndarray) -> bytes:
    """Columns of numbers, compressed each by byte plane."""
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return len(arrays[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def _planes(body: bytes, n: int, *types: str) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        width = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(body, np.uint8, n * width, at).reshape(width, n).T).view(t).ravel())
        at += n * width
    return out


def _unpress(blob: bytes, *types: str) -> list[np.ndarray]:
    return _planes(unpack(blob[8:]), int.from_bytes(blob[:8], "little"), *types)


def _tokens(ends: np.ndarray, data: bytes) -> tuple[np.ndarray, bytes, bytes]:
    """What a chunk stores of its texts: where they end among its tokens, tokens by place of their word, and the words' hashes in order."""
    index: dict[bytes, int] = {b"": 0}
    tokens, stops, a = [], [], 0
    for b in ends.tolist():
        words = data[a:b].lower().split()  # bytes: A-Z, and the six ASCII blanks, only
        for w in words:
            if w not in index:
                index[w] = len(index)
        tokens += map(index.__getitem__, words)
        tokens.append(0)
        stops.append(len(tokens))
        a = b
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in index], np.uint64)
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    token = place[np.array(tokens, np.int64)].astype("<u4")
    return np.array(stops, np.int64), token.view(np.uint8).reshape(-1, 4).T.tobytes(), hashes[order].tobytes()


class Grams:
    """Tokens of a chunk whose words have ids and counts, and its distinct bigrams and trigrams by shard."""

    def __init__(self, c, shards: int):
        self.token = _token(c)
        self.id, self.count = (x.astype(np.int64) for x in _unpress(c.extra, "<u4", "<u4"))
        self.shards, self.begins, self.stops = shards, np.append(0, c.ends[:-1]), c.ends
        self.out = np.array([held_out(i) for i in c.ids], bool)
        self.train = _train(c)
        words = len(self.id)
        context = np.empty(len(self.token), np.int64)
        context[1:] = self.token[:-1]
        context[self.begins] = self.token[self.stops[0] - 1]  # every text ends with the end
        pair, which = np.unique(context * words + self.token, return_inverse=True)
        u, v = pair // words, pair % words
        # by the first word, and a residue of the second where the first is frequent
        residue = (self.id[v] % (1 + self.count[u] // CONTEXT_TOKENS)).astype(np.uint64)
        key = (self.id[u].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ residue * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
        shard = shard_of(key, shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.edges, self.u, self.v, self.pair = np.searchsorted(shard[order], np.arange(shards + 1)), u[order], v[order], place[which]

    def pair_codes(self, got: dict) -> None:
        """Codes of the pairs and whether they are contexts, from the answers of the first level."""
        self.code, self.often = np.zeros(len(self.u), "<u2"), np.zeros(len(self.u), bool)
        for shard, blob in got.items():
            if shard < self.shards:
                part = slice(self.edges[shard], self.edges[shard + 1])
                self.code[part], often = _unpress(blob, "<u2", "u1")
                self.often[part] = often > 0

    def triples(self) -> None:
        """Trigrams of the tokens whose two words before are a context; ``asked``: those tokens."""
        words = len(self.id)
        before = np.empty(len(self.token), np.int64)
        before[1:] = self.pair[:-1]
        before[self.begins] = -1
        self.asked = np.flatnonzero((before >= 0) & self.often[before])
        triple, self.triple = np.unique(before[self.asked] * words + self.token[self.asked], return_inverse=True)
        first = np.zeros(len(triple), np.int64)
        first[self.triple] = self.asked
        # pairs stand by shard, then word: so do the triples
        self.triple_pair, self.w, self.lower = triple // words, triple % words, self.code[self.pair[first]]
        self.triple_edges = np.searchsorted(self.triple_pair, self.edges)


def _token(c) -> np.ndarray:
    return _planes(c.data, len(c.data) // 4, "<u4")[0].astype(np.int64)


def _train(c) -> np.ndarray:
    """Which tokens are in training documents."""
    return np.repeat([not held_out(i) for i in c.ids], np.diff(c.ends, prepend=0))


def _answers(c) -> dict[int, bytes]:
    return dict(zip(c.answers.field("shard").to_pylist(), c.answers.field("blob").to_pylist())) if c.answers is not None else {}


def count_words(_: int, chunks: list[int], blobs: list[bytes]) -> list[tuple[int, bytes]]:
    """Vocabulary at a shard: count and rank of each word asked about; the shard's record (chunk -1) is its tokens, training words and words."""
    parts = [_unpress(b, "<u8", "<u4") for b in blobs]
    word, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    count = np.bincount(which, np.concatenate([n for _, n in parts]), len(word)).astype(np.int64)
    edges = np.cumsum([len(k) for k, _ in parts])[:-1]
    answers = [(c, _press(count[w].astype("<u4"), w.astype("<u4"))) for c, w in zip(chunks, np.split(which, edges))]
    return [*answers, (-1, np.array([count.sum(), (count > 0).sum(), len(word)], "<i8").tobytes())]


def _pack(heads: list[np.ndarray], run: np.ndarray, tails: list[np.ndarray]) -> bytes:
    """N-grams by their context: columns of the contexts (the first ascending), grams of each, and columns of the grams (the first ascending within a context)."""
    first = np.append(0, np.cumsum(run)[:-1])
    step = np.diff(tails[0], prepend=0)
    step[first] = tails[0][first]
    top = _press(np.diff(heads[0], prepend=0).astype("<u4"), *heads[1:], run.astype("<u4"))
    return len(top).to_bytes(8, "little") + top + _press(step.astype("<u4"), *tails[1:])


def _unpack(blob: bytes, heads: tuple, tails: tuple) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(columns of the contexts, repeated for each gram; columns of the grams)."""
    n = int.from_bytes(blob[:8], "little")
    top, below = _unpress(blob[8 : 8 + n], "<u4", *heads, "<u4"), _unpress(blob[8 + n :], "<u4", *tails)
    top[0] = np.cumsum(top[0], dtype=np.int64)
    run = top.pop().astype(np.int64)
    sums = np.cumsum(below[0], dtype=np.int64)
    first = np.append(0, np.cumsum(run)[:-1])
    below[0] = sums - np.repeat(np.where(first > 0, sums[first - 1], 0), run)
    return [np.repeat(x, run) for x in top], below


def _split(sizes: list[int], *arrays: np.ndarray) -> list[bytes]:
    edges = np.cumsum(sizes)[:-1]
    return [_press(*x) for x in zip(*[np.split(a, edges) for a in arrays])]


def _distinct(context: np.ndarray, successor: np.ndarray, times: np.ndarray):
    """(context, successor, times in all, one place of each) of the distinct grams, and which gram each place has."""
    key, first, which = np.unique(context.astype(np.uint64) << np.uint64(32) | successor.astype(np.uint64), return_index=True, return_inverse=True)
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64), np.bincount(which, times, len(key)).astype(np.int64), first, which


def pairs_level(vocabulary: int):
    """First level of a shard: built from its messages, kept (under chunk -2, with the counts of the pairs that are contexts of the second), and asked for each message's pairs: their codes, and whether they are contexts."""

    def run(_: int, chunks: list[int], blobs: list[bytes]) -> list[tuple[int, bytes]]:
        parts = [_unpack(b, ("<u4",), ("<u4", "<u2")) for b in blobs]
        u, total = (np.concatenate(x) for x in zip(*[h for h, _ in parts]))
        v, times, lower = (np.concatenate(x) for x in zip(*[t for _, t in parts]))
        sizes = [len(t[0]) for _, t in parts]
        del parts
        u, v, n, first, which = _distinct(u, v, times)
        total, lower = total[first].astype(np.int64), lower[first]
        seen = np.flatnonzero(n)
        code, backoff = smoothed(n[seen], total[seen], lower[seen], PRIOR, GROWTH)
        starts = np.flatnonzero(np.diff(u[seen], prepend=-1))
        often = np.flatnonzero(n[seen] >= LEAST_PAIR)
        blob = Level.pack(u[seen], v[seen], code, backoff[starts], vocabulary, vocabulary) + EliasFano.pack(often, len(seen)) + n[seen][often].astype("<u4").tobytes()
        level = Level(mapped(blob))
        answers = _split(sizes, level.score(u, v, lower)[which], (n >= LEAST_PAIR)[which].astype("u1"))
        return [*zip(chunks, answers), (-2, blob)]

    return run


def triples_level(chunks: list[int], blobs: list[bytes], first_level: bytes) -> list[tuple[int, bytes]]:
    """Second level of a shard, below its first: built, kept (under chunk -3) and asked likewise."""
    pairs = Level(buffer := mapped(first_level))
    contexts = EliasFano(buffer, pairs.end)
    counts = np.frombuffer(buffer, "<u4", contexts.n, contexts.end)
    parts = [_unpack(b, ("<u4",), ("<u4", "<u2")) for b in blobs]
    u, v = (np.concatenate(x) for x in zip(*[h for h, _ in parts]))
    w, times, lower = (np.concatenate(x) for x in zip(*[t for _, t in parts]))
    sizes = [len(t[0]) for _, t in parts]
    del parts
    pair, which = np.unique(u.astype(np.uint64) << np.uint64(32) | v.astype(np.uint64), return_inverse=True)
    place = pairs.find((pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64))[1]
    place, w, n, first, which = _distinct(place[which], w, times)
    lower = lower[first]
    # each context comes with at least one triple, if only one that isn't stored: its back-off is kept all the same
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    number = np.cumsum(np.diff(place, prepend=-1) != 0) - 1
    total = counts[contexts.successor(place[starts])].astype(np.int64)
    stored = n >= LEAST_TRIPLE
    rest = total - np.bincount(number, np.where(stored, n, 0), len(starts))
    seen = np.flatnonzero(stored)
    code, _ = smoothed(n[seen], total[number[seen]], lower[seen], PAIR_PRIOR, PAIR_GROWTH, rest[number[seen]])
    _, backoff = smoothed(np.zeros(len(starts)), total, np.zeros(len(starts), "<u2"), PAIR_PRIOR, PAIR_GROWTH, rest)
    blob = Level.pack(place[seen], w[seen], code, backoff, pairs.vocabulary, len(pairs.codes), place[starts])
    level = Level(mapped(blob))
    return [*zip(chunks, _split(sizes, level.score(place, w, lower)[which])), (-3, blob)]


def scores(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    raw = chunked(documents, id_col, text_col, CHUNK, pack=_tokens)
    shards = max(LEAST_SHARDS, (raw.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0) // SHARD_TOKENS)

    def send_words(c):
        hashes = np.frombuffer(c.extra, np.uint64)
        count = np.bincount(_token(c)[_train(c)], minlength=len(hashes)).astype("<u4")
        edges = np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))
        yield messages(c.number, {int(k): _press(hashes[edges[k] : edges[k + 1]], count[edges[k] : edges[k + 1]]) for k in np.flatnonzero(np.diff(edges))})

    words = written(per_shard(per_chunk(raw, send_words, MESSAGE), count_words), "vocabulary")
    # one row of three numbers per shard: the shards' sizes are all that the driver learns
    records = sorted((r.shard, np.frombuffer(r.blob, "<i8")) for r in words.where("chunk = -1").select("shard", "blob").collect())
    tokens, distinct = (int(sum(r[k] for _, r in records)) for k in (0, 1))
    before, vocabulary = {}, 0
    for shard, r in records:
        before[shard] = vocabulary
        vocabulary += int(r[2])
    if vocabulary >= 1 << 32:
        raise ValueError("messages hold word ids of 32 bits")
    total = tokens + 0.5 * (distinct + 1)

    def name_words(c):
        """The chunk with ids and counts of its words instead of their hashes."""
        hashes = np.frombuffer(c.extra, np.uint64)
        count, id_ = np.zeros(len(hashes), "<u4"), np.zeros(len(hashes), "<u4")
        edges = np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))
        for shard, blob in _answers(c).items():
            part = slice(edges[shard], edges[shard + 1])
            count[part], rank = _unpress(blob, "<u4", "<u4")
            id_[part] = rank + before[shard]
        yield repacked(c, _press(id_, count))

    chunks = bucketed(per_chunk(raw, name_words, CHUNKS, words.where("chunk >= 0")), "named", "chunk", buckets_of(raw))
    dropped(raw, words)

    def base_log(count):
        return np.log10((count + 0.5) / total)

    def by_context(edges, context, heads, tails):
        """Messages of grams by context, which stand in order."""
        out = {}
        for k in np.flatnonzero(np.diff(edges)):
            s = slice(edges[k], edges[k + 1])
            first = np.flatnonzero(np.diff(context[s], prepend=-1))
            run = np.diff(np.append(first, edges[k + 1] - edges[k]))
            out[int(k)] = _pack([x[s][first] for x in heads], run, [x[s] for x in tails])
        return out

    def send_pairs(c):
        g = Grams(c, shards)
        times = np.bincount(g.pair[g.train], minlength=len(g.u)).astype("<u4")
        base = encode_log(10 ** base_log(g.count))
        yield messages(c.number, by_context(g.edges, g.u, [g.id[g.u], g.count[g.u].astype("<u4")], [g.id[g.v], times, base[g.v]]))

    # the trie's first level lies in buckets by shard, so it isn't moved to meet what the second is made of
    answers = bucketed(per_shard(per_chunk(chunks, send_pairs, MESSAGE), pairs_level(vocabulary)), "pairs", "shard", buckets_of(raw))
    pair_codes = answers.where("chunk >= 0")

    def send_triples(c):
        g = Grams(c, shards)
        g.pair_codes(_answers(c))
        g.triples()
        times = np.bincount(g.triple[g.train[g.asked]], minlength=len(g.w)).astype("<u4")
        u, v = g.id[g.u[g.triple_pair]], g.id[g.v[g.triple_pair]].astype("<u4")
        yield messages(c.number, by_context(g.triple_edges, g.triple_pair, [u, v], [g.id[g.w], times, g.lower]))

    def below(levels: pa.Table, sent: pa.Table) -> pa.Table:
        sent = sent.sort_by("chunk")
        out = triples_level(sent.column("chunk").to_pylist(), sent.column("blob").to_pylist(), levels.column("blob")[0].as_py()) if len(sent) else []
        shard = levels.column("shard")[0].as_py()
        return pa.table([pa.array([shard] * len(out), pa.int64()), pa.array([c for c, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], names=["shard", "chunk", "blob"])

    sent = per_chunk(chunks, send_triples, MESSAGE, pair_codes)
    triple_codes = written(answers.where("chunk = -2").groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(below, MESSAGE), "triples")

    def add_up(c):
        g = Grams(c, shards)
        got = _answers(c)
        g.pair_codes(got)
        g.triples()
        best = decode_log(g.code)[g.pair]
        code = np.zeros(len(g.w), "<u2")
        for shard, blob in got.items():
            if shard >= shards:
                code[g.triple_edges[shard - shards] : g.triple_edges[shard - shards + 1]] = _unpress(blob, "<u2")[0]
        best[g.asked] = decode_log(code)[g.triple]
        sums = [np.add.reduceat(x, g.begins) for x in (np.ones(len(g.token), np.int64), (g.count > 0)[g.token].astype(np.int64), base_log(g.count)[g.token], best)]
        yield pa.RecordBatch.from_arrays([pa.array(c.ids, pa.int64()), pa.array(g.out), pa.array(sums[0]), pa.array(sums[1]), pa.array(np.full(len(c.ids), tokens)), pa.array(sums[2]), pa.array(sums[3])], names=names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    every = pair_codes.unionByName(triple_codes.where("chunk >= 0").withColumn("shard", F.col("shard") + shards))
    return per_chunk(chunks, add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", every)


def query(spark, sf_dir):
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
