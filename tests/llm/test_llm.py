"""Corpus operators against brute force, round trips and held-out accuracy; odd input of every kind."""

import collections
import hashlib
import json
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import exact_dedup, exchange, ngram_join, ngram_trie, packing, sentencepiece_codec, suffix_dedup, tool_calls, toxicity, transport_stream, url_filter
from curbline.llm.tokens import byte_bpe

SF = "/root/testdata/sf0.001"
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, copies, repeated rows, equal ids, and columns with the operators' own names."""
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    near = [f"w{k}" for k in range(120)]
    texts = [None, "", " \t\n", "one", "One", "two words", long, long.upper(), "é" * 300, "a" * 450, " ".join(near), " ".join(near[:-1]), " ".join(near[:60] + ["x"] + near[60:]), "<|endoftext|> <s> ▁ \0", "x", "x"]
    data = [(k if k != 5 else None, t, "c", k, "s") for k, t in enumerate(texts)] + [(15, "x", "c", 1, "s")]
    return spark.createDataFrame(data, "doc_id long, text string, chunk string, shard long, `_row` string").repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_sentencepiece_is_the_library(spark, odd, none):
    import sentencepiece

    model = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    want = collections.Counter()
    for i, t in texts_of(docs):
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        want[i, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(sp.decode(ids).encode())] += 1
    got = sentencepiece_codec.round_trip(docs, model)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == want
    assert sentencepiece_codec.round_trip(none, model).count() == 0


def test_sentencepiece_spans_and_decode(spark):
    model, codec = P.path("piece_bpe_32k.model"), sentencepiece_codec.Codec(P.path("piece_bpe_32k.model"))
    rnd = random.Random(0)
    for _ in range(300):
        text = "".join(rnd.choice(["a", " ", "  ", "é", "foo bar", "\n", "日", "▁", "🙂", "<s>", "<0x41>"]) for _ in range(rnd.randint(0, 12)))
        ids, begin, end = codec.encode(text)
        assert (begin[1:] == end[:-1]).all() and end[-1] == len(text.encode())
        pieces = codec.model.encode(text, return_type="proto").pieces
        if not any(p.piece.startswith("<0x") for p in pieces):
            assert [(p.begin, p.end) for p in pieces] == list(zip(begin[1:-1].tolist(), end[1:-1].tolist()))
    df = spark.createDataFrame([(1, "Hello  world")], "doc_id long, text string")
    assert sentencepiece_codec.decode(sentencepiece_codec.encode(df, model), model).first().text == codec.decode(codec.model.encode("Hello  world"))


def test_normaliser_is_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    m = pb.ModelProto()
    m.ParseFromString(library.serialized_model_proto())
    s = m.normalizer_spec
    own = sentencepiece_codec.Normalizer(s.precompiled_charsmap, s.add_dummy_prefix, s.remove_extra_whitespaces, s.escape_whitespaces)
    rnd = random.Random(0)
    for _ in range(500):
        text = "".join(rnd.choice(["a", " ", "  ", "é", "ﬁ", "①", "Ａ", "㌀", "\t", "日", "ｶﾞ", "½", "▁"]) for _ in range(rnd.randint(0, 12)))
        out, source = own.normalize(text)
        assert library.normalize(text) == out.decode() and len(source) == len(out) + 1 and (np.diff(source) >= 0).all()


def test_urls_by_rule_and_list(spark):
    urls = [None, "no scheme", "http://Example.ORG/es/1", "http://a.example.org/en/12?x", "https://www.b.com/fr/", "https://b.com/de/x#y", "http://c.net/p/", "http://www.c.net/p", "http://c.net/q", "http://c.net", "http://badexample.org?/es/", "http://c.net/q"]
    pages = spark.createDataFrame([(k, u, "z") for k, u in enumerate(urls)], "page_id long, url string, block string")
    listed = spark.createDataFrame([("c.net/p",), (None,), ("c.net/p",)], "canonical string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, listed, "canonical").collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("example.org", "/es/1", "example.org/es/", "block"), 3: ("a.example.org", "/en/12", "example.org/en/1", "block"),
        4: ("www.b.com", "/fr/", "com/fr/", "allow"), 5: ("b.com", "/de/x", "com/de/", "block"), 6: ("c.net", "/p/", None, "block"), 7: ("www.c.net", "/p", None, "block"), 8: ("c.net", "/q", None, "allow"),
        9: ("c.net", "", None, "allow"), 10: ("badexample.org", "", None, "allow"), 11: ("c.net", "/q", None, "allow"),
    }
    assert url_filter.judge_urls(pages.where("false"), listed.where("false"), "canonical").count() == 0


def test_listed_flag_carries_any_column(spark):
    rows = spark.createDataFrame([(1, "u", "a", "b"), (2, None, "c", "d"), (3, "v", None, "e"), (1, "u", "a", "b")], "id long, `_on` string, block string, w0 string")
    got = url_filter.listed_flag(rows, "_on", spark.createDataFrame([("u",), (None,)], "block string"), "block", "id")
    assert got.columns == [*rows.columns, "_listed"]
    assert sorted((r.id, r.block or "", r.w0, r._listed or False) for r in got.collect()) == [(1, "a", "b", True), (1, "a", "b", True), (2, "c", "d", False), (3, "", "e", False)]


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("k"))
    rows = keys.unionByName(keys.select(F.concat(F.lit("v"), "k").alias("k"))).withColumn("id", F.monotonically_increasing_id())
    found = url_filter.listed_flag(rows, "k", keys, "k", "id").where("_listed").select("k")
    assert found.count() == 5000 and found.exceptAll(keys).count() == 0


def brute_groups(docs, keep):
    groups = collections.defaultdict(list)
    for i, t in docs:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, keep(known) if known else None, len(ids), sha(text)) for i in ids]
    return collections.Counter(out)


def test_exact_dedup(spark, odd, none):
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    got = exact_dedup.dedup(docs, keep="max").collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_groups(texts_of(docs), max)
    per = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(per.values()) == {1} and len(per) == len({r.text_sha256 for r in got})
    kept = exact_dedup.kept_rows(odd)
    assert kept.columns == odd.columns and kept.count() == len({(t or "").encode().lower() for _, t in texts_of(odd)})
    assert exact_dedup.dedup(none).count() == 0


@pytest.mark.parametrize("prefix", [b"", b"<html><head>"])
def test_patricia_trie_gives_up_subtrees(prefix):
    rnd, want, held = random.Random(0), collections.Counter(), []
    keys = [prefix + bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 9))) for _ in range(4000)]
    want.update(keys)
    work, got, passes = [[(k, [k]) for k in keys]], collections.Counter(), 0
    while work:
        passes += 1
        spilled = collections.defaultdict(list)
        items = work.pop()
        trie = exact_dedup.PatriciaTrie(lambda a, b: (a or []) + b, 20_000, lambda subtree, rest, value: spilled[subtree].append((rest, value)))
        for key, value in items:
            trie.insert(key, value)
            held.append(trie.bytes)
        got.update({v[0]: len(v) for v in trie.values()})
        work += spilled.values()
    assert passes > 1 and max(held) < 22_000
    assert got == want


def test_exact_dedup_in_passes(spark):
    rnd = random.Random(7)
    texts = ["<html>" + "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 8))) for _ in range(900)]
    docs = spark.createDataFrame([(k if k % 50 else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    for budget in (1 << 20, 3000):
        got = exact_dedup.dedup(docs, keep="max", budget=budget).collect()
        assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_groups(texts_of(docs), max)
        assert sum(r.kept for r in got) == len(set(texts))


def test_toxicity_held_out(spark, none):
    rnd = random.Random(1)
    clean = [f"c{k}" for k in range(400)]
    bad = ["vilest", "vilemost", "dreadly", "dreadest", "grimmer"]
    text = lambda y: " ".join(rnd.choices(clean, k=60) + (rnd.sample(bad, rnd.randint(2, 4)) if y else []))
    rows = [(k, text(k % 3 == 0), int(k % 3 == 0)) for k in range(900)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k < 600] + [(5000, 1), (None, 0), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.thetas == sorted(model.thetas)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[k].toxic == (y == 1) for k, _, y in rows if k >= 600) >= 297
    assert not got[9000].toxic and got[9000].severity == got[9001].severity
    assert {r.doc_id for r in toxicity.keep_clean(docs, model).collect()} == {i for i, r in got.items() if not r.toxic}
    assert toxicity.fit(docs, labels.where("false")).severity(5.0)[0] < 1e-6
    assert toxicity.score(none, model).count() == 0


def test_ordinal_fit_is_the_likeliest():
    """The fitted weights and thresholds leave nothing to gain: no small step lowers the penalised likelihood."""
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 2, (300, 4)).astype(float)
    z = x @ np.array([1.5, -0.5, 0.8, 0.0]) + rnd.logistic(size=300)
    y = (z > 0.5).astype(int) + (z > 2)
    trust = np.array([1.0, 0.5, 1.0, 0.7])
    model = toxicity.fit_ordinal([(int(g), np.flatnonzero(r), r[r > 0] * trust[r > 0]) for g, r in zip(y, x)], np.arange(4), trust, steps=4000)
    w, t = np.array([model.weights.get(k, 0.0) for k in range(4)]), np.array(model.thetas)

    def loss(w, t):
        cdf = np.concatenate([np.zeros((300, 1)), 1 / (1 + np.exp(-(t[None] - (x @ w)[:, None]))), np.ones((300, 1))], 1)
        return -np.log(cdf[np.arange(300), y + 1] - cdf[np.arange(300), y]).sum() + 0.2 * ((w / trust) ** 2).sum()

    best = loss(w, t)
    for k in range(6):
        for step in (-0.05, 0.05):
            v, u = w.copy(), t.copy()
            (v if k < 4 else u)[k % 4] += step
            assert loss(v, u) > best - 1e-6
    for s in (-3.0, 0.0, 2.0):  # expected severity is the sum of grades by their probabilities
        above = [1 / (1 + math.exp(h - s)) for h in model.thetas]
        p = [1 - above[0], above[0] - above[1], above[1]]
        assert model.severity(s) == (pytest.approx(p[1] + 2 * p[2]), int(np.argmax(p)))


def test_toxicity_of_odd_input(spark, odd):
    labels = spark.createDataFrame([(k, k % 2) for k in range(16)] + [(3, 0), (None, 1)], "doc_id long, toxic int")
    rows = odd.withColumn("_id", F.lit(7)).withColumn("_y", F.lit("y"))
    model = toxicity.fit(rows, labels)
    got = toxicity.score(rows, model).collect()
    assert len(got) == rows.count() and sorted(r.doc_id for r in got if r.doc_id == 15) == [15, 15]
    kept = toxicity.keep_clean(rows, model)
    assert kept.columns == rows.columns


def test_transport_streams(spark, odd, none):
    stored = transport_stream.store(odd)
    got = transport_stream.features(stored).collect()
    want = collections.Counter()
    for i, t in texts_of(odd):
        n, p = transport_stream.padded(t)
        want[i, n, len(p), sha(p), zlib.crc32(p[-16:])] += 1
    assert collections.Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    long = max(got, key=lambda r: r.media_bytes)
    assert long.timestamps == [3600 * k for k in range(len(long.timestamps))] and len(long.random_access) == -(-len(long.timestamps) // transport_stream.EVERY)
    assert transport_stream.features(transport_stream.store(none)).count() == 0


@pytest.mark.parametrize("n", [1, 150, 168, 169, 170, 171, 184, 350, 352, 353, 9215, 9216, 9217, 50_000])
def test_stream_lengths_and_damage(n):
    data = random.Random(n).randbytes(n)
    media = transport_stream.mux(data)
    assert transport_stream.demux(media)[0] == data and len(media) % 188 == 0
    if len(media) > 5 * 188:
        with pytest.raises(ValueError, match="continuity"):
            transport_stream.demux(media[: 3 * 188] + media[4 * 188 :])
        again = media[: 4 * 188] + media[3 * 188 : 4 * 188] + media[4 * 188 :]  # a packet may come twice, not three times
        assert transport_stream.demux(again)[0] == data
        with pytest.raises(ValueError, match="continuity"):
            transport_stream.demux(again[: 4 * 188] + media[3 * 188 : 4 * 188] + again[4 * 188 :])
    with pytest.raises(ValueError):
        transport_stream.demux(b"\0" + media[1:])
    # every unit begins with the clock, which runs with its time
    packets = np.frombuffer(media, np.uint8).reshape(-1, 188)
    heads = packets[(packets[:, 1] & 0x40 != 0) & (packets[:, 3] & 0x20 != 0)]
    bases = [int(p[6]) << 25 | int(p[7]) << 17 | int(p[8]) << 9 | int(p[9]) << 1 | int(p[10]) >> 7 for p in heads]
    assert (heads[:, 5] & 0x10 != 0).all() and bases == transport_stream.demux(media)[1]


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = odd.where("doc_id is null or doc_id < 15").select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    want = {i: np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts_of(docs)}
    pieces, sequences, padding = collections.defaultdict(list), collections.defaultdict(list), 0
    for r in packing.pack(docs).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == want.keys()
    for i, own in pieces.items():
        own.sort(key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == want[i].tobytes() and {r.doc_tokens for r in own} == {len(want[i])}
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own[:-1]]]).tolist()
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        fill = sum(r.length for r in own)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own[:-1]]]).tolist() and fill <= 1024
        padding += 1024 - fill if fill & fill - 1 else 0
    assert padding < 0.01 * sum(map(len, want.values()))
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("long_share", [0, 0.1, 0.3, 1])
def test_bins_hold_whole_documents_of_their_class(long_share):
    rnd, packer, lengths = random.Random(6), packing.Packer(3), []
    for k in range(4000):
        lengths.append(rnd.randint(1025, 5000) if rnd.random() < long_share else min(1024, int(rnd.lognormvariate(5.5, 0.9)) + 1))
        packer.add(k, lengths[-1])
        assert len(packer.waiting) <= packing.KEPT + 1 and len(packer.fillers) <= packing.KEPT
        assert all(len(v) < c and all(1024 // n == c for _, _, n in v) for c, v in packer.open.items())
    packer.close()
    pieces, fill = collections.defaultdict(list), collections.Counter()
    for item, start, n, sequence, offset in packer.rows:
        pieces[item].append((start, n))
        assert offset == fill[sequence] and sequence >> packing.LOCAL_BITS == 3
        fill[sequence] += n
    for k, n in enumerate(lengths):
        own = sorted(pieces[k])
        assert [s for s, _ in own] == [0, *np.cumsum([m for _, m in own])[:-1].tolist()] and sum(m for _, m in own) == n
    assert all(n == 1024 or n & n - 1 == 0 for n in fill.values())
    short = [len(pieces[k]) for k, n in enumerate(lengths) if n <= 1024]
    assert not short or sum(short) / len(short) <= (1.5 if long_share < 0.2 else 1.1)


def test_byte_bpe_is_the_library():
    from tokenizers import Tokenizer

    tokenizer, encode, rnd = Tokenizer.from_file(P.path("byte_bpe_50k.json")), byte_bpe(P.path("byte_bpe_50k.json")), random.Random(1)
    for _ in range(2000):
        text = "".join(rnd.choice([" ", "  ", "\n", " \n", "\t", "a", "foo", "'s", "'", "12", "é", "　", ".", "<|endoftext|>"]) for _ in range(rnd.randint(0, 14)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def brute_masks(texts, length):
    seen = collections.Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    for b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        yield gone


def brute_kept(texts, length):
    for b, gone in zip(texts, brute_masks(texts, length)):
        yield bytes(x for x, g in zip(b, gone) if not g)


def brute_removals(texts, length):
    for b, gone, kept in zip(texts, brute_masks(texts, length), brute_kept(texts, length)):
        yield len(b), len(b) - len(kept), sum(g and not h for g, h in zip(gone, b"\0" + gone)), sha(kept)


@pytest.mark.parametrize("hot", [4, 512])
def test_suffix_dedup(spark, odd, none, hot, monkeypatch):
    if hot == 4:
        for name, value in (("HOT", 4), ("HOTTEST", 15), ("SLICE", 2000), ("BLOCK", 700)):
            monkeypatch.setattr(suffix_dedup, name, value)
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(150, 900))) for _ in range(12)]
    texts = [None, "", "é" * 150, "a" * 500, "a" * 200, "ab" * 300, "x" * 199, "x" * 199]
    for _ in range(120):
        cuts = [(b, rnd.randint(0, len(b) // 2)) for b in rnd.choices(base, k=rnd.randint(1, 4))]
        texts.append("".join(b[i : rnd.randint(i, len(b))] + "".join(rnd.choices("xyz", k=rnd.randint(0, 6))) for b, i in cuts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removals(df).collect()}
    assert got == dict(enumerate(brute_removals([(t or "").encode() for t in texts], 200)))
    if hot == 512:
        rows = texts_of(odd)
        want = collections.Counter((i, *w) for (i, _), w in zip(rows, brute_removals([(t or "").encode() for _, t in rows], 200)))
        assert collections.Counter(map(tuple, suffix_dedup.removals(odd).collect())) == want
        assert suffix_dedup.removals(none).count() == 0
        kept = suffix_dedup.kept_texts(odd)
        assert kept.columns == odd.columns and [f.dataType for f in kept.schema] == [f.dataType for f in odd.schema]
        left = collections.Counter((r.doc_id, r.chunk, r.shard, sha(r.text.encode())) for r in kept.collect())
        assert left == collections.Counter((r.doc_id, r.chunk, r.shard, w[3]) for r, w in zip(odd.collect(), brute_removals([(t or "").encode() for _, t in rows], 200)))


def test_passages_at_every_distance():
    """Windows of hot grams are split by what they have in common: all of them, and equal ones alike."""
    rnd = random.Random(8)
    passage = bytes(rnd.choice(b"abcdefghij") for _ in range(700))
    data = bytes(rnd.choice(b"abcdefghij") for _ in range(90)) + passage + bytes(rnd.choice(b"abcdefghij") for _ in range(90)) + passage
    h, first, last, anchor = suffix_dedup.anchors(np.frombuffer(data, np.uint8), np.array([len(data)]), 200)
    assert [w for a, b in zip(first, last) for w in range(a, b + 1)] == list(range(len(data) - 199))
    for heat in (0, 1, 2):
        sent = list(suffix_dedup.stretches(data, h, first, last, anchor, np.full(len(h), heat), 200))
        assert sorted(w for _, _, a, b in sent for w in range(a, b - 199)) == list(range(len(data) - 199))
        found = np.zeros(len(data), bool)
        for (_, _, a, b), f in zip(sent, suffix_dedup.compare([k for k, *_ in sent], [d for _, d, _, _ in sent], [1] * len(sent), [data[a:b] for _, _, a, b in sent], 200)):
            found[a : b - 199] |= f
        seen = collections.Counter(data[w : w + 200] for w in range(len(data) - 199))
        assert [seen[data[w : w + 200]] > 1 for w in range(len(data) - 199)] == found[: len(data) - 199].tolist()


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def brute_components(docs, n, percent):
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                parent[top(a)] = top(b)
    least = collections.defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[top(k)].append(i)
    low = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    return collections.Counter((i, len(sets[k]), low[top(k)]) for k, (i, _) in enumerate(docs))


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (2, 50)])
def test_ngram_join(spark, odd, none, words, percent):
    rnd = random.Random(5)
    base = [[f"w{rnd.randint(0, 400)}" for _ in range(rnd.randint(3, 90))] for _ in range(8)]
    made = []
    for _ in range(110):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 1, 2, 4, 9])):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 9)}"
        made.append(" ".join(w))
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(k + 100, t) for k, t in enumerate(made)], "doc_id long, text string"))
    got = collections.Counter(map(tuple, ngram_join.groups(docs, words=words, percent=percent).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute_components(texts_of(docs), words, percent)
    if words == 4:
        assert ngram_join.groups(none).count() == 0


def test_prefix_tree_finds_all_links(monkeypatch):
    rnd = random.Random(2)
    base = [rnd.sample(range(90), rnd.randint(1, 60)) for _ in range(6)]
    sets = []
    for _ in range(240):
        s = set(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 5])):
            s.symmetric_difference_update([rnd.randrange(90)])
        sets.append(np.array(sorted(s) or [0], np.uint64))
    size, node = np.array([len(s) for s in sets]), np.arange(240) * 7 % 240
    every = np.ones(240, bool)
    for percent, frontier, stride in ((30, 50, 3), (85, 400_000, 32), (100, 1, 1)):
        monkeypatch.setattr(ngram_join, "FRONTIER", frontier)
        monkeypatch.setattr(ngram_join, "STRIDE", stride)
        key = [k % 3 for k in range(240)]
        a, b = (node[x] for x in ngram_join._tree_pairs(key, sets, size, size, node, node, every, every, percent, True))
        want = {(max(node[i], node[j]), min(node[i], node[j])) for i in range(240) for j in range(i) if key[i] == key[j] and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
        assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)
        # what is cut off may only add pairs
        cut = [s[: ngram_join.prefix_length(len(s), percent)] for s in sets]
        a, b = (node[x] for x in ngram_join._tree_pairs(key, cut, size, size, node, node, every, every, percent, True))
        assert set(zip(a.tolist(), b.tolist())) >= want


def test_parities_lose_no_link(monkeypatch):
    monkeypatch.setattr(ngram_join, "FRONTIER", 100)
    rnd = random.Random(4)
    base = [rnd.sample(range(1 << 40), rnd.randint(1, 400)) for _ in range(5)]
    sets = []
    for _ in range(150):
        s = rnd.choice(base)
        sets.append(np.unique(np.array([x if rnd.random() > 0.06 else rnd.randrange(1 << 40) for x in s], np.uint64)))
    size, node = np.array([len(s) for s in sets]), np.arange(150)
    maps = np.stack([ngram_join.parities(x) for x in sets])
    number, role = np.arange(150) % 4, np.arange(150) % 3
    got = {(x, y) for a, b in ngram_join.possible_pairs(number, maps, role, node, size, size, node, 85) for x, y in zip(a.tolist(), b.tolist())}
    pairs = {(i, j) for i in range(150) for j in range(i) if number[i] == number[j] and role[i] != 1 and role[j] < 2}
    want = {(i, j) for i, j in pairs if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert want and want <= got <= pairs and len(got) < len(pairs) / 2


def test_prefixes_are_moved_once_to_their_trees(spark, monkeypatch):
    plans, trees = [], ngram_join._grouped_trees

    def seen(rows, *rest):
        if "parities" in rows.columns:
            assert rows.where("part >= many").isEmpty()
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return trees(rows, *rest)

    monkeypatch.setattr(ngram_join, "_grouped_trees", seen)
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(k, " ".join(words[:k] + ["x"] + words[k:])) for k in range(12)], "doc_id long, text string")
    ngram_join.groups(docs).count()
    assert len(plans) == 1
    assert "prefix" in plans[0] and "Window" not in plans[0]  # a window over groups would deal whole prefixes by them first


def test_chunks_come_to_buckets_in_turn(spark):
    numbers = [n for task in range(5) for n, _ in zip(exchange.chunk_numbers(task, 12), range(30))]
    assert len(set(numbers)) == 150
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select(F.pmod(F.hash("n"), F.lit(12)).alias("b")).groupBy("b").count().collect()
    assert len(found) == 12 and max(r["count"] for r in found) <= 15
    chunks = exchange.chunked(spark.createDataFrame([(k, "x" * 50) for k in range(60)], "i long, t string").repartition(6), "i", "t", 300)
    answers = spark.createDataFrame([(n, 1) for n in numbers], "chunk long, a int")
    plan = exchange.per_chunk(chunks, lambda c: iter(()), "chunk long", answers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(chunk") == 1  # of the answers only


def test_elias_fano():
    rnd = np.random.default_rng(0)
    for n, u in ((0, 10), (1, 1), (1, 1000), (50, 60), (3000, 40), (5000, 10**6), (777, 2**45)):
        v = np.sort(rnd.integers(0, u, n)).astype(np.uint64)
        e = ngram_trie.EliasFano(ngram_trie.EliasFano.pack(v, u))
        q = np.concatenate([rnd.integers(0, u + 5, 500).astype(np.uint64), v, v + np.uint64(1)])
        assert (e.get(np.arange(n)) == v).all() and (e.successor(q) == np.searchsorted(v, q)).all()


def test_language_model(spark, odd, none, monkeypatch):
    monkeypatch.setattr(ngram_trie, "CONTEXT_TOKENS", 50)
    docs = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    rows = [(i, (t or "").encode().lower().split() + [b""]) for i, t in texts_of(docs)]
    count, pair, triple = collections.Counter(), collections.Counter(), collections.Counter()
    out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1
    for i, w in rows:
        if not out(i):
            count.update(w)
            pair.update(zip([b"", *w], w))
            triple.update(zip([b"", *w], w, w[1:]))
    n = sum(count.values())
    base = lambda x: (count[x] + 0.5) / (n + 0.5 * (len(count) + 1))

    def p2(v, x):
        prior = ngram_trie.PRIOR * count[v] ** ngram_trie.GROWTH
        return (pair[v, x] + prior * base(x)) / (count[v] + prior) if count[v] else base(x)

    stored = collections.Counter({k: n for k, n in triple.items() if n >= ngram_trie.LEAST_TRIPLE})
    kept = collections.Counter()
    for (u, v, _), times in stored.items():
        kept[u, v] += times

    def p(u, v, x):
        c = pair[u, v]
        prior = ngram_trie.PAIR_PRIOR * c**ngram_trie.PAIR_GROWTH
        return (stored[u, v, x] + (c - kept[u, v] + prior) * p2(v, x)) / (c + prior) if u is not None and c >= ngram_trie.LEAST_PAIR else p2(v, x)

    key = lambda r: (str(r[0]), *r[1:])
    want = sorted(((i, out(i), len(w), sum(count[x] > 0 for x in w), n, sum(math.log10(base(x)) for x in w), sum(math.log10(p(u, v, x)) for u, v, x in zip([None, b"", *w], [b"", *w], w))) for i, w in rows), key=key)
    got = sorted(map(tuple, ngram_trie.scores(docs.withColumn("shard", F.lit("x")).withColumn("chunk", F.lit(1))).collect()), key=key)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and abs(a[6] - b[6]) < 1.5 / ngram_trie.STEPS * b[2]
    two = sum(math.log10(p2(v, x)) for i, w in rows if out(i) for v, x in zip([b"", *w], w))
    assert sum(r[6] for r in got if r[1]) > two > sum(r[5] for r in got if r[1])  # the third order tells more of held-out texts
    assert ngram_trie.scores(none).count() == 0


def test_trie_levels_sum_to_one():
    rnd = np.random.default_rng(1)
    u, v = np.divmod(np.unique(rnd.integers(0, 400, 150)), 20)
    n = rnd.integers(1, 9, len(u))
    total = np.bincount(u, n, 20)[u]
    lower = ngram_trie.encode_log(np.full(20, 1 / 20))
    code, backoff = ngram_trie.smoothed(n, total, lower[v], 3.0, 0.85)
    first = np.flatnonzero(np.diff(u, prepend=-1))
    buffer = bytes(16) + ngram_trie.Level.pack(u, v, code, backoff[first], 20, 20)
    level = ngram_trie.Level(ngram_trie.mapped(buffer), 16)
    assert level.end == len(buffer)
    for c in range(-1, 22):
        p = 10 ** ngram_trie.decode_log(level.score(np.full(20, c), np.arange(20), lower))
        assert p.sum() == pytest.approx(1, abs=2 / ngram_trie.STEPS)


def test_tool_calls(spark):
    calls = spark.createDataFrame([(1, "a", 0, "f", '{"x":1}', ["b"]), (1, "b", 1, "f", '{"y": "é", "x":"z"}', []), (1, "c", 2, "f", "{", ["d"]), (1, "d", 3, "f", None, ["c"]), (1, "a", 5, "f", "{}", []), (2, None, 0, "g", '{"b":1,"a":[ ]}', None)], "conv_id long, call_id string, turn long, name string, arguments string, after array<string>")
    results = spark.createDataFrame([(1, "a", 9, "R"), (1, "a", 8, "Q"), (1, "b", 2, None), (1, "zz", 2, "q")], "conv_id long, call_id string, turn long, content string")
    schema = {"f": {"type": "object", "properties": {"x": {"type": "integer"}}}}
    got = sorted(((r.call_id or "", r.status, r.level, len(r.errors), r.json) for r in tool_calls.link_calls(calls, results, schema).collect()))
    assert [g[:4] for g in got] == [("", "missing", 0, 0), ("a", "duplicate", 1, 0), ("a", "ok", 1, 0), ("b", "ok", 0, 1), ("c", "cyclic", 0, 1), ("d", "cyclic", 0, 1)]
    assert got[2][4] == '{"arguments":{"x":1},"id":"a","name":"f","result":"Q"}' and got[0][4] == '{"arguments":{"a":[],"b":1},"id":null,"name":"g","result":null}'
    assert tool_calls.link_calls(calls.where("false"), results.where("false"), schema).count() == 0


def test_repeated_and_absent_identifiers_keep_their_own_call(spark):
    calls = spark.createDataFrame(
        [(1, "a", 0, "f", '{"x":1}', []), (1, "a", 5, "g", '{"x":"z"}', []), (1, "a", 5, "g", '{"x":"z"}', []), (1, None, 2, "f", '{"x":2}', []), (1, None, 3, "f", '{"x":"y"}', []), (2, "p", 0, "f", "{}", ["q"]), (2, "q", 1, "f", "{}", []), (2, None, 2, "f", None, None), (3, "a", 0, None, None, None), (3, "a", 0, None, None, None)],
        "conv_id long, call_id string, turn long, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([(1, "a", 9, "R")], "conv_id long, call_id string, turn long, content string")
    schema = {k: {"type": "object", "properties": {"x": {"type": "integer"}}} for k in "fg"}
    got = collections.Counter((r.conv_id, r.call_id, r.turn, r.level, r.status, len(r.errors), r.result_turn, json.loads(r.json)["arguments"] == {"x": "z"}, json.loads(r.json)["name"]) for r in tool_calls.link_calls(calls, results, schema).collect())
    want = [(1, "a", 0, 0, "ok", 0, 9, False, "f"), (1, "a", 5, 0, "duplicate", 1, None, True, "g"), (1, "a", 5, 0, "duplicate", 1, None, True, "g"), (1, None, 2, 0, "missing", 0, None, False, "f"), (1, None, 3, 0, "missing", 1, None, False, "f")]
    want += [(2, "p", 0, 1, "missing", 0, None, False, "f"), (2, "q", 1, 0, "missing", 0, None, False, "f"), (2, None, 2, 0, "missing", 1, None, False, "f"), (3, "a", 0, 0, "missing", 1, None, False, None), (3, "a", 0, 0, "duplicate", 1, None, False, None)]
    assert got == collections.Counter(want)


def brute_levels(after):
    """Longest chains of references; calls that can't be ordered are left out."""
    level, left = {}, {k: {n for n in v if n in after} for k, v in after.items()}
    while ready := [k for k, v in left.items() if all(n in level for n in v)]:
        for k in ready:
            level[k] = 1 + max((level[n] for n in left[k]), default=-1)
        left = {k: v for k, v in left.items() if k not in level}
    return level


def test_levels_of_random_graphs(spark):
    rnd, rows, want = random.Random(9), [], {}
    for conv in range(12):
        n = 30
        after = {f"c{k}": [f"c{rnd.randrange(k) if k and rnd.random() < 0.9 else rnd.randrange(n + 3)}" for _ in range(rnd.choice([0, 1, 1, 1, 1, 2, 3]))] for k in range(n)}
        rows += [(conv, k, v) for k, v in after.items()]
        want |= {(conv, k): x for k, x in brute_levels(after).items()}
    # a chain that no number of single rounds would reach, in either direction, and a circle
    rows += [(90, f"c{k}", [f"c{k - 1}"] if k else None) for k in range(700)] + [(91, f"c{k}", [f"c{(k + 1) % 9}"]) for k in range(9)]
    want |= {(90, f"c{k}"): k for k in range(700)}
    got = {(r.conv_id, r.call_id): r.level for r in tool_calls.levels(spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>")).collect()}
    assert {k for k, v in got.items() if v is None} == {(c, k) for c, k, _ in rows} - want.keys() and len(got) == len(rows)
    assert {k: v for k, v in got.items() if v is not None} == want


def test_arguments_that_json_or_python_refuses(spark):
    deep, wide = "[" * 200_000 + "]" * 200_000, "x" * 3_000_000
    cases = ['{"x":"\\ud800"}', deep, '{"x":NaN}', "1e400", '{"x":Infinity}', json.dumps({"x": wide}), "9" * 5000, '{"a":1}', '{"b":"y"}']
    calls = spark.createDataFrame([(1, f"c{k}", k, "f", a, None, "z") for k, a in enumerate(cases)], "conv_id long, call_id string, turn long, name string, arguments string, after array<string>, level string")
    results = spark.createDataFrame([(1, "c0", 1, "R", 5)], "conv_id long, call_id string, turn long, content string, status int")
    schema = {"f": {"properties": {"a": {"type": "date"}, "b": {"type": "string", "pattern": "("}}}}
    got = {r.turn: r for r in tool_calls.link_calls(calls, results, schema).collect()}
    assert [list(got[k].errors) for k in range(9)] == [[], ["$: nested too deep"], ["$: not JSON"], ["$: not JSON"], ["$: not JSON"], [], ["$: not JSON"], ["$.a: not of type date"], ["$.b: the schema's pattern is none"]]
    assert got[0].json == '{"arguments":{"x":"\\ud800"},"id":"c0","name":"f","result":"R"}' and json.loads(got[5].json)["arguments"]["x"] == wide
    assert all(json.loads(r.json)["id"] == r.call_id for r in got.values())
    assert not tool_calls.schema_errors(1, {"enum": [1]}) and tool_calls.schema_errors(True, {"enum": [1]})


def test_transcripts_by_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    turns = {(r.conv_id, r.turn): r for r in rows}
    want = collections.Counter()
    level = lambda c, t: 1 + level(c, t - 2) if (c, t - 2) in turns and turns[c, t - 2].role == "user" and t >= 2 else 0
    for (c, t), r in turns.items():
        if r.role == "user":
            arguments = {"prompt": r.text} | ({"previous": f"{c}-{t - 2}"} if t >= 2 else {})
            answer = turns.get((c, t + 1))
            found = answer is not None and answer.role == "assistant"
            want[c, f"{c}-{t}", level(c, t), "ok" if found else "missing", json.dumps({"arguments": arguments, "id": f"{c}-{t}", "name": "reply", "result": answer.text if found else None}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)] += 1
    assert collections.Counter((r.conv_id, r.call_id, r.level, r.status, r.json) for r in tool_calls.query(spark, SF).collect()) == want
    assert max(k[2] for k in want) > 0


def test_pipeline_stages(spark, odd):
    import corpus_pipeline as cp
    from curbline.llm.common import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names, kept = docs.columns, {}
    for name, stage in cp.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == names
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.score(before, toxicity.fit(before, labels)).collect() if r.toxic}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - bad
        elif name == "exact_dedup":
            least = {}
            for i, t in texts_of(before):
                least[t.encode().lower()] = min(i, least.get(t.encode().lower(), i))
            assert {r.doc_id for r in docs.collect()} == set(least.values())
        elif name == "ngram_join":
            parts = brute_components(texts_of(before), 5, 80)
            assert docs.count() == len({c for _, _, c in parts})
            assert len({c for i, _, c in parts if i in {r.doc_id for r in docs.collect()}}) == docs.count()
        elif name == "suffix_dedup":
            # what is left, without the bytes of characters that were cut
            want = {i: left.decode(errors="ignore") for (i, _), left in zip(texts_of(before), brute_kept([t.encode() for _, t in texts_of(before)], 200))}
            assert {r.doc_id: r.text for r in docs.collect()} == want and all(r.n_chars == len(r.text) for r in docs.collect())
    assert kept["packing"].agg(F.count_distinct("doc_id")).first()[0] == kept["suffix_dedup"].count()
    rows = odd.withColumn("n_chars", F.length("text").cast("long"))
    at = written(rows, "odd")
    for _, stage in cp.STAGES[1:-1]:
        at = written(stage(spark, at, SF), "odd")
        assert at.columns == rows.columns
