"""SentencePiece encoding that keeps source offsets, and decoding.

Normalisation walks the model's compiled character map (a double-array trie with a table of replacements) for the
longest matching prefix at each place, and records for every normalised byte the source byte it comes from. Piece
boundaries, which are offsets in the normalised text, are projected through that record to spans of the source.

Odd input: a null text is an empty one, whose ids are the begin and end ids; repeated rows are encoded each; an empty
table gives an empty table; very long texts are encoded whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import map_texts

#: U+2581, which stands for a blank in pieces: fixed value of the format.
BLANK = "▁".encode()


class CharacterMap:
    """Compiled character map: uint32 size of the trie, trie units, then replacements that end in a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.text = blob[4 + size :]

    def starts(self, byte: int) -> bool:
        return bool(self.units) and self._step(self._root(), byte) is not None

    def _root(self) -> int:
        return self._offset(self.units[0])

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    def _step(self, at: int, byte: int) -> tuple[int, int | None] | None:
        """(next place, index of the replacement if a key ends here)."""
        at ^= byte
        if at >= len(self.units):
            return None
        unit = self.units[at]
        if unit & (1 << 31 | 255) != byte:
            return None
        below = at ^ self._offset(unit)
        return below, self.units[below] & 0x7FFFFFFF if unit >> 8 & 1 else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest key that begins at ``at``."""
        if not self.units:
            return None
        best, place = None, self._root()
        for k in range(at, len(data)):
            if (step := self._step(place, data[k])) is None:
                break
            place, value = step
            if value is not None:
                best = (k + 1 - at, value)
        if best is None:
            return None
        return best[0], self.text[best[1] : self.text.index(b"\0", best[1])]


class Normalizer:
    """``normalize(text) -> (normalised bytes, source offset of each of them and of the end)``."""

    def __init__(self, charsmap: bytes = b"", dummy_prefix: bool = True, squeeze: bool = True, escape: bool = True, suffix: bool = False):
        self.map, self.dummy, self.squeeze, self.suffix = CharacterMap(charsmap), dummy_prefix, squeeze, suffix
        self.starts = np.array([self.map.starts(b) for b in range(256)])
        self.blank = BLANK if escape else b" "

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode()
        raw, source = self._mapped(data)
        n = len(data)
        if self.squeeze:
            blank = raw == 32
            first = np.ones(len(raw), bool)
            first[1:] = ~blank[:-1]
            keep = ~blank | first
            solid = np.flatnonzero(~blank)
            keep[: solid[0] if len(solid) else len(raw)] = False
            if len(solid):
                keep[solid[-1] + 1 :] = False
            raw, source = raw[keep], source[keep]
        if not len(raw):
            return b"", np.zeros(1, np.int64)
        if self.dummy:
            where = (len(raw), n) if self.suffix else (0, source[0] if self.squeeze else 0)
            raw, source = np.insert(raw, where[0], 32), np.insert(source, where[0], where[1])
        if len(self.blank) > 1:
            wide = np.where(raw == 32, len(self.blank), 1)
            out = np.repeat(raw, wide)
            begin = np.cumsum(wide) - wide
            for k, b in enumerate(self.blank):
                out[begin[raw == 32] + k] = b
            raw, source = out, np.repeat(source, wide)
        end = int(source[-1]) + 1 if self.squeeze and not self.suffix else n
        return raw.tobytes(), np.append(source, max(end, int(source[-1])))

    def _mapped(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        whole = np.frombuffer(data, np.uint8)
        if not self.map.units:
            return whole, np.arange(len(data))
        out, source, at, done = [], [], 0, 0
        begins = np.flatnonzero(self.starts[whole]) if len(whole) else []
        for k in begins:
            k = int(k)
            if k < at or data[k] & 0xC0 == 0x80:
                continue
            if (hit := self.map.longest(data, k)) is None:
                continue
            out += [whole[done:k], np.frombuffer(hit[1], np.uint8)]
            source += [np.arange(done, k), np.full(len(hit[1]), k)]
            at = done = k + hit[0]
        out.append(whole[done:])
        source.append(np.arange(done, len(data)))
        return np.concatenate(out), np.concatenate(source).astype(np.int64)


class Codec:
    """A model's encoder with spans, and decoder."""

    def __init__(self, file: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.model = SentencePieceProcessor(model_file=file)
        spec = pb.ModelProto()
        with open(file, "rb") as f:
            spec.ParseFromString(f.read())
        n, t = spec.normalizer_spec, spec.trainer_spec
        self.normalizer = Normalizer(n.precompiled_charsmap, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces, t.treat_whitespace_as_suffix)
        kinds = {p.Type.Value(k): k for p in spec.pieces[:1] for k in p.Type.keys()}
        #: Normalised bytes of each piece: one for a byte piece, none for a control piece; -1 where it isn't fixed (unknown).
        self.width = np.array([{"BYTE": 1, "CONTROL": 0, "UNKNOWN": -1}.get(kinds[p.type], len(p.piece.encode())) for p in spec.pieces], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids with begin and end id, source byte where each piece begins, and where it ends); places are -1 if a model's pieces don't add up to the normalised text."""
        ids = np.asarray(self.model.encode(text, add_bos=True, add_eos=True), np.int64)
        normal, source = self.normalizer.normalize(text)
        width = self.width[ids]
        if (width < 0).any():
            pieces = self.model.encode(text, return_type="proto").pieces
            width[1:-1] = [len(p.surface.encode()) if w < 0 else w for p, w in zip(pieces, width[1:-1])]
        ends = np.cumsum(width)
        if ends[-1] != len(normal):
            none = np.full(len(ids), -1, np.int64)
            return ids, none, none
        return ids, source[ends - width], source[ends]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def encode(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, begins, ends): ids and source byte offsets as little-endian uint32 and int64 arrays in binary."""

    def run(codec, texts, ids):
        done = [codec.encode(t or "") for t in texts]
        return {"doc_id": ids, "n_tokens": [len(i) for i, _, _ in done], "ids": [i.astype("<u4").tobytes() for i, _, _ in done], "begins": [b.astype("<i8").tobytes() for _, b, _ in done], "ends": [e.astype("<i8").tobytes() for _, _, e in done]}

    return map_texts(documents, [F.col(f"`{text_col}`"), F.col(f"`{id_col}`")], run, "doc_id long, n_tokens long, ids binary, begins binary, ends binary", lambda: Codec(model))


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from binary ids."""

    def run(codec, blobs, ids):
        return {"doc_id": ids, "text": [codec.decode(np.frombuffer(b, "<u4").tolist()) for b in blobs]}

    return map_texts(encoded, [F.col(ids_col), F.col(id_col)], run, "doc_id long, text string", lambda: Codec(model))


def round_trip(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of :func:`encode` and :func:`decode` in one pass over the texts: encoding, spans and decoded text never leave the worker."""

    def run(codec, texts, ids):
        out = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")}
        for t in texts:
            i, b, e = codec.encode(t or "")
            values = len(i), hashlib.sha256(i.astype("<u4")).hexdigest(), hashlib.sha256(codec.decode(i.tolist()).encode()).hexdigest(), hashlib.sha256(np.concatenate([b, e]).astype("<i8")).hexdigest()
            for column, v in zip(out.values(), values):
                column.append(v)
        return {"doc_id": ids} | out

    return map_texts(documents, [F.col(f"`{text_col}`"), F.col(f"`{id_col}`")], run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string", lambda: Codec(model))


def query(spark, sf_dir):
    from public_tokenizers import path

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), path("piece_bpe_32k.model"))
