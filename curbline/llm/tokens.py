"""Byte-level BPE encoding of whole texts."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np


def _byte_of_letter() -> dict[str, int]:
    """The published printable stand-in of each byte in byte-level vocabularies: itself if printable Latin-1, else 256 and up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_bpe(file: str) -> Callable[[str], bytes]:
    """Encoder of a ``tokenizers`` file with byte-level BPE, no special tokens added: text to its ids as little-endian uint32 bytes.

    If merges are ranked by id, as here, ids come from a rank table (several times as fast); texts that contain the
    string of a special token, and files of another kind, are left to the ``tokenizers`` library itself."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    with open(file, encoding="utf-8") as f:
        model = json.load(f)
    letters, specials = _byte_of_letter(), [t["content"] for t in model["added_tokens"]]
    vocab = {k: v for k, v in model["model"]["vocab"].items() if k not in specials}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
    ranks = [vocab[a + b] for a, b in pairs]

    def slow(text):
        return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    pre = model["pre_tokenizer"] or {}
    if ranks != sorted(ranks) or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("normalizer"):
        return slow
    from public_tokenizers import PATTERN

    table = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={bytes(letters[c] for c in k): v for k, v in vocab.items()}, special_tokens={})

    def fast(text):
        if any(s in text for s in specials):
            return slow(text)
        return np.asarray(table.encode_ordinary(text), "<u4").tobytes()

    return fast
