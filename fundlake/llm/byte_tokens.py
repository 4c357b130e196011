"""Token ids of whole texts by the byte-level vocabulary.

The library that the vocabulary file was made for encodes half a megabyte a second. The same
vocabulary as ranks (a token's rank is its id, and merges follow ranks) gives the same ids ten
times as fast; tests compare the two on odd texts. Left to the former are special strings,
which it reads as the one token they stand for, and blanks by the thousand in a row, on which
the latter recurses too deeply.
"""

from __future__ import annotations

import json
import re

import numpy as np

from fundlake.llm.tokens import _UNITS

#: The pre-tokenizer of the vocabulary file, as fixed there.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANKS = re.compile(r"\s{5000}")


class ByteIds:
    """Ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte_of = {chr(_UNITS.get(b, b)): b for b in range(256)}
        self.special = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = {bytes(map(byte_of.__getitem__, unit)): i for unit, i in vocabulary.items() if unit not in self.special}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def text(self, data: bytes) -> bytes:
        text = data.decode("utf-8", "replace")
        if any(s in text for s in self.special) or _BLANKS.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.encode(text), "<u4").tobytes()


_LOADED: dict[str, ByteIds] = {}


def byte_ids(path: str) -> ByteIds:
    """The encoder of this worker process."""
    if path not in _LOADED:
        _LOADED[path] = ByteIds(path)
    return _LOADED[path]
