"""Token ids of whole texts, from ids of their words.

The word tokenizer lower-cases, drops white space and never joins across it, so the ids of a
text are those of its words in order. Words repeat far more than texts: a worker keeps the ids
of words, and of the pieces that words fall into, and encodes only new ones.
"""

from __future__ import annotations

import struct
import unicodedata

import numpy as np
import regex

#: The pre-tokenizer of the vocabulary file, as fixed there.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Marks, special strings and white space beyond ASCII: such words are encoded whole.
_ODD = regex.compile(r"<\||\s|\p{C}|\p{M}")
#: Letters, then marks that cannot begin a contraction: the usual word.
_PLAIN = regex.compile(r"(\p{L}*)([^\s\p{L}\p{N}\p{C}\p{M}<']*)")
#: Byte-level units: a printable byte stands for itself, the n-th other one for character 256 + n.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_UNITS = {b: 256 + n for n, b in enumerate(_OTHERS)}
MOST_WORDS = 250_000
MOST_PIECES = 150_000


class WordIds(dict):
    """Ids of a word as little-endian unsigned 32-bit bytes, learnt when first asked for.

    Both maps are emptied when they reach their bound, so memory is bounded.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}

    def text(self, data: bytes) -> bytes:
        """Ids of a text; ASCII white space only is split here, the rest is left to the tokenizer."""
        if len(self) > MOST_WORDS:
            self.clear()
        if len(self.pieces) > MOST_PIECES:
            self.pieces.clear()
        return b"".join(map(self.__getitem__, data.split()))

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():
            ids = self.piece(word.decode().lower())
        else:
            ids = self.mixed(word.decode("utf-8", "replace"))
        self[word] = ids
        return ids

    def mixed(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain and "Σ" not in word and "İ" not in word and unicodedata.is_normalized("NFC", word):
            letters, marks = plain.groups()
            ids = self.piece(letters.lower()) if letters else b""
            return ids + self.piece(marks) if marks else ids
        if _ODD.search(word) or not unicodedata.is_normalized("NFC", word):
            return self.whole(word)
        lower = "".join(map(str.lower, word))
        if _ODD.search(lower):
            return self.whole(word)
        return b"".join(map(self.piece, PIECE.findall(lower)))

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            units = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_UNITS)
            found = self.model.tokenize(units)
            ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
            self.pieces[piece] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The encoder of this worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
