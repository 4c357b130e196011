"""SentencePiece encoding and decoding by a forward pass over shared prefixes.

White space becomes a mark at the head of the next word, and no piece reaches across a word's end,
so a text's ids are those of its marked words. The distinct new words of a window of texts are
sorted, which walks their trie depth first: the forward state of a prefix, the last piece of its
best segmentation, is kept for all words that share it.

In a merge model (the public file is one) the best segmentation is the one that merging gives. It
is the only one in which every two neighbours would stay apart if merged alone, so the forward
pass extends a prefix by the piece that fits its last one. With ``scores`` the pass maximises the
sum of piece scores instead, as in a unigram model.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from fundlake.llm.common import ROW, batched, rows_of, texts

MARK = "▁"
#: Score of what is no piece.
NEVER = float("-inf")
MOST_WORDS = 300_000
#: Bytes of text whose words are collected before they are encoded.
WINDOW_BYTES = 4 << 20


class Pieces:
    """A table of pieces, and the ids of words met so far (bounded)."""

    def __init__(self, names: list[str], scores: list[float], special: set[int], byte_of: dict[int, int], by_score: bool = False):
        self.by_score = by_score
        self.names = names
        self.special = special
        self.byte_of = byte_of
        self.bytes = {b: i for i, b in byte_of.items()}
        self.ids = {p: i for i, p in enumerate(names) if i not in special and i not in byte_of}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.spelled = [
            bytes([byte_of[i]]) if i in byte_of else b"" if i in special else name.replace(MARK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.codes = {p: struct.pack("<I", i) for p, i in self.ids.items()}
        self.byte_codes = {b: struct.pack("<I", i) for b, i in self.bytes.items()}
        self.sizes = self.sizes_by_end()
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.longest = 0 if by_score else self.longest_run()

    @classmethod
    def read(cls, path: str, by_score: bool = False) -> Pieces:
        """The pieces of a model file."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in numbers]
        byte_of = {i: int(names[i][3:5], 16) for i in numbers if model.is_byte(i)}
        special = {i for i in numbers if model.is_control(i) or model.is_unknown(i)}
        return cls(names, [model.get_score(i) for i in numbers], special, byte_of, by_score)

    def sizes_by_end(self) -> dict[str, tuple[int, ...]]:
        """Lengths, longest first, of the pieces that can end where three given characters end."""
        found: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 2:
                found.setdefault(piece[-3:], {1, 2}).add(len(piece))
        return {end: tuple(sorted(sizes, reverse=True)) for end, sizes in found.items()}

    def merged(self, text: str) -> list[str]:
        """Segmentation by merging the best-scored neighbours, leftmost first."""
        parts, _ = self.merge(text, 0)
        return parts

    def merge(self, text: str, wall: int) -> tuple[list[str], bool]:
        """Parts after merging, and whether no merge crossed ``wall`` characters; a crossing ends it."""
        parts = list(text)
        gains = [self.score.get(a + b, NEVER) for a, b in pairwise(parts)]
        while gains:
            best = max(gains)
            if best == NEVER:
                break
            at = gains.index(best)
            if wall:
                if at == wall - 1:
                    return parts, False
                wall -= at < wall
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = self.score.get(parts[at - 1] + parts[at], NEVER)
            if at < len(gains):
                gains[at] = self.score.get(parts[at] + parts[at + 1], NEVER)
        return parts, True

    def fits(self, left: str, right: str) -> bool:
        """Whether two neighbours stay apart, each whole, if merged alone."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > MOST_WORDS:
                self.pairs.clear()
            parts, apart = self.merge(left + right, len(left))
            known = self.pairs[left, right] = apart and len(parts) == 2
        return known

    def longest_run(self) -> int:
        """Length of the longest piece of marks if runs of marks can be counted, else 0.

        They can if such pieces have one score, below all others, so that they merge last and from
        the left; if marks fill the longest one; and if no other piece begins with two marks.
        """
        runs = {len(p): s for p, s in self.score.items() if p and not p.strip(MARK)}
        longest = max(runs, default=0)
        lowest = {s for n, s in runs.items() if n > 1}
        plain = all(p.strip(MARK) == "" or not p.startswith(MARK * 2) for p in self.score)
        below = all(s > min(lowest, default=0) for p, s in self.score.items() if p.strip(MARK))
        whole = longest > 1 and self.merged(MARK * longest) == [MARK * longest]
        return longest if len(lowest) == 1 and plain and below and whole else 0

    def run_of_marks(self, n: int) -> bytes:
        """The leftmost marks merge first: whole longest pieces, then what the rest merges to."""
        whole, rest = divmod(n, self.longest)
        return self.codes[MARK * self.longest] * whole + self.packed(self.merged(MARK * rest))

    def learn(self, words: set[str]) -> None:
        """Ids of all words; a run of marks is counted, the rest of its word keeps the last mark."""
        runs = {w for w in words if self.longest and not self.by_score and w.startswith(MARK * 2)}
        self.extend((words - runs) | {MARK + w.lstrip(MARK) for w in runs if w.strip(MARK)}.difference(self.words))
        for word in runs:
            rest = word.lstrip(MARK)
            n = len(word) - len(rest)
            tail = self.words[MARK + rest] if rest else self.codes[MARK]
            lone = tail.startswith(self.codes[MARK])  # the last mark merges with marks, not with letters
            self.words[word] = self.run_of_marks(n) + tail[4:] if lone else self.run_of_marks(n - 1) + tail

    def extend(self, words: set[str]) -> None:
        """Ids of words in sorted order; states of common prefixes are used again."""
        score, pairs, sizes, by_score = self.score, self.pairs, self.sizes, self.by_score
        before = ""
        last = [""]  # last piece of each prefix
        total = [0.0]  # score of each prefix
        for word in sorted(words):
            shared = 0
            for known, letter in zip(before, word):
                if known != letter:
                    break
                shared += 1
            before = word
            del last[shared + 1 :], total[shared + 1 :]
            if not by_score and word.startswith(MARK * 2):
                self.words[word] = self.packed(self.merged(word))  # pieces of marks have equal scores
                before, last, total = "", [""], [0.0]
                continue
            for end in range(shared + 1, len(word) + 1):
                best, chosen = NEVER, word[end - 1]
                for size in sizes.get(word[end - 3 : end] if end > 2 else "", (2, 1)):
                    if size > end:
                        continue
                    piece = word[end - size : end]
                    if size > 1 and piece not in score:
                        continue
                    if by_score:
                        value = total[end - size] + score.get(piece, -1e6)
                        if value > best:
                            best, chosen = value, piece
                        continue
                    left = last[end - size]
                    if not left or pairs.get((left, piece)) or self.fits(left, piece):
                        chosen = piece
                        break
                last.append(chosen)
                if by_score:
                    total.append(best)
            parts, end = [], len(word)
            while end:
                parts.append(last[end])
                end -= len(last[end])
            self.words[word] = self.packed(parts[::-1])

    def packed(self, parts: list[str]) -> bytes:
        try:
            return b"".join(map(self.codes.__getitem__, parts))
        except KeyError:  # a character without a piece becomes its bytes
            return b"".join(self.codes.get(p) or b"".join(map(self.byte_codes.__getitem__, p.encode())) for p in parts)

    @staticmethod
    def split(text: str) -> list[str]:
        """Marked words: a run of marks with what follows up to the next mark or line end."""
        if not text:
            return []
        words: list[str] = []
        for line in (MARK + text.replace(" ", MARK)).split("\n"):
            if words:
                words.append("\n")
            head, *rest = line.split(MARK)
            if all(rest):  # single spaces only
                words += [head] if head else []
                words += [MARK + part for part in rest]
                continue
            if head:
                words.append(head)
            marks = ""
            for part in rest:
                marks += MARK
                if part:
                    words.append(marks + part)
                    marks = ""
            if marks:
                words.append(marks)
        return words

    def encode(self, words: list[str]) -> bytes:
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: Sequence[int]) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[tuple[str, bool], Pieces] = {}


def pieces(path: str, scores: bool = False) -> Pieces:
    if (path, scores) not in _LOADED:
        _LOADED[path, scores] = Pieces.read(path, scores)
    return _LOADED[path, scores]


def _encode(path: str, scores: bool):
    schema = pa.schema([(ROW, pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, scores)

        def flush(waiting):
            if len(model.words) > MOST_WORDS:
                model.words.clear()
            model.learn(set().union(*(words for _, _, words in waiting)).difference(model.words))
            for row, doc, words in waiting:
                yield row, doc, model.encode(words)

        def rows():
            waiting, held = [], 0
            for row, doc, data in rows_of(batches):
                waiting.append((row, doc, model.split(data.decode("utf-8", "replace"))))
                held += len(data)
                if held > WINDOW_BYTES:
                    yield from flush(waiting)
                    waiting, held = [], 0
            yield from flush(waiting)

        yield from batched(rows(), schema, weight=lambda r: len(r[2]))

    return encode


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", scores: bool = False) -> DataFrame:
    """``_row, doc_id, ids`` (little-endian unsigned 32-bit) of every text; null and empty texts have none."""
    kind = f"{ROW} long, doc_id long, ids binary"
    return texts(docs, id_col, text_col).mapInArrow(_encode(model, scores), kind)


def decoded(ids: DataFrame, model: str, with_text: bool = True) -> DataFrame:
    """Counts, checksums and texts back from rows of ``encoded``: ``n_tokens, ids_crc32, text, text_sha256``.

    All texts are decoded in full; ``with_text=False`` keeps them out of the result.
    """
    fields = [(ROW, pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("text_sha256", pa.string())] + [("text", pa.string())] * with_text
    schema = pa.schema(fields)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)

        def rows():
            for row, doc, raw in rows_of(batches):
                n = len(raw) // 4
                text = own.decode(struct.unpack(f"<{n}I", raw))
                digests = row, doc, n, zlib.crc32(raw), hashlib.sha256(text.encode()).hexdigest()
                yield (*digests, text) if with_text else digests

        yield from batched(rows(), schema, weight=(lambda r: len(r[5])) if with_text else None)

    kind = f"{ROW} long, doc_id long, n_tokens long, ids_crc32 long, text_sha256 string"
    kind += ", text string" * with_text
    return ids.select(ROW, "doc_id", "ids").mapInArrow(decode, kind)
