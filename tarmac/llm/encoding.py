"""Tokenizer files of the tokenizers library applied to whole texts inside tasks.

The library encodes about a megabyte a second, and most of a corpus is repeated words, so texts are cut where no token can
cross and each distinct piece is encoded once per worker. A text with rare white space, where the cut rule of Python and
of the tokenizer could differ, is encoded whole.

For byte-level files a column of texts is cut and its pieces told apart as arrays, so Python sees a piece once per window
of pieces and not each time it comes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: White space and invisible characters beyond the common six, as ranges of code points.
RARE_RANGES = (
    (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F),
    (0x2028, 0x202F), (0x205F, 0x2064), (0x3000, 0x3000), (0xFEFF, 0xFEFF),
)
RARE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in RARE_RANGES) + "]")
#: White space with the word after it: byte-level tokens start with the space, and none has white space after a letter.
SPACED = re.compile(r"\s*\S+|\s+")
#: Pieces remembered by a worker, and their greatest length; the others are encoded each time they come.
REMEMBERED, LONGEST = 800_000, 64

#: Bytes of whole texts cut at a time, or one longer text, and pieces told apart at a time.
CUT_BYTES, WINDOW = 2 << 20, 1 << 21


def _kinds() -> np.ndarray:
    """The kind of each byte of UTF-8, a rare one wherever a rare character may start."""
    kinds = np.zeros(256, np.uint8)
    for c in range(0x21, 0x7F):
        kinds[c] = LETTER if chr(c).isalpha() else 0 if chr(c).isdigit() else MARK
    kinds[[chr(c).encode()[0] for a, b in RARE_RANGES for c in range(a, b + 1)]] = ODD
    kinds[[0x20, *range(0x09, 0x0E)]] = SPACE
    return kinds


SPACE, LETTER, MARK, ODD = 1, 2, 3, 4
KINDS = _kinds()

#: A letter run with at most one space or line end before it and one mark after it; tokens cross neither border.
PLAIN = re.compile(r"([\x20\n]?)([^\W\d_]+)([.,!?;:]?)")
#: The same for byte-level files, whose splitter takes numbers and runs of marks as one.
PLAIN_BYTES = re.compile(r"([\x20\n]?)([^\W\d_]+|[0-9]+)([!-/:-@\[-`{-~]*)")
#: Letters from here on go the whole way through the tokenizer's normalizer.
BEYOND_LATIN = chr(0x250)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, special tokens in a text being ordinary text."""

    def __init__(self, path: str, drops_space: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.drops_space = drops_space
        self.plain = (PLAIN if drops_space else PLAIN_BYTES).fullmatch
        self.size = self.tokenizer.get_vocab_size()
        self.split = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(self.known) < REMEMBERED and len(piece) <= LONGEST:
            self.known[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """One token run of the vocabulary's model, without the normalizer and the splitter it needs none of."""
        ids = self.known.get(word)
        if ids is None:
            if word.isascii():
                spelt = self.letters[32] + word[1:] if word[0] == " " else word
            else:
                spelt = word.encode().decode("latin-1").translate(self.letters)
            found = [token.id for token in self.split(spelt)]
            ids = self._remember(word, pack(f"<{len(found)}I", *found))
        return ids

    def _piece(self, piece: str) -> bytes:
        plain = self.plain(piece)
        if plain is None:
            return self._remember(piece, self._encoded([piece])[0])
        before, word, mark = plain.groups()
        if not word.isascii() and (not word.isalpha() or max(word) >= BEYOND_LATIN or (self.drops_space and chr(0x130) in word)):
            return self._remember(piece, self._encoded([piece])[0])
        if self.drops_space:
            ids = self._word(word.lower())
        elif not mark and before != "\n":
            return self._word(piece)
        elif before == "\n":
            ids = self.known.get(before) or self._remember(before, self._encoded([before])[0])
            ids += self._word(word)
        else:
            ids = self._word(before + word)
        if mark:
            ids += self.known.get(mark) or (self._remember(mark, self._encoded([mark])[0]) if self.drops_space else self._word(mark))
        return self._remember(piece, ids)

    def ids(self, text: str) -> bytes:
        if RARE.search(text):
            return self._encoded([text])[0]
        pieces = text.split() if self.drops_space else SPACED.findall(text)
        known, piece = self.known.get, self._piece
        return b"".join([known(p) or piece(p) for p in pieces])

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """Ids of the texts that lie in ``data`` between ``offsets``. Texts are cut before white space, and between a letter
        and a mark of ASCII, where the splitter always ends a run."""
        known, piece, base = self.known.get, self._piece, offsets[0]
        kinds, places = KINDS[data[base : offsets[-1]]], offsets - base
        space = kinds == SPACE
        border = np.zeros(len(kinds) + 1, bool)
        border[1:-1] = (space[1:] & ~space[:-1]) | ((kinds[1:] == MARK) & (kinds[:-1] == LETTER))
        for i in np.unique(np.searchsorted(places, np.flatnonzero(kinds == ODD), "right") - 1).tolist():
            if RARE.search(data[offsets[i] : offsets[i + 1]].tobytes().decode()):
                border[places[i] : places[i + 1]] = False
        border[places] = True
        cuts = np.flatnonzero(border)
        parts, lengths = [], [np.zeros(1, np.int64)]
        for at in range(0, len(cuts) - 1, WINDOW):
            ends = cuts[at : at + WINDOW + 1] + base
            pieces = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
            coded = pieces.dictionary_encode()
            found = [known(p) or piece(p) for p in coded.dictionary.to_pylist()]
            parts.append(pa.array(found, pa.large_binary()).take(coded.indices).buffers()[2])
            lengths.append(np.array([*map(len, found)], np.int64)[coded.indices.to_numpy()])
        ids = b"".join(parts)
        starts = np.cumsum(np.concatenate(lengths))[np.searchsorted(cuts, places)].tolist()
        for a, b in zip(starts, starts[1:]):
            yield ids[a:b]

    def column(self, texts: pa.Array) -> Iterator[bytes]:
        """What ``ids`` gives for each text of an Arrow column without nulls, in order; for byte-level files alone."""
        if self.drops_space:
            raise ValueError("tokens of this file do not hold the white space between them")
        if not len(texts):
            return
        texts = texts.cast(pa.large_string())
        _, places, held = texts.buffers()
        offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(held or b"", np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CUT_BYTES, "right")) - 1)
            yield from self._cut(data, offsets[first : last + 1])
            first = last


@cache
def encoder(path: str, drops_space: bool) -> Encoder:
    """One per worker and file."""
    return Encoder(path, drops_space)
