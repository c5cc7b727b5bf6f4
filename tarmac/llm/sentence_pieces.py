"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice has a node per character boundary and an arc per piece. The model's pieces come from merges, so the path
wanted is the one the merges make, and it has a local test: a sequence of pieces is that path exactly when merging each
neighbouring pair on its own gives back the pair. The search keeps, for every boundary, the backpointer of the one path
that passes the test so far. Only boundaries less than the longest piece away can still be extended; as soon as the
backpointer paths of all of them run through one boundary, the ids before it are committed and its past is forgotten. So
a text of any length needs a window of a few pieces, and its ids equal the library's.

Words repeat, so a text is first cut where no piece can cross (before spaces and around characters without a piece of
their own), and each worker remembers the parts met last. A part no longer than the window needs no commits on the way:
its paths converge at its end. Such parts are searched in the same way over numbers, the pieces being walked down a tree of
their characters: the new parts of many texts together, boundary by boundary, as arrays.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from struct import pack

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import whole

BAR = chr(0x2581)
#: Parts and pairs a worker remembers, and the longest part it does. Of the parts, those met since half as many others
#: were new stay.
REMEMBERED, REMEMBERED_PAIRS, LONGEST = 300_000, 400_000, 64
#: What a run of characters is in the lattice, and the score of a merge that does not exist.
PIECE, BEGINNING = 1, 2
NEVER = float("-inf")
#: Characters between two looks for a common boundary; a part of as many has none on the way.
LOOK = 64
#: Above all numbers of pieces and of characters without one.
OUTSIDE = (1 << 22) - 1
#: Parts are searched together from so many on, and up to this length; characters of the texts taken at once.
TOGETHER, WIDTH, AT_ONCE = 64, 32, 1 << 21
#: Characters with a column in the tree's table, and places of the table of pairs.
COMMON, PAIR_PLACES = 0x250, 1 << 20
#: What the tree of pieces has for a character that does not go on: no branch and no piece.
NOTHING: list = [{}, -1]


class Pieces:
    """A merge-built SentencePiece model: ids by piece, text by id, and the search."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: dict[int, int] = {}  # id by byte
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.texts: list[bytes] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.texts.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.texts.append(b"")
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.texts.append(piece.replace(BAR, " ").encode())
        self.longest = max(map(len, self.ids))
        self.parts = re.compile(f"{BAR}*[^{BAR}\n]+|{BAR}+|\n")
        if any("\n" in p or (BAR in p.lstrip(BAR)) for p in self.ids):
            self.parts = re.compile(r"(?s).+")
        self.arcs = dict.fromkeys(self.ids, PIECE)
        for beginning in {p[:n] for p in self.ids for n in range(1, len(p))}:
            self.arcs[beginning] = self.arcs.get(beginning, 0) | BEGINNING
        self.met = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.known: dict[str, bytes] = {}  # parts met lately, and those met before them
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.built: dict[str, list] = {}
        # pieces by number: those of the model, then characters without a piece, then nothing
        self.named = [model.id_to_piece(i) for i in range(size)]
        self.lengths = [len(p) for p in self.named]
        self.alone: dict[str, int] = {}
        self.fitting: dict[int, bool] = {}
        self.tree: dict = {}
        for piece, i in self.ids.items():
            node, entry = self.tree, []
            for character in piece:
                entry = node.setdefault(character, [{}, -1])
                node = entry[0]
            entry[1] = i

    def merges(self, piece: str) -> list[tuple[float, str, str]]:
        """The merges that build a piece, best first and leftmost of equals: score, then first and last symbol after it."""
        found = self.built.get(piece)
        if found is None:
            symbols, found = list(piece), [(0.0, piece[0], piece[-1])] if piece else []
            while len(symbols) > 1:
                scores = [self.scores.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
                at = scores.index(max(scores))
                if scores[at] == NEVER:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
                found.append((scores[at], symbols[0], symbols[-1]))
            if len(symbols) > 1:
                found = []  # the piece never comes about
            self.built[piece] = found
        return found

    def fits(self, left: str, right: str) -> bool:
        """Merging the two together, best first, never joins a symbol of one to a symbol of the other."""
        ours, theirs = self.merges(left), self.merges(right)
        if not theirs or (left and not ours):
            return False
        i = j = 0
        while left:
            across = self.scores.get(ours[i][2] + theirs[j][1], NEVER)
            before = ours[i + 1][0] if i + 1 < len(ours) else NEVER
            after = theirs[j + 1][0] if j + 1 < len(theirs) else NEVER
            if across > before and across >= after and across > NEVER:
                return False
            if before == NEVER == after:
                break
            if before >= after:
                i += 1
            else:
                j += 1
        return True

    def stream(self, text: str, look: int = LOOK) -> Iterator[str]:
        """Pieces of the text in order, each as soon as it is certain. A character without a piece is one by itself."""
        arcs, pairs = self.arcs, self.pairs
        first = 0  # the boundary all paths run through
        last = {0: ""}  # piece that ends at each boundary of the window
        for end in range(1, len(text) + 1):
            start = end - 1
            before = last.get(start)
            if before is None:
                raise ValueError("no path: the pieces of this model are not built by merges")
            for stop in range(end, min(len(text), start + self.longest) + 1):
                piece = text[start:stop]
                kind = arcs.get(piece, 0)
                if stop not in last and (kind & PIECE or stop == end):
                    good = pairs.get((before, piece))
                    if good is None:
                        if len(pairs) >= REMEMBERED_PAIRS:
                            pairs.clear()
                        good = pairs[before, piece] = self.fits(before, piece)
                    if good:
                        last[stop] = piece
                if not kind & BEGINNING:
                    break
            # arcs into ``end`` are all known now, those beyond it are not
            if end == len(text) or end % look == 0:
                ends = [end] if end == len(text) else range(max(first, end - self.longest + 1), end + 1)
                path, shared = self._path(last, ends, first)
                yield from path
                first, last = shared, {b: p for b, p in last.items() if b >= shared}

    def _path(self, last: dict[int, str], ends, first: int) -> tuple[list[str], int]:
        """Pieces from ``first`` to the furthest boundary that the paths to all ``ends`` run through."""
        common: set[int] | None = None
        for end in ends:
            at, met = end, {end}
            while at > first:
                at -= len(last[at])
                met.add(at)
            common = met if common is None else common & met
        shared = at = max(common)
        pieces = []
        while at > first:
            pieces.append(last[at])
            at -= len(last[at])
        return pieces[::-1], shared

    def _number(self, character: str) -> int:
        """Number of a character without a piece."""
        number = self.alone.get(character)
        if number is None:
            if len(self.named) >= OUTSIDE:
                raise ValueError("more characters than a model can leave out")
            number = self.alone[character] = len(self.named)
            self.named.append(character)
            self.lengths.append(1)
        return number

    def _fit(self, key: int) -> bool:
        """``fits`` for two numbers in one; OUTSIDE stands for the beginning."""
        left, right = divmod(key, OUTSIDE + 1)
        good = self.fits("" if left == OUTSIDE else self.named[left], self.named[right])
        if len(self.fitting) >= REMEMBERED_PAIRS:
            self.fitting.clear()
        self.fitting[key] = good
        return good

    def short(self, part: str) -> list[int]:
        """Numbers of the pieces of a part that a window holds whole; the same pieces that ``stream`` gives."""
        size, tree, fitting = len(part), self.tree, self.fitting.get
        last = [-1] * (size + 1)  # piece that ends at each boundary
        before = OUTSIDE
        for start in range(size):
            if start:
                before = last[start]
                if before < 0:
                    raise ValueError("no path: the pieces of this model are not built by merges")
            base, node = before * (OUTSIDE + 1), tree
            for stop in range(start, size):
                node, piece = node.get(part[stop], NOTHING)
                if piece < 0 and stop == start:
                    piece = self._number(part[stop])
                if piece >= 0 and last[stop + 1] < 0:
                    good = fitting(base + piece)
                    if good or (good is None and self._fit(base + piece)):
                        last[stop + 1] = piece
                if not node:
                    break
        out, at, lengths = [], size, self.lengths
        while at:
            piece = last[at]
            out.append(piece)
            at -= lengths[piece]
        out.reverse()
        return out

    def _part(self, part: str) -> bytes:
        if len(part) <= LOOK:
            found = self.short(part)
            if max(found, default=0) >= len(self.texts):
                found = [i for n in found for i in ([n] if n < len(self.texts) else [self.bytes[b] for b in self.named[n].encode()])]
            return pack(f"<{len(found)}I", *found)
        out: list[int] = []
        for piece in self.stream(part):
            number = self.ids.get(piece)
            out += [number] if number is not None else [self.bytes[b] for b in piece.encode()]
        return np.array(out, "<u4").tobytes()

    @cached_property
    def grid(self) -> Grid:
        return Grid(self)

    def _searched(self, part: str) -> bytes:
        """Ids of a part; a long one is cut wherever no piece holds both neighbours, and each cut piece searched by itself."""
        if len(part) <= LOOK:
            return self._part(part)
        met = self.met
        cuts = [0, *[i for i in range(1, len(part)) if part[i - 1 : i + 1] not in met], len(part)]
        return b"".join(map(self._part, map(part.__getitem__, map(slice, cuts, cuts[1:]))))

    def _learn(self, parts: set[str]) -> None:
        """Remember the ids of all these parts."""
        known, older = self.known, self.older
        new = []
        for part in parts:
            if part in older:
                known[part] = older[part]
            else:
                new.append(part)
        grid = self.grid if len(new) >= TOGETHER else None
        together = [p for p in new if len(p) <= WIDTH and grid.covers(p)] if grid else []
        if together:
            known.update(zip(together, grid.search(together)))
        for part in new:
            if part not in known:
                known[part] = self._searched(part)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. A text gets a space in front, unless it is empty."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.parts.findall(BAR + text.replace(" ", BAR)) if text else [])
            size += len(text or "")
            if size >= AT_ONCE:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[str]]) -> Iterator[bytes]:
        self._learn({p for parts in held for p in parts} - self.known.keys())
        for parts in held:
            yield b"".join(map(self.known.__getitem__, parts))
        for part in {p for parts in held for p in parts if len(p) > LONGEST}:
            del self.known[part]
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> str:
        """The text again; a bar in a text comes back as the space it stands for."""
        text = b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text.decode("utf-8", "replace").removeprefix(" ")


class Grid:
    """The search of many short parts together, for parts of common characters that are pieces by themselves."""

    def __init__(self, of: Pieces) -> None:
        self.of = of
        self.codes = np.zeros(ord(BAR) + 1, np.int32)
        common = sorted(c for c in of.ids if len(c) == 1 and (ord(c) < COMMON or c == BAR))
        self.codes[[ord(c) for c in common]] = np.arange(1, len(common) + 1)
        self.outside = re.compile(f"[^{re.escape(''.join(common))}]")
        rows, self.piece, trees = [], [], [of.tree]
        for tree in trees:  # grows while it is read; the first is the root, and none
            row = np.zeros(len(common) + 1, np.int32)
            for character, (below, _) in tree.items():
                if ord(character) <= ord(BAR) and self.codes[ord(character)]:
                    row[self.codes[ord(character)]] = len(trees)
                    trees.append(below)
            rows.append(row)
        self.next = np.stack(rows)
        self.piece = np.full(len(trees), -1, np.int64)
        number = 1
        for tree in trees:
            for character, (_, piece) in tree.items():
                if ord(character) <= ord(BAR) and self.codes[ord(character)]:
                    self.piece[number] = piece
                    number += 1
        self.leaf = ~self.next.any(axis=1)
        self.pairs = np.full(PAIR_PLACES, -1, np.int64)
        self.fits = np.zeros(PAIR_PLACES, bool)

    def covers(self, part: str) -> bool:
        return not self.outside.search(part)

    def fitting(self, keys: np.ndarray) -> np.ndarray:
        """``fits`` of each pair. The table holds the pairs met last at each place, the others are worked out."""
        at = (keys * 0x9E3779B97F4A7C1 >> 24) % PAIR_PLACES
        good, unknown = self.fits[at], np.flatnonzero(self.pairs[at] != keys)
        if len(unknown):
            some, where = np.unique(keys[unknown], return_inverse=True)
            held, fit = self.of.fitting.get, self.of._fit
            found = np.array([fit(k) if (known := held(k)) is None else known for k in some.tolist()], bool)
            good[unknown] = found[where]
            self.pairs[at[unknown]], self.fits[at[unknown]] = keys[unknown], good[unknown]
        return good

    def search(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, all of its characters common ones and at most ``WIDTH`` of them."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        order = np.argsort(-lengths, kind="stable")  # longest first, so parts that reach a boundary come first
        size = lengths[order]
        width, count = int(size[0]), len(parts)
        text = np.frombuffer("".join(map(parts.__getitem__, order.tolist())).encode("utf-32-le"), "<u4")
        grid = np.zeros((count, width), np.int32)
        grid[np.arange(width) < size[:, None]] = self.codes[text]
        grid = np.ascontiguousarray(grid.T)
        last = np.full((width + 1, count), -1, np.int64)  # piece that ends at each boundary
        last[0] = OUTSIDE
        for start in range(width):
            word = np.arange(np.searchsorted(-size, -start))  # parts longer than ``start``
            before = last[start, word]
            if (before < 0).any():
                raise ValueError("no path: the pieces of this model are not built by merges")
            base, node = before * (OUTSIDE + 1), np.zeros(len(word), np.int32)
            for stop in range(start, width):
                node = self.next[node, grid[stop, word]]
                on = node > 0
                if not on.all():
                    word, node, base = word[on], node[on], base[on]
                if not len(word):
                    break
                piece = self.piece[node]
                asked = np.flatnonzero((piece >= 0) & (last[stop + 1, word] < 0))
                if len(asked):
                    asked = asked[self.fitting(base[asked] + piece[asked])]
                    last[stop + 1, word[asked]] = piece[asked]
                further = ~self.leaf[node]
                if not further.all():
                    word, node, base = word[further], node[further], base[further]
        return self._read_back(last, size, order)

    def _read_back(self, last: np.ndarray, size: np.ndarray, order: np.ndarray) -> list[bytes]:
        lengths, at, steps = np.array(self.of.lengths[: len(self.of.texts)]), size.copy(), []
        word = np.arange(len(size))
        while len(word):
            piece = last[at[word], word]
            steps.append((word, piece))
            at[word] -= lengths[piece]
            word = word[at[word] > 0]
        words, found = np.concatenate([w for w, _ in steps]), np.concatenate([p for _, p in steps])
        turn = np.concatenate([np.full(len(w), -n) for n, (w, _) in enumerate(steps)])
        by = np.lexsort((turn, words))
        ids, ends = found[by].astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(words, minlength=len(size)))
        out: list[bytes] = [b""] * len(size)
        start = 0
        for place, end in zip(order.tolist(), ends.tolist()):
            out[place] = ids[start:end]
            start = end
        return out


@cache
def pieces(path: str) -> Pieces:
    """One per worker and file."""
    return Pieces(path)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every text.

    Null text counts as empty and has no ids. Repeated rows are encoded one by one; other columns are never read,
    whatever their names; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = pieces(model).encode_all
        for batch in batches:
            ids = pa.array(encode(t.as_py() for t in batch.column(1)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, ids binary")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """``encoded`` rows with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = pieces(model).decode
        for batch in batches:
            texts = pa.array([decode(i.as_py()) for i in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, and SHA-256 and length of the text decoded from the ids, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model)
        for batch in batches:
            rows = []
            for ids in coder.encode_all(text.as_py() for text in batch.column(1)):
                back = coder.decode(ids)
                rows.append((len(ids) // 4, zlib.crc32(ids), hashlib.sha256(back.encode()).hexdigest(), len(back)))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "decoded_chars"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole("text").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, decoded_sha256 string, decoded_chars bigint")
