"""N-best segmentation of whole texts with a SentencePiece vocabulary.

The lattice of a text has an edge for every piece that fits, with the piece's score. A forward
Viterbi pass gives the best score up to every place; these are exact heuristics for an A* search
that starts at the end and goes backwards, so its results come out in order and it never expands
a path that is not part of one.

No piece reaches from a visible character over to a space mark, so the lattice falls apart into
words. The forward pass of a word keeps its two best scores. A worker remembers words, and of a
text only those whose second score is closest can differ from the best path in the first n
results; the backward search runs on these and their combinations are put in order.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.common import hold, id_and_text

SPACE = "▁"
#: A character that no piece covers scores this much less than the lowest piece, and is spelled in bytes.
UNKNOWN_PENALTY = 10
#: Scores at or under this mark pieces that training never made; they do not lower the score of unknown ones.
UNTRAINED = -1_000_000_000
HELD_CHARS = 4_500_000
HELD_SEARCHES = 20_000
#: Marks that no sum of scores reaches.
NO_PIECE, NONE, NO_SECOND = 1 << 59, -(1 << 59), 1 << 34
#: Scores are added up as whole multiples of one over this if a model has fractional ones; float scores from 8 up are exact.
FRACTION = 1 << 20
OUT_CHARS = 2_000_000

ROWS = "doc_id long, rank int, score long, n_pieces long, ids binary, round_trip boolean"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("rank", pa.int32()), ("score", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.binary()), ("round_trip", pa.bool_())]
)
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]*")
_LATTICES: dict[str, Lattice] = {}


def model_file(name: str = "piece_bpe_32k.model") -> str:
    """Path of an installed public model."""
    import public_tokenizers

    return public_tokenizers.path(name)


def lattice(path: str) -> Lattice:
    """The lattice of this worker process for a model file."""
    hold("lattice", _LATTICES.clear)
    if path not in _LATTICES:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        scores = {
            model.id_to_piece(i): (i, model.get_score(i))
            for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        }
        _LATTICES[path] = Lattice(scores, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    return _LATTICES[path]


class Lattice:
    """Pieces with their scores, and byte pieces for what they do not cover.

    Scores are held as whole numbers of ``1 / unit``: the unit is one if all scores are whole, else ``FRACTION``.
    Ties are in favour of the path whose last piece is the longest, then the one before it.
    """

    def __init__(self, scored: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.unit = 1 if all(float(score).is_integer() for _, score in scored.values()) else FRACTION
        pieces = {piece: (i, round(score * self.unit)) for piece, (i, score) in scored.items()}
        #: Scores of pieces; beginnings of pieces that are none have ``NO_PIECE``.
        self.scores = {piece[:k]: NO_PIECE for piece in pieces for k in range(1, len(piece))}
        self.scores |= {piece: score for piece, (_, score) in pieces.items()}
        #: The same with the ends of pieces.
        self.backward = {piece[k:]: NO_PIECE for piece in pieces for k in range(1, len(piece))}
        self.backward |= {piece: score for piece, (_, score) in pieces.items()}
        self.ids = {piece: np.array([i], "<u4").tobytes() for piece, (i, _) in pieces.items()}
        self.byte_ids = byte_ids
        self.unknown = min((s for _, s in pieces.values() if s > UNTRAINED * self.unit), default=0) - UNKNOWN_PENALTY * self.unit
        self.spelled = np.full(1 + max([i for i, _ in pieces.values()] + byte_ids), b"", object)
        for piece, (i, _) in pieces.items():
            self.spelled[i] = piece.replace(SPACE, " ").encode()
        for b, i in enumerate(byte_ids):
            self.spelled[i] = bytes([b])
        self.words: dict[str, tuple[bytes, int, int]] = {}
        self.old: dict[str, tuple[bytes, int, int]] = {}
        self.searched: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
        self.chars = 0

    def edges(self, word: str, start: int) -> Iterator[tuple[int, int]]:
        """(end, score) of the pieces from ``start``, shortest first."""
        score = self.scores.get(word[start], NO_PIECE)
        yield start + 1, self.unknown if score == NO_PIECE else score
        for end in range(start + 2, len(word) + 1):
            if (score := self.scores.get(word[start:end])) is None:
                return
            if score != NO_PIECE:
                yield end, score

    def piece_ids(self, piece: str) -> bytes:
        if (found := self.ids.get(piece)) is None:
            found = np.array([self.byte_ids[b] for b in piece.encode("utf-8", "replace")], "<u4").tobytes()
        return found

    def forward(self, words: list[str]) -> Iterator[tuple[str, list[int], list[int], list[int]]]:
        """For each word the best and second score up to every place, and where the best came from.

        The scores of a beginning hold for all words that share it, so sorted words save the most. The lists
        are the same ones for all words.
        """
        best, second, source, last = [0], [NONE], [0], ""
        get, unknown = self.backward.get, self.unknown
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1 :], second[shared + 1 :], source[shared + 1 :]
            for j in range(shared + 1, len(word) + 1):
                i = j - 1
                score = get(word[i])
                x = y = NONE
                at = i
                if score is None or score == NO_PIECE:
                    x, y = best[i] + unknown, second[i] + unknown
                    more = score is not None
                else:
                    x, y, more = best[i] + score, second[i] + score, True
                while more and i:
                    i -= 1
                    score = get(word[i:j])
                    if score is None:
                        break
                    if score != NO_PIECE:
                        z = best[i] + score
                        if z >= x:  # of equals the longest last piece
                            x, y, at = z, x, i
                            z = second[i] + score
                        if z > y:
                            y = z
                best.append(x)
                second.append(y)
                source.append(at)
            last = word
            yield word, best, second, source

    def learn(self, words: set[str]) -> None:
        """Remember of each word the ids of its best path, its score, and how much less the second has."""
        known = {word: self.old[word] for word in words if word in self.old}
        self.words |= known
        ids = self.ids
        for word, best, second, source in self.forward(sorted(word for word in words if word not in known)):
            at, parts = len(word), []
            while at:
                piece = word[source[at] : at]
                parts.append(ids.get(piece) or self.piece_ids(piece))
                at = source[at]
            parts.reverse()
            self.words[word] = b"".join(parts), best[-1], min(best[-1] - second[-1], NO_SECOND)
            self.chars += len(word)

    def search(self, word: str, n: int) -> list[tuple[int, bytes]]:
        """The ``n`` best paths, (score, ids), by backward A* over the forward scores."""
        _, best, _, _ = next(self.forward([word]))
        into: list[list[tuple[int, int]]] = [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            for j, score in self.edges(word, i):
                into[j].append((i, score))
        out: list[tuple[int, bytes]] = []
        # Among equals the latest goes first, so the search runs to an end before it branches out.
        heap: list[tuple] = [(-best[-1], 0, len(word), 0, None)]
        order = itertools.count(1)
        while heap and len(out) < n:
            _, _, at, done, path = heapq.heappop(heap)
            if at == 0:
                parts = []
                while path is not None:
                    parts.append(path[0])
                    path = path[1]
                out.append((done, b"".join(self.piece_ids(p) for p in parts)))
                continue
            for i, score in reversed(into[at]):
                heapq.heappush(heap, (-(done + score + best[i]), -next(order), i, done + score, (word[i:at], path)))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of a sequence of ids; the mark before the first word is not part of it."""
        data = b"".join(self.spelled[np.frombuffer(ids, "<u4")].tolist())
        return data.decode("utf-8", "replace").removeprefix(" ")

    def nbest(self, texts: list[str], n: int) -> list[list[tuple[int, bytes]]]:
        """The ``n`` best segmentations of each text, (score, ids); an empty text has one, without pieces."""
        if self.chars > HELD_CHARS:
            self.old, self.words, self.chars = self.words, {}, 0
        keys = [_units(text) for text in texts]
        found = [list(map(self.words.get, of_text)) for of_text in keys]
        lacking = [at for at, values in enumerate(found) if None in values]
        if lacking:
            self.learn({key for at in lacking for key, value in zip(keys[at], found[at]) if value is None})
            for at in lacking:
                found[at] = list(map(self.words.__getitem__, keys[at]))
        return [self._combined(of_text, values, n) if of_text else [(0, b"")] for of_text, values in zip(keys, found)]

    def _combined(self, keys: list[str], found: list[tuple[bytes, int, int]], n: int) -> list[tuple[int, bytes]]:
        ids, scores, gaps = zip(*found)
        if n == 1:
            return [(sum(scores), b"".join(ids))]
        # A path that leaves the best one elsewhere is no better than n - 1 paths that leave it here once.
        near = np.array(gaps) * len(keys) + np.arange(len(keys))
        if len(near) >= n:
            near = np.partition(near, n - 2)[: n - 1]
        places = sorted(int(x % len(keys)) for x in near if x // len(keys) < NO_SECOND)
        choices = [self._known(keys[at], n) for at in places]
        ranked = sorted(
            ((sum(c[0][0] - c[k][0] for c, k in zip(choices, picks)), picks) for picks in _picks([len(c) for c in choices], n))
        )[:n]
        parts, total, out = list(ids), sum(scores), []
        for less, picks in ranked:
            for at, choice, k in zip(places, choices, picks):
                parts[at] = choice[k][1]
            out.append((total - less, b"".join(parts)))
        return out

    def _known(self, word: str, n: int) -> list[tuple[int, bytes]]:
        if (found := self.searched.get((word, n))) is None:
            if len(self.searched) > HELD_SEARCHES:
                self.searched.clear()
            found = self.search(word, n)
            if len(word) <= 64:
                self.searched[word, n] = found
        return found


def _units(text: str) -> list[str]:
    """Space marks and what follows them, up to the next; there is one before the text."""
    if not text:
        return []
    keys = text.replace(" ", SPACE).split(SPACE)
    if "" not in keys:
        return [SPACE + key for key in keys]
    return [w for w in _WORDS.findall(SPACE + text.replace(" ", SPACE)) if w]


def _picks(sizes: list[int], n: int) -> Iterator[tuple[int, ...]]:
    """Choices that can be among the n best: raising one choice gives something no better, so a choice with as
    many ahead of it as the product of its places is out, and so is all that goes on from it."""
    grown: list[tuple[tuple[int, ...], int]] = [((), 1)]
    for size in sizes:
        grown = [(picks + (k,), ahead * (k + 1)) for picks, ahead in grown for k in range(min(size, n // ahead))]
    return (picks for picks, _ in grown)


def nbest_segments(docs: DataFrame, n: int = 4, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """Up to ``n`` rows per document, best first: ``rank``, ``score``, ``n_pieces``, ``ids`` and ``round_trip``.

    ``ids`` are little-endian unsigned 32-bit integers, the score is the sum of the pieces' scores,
    in whole units (of ``1 / FRACTION`` if the model has fractional scores).
    ``round_trip`` is true if decoding gives the text back (a space mark in the text counts as a space). A null
    or empty text has one row without pieces; a text with fewer segmentations has fewer rows.
    """
    path = model or model_file()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(path)
        for batch in batches:
            sizes = np.cumsum([len(t) for t in batch.column("text").to_pylist()]) // OUT_CHARS
            starts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                doc_ids, texts = (batch.column(c).slice(a, b - a).to_pylist() for c in ("doc_id", "text"))
                out = [
                    (doc_id, rank, score, len(ids) // 4, ids, pieces.decode(ids) == text.replace(SPACE, " "))
                    for doc_id, text, found in zip(doc_ids, texts, pieces.nbest(texts, n))
                    for rank, (score, ids) in enumerate(found, 1)
                ]
                if out:
                    yield pa.record_batch(list(map(list, zip(*out))), schema=_ARROW)

    return id_and_text(docs, id_col, text_col).mapInArrow(rows, ROWS)
