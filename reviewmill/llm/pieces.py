"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search runs over the lattice of vocabulary pieces. The model is of the byte-pair kind, so a path
is not scored by a sum: it is admissible if each two neighbouring pieces would come out of the
model's merges for just the two of them, and exactly one admissible path leads to every boundary,
the model's own segmentation of the text up to there. The search keeps one survivor (piece and back
pointer) for each boundary of the last ``longest`` characters, ``longest`` being the length of the
longest piece. Ids are committed as soon as the back-pointer paths of all survivors run through one
boundary; what is kept does not grow with the text.

A place that no piece can span, such as a space after a letter, is a boundary on which all paths
converge. The text between two such places is searched once and remembered, in a bounded table.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.frames import by_batch, pick

TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: stretches of text remembered in each of two halves
REMEMBERED = 250_000
PAIRS = 400_000
#: longer stretches are searched every time
MEMORABLE = 64


class Pieces:
    """The vocabulary of a model file, with encoding and decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.raw = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.raw.items()}
        #: what a piece adds to a text, and whether it is a part of a character only
        self.shown = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else self.text[i] for i in range(size)]
        self.partial = np.array([self.byte_of.get(i, 0) > 127 for i in range(size)], bool)
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.ids))
        #: lengths of the pieces of three characters or more that end in three given ones, longest first
        lengths: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 2:
                lengths.setdefault(piece[-3:], set()).add(len(piece))
        self.lengths = {end: tuple(sorted(found, reverse=True)) for end, found in lengths.items()}
        #: neighbouring characters that some piece holds; no piece spans any others
        self.inside = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        # No piece spans a space after another character, or a character that no longer piece has.
        spanned = any(SPACE in piece.lstrip(SPACE) for piece in self.ids)
        lone = [c for c in "\n\t\r" if not any(c in piece for piece in self.ids)]
        alone = "".join(map(re.escape, lone))
        self.stretch = re.compile(
            "(?s).+" if spanned else f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if lone else f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        )
        #: ids of stretches met lately, and those met before; the older half is dropped when the newer is full
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def forget(self) -> None:
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        if len(self.pairs) >= PAIRS:
            self.pairs = {}

    def merged(self, text: str) -> list[str]:
        """The model's merges for a short text: always the best scoring neighbours, the leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, pair: tuple[str, str]) -> bool:
        """Whether two pieces stay as they are beside each other."""
        found = self.merged(pair[0] + pair[1]) == list(pair)
        self.pairs[pair] = found
        return found

    def search(self, text: str) -> Iterator[str]:
        """Pieces of a stretch of text, as soon as they are certain."""
        survivors = [""]  # by boundary, counted from the last commit: the piece that ends there
        base = 0  # the last commit's place in the text
        ids, lengths, known, neighbours = self.ids, self.lengths, self.pairs.get, self.neighbours
        enough = 4 * self.longest
        for end in range(1, len(text) + 1):
            here = end - base
            chosen = text[end - 1]
            for length in lengths.get(text[end - 3 : end], ()) if here > 2 else ():
                if length <= here:
                    piece = text[end - length : end]
                    if piece in ids:
                        before = survivors[here - length]
                        if not before:
                            chosen = piece
                            break
                        stays = known((before, piece))
                        if stays or stays is None and neighbours((before, piece)):
                            chosen = piece
                            break
            else:
                if here > 1:
                    piece = text[end - 2 : end]
                    if piece in ids:
                        before = survivors[here - 2]
                        if not before:
                            chosen = piece
                        else:
                            stays = known((before, piece))
                            if stays or stays is None and neighbours((before, piece)):
                                chosen = piece
            survivors.append(chosen)
            if here >= enough and end < len(text):
                settled = self._converged(survivors, here)
                if settled:
                    yield from self._path(survivors, settled)
                    survivors = ["", *survivors[settled + 1 :]]
                    base += settled
        yield from self._path(survivors, len(text) - base)

    def _converged(self, survivors: list[str], end: int) -> int:
        """The last boundary that the paths of all survivors of the window run through."""
        fronts = set(range(end - self.longest + 1, end + 1))
        while len(fronts) > 1:
            last = max(fronts)
            fronts.remove(last)
            fronts.add(last - len(survivors[last]))
        return fronts.pop()

    @staticmethod
    def _path(survivors: list[str], end: int) -> list[str]:
        found = []
        while end > 0:
            found.append(survivors[end])
            end -= len(survivors[end])
        return found[::-1]

    def piece_ids(self, piece: str) -> list[int]:
        own = self.ids.get(piece)
        if own is not None:
            return [own]
        return [self.raw.get(b, self.unknown) for b in piece.encode()]

    def _part_ids(self, part: str) -> tuple[int, ...]:
        """Ids of text that holds no sure boundary."""
        found = self.known.get(part) or self.older.get(part)
        if found is None:
            found = tuple(i for piece in self.search(part) for i in self.piece_ids(piece))
        if len(part) <= MEMORABLE:
            self.known[part] = found
        return found

    def _stretch_ids(self, stretch: str) -> tuple[int, ...]:
        """Ids of a stretch, searched between the places that no piece spans."""
        self.forget()
        inside = self.inside
        if stretch in self.older or all(map(inside.__contains__, map(add, stretch, stretch[1:]))):
            return self._part_ids(stretch)
        out: list[int] = []
        start = 0
        for end in range(1, len(stretch) + 1):
            if end == len(stretch) or stretch[end - 1 : end + 1] not in inside:
                out += self._part_ids(stretch[start:end])
                start = end
        found = tuple(out)
        if len(stretch) <= MEMORABLE:
            self.known[stretch] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, as the model's own merges give them."""
        stretches = self.stretch.findall(SPACE + text.replace(" ", SPACE)) if text else []
        found = list(map(self.known.get, stretches))
        if None in found:
            found = [self.known.get(s) or self._stretch_ids(s) if ids is None else ids for s, ids in zip(stretches, found, strict=True)]
        return np.array(list(chain.from_iterable(found)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids that ``encode`` gave."""
        if not self.partial[ids].any():
            return "".join(map(self.shown.__getitem__, ids.tolist())).replace(SPACE, " ").removeprefix(" ")
        out, text, byte_of = bytearray(), self.text, self.byte_of
        run: list[str] = []
        for i in ids.tolist():
            byte = byte_of.get(i)
            if byte is None:
                run.append(text[i])
            else:
                out += "".join(run).encode()
                run = []
                out.append(byte)
        out += "".join(run).encode()
        return out.decode(errors="replace").replace(SPACE, " ").removeprefix(" ")


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    """The vocabulary of a worker."""
    return Pieces(path)


def model_path(folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, MODEL)


def encode_documents(docs: DataFrame, *, path: str | None = None) -> DataFrame:
    """``doc_id, ids, n_ids, ids_sha256, round_trip``, one row for each row.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers; ``round_trip`` tells whether
    decoding gives the text back. Null and empty texts have no ids. A text that holds the character
    the model writes for a space comes back with a space there. Other columns are ignored.
    """
    path = path or model_path()

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        texts = [t or "" for t in batch["text"].to_pylist()]
        for low in range(0, len(texts), 256):
            ids = [vocabulary.encode(t) for t in texts[low : low + 256]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][low : low + 256],
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([vocabulary.decode(x) == t for x, t in zip(ids, texts[low : low + 256], strict=True)], pa.bool_()),
                ],
                names=["doc_id", "ids", "n_ids", "ids_sha256", "round_trip"],
            )

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return by_batch(rows, encode, "doc_id long, ids array<int>, n_ids long, ids_sha256 string, round_trip boolean")


def decode_documents(encoded: DataFrame, *, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of a table with ``ids``; null ids give an empty text."""
    path = path or model_path()

    def decode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        texts = [vocabulary.decode(np.array(x or [], np.int32)) for x in batch["ids"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return by_batch(pick(encoded, "doc_id", "ids"), decode, "doc_id long, text string")
