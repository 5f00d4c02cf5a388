"""Exact encoding and decoding with the merge type of sentence-piece models.

The library merges neighbouring symbols, best score first and leftmost among equals, until no merge is
left. The same pieces are found here without a merge queue over the text:

* An Aho-Corasick automaton over the reversed pieces is run over the reversed text. At each place it
  reports the longest piece that begins there; the next shorter one is known for each piece.
* Pieces are laid from left to right, longest first. Two neighbours are *compatible* when merging the
  joined string of both anew gives just these two. Merges that happen in one part of a text never depend
  on another part, so a sequence of compatible neighbours is what the merges give, and there is one for every prefix.
* A place from which no piece leads on is marked in a bitfield of failed positions and the last piece is
  taken back. As the pieces up to a place are unique, no place is tried twice.

A text is cut beforehand between any two characters that stand side by side in no piece of the model, since no merge
joins them: before a blank that ends a word, around a line feed or a foreign letter. Equal parts are encoded once for
a slice of texts, and remembered.

Decoding concatenates the pieces, turns the blank sign back into a blank, drops the blank that encoding put
first, and reads runs of byte pieces as UTF-8, each byte that is none as U+FFFD.

Rows: a null or empty text has no ids and decodes to an empty text. Texts are read whole, of any
length. Repeated rows are rows of their own; an empty table gives no rows; null ids stay null; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import SpanHasher, mix, spread, text_slices

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NO_PIECE = -1
# Entries of a worker's tables of known parts and pairs, after which it starts them anew.
KEPT = 250_000
POINT_VALUES = mix(np.arange(1, 0x110001, dtype=np.uint64)) | np.uint64(1)


class Model(NamedTuple):
    """What a model file says; in ``texts`` the blank sign is a plain blank."""

    texts: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool
    unknown_text: str


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message in the wire format of protocol buffers."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
            continue
        size = number() if wire == 2 else {1: 8, 5: 4}[wire]
        yield key >> 3, data[at : at + size]
        at += size


def read_model(path: str) -> Model:
    """Reads a model file. Raises ValueError for what this module does not encode: other model types, character maps, user symbols."""
    with open(path, "rb") as f:
        message = list(_fields(f.read()))
    trainer = dict(_fields(next(v for k, v in message if k == 2)))
    normalizer = dict(_fields(next(v for k, v in message if k == 3)))
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("only merge models with byte fallback and blanks before words are supported")
    if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("only models without character map that keep all blanks are supported")
    texts, scores, kinds = [], [], []
    for _, value in (m for m in message if m[0] == 1):
        entry = dict(_fields(value))
        texts.append(entry[1].decode().replace(BLANK, " "))
        scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
        kinds.append(entry.get(3, NORMAL))
    if not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("user-defined and unused pieces are not supported")
    return Model(texts, scores, kinds, bool(normalizer.get(3, 1)), trainer.get(44, " ⁇ ".encode()).decode())


class Encoder:
    """Encodes single parts of texts. Ids below -1 stand for characters that are no piece."""

    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.text, self.score = model.texts, model.scores
        self.ids = {t: i for i, (t, k) in enumerate(zip(model.texts, model.kinds, strict=True)) if k == NORMAL}
        self.byte_ids = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(model.texts, model.kinds, strict=True)) if k == BYTE}
        self.longest_size = max(map(len, self.ids), default=1)
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text[::-1], i)
        self.automaton.make_automaton()
        self.shorter = {i: self._shorter(text) for text, i in self.ids.items()}
        self.sizes = [len(t) for t in model.texts]
        self.fits: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def _shorter(self, text: str) -> int:
        """The longest piece that ``text`` begins with and is longer than."""
        for size in range(len(text) - 1, 0, -1):
            if (i := self.ids.get(text[:size])) is not None:
                return i
        return self._character(text[0]) if len(text) > 1 else NO_PIECE

    @staticmethod
    def _character(c: str) -> int:
        return -2 - ord(c)

    def text_of(self, i: int) -> str:
        return self.text[i] if i >= 0 else chr(-2 - i)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: best score first, leftmost among equals."""
        parts = list(text)
        ids, score = self.ids, self.score
        while len(parts) > 1:
            best, where = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, where = score[i], k
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging both anew keeps them apart and whole."""
        key = (left << 32) + right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > KEPT:
                self.fits.clear()
            a, b = self.text_of(left), self.text_of(right)
            known = self.fits[key] = self.merged(a + b) == [a, b]
        return known

    def stable(self, i: int) -> bool:
        """Whether merging a piece anew gives it again."""
        known = self.whole.get(i)
        if known is None:
            known = self.whole[i] = len(self.merged(self.text_of(i))) == 1
        return known

    def __call__(self, part: str) -> list[int]:
        n = len(part)
        longest = [NO_PIECE] * n
        for end, i in self.automaton.iter(part[::-1]):
            if longest[n - 1 - end] == NO_PIECE:  # the first report at a place is its longest piece
                longest[n - 1 - end] = i
        sizes, shorter, fits = self.sizes, self.shorter, self.fits
        failed, any_failed = bytearray((n >> 3) + 1), False
        laid: list[int] = []
        at, last = 0, NO_PIECE
        piece = longest[0] if longest[0] >= 0 else self._character(part[0])
        while True:
            while piece != NO_PIECE:
                end = at + (sizes[piece] if piece >= 0 else 1)
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    fit = fits.get((last << 32) + piece) if at else self.stable(piece)
                    if fit or fit is None and self.compatible(last, piece):
                        break
                piece = shorter[piece] if piece >= 0 else NO_PIECE
            if piece != NO_PIECE:
                laid.append(piece)
                if end == n:
                    break
                at, last = end, piece
                piece = longest[at] if longest[at] >= 0 else self._character(part[at])
            else:
                any_failed = True
                failed[at >> 3] |= 1 << (at & 7)
                piece = laid.pop()
                at -= sizes[piece] if piece >= 0 else 1
                last = laid[-1] if laid else NO_PIECE
                piece = shorter[piece] if piece >= 0 else NO_PIECE
        if min(laid) >= 0:
            return laid
        out = []
        for i in laid:
            if i >= 0:
                out.append(i)
            else:
                out += [self.byte_ids[b] for b in chr(-2 - i).encode()]
        return out


class TextEncoder:
    """Ids of all texts of a slice."""

    def __init__(self, model: Model) -> None:
        self.encoder, self.dummy_prefix = Encoder(model), model.dummy_prefix
        # Characters of pieces are numbered from 1, all others are 0; ``joined`` has the pairs that stand side by side in a piece.
        several = [t for t in self.encoder.ids if len(t) > 1]
        number = {c: k for k, c in enumerate(sorted(set("".join(several))), 1)}
        self.width = len(number) + 1
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in number]] = list(number.values())
        self.joined = np.zeros(self.width**2, bool)
        self.joined[[number[x] * self.width + number[y] for t in several for x, y in zip(t, t[1:], strict=False)]] = True
        self.hasher, self.known = SpanHasher(), {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and where each text's ids begin and end."""
        n = len(offsets) - 1
        raw = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.searchsorted(heads, offsets)
        some = (np.diff(first) > 0) & self.dummy_prefix
        first[1:] += np.cumsum(some)
        points = np.full(len(raw) + int(some.sum()), 0x20, np.uint32)
        own = np.ones(len(points), bool)
        own[first[:-1][some]] = False
        points[own] = raw
        points[points == ord(BLANK)] = 0x20
        if len(points) == 0:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        number = self.number[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joined[number[:-1] * self.width + number[1:]]
        cut[first[:-1][first[:-1] < len(points)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(points))
        hashes = self.hasher(points, starts, ends, POINT_VALUES)
        _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        text = points.tobytes().decode("utf-32-le")
        if len(self.known) > KEPT:
            self.known.clear()
        ids, sizes = [], np.zeros(len(example), np.int64)
        for k, (a, b) in enumerate(zip(starts[example].tolist(), ends[example].tolist(), strict=True)):
            part = text[a:b]
            got = self.known.get(part)
            if got is None:
                got = self.encoder(part)
                if b - a <= 64:
                    self.known[part] = got
            ids += got
            sizes[k] = len(got)
        begins = np.cumsum(sizes) - sizes
        flat = np.array(ids, np.int32)[spread(begins[which], sizes[which])]
        running = np.concatenate([[0], np.cumsum(sizes[which])])
        return flat, running[np.searchsorted(starts, first)]


class Decoder:
    """Texts of id sequences."""

    def __init__(self, model: Model) -> None:
        shown = []
        for text, kind in zip(model.texts, model.kinds, strict=True):
            shown.append(bytes([int(text[3:5], 16)]) if kind == BYTE else {CONTROL: "", UNKNOWN: model.unknown_text}.get(kind, text).encode())
        self.sizes = np.array([len(s) for s in shown], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        kinds = np.array(model.kinds)
        self.silent = kinds == CONTROL
        self.blank_first = np.array([k == NORMAL and t.startswith(" ") for t, k in zip(model.texts, model.kinds, strict=True)]) & model.dummy_prefix

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Text of each run ``offsets[k]:offsets[k + 1]`` of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)):
            raise ValueError("an id is not in the model")
        begins, sizes = self.begins[ids], self.sizes[ids]
        loud = np.flatnonzero(~self.silent[ids])
        lead = np.searchsorted(loud, offsets[:-1])
        inside = lead < len(loud)
        lead = loud[lead[inside]]
        lead = lead[lead < offsets[1:][inside]]
        lead = lead[self.blank_first[ids[lead]]]
        begins[lead] += 1
        sizes[lead] -= 1
        raw = self.bytes[spread(begins, sizes)].tobytes()
        at = np.concatenate([[0], np.cumsum(sizes)])
        # A silent piece ends a run of bytes.
        breaks = np.flatnonzero(self.silent[ids])
        cuts = at[np.sort(np.concatenate([offsets, breaks]), kind="stable")].tolist()
        per_text = (np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1).tolist()
        parts = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            text = raw[a:b].decode("utf-8", "surrogateescape")
            parts.append(text if text.isascii() else re.sub("[\udc80-\udcff]", "�", text))
        if not len(breaks):
            return parts
        out, k = [], 0
        for n in per_text:
            out.append("".join(parts[k : k + n]))
            k += n
        return out


def _list_parts(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids and the bounds of each row's ids."""
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _encoded(batches: Iterator[pa.RecordBatch], encoder: TextEncoder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in text_slices(batch.column(1)):
            ids, bounds = encoder(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], decoder: Decoder) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array(decoder(*_list_parts(batch.column(1))), pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=["doc_id", "ids", "decoded"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _shared(df: DataFrame, model_file: str):
    """The model as a broadcast; a few MB, whatever the number of rows."""
    return df.sparkSession.sparkContext.broadcast(tuple(read_model(model_file)))


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, ids)`` per row of ``docs(doc_id, text)``, without begin and end ids. ``model_file`` is a path on the driver."""
    shared = _shared(docs, model_file)
    return _texts(docs).mapInArrow(lambda batches: _encoded(batches, TextEncoder(Model(*shared.value))), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` per row of ``encoded(doc_id, ids)``; null ids decode to an empty text."""
    shared = _shared(encoded, model_file)
    rows = encoded.select("doc_id", F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(lambda batches: _decoded(batches, Decoder(Model(*shared.value))), "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """:func:`encode` and :func:`decode` of its ids in one pass, with one worker process per task."""
    shared = _shared(docs, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        return _decoded(_encoded(batches, TextEncoder(model)), Decoder(model))

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
