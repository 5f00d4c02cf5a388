"""Token counts by compiled finite-state machines.

The vocabulary file of a byte-level pair-merging tokenizer is compiled into two machines.

* A deterministic transducer over character symbols splits texts into pre-tokens. Each transition
  says whether a pre-token begins. The characters of many texts are cut into chunks of equal
  length; every chunk is run from all states at once, which gives its state map, the maps are composed
  by a parallel prefix scan, and a second run from the now known states emits the beginnings.
* A trie transducer over bytes finds the vocabulary tokens at every place of a pre-token. Its transitions
  carry the counts: reaching place ``i`` by token ``t`` from place ``i - len(t)`` emits one more token
  than that place had, and is allowed when ``t`` may follow the token that ended there. Two tokens
  may be neighbours when no merge across their border comes before the merges that built
  them; a sequence of allowed neighbours is the one the merges give, so one token is allowed per place.
  Distinct pre-tokens of a slice run side by side, and known ones are kept.

Rows: a null text is empty and has 0 tokens. The special strings of the file count as one token each, as
the tokenizer library has it by default. Texts are read whole. Repeated rows count alike; an
empty table gives no rows; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import SpanHasher, text_slices

# Symbols of the splitter. A blank is told apart by what follows it, an apostrophe by the ending after it.
LETTER, NUMBER, OTHER, SPACE_TEXT, BLANK_TEXT, BLANK_MORE, ENDING_1, ENDING_2, EDGE = range(9)
N_SYMBOLS = 16
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, ONE_LEFT, TWO_LEFT = range(8)
N_STATES = 8
CHUNK = 128
KEPT = 400_000


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission (1: a pre-token begins) for state * N_SYMBOLS + symbol."""
    goto, emits = np.zeros((N_STATES, N_SYMBOLS), np.uint8), np.zeros((N_STATES, N_SYMBOLS), np.uint8)
    inside = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    for state in range(N_STATES):
        for symbol, own in inside.items():
            goto[state, symbol], emits[state, symbol] = own, state not in (own, AFTER_SPACE)
        goto[state, SPACE_TEXT], emits[state, SPACE_TEXT] = AFTER_SPACE, 1
        goto[state, BLANK_TEXT], emits[state, BLANK_TEXT] = CLOSED, 1
        goto[state, BLANK_MORE], emits[state, BLANK_MORE] = IN_BLANKS, state != IN_BLANKS
        joined = state in (AFTER_SPACE, IN_OTHERS)
        for symbol, left in ((ENDING_1, ONE_LEFT), (ENDING_2, TWO_LEFT)):
            goto[state, symbol], emits[state, symbol] = (IN_OTHERS, state == CLOSED) if joined else (left, 1)
        goto[state, EDGE] = CLOSED
    goto[ONE_LEFT, LETTER], emits[ONE_LEFT, LETTER] = CLOSED, 0
    goto[TWO_LEFT, LETTER], emits[TWO_LEFT, LETTER] = ONE_LEFT, 0
    return goto.ravel(), emits.ravel()


def character_kinds() -> np.ndarray:
    """Kind of each code point: letter, number, other, or blank (as BLANK_MORE)."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
        elif major == "Z":
            kinds[point] = BLANK_MORE
    kinds[[*range(0x09, 0x0E), 0x85]] = BLANK_MORE
    return kinds


def symbols(points: np.ndarray, edges: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Symbol of each code point; ``edges`` are the places of the separators between texts."""
    out = kinds[points]
    out[edges] = EDGE
    blank = out == BLANK_MORE
    followed = np.zeros(len(out), bool)
    followed[:-1] = (out[1:] != BLANK_MORE) & (out[1:] != EDGE)
    out[blank & followed] = BLANK_TEXT
    out[(points == 0x20) & (out == BLANK_TEXT)] = SPACE_TEXT
    quotes = np.flatnonzero((points == 0x27) & (out == OTHER))
    if len(quotes):
        padded = np.append(points, np.zeros(2, points.dtype))
        # A separator is never one of these letters, so endings stay inside a text.
        first, second = padded[quotes + 1], padded[quotes + 2]
        out[quotes[np.isin(first, [ord(c) for c in "stmd"])]] = ENDING_1
        double = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        out[quotes[double]] = ENDING_2
    return out


def beginnings(marks: np.ndarray, goto: np.ndarray, emits: np.ndarray) -> np.ndarray:
    """Places where a pre-token begins, by chunk state maps and a prefix scan."""
    n = len(marks)
    n_chunks = -(-n // CHUNK)
    lanes = np.full(n_chunks * CHUNK, EDGE, np.uint8)
    lanes[:n] = marks
    lanes = np.ascontiguousarray(lanes.reshape(n_chunks, CHUNK).T)
    maps = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], n_chunks, 1)
    for step in range(CHUNK):
        maps = goto.take(maps * np.uint8(N_SYMBOLS) + lanes[step])
    maps = maps.T
    reach = 1
    while reach < n_chunks:  # maps[k] becomes the map of all chunks up to k
        later = np.take_along_axis(maps[reach:], maps[:-reach], 1)
        maps = np.concatenate([maps[:reach], later])
        reach *= 2
    state = np.zeros(n_chunks, np.uint8)
    state[1:] = maps[:-1, CLOSED]
    out = np.zeros((CHUNK, n_chunks), np.uint8)
    for step in range(CHUNK):
        at = state * np.uint8(N_SYMBOLS) + lanes[step]
        out[step] = emits.take(at)
        state = goto.take(at)
    return np.flatnonzero(out.T.ravel()[:n])


class Machine(NamedTuple):
    """Compiled vocabulary; tokens are numbered bytes first, then merges in order."""

    kinds: np.ndarray
    goto: np.ndarray
    emits: np.ndarray
    edge_keys: np.ndarray  # hash table of node * 256 + byte
    edge_to: np.ndarray
    node_token: np.ndarray
    pair_keys: np.ndarray  # hash table of left * 2**32 + right
    pair_token: np.ndarray
    left: np.ndarray
    right: np.ndarray
    specials: list[str]


def byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in plain):
        out[chr(256 + k)] = b
    return out


def compile_vocabulary(path: str) -> Machine:
    """Machines of a byte-level vocabulary file (JSON with a merge list)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, stand_in = spec["model"], byte_of()
    numbers: dict[bytes, int] = {bytes([b]): b for b in range(256)}
    left, right = list(range(256)), list(range(256))
    pairs = {}
    for merge in model["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        a, b = bytes(stand_in[c] for c in a), bytes(stand_in[c] for c in b)
        number = len(left)
        numbers.setdefault(a + b, number)
        pairs[numbers[a] << 32 | numbers[b]] = number
        left.append(numbers[a])
        right.append(numbers[b])
    edges: dict[int, int] = {}
    node_token = [-1]
    for token, number in numbers.items():
        node = 0
        for byte in token:
            key = node * 256 + byte
            if key not in edges:
                edges[key] = len(node_token)
                node_token.append(-1)
            node = edges[key]
        node_token[node] = number
    goto, emits = splitter()
    return Machine(
        character_kinds(), goto, emits, *hash_table(edges), np.array(node_token, np.int32), *hash_table(pairs),
        np.array(left, np.int32), np.array(right, np.int32), [t["content"] for t in spec.get("added_tokens", [])],
    )


def slots(keys: np.ndarray, size: int) -> np.ndarray:
    """Home slot of each key in a table of ``size`` (a power of two) slots."""
    shift = np.uint64(64 - (size.bit_length() - 1))
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)


def hash_table(items: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Open-addressing table, at most a quarter full: keys (-1: free) and values."""
    size = 1 << (4 * len(items)).bit_length()
    keys, values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
    left, given = np.array(list(items), np.int64), np.array(list(items.values()), np.int32)
    slot = slots(left, size)
    while len(left):
        free = keys[slot] == -1
        _, first = np.unique(slot, return_index=True)
        first = first[free[first]]
        keys[slot[first]], values[slot[first]] = left[first], given[first]
        rest = np.ones(len(left), bool)
        rest[first] = False
        left, given, slot = left[rest], given[rest], (slot[rest] + 1) & (size - 1)
    return keys, values


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the wanted keys, -1 where a key is missing."""
    slot = slots(wanted, len(keys))
    there = keys[slot]
    out = values[slot]
    out[there != wanted] = -1
    live = np.flatnonzero((there != wanted) & (there != -1))
    slot = slot[live]
    while len(live):
        slot = (slot + 1) & (len(keys) - 1)
        there = keys[slot]
        hit = there == wanted[live]
        out[live[hit]] = values[slot[hit]]
        on = ~hit & (there != -1)
        live, slot = live[on], slot[on]
    return out


def may_follow(a: np.ndarray, b: np.ndarray, m: Machine) -> np.ndarray:
    """Whether token ``b`` may stand after token ``a``.

    Undoes the merges of both sides at their border, latest first. A merge across the border that comes
    before the merges which took up its two sides would have been made instead.
    """
    never = np.iinfo(np.int32).max
    good = np.ones(len(a), bool)
    live = np.arange(len(a))
    taken_a, taken_b = np.full(len(a), never), np.full(len(a), never)
    while len(live):
        across = look_up(m.pair_keys, m.pair_token, a.astype(np.int64) << 32 | b)
        bad = (across >= 0) & (across < taken_a) & (across <= taken_b)
        good[live[bad]] = False
        on = ~bad & (np.maximum(a, b) >= 256)
        live, a, b, taken_a, taken_b = live[on], a[on], b[on], taken_a[on], taken_b[on]
        undo_a = a > b
        taken_a, taken_b = np.where(undo_a, a, taken_a), np.where(undo_a, taken_b, b)
        a, b = np.where(undo_a, m.right[a], a), np.where(undo_a, b, m.left[b])
    return good


def emitted(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, m: Machine) -> np.ndarray:
    """Tokens emitted for each pre-token, all run side by side."""
    lengths = ends - starts
    n, total = len(starts), int(lengths.sum())
    base = np.cumsum(lengths) - lengths
    where = np.arange(total) - np.repeat(base, lengths)  # place in the pre-token
    flat = data[np.repeat(starts, lengths) + where].astype(np.int64)
    room = np.repeat(lengths, lengths) - where
    # Candidates: every vocabulary token at every place, found by walking the trie from all places.
    ends_at, sizes, tokens = [], [], []
    live, node, size = np.arange(total), np.zeros(total, np.int64), 0
    while len(live):
        node = look_up(m.edge_keys, m.edge_to, node * 256 + flat[live + size]).astype(np.int64)
        size += 1
        alive = node >= 0
        live, node = live[alive], node[alive]
        token = m.node_token[node]
        some = token >= 0
        ends_at.append(live[some] + size - 1)
        sizes.append(np.full(some.sum(), size))
        tokens.append(token[some])
        on = room[live] > size
        live, node = live[on], node[on]
    at, size, token = np.concatenate(ends_at), np.concatenate(sizes), np.concatenate(tokens)
    # Places are settled in order of their distance from the start, all pre-tokens at once.
    place = where[at].astype(np.int32)
    order = np.argsort(place.astype(np.uint16) if len(place) == 0 or place.max() < 1 << 16 else place, kind="stable")
    at, size, token = at[order], size[order], token[order]
    bounds = np.searchsorted(place[order], np.arange(int(lengths.max()) + 1 if n else 1))
    last, count = np.full(total, -1, np.int32), np.zeros(total, np.int32)
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        here, long, tok = at[lo:hi], size[lo:hi], token[lo:hi]
        whole = where[here] + 1 == long
        before = here - long
        fine = whole.copy()
        fine[~whole] = may_follow(last[before[~whole]], tok[~whole], m)
        here, tok = here[fine], tok[fine]
        last[here] = tok
        count[here] = 1 + np.where(whole[fine], 0, count[np.maximum(before[fine], 0)])
    return count[base + lengths - 1] if n else np.zeros(0, np.int32)


class Counter:
    """Token counts of the texts of a slice; keeps the counts of known pre-tokens."""

    def __init__(self, machine: Machine) -> None:
        self.machine, self.hasher, self.known = machine, SpanHasher(), {}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = data.tobytes()
        n = len(offsets) - 1
        found = [s for s in self.machine.specials if raw.find(s.encode()) >= 0]
        if not found:
            return self.plain(data, offsets)
        # Split at special strings; each is one token, and the parts are texts of their own.
        pieces, owner, out = [], [], np.zeros(n, np.int64)
        for d in range(n):
            parts = [raw[offsets[d] : offsets[d + 1]]]
            for special in found:
                parts = [x for p in parts for x in p.split(special.encode())]
            out[d] = len(parts) - 1
            pieces += parts
            owner += [d] * len(parts)
        joined = np.frombuffer(b"".join(pieces), np.uint8)
        counts = self.plain(joined, np.concatenate([[0], np.cumsum([len(p) for p in pieces])]))
        np.add.at(out, owner, counts)
        return out

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        m, n = self.machine, len(offsets) - 1
        if len(data) == 0:
            return np.zeros(n, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        # A separator goes before every text.
        at = np.searchsorted(heads, offsets[:-1])
        edges = at + np.arange(n)
        spread = np.zeros(len(points) + n, np.uint32)
        real = np.ones(len(spread), bool)
        real[edges] = False
        spread[real] = points
        places = beginnings(symbols(spread, edges, m.kinds), m.goto, m.emits)
        starts = heads[places - np.searchsorted(edges, places)]
        ends = np.append(starts[1:], len(data))
        hashes = self.hasher(data, starts, ends)
        unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > KEPT:
            self.known.clear()
        names = unique.tolist()
        counts = np.array(list(map(self.known.get, names, [0] * len(names))), np.int64)
        new = np.flatnonzero(counts == 0)
        if len(new):
            counts[new] = emitted(data, starts[first[new]], ends[first[new]], m)
            self.known.update(zip(unique[new].tolist(), counts[new].tolist(), strict=True))
        running = np.concatenate([[0], np.cumsum(counts[which])])
        return np.diff(running[np.searchsorted(starts, offsets)])


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs(doc_id, text)``.

    ``vocabulary`` is the path of the tokenizer file on the driver; the compiled machines, whose size
    follows the vocabulary alone (12 MB for 50,000 merges), are broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(compile_vocabulary(vocabulary)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Machine(*shared.value))
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1), 2 << 20):
                n = counter(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(offsets)), pa.array(n.astype(np.int64)), pa.array(n > limit)],
                    names=[x.split()[0] for x in SCHEMA.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, SCHEMA)
