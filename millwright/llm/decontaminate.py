"""Benchmark decontamination by spaced-seed hashing.

A mask marks some of the words of a window and ignores the others, so a passage still hits where a word
was replaced. The masks are chosen so that whichever words an accepted window may have replaced, one of
them fits between these somewhere (:func:`masks`): nothing that verification accepts is missed. The hashes of all masks over every position of a text are looked up in those of the
benchmark; around each hit the two word sequences are laid on each other and compared word by word.
A pair counts when some ``window`` aligned words (or the whole item, if shorter) agree in at least
``min_equal`` of their places.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. Items shorter
than the window have masks of their own for their length; items below ``min_item_words``
words, null and empty items are not searched. Null and empty texts match nothing. Repeated rows
give repeated results; null ids stay null; an empty table or benchmark gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import BARE, FOLDED_VALUES, MULTIPLIERS, SpanHasher, find_words, mix, text_slices

MOST = 6
# Larger covers are not searched for.
LONGEST, PLACEMENTS = 14, 500
LOW = np.uint64(0xFFFF)
SCHEMA = "doc_id long, item_id long, start_word long, n_words long, n_equal long"


def least_equal(size: int, min_equal: float) -> int:
    """Equal words that ``size`` aligned words need."""
    return int(np.ceil(min_equal * size))


@cache
def masks(size: int, replaced: int) -> tuple[str, ...]:
    """Masks of which one, at some shift, avoids any ``replaced`` of ``size`` words.

    The heaviest weight for which a greedy cover of all placements has at most ``MOST`` masks. Where there are
    too many placements to list: the run of words that must be left between the replaced ones.
    """
    if replaced <= 0 or size > LONGEST or comb(size, replaced) > PLACEMENTS:
        return ("1" * min(len(MULTIPLIERS), max(1, -(-(size - replaced) // (replaced + 1)))),)
    lost = [sum(1 << p for p in places) for places in combinations(range(size), replaced)]
    for weight in range(size - replaced, 1, -1):
        covers = {}
        for marks in ((0, *rest) for rest in combinations(range(1, size), weight - 1)):
            own = sum(1 << p for p in marks)
            shifts = range(size - marks[-1])
            covers[marks] = sum(1 << i for i, gone in enumerate(lost) if any(not (own << s) & gone for s in shifts))
        open_, chosen = (1 << len(lost)) - 1, []
        while open_ and len(chosen) < MOST:
            best = max(covers, key=lambda m: (covers[m] & open_).bit_count())
            chosen.append("".join("01"[p in best] for p in range(best[-1] + 1)))
            open_ &= ~covers[best]
        if not open_:
            return tuple(chosen)
    return ("1",)


class Benchmark:
    """Hashes of one block of benchmark items, sorted for look-up."""

    def __init__(self, item_ids: list[int], texts: list[str], min_item_words: int, window: int = 13, min_equal: float = 0.8) -> None:
        column = pa.array(texts, pa.large_string())
        hasher, parts, self.ids = SpanHasher(), [], []
        for i, j, data, offsets in text_slices(column):
            found = find_words(data, offsets, BARE)
            hashes = hasher(data, found.starts, found.ends, FOLDED_VALUES)
            for d in range(j - i):
                own = hashes[found.first[d] : found.first[d + 1]]
                if len(own) >= min_item_words:
                    parts.append(own)
                    self.ids.append(item_ids[i + d])
        self.words = parts
        self.tables = {}
        by_pattern: dict[str, list[tuple[np.ndarray, int]]] = {}
        for item, own in enumerate(parts):
            size = min(window, len(own))
            for pattern in masks(size, size - least_equal(size, min_equal)):
                by_pattern.setdefault(pattern, []).append((spaced(own, pattern), item))
        for pattern, found in by_pattern.items():
            hashes = np.concatenate([h for h, _ in found])
            item = np.concatenate([np.full(len(h), k) for h, k in found])
            at = np.concatenate([np.arange(len(h)) for h, _ in found])
            order = np.argsort(hashes, kind="stable")
            near = np.zeros(1 << 16, bool)
            near[(hashes & LOW).astype(np.int64)] = True
            self.tables[pattern] = (hashes[order], item[order], at[order], near)


def spaced(words: np.ndarray, pattern: str) -> np.ndarray:
    """Hash of the words at the marked places of ``pattern``, at every position."""
    n = len(words) - len(pattern) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for place, mark in enumerate(pattern):
        if mark == "1":
            total += words[place : place + n] * MULTIPLIERS[place]
    return mix(total)


def matches(words: np.ndarray, first: np.ndarray, bench: Benchmark, window: int, min_equal: float) -> list[tuple[int, int, int, int, int]]:
    """Text, item, first word, number of words and of equal words of each verified overlap."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    lines: set[tuple[int, int, int]] = set()
    for pattern, (hashes, item, at, near) in bench.tables.items():
        here = spaced(words, pattern)
        if len(here) == 0:
            continue
        some = np.flatnonzero(near[(here & LOW).astype(np.int64)])
        left = np.searchsorted(hashes, here[some], "left")
        hit = (left < len(hashes)) & (hashes[np.minimum(left, len(hashes) - 1)] == here[some])
        hit &= owner[some] == owner[some + len(pattern) - 1]
        some, left = some[hit], left[hit]
        right = np.searchsorted(hashes, here[some], "right")
        counts = right - left
        place = np.repeat(some, counts)
        which = np.repeat(left, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        lines.update(zip(owner[place].tolist(), item[which].tolist(), (place - at[which]).tolist(), strict=True))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for text, k, diagonal in sorted(lines):
        own = bench.words[k]
        low, high = max(first[text], diagonal), min(first[text + 1], diagonal + len(own))
        equal = words[low:high] == own[low - diagonal : high - diagonal]
        size = min(window, len(own))
        if len(equal) < size:
            continue
        running = np.concatenate([[0], np.cumsum(equal)])
        good = np.flatnonzero(running[size:] - running[:-size] >= least_equal(size, min_equal))
        if len(good) == 0:
            continue
        begin, end = good[0], good[-1] + size
        value = (int(running[end] - running[begin]), -int(low + begin - first[text]), int(end - begin))
        best[text, k] = max(best.get((text, k), value), value)
    return [(text, k, -start, n, equal) for (text, k), (equal, start, n) in sorted(best.items())]


def blocks(benchmark: DataFrame, min_item_words: int, max_words: int, window: int, min_equal: float) -> Iterator[Benchmark]:
    """The benchmark in parts of about ``max_words`` words, so that what is sent to the tasks is bounded."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    size = F.size(F.split("text", r"\s+"))
    total = items.agg(F.sum(size)).first()[0] or 0
    n = -(-total // max_words)
    for part in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part).orderBy("item_id", "text").toPandas()
        yield Benchmark(block["item_id"].astype(object).where(block["item_id"].notna(), None).tolist(), block["text"].tolist(), min_item_words, window, min_equal)


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    min_equal: float = 0.8,
    min_item_words: int = 5,
    max_words: int = 2_000_000,
) -> DataFrame:
    """One row per text of ``docs(doc_id, text)`` and item of ``benchmark(item_id, text)`` that overlap.

    Columns: doc_id, item_id, start_word (0-based, in the text), n_words, n_equal. The
    benchmark goes to the tasks in blocks of at most about ``max_words`` words; a larger one means more
    passes over the texts.
    """
    out = None
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    for bench in blocks(benchmark, min_item_words, max_words, window, min_equal):

        def search(batches: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            hasher = SpanHasher()
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for i, _, data, offsets in text_slices(batch.column(1)):
                    found = find_words(data, offsets, BARE)
                    words = hasher(data, found.starts, found.ends, FOLDED_VALUES)
                    hits = matches(words, found.first, bench, window, min_equal)
                    columns = list(zip(*[(ids[i + t], bench.ids[k], *rest) for t, k, *rest in hits], strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])

        part = rows.mapInArrow(search, SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    min_equal: float = 0.8,
    min_item_words: int = 5,
    max_words: int = 2_000_000,
) -> DataFrame:
    """The rows of ``docs`` that overlap no item, all columns; the verdict is per row, without a join."""
    for bench in blocks(benchmark, min_item_words, max_words, window, min_equal):

        def keep(batches: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            hasher = SpanHasher()
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for i, _, data, offsets in text_slices(batch.column("text")):
                    found = find_words(data, offsets, BARE)
                    words = hasher(data, found.starts, found.ends, FOLDED_VALUES)
                    for t, *_ in matches(words, found.first, bench, window, min_equal):
                        clean[i + t] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
