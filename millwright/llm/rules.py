"""Quality rules: base counts, and divergence of a text from the reference of its language.

Each text gives two histograms: classes of characters, and the words most common in its
language plus one bin for all others. Both are compared with the same histograms of all texts
of that language by the Jensen-Shannon distance (base 2, 0 to 1). A short text gives a noisy
histogram, so each distance is a verdict only from a minimum length on, and what sampling alone
adds to the word distance is allowed for.

Rows: a null text has no words and fails the base rule. A null language, a language beyond the
``max_languages`` with most words, and a language without common words use the reference of all
texts. Repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.shared import staged
from millwright.llm.words import SpanHasher, WORD, find_words, mix, per_text, text_slices, window_hashes, windows_in_texts

SYMBOLS = b"#*$%&|<>"
N_CLASSES = 7
_CLASS = np.full(256, 5, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[~WORD] = 3
_CLASS[list(b".,;:'\"?()-")] = 4
_CLASS[192:] = 6
_CLASS[128:192] = N_CLASSES  # inside a longer code point: not counted
COMMON = 50
ALL = "\x00all"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, char_distance double, word_distance double, kept boolean"
)


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of each class per text."""
    owner = np.repeat(np.arange(len(offsets) - 1) * (N_CLASSES + 1), np.diff(offsets))
    flat = np.bincount(owner + _CLASS[data], minlength=(len(offsets) - 1) * (N_CLASSES + 1))
    return flat.reshape(-1, N_CLASSES + 1)[:, :N_CLASSES]


def base_counts(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher):
    """Words and the four base counts of each text."""
    found = find_words(data, offsets)
    hashes = hasher(data, found.starts, found.ends)
    points = (data & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    word_chars = per_text(points & WORD[data], offsets)
    n_symbols = per_text(symbol[data], offsets)
    n_texts = len(offsets) - 1

    breaks = np.flatnonzero(data == 0x0A)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    owner = np.searchsorted(offsets, starts, "right") - 1
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    ends = np.minimum(ends, offsets[owner + 1])
    ends = ends - (data[ends - 1] == 0x0A) if len(ends) else ends
    with_word = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends, owner = starts[with_word], ends[with_word], owner[with_word]
    keys = mix(hasher(data, starts, ends) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(keys, return_index=True)
    n_dup = np.bincount(owner, minlength=n_texts) - np.bincount(owner[at], minlength=n_texts)

    size = 3
    whole = windows_in_texts(found.first, size)
    grams = window_hashes(hashes, size)
    word_owner = found.owner()
    covered = np.zeros(len(hashes), bool)
    if len(grams):
        at = np.flatnonzero(whole)
        keys = mix(grams[at] + word_owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = at[counts[which] > 1]
        for j in range(size):
            covered[again + j] = True
    return found, hashes, word_owner, word_chars, n_symbols, n_dup, per_text(covered, found.first)


def _corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: character classes and the words of each slice, with their numbers."""
    hasher = SpanHasher()
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for i, j, data, offsets in text_slices(batch.column(0), 4 << 20):
            names, index = np.unique(np.array([ALL if x is None else x for x in langs[i:j]], object), return_inverse=True)
            classes = np.zeros((len(names), N_CLASSES), np.int64)
            np.add.at(classes, index, class_counts(data, offsets))
            found = find_words(data, offsets)
            lang_of = index[found.owner()]
            totals = np.bincount(lang_of, minlength=len(names))
            hashes = hasher(data, found.starts, found.ends)
            _, at, counts = np.unique(mix(hashes + lang_of.astype(np.uint64)), return_index=True, return_counts=True)
            all_langs = np.arange(len(names))
            out_lang = np.concatenate([np.repeat(all_langs, N_CLASSES), lang_of[at], all_langs])
            kind = np.concatenate([np.tile(np.arange(N_CLASSES), len(names)), np.full(len(at), -1), np.full(len(names), -2)])
            word = np.concatenate([np.zeros(N_CLASSES * len(names), np.int64), hashes[at].view(np.int64), np.zeros(len(names), np.int64)])
            n = np.concatenate([classes.ravel(), counts, totals])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(names), pa.string()).take(pa.array(out_lang)), pa.array(kind.astype(np.int32)), pa.array(word), pa.array(n)],
                names=["lang", "kind", "word", "n"],
            )


def references(docs: DataFrame, max_languages: int = 256) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per language: class shares, common words, and their shares with the rest last.

    Every word of every text is counted, by partial sums in the tasks first, so the references follow from
    the rows alone. At most ``max_languages`` languages (those with most words, by name where equal) and
    :data:`COMMON` words of each reach the driver.
    """
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(_corpus_counts, "lang string, kind int, word long, n long")
    sums = rows.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    pooled = F.explode(F.array_distinct(F.array("lang", F.lit(ALL)))).alias("lang")
    sums = sums.select(pooled, "kind", "word", "n").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    top = sums.withColumn("r", F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word"))).where(f"r <= {COMMON}")
    top = staged(top.drop("r"), "references")
    largest = top.where("kind = -2").orderBy(F.desc("n"), (F.col("lang") != ALL), "lang").limit(max_languages + 1)
    found: dict[str, tuple] = {}
    for r in top.join(largest.select("lang"), "lang", "left_semi").collect():
        classes, words, total = found.setdefault(r["lang"], (np.zeros(N_CLASSES), {}, [0]))
        if r["kind"] >= 0:
            classes[r["kind"]] = r["n"]
        elif r["kind"] == -1:
            words[r["word"]] = r["n"]
        else:
            total[0] = r["n"]
    out = {}
    for lang, (classes, words, total) in found.items():
        if total[0] == 0 or not words:
            continue
        order = sorted(words, key=lambda w: (-words[w], w))
        shares = np.array([words[w] for w in order], float) / total[0]
        out[lang] = (classes / max(classes.sum(), 1), np.array(order, np.int64).view(np.uint64), np.append(shares, max(0.0, 1 - shares.sum())))
    return out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` to the same row of ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def quality_rules(
    docs: DataFrame,
    max_char_distance: float = 0.30,
    max_word_distance: float = 0.36,
    min_chars: int = 200,
    min_words: int = 50,
    max_languages: int = 256,
) -> DataFrame:
    """Base counts, distances and verdict per row of ``docs(doc_id, text, lang)``.

    A distance is null below its minimum length and then decides nothing. The bound on the word
    distance is ``max_word_distance + 0.9 / sqrt(n_words)``.
    """
    known = references(docs, max_languages)
    # The pooled reference is always there unless no text has a word.
    names = sorted(known)
    place = {x: k for k, x in enumerate(names)}
    n_bins = COMMON + 1
    class_ref = np.array([known[x][0] for x in names]).reshape(-1, N_CLASSES)
    word_ref = np.zeros((len(names), n_bins))
    union = np.unique(np.concatenate([known[x][1] for x in names] or [np.zeros(0, np.uint64)]))
    bins = np.full((max(1, len(names)), len(union) + 1), COMMON, np.int64)
    for k, x in enumerate(names):
        shares = known[x][2]
        word_ref[k, : len(shares) - 1], word_ref[k, COMMON] = shares[:-1], shares[-1]
        bins[k, np.searchsorted(union, known[x][1])] = np.arange(len(shares) - 1)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for i, j, data, offsets in text_slices(batch.column(1)):
                found, hashes, owner, word_chars, n_symbols, n_dup, n_repeat = base_counts(data, offsets, hasher)
                n_words = np.diff(found.first)
                failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
                classes = class_counts(data, offsets).astype(float)
                chars = classes.sum(1)
                long_enough, enough_words = chars >= min_chars, n_words >= min_words
                char_d = word_d = np.zeros(j - i)
                if names:
                    ref = np.array([place.get(ALL if x is None else x, place.get(ALL, 0)) for x in langs[i:j]])
                    char_d = distance(classes / np.maximum(chars, 1)[:, None], class_ref[ref])
                    at = np.searchsorted(union, hashes)
                    at[(at == len(union)) | (union[np.minimum(at, len(union) - 1)] != hashes)] = len(union)
                    hist = np.bincount(owner * n_bins + bins[ref[owner], at], minlength=(j - i) * n_bins).reshape(-1, n_bins)
                    word_d = distance(hist / np.maximum(n_words, 1)[:, None], word_ref[ref])
                odd = long_enough & (char_d > max_char_distance)
                odd |= enough_words & (word_d > max_word_distance + 0.9 / np.sqrt(np.maximum(n_words, 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        *[pa.array(x.astype(np.int64)) for x in (n_words, word_chars, n_symbols, n_dup, n_repeat)],
                        pa.array(failed),
                        pa.array(char_d, mask=~long_enough),
                        pa.array(word_d, mask=~enough_words),
                        pa.array(~failed & ~odd),
                    ],
                    names=[x.split()[0] for x in SCHEMA.split(", ")],
                )

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")]
    return docs.select(*columns).mapInArrow(judge, SCHEMA)
