"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are estimated: one of target texts (a bounded sample of
texts labelled good) and one of all raw texts. The log importance weight of a text is the sum of
the log ratios of its n-grams, tempered for long texts (their mean times a bounded number of draws). Gumbel noise is added and the rows with the largest sums are kept,
which samples without replacement in proportion to the weights.

N-grams are single tokens and pairs of tokens (runs of letters and digits in lower case, runs of
other marks), and the same over token shapes (capitals, length, mark, repetition of a recent
token), so that unseen words still tell what kind of text they stand in.

Rows: a null or empty text has weight 1 (log 0). Repeated ids get the same noise; rows that tie at
the cut are all kept. An empty table gives no rows. Null ids are judged like others. Without any
labelled good text, all rows have weight 1. Columns other than the named ones pass through
:func:`resampled` unchanged and are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from millwright.llm.shared import staged, unused
from millwright.llm.words import BARE, FOLDED_VALUES, WORD, SpanHasher, mix, text_slices

WORD_BITS = 14
SHAPE_BITS = 12
N_BUCKETS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
# Added to seen and expected counts, so that buckets with little evidence have a ratio near 1.
SMOOTHING = 4.0
# The n-grams of a text depend on each other: together they count as so many independent draws at most.
DRAWS = 24
_KIND = np.where(BARE, 1, np.where(WORD, 2, 0)).astype(np.uint8)
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True


def grams(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Text index and bucket of every n-gram."""
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return none, none
    kind = _KIND[data]
    change = np.empty(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[0] = change[-1] = True
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    if len(starts) == 0:
        return none, none
    owner = np.searchsorted(offsets, starts, "right") - 1
    hashes = hasher(data, starts, ends, FOLDED_VALUES)
    capitals = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data], out=capitals[1:])
    upper = np.minimum(capitals[ends] - capitals[starts], 2)
    length = np.minimum(ends - starts, 7)
    recent = np.zeros(len(starts), np.int64)
    for back in (1, 2):
        same = (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
        recent[back:] |= same.astype(np.int64)
    mark = np.where(kind[starts] == 2, data[starts], 0).astype(np.int64)
    shape = mix((((mark * 3 + upper) * 8 + length) * 2 + recent).astype(np.uint64) + np.uint64(1))
    pair = owner[1:] == owner[:-1]
    with_next = mix(hashes[:-1] * np.uint64(3) + hashes[1:] * np.uint64(5))[pair]
    shape_next = mix(shape[:-1] * np.uint64(3) + shape[1:] * np.uint64(5))[pair]
    low = np.uint64((1 << WORD_BITS) - 1)
    shape_low, above = np.uint64((1 << SHAPE_BITS) - 1), np.uint64(1 << WORD_BITS)
    buckets = np.concatenate([hashes & low, with_next & low, (shape & shape_low) + above, (shape_next & shape_low) + above])
    return np.concatenate([owner, owner[:-1][pair], owner, owner[:-1][pair]]), buckets.astype(np.int64)


def _of(column: str, kind: str) -> Column:
    return F.col(column).cast(kind)


def log_ratios(docs: DataFrame, good: np.ndarray) -> np.ndarray:
    """Log ratio of target to raw share of each bucket; ``good``: sorted ids of the target texts.

    Each task sums its buckets, so that the shuffle holds buckets times tasks rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, raw, target = SpanHasher(), np.zeros(N_BUCKETS, np.int64), np.zeros(N_BUCKETS, np.int64)
        for batch in batches:
            ids = pc.fill_null(batch.column(0), -1).to_numpy(zero_copy_only=False)
            chosen = np.isin(ids, good) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for i, j, data, offsets in text_slices(batch.column(1)):
                owner, buckets = grams(data, offsets, hasher)
                raw += np.bincount(buckets, minlength=N_BUCKETS)
                target += np.bincount(buckets[chosen[i:j][owner]], minlength=N_BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])

    rows = docs.select(_of("doc_id", "long"), _of("text", "string")).mapInArrow(count, "bucket long, raw long, target long")
    rows = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = rows.toPandas()  # at most N_BUCKETS rows
    raw, target = np.zeros(N_BUCKETS), np.zeros(N_BUCKETS)
    raw[found["bucket"]], target[found["bucket"]] = found["raw"], found["target"]
    if target.sum() == 0:
        return np.zeros(N_BUCKETS)
    out = np.zeros(N_BUCKETS)
    for part in (slice(0, 1 << WORD_BITS), slice(1 << WORD_BITS, N_BUCKETS)):
        expected = raw[part] * (target[part].sum() / raw[part].sum())
        out[part] = np.log((target[part] + SMOOTHING) / (expected + SMOOTHING))
    return out


def cut_of(keys: DataFrame, k: int, rounds: int = 4, bins: int = 1024) -> float:
    """A value of ``key`` that at least ``k`` rows reach, and no more than ties beyond.

    Narrows the range by histograms of ``bins`` counts; no sort and no rows on the driver.
    """
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return float("inf")
    above = 0
    for _ in range(rounds):
        width = (high - low) / bins
        if not width > 0:
            break
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high))
        place = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        counts = {r["p"]: (r["n"], r["low"], r["high"]) for r in inside.groupBy(place.alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()}
        for p in sorted(counts, reverse=True):
            n, bottom, top = counts[p]
            if above + n >= k or p == min(counts):
                low, high = bottom, top
                break
            above += n
        if above + n == k:
            break
    return float(low)


def weighed(docs: DataFrame, ratios: np.ndarray, seed: int) -> DataFrame:
    """``docs`` with ``n_grams``, ``log_weight`` and ``key`` (the weight with Gumbel noise) added."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                owner, buckets = grams(data, offsets, hasher)
                n = np.bincount(owner, minlength=j - i)
                total = np.bincount(owner, ratios[buckets], minlength=j - i)
                added = [pa.array(n), pa.array(total * (np.minimum(n, DRAWS) / np.maximum(n, 1)))]
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*own.columns, *added], names=[*own.schema.names, "n_grams", "log_weight"])

    schema = StructType([*docs.schema.fields, StructField("n_grams", LongType()), StructField("log_weight", DoubleType())])
    # Rows without an id draw by their text.
    own = F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed))
    drawn = F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit("")), F.lit(seed))).otherwise(own)
    uniform = (F.pmod(drawn, F.lit(1 << 40)) + 0.5) / float(1 << 40)
    return docs.mapInArrow(weigh, schema).withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def fitted(docs: DataFrame, labels: DataFrame, max_target_rows: int, seed: int) -> tuple[np.ndarray, DataFrame, float]:
    """Log ratios, the staged ``(doc_id, n_grams, log_weight, key)`` of all rows, and the cut on ``key``.

    The target model is fitted on at most ``max_target_rows`` labelled good rows, taken in the order
    of a hash of the id; the raw model, the weights and the cut cover all rows. The number of
    rows to keep is the number of rows that are likelier good than not, given their weight and
    the good share of the labels.
    """
    usable = labels.select(_of("doc_id", "long"), _of("quality", "int")).where("doc_id is not null and quality is not null")
    # Remainder 2 of the id's checksum stays out of the fit, for held-out figures.
    usable = usable.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
    share = usable.agg(F.avg((F.col("quality") > 0).cast("double"))).first()[0]
    chosen = usable.where("quality > 0").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target_rows)
    good = np.sort(chosen.toPandas()["doc_id"].to_numpy(np.int64))
    ratios = log_ratios(docs, good)
    prior = 0.0 if share is None else float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    own = docs.select(_of("doc_id", "long"), _of("text", "string"))
    out = staged(weighed(own, ratios, seed).drop("text"), "weights")
    return ratios, out, cut_of(out, out.where(F.col("log_weight") + F.lit(prior) > 0).count())


def importance_resampling(docs: DataFrame, labels: DataFrame, max_target_rows: int = 20_000, seed: int = 7) -> DataFrame:
    """``(doc_id, n_grams, log_weight, kept)`` for each row of ``docs(doc_id, text)``."""
    _, out, cut = fitted(docs, labels, max_target_rows, seed)
    return out.select("doc_id", "n_grams", "log_weight", (F.col("key") >= cut).alias("kept"))


def resampled(docs: DataFrame, labels: DataFrame, max_target_rows: int = 20_000, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; each row is weighed where it is, without a join."""
    ratios, _, cut = fitted(docs, labels, max_target_rows, seed)
    clashing = [c for c in docs.columns if c.lower() in ("n_grams", "log_weight", "key")]
    clean = dict(zip(clashing, unused(docs, *[f"_own_{c}" for c in clashing]), strict=True))
    kept = weighed(docs.withColumnsRenamed(clean), ratios, seed).where(F.col("key") >= cut).drop("n_grams", "log_weight", "key")
    return kept.withColumnsRenamed({v: k for k, v in clean.items()})
