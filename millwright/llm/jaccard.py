"""N-gram Jaccard join by signature trees.

Every text is the set of its distinct word 5-grams. Two texts link when their sets have a Jaccard
similarity of at least 0.8, exactly; the result is the class of texts that links connect.

1. Equal sets are one class from the start, so copies cost a group-by and nothing more.
2. A tree over all texts cannot be walked by many tasks and its upper bitmaps are full, so its top
   level is keyed: a set goes to a shard for each of its rarest tokens (a fifth of them, so that linked
   sets share a shard). Rarity comes from a lossy count over all texts; any order would
   give the same result.
3. In each shard the sets are tried against one pivot, and the verified links are closed
   to components. Shards that are one component by then are done, however large.
4. In the others a signature tree is built: leaves and nodes hold the OR of their sets' token
   bitmaps, ranges of size, and the component if it is the same for all. The tree is joined
   with itself from the root; a pair of nodes is dropped when the largest overlap its bitmaps and
   sizes allow is below what the similarity needs, or when both are one component. Large shards are
   cut into blocks, and block pairs are separate units of work.
5. What is left is verified on the whole token sets, and the components are closed again.

Rows: a null or empty text has an empty set and links with nothing (its class is its own id); a text of
fewer than five words is one token. Rows with equal text are one class; null ids never name a class
unless all ids in it are null; an empty table gives no rows; other columns are ignored.
Token and set identity is by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.shared import components, marked, marks, staged, unused
from millwright.llm.words import FOLDED_VALUES, MULTIPLIERS, SpanHasher, find_words, mix, text_slices, window_hashes

N = 5
BIT_WORDS = 16  # longs of a bitmap
BITS = 64 * BIT_WORDS
MAX_LISTED = 1 << 19  # listed frequent tokens; others count as rarer, whatever their number
BLOCK = 2048  # sets of a shard that one tree holds
FAN = 8
NO_ID = 2**63 - 1


def token_sets(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of each text, one text after the other, and the bounds of the texts."""
    found = find_words(data, offsets)
    hashes = hasher(data, found.starts, found.ends, FOLDED_VALUES)
    grams = window_hashes(hashes, N)
    first = found.first
    out, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for d, n in enumerate(np.diff(first)):
        a = first[d]
        if n >= N:
            own = np.sort(grams[a : a + n - N + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n > 0:
            own = mix((hashes[a : a + n] * MULTIPLIERS[:n]).sum(keepdims=True) + np.uint64(n))
        else:
            continue
        out.append(own)
        sizes[d] = len(own)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def set_ids(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, from a sum over its tokens."""
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens ^ np.uint64(0xA5A5A5A5DEADBEEF)), dtype=np.uint64)])
    return mix(running[bounds[1:]] - running[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * MULTIPLIERS[7])


def least_overlap(total: int) -> int:
    """Smallest overlap of two sets with ``total`` tokens together at a Jaccard similarity of 0.8."""
    return -(-4 * total // 9)


def whole_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return offsets


def frequent_tokens(rows: DataFrame, units: Callable[[np.ndarray, np.ndarray], np.ndarray] = whole_texts) -> tuple[np.ndarray, np.ndarray]:
    """Tokens found in many units (texts, unless said otherwise), sorted, and their ranks by rising count.

    A slice of about 16 MB reports tokens in three or more of its units, so a count is short by two per
    slice at most. The :data:`MAX_LISTED` most frequent reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            parts = []
            size = 0
            for _, _, data, offsets in text_slices(batch.column(1)):
                parts.append(token_sets(data, units(data, offsets), hasher)[0])
                size += len(parts[-1])
                if size > 3_000_000:
                    yield repeated(parts)
                    parts, size = [], 0
            yield repeated(parts)

    def repeated(parts: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
        n = np.diff(np.append(heads, len(tokens)))
        many = n >= 3
        return pa.RecordBatch.from_arrays([pa.array(tokens[heads[many]].view(np.int64)), pa.array(n[many])], names=["token", "n"])

    counts = staged(rows.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n >= 8"), "frequent")
    by_size = counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("size")).count().orderBy(F.desc("size")).collect()
    listed, least = 0, None
    for r in by_size:
        listed += r["count"]
        if listed > MAX_LISTED:
            break
        least = r["size"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    got = counts.where(F.floor(F.log2("n") * 4) >= least).toPandas()
    tokens, n = got["token"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
    order = np.lexsort((tokens, n))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    by_token = np.argsort(tokens)
    return tokens[by_token], rank[by_token]


def bitmaps(tokens: np.ndarray, bounds: np.ndarray, n_bits: int) -> np.ndarray:
    """Bitmap of the tokens of each set, as rows of longs."""
    n_sets = len(bounds) - 1
    bits = np.zeros((n_sets, n_bits), bool)
    bits[np.repeat(np.arange(n_sets), np.diff(bounds)), (tokens % np.uint64(n_bits)).astype(np.int64)] = True
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def bit_lists(packed: np.ndarray) -> pa.ListArray:
    n, width = packed.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(packed.reshape(-1)))


def wide_bitmaps(tokens: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """Bitmaps that grow with the set: the power of two from twice its size on; null where the common one is that wide."""
    sizes = np.diff(bounds)
    wide = np.flatnonzero(2 * sizes > BITS)
    widths = np.zeros(len(sizes), np.int64)
    widths[wide] = 1 << np.ceil(np.log2(2 * sizes[wide])).astype(np.int64)
    starts = np.cumsum(widths) - widths
    bits = np.zeros(int(widths.sum()), bool)
    for d in wide:
        bits[starts[d] + (tokens[bounds[d] : bounds[d + 1]] & np.uint64(widths[d] - 1)).astype(np.int64)] = True
    longs = np.packbits(bits, bitorder="little").view(np.int64)
    to = np.concatenate([[0], np.cumsum(widths // 64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(to), pa.array(longs))


class RarestFirst:
    """Picks the rarest tokens of sets: unlisted ones by hash, then listed ones by rising count."""

    def __init__(self, listed: np.ndarray, ranks: np.ndarray) -> None:
        self.listed, self.ranks = listed, ranks
        self.near = np.zeros(1 << 22, bool)
        self.near[(listed >> np.uint64(42)).astype(np.int64)] = True

    def __call__(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Prefixes of all sets, their bounds, and how many tokens of each are unlisted."""
        place = np.full(len(tokens), -1, np.int64)
        some = np.flatnonzero(self.near[(tokens >> np.uint64(42)).astype(np.int64)])
        if len(self.listed) and len(some):
            at = np.minimum(np.searchsorted(self.listed, tokens[some]), len(self.listed) - 1)
            hit = self.listed[at] == tokens[some]
            place[some[hit]] = self.ranks[at[hit]]
        n_sets = len(bounds) - 1
        prefixes, n_rare, size = [], np.zeros(n_sets, np.int32), np.zeros(n_sets, np.int64)
        for d in np.flatnonzero(np.diff(bounds)):
            own, where = tokens[bounds[d] : bounds[d + 1]], place[bounds[d] : bounds[d + 1]]
            take = len(own) - -(-8 * len(own) // 10) + 1
            rare = own[where < 0][:take]
            n_rare[d] = len(rare)
            if len(rare) < take:
                order = np.argsort(where[where >= 0])[: take - len(rare)]
                rare = np.concatenate([rare, own[where >= 0][order]])
            size[d] = take
            prefixes.append(rare)
        flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
        return flat, np.concatenate([[0], np.cumsum(size)]).astype(np.int32), n_rare


FEATURES = "doc_id long, row long, set long, n long, bits array<long>, wide array<long>, prefix array<long>, n_rare int"


def features(rows: DataFrame, listed: np.ndarray, ranks: np.ndarray) -> DataFrame:
    """Per text: its set, the bitmap of its tokens and its rarest tokens (null for an empty set).

    The prefix holds tokens that are not listed in the order of their hashes (``n_rare`` of them),
    then listed ones by rising count; ``n - least overlap with an equal set + 1`` in all.
    """
    shared = rows.sparkSession.sparkContext.broadcast((listed, ranks))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = RarestFirst(*shared.value)
        hasher = SpanHasher()
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(1)):
                tokens, bounds = token_sets(data, offsets, hasher)
                n = np.diff(bounds)
                packed = bitmaps(tokens, bounds, BITS)
                flat, to, n_rare = order(tokens, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(2).slice(i, j - i),
                        pa.array(set_ids(tokens, bounds).view(np.int64), mask=n == 0),
                        pa.array(n),
                        bit_lists(packed),
                        wide_bitmaps(tokens, bounds),
                        pa.ListArray.from_arrays(pa.array(to), pa.array(flat.view(np.int64))),
                        pa.array(n_rare),
                    ],
                    names=[x.split()[0] for x in FEATURES.split(", ")],
                )

    return rows.mapInArrow(build, FEATURES)


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of the rare tokens of a task: tokens in two or more sets, each distinct group of sets once."""
    tokens, sets = [], []
    for batch in batches:
        tokens.append(batch.column(0).to_numpy().view(np.uint64))
        sets.append(batch.column(1).to_numpy().view(np.uint64))
    if not tokens:
        return
    token, own = np.concatenate(tokens), np.concatenate(sets)
    order = np.argsort(token)
    token, own = token[order], own[order]
    heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    size = np.diff(np.append(heads, len(token)))
    heads, size = heads[size > 1], size[size > 1]
    if len(heads) == 0:
        return
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own), dtype=np.uint64)])
    shard, first = np.unique(mix(running[heads + size] - running[heads]), return_index=True)
    heads, size = heads[first], size[first]
    at = np.repeat(heads - (np.cumsum(size) - size), size) + np.arange(size.sum())
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(shard, size).view(np.int64)), pa.array(own[at].view(np.int64)), pa.array(np.zeros(len(at), np.int32))], names=["shard", "set", "pos"])


def shards(sets: DataFrame) -> DataFrame:
    """``(shard, set, pos)``: where sets meet. Listed tokens are shards as they are; their rows are never gathered."""
    rows = sets.select("set", "n_rare", F.posexplode("prefix").alias("pos", "token"))
    rare = rows.where("pos < n_rare").select("token", "set").repartition("token").mapInArrow(_shared_tokens, "shard long, set long, pos int")
    common = rows.where("pos >= n_rare").select(F.col("token").alias("shard"), "set", "pos")
    return rare.unionAll(common).groupBy("shard", "set").agg(F.min("pos").alias("pos"))


def may_link(na: Column, nb: Column, overlap: Column) -> Column:
    return 9 * overlap >= 4 * (na + nb)


def _widest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bitmaps at the width of the narrower: a token's bit is its hash modulo the width."""
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    return a, b


def bitmaps_allow(na: int, nb: int, a: np.ndarray, b: np.ndarray) -> bool:
    a, b = (x.view(np.uint64) for x in _widest(a, b))  # counting bits of signed values would take their magnitude
    overlap = min(na - int(np.bitwise_count(a & ~b).sum()), nb - int(np.bitwise_count(b & ~a).sum()))
    return 9 * overlap >= 4 * (na + nb)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _by_bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that bitmaps and sizes allow: every bit of one set that the other lacks is a token it lacks."""
    for batch in batches:
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        keep = 9 * np.minimum(na, nb) >= 4 * (na + nb)
        lists = {c: _lists(batch.column(c)) for c in ("ba", "bb", "wa", "wb")}
        for k in np.flatnonzero(keep):
            own = {c: values[at[k] : at[k + 1]] for c, (at, values) in lists.items()}
            keep[k] = bitmaps_allow(na[k], nb[k], own["wa"] if len(own["wa"]) else own["ba"], own["wb"] if len(own["wb"]) else own["bb"])
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that link. Token sets are built again for the texts that need it."""
    own = sets.select("set", "n", "bits", "wide")
    pairs = pairs.join(own.toDF("a", "na", "ba", "wa"), "a").join(own.toDF("b", "nb", "bb", "wb"), "b")
    pairs = staged(pairs.mapInArrow(_by_bitmap, "a long, b long"), "candidates")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    wanted = rows.sparkSession.sparkContext.broadcast(marks(sets.join(needed, "set", "left_semi").select("row"), "row"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = SpanHasher(), wanted.value
        for batch in batches:
            batch = batch.filter(pa.array(marked(bits, batch.column(2).to_numpy())))
            for _, _, data, offsets in text_slices(batch.column(1)):
                tokens, bounds = token_sets(data, offsets, hasher)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_ids(tokens, bounds).view(np.int64)), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens.view(np.int64)))],
                    names=["set", "tokens"],
                )

    tokens = rows.mapInArrow(build, "set long, tokens array<long>")
    tokens = staged(tokens.join(needed, "set", "left_semi").dropDuplicates(["set"]), "tokens")
    both = pairs.join(tokens.toDF("a", "ta"), "a").join(tokens.toDF("b", "tb"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [_lists(batch.column(c)) for c in ("ta", "tb")]
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = (values[at[k] : at[k + 1]] for at, values in lists)
                joined = np.sort(np.concatenate([x, y]))
                common = int((joined[1:] == joined[:-1]).sum())
                keep[k] = 9 * common >= 4 * (len(x) + len(y))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long").distinct()


class Forest:
    """Signature trees of many units (shards or block pairs) in arrays, one level after the other."""

    def __init__(self, unit: np.ndarray, bits: np.ndarray, n: np.ndarray, comp: np.ndarray) -> None:
        filled = np.bitwise_count(bits).sum(1).astype(np.int64)
        self.unit, self.bits = [unit], [bits]
        self.low, self.high, self.slack = [n], [n], [n - filled]
        self.comp, self.one = [comp], [np.ones(len(n), bool)]
        self.first: list[np.ndarray] = []
        while len(self.unit[-1]) > len(np.unique(self.unit[-1])):
            unit = self.unit[-1]
            heads = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            rank = np.arange(len(unit)) - np.repeat(heads, np.diff(np.append(heads, len(unit))))
            first = np.flatnonzero(rank % FAN == 0)
            self.first.append(np.append(first, len(unit)))
            self.unit.append(unit[first])
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], first, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], first))
            self.high.append(np.maximum.reduceat(self.high[-1], first))
            self.slack.append(np.maximum.reduceat(self.slack[-1], first))
            lowest, highest = np.minimum.reduceat(self.comp[-1], first), np.maximum.reduceat(self.comp[-1], first)
            self.one.append(np.logical_and.reduceat(self.one[-1], first) & (lowest == highest))
            self.comp.append(lowest)

    def possible(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs of nodes below which two sets of different components may reach the similarity."""
        shared = np.bitwise_count(self.bits[level][x] & self.bits[level][y]).sum(1).astype(np.int64)
        # A set has at most (tokens beyond its bits + bits shared) tokens in common with the other.
        overlap = np.minimum(self.slack[level][x], self.slack[level][y]) + shared
        overlap = np.minimum(overlap, np.minimum(self.high[level][x], self.high[level][y]))
        same = self.one[level][x] & self.one[level][y] & (self.comp[level][x] == self.comp[level][y])
        return (9 * overlap >= 4 * (self.low[level][x] + self.low[level][y])) & ~same

    def pairs(self, chunk: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets of a unit that no level drops, from a walk of the trees against themselves."""
        top = len(self.first)
        roots = np.arange(len(self.unit[top]))
        stack = [(top, roots, roots)]
        while stack:
            level, x, y = stack.pop()
            for k in range(0, len(x), chunk):
                a, b = x[k : k + chunk], y[k : k + chunk]
                good = self.possible(level, a, b)
                a, b = a[good], b[good]
                if len(a) == 0:
                    continue
                if level == 0:
                    yield a[a != b], b[a != b]
                    continue
                first = self.first[level - 1]
                na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
                total = na * nb
                which = np.repeat(np.arange(len(a)), total)
                inner = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
                ca, cb = first[a][which] + inner // nb[which], first[b][which] + inner % nb[which]
                keep = ca <= cb
                stack.append((level - 1, ca[keep], cb[keep]))


UNITS = "unit long, side_a int, side_b int, block int, set long, comp long, n long, bits array<long>, wide array<long>, pivot boolean"


def _tree_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks().sort_by([("unit", "ascending"), ("side_a", "ascending"), ("side_b", "ascending"), ("n", "ascending"), ("set", "ascending")])
    get = {c: table.column(c).to_numpy() for c in ("unit", "side_a", "side_b", "block", "set", "comp", "n", "pivot")}
    bits = table.column("bits").combine_chunks()
    bits = (bits.chunk(0) if isinstance(bits, pa.ChunkedArray) else bits).flatten().to_numpy().reshape(table.num_rows, -1).view(np.uint64)
    column = table.column("wide").combine_chunks()
    to, wide = _lists(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
    change = np.zeros(table.num_rows, bool)
    for c in ("unit", "side_a", "side_b"):
        change[1:] |= get[c][1:] != get[c][:-1]
    forest = Forest(np.cumsum(change), bits, get["n"].astype(np.int64), get["comp"])
    for a, b in forest.pairs():
        # Of two blocks only pairs across; the pivot has been tried against all.
        good = ((get["side_a"][a] == get["side_b"][a]) | (get["block"][a] != get["block"][b])) & ~(get["pivot"][a] | get["pivot"][b])
        a, b = a[good], b[good]
        # A pair that meets in several units is looked at once; wide bitmaps tell what the common ones, full for long texts, cannot.
        _, once = np.unique(mix(get["set"][a].view(np.uint64)) + mix(get["set"][b].view(np.uint64)), return_index=True)
        a, b = a[once], b[once]
        keep = np.ones(len(a), bool)
        for k in np.flatnonzero(2 * np.maximum(get["n"][a], get["n"][b]) > BITS):
            keep[k] = bitmaps_allow(get["n"][a[k]], get["n"][b[k]], *(wide[to[i] : to[i + 1]] if to[i + 1] > to[i] else bits[i].view(np.int64) for i in (a[k], b[k])))
        x, y = get["set"][a[keep]], get["set"][b[keep]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def linked_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Components of the sets that link: ``(node, component)``."""
    where = staged(shards(sets), "shards")
    pivots = where.groupBy("shard").agg(F.min(F.struct("pos", "set"))["set"].alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1")
    where = staged(where.join(pivots, "shard"), "shards")
    tried = where.where("set <> pivot").select(F.least("set", "pivot").alias("a"), F.greatest("set", "pivot").alias("b")).distinct()
    links = staged(verified(tried, sets, rows), "links")
    first = staged(components(links), "components")

    known = where.where("size > 2").join(first.withColumnRenamed("node", "set"), "set", "left").withColumn("comp", F.coalesce("component", "set"))
    known = known.select("shard", "set", "comp", "size", "pivot")
    open_shards = known.groupBy("shard").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("shard")
    left = known.join(open_shards, "shard", "left_semi").join(sets.select("set", "n", "bits", "wide"), "set")
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.hash("set"), n_blocks).cast("int")
    left = left.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    units = left.select(
        F.col("shard").alias("unit"), F.least("block", "other").cast("int").alias("side_a"), F.greatest("block", "other").cast("int").alias("side_b"),
        "block", "set", "comp", F.col("n"), "bits", "wide", (F.col("set") == F.col("pivot")).alias("pivot"),
    )
    more = units.repartition("unit", "side_a", "side_b").mapInArrow(_tree_join, "a long, b long").distinct()
    more = verified(staged(more, "tree-pairs"), sets, rows)
    edges = first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more)
    return components(edges)


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, row (a hash of id and text), n, set (null if empty), and the class.

    ``least`` and ``least_row`` tell the row of the class with the smallest id (nulls last), then hash.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row)
    found = staged(features(rows, *frequent_tokens(rows)).withColumn("key", F.coalesce("doc_id", F.lit(NO_ID))), "features")
    lowest = found.where("set is not null").groupBy("set").agg(F.min(F.struct("key", "row")).alias("low"))
    lowest = staged(lowest.select("set", "low.*"), "sets")
    sets = found.where("set is not null").join(lowest, ["set", "key", "row"], "left_semi").dropDuplicates(["set", "key", "row"])
    sets = staged(sets.drop("doc_id"), "set-features")
    linked = staged(linked_sets(rows, sets), "classes")
    joined = lowest.join(linked.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = joined.groupBy("component").agg(F.min(F.struct("key", "row")).alias("low"))
    named = joined.join(least, "component").select("set", F.col("low.key").alias("least"), F.col("low.row").alias("least_row"))
    return found.select("doc_id", "row", "n", "set").join(named, "set", "left")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs(doc_id, text)``."""
    name = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.when(F.col("least") < NO_ID, F.col("least")))
    return classes(docs).select("doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, the first by id; all texts without words are kept.

    Rows equal in id and text count as one row. Further columns pass through, whatever their names.
    """
    (key,) = unused(docs, "_key")
    kept = classes(docs).where("set is null or row = least_row").select(F.col("row").alias(key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return keyed.join(kept, keyed[key] == kept[key], "left_semi").dropDuplicates([key]).drop(key)
