"""Audit of how far the sources of a language differ in their terms, by iceberg prefix refinement.

Terms are runs of ASCII letters and non-ASCII characters, with A-Z lower-cased. Only terms that stand in
``min_docs`` documents of a language count, and a term can only do so if each of its prefixes does. So byte
prefixes are extended level by level: the documents that hold a term with a prefix are counted, prefixes below the
threshold are discarded with all their terms, and the next level extends the rest, until complete terms are left.

Texts are read once. Every slice of texts becomes, for each language, a chunk: its sorted distinct terms and, per document,
the numbers of its terms with their counts. In sorted terms a prefix is a run, so a document's terms with one
prefix are neighbours, and a level costs one pass over these numbers. A document lies in one chunk, so the counts
of chunks add up to the number of distinct documents. The surviving prefixes of a level reach the next as a bitmap of
bounded size; it may let others pass, never the reverse, and the last level counts the complete terms themselves.

All arithmetic is on integers. A term's share in a group is ``p = 1 + floor(10**9 * (count + 1) / (N + V))``; the
divergence of two shares is ``floor((p - q)**2 / q)``. Sums over pairs of sources are built in the tasks that hold the
terms, one matrix per language, whose size follows the sources alone.

Rows: null text, language and source are read as empty strings. Every row is a document of its own, repeated
rows too. Texts are read whole. Equal values are ranked by the UTF-8 bytes of the item. A language without kept
terms has pairs of value 0 and no term rows. An empty table gives no rows. Other columns are ignored, whatever
their names. Terms of a slice are told apart, and prefixes of a level added up, by 64-bit hashes: two prefixes with one hash
count together, which can only keep more of them; kept terms are counted as text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.shared import marked, marks, staged
from millwright.llm.words import FOLD, SpanHasher, find_words, mix, spread, text_slices

SCALE = 1_000_000_000
LEVELS = (2, 4, 8, 16)
# Bytes of a term: ASCII letters and every byte of a longer code point.
TERM = np.zeros(256, bool)
TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# Numbers are kept as raw 32-bit integers: ``at`` has the bounds of the terms in ``data``, ``first`` those of the documents in ``term`` and ``n``.
CHUNK = "lang string, lang_key long, sources array<string>, data binary, at binary, first binary, doc_source binary, term binary, n binary"
# Rows that a task gathers before it adds them up and passes them on.
GATHERED = 1_250_000


def _raw(values: np.ndarray) -> pa.Array:
    """A binary column with a single row of 32-bit integers."""
    return pa.array([values.astype("<i4").tobytes()], pa.binary())


def _coded(codes: np.ndarray, names: pa.Array) -> pa.DictionaryArray:
    """``names`` at ``codes`` as a dictionary column that holds each name in use once."""
    used = np.zeros(len(names), bool)
    used[codes] = True
    return pa.DictionaryArray.from_arrays((np.cumsum(used, dtype=np.int32) - np.int32(1))[codes], names.take(pa.array(np.flatnonzero(used))))


def _added_up(batches: Iterator[pa.RecordBatch], keys: list[str], sums: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches with equal keys added up within a task, so that Spark gets fewer rows; memory is bounded by :data:`GATHERED` rows.

    The key is one 64-bit column, or dictionaries, whose rows are told apart by their codes: no text is held once per row.
    """

    def compact(gathered: list[pa.Table]) -> pa.Table:
        total, key, names = pa.concat_tables(gathered), np.int64(0), {}
        gathered.clear()  # nothing is held twice
        total = total.unify_dictionaries()
        for c in keys:
            column = total.column(c).combine_chunks()
            total = total.drop_columns(c)
            if pa.types.is_dictionary(column.type):
                names[c] = column.dictionary
                key = key * len(column.dictionary) + column.indices.to_numpy()
            else:
                key = column.to_numpy()
        order = np.argsort(key)
        heads = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
        key, columns = key[order[heads]], {}
        for c in sums:
            column = total.column(c).to_numpy()
            total = total.drop_columns(c)
            columns[c] = pa.array(np.add.reduceat(column[order], heads))
        for c in reversed(keys):
            if c in names:
                key, codes = np.divmod(key, len(names[c]))
                columns[c] = pa.DictionaryArray.from_arrays(codes.astype(np.int32), names[c])
            else:
                columns[c] = pa.array(key)
        return pa.table({c: columns[c] for c in [*keys, *sums]})

    def passed_on(total: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in total.to_batches(max_chunksize=50_000):
            columns = [c.dictionary_decode() if pa.types.is_dictionary(c.type) else c for c in batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    gathered, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        gathered.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows > GATHERED:
            total = compact(gathered)
            gathered, rows = [total], total.num_rows
            if rows > GATHERED * 3 // 4:
                yield from passed_on(total)
                gathered, rows = [], 0
            del total
    if gathered:
        yield from passed_on(compact(gathered))


def chunks(docs: DataFrame) -> DataFrame:
    """Terms and their places, one row per slice of texts and language (columns: :data:`CHUNK`)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(3), 2 << 20):
                data = FOLD[data]
                words = find_words(data, offsets, TERM)
                if not len(words.starts):
                    continue
                hashes, owner = hasher(data, words.starts, words.ends), words.owner()
                langs = batch.column(0).slice(i, j - i).dictionary_encode()
                lang_of = langs.indices.to_numpy()[owner]
                for k in np.unique(lang_of).tolist():
                    mine = np.flatnonzero(lang_of == k)
                    _, example, which = np.unique(hashes[mine], return_index=True, return_inverse=True)
                    starts, ends = words.starts[mine[example]], words.ends[mine[example]]
                    sizes = ends - starts
                    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    terms = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(at), pa.py_buffer(data[spread(starts, sizes)]))
                    order = pc.array_sort_indices(terms).to_numpy()
                    place = np.empty(len(order), np.int64)
                    place[order] = np.arange(len(order))
                    # One number per word: its document, then its term in sorted order.
                    pairs, counts = np.unique(owner[mine] * len(order) + place[which], return_counts=True)
                    doc, term = np.divmod(pairs, len(order))
                    heads = np.flatnonzero(np.diff(doc, prepend=-1))
                    sources = batch.column(2).slice(i, j - i).take(pa.array(doc[heads])).dictionary_encode()
                    names = pa.ListArray.from_arrays(pa.array([0, len(sources.dictionary)], pa.int32()), sources.dictionary)
                    key = batch.column(1)[i + int(owner[mine[0]])]
                    _, where, text = terms.take(pa.array(order)).buffers()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([langs.dictionary[k].as_py()], pa.string()), pa.array([key.as_py()], pa.int64()), names,
                            pa.array([text.to_pybytes()[: int(at[-1])]], pa.binary()), _raw(np.frombuffer(where, np.int32)[: len(order) + 1]),
                            _raw(np.append(heads, len(pairs))), _raw(sources.indices.to_numpy()), _raw(term), _raw(counts),
                        ],
                        names=[c.split()[0] for c in CHUNK.split(", ")],
                    )

    rows = docs.select("lang", F.xxhash64("lang").alias("key"), "source", "text")
    return rows.mapInArrow(cut, CHUNK)


class Chunk:
    """One row of :func:`chunks` as arrays."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        lang, key, sources, data, at, *rest = (c[row] for c in batch.columns)
        self.lang, self.key, self.sources = lang.as_py(), key.as_py(), sources.values
        self.first, self.doc_source, self.term, self.n = (np.frombuffer(x.as_buffer(), "<i4").astype(np.int64) for x in rest)
        where, text = at.as_buffer(), data.as_buffer()
        self.at, self.data = np.frombuffer(where, "<i4").astype(np.int64), np.frombuffer(text, np.uint8)
        self.terms = pa.StringArray.from_buffers(len(self.at) - 1, where, text)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_source)), np.diff(self.first))

    def prefix_keys(self, hasher: SpanHasher, size: int) -> np.ndarray:
        """Hash of language and the first ``size`` bytes of each term."""
        ends = np.minimum(self.at[1:], self.at[:-1] + size)
        return mix(hasher(self.data, self.at[:-1], ends) ^ np.uint64(self.key & (2**64 - 1)))


def _prefixes(parts: DataFrame, size: int, last: tuple[int, np.ndarray] | None) -> DataFrame:
    """``(key, docs)``: documents of each chunk by prefix, of the terms that passed the last level."""
    shared = parts.sparkSession.sparkContext.broadcast(last) if last else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for row in range(batch.num_rows):
                c = Chunk(batch, row)
                keys, doc, term = c.prefix_keys(hasher, size), c.doc(), c.term
                if shared:
                    before, bits = shared.value
                    passed = marked(bits, c.prefix_keys(hasher, before))[term]
                    doc, term = doc[passed], term[passed]
                key = keys[term]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                found, docs = np.unique(key[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(docs)], names=["key", "docs"])

    return parts.mapInArrow(lambda batches: _added_up(count(batches), ["key"], ["docs"]), "key long, docs long")


def _terms(parts: DataFrame, last: tuple[int, np.ndarray] | None) -> DataFrame:
    """``(lang, term, source, docs, n)`` of each chunk, of the terms that passed the last level."""
    shared = parts.sparkSession.sparkContext.broadcast(last) if last else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for row in range(batch.num_rows):
                c = Chunk(batch, row)
                source, term, n = c.doc_source[c.doc()], c.term, c.n
                if shared:
                    before, bits = shared.value
                    passed = marked(bits, c.prefix_keys(hasher, before))[term]
                    source, term, n = source[passed], term[passed], n[passed]
                both, which, docs = np.unique(source * len(c.terms) + term, return_inverse=True, return_counts=True)
                total = np.bincount(which, n, len(both)).astype(np.int64)
                source, term = np.divmod(both, len(c.terms))
                named = [_coded(np.zeros(len(both), np.int64), pa.array([c.lang], pa.string())), _coded(term, c.terms), _coded(source, c.sources)]
                yield pa.RecordBatch.from_arrays([*named, pa.array(docs), pa.array(total)], names=["lang", "term", "source", "docs", "n"])

    schema = "lang string, term string, source string, docs long, n long"
    return parts.mapInArrow(lambda batches: _added_up(count(batches), ["lang", "term", "source"], ["docs", "n"]), schema)


def kept_terms(docs: DataFrame, min_docs: int = 3, levels: Sequence[int] = LEVELS) -> DataFrame:
    """``(lang, term, source, docs, n)`` of the terms by source, with all terms in ``min_docs`` documents of their language.

    ``docs(lang, source, text)`` without nulls. ``levels`` are the numbers of bytes to which prefixes are extended, rising. A term
    in fewer documents may be left; none with enough is missing.
    """
    parts = staged(chunks(docs), "divergence-chunks")
    last = None
    for size in levels:
        grown = _prefixes(parts, size, last).groupBy("key").agg(F.sum("docs").alias("docs"))
        grown = staged(grown.where(F.col("docs") >= min_docs).select("key"), "divergence-prefixes")
        last = (size, marks(grown, "key"))
    return _terms(parts, last).groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _share(count: Column, size: Column) -> Column:
    """``1 + floor(10**9 * (count + 1) / size)``, exact for up to 9 * 10**15 words: long division in steps of 1000."""
    out, rest = F.lit(1).cast("long"), count + 1
    for weight in (1_000_000, 1000, 1):
        out = out + F.call_function("div", rest * 1000, size) * weight
        rest = (rest * 1000) % size
    return out


def _shares(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`_share` of arrays."""
    out, rest = np.ones(np.broadcast_shapes(counts.shape, sizes.shape), np.int64), counts + 1
    for weight in (1_000_000, 1000, 1):
        digits, rest = np.divmod(rest * 1000, sizes)
        out += digits * weight
    return out


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(terms: DataFrame) -> DataFrame:
    """``(lang, a, b, value)``: divergence of source ``a`` from source ``b``, by their places in the language.

    From a row per kept term: ``lang``, ``counts`` as a list of ``(place, n)``, and ``sizes``, the ``N + V`` of all places.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            indices = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = pa.array(np.flatnonzero(indices == k))
                lists, sizes = batch.column(1).take(mine), batch.column(2)[mine[0].as_py()].values.to_numpy()
                cells = lists.flatten()
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                counts = np.zeros((len(lists), len(sizes)), np.int64)
                counts[row, cells.field("place").to_numpy()] = cells.field("n").to_numpy()
                p = _shares(counts, sizes)
                total = sums.setdefault(lang, np.zeros((len(sizes), len(sizes)), np.int64))
                for a in range(len(sizes)):
                    off = p - p[:, a : a + 1]
                    total[a] += (off * off // p).sum(0)
        for lang, total in sums.items():
            a, b = np.indices(total.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(a)).cast(pa.string()), pa.array(a), pa.array(b), pa.array(total.ravel())], names=["lang", "a", "b", "value"]
            )

    return terms.mapInArrow(add, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = 3, levels: Sequence[int] = LEVELS, top: int = 200) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for ``docs(text, lang, source)``.

    Part ``pair``: each other source of the language and the group's divergence from it over all kept terms. Part
    ``term``: the ``top`` kept terms that the group has more often than its language, by divergence from the language.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # One row per group; as a written table its size is known, and Spark broadcasts it where that is small.
    by_name = Window.partitionBy("lang").orderBy("source")
    places = staged(docs.select("lang", "source").distinct().withColumn("place", F.row_number().over(by_name) - 1), "divergence-places")
    cells = kept_terms(docs, min_docs, levels).join(places, ["lang", "source"])
    kept = cells.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("place", "n")).alias("counts")
    )
    kept = staged(kept.where(F.col("docs") >= min_docs).drop("docs"), "divergence-terms")

    whole = kept.groupBy("lang").agg(F.sum("total").alias("all"), F.count(F.lit(1)).alias("v"))
    sizes = kept.select("lang", F.inline("counts")).groupBy("lang", "place").agg(F.sum("n").alias("size"))
    groups = places.join(whole, "lang", "left").join(sizes, ["lang", "place"], "left")
    v = F.coalesce("v", F.lit(0))
    groups = groups.select("lang", "source", "place", (F.coalesce("size", F.lit(0)) + v).alias("size"), (F.coalesce("all", F.lit(0)) + v).alias("all"))
    groups = staged(groups, "divergence-groups")

    in_place = F.array_sort(F.collect_list(F.struct("place", "size")))["size"]
    langs = staged(groups.groupBy("lang").agg(in_place.alias("sizes")), "divergence-langs")
    sums = _pair_sums(kept.join(langs, "lang").select("lang", "counts", "sizes"))
    left = groups.select("lang", "source", F.col("place").alias("a"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"))
    pairs = left.join(right, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    own = kept.select("lang", F.col("term").alias("item"), "total", F.inline("counts")).join(groups, ["lang", "place"])
    own = own.select("lang", "source", "item", _share(F.col("n"), F.col("size")).alias("p"), _share(F.col("total"), F.col("all")).alias("q"))
    own = own.where("p > q").select("lang", "source", "item", _apart(F.col("p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    return ranked(pairs, "pair").unionAll(ranked(own, "term").where(F.col("rank") <= top))
