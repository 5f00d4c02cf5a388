"""Line deduplication by an exact set-similarity join.

A line is the set of its distinct word 5-grams (all its words, if fewer). It is removed when an
earlier line, by document id and then place, has an equal set or one with a Jaccard similarity of at
least 0.8. The tokens of a line are ordered by rarity; two lines can only match when they share one of
their rarest tokens (prefix), when what is left behind that token on both sides still suffices
(position), and when their sizes are close enough (length). What passes is verified on the whole sets.

Lines with equal sets are one from the start. In each group that shares a token, all lines are first
tried against two pivots, the earliest and the one whose shared token comes first (the least edited);
a line that matches needs no further search. What is left is searched in full, by position, length and
a sketch of the tokens, in blocks where a group is large: the likeliest earlier line of each is verified first, all
others only where that one fails, so a group of near copies does not list its pairs. All steps are DataFrame operations.

Rows: lines without a word are never removed; null and empty texts stay as they are. A row is known by
its id and text: rows equal in both are one document. Null ids come last in the order. A document
whose lines are all removed is left out by :func:`deduplicated` (its lines are all elsewhere). An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.jaccard import BLOCK, NO_ID, N, may_link
from millwright.llm.shared import MAX_MARKS, noted_folders, release, shuffles_removed, staged, unused

# A token that so many lines have among their rarest ones is frequent.
FREQUENT = 64
# A line's place in the order of all lines.
FIRST = ("doc", "row", "line")
UPPER, SPACES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\t\n\x0b\x0c\r"
PART_BITS = 32768
# Buckets of the sketch that stands for a line's tokens.
SKETCH = 256
# More copies of a set's tokens than these are told apart before sets are verified.
COPIES = 64
# Rows of so few sets are picked before their lines are looked at.
FEW = 10_000


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def split_lines(rows: DataFrame) -> DataFrame:
    """``(doc, row, line, words)``: the lines of ``rows(doc, row, text)`` that have a word, as text."""
    lines = rows.select("doc", "row", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    return lines.where(F.ltrim("words", F.lit(" " + SPACES)) != "")


def with_tokens(lines: DataFrame) -> DataFrame:
    """The distinct tokens of each line, in the order of their hashes, in place of its ``words``; its ``set`` and their number ``n``."""
    others = [c for c in lines.columns if c != "words"]
    # Only A-Z are folded: `lower` does no more where every character is one byte.
    plain = F.octet_length("words") == F.length("words")
    for blank in SPACES:
        plain &= ~F.contains("words", F.lit(blank))
    folded = F.when(plain, F.lower("words")).otherwise(F.translate("words", UPPER + SPACES, UPPER.lower() + " " * len(SPACES)))
    hashes = lines.select(*others, F.transform(F.array_remove(F.split(folded, " "), ""), lambda word: F.xxhash64(word)).alias("hashes"))
    heads = F.slice("hashes", 1, F.greatest(F.size("hashes") - (N - 1), F.lit(1)))
    grams = F.transform(heads, lambda first, i: F.xxhash64(first, *[F.get("hashes", i + j) for j in range(1, N)]))
    sets = hashes.select(*others, F.sort_array(F.array_distinct(grams)).alias("tokens"))
    return sets.select(*others, F.xxhash64("tokens").alias("set"), F.size("tokens").alias("n"), "tokens")


def prefix_size(n: Column) -> Column:
    """So many of the first tokens of two matching sets, in any one order, have one in common."""
    return n - F.floor((8 * n + 9) / 10).cast("int") + 1


def line_features(rows: DataFrame) -> DataFrame:
    """``(doc, row, line, set, n, prefix)`` of the lines that have a word."""
    return with_tokens(split_lines(rows)).select(*FIRST, "set", "n", F.slice("tokens", 1, prefix_size(F.col("n"))).alias("prefix"))


def among(rows: DataFrame, at: Column, keys: DataFrame) -> DataFrame:
    """Rows whose 64-bit hash may be among ``keys(at)``, by a bitmap of 64 bits a key and at most :data:`MAX_MARKS`; nothing is shuffled."""
    size = min(MAX_MARKS, max(1 << 16, 1 << (64 * keys.count()).bit_length()))

    at_bit = at.bitwiseAND(F.lit(size - 1))
    key_bit = F.col("at").bitwiseAND(F.lit(size - 1))

    def part(bit: Column) -> Column:
        return F.floor(bit / PART_BITS).cast("int")

    bits = keys.groupBy(part(key_bit).alias("_part")).agg(F.bitmap_construct_agg(key_bit.bitwiseAND(F.lit(PART_BITS - 1))).alias("_bits"))
    # Eight bytes at a time as a number, the first byte highest.
    eight = F.transform(F.sequence(F.lit(0), F.lit(PART_BITS // 64 - 1)), lambda k: F.conv(F.hex(F.substring("_bits", k * 8 + 1, F.lit(8))), 16, -10).cast("long"))
    bits = bits.select("_part", eight.alias("_bits"))
    word = F.shiftright(at_bit.bitwiseAND(F.lit(PART_BITS - 1)), 6).cast("int")
    place = at_bit.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int")
    met = rows.withColumn("_part", part(at_bit)).join(F.broadcast(bits), "_part")
    return met.where(F.call_function("shiftright", F.get("_bits", word), place).bitwiseAND(F.lit(1)) == 1).drop("_part", "_bits")


def tokens_of(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """``(set, tokens)`` of ``sets(set, doc, row, line)``, built again from the texts.

    Lines are picked by their places, so a few others are among them and a set may come a few times.
    """
    at_line = F.xxhash64("row", "line")
    places = staged(sets.select("row", at_line.alias("at")), "line-places")
    if places.count() <= FEW:
        rows = rows.join(F.broadcast(places.select("row").distinct()), "row", "left_semi")
    lines = among(split_lines(rows), at_line, places.select("at"))
    with noted_folders() as folders:
        tokens = staged(with_tokens(lines.select("words")).select("set", "tokens"), "line-tokens")
    # Common lines and equal rows may give a set many times.
    many = staged(tokens.groupBy("set").count().where(F.col("count") > COPIES).select("set"), "line-copies")
    if many.isEmpty():
        return tokens
    once = tokens.join(many, "set", "left_semi").dropDuplicates(["set"])
    tokens = staged(tokens.join(many, "set", "left_anti").unionByName(once), "line-tokens")
    release(tokens, folders)
    return tokens


def passes(na: Column, nb: Column, pa_: Column, pb: Column) -> Column:
    """Length and positional filter for two lines that first share a token at the given places.

    The place in a shard of several tokens is the least, which allows the most.
    """
    return may_link(na, nb, F.least(na - pa_, nb - pb))


def matching(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(set)``: the later ones (b) of ``pairs(a, b)`` whose sets have the similarity; only tokens of these sets are shuffled."""
    pairs = staged(pairs, "line-pairs")
    tokens = among(tokens, F.col("set"), pairs.select(F.explode(F.array("a", "b")).alias("at")))
    left, right = tokens.alias("left"), tokens.alias("right")
    both = pairs.join(left, F.col("a") == F.col("left.set")).select("a", "b", F.col("left.tokens").alias("ta"))
    both = both.join(right, F.col("b") == F.col("right.set")).select("b", "ta", F.col("right.tokens").alias("tb"))
    overlap = F.size(F.array_intersect("ta", "tb"))
    return both.where(may_link(F.size("ta"), F.size("tb"), overlap)).select(F.col("b").alias("set")).distinct()


def prefix_entries(sets: DataFrame) -> DataFrame:
    return sets.select("set", F.posexplode("prefix").alias("pos", "token"))


def meeting(entries: DataFrame) -> DataFrame:
    """Those of ``entries(token, set, pos)``, each once, whose token two or more sets have; ``size`` of them."""
    return entries.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("size > 1")


def shards(sets: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(shard, set, pos)``: where sets meet, by the rarest tokens of each; and ``(set, tokens)`` of some.

    Tokens are ordered by their hashes first, as in ``sets``. Those that :data:`FREQUENT` or more sets then have in their prefix,
    and others as frequent in these sets, come last instead, by rising count. Only sets whose
    prefix that changes are looked at again: a listed token is in no prefix of any other set.
    """
    met = staged(meeting(prefix_entries(sets)), "line-met")
    hot = staged(met.where(F.col("size") >= FREQUENT).select("set").distinct(), "line-hot")
    met = met.select("token", "set", "pos")
    tokens = None
    if not hot.isEmpty():
        tokens = tokens_of(sets.select("set", *FIRST).join(met.select("set").distinct(), "set", "left_semi"), rows)
        again = reordered(sets, hot, tokens)
        names = staged(again.select(F.col("token").alias("at")).distinct(), "line-names")
        # A token that sets of both kinds have comes whole with `others`; what else passes the bitmap is met already or alone.
        others = staged(among(prefix_entries(sets), F.col("token"), names), "line-others").join(hot, "set", "left_anti")
        met = met.join(hot, "set", "left_anti").unionByName(others.select("token", "set", "pos")).distinct().unionByName(again)
    # Tokens that the same sets have are one shard.
    own = Window.partitionBy("token")
    named = met.select("*", F.bit_xor(F.xxhash64("set")).over(own).alias("shard"), F.count(F.lit(1)).over(own).alias("many")).where("many > 1")
    return named.groupBy("shard", "set").agg(F.min("pos").alias("pos")), tokens


def reordered(sets: DataFrame, hot: DataFrame, tokens: DataFrame) -> DataFrame:
    """The entries ``(token, set, pos)`` of the sets in ``hot``, by the order that has frequent tokens last."""
    # Sets in `hot` are distinct. A semi join would be pushed below the bitmap, and all tokens shuffled.
    every = among(tokens, F.col("set"), hot.select(F.col("set").alias("at"))).join(hot, "set")
    every = staged(every.dropDuplicates(["set"]), "line-hot")
    every = every.select("set", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    listed = staged(every.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") >= FREQUENT), "frequent")
    taken = prefix_entries(sets).join(listed, "token", "left_semi").join(hot, "set", "left_anti")
    listed = staged(listed.join(taken.select("token").distinct(), "token", "left_anti"), "frequent")
    ordered = every.join(listed, "token", "left").groupBy("set", "n").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("many", F.lit(0)).alias("many"), "token"))).alias("order")
    )
    firsts = ordered.select("set", F.posexplode(F.slice("order", 1, prefix_size(F.col("n")))).alias("pos", "entry"))
    return staged(firsts.select(F.col("entry.token").alias("token"), "set", "pos"), "line-entries")


def sketches(tokens: DataFrame) -> DataFrame:
    """``(set, bits)``: parities of the tokens of each set in :data:`SKETCH` buckets.

    As many buckets as differ between two sets hold tokens that only one of them has, at least.
    """
    every = tokens.withColumn("copy", F.monotonically_increasing_id()).select("set", "copy", F.explode("tokens").alias("token"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("token", F.lit(64)).cast("int"))
    bucket, names = F.pmod(F.shiftright("token", 6), F.lit(SKETCH // 64)), [f"s{k}" for k in range(SKETCH // 64)]
    parts = every.groupBy("set", "copy").agg(*[F.bit_xor(F.when(bucket == k, bit).otherwise(F.lit(0).cast("long"))).alias(s) for k, s in enumerate(names)])
    return parts.groupBy("set").agg(*[F.min(s).alias(s) for s in names]).select("set", F.struct(*names).alias("bits"))


def apart(x: str, y: str) -> Column:
    """So many tokens, at least, are in only one of two sets with the given sketches."""
    return sum((F.bit_count(F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))) for k in range(1, SKETCH // 64)), F.bit_count(F.col(f"{x}.s0").bitwiseXOR(F.col(f"{y}.s0"))))


def candidates(left: DataFrame, found: DataFrame) -> DataFrame:
    """``(a, b, apart)``: sets of ``left`` that are not ``found`` (b) and earlier ones (a) that pass the filters.

    Earlier sets are dealt over blocks of a large shard; an open one is held against each block. Pairs with a pivot are left out.
    """
    late = left.join(found, "set", "left_anti")
    early = left.join(late.select("shard").distinct(), "shard", "left_semi")
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    both = ["shard", "block"]
    sides = [
        frame.select("shard", block.alias("block"), *[F.col(c).alias(f"{c}_{x}") for c in ("set", "n", "pos", "bits", *FIRST)], F.col("set").isin(F.col("p"), F.col("q")).alias(f"pivot_{x}"))
        for x, frame, block in (("a", early, F.pmod(F.hash("set"), n_blocks).cast("int")), ("b", late, F.explode(F.sequence(F.lit(0), n_blocks - 1))))
    ]
    place_a, place_b = (F.struct(*[F.col(f"{c}_{x}").alias(c) for c in FIRST]) for x in "ab")
    pairs = sides[0].where("not pivot_a").join(sides[1].where("not pivot_b"), both).where(place_a < place_b)
    pairs = pairs.where(passes(F.col("n_a"), F.col("n_b"), F.col("pos_a"), F.col("pos_b")))
    pairs = pairs.where(9 * apart("bits_a", "bits_b") <= F.col("n_a") + F.col("n_b"))
    return pairs.select(F.col("set_a").alias("a"), F.col("set_b").alias("b"), apart("bits_a", "bits_b").alias("apart"))


def near_copies(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """Sets that an earlier, different set matches; ``sets`` has one row per set with its first place."""
    where, tokens = shards(sets, rows)
    places = sets.select("set", "n", *FIRST)
    where = staged(where.join(places, "set"), "line-shards")
    lacking = where.select("set", *FIRST).distinct()
    # Sets that meet others by the new order alone, or all of them if no order changed.
    more = tokens_of(lacking if tokens is None else lacking.join(tokens.select("set"), "set", "left_anti"), rows)
    tokens = more if tokens is None else tokens.unionByName(more)
    pivots = where.groupBy("shard").agg(
        F.min(F.struct(*FIRST, "set", "n", "pos")).alias("earliest"),
        F.min(F.struct("pos", *FIRST, "set", "n")).alias("least"),
        F.count(F.lit(1)).alias("size"),
    )
    where = staged(where.join(pivots, "shard"), "line-shards")
    place = F.struct(*FIRST)
    tried = where.withColumn("p", F.explode(F.array_distinct(F.array(*[
        F.struct(F.col(f"{k}.set").alias("set"), F.col(f"{k}.n").alias("n"), F.col(f"{k}.pos").alias("pos"), F.struct(*[F.col(f"{k}.{c}") for c in FIRST]).alias("place"))
        for k in ("earliest", "least")
    ]))))
    tried = tried.where((F.col("p.set") != F.col("set")) & passes(F.col("n"), F.col("p.n"), F.col("pos"), F.col("p.pos")))
    before = F.col("p.place") < place
    tried = tried.select(F.when(before, F.col("p.set")).otherwise(F.col("set")).alias("a"), F.when(before, F.col("set")).otherwise(F.col("p.set")).alias("b"))
    found = staged(matching(tried.distinct(), tokens), "line-found")

    # Of a set still open the likeliest earlier one is verified, then all others; a group of near copies never lists its pairs.
    left = where.where("size > 2").select("shard", "set", "pos", "n", *FIRST, "size", F.col("earliest.set").alias("p"), F.col("least.set").alias("q"))
    open_shards = left.join(found, "set", "left_anti").select("shard").distinct()
    left = staged(left.join(open_shards, "shard", "left_semi"), "line-left")
    left = staged(left.join(sketches(tokens), "set"), "line-left")
    best = candidates(left, found).groupBy("b").agg(F.min_by("a", "apart").alias("a"), F.count(F.lit(1)).alias("many"))
    best = staged(best, "line-best")
    also = staged(matching(best.select("a", "b"), tokens), "line-found")
    done = staged(found.unionAll(also), "line-found")
    alone = best.where("many > 1").select(F.col("b").alias("set")).join(done, "set", "left_anti")
    alone = staged(alone, "line-open")
    if alone.isEmpty():
        return done
    settled = left.select("set").distinct().join(alone, "set", "left_anti")
    rest = candidates(left, settled).select("a", "b").distinct()
    return done.unionAll(matching(rest, tokens))


def removed_lines(docs: DataFrame) -> DataFrame:
    """``(row, lines)``: the numbers of the lines to remove from each row of ``docs(doc_id, text)`` that loses any."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), row_key().alias("row"), F.col("text").cast("string"))
    with shuffles_removed(docs.sparkSession):
        with noted_folders() as folders:
            features = staged(line_features(rows), "lines")
        lines = staged(features.select("set", *FIRST), "lines")
        sets = features.groupBy("set").agg(F.min(F.struct(*FIRST, "n", "prefix")).alias("first"), F.count(F.lit(1)).alias("many"))
        sets = staged(sets.select("set", "first.*", "many"), "line-sets")
        release(sets, folders)
        near = near_copies(sets, rows).distinct().withColumn("_near", F.lit(True))
    fate = sets.select("set", "many", *[F.col(c).alias(f"_{c}") for c in FIRST]).join(near, "set", "left").where("many > 1 or _near")
    judged = lines.select("set", *FIRST).join(fate, "set")
    later = (F.col("doc") != F.col("_doc")) | (F.col("row") != F.col("_row")) | (F.col("line") != F.col("_line"))
    return judged.where(later | F.col("_near").isNotNull()).groupBy("row").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without the removed lines; documents that lose every line with a word are left out.

    All columns stay, whatever their names.
    """
    out, lines, gone = lines_to_remove(docs)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(gone, i))
    text = F.when(F.size(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    empty = (F.size(gone) > 0) & (F.trim(F.translate(F.array_join(kept, " "), "\t\n\x0b\x0c\r", "     ")) == "")
    return out.where(~empty | F.col("text").isNull()).withColumn("text", text).drop(lines, gone)


def lines_to_remove(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with its lines and the numbers of those to remove, and the names of these two columns."""
    key, row, lines, numbers = unused(docs, "_key", "_row", "_lines", "_gone")
    gone = removed_lines(docs).withColumnsRenamed({"row": row, "lines": numbers})
    keyed = docs.withColumn(key, row_key())
    out = keyed.join(gone, keyed[key] == gone[row], "left").drop(key, row)
    out = out.withColumn(numbers, F.coalesce(numbers, F.array().cast("array<int>")))
    return out.withColumn(lines, F.split(F.col("text"), "\n")), lines, numbers


def line_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed_lines)`` per row; line numbers count from 0."""
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(breaks + 1).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_lines.alias("n_lines"), row_key().alias("row"))
    gone = F.coalesce("lines", F.array().cast("array<int>"))
    return rows.join(removed_lines(docs), "row", "left").select("doc_id", "n_lines", F.size(gone).cast("long").alias("n_removed"), gone.alias("removed_lines"))
