"""The divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from millwright.llm import divergence
from millwright.llm.divergence import source_divergence

# Tells the most that Arrow held; it has to outlive what was made with it.
POOL = pa.proxy_memory_pool(pa.default_memory_pool())
SCHEMA = "doc_id long, text string, lang string, source string, key string, n long, `Item` string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]

        def shares(count, kept=kept):
            size = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // size for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[s][t] - whole[t]) ** 2 // whole[t]) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["".join(r.choice("abcXYZé日") for _ in range(r.choice([1, 1, 2, 3, 5, 9, 17, 18, 40]))) for _ in range(700)]
    words += ["prefix" * 3 + w for w in "abcdef"] + ["pre", "prefix"]

    def text(n):
        return "".join(r.choice(words) + r.choice([" ", "\n", "1", "_", "\x00", "."]) for _ in range(n))

    out = [(k, text(r.randint(0, 80)), r.choice(["en", "en", "de", None]), r.choice(["a", "a", "a", "b", "Z", "é", None])) for k in range(240)]
    out += [out[5]] * 4 + [(None, None, None, None), (1, "", "xx", "a"), (2, "solo", "xx", "b"), (3, "12 _", "yy", "a")]
    out.append((4, " ".join(r.choice(words) for _ in range(300_000)), "de", "b"))  # longer than a slice
    out.append((5, "q" * 100_000 + " " + "q" * 100_001, "de", "a"))
    return [(*row, "k", 1, "i") for row in out]


@pytest.mark.parametrize(("levels", "parts"), [((2, 4, 8, 16), 4), ((1, 2, 3), 1), ((), 7)])
def test_rows_are_those_of_plain_counting(spark, rows, levels, parts):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = source_divergence(docs, levels=levels).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_ties_are_ranked_by_item(spark):
    rows = [(k, "bb aa é cc", "en", s, "", 1, "") for k, s in enumerate("xxxyyy")] + [(9, "rest rest rest", "en", "z", "", 1, "")] * 3
    got = source_divergence(spark.createDataFrame(rows, SCHEMA), top=3).collect()
    assert sorted(map(tuple, got)) == plain(rows, 3)
    assert [r["item"] for r in sorted(got, key=lambda r: r["rank"]) if r["part"] == "term" and r["source"] == "x"] == ["aa", "bb", "cc"]


def test_an_empty_table_gives_no_rows(spark):
    out = source_divergence(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_rows_of_a_task_are_added_up_in_little_memory(spark):
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(24)) for _ in range(4000)]
    rows = [(k, " ".join(r.sample(words, 400)), "english, a long name", f"source of a long name {k % 20}", "", 1, "") for k in range(600)]
    found = divergence.chunks(spark.createDataFrame(rows, SCHEMA).repartition(6)).toArrow().to_batches()

    class Task:
        def mapInArrow(self, run, schema):
            return run(iter(found))

    before = pa.default_memory_pool()
    pa.set_memory_pool(POOL)
    try:
        counts = Counter()
        for batch in divergence._terms(Task(), None):
            lang, term, source, docs, n = (c.to_pylist() for c in batch.columns)
            assert set(lang) == {rows[0][2]} and docs == n
            counts.update(dict(zip(zip(term, source, strict=True), n, strict=True)))
    finally:
        pa.set_memory_pool(before)
    assert counts == Counter((w, row[3]) for row in rows for w in row[1].split())
    # Of about 200,000 rows Arrow held 15.9 MB while they were texts, and holds 6.4 MB of codes and counts.
    assert POOL.max_memory() < 10_000_000
