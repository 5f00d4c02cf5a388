"""Line dedup by DataFrame operations alone, against all pairs, with rare and frequent tokens."""

import random
import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm import line_dedup, shared


def grams(line):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in line))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def removed(texts):
    seen, out = [], {}
    for k, text in enumerate(texts):
        out[k] = []
        for n, line in enumerate(text.split("\n") if text is not None else []):
            own = grams(line)
            if own:
                if any(5 * len(own & s) >= 4 * len(own | s) for s in seen):
                    out[k].append(n)
                seen.append(own)
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(31)

    def words(n):
        return [f"{r.choice(['w', 'W', 'é', 'É', '語'])}{r.randrange(400)}" for _ in range(n)]

    passage, base, lines = words(24), words(60), []
    for _ in range(12):  # a passage that many lines share, of which few match
        lines.append(words(r.randrange(0, 12)) + passage + words(r.randrange(0, 12)))
    for _ in range(14):  # near copies of one line
        line = list(base)
        for _ in range(r.randrange(0, 4)):
            line[r.randrange(len(line))] = "new"
        lines.append(line)
    lines += [words(r.randrange(1, 30)) for _ in range(20)] + [base, base[:3], base[:3], ["A", "B"], ["a", "b"], ["É"], ["é"]]
    r.shuffle(lines)
    blanks = [" ", "  ", "\t", "\r", "\x0b ", "\x0c"]
    joined = [r.choice(["", " "]) + "".join(w + r.choice(blanks if i % 3 == 0 else [" "]) for w in line) for i, line in enumerate(lines)]
    return ["\n".join(joined[i : i + 3]) for i in range(0, len(joined), 3)] + [None, "", "\n \n\t", joined[0] + "\n" + joined[0].upper()]


@pytest.mark.parametrize(("frequent", "block"), [(64, 2048), (3, 2), (6, 3)])
def test_lines_without_python_on_executors(spark, monkeypatch, texts, frequent, block):
    def refused(*_, **__):
        raise AssertionError("Python on the executors")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(DataFrame, name, refused)
        monkeypatch.setattr(type(spark.range(1)), name, refused)
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent, raising=False)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["removed_lines"] for r in line_dedup.line_report(docs).collect()} == removed(texts)


def test_lists_of_folders_are_told_apart(spark):
    with shared.noted_folders() as outer:
        with shared.noted_folders() as inner:
            shared.staged(spark.range(3), "told-apart")
        assert inner == outer
        shared.staged(spark.range(3), "told-apart")
    assert (len(inner), len(outer)) == (1, 2)


def test_near_copies_do_not_list_their_pairs(spark, monkeypatch):
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(60)]
    lines = []
    for _ in range(120):  # most of these match many earlier ones, not always a pivot
        line = list(base)
        for _ in range(r.randrange(1, 3)):
            line[r.randrange(len(line))] = f"new{r.randrange(10**6)}"
        lines.append(" ".join(line))
    sizes, matching = [], line_dedup.matching

    def counted(pairs, tokens):
        sizes.append(pairs.count())
        return matching(pairs, tokens)

    monkeypatch.setattr(line_dedup, "matching", counted)
    docs = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "doc_id long, text string")
    assert {x["doc_id"]: x["removed_lines"] for x in line_dedup.line_report(docs).collect()} == removed(lines)
    assert 0 < sum(sizes) < 10 * len(lines)


def test_sketches_never_tell_too_much(spark):
    r = random.Random(9)
    sets = {k: {r.randrange(-(2**63), 2**63) for _ in range(40)} for k in range(6)}
    sets |= {k + 6: set(list(sets[k])[: 40 - k]) for k in range(6)}
    tokens = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()] * 2, "set long, tokens array<long>").repartition(3)
    both = line_dedup.sketches(tokens)
    both = both.withColumnsRenamed({"set": "a", "bits": "ba"}).crossJoin(both.withColumnsRenamed({"set": "b", "bits": "bb"}))
    got = {(x["a"], x["b"]): x["d"] for x in both.select("a", "b", line_dedup.apart("ba", "bb").alias("d")).collect()}
    assert len(got) == 144
    assert all(d <= len(sets[a] ^ sets[b]) for (a, b), d in got.items())
    assert all(got[k, k + 6] >= k - 2 for k in range(6))
    assert min(d for (a, b), d in got.items() if a < b < 6) > 40


def test_only_tokens_of_the_pairs_are_shuffled(spark):
    r = random.Random(3)
    rows = [(k, sorted(r.randrange(-(2**63), 2**63) for _ in range(5))) for k in range(50_000)]
    rows[7] = (7, rows[8][1])
    tokens = shared.staged(spark.createDataFrame(rows, "set long, tokens array<long>"), "line-test")
    pairs = spark.createDataFrame([(k, k + 1) for k in range(0, 200, 7)], "a long, b long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables of this size would not be shuffled at all
    try:
        out = line_dedup.matching(pairs, tokens)
        assert [x["set"] for x in out.collect()] == [8]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan, seen = out._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName() == "Exchange":
            written = node.metrics().get("shuffleRecordsWritten")
            seen.append(written.get().value() if written.isDefined() else 0)
        for inner in ([node.plan()] if node.nodeName().endswith("QueryStage") else []) + [node.children().apply(i) for i in range(node.children().size())]:
            walk(inner)

    walk(plan)
    assert seen and max(seen) < 5000


def test_bitmaps_pass_all_keys_and_few_others(spark):
    r = random.Random(8)
    keys = [r.randrange(-(2**63), 2**63) for _ in range(3000)] + [0, -1, 63, 64, 2**63 - 1, -(2**63)]
    others = [r.randrange(-(2**63), 2**63) for _ in range(3000)]
    rows = spark.createDataFrame([(k,) for k in keys + others], "token long")
    got = {x["token"] for x in line_dedup.among(rows, F.col("token"), spark.createDataFrame([(k,) for k in keys], "at long")).collect()}
    assert set(keys) <= got and len(got) < len(keys) + 150
    none = spark.createDataFrame([], "at long")
    assert line_dedup.among(rows, F.col("token"), none).collect() == []


@pytest.mark.parametrize("text", [None, "", "\n", "a", "a\n", "\na\n\nb", "é\r\n語\n"])
def test_lines_are_counted_as_they_are_split(spark, text):
    row = line_dedup.line_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_lines"] == (0 if text is None else text.count("\n") + 1)
