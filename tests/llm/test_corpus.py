"""Corpus operators against brute-force versions on small tables with odd rows."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest

from millwright.llm import chat, decontaminate, importance, jaccard, line_dedup, mixing, repeats, rules, token_counts, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_grams string, key string"


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text):
    w = WORD.findall(fold(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def similar(a, b):
    common = len(a & b)
    return bool(common) and 100 * common >= 80 * (len(a) + len(b) - common)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(r.choice(vocabulary) + ("\n" if r.random() < 0.05 else "") for _ in range(n))

    passage = " ".join(r.choice(vocabulary) for _ in range(70))
    out = [prose(r.randint(1, 120)) for _ in range(60)]
    base = prose(150)
    for k in range(25):  # near copies with 0 to 4 words replaced
        words = base.split(" ")
        for _ in range(k % 5):
            words[r.randrange(len(words))] = f"edit{r.random()}"
        out.append(" ".join(words))
    out += [out[3]] * 6 + [base.upper()]
    out += [f"{prose(20)} {passage} {prose(r.randint(5, 30))}" for _ in range(8)]
    out += [None, "", "   \n\t ", "one", "one", "Äpfel naïve 日本 😀", prose(6000), "la " * 400, "x", passage]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, ["en", "de", None][k % 3], ["a", "b", None, "a"][k % 4], len(t or ""), "own", "k") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components_are_those_of_all_pairs(docs, texts):
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        if similar(sets[a], sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()}
    assert got == {k: (len(s), find(k)) for k, s in enumerate(sets)}
    kept = {r["doc_id"] for r in jaccard.one_of_each(docs).collect()}
    assert kept == {k for k, s in enumerate(sets) if find(k) == k or not s}


def test_tree_blocks_and_listed_tokens_change_nothing(docs, texts, monkeypatch):
    before = sorted(map(tuple, jaccard.jaccard_components(docs).collect()))
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "MAX_LISTED", 5)
    assert sorted(map(tuple, jaccard.jaccard_components(docs).collect())) == before


def test_components_with_null_and_repeated_ids(spark):
    text = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(None, text), (7, text), (7, text), (9, text + " u"), (None, "other words here that are alone now"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in jaccard.jaccard_components(docs).collect())
    assert got == [(-1, 3, -1), (-1, 16, 7), (7, 0, 7), (7, 16, 7), (7, 16, 7), (9, 17, 7)]
    assert sorted((r["doc_id"] or -1) for r in jaccard.one_of_each(docs).collect()) == [-1, 7, 7]


def test_lines_removed_are_those_of_all_pairs(docs, texts):
    seen, want = [], defaultdict(list)
    for k, t in enumerate(texts):
        for n, line in enumerate((t or "").split("\n")):
            own = grams(line)
            if own:
                if any(similar(own, s) for s in seen):
                    want[k].append(n)
                seen.append(own)
    got = {r["doc_id"]: r["removed_lines"] for r in line_dedup.line_report(docs).collect()}
    assert got == {k: want[k] for k in range(len(texts))}
    out = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs).collect()}
    for k, t in enumerate(texts):
        if t is None or not want[k]:
            assert out[k] == t
        else:
            left = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[k])
            assert out.get(k) == (left if left.strip(" \t\n") else None)


def test_token_counts_agree_with_the_library(docs, texts):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    spark = docs.sparkSession
    odd = ["it's they'll we've 's 'S  's\n's ''s 're 'r", "\n\n a\n b \n", "<|endoftext|>x <|endoftext|> y", "日本語 १२३ ½ x", " '", "!!!  ??", "x" * 3000, "\x1c a\x85b"]
    every = [*texts, *odd]
    rows = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(rows, path).collect()}
    for k, t in enumerate(every):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[k] == (len((t or "").encode()), n, n > 512)


def test_repeats_are_those_of_all_windows(docs, texts):
    windows = defaultdict(set)
    for k, t in enumerate(texts):
        w = WORD.findall(t or "")
        for i in range(len(w) - 49):
            windows[tuple(w[i : i + 50])].add(k)
    want = {k for own in windows.values() if len(own) > 1 for k in own}
    rows = repeats.repeats(docs).collect()
    assert {r["doc_id"] for r in rows if any(x != r["doc_id"] for x in r["other_ids"])} == want
    for r in rows:
        w = WORD.findall(texts[r["doc_id"]])
        for s in r["spans"]:
            assert s["end"] - s["start"] >= 50 and s["end"] <= len(w)
    cut = {r["doc_id"]: r["text"] for r in repeats.without_repeats(docs).collect()}
    assert len(cut) == len(texts) and cut[0] == texts[0] and len(cut[61]) < len(texts[61])


def test_contaminations_tolerate_replaced_words(spark):
    r = random.Random(1)
    items = [" ".join(f"w{r.randrange(10**6)}" for _ in range(n)) for n in (40, 20, 9, 3)]
    words = items[0].split()
    words[7], words[19] = "other", "changed"
    rows = [(0, "pre " + " ".join(words) + " post"), (1, "clean text of nothing"), (2, f"a b {items[1].upper()}, c"), (3, f"x {items[2]}"), (4, items[3]), (5, None), (6, ""), (None, items[0])]
    rows += [(8, " ".join(items[0].split()[:13])), (9, " ".join(items[0].split()[:8]))]
    docs = spark.createDataFrame([(*x, "e") for x in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*enumerate(items), (8, None), (9, "")], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminations(docs, bench).collect()}
    assert got == {(0, 0), (2, 1), (3, 2), (None, 0), (8, 0)}
    small = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminations(docs, bench, max_words=20).collect()}
    assert small == got
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {1, 4, 5, 6, 9}
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0 and decontaminate.decontaminated(docs, bench.limit(0)).count() == 10


def test_near_copies_are_compared_by_all_windows(spark):
    r = random.Random(7)
    base = [f"w{k}" for k in range(200)]
    passages = [[f"p{g}x{k}" for k in range(50)] for g in range(5)]
    every = [[w if r.random() > 0.05 else f"e{r.random()}" for w in base] for _ in range(300)]
    every += [[f"a{r.random()}"] + passages[g] + [f"b{r.random()}"] for g in range(5) for _ in range(60)]
    windows = defaultdict(list)
    for k, w in enumerate(every):
        for i in range(len(w) - 49):
            windows[tuple(w[i : i + 50])].append((k, i))
    want, gone = defaultdict(set), defaultdict(set)
    for places in windows.values():
        for k, i in places if len(places) > 1 else ():
            want[k].update(range(i, i + 50))
            if k > places[0][0]:
                gone[k].update(range(i, i + 50))
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(every)], "doc_id long, text string").repartition(7)
    got = {x["doc_id"]: {i for s in x["spans"] for i in range(s["start"], s["end"])} for x in repeats.repeats(docs).collect()}
    assert got == want
    left = {x["doc_id"]: WORD.findall(x["text"]) for x in repeats.without_repeats(docs).collect()}
    assert left == {k: [x for i, x in enumerate(w) if i not in gone[k]] for k, w in enumerate(every)}


def test_copies_in_a_row_are_those_of_all_windows(spark):
    r = random.Random(6)

    def prose(n):
        return [f"w{r.randrange(10**9)}" for _ in range(n)]

    every = [prose(10) + prose(n) * copies + prose(10) for n in (20, 50, 60, 100) for copies in range(2, 9)]
    want = {}
    for k, w in enumerate(every):
        places = defaultdict(list)
        for i in range(len(w) - 49):
            places[tuple(w[i : i + 50])].append(i)
        cover = {i + j for p in places.values() for i in p if i - p[0] >= 50 or p[-1] - i >= 50 for j in range(50)}
        if cover:
            want[k] = cover
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(every)], "doc_id long, text string")
    got = {x["doc_id"]: {i for s in x["spans"] for i in range(s["start"], s["end"])} for x in repeats.repeats(docs).collect()}
    assert got == want


@pytest.mark.parametrize("length", [*range(5, 21), 26])
def test_every_accepted_placement_is_found(length):
    import numpy as np

    bench = decontaminate.Benchmark([1], [" ".join(f"w{k}" for k in range(length))], 5)
    own, size = bench.words[0], min(13, length)
    copies, want = [], []
    cases = [(p, 0, length) for n in range(4) for p in combinations(range(length), n)] if length <= 20 else []
    # Texts that hold only a window of a longer item.
    cases += [(p, at, at + size) for at in range(length - size + 1) for n in range(4) for p in combinations(range(at, at + size), n)]
    for places, low, high in cases:
        words = own.copy()
        words[list(places)] = 3
        kept = [k not in places for k in range(low, high)]
        want.append(any(10 * sum(kept[i : i + size]) >= 8 * size for i in range(high - low - size + 1)))
        copies.append(words[low:high])
    first = np.cumsum([0, *map(len, copies)])
    found = {t for t, *_ in decontaminate.matches(np.concatenate(copies), first, bench, 13, 0.8)}
    assert found == {t for t, accepted in enumerate(want) if accepted}


def test_mixture_meets_targets(docs, texts):
    rows = mixing.mixture(docs).collect()
    size = {k: len(WORD.findall(t or "")) for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["size"] for r in rows} == size
    taken, target = defaultdict(int), {}
    for r in rows:
        source = ["a", "b", None, "a"][r["doc_id"] % 4]
        taken[source] += r["taken"]
        target[source] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    total = sum(size.values())
    assert sum(target.values()) == pytest.approx(total)
    for s in taken:
        assert abs(taken[s] - target[s]) <= 1
    order = mixing.curriculum(docs).collect()
    assert [r["train_time"] for r in order] == sorted(r["train_time"] for r in order)
    assert sum(r["words_taken"] for r in order) == sum(taken.values())
    assert all(0 <= r["train_time"] <= 1 for r in order)


def test_mixture_is_the_sum_of_its_dealt_rounds(docs, texts, monkeypatch):
    rows, keep = [], mixing.staged

    def watched(df, name):
        out = keep(df, name)
        if name == "mix-order":
            rows.extend(out.collect())
        return out

    monkeypatch.setattr(mixing, "staged", watched)
    mixed = mixing.mixture(docs).collect()
    got = {r["doc_id"]: r["taken"] for r in mixed}
    sources = ["a", "b", None, "a"]
    size = {k: len(WORD.findall(t or "")) for k, t in enumerate(texts)}
    inner = {k: hashlib.md5((t or "").encode()).hexdigest() for k, t in enumerate(texts)}
    place = {k: hashlib.md5(f"{k}:{inner[k]}".encode()).hexdigest() for k in size}
    stream = sorted(size, key=lambda k: place[k])
    quota = {r["source"]: round(r["target"]) for r in rows}
    want, taken = {}, dict.fromkeys(size, 0)
    for rank, source in enumerate(("a", "b", None)):
        own, at, number = [k for k in stream if sources[k % 4] == source], 0, 0
        knots = mixing.SCHEDULES[rank]
        while at < quota[source]:
            for k in own:
                words = min(size[k], quota[source] - at)
                if words > 0:
                    share, low, high = (at + words / 2) / quota[source], 0.0, 1.0
                    for _ in range(60):  # bisection of the integral
                        t = (low + high) / 2
                        x, y = min(t, 0.5), max(t - 0.5, 0.0)
                        area = knots[0] * x + (knots[1] - knots[0]) * x * x + knots[1] * y + (knots[2] - knots[1]) * y * y
                        low, high = (t, high) if area < share * ((knots[0] + knots[2]) / 4 + knots[1] / 2) else (low, t)
                    want[k, number] = (words, low)
                    taken[k] += words
                    at += words
            number += 1
    assert got == taken
    dealt = {(r["doc_id"], r["round"]): (r["words_taken"], r["train_time"]) for r in rows if r["round"] is not None}
    assert set(dealt) == set(want)
    assert all(dealt[x][0] == want[x][0] and dealt[x][1] == pytest.approx(want[x][1], abs=1e-9) for x in want)
    assert sorted(r["doc_id"] for r in rows if r["round"] is None) == [k for k in sorted(taken) if taken[k] == 0]
    before, first = 0, dict.fromkeys(size)
    for k, number in sorted(want, key=lambda x: (dealt[x][1], place[x[0]], x[1])):
        first[k] = before if first[k] is None else first[k]
        before += want[k, number][0]
    assert {r["doc_id"]: r["position"] for r in mixed} == first


def test_mixture_positions_do_not_depend_on_cells(docs, monkeypatch):
    want = sorted(mixing.mixture(docs).collect(), key=str)
    placed = mixing._placed
    monkeypatch.setattr(mixing, "_placed", lambda dealt: placed(dealt, cell_rows=5))
    assert sorted(mixing.mixture(docs).collect(), key=str) == want


def test_mixture_spreads_null_and_repeated_ids(spark):
    rows = [(None if k % 3 else 7, f"w{k} " * (1 + k % 4), "s" if k % 2 else None) for k in range(300)] + [(None, None, None), (7, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert docs.select(mixing.stream_order()).distinct().count() == 302
    got = mixing.mixture(docs).collect()
    assert len(got) == 302
    assert sum(r["taken"] for r in got) == sum(r["size"] for r in got)
    assert sum(r["position"] is None for r in got) == sum(r["taken"] == 0 for r in got)
    times = docs.withColumn("ROUND", docs["doc_id"])
    assert mixing.curriculum(times).columns == ["doc_id", "text", "source", "round", "words_taken", "train_time"]


def test_due_time_inverts_the_schedule(spark):
    from pyspark.sql import functions as F

    def integral(knots, t):
        n, out = len(knots) - 1, 0.0
        for i in range(n):
            x = min(max(t - i / n, 0), 1 / n)
            out += knots[i] * x + (knots[i + 1] - knots[i]) * n * x * x / 2
        return out

    rows = spark.range(303).select((F.col("id") % 101 / 100).alias("share"), F.floor(F.col("id") / 101).alias("rank"))
    for r in rows.withColumn("t", mixing.due_time(F.col("share"), F.col("rank"))).collect():
        knots = mixing.SCHEDULES[r["rank"]]
        assert integral(knots, r["t"]) / integral(knots, 1) == pytest.approx(r["share"], abs=1e-9)


def test_quality_rules_base_counts(docs, texts):
    got = {r["doc_id"]: r for r in rules.quality_rules(docs).collect()}
    for k, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        places = defaultdict(list)
        for i in range(len(w) - 2):
            places[tuple(w[i : i + 3])].append(i)
        repeated = len({i + j for p in places.values() if len(p) > 1 for i in p for j in range(3)})
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), dup, repeated)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert r["base_failed"] == (len(w) < 50 or 100 * repeated > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_references_count_all_words_however_rows_are_dealt(spark):
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(400)]
    langs = ["en", "de", None, "xx"]
    rows = [(k, " ".join(r.choice(vocabulary[: 40 + 90 * (k % 4)]) for _ in range(r.randint(1, 300))), langs[k % 4]) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [rules.quality_rules(docs.repartition(n)).collect() for n in (1, 40)]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))
    known = rules.references(docs.repartition(7))
    assert set(known) == {"en", "de", "xx", rules.ALL}
    for lang, (_, _, shares) in known.items():
        counts = defaultdict(int)
        for _, text, own in rows:
            if lang in (own, rules.ALL):
                for word in text.split():
                    counts[word] += 1
        best = sorted(counts.values(), reverse=True)[: rules.COMMON]
        assert shares[:-1] == pytest.approx([n / sum(counts.values()) for n in best])
    size = {lang: sum(len(text.split()) for _, text, own in rows if own == lang) for lang in ("en", "de", "xx")}
    assert set(rules.references(docs, max_languages=2)) == {rules.ALL, *sorted(size, key=size.get)[1:]}


def test_distance_is_that_of_jensen_and_shannon():
    import numpy as np

    p, q = np.array([[0.5, 0.5, 0.0], [1.0, 0.0, 0.0]]), np.array([[0.5, 0.5, 0.0], [0.0, 1.0, 0.0]])
    assert rules.distance(p, q).tolist() == [0.0, 1.0]


def test_chats_read_back(spark):
    texts = ["\\### Assistant: </turn> ok", "####", "\\", None, "", "::: </turn", "\\0 \\1 \\-", "a\nb"]
    roles = ["system", "user", "assistant", None, "tool:: x", ""]
    r = random.Random(2)
    rows = [(c, t, r.choice(roles), r.choice(texts), "e") for c in range(40) for t in range(r.randint(1, 6))]
    rows += [(100, 0, "user", "u", "e"), (100, 1, "assistant", "\\### A", "e"), (None, 0, "user", "x", "e"), (101, 0, "user", "d", "e"), (101, 0, "user", "d", "e")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {x["conv_id"]: x for x in chat.chat_digests(chat.chats(table)).collect()}
    by = defaultdict(list)
    for c, t, role, text, _ in rows:
        by[c].append((t, role is not None, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        lost = "".join(text for _, _, role, text in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    assert got[100]["valid"] and not got[101]["valid"] and not got[None]["valid"]


def test_importance_resampling_rejects_junk(spark):
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    good = [" ".join(r.choice(vocabulary) for _ in range(80)) + "." for _ in range(300)]
    junk = [" ".join(r.choice(vocabulary).upper() + "!!" for _ in range(80)) for _ in range(40)]
    rows = [(k, t, "e") for k, t in enumerate(good + junk)] + [(900, None, "e"), (901, "", "e"), (None, good[0], "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    labels = spark.createDataFrame([(k, int(k < 300)) for k in range(0, 340, 2)] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {x["doc_id"]: x["kept"] for x in importance.importance_resampling(docs, labels).collect()}
    assert all(got[k] for k in range(300)) and not any(got[k] for k in range(300, 340)) and got[None]
    kept = importance.resampled(docs, labels)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {k for k, v in got.items() if v}
    assert importance.importance_resampling(docs, labels.limit(0)).where("log_weight <> 0").count() == 0


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(200)]
    bad = [f"nasty{r.choice('abcdefgh')}{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(900):
        words = [r.choice(vocabulary) for _ in range(r.randint(3, 150))]
        toxic = int(k % 5 == 0)
        if toxic:
            words[r.randrange(len(words))] = r.choice(bad)
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    rows += [(9000, None), (9001, ""), (None, "plain")]
    got = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(x["predicted"], x["doc_id"] % 5 == 0) for x in got if x["held_out"] and x["doc_id"] is not None and x["doc_id"] < 900]
    assert len(got) == 903 and sum(p == t for p, t in held) >= 0.95 * len(held)
    assert all(0 <= x["score"] <= 1 for x in got)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert jaccard.jaccard_components(empty).count() == 0
    assert line_dedup.deduplicated(empty).columns == empty.columns
    assert repeats.repeats(empty).count() == 0
    assert rules.quality_rules(empty).count() == 0
    assert mixing.mixture(empty).count() == 0 and mixing.curriculum(empty).count() == 0
    assert importance.resampled(empty, labels).count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0
    assert chat.chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("extra", [("_key", "_row", "_lines", "_gone", "_kept", "_cuts"), ("_KEY", "_ROW", "N_GRAMS", "KEY", "Log_Weight", "_own_KEY")])
def test_columns_of_any_name_pass_through(spark, extra):
    r = random.Random(9)
    base = [f"w{r.randrange(500)}" for _ in range(60)]
    texts = [" ".join(base), " ".join(base), " ".join(f"v{r.randrange(500)}" for _ in range(60)), None, ""]
    names = ["doc_id", "text", *extra]
    rows = [(k, t, *[f"{k}-{c}" for c in extra]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'doc_id' else 'string'}" for c in names)).repartition(2)
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 1)], "doc_id long, quality int")

    def own(out):
        assert out.columns == names
        got = {x["doc_id"]: tuple(x) for x in out.collect()}
        assert all(v[2:] == rows[k][2:] for k, v in got.items())
        return {k: v[1] for k, v in got.items()}

    assert own(jaccard.one_of_each(docs)) == {k: texts[k] for k in (0, 2, 3, 4)}
    assert own(line_dedup.deduplicated(docs)) == {k: texts[k] for k in (0, 2, 3, 4)}
    assert own(repeats.without_repeats(docs)) == {0: texts[0], 1: "", 2: texts[2], 3: None, 4: ""}
    assert set(own(importance.resampled(docs, labels))) <= set(range(5))


def test_rows_without_an_id_draw_on_their_own(spark):
    texts = [f"text number {k}" for k in range(50)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(5, None), (5, "x")], "doc_id long, text string")
    import numpy as np

    keys = importance.weighed(docs, np.zeros(importance.N_BUCKETS), 7).collect()
    assert len({x["key"] for x in keys if x["doc_id"] is None}) == 50


def test_pipeline_keeps_columns_and_one_of_each(spark, tmp_path):
    import corpus_pipeline

    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, source)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert 0 < docs.count() < before
    rows = docs.collect()
    sets = [grams(r["text"]) for r in rows]
    assert not any(similar(a, b) for a, b in combinations(sets, 2) if a & b)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, source)
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in rows}
