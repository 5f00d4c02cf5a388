"""Hand-computed shift, interval and OEE cases."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.operators.dedup import latest_per_key, without_repeated_open_runs
from millwright.operators.intervals import covered_seconds, intersect, tiles
from millwright.operators.shifts import cut_at_shifts, shift_grid, with_shifts
from millwright.plans.oee import with_oee

NIGHT = ("05:24:00", "14:00:00", "14:00:00", "22:10:00", "22:10:00", "05:24:00")
LATE = ("05:24:00", "15:40:00", "15:40:00", "00:57:01", "00:57:01", "05:24:00")
NAMES = ("ini_1_t1", "fim_1_t1", "ini_1_t2", "fim_1_t2", "ini_1_t3", "fim_1_t3")


def schedule(spark, bounds, rule="oee"):
    row = spark.range(1).select(F.lit(20).alias("id_estabelecimento"), F.lit(1).alias("id_setor"))
    row = row.withColumns({n: clock.clock_seconds(F.lit(b)) for n, b in zip(NAMES, bounds)})
    return with_shifts(row, rule)


def cut(spark, ts, start, end, bounds=NIGHT, rule="oee"):
    stops = ts([(20, 1, start, end)], "id_estabelecimento int, id_setor int, a timestamp_ntz, b timestamp_ntz")
    rows = cut_at_shifts(
        stops.join(schedule(spark, bounds, rule), ["id_estabelecimento", "id_setor"]), "a", "b", "2024-01-10", "2024-01-12"
    )
    return sorted((str(r.data_turno), r.num_turno, r.segundos) for r in rows.collect())


def test_stop_over_a_shift_change(spark, ts):
    assert cut(spark, ts, "2024-01-10 13:30:00", "2024-01-10 14:30:00") == [("2024-01-10", 1, 1800), ("2024-01-10", 2, 1800)]


def test_stop_over_midnight(spark, ts):
    assert cut(spark, ts, "2024-01-10 23:00:00", "2024-01-11 06:00:00") == [("2024-01-10", 3, 23040), ("2024-01-11", 1, 2160)]


def test_early_stop_belongs_to_the_day_before(spark, ts):
    assert cut(spark, ts, "2024-01-10 02:00:00", "2024-01-10 03:00:00") == [("2024-01-09", 3, 3600)]


def test_empty_stop_at_a_boundary(spark, ts):
    assert cut(spark, ts, "2024-01-10 14:00:00", "2024-01-10 14:00:00") == []


def test_second_boundaries_are_counted(spark, ts):
    got = cut(spark, ts, "2024-01-10 13:59:59.900", "2024-01-10 14:00:00.100")
    assert got == [("2024-01-10", 1, 1), ("2024-01-10", 2, 0)]


def test_no_schedule_no_shift(spark, ts):
    assert cut(spark, ts, "2024-01-10 13:30:00", "2024-01-10 14:30:00", (None,) * 6) == []


def test_special_third_shift(spark):
    rows = shift_grid(schedule(spark, LATE), "2024-01-10", "2024-01-10").where("data_turno = '2024-01-10'").collect()
    got = {r.num_turno: (str(r.inicio_turno), str(r.fim_turno)) for r in rows}
    assert got[2][1] == "2024-01-11 00:57:01"
    assert got[3] == ("2024-01-11 00:57:01", "2024-01-11 05:24:00")


def test_roll_rules_differ_at_midnight(spark, ts):
    bounds = ("06:00:00", "14:00:00", "14:00:00", "00:00:00", "00:00:00", "06:00:00")
    stop = ("2024-01-10 15:00:00", "2024-01-10 16:00:00")
    assert ("2024-01-10", 2, 3600) in cut(spark, ts, *stop, bounds, "oee")
    assert ("2024-01-10", 2, 3600) not in cut(spark, ts, *stop, bounds, "stop_detail")


def test_production_day(spark, ts):
    df = ts([("2024-01-10 05:23:59", 19440), ("2024-01-10 05:24:00", 19440), ("2024-01-10 02:00:00", None)], "t timestamp_ntz, i int")
    got = [str(r[0]) for r in df.select(clock.production_day(F.col("t"), F.col("i"))).collect()]
    assert got == ["2024-01-09", "2024-01-10", "2024-01-10"]


def test_hms_wraps(spark):
    got = spark.range(1).select(clock.hms(F.lit(90000)), clock.hms(F.lit(-1)), clock.hms(F.lit(1000))).first()
    assert tuple(got) == ("01:00:00", "23:59:59", "00:16:40")


def test_oee_formula(spark):
    row = spark.createDataFrame(
        [(1000, 100, 50, 25.0, 40.0, 10.0)],
        "tempo_util bigint, tempo_disp bigint, tempo_setup bigint, tempo_qual double, tempo_perf_perdas double, saldo_tc double",
    )
    got = with_oee(row).first()
    assert [float(got[c]) for c in ("pct_oee", "pct_disp", "pct_perf", "pct_qual")] == [77.5, 15.0, 5.0, 2.5]
    assert (got.tempo_util_hms, got.hrs_boas_hms) == ("00:16:40", "00:12:54")


def test_repeated_open_run_is_dropped(spark, ts):
    runs = ts(
        [(1, "p", "2024-01-10 08:00:00.200", "2024-01-10 09:00:00"), (1, "p", "2024-01-10 08:00:00.400", None), (2, "p", "2024-01-10 08:00:00.400", None)],
        "m int, p string, a timestamp_ntz, b timestamp_ntz",
    )
    kept = without_repeated_open_runs(runs, ["m", "p"], "a", "b").collect()
    assert sorted((r.m, r.b is None) for r in kept) == [(1, False), (2, True)]


def test_latest_per_key_breaks_ties(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, None, "c")]
    a = latest_per_key(spark.createDataFrame(rows, "k int, t int, v string"), ["k"], "t").collect()
    b = latest_per_key(spark.createDataFrame(rows[::-1], "k int, t int, v string"), ["k"], "t").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == [(1, 5, "a"), (2, None, "c")]


def spans(rng, n, hot):
    out = []
    for _ in range(n):
        a = rng.randrange(0, 500)
        out.append((1 if rng.random() < hot else rng.randrange(2, 6), rng.choice("xyz"), a, a + rng.randrange(0, 120)))
    return out


def test_covered_seconds_matches_pairs_under_skew(spark):
    rng = random.Random(7)
    runs, stops = spans(rng, 400, 0.5), spans(rng, 400, 0.5)
    schema = "m int, p string, ini_corte bigint, fim_corte bigint"
    got = covered_seconds(
        spark.createDataFrame(runs, schema), spark.createDataFrame(stops, schema).drop("p"), ["m"], ["m", "p"]
    ).collect()
    want = {}
    for m, p, a, b in runs:
        total, covered = want.get((m, p), (0, 0))
        hit = sum(max(0, min(b, d) - max(a, c)) for k, _, c, d in stops if k == m)
        want[m, p] = (total + b - a, covered + hit)
    assert {(r.m, r.p): (r.total, r.covered) for r in got} == want


def test_intersect_matches_pairs_across_buckets(spark, ts):
    rng = random.Random(3)

    def rows(n):
        out = []
        for i in range(n):
            a = rng.randrange(0, 5 * 86400)
            b = a + rng.randrange(0, 2 * 86400)
            out.append((1 if i % 3 else 2, i, *(str(F_EPOCH(x)) for x in (a, b))))
        return out

    def F_EPOCH(s):
        return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)

    left, right = rows(40), rows(40)
    schema = "m int, {0} int, {1}0 timestamp_ntz, {1}1 timestamp_ntz"
    got = intersect(
        ts(left, schema.format("i", "a")), ts(right, schema.format("j", "b")), ["m"], ("a0", "a1"), ("b0", "b1"), names=("c0", "c1")
    ).collect()
    want = sorted(
        (i, j, max(a0, b0), min(a1, b1)) for m, i, a0, a1 in left for k, j, b0, b1 in right if m == k and b0 <= a1 and b1 >= a0
    )
    assert sorted((r.i, r.j, str(r.c0), str(r.c1)) for r in got) == want
    more = [(2, 99, str(F_EPOCH(90 * 86400)), str(F_EPOCH(91 * 86400))), (1, 98, None, str(F_EPOCH(9))), (1, 97, str(F_EPOCH(9)), str(F_EPOCH(3)))]
    outer = intersect(
        ts(left + more, schema.format("i", "a")), ts(right, schema.format("j", "b")), ["m"], ("a0", "a1"), ("b0", "b1"), names=("c0", "c1"), how="left"
    ).collect()
    assert sorted((r.i, r.j, str(r.c0), str(r.c1)) for r in outer if r.c0 is not None) == want
    met = {i for i, *_ in want}
    assert sorted((r.i, r.c1) for r in outer if r.c0 is None) == sorted((i, None) for _, i, _, _ in left + more if i not in met)


@pytest.mark.parametrize("period", [None, ("2021-03-05 07:00:00", "2023-08-01 00:00:00")])
def test_long_intervals_meet_once(spark, ts, period):
    """Spans of minutes to a decade, one key with most rows, open ends; against all pairs."""
    rng = random.Random(11)
    first = datetime.datetime(2019, 12, 30, 23)

    def rows(n):
        out = []
        for i in range(n):
            a = first + datetime.timedelta(minutes=rng.randrange(0, 5 * 525_600))
            b = a + datetime.timedelta(minutes=rng.choice([0, 7, 1440, 8 * 1440, 64 * 1440, rng.randrange(5_000_000)]))
            out.append((1 if i % 5 else 2, i, a, None if i % 17 == 0 else b))
        return out

    left, right = rows(150), rows(150)
    schema = "m int, {0} int, {1}0 timestamp_ntz, {1}1 timestamp_ntz"

    def table(rows, names):
        return ts([(m, i, str(a), b and str(b)) for m, i, a, b in rows], schema.format(*names))

    got = intersect(table(left, "ia"), table(right, "jb"), ["m"], ("a0", "a1"), ("b0", "b1"), names=("c0", "c1"), period=period).collect()
    if period:
        low, high = map(datetime.datetime.fromisoformat, period)
        left, right = ([(m, i, max(a, low), min(b or high, high)) for m, i, a, b in x] for x in (left, right))
    want = [
        (i, j, max(a, c), min(b, d)) for m, i, a, b in left for k, j, c, d in right if m == k and None not in (b, d) and a <= b and c <= d and c <= b and d >= a
    ]
    assert sorted((r.i, r.j, r.c0, r.c1) for r in got) == sorted(want) and len(want) > 500


def test_a_run_of_years_makes_tens_of_rows(spark):
    spans = [(0, 0), (3, 5), (0, 7), (1, 4000), (-900, 3999), (7, 8), (100, 611)]
    df = spark.createDataFrame(spans, "a long, b long").select("a", "b", tiles(F.col("a"), F.col("b")).alias("t"))
    for r in df.collect():
        own = [range(t["index"] * 8**t.level, (t["index"] + 1) * 8**t.level) for t in r.t if t.own]
        assert sorted(x for tile in own for x in tile) == list(range(r.a, r.b + 1)) and len(r.t) < 60
        partly = {(k, x // 8**k) for k in range(1, 5) for x in range(r.a, r.b + 1)}
        partly = {(k, i) for k, i in partly if i * 8**k < r.a or (i + 1) * 8**k - 1 > r.b}
        assert {(t.level, t["index"]) for t in r.t if not t.own} == partly
