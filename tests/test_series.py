"""Gap repair, bins, alignment and the whole recipe against plain Python."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeloom.operators.align import CELL_BINS, align_stations, order_output, time_cells, to_long, to_wide
from gaugeloom.operators.dedupe import (
    concat_order, dedupe_keep_first, duplicate_report, merge_harvests,
)
from gaugeloom.operators.gaps import gap_runs, interpolate_linear
from gaugeloom.operators.resample import bin_origin, dense_bins, repair_resample, resample_first
from gaugeloom.plans.series import harvest_series, ordered_series
from helpers import OBS, at, binned, by_key, first_of_times, obs_frame, recipe, repaired

BURSTY = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C"]),
        st.one_of(st.integers(0, 90), st.integers(0, 5000)),
        st.one_of(st.none(), st.floats(-5, 5, allow_nan=False, width=32)),
    ),
    min_size=1, max_size=60,
)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_only_the_first_null_of_a_gap_is_filled(spark):
    df = obs_frame(spark, [("A", 0, 1.0), ("A", 6, None), ("A", 12, None), ("A", 18, 4.0)])
    got = by_key(interpolate_linear(df))
    assert [got["A", at(m)] for m in (0, 6, 12, 18)] == [1.0, 2.0, None, 4.0]


def test_edges_are_never_filled(spark):
    df = obs_frame(spark, [("A", 0, None), ("A", 6, 1.0), ("A", 12, None)])
    got = by_key(interpolate_linear(df, limit=9))
    assert [got["A", at(m)] for m in (0, 6, 12)] == [None, 1.0, None]


def test_fill_is_weighted_by_time(spark):
    df = obs_frame(spark, [("A", 0, 0.0), ("A", 9, None), ("A", 12, 4.0)])
    assert by_key(interpolate_linear(df))["A", at(9)] == 3.0


@pytest.mark.parametrize("limit", [1, 2, 5])
def test_repair_crosses_block_borders(spark, limit):
    # Points hours apart, so most blocks hold one row and gaps run over many blocks.
    rng = random.Random(limit)
    rows = [("A", 150 * i, rng.choice([None, None, float(i)])) for i in range(80)]
    df = obs_frame(spark, rows)
    want = dict(repaired([(at(m), v) for _, m, v in rows], limit))
    for options in ({}, {"block_minutes": 15}, {"block_minutes": 1440}):
        got = {t: v for (_, t), v in by_key(interpolate_linear(df, limit, **options)).items()}
        assert got == want, options


def test_blocks_depend_on_the_row_alone(spark):
    from gaugeloom.operators.gaps import with_blocks

    calm = [("calm", 6 * i, float(i)) for i in range(200)]
    for rows in (calm, calm + [("hot", i / 60, 1.0) for i in range(300)]):
        blocks = with_blocks(obs_frame(spark, rows)).where("station = 'calm'")
        assert {r["count"] for r in blocks.groupBy("_block").count().collect()} == {10}


@pytest.mark.parametrize("stations", [1, 30])
def test_hot_and_equally_hot_blocks(spark, stations):
    # One station with most rows, or many bins of one size: the same path, the same answer.
    rng = random.Random(stations)
    raw = [(f"s{i % stations}", rng.randrange(600) / 10, rng.choice([None, float(i)])) for i in range(900)]
    rows = [(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)]
    want = {(s, t): v for s, p in first_of_times(rows).items() for t, v in repaired(p, 1)}
    assert by_key(interpolate_linear(dedupe_keep_first(obs_frame(spark, raw)))) == want
    assert by_key(harvest_series(obs_frame(spark, raw))) == recipe(rows)


@given(BURSTY, st.sampled_from([1, 2, 3]), st.sampled_from([2, 60]))
@FEW
def test_interpolation_matches_plain_python(spark, raw, limit, minutes):
    df = obs_frame(spark, raw)
    got = by_key(interpolate_linear(dedupe_keep_first(df), limit, minutes))
    rows = [(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)]
    want = {(s, t): v for s, p in first_of_times(rows).items() for t, v in repaired(p, limit)}
    assert got == want


@given(BURSTY)
@FEW
def test_gap_runs_match_plain_python(spark, raw):
    got = {(r["station"], r["time"]): (r["gap_id"], r["gap_pos"])
           for r in gap_runs(dedupe_keep_first(obs_frame(spark, raw)), 2).collect()}
    want = {}
    for s, points in first_of_times([(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)]).items():
        valid = run = 0
        for t, v in points:
            run = 0 if v is not None else run + 1
            valid += v is not None
            want[s, t] = (None, None) if v is not None else (valid, run)
    assert got == want


@given(BURSTY, st.sampled_from([15, 60, 7, 2880]))
@FEW
def test_recipe_matches_plain_python(spark, raw, minutes):
    rows = [(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)]
    assert by_key(harvest_series(obs_frame(spark, raw), minutes)) == recipe(rows, minutes)


@given(BURSTY)
@FEW
def test_native_recipe_matches_plain_python(spark, raw):
    rows = [(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)]
    assert by_key(harvest_series(obs_frame(spark, raw), 0)) == recipe(rows, 0)


@given(BURSTY)
@FEW
def test_fused_repair_equals_repair_then_resample(spark, raw):
    rows = dedupe_keep_first(obs_frame(spark, raw))
    fused = {k: v for k, v in by_key(repair_resample(rows, 15)).items() if v is not None}
    assert fused == by_key(resample_first(interpolate_linear(rows), 15))


def test_unique_flag_gives_the_same_answer(spark):
    df = obs_frame(spark, [("A", 6 * i, None if i % 3 == 0 else float(i)) for i in range(50)])
    for minutes in (0, 15):
        assert by_key(harvest_series(df, minutes, unique=True)) == by_key(harvest_series(df, minutes))


@pytest.mark.parametrize("seed", [1, 4, 40])
def test_hot_bins(spark, seed):
    # One row copied over and over, and one station with most of the rows.
    rng = random.Random(seed)
    raw = [("copy", 5, None)] + [("copy", 5, 1.0)] * 60 + [("copy", 22, 2.0)]
    raw += [("hot", rng.randrange(40), rng.choice([None, float(i)])) for i in range(90)]
    raw += [("calm", 33, 4.0)]
    rows = [(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)]
    assert by_key(harvest_series(obs_frame(spark, raw))) == recipe(rows)


def test_empty_bins_are_present(spark):
    df = obs_frame(spark, [("A", 3, None), ("A", 9, 5.0), ("A", 40, 7.0)])
    assert by_key(dense_bins(df)) == {
        ("A", at(0)): 5.0, ("A", at(15)): None, ("A", at(30)): 7.0}


def test_dense_bins_match_plain_python(spark):
    rng = random.Random(3)
    raw = [("A", rng.randrange(3000), rng.choice([None, 1.0, 2.0])) for _ in range(60)]
    points = first_of_times([(s, at(m), v, i) for i, (s, m, v) in enumerate(raw)])["A"]
    for minutes in (7, 15, 1440):
        got = {t: v for (_, t), v in by_key(dense_bins(dedupe_keep_first(obs_frame(spark, raw)), minutes)).items()}
        assert got == binned(points, minutes)


def test_bins_count_from_midnight_of_the_first_day(spark):
    bins = bin_origin(obs_frame(spark, [("A", 182, 1.0), ("A", 190, 1.0)]), 7).collect()
    assert [r["bin"] for r in sorted(bins, key=lambda r: r["time"])] == [at(182), at(189)]


def test_resample_zero_and_default(spark):
    df = obs_frame(spark, [("A", 3, 1.0), ("A", 5, 2.0)])
    assert resample_first(df, 0) is df
    assert by_key(resample_first(df, None)) == {("A", at(0)): 1.0}


def test_align_gives_every_station_every_time(spark):
    df = obs_frame(spark, [("A", 1, 1.0), ("A", 2, 2.0), ("B", 2, 3.0), ("B", 3, 4.0)])
    got = by_key(align_stations(df))
    assert len(got) == 6 and sum(v is None for v in got.values()) == 2


@pytest.mark.parametrize("size", [1, 3, 64])
def test_align_with_many_rosters(spark, size):
    rng = random.Random(size)
    raw = [(f"S{i}", rng.randrange(40), float(i)) for i in range(30) for _ in range(3)]
    rows = dedupe_keep_first(obs_frame(spark, raw))
    present = by_key(rows)
    got = align_stations(rows, roster_size=size).collect()
    times, stations = {t for _, t in present}, {s for s, _ in present}
    assert len(got) == len(times) * len(stations)
    assert {(r["station"], r["time"]): r["value"] for r in got} == {
        (s, t): present.get((s, t)) for s in stations for t in times}


def test_repeated_time_keeps_the_first_row_even_if_null(spark):
    df = obs_frame(spark, [("A", 1, None), ("A", 1, 3.0), ("A", 2, 4.0)])
    assert by_key(dedupe_keep_first(df)) == {("A", at(1)): None, ("A", at(2)): 4.0}
    report = duplicate_report(df).collect()[0]
    assert (report["rows_before"], report["rows_after"], report["multivalue"]) == (3, 2, True)


def test_dedupe_with_more_columns(spark):
    df = obs_frame(spark, [("A", 1, None), ("A", 1, 3.0)]).withColumn("note", F.concat(F.lit("n"), "seq"))
    row = dedupe_keep_first(df).collect()[0]
    assert (row["value"], row["seq"], row["note"]) == (None, 0, "n0")


def test_concat_order_prefers_the_earlier_part(spark):
    early = obs_frame(spark, [("A", 1, 1.0)]).withColumn("seq", F.lit(9).cast("bigint"))
    late = obs_frame(spark, [("A", 1, 2.0), ("A", 2, 3.0)])
    assert by_key(dedupe_keep_first(concat_order(early, late))) == {
        ("A", at(1)): 1.0, ("A", at(2)): 3.0}


def test_merge_keeps_what_was_seen_first(spark):
    old = obs_frame(spark, [("A", 1, None), ("A", 2, 2.0)])
    new = obs_frame(spark, [("A", 1, 9.0), ("A", 3, 3.0)])
    assert by_key(merge_harvests(old, new)) == {
        ("A", at(1)): None, ("A", at(2)): 2.0, ("A", at(3)): 3.0}


def test_wide_and_long_forms(spark):
    df = obs_frame(spark, [("A", 1, 1.0), ("B", 2, 3.0)])
    wide = to_wide(df, ["A", "B"])
    assert wide.columns == ["TIME", "A", "B"]
    rows = {(r["TIME"], r["STATION"]): r["WATER_LEVEL"] for r in to_long(wide).collect()}
    assert rows == {(at(1), "A"): 1.0, (at(1), "B"): None, (at(2), "A"): None, (at(2), "B"): 3.0}


def test_output_order_is_request_order_then_time(spark):
    df = obs_frame(spark, [("A", 2, 1.0), ("B", 1, 1.0), ("A", 1, 1.0), ("Z", 0, 1.0)])
    asked = spark.createDataFrame([(0, "B"), (1, "A")], "position int, station string")
    got = [(r["station"], r["time"]) for r in order_output(df, asked).collect()]
    assert got == [("B", at(1)), ("A", at(1)), ("A", at(2)), ("Z", at(0))]


def test_no_station_is_dropped_when_all_its_values_are_missing(spark):
    df = obs_frame(spark, [("A", 1, 1.0), ("B", 20, None)])
    got = by_key(harvest_series(df))
    assert got == {("A", at(0)): 1.0, ("A", at(15)): -99999.0,
                   ("B", at(0)): -99999.0, ("B", at(15)): -99999.0}
    assert at(15) == at(0) + timedelta(minutes=15)
    assert OBS.startswith("station")


def test_native_cells_hold_as_many_times_however_dense(spark):
    dense = [("A" if i % 2 else "B", 1 + i / 1000, float(i)) for i in range(700)]
    obs = obs_frame(spark, [*dense, *[("A", 1440 * d, 1.0) for d in range(1, 200)]])
    cells = time_cells(obs.select("time").distinct()).orderBy("time").collect()
    assert [c["_cell"] for c in cells] == [i // CELL_BINS for i in range(899)]
    got = ordered_series(obs, minutes=0).collect()
    assert [(r["station"], r["time"]) for r in got] == [(s, c["time"]) for s in "AB" for c in cells]
    assert {(r["station"], r["time"]): r["value"] for r in got} == by_key(harvest_series(obs, minutes=0))
