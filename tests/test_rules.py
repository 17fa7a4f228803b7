"""Rules on small hand-made tables, and sequential restatements of the stateful operators on random ones.

One job of every random table holds about a third of the rows.
"""

import random
import re

import pytest
from pyspark.sql import functions as F

from timelane.functions.quantiles import discrete_rank, upper_median_rank, value_at_ranks
from timelane.functions.scalars import clamp, clock, even, floor_div, half_up
from timelane.functions.skew import Limits, Run, running
from timelane.operators import adapt, captions, frames, gates, joins, logs, quality, queue, regions, timeline
from timelane.plans import render
from timelane.sources import readers, sinks

ASSETS = (
    "asset_id bigint, asset_ord bigint, persona string, reaction_type string, speech_ready boolean, enabled boolean, "
    "intensity_min_m bigint, intensity_max_m bigint, duration_ms bigint, probed_ms bigint, peak_ms bigint"
)
JOBS = (
    "job_id bigint, total_ms bigint, persona string, has_plan boolean, voice_lipsync boolean, max_voice_comments bigint"
)
EVENTS = (
    "job_id bigint, event_ord bigint, time_ms bigint, type string, intensity_m bigint, duration_ms bigint, comment string, voice_ms bigint"
)


def asset(i, kind, ready=False, enabled=True, low=None, high=None, length=2000, peak=None, persona="p"):
    return (i, i, persona, kind, ready, enabled, low, high, length, length, peak)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(params=[False, True], ids=["plain", "split"])
def split(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(Limits, "chunk_rows", 8)
    return request.param


# ---------------------------------------------------------------- scalars and order statistics

def test_scalars(spark):
    df = spark.createDataFrame([(-7,), (5,)], "v bigint").select(
        floor_div(F.col("v"), 2), even(F.col("v")), half_up(F.col("v") / 2), clamp(F.col("v"), 0, 3)
    )
    assert [tuple(r) for r in df.collect()] == [(-4, -6, -3, 0), (2, 6, 3, 3)]


def test_clamp_keeps_null(spark):
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS v").select(clamp(F.col("v"), 0, 3)).first()[0] is None


def test_clock_carries_into_the_next_unit(spark):
    df = spark.createDataFrame([(59_996,), (3_661_007,)], "ms bigint")
    assert [r[0] for r in df.select(clock(F.col("ms"), ".", 1, 2)).collect()] == ["0:01:00.00", "1:01:01.01"]
    assert [r[0] for r in df.select(clock(F.col("ms"), ",", 2, 3)).collect()] == ["00:00:59,996", "01:01:01,007"]


def test_upper_median_and_percentile(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)], "k string, v bigint")
    got = value_at_ranks(df, ["k"], "v", {"m": upper_median_rank, "p": discrete_rank(50)}, bucket=2).first()
    assert (got["n"], got["m"], got["p"]) == (4, 3, 2)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_running_values_do_not_depend_on_the_cut(spark, levels):
    rng = random.Random(levels)
    data = [(0 if i % 3 == 0 else rng.randrange(1, 9), i, rng.choice([None, rng.randrange(50)])) for i in range(400)]
    df = spark.createDataFrame(data, "k bigint, i bigint, v bigint")
    value = F.coalesce("v", F.lit(0))
    runs = [
        Run("r", "rank"), Run("s", "sum", value), Run("b", "sum_before", value), Run("m", "max", F.col("v")),
        Run("g", "lag", F.col("v")), Run("l", "last", F.col("v")),
    ]
    cuts = [[floor_div(F.col("i"), w)] for w in (100, 20, 3)][3 - levels :]
    plain = running(df, ["k"], [F.col("i")], runs)
    cut = running(df, ["k"], [F.col("i")], runs, cuts)
    # (k, i) is unique, so sorting never compares the values themselves.
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, cut.collect()))


# ---------------------------------------------------------------- catalog and gates

def test_null_enabled_is_enabled_and_ties_keep_library_order(spark):
    assets = spark.createDataFrame(
        [asset(1, "smirk", enabled=False), asset(2, "smirk", enabled=None), asset(3, "smirk"), asset(4, "reference"), asset(5, "smirk", ready=None)],
        ASSETS,
    )
    assert rows(gates.playable_assets(assets), "asset_id") == [(2,), (3,), (5,)]
    assert rows(gates.reaction_assets(assets), "asset_id") == [(2,), (3,), (5,)]
    events = spark.createDataFrame([("p", "smirk", None)], "persona string, type string, intensity_m bigint")
    assert rows(timeline.nearest_asset(events, assets), "asset_id") == [(2,)]


def test_first_failing_reason(spark):
    assets = spark.createDataFrame([asset(1, "neutral"), asset(2, "smirk", persona="q"), asset(3, "neutral", persona="r"), asset(4, "reference", persona="r")], ASSETS)
    jobs = spark.createDataFrame(
        [(1, 1, "q", False, True, None), (2, 1, "q", True, False, None), (3, 1, "p", True, True, None), (4, 1, "r", True, True, None), (5, 1, "p", True, None, None)],
        JOBS,
    )
    got = dict(rows(gates.admission_gate(jobs, assets), "job_id", "reason"))
    assert got == {1: "no_plan", 2: "no_neutral", 3: "no_voice_source", 4: None, 5: None}
    assert dict(rows(gates.admission_gate(jobs, assets, avatar_key=False), "job_id", "reason"))[4] == "no_voice_source"


def test_voice_job_with_a_still_but_no_carrier_loses_its_lines(spark):
    assets = spark.createDataFrame([asset(1, "neutral"), asset(2, "reference")], ASSETS)
    jobs = spark.createDataFrame([(1, 60000, "p", True, True, 2)], JOBS)
    events = spark.createDataFrame([(1, 1, 500, "comment", None, None, " hello ", 1000)], EVENTS)
    got = adapt.adapt_plan(events, jobs, assets).first()
    assert (got["comment"], got["type"], got["mapped_from_type"]) == (None, "neutral", "comment")


def test_missing_type_maps_from_the_empty_string(spark):
    assets = spark.createDataFrame([asset(1, "neutral")], ASSETS)
    jobs = spark.createDataFrame([(1, 60000, "p", True, False, None)], JOBS)
    events = spark.createDataFrame([(1, 1, 0, None, None, None, None, 0), (1, 2, None, "smirk", None, None, None, 0)], EVENTS)
    assert rows(adapt.adapt_plan(events, jobs, assets), "type", "mapped_from_type") == [("neutral", "")]
    assert rows(adapt.adapt_plan(events, jobs, assets, "v2"), "type", "mapped_from_type") == [("neutral", None)]


def test_adapting_twice_changes_nothing(spark):
    assets = spark.createDataFrame([asset(1, "neutral"), asset(2, "cringe")], ASSETS)
    jobs = spark.createDataFrame([(1, 60000, "p", True, False, None)], JOBS)
    kinds = ["laugh", "disbelief", "suspicious", "comment", "dance", "cringe", None]
    events = spark.createDataFrame([(1, i, i * 10, k, None, None, None, 0) for i, k in enumerate(kinds, 1)], EVENTS)
    once = adapt.adapt_plan(events, jobs, assets)
    again = adapt.adapt_plan(once.select(*[c.split()[0] for c in EVENTS.split(", ")]), jobs, assets)
    assert rows(once, "event_no", "type") == rows(again, "event_no", "type")


# ---------------------------------------------------------------- placement and fill

def placed_by_hand(events, total):
    out, cursor = [], 0
    for no, target, length in events:
        start = max(target, cursor + 80)
        if start >= total - 50:
            break
        length = min(length, total - start)
        out.append((no, start, length))
        cursor = start + length
    return out


def test_reaction_lands_on_its_moment(spark):
    """The recorded regression: an event at 4.5 s must peak at 4.5 s, not 9.4 s."""
    assets = spark.createDataFrame([asset(1, "neutral", length=4000), asset(2, "surprise", length=9800, peak=4400)], ASSETS)
    jobs = spark.createDataFrame([(1, 60000, "p", True, False, None)], JOBS)
    events = spark.createDataFrame([(1, 1, 4500, "surprise", None, None, None, 0)], EVENTS)
    got = render.planned_reactions(events, jobs, assets).first()
    assert got["start_ms"] + got["peak_ms"] == 4500


def test_placement_matches_the_sequential_rule(spark, split):
    rng = random.Random(7)
    data, want = [], []
    for job in range(30):
        total = rng.randrange(500, 60_000)
        n = 150 if job == 0 else rng.randrange(0, 12)
        times = sorted(rng.randrange(0, 60_000) for _ in range(n))
        steps = []
        for no, t in enumerate(times, 1):
            clip, peak = rng.randrange(200, 4000), rng.choice([None, 0, rng.randrange(1, 5000)])
            offset = peak if peak and peak < clip else clip // 2
            data.append((job, "p", total, no, no, t, "smirk", None, 0, 1, clip, peak, None))
            steps.append((no, t - offset, clip))
        want += [(job, *p) for p in placed_by_hand(steps, total)]
    rng.shuffle(data)
    events = spark.createDataFrame(
        data,
        "job_id bigint, persona string, total_ms bigint, event_no bigint, event_ord bigint, time_ms bigint, type string, comment string, "
        "voice_ms bigint, asset_id bigint, clip_ms bigint, stored_peak_ms bigint, duration_ms bigint",
    )
    assert rows(timeline.place_reactions(events, split=split), "job_id", "event_no", "start_ms", "duration_ms") == sorted(want)


def test_cyclic_fill_matches_the_sequential_rule(spark, split):
    rng = random.Random(11)
    lengths = {p: [rng.randrange(300, 5000) for _ in range(rng.randrange(1, 6))] for p in "abc"}
    assets, gaps, want, next_id = [], [], [], 1
    ids = {}
    for p, clips in lengths.items():
        ids[p] = []
        for c in clips:
            assets.append(asset(next_id, "neutral", length=c, persona=p))
            ids[p].append(next_id)
            next_id += 1
    for job in range(25):
        p, at, turn = rng.choice("abc"), 0, 0
        for no in range(1, (90 if job == 0 else rng.randrange(2, 9))):
            start, end = at, at + rng.choice([0, 30, 40, 41, rng.randrange(0, 40_000)])
            gaps.append((job, p, no, start, end))
            cursor, k = start, 0
            while end - cursor > 40:
                length = min(end - cursor, lengths[p][turn % len(lengths[p])])
                want.append((job, no, k, ids[p][turn % len(ids[p])], cursor, length))
                cursor, k, turn = cursor + length, k + 1, turn + 1
            at = end + 500
    rng.shuffle(gaps)
    df = spark.createDataFrame(gaps, "job_id bigint, persona string, gap_no bigint, gap_start_ms bigint, gap_end_ms bigint")
    got = timeline.fill_gaps_cyclic(df, spark.createDataFrame(assets, ASSETS), split)
    assert rows(got, "job_id", "gap_no", "chunk_no", "asset_id", "start_ms", "duration_ms") == sorted(want)


@pytest.mark.parametrize("piece_ms", [2_000, 1 << 18])
def test_pools_lie_in_pieces(spark, monkeypatch, piece_ms, split):
    monkeypatch.setattr(timeline, "TAPE_MS", piece_ms)
    assets = spark.createDataFrame([asset(i, "neutral", length=1000 + i) for i in range(1, 40)], ASSETS)
    gaps = [(1, "p", 1, 0, 3500), (1, "p", 2, 5000, 7100), *((2, "p", n, 10_000 * n, 10_000 * n + 9_000) for n in range(1, 30)), (3, "p", 1, 0, 200_000)]
    df = spark.createDataFrame(gaps, "job_id bigint, persona string, gap_no bigint, gap_start_ms bigint, gap_end_ms bigint")
    got = rows(timeline.fill_gaps_cyclic(df, assets, split), "job_id", "start_ms", "duration_ms", "asset_id")
    assert got[:7] == [(1, 0, 1001, 1), (1, 1001, 1002, 2), (1, 2003, 1003, 3), (1, 3006, 494, 4), (1, 5000, 1005, 5), (1, 6005, 1006, 6), (1, 7011, 89, 7)]
    want, turn = [], {2: 0, 3: 0}
    for job, _, _, at, end in gaps[2:]:
        while end - at > 40:
            number = turn[job] % 39 + 1
            want.append((job, at, min(end - at, 1000 + number), number))
            at, turn[job] = at + want[-1][2], turn[job] + 1
    assert got[7:] == want
    reached = timeline._with_reach(
        spark.createDataFrame([(1, "p", 0, 3500, 1)], "job_id bigint, persona string, chunk bigint, _need bigint, _needs bigint"), timeline.cycle_tape(timeline.neutral_pool(assets))
    ).first()
    assert len(reached.clips) == (6 if piece_ms == 2_000 else 39)


def test_carriers_cover_a_line_or_are_flagged(spark, split):
    assets = spark.createDataFrame([asset(1, "comment", ready=True, length=1000), asset(2, "comment", ready=True, length=1500)], ASSETS)
    lines = spark.createDataFrame([(1, "p", 1, 2500), (1, "p", 2, 900), (1, "p", 3, 40_000)], "job_id bigint, persona string, seq bigint, need_ms bigint")
    got = rows(timeline.cover_with_cycle(lines, assets, split), "seq", "first_index", "parts", "covered_ms", "too_short")
    assert got == [(1, 0, 2, 2500, False), (2, 0, 1, 1000, False), (3, 1, 24, 30_000, True)]


def test_timeline_covers_the_job_without_overlap(spark):
    rng = random.Random(3)
    assets = spark.createDataFrame(
        [asset(1, "neutral", length=3000), asset(2, "neutral", length=700), asset(3, "smirk", length=2500, peak=900), asset(4, "cringe", length=1800)], ASSETS
    )
    jobs = spark.createDataFrame([(j, rng.randrange(300, 50_000), "p", True, False, None) for j in range(20)], JOBS)
    events = spark.createDataFrame(
        [(j, i, rng.randrange(0, 50_000), rng.choice(["smirk", "cringe", "laugh"]), None, None, None, 0) for j in range(20) for i in range(1, rng.randrange(2, 9))], EVENTS
    )
    totals = {r["job_id"]: r["total_ms"] for r in jobs.collect()}
    for dialect in ("v4", "v2"):
        by_job = {}
        for job, start, length in rows(render.build_timeline(events, jobs, assets, dialect), "job_id", "start_ms", "duration_ms"):
            by_job.setdefault(job, []).append((start, length))
        assert set(by_job) == set(totals)
        for job, segments in by_job.items():
            cursor = 0
            for start, length in segments:
                assert 0 <= start - cursor <= 40
                cursor = start + length
            assert 0 <= totals[job] - cursor <= 50


# ---------------------------------------------------------------- captions

def lines_by_hand(words, dialect):
    out, current = [], []
    for w in words:
        if dialect == "lines":
            if current and (len(current) >= 5 or w[3] - current[0][2] > 2400 or w[2] - current[-1][3] > 700):
                out.append(current)
                current = []
            current.append(w)
        else:
            current.append(w)
            if len(current) >= 5 or w[3] - current[0][2] >= 2400:
                out.append(current)
                current = []
    if current:
        out.append(current)
    hold = (lambda g: max(g[-1][3], g[0][2] + 500)) if dialect == "lines" else (lambda g: g[-1][3])
    return [(g[0][0], len(g), g[0][2], hold(g), " ".join(w[1] for w in g)) for g in out]


@pytest.mark.parametrize("dialect", ["lines", "cues"])
def test_captions_match_the_sequential_rule(spark, split, dialect):
    rng = random.Random(5)
    data, want = [], []
    for job in range(20):
        at, words = 0, []
        for ord_ in range(1, (400 if job == 0 else rng.randrange(2, 60))):
            at += rng.choice([10, 60, 450, 701, 900, 700])
            length = rng.choice([5, 200, 600, 1100, 2400])
            words.append((ord_, f"w{ord_}", at, at + length))
            at += length
        data += [(job, *w) for w in words]
        want += [(job, *line) for line in lines_by_hand(words, dialect)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "job_id bigint, ord bigint, text string, start_ms bigint, end_ms bigint")
    op = captions.caption_lines if dialect == "lines" else captions.caption_cues
    assert rows(op(df, split), "job_id", "first_ord", "words", "start_ms", "end_ms", "text") == sorted(want)


def test_caption_parts_put_together_are_one_document(spark, monkeypatch):
    lines = spark.createDataFrame([(1, i, 1, i * 1000, i * 1000 + 500, f"a\nb{i}") for i in range(1, 6)], "job_id bigint, first_ord bigint, words bigint, start_ms bigint, end_ms bigint, text string")
    whole = captions.export_captions(lines, "srt").first()["document"]
    monkeypatch.setattr(captions, "PART_CUES", 2)
    parts = sorted(captions.export_captions(lines, "srt", split=True).collect(), key=lambda r: r["part"])
    assert len(parts) == 3 and "".join(r["document"] for r in parts) == whole
    assert whole.startswith("1\n00:00:01,000 --> 00:00:01,500\na\nb1\n\n2\n")


# ---------------------------------------------------------------- frames and regions

def test_ladder_takes_the_first_clean_threshold(spark):
    """Measured example: the subject survives whole from 0.07 on, and the plate comes back at 0.05."""
    subject = [0, 0, 0, 0, 60, 60, 60, 230, 230, 255, 255, 255, 255, 255]
    plate = [0] * 11 + [200] * 3
    cells = [(1, 63, 154, 63, plate)] * 25 + [(1, 20, 20, 20, subject)] * 10
    scored = spark.createDataFrame(cells, "clip_id bigint, r bigint, g bigint, b bigint, alphas array<bigint>")
    colours = frames.plate_colour(scored)
    assert colours.first()["hex"] == "3f9a3f"
    got = frames.threshold_ladder(scored, colours).first()
    assert (got["similarity_milli"], got["calibrated"], got["subject_cells"], got["plate_cells"]) == (70, True, 10, 25)
    dull = [(1, 63, 154, 63, [9] * 14)] * 25 + [(1, 20, 20, 20, list(range(14)))] * 10
    got = frames.threshold_ladder(spark.createDataFrame(dull, scored.schema), colours).first()
    assert (got["similarity_milli"], got["calibrated"]) == (240, False)


def test_loop_takes_first_maximum_and_first_minimum(spark):
    grids = [[0, 0], [4, 0], [4, 0], [1, 0], [2, 0], [1, 0]]
    df = spark.createDataFrame([(1, i, g) for i, g in enumerate(grids)], "clip_id bigint, frame_no bigint, grid array<int>")
    got = frames.frame_loop(df, F.lit(False), 25).first()
    assert (got["peak_frame"], got["loop_frame"], got["noise4"], got["peak_ms"]) == (1, 3, 8, 80)
    assert frames.frame_loop(df, F.lit(True), 25).first()["peak_frame"] == 5


def test_empty_plate_gives_the_whole_frame(spark):
    cells = spark.createDataFrame([(1, x, 200 if y == 0 else 0) for x in range(8) for y in range(8)], "clip_id bigint, x int, alpha int")
    assert tuple(frames.subject_bounds(cells, ["clip_id"], 8, 772).first()) == (1, 0, 772)


def test_region_follows_sample_order_whatever_the_row_order(spark):
    rng = random.Random(2)
    dets = [(1, i % 7, i, 4000 + rng.randrange(300), 3000 + rng.randrange(300), 900, 900) for i in range(60)]
    dets += [(1, i % 7, i, rng.randrange(9000), rng.randrange(9000), 500, 500) for i in range(60, 90)]
    dets += [(2, 0, 1, 10, 10, 10, 10)]
    schema = "video_id bigint, sample_no bigint, det_no bigint, x bigint, y bigint, w bigint, h bigint"
    first = rows(regions.stable_region(spark.createDataFrame(dets, schema), 1920, 1080), "video_id", "hits", "detected", "px", "py")
    rng.shuffle(dets)
    again = rows(regions.stable_region(spark.createDataFrame(dets, schema), 1920, 1080), "video_id", "hits", "detected", "px", "py")
    clusters = []
    for _, _, _, x, y, w, h in sorted(d for d in dets if d[0] == 1):
        cx, cy = (x + w / 2) / 10000, (y + h / 2) / 10000
        near = [(((cx - c[0] / c[2]) ** 2 + (cy - c[1] / c[2]) ** 2) ** 0.5, i) for i, c in enumerate(clusters)]
        near = [n for n in near if n[0] < 0.16]
        if near:
            c = clusters[min(near)[1]]
            c[0] += cx
            c[1] += cy
            c[2] += 1
        else:
            clusters.append([cx, cy, 1])
    assert first == again
    assert first[0][1] == max(c[2] for c in clusters) and first[1][2] is False


# ---------------------------------------------------------------- lookups, quality, logs

def test_length_choice_takes_the_first_of_equals(spark):
    model = joins.MODEL_PRICES[5][0]
    asked = spark.createDataFrame([(1, model, "fal", 5), (2, model, "fal", 10), (3, "new", "openrouter", 5)], "request_no bigint, model string, backend string, requested_s bigint")
    assert rows(joins.spec_cost(asked), "request_no", "chosen_s", "unit_micro") == [(1, 4, 150_000), (2, 8, 150_000), (3, 5, 126_000)]


def test_markers_must_occur_exactly_once(spark):
    docs = spark.createDataFrame([(1, "aXbXc"), (2, "aX"), (3, "b")], "id bigint, body string")
    got = joins.marker_audit(docs, "id", "body", [("x", "X", "needed")])
    assert rows(got, "id", "found", "verdict") == [(1, 2, "ambiguous"), (3, 0, "missing")]


def test_loudness_takes_the_last_reading(spark):
    logs_df = spark.createDataFrame([(1, "I: -20.0 LUFS .. I: -9.5 LUFS"), (2, "none"), (3, "I: -50 LUFS")], "job_id bigint, log string")
    assert rows(quality.loudness_gain(logs_df), "job_id", "gain_db") == [(1, -3.5), (2, 0.0), (3, 18.0)]


def test_attempts_stay_blocked_once_blocked(spark):
    data = [(1, 1, 1, "HTTP Error 429"), (1, 2, 1, "boom"), (2, 1, 1, "Too many requests"), (2, 2, 0, ""), (3, 1, 1, "boom")]
    df = spark.createDataFrame(data, "request_id bigint, attempt bigint, exit_code int, log string")
    assert rows(logs.classify_attempts(df), "request_id", "exit_code") == [(1, 42), (2, 0), (3, 1)]


def test_end_of_a_job_is_absorbing(spark):
    data = [(1, 10, 1, "a", "rendering", {"x": "1"}), (1, 20, 2, "done", "completed", {"y": "2"}), (1, 30, 3, "late", "failed", {"x": "9"})]
    df = spark.createDataFrame(data, "job_id bigint, at_us bigint, seq bigint, stage string, status string, patch map<string,string>")
    got = logs.job_state(df).first()
    assert (got["stage"], got["status"], got["reports"], got["meta"]) == ("done", "completed", 2, {"x": "1", "y": "2"})


def test_drain_sessions_end_at_their_cap(spark, split):
    minute = 60_000_000
    # 50 dense claims of one worker, 8 after a gap, one more; two claims of another at one time.
    claims = [(1, i * minute, i) for i in range(50)] + [(1, (200 + i) * minute, 100 + i) for i in range(8)] + [(1, 300 * minute, 200), (2, 0, 1), (2, 0, 2)]
    found = rows(queue.drain_sessions(spark.createDataFrame(claims[::-1], "worker bigint, at_us bigint, seq bigint"), split), "worker", "session_no", "start_us", "last_us", "claims", "ended_by")
    dense = [(1, k + 1, 8 * k * minute, (8 * k + 7) * minute, 8, "cap") for k in range(6)] + [(1, 7, 48 * minute, 49 * minute, 2, "empty_queue")]
    assert found == [*dense, (1, 8, 200 * minute, 207 * minute, 8, "cap"), (1, 9, 300 * minute, 300 * minute, 1, "empty_queue"), (2, 1, 0, 0, 2, "empty_queue")]


def test_global_rank_needs_no_common_task(spark):
    data = [(i, "queued", f"2024-01-0{1 + i % 3} 00:00:0{i % 2}") for i in range(50)] + [(99, "failed", "2020-01-01 00:00:00")]
    df = spark.createDataFrame(data, "job_id bigint, status string, t string").select("job_id", "status", F.to_timestamp("t").alias("created_at"))
    want = {j: r for r, (_, j) in enumerate(sorted((t, i) for i, s, t in data if s == "queued"), 1)}
    got = queue.drain_batches(df)
    assert {r["job_id"]: r["rank"] for r in got.collect()} == want
    assert got.agg(F.max("run_no")).first()[0] == 7


# ---------------------------------------------------------------- sources and sinks

def test_times_that_are_no_numbers_are_dropped(spark):
    text = '{"provider":"p","language":"en","words":[{"text":" a ","start":"0.5","end":1},{"text":" ","start":0,"end":1},{"text":"b","start":"x","end":2},{"text":"c","start":1,"end":"Infinity"},{"text":"d","start":2,"end":2.5}]}'
    df = spark.createDataFrame([(1, text), (2, '{"provider":"p"}')], "job_id bigint, document string")
    assert rows(readers.read_transcripts(df), "ord", "text", "start_ms", "end_ms") == [(1, "a", 500, 1000), (2, "d", 2000, 2500)]


def test_plan_must_be_an_object(spark):
    docs = ['{"job":{"id":1,"reaction_plan":{"events":[{"time":1.5,"type":"smirk"}]}}}', '{"job":{"id":2}}', '{"job":{"id":3,"reaction_plan":{}}}']
    got = readers.read_jobs(spark.createDataFrame([(d,) for d in docs], "document string"))
    assert rows(got, "job_id", "has_plan", "event_ord", "time_ms") == [(1, True, 1, 1500), (2, False, None, None), (3, True, None, None)]


def test_job_documents_are_read_whole(spark):
    docs = [
        '{"job":{"id":"7d0c-a","reaction_plan":{"events":[{"time":"3.5","type":"smirk","intensity":0.25,"duration":"2.4"},{"time":"x","comment":"c"}]}},"assets":[{"id":"a-1","reaction_type":"neutral","enabled":true,"intensity_min":"0.1","extra":{"k":1}},{"id":2,"enabled":null}]}',
        '{"job":{"id":"7d0c-b","reaction_plan":{"events":[{"time":1,"duration":3}]}}}',
        '{"job":{"id":12},"assets":[]}',
    ]
    documents = spark.createDataFrame([(d,) for d in docs], "document string")
    got = readers.read_jobs(documents).orderBy("job_ref", "event_ord").select("job_id", "job_ref", "event_ord", "time_ms", "intensity_m", "duration_ms", "comment")
    assert [tuple(r) for r in got.collect()] == [(12, "12", None, None, None, None, None), (None, "7d0c-a", 1, 3500, 250, 2400, None), (None, "7d0c-a", 2, None, None, None, "c"), (None, "7d0c-b", 1, 1000, None, 3000, None)]
    offered = readers.read_job_assets(documents).orderBy("asset_ord").select("job_ref", "asset_ord", "asset_ref", "reaction_type", "enabled", "intensity_min_m", F.get_json_object("asset", "$.extra.k"))
    assert [tuple(r) for r in offered.collect()] == [("7d0c-a", 1, "a-1", "neutral", True, 100, "1"), ("7d0c-a", 2, "2", None, None, None, None)]


def test_every_clip_is_registered_or_refused(spark):
    clips = spark.createDataFrame(
        [(1, "p", "smirk_a", "m", "fal", 2100, ("pingpong", 900)), (2, "p", "nope", "m", "fal", 2100, ("pingpong", 900)), (3, "p", None, "m", "fal", 2100, None)],
        "asset_id bigint, persona string, preset string, model string, backend string, stored_ms bigint, loop struct<mode string, peak_ms bigint>",
    )
    assert rows(sinks.register_assets(clips), "asset_id") == [(1,)]
    assert rows(sinks.refused_clips(clips), "asset_id", "stored_ms", "reason") == [(2, 2100, "unknown preset nope"), (3, 2100, "unknown preset NULL")]


def test_partial_frame_is_dropped(spark):
    df = spark.createDataFrame([(1, list(range(10)))], "clip_id bigint, bytes array<int>")
    got = readers.explode_frames(df, 2, 2)
    assert got.count() == 8 and got.agg(F.max("frame_no")).first()[0] == 1


def test_results_are_appended_under_their_keys(spark, tmp_path):
    writes = spark.createDataFrame([(1, 10, 1, False), (1, 11, 2, False), (1, 12, 3, True), (2, 13, 4, True)], "job_id bigint, render_id bigint, written_at bigint, immutable boolean")
    path = str(tmp_path / "results")
    sinks.write_results(writes.limit(2), path)
    sinks.write_results(writes.filter("render_id >= 12"), path)
    back = spark.read.parquet(path)
    assert back.count() == 4
    assert rows(queue.overwrite_audit(back.drop("key", "bucket")), "key", "writes", "latest_render") == [("results/1.mp4", 2, 11)]
    one = sinks.read_results(spark, path, 1)
    assert re.search(r"PartitionFilters: \[.*bucket", one._jdf.queryExecution().executedPlan().toString())
    assert rows(one, "job_id", "render_id") == [(1, 10), (1, 11), (1, 12)]
    assert sinks.read_results(spark, path).count() == 4


def test_results_of_one_job_are_many_files(spark, tmp_path):
    n = F.col("id")
    writes = spark.range(2000).select(F.when(n < 1800, 1).otherwise(n).cast("bigint").alias("job_id"), n.alias("render_id"), n.alias("written_at"), F.lit(True).alias("immutable"))
    path = str(tmp_path / "results")
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        sinks.write_results(writes, path, buckets=4, file_rows=200)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    back = spark.read.parquet(path)
    files = back.withColumn("file", F.input_file_name()).groupBy("bucket", "file").count().groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).collect()
    assert back.count() == 2000 and max(f["n"] for f in files) >= 6 and max(f["most"] for f in files) < 500


def test_clips_without_a_box_fail(spark):
    frames = spark.createDataFrame([(1, 0, None), (1, 1, 5), (2, 0, None)], "clip_id bigint, frame_no bigint, box bigint")
    assert rows(timeline.box_coverage(frames), "clip_id", "valid", "total", "failed") == [(1, 1, 2, False), (2, 0, 1, True)]


def test_assets_of_any_shape(spark):
    docs = ['{"job":{"id":1},"assets":"none"}', '{"job":{"id":2},"assets":[null,3,{"id":{"a":1},"enabled":"maybe","metadata":[1]}]}', "no json", None]
    got = readers.read_job_assets(spark.createDataFrame([(d,) for d in docs], "document string"))
    assert rows(got, "job_id", "asset_ord", "asset_ref", "enabled", "metadata") == [(2, 1, None, None, None), (2, 2, None, None, None), (2, 3, '{"a":1}', None, "[1]")]


def test_new_clips_start_disabled(spark):
    clips = spark.createDataFrame(
        [(1, "p", "smirk_a", "m", "fal", 2100, ("pingpong", 900)), (2, "p", "nope", "m", "fal", 2100, ("pingpong", 900))],
        "asset_id bigint, persona string, preset string, model string, backend string, stored_ms bigint, loop struct<mode string, peak_ms bigint>",
    )
    got = sinks.register_assets(clips)
    assert rows(got, "asset_id", "reaction_type", "enabled", "speech_ready", "anchor_role") == [(1, "smirk", False, False, "none")]
    catalog = spark.createDataFrame([asset(9, "neutral")], ASSETS)
    assert gates.playable_assets(sinks.append_assets(catalog, got)).count() == 1


def test_caption_rows_are_written_in_order(spark, tmp_path):
    data = [(j, c, f"{j}-{c}") for j in range(5) for c in range(1, 30)]
    random.Random(1).shuffle(data)
    sinks.write_caption_rows(spark.createDataFrame(data, "job_id bigint, cue bigint, row string"), str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == len(data)
