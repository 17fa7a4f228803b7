"""Check SQL: gates, plan adaptation, placement, fill."""

from timelane.plans.checks import STEPS, with_steps

STEPS.update(
    k_play="""SELECT * FROM fx_assets WHERE enabled IS DISTINCT FROM false AND reaction_type NOT IN ('reference', 'background')""",
    k_react="""SELECT * FROM k_play WHERE speech_ready IS DISTINCT FROM true""",
    k_react2="""SELECT * FROM fx_assets WHERE enabled IS DISTINCT FROM false""",
    k_gate="""
SELECT job_id, j.persona, CASE WHEN NOT has_plan THEN 'no_plan'
   WHEN NOT EXISTS (SELECT 1 FROM k_react r WHERE r.persona = j.persona AND r.reaction_type = 'neutral') THEN 'no_neutral'
   WHEN voice_lipsync AND NOT EXISTS (SELECT 1 FROM k_play r WHERE r.persona = j.persona AND r.speech_ready)
        AND NOT EXISTS (SELECT 1 FROM fx_assets r WHERE r.persona = j.persona AND r.enabled IS DISTINCT FROM false AND r.reaction_type = 'reference') THEN 'no_voice_source' END AS reason
FROM fx_jobs j""",
    k_jobs="""SELECT j.* FROM fx_jobs j JOIN k_gate g ON g.job_id = j.job_id AND g.reason IS NULL""",
    k_jobs2="""SELECT j.* FROM fx_jobs j WHERE has_plan AND EXISTS (SELECT 1 FROM k_react2 r WHERE r.persona = j.persona AND r.reaction_type = 'neutral')""",
    k_fallback="""
SELECT * FROM (VALUES ('laugh',1,'smirk'),('laugh',2,'cringe'),('laugh',3,'neutral'),('disbelief',1,'cringe'),('disbelief',2,'smirk'),('disbelief',3,'neutral'),
 ('suspicious',1,'cringe'),('suspicious',2,'neutral'),('suspicious',3,'smirk'),('surprise',1,'cringe'),('surprise',2,'neutral'),('surprise',3,'smirk'),
 ('comment',1,'neutral'),('comment',2,'smirk'),('comment',3,'cringe')) AS t(requested, rank, candidate)""",
)


def _adapt(jobs: str, react: str, v4: bool, carriers: bool = True) -> dict[str, str]:
    s = "" if v4 else "2"
    voiced = "j.voice_lipsync" + (" AND EXISTS (SELECT 1 FROM k_play r WHERE r.persona = j.persona AND r.speech_ready)" if v4 else "")
    requested = "coalesce(nullif(type, ''), 'neutral')"
    return {
        f"k_num{s}": f"""
SELECT e.* REPLACE (nullif(trim(comment), '') AS comment), j.persona, j.total_ms,
       row_number() OVER (PARTITION BY e.job_id ORDER BY time_ms, event_ord) AS event_no,
       CASE WHEN {voiced} THEN greatest(0, coalesce(j.max_voice_comments, 1)) ELSE 0 END AS cap
FROM fx_events e JOIN {jobs} j ON j.job_id = e.job_id WHERE time_ms IS NOT NULL""",
        f"k_cap{s}": f"""
SELECT * REPLACE (CASE WHEN n <= cap THEN comment END AS comment), {requested} AS asked FROM (
  SELECT *, count(comment) OVER (PARTITION BY job_id ORDER BY event_no ROWS UNBOUNDED PRECEDING) AS n FROM k_num{s}) AS q""",
        f"k_req{s}": f"""SELECT *, {"CASE WHEN comment IS NULL AND asked = 'comment' THEN 'neutral' ELSE asked END" if v4 else "asked"} AS requested FROM k_cap{s}""",
        f"k_vocab{s}": f"""SELECT DISTINCT persona, reaction_type FROM {react}""",
        f"k_map{s}": f"""
SELECT p.persona, p.requested, coalesce(
   (SELECT arg_min(c.candidate, c.rank) FROM (SELECT requested AS rq, rank, candidate FROM k_fallback UNION ALL SELECT p.requested, 0, p.requested) c
     JOIN k_vocab{s} v ON v.persona = p.persona AND v.reaction_type = c.candidate WHERE c.rq = p.requested), 'neutral') AS mapped
FROM (SELECT DISTINCT persona, requested FROM k_req{s}) p""",
        f"k_adapt{s}": f"""
SELECT r.job_id, r.persona, r.total_ms, r.event_no, r.event_ord, r.time_ms, m.mapped AS type,
       CASE WHEN m.mapped <> {"coalesce(r.type, '')" if v4 else "r.asked"} THEN {"coalesce(r.type, '')" if v4 else "r.asked"} END AS mapped_from_type,
       r.intensity_m, r.duration_ms, r.comment, r.voice_ms
FROM k_req{s} r JOIN k_map{s} m ON m.persona = r.persona AND m.requested = r.requested""",
        f"k_near{s}": f"""
SELECT a.*, p.asset_id, CASE WHEN p.duration_ms > 200 THEN p.duration_ms ELSE p.probed_ms END AS clip_ms, p.peak_ms AS stored
FROM k_adapt{s} a LEFT JOIN (
  SELECT w.persona, w.type, w.at, arg_min(r, struct_pack(d := abs(coalesce(r.intensity_min_m, 0) + coalesce(r.intensity_max_m, 1000) - w.at), o := r.asset_ord)) AS pick
  FROM (SELECT DISTINCT persona, type, 2 * coalesce(intensity_m, 350) AS at FROM k_adapt{s}) w JOIN {react} r ON r.persona = w.persona AND r.reaction_type = w.type
  GROUP BY ALL) b ON b.persona = a.persona AND b.type = a.type AND b.at = 2 * coalesce(a.intensity_m, 350)
LEFT JOIN fx_assets p ON p.asset_id = b.pick.asset_id""",
    }


STEPS.update(_adapt("k_jobs", "k_react", True))
STEPS.update(_adapt("k_jobs2", "k_react2", False))
_PEAK = "CASE WHEN stored > 0 AND stored < {d} THEN stored ELSE {d} // 2 END"
_ON_CLOCK = "greatest(0, least(greatest(0, total_ms - 100), time_ms))"


def _place(s: str, length: str, target: str) -> dict[str, str]:
    # The sequential rule itself, one recursion step per event number.
    return {
        f"k_aim{s}": f"SELECT *, CAST({length} AS BIGINT) AS d, CAST({target} AS BIGINT) AS t FROM k_near{s}",
        f"k_walk{s}": f"""
SELECT job_id, CAST(0 AS BIGINT) AS event_no, CAST(0 AS BIGINT) AS start_ms, CAST(0 AS BIGINT) AS duration_ms, CAST(0 AS BIGINT) AS cur FROM (SELECT DISTINCT job_id FROM k_aim{s})
UNION ALL
SELECT a.job_id, a.event_no, greatest(a.t, w.cur + 80), least(a.d, a.total_ms - greatest(a.t, w.cur + 80)), greatest(a.t, w.cur + 80) + least(a.d, a.total_ms - greatest(a.t, w.cur + 80))
FROM k_walk{s} w JOIN k_aim{s} a ON a.job_id = w.job_id AND a.event_no = w.event_no + 1 WHERE greatest(a.t, w.cur + 80) < a.total_ms - 50""",
        f"k_placed{s}": f"""
SELECT a.job_id, a.persona, a.total_ms, a.event_no, a.time_ms, a.type, a.comment, a.voice_ms, a.asset_id,
       CASE WHEN a.comment IS NULL THEN 'reaction' ELSE 'comment' END AS kind, w.start_ms, w.duration_ms,
       {_PEAK.format(d="w.duration_ms")} AS peak_ms, w.start_ms > a.t AS pushed
FROM k_aim{s} a JOIN k_walk{s} w ON w.job_id = a.job_id AND w.event_no = a.event_no""",
        f"k_gaps{s}": f"""
SELECT job_id, persona, event_no AS gap_no, coalesce(lag(start_ms + duration_ms) OVER (PARTITION BY job_id ORDER BY event_no), 0) AS gap_start_ms, start_ms AS gap_end_ms FROM k_placed{s}
UNION ALL
SELECT j.job_id, j.persona, coalesce(n, 0) + 1, coalesce(e, 0), j.total_ms FROM k_jobs{s} j
LEFT JOIN (SELECT job_id, max(event_no) AS n, max(start_ms + duration_ms) AS e FROM k_placed{s} GROUP BY job_id) p ON p.job_id = j.job_id WHERE coalesce(e, 0) < j.total_ms""",
    }


STEPS.update(
    _place("", "CASE WHEN comment IS NULL THEN clip_ms ELSE voice_ms END", f"CASE WHEN comment IS NULL THEN time_ms - {_PEAK.format(d='clip_ms')} ELSE {_ON_CLOCK} END")
)
_V2 = "greatest(800, least(8000, coalesce(duration_ms, 2400)))"
STEPS.update(_place("2", f"CASE WHEN comment IS NULL THEN {_V2} ELSE greatest(1200, least(8000, greatest({_V2}, voice_ms + 300))) END", _ON_CLOCK))

STEPS.update(
    k_tape="""
SELECT persona, row_number() OVER (PARTITION BY persona ORDER BY asset_ord) - 1 AS pos, count(*) OVER (PARTITION BY persona) AS n, asset_id,
       CASE WHEN duration_ms > 200 THEN duration_ms ELSE probed_ms END AS clip_ms FROM k_react WHERE reaction_type = 'neutral'""",
    # One step per chunk: state is (gap, where in it, turn of the pool).  fill = 1 marks a laid chunk.
    k_gapn="""SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY gap_no) AS g FROM k_gaps""",
    k_filled="""
SELECT job_id, persona, g, gap_no, gap_start_ms AS gs, gap_end_ms AS ge, gap_start_ms AS pos_ms, CAST(0 AS BIGINT) AS turn, CAST(-1 AS BIGINT) AS chunk_no, CAST(NULL AS BIGINT) AS asset_id, CAST(0 AS BIGINT) AS dur FROM k_gapn WHERE g = 1
UNION ALL
SELECT f.job_id, f.persona, CASE WHEN f.ge - f.pos_ms > 40 THEN f.g ELSE x.g END, CASE WHEN f.ge - f.pos_ms > 40 THEN f.gap_no ELSE x.gap_no END,
       CASE WHEN f.ge - f.pos_ms > 40 THEN f.gs ELSE x.gap_start_ms END, CASE WHEN f.ge - f.pos_ms > 40 THEN f.ge ELSE x.gap_end_ms END,
       CASE WHEN f.ge - f.pos_ms > 40 THEN f.pos_ms + least(f.ge - f.pos_ms, p.clip_ms) ELSE x.gap_start_ms END,
       CASE WHEN f.ge - f.pos_ms > 40 THEN f.turn + 1 ELSE f.turn END,
       CASE WHEN f.ge - f.pos_ms > 40 THEN f.chunk_no + 1 ELSE -1 END,
       CASE WHEN f.ge - f.pos_ms > 40 THEN p.asset_id END,
       CASE WHEN f.ge - f.pos_ms > 40 THEN least(f.ge - f.pos_ms, p.clip_ms) ELSE 0 END
FROM k_filled f JOIN (SELECT DISTINCT persona, n FROM k_tape) c ON c.persona = f.persona
JOIN k_tape p ON p.persona = f.persona AND p.pos = f.turn % c.n
LEFT JOIN k_gapn x ON x.job_id = f.job_id AND x.g = f.g + 1
WHERE f.ge - f.pos_ms > 40 OR x.g IS NOT NULL""",
    k_fill="""SELECT job_id, gap_no, chunk_no, asset_id, pos_ms - dur AS start_ms, dur AS duration_ms FROM k_filled WHERE chunk_no >= 0""",
    k_tape2="""
SELECT persona, row_number() OVER (PARTITION BY persona ORDER BY asset_ord) - 1 AS pos, count(*) OVER (PARTITION BY persona) AS n, asset_id FROM k_react2 WHERE reaction_type = 'neutral'""",
    k_fill2="""
SELECT c.job_id, c.gap_no, c.k AS chunk_no, p.asset_id, c.gap_start_ms + 10500 * c.k AS start_ms, least(c.gap_end_ms - c.gap_start_ms - 10500 * c.k, 10500) AS duration_ms
FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY gap_no, k) - 1 AS turn FROM (
        SELECT *, unnest(range(0, CASE WHEN gap_end_ms - gap_start_ms > 40 THEN (gap_end_ms - gap_start_ms - 40 + 10499) // 10500 ELSE 0 END)) AS k FROM k_gaps2) AS u) c
JOIN k_tape2 p ON p.persona = c.persona AND p.pos = c.turn % p.n""",
    k_segments="""
SELECT job_id, kind, event_no, type, asset_id, start_ms, duration_ms, peak_ms FROM k_placed
UNION ALL SELECT job_id, 'neutral', NULL, 'neutral', asset_id, start_ms, duration_ms, NULL FROM k_fill""",
    k_segments2="""
SELECT job_id, kind, event_no, type, asset_id, start_ms, duration_ms, peak_ms FROM k_placed2
UNION ALL SELECT job_id, 'neutral', NULL, 'neutral', asset_id, start_ms, duration_ms, NULL FROM k_fill2""",
    k_segn="""SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_ms) AS seg_no, CAST((greatest(120, duration_ms) * 60 + 1000) // 2000 AS BIGINT) AS frames FROM k_segments""",
    k_clock="""
SELECT job_id, seg_no, start_ms, duration_ms, frames, fb AS frames_before, CAST((fb * 2000 + 30) // 60 AS BIGINT) AS realised_start_ms, CAST((fb * 2000 + 30) // 60 AS BIGINT) - start_ms AS drift_ms
FROM (SELECT *, CAST(coalesce(sum(frames) OVER (PARTITION BY job_id ORDER BY seg_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS fb FROM k_segn) AS q""",
    k_segn2="""SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_ms) AS seg_no, duration_ms * 1000 AS us FROM k_segments2""",
    k_fade2="""
SELECT *, CASE WHEN prev IS NOT NULL THEN least(160000, prev // 3, us // 3) END AS fade_us
FROM (SELECT *, lag(us) OVER (PARTITION BY job_id ORDER BY seg_no) AS prev FROM k_segn2) AS q""",
    k_lines="""SELECT job_id, persona, row_number() OVER (PARTITION BY job_id ORDER BY event_no) AS seq, voice_ms * 6 AS need_ms FROM k_cap WHERE comment IS NOT NULL
 AND EXISTS (SELECT 1 FROM k_play r WHERE r.persona = k_cap.persona AND r.speech_ready)""",
    k_bedtape="""
SELECT persona, row_number() OVER (PARTITION BY persona ORDER BY asset_ord) - 1 AS pos, count(*) OVER (PARTITION BY persona) AS n,
       CASE WHEN duration_ms > 200 THEN duration_ms ELSE probed_ms END AS clip_ms FROM k_play WHERE speech_ready""",
    k_beds="""
SELECT job_id, persona, seq, need_ms, CAST(0 AS BIGINT) AS first_index, CAST(0 AS BIGINT) AS parts, CAST(0 AS BIGINT) AS covered_ms FROM k_lines WHERE seq = 1
UNION ALL
SELECT b.job_id, b.persona, CASE WHEN more THEN b.seq ELSE x.seq END, CASE WHEN more THEN b.need_ms ELSE x.need_ms END,
       CASE WHEN more THEN b.first_index ELSE (b.first_index + b.parts) % c.n END, CASE WHEN more THEN b.parts + 1 ELSE 0 END, CASE WHEN more THEN b.covered_ms + p.clip_ms ELSE 0 END
FROM (SELECT *, covered_ms < need_ms AND parts < 24 AS more FROM k_beds) b JOIN (SELECT DISTINCT persona, n FROM k_bedtape) c ON c.persona = b.persona
JOIN k_bedtape p ON p.persona = b.persona AND p.pos = (b.first_index + b.parts) % c.n
LEFT JOIN k_lines x ON x.job_id = b.job_id AND x.seq = b.seq + 1
WHERE b.more OR x.seq IS NOT NULL""",
    k_boxes="""
SELECT label AS clip_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_no,
       CASE WHEN vec_id % 7 < 2 THEN NULL ELSE struct_pack(x1 := vec_id % 50, y1 := vec_id % 40, x2 := vec_id % 50 + 20, y2 := vec_id % 40 + 30) END AS box FROM embeddings""",
)

CHECKS = {
    "asset_catalog": "SELECT asset_id, label, 'Brand#7' AS persona FROM fx_assets WHERE persona = 'Brand#7' AND reaction_type = 'reference' AND enabled ORDER BY asset_ord LIMIT 1",
    "playable_assets": "SELECT * FROM k_play",
    "speech_carriers": "SELECT * FROM k_play WHERE speech_ready",
    "first_background": "SELECT persona, arg_min(asset_id, asset_ord) AS asset_id, arg_min(label, asset_ord) AS label FROM fx_assets WHERE enabled IS DISTINCT FROM false AND reaction_type = 'background' GROUP BY persona",
    "admission_gate": "SELECT job_id, persona, reason IS NULL AS admitted, reason FROM k_gate",
    "caption_eligibility": "SELECT job_id, dir_captions AS zone, dir_captions IS DISTINCT FROM 'none' AND has_speech IS DISTINCT FROM false AND source_has_audio AS eligible FROM fx_jobs",
    "clip_caption_language": """
SELECT doc_id AS clip_id, doc_id % 4 <> 1 OR doc_id % 8 = 1 AS eligible,
       nullif(nullif(coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN '' END, ''), CASE WHEN doc_id % 5 = 0 THEN 'unknown' WHEN doc_id % 5 = 1 THEN lang END, 'auto'), 'auto'), 'unknown') AS language_hint FROM documents""",
    "vocabulary": "SELECT persona, reaction_type FROM k_vocab",
    "vocabulary_legacy": "SELECT persona, reaction_type FROM k_vocab2",
    "order_events": "SELECT job_id, event_ord, time_ms, row_number() OVER (PARTITION BY job_id ORDER BY time_ms, event_ord) AS event_no FROM fx_events WHERE time_ms IS NOT NULL",
    "cap_comments": "SELECT job_id, event_no, event_ord, time_ms, type, comment FROM k_cap",
    "cap_comments_legacy": "SELECT job_id, event_no, event_ord, time_ms, type, comment FROM k_cap2",
    "map_reaction_type": """
SELECT q.persona, q.requested, coalesce((SELECT arg_min(c.candidate, c.rank) FROM (SELECT requested AS rq, rank, candidate FROM k_fallback UNION ALL SELECT q.requested, 0, q.requested) c
     JOIN k_vocab v ON v.persona = q.persona AND v.reaction_type = c.candidate WHERE c.rq = q.requested), 'neutral') AS mapped, q.events
FROM (SELECT j.persona, coalesce(nullif(e.type, ''), 'neutral') AS requested, count(*) AS events FROM fx_events e JOIN fx_jobs j ON j.job_id = e.job_id GROUP BY ALL) q""",
    "adapt_plan": "SELECT * FROM k_adapt",
    "adapt_plan_legacy": "SELECT * FROM k_adapt2",
    "nearest_asset": "SELECT job_id, event_no, type, asset_id, clip_ms FROM k_near",
    "nearest_asset_legacy": "SELECT job_id, event_no, type, asset_id, clip_ms FROM k_near2",
    "place_reactions": "SELECT * FROM k_placed",
    "place_reactions_legacy": "SELECT * FROM k_placed2",
    "placement_summary": "SELECT type, count(*) AS reactions, CAST(sum(duration_ms) AS BIGINT) AS planned_ms, count(*) FILTER (WHERE pushed) AS pushed, count(*) FILTER (WHERE kind = 'comment') AS comments FROM k_placed GROUP BY type",
    "fill_gaps_cyclic": "SELECT * FROM k_fill",
    "fill_gaps_fixed": "SELECT * FROM k_fill2",
    "build_timeline": "SELECT * FROM k_segments",
    "build_timeline_legacy": "SELECT * FROM k_segments2",
    "realised_clock": "SELECT * FROM k_clock",
    "clock_verdict": """
SELECT job_id, total_ms, merged_ms, total_ms - merged_ms AS shortfall_ms, CASE WHEN total_ms - merged_ms > 1000 THEN 'fail_short' WHEN total_ms - merged_ms > 5 THEN 'pad' ELSE 'trim' END AS verdict
FROM (SELECT s.job_id, j.total_ms, CAST((sum(frames) * 2000 + 30) // 60 AS BIGINT) AS merged_ms FROM k_segn s JOIN k_jobs j ON j.job_id = s.job_id GROUP BY ALL) AS q""",
    "crossfade_offsets": """
SELECT job_id, seg_no, fade_us, greatest(10000, cum - fade_us) AS offset_us FROM (
  SELECT *, CAST(sum(us - coalesce(fade_us, 0)) OVER (PARTITION BY job_id ORDER BY seg_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS cum FROM k_fade2) AS q WHERE fade_us IS NOT NULL""",
    "cover_with_cycle": "SELECT job_id, seq, need_ms, first_index, max(parts) AS parts, max(covered_ms) AS covered_ms, max(covered_ms) + 50 < need_ms AS too_short FROM k_beds GROUP BY job_id, seq, need_ms, first_index",
    "forward_fill_boxes": """
SELECT clip_id, frame_no, valid, box.x1 AS x1, box.y1 AS y1, box.x2 AS x2, box.y2 AS y2 FROM (
  SELECT clip_id, frame_no, box IS NOT NULL AS valid, last_value(box IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame_no) AS box FROM k_boxes) AS q""",
    "landing_error": """
SELECT type, count(*) AS reactions, count(*) FILTER (WHERE e > 0) AS late, count(*) FILTER (WHERE time_ms < peak_ms) AS clamped, max(abs(e)) AS max_off_ms,
       CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY abs(e)) AS BIGINT) AS p50_off_ms, CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY abs(e)) AS BIGINT) AS p95_off_ms
FROM (SELECT *, start_ms + peak_ms - time_ms AS e FROM k_placed WHERE kind = 'reaction') AS q GROUP BY type""",
    "reaction_density": """
SELECT j.job_id, j.total_ms * 40 // 1000 AS target_milli_events, coalesce(m, 0) AS planned, coalesce(n, 0) AS placed,
       coalesce(m, 0) * 1000 - j.total_ms * 40 // 1000 AS planned_over_milli, coalesce(n, 0) * 1000 - j.total_ms * 40 // 1000 AS over_milli_events
FROM k_jobs j LEFT JOIN (SELECT job_id, count(*) AS n FROM k_placed GROUP BY job_id) p ON p.job_id = j.job_id
LEFT JOIN (SELECT job_id, count(*) AS m FROM fx_events GROUP BY job_id) e ON e.job_id = j.job_id""",
    "box_coverage": "SELECT clip_id, count(box) AS valid, count(*) AS total, count(box) = 0 AS failed FROM k_boxes GROUP BY clip_id",
}


def checks() -> dict[str, str]:
    return {name: with_steps(sql) for name, sql in CHECKS.items()}
