"""Check SQL: documents, sinks, quality, queue, logs, caches, progress."""

from timelane.plans import checks_media  # noqa: F401  (shares its steps)
from timelane.plans.checks import STEPS, with_steps

STEPS.update(
    o_rects="""
SELECT job_id, x >= 0 AND y >= 0 AND w > 0 AND h > 0 AND x + w <= 1001 AND y + h <= 1001 AS fits,
       2 * CAST(floor(CAST(greatest(0, least(1000, x)) * 1080 AS DOUBLE) / 1000 / 2 + 0.5) AS BIGINT) AS px, 2 * CAST(floor(CAST(greatest(0, least(1000, y)) * 1920 AS DOUBLE) / 1000 / 2 + 0.5) AS BIGINT) AS py,
       2 * CAST(floor(CAST(greatest(160, least(1000, w)) * 1080 AS DOUBLE) / 1000 / 2 + 0.5) AS BIGINT) AS pw0, 2 * CAST(floor(CAST(greatest(120, least(460, h)) * 1920 AS DOUBLE) / 1000 / 2 + 0.5) AS BIGINT) AS ph0
FROM (SELECT o_orderkey AS job_id, o_orderkey * 37 % 1000 - 20 AS x, o_orderkey * 53 % 900 AS y, o_orderkey * 29 % 700 - 10 AS w, o_orderkey * 31 % 600 AS h FROM orders) AS q""",
    o_qc="""
SELECT p.job_id, CASE WHEN NOT has_video THEN 'no_video' WHEN width <> 1080 OR height <> 1920 THEN 'wrong_size' WHEN abs(duration_ms - expected_ms) > 350 THEN 'duration_mismatch'
  WHEN source_has_audio AND NOT has_audio THEN 'audio_missing' WHEN source_has_audio AND audio_ms < expected_ms - 500 THEN 'audio_ends_early' ELSE 'passed' END AS verdict,
  CASE WHEN has_video AND width = 1080 AND height = 1920 THEN 'passed' ELSE 'wrong_size' END AS clip_verdict
FROM fx_probes p JOIN fx_jobs j ON j.job_id = p.job_id""",
    o_gain=r"""
SELECT job_id, x AS loudness_lufs, CASE WHEN x IS NULL THEN 0 ELSE round(greatest(-6, least(18, -13 - x)), 2) END AS gain_db FROM (
  SELECT job_id, TRY_CAST(regexp_extract_all(log, 'I:\s*(-?[\d.]+)\s*LUFS', 1)[-1] AS DOUBLE) AS x FROM fx_loudness) AS q""",
    o_delivery="""
SELECT job_id, kbps, CASE WHEN bytes > 48234496 THEN CAST(floor(CAST(kbps * 82 AS DOUBLE) / 100 + 0.5) AS BIGINT) END AS retry_kbps,
       CASE WHEN bytes <= 48234496 THEN 'delivered' WHEN bytes * 85 // 100 > 48234496 THEN 'too_large' ELSE 'delivered_on_retry' END AS outcome
FROM (SELECT *, CAST(greatest(1500, least(12000, floor(CAST(48234496 * 8 * 0.94 AS DOUBLE) / greatest(1000, duration_ms)) - 160)) AS BIGINT) AS kbps FROM fx_probes) AS q""",
    o_progress="SELECT job_id, seq, epoch_us(ts) AS at_us, stage, status, CAST(json_extract_string(patch, '$.k') AS VARCHAR) AS k FROM fx_progress",
    o_live="""
SELECT p.* FROM o_progress p JOIN (SELECT job_id, min(struct_pack(a := at_us, s := seq)) FILTER (WHERE status IN ('completed', 'failed')) AS e FROM o_progress GROUP BY job_id) t ON t.job_id = p.job_id
WHERE e IS NULL OR struct_pack(a := at_us, s := seq) <= e""",
    o_cache="SELECT request_no, sha1(concat(model, '::', image, '::', audio, '::', prompt)) AS cache_key, seconds FROM fx_cache",
    o_hits="SELECT request_no, cache_key, n > 1 AS hit, CASE WHEN n > 1 THEN seconds * 112000 ELSE 0 END AS saved_micro FROM (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY request_no) AS n FROM o_cache) AS q",
    o_sessions="""
SELECT worker, session_no, min(at_us) AS start_us, max(at_us) AS last_us, count(*) AS claims, CASE WHEN count(*) >= 8 THEN 'cap' ELSE 'empty_queue' END AS ended_by FROM (
  SELECT *, CAST(sum(CASE WHEN (place - 1) % 8 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY worker ORDER BY at_us, seq) AS BIGINT) AS session_no FROM (
    SELECT *, row_number() OVER (PARTITION BY worker, gap_no ORDER BY at_us, seq) AS place FROM (
      SELECT *, sum(CASE WHEN prev IS NULL OR at_us - prev >= 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY worker ORDER BY at_us, seq) AS gap_no FROM (
        SELECT *, lag(at_us) OVER (PARTITION BY worker ORDER BY at_us, seq) AS prev FROM fx_claims) AS a) AS b) AS c) AS d GROUP BY worker, session_no""",
    o_requests="""
SELECT request_no, at_us, sha1(concat(model, '::', image, '::', audio, '::', prompt)) AS cache_key FROM fx_requests
WHERE at_us <= (SELECT max(at_us) // 1000 - 28800000 FROM fx_requests) * 1000""",
    o_passed="""
SELECT cache_key, min(struct_pack(a := at_us, n := request_no)) AS p FROM o_requests GROUP BY cache_key
UNION ALL
SELECT r.cache_key, min(struct_pack(a := r.at_us, n := r.request_no)) AS p
FROM o_passed JOIN o_requests r ON r.cache_key = o_passed.cache_key AND r.at_us >= o_passed.p.a + 21600000000 GROUP BY r.cache_key, o_passed.p""",
    o_stalled="""
SELECT job_id, kind, first_us, deadline_us FROM (
  SELECT *, first_us + CASE kind WHEN 'avatar' THEN 900 WHEN 'lipsync' THEN 600 WHEN 'generation' THEN 1200 ELSE 1500 END * 1000000 AS deadline_us FROM (
    SELECT job_id, CASE job_id % 4 WHEN 0 THEN 'avatar' WHEN 1 THEN 'lipsync' WHEN 2 THEN 'generation' ELSE 'kernel' END AS kind, min(at_us) AS first_us, min(at_us) FILTER (WHERE status IN ('completed', 'failed')) AS ended FROM o_progress GROUP BY job_id) AS a) AS b
WHERE deadline_us < (SELECT max(at_us) FROM o_progress) AND (ended IS NULL OR ended > deadline_us)""",
)

_PRESETS = [
    ("Neutral A", "neutral", 10), ("Neutral B", "neutral", 10), ("Smirk A", "smirk", 5), ("Cringe A", "cringe", 5), ("Disbelief A", "disbelief", 5), ("Surprise A", "surprise", 5),
    ("Suspicious A", "suspicious", 5), ("Smirk B", "smirk", 5), ("Cringe B", "cringe", 5), ("Surprise B", "surprise", 5), ("Disbelief B", "disbelief", 5), ("Laugh A", "laugh", 5),
]

CHECKS = {
    "read_jobs": """
SELECT CASE WHEN job_id % 9 <> 0 THEN job_id END AS job_id, CASE WHEN job_id % 9 = 0 THEN concat('job-', job_id) ELSE CAST(job_id AS VARCHAR) END AS job_ref, status, has_plan, i + 1 AS event_ord,
       CASE WHEN (job_id + i) % 7 <> 0 THEN (job_id * 131 + i * 9973) % 90000 END AS time_ms, CASE WHEN (job_id + i) % 4 <> 0 THEN concat('type-', (job_id + i) % 4) END AS type,
       CASE WHEN (job_id + i) % 5 <> 0 THEN (job_id * 37 + i * 211) % 1001 END AS intensity_m, CASE WHEN (job_id + i) % 6 > 1 THEN (job_id * 53 + i * 400) % 8000 END AS duration_ms,
       CASE WHEN (job_id + i) % 3 = 0 THEN concat(' line ', i) END AS comment
FROM fx_jobs LEFT JOIN (VALUES (0), (1), (2), (3)) AS t(i) ON has_plan AND i < job_id % 5""",
    "read_job_assets": """
SELECT CASE WHEN job_id % 9 <> 0 THEN job_id END AS job_id, CASE WHEN job_id % 9 = 0 THEN concat('job-', job_id) ELSE CAST(job_id AS VARCHAR) END AS job_ref, i + 1 AS asset_ord,
       CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE concat('a-', k) END AS asset_ref, persona, CASE WHEN k % 5 <> 0 THEN 'neutral' END AS reaction_type, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS enabled,
       CASE WHEN k % 4 <> 0 THEN k % 1001 END AS intensity_min_m, CASE k % 7 WHEN 0 THEN '{"loop":[1,2]}' WHEN 1 THEN '"none"' END AS metadata
FROM (SELECT *, job_id * 2 + i AS k FROM fx_jobs JOIN (VALUES (0), (1)) AS t(i) ON i < job_id % 4 AND job_id % 4 < 3) AS q""",
    "read_transcripts": """
SELECT job_id, 'local' AS provider, role AS language, row_number() OVER (PARTITION BY job_id ORDER BY pos) AS ord, word AS text, (pos - 1) * 300 AS start_ms, (pos - 1) * 300 + 240 AS end_ms
FROM (SELECT conv_id * 1000 + turn AS job_id, role, u.word AS word, u.pos AS pos FROM conversations, LATERAL unnest(string_split(conversations.text, ' ')) WITH ORDINALITY AS u(word, pos)) AS q
WHERE trim(word) <> '' AND (pos - 1) % 11 NOT IN (3, 5)""",
    "read_probes": """
SELECT job_id, has_video, CASE WHEN has_video THEN width END AS width, CASE WHEN has_video THEN height END AS height, CASE WHEN has_video THEN 'h264' END AS video_codec, d AS duration_ms, has_audio,
       CASE WHEN has_audio THEN 'aac' END AS audio_codec, CASE WHEN has_audio THEN CASE WHEN job_id % 4 <> 0 THEN audio_ms ELSE d END END AS audio_ms
FROM (SELECT *, CASE WHEN job_id % 13 <> 0 THEN duration_ms ELSE 0 END AS d FROM fx_probes) AS q""",
    "overwrite_audit": """
SELECT job_id, key, count(*) AS writes, arg_max(render_id, struct_pack(a := ts, b := render_id)) AS latest_render FROM (
  SELECT user_id AS job_id, event_id AS render_id, ts, CASE WHEN event_id % 3 <> 0 THEN concat('results/', user_id, '/', event_id, '.mp4') ELSE concat('results/', user_id, '.mp4') END AS key FROM events) AS q GROUP BY job_id, key HAVING count(*) > 1""",
    "write_results": """
SELECT job_id, count(*) AS renders, count(DISTINCT key) AS keys, arg_max(render_id, struct_pack(a := ts, b := render_id)) AS latest_render, arg_max(key, struct_pack(a := ts, b := render_id)) AS latest_key FROM (
  SELECT user_id AS job_id, event_id AS render_id, ts, CASE WHEN event_id % 3 <> 0 THEN concat('results/', user_id, '/', event_id, '.mp4') ELSE concat('results/', user_id, '.mp4') END AS key FROM events) AS q GROUP BY job_id""",
    "register_assets": """
SELECT p_partkey AS asset_id, p_brand AS persona, rt AS reaction_type, t.label, concat('assets/', p_brand, '/', p_partkey, '/', lower(replace(t.label, ' ', '_')), '.mp4') AS storage_path, 2000 + p_size * 100 AS duration_ms,
       false AS speech_ready, CASE WHEN rt = 'neutral' THEN 'neutral' ELSE 'none' END AS anchor_role, false AS enabled, s.model AS generated_by,
       CASE WHEN s.i = 5 THEN CASE WHEN t.sec = 10 THEN 8 ELSE 4 END ELSE t.sec END AS requested_duration_s, CASE WHEN s.i = 5 THEN CASE WHEN t.sec = 10 THEN 8 ELSE 4 END ELSE t.sec END * s.price AS cost_micro, 700 + p_size * 40 AS peak_ms
FROM part JOIN (VALUES """ + ",".join(f"({i},'{l}','{r}',{s})" for i, (l, r, s) in enumerate(_PRESETS)) + """) AS t(k, label, rt, sec) ON t.k = p_partkey % 13 JOIN m_specs s ON s.i = p_partkey % 8""",
    "loudness_gain": "SELECT * FROM o_gain",
    "render_qc": "SELECT * FROM o_qc",
    "render_qc_rates": "SELECT coalesce(verdict, 'all') AS verdict, count(*) AS renders FROM o_qc GROUP BY ROLLUP (verdict)",
    "replacement_rect": """
SELECT job_id, CASE WHEN NOT fits THEN 'invalid' WHEN pw < 120 OR ph < 120 THEN 'too_small' ELSE 'ok' END AS verdict, CASE WHEN fits THEN px END AS px, CASE WHEN fits THEN py END AS py, CASE WHEN fits THEN pw END AS pw, CASE WHEN fits THEN ph END AS ph
FROM (SELECT *, least(pw0, 1080 - px) AS pw, least(ph0, 1920 - py) AS ph FROM o_rects) AS q""",
    "delivery_budget": "SELECT * FROM o_delivery",
    "render_summary": """
SELECT j.job_id, j.total_ms AS duration_ms, coalesce(ev.n, 0) AS event_count, coalesce(sg.n, 0) AS segment_count, coalesce(sg.c, 0) AS comment_count, coalesce(cl.n, 0) AS caption_lines, coalesce(cl.w, 0) AS caption_words,
       cm.first_comment, CASE WHEN cm.job_id IS NULL THEN NULL WHEN j.job_id % 2 = 0 THEN 'fal' WHEN j.job_id % 3 = 0 THEN 'kaggle' END AS lipsync_provider, coalesce(cm.comments, '') AS comments,
       l.avatar, CASE WHEN j.job_id % 13 = 0 THEN 'localized_source_replacement' ELSE l.layout_source END AS layout_source, l.crop_x, l.crop_width, q.verdict AS validation,
       p.bytes AS result_bytes, d.kbps AS delivery_kbps, d.outcome, g.loudness_lufs AS voice_loudness_lufs, g.gain_db AS voice_gain_db
FROM k_jobs j
LEFT JOIN (SELECT job_id, count(*) AS n FROM fx_events WHERE time_ms IS NOT NULL GROUP BY job_id) ev ON ev.job_id = j.job_id
LEFT JOIN (SELECT job_id, count(*) AS n, count(*) FILTER (WHERE kind = 'comment') AS c FROM k_segments GROUP BY job_id) sg ON sg.job_id = j.job_id
LEFT JOIN (SELECT job_id, count(*) AS n, CAST(sum(words) AS BIGINT) AS w FROM m_lines GROUP BY job_id) cl ON cl.job_id = j.job_id
LEFT JOIN (SELECT job_id, arg_min(comment, start_ms) AS first_comment, string_agg(concat(start_ms, '|', duration_ms, '|', comment), ';' ORDER BY start_ms) AS comments FROM k_placed WHERE kind = 'comment' GROUP BY job_id) cm ON cm.job_id = j.job_id
LEFT JOIN m_layout l ON l.job_id = j.job_id LEFT JOIN o_qc q ON q.job_id = j.job_id LEFT JOIN fx_probes p ON p.job_id = j.job_id
LEFT JOIN o_delivery d ON d.job_id = j.job_id LEFT JOIN o_gain g ON g.job_id = j.job_id""",
    "claim_order": "SELECT job_id, persona FROM fx_jobs WHERE status = 'queued' ORDER BY created_at, job_id LIMIT 1",
    "drain_batches": "SELECT job_id, rank, (rank + 7) // 8 AS run_no FROM (SELECT job_id, row_number() OVER (ORDER BY created_at, job_id) AS rank FROM fx_jobs WHERE status = 'queued') AS q",
    "preferred_artifact": """
SELECT job_id, f.name AS name, f.size AS size FROM (SELECT job_id, arg_min(struct_pack(name := name, size := size), struct_pack(a := CASE WHEN size > 1024 THEN CASE name WHEN 'source.mp4' THEN 1 WHEN 'source.mkv' THEN 2 WHEN 'source.webm' THEN 3 WHEN 'source.mov' THEN 4 ELSE 5 END ELSE 5 END, b := name, c := mtime_ms, d := size)) AS f
FROM fx_files WHERE name LIKE 'source.%' GROUP BY job_id) AS q""",
    "newest_result": """
SELECT job_id, f.folder AS folder, f.name AS name, f.mtime_ms AS mtime_ms FROM (SELECT job_id, arg_max(struct_pack(folder := folder, name := name, mtime_ms := mtime_ms), struct_pack(a := folder = 'results', b := mtime_ms, c := name, d := size)) AS f FROM fx_files GROUP BY job_id) AS q""",
    "requeue": """
SELECT job_id, CASE WHEN a THEN 'queued' ELSE status END AS status, CASE WHEN a THEN 'render_requeued_v4' WHEN job_id % 3 = 0 THEN 'compositing' ELSE 'result_uploading' END AS current_stage,
       CASE WHEN NOT a AND job_id % 5 = 0 THEN concat('failed at ', job_id) END AS error, CASE WHEN NOT a THEN concat('results/', job_id, '.mp4') END AS result_path,
       CASE WHEN NOT a THEN CAST(epoch(created_at) AS BIGINT) END AS started_at, CASE WHEN a THEN 1700000000 ELSE 0 END AS updated_at
FROM (SELECT *, status = 'rendering' AND job_id % 2 = 0 AS a FROM fx_jobs) AS q""",
    "schedule_gaps": """
SELECT event_type, count(*) AS gaps, list_sort(list(gap))[count(*) // 2 + 1] AS median_us, min(gap) AS min_us, max(gap) AS max_us, count(*) FILTER (WHERE gap > 300000000) AS late
FROM (SELECT event_type, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id)) AS gap FROM events) AS q WHERE gap IS NOT NULL GROUP BY event_type""",
    "drain_sessions": "SELECT * FROM o_sessions",
    "classify_attempts": """
SELECT request_id, count(*) AS attempts, min(attempt) FILTER (WHERE exit_code = 0) AS succeeded_at,
       CASE WHEN count(*) FILTER (WHERE exit_code = 0) > 0 THEN 0 WHEN count(*) FILTER (WHERE exit_code <> 0 AND (log LIKE '%429%' OR log LIKE '%not a bot%')) > 0 THEN 42 ELSE 1 END AS exit_code FROM fx_attempts GROUP BY request_id""",
    "classify_status": """
SELECT ref, CASE WHEN regexp_matches(lower(text), 'complete|success') THEN 'complete' WHEN regexp_matches(lower(text), 'error|failed|cancel') THEN 'failed' ELSE 'pending' END AS state, 'polling' AS provider_state,
       CASE WHEN ref % 3 = 0 THEN regexp_extract(push_log, '(owner-[0-9]+/lip_[0-9]+)', 1) WHEN ref % 3 = 1 THEN regexp_extract(push_log, '(me[0-9]+/lip.sync)', 1) END AS kernel FROM fx_statuses""",
    "cache_lookup": "SELECT * FROM o_hits",
    "cache_savings": "SELECT hit, count(*) AS requests, CAST(sum(saved_micro) AS BIGINT) AS saved_micro FROM o_hits GROUP BY hit",
    "download_cache": """
SELECT concat(sha1(url), CASE WHEN page_id % 3 = 0 THEN '.png' ELSE '.mp4' END) AS cache_key, count(*) AS asked, count(*) - 1 AS hits
FROM events JOIN pages ON page_id = event_id % 50 GROUP BY ALL""",
    "error_digest": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY failures DESC, message) AS rank FROM (
  SELECT concat('attempt ', attempt) AS stage, concat(log, ' host ', request_id % 7) AS message, count(*) AS failures FROM fx_attempts WHERE exit_code <> 0 GROUP BY ALL) AS a) AS b WHERE rank <= 3""",
    "job_state": """
SELECT job_id, arg_max(stage, struct_pack(a := at_us, s := seq)) AS stage, arg_max(status, struct_pack(a := at_us, s := seq)) AS status, count(*) AS reports, arg_max(k, struct_pack(a := at_us, s := seq)) AS k FROM o_live GROUP BY job_id""",
    "stage_durations": """
SELECT stage, count(*) AS reports, CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY ms) AS BIGINT) AS p50_ms, CAST(percentile_disc(0.95) WITHIN GROUP (ORDER BY ms) AS BIGINT) AS p95_ms FROM (
  SELECT stage, (lead(at_us) OVER (PARTITION BY job_id ORDER BY at_us, seq) - at_us) // 1000 AS ms FROM o_progress) AS q WHERE ms IS NOT NULL GROUP BY stage""",
    "stage_counts": "SELECT at_us // 300000000 * 300 AS window_start_s, stage, count(*) AS reports FROM o_progress GROUP BY ALL",
    "stalled_jobs": "SELECT * FROM o_stalled",
    # Streams: windows, sessions and requests behind the watermark (one, two, eight hours) are not emitted.
    "job_state_stream": """
SELECT job_id, arg_max(stage, struct_pack(a := at_us, s := seq)) AS stage, arg_max(status, struct_pack(a := at_us, s := seq)) AS status, count(*) AS reports, arg_max(k, struct_pack(a := at_us, s := seq)) AS k FROM o_live GROUP BY job_id""",
    "stage_counts_stream": """
SELECT * FROM (SELECT at_us // 300000000 * 300 AS window_start_s, stage, count(*) AS reports FROM o_progress GROUP BY ALL) AS q
WHERE (window_start_s + 300) * 1000 <= (SELECT max(at_us) // 1000 - 3600000 FROM o_progress)""",
    "cache_dedup_stream": "SELECT cache_key, p.n AS request_no, p.a AS at_us FROM o_passed",
    "stalled_jobs_stream": "SELECT * FROM o_stalled WHERE deadline_us // 1000 < (SELECT max(at_us) // 1000 - 3600000 FROM o_progress)",
    # A run of eight is known once the watermark has passed it, any other once the gap after it has gone by.
    "drain_sessions_stream": """
SELECT worker, start_us, last_us, claims, ended_by FROM o_sessions
WHERE last_us + CASE ended_by WHEN 'cap' THEN 0 ELSE 3600000000 END <= (SELECT max(at_us) // 1000 - 7200000 FROM fx_claims) * 1000""",
}


def checks() -> dict[str, str]:
    return {name: with_steps(sql) for name, sql in CHECKS.items()}
