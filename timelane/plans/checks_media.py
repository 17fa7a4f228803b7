"""Check SQL: prices, windows, markers, layout, captions, frame grids, regions."""

from timelane.plans import checks_timeline  # noqa: F401  (shares its steps)
from timelane.plans.checks import STEPS, with_steps

_LADDER = (240, 200, 170, 150, 130, 110, 100, 90, 80, 70, 60, 50, 45, 40)
_HALF_UP = "CAST(floor({} + 0.5) AS BIGINT)"


def _half(text: str) -> str:
    return _HALF_UP.format(text)


STEPS.update(
    m_specs="""
SELECT * FROM (VALUES (0,'fal-ai/kling-video/v3/standard/image-to-video',84000),(1,'fal-ai/kling-video/v3/pro/image-to-video',112000),(2,'fal-ai/kling-video/o1/standard/image-to-video',84000),
 (3,'bytedance/seedance-2.0/image-to-video',240000),(4,'fal-ai/bytedance/seedance/v1/pro/image-to-video',50000),(5,'fal-ai/veo3.1/fast/first-last-frame-to-video',150000),(6,'fal-ai/wan-flf2v',20000),(7,'unlisted/model',112000)) AS t(i, model, price)""",
    m_cost="""
SELECT *, chosen_s * unit_micro AS cost_micro FROM (
  SELECT event_id AS request_no, model, CASE WHEN event_id % 5 = 0 THEN 'openrouter' ELSE 'fal' END AS backend,
         CASE WHEN i = 5 THEN CASE WHEN 3 + event_id % 8 <= 5 THEN 4 WHEN 3 + event_id % 8 <= 7 THEN 6 ELSE 8 END ELSE 3 + event_id % 8 END AS chosen_s,
         CASE WHEN event_id % 5 = 0 THEN 126000 ELSE price END AS unit_micro
  FROM events JOIN m_specs ON i = event_id % 8) AS q""",
    m_windows="""
SELECT *, CASE WHEN end_ms IS NULL OR end_ms <= start_ms THEN 'invalid_range' WHEN end_ms - start_ms < 15000 OR end_ms - start_ms > 90010 THEN 'length_contract' END AS reason FROM (
  SELECT candidate_id, job_id, coalesce(plan_start_ms, clip_start_ms) AS start_ms, coalesce(plan_end_ms, clip_end_ms) AS end_ms FROM fx_candidates) AS q""",
    m_layout="""
SELECT *, banded_to AS banded, CASE WHEN is_band OR avatar IN ('bottom_left', 'top_left') THEN 0 ELSE 1080 - 772 END AS avatar_x, CASE WHEN is_top THEN 0 ELSE 1920 - h END AS avatar_y,
       CASE WHEN NOT is_band THEN 0 END AS crop_x, CASE WHEN NOT is_band THEN 772 END AS crop_width, 1920 - h AS source_height,
       CASE WHEN banded_to THEN CASE WHEN CASE WHEN is_band THEN is_top ELSE source_shift = 'down' END THEN h ELSE 0 END END AS source_y,
       CASE WHEN CASE WHEN is_band THEN NOT is_top ELSE source_shift = 'up' END THEN 1920 - h ELSE 0 END AS plate_y,
       CASE WHEN captions = 'top' THEN 8 ELSE 2 END AS caption_alignment, CASE WHEN coalesce(captions = 'top', false) = is_top THEN h + 40 ELSE 120 END AS caption_margin
FROM (SELECT *, avatar LIKE '%band' AS is_band, avatar LIKE 'top%' AS is_top, CASE WHEN avatar LIKE '%band' THEN 608 ELSE 434 END AS h, avatar LIKE '%band' OR source_shift <> 'none' AS banded_to FROM (
  SELECT job_id, dir_captions AS captions, CASE WHEN wants AND NOT has_plate AND NOT forced THEN 'bottom_right' ELSE asked END AS avatar,
         CASE WHEN wants AND NOT has_plate AND NOT forced THEN 'none' ELSE shift END AS source_shift, wants AND has_plate AS plate, CASE WHEN forced THEN 'operator_override' ELSE 'director' END AS layout_source
  FROM (SELECT *, CASE WHEN NOT forced THEN dir_shift WHEN asked = 'top_band' THEN 'down' WHEN asked = 'bottom_band' THEN 'up' WHEN asked LIKE 'top%' AND dir_shift = 'none' THEN 'down' ELSE dir_shift END AS shift,
               CASE WHEN NOT forced THEN dir_plate WHEN ovr_background = 'on' THEN true WHEN ovr_background = 'off' THEN false ELSE asked LIKE 'top%' END AS wants
        FROM (SELECT *, ovr IS NOT NULL OR ovr_background <> 'auto' AS forced, coalesce(ovr, dir_avatar) AS asked FROM (
          SELECT *, CASE WHEN ovr_avatar IN ('bottom_right', 'bottom_left', 'top_right', 'top_left', 'top_band', 'bottom_band') THEN ovr_avatar END AS ovr,
                 EXISTS (SELECT 1 FROM fx_assets a WHERE a.persona = j.persona AND a.enabled IS DISTINCT FROM false AND a.reaction_type = 'background') AS has_plate FROM fx_jobs j) AS a) AS b) AS c) AS d) AS e""",
    m_linewalk="""
SELECT job_id, ord, ord AS first_ord, start_ms AS line_start, end_ms AS last_end, CAST(1 AS BIGINT) AS n, text FROM fx_words WHERE ord = 1
UNION ALL
SELECT w.job_id, w.ord, CASE WHEN brk THEN w.ord ELSE first_ord END, CASE WHEN brk THEN w.start_ms ELSE line_start END, w.end_ms, CASE WHEN brk THEN 1 ELSE n + 1 END, CASE WHEN brk THEN w.text ELSE concat(l_text, ' ', w.text) END
FROM (SELECT w.*, l.first_ord, l.line_start, l.n, l.text AS l_text, l.n >= 5 OR w.end_ms - l.line_start > 2400 OR w.start_ms - l.last_end > 700 AS brk
      FROM m_linewalk l JOIN fx_words w ON w.job_id = l.job_id AND w.ord = l.ord + 1) AS w""",
    m_lines="""
SELECT job_id, first_ord, max(n) AS words, any_value(line_start) AS start_ms, greatest(max(last_end), any_value(line_start) + 500) AS end_ms, arg_max(text, ord) AS text FROM m_linewalk GROUP BY job_id, first_ord""",
    m_cuewalk="""
SELECT job_id, ord, ord AS first_ord, start_ms AS line_start, end_ms AS last_end, CAST(1 AS BIGINT) AS n, text FROM fx_words WHERE ord = 1
UNION ALL
SELECT w.job_id, w.ord, CASE WHEN brk THEN w.ord ELSE first_ord END, CASE WHEN brk THEN w.start_ms ELSE line_start END, w.end_ms, CASE WHEN brk THEN 1 ELSE n + 1 END,
       CASE WHEN brk THEN CASE WHEN trim(w.text) = '' THEN '' ELSE w.text END WHEN trim(w.text) = '' THEN l_text WHEN l_text = '' THEN w.text ELSE concat(l_text, ' ', w.text) END
FROM (SELECT w.*, l.first_ord, l.line_start, l.n, l.text AS l_text, l.n >= 5 OR l.last_end - l.line_start >= 2400 AS brk
      FROM m_cuewalk l JOIN fx_words w ON w.job_id = l.job_id AND w.ord = l.ord + 1) AS w""",
    m_cues="""
SELECT job_id, first_ord, max(n) AS words, any_value(line_start) AS start_ms, max(last_end) AS end_ms, arg_max(text, ord) AS text FROM m_cuewalk GROUP BY job_id, first_ord""",
    m_green="SELECT * FROM fx_cells WHERE g > r + 12 AND g > b + 12",
    m_plate="""
SELECT *, lower(concat(lpad(hex(r), 2, '0'), lpad(hex(g), 2, '0'), lpad(hex(b), 2, '0'))) AS hex FROM (
  SELECT clip_id, CAST(list_sort(list(r))[n // 2 + 1] AS BIGINT) AS r, CAST(list_sort(list(g))[n // 2 + 1] AS BIGINT) AS g, CAST(list_sort(list(b))[n // 2 + 1] AS BIGINT) AS b, n AS plate_cells
  FROM m_green JOIN (SELECT clip_id AS c, count(*) AS n FROM m_green GROUP BY 1) ON c = clip_id GROUP BY clip_id, n) AS q WHERE plate_cells >= 20""",
    m_plate_take="""
SELECT *, lower(concat(lpad(hex(r), 2, '0'), lpad(hex(g), 2, '0'), lpad(hex(b), 2, '0'))) AS hex FROM (
  SELECT clip_id, take, CAST(list_sort(list(r))[n // 2 + 1] AS BIGINT) AS r, CAST(list_sort(list(g))[n // 2 + 1] AS BIGINT) AS g, CAST(list_sort(list(b))[n // 2 + 1] AS BIGINT) AS b, n AS plate_cells
  FROM (SELECT *, frame_no // 10 AS take FROM m_green) JOIN (SELECT clip_id AS c, frame_no // 10 AS f, count(*) AS n FROM m_green GROUP BY 1, 2) ON c = clip_id AND f = take GROUP BY clip_id, take, n) AS q WHERE plate_cells >= 20""",
    m_ladder="SELECT * FROM (VALUES " + ",".join(f"({i + 1},{v})" for i, v in enumerate(_LADDER)) + ") AS t(ord, similarity)",
    m_scored="""
SELECT c.clip_id, l.ord, l.similarity, least(255, c.v * l.ord) AS alpha,
       CASE WHEN d > 4900 THEN 's' WHEN d < 484 THEN 'p' END AS side
FROM (SELECT c.*, (c.r - p.r) * (c.r - p.r) + (c.g - p.g) * (c.g - p.g) + (c.b - p.b) * (c.b - p.b) AS d FROM fx_cells c JOIN m_plate p ON p.clip_id = c.clip_id) AS c, m_ladder l""",
    m_rungs="""
SELECT clip_id, ord, similarity, coalesce(sum(alpha) FILTER (WHERE side = 's'), 0) AS sa, coalesce(sum(alpha) FILTER (WHERE side = 'p'), 0) AS pa, count(*) FILTER (WHERE side = 's') AS sn, count(*) FILTER (WHERE side = 'p') AS pn
FROM m_scored GROUP BY clip_id, ord, similarity""",
    m_motion="""
SELECT *, max(deviation) OVER (PARTITION BY clip_id) AS peak_deviation, max(mean) OVER (PARTITION BY clip_id) AS peak_mean FROM (
  SELECT clip_id, cell, x, y, count(*) AS frames, CAST(sum(v) AS DOUBLE) / count(*) AS mean, sqrt(CAST(count(*) * sum(CAST(v AS BIGINT) * v) - sum(v) * sum(v) AS DOUBLE)) / count(*) AS deviation
  FROM fx_cells GROUP BY clip_id, cell, x, y) AS q QUALIFY min(frames) OVER (PARTITION BY clip_id) >= 4 AND max(deviation) OVER (PARTITION BY clip_id) >= 1.5""",
    m_block="""
SELECT clip_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM m_motion WHERE mean >= greatest(3.0, peak_mean * 0.25) GROUP BY clip_id""",
    m_gather="""
SELECT b.clip_id, x0, x1, y0, y1, any_value(m.peak_deviation) AS peak_deviation, count(*) FILTER (WHERE mv) AS k, sum(w) FILTER (WHERE mv) AS w,
       sum(w * x) FILTER (WHERE mv) AS wx, sum(w * y) FILTER (WHERE mv) AS wy, sum(w * x * x) FILTER (WHERE mv) AS wxx, sum(w * y * y) FILTER (WHERE mv) AS wyy
FROM m_block b JOIN (SELECT *, CAST(floor(deviation * 1000000 + 0.5) AS BIGINT) AS w FROM m_motion) m ON m.clip_id = b.clip_id,
     LATERAL (SELECT x BETWEEN x0 AND x1 AND y >= y0 + (y1 - y0 + 1) * 0.5 AND y <= y1 AND deviation >= greatest(1.2, m.peak_deviation * 0.30) AS mv) AS f
GROUP BY b.clip_id, x0, x1, y0, y1""",
    m_located="""
SELECT *, x1 - x0 + 1 AS bw, y1 - y0 + 1 AS bh,
  CASE WHEN k >= 3 THEN (CAST(wx AS DOUBLE) / w + 0.5) * 240 ELSE (x0 + (x1 - x0 + 1) * 0.47 + 0.5) * 240 END AS cx,
  CASE WHEN k >= 3 THEN (CAST(wy AS DOUBLE) / w + 0.5) * 136 ELSE (y0 + (y1 - y0 + 1) * 0.76 + 0.5) * 136 END AS cy,
  CASE WHEN k >= 3 THEN sqrt(greatest(0.0, CAST(wxx AS DOUBLE) / w - (CAST(wx AS DOUBLE) / w) * (CAST(wx AS DOUBLE) / w))) * 240 ELSE (x1 - x0 + 1) * 0.13 * 240 END AS sx,
  CASE WHEN k >= 3 THEN sqrt(greatest(0.0, CAST(wyy AS DOUBLE) / w - (CAST(wy AS DOUBLE) / w) * (CAST(wy AS DOUBLE) / w))) * 136 ELSE (y1 - y0 + 1) * 0.10 * 136 END AS sy
FROM m_gather""",
    m_sized="""
SELECT *, greatest(2, 2 * CAST(floor(greatest(86.4, least(201.6, greatest(sx * 1.9, bw * 240 * 0.20))) * 2 / 2 + 0.5) AS BIGINT)) AS pw,
          greatest(2, 2 * CAST(floor(greatest(59.84, least(141.44, greatest(sy * 1.9, bh * 136 * 0.14))) * 2 / 2 + 0.5) AS BIGINT)) AS ph FROM m_located""",
    m_corner="""
SELECT *, greatest(2, 2 * CAST(floor(greatest(0.0, least(1920.0 - pw, cx - pw / 2)) / 2 + 0.5) AS BIGINT)) AS px, greatest(2, 2 * CAST(floor(greatest(0.0, least(1088.0 - ph, cy - ph / 2)) / 2 + 0.5) AS BIGINT)) AS py FROM m_sized""",
    m_dist="""
SELECT a.clip_id, a.frame_no, sum(abs(a.v - z.v)) AS d, sum(abs(a.v - p.v)) AS step FROM fx_cells a
JOIN fx_cells z ON z.clip_id = a.clip_id AND z.cell = a.cell AND z.frame_no = 0
LEFT JOIN fx_cells p ON p.clip_id = a.clip_id AND p.cell = a.cell AND p.frame_no = a.frame_no - 1 GROUP BY ALL""",
    m_loop="""
SELECT clip_id, n AS frames, CASE WHEN clip_id % 4 = 0 THEN n - 1 ELSE pk.i END AS peak_frame, CASE WHEN clip_id % 4 = 0 THEN 0 ELSE pk.d END AS peak_difference, lp.i AS loop_frame, lp.d AS loop_difference, noise4
FROM (SELECT clip_id, n, arg_max(struct_pack(d := d, i := frame_no), struct_pack(d := d, i := -frame_no)) FILTER (WHERE frame_no >= 1) AS pk,
             arg_min(struct_pack(d := d, i := frame_no), struct_pack(d := d, i := frame_no)) FILTER (WHERE frame_no >= n * 45 // 100) AS lp,
             sum(step) FILTER (WHERE frame_no BETWEEN 1 AND 4) AS noise4
      FROM (SELECT *, count(*) OVER (PARTITION BY clip_id) AS n FROM m_dist) AS q GROUP BY clip_id, n) AS r""",
    m_dets="""
SELECT *, 2 * x + w AS cx, 2 * y + h AS cy, row_number() OVER (PARTITION BY video_id ORDER BY sample_no, det_no) AS o FROM fx_detections WHERE w * h BETWEEN 100000 AND 18000000""",
    # One recursion step per detection; the state is the list of clusters.
    m_clwalk="""
SELECT video_id, o, [struct_pack(sx := CAST(cx AS BIGINT), sy := CAST(cy AS BIGINT), n := CAST(1 AS BIGINT), x := CAST(x AS BIGINT), y := CAST(y AS BIGINT), w := CAST(w AS BIGINT), h := CAST(h AS BIGINT), a := CAST(w * h AS BIGINT))] AS cl FROM m_dets WHERE o = 1
UNION ALL
SELECT video_id, o, CASE WHEN best IS NULL THEN list_append(cl, struct_pack(sx := CAST(cx AS BIGINT), sy := CAST(cy AS BIGINT), n := CAST(1 AS BIGINT), x := CAST(x AS BIGINT), y := CAST(y AS BIGINT), w := CAST(w AS BIGINT), h := CAST(h AS BIGINT), a := CAST(w * h AS BIGINT)))
  ELSE list_transform(cl, lambda c, i: CASE WHEN i = best THEN struct_pack(sx := c.sx + cx, sy := c.sy + cy, n := c.n + 1, x := c.x + q.x, y := c.y + q.y, w := c.w + q.w, h := c.h + q.h, a := c.a + q.w * q.h) ELSE c END) END
FROM (SELECT *, CASE WHEN list_min(ds) < 10240000 THEN list_position(ds, list_min(ds)) END AS best FROM (
  SELECT d.*, c.cl, list_transform(c.cl, lambda k: (d.cx - CAST(k.sx AS DOUBLE) / k.n) * (d.cx - CAST(k.sx AS DOUBLE) / k.n) + (d.cy - CAST(k.sy AS DOUBLE) / k.n) * (d.cy - CAST(k.sy AS DOUBLE) / k.n)) AS ds
  FROM m_clwalk c JOIN m_dets d ON d.video_id = c.video_id AND d.o = c.o + 1) AS p) AS q""",
    m_region="""
SELECT video_id, len(cl) AS clusters, c.n AS hits, c.* FROM (
  SELECT video_id, cl, list_reverse_sort(list_transform(cl, lambda k, i: struct_pack(n := k.n, a := CAST(k.a AS DOUBLE) / k.n, i := -i)))[1] AS top FROM m_clwalk QUALIFY o = max(o) OVER (PARTITION BY video_id)) AS q, LATERAL (SELECT unnest([cl[-top.i]]) AS c) AS u""",
    m_crop="""
SELECT *, greatest(0.0, least(1 - cw, greatest(cw / 2, least(1 - cw / 2, mx + mw / 2)) - cw / 2)) AS ox, greatest(0.0, least(1 - ch, greatest(ch / 2, least(1 - ch / 2, my + mh / 2)) - ch / 2)) AS oy FROM (
  SELECT *, greatest(0.20, least(0.48, mw * 3.2)) AS cw, greatest(0.20, least(0.52, mh * 3.6)) AS ch FROM (
    SELECT video_id, clusters, hits, CAST(x AS DOUBLE) / hits / 10000 AS mx, CAST(y AS DOUBLE) / hits / 10000 AS my, CAST(w AS DOUBLE) / hits / 10000 AS mw, CAST(h AS DOUBLE) / hits / 10000 AS mh FROM m_region) AS a) AS b""",
    m_fifth=f"""
SELECT video_id, clusters, hits, {_half("least(1.0, CAST(hits AS DOUBLE) / CAST(4.8999999999999995 AS DOUBLE)) * 1000")} AS confidence_milli, CAST(hits AS DOUBLE) / 4.9 >= 0.35 AS detected,
       {_half("ox * 100000")} AS x, {_half("oy * 100000")} AS y, {_half("cw * 100000")} AS w, {_half("ch * 100000")} AS h FROM m_crop""",
    m_pixels=f"""
SELECT *, greatest(2, least(1920 - px, {_half("CAST(w AS DOUBLE) / 100000 * 1920")})) AS pw, greatest(2, least(1080 - py, {_half("CAST(h AS DOUBLE) / 100000 * 1080")})) AS ph FROM (
  SELECT *, greatest(0, {_half("CAST(x AS DOUBLE) / 100000 * 1920")}) AS px, greatest(0, {_half("CAST(y AS DOUBLE) / 100000 * 1080")}) AS py FROM m_fifth) AS q""",
)
_STAMP = "concat(lpad(CAST({c} // 3600000 AS VARCHAR), 2, '0'), ':', lpad(CAST({c} % 3600000 // 60000 AS VARCHAR), 2, '0'), ':', lpad(CAST({c} % 60000 // 1000 AS VARCHAR), 2, '0'), ',', lpad(CAST({c} % 1000 AS VARCHAR), 3, '0'))"
_CENTI = "concat(CAST(({c} + 5) // 10 // 360000 AS VARCHAR), ':', lpad(CAST(({c} + 5) // 10 % 360000 // 6000 AS VARCHAR), 2, '0'), ':', lpad(CAST(({c} + 5) // 10 % 6000 // 100 AS VARCHAR), 2, '0'), '.', lpad(CAST(({c} + 5) // 10 % 100 AS VARCHAR), 2, '0'))"
_HEADER = (
    "[Script Info]\nScriptType: v4.00+\nPlayResX: 1080\nPlayResY: 1920\nWrapStyle: 2\n\n[V4+ Styles]\n"
    "Format: Name, Fontname, Fontsize, PrimaryColour, OutlineColour, BackColour, Bold, Italic, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding\n"
    "Style: Caption,DejaVu Sans,64,&H00FFFFFF,&H00000000,&H00000000,1,0,1,5,2,"
)
_EVENTS = "\n\n[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text\n"
_MARKERS = [
    ("navigation", "<nav>", "a page without navigation is a fragment"),
    ("script", "<script>", "the tracker must be present once"),
    ("tracker", "track(0);", "the first tracker must run once"),
    ("canonical link", 'rel="canonical"', "copies must name their origin"),
]

CHECKS = {
    "spec_cost": "SELECT request_no, model, backend, chosen_s, unit_micro, cost_micro FROM m_cost",
    "spec_cost_by_model": "SELECT model, backend, count(*) AS requests, CAST(sum(chosen_s) AS BIGINT) AS seconds, CAST(sum(cost_micro) AS BIGINT) AS cost_micro FROM m_cost GROUP BY model, backend",
    "window_contract": "SELECT * FROM m_windows",
    "slice_window": """
SELECT c.candidate_id, c.job_id, w.ord, w.text, w.start_ms - c.start_ms AS start_ms, w.end_ms - c.start_ms AS end_ms
FROM m_windows c JOIN fx_words w ON w.job_id = c.job_id AND w.start_ms >= c.start_ms AND w.end_ms <= c.end_ms WHERE c.reason IS NULL""",
    "marker_audit": "SELECT page_id, label, why, found, CASE WHEN found = 0 THEN 'missing' ELSE 'ambiguous' END AS verdict FROM ("
    + " UNION ALL ".join(
        f"SELECT page_id, '{label}' AS label, '{why}' AS why, len(string_split(html, '{needle}')) - 1 AS found FROM pages" for label, needle, why in _MARKERS
    )
    + ") AS q WHERE found <> 1",
    "layout_plan": "SELECT job_id, captions, avatar, source_shift, plate, layout_source, banded, avatar_x, avatar_y, h AS avatar_height, crop_x, crop_width, source_height, source_y, plate_y, caption_alignment, caption_margin FROM m_layout",
    "caption_lines": "SELECT * FROM m_lines",
    "caption_cues": "SELECT * FROM m_cues",
    "export_captions_srt": f"""
SELECT job_id, (cue - 1) // 4096 AS part, string_agg(concat(CAST(cue AS VARCHAR), '\n', {_STAMP.format(c='start_ms')}, ' --> ', {_STAMP.format(c='end_ms')}, '\n', text, '\n'), '\n' ORDER BY cue) AS document
FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY first_ord) AS cue FROM m_cues) AS q GROUP BY job_id, part""",
    "export_captions_ass": f"""
SELECT q.job_id, 0 AS part, concat('{_HEADER}', caption_alignment, ',90,90,', caption_margin, ',1', '{_EVENTS}', body, '\n') AS document FROM (
  SELECT job_id, string_agg(concat('Dialogue: 0,', {_CENTI.format(c='start_ms')}, ',', {_CENTI.format(c='end_ms')}, ',Caption,,0,0,0,,', replace(text, '\n', ' ')), '\n' ORDER BY first_ord) AS body FROM m_lines GROUP BY job_id) AS q
JOIN m_layout l ON l.job_id = q.job_id""",
    "explode_frames": """
SELECT vec_id AS clip_id, i // 16 AS frame_no, i % 16 AS cell, i % 16 % 4 AS x, i % 16 // 4 AS y, CAST(floor((CAST(embedding[i + 1] AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) AS INT) AS v
FROM (SELECT *, unnest(range(CASE WHEN vec_id % 2 = 0 THEN 64 ELSE 48 END)) AS i FROM embeddings) AS q""",
    "plate_colour": "SELECT * FROM m_plate",
    "plate_colour_per_take": "SELECT * FROM m_plate_take",
    "colour_drift": """
SELECT *, drift_squared > 1156 AS drifted FROM (
  SELECT f.*, (f.r - p.r) * (f.r - p.r) + (f.g - p.g) * (f.g - p.g) + (f.b - p.b) * (f.b - p.b) AS drift_squared FROM m_plate_take f JOIN m_plate p ON p.clip_id = f.clip_id) AS q""",
    "threshold_ladder": f"""
SELECT clip_id, CASE WHEN sn = 0 OR pn = 0 THEN 80 ELSE pick.similarity END AS similarity_milli, sn > 0 AND pn > 0 AND clean IS NOT NULL AS calibrated,
       CASE WHEN sn > 0 AND pn > 0 THEN {_half("CAST(pick.sa * 10 AS DOUBLE) / sn")} END AS subject_alpha_tenths, CASE WHEN sn > 0 AND pn > 0 THEN {_half("CAST(pick.pa * 10 AS DOUBLE) / pn")} END AS plate_alpha_tenths, sn AS subject_cells, pn AS plate_cells
FROM (SELECT clip_id, sn, pn, clean, coalesce(clean, best) AS pick FROM (
  SELECT clip_id, sn, pn, arg_min(r, ord) FILTER (WHERE sa >= 250 * sn AND pa <= 4 * pn) AS clean, arg_max(r, struct_pack(s := sa, o := -ord)) FILTER (WHERE ord = 1 OR pa <= 6 * pn) AS best FROM m_rungs r GROUP BY clip_id, sn, pn) AS a) AS b""",
    "subject_bounds": """
SELECT clip_id, frame_no, CASE WHEN hi IS NULL THEN 0 ELSE lo END AS x, CASE WHEN hi IS NULL THEN 772 ELSE greatest(2, hi - lo) END AS width FROM (
  SELECT clip_id, frame_no, greatest(0, 2 * CAST(floor((min(x) FILTER (WHERE k >= 2) - CAST(0.5 AS DOUBLE)) / 8 * 772 / 2) AS BIGINT)) AS lo, least(772, 2 * CAST(ceil((max(x) FILTER (WHERE k >= 2) + CAST(1.5 AS DOUBLE)) / 8 * 772 / 2) AS BIGINT)) AS hi0,
         CASE WHEN max(k) >= 2 THEN least(772, 2 * CAST(ceil((max(x) FILTER (WHERE k >= 2) + CAST(1.5 AS DOUBLE)) / 8 * 772 / 2) AS BIGINT)) END AS hi
  FROM (SELECT clip_id, frame_no, x, count(*) FILTER (WHERE alpha > 140) AS k FROM fx_cells GROUP BY ALL) AS c GROUP BY clip_id, frame_no) AS q""",
    "motion_cells": "SELECT clip_id, cell, frames, round(mean, 4) AS mean, round(deviation, 4) AS deviation FROM m_motion",
    "motion_patch": f"""
SELECT clip_id, px AS x, py AS y, least(pw, 1920 - px) AS width, least(ph, 1088 - py) AS height, round(peak_deviation, 2) AS peak_deviation, k AS moving_cells, {_half('cx')} AS centre_x, {_half('cy')} AS centre_y,
       CASE WHEN k >= 3 THEN 'motion_in_lower_face' ELSE 'face_block_geometry' END AS located_by, x0 * 240 AS block_x, y0 * 136 AS block_y, bw * 240 AS block_width, bh * 136 AS block_height FROM m_corner""",
    "frame_loop": f"""
SELECT clip_id, frames, peak_frame, peak_difference, {_half('CAST((peak_frame + 1) * 1000 AS DOUBLE) / 24')} AS peak_ms, loop_frame, loop_difference, {_half('CAST((loop_frame + 1) * 1000 AS DOUBLE) / 24')} AS loop_ms, noise4,
       {_half('(CAST(loop_difference AS DOUBLE) / 64) / greatest(0.01, CAST(noise4 AS DOUBLE) / 4 / 64) * 100')} AS ratio_percent, loop_difference * 20 <= noise4 * 11 AS seamless FROM m_loop""",
    "stable_region": "SELECT v.video_id, clusters, hits, confidence_milli, coalesce(detected, false) AS detected, x, y, w, h, px, py, pw, ph FROM (SELECT DISTINCT video_id FROM fx_detections) v LEFT JOIN m_pixels p ON p.video_id = v.video_id",
}


def checks() -> dict[str, str]:
    return {name: with_steps(sql) for name, sql in CHECKS.items()}
