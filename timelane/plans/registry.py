"""The registered queries: one callable per operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.functions.scalars import floor_div
from timelane.functions.skew import spread
from timelane.operators import (
    adapt,
    captions as C,
    frames as P,
    gates,
    joins as J,
    logs as L,
    quality as Q,
    queue as K,
    regions as R,
    timeline as T,
)
from timelane.plans import render
from timelane.session import shared_folder, stage, tune
from timelane.sources import readers, sinks
from timelane.sources.derived import Entities, claims, requests
from timelane.streaming import progress as S

Query = Callable[[Entities], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: fn(Entities(tune(spark), folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


# ---------------------------------------------------------------- catalog and gates

@query
def asset_catalog(e):
    return readers.asset_catalog(e.assets, "Brand#7", "reference")


@query
def playable_assets(e):
    return gates.playable_assets(e.assets)


@query
def speech_carriers(e):
    return gates.speech_carriers(e.assets)


@query
def first_background(e):
    return gates.first_asset_of_type(e.assets, "background").select("persona", "asset_id", "label")


@query
def admission_gate(e):
    return gates.admission_gate(e.jobs, e.assets)


@query
def caption_eligibility(e):
    return gates.caption_eligibility(e.jobs)


@query
def clip_caption_language(e):
    n = F.col("doc_id")
    clips = e.table("documents").select(
        n.alias("clip_id"),
        F.when(n % 4 != 1, True).when(n % 8 != 1, False).alias("captions"),
        F.when(n % 3 == 0, F.col("lang")).when(n % 3 == 1, "").alias("language"),
        F.when(n % 5 == 0, "unknown").when(n % 5 == 1, F.col("lang")).alias("vod_language"),
    )
    return gates.clip_caption_language(clips)


# ---------------------------------------------------------------- plan adaptation

@query
def vocabulary(e):
    return adapt.vocabulary(e.assets)


@query
def vocabulary_legacy(e):
    return adapt.vocabulary(e.assets, "v2")


@query
def order_events(e):
    ordered = adapt.order_events(e.events, e.events_hot)
    return ordered.select("job_id", "event_ord", "time_ms", "event_no")


def _ready(e, dialect="v4"):
    return gates.admitted_jobs(e.jobs, e.assets, dialect=dialect)


@query
def cap_comments(e):
    return adapt.cap_comments(e.events, _ready(e), e.assets, "v4", e.events_hot)


@query
def cap_comments_legacy(e):
    return adapt.cap_comments(e.events, _ready(e, "v2"), e.assets, "v2", e.events_hot)


@query
def map_reaction_type(e):
    return adapt.reaction_type_map(e.events, e.jobs, e.assets)


@query
def adapt_plan(e):
    return adapt.adapt_plan(e.events, _ready(e), e.assets, "v4", e.events_hot)


@query
def adapt_plan_legacy(e):
    return adapt.adapt_plan(e.events, _ready(e, "v2"), e.assets, "v2", e.events_hot)


@query
def nearest_asset(e):
    chosen = T.nearest_asset(adapt_plan(e), e.assets)
    return chosen.select("job_id", "event_no", "type", "asset_id", "clip_ms")


@query
def nearest_asset_legacy(e):
    chosen = T.nearest_asset(adapt_plan_legacy(e), e.assets, "v2")
    return chosen.select("job_id", "event_no", "type", "asset_id", "clip_ms")


# ---------------------------------------------------------------- timeline

@query
def place_reactions(e):
    return render.planned_reactions(e.events, e.jobs, e.assets, "v4", e.events_hot)


@query
def place_reactions_legacy(e):
    return render.planned_reactions(e.events, e.jobs, e.assets, "v2", e.events_hot)


@query
def placement_summary(e):
    return render.placement_summary(place_reactions(e))


@query
def fill_gaps_cyclic(e):
    placed = stage(place_reactions(e), "placed")
    return T.fill_gaps_cyclic(T.open_gaps(placed, _ready(e), e.events_hot), e.assets, e.events_hot)


@query
def fill_gaps_fixed(e):
    placed = stage(place_reactions_legacy(e), "placed")
    return T.fill_gaps_fixed(T.open_gaps(placed, _ready(e, "v2"), e.events_hot), e.assets, e.events_hot)


@query
def build_timeline(e):
    return render.build_timeline(e.events, e.jobs, e.assets, "v4", e.events_hot)


@query
def build_timeline_legacy(e):
    return render.build_timeline(e.events, e.jobs, e.assets, "v2", e.events_hot)


def _segments_hot(e):
    return e.events_hot or T.has_long_job(e.jobs)


def _numbered(e, segments):
    """Segments, a little less than two for an event, with their numbers."""
    hot = _segments_hot(e)
    return T.number_segments(segments if hot else spread(segments, "job_id", 2 * e.rows("lineitem")), hot), hot


@query
def realised_clock(e):
    return T.realised_clock(*_numbered(e, build_timeline(e)))


@query
def clock_verdict(e):
    return T.clock_verdict(build_timeline(e), _ready(e))


@query
def crossfade_offsets(e):
    return T.crossfade_offsets(*_numbered(e, build_timeline_legacy(e)))


@query
def cover_with_cycle(e):
    """Spoken lines are made six times as long as voiced, so several carriers are needed for each."""
    jobs = _ready(e)
    carried = gates.persona_flags(e.assets).filter("has_carrier").select("persona")
    spoken = adapt.adapt_plan(e.events, jobs, e.assets, "v4", e.events_hot).filter("comment IS NOT NULL")
    numbered = T.running(
        spoken.join(carried, "persona", "left_semi"),
        ["job_id"],
        [F.col("event_no")],
        [T.Run("seq", "rank")],
        [[T.chunk_of("event_no")]] if e.events_hot else None,
    )
    lines = numbered.select("job_id", "persona", "seq", (F.col("voice_ms") * 6).cast("bigint").alias("need_ms"))
    return T.cover_with_cycle(lines, e.assets, e.events_hot)


def _boxes(e):
    """Boxes derived from the vector ids; two of seven frames have none."""
    numbered = T.running(
        e.table("embeddings").select(F.col("label").alias("clip_id"), "vec_id"),
        ["clip_id"], [F.col("vec_id")], [T.Run("ord", "rank")],
        [[T.block_of("vec_id")]] if e.hot("embeddings", "label") else None,
    )
    n = F.col("vec_id")
    box = F.struct((n % 50).alias("x1"), (n % 40).alias("y1"), (n % 50 + 20).alias("x2"), (n % 40 + 30).alias("y2"))
    frames = numbered.select("clip_id", (F.col("ord") - 1).alias("frame_no"), F.when(n % 7 >= 2, box).alias("box"))
    return frames


@query
def forward_fill_boxes(e):
    filled = T.forward_fill_boxes(_boxes(e), e.hot("embeddings", "label"))
    return filled.select("clip_id", "frame_no", "valid", "box.x1", "box.y1", "box.x2", "box.y2")


@query
def box_coverage(e):
    return T.box_coverage(_boxes(e))


@query
def landing_error(e):
    return render.landing_error(place_reactions(e))


@query
def reaction_density(e):
    return render.reaction_density(e.events, place_reactions(e), _ready(e))


# ---------------------------------------------------------------- prices, windows, markers, layout


# What the marker check looks for in a page.
PAGE_MARKERS = (
    ("navigation", "<nav>", "a page without navigation is a fragment"),
    ("script", "<script>", "the tracker must be present once"),
    ("tracker", "track(0);", "the first tracker must run once"),
    ("canonical link", 'rel="canonical"', "copies must name their origin"),
)


def _cost_requests(e):
    """Every event asks for one clip: a known model or an unknown one, on either backend."""
    n = F.col("event_id")
    names = F.array(*[F.lit(m[0]) for m in J.MODEL_PRICES], F.lit("unlisted/model"))
    return e.table("events").select(
        n.alias("request_no"),
        F.get(names, (n % 8).cast("int")).alias("model"),
        F.when(n % 5 == 0, "openrouter").otherwise("fal").alias("backend"),
        (3 + n % 8).alias("requested_s"),
    )


@query
def spec_cost(e):
    return J.spec_cost(_cost_requests(e))


@query
def spec_cost_by_model(e):
    priced = J.spec_cost(_cost_requests(e))
    return priced.groupBy("model", "backend").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("chosen_s").alias("seconds"), F.sum("cost_micro").alias("cost_micro")
    )


@query
def window_contract(e):
    return J.window_contract(e.candidates)


@query
def slice_window(e):
    return J.slice_window(e.words, e.candidates)


@query
def marker_audit(e):
    return J.marker_audit(e.table("pages"), "page_id", "html", PAGE_MARKERS)


@query
def layout_plan(e):
    return J.layout_plan(e.jobs, e.assets)


# ---------------------------------------------------------------- captions

@query
def caption_lines(e):
    return C.caption_lines(e.words, e.words_hot)


@query
def caption_cues(e):
    return C.caption_cues(e.words, e.words_hot)


@query
def export_captions_srt(e):
    return C.export_captions(C.caption_cues(e.words, e.words_hot), "srt", split=e.words_hot)


@query
def export_captions_ass(e):
    return C.export_captions(C.caption_lines(e.words, e.words_hot), "ass", J.layout_plan(e.jobs, e.assets), e.words_hot)


# ---------------------------------------------------------------- frame grids and regions

@query
def explode_frames(e):
    """Vectors as raw clips: 64 values, read as 4 x 4 grids, are 4 whole frames; the first 60 leave a partial one."""
    grids = e.table("embeddings").select(
        F.col("vec_id").alias("clip_id"),
        F.transform(
            F.slice("embedding", F.lit(1), F.when(F.col("vec_id") % 2 == 0, 64).otherwise(60)),
            lambda v: F.floor((v.cast("double") + 1) * F.lit(127.5)).cast("int"),
        ).alias("bytes"),
    )
    return readers.explode_frames(grids, 4, 4)


@query
def plate_colour(e):
    return P.plate_colour(e.cells)


def _takes(e):
    """Ten frames in a row count as one take of a clip."""
    return P.plate_colour(e.cells.withColumn("take", T.floor_div(F.col("frame_no"), 10)), ["clip_id", "take"])


@query
def plate_colour_per_take(e):
    return _takes(e)


@query
def colour_drift(e):
    return P.colour_drift(_takes(e), P.plate_colour(e.cells))


@query
def threshold_ladder(e):
    """The alpha a candidate leaves on a cell is derived from its value and the candidate's place."""
    scored = e.cells.select(
        "clip_id", "r", "g", "b",
        F.array(*[F.least(F.lit(255), F.col("v") * (i + 1)) for i in range(len(P.SIMILARITIES))]).alias("alphas"),
    )
    return P.threshold_ladder(scored, P.plate_colour(e.cells))


@query
def subject_bounds(e):
    return P.subject_bounds(e.cells, ["clip_id", "frame_no"], 8, J.AVATAR_W)


@query
def motion_cells(e):
    cells = P.motion_cells(e.cells)
    return cells.select("clip_id", "cell", "frames", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query
def motion_patch(e):
    return P.motion_patch(P.motion_cells(e.cells), (8, 8), (1920, 1088))


@query
def frame_loop(e):
    return P.frame_loop(e.frames, F.col("clip_id") % 4 == 0, 24)


@query
def stable_region(e):
    return R.stable_region(e.detections, 1920, 1080)


# ---------------------------------------------------------------- sources and sinks


def _claims(e):
    """One claim document per order, as text, for its planted shapes: ids that are no numbers, numbers in quotes, plans
    that are no object, up to four plan events and two assets with missing or mistyped fields."""
    n, q = F.col("job_id"), F.lit('"')
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    seconds = lambda ms: F.concat(floor_div(ms, 1000).cast("string"), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))
    quoted = lambda when, value: F.when(when, F.concat(q, value, q)).otherwise(value)
    record = lambda *fields: text("{", F.array_join(F.array_compact(F.array(*fields)), ","), "}")
    listed = lambda size, make: F.array_join(F.transform(F.filter(F.array(*[F.lit(i) for i in range(4)]), lambda i: i < size), make), ",")

    def event(i):
        k = n + i
        return record(
            F.when(k % 7 != 0, text('"time":', quoted(k % 3 == 1, seconds((n * 131 + i * 9973) % 90000)))),
            F.when(k % 4 != 0, text('"type":"type-', (k % 4).cast("string"), q)),
            F.when(k % 5 != 0, text('"intensity":', quoted(k % 2 == 1, seconds((n * 37 + i * 211) % 1001)))),
            F.when(k % 6 != 0, text('"duration":', F.when(k % 6 == 1, F.lit('"soon"')).otherwise(seconds((n * 53 + i * 400) % 8000)))),
            F.when(k % 3 == 0, text('"comment":" line ', i.cast("string"), q)),
        )

    def offered(i):
        k = n * 2 + i
        return record(
            text('"id":', F.when(k % 2 == 0, k.cast("string")).otherwise(text('"a-', k.cast("string"), q))),
            text('"persona":"', F.col("persona"), q),
            F.when(k % 5 != 0, F.lit('"reaction_type":"neutral"')),
            F.when(k % 3 == 0, F.lit('"enabled":true')).when(k % 3 == 1, F.lit('"enabled":"false"')),
            F.when(k % 4 != 0, text('"intensity_min":', quoted(k % 4 == 1, seconds(k % 1001)))),
            F.when(k % 7 == 0, F.lit('"metadata":{"loop":[1,2]}')).when(k % 7 == 1, F.lit('"metadata":"none"')),
        )

    ref = F.when(n % 9 == 0, text('"job-', n.cast("string"), q)).otherwise(quoted(n % 9 == 1, n.cast("string")))
    plan = F.when(F.col("has_plan"), text('{"events":[', listed(n % 5, event), "]}")).otherwise(F.lit('"none"'))
    assets = F.when(n % 4 == 3, F.lit("null")).otherwise(text("[", listed(n % 4, offered), "]"))
    return e.jobs.select(text('{"job":{"id":', ref, ',"status":"', F.col("status"), '","reaction_plan":', plan, '},"assets":', assets, "}").alias("document"))


@query
def read_jobs(e):
    return readers.read_jobs(_claims(e))


@query
def read_job_assets(e):
    found = readers.read_job_assets(_claims(e))
    return found.select("job_id", "job_ref", "asset_ord", "asset_ref", "persona", "reaction_type", "enabled", "intensity_min_m", "metadata")


@query
def read_transcripts(e):
    """One transcript document per conversation turn; blank words and words without an end are planted in it."""
    words = F.transform(
        F.split("text", " "),
        lambda w, i: F.struct(
            F.concat(F.lit(" "), w).alias("text"),
            F.format_string("%d.%03d", (i * 300 / 1000).cast("int"), (i * 300 % 1000).cast("int")).alias("start"),
            F.when(i % 11 == 3, "NaN").when(i % 11 != 5, F.format_string("%d.%03d", ((i * 300 + 240) / 1000).cast("int"), ((i * 300 + 240) % 1000).cast("int"))).alias("end"),
        ),
    )
    documents = e.table("conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("job_id"),
        F.to_json(F.struct(F.lit("local").alias("provider"), F.col("role").alias("language"), words.alias("words"))).alias("document"),
    )
    return readers.read_transcripts(documents)


@query
def read_probes(e):
    """Probe documents are built from the probe facts, with an audio stream ahead of the video for odd jobs."""
    seconds = lambda c: F.format_string("%d.%03d", (c / 1000).cast("int"), (c % 1000).cast("int"))
    video = F.struct(
        F.lit("video").alias("codec_type"), F.lit("h264").alias("codec_name"), "width", "height", F.lit(None).cast("string").alias("duration")
    )
    audio = F.struct(
        F.lit("audio").alias("codec_type"), F.lit("aac").alias("codec_name"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.when(F.col("job_id") % 4 != 0, seconds(F.col("audio_ms"))).alias("duration"),
    )
    streams = F.filter(
        F.when(F.col("job_id") % 2 == 1, F.array(audio, video)).otherwise(F.array(video, audio)),
        lambda s: ((s["codec_type"] == "video") & F.col("has_video")) | ((s["codec_type"] == "audio") & F.col("has_audio")),
    )
    length = F.when(F.col("job_id") % 13 != 0, seconds(F.col("duration_ms")))
    documents = e.probes.select(
        "job_id", F.to_json(F.struct(streams.alias("streams"), F.struct(length.alias("duration")).alias("format"))).alias("document")
    )
    return readers.read_probes(documents)


def _writes(e):
    n = F.col("event_id")
    return e.table("events").select(
        F.col("user_id").alias("job_id"), n.alias("render_id"), F.col("ts").alias("written_at"), (n % 3 != 0).alias("immutable")
    )


@query
def overwrite_audit(e):
    return K.overwrite_audit(_writes(e))


@query
def write_results(e):
    """Written under their keys to a table of their own, in two appends, read back and audited."""
    path = f"{shared_folder(e.spark)}/timelane-results-{uuid.uuid4().hex}"
    writes = _writes(e)
    for half in (0, 1):
        sinks.write_results(writes.where(F.col("render_id") % 2 == half), path)
    back = sinks.read_results(e.spark, path)
    return back.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("renders"),
        F.countDistinct("key").alias("keys"),
        F.max_by("render_id", F.struct("written_at", "render_id")).alias("latest_render"),
        F.max_by("key", F.struct("written_at", "render_id")).alias("latest_key"),
    )


@query
def register_assets(e):
    n = F.col("p_partkey")
    presets = F.array(*[F.lit(p[0]) for p in sinks.PRESETS], F.lit("unknown_preset"))
    names = F.array(*[F.lit(m[0]) for m in J.MODEL_PRICES], F.lit("unlisted/model"))
    clips = e.table("part").select(
        n.alias("asset_id"),
        F.col("p_brand").alias("persona"),
        F.get(presets, (n % 13).cast("int")).alias("preset"),
        F.get(names, (n % 8).cast("int")).alias("model"),
        F.lit("fal").alias("backend"),
        (2000 + F.col("p_size") * 100).alias("stored_ms"),
        F.struct(F.lit("pingpong").alias("mode"), (700 + F.col("p_size") * 40).alias("peak_ms")).alias("loop"),
    )
    registered = sinks.register_assets(clips)
    return registered.select(
        "asset_id", "persona", "reaction_type", "label", "storage_path", "duration_ms", "speech_ready", "anchor_role", "enabled",
        "metadata.generated_by", "metadata.requested_duration_s", "metadata.cost_micro", "metadata.loop.peak_ms",
    )


# ---------------------------------------------------------------- quality

@query
def loudness_gain(e):
    return Q.loudness_gain(e.loudness)


@query
def render_qc(e):
    return Q.render_qc(e.probes, e.jobs)


@query
def render_qc_rates(e):
    return Q.qc_rates(Q.render_qc(e.probes, e.jobs))


@query
def replacement_rect(e):
    n = F.col("o_orderkey")
    rects = e.table("orders").select(
        n.alias("job_id"),
        (n * 37 % 1000 - 20).alias("x"), (n * 53 % 900).alias("y"), (n * 29 % 700 - 10).alias("width"), (n * 31 % 600).alias("height"),
    )
    return Q.replacement_rect(rects)


@query
def delivery_budget(e):
    return Q.delivery_budget(e.probes.withColumn("retry_bytes", T.floor_div(F.col("bytes") * 85, 100)))


@query
def render_summary(e):
    ready = _ready(e)
    placed = stage(place_reactions(e), "placed").withColumn(
        "lipsync_provider", F.when(F.col("job_id") % 2 == 0, "fal").when(F.col("job_id") % 3 == 0, "kaggle")
    )
    return Q.render_summary(
        ready.withColumn("source_replacement", F.col("job_id") % 13 == 0),
        e.events.filter("time_ms IS NOT NULL"),
        placed,
        T.fill_counts(T.open_gaps(placed, ready, e.events_hot), e.assets, e.events_hot),
        C.caption_lines(e.words, e.words_hot),
        J.layout_plan(e.jobs, e.assets),
        Q.render_qc(e.probes, e.jobs),
        delivery_budget(e).join(e.probes.select("job_id", "bytes"), "job_id"),
        Q.loudness_gain(e.loudness),
    ).withColumn("comments", F.array_join(F.transform("comments", lambda c: F.concat_ws("|", c["start_ms"], c["duration_ms"], c["text"])), ";"))


# ---------------------------------------------------------------- queue and files

@query
def claim_order(e):
    return K.claim_order(e.jobs)


@query
def drain_batches(e):
    return K.drain_batches(e.jobs)


@query
def preferred_artifact(e):
    return K.preferred_artifact(e.files)


@query
def newest_result(e):
    return K.newest_result(e.files)


@query
def requeue(e):
    n = F.col("job_id")
    jobs = e.jobs.select(
        "job_id", "status",
        F.when(n % 3 == 0, "compositing").otherwise("result_uploading").alias("current_stage"),
        F.when(n % 5 == 0, F.concat(F.lit("failed at "), n.cast("string"))).alias("error"),
        F.concat(F.lit("results/"), n.cast("string"), F.lit(".mp4")).alias("result_path"),
        F.unix_seconds(F.col("created_at").cast("timestamp")).alias("started_at"),
        F.lit(0).cast("bigint").alias("updated_at"),
    )
    return K.requeue(jobs, e.jobs.filter((F.col("status") == "rendering") & (n % 2 == 0)), F.lit(1_700_000_000).cast("bigint"))


@query
def schedule_gaps(e):
    runs = e.table("events").select("event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"))
    return K.schedule_gaps(runs, "event_type", "at_us", "event_id", 300_000_000, e.hot("events", "event_type"))


@query
def drain_sessions(e):
    return K.drain_sessions(claims(e.table("events")))


# ---------------------------------------------------------------- logs, caches, progress

def _progress(e):
    return e.progress.select(
        "job_id", "seq", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"), "stage", "status",
        F.from_json("patch", "map<string,string>").alias("patch"),
    )


def _kind(job):
    return F.get(F.array(*[F.lit(k) for k in L.DEADLINES_S]), (job % len(L.DEADLINES_S)).cast("int"))


@query
def classify_attempts(e):
    return L.classify_attempts(e.attempts)


@query
def classify_status(e):
    return L.classify_status(e.statuses, "lip.sync")


@query
def cache_lookup(e):
    return L.cache_lookup(e.cache, J.DEFAULT_PRICE)


@query
def cache_savings(e):
    found = L.cache_lookup(e.cache, J.DEFAULT_PRICE)
    return found.groupBy("hit").agg(F.count(F.lit(1)).alias("requests"), F.sum("saved_micro").alias("saved_micro"))


@query
def download_cache(e):
    """Downloads of the pages' urls, asked for again by every event of a page's number."""
    pages = e.table("pages").select("page_id", "url")
    asked = e.table("events").select(F.col("event_id").alias("asked_no"), (F.col("event_id") % 50).alias("page_id"))
    extension = F.when(F.col("page_id") % 3 == 0, ".png").alias("extension")
    return L.download_cache(asked.join(pages, "page_id").select("asked_no", "url", extension)).select("cache_key", "asked", "hits")


@query
def error_digest(e):
    n = F.col("request_id")
    failures = e.attempts.filter("exit_code <> 0").select(
        F.concat(F.lit("attempt "), F.col("attempt").cast("string")).alias("stage"),
        F.concat("log", F.lit(" host "), (n % 7).cast("string")).alias("message"),
    )
    return L.error_digest(failures, 3)


@query
def job_state(e):
    state = L.job_state(_progress(e))
    return state.select("job_id", "stage", "status", "reports", F.col("meta")["k"].alias("k"))


@query
def stage_durations(e):
    return L.stage_durations(_progress(e), e.hot("events", "user_id"))


@query
def stage_counts(e):
    return L.stage_counts(_progress(e))


@query
def stalled_jobs(e):
    reports = _progress(e).withColumn("kind", _kind(F.col("job_id")))
    last = reports.agg(F.max("at_us")).first()[0]  # one number
    return L.stalled_jobs(reports, last)


# ---------------------------------------------------------------- streams over the event file

#: Bytes per micro-batch; None reads everything available as one.
MAX_BYTES = None


def _event_stream(e):
    return S.report_stream(e.spark, e.folder, "events.parquet", e.table("events").schema, MAX_BYTES)


def _progress_stream(e):
    return _event_stream(e).select(
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("seq"),
        "ts",
        F.unix_micros("ts").alias("at_us"),
        F.expr("CASE event_type WHEN 'view' THEN 'render_preparing' WHEN 'signup' THEN 'timeline_building' WHEN 'click' THEN 'avatar_rendering' WHEN 'purchase' THEN 'completed' ELSE 'failed' END").alias("stage"),
        F.expr("CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'rendering' END").alias("status"),
        F.from_json("props", "map<string,string>").alias("patch"),
    )


@query
def job_state_stream(e):
    states = S.latest_version(S.drain(S.job_state_stream(_progress_stream(e)), "states"))
    return states.select("job_id", "stage", "status", "reports", F.col("meta")["k"].alias("k"))


@query
def stage_counts_stream(e):
    return S.drain(S.stage_counts_stream(_progress_stream(e)), "counts")


@query
def stalled_jobs_stream(e):
    reports = _progress_stream(e).withColumn("kind", _kind(F.col("job_id")))
    return S.drain(S.stalled_jobs_stream(reports), "stalled")


@query
def cache_dedup_stream(e):
    # Requests come again up to seven hours after their event.
    asked = requests(_event_stream(e)).withColumn("ts", F.timestamp_micros("at_us"))
    return S.drain(S.cache_dedup_stream(asked, delay="8 hours"), "dedup").select("cache_key", "request_no", "at_us")


@query
def drain_sessions_stream(e):
    made = claims(_event_stream(e)).withColumn("ts", F.timestamp_micros("at_us"))
    return S.drain(S.drain_sessions_stream(made, delay="2 hours"), "sessions")
