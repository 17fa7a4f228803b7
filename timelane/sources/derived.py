"""The entity tables of the domain, derived from the given Parquet tables by plain expressions.

``Entities(spark, folder)`` offers one lazy DataFrame per entity.  The derivations are in FIXTURES.md; all
clocks are integer milliseconds and every ordering is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.functions.scalars import floor_div
from timelane.functions.skew import Run, block_of, chunk_of, has_hot_key, running, spread

# Derivations that are one projection of one table; the text runs unchanged in Spark and in ANSI engines.
PROJECTIONS = {
    "fx_jobs": """
SELECT o_orderkey AS job_id,
       15000 + (o_orderkey * 7919) % 75001 AS total_ms,
       concat('Brand#', CAST(1 + o_custkey % 25 AS STRING)) AS persona,
       CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'P' THEN 'rendering' ELSE 'completed' END AS status,
       o_orderdate AS created_at,
       o_orderkey % 3 = 0 AS voice_lipsync,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 3 END AS max_voice_comments,
       o_orderkey % 10 <> 0 AS has_plan,
       o_orderkey % 5 <> 0 AS source_has_audio,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 6 <> 1 END AS has_speech,
       CASE o_custkey % 4 WHEN 0 THEN 'bottom_right' WHEN 1 THEN 'top_left' WHEN 2 THEN 'top_band' ELSE 'bottom_left' END AS dir_avatar,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CASE o_custkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'top' ELSE 'bottom' END END AS dir_captions,
       CASE o_custkey % 5 WHEN 0 THEN 'down' WHEN 1 THEN 'up' ELSE 'none' END AS dir_shift,
       o_custkey % 4 IN (1, 2) AS dir_plate,
       CASE o_orderkey % 7 WHEN 0 THEN 'top_right' WHEN 1 THEN 'bottom_band' WHEN 2 THEN 'sideways' ELSE NULL END AS ovr_avatar,
       CASE o_orderkey % 9 WHEN 0 THEN 'on' WHEN 1 THEN 'off' ELSE 'auto' END AS ovr_background
FROM {orders}""",
    "fx_assets": """
SELECT p_partkey AS asset_id, p_partkey AS asset_ord, p_brand AS persona,
       CASE p_type WHEN 'STANDARD' THEN 'neutral' WHEN 'ECONOMY' THEN 'smirk' WHEN 'MEDIUM' THEN 'cringe'
                   WHEN 'SMALL' THEN 'surprise' WHEN 'LARGE' THEN 'disbelief'
                   ELSE CASE p_partkey % 4 WHEN 0 THEN 'reference' WHEN 1 THEN 'background' ELSE 'comment' END END AS reaction_type,
       CASE WHEN p_type = 'PROMO' AND p_partkey % 4 >= 2 THEN true WHEN p_partkey % 5 = 0 THEN NULL ELSE false END AS speech_ready,
       CASE WHEN p_partkey % 13 = 0 THEN false WHEN p_partkey % 7 = 0 THEN NULL ELSE true END AS enabled,
       CASE WHEN p_size % 8 = 0 THEN NULL ELSE (p_size * 17) % 500 END AS intensity_min_m,
       CASE WHEN p_size % 9 = 0 THEN NULL ELSE 500 + (p_size * 23) % 501 END AS intensity_max_m,
       CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN 150 ELSE 2000 + p_size * 100 END AS duration_ms,
       2100 + p_size * 100 AS probed_ms,
       CASE WHEN p_size % 6 = 0 THEN NULL WHEN p_size % 6 = 1 THEN 90000 ELSE 700 + p_size * 40 END AS peak_ms,
       p_name AS label
FROM {part}""",
    "fx_candidates": """
SELECT conv_id * 10 + turn AS candidate_id, conv_id AS job_id,
       turn * 4000 AS clip_start_ms, turn * 4000 + 9000 + (conv_id * 7001 + turn * 911) % 90000 AS clip_end_ms,
       CASE WHEN conv_id % 3 = 0 THEN turn * 4000 + 500 ELSE NULL END AS plan_start_ms,
       CASE WHEN conv_id % 4 = 0 THEN turn * 4000 + 30000 ELSE NULL END AS plan_end_ms
FROM {conversations}""",
    "fx_detections": """
SELECT user_id AS video_id, event_id % 7 AS sample_no, event_id AS det_no,
       CASE WHEN event_id % 3 = 0 THEN (event_id * 7919) % 8000 ELSE (user_id * 613) % 7000 + (event_id * 31) % 400 END AS x,
       CASE WHEN event_id % 3 = 0 THEN (event_id * 104729) % 8000 ELSE (user_id * 419) % 7000 + (event_id * 17) % 400 END AS y,
       300 + (event_id * 71) % 1200 AS w, 300 + (event_id * 53) % 1500 AS h
FROM {events}""",
    "fx_probes": """
SELECT o_orderkey AS job_id, o_orderkey % 31 <> 0 AS has_video, CASE WHEN o_orderkey % 23 = 0 THEN 720 ELSE 1080 END AS width, 1920 AS height,
       15000 + (o_orderkey * 7919) % 75001 + (o_orderkey * 13) % 500 - 200 AS duration_ms,
       o_orderkey % 9 <> 0 AS has_audio, 15000 + (o_orderkey * 7919) % 75001 - (o_orderkey * 29) % 900 AS audio_ms,
       15000 + (o_orderkey * 7919) % 75001 AS expected_ms, 20000000 + (o_orderkey * 99991) % 40000000 AS bytes
FROM {orders}""",
    "fx_progress": """
SELECT user_id AS job_id, event_id AS seq, ts,
       CASE event_type WHEN 'view' THEN 'render_preparing' WHEN 'signup' THEN 'timeline_building' WHEN 'click' THEN 'avatar_rendering' WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS stage,
       CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'rendering' END AS status,
       props AS patch
FROM {events}""",
    "fx_attempts": """
SELECT CAST(floor(event_id / 2) AS BIGINT) AS request_id, event_id % 2 + 1 AS attempt,
       CASE WHEN event_type IN ('view', 'purchase') THEN 0 ELSE 1 END AS exit_code,
       CASE event_type WHEN 'error' THEN 'ERROR: HTTP Error 429: Too Many Requests' WHEN 'click' THEN 'Sign in to confirm you''re not a bot' WHEN 'signup' THEN 'network unreachable' ELSE 'ok' END AS log
FROM {events}""",
    "fx_statuses": """
SELECT event_id AS ref,
       CASE event_type WHEN 'view' THEN 'KernelWorkerStatus.COMPLETE' WHEN 'click' THEN 'running' WHEN 'error' THEN 'status: ERROR after success' WHEN 'signup' THEN 'Cancelled by user' ELSE 'queued' END AS text,
       CASE event_id % 3 WHEN 0 THEN concat('pushed to https://www.kaggle.com/code/owner-', CAST(user_id AS STRING), '/lip_', CAST(event_id AS STRING), ' ok')
                         WHEN 1 THEN concat('ref me', CAST(user_id AS STRING), '/lip.sync, running') ELSE 'nothing here' END AS push_log
FROM {events}""",
    "fx_loudness": """
SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 8 = 0 THEN 'no measurement' ELSE concat('t: 1 I: -', CAST(10 + o_orderkey % 20 AS STRING), '.0 LUFS Summary: I: -', CAST(5 + o_orderkey % 40 AS STRING), '.5 LUFS') END AS log FROM {orders}""",
    "fx_files": """
SELECT conv_id AS job_id, CASE turn % 4 WHEN 0 THEN 'source.webm' WHEN 1 THEN 'source.mp4' WHEN 2 THEN 'source.ts' ELSE 'notes.txt' END AS name,
       (conv_id * 577 + turn * 211) % 5000 AS size, (conv_id * 31 + turn * 1009) % 100000 AS mtime_ms, CASE WHEN turn % 3 = 0 THEN 'fallback' ELSE 'results' END AS folder
FROM {conversations}""",
    "fx_cache": """
SELECT event_id AS request_no, concat('model-', CAST(event_id % 3 AS STRING)) AS model, concat('img-', CAST(user_id AS STRING)) AS image, concat('aud-', event_type) AS audio, 'hold still' AS prompt, 3 + event_id % 8 AS seconds FROM {events}""",
}

_EVENT_COLUMNS = """l_orderkey AS job_id, event_ord,
       CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE (l_partkey * 131 + l_linenumber * 9973 + l_suppkey * 37) % 90000 END AS time_ms,
       CASE (l_partkey + l_linenumber) % 9 WHEN 0 THEN 'laugh' WHEN 1 THEN 'disbelief' WHEN 2 THEN 'suspicious' WHEN 3 THEN 'surprise'
            WHEN 4 THEN 'comment' WHEN 5 THEN 'smirk' WHEN 6 THEN 'cringe' WHEN 7 THEN 'dance' ELSE NULL END AS type,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE (l_suppkey * 37 + l_linenumber * 211) % 1001 END AS intensity_m,
       CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE (l_partkey * 53) % 10000 END AS duration_ms,
       CASE WHEN l_linestatus = 'F' THEN concat(' line ', CAST(l_linenumber AS STRING), ' ') WHEN l_partkey % 5 = 0 THEN '   ' ELSE NULL END AS comment,
       1400 + 137 * (l_partkey % 23) AS voice_ms"""

_WORD_LENGTHS = """job_id, ord, text, 120 + 40 * (length(text) % 8) AS dur,
       CASE WHEN ord = 1 THEN 0 WHEN prev LIKE '%.' THEN 900 WHEN prev LIKE '%,' THEN 450 ELSE 60 END AS gap"""

_CELL_COLUMNS = """clip_id, frame_no, cell, cell % 8 AS x, CAST(floor(cell / 8) AS INT) AS y, v,
       (v * 3) % 256 AS r, (v * 5) % 256 AS g, (v * 7) % 256 AS b, (v * 11) % 256 AS alpha"""

#: A tenth of the claims opens a burst of up to 23, two and a half minutes apart; a tenth of the requests comes again.
BURST_STEP_US = 150_000_000
REPEATED_AFTER_H = (0, 2, 5, 7)

# Spellings for an engine without Spark's explode; used by the result checks only.
SEQUENCED_SQL = {
    "fx_claims": f"""
SELECT user_id AS worker, event_id * 64 + i AS seq, epoch_us(ts) + i * {BURST_STEP_US} AS at_us
FROM events, LATERAL unnest(range(CASE WHEN event_id % 10 = 0 THEN 1 + event_id % 23 ELSE 1 END)) AS t(i)""",
    "fx_requests": f"""
SELECT event_id * 8 + h AS request_no, epoch_us(ts) + h * 3600000000 AS at_us, model, image, audio, prompt
FROM events JOIN fx_cache ON request_no = event_id, LATERAL unnest(CASE WHEN event_id % 10 = 0 THEN {list(REPEATED_AFTER_H)} ELSE [0] END) AS t(h)""",
    "fx_events": f"""
SELECT {_EVENT_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS event_ord FROM lineitem) AS n""",
    "fx_words": f"""
SELECT job_id, ord, text, CAST(end_ms - dur AS BIGINT) AS start_ms, CAST(end_ms AS BIGINT) AS end_ms FROM (
  SELECT *, sum(gap + dur) OVER (PARTITION BY job_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS end_ms FROM (
    SELECT {_WORD_LENGTHS} FROM (
      SELECT *, lag(text) OVER (PARTITION BY job_id ORDER BY ord) AS prev FROM (
        SELECT conv_id AS job_id, u.word AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, u.pos) AS ord
        FROM conversations, LATERAL unnest(string_split(conversations.text, ' ')) WITH ORDINALITY AS u(word, pos) WHERE length(u.word) > 0) AS a) AS b) AS c) AS d""",
    "fx_cells": f"""
SELECT {_CELL_COLUMNS} FROM (
  SELECT clip_id, frame_no, CAST(u.pos - 1 AS INT) AS cell, CAST(floor((CAST(u.e AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) AS INT) AS v
  FROM (SELECT label AS clip_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_no, embedding FROM embeddings) AS f,
       LATERAL unnest(f.embedding) WITH ORDINALITY AS u(e, pos)) AS c""",
}


def claims(events: DataFrame) -> DataFrame:
    """(worker, seq, at_us) of an event table or stream."""
    n = F.col("event_id")
    size = F.when(n % 10 == 0, 1 + n % 23).otherwise(1)
    spread = events.select("user_id", n, "ts", F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1)).alias("i"))
    return spread.select(F.col("user_id").alias("worker"), (n * 64 + F.col("i")).alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) + F.col("i") * BURST_STEP_US).alias("at_us"))


def requests(events: DataFrame) -> DataFrame:
    """(request_no, at_us, model, image, audio, prompt) of an event table or stream."""
    n = F.col("event_id")
    hours = F.when(n % 10 == 0, F.array(*map(F.lit, REPEATED_AFTER_H))).otherwise(F.array(F.lit(0)))
    return events.select(n, "ts", "user_id", "event_type", F.explode(hours).alias("h")).select(
        (n * 8 + F.col("h")).alias("request_no"),
        (F.unix_micros(F.col("ts").cast("timestamp")) + F.col("h") * F.lit(3_600_000_000)).alias("at_us"),
        F.concat(F.lit("model-"), (n % 3).cast("string")).alias("model"),
        F.concat(F.lit("img-"), F.col("user_id").cast("string")).alias("image"),
        F.concat(F.lit("aud-"), "event_type").alias("audio"),
        F.lit("hold still").alias("prompt"),
    )


class Entities:
    """Lazy entity tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._hot: dict[str, bool] = {}
        self._rows: dict[str, int] = {}
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def projection(self, name: str) -> DataFrame:
        text = PROJECTIONS[name]
        source = text[text.rindex("{") + 1 : text.rindex("}")]
        return self.spark.sql(text, **{source: self.table(source)})

    def hot(self, table: str, key: str) -> bool:
        """Does one value of ``key`` hold more rows of ``table`` than one task should order?"""
        name = f"{table}.{key}"
        if name not in self._hot:
            self._hot[name] = has_hot_key(self.table(table), [key])
        return self._hot[name]

    def rows(self, table: str) -> int:
        """Rows of a table, read from the footers of its files."""
        if table not in self._rows:
            self._rows[table] = self.table(table).count()
        return self._rows[table]

    @property
    def jobs(self) -> DataFrame:
        return self.projection("fx_jobs")

    @property
    def assets(self) -> DataFrame:
        return self.projection("fx_assets")

    @property
    def events_hot(self) -> bool:
        return self.hot("lineitem", "l_orderkey")

    @property
    def events(self) -> DataFrame:
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
        chunk = [[F.col("l_linenumber")], [floor_div(F.col("l_partkey"), 64)]] if self.events_hot else None
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus"
        )
        numbered = running(
            lines if self.events_hot else spread(lines, "l_orderkey", self.rows("lineitem")),
            ["l_orderkey"],
            [F.col(c) for c in order],
            [Run("event_ord", "rank")],
            chunk,
        )
        return self.spark.sql(f"SELECT {_EVENT_COLUMNS} FROM {{numbered}}", numbered=numbered)

    @property
    def words_hot(self) -> bool:
        if "words" not in self._hot:
            size = F.size(F.split("text", " "))
            self._hot["words"] = has_hot_key(self.table("conversations"), ["conv_id"], size)
        return self._hot["words"]

    @property
    def words(self) -> DataFrame:
        """A spoken clock: every word lasts by its length, pauses follow full stops and commas."""
        hot = self.words_hot
        split = (
            self.table("conversations")
            .select(F.col("conv_id").alias("job_id"), "turn", F.posexplode(F.split("text", " ")).alias("pos", "text"))
            .filter(F.length("text") > 0)
        )
        order = [F.col("turn"), F.col("pos")]
        chunk = [[F.col("turn")], [block_of("pos")]] if hot else None
        ordered = running(
            split, ["job_id"], order, [Run("ord", "rank"), Run("prev", "lag", F.col("text"))], chunk
        )
        sized = self.spark.sql(f"SELECT {_WORD_LENGTHS} FROM {{ordered}}", ordered=ordered)
        clocked = running(
            sized,
            ["job_id"],
            [F.col("ord")],
            [Run("end_ms", "sum", F.expr("gap + dur"))],
            [[chunk_of("ord")]] if hot else None,
        )
        return clocked.select(
            "job_id",
            "ord",
            "text",
            (F.col("end_ms") - F.col("dur")).cast("bigint").alias("start_ms"),
            F.col("end_ms").cast("bigint").alias("end_ms"),
        )

    @property
    def frames(self) -> DataFrame:
        """One gray grid of 8 x 8 cells per row, numbered from 0 inside its clip."""
        vectors = self.table("embeddings").select(F.col("label").alias("clip_id"), "vec_id", "embedding")
        chunk = [[block_of("vec_id")]] if self.hot("embeddings", "label") else None
        numbered = running(vectors, ["clip_id"], [F.col("vec_id")], [Run("frame_ord", "rank")], chunk)
        return numbered.select(
            "clip_id",
            (F.col("frame_ord") - 1).alias("frame_no"),
            F.transform(
                "embedding", lambda e: F.floor((e.cast("double") + 1) * F.lit(127.5)).cast("int")
            ).alias("grid"),
        )

    @property
    def cells(self) -> DataFrame:
        exploded = self.frames.select("clip_id", "frame_no", F.posexplode("grid").alias("cell", "v"))
        return self.spark.sql(f"SELECT {_CELL_COLUMNS} FROM {{exploded}}", exploded=exploded)

    def __getattr__(self, name: str) -> DataFrame:
        if f"fx_{name}" in PROJECTIONS:
            return self.projection(f"fx_{name}")
        raise AttributeError(name)
