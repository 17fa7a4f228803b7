"""Word timings to short caption lines, and caption documents.

Both dialects are greedy: where a line starts depends on where the one before started.  A line holds at most
five words, so the state at any point is an offset of 0 to 4 words.  Long transcripts are cut into chunks that
are solved for each of the five offsets, chained, and then solved for real (see ``functions.folds``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from timelane.functions.folds import chain_entries, group_starts, whole_groups
from timelane.functions.scalars import clock, floor_div
from timelane.functions.skew import Limits, Run, block_of, chunk_of, has_hot_key, running
from timelane.session import stage

# Fixed values.
MAX_WORDS = 5
MAX_LINE_MS = 2_400
MAX_PAUSE_MS = 700
MIN_HOLD_MS = 500

# Cues of a caption document in one row.
PART_CUES = 4096


def _next_start(frame: pd.DataFrame, bounds: np.ndarray, dialect: str) -> np.ndarray:
    """For every word: where the next line would start if a line started here."""
    start, end = frame["start_ms"].to_numpy(), frame["end_ms"].to_numpy()
    n = len(frame)
    limit = np.repeat(bounds[1:], np.diff(bounds))
    here = np.arange(n)
    following = np.minimum(here + MAX_WORDS, limit)
    for ahead in range(MAX_WORDS - 1, 0, -1):
        at = here + ahead
        inside = at < limit
        at = np.minimum(at, n - 1)
        if dialect == "lines":
            breaks = (end[at] - start > MAX_LINE_MS) | (start[at] - end[at - 1] > MAX_PAUSE_MS)
        else:
            breaks = end[at - 1] - start >= MAX_LINE_MS
        following = np.where(inside & breaks, here + ahead, following)
    return following


def _greedy(words: DataFrame, dialect: str, split: bool) -> DataFrame:
    source = words.select("job_id", "ord", "text", "start_ms", "end_ms")
    if split:
        source = words = stage(source, "words")
        # A chunk also sees the first words of the next one, to finish a line begun in it.
        block = chunk_of("ord")
        halo = (F.pmod(F.col("ord") - 1, F.lit(Limits.chunk_rows)) < MAX_WORDS) & (block > 0)
        source = source.withColumn(
            "chunk", F.explode(F.when(halo, F.array(block, block - 1)).otherwise(F.array(block)))
        ).withColumn("own", F.col("chunk") == block)
    else:
        source = source.withColumn("chunk", F.lit(0).cast("bigint")).withColumn("own", F.lit(True))
    keys = ["job_id", "chunk"]

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            bounds = group_starts(frame, keys)
            following = _next_start(frame, bounds, dialect).tolist()
            own = frame["own"].to_numpy()
            jobs, chunks, steps = [], [], []
            for low, high in zip(bounds[:-1], bounds[1:]):
                if own[low:high].all():
                    continue  # the last chunk of a job leads nowhere
                stop = low + int(own[low:high].sum())
                table = []
                for entry in range(MAX_WORDS):
                    at = low + entry
                    while at < stop:
                        at = following[at]
                    table.append(int(at - stop))
                jobs.append(frame["job_id"].iat[low])
                chunks.append(frame["chunk"].iat[low])
                steps.append(table)
            if jobs:
                yield pd.DataFrame({"job_id": jobs, "chunk": chunks, "step": steps})

    placed = source
    if split:
        long_jobs = words.filter(F.col("ord") > Limits.chunk_rows).select("job_id").distinct()
        maps = (
            source.join(long_jobs, "job_id", "left_semi")
            .repartition(*keys)
            .sortWithinPartitions(*keys, "ord")
            .mapInPandas(exits, source.select(*keys).schema.add("step", ArrayType(LongType())))
        )
        placed = source.join(chain_entries(maps, "job_id"), keys, "left")
    else:
        placed = source.withColumn("entry", F.lit(0).cast("bigint"))

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            bounds = group_starts(frame, keys)
            following = _next_start(frame, bounds, dialect).tolist()
            own = frame["own"].to_numpy()
            entries = frame["entry"].fillna(0).astype("int64").to_numpy()
            firsts, nexts = [], []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                stop = low + int(own[low:high].sum())
                at = low + int(entries[low])
                while at < stop:
                    firsts.append(at)
                    at = following[at]
                    nexts.append(at)
            if not firsts:
                continue
            first, last = np.array(firsts, dtype=int), np.array(nexts, dtype=int) - 1
            start, end = frame["start_ms"].to_numpy()[first], frame["end_ms"].to_numpy()[last]
            if dialect == "lines":
                end = np.maximum(end, start + MIN_HOLD_MS)
            text = frame["text"].tolist()
            joined = [
                " ".join(t for t in text[a : b + 1] if dialect == "lines" or t.strip()) for a, b in zip(first, last)
            ]
            yield pd.DataFrame(
                {
                    "job_id": frame["job_id"].to_numpy()[first],
                    "first_ord": frame["ord"].to_numpy()[first],
                    "words": last - first + 1,
                    "start_ms": start,
                    "end_ms": end,
                    "text": joined,
                }
            )

    schema = source.select("job_id").schema
    for name in ("first_ord", "words", "start_ms", "end_ms"):
        schema = schema.add(name, LongType())
    return (
        placed.repartition(*(keys if split else keys[:1]))
        .sortWithinPartitions(*keys, "ord")
        .mapInPandas(lines, schema.add("text", StringType()))
    )


def caption_lines(words: DataFrame, split: bool | None = None) -> DataFrame:
    """Break before a word that would be the sixth, stretch the line past 2.4 s, or follow a pause over 0.7 s.

    ``ord`` counts a job's words from 1 without gaps.  A line is held at least half a second.
    """
    return _greedy(words, "lines", has_hot_key(words, ["job_id"]) if split is None else split)


def caption_cues(words: DataFrame, split: bool | None = None) -> DataFrame:
    """Clip dialect: close a cue after its fifth word or once it lasts 2.4 s; pauses do not matter."""
    return _greedy(words, "cues", has_hot_key(words, ["job_id"]) if split is None else split)


# Caption document formats.
ASS_HEADER = (
    "[Script Info]",
    "ScriptType: v4.00+",
    "PlayResX: 1080",
    "PlayResY: 1920",
    "WrapStyle: 2",
    "",
    "[V4+ Styles]",
    "Format: Name, Fontname, Fontsize, PrimaryColour, OutlineColour, BackColour, Bold, Italic, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding",
    "Style: Caption,DejaVu Sans,64,&H00FFFFFF,&H00000000,&H00000000,1,0,1,5,2,{alignment},90,90,{margin},1",
    "",
    "[Events]",
    "Format: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text",
)


def ass_header(alignment: Column, margin: Column) -> Column:
    text = F.lit("\n".join(ASS_HEADER))
    filled = F.replace(text, F.lit("{alignment}"), alignment.cast("string"))
    return F.replace(filled, F.lit("{margin}"), margin.cast("string"))


def caption_rows(lines: DataFrame, fmt: str, split: bool = False) -> DataFrame:
    """One text row per line, ready to be written in order: an SRT cue or an ASS dialogue."""
    chunk = [[block_of("first_ord")]] if split else None
    numbered = running(lines, ["job_id"], [F.col("first_ord")], [Run("cue", "rank")], chunk)
    if fmt == "srt":
        stamp = lambda c: clock(F.col(c), ",", 2, 3)
        row = F.concat(F.col("cue").cast("string"), F.lit("\n"), stamp("start_ms"), F.lit(" --> "), stamp("end_ms"), F.lit("\n"), F.col("text"), F.lit("\n"))
    else:
        stamp = lambda c: clock(F.col(c), ".", 1, 2)
        row = F.concat(
            F.lit("Dialogue: 0,"), stamp("start_ms"), F.lit(","), stamp("end_ms"), F.lit(",Caption,,0,0,0,,"),
            F.replace(F.col("text"), F.lit("\n"), F.lit(" ")),
        )
    return numbered.select("job_id", "cue", row.alias("row"))


def export_captions(lines: DataFrame, fmt: str, layout: DataFrame | None = None, split: bool = False) -> DataFrame:
    """Caption documents in parts of at most PART_CUES cues (job_id, part, document).

    The parts of a job, put together in order, are its document; nearly every job has just part 0.
    """
    rows = caption_rows(lines, fmt, split).withColumn("part", floor_div(F.col("cue") - 1, PART_CUES))
    ordered = F.array_sort(F.collect_list(F.struct("cue", "row")))
    body = F.array_join(F.transform(ordered, lambda r: r["row"]), "\n")
    parts = rows.groupBy("job_id", "part").agg(body.alias("body"))
    if fmt == "srt":
        return parts.select("job_id", "part", F.concat(F.when(F.col("part") > 0, "\n").otherwise(""), "body").alias("document"))
    headed = parts.join(layout.select("job_id", "caption_alignment", "caption_margin"), "job_id")
    header = F.concat(ass_header(F.col("caption_alignment"), F.col("caption_margin")), F.lit("\n"))
    return headed.select(
        "job_id", "part", F.concat(F.when(F.col("part") == 0, header).otherwise(""), "body", F.lit("\n")).alias("document")
    )
