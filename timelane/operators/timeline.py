"""Place reactions on each job's clock, fill what lies between, and check the realised clock."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType

from timelane.functions.folds import chain_entries
from timelane.functions.scalars import clamp, floor_div, half_up
from timelane.functions.sides import beside
from timelane.functions.skew import Limits, Run, block_of, chunk_of, has_hot_key, running
from timelane.operators.gates import clip_length, reaction_assets, speech_carriers
from timelane.session import stage

# Fixed values, milliseconds.
LEAD_GAP = 80          # a placed clip starts at least this long after the one before
END_GUARD = 50         # nothing starts this close to the end
COMMENT_GUARD = 100    # a spoken line aims no later than this before the end
FILL_SLACK = 40        # a gap this short is left open
FIXED_CHUNK = 10_500   # v2 fill length
DEFAULT_LOOP = 4_000   # fill length of a clip without a known one
DEFAULT_EVENT = 2_400  # v2 event length
CROSSFADE = 160        # v2 fade
BED_PARTS = 24         # most carriers chained for one spoken line
BED_TOLERANCE = 50
MIN_SEGMENT = 120
FRAMES_PER_SECOND = 30

# Length of the pieces in which a pool is handed to the jobs that reach them.
TAPE_MS = 1 << 18


# ---------------------------------------------------------------- nearest asset

def _choice_ranges(assets: DataFrame, dialect: str) -> DataFrame:
    """Which asset wins for which stretch of (doubled) intensity, per persona and type, cut into buckets.

    Assets collapse to one per distinct middle, first in the library.  Between two neighbours the border is half
    way; a point exactly half way goes to the one earlier in the library.
    """
    big = 1 << 40
    doubled = lambda c, default: F.coalesce(F.col(c).cast("bigint"), F.lit(default))
    pool = reaction_assets(assets, dialect).select(
        "persona",
        F.col("reaction_type").alias("type"),
        (doubled("intensity_min_m", 0) + doubled("intensity_max_m", 1000)).alias("at"),
        F.struct(
            "asset_ord", "asset_id", clip_length().alias("clip_ms"), F.col("peak_ms").cast("bigint").alias("stored_peak_ms")
        ).alias("asset"),
    )
    points = pool.groupBy("persona", "type", "at").agg(F.min_by("asset", "asset.asset_ord").alias("asset"))
    near = Window.partitionBy("persona", "type").orderBy("at")
    sided = points.select(
        "*",
        *[
            fn(c).over(near).alias(f"{side}_{name}")
            for side, fn in (("prev", F.lag), ("next", F.lead))
            for name, c in (("at", F.col("at")), ("ord", F.col("asset.asset_ord")))
        ],
    )
    border = lambda low, high, low_ord, high_ord: floor_div(low + high, 2) - F.when(
        (F.pmod(low + high, F.lit(2)) == 0) & (low_ord > high_ord), 1
    ).otherwise(0)
    own = F.col("asset.asset_ord")
    low = F.coalesce(border(F.col("prev_at"), F.col("at"), F.col("prev_ord"), own) + 1, F.lit(-big))
    high = F.coalesce(border(F.col("at"), F.col("next_at"), own, F.col("next_ord")), F.lit(big))
    ranges = sided.select("persona", "type", low.alias("_low"), high.alias("_high"), "asset").filter("_low <= _high")
    return ranges.withColumn("_bucket", F.explode(F.sequence(_intensity_bucket(F.col("_low")), _intensity_bucket(F.col("_high")))))


def _intensity_bucket(doubled):
    """Buckets of 64 over the usual range 0..2000; what lies outside joins the outer buckets."""
    return floor_div(clamp(doubled, 0, 2000), 64)


def nearest_asset(events: DataFrame, assets: DataFrame, dialect: str = "v4") -> DataFrame:
    """Per event the asset of its persona and type whose intensity middle lies nearest; first in the library wins.

    Events never meet all assets of their type: the catalog is first turned into ranges of intensity with one
    winner each, so an event finds its asset by an equality join on a bucket and a range test.
    """
    ranges = _choice_ranges(assets, dialect)
    aimed = events.withColumn("_at", 2 * F.coalesce(F.col("intensity_m").cast("bigint"), F.lit(350))).withColumn(
        "_bucket", _intensity_bucket(F.col("_at"))
    )
    a, r = aimed.alias("a"), beside(ranges).alias("r")
    same = [F.col(f"a.{c}") == F.col(f"r.{c}") for c in ("persona", "type", "_bucket")]
    within = F.col("a._at").between(F.col("r._low"), F.col("r._high"))
    return a.join(r, [*same, within], "left").select(
        *[f"a.{c}" for c in events.columns], "r.asset.asset_id", "r.asset.clip_ms", "r.asset.stored_peak_ms"
    )


def peak_offset(stored, duration):
    """Where inside a clip its reaction lands: the measured peak if it lies inside, else the middle."""
    return F.when((stored > 0) & (stored < duration), stored).otherwise(floor_div(duration, 2))


# ---------------------------------------------------------------- placement

def place_reactions(events: DataFrame, dialect: str = "v4", split: bool | None = None) -> DataFrame:
    """Start and length of every event that still fits, per job in event order.

    The sequential rule "start at the target, but 80 ms after the previous end" has a closed form: with C the
    running sum of (length + 80) over earlier events, start = max(80, running max of (target - C)) + C.
    Starts grow strictly, so stopping at the first one past the end is a filter.
    """
    split = has_hot_key(events, ["job_id"]) if split is None else split
    total, time = F.col("total_ms"), F.col("time_ms").cast("bigint")
    spoken = F.col("comment").isNotNull()
    on_clock = clamp(time, F.lit(0), F.greatest(F.lit(0), total - COMMENT_GUARD))
    if dialect == "v4":
        length = F.when(spoken, F.col("voice_ms")).otherwise(F.col("clip_ms"))
        target = F.when(spoken, on_clock).otherwise(time - peak_offset(F.col("stored_peak_ms"), F.col("clip_ms")))
    else:
        plain = clamp(F.coalesce(F.col("duration_ms").cast("bigint"), F.lit(DEFAULT_EVENT)), 800, 8000)
        length = F.when(spoken, clamp(F.greatest(plain, F.col("voice_ms") + 300), 1200, 8000)).otherwise(plain)
        target = on_clock
    aimed = events.select("*", length.cast("bigint").alias("_d"), target.cast("bigint").alias("_t"))
    chunk = [[chunk_of("event_no")]] if split else None
    # The order of event_no, spelled as it was when the events were numbered: they are still sorted that way.
    order = [F.col("time_ms"), F.col("event_ord")]
    spent = running(aimed, ["job_id"], order, [Run("_c", "sum_before", F.col("_d") + LEAD_GAP)], chunk)
    if split:
        spent = stage(spent, "spent")
    ahead = running(spent, ["job_id"], order, [Run("_ahead", "max", F.col("_t") - F.col("_c"))], chunk)
    start = F.greatest(F.lit(LEAD_GAP), F.col("_ahead")) + F.col("_c")
    placed = ahead.withColumn("start_ms", start).filter(F.col("start_ms") < total - END_GUARD)
    kept = placed.withColumn("placed_ms", F.least(F.col("_d"), total - F.col("start_ms")))
    return kept.select(
        "job_id",
        "persona",
        "total_ms",
        "event_no",
        "time_ms",
        "type",
        "comment",
        "voice_ms",
        "asset_id",
        F.when(spoken, "comment").otherwise("reaction").alias("kind"),
        "start_ms",
        F.col("placed_ms").alias("duration_ms"),
        peak_offset(F.col("stored_peak_ms"), F.col("placed_ms")).alias("peak_ms"),
        (F.col("start_ms") > F.col("_t")).alias("pushed"),
    )


def open_gaps(placed: DataFrame, jobs: DataFrame, split: bool = False) -> DataFrame:
    """The stretches a job's placed clips leave open, numbered without gaps: one before each clip and a tail."""
    ends = F.col("start_ms") + F.col("duration_ms")
    chunk = [[chunk_of("event_no")]] if split else None
    lagged = running(placed, ["job_id"], [F.col("event_no")], [Run("_prev", "lag", ends)], chunk)
    before = lagged.select(
        "job_id",
        "persona",
        F.col("event_no").alias("gap_no"),
        F.coalesce("_prev", F.lit(0)).cast("bigint").alias("gap_start_ms"),
        F.col("start_ms").alias("gap_end_ms"),
    )
    last = placed.groupBy("job_id").agg(F.max("event_no").alias("_n"), F.max(ends).alias("_end"))
    tails = jobs.join(last, "job_id", "left").select(
        "job_id",
        "persona",
        (F.coalesce("_n", F.lit(0)) + 1).cast("bigint").alias("gap_no"),
        F.coalesce("_end", F.lit(0)).cast("bigint").alias("gap_start_ms"),
        F.col("total_ms").cast("bigint").alias("gap_end_ms"),
    )
    return before.unionByName(tails.filter("gap_start_ms < gap_end_ms"))


# ---------------------------------------------------------------- round robin over a pool

def cycle_tape(pool: DataFrame) -> DataFrame:
    """Number a persona's clips in library order with the time before each, the pool size and the cycle length."""
    length = clip_length()
    sized = pool.select(
        "persona", "asset_ord", "asset_id", F.when(length > 0, length).otherwise(F.lit(DEFAULT_LOOP)).cast("bigint").alias("clip_ms")
    )
    runs = [Run("_rank", "rank"), Run("before_ms", "sum_before", F.col("clip_ms"))]
    split = has_hot_key(pool, ["persona"])
    laid = running(sized, ["persona"], [F.col("asset_ord")], runs, [[block_of("asset_ord")]] if split else None)
    if split:
        totals = sized.groupBy("persona").agg(F.count(F.lit(1)).alias("pool_size"), F.sum("clip_ms").alias("cycle_ms"))
        laid = laid.join(totals, "persona")
    else:
        whole = Window.partitionBy("persona")
        laid = laid.select(
            "*", F.count(F.lit(1)).over(whole).alias("pool_size"), F.sum("clip_ms").over(whole).alias("cycle_ms")
        )
    return laid.select(
        "persona", (F.col("_rank") - 1).alias("pos"), "asset_id", "clip_ms", "before_ms", "pool_size", "cycle_ms"
    )


def _with_reach(grouped: DataFrame, tape: DataFrame) -> DataFrame:
    """Rows with the clips (lengths, in order) that they can reach, whatever the size of the pool.

    A job starts at the first clip, and a need overshoots by less than one clip, so ``reach_ms`` from the start of the
    cycle is all it can meet: never more clips than the job itself could be filled with.  The tape lies in pieces of
    TAPE_MS; a row is joined with those it reaches, nearly always the first alone.
    """
    pieces = tape.groupBy("persona", floor_div(F.col("before_ms"), TAPE_MS).alias("_piece")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "clip_ms"))), lambda c: c["clip_ms"]).alias("_clips")
    )
    pools = tape.groupBy("persona").agg(
        F.max("pool_size").alias("pool_size"), F.max("cycle_ms").alias("cycle_ms"), F.max("clip_ms").alias("_longest")
    )
    reach = F.least(F.col("cycle_ms"), F.col("_need") + F.col("_needs") * F.col("_longest"))
    last = floor_div(F.greatest(reach, F.lit(1)) - 1, TAPE_MS)
    spread = grouped.join(beside(pools), "persona").withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    met = spread.join(beside(pieces), ["persona", "_piece"])
    rest = [c for c in grouped.columns if c not in ("job_id", "persona", "chunk", "_need", "_needs")]
    return met.groupBy("job_id", "persona", "chunk").agg(
        *[F.first(c).alias(c) for c in (*rest, "pool_size", "cycle_ms")],
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_piece", "_clips"))), lambda p: p["_clips"])).alias("clips"),
    )


class _Tapes:
    """Prefix sums of the clips of many rows in one rising array, so that one search serves all rows."""

    def __init__(self, clips: pa.Array, pool_size: np.ndarray, cycle_ms: np.ndarray):
        lengths = pc.list_value_length(clips).to_numpy()
        ends = np.cumsum(lengths)
        self.head = ends - lengths + np.arange(len(lengths))
        total = np.append(0, np.cumsum(clips.flatten().to_numpy()))
        self.before = np.zeros(len(total) - 1 + len(lengths), dtype=np.int64)
        first = np.zeros(len(self.before), dtype=bool)
        first[self.head] = True
        self.before[~first] = total[1:]
        base = total[ends - lengths]
        self.before[self.head] = base
        self.before -= np.repeat(base, lengths + 1)
        self.size, self.cycle = pool_size, cycle_ms
        self.apart = np.arange(len(lengths)) * (int(self.before.max(initial=0)) + int(cycle_ms.max(initial=0)) + 1)
        self.rising = self.before + np.repeat(self.apart, lengths + 1)

    def taken(self, row: np.ndarray, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """How many clips from ``at`` on cover ``target`` ms: whole turns, then up to the first boundary not before it."""
        cycle = self.cycle[row]
        turns = (target - 1) // cycle
        end = self.before[self.head[row] + at] + target - turns * cycle
        wrapped = end > cycle
        stop = np.searchsorted(self.rising, end - wrapped * cycle + self.apart[row]) - self.head[row]
        return np.where(target > 0, (turns + wrapped) * self.size[row] + stop - at, 0)

    def passed(self, row: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Length of ``count`` clips from ``at`` on."""
        turns, rest = np.divmod(at + count, self.size[row])
        return turns * self.cycle[row] + self.before[self.head[row] + rest] - self.before[self.head[row] + at]


def cycle_cover(needs: DataFrame, tape: DataFrame, slack_ms: int = 0, at_most: int | None = None, split: bool = False) -> DataFrame:
    """Serve needs (job_id, persona, seq without gaps, need_ms, carried) from the pool in turn, never restarting in a job.

    Adds ``first_index``, ``taken`` and, for the clips first_index, first_index+1, ... (modulo the pool) that are
    taken until no more than ``slack_ms`` stays uncovered or ``at_most`` are used up, their length ``covered_ms``,
    plus ``base_ms`` (where the first lies in the cycle), ``pool_size`` and ``cycle_ms``.

    A batch takes the first need of all its rows at once, then the second, and so on.  Long jobs are cut into chunks
    whose tables "clip on entry -> clip on exit" are chained by levels (``functions.folds``).
    """
    piece = chunk_of("seq") if split else F.lit(0).cast("bigint")
    met = [F.sum(F.greatest(F.col("need_ms"), F.lit(0))).alias("_need"), F.count(F.lit(1)).alias("_needs")]
    grouped = (
        needs.select("job_id", "persona", piece.alias("chunk"), "need_ms", F.struct("seq", "need_ms", "carried").alias("need"))
        .groupBy("job_id", "persona", "chunk")
        .agg(F.array_sort(F.collect_list("need")).alias("needs"), *met)  # at most chunk_rows, or split_rows when unsplit
        .select("job_id", "persona", "chunk", "needs.seq", "needs.need_ms", "needs.carried", "_need", "_needs")
    )
    if split:
        grouped = grouped.drop("_need", "_needs").join(needs.groupBy("job_id").agg(*met), "job_id")
    grouped = _with_reach(grouped, tape)

    if split:
        def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tapes = _Tapes(batch["clips"], batch["pool_size"].to_numpy(), batch["cycle_ms"].to_numpy())
                lengths = pc.list_value_length(batch["clips"]).to_numpy()
                tables = []
                for i, wants in enumerate(batch["need_ms"]):
                    state = np.arange(lengths[i], dtype=np.int64)
                    row = np.full(len(state), i)
                    for want in wants.values.to_numpy() - slack_ms:
                        count = tapes.taken(row, state, want)
                        if at_most is not None:
                            count = np.minimum(count, at_most)
                        # Entries that the job cannot reach may lead anywhere inside.
                        state = np.minimum((state + count) % tapes.size[i], lengths[i] - 1)
                    tables.append(state)
                table = pa.array(tables, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch["job_id"], batch["chunk"], table], names=["job_id", "chunk", "step"])

        schema = grouped.select("job_id", "chunk").schema.add("step", ArrayType(LongType()))
        many = needs.filter(F.col("seq") > Limits.chunk_rows).select("job_id").distinct()
        tables = grouped.join(many, "job_id", "left_semi").select("job_id", "chunk", "need_ms", "clips", "pool_size", "cycle_ms")
        grouped = grouped.join(chain_entries(tables.mapInArrow(steps, schema), "job_id"), ["job_id", "chunk"], "left")
    else:
        grouped = grouped.withColumn("entry", F.lit(0).cast("bigint"))

    names = ("seq", "need_ms", "carried", "first_index", "taken", "covered_ms", "base_ms", "pool_size", "cycle_ms")

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, cycle = batch["pool_size"].to_numpy(), batch["cycle_ms"].to_numpy()
            tapes = _Tapes(batch["clips"], size, cycle)
            n = pc.list_value_length(batch["seq"]).to_numpy()
            first, order = np.cumsum(n) - n, np.argsort(-n, kind="stable")
            wants = batch["need_ms"].flatten().to_numpy()
            index, taken, covered, base = np.zeros((4, len(wants)), dtype=np.int64)
            at = batch["entry"].fill_null(0).to_numpy().copy()
            for turn in range(int(n.max(initial=0))):
                row = order[: np.searchsorted(-n[order], -turn)]
                here = first[row] + turn
                count = tapes.taken(row, at[row], wants[here] - slack_ms)
                if at_most is not None:
                    count = np.minimum(count, at_most)
                index[here], taken[here] = at[row], count
                covered[here] = tapes.passed(row, at[row], count)
                base[here] = tapes.before[tapes.head[row] + at[row]]
                at[row] = (at[row] + count) % size[row]
            owner = pa.array(np.repeat(np.arange(len(n)), n))
            arrays = [batch["seq"].flatten(), batch["need_ms"].flatten(), batch["carried"].flatten()]
            arrays += [pa.array(x) for x in (index, taken, covered, base)]
            arrays += [batch[c].take(owner) for c in ("pool_size", "cycle_ms")]
            yield pa.RecordBatch.from_arrays([batch["job_id"].take(owner), batch["persona"].take(owner), *arrays], names=["job_id", "persona", *names])

    schema = grouped.select("job_id", "persona").schema
    for name in names:
        schema = schema.add(name, LongType())
    return grouped.select(
        "job_id", "persona", "seq", "need_ms", "carried", "clips", "pool_size", "cycle_ms", "entry"
    ).mapInArrow(serve, schema)


def _each_taken(served: DataFrame, block: int = 1024) -> DataFrame:
    """One row per taken clip.  Two short explodes instead of one array as long as the largest gap."""
    blocks = served.filter("taken > 0").withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), floor_div(F.col("taken") - 1, block)))
    )
    low = F.col("_block") * block
    return blocks.withColumn(
        "k", F.explode(F.sequence(low, F.least(low + (block - 1), F.col("taken") - 1)))
    ).drop("_block")


def neutral_pool(assets: DataFrame, dialect: str = "v4") -> DataFrame:
    return reaction_assets(assets, dialect).filter(F.col("reaction_type") == "neutral")


def fill_counts(gaps: DataFrame, assets: DataFrame, split: bool = False) -> DataFrame:
    """Per job how many clips fill its gaps, without making any of them a row."""
    served = cycle_cover(_gap_needs(gaps), stage(cycle_tape(neutral_pool(assets)), "tape"), FILL_SLACK, split=split)
    return served.groupBy("job_id").agg(F.sum("taken").alias("fill_count"))


def _gap_needs(gaps: DataFrame) -> DataFrame:
    return gaps.select(
        "job_id", "persona", F.col("gap_no").cast("bigint").alias("seq"),
        (F.col("gap_end_ms") - F.col("gap_start_ms")).cast("bigint").alias("need_ms"),
        F.col("gap_start_ms").cast("bigint").alias("carried"),
    )


def fill_gaps_cyclic(gaps: DataFrame, assets: DataFrame, split: bool = False) -> DataFrame:
    """Fill every gap with whole neutral clips in round robin; the turn carries on from gap to gap of a job."""
    tape = stage(cycle_tape(neutral_pool(assets)), "tape")
    place = F.col("first_index") + F.col("k")
    clips = _each_taken(cycle_cover(_gap_needs(gaps), tape, FILL_SLACK, split=split)).select(
        "*", F.pmod(place, F.col("pool_size")).alias("pos"), F.call_function("div", place, F.col("pool_size")).alias("turn")
    )
    laid = clips.join(beside(tape.select("persona", "pos", "asset_id", "clip_ms", "before_ms")), ["persona", "pos"])
    offset = F.col("turn") * F.col("cycle_ms") + F.col("before_ms") - F.col("base_ms")
    return laid.select(
        "job_id",
        F.col("seq").alias("gap_no"),
        F.col("k").alias("chunk_no"),
        "asset_id",
        (F.col("carried") + offset).alias("start_ms"),
        F.least(F.col("need_ms") - offset, F.col("clip_ms")).alias("duration_ms"),
    )


def fill_gaps_fixed(gaps: DataFrame, assets: DataFrame, split: bool = False) -> DataFrame:
    """v2 fill: chunks of 10.5 s; the asset is the running chunk count modulo the pool."""
    room = F.col("gap_end_ms") - F.col("gap_start_ms")
    counted = gaps.withColumn(
        "taken", F.when(room > FILL_SLACK, F.ceil((room - FILL_SLACK) / FIXED_CHUNK)).otherwise(0).cast("bigint")
    )
    chunk = [[chunk_of("gap_no")]] if split else None
    numbered = running(counted, ["job_id"], [F.col("gap_no")], [Run("_used", "sum_before", F.col("taken"))], chunk)
    pool = neutral_pool(assets, "v2")
    sizes = pool.groupBy("persona").agg(F.count(F.lit(1)).alias("pool_size"))
    tape = cycle_tape(pool)
    chunks = _each_taken(numbered.join(sizes, "persona")).withColumn(
        "pos", F.pmod(F.col("_used") + F.col("k"), F.col("pool_size"))
    )
    start = F.col("gap_start_ms") + F.col("k") * FIXED_CHUNK
    return chunks.join(tape.select("persona", "pos", "asset_id"), ["persona", "pos"]).select(
        "job_id",
        "gap_no",
        F.col("k").alias("chunk_no"),
        "asset_id",
        start.alias("start_ms"),
        F.least(F.col("gap_end_ms") - start, F.lit(FIXED_CHUNK)).alias("duration_ms"),
    )


def cover_with_cycle(lines: DataFrame, assets: DataFrame, split: bool = False) -> DataFrame:
    """Chain speech carriers in turn under every spoken line (job_id, persona, seq, need_ms), 24 at most."""
    needs = lines.withColumn("carried", F.lit(0).cast("bigint"))
    served = cycle_cover(needs, stage(cycle_tape(speech_carriers(assets)), "tape"), 0, BED_PARTS, split)
    return served.select(
        "job_id", "seq", "need_ms", "first_index", F.col("taken").alias("parts"), "covered_ms",
        (F.col("covered_ms") + BED_TOLERANCE < F.col("need_ms")).alias("too_short"),
    )


# ---------------------------------------------------------------- clocks over segments

def has_long_job(jobs: DataFrame) -> bool:
    """True when some job lasts so long that its fill alone may make more segments than one task should order.

    Declared clip lengths start at 0.2 s, so a job has about five segments per second at most.
    """
    return not jobs.filter(F.col("total_ms") > 200 * Limits.split_rows).limit(1).isEmpty()


def number_segments(segments: DataFrame, split: bool = False) -> DataFrame:
    """Segment number by start; segments of a job never share a start, so a block of starts is a bounded chunk."""
    chunk = [[block_of("start_ms")]] if split else None
    if split:
        segments = stage(segments, "segments")
    return running(segments, ["job_id"], [F.col("start_ms")], [Run("seg_no", "rank")], chunk)


def realised_clock(segments: DataFrame, split: bool = False) -> DataFrame:
    """Where segments really land once concatenated: whole frames, at least 0.12 s each, in numbered order."""
    frames = half_up(F.greatest(F.lit(MIN_SEGMENT), F.col("duration_ms")) * FRAMES_PER_SECOND / 1000)
    counted = segments.withColumn("frames", frames)
    chunk = [[chunk_of("seg_no")]] if split else None
    summed = running(counted, ["job_id"], [F.col("seg_no")], [Run("frames_before", "sum_before", F.col("frames"))], chunk)
    realised = half_up(F.col("frames_before") * 1000 / FRAMES_PER_SECOND)
    return summed.select(
        "job_id", "seg_no", "start_ms", "duration_ms", "frames", "frames_before",
        realised.alias("realised_start_ms"), (realised - F.col("start_ms")).alias("drift_ms"),
    )


def clock_verdict(segments: DataFrame, jobs: DataFrame) -> DataFrame:
    """Per job: shortfall against the wanted length and what becomes of it."""
    frames = half_up(F.greatest(F.lit(MIN_SEGMENT), F.col("duration_ms")) * FRAMES_PER_SECOND / 1000)
    merged = segments.groupBy("job_id").agg(F.sum(frames).alias("_frames"))
    length = half_up(F.col("_frames") * 1000 / FRAMES_PER_SECOND)
    short = F.col("total_ms") - F.col("merged_ms")
    # Padding and trimming both end at the wanted length, so only an untrimmed surplus could still drift.
    return (
        jobs.join(merged, "job_id")
        .withColumn("merged_ms", length)
        .select(
            "job_id", "total_ms", "merged_ms", short.alias("shortfall_ms"),
            F.when(short > 1000, "fail_short").when(short > 5, "pad").otherwise("trim").alias("verdict"),
        )
    )


def crossfade_offsets(segments: DataFrame, split: bool = False) -> DataFrame:
    """v2 dissolves in thousandths of a millisecond: fade, and offset of each transition on the merged clock."""
    micros = F.col("duration_ms").cast("bigint") * 1000
    chunk = [[chunk_of("seg_no")]] if split else None
    order = [F.col("seg_no")]
    lagged = running(segments.withColumn("_us", micros), ["job_id"], order, [Run("_prev", "lag", F.col("_us"))], chunk)
    fade = F.least(F.lit(CROSSFADE * 1000), floor_div(F.col("_prev"), 3), floor_div(F.col("_us"), 3))
    faded = lagged.withColumn("fade_us", F.when(F.col("_prev").isNotNull(), fade))
    if split:
        faded = stage(faded, "faded")
    gained = F.col("_us") - F.coalesce("fade_us", F.lit(0))
    summed = running(faded, ["job_id"], order, [Run("_cum", "sum_before", gained)], chunk)
    return summed.filter("fade_us IS NOT NULL").select(
        "job_id", "seg_no", "fade_us", F.greatest(F.lit(10_000), F.col("_cum") - F.col("fade_us")).alias("offset_us")
    )


def box_coverage(frames: DataFrame) -> DataFrame:
    """Per clip: frames with a valid box of all, and whether it fails for want of any."""
    return frames.groupBy("clip_id").agg(
        F.count_if(F.col("box").isNotNull()).alias("valid"), F.count(F.lit(1)).alias("total"), (F.count_if(F.col("box").isNotNull()) == 0).alias("failed")
    )


def forward_fill_boxes(frames: DataFrame, split: bool | None = None) -> DataFrame:
    """Carry the last valid box (clip_id, frame_no, box) forward; leading frames without one stay empty."""
    split = has_hot_key(frames, ["clip_id"]) if split is None else split
    chunk = [[block_of("frame_no")]] if split else None
    filled = running(frames, ["clip_id"], [F.col("frame_no")], [Run("filled", "last", F.col("box"))], chunk)
    return filled.select("clip_id", "frame_no", F.col("box").isNotNull().alias("valid"), F.col("filled").alias("box"))
