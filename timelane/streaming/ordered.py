"""Keyed state for streams whose rule runs in time order: rows wait until the watermark has passed them.

A row that comes late, but within the watermark, still takes its place, so answers do not depend on how rows fall into
batches.  State per key is what waits behind the watermark and one small record; more waiting rows than can be sorted
at once are read in stretches of time, so a key with very many of them is never held whole.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import batched, islice

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessorHandle, TimerValues

#: Rows that are sorted at once, and the width of the stretches that rows are counted by.
SORTED_ROWS, STRETCH_US = 50_000, 60_000_000
APPENDED_ROWS = 1_000


def named(schema: str) -> Row:
    """A maker of rows with the names of a schema of plain columns."""
    return Row(*(column.split()[0] for column in schema.split(", ")))


class InOrder(StatefulProcessor):
    """Waiting rows start with (at_us, seq).  Subclasses say which rows matter and what a row in its turn does."""

    waiting_schema = record_schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.record = handle.getValueState("record", self.record_schema)

    def wait(self, rows: Iterable[tuple]) -> None:
        """Keep rows for later and wake up once the watermark has passed the first of them."""
        first = None
        for some in batched(rows, APPENDED_ROWS):
            self.waiting.appendList(list(some))
            least = min(row[0] for row in some)
            first = least if first is None else min(first, least)
        if first is not None:
            self.wake(first)

    def wake(self, at_us: int) -> None:
        self.handle.registerTimer(-(-at_us // 1000))

    def in_order(self, until_us: int | None = None) -> Iterator[tuple]:
        """Waiting rows up to ``until_us`` by (at_us, seq); more than can be sorted at once come in bounded stretches of time."""
        due = lambda: (row for row in map(tuple, self.waiting.get()) if until_us is None or row[0] <= until_us)
        all_due = due()
        rows = list(islice(all_due, SORTED_ROWS + 1))
        if len(rows) <= SORTED_ROWS:
            yield from sorted(rows, key=lambda row: row[:2])
            return
        counts = Counter(row[0] // STRETCH_US for row in rows)
        del rows
        counts.update(row[0] // STRETCH_US for row in all_due)
        counts = sorted(counts.items())
        while counts:
            n_rows, first = 0, counts[0][0]
            while counts and (not n_rows or n_rows + counts[0][1] <= SORTED_ROWS):
                last, n = counts.pop(0)
                n_rows += n
            yield from sorted((row for row in due() if first <= row[0] // STRETCH_US <= last), key=lambda row: row[:2])

    def forget(self, until_us: int) -> None:
        """Waiting rows up to ``until_us`` go; the rest, no more than lies behind the watermark, waits on."""
        rest = [row for row in map(tuple, self.waiting.get()) if row[0] > until_us]
        self.waiting.clear()
        self.wait(rest)

    def close(self) -> None:
        pass


class Grouped(InOrder):
    """Many keys in one group of state: calls for state cost time by group, so they do not grow with the number of keys.

    Records, one per key that is still open, are read and put back as one list.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.records = handle.getListState("records", self.record_schema)

    def keep(self, records: list[tuple]) -> None:
        if records:
            self.records.put(records)
        else:
            self.records.clear()


class FirstPerHorizon(Grouped):
    """A request passes unless one of its key has passed less than ``horizon_us`` before it."""

    record_schema = "cache_key string, passed_us bigint"

    def __init__(self, schema: str, horizon_us: int):
        self.waiting_schema, self.horizon_us = schema, horizon_us
        self.out = named(schema)
        names = [column.split()[0] for column in schema.split(", ")]
        self.width, self.key_at = len(names), names.index("cache_key")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        passed = dict(map(tuple, self.records.get()))
        # What has passed is before all that waits, so a repeat of it stays one whatever else comes.
        self.wait(row[: self.width] for row in map(tuple, rows) if row[self.key_at] not in passed or row[0] - passed[row[self.key_at]] >= self.horizon_us)
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        until_us = timerValues.getCurrentWatermarkInMs() * 1000
        passed = dict(map(tuple, self.records.get()))
        for row in self.in_order(until_us):
            last = passed.get(row[self.key_at])
            if last is None or row[0] - last >= self.horizon_us:
                passed[row[self.key_at]] = row[0]
                yield self.out(*row)
        self.forget(until_us)
        live = [(k, at_us) for k, at_us in passed.items() if at_us + self.horizon_us > until_us]
        self.keep(live)
        if live:
            self.wake(min(at_us for _, at_us in live) + self.horizon_us)


class CappedRuns(Grouped):
    """Runs of claims with less than ``gap_us`` between them; a run ends at ``cap`` claims."""

    waiting_schema, record_schema = "at_us bigint, seq bigint, worker bigint", "worker bigint, start_us bigint, last_us bigint, claims bigint"
    schema = f"{record_schema}, ended_by string"

    def __init__(self, gap_us: int, cap: int):
        self.gap_us, self.cap = gap_us, cap
        self.out = named(self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        self.wait((row.at_us, row.seq, row.worker) for row in rows)
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        until_us = timerValues.getCurrentWatermarkInMs() * 1000
        runs = {row[0]: tuple(row)[1:] for row in self.records.get()}
        for at_us, _, worker in self.in_order(until_us):
            run = runs.get(worker)
            if run and at_us - run[1] >= self.gap_us:
                yield self.out(worker, *run, "empty_queue")
                run = None
            run = (run[0], at_us, run[2] + 1) if run else (at_us, at_us, 1)
            if run[2] == self.cap:
                yield self.out(worker, *run, "cap")
                runs.pop(worker, None)
            else:
                runs[worker] = run
        self.forget(until_us)
        for worker, run in runs.items():
            if run[1] + self.gap_us <= until_us:
                yield self.out(worker, *run, "empty_queue")
        still = [(worker, *run) for worker, run in runs.items() if run[1] + self.gap_us > until_us]
        self.keep(still)
        if still:
            self.wake(min(run[2] for run in still) + self.gap_us)


class Followed(Grouped):
    """States of a group's jobs after each micro-batch: settled reports, and on top of them those that still wait.

    The first terminal report ends a job, whenever it comes; reports after it do not count, so they do not wait either.
    Patches (JSON objects) are merged key by key.  A job's record goes ``keep_us`` after its last report.
    """

    waiting_schema = "at_us bigint, seq bigint, job_id bigint, stage string, status string, patch string"
    record_schema = "job_id bigint, last_us bigint, ended boolean, version bigint, stage string, status string, reports bigint, meta map<string,string>"
    schema = "job_id bigint, version bigint, stage string, status string, reports bigint, meta map<string,string>"
    #: Not yet settled: (last_us, ended, version, stage, status, reports, meta).
    new = (-1, False, 0, None, None, 0, None)

    def __init__(self, terminal: tuple[str, ...], keep_us: int):
        self.terminal, self.keep_us = terminal, keep_us
        self.out = named(self.schema)

    def read(self) -> dict:
        return {row[0]: tuple(row)[1:] for row in self.records.get()}

    def apply(self, states: dict, until_us: int | None) -> None:
        """Waiting reports up to ``until_us`` change the states of their jobs; other jobs' reports are passed over."""
        patched: dict = {}
        for at_us, _, job, stage, status, patch in self.in_order(until_us):
            state = states.get(job)
            if state and not state[1]:
                states[job] = (at_us, status in self.terminal, state[2], stage, status, state[5] + 1, state[6])
                if patch:
                    patched.setdefault(job, {}).update(json.loads(patch))
        for job, changes in patched.items():
            states[job] = (*states[job][:6], (states[job][6] or {}) | changes)

    def counting(self, rows: Iterable[tuple], ended: set, touched: set) -> Iterator[tuple]:
        """Rows without those of ended jobs and without those behind a terminal report that has come by now."""
        ends: dict = {}
        for some in batched((row for row in rows if row[2] not in ended), SORTED_ROWS):
            for row in some:
                job = row[2]
                touched.add(job)
                if row[4] in self.terminal and (job not in ends or row[:2] < ends[job]):
                    ends[job] = row[:2]
            yield from (row for row in some if row[2] not in ends or row[:2] <= ends[row[2]])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        records, touched = self.read(), set()
        self.wait(self.counting((tuple(row)[:6] for row in rows), {job for job, record in records.items() if record[1]}, touched))
        for job in touched:
            record = records.get(job, self.new)
            records[job] = (*record[:2], record[2] + 1, *record[3:])
        self.keep([(job, *record) for job, record in records.items()])
        states = {job: records[job] for job in touched}
        del records
        self.apply(states, None)
        for job, (_, _, version, stage, status, reports, meta) in states.items():
            yield self.out(job, version, stage, status, reports, meta or {})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        until_us = timerValues.getCurrentWatermarkInMs() * 1000
        records = self.read()
        self.apply(records, until_us)
        rest = [row for row in map(tuple, self.waiting.get()) if row[0] > until_us and not records[row[2]][1]]
        self.waiting.clear()
        self.wait(rest)
        waits = {row[2] for row in rest}
        live = [(job, *record) for job, record in records.items() if job in waits or record[0] + self.keep_us > until_us]
        self.keep(live)
        settled = [record[1] for record in live if record[1] >= 0]
        if settled:
            # A job past its time that still waits is woken for by its waiting reports.
            self.wake(max(min(settled) + self.keep_us, until_us + 1000))
        return iter(())
