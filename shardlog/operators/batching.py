"""Cutting ordered records into batches by count, bytes or time.

The count rule is arithmetic on positions. With a bytes or time limit each batch
begins where the one before ended, a running sum with resets. To keep that
parallel inside one shard, the shard is cut into sorted chunks of bounded size:

1. every chunk proposes the few states it may leave to the next chunk;
2. every chunk is folded once for each proposal: entry state -> exit state;
3. these transfers are joined up level by level, a group of chunks, then a group of
   groups, until a part is one transfer; where a true state was not proposed it is
   folded in a further round, so the result is exact whatever was proposed;
4. the way down the levels gives every chunk its true entry state, and the chunk says
   where its batches begin.

All of them read times and sizes only, and all are Spark jobs: of the parts, however
many, the driver sees the length of the longest one in chunks, and whether a round has
left any part unfinished.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardlog.model import check_positive
from shardlog.operators.sequence import CHUNK, PLACE, lay_out, number_rows, with_position
from shardlog.session import store

# State between two records: (timer start in us, records in the open batch, their bytes).
State = tuple[int, int, int]
NO_LIMIT = 1 << 62
# Entry states a chunk proposes to its successor: one per record that may have
# closed the last batch, so as many as a batch has records, up to this. States
# beyond are found in later rounds; this bounds the work of a round, not the result.
PROPOSALS = 4096
# Chunks, or groups of them, whose transfers are joined up in one task.
GROUP = 256
STATE = ["t0", "held", "size"]
# What a part ends with, and a later cut may go on from.
TAIL = [*STATE, "batches", "records"]
STATE_TYPE = "t0 bigint, held bigint, size bigint"
EXIT = ["t1", "held1", "size1"]
EXIT_TYPE = "t1 bigint, held1 bigint, size1 bigint, begun bigint"
NODE_TYPE = f"_seq bigint, {STATE_TYPE}, {EXIT_TYPE}, reached bigint, through boolean"


@dataclass(frozen=True)
class Rule:
    """Close a batch at ``count`` records, at ``n_bytes`` payload bytes, or when
    ``timeout_us`` has passed since the last close by size (0: no timer)."""

    count: int = 100
    n_bytes: int = NO_LIMIT
    timeout_us: int = 0

    def __post_init__(self) -> None:
        check_positive("count", self.count)
        check_positive("n_bytes", self.n_bytes)


def batch_by_count(df: DataFrame, parts: list[str], order: list[str], count: int = 100) -> DataFrame:
    """Batches of ``count`` records per part; ids from 1, indexes from 0."""
    check_positive("count", count)
    return _count_ids(with_position(df, parts, order), count)


# Batches that one task stamps in one sorted run.
BLOCK = 1000


def stamp_publish_time(records: DataFrame, parts: list[str], ts: str = "ts") -> DataFrame:
    """Add ``publish_time``, the time of the latest record of the batch.

    Rows are spread by block of batches, not by shard, so a hot shard is many
    tasks, and each task holds whole runs of batches ready to be written.
    """
    blocks = records.withColumn("_block", F.floor(F.col("batch_id") / BLOCK)).repartition(*parts, "_block")
    batch = W.partitionBy(*parts, "_block", "batch_id")
    return blocks.withColumn("publish_time", F.max(ts).over(batch)).drop("_block")


def _count_ids(numbered: DataFrame, count: int) -> DataFrame:
    at = F.col("rn") - 1
    return numbered.withColumn("batch_id", F.floor(at / count) + 1).withColumn("batch_index", (at % count).cast("int"))


def _fold(
    ts: np.ndarray, ends: np.ndarray, rule: Rule, state: State, at: int, closes: dict | None = None
) -> tuple[list[int], int, State]:
    """Follow the batches from record ``at``; ``ends[i]`` is bytes before record i.

    Returns where batches begin, how many, and the state after the last record.
    ``closes`` remembers, by closing record, the number begun and the end state
    after a close by size: what follows depends on nothing else. Positions found
    that way are counted but not listed.
    """
    m, begins, passed, known = len(ts), [], [], 0
    t0, held, size = state
    while at < m:
        full = at + rule.count - held - 1
        if rule.n_bytes < NO_LIMIT:
            full = min(full, int(np.searchsorted(ends, ends[at] + rule.n_bytes - size)) - 1)
        tick = int(np.searchsorted(ts, t0 + rule.timeout_us)) if rule.timeout_us > 0 else m
        if held == 0 and tick > at:
            begins.append(at)
        if tick <= full and tick < m:
            t0 += rule.timeout_us * ((int(ts[tick]) - t0) // rule.timeout_us)
            at, held, size = tick, 0, 0
        elif full < m:
            if closes is not None and full in closes:
                known, state = closes[full]
                break
            passed.append((full, len(begins)))
            t0 = int(ts[full]) if rule.timeout_us > 0 else 0
            at, held, size = full + 1, 0, 0
        else:
            at, held, size = m, held + m - at, size + int(ends[m] - ends[at])
    else:
        state = (t0, held, size)
    begun = len(begins) + known
    if closes is not None:
        closes.update((full, (begun - n, state)) for full, n in passed)
    return begins, begun, state


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values(PLACE)
    return pdf["_us"].to_numpy(), np.concatenate([[0], np.cumsum(pdf["_bytes"].to_numpy())])


def _closing(ts: np.ndarray, ends: np.ndarray, rule: Rule, n: int) -> np.ndarray:
    """Which of the last ``n`` records can close a batch by size: the shortest run
    up to the record that is full must fit between two ticks of the timer, or
    reach back before the chunk."""
    last = np.arange(len(ts) - 1, max(-1, len(ts) - 1 - n), -1)
    if rule.timeout_us <= 0:
        return last
    first = np.maximum(last - rule.count + 1, np.searchsorted(ends, ends[last + 1] - rule.n_bytes, "right") - 1)
    return last[(first < 0) | (ts[last] - ts[np.maximum(first, 0)] < rule.timeout_us)]


def _propose(pdf: pd.DataFrame, rule: Rule, key: list[str], limit: int) -> pd.DataFrame:
    """States a chunk can leave behind if a batch begins at one of its last
    records, or if the timer has run undisturbed since the first record."""
    ts, ends = _arrays(pdf)
    m, closes, states = len(ts), {}, set()
    if rule.timeout_us > 0:
        root = int(pdf["_root"].iloc[0])
        ticked = root + rule.timeout_us * ((int(ts[0]) - root) // rule.timeout_us)
        states.add(_fold(ts, ends, rule, (ticked, 0, 0), 0, closes)[2])
    # Without a timer the last close lies within the last batch; with one, ticks
    # may have passed since, and a few batches are looked back.
    back = rule.count * (4 if rule.timeout_us > 0 else 1)
    for last in _closing(ts, ends, rule, min(back, limit)):
        closed_at = int(ts[last]) if rule.timeout_us > 0 else 0
        states.add(_fold(ts, ends, rule, (closed_at, 0, 0), last + 1, closes)[2])
    return _rows(pdf, key, list(states), STATE)


def _rows(pdf: pd.DataFrame, key: list[str], states: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Rows of numbers, after the key of the group they belong to."""
    out = pd.DataFrame(states, columns=columns)
    for i, c in enumerate(key):
        out.insert(i, c, pdf[c].iloc[0])
    return out


def _states(pdf: pd.DataFrame, columns: list[str] = STATE) -> list[tuple]:
    return [tuple(map(int, s)) for s in pdf[columns].itertuples(index=False)]


def _transfer(pdf: pd.DataFrame, entries: pd.DataFrame, rule: Rule, key: list[str]) -> pd.DataFrame:
    """For each entry state of a chunk: the exit state and batches begun."""
    if pdf.empty or entries.empty:
        return pd.DataFrame(columns=[*key, *STATE, *EXIT, "begun"])
    ts, ends = _arrays(pdf)
    closes: dict = {}
    rows = []
    for state in _states(entries):
        _, begun, after = _fold(ts, ends, rule, state, 0, closes)
        rows.append((*state, *after, begun))
    return _rows(pdf, key, rows, [*STATE, *EXIT, "begun"])


def _steps(transfers: pd.DataFrame) -> dict[int, dict[State, tuple]]:
    """Transfers of a group by number and entry state."""
    steps: dict = {}
    ends = zip(_states(transfers, EXIT), transfers["begun"], transfers["reached"], transfers["through"])
    for seq, entry, (after, begun, reached, through) in zip(transfers["_seq"], _states(transfers), ends):
        steps.setdefault(int(seq), {})[entry] = (after, int(begun), int(reached), bool(through))
    return steps


def _composer(parts: list[str], span: int, size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Joins up the transfers of a group of ``size`` members of ``span`` chunks each."""

    def compose(transfers: pd.DataFrame) -> pd.DataFrame:
        """From each state the first member was folded for, as far as known.
        ``reached`` is the chunk the walk stands before."""
        steps = _steps(transfers)
        first, last = min(steps), max(steps)
        rows = []
        for entry in steps[first]:
            state, begun, at, reached, through = entry, 0, first, first * span, True
            while through and at <= last:
                if state not in steps[at]:
                    reached, through = at * span, False
                else:
                    state, n, reached, through = steps[at][state]
                    begun, at = begun + n, at + 1
            rows.append((first // size, *entry, *state, begun, reached, through))
        return _rows(transfers, parts, rows, ["_seq", *STATE, *EXIT, "begun", "reached", "through"])

    return compose


def _enter(transfers: pd.DataFrame, entry: pd.DataFrame, parts: list[str]) -> pd.DataFrame:
    """The true entry state of every member of a group and the batches before it."""
    steps = _steps(transfers)
    state, batches = _states(entry)[0], int(entry["batches"].iloc[0])
    rows = []
    for at in range(min(steps), max(steps) + 1):
        rows.append((at, *state, batches))
        state, n, _, _ = steps[at][state]
        batches += n
    return _rows(transfers, parts, rows, ["_seq", *STATE, "batches"])


def _begins(pdf: pd.DataFrame, entry: pd.DataFrame, rule: Rule, key: list[str]) -> pd.DataFrame:
    """Every batch with records in the chunk: position of its first record, id, and
    the time of its last record here."""
    ts, ends = _arrays(pdf)
    e, state = entry.iloc[0], _states(entry)[0]
    begins, _, _ = _fold(ts, ends, rule, state, 0)
    first, done = int(e["first_rn"]), int(e["batches"])
    starts = [(first + at, done + i + 1) for i, at in enumerate(begins)]
    if not begins or begins[0] > 0:  # the batch that was open when the chunk began
        starts.insert(0, (first - state[1], done))
        begins = [0, *begins]
    rows = [(*s, int(ts[nxt - 1])) for s, nxt in zip(starts, [*begins[1:], len(ts)])]
    return _rows(pdf, key, rows, ["_start", "_batch", "_until"])


def _cut_by_count(df: DataFrame, parts: list[str], ts: str | None, order: list[str], count: int, resume: DataFrame | None) -> "Cut":
    table, chunks = lay_out(df, parts, order, "count")
    if resume is not None:
        chunks = _moved_on(chunks, resume, parts)
    n = F.max(F.col("_before") + F.col("_rows"))
    zero = F.lit(0).cast("bigint")
    tails = chunks.groupBy(*parts).agg(n.alias("records")).select(
        *parts, zero.alias("t0"), (F.col("records") % count).alias("held"), zero.alias("size"), F.ceil(F.col("records") / count).alias("batches"), "records"
    )
    records = _count_ids(number_rows(table, chunks, parts).drop(CHUNK), count)
    if ts and count == 1:
        records = records.withColumn("publish_time", F.col(ts))
    elif ts:
        records = stamp_publish_time(records, parts, ts)
    return Cut(tails, lambda: records)


def _moved_on(chunks: DataFrame, seen: DataFrame, parts: list[str]) -> DataFrame:
    """Chunks whose positions go on from the ``records`` that a part had before."""
    moved = F.col("_before") + F.coalesce("_seen", F.lit(0))
    joined = chunks.join(seen.select(*parts, F.col("records").alias("_seen")), parts, "left")
    return store(joined.withColumn("_before", moved).drop("_seen"), "chunks")


@dataclass
class Cut:
    """Result of ``cut_batches``: a row per part with the state after its last record
    and the numbers of batches and records so far (``TAIL``); and, placed when asked
    for, the records with their ids."""

    tails: DataFrame
    place: Callable[[], DataFrame]

    @cached_property
    def records(self) -> DataFrame:
        return self.place()


def cut_batches(
    df: DataFrame,
    parts: list[str],
    ts: str | None,
    order: list[str],
    n_bytes: str,
    rule: Rule,
    resume: DataFrame | None = None,
) -> Cut:
    """Cut the records of each part, in ``(ts, *order)``, by count, bytes or time.

    A limit is tested after a record is added, so the record that reaches it is
    the last of its batch. The timer starts at the last close by size (at first:
    at the first record), and each time it runs out the open batch, if any, is
    closed before the next record is added.

    ``ts`` may be None, for ``order`` alone, if the rule has no timer.
    ``resume`` continues parts cut before, from their ``tails``; a null ``t0`` begins
    a new batch. A part that is not in it is new. With the count rule alone the batches are
    told from the records, which then must be a multiple of the count if new.
    Adds ``rn``, ``batch_id`` (from 1), ``batch_index`` (from 0) and, if there is
    ``ts``, ``publish_time``: the time of the latest record of the batch so far.
    """
    if ts is None and rule.timeout_us > 0:
        raise ValueError("a timer needs a time column")
    order = order if ts is None else [ts, *order]
    if rule.n_bytes >= NO_LIMIT and rule.timeout_us <= 0:
        return _cut_by_count(df, parts, ts, order, rule.count, resume)
    us = F.lit(0).cast("bigint") if ts is None else F.unix_micros(F.col(ts).cast("timestamp"))
    size = F.coalesce(F.col(n_bytes).cast("bigint"), F.lit(0))
    table, chunks = lay_out(df.withColumn("_us", us).withColumn("_bytes", size), parts, order, "cut", [F.min("_us").alias("_root")])
    key = [*parts, "_seq"]
    part_types = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in table.select(*parts).schema)
    spark = df.sparkSession
    numbers = chunks.select(*parts, CHUNK, "_seq")
    narrow = table.select(*parts, CHUNK, PLACE, "_us", "_bytes").join(numbers, [*parts, CHUNK])

    # What each part starts from. Written, so that joins with it are planned by its size.
    starts = chunks.groupBy(*parts).agg(F.min("_root").alias("_root"), F.sum("_rows").alias("_rows"), F.max("_seq").alias("_last"))
    before = starts.withColumns(dict.fromkeys(TAIL, F.lit(None).cast("bigint")))
    if resume is not None:
        before = starts.join(resume.select(*parts, *TAIL), parts, "left")
    new_t0 = F.col("_root") if rule.timeout_us > 0 else F.lit(0).cast("bigint")
    zero = F.lit(0).cast("bigint")
    begin = store(
        before.select(
            *parts, F.coalesce("t0", new_t0).alias("t0"), *[F.when(F.col("t0").isNull(), zero).otherwise(F.col(c)).alias(c) for c in STATE[1:]],
            F.coalesce("batches", zero).alias("batches"), F.coalesce("records", zero).alias("records"), "_last", "_rows",
        ),
        "begin",
    )
    longest = starts.agg(F.max("_last")).first()[0] or 0

    wanted = begin.select(*parts, zero.alias("_seq"), *STATE)
    if longest:
        # The timer grid of a part stems from its start. The last chunk has none to propose to.
        rooted = narrow.join(begin.select(*parts, F.col("t0").alias("_root"), "_last"), parts).where("_seq < _last").drop("_last")
        limit = PROPOSALS
        proposed = rooted.groupBy(*key).applyInPandas(
            lambda pdf: _propose(pdf, rule, key, limit), f"{part_types}_seq bigint, {STATE_TYPE}"
        )
        wanted = wanted.unionByName(_shift(proposed, numbers, parts))

    known = None
    while True:
        fresh = _fold_chunks(narrow, wanted, rule, key, part_types, all_chunks=known is None)
        known = fresh if known is None else known.unionByName(fresh)
        levels = _levels(known, parts, part_types, longest)
        # A row per part: where its walk ended.
        walked = store(begin.join(levels[-1].drop("_seq"), [*parts, *STATE]), "walked")
        short = walked.where("not through")
        if short.isEmpty():
            break
        after = [F.col(e).alias(s) for e, s in zip(EXIT, STATE)]
        ends = short.select(*parts, F.col("reached").alias("_seq"), *after)
        beyond = ends.select(*parts, F.col("_seq").alias("_from"))
        guesses = _shift(known.select(*key, *after), numbers, parts).join(beyond, parts).where("_seq > _from").drop("_from")
        wanted = ends.unionByName(guesses.join(known.select(*key, *STATE), [*key, *STATE], "left_anti"))
    tails = walked.select(
        *parts, *[F.col(e).alias(s) for e, s in zip(EXIT, STATE)], (F.col("batches") + F.col("begun")).alias("batches"), (F.col("records") + F.col("_rows")).alias("records")
    )

    def place() -> DataFrame:
        entered = begin.select(*parts, zero.alias("_seq"), *STATE, "batches")
        for level in reversed(levels[:-1]):
            entered = (
                level.withColumn("_up", F.floor(F.col("_seq") / GROUP))
                .groupBy(*parts, "_up")
                .cogroup(entered.withColumnRenamed("_seq", "_up").groupBy(*parts, "_up"))
                .applyInPandas(lambda t, e: _enter(t, e, parts), f"{part_types}_seq bigint, {STATE_TYPE}, batches bigint")
            )
        shifted = chunks if resume is None else _moved_on(chunks, begin, parts)
        placed_entries = entered.join(shifted.select(*key, (F.col("_before") + 1).alias("first_rn")), key)
        begins = (
            narrow.groupBy(*key)
            .cogroup(placed_entries.groupBy(*key))
            .applyInPandas(lambda pdf, entry: _begins(pdf, entry, rule, key), f"{part_types}_seq bigint, _start bigint, _batch bigint, _until bigint")
        )
        whole = W.partitionBy(*parts, "_batch")
        published = begins.withColumn("publish_time", F.timestamp_micros(F.max("_until").over(whole)).cast("timestamp_ntz"))
        marks = store(published.join(numbers, key).drop("_seq", "_until"), "begins")
        placed = number_rows(table.drop("_us", "_bytes"), shifted, parts)
        records = _spread(placed, marks, [*parts, CHUNK])
        return records if ts else records.drop("publish_time")

    return Cut(tails, place)


def _shift(states: DataFrame, numbers: DataFrame, parts: list[str]) -> DataFrame:
    """States left by a chunk as entries of the next, where there is one."""
    key = [*parts, "_seq"]
    after = states.withColumn("_seq", F.col("_seq") + 1).distinct()
    return after.join(numbers.select(*key), key, "left_semi").select(*key, *STATE)


def _fold_chunks(narrow: DataFrame, wanted: DataFrame, rule: Rule, key: list[str], part_types: str, all_chunks: bool) -> DataFrame:
    rows = narrow
    if not all_chunks:
        wanted = store(wanted, "wanted")
        rows = narrow.join(wanted.select(*key).distinct(), key, "left_semi")
    folded = (
        rows.groupBy(*key)
        .cogroup(wanted.groupBy(*key))
        .applyInPandas(lambda pdf, entries: _transfer(pdf, entries, rule, key), f"{part_types}_seq bigint, {STATE_TYPE}, {EXIT_TYPE}")
    )
    return store(folded, "transfers")


def _levels(known: DataFrame, parts: list[str], part_types: str, longest: int) -> list[DataFrame]:
    """Transfers of chunks, of groups of chunks and so on, until every part is one group."""
    levels, span = [known.withColumns({"reached": F.col("_seq") + 1, "through": F.lit(True)})], 1
    while longest >= span:
        composed = (
            levels[-1]
            .groupBy(*parts, F.floor(F.col("_seq") / GROUP).alias("_up"))
            .applyInPandas(_composer(parts, span, GROUP), f"{part_types}{NODE_TYPE}")
        )
        levels.append(store(composed, "composed"))
        span *= GROUP
    return levels


def _spread(placed: DataFrame, begins: DataFrame, key: list[str]) -> DataFrame:
    """Give every record the last batch that begins at or before it in its chunk."""
    marks = begins.select(*key, F.col("_start").alias("rn"), "_batch", "publish_time", F.lit(True).alias("_mark"))
    rows = placed.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    so_far = W.partitionBy(*key).orderBy("rn", F.col("_mark").desc()).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumn("batch_id", F.last("_batch", ignorenulls=True).over(so_far))
        .withColumn("publish_time", F.last("publish_time", ignorenulls=True).over(so_far))
        .withColumn("_start", F.last(F.when(F.col("_mark"), F.col("rn")), ignorenulls=True).over(so_far))
        .where(~F.col("_mark"))
        .withColumn("batch_index", (F.col("rn") - F.col("_start")).cast("int"))
        .drop("_mark", "_start", "_batch", CHUNK)
    )
