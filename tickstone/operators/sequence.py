"""Ordered per-key logic that stays spread out when one key holds much of the data.

A plain window or grouped fold puts a whole key into one task.  Here rows are dealt into parts: ranges of (key, time, tie)
of about equal size, whatever the keys and however dense their times, each in order.  What a part does to the state of
the key it begins with is a small map (a value to carry, an affine function, a step function).  The maps are computed in all parts at
once and chained, which gives the state at the start of every part; then all parts are processed at once.  The result
equals one pass over the key.

A part has one map, so the driver sees one row per part for carried values and averages.  The step functions of a cooldown have
more rows and are chained on the cluster, as a tree.  Parts are kept on shared storage between the two readings.  The Arrow
steps stream through their part and hold one batch and a small state, never a whole key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstone.functions import micros
from tickstone.operators.lineage import settled

PART = "_part"


def in_parts(df: DataFrame, key: str, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows in order in parts of about equal size with the part's number; Spark chooses how many unless ``parts`` says so."""
    ranged = df.repartitionByRange(*([parts] if parts else []), key, *order)
    return settled(ranged.sortWithinPartitions(key, *order).withColumn(PART, F.spark_partition_id()))


# --- shared plumbing for the Arrow-batched steps ----------------------------------------------


def _starts(batch: pa.RecordBatch | pa.Table, by: Sequence[str]) -> np.ndarray:
    """Positions at which a new group of ``by`` begins."""
    fresh = np.zeros(batch.num_rows, dtype=bool)
    fresh[0] = True
    for name in by:
        column = batch.column(name)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(fresh)


def _group_numbers(starts: np.ndarray, size: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, size)))


def _whole_groups(batches: Iterable[pa.RecordBatch], by: Sequence[str]) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that no group of ``by`` is split between two of them."""
    held: list[pa.RecordBatch] = []
    tail = None
    name = lambda batch, at: tuple(batch.column(c)[at].as_py() for c in by)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held and name(batch, 0) != tail:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        cut = int(_starts(batch, by)[-1])
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
        tail = name(batch, batch.num_rows - 1)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _numpy(table: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    column = table.column(name)
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{n}` {types[n]}" for n in names)


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


class _Runs:
    """Walks the batches of a part and tells where runs of one key begin, also across batches."""

    def __init__(self, key: str):
        self.key, self.part, self.first, self.last = key, None, None, None

    def walk(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
        """Each batch that has rows, the starts of its runs, and whether the first one began in an earlier batch."""
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(self.key)
            goes_on = self.part is not None and keys[0].as_py() == self.last
            if self.part is None:
                self.number, self.first = batch.column(PART).slice(0, 1), keys.slice(0, 1)
                self.part = self.number[0].as_py()
            self.last = keys[batch.num_rows - 1].as_py()
            self.last_key = keys.slice(batch.num_rows - 1, 1)
            yield batch, _starts(batch, [self.key]), goes_on


def _ends(table: pa.Table) -> Iterator[tuple[int, int, bool]]:
    """Row, part number and whether the part goes on with the last key of the part before it, in order of parts."""
    firsts, lasts, before = table["_first"].to_pylist(), table["_last"].to_pylist(), object()
    numbers = table[PART].to_numpy()
    for i in np.argsort(numbers):
        yield int(i), int(numbers[i]), firsts[i] == before
        before = lasts[i]


# --- last known value -------------------------------------------------------------------------


def carry_forward(
    df: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    value: str,
    name: str,
    include_current: bool,
    parts: int | None = None,
) -> DataFrame:
    """Add the last non-NULL ``value`` of the key before (or up to and including) each row."""
    rows = in_parts(df, key, [ts, *tie], parts)

    # What a part leaves behind: the last value of its last key, and whether that key began in an earlier part.
    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, whole, known = _Runs(key), True, None
        for batch, starts, goes_on in runs.walk(batches):
            if known is not None and not goes_on or len(starts) > 1:
                whole, known = False, None
            column = batch.column(value)
            last = column.slice(starts[-1])
            at = np.flatnonzero(last.is_valid().to_numpy(zero_copy_only=False))
            if at.size:
                known = last.slice(at[-1], 1)
            elif known is None:
                known = pa.nulls(1, column.type)
        if runs.part is not None:
            columns = [runs.number, runs.first, runs.last_key, pa.array([whole]), known]
            yield pa.RecordBatch.from_arrays(columns, [PART, "_first", "_last", "_whole", "_value"])

    kind = _type(rows, key)
    left = rows.select(PART, key, value).mapInArrow(
        leave, f"{PART} int, _first {kind}, _last {kind}, _whole boolean, _value {_type(rows, value)}"
    ).toArrow()
    values = left["_value"].combine_chunks()
    is_known, whole = values.is_valid().to_numpy(zero_copy_only=False), left["_whole"].to_numpy()
    enters, at = {}, None
    for i, part, goes_on in _ends(left):
        at = at if goes_on else None
        if at is not None:
            enters[part] = at
        if is_known[i] or not whole[i]:
            at = i if is_known[i] else None

    columns = list(df.columns)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, carried = _Runs(key), None
        for batch, starts, goes_on in runs.walk(batches):
            column, n = batch.column(value), batch.num_rows
            if carried is None and runs.part in enters:
                carried = values.slice(enters[runs.part], 1).cast(column.type)
            elif carried is None or not goes_on:
                carried = pa.nulls(1, column.type)
            group = _group_numbers(starts, n)
            known = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.arange(1, n + 1), 0)
            newest = np.maximum.accumulate(known)
            seen = newest if include_current else np.append(0, newest[:-1])
            # Position 0 is the value carried in, which the first run may use; earlier runs are out of reach.
            seen = np.where(seen > starts[group], seen, np.where(group == 0, 0, -1))
            filled = pa.concat_arrays([carried, column]).take(pa.array(seen, mask=seen < 0))
            if newest[-1] > starts[-1]:
                carried = column.slice(newest[-1] - 1, 1)
            elif len(starts) > 1:
                carried = pa.nulls(1, column.type)
            yield pa.RecordBatch.from_arrays([*batch.select(columns).columns, filled], [*columns, name])

    return rows.mapInArrow(fill, f"{_fields(df, columns)}, `{name}` {_type(df, value)}")


def previous_value(
    df: DataFrame, key: str, ts: str, tie: Sequence[str], value: str, name: str, parts: int | None = None
) -> DataFrame:
    """Add the key's previous ``value``: ``lag`` for series of any length."""
    return carry_forward(df, key, ts, tie, value, name, include_current=False, parts=parts)


# --- exponentially weighted average -----------------------------------------------------------


def affine_scan(a: np.ndarray, b: np.ndarray, start: float) -> np.ndarray:
    """Every y of ``y = a * y + b``, row by row from ``start``; where ``a`` is 0 nothing earlier counts.

    Rows are laid out in about sqrt(n) blocks: all blocks are folded side by side, then the blocks' maps are chained.
    """
    n = a.size
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    by_step = lambda x, pad: np.append(x, np.full(blocks * width - n, pad)).reshape(blocks, width).T.copy()
    slope, shift = by_step(a, 1.0), by_step(b, 0.0)
    for i in range(1, width):
        fresh = slope[i] == 0
        shift[i] = np.where(fresh, shift[i], slope[i] * shift[i - 1] + shift[i])
        slope[i] *= slope[i - 1]
    enters, y = np.empty(blocks), start
    for i in range(blocks):
        enters[i] = y
        y = shift[-1, i] if slope[-1, i] == 0 else slope[-1, i] * y + shift[-1, i]
    return np.where(slope == 0, shift, slope * enters + shift).T.ravel()[:n]


def ewma(
    df: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str],
    columns: Mapping[str, tuple[str | tuple[str, str], float, float]],
    when: str = "after",
    seeds: DataFrame | None = None,
    parts: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Add running weighted averages ``new = keep * old + gain * value`` per key.

    ``columns`` maps an output name to (value column, ``keep``, ``gain``).  The first row of a key only sets
    the average: to its own value, or to the column of the same output name in ``seeds`` (one row
    per key).  ``when="before"`` gives the average a row is compared with (NULL on the first row),
    ``"after"`` the one that includes it.  Values must not be NULL.

    ``bounded`` keeps a key in one task and reads the rows once; use it only where the rows per key are
    bounded, as with one row per day.  Only then a pair of earlier outputs may stand for a value column, which is their difference.
    """
    if when not in ("before", "after"):
        raise ValueError("when must be 'before' or 'after'")
    outputs = list(columns)
    plain = {o: f"_x{i}" for i, o in enumerate(outputs) if isinstance(columns[o][0], str)}
    if not bounded and len(plain) < len(outputs):
        raise ValueError("differences of outputs need bounded=True")
    weights = {o: (float(columns[o][1]), float(columns[o][2])) for o in outputs}
    own = list(df.columns)
    rows = df.withColumns({x: F.col(columns[o][0]).cast("double") for o, x in plain.items()}).withColumn("_row", F.lit(1))
    if seeds is not None:  # a seed is a row before the key's first
        values = {x: F.col(o).cast("double") for o, x in plain.items()}
        rows = rows.unionByName(seeds.select(key, *[v.alias(x) for x, v in values.items()], F.lit(0).alias("_row")), allowMissingColumns=True)
    order = ["_row", ts, *tie] if seeds is not None else [ts, *tie]
    if bounded:
        rows = rows.repartition(key).sortWithinPartitions(key, *order).withColumn(PART, F.lit(0))
    else:
        rows = in_parts(rows, key, order, parts)

    def opening(batch: pa.RecordBatch, starts: np.ndarray, goes_on: bool, after_seed: bool) -> tuple[np.ndarray, ...]:
        """Which rows set the average, and which follow a seed and leave it as it is."""
        seed = _numpy(batch, "_row") == 0
        sets = seed.copy()
        sets[starts] = True
        if goes_on and not seed[0]:
            sets[0] = False
        follows = np.append(after_seed, seed[:-1]) & ~sets
        return seed, sets, follows

    def maps(x: np.ndarray, o: str, sets: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep, gain = weights[o]
        return np.where(sets, 0.0, np.where(follows, 1.0, keep)), np.where(sets, x, np.where(follows, 0.0, gain * x))

    # A part's first row depends on the part before; the rows after it are one affine map per output.
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, opened, after_seed, slopes, shifts = _Runs(key), None, False, {}, {}
        for batch, starts, goes_on in runs.walk(batches):
            seed, sets, follows = opening(batch, starts, goes_on, after_seed)
            after_seed = bool(seed[-1])
            for o, x in plain.items():
                a, b = maps(_numpy(batch, x), o, sets, follows)
                if opened is None:
                    a[0], b[0] = 1.0, 0.0
                shifts[o] = affine_scan(a, b, shifts.get(o, 0.0))[-1]
                slopes[o] = slopes.get(o, 1.0) * a.prod()
            if opened is None:
                opened = [bool(seed[0]), *(_numpy(batch, x)[0] for x in plain.values())]
        if runs.part is not None:
            found = [*opened, after_seed, *(v for o in outputs for v in (slopes[o], shifts[o]))]
            columns = [runs.first, runs.last_key, runs.number, *(pa.array([v]) for v in found)]
            yield pa.RecordBatch.from_arrays(columns, ["_first", "_last", PART, "_seed", *plain.values(), "_after", *map_names])

    map_names = [f"{kind}{i}" for i in range(len(outputs)) for kind in ("_slope", "_shift")]
    enters: dict[int, tuple[bool, list[float]]] = {}
    if not bounded:
        kind = _type(rows, key)
        doubles = lambda names: ", ".join(f"{n} double" for n in names)
        schema = f"_first {kind}, _last {kind}, {PART} int, _seed boolean, {doubles(plain.values())}, _after boolean, {doubles(map_names)}"
        found = rows.select(PART, key, "_row", *plain.values()).mapInArrow(summarise, schema).toArrow()
        table = found.drop_columns(["_first", "_last"]).to_pylist()  # a row per part
        pending, states = False, []
        for i, part, goes_on in _ends(found):
            row = table[i]
            if goes_on:
                enters[part] = (pending, states)
            after = []
            for j, o in enumerate(outputs):
                (keep, gain), x = weights[o], row[plain[o]]
                first = x if row["_seed"] or not goes_on else states[j] if pending else keep * states[j] + gain * x
                slope = row[f"_slope{j}"]
                after.append(row[f"_shift{j}"] if slope == 0 else slope * first + row[f"_shift{j}"])
            pending, states = row["_after"], after

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, after_seed, states = _Runs(key), False, None
        for batch, starts, goes_on in runs.walk(batches):
            if states is None:
                goes_on = runs.part in enters
                after_seed, states = enters.get(runs.part, (False, [0.0] * len(outputs)))
                states = list(states)
            seed, sets, follows = opening(batch, starts, goes_on, after_seed)
            after_seed = bool(seed[-1])
            reached: dict[str, np.ndarray] = {}
            results = []
            for j, o in enumerate(outputs):
                source = columns[o][0]
                x = _numpy(batch, plain[o]) if o in plain else reached[source[0]] - reached[source[1]]
                y = reached[o] = affine_scan(*maps(x, o, sets, follows), states[j])
                if when == "before":
                    results.append(pa.array(np.append(states[j], y[:-1]), mask=sets | follows))
                else:
                    results.append(pa.array(y))
                states[j] = y[-1]
            ticks = pa.array(~seed)
            out = [*(c.filter(ticks) for c in batch.select(own).columns), *(r.filter(ticks) for r in results)]
            yield pa.RecordBatch.from_arrays(out, [*own, *outputs])

    return rows.mapInArrow(replay, ", ".join([_fields(df, own), *[f"`{o}` double" for o in outputs]]))


# --- cooldown ---------------------------------------------------------------------------------

FAN_IN = 8  # maps that one task puts together


def _next_allowed(starts: np.ndarray, us: np.ndarray, group: np.ndarray, wait: int) -> np.ndarray:
    """Position of the first row of the same group at least ``wait`` later, else the row count."""
    offset = us - us[starts][group]
    # One sorted axis for all groups: each group gets a slot wider than any reach of its rows.
    axis = group * (int(offset.max()) + wait + 1) + offset
    nxt = np.searchsorted(axis, axis + wait, side="left")
    inside = nxt < len(us)
    inside[inside] = group[nxt[inside]] == group[inside]
    return np.where(inside, nxt, len(us))


class _Steps:
    """Where a chain of kept rows leaves a stretch of one key: ``leaves[i]`` if the time from which it may go on is at most
    ``reach[i]`` and above ``reach[i - 1]``; beyond the last one it keeps nothing there."""

    def __init__(self, opens: int, reach: np.ndarray, leaves: np.ndarray, wait: int):
        self.opens, self.wait = opens, wait
        # A chain comes from before ``opens``, so no step beyond ``opens + wait`` is taken, and steps that leave alike are one.
        n = int(np.searchsorted(reach, opens + wait)) + 1
        reach, leaves = reach[:n], leaves[:n]
        last = np.append(leaves[1:] != leaves[:-1], True)
        self.reach, self.leaves = reach[last], leaves[last]

    def after(self, kept: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.reach, kept + self.wait)
        return np.where(at < self.reach.size, np.append(self.leaves, 0)[at], kept)

    def then(self, other: _Steps) -> _Steps:
        beyond = other.reach > self.reach[-1]
        reach = np.append(self.reach, other.reach[beyond])
        return _Steps(self.opens, reach, np.append(other.after(self.leaves), other.leaves[beyond]), self.wait)


def cooldown(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    seconds: float,
    at_limit: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """Keep a row only if enough time has passed since the last *kept* row of its key.

    Returns the kept (key, ts, tie) rows.  ``at_limit`` tells whether a row exactly ``seconds``
    later is kept.  Of rows with the same key and time only the lowest ``tie`` can be kept.

    The step function of a part has at most one row per distinct exit of the chains that can enter it, that is per row in the
    first ``seconds`` of the part.  A task puts together ``FAN_IN`` of them, so it reads at most that many times the rows in
    one such span.
    """
    wait = int(seconds * 1_000_000) + (0 if at_limit else 1)
    if wait <= 0:
        raise ValueError("the cooldown must be positive")
    stamps = df.groupBy(key, ts).agg(F.min(tie).alias(tie)).withColumn("_us", micros(ts))
    rows = in_parts(stamps, key, ["_us"], parts)

    def chain(runs: _Runs, batches: Iterator[pa.RecordBatch], enters: Mapping[int, int]) -> Iterator[tuple]:
        """Batches, which rows are kept, the time of the row kept last in the last run, and how many runs begin."""
        kept = None
        for batch, starts, goes_on in runs.walk(batches):
            if kept is None:
                kept = enters.get(runs.part)
                goes_on = kept is not None
            us = _numpy(batch, "_us")
            nxt = _next_allowed(starts, us, _group_numbers(starts, len(us)), wait)
            keep = np.zeros(len(us), dtype=bool)
            at = starts.copy()
            if goes_on:
                end = starts[1] if len(starts) > 1 else len(us)
                at[0] = np.searchsorted(us[:end], kept + wait)
                if at[0] == end:
                    at = at[1:]
            while len(at):
                keep[at] = True
                at = nxt[at]
                at = at[at < len(us)]
            tail = np.flatnonzero(keep[starts[-1] :])
            if len(tail):
                kept = int(us[starts[-1] + tail[-1]])
            yield batch, keep, kept, len(starts) - goes_on

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, n_runs, kept = _Runs(key), 0, None
        for _, _, kept, fresh in chain(runs, batches, {}):
            n_runs += fresh
        if runs.part is not None:
            columns = [runs.number, runs.first, runs.last_key, pa.array([n_runs == 1]), pa.array([kept])]
            yield pa.RecordBatch.from_arrays(columns, [PART, "_first", "_last", "_whole", "_kept"])

    kind = _type(rows, key)
    schema = f"{PART} int, _first {kind}, _last {kind}, _whole boolean, _kept bigint"
    found = rows.select(PART, key, "_us").mapInArrow(summarise, schema).toArrow()  # a row per part
    whole, kept = found["_whole"].to_pylist(), found["_kept"].to_pylist()
    # Parts that go on with a key form a chain from the part where the key begins.
    states, places, enters = {}, {}, {}
    n_chains, length = -1, 0
    for i, part, goes_on in _ends(found):
        if not goes_on:
            n_chains, length = n_chains + 1, 0
            states[n_chains, 0] = kept[i]
            continue
        places[part] = (n_chains, length)
        length += 1
        if not whole[i]:
            n_chains, length = n_chains + 1, 0
            states[n_chains, 0] = kept[i]
    if places:
        states = _chained(rows, {p: c for p, c in places.items()}, states, key, wait)
        enters = {part: states[place] for part, place in places.items()}

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, keep, _, _ in chain(_Runs(key), batches, enters):
            yield batch.select([key, ts, tie]).filter(pa.array(keep))

    return rows.mapInArrow(replay, _fields(stamps, [key, ts, tie]))


_STEP_FIELDS = "chain int, at int, opens bigint, reach bigint, leaves bigint"


def _step_rows(chain: int, at: int, steps: _Steps) -> pa.RecordBatch:
    n = steps.reach.size
    head = [pa.array(np.full(n, v, dtype=t)) for v, t in ((chain, np.int32), (at, np.int32), (steps.opens, np.int64))]
    return pa.RecordBatch.from_arrays([*head, pa.array(steps.reach), pa.array(steps.leaves)], ["chain", "at", "opens", "reach", "leaves"])


def _chained(rows: DataFrame, places: dict[int, tuple[int, int]], states: dict, key: str, wait: int) -> dict:
    """The time kept last before each (chain, place), from the one before place 0: step functions put together as a tree."""

    # Step functions of the first run of each part in ``places``, over the rows a chain may enter at.
    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, entry, reached, ended = _Runs(key), np.array([], dtype=np.int64), np.array([], dtype=np.int64), False
        for batch, starts, goes_on in runs.walk(batches):
            if runs.part not in places or ended or entry.size and not goes_on:
                ended = True
                continue
            us = _numpy(batch, "_us")[: starts[1] if len(starts) > 1 else None]
            ended = len(starts) > 1
            opens = int(entry[0]) if entry.size else int(us[0])
            new = us[: np.searchsorted(us, opens + wait) + 1] if not (entry.size and entry[-1] >= opens + wait) else us[:0]
            entry, reached = np.append(entry, new), np.append(reached, new)
            while len(due := np.flatnonzero(reached + wait <= us[-1])):
                reached[due] = us[np.searchsorted(us, reached[due] + wait)]
        if entry.size:
            yield _step_rows(*places[runs.part], _Steps(int(entry[0]), entry, reached, wait))

    def blocks(maps: DataFrame) -> DataFrame:
        maps = maps.withColumn("block", F.floor(F.col("at") / FAN_IN).cast("int"))
        return maps.repartition("chain", "block").sortWithinPartitions("chain", "block", "at", "reach")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[tuple[int, _Steps]]]]:
        for table in _whole_groups(batches, ["chain", "block"]):
            starts = _starts(table, ["chain", "block", "at"])
            chain, block, at, opens = (_numpy(table, c)[starts] for c in ("chain", "block", "at", "opens"))
            reach, leaves = np.split(_numpy(table, "reach"), starts[1:]), np.split(_numpy(table, "leaves"), starts[1:])
            found: dict[tuple[int, int], list] = {}
            for i in range(len(starts)):
                found.setdefault((int(chain[i]), int(block[i])), []).append((int(at[i]), _Steps(int(opens[i]), reach[i], leaves[i], wait)))
            for (c, b), own in found.items():
                yield c, b, own

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chain, block, own in members(batches):
            steps = own[0][1]
            for _, more in own[1:]:
                steps = steps.then(more)
            yield _step_rows(chain, block, steps)

    levels = [settled(rows.select(PART, key, "_us").mapInArrow(steps, _STEP_FIELDS))]
    size = 1 + max(at for _, at in places.values())
    while size > FAN_IN:
        levels.append(settled(blocks(levels[-1]).mapInArrow(together, _STEP_FIELDS)))
        size = -(-size // FAN_IN)
    for maps in reversed(levels):
        known = states

        def walk(batches: Iterator[pa.RecordBatch], known: dict = known) -> Iterator[pa.RecordBatch]:
            for chain, block, own in members(batches):
                kept, out = known[chain, block], []
                for at, steps in own:
                    out.append((at, kept))
                    kept = int(steps.after(np.array([kept]))[0])
                at, before = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([chain] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(before)], ["chain", "at", "kept"])

        found = blocks(maps).mapInArrow(walk, "chain int, at int, kept bigint").toArrow()  # a row per map
        states = {(c, at): k for c, at, k in zip(*(found[n].to_pylist() for n in ("chain", "at", "kept")), strict=True)}
    return states
