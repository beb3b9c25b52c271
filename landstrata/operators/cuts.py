"""Greedy byte-budget cut of an ordered partition into row groups, exact over many tasks.

A group ends before the row that would exceed the budget, when it holds `max_rows` rows, or where
the large features begin; a row over the budget stands alone. Where a group ends depends on where it
began, so a partition that spans several tasks needs the state each task starts with: the row at which
the open group began, and the cost before it. No step holds a partition:

1. every span, in parallel, learns for each row at which its first new group could begin which group is
   open at its end. Only rows within one budget of the span's start can be such rows, and neighbours
   soon lead to the same end, so what a span tells is a list of runs of them, each with one end;
2. spans are functions from state to state, which the lists describe. A fixed number of neighbours is
   composed to one function, those again, and so on until one is left a partition; then the states
   go down the same way, each function handing its first state to its parts. A task sees that number of
   lists at a time, and rounds grow with the logarithm of the spans;
3. every span, in parallel, cuts its rows from the state it starts with.

Partitions that lie in one task skip the first two.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landstrata.operators.ordering import spans_of, with_spans
from landstrata.session import materialise, materialise_observing

# Functions that are composed at once.
FAN = 64
# A row number beyond all others.
NEVER = 1 << 62

ENTRY = ["open_cost", "open_rows", "open_large", "groups_before"]


def _next_start(costs, at, spent, rows, budget, max_rows, flip):
    """Where the group after the one open at `at` begins, if it holds `rows` rows costing `spent`
    already. `costs` are running sums with a leading 0; `flip` is where the large rows begin."""
    fits = np.searchsorted(costs, costs[at] + (budget - spent), side="right") - 1
    start = np.minimum(np.maximum(fits, at + (rows == 0)), at + max_rows - rows)
    return np.where((flip > at) | ((flip == at) & (rows > 0)), np.minimum(start, flip), start)


def _block(costs: np.ndarray, large: np.ndarray, before: bool | None) -> tuple[np.ndarray, int]:
    """Running costs of a block, and the row where the large rows begin (its length if nowhere)."""
    running = np.concatenate([[0], np.cumsum(costs)])
    led = np.concatenate([[large[0] if before is None else before], large[:-1]])
    flips = np.flatnonzero(large != led)
    return running, int(flips[0]) if len(flips) else len(costs)


def _runs(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
    yield from zip(edges[:-1].tolist(), edges[1:].tolist())


class _Outlook:
    """Pass 1 over one span: what each possible first group start leads to."""

    def __init__(self, only_first: bool):
        self.only_first = only_first
        self.total, self.rows, self.large, self.flip = 0, 0, None, None
        self.first_large = None
        self.starts = np.empty(0, np.int64)  # row in the span
        self.costs = np.empty(0, np.int64)  # cost of the span before that row
        self.spent = np.empty(0, np.int64)
        self.held = np.empty(0, np.int64)
        self.begun = np.empty(0, np.int64)

    def add(self, costs: np.ndarray, large: np.ndarray, budget: int, max_rows: int) -> None:
        size = len(costs)
        running, flip = _block(costs, large, self.large)
        if self.first_large is None:
            self.first_large = bool(large[0])
        seen_flip = self.flip is not None
        if self.flip is None and flip < size:
            self.flip = self.rows + flip
        # Rows that can begin the span's first new group.
        reach = np.searchsorted(running, budget - self.total, side="right")
        reach = min(reach, size, max_rows - self.rows, size if flip == size else flip + 1)
        if self.rows == 0:
            reach = max(1, reach)
        if self.only_first:
            reach = 1 if self.rows == 0 else 0
        fresh = np.arange(0 if seen_flip else max(0, reach))
        # Groups that are open already go on into this block.
        spent, held, begun = self.spent, self.held, self.begun
        at = np.zeros(len(spent), np.int64)
        begins = _next_start(running, at, spent, held, budget, max_rows, flip)
        inside = begins < size
        at = np.concatenate([np.where(inside, begins, 0), fresh])
        spent = np.concatenate([np.where(inside, 0, spent), np.zeros(len(fresh), np.int64)])
        held = np.concatenate([np.where(inside, 0, held), np.zeros(len(fresh), np.int64)])
        begun = np.concatenate([begun + inside, np.ones(len(fresh), np.int64)])
        moving = np.concatenate([inside, np.ones(len(fresh), bool)])
        while moving.any():
            live = np.flatnonzero(moving)
            begins = _next_start(running, at[live], 0, np.zeros(len(live), np.int64), budget, max_rows, flip)
            goes = begins < size
            at[live[goes]] = begins[goes]
            begun[live[goes]] += 1
            moving[live[~goes]] = False
        self.spent = spent + running[size] - running[at]
        self.held = held + size - at
        self.begun = begun
        self.starts = np.concatenate([self.starts, fresh + self.rows])
        self.costs = np.concatenate([self.costs, running[fresh] + self.total])
        self.total += int(running[size])
        self.rows += size
        self.large = bool(large[-1])


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


# A span's or several spans' function: runs of rows at which its first new group may begin, and the group
# that is then open at the end. `rows` and `costs` say where runs begin and what the partition costs before;
# `ends` and `end_costs` the same of the open group; `begun` how many groups began.
_RUNS = ["rows", "costs", "ends", "end_costs", "begun"]
_RUNS_TYPE = ", ".join(f"{name} array<bigint>" for name in _RUNS)
_PLACE = ["part", "at"]
_STATE = ["began", "spent", "groups"]
_RECORD = [*_PLACE, "lo_row", "hi_row", "lo_cost", "hi_cost", "budget", "flip"]


def _merged(runs: list[np.ndarray]) -> list[np.ndarray]:
    """Neighbouring runs of the same end as one."""
    _, _, ends, _, begun = runs
    fresh = np.ones(len(ends), dtype=bool)
    fresh[1:] = (ends[1:] != ends[:-1]) | (begun[1:] != begun[:-1])
    return [values[fresh] for values in runs]


def _lists(runs: list[np.ndarray]) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int64())) for v in runs]


def _outlooks(batches: Iterator[pa.RecordBatch], max_rows: int) -> Iterator[pa.RecordBatch]:
    """Pass 1: the function of every span."""

    def record(span: int, look: _Outlook, rows_before: int, cost_before: int) -> pa.RecordBatch:
        end, end_cost = rows_before + look.rows, cost_before + look.total
        runs = _merged([look.starts + rows_before, look.costs + cost_before, end - look.held, end_cost - look.spent, look.begun])
        return pa.RecordBatch.from_arrays([pa.array([span], pa.int64()), *_lists(runs)], ["first_at", *_RUNS])

    span, look, before = None, None, (0, 0)
    for batch in batches:
        ids, costs, large, budget, first, rows_before, cost_before = _columns(
            batch, "first_at", "cost", "is_large", "budget", "is_first", "rows_before", "cost_before"
        )
        for a, z in _runs(ids) if len(ids) else ():
            if ids[a] != span:
                if look is not None:
                    yield record(span, look, *before)
                span, look, before = int(ids[a]), _Outlook(bool(first[a])), (int(rows_before[a]), int(cost_before[a]))
            look.add(costs[a:z], large[a:z], int(budget[a]), max_rows)
    if look is not None:
        yield record(span, look, *before)


class _Span:
    """One record: where it lies in its partition, and its runs (none for a partition's last span)."""

    def __init__(self, row: dict):
        self.row = row
        self.first, self.end, self.cost, self.end_cost = row["lo_row"], row["hi_row"], row["lo_cost"], row["hi_cost"]
        self.budget, self.flip = row["budget"], row["flip"]
        self.runs = [np.asarray(row[name] if row[name] is not None else [], dtype=np.int64) for name in _RUNS]

    def passed(self, state: tuple[np.ndarray, np.ndarray, np.ndarray], max_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The states at the end, of states (row and cost at which the open group began, groups so far)."""
        began, spent, groups = state
        rows, costs, ends, end_costs, begun = self.runs
        if not len(rows):
            return state
        most = spent + self.budget
        limit = np.minimum(began + max_rows, np.where(began < self.flip, self.flip, NEVER))
        # The run of the first row that does not fit: all before a run's first row fit if their cost does.
        run = np.minimum(np.searchsorted(costs, most, side="right"), np.searchsorted(rows, limit, side="right")) - 1
        run = np.maximum(run, 0)
        goes_on = (self.end_cost <= most) & (limit >= self.end)
        return np.where(goes_on, began, ends[run]), np.where(goes_on, spent, end_costs[run]), np.where(goes_on, groups, groups + begun[run])


def _families(batches: Iterator[pa.RecordBatch], fan: int) -> Iterator[list[_Span]]:
    """Records come sorted by place; those that are composed at once begin at a multiple of `fan`."""
    held: list[_Span] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["at"] % fan == 0:
                yield held
                held = []
            held.append(_Span(row))
    if held:
        yield held


def _composed(batches: Iterator[pa.RecordBatch], max_rows: int, fan: int) -> Iterator[pa.RecordBatch]:
    """One function of up to `fan` neighbours. Its first new group may begin in any of them that lies within
    one budget of the first one's start."""
    for family in _families(batches, fan):
        head = family[0]
        runs = head.runs
        for span in family[1:]:
            ends, end_costs, begun = span.passed((runs[2], runs[3], runs[4]), max_rows)
            runs = [runs[0], runs[1], ends, end_costs, begun]
            near = (span.runs[1] <= head.cost + head.budget) & (span.runs[0] < head.first + max_rows)
            if head.row["at"] > 0 and near.any():
                runs = [np.concatenate([old, new[near]]) for old, new in zip(runs, span.runs)]
            runs = _merged(runs)
        kept = {name: value for name, value in head.row.items() if name not in _RUNS}
        kept |= {"at": head.row["at"] // fan, "hi_row": family[-1].end, "hi_cost": family[-1].end_cost}
        names = list(kept)
        arrays = [pa.array([kept[n]]) for n in names]
        yield pa.RecordBatch.from_arrays([*arrays, *_lists(runs)], [*names, *_RUNS])


def _entered(batches: Iterator[pa.RecordBatch], max_rows: int, fan: int) -> Iterator[pa.RecordBatch]:
    """The state in front of every record of a family, from that in front of the first one."""
    for family in _families(batches, fan):
        row = family[0].row
        state = tuple(np.array([row[name]], dtype=np.int64) for name in _STATE)
        out = []
        for span in family:
            out.append((*(span.row[name] for name in _PLACE), *(int(x[0]) for x in state)))
            if span.row["lo_row"] == 0 and len(span.runs[0]):  # the partition's first row begins its first group
                state = tuple(x[:1] for x in span.runs[2:])
            else:
                state = span.passed(state, max_rows)
        arrays = [pa.array(list(c), pa.int64()) for c in zip(*out)]
        yield pa.RecordBatch.from_arrays(arrays, [*_PLACE, *_STATE])


def _cut(batches: Iterator[pa.RecordBatch], max_rows: int, file_cost: int) -> Iterator[pa.RecordBatch]:
    """Pass 3: group and file number of every row, from the state on the first row of its span."""
    spent, held, large, group, passed, began = 0, 0, None, -1, 0, 0
    for batch in batches:
        costs, flags, budgets = _columns(batch, "cost", "is_large", "budget")
        states = batch.column("_state")
        group_ids, files, heads = (np.zeros(len(costs), t) for t in (np.int64, np.int64, bool))
        fresh = np.flatnonzero(states.is_valid().to_numpy(zero_copy_only=False))
        edges = np.unique(np.concatenate([[0], fresh, [len(costs)]])).astype(np.int64).tolist()
        for a, z in zip(edges[:-1], edges[1:]):
            if states[a].is_valid:
                spent, held, open_large, groups, passed = map(int, states[a].as_py().split(","))
                large, group, began = bool(open_large) if held else None, groups - 1, passed - spent
            running, flip = _block(costs[a:z], flags[a:z], large)
            size, budget, at = z - a, int(budgets[a]), 0
            starts, began_at = [], [began]
            if held == 0:
                starts, began_at = [0], [began, passed]
            while True:
                begins = int(_next_start(running, at, spent, np.int64(held), budget, max_rows, flip))
                if begins >= size:
                    break
                at, spent, held = begins, 0, 0
                starts.append(at)
                began_at.append(passed + int(running[at]))
            number = np.zeros(size, np.int64)
            number[starts] = 1
            number = np.cumsum(number)
            group_ids[a:z] = group + number
            files[a:z] = (np.array(began_at) // file_cost)[number]
            heads[a:z][starts] = True
            group, began = group + len(starts), began_at[-1]
            spent, held = spent + int(running[size] - running[at]), held + size - at
            passed, large = passed + int(running[size]), bool(flags[z - 1])
        kept = batch.select([name for name in batch.schema.names if name != "_state"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(group_ids), pa.array(files), pa.array(heads)],
            [*kept.schema.names, "group_id", "file_no", "group_head"],
        )


class Cutter:
    """The greedy cut of rows that come in order, block by block, from a group's first row on."""

    def __init__(self, budget: int, max_rows: int):
        self.budget, self.max_rows = budget, max_rows
        self.spent, self.held, self.large = 0, 0, None

    def starts(self, costs: np.ndarray, large: np.ndarray) -> list[int]:
        """The rows of the next block at which groups begin."""
        running, flip = _block(costs, large, self.large)
        out, at = [] if self.held else [0], 0
        while True:
            begins = int(_next_start(running, at, self.spent, np.int64(self.held), self.budget, self.max_rows, flip))
            if begins >= len(costs):
                break
            at, self.spent, self.held = begins, 0, 0
            out.append(at)
        self.spent += int(running[-1] - running[at])
        self.held += len(costs) - at
        self.large = bool(large[-1])
        return out


def cut_groups(ordered: DataFrame, keys: list[str], max_rows: int, file_cost: int) -> DataFrame:
    """Adds `position`, `group_id` (dense from 0), `file_no` and `group_head` to ordered rows.

    `ordered` comes from `in_order` and has `cost` and `budget` (integers of one unit) and
    `is_large`. A file takes whole groups: the group that begins at partition cost c goes to file
    c div `file_cost`, so file numbers grow but may skip.
    """
    grouping = [*keys, "budget"]
    spans, seen = materialise_observing(spans_of(ordered, grouping, "cost", "is_large"), going=F.count_if("goes_on"))
    if not seen["going"]:
        entry = spans.select(
            "first_at", *(F.lit(0).cast("bigint").alias(c) for c in ENTRY[:2]),
            F.lit(False).alias("open_large"), F.lit(0).cast("bigint").alias("groups_before"),
        )
    else:
        going = spans.where("goes_on").withColumn("is_first", F.col("rows_before") == 0)
        rows = with_spans(ordered, going.select(*grouping, "slice", "first_at", "is_first", "rows_before", "cost_before"), grouping)
        narrow = rows.select("first_at", "cost", "is_large", "budget", "is_first", "rows_before", "cost_before")
        outlooks = narrow.mapInArrow(partial(_outlooks, max_rows=max_rows), f"first_at bigint, {_RUNS_TYPE}")
        records = _records(spans, grouping).join(outlooks, "first_at", "left")
        known = records.select("first_at", *_PLACE, "lo_row", "lo_cost", "flip").join(_entries(materialise(records.drop("first_at")), max_rows), _PLACE)
        known = known.select(
            "first_at", (F.col("lo_cost") - F.col("spent")).alias("open_cost"), (F.col("lo_row") - F.col("began")).alias("open_rows"),
            (F.col("began") >= F.col("flip")).alias("open_large"), F.col("groups").alias("groups_before"),
        )
        entry = spans.select("first_at").join(known, "first_at", "left").na.fill(0).na.fill(False)
    state = spans.join(entry, "first_at")
    state = state.select(*grouping, "slice", "first_at", "rows_before", "cost_before", *ENTRY)
    rows = with_spans(ordered, state, grouping)
    # Text, as a mostly null text column is much cheaper to hand over than a mostly null list.
    numbers = ("open_cost", "open_rows", F.col("open_large").cast("int"), "groups_before", "cost_before")
    entered = F.concat_ws(",", *(F.col(c) if isinstance(c, str) else c for c in numbers))
    rows = (
        rows.withColumn("position", F.col("row_at") - F.col("first_at") + F.col("rows_before"))
        .withColumn("_state", F.when(F.col("row_at") == F.col("first_at"), entered))
        .drop("row_at", "slice", "first_at", "rows_before", "cost_before", *ENTRY)
    )
    schema = f"{_ddl(rows.drop('_state'))}, group_id bigint, file_no bigint, group_head boolean"
    return rows.mapInArrow(partial(_cut, max_rows=max_rows, file_cost=file_cost), schema)


def _records(spans: DataFrame, grouping: list[str]) -> DataFrame:
    """Where the spans of partitions in several tasks lie: their partition (named by its first row), their
    place in it, the rows and costs they reach from and to, and the partition's first large row."""
    whole, along = Window.partitionBy(*grouping), Window.partitionBy(*grouping).orderBy("slice")
    small = F.sum("span_small").over(whole)
    placed = spans.where("goes_on or rows_before > 0").select(
        "first_at", F.min("first_at").over(whole).alias("part"), (F.row_number().over(along) - 1).cast("bigint").alias("at"),
        F.col("rows_before").alias("lo_row"), (F.col("rows_before") + F.col("span_rows")).alias("hi_row"),
        F.col("cost_before").alias("lo_cost"), (F.col("cost_before") + F.col("span_cost")).alias("hi_cost"),
        "budget", F.when(small < F.sum("span_rows").over(whole), small).otherwise(F.lit(NEVER)).alias("flip"),
    )
    return placed


def _entries(records: DataFrame, max_rows: int) -> DataFrame:
    """(part, at, began, spent, groups): pass 2, the state in front of every span."""
    family = (F.col("at") / FAN).cast("bigint")
    schema = ", ".join(f"{name} bigint" for name in _RECORD) + f", {_RUNS_TYPE}"

    def by_family(rows: DataFrame) -> DataFrame:
        return rows.repartition("part", family).sortWithinPartitions("part", "at")

    levels = [records.select(*_RECORD, *_RUNS)]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) >= FAN:
        levels.append(materialise(by_family(levels[-1]).mapInArrow(partial(_composed, max_rows=max_rows, fan=FAN), schema)))
    states = None
    for level in reversed(levels):
        if states is None:
            entered = level.withColumns({name: F.lit(0).cast("bigint") for name in _STATE})
        else:
            entered = level.withColumn("family", family).join(states.withColumnRenamed("at", "family"), ["part", "family"]).drop("family")
        states = by_family(entered).mapInArrow(partial(_entered, max_rows=max_rows, fan=FAN), ", ".join(f"{name} bigint" for name in (*_PLACE, *_STATE)))
        states = materialise(states)
    return states


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
