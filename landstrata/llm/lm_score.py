"""Texts scored by a smoothed n-gram model, run as a backoff automaton.

Model. p(w) = (c(w) + 1) / (N + V + 1) over the N training tokens with V distinct ones, the last share
being that of all unknown words. A longer history h, with h' being h without its first word, adds
p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m): Dirichlet smoothing, which sums to one for every history.
As an automaton: histories seen in training are states; a state has an arc for each word seen after it,
weighed log10 p(w | h), and a failure arc to h' weighed log10 of m / (c(h) + m), taken without reading
when it has no arc for the next word.

Counts cover all training texts and grow with them, so the model lies in no single place:

1. Tasks encode texts, in groups of some two million tokens, as numbers of the group's own words. This
   is stored, and holds what follows in place of the texts.
2. A group sends the sorted keys of its distinct n-grams, with its own counts, to shards of the key
   space. Shards sum them and send back to a group, in that order, what the others have seen of them.
3. A group thus knows the counts of all n-grams that its texts can ask for. It builds the part of the
   automaton that they can reach, and runs its texts through it from left to right.

A common n-gram is one row entry a group, whatever its count, and shards are ranges of hashes, so no
key is hot. N-grams are told apart by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.llm.blobs import packed, packed_sorted, unpacked, unpacked_sorted
from landstrata.llm.text import mix, ragged, seeds, slices, utf8, word_hashes
from landstrata.session import materialise, ship

ORDER = 2
# Weight of the shorter history, in occurrences.
PRIOR = 400.0
# Tokens of a group, and n-grams of a shard, on average.
GROUP = 1 << 21
SHARD = 1 << 21
# Tokens that the automaton reads of a text in one piece; pieces are read side by side.
PIECE = 1024

_ODD = np.uint64(0x9E3779B97F4A7C15)
END, BEGIN = seeds(2, 13)


def score(
    docs: DataFrame, learns: Column, order: int = ORDER, prior: float = PRIOR, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, learns, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are the words of a text, runs without ASCII white space with A-Z as a-z, and one end.
    Rows for which `learns` holds are learned from. `n_known` counts tokens that training has,
    `train_tokens` all tokens of training. `base_score` is the log10 probability of the text by p(w)
    alone, `score` by histories of up to `order` - 1 words; a text's first history is its beginning.

    Null texts are empty: one token, the end. A null `learns` is false; repeated rows count as often
    as they are there; null keys are kept. A text of any length lies in one group. Without training
    rows every score is 0. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(learns, F.lit(False)).alias("learns"), F.col(text).alias("text"))
    blobs = "words binary, tokens binary, sizes binary"
    groups = materialise(rows.mapInArrow(_encoded, f"part long, {blobs}, learns array<boolean>, ids array<{kind}>, n long, n_train long, n_begun long"))
    seen = groups.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "n_train", "n_begun"))).first()

    bits = max(0, int(seen.n * order // SHARD).bit_length())
    asked = groups.mapInArrow(partial(_asked, order=order, bits=bits), "shard long, size int, part long, keys binary, counts binary")
    asked = asked.repartition("shard").sortWithinPartitions("shard", "size")
    told = materialise(asked.mapInArrow(_told, "part long, size int, shard long, counts binary, known long"))
    known = told.where("part is null").agg(F.coalesce(F.sum("known"), F.lit(0)).alias("known")).first().known

    none = F.lit(None)
    told = told.where("part is not null").select("part", "size", "shard", none.cast("binary").alias("words"), F.col("counts").alias("blob"), none.cast("binary").alias("sizes"), none.cast("array<boolean>").alias("learns"), none.cast(f"array<{kind}>").alias("ids"))
    groups = groups.select("part", F.lit(order + 1).alias("size"), F.lit(0).cast("bigint").alias("shard"), "words", F.col("tokens").alias("blob"), "sizes", "learns", "ids")
    met = told.unionByName(groups).repartition("part").sortWithinPartitions("part", "size", "shard")
    scored = partial(_scored, order=order, bits=bits, prior=prior, total=float(seen.n_train + known + 1), begun=seen.n_begun)
    out = met.mapInArrow(scored, f"doc_id {kind}, learns boolean, n_tokens long, n_known long, base_score double, score double")
    columns = [F.col("doc_id").alias(key), "learns", "n_tokens", "n_known", F.lit(seen.n_train).cast("bigint").alias("train_tokens"), "base_score", "score"]
    return out.select(*columns)


# ---- inside a task -------------------------------------------------------------------------------


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of texts: the hashes of their words, the most frequent first, and texts as their numbers."""
    part = TaskContext.get().partitionId() << 32
    hashes, sizes, learns, ids, held = [], [], [], [], 0

    def group() -> pa.RecordBatch:
        every, counts = np.concatenate(hashes), np.concatenate(sizes)
        words, at, often = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.argsort(-often, kind="stable")
        number = np.empty(len(words), dtype=np.uint32)
        number[rank] = np.arange(len(words), dtype=np.uint32)
        train = pa.concat_arrays(learns)
        own = train.to_numpy(zero_copy_only=False)
        keys = pa.concat_arrays(ids)
        # Of words as frequent as each other the hashes ascend.
        one = [packed_sorted(words[rank]), packed(number[at]), packed(counts.astype(np.uint32))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], type=pa.int32()), x) for x in (train, keys)]
        numbers = [pa.array([int(v)]) for v in (len(every), counts[own].sum(), own.sum())]
        names = ["part", "words", "tokens", "sizes", "learns", "ids", "n", "n_train", "n_begun"]
        return pa.RecordBatch.from_arrays([pa.array([part]), *(pa.array([b], type=pa.binary()) for b in one), *lists, *numbers], names)

    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in slices(np.diff(offsets)):
            words, bounds = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            hashes.append(np.insert(words, bounds[1:], END))
            sizes.append(np.diff(bounds) + 1)
            learns.append(batch.column("learns").slice(a, b - a))
            ids.append(batch.column("doc_id").slice(a, b - a))
            held += len(hashes[-1])
            if held >= GROUP:
                yield group()
                part += 1
                hashes, sizes, learns, ids, held = [], [], [], [], 0
    if held:
        yield group()


class Grams(NamedTuple):
    """The distinct n-grams of one size in a group."""

    keys: np.ndarray  # 64-bit names
    counts: np.ndarray  # in the group's training texts
    history: np.ndarray  # number of the n-gram without its last word, among those one shorter
    word: np.ndarray  # the last word
    suffix: np.ndarray  # number of the n-gram without its first word, among those one shorter


def grams(words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, learns: np.ndarray, order: int) -> list[Grams]:
    """The n-grams of sizes 1 to `order`. A text's beginning is a word that stands only there; as a
    history its number is that after the last word."""
    n = len(words)
    train = np.repeat(learns, sizes).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    nothing = np.zeros(0, dtype=np.int64)
    counts = np.bincount(tokens, weights=train, minlength=n).astype(np.int64)
    out = [Grams(mix(words + np.uint64(1)), counts, nothing, np.arange(n), nothing)]
    at, valid = tokens.astype(np.int64), np.ones(len(tokens), dtype=bool)
    shorter_keys = np.append(out[0].keys, mix(np.array([BEGIN], dtype=np.uint64)))
    for size in range(2, order + 1):
        history = np.empty_like(at)
        history[1:] = at[:-1]
        now = np.ones(len(tokens), dtype=bool)
        now[1:] = valid[:-1]
        now[starts] = size == 2
        history[starts] = n
        places = np.flatnonzero(now)
        codes, first, number = np.unique(history[places] * n + tokens[places], return_index=True, return_inverse=True)
        before, word = codes // n, codes % n
        keys = mix(shorter_keys[before] * _ODD + words[word] + np.uint64(size))
        counts = np.bincount(number, weights=train[places], minlength=len(codes)).astype(np.int64)
        out.append(Grams(keys, counts, before, word, at[places[first]]))
        at, valid, shorter_keys = np.full(len(tokens), -1, dtype=np.int64), now, keys
        at[places] = number
    return out


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, tokens and sizes of a group's row."""
    return unpacked_sorted(row["words"]), unpacked(row["tokens"], np.uint32).astype(np.int64), unpacked(row["sizes"], np.uint32).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            cells = {name: batch.column(name)[k] for name in batch.schema.names}
            yield {name: cell.values if name == "ids" else cell.as_py() for name, cell in cells.items()}


def _shards(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, first, end) of sorted keys."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), dtype=np.int64)
    cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(keys)).tolist()
    yield from ((int(shard[x]), x, y) for x, y in zip(cuts[:-1], cuts[1:]))


def _asked(batches: Iterator[pa.RecordBatch], order: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The sorted keys and own counts of a group's n-grams, a row for each shard and size."""
    for row in _rows(batches):
        for size, held in enumerate(grams(*_opened(row), np.array(row["learns"], dtype=bool), order), start=1):
            by = np.argsort(held.keys)
            keys, counts = held.keys[by], held.counts[by].astype(np.uint32)
            spans = list(_shards(keys, bits))
            for a in range(0, len(spans), 1000):
                own = spans[a : a + 1000]
                arrays = [pa.array([s for s, _, _ in own], type=pa.int64()), pa.array([size] * len(own), type=pa.int32()), pa.array([row["part"]] * len(own), type=pa.int64())]
                arrays += [pa.array([packed_sorted(keys[x:y]) for _, x, y in own], type=pa.binary()), pa.array([packed(counts[x:y]) for _, x, y in own], type=pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["shard", "size", "part", "keys", "counts"])


def _runs(rows: Iterator[dict], *names: str) -> Iterator[list[dict]]:
    """Neighbouring rows that agree in `names`."""
    held: list[dict] = []
    for row in rows:
        if held and any(row[n] != held[0][n] for n in names):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each group what the others have counted of its n-grams of a shard, in the order of their keys, if
    anything; and the number of distinct words in training, in rows without a group."""
    names = ["part", "size", "shard", "counts", "known"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
    for run in _runs(_rows(batches), "shard", "size"):
        keys = [unpacked_sorted(row["keys"]) for row in run]
        counts = [unpacked(row["counts"], np.uint32).astype(np.int64) for row in run]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
        out, began, shard, size = [], 0, run[0]["shard"], run[0]["size"]
        for row, own, count in zip(run, keys, counts):
            others = total[at[began : began + len(own)]] - count
            began += len(own)
            if others.any():
                out.append((row["part"], size, shard, packed(others), None))
        if size == 1:
            out.append((None, size, shard, None, int((total > 0).sum())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*out), kinds)], names)


class Automaton(NamedTuple):
    """States are numbers; 0 is that without a history, which has an arc for every word."""

    n: int  # words
    begin: int  # state of a text's beginning
    first: np.ndarray  # weights of the arcs of state 0
    enter: np.ndarray  # and where they lead
    arcs: np.ndarray  # state * n + word of the other arcs, ascending
    weight: np.ndarray
    target: np.ndarray
    fail: np.ndarray  # the state that a state's failure arc leads to
    backoff: np.ndarray  # and its weight


def automaton(held: list[Grams], counts: list[np.ndarray], total: float, begun: int, prior: float) -> Automaton:
    """From n-grams and how often all training has them; `begun` counts its texts."""
    n, order = len(counts[0]), len(held)
    chance = (counts[0] + 1) / total
    first, enter = np.log10(chance), np.zeros(n, dtype=np.int64)
    if order == 1:
        none = np.zeros(0, dtype=np.int64)
        return Automaton(n, 0, first, enter, none, np.zeros(0), none, np.zeros(1, dtype=np.int64), np.zeros(1))
    # States of one size are numbered one after the other: words and the beginning, then pairs, ...
    seen, base = np.append(counts[0], begun), 1
    state = np.where(seen > 0, np.arange(n + 1) + base, 0)
    enter, begin = state[:n], int(state[n])
    fails, backoffs = [np.zeros(n + 2, dtype=np.int64)], [np.zeros(1), np.log10(prior / (seen + prior))]
    arcs, weights, targets = [], [], []
    for size in range(2, order + 1):
        own, count = held[size - 1], counts[size - 1]
        chance = (count + prior * chance[own.suffix]) / (seen[own.history] + prior)
        base += len(state)
        there = np.where(count > 0, np.arange(len(count)) + base, 0)
        leads = there if size < order else state[own.suffix]
        has = np.flatnonzero(count > 0)
        arcs.append(state[own.history[has]] * n + own.word[has])
        weights.append(np.log10(chance[has]))
        targets.append(leads[has])
        if size < order:
            fails.append(state[own.suffix])
            backoffs.append(np.log10(prior / (count + prior)))
        state, seen = there, count
    arcs, weights, targets = (np.concatenate(x) for x in (arcs, weights, targets))
    by = np.argsort(arcs)
    return Automaton(n, begin, first, enter, arcs[by], weights[by], targets[by], np.concatenate(fails), np.concatenate(backoffs))


def _step(machine: Automaton, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every state reads its word: the states reached, and the weights of all arcs taken."""
    gained, reached = np.zeros(len(states)), np.zeros(len(states), dtype=np.int64)
    going, states = np.arange(len(states)), states.copy()
    while len(going):
        free = states[going] == 0
        done = going[free]
        gained[done] += machine.first[words[done]]
        reached[done] = machine.enter[words[done]]
        going = going[~free]
        code = states[going] * machine.n + words[going]
        at = np.searchsorted(machine.arcs, code)
        hit = at < len(machine.arcs)
        hit[hit] = machine.arcs[at[hit]] == code[hit]
        gained[going[hit]] += machine.weight[at[hit]]
        reached[going[hit]] = machine.target[at[hit]]
        going = going[~hit]
        gained[going] += machine.backoff[states[going]]
        states[going] = machine.fail[states[going]]
    return reached, gained


def traverse(machine: Automaton, tokens: np.ndarray, sizes: np.ndarray, order: int, piece: int | None = None) -> np.ndarray:
    """The log10 probability of every text (all have tokens), read from left to right.

    Texts are read in pieces, all pieces side by side. A piece that does not begin its text first
    reads the `order` - 1 tokens before it, uncounted: the state then is the same as after all of them.
    """
    piece = piece or PIECE
    pieces = -(-sizes // piece)
    text = np.repeat(np.arange(len(sizes)), pieces)
    inner = ragged(np.zeros(len(sizes), dtype=np.int64), pieces) * piece
    starts = (np.cumsum(sizes) - sizes)[text] + inner
    length = np.minimum(sizes[text] - inner, piece)
    by = np.argsort(-length, kind="stable")
    text, inner, starts, length = text[by], inner[by], starts[by], length[by]
    states = np.where(inner < order - 1, machine.begin, 0)
    for back in range(order - 1, 0, -1):
        early = np.flatnonzero(inner >= back)
        states[early], _ = _step(machine, states[early], tokens[starts[early] - back])
    total = np.zeros(len(starts))
    for t in range(int(length[0]) if len(length) else 0):
        m = int(np.searchsorted(-length, -t, side="left"))  # pieces longer than t
        states[:m], gained = _step(machine, states[:m], tokens[starts[:m] + t])
        total[:m] += gained
    return np.bincount(text, weights=total, minlength=len(sizes))


def _scored(batches: Iterator[pa.RecordBatch], order: int, bits: int, prior: float, total: float, begun: int) -> Iterator[pa.RecordBatch]:
    others: dict[tuple[int, int], np.ndarray] = {}
    for row in _rows(batches):
        if row["size"] <= order:
            others[row["size"], row["shard"]] = unpacked(row["blob"], np.int64)
            continue
        row["tokens"] = row["blob"]
        (words, tokens, sizes), learns = _opened(row), np.array(row["learns"], dtype=bool)
        held, counts = grams(words, tokens, sizes, learns, order), []
        for size, own in enumerate(held, start=1):
            count, by = own.counts.copy(), np.argsort(own.keys)
            for shard, x, y in _shards(own.keys[by], bits):
                if (size, shard) in others:
                    count[by[x:y]] += others[size, shard]
            counts.append(count)
        others = {}
        machine = automaton(held, counts, total, begun, prior)
        scores = traverse(machine, tokens, sizes, order)
        starts = np.cumsum(sizes) - sizes
        base = np.add.reduceat(machine.first[tokens], starts)
        known = np.add.reduceat((counts[0] > 0)[tokens].astype(np.int64), starts)
        yield pa.RecordBatch.from_arrays([row["ids"], pa.array(learns), pa.array(sizes), pa.array(known), pa.array(base), pa.array(scores)], ["doc_id", "learns", "n_tokens", "n_known", "base_score", "score"])
