"""Best-fit packing of token pieces into sequences by a configuration linear program.

A configuration is a multiset of lengths that fit in one sequence. The program covers the histogram of lengths with as
few configurations as it can. It is solved by multiplicative weights: each length has a dual price, its size times an
exponential of how far its coverage is behind; a knapsack dynamic program over the prices finds, for every length at once, the
configuration of the highest price that holds it; coverage rises in steps, which get finer until the measured duality gap is
at most `gap`. Any prices bound the optimum from below (their total over the highest price of a configuration), and so do the
sizes; what covers everything bounds it from above.

The fractional solution is rounded: whole multiples first, then the configurations with the largest fractions as far as
pieces are left for them. What remains is a histogram again and is solved again, until a solution places few pieces or none;
that last remainder goes by best fit, longest first.

All of that works on the histogram (at most `capacity` rows, whatever the corpus) on the driver. Pieces get their places
in the cluster: each piece's rank among those of its length comes from counts by (length, salt), so a length that
a third of all pieces share is dealt over many tasks; a rank falls in a range of sequences of one configuration, and the
table of ranges is bounded by the number of configurations times the lengths in one.

Defined results: a null or empty text is one piece that holds the separator alone. Rows that repeat, share an id or have none
are packed each for itself. Only texts longer than a sequence are cut: into whole sequences, and the first piece takes the
rest. An empty table gives none. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenantgraph.llm.shared import named, slices, stash
from tenantgraph.llm.tokens import token_bytes

Groups = list[tuple[tuple[int, ...], int]]


class Prices:
    """The knapsack table of prices: values[s - 1] is that of length s, -inf for one that may not be used."""

    def __init__(self, values: np.ndarray):
        capacity = len(values)
        self.best, self.pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
        usable = np.flatnonzero(values > -np.inf) + 1
        few = 4 * len(usable) < capacity
        fit = np.searchsorted(usable, np.arange(capacity + 1), side="right").tolist()
        worth = values[usable - 1]
        for c in range(1, capacity + 1):
            self.best[c] = self.best[c - 1]
            if n := fit[c]:
                total = worth[:n] + self.best[c - usable[:n]] if few else values[:c] + self.best[c - 1 :: -1]
                k = int(total.argmax())
                if total[k] > self.best[c] + 1e-12:
                    self.best[c], self.pick[c] = total[k], usable[k] if few else k + 1

    def multiset(self, room: int) -> list[int]:
        """The lengths of the highest total price that fit."""
        out = []
        while room > 0:
            if self.pick[room]:
                out.append(int(self.pick[room]))
                room -= out[-1]
            else:
                room -= 1
        return out


def bound_by(counts: np.ndarray, value: np.ndarray, prices: Prices) -> float:
    """Prices that no configuration's total exceeds, once divided by the highest, bound the number of sequences from below."""
    return float((counts * value).sum()) / max(prices.best[len(counts)], 1e-9)


def bounds(counts: np.ndarray) -> float:
    """The best of the bounds by sizes, by how many of a length fit, and by sizes with all above half as whole."""
    capacity = len(counts)
    length = np.arange(1, capacity + 1)
    found = float((counts * length).sum()) / capacity
    for value in (1 / (capacity // length), np.where(2 * length > capacity, 1, length / capacity)):
        found = max(found, bound_by(counts, value, Prices(np.where(counts > 0, value, -np.inf))))
    return found


def cover(counts: np.ndarray, step: float, rate: float = 4.0) -> tuple[dict[tuple[int, ...], float], float]:
    """(configuration -> amount, a lower bound): amounts that cover counts[s - 1] pieces of each length s, in rounds that raise all
    coverage by a step. A round ends when all are there, or when a new table of prices brings nothing; then what it leaves has its turn in the next, and
    what the last one leaves is covered by each length alone."""
    capacity = len(counts)
    present = counts > 0
    size = np.arange(1, capacity + 1) / capacity
    bound = 0.0
    done = np.zeros(capacity)  # coverage, of counts
    x: dict[tuple[int, ...], float] = defaultdict(float)
    level = 0.0
    while level < 1 - 1e-9:
        level = min(1.0, level + step)
        moved = 1.0
        while moved > 1e-6 and (behind := present & (done < level - 1e-9)).any():
            moved = 0.0
            value = np.where(behind, size * np.exp(rate * (level - done)), 0)
            prices = Prices(np.where(behind, value, -np.inf))
            bound = max(bound, bound_by(counts, value, prices))  # the others' prices are zero
            order = np.flatnonzero(behind)
            for s in (order[np.argsort(done[order] - size[order], kind="stable")] + 1).tolist():
                if done[s - 1] >= level - 1e-9:
                    continue
                config = tuple(sorted([s, *prices.multiset(capacity - s)], reverse=True))
                held = Counter(config)
                amount = min(max(0.0, level - done[r - 1]) * counts[r - 1] / a for r, a in held.items())
                if amount > 1e-12:
                    x[config] += amount
                    moved += amount
                    for r, a in held.items():
                        done[r - 1] += a * amount / counts[r - 1]
    for s in (np.flatnonzero(present & (done < 1 - 1e-6)) + 1).tolist():
        x[(s,) * (capacity // s)] += (1 - done[s - 1]) * counts[s - 1] / (capacity // s)
    return x, bound


def solve(counts: np.ndarray, gap: float, steps: tuple[float, ...] = (0.5, 0.2, 0.08, 0.03)) -> tuple[dict[tuple[int, ...], float], float]:
    """(configuration -> amount, duality gap): steps get finer until the gap is small enough, or a finer one brings less than a thousandth."""
    bound, found, best = bounds(counts), {}, np.inf
    for step in steps:
        x, below = cover(counts, step)
        bound, before = max(bound, below), best
        if sum(x.values()) < best:
            found, best = x, sum(x.values())
        if best <= bound * (1 + gap) or best > 0.999 * before:
            break
    return found, float(best / max(bound, 1e-9) - 1)


def best_fit(left: np.ndarray, groups: Groups, capacity: int) -> Groups:
    """Longest first, each into the fullest sequence that takes it; equal sequences move together."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for config, times in groups:
        room[capacity - sum(config)].append((config, times))
    for s in range(capacity, 0, -1):
        n = int(left[s - 1])
        while n:
            fits = [r for r, held in room.items() if r >= s and held]
            if not fits:
                each = capacity // s
                room[capacity - s * each] += [((s,) * each, n // each)] if n >= each else []
                if n % each:
                    room[capacity - s * (n % each)].append(((s,) * (n % each), 1))
                break
            r = min(fits)
            config, times = room[r].pop()
            each = min(r // s, n)
            used = min(times, n // each)
            room[r - each * s].append((config + (s,) * each, used))
            if times > used:
                room[r].append((config, times - used))
            n -= used * each
    return [g for held in room.values() for g in held if g[1]]


def used(groups: dict[tuple[int, ...], int], capacity: int) -> np.ndarray:
    return sum((np.bincount(config, minlength=capacity + 1)[1:] * n for config, n in groups.items()), np.zeros(capacity, np.int64))


def program(counts: np.ndarray, gap: float, least_fill: float = 0.998, max_phases: int = 12) -> tuple[dict[tuple[int, ...], int], list[float]]:
    """(configuration -> number of sequences, the gaps of the solutions): what the rounded solutions place. Sequences with more room
    than least_fill leaves wait for the next solution, unless they are whole multiples of one whose gap is closed."""
    capacity = len(counts)
    left = counts.copy()
    groups: Counter[tuple[int, ...]] = Counter({(capacity,): int(left[-1])} if left[-1] else {})
    left[-1] = 0
    gaps = []
    for _ in range(max_phases):
        before = int(left.sum())
        if before < 2:
            break
        x, own = solve(left.astype(float), gap) if not gaps else solve(left.astype(float), gap, (0.5,))  # a remainder is small and coarse
        gaps.append(own)
        for whole in (True, False):
            for config, amount in sorted(x.items(), key=lambda y: (-y[0][0], -sum(y[0]), -(y[1] % 1), y[0]) if not whole else (-y[1], y[0])):
                if sum(config) < least_fill * capacity and not (whole and own <= gap):
                    continue
                held = Counter(config)
                times = min([int(amount + 1e-6) if whole else 1, *(int(left[s - 1]) // a for s, a in held.items())])
                if times > 0:
                    groups[config] += times
                    for s, a in held.items():
                        left[s - 1] -= a * times
        if before - int(left.sum()) < 0.02 * before:
            break
    return groups, gaps


def pack_histogram(histogram: dict[int, int], capacity: int, gap: float = 0.01) -> Groups:
    """length -> pieces to (configuration, number of sequences); every piece is in exactly one."""
    counts = np.zeros(capacity, np.int64)
    for s, n in histogram.items():
        counts[s - 1] = n
    groups, _ = program(counts, gap)
    return best_fit(counts - used(groups, capacity), list(groups.items()), capacity)


def ranges(groups: Groups) -> dict[str, np.ndarray]:
    """Where the k-th piece of a length goes: rows sorted by (length, first rank)."""
    rows, at, base = [], Counter(), 0
    for config, times in groups:
        offset = 0
        for s, a in sorted(Counter(config).items(), reverse=True):
            rows.append((s, at[s], a, base, offset))
            at[s] += a * times
            offset += s * a
        base += times
    rows.sort()
    return dict(zip(("length", "first", "each", "base", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pieces(docs: DataFrame, *, id_col: str, text_col: str, capacity: int, separator: int = 0, tokenizers: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): each text's ids and the separator, cut to at most capacity."""
    read = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_bytes(tokenizers)
        for batch, texts in slices(batches, 1, 4 << 20):
            rows, out = [], [[], [], [], [], []]
            for i, text in enumerate(texts):
                ids = encode(text) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    rows.append(i)
                    own = ids[4 * a : 4 * b]
                    for column, value in zip(out, (k, a, b - a, zlib.crc32(own), own), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)][: 5 if with_ids else 4]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], ["id", "piece", "start", "length", "ids_crc32", "ids"][: 1 + len(columns)])

    return read.mapInArrow(run, f"id {read.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def place(cut: DataFrame, capacity: int, rows_each: int = 100_000, salts: int = 64) -> DataFrame:
    """cut (id, piece, start, length, ...) with sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    where = ranges(pack_histogram(histogram, capacity))
    salts = max(salts, -(-sum(histogram.values()) // rows_each))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before"))
    ranked = ranked.select(*cut.columns, F.col("rank").cast("long"))
    shift = 1 << 44  # more pieces of one length than any corpus holds
    keys = where["length"] * shift + where["first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            k = np.searchsorted(keys, length * shift + rank, side="right") - 1
            copy, nth = np.divmod(rank - where["first"][k], where["each"][k])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(where["base"][k] + copy, pa.int64()), pa.array(where["offset"][k] + nth * length, pa.int64())], [*batch.schema.names[:-1], "sequence_id", "offset"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, `offset` long")


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, separator: int = 0, tokenizers: str | None = None, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece."""
    cut = stash(pieces(docs, id_col=id_col, text_col=text_col, capacity=capacity, separator=separator, tokenizers=tokenizers, with_ids=with_ids), "packing-pieces")
    return place(cut, capacity).withColumnRenamed("id", id_col)
