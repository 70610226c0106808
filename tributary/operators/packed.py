"""Loops over the arcs of a graph with few nodes.

The arcs lie packed in the executors, a few arrays for each partition, and are never moved again. What is known of the nodes, no
more rows than a block has, is held as arrays by the driver and copied to the executors for every round, so that a round is one job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tributary.session import share_code

#: Of each block of arcs: its near ends, how many arcs each has, their far ends and weights; inner is the weight of a near end to itself.
PACKED = {"near": np.int32, "degree": np.int32, "other": np.int32, "w": np.float64, "inner": np.float64}


def schema(columns: Iterable[str]) -> str:
    return ", ".join(f"{c} binary" for c in columns)


def row(arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array([a.tobytes()], pa.binary()) for c, a in arrays.items()})


def arrays(batch: pa.RecordBatch, kinds: dict[str, type]) -> Iterator[dict[str, np.ndarray]]:
    for i in range(batch.num_rows):
        yield {c: np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()}


def joined(blocks: list[dict[str, np.ndarray]], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([b[c] for b in blocks]) if blocks else np.empty(0, kind) for c, kind in kinds.items()}


def starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def summed(near: np.ndarray, other: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(near, other, w) once for each pair, in order."""
    keys = near.astype(np.int64) * n + other
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = starts(keys)
    return near[order][at], other[order][at], np.add.reduceat(w[order], at) if len(at) else w


#: Arcs on their way to the executor where they will lie, in as many parts by their near end as there are rows.
DEALT = {"node": np.int32, "other": np.int32, "w": np.float64}
#: Parts for each partition; they are dealt out by hash, so that more of them are dealt more evenly.
PARTS = 4
#: Rows that a task packs at a time.
AT_ONCE = 1_000_000


def dealt(node: np.ndarray, other: np.ndarray, w: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row for each part that has arcs."""
    part = node % parts
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    arcs = {c: a.astype(kind)[order] for (c, kind), a in zip(DEALT.items(), (node, other, w))}
    cut_up = {c: pa.array([a[bounds[p] : bounds[p + 1]].tobytes() for p in some], pa.binary()) for c, a in arcs.items()}
    return pa.RecordBatch.from_pydict({"part": pa.array(some, pa.int32()), **cut_up})


def deal(arcs: DataFrame, ids: np.ndarray, width: int, both: bool = False) -> DataFrame:
    """arcs(node, other, w), with `both` seen from either end, as rows of `DEALT`; ends by their place among `ids`, which are in order."""
    share_code(arcs.sparkSession)
    known = arcs.sparkSession.sparkContext.broadcast(ids)

    def of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        node, other = (np.searchsorted(known.value, table.column(c).to_numpy()).astype(np.int32) for c in ("node", "other"))
        w = table.column("w").to_numpy()
        if both:
            node, other, w = np.concatenate([node, other]), np.concatenate([other, node]), np.concatenate([w, w])
        return dealt(node, other, w, PARTS * width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
            if rows >= AT_ONCE:
                yield of(waiting)
                waiting, rows = [], 0
        if waiting:
            yield of(waiting)

    return arcs.select("node", "other", "w").mapInArrow(run, f"part int, {schema(DEALT)}")


def pack(arcs: DataFrame, n: int, width: int, merge: bool = False) -> DataFrame:
    """Dealt arcs between n nodes in blocks of `PACKED` by their near end, kept.

    With `merge`, equal pairs are added up, and a node's weight to itself is set apart as `inner`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for part, found in zip(batch.column("part").to_pylist(), arrays(batch, DEALT)):
                parts.setdefault(part, []).append(found)
        for part in sorted(parts):
            whole = joined(parts.pop(part), DEALT)
            yield row(in_blocks(whole["node"], whole["other"], whole["w"], n, merge))

    return arcs.repartition(width, "part").mapInArrow(run, schema(PACKED)).persist(StorageLevel.MEMORY_AND_DISK)


def in_blocks(near: np.ndarray, other: np.ndarray, w: np.ndarray, n: int, merge: bool) -> dict[str, np.ndarray]:
    if merge:
        near, other, w = summed(near, other, w, n)
    else:
        order = np.argsort(near.astype(np.int64) * n + other, kind="stable")
        near, other, w = near[order], other[order], w[order]
    ends, place = np.unique(near, return_inverse=True)
    own = (near == other) if merge else np.zeros(len(near), bool)
    inner = np.bincount(place[own], w[own], len(ends)).astype(np.float64)
    degree = np.bincount(place[~own], minlength=len(ends)).astype(np.int32)
    return {"near": ends.astype(np.int32), "degree": degree, "other": other[~own], "w": w[~own], "inner": inner}


def over(blocks: DataFrame, facts, compute: Callable, columns: str) -> tuple[DataFrame, object]:
    """The batches compute(block, facts) of every block; with the copy of `facts` in the executors, to be destroyed when it is used up."""
    copy = blocks.sparkSession.sparkContext.broadcast(facts)
    kinds = {c: PACKED[c] for c in blocks.columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in arrays(batch, kinds):
                yield compute(block, copy.value)

    return blocks.mapInArrow(run, columns), copy


def gathered(frame: DataFrame, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """The arrays of all rows, one after the other."""
    found = [{c: np.frombuffer(r[c], kind) for c, kind in kinds.items()} for r in frame.select(*kinds).collect()]
    return joined(found, kinds)


def table(spark: SparkSession, columns: dict[str, np.ndarray]) -> DataFrame:
    return spark.createDataFrame(pa.table(columns))


# --- Spark's xxhash64, for what is drawn by hash --------------------------------

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def hash_with(ids: np.ndarray, number: int) -> np.ndarray:
    """F.xxhash64(ids, F.lit(number)) of longs and a number, as unsigned; lit makes a number of over 31 bits a long."""
    with np.errstate(over="ignore"):
        found = _hashed(ids.astype(np.int64).view(np.uint64), np.full(len(ids), 42, np.uint64))
        if -(1 << 31) <= number < 1 << 31:
            bits = np.uint64(number & 0xFFFFFFFF)
            found = (found + _P5 + np.uint64(4)) ^ (bits * _P1)
            return _mixed(_turned(found, 23) * _P2 + _P3)
        return _hashed(np.full(len(ids), number & 0xFFFFFFFFFFFFFFFF, np.uint64), found)


def _hashed(longs: np.ndarray, seed: np.ndarray) -> np.ndarray:
    found = (seed + _P5 + np.uint64(8)) ^ (_turned(longs * _P2, 31) * _P1)
    return _mixed(_turned(found, 27) * _P1 + _P4)


# --- PageRank ----------------------------------------------------------------------

RECEIVED = {"near": np.int32, "received": np.float64}


def received_by(block: dict[str, np.ndarray], per_unit: np.ndarray) -> pa.RecordBatch:
    """What the near ends of a block get, if every far end gives `per_unit` for a unit of weight."""
    begin = np.cumsum(block["degree"]) - block["degree"]
    return row({"near": block["near"], "received": np.add.reduceat(block["w"] * per_unit[block["other"]], begin)})


def received(blocks: DataFrame, per_unit: np.ndarray) -> np.ndarray:
    """What every node gets from the arcs that lie at their receiving ends."""
    frame, copy = over(blocks, per_unit, received_by, schema(RECEIVED))
    seen = gathered(frame, RECEIVED)
    copy.destroy()
    return np.bincount(seen["near"], seen["received"], len(per_unit))


# --- Louvain ----------------------------------------------------------------------

WISHES = {"active": np.int32, "links": np.int64, "node": np.int32, "target": np.int32, "delta": np.float64}


def wishes_of(block: dict[str, np.ndarray], facts: dict) -> pa.RecordBatch:
    """What the active nodes of a block wish: each the community where it gains most, if it gains by moving.

    `facts` has comm, total and k of all nodes (comm and total by their place), which of them `changed` and which
    are active `again` or `rest`; without `changed` all are active.
    """
    near, degree, other, w = block["near"], block["degree"], block["other"], block["w"]
    active = picked(block, facts)
    n, keep = len(facts["comm"]), np.repeat(active, degree)
    near, degree, other, w = near[active], degree[active], other[keep], w[keep]
    at = np.repeat(np.arange(len(near)), degree)
    at, comm, w = summed(at, facts["comm"][other], w, n)
    home, k = facts["comm"][near], facts["k"][near]
    cost = facts["rate"] * k
    at_home = comm == home[at]
    gain = w - cost[at] * np.where(at_home, facts["total"][comm] - k[at], facts["total"][comm])
    stay = -cost * (facts["total"][home] - k)
    stay[at[at_home]] = gain[at_home]
    best, target = np.full(len(near), -np.inf), np.zeros(len(near), np.int32)
    away = np.flatnonzero(~at_home)
    if len(away):
        first = starts(at[away])
        best[at[away][first]] = np.maximum.reduceat(gain[away], first)
        top = away[gain[away] == best[at[away]]][::-1]  # of equal ones the smallest community is written last
        target[at[top]] = comm[top]
    delta = best - stay
    wants = delta > facts["least"] * k
    return row({"active": near, "links": degree.sum(keepdims=True, dtype=np.int64), "node": near[wants], "target": target[wants], "delta": delta[wants]})


def picked(block: dict[str, np.ndarray], facts: dict) -> np.ndarray:
    """Which of a block's near ends are active: neighbours of nodes that changed, and those active `again`, without those at `rest`."""
    near, degree = block["near"], block["degree"]
    if facts["changed"] is None:
        return degree > 0
    ends = np.concatenate([[0], np.cumsum(facts["changed"][block["other"]])])
    upto = np.concatenate([[0], np.cumsum(degree)])
    touched = ends[upto[1:]] > ends[upto[:-1]]
    return (touched | facts["again"][near]) & ~facts["rest"][near] & (degree > 0)


ARCS = {"near": np.int32, "degree": np.int32, "other": np.int32, "w": np.float64}


def arcs_of(block: dict[str, np.ndarray], active: np.ndarray) -> pa.RecordBatch:
    kept = active[block["near"]] & (block["degree"] > 0)
    keep = np.repeat(kept, block["degree"])
    return row({"near": block["near"][kept], "degree": block["degree"][kept], "other": block["other"][keep], "w": block["w"][keep]})


def granted_together(node: np.ndarray, home: np.ndarray, target: np.ndarray, k: np.ndarray, delta: np.ndarray, n: int, rate: float, drawn: np.ndarray, single: bool) -> np.ndarray:
    """Which wishes are granted together: no community gives and receives in one round. See _Level.independent."""
    order = np.lexsort((node, delta))

    def side(at: np.ndarray) -> tuple:
        best = np.full(n, -1)
        best[at[order]] = order  # the best is written last
        weight, squares, gain = (np.bincount(at, x, n) for x in (k, k * k, delta))
        pairs = (weight * weight - squares) * rate / 2
        share = np.ones(n)
        np.divide(gain, 4 * pairs, out=share, where=pairs > 0)
        return best, share

    (enter, share_in), (leave, share_out) = side(target), side(home)
    place = np.empty(len(node) + 1, np.int64)
    place[order], place[-1] = np.arange(len(node)), -1  # where a community has no wish
    receives = (enter >= 0) & (place[enter] > place[leave])
    fits = ~receives[home] & receives[target]
    index = np.arange(len(node))
    first = (leave[home] == index) & (enter[target] == index)
    lucky = drawn < np.minimum(share_out[home], share_in[target]) * (1 << 20)
    return fits & (first if single else first | lucky)


def may_cost(was: np.ndarray, now: np.ndarray, k: np.ndarray, n: int, rate: float) -> float:
    """What moves into or out of one community may cost each other."""
    lost = 0.0
    for at in (was, now):
        weight, squares = np.bincount(at, k, n), np.bincount(at, k * k, n)
        lost += (weight * weight - squares).sum()
    return lost * rate / 2


class PackedLevel:
    """One coarsening level of a graph with few nodes; the rounds are those of community._Level, and so is their outcome.

    ids, k, own: of the nodes, in the order of their ids; arcs are dealt. Communities are named by the place of their id.
    """

    def __init__(self, spark: SparkSession, ids: np.ndarray, k: np.ndarray, own: np.ndarray, arcs: DataFrame, width: int, merge: bool = False) -> None:
        self.spark, self.ids, self.k, self.width = spark, ids, k, width
        self.blocks = pack(arcs, len(ids), width, merge)
        kinds = {c: PACKED[c] for c in ("near", "degree", "inner")}
        seen = gathered(self.blocks, kinds)
        self.links = int(seen["degree"].sum(dtype=np.int64))
        self.own = own + np.bincount(seen["near"], seen["inner"], len(ids))

    def modularity(self, two_m: float, resolution: float) -> float:
        """Of the partition that made this level's nodes."""
        return self.own.sum() / two_m - resolution * (self.k * self.k).sum() / two_m**2

    def look(self, facts: dict) -> dict[str, np.ndarray]:
        """The active nodes, how many arcs they have, and their wishes in the order of the nodes."""
        frame, copy = over(self.blocks, facts, wishes_of, schema(WISHES))
        seen = gathered(frame, WISHES)
        copy.destroy()
        order = np.argsort(seen["node"], kind="stable")
        return seen | {c: seen[c][order] for c in ("node", "target", "delta")}

    def in_turn(self, active: np.ndarray, comm: np.ndarray, total: np.ndarray, run: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(node, target, delta): where the active nodes end if one task lets them move one after another until none gains."""
        chosen = np.zeros(len(comm), bool)
        chosen[active] = True
        frame, copy = over(self.blocks, chosen, arcs_of, schema(ARCS))
        facts = self.spark.sparkContext.broadcast((self.ids, self.k, comm, total))

        def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arcs = joined([a for b in batches for a in arrays(b, ARCS)], ARCS)
            if len(arcs["near"]):
                yield row(moves(arcs, *facts.value, run))

        seen = gathered(frame.repartition(1).mapInArrow(settle, schema(MOVES)), MOVES)
        copy.destroy()
        facts.destroy()
        return np.searchsorted(self.ids, seen["node"]), np.searchsorted(self.ids, seen["target"]), seen["delta"]

    def settle(self, two_m: float, rate: float, least: float, seed: int, fits: int, one_by_one: Callable, arcs_read: list[int], start: np.ndarray | None) -> tuple[np.ndarray, bool]:
        """(the community of every node when no node gains by moving, did any move). See _Level.settle."""
        n, k = len(self.ids), self.k
        comm = np.arange(n) if start is None else start
        none, changed, again, rest = np.zeros(n, bool), None, None, None
        any_moved, round_ = False, 0
        if not self.links:
            arcs_read.append(0)
            return comm, False
        while True:
            total, coin = np.bincount(comm, k, n), seed * 1000 + round_
            if changed is None and self.links <= fits:
                active, reads = np.arange(n), self.links
            else:
                facts = {"comm": comm.astype(np.int32), "total": total, "k": k, "rate": rate, "least": least, "changed": changed, "again": again, "rest": rest}
                seen = self.look(facts)
                active, reads = seen["active"], int(seen["links"].sum())
            if not reads:  # a community's total may have changed far from its members: all nodes once more
                changed = None
                continue
            arcs_read.append(reads)
            full, changed, again, rest = reads == self.links, none.copy(), none.copy(), none.copy()
            if reads <= fits:
                node, target, delta = self.in_turn(active, comm, total, one_by_one(seed=coin))
                rest[active] = True
            else:
                node, target, delta = (seen[c] for c in ("node", "target", "delta"))
                again[node] = True
                drawn = hash_with(self.ids[node], coin) & np.uint64((1 << 20) - 1)
                for single in (False, True):
                    granted = granted_together(node, comm[node], target, k[node], delta, n, rate, drawn, single)
                    lost = may_cost(comm[node[granted]], target[granted], k[node[granted]], n, rate)
                    if not granted.any() or delta[granted].sum() > lost:
                        break
                node, target = node[granted], target[granted]
            comm, changed[node] = comm.copy(), True
            comm[node] = target
            any_moved, round_ = any_moved or len(node) > 0, round_ + 1
            if full and (not len(node) or self.links <= fits):
                return comm, any_moved

    def contract(self, comm: np.ndarray) -> PackedLevel:
        """Communities become the nodes of the next level."""
        at, place = np.unique(comm, return_inverse=True)
        arcs, _ = over(self.blocks, (place.astype(np.int32), len(at), PARTS * self.width), merged_arcs, f"part int, {schema(DEALT)}")
        k, own = (np.bincount(place, x, len(at)) for x in (self.k, self.own))
        return PackedLevel(self.spark, self.ids[at], k, own, arcs, self.width, True)

    def close(self) -> None:
        """Drop what only this level reads."""
        self.blocks.unpersist()


def merged_arcs(block: dict[str, np.ndarray], facts: tuple) -> pa.RecordBatch:
    """The arcs between communities that a block's arcs amount to, dealt."""
    place, n, parts = facts
    return dealt(*summed(np.repeat(place[block["near"]], block["degree"]), place[block["other"]], block["w"], n), parts)


MOVES = {"node": np.int64, "target": np.int64, "delta": np.float64}


def moves(arcs: dict[str, np.ndarray], ids: np.ndarray, k: np.ndarray, comm: np.ndarray, total: np.ndarray, run: Callable) -> dict[str, np.ndarray]:
    """What `run` (a community.OneByOne) makes of these arcs."""
    import pandas as pd

    near, other = np.repeat(arcs["near"], arcs["degree"]), arcs["other"]
    home, there = comm[near], comm[other]
    found = run(pd.DataFrame({
        "node": ids[near], "other": ids[other], "w": arcs["w"], "k": k[near],
        "home": ids[home], "home_total": total[home], "comm": ids[there], "total": total[there],
    }))
    return {c: found[c].to_numpy().astype(kind) for c, kind in MOVES.items()}


def communities(ground: PackedLevel, two_m: float, resolution: float, settings: dict, seed: int, min_gain: float, cycles: int) -> np.ndarray:
    """The community of every node of the ground level. `settings` go to every settle. See community.louvain."""
    at, last = np.arange(len(ground.ids)), None
    for cycle in range(cycles):
        level, depth, start = ground, 0, at if cycle else None
        while True:
            before = level.modularity(two_m, resolution)
            comm, any_moved = level.settle(two_m, resolution / two_m, seed=seed + depth, start=start, **settings)
            start = None
            if not any_moved:
                break
            # an id of this level is a community of the one before
            up = np.searchsorted(ground.ids, level.ids[comm])
            at = up[np.searchsorted(level.ids, ground.ids[at])] if depth else up
            finer, level, depth = level, level.contract(comm), depth + 1
            if finer is not ground:
                finer.close()
            if level.modularity(two_m, resolution) <= before + min_gain:
                break
        found = level.modularity(two_m, resolution)
        if level is not ground:
            level.close()
        if not depth or last is not None and found <= last + min_gain:
            break
        last = found
    ground.close()
    return at


def named(at: np.ndarray, strength: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster id, place of the representative) of every node: clusters count from 0 in the order of their smallest
    members, the representative is the member of highest strength, the smallest of equal ones."""
    _, first, place = np.unique(at, return_index=True, return_inverse=True)
    number = np.empty(len(first), np.int64)
    number[np.argsort(first, kind="stable")] = np.arange(len(first))
    cluster = number[place]
    top = np.empty(len(first), np.int64)
    order = np.lexsort((-np.arange(len(at)), strength))  # the strongest is written last, of equal ones the smallest
    top[cluster[order]] = order
    return cluster, top[cluster]
