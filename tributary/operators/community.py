"""Modularity and distributed Louvain communities on an undirected weighted graph.

folded(i, j, w) holds each pair once with i < j.
"""

from __future__ import annotations

from collections import deque
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators import packed
from tributary.operators.links import both_ways, weighted_degree
from tributary.operators.pagerank import hot_sources
from tributary.operators.skew import Chain, copy_to_blocks, fits_broadcast, positions, salt_rows, salted_join, shuffles, spread_join
from tributary.session import block_rows, cut, discard, layout_width, share_code


def modularity(folded: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """One row `modularity` of labels(node, cluster_id); unlabelled nodes stand alone."""
    own = F.coalesce(
        F.concat(F.lit("cluster "), F.col("cluster_id").cast("string")),
        F.concat(F.lit("node "), F.col("node").cast("string")),
    )
    strengths = weighted_degree(folded).join(labels.select("node", "cluster_id"), "node", "left")
    totals = strengths.groupBy(own.alias("c")).agg(F.sum("wdeg").alias("k"))
    spread = totals.agg(F.sum("k").alias("two_m"), F.sum(F.col("k") * F.col("k")).alias("squares"))
    left = labels.select(F.col("node").alias("i"), F.col("cluster_id").alias("ci"))
    right = labels.select(F.col("node").alias("j"), F.col("cluster_id").alias("cj"))
    tagged = Chain(folded, "i", "j").join(left, "i").join(right, "j").df
    same = F.when(F.col("ci") == F.col("cj"), F.col("w"))
    inside = tagged.agg(F.coalesce(F.sum(same), F.lit(0.0)).alias("inside")).scalar()
    q = 2 * inside / F.col("two_m") - resolution * F.col("squares") / (F.col("two_m") * F.col("two_m"))
    return spread.select(q.alias("modularity"))


#: A move must gain more than this, as a share of the node's strength; less is rounding.
LEAST_GAIN = 1e-10
#: Blocks of arcs that one task may settle node by node: two million arcs, about half a gigabyte there.
ONE_TASK = 4


class _Level:
    """One coarsening level: nodes(id, k, own, links) and arcs(node, other, w) in both directions.

    k is a node's strength, own its weight to itself counted from both ends, links the number of its arcs.
    The arcs are laid out by their near end once and kept for all rounds. A node with very many arcs is split into
    blocks. What is known of the nodes goes to the arcs: if there are `few`, no more than a block has rows, as a copy for every
    executor, so that no round moves or sorts the arcs for it; else by joins that spread.
    """

    def __init__(self, nodes: DataFrame, arcs: DataFrame, block: int | None, *sources: DataFrame) -> None:
        self.nodes, self.sources, self.block = nodes, sources, block
        facts = nodes.agg(
            F.count("*").alias("nodes"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"),
            F.sum("k").alias("k"), F.sum("own").alias("own"), F.sum(F.col("k") * F.col("k")).alias("k2"),
        ).first()
        self.links, self.facts = facts["links"], facts
        self.few = facts["nodes"] <= (block or block_rows(nodes.sparkSession))
        self.hot = hot_sources(nodes, self.links, block)
        self.on = ["node", "_salt"] if self.hot else ["node"]
        laid = salt_rows(arcs, ["node"], self.hot) if self.hot else arcs
        self.arcs = laid.repartition(layout_width(nodes.sparkSession, self.links), *self.on).persist(StorageLevel.MEMORY_AND_DISK)

    def modularity(self, resolution: float) -> float:
        """Of the partition that made this level's nodes."""
        two_m = self.facts["k"]
        return (self.facts["own"] or 0.0) / two_m - resolution * self.facts["k2"] / two_m**2

    def near(self, some: DataFrame) -> DataFrame:
        """The arcs of some nodes (node, ...), with what `some` says of them."""
        if self.few:
            return self.arcs.join(F.broadcast(some), "node").drop("_salt")
        return self.arcs.join(copy_to_blocks(some, ["node"], self.hot) if self.hot else some, self.on)

    def far(self, arcs: DataFrame, facts: DataFrame) -> DataFrame:
        """Facts (other, ...) of the far ends. Every node has as many arcs coming as going, so one hot list serves both ends."""
        if self.few:
            return arcs.join(F.broadcast(facts), "other")
        return arcs.join(facts, "other") if fits_broadcast(facts) else salted_join(arcs, facts, ["other"], "inner", self.hot)

    def know(self, rows: DataFrame, *facts: tuple[str, DataFrame], how: str = "inner") -> DataFrame:
        """Rows about nodes with facts of which there is one for a node or a community: (key, facts) ..."""
        if self.few:
            return reduce(lambda all_, fact: all_.join(F.broadcast(fact[1]), fact[0], how), facts, rows)
        chain = Chain(rows, *[key for key, _ in facts], block=self.block)
        return reduce(lambda all_, fact: all_.join(fact[1], fact[0], how), facts, chain).df

    def seen(self, state: DataFrame) -> DataFrame:
        """The arcs of the active nodes with both ends' communities: node, other, w, k, home, home_total, comm, total."""
        totals = state.groupBy("comm").agg(F.sum("k").alias("total"), F.count("*").alias("size"))
        placed = self.know(state, ("comm", totals))
        here = placed.where("active").select(F.col("id").alias("node"), "k", F.col("comm").alias("home"), F.col("total").alias("home_total"))
        return self.far(self.near(here), placed.select(F.col("id").alias("other"), "comm", "total"))

    def one_by_one(self, state: DataFrame, two_m: float, resolution: float, seed: int) -> DataFrame:
        """(node, target, delta): where the active nodes end if they move one after another until none gains. For arcs that fit a block."""
        run = OneByOne(resolution / two_m, seed)
        share_code(state.sparkSession)
        columns = ["node", "other", "w", "k", "home", "home_total", "comm", "total"]
        return self.seen(state).select(*columns).groupBy().applyInPandas(lambda rows: run(rows), "node long, target long, delta double")

    def wishes(self, state: DataFrame, two_m: float, resolution: float) -> DataFrame:
        """(node, home, target, k, delta): active nodes that would gain by moving, each to the community where it gains most."""
        options = self.seen(state).groupBy("node", "comm").agg(
            F.sum("w").alias("w"), *[F.max(c).alias(c) for c in ("k", "home", "home_total", "total")]
        )
        cost = F.lit(resolution / two_m) * F.col("k")
        at_home = F.col("comm") == F.col("home")
        gain = F.col("w") - cost * F.when(at_home, F.col("total") - F.col("k")).otherwise(F.col("total"))
        best = F.struct((-F.col("gain")).alias("loss"), F.col("comm"))
        choice = options.withColumn("gain", gain).groupBy("node").agg(
            *[F.max(c).alias(c) for c in ("k", "home", "home_total")],
            F.min(F.when(~at_home, best)).alias("best"), F.max(F.when(at_home, F.col("gain"))).alias("stay"),
        )
        stay = F.coalesce("stay", -cost * (F.col("home_total") - F.col("k")))
        found = choice.select("node", "home", F.col("best.comm").alias("target"), "k", (-F.col("best.loss") - stay).alias("delta"))
        return found.where(F.col("delta") > F.lit(LEAST_GAIN) * F.col("k"))

    def independent(self, wishes: DataFrame, two_m: float, resolution: float, coin: int, single: bool) -> DataFrame:
        """The wishes that are granted together: no community gives and receives in one round.

        Two moves can only undo each other if one goes where the other leaves, or if both enter or both leave one community. A
        community receives if the best wish to enter it beats the best to leave it, and gives otherwise; the best
        wish of all is always granted. Nodes that enter or leave together cost resolution k k' / 2m for each pair at most; where that may
        outweigh a community's gains, only a share of the wishes is granted, by hash. With `single`, each community takes part in one
        move at most.
        """
        rank = F.struct("delta", "node")
        sides = wishes.select(F.explode(F.array(
            F.struct(F.col("home").alias("comm"), F.lit(False).alias("enters")), F.struct(F.col("target").alias("comm"), F.lit(True).alias("enters"))
        )).alias("at"), "node", "k", "delta")
        one_way = lambda enters, what: F.when(F.col("at.enters") == enters, what)
        facts = sides.groupBy("at.comm").agg(
            F.max(one_way(True, rank)).alias("enter"), F.max(one_way(False, rank)).alias("leave"),
            *[F.sum(one_way(enters, F.col(c) * F.col(d))).alias(f"{c}{d}{enters}") for enters in (True, False) for c, d in (("k", "k"),)],
            *[F.sum(one_way(enters, F.col(c))).alias(f"{c}{enters}") for enters in (True, False) for c in ("k", "delta")],
        )

        def share(enters: bool):
            pairs = (F.col(f"k{enters}") * F.col(f"k{enters}") - F.col(f"kk{enters}")) * F.lit(resolution / two_m) / 2
            return F.when(pairs <= 0, F.lit(1.0)).otherwise(F.col(f"delta{enters}") / (4 * pairs))

        receives = F.coalesce(F.col("enter") > F.col("leave"), F.col("enter").isNotNull())
        facts = facts.select("comm", receives.alias("receives"), F.when(receives, F.col("enter.node")).otherwise(F.col("leave.node")).alias("first"),
                             F.when(receives, share(True)).otherwise(share(False)).alias("share"))
        leaving = facts.where(~F.col("receives")).select(F.col("comm").alias("home"), F.col("first").alias("a"), F.col("share").alias("share_a"))
        entering = facts.where("receives").select(F.col("comm").alias("target"), F.col("first").alias("b"), F.col("share").alias("share_b"))
        both = self.know(wishes, ("home", leaving), ("target", entering))
        first = (F.col("a") == F.col("node")) & (F.col("b") == F.col("node"))
        drawn = F.pmod(F.xxhash64("node", F.lit(coin)), F.lit(1 << 20)) < F.least("share_a", "share_b") * (1 << 20)
        return both.where(first if single else first | drawn).select("node", "target", "delta")

    def moved(self, state: DataFrame, granted: DataFrame, again: DataFrame | None) -> DataFrame:
        """The next state: new communities; active are the neighbours of nodes that moved, and the nodes of `again`. Without `again`, the
        nodes that were active are settled among themselves and rest."""
        granted = granted.withColumnsRenamed({"target": "to", "delta": "gained"})
        touched = self.near(granted.select("node")).select(F.col("other").alias("id"))
        if again is not None:
            touched = touched.unionByName(again.select(F.col("node").alias("id")))
        touched = touched.distinct().withColumn("touched", F.lit(True))
        granted, touched = [F.broadcast(facts) if self.few else facts for facts in (granted.withColumnRenamed("node", "id"), touched)]
        after = state.drop("was", "gained").join(granted, "id", "left").join(touched, "id", "left")
        active = F.col("touched").isNotNull() & (F.lit(again is not None) | ~F.col("active"))
        return after.select(
            "id", "k", "own", "links", F.coalesce("to", "comm").alias("comm"), active.alias("active"),
            F.when(F.col("to").isNotNull(), F.col("comm")).alias("was"), "gained",
        )

    def judged(self, state: DataFrame, two_m: float, resolution: float):
        """One row: nodes moved, what the modularity gained at least (times m), arcs of the nodes now active."""
        ends = state.where("was is not null").select("k", F.explode(F.array(F.struct("comm", F.lit(1).alias("side")), F.struct(F.col("was").alias("comm"), F.lit(0).alias("side")))).alias("at"))
        pairs = ends.groupBy("at").agg((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("pairs"))
        lost = pairs.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)) * (resolution / two_m / 2)).scalar()
        return state.agg(
            F.count("was").alias("moved"), (F.coalesce(F.sum("gained"), F.lit(0.0)) - lost).alias("gained"),
            F.coalesce(F.sum(F.when(F.col("active"), F.col("links"))), F.lit(0)).alias("links"),
        ).first()

    def settle(self, two_m: float, resolution: float, seed: int, arcs_read: list[int], start: DataFrame | None = None) -> tuple[DataFrame, bool]:
        """(state in which no node gains by moving, did any move), from `start` (id, comm) or from every node alone.

        A round looks at the active nodes only. When none of them gains, all nodes are looked at once more,
        because a community's total may have changed far from its members. Every round raises the modularity: what the moves of a
        round may cost each other is summed up, and a round that might lose is done again with single moves. As soon as the arcs of
        the active nodes fit ONE_TASK blocks, one task lets these nodes move one after another, which ends the long tail of rounds with few moves.
        """
        alone = self.nodes.withColumn("comm", F.col("id")) if start is None else self.nodes.join(start, "id")
        state = alone.withColumn("active", F.lit(True))
        reads, any_moved, round_, fits = self.links, False, 0, ONE_TASK * block_rows(state.sparkSession)
        while True:
            full, coin = reads == self.links, seed * 1000 + round_
            arcs_read.append(reads)
            if reads <= fits:
                granted = cut(self.one_by_one(state, two_m, resolution, coin))
                after, used = cut(self.moved(state, granted, None)), [granted]
                seen = self.judged(after, two_m, resolution)
            else:
                wishes = cut(self.wishes(state, two_m, resolution))
                used = [wishes]
                for single in (False, True):
                    granted = self.independent(wishes, two_m, resolution, coin, single)
                    after = cut(self.moved(state, granted, wishes))
                    seen = self.judged(after, two_m, resolution)
                    if not seen["moved"] or seen["gained"] > 0:
                        break
                    discard(after)
            discard(*used, state)
            any_moved, round_, state, reads = any_moved or seen["moved"] > 0, round_ + 1, after, seen["links"]
            if full and (not seen["moved"] or self.links <= fits):
                return state, any_moved
            if not reads:
                state, reads = after.withColumn("active", F.lit(True)), self.links
                state.written_at = after.written_at

    def contract(self, state: DataFrame) -> _Level:
        """Communities become the nodes of the next level."""
        placed = state.select(F.col("id").alias("node"), F.col("comm").alias("from"))
        ends = self.far(self.near(placed), placed.withColumnsRenamed({"node": "other", "from": "to"}))
        pairs = cut(ends.groupBy("from", "to").agg(F.sum("w").alias("w")))
        out = pairs.groupBy(F.col("from").alias("id")).agg(
            F.sum(F.when(F.col("from") == F.col("to"), F.col("w"))).alias("inner"), F.count_if(F.col("from") != F.col("to")).alias("links")
        )
        merged = state.groupBy(F.col("comm").alias("id")).agg(F.sum("k").alias("k"), F.sum("own").alias("own"))
        own = F.col("own") + F.coalesce("inner", F.lit(0.0))
        nodes = cut(merged.join(out, "id", "left").select("id", "k", own.alias("own"), F.coalesce("links", F.lit(0)).alias("links")))
        arcs = pairs.where(F.col("from") != F.col("to")).select(F.col("from").alias("node"), F.col("to").alias("other"), "w")
        return _Level(nodes, arcs, self.block, nodes, pairs)

    def close(self) -> None:
        """Drop what only this level reads."""
        self.arcs.unpersist()
        discard(*self.sources)


class OneByOne:
    """Sequential moves of some nodes, all their arcs and the totals of all communities they touch being known."""

    def __init__(self, cost: float, seed: int) -> None:
        self.cost, self.seed = cost, seed

    def __call__(self, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "other"])
        node, start, degree = np.unique(rows["node"].to_numpy(), return_index=True, return_counts=True)
        first = rows.iloc[start]
        place = {n: i for i, n in enumerate(node.tolist())}
        home, k = first["home"].tolist(), first["k"].tolist()
        comm = home.copy()
        total = dict(zip(rows["comm"].tolist(), rows["total"].tolist())) | dict(zip(home, first["home_total"].tolist()))
        other = [place.get(o, -1) for o in rows["other"].tolist()]  # -1: a node that stays where it is
        there, weight = rows["comm"].tolist(), rows["w"].tolist()
        ends = (start + degree).tolist()
        start = start.tolist()
        mixed = (node.astype(np.uint64) + np.uint64(self.seed)) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(mixed, kind="stable").tolist()
        queue, moves, asked = deque(order), 0, 0
        waiting, gained = [True] * len(node), [0.0] * len(node)
        while queue:
            i = queue.popleft()
            waiting[i] = False
            to: dict[int, float] = {}
            for at in range(start[i], ends[i]):
                c = there[at] if other[at] < 0 else comm[other[at]]
                to[c] = to.get(c, 0.0) + weight[at]
            now, cost = comm[i], self.cost * k[i]
            stay = to.pop(now, 0.0) - cost * (total[now] - k[i])
            best, target = max(((w - cost * total[c], -c) for c, w in to.items()), default=(stay, 0))
            if best > stay + LEAST_GAIN * k[i]:
                total[now] -= k[i]
                comm[i] = -target
                total[comm[i]] += k[i]
                gained[i] += best - stay
                moves += 1
                for at in range(start[i], ends[i]):
                    j = other[at]
                    if j >= 0 and not waiting[j]:
                        waiting[j] = True
                        queue.append(j)
            if not queue and moves != asked:  # totals have changed for those that are no neighbours too
                asked, waiting = moves, [True] * len(node)
                queue.extend(order)
        moved = [i for i in range(len(node)) if comm[i] != home[i]]
        return pd.DataFrame({"node": node[moved], "target": [comm[i] for i in moved], "delta": [gained[i] for i in moved]})


def louvain(
    folded: DataFrame,
    resolution: float = 1.0,
    seed: int = 42,
    min_gain: float = 1e-7,
    block: int | None = None,
    cycles: int = 2,
    arcs_read: list[int] | None = None,
) -> DataFrame:
    """labels(node, cluster_id, representative) by Louvain rounds of moves that cannot undo each other.

    Ids count from 0 in the order of each community's smallest member; the
    representative is the member of highest weighted degree. The outcome depends
    on the graph, the seed and the block size of the session, not on partitioning. A level ends when no
    node gains by moving, the run when a level gains less than `min_gain`; a larger
    one saves jobs for a little less modularity. Further `cycles` start again from the nodes with the communities found, so that
    nodes can leave a community that others have joined since; they end early if one gains too little. `arcs_read` gets the number of arcs that each round looked at.
    """
    arcs_read = [] if arcs_read is None else arcs_read
    if shuffles(folded):
        folded = cut(folded)  # read twice
    strengths = both_ways(folded).groupBy("node").agg(F.sum("w").alias("wdeg"), F.count("*").alias("links"), F.count("w").alias("weights"))
    numbered = cut(positions(strengths, [F.asc("node")], "place"))
    size = numbered.agg(F.count("*"), F.max("links"), F.sum("links"), F.sum("weights")).first()
    total, most = size[2] or 0, block or block_rows(folded.sparkSession)
    if size[0] <= most and total and size[1] <= most and size[3] == total:
        return _of_few(folded, numbered, total, resolution, seed, min_gain, cycles, arcs_read)
    numbered = numbered.drop("weights")
    hot = hot_sources(numbered.select(F.col("node").alias("id"), "links"), total, block)
    low = numbered.select(F.col("node").alias("i"), F.col("place").alias("a"))
    high = numbered.select(F.col("node").alias("j"), F.col("place").alias("b"))
    # No node is on either side of more pairs than it has arcs, so one hot list serves both joins.
    pairs = spread_join(spread_join(folded, low, "i", hot=hot), high, "j", hot=hot)
    arcs = cut(both_ways(pairs.select(F.col("a").alias("i"), F.col("b").alias("j"), "w")))
    numbered = numbered.withColumnRenamed("place", "id")
    nodes = numbered.select("id", F.col("wdeg").alias("k"), F.lit(0.0).alias("own"), "links")
    two_m = nodes.agg(F.sum("k")).first()[0]
    at, last = numbered.select("id", F.col("id").alias("comm")), None
    ground = _Level(nodes, arcs, block, arcs) if two_m else None
    for cycle in range(cycles if two_m else 0):
        level, depth, start = ground, 0, at if cycle else None
        while True:
            before = level.modularity(resolution)
            state, any_moved = level.settle(two_m, resolution, seed + depth, arcs_read, start)
            start = None
            if not any_moved:
                discard(state)
                break
            step = state.select(F.col("id").alias("comm"), F.col("comm").alias("up"))
            old, at = at, cut(spread_join(at, step, "comm").select("id", F.col("up").alias("comm")) if depth else state.select("id", "comm"))
            discard(old)
            finer, level, depth = level, level.contract(state), depth + 1
            discard(state)
            if finer is not ground:
                finer.close()
            if level.modularity(resolution) <= before + min_gain:
                break
        found = level.modularity(resolution)
        if level is not ground:
            level.close()
        if not depth or last is not None and found <= last + min_gain:
            break
        last = found
    if ground:
        ground.close()
    return _name(numbered, at)


def _of_few(folded: DataFrame, numbered: DataFrame, links: int, resolution: float, seed: int, min_gain: float, cycles: int, arcs_read: list[int]) -> DataFrame:
    """The same rounds for no more nodes than a block has rows: names and facts of the nodes are copied, the arcs stay where they are."""
    spark = folded.sparkSession
    named = numbered.select("place", "node")
    low, high = (F.broadcast(named.select(F.col("node").alias(end), F.col("place").alias(id_))) for end, id_ in (("i", "a"), ("j", "b")))
    pairs = folded.join(low, "i").join(high, "j").select(F.col("a").alias("node"), F.col("b").alias("other"), "w")
    facts = numbered.select("place", "wdeg").toArrow().sort_by("place")
    ids, strength = (facts.column(c).to_numpy() for c in ("place", "wdeg"))
    two_m, at = strength.sum(), np.arange(len(ids))
    if two_m:
        width = layout_width(spark, links)
        ground = packed.PackedLevel(spark, ids, strength, np.zeros(len(ids)), packed.deal(pairs, ids, width, both=True), width)
        settings = {"least": LEAST_GAIN, "fits": ONE_TASK * block_rows(spark), "one_by_one": partial(OneByOne, resolution / two_m), "arcs_read": arcs_read}
        at = packed.communities(ground, two_m, resolution, settings, seed, min_gain, cycles)
    cluster, top = packed.named(at, strength)
    found = F.broadcast(packed.table(spark, {"place": ids, "cluster_id": cluster, "top": ids[top]}))
    names = F.broadcast(named.select(F.col("place").alias("top"), F.col("node").alias("representative")))
    return named.join(found, "place").join(names, "top").select("node", "cluster_id", "representative")


def _name(numbered: DataFrame, at: DataFrame) -> DataFrame:
    members = numbered.join(at, "id")
    rank = F.struct((-F.col("wdeg")).alias("falling"), F.col("node"))
    groups = members.groupBy("comm").agg(
        F.min("id").alias("first"), F.min(rank).alias("top")
    )
    ordered = positions(groups, [F.asc("first")], "place")
    named = ordered.select(
        "comm",
        (F.col("place") - 1).alias("cluster_id"),
        F.col("top.node").alias("representative"),
    )
    return spread_join(members, named, "comm").select("node", "cluster_id", "representative")
