"""A graph of stages, each writing one result: run side by side, skipped if nothing they depend on has changed."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from tributary.sources import sinks


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    compute: Callable[[], DataFrame]
    write: Callable[[DataFrame, str], None]


class Stages:
    """Stages in the order they are added; each may need results added before it and outside facts.

    A fact is a digest of something that lies outside: input files or parameters. A stage's manifest is a digest of its name, the facts and the
    manifests of what it needs; it is written beside a finished result. A result is kept if it is complete and its manifest is
    still the same, so a changed input is computed again with all that follows from it, and an interrupted run goes on where it stopped.

    Results that do not depend on each other are computed at the same time, by `workers` threads of the driver that do nothing but
    submit Spark jobs; with spark.scheduler.mode=FAIR each stage gets a pool of its own. Of the stages that could start, the one that most others
    wait for goes first. The first failure cancels what is running and starts nothing more.
    """

    def __init__(self, spark: SparkSession, out: str, facts: dict[str, str] | None = None) -> None:
        self.spark, self.out, self.facts = spark, out, facts or {}
        self.stages: dict[str, Stage] = {}
        self.between: dict[str, Future] = {}
        self.lock = Lock()

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def table(self, name: str) -> DataFrame:
        """A result that a stage needs."""
        return self.spark.read.parquet(self.path(name))

    def shared(self, name: str, compute: Callable[[], DataFrame]) -> DataFrame:
        """A table that several stages of one run read but that is no result: the first computes it, the others wait for that."""
        with self.lock:
            mine = name not in self.between
            found = self.between.setdefault(name, Future())
        if mine:
            try:
                found.set_result(compute())
            except BaseException as error:
                found.set_exception(error)
        return found.result()

    def add(self, name: str, needs: Sequence[str], compute: Callable[[], DataFrame], write: Callable[[DataFrame, str], None] | None = None) -> None:
        unknown = [n for n in needs if n not in self.stages and n not in self.facts]
        if unknown:
            raise ValueError(f"{name} needs {', '.join(unknown)}, which no earlier stage makes")
        by_name = sinks.write_csv if name.endswith(".csv") else sinks.write_table
        self.stages[name] = Stage(name, tuple(needs), compute, write or by_name)

    def manifests(self) -> dict[str, str]:
        found = dict(self.facts)
        for stage in self.stages.values():
            found[stage.name] = digest([stage.name, *[found[n] for n in stage.needs]])
        return found

    def waiting(self) -> dict[str, int]:
        """How many stages need each stage, directly or through others."""
        before: dict[str, set[str]] = {}
        for stage in self.stages.values():
            needed = [n for n in stage.needs if n in self.stages]
            before[stage.name] = set(needed).union(*[before[n] for n in needed])
        return {name: sum(name in b for b in before.values()) for name in self.stages}

    def run(self, workers: int = 4) -> dict[str, str]:
        """Run what has to be; returns where each result lies."""
        manifests = self.manifests()
        self.between.clear()
        open_ = {n: s for n, s in self.stages.items() if not sinks.is_complete(self.spark, self.path(n), manifests[n])}
        group, running = f"stages-{uuid.uuid4().hex}", {}
        context, waiting, workers = self.spark.sparkContext, self.waiting(), max(1, workers)

        def work(stage: Stage) -> None:
            context.setJobGroup(group, stage.name)
            context.setLocalProperty("spark.scheduler.pool", stage.name)
            path = self.path(stage.name)
            sinks.forget(self.spark, path)  # a result that is written half must not look finished
            stage.write(stage.compute(), path)
            sinks.remember(self.spark, path, manifests[stage.name])

        with ThreadPoolExecutor(workers) as pool:
            while open_ or running:
                ready = [s for s in open_.values() if not any(n in open_ or n in running.values() for n in s.needs)]
                ready.sort(key=lambda s: -waiting[s.name])
                for stage in ready[: workers - len(running)]:  # no more than can begin now: a stage that is ready later may be more urgent
                    running[pool.submit(work, stage)] = open_.pop(stage.name).name
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                failed = [f for f in done if f.exception()]
                if failed:
                    self.stop(running, group)
                    raise failed[0].exception()
                for future in done:
                    running.pop(future)
        return {name: self.path(name) for name in self.stages}

    def stop(self, running: dict[Future, str], group: str) -> None:
        for future in running:
            future.cancel()
        while True:  # a stage may submit its next job after its last was cancelled
            self.spark.sparkContext.cancelJobGroup(group)
            if not wait(running, timeout=0.5).not_done:
                return


def digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()
