import threading
from functools import reduce
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import DataFrame

from tributary.operators import links
from tributary.plans.build import build_graph, load_dump
from tributary.plans.stages import Stages
from tributary.plans.workflow import run_all
from tributary.session import checkpoint_root
from tributary.sources import sinks

# Artists 1..6; the sixth is unknown, the fifth is a second spelling of the first.
ARTISTS = [(1, "Kool & the Gang"), (2, "Beta feat. Guest"), (3, "Gamma, The"), (4, "Delta"), (5, "Cool Gang"), (6, "[unknown]")]
SONGS = [(100 + i, f"Song {i}", 1 + i % 6) for i in range(18)]
# link id -> type; 999 is no reuse.
KINDS = {1: 69, 2: 231, 3: 230, 4: 999}


def write(folder, name, lines):
    (folder / name).write_text("".join("\t".join(map(str, line)) + "\n" for line in lines))


def dump(folder):
    write(folder, "recording", [(i, f"r{i}", n, c, r"\N", "", 0, "now", "f") for i, n, c in SONGS])
    write(folder, "artist", [(i, f"gid{i}", n, n) for i, n in ARTISTS])
    credits = [(i, 0, i, n, "") for i, n in ARTISTS] + [(1, 1, 4, "Delta", "")]
    write(folder, "artist_credit_name", credits)
    write(folder, "link", [(i, t, *[r"\N"] * 6, 0, "now", "f") for i, t in KINDS.items()])
    pairs = [(a, b) for a in range(100, 118) for b in (a - 1, a - 4, a - 6) if b >= 100]
    write(folder, "l_recording_recording", [(n, 1 + n % 4, a, b, 0, "now", 0) for n, (a, b) in enumerate(pairs)])
    write(folder, "track", [(n, "g", s, n % 5) for n, (s, _, _) in enumerate(SONGS)])
    write(folder, "medium", [(i, i % 3, "more") for i in range(5)])
    write(folder, "release", [(i, "g", "n", 1, i) for i in range(3)])
    write(folder, "release_group_meta", [(0, 1, 1990), (1, 1, 1985), (2, 1, r"\N")])
    (folder / "aliases.json").write_text('{"Cool Gang": "Kool & the Gang"}')


def test_graph_from_dump(spark, tmp_path):
    dump(tmp_path)
    tables = load_dump(spark, str(tmp_path))
    graph = build_graph(tables, spark.createDataFrame([("Cool Gang", "Kool & the Gang")], "variant string, canonical string"))
    names = {n for r in rows(graph, "Sampler_Artist_Name", "Original_Artist_Name") for n in r}
    assert names == {"Kool and the Gang", "Beta", "The Gamma", "Delta"}
    # Two GIDs share one name now: the edge stays here and goes at artist level.
    edges = links.as_edges(graph)
    assert edges.where("src = dst").count() > 0
    assert links.drop_self_loops(edges).where("src = dst").count() == 0
    assert {r[0] for r in rows(graph, "weight")} == {0.5, 1.0}
    years = {r[0] for r in rows(graph, "Sampler_Release_Year")}
    assert years <= {1990, 1985, None}


def test_all_stages_and_a_second_run(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    dump(source)
    between = Path(checkpoint_root(spark).removeprefix("file:"))
    kept = set(between.glob("tables-*/*"))
    written = run_all(spark, str(source), str(out), str(source / "aliases.json"), ["Kool Gang The", "Delta", "Nobody"])
    assert {p.name for p in out.iterdir()} == set(written)
    assert set(between.glob("tables-*/*")) == kept  # nothing but the results is left
    before = {p: p.stat().st_mtime_ns for p in out.rglob("part-*")}
    run_all(spark, str(source), str(out), str(source / "aliases.json"), ["Kool Gang The", "Delta", "Nobody"])
    assert {p: p.stat().st_mtime_ns for p in out.rglob("part-*")} == before
    (source / "aliases.json").write_text('{"Cool Gang": "Kool & the Gang", "Delta": "Delta Force"}')
    run_all(spark, str(source), str(out), str(source / "aliases.json"), ["Kool Gang The", "Delta", "Nobody"])
    after = {p: p.stat().st_mtime_ns for p in out.rglob("part-*")}
    assert {p.relative_to(out).parts[0] for p in after if before.get(p) != after[p]} == set(written)
    assert "Delta Force" in {r[0] for r in rows(spark.read.parquet(written["artist_pagerank.parquet"]), "artist")}
    matched = spark.read.parquet(written["external_validation.parquet"])
    assert rows(matched, "ground_truth", "matched_artist") == [("Delta", "Delta Force"), ("Kool Gang The", "Kool and the Gang")]
    labels = spark.read.parquet(written["music_labels.parquet"])
    assert labels.columns == ["artist_name", "cluster_id", "cluster_representative"]


def staged(spark, out, log, broken=(), facts=None):
    """Four stages: a feeds b and c, which run side by side; d needs both."""
    run = Stages(spark, str(out), facts or {"in": "1"})
    meet = threading.Barrier(2, timeout=60)

    def of(name, needs):
        def compute():
            log.append(name)
            if name in ("b", "c") and not broken:
                meet.wait()  # neither goes on before the other has begun
            if name in broken:
                raise ValueError(name)
            tables = [run.table(f"{n}.parquet") for n in needs] or [spark.range(3)]
            return reduce(DataFrame.unionByName, tables)

        run.add(f"{name}.parquet", [f"{n}.parquet" for n in needs] or ["in"], compute)

    for name, needs in (("a", []), ("b", ["a"]), ("c", ["a"]), ("d", ["b", "c"])):
        of(name, needs)
    return run


def test_stages_run_side_by_side_and_once(spark, tmp_path):
    log = []
    staged(spark, tmp_path, log).run()
    assert log[0] == "a" and set(log[1:3]) == {"b", "c"} and log[3:] == ["d"]
    assert spark.read.parquet(f"{tmp_path}/d.parquet").count() == 6
    staged(spark, tmp_path, log).run()
    assert len(log) == 4
    staged(spark, tmp_path, log, facts={"in": "2"}).run()
    assert len(log) == 8


def test_what_most_others_wait_for_goes_first(spark, tmp_path):
    """Also where it was added last and becomes ready while others queue."""
    log, run = [], Stages(spark, str(tmp_path), {"in": "1"})

    def add(name, *needs):
        def compute():
            log.append(name)
            return spark.range(1)

        run.add(f"{name}.parquet", [f"{n}.parquet" for n in needs] or ["in"], compute)

    for name, needs in (("a", []), ("x", ["a"]), ("y", ["a"]), ("b", ["a"]), ("c", ["b"]), ("d", ["c"])):
        add(name, *needs)
    assert run.waiting() == {"a.parquet": 5, "x.parquet": 0, "y.parquet": 0, "b.parquet": 2, "c.parquet": 1, "d.parquet": 0}
    run.run(workers=1)
    assert log == ["a", "b", "c", "x", "y", "d"]


def test_a_failure_stops_the_run_and_the_next_goes_on(spark, tmp_path):
    log = []
    with pytest.raises(ValueError, match="c"):
        staged(spark, tmp_path, log, broken=("c",)).run(workers=1)
    assert "d" not in log and sinks.is_complete(spark, f"{tmp_path}/a.parquet") and not sinks.is_complete(spark, f"{tmp_path}/d.parquet")
    more = []
    staged(spark, tmp_path, more, broken=("none",)).run()
    assert "a" not in more and sorted(more)[-2:] == ["c", "d"]


def test_a_result_without_its_manifest_is_computed_again(spark, tmp_path):
    log = []
    staged(spark, tmp_path, log, broken=("none",)).run()
    sinks.forget(spark, f"{tmp_path}/d.parquet")
    staged(spark, tmp_path, log, broken=("none",)).run()
    assert log.count("d") == 2 and len(log) == 5


def test_stages_must_know_what_they_need(spark, tmp_path):
    with pytest.raises(ValueError, match="missing.parquet"):
        Stages(spark, str(tmp_path)).add("x.parquet", ["missing.parquet"], lambda: spark.range(1))


def test_a_shared_table_is_computed_once_a_run(spark, tmp_path):
    log, run = [], Stages(spark, str(tmp_path), {"in": "1"})

    def table():
        log.append(1)
        return spark.range(2)

    for name in ("a", "b"):
        run.add(f"{name}.parquet", ["in"], lambda: run.shared("between", table))
    run.run()
    assert log == [1] and spark.read.parquet(f"{tmp_path}/b.parquet").count() == 2
    assert {p.name for p in tmp_path.iterdir()} == {"a.parquet", "b.parquet"}


def test_both_reports_share_the_counts_of_songs(spark, tmp_path, monkeypatch):
    from tributary.operators import statistics

    log, facts = [], statistics.song_facts
    monkeypatch.setattr(statistics, "song_facts", lambda edges: log.append(1) or facts(edges))
    (tmp_path / "in").mkdir()
    dump(tmp_path / "in")
    written = run_all(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert log == [1]
    edges = links.as_edges(spark.read.parquet(written["music_graph.parquet"]))
    for name, report in (("validation_summary.csv", statistics.network_summary(edges)), ("statistics_summary.csv", statistics.overview(edges))):
        assert rows(sinks.read_csv(spark, written[name], "metric string, value double")) == rows(report)
