from types import SimpleNamespace

import pytest

from tributary.session import checkpoint_root, cut, discard, handoff, workspace
from tributary.sources.sinks import exists


class Folder:
    def __init__(self, path=None):
        self.path = path

    def isDefined(self):
        return self.path is not None

    def get(self):
        return self.path


def session(master, named=None):
    """Stands in for a session with the given master and checkpoint setting."""
    folder = Folder()
    context = SimpleNamespace(master=master)
    context._jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: folder))
    context.setCheckpointDir = lambda path: setattr(folder, "path", path)
    return SimpleNamespace(conf={"spark.checkpoint.dir": named}, sparkContext=context)


def test_the_named_folder_wins():
    assert checkpoint_root(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert checkpoint_root(session("local[2]", "/shared")) == "/shared"


def test_only_a_local_master_gets_a_temporary_folder():
    local = session("local[2]")
    first = checkpoint_root(local)
    assert "tributary-checkpoint-" in first and checkpoint_root(local) == first
    with pytest.raises(RuntimeError):
        checkpoint_root(session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        checkpoint_root(session("local-cluster[2,1,1024]"))


def test_discarded_tables_are_gone(spark):
    table = handoff(spark.range(3), "x")
    assert table.count() == 3 and exists(spark, table.written_at)
    discard(table, spark.range(2))
    assert not exists(spark, table.written_at)


def test_a_workspace_leaves_nothing_behind(spark):
    kept = handoff(spark.range(1), "outside")
    paths = []
    with pytest.raises(ValueError), workspace(spark):
        one = handoff(spark.range(3), "x")
        result = handoff(one, "result", keep=True)
        with workspace(spark):
            paths.append(cut(spark.range(2).select("id")).written_at)
        assert not exists(spark, paths[0])
        paths.append(one.written_at)
        assert one.select("id").count() == 3
        raise ValueError
    assert not any(exists(spark, p) for p in paths)
    assert exists(spark, kept.written_at) and result.count() == 3
    discard(kept, result)


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere without a path setting still runs the functions shipped by name."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    script = f"""
import sys; sys.path.insert(0, {str(root)!r})
from tributary.session import build_session
from tributary.operators import matching
from tributary.sources.dumps import ranked_names
spark = build_session("elsewhere", "local[1]", **{{"spark.ui.enabled": "false"}})
scores = spark.createDataFrame([("a b", 1.0)], "artist string, authority_score double")
print("FOUND", matching.similar(ranked_names(spark, ["b a"]), matching.candidates(scores)).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND 1" in run.stdout, run.stderr[-2000:]


def test_parts_side_by_side_keep_the_job_group(spark):
    import threading

    from tributary.session import side_by_side

    meet = threading.Barrier(2, timeout=60)

    def part(value):
        meet.wait()
        return value, spark.sparkContext.getLocalProperty("spark.jobGroup.id"), spark.range(value).count()

    spark.sparkContext.setJobGroup("both", "")
    try:
        assert side_by_side(spark, lambda: part(1), lambda: part(2)) == [(1, "both", 1), (2, "both", 2)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1, lambda: 1 / 0)
