import json

import pytest
from conftest import rows

from tributary.sources import dumps, sinks


def test_dump_reading(spark, tmp_path):
    lines = [
        '1\tg1\t"never closed\t10\t\\N\t\\N\t0\tnow\tf\textra',
        '2\tg2\tmid "quote\t11\t5\tc\t0\tnow\tt',
        "3\tg3\tback\\slash\t\\N\t5\tc\t0\tnow\tt",
    ]
    (tmp_path / "recording").write_text("\n".join(lines) + "\n")
    got = dumps.read_dump(spark, str(tmp_path), "recording")
    assert rows(got, "id", "name", "artist_credit", "comment") == [
        (1, '"never closed', 10, None),
        (2, 'mid "quote', 11, "c"),
        (3, "back\\slash", None, "c"),
    ]


def test_prefix_schema_ignores_more_columns(spark, tmp_path):
    (tmp_path / "medium").write_text("1\t2\tx\ty\n")
    assert rows(dumps.read_dump(spark, str(tmp_path), "medium")) == [(1, 2)]


def test_alias_map_as_object_and_as_lines(spark, tmp_path):
    (tmp_path / "map.json").write_text('{\n  "a b": "A B",\n  "c": "C"\n}')
    whole = dumps.read_alias_map(spark, str(tmp_path / "map.json"))
    assert rows(whole) == [("a b", "A B"), ("c", "C")]
    sinks.write_alias_map(whole, str(tmp_path / "lines"))
    assert rows(dumps.read_alias_map(spark, str(tmp_path / "lines"))) == rows(whole)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{ "variant": "a", "canonical": "b" }\n  {"canonical":"d","variant":"c"}  \n', [("a", "b"), ("c", "d")]),
        ('{"variant": "x"}', [("variant", "x")]),
        ('{"variant": "x", "other": "y"}', [("other", "y"), ("variant", "x")]),
        ('{"a": "b",\n\n "a": "c", "q\\"uote": "\\u00e9"}', [("a", "c"), ('q"uote', "é")]),
        ("{}", []),
        ("", []),
        (" \n\n", []),
    ],
)
def test_alias_map_in_any_spelling(spark, tmp_path, text, expected):
    (tmp_path / "map").write_text(text)
    assert rows(dumps.read_alias_map(spark, str(tmp_path / "map"))) == expected


@pytest.mark.parametrize(
    "text",
    [
        '{"a": "b", "c": ',
        '{"variant": "a", "canonical": "b"}\n{"variant": "c"',
        '{"variant": "a", "canonical": "b"}\n{"c": "d"}',
        '["a", "b"]',
        '{"a": null}',
        "a,b\nc,d",
    ],
)
def test_broken_alias_maps_raise(spark, tmp_path, text):
    (tmp_path / "map").write_text(text)
    with pytest.raises(Exception, match="neither lines|JSONDecodeError"):
        dumps.read_alias_map(spark, str(tmp_path / "map")).collect()


def test_stage_runs_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "stage")
    for _ in range(2):
        assert sinks.read_or_compute(spark, path, compute).count() == 3
    assert len(calls) == 1


def test_missing_input_is_named(spark, tmp_path):
    try:
        sinks.require(spark, str(tmp_path), str(tmp_path / "gone"))
    except FileNotFoundError as error:
        assert "gone" in str(error)
    else:
        raise AssertionError


def test_preview_and_csv(spark, tmp_path):
    df = dumps.ranked_names(spark, ["x", "y", "z"])
    assert sinks.preview(df, 2).count() == 2
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == df.columns


def test_alias_objects_stay_small(spark, tmp_path, monkeypatch):
    from parity import catalogue, queries

    monkeypatch.setattr(queries, "ALIASES", 10, raising=False)
    monkeypatch.setattr(queries, "fresh_folder", lambda session: str(tmp_path / "map"))
    folder = "/root/testdata/sf0.001"
    got = rows(queries.io_alias_object(spark, folder), "variant", "canonical")
    assert got == rows(catalogue.alias_table(spark, folder), "variant", "canonical")
    objects = [json.loads(p.read_text()) for p in (tmp_path / "map").rglob("part-*.txt")]
    assert len(objects) > len(got) / 20 and sum(map(len, objects)) == len(got) > 20
    assert max(map(len, objects)) <= 30


def test_bundle_has_a_folder_for_every_kind(spark, tmp_path):
    """Core artists of a large sparse graph may have no link among each other."""
    bundle = spark.createDataFrame([("node", '{"id":1}'), ("cluster", '{"rank":1,"representative":"a"}')], "kind string, json string")
    sinks.write_bundle(bundle, f"{tmp_path}/some")
    read = {k: spark.read.schema(s).json(f"{tmp_path}/some/kind={k}") for k, s in {"node": "id long", "link": "source string", "cluster": "rank string"}.items()}
    assert {k: df.count() for k, df in read.items()} == {"node": 1, "link": 0, "cluster": 1}
    assert spark.read.text(f"{tmp_path}/some").groupBy("kind").count().count() == 2
    sinks.write_bundle(bundle.limit(0), f"{tmp_path}/none")
    assert spark.read.schema("id long").json(f"{tmp_path}/none/kind=node").count() == 0
