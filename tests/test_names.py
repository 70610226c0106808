from conftest import rows
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators import aliases, links


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_clean_names(spark):
    expected = {
        "Kool & the Gang": "Kool and the Gang",
        "Beatles, The": "The Beatles",
        "Rock ’n’ Roll (Live)": "Rock 'n' Roll",
        "X feat. Y & Z": "X",
        "X FT Y": "X",
        "Ft. Minor": "Ft. Minor",
        "Sly &the": "Sly &the",
        "(only)": "",
        "Trailing (a) (b) ": "Trailing (a)",
        "A‐B−C": "A-B-C",
        "two   blanks": "two blanks",
    }
    got = names(spark, *expected).select(
        "name", text.clean_name(text.strip_featured(F.col("name"))).alias("clean")
    )
    assert {r["name"]: r["clean"] for r in got.collect()} == expected


def test_readable(spark):
    cases = {"plain": True, "a b": False, "a\tb": False, "a​b": False, "電音部": True, "": False,
             "[unknown]": False, "[no artist]": False, "two words": True}
    got = names(spark, *cases).select("name", text.readable(F.col("name")).alias("ok"))
    assert {r["name"]: r["ok"] for r in got.collect()} == cases
    assert names(spark, None).select(text.readable(F.col("name"))).first()[0] is False


def test_prefix_aliases(spark):
    listed = names(
        spark, "Bill Evans", "Bill Evans Trio", "X Y", "X Y feat. Z", "A B", "A B Orchestra",
        "A B Orchestra Band", "Solo Trio", "Solo", "X Y & Some Friends", "X Y Unrelated Words",
    )
    assert rows(aliases.prefix_aliases(listed)) == [
        ("A B Orchestra Band", "A B Orchestra"),
        ("A B Orchestra", "A B"),
        ("Bill Evans Trio", "Bill Evans"),
        ("X Y & Some Friends", "X Y"),
    ]


def test_prefix_key_shared_by_two_spellings_takes_the_last(spark):
    listed = names(spark, "BILL EVANS", "Bill Evans", "Bill Evans Trio")
    assert ("Bill Evans Trio", "Bill Evans") in rows(aliases.prefix_aliases(listed))


def test_case_aliases(spark):
    listed = names(spark, "JADE", "Jade", "jade", "Other", "1abc", "1ABC")
    assert rows(aliases.case_aliases(listed)) == [("1abc", "1ABC"), ("Jade", "JADE"), ("jade", "JADE")]


def test_prefix_wins_over_case(spark):
    general = spark.createDataFrame([("a", "A"), ("b", "B")], "variant string, canonical string")
    special = spark.createDataFrame([("a", "Z")], "variant string, canonical string")
    assert rows(aliases.merge_aliases(general, special)) == [("a", "Z"), ("b", "B")]


def test_aliases_apply_before_clean_up(spark):
    mapping = spark.createDataFrame([("A & B", "Both, The")], "variant string, canonical string")
    got = aliases.apply_aliases(names(spark, "A & B", "A and B", "C & D"), mapping)
    assert rows(got) == [("A and B",), ("C and D",), ("The Both",)]


def test_name_list_drops_placeholders(spark):
    pairs = spark.createDataFrame([("a", "[unknown]"), ("", "b"), (None, "a")], "src string, dst string")
    assert rows(aliases.name_list(pairs, "src", "dst")) == [("a",), ("b",)]


def test_placeholder_edges(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("[unknown] x", "b"), ("a", "the [no artist]"), ("a", None)], "src string, dst string"
    )
    assert rows(links.drop_placeholders(edges)) == [("a", "b")]
