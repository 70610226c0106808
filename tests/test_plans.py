"""How often a plan reads the edges."""

from pathlib import Path

import pytest
from conftest import rows

from parity import standins as std
from tributary.operators import clusters, degree, statistics, subgraph
from tributary.plans.build import release_years
from tributary.session import cut

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


def scans(spark, build) -> int:
    """Reads of the edge table in the plan, sub-plans included."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        edges = std.edges(spark, FOLDER)
        path = edges.inputFiles()[0].rsplit("/", 1)[0].split("/")[-1]
        text = build(edges)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    seen = text.split("Subqueries")[0] if "Subqueries" in text else text
    return sum("FileScan" in line and path[:20] in line for line in seen.splitlines())


@pytest.mark.parametrize(
    "name, build, most",
    [
        ("concentration", degree.concentration_all, 1),
        ("summary", statistics.network_summary, 3),
        ("roles", lambda e: degree.roles(degree.known_degrees(e)), 2),
        ("degrees", degree.degrees, 1),
    ],
)
def test_scans(spark, name, build, most):
    assert 1 <= scans(spark, build) <= most


def test_core_reads_the_edges_for_one_degree_table(spark):
    core = lambda e: subgraph.core_nodes(e, std.scores(spark, FOLDER), std.labels(spark, FOLDER))
    assert scans(spark, core) == 0  # written once, the readers see the list


def test_reports_read_what_is_written_already(spark):
    """The flow between clusters and the degrees are not counted again from the edges; the results are the same."""
    edges, scores, labels = std.edges(spark, FOLDER), std.scores(spark, FOLDER), std.labels(spark, FOLDER)
    flows, both = cut(clusters.flow(edges, labels)), cut(degree.degrees(edges))
    assert scans(spark, lambda e: clusters.quality_summary(e, labels)) > 0
    assert scans(spark, lambda e: clusters.quality_summary(e, labels, flows)) == 0
    assert rows(clusters.quality_summary(edges, labels, flows)) == rows(clusters.quality_summary(edges, labels))
    assert rows(subgraph.core_bundle(edges, scores, labels, both)) == rows(subgraph.core_bundle(edges, scores, labels))


def test_a_long_list_of_recordings_meets_the_years(spark):
    """Tracks are not moved for a list too long to broadcast; a short one thins them out first. Both give the same years."""
    track = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, 10), (3, 12), (4, 99), (None, 10)], "recording long, medium long")
    medium = spark.createDataFrame([(10, 5), (11, 6), (12, 7)], "id long, release long")
    release = spark.createDataFrame([(5, 1), (6, 2), (7, 3)], "id long, release_group long")
    meta = spark.createDataFrame([(1, 1999), (2, 1980), (3, None)], "id long, first_release_date_year int")
    only = spark.createDataFrame([(1,), (3,), (4,), (8,)], "id long")

    def plan_and_rows():
        years = release_years(track, medium, release, meta, only)
        return years._jdf.queryExecution().optimizedPlan().toString(), sorted(tuple(r) for r in years.collect())

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long_plan, long_rows = plan_and_rows()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    _, short_rows = plan_and_rows()
    assert long_rows == short_rows == [(1, 1980), (3, None)]
    assert -1 < long_plan.find("LeftSemi") < long_plan.find("Aggregate")
