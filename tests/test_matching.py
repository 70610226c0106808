import math
import random

import numpy as np
import pytest
from conftest import rows

from tributary.functions.similarity import token_set_scorer
from tributary.operators import matching, name_index, ranking
from tributary.operators.components import components
from tributary.sources.dumps import ranked_names

SCORE = token_set_scorer()


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("kool & the gang", "kool and the gang", 100),
        ("queen", "queen latifah", 100),
        ("biggie smalls", "smalls biggie", 100),
        ("abc", "", 0),
        ("&&&", "abc", 0),
        ("abcd", "abce", 75),
        ("run-d.m.c.", "run dmc", 75),
        ("the beatles", "the beetles", 91),
    ],
)
def test_token_set_score(a, b, expected):
    assert SCORE(a, b) == expected and SCORE(b, a) == expected


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b, 1):
            row[j] = old[j - 1] + 1 if x == y else max(old[j], row[j - 1])
    return row[-1]


def test_ratio_against_plain_dynamic_programming():
    random.seed(3)
    for _ in range(300):
        a = "".join(random.choice("abc") for _ in range(random.randrange(1, 12)))
        b = "".join(random.choice("abc") for _ in range(random.randrange(1, 12)))
        expected = 100 if a == b else round(200 * lcs(a, b) / (len(a) + len(b)))
        assert SCORE(a, b) == expected


def by_hand(truth, ranked, threshold=85):
    used, found = set(), []
    for place, name in enumerate(truth, 1):
        best, points = None, 0
        for rank, (artist, _) in enumerate(ranked, 1):
            score = SCORE(name.lower(), artist.lower())
            if rank not in used and score > points and score >= threshold:
                best, points = rank, score
        if best:
            used.add(best)
            found.append((name, place, ranked[best - 1][0], best, ranked[best - 1][1], points))
    return found


def test_alignment_equals_choosing_one_by_one(spark):
    random.seed(4)
    words = ["red", "reds", "blue", "band", "the", "trio"]
    pool = sorted({" ".join(random.sample(words, random.randrange(1, 4))) for _ in range(60)})
    ranked = [(n, 100.0 - i) for i, n in enumerate(pool)]
    truth = [" ".join(random.sample(words, random.randrange(1, 4))) for _ in range(25)]
    scores = spark.createDataFrame(ranked, "artist string, authority_score double")
    got = [tuple(r) for r in matching.align(ranked_names(spark, truth), scores).collect()]
    assert got == by_hand(truth, ranked)


def test_no_match_at_all(spark):
    scores = spark.createDataFrame([("abc", 1.0)], "artist string, authority_score double")
    truth = ranked_names(spark, ["xyz"])
    matches = matching.align(truth, scores)
    assert matches.count() == 0
    report = matching.agreement(truth, matches).first()
    assert report["Number_of_matched_artists"] == 0 and str(report["P_value"]) == "nan"


def test_spearman_with_ties_and_p(spark):
    data = [(i, x, y) for i, (x, y) in enumerate([(1, 2), (2, 1), (3, 4), (4, 3), (5, 6), (6, 6), (7, 9)])]
    one = ranking.spearman(spark.createDataFrame(data, "id int, x int, y int"), "x", "y", "id").first()
    rho = np.corrcoef([1, 2, 3, 4, 5, 6, 7], [2, 1, 4, 3, 5.5, 5.5, 7])[0, 1]
    # Closed form of Student's t for five degrees of freedom.
    angle = math.atan(rho / math.sqrt(1 - rho * rho))
    inside = 2 / math.pi * (angle + math.sin(angle) * (math.cos(angle) + 2 / 3 * math.cos(angle) ** 3))
    assert one["rho"] == pytest.approx(rho, abs=1e-12)
    assert one["p_value"] == pytest.approx(1 - inside, abs=1e-10)
    assert one["n"] == 7 and one["not_significant"] is False


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9), ("d", 1)], "artist string, s int")
    got = rows(ranking.add_ranks(df, "s", "artist", "v"), "artist", "v_position", "v_rank", "v_avg_rank")
    assert got == [("a", 2, 2, 2.5), ("b", 3, 2, 2.5), ("c", 1, 1, 1.0), ("d", 4, 4, 4.0)]


@pytest.mark.parametrize(
    "n, t, expected",
    [  # two-sided p of Student's t: closed forms for one and eight degrees of freedom, else published tables
        (3, 1.0, 0.5),
        (10, 2.306004, 0.05),
        (30, 2.048407, 0.05),
        (10_000, 2.0, 0.045527),
        (10**7, 2.0, 0.0455003),
        (10**8, 1.0, 0.3173105),
        (10**9, 3.0, 0.0026998),
    ],
)
def test_p_for_any_number_of_rows(n, t, expected):
    r = t / math.sqrt(n - 2 + t * t)
    assert ranking.correlation_p(r, n) == pytest.approx(expected, abs=2e-6)
    assert ranking.correlation_p(-r, n) == pytest.approx(expected, abs=2e-6)


def test_p_at_the_ends():
    assert ranking.correlation_p(0.0, 50) == 1.0
    assert ranking.correlation_p(1.0, 50) == 0.0
    assert math.isnan(ranking.correlation_p(0.3, 2))


def test_alignment_of_a_cut_ranking(spark):
    names = [f"band {k} of {k % 7}" for k in range(40)]
    ranked = [(n, 100.0 - i) for i, n in enumerate(names)]
    scores = spark.createDataFrame(ranked, "artist string, authority_score double")
    truth = ranked_names(spark, names[::3])
    assert matching.candidates(scores, 5).count() == 5 and matching.candidates(scores).count() == 40
    assert [tuple(r) for r in matching.align(truth, scores, top=10).collect()] == by_hand(names[::3], ranked[:10])


LETTERS = "abcdeilnorst01_"


def typo(draw, name):
    at = draw.randrange(len(name) + 1)
    return draw.choice([name[:at] + draw.choice(LETTERS) + name[at:], name[:at] + name[at + 1 :], name[:at] + draw.choice(LETTERS) + name[at + 1 :]])


def names_alike(seed, n):
    draw = random.Random(seed)
    words = ["the", "and", "dj", "band", *("".join(draw.choices(LETTERS, k=draw.randrange(1, 12))) for _ in range(25))]
    names = [" ".join(draw.choices(words, k=draw.randrange(1, 7))) for _ in range(n)]
    for k in range(n):
        for _ in range(draw.randrange(0, 4)):
            names[k] = typo(draw, names[k])
    long = ["".join(draw.choices(LETTERS, k=230)) for _ in range(3)]
    long += [typo(draw, typo(draw, x)) for x in long]
    return names + long + ["", "&&& !", "É", "Ünïted Stätes", "united states", "\u212angs", "kngs", "KNGS", "İstanbul", "istanbul", "a\tb\nc", "A B C"]


@pytest.mark.parametrize("threshold, seed", [(85, 1), (85, 2), (70, 3), (100, 4)])
def test_no_pair_is_lost(spark, threshold, seed):
    """All pairs scored one by one against what the index lets through."""
    ranked, listed = names_alike(seed, 160), names_alike(seed + 10, 60) + names_alike(seed, 160)[:30]
    pool = spark.createDataFrame([(a, i, 1.0) for i, a in enumerate(ranked, 1)], "artist string, system_rank long, authority_score double")
    truth = ranked_names(spark, listed)
    found = matching.similar(truth, pool, threshold)
    got = {(r["ground_truth_rank"], r["system_rank"]): r["match_score"] for r in found.collect()}
    expected = {(i, k): p for i, a in enumerate(listed, 1) for k, b in enumerate(ranked, 1) if (p := SCORE(a.lower(), b.lower())) >= threshold}
    assert got == expected and len(expected) > 40


def test_index_lets_few_pairs_through(spark):
    """Names of one length that share a common word are not compared with each other."""
    draw = random.Random(5)
    names = ["the " + "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(600)]
    bounds = name_index.Bounds(85)
    pool = name_index.signed(spark.createDataFrame([(n,) for n in names], "artist string"), "artist", bounds)
    truth = name_index.signed(spark.createDataFrame([(n,) for n in names[:200]], "ground_truth string"), "ground_truth", bounds)
    met = name_index.ranked_keys(pool, bounds).select("artist", "key").join(name_index.listed_keys(truth, bounds).select("ground_truth", "key"), "key")
    assert met.select("artist", "ground_truth").distinct().count() < 0.1 * 600 * 200
    assert matching.similar(truth.selectExpr("ground_truth", "1 as ground_truth_rank"), pool.selectExpr("artist", "1L as system_rank", "1.0D as authority_score")).count() == 200


def test_names_that_all_want_the_same_artists(spark):
    """200 names compete for 200 artists: settled without a round for each, the same by rounds and by components."""
    pairs = [(f"artist {a}", a, 1.0, f"name {n}", n, 90) for n in range(1, 201) for a in range(1, 201)]
    pairs += [(f"other {a}", 300 + a, 1.0, f"lone {a}", 300 + a, 95) for a in range(20)]
    kind = "artist string, system_rank long, authority_score double, ground_truth string, ground_truth_rank int, match_score int"
    table = spark.createDataFrame(pairs, kind)
    expected = [(n, f"artist {n}") for n in range(1, 201)] + [(300 + a, f"other {a}") for a in range(20)]
    seen = []
    cut = matching.cut
    try:
        matching.cut = lambda df: seen.append(1) or cut(df)
        got = rows(matching.assign(table), "ground_truth_rank", "matched_artist")
        assert sorted(got) == expected and len(seen) == 1
    finally:
        matching.cut = cut
    few = table.where("ground_truth_rank <= 5 or ground_truth_rank >= 300")
    wanted = [x for x in expected if x[0] <= 5 or x[0] >= 300]
    assert sorted(rows(matching.assign(few, settled=1010), "ground_truth_rank", "matched_artist")) == wanted  # by components
    assert sorted(rows(matching.assign(few, settled=100), "ground_truth_rank", "matched_artist")) == wanted  # the large one in rounds


def test_components_against_union_find(spark):
    draw = random.Random(6)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)] + [(9, 9)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(rows(got)) == sorted((x, root(x)) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
