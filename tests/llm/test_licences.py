import re

import numpy as np
import pytest

from conftest import rows
from tributary.llm import licences

FOLDER = "/root/testdata/sf0.01"
#: The notices that the given documents hold.
PLANTED = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def classifier():
    rng = np.random.default_rng(10)
    corpus = [" ".join(["the", "of", "a", *(f"w{x}" for x in rng.integers(0, 500, 12))]).encode() for _ in range(300)]
    return licences.Classifier(corpus)


def plain(classifier, text):
    """Paragraph by paragraph, without batches."""
    out = []
    for k, line in enumerate((text or "").split("\n")):
        words = licences.words_of(line.encode())
        if words:
            z = classifier.row(words) @ classifier.weights[:-1] + classifier.weights[-1]
            family = classifier.classes[int(z.argmax())]
            if family != licences.UNKNOWN:
                same = licences.similarity(licences.pairs_of(words), classifier.templates[family])
                if same >= licences.CONFIRM:
                    out.append((k, family, round(same, 9)))
    return out


def test_batches_equal_paragraph_by_paragraph(spark, classifier):
    every = [t for ts in licences.TEMPLATES.values() for t in ts]
    texts = ["\n".join(every), None, "", "\n \n\x00\n", "so it goes\nReleased under the MIT License.\n\nend", "the license of the software\n" * 50]
    texts += [f"{t.upper()} trailing words here\nunder the of license" for t in every] + ["a " * 30_000 + "\n" + every[3]]
    data = [(k % 40, t) for k, t in enumerate(texts)] + [(None, every[0])]
    df = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, found int").repartition(2)
    got = [(i, [(f["paragraph"], f["family"], round(f["similarity"], 9)) for f in found]) for i, _, found in rows(licences.scan(df, classifier))]
    assert sorted(got, key=repr) == sorted(((i, plain(classifier, t)) for i, t in data), key=repr)
    assert rows(licences.scan(df.limit(0), classifier)) == []


def test_templates_are_recognised(classifier):
    for family, notices in licences.TEMPLATES.items():
        for t in notices:
            assert [f for _, f, _ in plain(classifier, t)] == [family], t


def test_talk_of_licences_is_unknown(classifier):
    for t in licences.TALK:
        assert plain(classifier, t) == []


def test_probabilities_are_calibrated(classifier):
    rng = np.random.default_rng(11)
    rows_, truth = [], []
    for family, notices in licences.TEMPLATES.items():
        for t in notices:
            for v in licences.variants(licences.words_of(t.encode()), [b"zz", b"yy"], rng):
                rows_.append(classifier.row(v))
                truth.append(classifier.classes.index(family))
    p = licences.softmax(np.stack(rows_) @ classifier.weights[:-1] + classifier.weights[-1])
    assert abs(p.max(axis=1).mean() - (p.argmax(axis=1) == truth).mean()) < 0.05


def test_planted_notices_are_found(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r["id"]: r["found"] for r in licences.scan(docs, licences.fit(docs)).collect()}
    for r in docs.select("doc_id", "text").collect():
        lines = r["text"].split("\n")
        expected = [(k, PLANTED[x]) for k, x in enumerate(lines) if x in PLANTED]
        got = [(f["paragraph"], f["family"]) for f in found[r["doc_id"]]]
        assert set(expected) <= set(got), r["doc_id"]
        assert all(re.search("licen|public", lines[k], re.I) for k, _ in got)


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "a", "to", "in", "license", "software", *(f"w{k}" for k in range(200))], n))


def test_every_notice_in_long_lines(spark, classifier):
    rng = np.random.default_rng(14)
    every = [(family, t) for family, notices in licences.TEMPLATES.items() for t in notices]
    data = []
    for family, t in every:
        data.append((len(data), prose(rng, 250) + ". " + t + " " + prose(rng, 250), [family]))
    for n in (500, 20_000):
        for family, t in every[::7]:
            data.append((len(data), " ".join([prose(rng, n // 3), t, prose(rng, n // 3), every[-9][1], prose(rng, n // 3)]), [family, every[-9][0]]))
        data.append((len(data), prose(rng, n), []))
    both = "Released under the MIT License. {}Licensed under the Apache License, Version 2.0."
    data += [(len(data) + k, both.format(x), ["mit", "apache"]) for k, x in enumerate(["", "Parts of it: ", prose(rng, 60) + " "])]
    for (a, t), (b, u) in [(every[k], every[(k * 5 + 11) % len(every)]) for k in range(len(every))]:
        data.append((len(data), f"{t} {u}", [a, b]))
    data.append((len(data), " ".join(f"{t} {prose(rng, 30)}" for _, t in every), [f for f, _ in every]))
    df = spark.createDataFrame([r[:2] for r in data], "doc_id long, text string")
    got = {r["id"]: [f["family"] for f in r["found"]] for r in licences.scan(df, classifier).collect()}
    wrong = [(k, expected, got[k], t[:200]) for k, t, expected in data if sorted(got[k]) != sorted(set(expected))]
    assert wrong == []
