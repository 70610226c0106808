"""Every registered query on the smallest tables, against SQL or a brute-force version."""

import html as entities
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import test_interpolation
import test_licences
import test_packing
import test_quality
import test_simhash
from parity.check import compare, connect
from tributary.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def result(spark, name):
    return REGISTRY[name][0](spark, FOLDER).collect()


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_sql(spark, name):
    query, sql = REGISTRY[name]
    assert compare(spark, connect(FOLDER), query, sql, FOLDER) is None


def test_op1(spark, documents):
    expected = {r[0]: r for r in test_interpolation.brute(documents.items())}
    got = result(spark, "op1_deleted_interpolation")
    assert len(got) == len(documents)
    for r in got:
        e = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == e[1:5]
        assert r["base_score"] == pytest.approx(e[5], rel=1e-9) and r["score"] == pytest.approx(e[6], rel=0.01)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op2(spark, documents):
    expected = test_simhash.brute(documents)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in result(spark, "op2_simhash_near_dedup")}
    assert got == expected


def test_op3(spark, documents):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    places = defaultdict(list)
    pieces = defaultdict(dict)
    for r in result(spark, "op3_best_fit_packing"):
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]][r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    for i, text in documents.items():
        ids = whole.encode(text, add_special_tokens=False).ids + [0]
        starts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048)]
        cuts = list(zip(starts, [*starts[1:], len(ids)]))
        assert [pieces[i][k] for k in range(len(pieces[i]))] == [(a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for a, b in cuts]
    for spans in places.values():
        ends = np.cumsum([n for _, n in sorted(spans)]).tolist()
        assert [a for a, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(places) == len(test_packing.one_by_one([n for s in places.values() for _, n in s], 2048))


def test_op4(spark, documents):
    whole = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in result(spark, "op4_token_counts"):
        n = len(whole.encode(documents[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(documents[r["doc_id"]].encode()), n, n > 4096)


def test_op5(spark, documents):
    for r in result(spark, "op5_licence_scan"):
        lines = documents[r["doc_id"]].split("\n")
        expected = {test_licences.PLANTED[x] for x in lines if x in test_licences.PLANTED}
        assert set(r["families"].split(",")) - {""} == expected
        assert r["n_paragraphs"] == sum(bool(x.split()) for x in lines)


def test_op6(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = result(spark, "op6_html_extraction")
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        inside = re.sub(r"<!--.*?-->", "", re.sub(r"</?(p|h1|br|div|li|ul)\b[^>]*>", " ", inside), flags=re.S)
        expected = " ".join(entities.unescape(re.sub(r"<[a-zA-Z/][^>]*>", "", inside)).split())
        assert (r["text"], r["n_chars"]) == (expected, len(expected))


def test_op7(spark, documents):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    got = result(spark, "op7_quality_classifier")
    assert len(got) == len(documents)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r["predicted"] == labels[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(held) >= 0.8 * len(held)


def test_op8(spark, documents):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    right = total = 0
    for r in result(spark, "op8_quality_rules"):
        counts = test_quality.brute(documents[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts[:5]
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if r["doc_id"] in labels and counts[0] >= 10:
            total += 1
            right += r["kept"] == (labels[r["doc_id"]] == 1)
    assert right >= 0.9 * total
