"""Line runs, near copies and spot signatures against plain Python."""

import hashlib
import itertools
import re
from collections import defaultdict

import numpy as np
import pytest

from cellspan.llm import line_runs, near_copies, spot_signatures
from cellspan.llm.common import table
from cellspan.llm.queries import op5_spot_signatures
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_lines_of_odd_documents(spark, odd_docs, no_docs):
    out = line_runs.dedup_lines(odd_docs, min_docs=2, fanout=2, batches=3)
    assert out.count() == odd_docs.count() and set(odd_docs.columns) <= set(out.columns)
    rows = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert rows[(7, None)]["n_lines"] == 1 and rows[(7, None)]["kept_text"] == ""
    assert rows[(8, "")]["n_lines"] == 1
    by_id = defaultdict(list)
    for (doc, _), r in rows.items():
        by_id[doc].append(r)
    # the sentence stays in the largest document that holds it, 12, alone
    assert by_id[10][0]["n_dropped"] == 2000 and by_id[10][0]["kept_text"] == ""
    assert by_id[5][0]["n_dropped"] == 1 and all(r["n_dropped"] == 0 for r in by_id[12])
    assert line_runs.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (2, 2), (5, 3)])
def test_batches_and_levels_do_not_matter(spark, batches, fanout):
    docs = table(spark, SF, "documents")
    a = line_runs.dedup_lines(docs, batches=batches, fanout=fanout).select("doc_id", "kept_text")
    b = line_runs.dedup_lines(docs, batches=3, fanout=9).select("doc_id", "kept_text")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plain_components(rows, k, percent):
    sets = defaultdict(list)
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        s = {tuple(words)} if 0 < len(words) < k else set(zip(*(words[i:] for i in range(k))))
        sets[doc].append(s)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_copies_against_all_pairs(spark, k):
    rng = np.random.default_rng(k)
    words = [f"w{i}" for i in range(400)]
    base = [words[i] for i in rng.integers(0, 400, 150)]
    rows = [(i, " ".join(w if rng.random() > 0.08 * rng.random() else words[rng.integers(400)] for w in base)) for i in range(0, 240, 2)]
    rows += [(i, " ".join(words[j] for j in rng.integers(0, 400, rng.integers(1, 60)))) for i in range(1, 160, 2)]
    rows += [(900, rows[0][1].upper()), (901, ""), (902, None), (903, "one"), (904, "ONE"), (905, " \n")]
    got = {r["doc_id"]: r for r in near_copies.near_copy_components(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle_words=k).collect()}
    want = plain_components(rows, k, 80)
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["kept"] == (d == want[d]) for d, r in got.items())
    assert got[901]["n_shingles"] == got[902]["n_shingles"] == 0 and got[903]["n_shingles"] == 1


def test_pigeonhole_keys():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**14, (1, near_copies.SYMBOLS)).astype(np.uint16)
    for _ in range(200):
        b = a.copy()
        at = rng.choice(near_copies.SYMBOLS, near_copies.CHUNKS * (near_copies.ERRORS + 1) - 1, replace=False)
        b[0, at] = (b[0, at] + 1) % 2**14
        assert set(near_copies.signature_keys(a)[0]) & set(near_copies.signature_keys(b)[0])


def test_near_copies_of_odd_documents(spark, odd_docs, no_docs):
    rows = near_copies.near_copy_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)]
    assert near_copies.near_copy_components(no_docs).count() == 0


def plain_spots(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    at = [i for i, w in enumerate(words) if w not in spot_signatures.ANCHORS]
    if not at:
        return {" ".join(words)} if words else set()
    return {(words[i - 1] if i and words[i - 1] in spot_signatures.ANCHORS else None, *(words[j] for j in at[k : k + spot_signatures.CHAIN])) for k, i in enumerate(at)}


def test_a_replaced_tenth_never_hides_a_copy(spark):
    docs = table(spark, SF, "documents").where("char_length(text) >= 200")
    n, tenth = F.char_length("text"), F.expr("char_length(text) div 10")
    edited = F.concat(F.substring("text", F.lit(1), n - tenth), F.substring(F.reverse("text"), F.lit(1), tenth))
    alike = docs.select(spot_signatures.likeness(spot_signatures.spots(F.col("text")), spot_signatures.spots(edited)).alias("l"))
    # texts that repeat a few words have few signatures, of which a tenth takes more than its share
    assert alike.where("l < 0.25").isEmpty() and alike.where("l < 0.5").count() * 50 <= alike.count()


def test_op5_against_plain(spark):
    docs = [(r["doc_id"], r["text"] or "") for r in table(spark, SF, "documents").orderBy("doc_id").collect()]
    got = {r["doc_id"]: r for r in op5_spot_signatures(spark, SF).collect()}
    assert len(got) == len(docs)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for (doc, text), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        r = got[doc]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(jaccard(plain_spots(text), plain_spots(edited)))
        assert r["near_next"] == pytest.approx(jaccard(plain_spots(text), plain_spots(after)))
        assert len(r["fingerprint"]) == 12 * len(plain_spots(text))


def test_spots_of_odd_documents(spark, odd_docs, no_docs):
    rows = spot_signatures.edit_report(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert spot_signatures.edit_report(no_docs).count() == 0
    one = spot_signatures.edit_report(odd_docs.where("doc_id = 5")).collect()
    assert [r["near_next"] for r in one] == [1.0]


def test_spot_pairs_against_all_pairs(spark):
    docs = table(spark, SF, "documents")
    members, pairs = spot_signatures.near_pairs(docs, 0.7)
    cls = {r["doc_id"]: r["class_id"] for r in members.collect()}
    texts = {r["doc_id"]: plain_spots(r["text"] or "") for r in docs.collect()}
    want = set()
    for a, b in itertools.combinations(sorted(set(cls.values())), 2):
        if texts[a] and texts[b] and len(texts[a] & texts[b]) >= 0.7 * len(texts[a] | texts[b]):
            want.add((a, b))
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want and len(cls) == docs.select(F.col("doc_id")).count()


def test_a_link_through_the_shorter_text_of_an_id(spark):
    words = [f"w{i}" for i in range(600)]
    rows = [(1, " ".join(words[:40])), (1, " ".join(words[100:500])), (2, " ".join(words[:38])), (3, " ".join(words[100:490]))]
    got = near_copies.near_copy_components(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle_words=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(rows, 2, 80) == {1: 1, 2: 1, 3: 1}
