"""Quality rules, the classifier and mixing."""

import math
import re

import numpy as np
import pytest

from cellspan.llm import adaptive_rules, neighbour_quality, temperature_mix
from cellspan.llm.common import table
from cellspan.llm.queries import op2_adaptive_rules, op6_neighbour_quality
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    marked = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


def test_op2_against_plain(spark):
    got = {r["doc_id"]: r for r in op2_adaptive_rules(spark, SF).collect()}
    for d in table(spark, SF, "documents").collect():
        r, want = got[d["doc_id"]], plain_counts(d["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r["base_failed"] and r["kept"])


def test_op2_tells_good_from_bad(spark):
    judged = op2_adaptive_rules(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("not base_failed")
    rate = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rate[1] > 0.97 and rate[0] < 0.1


def test_sketches_merge_and_measure(spark):
    rng = np.random.default_rng(0)
    values = rng.lognormal(0, 1, 5000)
    rows = spark.createDataFrame([(f"s{i % 7}", float(v)) for i, v in enumerate(values)], "source string, v double")
    rows = rows.select("source", *[F.col("v").alias(m) for m in adaptive_rules.MEASURES])
    merged = adaptive_rules.quartiles(adaptive_rules.merge(adaptive_rules.sketch(rows, ["source"]), []), []).collect()
    for r in merged:
        assert r["docs"] == 5000
        assert r["q1"] == pytest.approx(np.quantile(values, 0.25), rel=0.02) and r["q3"] == pytest.approx(np.quantile(values, 0.75), rel=0.02)


def test_rules_on_odd_documents(spark, odd_docs, no_docs):
    rows = adaptive_rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["base_failed"] for r in rows if r["doc_id"] in (7, 8, 9, 10))
    assert adaptive_rules.judge(no_docs).count() == 0 and adaptive_rules.filter_documents(odd_docs).columns == odd_docs.columns


def test_op6_held_out_accuracy(spark):
    rows = op6_neighbour_quality(spark, SF)
    assert rows.count() == table(spark, SF, "documents").count()
    test = rows.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    good = [r["score"] for r in test if r["quality"] == 1]
    bad = [r["score"] for r in test if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([r["predicted"] == r["quality"] for r in test]) > 0.95


def test_held_out_fold(spark):
    import zlib

    for r in spark.range(50).select("id", neighbour_quality.held_out(F.col("id")).alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0)


def test_classifier_on_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (10, 0), (12, 1), (11, None), (99, 1)], "doc_id bigint, quality int")
    model = neighbour_quality.fit(neighbour_quality.training_rows(odd_docs, labels))
    rows = neighbour_quality.score(odd_docs, model).collect()  # replaces their own score
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert neighbour_quality.score(no_docs, model).count() == 0
    assert {r["score"] for r in neighbour_quality.score(odd_docs, None).collect()} == {1.0}


def test_exponent_meets_targets():
    shares = [0.7, 0.2, 0.1]
    a = temperature_mix.solve_exponent(shares, entropy_share=0.9, max_repeats=None, epochs=1.0)
    assert temperature_mix.entropy(temperature_mix.weights_at(shares, a)) == pytest.approx(0.9 * math.log(3), abs=1e-6)
    a = temperature_mix.solve_exponent(shares, entropy_share=1.0, max_repeats=1.5, epochs=1.0)
    w = temperature_mix.weights_at(shares, a)
    assert max(x / s for x, s in zip(w, shares, strict=True)) == pytest.approx(1.5, abs=1e-6)
    with pytest.raises(ValueError):
        temperature_mix.solve_exponent(shares, entropy_share=None, max_repeats=1.0, epochs=2.0)


@pytest.mark.parametrize("block_rows", [5, 10_000])
def test_mix_realises_budgets(spark, block_rows):
    docs = table(spark, SF, "documents")
    mixed = temperature_mix.mix(docs, entropy_share=0.995, max_repeats=3.0, block_rows=block_rows).select(
        "doc_id", "source", "mix_tokens", "mix_weight", "mix_epoch", "mix_order").collect()
    total = sum(len((r["text"] or "").split()) for r in docs.collect())
    largest = max(r["mix_tokens"] for r in mixed)
    spent, seen = {}, set()
    for r in mixed:
        spent[r["source"]] = spent.get(r["source"], 0) + r["mix_tokens"]
        assert (r["doc_id"], r["mix_epoch"]) not in seen
        seen.add((r["doc_id"], r["mix_epoch"]))
    for r in mixed:
        assert abs(spent[r["source"]] - r["mix_weight"] * total) <= largest
    # an epoch is complete before the next begins
    for doc, epoch in seen:
        assert epoch == 0 or (doc, epoch - 1) in seen


def test_mix_of_odd_documents(spark, odd_docs, no_docs):
    out = temperature_mix.mix(odd_docs, entropy_share=0.9)
    assert set(odd_docs.columns) <= set(out.columns) and temperature_mix.mix(no_docs).count() == 0
    same = temperature_mix.mix(odd_docs)  # natural shares, one epoch: every row once
    assert same.count() == odd_docs.count()


def test_least_whole_budget():
    even = [0.06] * 10 + [0.04] * 10
    assert temperature_mix.solve_exponent(even, entropy_share=0.97, max_repeats=4.0, epochs=None) == 1.0
    hot = [1 / 3] + [1 / 30] * 20
    a = temperature_mix.solve_exponent(hot, entropy_share=0.97, max_repeats=4.0, epochs=None)
    weights = temperature_mix.weights_at(hot, a)
    assert temperature_mix.entropy(weights) == pytest.approx(0.97 * math.log(21), abs=1e-9)
    times = temperature_mix.repetitions(hot, weights, None)
    assert times == pytest.approx([1.0] + [10 ** (1 - a)] * 20) and times[1] < 4
    tight = temperature_mix.solve_exponent(hot, entropy_share=0.97, max_repeats=1.5, epochs=None)
    assert 10 ** (1 - tight) == pytest.approx(1.5, abs=1e-6)
    with pytest.raises(ValueError):
        temperature_mix.solve_exponent(hot, entropy_share=None, max_repeats=0.5, epochs=None)


def test_pipeline_mixing_loses_nothing_and_reaches_its_target(spark, no_docs):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    assert corpus_pipeline.mix_sources(spark, docs, SF).count() == docs.count()
    rows = [(i, "one two three four five", "en", "hot" if i < 500 else f"s{i % 20}", 23) for i in range(1500)]
    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), SF)
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(times) == set(range(1500)) and max(times.values()) <= 4 and all(times[i] == 1 for i in range(500))
    got = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    # by brute force: the budgets of the largest exponent, in thousandths, that reaches the target
    shares = [500 / 1500] + [50 / 1500] * 20
    reaches = lambda a: temperature_mix.entropy([s**a / sum(x**a for x in shares) for s in shares]) >= 0.97 * math.log(21)
    a = max(k / 1000 for k in range(1001) if reaches(k / 1000))
    assert all(abs(n - 50 * 10 ** (1 - a)) <= 1.5 for s, n in got.items() if s != "hot")
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), SF).count() == 0


def test_mix_tells_a_missed_target(spark):
    rows = [(i, "one two", "hot" if i < 90 else "rare") for i in range(100)]
    with pytest.warns(UserWarning, match="entropy share of"):
        temperature_mix.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), entropy_share=0.97, max_repeats=1.1)


def test_fences_follow_each_group(spark):
    rng = np.random.default_rng(3)
    none = {m: 0.0 for m in adaptive_rules.MEASURES}
    rows = [
        ("en", source, False, *({**none, "mean_word": float(v), "upper_rate": float(u)}.values()))
        for source, spread, n in (("narrow", 0.2, 2000), ("wide", 0.8, 2000), ("small", 0.8, 5))
        for v, u in zip(rng.normal(5, spread, n), rng.normal(0.1, spread / 20, n), strict=True)
    ] + [("en", "none", True, *none.values())]
    docs = spark.createDataFrame(rows, "lang string, source string, base_failed boolean, " + ", ".join(f"{m} double" for m in none))
    got = {r["source"]: r["fences"] for r in adaptive_rules.thresholds(docs).collect()}
    width = lambda s, m: got[s][m]["high"] - (5 if m == "mean_word" else 0.1)
    for m in ("mean_word", "upper_rate"):
        assert width("wide", m) > 2 * width("narrow", m)
        # a small group leans on its language, one without documents of its own has just that
        assert width("small", m) == pytest.approx(width("none", m), rel=0.2)
    for s in ("narrow", "wide"):
        assert width(s, "mean_word") == pytest.approx(3.5 * 1.2816 * {"narrow": 0.2, "wide": 0.8}[s], rel=0.25)


def test_shape_reads_the_whole_word():
    start = "a1" * 2000
    assert len({neighbour_quality._shape(start + end) for end in ("", "!", "?", "AA")}) == 4
    assert neighbour_quality._shape("x" * 5000 + "0" * 5000) == "aa00"


def test_labelled_rows_are_bounded_before_they_are_ranked(spark):
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, 0).when(F.col("id") % 100 != 1, 1).alias("label"))
    got = [(r["label"], r["h"], r["doc_id"]) for r in neighbour_quality._lowest_hashes(rows, 700).collect()]
    every = [(r["label"], r["h"], r["doc_id"]) for r in rows.where("label is not null").withColumn("h", F.xxhash64("doc_id")).collect()]
    for label, most in ((0, 600), (1, 800)):
        mine = sorted(x for x in got if x[0] == label)
        assert mine[:700] == sorted(x for x in every if x[0] == label)[:700] and len(mine) <= most
