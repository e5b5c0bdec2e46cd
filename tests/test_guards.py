"""Every guard raises and names a row, costs no second scan, and leaves good data as they are."""

import gzip
import re

import pytest
from pyspark.sql import functions as F

from cellspan.operators import cells as K
from cellspan.operators import features as FT
from cellspan.operators import matrices as MX
from cellspan.operators import sites as S
from cellspan.plans import guards, routes
from cellspan.plans.guards import ConstraintError, checked, write_checked
from cellspan.sources import site_files as SF
from cellspan.sources import tables as T
from cellspan.streaming import region_counts as RC

SITE = "cell_id string, chrom string, pos long, context string, mc long, cov long"


def scans(df):
    """File or row scans that the plan runs."""
    return len(re.findall(r"\(\d+\) Scan ", df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))))


@pytest.fixture
def site_file(spark, tmp_path):
    path = f"{tmp_path}/sites"
    rows = [("a", "chr1", 5, "CGA", 1, 2), ("a", "chr1", 9, "CGA", 2, 2), ("b", "chr1", 5, "CGT", 0, 4)]
    spark.createDataFrame(rows, SITE).write.parquet(path)
    return path


@pytest.mark.parametrize(("rule", "row"), [
    ("convert", ("c", "chr2", 7, "CGA", 3, 2)), ("convert", ("c", "chr2", 0, "CGA", 1, 2)), ("convert", ("c", "chr2", 7, "CGA", 0, 0)),
    ("preflight", ("c", "chr2", 7, "CGA", -1, 2)), ("count", ("c", "chr2", None, "CGA", 1, 2)),
])
def test_sites_that_break_a_rule_are_named(spark, site_file, rule, row):
    sites = spark.read.parquet(site_file)
    good = S.guarded_sites(sites, rule)
    assert checked(good.watched, good).count() == 3
    bad = S.guarded_sites(sites.unionByName(spark.createDataFrame([row], SITE)), rule)
    with pytest.raises(ConstraintError, match=r'sites \(\w+\): an invalid position or count in 1 of 4 rows.*"chrom":"chr2"'):
        checked(bad.watched.groupBy("cell_id").count(), bad)


def test_guards_add_no_scan(spark, site_file):
    sites = spark.read.parquet(site_file)
    plain = sites.groupBy("cell_id").agg(F.sum("cov"))
    guard = S.guarded_sites(sites, "count")
    watched = guard.watched.groupBy("cell_id").agg(F.sum("cov"))
    assert scans(watched) == scans(plain) == 1 and "CollectMetrics" in watched._jdf.queryExecution().executedPlan().toString()
    ids = sites.select("cell_id").distinct()
    kept, listed = K.guarded_restriction(sites, ids)
    # the site file once, the stored id list once
    assert scans(kept) == 2
    labelled = sites.select("cell_id", F.lit("S").alias("sample_id"), F.col("cell_id").alias("cell_type"))
    pairs, _ = K.guarded_pairs(labelled)
    assert len(re.findall("FileScan", pairs._jdf.queryExecution().optimizedPlan().toString())) == 0 and checked(pairs).count() == 1
    (write_checked(kept, f"{site_file}-kept", listed), spark.read.parquet(f"{site_file}-kept").count() == 3)


def test_listed_cells_are_unique_and_present(spark, site_file, monkeypatch):
    sites = spark.read.parquet(site_file)

    def restricted(ids):
        return checked(*K.guarded_restriction(sites, spark.createDataFrame([(i,) for i in ids], "cell_id string")))

    assert restricted(["a"]).count() == 2 and set(restricted(["a", "b"]).columns) == set(sites.columns)
    with pytest.raises(ConstraintError, match="do not occur, first c, d"):
        restricted(["a", "c", "d"])
    with pytest.raises(ConstraintError, match='a repeated id in 1 of 2 rows.*"cell_id":"b"'):
        restricted(["a", "b", "b"])
    with pytest.raises(ConstraintError, match="do not occur, first x"):
        restricted(["x"])
    many = spark.range(40_000).select(F.concat(F.lit("n"), "id").alias("cell_id"))
    assert checked(*K.guarded_restriction(many.withColumn("v", F.lit(1)), many)).count() == 40_000
    with pytest.raises(ConstraintError, match="do not occur, first n39999"):
        checked(*K.guarded_restriction(many.where("cell_id <> 'n39999'"), many))
    monkeypatch.setattr(guards, "MAX_BITMAPS", 1)
    with pytest.raises(ConstraintError, match="do not occur, first n7"):
        checked(*K.guarded_restriction(many.where("cell_id <> 'n7'"), many))


def test_cells_samples_and_labels(spark, site_file):
    sites = spark.read.parquet(site_file)
    cells = spark.createDataFrame([("a", "S", "x"), ("b", "S", "y"), ("z", "R", "y"), ("w", "R", "NA")], "cell_id string, sample_id string, cell_type string")
    qc = S.guarded_cell_site_qc(sites, cells.where("sample_id = 'S'"))
    assert checked(qc.watched, qc).count() == 2
    qc = S.guarded_cell_site_qc(sites, cells)
    with pytest.raises(ConstraintError, match="no covered site in 2 of 4 rows"):
        checked(qc.watched, qc)
    notes = cells.where("sample_id = 'S'").select("cell_id", "cell_type")
    one = K.guarded_summary(K.select_cells(cells, notes, approved=True))
    with pytest.raises(ConstraintError, match='no cell selected in 1 of 2 rows.*"sample_id":"R"'):
        checked(one.watched, one)
    pairs, guard = K.guarded_pairs(cells.where("sample_id = 'S'"))
    assert [r["comparison"] for r in checked(pairs, guard).collect()] == ["x_vs_y"]
    pairs, guard = K.guarded_pairs(cells)
    with pytest.raises(ConstraintError, match='fewer than two labels.*"sample_id":"R","labels":1'):
        checked(pairs, guard)


def test_union_refuses_a_cell_of_two_samples(spark):
    make = lambda rows: spark.createDataFrame(rows, "cell_id string, gene string, count long")
    a, b = make([("a", "g", 2), ("a", "h", 1)]), make([("b", "g", 5)])
    total = lambda df: df.groupBy("cell_id").agg(F.sum("count").alias("total"))
    guard = K.guarded_union([a, b], total)
    assert sorted(tuple(r) for r in checked(guard.watched, guard).collect()) == [("a", 3), ("b", 5)]
    guard = K.guarded_union([a, b.unionByName(make([("a", "k", 1)]))], total)
    with pytest.raises(ConstraintError, match='a cell of several samples.*"cell_id":"a"'):
        checked(guard.watched, guard)


def test_small_matrices_and_unsound_combinations(spark):
    rows = [(c, f, 1, 2) for c in "abc" for f in ("v1", "v2")]
    counts = spark.createDataFrame(rows, "cell_id string, feature_id string, mc long, cov long")
    cells = counts.select("cell_id").distinct()
    kept, rules = MX.guarded_missingness(counts, cells, min_cell_regions=2)
    assert checked(kept, *rules).count() == 6
    for part, told in ((counts.where("cell_id <> 'a'"), "cells with enough regions: 2 found"), (counts.where("feature_id = 'v1'"), "regions observed in enough cells: 1 found")):
        with pytest.raises(ConstraintError, match=told):
            kept, rules = MX.guarded_missingness(part, cells, min_cell_regions=1)
            checked(kept, *rules)
    var = lambda rows: spark.createDataFrame(rows, "chrom string, start long, end long, feature_id string, selection_rank int")
    vmr, dmr = var([("chr1", 0, 10, "v1", 1), ("chr1", 20, 30, "v2", 2)]), var([("chr1", 5, 15, "d1", 1), ("chr1", 40, 50, "d2", 2)])
    other = counts.withColumn("feature_id", F.when(F.col("feature_id") == "v1", "d1").otherwise("d2"))

    def combined(vmr=vmr, dmr=dmr, a=counts, b=other, ca=cells, cb=cells):
        features, both, rules = FT.combine_inputs(vmr, dmr, a, b, ca, cb)
        return checked(both, *rules), features

    both, features = combined()
    assert sorted({r["feature_id"] for r in both.collect()}) == ["d2", "v1", "v2"]
    assert [r["feature_id"] for r in features.orderBy("selection_rank").collect()] == ["v1", "v2", "d2"]
    for told, change in (
        ("a cell of one source only", {"cb": cells.where("cell_id <> 'a'")}), ("a feature id of both", {"dmr": var([("chr1", 40, 50, "v1", 1)])}),
        ("DMRs that overlap no VMR: 0 found", {"dmr": dmr.where("feature_id = 'd1'")}), ("mc above cov", {"b": other.withColumn("mc", F.lit(5).cast("long"))}),
    ):
        with pytest.raises(ConstraintError, match=told):
            combined(**change)


def test_small_tables(spark):
    names = T.SAMPLE_COLUMNS
    row = lambda **x: tuple({**dict.fromkeys(names, ""), "sample_id": "s1", "include": "yes", "allc_root": "/a", **x}[n] for n in names)
    make = lambda *rows: spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in names))
    assert T.checked_samples(make(row(), row(sample_id="s2", include="no"))).count() == 2
    for told, rows in (("no included sample", [row(include="no")]), ("duplicate sample_id", [row(), row()]), ("invalid sample_id", [row(sample_id="-x")]),
                       ("no RNA or ALLC input", [row(allc_root="")])):
        with pytest.raises(ConstraintError, match=told):
            T.checked_samples(make(*rows))
    notes = lambda *rows: spark.createDataFrame(list(rows), "cell_id string, cell_type string")
    assert T.checked_annotation(notes(("a", "x"), ("b", "x"))).count() == 2
    for told, rows in (("a repeated cell id", [("a", "x"), ("a", "y")]), ("a blank label", [("a", " ")]), ("a blank cell id", [(None, "x")])):
        with pytest.raises(ConstraintError, match=told):
            T.checked_annotation(notes(*rows))
    sizes = spark.createDataFrame([("chr1", 100)], "chrom string, size long")
    bed = lambda *rows: spark.createDataFrame(list(rows), "chrom string, start long, end long, _corrupt string")
    assert T.checked_bed(bed(("chr1", 0, 100, None), ("chr9", 0, 900, None)), sizes).columns == ["chrom", "start", "end"]
    for told, rows in (("an unreadable row", [("chr1", None, None, "chr1\tx")]), ("an invalid interval", [("chr1", 5, 5, None)]), ("past the chromosome", [("chr1", 5, 101, None)])):
        with pytest.raises(ConstraintError, match=told):
            T.checked_bed(bed(*rows), sizes)
    with pytest.raises(ConstraintError, match="listed twice"):
        T.checked_bed(bed(("chr1", 0, 1, None)), sizes.unionByName(sizes))


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)


GOOD = "chr1\t10\t+\tCGN\t1\t2\n"


@pytest.mark.parametrize(("text", "problem"), [
    (f"chrom\tpos\tstrand\tcontext\tmc\tcov\n{GOOD}", None), (f"chr1\tx\t+\tCG\t1\t2\n{GOOD}", None), (GOOD, None),
    (f"{GOOD}chr1\tx\t+\tCG\ty\tz\n{GOOD}", "non-integer field"), (f"{GOOD}chr1\t11\t+\tCG\n", "fewer than 6 columns"),
    (f"chrom\tpos\tstrand\tcontext\tmc\tcov\n{GOOD}chr1\tx\t+\tCG\t1\tz\n", "non-integer field"), (f"# note\nchrom\tpos\tstrand\tcontext\tmc\tcov\n{GOOD}", "non-integer field"),
])
def test_only_the_first_line_may_be_a_header(spark, tmp_path, text, problem):
    put(tmp_path / "in/good.allc.tsv.gz", GOOD)
    put(tmp_path / "in/x.allc.tsv.gz", text)
    frame, guard = SF.guarded_allc(spark, f"{tmp_path}/in")
    source = RC.stream_region_counts(RC.stream_allc(spark, f"{tmp_path}/in", "S"), spark.createDataFrame(
        [("chr1", 0, 100, "r1")], "chrom string, start long, end long, feature_id string"), f"{tmp_path}/out")
    if problem is None:
        assert checked(frame, guard).count() == SF.read_allc(spark, f"{tmp_path}/in").count() == 2
        source.awaitTermination()
        return
    for run in (lambda: checked(frame, guard), lambda: SF.read_allc(spark, f"{tmp_path}/in").count(), source.awaitTermination):
        with pytest.raises(Exception, match=problem):
            run()


def test_stream_refuses_an_invalid_count(spark, tmp_path):
    put(tmp_path / "in/x.allc.tsv.gz", "chr1\t10\t+\tCGN\t3\t2\n")
    regions = spark.createDataFrame([("chr1", 0, 100, "r1")], "chrom string, start long, end long, feature_id string")
    with pytest.raises(Exception, match="an invalid position or count"):
        RC.stream_region_counts(RC.stream_allc(spark, f"{tmp_path}/in", "S"), regions, f"{tmp_path}/out").awaitTermination()


def test_discovery_refuses_empty_samples_and_repeated_cells(spark, tmp_path):
    put(tmp_path / "a/c1.allc.tsv.gz", GOOD)
    put(tmp_path / "b/c1.allc.tsv.gz", GOOD)
    (tmp_path / "none").mkdir()
    make = lambda *rows: spark.createDataFrame(list(rows), "sample_id string, allc_root string, cell_id_prefix string")
    found, rules = SF.guarded_discovery(make(("a", f"{tmp_path}/a", "a"), ("b", f"{tmp_path}/b", "b")))
    assert sorted(r["cell_id"] for r in checked(found, *rules).collect()) == ["a_c1", "b_c1"]
    for told, rows in (("a repeated cell id", [("a", f"{tmp_path}/a", "x"), ("b", f"{tmp_path}/b", "x")]), ("a sample without files", [("a", f"{tmp_path}/a", "a"), ("n", f"{tmp_path}/none", "n")])):
        with pytest.raises(ConstraintError, match=told):
            found, rules = SF.guarded_discovery(make(*rows))
            checked(found, *rules)


@pytest.mark.parametrize("value", [1e-20, 123456789.0, 1.5e300, -2.5e-7, 99999999.6, 0.0001, 0.00001, 12345678.0, 0.1, -0.0, 0.0, 1 / 3, 100.0])
def test_eight_significant_digits(spark, value):
    text = spark.createDataFrame([(value,)], "value double").select(MX.significant_digits("value")).first()[0]
    assert text.lstrip("-0") == ("%.8g" % value).lstrip("-0") and float(text) == float("%.8g" % value)


def test_routes_stop_on_bad_counts(spark, site_file):
    sites = spark.read.parquet(site_file).withColumn("mc", F.lit(9).cast("long"))
    cells = spark.createDataFrame([("a", "S", "x"), ("b", "S", "y")], "cell_id string, sample_id string, cell_type string")
    order = spark.createDataFrame([("chr1", 100, 0)], "chrom string, size long, rank int")
    with pytest.raises(ConstraintError, match="an invalid position or count in 3 of 3"):
        routes.differential_matrix(sites, cells, order)
    with pytest.raises(ConstraintError, match="fewer than two labels"):
        routes.differential_matrix(spark.read.parquet(site_file), cells.withColumn("cell_type", F.lit("x")), order, cell_filter={"min_sites": 1, "min_pct": 0})
    regions = spark.createDataFrame([("chr1", 0, 50, 1.0, 2, 3)], "chrom string, start long, end long, peak_var double, n_cpg long, n_obs_cells long")
    with pytest.raises(ConstraintError, match="an invalid position or count"):
        routes.feature_matrix(sites, regions, order, regions.limit(0).select("chrom", "start", "end"), cells, cells, n=1)
