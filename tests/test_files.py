"""Readers, writers and the file stream on small files."""

import gzip
import hashlib

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from cellspan.operators import intervals as I
from cellspan.sources import inventory as V
from cellspan.sources import matrix_files as MF
from cellspan.sources import site_files as SF
from cellspan.sources import tables as TB
from cellspan.sources.text import read_lines
from cellspan.streaming import region_counts as RC


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_allc_lines(spark, tmp_path, rows):
    put(tmp_path / "a.allc.tsv.gz", "chrom\tpos\tstrand\tcontext\tmc\tcov\n# note\n\nchr1\t1\t+\tCGN\t1\t2\t1\nchr1\t2\t+\tCGN\t0\t2\n")
    put(tmp_path / "b.allc.tsv.gz", "chr1\t7\t+\tCGN\t1\t2\nchr1\tx\t+\tCGN\t1\t2\nchr1\t1\n")
    got = SF.read_allc(spark, str(tmp_path), on_error="skip")
    assert rows(got, "chrom", "pos", "mc", "cov") == [("chr1", 1, 1, 2), ("chr1", 2, 0, 2), ("chr1", 7, 1, 2)]
    errors = SF.allc_errors(read_lines(spark, str(tmp_path), "*.gz"))
    # the header of the first file is no error, the bad line of the second is
    assert rows(errors, "problem") == [("fewer than 6 columns",), ("non-integer field",)]


@pytest.mark.parametrize("line,told", [
    ("chr1\tx\t+\tCGN\t1\t2", "non-integer field"), ("chr1\t1", "fewer than 6 columns"), ("chr1\t1\t+\tCGN\t1\t2.5", "non-integer field"),
])
def test_a_malformed_site_line_stops_the_job(spark, tmp_path, rows, line, told):
    head = "chrom\tpos\tstrand\tcontext\tmc\tcov\n"
    put(tmp_path / "a.gz", head + "chr1\t7\t+\tCGN\t1\t2\n")
    assert rows(SF.read_allc(spark, str(tmp_path)), "pos", "cov") == [(7, 2)]
    put(tmp_path / "b.gz", f"chr1\t7\t+\tCGN\t1\t2\n{line}\n")
    with pytest.raises(Exception, match=told):
        SF.read_allc(spark, str(tmp_path)).agg(F.sum("cov")).collect()
    with pytest.raises(ValueError, match="raise or skip"):
        SF.read_allc(spark, str(tmp_path), on_error="drop")


def test_a_bad_coverage_line_stops_the_job(spark, tmp_path):
    put(tmp_path / "a.cov", "chr1\t3\t3\t50.0\t1\t1\nchr1\t5\t4\t50.0\t1\t1\n")
    with pytest.raises(Exception, match="invalid coordinate or count"):
        SF.read_cov(spark, str(tmp_path)).count()
    assert SF.read_cov(spark, str(tmp_path), on_error="skip").count() == 1


@pytest.mark.parametrize("name,regex,replacement,prefix,expected", [
    ("AAACCTGAGAAACCAT-1.allc.tsv.gz", "", "", "lung-S11-m1", "lung-S11-m1_AAACCTGAGAAACCAT-1"),
    ("allc_lung-S11-m1_sc10.tsv.gz", r"allc_(?P<cell_id>.+)\.tsv\.gz$", "", "lung-S11-m1", "lung-S11-m1_sc10"),
    ("x_allc.gz", "", "", "", "x"), ("x.allc.gz", "", "", "S", "S_x"), ("x.gz", "", "", "S", "S_x.gz"),
    ("ab-12.gz", r"(\w+)-(?P<n>\d+)", r"\g<n>.\1", "S", "S_12.ab"),
    ("x-.gz", r"x-(?P<cell_id>\d*)", "", "S", "S_x-"),
])
def test_cell_ids(spark, name, regex, replacement, prefix, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(SF.prefixed_cell_id(SF.cell_name("n", regex, replacement), F.lit(prefix))).first()[0] == expected


def test_name_without_match_is_an_error(spark):
    with pytest.raises(Exception, match="does not match"):
        spark.createDataFrame([("a",)], "n string").select(SF.cell_name("n", "zzz")).collect()


def test_discovery_depth_and_duplicates(spark, tmp_path, rows):
    put(tmp_path / "one/deep/c1.allc.tsv.gz", "x")
    put(tmp_path / "one/c2.allc.tsv.gz", "x")
    put(tmp_path / "one/other.gz", "x")
    put(tmp_path / "two/S1_c1.allc.tsv.gz", "x")
    samples = spark.createDataFrame([("S1", f"{tmp_path}/one", "S1"), ("S2", f"{tmp_path}/two", "S1")], "sample_id string, allc_root string, cell_id_prefix string")
    cells = SF.discover_cells(samples)
    assert rows(cells, "sample_id", "cell_id") == [("S1", "S1_c1"), ("S1", "S1_c2"), ("S2", "S1_c1")]
    assert rows(SF.duplicate_cells(cells), "cell_id") == [("S1_c1",)]
    assert SF.discover_cells_one_root(spark, f"{tmp_path}/one", ["Z"]).count() == 3
    inventory = V.source_inventory(cells)
    assert V.inventory_changes(inventory, inventory).isEmpty()
    assert V.inventory_changes(inventory, inventory.withColumn("size", F.col("size") + 1)).count() == 6


def test_cov_round_trip(spark, tmp_path, rows):
    sites = spark.createDataFrame([("c1", "chr1", 5, 1, 3), ("c1", "chr1", 2, 0, 1), ("c2", "chr2", 9, 2, 2)], "cell_id string, chrom string, pos long, mc long, cov long")
    SF.write_cov(sites, f"{tmp_path}/cov")
    back = SF.read_cov(spark, f"{tmp_path}/cov", "*.gz")
    assert rows(back, "chrom", "start", "end", "pct", "mc", "uc") == [("chr1", 2, 2, 0.0, 0, 1), ("chr1", 5, 5, 33.333333, 1, 2), ("chr2", 9, 9, 100.0, 2, 0)]
    assert rows(SF.cov_to_allc(back), "pos", "strand", "context", "mc", "cov", "methylated") == [(2, "+", "CGN", 0, 1, 1), (5, "+", "CGN", 1, 3, 1), (9, "+", "CGN", 2, 2, 1)]
    with pytest.raises(Exception):
        SF.write_cov(sites, f"{tmp_path}/cov")


def test_mtx(spark, tmp_path, rows):
    put(tmp_path / "barcodes.tsv", "AAAC-1\nAAAG-1\n")
    put(tmp_path / "features.tsv", "e1\tGENE1\tx\ne2\tMT-X\tx\ne3\tGENE1\tx\n")
    put(tmp_path / "matrix.mtx", "%%MatrixMarket matrix coordinate integer general\n%c\n3 2 3\n1 1 3\n2 2 1\n3 2 4\n")
    assert rows(MF.read_10x_mtx(spark, str(tmp_path), "S1"), "cell_id", "gene", "count") == [("S1_AAAC-1", "GENE1", 3), ("S1_AAAG-1", "GENE1-1", 4), ("S1_AAAG-1", "MT-X", 1)]


@pytest.mark.parametrize("sizes,entry,told", [
    ("3 2 2", "1 1 3", "declares"), ("2 2 1", "1 1 3", "declares"), ("3 2 1", "4 1 3", "no feature or barcode"),
    ("3 2 1", "1 0 3", "no feature or barcode"), ("3 2 1", "1 1 x", "no feature or barcode"),
])
def test_mtx_that_contradicts_itself_is_refused(spark, tmp_path, sizes, entry, told):
    put(tmp_path / "barcodes.tsv", "AAAC-1\nAAAG-1\n")
    put(tmp_path / "features.tsv", "e1\tGENE1\tx\ne2\tMT-X\tx\ne3\tGENE1\tx\n")
    put(tmp_path / "matrix.mtx", f"%%MatrixMarket matrix coordinate integer general\n{sizes}\n{entry}\n")
    with pytest.raises(Exception, match=told):
        MF.read_10x_mtx(spark, str(tmp_path), "S1").collect()


def test_manifest(spark, tmp_path, rows):
    head = "\t".join(TB.SAMPLE_COLUMNS)
    path = put(tmp_path / "s.tsv", head + "\nS1\tcontrol\tB1\t1\t\t\t/a\t\t\t\t\nS1\tc\tB\tyes\t/r\t\t\t\tP\t\t\n-x\tc\tB\tno\t/r\t10x_mtx\t\t\t\t\t\n")
    samples = TB.read_samples(spark, path)
    assert rows(samples, "sample_id", "cell_id_prefix") == [("-x", "-x"), ("S1", "P"), ("S1", "S1")]
    problems = [p for r in TB.sample_problems(samples).collect() for p in r["problems"]]
    assert sorted(problems) == ["duplicate sample_id", "duplicate sample_id", "invalid sample_id", "rna_format required"]
    with pytest.raises(ValueError):
        TB.read_samples(spark, put(tmp_path / "bad.tsv", "sample_id\tother\nS\t1\n"))


def test_bed_and_sizes(spark, tmp_path, rows):
    sizes = TB.read_chrom_sizes(spark, put(tmp_path / "sizes", "# c\nchr2\t50\nchr1\t1000\n"))
    assert rows(sizes, "chrom", "size", "rank") == [("chr1", 1000, 1), ("chr2", 50, 0)]
    bed = TB.read_bed(spark, put(tmp_path / "x.bed", "# c\nchr1\t100\t200\n\nchr1\t5\t5\nchr2\t1\t60\nchr1\tx\t3\n"), "bed3")
    assert rows(TB.bed_problems(bed, sizes), "chrom", "problem") == [("chr1", "invalid_interval"), ("chr1", "unreadable"), ("chr2", "past_chromosome_end")]
    dmr = TB.read_bed(spark, put(tmp_path / "d.bed", "chr1\t10\t20\t1.5\t3\t4\t5\t0.1\t0.6\tgroup_A\t0.001\tNA\n"), "dmr12").first()
    assert (dmr["meth_a"], dmr["meth_b"], dmr["low_group"], dmr["adj_p"]) == (0.1, 0.6, "group_A", None)


def test_annotation_and_worksheet(spark, tmp_path, rows):
    path = put(tmp_path / "a.tsv", "id\tlab\textra\nS1_A\t T \tx\nS1_B\t\ty\nS1_B\tU\tz\n")
    a = TB.read_annotation(spark, path, "id", "lab")
    assert a.columns == ["cell_id", "cell_type", "extra"]
    assert rows(TB.annotation_problems(a)) == [("S1_B", "blank"), ("S1_B", "duplicate")]
    sheet = spark.createDataFrame([("0", "T", 3, "T", "reviewed", "")], "cluster string, proposed_cell_type string, cells long, cell_type string, confidence string, evidence string")
    TB.export_worksheet(sheet, f"{tmp_path}/w")
    assert rows(TB.import_worksheet(spark, f"{tmp_path}/w"), "cluster", "cell_type") == [("0", "T")]
    with pytest.raises(Exception):
        TB.export_worksheet(sheet, f"{tmp_path}/w")


def test_checksums(spark, tmp_path):
    path = put(tmp_path / "f.txt", "abc")
    sums = V.file_checksums(spark, path, "md5")
    assert sums.first()["digest"] == "900150983cd24fb0d6963f7d28e17f72"
    declared = sums.select("path", F.upper("digest").alias("digest"))
    assert V.checksum_mismatches(sums, declared).isEmpty()
    assert V.checksum_mismatches(sums, declared.withColumn("digest", F.lit("0"))).count() == 1


def _digests(folder, algorithm):
    return {p.name: hashlib.new(algorithm, p.read_bytes()).hexdigest() for p in folder.iterdir()}


@pytest.mark.parametrize("algorithm", ["sha256", "md5"])
def test_checksums_of_files_read_in_pieces(spark, tmp_path, algorithm):
    names = ["one", "a b.gz", "100%25.txt", "x#y=1", "é", "p", "q"]
    for name, size in zip(names, [1, 1000, 1001, 1064, 5000, 64, 4_999], strict=True):
        (tmp_path / name).write_bytes(hashlib.shake_128(name.encode()).digest(size))
    sums = V.file_checksums(spark, str(tmp_path), algorithm, piece=1000).collect()
    assert {r["path"].rpartition("/")[2]: r["digest"] for r in sums} == _digests(tmp_path, algorithm) and len(sums) == len(names)
    assert all(r["size"] == (tmp_path / r["path"].rpartition("/")[2]).stat().st_size for r in sums)
    with pytest.raises(ValueError, match="positive"):
        V.file_checksums(spark, str(tmp_path), piece=0)


def _first_turn(folder, **sizes):
    for name, size in sizes.items():
        (folder / name).write_bytes(name.encode() * size)
    rows = [{"path": f"file:{folder}/{name}", "size": size, "at": 0, "state": None, "digest": None} for name, size in sizes.items()]
    types = {"path": pa.string(), "size": pa.int64(), "at": pa.int64(), "state": pa.binary(), "digest": pa.string()}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))


def test_a_task_reads_one_piece_of_all_its_files(tmp_path):
    batch, places, digests = _first_turn(tmp_path, a=700, b=2500), [], {}
    while batch.num_rows:
        (batch,) = V._read_on("sha256", 1000)(iter([batch]))
        places.append(batch["at"].to_pylist())
        done = pa.compute.is_valid(batch["digest"])
        digests |= {r["path"][-1]: r["digest"] for r in batch.filter(done).to_pylist()}
        batch = batch.filter(pa.compute.invert(done))
    assert places == [[700, 300], [1300], [2300], [2500]]
    assert digests == _digests(tmp_path, "sha256")


def test_a_file_that_shrinks_has_no_checksum(tmp_path):
    batch = _first_turn(tmp_path, a=700)
    (tmp_path / "a").write_bytes(b"a")
    with pytest.raises(OSError, match="ended at 1 of 700"):
        list(V._read_on("sha256", 1000)(iter([batch])))


def test_checksums_without_a_digest_to_take_up_again(tmp_path, monkeypatch):
    monkeypatch.setattr(V, "_library", lambda algorithm: None)
    (batch,) = V._read_on("sha256", 1000)(iter([_first_turn(tmp_path, a=700, b=2500)]))
    assert dict(zip("ab", batch["digest"].to_pylist(), strict=True)) == _digests(tmp_path, "sha256")


def test_checksum_of_a_file_beyond_2_gb(spark, tmp_path):
    # sparse: it takes no disk
    with open(tmp_path / "big.gz", "wb") as file:
        for place in (0, 1 << 30, (1 << 31) + 12_345):
            file.seek(place)
            file.write(b"abc")
    (tmp_path / "small").write_bytes(b"abc")
    with open(tmp_path / "big.gz", "rb") as file:
        want = hashlib.file_digest(file, "md5").hexdigest()
    sums = V.file_checksums(spark, str(tmp_path), "md5")
    got = {r["path"].rpartition("/")[2]: (r["size"], r["digest"]) for r in sums.collect()}
    assert got == {"big.gz": ((1 << 31) + 12_348, want), "small": (3, "900150983cd24fb0d6963f7d28e17f72")}


def test_matrix_store_refuses_bad_counts(spark, tmp_path):
    obs = spark.createDataFrame([("a",)], "cell_id string")
    var = spark.createDataFrame([("f",)], "feature_id string")
    counts = spark.createDataFrame([("a", "f", 1, 2)], "cell_id string, feature_id string, mc long, cov long")
    MF.save_matrix(counts, obs, var, f"{tmp_path}/m")
    with pytest.raises(Exception):
        MF.save_matrix(counts, obs, var, f"{tmp_path}/m")
    with pytest.raises(ValueError, match="unknown features"):
        MF.save_matrix(counts.withColumn("feature_id", F.lit("z")), obs, var, f"{tmp_path}/m2")


def test_stream_counts_each_cell_once_and_keeps_its_definition(spark, tmp_path, rows):
    regions = spark.createDataFrame([("chr1", 0, 100, "r1"), ("chr1", 200, 300, "r2")], "chrom string, start long, end long, feature_id string")
    source, out = tmp_path / "in", f"{tmp_path}/out"

    def run():
        RC.stream_region_counts(RC.stream_allc(spark, str(source), "S"), regions, out).awaitTermination()
        return rows(RC.read_region_counts(spark, out))

    put(source / "c1.allc.tsv.gz", "chr1\t10\t+\tCGN\t1\t2\nchr1\t250\t+\tCGA\t2\t2\nchr1\t20\t+\tCHN\t2\t2\n")
    assert run() == [("S_c1", "r1", 1, 2), ("S_c1", "r2", 2, 2)]
    put(source / "c2.allc.tsv.gz", "chr1\t100\t+\tCGN\t0\t3\n")
    want = [("S_c1", "r1", 1, 2), ("S_c1", "r2", 2, 2), ("S_c2", "r1", 0, 3)]
    assert run() == want and run() == want
    changed = regions.withColumn("end", F.col("end") + 1)
    with pytest.raises(ValueError, match="differs"):
        RC.stream_region_counts(RC.stream_allc(spark, str(source), "S"), changed, out)
    batch = SF.read_allc(spark, str(source), "*.gz").where("context like 'CG%'")
    named = batch.withColumn("cell_id", SF.prefixed_cell_id(SF.cell_name(F.element_at(F.split("path", "/"), -1)), F.lit("S")))
    assert rows(I.count_over_regions(named, regions)) == want


@pytest.mark.parametrize("together", [True, False])
def test_stream_refuses_a_cell_from_two_files(spark, tmp_path, together):
    regions = spark.createDataFrame([("chr1", 0, 100, "r1")], "chrom string, start long, end long, feature_id string")
    source, out = tmp_path / "in", f"{tmp_path}/out"

    def run():
        RC.stream_region_counts(RC.stream_allc(spark, str(source), "S"), regions, out).awaitTermination()

    put(source / "c1.allc.tsv.gz", "chr1\t10\t+\tCGN\t1\t2\n")
    if not together:
        run()
    put(source / "again/c1.allc.tsv.gz", "chr1\t10\t+\tCGN\t1\t2\n")
    with pytest.raises(Exception, match="more than one file"):
        run()
