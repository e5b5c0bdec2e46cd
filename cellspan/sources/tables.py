"""Small delimited tables: sample manifests, annotations, BED files, worksheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellspan.functions.columns import is_truthy
from cellspan.plans.guards import ConstraintError, Guard, checked
from cellspan.sources.text import is_content, read_lines, with_line_numbers

# Manifest columns (version 1 is the first nine) and the accepted count formats.
SAMPLE_COLUMNS = (
    "sample_id", "condition", "batch", "include", "rna_path", "rna_format", "allc_root", "allc_glob",
    "cell_id_prefix", "allc_cell_id_regex", "allc_cell_id_replacement",
)
RNA_FORMATS = ("", "10x_mtx", "10x_h5", "10x_zip")

BED_KINDS = {
    "sizes": "chrom string, size bigint",
    "bed3": "chrom string, start bigint, end bigint",
    "vmr6": "chrom string, start bigint, end bigint, peak_var double, n_cpg bigint, n_obs_cells bigint",
    "vmr7": "chrom string, start bigint, end bigint, peak_var double, n_cpg bigint, n_obs_cells bigint, feature_id string",
    "dmr12": "chrom string, start bigint, end bigint, t_stat double, n_sites bigint, n_a bigint, n_b bigint, "
             "meth_a double, meth_b double, low_group string, raw_p double, adj_p double",
}


def _text(name: str):
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Manifest with the exact version-1 or version-2 column tuple; trimmed, prefix defaulted."""
    raw = spark.read.option("header", True).option("sep", "\t").option("inferSchema", False).csv(path)
    if tuple(raw.columns) not in (SAMPLE_COLUMNS, SAMPLE_COLUMNS[:9]):
        raise ValueError(f"manifest columns must be {SAMPLE_COLUMNS} or the first nine, got {tuple(raw.columns)}")
    out = raw.select(*[_text(c).alias(c) for c in raw.columns])
    for c in SAMPLE_COLUMNS[9:]:
        if c not in raw.columns:
            out = out.withColumn(c, F.lit(""))
    return out.withColumn("cell_id_prefix", F.when(F.col("cell_id_prefix") == "", F.col("sample_id")).otherwise(F.col("cell_id_prefix")))


def _sample_faults(copies: Column) -> Column:
    """All problems of a manifest row, given how often its id occurs."""
    rna, allc, fmt = _text("rna_path"), _text("allc_root"), _text("rna_format")
    return F.array_compact(F.array(
        F.when(~_text("sample_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"), "invalid sample_id"),
        F.when(copies > 1, "duplicate sample_id"),
        F.when(~fmt.isin(*RNA_FORMATS), "unsupported rna_format"),
        F.when(is_truthy("include") & (rna == "") & (allc == ""), "no RNA or ALLC input"),
        F.when((rna != "") & (fmt == ""), "rna_format required"),
    ))


def sample_problems(samples: DataFrame) -> DataFrame:
    """Every row with all of its problems (an array), for rows that have any."""
    copies = samples.groupBy(_text("sample_id").alias("__id")).agg(F.count("*").alias("__n"))
    return (
        samples.withColumn("__id", _text("sample_id")).join(copies, "__id").withColumn("problems", _sample_faults(F.col("__n")))
        .where(F.size("problems") > 0).drop("__id", "__n")
    )


def checked_samples(samples: DataFrame) -> DataFrame:
    """``samples`` read once; a faulty row, named with all its problems, or a manifest that includes no sample is an error."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(_text("sample_id")))
    judged = samples.withColumn("__copies", copies).withColumn("problems", _sample_faults(F.col("__copies"))).drop("__copies")
    faults = Guard(judged, "sample manifest", {"problems": F.size("problems") > 0}, ["sample_id", "problems"])
    stored = checked(faults.watched, faults)
    # a manifest is stored now: this looks at the copy
    if stored.where(is_truthy("include")).isEmpty():
        raise ConstraintError("sample manifest: no included sample")
    return stored.select(*samples.columns)


def normalize_annotation(raw: DataFrame, cell_column: str = "cell_id", type_column: str = "cell_type") -> DataFrame:
    """``cell_id, cell_type`` first (label trimmed), the other columns after them in order."""
    rest = [c for c in raw.columns if c not in {cell_column, type_column, "cell_id", "cell_type"}]
    return raw.select(F.col(cell_column).alias("cell_id"), F.trim(F.coalesce(F.col(type_column), F.lit(""))).alias("cell_type"), *rest)


def read_annotation(spark: SparkSession, path: str, cell_column: str = "cell_id", type_column: str = "cell_type") -> DataFrame:
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    lacking = {cell_column, type_column} - set(raw.columns)
    if lacking:
        raise ValueError(f"annotation lacks columns {sorted(lacking)}")
    return normalize_annotation(raw, cell_column, type_column)


def annotation_problems(annotation: DataFrame) -> DataFrame:
    """Repeated or blank cell ids and blank labels."""
    blank = annotation.where((_text("cell_id") == "") | (_text("cell_type") == "")).select("cell_id", F.lit("blank").alias("problem"))
    twice = annotation.groupBy("cell_id").agg(F.count("*").alias("n")).where("n > 1").select("cell_id", F.lit("duplicate").alias("problem"))
    return blank.unionByName(twice)


def checked_annotation(annotation: DataFrame) -> DataFrame:
    """``annotation`` read once; a repeated or blank cell id and a blank label are errors that name the row."""
    copies = F.count(F.lit(1)).over(Window.partitionBy("cell_id"))
    guard = Guard(annotation.withColumn("__copies", copies), "annotation", {
        "a blank cell id": _text("cell_id") == "", "a blank label": _text("cell_type") == "", "a repeated cell id": F.col("__copies") > 1,
    }, ["cell_id", "cell_type"])
    return checked(guard.watched.drop("__copies"), guard)


def checked_bed(bed: DataFrame, chrom_sizes: DataFrame | None = None, *, file: str = "interval file") -> DataFrame:
    """``bed`` (as :func:`read_bed` gives it) read once, without ``_corrupt``; an unreadable row or bad coordinates are errors.

    Where sizes are given, an interval past its chromosome's end is one too; chromosomes they lack are left alone.
    """
    rows, past = bed, F.lit(False)
    if chrom_sizes is not None:
        rows = bed.join(F.broadcast(checked_sizes(chrom_sizes).select("chrom", F.col("size").alias("__size"))), "chrom", "left")
        past = F.col("end") > F.col("__size")
    unread = F.col("_corrupt").isNotNull() | F.col("start").isNull() | F.col("end").isNull()
    guard = Guard(rows, file, {
        "an unreadable row": unread, "an invalid interval": (F.col("start") < 0) | (F.col("end") <= F.col("start")), "an end past the chromosome": past,
    }, ["chrom", "start", "end", "_corrupt"])
    return checked(guard.watched.select(*[c for c in bed.columns if c != "_corrupt"]), guard)


def checked_sizes(chrom_sizes: DataFrame, *, limit: int = 1_000_000) -> DataFrame:
    """``chrom_sizes`` stored; a chromosome listed twice, or more of them than a broadcast should hold, is an error."""
    copies = F.count(F.lit(1)).over(Window.partitionBy("chrom"))
    guard = Guard(chrom_sizes.withColumn("__copies", copies), "chromosome sizes", {
        "a chromosome listed twice": F.col("__copies") > 1, "a size that is no positive number": ~F.coalesce(F.col("size") > 0, F.lit(False))}, ["chrom", "size"])
    out = checked(guard.watched.drop("__copies"), guard)
    if out.count() > limit:
        raise ConstraintError(f"chromosome sizes: more than {limit} chromosomes")
    return out


def read_bed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Headerless interval file of one of :data:`BED_KINDS`; blank and ``#`` lines are skipped.

    A row that does not parse keeps its text in ``_corrupt``; :func:`checked_bed` refuses it, :func:`bed_problems` lists it.
    """
    schema = T._parse_datatype_string(BED_KINDS[kind] + ", _corrupt string")
    return (
        spark.read.schema(schema).option("sep", "\t").option("comment", "#").option("nullValue", "NA")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    )


def bed_problems(bed: DataFrame, chrom_sizes: DataFrame | None = None) -> DataFrame:
    """Rows with bad coordinates: ``0 <= start < end`` and, where sizes are given, ``end <= size``."""
    checked = bed
    bounds = F.lit(False)
    if chrom_sizes is not None:
        checked = checked.join(chrom_sizes.select("chrom", F.col("size").alias("__size")), "chrom", "left")
        bounds = F.col("end") > F.col("__size")
    problem = (
        F.when(F.col("start").isNull() | F.col("end").isNull(), "unreadable")
        .when((F.col("start") < 0) | (F.col("end") <= F.col("start")), "invalid_interval")
        .when(bounds, "past_chromosome_end")
    )
    return checked.withColumn("problem", problem).where("problem is not null").drop("__size")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, size, rank`` with the rank from line order; the order of this file is semantic.

    A chromosome listed twice is an error: check with ``expect_unique(sizes, "chrom")``.
    """
    lines = read_lines(spark, path).where(is_content())
    parts = F.split("line", "\t")
    placed = with_line_numbers(lines).select(
        F.trim(parts[0]).alias("chrom"), F.trim(parts[1]).cast("bigint").alias("size"), (F.col("line_no") - 1).cast("int").alias("rank")
    )
    return placed


def export_worksheet(sheet: DataFrame, path: str) -> None:
    """Write the review sheet as one headed TSV; an existing target is an error (it is a reviewer's work)."""
    # one row per cluster: a single small file is what a reviewer opens
    sheet.orderBy("cluster").coalesce(1).write.mode("errorifexists").option("header", True).option("sep", "\t").option("emptyValue", "").csv(path)


def import_worksheet(spark: SparkSession, path: str) -> DataFrame:
    sheet = spark.read.option("header", True).option("sep", "\t").csv(path)
    lacking = {"cluster", "cell_type"} - set(sheet.columns)
    if lacking:
        raise ValueError(f"worksheet lacks columns {sorted(lacking)}")
    return sheet
