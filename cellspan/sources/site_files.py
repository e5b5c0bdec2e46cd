"""Per-cell cytosine call files and coverage files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cellspan.plans.bounded import bounded_rows
from cellspan.plans.guards import ConstraintError, Guard, counters
from cellspan.sources.text import first_lines, is_content, read_lines

# File name endings that are not part of a cell name, longest match first.
ALLC_SUFFIXES = (".allc.tsv.gz", "_allc.gz", ".allc.gz")
DEFAULT_GLOB = "**/*.allc.tsv.gz"
MAX_SAMPLES = 100_000


def _fields(lines: DataFrame) -> DataFrame:
    parts = F.split("line", "\t")
    part = lambda i: F.get(parts, F.lit(i))
    number = lambda i: F.trim(part(i)).try_cast("bigint")
    return lines.withColumn("__n", F.size(parts)).select(
        "*", part(0).alias("chrom"), number(1).alias("pos"), part(2).alias("strand"), part(3).alias("context"),
        number(4).alias("mc"), number(5).alias("cov"),
    )


def parse_allc(lines: DataFrame) -> DataFrame:
    """Well-formed site rows of ALLC text lines: at least six fields, integer position and counts.

    A malformed line is left out here and reported by :func:`allc_errors`.
    """
    f = _fields(lines.where(is_content()))
    return f.where("__n >= 6 and pos is not null and mc is not null and cov is not null").drop("__n", "line")


def allc_errors(lines: DataFrame) -> DataFrame:
    """Lines that are errors: too few fields, or non-integer numbers anywhere but in a file's first line."""
    bad = _fields(lines.where(is_content())).where("__n < 6 or pos is null or mc is null or cov is null")
    tagged = bad.join(first_lines(lines), "path")
    header = (F.col("__n") >= 6) & (F.struct("__block", "__seq") == F.col("__first"))
    return tagged.where(~header).select(
        "path", "line", F.when(F.col("__n") < 6, "fewer than 6 columns").otherwise("non-integer field").alias("problem")
    )


def _checked(on_error: str) -> bool:
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error is raise or skip, not {on_error!r}")
    return on_error == "raise"


def _refuse(bad: Column, problem: Column) -> Column:
    """True for rows that are not ``bad``; the first bad one stops the job, in the scan that reads it."""
    told = F.raise_error(F.concat_ws(": ", "path", problem, F.substring("line", 1, 200)))
    return F.when(bad, told.cast("boolean")).otherwise(F.lit(True))


def _malformed() -> Column:
    return F.expr("__n < 6 or pos is null or mc is null or cov is null")


def _fault() -> Column:
    return F.when(F.col("__n") < 6, "fewer than 6 columns").otherwise("non-integer field")


class HeaderGuard:
    """Counts the lines that only a file's first line may be; looks for their places if there are any."""

    def __init__(self, lines: DataFrame) -> None:
        self._lines, self._seen = lines, Observation()

    def watch(self, fields: DataFrame) -> DataFrame:
        return fields.observe(self._seen, F.count_if(_malformed()).alias("headers"))

    def verify(self) -> None:
        found = counters(self._seen)
        if found is None or found["headers"]:
            found = allc_errors(self._lines).limit(5).collect()
            if found:
                raise ConstraintError(f"site files: {'; '.join(f'{r.path}: {r.problem}: {r.line[:200]}' for r in found)}")


def guarded_allc(spark: SparkSession, paths, glob: str | None = "*.gz") -> tuple[DataFrame, HeaderGuard]:
    """:func:`read_allc` in one pass. A malformed line stops the job where it is read, but for lines with six fields near a
    file's start: those are left out and counted, and the guard tells at the sink whether each was its file's first.
    """
    lines = read_lines(spark, paths, glob)
    guard = HeaderGuard(lines)
    f = _fields(lines.where(is_content()))
    perhaps = F.expr("__n >= 6 and __block = 0")
    watched = guard.watch(f.where(_refuse(~perhaps & _malformed(), _fault())))
    return parse_allc(watched.select(*lines.columns)).select("path", "chrom", "pos", "strand", "context", "mc", "cov"), guard


def read_allc(spark: SparkSession, paths, glob: str | None = "*.gz", *, on_error: str = "raise") -> DataFrame:
    """``path, chrom, pos, strand, context, mc, cov`` of every site line.

    A malformed line stops the job; ``on_error="skip"`` leaves it out for :func:`allc_errors` to report. Only the very
    first line of a file may lack numbers, as its header. To know which lines are first the files are read twice;
    :func:`guarded_allc` reads them once. A gz file is one split; follow with :func:`write_sites` to spread and cluster the rows.
    """
    lines = read_lines(spark, paths, glob)
    if _checked(on_error):
        # one row per file, which the driver's listing holds as well
        f = _fields(lines.where(is_content())).join(F.broadcast(first_lines(lines)), "path")
        header = (F.col("__n") >= 6) & (F.struct("__block", "__seq") == F.col("__first"))
        # one predicate refuses and leaves out, so that no malformed line is gone before it is judged
        good = F.when(_malformed(), ~_refuse(~header, _fault())).otherwise(F.lit(True))
        return f.where(good).select("path", "chrom", "pos", "strand", "context", "mc", "cov")
    return parse_allc(lines).select("path", "chrom", "pos", "strand", "context", "mc", "cov")


def write_sites(sites: DataFrame, path: str) -> None:
    """Parquet clustered by (chrom, pos): range partitions, sorted, so scans prune by chromosome and position."""
    sites.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode("errorifexists").parquet(path)


def cell_name(name: Column | str, regex: str = "", replacement: str = "") -> Column:
    """Cell name from a file name: a regex match (template, ``cell_id`` group unless empty, or whole), else suffix removal."""
    text = F.col(name) if isinstance(name, str) else name
    if not regex:
        out = text
        for suffix in reversed(ALLC_SUFFIXES):
            out = F.when(text.endswith(suffix), F.substring(text, F.lit(1), F.length(text) - len(suffix))).otherwise(out)
        return out
    groups = re.compile(regex).groupindex
    # Java names allow no underscore: groups are addressed by number instead
    java = re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\{groups[m.group(1)]}", re.sub(r"\(\?P<\w+>", "(", regex))
    if replacement:
        parts: list[Column] = []
        at = 0
        for m in re.finditer(r"\\g<(\w+)>|\\(\d+)", replacement):
            parts.append(F.lit(replacement[at:m.start()]))
            key = m.group(1) or m.group(2)
            parts.append(F.regexp_extract(text, java, int(key) if key.isdigit() else groups[key]))
            at = m.end()
        value = F.concat(*parts, F.lit(replacement[at:]))
    else:
        whole = F.regexp_extract(text, java, 0)
        named = F.regexp_extract(text, java, groups["cell_id"]) if "cell_id" in groups else whole
        value = F.when(named == "", whole).otherwise(named)
    miss = F.raise_error(F.concat(F.lit("file name does not match the cell-id pattern: "), text))
    return F.when(text.rlike(java), value).otherwise(miss)


def prefixed_cell_id(name: Column | str, prefix: Column | str) -> Column:
    """``prefix_name``, unless the prefix is empty or already there."""
    n = F.col(name) if isinstance(name, str) else name
    p = F.trim(F.col(prefix) if isinstance(prefix, str) else prefix)
    return F.when((p == "") | F.startswith(n, F.concat(p, F.lit("_"))), n).otherwise(F.concat(p, F.lit("_"), n))


def list_files(spark: SparkSession, root: str, glob: str = DEFAULT_GLOB) -> DataFrame:
    """``path, file_name, size, modified`` below ``root``; a leading ``**/`` means any depth."""
    head, _, pattern = glob.rpartition("/")
    deep = head.startswith("**") or not head and glob.startswith("**")
    folder = root if deep or not head else f"{root.rstrip('/')}/{head}"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern.replace("**", "*"))
    if deep:
        reader = reader.option("recursiveFileLookup", "true")
    # the content column is never selected, so files are listed and not read
    return reader.load(folder).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def discover_cells(samples: DataFrame) -> DataFrame:
    """Files of every sample with their cell names and ids.

    ``samples``: ``sample_id, allc_root`` and optionally ``allc_glob, cell_id_prefix,
    allc_cell_id_regex, allc_cell_id_replacement``. See :func:`duplicate_cells`.
    """
    spark = samples.sparkSession
    out = None
    for row in bounded_rows(samples, MAX_SAMPLES, "samples"):
        s = row.asDict()
        files = list_files(spark, s["allc_root"], (s.get("allc_glob") or "").strip() or DEFAULT_GLOB)
        name = cell_name("file_name", (s.get("allc_cell_id_regex") or "").strip(), s.get("allc_cell_id_replacement") or "")
        prefix = F.lit((s.get("cell_id_prefix") or s["sample_id"]).strip())
        one = files.select(F.lit(s["sample_id"]).alias("sample_id"), name.alias("barcode"), prefixed_cell_id(name, prefix).alias("cell_id"), "path", "size", "modified")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no sample rows")
    return out


def discover_cells_one_root(spark: SparkSession, root: str, sample_ids: list[str]) -> DataFrame:
    """One shared root, any ``.gz`` file, the sample as prefix."""
    rows = [(s, root, "**/*.gz", s) for s in sample_ids]
    return discover_cells(spark.createDataFrame(rows, "sample_id string, allc_root string, allc_glob string, cell_id_prefix string"))


def guarded_discovery(samples: DataFrame) -> tuple[DataFrame, list[Guard]]:
    """:func:`discover_cells`, and the guards that every sample has a file and no cell id comes twice; one listing for all."""
    found = discover_cells(samples).withColumn("__copies", F.count(F.lit(1)).over(Window.partitionBy("cell_id")))
    unique = Guard(found, "discovered cells", {"a repeated cell id": F.col("__copies") > 1}, ["cell_id", "sample_id", "path"])
    files = samples.select("sample_id").distinct().join(unique.watched.withColumnRenamed("sample_id", "__sample"), F.col("sample_id") == F.col("__sample"), "left")
    present = Guard(files, "discovered cells", {"a sample without files": F.col("__sample").isNull()}, ["sample_id"])
    return present.watched.drop("__sample", "__copies"), [present, unique]


def duplicate_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell_id").agg(F.count("*").alias("copies")).where("copies > 1")


def parse_cov(lines: DataFrame) -> DataFrame:
    """Coverage rows of exactly six fields with ``start >= 1, end >= start, mc >= 0, uc >= 0``."""
    return _cov_fields(lines).where("problem is null").select("path", "chrom", "start", "end", "pct", "mc", "uc")


def cov_errors(lines: DataFrame) -> DataFrame:
    return _cov_fields(lines).where("problem is not null").select("path", "line", "problem")


def _cov_fields(lines: DataFrame) -> DataFrame:
    parts = F.split("line", "\t")
    number = lambda i, t: F.get(parts, F.lit(i)).try_cast(t)
    f = lines.withColumn("__n", F.size(parts)).select(
        "*", parts[0].alias("chrom"), number(1, "bigint").alias("start"), number(2, "bigint").alias("end"),
        number(3, "double").alias("pct"), number(4, "bigint").alias("mc"), number(5, "bigint").alias("uc"),
    )
    unreadable = F.col("start").isNull() | F.col("end").isNull() | F.col("mc").isNull() | F.col("uc").isNull()
    problem = (
        F.when(F.col("__n") != 6, "not 6 columns").when(unreadable, "non-integer field")
        .when(F.expr("start < 1 or end < start or mc < 0 or uc < 0"), "invalid coordinate or count")
    )
    return f.withColumn("problem", problem)


def read_cov(spark: SparkSession, paths, glob: str | None = None, *, on_error: str = "raise") -> DataFrame:
    """Coverage rows; a bad line stops the job, or is left out for :func:`cov_errors` with ``on_error="skip"``."""
    lines = read_lines(spark, paths, glob)
    if not _checked(on_error):
        return parse_cov(lines)
    f = _cov_fields(lines)
    return f.where(_refuse(F.col("problem").isNotNull(), F.col("problem"))).select("path", "chrom", "start", "end", "pct", "mc", "uc")


def cov_lines(sites: DataFrame) -> DataFrame:
    """Coverage projection: ``chrom, start, end, pct`` (six decimals), ``mc, uc``."""
    pct = F.format_string("%.6f", F.lit(100.0) * F.col("mc") / F.col("cov"))
    keep = [c for c in ("cell_id", "sample_id") if c in sites.columns]
    return sites.select(*keep, "chrom", F.col("pos").alias("start"), F.col("pos").alias("end"), pct.alias("pct"), "mc", (F.col("cov") - F.col("mc")).alias("uc"))


def write_cov(sites: DataFrame, path: str, by: str = "cell_id") -> None:
    """Gzipped TSV, one folder per cell, rows in coordinate order within it."""
    rows = cov_lines(sites).select(by, F.concat_ws("\t", "chrom", "start", "end", "pct", "mc", "uc").alias("value"), "chrom", "start")
    # a cell larger than one partition may be cut: range partitioning keeps its parts in order
    rows.repartitionByRange(by, "chrom", "start").sortWithinPartitions(by, "chrom", "start").select(by, "value").write.mode(
        "errorifexists").partitionBy(by).option("compression", "gzip").text(path)


def cov_to_allc(cov: DataFrame, context: str = "CGN") -> DataFrame:
    """ALLC columns of coverage rows: strand ``+``, one context, ``cov = mc + uc``, flag 1."""
    keep = [c for c in ("cell_id", "path") if c in cov.columns]
    return cov.select(
        *keep, "chrom", F.col("start").alias("pos"), F.lit("+").alias("strand"), F.lit(context).alias("context"),
        "mc", (F.col("mc") + F.col("uc")).alias("cov"), F.lit(1).alias("methylated"),
    )
