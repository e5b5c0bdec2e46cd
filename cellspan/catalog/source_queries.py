"""Queries that write the driver tables in the supported file forms and read them back."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.catalog.interval_queries import _COUNTS, region_counts
from cellspan.operators import preflight as P
from cellspan.plans.prefix import global_row_number
from cellspan.plans.storage import scratch_path, stored
from cellspan.sources import inventory as V
from cellspan.sources import matrix_files as MF
from cellspan.sources import site_files as SF
from cellspan.sources import tables as TB
from cellspan.sources.text import read_lines
from cellspan.streaming import region_counts as RC

add = registry.add


def _write_allc(t):
    """The site table as gzipped ALLC text, one folder per sample, with a header and comments mixed in."""
    path = scratch_path(t.spark, "allc")
    text = F.concat_ws("\t", "chrom", "pos", F.lit("+"), "context", "mc", "cov", F.lit(1))
    broken = F.when(F.col("cov") == 13, F.concat_ws("\t", "chrom", "pos", F.lit("+"), "context", "mc", F.lit("x"), F.lit(1)))
    broken = F.when(F.col("cov") == 17, F.concat_ws("\t", "chrom", "pos")).otherwise(broken)
    # a broken number in the first line of a file would pass as a header: keep those lines later
    lines = t.sites.select("sample_id", F.coalesce(broken, text).alias("value"), (F.col("cov") == 13).alias("late"))
    placed = lines.repartition("sample_id", F.substring("value", 1, 4)).sortWithinPartitions("sample_id", "late")
    placed.select("sample_id", "value").write.partitionBy("sample_id").option("compression", "gzip").text(path)
    return path


def _sample(path):
    return F.regexp_extract(path, "sample_id=([^/]+)", 1)


@add("s1_read_allc", duck("select sample_id, chrom, pos, '+' strand, context, mc, cov from sites where cov not in (13, 17)", "sites"))
def s1(t):
    sites = SF.read_allc(t.spark, _write_allc(t), "*.gz", on_error="skip")
    return sites.select(_sample("path").alias("sample_id"), "chrom", "pos", "strand", "context", "mc", "cov")


@add("s1_allc_errors", duck("""
select sample_id, case cov when 13 then 'non-integer field' else 'fewer than 6 columns' end problem, count(*) n from sites where cov in (13, 17) group by 1,2""", "sites"))
def s1_errors(t):
    errors = SF.allc_errors(read_lines(t.spark, _write_allc(t), "*.gz"))
    return errors.groupBy(_sample("path").alias("sample_id"), "problem").agg(F.count("*").alias("n"))


_NAME_TEXT = """case c_mktsegment when 'HOUSEHOLD' then concat('S', c_nationkey, '_') else '' end || c_name
 || case c_mktsegment when 'BUILDING' then '.allc.tsv.gz' when 'MACHINERY' then '_allc.gz' when 'FURNITURE' then '.allc.gz' else '.gz' end"""


@add("s2_cell_names", duck("""
select file_name, n "name", case when starts_with(n, 'S' || c_nationkey || '_') then n else 'S' || c_nationkey || '_' || n end cell_id, regexp_extract(file_name, '#(\\d+)', 1) by_group,
 regexp_extract(file_name, 'Customer#(\\d+)', 1) || '-x' by_template from (
 select *, regexp_replace(file_name, '(\\.allc\\.tsv\\.gz|_allc\\.gz|\\.allc\\.gz)$', '') n from names)""", ctes=f"names as (select {_NAME_TEXT} file_name, c_nationkey from customer)"))
def s2(t):
    name = SF.cell_name("file_name")
    return t.customer.select(F.expr(_NAME_TEXT).alias("file_name"), "c_nationkey").select(
        "file_name", name.alias("name"), SF.prefixed_cell_id(name, F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))).alias("cell_id"),
        SF.cell_name("file_name", r"#(?P<cell_id>\d+)").alias("by_group"), SF.cell_name("file_name", r"Customer#(?P<n_1>\d+)", r"\g<n_1>-x").alias("by_template"),
    )


@add("s2_discover_cells", duck("select distinct sample_id, sample_id || '_x' cell_id from sites", "sites"))
def s2_discover(t):
    path = scratch_path(t.spark, "cells")
    t.sites.select("sample_id", F.col("sample_id").alias("s"), F.concat_ws("\t", "chrom", "pos", F.lit("+"), "context", "mc", "cov").alias("value")).repartition("value").select("s", "value").write.partitionBy("s").option("compression", "gzip").text(path)
    rows = [(f"S{i}", f"{path}/s=S{i}", "**/*.gz", f"S{i}", r"part-.*\.gz", "x") for i in range(5)]
    samples = t.spark.createDataFrame(rows, "sample_id string, allc_root string, allc_glob string, cell_id_prefix string, allc_cell_id_regex string, allc_cell_id_replacement string")
    return SF.discover_cells(samples).select("sample_id", "cell_id").distinct()


@add("s4_write_read_cov", duck("""select sample_id, chrom, pos "start", pos "end", cast(printf('%.6f', 100.0*mc/cov) as double) pct, mc, cov-mc uc from cg""", "cg"))
def s4(t):
    path = scratch_path(t.spark, "cov")
    SF.write_cov(t.cg.drop("cell_id"), path, by="sample_id")
    back = SF.read_cov(t.spark, path, "*.gz")
    return back.select(_sample("path").alias("sample_id"), "chrom", "start", "end", "pct", "mc", "uc")


@add("s4_cov_projection", duck("""select cell_id, sample_id, chrom, pos "start", pos "end", printf('%.6f', 100.0*mc/cov) pct, mc, cov-mc uc from cg""", "cg"))
def s4_lines(t):
    return SF.cov_lines(t.cg)


@add("s3_cov_errors", duck("""
select problem, count(*) n from (select case when cov = 13 then 'not 6 columns' when cov = 17 then 'non-integer field' when pos <= 20 or mc < 5 then 'invalid coordinate or count' end problem from sites) where problem is not null group by 1""", "sites"))
def s3(t):
    path = scratch_path(t.spark, "cov-errors")
    good = F.concat_ws("\t", "chrom", F.col("pos") - 20, F.col("pos") - 20, F.lit("0.5"), F.col("mc") - 5, F.col("cov") - F.col("mc"))
    short = F.concat_ws("\t", "chrom", "pos")
    letters = F.concat_ws("\t", "chrom", "pos", "pos", F.lit("0.5"), F.lit("x"), F.lit("1"))
    t.sites.select(F.when(F.col("cov") == 13, short).when(F.col("cov") == 17, letters).otherwise(good).alias("value")).write.text(path)
    return SF.cov_errors(read_lines(t.spark, path, "*.txt")).groupBy("problem").agg(F.count("*").alias("n"))


@add("s5_cov_to_allc", duck("""select cell_id, chrom, pos, '+' strand, 'CHN' context, mc, cov, 1 methylated from cg""", "cg"))
def s5(t):
    return SF.cov_to_allc(SF.cov_lines(t.cg), "CHN")


@add("s6_read_10x_mtx", duck("""select 'L_' || cell_id cell_id, 'L' sample_id, gene, "count" from rna""", "rna"))
def s6(t):
    spark, path = t.store("rna").spark, scratch_path(t.spark, "mtx")
    genes = global_row_number(t.rna.select("gene").distinct(), [F.col("gene")], "g")
    cells = global_row_number(t.rna.select("cell_id").distinct(), [F.col("cell_id")], "c")
    genes.orderBy("g").select(F.concat_ws("\t", F.concat(F.lit("id"), "g"), "gene", F.lit("Gene Expression")).alias("value")).write.text(f"{path}/features.tsv")
    cells.orderBy("c").select(F.col("cell_id").alias("value")).write.text(f"{path}/barcodes.tsv")
    t.rna.join(genes, "gene").join(cells, "cell_id").select(F.concat_ws(" ", "g", "c", "count").alias("value")).write.text(f"{path}/matrix.mtx")
    sizes = [df.agg(F.count("*")).scalar() for df in (genes, cells, t.rna)]
    head = spark.range(1).select(F.concat(F.lit("%%MatrixMarket matrix coordinate integer general\n"), F.concat_ws(" ", *sizes)).alias("value"))
    head.coalesce(1).write.mode("append").text(f"{path}/matrix.mtx")
    return MF.read_10x_mtx(spark, path, "L")


@add("s9_read_bed", duck("""select chrom, "start", "end", peak_var, n_cpg, n_obs_cells, feature_id from regions""", "regions"))
def s9(t):
    path = scratch_path(t.spark, "bed")
    t.regions.select(F.concat_ws("\t", "chrom", "start", "end", "peak_var", "n_cpg", "n_obs_cells", "feature_id").alias("value")).unionByName(
        t.region.select(F.concat(F.lit("# "), "r_name").alias("value"))).write.text(path)
    return TB.read_bed(t.spark, path, "vmr7").drop("_corrupt")


@add("s9_bed_problems", duck("""
select chrom, "start" - 500 "start", "end" - 600 "end", case when "start" < 500 or "end" - 600 <= "start" - 500 then 'invalid_interval' else 'past_chromosome_end' end problem
from regions where "start" < 500 or "end" - 600 <= "start" - 500 or "end" - 600 > 10000""", "regions"))
def s9_problems(t):
    bed = t.regions.select("chrom", (F.col("start") - 500).alias("start"), (F.col("end") - 600).alias("end"))
    return TB.bed_problems(bed, t.chrom_order.withColumn("size", F.lit(10000)))


@add("s11_source_inventory", duck("select distinct sample_id cell_id, true has_size, sample_id = 'S0' changed from sites", "sites"))
def s11(t):
    files = SF.list_files(t.spark, _write_allc(t), "**/*.gz").withColumn("cell_id", _sample("path"))
    now = V.source_inventory(files)
    changed = V.inventory_changes(now.where("cell_id <> 'S0'"), now).select("cell_id").distinct().withColumn("c", F.lit(True))
    seen = now.groupBy("cell_id").agg(F.bool_and(F.col("size") > 0).alias("has_size"))
    return seen.join(changed, "cell_id", "left").select("cell_id", "has_size", F.coalesce("c", F.lit(False)).alias("changed"))


@add("s12_file_checksums")
def s12(t):
    folder = f"{t.sf_dir}/"
    sums = stored(V.file_checksums(t.spark, folder))
    declared = sums.select("path", F.upper("digest").alias("digest"))
    return sums.select(F.element_at(F.split("path", "/"), -1).alias("file"), "digest").withColumn("mismatches", V.checksum_mismatches(sums, declared).agg(F.count("*")).scalar())


@add("s13_matrix_store", duck("""select count(*) "values", (select count(*) from cells) cells, (select count(*) from regions) features from counts""", "cells", "cg", "regions", ctes=_COUNTS))
def s13(t):
    path = scratch_path(t.spark, "matrix")
    MF.save_matrix(region_counts(t), t.cells, t.regions, path)
    return MF.matrix_shape(t.spark, path)


_LINES = """
lines as (select c.sample_id path, row_number() over (partition by sample_id order by cell_id, chrom, pos, mc, cov) line_no, chrom, pos, context, mc, cov from sites c),
prev as (select *, lag(chrom) over w pc, lag(pos) over w pp from lines window w as (partition by path order by line_no)),
brk as (select path, chrom, count(*) filter (chrom = pc and pos < pp) unsorted, count(*) filter (pc is null or pc <> chrom) blocks from prev group by 1,2)"""


def _lines(t):
    order = [F.col(c) for c in ("cell_id", "chrom", "pos", "mc", "cov")]
    return global_row_number(t.sites, order, "line_no", ["sample_id"]).withColumnRenamed("sample_id", "path")


@add("w4_sorted_site_check", duck("select * from brk where unsorted > 0 or blocks > 1", "sites", ctes=_LINES))
def w4(t):
    return P.sorted_site_check(_lines(t))


@add("w4_order_summaries", duck("select * from brk where unsorted > 0 or blocks > 1", "sites", ctes=_LINES))
def w4_summaries(t):
    # the lines as text files: a folder a path, of files whose numbers follow the lines, so that no task holds a whole path
    folder = scratch_path(t.spark, "site-lines")
    text = F.concat_ws("\t", "chrom", "pos").alias("value")
    lines = _lines(t).repartitionByRange("path", "line_no").sortWithinPartitions("path", "line_no")
    lines.select("path", text).write.partitionBy("path").text(folder)
    parts = F.split("line", "\t")
    # a file's number goes before the place in it; a terabyte a file leaves room for eight million
    block = F.regexp_extract("path", r"/part-(\d+)-", 1).cast("bigint") * F.lit(1 << 40) + F.col("__block")
    lines = read_lines(t.spark, folder).select(
        F.regexp_extract("path", "/path=([^/]+)/", 1).alias("path"), block.alias("__block"), parts[0].alias("chrom"), parts[1].cast("bigint").alias("pos"))
    return P.stitched_site_check(P.order_summaries(lines))


@add("q1_preflight_full", duck("""
select path, count(*) records_checked, count(*) filter (not (pos>=1 and mc>=0 and cov>=0 and mc<=cov)) invalid_records, bool_or(context like 'CG%') saw_context,
 cast((select sum(unsorted + blocks - 1) from brk where brk.path = lines.path and (unsorted > 0 or blocks > 1)) as bigint) order_breaks, 'full' mode, 'not coordinate sorted' problem from lines group by path""", "sites", ctes=_LINES))
def q1_full(t):
    return P.preflight_sites(_lines(t), "CGN", "full")


@add("q1_preflight_quick", duck("""
select path, count(*) records_checked, 0::bigint invalid_records, bool_or(context like 'CH%') saw_context, 0::bigint order_breaks, 'quick' mode, null::varchar problem
from lines join (select path, min(line_no) filter (context like 'CH%') f from lines group by 1) using (path) where f is null or line_no <= greatest(f, 2) group by path""", "sites", ctes=_LINES))
def q1_quick(t):
    return P.preflight_sites(_lines(t), "CHN", "quick", 2)


@add("t1_stream_region_counts", duck("select * from counts", "cg", "regions", ctes=_COUNTS))
def t1(t):
    source, out = scratch_path(t.spark, "stream-in"), scratch_path(t.spark, "stream-out")
    # a cell lives in exactly one file, as in the per-cell input
    t.sites.repartition(6, "cell_id").write.parquet(source)
    t.__dict__["sites"] = t.spark.read.parquet(source)
    sites = t.spark.readStream.schema(t.sites.schema).option("maxFilesPerTrigger", 2).parquet(source)
    RC.stream_region_counts(sites, t.store("regions").regions, out).awaitTermination()
    return RC.read_region_counts(t.spark, out)
