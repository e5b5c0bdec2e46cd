"""Queries over site records."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.operators import sites as S
from cellspan.plans.guards import checked

add = registry.add


@add("p1_context_wildcard", duck("select context, chrom, count(*) n, cast(sum(cov) as bigint) cov from sites where upper(context) like 'CG%' group by 1,2", "sites"))
def p1_wildcard(t):
    return S.context_filter(t.sites, "CGN").groupBy("context", "chrom").agg(F.count("*").alias("n"), F.sum("cov").alias("cov"))


@add("p1_context_dinucleotide", duck("""
select cell_id, count(*) n from sites where left(upper(context), 2) = 'CH' group by 1""", "sites"))
def p1_dinucleotide(t):
    return S.context_filter(t.sites, "CHG", "dinucleotide").groupBy("cell_id").agg(F.count("*").alias("n"))


_SHIFTED = "shifted as (select cell_id, chrom, pos - 3 pos, mc - 1 mc, cov - 2 cov from sites)"


def _shifted(t):
    # shifted counts make every rule reject something
    return t.sites.select("cell_id", "chrom", (F.col("pos") - 3).alias("pos"), (F.col("mc") - 1).alias("mc"), (F.col("cov") - 2).alias("cov"))


@add("p2_valid_sites", duck("""
select 'convert' rule, count(*) filter (pos>=1 and mc>=0 and cov>0 and mc<=cov) valid, count(*) filter (not (pos>=1 and mc>=0 and cov>0 and mc<=cov)) invalid from shifted
union all select 'preflight', count(*) filter (pos>=1 and mc>=0 and cov>=0 and mc<=cov), count(*) filter (not (pos>=1 and mc>=0 and cov>=0 and mc<=cov)) from shifted
union all select 'count', count(*) filter (pos>=1 and mc>=0 and cov>=mc), count(*) filter (not (pos>=1 and mc>=0 and cov>=mc)) from shifted
""", "sites", ctes=_SHIFTED))
def p2(t):
    return S.rule_counts(_shifted(t), ("convert", "preflight", "count"))


@add("p3_coverage_projection", duck("select cell_id, chrom, pos, mc, cov, cov - mc uc, round(100.0*mc/cov, 6) pct from cg", "cg"))
def p3(t):
    cg = S.context_filter(t.sites).select("cell_id", "chrom", "pos", "mc", "cov")
    return S.coverage_projection(cg).withColumn("pct", F.round("pct", 6))


@add("p14_binary_calls", duck("""
select cell_id, chrom, pos, cast(case when mc > 0 then 1 else 0 end as bigint) call from cg where mc = 0 or mc = cov""", "cg"))
def p14(t):
    return S.binary_calls(S.context_filter(t.sites)).select("cell_id", "chrom", "pos", "call")


@add("p14_binary_calls_rounded", duck("""
select cell_id, count(*) n, cast(sum(case when mc*2 >= cov then 1 else 0 end) as bigint) meth from cg group by 1""", "cg"))
def p14_rounded(t):
    calls = S.binary_calls(S.context_filter(t.sites), round_sites=True)
    return calls.groupBy("cell_id").agg(F.count("*").alias("n"), F.sum("call").alias("meth"))


@add("a1_cell_site_qc", duck("""
select cell_id, covered_sites, methylated_reads, total_reads, unmixed_sites, unmixed_methylated,
 round(methylated_reads/total_reads, 6) mcg, round(unmixed_methylated/nullif(unmixed_sites,0), 6) unmixed_fraction from (
select cell_id, count(*) covered_sites, cast(sum(mc) as bigint) methylated_reads, cast(sum(cov) as bigint) total_reads,
 count(*) filter (mc=0 or mc=cov) unmixed_sites, count(*) filter ((mc=0 or mc=cov) and mc>0) unmixed_methylated
from cg group by 1)""", "cg"))
def a1(t):
    qc = S.cell_site_qc(S.context_filter(t.sites))
    return qc.withColumn("mcg", F.round("mcg", 6)).withColumn("unmixed_fraction", F.round("unmixed_fraction", 6))


@add("a1_guarded_cell_site_qc", duck("""
select cell_id, count(*) covered_sites, cast(sum(mc) as bigint) methylated_reads, cast(sum(cov) as bigint) total_reads from sites
where pos >= 1 and mc >= 0 and cov > 0 and mc <= cov group by 1""", "sites"))
def a1_guarded(t):
    valid = S.guarded_sites(t.sites, "convert")
    qc = S.guarded_cell_site_qc(valid.watched, t.cells)
    return checked(qc.watched, valid, qc).select("cell_id", "covered_sites", "methylated_reads", "total_reads")


@add("a1_cells_without_sites", duck("""
select 'S' || cast(c_nationkey % 5 as varchar) || '_' || cast(c_custkey as varchar) cell_id from customer
where 'S' || cast(c_nationkey % 5 as varchar) || '_' || cast(c_custkey as varchar) not in (select cell_id from cg where mc = cov)""", "cg"))
def a1_missing(t):
    cells = t.customer.select(F.concat(F.lit("S"), (F.col("c_nationkey") % 5).cast("string"), F.lit("_"), F.col("c_custkey").cast("string")).alias("cell_id"))
    return S.cells_without_sites(cells, S.context_filter(t.sites).where("mc = cov"))
