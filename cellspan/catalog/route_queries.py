"""Whole routes over the driver tables."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.catalog.methylation_queries import _CONTRAST, _MERGED, _RESID
from cellspan.plans import routes

add = registry.add

_FEATURE = """
kept as (select chrom, "start", "end", peak_var, n_cpg, n_obs_cells, 'VMR_' || lpad(cast(row_number() over (order by "rank", "start", "end") as varchar), 6, '0') feature_id
 from regions r join chrom_order using (chrom) where not exists (select 1 from blacklist b where b.chrom=r.chrom and (least(r."end", b."end") - greatest(r."start", b."start"))::double / (r."end"-r."start") >= 0.2)),
counts as (select s.cell_id, r.feature_id, cast(sum(mc) as bigint) mc, cast(sum(cov) as bigint) cov from cg s join kept r on s.chrom=r.chrom and s.pos-1 >= r."start" and s.pos-1 < r."end" group by 1,2 having sum(cov) > 0),
cover as (select r.*, coalesce(n, 0) covered_cells from kept r left join (select feature_id, count(*) n from counts group by 1) using (feature_id)),
cut as (select greatest((select cast(ceil(count(distinct cell_id) * 0.5 / 100) as bigint) from cells), (select min(covered_cells) from (select covered_cells from cover order by covered_cells desc limit 25))) c),
sel as (select * from (select *, row_number() over (order by peak_var desc, n_obs_cells desc, n_cpg desc, feature_id) selection_rank from cover where covered_cells >= (select c from cut)) where selection_rank <= 25)"""


@add("route_feature_matrix", duck("select * from counts where feature_id in (select feature_id from sel)", "cells", "cg", "regions", "blacklist", "chrom_order", ctes=_FEATURE))
def feature_matrix(t):
    out = routes.feature_matrix(t.sites, t.regions.drop("feature_id"), t.chrom_order, t.blacklist, t.cells, t.annotation, n=25, floor_percent=0.5, exact=False)
    return out.counts


_ROUTE = """
passed as (select cell_id from cg group by cell_id having count(*) >= 15 and 100.0*avg(case when mc*2 >= cov then 1 else 0 end) between 60 and 95),
good as (select * from cg where cell_id in (select cell_id from passed)),
calls as (select cell_id, sample_id, cell_type, chrom, pos, case when mc*2 >= cov then 1 else 0 end call from good),""" + _RESID + _CONTRAST + _MERGED + """,
hypo_rows as (select sample_id, chrom, "start", "end", abs(k.ma - k.mb) abs_diff, k.p raw_p, case low_group when 'group_A' then cell_type_a else cell_type_b end hypo,
 case low_group when 'group_A' then cell_type_b else cell_type_a end other from dmrs where k.p < 0.1 and abs(k.ma - k.mb) >= 0.1),
best as (select * from (select *, row_number() over (partition by sample_id, hypo, chrom, "start", "end" order by abs_diff desc, raw_p, other) kk from hypo_rows) where kk = 1),
top as (select * from (select b.*, row_number() over (partition by sample_id, hypo order by abs_diff desc, raw_p, "rank", "start", "end") label_rank from best b join chrom_order using (chrom)) where label_rank <= 5),
mi as (select *, sum(case when m is null or "start" >= m then 1 else 0 end) over (partition by sample_id, chrom order by "start", "end", hypo rows unbounded preceding) g from (
 select *, max("end") over (partition by sample_id, chrom order by "start", "end", hypo rows between unbounded preceding and 1 preceding) m from top)),
feat as (select *, sample_id || '__merged_hypo_DMR_' || lpad(cast(row_number() over (partition by sample_id order by "rank", "start", "end") as varchar), 6, '0') feature_id
 from (select sample_id, chrom, min("start") "start", max("end") "end" from mi group by sample_id, chrom, g) join chrom_order using (chrom)),
matrix as (select s.cell_id, f.feature_id, avg(r) "value", count(*) n_sites from (select cell_id, sample_id, chrom, pos, sum(mc)/sum(cov) r from good group by 1,2,3,4) s join feat f
 on s.chrom=f.chrom and s.sample_id=f.sample_id and s.pos >= f."start" and s.pos < f."end" group by 1,2)"""


@add("route_differential_matrix", duck("""
select cell_id, feature_id, round("value", 6) "value", n_sites, n observed_cells, round(case when n >= 12 and sd > 1e-9 then ("value"-m)/sd end, 4) z from (
 select *, avg("value") over w m, stddev_pop("value") over w sd, count(*) over w n from matrix window w as (partition by feature_id))""", "cg", "chrom_order", ctes=_ROUTE))
def differential_matrix(t):
    t.store("sites")
    out = routes.differential_matrix(
        t.sites, t.cells, t.chrom_order, round_sites=True, step=500, threshold=0.1, max_raw_p=0.1, min_abs_diff=0.1, top=5, min_observed=12,
        cell_filter={"min_sites": 15, "min_pct": 60, "max_pct": 95},
    )
    return out.matrix.withColumn("value", F.round("value", 6)).withColumn("z", F.round("z", 4))


@add("route_expression_clusters")
def expression_clusters(t):
    clusters, _ = routes.expression_clusters(
        t.rna, qc={"min_genes": 20, "max_genes": 100, "min_counts": 300, "max_mt": 20}, genes=60, components=10, iterations=5, correct_batches=False, markers=False,
    )
    return clusters
