"""Queries over differential-region rows and region-by-cell values."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.operators import intervals as I
from cellspan.operators import regions as R
from cellspan.operators import sites as S

add = registry.add

_HYPO = """
hypo_rows as (select *, abs(meth_a-meth_b) abs_diff, case low_group when 'group_A' then cell_type_a else cell_type_b end hypo,
 case low_group when 'group_A' then cell_type_b else cell_type_a end other from dmr where raw_p < 0.01 and abs(meth_a-meth_b) >= 0.25)"""
_BEST = _HYPO + """,
best as (select sample_id, hypo, chrom, "start", "end", abs_diff, raw_p, other from (
 select *, row_number() over (partition by sample_id, hypo, chrom, "start", "end" order by abs_diff desc, raw_p, other) k from hypo_rows) where k = 1)"""
_TOP = _BEST + """,
top as (select * from (select b.*, row_number() over (partition by sample_id, hypo order by abs_diff desc, raw_p, "rank", "start", "end") label_rank
 from best b join chrom_order using (chrom)) where label_rank <= 20)"""
_MERGED = _TOP + """,
mi as (select *, sum(case when m is null or "start" >= m then 1 else 0 end) over (partition by sample_id, chrom order by "start", "end", hypo rows unbounded preceding) g from (
 select *, max("end") over (partition by sample_id, chrom order by "start", "end", hypo rows between unbounded preceding and 1 preceding) m from top)),
merged as (select sample_id, chrom, min("start") "start", max("end") "end", list_sort(list_distinct(list(hypo))) labels from mi group by sample_id, chrom, g),
feat as (select *, sample_id || '__merged_hypo_DMR_' || lpad(cast(row_number() over (partition by sample_id order by "rank", "start", "end") as varchar), 6, '0') feature_id
 from merged join chrom_order using (chrom))"""
_MATRIX = _MERGED + """,
site_ratio as (select cell_id, sample_id, chrom, pos, sum(mc)/sum(cov) r from cg group by 1,2,3,4),
matrix as (select s.cell_id, f.feature_id, avg(r) value, count(*) n_sites from site_ratio s join feat f
 on s.chrom=f.chrom and s.sample_id=f.sample_id and s.pos >= f."start" and s.pos < f."end" group by 1,2)"""
_NEEDS = ("dmr", "chrom_order")
_MNEEDS = ("dmr", "chrom_order", "cg", "cells")


def hypo_rows(t):
    return R.hypo_label(R.dmr_threshold(t.dmr))


def top(t):
    return R.top_n_per_label(R.best_per_interval(hypo_rows(t)), t.chrom_order, 20)


def merged(t):
    m = I.merge_overlapping(top(t), ["sample_id"], label="hypo")
    return I.number_features(m, t.chrom_order, "{sample_id}__merged_hypo_DMR_%06d", ["sample_id"])


def matrix(t, features):
    # regions belong to one sample: key the sample into the chromosome so that only its cells match
    tag = F.concat_ws("|", "sample_id", "chrom").alias("chrom")
    cells = S.context_filter(t.sites).select("cell_id", tag, "pos", "mc", "cov")
    return R.region_mean_of_site_ratios(cells, features.select(tag, "start", "end", "feature_id"))


@add("p11_dmr_threshold", duck("""select sample_id, comparison, chrom, "start", "end", round(abs_diff, 6) abs_diff, raw_p from hypo_rows""", "dmr", ctes=_HYPO))
def p11(t):
    return R.dmr_threshold(t.dmr).select("sample_id", "comparison", "chrom", "start", "end", F.round("abs_diff", 6).alias("abs_diff"), "raw_p")


@add("p12_hypo_label", duck("""select hypo, other, count(*) n, round(avg(abs_diff), 6) d from hypo_rows group by 1,2""", "dmr", ctes=_HYPO))
def p12(t):
    return hypo_rows(t).groupBy("hypo", "other").agg(F.count("*").alias("n"), F.round(F.avg("abs_diff"), 6).alias("d"))


@add("w1_best_per_interval", duck("""select * replace (round(abs_diff, 6) as abs_diff) from best""", "dmr", ctes=_BEST))
def w1(t):
    return R.best_per_interval(hypo_rows(t)).withColumn("abs_diff", F.round("abs_diff", 6))


@add("w1_best_pooled", duck("""select hypo, chrom, "start", "end", round(abs_diff, 6) abs_diff, raw_p, comparison from (
 select *, row_number() over (partition by hypo, chrom, "start", "end" order by abs_diff desc, raw_p, comparison) k from hypo_rows) where k = 1""", "dmr", ctes=_HYPO))
def w1_pooled(t):
    return R.best_per_interval(hypo_rows(t), pooled=True).withColumn("abs_diff", F.round("abs_diff", 6))


@add("w2_top_n_per_label", duck("""select * replace (round(abs_diff, 6) as abs_diff) from top""", *_NEEDS, ctes=_TOP))
def w2(t):
    return top(t).withColumn("abs_diff", F.round("abs_diff", 6))


@add("w2_merged_top_regions", duck("""select sample_id, chrom, "start", "end", feature_id, array_to_string(labels, ',') labels from feat""", *_NEEDS, ctes=_MERGED))
def w2_merged(t):
    return merged(t).select("sample_id", "chrom", "start", "end", "feature_id", F.array_join("labels", ",").alias("labels"))


@add("a2_region_mean_of_site_ratios", duck("""select cell_id, feature_id, round(value, 6) "value", n_sites from matrix""", *_MNEEDS, ctes=_MATRIX))
def a2(t):
    return matrix(t, merged(t)).withColumn("value", F.round("value", 6))


@add("w12_region_zscore", duck("""
select cell_id, feature_id, round("value", 6) "value", n_sites, n observed_cells, round(case when n >= 12 and sd > 1e-9 then greatest(-2.0, least(2.0, ("value"-m)/sd)) end, 5) z from (
 select *, avg("value") over w m, stddev_pop("value") over w sd, count(*) over w n from matrix window w as (partition by feature_id))""", *_MNEEDS, ctes=_MATRIX))
def w12(t):
    z = R.region_zscore(matrix(t, merged(t)), min_observed=12, clip_at=2.0)
    return z.withColumn("value", F.round("value", 6)).withColumn("z", F.round("z", 5))


@add("w12_zscore_qc", duck("""select feature_id, count(*) observed_cells, count(*) >= 12 and stddev_pop("value") > 0 eligible from matrix group by 1""", *_MNEEDS, ctes=_MATRIX))
def w12_qc(t):
    return R.zscore_qc(matrix(t, merged(t)), min_observed=12)


_OWN = _MATRIX + """,
lm as (select feature_id, cell_type, avg("value") m from matrix join cells using (cell_id) group by 1,2),
own as (select feature_id, own_label, m own_mean from (
 select feature_id, l own_label, m, row_number() over (partition by feature_id order by m is null, m, l) k
 from (select feature_id, unnest(labels) l from feat) u left join lm using (feature_id) where lm.cell_type = u.l or lm.cell_type is null
) where k = 1)"""
_OWN = _OWN.replace("left join lm using (feature_id) where lm.cell_type = u.l or lm.cell_type is null", "left join lm on lm.feature_id=u.feature_id and lm.cell_type = u.l").replace("select feature_id, l own_label, m, row_number() over (partition by feature_id", "select u.feature_id, l own_label, m, row_number() over (partition by u.feature_id")


@add("a19_own_label_for_region", duck("select feature_id, own_label, round(own_mean, 6) own_mean from own", *_MNEEDS, ctes=_OWN))
def a19(t):
    m = merged(t)
    return R.own_label_for_region(matrix(t, m), t.cells, m).withColumn("own_mean", F.round("own_mean", 6))


def _axes(t):
    m = merged(t)
    return m, R.own_label_for_region(matrix(t, m), t.cells, m)


@add("o3_heatmap_cell_order", duck("select cell_id, cell_type, row_number() over (order by cell_type, cell_id) position from cells where cell_type in (select own_label from own)", *_MNEEDS, ctes=_OWN))
def o3_cells(t):
    _, own = _axes(t)
    return R.heatmap_cell_order(t.cells, own)


_AXIS = _OWN + """,
axis as (select chrom, "start", "end", f.feature_id, own_label, row_number() over (order by own_label, "rank", "start", "end", f.feature_id) position from feat f join own using (feature_id))"""


@add("o3_heatmap_region_order", duck("select * from axis", *_MNEEDS, ctes=_AXIS))
def o3_regions(t):
    m, own = _axes(t)
    return R.heatmap_region_order(m, own, t.chrom_order)


@add("w13_contiguous_groups", duck("""
select min(position) run_start, max(position) run_end, first(chrom) "label", (min(position)+max(position))/2 center from (
 select position, chrom, position - row_number() over (partition by own_label, chrom order by position) g, own_label from axis) group by own_label, chrom, g""", *_MNEEDS, ctes=_AXIS))
def w13(t):
    m, own = _axes(t)
    return R.contiguous_groups(R.heatmap_region_order(m, own, t.chrom_order).withColumn("l", F.concat_ws("|", "own_label", "chrom")), "l").withColumn("label", F.split("label", r"\|")[1])


_STATUS = """
status as (select sample_id, comparison, case when min(raw_p) > 0.0005 then 'ineligible' when max(raw_p) > 0.0198 then 'known_fdr_zero_failure' else 'complete' end status,
 sample_id || '/' || comparison || '.bed' dmr_file from dmr group by 1,2)"""


def comparison_status(t):
    status = F.when(F.min("raw_p") > 0.0005, "ineligible").when(F.max("raw_p") > 0.0198, "known_fdr_zero_failure").otherwise("complete")
    return t.dmr.groupBy("sample_id", "comparison").agg(status.alias("status")).withColumn("dmr_file", F.concat("sample_id", F.lit("/"), "comparison", F.lit(".bed")))


@add("j13_resolve_comparisons", duck("""select sample_id, comparison, status, case status when 'complete' then dmr_file else 'raw/' || dmr_file end dmr_file from status where status <> 'ineligible'""", "dmr", ctes=_STATUS))
def j13(t):
    status = comparison_status(t)
    fallback = status.where("status = 'known_fdr_zero_failure'").withColumn("dmr_file", F.concat(F.lit("raw/"), "dmr_file"))
    return R.resolve_comparisons(status, fallback)


@add("a13_pairwise_rollup", duck("""
select count(*) comparisons, count(*) filter (status='complete') completed, count(*) filter (status='ineligible') ineligible, 0::bigint failed,
 count(*) filter (status='known_fdr_zero_failure') fallback_needed, case when count(*) filter (status='known_fdr_zero_failure') = 0 then 'complete' else 'complete_with_fallback_needed' end status from status""", "dmr", ctes=_STATUS))
def a13(t):
    return R.pairwise_rollup(comparison_status(t))


@add("w5_adjacent_duplicates", duck("select cell_id, chrom, pos, count(*) copies from sites group by 1,2,3 having count(*) > 1", "sites"))
def w5(t):
    return R.adjacent_duplicates(t.sites)
