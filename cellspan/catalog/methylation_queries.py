"""Queries for smoothing, scanning, contrasts and hypomethylation scores."""

import uuid

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.operators import cells as K
from cellspan.operators import features as FT
from cellspan.operators import intervals as I
from cellspan.operators import methylation as M
from cellspan.operators import sites as S
from cellspan.plans.storage import cut_lineage

add = registry.add

_CALL = """
calls as (select cell_id, sample_id, cell_type, chrom, pos, case when mc*2 >= cov then 1 else 0 end call from cg),"""
_RESID = """
per_pos as (select chrom, pos, count(*) n, cast(sum(call) as bigint) meth from calls group by 1,2),
smooth as (select a.chrom, a.pos, a.n, a.meth, sum(k*b.meth)/sum(k*b.n) smoothed from (
 select *, 1 - power(abs(a_pos - b_pos)/1000.0, 3) u, u*u*u k from (select chrom, pos a_pos from per_pos) x join (select chrom bc, pos b_pos, n bn, meth bm from per_pos) y
 on x.chrom = y.bc and abs(a_pos - b_pos) < 1000) z join per_pos a on a.chrom=z.chrom and a.pos=z.a_pos join per_pos b on b.chrom=z.chrom and b.pos=z.b_pos group by 1,2,3,4),
resid as (select c.*, c.call - s.smoothed r from calls c join smooth s using (chrom, pos))"""
_CALLS = _CALL + _RESID


def calls(t):
    return S.binary_calls(S.context_filter(t.sites), round_sites=True)


def residuals(t):
    # the calls are read for the positions' sums and again for the residuals, and the sites for the cells
    t.store("sites")
    return M.tile_residuals(M.tile_calls(calls(t)))


@add("m1_smooth_methylation", duck("select chrom, pos, n, meth, round(smoothed, 6) smoothed from smooth", "cg", ctes=_CALLS))
def m1(t):
    return M.smooth_methylation(calls(t)).withColumn("smoothed", F.round("smoothed", 6))


@add("m2_call_residuals", duck("select cell_id, chrom, pos, call, count(*) copies, round(r, 6) residual from resid group by all", "cg", ctes=_CALLS))
def m2_residuals(t):
    c = calls(t)
    out = M.call_residuals(c, M.smooth_methylation(c))
    return out.withColumn("residual", F.round("residual", 6)).groupBy("cell_id", "chrom", "pos", F.col("call").cast("int").alias("call"), "residual").agg(F.count("*").alias("copies"))


@add("m2_tile_residuals", duck("select cell_id, chrom, pos, call, count(*) copies, round(r, 6) residual from resid group by all", "cg", ctes=_CALLS))
def m2_tiles(t):
    c = calls(t.store("sites"))
    tiles = M.save_tiles(M.tile_calls(c, tile=4_000), table := "tiles_" + uuid.uuid4().hex, M.tile_buckets(c, 8))
    try:
        out = M.own_residuals(M.tile_residuals(tiles, tile=4_000, broadcast_rows=0)).withColumn("residual", F.round("residual", 6))
        return cut_lineage(out.groupBy("cell_id", "chrom", "pos", F.col("call").cast("int").alias("call"), "residual").agg(F.count("*").alias("copies")))
    finally:
        t.spark.sql(f"drop table {table}")


@add("m2_shrunken_residuals", duck("""
select cell_id, feature_id, cast(sum(call) as bigint) methylated_sites, count(*) total_sites, round(avg(call), 6) methylation_fraction, round(sum(r)/(count(*)+1), 6) shrunken_residual
from resid c join regions g on c.chrom=g.chrom and c.pos-1 >= g."start" and c.pos-1 < g."end" group by 1,2""", "cg", "regions", ctes=_CALLS))
def m2(t):
    c = calls(t)
    out = M.shrunken_residuals(M.call_residuals(c, M.smooth_methylation(c)), t.regions)
    return out.withColumn("methylation_fraction", F.round("methylation_fraction", 6)).withColumn("shrunken_residual", F.round("shrunken_residual", 6))


_SCAN = _CALLS + """,
pane as (select cell_id, sample_id, cell_type, chrom, (pos-1)//500 p, count(*) n, sum(call) meth, sum(r) r from resid group by all),
cw as (select cell_id, chrom, w, sum(r)/(sum(n)+1) v from (select *, unnest(generate_series(greatest(p-3, 0), p)) w from pane) group by all),
wv as (select chrom, w*500 "start", w*500+2000 "end", round(var_pop(v), 9) variance, count(*) n_cells from cw group by chrom, w having count(*) >= 6)"""


@add("m3_window_variance", duck("select * replace (round(variance, 6) as variance) from wv", "cg", ctes=_SCAN))
def m3_windows(t):
    return M.window_variance(residuals(t), bandwidth=2000, step=500).withColumn("variance", F.round("variance", 6))


@add("m3_scan_variable_regions", duck("""
select chrom, "start", "end", round(peak_var, 6) peak_var, n_cpg, n_obs_cells from (select m.chrom, m."start", m."end", peak_var, count(distinct c.pos) n_cpg, count(distinct c.cell_id) n_obs_cells
from (select chrom, min("start") "start", max("end") "end", max(variance) peak_var from (
 select *, sum(case when m is null or "start" >= m then 1 else 0 end) over (partition by chrom order by "start" rows unbounded preceding) g from (
 select *, max("end") over (partition by chrom order by "start" rows between unbounded preceding and 1 preceding) m from wv
  where variance >= (select round(quantile_cont(variance, 0.8), 9) from wv))) group by chrom, g) m
 join calls c on c.chrom=m.chrom and c.pos-1 >= m."start" and c.pos-1 < m."end" group by 1,2,3,4)""", "cg", ctes=_SCAN))
def m3(t):
    rows = residuals(t)
    out = M.scan_variable_regions(rows, bandwidth=2000, step=500, top=0.2, calls=calls(t))
    return out.withColumn("peak_var", F.round("peak_var", 6))


_CONTRAST = """,
pane as (select cell_id, sample_id, cell_type, chrom, (pos-1)//500 p, count(*) n, sum(call) meth, sum(r) r from resid group by all),
cw as (select cell_id, sample_id, cell_type, chrom, w, sum(n) n, sum(meth) meth, sum(r)/(sum(n)+1) v from (select *, unnest(generate_series(greatest(p-3, 0), p)) w from pane) group by all),
lw as (select sample_id, cell_type, chrom, w, count(*)::double n, sum(v) s, sum(v*v) q, sum(meth) k, sum(n) c from cw group by all having count(*) >= 6),
va as (select *, greatest(q - s*s/n, 0)/(n-1)/n v from lw),
co as (select a.sample_id, a.cell_type cell_type_a, b.cell_type cell_type_b, a.chrom, a.w*500 "start", a.w*500+2000 "end", (a.s/a.n - b.s/b.n)/sqrt(a.v+b.v) t,
 (a.v+b.v)*(a.v+b.v)/(a.v*a.v/(a.n-1) + b.v*b.v/(b.n-1)) df, cast(a.c + b.c as bigint) n_sites, cast(a.n as bigint) n_a, cast(b.n as bigint) n_b, a.k/a.c meth_a, b.k/b.c meth_b
 from va a join va b on a.sample_id=b.sample_id and a.chrom=b.chrom and a.w=b.w and a.cell_type < b.cell_type where a.v+b.v > 0),
cz as (select *, (8*df+1)/(8*df+3)*sqrt(df*ln(1+t*t/df))/sqrt(2) x, 1/(1+0.3275911*x) k from co),
contrast as (select *, case when t < 0 then 'group_A' else 'group_B' end low_group, greatest(0, least(1,
 k*(0.254829592 + k*(-0.284496736 + k*(1.421413741 + k*(-1.453152027 + k*1.061405429))))*exp(-x*x))) raw_p from cz)"""
_DIFF = _CALLS + _CONTRAST


def contrasts(t):
    rows = residuals(t)
    windows = M.label_windows(rows, t.cells, bandwidth=2000, step=500)
    return M.compare_windows(windows, bandwidth=2000, step=500)


@add("m4_window_contrasts", duck("""
select sample_id, cell_type_a, cell_type_b, chrom, "start", "end", round(t, 5) t_stat, n_sites, n_a, n_b, round(meth_a, 6) meth_a, round(meth_b, 6) meth_b, low_group, round(raw_p, 5) raw_p from contrast""", "cg", ctes=_DIFF))
def m4_windows(t):
    rounded = {"t_stat": 5, "meth_a": 6, "meth_b": 6, "raw_p": 5}
    out = contrasts(t)
    for c, d in rounded.items():
        out = out.withColumn(c, F.round(c, d))
    return out


_MERGED = """,
hit as (select * from (select *, round(abs(t), 9) abt, quantile_cont(round(abs(t), 9), 0.9) over (partition by sample_id, cell_type_a, cell_type_b) cut from contrast) where abt >= round(cut, 9)),
isl as (select *, sum(case when m is null or "start" >= m then 1 else 0 end) over (partition by sample_id, cell_type_a, cell_type_b, low_group, chrom order by "start" rows unbounded preceding) g from (
 select *, max("end") over (partition by sample_id, cell_type_a, cell_type_b, low_group, chrom order by "start" rows between unbounded preceding and 1 preceding) m from hit)),
dmrs as (select sample_id, cell_type_a, cell_type_b, low_group, chrom, min("start") "start", max("end") "end",
 first({'t': t, 'ns': n_sites, 'na': n_a, 'nb': n_b, 'ma': meth_a, 'mb': meth_b, 'p': raw_p} order by abt desc, "start") k from isl group by sample_id, cell_type_a, cell_type_b, low_group, chrom, g)"""
_DMRS = _DIFF + _MERGED


@add("m4_diff_methylation", duck("""
select sample_id, cell_type_a, cell_type_b, chrom, "start", "end", round(k.t, 5) t_stat, k.ns n_sites, k.na n_a, k.nb n_b, round(k.ma, 6) meth_a, round(k.mb, 6) meth_b, low_group,
 round(k.p, 5) raw_p, null::double adj_p from dmrs""", "cg", ctes=_DMRS))
def m4(t):
    out = M.diff_methylation(contrasts(t), threshold=0.1)
    for c, d in {"t_stat": 5, "meth_a": 6, "meth_b": 6, "raw_p": 5}.items():
        out = out.withColumn(c, F.round(c, d))
    return out


# real and permuted labels side by side; permuted windows face the cut of the real ones
_FDR = _CALLS + """,
permuted as (select d.cell_id, d.sample_id, i.cell_type from (select cell_id, sample_id, row_number() over (partition by sample_id order by md5(cell_id || '|3'), cell_id) k from cells) d
 join (select sample_id, cell_type, row_number() over (partition by sample_id order by cell_id) k from cells) i on i.sample_id=d.sample_id and i.k=d.k),
labelled as (select cell_id, sample_id, cell_type, true is_real from cells union all select cell_id, sample_id, cell_type, false from permuted),
pane as (select cell_id, chrom, (pos-1)//500 p, count(*) n, sum(call) meth, sum(r) r from resid group by all),
cw as (select cell_id, chrom, w, sum(n) n, sum(meth) meth, sum(r)/(sum(n)+1) v from (select *, unnest(generate_series(greatest(p-3, 0), p)) w from pane) group by all),
lw as (select is_real, sample_id, cell_type, chrom, w, count(*)::double n, sum(v) s, sum(v*v) q, sum(meth) k, sum(n) c from cw join labelled using (cell_id) group by all having count(*) >= 6),
va as (select *, greatest(q - s*s/n, 0)/(n-1)/n v from lw),
co as (select a.is_real, a.sample_id, a.cell_type cell_type_a, b.cell_type cell_type_b, a.chrom, a.w*500 "start", a.w*500+2000 "end", (a.s/a.n - b.s/b.n)/sqrt(a.v+b.v) t,
 cast(a.c + b.c as bigint) n_sites, a.k/a.c meth_a, b.k/b.c meth_b from va a join va b on a.is_real=b.is_real and a.sample_id=b.sample_id and a.chrom=b.chrom and a.w=b.w
 and a.cell_type < b.cell_type where a.v+b.v > 0),
cutoff as (select sample_id, cell_type_a, cell_type_b, round(quantile_cont(round(abs(t), 9), 0.9), 9) cut from co where is_real group by all),
hit as (select co.*, round(abs(t), 9) abt, case when t < 0 then 'group_A' else 'group_B' end low_group from co join cutoff using (sample_id, cell_type_a, cell_type_b) where round(abs(t), 9) >= cut),
isl as (select *, sum(case when m is null or "start" >= m then 1 else 0 end) over (partition by is_real, sample_id, cell_type_a, cell_type_b, low_group, chrom order by "start" rows unbounded preceding) g from (
 select *, max("end") over (partition by is_real, sample_id, cell_type_a, cell_type_b, low_group, chrom order by "start" rows between unbounded preceding and 1 preceding) m from hit)),
found as (select is_real, sample_id, cell_type_a, cell_type_b, low_group, chrom, min("start") "start", max("end") "end", max(abt) abt, first(n_sites order by abt desc, "start") n_sites
 from isl group by is_real, sample_id, cell_type_a, cell_type_b, low_group, chrom, g),
ranked as (select *, count(*) filter (is_real) over upto cr, count(*) filter (not is_real) over upto cp, count(*) filter (is_real) over every n_real, count(*) filter (not is_real) over every n_permuted
 from found window every as (partition by sample_id, cell_type_a, cell_type_b), upto as (partition by sample_id, cell_type_a, cell_type_b order by abt desc range unbounded preceding))"""


@add("m4_diff_methylation_fdr", duck("""
select sample_id, cell_type_a, cell_type_b, chrom, "start", "end", low_group, n_sites, round(abt, 5) abs_t,
 round(case when n_permuted > 0 then least(1, (cp/n_permuted)/(cr/n_real)) end, 6) adj_p from ranked where is_real""", "cells", "cg", ctes=_FDR))
def m4_fdr(t):
    rows = residuals(t)
    windows = M.label_windows(rows, t.cells, bandwidth=2000, step=500, permute_seed=3)
    out = M.diff_methylation(M.compare_windows(windows, bandwidth=2000, step=500), threshold=0.1)
    return out.select(
        "sample_id", "cell_type_a", "cell_type_b", "chrom", "start", "end", "low_group", "n_sites",
        F.round(F.abs("t_stat"), 5).alias("abs_t"), F.round("adj_p", 6).alias("adj_p"),
    )


@add("m4_comparison_status", duck("""
select p.*, case when least(group_a_cells, group_b_cells) < 60 then 'ineligible' else 'complete' end status,
 case when least(group_a_cells, group_b_cells) < 60 then 0 else coalesce(n, 0) end dmr_rows from (
 select a.sample_id, a.cell_type cell_type_a, b.cell_type cell_type_b, a.cell_type || '_vs_' || b.cell_type comparison, a.n group_a_cells, b.n group_b_cells
 from (select sample_id, cell_type, count(*) n from cells group by 1,2) a join (select sample_id, cell_type, count(*) n from cells group by 1,2) b on a.sample_id=b.sample_id and a.cell_type < b.cell_type) p
 left join (select sample_id, cell_type_a, cell_type_b, count(*) n from dmr where raw_p < 0.01 group by 1,2,3) using (sample_id, cell_type_a, cell_type_b)""", "cells", "dmr"))
def m4_status(t):
    return M.comparison_status(K.label_pairs(t.cells), t.dmr.where("raw_p < 0.01"), 60)


@add("m5_permute_labels", duck("""
select d.cell_id, d.sample_id, i.cell_type from (select cell_id, sample_id, row_number() over (partition by sample_id order by md5(cell_id || '|7'), cell_id) k from cells) d
join (select sample_id, cell_type, row_number() over (partition by sample_id order by cell_id) k from cells) i on i.sample_id=d.sample_id and i.k=d.k""", "cells"))
def m5_permute(t):
    return M.permute_labels(t.cells, 7)


@add("m5_empirical_fdr", duck("""
select sample_id, comparison, chrom, "start", cell_type_a, abs_t, n_real, n_permuted, round(case when n_permuted > 0 then least(1, (cp/n_permuted)/(cr/n_real)) end, 6) adj_p from (
 select *, count(*) filter (is_real) over w cr, count(*) filter (not is_real) over w cp, count(*) filter (is_real) over (partition by comparison) n_real,
  count(*) filter (not is_real) over (partition by comparison) n_permuted from ft window w as (partition by comparison order by abs_t desc range unbounded preceding)) where is_real""",
    "dmr", ctes="""ft as (select *, round(abs(meth_a - meth_b), 3) abs_t, raw_p < 0.012 or cell_type_a = 'AUTOMOBILE' is_real from dmr)"""))
def m5(t):
    w = t.dmr.withColumn("abs_t", F.round(F.abs(F.col("meth_a") - F.col("meth_b")), 3)).withColumn("is_real", F.expr("raw_p < 0.012 or cell_type_a = 'AUTOMOBILE'"))
    out = M.empirical_fdr(w.select("sample_id", "comparison", "chrom", "start", "cell_type_a", "abs_t", "is_real"))
    return out.withColumn("adj_p", F.round("adj_p", 6))


_HYPO = """
bc as (select cell_id, chrom || '_' || cast(b*1000 as varchar) || '_' || cast(b*1000+1000 as varchar) feature_id, cast(sum(mc) as bigint) mc, cast(sum(cov) as bigint) cov
 from (select *, (pos-1)//1000 b from cg) group by cell_id, chrom, b),
br as (select *, sum(mc) over (partition by cell_id) / sum(cov) over (partition by cell_id) p from bc),
hs as (select cell_id, feature_id, mc, cov, case when mc >= cov or p <= 0 then 0 when p >= 1 then 1 else greatest(0, 1 - list_sum(list_transform(generate_series(0, mc),
 lambda i: exp(lgamma(cov+1) - lgamma(i+1) - lgamma(cov-i+1) + i*ln(p) + (cov-i)*ln(1-p))))) end score from br),
prev as (select feature_id, count(*) hypo_cells from hs where score >= 0.95 group by 1)"""


def scores(t):
    counts = I.count_over_bins(S.context_filter(t.sites), I.tile_genome(t.genome, 1000), 1000)
    return M.hypo_score(counts)


def rounded_score(df):
    """Six digits, halves up: rates like 11/20 give scores on a half, where the sums' own rounding would decide."""
    return df.withColumn("score", F.round(F.col("score") + 1e-10, 6))


@add("m6_hypo_score", duck("select cell_id, feature_id, mc, cov, round(score + 1e-10, 6) score from hs where score >= 0.9", "cg", ctes=_HYPO))
def m6(t):
    return rounded_score(scores(t))


# forty times the reads, and rates near one
_DEEP = """
bc as (select cell_id, chrom || '_' || cast(b*1000 as varchar) || '_' || cast(b*1000+1000 as varchar) feature_id,
 cast(sum(cov)*40 - sum(cov-mc) as bigint) mc, cast(sum(cov)*40 as bigint) cov from (select *, (pos-1)//1000 b from cg) group by cell_id, chrom, b),
br as (select *, sum(mc) over (partition by cell_id) / sum(cov) over (partition by cell_id) p from bc),
hs as (select cell_id, feature_id, mc, cov, case when mc >= cov or p <= 0 then 0 when p >= 1 then 1 else list_sum(list_transform(generate_series(mc+1, cov),
 lambda i: exp(lgamma(cov+1) - lgamma(i+1) - lgamma(cov-i+1) + i*ln(p) + (cov-i)*ln(1-p)))) end score from br)"""


@add("m6_hypo_score_deep", duck("select cell_id, feature_id, mc, cov, round(score + 1e-10, 6) score from hs where score >= 0.9", "cg", ctes=_DEEP))
def m6_deep(t):
    counts = I.count_over_bins(S.context_filter(t.sites), I.tile_genome(t.genome, 1000), 1000)
    deep = counts.withColumn("mc", F.col("cov") * 40 - (F.col("cov") - F.col("mc"))).withColumn("cov", F.col("cov") * 40)
    return rounded_score(M.hypo_score(deep))


@add("a4_hypo_prevalence", duck("select * from prev", "cg", ctes=_HYPO))
def a4(t):
    return M.hypo_prevalence(scores(t))


@add("w8_rank_bins", duck("select * from (select *, row_number() over (order by hypo_cells desc, feature_id) selection_rank from prev) where selection_rank <= 40", "cg", ctes=_HYPO))
def w8(t):
    return FT.rank_bins(M.hypo_prevalence(scores(t)), 40, exact=False)  # small tables hold fewer


@add("w8_rank_bins_summary", duck("""
select count(*) nonzero_hypo_bins, max(b) boundary_hypo_cells, count(*) filter (hypo_cells = b) boundary_tied_bins, round(max(b)*100.0/(select count(*) from cells), 6) effective_hypo_percent
from prev, (select min(hypo_cells) b from (select hypo_cells from prev order by hypo_cells desc limit 40))""", "cells", "cg", ctes=_HYPO))
def w8_summary(t):
    out = FT.rank_bins_summary(M.hypo_prevalence(scores(t)), t.cells, 40)
    return out.withColumn("effective_hypo_percent", F.round("effective_hypo_percent", 6))
