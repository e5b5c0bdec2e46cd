"""Queries over RNA counts."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.operators import expression as X
from cellspan.operators import features as FT
from cellspan.plans.storage import cut_lineage, stored

add = registry.add

_MET = """
met as (select cell_id, sample_id, cell_type, count(*) n_genes_by_counts, cast(sum("count") as bigint) total_counts,
 100.0*sum(case when gene like 'MT-%' then "count" else 0 end)/sum("count") pct_counts_mt, 100.0*sum(case when gene like 'RPL%' or gene like 'RPS%' then "count" else 0 end)/sum("count") pct_counts_ribo
 from rna group by 1,2,3)"""
_LOG = """
lg as (select *, ln(1 + "count"*10000.0/sum("count") over (partition by cell_id)) v from rna)"""


def values(t):
    """Normalised counts, derived once: the genes, moments, ranks and cells of a query are further readings."""
    return stored(X.normalize_log1p(t.rna))


def r(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


def clusters(rna):
    return rna.select("cell_id", F.col("cell_type").alias("cluster")).distinct()


@add("a7_rna_cell_metrics", duck("select cell_id, sample_id, n_genes_by_counts, total_counts, round(pct_counts_mt, 6) pct_counts_mt, round(pct_counts_ribo, 6) pct_counts_ribo from met", "rna", ctes=_MET))
def a7(t):
    return r(X.cell_metrics(t.rna), 6, "pct_counts_mt", "pct_counts_ribo")


@add("p6_rna_cell_qc", duck("select cell_id, n_genes_by_counts, total_counts from met where n_genes_by_counts >= 20 and n_genes_by_counts < 60 and total_counts >= 500 and pct_counts_mt < 7", "rna", ctes=_MET))
def p6(t):
    return X.cell_qc(X.cell_metrics(t.rna), min_genes=20, max_genes=60, min_counts=500, max_mt=7).select("cell_id", "n_genes_by_counts", "total_counts")


@add("p7_gene_min_cells", duck("""
select sample_id, gene, count(*) cells, cast(sum("count") as bigint) total from rna group by 1,2 having count(*) >= 35""", "rna"))
def p7(t):
    return X.gene_min_cells(t.rna, 35).groupBy("sample_id", "gene").agg(F.count("*").alias("cells"), F.sum("count").alias("total"))


@add("a8_qc_distribution", duck("\nunion all\n".join(f"""
select sample_id, '{m}' metric, count(*) n, round(avg({m}), 6) mean, round(stddev_samp({m}), 5) std, round(min({m}::double), 6) min, round(max({m}::double), 6) max,
 round(quantile_cont({m}::double, 0.01), 6) p01, round(quantile_cont({m}::double, 0.05), 6) p05, round(quantile_cont({m}::double, 0.5), 6) p50, round(quantile_cont({m}::double, 0.95), 6) p95, round(quantile_cont({m}::double, 0.99), 6) p99
from met group by 1""" for m in ("n_genes_by_counts", "total_counts", "pct_counts_mt", "pct_counts_ribo")), "rna", ctes=_MET))
def a8(t):
    out = FT.metric_distribution(X.cell_metrics(t.rna), "sample_id", ["n_genes_by_counts", "total_counts", "pct_counts_mt", "pct_counts_ribo"])
    return r(r(out, 6, "mean", "min", "max", "p01", "p05", "p50", "p95", "p99"), 5, "std")


@add("a11_cluster_qc", duck("""
select cell_type "cluster", count(*) cells, round(median(n_genes_by_counts), 6) median_n_genes_by_counts, round(median(total_counts), 6) median_total_counts, round(median(pct_counts_mt), 6) median_pct_counts_mt
from met group by 1""", "rna", ctes=_MET))
def a11(t):
    t.store("rna")
    cells = X.cell_metrics(t.rna).join(clusters(t.rna), "cell_id")
    ms = ["n_genes_by_counts", "total_counts", "pct_counts_mt"]
    return r(X.cluster_qc(cells, "cluster", ms), 6, *[f"median_{m}" for m in ms])


@add("a21_highest_expressed_genes", duck("""
select * from (select *, row_number() over (partition by sample_id order by mean_percent desc, gene) gene_rank from (
 select sample_id, gene, round(sum(100.0*"count"/t)/any_value(n), 9) mean_percent from (select *, sum("count") over (partition by cell_id) t from rna)
 join (select sample_id, count(distinct cell_id) n from rna group by 1) using (sample_id) group by 1,2)) where gene_rank <= 20""".replace("select * from (select *, row", "select sample_id, gene, round(mean_percent, 6) mean_percent, gene_rank from (select *, row"), "rna"))
def a21(t):
    return r(X.highest_expressed_genes(t.rna), 6, "mean_percent")


@add("m7_normalize_log1p", duck("""select cell_id, gene, "count", round(v, 6) "value" from lg""", "rna", ctes=_LOG))
def m7(t):
    return r(X.normalize_log1p(t.rna), 6, "value").select("cell_id", "gene", "count", "value")


_HVG = _LOG + """,
gs as (select sample_id, gene, sum(exp(v)-1) s, sum((exp(v)-1)*(exp(v)-1)) q, any_value(n) n from lg join (select sample_id, count(distinct cell_id)::double n from rna group by 1) using (sample_id) group by 1,2),
gd as (select sample_id, gene, ln(1+s/n) m, ln(nullif(greatest((q - s*s/n)/(n-1), 0)/(s/n), 0)) d from gs),
gb as (select *, greatest(1, least(20, ceil(round((m - min(m) over w)/(max(m) over w - min(m) over w)*20, 9)))) b from gd window w as (partition by sample_id)),
gz as (select *, round(case when count(d) over w = 1 then case when d is not null then 1.0 end else (d - avg(d) over w)/nullif(stddev_samp(d) over w, 0) end, 9) z from gb window w as (partition by sample_id, b)),
gt as (select *, row_number() over (partition by sample_id order by z desc nulls last, gene) <= {n} and z is not null top from gz),
hvg as (select gene, count(*) filter (top) n_samples, round(coalesce(sum(z), 0)/(select count(distinct sample_id) from rna), 6) score from gt group by 1),
sel as (select *, row_number() over (order by n_samples desc, score desc, gene) gene_rank from hvg order by n_samples desc, score desc, gene limit {n})"""


@add("m8_highly_variable_genes", duck("select * from sel", "rna", ctes=_HVG.format(n=60)))
def m8(t):
    return X.highly_variable_genes(values(t), 60)


def _long(vectors):
    return vectors.select("cell_id", F.posexplode("vec").alias("i", "z")).select("cell_id", F.col("i").cast("long").alias("i"), F.round("z", 5).alias("z"))


@add("m10_scale_genes", duck("""
select cell_id, i, round(least(10, (coalesce(v, 0) - m)/sd), 5) z from (select distinct cell_id from rna) c
cross join (select gene, row_number() over (order by gene) - 1 i, s/n m, sqrt((q - s*s/n)/(n-1)) sd from (select gene, sum(v) s, sum(v*v) q, (select count(distinct cell_id)::double from rna) n from lg where gene in (select gene from sel) group by 1)) g
left join lg using (cell_id, gene)""", "rna", ctes=_HVG.format(n=30)))
def m10(t):
    v = values(t)
    return _long(X.scale_genes(v, v.select("cell_id").distinct(), X.highly_variable_genes(v, 30)))


@add("m9_regress_out", duck("""
select cell_id, i, round(coalesce(v, 0) - my - ba*(total_counts - ma) - bb*(pct_counts_mt - mb), 5) z from met
cross join (select gene, row_number() over (order by gene) - 1 i, regr.* from (
  select gene, sum(v)/any_value(n) my, any_value(ma) ma, any_value(mb) mb,
   (any_value(sbb)*sum(v*(total_counts-ma)) - any_value(sab)*sum(v*(pct_counts_mt-mb)))/any_value(saa*sbb-sab*sab) ba,
   (any_value(saa)*sum(v*(pct_counts_mt-mb)) - any_value(sab)*sum(v*(total_counts-ma)))/any_value(saa*sbb-sab*sab) bb
  from lg join met using (cell_id) cross join (select count(*)::double n, avg(total_counts) ma, avg(pct_counts_mt) mb, var_pop(total_counts)*count(*) saa, var_pop(pct_counts_mt)*count(*) sbb,
   covar_pop(total_counts, pct_counts_mt)*count(*) sab from met) where gene in (select gene from sel) group by 1) regr) g
left join lg using (cell_id, gene)""".replace("regr.* from (", "my, ma, mb, ba, bb from ("), "rna", ctes=_HVG.format(n=10) + "," + _MET))
def m9(t):
    v = values(t)
    return _long(X.regress_out(v, cut_lineage(X.cell_metrics(v)), X.highly_variable_genes(v, 10)))


_PANELS = {"mito": ["MT-1", "MT-2", "MT-5"], "ribo": ["RPL20", "RPL30", "RPL40"], "low": ["GENE70", "GENE80", "GENE90"], "mid": ["GENE130", "GENE150"], "high": ["GENE200", "GENE250", "GENE290", "ABSENT"]}
_PAN = "pan(panel, gene) as (values " + ", ".join(f"('{p}','{g}')" for p, gs in _PANELS.items() for g in gs) + ")"
_GM = _LOG + "," + _PAN + """,
sz as (select cell_type "cluster", count(*) n from (select distinct cell_id, cell_type from rna) group by 1),
gm as (select z."cluster", g.gene, coalesce(k, 0)/n::double fraction, coalesce(s, 0)/n mean_value from (select distinct gene from lg where gene in (select gene from pan)) g cross join sz z
 left join (select cell_type "cluster", gene, sum(v) s, count(*) filter (v > 0) k from lg group by 1,2) x using ("cluster", gene))"""


def panel_genes(t):
    return X._panel_frame(t.spark, _PANELS)


@add("a17_dotplot_stats", duck("""select "cluster", gene, round(fraction, 6) fraction, round(mean_value, 6) mean_value from gm""", "rna", ctes=_GM))
def a17(t):
    v = values(t)
    return r(X.dotplot_stats(v, cut_lineage(clusters(v)), panel_genes(t)), 6, "fraction", "mean_value")


@add("a17_dotplot_subset", duck("""select "cluster", gene, round(fraction, 6) fraction, round(mean_value, 6) mean_value from gm where "cluster" in ('BUILDING', 'MACHINERY')""", "rna", ctes=_GM))
def a17_subset(t):
    v = values(t)
    return r(X.dotplot_stats(v, cut_lineage(clusters(v)), panel_genes(t), only=["BUILDING", "MACHINERY"]), 6, "fraction", "mean_value")


_WIL = _LOG + """,
nz as (select gene, cell_type, v, rank() over (partition by gene order by v) + (count(*) over (partition by gene, v) - 1)/2.0 rk, count(*) over (partition by gene) nzn from lg),
wsz as (select cell_type "cluster", count(*)::double n1, (select count(distinct cell_id)::double from rna) n from (select distinct cell_id, cell_type from rna) group by 1),
wil as (select w."cluster", g.gene, coalesce(rs, 0) + coalesce(k, 0)*(n - nzn) + (n1 - coalesce(k, 0))*(n - nzn + 1)/2 rank_sum, n1, n from (select gene, any_value(nzn) nzn from nz group by 1) g cross join wsz w
 left join (select gene, cell_type "cluster", sum(rk) rs, count(*) k from nz group by 1,2) x using ("cluster", gene)),
wz as (select *, (rank_sum - n1*(n+1)/2)/sqrt(n1*(n-n1)*(n+1)/12) score from wil)"""


def wilcoxon(v, groups):
    out = X.rank_genes_wilcoxon(v.withColumn("value", F.round("value", 9)), groups)
    return r(out, 6, "score")


_WIL = _WIL.replace("from lg),\nwsz", "from (select gene, cell_type, round(v, 9) v from lg)),\nwsz")


@add("m18_rank_genes_wilcoxon", duck("""select "cluster", gene, round(rank_sum, 3) rank_sum, round(score, 6) score from wz""", "rna", ctes=_WIL))
def m18(t):
    v = values(t)
    return r(wilcoxon(v, cut_lineage(clusters(v))), 3, "rank_sum")


_TOPM = _WIL + """,
tm as (select * from (select "cluster", gene, round(score, 6) score, row_number() over (partition by "cluster" order by round(score, 6) desc, gene) marker_rank from wz) where marker_rank <= 10)"""


@add("w15_top_markers", duck("select * from tm", "rna", ctes=_TOPM))
def w15(t):
    v = values(t)
    return X.top_markers(wilcoxon(v, cut_lineage(clusters(v))), 10).select("cluster", "gene", "score", "marker_rank")


_SC = _GM + """,
gz as (select *, case when stddev_pop(mean_value) over w > 1e-12 then (mean_value - avg(mean_value) over w)/stddev_pop(mean_value) over w else 0 end z from gm window w as (partition by gene)),
ps as (select "cluster", panel, avg(z) score from gz join pan using (gene) group by 1,2),
tt as (select "cluster", max(case when k=1 then panel end) top_candidate, max(case when k=2 then panel end) second_candidate, max(case when k=1 then score end) top_score, max(case when k=2 then score end) second_score
 from (select *, row_number() over (partition by "cluster" order by round(score, 9) desc, panel) k from ps) group by 1),
mg as (select *, top_score - second_score score_margin, case when round(top_score - second_score, 9) >= 0.5 then 'proposed' else 'ambiguous' end status,
 case when round(top_score - second_score, 9) >= 0.5 then top_candidate else 'Unassigned' end proposed_cell_type from tt)"""


@add("m19_panel_scores", duck("""select "cluster", panel, round(score, 5) score from ps""", "rna", ctes=_SC))
def m19(t):
    v = values(t)
    return r(X.panel_scores(v, cut_lineage(clusters(v)), _PANELS), 5, "score")


_MARGIN_COLS = """"cluster", top_candidate, second_candidate, round(top_score, 5) top_score, round(second_score, 5) second_score, round(score_margin, 5) score_margin, status, proposed_cell_type"""


def margins(v, groups):
    out = X.top_two_margin(X.panel_scores(v, groups, _PANELS), 0.5)
    return r(out, 5, "top_score", "second_score", "score_margin")


@add("w14_top_two_margin", duck(f"select {_MARGIN_COLS} from mg", "rna", ctes=_SC))
def w14(t):
    v = values(t)
    return margins(v, cut_lineage(clusters(v)))


@add("a22_annotation_audit", duck(f"""select {_MARGIN_COLS}, n cells, (select string_agg(gene, ',' order by marker_rank) from tm where tm."cluster" = mg."cluster") top_markers
 from mg join sz using ("cluster")""", "rna", ctes=_SC + "," + _TOPM.replace(_LOG, "").strip().lstrip(",")))
def a22(t):
    v = values(t)
    groups = cut_lineage(clusters(v))
    return X.annotation_audit(groups, X.top_markers(wilcoxon(v, groups), 10), margins(v, groups))


@add("a22_audit_without_panels", duck("""select "cluster", n cells, (select string_agg(gene, ',' order by marker_rank) from tm where tm."cluster" = sz."cluster") top_markers, 'Unassigned' proposed_cell_type, 'pending_annotation_review' status
 from (select cell_type "cluster", count(*) n from (select distinct cell_id, cell_type from rna) group by 1) sz""", "rna", ctes=_TOPM))
def a22_plain(t):
    v = values(t)
    groups = cut_lineage(clusters(v))
    return X.annotation_audit(groups, X.top_markers(wilcoxon(v, groups), 10))


@add("m20_expected_doublet_rate", duck("select sample_id, count(*) cells, 0.004*count(*)/1000 expected_doublet_rate from (select distinct sample_id, cell_id from rna) group by 1".replace("0.004*count(*)/1000", "round(0.004::double*count(*)/1000, 9)"), "rna"))
def m20_rate(t):
    return r(X.expected_doublet_rate(t.rna.select("sample_id", "cell_id").distinct(), min_cells=10), 9, "expected_doublet_rate")


@add("p16_drop_doublets", duck("""select cell_id, sample_id from met where not total_counts > 1500""", "rna", ctes=_MET))
def p16(t):
    return X.drop_doublets(X.cell_metrics(t.rna).withColumn("predicted_doublet", F.col("total_counts") > 1500)).select("cell_id", "sample_id")
