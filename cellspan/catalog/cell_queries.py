"""Queries over cell tables and annotations."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.functions import columns as C
from cellspan.operators import annotation as AN
from cellspan.operators import cells as K
from cellspan.operators import quality as Q
from cellspan.plans.guards import checked
from cellspan.operators import sites as S

add = registry.add

_SEL = """
sel as (select c.cell_id, c.sample_id, trim(coalesce(a.cell_type, '')) rna_cell_type, coalesce(a.leiden,'') rna_leiden, coalesce(a.cohort,'') rna_cohort, coalesce(a.sample,'') rna_sample,
 case when a.cell_id is null then 'not_in_scanpy' when trim(coalesce(a.cell_type,'')) = '' then 'missing_scanpy_cell_type'
  when trim(a.cell_type) in ('BUILDING','NA','Unassigned','requires_review') then 'excluded_scanpy_cell_type_BUILDING' end reason
 from cells c left join annotation a using (cell_id))"""


def selection(t):
    return K.select_cells(t.cells, t.annotation, approved=True, exclude="BUILDING")


@add("j1_select_cells", duck("select cell_id, sample_id, rna_cell_type, rna_leiden, rna_cohort, rna_sample from sel where reason is null", "cells", "annotation", ctes=_SEL))
def j1(t):
    return K.selected(selection(t))


@add("j1_excluded_cells", duck("select cell_id, sample_id, reason from sel where reason is not null", "cells", "annotation", ctes=_SEL))
def j1_excluded(t):
    return K.excluded(selection(t))


@add("j1_selection_summary", duck("""
select sample_id, count(*) discovered_cells, count(*) filter (reason is null) selected_cells, count(*) filter (reason is not null) excluded_cells from sel group by 1""", "cells", "annotation", ctes=_SEL))
def j1_summary(t):
    return K.selection_summary(selection(t))


@add("j1_exclusion_counts", duck("select reason, count(*) cells from sel where reason is not null group by 1", "cells", "annotation", ctes=_SEL))
def j1_reasons(t):
    return K.exclusion_counts(selection(t))


@add("j1_unapproved", duck("select cell_id, sample_id, 'Unassigned' rna_cell_type, '' rna_leiden, '' rna_cohort, '' rna_sample from cells", "cells"))
def j1_unapproved(t):
    return K.selected(K.select_cells(t.cells, t.annotation, approved=False))


@add("j2_restrict_to_cells", duck("""
select cell_id, count(*) n, cast(sum(cov) as bigint) cov from sites where cell_id in (select cell_id from sel where reason is null) group by 1""", "cells", "annotation", ctes=_SEL))
def j2(t):
    kept = K.restrict_to_cells(t.sites, K.selected(selection(t)))
    return kept.groupBy("cell_id").agg(F.count("*").alias("n"), F.sum("cov").alias("cov"))


@add("j2_guarded_restriction", duck("""
select cell_id, count(*) n, cast(sum(cov) as bigint) cov from sites where cell_id in (select cell_id from cells where cell_type <> 'BUILDING') group by 1""", "cells", "sites"))
def j2_guarded(t):
    kept, guard = K.guarded_restriction(t.sites, t.cells.where("cell_type <> 'BUILDING'"))
    return checked(kept.groupBy("cell_id").agg(F.count("*").alias("n"), F.sum("cov").alias("cov")), guard)


@add("j2_restriction_problems", duck("select cell_id, 'missing' problem from annotation where cell_id not in (select cell_id from sites where mc = cov)", "annotation", "sites"))
def j2_problems(t):
    return K.restriction_problems(t.sites.where("mc = cov"), t.annotation)


@add("j3_annotate_obs", duck("""
select cell_id, coalesce(a.cell_type, 'Unknown') cell_type, coalesce(a.cell_type, 'Unknown') manual_celltype, coalesce(a.sample, split_part(cell_id,'_',1)) sample_id,
 coalesce(a.cohort, a.sample, split_part(cell_id,'_',1)) condition, coalesce(a.cohort, a.sample, split_part(cell_id,'_',1)) cohort
from cells c left join annotation a using (cell_id)""", "cells", "annotation"))
def j3(t):
    return K.annotate_obs(t.cells, t.annotation)


@add("p4_drop_placeholder_strict", duck("""select cell_id, cell_type from annotation where cell_type not in ('NA','Unassigned','requires_review')""", "annotation"))
def p4_strict(t):
    return K.drop_placeholder_labels(t.annotation, mode="strict").select("cell_id", "cell_type")


@add("p4_drop_placeholder_canonical", duck("""select cell_id, cell_type from annotation where lower(trim(cell_type)) not in
 ('','na','nan','none','n/a','unknown','unannotated','unassigned','requires_review','requires review')""", "annotation"))
def p4_canonical(t):
    return K.drop_placeholder_labels(t.annotation).select("cell_id", "cell_type")


_MANIFEST = """
manifest as (select concat('S', c_nationkey) || case when c_acctbal < -500 then ' x' else '' end sample_id,
 case when c_acctbal > 5000 then 'TRUE' when c_acctbal > 2000 then ' yes ' when c_acctbal > 0 then '1' else 'no' end include,
 case when c_mktsegment = 'BUILDING' then '' when c_mktsegment = 'MACHINERY' then null else '/data/' || c_name end allc_root,
 case when c_mktsegment in ('BUILDING','FURNITURE') then '' else '/rna/' || c_name end rna_path,
 case c_mktsegment when 'MACHINERY' then '' when 'HOUSEHOLD' then 'loom' else '10x_mtx' end rna_format, ' ' cell_id_prefix, c_custkey line from customer)"""


def manifest(t):
    return t.customer.select(
        F.expr("concat('S', c_nationkey) || case when c_acctbal < -500 then ' x' else '' end").alias("sample_id"),
        F.expr("case when c_acctbal > 5000 then 'TRUE' when c_acctbal > 2000 then ' yes ' when c_acctbal > 0 then '1' else 'no' end").alias("include"),
        F.expr("case when c_mktsegment = 'BUILDING' then '' when c_mktsegment = 'MACHINERY' then null else '/data/' || c_name end").alias("allc_root"),
        F.expr("case when c_mktsegment in ('BUILDING','FURNITURE') then '' else '/rna/' || c_name end").alias("rna_path"),
        F.expr("case c_mktsegment when 'MACHINERY' then '' when 'HOUSEHOLD' then 'loom' else '10x_mtx' end").alias("rna_format"),
        F.lit(" ").alias("cell_id_prefix"), F.col("c_custkey").alias("line"),
    )


@add("p5_included_samples", duck("""select line, sample_id from manifest where lower(trim(include)) in ('1','true','yes') and trim(coalesce(allc_root,'')) <> ''""", ctes=_MANIFEST))
def p5(t):
    return K.included_samples(manifest(t)).select("line", "sample_id")


@add("s7_samples_problems", duck("""
select line, p problem from (select line, unnest(list_filter([
 case when not regexp_full_match(trim(sample_id), '[A-Za-z0-9][A-Za-z0-9_.-]*') then 'invalid sample_id' end,
 case when count(*) over (partition by trim(sample_id)) > 1 then 'duplicate sample_id' end,
 case when trim(rna_format) not in ('', '10x_mtx', '10x_h5', '10x_zip') then 'unsupported rna_format' end,
 case when lower(trim(include)) in ('1','true','yes') and coalesce(trim(rna_path),'') = '' and coalesce(trim(allc_root),'') = '' then 'no RNA or ALLC input' end,
 case when coalesce(trim(rna_path),'') <> '' and coalesce(trim(rna_format),'') = '' then 'rna_format required' end], lambda x: x is not null)) p from manifest)""", ctes=_MANIFEST))
def s7(t):
    from cellspan.sources.tables import sample_problems

    return sample_problems(manifest(t)).select("line", F.explode("problems").alias("problem"))


@add("p15_split_cell_id", duck("""
select cell_id, case when contains(cell_id, '_') then split_part(cell_id,'_',1) else 'NA' end sample_id,
 case when contains(cell_id,'_') then substr(cell_id, strpos(cell_id,'_')+1) else cell_id end barcode
from (select cell_id from cells union all select c_name from customer union all select 'a_' || cell_id from cells)""", "cells"))
def p15(t):
    ids = t.cells.select("cell_id").union(t.customer.select("c_name")).union(t.cells.select(F.concat(F.lit("a_"), "cell_id")))
    return K.split_cell_id(ids)


_CELLSTAT = """
stat as (select cell_id, count(*) n_sites, 100.0*sum(case when mc*2>=cov then 1 else 0 end)/count(*) mean_pct from cg group by 1)"""


@add("p8_meth_cell_filter", duck("select cell_id, n_sites, round(mean_pct, 6) mean_pct from stat where n_sites >= 20 and mean_pct >= 60 and mean_pct <= 95", "cg", ctes=_CELLSTAT))
def p8(t):
    stats = K.meth_cell_stats(S.binary_calls(S.context_filter(t.sites), round_sites=True))
    return K.meth_cell_filter(stats, min_sites=20, min_pct=60, max_pct=95).withColumn("mean_pct", F.round("mean_pct", 6))


_PAIRS = """
lab as (select {s} sample_id, trim(cell_type) label, count(distinct cell_id) n from cells join (select cell_id, cell_type label2 from annotation) using (cell_id)
 where label2 not in ('NA') group by 1,2),
pairs as (select a.sample_id, a.label cell_type_a, a.n group_a_cells, b.label cell_type_b, b.n group_b_cells, a.label || '_vs_' || b.label comparison
 from lab a join lab b on a.sample_id=b.sample_id and a.label < b.label)"""


def _annotated(t):
    return t.cells.join(t.annotation.where("cell_type <> 'NA'").select("cell_id"), "cell_id", "left_semi")


@add("j9_label_pairs", duck("select * from pairs", "cells", "annotation", ctes=_PAIRS.format(s="sample_id")))
def j9(t):
    return K.label_pairs(_annotated(t))


@add("j9_guarded_pairs_pooled", duck("select * from pairs", "cells", "annotation", ctes=_PAIRS.format(s="'pooled'")))
def j9_guarded(t):
    pairs, guard = K.guarded_pairs(_annotated(t), pool_as="pooled")
    return checked(pairs, guard)


@add("j9_label_pairs_pooled", duck("select * from pairs", "cells", "annotation", ctes=_PAIRS.format(s="'pooled'")))
def j9_pooled(t):
    return K.label_pairs(_annotated(t), pool_as="pooled")


@add("j11_reconcile_ids", duck("""
select coalesce(c.cell_id, a.cell_id) cell_id, case when a.cell_id is null then 'missing' else 'extra' end status
from cells c full outer join annotation a on c.cell_id=a.cell_id where a.cell_id is null or c.cell_id is null""", "cells", "annotation"))
def j11(t):
    return K.reconcile_ids(t.cells, t.annotation)


@add("u2_missing_and_extra", duck("""
select 'missing' side, cell_id from (select cell_id from annotation except select cell_id from cells)
union all select 'extra', cell_id from (select cell_id from cells except select cell_id from annotation)""", "cells", "annotation"))
def u2(t):
    return Q.missing_and_extra(t.annotation, t.cells, "cell_id")


_OVER = """
over_ as (select trim(cell_type) cell_type, count(*) cells from annotation where cell_id in (select cell_id from cells) and trim(cell_type) <> '' group by 1)"""


@add("j12_modality_overlap", duck("select * from over_", "cells", "annotation", ctes=_OVER))
def j12(t):
    return K.modality_overlap(t.annotation, t.cells)


@add("a16_eligible_labels", duck("select * from over_ where cells >= 60", "cells", "annotation", ctes=_OVER))
def a16(t):
    return K.eligible_labels(K.modality_overlap(t.annotation, t.cells), 60)


@add("a16_labels_ready", duck("""select count(*) filter (cells >= 60) eligible_labels, count(*) filter (cell_type in ('NA','Unassigned','requires_review')) placeholder_labels,
 count(*) filter (cells >= 60) >= 2 and count(*) filter (cell_type in ('NA','Unassigned','requires_review')) = 0 ready from over_""", "cells", "annotation", ctes=_OVER))
def a16_ready(t):
    return K.labels_ready(K.modality_overlap(t.annotation, t.cells), 60)


@add("q4_route_readiness", duck("""
select (select count(*) > 0 from rna) rna_present, (select count(*) > 0 from sites) methylation_present,
 (select count(*) filter (cells >= 60) >= 2 and count(*) filter (cell_type in ('NA','Unassigned','requires_review')) = 0 from over_) dmr_ready""", "rna", "sites", "cells", "annotation", ctes=_OVER))
def q4(t):
    return Q.route_readiness(t.rna, t.sites, K.modality_overlap(t.annotation, t.cells), approved=True, min_cells=60)


@add("a9_stage_funnel", duck("""
select sample_id, s.step, s.stage, cells, round(cells::double / first(cells) over (partition by sample_id order by s.step), 6) fraction_of_first,
 round(cells::double / nullif(coalesce(lag(cells) over (partition by sample_id order by s.step), cells), 0), 6) fraction_of_previous from (
 select sample_id, step, stage, coalesce(n, 0) cells from (select distinct sample_id from cells) x cross join (values (0,'discovered'),(1,'selected'),(2,'filtered')) v(step, stage)
 left join (select sample_id, 0 step, count(*) n from cells group by 1 union all select sample_id, 1, count(*) from sel where reason is null group by 1
  union all select sample_id, 2, count(*) from sel where reason is null and cell_id in (select cell_id from stat where n_sites >= 20) group by 1) using (sample_id, step)) s""",
    "cells", "annotation", "cg", ctes=_SEL.strip() + "," + _CELLSTAT))
def a9(t):
    picked = K.selected(selection(t))
    stats = K.meth_cell_stats(S.binary_calls(S.context_filter(t.sites), round_sites=True)).where("n_sites >= 20")
    stages = [("discovered", t.cells), ("selected", picked), ("filtered", K.restrict_to_cells(picked, stats))]
    out = K.stage_funnel(stages)
    return out.withColumn("fraction_of_first", F.round("fraction_of_first", 6)).withColumn("fraction_of_previous", F.round("fraction_of_previous", 6))


@add("a10_crosstab", duck("""select leiden, cell_type, count(*) cells from annotation group by 1,2""", "annotation"))
def a10(t):
    return K.crosstab(t.annotation, "leiden", "cell_type")


@add("a10_crosstab_fractions", duck("""
select leiden, cell_type, count(*) cells, round(count(*)::double / sum(count(*)) over (partition by leiden), 6) fraction from annotation group by 1,2""", "annotation"))
def a10_fractions(t):
    return K.crosstab(t.annotation, "leiden", "cell_type", normalize=True).withColumn("fraction", F.round("fraction", 6))


_MAJ = """
maj as (select leiden, cast(sum(n) as bigint) cells, count(*) n_labels, first(cell_type order by n desc, cell_type) proposed_cell_type
 from (select leiden, cell_type, count(*) n from annotation group by 1,2) group by 1)"""


@add("a12_majority_label", duck("select * from maj", "annotation", ctes=_MAJ))
def a12(t):
    return K.majority_label(t.annotation, "leiden")


@add("s14_review_worksheet", duck("""select leiden "cluster", proposed_cell_type, cells, proposed_cell_type cell_type, 'reviewed' confidence, '' evidence from maj""", "annotation", ctes=_MAJ))
def s14(t):
    return AN.review_worksheet(t.annotation, "leiden")


@add("s14_worksheet_problems", duck("""
select "cluster", problem from (select trim(leiden) "cluster", case when trim(leiden)='' then 'blank cluster' when n > 1 then 'duplicate cluster' when trim(cell_type) = '' then 'blank label'
 when lower(trim(cell_type)) in ('na','nan','none','n/a','unknown','unannotated','unassigned','requires_review','requires review') then 'placeholder label' end problem
 from (select *, count(*) over (partition by trim(leiden)) n from (select distinct case leiden when '3' then ' ' else leiden || cell_id end leiden, cell_type from annotation))) where problem is not null""", "annotation"))
def s14_problems(t):
    sheet = t.annotation.select(F.expr("case leiden when '3' then ' ' else concat(leiden, cell_id) end").alias("cluster"), "cell_type").distinct()
    return AN.worksheet_problems(sheet).select("cluster", "problem")


@add("j10_apply_reviewed_labels", duck("""
select a.cell_id, a.leiden "cluster", m.proposed_cell_type cell_type, 'reviewed' status, 'reviewed' reason from annotation a join maj m using (leiden)""", "annotation", ctes=_MAJ))
def j10(t):
    cells = t.annotation.select("cell_id", F.col("leiden").alias("cluster"))
    profile = AN.record_profile(AN.review_worksheet(t.annotation, "leiden"), "sig")
    return AN.apply_reviewed_labels(cells, profile, "sig").select("cell_id", "cluster", "cell_type", "status", "reason")


@add("j10_profile_verdicts", duck("""
select * from (values ('absent','requires_review','annotation_profile_absent'), ('signature','requires_review','analysis_signature_mismatch'),
 ('clusters','requires_review','cluster_set_mismatch'), ('incomplete','requires_review','annotation_mapping_incomplete'), ('good','reviewed','reviewed')) v("case", status, reason)"""))
def j10_verdicts(t):
    cells = t.annotation.select("cell_id", F.col("leiden").alias("cluster"))
    good = AN.record_profile(AN.review_worksheet(t.annotation, "leiden"), "sig")
    top = good.agg(F.max("cluster")).scalar()
    cases = [
        ("absent", good.where("1 = 0")), ("signature", good.withColumn("analysis_signature", F.lit("other"))),
        ("clusters", good.where(F.col("cluster") < top)),
        ("incomplete", good.withColumn("cell_type", F.when(F.col("cluster") < top, F.col("cell_type")).otherwise(""))), ("good", good),
    ]
    return K.union_samples([AN.profile_verdict(cells, p, "sig").select(F.lit(n).alias("case"), "status", "reason") for n, p in cases])


@add("s8_read_annotation", duck("""select cell_id, trim(leiden) cell_type, cohort, sample from annotation""", "annotation"))
def s8(t):
    from cellspan.sources.tables import normalize_annotation

    return normalize_annotation(t.annotation.drop("cell_type"), "cell_id", "leiden")


@add("w7_balanced_sample", duck("""
select cell_id, sample_id, cell_type, turn from (select *, row_number() over (partition by sample_id order by cell_id) turn from cells) order by turn, sample_id limit 43""", "cells"))
def w7(t):
    return K.balanced_sample(t.cells, 43).withColumn("turn", F.col("turn").cast("long"))


@add("o2_first_n_cells", duck("select * from cells order by cell_id limit 25", "cells"))
def o2(t):
    return K.first_n_cells(t.cells, 25)


@add("u1_union_samples", duck("""
select cell_id, gene, "count", cast(null as bigint) cov from rna where sample_id = 'S0' union all select cell_id, null, null, cov from sites where sample_id <> 'S0'""", "rna", "sites"))
def u1(t):
    return K.union_samples([t.rna.where("sample_id = 'S0'").select("cell_id", "gene", "count"), t.sites.where("sample_id <> 'S0'").select("cell_id", "cov")])


@add("u1_guarded_union", duck("""
select cell_id, count(*) n, cast(sum("count") as bigint) total from rna group by 1""", "rna"))
def u1_guarded(t):
    frames = [t.rna.where("sample_id = 'S0'"), t.rna.where("sample_id <> 'S0'")]
    guard = K.guarded_union(frames, lambda df: df.groupBy("cell_id").agg(F.count("*").alias("n"), F.sum("count").alias("total")))
    return checked(guard.watched, guard)


@add("q2_expect_unique", duck("""select cell_type, count(*) copies from annotation group by 1 having count(*) > 1""", "annotation"))
def q2(t):
    return Q.expect_unique(t.annotation, "cell_type")


@add("q2_expect_subset", duck("""select distinct cell_id from annotation where cell_id not in (select cell_id from sites where mc = 0)""", "annotation", "sites"))
def q2_subset(t):
    return Q.expect_subset(t.annotation, t.sites.where("mc = 0"), "cell_id")


@add("q2_expect_nonempty", duck("""select 'cell_type' "column", count(*) filter (trim(coalesce(cell_type,'')) = '') blank_rows, count(*) n_rows from annotation
 union all select 'cohort', count(*) filter (trim(coalesce(cohort,'')) = ''), count(*) from annotation""", "annotation"))
def q2_nonempty(t):
    return Q.expect_nonempty(t.annotation, ["cell_type", "cohort"])


@add("q7_metadata_consistency", duck("""
select cell_id, 'id_mismatch' problem from annotation where sample || '_' || split_part(cell_id,'_',2) <> cell_id or sample is null
union all select cell_id, 'conflicting_labels' from (select cell_id, sample_id, chrom from sites group by all) group by 1 having count(*) > 1""", "annotation", "sites"))
def q7(t):
    ids = t.annotation.select("cell_id", F.col("sample").alias("sample_id"), F.split("cell_id", "_", 2)[1].alias("barcode"))
    labels = t.sites.select("cell_id", "sample_id", F.col("chrom").alias("cell_type"))
    return Q.id_mismatches(ids).unionByName(Q.conflicting_labels(labels))


@add("q8_panel_consistency", duck("""
select label, in_order, in_panels, in_mapping from (select label, bool_or(s=1) in_order, bool_or(s=2) in_panels, bool_or(s=3) in_mapping from (
 select distinct cell_type label, 1 s from annotation union all select distinct cell_type, 2 from cells union all select distinct c_mktsegment, 3 from customer where c_acctbal > 9990) group by 1)
where not (in_order and in_panels and in_mapping)""", "annotation", "cells"))
def q8(t):
    return Q.panel_consistency(
        t.annotation.select(F.col("cell_type").alias("label")), t.cells.select(F.col("cell_type").alias("label")),
        t.customer.where("c_acctbal > 9990").select(F.col("c_mktsegment").alias("label")),
    )


@add("f1_sanitize_label", duck("""
select c_name, trim(regexp_replace(c_name || ' (' || c_mktsegment || ')', '[^A-Za-z0-9._-]+', '_', 'g'), '_') safe_label from customer"""))
def f1(t):
    return t.customer.select("c_name", C.sanitize_label(F.expr("concat(c_name, ' (', c_mktsegment, ')')")).alias("safe_label"))


@add("f1_sanitize_collisions", duck("""
select sample_id, safe_label, count(*) labels from (select distinct sample_id, label, trim(regexp_replace(label, '[^A-Za-z0-9._-]+', '_', 'g'), '_') safe_label from v) group by 1,2 having count(*) > 1""",
    "cells", ctes="v as (select sample_id, cell_type label from cells union all select sample_id, cell_type || '?' from cells)"))
def f1_collisions(t):
    v = t.cells.select("sample_id", "cell_type").union(t.cells.select("sample_id", F.concat("cell_type", F.lit("?"))))
    return K.sanitize_collisions(v)


@add("f2_f6_scalar_functions", duck("""
select l_orderkey, l_linenumber, round(case when l_linenumber = 4 then null else l_quantity / (l_linenumber - 4) end, 6) ratio,
 round(case when l_linenumber = 4 then null else 100*l_quantity / (l_linenumber - 4) end, 6) pct,
 greatest(least(l_partkey + 50, l_suppkey + 80) - greatest(l_partkey, l_suppkey), 0) shared, round(greatest(least(l_partkey + 50, l_suppkey + 80) - greatest(l_partkey, l_suppkey), 0) / 50.0, 6) fraction,
 l_partkey // 7 bin, l_partkey % 7 = 0 aligned, upper(l_linestatus || l_returnflag) like 'OR%' or upper(l_linestatus || l_returnflag) like 'FA%' has_prefix,
 round(case when l_linenumber = 1 then null else greatest(least(l_quantity - 25, 10), -10) end, 6) clipped from lineitem"""))
def f2_f6(t):
    c = F.col
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(C.safe_ratio("l_quantity", c("l_linenumber") - 4), 6).alias("ratio"),
        F.round(C.safe_percent("l_quantity", c("l_linenumber") - 4), 6).alias("pct"),
        C.overlap_length("l_partkey", c("l_partkey") + 50, "l_suppkey", c("l_suppkey") + 80).cast("long").alias("shared"),
        F.round(C.overlap_fraction("l_partkey", c("l_partkey") + 50, "l_suppkey", c("l_suppkey") + 80), 6).alias("fraction"),
        C.bin_index("l_partkey", 7).alias("bin"), C.is_bin_aligned("l_partkey", 7).alias("aligned"),
        C.has_any_prefix(F.concat("l_linestatus", "l_returnflag"), ["or", "Fa"]).alias("has_prefix"),
        F.round(C.clip(F.when(c("l_linenumber") != 1, c("l_quantity") - 25), 10), 6).alias("clipped"),
    )


@add("f7_digests", duck("""select c_custkey, sha256(c_name) sha256, md5(c_name) md5 from customer"""))
def f7(t):
    return t.customer.select("c_custkey", C.sha256_hex("c_name").alias("sha256"), C.md5_hex("c_name").alias("md5"))


@add("f8_weight_tag", duck("""
select distinct l_discount, l_tax, replace(printf('%g', l_discount), '.', 'p') tag, replace(printf('%g', l_tax), '.', 'p') tax_tag, replace(printf('%g', l_quantity/64), '.', 'p') tag64 from lineitem"""))
def f8(t):
    return t.lineitem.select(
        "l_discount", "l_tax", C.weight_tag("l_discount").alias("tag"), C.weight_tag("l_tax").alias("tax_tag"), C.weight_tag(F.col("l_quantity") / 64).alias("tag64")
    ).distinct()


@add("f9_split_and_join_labels", duck("""
select cell_id, len(l) n, array_to_string(list_sort(l), ',') joined from (
 select cell_id, list_filter(string_split(cell_type || ',,' || coalesce(cohort, '') || ',' || leiden, ','), lambda v: v <> '') l from annotation)""", "annotation"))
def f9(t):
    labels = C.split_labels(F.concat("cell_type", F.lit(",,"), F.coalesce("cohort", F.lit("")), F.lit(","), "leiden"))
    return t.annotation.select("cell_id", F.size(labels).cast("long").alias("n"), C.join_labels(labels).alias("joined"))


@add("f10_label_codes", duck("""
select cell_id, cell_type, coalesce(code, -1) code from annotation a left join (select label, row_number() over (order by label) - 1 code from (
 select distinct trim(cell_type) label from annotation where lower(trim(cell_type)) not in ('','na','unassigned'))) on label = trim(cell_type)""", "annotation"))
def f10(t):
    return K.label_codes(t.annotation.select("cell_id", "cell_type"))


@add("f11_condition_fallback", duck("select cell_id, coalesce(cohort, sample, split_part(cell_id,'_',1)) condition from annotation", "annotation"))
def f11(t):
    return t.annotation.select("cell_id", C.first_present("cohort", "sample", F.split("cell_id", "_", 2)[0]).alias("condition"))
