"""Queries over vectors: factorisation, neighbours, communities, batches, missingness."""

from pyspark.sql import functions as F

from cellspan.catalog.base import duck, registry
from cellspan.operators import batch as B
from cellspan.operators import expression as X
from cellspan.operators import graph as G
from cellspan.operators import linalg as L
from cellspan.operators import matrices as MX
from cellspan.operators import methylation as M
from cellspan.operators import neighbors as N
from cellspan.operators import quality as Q
from cellspan.catalog.interval_queries import _COUNTS, region_counts, stored_counts
from cellspan.catalog.expression_queries import values
from cellspan.catalog.methylation_queries import scores
from cellspan.plans.guards import checked

add = registry.add


def r(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@add("m11_pca")
def m11(t):
    scores, _ = L.pca(t.embedding.select("cell_id", "vec"), 10)
    return scores.select("cell_id", F.transform("vec", lambda x: F.round(x, 5)).alias("vec"))


@add("m11_pca_expression")
def m11_expression(t):
    v = values(t)
    vectors = X.scale_genes(v, v.select("cell_id").distinct(), X.highly_variable_genes(v, 50))
    scores, _ = L.pca(vectors, 10)
    return scores.select("cell_id", F.transform("vec", lambda x: F.round(x, 5)).alias("vec"))


@add("m12_pca_impute")
def m12(t):
    # coordinates close to zero count as unobserved
    gaps = t.embedding.select("cell_id", F.transform("vec", lambda x: F.when(F.abs(x) >= 0.01, x)).alias("vec"))
    filled, _ = L.pca_impute(gaps, 5, 4)
    return filled.select("cell_id", F.transform("vec", lambda x: F.round(x, 5)).alias("vec"))


@add("m13_lsi")
def m13(t):
    hits = scores(t.store("sites")).where("score >= 0.95").select("cell_id", "feature_id")
    out, _ = L.lsi(hits, t.cells.select("cell_id"), 10)
    return out.select("cell_id", F.transform("vec", lambda x: F.round(x, 4)).alias("vec"))


@add("m13_tf_idf", duck("""
select cell_id, feature_id, round(ln(1 + 1e5/count(*) over (partition by cell_id)) * ln(1 + (select count(distinct cell_id) from sites)::double/count(*) over (partition by feature_id)), 6) weight from counts""", "cg", "regions", ctes=_COUNTS))
def m13_weights(t):
    t.store("sites")
    return r(L.tf_idf(region_counts(t).select("cell_id", "feature_id"), t.cells), 6, "weight")


_KS = """
e as (select vec_id, unnest(embedding)::double x, generate_subscripts(embedding, 1) - 1 i from embeddings),
two as (select i component, x, 1 d from e union all select i - 1, x, -1 from e where i > 0),
cum as (select component, abs(sum(d) over (partition by component order by x range unbounded preceding)) g from two),
st as (select component, max(g)::double / (select count(*) from embeddings) statistic from cum where component < (select max(i) from e) group by 1),
lam as (select *, (sqrt((select count(*) from embeddings)/2.0) + 0.12 + 0.11/sqrt((select count(*) from embeddings)/2.0))*statistic l from st),
ks as (select component, statistic, case when l < 0.2 then 1.0 else least(1, greatest(0, (select sum(2*power(-1, k-1)*exp(-2*k*k*l*l)) from range(1, 21) z(k)))) end p_value from lam)"""


@add("m14_component_ks", duck("select component, round(statistic, 6) statistic, round(p_value, 6) p_value from ks", ctes=_KS))
def m14(t):
    return r(L.component_ks(t.embedding), 6, "statistic", "p_value")


@add("m14_significant_components", duck("select coalesce(min(component) filter (p_value > 0.1), max(component) + 1)::bigint n_components from ks", ctes=_KS))
def m14_count(t):
    return L.significant_components(L.component_ks(t.embedding), 0.1)


_KNN = """
kn as (select src, dst, rank, dist from (select a.vec_id src, b.vec_id dst, round(list_distance(a.embedding::double[], b.embedding::double[]), 9) dist,
 row_number() over (partition by a.vec_id order by round(list_distance(a.embedding::double[], b.embedding::double[]), 9), b.vec_id) rank
 from embeddings a join embeddings b on a.vec_id <> b.vec_id) where rank <= 15)"""


@add("m15_knn", duck("select src, dst, rank, round(dist, 6) dist from kn", ctes=_KNN))
def m15(t):
    return r(N.knn(t.embedding.select("cell_id", "vec"), 15), 6, "dist")


@add("m15_knn_projected", duck("select count(*) cells, count(*) * 15 edges, true recall_reached, true recall_told from embeddings"))
def m15_projected(t):
    """Projected edges against the exact ones: their number, the share found, and whether the sampled estimate came near it."""
    points = t.embedding.select("cell_id", "vec")
    edges, told = N.knn_projected(points, 15, tables=4, block=128)
    exact = N.knn(points, 15).select("src", "dst", F.lit(1).alias("true"))
    both = edges.join(exact, ["src", "dst"], "left").agg(
        F.count_distinct("src").alias("cells"), F.count("*").alias("edges"), (F.sum("true") / F.count("*")).alias("recall"))
    return both.select("cells", "edges", (F.col("recall") >= 0.93).alias("recall_reached"), (F.abs(F.col("recall") - told) <= 0.05).alias("recall_told"))


_LP = _KNN + """,
me as (select a.src, a.dst, 1/(1+a.dist) w from kn a join kn b on a.src=b.dst and a.dst=b.src),
l0 as (select vec_id node, vec_id lab from embeddings)""" + "".join(f""",
l{i} as (select node, first(lab order by v desc, lab) lab from (select node, lab, round(sum(w), 6) v from (
 select src node, lab, w from me join l{i-1} on node = dst union all select node, lab, 0.5 from l{i-1}) group by 1,2) group by 1)""" for i in range(1, 6))


@add("m16_graph_communities", duck("select node cell_id, c \"cluster\" from l5 join (select lab, row_number() over (order by count(*) desc, lab) - 1 c from l5 group by 1) using (lab)", ctes=_LP))
def m16(t):
    edges = N.mutual_edges(N.knn(t.embedding.select("cell_id", "vec"), 15))
    return G.graph_communities(edges, t.embedding.select("cell_id"), 5)


@add("m16_modularity", duck("""
select g resolution, round(sum(i) / sum(w) - g * sum(w * w) / (sum(w) * sum(w)), 6) modularity
from (select a.lab, sum(w) w, sum(case when a.lab = b.lab then w else 0 end) i from me join l5 a on a.node = src join l5 b on b.node = dst group by 1)
cross join (select unnest([0.5::double, 0.8, 1.0, 2.0]) g) group by 1""", ctes=_LP))
def m16_modularity(t):
    """How good the propagated communities are, at four resolutions."""
    edges = N.mutual_edges(N.knn(t.embedding.select("cell_id", "vec"), 15))
    found = G.graph_communities(edges, t.embedding.select("cell_id"), 5)
    return r(G.modularity(edges, found, [0.5, 0.8, 1.0, 2.0]), 6, "modularity")


@add("m17_consensus_communities")
def m17(t):
    edges = N.mutual_edges(N.knn(t.embedding.select("cell_id", "vec"), 15))
    return r(G.consensus_communities(edges, t.embedding.select("cell_id"), repeats=10, iterations=4, min_size=3), 6, "agreement")


@add("m20_doublet_scores")
def m20(t):
    return r(B.doublet_scores(t.rna, expected_rate=0.06, components=10, genes=60), 6, "doublet_score")


@add("m21_harmonize")
def m21(t):
    e = t.embedding.select("cell_id", F.col("label").cast("string").alias("batch"), "vec")
    return B.harmonize(e, max_rounds=5).select("cell_id", "batch", F.transform("vec", lambda x: F.round(x, 4)).alias("vec"))


@add("m22_train_validation_split", duck("""
select cell_id, case when row_number() over (order by md5(cell_id || '|3'), cell_id) <= round((select count(*) from cells)*0.1) then 'validation' else 'train' end split from cells""", "cells"))
def m22(t):
    return B.train_validation_split(t.cells, 0.1, 3)


_MISS = _COUNTS.strip() + """,
nc as (select count(*)::double n from cells),
kr as (select feature_id, count(*) n from counts group by 1 having count(*)/(select n from nc) >= 0.012),
kc as (select cell_id, count(*) n from counts where feature_id in (select feature_id from kr) group by 1 having count(*) >= 12)"""


@add("p9_missingness_filter", duck("select * from counts where feature_id in (select feature_id from kr) and cell_id in (select cell_id from kc)", "cells", "cg", "regions", ctes=_MISS))
def p9(t):
    return MX.missingness_filter(stored_counts(t), t.cells, min_region_fraction=0.012, min_cell_regions=12)


@add("p9_guarded_missingness", duck("select * from counts where feature_id in (select feature_id from kr) and cell_id in (select cell_id from kc)", "cells", "cg", "regions", ctes=_MISS))
def p9_guarded(t):
    kept, guards = MX.guarded_missingness(stored_counts(t), t.cells, min_region_fraction=0.012, min_cell_regions=12)
    return checked(kept, *guards)


@add("p9_region_missingness_qc", duck("""
select feature_id, round(coalesce(n, 0)/(select n from nc), 6) observed_fraction, coalesce(n, 0)/(select n from nc) >= 0.012 pass from regions left join (select feature_id, count(*) n from counts group by 1) using (feature_id)""", "cells", "cg", "regions", ctes=_MISS))
def p9_regions(t):
    return r(MX.region_missingness(region_counts(t), t.regions, t.cells, 0.012), 6, "observed_fraction")


@add("p9_cell_missingness_qc", duck("""
select cell_id, coalesce(n, 0) n_observed, round(coalesce(n, 0)::double/greatest((select count(*) from kr), 1), 6) observed_fraction, coalesce(n, 0) >= 12 pass
from cells left join (select cell_id, count(*) n from counts where feature_id in (select feature_id from kr) group by 1) using (cell_id)""", "cells", "cg", "regions", ctes=_MISS))
def p9_cells(t):
    return r(MX.cell_missingness(stored_counts(t), t.cells, 0.012, 12), 6, "observed_fraction")


@add("s10_wide_matrix", duck("""
select r.chrom, r."start", r."end", feature_id, """ + ", ".join(f"""coalesce(max(case when s = 'S{i}' then v end), 'NA') "S{i}" """ for i in range(5)) + """
from (select split_part(cell_id, '_', 1) s, feature_id, cast(sum(mc) as varchar) v from counts group by 1,2) join regions r using (feature_id) group by 1,2,3,4""", "cg", "regions", ctes=_COUNTS))
def s10(t):
    per_sample = region_counts(t).groupBy(F.split("cell_id", "_")[0].alias("cell_id"), "feature_id").agg(F.sum("mc").cast("double").alias("value"))
    return MX.wide_matrix(per_sample, t.regions, [f"S{i}" for i in range(5)])


@add("s10_read_wide_matrix", duck("""
select split_part(cell_id, '_', 1) cell_id, feature_id, cast(sum(mc) as double) "value" from counts group by 1,2""", "cg", "regions", ctes=_COUNTS))
def s10_read(t):
    return MX.unpivot_matrix(s10(t))


@add("q6_branch_consistency", duck("""
select threshold, (select count(*) from cells) filtered_cells, m matrix_cells, k retained_cells, 0::bigint retained_outside, m = (select count(*) from cells) ids_equal, true retained_subset from (
 select '0.01' threshold, (select count(*) from cells) m, (select count(*) from kc) k union all select '0.02', (select count(distinct cell_id) from counts), (select count(*) from kc))""", "cells", "cg", "regions", ctes=_MISS))
def q6(t):
    counts = stored_counts(t)
    kept = MX.missingness_filter(counts, t.cells, min_region_fraction=0.012, min_cell_regions=12).select("cell_id").distinct()
    at = lambda df, x: df.select(F.lit(x).alias("threshold"), "cell_id")
    matrix = at(t.cells, "0.01").unionByName(at(counts.select("cell_id").distinct(), "0.02"))
    return Q.branch_consistency(matrix, t.cells, at(kept, "0.01").unionByName(at(kept, "0.02")))


@add("q5_drift_check", duck("""
select cell_id, cell_type, 'stored_only' drift from (select cell_id, cell_type from cells except select cell_id, trim(cell_type) from annotation)
union all select cell_id, cell_type, 'current_only' from (select cell_id, trim(cell_type) cell_type from annotation except select cell_id, cell_type from cells)""", "cells", "annotation"))
def q5(t):
    return Q.drift_check(t.cells.select("cell_id", "cell_type"), t.annotation.select("cell_id", F.trim("cell_type").alias("cell_type")))


@add("a18_dataset_fingerprint")
def a18(t):
    return MX.dataset_fingerprint(t.sites)


@add("a18_ordered_fingerprint", duck("""
select (select count(*) from sites) n_rows, sha256(string_agg(bucket || ':' || h, chr(10) order by bucket)) fingerprint from (
 select left(l, 3) bucket, sha256(string_agg(l || 'x' || n, '' order by l)) h from (select sha256(sample_id || chr(9) || chrom || chr(9) || cast(pos as varchar)) l, count(*) n from sites group by 1) group by 1)""", "sites"))
def a18_ordered(t):
    return MX.ordered_fingerprint(t.sites, ["sample_id", "chrom", "pos"])
