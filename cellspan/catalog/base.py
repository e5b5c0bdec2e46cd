"""Domain tables derived from the driver tables, once for Spark and once as SQL for the oracle.

The mapping only renames and recombines columns; every query runs over whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.plans.storage import stored

# {div}: integer division; {str}: text type. The two engines differ in nothing else here.
_SITES = """
select concat('S', cast(c.c_nationkey % 5 as {str})) sample_id,
 concat('S', cast(c.c_nationkey % 5 as {str}), '_', cast(c.c_custkey as {str})) cell_id,
 c.c_mktsegment cell_type,
 concat('chr', cast(l.l_partkey % 5 + 1 as {str})) chrom,
 1 + (l.l_partkey {div} 5)*50 + (l.l_linenumber*7) % 50 pos,
 case l.l_returnflag when 'N' then 'CHN' else 'CGN' end context,
 (cast(l.l_quantity as bigint) * case when ((l.l_partkey {div} 100) + ascii(c.c_mktsegment)) % 5 = 0 then 20
   else 60 + (l.l_suppkey*13 + l.l_partkey*7) % 41 end) {div} 100 mc,
 cast(l.l_quantity as bigint) cov
from lineitem l join orders o on l.l_orderkey=o.o_orderkey join customer c on o.o_custkey=c.c_custkey
"""

_RNA_KEYS = """concat('S', cast(c.c_nationkey % 5 as {str}), '_', cast(c.c_custkey as {str})) cell_id,
 concat('S', cast(c.c_nationkey % 5 as {str})) sample_id, c.c_mktsegment cell_type,
 concat(case when l.l_partkey % 300 < 13 then 'MT-' when l.l_partkey % 300 < 60 then 'RPL' else 'GENE' end,
   cast(l.l_partkey % 300 as {str})) gene"""

_RNA_READS = """cast(l.l_quantity as bigint) * case when (l.l_partkey % 300) {div} 60 = ascii(c.c_mktsegment) % 5
   then 3 else 1 end"""

_RNA_FROM = """
from lineitem l join orders o on l.l_orderkey=o.o_orderkey join customer c on o.o_custkey=c.c_custkey
"""

_RNA = f"""
select {_RNA_KEYS},
 cast(sum({_RNA_READS}) as bigint) {{q}}count{{q}}{_RNA_FROM}group by 1,2,3,4
"""

# Spark deals the lines by cell once; their sums, and windows over a cell's genes, stay there
_RNA_BY_CELL = f"""
select cell_id, sample_id, cell_type, gene, cast(sum(reads) as bigint) {{q}}count{{q}} from (
 select /*+ repartition(cell_id) */ {_RNA_KEYS},
 {_RNA_READS} reads{_RNA_FROM}) group by 1,2,3,4
"""

_ANNOTATION = """
select concat('S', cast(c_nationkey % 5 as {str}), '_', cast(c_custkey as {str})) cell_id,
 case when c_acctbal > 9000 then 'NA' when c_acctbal > 8500 then ' Unassigned ' when c_acctbal > 8000 then ''
   else c_mktsegment end cell_type,
 cast(c_nationkey {div} 5 as {str}) leiden,
 case when c_acctbal > 2000 then concat('cohort', cast(c_nationkey {div} 13 as {str})) end cohort,
 case when c_acctbal > 1000 then concat('S', cast(c_nationkey % 5 as {str})) end sample
from customer where c_acctbal >= 0
"""

_CHROM_ORDER = """
select concat('chr', cast(r_regionkey + 1 as {str})) chrom, cast(1000000 as bigint) size,
 case r_regionkey when 0 then 2 when 1 then 1 when 2 then 3 when 3 then 5 else 4 end {q}rank{q} from region
"""

# chromosomes for tiling reach past the last site: the declared size fits the small tables only
_GENOME = """
select concat('chr', cast(r_regionkey + 1 as {str})) chrom,
 greatest(cast(1000000 as bigint), (select (max(l_partkey) {div} 100 + 1)*1000 from lineitem)) size from region
"""

_REGIONS = """
select chrom, s + (s {div} 300) % 7 * 10 as {q}start{q}, s + (s {div} 300) % 7 * 10 + 180 as {q}end{q},
 concat(chrom, '_', cast(s as {str})) feature_id,
 cast(s {div} 300 % 7 as double) peak_var, s {div} 300 % 11 n_cpg, s {div} 300 % 5 n_obs_cells
from (select distinct chrom, ((pos-1) {div} 300)*300 s from sites) t
"""

_BLACKLIST = """
select distinct chrom, ({q}start{q} {div} 2000)*2000 + 900 {q}start{q}, ({q}start{q} {div} 2000)*2000 + 1050 {q}end{q}
from regions
"""

_DMR_WINDOWS = """
select sample_id, cell_type, chrom, (pos-1) {div} 500 w, cast(sum(mc) as bigint) mc, cast(sum(cov) as bigint) cov
from sites where context like 'CG%' group by 1,2,3,4
"""

_DMR = """
select a.sample_id, concat(a.cell_type, '_vs_', b.cell_type) comparison, a.cell_type cell_type_a, b.cell_type cell_type_b,
 a.chrom, a.w*500 + (a.cov + b.cov) % 400 {q}start{q}, a.w*500 + (a.cov + b.cov) % 400 + 60 + (a.mc + b.mc) % 100 {q}end{q},
 cast(a.mc as double)/a.cov meth_a, cast(b.mc as double)/b.cov meth_b,
 case when cast(a.mc as double)/a.cov < cast(b.mc as double)/b.cov then 'group_A' else 'group_B' end low_group,
 cast((a.mc*7 + b.mc*11) % 200 as double)/10000 raw_p
from dmr_windows a join dmr_windows b
 on a.sample_id=b.sample_id and a.chrom=b.chrom and a.w=b.w and a.cell_type < b.cell_type
"""

_SOURCES = {
    "sites": (_SITES, ()),
    "rna": (_RNA, ()),
    "annotation": (_ANNOTATION, ()),
    "chrom_order": (_CHROM_ORDER, ()),
    "genome": (_GENOME, ()),
    "regions": (_REGIONS, ("sites",)),
    "blacklist": (_BLACKLIST, ("regions",)),
    "dmr_windows": (_DMR_WINDOWS, ("sites",)),
    "dmr": (_DMR, ("dmr_windows",)),
    "cells": ("select distinct cell_id, sample_id, cell_type from sites", ("sites",)),
    "cg": ("select * from sites where context like 'CG%'", ("sites",)),
}

_SPARK_SOURCES = {"rna": (_RNA_BY_CELL, ())}

# the order list is joined to its customers first, so that the lines are exchanged once and not again by customer
_LINES_FIRST = "orders o on l.l_orderkey=o.o_orderkey join customer c on o.o_custkey=c.c_custkey"
_ORDERS_FIRST = "(select o.o_orderkey, c.* from orders o join customer c on o.o_custkey=c.c_custkey) c on l.l_orderkey=c.o_orderkey"

_TABLES = ("region", "nation", "customer", "lineitem", "orders", "embeddings", "events", "documents")


class Tables:
    """Lazy domain tables over one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in _TABLES:
            return self.raw(name)
        if name not in _SOURCES:
            raise AttributeError(name)
        text, needs = _SPARK_SOURCES.get(name, _SOURCES[name])
        text = text.format(div="div", str="string", q="`").replace(_LINES_FIRST, _ORDERS_FIRST)
        views = {}
        for word in (*needs, *_TABLES):
            if f" {word}" in text:
                # args-by-name keeps the session catalog free of temporary views
                views[word] = getattr(self, word)
        for word in views:
            text = _bind(text, word)
        frame = self.spark.sql(text, **views) if views else self.spark.sql(text)
        self.__dict__[name] = frame
        return frame

    def store(self, *names: str) -> Tables:
        """Derive the named tables once for a query that reads them several times, also through the tables made from them."""
        for name in names:
            self.__dict__[name] = stored(getattr(self, name))
        return self

    @cached_property
    def embedding(self) -> DataFrame:
        """``(cell_id, vec array<double>, label)``."""
        return self.embeddings.select(
            F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("vec"), "label"
        )


def _bind(text: str, table: str) -> str:
    for lead in ("from ", "join "):
        text = text.replace(f"{lead}{table} ", f"{lead}{{{table}}} ").replace(f"{lead}{table})", f"{lead}{{{table}}})")
        text = text.replace(f"{lead}{table}\n", f"{lead}{{{table}}}\n")
        if text.endswith(f"{lead}{table}"):
            text = text[: -len(table)] + f"{{{table}}}"
    return text


def duck(body: str, *needs: str, ctes: str = "") -> str:
    """DuckDB text: WITH the needed domain tables (and their sources), extra ``ctes``, then ``body``."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _SOURCES[name][1]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    parts = [f"{n} as ({_SOURCES[n][0].format(div='//', str='varchar', q=chr(34)).strip()})" for n in order]
    if ctes:
        parts.append(ctes.strip().rstrip(","))
    # "with recursive" is only needed by iterative oracles and harmless otherwise
    return ("with recursive " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


class Registry:
    """Query functions and their oracle texts, collected by decorators."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None):
        def register(build):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return build(Tables(spark, sf_dir))

            run.__name__ = name
            run.__doc__ = build.__doc__
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = run
            if oracle is not None:
                self.oracles[name] = oracle
            return build

        return register


registry = Registry()
