"""Order summaries of splits against a walk through the file."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspan.operators import preflight as P
from cellspan.sources.text import read_lines


def walked(lines):
    counts, last = {}, None
    for chrom, pos in lines:
        c = counts.setdefault(chrom, [0, 0])
        if last is None or last[0] != chrom:
            c[1] += 1
        elif pos < last[1]:
            c[0] += 1
        last = (chrom, pos)
    return {k: tuple(v) for k, v in counts.items() if v[0] or v[1] > 1}


@pytest.mark.parametrize("split", [100, 1_000, 128_000_000])
def test_summaries_stitch_to_the_whole_file(spark, tmp_path, split):
    rng = np.random.default_rng(9)
    want = {}
    for name, chroms, descents in (("good", 3, 0), ("turns", 3, 9), ("back", 6, 0), ("one", 1, 1)):
        lines = []
        for c in range(chroms):
            lines += [(f"chr{c % 3}", int(p)) for p in np.sort(rng.integers(1, 10_000, 80))]
        for i in rng.integers(1, len(lines), descents):
            lines[i] = (lines[i][0], 0)
        (tmp_path / f"{name}.tsv").write_text("".join(f"{c}\t{p}\n" for c, p in lines))
        want |= {(name, k): v for k, v in walked(lines).items()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        parts = F.split("line", "\t")
        lines = read_lines(spark, str(tmp_path)).select(
            F.regexp_extract("path", "/([a-z]+).tsv", 1).alias("path"), "__block", parts[0].alias("chrom"), parts[1].cast("bigint").alias("pos"))
        summaries = P.order_summaries(lines)
        assert "Exchange" not in summaries._jdf.queryExecution().executedPlan().toString()
        got = {(r["path"], r["chrom"]): (r["unsorted"], r["blocks"]) for r in P.stitched_site_check(summaries).collect()}
        if split < 1_000:
            assert summaries.select("path", "block").distinct().count() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want and got
