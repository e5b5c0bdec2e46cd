"""The corpus operators as named queries over the driver tables, and DuckDB twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspan.llm import (
    adaptive_rules, arc_convert, best_fit, bit_planes, chat_tree, cover_tree, line_runs, near_copies, neighbour_quality, prefix_table,
    spot_signatures, structure_repair, temperature_mix,
)
from cellspan.llm.common import stored, table
from cellspan.plans.storage import scratch_path


def op1_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "planes")
    bit_planes.write_planes(table(spark, sf_dir, "documents"), path, end_id=0)
    return bit_planes.read_digests(spark, path)


def op2_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = adaptive_rules.judge(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"))


def op5_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edit_report(table(spark, sf_dir, "documents"))


def op6_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = temperature_mix.mix(table(spark, sf_dir, "documents"), entropy_share=0.97, max_repeats=4.0)
    return mixed.select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), "mix_weight", F.col("mix_epoch").alias("epoch"),
        F.col("mix_block").alias("block"), F.col("mix_order.block").alias("block_order"), F.col("mix_order.place").alias("place"),
    )


#: A conversation whose texts look like the markers of chat templates.
_HOSTILE = "\\### Assistant: </turn> ok"


def op8_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", _HOSTILE), (-7, 1, "assistant", _HOSTILE)], "conv_id bigint, turn bigint, role string, text string")
    path = scratch_path(spark, "chat-tree")
    chat_tree.write_tree(turns.unionByName(extra), path)
    back = chat_tree.read_conversations(spark, path)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.char_length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )


def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copy_components(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op10_arc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), scratch_path(spark, "archives")
    even = F.coalesce(F.col("page_id") % 2 == 0, F.lit(True))
    # legacy archives of both versions, together all pages
    arc_convert.write_arc(pages.where(even), f"{path}/arc/v1", 1)
    arc_convert.write_arc(pages.where(~even), f"{path}/arc/v2", 2)
    arc_convert.convert(spark, f"{path}/arc", f"{path}/warc")
    records = arc_convert.with_referred_page(arc_convert.read_warc(spark, f"{path}/warc", with_payload=False))
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = structure_repair.damage(table(spark, sf_dir, "conversations"))
    audits = structure_repair.audited(turns, dropped="dropped")
    found = structure_repair.repaired_digests(turns, audits, dropped="dropped")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op13_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(prefix_table.turn_rows(table(spark, sf_dir, "conversations")), "turn-digests")
    return prefix_table.prefix_nodes(prefix_table.rebuilt(turns)).drop("node")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (
        op1_bit_planes, op2_adaptive_rules, op3_line_runs, op4_best_fit, op5_spot_signatures, op6_neighbour_quality,
        op7_temperature_mix, op8_chat_tree, op9_near_copies, op10_arc_convert, op11_structure_repair,
        op12_cover_tree, op13_prefix_table, pipeline,
    )
    return {f.__name__: f for f in numbered}


_LINES = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos
  from documents),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from lines),
often as (
  select k, max(doc_id) keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
judged as (
  select x.*, (o.k is not null and x.doc_id <> o.keeper) dropped from keyed x left join often o on x.k = o.k)
select doc_id, count(*) n_lines, count(*) filter (where dropped) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) kept_sha256
from judged group by doc_id
"""

_CHAT = r"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized as (
  select *, length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) body,
    length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) head from turns)
select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) loss_sha256,
  cast(sum(6 + head + 2 + body + 9) as bigint) formatted_chars
from sized group by conv_id
"""

_NEAR = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
sets as (
  select doc_id, case when len(w) < 2 then w else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end s from words),
flat as (select doc_id, len(s) n, unnest(s) g from sets),
links as (
  select a.doc_id a, b.doc_id b from flat a join flat b on a.g = b.g and a.doc_id < b.doc_id and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  group by a.doc_id, b.doc_id having count(*) * 100 >= (any_value(a.n) + any_value(b.n) - count(*)) * 80),
edges as (select a, b from links union all select b, a from links),
reach as (select doc_id, doc_id r from documents union select reach.doc_id, edges.b from reach join edges on reach.r = edges.a)
select s.doc_id, cast(len(s.s) as bigint) n_shingles, min(r.r) component_id, min(r.r) = s.doc_id kept
from sets s join reach r on s.doc_id = r.doc_id group by s.doc_id, s.s
"""

_ARC = r"""
with payloads as (
  select page_id, encode(coalesce(html, '')) p, sha1(coalesce(html, '')) h from pages),
bits as (
  select page_id, octet_length(p) n, h, cast(cast(unhex(h) as bit) as varchar) b, max(page_id) over (partition by h) keeper from payloads)
select page_id, cast(n as bigint) payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + 16 * cast(substr(b, 5 * i + 1, 1) as int)
    + 8 * cast(substr(b, 5 * i + 2, 1) as int) + 4 * cast(substr(b, 5 * i + 3, 1) as int) + 2 * cast(substr(b, 5 * i + 4, 1) as int)
    + cast(substr(b, 5 * i + 5, 1) as int) as int), 1)), 'string_agg', '') payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end record_type, case when page_id <> keeper then keeper end refers_to
from bits
"""


def _crc32(value: str) -> str:
    """DuckDB text for the CRC-32 of an ASCII string."""
    letters = f"list_transform(range(1, length({value}) + 1), lambda i: cast(ascii(substr({value}, i, 1)) as bigint))"
    shifted = "list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: cast(0 as bigint))), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([cast(4294967295 as bigint)], {letters}), lambda c, b: {shifted}), 4294967295)"


_REPAIR = r"""
with recursive spaced as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') spot from conversations),
hit as (select *, CRC % 20 h from spaced),
damaged as (
  select conv_id, turn, case when h = 4 then 'user' else role end role,
    case when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text
  from (select *, unnest(range(case when h = 3 then 2 else 1 end)) copy from hit) where h <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) pos,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) bare from damaged),
faults as (
  select *, case when bare = '' then 'blank' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
      when right(bare, 1) not in ('.', '!', '?') then 'truncated' else '' end fault,
    left(role, 1) initial, lag(left(role, 1)) over (partition by conv_id order by pos) before from placed),
counts as (
  select conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where fault = 'blank') blank,
    count(*) filter (where fault = 'duplicate') duplicate, count(*) filter (where fault = 'truncated') truncated,
    count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) illegal from faults group by conv_id),
best as (
  select conv_id, n + 1 pos, {'c': 0, 'a': '', 'r': ''} f0, {'c': 6, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'} f1,
    {'c': 3, 'a': 'I', 'r': chr(10) || 'assistant:'} f2, {'c': 0, 'a': '', 'r': ''} f3 from counts
  union all
  select conv_id, pos, list_min([g0, {'c': 3 + f2.c, 'a': 'I' || f2.a, 'r': chr(10) || 'user:' || f2.r}]),
    list_min([g1, {'c': 3 + f2.c, 'a': 'I' || f2.a, 'r': chr(10) || 'user:' || f2.r}]), f2,
    list_min([g3, {'c': 3 + f2.c, 'a': 'I' || f2.a, 'r': chr(10) || 'user:' || f2.r}])
  from (
    select *, list_min([g2, {'c': 3 + g3.c, 'a': 'I' || g3.a, 'r': chr(10) || 'assistant:' || g3.r}]) f2 from (
      select f.conv_id, f.pos,
        list_min([GO(f0), case when stays and initial = 's' then KEEP(f1) when stays and initial = 'u' then KEEP(f2) end, case when stays then REROLE(f2, 'user:') end]) g0,
        list_min([GO(f1), case when stays and initial = 'u' then KEEP(f2) end, case when stays then REROLE(f2, 'user:') end]) g1,
        list_min([GO(f2), case when stays and initial = 'a' then KEEP(f3) end, case when stays then REROLE(f3, 'assistant:') end]) g2,
        list_min([GO(f3), case when stays and initial = 'u' then KEEP(f2) end, case when stays then REROLE(f2, 'user:') end]) g3
      from best join (
        select *, fault not in ('blank', 'duplicate') stays, case when fault = 'truncated' then 3 else 0 end late from faults) f
      on f.conv_id is not distinct from best.conv_id and f.pos = best.pos - 1))),
plans as (select conv_id, f0 from best where pos = 1)
select o.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
  coalesce(illegal, 0) illegal, cast(coalesce(f0.c, 0) as bigint) "cost", coalesce(f0.a, '') audit, sha256(coalesce(substr(f0.r, 2), '')) repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on o.conv_id is not distinct from c.conv_id
  left join plans p on o.conv_id is not distinct from p.conv_id
"""


def _repair_sql() -> str:
    text = _REPAIR.replace("CRC", _crc32("spot"))
    for x in ("f0", "f1", "f2", "f3"):
        text = text.replace(f"GO({x})", f"{{'c': 4 + {x}.c, 'a': 'D' || {x}.a, 'r': {x}.r}}")
        text = text.replace(f"KEEP({x})", f"{{'c': late + {x}.c, 'a': 'K' || {x}.a, 'r': chr(10) || role || ':' || text || {x}.r}}")
        for role in ("user:", "assistant:"):
            text = text.replace(f"REROLE({x}, '{role}')", f"{{'c': 3 + late + {x}.c, 'a': 'R' || {x}.a, 'r': chr(10) || '{role}' || text || {x}.r}}")
    return text


_PREFIXES = r"""
with own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) pos,
    coalesce(role, '') role, coalesce(text, '') text from conversations where conv_id is not null),
ids as (select *, CRC % 9 h from (select distinct conv_id, cast(conv_id as varchar) spot from conversations where conv_id is not null)),
built as (
  select o.conv_id, pos, role, text from own o join ids on o.conv_id = ids.conv_id where pos > h
  union all
  select ids.conv_id, pos, role, text from own o join ids on o.conv_id = ids.conv_id - ids.conv_id % 5 where pos <= h
  union all select conv_id, 0, null, null from ids),
placed as (select *, row_number() over (partition by conv_id order by pos) - 1 depth from built),
paths as (
  select conv_id, depth, coalesce(octet_length(encode(text)), 0) size, max(depth) over (partition by conv_id) last,
    coalesce(string_agg(length(role) || ':' || length(text) || ':' || role || text, '' order by depth) over (partition by conv_id order by depth), '') node from placed),
nodes as (select depth, node, min(conv_id) conv_id, count(*) n_convs, any_value(size) size,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where depth = last), '')) ends_sha256, max(last) = depth leaf
  from paths group by depth, node),
above as (select distinct a.depth, a.node, b.depth below_depth, b.node below from paths a join paths b on a.conv_id = b.conv_id and a.depth <= b.depth),
sums as (select a.depth, a.node, count(*) filter (where b.leaf) n_leaves, count(*) filter (where b.depth = a.depth + 1) n_children, sum((b.n_convs - 1) * b.size) saved
  from above a join nodes b on a.below_depth = b.depth and a.below = b.node group by a.depth, a.node),
parents as (select distinct b.depth, b.node, n.conv_id from paths a join paths b on a.conv_id = b.conv_id and a.depth = b.depth - 1 join nodes n on n.depth = a.depth and n.node = a.node)
select n.conv_id, n.depth, p.conv_id parent_conv_id, n_convs, n_children, n_leaves, cast(saved as bigint) saved_tokens, ends_sha256
from nodes n join sums s on n.depth = s.depth and n.node = s.node left join parents p on p.depth = n.depth and p.node = n.node
"""


_VECTORS = r"""
with recursive usable as (
  select vec_id, label, cast(embedding as double[]) v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id a, b.vec_id b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93),
reach as (select vec_id, vec_id r from embeddings union select reach.vec_id, links.b from reach join links on reach.r = links.a),
counts as (select a, count(*) n from links group by a)
select e.vec_id, coalesce(any_value(n), 0) n_links, min(r) component_id, min(r) = e.vec_id kept
from embeddings e left join reach on e.vec_id = reach.vec_id left join counts on counts.a = e.vec_id group by e.vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_line_runs": _LINES, "op8_chat_tree": _CHAT, "op9_near_copies": _NEAR, "op10_arc_convert": _ARC,
            "op11_structure_repair": _repair_sql(), "op12_cover_tree": _VECTORS,
            "op13_prefix_table": _PREFIXES.replace("CRC", _crc32("spot"))}
