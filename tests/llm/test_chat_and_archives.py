"""Prefix tree and archive conversion: exact round trips."""

import pytest

from cellspan.llm import arc_convert, chat_tree
from cellspan.plans.storage import scratch_path


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, node string, position int")


ROWS = [(c, t, r, x, "clash", 1) for c, t, r, x in [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi < there \\"), (1, 2, "user", "a"), (2, 0, "user", "hello"), (2, 1, "assistant", "hi < there \\"),
    (2, 2, "user", "b"), (3, 0, "user", "hello"), (3, 1, "assistant", "other"), (4, 0, "user", "hello"), (5, 0, "user", None), (5, 1, None, ""),
    (6, 0, "assistant", "</turn>\n<turn assistant>\n"), (6, 0, "assistant", "</turn>\n<turn assistant>\n"), (None, 3, "user", "stray"), (7, None, "assistant", "漢字 " * 300),
]]


def test_tree_round_trip(spark):
    path = scratch_path(spark, "t")
    chat_tree.write_tree(conversations(spark, ROWS), path)
    got = {r["conv_id"]: r for r in chat_tree.read_conversations(spark, path).collect()}
    for conv in {r[0] for r in ROWS}:
        want = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in ROWS if r[0] == conv))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [w[2:] for w in want]
        assert got[conv]["loss_text"] == "".join(w[3] for w in want if w[2] == "assistant")


def test_tree_shares_and_attends(spark):
    path = scratch_path(spark, "t")
    chat_tree.write_tree(conversations(spark, ROWS), path)
    nodes = {bytes(r["node"]): r for r in spark.read.parquet(f"{path}/nodes").collect()}
    assert sum(r["n_conversations"] == 4 for r in nodes.values()) == 1  # "hello" once for four conversations
    ordered = sorted(nodes.values(), key=lambda r: r["start"])
    at = 0
    for r in ordered:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    for r in nodes.values():
        chain, parent = [], bytes(r["parent"])
        while parent:
            p = nodes[parent]
            chain.insert(0, (p["start"], p["start"] + p["n_tokens"]))
            parent = bytes(p["parent"])
        assert [(x["from"], x["to"]) for x in r["attends"]] == chain and r["position"] == sum(b - a for a, b in chain)
        assert r["depth"] == len(chain)
    # depth first: a subtree is one stretch of the stream
    for r in nodes.values():
        under = [n for n in ordered if any(x["from"] == r["start"] for x in n["attends"]) or n is r]
        first = ordered.index(under[0])
        assert ordered[first : first + len(under)] == under


def test_tree_of_nothing(spark):
    path = scratch_path(spark, "t")
    chat_tree.write_tree(conversations(spark, []), path)
    assert chat_tree.read_conversations(spark, path).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "<>\\l\\g", "</turn>", "\\### Assistant: </turn> ok"])
def test_escape(text):
    assert chat_tree.unescape(chat_tree.escape(text)) == text and "<" not in chat_tree.escape(text)


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, version):
    rows = [(1, "http://a/ b", "same"), (2, "http://b/", "same"), (3, None, None), (4, "http://c/", ""), (5, "http://d/", "x\r\n\r\nWARC/1.0\r\n" * 3),
            (None, "http://e/", "é" * 9000), (6, "http://f/", "sole"), (7, "http://f/", "same"), (7, "http://f/", "same"), (-8, "u", "neg")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, payload string")
    path = scratch_path(spark, "t")
    arc_convert.write_arc(pages, f"{path}/arc", version)
    arc_convert.convert(spark, f"{path}/arc", f"{path}/warc")
    back = arc_convert.with_referred_page(arc_convert.read_warc(spark, f"{path}/warc")).collect()
    assert len(back) == len(rows)
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    for r in back:
        want = payload[r["page_id"]]
        assert r["payload_digest"] == arc_convert.sha1_base32(want) and r["payload_bytes"] == len(want)
        assert r["warc_type"] == "revisit" or bytes(r["payload"]) == want
    kinds = sorted((r["page_id"] or 0, r["warc_type"], r["refers_to"]) for r in back if r["warc_type"] == "revisit")
    assert kinds == [(1, "revisit", 7), (2, "revisit", 7), (3, "revisit", 4), (7, "revisit", 7)]
    large = f"{path}/large"
    arc_convert.convert(spark, f"{path}/arc", large, min_bytes=5)
    assert arc_convert.read_warc(spark, large).where("warc_type = 'revisit'").count() == 0
    empty = f"{path}/empty"
    arc_convert.write_arc(pages.limit(0), f"{empty}/arc", version)
    arc_convert.convert(spark, f"{empty}/arc", f"{empty}/warc")
    assert arc_convert.read_warc(spark, f"{empty}/warc").count() == 0


def test_malformed_archives_raise():
    good = arc_convert.version_block("x", 1) + b"\nhttp://a/ 1.1.1.1 20200101000000 text/html 5\nhello\n"
    assert [c for _, _, c in arc_convert.arc_records(good)] == [b"hello"]
    for bad in (good[:-4], good.replace(b"html 5", b"html five"), good.replace(b"\n1 0", b"\n9 0")):
        with pytest.raises(ValueError):
            list(arc_convert.arc_records(bad))
    with pytest.raises(ValueError):
        list(arc_convert.warc_records(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nab\r\n\r\n"))
