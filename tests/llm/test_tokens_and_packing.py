"""Planes and packing against the tokenizer library and plain Python."""

import json
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from cellspan.llm import best_fit, bit_planes, tokens
from cellspan.llm.common import table
from cellspan.llm.queries import op1_bit_planes, op4_best_fit
from cellspan.plans.storage import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain_ids():
    t = Tokenizer.from_file(tokens.byte_bpe_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(spark, plain_ids):
    texts = ["", " ", "a", "  x ", "a\n\nb c", "a \n b", "don't 's  it's\tq", "foo\nbar baz.\nqux a.\n b", "12,3. a1. _x #%&", "漢字 é, ñ!",
             "a b c", "<|endoftext|> x", "w" * 300 + " y", "a. b. a, b, a", "x\x1c y \x85 z"]
    texts += [r["text"] for r in table(spark, SF, "documents").limit(60).collect()]
    e = tokens.TextEncoder(tokens.byte_bpe_path())
    for batch in (texts, texts[::-1]):
        for text, ids in zip(batch, e.encode_many(batch), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain_ids(text)


def test_encoder_of_odd_neighbours(plain_ids):
    rng = np.random.default_rng(5)
    parts = [*" \n\t\u00a0\u2009\u3000\x1c\x85\r", *"abZé×÷ßǅɏɐʰ漢ñ١7'.,!)(\"#*-_|", "'s", "'ll", " ", "\n", " "]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(4000)]
    e = tokens.TextEncoder(tokens.byte_bpe_path())
    for at in (0, 500, 501, 4000):  # alone, together, and again from the pieces remembered
        for text, ids in zip(texts[:at] or texts[:1], e.encode_many(texts[:at] or texts[:1]), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain_ids(text), repr(text)


def test_encoder_forgets_old_pieces_and_keeps_ids(plain_ids, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 8)
    e = tokens.TextEncoder(tokens.byte_bpe_path())
    for turn in range(30):
        text = f"same words, new w{turn} and x{turn // 3}.\nEnd"
        assert np.frombuffer(e.encode_many([text])[0], dtype="<u4").tolist() == plain_ids(text)
        assert len(e._young) < 30


def test_other_splitting_rules_get_whole_texts(tmp_path):
    known = json.loads(Path(tokens.byte_bpe_path()).read_text(encoding="utf-8"))
    known["pre_tokenizer"]["use_regex"] = False  # pieces may now join a space to the word before it
    path = tmp_path / "other.json"
    path.write_text(json.dumps(known), encoding="utf-8")
    texts = ["a b. c\nd", "of the, of the"]
    library = Tokenizer.from_file(str(path))
    for text, ids in zip(texts, tokens.TextEncoder(str(path)).encode_many(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_planes_round_trip(unit):
    ids = np.random.default_rng(0).integers(0, 2**32, 1001, dtype=np.uint64).astype("<u4")
    assert (bit_planes.from_planes(bit_planes.to_planes(ids, unit), len(ids), unit) == ids).all()


def test_op1_against_plain(spark, plain_ids):
    start = 0
    got = {r["doc_id"]: r for r in op1_bit_planes(spark, SF).collect()}
    for r in table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = np.array([*plain_ids(r["text"]), 0], dtype="<u4")
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_planes_of_odd_documents(spark, odd_docs, plain_ids, unit):
    path = scratch_path(spark, "t")
    bit_planes.write_planes(odd_docs, path, chunk_ids=64, unit=unit)  # documents span many chunks
    got = sorted((r["start"], r["doc_id"], np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in bit_planes.read_ids(spark, path).collect())
    want = sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in odd_docs.collect()))
    assert [(-1 if d is None else d, ids) for _, d, ids in got] == [(d, [*plain_ids(t), 0]) for d, t in want]
    assert [s for s, _, _ in got] == np.cumsum([0, *(len(ids) for _, _, ids in got)])[:-1].tolist()
    index = spark.read.parquet(f"{path}/index").orderBy("first_id").collect()
    assert index[0]["first_id"] == 0 and sum(r["n_ids"] for r in index) == sum(len(ids) for _, _, ids in got)


def test_planes_of_nothing(spark, no_docs):
    path = scratch_path(spark, "t")
    bit_planes.write_planes(no_docs, path)
    assert bit_planes.read_digests(spark, path).count() == 0


def check_packing(rows, capacity):
    room = defaultdict(list)
    for r in rows:
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(room)


def test_op4_against_plain(spark, plain_ids):
    rows = op4_best_fit(spark, SF).collect()
    n = check_packing(rows, 1024)
    assert n <= 1.01 * -(-sum(r["length"] for r in rows) // 1024) + 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for d in table(spark, SF, "documents").collect():
        ids = np.array([*plain_ids(d["text"]), 2], dtype="<u4")
        at, parts = 0, sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])
        assert [p["length"] for p in parts] == best_fit.cut_lengths(len(ids), 1024)
        for p in parts:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)


def test_rounds_equal_sequential_best_fit():
    rng = np.random.default_rng(3)
    for capacity in (10, 64):
        for _ in range(30):
            lengths = sorted(rng.integers(1, capacity + 1, 200).tolist(), reverse=True)
            gaps = []
            for x in lengths:  # one document after the other
                fit = [g for g in gaps if g >= x]
                if fit:
                    gaps.remove(min(fit))
                gaps.append((min(fit) if fit else capacity) - x)
            counts = {x: lengths.count(x) for x in lengths}
            plan = best_fit.match_rounds(counts, capacity)
            placed = [(s + k // per, off + (k % per) * x, x) for x, a, b, per, s, off in plan for k in range(b - a)]
            assert sorted(x for *_, x in placed) == sorted(lengths)
            used = check_packing([{"sequence_id": s, "offset": o, "length": x} for s, o, x in placed], capacity)
            assert used == len(gaps)


def test_packing_odd_documents(spark, odd_docs, no_docs, plain_ids):
    pieces = best_fit.stored(best_fit.token_pieces(odd_docs, capacity=16, with_ids=True), "t")
    placed = best_fit.pack(pieces, 16)
    rows = placed.collect()
    check_packing(rows, 16)
    assert len([r for r in rows if r["doc_id"] == 6]) == 2 * len([r for r in rows if r["doc_id"] == 5])
    sequences = best_fit.packed_sequences(placed).collect()
    assert all(len(r["ids"]) == 4 * r["length"] <= 64 for r in sequences)
    assert sum(r["length"] for r in sequences) == sum(len(plain_ids(r["text"])) + 1 for r in odd_docs.collect())
    assert best_fit.pack_documents(no_docs).count() == 0
