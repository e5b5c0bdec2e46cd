"""Structure repair, prefix tables and cover trees against plain Python."""

import functools
import hashlib
import itertools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cellspan.llm import cover_tree, prefix_table, structure_repair
from cellspan.llm.common import table

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, signature string, node string, kind int"
BLANK = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def odd_turns(spark):
    """Null ids, turns, roles and texts, ties, repeated rows, other roles, a long conversation, clashing columns."""
    rows = [
        (1, 0, "user", "Hello."), (1, 1, "assistant", "Well"), (1, 1, "assistant", "Well"), (1, 3, "user", " \n"), (1, 7, "tool", "x!"),
        (2, None, "system", "Rules."), (2, None, None, None), (2, 5, "user", ""), (3, 2, "user", "Hello."), (3, 2, "User", "hello?"),
        (None, 1, "user", "lost."), (None, None, "assistant", "found"), (4, 1, "", "no role."), (5, 0, "system", "alone."), (6, 0, "user", "É 漢字!"),
        (7, 0, "assistant", "first."), (7, 1, "user", "then"), (8, 0, "user", "a." * 30_000), (10, 0, "user", "Hello."), (10, 1, "assistant", "Well"),
    ]
    rows += [(20, i, ("user", "assistant", "user")[i % 3], f"turn {i % 40}." if i % 7 else "cut") for i in range(300)]
    rows += [(c, i, r, "same.") for c in range(30, 60) for i, r in enumerate(("user", "assistant", "user"))]
    return spark.createDataFrame([(*r, "x", "y", "z", 3) for r in rows], TURNS)


def plain_best(rows):
    """Least (cost, audit, repaired) by trying every edit; rows are (role, text, fault)."""

    @functools.cache
    def best(i, state):
        # state: what the initials so far are, inserted rows in a row bounded by the grammar's period
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        return min(options + [o for o in steps(i, state)], key=lambda o: o[:2], default=(math.inf, "", ()))

    def follows(state, initial):
        return (state in ("", "s", "a") and initial == "u") or (state == "u" and initial == "a") or (state == "" and initial == "s")

    def moved(i, state, inserted):
        found = []
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, r = best(i + 1, state)
            found.append((c + 4, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                late = 3 if fault == "truncated" else 0
                if role[:1] and follows(state, role[0]):
                    c, a, r = best(i + 1, role[0])
                    found.append((c + late, "K" + a, (f"{role}:{text}", *r)))
                for given in ("user", "assistant"):
                    if follows(state, given[0]):
                        c, a, r = best(i + 1, given[0])
                        found.append((c + 3 + late, "R" + a, (f"{given}:{text}", *r)))
        elif state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for given in ("user", "assistant"):
                if follows(state, given[0]):
                    found += [(c + 3, "I" + a, (f"{given}:", *r)) for c, a, r in moved(i, given[0], inserted + 1)]
        return found

    def steps(i, state):
        return moved(i, state, 0)

    out = (0, "", ())
    for i in range(len(rows), -1, -1):  # fill from the end, so that no recursion runs deep
        for state in ("", "s", "u", "a"):
            out = best(i, state)
    return best(0, "")


def plain_repair(rows):
    """conv_id -> the report row; rows are (conv_id, turn, role, text)."""
    kept, known = defaultdict(list), set()
    word = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        known.add(conv)
        hit = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        if hit:
            kept[conv] += [(turn, role, text)] * (2 if hit == 3 else 1)
    out = {}
    for conv in known:
        part = sorted(kept[conv], key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest()))
        marked, seen, counts = [], set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in part:
            bare = text.rstrip(BLANK)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        turns = {t for t, _, _ in part if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, repaired = plain_best(marked)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def repaired(turns):
    damaged = structure_repair.damage(turns)
    audits = structure_repair.audited(damaged, dropped="dropped")
    found = structure_repair.repaired_digests(damaged, audits, dropped="dropped").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return damaged, audits, found


def test_repair_against_all_edits(spark, odd_turns):
    turns = odd_turns.unionByName(table(spark, SF, "conversations"), allowMissingColumns=True)
    plain = plain_repair([tuple(r)[:4] for r in turns.collect()])
    damaged, audits, found = repaired(turns)
    got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == plain
    lines = defaultdict(dict)
    for r in structure_repair.repaired_turns(damaged, audits, dropped="dropped").collect():
        lines[r["conv_id"]][r["position"]] = f"{r['role']}:{r['text']}"
    for conv, expected in plain.items():
        text = "\n".join(lines[conv][i] for i in range(len(lines[conv])))
        assert hashlib.sha256(text.encode()).hexdigest() == expected[-1]


def test_repair_shares_suffixes(spark, odd_turns):
    words = spark.createDataFrame([("uaua",), ("aua",), ("xua",), ("Suaua",), ("",), ("oxox",)], "signature string")
    plans = {r["signature"]: r for r in structure_repair.plan(words.coalesce(1)).collect()}
    assert plans[""]["cost"] == 0 and plans[""]["audit"] == "" and plans["uaua"]["audit"] == "KKKK"
    # aua, uaua and Suaua have five suffixes, xua adds one, oxox four
    assert sum(p["new_nodes"] for p in plans.values()) == 10
    assert plans["Suaua"]["cost"] == 3 and plans["aua"]["audit"] == "DKK" or plans["aua"]["audit"] == "IKKK"
    empty = odd_turns.limit(0)
    assert repaired(empty)[2].count() == 0
    assert structure_repair.audited(odd_turns.where("conv_id = 1")).first()["duplicate"] == 1


def plain_nodes(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = own
    if rebuild:
        built = {}
        for c in own:
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = {}
    for node, convs in members.items():
        under = [x for x in members if x[: len(node)] == node]
        children = [x for x in under if len(x) == len(node) + 1]
        leaves = sum(not any(y[: len(x)] == x and len(y) > len(x) for y in members) for x in under)
        saved = sum((len(members[x]) - 1) * (len(x[-1][1].encode()) if x else 0) for x in under)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out[min(convs), len(node)] = (parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


@pytest.mark.parametrize(("limit", "top"), [(32_768, 1_000_000), (2, 1_000_000), (12, 1_000_000), (1, 40)])
def test_prefix_nodes_against_all_prefixes(spark, odd_turns, limit, top):
    turns = odd_turns.where("conv_id is null or conv_id <> 20").unionByName(table(spark, SF, "conversations").where("conv_id < 12"), allowMissingColumns=True)
    plain = plain_nodes([tuple(r)[:4] for r in turns.collect()])
    found = prefix_table.prefix_nodes(prefix_table.rebuilt(prefix_table.turn_rows(turns)), limit=limit, top_nodes=top).collect()
    got = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in found}
    assert got == plain and len(found) == len(plain)


def test_prefix_nodes_of_plain_and_empty_tables(spark, odd_turns):
    turns = odd_turns.where("conv_id < 11")
    plain = plain_nodes([tuple(r)[:4] for r in turns.collect()], rebuild=False)
    found = prefix_table.prefix_nodes(prefix_table.turn_rows(turns)).collect()
    assert {(r["conv_id"], r["depth"]): r["n_convs"] for r in found} == {k: v[1] for k, v in plain.items()}
    assert prefix_table.prefix_nodes(prefix_table.rebuilt(prefix_table.turn_rows(odd_turns.limit(0)))).count() == 0


def test_slots_are_minimal_and_verified():
    keys = np.random.default_rng(3).integers(0, 2**63, (5_000, 2), dtype=np.uint64)
    slots = prefix_table.SlotTable(keys)
    assert sorted(slots.slots(keys).tolist()) == list(range(5_000))
    assert (slots.slots(keys + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError, match="not distinct"):
        prefix_table.SlotTable(np.vstack([keys[:3], keys[:1]]))


def plain_vectors(rows, threshold):
    links = {}
    for i, (vec_id, vec, label) in enumerate(rows):
        good = vec_id is not None and label is not None and vec and all(x is not None and math.isfinite(x) for x in vec) and any(vec)
        links[i] = (np.array(vec, dtype=float) / max(map(abs, vec)) if good else None)
        if good:
            links[i] = links[i] / np.linalg.norm(links[i])
    near, parent = defaultdict(set), {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = links[i], links[j]
        if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and rows[i][0] != rows[j][0] and a @ b >= threshold:
            near[i].add(rows[j][0])
            near[j].add(rows[i][0])
            x, y = find(rows[i][0]), find(rows[j][0])
            parent[max(x, y)] = min(x, y)
    return sorted(((r[0], len(near[i]), None if r[0] is None else find(r[0])) for i, r in enumerate(rows)), key=repr)


VECTORS = "vec_id bigint, embedding array<double>, label int, pid string, root string, n string, leaf string, part int"


@pytest.mark.parametrize(("block", "dim", "seed"), [(2048, 8, 0), (16, 8, 1), (8, 3, 2), (16, 24, 3)])
def test_cover_tree_against_all_pairs(spark, block, dim, seed, monkeypatch):
    rng = np.random.default_rng(seed)
    rows, ids = [], itertools.count()
    for label in (0, 1, 2):
        # loose vectors, dense groups, chains of neighbours just linked or just not, and exact copies
        loose = rng.normal(size=(120, dim))
        groups = [c + s * rng.normal(size=(60, dim)) * np.linalg.norm(c) / dim**0.5 for c, s in zip(rng.normal(size=(4, dim)), (0.02, 0.1, 0.2, 0.3), strict=True)]
        turn = [np.concatenate([[math.cos(0.3 * k), math.sin(0.3 * k)], np.zeros(dim - 2)]) for k in range(15)]
        for v in [*loose, *np.concatenate(groups), *turn, *loose[:10], *[loose[0]] * 20]:
            rows.append((next(ids), (v * 10.0 ** rng.integers(-3, 4)).tolist() if rng.random() < 0.2 else v.tolist(), label))
    rows += [(None, rows[0][1], 0), (next(ids), None, 0), (next(ids), [], 0), (next(ids), [0.0] * dim, 1), (next(ids), [math.nan] * dim, 1),
             (next(ids), [1.0, None, *[0.0] * (dim - 2)], 1), (next(ids), [math.inf] * dim, 1), (next(ids), rows[0][1], None), (next(ids), [1.0], 0), (next(ids), [2.0], 0),
             (next(ids), [-0.0, *[1e300] * (dim - 1)], 2), (next(ids), [0.0, *[1e-300] * (dim - 1)], 2)]
    monkeypatch.setattr(cover_tree, "LEAST_CHILD", 4)
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", 1) for r in rows], VECTORS).repartition(3)
    out = cover_tree.near_vectors(df, threshold=0.93, block=block)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()), key=repr) == plain_vectors(rows, 0.93)
    assert out.where("kept <> (vec_id <=> component_id)").count() == 0


def test_vectors_that_share_an_id_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (2, [0.0, 1.0], 0), (3, [0.01, 1.0], 0), (3, [0.01, 1.0], 0), (4, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    out = sorted(tuple(r) for r in cover_tree.near_vectors(df).collect())
    assert out == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]
    assert cover_tree.near_vectors(df.limit(0)).count() == 0
