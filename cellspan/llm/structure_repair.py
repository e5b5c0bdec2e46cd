"""Cheapest repair of conversation structure, planned on an automaton that all conversations share.

A conversation becomes a word: one symbol a row, its role's initial and fault. Two rows whose rest of the word is equal
share one node, so the nodes are the distinct suffixes of all words, minimised from the end. For every node and grammar
state the cost-to-go and the first step of the best audit suffix are computed once: distinct words are range-partitioned
by their reversal and read in that order, which walks the automaton depth-first from its end and needs no more memory
than the longest word. Only nodes on the path at a range border are computed in both ranges.

A conversation is never held: rows arrive sorted, and the edits, checks and digests read them as a stream. What is held
of one conversation is a byte and a 16-byte digest a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspan.llm.common import BLANKS, join_by_counted_key, stored

# Costs of the edits; a kept or re-roled row that is cut off costs as much more.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

# Grammar (s?(ua)+)?: states before anything, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_ENDS = {_START, _ASSISTANT}
# The one role that may be inserted, or given to a row, in each state, and where it leads.
_GIVEN = {_START: ("user", _USER), _SYSTEM: ("user", _USER), _USER: ("assistant", _ASSISTANT), _ASSISTANT: ("user", _USER)}

# Symbols: x must go; s, u, a and o (any other role) may stay, as capitals where the text is cut off.
_SYMBOLS = "xsuaoSUAO"


def _steps() -> dict[str, list[list[tuple[int, str, int]]]]:
    """Per symbol and state: (cost, audit letters, next state) of inserting up to three rows, then treating the row."""
    out = {}
    for symbol in _SYMBOLS:
        late = CUT_OFF if symbol.isupper() else 0
        out[symbol] = []
        for state in range(4):
            options, at = [], state
            for inserted in range(4):
                cost, letters = inserted * INSERT, "I" * inserted
                options.append((cost + DELETE, letters + "D", at))
                if symbol != "x":
                    options.append((cost + REROLE + late, letters + "R", _GIVEN[at][1]))
                    if (at, symbol.lower()) in _AFTER:
                        options.append((cost + late, letters + "K", _AFTER[at, symbol.lower()]))
                at = _GIVEN[at][1]
            out[symbol].append(options)
    return out


_STEPS = _steps()


def _ranked(choices: list[tuple[int, str, int, int]]) -> tuple:
    """A node: per state cost, letters and next state, and the order of the four audit suffixes.

    Letters are inserts and one row edit, so different letters differ before either ends, and equal letters leave the
    order to the suffixes that follow: no suffix is ever spelled out to compare it.
    """
    places = sorted({(c[1], c[2]) for c in choices})
    return (tuple(c[0] for c in choices), tuple(c[1] for c in choices), tuple(c[3] for c in choices),
            tuple(places.index((c[1], c[2])) for c in choices))


def _end_node() -> tuple:
    choices = []
    for state in range(4):
        at, letters = state, ""
        while at not in _ENDS:
            at, letters = _GIVEN[at][1], letters + "I"
        choices.append((len(letters) * INSERT, letters, 0, at))
    return _ranked(choices)


_END = _end_node()


def _node(symbol: str, rest: tuple) -> tuple:
    """The node reached by ``symbol`` before the suffix of node ``rest``."""
    costs, _, _, order = rest
    return _ranked([min((costs[to] + cost, letters, order[to], to) for cost, letters, to in options) for options in _STEPS[symbol]])


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reversed words in ascending order: the stack is the path of the last word, equal beginnings stay on it."""
    stack, last = [_END], ""
    for batch in batches:
        words, costs, audits, made = batch.column("reversed").to_pylist(), [], [], []
        for word in words:
            same = 0
            for x, y in zip(word, last, strict=False):
                if x != y:
                    break
                same += 1
            del stack[same + 1 :]
            for symbol in word[same:]:
                stack.append(_node(symbol, stack[-1]))
            state, letters = _START, []
            for node in reversed(stack):
                letters.append(node[1][state])
                state = node[2][state]
            costs.append(stack[-1][0][_START])
            audits.append("".join(letters))
            made.append(len(word) - same)
            last = word
        yield pa.RecordBatch.from_arrays(
            [pa.array([w[::-1] for w in words], pa.string()), pa.array(costs, pa.int64()), pa.array(audits, pa.string()), pa.array(made, pa.int64())],
            names=["signature", "cost", "audit", "new_nodes"],
        )


def plan(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit, new_nodes) of every distinct ``signature``: its cheapest edits, ties ASCII-least.

    ``new_nodes`` counts the automaton nodes that the signature added in its range; the rest it shares.
    """
    order = F.reverse("signature").alias("reversed")
    return signatures.select(order).repartitionByRange("reversed").sortWithinPartitions("reversed").mapInArrow(
        _planned, "signature string, cost bigint, audit string, new_nodes bigint"
    )


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): every row hit or spared by ``crc32(conv_id:turn) % 20``; null counts as one space.

    0 drops the row (it stays as a marker), 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it the user's.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    copies = F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(word("role")).alias("role"), text.alias("text"),
                        (hit == 0).alias("dropped"), copies.alias("__copy")).drop("__copy")


def _clean(turns: DataFrame, dropped: str | None) -> DataFrame:
    space = F.lit(" ")
    return turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)).alias("dropped"),
    ).withColumn("digest", F.unhex(F.md5("text")))


def _order(first: list[str]) -> list[Column]:
    return [*(F.col(c).asc_nulls_first() for c in first), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


_MARKS = pa.schema([
    ("conv_id", pa.int64()), ("signature", pa.string()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()),
])


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from rows sorted by conversation and turn."""
    nothing = object()
    conv, done = nothing, []

    def close() -> None:
        turns = (last - low + 1 - distinct) if distinct else 0
        done.append((conv, word.decode(), turns, *counts))

    for batch in batches:
        for key, turn, role, digest, blank, ended, dropped in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if key != conv:
                if conv is not nothing:
                    close()
                conv, word, counts, seen, before = key, bytearray(), [0, 0, 0, 0], set(), None
                low = last = None
                distinct = 0
            if dropped:
                continue
            if turn is not None and turn != last:
                low, last, distinct = turn if low is None else low, turn, distinct + 1
            said = hashlib.blake2b(role.encode() + b"\0" + digest, digest_size=16).digest()
            initial = role[:1]
            if blank or said in seen:
                counts[0 if blank else 1] += 1
                symbol = "x"
            else:
                symbol = initial if initial in ("s", "u", "a") else "o"
                if not ended:
                    counts[2] += 1
                    symbol = symbol.upper()
            seen.add(said)
            word += symbol.encode()
            if before is not None and before + initial not in ("su", "ua", "au"):
                counts[3] += 1
            before = initial
        if len(done) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), _MARKS.types, strict=True)], schema=_MARKS)
            done.clear()
    if conv is not nothing:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), _MARKS.types, strict=True)], schema=_MARKS)


def diagnose(turns: DataFrame, *, dropped: str | None = None) -> DataFrame:
    """(conv_id, signature, gaps, blank, duplicate, truncated, illegal) of every conversation.

    Rows are ordered by turn (null first), then role and digest of the text. A row's first fault counts: blank, duplicate
    (role and text seen earlier), truncated (no ``.``, ``!`` or ``?`` as last character but blanks). ``gaps`` are missing
    numbers between the least and largest turn, ``illegal`` adjacent roles other than system-user, user-assistant and
    assistant-user. Null role or text is one space, rows without ``conv_id`` are one conversation, and rows that
    ``dropped`` names only say that their conversation exists. Other columns are not read.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = _clean(turns, dropped).select(
        "conv_id", "turn", "role", "digest", (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"), "dropped"
    )
    sorted_rows = narrow.repartition("conv_id").sortWithinPartitions(*_order(["conv_id"]))
    return sorted_rows.mapInArrow(
        _marked, "conv_id bigint, signature string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
    )


class _Edits:
    """The audit of one conversation, applied row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, _START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = _GIVEN[self.state]
            self.at += 1
            yield role, "", "insert"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _AFTER[self.state, role[:1]]
            yield role, text, "keep"
        elif edit == "R":
            role, self.state = _GIVEN[self.state]
            yield role, text, "rerole"

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]] | None]]:
    """(conversation, rows) pairs in order; a conversation's end is told by ``None`` in place of rows."""
    nothing = object()
    conv, edits = nothing, None
    for batch in batches:
        for key, kind, audit, role, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if kind == 0:
                if conv is not nothing:
                    yield conv, edits.rest()
                    yield conv, None
                conv, edits = key, _Edits(audit)
            else:
                yield conv, edits.row(role, text)
    if conv is not nothing:
        yield conv, edits.rest()
        yield conv, None


def _repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    out, position, size = [], 0, 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    for conv, rows in _edited(batches):
        if rows is None:
            position = 0
            continue
        for role, text, edit in rows:
            out.append((conv, position, role, text, edit))
            position += 1
            size += len(text)
        if len(out) >= 10_000 or size > 4_000_000:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    found, running, started = [], hashlib.sha256(), False
    for conv, rows in _edited(batches):
        if rows is None:
            found.append((conv, running.hexdigest()))
            running, started = hashlib.sha256(), False
        else:
            for role, text, _ in rows:
                running.update(("\n" if started else "").encode() + f"{role}:{text}".encode())
                started = True
        if len(found) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)
            found = []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)


def audited(turns: DataFrame, *, dropped: str | None = None) -> DataFrame:
    """The columns of :func:`diagnose` and ``cost`` and ``audit``, the cheapest edits' initials in order.

    Keep costs nothing, Rerole to user or assistant 3, Delete 4 (the only edit of blank and duplicate rows), Insert of an
    empty user or assistant row 3; a truncated row that stays adds 3. The roles that result are ``(s?(ua)+)?`` by their
    initials; a role without one of these initials, the empty one too, can't be kept. Every conversation has a row; one
    without rows costs 0 and has an empty audit.
    """
    marks = stored(diagnose(turns, dropped=dropped), "conversation-signatures")
    words = stored(marks.groupBy("signature").agg(F.count(F.lit(1)).alias("n_conversations")), "distinct-signatures")
    plans = stored(plan(words).join(words, "signature"), "repair-plans")
    return stored(join_by_counted_key(marks, plans, "signature", "n_conversations"), "audits")


def _with_edits(turns: DataFrame, audits: DataFrame, dropped: str | None) -> DataFrame:
    kept = _clean(turns, dropped).where("not dropped")
    rows = kept.select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "role", "text", "turn", "digest")
    none = lambda kind: F.lit(None).cast(kind)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), "audit", none("string").alias("role"), none("string").alias("text"),
                          none("bigint").alias("turn"), none("binary").alias("digest"))
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*_order(["conv_id", "kind"])).select(
        "conv_id", "kind", "audit", "role", "text")


def repaired_turns(turns: DataFrame, audits: DataFrame, *, dropped: str | None = None) -> DataFrame:
    """(conv_id, position, role, text, edit): the rows of the repaired conversations, by the edits of :func:`audited`."""
    return _with_edits(turns, audits, dropped).mapInArrow(
        _repaired_rows, "conv_id bigint, position bigint, role string, text string, edit string")


def repaired_digests(turns: DataFrame, audits: DataFrame, *, dropped: str | None = None) -> DataFrame:
    """``audits`` and ``repaired_sha256``: the digest of the repaired rows as ``role:text`` lines, none: of nothing."""
    found = _with_edits(turns, audits, dropped).mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    both = found.withColumnRenamed("conv_id", "__conv")
    return audits.join(both, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
