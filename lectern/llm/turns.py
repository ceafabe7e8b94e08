"""Repair of conversation structure: align turns to the alternating grammar at the least cost.

The role initials of a sound conversation read ``(s?(ua)+)?``. Turns are kept (cost 0), given another role (3), deleted (4,
demanded for blank and repeated turns) or inserted empty (3); a truncated turn that is not deleted adds 3. For each feasible
length the grammar has one string per beginning and end, and the turns are aligned to it by Wagner-Fischer, within the
Ukkonen band that the cheapest alignment so far leaves; lengths are tried by their least possible cost until that exceeds the
cheapest. The audit is the backtrace that is least in ASCII among the cheapest of all lengths.

A conversation of any length is cut into runs of ``RUN`` turns, so nothing gathers one conversation in one row. A run is
aligned for each state of the grammar it may be entered and left in (nothing yet, after s, after u, after a); runs then
combine pairwise associatively in rounds of ``FOLD`` neighbours: least cost, then least audit. That is exact, since of two
audits of the same turns and cost none is the beginning of the other. Numbers of turns come from the distributed numbering,
and texts travel only once, for the repair itself, which streams a conversation's turns in order; until then a turn is a code
of two letters and a digest.

Defined cases: null roles and texts are one space (a blank turn, a role that fits nothing); null turns come first; turns of
one number are ordered by role and text digest; a null conv_id is a conversation like any other; a conversation of no turns has
zeros, an empty audit and the digest of the empty string; repeated rows are repeated turns; roles and texts of any length; extra
columns are ignored; an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import staged
from lectern.operators.numbering import exact_row_number

RUN, FOLD = 16, 64
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\f\r"
ENDS, SOUND = (0, 3), ("su", "ua", "au")
INF = 1 << 60


def targets(entry: int, leave: int, length: int) -> list[str]:
    """The grammar's strings of that length that lead from one state to the other."""
    found = [""] if length == 0 and entry == leave else []
    for head in ("", "s") if entry == 0 else ("",):
        first = "u" if head else NEXT[entry]
        body = ("ua" if first == "u" else "au") * (length // 2 + 1)
        text = head + body[:length - len(head)]
        if 0 < length == len(text) and {"s": 1, "u": 2, "a": 3}[text[-1]] == leave:
            found.append(text)
    return found


def align(turns: str, target: str, limit: int) -> tuple[int, str] | None:
    """Least cost and audit of turns against one string, if the cost is at most ``limit``.

    ``turns``: s, u, a or o (no role of the grammar) a turn, in capitals if truncated, x if it must go.
    """
    n, m = len(turns), len(target)
    inserts = (limit - DELETE * (n - m)) // (DELETE + INSERT)
    deletes = inserts + n - m
    if inserts < 0 or deletes < 0:
        return None
    togo: list[dict[int, int]] = [{} for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, below = togo[i], togo[i + 1]
        turn = turns[i] if i < n else "x"
        kind, extra = turn.lower(), TRUNCATED if turn.isupper() else 0
        for j in range(min(m, i + inserts), max(0, i - deletes) - 1, -1):
            cost = 0 if i == n and j == m else INF
            if i < n:
                cost = below.get(j, INF) + DELETE
            if j < m and target[j] != "s":
                cost = min(cost, row.get(j + 1, INF) + INSERT)
                if kind != "x":
                    cost = min(cost, below.get(j + 1, INF) + extra + (0 if kind == target[j] else REROLE))
            elif j < m and kind == "s":
                cost = min(cost, below.get(j + 1, INF) + extra)
            row[j] = cost
    best = togo[0].get(0, INF)
    if best > limit:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        now = togo[i][j]
        if i < n and togo[i + 1].get(j, INF) + DELETE == now:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and togo[i].get(j + 1, INF) + INSERT == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return best, "".join(audit)


@lru_cache(200_000)
def cheapest(turns: str, entry: int, leave: int) -> tuple[int, str] | None:
    """Least (cost, audit) of turns over all lengths of the grammar between two states."""
    live = sum(t != "x" for t in turns)
    gone = DELETE * (len(turns) - live)

    def least(length: int) -> int:
        return gone + (DELETE * (live - length) if length < live else INSERT * (length - live))

    best = None
    for length in sorted(range(2 * live + 3), key=least):
        if best and least(length) > best[0]:
            break
        for target in targets(entry, leave, length):
            limit = best[0] if best else DELETE * len(turns) + INSERT * length + DELETE
            found = align(turns, target, limit)
            best = min(filter(None, (best, found)), default=None)
    return best


class Run:
    """What a stretch of turns contributes: counts of faults, turn numbers, and its cheapest audits by (entry, leave)."""

    def __init__(self, ends: str, counts: list[int], lo: int | None, hi: int | None, paths: dict):
        self.ends, self.counts, self.lo, self.hi, self.paths = ends, counts, lo, hi, paths

    @classmethod
    def of(cls, codes: str, first: str, lo: int | None, hi: int | None, distinct: int, entries) -> Run:
        kinds, faults = codes[::2], codes[1::2]
        dup = [f == "0" and x != "b" for f, x in zip(first, faults)]
        turns = "".join("x" if x == "b" or d else k.upper() if x == "t" else k for k, x, d in zip(kinds, faults, dup))
        counts = [faults.count("b"), sum(dup), sum(t.isupper() for t in turns),
                  sum(a + b not in SOUND for a, b in zip(kinds, kinds[1:])), distinct]
        paths = {(p, q): c for p in entries for q in range(4) if (c := cheapest(turns, p, q))}
        return cls(kinds[0] + kinds[-1], counts, lo, hi, paths)

    def then(self, other: Run) -> Run:
        counts = [a + b for a, b in zip(self.counts, other.counts)]
        counts[3] += self.ends[1] + other.ends[0] not in SOUND
        counts[4] -= self.hi is not None and self.hi == other.lo
        paths: dict = {}
        for (p, q), (cost, audit) in self.paths.items():
            for r in range(4):
                if after := other.paths.get((q, r)):
                    way = cost + after[0], audit + after[1]
                    if (p, r) not in paths or way < paths[p, r]:
                        paths[p, r] = way
        lo = other.lo if self.lo is None else self.lo
        hi = self.hi if other.hi is None else other.hi
        return Run(self.ends[0] + other.ends[1], counts, lo, hi, paths)

    def text(self) -> str:
        numbers = ",".join("" if x is None else str(x) for x in (*self.counts, self.lo, self.hi))
        return " ".join([self.ends, numbers, *(f"{p}{q}{cost}{audit and ':' + audit}" for (p, q), (cost, audit) in self.paths.items())])

    @classmethod
    def read(cls, text: str) -> Run:
        ends, numbers, *paths = text.split(" ")
        *counts, lo, hi = (int(x) if x else None for x in numbers.split(","))
        ways = {}
        for path in paths:
            cost, _, audit = path[2:].partition(":")
            ways[int(path[0]), int(path[1])] = int(cost), audit
        return cls(ends, counts, lo, hi, ways)

    def result(self) -> tuple[list[int], str]:
        """gaps, blank, duplicate, truncated, illegal, cost, and the audit."""
        cost, audit = min(self.paths[0, q] for q in ENDS if (0, q) in self.paths)
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.counts[4]
        return [min(gaps, (1 << 63) - 1), *self.counts[:4], cost], audit


def damage(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults: (conv_id, turn, role, text, copies); 0 copies: the turn is dropped."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    hurt = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
                                hurt.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _code() -> Column:
    """Role initial (o: none of the grammar's) and fault (b blank, t truncated, -)."""
    initial = F.left(F.col("role"), F.lit(1))
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(body == "", "b").when(F.right(body, F.lit(1)).isin(".", "!", "?"), "-").otherwise("t")
    return F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("o"), fault)


def _runs(turns: DataFrame) -> DataFrame:
    """(conv_id, run, node): every run of turns aligned for the states it can be entered in."""
    keys = turns.where("copies > 0").select(
        "conv_id", "turn", "role", F.xxhash64("text").alias("place"), F.unhex(F.left(F.sha2("text", 256), F.lit(32))).alias("digest"),
        _code().alias("code"), F.monotonically_increasing_id().alias("tie"), F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "place", "tie", "copy")]
    numbered = exact_row_number(keys, ["conv_id"], order, "pos")
    run = F.floor((F.col("pos") - 1) / RUN).alias("run")
    firsts = numbered.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos"))
    both = numbered.select("conv_id", run, F.struct("pos", "code", "turn").alias("row"), F.lit(None).cast("long").alias("first")).unionByName(
        firsts.select("conv_id", run, F.col("pos").alias("first")), allowMissingColumns=True)
    rows = both.groupBy("conv_id", "run").agg(F.array_sort(F.collect_list("row")).alias("rows"), F.collect_list("first").alias("firsts"))
    turn = F.filter(F.transform("rows", lambda x: x["turn"]), lambda t: t.isNotNull())
    rows = rows.select(
        "conv_id", "run", F.array_join(F.transform("rows", lambda x: x["code"]), "").alias("codes"),
        F.array_join(F.transform("rows", lambda x: F.when(F.array_contains("firsts", x["pos"]), "1").otherwise("0")), "").alias("mask"),
        F.concat_ws(",", F.size(F.array_distinct(turn)), F.array_min(turn), F.array_max(turn)).alias("numbers"))

    @F.pandas_udf("string")
    def node(run: pd.Series, codes: pd.Series, mask: pd.Series, numbers: pd.Series) -> pd.Series:
        out = []
        for r, c, f, x in zip(run, codes, mask, numbers):
            distinct, *span = map(int, x.split(","))
            out.append(Run.of(c, f, *(span or (None, None)), distinct, range(4) if r else (0,)).text())
        return pd.Series(out, dtype=object)

    return rows.select("conv_id", "run", node("run", "codes", "mask", "numbers").alias("node"))


def _folded(runs: DataFrame) -> DataFrame:
    """(conv_id, node): runs combined in rounds of FOLD neighbours until each conversation is one."""
    @F.pandas_udf("string")
    def fold(nodes: pd.Series) -> pd.Series:
        out = []
        for parts in nodes:
            whole = Run.read(parts[0])
            for part in parts[1:]:
                whole = whole.then(Run.read(part))
            out.append(whole.text() if len(parts) > 1 else parts[0])
        return pd.Series(out, dtype=object)

    while True:
        runs = staged(runs, "runs")
        if not runs.agg(F.max("run")).first()[0]:
            return runs.select("conv_id", "node")
        pack = runs.groupBy("conv_id", F.floor(F.col("run") / FOLD).alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("run", "node"))).alias("parts"))
        runs = pack.select("conv_id", "run", fold(F.transform("parts", lambda x: x["node"])).alias("node"))


class _Repair:
    """One conversation while its turns stream by: what the audit makes of each."""

    def __init__(self, conv_id):
        self.conv_id, self.numbers, self.audit, self.at, self.state, self.n = conv_id, [0] * 6, "", 0, 0, 0

    def _out(self, letter: str, role: str, text: str) -> tuple[int, str, str]:
        self.state = {"s": 1, "u": 2, "a": 3}[letter]
        self.n += 1
        return self.n, role, text

    def inserts(self) -> Iterator[tuple[int, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            letter = NEXT[self.state]
            yield self._out(letter, ROLES[letter], "")

    def turn(self, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._out(role[0], role, text)
        elif edit == "R":
            letter = NEXT[self.state]
            yield self._out(letter, ROLES[letter], text)


def _ordered(turns: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, all in one partition; a turn of no copies only names its conversation."""
    nodes = _folded(_runs(turns)).select("conv_id", "node")
    rows = turns.select("conv_id", "turn", "role", F.xxhash64("text").alias("place"), "text", "copies")
    both = nodes.unionByName(rows, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("node").isNull(), *[F.col(c).asc_nulls_first() for c in ("turn", "role", "place", "text")])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Repair, list | None]]:
    """(conversation, turns put out by a row); None after a conversation's last turn."""
    now = None
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "node", "role", "text", "copies")]
        for conv_id, node, role, text, copies in zip(*cols):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now, list(now.inserts())
                    yield now, None
                now = _Repair(conv_id)
            if node is not None:
                now.numbers, now.audit = Run.read(node).result()
            for _ in range(copies or 0):
                yield now, list(now.turn(role, text))
    if now is not None:
        yield now, list(now.inserts())
        yield now, None


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or weight > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations themselves: (conv_id, place, role, text), places from 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", first.schema.field("conv_id").type), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        rows = ((c.conv_id, *t) for c, out in _stream(_chain(first, batches)) for t in out or ())
        yield from _batches(rows, schema)

    key = turns.schema["conv_id"].dataType.simpleString()
    return _ordered(turns).mapInArrow(run, f"conv_id {key}, place long, role string, text string")


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit, and the digest of the repaired turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", first.schema.field("conv_id").type), *((c, pa.int64()) for c in NUMBERS),
                            ("audit", pa.string()), ("repaired_sha256", pa.string())])

        def rows():
            digest = hashlib.sha256()
            for conv, out in _stream(_chain(first, batches)):
                for place, role, text in out or ():
                    digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
                if out is None:
                    yield conv.conv_id, *conv.numbers, conv.audit, digest.hexdigest()
                    digest = hashlib.sha256()

        yield from _batches(rows(), schema)

    key = turns.schema["conv_id"].dataType.simpleString()
    return _ordered(turns).mapInArrow(run, f"conv_id {key}, {', '.join(c + ' long' for c in NUMBERS)}, audit string, repaired_sha256 string")


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest
