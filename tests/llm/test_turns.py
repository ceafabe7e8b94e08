"""Conversation repair against a brute-force version: every edit of every turn, state by state."""

import hashlib
import random
import re
import zlib

import pytest

from lectern.llm import turns
from lectern.llm.queries import QUERIES

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        got = out.setdefault(conv, [])
        name = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(":".join(name).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        got += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of turns in order."""
    seen, marks = set(), []
    for _, role, text in rows:
        marks.append("b" if not BLANK.search(text) else "d" if (role, text) in seen else
                     "-" if BLANK.findall(text)[-1] in ".!?" else "t")
        seen.add((role, text))
    best = {0: (0, "", [])}

    def insert(states):
        for _ in range(3):
            for q, (cost, audit, out) in list(states.items()):
                letter = "a" if q == 2 else "u"
                way = cost + 3, audit + "I", out + [("user" if letter == "u" else "assistant") + ":"]
                to = 3 if letter == "a" else 2
                if to not in states or way[:2] < states[to][:2]:
                    states[to] = way
        return states

    best = insert(best)
    for (_, role, text), mark in zip(rows, marks):
        after = {}
        for q, (cost, audit, out) in best.items():
            ways = [(q, (cost + 4, audit + "D", out))]
            if mark not in "bd":
                need = "a" if q == 2 else "u"
                more = 3 * (mark == "t")
                if q == 0 and role[:1] == "s":
                    ways.append((1, (cost + more, audit + "K", out + [f"{role}:{text}"])))
                to = 3 if need == "a" else 2
                if role[:1] == need:
                    ways.append((to, (cost + more, audit + "K", out + [f"{role}:{text}"])))
                else:
                    ways.append((to, (cost + more + 3, audit + "R", out + [("user" if need == "u" else "assistant") + f":{text}"])))
            for to, way in ways:
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        best = insert(after)
    cost, audit, out = min((best[q] for q in (0, 3) if q in best), key=lambda w: w[:2])
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, "\n".join(out))


def test_cheapest_equals_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        spelled = "".join(rng.choice("uuaasoUAx") for _ in range(rng.randrange(9)))
        rows = [(i, {"u": "user", "a": "assistant", "s": "system", "o": "tool", "x": "user"}[c.lower()],
                 "" if c == "x" else f"t{i}" + ("" if c.isupper() else ".")) for i, c in enumerate(spelled)]
        want = brute(rows)
        assert min(c for q in (0, 3) if (c := turns.cheapest(spelled, 0, q))) == (want[5], want[6]), spelled


def test_targets_are_the_grammar():
    for length in range(7):
        spelled = sorted(t for q in turns.ENDS for t in turns.targets(0, q, length))
        want = [t for t in ("ua" * (length // 2), "s" + "ua" * (length // 2)) if len(t) == length and re.fullmatch("(s?(ua)+)?", t)]
        assert spelled == sorted(want)


def check(spark, rows, schema="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r for r in turns.repair_report(turns.damage(df)).collect()}
    want = brute_damage(rows)
    assert got.keys() == want.keys()
    for conv, given in want.items():
        order = {r.text: i for i, r in enumerate(spark.createDataFrame([(t,) for _, _, t in given] or [("",)], "text string")
                                                 .selectExpr("text", "xxhash64(text) h").orderBy("h").collect())}
        given.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], order.get(r[2], 0)))
        w, r = brute(given), got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == w[:7], conv
        assert r.repaired_sha256 == hashlib.sha256(w[7].encode()).hexdigest(), conv
    return got


@pytest.mark.parametrize("run", [turns.RUN, 3])
def test_report_on_odd_rows(spark, monkeypatch, run):
    monkeypatch.setattr(turns, "RUN", run)
    monkeypatch.setattr(turns, "FOLD", 2)
    rng = random.Random(run)
    rows = [(1, t, r, x) for t, r, x in [(0, "system", "You."), (1, "user", "Hi?"), (2, "assistant", "Yes.")]]
    for conv in [2, 3, 4, 5, 6, 7, None]:
        for _ in range(rng.randrange(1, 25)):
            rows.append((conv, rng.choice([None, *range(20)]), rng.choice(["user", "assistant", "assistant", "system", None, "", "tool"]),
                         rng.choice([None, "", " \t", "Yes.", "No", "What? ", "Fine. ", "a b c!", f"x{rng.random()}.", f"y{rng.random()}"])))
    rows += [(8, 0, "user", "Same.")] * 7 + [(9, t, "user", "Hot text.") for t in range(40)]
    dropped = next(c for c in range(100, 300) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    got = check(spark, rows)
    gone = got[dropped]
    assert (gone.cost, gone.audit, gone.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())


def test_long_conversation_is_cut_and_joined(spark):
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"text {t}" + rng.choice([".", ".", ""])) for t in range(1500)]
    got = check(spark, rows)
    assert len(got[1].audit) >= 1300


def test_repaired_turns_follow_the_grammar(spark, sf_small):
    given = turns.damage(spark.read.parquet(f"{sf_small}/conversations.parquet"))
    found = {}
    for r in turns.repaired_turns(given).collect():
        found.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    report = {r.conv_id: r for r in turns.repair_report(given).collect()}
    for conv, rows in found.items():
        rows.sort()
        assert [p for p, _, _ in rows] == list(range(1, len(rows) + 1))
        assert re.fullmatch("s?(ua)+", "".join(r[0] for _, r, _ in rows))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in rows).encode()).hexdigest() == report[conv].repaired_sha256


def test_query_on_given_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r for r in QUERIES["op11_turn_alignment"](spark, sf_small).collect()}
    for conv, given in brute_damage(rows).items():
        w = brute(sorted(given, key=lambda r: r[0]))
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == w[:7]
        assert r.repaired_sha256 == hashlib.sha256(w[7].encode()).hexdigest()
