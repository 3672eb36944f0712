"""Conversation repair against a plain search over all lengths of the repaired conversation."""

import functools
import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import pytest

from clusterkit.llm import repair
from tests.llm import cases

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, copies string, seen string, `at` string"


def plain_edits(rows):
    """Cost, edits and repaired (role, text) of (role, text, must go, truncated) rows, by length."""
    best = None
    for length in range(0, 2 * len(rows) + 3):
        if length == 1:
            continue
        want = ("s" if length % 2 else "") + "ua" * (length // 2)

        @functools.lru_cache(None)
        def cheapest(i, j):
            if i == len(rows) and j == length:
                return 0, ""
            found = []
            if j < length and want[j] != "s":
                c, rest = cheapest(i, j + 1) if j < length else (None, None)
                found.append((c + 5, "I" + rest))
            if i < len(rows):
                role, _, must, cut = rows[i]
                c, rest = cheapest(i + 1, j)
                found.append((c + 2, "D" + rest))
                if not must and j < length:
                    c, rest = cheapest(i + 1, j + 1)
                    extra = 5 if cut else 0
                    if role[:1] == want[j]:
                        found.append((c + extra, "K" + rest))
                    if want[j] != "s":
                        found.append((c + extra + 1, "R" + rest))
            return min(found, default=(10**9, ""))

        got = cheapest(0, 0)
        if best is None or got < best[0]:
            best = got, want
    (cost, audit), want = best
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            out.append((want[len(out)], ""))
        else:
            if letter != "D":
                out.append((rows[i][0] if letter == "K" else want[len(out)], rows[i][1]))
            i += 1
    out = [({"u": "user", "a": "assistant"}.get(role, role), text) for role, text in out]
    return cost, audit, out


def plain_report(rows):
    """Reports by conversation of (conv_id, turn, role, text) rows."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv]
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        turns[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, found in turns.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, count = set(), [], defaultdict(int)
        for _, role, text in found:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            count[kind] += 1
            seen.add((role, text))
            marked.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
        numbers = {t for t, _, _ in found if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        pairs = [(a[0][:1], b[0][:1]) for a, b in zip(marked, marked[1:])]
        cost, audit, fixed = plain_edits(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"],
                     sum("".join(p) not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def report(spark, rows):
    frame = spark.createDataFrame([(*r, "x", None, "x") for r in rows], SCHEMA)
    return repair.repair_report(repair.damaged(repair.turns(frame)))


def test_search_against_plain_search():
    rng = random.Random(5)
    for trial in range(1500):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]), f"t{k}",
                 rng.random() < 0.2, rng.random() < 0.2) for k in range(rng.randint(0, 9))]
        rows = [(r, t, must, cut and not must) for r, t, must, cut in rows]
        search, edits = repair.Search(), []
        for role, _, must, cut in rows:
            edits += search.turn(role[:1], must, cut)
        edits += search.finish()
        assert (search.total, "".join(e for e, _ in edits)) == plain_edits(rows)[:2], rows


@pytest.mark.parametrize("roles, most", [("ua", 40), ("su", 40), ("uua", 40), ("ssa", 40), ("auu", 40), ("u", 3000), ("t", 3000)])
def test_few_turns_wait(roles, most):
    """But for ties that run on to the end, like user after user."""
    conversation, names = repair.Conversation(1), {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    done = 0
    for k in range(3000):
        done += sum(e != "I" for e, _, _ in conversation.add(k, names[roles[k % len(roles)]], f"Text {k}.", k % 7 == 3))
    done += sum(e != "I" for e, _, _ in conversation.finish())
    assert done == 3000 and conversation.held <= most


def test_report_against_plain_report(spark):
    rng = random.Random(6)
    texts = ["Yes.", "No", "", " \n", "Why? ", "A!", None, "café.", "long " * 5000 + ".", "end..."]
    rows = [(rng.choice([*range(40), None]), rng.choice([None, *range(6)]),
             rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice(texts))
            for _ in range(300)]
    rows += rows[:20]
    got = {r[0]: tuple(r)[1:] for r in report(spark, rows).collect()}
    assert got == plain_report(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi there."), (1, 2, "assistant", "Yes."), (2, 0, "tool", "x."),
            (1, 3, "user", "Hi."), (3, None, "system", "S."), (3, 1, "user", "U."), (3, 2, "assistant", "A.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in repair.repair(repair.turns(frame)).orderBy("conv_id", "position").collect()]
    kept = [(c, r, t) for c, p, e, r, t in got if p is not None]
    assert kept == [(1, "user", "Hi there."), (1, "assistant", "Yes."),
                    (3, "system", "S."), (3, "user", "U."), (3, "assistant", "A.")]
    assert sorted(e for *_, e, _, _ in got) == sorted("DKKD" + "D" + "KKK")


def test_empty_table(spark):
    assert report(spark, []).collect() == []
    assert repair.repair(repair.turns(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_whole_table(spark):
    from clusterkit.llm.queries import op11_conversation_repair

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, SF_DIR).collect()}
    assert got == plain_report(rows)
