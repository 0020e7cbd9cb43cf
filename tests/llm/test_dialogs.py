"""Conversation repair against a search of all paths in order of cost."""

import random
import time

import pytest

from linkloom.llm import dialogs
from tests.llm import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def _plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        found = brute.repair([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv])
        out[conv] = (*found[:-1], brute.sha256(found[-1]))
    return out


def _found(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_search_equals_brute_force():
    rng = random.Random(13)
    for _ in range(1500):
        roles = [rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]) for _ in range(rng.randint(0, 9))]
        texts = [rng.choice(["Yes.", "No!", "", " ", "cut", "cut off", "Well?"]) for _ in roles]
        rows = [(1, t, r, x) for t, (r, x) in enumerate(zip(roles, texts))]
        want = brute.repair(rows)
        faults, seen = [], set()
        for r, x in zip(roles, texts):
            faults.append(1 if not x.strip() else 2 if (r, x) in seen else 3 if x[-1] not in ".!?" else 0)
            seen.add((r, x))
        initials = "".join(r[0] if r[0] in "sua" else "?" for r in roles)
        cost, edits = dialogs.cheapest_edits(initials, bytes(faults))
        lines = "\n".join(f"{r}:{x}" for _, r, x in dialogs.repaired_rows(edits, iter(zip(roles, texts))))
        assert (cost, edits, lines) == want[5:]


@pytest.mark.parametrize("landmark", [1, 3, 64, 1000])
def test_landmarks_change_no_result(monkeypatch, landmark):
    rng = random.Random(5)
    cases = [("".join(rng.choice("uauas?") for _ in range(n)), bytes(rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))) for n in (1, 5, 40, 130)]
    want = [dialogs.cheapest_edits(*case) for case in cases]
    monkeypatch.setattr(dialogs, "LANDMARK", landmark)
    assert [dialogs.cheapest_edits(*case) for case in cases] == want


def test_long_conversations_take_time_in_proportion():
    rng, took = random.Random(1), {}
    for n in (5_000, 40_000):
        initials, faults = "".join(rng.choice("uauaua?s") for _ in range(n)), bytes(rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))
        began = time.process_time()
        dialogs.cheapest_edits(initials, faults)
        took[n] = time.process_time() - began
    assert took[40_000] < 24 * took[5_000] + 0.5


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = _plain(brute.damage(rows))
    want |= {r[0]: (0, 0, 0, 0, 0, 0, "", brute.sha256("")) for r in rows if r[0] not in want}
    got = dialogs.query(spark, SF)
    assert got.columns == ["conv_id", *COLUMNS] and _found(got) == want


AWKWARD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", None), (1, 2, None, "Hm."), (1, None, "assistant", "First."),
    (1, 7, "assistant", "cut"), (1, 7, "assistant", "cut"), (1, 9, "user", "Hi."), (1, 9, "", "no role!"), (2, 3, "user", " \t\n"),
    (None, 1, "user", "Null id."), (None, None, "User", "case."), (3, 5, "assistant", "x" * 300_000 + "."), (3, 5, "user", " "), (4, 1, "system", "Only."),
]


def test_awkward_rows(spark):
    rows = spark.createDataFrame([(*r, "extra", 1) for r in AWKWARD], SCHEMA + ", digest string, fault int")
    assert _found(dialogs.audits(rows)) == _plain(AWKWARD)
    assert _found(dialogs.audits(dialogs.damaged(rows))) == _plain(brute.damage(AWKWARD))
    empty = rows.limit(0)
    assert dialogs.audits(empty).collect() == [] and dialogs.repaired(empty).collect() == []


def test_repaired_rows_are_in_place_and_legal(spark):
    rows = spark.createDataFrame(AWKWARD, SCHEMA)
    out = {}
    for r in sorted(dialogs.repaired(rows).collect(), key=lambda r: (r.conv_id or 0, r.place)):
        out.setdefault(r.conv_id, []).append(r)
    for conv, found in out.items():
        assert [r.place for r in found] == list(range(len(found)))
        roles = "".join(r.role[0] for r in found).removeprefix("s")
        assert roles and roles == "ua" * (len(roles) // 2)
        want = brute.repair([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in AWKWARD if c == conv])
        assert "\n".join(f"{r.role}:{r.text}" for r in found) == want[-1]
