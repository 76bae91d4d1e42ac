"""Conversation repair against a plain search over the grammar's states."""

import hashlib
import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from wordmill.llm import repair
from wordmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(letters):
    """Least (cost, audit) by a search over states, and the repaired roles."""
    best = {"": (0, "")}

    def put(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserts(table):
        for _ in range(4):
            for state, (cost, audit) in list(table.items()):
                for new in NEXT[state]:
                    if new != "s":
                        put(table, new, (cost + 2, audit + "I"))
        return table

    best = inserts(best)
    for letter in letters:
        new = {}
        for state, (cost, audit) in best.items():
            put(new, state, (cost + 3, audit + "D"))
            if letter in "bd":
                continue
            extra = letter.isupper()
            for role in NEXT[state]:
                if role == letter.lower():
                    put(new, role, (cost + extra, audit + "K"))
                elif role != "s":
                    put(new, role, (cost + extra + 2, audit + "R"))
        best = inserts(new)
    return min(v for s, v in best.items() if s in ("", "a"))


def test_every_short_conversation():
    for n in range(5):
        for letters in map("".join, itertools.product("suaoUbS", repeat=n)):
            assert repair.align(letters.encode()) == cheapest(letters), letters


@settings(max_examples=150, deadline=None)
@given(st.text("suaoSUAObd", max_size=60), st.integers(1, 9))
def test_blocks_of_any_size(letters, block):
    want = cheapest(letters)
    assert repair.align(letters.encode()) == want
    assert repair.align(letters.encode(), block) == want


def test_long_conversation_grows_with_its_length():
    rng = random.Random(3)
    letters = "".join(rng.choice("uauauauaUsbdo") for _ in range(6_000))
    assert repair.align(letters.encode()) == cheapest(letters)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = brute.crc(":".join(" " if x is None else str(x) for x in (conv, turn))) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def report(rows):
    """{conv_id: the contract's columns} for undamaged rows."""
    out = {}
    told = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted(
            (r for r in told if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()),
        )
        seen, letters, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, _, role, text in own:
            shown = text.strip(brute.SPACES)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not shown:
                letter, fault = "b", "b"
            elif (role, text) in seen:
                letter, fault = "d", "d"
            elif shown[-1] not in ".!?":
                letter, fault = letter.upper(), "t"
            else:
                fault = ""
            seen.add((role, text))
            letters += letter
            if fault:
                counts[fault] += 1
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(letters)
        length = len(audit) - audit.count("D")
        lines, left = [], iter(own)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            role = "user" if (length - len(lines)) % 2 == 0 else "assistant"
            lines.append(f"{row[2] if letter == 'K' else role}:{row[3] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, digest)
    return out


def collected(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op13_conversation_repair"](spark, SF)) == report(rows)


def sample_rows():
    rng = random.Random(8)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 14)):
            text = rng.choice(["Yes.", "No", "ok!", "", " \t", None, "é?\n", "same.", "long " * rng.randint(1, 4) + rng.choice(".x")])
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "system", "tool", None, "", "user"]), text))
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (70, None, "user", "x."), (70, None, "assistant", "y."), (70, 3, "user", "z")]
    rows += [(71, 5, "assistant", "w" * 400_000 + "."), (71, 6, "user", "last.")]
    rows += [(72, t, "ua"[t % 2] and ("user", "assistant")[t % 2], f"turn {t}.") for t in range(1500)]  # several blocks and pieces
    rows += rows[:40]  # repeated rows
    return rows


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(sample_rows(), "conv_id long, turn long, role string, text string").repartition(5)


def test_nulls_ties_long_texts_and_clashing_columns(turns):
    clashing = turns.withColumns({c: F.lit(c) for c in ("name", "at", "audit", "digest", "kind", "copy", "position", "gaps")})
    found = collected(repair.repair_report(repair.damaged(clashing), clashing))
    assert found == report(sample_rows())


def test_repaired_turns_follow_the_grammar(turns):
    audits, repaired = repair.repair(turns)
    roles = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.name, r.position)):
        assert r.position == len(roles.setdefault(r.name, ""))
        roles[r.name] += r.role[0]
    kept = {r.name: len(r.audit) - r.audit.count("D") for r in audits.collect()}
    assert {n: len(x) for n, x in roles.items()} == {n: k for n, k in kept.items() if k}
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())


def test_empty_table_and_conversation_without_rows(spark, turns):
    empty = turns.limit(0)
    assert repair.repair_report(empty, empty).collect() == []
    row = repair.repair_report(empty, turns.filter("conv_id = 3")).collect()
    assert [tuple(r) for r in row] == [(3, 0, 0, 0, 0, 0, 0, "", repair.NOTHING)]
