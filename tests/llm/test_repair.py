"""Repair of conversations against a plain version that tries all edits row by row."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from txnguard.llm import lattice, queries, repair

FORM = {"": "su", "s": "u", "u": "a", "a": "u"}  # last initial -> what may follow


def plain_audit(symbols):
    """Least (cost, audit), by dynamic programming from the end; symbols: (initial or None, gone, cut)."""
    ends = {"": (0, ""), "a": (0, "")}
    best = None
    for k in range(len(symbols), -1, -1):
        here = {}
        for last in FORM:
            options = [ends[last]] if k == len(symbols) and last in ends else []
            if k < len(symbols):
                initial, gone, cut = symbols[k]
                options.append((best[last][0] + 3, "D" + best[last][1]))
                if not gone:
                    if initial in FORM[last]:
                        options.append((best[initial][0] + cut, "K" + best[initial][1]))
                    for c in "ua":
                        if c in FORM[last]:
                            options.append((best[c][0] + 2 + cut, "R" + best[c][1]))
            if options:
                here[last] = min(options)
        for _ in range(4):  # insertions lead from state to state within a row
            for last, after in FORM.items():
                for c in "ua":
                    if c in after and c in here:
                        here[last] = min(here.get(last, (10**9, "")), (here[c][0] + 2, "I" + here[c][1]))
        best = here
    return best[""]


def plain_repair(rows):
    """rows: (turn, role, text) after damage -> the report."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, symbols, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = re.findall(r"[^\x20\x09-\x0D]", text)
        again, cut = (role, text) in seen, bool(bare) and bare[-1] not in ".!?"
        seen.add((role, text))
        fault = 0 if not bare else 1 if again else 2 if cut else None
        if fault is not None:
            counts[fault] += 1
        symbols.append((role[:1], fault in (0, 1), int(fault == 2)))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = plain_audit(symbols)
    lines, at = [], 0
    n = sum(x != "D" for x in audit)
    form = ("s" if n % 2 else "") + "ua" * (n // 2)
    for x in audit:
        if x == "D":
            at += 1
            continue
        role = {"u": "user", "a": "assistant", "s": "system"}[form[len(lines)]]
        if x == "I":
            lines.append(f"{role}:")
        else:
            lines.append(f"{rows[at][1] if x == 'K' else role}:{rows[at][2]}")
            at += 1
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            yield from [row] * (2 if kind == 3 else 1)


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def expected(rows):
    after = grouped(plain_damage(rows))
    return {c: plain_repair(after.get(c, [])) for c in grouped(rows)}


def got(df):
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{folder}/conversations.parquet'").fetchall()
    assert got(queries.op13_dijkstra_repair(spark, folder)) == expected(rows)


def test_search_is_exact():
    rng = random.Random(3)
    for _ in range(3000):
        signature = "".join(rng.choice("suaxSUAXDuauaua") for _ in range(rng.randrange(12)))
        symbols = [(x.lower() if x != "D" else "x", x == "D", int(x.isupper())) for x in signature]
        whole = lattice.repair_plan(signature)
        assert whole == plain_audit(symbols)
        cut = rng.randrange(len(signature) + 1)
        assert lattice.joined([lattice.passages(signature[:cut]), lattice.passages(signature[cut:])]) == whole


def odd_rows():
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "s", "User"], ["Yes.", "No", "", " \t", None, "\n", "Well? ", "é!\U0001f600", "x" * 50_000]
    rows = [(c, rng.choice([None, 0, 1, 2, 5, 9]), rng.choice(roles), rng.choice(texts)) for c in [None, 1, 2, 3, 1 << 62] for _ in range(6)]
    return rows + rows[:4] + [(7, None, None, None), (8, 3, "user", "Hi."), (9, k := 1, "assistant", "Ok."), (9, k, "assistant", "Ok.")]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", `key` string, rows long")
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(repair.repair(df)) == {c: plain_repair(x) for c, x in grouped(spaced).items()}
    assert repair.repair(df.limit(0)).count() == 0


def test_long_conversations_are_searched_in_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 7)
    rng = random.Random(9)
    rows = odd_rows()
    for conv, n in ((20, 7), (21, 8), (22, 300), (23, 49), (None, 30)):
        for k in range(n):
            role = rng.choice(["user", "assistant"][k % 2 :: 2] * 6 + ["system", "tool"])
            rows.append((conv, rng.choice([k, k, k + 40, None]), role, rng.choice([f"Text {k}.", f"Text {k}.", "Ok.", "and", ""])))
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    found = got(repair.repair(spark.createDataFrame(rows, SCHEMA)))
    assert found == {c: plain_repair(x) for c, x in grouped(spaced).items()}
