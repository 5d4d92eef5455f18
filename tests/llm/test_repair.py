import hashlib
import itertools
import random
import re
import zlib

import pytest

from overflight.llm import repair
from tests.llm.texts import LONG

LEGAL = re.compile(r"(s?(ua)+)?")
ROLES = ["user", "assistant", "system", None, "tool", ""]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").selectExpr(
        "*", "1 AS at", "2 AS block", "3 AS symbol", "4 AS copy", "5 AS audit", "6 AS fault")


def exhaustive(symbols, most=8):
    """The least (cost, audit) of all edit sequences up to a length."""
    best, todo = None, [(0, "", 0, "")]
    while todo:
        cost, audit, i, made = todo.pop()
        if best and cost > best[0] or len(audit) > most:
            continue
        if i == len(symbols) and LEGAL.fullmatch(made):
            best = min(best or (cost, audit), (cost, audit))
        for role in "ua":
            todo.append((cost + 2, audit + "I", i, made + role))
        if i < len(symbols):
            initial, fault = symbols[i]
            todo.append((cost + 3, audit + "D", i + 1, made))
            if fault != "d":
                more = fault == "t"
                todo.append((cost + more, audit + "K", i + 1, made + initial))
                todo += [(cost + 2 + more, audit + "R", i + 1, made + role) for role in "ua"]
    return best


def every_split(symbols):
    """CYK over all spans with all splits."""
    n = len(symbols)
    cells = {(i, i + 1): repair.row_cell(s) for i, s in enumerate(symbols)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cells[i, i + size] = repair._least(
                kv for k in range(i + 1, i + size) for kv in repair.product(cells[i, k], cells[k, i + size]).items())
    return repair.cheapest(cells[0, n])


def test_parse_against_all_edits():
    symbols = ["".join(p) for p in itertools.product("suax", "-td")]
    draw = random.Random(2)
    for n in (1, 2, 3):
        for word in itertools.product(symbols, repeat=n) if n < 3 else [tuple(draw.choices(symbols, k=3)) for _ in range(60)]:
            assert repair.cheapest(repair.parsed(list(map(repair.row_cell, word)))) == exhaustive(word, n + 4)


def test_one_split_is_enough():
    draw = random.Random(3)
    for _ in range(60):
        word = [draw.choice("suuaax") + draw.choice("---td") for _ in range(draw.randrange(1, 25))]
        assert repair.cheapest(repair.parsed(list(map(repair.row_cell, word)))) == every_split(word)


def wanted(rows):
    out = {}
    space = lambda v: " " if v is None else v
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, space(r[2]), space(r[3])) for r in rows if r[0] == conv)
        seen, symbols, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in turns:
            plain = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "x") + {None: "-", "truncated": "t"}.get(fault, "d"))
        numbers = [t for known, t, *_ in turns if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = every_split(symbols)
        made, left = [], iter(turns)
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit != "D":
                role = row[2] if edit == "K" else "assistant" if made and made[-1][0][:1] == "u" else "user"
                made.append((role, row[3] if row else ""))
        assert LEGAL.fullmatch("".join(role[0] for role, _ in made))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


TEXTS = ["Hello.", "What? ", "cut off", "", " \n", None, "é!\n", "line\nline.", "a:b", "ok. "]


@pytest.mark.parametrize("bits", [12, 1])  # blocks of 4096 places, and of two
def test_conversations(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    draw = random.Random(5)
    rows = [(draw.choice([None, *range(50)]), draw.choice([None, *range(9)]), draw.choice(ROLES), draw.choice(TEXTS)) for _ in range(300)]
    rows += [(60, i, ("user", "assistant")[i % 2], f"text {i}.") for i in range(40)] + [(61, None, "user", "x.")] * 3
    rows += [(62, 0, "user", LONG), (62, 5, "assistant", LONG), (62, 9, "assistant", LONG)]
    got = {r.conv_id: tuple(r)[1:] for r in repair.repaired(table(spark, rows)).collect()}
    assert got == wanted(rows)


def test_long_conversation(spark):
    rows = [(1, i, ("user", "assistant", "tool")[i % 3], "go on." if i % 5 else f"text {i}") for i in range(9000)]
    (got,) = repair.repaired(table(spark, rows)).collect()
    assert len(got.audit.replace("I", "")) == 9000 and got.duplicate > 7000
    assert repair.cheapest(repair.parsed([repair.row_cell("u-")] * 3)) == every_split(["u-"] * 3)


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {c}-{t}?") for c in range(30) for t in (None, 0, 1, 2)] + [(None, None, None, None)]
    out = [tuple(r) for r in repair.damaged(table(spark, rows)).collect()]
    expected = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            expected += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert sorted(out, key=str) == sorted(expected, key=str)


def test_lost_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (got,) = repair.damaged_and_repaired(table(spark, [(gone, 0, "user", "x.")])).collect()
    assert tuple(got) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repaired(table(spark, [])).collect() == repair.damaged_and_repaired(table(spark, [])).collect() == []
