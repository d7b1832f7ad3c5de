"""Conversation repair against a search over all edits, in plain Python."""

import hashlib
import itertools
import random
import re
from zlib import crc32

import pytest

from postsift.llm import convrepair, queries

SOUND = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """(role, text, fault) of sorted rows."""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.strip(WHITE)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def search(rows):
    """Cost, audit and turns of the cheapest edits, from an automaton over (row, last initial): no targets, no bands."""
    n = len(rows)
    best = [{} for _ in range(n + 1)]  # what is left from there: cost, audit, turns
    after = {"": "us", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    for i in range(n, -1, -1):
        cell = {x: (0, "", ()) for x in ("", "a")} if i == n else {}

        def offer(x, cost, step, rest, turn):
            if rest is not None:
                way = (cost + rest[0], step + rest[1], turn + rest[2])
                if x not in cell or way[:2] < cell[x][:2]:
                    cell[x] = way

        if i < n:
            role, text, fault = rows[i]
            for x in after:
                offer(x, 3, "D", best[i + 1].get(x), ())
                if fault not in ("blank", "duplicate"):
                    for y in after[x]:
                        if role[:1] == y:
                            offer(x, fault == "truncated", "K", best[i + 1].get(y), ((role, text),))
                        elif y in names:
                            offer(x, 2 + (fault == "truncated"), "R", best[i + 1].get(y), ((names[y], text),))
        for _ in range(4):  # insertions in a row
            for x in after:
                for y in after[x]:
                    if y in names:
                        offer(x, 2, "I", cell.get(y), ((names[y], ""),))
        best[i] = cell
    return best[0][""]


def plain(rows):
    """The result for the rows (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, left = search(found)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == x for _, _, f in found) for x in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    )


def damaged(rows):
    """The contract's damage of rows (conv, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def conversations(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No?", "Well", "", " ", "\n\t", "é.", "Long! ", "a.b", "x" * 3000 + ".", "..", "And so on?\r\n"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("assistant" if turn % 2 else "user")
            if turn == 0 and rng.random() < 0.3 or rng.random() < 0.05:
                role = rng.choice(["system", "tool", "User", "", "u", "s", None])
            rows.append((conv, rng.choice([turn, turn, turn, None, 2 * turn]), role, rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    return rows


def test_alignment_is_the_search():
    rng = random.Random(1)
    for n in range(8):
        for _ in range(120 if n else 1):
            turns = "".join(rng.choice("usaoUSAO") for _ in range(n))
            rows = [({"u": "user", "s": "system", "a": "assistant", "o": "x"}[t.lower()], "", "truncated" if t.isupper() else "") for t in turns]
            assert convrepair.cheapest(turns, "", convrepair.FINAL)[:2] == search(rows)[:2], turns


def test_targets():
    for entry, exit_ in itertools.product(convrepair.STATES, repeat=2):
        got = [t for _, t in itertools.takewhile(lambda x: x[0] < 7, convrepair.targets(entry, exit_))]
        after = {"": "us", "s": "u", "u": "a", "a": "u"}
        want = []
        for length in range(7):
            for t in itertools.product("sua", repeat=length):
                states = [entry, *t]
                if all(b in after[a] for a, b in itertools.pairwise(states)) and states[-1] == exit_:
                    want.append("".join(t))
        assert sorted(got) == sorted(want)
        assert all(SOUND.fullmatch(t) for t in got if entry == "" and exit_ in convrepair.FINAL)


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed):
    """The registered query, with its damage, on short, long, odd and null conversations in many partitions."""
    rows = conversations(seed, 150, 9) + [(1000 + c, *r) for c, *r in conversations(seed + 9, 4, 300)]
    rows += [(5000, 3, "user", "Same.")] * 400 + [(5001, t, "user", "Same.") for t in range(500)] + [(5002, None, None, None)]
    rows += [(None, t, r, f"{t}!") for t, r in enumerate(["system", "user", "assistant"] * 30)] + [(6000 + i, 0, "user", "One.") for i in range(60)]
    random.Random(seed).shuffle(rows)
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(c, t, r, x, "at", 1) for c, t, r, x in rows], schema + ", at string, conv long").repartition(7)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.LLM_QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    left = by_conversation(damaged(rows))
    want = {c: plain(left.get(c, [])) for c in {r[0] for r in rows}}
    found = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert found.keys() == want.keys()
    assert {c: v for c, v in found.items() if v != want[c]} == {}
    assert all(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, v in found.items() if c not in left)


def test_turns_are_sound(spark):
    rows = conversations(5, 60, 80)
    done = convrepair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = {}
    for r in sorted(done.turns.collect(), key=lambda r: (r.conv, r.at)):
        out[r.conv] = out.get(r.conv, "") + "".join(x[0] for x in r.roles)
    assert out.keys() == {r[0] for r in rows}
    assert all(SOUND.fullmatch(x) for x in out.values())


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    done = convrepair.repair(df)
    assert done.conversations.collect() == done.turns.collect() == done.digests().collect() == []
