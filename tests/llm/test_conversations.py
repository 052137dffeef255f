import hashlib
import itertools
import random
import zlib

import pytest

from careflow.llm import conversation_repair as repair
from tests.llm.conftest import SF_CHECK

COST = {"K": 0, "R": 2, "D": 3, "I": 2}
AFTER_ANY = {"": "u", "s": "u", "u": "a", "a": "u"}


def exhaustive(initials, faults, inserts=2):
    """Cheapest, then least edits, by trying every string of edits."""
    best = None
    choices = ["D" if f in "bd" else "DKR" for f in faults]
    for letters in itertools.product(*choices):
        for gaps in itertools.product(range(inserts + 1), repeat=len(initials) + 1):
            edits = "".join("I" * g + x for g, x in zip(gaps, [*letters, ""], strict=True))
            roles, cost, row, last = "", 0, 0, ""
            for e in edits:
                cost += COST[e] + (e in "KR" and faults[row] == "t")
                if e != "D":
                    last = initials[row] if e == "K" else AFTER_ANY[last if last in AFTER_ANY else ""]
                    roles += last
                row += e != "I"
            body = roles[1:] if roles.startswith("s") else roles
            legal = roles == "" or (body != "" and body == "ua" * (len(body) // 2))
            if legal and (best is None or (cost, edits) < best):
                best = (cost, edits)
    return best


def table_fold(initials, faults):
    """The same by whole strings in four states, without nodes."""
    def better(d, k, v):
        d[k] = min(d.get(k, v), v)

    def inserted(ways):
        out = dict(ways)
        for _ in range(3):
            for s, (c, t) in list(out.items()):
                better(out, AFTER_ANY[s], (c + 2, t + "I"))
        return out

    ways = {"": (0, "")}
    for i, f in zip(initials, faults, strict=True):
        new = {}
        for s, (c, t) in inserted(ways).items():
            better(new, s, (c + 3, t + "D"))
            if f not in "bd":
                better(new, AFTER_ANY[s], (c + 2 + (f == "t"), t + "R"))
                if (i == "s" and s == "") or (i in "ua" and AFTER_ANY[s] == i):
                    better(new, i, (c + (f == "t"), t + "K"))
        ways = new
    ways = inserted(ways)
    return min(ways[s] for s in ("", "a") if s in ways)


def brute(rows):
    """Contract columns of one conversation's rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = "", set()
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\f\r")
        faults += "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
        seen.add((role, text))
    initials = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "?" for r in rows)
    cost, audit = table_fold(initials, faults)
    out, row, last = [], 0, ""
    for e in audit:
        if e != "D":
            last = initials[row] if e == "K" else AFTER_ANY[last]
            role = rows[row][1] if e == "K" else {"u": "user", "a": "assistant"}[last]
            out.append(f"{role}:{'' if e == 'I' else rows[row][2]}")
        row += e != "I"
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def random_strings(draw, n):
    return "".join(draw.choices("suasua?", k=n)), "".join(draw.choices("--tbd-", k=n))


def test_edits_against_every_string():
    draw = random.Random(5)
    for _ in range(150):
        initials, faults = random_strings(draw, draw.randrange(5))
        ends = repair.slice_edits(initials, faults, repair.NOTHING)
        got = min(ends[s] for s in (repair.NOTHING, repair.ASSISTANT) if s in ends)
        assert got == exhaustive(initials, faults) == table_fold(initials, faults)


@pytest.mark.parametrize("modulus", [2, 7, 2**61 - 1])
def test_collisions_of_hashes_decide_nothing(modulus):
    draw = random.Random(modulus)
    for _ in range(400):
        initials, faults = random_strings(draw, draw.randrange(40))
        ends = repair.slice_edits(initials, faults, repair.NOTHING, modulus)
        assert min(ends[s] for s in (repair.NOTHING, repair.ASSISTANT) if s in ends) == table_fold(initials, faults)


def test_order_of_linked_strings():
    draw = random.Random(2)
    edits = repair.Edits(modulus=5)
    nodes = [0]
    for _ in range(300):
        nodes.append(edits.add(draw.choice(nodes[-6:]), draw.choice("DIKR")))
    for _ in range(3000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert edits.less(a, b) == (edits.text(a) < edits.text(b))


def test_slices_join_to_the_whole():
    draw = random.Random(7)
    for _ in range(400):
        n = draw.randrange(25)
        initials, faults = random_strings(draw, n)
        cuts = [0, *sorted(draw.choices(range(n + 1), k=draw.randrange(4))), n]
        parts = [(initials[a:b], faults[a:b]) for a, b in itertools.pairwise(cuts)]
        tables = [{s: repair.slice_edits(i, f, s) for s in range(4)} for i, f in parts]
        cost, path = repair.join_slices(tables)
        assert (cost, "".join(t[s][e][1] for t, (s, e) in zip(tables, path, strict=True))) == table_fold(initials, faults)


def test_inserts_and_ties():
    assert table_fold("ua", "--") == (0, "KK") and table_fold("a", "-") == (2, "IK")
    ends = repair.slice_edits("u", "-", repair.NOTHING)
    assert min(ends[s] for s in (0, 3) if s in ends) == (2, "KI")
    ends = repair.slice_edits("us", "--", repair.NOTHING)
    assert min(ends[s] for s in (0, 3) if s in ends) == (2, "KR")


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def whole(conversations, slice_rows):
    audits, rows = repair.repair(conversations, slice_rows=slice_rows)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.repaired_digests(rows).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS[:-1]) + (digests.get(r["conv_id"], empty),) for r in audits.collect()}


@pytest.mark.parametrize("slice_rows", [4, 20_000])
def test_tables_with_everything(spark, slice_rows):
    """Null keys, turns, roles and texts, repeated rows and turns, other roles, extra columns."""
    draw = random.Random(13)
    texts = ["Yes.", "No!", "", " \t", None, "cut off", "what? ", "the same words.", "z" * 5000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = []
    for conv in [None, 0, 1, 2, 2**53 + 1, 2**53 + 3, -2**62 - 5]:
        n = draw.choice([1, 3, 30, 60])
        rows += [(conv, draw.choice([None, 3, *range(n)]), draw.choice(roles), draw.choice(texts), 1, "x") for _ in range(n)]
        rows += rows[-1:] * draw.randrange(20)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int, fault string").repartition(4)
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = brute([(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, _, _ in rows if c == conv])
    assert whole(table, slice_rows) == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    audits, rows = repair.repair(none)
    assert audits.collect() == [] and rows.collect() == [] and repair.repaired_digests(rows).collect() == []


def test_query_against_brute_force(spark):
    from careflow.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF_CHECK}/conversations.parquet").collect()
    after = {r["conv_id"]: [] for r in rows}
    for r in rows:
        draw = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if draw == 1 else r["text"].translate(str.maketrans("", "", ".!?")) if draw == 2 else r["text"]
        if draw:
            after[r["conv_id"]] += [(r["turn"], "user" if draw == 4 else r["role"], text)] * (2 if draw == 3 else 1)
    want = {c: brute(x) for c, x in after.items()}
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_conversation_repair"](spark, SF_CHECK).collect()}
    assert got == want
