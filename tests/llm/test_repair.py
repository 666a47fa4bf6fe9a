"""Repair of conversations against a search over all lists of edits, and against plain Python on a whole table."""

import itertools
import random
import re
from hashlib import sha256
from zlib import crc32

import pytest

from forumlens.llm import queries, repair

COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACES = " \t\n\v\f\r"


def faults_of(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        found.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return found


def brute_edits(rows, faults):
    """(cost, audit, lines): the least of all lists with at most two inserted messages between rows."""
    best = None
    # breadth first over rows: every (roles so far, audit, cost, lines); roles by their whole string
    partial = {("", ""): (0, ())}
    def with_inserts(items):
        out = dict(items)
        now = dict(items)
        for _ in range(2):
            later = {}
            for (initials, audit), (cost, lines) in now.items():
                for role in ("user", "assistant"):
                    later[initials + role[0], audit + "I"] = (cost + 3, lines + (f"{role}:",))
            out |= later
            now = later
        return out
    for (_, role, text), fault in zip(rows, faults):
        later = {}
        for (initials, audit), (cost, lines) in with_inserts(partial).items():
            more = 3 if fault == 3 else 0
            ways = [(initials, "D", 4, ())]
            if fault not in (1, 2):
                ways.append((initials + role[:1], "K", more, (f"{role}:{text}",)))
                ways += [(initials + r[0], "R", 3 + more, (f"{r}:{text}",)) for r in ("user", "assistant")]
            for initials2, letter, price, line in ways:
                if not re.fullmatch("(s?(ua)*u?)?", initials2):
                    continue
                key, value = (initials2, audit + letter), (cost + price, lines + line)
                if key not in later or value[0] < later[key][0]:
                    later[key] = value
        partial = later
    for (initials, audit), (cost, lines) in with_inserts(partial).items():
        if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, lines)
    return best


def plain_edits(rows, faults):
    """The same by cost to go, row by row from the end, and the least letter from the front."""
    follows, n = {0: 2, 1: 2, 2: 3, 3: 2}, len(rows)
    def ways(i, place):
        yield "I", i, follows[place], 3
        if i == n:
            return
        yield "D", i + 1, place, 4
        if faults[i] in (1, 2):
            return
        more, initial = (3 if faults[i] == 3 else 0), rows[i][1][:1]
        if initial == "":
            yield "K", i + 1, place, more
        elif initial == "s" and place == 0:
            yield "K", i + 1, 1, more
        elif initial in "ua" and follows[place] == {"u": 2, "a": 3}[initial]:
            yield "K", i + 1, follows[place], more
        yield "R", i + 1, follows[place], 3 + more
    togo = [[0 if i == n and p in (0, 3) else 10**12 for p in range(4)] for i in range(n + 1)]
    for i in range(n, -1, -1):
        for _ in range(4):
            for p in range(4):
                togo[i][p] = min([togo[i][p], *[price + togo[j][q] for _, j, q, price in ways(i, p)]])
    i, place, audit, lines, cost = 0, 0, "", [], togo[0][0]
    while not (i == n and togo[i][place] == 0):
        letter, j, q, price = min(w for w in ways(i, place) if w[3] + togo[w[1]][w[2]] == togo[i][place])
        role = {2: "user", 3: "assistant"}.get(q)
        if letter == "I":
            lines.append(f"{role}:")
        elif letter != "D":
            lines.append(f"{rows[i][1] if letter == 'K' else role}:{rows[i][2]}")
        audit, i, place = audit + letter, j, q
    return cost, audit, tuple(lines)


def report_of(rows, edits=plain_edits):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = edits(rows, faults)
    return (gaps, *[faults.count(k) for k in (1, 2, 3)], illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())


def reports(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.reports(repair.repair(df, **options)).select("conv_id", *COLUMNS).collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: tuple(r)[1:] for r in found}


def random_rows(draw, n):
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", ""], ["a.", "b?", "c", "", " \n", "d! ", "e. "]
    return [(draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def test_plain_edits_are_the_least_of_all_lists():
    draw = random.Random(5)
    for k in range(150):
        rows = random_rows(draw, k % 5)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        if any(r[1] == "" for r in rows):  # stands outside the order
            continue
        assert plain_edits(rows, faults_of(rows)) == brute_edits(rows, faults_of(rows))


@pytest.mark.parametrize("options", [{}, {"held": 2}, {"held_bytes": 8}])
def test_reports_equal_plain_python(spark, options):
    draw = random.Random(7)
    rows = [(c, *r) for c in [None, *range(60)] for r in random_rows(draw, 1 + draw.randrange(25))]
    rows += [(100, i, "user", f"t{i % 3}.") for i in range(5000)]  # one with half of all rows
    found = reports(spark, rows, **options)
    by_conv = {}
    for conv, *row in rows:
        by_conv.setdefault(conv, []).append(tuple(row))
    assert found == {c: report_of(own) for c, own in by_conv.items()}


def test_odd_cases(spark):
    long = "word " * 40000 + "end."
    rows = [(1, 0, None, None), (1, 1, "user", long), (1, 2, "assistant", long), (2, None, "user", "x."), (2, None, "user", "x."), (3, 5, "", "hm.")]
    found = reports(spark, rows)
    assert found[1][:7] == (0, 1, 0, 0, 1, 4, "DKK")
    assert found[2][:7] == (0, 0, 1, 0, 1, 7, "KDI")
    assert found[3][:7] == (0, 0, 0, 0, 0, 0, "K")
    assert reports(spark, rows[:0]) == {}


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.", 7, "x", 9), (1, 0, "user", "a.", 7, "x", 9)], "Turn long, conv_id long, role string, text string, KEY int, `a.b` string, Edits int")
    found = repair.repair(df)
    assert found.columns[-4:] == ["seq", "fault", "edits", "roles"] and {"KEY", "a.b", "role"} <= set(found.columns)
    got = [(r["seq"], r["fault"], r["edits"], r["roles"], r["KEY"]) for r in found.orderBy("seq").collect()]
    assert got == [(0, "sound", "K", ["user"], 7), (1, "duplicate", "DI", ["assistant"], 7)]
    messages = repair.repaired_rows(found).orderBy("seq", "place").collect()
    assert [(m["role"], m["text"]) for m in messages] == [("user", "a."), ("assistant", "")]


def test_repaired_rows_are_sound(spark):
    draw = random.Random(3)
    rows = [(c, *r) for c in range(40) for r in random_rows(draw, 12) if r[1]]
    messages = repair.repaired_rows(repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    by_conv = {}
    for m in messages.orderBy("conv_id", "seq", "place").collect():
        by_conv[m["conv_id"]] = by_conv.get(m["conv_id"], "") + m["role"][0]
    assert by_conv and all(re.fullmatch("(s?(ua)+)?", x) for x in by_conv.values())


def test_query_equals_plain_python_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    by_conv = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        own = by_conv.setdefault(r["conv_id"], [])
        conv, turn, role, text = (" " if v is None else v for v in (r["conv_id"], r["turn"], r["role"], r["text"]))
        harm = crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        own += [(r["turn"], "user" if harm == 4 else role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    found = queries.op12_repair(spark, folder).select("conv_id", *COLUMNS).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {c: report_of(own) for c, own in by_conv.items()}
    assert len(found) == len(by_conv)


def test_a_conversation_without_rows_is_reported(spark, tmp_path):
    turn = next(t for t in range(200) if crc32(f"5:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(5, turn, "user", "x.")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = queries.op12_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
