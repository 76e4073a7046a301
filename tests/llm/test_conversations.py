"""Conversation repair against a plain search over whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from tilewright.llm import conversations, queries
from tilewright.llm.common import read_table
from tilewright.session import local_frame

SF = "/root/testdata/sf0.01"
ROWS = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        out += [row, row] if fault == 3 else [row]
    return out


def faults_of(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        if not last:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def in_order(rows):
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:200], digest(r[3])))


def step(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "", ("a", "u"): "u"}.get((state, initial))


def cheapest(rows, faults):
    """Least (cost, edits) over whole strings, with the roles made as the state: a regular expression judges."""
    best = {"": (0, "", ())}  # the last initial and whether any row is there: (cost, edits, repaired)

    def spread(best):
        todo = list(best.items())
        while todo:
            state, (cost, edits, made) = todo.pop()
            for role in ("user", "assistant"):
                new = (cost + 3, edits + "I", (*made, f"{role}:"))
                target = follow(state, role[0])
                if target is not None and new[:2] < best.get(target, (10**9, ""))[:2]:
                    best[target] = new
                    todo.append((target, new))
        return best

    def follow(state, initial):
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return initial if initial and initial in allowed else None

    for (_, _, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, edits, made) in spread(best).items():
            options = [(state, cost + 4, "D", made)]
            if fault not in ("blank", "duplicate"):
                extra = cost + (3 if fault == "truncated" else 0)
                options.append((follow(state, role[:1]), extra, "K", (*made, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    options.append((follow(state, other[0]), extra + 3, "R", (*made, f"{other}:{text}")))
            for target, total, edit, lines in options:
                way = (total, edits + edit, lines)
                if target is not None and way[:2] < new.get(target, (10**9, ""))[:2]:
                    new[target] = way
        best = new
    ends = spread(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def expected(rows, damage=True):
    """What op12 returns, by the plain way."""
    after = damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    result = {}
    for conv in {r[0] for r in rows}:
        mine = in_order(r for r in after if r[0] == conv)
        faults = faults_of(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        cost, edits, lines = cheapest(mine, faults)
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        result[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            edits,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return result


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    rows = df.select("conv_id", *COLUMNS).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_conversation_repair(spark, SF)) == expected(rows)


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["a.", "b", "c?", " \n", "", f"t{turn}.", f"u{turn}!", f"v{turn}", None, "é. \t"])
            rows += [(conv, rng.choice([turn, turn, turn, None, 2 * turn]), role, text)] * rng.choice([1, 1, 1, 2, 5])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [None, 7])
def test_random_conversations(spark, blocks):
    """Ties, nulls, unknown roles, copies; in one range and cut into several, in the middle of conversations."""
    rows = random_rows(blocks or 1, [None, *range(60)], 12)
    df = local_frame(spark, rows, ROWS)
    assert found(conversations.conversation_digests(df, df, blocks=blocks)) == expected(rows, damage=False)


def test_one_conversation_over_many_ranges(spark):
    """No task needs to hold a whole conversation: four fifths of all rows are of one."""
    rows = random_rows(5, [1] * 40, 12) + random_rows(6, [2, 3], 30)
    df = local_frame(spark, rows, ROWS)
    blocks = conversations.repair_conversations(df, blocks=16).groupBy("block").count().collect()
    assert len(blocks) >= 10 and max(r["count"] for r in blocks) < len(set(rows)) / 4
    for count in (16, 3):
        assert found(conversations.conversation_digests(df, df, blocks=count)) == expected(rows, damage=False)


def test_all_edits_of_short_conversations():
    """Every edit string up to a length, kept if a regular expression likes its roles."""
    for seed in range(150):
        rows = in_order((0, t, r or " ", x or " ") for _, t, r, x in random_rows(seed, [0], 2))[:4]
        faults = faults_of(rows)
        wanted = min(all_edits(rows, faults))
        survivors = conversations.Fragment(open_start=False)
        for row, fault in zip(rows, faults):
            initial = row[2][:1] if row[2][:1] in ("s", "u", "a") else ""
            survivors.step(initial, int(fault in ("blank", "duplicate")), fault == "truncated")
        survivors.close()
        edits = "".join(w[0].split(":")[0] for w in survivors.ready)
        assert edits == wanted[1] and cheapest(rows, faults)[:2] == wanted


def all_edits(rows, faults, most_inserts=3):
    """(cost, edits) of every sequence of edits with few inserts whose roles are right."""
    inserts = ["".join(p) for n in range(most_inserts) for p in itertools.product("ua", repeat=n)]
    choices = []
    for (_, _, role, _), fault in zip(rows, faults):
        cut = 3 if fault == "truncated" else 0
        ways = [(4, "D", "")]
        if fault not in ("blank", "duplicate"):
            ways += [(cut, "K", role[:1] or "?"), (3 + cut, "R", "u"), (3 + cut, "R", "a")]
        choices.append([(3 * len(i) + c, "I" * len(i) + e, i + r) for i in inserts for c, e, r in ways])
    choices.append([(3 * len(i), "I" * len(i), i) for i in inserts])
    for parts in itertools.product(*choices):
        if re.fullmatch("(s?(ua)+)?", "".join(p[2] for p in parts)):
            yield sum(p[0] for p in parts), "".join(p[1] for p in parts)


def test_survivors_stay_few():
    """On a long conversation without end, only the newest rows are open."""
    fragment, most = conversations.Fragment(open_start=False), 0
    rng = random.Random(1)
    for _ in range(20_000):
        fragment.step(rng.choice("uaua") if rng.random() < 0.9 else "", int(rng.random() < 0.1), rng.random() < 0.1)
        start = fragment.starts[0]
        most = max(most, len(start.open_rows(start.best_end())))
    assert most < 200 and len(fragment.ready) > 19_000


def test_system_rows_do_not_hold_up():
    """The way that keeps nothing is dropped once it can no longer win."""
    fragment = conversations.Fragment(open_start=True)
    for initial in "ua" * 50:
        fragment.step(initial, 0, False)
    assert len(fragment.ready) >= 90


def test_ids_without_rows_and_empty_tables(spark):
    df = local_frame(spark, [(7, 1, "user", "x."), (None, None, None, None)], ROWS)
    got = found(conversations.conversation_digests(df.limit(0), df))
    assert got == {k: (0, 0, 0, 0, 0, 0, "", EMPTY) for k in (7, None)}
    assert found(conversations.conversation_digests(df.limit(0), df.limit(0))) == {}


def test_repaired_rows_and_clashing_names(spark):
    names = "block long, place long, costs string, _role long, conv_id long, turn long, role string, text string"
    rows = [(9, 9, "x", 9, 1, 0, "user", "Hi."), (9, 9, "x", 9, 1, 1, "user", "x" * 100_000 + "?")]
    got = conversations.repair_conversations(local_frame(spark, rows, names)).orderBy("block", "place").collect()
    assert "".join(r.edits for r in got) == "KR"
    lines = [(x.role, len(x.text)) for r in got for x in r.repaired]
    assert sum(r.cost for r in got) == 3 and lines == [("user", 3), ("assistant", 100_001)]
