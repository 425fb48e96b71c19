"""Conversation repair against a search over all edits, and the query against a plain version of its contract."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakekit.llm import repair
from lakekit.llm.queries import op11_conversation_repair

GRAMMAR = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(turns):
    """Least (cost, audit) and the repaired turns; ``turns``: (role, text, kind), kind d, cut or whole. A uniform-cost search."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, said = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            return cost, audit, said
        if (i, state, audit) in seen:
            continue
        seen.add((i, state, audit))
        for initial, role in (("u", "user"), ("a", "assistant")):
            if initial in GRAMMAR[state]:
                if len(audit) - i < 2 * len(turns) + 2 and not audit.endswith("III"):
                    heapq.heappush(heap, (cost + 2, audit + "I", i, initial, (*said, (role, ""))))
                if i < len(turns) and turns[i][2] != "d":
                    extra = turns[i][2] == "cut"
                    heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, initial, (*said, (role, turns[i][1]))))
        if i < len(turns):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, said))
            initial = turns[i][0][:1]
            if turns[i][2] != "d" and initial in GRAMMAR[state]:
                heapq.heappush(heap, (cost + (turns[i][2] == "cut"), audit + "K", i + 1, initial, (*said, turns[i][:2])))
    raise AssertionError


def recursive(turns):
    """As ``cheapest``, by the best rest for every turn and state (checked against it)."""
    rest = {state: (0, "", ()) for state in ("", "a")} | {"u": (2, "I", (("assistant", ""),)), "s": (4, "II", (("user", ""), ("assistant", "")))}
    for role, text, kind in reversed(turns):
        now = {}
        for state, after in GRAMMAR.items():
            options = [(3, "D", (), state)]
            if kind != "d":
                options += [(2 + (kind == "cut"), "R", ((name, text),), i) for i, name in (("u", "user"), ("a", "assistant")) if i in after]
                options += [(kind == "cut", "K", ((role, text),), role[:1])] if role[:1] in after else []
            now[state] = min((cost + rest[i][0], letter + rest[i][1], said + rest[i][2]) for cost, letter, said, i in options)
        for _ in range(2):
            for state, after in GRAMMAR.items():
                for i in set(after) & {"u", "a"}:
                    now[state] = min(now[state], (now[i][0] + 2, "I" + now[i][1], (("user" if i == "u" else "assistant", ""), *now[i][2])))
        rest = now
    return rest[""]


def plain(rows):
    """The contract for one conversation's rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, kinds = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "whole" if last[-1] in ".!?" else "cut")
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    pairs = zip(rows, rows[1:], strict=False)
    cost, audit, said = recursive([(r, t, "d" if k in ("blank", "duplicate") else k) for (_, r, t), k in zip(rows, kinds, strict=True)])
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("cut"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())


def damaged(rows):
    out = {}
    for c, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out.setdefault(c, []).extend([(turn, "user" if fault == 4 else role, text)] * (0, 1, 1, 2, 1)[fault] if fault < 5 else [(turn, role, text)])
    return out


def found(rows):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = {r.conv_id: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op11_conversation_repair(spark, folder).collect()) == {c: plain(r) for c, r in damaged(rows).items()}


def test_query_on_awkward_conversations(spark, tmp_path):
    dice = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "assistant", "user"]
    texts = ["Fine.", "cut off", "", " \x0b\n", None, "no end", "Ärger!", "really?  ", " ", "Fine.", "a.b"]
    rows = [(dice.choice([*range(60), None]), dice.choice([*range(9), None]), dice.choice(roles), dice.choice(texts)) for _ in range(400)]
    dropped = next(c for c in range(900, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "all of it dropped")] + [(-1, t, "user", "same") for t in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("_text", F.lit("x"))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    expected = {c: plain(r) for c, r in damaged(rows).items()}
    assert any(not audit for *_, audit, _ in expected.values())
    assert found(op11_conversation_repair(spark, str(tmp_path)).collect()) == expected
    frame.where("false").write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert op11_conversation_repair(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("seed", range(60))
def test_audit_is_the_least_of_all(seed):
    dice = random.Random(seed)
    turns = "".join(dice.choice(dice.choice(["sua", "uad", "suaxSUAXd", "uaUA"])) for _ in range(dice.randint(0, 6)))
    given = [("tool" if t.lower() == "x" else t.lower(), "", "d" if t == "d" else "cut" if t.isupper() else "whole") for t in turns]
    assert repair.repaired_audit(turns) == cheapest(given)[:2]
    assert recursive(given) == cheapest(given)


def test_parts_in_any_cuts_give_the_whole(monkeypatch):
    """Blocks and parts of a conversation, however cut, lead to the same cost and audit as one block."""
    dice = random.Random(5)
    for _ in range(150):
        turns = "".join(dice.choice("ssuuaauaxSUAXdd") for _ in range(dice.randint(1, 40)))
        monkeypatch.setattr(repair, "BLOCK", 1000)
        whole = repair.closed(repair.advanced(repair.opened(repair.START), turns))
        monkeypatch.setattr(repair, "BLOCK", dice.randint(1, 7))
        assert repair.closed(repair.advanced(repair.opened(repair.START), turns)) == whole
        front, at = repair.opened(repair.START), 0
        while at < len(turns):
            part, at = turns[at:at + (n := dice.randint(1, 15))], at + n
            front = repair.joined(front, [(q, r, x[0], repair.text_of(x[2])) for q in range(4)
                                          for r, x in enumerate(repair.advanced(repair.opened(q), part)) if x])
        assert repair.closed(front) == whole


def test_one_conversation_over_many_tasks(spark):
    """One conversation with most rows, cut at the borders of tasks; a great many equal rows in it."""
    roles = ["user", "assistant", "system", "user"]
    rows = [(7, t, roles[t * t % 7 % 4], f"text {t % 900} " + ("." if t % 3 else "-")) for t in range(3000)] + [(8, 1, "user", "x."), (7, None, "user", "ok.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.unionByName(spark.range(5000).selectExpr("7L AS conv_id", "50L AS turn", "'user' AS role", "'again.' AS text"))
    found = {r.conv_id: r for r in repair.audits(frame).collect()}
    pure = sorted([*rows[:3000], rows[-1], *[(7, 50, "user", "again.")] * 5000],
                  key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, turns = set(), []
    for _, _, role, text in pure:
        letter = "d" if (role, text) in seen else role[0] if text.endswith(".") else role[0].upper()
        seen.add((role, text))
        turns.append(letter)
    assert (found[7].cost, found[7].audit) == repair.repaired_audit("".join(turns))
    assert found[7].duplicate == turns.count("d") and found[7].gaps == 0 and found[8].audit == "KI"
    kept = repair.repaired_turns(frame, repair.audits(frame)).where("conv_id = 7").count()
    assert kept == len(found[7].audit) - found[7].audit.count("D")


def test_other_names_and_columns(spark, rows):
    frame = spark.createDataFrame([("a", 0, "user", "Hi.", "k"), ("a", 1, "assistant", "Yes.", "k"), ("b", 0, "assistant", "Yes.", "k")],
                                  "Chat string, no int, who string, said string, digest string")
    names = {"conv_id": "Chat", "turn": "no", "role": "who", "text": "said"}
    audits = repair.audits(frame, **names)
    assert [r[0:1] + r[-2:] for r in rows(audits)] == [("a", 0, "KK"), ("b", 2, "IK")]
    assert rows(repair.repaired_turns(frame, audits, **names)) == [
        ("a", 0, "K", "user", "Hi."), ("a", 1, "K", "assistant", "Yes."), ("b", 0, "I", "user", ""), ("b", 1, "K", "assistant", "Yes.")]
