"""Conversation repair against the search through all repairs."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import conversation_repair as cr
from touchline.llm import queries

GRAMMAR = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def kinds(rows):
    """Faults of rows (turn, role, text) that are in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def best_repair(rows):
    """(cost, letters, repaired rows) by trying all."""
    faults, found = kinds(rows), []
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    each = []
    for (_, role, text), fault in zip(rows, faults):
        more = 3 if fault == "truncated" else 0
        ways = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            ways += [(more, "K", [(role, text)]), (3 + more, "R", [("user", text)]), (3 + more, "R", [("assistant", text)])]
        each.append([(c + 3 * len(i), "I" * len(i) + w, [(r, "") for r in i] + made) for i in inserts for c, w, made in ways])
    each.append([(3 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts])
    for way in itertools.product(*each):
        made = [r for w in way for r in w[2]]
        if GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in made)):
            found.append((sum(w[0] for w in way), "".join(w[1] for w in way), made))
    cost, letters = min(f[:2] for f in found)
    made = [m for c, w, m in found if (c, w) == (cost, letters)]
    assert all(m == made[0] for m in made)
    return cost, letters, made[0]


def report(conv, rows):
    turns = [t for t, _, _ in rows if t is not None]
    faults = kinds(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, letters, made = best_repair(rows)
    return (
        conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
    )


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def made_rows(seed, conversations, most):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "sam", ""]
    texts = ["Yes.", "No!", "cut off", " \n", "", "A long answer? ", "other."]
    return [
        (conv, pick.choice([turn, turn, turn + 3, None]), pick.choice(roles), pick.choice(texts))
        for conv in range(conversations) for turn in range(pick.randint(1, most))
    ]


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return {c: in_order(r) for c, r in out.items()}


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_repairs(spark, seed):
    rows = made_rows(seed, 60, 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted((report(c, r) for c, r in by_conversation(rows).items()), key=repr)
    assert collected(cr.audit_conversations(df).drop("n_rows")) == want
    repaired = [(c, i, r, t) for c, rs in by_conversation(rows).items() for i, (r, t) in enumerate(best_repair(rs)[2])]
    assert collected(cr.repair_conversations(df).select("conv_id", "place", "role", "text")) == sorted(repaired, key=repr)


def test_query_damages_and_repairs(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x in made_rows(3, 300, 3)]
    rows += [(None, 1, "user", "Hi."), (900, None, None, None), (901, 2, None, "a."), (901, 2, "user", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    left = {}
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        code, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        mine = left.setdefault(conv, [])
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        mine += [] if code == 0 else [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    want = sorted((report(c, in_order(r)) for c, r in left.items()), key=repr)
    assert any(r[-2] == "" for r in want) and any(not r for r in left.values())
    assert collected(queries.op11_conversation_repair(spark, str(tmp_path))) == want


def test_giant_conversation_across_batches_and_files(spark, monkeypatch):
    rows = [(1, n, "user" if n % 3 else "assistant", f"row {n}" + "." * (n % 5)) for n in range(40_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = collected(cr.audit_conversations(df))
    monkeypatch.setattr(cr, "MEMORY", 5_000)
    talk = cr.Conversation("1")
    for _, turn, role, text in rows:
        talk.add(str(turn), role, text, False)
    talk.end()
    assert talk._back.file and talk._texts.file
    assert (talk.rows, talk.cost, talk.audit, talk.sha256()) == (whole[0][1], whole[0][-3], whole[0][-2], whole[0][-1])
    made = list(talk.repaired())
    assert GRAMMAR.fullmatch("".join(r[2][0] for r in made)) and len(made) == len(talk.audit) - talk.audit.count("D")
    talk.close()


def test_odd_rows(spark, none):
    df = spark.createDataFrame(
        [(7, None, None, None, "k"), (7, None, None, None, "k"), (None, 3, "", "x" * 50_000, "k"), (8, 2**62, "user", "Yes.", "k")],
        SCHEMA + ", conv string",
    ).repartition(2)
    out = {r["conv_id"]: r for r in cr.audit_conversations(df).collect()}
    assert (out[7]["audit"], out[7]["blank"], out[7]["duplicate"], out[7]["illegal"]) == ("DD", 2, 0, 1)
    assert (out[None]["audit"], out[None]["cost"], out[None]["truncated"]) == ("D", 4, 1)
    assert (out[8]["audit"], out[8]["cost"], out[8]["gaps"]) == ("KI", 3, 0)
    assert cr.repair_conversations(df).where("conv_id = 8").select("turn", "edit").collect()[0]["turn"] == 2**62
    empty = none.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("source").alias("role"), "text")
    assert cr.audit_conversations(empty).collect() == [] and cr.repair_conversations(empty).collect() == []
    alone = cr.audit_conversations(df, there=F.lit(None).cast("boolean")).collect()
    assert {(r["n_rows"], r["gaps"], r["audit"], r["cost"]) for r in alone} == {(0, 0, "", 0)}
