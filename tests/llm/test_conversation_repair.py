"""Operator 11 against all edits of short conversations, and against SQL."""

import random

import pytest
from pyspark.sql import functions as F

from voltframe.llm import queries, repair

SCHEMA = "conv_id long, turn int, role string, text string, audit string, at int"


def is_legal(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return rest == "ua" * (len(rest) // 2) and (roles[:1] != "s" or rest != "")


def cheapest_by_all(turns, most_inserts=3):
    best = None

    def go(i, roles, cost, audit, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(turns) and is_legal(roles):
            best = min(best, (cost, audit)) if best else (cost, audit)
        for r in "ua" if inserts < most_inserts else "":
            go(i, roles + r, cost + 5, audit + "I", inserts + 1)
        if i < len(turns):
            initial, must_go, truncated = turns[i]
            go(i + 1, roles, cost + 2, audit + "D", inserts)
            if not must_go:
                extra = 5 if truncated else 0
                go(i + 1, roles + (initial or "?"), cost + extra, audit + "K", inserts)
                for r in "ua":
                    go(i + 1, roles + r, cost + 1 + extra, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return best


def test_parse_equals_all_edits():
    stacks, rng = repair.Stacks(), random.Random(1)
    for _ in range(400):
        turns = [(rng.choice(["s", "u", "a", "a", "u", "t", ""]), rng.random() < 0.15, rng.random() < 0.2) for _ in range(rng.randrange(6))]
        assert stacks.best(stacks.run(stacks.start(), turns)) == cheapest_by_all(turns), turns


def test_stacks_share_nodes():
    stacks = repair.Stacks()
    assert len(stacks.tops) == 10 and len(set(stacks.nodes)) == len(stacks.nodes)
    with pytest.raises(ValueError):         # right recursion: the stack grows with the input
        repair.Stacks(repair.Tables((("talk", ()), ("talk", ("u", "a", "talk")))), most=50)


def awkward(seed=3):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", None, ""], ["Yes.", "No", "", None, " \t", "Why?", "a\x1c", "x.\n", "ok!"]
    rows = []
    for conv in [None, *range(25)]:
        if conv != 7:
            rows += [(conv, rng.choice([None, t, t, t, 2 * t]), rng.choice(roles), rng.choice(texts), "x", 1) for t in range(rng.randrange(9))]
    rows += rows[:5] + [(40, t, ["user", "assistant"][t % 2], f"turn {t} ends.", "x", 1) for t in range(60)]
    rng.shuffle(rows)
    return rows


def results(spark, tmp_path, monkeypatch, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return queries.op11_conversation_repair(spark, str(tmp_path))


@pytest.mark.parametrize("piece_bits", [12, 2])
def test_query_equals_sql(spark, tmp_path, monkeypatch, same_as_sql, piece_bits):
    monkeypatch.setattr(repair, "PIECE_BITS", piece_bits)
    rows = awkward()
    same_as_sql(results(spark, tmp_path, monkeypatch, rows), queries.SQL_REPAIR,
                conversations=(rows, ["conv_id", "turn", "role", "text", "audit", "at"]))


def test_empty_table(spark, tmp_path, monkeypatch):
    assert results(spark, tmp_path, monkeypatch, []).count() == 0


def test_repaired_turns_are_legal_and_follow_the_audit(spark):
    rows = spark.createDataFrame(awkward(9), SCHEMA)
    edits, repaired = repair.repair_conversations(rows)
    letters = {r.conv_id: r for r in edits.collect()}
    talks = {}
    for r in sorted(repaired.collect(), key=lambda r: (str(r.conv_id), r.pos)):
        talks.setdefault(r.conv_id, []).append(r)
    for conv, turns in talks.items():
        assert [t.pos for t in turns] == list(range(len(turns)))
        assert is_legal("".join(t.role[:1] for t in turns))
        assert "".join(t.edit for t in turns) == letters[conv].audit.replace("D", "")
    assert all(set(r.audit) <= {"D"} for conv, r in letters.items() if conv not in talks)


def test_damage_follows_the_checksum(spark):
    rows = spark.createDataFrame([(c, t, "system", "Done. Yes!") for c in range(30) for t in range(4)], "conv_id long, turn int, role string, text string")
    hurt = {}
    for r in repair.damage(rows).collect():
        hurt.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    import zlib
    want = {0: [], 1: [("system", "")], 2: [("system", "Done Yes")], 3: [("system", "Done. Yes!")] * 2, 4: [("user", "Done. Yes!")]}
    for c in range(30):
        for t in range(4):
            assert hurt.get((c, t), []) == want.get(zlib.crc32(f"{c}:{t}".encode()) % 20, [("system", "Done. Yes!")])


def test_one_long_conversation_spans_pieces(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", f"t{t}", "same."])) for t in range(3000)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole = repair.edited(repair.with_faults(repair.in_order(table))).collect()
    monkeypatch.setattr(repair, "PIECE_BITS", 5)
    assert repair.edited(repair.with_faults(repair.in_order(table))).collect() == whole
    assert F.lit(1) is not None and whole[0].cost > 0
