"""Conversation repair: against all edits of small conversations, pieces against wholes, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm import queries, repair

ROWS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])
SPACE = "[\x20\x09-\x0d]*"


def all_audits(symbols, most):
    """Every sequence of edits with at most ``most`` insertions, its cost and the initials it gives, by plain enumeration."""
    out = {}
    for edits in itertools.product("KRD", repeat=len(symbols)):
        if any(s == "x" and e != "D" for s, e in zip(symbols, edits)):
            continue
        for places in itertools.chain(*[itertools.combinations_with_replacement(range(len(symbols) + 1), m) for m in range(most + 1)]):
            audit = "".join("I" * places.count(i) + e for i, e in enumerate([*edits, ""]))
            # Unknown roles of changed and inserted rows: both are tried.
            kept = [s.lower() if e == "K" else "?" for s, e in zip(symbols, edits) if e != "D"]
            spots, at = [], iter(kept)
            for e in audit:
                if e == "I":
                    spots.append("?")
                elif e != "D":
                    spots.append(next(at))
            for fill in itertools.product("ua", repeat=spots.count("?")):
                new = iter(fill)
                roles = "".join(next(new) if x == "?" else x for x in spots)
                if re.fullmatch("(s?(ua)+)?", roles):
                    cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit) + 3 * sum(s.isupper() and e != "D" for s, e in zip(symbols, edits))
                    out[audit] = cost
    return out


def test_cheapest_equals_all_edits():
    rng = random.Random(3)
    patterns = ["", "s", "u", "a", "x", "o", "su", "au", "SUA"] + ["".join(rng.choice("suaoxSUAO") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    for symbols in patterns:
        ways = all_audits(symbols, 3)
        assert repair.cheapest(symbols) == min((cost, audit) for audit, cost in ways.items()), symbols


def test_pieces_give_the_same_as_the_whole():
    rng = random.Random(5)
    for _ in range(50):
        symbols = "".join(rng.choice("suauaoxSUA") for _ in range(rng.randint(2, 40)))
        cut = rng.randint(1, len(symbols) - 1)
        audits, states = repair.Audits(), {0: (0, 0)}
        for part in (symbols[:cut], symbols[cut:]):
            costs, labels = repair.matrix(part)
            after = {}
            for a, (cost, node) in states.items():
                for b in range(4):
                    if costs[4 * a + b] >= 0:
                        way = (cost + costs[4 * a + b], audits.push(node, labels[4 * a + b]))
                        if b not in after or way[0] < after[b][0] or way[0] == after[b][0] and audits.less(way[1], after[b][1]):
                            after[b] = way
            states = after
        cost, node = repair.finish(audits, states)
        assert (cost, "".join(audits.items(node))) == repair.cheapest(symbols)


def test_order_of_audits_with_equal_hashes(monkeypatch):
    """With a hash that is the same for all strings, links decide."""
    rng = random.Random(8)
    words = ["".join(rng.choice("DIKR") for _ in range(rng.randint(0, 12))) for _ in range(40)]
    for prime in (repair._PRIME, 1, 3):
        monkeypatch.setattr(repair, "_PRIME", prime)
        audits = repair.Audits()
        nodes = [audits.extended(0, w) for w in words]
        for a, b in itertools.product(range(len(words)), repeat=2):
            assert audits.less(nodes[a], nodes[b]) == (words[a] < words[b])


def plain(rows, hurt=True):
    """The contract, row by row; the edits come from ``all_audits`` where that is short enough, else from ``cheapest``."""
    by_key = {}
    for key, turn, role, text in rows:
        found = by_key.setdefault(key, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for key, found in by_key.items():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
        seen, symbols, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in found:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            own = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else own.upper() if fault else own
        cost, audit = repair.cheapest(symbols)
        if len(symbols) <= 3:
            assert (cost, audit) == min((c, a) for a, c in all_audits(symbols, 3).items())
        lines, at, last = [], iter(found), ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(at)[1:]
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        out[key] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in names) for r in rows}


def test_query_equals_plain(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op11_conversations"](spark, folder)) == plain(rows)


@pytest.mark.parametrize("piece", [3, 1024])
def test_odd_rows_and_a_hot_conversation(spark, piece):
    rng = random.Random(11)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User", " "], ["Yes.", "No", "", None, " \n ", "What? ", "It is so! ", "x" * 300_000 + ".", "é.", "."]
    rows = [(rng.randint(0, 6), rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts[:7])) for _ in range(60)]
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "assistant", texts[7]), (-5, None, "user", texts[8])]
    rows += [(77, i, rng.choice(roles[:3]), rng.choice(["Same.", f"No. {i}.", f"no. {i}"])) for i in range(400)]
    rows += [(78, 4, "user", "Again and again.")] * 50
    df = spark.createDataFrame(rows, ROWS).withColumn("k", F.lit(1)).withColumn("n", F.lit(2)).withColumn("audit", F.lit("x"))
    want = plain(rows, hurt=False)
    assert got(repair.repair(df, piece=piece)) == want
    names = {"conv_id": "K", "turn": "N", "role": "t", "text": "r"}
    renamed = repair.repair(df.select([F.col(a).alias(b) for a, b in names.items()]), "K", "N", "t", "r").withColumnRenamed("K", "conv_id")
    assert got(renamed) == want
    assert got(repair.repair(repair.damaged(df))) == {k: v for k, v in plain(rows).items() if v[-2] or v[:-2] != (0,) * 6 or k in {r[0] for r in repair.damaged(df).collect()}}


def test_all_rows_dropped_and_empty_table(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi."), (None, None, "user", "Hi.")], ROWS)
    df.write.parquet(f"{tmp_path}/one/conversations.parquet")
    found = got(queries.QUERIES["op11_conversations"](spark, f"{tmp_path}/one"))
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and len(found) == 2
    df.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert got(queries.QUERIES["op11_conversations"](spark, f"{tmp_path}/none")) == {}
