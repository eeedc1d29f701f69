"""Conversation repair against all edit sequences, and long conversations cut into many runs."""

import hashlib
import heapq
import random
import zlib

import pytest

from kiln.llm import turns

WHITE = " \t\n\x0b\f\r"


def plain_repair(rows):
    """Cheapest edits by a uniform-cost search over (row, state), least letters first: (cost, audit, repaired)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    given = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    heap, seen = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if seen.setdefault((i, state), (cost, audit)) < (cost, audit):
            continue
        if i == len(rows) and state in ("", "a"):
            return cost, audit, out
        role = given[state]
        if len(out) < 3 * len(rows) + 3:
            heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*out, (role, ""))))
        if i == len(rows):
            continue
        name, text, forced, late = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
        if not forced:
            if (state, name[:1]) in after:
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, after[state, name[:1]], (*out, (name, text))))
            heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, role[0], (*out, (role, text))))


def plain_report(rows):
    """(turn, role, text) rows of a conversation -> its report."""
    rows = sorted(((t, r or (" " if r is None else ""), x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).hexdigest()))
    seen, blank, duplicate, truncated, faulty = set(), 0, 0, 0, []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        late = bool(bare) and bare[-1] not in ".!?"
        copy = (role, text) in seen
        seen.add((role, text))
        blank, duplicate, truncated = blank + (not bare), duplicate + (bool(bare) and copy), truncated + (late and not copy)
        faulty.append((role, text, not bare or copy, int(late)))
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit, out = plain_repair(faulty)
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate:
            text = "" if fate == 1 else text.translate(str.maketrans("", "", ".!?")) if fate == 2 else text
            out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain(rows, damage=False):
    talks = {conv: [] for conv, *_ in rows}
    for conv, *row in plain_damage(rows) if damage else rows:
        talks[conv].append(row)
    return {conv: plain_report(t) for conv, t in talks.items()}


def make_talks():
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usr"]
    texts = ["Yes.", "No", "", "  \n", None, "What? ", "A long answer.\x0b", "cut off, ", "é…!", "x" * 3000 + "."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{conv} {turn}."))
    rows += [(61, 0, "user", "Twice.")] * 5 + [(62, None, "assistant", "Only.")]
    rows += [(70, t, ("user", "assistant")[t % 2], f"Turn {t}{'.' if t % 7 else ''}") for t in range(150)]      # long and legal
    rows += [(71, t, "tool", f"Call {t}.") for t in range(91)]                                                   # costs never settle
    rows += [(72, t % 5, rng.choice(roles), rng.choice(texts)) for t in range(120)]                              # many repeats and ties
    return rows


def collected(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in df.collect()}


@pytest.fixture
def many_partitions(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("chunk", [(4096, 1 << 22), (3, 1 << 22), (5, 40)])
def test_repair(spark, many_partitions, chunk):
    rows = make_talks()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'clash' AS part", "1 AS key", "2 AS audit")
    pieces = turns.repair_conversations(df, *chunk)
    assert collected(turns.conversation_reports(pieces)) == plain(rows)
    assert pieces.filter("not whole").count() > (5 if chunk[0] > 10 else 50)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Cut"), (1, 3, "user", " ")]
    got = turns.repair_conversations(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")).first()
    assert (got["audit"], got["cost"], got["whole"]) == (plain(rows)[1][6], plain(rows)[1][5], True)
    kept = [(t["role"], t["text"]) for t in got["turns"] if t["edit"] != "D"]
    assert [r[0] for r in kept] in (["s", "u", "a"], ["system", "user", "assistant"])


def test_query_damages_and_reports_every_conversation(spark, tmp_path):
    rows = make_talks() + [(conv, 0, "user", "Gone?") for conv in range(100, 160)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = collected(turns.op11(spark, str(tmp_path))), plain(rows, damage=True)
    assert got == want and any(w[6] == "" for w in want.values())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert turns.op11(spark, str(tmp_path)).collect() == []
