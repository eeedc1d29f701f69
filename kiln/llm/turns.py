"""Conversation structure repair: rank-convergence parallel Viterbi over edits of the turns.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Each row is kept (free),
given the user or assistant role (``REROLE``) or deleted (``DELETE``; a blank row or one
whose role and text came earlier must be), and empty user or assistant turns may be
inserted anywhere (``INSERT``); a truncated row that stays costs ``TRUNCATED`` more.
Of the cheapest repairs the one whose edit letters (D, I, K, R in order) are least wins.

*Backward costs.*  The least cost of the rows from a place on is a vector of four states
(start, after system, after user, after assistant).  Rows are range-partitioned by
conversation and turn, so a long conversation is cut into one run a partition.  Each run
goes backward from a speculative vector; fix-up passes then rerun the runs whose next
run begins with another vector than they used, each until its vector differs from the
earlier pass's by a constant only, and end when no run is left.  Letters depend on
differences of costs alone, so a vector known up to a constant is enough.

*Tracing.*  Every run finds the state it leaves for each state it may be entered in; the
entries follow from run to run, and each chunk of a run then picks, in its own task, the
least letter that keeps the cost.  A conversation that lies in one chunk (nearly all) is
solved where it was read, without passes.

Bounds: a chunk holds ``CHUNK_ROWS`` rows and ``CHUNK_BYTES`` of text, a longer text
alone; a run holds one byte a row of one partition; a conversation has one run a
partition at most, and so many passes at most (two or three unless every row is undecided).

Defined cases: rows sort by turn, nulls first, then role, then the MD5 of role and text;
a null conv_id is one conversation; a null role or text is one space; a role counts by its
first letter, an empty one is unknown; equal rows are duplicates of each other; texts of
any length are read whole; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import query, table, written

START, SYSTEM, USER, DONE = range(4)
#: Legal steps: the state after a turn with initial s, u or a.
AFTER = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): DONE, (DONE, 1): USER}
#: The role, and the state after it, that an inserted or re-roled turn has in each state.
GIVEN = ((USER, "user"), (USER, "user"), (DONE, "assistant"), (USER, "user"))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
END = (0, 4, 2, 0)                       # costs behind the last row
LEGAL = {(0, 1), (1, 2), (2, 1)}         # adjacent initials
FORCED, LATE = 4, 8                      # flags of a row's code beside its initial's number
CHUNK_ROWS = 4096
CHUNK_BYTES = 4 << 20
WHITE = " \t\n\x0b\f\r"


def code_of(role: str, text: str) -> int:
    """A row's initial (0 to 2, 3: none of s, u, a), whether it must go and whether it is truncated."""
    kind = "sua".find(role[:1]) if role else 3
    text = text.strip(WHITE)
    return (3 if kind < 0 else kind) | (FORCED if not text else 0 if text[-1] in ".!?" else LATE)


def costs_before(code: int, after: tuple) -> tuple:
    """Least cost from each state ahead of a row, given those behind it."""
    late = TRUNCATED if code & LATE and not code & FORCED else 0
    cost = []
    for state in range(4):
        ways = [DELETE + after[state]]
        if not code & FORCED:
            ways.append(REROLE + late + after[GIVEN[state][0]])
            if (state, code & 3) in AFTER:
                ways.append(late + after[AFTER[state, code & 3]])
        cost.append(min(ways))
    cost[USER], cost[DONE] = min(cost[USER], INSERT + cost[DONE]), min(cost[DONE], INSERT + cost[USER])
    for state in (START, SYSTEM):
        cost[state] = min(cost[state], INSERT + cost[USER])
    return tuple(cost)


class Steps:
    """Steps of the vectors (their least cost taken off) and of the trace; few differ, so each is worked out once a task."""

    def __init__(self):
        self.back, self.forth = {}, {}

    def before(self, code: int, after: tuple) -> tuple:
        key = code, after
        if key not in self.back:
            cost = costs_before(code, after)
            self.back[key] = tuple(c - min(cost) for c in cost)
        return self.back[key]

    def trace(self, code: int, after: tuple, state: int):
        """(letters, states the inserted turns are given in, state after) of a row: the least letters that keep the cost."""
        key = code, after, state
        if key not in self.forth:
            cost, inserted = costs_before(code, after), []
            late = TRUNCATED if code & LATE else 0
            while cost[state] != DELETE + after[state] and cost[state] == INSERT + cost[GIVEN[state][0]]:
                inserted.append(state)
                state = GIVEN[state][0]
            if cost[state] == DELETE + after[state]:
                letter, out = "D", state
            elif not code & FORCED and (state, code & 3) in AFTER and cost[state] == late + after[AFTER[state, code & 3]]:
                letter, out = "K", AFTER[state, code & 3]
            else:
                letter, out = "R", GIVEN[state][0]
            self.forth[key] = letter, inserted, state, out
        return self.forth[key]

    def vectors(self, codes, end: tuple) -> list:
        """The vector behind each row, and ahead of the first as the last of the list."""
        out = [end]
        for code in reversed(codes):
            out.append(self.before(code, out[-1]))
        return out[-2::-1] + [out[-1]]


def chunks_of(kind: pa.DataType, rows: int, size: int):
    """Cut a sorted partition into chunks of one conversation each."""
    schema = pa.schema([("conv_id", kind), ("part", pa.int32()), ("seq", pa.int32()), ("edge", pa.bool_()), ("cut", pa.bool_()),
                        ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                        ("keys", pa.list_(pa.string())), ("codes", pa.binary())])

    def chunks(batches):
        from pyspark import TaskContext

        part, seq, n_bytes = TaskContext.get().partitionId(), 0, 0
        held, conv, first, cut = [], None, True, False

        def chunk(last):
            nonlocal seq, n_bytes, held
            turns, roles, texts, keys = map(list, zip(*held))
            row = (conv, part, seq, first or last, cut, turns, roles, texts, keys, bytes(code_of(r, t) for r, t in zip(roles, texts)))
            seq, n_bytes, held = seq + 1, 0, []
            return pa.RecordBatch.from_pydict({f.name: pa.array([v], f.type) for f, v in zip(schema, row)}, schema)

        for batch in batches:
            for new, turn, role, text, key in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and new != conv:
                    yield chunk(False)
                    first, cut = False, False
                elif held and (len(held) >= rows or n_bytes >= size):
                    cut = True
                    yield chunk(False)
                conv = new
                held.append((turn, role, text, key))
                n_bytes += len(text)
        if held:
            yield chunk(True)
    return chunks, schema


def backward(batches):
    """Run backward over each run from the vector it wants, until it meets its earlier vectors."""
    steps = Steps()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            want, old = tuple(row["want"]), row["ends"]
            if row["used"] is None or tuple(row["used"]) != want:
                ends, vector = [], want
                for i in range(len(row["chunks"]) - 1, -1, -1):
                    if old and tuple(old[i]) == vector:      # from here on as before
                        ends += [tuple(e) for e in reversed(old[:i + 1])]
                        vector = tuple(row["ahead"])
                        break
                    ends.append(vector)
                    for code in reversed(flagged(row["chunks"][i])):
                        vector = steps.before(code, vector)
                row["ends"], row["ahead"], row["used"] = ends[::-1], vector, want
            out.append(row)
        yield pa.RecordBatch.from_pylist([{k: r[k] for k in batch.schema.names if k != "want"} for r in out],
                                         pa.schema([f for f in batch.schema if f.name != "want"]))


def flagged(chunk) -> bytearray:
    codes = bytearray(chunk["codes"])
    for i in chunk["repeats"] or ():
        codes[i] |= FORCED
    return codes


def leaving(batches):
    """The state in which a run is left, for each state it may be entered in."""
    steps = Steps()
    for batch in batches:
        rows = batch.select(["conv_id", "part", "chunks", "ends"]).to_pylist()
        for row in rows:
            states = list(range(4))
            for chunk, end in zip(row["chunks"], row["ends"]):
                codes = flagged(chunk)
                for code, after in zip(codes, steps.vectors(codes, tuple(end))):
                    states = [steps.trace(code, after, s)[3] for s in states]
            row["leaves"] = states
        yield pa.RecordBatch.from_pydict({"conv_id": pa.array([r["conv_id"] for r in rows], batch.schema.field("conv_id").type),
                                          "part": pa.array([r["part"] for r in rows], pa.int32()),
                                          "leaves": pa.array([r["leaves"] for r in rows], pa.list_(pa.int32()))})


def entered(batches):
    """The state in which each chunk of a run is entered."""
    steps = Steps()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            state = row["enter"]
            for i, (chunk, end) in enumerate(zip(row["chunks"], row["ends"])):
                out.append((row["part"], chunk["seq"], state, end, row["last"] and i == len(row["chunks"]) - 1, chunk["repeats"] or []))
                codes = flagged(chunk)
                for code, after in zip(codes, steps.vectors(codes, tuple(end))):
                    state = steps.trace(code, after, state)[3]
        types = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.bool_(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)],
                                         names=["part", "seq", "enter", "end", "last", "repeats"])


COUNTS = "n_rows bigint, n_turns bigint, low_turn bigint, high_turn bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
PIECE = f"part int, seq int, {COUNTS}, first_kind int, last_kind int, audit string, turns array<struct<edit:string,role:string,text:string>>"
EDIT = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def repaired(kind: pa.DataType):
    """Trace each chunk between its entering state and the vector behind it."""
    def trace(batches):
        steps = Steps()
        for batch in batches:
            out = [piece(steps, row) for row in batch.to_pylist()]
            types = [kind, pa.int32(), pa.int32()] + [pa.int64()] * 9 + [pa.int32(), pa.int32(), pa.string(), EDIT]
            names = ["conv_id"] + [f.split(" ")[0] for f in PIECE.split("array")[0].split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 16, types)], names=names)

    def piece(steps, row):
        codes, keys = bytearray(row["codes"]), row["keys"]
        n_blank = sum(bool(c & FORCED) for c in codes)
        if row["repeats"] is None:           # a whole conversation
            seen = set()
            repeats = [i for i, k in enumerate(keys) if k in seen or seen.add(k)]
        else:
            repeats = row["repeats"]
        repeats = [i for i in repeats if not codes[i] & FORCED]
        for i in repeats:
            codes[i] |= FORCED
        kinds = [c & 3 for c in codes]
        truncated = sum(c & FORCED == 0 and c & LATE != 0 for c in codes)
        illegal = sum((a, b) not in LEGAL for a, b in zip(kinds, kinds[1:]))
        numbers = [t for t in row["turns"] if t is not None]
        state, cost, audit, turns = row["enter"], 0, [], []
        for code, after, role, text in zip(codes, steps.vectors(codes, tuple(row["end"])), row["roles"], row["texts"]):
            letter, inserted, at, state = steps.trace(code, after, state)
            for s in inserted:
                turns.append(("I", GIVEN[s][1], ""))
            cost += INSERT * len(inserted) + {"D": DELETE, "K": 0, "R": REROLE}[letter] + (TRUNCATED if code & LATE and letter != "D" else 0)
            audit.append("I" * len(inserted) + letter)
            turns.append(("D", role, None) if letter == "D" else (letter, GIVEN[at][1] if letter == "R" else role, text))
        while row["last"] and state not in (START, DONE):
            turns.append(("I", GIVEN[state][1], ""))
            audit.append("I")
            cost, state = cost + INSERT, GIVEN[state][0]
        return (row["conv_id"], row["part"], row["seq"], len(codes), len(set(numbers)), min(numbers, default=None), max(numbers, default=None),
                n_blank, len(repeats), truncated, illegal, cost, kinds[0], kinds[-1], "".join(audit), [dict(zip(("edit", "role", "text"), t)) for t in turns])
    return trace


def literal(vector) -> Column:
    return F.array(*(F.lit(v) for v in vector))


def repair_conversations(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of a conversation, ordered by part and seq: conv_id, whole (it is all of the conversation), counts of
    its rows' faults, cost, audit (edit letters) and turns (edit, role, text of every turn; a deleted one's text is null)."""
    from pyspark.sql.pandas.types import to_arrow_type

    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
                       F.md5(F.concat_ws("\0", role, text)).alias("key"))
    order = ["conv_id", "turn", "role", "key"]
    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    name = rows.schema["conv_id"].dataType.simpleString()
    cut, _ = chunks_of(kind, chunk_rows, chunk_bytes)
    # the last range column spreads equal rows, which are alike wherever they lie
    chunks = written(rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
                     .mapInArrow(cut, f"conv_id {name}, part int, seq int, edge boolean, cut boolean, turns array<bigint>, roles array<string>, "
                                      "texts array<string>, keys array<string>, codes binary"), "chunks")
    # conversations over several partitions: two rows a partition at most
    shared = written(chunks.filter("edge").groupBy("conv_id").agg(F.count_distinct("part").alias("n")).filter("n > 1").select(F.col("conv_id").alias("c")), "shared")
    marked = chunks.join(F.broadcast(shared.withColumn("in", F.lit(True))), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    long = F.col("cut") | (F.col("edge") & F.col("in").isNotNull())
    ints = "array<int>"
    whole = marked.filter(~long).select("conv_id", "part", "seq", "turns", "roles", "texts", "keys", "codes", F.lit(START).alias("enter"),
                                        literal(END).alias("end"), F.lit(True).alias("last"), F.lit(None).cast(ints).alias("repeats"))
    pieces = whole.mapInArrow(repaired(kind), f"conv_id {name}, {PIECE}").withColumn("whole", F.lit(True))
    cut_up = marked.filter(long)
    if cut_up.select("part").isEmpty():
        return pieces
    stitched = stitch(cut_up.select("conv_id", "part", "seq", "keys", "codes"))
    longer = cut_up.select("conv_id", "part", "seq", "turns", "roles", "texts", "keys", "codes").join(stitched, ["part", "seq"])
    longer = longer.select("conv_id", "part", "seq", "turns", "roles", "texts", "keys", "codes", "enter", "end", "last", "repeats")
    return pieces.unionByName(longer.mapInArrow(repaired(kind), f"conv_id {name}, {PIECE}").withColumn("whole", F.lit(False)))


def stitch(chunks: DataFrame) -> DataFrame:
    """For each chunk of the conversations that several chunks hold: the state it is entered in, the vector behind it,
    whether it ends the conversation, and its rows that repeat an earlier one."""
    at = F.struct("part", "seq", "i")
    keys = chunks.select("conv_id", "part", "seq", F.posexplode("keys").alias("i", "key"))
    firsts = keys.groupBy("conv_id", "key").agg(F.min(at).alias("least"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "least")
    repeats = (keys.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))).filter(at != F.col("least"))
               .groupBy("part", "seq").agg(F.sort_array(F.collect_list("i")).alias("repeats")))
    coded = chunks.select("conv_id", "part", "seq", "codes").join(repeats, ["part", "seq"], "left")
    runs = coded.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("seq", "codes", F.coalesce("repeats", F.array().cast("array<int>")).alias("repeats")))).alias("chunks"))
    runs = runs.select("*", F.lit(None).cast("array<array<int>>").alias("ends"), F.lit(None).cast("array<int>").alias("ahead"), F.lit(None).cast("array<int>").alias("used"))
    schema = runs.schema
    runs = written(runs.withColumn("want", literal(END)).mapInArrow(backward, schema), "runs")
    along = Window.partitionBy("conv_id").orderBy("part")
    while True:
        wanting = runs.withColumn("want", F.coalesce(F.lead("ahead").over(along), literal(END)))
        if wanting.filter(F.col("want") != F.col("used")).isEmpty():
            break
        runs = written(wanting.mapInArrow(backward, schema), "runs")
    name = schema["conv_id"].dataType.simpleString()
    leaves = runs.mapInArrow(leaving, f"conv_id {name}, part int, leaves array<int>")
    enter = F.aggregate(F.collect_list("leaves").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(START), lambda s, run: F.get(run, s))
    entries = leaves.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), enter.alias("enter"), F.lead("part").over(along).isNull().alias("last"))
    joined = runs.join(entries, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return written(joined.select("part", "chunks", "ends", "enter", "last")
                   .mapInArrow(entered, "part int, seq int, enter int, end array<int>, last boolean, repeats array<int>"), "entries")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: rows dropped, emptied, without stops, repeated or given the user role, by a hash of their key."""
    space = F.lit(" ")
    fate = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    text = F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fate == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space))
    copies = F.when(fate == 3, 2).otherwise(1)
    return (rows.filter(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"))
            .drop("copy"))


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def reports(kind: pa.DataType):
    """One row per conversation from its pieces in order; the digest is fed piece by piece."""
    import hashlib

    class Report:
        def __init__(self, conv):
            self.conv, self.digest, self.audit, self.sums = conv, hashlib.sha256(), [], [0] * 5
            self.low = self.high = self.kind = None
            self.turns, self.any = 0, False

        def add(self, row):
            if row["low_turn"] is not None:          # turns ascend, so only the border's may be equal
                self.turns += row["n_turns"] - (self.high == row["low_turn"])
                self.low, self.high = row["low_turn"] if self.low is None else self.low, row["high_turn"]
            if self.kind is not None and (self.kind, row["first_kind"]) not in LEGAL:
                self.sums[3] += 1
            self.kind = row["last_kind"]
            self.sums = [a + row[c] for a, c in zip(self.sums, ("blank", "duplicate", "truncated", "illegal", "cost"))]
            self.audit.append(row["audit"])
            for turn in row["turns"]:
                if turn["edit"] != "D":
                    self.digest.update(f"{chr(10) if self.any else ''}{turn['role']}:{turn['text']}".encode())
                    self.any = True

        def row(self):
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
            return (self.conv, gaps, *self.sums, "".join(self.audit), self.digest.hexdigest())

    def report(batches):
        types = [kind] + [pa.int64()] * 6 + [pa.string()] * 2
        names = ["conv_id"] + [f.split(" ")[0] for f in REPORT.split(", ")]
        held = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held is None or row["conv_id"] != held.conv:
                    done += [held.row()] if held else []
                    held = Report(row["conv_id"])
                held.add(row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(held.row(), types)], names=names)
    return report


def conversation_reports(pieces: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, cost, audit and the SHA-256 of the repaired turns, from the pieces of repair_conversations."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = pieces.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, {REPORT}"
    run = reports(to_arrow_type(kind))
    several = pieces.filter(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return pieces.filter("whole").mapInArrow(run, schema).unionByName(several.mapInArrow(run, schema))


@query("op11_conversation_repair")
def op11(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    got = conversation_reports(repair_conversations(damaged(rows))).withColumnRenamed("conv_id", "c")
    every = rows.select("conv_id").distinct().join(got, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.fillna(0, numbers).fillna({"audit": "", "repaired_sha256": "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"})
