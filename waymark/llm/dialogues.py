"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

A conversation is legal if its role initials read (s?(ua)+)?; four states say what came last (nothing, s, u, a). A turn is
kept, reroled or deleted, turns are inserted between; in each state every edit leads to one next state, so the edits'
initials (the audit) determine the repair. Hirschberg's divide and conquer finds it in linear space: a forward vector of
four costs from the left and a backward vector from the right meet in the middle, the cheapest crossing state splits the
conversation, and both halves are solved alike. Of crossings that cost the same, the one with the ASCII-least audit is
taken. For that the forward vector carries the rank of each state's least audit: two audits up to one place have equally
many non-insert letters and end on one, so neither is a prefix of the other, and the first half alone decides.

At scale the same recursion works on runs: turns are sorted by range over all conversations, so that a conversation of any
length spreads over tasks; a run of at most RUN turns is summed up as a table of cost and rank from each state to each state.
The crossings between runs are found on these tables, then each run is solved by itself between its two states.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from waymark.llm.store import saved

#: Turns that one summary covers at most.
RUN = 16_384
NOTHING, S, U, A = range(4)
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_BLANKS = " \t\n\x0b\x0c\r"
_KEEP = {(NOTHING, "s"): S, (NOTHING, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: Where an inserted or reroled turn leads: it has the one role among user and assistant that may follow.
_PUT = {NOTHING: U, S: U, U: A, A: U}
ROLES = {U: "user", A: "assistant"}
#: Cost and letters from a state to the legal end of a conversation.
TAIL = {NOTHING: (0, ""), A: (0, ""), U: (2, "I"), S: (4, "II")}


def _steps(initial: str, fault: int) -> dict[int, dict[int, tuple[int, str]]]:
    """From each state, the cheapest way over one turn to each state: (cost, letters), the least letters on ties; inserts come first."""
    found: dict[int, dict[int, tuple[int, str]]] = {}
    for start in range(4):
        state, ways = start, {}
        for inserts in range(3):
            own = [(state, 3, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = 1 if fault == TRUNCATED else 0
                own.append((_PUT[state], 2 + extra, "R"))
                if (state, initial) in _KEEP:
                    own.append((_KEEP[state, initial], extra, "K"))
            for end, cost, letter in own:
                way = (cost + 2 * inserts, "I" * inserts + letter)
                ways[end] = min(way, ways.get(end, way))
            state = _PUT[state]
        found[start] = ways
    return found


_KINDS = [(i, f) for i in ("s", "u", "a", "") for f in (0, BLANK, DUPLICATE, TRUNCATED)]
STEPS = [_steps(i, f) for i, f in _KINDS]


def kind_of(initial: str, fault: int) -> int:
    return ("sua".find(initial) if initial in ("s", "u", "a") else 3) * 4 + fault


def forward(steps: list, start: int) -> dict[int, tuple[int, int]]:
    """State -> (cost, rank of its least letters among the states) after all steps."""
    best = {start: (0, 0)}
    for step in steps:
        ways: dict = {}
        for s, (cost, rank) in best.items():
            for t, (own, order) in step[s].items():
                way = (cost + own, rank, order)
                if t not in ways or way < ways[t]:
                    ways[t] = way
        best = {t: (ways[t][0], i) for i, t in enumerate(sorted(ways, key=lambda t: ways[t][1:]))}
    return best


def backward(steps: list, ends: dict[int, int]) -> dict[int, int]:
    """State -> least cost from before all steps to one of the ends."""
    for step in reversed(steps):
        ends = {s: min(own + ends[t] for t, (own, _) in ways.items() if t in ends) for s, ways in step.items() if any(t in ends for t in ways)}
    return ends


def crossings(steps: list, start: int, end: int) -> list[int]:
    """The states after each step on the cheapest, audit-least way from start to end."""
    if len(steps) < 2:
        return [end] * len(steps)
    mid = len(steps) // 2
    left, right = forward(steps[:mid], start), backward(steps[mid:], {end: 0})
    state = min((s for s in left if s in right), key=lambda s: (left[s][0] + right[s], left[s][1]))
    return crossings(steps[:mid], start, state) + crossings(steps[mid:], state, end)


def last_state(steps: list) -> tuple[int, int]:
    """(state after the last step, whole cost) of the cheapest, audit-least repair."""
    ends = forward(steps, NOTHING)
    end = min(ends, key=lambda s: (ends[s][0] + TAIL[s][0], ends[s][1]))
    return end, ends[end][0] + TAIL[end][0]


def repaired(kinds: list[int]) -> tuple[int, list[str], str]:
    """Cost, letters of each turn and letters at the end, of one conversation held in memory."""
    steps = [STEPS[k] for k in kinds]
    end, cost = last_state(steps)
    return cost, letters(steps, NOTHING, end), TAIL[end][1]


def letters(steps: list, start: int, end: int) -> list[str]:
    states = [start, *crossings(steps, start, end)]
    return [step[a][b][1] for step, a, b in zip(steps, states, states[1:])]


# --- Spark side -------------------------------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): null role and text as one space, damaged by crc32("conv_id:turn") % 20; copies is 0 for dropped rows."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate(F.col("_t"), ".!?", "")).otherwise(F.col("_t"))
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), said("role").alias("_r"), said("text").alias("_t"), draw.alias("_d"))
    return rows.select("conv_id", "turn", F.when(F.col("_d") == 4, "user").otherwise(F.col("_r")).alias("role"), text.alias("text"),
                       F.when(F.col("_d") == 0, 0).when(F.col("_d") == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _slots(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text, with its number of copies and its own fault; no texts.

    Dropped rows meet in one slot without copies, so their conversation stays. A slot is a duplicate if an earlier turn has
    its role and text. The first turn of each role and text is found by aggregation and meets its slot on the whole key, so
    a text that a third of all turns repeat is not gathered anywhere.
    """
    gone, nothing = F.col("copies") == 0, F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = F.when(nothing == "", BLANK).when(~F.substring(nothing, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    keyed = rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(~gone, F.col("role")).alias("role"),
                        F.when(~gone, _digest(F.col("text"))).alias("digest"), F.when(~gone, fault).alias("own"), "copies")
    slots = keyed.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.max("own").alias("own"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = keyed.filter("digest is not null").groupBy("conv_id", "role", "digest").agg(F.min(order).alias("least"))
    firsts = firsts.select(F.col("conv_id").alias("_c"), F.col("least.turn").alias("_t"), F.col("role").alias("_r"), F.col("digest").alias("_g"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_g"))
    joined = slots.join(firsts, same, "left")
    repeat = F.col("digest").isNotNull() & F.col("_g").isNull() & (F.col("own") != BLANK)
    return joined.select("conv_id", "turn", "role", "digest", "copies", F.when(repeat, DUPLICATE).otherwise(F.col("own")).alias("fault"))


_RUN = ("run bigint, conv_id bigint, turn bigint, role string, digest binary, kinds binary, copies array<bigint>, ways binary, blank bigint, duplicate bigint, truncated bigint, "
        "extra bigint, illegal bigint, first string, last string, turns bigint, least bigint, most bigint")


def _ordered(*more: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", *more)]


def _rows(batches):
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns])


def _ways(steps: list) -> bytes:
    """Cost and rank from each state to each state, as 32 numbers of 8 bytes; cost -1 where there is no way."""
    out = []
    for s in range(4):
        best = forward(steps, s)
        out += [x for t in range(4) for x in best.get(t, (-1, -1))]
    return b"".join(x.to_bytes(8, "little", signed=True) for x in out)


def _read_ways(raw: bytes) -> dict:
    x = [int.from_bytes(raw[k:k + 8], "little", signed=True) for k in range(0, len(raw), 8)]
    return {s: {t: (x[8 * s + 2 * t], x[8 * s + 2 * t + 1]) for t in range(4) if x[8 * s + 2 * t] >= 0} for s in range(4)}


def _summaries(batches):
    """Sorted slots -> one row per run: kinds and copies of its turns, its table of ways and its counts."""
    base, number, run, out = TaskContext.get().partitionId() << 40, 0, None, []

    def closed():
        return (base + number, *run["key"], bytes(run["kinds"]), run["copies"], _ways([STEPS[k] for k in run["kinds"]]), *run["faults"],
                *(run[k] for k in ("extra", "illegal", "first", "last", "turns", "least", "most")))

    def batch(rows):
        schema = pa.schema([("run", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("kinds", pa.binary()), ("copies", pa.list_(pa.int64())),
                            ("ways", pa.binary()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "extra", "illegal")], ("first", pa.string()), ("last", pa.string()),
                            *[(n, pa.int64()) for n in ("turns", "least", "most")]])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for conv, turn, role, digest, copies, fault in _rows(batches):
        if run is None or run["conv"] != conv or len(run["kinds"]) >= RUN:
            if run is not None:
                out.append(closed())
                number += 1
                if len(out) >= 256:
                    yield batch(out)
                    out = []
            run = {"conv": conv, "key": (conv, turn, role, digest), "kinds": bytearray(), "copies": [], "faults": [0, 0, 0], "extra": 0, "illegal": 0, "first": None, "last": None,
                   "turns": 0, "least": None, "most": None}
        if not copies:  # dropped rows only
            continue
        initial = role[:1]
        run["kinds"].append(kind_of(initial, fault))
        run["copies"].append(copies)
        if fault:
            run["faults"][fault - 1] += 1
        run["faults"][0 if fault == BLANK else 1] += copies - 1
        run["extra"] += 3 * (copies - 1)
        run["illegal"] += copies - 1 + (run["last"] is not None and run["last"] + initial not in ("su", "ua", "au"))
        run["first"], run["last"] = initial if run["first"] is None else run["first"], initial
        if turn is not None:
            run["turns"] += turn != run["most"]
            run["least"], run["most"] = turn if run["least"] is None else run["least"], turn
    if run is not None:
        out.append(closed())
    if out:
        yield batch(out)


_SOLVED = "run bigint, begin int, end int, tail string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


def _solve_runs(batches):
    """Runs of whole conversations in order -> the states at their ends; the counts of a conversation stand on its first run."""
    def solved(runs):
        steps = [_read_ways(r["ways"]) for r in runs]
        end, cost = last_state(steps)
        states = [NOTHING, *crossings(steps, NOTHING, end)]
        sums = {k: sum(r[k] for r in runs) for k in ("blank", "duplicate", "truncated", "illegal", "extra", "turns")}
        last, most = None, None
        for r in runs:
            if last is not None and r["first"] is not None:
                sums["illegal"] += last + r["first"] not in ("su", "ua", "au")
            if most is not None and r["least"] == most:
                sums["turns"] -= 1
            last, most = r["last"] if r["last"] is not None else last, r["most"] if r["most"] is not None else most
        least = next((r["least"] for r in runs if r["least"] is not None), None)
        gaps = 0 if least is None else most - least + 1 - sums["turns"]
        for k, r in enumerate(runs):
            totals = [gaps, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], cost + sums["extra"]] if k == 0 else [None] * 6
            yield (r["run"], states[k], states[k + 1], TAIL[end][1] if k == len(runs) - 1 else "", *totals)

    schema = pa.schema([("run", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("tail", pa.string()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]])
    held, of, out = [], None, []
    for b in batches:
        for r in b.to_pylist():
            if held and r["conv_id"] != of:
                out.extend(solved(held))
                held = []
            of = r["conv_id"]
            held.append(r)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*solved(held)), schema)], schema=schema)


def _edit_runs(batches):
    """Runs with their end states -> the letters of every turn."""
    schema = pa.schema([("run", pa.int64()), ("letters", pa.list_(pa.string()))])
    for b in batches:
        run, kinds, begin, end = (c.to_pylist() for c in b.columns)
        made = [letters([STEPS[k] for k in ks], s, t) for ks, s, t in zip(kinds, begin, end)]
        yield pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), pa.array(made, pa.list_(pa.string()))], schema=schema)


_OUT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")


def _assemble(batches):
    """Edits and texts of whole conversations in order -> one row each; of a conversation only its audit and a hash state are held."""
    schema = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    now, out = None, []

    def put(role, text=""):
        now["sha"].update(f"{chr(10) if now['some'] else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        now["some"] = True

    def inserts(n):
        for _ in range(n):
            now["state"] = _PUT[now["state"]]
            put(ROLES[now["state"]])

    def closed():
        inserts(len(now["tail"]))
        return (now["conv"], *now["totals"], "".join(now["audit"]) + now["tail"], now["sha"].hexdigest())

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for conv, turn, role, digest, text, edits, copies, tail, totals in _rows(batches):
        if edits is not None:
            if now is None or now["conv"] != conv:
                if now is not None:
                    out.append(closed())
                    if len(out) >= 1024:
                        yield batch()
                        out = []
                now = {"conv": conv, "totals": totals, "audit": [], "sha": hashlib.sha256(), "state": NOTHING, "some": False, "tail": "", "slot": None}
            now["edits"], now["at"] = edits, 0
            now["tail"] = tail
            now["audit"].extend(e + "D" * (n - 1) for e, n in zip(edits, copies))
            continue
        if (turn, role, digest) == now["slot"]:
            continue
        now["slot"] = (turn, role, digest)
        own = now["edits"][now["at"]]
        now["at"] += 1
        inserts(len(own) - 1)
        if own[-1] == "K":
            now["state"] = _KEEP[now["state"], role[:1]]
            put(role, text)
        elif own[-1] == "R":
            now["state"] = _PUT[now["state"]]
            put(ROLES[now["state"]], text)
    if now is not None:
        out.append(closed())
    if out:
        yield batch()


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of a damaged() table: counts of its faults, the cost, the audit and a digest of the repair.

    Turns of a conversation stand by turn (nulls first), those of one turn by role and then by the MD5 of their text; equal
    rows are copies, of which all but the first are duplicates. Null conversation ids are one conversation. A conversation
    without rows has zeros, an empty audit and the digest of nothing. Roles other than s..., u..., a... are never kept. An
    empty table gives no rows. Texts are shuffled once; one task reads a conversation's texts in order for the digest,
    which is one SHA-256, and holds only its audit.
    """
    runs = saved(_slots(rows).repartitionByRange(*_ordered()).sortWithinPartitions(*_ordered()).mapInArrow(_summaries, _RUN))
    # AQE must not spread the runs of one conversation over several tasks: a plain hash partitioning keeps them together
    table = runs.select("conv_id", "run", "ways", "blank", "duplicate", "truncated", "illegal", "extra", "first", "last", "turns", "least", "most")
    solved = saved(table.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "run").mapInArrow(_solve_runs, _SOLVED))
    edits = runs.select("run", "kinds").join(solved.select("run", "begin", "end"), "run").mapInArrow(_edit_runs, "run bigint, letters array<string>")
    heads = runs.select("run", "conv_id", "turn", "role", "digest", "copies").join(solved, "run").join(edits, "run")
    totals = F.array("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    heads = heads.select("conv_id", "turn", "role", "digest", F.lit(None).cast("string").alias("text"), F.col("letters").alias("edits"), "copies", "tail", totals.alias("totals"), F.col("run").alias("_tag"))
    texts = rows.filter("copies > 0").select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), "text", F.lit(None).cast("array<string>").alias("edits"),
                                             F.lit(None).cast("array<bigint>").alias("copies"), F.lit(None).cast("string").alias("tail"), F.lit(None).cast("array<bigint>").alias("totals"),
                                             F.lit((1 << 63) - 1).alias("_tag"))
    stream = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*_ordered("_tag"))
    return stream.drop("_tag").mapInArrow(_assemble, _OUT)
