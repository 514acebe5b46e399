"""Repair of damaged conversations: turns aligned to an alternating grammar at least cost.

A repaired conversation is empty, or an optional system turn followed by pairs of user and assistant.
Rows are numbered once in a global order and cut into blocks of at most eight. Each block is aligned
(Wagner-Fischer) to every feasible length of the alternating string, from every state in which the
rows before may leave it; a conversation's repair is then the cheapest chain of its blocks. So a
conversation of any length spreads over many tasks, and only its blocks' costs meet again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.merkle import encode
from tillpoint.session import ensure_checkpoint_dir

INSERT, DELETE, REROLE, OPEN_END = 3, 4, 3, 3
#: Bits of a row's place within its partition that number it within its block.
BLOCK_BITS = 3
WHITE = " \t\n\x0b\f\r"
#: States between turns: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {NOTHING: "ua", SYSTEM: "ua", USER: "au", ASSISTANT: "ua"}
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NAME = {"u": "user", "a": "assistant"}
#: What a conversation that ends in a state still needs.
_MISSING = {NOTHING: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
_FAR = 1 << 60


def _target(state: int, system: bool, length: int) -> str:
    """The grammar string of ``length`` roles that goes on from a state."""
    turns = _NEXT[state]
    text = turns * (length // 2 + 1)
    return ("s" + text if system else text)[:length]


def align(roles: str, faults: str, target: str, bound: int = _FAR) -> tuple[int, str] | None:
    """Least cost, and the ASCII-least audit of that cost, of turning rows into ``target``.

    ``roles``: initials; ``faults``: ``b`` blank or ``d`` duplicate (must go), ``t`` truncated, ``-``
    none. An insertion stands before a row, never after the last one. Cells that cannot lie on a path
    of cost ``bound`` are left out (Ukkonen's band); None if no such path is left.
    """
    n, m = len(roles), len(target)

    def least(rows: int, places: int) -> int:
        return (rows - places) * DELETE if rows > places else (places - rows) * INSERT

    # rest[i][j]: cost from before row i with j places filled to the end
    rest = [dict[int, int]() for _ in range(n + 1)]
    rest[n][m] = 0
    for i in range(n - 1, -1, -1):
        below, here = rest[i + 1], rest[i]
        gone, open_end = faults[i] in "bd", OPEN_END if faults[i] == "t" else 0
        for j in range(m, -1, -1):
            if least(i, j) + least(n - i, m - j) > bound:
                continue
            cost = below.get(j, _FAR) + DELETE
            if j < m:
                cost = min(cost, here.get(j + 1, _FAR) + INSERT if target[j] != "s" else _FAR)
                if not gone and (roles[i] == target[j] or target[j] != "s"):
                    cost = min(cost, below.get(j + 1, _FAR) + open_end + (0 if roles[i] == target[j] else REROLE))
            if least(i, j) + cost <= bound and cost < _FAR:
                here[j] = cost
    if n and 0 not in rest[0] or not n and m:
        return None
    i = j = 0
    audit = []
    while i < n:
        cost = rest[i][j]
        gone, open_end = faults[i] in "bd", OPEN_END if faults[i] == "t" else 0
        if rest[i + 1].get(j, _FAR) + DELETE == cost:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest[i].get(j + 1, _FAR) + INSERT == cost:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if roles[i] == target[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0] if n else 0, "".join(audit)


@lru_cache(maxsize=1 << 16)
def block_moves(roles: str, faults: str) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, audit) of a block for every pair of states that it can join.

    Feasible lengths come in the order of the least cost they can have; once that passes the cheapest
    alignment found, no other length can be as cheap. Equally cheap ones are decided by their audits.
    """
    n = len(roles)
    moves = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}

        def consider(target: str, best=best, state=state) -> None:
            end = _AFTER[target[-1]] if target else state
            known = best.get(end)
            found = align(roles, faults, target, known[0] if known else _FAR)
            if found and (known is None or found < known):
                best[end] = found

        variants = [(False, length) for length in range(2 * n + 3)]
        if state == NOTHING and "s" in roles:
            variants += [(True, length) for length in range(1, 2 * n + 3)]
        floor = lambda v: (v[1] - n) * INSERT if v[1] > n else (n - v[1]) * DELETE
        for system, length in sorted(variants, key=lambda v: (floor(v), v)):
            # n deletions and two insertions reach every state but "after system", so 2 n + 2 places suffice
            known = best.get(_AFTER[_target(state, system, length)[-1]] if length else state)
            if known is None or floor((system, length)) <= known[0]:
                consider(_target(state, system, length))
        moves += [(state, end, cost, audit) for end, (cost, audit) in sorted(best.items())]
    return tuple(moves)


def chain(blocks: list[tuple[tuple[int, int, int, str], ...]]) -> tuple[int, list[tuple[int, str]], str]:
    """Cost, (state before, audit) of each block, and the roles missing at the end.

    Audits of equal length in rows never are one another's beginning, so those that lead to different
    states can be ordered once and for all by a rank, and whole audits need not be kept.
    """
    reached = {NOTHING: (0, 0)}  # state: cost, rank of the audit so far
    back: list[dict[int, tuple[int, str]]] = []
    for moves in blocks:
        best: dict[int, tuple[int, int, str, int]] = {}
        for before, after, cost, audit in moves:
            if before in reached:
                sofar, rank = reached[before]
                new = (sofar + cost, rank, audit, before)
                if after not in best or new < best[after]:
                    best[after] = new
        order = sorted(best, key=lambda q, best=best: best[q][1:3])
        reached = {q: (best[q][0], r) for r, q in enumerate(order)}
        back.append({q: (b[3], b[2]) for q, b in best.items()})
    cost, _, state = min((c + INSERT * len(_MISSING[q]), r, q) for q, (c, r) in reached.items())
    steps, at = [], state
    for step in reversed(back):
        before, audit = step[at]
        steps.append((before, audit))
        at = before
    return cost, steps[::-1], _MISSING[state]


def _spell(state: int, audit: str, roles: str) -> tuple[list[tuple[str, str | None]], int]:
    """For each row of a block: the turns inserted before it, and its new role (None: deleted, empty:
    its own); and the state after the block."""
    out, before, i = [], [], 0
    for letter in audit:
        if letter == "D":
            out.append(("".join(before), None))
            before, i = [], i + 1
            continue
        if letter == "K":
            out.append(("".join(before), ""))
            before, state, i = [], _AFTER[roles[i]], i + 1
            continue
        place = _NEXT[state][0]
        state = _AFTER[place]
        if letter == "I":
            before.append(place)
        else:
            out.append(("".join(before), _NAME[place]))
            before, i = [], i + 1
    return out, state


@dataclass
class Repair:
    """``audits``: one row for each conversation that has rows: its key ``g``, ``rows``, the faults
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``. ``turns``: the
    repaired conversations as ``g``, ``seq`` (from 1), ``role``, ``text``."""

    audits: DataFrame
    turns: DataFrame


_CHAIN_SCHEMA = (
    "g string, rows long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "steps array<struct<at:long,before:string,role:string,behind:string>>"
)


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each conversation (without steps) and one for each of its blocks (steps only), from
    blocks that come conversation by conversation in order."""
    names = [c.split(" ")[0] for c in _CHAIN_SCHEMA.split(", steps")[0].split(", ")] + ["steps"]

    def told(g: str, held: list) -> Iterator[tuple]:
        cost, steps, missing = chain([block_moves(roles, faults) for _, roles, faults in held])
        audit = "".join(a for _, a in steps) + "I" * len(missing)
        roles, faults = "".join(r for _, r, _ in held), "".join(f for *_, f in held)
        illegal = sum(roles[k : k + 2] not in ("su", "ua", "au") for k in range(len(roles) - 1))
        counts = [faults.count(x) for x in "bdt"]
        yield (g, len(roles), *counts, illegal, cost, audit, None)
        for k, ((at, own, _), (state, letters)) in enumerate(zip(held, steps, strict=True)):
            spelt, _ = _spell(state, letters, own)
            behind = missing if k == len(held) - 1 else ""
            last = len(spelt) - 1
            yield (
                g, None, None, None, None, None, None, None,
                [(int(a), before, role, behind if i == last else "") for i, (a, (before, role)) in enumerate(zip(at, spelt, strict=True))],
            )

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        for c in names[1:7]:
            out[c] = out[c].astype("Int64")
        return out

    group, held, ready = None, [], []
    for batch in batches:
        for g, at, roles, faults in batch[["g", "at", "roles", "faults"]].itertuples(index=False):
            if g != group:
                if held:
                    ready.extend(told(group, held))
                group, held = g, []
            held.append((at, roles, faults))
            if len(ready) >= 4096:
                yield frame(ready)
                ready = []
    if held:
        ready.extend(told(group, held))
    if ready:
        yield frame(ready)


_TURN_SCHEMA = pa.schema([("g", pa.string()), ("seq", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns, from each row's decision followed by the row itself, conversation by conversation."""
    group, seq, step = None, 0, None
    for batch in batches:
        out: list[tuple] = []
        for g, text, role, before, new, behind in zip(
            *[batch.column(c).to_pylist() for c in ("g", "text", "role", "before", "new", "behind")], strict=True
        ):
            if g != group:
                group, seq = g, 0
            if before is not None:  # a decision
                step = before, new, behind
                continue
            lines = [(_NAME[x], "") for x in step[0]]
            if step[1] is not None:
                lines.append((step[1] or role, text))
            lines += [(_NAME[x], "") for x in step[2]]
            for line in lines:
                seq += 1
                out.append((g, seq, *line))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(col, t.type) for col, t in zip(zip(*out, strict=True), _TURN_SCHEMA, strict=True)], schema=_TURN_SCHEMA
            )


def repair_conversations(rows: DataFrame, conv: Column | str, turn: Column | str, role: Column | str, text: Column | str) -> Repair:
    """The cheapest repair of every conversation.

    Rows of a conversation stand in the order of their turn (nulls first; equal turns by role, then
    text). A row's first fault counts: blank (nothing but white space), duplicate (role and text of an
    earlier row), truncated (does not end in ``. ! ?``). Keep costs 0, Rerole to user or assistant 3,
    Delete 4 (the only way for blank and duplicate rows), Insert of an empty user or assistant turn 3;
    a truncated row that stays adds 3. The audit holds the edits' initials in order, of equally cheap
    ones the ASCII-least.

    Null roles and texts read as one space. A null conversation is one like any other (``g``: ``-``);
    equal rows are rows of their own, told apart by where they stood. No rows give empty tables. Only
    the four given columns are read, so others may have any name. A conversation's repaired text and
    audit are one value each, so one task streams its blocks, and one its turns; nothing else of it
    meets in one place.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    col = lambda c: F.col(c) if isinstance(c, str) else c
    blanked = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", F.col("turn").asc_nulls_first(), "role", "text", "stood"]
    placed = (
        rows.select(encode(col(conv)).alias("g"), col(turn).alias("turn"), blanked(role).alias("role"), blanked(text).alias("text"))
        .withColumn("stood", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("g", "role", "text", F.monotonically_increasing_id().alias("at"))
        .checkpoint()
    )
    ended = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    seen = placed.select(
        "g",
        "at",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.unhex(F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"), 256)).alias("t"),
    )
    # A row is the first of its kind if it has the least place; places are unique, so no key is hot.
    firsts = seen.where("not blank").groupBy("g", "t").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("blank"), "b").when(F.col("first").isNull(), "d").when(F.col("truncated"), "t").otherwise("-")
    )
    coded = seen.drop("t").join(firsts, "at", "left").select("g", "at", "initial", fault.alias("fault"))
    blocks = (
        coded.groupBy("g", F.shiftright("at", BLOCK_BITS).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "initial", "fault"))).alias("rows"))
        .select(
            "g",
            F.col("rows.at").alias("at"),
            F.array_join("rows.initial", "").alias("roles"),
            F.array_join("rows.fault", "").alias("faults"),
            "block",
        )
    )
    chained = (
        blocks.repartition("g").sortWithinPartitions("g", "block").drop("block").mapInPandas(_chained, _CHAIN_SCHEMA).checkpoint()
    )
    steps = chained.where("steps is not null").select("g", F.explode("steps").alias("s"))
    decided = steps.select(
        "g", "s.at", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        "s.before", F.col("s.role").alias("new"), "s.behind",
    )
    nothing = F.lit(None).cast("string")
    given = placed.select("g", "at", F.lit(1).alias("kind"), "role", "text", nothing.alias("before"), nothing.alias("new"), nothing.alias("behind"))
    turns = (
        decided.unionByName(given)
        .repartition("g")
        .sortWithinPartitions("g", "at", "kind")
        .mapInArrow(_rewritten, "g string, seq long, role string, text string")
    )
    return Repair(chained.where("steps is null").drop("steps"), turns)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, fed turn by turn."""
    group, sha, out = None, None, []
    for batch in batches:
        for g, seq, role, text in zip(*[batch.column(c).to_pylist() for c in ("g", "seq", "role", "text")], strict=True):
            if seq == 1:
                if sha:
                    out.append((group, sha.hexdigest()))
                group, sha = g, hashlib.sha256()
            sha.update(f"{'' if seq == 1 else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pydict({"g": [g for g, _ in out], "repaired_sha256": [s for _, s in out]})
            out = []
    if sha:
        out.append((group, sha.hexdigest()))
    if out:
        yield pa.RecordBatch.from_pydict({"g": [g for g, _ in out], "repaired_sha256": [s for _, s in out]})


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` after damage by the crc32 of ``conv_id:turn`` modulo 20: 0 drops a
    row, 1 empties its text, 2 removes ``. ! ?`` from it, 3 repeats it, 4 makes it the user's. Nulls
    read as one space, in the key as well; conv_id and turn stay null."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id",
        "turn",
        said("role").alias("role"),
        said("text").alias("text"),
        (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20).alias("luck"),
    )
    text = F.when(F.col("luck") == 1, "").when(F.col("luck") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("luck") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("luck <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("luck") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(times).alias("time"),
    ).drop("time")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conversation's repair after damage.

    Every conv_id of the table has one row (null is one of them); one without rows after damage has
    zeros, an empty audit and the digest of an empty text. ``gaps`` counts the turns missing between
    the least and the greatest, null turns left aside. Other columns are not read."""
    hurt = damage(conversations)
    repaired = repair_conversations(hurt, "conv_id", "turn", "role", "text")
    g = encode(F.col("conv_id"))
    wide = F.col("turn").cast("decimal(38,0)")
    gaps = hurt.groupBy(g.alias("g")).agg(
        (F.max(wide) - F.min(wide) + F.lit(1).cast("decimal(38,0)") - F.count_distinct("turn")).cast("long").alias("gaps")
    )
    shas = repaired.turns.mapInArrow(_hashed, "g string, repaired_sha256 string")
    known = conversations.groupBy("conv_id").agg(F.count("*").alias("given")).select("conv_id", g.alias("g"))
    out = known.join(gaps, "g", "left").join(repaired.audits, "g", "left").join(shas, "g", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
