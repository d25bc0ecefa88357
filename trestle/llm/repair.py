"""Repair of conversation structure by Knuth's lightest-derivation agenda.

The damaged rows of a conversation become the cheapest sequence whose role initials read ``(s?(ua)+)?``.  An item says
that the first ``i`` rows of a stretch have been repaired and the repaired rows lead from one state of that pattern to
another.  Deductions join an item with an edit of the next row (Keep, Rerole, Delete) or with an Insert, at a cost; the
value of an item is (cost, audit), where the audit holds the initials of the edits in order.  The agenda always pops the
lightest item, whose value is then final, until the wanted items are.

This is sound because the values are monotone and superior.  Costs add up and audits are joined, so no conclusion is
lighter than its premise.  The cost of an audit over given rows follows from its letters (a letter more is an Insert),
so of two audits of the same rows and cost none is the beginning of the other, and their order stays as it is whatever
follows.  The state before a Rerole or an Insert fixes the role that it gives, so an audit is one repair.

A conversation may be as large as it likes: Spark sorts its rows by range, and tasks cut what they get into stretches of
at most ``STRETCH`` rows.  The agenda runs inside a stretch from every state it may be entered in; a second one joins
the spans of a conversation's stretches, without their texts.  The chosen edits then go back to the stretches, so the
rows are repaired in as many tasks as there are stretches.  Only the digest of a conversation is one stream in order,
because SHA-256 is; it is read row by row, never held.

Defined cases: null roles and texts are one space, and so is a null in the key that draws the damage; a null conversation
id is one conversation; rows of the same turn are taken by role, then by a hash of their text; a conversation of which no
row is left has zeros, an empty audit and the hash of nothing; repeated rows are rows of their own, the later ones
duplicates; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trestle.llm.common import WHITE, land, map_batches, shuffle_width

STRETCH, STRETCH_CHARS = 512, 4 << 20
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5      # costs; the last one for truncated rows that stay
START, SYSTEM, USER, ASSISTANT = range(4)                  # what the repaired rows end with
AFTER = {(START, "s"): SYSTEM, **{(p, "u"): USER for p in (START, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
ACCEPTED = (START, ASSISTANT)
ROLE = {USER: "user", ASSISTANT: "assistant"}
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

Value = tuple[int, str]


def next_role(state: int) -> int:
    """The state that a given role (user or assistant) can lead to; there is one."""
    return ASSISTANT if state == USER else USER


def _edits(state: int, initial: str, fault: str | None) -> Iterator[tuple[int, int, str]]:
    """``state, cost, letter`` of what can be done with the next row."""
    yield state, DELETE, "D"
    if fault in (BLANK, DUPLICATE):
        return
    more = CUT_OFF if fault == TRUNCATED else 0
    kept = AFTER.get((state, initial))
    if kept is not None:
        yield kept, KEEP + more, "K"
    yield next_role(state), REROLE + more, "R"


def spans(rows: list[tuple[str, str | None]], entries: Iterable[int]) -> list[tuple[int, int, int, str]]:
    """``entry, exit, cost, audit``: the lightest repair of ``initial, fault`` rows between two states."""
    out = []
    system = any(initial == "s" and fault not in (BLANK, DUPLICATE) for initial, fault in rows)
    for entry in entries:
        agenda: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
        final: set[tuple[int, int]] = set()
        wanted = {START: 3 + system, SYSTEM: 3}.get(entry, 2)      # exits that can be reached
        while agenda and wanted:
            cost, audit, i, state = heapq.heappop(agenda)
            if (i, state) in final:
                continue
            final.add((i, state))
            if i == len(rows):
                out.append((entry, state, cost, audit))
                wanted -= 1
            else:
                for to, more, letter in _edits(state, *rows[i]):
                    if (i + 1, to) not in final:
                        heapq.heappush(agenda, (cost + more, audit + letter, i + 1, to))
            to = next_role(state)
            if (i, to) not in final:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, to))
    return out


def joined(heads: dict[int, Value], here: list[tuple[int, int, int, str]]) -> dict[int, tuple[Value, int]]:
    """The lightest way to every state after a stretch: its value and the state it entered the stretch in."""
    agenda = [(heads[p][0] + cost, heads[p][1] + audit, q, p) for p, q, cost, audit in here if p in heads]
    heapq.heapify(agenda)
    final: dict[int, tuple[Value, int]] = {}
    while agenda:
        cost, audit, q, p = heapq.heappop(agenda)
        final.setdefault(q, ((cost, audit), p))
    return final


def damaged(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that the checksum of a row's key draws."""
    def space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(space(id_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                space(role_col).alias("role"), space(text_col).alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("draw <> 0").select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``said`` (a hash of conversation, role and text), ``place`` (tells equal rows apart) and the first
    ``fault`` of each."""
    rows = land(rows.select("*", F.monotonically_increasing_id().alias("place"),
                            F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                                               F.length("role").cast("string"), "role", "text"), 256).alias("said")))
    first = rows.groupBy("said").agg(F.min(F.struct("turn", "place")).alias("first"), F.count("*").alias("n"))
    rows = rows.join(first.filter("n > 1").drop("n"), "said", "left")
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(end == "", BLANK).when(F.col("first") < F.struct("turn", "place"), DUPLICATE).when(
        ~F.substring(end, -1, 1).isin(".", "!", "?"), TRUNCATED)
    return rows.select("conv_id", "turn", "role", "text", "said", "place", fault.alias("fault"))


_STRETCHES = ("conv_id long, stretch long, spans array<struct<entry int, exit int, cost long, audit string>>, "
              "rows array<struct<role string, text string>>, first_role string, last_role string, first_turn long, "
              "last_turn long, turns long, blank long, duplicate long, truncated long, illegal long")


def illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


def stretches(rows: DataFrame, length: int = STRETCH, chars: int = STRETCH_CHARS) -> DataFrame:
    """One row per stretch of a conversation, numbered in order: its rows, spans and counts."""
    def summary(conv, number, held, inner):
        initials = [r[0][:1] for _, r, _ in held]
        turns = [t for t, _, _ in held if t is not None]
        found = spans([(i, fault) for i, (_, _, fault) in zip(initials, held)], (START,) if inner else range(4))
        return {"conv_id": conv, "stretch": number,
                "spans": [dict(zip(("entry", "exit", "cost", "audit"), s)) for s in found],
                "rows": [{"role": role, "text": text} for _, (role, text), _ in held],
                "first_role": initials[0], "last_role": initials[-1],
                "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                "turns": len(set(turns)), "illegal": sum(map(illegal, initials, initials[1:])),
                **{k: sum(f == k for _, _, f in held) for k in (BLANK, DUPLICATE, TRUNCATED)}}

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        out, conv, held, size, begins = [], None, [], 0, False

        def close():
            nonlocal held, size, number
            out.append(summary(conv, number, held, begins))
            held, size, number = [], 0, number + 1

        started = False
        for b in batches:
            for own, turn, role, text, fault in zip(*(b.column(k).to_pylist() for k in range(5))):
                if started and own != conv:
                    close()
                    begins = True           # a conversation that begins inside a task is entered in one state
                elif len(held) >= length or size > chars:
                    close()
                    begins = False
                conv, started = own, True
                held.append((turn, (role, text), fault))
                size += len(text)
            if out:
                yield {k: [r[k] for r in out] for k in out[0]}
                out = []
        if held:
            close()
            yield {k: [r[k] for r in out] for k in out[0]}

    order = ["conv_id", "turn", "role", "said", "place"]
    rows = rows.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    return map_batches(rows.select("conv_id", "turn", "role", "text", "fault"), run, _STRETCHES)


_CHOSEN = ("conv_id long, stretch long, entry int, letters string, gaps long, blank long, duplicate long, "
           "truncated long, illegal long, cost long, audit string")


def chosen(found: DataFrame) -> DataFrame:
    """Per stretch the state it is entered in and the letters of its edits; on the first one of a conversation also what
    the whole conversation has."""
    def finish(conv, paths, heads, total):
        (cost, audit), state = min((heads[q], q) for q in ACCEPTED if q in heads)     # the goal item
        ends, way = len(audit), []
        for number, back in reversed(paths):
            entry, start = back[state]
            way.append((number, entry, audit[start:ends]))
            state, ends = entry, start
        for k, (number, entry, letters) in enumerate(reversed(way)):
            whole = {**total, "cost": cost, "audit": audit} if k == 0 else {}
            yield {"conv_id": conv, "stretch": number, "entry": entry, "letters": letters,
                   **{c: whole.get(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")}}

    def run(batches):
        conv, paths, heads, total, border, started = None, [], {}, {}, {}, False
        for b in batches:
            out = []
            for r in b.to_pylist():
                if not started or r["conv_id"] != conv:
                    if started:
                        out += finish(conv, paths, heads, total)
                    conv, started, paths, heads, border = r["conv_id"], True, [], {START: (0, "")}, {}
                    total = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED, "illegal", "gaps"), 0)
                for k in (BLANK, DUPLICATE, TRUNCATED, "illegal"):
                    total[k] += r[k]
                total["illegal"] += bool(border) and illegal(border["role"], r["first_role"])
                low, high, turns = border.get("low"), border.get("high"), border.get("turns", 0) + r["turns"]
                if r["first_turn"] is not None:
                    turns -= high == r["first_turn"]
                    low, high = r["first_turn"] if low is None else low, r["last_turn"]
                    total["gaps"] = high - low + 1 - turns
                border = {"role": r["last_role"], "low": low, "high": high, "turns": turns}
                after = joined(heads, [(s["entry"], s["exit"], s["cost"], s["audit"]) for s in r["spans"]])
                paths.append((r["stretch"], {q: (p, len(heads[p][1])) for q, (_, p) in after.items()}))
                heads = {q: value for q, (value, _) in after.items()}
            if out:
                yield {k: [r[k] for r in out] for k in out[0]}
        if started:
            out = list(finish(conv, paths, heads, total))
            yield {k: [r[k] for r in out] for k in out[0]}

    spare = found.drop("rows")
    return map_batches(spare.repartition(shuffle_width(found.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "stretch"), run, _CHOSEN)


def repaired_rows(found: DataFrame, choice: DataFrame) -> DataFrame:
    """``conv_id, stretch, rows``: the repaired rows (``role, text``) of every stretch."""
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                state, left, made = r["entry"], iter(r["rows"]), []
                for letter in r["letters"]:
                    row = None if letter == "I" else next(left)
                    if letter == "D":
                        continue
                    state = AFTER[state, row["role"][:1]] if letter == "K" else next_role(state)
                    made.append({"role": row["role"] if letter == "K" else ROLE[state], "text": row["text"] if row else ""})
                out.append(made)
            yield {"conv_id": b.column(0), "stretch": b.column(1), "rows": out}

    rows = found.select("conv_id", "stretch", "rows").join(choice.select("stretch", "entry", "letters"), "stretch")
    return map_batches(rows.select("conv_id", "stretch", "rows", "entry", "letters"), run,
                       "conv_id long, stretch long, rows array<struct<role string, text string>>")


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the ``role:text`` lines of every conversation, read as a stream."""
    def run(batches):
        conv, state, started, empty = None, None, False, True
        for b in batches:
            out = []
            for own, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not started or own != conv:
                    if started:
                        out.append((conv, state.hexdigest()))
                    conv, state, started, empty = own, hashlib.sha256(), True, True
                for r in rows:
                    state.update(f"{'' if empty else '\n'}{r['role']}:{r['text']}".encode())
                    empty = False
            if out:
                yield dict(zip(("conv_id", "repaired_sha256"), map(list, zip(*out))))
        if started:
            yield {"conv_id": [conv], "repaired_sha256": [state.hexdigest()]}

    rows = repaired.repartition(shuffle_width(repaired.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "stretch")
    return map_batches(rows.select("conv_id", "rows"), run, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", length: int = STRETCH) -> tuple[DataFrame, DataFrame]:
    """The verdicts on the conversations that have rows after the damage, and their repaired rows by stretch."""
    found = land(stretches(faults(damaged(conversations, id_col, turn_col, role_col, text_col)), length))
    choice = land(chosen(found))
    return choice.filter("audit IS NOT NULL").drop("stretch", "entry", "letters"), repaired_rows(found, choice)


def report(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", length: int = STRETCH) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation."""
    verdicts, rows = repair(conversations, id_col, turn_col, role_col, text_col, length)
    every = conversations.select(F.col(id_col).cast("long").alias("conv_id")).distinct()
    sums = digests(rows).withColumnRenamed("conv_id", "_conv")
    told = verdicts.withColumnRenamed("conv_id", "_id").join(sums, F.col("_id").eqNullSafe(F.col("_conv")))
    told = every.join(told, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return told.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce(
        "repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
