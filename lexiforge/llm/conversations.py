"""Operator 13: conversation structure repair by a higher-order fold.

The rows of a conversation are sorted into ranges of the whole table, so one
conversation may cross many of them.  Windows inside a range derive the flags of
faults; bounded chunks of a conversation are collected as sorted arrays and
folded by ``aggregate()``, which carries four (cost, audit) structs, one per
state of the pattern ``(s?(ua)+)?``, through ``least``.  A chunk that does not
begin its conversation is folded once per state it can be entered in; those
tables are put together level by level, ``FAN`` at a time, so no task holds more
than that many chunks.

An audit marks every row's end with the state reached (a digit).  Digits stand
at the same places in strings that agree up to there, so they change no
comparison; they tell the writer of the repaired rows which role an edit gave.

Defined cases: a null role or text is one space; null ids are one conversation;
null turns come first; rows of one turn come by role, then text (code points),
equal ones adjacent; a role's initial is its first character, whatever follows.
Texts of any length are only compared, searched for their last character and
streamed into the digest.  Rows of one conversation, turn and role whose texts
share the first 100 characters are sorted in one task, with spilling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, materialize, trimmed

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
CHUNK, FAN = 128, 32
STATES = ("e", "s", "u", "a")  # nothing yet, after s, after u, after a
_NEVER = 1 << 60


def damaged(rows: DataFrame) -> DataFrame:
    """The fixed damage of the query: by ``crc32(conv_id:turn) % 20``, nulls as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(h == 4, "user").otherwise(space("role"))
    slim = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), h.alias("h"))
    return slim.filter("h <> 0").withColumn("copies", F.when(F.col("h") == 3, 2).otherwise(1).cast("long")).drop("h")


def ordered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies with ``part`` and ``idx``: (part, idx) is the order, a row in no more than one part.

    Equal rows become one row with a count first, so that a row repeated a billion times is one row of its range.
    """
    grouped = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    ranged = grouped.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 100))
    local = ranged.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("_id", F.monotonically_increasing_id())
    split = local.withColumn("part", F.shiftright("_id", 33)).withColumn("idx", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    return materialize(split.drop("_id"), "conversation-turns")


def flagged(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without texts: conv_id, part, idx, turn, copies, n (place in the part), first, initial, blank, repeat, cut.

    Also the conversations that cross parts: at most one per border of a part.
    """
    known = F.sha2(F.to_json(F.struct(F.col("conv_id").cast("string").alias("c"), "role", "text"), {"ignoreNullFields": "false"}), 256)
    last = F.right(trimmed(F.col("text")), F.lit(1))
    slim = turns.select(
        "conv_id", "part", "idx", "turn", "copies", F.substring("role", 1, 1).alias("initial"), known.alias("known"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    crossing = turns.groupBy("conv_id").agg(F.min("part").alias("from"), F.max("part").alias("to")).filter("from < to")
    crossing = crossing.select(F.col("conv_id").alias("_conv"), "from")
    here = Window.partitionBy("conv_id", "part").orderBy("idx")
    again = Window.partitionBy("conv_id", "part", "known").orderBy("idx")
    rows = slim.withColumn("n", F.row_number().over(here)).withColumn("seen", F.row_number().over(again) > 1)
    rows = rows.join(F.broadcast(crossing), F.col("conv_id").eqNullSafe(F.col("_conv")), "left")  # at most one row per part
    # texts met in several parts: only the first row of each part asks
    asks = F.when(F.col("from").isNotNull() & ~F.col("seen"), F.col("known")).otherwise(F.concat_ws(":", "part", "idx"))
    rows = rows.withColumn("asks", asks).withColumn("first", (F.col("n") == 1) & (F.col("from").isNull() | (F.col("from") == F.col("part"))))
    crossed = rows.filter(F.col("from").isNotNull()).groupBy("known").agg(F.min("part").alias("_in"), F.max("part").alias("_to")).filter("_in < _to")
    crossed = crossed.select(F.col("known").alias("_known"), "_in")
    rows = rows.join(crossed, F.col("asks") == F.col("_known"), "left")
    repeat = F.col("seen") | F.coalesce(F.col("part") > F.col("_in"), F.lit(False))
    return rows.select("conv_id", "part", "idx", "turn", "copies", "n", "first", "initial", "blank", (~F.col("blank") & repeat).alias("repeat"), (~F.col("blank") & ~repeat & F.col("cut")).alias("cut")), crossing


def _best(cost: Column, audit: Column) -> Column:
    return F.struct(cost.cast("long").alias("cost"), audit.alias("audit"))


def _add(x: Column, cost: int | Column, letter: str | Column) -> Column:
    more = F.lit(letter) if isinstance(letter, str) else letter
    return _best(x["cost"] + cost, F.concat(x["audit"], more))


def _inserted(x: Column) -> Column:
    """The states after any number of insertions (two at most are of use)."""
    u = F.least(x["u"], _add(x["e"], INSERT, "I"), _add(x["s"], INSERT, "I"), _add(x["a"], INSERT, "I"))
    return let(u, lambda y: _states({"e": x["e"], "s": x["s"], "u": y, "a": F.least(x["a"], _add(y, INSERT, "I"))}))


def _states(found: dict[str, Column]) -> Column:
    return F.struct(*[found[k].alias(k) for k in STATES])


def _entered(state: str) -> Column:
    return _states({k: _best(F.lit(0 if k == state else _NEVER), F.lit("")) for k in STATES})


def _step(x: Column, row: Column) -> Column:
    """One row: kept, given another role or deleted, after insertions before it; its repeats are deleted."""
    never = _best(F.lit(_NEVER), F.lit(""))
    alive, extra = ~(row["blank"] | row["repeat"]), DELETE * (row["copies"] - 1)
    more = F.repeat(F.lit("D"), (row["copies"] - 1).cast("int"))
    stays = extra + F.when(row["cut"], UNFINISHED).otherwise(0)
    mark = lambda letter, state: F.concat(F.lit(letter), more, F.lit(str(STATES.index(state))))

    def moved(ins: Column, start: Column) -> Column:
        gone = lambda state: _add(ins[state], DELETE + extra, mark("D", state))
        kept = lambda at, initial: F.when(alive & (row["initial"] == initial), _add(at, stays + KEEP, mark("K", initial))).otherwise(never)
        made = lambda at, state: F.when(alive, _add(at, stays + REROLE, mark("R", state))).otherwise(never)
        return _states(
            {
                "e": gone("e"),
                "s": F.least(gone("s"), kept(ins["e"], "s")),
                "u": F.least(gone("u"), kept(start, "u"), made(start, "u")),
                "a": F.least(gone("a"), kept(ins["u"], "a"), made(ins["u"], "a")),
            }
        )

    return let(_inserted(x), lambda ins: let(F.least(ins["e"], ins["s"], ins["a"]), lambda start: moved(ins, start)))


def _composed(x: Column, table: Column) -> Column:
    """States after a chunk given by its table (one entry per state it is entered in)."""
    out = {}
    for k in STATES:
        ways = [_best(x[s]["cost"] + table[i][k]["cost"], F.concat(x[s]["audit"], table[i][k]["audit"])) for i, s in enumerate(STATES)]
        out[k] = F.least(*ways)
    return _states(out)


def _legal(pair: Column) -> Column:
    return pair.isin("su", "ua", "au")


def chunks(rows: DataFrame) -> DataFrame:
    """conv_id, part, chunk, table, pairs: the folds of bounded runs of rows."""
    row = F.struct("idx", "copies", "initial", "blank", "repeat", "cut")
    runs = rows.groupBy("conv_id", "part", F.floor((F.col("n") - 1) / CHUNK).cast("long").alias("chunk")).agg(
        F.sort_array(F.collect_list(row)).alias("run"), F.max("first").alias("first")
    )
    entries = F.when(F.col("first"), F.array(_entered("e"))).otherwise(F.array(*[_entered(s) for s in STATES]))
    table = F.transform(entries, lambda entry: F.aggregate("run", entry, _step))
    one = lambda r: F.struct(r["initial"].alias("head"), r["initial"].alias("tail"), (r["copies"] - 1).alias("illegal"))
    pairs = F.aggregate(F.slice("run", 2, CHUNK), one(F.get("run", F.lit(0))), lambda x, r: _joined(x, one(r)))
    return runs.select("conv_id", "part", "chunk", table.alias("table"), pairs.alias("pairs"))


def _joined(x: Column, y: Column) -> Column:
    wrong = F.when(_legal(F.concat(x["tail"], y["head"])), 0).otherwise(1)
    return F.struct(x["head"].alias("head"), y["tail"].alias("tail"), (x["illegal"] + y["illegal"] + wrong).alias("illegal"))


def _merged(rows: DataFrame, part: Column, chunk: Column) -> DataFrame:
    group = rows.groupBy("conv_id", part.cast("long").alias("_p"), chunk.cast("long").alias("_c")).agg(
        F.sort_array(F.collect_list(F.struct("part", "chunk", "table", "pairs"))).alias("run")
    )
    head, rest = F.get("run", F.lit(0)), F.slice("run", 2, FAN * 2)
    table = F.aggregate(rest, head["table"], lambda x, y: F.transform(x, lambda entry: _composed(entry, y["table"])))
    pairs = F.aggregate(rest, head["pairs"], lambda x, y: _joined(x, y["pairs"]))
    return group.select("conv_id", F.col("_p").alias("part"), F.col("_c").alias("chunk"), table.alias("table"), pairs.alias("pairs"))


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, marked: the cheapest audit of each conversation, with its marks."""
    level = materialize(chunks(rows), "conversation-chunks")
    top = level.agg(F.max("chunk").alias("chunk"), F.max("part").alias("part")).first()
    chunk, part = top["chunk"] or 0, top["part"] or 0
    while chunk:
        level, chunk = _merged(level, F.col("part"), F.floor(F.col("chunk") / FAN)), chunk // FAN
    while part:
        level, part = _merged(level, F.floor(F.col("part") / FAN), F.lit(0)), part // FAN
    best = let(F.get("table", F.lit(0)), lambda x: let(_inserted(x), lambda end: F.least(end["e"], end["a"])))
    return level.withColumn("best", best).select("conv_id", F.col("pairs.illegal").cast("long").alias("illegal"), F.col("best.cost").alias("cost"), F.col("best.audit").alias("marked"))


_ROLES = {"u": "user", "a": "assistant"}


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text of the repaired rows; those of a conversation stand in order in one partition.

    One stream per partition: an audit comes first, then its rows; only the audit is held.
    """
    schema = turns.select("conv_id").schema.add("place", "long").add("role", "string").add("text", "string")
    rows = turns.select("conv_id", "part", "idx", "copies", "role", "text")
    heads = found.select("conv_id", F.lit(-1).cast("long").alias("part"), F.lit(-1).cast("long").alias("idx"), F.lit(0).cast("long").alias("copies"), F.lit("").alias("role"), F.col("marked").alias("text"))
    stream = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "part", "idx")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, place, audit, at = None, "e", 0, "", 0

        def inserted(out: list, state: str) -> str:
            state = "a" if state == "u" else "u"
            out.append((key, place + len(out), _ROLES[state], ""))
            return state

        def closing() -> list[tuple]:
            out: list[tuple] = []
            now = state
            for _ in audit[at:]:
                now = inserted(out, now)
            return out

        for batch in batches:
            ready: list[tuple] = []
            for conv, part, copies, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "copies", "role", "text")), strict=True):
                if part < 0:
                    ready += closing()
                    key, state, place, audit, at = conv, "e", 0, text, 0
                    continue
                out: list[tuple] = []
                while audit[at] == "I":
                    state, at = inserted(out, state), at + 1
                letter = audit[at]
                at += copies  # the row and its deleted repeats
                state, at = STATES[int(audit[at])], at + 1
                if letter == "K":
                    out.append((key, place + len(out), role, text))
                elif letter == "R":
                    out.append((key, place + len(out), _ROLES[state], text))
                place += len(out)
                ready += out
            yield _batch(ready, batch.schema.field("conv_id").type)
            kind = batch.schema.field("conv_id").type
        if audit[at:]:
            yield _batch(closing(), kind)

    def _batch(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        cols = list(zip(*found, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv_id", "place", "role", "text"])

    return stream.mapInArrow(write, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``repaired_turns``: ``role:text`` joined by newlines, hashed as they stream by."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, kind = None, None, None
        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            for conv, place, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "place", "role", "text")), strict=True):
                if place == 0:
                    if running is not None:
                        out.append((key, running.hexdigest()))
                    key, running = conv, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], kind), pa.array([d for _, d in out], pa.string())], names=["conv_id", "repaired_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([running.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(digest, repaired.select("conv_id").schema.add("repaired_sha256", "string"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (conv_id, turn, role, text, copies): one report per conversation, and the repaired rows.

    The report has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.  Faults count each copy of a row: all but
    the first of equal rows are duplicates, or blank.
    """
    turns = ordered_turns(rows)
    flags, _ = flagged(turns)
    flags = materialize(flags, "conversation-flags")
    more = F.col("copies") - 1
    each = flags.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("repeat"), F.col("copies")).otherwise(more)).alias("duplicate"),
        F.sum(F.col("cut").cast("long")).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counts = each.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    found = materialize(audits(flags), "conversation-audits")
    slim = found.select(F.col("conv_id").alias("_conv"), "illegal", "cost", F.translate("marked", "0123", "").alias("audit"))
    report = counts.join(slim, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return report, repaired_turns(turns, found)


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def op13_conversation_repair(rows: DataFrame) -> DataFrame:
    """The query: damage, repair, one row for each original conversation."""
    report, repaired = repair(damaged(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    hashes = digests(repaired).select(F.col("conv_id").alias("_hashed"), "repaired_sha256")
    found = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(hashes, F.col("id").eqNullSafe(F.col("_hashed")), "left")
    zeros = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in NUMBERS]
    return found.select(F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
