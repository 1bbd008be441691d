"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate, by a square-root checkpointed dynamic program.

Roles must read ``(s?(ua)+)?`` by their initials: nothing at all, or an optional system turn and then pairs of user and assistant. A turn can be kept
(0), get the role user or assistant (1), or be deleted (2); a turn with the role user or assistant and no text can be inserted anywhere (5). Blank and
repeated turns must be deleted; a truncated turn that is not deleted adds 5. Of the cheapest edit strings (initials K, R, D, I in order) the one that
comes first in ASCII is taken.

The program runs backwards: its vector at a turn holds, for each state of the grammar (start, after system, after user, after assistant), the least
cost of the rest. Vectors are stored at checkpoints only, about the square root of a conversation's turns apart. A conversation is cut there: each
block becomes a 4 x 4 matrix (least cost from each state before it to each state behind it), the matrices give the vectors at the checkpoints from last
to first, and every block recomputes its own vectors from the checkpoint behind it and walks forward, taking at every step the first letter that is tight,
that is whose cost and rest add up to the vector. Blocks are separate rows, so the turns of one long conversation are dealt over many
tasks; since the state in which a block is entered is known only from the blocks before, each walks from all four, and the right walk is chosen after.
Only the SHA-256 of the repaired conversation is sequential by nature; it reads a conversation's turns as a stream, in constant memory.

Defined results: rows stand by turn, nulls first; equal turns by role, then by SHA-256 of the text. A null role or text counts as one space, so such a
text is blank. A null conversation id is a conversation of its own. An empty role has no initial. Rows that repeat role and text of an earlier
row are duplicates. Texts may have any length. Other columns are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same
from deltaloom.llm.vectors import partitions_of
from deltaloom.operators.ranking import number_rows
from deltaloom.storage import cut_lineage

#: Costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 60
#: Turns between checkpoints, at least.
LEAST = 64
SPACE = r"[\x20\x09-\x0D]"

#: States: 0 start, 1 after system, 2 after user, 3 after assistant. KEEP[initial][state] and GROW[state] are the states that follow.
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None, None, None, None)}
GROW = (2, 2, 3, 2)
#: A turn as one letter: its initial, in upper case if truncated, as a digit if it must go.
MUST_GO = dict(zip("1234", "suao", strict=True))


def _moves(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """What can be done with a turn in a state: action, cost and next state, deletions first, then by edit initial."""
    yield "d", DELETE, state
    if letter not in MUST_GO:
        extra = TRUNCATED if letter.isupper() else 0
        kept = KEEP[letter.lower()][state]
        if kept is not None:
            yield "k", extra, kept
        yield "ua"[GROW[state] - 2], REROLE + extra, GROW[state]


def _settled(costs: list[int]) -> list[int]:
    """Least costs when turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[GROW[s]]) for s, c in enumerate(costs)]
    return costs


def vectors(turns: str, behind: list[int]) -> list[list[int]]:
    """Cost vectors before each turn of a block, and behind the last."""
    out = [behind]
    for letter in reversed(turns):
        out.append(_settled([min(cost + out[-1][to] for _, cost, to in _moves(letter, s)) for s in range(4)]))
    return out[::-1]


#: Costs behind a conversation's last turn.
END = _settled([0, FAR, FAR, 0])


def matrix(turns: str) -> list[list[int]]:
    """Least costs from each state before a block to each state behind it."""
    columns = [vectors(turns, [0 if s == t else FAR for s in range(4)])[0] for t in range(4)]
    return [[min(FAR, columns[t][s]) for t in range(4)] for s in range(4)]


def walk(turns: str, behind: list[int], state: int, last: bool) -> tuple[list[str], int]:
    """The ASCII-least tight edits of a block, one string per turn, and the state behind it.

    A string has U or A for every turn inserted before, then d, k, u or a for the turn itself; after the conversation's last turn more may be inserted.
    """
    rest = vectors(turns, behind)
    pieces, piece, at = [], "", 0
    while at < len(turns) or last and rest[at][state] > 0:
        move = next(_tight(turns, rest, at, state))
        if move[0] == "I":
            piece, state = piece + "UA"[move[1] - 2], move[1]
        else:
            pieces.append(piece + move[0])
            piece, state, at = "", move[1], at + 1
    if pieces:
        pieces[-1] += piece
    return pieces, state


def _tight(turns: str, rest: list[list[int]], at: int, state: int) -> Iterator[tuple[str, int]]:
    """Moves whose cost and rest add up to the vector, by edit initial: delete, insert, keep, change the role."""
    moves = list(_moves(turns[at], state)) if at < len(turns) else []
    grow = GROW[state]
    if moves and moves[0][1] + rest[at + 1][state] == rest[at][state]:
        yield "d", state
    if INSERT + rest[at][grow] == rest[at][state]:
        yield "I", grow
    for action, cost, to in moves[1:]:
        if cost + rest[at + 1][to] == rest[at][state]:
            yield action, to


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns (conv_id, turn, role, text) with faults: by crc32 of ``conv_id:turn`` modulo 20 a turn is dropped, emptied, stripped of ``.!?``, repeated or given to the user."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    key = F.concat(space(F.col(conv_id)), F.lit(":"), space(F.col(turn)))
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), space(F.col(role)).alias("role"), space(F.col(text)).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def _faults(turns: DataFrame) -> DataFrame:
    """Numbered turns (conv_id, turn, role, text, nr) with their first fault and their letter."""
    order = [F.asc_nulls_first("turn"), "role", "hash"]
    rows = number_rows(turns.withColumn("hash", F.sha2("text", 256)), ["conv_id"], order, "nr")
    rows = cut_lineage(rows, "numbered-turns")
    seen = rows.groupBy("conv_id", "role", "hash").agg(F.min("nr").alias("first")).withColumnsRenamed({"role": "r", "hash": "h"})
    told = rows.hint("merge").join(
        seen.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    )
    end = F.substring(F.regexp_replace("text", f"{SPACE}+\\z", ""), -1, 1)
    blank = F.length(F.regexp_replace("text", SPACE, "")) == 0
    fault = F.when(blank, "blank").when(F.col("nr") > F.col("first"), "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    told = told.select("conv_id", "turn", "role", "text", "nr", fault.alias("fault"))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    must_go = F.translate(initial, "suao", "1234")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), must_go).when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    return cut_lineage(told.withColumn("letter", letter), "faults")


def _blocks(rows: DataFrame) -> DataFrame:
    """Frame (conv_id, block, turns): the letters between two checkpoints."""
    sizes = rows.groupBy("conv_id").agg(F.greatest(F.lit(LEAST), F.ceil(F.sqrt(F.count("*")))).alias("size"))
    dealt = join_same(rows.select("conv_id", "nr", "letter"), sizes, ["conv_id"])
    dealt = dealt.withColumn("block", F.floor((F.col("nr") - 1) / F.col("size"))).repartition(partitions_of(rows), "conv_id", "block")
    letters = F.transform(F.array_sort(F.collect_list(F.struct("nr", "letter"))), lambda x: x["letter"])
    return dealt.groupBy("conv_id", "block").agg(F.array_join(letters, "").alias("turns"), F.min("nr").alias("nr"))


def _apply(function, schema: str):
    """A function of a row's values as a mapping of Arrow batches; it returns a list of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for out in function(*row)]
            names = [x.split()[0] for x in schema.split(", ")]
            types = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}[x.split()[1]] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return run


def _checkpoints(conv_id, blocks: list[dict]) -> list[tuple]:
    """Vectors behind every block, from the conversation's last block to its first, and the conversation's cost."""
    behind, out = END, []
    for block in reversed(blocks):
        out.append((conv_id, block["block"], behind, block is blocks[-1]))
        m = block["costs"]
        behind = [min(m[4 * s + t] + behind[t] for t in range(4)) for s in range(4)]
    return [(*row, behind[0]) for row in out]


def edits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frames (conv_id, nr, piece), the edits of every turn as ``walk`` writes them, and (conv_id, cost)."""
    schema = "conv_id long, block long, nr long, turns string, costs array<long>"
    blocks = _blocks(rows).select("conv_id", "block", "nr", "turns")
    blocks = cut_lineage(blocks.mapInArrow(_apply(lambda c, b, nr, turns: [(c, b, nr, turns, sum(matrix(turns), []))], schema), schema), "blocks")
    lists = blocks.repartition(partitions_of(rows), "conv_id").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "costs"))).alias("blocks"))
    schema = "conv_id long, block long, behind array<long>, last boolean, cost long"
    points = cut_lineage(lists.mapInArrow(_apply(_checkpoints, schema), schema), "checkpoints")

    def walks(conv_id, block, nr, turns, behind, last):
        ways = [walk(turns, behind, s, last) for s in range(4)]
        return [(conv_id, block, nr, [",".join(pieces) for pieces, _ in ways], [to for _, to in ways])]

    schema = "conv_id long, block long, nr long, pieces array<string>, ends array<long>"
    ready = join_same(blocks.select("conv_id", "block", "nr", "turns"), points, ["conv_id", "block"]).select("conv_id", "block", "nr", "turns", "behind", "last")
    ready = ready.repartition(partitions_of(rows), "conv_id", "block")  # letters are few bytes but much work
    walked = cut_lineage(ready.mapInArrow(_apply(walks, schema), schema), "walks")
    # the state in which each block is entered, from the first block on
    ends = F.transform(F.array_sort(F.collect_list(F.struct("block", "ends"))), lambda x: x["ends"])
    entered = F.aggregate("ends", F.array(F.lit(0).cast("long")), lambda states, e: F.concat(states, F.array(F.get(e, F.element_at(states, -1).cast("int")))))
    states = walked.groupBy("conv_id").agg(ends.alias("ends")).select("conv_id", F.posexplode(F.slice(entered, 1, F.size("ends"))).alias("block", "state"))
    chosen = join_same(walked, states.withColumn("block", F.col("block").cast("long")), ["conv_id", "block"])
    pieces = F.split(F.get("pieces", F.col("state").cast("int")), ",")
    pieces = chosen.select("conv_id", F.col("nr").alias("begin"), F.posexplode(pieces).alias("at", "piece"))
    return pieces.select("conv_id", (F.col("begin") + F.col("at")).alias("nr"), "piece"), points.where("block = 0").select("conv_id", "cost")


#: Edit initials of the letters in ``walk``'s strings.
INITIALS = dict(zip("dkuaUA", "DKRRII", strict=True))


def _digests(turns: DataFrame) -> DataFrame:
    """Frame (conv_id, audit, repaired_sha256) from (conv_id, nr, role, text, piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, audit, first, begun = None, None, [], True, False
        told = lambda: pa.RecordBatch.from_pylist([{"conv_id": now, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], _TOLD)
        for batch in batches:
            for conv_id, role, text, piece in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "piece")), strict=True):
                if not begun or conv_id != now:
                    if begun:
                        yield told()
                    now, digest, audit, first, begun = conv_id, hashlib.sha256(), [], True, True
                for c in piece:
                    audit.append(INITIALS[c])
                    if c != "d":
                        line = f"{role}:{text}" if c == "k" else ("user:" if c in "uU" else "assistant:") + (text if c in "ua" else "")
                        digest.update(line.encode() if first else b"\n" + line.encode())
                        first = False
        if begun:
            yield told()

    dealt = turns.repartition(partitions_of(turns), "conv_id").sortWithinPartitions("conv_id", "nr")
    return dealt.select("conv_id", "role", "text", "piece").mapInArrow(run, "conv_id long, audit string, repaired_sha256 string")


_TOLD = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For turns (conv_id, turn, role, text): every turn with its fault and edits, and a report per conversation.

    The first frame is (conv_id, turn, role, text, nr, fault, letter, piece); the second (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = _faults(turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text")))
    pieces, costs = edits(rows)
    edited = cut_lineage(join_same(rows.hint("merge"), pieces, ["conv_id", "nr"]), "edited-turns")
    count = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    told = rows.groupBy("conv_id").agg(*[count(f) for f in ("blank", "duplicate", "truncated")])
    spans = rows.where("turn is not null").groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    initial = F.substring("role", 1, 1).alias("initial")
    before = rows.select("conv_id", (F.col("nr") + 1).alias("nr"), F.substring("role", 1, 1).alias("before"))
    met = join_same(rows.select("conv_id", "nr", initial), before, ["conv_id", "nr"])
    illegal = met.where(~F.concat("before", "initial").isin("su", "ua", "au")).groupBy("conv_id").agg(F.count("*").alias("illegal"))
    for more in (spans, illegal, costs, _digests(edited)):
        told = join_same(told, more, ["conv_id"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return edited, told.select("conv_id", *[zero(c) for c in numbers], "audit", "repaired_sha256")


def report(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """The report of ``repair`` for every id in ``conv_ids`` (conv_id); conversations without turns get zeros, no edits and the hash of nothing."""
    told = repair(turns)[1]
    every = conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = join_same(every, told, ["conv_id"], "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
