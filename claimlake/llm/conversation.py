"""Conversation structure repair over a suffix-shared automaton.

A conversation is its rows in order of turn (nulls first; rows of one turn by
role, then text).  The first fault of a row counts: blank (no character but ASCII
white space), duplicate (role and text stood earlier in the conversation),
truncated (the last character that is not white space ends no sentence).  A
repair turns the rows into a sequence of roles ``(s?(ua)+)?`` (system, user,
assistant by initial) by edits with costs: keep a row, give it the role user or
assistant, delete it (blank and duplicate rows must go), insert an empty row of
one of the two roles anywhere; a truncated row that stays adds to the cost.  The cheapest
repair is taken, of several the one whose edit initials are ASCII-least.

Method.  What a repair depends on is the conversation's signature: one letter a
row for role and fault.  The signatures of all conversations are made distinct,
read from the end, range-partitioned and sorted in that order, so those that end
alike stand together.  A task walks them as a trie from the end: its nodes, one
for each different suffix, are the states of an acyclic automaton minimised from
the end.  At each node, for each of the four grammar states (nothing yet, after
system, after user, after assistant), the cheapest cost to go and the first edit
of the best audit suffix are computed once; the rest of the suffix is that of the
node and state it leads to.  The choices in a state begin with different letters,
so equal costs are decided by one letter.  The nodes kept are those of the last
signature.

Scale: texts move twice, by conversation, sorted inside the tasks and streamed;
a task holds of a conversation one letter a row, one digest per different row
and, the second time, its audit, never its texts.  The rows of one conversation
pass one task, since the digest of its repaired text is sequential.  Signatures
are combined map-side; the join back is split by AQE if a signature is frequent.

Defined cases: a null conversation id is a conversation; null role and text are
one space; a role with any other initial, or none, fits nowhere without an edit;
an empty conversation repairs to itself; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import OUT_ROWS, materialise

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
#: Grammar states, and the state after a row of a role; what may end a conversation.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
MAY_END = (START, ASSISTANT)
#: The role, and its initial, that an edit can give in each state.
GIVEN = [("user", "u"), ("user", "u"), ("assistant", "a"), ("user", "u")]
#: Letter of a row that must go, whatever its role.
GONE = "x"
_NEVER = 1 << 62


@dataclass(frozen=True)
class Costs:
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


# the automaton --------------------------------------------------------------------

class Node:
    """Cost to go, first edit and the state after it, for each grammar state."""

    __slots__ = ("cost", "edit", "then")

    def __init__(self, best: list[tuple]):
        self.cost, self.edit, self.then = ([b[k] for b in best] for k in range(3))


def _with_inserts(best: list[tuple], costs: Costs) -> Node:
    """Inserted rows lead from state to state of one node."""
    while True:
        more = [min(b, (costs.insert + best[STEP[q][GIVEN[q][1]]][0], "I", STEP[q][GIVEN[q][1]])) for q, b in enumerate(best)]
        if more == best:
            return Node(best)
        best = more


def end_node(costs: Costs) -> Node:
    return _with_inserts([(0 if q in MAY_END else _NEVER, "", q) for q in range(4)], costs)


def node_before(letter: str, after: Node, costs: Costs) -> Node:
    """The node of ``letter`` followed by what ``after`` stands for."""
    best = []
    for q in range(4):
        choices = [(costs.delete + after.cost[q], "D", q)]
        if letter != GONE:
            extra = costs.truncated if letter.isupper() else 0
            nxt = STEP[q].get(letter.lower())
            if nxt is not None:
                choices.append((costs.keep + extra + after.cost[nxt], "K", nxt))
            nxt = STEP[q][GIVEN[q][1]]
            choices.append((costs.rerole + extra + after.cost[nxt], "R", nxt))
        best.append(min(choices))
    return _with_inserts(best, costs)


def audit_of(nodes: list[Node]) -> str:
    """Edits from the start state of the last node; ``nodes`` from the end on."""
    out, q, k = [], START, len(nodes) - 1
    while True:
        edit = nodes[k].edit[q]
        if not edit:
            return "".join(out)
        out.append(edit)
        q = nodes[k].then[q]
        if edit != "I":
            k -= 1


class Automaton:
    """Solves signatures given in order of their reversed letters; a node is
    computed once for each suffix that differs from those of the signature before."""

    def __init__(self, costs: Costs):
        self.costs, self.nodes, self.before, self.made = costs, [end_node(costs)], "", 0

    def solve(self, signature: str) -> tuple[int, str]:
        back = signature[::-1]
        shared = 0
        for a, b in zip(back, self.before):  # noqa: B905  the shorter ends it
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1:]
        for letter in back[shared:]:
            self.nodes.append(node_before(letter, self.nodes[-1], self.costs))
        self.made += len(back) - shared
        self.before = back
        return self.nodes[-1].cost[START], audit_of(self.nodes)


def solve_signatures(signatures: DataFrame, costs: Costs) -> DataFrame:
    """(signature) with any repetition -> (signature, cost, audit), each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(costs)
        for batch in batches:
            names = batch.column(0).to_pylist()
            solved = [automaton.solve(s) for s in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in solved], pa.int64()),
                                              pa.array([a for _, a in solved], pa.string())], names=["signature", "cost", "audit"])

    back = F.reverse("signature")
    return (signatures.select("signature").distinct().repartitionByRange(back).sortWithinPartitions(back)
            .mapInArrow(run, "signature string, cost long, audit string"))


# rows -----------------------------------------------------------------------------

def _shaped(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present_col: str | None) -> DataFrame:
    def text(c: str):
        return F.coalesce(F.col(c), F.lit(" "))

    present = F.col(present_col) if present_col else F.lit(True)
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"),
                       text(text_col).alias("text"), present.alias("present"))


#: Rows of a conversation in order, those that only name it first.
ORDER = ["conv", "present", "turn", "role", "text"]


class _Faults:
    """Faults and signature of one conversation, row by row."""

    def __init__(self):
        self.seen: set[bytes] = set()
        self.letters = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.initial: str | None = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        import xxhash

        if turn is not None and turn != self.high:  # in order, so a new turn is a larger one
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        digest = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
        letter = initial if initial in ("s", "u", "a") else "o"
        body = text.rstrip(SPACE)
        if not body:
            self.blank += 1
            letter = GONE
        elif digest in self.seen:
            self.duplicate += 1
            letter = GONE
        elif body[-1] not in ENDS:
            self.truncated += 1
            letter = letter.upper()
        self.seen.add(digest)
        self.letters += letter.encode()

    def row(self, conv) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.letters.decode()


def signatures(rows: DataFrame) -> DataFrame:
    """Shaped rows -> one row a conversation: counts of faults and the signature."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]
        conv, at, done, conv_type = None, None, [], None

        def out() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            types = [conv_type, *[pa.int64()] * 5, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for c, turn, role, text, present in zip(*[batch.column(k).to_pylist() for k in range(5)], strict=True):
                if at is None or c != conv:
                    if at is not None:
                        done.append(at.row(conv))
                        if len(done) >= OUT_ROWS:
                            yield out()
                            done = []
                    conv, at = c, _Faults()
                if present:
                    at.add(turn, role, text)
        if at is not None:
            done.append(at.row(conv))
        if done:
            yield out()

    columns = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
    return (rows.select("conv", "turn", "role", "text", "present").repartition("conv").sortWithinPartitions(*ORDER)
            .mapInArrow(run, columns))


class _Repaired:
    """The digest of a repaired conversation, row by row along its audit."""

    def __init__(self, audit: str):
        self.audit, self.k, self.state, self.first = audit, 0, START, True
        self.sha = hashlib.sha256()

    def _put(self, initial: str, role: str, text: str) -> None:
        self.sha.update((("" if self.first else "\n") + role + ":" + text).encode())
        self.first, self.state = False, STEP[self.state][initial]

    def inserts(self) -> None:
        while self.k < len(self.audit) and self.audit[self.k] == "I":
            role, initial = GIVEN[self.state]
            self._put(initial, role, "")
            self.k += 1

    def add(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.k]
        self.k += 1
        if edit == "K":
            self._put(role[:1], role, text)
        elif edit == "R":
            given, initial = GIVEN[self.state]
            self._put(initial, given, text)

    def hex(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


_STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Shaped rows, and one row a conversation with its audit -> the latter with
    the digest of the repaired text.  Each solved row travels ahead of its rows."""
    kind = rows.schema["conv"].dataType.simpleString()
    nothing = [F.lit(None).cast("long").alias(c) for c in _STATS]
    ahead = solved.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                          F.lit(False).alias("present"), "audit", *_STATS)
    both = ahead.unionByName(rows.where("present").select("conv", "turn", "role", "text", "present",
                                                          F.lit(None).cast("string").alias("audit"), *nothing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, at, done, conv_type = None, None, [], None

        def out() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            types = [conv_type, *[pa.int64()] * len(_STATS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types, strict=True)],
                                              names=["conv", *_STATS, "audit", "repaired_sha256"])

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for c, role, text, audit, *stats in zip(*[batch.column(k).to_pylist() for k in (0, 2, 3, 5, *range(6, 6 + len(_STATS)))],
                                                    strict=True):
                if audit is not None:
                    if at is not None:
                        done.append((*head, at.hex()))
                        if len(done) >= OUT_ROWS:
                            yield out()
                            done = []
                    head, at = (c, *stats, audit), _Repaired(audit)
                else:
                    at.add(role, text)
        if at is not None:
            done.append((*head, at.hex()))
        if done:
            yield out()

    columns = f"conv {kind}, {', '.join(f'{c} long' for c in _STATS)}, audit string, repaired_sha256 string"
    return both.repartition("conv").sortWithinPartitions(*ORDER).mapInArrow(run, columns)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present_col: str | None = None, costs: Costs = Costs()) -> DataFrame:  # noqa: B008  frozen
    """One row a conversation: id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.  Rows whose ``present_col`` is false only name their conversation."""
    shaped = _shaped(rows, conv_col, turn_col, role_col, text_col, present_col)
    found = materialise(signatures(shaped), "conversation-signatures")
    solved = found.join(solve_signatures(found, costs), "signature")
    return digests(shaped, solved).withColumnRenamed("conv", conv_col)


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, decided by a digest of id and turn: one in twenty
    each is dropped (``present`` false), emptied, stripped of sentence ends, repeated, given to the user."""
    def name(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(lot == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(lot == 1, F.lit("")).when(lot == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (lot != 0).alias("present"), F.explode(F.array_repeat(F.lit(0), F.when(lot == 3, 2).otherwise(1))).alias("copy")).drop("copy")
