r"""Chat formatting into budgeted windows.

A turn is rendered as ``<turn>role</role>text</turn>`` and a line break. Where role or
text hold one of these control strings, its ``<`` becomes ``\l``; a backslash becomes
``\\``. So a rendered turn has no control string but its own, and reading back is exact.

Turns are put in order and their token counts summed; a window takes turns while the
difference of prefix sums, with what it repeats, stays within the budget. It repeats
the conversation's system turn and the last turns before its first one, as many as
fit ``history_turns`` and ``history_tokens`` and leave room for the new turn. Turns
are never cut: one that exceeds the budget has a window of its own with the system
turn, marked ``over_budget``. The loss mask holds the character spans of the assistant
texts that are new in a window; what is repeated is masked out, so each assistant text
is a target once.

Conversations are cut into segments of ``segment_turns`` turns by rank, whatever their turn numbers; windows
never cross a segment, and each segment is one unit of work, which gets the system turn and
the history it needs as extra rows. Rows are sorted by Spark and streamed, so memory
holds one window.

Defined cases: a missing text or role is empty; a missing turn number comes last; a
missing conversation id is a conversation; equal turn numbers are ordered by role
and text, and repeated rows are repeated turns; gaps between turn numbers, negative and very large ones mean nothing; the system turn is the first row with
role ``system``, and history does not reach back over it; an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import beside
from millrace.operators.keys import assign_keys
from millrace.session import written

LAST_TURN = 1 << 62  # stands for a missing turn number
CONTROL = re.compile(r"<(?=/?turn>|/role>)")
RENDERED = re.compile(r"<turn>(.*?)</role>(.*?)</turn>\n", re.DOTALL)


@dataclass(frozen=True)
class Budget:
    tokens: int = 512
    history_tokens: int = 128
    history_turns: int = 4
    segment_turns: int = 4096


def escape(text: str) -> str:
    return CONTROL.sub(r"\\l", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "<" if m[1] == "l" else m[1], text, flags=re.DOTALL)


def render(role: str, text: str) -> str:
    return f"<turn>{escape(role)}</role>{escape(text)}</turn>\n"


def count_tokens(rendered: str) -> int:
    """Default token count: one for four bytes, rounded up."""
    return -(-len(rendered.encode("utf-8", "surrogatepass")) // 4)


@dataclass
class Turn:
    role: str
    text: str
    rendered: str
    tokens: int
    order: int = 0  # position among the segment's turns, for history


@dataclass
class Packer:
    """Windows of one segment, turn by turn."""

    budget: Budget
    count: object
    system: Turn | None = None
    history: deque = field(default_factory=deque)
    context: list = field(default_factory=list)
    new: list = field(default_factory=list)
    prefix: int = 0  # tokens of all turns so far
    start: int = 0  # the same before the window's first new turn
    repeated: int = 0  # tokens of the context
    first: int = 0

    def turn(self, role: str | None, text: str | None) -> Turn:
        rendered = render(role or "", text or "")
        return Turn(role or "", text or "", rendered, self.count(rendered))

    def past(self, t: Turn) -> None:
        """A turn that later windows may repeat."""
        if t.role == "system" and self.system is None:
            self.system = t
            self.history.clear()
        else:
            self.history.append(t)
            if len(self.history) > self.budget.history_turns:
                self.history.popleft()

    def add(self, number: int, t: Turn) -> dict | None:
        """Take the next turn; returns the window that it closes."""
        closed = None
        if self.new and self.repeated + self.prefix - self.start + t.tokens > self.budget.tokens:
            closed = self.close()
        if not self.new:
            self._open(number, t)
        self.new.append(t)
        self.prefix += t.tokens
        self.past(t)
        return closed

    def _open(self, number: int, t: Turn) -> None:
        self.first, self.start = number, self.prefix
        base = self.system.tokens if self.system else 0
        room = min(self.budget.history_tokens, self.budget.tokens - base - t.tokens)
        chosen: list[Turn] = []
        for old in reversed(self.history):
            if old.tokens > room:
                break
            room -= old.tokens
            chosen.append(old)
        self.context = ([self.system] if self.system else []) + chosen[::-1]
        self.repeated = sum(c.tokens for c in self.context)

    def close(self) -> dict | None:
        if not self.new:
            return None
        parts, spans, at = [c.rendered for c in self.context], [], sum(len(c.rendered) for c in self.context)
        for t in self.new:
            if t.role == "assistant":
                end = at + len(t.rendered) - len("</turn>\n")
                spans.append({"start": end - len(escape(t.text)), "end": end})
            parts.append(t.rendered)
            at += len(t.rendered)
        tokens = self.repeated + self.prefix - self.start
        out = {
            "first_turn": None if self.first == LAST_TURN else self.first,
            "n_context": len(self.context),
            "n_new": len(self.new),
            "tokens": tokens,
            "over_budget": tokens > self.budget.tokens,
            "text": "".join(parts),
            "loss": spans,
        }
        self.context, self.new = [], []
        return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WINDOW = [
    ("segment", pa.int64()),
    ("window", pa.int64()),
    ("first_turn", pa.int64()),
    ("n_context", pa.int32()),
    ("n_new", pa.int32()),
    ("tokens", pa.int64()),
    ("over_budget", pa.bool_()),
    ("text", pa.string()),
    ("loss", _SPANS),
]
WINDOW_SCHEMA = (
    "segment bigint, window bigint, first_turn bigint, n_context int, n_new int, tokens bigint, "
    "over_budget boolean, text string, loss array<struct<start: bigint, end: bigint>>"
)
CONTEXT_SYSTEM, CONTEXT_HISTORY, NEW = 0, 1, 2


def _flush(key_type: pa.DataType, rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r["conv"] for r in rows], key_type)]
    columns += [pa.array([r[name] for r in rows], kind) for name, kind in _WINDOW]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", *(name for name, _ in _WINDOW)])


def _pack(batches: Iterator[pa.RecordBatch], budget: Budget, count) -> Iterator[pa.RecordBatch]:
    packer, group, n, rows, size, kind, reached = None, None, 0, [], 0, None, None

    def put(window):
        nonlocal n, size
        if window:
            rows.append(window | {"conv": group[0], "segment": group[1], "window": n})
            n += 1
            size += len(window["text"])

    for batch in batches:
        kind = batch.schema.field("conv").type
        for r in batch.to_pylist():
            if packer is None or (r["conv"], r["seg"]) != group:
                if packer:
                    put(packer.close())
                packer, group, n, reached = Packer(budget, count), (r["conv"], r["seg"]), 0, None
            t = packer.turn(r["role"], r["text"])
            if r["kind"] == NEW:
                put(packer.add(r["turn"], t))
            elif r["kind"] == CONTEXT_SYSTEM:
                packer.past(t)
                reached = r["at"]
            elif reached is None or r["at"] > reached:  # history before the system turn, and that turn itself, don't count
                packer.past(t)
            if size > 4_000_000:
                yield _flush(kind, rows)
                rows, size = [], 0
    if packer:
        put(packer.close())
    if rows:
        yield _flush(kind, rows)


def _segments(rows: DataFrame, size: int) -> DataFrame:
    """The rows with ``seg``, the segment by their rank in the conversation, and ``at``, that rank from 0 where there are several.

    Ranks are needed in conversations of more than one segment only; these are counted first and sorted by ranges,
    so a conversation that holds most rows is dealt over many tasks.
    """
    counts = rows.groupBy(F.struct("conv").alias("_conv")).agg(F.count(F.lit(1)).alias("_n"))
    long = beside(written(counts.where(F.col("_n") > size).select("_conv"), "long-conversations"))
    keyed = rows.withColumn("_conv", F.struct("conv"))
    none = F.lit(None).cast("bigint")
    short = keyed.join(long, "_conv", "left_anti").withColumns({"seg": F.lit(0).cast("bigint"), "at": none})
    tied = keyed.join(long, "_conv", "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    placed = assign_keys(tied, ["conv", "turn", "role", "text", "_tie"], "_place")
    firsts = placed.groupBy("_conv").agg(F.min("_place").alias("_first"))
    ranked = placed.join(beside(written(firsts, "first-turns")), "_conv").withColumn("at", F.col("_place") - F.col("_first"))
    ranked = ranked.withColumn("seg", F.expr(f"at div {size}"))
    columns = ["conv", "seg", "at", "turn", "role", "text"]
    return short.select(*columns).unionAll(ranked.select(*columns))


def chat_windows(turns: DataFrame, budget: Budget = Budget(), count=count_tokens) -> DataFrame:
    """The windows of (conv_id, turn, role, text): formatted text, loss spans, what is repeated.

    ``count`` gives the tokens of a rendered turn; pass a tokenizer's own count to pack for a model.
    """
    turn = F.coalesce(F.col("turn").cast("bigint"), F.lit(LAST_TURN))
    rows = _segments(
        turns.select(
            F.col("conv_id").alias("conv"),
            turn.alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ),
        budget.segment_turns,
    )
    new = rows.withColumn("kind", F.lit(NEW))
    # What a segment needs from the ones before it; conversations of one segment add no rows.
    late = F.col("at") % budget.segment_turns >= budget.segment_turns - budget.history_turns
    history = rows.where(late).withColumns({"seg": F.col("seg") + 1, "kind": F.lit(CONTEXT_HISTORY)})
    long = rows.where("at is not null")
    first = F.min(F.struct("at", "turn", "text", "seg"))
    system = long.where("role = 'system'").groupBy("conv").agg(first.alias("first"))
    system = system.select(F.struct("conv").alias("_conv"), "first")
    later = long.select(F.struct("conv").alias("_conv"), F.col("seg").alias("_seg")).distinct()
    carried = later.join(system, "_conv").where(F.col("_seg") > F.col("first.seg"))
    context = carried.select(
        F.col("_conv.conv").alias("conv"),
        F.col("_seg").alias("seg"),
        F.col("first.at").alias("at"),
        F.col("first.turn").alias("turn"),
        F.lit("system").alias("role"),
        F.col("first.text").alias("text"),
        F.lit(CONTEXT_SYSTEM).alias("kind"),
    )
    order = ["conv", "seg", "kind", "at", "turn", "role", "text"]
    dealt = new.unionByName(history).unionByName(context).repartition("conv", "seg").sortWithinPartitions(*order)
    kind = turns.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(lambda batches: _pack(batches, budget, count), f"conv_id {kind}, {WINDOW_SCHEMA}")


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of a formatted window."""
    return [(unescape(m[1]), unescape(m[2])) for m in RENDERED.finditer(text)]


_DIGEST = [
    ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
    ("n_windows", pa.int64()),
]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state, conv, rows = None, None, []
    encode = lambda s: s.encode("utf-8", "surrogatepass")

    def put():
        if state:
            rows.append((conv, state["turns"], state["all"].hexdigest(), state["lost"], state["loss"].hexdigest(), state["chars"], state["windows"]))

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for r in batch.to_pylist():
            if state is None or r["conv_id"] != conv:
                put()
                conv = r["conv_id"]
                state = {"turns": 0, "lost": 0, "chars": 0, "windows": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
            for role, text in read_turns(r["text"])[r["n_context"] :]:
                state["turns"] += 1
                state["all"].update(encode(f"{role}\n{text}\n"))
            for span in r["loss"]:
                target = unescape(r["text"][span["start"] : span["end"]])
                state["lost"] += len(target)
                state["loss"].update(encode(target))
            state["chars"] += len(r["text"])
            state["windows"] += 1
    put()
    if rows:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [kind, *(k for _, k in _DIGEST)], strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", *(name for name, _ in _DIGEST)])


def window_digests(windows: DataFrame) -> DataFrame:
    """What the windows hold, read back: one row per conversation.

    A SHA-256 is a chain, so the windows of a conversation pass one task in order; it keeps only the hash states.
    """
    kind = windows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint"
    narrow = windows.select("conv_id", "segment", "window", "n_context", "text", "loss")
    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window").mapInArrow(_digests, schema)


# The conversation that every result must hold besides the table's.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def with_probe(turns: DataFrame) -> DataFrame:
    """The table and conversation -7, whose texts look like markup."""
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())])
    schema = schema.add("role", T.StringType()).add("text", T.StringType())
    probe = turns.sparkSession.createDataFrame([(PROBE_ID, i, r, PROBE_TEXT) for i, r in enumerate(("user", "assistant"))], schema)
    return turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(probe)


def digest_sql(budget: Budget) -> str:
    """The digest in SQL: windows are followed turn by turn, and begin anew with each segment."""
    esc = r"replace(replace(replace(replace({}, '\', '\\'), '<turn>', '\lturn>'), '</turn>', '\l/turn>'), '</role>', '\l/role>')"
    role, text = esc.format("role"), esc.format("text")
    history = range(1, budget.history_turns + 1)
    back = "\n".join(
        f"  , sum(cost) over (partition by conv_id order by i rows between {k} preceding and 1 preceding) as cost{k}, sum(chars) over (partition by conv_id order by i rows between {k} preceding and 1 preceding) as chars{k}"
        for k in history
    )
    fits = " ".join(
        f"when i - {k} > coalesce(sys, 0) and cost{k} <= {budget.history_tokens} and sys_cost + cost{k} + cost <= {budget.tokens} then {k}"
        for k in reversed(history)
    )
    picked = lambda what: "case k " + " ".join(f"when {k} then {what}{k}" for k in history) + " else 0 end"
    goes_on = f"run.total + w.cost <= {budget.tokens} and (w.i - 1) % {budget.segment_turns} <> 0"
    return f"""
with recursive c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select {PROBE_ID}, i, r, '{PROBE_TEXT}' from (values (0, 'user'), (1, 'assistant')) v(i, r)),
t as (select *, row_number() over (partition by conv_id order by turn nulls last, role, text) as i,
    '<turn>' || {role} || '</role>' || {text} || '</turn>' || chr(10) as line from c),
m as (select *, length(line) as chars, (strlen(line) + 3) // 4 as cost,
    min(case when role = 'system' then i end) over (partition by conv_id) as first_sys from t),
s as (select *, case when first_sys < i then first_sys end as sys,
    coalesce(max(case when i = first_sys then cost end) over (partition by conv_id), 0) * (first_sys < i)::int as sys_cost0,
    coalesce(max(case when i = first_sys then chars end) over (partition by conv_id), 0) * (first_sys < i)::int as sys_chars0{back}
  from m),
o as (select conv_id, i, cost, chars, sys, coalesce(sys_cost0, 0) as sys_cost, coalesce(sys_chars0, 0) as sys_chars,
    {", ".join(f"cost{k}, chars{k}" for k in history)} from s),
p as (select *, case {fits} else 0 end as k from o),
w as (select conv_id, i, cost, chars, sys_cost + cost + {picked("cost")} as opened, sys_chars + chars + {picked("chars")} as opened_chars from p),
run as (select conv_id, i, opened as total, opened_chars as out_chars, 1 as windows from w where i = 1
  union all select w.conv_id, w.i, case when {goes_on} then run.total + w.cost else w.opened end,
    case when {goes_on} then w.chars else w.opened_chars end,
    case when {goes_on} then 0 else 1 end
  from run join w on w.conv_id = run.conv_id and w.i = run.i + 1),
f as (select conv_id, sum(out_chars)::bigint as formatted_chars, sum(windows)::bigint as n_windows from run group by conv_id)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by i), '')) as loss_sha256,
  any_value(formatted_chars) as formatted_chars, any_value(n_windows) as n_windows
from t join f using (conv_id) group by conv_id
"""
