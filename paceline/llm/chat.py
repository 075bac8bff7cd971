"""Chat formatting around a template that is only called, never looked into.

A template is a function from turns, (role, text) pairs, to a string. Rendering one turn more
at a time and comparing neighbouring outputs shows where each turn's part lies; rendering a
turn with a mark as its text shows where in its part the text lies. If an output does not
start with the one before, the template rewrites history, and that is reported.

Every turn is rendered on its whole prefix, since nothing is known of a template. Only one that
says how many turns before a turn it looks at (an attribute ``reach``) is rendered in blocks,
each after that many turns, and needs no more than a block at a time.
"""

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Turns of a block, where a template's reach allows blocks.
BLOCK_TURNS = 128
MARK = "\ue000"
START, END = "<|im_start|>", "<|im_end|>\n"
ESCAPABLE, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
SPANS = "array<struct<role:string,start:int,end:int,text_start:int,text_end:int,loss:boolean>>"
FORMATTED = f"block int, n_turns long, formatted string, spans {SPANS}, rewrites boolean"


def escape(text):
    """Break up every control string: ``<|`` gets a backslash, and so does what already has some."""
    return ESCAPABLE.sub(r"<\\\1|", text)


def unescape(text):
    return ESCAPED.sub(r"<\1|", text)


def chat_template(turns):
    """Turns between control strings; texts and roles are escaped reversibly."""
    return "".join(f"{START}{escape(r).replace('%', '%25').replace(chr(10), '%0A')}\n{escape(t)}{END}" for r, t in turns)


chat_template.reach = 0


def parse(formatted):
    """(role, text) of every turn of ``chat_template``'s output."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        stop = formatted.index(END, line + 1)
        role = formatted[at + len(START) : line].replace("%0A", "\n").replace("%25", "%")
        out.append((unescape(role), unescape(formatted[line + 1 : stop])))
        at = stop + len(END)
    return out


@dataclass
class Located:
    formatted: str
    spans: list
    rewrites: bool


def locate(turns, template, loss_roles=("assistant",), context=()) -> Located:
    """Render ``turns`` after ``context``, one turn more at a time.

    The spans are relative to what the turns add to the rendered context. If the template
    rewrites history, the output is the last rendering as a whole; turns whose part changed
    later lose their place (a null span) and are never under the loss mask.
    """
    context = list(context)
    base = template(context) if context else ""
    before, spans, rewrites = base, [], False
    for k, (role, _) in enumerate(turns):
        now = template([*context, *turns[: k + 1]])
        if not now.startswith(before):
            rewrites = True
            same = next((i for i, (a, b) in enumerate(zip(before, now)) if a != b), min(len(before), len(now)))
            spans = [s if s["end"] is not None and s["end"] + len(base) <= same else lost(s["role"]) for s in spans]
            spans.append(lost(role))
        else:
            marked = template([*context, *turns[:k], (role, MARK)])
            head = marked.find(MARK, len(before))
            tail = len(marked) - head - len(MARK)
            placed = head >= 0 and marked.startswith(before) and len(now) - tail >= head
            spans.append(
                {
                    "role": role, "start": len(before) - len(base), "end": len(now) - len(base),
                    "text_start": head - len(base) if placed else None,
                    "text_end": len(now) - tail - len(base) if placed else None,
                    "loss": placed and role in loss_roles,
                }
            )
        before = now
    return Located(before[len(base) :] if before.startswith(base) else before, spans, rewrites)


def lost(role):
    return {"role": role, "start": None, "end": None, "text_start": None, "text_end": None, "loss": False}


def in_order(turns: DataFrame, key, order) -> DataFrame:
    """Whole conversations in a partition, their rows in order."""
    return turns.repartition(key).sortWithinPartitions(key, *order)


def format_conversations(
    turns: DataFrame, key="conv_id", turn="turn", role="role", text="text",
    template=chat_template, loss_roles=("assistant",), block=BLOCK_TURNS,
) -> DataFrame:
    """A row per block of a conversation: formatted text, spans of its turns, and whether history was rewritten.

    Null texts and roles count as empty. Rows of equal turn number go by role and text, null
    turn numbers come first, and rows without a key make one conversation. No rows give no
    rows. Other columns are not carried. Texts of any length are formatted whole. A task passes over
    its conversations in order. For a template with a ``reach`` it holds one block at a time, whatever
    the length of a conversation; ``reach`` is a promise about the template, which nothing
    checks. Any other template gets one block for each conversation: it is called with every prefix
    of it, so the work grows with the square of its length, and the task holds it whole.
    """
    reach = getattr(template, "reach", None)
    rows = turns.select(
        F.col(f"`{key}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    schema = f"conv_id long, {FORMATTED}"

    def work(batches):
        current, held, context, number = object(), [], [], 0
        ready = []

        def flush():
            if held:
                found = locate(held, template, loss_roles, context)
                ready.append((current, number, len(held), found.formatted, found.spans, found.rewrites))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conversation, who, said in zip(*columns):
                if conversation != current:
                    flush()
                    current, held, context, number = conversation, [], [], 0
                elif reach is not None and len(held) == block:
                    flush()
                    context, held, number = (context + held)[len(context) + len(held) - reach :], [], number + 1
                held.append((who, said))
                if len(ready) >= 64:
                    yield as_batch(ready)
                    ready.clear()
        flush()
        yield as_batch(ready)

    def as_batch(rows):
        span = pa.struct(
            [("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text_start", pa.int32()), ("text_end", pa.int32()), ("loss", pa.bool_())]
        )
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(span), pa.bool_()]
        columns = list(zip(*rows)) if rows else [[]] * len(types)
        names = ["conv_id", "block", "n_turns", "formatted", "spans", "rewrites"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return in_order(rows, "conv_id", ["turn", "role", "text"]).mapInArrow(work, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from nothing but the formatted blocks and their loss spans."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(batches):
        current, state, ready = object(), None, []

        def flush():
            if state:
                ready.append((current, state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["size"]))

        for batch in batches:
            for row in batch.select(["conv_id", "formatted", "spans"]).to_pylist():
                if row["conv_id"] != current or state is None:
                    flush()
                    current = row["conv_id"]
                    state = {"n": 0, "chars": 0, "size": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                for who, said in parse(row["formatted"]):
                    state["n"] += 1
                    state["turns"].update(f"{who}\n{said}\n".encode())
                for s in row["spans"]:
                    if s["loss"]:
                        said = unescape(row["formatted"][s["text_start"] : s["text_end"]])
                        state["chars"] += len(said)
                        state["loss"].update(said.encode())
                state["size"] += len(row["formatted"])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*ready)) or [[]] * 6, types)], names=names)
            ready.clear()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*ready)) or [[]] * 6, types)], names=names)

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return in_order(formatted.select("conv_id", "block", "formatted", "spans"), "conv_id", ["block"]).mapInArrow(work, schema)
