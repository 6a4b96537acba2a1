"""Chat formatting by schema fingerprints.

A record's fingerprint is a hash of its nested field paths (array levels as `[]`). It selects one of a few
declarative mappings that say where turns, roles and texts lie; the mapping turns the record into canonical
turns (role, text). Turns are then written with a template whose control strings mark turns; where one stands
inside a text or role it is escaped, reversibly. The loss mask covers the assistant's texts.

Defined results: null text or role is empty; a record that no mapping knows, or that is no JSON object, gives
no turns but one row with `layout` null in `canonical_turns`; an empty table gives no rows; equal (id, turn)
rows keep an order by role and text; null ids and turns sort first. Rows stream through in order, so a
conversation is never held whole, however long.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template, and others that common chat models read as control.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = (TURN, BODY, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
_ESCAPE = re.compile("|".join(f"{re.escape(c[0])}(?=\\\\*{re.escape(c[1:])})" for c in CONTROL))
_UNESCAPE = re.compile("|".join(f"{re.escape(c[0])}\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROL))
_MARK = re.compile("|".join(re.escape(c) for c in (TURN, BODY, END)))

#: Names by which layouts call the roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}

#: Declarative mappings. `turns`: (role or path of the role, path of the text) in order; `each`: the array the paths start from.
#: `optional` paths may be missing; every other path must be there, and no further path may.
MAPPINGS: dict[str, dict] = {
    "turn_row": {"turns": [("@role", "text")], "optional": ("conv_id", "turn", "role", "text")},
    "messages": {"each": "messages", "turns": [("@role", "content")], "optional": ("messages[].name",)},
    "share": {"each": "conversations", "turns": [("@from", "value")], "optional": ("id", "system")},
    "prompt_completion": {"turns": [("user", "prompt"), ("assistant", "completion")]},
    "prompt_response": {"turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")], "optional": ("system",)},
    "question_answer": {"turns": [("user", "question"), ("assistant", "answer")]},
    "instruction": {"turns": [("system", "system"), ("user", "instruction", "input"), ("assistant", "output")], "optional": ("system", "input")},
}


def paths(value: object, at: str = "") -> set[str]:
    """Paths of the leaves of a JSON value, array elements merged under `[]`."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else str(k))}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def _known() -> dict[str, str]:
    """Fingerprint -> mapping, for every subset of a mapping's optional paths."""
    out: dict[str, str] = {}
    for name, m in MAPPINGS.items():
        each = f"{m['each']}[]." if "each" in m else ""
        need = {each + p for role, *texts in m["turns"] for p in (*texts, *([role[1:]] if role[0] == "@" else []))}
        optional = sorted({*m.get("optional", ())})
        for bits in range(1 << len(optional)):
            chosen = {p for i, p in enumerate(optional) if bits >> i & 1}
            out.setdefault(fingerprint((need - set(optional)) | chosen), name)
    return out


KNOWN = _known()


def canonical(record: object) -> tuple[str | None, list[tuple[str, str]]]:
    """Layout name and turns of one parsed record; (None, []) if no mapping has its fingerprint."""
    name = KNOWN.get(fingerprint(paths(record))) if isinstance(record, dict) and record else None
    if name is None:
        return None, []
    m = MAPPINGS[name]
    out = []
    if name == "share" and record.get("system"):
        out.append(("system", str(record["system"])))
    for item in record[m["each"]] if "each" in m else [record]:
        for role, *texts in m["turns"]:
            if role[0] != "@" and not any(t in item for t in texts):
                continue
            who = item.get(role[1:]) if role[0] == "@" else role
            body = "\n\n".join(str(item[t]) for t in texts if item.get(t) is not None and (item[t] != "" or t == texts[0]))
            out.append((ROLES.get(who, who) if who is not None else "", body))
    return name, out


def escape(text: str) -> str:
    """Break every control string by a backslash after its first character (one more, if there are some already)."""
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][:-1], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The piece of the output for a turn, and where its text lies in it."""
    head = f"{TURN}{escape(role)}{BODY}"
    body = escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of an output, unescaped."""
    marks = [(m[0], m.start(), m.end()) for m in _MARK.finditer(formatted)]
    if len(marks) % 3 or [m[0] for m in marks] != [TURN, BODY, END] * (len(marks) // 3):
        raise ValueError("not an output of this template")
    for (_, _, a), (_, b, c), (_, d, _) in zip(marks[::3], marks[1::3], marks[2::3]):
        yield unescape(formatted[a:b]), unescape(formatted[c:d])


def canonical_turns(records: DataFrame, id_col: str, record: str | Column, order: str | Column | None = None) -> DataFrame:
    """(id, turn, sub, layout, role, text) of heterogeneous records given as JSON text.

    `order` places records of one id one after the other; `sub` places the turns inside a record.
    """
    put = F.col(order) if isinstance(order, str) else order if order is not None else F.lit(0)
    src = records.select(F.col(id_col), put.cast("long").alias("turn"), (F.col(record) if isinstance(record, str) else record).alias("record"))
    kind = records.schema[id_col].dataType.simpleString()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                rows, sub, layout, role, text = [], [], [], [], []
                for i, raw in enumerate(part.column(2).to_pylist()):
                    try:
                        name, turns = canonical(json.loads(raw)) if raw is not None else (None, [])
                    except ValueError:
                        name, turns = None, []
                    for k, (r, t) in enumerate(turns or [(None, None)]):
                        for c, v in zip((rows, sub, layout, role, text), (i, k, name if turns else None, r, t)):
                            c.append(v)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(sub, pa.int32()), *(pa.array(c, pa.string()) for c in (layout, role, text))],
                    [id_col, "turn", "sub", "layout", "role", "text"],
                )

    return src.mapInArrow(convert, f"`{id_col}` {kind}, turn long, sub int, layout string, role string, text string")


def format_chats(turns: DataFrame, id_col: str) -> DataFrame:
    """Pieces of the formatted conversations, in order within each partition: (id, piece, loss, loss_start, loss_end).

    All pieces of one id lie in one partition, next to each other; joined they are the conversation's output.
    """
    ordered = turns.filter("layout is not null").repartition(id_col).sortWithinPartitions(id_col, "turn", "sub", "role", "text")
    kind = turns.schema[id_col].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, texts = b.column(1).to_pylist(), b.column(2).to_pylist()
            made = [format_turn(r or "", t or "") for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([r == "assistant" for r in roles], pa.bool_()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())],
                [id_col, "piece", "loss", "loss_start", "loss_end"],
            )

    return ordered.select(id_col, "role", "text").mapInArrow(write, f"`{id_col}` {kind}, piece string, loss boolean, loss_start long, loss_end long")


def read_back(pieces: DataFrame, id_col: str) -> DataFrame:
    """Digests of what the formatted output says, read from it again; one row per id."""
    kind = pieces.schema[id_col].dataType.simpleString()
    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = pa.schema([("n", pa.int64()), ("t", pa.string()), ("c", pa.int64()), ("l", pa.string()), ("f", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = None
        state: list | None = None

        def done(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], id_type), *(pa.array([r[k + 1] for r in rows], f.type) for k, f in enumerate(schema))], names)

        def ended() -> tuple:
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        id_type = pa.int64()
        for b in batches:
            id_type, rows = b.schema.field(0).type, []
            for who, piece, loss, start, end in zip(*(b.column(i).to_pylist() for i in range(5))):
                if state is None or who != now:
                    if state is not None:
                        rows.append(ended())
                    now, state = who, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if loss:
                    masked = unescape(piece[start:end])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(piece)
            if rows:
                yield done(rows)
        if state is not None:
            yield done([ended()])

    return pieces.mapInArrow(read, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
