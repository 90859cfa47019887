"""Chat formatting: schema fingerprints choose declarative mappings.

Conversations come in many layouts. A record's nested field paths, sorted and
hashed, are its schema's fingerprint; a table of mappings by fingerprint says
where its turns, roles and texts are. Records become canonical turns, one row
each, and turns become text under a template that marks them. Texts are escaped
so that nothing inside them is taken for a mark, and can be read back exactly.

A turn is formatted by itself, so a conversation of any length is never gathered;
reading back goes through a conversation's turns in order, one at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import sliced

# Strings that chat models take for marks.
CONTROL = (
    "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>",
    "<end_of_turn>", "<unk>", "<pad>", "<bos>", "<eos>", "[PAD]", "[SEP]", "[CLS]", "[UNK]", "[MASK]",
)
START, AFTER_ROLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"

# Other names of roles.
ROLES = {
    "human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
    "chatgpt": "assistant", "model": "assistant", "ai": "assistant", "assistant": "assistant",
    "system": "system",
}

_STARTS = re.compile("(?=" + "|".join(re.escape(c) for c in CONTROL) + ")", re.IGNORECASE)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Breaks every control string by a backslash after its first sign.

    Backslashes of the text are doubled first, so a backslash always stands
    before the sign that it protects.
    """
    text = text.replace("\\", "\\\\")
    places = [match.start() + 1 for match in _STARTS.finditer(text)]
    if not places:
        return text
    return "\\".join(text[a:b] for a, b in zip([0, *places], [*places, len(text)]))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Mapping:
    """Where a layout's turns are.

    Either ``turns`` names the list of turns and ``role`` and ``text`` the fields
    in each, or ``fields`` lists ``(role, paths)`` of a flat record in order, the
    texts of several paths joined by an empty line where they are not empty.
    ``first`` is a leading ``(role, path)`` beside a list of turns.
    """

    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    first: tuple[str, str] | None = None


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of a record's leaves; a list adds ``[]`` whatever its length."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _layouts() -> dict[str, Mapping]:
    """Mappings by the fingerprints of the layouts they read."""
    flat = lambda *fields: Mapping(fields=tuple((r, tuple(p)) for r, *p in fields))
    system = ("system", "system")
    named = [
        ({"role", "text"}, flat(("role", "text"))),
        ({"role", "content"}, flat(("role", "content"))),
        ({"messages[].role", "messages[].content"}, Mapping("messages")),
        ({"system", "messages[].role", "messages[].content"}, Mapping("messages", first=system)),
        ({"conversations[].from", "conversations[].value"}, Mapping("conversations", "from", "value")),
        ({"system", "conversations[].from", "conversations[].value"},
         Mapping("conversations", "from", "value", first=system)),
        ({"turns[].speaker", "turns[].text"}, Mapping("turns", "speaker", "text")),
        ({"data.turns[].role", "data.turns[].text"}, Mapping("data.turns", "role", "text")),
        ({"prompt", "completion"}, flat(("user", "prompt"), ("assistant", "completion"))),
        ({"prompt", "response"}, flat(("user", "prompt"), ("assistant", "response"))),
        ({"question", "answer"}, flat(("user", "question"), ("assistant", "answer"))),
        ({"instruction", "output"}, flat(("user", "instruction"), ("assistant", "output"))),
        ({"instruction", "input", "output"},
         flat(("user", "instruction", "input"), ("assistant", "output"))),
        ({"system", "prompt", "response"},
         flat(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    ]
    return {fingerprint(paths): mapping for paths, mapping in named}


LAYOUTS = _layouts()


def canonical_turns(record: dict, layouts: dict[str, Mapping]) -> list[tuple[str, str]] | None:
    """``(role, text)`` of a record, or None where no mapping knows its layout.

    A turn's null text is empty; a role is trimmed to its usual name, others stay.
    """
    mapping = layouts.get(fingerprint(field_paths(record)))
    if mapping is None:
        return None

    def at(value: object, path: str) -> object:
        for name in path.split("."):
            value = value.get(name) if isinstance(value, dict) else None
        return value

    if mapping.turns is None:
        found = []
        for role, paths in mapping.fields:
            texts = [_text(at(record, path)) for path in paths]
            # ``role`` in a record of one turn is a field, not a name.
            role = _text(at(record, "role")) if role == "role" else role
            found.append((role, "\n\n".join(t for t in texts if t)))
    else:
        found = [(_text(t.get(mapping.role)), _text(t.get(mapping.text))) for t in at(record, mapping.turns)]
        if mapping.first:
            found.insert(0, (mapping.first[0], _text(at(record, mapping.first[1]))))
    return [(ROLES.get(role.strip().lower(), role), text) for role, text in found]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """``(formatted, start, end)``; the loss covers a learned role's text."""
    head = START + escape(role).replace("\n", "\\\n") + AFTER_ROLE
    body = escape(text)
    learned = role == LEARNED_ROLE
    return head + body + END, len(head), len(head) + len(body) if learned else len(head)


def read_turn(formatted: str) -> tuple[str, str]:
    """``(role, text)`` of one formatted turn."""
    if not (formatted.startswith(START) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    inner = formatted[len(START) : -len(END)]
    at = re.match(r"(?:[^\\\n]|\\.)*", inner, re.DOTALL).end()
    return unescape(inner[:at]), unescape(inner[at + 1 :])


_FORMATTED = (
    "conv_id LONG, turn LONG, part INT, formatted STRING, loss_start LONG, loss_end LONG, layout STRING"
)


def format_records(records: DataFrame, layouts: dict[str, Mapping] | None = None) -> DataFrame:
    """``(conv_id, turn, part, formatted, loss_start, loss_end, layout)`` of each turn.

    ``records`` has ``conv_id``, ``turn`` and ``record``, JSON of any known layout
    with one turn or many, which ``part`` numbers. The loss covers code points
    ``loss_start`` to ``loss_end`` of ``formatted``. A record that is no JSON
    object or whose layout is unknown gives one row with null ``formatted`` and
    its fingerprint in ``layout``. A conversation's text is its turns' in order.
    """
    known = LAYOUTS if layouts is None else layouts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["conv_id", "turn", "part", "formatted", "loss_start", "loss_end", "layout"]
        for batch in sliced(batches):
            rows = []
            for conv_id, turn, written in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    record = json.loads(written or "null")
                except ValueError:
                    record = None
                record = record if isinstance(record, dict) else {}
                layout = fingerprint(field_paths(record))
                turns = canonical_turns(record, known)
                if turns is None:
                    rows.append((conv_id, turn, 0, None, None, None, layout))
                for part, (role, text) in enumerate(turns or ()):
                    rows.append((conv_id, turn, part, *format_turn(role, text), layout))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return records.select("conv_id", "turn", "record").mapInArrow(run, _FORMATTED)


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows by turn as records; a null role is empty."""
    return conversations.select(
        "conv_id",
        "turn",
        F.to_json(
            F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        ).alias("record"),
    )


_READ = (
    "conv_id LONG, n_turns LONG, turns_sha256 STRING, loss_chars LONG, loss_sha256 STRING,"
    " formatted_chars LONG"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.

    Read from the formatted turns alone: each is parsed and unescaped. Turns are
    in order of turn, part and text (nulls first); conversations that share a null
    conv_id are one. A conversation's turns pass through one task as a stream, of
    which only running digests are kept.
    """
    order = ["conv_id", "turn", "part", "formatted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [f.split()[0] for f in _READ.split(", ")]
        at, state = None, None

        def closed() -> tuple:
            n, turns, chars, loss, length = state
            return (at, n, turns.hexdigest(), chars, loss.hexdigest(), length)

        for batch in sliced(batches):
            rows = []
            for conv_id, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv_id != at:
                    if state is not None:
                        rows.append(closed())
                    at, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                learned = unescape(text[start:end])
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        if state is not None:
            yield pa.record_batch(
                [pa.array([v], t) for v, t in zip(closed(), types)], names=names
            )

    return (
        formatted.where(F.col("formatted").isNotNull())
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(run, _READ)
    )
