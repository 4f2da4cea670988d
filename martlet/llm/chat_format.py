"""Chat records of many layouts to one formatted training text with a loss mask.

A record is a JSON object. Its nested field paths (``messages[].role``), sorted and hashed, are its schema fingerprint, and the fingerprint
selects a declarative mapping (``LAYOUTS``) to canonical turns of role and text. The mappings are data: a new layout is a new
entry, whose fingerprints with and without its optional fields are worked out from it.

The template puts each turn between marks. Inside texts a backslash breaks every control string after its first character (one more
for each that stands there already), so marks are never confused with contents and unescaping gives back the text. The
loss mask is a list of spans of code points, one for each assistant text, between its marks.

Rows of a conversation are sorted and packed as a stream, ``TURNS`` turns to a record, so a conversation of any length needs
the memory of one record. The parts of a conversation follow each other in one partition: SHA-256 over a whole conversation has to
see its bytes in order, so the digests of one conversation are the work of one task, in bounded memory.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = 32
RECORD_CHARS = 1 << 20
BATCH_CHARS = 1 << 22

#: role -> marks before and after its text
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
#: any other role is spelled out: mark, role, mark, text, mark
OTHER = ("<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
CONTROLS = [m for pair in MARKS.values() for m in pair] + list(OTHER)

_FIRST = "([<\\[])"
_TAIL = "(" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")"
_ESCAPE = re.compile(_FIRST + r"(\\*)" + _TAIL)
_UNESCAPE = re.compile(_FIRST + r"\\(\\*)" + _TAIL)
_SPLIT = re.compile("(" + "|".join(map(re.escape, CONTROLS)) + ")")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


@dataclass(frozen=True)
class Turn:
    """One rule: for each element under ``each`` (or once), a turn with the texts at these paths.

    ``role`` is a role, or with a leading ``@`` the path of one. Several ``texts`` are joined by ``joint``; a rule
    whose paths are all absent gives no turn.
    """

    role: str
    texts: tuple[str, ...]
    each: str = ""
    joint: str = "\n\n"


@dataclass(frozen=True)
class Layout:
    """A mapping: field paths that a record must have or may have, and the rules for its turns, in order."""

    name: str
    required: tuple[str, ...]
    turns: tuple[Turn, ...]
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


LAYOUTS = [
    Layout("messages", ("messages[].content", "messages[].role"), (Turn("@role", ("content",), "messages[]"),)),
    Layout("parts", ("messages[].content[].text", "messages[].content[].type", "messages[].role"), (Turn("@role", ("content[].text",), "messages[]", ""),)),
    Layout("shared", ("conversations[].from", "conversations[].value"), (Turn("@from", ("value",), "conversations[]"),), roles={"human": "user", "gpt": "assistant"}),
    Layout("dialog", ("dialog.turns[].speaker.role", "dialog.turns[].utterance"), (Turn("@speaker.role", ("utterance",), "dialog.turns[]"),)),
    Layout("prompt", ("prompt", "completion"), (Turn("system", ("system",)), Turn("user", ("prompt",)), Turn("assistant", ("completion",))), ("system",)),
    Layout(
        "instruction",
        ("instruction", "output"),
        (Turn("system", ("system",)), Turn("user", ("instruction", "input")), Turn("assistant", ("output",))),
        ("input", "system"),
    ),
    Layout(
        "history",
        ("history[].question", "history[].answer", "question", "answer"),
        (Turn("user", ("question",), "history[]"), Turn("assistant", ("answer",), "history[]"), Turn("user", ("question",)), Turn("assistant", ("answer",))),
    ),
]
#: fields that say nothing of the turns and are left out of the fingerprint
IGNORED = ("id", "metadata", "source", "meta")


def field_paths(value, path: str = "") -> set[str]:
    """The paths of all leaves; an empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        found = set()
        for key, inner in value.items():
            if path or key not in IGNORED:
                found |= field_paths(inner, f"{path}.{key}" if path else key)
        return found
    if isinstance(value, list):
        return set().union(*(field_paths(v, path + "[]") for v in value)) if value else {path + "[]"}
    return {path}


def fingerprint(paths: set[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def mappings(layouts: list[Layout]) -> dict[str, Layout]:
    """The fingerprint of each combination of optional fields, and of records whose lists are empty."""
    out = {}
    for layout in layouts:
        for n in range(len(layout.optional) + 1):
            for extra in combinations(layout.optional, n):
                out[fingerprint((*layout.required, *extra))] = layout
        for turn in layout.turns:
            if turn.each:
                rest = [p for p in layout.required if not p.startswith(turn.each)]
                out[fingerprint((*rest, turn.each))] = layout
    return out


def _values(record, path: str) -> list:
    """What stands at a path, in order."""
    found = [record]
    for step in re.findall(r"[^.\[\]]+|\[\]", path):
        if step == "[]":
            found = [x for v in found if isinstance(v, list) for x in v]
        else:
            found = [v[step] for v in found if isinstance(v, dict) and step in v]
    return found


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical_turns(record, layout: Layout) -> list[tuple[str, str]]:
    turns: list[tuple[str, str]] = []
    groups: list[tuple[str, list[Turn]]] = []
    for rule in layout.turns:  # rules on the same list take turns element by element
        if groups and rule.each and groups[-1][0] == rule.each:
            groups[-1][1].append(rule)
        else:
            groups.append((rule.each, [rule]))
    for each, rules in groups:
        for element in _values(record, each) if each else [record]:
            for rule in rules:
                texts = [_text(v) for p in rule.texts for v in _values(element, p)]
                if not texts:
                    continue
                role = rule.role
                if role.startswith("@"):
                    role = _text(next(iter(_values(element, role[1:])), None))
                    role = layout.roles.get(role, role)
                turns.append((role, rule.joint.join(texts)))
    return turns


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of the loss mask."""
    out, loss, at = [], [], 0
    for role, text in turns:
        text = escape(text)
        before, after = MARKS[role] if role in MARKS else (f"{OTHER[0]}{escape(role)}{OTHER[1]}", OTHER[2])
        if role == "assistant":
            loss.append((at + len(before), at + len(before) + len(text)))
        out += (before, text, after)
        at += len(before) + len(text) + len(after)
    return "".join(out), loss


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    opening = {before: role for role, (before, _) in MARKS.items()}
    parts = _SPLIT.split(formatted)
    turns, i = [], 1
    while i < len(parts):
        if parts[i] == OTHER[0]:
            turns.append((unescape(parts[i + 1]), unescape(parts[i + 3])))
            i += 6
        else:
            turns.append((opening[parts[i]], unescape(parts[i + 1])))
            i += 4
    return turns


# --- Spark


def _sorted_rows(conversations: DataFrame) -> DataFrame:
    """Each conversation's rows together in one partition, by turn; ties by role and text, nulls first."""
    rows = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")


def _pick_layout(conv_id, part: int, turns: list[tuple[str, str]]) -> dict:
    """A record of these turns in one of the layouts that can hold them; which one follows from the key."""
    roles = tuple(r for r, _ in turns)
    raw = {"messages": [{"role": r, "content": t} for r, t in turns]}
    options = [raw]
    options.append({"messages": [{"role": r, "content": [{"type": "text", "text": t[:99]}, {"type": "text", "text": t[99:]}]} for r, t in turns]})
    options.append({"dialog": {"turns": [{"speaker": {"role": r}, "utterance": t} for r, t in turns]}, "id": part})
    if set(roles) <= set(MARKS):
        names = {"user": "human", "assistant": "gpt"}
        options.append({"conversations": [{"from": names.get(r, r), "value": t} for r, t in turns], "source": "chat"})
    own, rest = ({"system": turns[0][1]}, turns[1:]) if roles[0] == "system" else ({}, turns)
    if len(rest) >= 2 and len(rest) % 2 == 0 and tuple(r for r, _ in rest) == ("user", "assistant") * (len(rest) // 2):
        if len(rest) == 2:
            options.append(own | {"prompt": rest[0][1], "completion": rest[1][1]})
            head, gap, tail = rest[0][1].partition("\n\n")
            options.append(own | {"instruction": head, "output": rest[1][1]} | ({"input": tail} if gap else {}))
        elif not own:
            pairs = [{"question": rest[i][1], "answer": rest[i + 1][1]} for i in range(0, len(rest), 2)]
            options.append({"history": pairs[:-1]} | pairs[-1])
    return options[zlib.crc32(f"{conv_id},{part}".encode()) % len(options)]


def pack_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, record): the conversations as JSON records of different layouts, in parts of at most ``TURNS`` turns.

    Null texts and roles are empty, a null conv_id is a conversation of its own; rows of one turn stand by role and text, nulls
    first, and repeated rows are turns each. A conversation's parts stand in order in one partition. Other columns are ignored.
    """
    schema = T.StructType([conversations.schema["conv_id"], T.StructField("part", T.LongType()), T.StructField("record", T.StringType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        written = 0
        now, part, turns, size = None, 0, [], 0

        def close():
            nonlocal part, turns, size, written
            record = json.dumps(_pick_layout(now, part, turns), ensure_ascii=False)
            for column, value in zip(out, (now, part, record)):
                column.append(value)
            written += len(record)
            part, turns, size = part + 1, [], 0

        def flush():
            nonlocal out, written
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (kind, pa.int64(), pa.string()))], names=schema.names)
            out, written = ([], [], []), 0
            return batch

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and (conv != now or len(turns) == TURNS or size > RECORD_CHARS):
                    close()
                if conv != now:
                    now, part = conv, 0
                turns.append((role or "", text or ""))
                size += len(text or "")
                if written > BATCH_CHARS:
                    yield flush()
        if turns:
            close()
        yield flush()

    return _sorted_rows(conversations).mapInArrow(pack, schema)


def format_records(records: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """(conv_id, part, fingerprint, layout, formatted, loss) of each row of (conv_id, part, record).

    ``loss`` is an array of (start, stop) in code points of ``formatted``. A record that is null, no JSON object or of an unknown
    fingerprint has null layout, formatted and loss (no fingerprint either unless it is an object) and its row stays, so
    that new layouts can be counted by fingerprint. Row order within partitions is kept; other columns are ignored.
    """
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    fields = [records.schema["conv_id"], records.schema["part"]]
    fields += [T.StructField(c, T.StringType()) for c in ("fingerprint", "layout", "formatted")]
    schema = T.StructType([*fields, T.StructField("loss", T.ArrayType(span))])
    known = mappings(layouts)
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def one(text: str | None):
        try:
            record = json.loads(text or "")
        except ValueError:
            return None, None, None, None
        if not isinstance(record, dict):
            return None, None, None, None
        key = fingerprint(field_paths(record))
        layout = known.get(key)
        if layout is None:
            return key, None, None, None
        formatted, loss = format_turns(canonical_turns(record, layout))
        return key, layout.name, formatted, [{"start": a, "stop": b} for a, b in loss]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [one(t) for t in batch.column(2).to_pylist()]
            columns = [[d[i] for d in done] for i in range(4)]
            types = (pa.string(), pa.string(), pa.string(), loss_type)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types))], names=schema.names)

    return records.select("conv_id", "part", "record").mapInArrow(run, schema)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted parts say when read back: turns, loss and their digests.

    The parts of a conversation must follow each other in one partition, as ``pack_records`` leaves them. Parts without
    formatted text count as no turns. The turns come from the marks, the loss from the spans.
    """
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType())
    schema = T.StructType([formatted.schema["conv_id"], *(T.StructField(n, k) for n, k in zip(names, kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started = None, False
        n = chars = total = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        kind = pa.int64()
        out: list[tuple] = []

        def flush():
            nonlocal out
            types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=schema.names)
            out = []
            return batch

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                if started and conv != now:
                    out.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), total))
                    n = chars = total = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                now, started = conv, True
                for role, said in parse_turns(text or ""):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in spans or ():
                    said = unescape(text[span["start"] : span["stop"]])
                    loss.update(said.encode())
                    chars += len(said)
                total += len(text or "")
            yield flush()
        if started:
            out.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), total))
            yield flush()

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, schema)


def with_marked_conversation(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, -1, whose user and assistant both say control strings."""
    spark = conversations.sparkSession
    text = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    kind = conversations.schema
    more = spark.range(2).select(
        F.lit(-1).cast(kind["conv_id"].dataType).alias("conv_id"), F.col("id").cast(kind["turn"].dataType).alias("turn"), role.alias("role"), text.alias("text")
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(more)


def _oracle() -> str:
    """SQL of the digests; RE2 reads the same expression."""
    pattern = _ESCAPE.pattern.replace("'", "''")
    escaped = f"regexp_replace(%s, '{pattern}', '\\1\\2\\\\\\3', 'g')"
    length = " ".join(f"WHEN role = '{r}' THEN {len(a) + len(b)}" for r, (a, b) in MARKS.items())
    other = f"{sum(map(len, OTHER))} + length({escaped % 'role'})"
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations UNION ALL
    SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({escaped % 'text'}) + CASE {length} ELSE {other} END)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


ORACLE = _oracle()
