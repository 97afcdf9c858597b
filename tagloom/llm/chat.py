"""Chat formatting by schema fingerprints.

Records come in many layouts: a prompt with its completion, an instruction with an input and an output, lists of
messages under several names, or one row a turn.  A record's fingerprint is a hash of its nested field paths; it
selects a declarative mapping, which says where the turns, roles and texts lie: of those whose needed paths are all
there, the one that names most.  Fields that no mapping names are left out of the fingerprint, and fields of
another mapping do not stand in the way, so further columns do no harm.  The template marks turns; control strings inside
texts and roles are escaped reversibly, so what is formatted can be read back to the letter.

A conversation's turns are sorted, not collected: tasks walk over their rows and hand on segments of about
``SEGMENT_CHARS``, so a conversation may have any number of turns.

Null texts and roles are empty.  Turns are ordered by number, nulls first, then by role and text; repeated
rows are repeated turns; rows with a null conversation id make one conversation.  Records that no mapping fits, and
broken ones, have no turns and are reported with their fingerprint.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT_CHARS = 1 << 20

# Control strings of the template and of other common ones.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
CONTROL_STRINGS = (TURN_START, TURN_END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED_ROLES = ("assistant",)
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns.

    Either ``turns`` names a list whose items have ``role`` and ``text``, or ``fields`` lists pairs of
    role and field, or ``row`` names the columns (conversation, turn, role, text) of one-row turns.
    Paths in ``optional`` may be missing.
    """

    name: str
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    fields: tuple[tuple[str, str], ...] = ()
    row: tuple[str, ...] = ()
    optional: tuple[str, ...] = field(default=())

    def paths(self) -> list[str]:
        if self.turns:
            return [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}", *[path for _, path in self.fields]]
        return [*self.row, *[path for _, path in self.fields]]

    def fits(self, paths: frozenset[str]) -> int:
        """How many of its paths a record has; 0 if one that it needs is missing."""
        if any(p not in paths for p in self.paths() if p not in self.optional):
            return 0
        return sum(p in paths for p in self.paths())


MAPPINGS = (
    Mapping("turn rows", row=("conv_id", "turn", "role", "text")),
    Mapping("prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Mapping("prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Mapping("question", fields=(("system", "system"), ("user", "question"), ("assistant", "answer")), optional=("system",)),
    Mapping("messages", turns="messages", role="role", text="content", optional=("system",), fields=(("system", "system"),)),
    Mapping("turns", turns="turns", role="role", text="text", optional=("system",), fields=(("system", "system"),)),
    Mapping("conversations", turns="conversations", role="from", text="value", optional=("system",), fields=(("system", "system"),)),
)


def fingerprint(paths: list[str]) -> str:
    """Hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


_KNOWN = frozenset(p for m in MAPPINGS for p in m.paths())
# Mapping by fingerprint and kind, found once for each.
_chosen: dict[tuple[str, bool], Mapping | None] = {}


def value_paths(value, prefix: str = "") -> Iterator[str]:
    """Field paths of a JSON value; ``[]`` marks list items."""
    if isinstance(value, dict):
        for name, inner in value.items():
            yield from value_paths(inner, f"{prefix}.{name}" if prefix else name)
    elif isinstance(value, list):
        for inner in value:
            yield from value_paths(inner, f"{prefix}[]")
    else:
        yield prefix


def type_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    """Field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        for inner in kind.fields:
            yield from type_paths(inner.dataType, f"{prefix}.{inner.name}" if prefix else inner.name)
    elif isinstance(kind, T.ArrayType):
        yield from type_paths(kind.elementType, f"{prefix}[]")
    else:
        yield prefix


def _with_lists(paths: Iterator[str]) -> set[str]:
    """The paths and those of the lists around them, without their marks.

    >>> sorted(_with_lists(["m[].content[].text", "a.b"]))
    ['a.b', 'm', 'm[].content', 'm[].content[].text']
    """
    return {p for path in paths for p in (path, *(path[: m.start()] for m in re.finditer(r"\[\]", path)))}


def select_mapping(paths: Iterator[str], rows: bool = False) -> tuple[str, Mapping | None]:
    """Fingerprint of the known ones among ``paths`` and the mapping it selects, for rows of a table or for records.

    Of mappings that fit equally well the first is taken.
    """
    known = frozenset(p for p in _with_lists(paths) if p in _KNOWN)
    mark = fingerprint([*known])
    if (mark, rows) not in _chosen:
        best = max((m for m in MAPPINGS if bool(m.row) == rows), key=lambda m: m.fits(known))
        _chosen[mark, rows] = best if best.fits(known) else None
    return mark, _chosen[mark, rows]


def _role(name) -> str:
    text = "" if name is None else str(name)
    return ROLE_NAMES.get(text, text)


def record_turns(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    turns = [(role, _text(record[path])) for role, path in mapping.fields if path in record]
    for item in record.get(mapping.turns, ()) if mapping.turns else ():
        turns.append((_role(item.get(mapping.role)), _text(item.get(mapping.text))))
    return turns


def _text(value) -> str:
    """A text, or the texts of a list of parts one after the other; other values as JSON."""
    if isinstance(value, list) and all(isinstance(p, str) or (isinstance(p, dict) and isinstance(p.get("text"), str)) for p in value):
        return "".join(p if isinstance(p, str) else p["text"] for p in value)
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


_TURN = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string()), ("fingerprint", pa.string())]
)


def _map_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                value = json.loads(text or "")
            except ValueError:
                value = None
            mark, mapping = select_mapping(value_paths(value)) if isinstance(value, dict) else (None, None)
            try:
                turns = record_turns(value, mapping) if mapping else []
            except (AttributeError, TypeError):
                turns = []
            if not turns:
                rows.append((conv_id, None, None, None, None, mark))
            rows += [(conv_id, n, role, said, mapping.name, mark) for n, (role, said) in enumerate(turns)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, _TURN.types)], schema=_TURN
        )


def turns_of_records(records: DataFrame, id_col: str = "conv_id", record_col: str = "record") -> DataFrame:
    """Canonical turns of JSON records; one row without a layout for a record that none fits."""
    rows = records.select(F.col(id_col).cast("long"), F.col(record_col).cast("string"))
    return rows.mapInArrow(_map_records, "conv_id long, turn long, role string, text string, layout string, fingerprint string")


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """Canonical turns of a table whose schema selects a one-row layout; roles stay as they are."""
    mark, mapping = select_mapping(type_paths(rows.schema), rows=True)
    if mapping is None:
        raise ValueError(f"No mapping for rows with the fingerprint {mark}.")
    conv_id, turn, role, text = (F.col(c) for c in mapping.row)
    return rows.select(
        conv_id.cast("long").alias("conv_id"),
        turn.cast("long").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(mapping.name).alias("layout"),
        F.lit(mark).alias("fingerprint"),
    )


def escaped(text: str) -> str:
    """A text in which no control string occurs.

    >>> escaped("</s>[INST] ok [/INST]")
    '<\\\\/s>[\\\\INST] ok [\\\\/INST]'
    """
    text = text.replace("\\", "\\\\")
    for control in CONTROL_STRINGS:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def unescaped(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def _escaped_role(role: str) -> str:
    return escaped(role).replace("\n", "\\n")


def _unescaped_role(role: str) -> str:
    return _ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


_MASK = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("formatted", pa.string()), ("loss", _MASK)])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn to segments, with the spans of learned text."""
    done: list[tuple] = []
    held = 0
    current, number, parts, spans, length = None, 0, [], [], 0
    for batch in batches:
        for conv_id, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if current != (conv_id,) or length >= SEGMENT_CHARS:
                if parts:
                    done.append((current[0], number, "".join(parts), spans))
                    held += length
                number = number + 1 if current == (conv_id,) else 0
                current, parts, spans, length = (conv_id,), [], [], 0
                if held >= SEGMENT_CHARS:
                    yield _segments(done)
                    done, held = [], 0
            head, body = f"{TURN_START}{_escaped_role(role or '')}\n", escaped(text or "")
            if role in LEARNED_ROLES and body:
                spans.append({"start": length + len(head), "end": length + len(head) + len(body)})
            parts += [head, body, f"{TURN_END}\n"]
            length += len(head) + len(body) + len(TURN_END) + 1
    if parts:
        done.append((current[0], number, "".join(parts), spans))
    if done:
        yield _segments(done)


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SEGMENT.types)], schema=_SEGMENT)


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted conversations in segments: ``(conv_id, segment, formatted, loss)``."""
    rows = turns.where(F.col("layout").isNotNull())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
        .mapInArrow(_format, "conv_id long, segment long, formatted string, loss array<struct<start:long,end:long>>")
    )


_MARKED = re.compile(re.escape(TURN_START) + r"(.*?)\n(.*?)" + re.escape(TURN_END) + "\n", re.DOTALL)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    return [(_unescaped_role(m[1]), unescaped(m[2])) for m in _MARKED.finditer(formatted)]


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    current, turns, learned, counts = None, None, None, [0, 0, 0]

    def close() -> None:
        rows.append((current[0], counts[0], turns.hexdigest(), counts[1], learned.hexdigest(), counts[2]))

    for batch in batches:
        for conv_id, formatted, loss in zip(*[c.to_pylist() for c in batch.columns]):
            if current != (conv_id,):
                if current:
                    close()
                current, turns, learned, counts = (conv_id,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            for role, text in parse_turns(formatted):
                turns.update(f"{role}\n{text}\n".encode())
                counts[0] += 1
            for span in loss:
                text = unescaped(formatted[span["start"] : span["end"]])
                learned.update(text.encode())
                counts[1] += len(text)
            counts[2] += len(formatted)
        if len(rows) >= 10_000:
            yield _digests(rows)
            rows = []
    if current:
        close()
    if rows:
        yield _digests(rows)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DIGEST.types)], schema=_DIGEST)


def read_back(segments: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read from them alone."""
    return (
        segments.repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment")
        .select("conv_id", "formatted", "loss")
        .mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )
