"""Chat formatting of heterogeneous records by schema fingerprints.

A record is JSON. The sorted set of its nested field paths, hashed, is its
fingerprint; a fingerprint selects a declarative mapping: which array (or which
fields) hold the turns, and where a turn's role and text are. A fingerprint of
no mapping is led back, once, to the mapping with the most paths that it
contains, so optional fields do no harm. Mapped records become canonical (role,
text) turns, which a template renders with turn marks. Control strings inside
roles and texts are escaped reversibly. Records that can't be mapped give a row
that says why.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import map_arrow

# The marks of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>\n", "\n"


@dataclass(frozen=True)
class Mapping:
    """``paths``: the field paths of its records, array elements as ``[]``. ``turns``: the array
    of turns with its role and text fields ("" for the record itself), or else ``fields``:
    (field, role) pairs in order, joined by ``join`` where neighbours have one role. ``roles``
    renames the roles of layouts that have their own."""

    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    join: str = "\n\n"
    roles: tuple[tuple[str, str], ...] = ()


# Layouts in wide use, and the names that those with "from" and "value" give roles.
ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("prompter", "user"))
MAPPINGS = (
    Mapping(("role", "text"), "", "role", "text"),
    Mapping(("role", "content"), "", "role", "content"),
    Mapping(("from", "value"), "", "from", "value", roles=ROLES),
    Mapping(("messages", "messages[].role", "messages[].content"), "messages", "role", "content"),
    Mapping(("messages", "messages[].role", "messages[].text"), "messages", "role", "text"),
    Mapping(("conversations", "conversations[].from", "conversations[].value"), "conversations", "from", "value", roles=ROLES),
    Mapping(("prompt", "response"), fields=(("prompt", "user"), ("response", "assistant"))),
    Mapping(("prompt", "completion"), fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping(("question", "answer"), fields=(("question", "user"), ("answer", "assistant"))),
    Mapping(("instruction", "output"), fields=(("instruction", "user"), ("output", "assistant"))),
    Mapping(("instruction", "input", "output"), fields=(("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Mapping(("system", "prompt", "response"), fields=(("system", "system"), ("prompt", "user"), ("response", "assistant"))),
)


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Paths of all fields of a record, whatever their values."""
    if isinstance(value, dict):
        found = set()
        for k, v in value.items():
            name = f"{prefix}.{k}" if prefix else k
            found |= {name} | field_paths(v, name)
        return found
    if isinstance(value, list):
        return set().union(*(field_paths(v, prefix + "[]") for v in value))
    return set()


def fingerprint(paths: set[str] | tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode(), 0)


def choose(paths: set[str], empty: set[str], mappings: tuple[Mapping, ...]) -> Mapping | None:
    """The mapping with the most paths that a record's ``paths`` contain; ties: the first. Paths within
    arrays that are ``empty`` count as there."""
    there = lambda p: p in paths or any(p.startswith(e + "[]") for e in empty)
    fit = [m for m in mappings if all(map(there, m.paths))]
    return max(fit, key=lambda m: len(m.paths), default=None)


def empty_arrays(value: object, prefix: str = "") -> set[str]:
    """Paths of all fields that hold an empty array or null in its place."""
    if isinstance(value, dict):
        return set().union(*({f"{prefix}.{k}" if prefix else k} if v is None or v == [] else empty_arrays(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    return set().union(*(empty_arrays(v, prefix + "[]") for v in value)) if isinstance(value, list) else set()


def _sound(text: str) -> str:
    """The text with lone surrogates, which no UTF-8 holds, as question marks."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode()


def canonical(record: object, mapping: Mapping) -> list[tuple[str, str]]:
    """(role, text) turns; nulls are empty, other values their JSON text. Raises where a turn is no object."""
    as_text = lambda v: "" if v is None else _sound(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))
    renamed = dict(mapping.roles)
    if mapping.turns is not None:
        turns = [record] if mapping.turns == "" else record[mapping.turns] or []
        if not isinstance(turns, list) or not all(isinstance(t, dict) for t in turns):
            raise ValueError("turns must be an array of objects")
        return [(renamed.get(r := as_text(t.get(mapping.role)), r), as_text(t.get(mapping.text))) for t in turns]
    found: list[tuple[str, str]] = []
    for field, role in mapping.fields:
        text = as_text(record.get(field))
        if found and found[-1][0] == role:
            if text:
                found[-1] = role, found[-1][1] + mapping.join + text
        else:
            found.append((role, text))
    return found


def turns_of(record: str | None, mappings: tuple[Mapping, ...], known: dict) -> tuple[list[tuple[str, str]], str | None]:
    """The turns of a record (JSON text), or none and what is wrong. ``known`` holds mappings by fingerprint."""
    if record is None:
        return [], "null record"
    try:
        value = json.loads(record)
        paths, empty = field_paths(value), empty_arrays(value)
        key = fingerprint(paths), frozenset(empty)
        if key not in known:
            exact = [m for m in mappings if fingerprint(m.paths) == key[0]]
            known[key] = exact[0] if exact else choose(paths, empty, mappings)
        if known[key] is None:
            return [], _sound("no mapping for fields " + ", ".join(sorted(paths)))
        return canonical(value, known[key]), None
    except (ValueError, RecursionError) as e:
        return [], f"broken record: {type(e).__name__}"


def escape(text: str) -> str:
    r"""No mark can occur in the result: ``\`` is doubled, and a ``\`` parts ``<`` from ``|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's formatted text and the span of it under the loss mask (an assistant's text, else empty)."""
    head = START + escape(role).replace("\n", "\\n") + LINE
    body = escape(text)
    masked = len(body) if role == "assistant" else 0
    return head + body + END, len(head), len(head) + masked


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n((?:(?!<\|im_end\|>).)*)<\|im_end\|>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text. Linear: marks are found by search."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError("a turn must begin with its mark")
        line = formatted.index(LINE, at)
        end = formatted.index(END, line)
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], formatted[at + len(START) : line], flags=re.S)
        turns.append((role, unescape(formatted[line + 1 : end])))
        at = end + len(END)
    return turns


def format_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, seq, part, formatted, loss_start, loss_end, error): a row for each turn of each record.

    ``records`` has conv_id, seq (its place in the conversation) and ``record``
    (JSON text). ``part`` numbers the turns of one record. A record without
    turns, and one that is null, broken or of no known layout, gives one row
    with an empty text, so its conversation stays; ``error`` says what is wrong
    and is null otherwise. Repeated rows stay; an empty table gives no row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: dict = {}
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("conv_id", "seq", "part", "formatted", "loss_start", "loss_end", "error")}
            for conv, seq, record in zip(batch.column("conv_id").to_pylist(), batch.column("seq").to_pylist(), batch.column("record").to_pylist()):
                turns, error = turns_of(record, mappings, known)
                if len(known) > 100_000:  # no layout, but as many as rows
                    known.clear()
                for part, (formatted, a, b) in enumerate([render(role, text) for role, text in turns] or [("", 0, 0)]):
                    for k, v in zip(out, (conv, seq, part, formatted, a, b, error)):
                        out[k].append(v)
            yield out

    return map_arrow(records.select("conv_id", "seq", "record"), rows, "conv_id long, seq long, part int, formatted string, loss_start int, loss_end int, error string")


def conversations_as_records(turns: DataFrame) -> DataFrame:
    """Records of one turn each from a table (conv_id, turn, role, text); null texts are empty."""
    record = F.to_json(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"), record.alias("record"))


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted turns back gives, a row per conversation.

    Rows are dealt by conversation and sorted, and each conversation is folded
    as it streams by: however long, it is never held. Rows of equal place are
    taken in order of their formatted text.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        none = object()
        conv: object = none
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_errors")
        out: dict[str, list] = {k: [] for k in names}

        def close() -> None:
            if conv is not none:
                for k, v in zip(names, (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, errors)):
                    out[k].append(v)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end", "error")]
            for at, text, a, b, error in zip(*columns):
                if conv is none or at != conv:
                    close()
                    conv, n, loss_chars, chars, errors, turns, loss = at, 0, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said in read_back(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                masked = unescape(text[a:b])
                loss.update(masked.encode())
                loss_chars += len(masked)
                chars += len(text)
                errors += error is not None
            if len(out["conv_id"]) > 10_000:
                yield out
                out = {k: [] for k in names}
        close()
        yield out

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "part", "formatted")
    return map_arrow(ordered, rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_errors long")
