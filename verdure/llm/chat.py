"""Chat formatting with schema fingerprints.

A record's layout is the set of its nested field paths, array positions written ``[]``. The fingerprint is the xxhash64 of the
sorted paths. It selects a mapping, which says declaratively where turns come from; one record so becomes canonical turns
(role, text). Canonical turns are written by a template that marks turns and escapes its own control strings in texts, together
with the spans under the loss mask; ``parse`` and ``loss_text`` undo both.

Cases: a null text is empty, a null role is the empty role; turns are ordered by (turn, role, text), nulls first, and repeated
rows stay; a null conv_id is a conversation of its own; a record of unknown layout has null turns, and its fingerprint says which
layout is missing; an empty table gives an empty result; other columns are ignored, whatever their names; a very long text is a
text like others, held as often as its conversation's record is.
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

from .common import only, small

START, END = "<|im_start|>", "<|im_end|>"
#: Both open with ``<|``, which in texts is written ``<\\|``.
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """Where turns come from. ``items``: path of a list of turns, each with ``role`` and ``text`` fields; or ``fields``: (role, path, ...) in order,
    where texts of several paths of one role are joined by a blank line and absent or empty ones are left out."""

    name: str
    items: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, ...], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


MESSAGES = ("messages[].content", "messages[].role")
#: Known layouts: the field paths that a record of this layout has, and its mapping.
LAYOUTS: list[tuple[tuple[str, ...], Mapping]] = [
    (MESSAGES, Mapping("messages", items="messages")),
    (("conversations[].from", "conversations[].value"), Mapping("from-value", items="conversations", role="from", text="value", roles=(("human", "user"), ("gpt", "assistant")))),
    (("prompt", "response"), Mapping("prompt-response", fields=(("user", "prompt"), ("assistant", "response")))),
    (("completion", "prompt"), Mapping("prompt-completion", fields=(("user", "prompt"), ("assistant", "completion")))),
    (("instruction", "output"), Mapping("instruction", fields=(("user", "instruction"), ("assistant", "output")))),
    (("input", "instruction", "output"), Mapping("instruction-input", fields=(("user", "instruction", "input"), ("assistant", "output")))),
    (("input", "instruction", "output", "system"), Mapping("instruction-system", fields=(("system", "system"), ("user", "instruction", "input"), ("assistant", "output")))),
    (("answer", "question"), Mapping("question-answer", fields=(("user", "question"), ("assistant", "answer")))),
]


def paths(value, at: str = "") -> set[str]:
    """The nested field paths of a record."""
    if isinstance(value, dict) and value:
        return set().union(*(paths(v, f"{at}.{k}" if at else str(k)) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths(v, f"{at}[]") for v in value))
    return {f"{at}[]" if isinstance(value, list) else at}


def fingerprint(field_paths) -> str:
    return f"{xxhash.xxh64_intdigest(chr(10).join(sorted(field_paths)).encode()):016x}"


def registry(layouts=None) -> dict[str, Mapping]:
    return {fingerprint(p): m for p, m in (LAYOUTS if layouts is None else layouts)}


def apply_mapping(m: Mapping, record: dict) -> list[tuple[str, str]]:
    as_text = lambda v: "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    names = dict(m.roles)
    if m.items is not None:
        return [(names.get(r, r), as_text(x.get(m.text))) for x in record.get(m.items) or [] for r in [as_text(x.get(m.role))]]
    out = []
    for role, *fields in m.fields:
        texts = [as_text(record.get(f)) for f in fields]
        if len(fields) == 1 and role != "system" or any(texts):
            out.append((role, "\n\n".join(t for t in texts if t)))
    return out


def canonical(records: DataFrame, key: str, record: str, layouts=None) -> DataFrame:
    """(key, fingerprint, layout, turns) of JSON records; layout and turns are null where the layout is unknown or the JSON is broken."""
    known = registry(layouts)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 500):
            prints, names, turns = [], [], []
            for text in b.column(1).to_pylist():
                try:
                    value = json.loads(text)
                except (TypeError, ValueError):
                    value = None
                fp = fingerprint(paths(value)) if isinstance(value, dict) else None
                m = known.get(fp)
                prints.append(fp)
                names.append(m and m.name)
                turns.append(None if m is None else [{"role": r, "text": t} for r, t in apply_mapping(m, value)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.string()), pa.array(names, pa.string()), pa.array(turns, ARROW_TURNS)], names=[key, "fingerprint", "layout", "turns"])

    kind = dict(records.dtypes)[key]
    return records.select(key, record).mapInArrow(convert, f"`{key}` {kind}, fingerprint string, layout string, turns {TURNS}")


ARROW_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def as_records(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Turn rows (key, turn, role, text) as one JSON record for each conversation, in one of the layouts that can hold it, by a hash of the key: any conversation as messages, one without
    roles of the from-value layout also in that, one of a user's and an assistant's turn also as a pair of fields, one with a system turn before as an instruction."""
    own = only(rows, key, "turn", "role", "text")
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    turns = own.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("turns")).withColumn("names", F.transform("turns", lambda t: t["role"]))
    text = lambda n: F.get("turns", F.lit(n))["content"]
    pair = lambda a, b: F.to_json(F.struct(text(0).alias(a), text(1).alias(b)))
    messages = F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages")))
    renamed = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    values = F.to_json(F.struct(F.transform("turns", lambda t: F.struct(renamed(t["role"]).alias("from"), t["content"].alias("value"))).alias("conversations")))
    instruction = F.to_json(F.struct(text(0).alias("instruction"), F.lit("").alias("input"), text(1).alias("output")))
    system = F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), F.lit("").alias("input"), text(2).alias("output")))
    is_ = lambda *names: F.col("names") == F.array(*map(F.lit, names))
    any_ = F.when(F.arrays_overlap("names", F.array(F.lit("human"), F.lit("gpt"))), F.array(messages)).otherwise(F.array(messages, values))
    two = F.array(pair("prompt", "response"), pair("prompt", "completion"), pair("instruction", "output"), pair("question", "answer"))
    fits = F.when(is_("user", "assistant") & (text(0) != ""), F.concat(any_, two, F.array(instruction))).when(is_("user", "assistant"), F.concat(any_, two))
    fits = fits.when(is_("system", "user", "assistant") & (text(0) != "") & (text(1) != ""), F.concat(any_, F.array(system))).otherwise(any_)
    return turns.withColumn("fits", fits).select(key, F.col("fits")[F.pmod(F.xxhash64(key), F.size("fits")).cast("int")].alias("record"))


def as_messages(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Turn rows (key, turn, role, text) as one JSON record for each conversation, in the messages layout."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    return (
        rows.groupBy(key)
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        .select(key, F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))).alias("record"))
    )


def escape(text: str) -> str:
    """No control string can occur in what this returns: a ``|`` after ``<`` and any backslashes gets one backslash more."""
    return re.sub(r"(<\\*)\|", r"\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"(<\\*)\\\|", r"\1|", text)


def write_turns(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the code point spans under the loss mask: the texts of the ``trained`` role."""
    out, at, mask = [], 0, []
    for role, text in turns:
        head, body = f"{START}{escape(role).replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n')}\n", escape(text)
        if role == trained:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), mask


def _role(written: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], written))


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out = []
    for part in formatted.split(f"{END}\n")[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        out.append((_role(role), unescape(text)))
    return out


def loss_text(formatted: str, mask: list[tuple[int, int]]) -> str:
    return "".join(unescape(formatted[a:b]) for a, b in mask)


def format_chats(turns: DataFrame, key: str, trained: str = "assistant") -> DataFrame:
    """(key, formatted, mask_start, mask_end) of rows (key, turns); unknown layouts give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 500):
            done = [(None, None) if ts is None else write_turns([(t["role"], t["text"]) for t in ts], trained) for ts in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f for f, _ in done], pa.string()), *(pa.array([m and [x[k] for x in m] if m is not None else None for _, m in done], pa.list_(pa.int64())) for k in (0, 1))],
                names=[key, "formatted", "mask_start", "mask_end"],
            )

    kind = dict(turns.dtypes)[key]
    return turns.select(key, "turns").mapInArrow(run, f"`{key}` {kind}, formatted string, mask_start array<long>, mask_end array<long>")


def chat_digests(chats: DataFrame, key: str) -> DataFrame:
    """What can be read back from formatted chats: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; nulls where the layout is unknown."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 500):
            rows = []
            for k, text, a, e in zip(*(c.to_pylist() for c in b.columns)):
                if text is None:
                    rows.append((k, None, None, None, None, None))
                    continue
                ts, loss = parse(text), loss_text(text, list(zip(a, e)))
                rows.append((k, len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [b.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=[key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = dict(chats.dtypes)[key]
    schema = f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chats.select(key, "formatted", "mask_start", "mask_end").mapInArrow(run, schema)
