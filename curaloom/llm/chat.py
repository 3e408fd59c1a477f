"""Chat formatting by schema fingerprints.

A record is a JSON object in any of several layouts. The set of its nested field paths (array elements as
[]) is hashed; the fingerprint selects a declarative mapping, which turns the record into canonical turns.
The turns are rendered with a template that marks each turn; control strings inside texts are escaped
reversibly. The loss mask is the list of the spans of assistant texts in the rendered string.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaloom.llm import runtime


def field_paths(value, prefix: str = "") -> set[str]:
    """The paths of all leaves and empty containers."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value))
    return {prefix + ("[]" if isinstance(value, list) else "")}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _turns(at: str, role: str, text: str, roles: dict | None = None) -> dict:
    return {"paths": {f"{at}[].{role}", f"{at}[].{text}"}, "list": at, "role": role, "text": text, "roles": roles or {}}


def _fields(**roles: str) -> dict:
    return {"paths": set(roles.values()), "fields": list(roles.items())}


#: The known layouts; order of fields is order of turns.
LAYOUTS = {
    "messages": _turns("messages", "role", "content"),
    "share": _turns("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    "nested": _turns("data.dialog.turns", "speaker", "utterance", {"bot": "assistant"}),
    "prompt": _fields(user="prompt", assistant="completion"),
    "instruction": _fields(system="system", user="instruction", assistant="output"),
}
MAPPINGS = {fingerprint(m["paths"]): m for m in LAYOUTS.values()}


def _words(value) -> str:
    """A field's text: null as empty, what is no string as JSON."""
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True)


def schema(record: str | None) -> tuple[str | None, object]:
    """(fingerprint, value) of a record; no fingerprint for what isn't JSON."""
    try:
        value = json.loads(record or "")
        return fingerprint(field_paths(value)), value
    except (ValueError, RecursionError):
        return None, None


def canonical(record: str | None) -> list[tuple[str, str]] | None:
    """(role, text) of each turn; None for a record of no known layout.

    Null texts and roles are empty, numbers and truth values their JSON.
    """
    return _canonical(*schema(record))


def _canonical(print_: str | None, value) -> list[tuple[str, str]] | None:
    mapping = MAPPINGS.get(print_)
    if mapping is None:
        return None
    if "fields" in mapping:
        return [(role, _words(value[name])) for role, name in mapping["fields"]]
    for step in mapping["list"].split("."):
        value = value[step]
    turns = [(_words(t[mapping["role"]]), _words(t[mapping["text"]])) for t in value]
    return [(mapping["roles"].get(role, role), text) for role, text in turns]


_NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in _NAMES.items()}
_OPEN, _CLOSE = "### ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]++|\\(?:\\|###|</turn>|:))*+): ((?:[^\\<]++|\\(?:\\|###|</turn>)|<(?!/turn>))*+)</turn>\n")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The formatted conversation and its loss mask, as starts and ends in turn."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head = _OPEN + (_NAMES.get(role) or "=" + _CONTROL_IN_ROLE.sub(lambda m: "\\" + m[0], role)) + ": "
        body = escape(text)
        if role == "assistant":
            mask += [at + len(head), at + len(head) + len(body)]
        parts += [head, body, _CLOSE]
        at += len(head) + len(body) + len(_CLOSE)
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation. Raises ValueError if it isn't one."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((_ROLES.get(m[1]) or unescape(m[1][1:]), unescape(m[2])))
        at = m.end()
    return out


def loss_text(formatted: str, mask: list[int]) -> str:
    """The text under the mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in zip(mask[::2], mask[1::2], strict=True))


def _rendered(batches):
    for batch in batches:
        found = [schema(r) for r in batch.column(1).to_pylist()]
        made = [render(t) if (t := _canonical(*x)) is not None else (None, None) for x in found]
        columns = [pa.array([f for f, _ in made], pa.string()), pa.array([m for _, m in made], pa.list_(pa.int64())), pa.array([f for f, _ in found], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["conv_id", "formatted", "loss_mask", "fingerprint"])


def formatted(records: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask, fingerprint of records (conv_id, record as JSON).

    formatted and loss_mask are null where no layout fits, see `unmapped`; the fingerprint where the record isn't JSON.
    """
    runtime.bound_batches(records.sparkSession)
    return records.select("conv_id", "record").mapInArrow(_rendered, "conv_id long, formatted string, loss_mask array<long>, fingerprint string")


def unmapped(chats: DataFrame) -> DataFrame:
    """fingerprint, n, example (its smallest conv_id) of the layouts that no mapping knows; a null fingerprint stands for what isn't JSON."""
    return chats.where("formatted is null").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("example"))


def _digested(batches):
    for batch in batches:
        out = []
        for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = parse(text or "")
            loss = loss_text(text or "", mask or [])
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            out.append((len(turns), hashlib.sha256(whole.encode("utf-8", "replace")).hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "replace")).hexdigest(), len(text or "")))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(chats: DataFrame) -> DataFrame:
    """Per formatted conversation what is read back from it; a null one counts as empty."""
    return chats.mapInArrow(_digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def records(conversations: DataFrame) -> DataFrame:
    """conv_id, record: the rows of each conversation by turn as one JSON object, in a layout that can hold it.

    Two turns of user and assistant, or three with system first, take a layout of fields; the others, by
    hash of conv_id, one of the three lists. Null texts and roles are written as empty. Rows of the same
    turn sort by role and text. One conversation is one record, so its rows meet in one task.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    shape = F.array_join(F.transform("ts", lambda t: t["role"]), ",")
    pick = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    renamed = lambda names: lambda t: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), t["role"]), t["role"])

    def listed(outer, role, body, names=None):
        who = renamed(names) if names else lambda t: t["role"]
        turns = F.transform("ts", lambda t: F.struct(who(t).alias(role), t["text"].alias(body)))
        for name in reversed(outer.split(".")):
            turns = F.struct(turns.alias(name))
        return F.to_json(turns)

    clashes = F.exists("ts", lambda t: t["role"].isin("human", "gpt", "bot"))  # such roles don't survive renaming
    at = lambda i: F.col("ts")[i]["text"]
    record = (
        F.when((shape == "user,assistant") & (pick < 2), F.to_json(F.struct(at(0).alias("prompt"), at(1).alias("completion"))))
        .when((shape == "system,user,assistant") & (pick < 2), F.to_json(F.struct(at(0).alias("system"), at(1).alias("instruction"), at(2).alias("output"))))
        .when((pick == 1) & ~clashes, listed("conversations", "from", "value", {"user": "human", "assistant": "gpt"}))
        .when((pick == 2) & ~clashes, listed("data.dialog.turns", "speaker", "utterance", {"assistant": "bot"}))
        .otherwise(listed("messages", "role", "content"))
    )
    return whole.select("conv_id", record.alias("record"))
