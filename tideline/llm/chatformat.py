"""Chat formatting: heterogeneous records to canonical turns, turns to one marked text, and back."""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm._native import replace_columns

#: The marks of the template: before a role, before a text, before a text under the loss mask, after a text.
TURN, TEXT, LOSS, END = "<|turn|>", "<|text|>", "<|loss|>", "<|end|>"
# Control strings of public chat templates, which texts must not forge either.
CONTROLS = (TURN, TEXT, LOSS, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
ESCAPE = "␛"
#: What stands for each of them in a text: the escape character and a letter of its own.
ESCAPED = [(ESCAPE, f"{ESCAPE}0"), *((c, ESCAPE + chr(ord("a") + i)) for i, c in enumerate(CONTROLS))]
TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def escape(text: Column) -> Column:
    """The text with every control string and escape character replaced; unescape() gives it back."""
    for plain, coded in ESCAPED:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPED):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_turns(turns: Column, loss_role: str = "assistant") -> Column:
    """One text of an array of (role, text). Nulls count as empty."""

    def one(t: Column) -> Column:
        role, text = F.coalesce(t["role"], F.lit("")), F.coalesce(t["text"], F.lit(""))
        return F.concat(F.lit(TURN), escape(role), F.when(role == loss_role, LOSS).otherwise(TEXT), escape(text), F.lit(END))

    return F.array_join(F.transform(turns, one), "")


def parse_turns(formatted: Column) -> Column:
    """The (role, text, loss) of a formatted text, in order. Escaped texts hold no mark, so that marks can be split at."""

    def one(part: Column) -> Column:
        loss = F.contains(part, F.lit(LOSS))
        halves = F.split(F.replace(part, F.lit(LOSS), F.lit(TEXT)), r"<\|text\|>", 2)
        return F.struct(unescape(F.get(halves, F.lit(0))).alias("role"), unescape(F.replace(F.get(halves, F.lit(1)), F.lit(END))).alias("text"), loss.alias("loss"))

    parts = F.split(formatted, r"<\|turn\|>")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), one)


@dataclass(frozen=True)
class Mapping:
    """How records that hold just these field paths, or some of them and null in the others, become turns.

    paths: the leaves that aren't null, by name, an array's elements as []. turns: (role, path) of scalar fields in
    order, or, with `each`, the path of an array of structs whose fields `role` and `text` are the turns. A role that
    begins with "=" is a constant; rename translates roles.
    """

    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    rename: tuple[tuple[str, str], ...] = ()

    def fingerprints(self) -> dict[str, int]:
        """Of records that hold some of the fields, the others being null: each with the number of those that lack."""
        n = len(self.paths)
        return {fingerprint_of(some): n - k for k in range(n, 0, -1) for some in itertools.combinations(self.paths, k)}


def fingerprint_of(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


SHARED_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
MAPPINGS = (
    Mapping(("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Mapping(("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping(("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    Mapping(("system", "prompt", "response"), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping(("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping(("instruction", "input", "output"), (("user", "instruction\ninput"), ("assistant", "output"))),
    Mapping(("messages[].role", "messages[].content"), each="messages", role="role", text="content", rename=SHARED_ROLES),
    Mapping(("messages[].role", "messages[].text"), each="messages", role="role", text="text"),
    Mapping(("conversations[].from", "conversations[].value"), each="conversations", role="from", text="value", rename=SHARED_ROLES),
)


def _leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, top-level path) of every leaf: below an array of structs, the path names the field and the array."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, f"{path}.")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out += [(f"{path}[].{x.name}", path) for x in f.dataType.elementType.fields]
        else:
            out.append((path, path))
    return out


def _has(leaf: str):
    return lambda x: x[leaf].isNotNull()


def _message(m: Mapping):
    """Of an element of the array of a mapping, the canonical turn."""
    names = F.create_map(*(F.lit(x) for pair in m.rename for x in pair)) if m.rename else None

    def one(x: Column) -> Column:
        role = x[m.role] if names is None else F.coalesce(F.element_at(names, x[m.role]), x[m.role])
        return F.struct(role.alias("role"), F.coalesce(x[m.text], F.lit("")).alias("text"))

    return one


def fingerprint(records: DataFrame, ignore: tuple[str, ...] = ()) -> Column:
    """The hash of the sorted paths of a record's fields that aren't null. An array of structs counts with the fields that some element has."""
    present = []
    for path, top in sorted(_leaves(records.schema)):
        if path in ignore:
            continue
        if "[]" in path:
            leaf = path.rpartition(".")[2]
            there = F.exists(F.col(top), _has(leaf))
        else:
            there = F.col(top).isNotNull()
        present.append(F.when(there, F.lit(path)))
    return F.sha2(F.array_join(F.array_compact(F.array(*present)), "\n"), 256)


def canonical_turns(records: DataFrame, ignore: tuple[str, ...] = (), mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Returns the records with `layout`, the fingerprint of each, and `turns`, its canonical (role, text) turns.

    Each record is read by the mapping of its own fingerprint. Where a field of a layout is null its path is not in the
    fingerprint; the record is of the mapping that lacks the fewest paths so, the first of several, and a null text is
    an empty one. All fields of a mapping must be in the schema. A record of an unknown layout, or with nothing but
    nulls, keeps its fingerprint and has null turns: nothing is guessed. A very long text is one turn. Empty tables
    stay empty; repeated rows get the same results; columns in `ignore` (ids, metadata) take no part in the
    fingerprint. Input columns named as the results are replaced.
    """
    ignore = (*ignore, *(c for c in records.columns if c.startswith("__")))
    leaves = {p for p, _ in _leaves(records.schema)}
    usable = [m for m in mappings if set(m.paths) <= leaves]
    chosen: dict[str, tuple[int, int]] = {}
    for i, m in enumerate(usable):
        for print_, lacking in m.fingerprints().items():
            chosen[print_] = min(chosen.get(print_, (lacking, i)), (lacking, i))
    turns = F.lit(None).cast(TURNS)
    for i, m in enumerate(usable):
        if m.each:
            value = F.transform(F.col(m.each), _message(m))
        else:
            value = F.array(*(F.struct(F.lit(role).alias("role"), F.array_join(F.array(*(F.col(p) for p in path.split("\n"))), "\n").alias("text")) for role, path in m.turns))
        mine = sorted(f for f, (_, k) in chosen.items() if k == i)
        turns = F.when(F.col("__layout").isin(mine), value.cast(TURNS)).otherwise(turns)
    out = records.withColumn("__layout", fingerprint(records, ignore))
    return replace_columns(out, {"layout": F.col("__layout"), "turns": turns})


def format_chats(records: DataFrame, ignore: tuple[str, ...] = (), mappings: tuple[Mapping, ...] = MAPPINGS, loss_role: str = "assistant") -> DataFrame:
    """canonical_turns() with `formatted`, the turns as one text; null where the layout is unknown. All else as there."""
    out = canonical_turns(records, ignore, mappings)
    return replace_columns(out, {"formatted": format_turns(F.col("turns"), loss_role)})


def conversations_as_records(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id_col, messages): rows of one turn each as records of the messages layout, ordered by turn, then role and text.

    Null roles and texts become empty ones, so that they keep their place; null turns come first; repeated rows are
    turns of their own. A conversation is one record and so must fit in a task, as its formatted text must.
    """
    message = F.struct(F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    grouped = rows.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col(turn_col).isNotNull().alias("known"), F.coalesce(F.col(turn_col), F.lit(0)).alias("turn"), message.alias("m")))).alias("t"))
    return grouped.select(id_col, F.transform("t", lambda x: x["m"]).alias("messages"))


def delivered(records: DataFrame) -> DataFrame:
    """Records of messages (role, text) in the layouts in which different sources deliver chats; each has its own fields, others are null.

    A question and its answer are prompt and response, with a system turn before them system too; chats between those
    roles that begin with the assistant are conversations of from and value; all others stay messages.
    """
    roles = F.transform("messages", lambda m: m["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    triple = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    plain = (F.get(roles, F.lit(0)) == "assistant") & F.forall(roles, lambda r: r.isin("system", "user", "assistant"))

    def text(at: int) -> Column:
        return F.get("messages", F.lit(at))["text"]

    return records.select(
        *(f"`{c}`" for c in records.columns if c != "messages"),
        F.when(triple, text(0)).alias("system"),
        F.when(pair, text(0)).when(triple, text(1)).alias("prompt"),
        F.when(pair, text(1)).when(triple, text(2)).alias("response"),
        F.when(plain, F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["text"].alias("value")))).alias("conversations"),
        F.when(~(pair | triple | plain), F.col("messages")).alias("messages"),
    )
