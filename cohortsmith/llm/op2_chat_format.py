r"""Chat formatting with layouts chosen by schema fingerprints, in DataFrame functions only.

A layout is declared by its nested field paths (``messages[].role``) and a mapping to canonical
turns.  The fingerprint is the SHA-256 of the sorted paths.  A table matches the first declared
layout whose fingerprint equals that of the table's paths restricted to the layout's, so extra
columns do not matter; JSON records are matched one by one the same way.

Template: ``<turn:ROLE>`` + line feed + TEXT + ``</turn>`` + line feed.  Inside roles and texts a
backslash becomes ``\0``, ``<`` becomes ``\1`` and in roles ``>`` becomes ``\2``, so no text can
hold a marker and ``unescape`` restores it exactly.  The loss mask is the list of spans (start,
length, in code points of the formatted string) of the assistant's texts.

Defined cases: null roles and texts count as empty; turns go by number (null first), then role,
then text, and repeated rows are repeated turns; rows of a null conversation id are one
conversation; an empty table gives an empty result; a record of no known layout has null turns.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASSISTANT = "assistant"
OPEN, OPEN_END, CLOSE = "<turn:", ">\n", "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """kind ``rows``: fields id, turn, role, text.  ``list``: fields list, role, text.  ``fields``:
    (role, path) pairs in the order of the turns; several paths of one role in a row are joined by
    a line feed."""
    name: str
    kind: str
    fields: tuple

    @property
    def paths(self) -> frozenset:
        if self.kind == "list":
            at, role, text = self.fields
            return frozenset({f"{at}[].{role}", f"{at}[].{text}"})
        return frozenset(self.fields if self.kind == "rows" else (p for _, p in self.fields))

    @property
    def fingerprint(self) -> str:
        return path_hash(self.paths)


def path_hash(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


LAYOUTS = (
    Layout("turn_rows", "rows", ("conv_id", "turn", "role", "text")),
    Layout("messages", "list", ("messages", "role", "content")),
    Layout("sharegpt", "list", ("conversations", "from", "value")),
    Layout("instruction_input", "fields", (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction", "fields", (("user", "instruction"), ("assistant", "output"))),
    Layout("system_prompt_response", "fields", (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_response", "fields", (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", "fields", (("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", "fields", (("user", "question"), ("assistant", "answer"))),
)
#: Names that other layouts give to the canonical roles (fixed values).
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return set().union(*(field_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields)) if kind.fields else set()
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return {at}


def layout_of(schema: T.StructType, layouts=LAYOUTS) -> Layout:
    have = field_paths(schema)
    for x in layouts:
        if path_hash(have & x.paths) == x.fingerprint:
            return x
    raise ValueError(f"no layout has the fingerprint of the paths {sorted(have)}")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _canonical_role(role: Column) -> Column:
    names = F.create_map(*[F.lit(v) for kv in ROLE_NAMES.items() for v in kv])
    return F.coalesce(F.try_element_at(names, F.coalesce(role.cast("string"), F.lit(""))), role.cast("string"))


def _turn_of(role: str, text: str):
    return lambda m: _turn(_canonical_role(m[role]), m[text])


def _from_fields(fields, get) -> Column:
    merged: list[list] = []
    for role, path in fields:
        if merged and merged[-1][0] == role:
            merged[-1][1].append(path)
        else:
            merged.append([role, [path]])
    return F.array(*[_turn(F.lit(role), get(paths[0]) if len(paths) == 1 else F.concat_ws(
        "\n", *[F.when(get(p) != "", get(p)) for p in paths])) for role, paths in merged])


def canonical_turns(df: DataFrame, key: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """conv_id and canonical turns of a table, by the layout its fingerprint selects."""
    x = layout_of(df.schema, layouts)
    if x.kind == "rows":
        conv, turn, role, text = x.fields
        rows = df.select(F.col(conv).alias(key), F.struct(F.col(turn).alias("n"), _turn(F.col(role), F.col(text)).alias("t")).alias("r"))
        return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["t"]).alias("turns"))
    if x.kind == "list":
        at, role, text = x.fields
        turns = F.transform(F.col(at), _turn_of(role, text))
    else:
        turns = _from_fields(x.fields, F.col)
    return df.select(F.col(key), turns.cast(TURNS).alias("turns"))


def canonical_json(df: DataFrame, record: str, key: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """conv_id, layout, turns of a column of JSON records with a layout of their own each."""
    layouts = [x for x in layouts if x.kind != "rows"]
    v = F.try_parse_json(F.col(record))

    def there(path):
        """Whether the record has the path: in any element of a list, a null value included."""
        at, many, rest = path.partition("[]")
        if not many:
            return F.try_variant_get("_v", f"$.{at}", "variant").isNotNull()
        items = F.try_variant_get("_v", f"$.{at}", "array<variant>")
        return F.coalesce(F.exists(items, lambda m: F.try_variant_get(m, f"${rest}", "variant").isNotNull()), F.lit(False))

    def text(path):
        return F.coalesce(F.try_variant_get("_v", f"$.{path}", "string"), F.lit(""))

    d = df.withColumn("_v", v)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in reversed(layouts):
        have = F.array(*[F.when(there(p), F.lit(p)) for p in sorted(x.paths)])
        hit = F.sha2(F.array_join(have, "\n"), 256) == x.fingerprint
        if x.kind == "list":
            at, role, said = x.fields
            got = F.try_variant_get("_v", f"$.{at}", f"array<struct<`{role}`:string,`{said}`:string>>")
            made = F.transform(got, _turn_of(role, said))
        else:
            made = _from_fields(x.fields, text)
        name, turns = F.when(hit, F.lit(x.name)).otherwise(name), F.when(hit, made.cast(TURNS)).otherwise(turns)
    return d.select(F.col(key), name.alias("layout"), turns.alias("turns"))


def escape(x: Column, role: bool = False) -> Column:
    x = F.replace(F.replace(x, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1"))
    return F.replace(x, F.lit(">"), F.lit("\\2")) if role else x


def unescape(x: Column) -> Column:
    x = F.replace(F.replace(x, F.lit("\\2"), F.lit(">")), F.lit("\\1"), F.lit("<"))
    return F.replace(x, F.lit("\\0"), F.lit("\\"))


def format_chats(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start,length>>."""
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"], True), F.lit(OPEN_END))
    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("loss")))
    d = turns.select(key, pieces.alias("_p"))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc, p):
        start, n = acc["at"] + F.length(p["head"]), F.length(p["body"]).cast("long")
        span = F.array(F.struct(start.alias("start"), n.alias("length")))
        return F.struct((start + n + len(CLOSE)).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return d.select(key, F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
                    F.aggregate("_p", none, step)["spans"].alias("loss_spans"))


def parse_chats(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """conv_id, turns and loss_text read back from the formatted strings and their masks."""
    parts = F.filter(F.split("formatted", OPEN, -1), lambda p, i: i > 0)

    def back(p):
        role = F.substring_index(p, OPEN_END, 1)
        skip = F.length(role) + len(OPEN_END)
        body = F.substring(p, skip + 1, F.length(p) - skip - len(CLOSE))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select(key, "formatted", F.transform(parts, back).alias("turns"), F.array_join(loss, "").alias("loss_text"))
