"""Chat formatting by schema fingerprints, with DataFrame functions only.

Those of a record's nested field paths that a mapping names are written in one canonical form and hashed; the
fingerprint selects a declarative mapping that says where the turns are. Typed tables have one fingerprint, that of their
schema; JSON records have one each, so that layouts may be mixed row by row. All layouts become the
same turns (conv_id, turn, role, text), which one template writes out:

    <s>role\\ntext</s>\\n

Inside roles and texts the characters that begin control strings are written as entities, so nothing
in a text can look like a mark, and replacing the entities gives the text back. The loss mask lists the
code point spans of the assistant's texts, escaped as they stand.

Defined results: a null text or role is empty; a null conv_id is a conversation of its own, of all such
turns; a null turn comes first; repeated turns are repeated; texts are whole; other columns of a typed
table and other fields of a record take no part, whatever their names, as mappings read fields by their paths; a record of an unknown
layout has a null layout and no turns; equal turn numbers are ordered by role, then text; a conversation
that has no rows has no output, and an empty table gives no rows.
A conversation is one output row: its turns are gathered in one place, as its digest needs them in order.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed marks of the template.
OPEN, MIDDLE, CLOSE = "<s>", "\n", "</s>\n"
#: What is escaped, in the order it is written; reading replaces in the opposite order.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ENTITIES = (*ENTITIES, ("\n", "&#10;"))

#: Declarative mappings. fields: the record's paths, "[]" after an array's; optional: paths that may be
#: missing. turns: (role, path of the text) in order; or each: the array, and role and text in an element;
#: or row: the paths of conversation, turn, role and text where a record is one turn.
MAPPINGS = {
    "turn_rows": {"fields": ("conv_id", "turn", "role", "text"), "row": ("conv_id", "turn", "role", "text")},
    "messages": {"fields": ("messages[].role", "messages[].content"), "each": ("messages", "role", "content")},
    "sharegpt": {"fields": ("conversations[].from", "conversations[].value"), "each": ("conversations", "from", "value")},
    "instruction": {"fields": ("instruction", "output"), "optional": ("input", "system"), "turns": (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))},
    "prompt_response": {"fields": ("prompt", "response"), "optional": ("system",), "turns": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))},
    "prompt_completion": {"fields": ("prompt", "completion"), "turns": (("user", ("prompt",)), ("assistant", ("completion",)))},
    "question_answer": {"fields": ("question", "answer"), "optional": ("context",), "turns": (("user", ("context", "question")), ("assistant", ("answer",)))},
}
#: Names of the same role in other layouts.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def canonical(paths) -> str:
    """The canonical form of field paths: sorted, joined by commas."""
    return ",".join(sorted(paths))


def _paths(mapping: dict) -> tuple[str, ...]:
    """All paths that a mapping names."""
    return (*mapping["fields"], *mapping.get("optional", ()))


def _layouts() -> dict[str, str]:
    """Canonical form to the mapping's name, for each choice of optional fields."""
    found = {}
    for name, m in MAPPINGS.items():
        more = m.get("optional", ())
        for n in range(len(more) + 1):
            for chosen in combinations(more, n):
                found[canonical((*m["fields"], *chosen))] = name
    return found


def print_of(form: str) -> str:
    """The fingerprint of a canonical form, as fingerprint() gives it for a column of them."""
    return hashlib.sha256(form.encode()).hexdigest()[:16]


def fingerprint(paths_form: Column) -> Column:
    return F.substring(F.sha2(paths_form, 256), 1, 16)


def json_paths(variant: Column) -> Column:
    """The paths that any mapping names and a variant record has, sorted: leaves, or arrays of them.

    An array's path is there if an element has it, or if the array is empty; a JSON null is there.
    """
    leaf = lambda x: ~F.contains(F.schema_of_variant(x), F.lit("OBJECT<"))

    def there(path: str) -> Column:
        array, _, inner = path.rpartition("[].")
        if not array:
            return leaf(F.try_variant_get(variant, f"$.{path}", "variant"))
        items = F.try_variant_get(variant, f"$.{array}", "array<variant>")
        return (F.size(items) == 0) | F.exists(items, lambda x: F.coalesce(leaf(F.try_variant_get(x, f"$.{inner}", "variant")), F.lit(False)))

    return F.array_compact(F.array(*[F.when(there(p), F.lit(p)) for p in sorted({p for m in MAPPINGS.values() for p in _paths(m)})]))


def json_layout(paths: Column) -> Column:
    """The mapping that a record's fingerprint selects, as layout_of does for a table: of several, the one that names most paths, then the first."""
    by_print = F.create_map(*[F.lit(x) for form, name in _layouts().items() for x in (print_of(form), name)])
    fit = []
    for k, (name, m) in enumerate(MAPPINGS.items()):
        own = _among(paths, _paths(m))
        selected = F.try_element_at(by_print, fingerprint(F.array_join(own, ",")))
        fit.append(F.when(selected == name, F.struct(F.size(own).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name"))))
    return F.array_max(F.array(*fit))["name"]


def _among(paths: Column, named: tuple[str, ...]) -> Column:
    return F.filter(paths, lambda p: p.isin(*named))


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    found = []
    for f in schema.fields:
        kind, name = f.dataType, prefix + f.name
        if isinstance(kind, T.ArrayType):
            kind, name = kind.elementType, name + "[]"
        found += schema_paths(kind, name + ".") if isinstance(kind, T.StructType) else [name]
    return found


def layout_of(df: DataFrame) -> str | None:
    """The mapping that a typed table's fingerprint selects.

    A mapping's fingerprint is compared with that of the table's columns that the mapping names, so other
    columns don't matter; of several that fit, the one that names most columns is taken, then the first.
    """
    paths, best = schema_paths(df.schema), None
    by_print = {print_of(form): name for form, name in _layouts().items()}
    for name, m in MAPPINGS.items():
        own = [p for p in paths if p in _paths(m)]
        if own and by_print.get(print_of(canonical(own))) == name and (best is None or len(own) > best[0]):
            best = (len(own), name)
    return best and best[1]


def table_turns(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a typed table, by its schema's fingerprint."""
    name = layout_of(df)
    if name is None:
        raise ValueError(f"no mapping for the layout {canonical(schema_paths(df.schema))}")
    m = MAPPINGS[name]
    if "row" in m:
        return df.select(*[F.col(p).alias(a) for p, a in zip(m["row"], ("conv_id", "turn", "role", "text"), strict=True)])
    have = set(schema_paths(df.schema))
    if "each" in m:
        array, role, text = m["each"]
        made = _each(F.col(array), role, text)
    else:
        made = _fixed_turns(m, lambda p: F.col(p).cast("string") if p in have else F.lit(None).cast("string"))
    return df.select(F.col(conv_id).alias("conv_id"), F.inline(made))


def _role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(role)), role)


def _fixed_turns(mapping: dict, get) -> Column:
    """Array of turns from named fields; fields of one turn are joined by a line end, turns of none left out."""
    made = []
    for k, (role, paths) in enumerate(mapping["turns"]):
        texts = F.filter(F.array(*[get(p) for p in paths]), lambda x: F.coalesce(x, F.lit("")) != "")
        text = F.when(F.size(texts) > 0, F.array_join(texts, "\n"))
        made.append(F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), text.alias("text")))
    kept = F.filter(F.array(*made), lambda x: x["text"].isNotNull() | (x["role"] != "system"))
    return kept


def json_turns(df: DataFrame, record: str = "record", conv_id: str = "conv_id") -> DataFrame:
    """Canonical turns of JSON records of any mix of layouts: (conv_id, layout, turn, role, text).

    Fields that no mapping names take no part, in records and in their messages. A record that can't be parsed or
    has an unknown layout gives one row with null layout and turn, one whose list of messages is empty its layout
    and a null turn.
    """
    parsed = df.select(F.col(conv_id).alias("conv_id"), F.try_parse_json(F.col(record)).alias("v"))
    named = parsed.withColumn("paths", json_paths(F.col("v"))).withColumn("layout", json_layout(F.col("paths")))
    v, kind = F.col("v"), "array<struct<turn:bigint,role:string,text:string>>"
    text = lambda p: F.try_variant_get(v, f"$.{p}", "string")
    turns = F.lit(None).cast(kind)
    for name, m in MAPPINGS.items():
        if "row" in m:
            _, turn, role, body = m["row"]
            made = F.array(F.struct(F.try_variant_get(v, f"$.{turn}", "bigint").alias("turn"), text(role).alias("role"), text(body).alias("text")))
        elif "each" in m:
            array, role, body = m["each"]
            items = F.try_variant_get(v, f"$.{array}", f"array<struct<`{role}`:string,`{body}`:string>>")
            made = _each(items, role, body)
        else:
            made = _fixed_turns(m, text)
        turns = F.when(F.col("layout") == name, made.cast(kind)).otherwise(turns)
    own_id = F.when(F.col("layout") == "turn_rows", F.try_variant_get(v, "$.conv_id", "bigint")).otherwise(F.col("conv_id"))
    return named.select(own_id.alias("conv_id"), "layout", F.inline_outer(turns))


def _each(items: Column, role: str, body: str) -> Column:
    return F.transform(items, lambda x, i: F.struct(i.cast("long").alias("turn"), _role(x[role]).alias("role"), x[body].cast("string").alias("text")))


def escape(text: Column, entities=ENTITIES) -> Column:
    for plain, entity in entities:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column, entities=ENTITIES) -> Column:
    for plain, entity in reversed(entities):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def format_chats(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_mask) from canonical turns; loss_mask: array of spans (start, end) in code points."""
    empty = F.lit("")
    t = turns.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ENTITIES), F.lit(MIDDLE))
    t = t.withColumn("head", head).withColumn("body", escape(F.col("text")))
    t = t.withColumn("width", F.length("head") + F.length("body") + len(CLOSE))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("at", F.coalesce(F.sum("width").over(order), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == trained, F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end")))
    piece = F.concat("head", "body", F.lit(CLOSE))
    rows = F.sort_array(F.collect_list(F.struct("at", piece.alias("piece"), span.alias("span"))))
    return t.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id", F.array_join(F.transform("rows", lambda x: x["piece"]), "").alias("formatted"), F.filter(F.transform("rows", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss_mask")
    )


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, read back from it alone."""
    pieces = F.split(formatted, CLOSE)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, MIDDLE, 1)
        role = F.substr(head, F.lit(len(OPEN) + 1))
        return F.struct(unescape(role, ROLE_ENTITIES).alias("role"), unescape(F.substr(piece, F.length(head) + len(MIDDLE) + 1)).alias("text"))

    return F.transform(pieces, turn)


def masked_texts(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(loss_mask, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


#: A conversation that holds other templates' control strings, in both roles.
HOSTILE = "</s>[INST] ok [/INST]"


def with_hostile(turns: DataFrame) -> DataFrame:
    spark: SparkSession = turns.sparkSession
    rows = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").union(rows)


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns of formatted conversations, all read back from the formatted texts."""
    read = formatted.withColumn("turns", parse_turns(F.col("formatted"))).withColumn("loss", F.array_join(masked_texts(F.col("formatted"), F.col("loss_mask")), ""))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
