"""Canonical JSON in the JVM: keys sorted, no spaces, ASCII only, numbers in their shortest form.

The form is the one that json.dumps(json.loads(text), sort_keys=True, separators=(",", ":")) has, so digests of
it are those that other makers of bundles have. All is Column functions; nothing leaves the JVM.

A text is checked by parse_json, cut into tokens by one pattern, and folded: brackets open and close frames, a
closed object sorts its members by key and becomes a value of the frame around it. A value is appended to its
frame by a copy, so an object of n members takes n squared steps of copying pointers: made for metadata, not
for documents.

Defined results: null stays null; a text that isn't JSON, or whose object names a key twice, raises an error, as
parse_json has it; keys are sorted by code points; whole numbers keep all their digits; the escape of half a
surrogate pair, which no text of Spark can hold, counts as a question mark. Where a JVM before version 19 ends 17
digits in a digit that isn't the nearest, that digit stays: three of 60,000 doubles of random bits and powers, all above 1e17.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that carry content: strings, brackets, and runs of anything else but blanks, colons and commas.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]]|[^\s{}\[\]:,"]+'
#: Characters with an escape of their own, by their code in UTF-16.
_NAMED = {"000a": "n", "000d": "r", "0009": "t", "0008": "b", "000c": "f"}
_FRAME = "struct<object:boolean,key:string,shown:string,items:array<struct<key:string,place:int,text:string>>>"


def bound(value: Column, body) -> Column:
    """body(value), with value worked out once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def json_string(c: Column) -> Column:
    """A text as a JSON string of printable ASCII; null stays null."""

    def escaped(run: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")
        for code, name in _NAMED.items():
            units = F.replace(units, F.lit(f"\\u{code}"), F.lit(f"\\{name}"))
        plain = F.replace(F.replace(run, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.when(run.rlike("^[ -~]"), plain).otherwise(units)

    odd = c.rlike(r'[^ -~]|["\\]')
    whole = F.array_join(F.transform(F.regexp_extract_all(c, F.lit("[ -~]+|[^ -~]+"), F.lit(0)), escaped), "")
    return F.concat(F.lit('"'), F.when(odd, whole).otherwise(c), F.lit('"'))


def json_float(c: Column) -> Column:
    """A double as the shortest digits that give it back, with an exponent below 1e-4 and from 1e16 on; null stays null.

    Digits come from the JVM, which may write one too many: digits rounded by one place, to the nearer or the other side, are taken if they still give the number.
    """

    def shortest(parts: Column) -> Column:
        """(digits without zeros around them, place of the first digit's power of ten)"""
        n, given = F.length(parts["digits"]), parts["digits"].cast("long")
        lower = given - given % 10
        near, far = F.when(given % 10 < 5, lower).otherwise(lower + 10), F.when(given % 10 < 5, lower + 10).otherwise(lower)
        gives = lambda digits: (digits > 0) & (F.concat(digits.cast("string"), F.lit("E"), (parts["power"] - n + 1).cast("string")).cast("double") == parts["size"])

        def taken(digits: Column) -> Column:
            text = digits.cast("string")
            return F.struct(F.regexp_replace(text, "0+$", "").alias("digits"), (parts["power"] + F.length(text) - n).alias("power"))

        return F.when((n > 1) & gives(near), taken(near)).when((n > 1) & gives(far), taken(far)).otherwise(F.struct(parts["digits"].alias("digits"), parts["power"].alias("power")))

    def shown(s: Column) -> Column:
        n, e = F.length(s["digits"]), s["power"]
        fixed = (
            F.when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), s["digits"]))
            .when(e >= n - 1, F.concat(s["digits"], F.repeat(F.lit("0"), e - n + 1), F.lit(".0")))
            .otherwise(F.concat(F.substring(s["digits"], F.lit(1), e + 1), F.lit("."), F.substring(s["digits"], e + 2, n)))
        )
        mantissa = F.when(n > 1, F.concat(F.left(s["digits"], F.lit(1)), F.lit("."), F.substring(s["digits"], F.lit(2), n))).otherwise(s["digits"])
        power = F.concat(F.when(e < 0, "e-").otherwise("e+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
        return F.when(e.between(-4, 15), fixed).otherwise(F.concat(mantissa, power))

    def taken_apart(text: Column) -> Column:
        head, tail = F.split_part(text, F.lit("E"), F.lit(1)), F.split_part(text, F.lit("E"), F.lit(2))
        left, right = F.split_part(head, F.lit("."), F.lit(1)), F.split_part(head, F.lit("."), F.lit(2))
        every = F.concat(left, right)
        bare = F.regexp_replace(every, "^0+", "")
        power = F.length(left) - 1 - (F.length(every) - F.length(bare)) + F.when(tail == "", 0).otherwise(tail).cast("int")
        return F.struct(F.regexp_replace(bare, "0+$", "").alias("digits"), power.alias("power"), text.cast("double").alias("size"))

    c = c.cast("double")
    sign = F.when(c.cast("string").startswith("-"), "-").otherwise("")
    size = bound(F.abs(c).cast("string"), lambda text: bound(taken_apart(text), lambda parts: bound(shortest(parts), shown)))
    return (
        F.when(F.isnan(c), "NaN").when(F.abs(c) == float("inf"), F.concat(sign, F.lit("Infinity")))
        .when(c == 0, F.concat(sign, F.lit("0.0"))).when(c.isNotNull(), F.concat(sign, size))
    )


def _folded(tokens: Column) -> Column:
    """Tokens (kind, key, text) folded to the text of their one value."""
    top = lambda stack: F.element_at(stack, -1)
    below = lambda stack: F.slice(stack, F.lit(1), F.size(stack) - 1)
    text = lambda: F.lit(None).cast("string")

    def frame(is_object, key, shown, items) -> Column:
        return F.struct(is_object.alias("object"), key.alias("key"), shown.alias("shown"), items.alias("items")).cast(_FRAME)

    def with_value(stack: Column, value: Column) -> Column:
        f = top(stack)
        item = F.struct(f["key"].alias("key"), F.size(f["items"]).alias("place"), F.concat(F.when(f["object"], F.concat(f["shown"], F.lit(":"))).otherwise(""), value).alias("text"))
        return F.concat(below(stack), F.array(frame(f["object"], text(), text(), F.concat(f["items"], F.array(item)))))

    def closed(f: Column) -> Column:
        members = F.array_join(F.transform(F.sort_array(f["items"]), lambda m: m["text"]), ",")
        return F.when(f["object"], F.concat(F.lit("{"), members, F.lit("}"))).otherwise(F.concat(F.lit("["), members, F.lit("]")))

    def step(stack: Column, token: Column) -> Column:
        kind, f = token["kind"], top(stack)
        none = F.array().cast("array<struct<key:string,place:int,text:string>>")
        opened = F.concat(stack, F.array(frame(kind == "{", text(), text(), none)))
        named = F.concat(below(stack), F.array(frame(f["object"], token["key"], token["text"], f["items"])))
        return (
            F.when(kind.isin("{", "["), opened).when(kind.isin("}", "]"), with_value(below(stack), closed(f)))
            .when(f["object"] & f["shown"].isNull(), named).otherwise(with_value(stack, token["text"]))
        )

    root = F.array(frame(F.lit(False), text(), text(), F.array().cast("array<struct<key:string,place:int,text:string>>")))
    return F.aggregate(tokens, root, step, lambda stack: F.element_at(top(stack)["items"], 1)["text"])


def canonical(c: Column) -> Column:
    """The canonical form of a JSON text."""

    def token(raw: Column) -> Column:
        first = F.left(raw, F.lit(1))
        key = F.when(first == '"', F.when(F.contains(raw, F.lit("\\")), F.parse_json(raw).cast("string")).otherwise(F.substring(raw, F.lit(2), F.length(raw) - 2)))
        number = F.when(raw == "-0", "0").when(raw.rlike("[.eE]"), json_float(raw.cast("double"))).otherwise(raw)
        return bound(key, lambda k: F.struct(
            first.alias("kind"), k.alias("key"),
            F.when(k.isNotNull(), json_string(k)).when(first.isin("{", "}", "[", "]", "t", "f", "n"), raw).otherwise(number).alias("text"),
        ))

    tokens = F.transform(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), token)
    return F.when(F.parse_json(c).isNotNull(), _folded(tokens))
