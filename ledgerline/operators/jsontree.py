"""J1, V4 for bodies of any shape: arrays of numbers, enums, objects and arrays,
mapping errors, and the first failure in the order of the document.

:func:`decode` reads the declared tree level by level from a VARIANT. Values
follow the rules of ``jsonio``; here also an array may hold any kind, and a
single value or object where an array is declared becomes a one-element array.

Each payload gets one reject (V4):

* ``wrong_type``, ``missing_field`` and ``unreadable`` as in ``jsonio``;
* ``mapping_error``, with the path and why: a JSON number outside the range of
  the declared int, long or decimal, or, with ``duplicate_keys="reject"``, a key
  that one object holds twice.

Which one: the first in the order in which the document has them, as a parser
that stops at the first failure reports it; fields that are missing come after
all that are there, in declared order. VARIANT sorts its keys, so the order is
taken from the raw text. The first pass reads the VARIANT alone and marks
payloads in which one object has several failures; only these are read again
beside their text. A path segment of an array element prints as ``?``.

Everything is built-in expressions; nested levels are bound once by one-element
``transform``s, so no level is evaluated twice in a pass. Objects and arrays are
told by a cast of one level: a variant's schema is derived from all that lies
below, so it is asked for scalars only, once each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.jsonio import MAPPING_ERROR, UNREADABLE, UNREADABLE_MESSAGE, Field, _fence, _missing, _reject, _wrong_type

NUMBERS = ("int", "long", "double", "decimal")
REJECT = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "path", "message")])


def _let(x: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``x``, which is evaluated once."""
    return F.transform(F.array(x), body)[0]


def _first(rejects: list[Column]) -> Column:
    return F.coalesce(*rejects, F.lit(None).cast(REJECT))


def _out(value: Column, reject: Column, late: Column, several: Column | None = None) -> Column:
    """A level's result: ``late`` is its failure if it is a required field that
    is not there; ``several``: an object in it has more than one failure."""
    return F.struct(value.alias("value"), reject.cast(REJECT).alias("reject"), late.cast(REJECT).alias("late"),
                    (F.lit(False) if several is None else several).alias("several"))


def _category(v: Column) -> Column:
    """As in ``jsonio``, with the schema asked once."""
    return _let(F.schema_of_variant(v), lambda t: F.when(t.isNull(), "missing").when(t == "STRING", "string").when(t == "VOID", "null")
                .when(t == "BOOLEAN", "boolean").when(t.startswith("ARRAY"), "array").when(t.startswith("OBJECT"), "object").otherwise("number"))


def _level(v: Column, kind: str, inner: Column) -> Column:
    """The category of ``v``, which is a ``kind`` where its cast ``inner`` is not null."""
    return F.when(v.isNull(), "missing").when(inner.isNotNull(), kind).otherwise(_category(v))


def _scalar(v: Column, f: Field, path: str) -> Column:
    """What a good value needs is read first; the rest is evaluated for the others only."""
    text = F.try_variant_get(v, "$", "string")

    def body(s: Column) -> Column:
        t, num = s["type"], s["num"]
        late = F.when(v.isNull(), _missing(path)) if f.required else F.lit(None)
        is_string, is_null = t == "STRING", t == "VOID"
        is_nested = t.startswith("ARRAY") | t.startswith("OBJECT")
        if f.kind == "string":
            shape = is_nested | is_null if f.required else is_nested
            return _out(F.when(~is_nested & ~is_null, num), F.when(shape, _missing(path)), late)
        if f.kind == "enum":
            known = is_string & num.isin(*f.values)
            is_number = ~(is_string | is_null | (t == "BOOLEAN") | is_nested)
            index = F.when(is_number, F.try_variant_get(v, "$", "int"))  # of a text it would cost an exception inside Spark
            in_range = F.coalesce(index.between(0, len(f.values) - 1), F.lit(False))
            value = F.when(known, num).when(in_range, F.try_element_at(F.array(*[F.lit(x) for x in f.values]), index + 1))
            empty = is_string & (num == "")
            shape = (t == "BOOLEAN") | is_nested | (is_null | empty if f.required else F.lit(False))
            bad = _first([F.when((is_string & ~empty) | (is_number & ~in_range), _wrong_type(path, num, f)), F.when(shape, _missing(path))])
            return _out(value, F.when(known, F.lit(None)).otherwise(bad), late)
        if f.kind == "boolean":
            num, shape = F.when(~is_string | text.isin("true", "false"), num), is_nested
        else:
            num, shape = F.when(t != "BOOLEAN", num), is_nested | (t == "BOOLEAN")
        shape = shape | is_null if f.required else shape
        is_other = is_string | (t == "BOOLEAN") if f.kind == "boolean" else is_string
        detail = F.format_string(f"Field '{path}': the number %s is out of the range of {f.type_name}.", text)
        bad = _first([F.when(shape, _missing(path)), F.when(is_other, _wrong_type(path, text, f)), F.when(
            ~is_null, _reject(MAPPING_ERROR, path, detail) if f.kind in NUMBERS else _wrong_type(path, text, f))])
        return _out(num, F.when(num.isNotNull(), F.lit(None)).otherwise(bad), late)

    kind = "string" if f.kind in ("string", "enum") else f.sql_type
    return _let(F.struct(F.schema_of_variant(v).alias("type"), F.try_variant_get(v, "$", kind).alias("num")), body)


def _object(v: Column, text: Column | None, f: Field, path: str, duplicates: bool) -> Column:
    prefix = f"{path}." if path else ""

    def finish(r: Column) -> Column:
        cat = r["cat"]
        is_obj = cat == "object"
        names = [c.name for c in f.fields]
        value = F.when(is_obj, F.struct(*[r[n]["value"].alias(n) for n in names]))
        several = F.lit(False)
        if text is None:
            in_order = _first([r[n]["reject"] for n in names])
            several = F.size(F.array_compact(F.array(*[r[n]["reject"] for n in names]))) > 1
            for c in f.fields:
                several = several | r[c.name]["several"] if _has_objects(c) else several
        else:
            found = F.filter(F.array(*[F.struct(F.lit(n).alias("name"), r[n]["reject"].alias("reject")) for n in names]),
                             lambda x: x["reject"].isNotNull())
            keys = F.json_object_keys(text)

            def placed(x: Column) -> Column:  # the last of equal keys is the one that counts
                return F.struct((F.size(keys) - F.array_position(F.reverse(keys), x["name"])).alias("at"), x["reject"].alias("reject"))

            in_order = _let(found, lambda some: F.when(F.size(some) > 1, F.array_min(F.transform(some, placed))["reject"]).otherwise(
                F.try_element_at(some, F.lit(1))["reject"]))
        rejects = [F.when(is_obj, in_order), *[F.when(is_obj, r[n]["late"]) for n in names]]
        if duplicates:
            def twice(k: Column) -> Column:
                return F.filter(k, lambda x: F.size(F.filter(k, lambda y: y == x)) > 1)

            key = F.try_element_at(twice(keys), F.lit(1))
            message = F.format_string(f"Object '{path}': the key '%s' occurs more than once.", key)
            rejects.insert(0, F.when(is_obj & (F.size(keys) > F.size(F.array_distinct(keys))), _reject(MAPPING_ERROR, path, message)))
        blank = F.try_variant_get(v, "$", "string") == ""
        empty = (cat == "string") & blank
        shape = cat.isin(["array", "boolean", "number"] + ["null"] * f.required) | ((cat == "string") & ~blank)
        shape = shape | empty if f.required else shape
        late = F.when(cat == "missing", _missing(path)) if f.required else F.lit(None)
        return _out(value, _first([*rejects, F.when(shape, _missing(path))]), late, is_obj & several)

    def children(s: Column) -> Column:
        results = [_value(s[c.name], None if text is None else F.get_json_object(text, f"$.{c.name}"), c, prefix + c.name, duplicates).alias(c.name)
                   for c in f.fields]
        return _let(F.struct(_level(v, "object", s).alias("cat"), *results), finish)

    quoted = [c.name.replace("`", "``") for c in f.fields]
    return _let(F.try_variant_get(v, "$", "struct<" + ", ".join(f"`{n}`: variant" for n in quoted) + ">"), children)


def _has_objects(f: Field) -> bool:
    return f.kind == "object" or (f.kind == "array" and _has_objects(f.items))


def _array(v: Column, text: Column | None, f: Field, path: str, duplicates: bool) -> Column:
    item = f.items

    def body(s: Column) -> Column:
        cat = s["cat"]
        many = cat == "array"
        single = cat.isin("string", "number", "boolean", "object")
        elements = F.when(many, s["items"]).when(single, F.array(v))
        if text is not None and _has_objects(item):  # the elements' raw texts, for the order of keys in them
            texts = F.when(many, F.from_json(text, "array<string>")).when(single, F.array(text))
            results = F.zip_with(elements, texts, lambda e, t: _value(e, t, item, f"{path}.?", duplicates))
        else:
            results = F.transform(elements, lambda e: _value(e, None, item, f"{path}.?", duplicates))

        def finish(r: Column) -> Column:
            bad = F.filter(r, lambda x: x["reject"].isNotNull() | x["late"].isNotNull())
            first = F.try_element_at(bad, F.lit(1))
            shape = F.when(cat == "null", _missing(path)) if f.required else F.lit(None)
            late = F.when(cat == "missing", _missing(path)) if f.required else F.lit(None)
            several = F.coalesce(F.exists(r, lambda x: x["several"]), F.lit(False)) if _has_objects(item) else None
            return _out(r["value"], _first([F.coalesce(first["reject"], first["late"]), shape.cast(REJECT)]), late, several)

        return _let(results, finish)

    return _let(F.try_variant_get(v, "$", "array<variant>"), lambda a: _let(F.struct(_level(v, "array", a).alias("cat"), a.alias("items")), body))


def _value(v: Column, text: Column | None, f: Field, path: str, duplicates: bool) -> Column:
    if f.kind == "object":
        return _object(v, text, f, path, duplicates)
    if f.kind == "array":
        return _array(v, text, f, path, duplicates)
    if f.kind == "string_array":
        return _array(v, text, Field(f.name, "array", f.required, items=Field("", "string")), path, duplicates)
    return _scalar(v, f, path)


def _check(f: Field) -> None:
    if "." in f.name or "'" in f.name:
        raise ValueError(f"field name {f.name!r} holds a dot or a quote, which paths use")
    if f.kind == "array" and f.items is None:
        raise ValueError(f"array {f.name!r} has no items")
    for c in (*f.fields, *([f.items] if f.items else [])):
        _check(c)


def decode(df: DataFrame, payload: str, schema: tuple[Field, ...], duplicate_keys: str = "last") -> DataFrame:
    """J1 + V4: add ``body``, a struct of the declared fields (null unless
    accepted), ``accepted`` and ``reject`` (kind, path, message)."""
    if duplicate_keys not in ("last", "reject"):
        raise ValueError("duplicate_keys must be 'last' or 'reject'")
    root = Field("", "object", required=True, fields=tuple(schema))
    _check(root)
    conf, key = df.sparkSession.conf, "spark.sql.variant.allowDuplicateKeys"
    before = conf.get(key)
    conf.set(key, "true")  # a repeated key is reported here, with its place
    try:
        parsed = df.withColumn("_v", F.try_parse_json(F.col(payload)))
        parsed.schema  # analysed here at the latest
    finally:
        conf.set(key, before)
    v, duplicates = F.col("_v"), duplicate_keys == "reject"
    beside_text = _value(v, F.col(payload), root, "", duplicates)
    out = parsed.withColumn("_r", beside_text if duplicates else _value(v, None, root, "", False))
    unreadable = _reject(UNREADABLE, "", F.lit(UNREADABLE_MESSAGE)).cast(REJECT)
    reject = F.when(v.isNull(), unreadable)
    if not duplicates:
        reject = reject.when(F.col("_r.several"), _let(beside_text, lambda r: F.coalesce(r["reject"], r["late"])))
    out = out.withColumn("reject", reject.otherwise(F.coalesce("_r.reject", "_r.late")))
    accepted = F.col("reject").isNull()
    # Fenced: a filter on the result would else be evaluated as a copy of the whole decode, below any repartition.
    return _fence(out.withColumn("body", F.when(accepted, F.col("_r.value"))).withColumn("accepted", accepted).drop("_v", "_r"))


def rejects(decoded: DataFrame) -> DataFrame:
    """V4: only the rejected rows, flattened, typed BAD_REQUEST."""
    r = F.col("reject")
    return decoded.drop("body").where(~F.col("accepted")).withColumns({
        "reject_kind": r["kind"], "reject_path": r["path"], "message": r["message"], "error_type": F.lit("BAD_REQUEST")}).drop("reject")
