"""J1, V4, J2: strict JSON decoding with classified rejects, and encoding.

Decoding parses each payload once into a VARIANT (``try_parse_json``) and
reads every declared field with variant functions, all JVM-side and inside
whole-stage codegen. Policy for a declared field:

* unknown properties are ignored;
* a required number or boolean (a primitive) that is missing or JSON null is a
  reject; one that is not required reads null as null;
* ``""`` where an object or enum is declared reads as null;
* a scalar where an array is declared becomes a one-element array;
* numbers truncate to int and long, numeric text (``"7"``) is accepted as a
  number, and ``"true"``, ``"false"`` and numbers (0 is false) as a boolean;
* an enum value outside the allowed set is a reject that lists the set;
* a repeated key keeps its last value (``duplicate_keys="last"``).

Rejects (V4), most specific first: ``wrong_type`` (path, value, expected type,
allowed values for an enum); ``missing_field`` (path; also any other shape
mismatch: object, array or boolean where a scalar is declared, null for a
primitive); ``unreadable`` (not JSON at all). Each payload gets one reject:
the first failing field in declared order, missing required fields last.
A path segment without a field name (an array element) prints as ``?``.

Encoding (J2) omits null fields, prints decimals in plain notation and
writes a field-less object as ``{}``.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str  # "int" | "long" | "double" | "decimal" | "boolean" | "string" | "enum" | "string_array" | "object" | "array" (jsontree)
    required: bool = False
    values: tuple[str, ...] = ()
    fields: tuple["Field", ...] = field(default_factory=tuple)
    precision: tuple[int, int] = (38, 12)  # of a decimal
    items: "Field | None" = None  # the elements of an array; required: none of them is null

    @property
    def type_name(self) -> str:
        return {"int": "Integer", "long": "Long", "double": "Double", "decimal": "BigDecimal", "boolean": "Boolean",
                "string": "String", "enum": "Enum", "string_array": "List", "array": "List", "object": "Object"}[self.kind]

    @property
    def sql_type(self) -> str:
        """Spark type of a number or boolean."""
        return {"long": "bigint", "decimal": "decimal({},{})".format(*self.precision)}.get(self.kind, self.kind)


# Reject kinds.
WRONG_TYPE = "wrong_type"
MISSING_FIELD = "missing_field"
MAPPING_ERROR = "mapping_error"
UNREADABLE = "unreadable"
UNREADABLE_MESSAGE = "The request body could not be read. Check that it is valid JSON."


def _category(sub: Column) -> Column:
    t = F.schema_of_variant(sub)
    return (
        F.when(sub.isNull(), F.lit("missing"))
        .when(t == "VOID", F.lit("null"))
        .when(t.startswith("ARRAY"), F.lit("array"))
        .when(t.startswith("OBJECT"), F.lit("object"))
        .when(t == "STRING", F.lit("string"))
        .when(t == "BOOLEAN", F.lit("boolean"))
        .otherwise(F.lit("number"))
    )


def _reject(kind: str, path: str, message: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(path).alias("path"), message.alias("message"))


def _missing(path: str) -> Column:
    return _reject(MISSING_FIELD, path, F.lit(f"Required field '{path}' is missing or has the wrong shape."))


def _wrong_type(path: str, value: Column, f: Field) -> Column:
    allowed = f" Allowed values: [{', '.join(f.values)}]" if f.kind == "enum" else ""
    return _reject(WRONG_TYPE, path, F.format_string(
        f"Field '{path}' has value '%s', which does not match the expected type ({f.type_name}).{allowed}", value))


def _decode_field(v: Column, f: Field, prefix: str, probes: dict[str, Column]
                  ) -> tuple[dict[str, Column], list[Column], list[Column]]:
    """Columns for ``f``, its in-order rejects and its missing-required rejects.

    Per-field reads of the variant go into ``probes`` (computed once per row
    in a projection of their own); the rules below only reference them.
    """
    path = f"{prefix}{f.name}"
    jpath = f"$.{path}"
    col_name = path.replace(".", "_")

    def probe(tag: str, expr: Column) -> Column:
        name = f"_{col_name}_{tag}"
        probes[name] = expr
        return F.col(name)

    sub = probe("sub", F.try_variant_get(v, jpath, "variant"))
    cat = probe("cat", _category(sub))
    as_string = probe("str", F.try_variant_get(sub, "$", "string"))
    rejects: list[Column] = []
    late: list[Column] = []
    if f.kind in ("int", "long", "double", "decimal", "boolean"):
        num = probe("num", F.try_variant_get(sub, "$", f.sql_type))
        scalar, other = ["number", "string"], ["array", "object"] + ["null"] * f.required
        if f.kind == "boolean":
            scalar.append("boolean")
            # Text reads as a boolean only where it says so; Spark alone would also take "t" or "yes".
            num = F.when((cat != "string") | as_string.isin("true", "false"), num)
        else:
            other.append("boolean")
        cols = {col_name: F.when(cat.isin(*scalar), num)}
        rejects.append(F.when(cat.isin(*scalar) & num.isNull(), _wrong_type(path, as_string, f)))
        rejects.append(F.when(cat.isin(*other), _missing(path)))
        if f.required:
            late.append(F.when(cat == "missing", _missing(path)))
    elif f.kind == "string":
        cols = {col_name: F.when(cat.isin("string", "number", "boolean"), as_string)}
        rejects.append(F.when(cat.isin("array", "object"), _missing(path)))
        if f.required:
            late.append(F.when(cat.isin("missing", "null"), _missing(path)))
    elif f.kind == "enum":
        idx = probe("int", F.try_variant_get(sub, "$", "int"))
        allowed = F.array(*[F.lit(x) for x in f.values])
        valid_text = (cat == "string") & as_string.isin(*f.values)
        # coalesce: an index that does not fit an int is null, and must count as out of range
        in_range = (cat == "number") & F.coalesce(idx.between(0, len(f.values) - 1), F.lit(False))
        empty = (cat == "string") & (as_string == "")
        cols = {col_name: F.when(valid_text, as_string).when(in_range, F.try_element_at(allowed, idx + 1))}
        bad = ((cat == "string") & ~as_string.isin(*f.values) & ~empty) | ((cat == "number") & ~in_range)
        rejects.append(F.when(bad, _wrong_type(path, as_string, f)))
        rejects.append(F.when(cat.isin("boolean", "array", "object"), _missing(path)))
        if f.required:
            late.append(F.when(cat.isin("missing", "null") | empty, _missing(path)))
    elif f.kind == "string_array":
        # Does the array hold an array or object? Blank out string literals in
        # its JSON text, then look for a bracket after the opening one. Stays
        # in generated code, unlike a lambda over the elements.
        no_strings = F.regexp_replace(sub.cast("string"), r'"(?:[^"\\]|\\.)*"', '""')
        nested = probe("nested", F.coalesce(no_strings.rlike(r"^\[.*[\[{]"), F.lit(False)))
        arr = probe("arr", F.try_variant_get(sub, "$", "array<string>"))
        cols = {col_name: F.when((cat == "array") & ~nested, arr)
                .when(cat.isin("string", "number", "boolean"), F.array(as_string))}
        rejects.append(F.when((cat == "array") & nested, _missing(f"{path}.?")))
        rejects.append(F.when(cat == "object", _missing(path)))
        if f.required:
            late.append(F.when(cat.isin("missing", "null"), _missing(path)))
    elif f.kind == "object":
        is_obj = cat == "object"
        cols = {}
        for sf in f.fields:
            c, r, lt = _decode_field(v, sf, f"{path}.", probes)
            cols.update({k: F.when(is_obj, x) for k, x in c.items()})
            rejects.extend(F.when(is_obj, x) for x in r)
            late.extend(F.when(is_obj, x) for x in lt)
        empty = (cat == "string") & (as_string == "")
        rejects.append(F.when(cat.isin("array", "boolean", "number") | ((cat == "string") & ~empty), _missing(path)))
        if f.required:
            late.append(F.when(cat.isin("missing", "null") | empty, _missing(path)))
    else:
        raise ValueError(f"unsupported field kind {f.kind}")
    return cols, rejects, late


def _names(schema: tuple[Field, ...], prefix: str = "") -> Iterator[str]:
    """The output columns of ``schema``."""
    for f in schema:
        if "." in f.name:
            raise ValueError(f"field name {f.name!r} holds a dot, which separates levels")
        if f.kind == "object":
            yield from _names(f.fields, f"{prefix}{f.name}_")
        else:
            yield prefix + f.name


@dataclass(frozen=True)
class _Plan:
    subs: dict
    probes: dict
    reject: Column
    outputs: dict


@functools.lru_cache(maxsize=64)
def _compile(schema: tuple[Field, ...], context_key: int) -> _Plan:
    """The decode expressions for ``schema``, built once and reused for every
    call and every micro-batch (building them is most of the planning cost)."""
    names = list(_names(schema))
    if len(set(names)) < len(names):
        raise ValueError(f"two fields would share a column: {sorted(names)}")
    v = F.col("_v")
    cols: dict[str, Column] = {}
    rejects: list[Column] = []
    late: list[Column] = []
    probes: dict[str, Column] = {"_root": F.schema_of_variant(v)}
    for f in schema:
        c, r, lt = _decode_field(v, f, "", probes)
        cols.update(c)
        rejects.extend(r)
        late.extend(lt)
    subs = {k: x for k, x in probes.items() if k.endswith("_sub")}
    rest = {k: x for k, x in probes.items() if k not in subs}
    reject = (
        F.when(v.isNull(), _reject(UNREADABLE, "", F.lit(UNREADABLE_MESSAGE)))
        .when(~F.col("_root").startswith("OBJECT"), _missing(""))
        .otherwise(F.coalesce(*rejects, *late))
    )
    accepted = F.col("reject").isNull()
    outputs = {**{k: F.when(accepted, x) for k, x in cols.items()}, "accepted": accepted}
    return _Plan(subs, rest, reject, outputs)


def decode(df: DataFrame, payload: str, schema: tuple[Field, ...], duplicate_keys: str = "last") -> DataFrame:
    """J1 + V4: add one column per declared field, ``accepted`` and a
    ``reject`` struct (kind, path, message), null when accepted.

    Stages: parse once to VARIANT; navigate to each field once; derive type,
    text and number from that; then the rules, which only read those columns.

    ``duplicate_keys``: ``"last"`` (the last value of a repeated key wins, as
    in the service) or ``"reject"`` (the payload is unreadable). Spark takes
    this from the session when the plan is built, so it is set meanwhile.
    """
    if duplicate_keys not in ("last", "reject"):
        raise ValueError("duplicate_keys must be 'last' or 'reject'")
    plan = _compile(tuple(schema), id(SparkContext._active_spark_context))
    conf, key = df.sparkSession.conf, "spark.sql.variant.allowDuplicateKeys"
    before = conf.get(key)
    conf.set(key, str(duplicate_keys == "last").lower())
    try:
        parsed = df.withColumn("_v", F.try_parse_json(F.col(payload)))
        parsed.schema  # analysed here at the latest
    finally:
        conf.set(key, before)
    out = (parsed.withColumns(plan.subs).withColumns(plan.probes)
           .withColumn("reject", plan.reject)
           .withColumns(plan.outputs))
    return out.drop("_v", *plan.subs.keys(), *plan.probes.keys())


def _fence(df: DataFrame) -> DataFrame:
    """Keep later filters above this point.

    A filter on a decode result references columns built from the whole
    decode; pushed down, Catalyst would inline the decode into the filter and
    evaluate it twice (and below any repartition). Filters are not pushed
    through a generator's output, and a one-element ``inline`` is free.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def rejects(decoded: DataFrame) -> DataFrame:
    """V4: only the rejected rows, flattened, typed BAD_REQUEST."""
    r = F.col("reject")
    return _fence(decoded).where(~F.col("accepted")).withColumns({
        "reject_kind": r["kind"], "reject_path": r["path"], "message": r["message"],
        "error_type": F.lit("BAD_REQUEST")}).drop("reject")


# --- J2 ---------------------------------------------------------------------------

def _has_decimal(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_decimal(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_decimal(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_decimal(dtype.valueType)
    return isinstance(dtype, T.DecimalType)


def _value_json(c: Column, dtype: T.DataType) -> Column:
    """JSON text of one value; null stays null so the field can be omitted."""
    if isinstance(dtype, T.DecimalType):
        # Plain notation with the column's scale, exact (DecimalFormat on the
        # BigDecimal), grouping commas removed. Not cast(... as string): with
        # ANSI off that prints 6.6230E-8.
        return F.translate(F.format_number(c, dtype.scale), ",", "")
    if isinstance(dtype, T.StructType):
        return _object_json([(f.name, c[f.name], f.dataType) for f in dtype.fields], c.isNull())
    if _has_decimal(dtype) and isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda x: F.coalesce(_value_json(x, dtype.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    if _has_decimal(dtype) and isinstance(dtype, T.MapType):
        items = F.transform(F.map_entries(c), lambda e: F.concat(
            _value_json(e["key"].cast("string"), T.StringType()), F.lit(":"),
            F.coalesce(_value_json(e["value"], dtype.valueType), F.lit("null"))))
        return F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}"))
    wrapped = F.to_json(F.struct(c.alias("v")))
    # '{"v":<json>}' -> '<json>': drop the 5-character head and the closing brace.
    return F.when(c.isNotNull(), wrapped.substr(F.lit(6), F.length(wrapped) - F.lit(6)))


def _object_json(fields: list[tuple[str, Column, T.DataType]], null_when: Column | None = None) -> Column:
    parts = []
    for name, c, dtype in fields:
        parts.append(F.concat(F.lit(json.dumps(name, ensure_ascii=False) + ":"), _value_json(c, dtype)))
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return body if null_when is None else F.when(~null_when, body)


def encode(df: DataFrame, columns: list[str] | None = None, alias: str = "json") -> DataFrame:
    """J2: one JSON object per row from ``columns`` (default: all)."""
    cols = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumn(alias, _object_json([(c, F.col(c), types[c]) for c in cols]))
