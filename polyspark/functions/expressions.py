"""Expressions of template places, such as ``answer_choices[label] | join(", ")``, as columns.

An expression is a field, an index or member of a value, a constant, or a value with filters. All of
it becomes one column of the plan; no row is interpreted.
"""

from __future__ import annotations

import ast
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polyspark.functions.text import strip


@dataclass(frozen=True)
class Value:
    """A column, its type, and where an index found nothing, which is printed as nothing (a null is ``None``)."""

    column: Column
    type: T.DataType
    missing: Column | None = None


Filter = Callable[..., Value]


def double_text(column: Column) -> Column:
    """A double in Python's form: shortest digits, an exponent only from 1e16 on and below 1e-4."""
    java = column.cast("string")
    plain = F.regexp_replace(column.cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    power = F.regexp_replace(F.regexp_replace(java, r"\.0E", "E"), r"E(-?)([0-9])$", "E$10$2")
    power = F.regexp_replace(F.regexp_replace(power, "E-", "e-"), "E", "e+")
    named = F.replace(F.lower(java), F.lit("infinity"), F.lit("inf"))
    size = F.abs(column)
    return (
        F.when(F.isnan(column) | (size == float("inf")), named)
        .when(~java.contains("E"), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(power)
    )


def text_of(value: Value) -> Column:
    """The text a value prints as."""
    column = value.column
    if isinstance(value.type, T.BooleanType):
        column = F.when(column, F.lit("True")).when(~column, F.lit("False"))
    elif isinstance(value.type, T.DoubleType):
        column = double_text(column)
    text = F.coalesce(column.cast("string"), F.lit("None"))
    return text if value.missing is None else F.when(value.missing, F.lit("")).otherwise(text)


def _array(value: Value, name: str) -> T.ArrayType:
    if not isinstance(value.type, T.ArrayType):
        raise ValueError(f"{name} needs a list")
    return value.type


def item(value: Value, index: Column) -> Value:
    """An element counted from 0, or from the end if negative; an index outside the list finds nothing."""
    kind = _array(value, "an index")
    index = index.cast("int")
    size = F.size(value.column)
    outside = index.isNull() | value.column.isNull() | (index >= size) | (index < -size)
    found = F.get(value.column, F.when(index < 0, index + size).otherwise(index))
    return Value(found, kind.elementType, outside if value.missing is None else value.missing | outside)


def member(value: Value, name: str) -> Value:
    """A field of a struct, or the value of a map's key; a missing key finds nothing."""
    if isinstance(value.type, T.StructType):
        if name not in value.type.names:
            raise ValueError(f"no member {name!r}")
        return replace(value, column=value.column.getField(name), type=value.type[name].dataType)
    if isinstance(value.type, T.MapType):
        absent = ~F.coalesce(F.map_contains_key(value.column, name), F.lit(False))
        return Value(F.try_element_at(value.column, F.lit(name)), value.type.valueType, absent if value.missing is None else value.missing | absent)
    raise ValueError(f"a value without members has no {name!r}")


def joined(value: Value, between: str = "") -> Value:
    """The printed elements of a list with a text between them; a null list is empty."""
    kind = _array(value, "join").elementType
    texts = F.transform(value.column, lambda x: text_of(Value(x, kind)))
    return Value(F.coalesce(F.array_join(texts, between), F.lit("")), T.StringType())


def length(value: Value) -> Value:
    count = F.size if isinstance(value.type, T.ArrayType) else F.length
    return Value(F.coalesce(count(value.column), F.lit(0)), T.IntegerType())


def on_text(fn: Callable[[Column], Column]) -> Filter:
    return lambda value: Value(fn(text_of(value)), T.StringType())


# Filters on printed texts and lists; those of the templates' own are given by the caller.
FILTERS: dict[str, Filter] = {
    "join": joined,
    "length": length,
    "first": lambda value: item(value, F.lit(0)),
    "last": lambda value: item(value, F.lit(-1)),
    "lower": on_text(F.lower),
    "upper": on_text(F.upper),
    "trim": on_text(strip),
}


def fields(df: DataFrame) -> dict[str, Value]:
    return {f.name: Value(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields}


def expression(source: str, names: dict[str, Value], filters: dict[str, Filter]) -> Value:
    """The value of an expression over ``names``; ValueError if it uses anything else."""
    try:
        tree = ast.parse(source.strip(), mode="eval").body
    except SyntaxError as error:
        raise ValueError(f"cannot read {{{{{source}}}}}") from error

    def value(node: ast.expr) -> Value:
        match node:
            case ast.Name(id=name):
                if name not in names:
                    raise ValueError(f"the documents have no field {name!r}")
                return names[name]
            case ast.Constant(value=str() as text):
                return Value(F.lit(text), T.StringType())
            case ast.Subscript(value=base, slice=ast.Constant(value=str() as key)) | ast.Attribute(value=base, attr=key):
                return member(value(base), key)
            case ast.Subscript(value=base, slice=ast.Constant(value=int() as at)):
                return item(value(base), F.lit(at))
            case ast.Subscript(value=base, slice=ast.UnaryOp(op=ast.USub(), operand=ast.Constant(value=int() as at))):
                return item(value(base), F.lit(-at))
            case ast.Subscript(value=base, slice=inner):
                at = value(inner)
                if not isinstance(at.type, T.IntegralType):
                    raise ValueError(f"the index in {{{{{source}}}}} is no whole number")
                return item(value(base), at.column)
            case ast.BinOp(left=base, op=ast.BitOr(), right=ast.Name(id=name)):
                return apply(name, value(base), [])
            case ast.BinOp(left=base, op=ast.BitOr(), right=ast.Call(func=ast.Name(id=name), args=args, keywords=[])):
                return apply(name, value(base), [ast.literal_eval(a) for a in args])
        raise ValueError(f"cannot use {{{{{source}}}}}")

    def apply(name: str, base: Value, args: list) -> Value:
        if name not in filters:
            raise ValueError(f"no filter {name!r}")
        return filters[name](base, *args)

    return value(tree)
