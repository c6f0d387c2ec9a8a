"""Small Column builders shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from sluiceway import spec


def quoted(name: str) -> str:
    """A column name that Spark SQL reads as one identifier."""
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores at its end if a column is called so, in whatever case."""
    names = {item.lower() for item in taken}
    while name.lower() in names:
        name += "_"
    return name


def as_column(column: spec.Column) -> Column:
    """A projected column: any Spark SQL expression, renamed if it has an alias.

    A bare alias may be any text. An alias that is SQL already, quoted or a
    list of names for a generator, is parsed together with its expression.
    """
    alias = column.alias.strip()
    if not alias:
        return F.expr(column.name)
    if alias.startswith(("`", "(")):
        return F.expr(str(column))
    return F.expr(column.name).alias(alias)


def lossless_cast(value: Column, current: DataType, wanted: DataType) -> tuple[Column, Column]:
    """``value`` as ``wanted``, and whether casting back gives something else.

    Used for keys, which must not turn into other keys: 1.5 is no integer key.
    """
    cast = value.try_cast(wanted)
    return cast, value.isNotNull() & ~cast.try_cast(current).eqNullSafe(value)


def comparable(kind: DataType) -> bool:
    """Whether Spark can order and hash values of this type: no maps, no variants."""
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return comparable(kind.elementType)
    if isinstance(kind, StructType):
        return all(comparable(item.dataType) for item in kind)
    return True
