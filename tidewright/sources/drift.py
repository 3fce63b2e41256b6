"""Declared types against those of stored files, down into structs, arrays and maps."""

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

#: Types that a file may hold where the later one is declared: Spark reads them without loss.
_WIDER = (
    ("byte", "short", "integer", "long"),
    ("byte", "short", "integer", "double"),
    ("float", "double"),
    ("date", "timestamp_ntz"),
)
#: Files whose footers are read for a comparison.
SAMPLE = 16


@dataclass(frozen=True)
class Drift:
    """A difference at one place: `missing` and `extra` fields, `widened` ones that are read without loss, `clash` for other
    types, `case` for a name in other letters."""

    place: str
    kind: str
    declared: str | None
    found: str | None


def holds(declared: T.DataType, found: T.DataType) -> bool:
    """Whether every value of the found plain type is one of the declared type."""
    if isinstance(declared, T.DecimalType) and isinstance(found, T.DecimalType):
        return declared.scale >= found.scale and declared.precision - declared.scale >= found.precision - found.scale
    names = declared.typeName(), found.typeName()
    return any(names[0] in row and names[1] in row and row.index(names[1]) < row.index(names[0]) for row in _WIDER)


def differences(declared: T.DataType, found: T.DataType, place: str = "") -> Iterator[Drift]:
    """All drifts of a found type from the declared one. Names are compared without case, as Spark reads them."""
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        own = {field.name.lower(): field for field in found}
        for field in declared:
            at, other = f"{place}.{field.name}".lstrip("."), own.pop(field.name.lower(), None)
            if other is None:
                yield Drift(at, "missing", field.dataType.simpleString(), None)
                continue
            if other.name != field.name:
                yield Drift(at, "case", field.name, other.name)
            yield from differences(field.dataType, other.dataType, at)
        for field in own.values():
            yield Drift(f"{place}.{field.name}".lstrip("."), "extra", None, field.dataType.simpleString())
    elif isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        yield from differences(declared.elementType, found.elementType, f"{place}[]")
    elif isinstance(declared, T.MapType) and isinstance(found, T.MapType):
        yield from differences(declared.keyType, found.keyType, f"{place}[key]")
        yield from differences(declared.valueType, found.valueType, f"{place}[value]")
    elif declared != found and declared.simpleString() != found.simpleString():
        yield Drift(place, "widened" if holds(declared, found) else "clash", declared.simpleString(), found.simpleString())


def with_extras(declared: T.DataType, found: T.DataType) -> T.DataType:
    """The declared type with the fields that only the found one has, at any depth, after the declared ones."""
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        own = {field.name.lower(): field for field in found}
        fields = []
        for field in declared:
            other = own.pop(field.name.lower(), None)
            fields.append(T.StructField(field.name, with_extras(field.dataType, other.dataType) if other else field.dataType, field.nullable))
        return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in own.values()]])
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(with_extras(declared.elementType, found.elementType), declared.containsNull)
    if isinstance(declared, T.MapType) and isinstance(found, T.MapType):
        return T.MapType(declared.keyType, with_extras(declared.valueType, found.valueType), declared.valueContainsNull)
    return declared


def _read(reader: DataFrameReader, path: str | list[str]) -> DataFrame:
    return reader.parquet(path) if isinstance(path, str) else reader.parquet(*path)


def footers(spark: SparkSession, path: str | list[str], sample: int | None = SAMPLE) -> dict[str, T.StructType]:
    """The schemas of files below a path: `sample` of them, evenly spread over the names, or all with None."""
    names = sorted(_read(spark.read.schema("_ int"), path).inputFiles())
    if sample is not None and len(names) > sample:
        names = [names[round(i * (len(names) - 1) / max(1, sample - 1))] for i in range(sample)]
    return {name: spark.read.parquet(name).schema for name in names}


def read_declared(
    spark: SparkSession, path: str | list[str], declared: T.StructType, allow_drift: bool = False, validate: bool = False, sample: int | None = SAMPLE
) -> DataFrame:
    """Parquet under a declared schema.

    With `validate`, the footers of a sample of the files are compared with it: a missing field or a clash of types
    raises before anything is read, with every file and place; narrower types are read as the declared ones, and
    names match in any case. A file outside of the sample with another type fails when it is read; one that lacks a field
    gives NULLs. With `allow_drift`, fields beyond the declared ones, at any depth, are kept behind them; where files
    differ in the type of such a field, the first one that holds the others' values counts, and a clash raises.
    """
    if not (allow_drift or validate):
        return _read(spark.read.schema(declared), path)
    found = footers(spark, path, sample)
    wrong, schema = [], declared
    for name, own in found.items():
        wrong += [(name, d) for d in differences(declared, own) if validate and d.kind in ("missing", "clash")]
        if allow_drift:
            schema = with_extras(schema, own)
    if allow_drift:
        extra = {d.place for own in found.values() for d in differences(declared, own) if d.kind == "extra"}
        wrong += [
            (name, d) for name, own in found.items() for d in differences(schema, own)
            if d.kind == "clash" and any(d.place == x or d.place.startswith((f"{x}.", f"{x}[")) for x in extra)
        ]
    if wrong:
        said = "; ".join(f"{name.rpartition('/')[2]}: {d.place} {d.kind}, declared {d.declared}, found {d.found}" for name, d in wrong)
        raise ValueError(f"{path} does not hold the declared schema: {said}")
    return _read(spark.read.schema(schema), path)
