"""JSON kept in text columns."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bracketed(path: str) -> str:
    return re.sub(r'\."([^"]*)"', r"['\1']", path)


def json_value(column, path: str) -> Column:
    """Scalar at a path such as $.Events[1].Comment; NULL for an object, an array or a missing path.

    Keys may be quoted: $."Shelf Life".
    """
    path = _bracketed(path)
    found = F.get_json_object(column, path)
    # A text may itself begin like an object; only then is its type looked up.
    document = F.try_parse_json(F.col(column) if isinstance(column, str) else column)
    kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    # In this order a missing path, which is NULL, is never parsed again.
    nothing = F.lit(None).cast("string")
    return F.when(found.isNull(), nothing).when(~F.substring(found, 1, 1).isin("{", "["), found).when(kind == "STRING", found)


def scalar_at(document: Column, path: str) -> Column:
    """Scalar at a path of a parsed document (a variant), as text; NULL for an object, an array, a JSON null or a missing
    path. Numbers come in their shortest form."""
    path = _bracketed(path)
    found = F.try_variant_get(document, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    return F.when(~F.substring(found, 1, 1).isin("{", "["), found).when(kind == "STRING", found)


def with_scalars(df: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    """df with the scalars at several paths of one text column, which is parsed once a row. A text that is no JSON
    document, or repeats a key, gives NULLs."""
    parsed = df.withColumn("_document", F.try_parse_json(F.col(column)))
    found = [scalar_at(F.col("_document"), path).alias(name) for name, path in paths.items()]
    return parsed.select(*[F.col(name) for name in df.columns], *found)
