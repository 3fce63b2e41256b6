"""Pivots and nested JSON / XML output."""

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.joins import distinct_apart
from tidewright.operators.numbering import number_rows


def pivot_sum(df: DataFrame, row: str, column: str, values: list, value: str, prefix="") -> DataFrame:
    """One row per `row`, one column per listed value with the sum; values outside the list are dropped.

    The list is given, so Spark needs no extra job to find it. Column names become plain identifiers.
    """
    wide = df.groupBy(row).pivot(column, values).agg(F.sum(value))
    return wide.select(row, *[F.col(f"`{v}`").alias(prefix + identifier(str(v))) for v in values])


def identifier(name: str) -> str:
    """Characters that an XML element or a column name cannot hold become underscores."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", name)


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULL properties left out. The form for results of any size."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def as_json_array(df: DataFrame, order_by: str) -> DataFrame:
    """A report as one JSON array, in pieces: (seq, json), one piece per row and one for each bracket.

    Joined in the order of `seq`, the pieces are the array, of any number of rows. `order_by` should be unique.
    """
    rows = df.select(F.col(f"`{order_by}`").alias("_order"), F.to_json(F.struct(*[f"`{c}`" for c in df.columns])).alias("_text"))
    numbered = number_rows(rows, ["_order"], "seq")
    pieces = numbered.select("seq", F.concat(F.when(F.col("seq") > 1, ",").otherwise(""), "_text").alias("json"))
    ends = F.array(
        F.struct(F.lit(0).cast("bigint").alias("seq"), F.lit("[").alias("json")),
        F.struct((F.col("_n") + 1).alias("seq"), F.lit("]").alias("json")),
    )
    brackets = numbered.agg(F.count("*").alias("_n")).select(F.inline(ends))
    return pieces.unionByName(brackets)


def as_xml(df: DataFrame, order_by: str) -> DataFrame:
    """A report as XML elements without a row wrapper, in pieces: (seq, xml), one per row; NULL columns are left out.

    Joined in the order of `seq`, the pieces are the text.
    """
    elements = [
        F.concat(F.lit(f"<{identifier(name)}>"), _escaped(F.col(f"`{name}`")), F.lit(f"</{identifier(name)}>"))
        for name in df.columns
    ]
    rows = df.select(F.col(f"`{order_by}`").alias("_order"), F.concat_ws("", *elements).alias("xml"))
    return number_rows(rows, ["_order"], "seq").select("seq", "xml")


def _escaped(column):
    text = F.replace(column.cast("string"), F.lit("&"), F.lit("&amp;"))
    text = F.replace(text, F.lit("<"), F.lit("&lt;"))
    return F.replace(text, F.lit(">"), F.lit("&gt;"))


def nest_by(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    group: str,
    parent_columns: list[str],
    child_columns: list[str],
    child_array: str,
) -> DataFrame:
    """Per group one JSON array of parent objects, each with the array of its children, in pieces.

    Returns (group, seq, text): a piece for each bracket of a group, for the begin and the end of each parent
    and for each child. Joined in the order of `seq`, the pieces of a group are its array. The shape is the same
    at every size and nothing is gathered: pieces are range-partitioned and numbered, so a group or a parent with
    a third of all rows is spread like any other rows. Parents are ordered by their key and children by their
    columns. Parents without children, and those without a group, are left out. Both frames should come straight
    from files: equal rows are told apart by their position in the scan.
    """
    parents = parents.filter(F.col(group).isNotNull()).select(*dict.fromkeys([parent_key, group, *parent_columns]))
    parents = parents.withColumn("_parent", F.monotonically_increasing_id())
    keys = children.select(child_key)
    children = children.select(*dict.fromkeys([child_key, *child_columns])).withColumn("_child", F.monotonically_increasing_id())
    # Rows travel with their columns and become text last. Columns go by their place, as names may repeat or differ in case only.
    order = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(child_columns)], "_child")
    own = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(parent_columns)])
    # All columns of the children are shuffled once to meet their parents, and once to be sorted.
    held = parents.join(distinct_apart(keys, child_key), F.col(parent_key) == F.col(child_key), "left_semi")
    members = children.join(parents.select(parent_key, "_parent", group), F.col(parent_key) == F.col(child_key))
    groups = held.groupBy(group).agg(F.count("*")).select(group)
    order_type, own_type = children.select(order.alias("o")).schema["o"].dataType, parents.select(own.alias("o")).schema["o"].dataType

    def pieces(df, section, kind, child=None, parent=None):
        of_parent = [F.col(k) if section == 1 else F.lit(None).cast(parents.schema[k].dataType).alias(k) for k in (parent_key, "_parent")]
        child = F.lit(None).cast(order_type) if child is None else child
        parent = F.lit(None).cast(own_type) if parent is None else parent
        # What opens an array has no comma after it.
        opens = F.lit(section == 0) if section != 1 else F.col("_kind") == 0
        columns = [F.col(group), F.lit(section).alias("_section"), *of_parent, kind.alias("_kind")]
        return df.select(*columns, child.alias("_order"), parent.alias("_own")).withColumn("_opens", opens)

    both = held.withColumn("_which", F.explode(F.array(F.lit(0), F.lit(2))))
    everything = [
        pieces(groups, 0, F.lit(0)),
        pieces(both, 1, F.col("_which"), parent=F.when(F.col("_which") == 0, own)),
        pieces(members, 1, F.lit(1), child=order),
        pieces(groups, 2, F.lit(0)),
    ]
    rows = reduce(DataFrame.unionByName, everything)
    sorted_by = [group, "_section", parent_key, "_parent", "_kind", "_order"]
    numbered = number_rows(rows, sorted_by, "seq", flag="_opens")

    def as_json(column, names):
        return F.to_json(F.struct(*[F.col(column)[f"c{i}"].alias(c) for i, c in enumerate(names)]))

    alone = as_json("_own", parent_columns)
    begin = F.when(alone == "{}", "{").otherwise(F.concat(F.substring(alone, F.lit(1), F.length(alone) - 1), F.lit(",")))
    comma = F.when(F.col("_before__opens"), "").otherwise(",")
    text = (
        F.when(F.col("_section") == 0, "[")
        .when(F.col("_section") == 2, "]")
        .when(F.col("_kind") == 0, F.concat(comma, begin, F.lit(f'"{child_array}":[')))
        .when(F.col("_kind") == 1, F.concat(comma, as_json("_order", child_columns)))
        .otherwise("]}")
    )
    return numbered.select(group, "seq", text.alias("text"))
