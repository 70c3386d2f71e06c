"""Flattening of nested rows and raw JSON: no array or struct is left."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


def _free(name: str, taken: set[str]) -> str:
    """``name``, or with the first number behind it that no other column has."""
    out, k = name, 1
    while out.lower() in taken:
        k += 1
        out = f"{name}_{k}"
    taken.add(out.lower())
    return out


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs become columns named by their path, arrays become rows; until neither is left.

    The elements of an array get a 0-based ``<name><sep>index``; a row whose
    array is empty or null stays, with nulls.  Arrays that stand side by side
    are read in step (element i of each in one row, the index named for the first
    of them), so rows never multiply.
    A path that meets another column's name gets a number behind it.  Maps
    become arrays of key and value; variants become text.
    """
    while True:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        nested = [n for n, k in kinds.items() if isinstance(k, (StructType, MapType, VariantType))]
        if nested:
            taken, out = {n.lower() for n in kinds if n not in nested}, []
            for name, kind in kinds.items():
                column = F.col(f"`{name}`")
                if isinstance(kind, StructType):
                    out += [column.getField(f).alias(_free(f"{name}{sep}{f}", taken)) for f in kind.fieldNames()]
                elif isinstance(kind, MapType):
                    out.append(F.map_entries(column).alias(_free(name, taken)))
                elif isinstance(kind, VariantType):
                    out.append(column.cast("string").alias(_free(name, taken)))
                else:
                    out.append(column)
            df = df.select(*out)
            continue
        arrays = [n for n, k in kinds.items() if isinstance(k, ArrayType)]
        if not arrays:
            return df
        taken = {n.lower() for n in kinds}
        index = _free(f"{arrays[0]}{sep}index", taken)
        step = F.arrays_zip(*[F.coalesce(F.col(f"`{a}`"), F.array().cast(kinds[a])).alias(f"a{i}") for i, a in enumerate(arrays)])
        others = [F.col(f"`{n}`") for n in kinds if n not in arrays]
        rows = df.select(*others, F.posexplode_outer(step).alias(index, "__step"))
        df = rows.select(*others, F.col(f"`{index}`"), *[F.col("__step").getField(f"a{i}").alias(a) for i, a in enumerate(arrays)])


def json_schema(lines: DataFrame, column: str = "value") -> str:
    """One type that holds every JSON object of the column, as DDL; found by a single aggregation over all lines."""
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first().s
    return re.sub(r"\bOBJECT<", "STRUCT<", found).replace("VOID", "STRING")


def flatten_json(lines: DataFrame, column: str = "value", schema: str | None = None, sep: str = "_") -> DataFrame:
    """Raw JSON objects (one per row) -> flat rows.  Lines that hold no object give none; a missing field is null.

    ``schema`` (DDL) saves the pass that finds it and fixes the columns.
    """
    value = F.try_parse_json(column)
    kind = schema or json_schema(lines.filter(F.try_variant_get(value, "$", "map<string,variant>").isNotNull()), column)
    typed = lines.filter(F.try_variant_get(value, "$", "map<string,variant>").isNotNull()).select(F.try_variant_get(value, "$", kind).alias("v"))
    return flatten(typed.select("v.*"), sep)
