"""Keys and types in the documents that the declared schema does not have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from claimstrata.sources.documents import WIRE_SCHEMA

DEPTH = 8
_ELEMENT = "[]"
_EMPTY = ("OBJECT<>", "ARRAY<VOID>", "VOID")
_KINDS = {"string": "STRING", "int": "BIGINT", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


def declared_fields(schema: DataType | str = WIRE_SCHEMA, path: str = "") -> dict[str, str]:
    """The declared type of every innermost field by its path; ``[]`` stands for an array's elements."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if isinstance(kind, StructType):
        return {
            found: name
            for field in kind.fields
            for found, name in declared_fields(field.dataType, f"{path}.{field.name}" if path else field.name).items()
        }
    if isinstance(kind, ArrayType):
        return declared_fields(kind.elementType, path + _ELEMENT)
    return {path: _KINDS.get(kind.simpleString(), kind.simpleString().upper())}


def read_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``doc`` of every line as it stands, whatever its fields; NULL for a line that is no JSON."""
    return spark.read.option("singleVariantColumn", "doc").json(path)


def found_fields(documents: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``path, type, n``: how often every innermost value of a path and type occurs in the column ``doc``.

    Containers are opened one after another down to ``depth`` levels in one
    scan; what lies deeper is counted as a value of the container's own type,
    as is an empty container. Lines that hold no container are counted under
    an empty path. NULL documents are not.

    Tasks count before the shuffle, which is bounded by paths and types.
    """
    return _counted(documents, depth, F.lit(False))


def undeclared_fields(
    documents: DataFrame, schema: DataType | str = WIRE_SCHEMA, depth: int = DEPTH
) -> DataFrame:
    """``path, type, n`` of values that the schema does not declare, or not with that type.

    JSON's null fits every field, and an empty container every path that the
    schema goes on from. What fits is dropped at the level it is found at.
    """
    declared = declared_fields(schema)
    known = {*declared, *(outer for path in declared for outer in _outer_paths(path))}
    fits = {f"{kind} {path}" for path, kind in declared.items()}
    fits |= {f"{kind} {path}" for path in known for kind in _EMPTY}
    # One lookup of one text: a comparison with each path in turn would build the path again for each.
    return _counted(documents, depth, F.concat("type", F.lit(" "), "path").isin(*fits))


def _counted(documents: DataFrame, depth: int, skipped: Column) -> DataFrame:
    """``found_fields`` without the paths and types that the condition ``skipped`` holds for.

    A row carries the container that is still to be opened, or the type of a
    value that is none. The containers around it stay behind: no step between
    two levels copies the document.
    """
    spark = documents.sparkSession
    rows = documents.where("doc IS NOT NULL").select(
        F.lit("").alias("path"), F.col("doc").alias("container"), F.lit(None).cast("string").alias("type")
    )
    for i in range(1, depth + 1):
        if i > 1:
            rows = rows.where(F.col("type").isNull() | ~skipped)
        inside = spark.tvf.variant_explode_outer(F.col("container").outer()).toDF("position", "key", "inner")
        step = F.when(F.col("key").isNull(), _ELEMENT).otherwise(
            F.concat(F.lit("." if i > 1 else ""), F.col("key"))
        )
        path = F.concat("path", F.when(F.col("position").isNull(), "").otherwise(step))
        # An empty container has nothing inside and stays.
        rows = _typed(rows.lateralJoin(inside), path, F.coalesce("inner", "container"), F.col("type"))
    kinds = rows.select("path", F.coalesce("type", F.schema_of_variant("container")).alias("type"))
    return kinds.where(~skipped).groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))


def _typed(rows: DataFrame, path: Column, value: Column, known: Column) -> DataFrame:
    """``path, container, type``: the value if it is a container, else its type or the type ``known`` before."""
    rows = rows.select(path.alias("path"), value.alias("value"), known.alias("known"))
    rows = rows.withColumn("kind", F.schema_of_variant("value"))
    opens = F.col("kind").rlike("^(OBJECT|ARRAY)<")
    return rows.select(
        "path",
        F.when(opens, F.col("value")).alias("container"),
        F.coalesce("known", F.when(~opens, F.col("kind"))).alias("type"),
    )


def _outer_paths(path: str) -> list[str]:
    """The paths of the containers around a field."""
    cuts = [i for i, c in enumerate(path) if c == "." or path.startswith(_ELEMENT, i)]
    return [path[:i] for i in cuts] + [""]
