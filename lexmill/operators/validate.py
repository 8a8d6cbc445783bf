"""Validation of JSON documents against a descriptive schema, compiled to one column expression.

A document is parsed to a variant once; every node of the schema becomes a predicate on the node's value, arrays are gone through by
``transform`` with positions, and the violations come out as an array of ``(path, rule)``.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KIND = "array<struct<path:string,rule:string>>"
#: What ``schema_of_variant`` calls the JSON types; it is asked of single values only, as it reads all of an object or array.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL\\(.*\\)", "boolean": "BOOLEAN"}


def _one(path: Column, rule: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))).cast(KIND)


def _none() -> Column:
    return F.array().cast(KIND)


def _get(v: Column, key: str) -> Column:
    return F.try_variant_get(v, "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']", "variant")


def compiled(v: Column, schema, path: Column, required: tuple[str, ...] = (), at: str = "$") -> Column:
    """The violations of variant ``v`` below ``path``; ``required`` holds schema paths such as ``$.entities[].id``.

    A value that is absent or null breaks nothing unless it is required (``missing``); one of another type gives ``not a string``,
    ``not an object`` and so on and is not looked into; one that is none of the listed values gives ``not allowed``.
    """
    nothing = v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(False))
    absent = _one(path, "missing") if at in required else _none()
    other = lambda wrong: F.when(nothing, absent).otherwise(_one(path, wrong))  # noqa: E731  the rare cases come last
    if isinstance(schema, dict):
        inner = F.concat(*[compiled(_get(v, k), s, F.concat(path, F.lit("." + k)), required, f"{at}.{k}") for k, s in schema.items()])
        return F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), inner).otherwise(other("not an object"))
    if isinstance(schema, list):
        each = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: compiled(x, schema[0], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), required, f"{at}[]"))
        return F.coalesce(F.flatten(each), other("not an array"))
    if schema in TYPES:
        return F.when(F.schema_of_variant(v).rlike(f"^(?:{TYPES[schema]})$"), _none()).otherwise(other(f"not a{'n' * (schema == 'integer')} {schema}"))
    if "|" in schema:
        return F.when(F.try_variant_get(v, "$", "string").isin(*schema.split("|")) & (F.schema_of_variant(v) == "STRING"), _none()).otherwise(other("not allowed"))
    raise ValueError(f"unknown type {schema!r} at {at}")


def violations(docs: DataFrame, schema: dict, json_col: str = "json", keys: tuple[str, ...] = ("doc_id",), required: tuple[str, ...] = ()) -> DataFrame:
    """``keys, path, rule`` for every place where a document differs from the schema; nothing for one that conforms.

    A text that is no JSON, or null, gives ``$`` with the rule ``not json``.  Keys that the schema doesn't name are allowed.  Rows with
    equal keys are checked each by itself.
    """
    parsed = docs.select(*keys, F.try_parse_json(json_col).alias("v"))
    found = F.when(F.col("v").isNull(), _one(F.lit("$"), "not json")).otherwise(compiled(F.col("v"), schema, F.lit("$"), required))
    return parsed.select(*keys, F.explode(found).alias("x")).select(*keys, "x.path", "x.rule")


def element_violations(rows: DataFrame, schema: dict, array: str, order: tuple[str, ...], json_col: str = "json", keys: tuple[str, ...] = ("doc_id",), required: tuple[str, ...] = ()) -> DataFrame:
    """As ``violations``, of the elements of the document's array ``array``, each a row with its own JSON text, whose places are by ``order`` among rows of equal ``keys``.

    Elements are checked before they are numbered, so that no text is sorted or put together.
    """
    inner = compiled(F.col("v"), schema[array][0], F.lit(""), required, f"$.{array}[]")
    found = F.when(F.col("v").isNull(), _one(F.lit(""), "not json")).otherwise(inner)
    df = rows.select(*keys, *order, F.try_parse_json(json_col).alias("v")).select(*keys, *order, found.alias("found"))
    df = df.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    return df.select(*keys, "i", F.explode("found").alias("x")).select(*keys, F.concat(F.lit(f"$.{array}["), F.col("i").cast("string"), F.lit("]"), F.col("x.path")).alias("path"), "x.rule")


def valid(docs: DataFrame, schema: dict, json_col: str = "json", required: tuple[str, ...] = ()) -> DataFrame:
    """The documents with ``n_violations long``, for keeping or parting them."""
    v = F.try_parse_json(json_col)
    return docs.withColumn("n_violations", F.when(v.isNull(), 1).otherwise(F.size(compiled(v, schema, F.lit("$"), required))).cast("long"))
