"""Schema contracts: all differences are told at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "strings": T.ArrayType(T.StringType())}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns.items()])


SOURCE = _struct(id="string", name="string", source_type="string", source_url="string", feed_url="string", collection_method="string", check_frequency="string", region="strings", topic_focus="strings", quality="double", active="boolean", last_attempt="timestamp", last_success="timestamp")
ARTICLE = _struct(url="string", title="string", snippet="string", source_id="string", published="timestamp", image_url="string", evidence="string", method="string")
ATTEMPT = _struct(source_id="string", outcome="string", article_count="int", error="string", attempted_at="timestamp")


class SchemaMismatch(ValueError):
    """Columns that are missing or of another type."""


def assert_schema(df: DataFrame, expected: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: missing" for f in expected if f.name not in have and f.name not in optional]
    wrong += [f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}" for f in expected if f.name in have and have[f.name] != f.dataType]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df


def only_known(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns that the target has with the same type; the rest is dropped."""
    kinds = {f.name: f.dataType for f in target}
    return df.select(*(f.name for f in df.schema if kinds.get(f.name) == f.dataType))
