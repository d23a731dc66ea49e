"""Type, system and random functions."""

from __future__ import annotations

import re
import secrets
import time
import uuid as _uuid

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.registry import FUNCTIONS, col, register

FUNCTIONS |= {
    "typeof": lambda x: F.typeof(col(x)), "version": F.version, "current_catalog": F.current_catalog, "current_database": F.current_catalog, "current_schema": F.current_schema,
    "current_schemas": lambda implicit=True: F.array(F.current_schema()), "current_user": F.current_user, "user": F.current_user, "session_user": F.current_user, "current_role": F.current_user,
    "random": F.rand, "setseed": lambda s: F.rand(s), "hash": lambda *x: F.xxhash64(*map(col, x)), "error": lambda m: F.raise_error(F.lit(m)),
    "coalesce": lambda *x: F.coalesce(*map(col, x)), "nullif": lambda a, b: F.nullif(col(a), col(b)), "ifnull": lambda a, b: F.coalesce(col(a), col(b)),
}


@F.pandas_udf(T.StringType())
def _uuid7(x: pd.Series) -> pd.Series:
    def one(_: object) -> str:
        n = (int(time.time() * 1000) << 80) | (7 << 76) | (secrets.randbits(12) << 64) | (2 << 62) | secrets.randbits(62)
        return str(_uuid.UUID(int=n))

    return x.map(one)


FUNCTIONS["uuid"] = FUNCTIONS["gen_random_uuid"] = FUNCTIONS["uuidv4"] = F.uuid
FUNCTIONS["uuidv7"] = lambda: _uuid7(F.monotonically_increasing_id())


@register()
def uuid_extract_version(u):
    return F.conv(F.substring(col(u), 15, 1), 16, 10).cast("int")


@register()
def uuid_extract_timestamp(u):
    return F.timestamp_millis(F.conv(F.replace(F.substring(col(u), 1, 13), F.lit("-"), F.lit("")), 16, 10).cast("long"))


@register()
def constant_or_null(c, x):
    return F.when(col(x).isNotNull(), F.lit(c))


@register()
def current_setting(spark, name: str):
    return F.lit(spark.conf.get(name))


@register()
def cast_to_type(x, like, df):
    """x cast to the type that ``like`` has in df."""
    return col(x).cast(df.select(like).schema[0].dataType)


@register()
def get_type(x):
    return F.typeof(col(x))


@register()
def replace_type(x, old: str, new: str, df):
    """x with each part of type ``old`` in its type, however nested, cast to ``new``."""
    kind = df.select(col(x)).schema[0].dataType.simpleString()
    return col(x).cast(re.sub(rf"\b{old}\b", new, kind))


@register()
def is_histogram_other_bin(x):
    """Whether a bin is the one of all values beyond the last bound."""
    return col(x).isNull()


def set_variable(spark: SparkSession, name: str, value: object) -> None:
    """SET VARIABLE: a session variable of the value's own type."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE `{name}` = :value", args={"value": value})


@register()
def getvariable(name: str):
    return F.expr(f"session.`{name}`")


@register("alias")
def alias_of(df, x):
    """The name that the expression would have as a column."""
    return F.lit(df.select(x).columns[0])
