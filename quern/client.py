"""A session's statements, tables and relations, as calls on Spark: what a client of the library uses day to day.

Nothing here plans or runs anything itself: SQL goes to ``spark.sql``, relations are DataFrames, registered functions are
Spark's.  Results stay distributed until they are fetched.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.registry import FUNCTIONS
from quern.operators import joins, rows, sets
from quern.streaming import windows

_STATEMENT = re.compile(r"""(?:'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/|[^;])+""", re.S)


# Statements.
def execute(spark: SparkSession, script: str, args: dict | list | None = None) -> DataFrame:
    """Runs statements one after another, parted by semicolons outside strings and comments; the last one's result."""
    out = None
    for statement in _STATEMENT.findall(script):
        if re.sub(r"--[^\n]*|/\*.*?\*/", "", statement, flags=re.S).strip():
            out = spark.sql(statement, args=args)
    if out is None:
        raise ValueError("no statement")
    return out


class Prepared:
    """A statement with named (:x) or numbered (?) parameters, bound on each run."""

    def __init__(self, spark: SparkSession, sql: str) -> None:
        self.spark, self.sql = spark, sql

    def run(self, *values: object, **named: object) -> DataFrame:
        return self.spark.sql(self.sql, args=named or list(values) or None)


def explain(df: DataFrame, mode: str = "formatted") -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def describe(df: DataFrame) -> DataFrame:
    """(column_name, column_type, null)."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO") for f in df.schema], "column_name string, column_type string, null string")


def try_(column: str) -> Column:
    """TRY(expression), for a cast: null where the value doesn't fit.  Other errors have their own try_ functions in Spark."""
    found = re.fullmatch(r"(?is)\s*cast\s*\((.*)\s+as\s+([^()]+(?:\([^()]*\))?)\)\s*", column)
    if not found:
        raise ValueError("TRY takes a CAST; see Spark's try_divide, try_add, try_element_at, try_to_timestamp")
    return F.expr(f"try_cast({found[1]} AS {found[2]})")


# Tables.
def write_table(df: DataFrame, name: str, overwrite: bool = False, append: bool = False, partition_by: list[str] | None = None) -> None:
    """CREATE TABLE AS, or an append by name (columns that the rows lack become null)."""
    spark = df.sparkSession
    if append:
        target = spark.table(name)
        full = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns])
        full.write.mode("append").insertInto(name)
    else:
        df.write.mode("overwrite" if overwrite else "errorifexists").format("parquet").partitionBy(*(partition_by or [])).saveAsTable(name)


def appender(spark: SparkSession, name: str, batches: Iterator[list[tuple]], rows_per_write: int = 1_000_000) -> int:
    """Appends batches of rows that come from the driver, in writes of at least ``rows_per_write`` rows; the number of rows."""
    held: list[tuple] = []
    n = 0
    for batch in itertools.chain(batches, [None]):
        held += batch or []
        if held and (batch is None or len(held) >= rows_per_write):
            spark.createDataFrame(held, spark.table(name).schema).write.mode("append").insertInto(name)
            n, held = n + len(held), []
    return n


def macro(spark: SparkSession, name: str, parameters: str, body: str, table: str | None = None) -> None:
    """CREATE MACRO: a SQL function for this session.  table: columns with types, for a table macro."""
    returns = f"RETURNS TABLE ({table}) " if table else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) {returns}RETURN {body}")


def register(spark: SparkSession, name: str, data: DataFrame | pd.DataFrame | pa.Table) -> DataFrame:
    """A temporary view of a DataFrame, or of a frame or Arrow table in the driver."""
    df = data if isinstance(data, DataFrame) else spark.createDataFrame(data)
    df.createOrReplaceTempView(name)
    return spark.table(name)


# Functions of the user's own.
def scalar_function(spark: SparkSession, name: str, fn: Callable[..., pd.Series], returns: str) -> Callable:
    """A vectorised function over Arrow batches, for DataFrames and SQL.  It gets and returns a Series."""
    made = F.pandas_udf(fn, returns)
    spark.udf.register(name, made)
    return made


def aggregate_function(spark: SparkSession, name: str, fn: Callable[..., object], returns: str) -> Callable:
    """An aggregate over a group's values; they come as one Series, so groups must fit a task."""

    def whole(x: pd.Series) -> float:
        return fn(x)

    whole.__annotations__ = {"x": pd.Series, "return": float}  # types, not their names: Spark reads the kind of function off them
    made = F.pandas_udf(whole, returns)
    spark.udf.register(name, made)
    return made


def table_function(spark: SparkSession, name: str, fn: Callable[..., Iterator[tuple]], returns: str) -> Callable:
    """A table function: rows from arguments, also per row with LATERAL."""

    class Rows:
        def eval(self, *args):
            yield from fn(*args)

    made = F.udtf(Rows, returnType=returns)
    spark.udtf.register(name, made)
    return made


# Fetching.
def fetch(df: DataFrame, n: int | None = None) -> list[tuple]:
    """The rows, or the first n."""
    return [tuple(r) for r in (df.limit(n) if n is not None else df).collect()]


def fetch_chunks(df: DataFrame, n: int) -> Iterator[list]:
    """Lists of n rows, a partition at a time in the driver."""
    return windows.chunks(df, n)


def fetch_arrow(df: DataFrame, n: int | None = None) -> pa.Table:
    return (df.limit(n) if n is not None else df).toArrow()


def record_batches(df: DataFrame, rows_per_batch: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Arrow record batches, a partition at a time in the driver."""
    schema = df.limit(0).toArrow().schema
    for chunk in windows.chunks(df, rows_per_batch):
        yield pa.RecordBatch.from_pylist([r.asDict(recursive=True) for r in chunk], schema=schema)


def materialize(df: DataFrame, n_rows: int | None = None, n_cells: int | None = None) -> list[tuple]:
    """The rows, or an error if there are more rows, or cells, than allowed; at most one row too many is fetched."""
    most = min(x for x in (n_rows, None if n_cells is None else n_cells // max(1, len(df.columns)), 1 << 31) if x is not None)
    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise RuntimeError(f"more than {most} rows")
    return [tuple(r) for r in found]


# Relations: DataFrames with the calls of a relational interface.
def rel_from_df(spark: SparkSession, data: pd.DataFrame | pa.Table) -> DataFrame:
    return spark.createDataFrame(data)


def rel_from_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def rel_from_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def rel_from_table_function(spark: SparkSession, name: str, *args: object) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}({', '.join(repr(a) for a in args)})")


def expr_reference(name: str) -> Column:
    return F.col(f"`{name}`")


def expr_constant(value: object) -> Column:
    return F.lit(value)


def expr_function(name: str, *args: Column) -> Column:
    """A function of this library, or else of Spark."""
    return FUNCTIONS[name](*args) if name in FUNCTIONS else F.call_function(name, *args)


def expr_comparison(op: str, x: Column, y: Column) -> Column:
    return {"=": x == y, "==": x == y, "<>": x != y, "!=": x != y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y, "IS NOT DISTINCT FROM": x.eqNullSafe(y), "IS DISTINCT FROM": ~x.eqNullSafe(y)}[op]


def expr_operator(op: str, *x: Column) -> Column:
    one = {"not": lambda a: ~a, "is_null": lambda a: a.isNull(), "is_not_null": lambda a: a.isNotNull(), "-": lambda a: -a}
    two = {"and": lambda a, b: a & b, "or": lambda a, b: a | b, "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b}
    return one[op](x[0]) if len(x) == 1 else two[op](*x)


def expr_window(call: Column, partition_by: list | None = None, order_by: list | None = None, rows_between: tuple[int, int] | None = None) -> Column:
    from pyspark.sql import Window

    w = Window.partitionBy(*(partition_by or []))
    if order_by:
        w = w.orderBy(*order_by)
    return call.over(w.rowsBetween(*rows_between) if rows_between else w)


def rel_project(rel: DataFrame, *columns: Column) -> DataFrame:
    return rel.select(*columns)


def rel_filter(rel: DataFrame, *conditions: Column) -> DataFrame:
    for c in conditions:
        rel = rel.where(c)
    return rel


def rel_aggregate(rel: DataFrame, groups: list[Column], aggregates: list[Column]) -> DataFrame:
    return rel.groupBy(*groups).agg(*aggregates)


def rel_order(rel: DataFrame, columns: list[str], ascending: bool | list[bool] = True) -> DataFrame:
    """Nulls last, whatever the direction."""
    up = ascending if isinstance(ascending, list) else [ascending] * len(columns)
    return rel.orderBy(*[F.asc_nulls_last(c) if a else F.desc_nulls_last(c) for c, a in zip(columns, up, strict=True)])


def rel_limit(rel: DataFrame, n: int) -> DataFrame:
    return rel.limit(n)


def rel_join(left: DataFrame, right: DataFrame, by: list[tuple[str, str]], join: str = "inner", kind: str = "regular", asof: tuple[str, str, str] | None = None) -> DataFrame:
    """join: inner, left, right, outer, cross, semi or anti.  kind: regular, natural, positional or asof (asof: left column, comparison, right column)."""
    if kind == "asof":
        return joins.asof_join(left, right, asof[0], asof[2], by, join, asof[1])
    if kind == "positional":
        return joins.positional_join(left, right, left.columns, right.columns)
    if join == "cross":
        return left.crossJoin(right)
    if kind == "natural":
        return left.join(right, [c for c in left.columns if c in right.columns], join)
    on = F.lit(True)
    for a, b in by:
        on &= left[a] == right[b]
    return left.join(right, on, {"semi": "left_semi", "anti": "left_anti"}.get(join, join))


def rel_union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionAll(b)


def rel_distinct(rel: DataFrame) -> DataFrame:
    return rel.distinct()


def rel_set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def rel_set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def rel_set_symdiff(a: DataFrame, b: DataFrame) -> DataFrame:
    return sets.symmetric_difference(a, b)


def rel_sql(rel: DataFrame, sql: str, name: str = "_") -> DataFrame:
    """SQL over the relation, which the text calls {_} (or {name})."""
    return rel.sparkSession.sql(sql, **{name: rel})


def rel_alias(rel: DataFrame, name: str) -> DataFrame:
    return rel.alias(name)


def rel_to_parquet(rel: DataFrame, path: str, **options: str) -> None:
    rel.write.options(**options).parquet(path)


def rel_to_csv(rel: DataFrame, path: str, **options: str) -> None:
    rel.write.options(**{"header": "true"} | options).csv(path)


def rel_to_table(rel: DataFrame, name: str) -> None:
    write_table(rel, name)


def rel_to_view(rel: DataFrame, name: str) -> DataFrame:
    rel.createOrReplaceTempView(name)
    return rel.sparkSession.table(name)


def rel_insert(rel: DataFrame, name: str) -> None:
    write_table(rel, name, append=True)


def row_summary(df: DataFrame) -> DataFrame:
    """(summary): each row as text, its values in brackets."""
    return df.select(F.concat(F.lit("["), F.concat_ws(", ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")) for c in df.columns]), F.lit("]")).alias("summary"))


def tbl_file(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder by the ending of its name."""
    kind = path.rstrip("/*").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    return spark.read.json(path) if kind in ("json", "ndjson", "jsonl") else spark.read.parquet(path)


summarize = rows.summarize
tbl_function, tbl_query = rel_from_table_function, rel_from_sql
