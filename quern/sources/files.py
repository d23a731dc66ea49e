"""File sources.  Paths are whatever Spark's readers take; nothing is read on the driver but footers and samples."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, paths: str | list[str], union_by_name: bool = False, filename: bool = False, file_row_number: bool = False, hive_partitioning: bool = True) -> DataFrame:
    """Parquet files or folders.  union_by_name merges schemas; hive_partitioning off leaves folder values out."""
    reader = spark.read.option("mergeSchema", str(union_by_name).lower())
    if not hive_partitioning:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    columns = [F.col(f"`{c}`") for c in df.columns]
    if filename:
        columns.append(F.col("_metadata.file_path").alias("filename"))
    if file_row_number:
        columns.append(F.col("_metadata.row_index").alias("file_row_number"))
    return df.select(*columns)


def read_csv(spark: SparkSession, paths: str | list[str], schema: str | None = None, sep: str | None = None, header: bool | None = None, null: str = "", quote: str = '"', escape: str = '"', date_format: str | None = None, ignore_errors: bool = False, store_rejects: bool = False, **options: str) -> DataFrame:
    """CSV.  Without sep or header they are found from the first lines; without a schema types are inferred (another pass).

    ignore_errors drops lines that don't fit; store_rejects keeps them in column _rejected, with the others null there.
    """
    paths = [paths] if isinstance(paths, str) else paths
    if sep is None or header is None:
        found = sniff_csv(spark, paths[0])
        sep, header = sep or found["delimiter"], found["has_header"] if header is None else header
    reader = spark.read.option("sep", sep).option("header", str(header).lower()).option("nullValue", null).option("quote", quote).option("escape", escape)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    reader = reader.options(**options)
    if store_rejects:
        if schema is None:
            raise ValueError("rejects need a schema")
        return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_rejected").schema(f"{schema}, _rejected string").csv(paths)
    reader = reader.option("mode", "DROPMALFORMED" if ignore_errors else "FAILFAST")
    return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(paths)


def csv_rejects(spark: SparkSession, paths: str | list[str], schema: str, limit: int | None = None, **options: str) -> DataFrame:
    """(file, line): lines that don't fit the schema, ``limit`` of them at most (a report's limit, not the reader's)."""
    found = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_rejected").schema(f"{schema}, _rejected string").csv(paths)
    # All columns are read, since a line is only parsed as far as columns are asked for.
    found = found.select("*", F.col("_metadata.file_name").alias("_file"))
    asked = F.xxhash64(*[F.col(f"`{c}`") for c in found.columns]) % 2 < 2  # holds for every row
    bad = found.where(F.col("_rejected").isNotNull() & asked).select(F.col("_file").alias("file"), F.col("_rejected").alias("line"))
    return bad if limit is None else bad.limit(limit)


#: Names of CSV options as users give them, and as Spark's reader has them.
CSV_OPTIONS = {
    "delim": "sep", "new_line": "lineSep", "nullstr": "nullValue", "dateformat": "dateFormat", "timestampformat": "timestampFormat", "comment": "comment", "encoding": "encoding",
    "max_line_size": "maxCharsPerColumn", "maximum_line_size": "maxCharsPerColumn", "compression": "compression", "quote": "quote", "escape": "escape", "sep": "sep",
}


def csv_options(**given: object) -> dict[str, str]:
    """Spark's options for CSV options by their usual names."""
    unknown = set(given) - set(CSV_OPTIONS)
    if unknown:
        raise ValueError(f"no such CSV option here: {', '.join(sorted(unknown))}")
    return {CSV_OPTIONS[k]: str(v) for k, v in given.items()}


def sniff_csv(spark: SparkSession, path: str, lines: int = 50) -> dict[str, object]:
    """Delimiter, quote and header of a CSV file, from its first lines."""
    head = [r[0] for r in spark.read.text(path).limit(lines).collect()]  # a bounded sample
    sample = "\n".join(head)
    try:
        dialect = csv.Sniffer().sniff(sample, delimiters=",;|\t")
        delimiter, quote = dialect.delimiter, dialect.quotechar
    except csv.Error:
        delimiter, quote = ",", '"'
    rows = list(csv.reader(head, delimiter=delimiter, quotechar=quote or '"'))

    def number(x: str) -> bool:
        try:
            float(x)
        except ValueError:
            return False
        return True

    numeric_below = len(rows) > 1 and any(number(x) for x in rows[1])
    return {"delimiter": delimiter, "quote": quote, "has_header": bool(rows) and not any(number(x) for x in rows[0]) and (numeric_below or len(rows) < 2), "columns": len(rows[0]) if rows else 0}


def read_json(spark: SparkSession, paths: str | list[str], schema: str | None = None, lines: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", str(not lines).lower())
    return (reader.schema(schema) if schema else reader).json(paths)


def read_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row per file: filename, content, size, last_modified."""
    return read_blob(spark, paths).withColumn("content", F.decode("content", "UTF-8"))


def read_blob(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    df = spark.read.format("binaryFile").load(paths)
    return df.select(F.col("path").alias("filename"), "content", F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def glob(spark: SparkSession, pattern: str) -> DataFrame:
    """(file): paths that a pattern matches, listed by the file system that holds them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return spark.createDataFrame([(s.getPath().toString(),) for s in found], "file string")


def _footers(spark: SparkSession, paths: str) -> DataFrame:
    """(file, tail): each Parquet file's footer, framed as a file without rows, read through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    out = []
    for (name,) in glob(spark, paths).collect():
        path = jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        length = system.getFileStatus(path).getLen()
        stream = system.open(path)
        try:
            size = int.from_bytes(_bytes(jvm, stream, length - 8, 4), "little")
            out.append((name, bytearray(b"PAR1" + _bytes(jvm, stream, length - 8 - size, size + 8))))
        finally:
            stream.close()
    return spark.createDataFrame(out, "file string, tail binary")


def _bytes(jvm, stream, at: int, n: int) -> bytes:
    stream.seek(at)
    return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n))


def parquet_file_metadata(spark: SparkSession, paths: str) -> DataFrame:
    """(file, rows, row_groups, columns, created_by, format_version) of each file."""

    def run(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            found = [(f, pq.read_metadata(io.BytesIO(t))) for f, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = [(f, m.num_rows, m.num_row_groups, m.num_columns, m.created_by, m.format_version) for f, m in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["file", "rows", "row_groups", "columns", "created_by", "format_version"])

    return _footers(spark, paths).mapInArrow(run, "file string, rows long, row_groups long, columns long, created_by string, format_version string")


def parquet_kv_metadata(spark: SparkSession, paths: str) -> DataFrame:
    """(file, key, value): what writers noted in the footers."""

    def run(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows = [(f, k, v) for f, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for k, v in (pq.read_metadata(io.BytesIO(t)).metadata or {}).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.binary(), pa.binary()), strict=True)], ["file", "key", "value"])

    return _footers(spark, paths).mapInArrow(run, "file string, key binary, value binary")


def parquet_metadata(spark: SparkSession, paths: str) -> DataFrame:
    """(file, row_group, column, type, rows, compressed, uncompressed, min, max): footers, read where Spark puts the files."""
    names = _footers(spark, paths)

    def run(batches):
        import io

        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for file, tail in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                meta = pq.read_metadata(io.BytesIO(tail))
                for g in range(meta.num_row_groups):
                    for c in range(meta.num_columns):
                        x = meta.row_group(g).column(c)
                        s = x.statistics
                        low, high = (str(s.min), str(s.max)) if s is not None and s.has_min_max else (None, None)
                        rows.append((file, g, x.path_in_schema, x.physical_type, x.num_values, x.total_compressed_size, x.total_uncompressed_size, low, high))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["file", "row_group", "column", "type", "rows", "compressed", "uncompressed", "min", "max"])

    return names.mapInArrow(run, "file string, row_group long, column string, type string, rows long, compressed long, uncompressed long, min string, max string")


def parquet_schema(spark: SparkSession, path: str) -> DataFrame:
    fields = spark.read.parquet(path).schema.fields
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in fields], "name string, type string, nullable boolean")


def generate_series(spark: SparkSession, start: int, stop: int, step: int = 1, inclusive: bool = True) -> DataFrame:
    """range(), or with its end."""
    return spark.range(start, stop + (1 if step > 0 else -1) * inclusive, step).select(F.col("id").alias("value"))


def generate_times(spark: SparkSession, start: str, stop: str, step: str, inclusive: bool = True) -> DataFrame:
    """Timestamps from start to stop, the last included or not; step as an interval."""
    out = spark.sql(f"SELECT explode(sequence(CAST(:a AS timestamp_ntz), CAST(:b AS timestamp_ntz), INTERVAL {step})) AS value", args={"a": start, "b": stop})
    return out if inclusive else out.where(F.col("value") < F.lit(stop).cast("timestamp_ntz"))


def all_types(spark: SparkSession) -> DataFrame:
    """Three rows (least, largest, null) with a column of each type that a query may meet."""
    kinds = {
        "tinyint": (-128, 127), "smallint": (-32768, 32767), "int": (-(1 << 31), (1 << 31) - 1), "bigint": (-(1 << 63), (1 << 63) - 1), "float": ("-3.4028234e38", "3.4028234e38"),
        "double": ("-1.7976931348623157e308", "1.7976931348623157e308"), "decimal(18,4)": ("-99999999999999.9999", "99999999999999.9999"), "boolean": (False, True), "string": ("", "goo"),
        "date": ("0001-01-01", "9999-12-31"), "timestamp_ntz": ("0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"),
    }
    rows = [[F.lit(v[i] if i < 2 else None).cast("string").cast(k).alias(k.split("(")[0]) for k, v in kinds.items()] for i in range(3)]
    nested = [(F.array().cast("array<int>"), F.lit(0)), (F.array(F.lit(42), F.lit(999), F.lit(None)), F.lit(1)), (F.lit(None).cast("array<int>"), F.lit(2))]
    return spark.range(1).select(F.explode(F.array(*[F.struct(*r, a.alias("int_array"), n.alias("row")) for r, (a, n) in zip(rows, nested, strict=True)])).alias("r")).select("r.*")


def repeat_row(spark: SparkSession, values: dict[str, object], n: int) -> DataFrame:
    return spark.range(n).select(*[F.lit(v).alias(k) for k, v in values.items()])


def query_table(spark: SparkSession, names: list[str], by_name: bool = False) -> DataFrame:
    """Tables one after another, by place or by name."""
    out = spark.table(names[0])
    for n in names[1:]:
        out = out.unionByName(spark.table(n), allowMissingColumns=True) if by_name else out.unionAll(spark.table(n))
    return out
