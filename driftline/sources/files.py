"""File sources and sinks: CSV/JSON readers, partitioned and clustered writes, file counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True,
             multiline: bool = False, sep: str = ",") -> DataFrame:
    """CSV with header, quoted fields and ``"`` escapes. ``multiline`` is for files whose quoted fields
    hold line breaks: such a file cannot be split and is read by one task. A DDL ``schema`` skips
    inference (inference costs an extra pass over the files)."""
    r = (spark.read.option("header", header).option("multiLine", multiline).option("escape", '"')
         .option("quote", '"').option("sep", sep))
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    (df.write.mode("overwrite").option("header", header).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


SEPARATORS = (",", ";", "\t", "|", ":", "~", "^")
DETECT_LINES = 1000


def detect_separator(spark: SparkSession, path: str, candidates: tuple[str, ...] = SEPARATORS, lines: int = DETECT_LINES) -> str:
    """The separator of delimited text files, by a vote of sampled lines (the smallest hashes, so from
    all files): outside quotes, a separator stands equally often in every line. The candidate with the
    largest share of lines that agree on a count above zero wins; among equals the larger count."""
    some = spark.read.text(path).filter("value <> ''").select(F.regexp_replace("value", '"[^"]*"', "").alias("line"))
    some = some.orderBy(F.xxhash64("line")).limit(lines)
    times = F.array(*[F.struct(F.lit(i).alias("i"), (F.length("line") - F.length(F.translate("line", c, ""))).alias("k")) for i, c in enumerate(candidates)])
    votes = some.select(F.explode(times).alias("v")).groupBy("v.i", "v.k").agg(F.count(F.lit(1)).alias("n"))
    best = votes.filter("k > 0").orderBy(F.desc("n"), F.desc("k"), "i").limit(1).collect()
    if not best:
        raise ValueError(f"no line of {path} holds any of {candidates}")
    return candidates[best[0]["i"]]


def read_delimited(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """Delimited text whose separator is not known (see :func:`detect_separator`)."""
    return read_csv(spark, path, schema=schema, header=header, sep=detect_separator(spark, path))


def write_n_files(df: DataFrame, path: str, n: int, mode: str = "overwrite") -> None:
    """Exactly ``n`` part files (one per partition after a round-robin repartition)."""
    df.repartition(n).write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, cols: list[str], mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000) -> None:
    """Directory per value. Rows are rebalanced by the partition columns: adaptive execution splits a
    value that holds much of the data by measured size and joins small ones, so the number of tasks
    and files follows the data instead of a fixed salt."""
    (df.hint("rebalance", *cols).write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file).partitionBy(*cols).parquet(path))


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a parquet scan with rows per file (from the hidden ``_metadata`` column)."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("n_rows")))


BOUNDARY_SAMPLE = 20_000  # rows that the bucket boundaries of a clustering are drawn from


def quantile_boundaries(df: DataFrame, cols: list[str], buckets: int, sample: int = BOUNDARY_SAMPLE) -> dict[str, list[str]]:
    """Up to ``buckets - 2`` ascending boundaries per column, as text, at equal ranks of a random
    sample of bounded size. Works for every ordered type, and a value that fills much of the column
    takes few boundaries however skewed it is."""
    some = df.select(*cols).orderBy(F.rand(42)).limit(sample)  # top-k per task, never a global sort
    steps = F.sequence(F.lit(1), F.lit(buckets - 2))

    def cuts(c: str) -> Column:
        ordered = F.sort_array(F.collect_list(c))
        at = F.transform(steps, lambda i: F.get(ordered, F.floor(i * F.size(ordered) / (buckets - 1)).cast("int")))
        as_text = (lambda v: F.hex(v)) if df.schema[c].dataType.simpleString() == "binary" else (lambda v: v.cast("string"))
        return F.transform(F.array_distinct(F.filter(at, lambda v: v.isNotNull())), as_text).alias(c)

    row = some.agg(*[cuts(c) for c in cols]).first()
    return {c: list(row[c]) for c in cols}


def rank_id(df: DataFrame, c: str, boundaries: list[str]) -> Column:
    """Bucket of a value by binary search: 0 for nulls, else 1 + the boundaries at or below it."""
    kind = df.schema[c].dataType
    bounds = [F.unhex(F.lit(b)) if kind.simpleString() == "binary" else F.lit(b).cast(kind) for b in boundaries]

    def within(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo + 1)
        mid = (lo + hi) // 2
        return F.when(F.col(c) < bounds[mid], within(lo, mid)).otherwise(within(mid + 1, hi))

    return F.when(F.col(c).isNull(), F.lit(0)).otherwise(within(0, len(bounds)))


def zorder_key(df: DataFrame, cols: list[str], bits: int = 8) -> DataFrame:
    """Add ``_z``: the bit-interleaved (Morton) code of per-column quantile buckets, for columns of any
    ordered type (text, dates, timestamps, numbers)."""
    if len(cols) == 1:
        return df.withColumn("_z", F.col(cols[0]))
    bits = min(bits, 62 // len(cols))
    found = quantile_boundaries(df, cols, 1 << bits)
    terms = []
    for i, c in enumerate(cols):
        b = rank_id(df, c, found[c]).cast("long")
        terms += [F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1)), bit * len(cols) + i) for bit in range(bits)]
    return df.withColumn("_z", reduce(lambda x, y: x.bitwiseOR(y), terms))


ROWS_PER_FILE = 2_000_000  # a task sorts the rows of one file


def clustered_rewrite(df: DataFrame, path: str, cols: list[str], n_files: int, mode: str = "overwrite") -> None:
    """OPTIMIZE ... ZORDER BY re-expressed: range-partition on the (Morton) key so each output
    file covers a narrow range of every clustering column; parquet min/max stats then skip
    files for range predicates. A table of more than ``n_files`` times ROWS_PER_FILE rows gets more
    files, so that the memory of a task that sorts one does not grow with the table."""
    n_files = max(n_files, -(-df.count() // ROWS_PER_FILE))
    keyed = zorder_key(df, cols).withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    # the row hash breaks ties so one very frequent key can still be cut into several files
    (keyed.repartitionByRange(n_files, "_z", "_tie").sortWithinPartitions("_z").drop("_z", "_tie")
     .write.mode(mode).parquet(path))
