"""Delimited text: inferred, typed and all-string scans, and a quarantine for long lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelwise.session import landed

RECORD = "_record"
ORDINAL = "_ordinal"


def scan_inferred(spark: SparkSession, path: str, sample: float = 1.0) -> DataFrame:
    """Types from the data, at the price of one more pass over ``sample`` of the file."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sample)
        .csv(path)
    )


def scan_typed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def scan_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Every column as text; an empty field is NULL."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.option("header", True).schema(schema).csv(path)


def scan_or_empty(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv"
) -> DataFrame:
    """The table at ``path``, or no rows of that schema when there is none."""
    try:
        return spark.read.format(fmt).option("header", True).schema(schema).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


# Quoting opens at the start of a field only; inside, a doubled quote does not close it.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CLOSED = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|)'
_OPENS = rf'(?:{_CLOSED},)*+"{_INSIDE}'


def records(spark: SparkSession, path: str, most_lines: int = 1000) -> DataFrame:
    """(record, ordinal, is_broken): lines joined where a quoted field goes on over line breaks.

    Files are split as usual. A line maps "inside quotes or not" at its start to the same at its end; of the
    lines before it in its block, the last that leaves no choice and the swaps since then give its start, and a
    row a block does the same for blocks. Where no line of ``path`` ends inside quotes, lines are records and
    nothing is shuffled. A record of more than ``most_lines`` lines has lost a quote: its lines come back one by
    one, marked broken, so no record gathers the rest of a file. Line breaks inside become a newline each.
    """
    block = F.struct("_metadata.file_path", "_metadata.file_block_start")
    lines = spark.read.text(path).select(F.col("value").alias(RECORD), F.struct(block.alias("block"), F.monotonically_increasing_id().alias("line")).alias(ORDINAL))
    opens = F.rlike(F.col(RECORD), F.lit(rf"(?s)\A{_OPENS}\z"))
    if lines.filter(opens).limit(1).count() == 0:
        return lines.filter(F.length(RECORD) > 0).withColumn("is_broken", F.lit(False))
    stays = F.rlike(F.col(RECORD), F.lit(rf'(?s)\A{_INSIDE}(?:"[^,]*+,{_OPENS})?+\z'))

    file, start, line = (F.col(f"{ORDINAL}.{c}") for c in ("block.file_path", "block.file_block_start", "line"))
    known = lines.select(RECORD, file.alias("file"), start.alias("block"), line.alias("line"), opens.alias("out"), stays.alias("in"))
    swaps = F.col("out") & ~F.col("in")
    fixed = F.when(F.col("out") == F.col("in"), F.col("out").cast("int"))
    in_block, by_block = Window.partitionBy("file", "block").orderBy("line"), Window.partitionBy("file").orderBy("block")
    before, so_far, earlier = (w.rowsBetween(Window.unboundedPreceding, end) for w, end in ((in_block, -1), (in_block, 0), (by_block, -1)))

    counted = known.withColumn("swaps", F.sum(swaps.cast("int")).over(so_far)).withColumn("fixed", F.when(fixed.isNotNull(), F.struct(fixed.alias("to"), "swaps")))
    placed = counted.withColumn("last", F.last("fixed", ignorenulls=True).over(before)).withColumn("swapped", F.coalesce(F.lag("swaps").over(in_block), F.lit(0)))
    # Of a block: the state it ends in if it fixes one, else whether it swaps.
    ends = counted.groupBy("file", "block").agg(F.max_by("fixed", F.when(F.col("fixed").isNotNull(), F.col("line"))).alias("end"), F.max("swaps").alias("all"))
    ends = ends.withColumn("all", F.sum("all").over(by_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("all")).withColumn(
        "end", F.when(F.col("end").isNotNull(), F.struct(F.col("end.to").alias("to"), (F.col("all") + F.col("end.swaps")).alias("swaps")))
    )
    first = F.last("end", ignorenulls=True).over(earlier)
    starts = ends.select("file", "block", ((F.coalesce(first["to"], F.lit(0)) + F.col("all") - F.coalesce(first["swaps"], F.lit(0))) % 2).alias("first"))
    state = (F.coalesce(F.col("last.to"), F.col("first")) + F.col("swapped") - F.coalesce(F.col("last.swaps"), F.lit(0))) % 2
    inside = placed.join(starts, ["file", "block"]).select(RECORD, "file", "block", "line", (state == 1).alias("goes_on"))

    # Each line's record is known by its first line, in this block or the last one that has a first line.
    own = inside.withColumn("head", F.last(F.when(~F.col("goes_on"), F.col("line")), ignorenulls=True).over(so_far))
    heads = own.groupBy("file", "block").agg(F.max("head").alias("head"))
    heads = heads.withColumn("from", F.last(F.when(F.col("head").isNotNull(), F.struct("block", "head")), ignorenulls=True).over(earlier)).drop("head")
    mine = own.join(heads, ["file", "block"]).withColumn("of", F.when(F.col("head").isNotNull(), F.struct("block", "head")).otherwise(F.col("from")))
    sizes = mine.groupBy("file", "of").agg(F.count("*").alias("lines"), F.max("goes_on").alias("several"))
    several = mine.join(sizes.filter("several").select("file", "of", "lines"), ["file", "of"], "left")
    several = landed(several.select(RECORD, "file", "block", "line", "of", "lines"), "records")

    def ordinal(block: str, line: str) -> Column:
        return F.struct(F.struct(F.col("file").alias("file_path"), F.col(block).alias("file_block_start")).alias("block"), F.col(line).alias("line")).alias(ORDINAL)

    alone = several.filter(f"lines IS NULL AND length({RECORD}) > 0").select(RECORD, ordinal("block", "line"), F.lit(False).alias("is_broken"))
    broken = several.filter(F.col("lines") > most_lines).select(RECORD, ordinal("block", "line"), F.lit(True).alias("is_broken"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", RECORD)))
    joined = several.filter(F.col("lines") <= most_lines).groupBy("file", "of").agg(F.array_join(F.transform(parts, lambda p: p[RECORD]), "\n").alias(RECORD))
    joined = joined.select(RECORD, ordinal("of.block", "of.head"), F.lit(False).alias("is_broken"))
    return alone.unionByName(broken).unionByName(joined)


def scan_lines(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    """(schema's columns, ordinal, record, is_long): every record parsed, too long and broken ones marked.

    A short record is padded with NULL, a field that does not fit its type is NULL. The ordinal
    orders records as they stand in their file. Quoted fields may hold line breaks (``records``).
    """
    rows = records(spark, path)
    if header:
        rows = rows.filter(F.col(RECORD) != ",".join(schema.names))
    bare = F.regexp_replace(RECORD, rf'(^|,)"{_INSIDE}"', "$1")
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    parsed = F.from_csv(RECORD, schema.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "escape": '"'})
    is_long = ((n_fields > len(schema)) | F.col("is_broken")).alias("is_long")
    return rows.select(parsed.alias("r"), ORDINAL, RECORD, is_long).select("r.*", ORDINAL, RECORD, "is_long")


def scan_with_quarantine(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, quarantined lines as they were read)."""
    rows = scan_lines(spark, path, schema, header)
    return rows.filter(~F.col("is_long")).select(*schema.names), rows.filter("is_long").select(RECORD)
