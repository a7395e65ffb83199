"""Reading, validating and deduplicating labelled text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.sources.quoted_csv import CSV_OPTIONS, largest_file, read_quoted_csv

REQUIRED_COLUMNS = ("review", "sentiment")

# Cell texts a CSV reader takes for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Column holding the reading order of rows that came without an id.
POSITION = "__position"


def read_table(
    spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = True, na_to_null: bool = True,
    split: bool | None = None, position: str | None = None,
) -> DataFrame:
    """Read a CSV (quotes doubled, newlines allowed inside quotes), Parquet, JSON or ORC table.

    Every CSV column is read as text. ``split`` reads a CSV with ``multiline`` in many tasks a file,
    which scans it twice, instead of one task a file; the rows are the same. Unless told, it is done
    where a file is larger than a scan partition. ``position`` names a column for the reading order.
    """
    if fmt == "csv" and multiline and split is None:
        split = largest_file(spark, path) > _partition_bytes(spark)
    if fmt == "csv" and multiline and split:
        df = read_quoted_csv(spark, path, position)
    else:
        options = {"header": True, **CSV_OPTIONS, "multiLine": multiline} if fmt == "csv" else {}
        df = spark.read.format(fmt).options(**options).load(path)
        if position:
            df = df.withColumn(position, _reading_order())
    if fmt == "csv" and na_to_null:
        cells = [c for c in df.columns if c != position]
        df = df.select(
            [F.when(~F.col(c).isin(list(NA_TOKENS)), F.col(c)).alias(n) for n, c in zip(cells, map(_quoted, cells))]
            + ([position] if position else [])
        )
    return df


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _partition_bytes(spark: SparkSession) -> int:
    """Bytes of a scan partition, as the session states them (``134217728b``, ``128MB``)."""
    stated = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(stated[-1:], 0)
    return int(stated.rstrip("kmgt")) << unit


def normalize_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Strip and lower-case column names, then require ``required``."""
    names = [name.strip().lower() for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns {df.columns} give {twice} more than once")
    renamed = df.toDF(*names)
    missing = sorted(set(required) - set(renamed.columns))
    if missing:
        raise ValueError(f"missing column(s) {missing}; found columns {renamed.columns}")
    return renamed


def drop_missing(df: DataFrame, columns: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(columns))


def dedupe_reviews(df: DataFrame, text: str = "review", order: str = "id") -> DataFrame:
    """Keep the row with the lowest ``order`` of every text.

    An aggregate rather than a window: copies collapse on the map side, so a text that makes up a
    third of the table sends one row per task. The hash leads the key, which keeps sorting and
    comparing cheap when texts share long beginnings.
    """
    rest = [F.col(f"`{name}`") for name in df.columns if name != text]
    first = F.min_by(F.struct(*rest), F.col(f"`{order}`")).alias("first")
    kept = df.groupBy(F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`")).agg(first)
    return kept.select([F.col(f"`{name}`") if name == text else F.col(f"first.`{name}`") for name in df.columns])


def load_audit(raw: DataFrame, loaded: DataFrame) -> DataFrame:
    before = raw.agg(F.count(F.lit(1)).alias("rows_before"))
    after = loaded.agg(F.count(F.lit(1)).alias("rows_after"))
    return before.crossJoin(after).withColumn(
        "rows_dropped", F.col("rows_before") - F.col("rows_after")
    )


def _reading_order() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def load_reviews(
    spark: SparkSession, path: str, fmt: str = "csv", id_col: str | None = None, **read_options
) -> DataFrame:
    """Load, validate, drop rows with missing values and repeated texts.

    ``id_col`` names a unique column that orders copies. Without one, copies are ordered by file
    and position, and ``id`` becomes a digest of the text: it does not depend on how the files
    were split, so samples drawn from it are stable.
    """
    position = POSITION if id_col is None else None
    df = normalize_columns(read_table(spark, path, fmt, position=position, **read_options))
    if id_col is not None:
        wanted = id_col.strip().lower()
        if wanted not in df.columns:
            raise ValueError(f"missing id column {id_col!r}; found columns {df.columns}")
        if fmt == "csv":
            # Ids that are all numbers are numbers; any other ids stay text.
            text_ids = df.where(F.col(f"`{wanted}`").isNotNull() & F.col(f"`{wanted}`").try_cast("bigint").isNull())
            if text_ids.isEmpty():
                df = df.withColumn(wanted, F.col(f"`{wanted}`").cast("bigint"))
        return dedupe_reviews(drop_missing(df.withColumnRenamed(wanted, "id")), order="id")
    df = dedupe_reviews(drop_missing(df), order=POSITION).drop(POSITION)
    return df.withColumn("id", F.md5("review")) if "id" not in df.columns else df


def raw_reviews(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Bind a document table and its quality labels to ``(id, review, sentiment)``."""
    quality = labels.select("doc_id", "quality")
    return documents.select("doc_id", "text").join(quality, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("review"),
        F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative").alias("sentiment"),
    )


def reviews(raw: DataFrame) -> DataFrame:
    """Missing values go first, so a labelled copy is never lost to an unlabelled one."""
    return dedupe_reviews(drop_missing(raw))
