"""Text files to typed tables: scan as text, check the contract, cast strictly, gate, load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeep.functions import matches
from stallkeep.sources.contracts import DAY, STAMP, TEXT, WHOLE, Contract

# Texts that a scan reads as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_MALFORMED = "_malformed_line"
# An offset or zone behind a time of day.
_ZONE = r"\d:\d{1,2}(:[\d.]*)?\s*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)\s*$"


class ContractError(ValueError):
    """The source does not keep its contract."""


def _reader(spark: SparkSession, contract: Contract):
    return (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", contract.multiline)
        # A line must be read whole to tell whether it has too many or too few fields.
        .option("columnPruning", False)
    )


def _raw_lines(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Every column as text, and the line itself where it does not have one field per column.

    With ``enforceSchema`` off, Spark compares the header of every file in the
    path with the contract, not only the first one's.
    """
    check_header(spark, path, contract)
    schema = T.StructType([*contract.text_schema.fields, T.StructField(_MALFORMED, T.StringType())])
    reader = _reader(spark, contract).option("enforceSchema", False).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", _MALFORMED).schema(schema).csv(path)


def check_header(spark: SparkSession, path: str, contract: Contract) -> None:
    """The file must exist and its header must equal the contract, order included."""
    try:
        actual = _reader(spark, contract).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    if actual != contract.column_names:
        raise ContractError(f"{contract.name}: expected columns {contract.column_names}, found {actual}")


def scan_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Every column as text; the usual spellings of a missing value become NULL.

    A line with too many or too few fields, or with a quote that never closes,
    fails the job with the name of the data set and the line.
    """
    line = F.col(_MALFORMED)
    complaint = F.concat(F.lit(f"{contract.name}: malformed line: "), line, _beside_line(contract))
    sound = F.when(line.isNotNull(), F.raise_error(complaint).cast("boolean")).otherwise(F.lit(True))
    return _raw_lines(spark, path, contract).filter(sound).select(
        *[F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c)).alias(c) for c in contract.column_names]
    )


def malformed_lines(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """How many lines the scan would refuse, and how many there are, without failing."""
    raw = _raw_lines(spark, path, contract)
    refused = F.count(F.when(F.col(_MALFORMED).isNotNull(), _beside_line(contract)))
    return raw.agg(refused.alias("MalformedLines"), F.count(F.lit(1)).alias("Lines"))


def _beside_line(contract: Contract) -> Column:
    """Always empty; Spark does not scan text files for the malformed line alone."""
    return F.substring(F.coalesce(F.col(contract.column_names[0]), F.lit("")), 1, 0)


def lenient_cast(text: Column, role: str) -> Column:
    """The typed value, or NULL where the text is not one."""
    if role == STAMP:
        return text.try_cast("timestamp_ntz")
    if role == DAY:
        return text.try_cast("timestamp_ntz").cast("date")
    if role == WHOLE:
        number = F.trim(text).try_cast("decimal(38,18)")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return F.nullif(F.trim(text), F.lit("")).try_cast(role)


def _loses(text: Column, role: str) -> Column:
    """Whether the typed value would be less than the text says."""
    value = lenient_cast(text, role)
    if role in (STAMP, DAY):
        zoned = text.rlike(_ZONE)
        return zoned | (value != text.try_cast("timestamp_ntz")) if role == DAY else zoned
    if role.startswith("decimal"):
        scale = int(role.rstrip(")").rpartition(",")[2])
        digits = F.length(F.regexp_extract(F.trim(text), r"\.([0-9]*?)0*$", 1))
        return (digits > scale) | (value != F.trim(text).try_cast(f"decimal(38,{min(scale + 10, 28)})"))
    return F.lit(False)


def _unreadable(text: Column, role: str) -> Column:
    """A text that is no value of the role, or more than one can hold (digits, an offset, a time of day)."""
    blank = F.trim(text) == "" if role.startswith("decimal") else F.lit(False)
    lost = F.coalesce(_loses(text, role), F.lit(False))
    return text.isNotNull() & ~blank & (lenient_cast(text, role).isNull() | lost)


def typed(raw: DataFrame, contract: Contract) -> DataFrame:
    """Cast every column to its role; a value that cannot be read fails the job."""
    columns = []
    for name, role in contract.columns:
        text = F.col(name)
        if role == TEXT:
            columns.append(text)
            continue
        complaint = F.concat(F.lit(f"{contract.name}.{name}: not a valid {role}: "), text)
        columns.append(
            F.when(_unreadable(text, role), F.raise_error(complaint)).otherwise(lenient_cast(text, role)).alias(name)
        )
    return raw.select(*columns)


def cast_failures(raw: DataFrame, contract: Contract) -> DataFrame:
    """Unreadable values per typed column, in one pass and without failing."""
    measures = [
        matches(_unreadable(F.col(name), role)).alias(name) for name, role in contract.columns if role != TEXT
    ]
    return raw.agg(*measures)


def key_gate(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with a NULL in the key and rows beyond the first of each key, from one grouping."""
    grouped = df.groupBy(*key).agg(F.count("*").alias("_rows"))
    incomplete = F.lit(False)
    for column in key:
        incomplete = incomplete | F.col(column).isNull()
    return grouped.agg(
        F.coalesce(F.sum(F.when(incomplete, F.col("_rows"))), F.lit(0)).alias("NullKeyRows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("DuplicateKeyRows"),
    )


def check_key(df: DataFrame, contract: Contract) -> None:
    """Fail on NULL or repeated keys; data sets without a key are not checked."""
    if not contract.key:
        return
    result = key_gate(df, contract.key).first()
    if result.NullKeyRows:
        raise ContractError(f"{contract.name}: NULL in key columns {list(contract.key)}: {result.NullKeyRows} rows")
    if result.DuplicateKeyRows:
        raise ContractError(f"{contract.name}: duplicate key rows: {result.DuplicateKeyRows}")


def load_table(df: DataFrame, path: str, name: str) -> DataFrame:
    """Write to a new path and read back; the rows stored must equal the rows written.

    The source count is observed by the writing job itself, so the source is
    not scanned a second time.
    """
    source = Observation(f"load {name}")
    df.observe(source, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    loaded, expected = stored.count(), source.get["rows"]
    if loaded != expected:
        raise ContractError(f"{name}: {expected} source rows but {loaded} loaded rows")
    return stored


def ingest(spark: SparkSession, path: str, contract: Contract, target: str) -> DataFrame:
    """The whole way from a text file to a checked table at ``target``.

    Keys are gated on the stored rows, before the caller publishes them, so
    the text is parsed only once.
    """
    stored = load_table(typed(scan_csv(spark, path, contract), contract), target, contract.name)
    check_key(stored, contract)
    return stored
