"""Header-CSV and table sources, with missing-value cells, optional and required paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NA_TOKENS, null_if_token
from ..operators.dedup import union_sources


def read_items(
    spark: SparkSession, path: str, schema: T.StructType, na_tokens: Sequence[str] = NA_TOKENS,
    encoding: str = "UTF-8", multiline: bool = True,
) -> DataFrame:
    """Read a header CSV by column name, as the given types, without inference.

    Columns that the file lacks are NULL and others are not read.  Quoted cells may hold
    line breaks; such a file cannot be split, so set ``multiline=False`` for large files
    without them, or convert to Parquet first.
    """
    raw = spark.read.csv(
        path, header=True, multiLine=multiline, quote='"', escape='"', encoding=encoding,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return raw.select(*[
        (null_if_token(F.col(f"`{f.name}`"), na_tokens) if f.name in raw.columns else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def null_tokens(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Replace missing-value tokens by NULL in string columns."""
    return df.withColumns({c: null_if_token(c, tokens) for c in cols})


def read_required(spark: SparkSession, path: str, schema: T.StructType, hint: str = "", **options) -> DataFrame:
    """:func:`read_items`, or ``FileNotFoundError`` with a hint."""
    try:
        return read_items(spark, path, schema, **options)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no data at {path}. {hint}".strip()) from e


def read_optional(spark: SparkSession, specs: Mapping[str, tuple[str, T.StructType]]) -> DataFrame | None:
    """Union of the sources that exist, in order, with their rank; None if there is none."""
    found = {}
    for name, (path, schema) in specs.items():
        try:
            found[name] = read_required(spark, path, schema)
        except FileNotFoundError:
            continue
    return union_sources(found) if found else None


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_default_column(df: DataFrame, col: str, default: str = "") -> DataFrame:
    """Add a column with a default where the table lacks it."""
    return df if col in df.columns else df.withColumn(col, F.lit(default))


def write_items(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write Parquet, or CSV with a header per file; ``append`` adds files."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"')
    else:
        writer.format(fmt).save(path)
