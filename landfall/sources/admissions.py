"""Raw admission records.

The source format is a parameter: Parquet, CSV, ORC, SAS7BDAT (the library's own
page-range source) or any Spark data source on the classpath. Only contract
columns are selected, so Catalyst prunes every other column at the scan (the SAS
source is told the columns); the undocumented raw fields are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from landfall.contracts import ADMISSIONS_REQUIRED, RAW_ADMISSIONS_COLUMNS
from landfall.sources import sas7bdat
from landfall.sources.delimited import require_columns


def load_raw_admissions(spark: SparkSession, uri: str | Sequence[str], fmt: str = "parquet",
                        columns: Sequence[str] | None = None,
                        options: dict[str, str] | None = None) -> DataFrame:
    """Load raw admissions: all 20 contract columns, or ``columns``.

    Every wanted column must be present, else the missing ones are named in an
    error; a narrower source needs its column list spelled out, which must
    hold what the fact job cannot do without (``cicid``, ``arrdate``,
    ``depdate``, ``dtaddto``).
    For ``fmt='csv'`` a header is expected and a leading index column
    (``_c0``) is ignored. ``fmt='sas7bdat'`` reads SAS files by page ranges.
    """
    wanted = list(columns) if columns is not None else RAW_ADMISSIONS_COLUMNS
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    elif fmt == sas7bdat.FORMAT:
        sas7bdat.register(spark)
        reader = reader.option("columns", ",".join(wanted))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(uri)
    if "_c0" in df.columns:
        df = df.drop("_c0")
    left_out = [c for c in ADMISSIONS_REQUIRED if c not in wanted]
    if left_out:
        raise ValueError(f"raw admissions: the column list lacks {left_out}")
    require_columns(df, wanted, "raw admissions")
    return df.select(*wanted)
