"""CSV sources (the bronze extracts) and the landing writer.

Fields follow RFC 4180: a quote inside a quoted field is doubled, a backslash
is an ordinary character.  Columns are found by name: every file's header line
is read first (its first bytes only), and the files of an extract are scanned
with the column order of their own header, one scan for each order that
occurs.  Names are compared without case and outer spaces; a column that a file
lacks is NULL, one that the table lacks is an error, and so is a name that
occurs twice.  Fields are scanned as text and converted by the declared types:
a field equal to a NULL marker is NULL, and in a number or date column so are
the usual markers of ``NUMBER_NULLS``.  A line with another number of fields,
or with a field that does not convert, is kept whole in ``_corrupt_record``;
the loader quarantines it.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.store import hadoop_path

CORRUPT = "_corrupt_record"

# Markers that can be no value of a number or date column.
NUMBER_NULLS = ("", "NaN", "nan", "NULL", "null", "NA", "N/A", "n/a", "None", "#N/A")

# Fixed file layout of the extracts: source system folder and file name.
SOURCE_FILES = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}


HEADER_BYTES = 1 << 16  # a header line is no longer than this
HEADER_READERS = 16     # files whose headers are read at the same time


def data_files(spark: SparkSession, path: str) -> Iterator[str]:
    """The files that Spark reads under ``path``: none hidden, none empty."""
    root, fs = hadoop_path(spark, path)
    files = fs.listFiles(root, True)
    while files.hasNext():
        st = files.next()
        below = st.getPath().toString().removeprefix(fs.makeQualified(root).toString())
        if st.getLen() and not any(p.startswith(("_", ".")) for p in below.split("/") if p):
            yield st.getPath().toString()


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The column names in the first line of a file."""
    p, fs = hadoop_path(spark, file)
    stream = fs.open(p)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark._jsc.hadoopConfiguration()).getCodec(p)
    if codec is not None:  # by the file's name, as Spark reads it
        stream = codec.createInputStream(stream)
    try:
        head = bytes(stream.readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    line = head.splitlines()[0].decode("utf-8-sig") if head else ""
    return tuple(name.strip().lower() for name in next(csv.reader([line]), []))


def column_orders(spark: SparkSession, path: str, schema: T.StructType) -> dict[tuple[str, ...], list[str]]:
    """The files of an extract by the order of their columns.  What comes to
    the driver is a header line per file, read by ``HEADER_READERS`` threads."""
    files = list(data_files(spark, path))
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), files))
    declared = {f.name.lower(): f.name for f in schema}
    orders: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        unknown = [c for c in header if c not in declared]
        if unknown or len(set(header)) < len(header):
            what = f"unknown columns {unknown}" if unknown else "a column twice"
            raise ValueError(f"{file}: the header has {what}; the table has {list(declared.values())}")
        orders.setdefault(tuple(declared[c] for c in header), []).append(file)
    return orders


def _scan(spark: SparkSession, paths: str | list[str], names: tuple[str, ...], schema: T.StructType,
          markers: tuple[str, ...], mode: str) -> DataFrame:
    """The files of one column order, typed, with ``_corrupt_record``."""
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    raw = (spark.read.option("header", True).option("sep", ",")
           .option("quote", '"').option("escape", '"')
           .option("nullValue", "\x00").option("emptyValue", "")
           .option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT)
           .schema(T.StructType([*text, T.StructField(CORRUPT, T.StringType(), True)])).csv(paths))
    numbers = [f for f in schema if f.name in names and not isinstance(f.dataType, T.StringType)]
    # one conversion per field: the check below looks at its result
    cast = raw.withColumns({f"_v_{f.name}": _converted(f, markers) for f in numbers})
    failed = [F.col(f"_v_{f.name}").isNull() & F.col(f.name).isNotNull()
              & ~F.trim(F.col(f.name)).isin(*markers, *NUMBER_NULLS) for f in numbers]
    line = F.to_csv(F.struct(*[F.col(n) for n in names]), {"escape": '"'})
    bad = reduce(lambda a, b: a | b, failed, F.lit(False))
    corrupt = F.coalesce(F.col(CORRUPT), F.when(bad, line)).alias(CORRUPT)

    def out(f: T.StructField) -> Column:
        if f.name not in names:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        return (F.when(~c.isin(*markers), c) if f not in numbers else F.col(f"_v_{f.name}")).alias(f.name)

    return cast.select(*[out(f) for f in schema], corrupt)


def _converted(field: T.StructField, markers: tuple[str, ...]) -> Column:
    """The field's value; the usual markers convert to nothing by themselves."""
    text = F.trim(F.col(field.name))
    own = [m for m in markers if m not in NUMBER_NULLS]
    return (F.when(~text.isin(*own), text) if own else text).try_cast(field.dataType)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             null_values: tuple[str, ...] = ("",), mode: str = "PERMISSIVE") -> DataFrame:
    """Scan one extract (a file, or a folder of files with headers of their
    own), typed by ``schema``.

    With ``mode="PERMISSIVE"`` the result has an extra ``_corrupt_record``
    column holding the line of rows that did not parse; with ``"FAILFAST"``
    such a line fails the scan.
    """
    orders = column_orders(spark, path, schema)
    names = tuple(f.name for f in schema)
    if len(orders) <= 1:  # the folder as it is: no list of files in the plan
        scans = [_scan(spark, path, next(iter(orders), names), schema, null_values, mode)]
    else:
        scans = [_scan(spark, files, order, schema, null_values, mode) for order, files in orders.items()]
    typed = reduce(DataFrame.unionAll, scans)
    if mode != "PERMISSIVE":
        failed = F.raise_error(F.concat(F.lit("malformed line: "), F.col(CORRUPT))).cast("boolean")
        return typed.filter(F.when(F.col(CORRUPT).isNotNull(), failed).otherwise(True)).drop(CORRUPT)
    return typed


def write_csv(df: DataFrame, path: str, null_value: str = "", append: bool = False,
              compression: str = "none") -> None:
    """Write an extract with a header, keeping leading and trailing spaces."""
    (df.write.option("compression", compression).mode("append" if append else "overwrite").option("header", True)
     .option("quote", '"').option("escape", '"')
     .option("nullValue", null_value)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))
