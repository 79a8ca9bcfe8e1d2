"""Readers for the reference's own input files (FIXTURES.md §1).

All are headerless, comma-separated text. The schemas are fixed values taken
from the reference and stated here as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StringType, StructField, StructType

from ..functions.casts import to_date
from ..operators.ordering import with_row_index
from .csv import read_csv
from .text import read_delimited

# --- fixed values -----------------------------------------------------------
# Labelled numeric points: four float features and a float class.
LABELLED_POINT_COLUMNS = ["x1", "x2", "x3", "x4", "y"]
# Points with a class name.
CLASS_POINT_COLUMNS = ["x1", "x2", "x3", "x4", "label"]
# Connection records: 41 features and the label; positions 1-3 and 41 are text.
CONNECTION_RECORD_COLUMNS = [
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes", "land",
    "wrong_fragment", "urgent", "hot", "num_failed_logins", "logged_in", "num_compromised",
    "root_shell", "su_attempted", "num_root", "num_file_creations", "num_shells",
    "num_access_files", "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate", "srv_rerror_rate",
    "same_srv_rate", "diff_srv_rate", "srv_diff_host_rate", "dst_host_count",
    "dst_host_srv_count", "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate", "dst_host_serror_rate",
    "dst_host_srv_serror_rate", "dst_host_rerror_rate", "dst_host_srv_rerror_rate", "label"]
CONNECTION_TEXT_COLUMNS = ["protocol_type", "service", "flag", "label"]
CONNECTION_NORMAL_LABEL = "normal."
# ---------------------------------------------------------------------------


def _float_schema(names, text=()) -> StructType:
    return StructType([StructField(n, StringType() if n in text else FloatType(), True)
                       for n in names])


def read_labelled_points(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """x1..x4, y (all FLOAT)."""
    return read_csv(spark, path, _float_schema(LABELLED_POINT_COLUMNS), mode=mode)


def read_points_with_class(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """x1..x4 FLOAT, label STRING."""
    return read_csv(spark, path, _float_schema(CLASS_POINT_COLUMNS, ["label"]), mode=mode)


def read_connection_records(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """The 42 connection-record columns, FLOAT except the four text ones."""
    schema = _float_schema(CONNECTION_RECORD_COLUMNS, CONNECTION_TEXT_COLUMNS)
    return read_csv(spark, path, schema, mode=mode)


def read_people(spark: SparkSession, path: str, date_format: str | None = None,
                strict: bool = False) -> DataFrame:
    """``cid,startDate,name`` lines -> cid DOUBLE, startDate DATE, name (stripped).

    ``date_format`` None reads ISO dates; give e.g. "MM/dd/yyyy" for US dates.
    Fields after the third are ignored; missing ones are NULL.
    """
    raw = read_delimited(spark, path, ["cid", "startDate", "name"], ["double", None, None],
                         strip=["name"], strict=strict)
    return raw.withColumn("startDate", to_date("startDate", date_format, strict))


def read_orders_text(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``cid,total[,...]`` lines -> cid DOUBLE, total INT."""
    return read_delimited(spark, path, ["cid", "total"], ["double", "int"], strict=strict)


def read_kmeans_points(spark: SparkSession, path: str, dims: int = 4,
                       strict: bool = True, ids: str = "consecutive") -> DataFrame:
    """Lines of ``dims`` numbers and a class name -> id, features ARRAY<DOUBLE>, label.

    Lines with another field count are dropped (the reference's arity
    filter). ``ids="consecutive"``: the 0-based index in scan order
    (``zipWithIndex``; one range shuffle and a checkpoint of the points);
    ``ids="unique"``: ``monotonically_increasing_id``, no shuffle, enough for
    the k-means loop, which only needs distinct ids. A number that does not
    parse fails the job when ``strict`` (as ``float()`` does in the
    reference), else becomes NULL.
    """
    names = [f"x{j}" for j in range(dims)] + ["label"]
    rows = read_delimited(spark, path, names, ["double"] * dims + [None], arity=dims + 1,
                          strict=strict)
    rows = rows.select(F.array(*names[:-1]).alias("features"), "label",
                       F.monotonically_increasing_id().alias("_scan"))
    if ids == "unique":
        return rows.select(F.col("_scan").alias("id"), "features", "label")
    if ids != "consecutive":
        raise ValueError("ids must be 'consecutive' or 'unique'")
    return with_row_index(rows, "_scan", name="id").drop("_scan").select("id", "features", "label")
