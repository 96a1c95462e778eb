"""Source and sink bindings: round trips through the shared scratch folder.

Each binding writes a whole table under ``spark.checkpoint.dir`` (a fresh
path per call) and reads it back with the package readers; the oracle is the
table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import safe_cast
from ..session import scratch_path
from ..sources import files
from ..sources.multiline import read_multiline
from .star import _r, query, table

ORACLE_IO: dict[str, str] = {}

# A text field with a comma, doubled quotes and a newline inside it.
_NOTE_SQL = "p_name || ', \"' || p_type || '\"' || chr(10) || p_brand"


def _part_with_note(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.withColumn("note", F.concat("p_name", F.lit(', "'), "p_type", F.lit('"'),
                                         F.lit("\n"), "p_brand"))


_PART_TYPES = {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"}


@query
def src_raw_csv(spark, sf_dir):
    path = scratch_path(spark, "src_raw_csv")
    files.write_table(_part_with_note(spark, sf_dir), path, fmt="csv")
    raw = files.read_raw(spark, path)
    return _r(safe_cast(raw, _PART_TYPES))


ORACLE_IO["src_raw_csv"] = f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice, 6) AS p_retailprice,
       {_NOTE_SQL} AS note
FROM part
"""

@query
def src_raw_csv_parallel(spark, sf_dir):
    """One CSV file with line breaks, commas and quotes inside quoted fields, read by as many tasks as it has blocks."""
    path = scratch_path(spark, "src_raw_csv_parallel")
    files.write_single_csv(_part_with_note(spark, sf_dir), path)
    return _r(safe_cast(read_multiline(spark, path), _PART_TYPES))


ORACLE_IO["src_raw_csv_parallel"] = ORACLE_IO["src_raw_csv"]

_CUSTOMER_DDL = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                 "c_mktsegment STRING")


@query
def src_typed_csv(spark, sf_dir):
    path = scratch_path(spark, "src_typed_csv")
    files.write_table(table(spark, sf_dir, "customer"), path, fmt="csv")
    return _r(files.read_typed(spark, path, schema=_CUSTOMER_DDL))


ORACLE_IO["src_typed_csv"] = """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer
"""

_ORDER_NAMES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query
def src_apply_header(spark, sf_dir):
    path = scratch_path(spark, "src_apply_header")
    o = table(spark, sf_dir, "orders").select(*_ORDER_NAMES)
    files.write_table(o, path, fmt="csv", header=False)
    raw = files.apply_header(files.read_raw(spark, path, header=False), _ORDER_NAMES)
    return _r(safe_cast(raw, {"o_orderkey": "bigint", "o_custkey": "bigint",
                              "o_totalprice": "double"}))


ORACLE_IO["src_apply_header"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderpriority
FROM orders
"""

_LINE_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]


@query
def snk_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "snk_roundtrip")
    li = table(spark, sf_dir, "lineitem").select(*_LINE_COLS)
    files.write_table(li, path, partition_by=["l_returnflag"])
    return _r(spark.read.parquet(path).select(*_LINE_COLS))


ORACLE_IO["snk_roundtrip"] = """
SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, l_returnflag FROM lineitem
"""


@query
def snk_single_csv(spark, sf_dir):
    path = scratch_path(spark, "snk_single_csv")
    files.write_single_csv(table(spark, sf_dir, "nation"), path)
    back = files.read_typed(spark, path, schema="n_nationkey INT, n_name STRING, n_regionkey INT")
    n_files = back.select(F.input_file_name().alias("f")).distinct().count()
    if n_files != 1:
        raise RuntimeError(f"expected one CSV part file, found {n_files}")
    return back


ORACLE_IO["snk_single_csv"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


_LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def src_numeric_stats(spark, sf_dir):
    """Headerless text file -> canonical names by position -> typed describe."""
    from ..operators.distribution import describe_table
    path = scratch_path(spark, "src_numeric_stats")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE_NUMERIC)
    files.write_table(li, path, fmt="csv", header=False)
    raw = files.apply_header(files.read_raw(spark, path, header=False), ["l_orderkey"] + _LINE_NUMERIC)
    return _r(describe_table(safe_cast(raw, _LINE_NUMERIC), _LINE_NUMERIC))


ORACLE_IO["src_numeric_stats"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, round(max({c}), 6) AS max "
    f"FROM lineitem" for c in _LINE_NUMERIC)
