"""Employee and payroll lines derived from the TPC-H-style test tables.

The given tables hold no payroll data, so the two input files are built from
``customer`` (one employee per customer) and ``orders`` (one payroll line per
order), with every validation class made from the key. All rows of both tables
are used; nothing is sampled or filtered away.

Employee line by ``c_custkey % 20``: 0 blank, 1 three fields, 2 empty department,
3 padded with tabs and spaces, 4 a second line with the same id (duplicate),
5 an id in another namespace (``EMX``), so that employee has no payroll and that
customer's orders have no employee; otherwise a good line.

Payroll line by ``o_orderkey % 50``: 0 blank, 1 four fields, 2 empty month,
3 text salary, 4 negative salary, 5 decimal, 6 lone ``+``, 7 above int32,
8 text salary and negative bonus, 9 padded with a ``+00`` prefix, 10 int32 max
(the sum overflows int32); otherwise good. One order in three is booked on
employee ``EMP000007``, a hot key with a third of all payroll rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salaria import schema as S

TAB = "\t"
HOT_CUSTKEY = 7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cases(selector: Column, cases: dict[int, Column], default: Column) -> Column:
    expr = None
    for value, result in cases.items():
        expr = F.when(selector == value, result) if expr is None else expr.when(selector == value, result)
    return expr.otherwise(default)


def employee_lines(customer: DataFrame) -> DataFrame:
    """One or two employee lines per customer, column ``line``."""
    key = F.col("c_custkey")
    k = key.cast("string")
    e = F.lpad(k, 6, "0")
    seg = F.col("c_mktsegment")
    lit = F.lit
    line = _cases(
        key % 20,
        {
            0: lit("   "),
            1: F.concat(lit("EMP"), e, lit(",OnlyFirst,HR")),
            2: F.concat(lit("EMP"), e, lit(",First,Last,  ")),
            3: F.concat(lit(TAB + "EMP"), e, lit(" , First ,Last"), k, lit(TAB + ","), seg, lit(" ")),
            5: F.concat(lit("EMX"), e, lit(",First,Last"), k, lit(","), seg),
        },
        F.concat(lit("EMP"), e, lit(",First,Last"), k, lit(","), seg),
    )
    second = F.concat(lit("EMP"), e, lit(",Second,Last"), k, lit(",ZDEPT"))
    lines = F.when(key % 20 == 4, F.array(line, second)).otherwise(F.array(line))
    return customer.select(F.explode(lines).alias(S.LINE))


def payroll_lines(orders: DataFrame) -> DataFrame:
    """One payroll line per order, column ``line``."""
    okey = F.col("o_orderkey")
    k = okey.cast("string")
    cust = F.when(okey % 3 == 0, F.lit(HOT_CUSTKEY).cast("bigint")).otherwise(F.col("o_custkey"))
    e = F.lpad(cust.cast("string"), 6, "0")
    m = F.concat(F.lit("M"), F.month("o_orderdate").cast("string"))
    b = F.floor("o_totalprice").cast("bigint").cast("string")
    x = (okey % 1000).cast("string")
    lit = F.lit
    head = F.concat(lit("PR"), k, lit(",EMP"), e, lit(","))
    line = _cases(
        okey % 50,
        {
            0: lit(""),
            1: F.concat(head, m, lit(","), b),
            2: F.concat(head, lit(" ,"), b, lit(","), x),
            3: F.concat(head, m, lit(",INVALID,"), x),
            4: F.concat(head, m, lit(",-"), b, lit(","), x),
            5: F.concat(head, m, lit(",8000.5,"), x),
            6: F.concat(head, m, lit(",+,"), x),
            7: F.concat(head, m, lit(",2147483648,"), x),
            8: F.concat(head, m, lit(",INVALID,-1")),
            9: F.concat(lit(TAB + "PR"), k, lit(" , EMP"), e, lit(" ,"), m, lit(TAB + ", +00"), b, lit(" , "), x, lit(" ")),
            10: F.concat(head, m, lit(",2147483647,"), x),
        },
        F.concat(head, m, lit(","), b, lit(","), x),
    )
    return orders.select(line.alias(S.LINE), okey.alias(S.LINE_ID))


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that yields fewer partitions than there are cores.

    Each test table is one Parquet row group, which Spark cannot split, so all
    line generation and parsing would otherwise run in a single task. A table of
    many files or row groups is returned as it is (no shuffle).
    """
    from salaria.plans.scratch import default_parallelism

    cores = default_parallelism(df.sparkSession)
    try:
        partitions = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (Spark Connect): leave the scan as it is
        return df
    return df if partitions >= cores else df.repartition(cores, key)


def testdata_employee_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee lines of a test-data folder; only the needed columns are read."""
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return employee_lines(_spread(customer, "c_custkey"))


def testdata_payroll_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll lines of a test-data folder; only the needed columns are read."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return payroll_lines(_spread(orders, "o_orderkey"))


def testdata_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(employee lines, payroll lines) for a test-data folder."""
    return testdata_employee_lines(spark, sf_dir), testdata_payroll_lines(spark, sf_dir)
