"""Dirty input derived from the clean test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cleargrist.functions import named
from cleargrist.operators.quality import CleaningRules
from cleargrist.sinks.writers import write_table
from cleargrist.workspace import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a row of the materials contract, with faults worked in.

    Some ids are no number and some are decimals, some names and categories are missing, names
    are padded and in capitals, some quantities are no number, and four columns are sparse.
    """
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as `Unnamed: 0`",
        """case when p_partkey % 17 = 0 then concat('bad', p_partkey)
                when p_partkey % 13 = 0 then concat(p_partkey, '.0')
                else cast(p_partkey as string) end as id""",
        """case when p_partkey % 19 = 0 then null
                else concat('  ', upper(replace(p_name, ' ', '   ')), ' ') end as name""",
        "p_name as description",
        "cast(null as string) as long_description",
        "cast(p_size as string) as customer_part_id",
        "p_brand as manufacturer_name",
        "cast(p_partkey as string) as manufacturer_part_id",
        "case when p_partkey % 20 = 0 then 'acme corp' end as competitor_name",
        "cast(null as string) as competitor_part_name",
        "cast(null as string) as competitor_part_id",
        "case when p_partkey % 23 = 0 then null else lower(p_type) end as category",
        "'EA' as unit_of_measure",
        "case when p_partkey % 7 = 0 then 'n/a' else cast(p_size as string) end as unit_quantity",
        "cast(p_size * 2 as string) as requested_quantity",
        "cast(p_retailprice as string) as requested_unit_price",
    )


def dirty_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as text, with faults worked in: a large table of another shape."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        """case when l_orderkey % 11 = 0 then concat('#', l_orderkey)
                else cast(l_orderkey as string) end as order_id""",
        "case when l_suppkey % 23 = 0 then null else cast(l_suppkey as string) end as supplier",
        "concat('  ', lower(l_returnflag), '   ', lower(l_linestatus), ' ') as status",
        "cast(l_quantity as string) as quantity",
        "case when l_partkey % 7 = 0 then 'n/a' else cast(l_extendedprice as string) end as price",
        "case when l_linenumber = 7 then 'last line' end as note",
    )


def ragged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty materials as lines of CSV without a header, some with too many or too few fields."""
    source = dirty_materials(spark, sf_dir)
    fields = [F.coalesce(named(c), F.lit("")) for c in source.columns]
    key = F.col("manufacturer_part_id").cast("int")
    line = F.concat_ws(",", *fields)
    return source.select(
        F.when(key % 29 == 0, F.concat(line, F.lit(",surplus,field")))
        .when(key % 31 == 0, F.concat_ws(",", *fields[:-2]))
        .otherwise(line)
        .alias("value")
    )


ORDER_LINE_RULES = CleaningRules(
    text=("status", "note"),
    integers=("order_id", "quantity"),
    doubles=("price",),
    required=("order_id", "supplier"),
    output=("order_id", "supplier", "status", "quantity", "price", "note"),
)

ORDER_LINE_CONTRACT = StructType([StructField(c, StringType()) for c in ORDER_LINE_RULES.output])


def stored(
    df: DataFrame, fmt: str, label: str, mode: str = "overwrite", partition_by: str | None = None
) -> str:
    """Write a table to a new scratch folder and return its path."""
    path = scratch_path(df.sparkSession, label)
    write_table(df, path, fmt, mode, partition_by)
    return path
