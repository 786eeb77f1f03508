"""Successive states of the order tables, for comparing and merging.

Each state is a whole table after a business rule: late orders are not there yet,
small finished ones are archived, prices and notes change.  The rules are SQL that
Spark and other engines read alike.
"""

from pyspark.sql import DataFrame, SparkSession

# The rules, as a projection and a filter per state.
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

SNAPSHOTS = {
    "orders_before": f"""
        select {ORDER_COLUMNS} from orders where o_orderdate < timestamp '1999-01-01 00:00:00'""",
    "orders_after": """
        select o_orderkey, o_custkey,
          case when o_orderstatus = 'P' then null else o_orderstatus end as o_orderstatus,
          case when o_orderpriority = '1-URGENT' then o_totalprice + 10 else o_totalprice end
            as o_totalprice,
          o_orderdate, o_orderpriority,
          case when o_totalprice > 400000 then 'large' end as note
        from orders where not (o_orderstatus = 'F' and o_totalprice < 50000)""",
    "orders_reshaped": """
        select o_orderkey, o_orderdate, o_custkey,
          case when o_orderstatus = 'P' then null else o_orderstatus end as o_orderstatus,
          case when o_orderpriority = '1-URGENT' then o_totalprice + 10 else o_totalprice end
            as price,
          case when o_totalprice > 400000 then 'large' end as note
        from orders where not (o_orderstatus = 'F' and o_totalprice < 50000)""",
    "orders_reformatted": """
        select o_orderkey, o_custkey,
          concat(' ', lower(o_orderstatus)) as o_orderstatus,
          case when o_orderpriority = '1-URGENT' then o_totalprice + 10
               else o_totalprice + 0.001 end as o_totalprice,
          o_orderdate, o_orderpriority
        from orders""",
    "orders_local": """
        select o_orderkey, o_custkey, o_orderstatus,
          case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_totalprice + 10
               else o_totalprice end as o_totalprice,
          o_orderdate, o_orderpriority,
          case when o_totalprice > 400000 then 'large' end as local_note
        from orders where not (o_orderstatus = 'F' and o_totalprice < 50000)""",
    "orders_remote": """
        select o_orderkey, o_custkey,
          case when o_orderstatus = 'P' then 'O' else o_orderstatus end as o_orderstatus,
          case when o_orderpriority = '2-HIGH' then o_totalprice + 20
               when o_orderpriority = '1-URGENT' then o_totalprice + 10
               when o_orderpriority = '3-MEDIUM' then o_totalprice + 5
               else o_totalprice end as o_totalprice,
          o_orderdate, o_orderpriority,
          case when o_totalprice < 60000 then 'small' end as remote_note
        from orders where not (o_orderstatus = 'O' and o_totalprice < 40000)""",
    "customers_before": """
        select c_name, c_nationkey, c_acctbal, c_mktsegment from customer""",
    "customers_after": """
        select concat(upper(c_name), ' ') as c_name, c_nationkey,
          case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as c_acctbal,
          c_mktsegment
        from customer where c_acctbal > -500""",
    "accounts_before": "select c_acctbal, c_mktsegment, c_nationkey from customer",
    "accounts_after": """
        select case when c_mktsegment = 'BUILDING' then c_acctbal + 0.5 else c_acctbal end
            as c_acctbal,
          c_mktsegment, c_nationkey
        from customer where c_acctbal > -500""",
    # A till roll: most lines have many equals, every sixth names an amount.
    "roll_before": """
        select c_custkey as line, c_mktsegment, c_nationkey % 3 as zone,
          case when c_custkey % 6 = 0 then c_acctbal end as amount
        from customer""",
    "roll_after": """
        select c_custkey as line,
          case when c_custkey % 29 = 0 then 'CLOSED' else c_mktsegment end as c_mktsegment,
          c_nationkey % 3 as zone, case when c_custkey % 6 = 0 then c_acctbal end as amount
        from customer where c_custkey % 13 <> 4""",
    "orders_all": f"select {ORDER_COLUMNS} from orders",
    "orders_corrected": """
        select o_orderkey, o_custkey, o_orderstatus,
          case when o_totalprice > 495000 then o_totalprice - 1 else o_totalprice end
            as o_totalprice,
          o_orderdate, o_orderpriority
        from orders where o_totalprice > 2500""",
    "lines_with_blanks": """
        select l_quantity,
          case when l_quantity > 40 or l_discount = 0.05 then null else l_returnflag end as flag,
          case when l_quantity > 40 or l_discount = 0.05 then '' else l_linestatus end as status
        from lineitem""",
}


def snapshot(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One state of a table as a DataFrame."""
    sql = SNAPSHOTS[name]
    source = next(t for t in ("orders", "customer", "lineitem") if f"from {t}" in sql)
    table = spark.read.parquet(f"{folder}/{source}.parquet")
    return spark.sql(sql.replace(f"from {source}", "from {source}"), source=table)
