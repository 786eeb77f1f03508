"""Raw monitoring dimension tables read out of the order tables.

Each raw table is given by its source table and one SQL expression per raw
column.  The configurations have a row per order line, the locations one per
order, so the lookup joins large tables on real keys.
"""

from pyspark.sql import DataFrame, SparkSession

# Raw table, source table, raw column and its expression.
RAW_TABLES = {
    "rqa_configurazioni": (
        "lineitem",
        {
            "COD_CONF": "l_linenumber",
            "COD_UBIC": "l_orderkey",
            "COD_PARAM": "l_partkey",
            "COD_ENTE": "l_suppkey",
            "COD_MIS": "l_returnflag",
            "COD_FREQ": "l_linestatus",
            "STATION_CL_EU": "cast(l_quantity as int)",
            "FLG_PUB": "l_returnflag",
        },
    ),
    "rqa_ubicazioni": (
        "orders",
        {
            "COD_UBIC": "o_orderkey",
            "DESCR_UBIC": "o_orderpriority",
            "VIA_UBIC": "o_orderstatus",
            "COD_PROV": "month(o_orderdate)",
            "COD_COM": "o_custkey",
            "CMIRL_LAT": "case when o_orderstatus = 'F' then '' else cast(o_totalprice as string) end",
            "CMIRL_LON": "cast(o_custkey as string)",
            "DATA_DISATTIV": "case when o_orderstatus = 'O' then '' else cast(o_orderdate as string) end",
            "COD_EU": "o_orderpriority",
            "COD_TZONA": "day(o_orderdate)",
        },
    ),
    "comuni": ("customer", {"COD_COM": "c_custkey", "NOM_COM": "c_name", "COD_PROV": "c_nationkey"}),
    "province": ("nation", {"COD_PROV": "n_nationkey", "NOM_PROV": "n_name"}),
    "rqa_t_zona": ("nation", {"COD_TZONA": "n_nationkey", "TIPO_ZONA": "n_name"}),
    "rqa_enti": (
        "supplier",
        {
            "COD_ENTE": "s_suppkey",
            "DESCR_ENTE": "s_name",
            "T_RETE": "s_nationkey",
            "FLAG_PRIVATA": "case when s_acctbal < 0 then 'S' else 'N' end",
        },
    ),
    "rqa_t_reti": ("nation", {"T_RETE": "n_nationkey", "DESCR_T_RETE": "n_name"}),
    "rqa_parametri": (
        "part",
        {
            "COD_PARAM": "p_partkey",
            "DESCR_PARAM": "p_name",
            "SIGLA_PARAM": "p_brand",
            "COD_METODO": "p_type",
            "FLAG_PUBBLICO": "case when p_retailprice < 1000 then 'S' else 'N' end",
            "COD_ELEMENTO": "p_size",
        },
    ),
    "rqa_elementi": ("nation", {"COD_ELEMENTO": "n_nationkey", "DESCRIZIONE": "n_name"}),
    "rqa_metodi": ("part", {"COD_METODO": "p_type", "DESCRIZIONE": "lower(p_type)"}),
    "rqa_t_stclass_eu": ("nation", {"ID": "n_nationkey", "DESC_EU": "n_name"}),
    "rqa_t_frequenze": (
        "lineitem",
        {"COD_FREQ": "l_linestatus", "DESCR_FREQ": "lower(l_linestatus)"},
    ),
    "t_unita_misura": (
        "lineitem",
        {"COD_MIS": "l_returnflag", "SIGLA_MIS": "lower(l_returnflag)"},
    ),
    "v_rqa_rete_regionale_ipr": (
        "orders",
        {"COD_UBIC": "o_custkey", "COD_CONF": "o_orderkey", "ANNO": "year(o_orderdate)"},
    ),
    "rqa_dati_aria_cor": (
        "lineitem",
        {
            "COD_UBIC": "l_suppkey",
            "COD_CONF": "l_linenumber",
            "DATA_DA": "cast(l_shipdate as string)",
            "DATA_A": "cast(l_shipdate as string)",
            "VAL_PARAM": "cast(l_quantity as string)",
            "COD_VALID": "cast(l_linenumber - 2 as string)",
            "COD_VALIDAZ": "l_returnflag",
            "COD_VALIDAZ_REG": "l_linestatus",
        },
    ),
}

# Raw tables listed as the distinct values of a larger table.
VALUE_LISTS = ("rqa_metodi", "rqa_t_frequenze", "t_unita_misura")


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    source, columns = RAW_TABLES[name]
    raw = spark.read.parquet(f"{folder}/{source}.parquet").selectExpr(
        *[f"{expr} as {column}" for column, expr in columns.items()]
    )
    return raw.distinct() if name in VALUE_LISTS else raw
