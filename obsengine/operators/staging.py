"""Staging: cast, rename and clean the raw tables.

Each raw table is described by its output columns; everything else is dropped,
so the projection reaches the Parquet scan.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.functions.scalar import blank_to_null, clamp_code

# Raw column, staged type, staged name where it differs.
STAGING_COLUMNS = {
    "comuni": [("COD_COM", "string"), ("NOM_COM", "string"), ("COD_PROV", "string")],
    "province": [("COD_PROV", "string"), ("NOM_PROV", "string")],
    "rqa_configurazioni": [
        ("COD_CONF", "int"),
        ("COD_UBIC", "string"),
        ("COD_PARAM", "string"),
        ("COD_ENTE", "string"),
        ("COD_MIS", "string"),
        ("COD_FREQ", "string"),
        ("STATION_CL_EU", "string"),
        ("FLG_PUB", "string"),
    ],
    "rqa_dati_aria_cor": [
        ("COD_UBIC", "string"),
        ("COD_CONF", "int"),
        ("DATA_DA", "timestamp_ntz"),
        ("DATA_A", "timestamp_ntz"),
        ("VAL_PARAM", "double"),
        ("COD_VALID", "clamped code"),
        ("COD_VALIDAZ", "string"),
        ("COD_VALIDAZ_REG", "string"),
    ],
    "rqa_elementi": [("COD_ELEMENTO", "string"), ("DESCRIZIONE", "string", "inquinante")],
    "rqa_enti": [
        ("COD_ENTE", "string"),
        ("DESCR_ENTE", "string"),
        ("T_RETE", "string"),
        ("FLAG_PRIVATA", "string"),
    ],
    "rqa_metodi": [("COD_METODO", "string"), ("DESCRIZIONE", "string", "metodo")],
    "rqa_parametri": [
        ("COD_PARAM", "string"),
        ("DESCR_PARAM", "string"),
        ("SIGLA_PARAM", "string"),
        ("COD_METODO", "string"),
        ("FLAG_PUBBLICO", "string"),
        ("COD_ELEMENTO", "string"),
    ],
    "rqa_t_frequenze": [("COD_FREQ", "string"), ("DESCR_FREQ", "string")],
    "rqa_t_reti": [("T_RETE", "string"), ("DESCR_T_RETE", "string")],
    "rqa_t_stclass_eu": [("ID", "string", "station_cl_eu"), ("DESC_EU", "string")],
    "rqa_t_zona": [("COD_TZONA", "string"), ("TIPO_ZONA", "string")],
    "rqa_ubicazioni": [
        ("COD_UBIC", "string"),
        ("DESCR_UBIC", "string"),
        ("VIA_UBIC", "string"),
        ("COD_PROV", "string"),
        ("COD_COM", "string"),
        ("CMIRL_LAT", "double or blank"),
        ("CMIRL_LON", "double or blank"),
        ("DATA_DISATTIV", "timestamp_ntz or blank"),
        ("COD_EU", "string"),
        ("COD_TZONA", "string"),
    ],
    "t_unita_misura": [("COD_MIS", "string"), ("SIGLA_MIS", "string")],
    "v_rqa_rete_regionale_ipr": [
        ("COD_UBIC", "string"),
        ("COD_CONF", "int"),
        ("ANNO", "int"),
    ],
}


def _staged(name: str, kind: str) -> Column:
    col = F.col(name)
    if kind == "clamped code":
        return clamp_code(col)
    if kind.endswith(" or blank"):
        return blank_to_null(col).cast(kind.removesuffix(" or blank"))
    return col.cast(kind)


def typed_select(df: DataFrame, columns: Sequence[tuple]) -> DataFrame:
    """Project to the described columns, cast and renamed (lower case by default)."""
    return df.select(
        *[
            _staged(name, kind).alias(*new_name or [name.lower()])
            for name, kind, *new_name in columns
        ]
    )


def stage(table: str, raw: DataFrame) -> DataFrame:
    """Staged form of one raw table."""
    staged = typed_select(raw, STAGING_COLUMNS[table])
    if table == "rqa_dati_aria_cor":
        staged = staged.withColumn("anno", F.year("data_da"))
    return staged
