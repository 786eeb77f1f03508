"""Joins of the staged tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The column order of the lookup table.
DIM_LOOKUP_COLUMNS = [
    "cod_ubic",
    "descr_ubic",
    "via_ubic",
    "cod_prov",
    "nom_prov",
    "cod_com",
    "nom_com",
    "cmirl_lat",
    "cmirl_lon",
    "data_disattiv",
    "cod_eu",
    "cod_tzona",
    "tipo_zona",
    "cod_conf",
    "cod_param",
    "cod_ente",
    "descr_ente",
    "t_rete",
    "descr_t_rete",
    "flag_privata",
    "cod_mis",
    "sigla_mis",
    "cod_freq",
    "descr_freq",
    "station_cl_eu",
    "desc_eu",
    "flg_pub",
    "descr_param",
    "sigla_param",
    "cod_metodo",
    "metodo",
    "flag_pubblico",
    "cod_elemento",
    "inquinante",
]

# Rows of a dimension that may be broadcast; they have a few short columns.
SMALL_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint where a count finds ``max_rows`` rows at most.  Runs a job.

    Larger tables are left to Spark: their statistics (or, with AQE, their measured
    shuffle size) decide, and otherwise they are shuffled, where AQE splits a hot key.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Whether a count finds ``max_rows`` rows at most.  Runs a job."""
    return df.limit(max_rows + 1).count() <= max_rows


def data_prep(measurements: DataFrame, configurations: DataFrame, parameters: DataFrame) -> DataFrame:
    """Measurements with the pollutant and frequency of their configuration."""
    # Both dimension tables first: the measurements then meet one small table once.
    series = configurations.select("cod_conf", "cod_ubic", "cod_param", "cod_freq").join(
        parameters.select("cod_param", "sigla_param"), "cod_param"
    )
    return measurements.join(series, ["cod_ubic", "cod_conf"]).select(
        "cod_ubic",
        "cod_conf",
        "cod_param",
        "data_da",
        "data_a",
        "val_param",
        "cod_valid",
        "cod_validaz",
        "cod_validaz_reg",
        "anno",
        "cod_freq",
        "sigla_param",
    )


def dim_lookup(staged: dict[str, DataFrame], bucketed: bool = True) -> DataFrame:
    """One wide descriptive row per configuration.

    Every exchange moves the configurations with all that was joined before, so what is long
    comes late.  Tables found small are broadcast after the last exchange: units, frequencies and
    station classes have few codes, and shuffling on one of them would leave most tasks empty.
    The parameters, which have fewer columns, come before the locations, unless both
    configurations and locations are kept in buckets of the location code (``bucketed``): then
    the locations come first and neither is shuffled for them.  Runs jobs.
    """
    small = {
        name: broadcast_if_small(staged[name])
        for name in ("province", "comuni", "rqa_t_zona")
    }
    location = (
        staged["rqa_ubicazioni"]
        .join(small["comuni"], ["cod_com", "cod_prov"], "left")
        .join(small["province"], "cod_prov")
        .join(small["rqa_t_zona"], "cod_tzona", "left")
    )
    parameter = (
        staged["rqa_parametri"]
        .join(staged["rqa_elementi"], "cod_elemento")
        .join(staged["rqa_metodi"], "cod_metodo")
    )
    owner = staged["rqa_enti"].join(staged["rqa_t_reti"], "t_rete")
    narrow, late = [], []
    for table, key, how in (
        (staged["t_unita_misura"], "cod_mis", "inner"),
        (staged["rqa_t_frequenze"], "cod_freq", "inner"),
        (staged["rqa_t_stclass_eu"], "station_cl_eu", "left"),
        (owner, "cod_ente", "inner"),
    ):
        if is_small(table):
            late.append((F.broadcast(table), key, how))
        else:
            narrow.append((table, key, how))
    by_parameter = [*narrow, (parameter, "cod_param", "inner")]
    by_location = [(location, "cod_ubic", "inner")]
    large = by_location + by_parameter if bucketed else by_parameter + by_location
    rows = staged["rqa_configurazioni"]
    for table, key, how in large + late:
        rows = rows.join(table, key, how)
    return rows.select(*DIM_LOOKUP_COLUMNS)
