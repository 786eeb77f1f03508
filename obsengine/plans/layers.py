"""All layers in dependency order: staged, prepared, indicators, published."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from obsengine.operators.daily_mean import daily_mean_levels
from obsengine.operators.prep import data_prep, dim_lookup
from obsengine.operators.quality import assert_unique, has_unique_hours
from obsengine.operators.rolling import moving_mean
from obsengine.operators.spine import SPINE_END, SPINE_START, date_spine
from obsengine.operators.staging import STAGING_COLUMNS, stage
from obsengine.plans.marts import fct_annual, fct_daily
from obsengine.plans.no2 import no2_annual, no2_daily
from obsengine.plans.o3 import o3_annual, o3_daily
from obsengine.sources.stores import CatalogStore, FolderStore, view

# Layer names.
BRONZE, SILVER, GOLD, UTILITIES = "bronze", "silver", "gold", "utilities"

PREP_TABLES = ("rqa_dati_aria_cor", "rqa_configurazioni", "rqa_parametri")
#: Tables that meet on a key of many values, and that key.
BUCKETED = {"rqa_configurazioni": ["cod_ubic"], "rqa_ubicazioni": ["cod_ubic"]}
_LOOKUP_TABLES = set(STAGING_COLUMNS) - {"rqa_dati_aria_cor", "v_rqa_rete_regionale_ipr"}


def build_layers(
    raw: dict[str, DataFrame],
    store: FolderStore | CatalogStore,
    start: datetime = SPINE_START,
    end: datetime = SPINE_END,
    tables: Sequence[str] = tuple(STAGING_COLUMNS),
) -> dict[str, DataFrame]:
    """Build and store every table from the raw ones; runs jobs.

    ``tables`` names the raw tables to stage; one that ``raw`` lacks is an error.

    The prepared measurements have many readers, so they are written once, by
    pollutant: each reader then scans its own folders only.  Their key is checked
    on the written table, which also tells whether the copy merge can be saved.
    Configurations and locations are kept by location code where the store can.  The lookup table is built when ``tables`` has all its raw tables.
    """
    missing = sorted({*tables, *PREP_TABLES} - set(raw))
    if missing:
        raise ValueError(f"raw tables are missing: {', '.join(missing)}")
    out = {
        name: store.table(BRONZE, name, stage(name, raw[name]), bucket_by=BUCKETED.get(name, ()))
        for name in STAGING_COLUMNS
        if name in tables or name in PREP_TABLES
    }
    spark = out[PREP_TABLES[0]].sparkSession
    out["hourly_spine"] = store.table(
        UTILITIES, "hourly_spine", date_spine(spark, "hour", start, end)
    )
    prep = store.table(
        SILVER, "data_prep", data_prep(*[out[t] for t in PREP_TABLES]), ["sigla_param"]
    )
    unique = has_unique_hours(prep)
    if not unique:
        assert_unique(prep)
    out["data_prep"] = prep
    if set(out) >= _LOOKUP_TABLES:
        lookup = dim_lookup(out, bucketed=isinstance(store, CatalogStore))
        out["data_lookup"] = store.table(SILVER, "data_lookup", lookup)
    means = store.table(SILVER, "daily_mean", daily_mean_levels(prep))
    moving = store.table(
        SILVER, "moving_mean", moving_mean(prep, start, end, unique_hours=unique)
    )
    out |= {"daily_mean": means, "moving_mean": moving}
    out["o3_daily"] = view("o3_daily", o3_daily(prep, moving, unique))
    out["no2_daily"] = view("no2_daily", no2_daily(prep, means, unique))
    out["o3_annual"] = view("o3_annual", o3_annual(prep, moving, unique))
    out["no2_annual"] = view("no2_annual", no2_annual(prep, unique))
    daily = fct_daily(out["o3_daily"], out["no2_daily"])
    annual = fct_annual(out["o3_annual"], out["no2_annual"])
    out["fct_daily"] = store.table(GOLD, "fct_daily", daily)
    out["fct_annual"] = store.table(GOLD, "fct_annual", annual)
    return out
