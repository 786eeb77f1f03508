"""The registered queries: every operator over whole tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsengine.functions.scalar import (
    available_year_days,
    pct_validity,
    validity_flag,
)
from obsengine.functions.windows import consecutive_sum, run_hits
from obsengine.operators.daily_mean import daily_mean, daily_mean_levels
from obsengine.operators.hourly import (
    annual_figures,
    daily_figures,
    exceeds,
    level_hours,
    with_year_to_date,
)
from obsengine.operators.indicators import unpivot_indicators
from obsengine.operators.levels import LEVELS, explode_levels, sum_by_level
from obsengine.operators.percentiles import exact_percentiles
from obsengine.operators.prep import data_prep, dim_lookup
from obsengine.operators.quality import duplicate_keys
from obsengine.operators.rolling import moving_mean
from obsengine.operators.spine import date_spine, gap_fill, spine_hours
from obsengine.operators.staging import STAGING_COLUMNS, stage
from obsengine.operators.tablediff.columns import column_changes
from obsengine.operators.tablediff.compare import (
    diff_columns,
    diff_rows,
    diff_summary,
    unequal_summary,
    with_listed,
)
from obsengine.operators.tablediff.context import drop_blank_rows, prune_columns, with_context
from obsengine.operators.tablediff.equality import Equality
from obsengine.operators.tablediff.keyless import diff_keyless
from obsengine.operators.tablediff.merge import (
    diff3,
    merge3,
    three_way_patch,
    with_conflict_texts,
)
from obsengine.operators.tablediff.patch import apply_patch, with_schema_rows
from obsengine.plans.layers import PREP_TABLES, build_layers
from obsengine.plans.marts import fct_annual, fct_daily
from obsengine.plans.no2 import DAILY_INDICATORS as NO2_DAILY
from obsengine.plans.no2 import no2_annual, no2_daily, nox_annual
from obsengine.plans.o3 import o3_annual, o3_daily
from obsengine.schema import LEVEL, SERIES
from obsengine.session import fresh_folder
from obsengine.sources import events as ev
from obsengine.sources.formats import SEPARATORS, read_table, write_table
from obsengine.sources.snapshots import snapshot
from obsengine.sources.stores import FolderStore
from obsengine.sources.tables import ingest_tables, load_tables
from obsengine.sources.trade import RAW_TABLES, raw_table

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, folder: str, *pollutants: str) -> DataFrame:
    events = ev.table(spark, folder, "events")
    return ev.of_pollutants(events, *pollutants) if pollutants else events


def _observations(spark: SparkSession, folder: str, *pollutants: str) -> DataFrame:
    return ev.observations(_events(spark, folder, *pollutants))


def _moving(spark: SparkSession, folder: str, prep: DataFrame, *pollutants: str) -> DataFrame:
    start, end = ev.event_period(_events(spark, folder))
    return moving_mean(
        prep, start, end, pollutants=pollutants or ("CO", "O3"), unique_hours=True
    )


def q_level_filter(spark, folder):
    rows = ev.event_measurements(_events(spark, folder))
    return explode_levels(rows).select(*SERIES, "data_da", "val_param", LEVEL)


def _by_day(rows):
    return rows.withColumn("data_day", F.col("data_da").cast("date")), [*SERIES, "data_day"]


def q_exceedance_counts(spark, folder):
    rows, keys = _by_day(ev.event_measurements(_events(spark, folder)))
    value = F.col("val_param")
    limits = (100, 140, 180, 200, 240, 400)
    return sum_by_level(
        rows,
        keys,
        {"n_values": value.isNotNull().cast("bigint")}
        | {f"over_{t}": exceeds(value, t) for t in limits},
    )


def q_consecutive_3h(spark, folder):
    hours = level_hours(_observations(spark, folder, "O3"), "O3", "data_day")
    flag = exceeds(F.col("val_param"), 240)
    run = consecutive_sum(F.col("flag"), SERIES + ["data_day", LEVEL], ["data_da"])
    return hours.withColumn("flag", flag).select(
        *SERIES, "data_da", LEVEL, "flag", run.alias("run_sum")
    )


def _no2_figures(spark, folder):
    prep = _observations(spark, folder, "NO2")
    daily = daily_figures(prep, "NO2", [200], 400, unique_hours=True)
    daily = daily.withColumnRenamed("count_over_200", "count_over_limit")
    return with_year_to_date(
        daily,
        {"ytd_over_limit": F.col("count_over_limit"), "ytd_count_val": F.col("count_val_param")},
    )


def q_daily_figures(spark, folder):
    """Hours with any number of rows: merged before they are placed."""
    rows = ev.event_measurements(_events(spark, folder, "NO2"))
    return daily_figures(rows, "NO2", [200], 400)


def q_exact_percentiles(spark, folder):
    cents = F.round(F.col("l_extendedprice") * 100)
    lines = ev.table(spark, folder, "lineitem").withColumn("cents", cents)
    shares = {"p02": 0.02, "p50": 0.5, "p98": 0.98}
    found = exact_percentiles(lines, ["l_returnflag", "l_linestatus"], "cents", shares)
    return found.withColumns({name: F.round(name) for name in shares})


def q_ytd_sums(spark, folder):
    return _no2_figures(spark, folder).select(
        *SERIES,
        "data_day",
        LEVEL,
        "available_days_ytd",
        F.col("ytd_over_limit").alias("ytd_over_200"),
        "ytd_count_val",
    )


def q_unpivot_indicators(spark, folder):
    return unpivot_indicators(
        _no2_figures(spark, folder), F.col("data_day").alias("data"), NO2_DAILY
    )


def q_validity(spark, folder):
    rows, keys = _by_day(ev.event_measurements(_events(spark, folder)))
    hours = sum_by_level(rows, keys, {"observed": F.col("val_param").isNotNull().cast("bigint")})
    # A level's share of one day, of one hour, and of nothing expected.
    expected = {"day": F.lit(24), "hour": F.lit(1), "none": F.lit(0)}
    return hours.select(
        "*",
        *[pct_validity(F.col("observed"), e).alias(f"pct_{k}") for k, e in expected.items()],
        *[validity_flag(F.col("observed"), e).alias(f"flag_{k}") for k, e in expected.items()],
    )


def q_daily_mean(spark, folder):
    return daily_mean(ev.event_measurements(_events(spark, folder)), LEVELS[0])


def q_daily_mean_levels(spark, folder):
    return daily_mean_levels(_observations(spark, folder))


def q_date_spine(spark, folder):
    return date_spine(spark, "hour", *ev.event_period(_events(spark, folder)))


def q_run_hits(spark, folder):
    """Hours that end a run of three above the alert limit, counted as the plans count them."""
    hours = level_hours(_observations(spark, folder, "O3"), "O3", "data_day")
    flag = exceeds(F.col("val_param"), 240)
    rows = hours.withColumns({"ones": flag, "zeros": 1 - flag})
    day = Window.partitionBy(*SERIES, "data_day", LEVEL).orderBy("data_da")
    hits = run_hits(F.col("zeros"), F.col("ones"), day)
    return rows.select(*SERIES, "data_da", LEVEL, hits.alias("hits"))


def q_hourly_spine(spark, folder):
    day = F.col("ts").cast("date")
    period = _events(spark, folder).agg(
        F.min(day).cast("timestamp_ntz").alias("first"),
        F.date_add(F.max(day), 1).cast("timestamp_ntz").alias("end"),
    )
    hours = period.select(F.explode(spine_hours(F.col("first"), F.col("end"))).alias("data_da"))
    return hours.withColumn("data_a", F.col("data_da") + F.expr("interval 1 hour"))


def q_gap_fill(spark, folder):
    prep = _observations(spark, folder, "CO", "O3")
    return gap_fill(prep, *ev.event_period(_events(spark, folder)))


def q_moving_8h(spark, folder):
    return _moving(spark, folder, _observations(spark, folder, "CO", "O3"))


def q_moving_8h_merged(spark, folder):
    """Hours with any number of rows."""
    rows = ev.event_measurements(_events(spark, folder, "CO", "O3"))
    return moving_mean(rows, *ev.event_period(_events(spark, folder)))


def _o3(spark, folder, plan, prep):
    return plan(prep, _moving(spark, folder, prep, "O3"), unique_hours=True)


def _no2_daily(prep):
    return no2_daily(prep, daily_mean_levels(prep), unique_hours=True)


def q_o3_daily(spark, folder):
    return _o3(spark, folder, o3_daily, _observations(spark, folder, "O3"))


def q_no2_daily(spark, folder):
    return _no2_daily(_observations(spark, folder, "NO2"))


def q_o3_annual(spark, folder):
    return _o3(spark, folder, o3_annual, _observations(spark, folder, "O3"))


def q_no2_annual(spark, folder):
    return no2_annual(_observations(spark, folder, "NO2", "NOX"), unique_hours=True)


def q_nox_annual(spark, folder):
    return nox_annual(_observations(spark, folder, "NOX"), unique_hours=True)


def q_annual_stats(spark, folder):
    rows = ev.event_measurements(_events(spark, folder, "O3"))
    figures = annual_figures(
        rows,
        "O3",
        [100, 180],
        percentiles={"p98_val_param": 0.98, "median_val_param": 0.5},
        stddev_digits=2,
    )
    return figures.drop("first_day", "last_day")


def _prepared(spark, folder, *pollutants):
    """Hours prepared once and written by pollutant, for plans that read them several times."""
    store = FolderStore(spark, fresh_folder(spark, "prepared"))
    hours = _observations(spark, folder, *pollutants)
    written = store.table("silver", "data_prep", hours, ["sigla_param"])
    return lambda *names: written.where(F.col("sigla_param").isin(*names))


def q_fct_daily(spark, folder):
    prepared = _prepared(spark, folder, "O3", "NO2")
    o3 = _o3(spark, folder, o3_daily, prepared("O3"))
    return fct_daily(o3, _no2_daily(prepared("NO2")))


def q_fct_annual(spark, folder):
    prepared = _prepared(spark, folder, "O3", "NO2", "NOX")
    o3 = _o3(spark, folder, o3_annual, prepared("O3"))
    return fct_annual(o3, no2_annual(prepared("NO2", "NOX"), unique_hours=True))


def q_available_year_days(spark, folder):
    orders = ev.table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    per_customer = orders.groupBy("o_custkey").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    dated = orders.select("o_orderkey", "o_custkey", day.alias("order_day"))
    return dated.join(per_customer, "o_custkey").select(
        "o_orderkey",
        "order_day",
        available_year_days(F.col("order_day"), F.col("first_day"), F.col("last_day")).alias(
            "available_days"
        ),
    )


def _stage_query(name: str) -> Query:
    return lambda spark, folder: stage(name, raw_table(spark, folder, name))


def q_data_prep(spark, folder):
    events = _events(spark, folder)
    # CO has no parameter and station S0 no configuration: their measurements match nothing.
    configurations = ev.raw_configurations(events).where("COD_UBIC <> 'S0'")
    return data_prep(
        stage("rqa_dati_aria_cor", ev.raw_measurements(events)),
        stage("rqa_configurazioni", configurations),
        stage("rqa_parametri", ev.raw_parameters(events).where("SIGLA_PARAM <> 'CO'")),
    )


def q_dim_lookup(spark, folder):
    names = set(STAGING_COLUMNS) - {"rqa_dati_aria_cor", "v_rqa_rete_regionale_ipr"}
    staged = {name: stage(name, raw_table(spark, folder, name)) for name in names}
    return dim_lookup(staged, bucketed=False)


def q_dq_unique_key(spark, folder):
    return duplicate_keys(ev.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


ORDER_KEY = ["o_orderkey"]


def _pair(spark, folder, before="orders_before", after="orders_after"):
    return snapshot(spark, folder, before), snapshot(spark, folder, after)


def q_diff_keyed(spark, folder):
    return with_listed(diff_rows(*_pair(spark, folder), ORDER_KEY))


def q_diff_acts(spark, folder):
    diff = diff_rows(
        *_pair(spark, folder), ORDER_KEY, ignore=["o_orderstatus"], acts=["update", "column"]
    )
    return with_listed(diff)


def q_diff_pruned(spark, folder):
    before, after = _pair(spark, folder)
    diff = diff_rows(before, after, ORDER_KEY)
    return with_listed(prune_columns(diff, ORDER_KEY, column_changes(before, after), around=0))


def q_diff_duplicate_keys(spark, folder):
    return with_listed(diff_rows(*_pair(spark, folder), ["o_custkey"]))


CUSTOMER_KEY = ["c_name", "c_nationkey"]


def _text_key_diff(before, after):
    plain = Equality(ignore_whitespace=True, ignore_case=True)
    return diff_rows(before, after, CUSTOMER_KEY, equality=plain, text_keys=True)


def q_diff_normalised_key(spark, folder):
    return with_listed(
        _text_key_diff(*_pair(spark, folder, "customers_before", "customers_after"))
    )


def q_patch_text_key(spark, folder):
    before, after = _pair(spark, folder, "customers_before", "customers_after")
    return apply_patch(before, _text_key_diff(before, after), CUSTOMER_KEY)


def q_diff_epsilon(spark, folder):
    loose = Equality(epsilon=0.01, ignore_whitespace=True, ignore_case=True)
    diff = diff_rows(
        *_pair(spark, folder, "orders_all", "orders_reformatted"), ORDER_KEY, equality=loose
    )
    return with_listed(diff)


def q_diff_schema(spark, folder):
    before, after = _pair(spark, folder, after="orders_reshaped")
    renames = {"o_totalprice": "price"}
    diff = diff_rows(before, after, ORDER_KEY, renames=renames)
    return diff_columns(diff, column_changes(before, after, renames))


def q_diff_summary(spark, folder):
    before, after = _pair(spark, folder, after="orders_reshaped")
    return diff_summary(before, after, ORDER_KEY, renames={"o_totalprice": "price"})


def q_diff_different(spark, folder):
    """What decides whether a comparison fails: a table with itself, and with its next state."""
    before, after = _pair(spark, folder)
    found = [
        (name, unequal_summary(before, other, ORDER_KEY) is not None)
        for name, other in (("same", before), ("next", after))
    ]
    return reduce(
        DataFrame.union,
        [
            spark.range(1).select(F.lit(name).alias("pair"), F.lit(different).alias("different"))
            for name, different in found
        ],
    )


def _family(spark, folder):
    return [snapshot(spark, folder, f"orders_{n}") for n in ("before", "local", "remote")]


def q_diff3(spark, folder):
    return with_listed(diff3(*_family(spark, folder), ORDER_KEY), "changed", "conflicts")


def q_patch_three_way(spark, folder):
    parent, local, remote = _family(spark, folder)
    data = [c for c in parent.columns if c not in ORDER_KEY]
    diff = diff3(parent, local, remote, ORDER_KEY)
    patch = three_way_patch(diff, ORDER_KEY, data, ["remote_note"])
    added = [c for c in column_changes(local, remote) if c.old is None]
    return apply_patch(local, patch, ORDER_KEY, added)


def q_merge3(spark, folder):
    return with_conflict_texts(merge3(*_family(spark, folder), ORDER_KEY))


def q_apply_patch(spark, folder):
    before, after = _pair(spark, folder)
    changes = column_changes(before, after)
    return apply_patch(before, diff_rows(before, after, ORDER_KEY), ORDER_KEY, changes)


def q_patch_stored(spark, folder):
    """The patch is stored with its added, dropped and renamed columns and applied alone."""
    before, after = _pair(spark, folder, after="orders_reshaped")
    renames = {"o_totalprice": "price"}
    diff = diff_rows(before, after, ORDER_KEY, renames=renames)
    path = fresh_folder(spark, "patch")
    with_schema_rows(diff, column_changes(before, after, renames)).write.parquet(path)
    return apply_patch(before, spark.read.parquet(path), ORDER_KEY, None)


def q_diff_keyless(spark, folder):
    return with_listed(diff_keyless(*_pair(spark, folder, "accounts_before", "accounts_after")))


def q_diff_keyless_wide(spark, folder):
    """More columns than are combined; the two tables differ in prices and missing rows."""
    return with_listed(diff_keyless(*_pair(spark, folder, "orders_all", "orders_corrected")))


def q_diff_keyless_ordered(spark, folder):
    """Lines with many equals, linked beside the lines that have none."""
    return with_listed(diff_keyless(*_pair(spark, folder, "roll_before", "roll_after"), order=["line"]))


def q_diff_context(spark, folder):
    rows = diff_rows(
        *_pair(spark, folder, "orders_all", "orders_corrected"), ORDER_KEY, keep_equal=True
    )
    day = F.coalesce("new_o_orderdate", "old_o_orderdate")
    dated = rows.withColumn("order_day", day)
    placed = with_context(dated, ["order_day", *ORDER_KEY])
    return placed.select("position", "action", *ORDER_KEY, "order_day")


def q_drop_blank_rows(spark, folder):
    lines = snapshot(spark, folder, "lines_with_blanks")
    return drop_blank_rows(lines.select("flag", "status"))


def q_drop_trailing_blank_rows(spark, folder):
    return drop_blank_rows(snapshot(spark, folder, "lines_with_blanks"), order_by="l_quantity")


def q_ingest_tables(spark, folder):
    names = ["nation", "customer", "orders"]
    base = fresh_folder(spark, "landed")
    ingest_tables(lambda name: ev.table(spark, folder, name), base, names)
    landed = load_tables(spark, base, names)
    return (
        landed["orders"]
        .join(landed["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(landed["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_orderdate", "o_totalprice", "c_name", "n_name")
    )


def q_format_roundtrip(spark, folder):
    customers = ev.table(spark, folder, "customer")
    base = fresh_folder(spark, "formats")
    parts = []
    for kind in [*SEPARATORS, "json", "ndjson"]:
        path = write_table(customers, f"{base}/customer.{kind}")
        parts.append(
            read_table(spark, path, customers.schema).withColumn("format", F.lit(kind))
        )
    return reduce(DataFrame.unionByName, parts)


def _event_tables(events):
    return {
        "rqa_dati_aria_cor": ev.raw_measurements(events),
        "rqa_configurazioni": ev.raw_configurations(events),
        "rqa_parametri": ev.raw_parameters(events),
    }


def _layers(spark, folder):
    events = _events(spark, folder)
    store = FolderStore(spark, fresh_folder(spark, "layers"))
    return build_layers(_event_tables(events), store, *ev.event_period(events), PREP_TABLES)


def q_layers_daily(spark, folder):
    return _layers(spark, folder)["fct_daily"]


def q_layers_annual(spark, folder):
    return _layers(spark, folder)["fct_annual"]


def q_layers_lookup(spark, folder):
    """All fifteen staged tables; the dimensions hold those of the events and of the orders."""
    events = _events(spark, folder)
    raw = {name: raw_table(spark, folder, name) for name in RAW_TABLES}
    own = _event_tables(events)
    raw["rqa_dati_aria_cor"] = own["rqa_dati_aria_cor"]
    for name in ("rqa_configurazioni", "rqa_parametri"):
        columns = [F.col(c).cast("string") for c in own[name].columns]
        raw[name] = own[name].select(*columns).unionByName(raw[name].select(*columns))
    store = FolderStore(spark, fresh_folder(spark, "layers"))
    return build_layers(raw, store, *ev.event_period(events))["data_lookup"]


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): function
    for name, function in list(globals().items())
    if name.startswith("q_")
}
QUERIES.update({f"stage_{name}": _stage_query(name) for name in RAW_TABLES})
