import random
import re
from datetime import datetime

import duckdb
import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from obsengine.operators.spine import gap_fill
from obsengine.plans.layers import build_layers
from obsengine.session import fresh_folder, shared_folder
from obsengine.sources import events as ev
from obsengine.sources.formats import copy_table, read_table, write_table
from obsengine.sources.stores import CatalogStore, FolderStore
from obsengine.sources.tables import (
    TABLES,
    HashSplit,
    JdbcSource,
    RangeSplit,
    Split,
    cuts_query,
    ingest_tables,
    load_tables,
    table_path,
)
from obsengine.sources.trade import RAW_TABLES, raw_table
from tests.conftest import SMALL, rows

# The days of the events of the test tables.
JANUARY = datetime(2024, 1, 1), datetime(2024, 1, 31)


def test_the_measurements_are_only_read_in_parallel():
    split = Split("DATA_DA", "2020-01-01", "2021-01-01", 64)
    name = "rqa_dati_aria_cor"
    with pytest.raises(ValueError, match="Split"):
        JdbcSource("jdbc:x", "s").options(name)
    assert JdbcSource("jdbc:x", "s", splits={name: split}).options(name)["numPartitions"] == "64"
    assert JdbcSource("jdbc:x", "s", {"fetchsize": "5"}, large=()).options(name)["fetchsize"] == "5"


def test_jdbc_options():
    source = JdbcSource(
        "jdbc:postgresql://host/db",
        "Case",
        {"user": "u"},
        {"big": Split("DATA_DA", "2020-01-01", "2021-01-01", 64)},
    )
    assert source.options("small") == {
        "fetchsize": "10000",
        "user": "u",
        "url": "jdbc:postgresql://host/db",
        "dbtable": '"Case"."small"',
    }
    assert source.options("big") == {
        "fetchsize": "10000",
        "user": "u",
        "url": "jdbc:postgresql://host/db",
        "dbtable": '"Case"."big"',
        "partitionColumn": "DATA_DA",
        "lowerBound": "2020-01-01",
        "upperBound": "2021-01-01",
        "numPartitions": "64",
    }


@pytest.mark.parametrize("keys", ["even", "skewed", "texts", "nulls", "empty"])
def test_parts_are_disjoint_and_complete(keys):
    rng = random.Random(keys)
    values = {
        "even": list(range(200)), "skewed": [7] * 150 + list(range(40)) + [None] * 30,
        "texts": [rng.choice(["a", "b'c", "", "é", None]) for _ in range(90)], "nulls": [None] * 5, "empty": [],
    }[keys]
    kind = "varchar" if keys == "texts" else "bigint"
    con = duckdb.connect()
    con.execute(f'create table t ("K ey" {kind}, id int)')
    for i, value in enumerate(values):
        con.execute("insert into t values (?, ?)", [value, i])
    cuts = [r[0] for r in con.execute(
        'select distinct unnest(quantile_disc("K ey", [0.25, 0.5, 0.75])) as c from t order by c'
    ).fetchall() if r[0] is not None]
    literals = ["'" + c.replace("'", "''") + "'" if kind == "varchar" else str(c) for c in cuts]
    splits = [
        HashSplit("K ey", 5, "cast(hash({column}) % {reads} as int)"),
        RangeSplit("K ey", literals), RangeSplit("K ey", literals * 2 if len(literals) == 1 else literals),
    ]
    for split in splits:
        parts = [con.execute(f"select id from t where {p}").fetchall() for p in split.predicates()]
        seen = [r[0] for part in parts for r in part]
        assert sorted(seen) == list(range(len(values)))
        assert len(parts[-1]) == values.count(None)
        if keys == "even":
            assert max(map(len, parts)) <= 80


def test_splits_reach_the_reader():
    split = HashSplit("COD_UBIC", 3)
    source = JdbcSource("jdbc:x", "S", splits={"rqa_dati_aria_cor": split})
    assert "numPartitions" not in source.options("rqa_dati_aria_cor")
    assert split.predicates()[1].startswith('"COD_UBIC" is not null and mod(mod(hashtext(')
    assert split.predicates()[1].endswith(" = 1") and split.predicates()[-1] == '"COD_UBIC" is null'
    assert cuts_query("S", "t", "c", 4).count("0.25, 0.5, 0.75") == 1


class _Reader:
    """Stands in for a session: notes what a JDBC read asks for."""

    def __init__(self):
        self.read = self

    def jdbc(self, url, table, predicates, properties):
        self.asked = (url, table, predicates, properties)


def test_parts_are_asked_for():
    spark, split = _Reader(), RangeSplit("K", ["1", "5"])
    JdbcSource("jdbc:x", "S", {"user": "u"}, {"t": split}).read(spark, "t")
    where = ['"K" < 1', '"K" >= 1 and "K" < 5', '"K" >= 5', '"K" is null']
    assert spark.asked == ("jdbc:x", '"S"."t"', where, {"fetchsize": "10000", "user": "u"})


@pytest.fixture(params=["folder", "catalog"])
def store(request, spark, tmp_path):
    if request.param == "folder":
        made = FolderStore(spark, str(tmp_path))
        return made, lambda: made.read("silver", "t")
    spark.sql("drop view if exists silver.t")
    return CatalogStore(spark, buckets=3), lambda: spark.table("silver.t")


def test_a_failed_rebuild_leaves_the_old_table(spark, store):
    made, read = store
    made.table("silver", "t", spark.range(5).toDF("n"))
    broken = spark.range(0, 40, 1, 4).selectExpr("if(id = 39, raise_error('lost'), id) as n")
    with pytest.raises(Exception, match="lost"):
        made.table("silver", "t", broken.selectExpr("cast(n as bigint) as n"))
    assert sorted(r.n for r in read().collect()) == [0, 1, 2, 3, 4]


def test_a_table_may_be_made_from_itself(spark, store):
    made, read = store
    before = made.table("silver", "t", spark.range(4).toDF("n"))
    after = made.table("silver", "t", before.union(read()).selectExpr("n + 1 as n"))
    assert sorted(r.n for r in after.collect()) == [1, 1, 2, 2, 3, 3, 4, 4]
    # The plan of the older table still reads its rows, until they are dropped.
    assert before.count() == 4 and read().count() == 8
    assert made.drop_old("silver", "t") >= 1
    assert read().count() == 8 and made.drop_old("silver", "t") == 0


def test_partitions_and_buckets_come_back(spark, store):
    made, read = store
    rows = spark.range(30).selectExpr("id as n", "id % 3 as part", "cast(id as string) as s")
    made.table("silver", "t", rows, partition_by=["part"])
    made.table("silver", "t", rows, bucket_by=["s"])
    assert sorted(map(tuple, read().collect())) == sorted(map(tuple, rows.collect()))


def test_two_runs_never_both_replace_a_folder(spark, tmp_path):
    made = FolderStore(spark, str(tmp_path))
    made.table("silver", "t", spark.range(1).toDF("n"))
    with pytest.raises(RuntimeError, match="another run"):
        made._point(f"{tmp_path}/silver/t", "late", 1)
    assert made.read("silver", "t").count() == 1
    with pytest.raises(ValueError, match="never"):
        made.read("silver", "other")


def test_lookup_moves_no_bucketed_row(spark):
    from obsengine.operators.prep import dim_lookup
    from obsengine.operators.staging import STAGING_COLUMNS, stage
    from obsengine.plans.layers import BUCKETED

    catalog = CatalogStore(spark, buckets=4)
    names = set(STAGING_COLUMNS) - {"rqa_dati_aria_cor", "v_rqa_rete_regionale_ipr"}
    staged = {
        name: catalog.table("lookup", name, stage(name, raw_table(spark, SMALL, name)), bucket_by=BUCKETED.get(name, ()))
        for name in names
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        text = dim_lookup(staged)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Bucketed: true") == 2
    assert not re.findall(r"Exchange hashpartitioning\((?:coalesce\()?cod_ubic", text)


@pytest.mark.parametrize("few", [True, False])
def test_lookup_is_the_same_in_any_order_of_joins(spark, monkeypatch, few):
    from obsengine.operators import prep
    from obsengine.operators.staging import STAGING_COLUMNS

    def table(name, *rows):
        columns = [c[-1].lower() if len(c) == 3 else c[0].lower() for c in STAGING_COLUMNS[name]]
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))

    staged = {
        # The same configuration twice, one of no class and one each without parameter, owner and place.
        "rqa_configurazioni": table(
            "rqa_configurazioni",
            ("1", "u1", "p1", "e1", "m1", "f1", "c1", "S"), ("1", "u1", "p1", "e1", "m1", "f1", "c1", "S"),
            ("2", "u2", "p1", "e1", "m1", "f1", None, "N"), ("3", "u2", None, "e1", "m1", "f1", "c1", "N"),
            ("4", "u1", "p1", "e9", "m1", "f1", "c1", "N"), ("5", None, "p1", "e1", "m1", "f1", "c1", "N"),
        ),
        "rqa_ubicazioni": table(
            "rqa_ubicazioni",
            ("u1", "d", "v", "1", "10", "1.0", "2.0", None, "x", "z1"), ("u2", "d", "v", "1", "11", None, None, None, "x", "z9"),
        ),
        "comuni": table("comuni", ("10", "town", "1"), ("10", "twin", "1"), ("11", "other", "2")),
        "province": table("province", ("1", "one")),
        "rqa_t_zona": table("rqa_t_zona", ("z1", "zone")),
        "rqa_enti": table("rqa_enti", ("e1", "owner", "r1", "N"), ("e1", "owner 2", "r1", "S")),
        "rqa_t_reti": table("rqa_t_reti", ("r1", "net")),
        "rqa_parametri": table("rqa_parametri", ("p1", "ozone", "O3", "k1", "S", "l1")),
        "rqa_elementi": table("rqa_elementi", ("l1", "element")),
        "rqa_metodi": table("rqa_metodi", ("k1", "method")),
        "rqa_t_stclass_eu": table("rqa_t_stclass_eu", ("c1", "class")),
        "rqa_t_frequenze": table("rqa_t_frequenze", ("f1", "hourly")),
        "t_unita_misura": table("t_unita_misura", ("m1", "ug")),
    }
    monkeypatch.setattr(prep, "is_small", lambda df, max_rows=0: few)
    found = [rows(prep.dim_lookup(staged, bucketed)) for bucketed in (True, False)]
    assert found[0] == found[1]
    place = prep.DIM_LOOKUP_COLUMNS.index
    # Two towns and two owners make four rows of each copy of configuration 1.
    assert [r[place("cod_conf")] for r in found[0]] == ["1"] * 8 + ["2"] * 2
    assert [r[place("nom_com")] for r in found[0]] == ["town"] * 4 + ["twin"] * 4 + [None] * 2
    assert {r[place("desc_eu")] for r in found[0] if r[place("cod_conf")] == "2"} == {None}


def test_ingest_never_overwrites(spark, tmp_path):
    base = str(tmp_path / "landed")
    written = ingest_tables(lambda name: spark.range(3).withColumn("t", F.lit(name)), base)
    assert list(written) == list(TABLES) and len(TABLES) == 17
    assert written["comuni"] == table_path(base, "comuni") == f"{base}/comuni/comuni.parquet"
    assert all(df.count() == 3 for df in load_tables(spark, base, TABLES[:2]).values())
    with pytest.raises(AnalysisException):
        ingest_tables(lambda name: spark.range(1), base, TABLES[:1])


TRICKY = [("a", 1), ("", 2), (None, 3), ('q"uo,te;', 4), ("line\nbreak\ttab", None), ("  x ", 6)]


@pytest.mark.parametrize("kind", ["csv", "tsv", "ssv", "psv", "json", "ndjson"])
def test_formats_keep_every_cell(spark, tmp_path, kind):
    df = spark.createDataFrame(TRICKY, "t string, n int")
    path = write_table(df.repartition(3), str(tmp_path / f"t.{kind}"), line_breaks=True)
    assert rows(read_table(spark, path, df.schema, line_breaks=True)) == rows(df)
    with pytest.raises(AnalysisException):
        write_table(df, path)


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_every_row_of_every_file_comes_back(spark, tmp_path, kind):
    df = spark.range(100).selectExpr("id", "cast(id as string) as t").repartition(2)
    path = write_table(df, str(tmp_path / f"t.{kind}"))
    assert rows(read_table(spark, path, df.schema)) == rows(df)
    copied = copy_table(spark, path, str(tmp_path / "u.json"))
    assert read_table(spark, copied).count() == 100


def test_line_breaks_are_refused_unless_asked_for(spark, tmp_path):
    df = spark.createDataFrame([("a\nb",)], "t string")
    with pytest.raises(PySparkException, match="line break"):
        write_table(df, str(tmp_path / "t.csv"))


def test_format_named_by_the_caller(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "t string, n string")
    path = write_table(df, str(tmp_path / "table.data"), kind="tsv")
    assert rows(read_table(spark, path, kind="tsv")) == rows(df)


def test_line_json_columns_are_the_union_of_keys(spark, tmp_path):
    (tmp_path / "t.ndjson").write_text('{"a": 1}\n{"b": "x"}\n')
    assert set(read_table(spark, str(tmp_path / "t.ndjson")).columns) == {"a", "b"}


def test_json_array(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"a": 1},\n {"a": 2, "b": "x"}]')
    assert read_table(spark, str(tmp_path / "t.json"), json_array=True).count() == 2


def test_copy_and_unknown_format(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "t string, n string")
    source = write_table(df, str(tmp_path / "t.csv"))
    copy = copy_table(spark, source, str(tmp_path / "u.ndjson"))
    assert rows(read_table(spark, copy).select("t", "n")) == rows(df)
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "t.xyz"))


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == configured
    assert fresh_folder(spark, "a") != fresh_folder(spark, "a")


def test_scratch_is_dropped_on_request(spark, monkeypatch):
    from obsengine import session

    monkeypatch.setattr(session, "_handed_out", {})
    path = fresh_folder(spark, "t")
    fresh_folder(spark, "never-written")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert session.drop_scratch(spark) == 1 and session.drop_scratch(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_layers_in_the_catalog(spark):
    events = ev.table(spark, SMALL, "events")
    raw = {name: raw_table(spark, SMALL, name) for name in RAW_TABLES}
    raw |= {
        "rqa_dati_aria_cor": ev.raw_measurements(events),
        "rqa_configurazioni": ev.raw_configurations(events),
        "rqa_parametri": ev.raw_parameters(events),
    }
    built = build_layers(raw, CatalogStore(spark), *JANUARY)
    assert spark.table("gold.fct_daily").count() == built["fct_daily"].count() > 0
    assert spark.table("gold.fct_annual").count() == built["fct_annual"].count() > 0
    assert spark.table("utilities.hourly_spine").count() == 720
    assert set(built) >= set(RAW_TABLES) | {"data_lookup"}
    assert spark.table("o3_daily").columns == built["fct_daily"].columns
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert views >= {"o3_daily", "no2_daily", "o3_annual", "no2_annual"}


def test_layers_want_their_tables(spark):
    events = ev.table(spark, SMALL, "events")
    raw = {"rqa_dati_aria_cor": ev.raw_measurements(events)}
    with pytest.raises(ValueError, match="comuni.*rqa_configurazioni"):
        build_layers(raw, CatalogStore(spark), *JANUARY)


@pytest.mark.parametrize("kept", [FolderStore, CatalogStore])
def test_layers_order_the_lookup_by_what_the_store_keeps(spark, tmp_path, monkeypatch, kept):
    class Seen(Exception):
        pass

    def lookup(staged, bucketed=None):
        raise Seen(bucketed)

    monkeypatch.setattr("obsengine.plans.layers.dim_lookup", lookup)
    events = ev.table(spark, SMALL, "events").limit(20)
    raw = {name: raw_table(spark, SMALL, name).limit(20) for name in RAW_TABLES} | {
        "rqa_dati_aria_cor": ev.raw_measurements(events),
        "rqa_configurazioni": ev.raw_configurations(events),
        "rqa_parametri": ev.raw_parameters(events),
    }
    store = CatalogStore(spark) if kept is CatalogStore else FolderStore(spark, str(tmp_path))
    with pytest.raises(Seen) as seen:
        build_layers(raw, store, *JANUARY)
    assert seen.value.args == (kept is CatalogStore,)


def test_other_event_types_fall_into_the_last_channel(spark):
    hour = datetime(2024, 3, 5, 7, 10)
    events = spark.createDataFrame(
        [(1, hour, 1, "error", 2.0), (2, hour, 1, "other", 5.0), (3, hour, 1, None, 1.0)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    )
    found = ev.observations(events).collect()
    assert [(r.sigla_param, r.val_param) for r in found] == [("PM10", 20.0)]
    assert ev.raw_configurations(events).count() == ev.raw_parameters(events).count() == 1
    assert ev.of_pollutants(events, "PM10").count() == 3 and ev.of_pollutants(events, "O3").count() == 0
    assert ev.event_period(events) == (datetime(2024, 3, 5), datetime(2024, 3, 6))
    assert ev.event_period(events.limit(0))[0] == ev.event_period(events.limit(0))[1]


def test_events_of_another_month_fill_their_own_spine(spark):
    events = spark.createDataFrame(
        [(i, datetime(2023, 7, 1 + i // 24, i % 24, 5), 1, "view", float(i)) for i in range(30)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    )
    filled = gap_fill(ev.observations(events), *ev.event_period(events))
    assert filled.count() == 48 and filled.where("val_param is not null").count() == 30
    assert gap_fill(ev.observations(events.limit(0)), *ev.event_period(events.limit(0))).count() == 0
