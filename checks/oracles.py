"""Plain SQL for the registered queries, run by DuckDB over the same tables.

The SQL follows the written definition of each result step by step (one filtered
chain per level, full joins, a complete spine, one branch per indicator) and
shares no shape with the Spark plans it checks.
"""

from checks import expected
from obsengine.sources.snapshots import SNAPSHOTS
from obsengine.sources.trade import RAW_TABLES, VALUE_LISTS

SERIES = "cod_ubic, cod_conf, sigla_param"

_CHANNELS = """
    case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 3
                    when 'signup' then 4 else 5 end as cod_conf,
    case event_type when 'view' then 'O3' when 'click' then 'NO2' when 'purchase' then 'NOX'
                    when 'signup' then 'CO' else 'PM10' end as sigla_param,
    case event_type when 'error' then 'CG' else 'OR' end as cod_freq"""

_CODES = """
    cast(case when {id} % 10 = 0 then 1 else 0 end as int) as cod_valid,
    case when {id} % 3 <> 0 then 'V' end as cod_validaz,
    case when {id} % 4 <> 0 then 'V' end as cod_validaz_reg"""

# One measurement per station, event type and hour.
OBS = f"""obs as (
  select 'S' || cast(user_id // 75 as varchar) as cod_ubic, {_CHANNELS},
    date_trunc('hour', ts) as data_da,
    date_trunc('hour', ts) + interval 1 hour as data_a,
    cast(floor(max(value) * 4) as double) as val_param,
    {_CODES.format(id="max(event_id)")},
    cast(date_trunc('day', ts) as date) as data_day,
    cast(year(ts) as int) as anno
  from events
  group by user_id // 75, event_type, date_trunc('hour', ts),
    cast(date_trunc('day', ts) as date), year(ts))"""

# One measurement per event.
ROWS = f"""obs as (
  select 'S' || cast(user_id // 75 as varchar) as cod_ubic, {_CHANNELS},
    date_trunc('hour', ts) as data_da,
    cast(floor(value * 4) as double) as val_param,
    {_CODES.format(id="event_id")},
    cast(date_trunc('day', ts) as date) as data_day,
    cast(year(ts) as int) as anno
  from events)"""

LEVELS = {
    "VS": ("Dati validi", "val", "cod_valid = 0"),
    "VX": ("Dati validi e validati COR", "val_cor", "cod_valid = 0 and cod_validaz = 'V'"),
    "VR": ("Dati certificati", "cert", "cod_validaz_reg = 'V'"),
}


def _query(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


def levelled(where: str = "true") -> str:
    """CTE ``hours``: one filtered copy of the measurements per level."""
    return "hours as (" + " union all ".join(
        f"select *, '{code}' as lvl from obs where {where} and {cond}"
        for code, (_, _, cond) in LEVELS.items()
    ) + ")"


def flagged(run: int, thresholds: list[int]) -> str:
    """CTE ``flagged``: 0/1 flags and the three-row sum within the day."""
    over = ", ".join(
        f"case when round(val_param) > {t} then 1 else 0 end as over_{t}"
        for t in sorted({run, *thresholds})
    )
    return f"""flags as (select *, {over} from hours),
flagged as (
  select *, over_{run} + coalesce(lag(over_{run}, 1) over w, 0)
    + coalesce(lag(over_{run}, 2) over w, 0) as run3
  from flags window w as (partition by lvl, {SERIES}, data_day order by data_da))"""


def daily(thresholds: list[int]) -> str:
    counts = ", ".join(f"cast(sum(over_{t}) as bigint) as count_over_{t}" for t in thresholds)
    return f"""daily as (
  select lvl, {SERIES}, data_day, anno, count(val_param) as count_val_param,
    max(round(val_param)) as max_val_param, {counts},
    cast(sum(case when run3 = 3 then 1 else 0 end) as bigint) as count_superi_3h
  from flagged group by lvl, {SERIES}, data_day, anno)"""


def annual(thresholds: list[int], digits: int, run: bool = True) -> str:
    counts = "".join(f"cast(sum(over_{t}) as bigint) as count_over_{t}, " for t in thresholds)
    runs = "cast(sum(case when run3 = 3 then 1 else 0 end) as bigint) as count_superi_3h,"
    return f"""annual as (
  select lvl, {SERIES}, anno, count(val_param) as count_val_param, {counts} {runs if run else ""}
    round(max(val_param)) as max_val_param, round(avg(val_param)) as mean_val_param,
    round(percentile_cont(0.98) within group (order by val_param)) as p98_val_param,
    round(stddev_samp(val_param), {digits}) as stddev_val_param,
    round(percentile_cont(0.5) within group (order by val_param)) as median_val_param,
    cast(date_diff('day', min(data_day), max(data_day)) + 1 as int) as available_days_in_year,
    cast((date_diff('day', min(data_day), max(data_day)) + 1) * 24 as int)
      as available_hours_in_year
  from flagged group by lvl, {SERIES}, anno)"""


def ytd(source: str, sums: dict[str, str]) -> str:
    """CTE ``running``: running sums and the days since the first day of the year."""
    totals = ", ".join(f"cast(sum({expr}) over w as bigint) as {name}" for name, expr in sums.items())
    return f"""running as (
  select *, cast(date_diff('day', min(data_day) over (partition by anno, lvl, {SERIES}), data_day)
      + 1 as int) as available_days_ytd, {totals}
  from {source}
  window w as (partition by anno, lvl, {SERIES} order by data_day
               rows between unbounded preceding and current row))"""


SPINE = """spine as (
  select h as data_da, h + interval 1 hour as data_a
  from (select unnest(generate_series(date_trunc('day', min(ts)),
      date_trunc('day', max(ts)) + interval 23 hour, interval 1 hour)) as h from events))"""

FILLED = f"""measured as (select * from obs where sigla_param in ('CO', 'O3')),
series as (select distinct {SERIES} from measured),
filled as (
  select s.data_da, s.data_a, p.cod_ubic, p.cod_conf, p.sigla_param, d.val_param,
    d.cod_valid, d.cod_validaz, d.cod_validaz_reg
  from spine s cross join series p
  left join measured d on s.data_da = d.data_da and s.data_a = d.data_a
    and p.cod_ubic = d.cod_ubic and p.cod_conf = d.cod_conf and p.sigla_param = d.sigla_param)"""


def _moving() -> str:
    parts, gated = [], []
    for _, suffix, cond in LEVELS.values():
        parts.append(
            f"round(avg(case when {cond} then val_param end) over w, 2) as m_{suffix},"
            f" count(case when {cond} then val_param end) over w as n_{suffix}"
        )
        gated.append(
            f"case when n_{suffix} >= 6 then m_{suffix} end as mv_avg_{suffix},"
            f" case when n_{suffix} >= 6 then n_{suffix} end as valori_validi_mv_avg_{suffix}"
        )
    return f"""windowed as (
  select data_da, data_a, {SERIES}, {", ".join(parts)} from filled
  window w as (partition by {SERIES} order by data_da rows between 7 preceding and current row)),
gated as (select data_da, data_a, {SERIES}, {", ".join(gated)} from windowed),
moving as (
  select * from gated where mv_avg_val is not null or mv_avg_val_cor is not null
    or mv_avg_cert is not null),
moving_days as (""" + " union all ".join(
        f"""select '{code}' as lvl, {SERIES}, cast(data_da as date) as data_day,
        count(mv_avg_{suffix}) as count_mv_avg, max(round(mv_avg_{suffix})) as max_mv_avg
      from moving where sigla_param = 'O3' group by {SERIES}, cast(data_da as date)"""
        for code, (_, suffix, _) in LEVELS.items()
    ) + ")"


MOVING = ", ".join([SPINE, FILLED, _moving()])

# Hours with any number of rows: every row of the eight hours up to each spine hour.
_EIGHT_HOURS = ", ".join(
    f"round(avg(case when {cond} then val_param end), 2) as m_{suffix},"
    f" count(case when {cond} then val_param end) as n_{suffix}"
    for _, suffix, cond in LEVELS.values()
)
MERGED = _query(
    ROWS, SPINE, f"""measured as (select * from obs where sigla_param in ('CO', 'O3')),
series as (select distinct {SERIES} from measured),
windowed as (
  select s.data_da, s.data_a, {", ".join("p." + c for c in SERIES.split(", "))}, {_EIGHT_HOURS}
  from spine s cross join series p
  join measured d on d.cod_ubic = p.cod_ubic and d.cod_conf = p.cod_conf
    and d.sigla_param = p.sigla_param
    and d.data_da between s.data_da - interval 7 hour and s.data_da
  group by all)""",
    select=f"""select data_da, data_a, {SERIES}, """ + ", ".join(
        f"case when n_{s} >= 6 then m_{s} end as mv_avg_{s},"
        f" case when n_{s} >= 6 then n_{s} end as valori_validi_mv_avg_{s}"
        for _, s, _ in LEVELS.values()
    ) + " from windowed where n_val >= 6 or n_val_cor >= 6 or n_cert >= 6",
)


def _daily_mean(suffix: str, cond: str, source: str = "obs") -> str:
    body = f"""select {SERIES}, round(avg(val_param), 2) as media_giornaliera_{suffix},
      count(val_param) as valori_validi_gg_{suffix}, data_day as data from {source} where {cond}"""
    return f"""{body} group by {SERIES}, data_day having count(val_param) >= 18
      union all {body} and cod_freq = 'CG' group by {SERIES}, data_day"""


_SAME = " and ".join(f"a.{c} = b.{c}" for c in ["data", "cod_ubic", "cod_conf", "sigla_param"])
_BOTH = ", ".join(
    f"coalesce(a.{c}, b.{c}) as {c}" for c in ["data", "cod_ubic", "cod_conf", "sigla_param"]
)

DAILY_MEANS = (
    "".join(f"mean_{s} as ({_daily_mean(s, c)}), " for _, s, c in LEVELS.values())
    + f"""mean_two as (
  select {_BOTH}, a.media_giornaliera_val, a.valori_validi_gg_val,
    b.media_giornaliera_val_cor, b.valori_validi_gg_val_cor
  from mean_val a full outer join mean_val_cor b on {_SAME}),
daily_means as (
  select {_BOTH}, a.media_giornaliera_val, a.valori_validi_gg_val,
    a.media_giornaliera_val_cor, a.valori_validi_gg_val_cor,
    b.media_giornaliera_cert, b.valori_validi_gg_cert
  from mean_two a full outer join mean_cert b on {_SAME})"""
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _coverage(observed: str, expected: str) -> str:
    share = f"cast({observed} as double) * 100.0 / ({expected})"
    return f"""cast({expected} as int) as dati_teorici, cast({observed} as bigint) as valori_rilevati,
      round(cast(case when ({expected}) = 0 then 0 else {share} end as double), 6)
        as percentuale_validita,
      case when ({expected}) = 0 then 'No' when {share} >= 75 then 'Si' else 'No' end
        as validita_indicatore"""


_LEVEL_NAME = "case lvl " + " ".join(
    f"when '{code}' then '{name}'" for code, (name, _, _) in LEVELS.items()
) + " end as livello_validazione, lvl as cod_liv_validazione"


def daily_branch(ind: tuple, source: str) -> str:
    nome, riferimento, condizione, note, valore, teorici, rilevati = ind
    return f"""select data_day as data, {SERIES}, {_LEVEL_NAME},
      {_text(nome)} as nome_indicatore, {_text(riferimento)} as riferimento_normativo,
      {_text(condizione)} as condizione_sul_limite, cast({valore} as double) as valore,
      {_text(note)} as note_di_lavoro, {_coverage(rilevati, teorici)} from {source}"""


def annual_branch(ind: tuple, source: str) -> str:
    nome, limite, condizione, livello_critico, valore, teorici, rilevati = ind
    return f"""select anno, {SERIES}, {_LEVEL_NAME},
      {_text(nome)} as nome_indicatore, {_text(limite)} as valore_limite,
      {_text(condizione)} as condizione_sul_limite,
      {_text(livello_critico)} as livello_critico, cast({valore} as double) as valore,
      {_coverage(rilevati, teorici)} from {source}"""


def _unpivot(branch, indicators, source: str) -> str:
    return " union all ".join(branch(ind, source) for ind in indicators)


_ON_SERIES = " and ".join(f"h.{c} = m.{c}" for c in ["cod_ubic", "cod_conf", "sigla_param"])

O3_DAILY = _query(
    OBS, levelled("sigla_param = 'O3'"), flagged(240, [180]), daily([180]), MOVING,
    f"""joined as (
  select h.*, coalesce(m.count_mv_avg, 0) as count_mv_avg, m.max_mv_avg
  from daily h left join moving_days m
    on h.lvl = m.lvl and h.data_day = m.data_day and {_ON_SERIES}),
checked as (
  select *, case when count_mv_avg * 100.0 / 24 >= 75 then 'Si' else 'No' end as validita_8h
  from joined)""",
    ytd("checked", {
        "ytd_over_180": "count_over_180",
        "ytd_superi_3h": "count_superi_3h",
        "ytd_count_val": "count_val_param",
        "ytd_8h_over_120": "case when max_mv_avg > 120 and validita_8h = 'Si' then 1 else 0 end",
        "ytd_valid_days": "case when validita_8h = 'Si' then 1 else 0 end",
    }),
    select=_unpivot(daily_branch, expected.O3_DAILY, "running"),
)

_NO2_RUNNING = [
    OBS, levelled("sigla_param = 'NO2'"), flagged(400, [200]), daily([200]),
    ytd("daily", {"ytd_over_200": "count_over_200", "ytd_count_val": "count_val_param"}),
]

_NO2_MEAN = "mean_rows as (" + " union all ".join(
    f"""select h.lvl, h.cod_ubic, h.cod_conf, h.sigla_param, h.data_day,
      round(m.media_giornaliera_{suffix}) as mean, m.valori_validi_gg_{suffix} as n
    from daily h left join daily_means m on h.data_day = m.data and {_ON_SERIES}
    where h.lvl = '{code}'"""
    for code, (_, suffix, _) in LEVELS.items()
) + ")"

NO2_DAILY = _query(
    *_NO2_RUNNING, DAILY_MEANS, _NO2_MEAN,
    select=_unpivot(daily_branch, expected.NO2_DAILY, "running")
    + " union all " + _unpivot(daily_branch, expected.NO2_DAILY_MEAN, "mean_rows"),
)

O3_ANNUAL = _query(
    OBS, levelled("sigla_param = 'O3'"), flagged(240, [180]), annual([180], 0), MOVING,
    f"""moving_years as (
  select lvl, {SERIES}, cast(year(data_day) as int) as anno,
    sum(case when max_mv_avg > 120 and count_mv_avg >= 18 then 1 else 0 end) as days_over_120,
    sum(case when count_mv_avg >= 18 then 1 else 0 end) as valid_days_8h
  from moving_days group by lvl, {SERIES}, year(data_day)),
joined as (
  select h.*, coalesce(m.days_over_120, 0) as days_over_120,
    coalesce(m.valid_days_8h, 0) as valid_days_8h
  from annual h left join moving_years m on h.lvl = m.lvl and h.anno = m.anno and {_ON_SERIES})""",
    select=_unpivot(annual_branch, expected.O3_ANNUAL, "joined"),
)

_NOX = f"""nox as (
  select lvl, {SERIES}, anno, count(val_param) as count_val_param,
    round(avg(val_param) * 1.912, 1) as mean_val_param,
    (date_diff('day', min(data_day), max(data_day)) + 1) * 24 as available_hours_in_year
  from nox_hours group by lvl, {SERIES}, anno)"""
_NOX_HOURS = levelled("sigla_param = 'NOX'").replace("hours as", "nox_hours as", 1)

NOX_ANNUAL = _query(
    OBS, _NOX_HOURS, _NOX, select=_unpivot(annual_branch, expected.NOX_ANNUAL, "nox")
)

NO2_ANNUAL = _query(
    OBS, levelled("sigla_param = 'NO2'"), flagged(400, [100, 140, 200]),
    annual([200, 140, 100], 2), _NOX_HOURS, _NOX,
    select=_unpivot(annual_branch, expected.NO2_ANNUAL, "annual")
    + " union all " + _unpivot(annual_branch, expected.NOX_ANNUAL, "nox"),
)


def _staged(name: str) -> str:
    source, columns = RAW_TABLES[name]
    raw = ", ".join(f"{expr} as {column}" for column, expr in columns.items())
    distinct = "distinct " if name in VALUE_LISTS else ""
    return f"select {expected.STAGED[name]} from (select {distinct}{raw} from {source})"


def _snapshot_ctes(**names: str) -> str:
    return ", ".join(f"{alias} as ({SNAPSHOTS[name]})" for alias, name in names.items())


def _is(a: str, b: str) -> str:
    return f"{a} is not distinct from {b}"


def _diff(
    before: str,
    after: str,
    keys: list[str],
    data: list[str],
    added: tuple = (),
    dropped: tuple = (),
    match: dict | None = None,
    same: dict | None = None,
    keep: str = "action <> ''",
    show_keys: bool = True,
) -> str:
    """Linked pairs, then deletes, then inserts; ``match`` and ``same`` override tests."""
    match, same = match or {}, same or {}
    side_key = {k: match.get(k, "{}." + k) for k in keys}
    partition = ", ".join(side_key[k].format("t") for k in keys)
    on = " and ".join(_is(side_key[k].format("l"), side_key[k].format("r")) for k in keys)
    changed = {c: f"not ({same.get(c, _is('l.' + c, 'r.' + c))})" for c in data}
    filled = " or ".join(f"coalesce(r.{c} <> '', false)" for c in added) or "false"
    listed = ", ".join(f"case when {t} then '{c}' end" for c, t in changed.items())

    def cells(old: bool, new: bool) -> str:
        parts = [f"{'r' if new else 'l'}.{k}" for k in keys] if show_keys else []
        for c in data:
            parts += [f"{'l.' + c if old else 'null'} as old_{c}"]
            parts += [f"{'r.' + c if new else 'null'} as new_{c}"]
        parts += [f"{'r.' + c if new else 'null'} as new_{c}" for c in added]
        parts += [f"{'l.' + c if old else 'null'} as old_{c}" for c in dropped]
        return ", ".join(parts)

    return f"""with before as ({before}), after as ({after}),
    l1 as (select *, count(*) over (partition by {partition}) as n_key from before t),
    r1 as (select *, count(*) over (partition by {partition}) as n_key from after t),
    linked as (
      select case when {" or ".join(changed.values())} then '->' when {filled} then '+' else '' end
          as action, {cells(True, True)}, concat_ws(',', {listed}) as changed
      from l1 l join r1 r on {on} and l.n_key = 1 and r.n_key = 1),
    deleted as (
      select '---' as action, {cells(True, False)}, '' as changed from l1 l
      where n_key > 1 or not exists (select 1 from r1 r where r.n_key = 1 and {on})),
    inserted as (
      select '+++' as action, {cells(False, True)}, '' as changed from r1 r
      where n_key > 1 or not exists (select 1 from l1 l where l.n_key = 1 and {on})),
    diff as (select * from linked union all by name select * from deleted
      union all by name select * from inserted)
    select * from diff where {keep}"""


_ORDER_DATA = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

DIFF_KEYED = _diff(
    SNAPSHOTS["orders_before"], SNAPSHOTS["orders_after"], ["o_orderkey"], _ORDER_DATA, ("note",)
)
_RENAMED = SNAPSHOTS["orders_before"].replace("o_totalprice,", "o_totalprice as price,")
DIFF_RESHAPED = _diff(
    _RENAMED, SNAPSHOTS["orders_reshaped"], ["o_orderkey"],
    ["o_custkey", "o_orderstatus", "price", "o_orderdate"], ("note",), ("o_orderpriority",),
)

_FAMILY = _snapshot_ctes(p="orders_before", l="orders_local", r="orders_remote")


def _diff3() -> str:
    changed = {c: f"(p.o_orderkey is not null and not ({_is('p.' + c, 'r.' + c)}))" for c in _ORDER_DATA}
    clash = {
        c: f"({t} and not ({_is('p.' + c, 'l.' + c)}) and not ({_is('r.' + c, 'l.' + c)}))"
        for c, t in changed.items()
    }
    cells = ", ".join(f"{s}.{c} as {n}_{c}" for c in _ORDER_DATA
                      for s, n in (("p", "parent"), ("l", "local"), ("r", "remote")))
    lists = ", ".join(
        "concat_ws(',', "
        + ", ".join(f"case when {t} then '{c}' end" for c, t in tests.items())
        + f") as {name}"
        for name, tests in (("changed", changed), ("conflicts", clash))
    )
    nothing = ", ".join(f"null as parent_{c}, null as local_{c}, r.{c} as remote_{c}" for c in _ORDER_DATA)
    gone = ", ".join(f"p.{c} as parent_{c}, l.{c} as local_{c}, null as remote_{c}" for c in _ORDER_DATA)
    return f"""with {_FAMILY},
    based as (
      select case when {" or ".join(clash.values())} then '!->'
          when {" or ".join(changed.values())} then '->'
          when coalesce(r.remote_note <> '', false) then '+' end as action,
        p.o_orderkey, {cells}, r.remote_note as remote_remote_note, {lists}
      from p join r on p.o_orderkey = r.o_orderkey left join l on p.o_orderkey = l.o_orderkey),
    deleted as (
      select '---' as action, p.o_orderkey, {gone}, null as remote_remote_note,
        '' as changed, '' as conflicts
      from p join l on p.o_orderkey = l.o_orderkey
      where p.o_orderkey not in (select o_orderkey from r)),
    inserted as (
      select '+++' as action, r.o_orderkey, {nothing}, r.remote_note as remote_remote_note,
        '' as changed, '' as conflicts
      from r where r.o_orderkey not in (select o_orderkey from p))
    select * from based where action is not null
    union all by name select * from deleted union all by name select * from inserted"""


def _merge3() -> str:
    merged, clashes = [], []
    for c in _ORDER_DATA:
        p, mine, theirs = f"p.{c}", f"l.{c}", f"r.{c}"
        clash = f"not ({_is(p, mine)}) and not ({_is(p, theirs)}) and not ({_is(mine, theirs)})"
        text = " || ".join([
            "'((( '", f"coalesce({p}::varchar, '')", "' ))) '", f"coalesce({mine}::varchar, '')",
            "' /// '", f"coalesce({theirs}::varchar, '')",
        ])
        merged.append(
            f"case when {clash} then {text} when {_is(p, mine)} then {theirs}::varchar"
            f" else {mine}::varchar end as {c}"
        )
        clashes.append(f"(case when {clash} then 1 else 0 end)")
    plain = ", ".join(f"{c}::varchar as {c}" for c in ["o_orderkey", *_ORDER_DATA])
    return f"""with {_FAMILY}
    select p.o_orderkey::varchar as o_orderkey, {", ".join(merged)}, l.local_note, r.remote_note,
      cast({" + ".join(clashes)} as int) as conflict_count
    from p join l on p.o_orderkey = l.o_orderkey join r on p.o_orderkey = r.o_orderkey
    union all by name
    select {plain}, local_note, null as remote_note, 0 as conflict_count from l
      where o_orderkey not in (select o_orderkey from p)
    union all by name
    select {plain}, null as local_note, remote_note, 0 as conflict_count from r
      where o_orderkey not in (select o_orderkey from p)"""


_ROLL = ["c_mktsegment", "zone", "amount"]
_ACCOUNT = ["c_acctbal", "c_mktsegment", "c_nationkey"]


def _beside(links: str, way: str, top: int) -> str:
    """Rows that follow (or, going up, precede) a linked pair at one distance with equal texts."""
    if way == "down":
        last, rows, step = "max", "unbounded preceding and 1 preceding", 1
        outside = {"a": "null", "b": "null"}
    else:
        last, rows, step = "min", "1 following and unbounded following", -1
        outside = {"a": "(select count(*) + 1 from a)", "b": "(select count(*) + 1 from b)"}
    out = []
    for side, other in ("ab", "ba"):
        out.append(f"""{way}_{side}m as (select k.id, k.k, l.id{other} as mate
          from {side}{top}k k left join {links} l on l.id{side} = k.id)""")
        out.append(f"""{way}_{side} as (select f.id, f.k, coalesce(f.up, {outside[side]}) as anchor,
            coalesce(x.mate, {outside[other]}) as base, {step} * (f.id - coalesce(f.up, {outside[side]})) as d
          from (select *, {last}(case when mate is not null then id end) over (order by id
            rows between {rows}) as up from {way}_{side}m) f
          left join {way}_{side}m x on x.id = f.up
          where f.mate is null and coalesce(f.up, {outside[side]}) is not null)""")
    out.append(f"""{way}_met as (select a.id as ida, b.id as idb, a.base, a.d
      from {way}_a a left join {way}_b b on b.anchor = a.base and b.d = a.d and b.k = a.k)""")
    out.append(f"""{way} as (select ida, idb from {way}_met m
      where d < coalesce((select min(d) from {way}_met e where e.base = m.base and e.idb is null), 1e18))""")
    return ",\n".join(out)


def _keyless(
    before: str, after: str, cells: list[str], columns: list[str], order: str = ""
) -> str:
    """Each set of ``columns`` in turn, written out; rows are numbered for the linking."""
    ctes = [
        _snapshot_ctes(a0=before, b0=after),
        f"a as (select *, row_number() over ({order}) as id from a0)",
        f"b as (select *, row_number() over ({order}) as id from b0)",
        "size as (select greatest((select count(*) from a), (select count(*) from b)) + 1 + 20 as h)",
    ]
    sets = range(1, 2 ** len(columns))
    for mask in sets:
        chosen = [c for at, c in enumerate(columns) if mask >> at & 1]
        text = " || ' // ' || ".join(f"coalesce({c}::varchar, '')" for c in chosen)
        for side in "ab":
            ctes.append(
                f"{side}{mask}k as (select id, {text} as k, count(*) over (partition by {text}) as n"
                f" from {side})"
            )
        earlier = "".join(
            f" and a.id not in (select ida from link{m}) and b.id not in (select idb from link{m})"
            for m in range(1, mask)
        )
        ctes.append(
            f"""link{mask} as (
            select a.id as ida, b.id as idb from a{mask}k a join b{mask}k b on a.k = b.k
            where a.n = 1 and b.n = 1 and greatest((select max(n) from a{mask}k),
              (select max(n) from b{mask}k)) < 0.1 * (select h from size){earlier})"""
        )
    ctes.append(
        f"{'found' if order else 'links'} as ("
        + " union all ".join(f"select * from link{m}" for m in sets)
        + ")"
    )
    if order:
        ctes.append(_beside("found", "down", max(sets)))
        ctes.append("after_down as (select * from found union all select * from down)")
        ctes.append(_beside("after_down", "up", max(sets)))
        ctes.append("links as (select * from after_down union all select * from up)")
    both = ", ".join(f"a.{c} as old_{c}, b.{c} as new_{c}" for c in cells)
    listed = ", ".join(
        f"case when a.{c} is distinct from b.{c} then '{c}' end" for c in cells
    )
    differs = " or ".join(f"a.{c} is distinct from b.{c}" for c in cells)
    old = ", ".join(f"{c} as old_{c}, null as new_{c}" for c in cells)
    new = ", ".join(f"null as old_{c}, {c} as new_{c}" for c in cells)
    return "with " + ",\n".join(ctes) + f"""
    select '->' as action, {both}, concat_ws(',', {listed}) as changed
    from links join a on a.id = ida join b on b.id = idb where {differs}
    union all by name
    select '---' as action, {old}, '' as changed from a where id not in (select ida from links)
    union all by name
    select '+++' as action, {new}, '' as changed from b where id not in (select idb from links)"""


def _plain(cell: str) -> str:
    return f"lower(trim({cell}))"


# A changed customer takes the new row, spelling included; the others stay as they were.
PATCH_TEXT_KEY = f"""with {_snapshot_ctes(l="customers_before", r="customers_after")},
  pairs as (select l.*, r.c_name as n_name, r.c_acctbal as n_bal, r.c_mktsegment as n_seg,
      l.c_acctbal is distinct from r.c_acctbal or l.c_mktsegment is distinct from r.c_mktsegment
        as changed
    from l join r on lower(trim(l.c_name)) = lower(trim(r.c_name))
      and l.c_nationkey = r.c_nationkey)
  select case when changed then n_name else c_name end as c_name, c_nationkey,
    case when changed then n_bal else c_acctbal end as c_acctbal,
    case when changed then n_seg else c_mktsegment end as c_mktsegment
  from pairs"""


def _patch_three_way() -> str:
    cells = ", ".join(
        f"case when {_is('p.' + c, 'l.' + c)} then r.{c} else l.{c} end as {c}" for c in _ORDER_DATA
    )
    names = ", ".join(["o_orderkey", *_ORDER_DATA])
    return f"""with {_FAMILY}
    select p.o_orderkey, {cells}, l.local_note, r.remote_note
    from p join l on p.o_orderkey = l.o_orderkey join r on p.o_orderkey = r.o_orderkey
    union all by name
    select {names}, local_note, null as remote_note from l
      where o_orderkey not in (select o_orderkey from p)
    union all by name
    select {names}, null as local_note, remote_note from r
      where o_orderkey not in (select o_orderkey from p)"""



_LOOSE = {
    "o_totalprice": "coalesce(abs(l.o_totalprice - r.o_totalprice) < 0.01, false)"
    " or l.o_totalprice is not distinct from r.o_totalprice",
    "o_orderstatus": _is(_plain("l.o_orderstatus"), _plain("r.o_orderstatus")),
}

_COLUMN_MARKS = [
    ("o_orderkey", "", "bigint", "bigint"),
    ("o_orderdate", ":", "timestamp_ntz", "timestamp_ntz"),
    ("o_custkey", "", "bigint", "bigint"),
    ("o_orderstatus", "", "string", "string"),
    ("price", "(o_totalprice)", "double", "double"),
    ("note", "+++", None, "string"),
    ("o_orderpriority", "---", "string", None),
]

DIFF_SCHEMA = f"""with marks(column_name, marker, old_type, new_type) as (values {
    ", ".join("(" + ", ".join("null" if v is None else _text(v) for v in row) + ")"
              for row in _COLUMN_MARKS)
}), cells as (select unnest(string_split(changed, ',')) as column_name from ({DIFF_RESHAPED})
    where action = '->')
select m.*, (select count(*) from cells c where c.column_name = m.column_name) as changed_cells
from marks m"""  # fmt: skip

DIFF_SUMMARY = f"""with changes as ({DIFF_RESHAPED}), counts as (
  select cast(count(*) filter (action = '+++') as bigint) as row_inserts,
    cast(count(*) filter (action = '---') as bigint) as row_deletes,
    cast(count(*) filter (action = '->') as bigint) as row_updates,
    (select count(distinct u) from (select unnest(string_split(changed, ',')) as u from changes
      where action = '->')) as col_updates,
    (select count(*) from ({SNAPSHOTS["orders_before"]})) as row_count_initial,
    (select count(*) from ({SNAPSHOTS["orders_reshaped"]})) as row_count_final
  from changes)
select *, 1::bigint as col_inserts, 1::bigint as col_deletes, 1::bigint as col_renames,
  1::bigint as col_reorders, 0::bigint as col_type_changes, 6::bigint as col_count_initial, 6::bigint as col_count_final,
  true as different from counts"""

_CONTEXT_DIFF = _diff(
    SNAPSHOTS["orders_all"], SNAPSHOTS["orders_corrected"], ["o_orderkey"], _ORDER_DATA,
    keep="true",
)
DIFF_CONTEXT = f"""with dated as (
    select action, o_orderkey, coalesce(new_o_orderdate, old_o_orderdate) as order_day
    from ({_CONTEXT_DIFF})),
  placed as (select *, row_number() over w - 1 as position,
      max(case when action <> '' then 1 else 0 end)
        over (order by order_day, o_orderkey rows between 1 preceding and 1 following) as near
    from dated window w as (order by order_day, o_orderkey))
select cast(position as bigint) as position, action, o_orderkey, order_day from placed where near = 1"""

ORACLES: dict[str, str] = {
    "level_filter": _query(
        ROWS, levelled(),
        select=f"select {SERIES}, data_da, val_param, lvl as cod_liv_validazione from hours",
    ),
    "exceedance_counts": _query(
        ROWS, levelled(),
        select=f"select {SERIES}, data_day, lvl as cod_liv_validazione, count(val_param) as n_values, "
        + ", ".join(
            f"cast(sum(case when round(val_param) > {t} then 1 else 0 end) as bigint) as over_{t}"
            for t in (100, 140, 180, 200, 240, 400)
        )
        + f" from hours group by {SERIES}, data_day, lvl",
    ),
    "consecutive_3h": _query(
        OBS, levelled("sigla_param = 'O3'"), flagged(240, []),
        select=f"select {SERIES}, data_da, lvl as cod_liv_validazione, over_240 as flag,"
        " cast(run3 as bigint) as run_sum from flagged",
    ),
    "run_hits": _query(
        OBS, levelled("sigla_param = 'O3'"), flagged(240, []),
        select=f"select {SERIES}, data_da, lvl as cod_liv_validazione,"
        " cast(run3 = 3 as bigint) as hits from flagged",
    ),
    "daily_figures": _query(
        ROWS, levelled("sigla_param = 'NO2'"),
        flagged(400, [200]).replace("order by data_da", "order by data_da, val_param"),
        daily([200]),
        select=f"select {SERIES}, data_day, anno, lvl as cod_liv_validazione, count_val_param,"
        " max_val_param, count_over_200, count_superi_3h from daily",
    ),
    "exact_percentiles": "select l_returnflag, l_linestatus, "
    + ", ".join(
        f"round(percentile_cont({p}) within group (order by round(l_extendedprice * 100))) as {n}"
        for n, p in (("p02", 0.02), ("p50", 0.5), ("p98", 0.98))
    )
    + " from lineitem group by l_returnflag, l_linestatus",
    "ytd_sums": _query(
        *_NO2_RUNNING,
        select=f"select {SERIES}, data_day, lvl as cod_liv_validazione, available_days_ytd,"
        " ytd_over_200, ytd_count_val from running",
    ),
    "unpivot_indicators": _query(
        *_NO2_RUNNING, select=_unpivot(daily_branch, expected.NO2_DAILY, "running")
    ),
    "validity": _query(
        ROWS, levelled(),
        f"""counts as (select {SERIES}, data_day, lvl as cod_liv_validazione,
          count(val_param) as observed from hours group by {SERIES}, data_day, lvl)""",
        select="""select *, round(observed * 100.0::double / 24, 6) as pct_day,
          round(observed * 100.0::double, 6) as pct_hour, 0.0::double as pct_none,
          case when observed * 100.0::double / 24 >= 75 then 'Si' else 'No' end as flag_day,
          case when observed * 100.0::double >= 75 then 'Si' else 'No' end as flag_hour,
          'No' as flag_none from counts""",
    ),
    "daily_mean": _query(ROWS, select=_daily_mean("val", "cod_valid = 0")),
    "daily_mean_levels": _query(OBS, DAILY_MEANS, select="select * from daily_means"),
    "hourly_spine": """
        with bounds as (select date_trunc('day', min(ts)) as lo,
            date_trunc('day', max(ts)) + interval 23 hour as hi from events),
        hours as (select unnest(generate_series(lo::timestamp, hi::timestamp, interval 1 hour))
            as data_da from bounds)
        select data_da, data_da + interval 1 hour as data_a from hours""",
    "gap_fill": _query(OBS, SPINE, FILLED, select="select * from filled"),
    "moving_8h": _query(OBS, MOVING, select="select * from moving"),
    "moving_8h_merged": MERGED,
    "o3_daily": O3_DAILY,
    "no2_daily": NO2_DAILY,
    "o3_annual": O3_ANNUAL,
    "no2_annual": NO2_ANNUAL,
    "nox_annual": NOX_ANNUAL,
    "annual_stats": _query(
        ROWS, levelled("sigla_param = 'O3'"), flagged(240, [100, 180]),
        annual([100, 180], 2, run=False),
        select=f"select {SERIES}, anno, lvl as cod_liv_validazione, * exclude (lvl, {SERIES}, anno)"
        " from annual",
    ),
    "fct_daily": f"select * from ({O3_DAILY}) union all select * from ({NO2_DAILY})",
    "fct_annual": f"select * from ({O3_ANNUAL}) union all select * from ({NO2_ANNUAL})",
    "available_year_days": """
        with bounds as (select o_custkey, min(o_orderdate)::date as lo, max(o_orderdate)::date as hi
            from orders group by o_custkey)
        select o_orderkey, o_orderdate::date as order_day,
          cast(date_diff('day',
            greatest(make_date(year(o_orderdate), 1, 1), lo),
            least(make_date(year(o_orderdate), 12, 31), hi)) + 1 as int) as available_days
        from orders join bounds using (o_custkey)""",
    "data_prep": _query(
        OBS,
        select="""select cod_ubic, cod_conf, 'P' || cod_conf as cod_param, data_da, data_a, val_param,
          cod_valid, cod_validaz, cod_validaz_reg, anno, cod_freq, sigla_param from obs
        where cod_ubic <> 'S0' and sigla_param <> 'CO'""",
    ),
    "dim_lookup": "with "
    + ", ".join(
        f"{name} as ({_staged(name)})"
        for name in RAW_TABLES
        if name not in ("rqa_dati_aria_cor", "v_rqa_rete_regionale_ipr")
    )
    + """
        select u.cod_ubic, u.descr_ubic, u.via_ubic, u.cod_prov, pr.nom_prov, u.cod_com, co.nom_com,
          u.cmirl_lat, u.cmirl_lon, u.data_disattiv, u.cod_eu, u.cod_tzona, z.tipo_zona,
          c.cod_conf, c.cod_param, c.cod_ente, e.descr_ente, e.t_rete, r.descr_t_rete,
          e.flag_privata, c.cod_mis, um.sigla_mis, c.cod_freq, f.descr_freq, c.station_cl_eu,
          ce.desc_eu, c.flg_pub, p.descr_param, p.sigla_param, p.cod_metodo, m.metodo,
          p.flag_pubblico, p.cod_elemento, el.inquinante
        from rqa_configurazioni c
        join rqa_enti e on c.cod_ente = e.cod_ente
        join rqa_t_reti r on e.t_rete = r.t_rete
        join rqa_parametri p on c.cod_param = p.cod_param
        join rqa_ubicazioni u on c.cod_ubic = u.cod_ubic
        join t_unita_misura um on c.cod_mis = um.cod_mis
        join rqa_t_frequenze f on c.cod_freq = f.cod_freq
        join province pr on u.cod_prov = pr.cod_prov
        left join comuni co on u.cod_com = co.cod_com and u.cod_prov = co.cod_prov
        left join rqa_t_stclass_eu ce on c.station_cl_eu = ce.station_cl_eu
        join rqa_elementi el on p.cod_elemento = el.cod_elemento
        join rqa_metodi m on p.cod_metodo = m.cod_metodo
        left join rqa_t_zona z on u.cod_tzona = z.cod_tzona""",
    "dq_unique_key": """
        select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1""",
    **{f"stage_{name}": _staged(name) for name in RAW_TABLES},
    "diff_keyed": DIFF_KEYED,
    "diff_acts": _diff(
        SNAPSHOTS["orders_before"], SNAPSHOTS["orders_after"], ["o_orderkey"],
        [c for c in _ORDER_DATA if c != "o_orderstatus"], ("note",), keep="action in ('->', '+')",
    ),
    "diff_duplicate_keys": _diff(
        SNAPSHOTS["orders_before"], SNAPSHOTS["orders_after"], ["o_custkey"],
        ["o_orderkey", *_ORDER_DATA[1:]], ("note",),
    ),
    "diff_normalised_key": _diff(
        SNAPSHOTS["customers_before"], SNAPSHOTS["customers_after"], ["c_name", "c_nationkey"],
        ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        match={"c_name": "lower(trim({}.c_name))"},
        same={"c_name": _is(_plain("l.c_name"), _plain("r.c_name"))},
    ),
    "diff_epsilon": _diff(
        SNAPSHOTS["orders_all"], SNAPSHOTS["orders_reformatted"], ["o_orderkey"], _ORDER_DATA,
        same=_LOOSE,
    ),
    "diff_schema": DIFF_SCHEMA,
    "diff_summary": DIFF_SUMMARY,
    "diff3": _diff3(),
    "merge3": _merge3(),
    "diff_different": f"""with {_snapshot_ctes(l="orders_before", r="orders_after")},
      shared as (select o_orderkey, {", ".join(_ORDER_DATA)} from r)
      select 'same' as pair, exists (select * from l except all select * from l) as different
      union all
      select 'next', exists (select * from l except all select * from shared)
        or exists (select * from shared except all select * from l)""",
    "diff_pruned": f"""select action, o_orderkey, old_o_orderstatus, new_o_orderstatus,
        old_o_totalprice, new_o_totalprice, new_note, changed from ({DIFF_KEYED})""",
    "apply_patch": SNAPSHOTS["orders_after"],
    "patch_stored": SNAPSHOTS["orders_reshaped"],
    "patch_text_key": PATCH_TEXT_KEY,
    "patch_three_way": _patch_three_way(),
    "diff_keyless": _keyless("accounts_before", "accounts_after", _ACCOUNT, _ACCOUNT),
    # The status has the fewest values of the six columns, so the other five are combined.
    "diff_keyless_ordered": _keyless(
        "roll_before", "roll_after", _ROLL, _ROLL, order="order by line"
    ),
    "diff_keyless_wide": _keyless(
        "orders_all", "orders_corrected", ["o_orderkey", *_ORDER_DATA],
        ["o_orderkey", "o_totalprice", "o_orderdate", "o_custkey", "o_orderpriority"],
    ),
    "diff_context": DIFF_CONTEXT,
    "drop_blank_rows": f"""select flag, status from ({SNAPSHOTS["lines_with_blanks"]})
        where flag is not null""",
    "drop_trailing_blank_rows": f"""with lines as ({SNAPSHOTS["lines_with_blanks"]})
        select * from lines
        where l_quantity <= (select max(l_quantity) from lines where flag is not null)""",
    "ingest_tables": """
        select o_orderkey, o_orderdate, o_totalprice, c_name, n_name
        from orders join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey""",
    "format_roundtrip": """
        select c.*, f.format from customer c
        cross join (values ('csv'), ('tsv'), ('ssv'), ('psv'), ('json'), ('ndjson')) as f(format)""",
    "layers_daily": f"select * from ({O3_DAILY}) union all select * from ({NO2_DAILY})",
    "layers_annual": f"select * from ({O3_ANNUAL}) union all select * from ({NO2_ANNUAL})",
}

ORACLES["date_spine"] = ORACLES["hourly_spine"]
# The configurations of the events have no owner, so the lookup is that of the orders.
ORACLES["layers_lookup"] = ORACLES["dim_lookup"]
