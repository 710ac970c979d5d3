"""DuckDB SQL for each registered query: an independent statement of the same
semantics over the same parquet tables (views ``lineitem``, ``part``, …).

Raw lines are not re-parsed here: composed lines are compared with the
original customer/nation/region columns they were built from, and the
hand-written edge lines with their expected splits written out below.
"""

from __future__ import annotations

from assayframe.functions.values import JVM_DOUBLE
from assayframe.plans import fixtures as fx

TOP_K = 20
ROUND = 6


def _s(v) -> str:
    """SQL literal."""
    if v is None:
        return "cast(null as varchar)"
    if isinstance(v, float):
        return f"cast({v!r} as double)"
    return "'" + str(v).replace("'", "''") + "'"


def _values(name: str, cols: str, rows) -> str:
    body = ", ".join("(" + ", ".join(_s(x) for x in r) + ")" for r in rows)
    return f"{name}({cols}) AS (VALUES {body})"


# --- SQL forms of the column rules -------------------------------------------
_WS = r" \t\n\x0B\f\r"
_TRIM_SET = "(" + " || ".join(f"chr({i})" for i in range(1, 33)) + ")"


def jtrim(x: str) -> str:
    return f"trim({x}, {_TRIM_SET})"


def strip_q(x: str) -> str:
    y = f"(case when starts_with({x}, '\"') then substr({x}, 2) else {x} end)"
    return f"(case when ends_with({y}, '\"') then substr({y}, 1, length({y}) - 1) else {y} end)"


def c1(x: str) -> str:
    t = jtrim(f"coalesce({x}, '')")
    return (f"(case when {t} = '' or lower({t}) in ('null', 'unknown', 'unknown or not stated', 'n/a', 'na') "
            f"then 'Unknown' else {t} end)")


def num(x: str) -> str:
    """Double from JVM-number text (suffix letter dropped), NULL otherwise."""
    t = jtrim(x)
    pat = JVM_DOUBLE.replace("'", "''")
    return (f"(case when regexp_matches({t}, '{pat}') "
            f"then try_cast(regexp_replace({t}, '[fFdD]$', '') as double) end)")


def c2(x: str) -> str:
    v = jtrim(f"replace({strip_q(jtrim(x))}, ',', '')")
    return f"(case when {num(v)} is not null and not ({num(v)} < 0) then {v} else 'Unknown' end)"


def f5(x: str) -> str:
    v = f"replace({strip_q(jtrim(x))}, ',', '')"
    return (f"(case when length({v}) > 0 and lower({v}) not like '%unknown%' and lower({v}) not like '%na%' "
            f"then {num(v)} end)")


def norm(x: str) -> str:
    a = f"regexp_replace(lower({x}), '\\(.*?\\)', '', 'g')"
    b = f"regexp_replace({a}, '[^a-z0-9{_WS}]', '', 'g')"
    return f"regexp_replace({jtrim(b)}, '[{_WS}]+', ' ', 'g')"


def required(x: str) -> str:
    return f"(length({jtrim(x)}) > 0 and lower({x}) not in ('unknown', 'unknown or not stated'))"


# --- measurements ------------------------------------------------------------
MEAS = """measurements AS (
  select l.l_orderkey as record_id, p.p_type as category, p.p_name as item, l.l_returnflag as analyte,
         case when l.l_discount = 0.0 then 'Unknown' else cast(l.l_quantity as varchar) end as reading,
         p.p_brand as maker, n.n_name as country
  from lineitem l join part p on l.l_partkey = p.p_partkey
  join supplier u on l.l_suppkey = u.s_suppkey join nation n on u.s_nationkey = n.n_nationkey)"""
LIMITS = _values("limits", "category_key, analyte_key, max_reading", fx.MEASUREMENT_LIMITS)
CLASSIFIED = """classified AS (
  select m.*, t.max_reading,
         case when t.max_reading is null or m.reading = 'Unknown' then 'NA'
              when cast(m.reading as double) > t.max_reading then 'YES' else 'NO' end as flag
  from measurements m left join limits t
    on lower(m.category) = t.category_key and lower(m.analyte) = t.analyte_key)"""
M_COLS = "record_id, category, item, analyte, reading, maker, country"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _cls(body: str) -> str:
    return _with(MEAS, LIMITS, CLASSIFIED) + body


def _meas(body: str) -> str:
    return _with(MEAS) + body


def _rate(key: str, hit: str, among: str | None = None, over: float | None = None, src="classified") -> str:
    where = f" where {among}" if among else ""
    having = f" having count_if({hit})::double / count(*) > {over}" if over is not None else ""
    return f"select {key}, count_if({hit})::double / count(*) as rate from {src}{where} group by {key}{having}"


_YES = "lower(flag) = 'yes'"
_DECIDED = "lower(flag) in ('yes', 'no')"
_KNOWN = "select {k}, cast(reading as double) as v from measurements where reading <> 'Unknown'"


def _stat(key: str, stat: str) -> str:
    known = _KNOWN.format(k=key)
    if stat == "mean":
        return _meas(f"select {key}, round(avg(v), {ROUND}) as mean from ({known}) group by {key}")
    if stat == "stddev":
        return _meas(f"select {key}, round(stddev_pop(v), {ROUND}) as stddev from ({known}) group by {key}")
    if stat == "median":
        return _meas(f"select {key}, median(v) as median from ({known}) group by {key}")
    if stat == "mode":
        return _meas(
            f"select {key}, v as mode from (select {key}, v, row_number() over "
            f"(partition by {key} order by n desc, v asc) as rn from "
            f"(select {key}, v, count(*) as n from ({known}) group by {key}, v)) where rn = 1")
    raise ValueError(stat)


# --- raw lines -----------------------------------------------------------------
CUST = """cust AS (
  select concat_ws(',', cast(c.c_custkey as varchar), c.c_mktsegment,
                   '"' || c.c_name || ', (' || c.c_mktsegment || ')"', r.r_name, cast(c.c_acctbal as varchar),
                   'USD', '"Maker, ' || cast(c.c_custkey % 7 as varchar) || '"', n.n_name, n.n_name, '', '"n/a"')
           as value,
         11 as n_fields, cast(c.c_custkey as varchar) as f0, c.c_mktsegment as f1,
         c.c_name || ', (' || c.c_mktsegment || ')' as f2, r.r_name as f3, cast(c.c_acctbal as varchar) as f4,
         'USD' as f5, 'Maker, ' || cast(c.c_custkey % 7 as varchar) as f6, n.n_name as f7, n.n_name as f8,
         '' as f9, 'n/a' as f10
  from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey)"""

# Expected split of each hand-written line (fixtures.EDGE_LINES, same order).
_EDGE_SPLITS = [
    ["1", "a, b", "c"],
    ["1", 'x ""q"" y', "z"],
    ["a", "", ""],
    [""],
    ["a", "b"],
    ['a,"b', "c", "d"],
    ["unknown ", "1"],
]
for _line in fx.EDGE_LINES[len(_EDGE_SPLITS):]:
    if _line.startswith("e07"):
        _EDGE_SPLITS.append(["e07", "unknown ", "Chili Powder", "Lead", "5", "ppm", "M", "India", "India", "", ""])
    elif _line.startswith("e08"):
        _EDGE_SPLITS.append(["e08", "Food-Spice", "Goldroot (Marrow) Powder", "Lead", "1,200.5", "ppm", "M",
                             "India", "India", "", ""])
    else:
        assert '"' not in _line
        _EDGE_SPLITS.append([p.strip(" ") for p in _line.split(",")])
_EDGE_ROWS = [(line, len(f), *(f + [None] * (11 - len(f)))) for line, f in zip(fx.EDGE_LINES, _EDGE_SPLITS)]
EDGE = ("edge(value, n_fields, f0, f1, f2, f3, f4, f5, f6, f7, f8, f9, f10) AS (VALUES "
        + ", ".join("(" + ", ".join(_s(x) if not isinstance(x, int) else str(x) for x in r) + ")" for r in _EDGE_ROWS)
        + ")")
LINES = "lines AS (select * from cust union all select * from edge)"
RAW_LIMITS = _values("rlimits", "category_key, analyte_key, max_reading", fx.RAW_LIMITS)
RAW_SYN = _values("rsyn", "alias, canonical", fx.RAW_SYNONYMS)
_F = [f"f{i}" for i in range(11)]
CLEANED = f"""cleaned AS (
  select {c1('f0')} as record_id, {c1('f1')} as category, {norm(c1('f2'))} as item_norm, {c1('f3')} as analyte,
         {c2('f4')} as reading, {c1('f5')} as unit, {c1('f6')} as maker, {c1('f7')} as country,
         {c1('f8')} as country_alt, {c1('f9')} as extra_9, {c1('f10')} as extra_10
  from lines where n_fields > 10 and {required('f1')} and {required('f2')} and {required('f3')} and {required('f4')})"""
ENRICHED = f"""enriched AS (
  select c.record_id, c.category, coalesce(s.canonical, c.item_norm) as item, c.analyte, c.reading, c.unit, c.maker,
         c.country, c.country_alt, c.extra_9, c.extra_10, t.max_reading,
         case when t.max_reading is null or c.reading = 'Unknown' or {num('c.reading')} is null then 'NA'
              when not isnan({num('c.reading')}) and {num('c.reading')} > t.max_reading then 'YES' else 'NO' end
           as flag
  from cleaned c left join rsyn s on c.item_norm = s.alias
  left join rlimits t on lower(c.category) = t.category_key and lower(c.analyte) = t.analyte_key)"""
CLEAN_12 = ("record_id, category, item, analyte, reading, unit, maker, country, country_alt, extra_9, extra_10, "
            "flag")


def _raw(body: str, clean: bool = False) -> str:
    ctes = [CUST, EDGE, LINES]
    if clean:
        ctes += [RAW_LIMITS, RAW_SYN, CLEANED, ENRICHED]
    return _with(*ctes) + body


_HEADER = _s(fx.RAW_HEADER)
ALIMITS = _values("alimits", "authority, category_key, analyte_key, max_reading", fx.authority_limit_rows())
_FLAG = ("case when t.max_reading is null or m.reading = 'Unknown' then 'NA' "
         "when cast(m.reading as double) > t.max_reading then 'YES' else 'NO' end")


_REASON = "case when n_fields <= 10 then 'too_few_fields' " + " ".join(
    f"when not {required(f)} then 'missing_{name}'"
    for f, name in (("f1", "category"), ("f2", "item"), ("f3", "analyte"), ("f4", "reading"))) + " end"
_REJECTED = f"select value as line, reason from (select value, {_REASON} as reason from lines) where reason is not null"


def _alternatives() -> dict[str, str]:
    by_auth = _with(MEAS, ALIMITS) + (
        f"select authority, category, count_if(flag = 'YES')::double / count_if(flag in ('YES', 'NO')) as rate "
        f"from (select a.authority, m.category, {_FLAG} as flag from measurements m "
        f"cross join (select distinct authority from alimits) a left join alimits t "
        f"on t.authority = a.authority and lower(m.category) = t.category_key and lower(m.analyte) = t.analyte_key) "
        f"group by authority, category having count_if(flag in ('YES', 'NO')) > 0")
    dual = _with(MEAS, LIMITS, CLASSIFIED, _PART_SYN) + (
        f"select item_raw, item, count(*) as n, count_if(flag = 'YES') as yes, "
        f"case when count_if(flag in ('YES', 'NO')) > 0 then count_if(flag = 'YES')::double / "
        f"count_if(flag in ('YES', 'NO')) end as rate from (select c.item as item_raw, "
        f"coalesce(s.canonical, {norm('c.item')}) as item, c.flag from classified c "
        f"left join psyn s on {norm('c.item')} = s.alias) group by item_raw, item")
    per_country = ("select country, yes::double / decided as rate, decided::double / n as completeness from "
                   "(select country, count(*) as n, count_if(flag = 'YES') as yes, "
                   "count_if(flag in ('YES', 'NO')) as decided from classified group by country) where decided > 0")
    weighted = (f"select round(sum(completeness * rate) / sum(completeness), {ROUND}) as weighted_rate, "
                f"round(avg(rate), {ROUND}) as unweighted_rate, count(*) as groups from ({per_country})")
    bounds = ("select country, count_if(flag = 'YES')::double / count(*) as rate_low, "
              "(count_if(flag = 'YES') + count_if(reading = 'Unknown'))::double / count(*) as rate_high "
              "from classified where max_reading is not null group by country")
    imputed = _with(MEAS, LIMITS) + (
        "select category, count_if(flag = 'YES')::double / count_if(flag in ('YES', 'NO')) as rate from ("
        "select m.category, case when t.max_reading is null or v is null then 'NA' "
        "when not isnan(v) and v > t.max_reading then 'YES' else 'NO' end as flag from ("
        "select m.*, coalesce(case when m.reading <> 'Unknown' then cast(m.reading as double) end, mu.mu) as v "
        "from measurements m left join (select category, avg(cast(reading as double)) as mu from measurements "
        "where reading <> 'Unknown' group by category) mu on m.category = mu.category) m "
        "left join limits t on lower(m.category) = t.category_key and lower(m.analyte) = t.analyte_key) "
        "group by category having count_if(flag in ('YES', 'NO')) > 0")
    # The drawn reading itself: the one at the drawn rank of the group's sorted list.
    drawn = _with(MEAS, LIMITS) + (
        ", limited as (select m.*, t.max_reading as lim, case when m.reading <> 'Unknown' then cast(m.reading as double) "
        "end as v from measurements m join limits t on lower(m.category) = t.category_key "
        "and lower(m.analyte) = t.analyte_key), "
        "known as (select category, list_sort(list(cast(reading as double))) as vs from measurements "
        "where reading <> 'Unknown' group by category), "
        "seeds as (select unnest(range(16)) as seed), "
        "each as (select l.country, s.seed, l.lim, l.v, coalesce(l.v, k.vs[1 + ('0x' || substr(md5(s.seed || ':' || "
        "l.record_id), 1, 13))::bigint % len(k.vs)]) as d from limited l cross join seeds s "
        "left join known k using (category)), "
        "per_seed as (select country, seed, count_if(d > lim) as yes, count(d) as n, count_if(v is null and d is not null) "
        "as drawn from each group by country, seed having count(d) > 0) "
        "select country, sum(yes)::double / sum(n)::double as rate, min(yes::double / n) as rate_low, "
        "max(yes::double / n) as rate_high, max(drawn) as drawn from per_seed group by country")
    return {
        "profile_distinct_category": _raw("select distinct f1 as category from lines where n_fields > 7"),
        "profile_distinct_country": _raw("select distinct f7 as country from lines where n_fields > 7"),
        "profile_value_count": _raw("select count_if(lower(f1) = 'household') as n from lines where n_fields > 7"),
        "profile_reading_range": _raw(
            f"select count(v) as n_valid, coalesce(min(v), 0.0) as min_reading, coalesce(max(v), 0.0) as max_reading, "
            f"round(coalesce(avg(v), 0.0), {ROUND}) as avg_reading "
            f"from (select {f5('f4')} as v from lines where n_fields > 7)"),
        "stream_clean_records": _raw(f"select {CLEAN_12} from enriched", True),
        "rejected_lines": _raw(_REJECTED),
        "rejected_by_rule": _raw(
            f"select r.reason, count(j.line) as n from (select unnest(['too_few_fields', 'missing_category', "
            f"'missing_item', 'missing_analyte', 'missing_reading']) as reason) r "
            f"left join ({_REJECTED}) j on r.reason = j.reason group by r.reason"),
        "accepted_records": _raw(f"select {CLEAN_12} from enriched", True),
        "stream_rates": _raw(" union all ".join(
            f"select '{k}' as dimension, {k} as key, count(*) as rows, "
            f"count_if({_YES})::double / nullif(count_if({_DECIDED}), 0) as hazard, "
            f"count_if(lower(reading) = 'unknown')::double / count(*) as unknown, "
            f"count_if(lower(flag) = 'na')::double / count(*) as na from enriched group by {k}"
            for k in ("category", "country", "maker")), True),
        "audit_unknown_rate_country_alt": _raw(
            "select country_alt, count_if(lower(reading) = 'unknown')::double / count(*) as rate "
            "from enriched group by country_alt", True),
        "audit_na_rate_country_alt": _raw(
            "select country_alt, count_if(lower(flag) = 'na')::double / count(*) as rate "
            "from enriched group by country_alt", True),
        "hazard_rate_by_authority": by_auth,
        "hazard_by_dual_label": dual,
        "completeness_by_country": _cls(per_country),
        "completeness_weighted_rate": _cls(weighted),
        "hazard_rate_bounds_country": _cls(bounds),
        "hazard_rate_imputed_category": imputed,
        "hazard_rate_drawn_country": drawn,
    }
_PART_SYN = _values("psyn", "alias, canonical", fx.PART_SYNONYMS)


def oracle() -> dict[str, str]:
    q = {
        "limit_lookup": _cls(f"select {M_COLS}, max_reading from classified"),
        "classify": _cls(f"select {M_COLS}, max_reading, flag from classified"),
        "hazard_rate_category": _cls(_rate("category", _YES, _DECIDED)),
        "hazard_category_over_half": _cls(_rate("category", _YES, _DECIDED, 0.5)),
        "hazard_country_over_half": _cls(_rate("country", _YES, _DECIDED, 0.5)),
        "hazard_maker_over_half": _cls(_rate("maker", _YES, _DECIDED, 0.5)),
        "top_makers": _cls(f"select maker, count_if({_YES}) as n from classified group by maker "
                           f"order by n desc, maker asc limit {TOP_K}"),
        "top_items": _cls(f"select item, count_if({_YES}) as n from classified group by item "
                          f"order by n desc, item asc limit {TOP_K}"),
        "na_rate_category": _cls(_rate("category", "lower(flag) = 'na'")),
        "na_rate_country": _cls(_rate("country", "lower(flag) = 'na'")),
        "unknown_rate_category": _meas(_rate("category", "lower(reading) = 'unknown'", src="measurements")),
        "unknown_rate_country": _meas(_rate("country", "lower(reading) = 'unknown'", src="measurements")),
    }
    for key in ("category", "country", "maker"):
        for stat in ("mean", "median", "mode"):
            q[f"{stat}_by_{key}"] = _stat(key, stat)
    q["stddev_by_category"] = _stat("category", "stddev")
    q["stats_by_each_key"] = _meas(" union all ".join(
        f"select * from (select '{k}' as dimension, s.{k} as key, s.mean, s.median, d.mode, s.stddev from "
        f"(select {k}, round(avg(v), {ROUND}) as mean, median(v) as median, round(stddev_pop(v), {ROUND}) as stddev "
        f"from ({_KNOWN.format(k=k)}) group by {k}) s join "
        f"(select {k}, v as mode from (select {k}, v, row_number() over (partition by {k} order by n desc, v asc) "
        f"as rn from (select {k}, v, count(*) as n from ({_KNOWN.format(k=k)}) group by {k}, v)) where rn = 1) d "
        f"using ({k}))" for k in ("category", "country", "maker")))
    known = _KNOWN.format(k="maker")
    q.update({
        "top_k_groups": _meas(f"select maker, round(avg(v), {ROUND}) as mean from ({known}) group by maker "
                              f"order by mean desc, maker asc limit {TOP_K}"),
        "analyte_distribution": _meas("select analyte, count(*) as n from measurements group by analyte"),
        "category_per_analyte_flat": _meas("select analyte, category, count(*) as n from measurements "
                                           "group by analyte, category"),
        "category_per_analyte": _meas(
            "select analyte, string_agg(category || ':' || n, ',' order by category) as counts from "
            "(select analyte, category, count(*) as n from measurements group by analyte, category) t "
            "group by analyte"),
        "value_count": _meas("select count_if(lower(category) = 'promo') as n from measurements"),
        "distinct_category": _meas("select distinct category from measurements"),
        "distinct_analyte": _meas("select distinct analyte from measurements"),
        "distinct_maker": _meas("select distinct maker from measurements"),
        "distinct_country": _meas("select distinct country from measurements"),
        "reading_range": _meas(
            f"select count(*) as n_valid, coalesce(min(v), 0.0) as min_reading, coalesce(max(v), 0.0) as max_reading, "
            f"round(coalesce(avg(v), 0.0), {ROUND}) as avg_reading "
            f"from (select {f5('reading')} as v from measurements) where v is not null"),
        "scan_lines": _raw(f"select value from lines union all select {_HEADER} as value"),
        "drop_header": _raw("select value from lines"),
        "parse_csv": _raw(f"select value, n_fields, {', '.join(_F)} from lines"),
        "arity_guard": _raw("select value, n_fields from lines where n_fields > 10"),
        "required_fields": _raw(
            f"select value from lines where n_fields > 10 and {required('f1')} and {required('f2')} "
            f"and {required('f3')} and {required('f4')}"),
        "standardise_missing": _raw(
            f"select value, {c1('f1')} as category, {c1('f7')} as country, {c1('f10')} as extra_10 "
            f"from lines where n_fields > 10"),
        "clean_reading": _raw(f"select value, {c2('f4')} as reading from lines where n_fields > 10"),
        "clean_records": _raw(f"select {CLEAN_12.replace(', flag', ', max_reading, flag')} from enriched", True),
        "valid_readings": _raw(
            f"select value, reading_value from (select value, {f5('f4')} as reading_value from lines "
            f"where n_fields > 7) where reading_value is not null"),
        "row_count": _raw("select count(*) as n from lines"),
        "row_count_grouped": _raw("select 'records' as key, count(*) as n from lines"),
        "cleaning_report": _raw(
            "select r.raw_records, c.cleaned_records, r.raw_records - c.cleaned_records as dropped, "
            "c.unknown_readings, cast(coalesce(trunc(c.unknown_readings::double / nullif(c.cleaned_records, 0) * 100), 0) "
            "as integer) as unknown_percent, c.na_flags "
            "from (select count(*) as raw_records from lines) r, "
            "(select count(*) as cleaned_records, count_if(reading = 'Unknown') as unknown_readings, "
            "count_if(flag = 'NA') as na_flags from enriched) c", True),
        "scan_clean": _raw(f"select {CLEAN_12} from enriched", True),
        "clean_published": _raw(f"select {CLEAN_12}, case when isnan(v) then null else v end as reading_value "
                                f"from (select *, case when reading <> 'Unknown' then {num('reading')} end as v from enriched)", True),
        "clean_roundtrip": _raw(f"select {CLEAN_12} from enriched", True),
        "catalog_partitioned": _raw(f"select {CLEAN_12} from enriched", True),
        "preview": _raw(f"select {CLEAN_12} from enriched order by record_id limit 10", True),
        "normalise_text": f"select doc_id, {norm('text')} as text_norm from documents",
        "canonical_item": _with(_PART_SYN) + (
            f"select p_partkey, coalesce(s.canonical, {norm('p.p_name')}) as item "
            f"from part p left join psyn s on {norm('p.p_name')} = s.alias"),
    })
    q.update(_alternatives())
    return q
