"""Check queries in plain SQL, one per registered query that SQL can express.

They are written from the meaning of each operator, not from its Spark plan: unions
for long forms, ``quantile_cont`` for quantiles, sub-queries for rules.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np

from dielens.plans import given
from dielens.plans.dies import DIE_EXPRESSIONS, RULE_CLUSTER, die_spec
from dielens.plans.queries import CENTRE_COLUMNS, CENTRES, CLUSTER_COLUMNS, LOTS, MEASURED, MODES, ORDER, VALUE

ROW = 'src_order, src_line, "FID"'


def q(name: str) -> str:
    return f'"{name}"'


def num(expression: str, name: str) -> str:
    return f"round(cast({expression} as double), 6) + 0.0 as {q(name)}"


def whole(expression: str, name: str) -> str:
    return f"cast({expression} as bigint) as {q(name)}"


RAW = "raw as (select " + ", ".join(f"{e} as {q(n)}" for n, e in DIE_EXPRESSIONS.items()) + " from lineitem)"
X_PART = """split_part("FID", ':', 3)"""
BINNED = f"""binned as (
  select *,
    split_part("FID", ':', 1) as "LotId", split_part("FID", ':', 2) as "WaferId",
    (case when {X_PART} like 'N%' then -1 else 1 end) * cast(substr({X_PART}, 2, 4) as integer) as "DieX",
    cast(split_part("FID", ':', 4) as integer) as "DieY",
    split_part("FID", ':', 1) || '_' || split_part("FID", ':', 2) as lot_wafer
  from raw where "BIN_BIT" not like '.:%' and "REPROBE" = '0')"""
CLEAN = (
    "clean as (select * replace ("
    + ", ".join(f"cast({q(c)} as double) as {q(c)}" for c in MEASURED)
    + ") from binned where "
    + " and ".join(f"{q(c)} <> 'X'" for c in MEASURED)
    + ")"
)
DIFF = """diff as (
  select *, greatest("BITQ_V_ALL" - "BITQ_t_ALL", 0.0) as "BITQ_V-t_ALL",
    greatest("BITP_V_ALL" - "BITP_t_ALL", 0.0) as "BITP_V-t_ALL" from clean)"""
CLUSTERED = f"clustered as (select *, {RULE_CLUSTER} as cluster from diff)"
FLAGGED = """flagged as (
  select *, cluster as kmeans, 'cluster_' || cast(cast("BITM_V_ALL" as integer) % 2 + 1 as varchar) as gmm,
    """ + ", ".join(f'cast({rule.replace("`", chr(34))} as integer) as "{m}"' for m, rule in MODES.items()) + """
  from clustered)"""
STEPS = {"raw": RAW, "binned": BINNED, "clean": CLEAN, "diff": DIFF, "clustered": CLUSTERED, "flagged": FLAGGED}


def on(step: str, body: str, *more: str) -> str:
    """A statement over the die frames up to ``step``."""
    names = list(STEPS)
    ctes = [STEPS[n] for n in names[: names.index(step) + 1]]
    return "with " + ",\n".join([*ctes, *more]) + "\n" + body


def melt(frame: str, ids: str, columns: Sequence[str], name: str = "stacked_item", value: str = "value") -> str:
    return " union all ".join(
        f"select {ids}, '{c}' as {name}, {q(c)} as {value} from {frame}" for c in columns
    )


ITEMS = ("__rdV", *CLUSTER_COLUMNS)
REG = ", ".join(q(c) for c in CLUSTER_COLUMNS)


def scan_list() -> str:
    texts = {"START_DATETIME": """strftime("START_DATETIME", '%Y-%m-%d %H:%M:%S') as "START_DATETIME\""""}
    texts["TOTAL_DIE"] = 'cast("TOTAL_DIE" as bigint) as "TOTAL_DIE"'
    return ", ".join(texts.get(c, q(c)) for c in die_spec().scan_columns)


def stats_sql(frame: str, cluster: str, items: Sequence[str] = ITEMS) -> str:
    return f"""select "FAB", "DESIGN_ID", {cluster}, stacked_item, count(value) as num_dies_in_cluster,
      max(value) as die_max_value, min(value) as die_min_value, avg(value) as die_mean_value,
      median(value) as die_median_value
    from ({melt(frame, f'"FAB", "DESIGN_ID", {cluster}', items)}) group by all"""


def counts_sql(frame: str, cluster: str, probe: str = '"__rdV"') -> str:
    return f"""select "FAB", "DESIGN_ID", {cluster}, count(distinct lot_wafer) as num_wafers_in_cluster,
      sum({probe}) as total_bin_count from {frame} group by all"""


def map_sql(frame: str, cluster: str, all_dies: str, per_wafer: str) -> str:
    """The stacked map of one cluster column, with its output columns."""
    keys = f'"FAB", "DESIGN_ID", {cluster}'
    at = f'"DieX", "DieY", {keys}'
    return f"""select m."FAB", m."DESIGN_ID", m."DieX", m."DieY", m.{cluster} as cluster,
      case m.stacked_item when '__rdV' then 'rdV' else m.stacked_item end as stacked_item,
      num_wafers_in_cluster, num_dies_in_cluster,
      die_mean_value * num_dies_in_cluster / {all_dies} as impact,
      median_value, {", ".join(f"w.{q(c)}" for c in CLUSTER_COLUMNS)},
      die_max_value, die_mean_value, die_median_value, die_min_value
    from (select {at}, stacked_item, median(value) as median_value
          from ({melt(frame, at, ITEMS)}) group by all) m
    join (select {at}, {", ".join(f"median({q(c)}) as {q(c)}" for c in CLUSTER_COLUMNS)} from {frame} group by all) w
      using ("DieX", "DieY", "FAB", "DESIGN_ID", {cluster})
    join ({stats_sql(frame, cluster)}) s using ("FAB", "DESIGN_ID", {cluster}, stacked_item)
    join ({counts_sql(frame, cluster)}) c using ("FAB", "DESIGN_ID", {cluster})"""


STATISTICS = (
    "num_wafers_in_cluster",
    "num_dies_in_cluster",
    "impact",
    "die_max_value",
    "die_mean_value",
    "die_median_value",
    "die_min_value",
)
COUNTS = STATISTICS[:2]


def shown_map(columns: Sequence[str], filled: bool = False) -> str:
    """Final select list of map rows: plain types, rounded."""
    out = []
    for c in columns:
        if c in ("DieX", "DieY") or (c in COUNTS and not filled):
            out.append(whole(q(c), c))
        elif c in ("FAB", "DESIGN_ID", "cluster", "model", "stacked_item"):
            out.append(q(c))
        else:
            out.append(num(q(c), c))
    return ", ".join(out)


MAP_COLUMNS = (
    "FAB", "DESIGN_ID", "DieX", "DieY", "cluster", "stacked_item", *COUNTS, "impact", "median_value",
    *CLUSTER_COLUMNS, "die_max_value", "die_mean_value", "die_median_value", "die_min_value",
)
GRID_COLUMNS = ("FAB", "DESIGN_ID", "DieX", "DieY", "model", "cluster", "stacked_item", "median_value", *STATISTICS)


def both_maps() -> list[str]:
    parts = [
        f"select *, '{m}' as model from ({map_sql('flagged', m, '(select count(*) from flagged)', '441')})"
        for m in ("kmeans", "gmm")
    ]
    return ["both_maps as (" + " union all ".join(parts) + ")"]


FULL = """full_map as (
  select * from (select distinct "FAB", "DESIGN_ID", "DieX", "DieY" from both_maps)
    cross join (select distinct model, cluster, stacked_item from both_maps)
    left join both_maps using ("FAB", "DESIGN_ID", "DieX", "DieY", model, cluster, stacked_item))"""
CONTEXT = '"FAB", "DESIGN_ID", cluster, model, stacked_item'
FILLED = (
    'filled as (select "FAB", "DESIGN_ID", "DieX", "DieY", model, cluster, stacked_item, median_value, '
    + ", ".join(f"coalesce({c}, avg({c}) over (partition by {CONTEXT})) as {c}" for c in STATISTICS)
    + " from full_map)"
)
CLUSTER_PARETO = f"""pareto as (
  select *, sum(register_median) over (partition by model, cluster order by position rows unbounded preceding)
      / nullif(sum(register_median) over (partition by model, cluster), 0) * 100 as cumpercentage
  from (select *, row_number() over (partition by model, cluster order by register_median desc, register) as position
        from (select model, cluster, register, median(value) as register_median
              from ({melt('both_maps', 'model, cluster', CLUSTER_COLUMNS, 'register')}) where value is not null group by all))
  where position <= 5)"""


def pareto_sql(threshold: float, crossing: int) -> str:
    sums = " union all ".join(f"select '{c}' as register, sum({q(c)}) as total from diff" for c in CLUSTER_COLUMNS)
    return on(
        "diff",
        f"""select {whole('position', 'position')}, register, {num('total', 'total')}, {num('share', 'share')},
          position <= case when quota < 6 then least(8, n) else quota end as kept
        from (select *, least(count(*) filter (share < {threshold}) over () + {crossing}, n) as quota
          from (select *, row_number() over (order by total desc, register) as position, count(*) over () as n,
                  sum(total) over (order by total desc, register rows unbounded preceding) / sum(total) over () as share
                from ({sums})))""",
    )


def cut_sql(sequential: bool) -> str:
    columns = (VALUE, "BITP_V-t_ALL", "price")
    steps = [
        'priced as (select *, "BITP_V_ALL" * 1000 + src_order * 7 % 1000 + "BITQ_V_ALL" / 64 as price from diff)'
    ]
    last = "priced"
    for i, c in enumerate(columns):
        base = last if sequential else "priced"
        limit = f"""select case when quantile_cont({q(c)}, 0.999) > median({q(c)})
            then quantile_cont({q(c)}, 0.999) else max({q(c)}) end from {base}"""
        steps.append(f"cut{i} as (select * from {last} where {q(c)} <= ({limit}))")
        last = f"cut{i}"
    shown = ", ".join(num(q(c), c) for c in columns)
    return on("diff", f"select {whole('src_order', 'src_order')}, {whole('src_line', 'src_line')}, \"FID\", {shown} from {last}", *steps)


ROW_OUT = f"{whole('src_order', 'src_order')}, {whole('src_line', 'src_line')}, \"FID\""


def knee_sql(curves: str, x: str, y: str) -> str:
    """Knee of falling convex curves, by rescanning the difference curve for each point."""
    return f"""pts as (
      select "LOT_ID", x, round((1 - (y - ylo) / nullif(yhi - ylo, 0)) - (x - xlo) / nullif(xhi - xlo, 0), 12) as d, n
      from (select "LOT_ID", {x} as x, {y} as y, min({x}) over g as xlo, max({x}) over g as xhi, min({y}) over g as ylo,
              max({y}) over g as yhi, count(*) over g as n from {curves} window g as (partition by "LOT_ID"))),
    shape as (
      select *, lead(d) over (partition by "LOT_ID" order by x) as dnext,
        d >= coalesce(lag(d) over w, d) and d >= coalesce(lead(d) over w, d) as top,
        d <= coalesce(lag(d) over w, d) and d <= coalesce(lead(d) over w, d) as low
      from pts window w as (partition by "LOT_ID" order by x)),
    falls as (
      select a."LOT_ID", a.x, max(b.x) as peak
      from shape a join shape b on a."LOT_ID" = b."LOT_ID" and b.x <= a.x and b.top
      group by a."LOT_ID", a.x),
    levels as (
      select a."LOT_ID", a.x, f.peak, a.dnext,
        (select case when s.low then 0.0 else s.d - 1.0 / (s.n - 1) end from shape s
         where s."LOT_ID" = a."LOT_ID" and s.x <= a.x and (s.low or s.top) order by s.x desc limit 1) as level
      from shape a join falls f on f."LOT_ID" = a."LOT_ID" and f.x = a.x),
    knees as (
      select l."LOT_ID", coalesce(arg_min(k.peak, k.x), 1) as knee
      from (select distinct "LOT_ID" from pts) l left join levels k on k."LOT_ID" = l."LOT_ID" and k.dnext < k.level
      group by l."LOT_ID")"""


SUBGROUPS = """subgroups as (select *, cluster || '-' || "FBD_REGION" as "Subgroup" from clustered)"""


def regression_sql(columns: Sequence[str]) -> str:
    return " union all ".join(
        f"""select "Subgroup", {i} as pair, '{a}' as x, '{b}' as y,
          regr_slope({q(b)}, {q(a)}) as slope, regr_r2({q(b)}, {q(a)}) as r2 from subgroups group by "Subgroup\""""
        for i, (a, b) in enumerate(combinations(columns, 2))
    )


def square_sql(centre: Sequence[float]) -> str:
    return "(" + " + ".join(f"pow({q(c)} - {v}, 2)" for c, v in zip(given.COLUMNS, centre)) + ")"


def tree_sql(tree) -> str:
    if isinstance(tree, int):
        return str(tree)
    left, a, right, b = tree
    return f"case when {square_sql(left)} <= {square_sql(right)} then {tree_sql(a)} else {tree_sql(b)} end"


def vote_sql(tree) -> str:
    if isinstance(tree, int):
        return str(tree)
    register, threshold, low, high = tree
    return f"case when {q(register)} <= {threshold} then {vote_sql(low)} else {vote_sql(high)} end"


def density_sql(mean: Sequence[float], covariance: Sequence[Sequence[float]]) -> str:
    """Normal log density from the inverse matrix, all entries written out."""
    inverse, (_, log_det) = np.linalg.inv(np.array(covariance)), np.linalg.slogdet(np.array(covariance))
    gaps = [f"({q(c)} - {m})" for c, m in zip(given.COLUMNS, mean)]
    form = " + ".join(f"({float(inverse[i, j])!r}) * {a} * {b}" for i, a in enumerate(gaps) for j, b in enumerate(gaps))
    return f"(-0.5 * ({form} + {len(gaps) * math.log(2 * math.pi) + float(log_det)!r}))"


def given_queries() -> dict[str, str]:
    """Checks of the models that are given, not fitted."""
    out = {}
    costs = []
    for centres in given.CENTRE_SETS:
        near = "least(" + ", ".join(map(square_sql, centres)) + ")"
        costs.append(
            f"select cast({len(centres)} as bigint) as k, {num(f'avg(sqrt({near}))', 'distortion')}, {num(f'sum({near})', 'inertia')} from diff"
        )
    out["costs_given"] = on("diff", " union all ".join(costs))
    curves = []
    for weights, means, covariances in given.MIXTURES:
        k, d = len(weights), len(given.COLUMNS)
        mass = " + ".join(f"{w} * exp({density_sql(m, c)})" for w, m, c in zip(weights, means, covariances))
        parameters = (k - 1) + k * d + k * d * (d + 1) / 2
        curves.append(
            f"select cast({k} as bigint) as k, sum(ln({mass})) as l, {parameters} as p, count(*) as n from diff"
        )
    out["mixture_bic_given"] = on(
        "diff",
        "select k, round(l, 3) as log_likelihood, round(-2 * l + p * ln(n), 3) as bic, round(-2 * l + 2 * p, 3) as aic from ("
        + " union all ".join(curves) + ")",
    )
    weights, means, covariances = given.MIXTURES[-1]
    scores = [f"{density_sql(m, c)} + ln({w})" for w, m, c in zip(weights, means, covariances)]
    best = " ".join(f"when s{i} >= all_best then {i + 1}" for i in range(len(scores)))
    listed = ", ".join(f"{s} as s{i}" for i, s in enumerate(scores))
    top = "greatest(" + ", ".join(f"s{i}" for i in range(len(scores))) + ")"
    out["gmm_given"] = on(
        "diff",
        f"""select {ROW_OUT}, cast(case {best} end as bigint) as gmm
        from (select *, {top} as all_best from (select {ROW}, {listed} from diff))""",
    )
    rows = []
    for i, (m, c) in enumerate(zip(means, covariances)):
        order = ", ".join([f"{density_sql(m, c)} desc", *[f"{q(x)} desc" for x in given.COLUMNS]])
        rows.append(
            f"select cast({i + 1} as bigint) as component, {', '.join(num(q(x), x) for x in given.COLUMNS)} "
            f"from (select * from diff order by {order} limit 1)"
        )
    out["representative_given"] = on("diff", " union all ".join(rows))
    out["bisecting_given"] = on("diff", f"select {ROW_OUT}, cast({tree_sql(given.TREE)} as bigint) as bisecting from diff")
    far = ", ".join(f"{square_sql(c)} as g{i}" for i, c in enumerate(given.CENTRE_SETS[1]))
    x, y, z = (q(c) for c in given.COLUMNS)
    out["silhouette_given"] = on(
        "diff",
        f"""select {num('avg(case when n = 1 then 0 else (b - a) / greatest(a, b) end)', 'silhouette')} from (
          select id, any_value(own) as own, any_value(n) filter (own = label) as n,
            max(case when own = label then gap * n / (n - 1) end) as a, min(case when own <> label then gap end) as b
          from (select p.id, p.label as own, c.label, c.n,
                  p.x * p.x + p.y * p.y + p.z * p.z + c.w - 2 * (p.x * c.x + p.y * c.y + p.z * c.z) as gap from placed p cross join centres c)
          group by id)""",
        f"""placed as (select row_number() over () as id, x, y, z,
          case when g0 <= g1 and g0 <= g2 then 1 when g1 <= g2 then 2 else 3 end as label
          from (select {x} as x, {y} as y, {z} as z, {far} from diff))""",
        """centres as (select label, count(*) as n, avg(x) as x, avg(y) as y, avg(z) as z, avg(x * x + y * y + z * z) as w
          from placed group by label)""",
    )
    scores = [
        num("(" + " + ".join(f"({q(c)} - {m}) * {w}" for c, m, w in zip(given.COLUMNS, given.MEANS, ws)) + f") / {s}", f"PC{i + 1}")
        for i, (ws, s) in enumerate(zip(given.LOADINGS, given.SPREADS))
    ]
    out["components_given"] = on("diff", f"select {ROW_OUT}, {', '.join(scores)} from diff")
    votes = " + ".join(map(vote_sql, given.FOREST))
    out["forest_given"] = on("diff", f"select {ROW_OUT}, cast(({votes}) >= {len(given.FOREST) // 2 + 1} as bigint) as \"HighQ\" from diff")
    return out


def no_nan(expression: str) -> str:
    return f"case when isnan({expression}) then null else {expression} end"


def all_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    wanted = ", ".join(f"'{lot[:7]}'" for lot in LOTS)
    out["scan_by_lot"] = on(
        "raw", f"""select {scan_list()} from raw where substr("LOT_ID", 1, 7) in ({wanted}) and "FAB" = '15'"""
    )
    out["scan_by_time"] = on(
        "raw",
        f"""select {scan_list()} from raw where cast("START_DATETIME" as date) between date '1996-02-01'
        and date '1997-01-31' and "FAB" = '10' and "DESIGN_ID" = 'Z32M'""",
    )
    names = ["BITQ_V_ALL", "BITP_V_ALL", "BITQ_t_ALL", "BITP_t_ALL"]
    out["tall_to_wide"] = on(
        "raw", f"select {ROW_OUT}, {', '.join(f'max({q(n)}) as {q(n)}' for n in names)} from raw group by {ROW}"
    )
    out["catalog_lookup"] = """select "Failure_Mode", string_agg(feature, '|' order by feature) as features,
        'models/fab15/Z32M/rdV/' || "Failure_Mode" as model_path
      from (select distinct p_brand as "Failure_Mode", p_name as feature from part
            where p_size % 2 = 0 and p_type in ('ECONOMY', 'SMALL', 'MEDIUM') and p_size % 3 <> 0)
      group by "Failure_Mode\""""

    out["design_family"] = on(
        "raw",
        """select "DESIGN_ID", case when left("DESIGN_ID", 1) in ('U','V','X','Y','Z') then 'DRAM'
          when left("DESIGN_ID", 1) in ('B','F','G','L','M','N') then 'NAND'
          when left("DESIGN_ID", 1) in ('S','H') then '3DXP' else 'OTHER' end as design_family,
          count(*) as dies from raw group by all""",
    )
    out["normalise_date"] = """select event_id,
        case event_id % 3 when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') when 1 then strftime(ts, '%y%m%d')
          else event_type end as spelled,
        case event_id % 3 when 2 then null else strftime(ts, '%y%m%d') end as day from events"""
    out["zone_code"] = on(
        "raw",
        """select "FBD_REGION" as zone, cast(strpos('ABCDE', "FBD_REGION") as bigint) as code,
          cast(nullif(strpos('ABCDE', "FBD_REGION"), 0) as double) as code_or_null, count(*) as dies
        from raw group by all""",
    )

    out["filter_unbinned"] = on("raw", f"""select {ROW_OUT}, "BIN_BIT" from raw where left("BIN_BIT", 2) <> '.:'""")
    out["filter_bin_step"] = on(
        "raw",
        f"""select {ROW_OUT}, "STEP_BIN" from raw where strpos("STEP_BIN", 'NA!') = 0 and strpos("STEP_BIN", '.') = 0""",
    )
    out["filter_first_pass"] = on("raw", f"""select {ROW_OUT}, "REPROBE" from raw where "REPROBE" = '0'""")
    out["parse_fid"] = """with """ + RAW + f"""
      select "FID", split_part("FID", ':', 1) as "LotId", split_part("FID", ':', 2) as "WaferId",
        cast(case when left({X_PART}, 1) = 'N' then '-' || substr({X_PART}, 2) else substr({X_PART}, 2) end as bigint) as "DieX",
        cast(split_part("FID", ':', 4) as bigint) as "DieY", "LOT_ID" || '_' || "WAFER_ID" as lot_wafer from raw"""
    out["drop_failed_dies"] = on("clean", f"select {ROW_OUT}, {', '.join(num(q(c), c) for c in MEASURED)} from clean")
    out["count_failed_dies"] = on(
        "binned",
        """select count(*) as dies, count(*) filter ("BITQ_V_ALL" = 'X' or "BITP_V_ALL" = 'X') as failed_dies from binned""",
    )
    out["filter_target_bin"] = on("binned", f"""select {ROW_OUT}, "BIN_BIT" from binned where "BIN_BIT" like '%:O'""")
    out["bin_indicator"] = on(
        "binned",
        f"""select {ROW_OUT}, cast("BIN_BIT" like 'A:%' as bigint) as fails_bin,
          cast("STEP_BIN" = 'N' as bigint) as fails_step from binned""",
    )

    distinct = " union all ".join(
        f"select '{c}' as register, count(distinct {q(c)}) as n_distinct from binned" for c in MEASURED
    )
    out["register_cardinality"] = on("binned", distinct)
    out["informative_registers"] = on(
        "binned",
        f"""select register from ({distinct})
        where n_distinct not in (1, 2) or register in ('__rdV', '__rdt', 'BITB_V_ALL')""",
    )
    out["dependent_difference"] = on(
        "clean",
        f"""select {ROW_OUT},
          {num('case when "BITQ_V_ALL" > "BITQ_t_ALL" then "BITQ_V_ALL" - "BITQ_t_ALL" else 0 end', 'BITQ_V-t_ALL')},
          {num('case when "BITP_V_ALL" > "BITP_t_ALL" then "BITP_V_ALL" - "BITP_t_ALL" else 0 end', 'BITP_V-t_ALL')}
        from clean""",
    )
    out["register_pareto"] = pareto_sql(0.99, 1)
    out["register_pareto_strict"] = pareto_sql(0.97, 0)

    out["quantile_cut"] = cut_sql(sequential=True)
    out["quantile_cut_single_pass"] = cut_sql(sequential=False)
    out["wafer_outliers"] = on(
        "diff",
        """select lot_wafer, case when wafer_out then 'outlier_map' else 'Normal' end as ooc_label, count(*) as dies
        from diff join second using (lot_wafer) group by all""",
        f"""wafers as (select lot_wafer, avg("__rdV") as a, avg({q(VALUE)}) as b from diff group by 1)""",
        """first as (select *, a > (select median(a) + 0.5 * stddev_samp(a) from wafers) as out_a from wafers)""",
        """second as (select lot_wafer, out_a or b > (select median(b) + 0.5 * stddev_samp(b) from first where not out_a)
          as wafer_out from first)""",
    )
    out["cbrt_transform"] = on(
        "diff", f"select {ROW_OUT}, {', '.join(num(f'cbrt({q(c)})', c + '_norm') for c in CLUSTER_COLUMNS)} from diff"
    )
    scaled = ", ".join(
        num(
            f"""coalesce(({q(c)} - (select avg({q(c)}) from diff)) / nullif((select stddev_pop({q(c)}) from diff), 0), 0)""",
            c + "_norm",
        )
        for c in (*CLUSTER_COLUMNS, "BITK_V_ALL")
    )
    out["standard_scale"] = on("diff", f"select {ROW_OUT}, {scaled} from diff")
    out["covariance_matrix"] = on(
        "diff",
        " union all ".join(
            f"select '{a}' as column_a, '{b}' as column_b, {num(f'covar_samp({q(a)}, {q(b)})', 'covariance')} from diff"
            for a, b in combinations_with_replacement(CLUSTER_COLUMNS, 2)
        ),
    )

    curves = """curves as (select "LOT_ID", x, cast(count(*) filter ("BITQ_V_ALL" * "BITQ_V_ALL" > 100 * x) as double) as y
      from clean cross join (select unnest(range(1, 25)) as x) group by "LOT_ID", x)"""
    out["knee_point"] = on(
        "clean", 'select "LOT_ID", cast(knee as bigint) as knee from knees', curves, knee_sql("curves", "x", "y")
    )
    bics = """curves as (select "LOT_ID", src_order % 9 + 1 as k, sum("BITQ_V_ALL") as bic from clean group by all)"""
    out["bic_choice"] = on(
        "clean",
        """select "LOT_ID", cast(first_minimum as bigint) as first_minimum, cast(knee as bigint) as knee,
          cast(floor((coalesce(first_minimum, knee) + knee) / 2.0) as bigint) as chosen_k
        from knees join minima using ("LOT_ID")""",
        bics,
        knee_sql("curves", "k", "bic"),
        """minima as (select a."LOT_ID", min(a.k) filter (a.bic < p.bic and a.bic < n.bic) as first_minimum from curves a
          left join curves p on p."LOT_ID" = a."LOT_ID" and p.k = (select max(k) from curves z where z."LOT_ID" = a."LOT_ID" and z.k < a.k)
          left join curves n on n."LOT_ID" = a."LOT_ID" and n.k = (select min(k) from curves z where z."LOT_ID" = a."LOT_ID" and z.k > a.k)
          group by a."LOT_ID")""",
    )
    square = " + ".join(f"pow({q(c)} - (select avg({q(c)}) from diff), 2)" for c in CLUSTER_COLUMNS)
    inertia = " + ".join(f"var_pop({q(c)}) * count(*)" for c in CLUSTER_COLUMNS)
    out["k1_inertia"] = on("diff", f"select {num(f'avg(sqrt({square}))', 'distortion')}, {num(inertia, 'inertia')} from diff")

    far = [
        " + ".join(f"pow({q(c)} - {v}, 2)" for c, v in zip(CENTRE_COLUMNS, centre)) for centre in CENTRES
    ]
    label = f"""case when a <= b and a <= c then 1 when b <= c then 2 else 3 end"""
    out["nearest_centre"] = on(
        "diff",
        f"""select {ROW_OUT}, cast({label} as bigint) as label, 'cluster_' || cast({label} as varchar) as cluster
        from (select {ROW}, {', '.join(f'{e} as {n}' for e, n in zip(far, 'abc'))} from diff)""",
    )

    wafer_sums = ", ".join(f"sum({q(c)}) as {q(c)}" for c in CLUSTER_COLUMNS)
    out["cluster_top_features"] = on(
        "clustered",
        f"""select cluster, position, register, {num('importance', 'importance')} from (
          select *, row_number() over (partition by cluster order by importance desc, register desc) as position
          from (select cluster, register, median(value) as importance
                from ({melt('wafer_sums', 'cluster', CLUSTER_COLUMNS, 'register')}) group by all))
        where position <= 5""",
        f"""wafer_sums as (select cluster, "LOT_ID", "WAFER_ID", {wafer_sums} from clustered group by all)""",
    )
    out["pairwise_regression"] = on(
        "clustered",
        f"""select "Subgroup", {whole('pair', 'pair')}, x, y, {num(no_nan('slope'), 'slope')}, {num(no_nan('r2'), 'r2')}
        from ({regression_sql((*CLUSTER_COLUMNS, 'BITK_V_ALL'))})""",
        SUBGROUPS,
    )
    out["penalised_slope"] = on(
        "clustered",
        f"""select "Subgroup", {whole('pair', 'pair')}, x, y,
          {num(f"coalesce(({no_nan('slope')}) * ({no_nan('r2')}), 0)", 'penalised_slope')}
        from ({regression_sql(('BITK_V_ALL', *CLUSTER_COLUMNS))})""",
        SUBGROUPS,
    )

    total = " + ".join(q(m) for m in MODES)
    out["split_labelled"] = on(
        "flagged",
        f"""select {ROW_OUT}, {', '.join(whole(q(m), m) for m in MODES)}, {whole(total, 'total')},
          case when {total} > 0 then 'labelled' else 'unlabelled' end as side from flagged""",
    )
    out["round_scores"] = on(
        "diff",
        f"""select {ROW_OUT}, {num('"BITD_V_ALL" / 2', 'score')}, {whole('round_even("BITD_V_ALL" / 2, 0)', 'flag')} from diff""",
    )

    out["cluster_wafer_counts"] = on(
        "clustered",
        f"""select "FAB", "DESIGN_ID", cluster, num_wafers_in_cluster, {num('total_bin_count', 'total_bin_count')}
        from ({counts_sql('clustered', 'cluster')})""",
    )
    stat_columns = ("die_max_value", "die_min_value", "die_mean_value", "die_median_value")
    stats = ", ".join(num(c, c) for c in stat_columns)
    out["cluster_item_stats"] = on(
        "clustered",
        f"""select "FAB", "DESIGN_ID", cluster, stacked_item, num_dies_in_cluster, {stats}
        from ({stats_sql('clustered', 'cluster')})""",
    )
    out["cluster_impact"] = on(
        "clustered",
        f"""select "FAB", "DESIGN_ID", cluster, stacked_item, num_dies_in_cluster, {stats}, num_wafers_in_cluster,
          cast(total_bin_count as bigint) as total_bin_count,
          {num('total_bin_count / num_wafers_in_cluster / 441', 'die_loss')},
          {num("case when stacked_item = 'BIN_BIT' then total_bin_count / num_wafers_in_cluster / 441 else "
               "die_mean_value * num_dies_in_cluster / (select count(*) from clustered) end", 'impact')}
        from ({stats_sql('failing', 'cluster', ('BIN_BIT', *CLUSTER_COLUMNS))})
        join ({counts_sql('failing', 'cluster', '"BIN_BIT"')}) using ("FAB", "DESIGN_ID", cluster)""",
        """failing as (select * replace (cast("BIN_BIT" like 'A:%' as integer) as "BIN_BIT") from clustered)""",
    )
    at = '"DieX", "DieY", "FAB", "DESIGN_ID", cluster'
    out["stacked_die_median"] = on(
        "clustered",
        f"""select {whole('"DieX"', 'DieX')}, {whole('"DieY"', 'DieY')}, "FAB", "DESIGN_ID", cluster, stacked_item,
          {num('median(value)', 'median_value')} from ({melt('clustered', at, ITEMS)})
        group by "DieX", "DieY", "FAB", "DESIGN_ID", cluster, stacked_item""",
    )
    out["stacked_map"] = on(
        "clustered",
        f"select {shown_map(MAP_COLUMNS)} from ({map_sql('clustered', 'cluster', '(select count(*) from clustered)', '441')})",
    )
    known = " union all ".join(
        f"select *, '{m}' as failure_mode from flagged where {q(m)} = 1" for m in MODES
    )
    dies = "(select count(*) from flagged)"
    parts = []
    for m in ("kmeans", "gmm"):
        parts.append(f"select *, '{m}' as model from ({map_sql('rest', m, dies, '441')})")
        parts.append(f"select *, '{m}' as model from ({map_sql('known', 'failure_mode', dies, '441')})")
    out["stacked_map_labelled"] = on(
        "flagged",
        f"select {shown_map((*MAP_COLUMNS, 'model'))} from ({' union all '.join(parts)})",
        f"rest as (select * from flagged where {total} = 0)",
        f"known as ({known})",
    )
    out["cluster_pareto"] = on(
        "flagged",
        f"""select model, cluster, position, register, {num('register_median', 'register_median')},
          {num('cumpercentage', 'cumpercentage')} from pareto""",
        *both_maps(),
        CLUSTER_PARETO,
    )
    out["full_die_map"] = on("flagged", f"select {shown_map(GRID_COLUMNS, filled=True)} from full_map", *both_maps(), FULL)

    out["group_mean_fill"] = on(
        "flagged", f"select {shown_map(GRID_COLUMNS, filled=True)} from filled", *both_maps(), FULL, FILLED
    )
    number = "coalesce(cast(cast(round({0} * 1000) as bigint) as varchar), 'null')"
    out["cluster_signature"] = on(
        "flagged",
        f"""select {CONTEXT}, {', '.join(num(f'avg({c})', c) for c in STATISTICS)},
          string_agg("DieX" || ':' || "DieY" || ':' || {number.format('median_value')}, ',' order by "DieX", "DieY") as die_info
        from filled group by {CONTEXT}""",
        *both_maps(),
        FULL,
        FILLED,
    )
    context = '"FAB", "DESIGN_ID", "LOT_ID", "WAFER_ID", lot_wafer'
    out["wafer_association"] = on(
        "flagged",
        f"""select {context}, model, cluster, string_agg("DieX" || ':' || "DieY", ',' order by "DieX", "DieY") as die_coordinates,
          count(*) as wafer_die_count
        from (select *, 'kmeans' as model, kmeans as cluster from merged
              union all select *, 'gmm' as model, gmm as cluster from merged)
        group by all""",
        f"""merged as (select distinct {context}, "DieX", "DieY", kmeans, gmm from flagged)""",
    )
    out["cluster_pareto_lists"] = on(
        "flagged",
        f"""select model, cluster, string_agg(register, ',' order by position) as register,
          string_agg({number.format('register_median')}, ',' order by position) as register_median,
          string_agg({number.format('cumpercentage')}, ',' order by position) as cumpercentage
        from pareto group by model, cluster""",
        *both_maps(),
        CLUSTER_PARETO,
    )
    mode = "case when \"HighP\" = 1 then 'HighP' when \"HighQ\" = 1 then 'HighQ' else {0} end as {0}"
    out["merge_labelled"] = on(
        "flagged",
        f"""select distinct {context}, cast("DieX" as bigint) as "DieX", cast("DieY" as bigint) as "DieY",
          {mode.format('kmeans')}, {mode.format('gmm')} from flagged""",
    )

    out["sample_counts"] = on(
        "clustered", "select cluster, least(count(*), 9000) as sampled_rows from clustered group by cluster"
    )
    sums = " union all ".join(f"select '{c}' as register, sum({q(c)}) as total from clustered" for c in CLUSTER_COLUMNS)
    value = lambda c: "case " + c + " " + " ".join(f"when '{x}' then {q(x)}" for x in CLUSTER_COLUMNS) + " end"
    out["pair_points"] = on(
        "clustered",
        f"""select {ROW_OUT}, case cluster when 'cluster_1' then 'Within Cluster' else 'Outside Cluster' end as side,
          x_register, y_register, {num(value('x_register'), 'x')}, {num(value('y_register'), 'y')}
        from clustered cross join (
          select a.register as x_register, b.register as y_register from ranked a join ranked b on a.position < b.position and b.position <= 5)""",
        f"ranked as (select *, row_number() over (order by total desc, register) as position from ({sums}))",
    )

    order = ", ".join(f"{q(c)} desc" for c in ORDER)
    design = '"FAB", "DESIGN_ID"'
    out["wafer_grid"] = on(
        "diff",
        f"""select {design}, "LOT_ID", "WAFER_ID", cast(x as bigint) as x, cast(y as bigint) as y, {num('coalesce(value, 0)', 'value')}
        from (select distinct {design}, "LOT_ID", "WAFER_ID" from diff)
        join (select {design}, unnest(range(0, dx + 1)) as x, dy from extents) using ("FAB", "DESIGN_ID")
        join (select unnest(range(0, (select max(dy) + 1 from extents))) as y) on y <= dy
        left join lasts using ("FAB", "DESIGN_ID", "LOT_ID", "WAFER_ID", x, y)""",
        f"""extents as (select {design}, min("DieX") as x0, min("DieY") as y0, max("DieX") - min("DieX") as dx,
          max("DieY") - min("DieY") as dy from diff group by all)""",
        f"""lasts as (select {design}, "LOT_ID", "WAFER_ID", "DieX" - x0 as x, "DieY" - y0 as y, {q(VALUE)} as value
          from diff join extents using ("FAB", "DESIGN_ID")
          qualify row_number() over (partition by {design}, "LOT_ID", "WAFER_ID", "DieX", "DieY" order by {order}) = 1)""",
    )
    bounds = f"bounds as (select min({q(VALUE)}) as low, quantile_cont({q(VALUE)}, 0.97) as high from diff)"
    unit = f"least(greatest(({q(VALUE)} - low) / (high - low), 0), 1)"
    out["minmax_q97"] = on("diff", f"select {ROW_OUT}, {num(unit, 'scaled')} from diff, bounds", bounds)
    out["equalise_levels"] = on(
        "diff",
        f"""select {ROW_OUT}, "LOT_ID", "WAFER_ID", {whole('level', 'level')},
          cast(coalesce(round_even((cdf - first_cdf) * 255.0 / nullif(n - first_cdf, 0), 0), level) as bigint) as equalised
        from (select *, min(cdf) over (partition by "LOT_ID", "WAFER_ID") as first_cdf from (
          select *, count(*) over (partition by "LOT_ID", "WAFER_ID" order by level) as cdf,
            count(*) over (partition by "LOT_ID", "WAFER_ID") as n from levels))""",
        bounds,
        f"levels as (select {ROW}, \"LOT_ID\", \"WAFER_ID\", cast(floor({unit} * 255) as integer) as level from diff, bounds)",
    )
    ranked = " union all ".join(
        f"""select "LOT_ID", "WAFER_ID", {i} as i, '{c}' as register, sum({q(c)}) as total from diff group by all"""
        for i, c in enumerate(CLUSTER_COLUMNS)
    )
    out["wafer_top_register"] = on(
        "diff",
        f"""select "LOT_ID", "WAFER_ID", register as top_register from ({ranked})
        qualify row_number() over (partition by "LOT_ID", "WAFER_ID" order by total desc, i) = 1""",
    )
    return out | given_queries()
