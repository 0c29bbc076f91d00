"""The registered queries again, as SQL that DuckDB runs on the same tables.

Written against the raw tables and apart from the Spark operators: plain windows, whole
joins and library aggregates, which are right at test size and easy to check by reading.
"""

from __future__ import annotations

from riskloom import catalog as cat
from riskloom.functions import normal
from riskloom.plans.queries import PARAMS
from riskloom.sources.sample import SAMPLE_SQL

KEY = cat.KEY


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def dec(expression: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0"


APPS = (
    "apps as (select "
    + ", ".join(f"{sql} as {name}" for name, sql in SAMPLE_SQL.items())
    + " from (select o_orderkey as k, o_custkey as c, o_totalprice from orders"
    " join customer on o_custkey = c_custkey))"
)

TARGET = f"case {cat.LABEL} when 1 then 1 when 2 then 0 end"
RISK = f"case {cat.LABEL} when 1 then 'Good' when 2 then 'Bad' end"


def decode_sql(a: cat.Attribute) -> str:
    arms = " ".join(f"when {text(c)} then {text(t)}" for c, t, _, _ in a.codes if t is not None)
    return f"case {a.raw} {arms} else 'unknown' end"


RATIO_SQL = f"cast({cat.AMOUNT} as double) / nullif({cat.DURATION}, 0)"
AGE_SQL = (
    f"case when {cat.AGE} < 25 then 'Under_25' when {cat.AGE} >= 25 and {cat.AGE} <= 40"
    " then '25_to_40' else 'Over_40' end"
)
AGE_FLAG_SQL = {
    "age_under_25": f"cast({cat.AGE} < 25 as int)",
    "age_25_to_40": f"cast({cat.AGE} >= 25 and {cat.AGE} <= 40 as int)",
    "age_over_40": f"cast({cat.AGE} > 40 as int)",
}
FLAG_SQL = {
    flag: f"cast({a.raw} = {text(code)} as int)" for a in cat.ATTRIBUTES for code, _, flag, _ in a.codes
}


def view_columns() -> dict[str, str]:
    """Column name to SQL, for the 98 columns."""
    columns = {c: c for c in cat.RAW_ORDER}
    columns |= {cat.RATIO: RATIO_SQL, cat.AGE_GROUP: AGE_SQL} | AGE_FLAG_SQL
    for a in cat.ATTRIBUTES:
        columns[a.decoded] = decode_sql(a)
    columns |= FLAG_SQL
    columns |= {cat.repeat_name(c): c for c in cat.REPEATED}
    return columns


def select_from_apps(columns: dict[str, str], key: bool = True) -> str:
    listed = ([KEY] if key else []) + [f"{sql} as {quoted(n)}" for n, sql in columns.items()]
    return f"select {', '.join(listed)} from apps"


VIEW = f"v as ({select_from_apps(view_columns() | {'Target': TARGET, 'risk': RISK})})"


def on_apps(body: str) -> str:
    return f"with {APPS} {body}"


def on_view(body: str, *ctes: str) -> str:
    return f"with {', '.join([APPS, VIEW, *ctes])} {body}"


def value_case(name: str) -> str:
    arms = " ".join(f"when {text(k)} then {text(v)}" for k, v in cat.VALUE_NAMES[name].items())
    return f"case {name} {arms} end"


# --- split ----------------------------------------------------------------------------

SPLIT = (
    "numbered as (select *, row_number() over (partition by \"Target\" order by"
    f" md5(concat('{PARAMS.seed}:split:', {KEY}))) as rn,"
    " count(*) over (partition by \"Target\") as size from v), "
    "split as (select *, case when rn <= round(size * cast("
    f"{PARAMS.test_fraction} as double)) then 'test' else 'train' end as part from numbered)"
)


def uniform(purpose: str, *keys: str) -> str:
    joined = ", ':', ".join(keys)
    digest = f"md5(concat('{PARAMS.seed}:{purpose}:', {joined}))"
    return f"(cast(cast(concat('0x', substr({digest}, 1, 13)) as bigint) as double) / 4503599627370496.0)"


def folds_sql() -> str:
    n = PARAMS.folds
    above = " + ".join(f"cast(rn > floor(size * {i} / {n}.0) as int)" for i in range(1, n))
    return on_view(
        f"select {KEY}, \"Target\", {above} as fold from (select {KEY}, \"Target\","
        f" row_number() over (partition by \"Target\" order by md5(concat('{PARAMS.seed}:fold:', {KEY}))) as rn,"
        " count(*) over (partition by \"Target\") as size from split where part = 'train')",
        SPLIT,
    )


# each sweep squares what is left beside the diagonal, once that is small
JACOBI_SWEEPS = 8
SEX_SQL = "coalesce(cast(lower(substr(status_sex_desc, 1, 1)) = 'm' as int), 0)"


def filled_inputs() -> dict[str, str]:
    """Every model input, with what stands for its missing values."""
    inputs = [c for c in (*cat.NUMBERS, cat.RATIO, *cat.FLAGS) if c != cat.LABEL]
    missing = {cat.AGE: f"median({cat.AGE}) filter (where part = 'train') over ()"}
    filled = {c: f"coalesce(cast({c} as double), {missing.get(c, 0)})" for c in inputs}
    return filled | {"Sex": f"cast({SEX_SQL} as double)"}


def scaled_sql(shift: str, spread: str) -> str:
    filled, columns = filled_inputs(), []
    for c in filled:
        center, width = shift.format(c=c), spread.format(c=c)
        columns.append(f"{dec(f'({c} - {center}) / coalesce(nullif({width}, 0), 1)')} as {c}")
    values = ", ".join(f"{sql} as {c}" for c, sql in filled.items())
    return on_view(f"select {KEY}, \"Target\", part, {', '.join(columns)} from (select {KEY}, \"Target\", part, {values} from split)", SPLIT)


def spectrum_sql() -> str:
    """Traces of powers of the training correlations, over the trace to the same power."""
    filled = filled_inputs()
    values = ", ".join(f"{sql} as {c}" for c, sql in filled.items())
    return on_view(
        f"select cast({len(filled)} as bigint) as components, {dec('cast(1 as double)')} as power_1,"
        f" {dec('(select sum(r * r) from pairs) / pow(m, 2)')} as power_2,"
        f" {dec('(select sum(s.r * p.r) from squared s join pairs p using (i, j)) / pow(m, 3)')} as power_3,"
        f" {dec('(select sum(r * r) from squared) / pow(m, 4)')} as power_4"
        " from (select cast(count(*) as double) as m from pairs where i = j)",
        SPLIT,
        f"inputs as (select {KEY}, part, {values} from split)",
        f"long as (unpivot (select * exclude (part) from inputs where part = 'train') on {', '.join(filled)} into name i value x)",
        "stats as (select i, avg(x) as mean, stddev_pop(x) as sd from long group by i having max(x) > min(x))",
        f"scaled as (select {KEY}, i, (x - mean) / sd as z from long join stats using (i))",
        f"pairs as (select a.i, b.i as j, avg(a.z * b.z) as r from scaled a join scaled b using ({KEY}) group by all)",
        "squared as (select a.i, b.j, sum(a.r * b.r) as r from pairs a join pairs b on a.j = b.i group by all)",
    )


def components_sql(body: str) -> str:
    """``body`` over spectrum(component, ratio, cumulative), loadings(i, component, v),
    scaled(key, part, i, z) and inputs.

    The training correlations are turned by Jacobi rotations: 34 disjoint pairs at a time for
    68 inputs, paired as in a round-robin tournament, so that each pair meets once a sweep.
    """
    filled = filled_inputs()
    values = ", ".join(f"{sql} as {c}" for c, sql in filled.items())
    names = ", ".join(f"({text(c)}, {n})" for n, c in enumerate(filled))
    even = len(filled) + len(filled) % 2
    rounds = even - 1
    last = rounds * JACOBI_SWEEPS
    partner = f"(r - i + {rounds}) % {rounds}"
    return f"with recursive {APPS}, {VIEW}, {SPLIT}, " + ", ".join([
        f"inputs as (select {KEY}, risk, \"Target\", part, {values} from split)",
        f"long as (unpivot (select * exclude (risk, \"Target\") from inputs) on {', '.join(filled)} into name feature value x)",
        f"names(feature, i) as (values {names})",
        "stats as (select feature, avg(x) as mean, stddev_pop(x) as sd from long where part = 'train' group by feature having max(x) > min(x))",
        f"scaled as (select {KEY}, part, i, (x - mean) / sd as z from long join stats using (feature) join names using (feature))",
        f"pairs as (select a.i, b.i as j, avg(a.z * b.z) as r from scaled a join scaled b using ({KEY}) where a.part = 'train' group by all)",
        f"turns as (select r, i, case when i = {rounds} then case when r % 2 = 0 then r // 2 else (r + {rounds}) // 2 end"
        f" when {partner} = i then {rounds} else {partner} end as p from range({rounds}) t(r), range({even}) u(i))",
        # a: the matrix so far; v: the product of the rotations
        "jacobi as (select 0 as step, i, j, r as a, cast(cast(i = j as int) as double) as v from pairs union all select * from ("
        f"with now as (select max(step) as step from jacobi),"
        " angles as (select t.i, t.p, case when o.a <> 0 then (q.a - d.a) / (2 * o.a) end as tau from turns t"
        f" join now on t.r = now.step % {rounds} left join jacobi d on d.i = t.i and d.j = t.i"
        " left join jacobi o on o.i = t.i and o.j = t.p left join jacobi q on q.i = t.p and q.j = t.p where t.i < t.p),"
        " tans as (select i, p, case when tau is null then 0.0 when tau >= 0 then 1 / (tau + sqrt(1 + tau * tau))"
        " else 1 / (tau - sqrt(1 + tau * tau)) end as t from angles),"
        " turned as (select i, p, 1 / sqrt(1 + t * t) as c, -t / sqrt(1 + t * t) as e from tans"
        " union all select p, i, 1 / sqrt(1 + t * t), t / sqrt(1 + t * t) from tans)"
        " select s.step + 1, s.i, s.j, x.c * y.c * s.a + coalesce(x.c * y.e * sj.a, 0) + coalesce(x.e * y.c * si.a, 0)"
        " + coalesce(x.e * y.e * sij.a, 0), y.c * s.v + coalesce(y.e * sj.v, 0)"
        " from jacobi s join turned x on x.i = s.i join turned y on y.i = s.j"
        " left join jacobi sj on sj.i = s.i and sj.j = y.p left join jacobi si on si.i = x.p and si.j = s.j"
        f" left join jacobi sij on sij.i = x.p and sij.j = y.p where s.step < {last}))",
        f"done as (select i, j, a, v from jacobi where step = {last})",
        "ranked as (select j, a, row_number() over (order by a desc, j) as component from done where i = j)",
        # inputs that never vary have no row above, and explain nothing
        f"spectrum as (select cast(component as int) as component, ratio, sum(ratio) over (order by component) as cumulative"
        f" from (select n as component, coalesce(a / sum(a) over (), 0) as ratio from range(1, {len(filled) + 1}) t(n)"
        " left join ranked on component = n))",
        "peaks as (select j, min(i) as i from (select j, i, abs(v) >= max(abs(v)) over (partition by j) - 1e-9 as high from done) where high group by j)",
        "signs as (select d.j, case when d.v >= 0 then 1 else -1 end as sign from done d join peaks using (i, j))",
        "loadings as (select d.i, component, v * sign as v from done d join ranked using (j) join signs using (j))",
    ]) + f" {body}"


def kept_sql() -> str:
    return f"(select coalesce(min(component) filter (where cumulative >= {PARAMS.variance_kept}), max(component)) from spectrum)"


def pca_2d_sql() -> str:
    first, second = (f"sum(z * v) filter (where component = {c})" for c in (1, 2))
    return components_sql(
        f"select {KEY}, {dec(first)} as pc1, {dec(second)} as pc2, case when any_value(\"Target\") = 1 then 'Good' else 'Bad' end as risk"
        f" from scaled join loadings using (i) join inputs using ({KEY}) where scaled.part = 'train' and component <= 2 group by {KEY}"
    )


def pca_loadings_sql() -> str:
    """An input that never varies loads on nothing."""
    return components_sql(
        f"select feature as input, cast(n as int) as component, {dec('coalesce(v, 0)', 4)} as loading"
        f" from names cross join range(1, {kept_sql()} + 1) t(n) left join loadings l on l.i = names.i and l.component = n"
    )


def pca_moments_sql() -> str:
    return components_sql(
        f"select part, component, count(*) as n, {dec('avg(value)')} as mean, {dec('avg(value * value)')} as square,"
        f" {dec('avg(abs(value))')} as size from (select {KEY}, part, component, sum(z * v) as value from scaled join"
        f" (select i, cast(component as int) as component, v from loadings where component <= {kept_sql()}) using (i)"
        f" group by {KEY}, part, component) group by part, component"
    )


_TRAIN = "filter (where part = 'train') over ()"

# --- statistics -----------------------------------------------------------------------

NUMERIC = [c for c in (*cat.NUMBERS, cat.RATIO, *cat.FLAGS)]


def describe_sql(places: int, columns: dict[str, str] | None = None) -> str:
    """``columns`` gives the features that are described and the column each one reads."""
    rows = [
        f"select {text(name)} as feature, count({c}) as count, {dec(f'avg({c})', places)} as mean,"
        f" {dec(f'stddev_samp({c})', places)} as std, {dec(f'cast(min({c}) as double)', places)} as min,"
        + "".join(
            f" {dec(f'quantile_cont(cast({c} as double), {p})', places)} as {n},"
            for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        )
        + f" {dec(f'cast(max({c}) as double)', places)} as max from v"
        for name, c in (columns or {c: c for c in NUMERIC}).items()
    ]
    return on_view(" union all ".join(rows))


CATEGORIES = "named as (" + " union all ".join(
    f"select {text(f)} as feature, {value_case(f)} as category, risk from v" for f in cat.VALUE_NAMES
) + "), kept as (select * from named where category is not null and risk is not null)"

STUDIED = (cat.AMOUNT, cat.DURATION, cat.AGE)
LONG = "long as (" + " union all ".join(
    f"select {text(c)} as feature, risk, {KEY}, cast({c} as double) as value from v where {c} is not null"
    for c in STUDIED
) + ")"


def correlated() -> dict[str, str]:
    names = cat.display_names()
    columns = [c for c in (*cat.NUMBERS, cat.RATIO, *cat.FLAGS, *map(cat.repeat_name, cat.REPEATED))
               if c != cat.LABEL]
    return {c: names.get(c, c) for c in columns if names.get(c, c) not in cat.NOT_CORRELATED}


def corr_rows(labels: dict[str, str]) -> str:
    return "corrs as (" + " union all ".join(
        f"select {text(label)} as feature, {text(c)} as column_name,"
        f" corr(cast({quoted(c)} as double), cast(\"Target\" as double)) as r from v"
        for c, label in labels.items()
    ) + ")"


TOP = (
    "top as (select feature, column_name, r from corrs"
    f" order by round(abs(r), 9) desc nulls last, feature limit {PARAMS.top_correlations})"
)


def group_case(name: str) -> str:
    arms = " ".join(
        f"when starts_with({name}, {text(p)}) then {text(g)}" for g, p in cat.GROUP_PREFIXES.items()
    )
    return f"case {arms} else 'Other' end"


def corr_matrix_sql() -> str:
    labels = correlated()
    lines = " union all ".join(
        f"select {KEY}, {text(label)} as feature, cast({quoted(c)} as double) as value from v"
        for c, label in labels.items()
    )
    return on_view(
        f"select a.feature as x, b.feature as y, {dec('corr(a.value, b.value)')} as r,"
        " cast(any_value(a.place) as int) as x_place, cast(any_value(b.place) as int) as y_place"
        f" from cells a join cells b on a.{KEY} = b.{KEY} group by a.feature, b.feature",
        corr_rows(labels), TOP,
        "placed as (select feature, row_number() over (order by feature) as place from top)",
        f"cells as (select l.*, p.place from ({lines}) l join placed p on l.feature = p.feature"
        " where l.value is not null)",
    )


BOXES = (
    "quarts as (select feature, risk, count(*) as n, quantile_cont(value, 0.25) as q1,"
    " quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3 from long"
    " where risk is not null group by feature, risk), "
    "fenced as (select long.*, n, q1, median, q3, value between q1 - 1.5 * (q3 - q1) and"
    " q3 + 1.5 * (q3 - q1) as inside from long join quarts using (feature, risk))"
)

KDE = on_view(
    f"select feature, risk, cast(point as int) as point, {dec('x')} as x,"
    " round(sum(n * exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / (size * h * sqrt(2 * pi())), 10) as density"
    " from points group by feature, risk, point, x, size, h",
    LONG,
    "stats as (select feature, risk, count(*) as size, min(value) as low, max(value) as high,"
    " stddev_samp(value) * pow(count(*), -0.2) as h from long where risk is not null group by feature, risk)",
    "counts as (select feature, risk, value, count(*) as n from long where risk is not null"
    " group by feature, risk, value)",
    "points as (select s.*, c.value, c.n, p.point,"
    " low - 3 * h + p.point * ((high - low + 6 * h) / 199.0) as x"
    " from stats s join counts c using (feature, risk), range(200) p(point))",
)


def horner(x: str, coefficients) -> str:
    sql = repr(coefficients[0])
    for c in coefficients[1:]:
        sql = f"({sql} * {x} + cast({c!r} as double))"
    return sql


def probit(p: str) -> str:
    centred = f"({p} - 0.5)"
    square = f"({centred} * {centred})"
    centre = f"{centred} * {horner(square, normal.CENTRE_NUM)} / {horner(square, normal.CENTRE_DEN)}"
    depth = f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    tail = f"{horner(depth, normal.TAIL_NUM)} / {horner(depth, normal.TAIL_DEN)}"
    return (
        f"case when {p} < {normal.TAIL_BELOW} then {tail}"
        f" when {p} > 1 - {normal.TAIL_BELOW} then -({tail}) else {centre} end"
    )


QQ = (
    "placed as (select feature, value, row_number() over (partition by feature order by value) as place,"
    " count(*) over (partition by feature) as size from long), "
    "chances as (select *, case when place = 1 then 1 - pow(0.5, 1.0 / size) when place = size"
    " then pow(0.5, 1.0 / size) else (cast(place as double) - 0.3175) / (size + 0.365) end as p from placed), "
    f"qq as (select feature, place, {probit('p')} as theoretical, value as ordered from chances)"
)


# codes of the sample that the books lack, and columns of it with missing codes
OUTSIDE = {"Status_of_existing_checking_account": "A99", "Savings_account_bonds": "A66"}
MISSING = ("Status_of_existing_checking_account", "Purpose", "Personal_status_and_sex")


def one_hot_sql() -> str:
    texts = {cat.AGE_GROUP: ["25_to_40", "Over_40", "Under_25"]}
    for a in cat.ATTRIBUTES:
        other = {OUTSIDE[a.raw]} if a.raw in OUTSIDE else set()
        texts[a.raw] = sorted({c for c, _, _, _ in a.codes} | other)
        unknown = {"unknown"} if other or a.raw in MISSING else set()
        texts[a.decoded] = sorted({"unknown" if t is None else t for _, t, _, _ in a.codes} | unknown)
    dummies = [
        f"cast(coalesce({c} = {text(v)}, false) as int) as {quoted(f'{c}_{v}')}"
        for c, values in texts.items() for v in values[1:]
    ]
    return on_view(f"select {KEY}, {', '.join(dummies)} from v")


def smote_sql(few: str, columns: dict[str, str]) -> str:
    """SMOTE by comparing all pairs: ``few`` gives the CTEs up to few(id, ...), the minority's
    rows, and ``columns`` names each result with the column of few that it is made from."""
    k = PARAMS.smote_neighbours
    square = " + ".join(f"(p.{c} - q.{c}) * (p.{c} - q.{c})" for c in columns.values())
    values = ", ".join(f"{dec(f'b.{c} + b.gap * (o.{c} - b.{c})')} as {name}" for name, c in columns.items())
    return on_view(
        f"select 0 as \"Target\", b.id, cast(b.copy as int) as copy, {values}"
        " from bases b join near n on b.id = n.id and b.pick = n.place join few o on o.id = n.other",
        SPLIT,
        few,
        "sizes as (select count(*) filter (where \"Target\" = 0) as small,"
        " count(*) filter (where \"Target\" = 1) as big from split where part = 'train')",
        f"listed as (select p.id, min({{'dist': {square}, 'other': q.id}}, {k}) as l from few p join few q on p.id <> q.id group by p.id),"
        " near as (select id, unnest(l).other as other, unnest(range(1, len(l) + 1)) as place from listed)",
        f"ranked as (select *, row_number() over (order by md5(concat('{PARAMS.seed}:base:', id))) as rn from few)",
        "quota as (select r.*, (big - small) // small + cast(rn <= (big - small) % small as int) as copies"
        " from ranked r, sizes)",
        f"bases as (select *, cast(floor({uniform('neighbour', 'id', 'copy')} * {k}) as int) + 1 as pick,"
        f" {uniform('gap', 'id', 'copy')} as gap from"
        f" (select id, {', '.join(columns.values())}, unnest(range(1, copies + 1)) as copy from quota))",
    )


def smote_amounts_sql() -> str:
    few = (
        f"few as (select {KEY} as id, cast({cat.AMOUNT} as double) as a, cast({cat.DURATION} as double) as d"
        " from split where part = 'train' and \"Target\" = 0)"
    )
    return smote_sql(few, {"amount": "a", "duration": "d"})


def smote_inputs_sql() -> str:
    filled = filled_inputs()
    names = {c: f"x{i}" for i, c in enumerate(filled)}
    values = ", ".join(f"{sql} as {names[c]}" for c, sql in filled.items())
    whole = ", ".join(
        f"({x} - min({x}) over ()) / coalesce(nullif(max({x}) over () - min({x}) over (), 0), 1) as {x}"
        for x in names.values()
    )
    few = (
        f"inputs as (select {KEY} as id, \"Target\", part, {values} from split), "
        f"scaled as (select id, \"Target\", {whole} from inputs where part = 'train'), "
        "few as (select * from scaled where \"Target\" = 0)"
    )
    return smote_sql(few, names)


RESAMPLED = on_view(
    "select method, \"Target\", case method when 'Original' then n when 'ClusterCentroids' then low else high end as n"
    " from counts, (select min(n) as low, max(n) as high from counts) ends,"
    " (values ('Original'), ('ClusterCentroids'), ('SMOTE'), ('KMeans-SMOTE')) methods(method)",
    SPLIT,
    "counts as (select \"Target\", count(*) as n from split where part = 'train' group by \"Target\")",
)



def newton_sql(steps: int = 30) -> str:
    """Newton steps of a logistic loss with two inputs; each solves three equations by Cramer's rule."""
    costs = ", ".join(f"({float(c)!r})" for c in cat.GRID_LOGREG["C"])
    scaled = ", ".join(
        f"({c} - min({c}) over ()) / cast(max({c}) over () - min({c}) over () as double) as {n}"
        for c, n in ((cat.AMOUNT, "a"), (cat.DURATION, "d"))
    )
    curved = {f"{s}{t}": f"sum(p * (1 - p) * {s} * {t})" for s, t in ("aa", "ad", "dd")} | {
        "a1": "sum(p * (1 - p) * a)", "d1": "sum(p * (1 - p) * d)", "n1": "sum(p * (1 - p))",
        "ga": "sum((p - y) * a)", "gd": "sum((p - y) * d)", "g1": "sum(p - y)",
    }
    sums = ", ".join(f"cost * {sql} as {n}" for n, sql in curved.items())

    def det(*m: str) -> str:
        a, b, c, d, e, f, g, h, i = m
        return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    rows = [["(aa + 1)", "ad", "a1"], ["ad", "(dd + 1)", "d1"], ["a1", "d1", "n1"]]
    right = ["(ga + wa)", "(gd + wd)", "g1"]
    whole = det(*[v for row in rows for v in row])
    step = [
        det(*[right[r] if c == at else v for r, row in enumerate(rows) for c, v in enumerate(row)]) + f" / {whole}"
        for at in range(3)
    ]
    return f"with recursive {APPS}, {VIEW}, {SPLIT}, " + ", ".join([
        f"points as (select {scaled}, cast(\"Target\" as double) as y from split where part = 'train')",
        f"costs(cost) as (select cast(c as double) from (values {costs}) t(c))",
        "newton as (select 0 as step, cost, cast(0 as double) as wa, cast(0 as double) as wd, cast(0 as double) as w1 from costs"
        f" union all select step + 1, cost, wa - {step[0]}, wd - {step[1]}, w1 - {step[2]} from"
        f" (select step, cost, wa, wd, w1, {sums} from (select *, 1 / (1 + exp(-(wa * a + wd * d + w1))) as p from newton, points"
        f" where step < {steps}) group by step, cost, wa, wd, w1))",
    ]) + (
        f" select cost, {dec('wa')} as amount, {dec('wd')} as duration, {dec('w1')} as intercept from newton where step = {steps}"
    )


# --- scores ---------------------------------------------------------------------------

SCORED = (
    f"scored as (select *, cast(score >= 0.5 as int) as prediction from (select {KEY}, label,"
    f" cast(({KEY} * 7919) % 97 + 40 * label as double) / cast(137 as double) as score"
    f" from (select {KEY}, cast({cat.LABEL} = 1 as int) as label from apps)))"
)
CURVE = (
    "tallies as (select score, sum(label) as hits, sum(1 - label) as misses from scored group by score), "
    "curve as (select score, cast(sum(hits) over w as double) as tp, cast(sum(misses) over w as double) as fp,"
    " (select sum(label) from scored) as positives from tallies window w as (order by score desc)), "
    "points as (select score, tp / (tp + fp) as precision, tp / positives as recall from curve"
    " union all select null, 1.0, 0.0)"
)


def on_scores(body: str, *ctes: str) -> str:
    return f"with {', '.join([APPS, SCORED, *ctes])} {body}"


def sql_texts() -> dict[str, str]:
    columns = view_columns()
    names = cat.display_names()
    view = on_apps(select_from_apps(columns))
    renamed = on_apps(select_from_apps({names.get(c, c): sql for c, sql in columns.items()}))
    raw = on_apps(f"select {KEY}, {', '.join(cat.RAW_ORDER)} from apps")
    decoded = {a.decoded for a in cat.ATTRIBUTES} | {cat.AGE_GROUP}
    numbers = {
        c: sql for c, sql in columns.items()
        if c not in decoded and c not in {a.raw for a in cat.ATTRIBUTES}
    }
    mapped = ", ".join(f"{value_case(c)} as {c}" for c in cat.VALUE_NAMES)
    filled = ", ".join(
        f"coalesce({value_case(c) if c in cat.VALUE_NAMES else c}, 'Unknown') as {c}" for c in cat.FILLED
    )
    found = {
        "scan_raw": raw, "scan_csv": raw, "project_raw": raw,
        "scan_table": view, "sink_csv": view, "view_ddl": view, "features_view": view,
        "scan_colmap_json": renamed, "scan_colmap_table": renamed, "sink_table": renamed,
        "rename_map": renamed,
        "preview": raw + f" order by {KEY} limit 5",
        "profile_shape": on_apps(f"select count(*) as n_rows, {len(columns)} as n_columns from apps"),
        "project_dup": on_apps(select_from_apps(
            {c: c for c in cat.REPEATED} | {cat.repeat_name(c): c for c in cat.REPEATED})),
        "ratio_safe": on_apps(select_from_apps({cat.RATIO: RATIO_SQL})),
        "bucket_age": on_apps(select_from_apps({cat.AGE_GROUP: AGE_SQL})),
        "flag_age": on_apps(select_from_apps(AGE_FLAG_SQL)),
    }
    for a in cat.ATTRIBUTES:
        found[f"decode_{a.name}"] = on_apps(select_from_apps({a.decoded: decode_sql(a)}))
        found[f"flag_{a.name}"] = on_apps(
            select_from_apps({flag: FLAG_SQL[flag] for _, _, flag, _ in a.codes}))
    found |= {
        "map_values": on_view(f"select {KEY}, {mapped} from v"),
        "target_encode": on_apps(select_from_apps({"Target": TARGET})),
        "fill_unknown": on_view(f"select {KEY}, {filled} from v"),
        "sex_from_status": on_view(
            f"select {KEY}, case when lower(status_sex_desc) like 'm%' then 1 else 0 end as \"Sex\" from v"),
        "drop_if_exists": on_apps(select_from_apps(
            {c: sql for c, sql in columns.items() if not c.endswith(":1")})),
        "select_numeric": on_apps(select_from_apps(numbers)),
        "one_hot_drop_first": one_hot_sql(),
        "describe_numeric": describe_sql(6),
        "describe_inputs": describe_sql(
            6, {c: c for c in NUMERIC if c != cat.LABEL} | {cat.repeat_name(c): c for c in cat.REPEATED if c in NUMERIC}),
        "round2": describe_sql(2).replace(" + 0.0", ""),
        "class_balance": on_apps(
            f"select {cat.LABEL}, count(*) as n, {dec('100.0 * count(*) / sum(count(*)) over ()')} as percent"
            f" from apps group by {cat.LABEL}"),
        "class_counts_split": on_view(
            "select part, \"Target\", count(*) as n,"
            f" {dec('100.0 * count(*) / sum(count(*)) over (partition by part)')} as percent"
            " from split group by part, \"Target\"", SPLIT),
        "class_counts_resampled": RESAMPLED,
        "category_risk_counts": on_view(
            "select feature, category, risk, count(*) as n from kept group by all", CATEGORIES),
        "crosstab_pct": on_view(
            "select feature, category,"
            f" {dec('100.0 * count(*) filter (where risk = $$Good$$) / count(*)')} as \"Good\","
            f" {dec('100.0 * count(*) filter (where risk = $$Bad$$) / count(*)')} as \"Bad\""
            " from kept group by feature, category", CATEGORIES),
        "sort_categories": on_view(
            "select distinct feature, category from kept order by feature, category", CATEGORIES),
        "corr_to_target": on_view(
            f"select feature, {dec('r')} as r, {dec('abs(r)')} as strength from top",
            corr_rows(correlated()), TOP),
        "topk_abs_corr": on_view(
            f"select feature, {dec('r')} as r, {dec('abs(r)')} as strength, {group_case('feature')} as \"group\","
            " cast(row_number() over (order by feature) as int) as place from top",
            corr_rows(correlated()), TOP),
        "group_columns": on_view(
            f"select column_name as feature, {dec('r')} as r, {group_case('column_name')} as group_by_column,"
            f" {group_case('feature')} as group_by_label from corrs", corr_rows(correlated())),
        "corr_matrix": corr_matrix_sql(),
        "box_stats": on_view(
            f"select feature, risk, n, {dec('q1')} as q1, {dec('median')} as median, {dec('q3')} as q3,"
            " min(value) filter (where inside) as whisker_low, max(value) filter (where inside) as whisker_high,"
            " count(*) filter (where not inside) as outliers"
            " from fenced group by feature, risk, n, q1, median, q3", LONG, BOXES),
        "box_outliers": on_view(
            f"select feature, risk, {KEY}, value from fenced where not inside", LONG, BOXES),
        "kde_by_class": KDE,
        "qq_normal": on_view(
            f"select feature, place, {dec('theoretical')} as theoretical, ordered from qq", LONG, QQ),
        "qq_fit": on_view(
            f"select feature, {dec('regr_slope(ordered, theoretical)')} as slope,"
            f" {dec('regr_intercept(ordered, theoretical)')} as intercept,"
            f" {dec('corr(ordered, theoretical)')} as r, count(*) as n from qq group by feature", LONG, QQ),
        "no_skill_rate": on_view(
            f"select {dec('avg(\"Target\")')} as no_skill from split where part = 'test'", SPLIT),
        "stratified_split": on_view(f"select {KEY}, \"Target\", part from split", SPLIT),
        "stratified_folds": folds_sql(),
        "standardize": scaled_sql(f"avg({{c}}) {_TRAIN}", f"stddev_pop({{c}}) {_TRAIN}"),
        "minmax_scale": scaled_sql(
            f"min({{c}}) {_TRAIN}", f"(max({{c}}) {_TRAIN} - min({{c}}) {_TRAIN})"),
        "smote": smote_amounts_sql(),
        "smote_inputs": smote_inputs_sql(),
        "pca_spectrum": spectrum_sql(),
        "pca_full": components_sql(f"select component, {dec('ratio')} as ratio from spectrum"),
        "cum_variance": components_sql(
            f"select component, {dec('ratio')} as ratio, {dec('cumulative')} as cumulative from spectrum"),
        "n_components_95": components_sql(f"select {kept_sql()} as n_components"),
        "pca_2d": pca_2d_sql(),
        "pca_loadings": pca_loadings_sql(),
        "pca_moments": pca_moments_sql(),
        "logreg_weights": newton_sql(),
        "logreg_checked": on_view(
            "select $$LogisticRegression$$ as model, count(*) as n, count(*) as n_keys, cast(sum(\"Target\") as bigint) as n_good,"
            " count(*) as n_probabilities, count(*) as n_classes from split where part = 'test'", SPLIT),
        "confusion_matrix": on_scores(
            "select actual, predicted, count(label) as n from (values (0, 0), (0, 1), (1, 0), (1, 1))"
            " grid(actual, predicted) left join scored on label = actual and prediction = predicted"
            " group by actual, predicted"),
        "metrics_prf": on_scores(
            f"select {dec('tp / (tp + fp)')} as precision, {dec('tp / (tp + fn)')} as recall,"
            f" {dec('2 * tp / (2 * tp + fp + fn)')} as f1 from (select"
            " cast(count(*) filter (where label = 1 and prediction = 1) as double) as tp,"
            " cast(count(*) filter (where label = 0 and prediction = 1) as double) as fp,"
            " cast(count(*) filter (where label = 1 and prediction = 0) as double) as fn from scored)"),
        "pr_curve": on_scores(
            f"select {dec('score')} as threshold, {dec('precision')} as precision, {dec('recall')} as recall"
            " from points", CURVE),
        "pr_auc": on_scores(
            f"select {dec('sum((recall - r0) * (precision + p0) / 2)')} as pr_auc from (select *,"
            " lag(recall) over (order by recall, precision desc) as r0,"
            " lag(precision) over (order by recall, precision desc) as p0 from points)", CURVE),
    }
    return found
