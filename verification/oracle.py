"""SQL equivalents of the registered queries, for DuckDB on the same parquet tables."""

from __future__ import annotations

SIZES = """sizes("interval", secs) as (values ('5m', 300), ('1h', 3600), ('4h', 14400), ('1d', 86400))"""

TICKS = """ticks as (
  select case when event_type = 'signup' then 'SPOT_' else 'PERP_' end || upper(event_type) || '_USDC' as symbol,
         ts, event_id as seq, value as price, cast(json_extract_string(props, '$.k') as double) as amount
  from events)"""

BARS = f"""{SIZES}, {TICKS}, bars as materialized (
  select symbol, "interval", make_timestamp((epoch_us(ts) // (secs::bigint * 1000000)) * secs::bigint * 1000000) as start_timestamp,
         arg_min(price, (ts, seq)) as open, max(price) as high, min(price) as low, arg_max(price, (ts, seq)) as close,
         sum(amount) as volume
  from ticks, sizes group by 1, 2, 3)"""

# Bars with their position and the series window under the name w.
NUMBERED = f"""{BARS}, b as materialized (
  select *, row_number() over (partition by symbol, "interval" order by start_timestamp) - 1 as i from bars)"""

W = 'window w as (partition by symbol, "interval" order by i)'


def frame(expr: str, bars: int) -> str:
    return f'{expr} over (partition by symbol, "interval" order by i rows between {bars - 1} preceding and current row)'


def rolling(function: str, column: str, bars: int) -> str:
    return f"case when {frame(f'count({column})', bars)} = {bars} then {frame(f'{function}({column})', bars)} end"


def filled(column: str) -> str:
    return (
        f"first_value({column} ignore nulls) over (partition by symbol, \"interval\" order by i "
        "rows between current row and unbounded following)"
    )


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 as {name}"


KEYS = 'symbol, "interval", start_timestamp'

CHANGES = f"""d as (
  select *, lag(close) over w as prev_close, lag(high) over w as prev_high, lag(low) over w as prev_low,
         lead(close) over w as next_close from b {W}),
m as (
  select *, greatest(high - low, abs(high - prev_close), abs(low - prev_close)) as tr,
         case when close > prev_close then close - prev_close else 0.0 end as gain,
         case when close < prev_close then prev_close - close else 0.0 end as loss,
         case when high > prev_high then high - prev_high else 0.0 end as plus_dm,
         case when low < prev_low then prev_low - low else 0.0 end as minus_dm from d)"""


def rsi_expr(gain: str, loss: str) -> str:
    return f"case when {loss} > 0 then 100 - 100 / (1 + {gain} / {loss}) when {gain} > 0 then 100.0 end"


RSI = f"""g as (select *, {rolling('avg', 'gain', 14)} as mean_gain, {rolling('avg', 'loss', 14)} as mean_loss from m),
rsi as (select *, {rsi_expr('mean_gain', 'mean_loss')} as rsi_14 from g)"""

ADX = f"""di0 as (
  select *, {rolling('avg', 'tr', 14)} as mean_tr, {rolling('avg', 'plus_dm', 14)} as mean_plus,
         {rolling('avg', 'minus_dm', 14)} as mean_minus from m),
di as (select *, 100 * mean_plus / nullif(mean_tr, 0) as plus_di, 100 * mean_minus / nullif(mean_tr, 0) as minus_di from di0),
dx as (select *, 100 * abs(plus_di - minus_di) / nullif(plus_di + minus_di, 0) as dx from di),
adx as (select *, {rolling('avg', 'dx', 14)} as adx from dx)"""

SPANS = (10, 12, 14, 20, 26, 50, 200)


def _ema(span: int) -> str:
    return f"e{span} + 2.0 / {span + 1} * (n.close - e{span})"


# Every exponential average in one recursion over the positions of all series.
EMAS = f"""emas as (
  select symbol, "interval", i, {', '.join(f'close as e{s}' for s in SPANS)}, 0.0::double as macd, 0.0::double as macd_signal
  from b where i = 0
  union all
  select r.symbol, r."interval", n.i, {', '.join(f'{_ema(s)}' for s in SPANS)},
         ({_ema(12)}) - ({_ema(26)}), macd_signal + 0.2 * ((({_ema(12)}) - ({_ema(26)})) - macd_signal)
  from emas r join b n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1)"""

SAR = """sars as (
  select symbol, "interval", i, high as ep, low as stop, true as up, 0.02::double as af, null::double as sar from b where i = 0
  union all
  select symbol, "interval", i,
         case when flip then extreme else ep end, case when flip then ep else moved end, up <> flip,
         case when flip then 0.02::double else af end + case when (case when flip then 0.02::double else af end) < 0.2 then 0.02::double else 0 end,
         case when flip then ep else moved end
  from (
    select *, case when up then low else high end as extreme,
           case when up then low < moved else high > moved end as flip
    from (select n.symbol, n."interval", n.i, n.high, n.low, r.ep, r.up, r.af, r.stop + r.af * (r.ep - r.stop) as moved
          from sars r join b n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1)))"""

RETURNS = f"""ret as (select *, case when close <> 0 then next_close / close - 1 end as "return" from d),
thr as (
  select symbol, "interval", quantile_cont("return", 0.15) as lower_threshold, quantile_cont("return", 0.85) as upper_threshold
  from ret group by 1, 2),
lab as materialized (
  select ret.*, case when "return" > upper_threshold then 1 when "return" < lower_threshold then -1 else 0 end as target
  from ret join thr using (symbol, "interval"))"""

HASH = "('0x' || substr(md5({}), 1, 8))::bigint"

# Scores of the three classes from an md5 of the bar's key, and the class of the highest one.
SCORED = f"""{NUMBERED}, {CHANGES}, {RETURNS}, raw as (
  select symbol, "interval", start_timestamp, i, target,
         {', '.join(HASH.format(f"symbol || '|' || " + '"interval"' + f" || '|' || i::varchar || '|{t}'") + f' % 1000 + 1 as s{t}' for t in 'abc')}
  from lab where "return" is not null),
scored as materialized (
  select symbol, "interval", start_timestamp, i, target, sa::double / (sa + sb + sc) as p_neg, sb::double / (sa + sb + sc) as p_zero,
         sc::double / (sa + sb + sc) as p_pos,
         case when sa >= sb and sa >= sc then -1 when sb >= sc then 0 else 1 end as prediction from raw)"""

AUC = """long as (
  select symbol, "interval", -1 as class, p_neg as score, target = -1 as positive from {src}
  union all select symbol, "interval", 0, p_zero, target = 0 from {src}
  union all select symbol, "interval", 1, p_pos, target = 1 from {src}),
ranked as (
  select *, rank() over (partition by symbol, "interval", class order by score)
            + (count(*) over (partition by symbol, "interval", class, score) - 1) / 2.0 as r from long),
area as (
  select symbol, "interval", class, count(*) filter (positive) as p, count(*) filter (not positive) as n,
         sum(r) filter (positive) as rs from ranked group by 1, 2, 3),
auc as (select *, case when p > 0 and n > 0 then (rs - p * (p + 1) / 2.0) / (p * n) end as auc from area),
auc_per_series as (
  select symbol, "interval",
         case when count(*) filter (p > 0) > 2 then avg(auc)
              when count(*) filter (p > 0) = 2 then arg_max(auc, class) filter (p > 0) end as roc_auc
  from auc group by 1, 2)"""

# Fixed values of the strategy catalogue, written out.
STRATEGIES = """catalogue("interval", strategy, extra) as (
  select s."interval", v.strategy, replace(replace(v.extra, '{fast}', s.fast), '{slow}', s.slow)
  from (values ('5m', 'ema_12', 'ema_26'), ('1h', 'ema_20', 'ema_50'), ('4h', 'ema_50', 'ema_200'), ('1d', 'ema_50', 'ema_200')) s("interval", fast, slow),
       (values ('Trend-Following', '{fast},{slow},macd,macd_signal,adx,vwap'),
               ('Volatility Breakout', 'atr_14,bollinger_hband,bollinger_lband,std_20,vwap'),
               ('Momentum Reversal', 'rsi_14,stoch_k_14,stoch_d_14,roc_10,momentum_10,vwap'),
               ('Momentum + Volatility', 'rsi_14,atr_14,bollinger_hband,bollinger_lband,roc_10,momentum_10,vwap'),
               ('Hybrid', '{fast},{slow},atr_14,bollinger_hband,rsi_14,macd,vwap'),
               ('Advanced', 'tenkan_sen_9,kijun_sen_26,senkou_span_a,senkou_span_b,sar,vwap'),
               ('Router', 'ema_12,ema_26,macd,macd_signal,adx,atr_14,bollinger_hband,bollinger_lband,std_20,rsi_14,stoch_k_14,stoch_d_14,roc_10,momentum_10,tenkan_sen_9,kijun_sen_26,senkou_span_a,senkou_span_b,sar,vwap')) v(strategy, extra)),
strategies as (
  select "interval", strategy, 'close,high,low,volume,' || extra as features, strategy <> 'Router' as force_features from catalogue)"""

# Columns of every feature, each in its own CTE chain over b.
ALL_FEATURES = f"""{CHANGES}, {RSI},
fx0 as (
  select r.*, e.e12 as ema_12, e.e20 as ema_20, e.e26 as ema_26, e.e50 as ema_50, e.e200 as ema_200, e.macd, e.macd_signal, s.sar
  from rsi r join emas e using (symbol, "interval", i) join sars s using (symbol, "interval", i)),
fx1 as (
  select *, {rolling('avg', 'tr', 14)} as atr_14, {rolling('avg', 'plus_dm', 14)} as mean_plus, {rolling('avg', 'minus_dm', 14)} as mean_minus,
         {rolling('avg', 'close', 20)} as bollinger_mavg, {rolling('stddev_samp', 'close', 20)} as bollinger_std,
         {rolling('stddev_samp', 'close', 20)} as std_20,
         100 * (close - {rolling('min', 'low', 14)}) / nullif({rolling('max', 'high', 14)} - {rolling('min', 'low', 14)}, 0) as stoch_k_14,
         100 * (close / nullif(lag(close, 10) over w, 0) - 1) as roc_10, close - lag(close, 10) over w as momentum_10,
         ({rolling('max', 'high', 9)} + {rolling('min', 'low', 9)}) / 2 as tenkan_sen_9,
         ({rolling('max', 'high', 26)} + {rolling('min', 'low', 26)}) / 2 as kijun_sen_26,
         ({rolling('max', 'high', 52)} + {rolling('min', 'low', 52)}) / 2 as span_b_now,
         sum(volume * (high + low + close) / 3) over w / nullif(sum(volume) over w, 0) as vwap
  from fx0 {W}),
fx2 as (
  select *, 100 * mean_plus / nullif(atr_14, 0) as plus_di, 100 * mean_minus / nullif(atr_14, 0) as minus_di,
         {rolling('avg', 'stoch_k_14', 3)} as stoch_d_14, bollinger_mavg + 2 * bollinger_std as bollinger_hband,
         bollinger_mavg - 2 * bollinger_std as bollinger_lband,
         lag((tenkan_sen_9 + kijun_sen_26) / 2, 26) over w as senkou_span_a, lag(span_b_now, 26) over w as senkou_span_b
  from fx1 {W}),
fx3 as (select *, 100 * abs(plus_di - minus_di) / nullif(plus_di + minus_di, 0) as dx from fx2),
fx as materialized (select *, {rolling('avg', 'dx', 14)} as adx from fx3)"""

SIDE = {
    "adx": ["plus_dm", "minus_dm", "tr", "plus_di", "minus_di", "dx", "adx"],
    "atr_14": ["tr", "atr_14"],
    "macd": ["ema_12", "ema_26", "macd", "macd_signal"],
    "bollinger_hband": ["bollinger_mavg", "bollinger_std", "bollinger_hband", "bollinger_lband"],
    "stoch_k_14": ["stoch_k_14", "stoch_d_14"],
    "senkou_span_a": ["tenkan_sen_9", "kijun_sen_26", "senkou_span_a"],
}


def swept(matrix: str, k: str, size: int) -> str:
    """The matrix with its k-th variable swept: least squares of the others on it, as one step of elimination."""
    m = matrix
    return (
        f"[[case when i = {k} and j = {k} then 1 / {m}[{k}][{k}] when i = {k} then {m}[{k}][j] / {m}[{k}][{k}] "
        f"when j = {k} then -{m}[i][{k}] / {m}[{k}][{k}] else {m}[i][j] - {m}[i][{k}] * {m}[{k}][j] / {m}[{k}][{k}] end "
        f"for j in range(1, {size + 1})] for i in range(1, {size + 1})]"
    )


def products(names: list[str]) -> str:
    """Sums of the products of all pairs of columns, as a matrix."""
    return "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in names) + "]" for a in names) + "]"


_LEVELS = [f"x{i}" for i in range(18)]
_CHANGES = [f"c{i}" for i in range(19)]
# Rows with prices and changes up to 19 bars back, and per series the products that regressions on them need.
PRODUCTS = f"""{NUMBERED}, scaled as (
  select *, case when avg(close) over (partition by symbol, "interval") < 1 then close * 1e8 else close end as sc from b),
centered as (select symbol, "interval", i, sc - avg(sc) over (partition by symbol, "interval") as x0 from scaled),
back as (
  select *, {', '.join(f'lag(x0, {i}) over w as x{i}' for i in range(1, 20))} from centered
  window w as (partition by symbol, "interval" order by i)),
lags as (select *, 1.0::double as one, {', '.join(f'x{i} - x{i + 1} as c{i}' for i in range(19))} from back where i >= 19),
products as materialized (
  select symbol, "interval", count(*) as n, {products(['one', 'x1', *_CHANGES])} as tests, {products(['one', *_LEVELS])} as levels,
         {products(['one', *_CHANGES[:18]])} as changes
  from lags group by 1, 2)"""


def unit_root_sql() -> str:
    """Regressions of the change on the price before and 0 to 18 earlier changes; the best criterion decides."""
    return f"""swept(symbol, "interval", n, step, m) as (
      select symbol, "interval", n, 0, tests from products
      union all
      select symbol, "interval", n, step + 1, {swept('m', '(case when step < 2 then step + 1 else step + 2 end)', 21)} from swept where step < 20),
    tried as (
      select symbol, "interval", n * ln(m[3][3] / n) + 2 * step as aic, m[2][3] / sqrt(m[2][2] * m[3][3] / (n - step)) as tau
      from swept where step >= 2 and n > step),
    adf as materialized (
      select symbol, "interval", arg_min(tau, aic) as tau, case when arg_min(tau, aic) <= -2.86 then 0 else 1 end as d from tried group by 1, 2)"""


def orders_sql() -> str:
    """A long autoregression for the shocks, then every order on lags and lagged shocks."""
    dot = "list_sum([{a}[k] * {b}[k] for k in range(1, 20)])"
    return f"""chosen as (
      select symbol, "interval", n, d, case when d = 0 then levels else changes end as g from products join adf using (symbol, "interval")),
    long(symbol, "interval", n, d, g, step, m) as (
      select symbol, "interval", n, d, g, d, g from chosen
      union all
      select symbol, "interval", n, d, g, step + 1, {swept('m', '(case when step = 0 then 1 else step + 2 end)', 19)} from long where step < 13),
    forms as (
      select symbol, "interval", n, d, g, list_concat(
        [[case when k = 2 then 1.0 else 0.0 end for k in range(1, 20)], [case when k = 1 then 1.0 else 0.0 end for k in range(1, 20)]],
        list_concat(
          [[case when k = l + 2 then 1.0 else 0.0 end for k in range(1, 20)] for l in range(1, 6)],
          [[case when k = l + 2 then 1.0 when k = 1 and d = 0 then -m[1][2] when k > l + 2 and k <= l + 14 then -m[k - l][2] else 0.0 end
            for k in range(1, 20)] for l in range(1, 6)])) as f
      from long where step = 13),
    halves as (select *, [[{dot.format(a='f[a]', b='g[b]')} for b in range(1, 20)] for a in range(1, 13)] as h from forms),
    seconds as materialized (
      select symbol, "interval", n, d, [[{dot.format(a='h[a]', b='f[b]')} for b in range(1, 13)] for a in range(1, 13)] as s from halves),
    orders(symbol, "interval", n, d, p, q, step, m) as (
      select symbol, "interval", n, d, p, q, 0, s from seconds, range(6) t(p), range(6) u(q)
      union all
      select symbol, "interval", n, d, p, q, step + 1,
             {swept('m', '(case when step < 1 - d then 2 when step < 1 - d + p then step + 2 + d else step + 2 + d + 5 - p end)', 12)}
      from orders where step < 1 - d + p + q),
    criteria as (
      select *, n * (ln(2 * pi() * m[1][1] / n) + 1) + 2 * (step + 1) as aic from orders
      where step = 1 - d + p + q and n >= greatest(2 * (p + q) + 5, 24)),
    best as (
      select s.symbol, s."interval", arg_min(p, (aic, p, q)) as p, any_value(c.d) as d, arg_min(q, (aic, p, q)) as q, min(aic) as aic
      from products s left join criteria c using (symbol, "interval") group by 1, 2)"""


def linear_sql() -> str:
    """Least squares on four scaled features; the fifth, a band, is a combination of two of them and changes no prediction."""
    names = ("sma_10", "ema_10", "rsi", "bollinger_high")
    scaled = ", ".join(
        f"case when max({n}) over s > min({n}) over s then ({n} - min({n}) over s) / (max({n}) over s - min({n}) over s) when {n} is not null then 0.0 end as {n}_scaled"
        for n in names
    )
    used = ["one", *(f"{n}_scaled" for n in names), "close"]
    return f"""lscaled as materialized (select {KEYS}, close, 1.0::double as one, {scaled} from lf window s as (partition by symbol, "interval")),
    lsums as materialized (
      select symbol, "interval", {products(used)} as g from lscaled where {' and '.join(f'{n}_scaled is not null' for n in names)} group by 1, 2),
    lswept(symbol, "interval", step, m) as (
      select symbol, "interval", 0, g from lsums
      union all
      select symbol, "interval", step + 1, {swept('m', '(step + 1)', 6)} from lswept where step < 5),
    lsolved as (select symbol, "interval", [m[i][6] for i in range(1, 6)] as b from lswept where step = 5)"""


def feature_sql(features: list[str], intervals: list[str]) -> str:
    columns: list[str] = []
    for feature in features:
        columns += [c for c in SIDE.get(feature, [feature]) if c not in columns]
    wanted = ", ".join(f"'{i}'" for i in intervals)
    # One nested window per column; the filter on bar size is outside, series are independent.
    shown = ", ".join(r6(filled(c), c) for c in columns)
    return (
        f"with recursive {NUMBERED}, {EMAS}, {SAR}, {ALL_FEATURES} "
        f'select {KEYS}, i as bar_index, {shown} from fx where "interval" in ({wanted})'
    )


def rows_sql(ctes: str, columns: str, source: str, tail: str = "", recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes} select {KEYS}, {columns} from {source} {tail}"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}

    # --- sources, sinks, catalogue
    q["bars_from_ticks"] = f"with {BARS} select {KEYS}, open, high, low, close, volume from bars"
    q["bars_in_range"] = (
        f"with {BARS} select {KEYS}, low, high, volume, close from bars "
        "where start_timestamp between timestamp '2024-01-08' and timestamp '2024-01-20'"
    )
    q["first_bars"] = (
        f"with {NUMBERED} select {KEYS}, low, high, volume, close from b "
        "where i < case \"interval\" when '1h' then 500 when '4h' then 200 when '1d' then 100 else 500 end"
    )
    q["latest_bars"] = (
        f"with {BARS} select {KEYS}, low, high, volume, close from bars "
        'qualify row_number() over (partition by symbol, "interval" order by start_timestamp desc) <= 200'
    )
    q["bars_ordered"] = f"with {BARS} select {KEYS}, close from bars order by 1, 2, 3"
    q["bars_from_payloads"] = f"""with {TICKS}, h as (
      select symbol, '1h' as "interval", date_trunc('hour', ts) as start_timestamp, price, amount, ts, seq from ticks)
      select symbol, "interval", start_timestamp, arg_min(price, (ts, seq)) as open, arg_min(price, (ts, seq)) as high,
             arg_min(price, (ts, seq)) as low, arg_min(price, (ts, seq)) as close, arg_min(amount, (ts, seq)) as volume
      from h group by 1, 2, 3"""
    q["listed_symbols"] = """with firsts as (
      select 'PERP_' || c_mktsegment || '_' || c_custkey::varchar as symbol, min(o_orderdate) as listed
      from customer left join orders on o_custkey = c_custkey group by c_mktsegment, c_custkey)
      select symbol from firsts where listed is not null and listed <= timestamp '1995-06-01' - interval 90 day"""
    stored = f"""{BARS}, stored as (select * from bars where start_timestamp < timestamp '2024-01-15')"""
    q["unseen_bars"] = f"with {BARS} select {KEYS}, open, high, low, close, volume from bars where start_timestamp >= timestamp '2024-01-15'"
    q["appended_bars"] = f"with {BARS} select {KEYS}, open, high, low, close, volume from bars"
    q["bars_without_null_time"] = f"with {BARS} select {KEYS}, close from bars where volume > 0"
    q["series_exist"] = f"""with {BARS}, {STRATEGIES}, asked as (
      select distinct upper(c_mktsegment) as symbol, "interval" from customer, sizes
      union select distinct symbol, "interval" from bars)
      select symbol, "interval", exists (select 1 from bars x where x.symbol = a.symbol and x."interval" = a."interval") as found from asked a"""
    q["series_like"] = f"with {BARS} select distinct symbol, \"interval\" from bars where symbol || '_' || \"interval\" like 'PERP_%_%'"
    q["series_coverage"] = f"""with {BARS} select symbol, "interval", strftime(min(start_timestamp), '%Y-%m-%d') as first_date,
      strftime(max(start_timestamp), '%Y-%m-%d') as last_date, count(*) as bars from bars group by 1, 2"""
    q["model_keys"] = f"""with {BARS}, {STRATEGIES} select distinct symbol, bars."interval", strategy,
      symbol || '_' || bars."interval" || '_' || replace(features, ',', '_') as model_key
      from bars join strategies s on s."interval" = bars."interval" """

    # --- strategies
    q["job_list"] = f"""with {BARS}, {STRATEGIES} select distinct symbol, bars."interval", strategy, features, force_features
      from bars join strategies s on s."interval" = bars."interval" """
    q["strategy_lookup"] = f"""with {BARS}, {STRATEGIES}, asked as (
      select distinct symbol, "interval", strategy from bars, (select distinct strategy from strategies union select 'Unknown') t)
      select symbol, a."interval", a.strategy, coalesce(features, '') as features, coalesce(force_features, false) as force_features
      from asked a left join strategies s on s."interval" = a."interval" and s.strategy = a.strategy"""
    q["merged_features"] = f"""with {BARS}, {STRATEGIES}, s2 as (select distinct symbol, "interval" from bars)
      select symbol, s2."interval", strategy, features, len(string_split(features, ',')) as feature_count
      from s2 join strategies s on s."interval" = s2."interval" """
    q["parsed_features"] = f"""with {BARS}, {STRATEGIES}, s2 as (select distinct symbol, "interval" from bars), p as (
      select symbol, s2."interval", strategy, unnest(string_split(features, ',')) as feature,
             unnest(range(len(string_split(features, ',')))) as position
      from s2 join strategies s on s."interval" = s2."interval")
      select symbol, "interval", strategy, position::int as position, feature,
             case when regexp_matches(feature, '_[0-9]+$') then regexp_extract(feature, '^(.*)_([0-9]+)$', 1) else feature end as indicator,
             case when regexp_matches(feature, '_[0-9]+$') then regexp_extract(feature, '^(.*)_([0-9]+)$', 2)::int else 0 end as "window" from p"""

    # --- scalar functions
    q["numbers_from_text"] = """select event_id, try_cast(json_extract_string(props, '$.k') as double) as k,
      try_cast(event_type as double) as word, try_cast(value::varchar as double) as value from events"""
    q["times_from_epoch"] = """select o_orderkey, epoch_ms(epoch_ms(o_orderdate)) as at, epoch_ms(o_orderdate) as millis from orders"""
    q["hour_and_weekday"] = "select event_id, hour(ts)::int as hour, (isodow(ts) - 1)::int as day_of_week from events"
    small = """small as (
      select l_returnflag || l_linestatus as symbol, '1d' as "interval", date_trunc('day', l_shipdate) as start_timestamp,
             arg_max(l_tax, (l_shipdate, l_orderkey * 10 + l_linenumber)) as close from lineitem group by 1, 2, 3)"""
    q["scaled_prices"] = f"""with {BARS}, {small}, u as (
      select symbol, "interval", start_timestamp, close from bars union all select * from small)
      select {KEYS}, {r6('case when avg(close) over (partition by symbol, "interval") < 1 then close * 1e8 else close end', 'scaled_close')} from u"""
    q["bar_index"] = f"with {NUMBERED} select {KEYS}, i as bar_index from b"

    # --- windows
    chain = f"{NUMBERED}, {CHANGES}"
    q["lag_lead_difference"] = rows_sql(chain, f"prev_close, next_close, {r6('close - prev_close', 'change')}", "d")
    q["sma"] = rows_sql(NUMBERED, f"{r6(rolling('avg', 'close', 10), 'sma_10')}, {r6(rolling('avg', 'close', 20), 'sma_20')}", "b")
    q["rolling_deviation"] = rows_sql(
        NUMBERED, f"{r6(rolling('stddev_samp', 'close', 20), 'std_20')}, {r6(rolling('stddev_samp', 'close', 10), 'volatility')}", "b"
    )
    q["rsi"] = rows_sql(f"{chain}, {RSI}", r6("rsi_14", "rsi_14"), "rsi")
    mid, dev = rolling("avg", "close", 20), rolling("stddev_samp", "close", 20)
    q["bollinger"] = rows_sql(
        NUMBERED, f"{r6(mid, 'bollinger_mavg')}, {r6(f'{mid} + 2 * {dev}', 'bollinger_hband')}, {r6(f'{mid} - 2 * {dev}', 'bollinger_lband')}", "b"
    )
    q["true_range"] = rows_sql(chain, r6("tr", "tr"), "m")
    q["atr"] = rows_sql(chain, r6(rolling("avg", "tr", 14), "atr_14"), "m")
    k = f"100 * (close - {rolling('min', 'low', 14)}) / nullif({rolling('max', 'high', 14)} - {rolling('min', 'low', 14)}, 0)"
    q["stochastic"] = rows_sql(
        f"{NUMBERED}, k as (select *, {k} as stoch_k from b)", f"{r6('stoch_k', 'stoch_k_14')}, {r6(rolling('avg', 'stoch_k', 3), 'stoch_d_14')}", "k"
    )
    q["momentum"] = rows_sql(NUMBERED, r6("close - lag(close, 10) over w", "momentum_10"), "b", W)
    q["rate_of_change"] = rows_sql(
        NUMBERED,
        f"{r6('100 * (close / nullif(lag(close, 10) over w, 0) - 1)', 'roc_10')}, {r6('close / nullif(lag(close) over w, 0) - 1', 'price_rate_of_change')}",
        "b",
        W,
    )
    q["adx"] = rows_sql(f"{chain}, {ADX}", f"{r6('plus_di', 'plus_di')}, {r6('minus_di', 'minus_di')}, {r6('dx', 'dx')}, {r6('adx', 'adx')}", "adx")
    mid9 = f"({rolling('max', 'high', 9)} + {rolling('min', 'low', 9)}) / 2"
    mid26 = f"({rolling('max', 'high', 26)} + {rolling('min', 'low', 26)}) / 2"
    mid52 = f"({rolling('max', 'high', 52)} + {rolling('min', 'low', 52)}) / 2"
    q["tenkan_kijun"] = rows_sql(NUMBERED, f"{r6(mid9, 'tenkan_sen_9')}, {r6(mid26, 'kijun_sen_26')}", "b")
    spans = f"{NUMBERED}, s as (select *, {mid9} as t, {mid26} as k, {mid52} as s52 from b)"
    q["senkou_spans"] = rows_sql(
        spans, f"{r6('lag((t + k) / 2, 26) over w', 'senkou_span_a')}, {r6('lag(s52, 26) over w', 'senkou_span_b')}", "s", W
    )
    q["vwap"] = rows_sql(NUMBERED, r6("sum(volume * (high + low + close) / 3) over w / nullif(sum(volume) over w, 0)", "vwap"), "b", W)
    q["backfill"] = rows_sql(
        f"{spans}, v as (select *, lag(s52, 26) over w as span_b, case when volume > 60 then volume end as busy from s {W})",
        f"{r6(filled('span_b'), 'senkou_span_b')}, {r6(filled('busy'), 'busy')}",
        "v",
    )
    q["ema"] = rows_sql(
        f"{NUMBERED}, {EMAS}", ", ".join(r6(f"e{s}", f"ema_{s}") for s in SPANS), 'b join emas using (symbol, "interval", i)', recursive=True
    )
    q["macd"] = rows_sql(
        f"{NUMBERED}, {EMAS}", f"{r6('macd', 'macd')}, {r6('macd_signal', 'macd_signal')}", 'b join emas using (symbol, "interval", i)', recursive=True
    )
    # Weighted means over the whole history: numerators by recursion, weights in closed form.
    weighted = f"""wm as (
      select symbol, "interval", i, close as n12, close as n26 from b where i = 0
      union all
      select r.symbol, r."interval", n.i, n.close + r.n12 * (11.0::double / 13), n.close + r.n26 * (25.0::double / 27)
      from wm r join b n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1),
    wmacd as materialized (
      select *, case when i >= 25 then n12 * (1 - 11.0::double / 13) / (1 - pow(11.0::double / 13, i + 1))
                                     - n26 * (1 - 25.0::double / 27) / (1 - pow(25.0::double / 27, i + 1)) end as macd from wm),
    ws as (
      select symbol, "interval", i, macd as n9 from wmacd where i = 25
      union all
      select r.symbol, r."interval", n.i, n.macd + r.n9 * 0.8::double
      from ws r join wmacd n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1),
    wsig as (
      select m.*, case when i >= 33 then s.n9 * 0.2 / (1 - pow(0.8::double, i - 24)) end as macd_signal
      from wmacd m left join ws s using (symbol, "interval", i))"""
    q["windowed_macd"] = rows_sql(
        f"{NUMBERED}, {weighted}", f"{r6('macd', 'macd')}, {r6('macd_signal', 'macd_signal')}", 'b join wsig using (symbol, "interval", i)', recursive=True
    )
    gappy = f"""{NUMBERED}, gb as materialized (
      select * replace (case when i % 19 <> 4 and i % 57 <> 5 then close end as close, case when i % 23 <> 5 then low end as low,
        case when i % 29 <> 7 then volume end as volume) from b)"""
    gk = k.replace("from b", "from gb")
    gchain = CHANGES.replace(" from b ", " from gb ")
    gtyp = "volume * (high + low + close) / 3"
    gvwap = f"case when {gtyp} is not null then sum({gtyp}) over w / nullif(sum(volume) over w, 0) end"
    q["gappy_windows"] = rows_sql(
        f"{gappy}, {gchain}, {RSI}, k as (select *, {gk} as stoch_k from rsi)",
        ", ".join(
            [
                r6(rolling("avg", "close", 10), "sma_10"), r6(dev, "std_20"), r6(f"{mid} + 2 * {dev}", "bollinger_hband"),
                r6("stoch_k", "stoch_k_14"), r6(rolling("avg", "stoch_k", 3), "stoch_d_14"), r6(mid9, "tenkan_sen_9"),
                r6(mid26, "kijun_sen_26"), r6(gvwap, "vwap"), r6(rolling("avg", "tr", 14), "atr_14"), r6("rsi_14", "rsi_14"),
            ]
        ),
        "k",
        W,
    )
    q["gappy_filled"] = rows_sql(
        f"{gappy}, v as (select *, {rolling('avg', 'close', 10)} as sma_10, {gvwap} as vwap from gb {W})",
        f"{r6(filled('sma_10'), 'sma_10')}, {r6(filled('vwap'), 'vwap')}",
        "v",
    )

    def gap_ema(span: int) -> str:
        left = f"pow({span - 1}.0::double / {span + 1}, s + 1)"
        return f"case when n.close is null then e{span} when e{span} is null then n.close else ({left} * e{span} + 2.0::double / {span + 1} * n.close) / ({left} + 2.0::double / {span + 1}) end"

    spans_used = (12, 26, 50)
    gemas = f"""ge as (
      select symbol, "interval", i, {', '.join(f'close as e{s}' for s in spans_used)}, 0 as s, case when close is not null then 0.0::double end as sig
      from gb where i = 0
      union all
      select symbol, "interval", i, {', '.join(f'e{s}' for s in spans_used)}, s, case when sig is null then e12 - e26 else sig + 0.2 * ((e12 - e26) - sig) end
      from (select n.symbol, n."interval", n.i, {', '.join(f'{gap_ema(s)} as e{s}' for s in spans_used)},
              case when n.close is null then s + 1 else 0 end as s, sig
            from ge r join gb n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1))"""
    q["gappy_averages"] = rows_sql(
        f"{gappy}, {gemas}",
        ", ".join([*(r6(f"e{s}", f"ema_{s}") for s in spans_used), r6("e12 - e26", "macd"), r6("sig", "macd_signal")]),
        'b join ge using (symbol, "interval", i)',
        recursive=True,
    )
    gmeans = f"""gm as (
      select symbol, "interval", i, coalesce(close, 0) as n12, coalesce(close, 0) as n26, (close is not null)::int::double as d12,
        (close is not null)::int::double as d26, (close is not null)::int as seen from gb where i = 0
      union all
      select n.symbol, n."interval", n.i, coalesce(n.close, 0) + n12 * (11.0::double / 13), coalesce(n.close, 0) + n26 * (25.0::double / 27),
        (n.close is not null)::int + d12 * (11.0::double / 13), (n.close is not null)::int + d26 * (25.0::double / 27), seen + (n.close is not null)::int
      from gm r join gb n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1),
    gmacd as materialized (select *, case when seen >= 26 then n12 / d12 - n26 / d26 end as macd from gm),
    gs as (
      select symbol, "interval", i, macd, 0.0::double as ns, 0.0::double as ds, 0 as seen from gmacd where i = 0
      union all
      select n.symbol, n."interval", n.i, n.macd, coalesce(n.macd, 0) + ns * 0.8::double, (n.macd is not null)::int + ds * 0.8::double, r.seen + (n.macd is not null)::int
      from gs r join gmacd n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1)"""
    q["gappy_windowed_macd"] = rows_sql(
        f"{gappy}, {gmeans}", f"{r6('macd', 'macd')}, {r6('case when seen >= 9 then ns / ds end', 'macd_signal')}", 'b join gs using (symbol, "interval", i)', recursive=True
    )
    q["parabolic_sar"] = rows_sql(f"{NUMBERED}, {SAR}", r6("sar", "sar"), 'b join sars using (symbol, "interval", i)', recursive=True)

    # --- feature sets
    for strategy, (features, intervals) in STRATEGY_QUERIES.items():
        q[strategy] = feature_sql(features, intervals)
    signal = f"""{NUMBERED}, {EMAS}, {weighted}, {CHANGES}, {RSI}, sg as (
      select r.*, wsig.macd, wsig.macd_signal, e14 as ema, {rolling('avg', 'close', 20)} as mid, {rolling('stddev_samp', 'close', 20)} as dev,
             {rolling('stddev_samp', 'close', 10)} as volatility, close / nullif(prev_close, 0) - 1 as price_rate_of_change
      from rsi r join emas using (symbol, "interval", i) join wsig using (symbol, "interval", i))"""
    q["signal_features"] = rows_sql(
        signal,
        ", ".join(
            r6(filled(f"({expr})"), name)
            for expr, name in (
                ("rsi_14", "rsi"), ("macd", "macd"), ("macd_signal", "macd_signal"), ("mid + 2 * dev", "bollinger_hband"),
                ("mid", "bollinger_mavg"), ("mid - 2 * dev", "bollinger_lband"), ("ema", "ema"), ("volatility", "volatility"),
                ("price_rate_of_change", "price_rate_of_change"),
            )
        )
        + ", case when next_close > close then 1 else 0 end as target",
        "sg",
        recursive=True,
    )
    linear = f"""{NUMBERED}, {EMAS}, {CHANGES}, {RSI}, ln as (
      select r.*, e10, {rolling('avg', 'close', 10)} as mid, {rolling('stddev_samp', 'close', 10)} as dev from rsi r join emas using (symbol, "interval", i))"""
    linear_columns = (
        ("mid", "sma_10"), ("e10", "ema_10"), ("rsi_14", "rsi"), ("mid + 2 * dev", "bollinger_high"), ("mid - 2 * dev", "bollinger_low"),
    )
    q["linear_features"] = rows_sql(
        linear,
        "hour(start_timestamp)::int as hour, (isodow(start_timestamp) - 1)::int as day_of_week, "
        + ", ".join(r6(filled(f"({e})"), n) for e, n in linear_columns),
        "ln",
        recursive=True,
    )
    scaled = """scaled as materialized (
      select symbol, "interval", start_timestamp, i, close,
             case when max(close) over s > min(close) over s then (close - min(close) over s) / nullif(max(close) over s - min(close) over s, 0) else 0.0 end as sc
      from b window s as (partition by symbol, "interval"))"""
    boosted = f"""{NUMBERED}, {scaled}, se as (
      select symbol, "interval", i, sc as e from scaled where i = 0
      union all
      select r.symbol, r."interval", n.i, e + 2.0 / 11 * (n.sc - e)
      from se r join scaled n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1),
    bo as (select *, {rolling('avg', 'sc', 10)} as mid, {rolling('stddev_samp', 'sc', 10)} as dev from scaled join se using (symbol, "interval", i))"""
    q["boosted_features"] = rows_sql(
        boosted,
        f"i::double as time_index, {r6(filled('mid'), 'sma_10')}, {r6(filled('e'), 'ema_10')}, {r6(filled('dev'), 'volatility')}, {r6('sc', 'close_scaled')}",
        "bo",
        recursive=True,
    )
    # The row appended on update: last price repeated, next time index, features of the longer series.
    q["boosted_update_rows"] = f"""with recursive {NUMBERED}, {scaled}, last as (
        select symbol, "interval", i, sc, start_timestamp from scaled qualify row_number() over (partition by symbol, "interval" order by i desc) = 1),
      longer as materialized (
        select symbol, "interval", i, sc from scaled
        union all select symbol, "interval", i + 1, sc from last),
      se as (
        select symbol, "interval", i, sc as e from longer where i = 0
        union all
        select r.symbol, r."interval", n.i, e + 2.0 / 11 * (n.sc - e)
        from se r join longer n on n.symbol = r.symbol and n."interval" = r."interval" and n.i = r.i + 1),
      bo as (select *, {rolling('avg', 'sc', 10)} as mid, {rolling('stddev_samp', 'sc', 10)} as dev from longer join se using (symbol, "interval", i))
      select symbol, "interval", i::double as time_index, {r6(filled('mid'), 'sma_10')}, {r6(filled('e'), 'ema_10')}, {r6(filled('dev'), 'volatility')},
             {r6('sc', 'close_scaled')} from bo"""

    # --- labels
    q["binary_labels"] = rows_sql(chain, "case when next_close > close then 1 else 0 end as target", "d")
    labels = f"{chain}, {RETURNS}"
    q["return_thresholds"] = f"with {labels} select symbol, \"interval\", {r6('lower_threshold', 'lower_threshold')}, {r6('upper_threshold', 'upper_threshold')} from thr"
    q["three_way_labels"] = rows_sql(labels, f"{r6('\"return\"', '\"return\"')}, target", "lab")
    q["label_distribution"] = f'with {labels} select symbol, "interval", target, count(*) as rows from lab group by 1, 2, 3'
    q["complete_rows"] = rows_sql(
        labels + f", c as (select *, {rolling('avg', 'close', 20)} as sma_20 from lab)", f"{r6('sma_20', 'sma_20')}, target", "c",
        'where sma_20 is not null and "return" is not null',
    )
    q["complete_in_subset"] = rows_sql(
        labels + f", c as (select *, {rolling('avg', 'close', 20)} as sma_20 from lab)", f"{r6('sma_20', 'sma_20')}, target", "c", "where sma_20 is not null"
    )
    q["look_back_windows"] = f"""with {NUMBERED}, {scaled}, lb as (
      select *, list(sc) over (partition by symbol, "interval" order by i rows between 60 preceding and 1 preceding) as x from scaled)
      select {KEYS}, i as bar_index, {r6('sc', 'y')}, len(x)::int as length, {r6('x[1]', 'x_first')}, {r6('x[60]', 'x_last')},
             {r6('list_sum(list_transform(range(1, 61), lambda j: j * x[j]))', 'x_weighted')} from lb where i >= 60"""

    # --- feature engineering
    per = 'over (partition by symbol, "interval")'
    q["min_max_scaled"] = rows_sql(
        BARS,
        ", ".join(
            r6(f"case when max({c}) {per} > min({c}) {per} then ({c} - min({c}) {per}) / nullif(max({c}) {per} - min({c}) {per}, 0) else 0 end", f"{c}_scaled")
            for c in ("close", "volume")
        ),
        "bars",
    )
    q["standard_scaled"] = rows_sql(
        BARS,
        ", ".join(
            r6(f"case when max({c}) {per} > min({c}) {per} then ({c} - avg({c}) {per}) / nullif(stddev_pop({c}) {per}, 0) else 0 end", f"{c}_scaled")
            for c in ("close", "volume")
        ),
        "bars",
    )
    names = ("close", "high", "low", "volume", "sma_10", "sma_20")
    corr_base = f"{NUMBERED}, c as (select *, {rolling('avg', 'close', 10)} as sma_10, {rolling('avg', 'close', 20)} as sma_20 from b)"
    pairs = [(a, b) for n, a in enumerate(names) for b in names[n + 1 :]]
    corr_rows = " union all ".join(
        f"select symbol, \"interval\", '{a}' as earlier, '{b}' as later, abs(case when isnan(corr({a}, {b})) then null else corr({a}, {b}) end) as correlation from c group by 1, 2" for a, b in pairs
    )
    q["correlations"] = f"with {corr_base}, pairs as ({corr_rows}) select symbol, \"interval\", earlier, later, {r6('correlation', 'correlation')} from pairs"
    listed = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    q["uncorrelated_features"] = f"""with {corr_base}, pairs as ({corr_rows}), dropped as (
        select symbol, "interval", coalesce(list(distinct later) filter (correlation > 0.98), []) as gone from pairs group by 1, 2),
      kept as (select *, list_filter({listed}, lambda f: not list_contains(gone, f)) as k from dropped),
      sized as (select *, case when list_contains(k, 'close') then k else list_append(k, 'close') end as k2 from kept),
      cut as (select *, case when len(k2) < floor(0.85::double * 6) then {listed}[1:5] else k2 end as k3 from sized)
      select symbol, "interval", array_to_string(case when list_contains(k3, 'close') then k3 else list_append(k3, 'close') end, ',') as final_features from cut"""
    mi_names = ("close", "high", "low", "volume", "change")
    mi = f"""{labels}, flat as (
        select symbol, "interval", target, unnest({list(mi_names)}) as feature, unnest([close, high, low, volume, coalesce(close - prev_close, 0)]) as v
        from lab where "return" is not null),
      binned as (
        select *, floor((rank() over (partition by symbol, "interval", feature order by v) - 1) * 16 / count(*) over (partition by symbol, "interval", feature)) as bin from flat),
      cells as (select symbol, "interval", feature, bin, target, count(*)::double as n from binned group by all),
      marg as (
        select *, sum(n) over (partition by symbol, "interval", feature) as total, sum(n) over (partition by symbol, "interval", feature, bin) as nb,
               sum(n) over (partition by symbol, "interval", feature, target) as nl from cells),
      info as (select symbol, "interval", feature, sum(n / total * ln(n * total / (nb * nl))) as information from marg group by 1, 2, 3)"""
    q["mutual_information"] = f"with {mi} select symbol, \"interval\", feature, {r6('information', 'information')} from info"
    q["informative_features"] = f"""with {mi}, tried as (
        select symbol, "interval", t as threshold, list(feature order by list_position({list(mi_names)}, feature)) as f
        from info, (select unnest([0.005, 0.01, 0.02, 0.05, 0.08]::double[]) as t) where information > t group by 1, 2, 3)
      select symbol, "interval", threshold, array_to_string(f, ',') as features from tried where len(f) >= 2"""
    q["class_weights"] = f"""with {labels}, c as (select symbol, "interval", target, count(*) as class_rows from lab where "return" is not null group by 1, 2, 3)
      select symbol, "interval", target, class_rows, {r6('sum(class_rows) over s / (count(*) over s * class_rows)', 'weight')} from c
      window s as (partition by symbol, "interval")"""
    z = f"""{labels}, z as materialized (
        select symbol, "interval", target, i,
               case when max(close) over s > min(close) over s then (close - avg(close) over s) / stddev_pop(close) over s else 0 end as zc,
               case when max(volume) over s > min(volume) over s then (volume - avg(volume) over s) / stddev_pop(volume) over s else 0 end as zv
        from lab where "return" is not null window s as (partition by symbol, "interval")),
      cc as (select symbol, "interval", target, count(*) as n from z group by 1, 2, 3),
      short as (select *, max(n) over (partition by symbol, "interval") - n as missing from cc),
      mem as materialized (
        select z.*, n, missing, row_number() over (partition by symbol, "interval", target order by i) - 1 as member
        from z join short using (symbol, "interval", target)),
      nn as materialized (
        select a.symbol, a."interval", a.target, a.member, b.member as neighbour, round(sqrt((a.zc - b.zc) ** 2 + (a.zv - b.zv) ** 2), 9) as distance
        from mem a join mem b on a.symbol = b.symbol and a."interval" = b."interval" and a.target = b.target and a.member <> b.member
        qualify row_number() over (partition by a.symbol, a."interval", a.target, a.member order by distance, b.member) <= 5),
      nk as materialized (select *, row_number() over (partition by symbol, "interval", target, member order by distance, neighbour) as rank from nn)"""
    q["class_neighbours"] = f'with {z} select symbol, "interval", target, member, rank::int as rank, neighbour, {r6("distance", "distance")} from nk'
    tag = "symbol || '|' || \"interval\" || '|' || target::varchar || '|' || replica::varchar || '|"
    q["synthetic_rows"] = f"""with {z}, rep as (select *, unnest(range(missing)) as replica from short where missing > 0),
      dr as (
        select *, {HASH.format(tag + "s'")} % n as member, 1 + {HASH.format(tag + "n'")} % least(5, n - 1) as rank,
               {HASH.format(tag + "g'")} / 4294967296.0::double as gap from rep)
      select dr.symbol, dr."interval", dr.target, replica, {r6('a.zc + gap * (b.zc - a.zc)', 'close_scaled')}, {r6('a.zv + gap * (b.zv - a.zv)', 'volume_scaled')}
      from dr join nk using (symbol, "interval", target, member, rank)
      join mem a using (symbol, "interval", target, member)
      join mem b on b.symbol = dr.symbol and b."interval" = dr."interval" and b.target = dr.target and b.member = nk.neighbour"""

    # --- evaluation
    q["stratified_folds"] = f"""with {labels} select {KEYS}, target,
      ((row_number() over (partition by symbol, "interval", target order by md5(symbol || '|' || "interval" || '|' || i::varchar || '|42')) - 1) % 5)::int as fold
      from lab where "return" is not null"""
    q["accuracy"] = f"with {SCORED} select symbol, \"interval\", {r6('avg((target = prediction)::int::double)', 'accuracy')} from scored group by 1, 2"
    q["macro_scores"] = f"""with {SCORED}, cl as (select symbol, "interval", target as class from scored union select symbol, "interval", prediction from scored),
      pc as (
        select cl.symbol, cl."interval", class, count(*) filter (target = class and prediction = class) as hits,
               count(*) filter (target = class) as actual, count(*) filter (prediction = class) as predicted
        from cl join scored using (symbol, "interval") group by 1, 2, 3)
      select symbol, "interval", {r6('sum(hits)::double / sum(actual)', 'accuracy')},
             {r6('avg(case when predicted > 0 then hits::double / predicted else 0 end)', 'precision')},
             {r6('avg(case when actual > 0 then hits::double / actual else 0 end)', 'recall')},
             {r6('avg(2.0 * hits / (predicted + actual))', 'f1_score')} from pc group by 1, 2"""
    q["roc_auc"] = f"with {SCORED}, {AUC.format(src='scored')} select symbol, \"interval\", {r6('roc_auc', 'roc_auc')} from auc_per_series"
    q["roc_auc_two_classes"] = (
        f"with {SCORED}, two as (select * from scored where target <> 0), {AUC.format(src='two')} select symbol, \"interval\", {r6('roc_auc', 'roc_auc')} from auc_per_series"
    )
    q["roc_auc_one_class"] = f'with {SCORED} select distinct symbol, "interval", null::double as roc_auc from scored where target = 0'
    q["one_hot_labels"] = f"""with {SCORED} select {KEYS}, (target = -1)::int as is_sell, (target = 0)::int as is_hold, (target = 1)::int as is_buy from scored"""
    q["soft_vote"] = f"""with {SCORED}, other as (
        select *, (p_neg + p_pos) / 2 as va, (p_zero + p_neg) / 2 as vb, (p_pos + p_zero) / 2 as vc from scored)
      select {KEYS}, {r6('va', 'p_neg')}, {r6('vb', 'p_zero')}, {r6('vc', 'p_pos')},
             case when va >= vb and va >= vc then -1 when vb >= vc then 0 else 1 end as prediction from other"""
    q["mean_squared_error"] = f"""with {chain} select symbol, "interval", {r6('avg((next_close - close) ** 2)', 'mse')} from d group by 1, 2"""
    folded = f"""{SCORED}, fo as (
        select *, (row_number() over (partition by symbol, "interval", target order by md5(symbol || '|' || "interval" || '|' || i::varchar || '|42')) - 1) % 5 as fold from scored),
      fs as (select symbol, "interval", fold, prediction as candidate, count(distinct target) as labels, avg((target = prediction)::int::double) as acc from fo group by 1, 2, 3, 4),
      sc as (select *, case when labels >= 2 then acc end as score from fs),
      ms as (select symbol, "interval", candidate, avg(score) as mean_score from sc group by 1, 2, 3)"""
    q["fold_scores"] = f"with {folded} select symbol, \"interval\", fold::int as fold, candidate, labels, {r6('score', 'score')} from sc"
    q["best_candidate"] = f"""with {folded} select symbol, "interval", candidate, {r6('mean_score', 'mean_score')} from ms where mean_score is not null
      qualify row_number() over (partition by symbol, "interval" order by mean_score desc, candidate) = 1"""

    # --- models: the parts that are plain computation
    q["unit_root"] = f"""with {chain}, x as (select symbol, "interval", prev_close as x, close - prev_close as y from d where prev_close is not null),
      s as (select symbol, "interval", count(*) as n, regr_sxx(y, x) as sxx, regr_sxy(y, x) as sxy, regr_syy(y, x) as syy from x group by 1, 2),
      t as (select *, case when sxx > 0 and n > 2 and syy - sxy * sxy / sxx > 0 then (sxy / sxx) / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) end as tau from s)
      select symbol, "interval", {r6('tau', 'tau')}, (tau is null or tau > -2.86)::int as d from t"""
    q["candidate_orders"] = f"""with {BARS}, s as (select distinct symbol, "interval" from bars)
      select symbol, "interval", p::int as p, q::int as q from s, range(6) a(p), range(6) b(q)"""
    q["jobs_to_train"] = f"""with {BARS}, {STRATEGIES} select distinct symbol, bars."interval", strategy from bars join strategies s on s."interval" = bars."interval"
      where symbol like 'SPOT%' """
    q["jobs_to_update"] = f"""with {BARS}, {STRATEGIES} select distinct symbol, bars."interval", strategy from bars join strategies s on s."interval" = bars."interval"
      where symbol like 'PERP%' """
    old = "start_timestamp <= timestamp '2024-01-15'"
    lin = (
        linear
        + ", lf as ("
        + f"select {KEYS}, i, close, "
        + ", ".join(f"{filled(f'({e})')} as {n}" for e, n in linear_columns)
        + " from ln)"
    )
    sides = []
    for version, cond in (("old", f"filter ({old})"), ("new", "")):
        cols = ", ".join(
            r6(
                f"case when max({n}) {cond} {per} > min({n}) {cond} {per} then ({n} - min({n}) {cond} {per}) / nullif(max({n}) {cond} {per} - min({n}) {cond} {per}, 0) else 0 end",
                f"{n}_scaled",
            )
            for _, n in linear_columns
        )
        sides.append(f"select {KEYS}, '{version}' as scaler, close, {cols} from lf")
    q["linear_update_rows"] = f"with recursive {lin} {' union all '.join(sides)}"
    # Unrounded: both sides do the same three operations.
    q["forest_weights"] = f"""with {SCORED} select {KEYS}, p_neg * (100.0::double / 150) + p_pos * (50.0::double / 150) as p_neg,
      p_zero * (100.0::double / 150) + p_neg * (50.0::double / 150) as p_zero,
      p_pos * (100.0::double / 150) + p_zero * (50.0::double / 150) as p_pos from scored"""

    q["augmented_unit_root"] = f"with recursive {PRODUCTS}, {unit_root_sql()} select symbol, \"interval\", {r6('tau', 'tau')}, d from adf"
    q["arima_orders"] = f"with recursive {PRODUCTS}, {unit_root_sql()}, {orders_sql()} select symbol, \"interval\", p, d, q, round(aic, 3) + 0.0 as aic from best"
    lf = ", ".join(f"{f}_scaled" for f in ("sma_10", "ema_10", "rsi", "bollinger_high"))
    q["linear_predictions"] = f"""with recursive {lin}, {linear_sql()}
      select {KEYS}, {r6('close', 'close')}, {r6('b[1] + ' + ' + '.join(f'b[{i}] * {n}' for i, n in enumerate(lf.split(', '), 2)), 'prediction')}
      from lscaled join lsolved using (symbol, "interval")"""

    # --- trained models: what is stored and what their scores must obey
    four = "where \"interval\" = '4h'"
    q["strategy_models"] = f"""with {BARS}, {STRATEGIES} select distinct symbol, bars."interval", strategy,
      'trained_models/' || symbol || '_' || bars."interval" || '_' || replace(features, ',', '_') as model_key, features,
      2 as forests, true as grown, true as scaled
      from bars join strategies s on s."interval" = bars."interval" where bars."interval" = '4h' and strategy = 'Volatility Breakout'"""
    q["metrics_written"] = f"""with {BARS} select distinct symbol as asset, "interval", 'Volatility Breakout' as strategy, 2 as runs, 2 as times, true as in_range
      from bars {four}"""
    q["scored_strategies"] = f"""with {NUMBERED}, {CHANGES}, {RETURNS} select {KEYS}, target, true as sums_to_one, true as likeliest from lab
      {four} and "return" is not null"""
    # A strategy with cloud spans needs 78 bars before a row is complete.
    short = "strategy in ('Advanced', 'Router') and n < 78"
    q["forest_models"] = f"""with {BARS}, {STRATEGIES}, series as (select symbol, "interval", count(*) as n from bars group by all)
      select symbol, series."interval", strategy, case when {short} then 'no complete rows' else 'ok' end as status,
        'trained_models/' || symbol || '_' || series."interval" || '_' || replace(features, ',', '_') as model_key,
        case when not ({short}) then 2 end as runs, case when not ({short}) then true end as grown, case when not ({short}) then true end as in_range
      from series join strategies s on s."interval" = series."interval" """
    q["scored_forests"] = f"""with {NUMBERED}, {CHANGES}, {RETURNS}, {STRATEGIES}, series as (select symbol, "interval", count(*) as n from lab group by all)
      select lab.symbol, lab."interval", strategy, start_timestamp, target, true as sums_to_one, true as likeliest
      from lab join series using (symbol, "interval") join strategies s on s."interval" = lab."interval" where "return" is not null and not ({short})"""
    q["signal_models"] = f"""with {NUMBERED}, {CHANGES} select {KEYS}, case when next_close > close then 1 else 0 end as target, 1 as version, true as voted
      from d {four}"""
    q["look_back_models"] = f"""with {BARS} select symbol, "interval", 1 as version, 2 as stages, count(*) - 10 as rows, true as better_than_mean
      from bars {four} group by 1, 2"""
    q["price_models"] = f"""with {BARS} select symbol, "interval", 1 as version, 1 as stages, count(*) + 1 as rows, true as better_than_mean
      from bars {four} group by 1, 2"""
    q["arima_history"] = f"""with {BARS} select symbol, "interval", count(*) - 19 as rows, true as order_kept, true as fitted
      from bars where "interval" in ('5m', '1h') group by 1, 2"""

    # --- streaming
    q["streamed_bars"] = f"with {BARS} select {KEYS}, open, high, low, close, volume from bars where \"interval\" = '1h'"
    q["streamed_payload_bars"] = q["bars_from_payloads"]
    q["streamed_tick_bars"] = f"with {BARS} select {KEYS}, open, high, low, close, volume from bars"
    q["streamed_closed_bars"] = f"""with {BARS}, ends as (
      select bars.*, start_timestamp + case "interval" when '5m' then interval 5 minute when '1h' then interval 1 hour
        when '4h' then interval 4 hour else interval 1 day end as ends from bars),
      closed as (select * from ends where "interval" = '5m' and ends <= (select max(ts) from events) - interval 1 hour)
      select {KEYS}, open, high, low, close, volume from ends
      where case when "interval" = '5m' then ends <= (select max(ts) from events) - interval 1 hour
        else ends <= (select max(ends) from closed) end"""
    return q


STRATEGY_QUERIES = {
    "features_trend_following_1h": (["ema_20", "ema_50", "macd", "adx", "vwap"], ["1h"]),
    "features_trend_following_5m": (["ema_12", "ema_26", "macd", "adx", "vwap"], ["5m"]),
    "features_trend_following_4h_1d": (["ema_50", "ema_200", "macd", "adx", "vwap"], ["4h", "1d"]),
    "features_volatility_breakout": (["atr_14", "bollinger_hband", "std_20", "vwap"], ["5m", "1h", "4h", "1d"]),
    "features_momentum_reversal": (["rsi_14", "stoch_k_14", "roc_10", "momentum_10", "vwap"], ["5m", "1h", "4h", "1d"]),
    "features_momentum_volatility": (["rsi_14", "atr_14", "bollinger_hband", "roc_10", "momentum_10", "vwap"], ["5m", "1h", "4h", "1d"]),
    "features_hybrid_1h": (["ema_20", "ema_50", "atr_14", "bollinger_hband", "rsi_14", "macd", "vwap"], ["1h"]),
    "features_advanced": (["tenkan_sen_9", "kijun_sen_26", "senkou_span_a", "senkou_span_b", "sar", "vwap"], ["5m", "1h", "4h", "1d"]),
    "features_router": (
        ["macd", "adx", "atr_14", "bollinger_hband", "std_20", "rsi_14", "stoch_k_14", "roc_10", "momentum_10", "senkou_span_a", "senkou_span_b", "sar", "vwap"],
        ["5m", "1h", "4h", "1d"],
    ),
}
