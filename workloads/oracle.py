"""The registered queries as DuckDB SQL over the driver tables."""

from __future__ import annotations

from workloads.derive import BREAKS, LISTED, MISSING, PROFILE

TRADES = """
trades AS (
  SELECT printf('S%05d', l_suppkey) AS ticker, CAST(l_shipdate AS DATE) AS "Date", l_orderkey,
         l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS net,
         l_extendedprice * (1 + l_tax) AS gross, l_quantity, l_tax,
         row(l_orderkey, l_linenumber, l_extendedprice, l_discount) AS o
  FROM lineitem
),
daily AS (
  SELECT ticker, "Date", arg_min(price, o) AS "Open", max(gross) AS "High", min(net) AS "Low",
         arg_max(price, o) AS "Close", arg_max(net, o) AS "Adj Close", sum(l_quantity) AS "Volume",
         max(l_tax) AS "Dividends", CAST(0 AS DOUBLE) AS "Stock Splits", max(l_orderkey) AS ord
  FROM trades GROUP BY ticker, "Date"
)"""
BARS = TRADES + ', bars AS (SELECT * EXCLUDE (ord) FROM daily)'

_HOLES = ", ".join(
    f'CASE WHEN ord % 97 = {i} THEN NULL {"WHEN ord % 97 = 6 THEN CAST($$nan$$ AS DOUBLE) " if c == "Close" else ""}'
    f'ELSE "{c}" END AS "{c}"'
    for i, c in enumerate(("Open", "High", "Low", "Close", "Adj Close", "Volume"))
)
RAW = TRADES + f', raw AS (SELECT ticker, "Date", {_HOLES}, "Dividends", "Stock Splits" FROM daily)'
_COMPLETE = " AND ".join(
    f'"{c}" IS NOT NULL AND NOT isnan("{c}")' for c in ("Open", "High", "Low", "Close", "Adj Close", "Volume")
)

# Periods with their unit and number.
_PERIOD_ROWS = "('D', 'd', 1), ('W', 'w', 1), ('2W', 'w', 2), ('3W', 'w', 3), ('ME', 'm', 1), ('2ME', 'm', 2), ('3ME', 'm', 3)"
SERIES = (
    BARS
    + f""",
periods(period, unit, n) AS (VALUES {_PERIOD_ROWS}),
anchors AS (SELECT ticker, min("Date") AS f FROM bars GROUP BY ticker),
placed AS (
  SELECT b.*, p.*, f + CAST(7 - isodow(f) AS INTEGER) AS s0,
         12 * year(f) + month(f) - 1 AS m0, 12 * year("Date") + month("Date") - 1 AS m
  FROM bars b JOIN anchors USING (ticker) CROSS JOIN periods p
),
labelled AS (
  SELECT *, m0 + n * CAST(ceil((m - m0) / n) AS INTEGER) AS target,
    CASE unit WHEN 'd' THEN "Date"
              WHEN 'w' THEN s0 + 7 * n * CAST(ceil(("Date" - s0) / (7.0 * n)) AS INTEGER) END AS week_label
  FROM placed
),
series AS (
  SELECT ticker, period, coalesce(week_label, last_day(make_date(target // 12, target % 12 + 1, 1))) AS label,
         arg_min("Open", "Date") AS "Open", max("High") AS "High", min("Low") AS "Low",
         arg_max("Close", "Date") AS "Close", arg_max("Adj Close", "Date") AS "Adj Close",
         sum("Volume") AS "Volume"
  FROM labelled GROUP BY ticker, period, label
)"""
)


def resample_sql(code: str) -> str:
    return f"""WITH {SERIES}
SELECT ticker, label AS "Date", "Open", "High", "Low", "Close", "Adj Close" AS adj_close, "Volume"
FROM series WHERE period = '{code}'"""


def resample_keep_sql() -> str:
    return f"""WITH {SERIES},
ends AS (SELECT ticker, period, min(label) AS a, max(label) AS z FROM series WHERE period <> 'D' GROUP BY ticker, period),
wanted AS (
  SELECT ticker, period, unnest(CASE WHEN unit = 'w'
      THEN list_transform(range(0, CAST((z - a) // (7 * n) AS BIGINT) + 1), lambda k: a + CAST(7 * n * k AS INTEGER))
      ELSE list_transform(range(0, CAST(((12 * year(z) + month(z)) - (12 * year(a) + month(a))) // n AS BIGINT) + 1),
             lambda k: last_day(CAST(date_trunc('month', a) + to_months(CAST(n * k AS INTEGER)) AS DATE))) END) AS label
  FROM ends JOIN periods USING (period)
)
SELECT ticker, period, label AS "Date", "Open", "High", "Low", "Close", coalesce("Volume", 0.0) AS "Volume"
FROM wanted LEFT JOIN series USING (ticker, period, label)"""


# --- indicators -------------------------------------------------------------------------
def _num(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _ema(name: str, x: str, n: int, start: int = 0, old: str = "r.") -> list[tuple[str, str]]:
    """(column, step expression) pairs of one exponential average."""
    last = start + n - 1
    acc, val = f"{old}{name}_acc", f"{old}{name}"
    return [
        (f"{name}_acc", f"CASE WHEN pos BETWEEN {start} AND {last} THEN {acc} + {x} ELSE {acc} END"),
        (
            name,
            f"CASE WHEN pos = {last} THEN ({acc} + {x}) / {n} "
            f"WHEN pos > {last} THEN ({x} - {val}) * {_num(2.0 / (n + 1))} + {val} END",
        ),
    ]


def _wilder(name: str, x: str, n: int) -> tuple[str, str]:
    return name, f"CASE WHEN pos < {n} THEN r.{name} + {x} ELSE r.{name} - r.{name} / {n} + {x} END"


def indicators_ctes() -> str:
    first: list[tuple[str, str]] = []
    first += _ema("ema13", "c", 13) + _ema("ema26", "c", 26) + _ema("fast12", "c", 12, start=14)
    first += _ema("fi2", "fi", 2) + _ema("fi13", "fi", 13)
    for n in (13, 14):
        first += [_wilder(f"up{n}", "up", n), _wilder(f"dn{n}", "dn", n), _wilder(f"tr{n}", "tr", n)]
    first += [
        ("atr_acc", "CASE WHEN pos <= 14 THEN r.atr_acc + tr ELSE r.atr_acc END"),
        ("atr", "CASE WHEN pos = 14 THEN (r.atr_acc + tr) / 14 WHEN pos > 14 THEN (r.atr * 13 + tr) / 14 END"),
    ]
    second = _ema("sig", "line", 9, start=25, old="p_") + [
        ("adx_acc", "CASE WHEN pos BETWEEN 14 AND 27 THEN p_adx_acc + coalesce(dx, 0) ELSE p_adx_acc END"),
        (
            "adx",
            "CASE WHEN pos = 27 THEN (p_adx_acc + coalesce(dx, 0)) / 14 "
            "WHEN pos > 27 THEN CASE WHEN dx IS NULL THEN p_adx ELSE (p_adx * 13 + dx) / 14 END END",
        ),
    ]
    zero = {"ema13_acc": "c", "ema26_acc": "c", "fi2_acc": "fi", "fi13_acc": "fi"}
    double_null = "CAST(NULL AS DOUBLE)"

    def base(name: str) -> str:
        if name in zero:
            return zero[name]
        running = name.endswith("_acc") or name[:2] in ("up", "dn", "tr")
        return "CAST(0 AS DOUBLE)" if running else double_null

    first_names, second_names = [n for n, _ in first], [n for n, _ in second]
    base_cols = ", ".join(f"{base(n)} AS {n}" for n in first_names + second_names)
    step1 = ", ".join(f"{e} AS {n}" for n, e in first)
    carry = ", ".join(f"r.{n} AS p_{n}" for n in second_names)
    step2 = ", ".join(f"{e} AS {n}" for n, e in second)
    share = "CASE WHEN abs(tr14) < 1e-14 THEN 0 ELSE 100.0 * ({0}14 / tr14) END"
    plus, minus = share.format("up"), share.format("dn")
    return f"""
lagged AS (
  SELECT ticker, period, label, "Open" AS o, "High" AS h, "Low" AS l, "Close" AS c, "Volume" AS v,
         row_number() OVER w - 1 AS pos, lag("High") OVER w AS h1, lag("Low") OVER w AS l1, lag("Close") OVER w AS c1
  FROM series WINDOW w AS (PARTITION BY ticker, period ORDER BY label)
),
prepared AS MATERIALIZED (
  SELECT *, CASE WHEN c1 IS NOT NULL THEN greatest(h - l, abs(h - c1), abs(l - c1)) END AS tr,
    CASE WHEN h - h1 > 0 AND h - h1 > l1 - l THEN h - h1 WHEN h1 IS NOT NULL THEN 0.0 END AS up,
    CASE WHEN l1 - l > 0 AND l1 - l > h - h1 THEN l1 - l WHEN h1 IS NOT NULL THEN 0.0 END AS dn,
    CASE WHEN pos = 0 THEN 0.0 ELSE (c - c1) * v END AS fi,
    max(h) OVER w5 AS h5, min(l) OVER w5 AS l5, max(h) OVER w7 AS h7, min(l) OVER w7 AS l7,
    avg(c) OVER w50 AS a50, avg(c) OVER w200 AS a200, stddev_pop(c) OVER w13 AS sd
  FROM lagged
  WINDOW w5 AS (PARTITION BY ticker, period ORDER BY pos ROWS 4 PRECEDING),
         w7 AS (PARTITION BY ticker, period ORDER BY pos ROWS 6 PRECEDING),
         w13 AS (PARTITION BY ticker, period ORDER BY pos ROWS 12 PRECEDING),
         w50 AS (PARTITION BY ticker, period ORDER BY pos ROWS 49 PRECEDING),
         w200 AS (PARTITION BY ticker, period ORDER BY pos ROWS 199 PRECEDING)
),
steps AS (
  SELECT ticker, period, pos, {base_cols} FROM prepared WHERE pos = 0
  UNION ALL
  SELECT ticker, period, pos, {", ".join(first_names)}, {step2}
  FROM (
    SELECT *, fast12 - ema26 AS line,
           CASE WHEN abs({plus} + {minus}) >= 1e-14
                THEN 100.0 * (abs({minus} - {plus}) / ({minus} + {plus})) END AS dx
    FROM (
      SELECT s.ticker, s.period, s.pos, {step1}, {carry}
      FROM (SELECT ticker AS r_ticker, period AS r_period, pos AS r_pos, * EXCLUDE (ticker, period, pos) FROM steps) r
      JOIN (SELECT ticker, period, pos, c, fi, up, dn, tr FROM prepared) s
        ON s.ticker = r_ticker AND s.period = r_period AND s.pos = r_pos + 1
    )
  )
),
stoch1 AS (
  SELECT *, CASE WHEN h5 = l5 THEN 0 ELSE (c - l5) / ((h5 - l5) / 100.0) END AS fast_k FROM prepared
),
stoch2 AS (
  SELECT *, avg(CASE WHEN pos >= 4 THEN fast_k END) OVER (PARTITION BY ticker, period ORDER BY pos ROWS 2 PRECEDING) AS slow_k
  FROM stoch1
),
stoch3 AS (
  SELECT *, avg(CASE WHEN pos >= 6 THEN slow_k END) OVER (PARTITION BY ticker, period ORDER BY pos ROWS 2 PRECEDING) AS slow_d
  FROM stoch2
),
ind AS MATERIALIZED (
  SELECT p.ticker, p.period, p.label AS "Date", p.pos, h, l, c, v,
    adx AS "ADX", CASE WHEN sig IS NOT NULL THEN fast12 - ema26 END AS "MACD", sig AS "MACD_signal",
    CASE WHEN sig IS NOT NULL THEN (fast12 - ema26) - sig END AS "MACD_hist",
    CASE WHEN pos >= 13 THEN CASE WHEN abs(tr13) < 1e-14 THEN 0 ELSE 100.0 * (up13 / tr13) END END AS "PLUS_DI",
    CASE WHEN pos >= 13 THEN CASE WHEN abs(tr13) < 1e-14 THEN 0 ELSE 100.0 * (dn13 / tr13) END END AS "MINUS_DI",
    CASE WHEN pos >= 8 THEN slow_k END AS "STOCH_slowk", CASE WHEN pos >= 8 THEN slow_d END AS "STOCH_slowd",
    CASE WHEN pos >= 6 THEN CASE WHEN h7 = l7 THEN 0 ELSE (h7 - c) / ((h7 - l7) / -100.0) END END AS "WILLR",
    ema13 + sd * 2.7 AS "upperband", ema13 AS "middleband", ema13 - sd * 2.7 AS "lowerband",
    ema13 + sd * 1.7 AS "upper_1_7", ema13 - sd * 1.7 AS "lower_1_7", ema13 AS "EMA13", ema26 AS "EMA26",
    CASE WHEN pos >= 49 THEN a50 END AS "SMA50", CASE WHEN pos >= 199 THEN a200 END AS "SMA200",
    atr AS "ATR", fi AS "FI", fi2 AS "FI_2", fi13 AS "FI_13", h - ema13 AS "Bull_Power", l - ema13 AS "Bear_Power"
  FROM stoch3 p JOIN steps USING (ticker, period, pos)
)"""


INDICATORS = f"{SERIES},\n{indicators_ctes()}"


def indicator_sql(columns: tuple[str, ...], digits: int) -> str:
    shown = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in columns)
    return f'WITH RECURSIVE {INDICATORS}\nSELECT ticker, period, "Date", {shown} FROM ind'


# --- signals ----------------------------------------------------------------------------
SIGNALS = (
    INDICATORS
    + """,
curves AS MATERIALIZED (
  SELECT ticker, period, 'pp' AS kind, pos, c AS x FROM ind
  UNION ALL SELECT ticker, period, 'pt', pos, -c FROM ind
  UNION ALL SELECT ticker, period, 'fp', pos, "FI_2" FROM ind WHERE "FI_2" IS NOT NULL
  UNION ALL SELECT ticker, period, 'ft', pos, -"FI_2" FROM ind WHERE "FI_2" IS NOT NULL
),
changes AS (
  SELECT *, CASE WHEN x = lag(x) OVER (PARTITION BY ticker, period, kind ORDER BY pos) THEN 0 ELSE 1 END AS fresh
  FROM curves
),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY ticker, period, kind ORDER BY pos) AS run FROM changes
),
runs AS (
  SELECT ticker, period, kind, run, x, min(pos) AS a, max(pos) AS z
  FROM numbered GROUP BY ticker, period, kind, run, x
),
around AS (
  SELECT *, lag(x) OVER w AS xa, lead(x) OVER w AS xz FROM runs
  WINDOW w AS (PARTITION BY ticker, period, kind ORDER BY run)
),
ranked AS MATERIALIZED (
  SELECT ticker, period, kind, (a + z) // 2 AS pos, x,
         row_number() OVER (PARTITION BY ticker, period, kind ORDER BY x DESC, a DESC) AS rk
  FROM around WHERE xa < x AND xz < x
),
greedy AS (
  SELECT ticker, period, kind, rk, true AS kept, [pos] AS chosen FROM ranked WHERE rk = 1
  UNION ALL
  SELECT ticker, period, kind, rk, free, CASE WHEN free THEN list_append(chosen, pos) ELSE chosen END
  FROM (
    SELECT p.*, g.chosen, len(list_filter(g.chosen, lambda q: abs(q - p.pos) < 5)) = 0 AS free
    FROM greedy g JOIN ranked p
      ON p.ticker = g.ticker AND p.period = g.period AND p.kind = g.kind AND p.rk = g.rk + 1
  )
),
spaced AS (SELECT r.* FROM ranked r JOIN greedy USING (ticker, period, kind, rk) WHERE kept),
fenced AS (
  SELECT s.ticker, s.period, s.kind, s.pos, s.x,
         coalesce(max(CASE WHEN u.pos < s.pos THEN u.pos END), -1) AS left_fence,
         coalesce(min(CASE WHEN u.pos > s.pos THEN u.pos END), 1000000) AS right_fence
  FROM spaced s LEFT JOIN curves u
    ON u.ticker = s.ticker AND u.period = s.period AND u.kind = s.kind AND u.x > s.x
  GROUP BY s.ticker, s.period, s.kind, s.pos, s.x
),
deep AS (
  SELECT f.ticker, f.period, f.kind, f.pos, f.x,
         min(CASE WHEN u.pos <= f.pos THEN u.x END) AS left_low, min(CASE WHEN u.pos >= f.pos THEN u.x END) AS right_low
  FROM fenced f JOIN curves u
    ON u.ticker = f.ticker AND u.period = f.period AND u.kind = f.kind
   AND u.pos > f.left_fence AND u.pos < f.right_fence
  GROUP BY f.ticker, f.period, f.kind, f.pos, f.x
),
peaks AS MATERIALIZED (
  SELECT ticker, period, kind, pos, x FROM deep
  WHERE x - greatest(left_low, right_low) >= CASE WHEN kind IN ('pp', 'pt') THEN 1 ELSE 5 END
    AND (kind IN ('pp', 'pt') OR x > 0)
),
pairs AS (
  SELECT *, lag(pos, 1) OVER w AS near, lag(x, 1) OVER w AS near_x, lag(pos, 2) OVER w AS far, lag(x, 2) OVER w AS far_x
  FROM peaks WHERE kind IN ('pp', 'pt') WINDOW w AS (PARTITION BY ticker, period, kind ORDER BY pos)
),
marked AS (
  SELECT p.ticker, p.period, p.kind, p.pos, i."MACD_hist", i."FI_13",
    CASE WHEN p.x > far_x AND p.x - far_x <= "ATR" THEN far
         WHEN far IS NOT NULL AND p.x > near_x AND p.x - near_x <= "ATR" THEN near END AS search
  FROM pairs p JOIN ind i ON i.ticker = p.ticker AND i.period = p.period AND i.pos = p.pos
),
topped AS MATERIALIZED (SELECT *, CASE WHEN kind = 'pp' THEN 1 ELSE -1 END AS sgn FROM marked WHERE search IS NOT NULL),
spans AS (
  SELECT m.ticker, m.period, m.kind, m.pos, j.pos AS jpos,
    m.sgn * m."MACD_hist" AS now1, m.sgn * j."MACD_hist" AS then1,
    m.sgn * m."FI_13" AS now2, m.sgn * j."FI_13" AS then2,
    CASE WHEN m.sgn = 1 THEN j."Bull_Power" ELSE -j."Bear_Power" END AS power
  FROM topped m JOIN ind j
    ON j.ticker = m.ticker AND j.period = m.period AND j.pos >= m.search AND j.pos < m.pos
),
falls AS (
  SELECT *,
    CASE WHEN now1 < then1 THEN CASE WHEN then1 = 0 THEN CAST('inf' AS DOUBLE) ELSE abs(now1 - then1) / abs(then1) * 100 END END AS d1,
    CASE WHEN now2 < then2 THEN CASE WHEN then2 = 0 THEN CAST('inf' AS DOUBLE) ELSE abs(now2 - then2) / abs(then2) * 100 END END AS d2
  FROM spans
),
leans AS (
  SELECT ticker, period, kind, pos,
    arg_max(jpos, row(d1, -jpos)) FILTER (d1 >= 30) AS from1,
    arg_max(jpos, row(d2, -jpos)) FILTER (d2 >= 70) AS from2,
    list_sort(list(row(-power, jpos)) FILTER (power > 0)) AS powers
  FROM falls GROUP BY ticker, period, kind, pos
),
fading AS (
  SELECT ticker, period, kind, pos, from1, from2, powers[1][2] AS p1, powers[2][2] AS p2 FROM leans
),
shifted AS (
  SELECT *, lag("EMA13") OVER w AS e13, lag("EMA26") OVER w AS e26, lag("FI_13") OVER w AS f13 FROM ind
  WINDOW w AS (PARTITION BY ticker, period ORDER BY pos)
),
flagged AS (
  SELECT s.*, pp.pos IS NOT NULL AS "price_Peak", pt.pos IS NOT NULL AS "price_Trough",
    fp.pos IS NOT NULL AS "FI_2_Peak", ft.pos IS NOT NULL AS "FI_2_Trough",
    coalesce(t.kind = 'pp', false) AS "Higher_Peak", coalesce(t.kind = 'pt', false) AS "Lower_Trough",
    t.search AS "price_search", fa.from1, fa.from2, CASE WHEN fa.p1 < fa.p2 THEN fa.p1 END AS p1, fa.p2
  FROM shifted s
  LEFT JOIN peaks pp ON pp.ticker = s.ticker AND pp.period = s.period AND pp.pos = s.pos AND pp.kind = 'pp'
  LEFT JOIN peaks pt ON pt.ticker = s.ticker AND pt.period = s.period AND pt.pos = s.pos AND pt.kind = 'pt'
  LEFT JOIN peaks fp ON fp.ticker = s.ticker AND fp.period = s.period AND fp.pos = s.pos AND fp.kind = 'fp'
  LEFT JOIN peaks ft ON ft.ticker = s.ticker AND ft.period = s.period AND ft.pos = s.pos AND ft.kind = 'ft'
  LEFT JOIN topped t ON t.ticker = s.ticker AND t.period = s.period AND t.pos = s.pos
  LEFT JOIN fading fa ON fa.ticker = s.ticker AND fa.period = s.period AND fa.pos = s.pos
),
spoken AS (
  SELECT *,
    CASE WHEN "EMA13" - "EMA26" > 0 AND e13 - e26 < 0 THEN 'Long' WHEN "EMA13" - "EMA26" < 0 AND e13 - e26 > 0 THEN 'Short' END AS "EMA_bullbear",
    "EMA13" - e13 AS "EMA13_slope",
    CASE WHEN "EMA13" - e13 > 0 THEN 'Up' WHEN "EMA13" - e13 < 0 THEN 'Down' END AS "EMA13_trend",
    "FI_13" - f13 AS "FI_13_diff",
    coalesce("FI_13" > 0 AND "FI_13" > f13 AND (f13 = 0 OR abs(("FI_13" - f13) / f13) * 100 >= 70), false) AS "FI_13_Peak",
    coalesce("FI_13" < 0 AND "FI_13" < f13 AND (f13 = 0 OR abs(("FI_13" - f13) / f13) * 100 >= 70), false) AS "FI_13_Trough",
    CASE WHEN from1 IS NOT NULL THEN CASE WHEN "Higher_Peak" THEN 'Down' ELSE 'Up' END END AS "MACD_hist_trend",
    CASE WHEN from2 IS NOT NULL THEN CASE WHEN "Higher_Peak" THEN 'Down' ELSE 'Up' END END AS "FI_13_trend",
    from1 || '_' || pos AS "MACD_hist_trend_pair", from2 || '_' || pos AS "FI_13_trend_pair",
    CASE WHEN p1 IS NOT NULL AND "Higher_Peak" THEN 'Down' END AS "Bull_Power_trend",
    CASE WHEN p1 IS NOT NULL AND "Lower_Trough" THEN 'Up' END AS "Bear_Power_trend",
    CASE WHEN "Higher_Peak" THEN p1 || '_' || p2 END AS "Bull_Power_trend_pair",
    CASE WHEN "Lower_Trough" THEN p1 || '_' || p2 END AS "Bear_Power_trend_pair"
  FROM flagged
),
signals AS MATERIALIZED (
  SELECT *,
    CASE WHEN "MACD_hist_trend" = 'Up' AND "FI_13_trend" = 'Up' THEN 'Long'
         WHEN "MACD_hist_trend" = 'Down' AND "FI_13_trend" = 'Down' THEN 'Short' END AS "Side_1",
    CASE WHEN "EMA13_trend" = 'Up' AND "FI_2_Trough" THEN 'Long'
         WHEN "EMA13_trend" = 'Down' AND "FI_2_Peak" THEN 'Short' END AS "Side_2",
    CASE WHEN "Bear_Power_trend" = 'Up' THEN 'Long' WHEN "Bull_Power_trend" = 'Down' THEN 'Short' END AS "Side_3"
  FROM spoken
)"""
)


def signal_sql(columns: tuple[str, ...], digits: int = 4) -> str:
    def shape(c: str) -> str:
        if c in ("EMA13_slope", "FI_13_diff"):
            return f'round("{c}", {digits}) + 0.0 AS "{c}"'
        return f'CAST("{c}" AS DOUBLE) AS "{c}"' if c == "price_search" else f'"{c}"'

    shown = ", ".join(shape(c) for c in columns)
    return f'WITH RECURSIVE {SIGNALS}\nSELECT ticker, period, "Date", {shown} FROM signals'


# --- as-of ------------------------------------------------------------------------------
TOY = (
    SERIES
    + """,
sides AS (
  SELECT ticker, period, label AS "Date",
    CASE WHEN "Close" > "Open" THEN 'Long' WHEN "Close" < "Open" THEN 'Short' END AS "Side_1",
    CASE WHEN "Close" > "Open" * 1.25 THEN 'Long' WHEN "Close" < "Open" * 0.75 THEN 'Short' END AS "Side_2",
    CASE WHEN "High" > 2 * "Low" THEN 'Long' WHEN "Low" = "Close" THEN 'Short' END AS "Side_3"
  FROM series
)"""
)
REAL = SIGNALS + ', sides AS (SELECT ticker, period, "Date", "Side_1", "Side_2", "Side_3" FROM signals)'
_DAY_SLICE = """
last_day_seen AS (SELECT CAST(max(l_shipdate) AS DATE) AS as_of FROM lineitem),
d AS (SELECT sides.* FROM sides, last_day_seen WHERE period = 'D' AND "Date" >= as_of - INTERVAL 24 MONTH)"""


# Look-ahead days and column suffix of each slower period, written out here so
# that a change in the library shows.
_SLOW = {"W": (8, "W"), "2W": (15, "2W"), "3W": (22, "3W"), "ME": (32, "ME"), "2ME": (63, "2M"), "3ME": (93, "3M")}
_SHIFTED = f"""
usable AS (
  SELECT ticker, period, "Date" AS bar_day, "Side_1" AS s1, "Side_2" AS s2, "Side_3" AS s3,
         "Date" - CASE period {" ".join(f"WHEN '{c}' THEN {days}" for c, (days, _) in _SLOW.items())} END AS usable_from
  FROM sides WHERE period <> 'D'
)"""


def _asof(code: str) -> str:
    name = f"p_{code.lower()}"
    return f"""
ASOF LEFT JOIN (SELECT * FROM usable WHERE period = '{code}') {name}
  ON d.ticker = {name}.ticker AND d."Date" >= {name}.usable_from"""


def asof_sql(code: str) -> str:
    _, suffix = _SLOW[code]
    name = f"p_{code.lower()}"
    sides = ", ".join(f'{name}.s{i} AS "Side_{i}_{suffix}"' for i in (1, 2, 3))
    return f"""WITH {TOY}, {_DAY_SLICE}, {_SHIFTED}
SELECT d.ticker, d."Date" AS "Date_D", {name}.bar_day AS "Date_{suffix}", {sides}
FROM d {_asof(code)}"""


def conclusion_body(sides_ctes: str, recursive: bool = False) -> str:
    shown = ['d.ticker', 'd."Date" AS "Date_D"']
    shown += [f'p_{c.lower()}.bar_day AS "Date_{suffix}"' for c, (_, suffix) in _SLOW.items()]
    for i in (1, 2, 3):
        shown.append(f'd."Side_{i}" AS "Side_{i}_D"')
        shown += [f'p_{c.lower()}.s{i} AS "Side_{i}_{suffix}"' for c, (_, suffix) in _SLOW.items()]
    return f"""WITH {"RECURSIVE " if recursive else ""}{sides_ctes}, {_DAY_SLICE}, {_SHIFTED},
last_days AS (SELECT ticker, max("Date") AS last_day FROM d GROUP BY ticker),
conclusion AS (
  SELECT {", ".join(shown)}
  FROM d {"".join(map(_asof, _SLOW))}
  JOIN last_days ON d.ticker = last_days.ticker AND d."Date" < last_days.last_day
)"""


# --- fundamentals -----------------------------------------------------------------------
def _measure(name: str) -> str:
    parts = []
    for t in range(4):
        for b, (m, v) in enumerate(BREAKS[t], start=1):
            if m == name:
                parts.append(f"WHEN t = {t} AND slot = {b} THEN {_num(v)}")
        if MISSING[t] == name:
            parts.append(f"WHEN t = {t} AND slot = 13 THEN NULL")
        parts.append(f"WHEN t = {t} THEN {_num(PROFILE[name][t])}")
    return f"CASE {' '.join(parts)} END AS {name}"


def fundamentals_cte(day: str = "2001-06-01", name: str = "fundamentals") -> str:
    listed = " ".join(f"WHEN c_custkey = {i} THEN '{x}'" for i, x in enumerate(LISTED))
    return f"""
{name} AS (
  SELECT DATE '{day}' AS created_at, CASE {listed} ELSE printf('C%06d', c_custkey) END AS ticker,
         {", ".join(_measure(m) for m in PROFILE)},
         CASE WHEN c_custkey % 13 = 0 THEN 'none' WHEN c_custkey % 17 = 0 THEN 'None' ELSE 'buy' END AS analyst_rating_key,
         c_custkey
  FROM (SELECT *, CASE WHEN c_custkey >= {len(LISTED)} THEN c_custkey % 4 END AS t, (c_custkey // 4) % 14 AS slot FROM customer)
)"""


_WORDS = {
    "trailing_pe": "WHEN c_custkey % 11 = 3 THEN 'Infinity' WHEN c_custkey % 11 = 10 THEN '-Infinity'",
    "forward_pe": "WHEN c_custkey % 11 = 5 THEN 'None'",
    "eps_growth": "WHEN c_custkey % 11 = 7 THEN 'none'",
    "revenue_growth": "WHEN c_custkey % 11 = 9 THEN 'n/a'",
}
_AS_TEXT = ", ".join(
    f"CASE {_WORDS[m]} ELSE CAST({m} AS VARCHAR) END AS {m}" if m in _WORDS else f"CAST({m} AS VARCHAR) AS {m}"
    for m in PROFILE
)
_CUT3 = ", ".join(
    f"trunc(CASE WHEN abs(TRY_CAST({m} AS DOUBLE)) < CAST('inf' AS DOUBLE) THEN TRY_CAST({m} AS DOUBLE) END * 1000) / 1000 AS {m}"
    for m in PROFILE
)
NORMALISED = (
    fundamentals_cte()
    + f""",
arriving AS (SELECT created_at, ticker, {_AS_TEXT}, analyst_rating_key FROM fundamentals),
normal AS (
  SELECT created_at, ticker, {_CUT3},
         CASE WHEN analyst_rating_key NOT IN ('None', 'none') THEN analyst_rating_key END AS analyst_rating_key
  FROM arriving
)"""
)


# The screen's labels, thresholds and tickers, written out here so that a change in
# the library shows.
_SCREEN = """CASE
  WHEN market_cap >= 1000000000 AND price_to_sales BETWEEN 2 AND 10 AND roe > 0.05 AND roe <= 0.25
    AND current_ratio >= 2.5 AND debt_to_equity <= 10 AND roa_ttm > 0 AND eps_ttm > 0 AND operating_cash_flow > 0
    AND institutional_pct >= 0.4 AND institutional_pct < 0.95 AND analyst_rating_mean <= 3 THEN 'HighGrowth'
  WHEN market_cap >= 400000000 AND price_to_sales BETWEEN 2 AND 7 AND roe > 0.15 AND roe <= 0.25
    AND current_ratio >= 2 AND debt_to_equity <= 10 AND roa_ttm > 0 AND eps_ttm > 0 AND operating_cash_flow > 0
    AND current_price >= 15 AND annual_revenue >= 50000000
    AND institutional_pct >= 0.4 AND institutional_pct < 0.95 AND analyst_rating_mean <= 2 THEN 'SteadyGrowth'
  WHEN price_to_sales <= 1.5 AND roe > 0.15 AND roe <= 0.25 AND current_ratio >= 1.1 AND debt_to_equity <= 50
    AND roa_ttm > 0 AND eps_ttm > 0 AND current_price > 0 AND annual_revenue >= 50000000 AND avg_daily_volume_3m >= 50000
    AND institutional_pct >= 0.4 AND institutional_pct < 0.95 AND analyst_rating_mean >= 3 THEN 'Distressed'
  WHEN change_52w >= 3 AND high_52w_ratio >= 0.9 AND current_price >= 15 AND avg_daily_volume_3m >= 50000
    AND institutional_pct >= 0.4 AND institutional_pct < 0.95 AND analyst_rating_mean <= 2
    AND analyst_rating_key IS NOT NULL THEN 'Super'
  WHEN ticker IN ('AAPL', 'MSFT', 'GOOGL', 'AMZN', 'NVDA', 'META', 'TSLA', 'NFLX') THEN 'Magnificent_8'
  WHEN ticker IN ('QQQ', 'SPY', 'DIA') THEN 'ETF_1'
END"""

SCREENED = (
    NORMALISED
    + f""",
labelled AS (SELECT created_at, ticker, {_SCREEN} AS is_selected FROM normal),
screened AS (SELECT * FROM labelled WHERE is_selected IS NOT NULL)"""
)
