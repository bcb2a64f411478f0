"""Periods, indicator parameters and signal parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Period:
    """One calendar period: ``n`` units per bar and the as-of look-ahead in days."""

    code: str
    unit: str  # "day", "week" or "month"
    n: int
    tolerance_days: int = 0
    suffix: str = ""  # column suffix in the entry conclusion

    def __post_init__(self) -> None:
        if self.unit not in ("day", "week", "month"):
            raise ValueError(f"unknown period unit {self.unit!r}")


# Period codes, look-ahead days and output suffixes.
PERIODS: tuple[Period, ...] = (
    Period("D", "day", 1, 0, "D"),
    Period("W", "week", 1, 8, "W"),
    Period("2W", "week", 2, 15, "2W"),
    Period("3W", "week", 3, 22, "3W"),
    Period("ME", "month", 1, 32, "ME"),
    Period("2ME", "month", 2, 63, "2M"),
    Period("3ME", "month", 3, 93, "3M"),
)


def period(code: str) -> Period:
    for p in PERIODS:
        if p.code == code:
            return p
    raise ValueError(f"Unsupported period: {code}")


@dataclass(frozen=True)
class Band:
    """Bollinger-style band; ``average`` is "ema" or "sma"."""

    n: int
    up: float
    down: float
    average: str = "ema"


@dataclass(frozen=True)
class IndicatorSpec:
    """Which indicators to compute, and with what lengths. ``None`` / ``()`` turns one off."""

    adx: int | None = 14
    macd: tuple[int, int, int] | None = (12, 26, 9)
    di: int | None = 13
    stoch: tuple[int, int, int] | None = (5, 3, 3)
    willr: int | None = 7
    bands: Band | None = Band(13, 2.7, 2.7)
    inner_bands: Band | None = Band(13, 1.7, 1.7)
    ema: tuple[int, ...] = (13, 26)
    sma: tuple[int, ...] = (50, 200)
    atr: int | None = 14
    force: tuple[int, ...] | None = (2, 13)
    power: int | None = 13

    @classmethod
    def none(cls) -> IndicatorSpec:
        return cls(None, None, None, None, None, None, None, (), (), None, None, None)

    @classmethod
    def from_mapping(cls, params: Mapping[str, Mapping] | None) -> IndicatorSpec:
        """Build a spec from the keyed-dict form; an indicator runs only when its key is there.

        Lengths left out of an inner dict take the fallback of that form, which is
        not always the default above (14 for DI, WILLR and the fast stochastic).
        """
        params = params or {}

        def one(key: str, fallback: int) -> int | None:
            return params[key].get("timeperiod", fallback) if key in params else None

        def band(key: str, width: float) -> Band | None:
            if key not in params:
                return None
            p = params[key]
            averages = {0: "sma", 1: "ema"}
            return Band(
                p.get("timeperiod", 13),
                p.get("nbdevup", width),
                p.get("nbdevdn", width),
                averages[p.get("matype", 1)],
            )

        macd = stoch = None
        if "MACD" in params:
            p = params["MACD"]
            macd = (p.get("fastperiod", 12), p.get("slowperiod", 26), p.get("signalperiod", 9))
        if "STOCH" in params:
            p = params["STOCH"]
            if p.get("slowk_matype", 0) or p.get("slowd_matype", 0):
                raise ValueError("only simple averages are supported in the stochastic")
            stoch = (p.get("fastk_period", 14), p.get("slowk_period", 3), p.get("slowd_period", 3))
        return cls(
            adx=one("ADX", 14),
            macd=macd,
            di=one("DI", 14),
            stoch=stoch,
            willr=one("WILLR", 14),
            bands=band("BBANDS", 2.7),
            inner_bands=band("SD_17", 1.7),
            ema=tuple(params["EMA"].get("ema_period", (13, 26))) if "EMA" in params else (),
            sma=tuple(params["SMA"].get("sma_period", (50, 200))) if "SMA" in params else (),
            atr=one("ATR", 14),
            force=tuple(params["FI"].get("ema_period", (2, 13))) if "FI" in params else None,
            power=params["Bull_Bear_Power"].get("ema_period", 13)
            if "Bull_Bear_Power" in params
            else None,
        )


@dataclass(frozen=True)
class SignalSpec:
    """Parameters of the signal columns."""

    ema_short: int = 13
    ema_long: int = 26
    price: str = "Close"
    price_gap: int = 5
    price_prominence: float = 1.0
    force_gap: int = 5
    force_prominence: float = 5.0
    lookback: int = 2  # preceding extrema each extremum is compared with
    # (indicator, least relative change in percent) of the first divergence
    divergence_1: tuple[tuple[str, float], ...] = (("MACD_hist", 30.0), ("FI_13", 70.0))
    trend_column: str = "EMA13"
    force_column: str = "FI_2"
    bull_column: str = "Bull_Power"
    bear_column: str = "Bear_Power"
    sides: tuple[str, str, str] = ("Side_1", "Side_2", "Side_3")

    @classmethod
    def from_mapping(cls, params: Mapping[str, object] | None) -> SignalSpec:
        """Build a spec from the keyed-dict form; what is left out keeps its default, other keys are refused."""
        params, made = dict(params or {}), {}
        for key, name in _SIGNAL_KEYS.items():
            if key in params:
                made[name] = params.pop(key)
        pair, least = params.pop("indicator_pair_1", None), params.pop("pair_1_threshold", None)
        if pair is not None or least is not None:
            names, levels = zip(*cls.divergence_1, strict=True)
            made["divergence_1"] = tuple(zip(pair or names, map(float, least or levels), strict=True))
        if "indicator_pair_2" in params:
            made["trend_column"], made["force_column"] = params.pop("indicator_pair_2")
        if "indicator_pair_3" in params:
            made["bull_column"], made["bear_column"] = params.pop("indicator_pair_3")
        sides = [params.pop(f"side_pair_{i}", name) for i, name in enumerate(cls.sides, 1)]
        if params:
            raise ValueError(f"unknown signal parameters: {sorted(params)}")
        return cls(**made, sides=tuple(sides))


# fixed values: keys of the keyed-dict form, and the fields that they set
_SIGNAL_KEYS = {
    "ema_short": "ema_short",
    "ema_long": "ema_long",
    "input_price_1": "price",
    "extrema_price_gap": "price_gap",
    "extrema_FI_2_gap": "force_gap",
    "extrema_price_prominence": "price_prominence",
    "extrema_FI_2_prominence": "force_prominence",
    "search_quantity": "lookback",
}


DEFAULT_INDICATORS = IndicatorSpec()
DEFAULT_SIGNALS = SignalSpec()


@dataclass(frozen=True)
class PeriodConfig:
    """Indicator and signal parameters of one period."""

    indicators: IndicatorSpec = field(default_factory=IndicatorSpec)
    signals: SignalSpec = field(default_factory=SignalSpec)

    @classmethod
    def from_mapping(cls, indicators: Mapping[str, Mapping] | None = None, signals: Mapping[str, object] | None = None) -> PeriodConfig:
        """From the keyed-dict forms of both; without indicators the defaults run."""
        chosen = IndicatorSpec() if indicators is None else IndicatorSpec.from_mapping(indicators)
        return cls(chosen, SignalSpec.from_mapping(signals))
