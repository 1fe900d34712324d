"""Technical indicators as layers of window expressions.

An indicator is a few named steps. A step says which columns it needs and how many bars its own
frame looks back; the planner below it only sorts steps into layers (a window cannot feed a window of
the same projection) and adds up the reach. All windows of all layers share one partitioning and one
sort order, so a set of indicators costs one exchange and one sort however many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.scalar import ratio
from barloom.operators import recurrence
from barloom.operators.blocks import BLOCK, BLOCK_BARS, INDEX, KEYS, block_of, is_own, spread, totals_before, with_bar_index
from barloom.session import stage


class Rows:
    """Frames over the rows of a block. ``chunks`` are the chunk lengths in use, longest first."""

    def __init__(self, chunks: Iterable[int] = ()):
        self.chunks = sorted(set(chunks), reverse=True)
        self._specs: dict = {}

    @staticmethod
    def chunk_column(size: int) -> str:
        return f"_chunk_{size}"

    def _window(self, inside: int | None = None, frame: tuple[int, int] | None = None):
        if (inside, frame) not in self._specs:
            if frame is not None:
                spec = self._window(inside).rowsBetween(*frame)
            else:
                names = [self.chunk_column(size) for size in self.chunks]
                cut = 0 if inside is None else self.chunks.index(inside) + 1
                spec = Window.partitionBy(*KEYS, BLOCK, *names[:cut]).orderBy(*names[cut:], INDEX)
            self._specs[inside, frame] = spec
        return self._specs[inside, frame]

    def lag(self, name: str, bars: int = 1) -> Column:
        return F.lag(name, bars).over(self._window())

    def lead(self, name: str, bars: int = 1) -> Column:
        return F.lead(name, bars).over(self._window())

    def rolling(self, function: Callable[[str], Column], name: str, bars: int) -> Column:
        """Aggregate of the last ``bars`` rows, null unless each of them has a value."""
        frame = self._window(frame=(-(bars - 1), 0))
        return F.when(F.count(name).over(frame) == bars, function(name).over(frame))

    def preceding(self, expression: Column, bars: int) -> Column:
        return expression.over(self._window(frame=(-bars, -1)))

    def running(self, expression: Column, inside: int | None = None) -> Column:
        return expression.over(self._window(inside, (Window.unboundedPreceding, 0)))

    def earlier(self, expression: Column) -> Column:
        return expression.over(self._window(frame=(Window.unboundedPreceding, -1)))


@dataclass(frozen=True)
class Step:
    name: str
    build: Callable[[Rows], Column] = field(compare=False)
    needs: tuple[str, ...] = ()
    reach: int = 0
    chunk: int | None = None
    ahead: int = 0
    gaps: bool = False  # may be null past its warm-up, whatever it needs


# --- building blocks ---------------------------------------------------------------------------


def _row(name: str, needs: tuple[str, ...], build: Callable[[], Column], gaps: bool = False) -> Step:
    return Step(name, lambda rows: build(), needs, gaps=gaps)


def _rolling(name: str, function, source: str, bars: int) -> Step:
    return Step(name, lambda rows: rows.rolling(function, source, bars), (source,), bars - 1)


def _lag(name: str, source: str, bars: int) -> Step:
    return Step(name, lambda rows: rows.lag(source, bars), (source,), bars)


def _extreme(name: str, sign: str, source: str, bars: int) -> list[Step]:
    """Lowest or highest of the last bars. A long even window is two windows of half its length."""
    function, both = {"min": (F.min, F.least), "max": (F.max, F.greatest)}[sign]
    half = bars // 2
    if bars < 32 or bars % 2:
        return [_rolling(name, function, source, bars)]
    part = f"_{'lowest' if sign == 'min' else 'highest'}_{half}"
    whole = Step(
        name,
        lambda rows: F.when(F.col(part).isNotNull() & rows.lag(part, half).isNotNull(), both(F.col(part), rows.lag(part, half))),
        (part,),
        half,
    )
    return [*_extreme(part, sign, source, half), whole]


def lookback(source: str, bars: int, name: str) -> list[Step]:
    """The ``bars`` values before a row, oldest first."""
    return [Step(name, lambda rows: rows.preceding(F.collect_list(source), bars), (source,), bars)]


def next_value(source: str, name: str) -> list[Step]:
    return [Step(name, lambda rows: rows.lead(source), (source,), ahead=1)]


def ema(source: str, span: int, name: str) -> list[Step]:
    """Recursive exponential average: the first value as it is, then weight 2/(span+1).

    A missing value keeps the average. The value after g missing ones weighs what it would have after a
    decay of g + 1 bars, normalised again, which is what ``ewm(adjust=False)`` of pandas does.
    """
    if span <= 1:
        return [Step(name, lambda rows: rows.running(F.last(source, ignorenulls=True)), (source,), 1)]
    size = recurrence.chunk_bars(span)
    at, gap = f"_at_{source}", f"_gap_{source}"
    fade, term, faded, total, carry = (f"_{name}_{part}" for part in ("fade", "term", "faded", "sum", "carry"))
    count, there = f"_rows_{size}", F.col(source).isNotNull()
    return [
        Step(at, lambda rows: rows.running(F.last(F.when(there, F.col(INDEX)), ignorenulls=True)), (source,)),
        Step(gap, lambda rows: F.when(there, F.col(INDEX) - rows.lag(at)), (source, at), 1),
        _row(fade, (source, gap), lambda: F.when(there, recurrence.log_fade(span, F.col(gap)))),
        _row(term, (source, gap), lambda: F.col(source) * recurrence.new_share(span, F.col(gap))),
        Step(faded, lambda rows: rows.running(F.sum(fade), inside=size), (fade,), 0, size),
        Step(
            total,
            lambda rows: F.exp(faded) * rows.running(F.sum(F.col(term) * F.exp(-F.col(faded))), inside=size),
            (term, faded),
            recurrence.reach_bars(span),
            size,
        ),
        Step(count, lambda rows: rows.running(F.count(F.lit(1)), inside=size), (), 0, size),
        Step(
            carry,
            lambda rows: rows.earlier(F.last(recurrence.closing(size, total, faded, count), ignorenulls=True)),
            (total, faded, count),
            0,
            size,
        ),
        _row(
            name,
            (total, carry, faded),
            lambda: F.when(
                F.col(total).isNotNull(), F.col(total) + F.exp(faded) * F.coalesce(carry, F.lit(0.0))
            ).otherwise(F.col(carry)),
        ),
    ]


def weighted_average(source: str, span: int, name: str) -> list[Step]:
    """Exponentially weighted mean over the whole history, null until ``span`` values are there.

    Missing values have no weight; the weights of the others go by their distance in bars.
    """
    if span <= 1:
        return [Step(name, lambda rows: rows.running(F.last(source, ignorenulls=True)), (source,), 1)]
    size = recurrence.chunk_bars(span)
    there, seen = f"_there_{source}", f"_seen_{source}"
    return [
        _row(there, (source,), lambda: F.when(F.col(source).isNotNull(), F.lit(1.0))),
        Step(seen, lambda rows: rows.running(F.count(source)), (source,)),
        *_scan(source, span, f"{name}_values", size),
        *_scan(there, span, f"{name}_weights", size),
        _row(
            name,
            (f"_{name}_values", f"_{name}_weights", seen),
            lambda: F.when(F.col(seen) >= span, F.col(f"_{name}_values") / F.col(f"_{name}_weights")),
        ),
    ]


def _scan(source: str, span: int, name: str, size: int) -> list[Step]:
    """``_name``: sum of the values so far, each faded by its distance in bars."""
    place = recurrence.offset_in_chunk(size)

    def chunk_sum(rows: Rows) -> Column:
        return recurrence.weight(span, place) * rows.running(F.sum(F.col(source) * recurrence.weight(span, -place)), inside=size)

    def carry(rows: Rows) -> Column:
        return rows.earlier(F.last(F.when(place == size - 1, F.coalesce(f"_{name}_sum", F.lit(0.0))), ignorenulls=True))

    def whole() -> Column:
        carried = F.coalesce(F.col(f"_{name}_carry"), F.lit(0.0))
        return F.coalesce(F.col(f"_{name}_sum"), F.lit(0.0)) + recurrence.weight(span, place + 1) * carried

    return [
        Step(f"_{name}_sum", chunk_sum, (source,), recurrence.reach_bars(span), size),
        Step(f"_{name}_carry", carry, (f"_{name}_sum",), 0, size),
        _row(f"_{name}", (f"_{name}_sum", f"_{name}_carry"), whole),
    ]


def true_range() -> list[Step]:
    def widest() -> Column:
        high, low, before = F.col("high"), F.col("low"), F.col("_close_before")
        return F.greatest(high - low, F.abs(high - before), F.abs(low - before))

    return [_lag("_close_before", "close", 1), _row("tr", ("high", "low", "_close_before"), widest)]


def sma(source: str, bars: int, name: str) -> list[Step]:
    return [_rolling(name, F.avg, source, bars)]


def deviation(source: str, bars: int, name: str) -> list[Step]:
    return [_rolling(name, F.stddev_samp, source, bars)]


def atr(bars: int, name: str) -> list[Step]:
    return [*true_range(), _rolling(name, F.avg, "tr", bars)]


def bollinger(source: str, bars: int, middle: str, spread_name: str, upper: str, lower: str, width: float = 2.0) -> list[Step]:
    return [
        *sma(source, bars, middle),
        *deviation(source, bars, spread_name),
        _row(upper, (middle, spread_name), lambda: F.col(middle) + F.col(spread_name) * width),
        _row(lower, (middle, spread_name), lambda: F.col(middle) - F.col(spread_name) * width),
    ]


def rsi(source: str, bars: int, name: str) -> list[Step]:
    """Relative strength from plain means of gains and losses; the first bar counts as no change."""
    before, up, down = f"_{source}_before", f"_{source}_gain", f"_{source}_loss"
    mean_up, mean_down = f"_{name}_gain", f"_{name}_loss"

    def part(sign: int) -> Column:
        change = (F.col(source) - F.col(before)) * sign
        return F.when(change > 0, change).otherwise(0.0)

    def index() -> Column:
        gain, loss = F.col(mean_up), F.col(mean_down)
        return F.when(loss > 0, 100.0 - 100.0 / (1.0 + ratio(gain, loss))).when(gain > 0, F.lit(100.0))

    return [
        _lag(before, source, 1),
        _row(up, (source, before), lambda: part(1)),
        _row(down, (source, before), lambda: part(-1)),
        _rolling(mean_up, F.avg, up, bars),
        _rolling(mean_down, F.avg, down, bars),
        _row(name, (mean_up, mean_down), index, gaps=True),
    ]


def stochastic(bars: int, k_name: str, d_name: str) -> list[Step]:
    lowest, highest = f"_lowest_{bars}", f"_highest_{bars}"
    return [
        *_extreme(lowest, "min", "low", bars),
        *_extreme(highest, "max", "high", bars),
        _row(k_name, ("close", lowest, highest), lambda: ratio(F.col("close") - F.col(lowest), F.col(highest) - F.col(lowest)) * 100.0, gaps=True),
        _rolling(d_name, F.avg, k_name, 3),
    ]


def momentum(bars: int, name: str) -> list[Step]:
    return [Step(name, lambda rows: F.col("close") - rows.lag("close", bars), ("close",), bars)]


def rate_of_change(bars: int, name: str, scale: float = 1.0) -> list[Step]:
    return [Step(name, lambda rows: (ratio(F.col("close"), rows.lag("close", bars)) - 1.0) * scale, ("close",), bars, gaps=True)]


def adx(bars: int, name: str) -> list[Step]:
    """Directional index from plain means; both directional moves may be positive on one bar."""

    def rise(column: Column) -> Column:
        return F.when(column > 0, column).otherwise(0.0)

    def directional(move: str) -> Column:
        return 100.0 * ratio(F.col(move), F.col(f"_tr_{bars}"))

    def imbalance() -> Column:
        return 100.0 * ratio(F.abs(F.col("plus_di") - F.col("minus_di")), F.col("plus_di") + F.col("minus_di"))

    return [
        *true_range(),
        Step("plus_dm", lambda rows: rise(F.col("high") - rows.lag("high")), ("high",), 1),
        Step("minus_dm", lambda rows: rise(rows.lag("low") - F.col("low")), ("low",), 1),
        _rolling(f"_tr_{bars}", F.avg, "tr", bars),
        _rolling(f"_plus_{bars}", F.avg, "plus_dm", bars),
        _rolling(f"_minus_{bars}", F.avg, "minus_dm", bars),
        _row("plus_di", (f"_plus_{bars}", f"_tr_{bars}"), lambda: directional(f"_plus_{bars}"), gaps=True),
        _row("minus_di", (f"_minus_{bars}", f"_tr_{bars}"), lambda: directional(f"_minus_{bars}"), gaps=True),
        _row("dx", ("plus_di", "minus_di"), imbalance, gaps=True),
        _rolling(name, F.avg, "dx", bars),
    ]


def mid_range(bars: int, name: str) -> list[Step]:
    lowest, highest = f"_lowest_{bars}", f"_highest_{bars}"
    return [
        *_extreme(lowest, "min", "low", bars),
        *_extreme(highest, "max", "high", bars),
        _row(name, (lowest, highest), lambda: (F.col(highest) + F.col(lowest)) / 2.0),
    ]


def senkou_a(name: str, tenkan: str, kijun: str, shift: int = 26) -> list[Step]:
    middle = "_senkou_a_now"
    return [
        _row(middle, (tenkan, kijun), lambda: (F.col(tenkan) + F.col(kijun)) / 2.0),
        _lag(name, middle, shift),
    ]


def senkou_b(name: str, bars: int = 52, shift: int = 26) -> list[Step]:
    return [*mid_range(bars, "_senkou_b_now"), _lag(name, "_senkou_b_now", shift)]


def macd(fast: str, slow: str, spans: tuple[int, int, int] = (12, 26, 9)) -> list[Step]:
    return [
        *ema("close", spans[0], fast),
        *ema("close", spans[1], slow),
        _row("macd", (fast, slow), lambda: F.col(fast) - F.col(slow)),
        *ema("macd", spans[2], "macd_signal"),
    ]


def windowed_macd(spans: tuple[int, int, int] = (12, 26, 9)) -> list[Step]:
    """MACD from whole-history weighted means; its signal starts at the first MACD value."""
    fast, slow, signal = spans
    return [
        *weighted_average("close", fast, "_fast_mean"),
        *weighted_average("close", slow, "_slow_mean"),
        _row("macd", ("_fast_mean", "_slow_mean"), lambda: F.col("_fast_mean") - F.col("_slow_mean")),
        *weighted_average("macd", signal, "macd_signal"),
    ]


# Running totals that reach back to the first bar: name -> (term, name of the total of earlier blocks).
_TRADED = "_traded_before"
_VOLUME = "_volume_before"


def _traded() -> Column:
    return F.col("volume") * (F.col("high") + F.col("low") + F.col("close")) / 3.0


def vwap(name: str = "vwap") -> list[Step]:
    """Volume-weighted average price since the first bar read; null on a bar without a price or volume."""

    def own_running(rows: Rows, term: Column, before: str) -> Column:
        return F.col(before) + rows.running(F.sum(F.when(F.col("_own"), term).otherwise(0.0)))

    return [
        Step(
            name,
            lambda rows: F.when(
                _traded().isNotNull(), ratio(own_running(rows, _traded(), _TRADED), own_running(rows, F.col("volume"), _VOLUME))
            ),
            ("high", "low", "close", "volume", _TRADED, _VOLUME),
            gaps=True,
        )
    ]


# --- planning ----------------------------------------------------------------------------------


def layers_of(steps: Iterable[Step], given: Iterable[str]) -> tuple[list[list[Step]], int, int]:
    """Steps grouped so that each group only needs earlier groups; total reach and look-ahead."""
    by_name: dict[str, Step] = {}
    for step in steps:
        by_name.setdefault(step.name, step)
    present = set(given)
    measured: dict[str, tuple[int, int, int]] = {}

    def measure(name: str) -> tuple[int, int, int]:
        if name not in by_name:
            if name not in present:
                raise ValueError(f"no column and no indicator named {name!r}")
            return 0, 0, 0
        if name not in measured:
            step = by_name[name]
            below = [measure(need) for need in step.needs]
            measured[name] = (
                1 + max((depth for depth, _, _ in below), default=0),
                step.reach + max((reach for _, reach, _ in below), default=0),
                step.ahead + max((ahead for _, _, ahead in below), default=0),
            )
        return measured[name]

    groups: dict[int, list[Step]] = {}
    for step in by_name.values():
        groups.setdefault(measure(step.name)[0], []).append(step)
    reach = max((r for _, r, _ in measured.values()), default=0)
    ahead = max((a for _, _, a in measured.values()), default=0)
    return [groups[depth] for depth in sorted(groups)], reach, ahead


def apply_steps(
    bars: DataFrame,
    steps: Iterable[Step],
    keep: Iterable[str],
    block_bars: int = BLOCK_BARS,
) -> DataFrame:
    """Compute steps over every series at once and keep the named ones.

    The result carries ``bar_index`` and ``bar_block`` and stays partitioned by (series, block).
    """
    steps = list(steps)
    indexed = with_bar_index(bars, block_bars)
    carried = [_TRADED, _VOLUME]
    if any(need in carried for step in steps for need in step.needs) and INDEX not in bars.columns:
        indexed = stage(indexed, "indexed")  # read by the rows and by the totals of their blocks
    layers, reach, ahead = layers_of(steps, [*indexed.columns, *carried])
    work = spread(indexed, reach, ahead, block_bars)
    if any(need in carried for step in steps for need in step.needs):
        work = _with_totals(work, indexed, block_bars)
    # Windows inside chunks of a block would otherwise ask for a finer partitioning first, which the others can't use.
    work = work.repartition(*KEYS, BLOCK)
    rows = Rows(step.chunk for step in steps if step.chunk)
    if rows.chunks:
        work = work.withColumns({rows.chunk_column(s): block_of(F.col(INDEX), s) for s in rows.chunks})
    for layer in layers:
        work = work.withColumns({step.name: step.build(rows) for step in layer})
    work = work.where(is_own(block_bars))
    names = list(dict.fromkeys([*indexed.columns, BLOCK, *keep]))
    return work.select(*names)


def _with_totals(work: DataFrame, indexed: DataFrame, block_bars: int) -> DataFrame:
    work = work.withColumn("_own", is_own(block_bars))
    blocks = indexed.withColumn(BLOCK, block_of(F.col(INDEX), block_bars))
    before = totals_before(blocks, KEYS, BLOCK, {_TRADED: F.sum(_traded()), _VOLUME: F.sum("volume")})
    # A copy beyond the last block has no totals; it is dropped with the other copies.
    return work.join(before, [*KEYS, BLOCK], "left")


def open_columns(steps: Iterable[Step], columns: Iterable[str], bars: DataFrame, block_bars: int = BLOCK_BARS) -> list[str]:
    """Columns whose nulls may reach past the end of a block.

    Where no price of ``bars`` is missing, most columns are null only while they warm up. If that ends
    inside the first block, later blocks have nothing to fill and the first one fills itself.
    """
    columns = list(columns)
    prices = [c for c in ("high", "low", "close", "volume") if c in bars.columns]
    if not bars.where(F.concat(*[F.col(c).cast("string") for c in prices]).isNull()).select(F.lit(1)).isEmpty():
        return columns
    by_name = {}
    for step in steps:
        by_name.setdefault(step.name, step)

    def measure(name: str) -> tuple[bool, int]:
        if name not in by_name:
            return False, 0
        step = by_name[name]
        below = [measure(need) for need in step.needs]
        return step.gaps or any(g for g, _ in below), step.reach + max((r for _, r in below), default=0)

    found = {name: measure(name) for name in columns}
    return [name for name, (gaps, reach) in found.items() if gaps or reach >= block_bars]


def backfill(df: DataFrame, columns: Iterable[str], open_ended: Iterable[str] | None = None, block_bars: int = BLOCK_BARS) -> DataFrame:
    """Fill nulls with the next value in time; nulls after the last value stay.

    Inside a block this is one running ``last`` over descending time. After it, the first row of a
    block holds the first value of the block, so what a block cannot fill itself is read from the
    first rows of the later blocks: one row per block. Columns in ``open_ended`` (all, if not given)
    take that second step; the rows are written once in between, since both sides read them.
    """
    columns = list(columns)
    open_ended = columns if open_ended is None else [c for c in columns if c in set(open_ended)]
    downward = Window.partitionBy(*KEYS, BLOCK).orderBy(F.col(INDEX).desc()).rowsBetween(Window.unboundedPreceding, 0)
    inside = df.withColumns({name: F.last(name, ignorenulls=True).over(downward) for name in columns})
    if not open_ended:
        return inside
    inside = stage(inside, "filled")
    opening = inside.where((F.col(INDEX) % block_bars == 0) & (F.col(BLOCK) > 0))
    later = Window.partitionBy(*KEYS).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, 0)
    following = opening.select(
        *KEYS,
        (F.col(BLOCK) - 1).alias(BLOCK),
        *[F.last(name, ignorenulls=True).over(later).alias(f"_next_{name}") for name in open_ended],
    )
    return (
        inside.join(following, [*KEYS, BLOCK], "left")
        .withColumns({name: F.coalesce(name, f"_next_{name}") for name in open_ended})
        .drop(*[f"_next_{name}" for name in open_ended])
    )
