"""Derived daily columns: price limits, volume ratio, share counts, turnover, market value.

Every fill takes the stored daily_basic table and returns it with computed columns set on
the rows in scope. With ``touched`` (``"month"``, also for True, or ``"day"``: the unit by which the store is
partitioned) it reads and returns the partitions from ``begin`` to ``end`` alone, each with all its rows, of
codes out of scope too, so that a dynamic partition overwrite loses none. The computed value depends on the row itself plus attributes joined to
it, so each fill decorates the row in place instead of joining results back a second time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codes import NOT_TRADED_AS_SHARE, SHARE_BOARDS, in_boards, in_codes, in_exchanges, not_in_boards
from ..functions.dates import DateLike, as_date, between_days
from ..functions.numeric import round_at
from .joins import asof_join
from .merge import concat_sources, in_partitions, partition_unit
from .series import trailing_mean

UNLIMITED_UP, UNLIMITED_DOWN = 999999.99, 0.01
HALF_UP_GUARD, CENT_GUARD = 0.000001, 0.0001

# Event categories that state a share count.
SHARE_EVENT_CATEGORIES = (
    "股本变化", "转配股上市", "送配股上市", "非流通股上市", "增发新股上市", "可转债上市", "股份回购",
)
INITIAL_STATE_DAY = "1990-01-01"
SHARES_PER_WAN = 10000


@dataclass(frozen=True)
class LimitRegime:
    """Rates of a board from a day on, until the board's next regime.

    In order: no limits up to listing day ``free_days``; own rates on listing day one; the
    rate of specially treated (ST) securities; the board's rate. None means not applicable.
    """

    board: str
    since: str
    rate: float
    free_days: int | None = None
    day_one_up: float | None = None
    day_one_down: float | None = None
    special_rate: float | None = None


# Dated limit regimes per board, oldest first.
LIMIT_REGIMES = (
    LimitRegime("STAR", "0001-01-01", 0.2, free_days=5),
    LimitRegime("GEM", "0001-01-01", 0.1, day_one_up=0.44, day_one_down=0.36),
    LimitRegime("GEM", "2020-08-24", 0.2, free_days=5),
    LimitRegime("BJ", "0001-01-01", 0.3, day_one_up=0.0, day_one_down=0.0),
    LimitRegime("MAIN", "0001-01-01", 0.1, day_one_up=0.44, day_one_down=0.36, special_rate=0.05),
    LimitRegime("MAIN", "2023-04-10", 0.1, free_days=5, special_rate=0.05),
    LimitRegime("MAIN", "2026-07-06", 0.1, free_days=5),
)


def limit_regimes(spark: SparkSession) -> DataFrame:
    """The regimes as a table with half-open day ranges: one row each, a handful in all."""
    def text(value: object) -> str:
        return "NULL" if value is None else repr(value)

    lines = []
    for r in LIMIT_REGIMES:
        until = min((n.since for n in LIMIT_REGIMES if n.board == r.board and n.since > r.since), default="9999-12-31")
        lines.append(
            f"('{r.board}', DATE '{r.since}', DATE '{until}', CAST({r.rate} AS DOUBLE), CAST({text(r.free_days)} AS INT), "
            + ", ".join(f"CAST({text(v)} AS DOUBLE)" for v in (r.day_one_up, r.day_one_down, r.special_rate)) + ")"
        )
    return spark.sql(
        f"SELECT * FROM VALUES {', '.join(lines)} AS "
        "t(_board, _since, _until, _rate, _free_days, _day_one_up, _day_one_down, _special_rate)"
    )


def with_limit_rates(rows: DataFrame) -> DataFrame:
    """Add ``_up`` and ``_down`` rates to rows with _board, _list_date, trade_date and is_st.

    Every row meets exactly one regime of its board. Listing age counts calendar days.
    """
    regimes = F.broadcast(limit_regimes(rows.sparkSession).withColumnRenamed("_board", "_regime_board"))
    in_force = (
        (F.col("_board") == F.col("_regime_board"))
        & (F.col("trade_date") >= F.col("_since")) & (F.col("trade_date") < F.col("_until"))
    )
    age = F.datediff("trade_date", "_list_date") + 1

    def rate(day_one: str) -> Column:
        return (
            F.when(F.col("_age") <= F.col("_free_days"), F.lit(0.0))
            .when((F.col("_age") == 1) & F.col(day_one).isNotNull(), F.col(day_one))
            .when((F.col("is_st") == 1) & F.col("_special_rate").isNotNull(), F.col("_special_rate"))
            .otherwise(F.col("_rate"))
        )

    dated = rows.join(regimes, in_force, "left").withColumn("_age", age)
    return dated.withColumns({"_up": rate("_day_one_up"), "_down": rate("_day_one_down")})


def limit_prices(board: Column, up: Column, down: Column, pre_close: Column) -> tuple[Column, Column]:
    """(upper, lower) limit price. The Beijing board rounds inward to whole cents."""
    raised, lowered = pre_close * (1 + up), pre_close * (1 - down)
    free, inward = up == 0, board == "BJ"
    upper = (
        F.when(free, F.lit(UNLIMITED_UP))
        .when(inward, F.floor(raised * 100 + CENT_GUARD).cast("double") / 100)
        .otherwise(round_at(raised + HALF_UP_GUARD, 2))
    )
    lower = (
        F.when(free, F.lit(UNLIMITED_DOWN))
        .when(inward, F.ceil(lowered * 100 - CENT_GUARD).cast("double") / 100)
        .otherwise(round_at(lowered + HALF_UP_GUARD, 2))
    )
    return upper, lower


def at_limit(shown: Column, up: Column, limit: Column) -> Column:
    """1 when the close as shown equals the limit; a day without limits never counts."""
    return F.when((up != 0) & (shown == limit), 1).otherwise(0)


def _scope(
    basic: DataFrame, begin: DateLike | None, end: DateLike | None, codes: Iterable[str] | None
) -> tuple[DataFrame, DataFrame]:
    """Rows to decorate and rows that pass through; both filters reach the scan."""
    wanted = between_days(F.col("trade_date"), begin, end) & in_codes(F.col("code"), codes)
    return basic.where(wanted), basic.where(~F.coalesce(wanted, F.lit(False)))


def _with_rest(
    rows: DataFrame, outside: DataFrame, touched: str | None, begin: DateLike | None, end: DateLike | None
) -> DataFrame:
    """Decorated rows plus those out of scope: all, or with ``touched`` those of the same partitions."""
    unit = partition_unit(touched)
    return (outside.where(in_partitions(F.col("trade_date"), begin, end, unit)) if unit else outside).unionByName(rows)


def _attributes(master: DataFrame, eligible: Column, *columns: str) -> DataFrame:
    """Master attributes of eligible codes; their absence after a left join means not eligible."""
    return master.where(eligible).select("code", *columns, F.lit(True).alias("_eligible"))


def _bars(bars: DataFrame, begin, end, *columns: str) -> DataFrame:
    return bars.where(between_days(F.col("date"), begin, end)).select(
        "code", F.col("date").alias("trade_date"), *[F.col(c).alias(f"_{c}") for c in columns],
        F.lit(True).alias("_traded"),
    )


def _set_where(df: DataFrame, condition: Column, values: dict[str, Column], columns: list[str]) -> DataFrame:
    """Assign computed columns on matching rows and restore the stored layout."""
    types = dict(df.dtypes)
    decided = df.withColumn("_hit", F.coalesce(condition, F.lit(False)))
    return decided.select(
        *[
            F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).cast(types[c]).alias(c) if c in values else F.col(c)
            for c in columns
        ]
    )


def fill_price_limits(
    basic: DataFrame,
    bars: DataFrame,
    master: DataFrame,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    exchanges: Iterable[str] | None = None,
    codes: Iterable[str] | None = None,
    touched: str | None = None,
) -> DataFrame:
    """Set limit prices and flags on days that traded with a known previous close."""
    inside, outside = _scope(basic, begin, end, codes)
    eligible = in_boards(F.col("board"), SHARE_BOARDS) & in_exchanges(F.col("exchange"), exchanges)
    traded = _bars(bars, begin, end, "close", "pre_close", "tradestatus").where(
        (F.col("_tradestatus") == 1) & (F.col("_pre_close") != -1)
    )
    rows = inside.join(traded, ["code", "trade_date"], "left").join(
        _attributes(master, eligible, F.col("board").alias("_board"), F.col("list_date").alias("_list_date")),
        "code", "left",
    )
    # Rates, then prices, then flags: each step reads the columns of the one before, so that
    # no expression is computed twice.
    rated = with_limit_rates(rows)
    upper, lower = limit_prices(F.col("_board"), F.col("_up"), F.col("_down"), F.col("_pre_close"))
    shown = round_at(F.col("_close") + HALF_UP_GUARD, 2)
    priced = rated.withColumns({"_upper": upper, "_lower": lower, "_shown": shown})
    values = {
        "limit_up": F.col("_upper"),
        "limit_down": F.col("_lower"),
        "is_limit_up": at_limit(F.col("_shown"), F.col("_up"), F.col("_upper")),
        "is_limit_down": at_limit(F.col("_shown"), F.col("_up"), F.col("_lower")),
    }
    return _with_rest(_set_where(priced, F.col("_traded") & F.col("_eligible"), values, basic.columns), outside, touched, begin, end)


def fill_volume_ratio(
    basic: DataFrame,
    bars: DataFrame,
    master: DataFrame,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    exchanges: Iterable[str] | None = None,
    codes: Iterable[str] | None = None,
    touched: str | None = None,
) -> DataFrame:
    """Volume over the mean of up to five preceding trading rows, two decimals.

    Suspended rows and non-shares leave before the window. Of the days before the range only
    the last five trading rows of each code take part, however far back a suspension pushes them; a rank
    filter finds them below the shuffle.
    """
    inside, outside = _scope(basic, begin, end, codes)
    eligible = not_in_boards(F.col("board"), NOT_TRADED_AS_SHARE) & in_exchanges(F.col("exchange"), exchanges)
    shares = master.where(eligible).select("code")
    traded = bars.select("code", "date", "volume", "tradestatus").where((F.col("tradestatus") == 1) & in_codes(F.col("code"), codes))
    trading = traded.where(between_days(F.col("date"), begin, end)).join(shares, "code", "left_semi")
    if begin is not None:
        newest = Window.partitionBy("code").orderBy(F.col("date").desc())
        earlier = traded.where(F.col("date") < F.lit(as_date(begin))).join(shares, "code", "left_semi")
        earlier = earlier.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= 5).drop("_rank")
        trading = trading.unionByName(earlier)
    means = trailing_mean(trading, "code", "date", "volume", 5, "_mean").where(
        between_days(F.col("date"), begin, end)
    )
    ratio = F.when(F.col("_mean") != 0, round_at(F.col("_volume") / F.col("_mean"), 2))
    source = means.select(
        "code", F.col("date").alias("trade_date"), F.col("volume").alias("_volume"), "_mean",
        F.lit(True).alias("_traded"),
    )
    rows = inside.join(source, ["code", "trade_date"], "left")
    return _with_rest(_set_where(rows, F.col("_traded"), {"volume_ratio": ratio}, basic.columns), outside, touched, begin, end)


def share_events(capital: DataFrame, master: DataFrame) -> DataFrame:
    """Share-count states per code and day, in units of ten thousand shares.

    Same-day events collapse to their largest values. The first event with positive
    "before" values also yields the state that held from the start of the market.
    """
    stated = capital.where(
        F.col("category").isin(list(SHARE_EVENT_CATEGORIES))
        & (F.col("bonus_share") > 0)
        & (F.col("allotment_share") > 0)
    ).join(
        master.select(F.col("symbol"), F.col("code").alias("_full_code")),
        F.col("code") == F.col("symbol"),
    )
    per_day = stated.groupBy(F.col("_full_code").alias("code"), "date").agg(
        F.max("dividend").alias("_prev_float"),
        F.max("allotment_price").alias("_prev_total"),
        F.max("bonus_share").alias("float_wan"),
        F.max("allotment_share").alias("total_wan"),
    )
    opening = (
        per_day.where((F.col("_prev_float") > 0) & (F.col("_prev_total") > 0))
        .groupBy("code")
        .agg(
            F.min_by("_prev_float", "date").alias("float_wan"),
            F.min_by("_prev_total", "date").alias("total_wan"),
        )
        .select("code", F.lit(INITIAL_STATE_DAY).cast("date").alias("date"), "float_wan", "total_wan")
    )
    return concat_sources([per_day.select("code", "date", "float_wan", "total_wan"), opening])


def fill_shares(
    basic: DataFrame,
    capital: DataFrame,
    master: DataFrame,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    codes: Iterable[str] | None = None,
    exchanges: Iterable[str] | None = None,
    touched: str | None = None,
) -> DataFrame:
    """Total and float shares from the latest share-count state on or before each day."""
    inside, outside = _scope(basic, begin, end, codes)
    eligible = in_boards(F.col("board"), SHARE_BOARDS) & in_exchanges(F.col("exchange"), exchanges)
    states = share_events(capital, master).select(
        "code", F.col("date").alias("_state_day"),
        F.round(F.col("total_wan") * SHARES_PER_WAN).cast("long").alias("_total"),
        F.round(F.col("float_wan") * SHARES_PER_WAN).cast("long").alias("_float"),
        F.lit(True).alias("_stated"),
    )
    scoped = inside.join(_attributes(master, eligible), "code", "left")
    rows = asof_join(
        scoped, states, ["code"], "trade_date", "_state_day", ["_total", "_float", "_stated"]
    )
    values = {"total_shares": F.col("_total"), "float_shares": F.col("_float")}
    return _with_rest(_set_where(rows, F.col("_eligible") & F.col("_stated"), values, basic.columns), outside, touched, begin, end)


def fill_report(
    filled: DataFrame,
    master: DataFrame,
    column: str,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    codes: Iterable[str] | None = None,
    exchanges: Iterable[str] | None = None,
) -> DataFrame:
    """One row over a fill's scope: rows in all, rows with a value, rows left without one.

    Counted on the result itself: counters collected while writing can count a task twice
    when a lost executor makes Spark run it again.
    """
    inside, _ = _scope(filled, begin, end, codes)
    eligible = in_boards(F.col("board"), SHARE_BOARDS) & in_exchanges(F.col("exchange"), exchanges)
    scoped = inside.join(master.where(eligible).select("code"), "code", "left_semi")
    return scoped.agg(
        F.count(F.lit(1)).alias("total"), F.count(column).alias("updated"),
        F.count_if(F.col(column).isNull()).alias("skipped"),
    )


def stated_codes(capital: DataFrame) -> DataFrame:
    """Exact number of codes that have a usable share-count event."""
    usable = (
        F.col("category").isin(list(SHARE_EVENT_CATEGORIES))
        & (F.col("bonus_share") > 0) & (F.col("allotment_share") > 0)
    )
    return capital.where(usable).agg(F.count_distinct("code").alias("stated_codes"))


def _turnover_rows(basic, bars, master, begin, end, codes, exchanges, overwrite) -> tuple[DataFrame, DataFrame, Column]:
    """(rows in scope with bar and eligibility, other rows, which rows get a rate)."""
    inside, outside = _scope(basic, begin, end, codes)
    eligible = in_boards(F.col("board"), SHARE_BOARDS) & in_exchanges(F.col("exchange"), exchanges)
    traded = _bars(bars, begin, end, "volume", "tradestatus").where(
        (F.col("_tradestatus") == 1) & F.col("_volume").isNotNull()
    )
    rows = inside.join(traded, ["code", "trade_date"], "left").join(
        _attributes(master, eligible), "code", "left"
    )
    hit = F.col("_traded") & F.col("_eligible") & (F.col("float_shares") > 0)
    return rows, outside, hit if overwrite else hit & F.col("turnover_rate").isNull()


def fill_turnover(
    basic: DataFrame,
    bars: DataFrame,
    master: DataFrame,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    codes: Iterable[str] | None = None,
    exchanges: Iterable[str] | None = None,
    overwrite: bool = False,
    touched: str | None = None,
) -> DataFrame:
    """Turnover rate in percent on trading rows; only NULLs unless ``overwrite``."""
    rows, outside, hit = _turnover_rows(basic, bars, master, begin, end, codes, exchanges, overwrite)
    rate = round_at(F.try_divide(F.col("_volume").cast("double"), F.col("float_shares").cast("double")) * 100, 4)
    return _with_rest(_set_where(rows, hit, {"turnover_rate": rate}, basic.columns), outside, touched, begin, end)


def turnover_updates(
    basic: DataFrame,
    bars: DataFrame,
    master: DataFrame,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    codes: Iterable[str] | None = None,
    exchanges: Iterable[str] | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """One row: how many rows ``fill_turnover`` sets with the same arguments."""
    rows, _, hit = _turnover_rows(basic, bars, master, begin, end, codes, exchanges, overwrite)
    return rows.agg(F.count_if(F.coalesce(hit, F.lit(False))).alias("updated"))


def fill_market_value(
    basic: DataFrame,
    bars: DataFrame,
    master: DataFrame,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    codes: Iterable[str] | None = None,
    exchanges: Iterable[str] | None = None,
    touched: str | None = None,
) -> DataFrame:
    """Market values wherever total shares are known and a bar exists, traded or not."""
    inside, outside = _scope(basic, begin, end, codes)
    eligible = in_boards(F.col("board"), SHARE_BOARDS) & in_exchanges(F.col("exchange"), exchanges)
    rows = inside.join(_bars(bars, begin, end, "close"), ["code", "trade_date"], "left").join(
        _attributes(master, eligible), "code", "left"
    )
    hit = F.col("_traded") & F.col("_eligible") & F.col("total_shares").isNotNull()
    values = {
        "total_mv": F.col("total_shares") * F.col("_close"),
        "float_mv": F.col("float_shares") * F.col("_close"),
    }
    return _with_rest(_set_where(rows, hit, values, basic.columns), outside, touched, begin, end)
