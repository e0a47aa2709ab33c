"""Completeness and consistency audits. Every check is one plan over all days at once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import NOT_AUDITED, in_codes, in_exchanges, not_in_boards
from ..functions.dates import DateLike, as_date, between_days
from ..functions.numeric import any_of, failing_columns, missing_or_not_positive, missing_or_zero, round_at
from ..operators.calendar import last_open_day, open_days, previous_open_day
from ..operators.merge import concat_sources
from ..operators.unique import repeated_keys
from ..schemas import TABLES, Table
from ..session import checkpointed
from ..sources.events import EX_RIGHTS

COMPLETE, GAPS_FOUND = "complete", "gaps_found"
FACTOR_CHANGE, PRICE_TOLERANCE = 1e-9, 0.01


@dataclass(frozen=True)
class Scope:
    """What an audit covers: securities of the exchanges and, if any are named, among the codes."""

    begin: DateLike
    end: DateLike
    exchanges: tuple[str, ...] = ("all",)
    codes: tuple[str, ...] = ()


def active_securities(master: DataFrame, scope: Scope, index: bool = False) -> DataFrame:
    board = F.col("board") == "INDEX" if index else not_in_boards(F.col("board"), NOT_AUDITED)
    return master.where(
        board
        & (F.col("list_status") == "L")
        & in_exchanges(F.col("exchange"), scope.exchanges)
        & in_codes(F.col("symbol"), scope.codes)
    ).select("code", "symbol", "name", "list_date", "delist_date")


def _in_range(df: DataFrame, day: str, scope: Scope) -> DataFrame:
    return df.where(between_days(F.col(day), scope.begin, scope.end))


def _suspended(bars: DataFrame, scope: Scope, day: str) -> DataFrame:
    return _in_range(bars, "date", scope).where(F.col("tradestatus") == 0).select("code", F.col("date").alias(day))


def _trading_days(calendar: DataFrame, scope: Scope, day: str) -> DataFrame:
    return F.broadcast(open_days(calendar, scope.begin, scope.end).select(F.col("cal_date").alias(day)))


def expected_counts(active: DataFrame, calendar: DataFrame, scope: Scope) -> DataFrame:
    """Securities listed on each open day, from listing and delisting steps.

    A security adds one on its first day and takes one off after its last, so the work is
    one row per security plus a running sum with at most one row per day, instead of one
    row per security and day.
    """
    listed = active.where(
        F.col("list_date").isNotNull()
        & (F.col("delist_date").isNull() | (F.col("delist_date") >= F.col("list_date")))
    )
    steps = (
        listed.select(
            F.explode(
                F.array(
                    F.struct(F.col("list_date").alias("day"), F.lit(1).alias("step")),
                    F.struct(F.date_add("delist_date", 1).alias("day"), F.lit(-1).alias("step")),
                )
            ).alias("s")
        )
        .where(F.col("s.day").isNotNull())
        .groupBy(F.col("s.day").alias("cal_date"))
        .agg(F.sum("s.step").alias("step"))
    )
    days = open_days(calendar, scope.begin, scope.end).select("cal_date", F.lit(0).cast("long").alias("step"), F.lit(True).alias("_open"))
    running = Window.orderBy("cal_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        steps.unionByName(days, allowMissingColumns=True)
        .withColumn("listed", F.sum("step").over(running))
        .where("_open")
        .select("cal_date", "listed")
    )


def _daily_count(df: DataFrame, day: str, active: DataFrame, out: str) -> DataFrame:
    counted = df.join(active.select("code"), "code", "left_semi")
    return counted.groupBy(F.col(day).alias("cal_date")).agg(F.count(F.lit(1)).alias(out))


def gap_dates(
    table: DataFrame, day: str, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope,
    is_bars: bool = False, index: bool = False,
) -> DataFrame:
    """Open days on which a table holds fewer rows than securities were listed.

    Suspended securities are not expected, except in the bar table itself, which stores
    their placeholder rows.
    """
    active = active_securities(master, scope, index)
    expected = expected_counts(active, calendar, scope)
    actual = _daily_count(_in_range(table, day, scope), day, active, "actual")
    joined = expected.join(actual, "cal_date", "left")
    if is_bars:
        need = F.col("listed")
    else:
        suspended = _daily_count(_suspended(bars, scope, "_day"), "_day", active, "_suspended")
        joined = joined.join(suspended, "cal_date", "left")
        need = F.col("listed") - F.coalesce(F.col("_suspended"), F.lit(0))
    have = F.coalesce(F.col("actual"), F.lit(0))
    return joined.where(need > have).select(
        "cal_date", need.alias("expected"), have.alias("actual"), (need - have).alias("missing")
    )


def missing_codes(
    table: DataFrame, day: str, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope,
    is_bars: bool = False, index: bool = False, gaps: DataFrame | None = None,
) -> DataFrame:
    """The securities missing on every gap day: listed, absent from the table, not suspended.

    ``gaps`` passes gap days that are already known.
    """
    if gaps is None:
        gaps = gap_dates(table, day, bars, master, calendar, scope, is_bars, index)
    active = active_securities(master, scope, index)
    first, last = F.lit(scope.begin).cast("date"), F.lit(scope.end).cast("date")
    intervals = active.where(F.col("list_date").isNotNull()).select(
        "code", "name",
        F.greatest(F.col("list_date"), first).alias("_from"),
        F.least(F.coalesce(F.col("delist_date"), last), last).alias("_to"),
    )
    present = _in_range(table, day, scope).select("code", F.col(day).alias("date"))
    if not is_bars:  # the bar table stores suspended days itself
        present = present.unionByName(_suspended(bars, scope, "date"))
    return _absent_days(intervals, gaps.select("cal_date"), present).select("date", "code", "name")


def _month_days(df: DataFrame, day: str, out: str, *keys: str) -> DataFrame:
    """The days of a month as a mask, a bit for each: one row per month and keys."""
    month = df.select(*keys, F.trunc(day, "month").alias("_month"), F.expr(f"shiftleft(1L, dayofmonth(`{day}`) - 1)").alias("_bit"))
    return month.groupBy(*keys, "_month").agg(F.bit_or("_bit").alias(out))


def _absent_days(intervals: DataFrame, days: DataFrame, present: DataFrame) -> DataFrame:
    """(date, code, name) of the days inside each interval on which its code is not present.

    Days meet as masks, a row per code and month, and become rows after the join: what is
    shuffled and sorted is one short row per security and month, not one per security and day.
    """
    months = intervals.where(F.col("_from") <= F.col("_to")).withColumn(
        "_month", F.expr("explode(sequence(trunc(_from, 'month'), trunc(_to, 'month'), INTERVAL 1 MONTH))")
    ).join(F.broadcast(_month_days(days, "cal_date", "_open")), "_month")
    inside = F.expr("shiftleft(1L, dayofmonth(least(_to, last_day(_month)))) - shiftleft(1L, dayofmonth(greatest(_from, _month)) - 1)")
    wanted = months.select("code", "name", "_month", F.col("_open").bitwiseAND(inside).alias("_wanted")).where(F.col("_wanted") != 0)
    met = wanted.join(_month_days(present, "date", "_seen", "code"), ["code", "_month"], "left")
    absent = met.select("code", "name", "_month", F.expr("_wanted & ~coalesce(_seen, 0L)").alias("_absent")).where(F.col("_absent") != 0)
    listed = absent.select("code", "name", "_month", F.expr("explode(filter(sequence(0, 30), i -> getbit(_absent, i) = 1))").alias("_at"))
    return listed.select(F.date_add("_month", F.col("_at")).alias("date"), "code", "name")


# Rules of the indicator and bar checks, by column.
BASIC_RULES = {
    **{c: missing_or_zero for c in ("pb", "total_shares", "float_shares", "turnover_rate", "total_mv", "float_mv")},
    **{c: missing_or_not_positive for c in ("limit_up", "limit_down")},
}
BAR_COLUMNS = ("open", "high", "low", "close", "pre_close", "volume", "amount")
FACTOR_COLUMNS = ("fore_factor", "back_factor", "adjust_factor")


def _audited(
    df: DataFrame, day: str, master: DataFrame, calendar: DataFrame, scope: Scope
) -> DataFrame:
    """Rows of active securities on open days, with the security's name."""
    names = active_securities(master, scope).select("code", "name")
    return _in_range(df, day, scope).join(_trading_days(calendar, scope, day), day, "left_semi").join(names, "code")


def _findings(df: DataFrame, day: str, rules: dict[str, Column]) -> DataFrame:
    return df.where(any_of(rules.values())).select(
        F.col(day).alias("trade_date"), "code", "name", failing_columns(rules).alias("missing")
    )


def not_suspended_indicators(
    basic: DataFrame, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope
) -> DataFrame:
    rows = _audited(basic, "trade_date", master, calendar, scope)
    return rows.join(_suspended(bars, scope, "trade_date"), ["code", "trade_date"], "left_anti")


def null_is_st(basic: DataFrame, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope) -> DataFrame:
    rows = not_suspended_indicators(basic.where(F.col("is_st").isNull()), bars, master, calendar, scope)
    return rows.select("trade_date", "code", "name")


def null_indicators(basic: DataFrame, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope) -> DataFrame:
    """Indicator rows with a missing value. The rules run before any join, so good rows never move."""
    rules = {c: rule(F.col(c)) for c, rule in BASIC_RULES.items()}
    rows = not_suspended_indicators(basic.where(any_of(rules.values())), bars, master, calendar, scope)
    return _findings(rows, "trade_date", rules)


def missing_pe(basic: DataFrame, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope) -> DataFrame:
    """Count of rows without a price-earnings ratio: a warning only."""
    rows = not_suspended_indicators(basic.where(missing_or_zero(F.col("pe"))), bars, master, calendar, scope)
    return rows.agg(F.count(F.lit(1)).alias("pe_missing"))


def bad_bars(bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope) -> DataFrame:
    rules = {c: missing_or_not_positive(F.col(c)) for c in BAR_COLUMNS}
    suspects = bars.where((F.col("tradestatus") == 1) & any_of(rules.values()))
    return _findings(_audited(suspects, "date", master, calendar, scope), "date", rules)


def bad_factors(
    factors: DataFrame, bars: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope
) -> DataFrame:
    rules = {c: missing_or_not_positive(F.col(c)) for c in FACTOR_COLUMNS}
    suspects = _audited(factors.where(any_of(rules.values())), "trade_date", master, calendar, scope)
    traded = _in_range(bars, "date", scope).where(F.col("tradestatus") == 1).select("code", F.col("date").alias("trade_date"))
    return _findings(suspects.join(traded, ["code", "trade_date"], "left_semi"), "trade_date", rules)


def xdr_check(
    capital: DataFrame, bars: DataFrame, factors: DataFrame, master: DataFrame, calendar: DataFrame, scope: Scope
) -> DataFrame:
    """Ex-rights events confirmed by a factor change, with theoretical and stored pre_close.

    ``status`` is mismatch, ok or uncomputable (an input price is missing). Events without a
    confirmed factor change and suspended days are not ex-rights days and leave.

    Each event asks for its own day and the open day before it. Both days of both daily
    tables are found in one join with the few events as the small side, and collapse back to
    one row per event; an event that finds no factors is dropped by the gate anyway.
    """
    active = active_securities(master, scope).select("symbol", F.col("code").alias("_code"), "name")
    terms = ("dividend", "allotment_price", "bonus_share", "allotment_share")
    events = (
        _in_range(capital.where(F.col("category") == EX_RIGHTS), "date", scope)
        .join(active, F.col("code") == F.col("symbol"))
        .select(
            F.col("_code").alias("code"), "name", F.col("date").alias("xdr_date"),
            *[F.coalesce(F.col(t), F.lit(0.0)).alias(t) for t in terms],
        )
    )
    dated = previous_open_day(events, "xdr_date", calendar)
    days = F.explode(F.expr("array(struct(false AS now, prev_open AS day), struct(true AS now, xdr_date AS day))"))
    wanted = dated.withColumn("_w", days).select("code", "name", "xdr_date", *terms, "_w.now", "_w.day")

    # Only days from the open day before the range on can be asked for.
    # That day is read first (one row), so that both bounds reach the scans as literals.
    first = F.lit(last_open_day(calendar, scope.begin).first()[0] or as_date(scope.begin))
    reachable = (F.col("day") >= first) & (F.col("day") <= F.lit(as_date(scope.end)))
    daily = bars.select("code", F.col("date").alias("day"), "close", "pre_close", "tradestatus").where(reachable).unionByName(
        factors.select("code", F.col("trade_date").alias("day"), "adjust_factor").where(reachable), allowMissingColumns=True
    )
    found = wanted.join(daily, ["code", "day"]).groupBy("code", "name", "xdr_date", *terms).agg(
        F.expr("max(close) FILTER (WHERE NOT now) AS close_prev"),
        F.expr("max(pre_close) FILTER (WHERE now) AS pre_close"),
        F.expr("max(tradestatus) FILTER (WHERE now) AS tradestatus"),
        F.expr("max(adjust_factor) FILTER (WHERE now) - max(adjust_factor) FILTER (WHERE NOT now) AS change"),
    )
    theory = F.expr(
        "(close_prev - dividend / 10 + allotment_price * allotment_share / 10)"
        " / (1 + bonus_share / 10 + allotment_share / 10)"
    )
    off = round_at(F.abs(F.col("pre_close") - F.col("theory")), 4)
    status = (
        F.when(F.col("close_prev").isNull() | F.col("pre_close").isNull(), "uncomputable")
        .when(off > PRICE_TOLERANCE, "mismatch")
        .otherwise("ok")
    )
    return (
        found.where((F.abs(F.col("change")) > FACTOR_CHANGE) & (F.coalesce(F.col("tradestatus"), F.lit(1)) != 0))
        .withColumn("theory", theory)
        .select("xdr_date", "code", "name", "close_prev", "pre_close", "theory", off.alias("diff"), status.alias("status"))
    )


def xdr_mismatches(*inputs, **named) -> DataFrame:
    return xdr_check(*inputs, **named).where(F.col("status") == "mismatch").drop("status")


def xdr_uncomputable(*inputs, **named) -> DataFrame:
    checked = xdr_check(*inputs, **named).where(F.col("status") == "uncomputable")
    return checked.agg(F.count(F.lit(1)).alias("uncomputable"))


def domain_check(df: DataFrame, table: str | Table) -> DataFrame:
    """Violations of a table's declared constraints: NOT NULL, value domains, key uniqueness.

    NOT NULL and domains are counted in one pass; a NULL satisfies a domain.
    """
    spec = TABLES[table] if isinstance(table, str) else table
    rules = {("not_null", c): F.col(c).isNull() for c in spec.required}
    rules |= {("domain", c): ~F.col(c).isin(list(allowed)) for c, allowed in spec.domains.items()}
    counts = df.agg(*[F.count_if(rule).alias(f"{kind}:{c}") for (kind, c), rule in rules.items()])
    listed = counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("rule"), F.lit(c).alias("column_name"), F.col(f"{kind}:{c}").alias("violations")
                    )
                    for kind, c in rules
                ]
            )
        ).alias("r")
    ).select("r.rule", "r.column_name", "r.violations")
    repeated = (
        repeated_keys(df, spec.keys, spec.day).agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("unique").alias("rule"), F.lit(",".join(spec.keys)).alias("column_name"), "violations")
    )
    return listed.unionByName(repeated).select(F.lit(spec.name).alias("table_name"), "rule", "column_name", "violations")


def limit_detail(findings: DataFrame, order: Iterable[str], check: str, limit: int | None) -> tuple[DataFrame, DataFrame]:
    """One row budget shared by ordered checks: (rows shown, totals per check).

    Earlier checks use the budget first. Totals always count everything, and say whether a
    check was cut. A negative or absent limit shows all. Each task keeps at most ``limit``
    rows, as for any ordered limit.
    """
    shown = findings if limit is None or limit < 0 else findings.orderBy(*order).limit(limit)
    totals = findings.groupBy(check).agg(F.count(F.lit(1)).alias("total"))
    kept = shown.groupBy(check).agg(F.count(F.lit(1)).alias("shown"))
    report = totals.join(kept, check, "left").select(
        check, "total", F.coalesce(F.col("shown"), F.lit(0)).alias("shown"),
        (F.coalesce(F.col("shown"), F.lit(0)) < F.col("total")).alias("truncated"),
    )
    return shown, report


@dataclass(frozen=True)
class AuditTables:
    bars: DataFrame
    basic: DataFrame
    factors: DataFrame
    capital: DataFrame
    master: DataFrame
    calendar: DataFrame


def core_checks(t: AuditTables, include_index: bool = False) -> list[tuple[str, DataFrame, str, bool, bool]]:
    """(check, table, day column, is the bar table, index scope) of the blocking checks, in order."""
    checks = [
        ("bars", t.bars, "date", True, False),
        ("factors", t.factors, "trade_date", False, False),
        ("indicators", t.basic, "trade_date", False, False),
    ]
    return checks + ([("index_bars", t.bars, "date", True, True)] if include_index else [])


def audit_gaps(t: AuditTables, scope: Scope, include_index: bool = False) -> DataFrame:
    """Gap days of all blocking checks."""
    parts = []
    for position, (name, table, day, is_bars, index) in enumerate(core_checks(t, include_index)):
        gaps = gap_dates(table, day, t.bars, t.master, t.calendar, scope, is_bars, index)
        parts.append(gaps.select(F.lit(position).alias("check_order"), F.lit(name).alias("check_name"), "*"))
    return concat_sources(parts)


def audit_missing(
    t: AuditTables, scope: Scope, include_index: bool = False, gaps: DataFrame | None = None
) -> DataFrame:
    """Missing securities of all blocking checks; ``gaps`` is an ``audit_gaps`` result to reuse."""
    parts = []
    for position, (name, table, day, is_bars, index) in enumerate(core_checks(t, include_index)):
        known = None if gaps is None else gaps.where(F.col("check_name") == name)
        rows = missing_codes(table, day, t.bars, t.master, t.calendar, scope, is_bars, index, known)
        parts.append(rows.select(F.lit(position).alias("check_order"), F.lit(name).alias("check_name"), "*"))
    return concat_sources(parts)


def audit_warnings(t: AuditTables, scope: Scope) -> DataFrame:
    """Row counts of the checks that warn without blocking."""
    found = {
        "bad_bars": bad_bars(t.bars, t.master, t.calendar, scope),
        "bad_factors": bad_factors(t.factors, t.bars, t.master, t.calendar, scope),
        "null_is_st": null_is_st(t.basic, t.bars, t.master, t.calendar, scope),
        "null_indicators": null_indicators(t.basic, t.bars, t.master, t.calendar, scope),
        "xdr_pre_close": xdr_mismatches(t.capital, t.bars, t.factors, t.master, t.calendar, scope),
    }
    return concat_sources(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("check_name"), "row_count") for n, df in found.items()]
    )


def audit_summary(
    t: AuditTables, scope: Scope, include_index: bool = False, gaps: DataFrame | None = None
) -> DataFrame:
    """One row per check: blocking checks count missing rows, warnings count findings."""
    if gaps is None:
        gaps = audit_gaps(t, scope, include_index)
    names = ", ".join(f"'{check[0]}'" for check in core_checks(t, include_index))
    every = t.bars.sparkSession.range(1).select(F.explode(F.expr(f"array({names})")).alias("check_name"))
    found = gaps.groupBy("check_name").agg(F.sum("missing").alias("row_count"))
    core = every.join(found, "check_name", "left").select(
        "check_name", F.lit("core").alias("kind"), F.coalesce(F.col("row_count"), F.lit(0)).alias("row_count")
    )
    warnings = audit_warnings(t, scope).select("check_name", F.lit("warning").alias("kind"), "row_count")
    return core.unionByName(warnings)


def audit_status(summary: DataFrame) -> DataFrame:
    """One row: totals and the overall status; only blocking checks decide it."""
    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("row_count"))), F.lit(0))

    return summary.agg(total("core").alias("core_missing"), total("warning").alias("warnings")).select(
        F.when(F.col("core_missing") == 0, COMPLETE).otherwise(GAPS_FOUND).alias("status"), "core_missing", "warnings"
    )


def audit_document(t: AuditTables, scope: Scope, include_index: bool = False, limit: int | None = None) -> DataFrame:
    """The whole audit as JSON lines: status, then checks, gap days and missing securities.

    ``part`` says what a line is. Only missing securities share the row budget; gap days
    are always complete, and each check's line says how much of its detail was cut. Gap days
    (one row per check and day) and the summary (one per check) are computed once and
    checkpointed. Findings are not stored: their totals are an aggregate, the lines shown an
    ordered limit.
    """
    gaps = checkpointed(audit_gaps(t, scope, include_index))
    missing = audit_missing(t, scope, include_index, gaps)
    summary = checkpointed(audit_summary(t, scope, include_index, gaps))
    shown, totals = limit_detail(missing, ["check_order", "date", "code"], "check_name", limit)

    def lines(part: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(part).alias("part"), F.to_json(F.struct(*df.columns)).alias("document"))

    return concat_sources(
        [
            lines("status", audit_status(summary)),
            lines("check", summary.join(totals, "check_name", "left")),
            lines("gap", gaps),
            lines("missing", shown),
        ]
    )
