"""Table registry: explicit schemas, keys, owned columns, domains. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, D, I, L, F8, TS = (
    T.StringType(), T.DateType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(),
)
MONEY = T.DecimalType(20, 4)

# Report field number -> column, in field-number order.
REPORT_FIELDS: dict[int, str] = {
    1: "eps", 2: "eps_deduct", 3: "undist_profit_ps", 4: "bps", 6: "roe", 7: "ocf_ps",
    8: "money_funds", 11: "accounts_recv", 17: "inventory", 21: "total_cur_assets",
    27: "fixed_assets", 33: "intangible_assets", 35: "goodwill", 39: "total_noncur_assets",
    40: "total_assets", 41: "short_term_loan", 44: "accounts_pay", 54: "total_cur_liab",
    55: "long_term_loan", 56: "bonds_payable", 62: "total_noncur_liab", 63: "total_liab",
    64: "share_capital", 65: "capital_reserve", 66: "surplus_reserve", 68: "undist_profits",
    69: "minority_equity", 72: "total_equity", 74: "op_revenue", 75: "op_cost",
    76: "tax_surcharges", 77: "sales_expense", 78: "admin_expense", 80: "financial_expense",
    81: "asset_impairment", 83: "investment_income", 86: "op_profit", 92: "total_profit",
    93: "income_tax", 95: "net_profit", 96: "net_profit_parent", 97: "minority_pl",
    101: "ocf_in", 106: "ocf_out", 107: "ocf_net", 119: "icf_net", 128: "fcf_net",
    131: "cash_net_inc", 133: "cash_end_bal", 159: "current_ratio", 160: "quick_ratio",
    183: "revenue_yoy", 184: "net_profit_yoy", 199: "net_margin", 202: "gross_margin",
    210: "debt_ratio", 238: "total_shares", 239: "float_a_shares", 242: "num_shareholders",
    304: "rd_expense", 314: "report_anno_date",
}

# Statement views over the wide report table, as field-number ranges.
STATEMENT_FIELDS: dict[str, tuple[int, ...]] = {
    "balance_sheet": tuple(n for n in REPORT_FIELDS if 8 <= n <= 72),
    "income_statement": (*(n for n in REPORT_FIELDS if 74 <= n <= 97), 304),
    "cash_flow": tuple(n for n in REPORT_FIELDS if 101 <= n <= 133),
}

MARGIN_COLUMNS = (
    "margin_buy_amount", "margin_repay_amount", "margin_balance", "short_sell_volume",
    "short_repay_volume", "short_balance_volume", "short_balance_amount", "margin_short_balance",
)


@dataclass(frozen=True)
class Table:
    """One stored table: schema, key, and the constraints the audits check."""

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    keys: tuple[str, ...]
    day: str | None = None
    required: tuple[str, ...] = ()
    domains: dict[str, tuple] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns])

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


def _factor_table(name: str) -> Table:
    return Table(
        name,
        (("code", S), ("trade_date", D), ("fore_factor", F8), ("back_factor", F8),
         ("adjust_factor", F8), ("created_at", TS), ("updated_at", TS)),
        ("code", "trade_date"), "trade_date", ("code", "trade_date"),
    )


def _margin_table(name: str, ids: tuple[str, ...], keys: tuple[str, ...]) -> Table:
    return Table(
        name,
        (("trade_date", D), ("exchange_code", S), *((c, S) for c in ids),
         *((c, MONEY) for c in MARGIN_COLUMNS), ("created_at", TS), ("updated_at", TS)),
        keys, "trade_date", ("trade_date", "exchange_code", *ids),
        {"exchange_code": ("SH", "SZ", "BJ")},
    )


TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "stock_info",
            (("code", S), ("symbol", S), ("name", S), ("exchange", S), ("board", S), ("list_date", D),
             ("delist_date", D), ("list_status", S), ("created_at", TS), ("last_updated_at", TS)),
            ("code",), None, ("code",),
            {"board": ("MAIN", "STAR", "GEM", "BJ", "ETF", "BOND", "INDEX"), "list_status": ("L", "D")},
            {"list_status": "L"},
        ),
        Table(
            "stock_daily",
            (("code", S), ("date", D), ("open", F8), ("high", F8), ("low", F8), ("close", F8),
             ("pre_close", F8), ("tradestatus", I), ("volume", L), ("amount", F8)),
            ("code", "date"), "date", ("code", "date"), {"tradestatus": (-1, 0, 1)}, {"tradestatus": 1},
        ),
        Table("trade_cal", (("cal_date", D), ("is_open", I)), ("cal_date",), "cal_date", ("cal_date",),
              {"is_open": (0, 1)}),
        _factor_table("adj_factor"),
        _factor_table("adj_factor_raw"),
        Table(
            "daily_basic",
            (("code", S), ("trade_date", D), ("turnover_rate", F8), ("float_mv", F8), ("total_mv", F8),
             ("pe", F8), ("pb", F8), ("is_st", I), ("limit_up", F8), ("limit_down", F8),
             ("is_limit_up", I), ("is_limit_down", I), ("volume_ratio", F8), ("total_shares", L),
             ("float_shares", L)),
            ("code", "trade_date"), "trade_date", ("code", "trade_date"),
            {"is_st": (0, 1), "is_limit_up": (0, 1), "is_limit_down": (0, 1)},
            {"is_limit_up": 0, "is_limit_down": 0},
        ),
        Table(
            "sw_industry",
            (("sw_version", S), ("industry_code", S), ("industry_name", S), ("sw_level", I),
             ("parent_code", S), ("updated_at", TS)),
            ("sw_version", "industry_code"), None,
            ("sw_version", "industry_code", "industry_name", "sw_level"), {"sw_level": (1, 2, 3)},
        ),
        Table(
            "stock_industry_clf_hist_sw_raw",
            (("symbol", S), ("start_date", D), ("industry_code", S), ("update_time", TS), ("updated_at", TS)),
            ("symbol", "start_date", "industry_code"), "start_date", ("symbol", "start_date", "industry_code"),
        ),
        Table(
            "capital_detail",
            (("code", S), ("date", D), ("category", S), ("dividend", F8), ("allotment_price", F8),
             ("bonus_share", F8), ("allotment_share", F8), ("updated_at", TS)),
            ("code", "date", "category"), "date", ("code", "date", "category"),
        ),
        _margin_table("margin_summary_daily", (), ("trade_date", "exchange_code")),
        _margin_table("margin_detail_daily", ("symbol", "code"), ("trade_date", "exchange_code", "symbol")),
        Table(
            "finance_report",
            (("code", S), ("report_date", D), *((c, F8) for c in REPORT_FIELDS.values()), ("updated_at", TS)),
            ("code", "report_date"), "report_date", ("code", "report_date"),
        ),
    )
}


def create_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All tables, empty, with their declared schemas."""
    return {name: table.empty(spark) for name, table in TABLES.items()}


def statement_view(report: DataFrame, statement: str) -> DataFrame:
    """Balance sheet, income statement or cash flow as a projection of the wide report."""
    columns = [REPORT_FIELDS[n] for n in STATEMENT_FIELDS[statement]]
    return report.select("code", "report_date", *columns)
