"""Security identifiers: symbol padding, suffixed codes, boards, code lists and scopes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Board vocabularies used by the different programs.
NON_INDEX = ("MAIN", "STAR", "GEM", "BJ", "ETF", "BOND")
SHARE_BOARDS = ("MAIN", "STAR", "GEM", "BJ")
NOT_TRADED_AS_SHARE = ("INDEX", "BOND", "ETF")
NOT_AUDITED = ("INDEX", "BJ")


def zero_pad(symbol: Column, width: int = 6) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    text = F.trim(symbol.cast("string"))
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def suffixed(symbol: Column, exchange: Column) -> Column:
    """``600519`` + ``sh`` -> ``600519.SH``."""
    return F.concat(F.trim(symbol), F.lit("."), F.upper(F.trim(exchange)))


def dotted_parts(code: Column) -> tuple[Column, Column]:
    """``sh.600509`` -> (exchange, symbol)."""
    parts = F.split(code, r"\.", 2)
    return F.upper(F.get(parts, 0)), F.get(parts, 1)


def board_of(kind: Column, symbol: Column) -> Column:
    """Board from security kind (1 share, 2 index) and symbol prefix."""
    return (
        F.when(kind == "2", "INDEX")
        .when(symbol.startswith("688") | symbol.startswith("689"), "STAR")
        .when(symbol.startswith("300") | symbol.startswith("301"), "GEM")
        .when(symbol.startswith("9"), "BJ")
        .otherwise("MAIN")
    )


def split_code_list(items: str | Iterable[str] | None) -> list[str]:
    """Flatten ``['600519,000001', '300750，688001']``; half- and full-width commas split."""
    if items is None:
        return []
    parts = [items] if isinstance(items, str) else items
    flat = (token.strip() for part in parts for token in part.replace("，", ",").split(","))
    return [token for token in flat if token]


def in_codes(column: Column, items: str | Iterable[str] | None) -> Column:
    """Predicate for a requested code list; no list means every code."""
    wanted = split_code_list(items)
    return column.isin(wanted) if wanted else F.lit(True)


def in_exchanges(column: Column, exchanges: Iterable[str] | None) -> Column:
    """Predicate for requested exchanges; ``all`` or nothing means every exchange."""
    wanted = requested_exchanges(exchanges)
    return F.lit(True) if wanted is None else column.isin(wanted)


def requested_exchanges(exchanges: Iterable[str] | None) -> list[str] | None:
    names = [e.upper() for e in (exchanges or [])]
    return None if not names or "ALL" in names else names


def in_boards(column: Column, boards: Iterable[str]) -> Column:
    return column.isin(list(boards))


def not_in_boards(column: Column, boards: Iterable[str]) -> Column:
    """``NOT IN``: a NULL board does not qualify, as in SQL."""
    return ~column.isin(list(boards))


def source_supports(symbol: Column, status: Column) -> Column:
    """Sources skip delisted securities and symbols that start with 9."""
    return ~symbol.startswith("9") & (status != "D")
