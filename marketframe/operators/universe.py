"""Which securities a job covers, and over which dates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import in_codes, in_exchanges, source_supports, split_code_list, suffixed
from ..functions.dates import DateLike, as_date


def candidates(
    master: DataFrame,
    as_of: DateLike,
    begin: DateLike | None = None,
    end: DateLike | None = None,
    exchanges: Iterable[str] | None = None,
    codes: Iterable[str] | None = None,
    include_delisted: bool = False,
    index: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Securities with the interval a job has to cover, ordered by symbol unless told not to.

    Named codes beat exchanges. The interval starts no earlier than the listing date and
    ends no later than ``as_of`` (listed) or the delisting date (delisted).
    """
    board = F.col("board") == "INDEX" if index else F.col("board") != "INDEX"
    named = in_codes(F.col("symbol"), codes) if split_code_list(codes) else in_exchanges(F.col("exchange"), exchanges)
    cap = F.when(F.col("list_status") == "L", F.lit(as_date(as_of))).otherwise(F.col("delist_date"))
    first = F.col("list_date") if begin is None else F.greatest("list_date", F.lit(as_date(begin)))
    last = F.col("_cap") if end is None else F.least(F.col("_cap"), F.lit(as_date(end)))
    chosen = (
        master.where(board & named & F.col("list_date").isNotNull())
        .withColumn("_cap", cap)
        .where(F.col("_cap").isNotNull())
    )
    if not include_delisted:
        chosen = chosen.where(F.col("list_status") == "L")
    found = (
        chosen.withColumns({"from_date": first, "to_date": last})
        .where(F.col("from_date") <= F.col("to_date"))
        .select(
            "symbol", "exchange", "from_date", "to_date", "list_status",
            suffixed(F.col("symbol"), F.col("exchange")).alias("code"),
        )
    )
    return found.orderBy("symbol", "exchange") if ordered else found


def fetchable(candidate_rows: DataFrame) -> DataFrame:
    """Candidates a bar source can serve."""
    return candidate_rows.where(source_supports(F.col("symbol"), F.col("list_status")))


def capital_fetchable(candidate_rows: DataFrame) -> DataFrame:
    """Candidates a capital-event source can serve: the Beijing exchange is not covered."""
    return candidate_rows.where(F.col("exchange") != "BJ")
