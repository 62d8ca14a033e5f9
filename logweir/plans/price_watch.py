"""Price report over a watchlist and captured pages."""

from logweir.operators.pricing import first_rows, price_status
from logweir.sinks.reports import write_lines


def run_price_watch(watchlist, pages, report, *, limit=None, order_by=("Model",), **status):
    """Write one report line per watched product; `limit` takes only the first ones."""
    if limit is not None:
        watchlist = first_rows(watchlist, order_by, limit)
    rows = price_status(watchlist, pages, **status)
    write_lines(rows, report)
    return rows
