"""Administrative units out of a crawled, paged table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from spinmart.sinks.tables import write_export
from spinmart.sources.pages import cells_to_columns, html_rows, html_rows_nested

# Cell positions of the published table, in the order of the export.
UNIT_CELLS = {
    "province_code": 6, "province": 7, "district_code": 4, "district": 5, "ward_code": 0, "ward": 1,
}


def admin_units(pages: DataFrame, row_tag: str = "tr", cell_tag: str = "td", nested: bool = False) -> DataFrame:
    """One row per table row of all pages, with ``(page_id, pos)`` as the order of the crawl."""
    read = html_rows_nested if nested else html_rows
    return cells_to_columns(read(pages, row_tag, cell_tag), UNIT_CELLS)


def export_admin_units(pages: DataFrame, path: str, row_tag: str = "tr", cell_tag: str = "td",
                       nested: bool = False) -> None:
    """Replace the exported sheet of units; its rows follow the crawl."""
    units = admin_units(pages, row_tag, cell_tag, nested).orderBy("page_id", "pos")
    write_export(units.drop("page_id", "pos"), path)
