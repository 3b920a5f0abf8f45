"""Workbook sheets as a long table of cells: ``workbook, sheet, row_idx, col_idx, value``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paygrain.functions.text import header_or_default, strip

SHEET = ["workbook", "sheet"]
HEADER_ROWS = 10


def _trimmed(cells: DataFrame) -> DataFrame:
    return cells.withColumn("text", F.coalesce(strip(F.col("value")), F.lit("")))


def profile_sheets(
    cells: DataFrame, first_rows: int = 50, min_rows: int = 5, min_columns: int = 2
) -> DataFrame:
    """Filled rows among the first ones, extents, and whether the sheet holds a table.

    A workbook without any such sheet keeps all of its sheets.
    """
    filled = (F.col("row_idx") < first_rows) & (F.length("text") > 0)
    profile = (
        _trimmed(cells)
        .groupBy(*SHEET)
        .agg(
            F.countDistinct(F.when(filled, F.col("row_idx"))).alias("data_rows"),
            (F.max("col_idx") + 1).alias("max_column"),
            (F.max("row_idx") + 1).alias("max_row"),
        )
        .withColumn(
            "qualifies", (F.col("data_rows") > min_rows) & (F.col("max_column") > min_columns)
        )
    )
    any_table = F.max("qualifies").over(Window.partitionBy("workbook"))
    return profile.withColumn("keep", F.col("qualifies") | ~any_table)


def top_cells(cells: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """The filled cells of the first rows of each (kept) sheet, trimmed: titles and headers depend on no others."""
    if keep is not None:
        cells = cells.join(keep.where("keep").select(*SHEET), SHEET, "left_semi")
    return _trimmed(cells).where((F.col("row_idx") < HEADER_ROWS) & (F.length("text") > 0))


def _sheet_layout(top_filled: DataFrame, width: DataFrame) -> DataFrame:
    """Per sheet: title, header row, width. Only the first rows are looked at."""
    top = (
        top_filled.groupBy(*SHEET, "row_idx")
        .agg(F.count(F.lit(1)).alias("filled"), F.min_by("text", "col_idx").alias("first"))
    )
    found = top.groupBy(*SHEET).agg(
        F.min(F.when(F.col("filled") > 2, F.col("row_idx"))).alias("header"),
        F.min(F.when(F.col("filled") <= 2, F.struct("row_idx", "first"))).alias("label"),
    )
    above = F.col("header").isNull() | (F.col("label.row_idx") < F.col("header"))
    return width.join(found, SHEET, "left").select(
        *SHEET,
        "width",
        F.coalesce("header", F.lit(0)).alias("start"),
        F.coalesce(
            F.when(above, F.col("label.first")), F.concat(F.lit("Sheet: "), "sheet")
        ).alias("title"),
    )


def _filled() -> Column:
    """Map from the columns of the filled cells to their texts."""
    return F.map_from_entries(F.collect_list(F.when(F.length("text") > 0, F.struct("col_idx", "text"))))


def _by_column(filled: str, fallback: Callable[[Column, Column], Column]) -> Column:
    """Array over all columns of the sheet from a map (column -> text)."""
    return F.transform(
        F.sequence(F.lit(0), F.col("width") - 1),
        lambda j: fallback(F.coalesce(F.try_element_at(filled, j), F.lit("")), j),
    )


def headers() -> Column:
    """All column names of a sheet, from ``heads`` and ``width``; a blank one becomes ``col_<j>``."""
    return _by_column("heads", header_or_default)


def sparse_rows(
    cells: DataFrame,
    max_rows: int | None = None,
    keep: DataFrame | None = None,
    top: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows ``workbook, sheet, row_idx, filled`` and heads ``workbook, sheet, title, width, heads`` of all sheets.

    ``filled`` and ``heads`` map columns to texts and hold what is filled only, so that a row is as large as its
    cells, however far to the right a stray one stands. Blank rows are dropped. Only one row of a sheet is ever
    put together, never a sheet. All rows are taken unless ``max_rows`` asks for the first ones; ``keep``
    is a profile of which only the sheets marked to keep are taken. ``top`` are the stored :func:`top_cells` of them: then
    the profile gives the widths and the cells are read once, for the rows.
    """
    if keep is not None and top is not None:
        kept = keep.where("keep").dropna(subset=SHEET)
        width = kept.select(*SHEET, F.col("max_column").alias("width"))
    else:
        if keep is not None:
            cells = cells.join(keep.where("keep").select(*SHEET), SHEET, "left_semi")
        width = cells.groupBy(*SHEET).agg((F.max("col_idx") + 1).alias("width"))
        top = top_cells(cells)
    cells = _trimmed(cells)
    layout = _sheet_layout(top, width)
    placed = cells.where(F.length("text") > 0).join(layout, SHEET).where(F.col("row_idx") >= F.col("start"))
    if max_rows is not None:
        placed = placed.where(F.col("row_idx") <= F.col("start") + max_rows)
    body = placed.where(F.col("row_idx") > F.col("start"))
    rows = body.groupBy(*SHEET, "row_idx").agg(_filled().alias("filled"))
    first = top.join(layout, SHEET).where(F.col("row_idx") == F.col("start"))
    named = first.groupBy(*SHEET).agg(_filled().alias("heads"))
    none = F.create_map().cast("map<int,string>")
    heads = layout.join(named, SHEET, "left").select(
        *SHEET, "title", "width", F.coalesce("heads", none).alias("heads")
    )
    return rows, heads


def sheet_rows(
    cells: DataFrame, max_rows: int | None = None, keep: DataFrame | None = None
) -> DataFrame:
    """:func:`sparse_rows` at full width: ``workbook, sheet, title, row_idx, headers, values``.

    Missing cells are empty text; a blank header becomes ``col_<j>``.
    """
    rows, heads = sparse_rows(cells, max_rows, keep)
    wide = rows.join(heads, SHEET)
    values = _by_column("filled", lambda v, j: v)
    return wide.select(*SHEET, "title", "row_idx", headers().alias("headers"), values.alias("values"))


def sheet_values(rows: DataFrame) -> DataFrame:
    """One row per cell: ``workbook, sheet, title, row_idx, header, value``."""
    pairs = F.inline(F.arrays_zip(F.col("headers").alias("header"), F.col("values").alias("value")))
    return rows.select(*SHEET, "title", "row_idx", pairs.alias("header", "value"))


def named_columns(rows: DataFrame, sheet: str, headers: Sequence[str]) -> DataFrame:
    """The rows of one sheet with its header as column names."""
    check_names(sheet, headers)
    return rows.select([F.get("values", F.lit(j)).alias(n) for j, n in enumerate(headers)])


def check_names(sheet: str, headers: Sequence[str]) -> None:
    if len(set(headers)) < len(headers):
        raise ValueError(f"repeated column names in sheet {sheet}: {list(headers)}")


def sheet_to_table(rows: DataFrame, workbook: str, sheet: str) -> tuple[DataFrame, str] | None:
    """One sheet with its header as column names, and its title; ``None`` for an empty sheet."""
    df = rows.where((F.col("workbook").cast("string") == workbook) & (F.col("sheet") == sheet))
    first = df.select("headers", "title").first()
    if first is None:
        return None
    return named_columns(df, sheet, first["headers"]), first["title"]
