"""Table rows out of raw HTML, JVM-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells of a panel row, in page order, with their types.
PANEL_CELLS = {
    "team": "string",
    "year": "int",
    "wins": "int",
    "losses": "int",
    "ot_losses": "int",
    "win_rate": "double",
    "goals_for": "int",
    "goals_against": "int",
    "goal_diff": "int",
}
TABLE_PATTERN = r"""(?is)<table\b[^>]*class\s*=\s*["'][^"']*\btable\b[^"']*["'][^>]*>(.*?)</table>"""
ROW_PATTERN = r"(?is)<tr\b[^>]*>(.*?)</tr>"
CELL_PATTERN = r"(?is)<td\b[^>]*>(.*?)</td>"
TAG_PATTERN = r"(?s)<[^>]*>"
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&",
}


def html_fragments(df: DataFrame, html: str, pattern: str, groups: dict[str, int]) -> DataFrame:
    """One row per match of ``pattern`` with its position and the named capture groups."""
    arrays = [F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(g)) for g in groups.values()]
    zipped = F.arrays_zip(*[a.alias(n) for n, a in zip(groups, arrays)])
    kept = [c for c in df.columns if c != html]
    exploded = df.select(*kept, F.posexplode(zipped).alias("pos", "m"))
    return exploded.select(*kept, "pos", *[F.col("m").getField(n).alias(n) for n in groups])


def table_rows(df: DataFrame, html: str, cells: dict[str, str] = PANEL_CELLS) -> DataFrame:
    """Rows of the first data table of a page, its header row skipped.

    Markup inside a cell is removed, the text trimmed, empty text is NULL and the cell is cast.
    Rows with fewer cells than asked for are dropped; the page is kept.
    """
    kept = [c for c in df.columns if c != html]
    table = F.regexp_extract(F.col(html), TABLE_PATTERN, 1)
    rows = df.select(
        *kept,
        F.posexplode(F.regexp_extract_all(table, F.lit(ROW_PATTERN), F.lit(1))).alias("pos", "_tr"),
    ).withColumn("_td", F.regexp_extract_all("_tr", F.lit(CELL_PATTERN), F.lit(1)))
    wide = rows.filter((F.col("pos") > 0) & (F.size("_td") >= len(cells)))
    out = []
    for i, (name, kind) in enumerate(cells.items()):
        text = F.regexp_replace(F.col("_td")[i], TAG_PATTERN, "")
        for entity, plain in ENTITIES.items():
            text = F.replace(text, F.lit(entity), F.lit(plain))
        text = F.trim(text, F.lit(" \t\r\n"))
        value = F.when(text != "", text)
        out.append((value if kind == "string" else value.try_cast(kind)).alias(name))
    return wide.select(*kept, "pos", *out)


def pages_until_empty(counts: DataFrame, page: str, rows: str) -> DataFrame:
    """Pages in front of the first page without rows."""
    stop = counts.filter(F.col(rows) == 0).agg(F.min(page)).scalar()
    return counts.filter(stop.isNull() | (F.col(page) < stop))
