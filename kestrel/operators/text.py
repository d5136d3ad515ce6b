"""Text lines and HTML item extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Markup patterns.  Table rows carry one of two row classes;
# cells are <td> elements.
ROW_CLASSES = ("altrow datarowSeparator", " datarowSeparator")
ROW_PATTERN = '<tr class="(?:' + "|".join(ROW_CLASSES) + ')">(.*?)</tr>'
CELL_PATTERN = r"<td[^>]*>(.*?)</td>"


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split on one space (empty strings count as words), count per word.
    The aggregation is partial per task before the shuffle (map-side combine)."""
    words = lines.select(F.explode(F.split(F.col(col), " ", -1)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def html_list(items: DataFrame) -> DataFrame:
    """Item names of each page in page order."""
    return items.groupBy("page_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda s: s["name"]).alias("names"))


def html_rows(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page_id, row, name, Metric, English, Comments) from attribute tables:
    rows of the two row classes, first cell = name, next three = values."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(ROW_PATTERN), 1))
                        .alias("row", "tr"))
    cells = rows.withColumn("td", F.regexp_extract_all("tr", F.lit(CELL_PATTERN), 1))
    return cells.select("page_id", "row", F.get("td", 0).alias("name"), F.get("td", 1).alias("Metric"),
                        F.get("td", 2).alias("English"), F.get("td", 3).alias("Comments"))
