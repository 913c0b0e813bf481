"""Saved listing and detail pages -> rows, all with built-in regex functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_html, unescape


def extract_listing(
    pages: DataFrame,
    html_col: str,
    link_re: str,
    header_split: str = "<h3>",
    header_re: str = r"^([^<]+)</h3>",
    keep_preamble: bool = False,
    id_cols: Sequence[str] = ("page_id",),
) -> DataFrame:
    """One page -> one row per link, with the group header above it carried on (A5).

    The page is split on the header tag; section 0 is the text before the first header (kept
    only with ``keep_preamble``, with a null header). ``link_re`` has two groups: target, text.
    """
    secs = pages.select(*id_cols, F.posexplode(F.split(F.col(html_col), header_split)).alias("section_no", "section"))
    if not keep_preamble:
        secs = secs.where(F.col("section_no") > 0)
    header = F.when(F.col("section_no") > 0, clean_html(F.regexp_extract("section", header_re, 1)))
    secs = secs.withColumn("header", header)
    links = F.arrays_zip(
        F.regexp_extract_all("section", F.lit(link_re), 1).alias("target"),
        F.regexp_extract_all("section", F.lit(link_re), 2).alias("text"),
    )
    rows = secs.select(*id_cols, "section_no", "header", F.posexplode(links).alias("pos", "link"))
    # the header is unescaped and blank-collapsed; the link text is unescaped and trimmed only
    return rows.select(
        *id_cols, "section_no", "header", (F.col("pos") + 1).alias("ordinal"), F.col("link.target").alias("target"),
        F.trim(unescape(F.col("link.text"))).alias("text"),
    )


def extract_fields(pages: DataFrame, html_col: str, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """Detail-page fields: for each field an ordered pattern list, first non-empty match wins."""
    out = pages
    for name, pats in fields.items():
        cands = [F.nullif(F.regexp_extract(F.col(html_col), p, 1), F.lit("")) for p in pats]
        out = out.withColumn(name, clean_html(F.coalesce(*cands)))
    return out


def extract_dated_listing(
    pages: DataFrame,
    html_col: str,
    item_re: str,
    date_formats: Sequence[str] = ("d MMM yyyy",),
    id_cols: Sequence[str] = ("page_id",),
) -> DataFrame:
    """Second listing layout (A6): one regex with three groups (id, title, date text) per item.
    The date is parsed with the given formats; an unparsable date gives null and the row is kept."""
    from ..functions.scalars import parse_date

    items = F.arrays_zip(
        F.regexp_extract_all(F.col(html_col), F.lit(item_re), 1).alias("item_id"),
        F.regexp_extract_all(F.col(html_col), F.lit(item_re), 2).alias("title"),
        F.regexp_extract_all(F.col(html_col), F.lit(item_re), 3).alias("date_text"),
    )
    rows = pages.select(*id_cols, F.posexplode(items).alias("pos", "it"))
    return rows.select(
        *id_cols,
        (F.col("pos") + 1).alias("ordinal"),
        F.col("it.item_id").try_cast("long").alias("item_id"),
        F.trim(unescape(F.col("it.title"))).alias("title"),
        parse_date(F.col("it.date_text"), date_formats).alias("date"),
    )
