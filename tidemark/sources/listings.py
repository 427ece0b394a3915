"""Flatten paged JSON listings into one row per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DEFAULT_LIST_FIELD, NEXT_LINK_FIELDS


def _is_json_array(text: Column) -> Column:
    return F.json_array_length(text).isNotNull()


def list_field_of(body: Column, list_field: str = DEFAULT_LIST_FIELD) -> Column:
    """Name of the list in one page: `list_field` when it holds a list, else
    the first key (in document order) whose value is a list, else null."""
    fields = F.from_json(body, "map<string,string>")
    first_list = F.get(F.filter(F.json_object_keys(body), lambda k: _is_json_array(F.element_at(fields, k))), 0)
    return F.when(_is_json_array(fields[list_field]), F.lit(list_field)).otherwise(first_list)


def flatten_pages(pages: DataFrame, list_field: str = DEFAULT_LIST_FIELD, *, page_col: str = "page_no",
                  body_col: str = "body") -> DataFrame:
    """One row per listed item: (page_no, item_pos, item, next_link).

    The list's name is chosen on the first page only (smallest `page_no`) and
    used for all pages. A page holding that list yields its elements; a page
    that is a bare array yields its elements; anything else that is not blank
    (another object, a page that is cut off or no JSON at all) is one item.
    Items are JSON text, ready for `from_json` with a schema (list elements
    come back compact; a whole-page item is the page's own text).
    Each page is a row, so pages are processed in parallel without a shuffle;
    only the one-row choice of the list name is a (scalar) subquery.
    """
    body = F.col(body_col)
    # Only the first page is parsed to choose the list: its number comes from
    # a column-only aggregate, then that one page is read.
    first_no = pages.select(F.min(page_col)).scalar()
    chosen = pages.where(F.col(page_col) == first_no).select(list_field_of(body, list_field)).limit(1).scalar()
    fields = F.from_json(body, "map<string,string>")
    listed = F.when(chosen.isNotNull(), F.element_at(fields, chosen))
    items = (F.when(_is_json_array(listed), F.from_json(listed, "array<string>"))
             .when(_is_json_array(body), F.from_json(body, "array<string>"))
             .when(F.length(F.trim(body)) > 0, F.array(body))
             .otherwise(F.array().cast("array<string>")))
    next_link = F.coalesce(*[fields[k] for k in NEXT_LINK_FIELDS])
    return pages.select(F.col(page_col), F.posexplode(items).alias("item_pos", "item"),
                        next_link.alias("next_link"))


def union_ordered(frames: list[DataFrame], pos_col: str = "part_pos") -> DataFrame:
    """Union all, by name, keeping which input each row came from so the
    original order can be restored with `orderBy(pos_col, ...)`."""
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn(pos_col, F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to union")
    return out
