"""Links of an HTML page, in document order."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text in which markup is not markup, then opening <a> tags, then the attributes of one tag.
_OPAQUE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ANCHOR = r"(?i)<a\s((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_ATTRIBUTE = r"([^\s=>/\"']+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)"
_HREF = r"(?is)^href\s*=\s*"


@F.pandas_udf(T.StringType())
def _decode_entities(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore").astype(object)


def decode_entities(text: Column) -> Column:
    """Decode HTML entities; only values that hold ``&`` carry data to the Arrow function."""
    return F.coalesce(_decode_entities(F.when(text.contains("&"), text)), text)


def raw_hrefs(page: Column) -> Column:
    """First non-empty ``href`` of each ``<a>``, still encoded, as an array in document order."""
    visible = F.regexp_replace(page, _OPAQUE, " ")
    tags = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(1))

    def first_href(tag: Column) -> Column:
        attributes = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1))
        values = F.transform(
            F.filter(attributes, lambda a: a.rlike(_HREF)),
            lambda a: F.regexp_replace(F.regexp_replace(a, _HREF, ""), r"^[\"']|[\"']$", ""),
        )
        return F.get(F.filter(values, lambda v: v != ""), F.lit(0))

    return F.filter(F.transform(tags, first_href), lambda h: h.isNotNull())
