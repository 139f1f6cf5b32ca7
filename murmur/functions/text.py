"""Text features of a post. The text itself never leaves these expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.constants import EMBED_EXTERNAL, EMBED_IMAGES, EMBED_VIDEO, RECORD_URI_PREFIX

# Letters, numbers and underscore of any script. Java's \w covers ASCII only and
# its Unicode variant also takes combining marks.
_TAG_PATTERN = r"#([\p{L}\p{N}_]+)"
_LINK_STARTS = ("http://", "https://")


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def hashtags(text: Column) -> Column:
    """Distinct tags, case kept, in code-point order; an empty array if none."""
    found = F.regexp_extract_all(text, F.lit(_TAG_PATTERN), F.lit(1))
    # Most texts have no mark at all, and looking for it is far cheaper than matching.
    found = F.when(text.contains("#"), found).otherwise(F.array().cast("array<string>"))
    return F.sort_array(F.array_distinct(found))


def has_link(text: Column, embed_type: Column) -> Column:
    starts = [text.contains(start) for start in _LINK_STARTS]
    in_text = F.coalesce(starts[0] | starts[1], F.lit(False))
    return in_text | F.coalesce(embed_type == EMBED_EXTERNAL, F.lit(False))


def has_media(embed_type: Column) -> Column:
    return F.coalesce(embed_type.isin(EMBED_IMAGES, EMBED_VIDEO), F.lit(False))


def first_language(langs: Column) -> Column:
    return F.get(langs, F.lit(0))


def split_record_uri(uri: Column) -> Column:
    """``<scheme>://owner/collection/key`` to struct(did, record_key)."""
    path = F.substring(uri, len(RECORD_URI_PREFIX) + 1, 2**31 - 1)
    parts = F.split(path, "/")
    usable = uri.startswith(RECORD_URI_PREFIX) & (F.size(parts) >= 3)
    return F.struct(
        F.when(usable, F.get(parts, F.lit(0))).alias("did"),
        F.when(usable, F.get(parts, F.lit(2))).alias("record_key"),
    )
