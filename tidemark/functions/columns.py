"""Scalar functions as column expressions: text, lists, buckets, vectors, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds in seconds of recency buckets 0..8; older is 9.
RECENCY_BOUNDS = [
    10 * 60,
    60 * 60,
    24 * 60 * 60,
    7 * 24 * 60 * 60,
    30 * 24 * 60 * 60,
    365 * 24 * 60 * 60,
    3 * 365 * 24 * 60 * 60,
    5 * 365 * 24 * 60 * 60,
    10 * 365 * 24 * 60 * 60,
]
# First number in a price text; date in a snapshot file name.
PRICE_PATTERN = r"\b((?:\d+\.\d*)|(?:\d+))\b"
SNAPSHOT_PATTERN = r"_upto_(\d{4})_(\d{2})_(\d{2})(?:_\d{6})?\.parquet$"
WHITE_SPACE = " \t\n\r\x0b\x0c"
MONTH_PATTERN = r"year_month=(\d{4}-\d{2})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recency_bucket(age: Column | str) -> Column:
    """0..9 for an age in seconds; negative ages fall in 0."""
    age = _col(age)
    bucket = F.when(age < RECENCY_BOUNDS[0], 0)
    for number, bound in enumerate(RECENCY_BOUNDS[1:], start=1):
        bucket = bucket.when(age < bound, number)
    return bucket.otherwise(len(RECENCY_BOUNDS))


def recency_buckets(times: Column | str, now: Column, pad: int = -1) -> Column:
    """Bucket a list of epoch seconds against ``now``; padding stays as it is."""
    return F.transform(_col(times), lambda x: F.when(x == pad, F.lit(pad)).otherwise(recency_bucket(now - x)))


def price_number(text: Column | str) -> Column:
    """First number in a price text as DOUBLE; NULL without one."""
    found = F.nullif(F.regexp_extract(_col(text), PRICE_PATTERN, 1), F.lit(""))
    return found.try_cast("double")


def snapshot_date(path: Column | str) -> Column:
    """Date in a file name that ends in _upto_YYYY_MM_DD.parquet; NULL for others."""
    part = lambda i: F.regexp_extract(_col(path), SNAPSHOT_PATTERN, i)
    return F.concat_ws("-", part(1), part(2), part(3)).try_cast("date")


def month_of_path(path: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(path), MONTH_PATTERN, 1), F.lit(""))


def millis_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_millis(_col(c).cast("bigint"))


def year_month(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def as_float(c: Column | str) -> Column:
    """Null-safe number: what does not parse is 0."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def as_text(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def joined_lines(c: Column | str) -> Column:
    """Array of sentences as lines; NULL is ''."""
    return F.coalesce(F.array_join(_col(c), "\n"), F.lit(""))


def parsed_tags(text: Column | str, n: int = 5) -> Column:
    """First ``n`` comma-separated tags, trimmed of any white space."""
    strip = lambda t: F.trim(t, F.lit(WHITE_SPACE))
    return F.slice(F.transform(F.split(strip(_col(text)), ","), strip), 1, n)


def top_tags(tags: Column | str, n: int = 5) -> Column:
    return F.array_join(F.slice(_col(tags), 1, n), ", ")


def id_list(text: Column | str, separator: str = ",") -> Column:
    """Split a joined id list; NULL and '' give an empty list."""
    known = F.nullif(_col(text), F.lit(""))
    return F.coalesce(F.split(known, separator), F.array().cast("array<string>"))


def last_in_list(text: Column | str, separator: str = "__") -> Column:
    return F.try_element_at(id_list(text, separator), F.lit(-1))


def fixed_length(vec: Column | str, size: int = 384) -> Column:
    """Exactly ``size`` numbers: cut or zero-padded; NULL vectors and NaN become zeros."""
    known = F.coalesce(_col(vec).cast("array<double>"), F.array().cast("array<double>"))
    kept = F.slice(known, 1, size)
    clean = F.transform(kept, lambda x: F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x))
    return F.concat(clean, F.array_repeat(F.lit(0.0), size - F.size(kept)))


def replace_padding(ids: Column | str, unknown: Column | int, pad: int = -1) -> Column:
    value = unknown if isinstance(unknown, Column) else F.lit(unknown)
    return F.transform(_col(ids), lambda x: F.when(x == pad, value).otherwise(x))


def dot(a: Column | str, b: Column | str) -> Column:
    product = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def pair_score(a: Column | str, b: Column | str) -> Column:
    return sigmoid(dot(a, b))


def unit(vec: Column | str) -> Column:
    """L2-normalised vector; the zero vector stays zero."""
    wide = _col(vec).cast("array<double>")
    length = F.sqrt(dot(wide, wide))
    return F.when(length > 0, F.transform(wide, lambda x: x / length)).otherwise(wide)


def short_title(title: Column | str, width: int = 50) -> Column:
    known = F.coalesce(_col(title), F.lit("N/A"))
    return F.when(F.length(known) > width, F.concat(F.substring(known, 1, width), F.lit("..."))).otherwise(known)


def clipped(items: Column | str, count: int) -> Column:
    return F.slice(_col(items), 1, count)


def utc_stamp(ts: Column | str, pattern: str = "yyyyMMdd_HHmmss") -> Column:
    return F.date_format(_col(ts), pattern)


def recommendation_json(ids: Column | str, scores: Column | str) -> Column:
    """The published payload: {"rec_item_ids": [...], "rec_scores": [...]}."""
    return F.to_json(F.struct(_col(ids).alias("rec_item_ids"), _col(scores).alias("rec_scores")))


# Fixed value: the tagging prompt; {text} is the description.
TAG_PROMPT = """You are an expert book classifier.

Task:
Read the book description below and generate **exactly 5** concise and meaningful tags 
that best represent the book's **themes, audience, and literary type**. 
Include the **format** if relevant.

Guidelines:
- Output must contain **exactly 5 tags**, separated by commas and a space.
- Tags should be **general and conceptual** 
- Avoid using **proper names**, **book titles**, **author names**, **award names**, or any phrase appearing directly in the description.
- Do **not** include explanations, numbering, or extra text.
- The output format must strictly be:
  tag1, tag2, tag3, tag4, tag5

Description: "{text}"

Tags:
"""


def tag_prompt(text: Column | str, template: str = TAG_PROMPT) -> Column:
    before, after = template.split("{text}")
    return F.concat(F.lit(before), as_text(text), F.lit(after))
