"""Predicates and expressions over titles. A null title matches nothing and stays null."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def _any(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def contains_any(title: Column, parts: Iterable[str]) -> Column:
    """Whether a part occurs anywhere in title, case-sensitive; false for null."""
    return F.coalesce(_any(title.contains(p) for p in parts), F.lit(False))


def is_semantic(title: Column, deny: Iterable[str] = fixed.NOT_SEMANTIC) -> Column:
    return ~contains_any(title, deny)


def matches_parts(title: Column, parts: Iterable[str]) -> Column:
    """Lower-cased title against parts as they are: a part with a capital never matches."""
    return contains_any(F.lower(title), parts)


def java_regex(patterns: Iterable[str]) -> str:
    """One expression that finds any of patterns, without regard to case and with Unicode classes."""
    return "(?iuU)(?:" + "|".join(patterns) + ")"


def is_maintenance(title: Column, extra: Iterable[str] = ()) -> Column:
    return F.coalesce(title.rlike(java_regex([*fixed.MAINTENANCE, *extra])), F.lit(False))


def underscored(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit("_"))


def same_title(title: Column, query: str) -> Column:
    """Equal without regard to case, spaces as underscores."""
    return F.lower(title) == query.replace(" ", "_").lower()


def first_keyword(title: Column, keywords: Iterable[str]) -> Column:
    """The first of keywords in the lower-cased title, or null."""
    low = F.lower(title)
    return F.coalesce(*(F.when(low.contains(k), F.lit(k)) for k in keywords))


def is_penalized(title: Column) -> Column:
    return contains_any(title, fixed.PENALIZED)


def infer_domain(title: Column) -> Column:
    """The domain of the first keyword, in the order of the list, that occurs in the lower-cased title."""
    low = F.lower(title)
    return F.coalesce(*(F.when(low.contains(k), F.lit(d)) for k, d in fixed.DOMAIN_KEYWORDS))


def normal_title(title: Column) -> Column:
    return F.translate(F.lower(title), " -", "__")


def category_node(category_id: Column) -> Column:
    return F.concat(F.lit("cat_"), category_id.cast("string"))


def page_node(page_id: Column) -> Column:
    return F.concat(F.lit("page_"), page_id.cast("string"))


def in_out_ratio(in_degree: Column, out_degree: Column) -> Column:
    return in_degree / (out_degree + 1)


def normalized_depth(depth: Column, max_depth: Column) -> Column:
    return F.when(max_depth > 0, depth / max_depth).otherwise(F.lit(0.0))


def specificity(total: Column) -> Column:
    """1 / log1p(total); 1 where there is nothing below."""
    return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(1.0) / F.log1p(total.cast("double")))


def to_int(value: Column) -> Column:
    """A dump field as a number; NULL, the empty field and what is no number become null."""
    return F.when(value.isin("NULL", ""), F.lit(None)).otherwise(value.try_cast("bigint"))


def to_str(value: Column) -> Column:
    """A dump field as text; NULL becomes null, quoted or not."""
    return F.nullif(value, F.lit("NULL"))


def keyword_pattern(words: Iterable[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def parse_answers(text: Column) -> Column:
    """The array of (title, visual) between the first [ and the last ] of an answer; null if there is none."""
    return F.from_json(F.nullif(F.regexp_extract(text, r"(?s)(\[.*\])", 1), F.lit("")), "array<struct<title:string,visual:boolean>>")


def align_answers(titles: Column, answers: Column) -> Column:
    """A verdict for each title: by place if there are as many answers as titles, else by title, else null."""
    by_title = F.map_from_entries(F.array_distinct(F.transform(F.filter(F.coalesce(answers, F.array().cast("array<struct<title:string,visual:boolean>>")), lambda a: a["title"].isNotNull()), lambda a: F.struct(underscored(a["title"]).alias("k"), F.coalesce(a["visual"], F.lit(False)).alias("v")))))
    placed = F.transform(titles, lambda t, i: F.struct(t.alias("title"), F.get(answers, i)["visual"].alias("visual")))
    matched = F.transform(titles, lambda t: F.struct(t.alias("title"), F.try_element_at(by_title, underscored(t)).alias("visual")))
    return F.when(F.size(answers) == F.size(titles), placed).otherwise(matched)
