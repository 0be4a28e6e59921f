"""Similarity of texts, token sets, tool trajectories and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word token is a run of letters and digits of the lower-cased text.
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def token_overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """Sizes of the intersection and the union of two token arrays as sets."""
    return F.size(F.array_intersect(a, b)).cast("long"), F.size(F.array_union(a, b)).cast("long")


def jaccard(a: Column, b: Column) -> Column:
    """|A∩B| / |A∪B| of the token sets; two empty texts have no similarity."""
    both, either = token_overlap(tokens(a), tokens(b))
    return F.when(either > 0, both / either)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0).cast("double"), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; a zero vector has none."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


# How actual tool names are held against the expected ones.
MODES = ("strict", "unordered", "superset", "subset")


def _covers(big: Column, small: Column) -> Column:
    """Every name of ``small`` occurs in ``big`` at least as often."""
    return F.forall(
        F.array_distinct(small),
        lambda name: F.size(F.filter(big, lambda x: x == name)) >= F.size(F.filter(small, lambda x: x == name)),
    )


def trajectory(actual: Column, expected: Column, mode: str) -> Column:
    """Strict compares in order; the other modes compare with multiplicity. An empty expectation
    says that no tools are called."""
    actual = F.coalesce(actual, F.array().cast("array<string>"))
    return {
        "strict": lambda: actual == expected,
        "unordered": lambda: F.array_sort(actual) == F.array_sort(expected),
        "superset": lambda: _covers(actual, expected),
        "subset": lambda: _covers(expected, actual),
    }[mode]()


def merge_judges(j1: Column, j2: Column, j3: Column, pass_mark: float = 5.0) -> Column:
    """Judge 1 alone; two that agree (same side of the mark, at most 1 apart) give their mean; else
    the third breaks the tie and the median of three counts."""
    agree = ((j1 >= pass_mark) == (j2 >= pass_mark)) & (F.abs(j1 - j2) <= 1)
    median = j1 + j2 + j3 - F.greatest(j1, j2, j3) - F.least(j1, j2, j3)
    return F.when(j2.isNull(), j1.cast("double")).when(agree | j3.isNull(), (j1 + j2) / 2.0).otherwise(median.cast("double"))


def judge_prompt(template: Column, values: dict[str, Column], criteria: Column) -> Column:
    """Fill ``{name}`` placeholders of a template and append the criteria."""
    filled = template
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return F.when(F.coalesce(criteria, F.lit("")) == "", filled).otherwise(F.concat(filled, F.lit("\n\n"), criteria))
