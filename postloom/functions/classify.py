"""Rule-based classification of postings; every rule is a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the rules look for. Word ends are ASCII.
_B, _E = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
INTERN = rf"(?i){_B}(?:intern(?:ship)?s?|co[- ]?op|apprentice(?:ship)?){_E}"
NEW_GRAD = (
    rf"(?i){_B}(?:new ?grad(?:uate)?|university grad(?:uate)?|recent grad(?:uate)?|campus hire|graduate (?:program|scheme|engineer|analyst)"
    rf"|class of 20\d\d|early career){_E}"
)
TERM = rf"(?i){_B}(summer|fall|spring|winter)\s*'?(?:20)?(2[5-9]){_E}"
GRADUATION = rf"(?i){_B}(?:class of|graduating(?: in| by)?|expected graduation[:\s]*)\s*(20\d\d){_E}"
SPONSOR_CITIZEN = r"(?i)u\.?s\.? citizen(?:ship)?(?: is)? required|citizens? only"
SPONSOR_NO = r"(?i)not (?:able to )?sponsor|unable to sponsor|without (?:the need for )?sponsorship|no sponsorship|sponsorship is not available"
SPONSOR_YES = r"(?i)sponsorship (?:is )?available|will sponsor|able to sponsor"


def kind(title: Column, structured: Column) -> Column:
    """``intern``, ``new_grad`` or ``other``; a structured internship comes first."""
    return (
        F.when(structured == "internship", "intern")
        .when(title.rlike(INTERN), "intern")
        .when(title.rlike(NEW_GRAD), "new_grad")
        .otherwise("other")
    )


def kind_source(structured: Column) -> Column:
    return F.when(structured == "internship", "structured").otherwise("regex")


def season_terms(title: Column) -> Column:
    """Distinct season terms such as ``Summer 2026`` in the order of the title; empty for null."""
    seasons, years = (F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(TERM), i) for i in (1, 2))
    return F.array_distinct(F.zip_with(seasons, years, lambda s, y: F.concat(F.initcap(s), F.lit(" 20"), y)))


def graduation_year(title: Column, description: Column) -> Column:
    """The first year of graduation in the title, else in the first 4000 characters of the description."""
    first, second = (F.nullif(F.regexp_extract(x, GRADUATION, 1), F.lit("")) for x in (title, F.substring(description, 1, 4000)))
    return F.coalesce(first, second).cast("int")


def sponsorship(description: Column) -> Column:
    """What the end of the description says: citizenship_required, no, offers or unknown."""
    tail = F.when(F.length(description) > 8000, F.right(description, F.lit(6000))).otherwise(description)
    return (
        F.when(tail.rlike(SPONSOR_CITIZEN), "citizenship_required").when(tail.rlike(SPONSOR_NO), "no").when(tail.rlike(SPONSOR_YES), "offers").otherwise("unknown")
    )
