"""Company names for display, one variant per report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cleaning:
    replacements: tuple[tuple[str, str], ...]
    longest: int
    brands: tuple[tuple[str, str], ...] = ()


# Spelling fixes, brands to collapse to, and the longest name of each report variant.
CLEANING = {
    "v1": Cleaning(
        (
            ("InsuranceCompany", " Insurance Company"),
            ("MutualAutomobile", " Mutual Automobile"),
            ("andCasualty", " and Casualty"),
        ),
        40,
    ),
    "v2": Cleaning(
        (
            ("InsuranceCompany", " Insurance"),
            ("MutualAutomobile", " Mutual Auto"),
            ("andCasualty", " & Casualty"),
            ("Fire and", "Fire &"),
        ),
        25,
        (
            ("State Farm", "State Farm"),
            ("Progressive", "Progressive"),
            ("Allstate", "Allstate"),
            ("Geico", "GEICO"),
            ("GEICO", "GEICO"),
            ("Farmers", "Farmers"),
            ("Liberty Mutual", "Liberty Mutual"),
        ),
    ),
    "refined": Cleaning(
        (
            ("InsuranceCompany", " Insurance Company"),
            ("MutualAutomobile", " Mutual Automobile"),
            ("andCasualty", " and Casualty"),
            ("Fire and", "Fire &"),
            ("Property and", "Property &"),
        ),
        35,
    ),
    "v3": Cleaning((("InsuranceCompany", " Insurance"), ("MutualAutomobile", " Mutual")), 25),
}

# Initials of the brands.
BRAND_INITIALS = [
    ("State Farm", "SF"),
    ("Progressive", "PG"),
    ("Allstate", "AS"),
    ("GEICO", "GE"),
    ("Farmers", "FM"),
    ("Liberty", "LM"),
]


def shortened(text: Column, longest: int) -> Column:
    """Cut to ``longest`` characters, the last three of them dots."""
    cut = F.concat(F.substring(text, 1, longest - 3), F.lit("..."))
    return F.when(F.length(text) > longest, cut).otherwise(text)


def clean_company_name(name: Column, variant: str) -> Column:
    rules = CLEANING[variant]
    fixed = name
    for old, new in rules.replacements:
        fixed = F.replace(fixed, F.lit(old), F.lit(new))
    result = F.trim(shortened(fixed, rules.longest))
    for found, brand in reversed(rules.brands):
        result = F.when(fixed.contains(found), F.lit(brand)).otherwise(result)
    return result


def company_initials(name: Column) -> Column:
    clean = clean_company_name(name, "v2")
    words = F.filter(F.split(clean, r"\s+"), lambda w: w != "")
    result = F.when(
        F.size(words) >= 2, F.concat(F.substring(words[0], 1, 1), F.substring(F.get(words, F.lit(1)), 1, 1))
    ).otherwise(F.upper(F.substring(clean, 1, 2)))
    for found, initials in reversed(BRAND_INITIALS):
        result = F.when(clean.contains(found), F.lit(initials)).otherwise(result)
    return result


def display_company(company: Column, subsidiary: Column) -> Column:
    """Company, or the subsidiary where no company was given, or N/A."""
    given = F.when((company != "") & (company != "Not specified in document"), company)
    return F.coalesce(given, F.nullif(subsidiary, F.lit("")), F.lit("N/A"))
