"""Payroll rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.money import as_col, to_number


def seniority(role: Column | str, rules=K.LEVEL_RULES, default: str = K.DEFAULT_LEVEL) -> Column:
    """First rule whose pattern occurs in the role."""
    role = as_col(role)
    out = None
    for pattern, level in rules:
        hit = role.rlike("(?i)" + pattern)
        out = F.when(hit, level) if out is None else out.when(hit, level)
    return F.lit(default) if out is None else out.otherwise(default)


def is_total_row(name: Column | str) -> Column:
    return F.upper(F.trim(as_col(name))).isin("TOTAIS", "TOTAL")


def is_subtotal_row(name: Column | str, dept: Column | str, role: Column | str) -> Column:
    """Rows that carry a department total instead of a person."""
    name, dept, role = F.trim(as_col(name)), as_col(dept), as_col(role)
    no_role = F.coalesce(F.trim(role), F.lit("")) == ""
    named_as_dept = F.coalesce(F.upper(F.trim(dept)) == F.upper(name), F.lit(False))
    shouting = (F.upper(name) == name) & ~name.contains(" ")
    return no_role & (named_as_dept | shouting)


def number2(c: Column | str) -> Column:
    return F.round(to_number(c), 2)


def age(c: Column | str) -> Column:
    v = to_number(c)
    return F.when(v > 0, v.cast("int"))


def recurring_cost(total: Column, severance: Column) -> Column:
    return F.round(total - severance, 2)
