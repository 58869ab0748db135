"""Text rules: names, codes, tokens, searches."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.money import as_col

CODE_PREFIX = r"^\d+(\.\d+)+ - "
TOKEN_CHARS = r"[^a-záàâãéèêíóôõúüçñ0-9]"


def strip_code_prefix(c: Column | str) -> Column:
    """'2.01.03 - Mão de Obra' -> 'Mão de Obra'."""
    return F.trim(F.regexp_replace(as_col(c), CODE_PREFIX, ""))


def category_group(c: Column | str) -> Column:
    """First two dotted levels of a category code; empty -> NULL."""
    return F.substring_index(F.nullif(as_col(c), F.lit("")), ".", 2)


def or_default(c: Column | str, default: str) -> Column:
    return F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit(default))


def status_code(c: Column | str) -> Column:
    return F.upper(F.coalesce(as_col(c), F.lit("")))


def is_direct_inflow(category_name: Column | str) -> Column:
    return F.lower(F.coalesce(as_col(category_name), F.lit(""))).contains("faturamento direto")


def is_direct_outflow(document: Column | str, fiscal: Column | str | None = None) -> Column:
    hit = F.lower(F.coalesce(as_col(document), F.lit(""))).contains("fd")
    if fiscal is not None:
        hit = hit | F.lower(F.coalesce(as_col(fiscal), F.lit(""))).contains("fd")
    return hit


def modality(is_direct: Column | str) -> Column:
    return F.when(as_col(is_direct), K.DIRECT).otherwise(K.NORMAL)


def modality_or_flag(stored: Column | str, is_direct: Column | str) -> Column:
    """Stored modality, or the flag where the column is empty."""
    return F.coalesce(F.nullif(as_col(stored), F.lit("")), modality(F.coalesce(as_col(is_direct), F.lit(False))))


def pick(c: Column | str, mapping: dict) -> Column:
    """Value of a short constant mapping; NULL for unknown keys. A CASE compiles better than a map lookup."""
    c = as_col(c)
    out = F
    for k, v in mapping.items():
        out = out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(None))


def from_map(c: Column | str, mapping: dict[str, str]) -> Column:
    """Label of a code; unknown codes pass through."""
    return F.coalesce(pick(c, mapping), as_col(c))


def order_stage(c: Column | str) -> Column:
    return from_map(F.coalesce(as_col(c).cast("string"), F.lit("")), K.ORDER_STAGES)


def account_type(c: Column | str) -> Column:
    return from_map(c, K.ACCOUNT_TYPES)


def flag(c: Column | str) -> Column:
    """'S' -> true; missing counts as 'N'."""
    return F.coalesce(as_col(c), F.lit("N")) == "S"


def keep_account(c: Column | str, ignored=K.IGNORED_ACCOUNTS, keep_null: bool = True) -> Column:
    """Account not on the ignore list. NULL accounts stay in the ledger, not in balances."""
    c = as_col(c)
    if not ignored:
        return F.lit(True) if keep_null else c.isNotNull()
    return F.coalesce(~c.isin(*ignored), F.lit(keep_null))


def contains_all(c: Column | str, words: list[str]) -> Column:
    """Each word occurs somewhere in the text, in any order, ignoring case."""
    text = F.lower(as_col(c))
    return reduce(lambda a, b: a & b, [text.contains(w.lower()) for w in words], F.lit(True))


def contains_folded(c: Column | str, needle: str) -> Column:
    """Contains, ignoring case and accents ('mao de obra' finds 'Mão de Obra')."""
    return F.contains(F.collate(as_col(c), "UNICODE_CI_AI"), F.collate(F.lit(needle), "UNICODE_CI_AI"))


def name_matches(c: Column | str, pattern: str) -> Column:
    return as_col(c).rlike("(?i)" + pattern)


def question_tokens(question: str, stopwords=K.STOPWORDS) -> list[str]:
    """Search words of one question: longer than two letters, no domain words, letters and digits only."""
    words = [w for w in question.lower().split() if len(w) > 2 and w not in stopwords]
    return [t for t in (re.sub(TOKEN_CHARS, "", w) for w in words) if t]


def tokens(c: Column | str, stopwords=K.STOPWORDS) -> Column:
    """Same rule as ``question_tokens`` over a column of questions."""
    words = F.split(F.trim(F.lower(as_col(c))), r"\s+")
    stop = F.array(*[F.lit(w) for w in stopwords])
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w))
    clean = F.transform(kept, lambda w: F.regexp_replace(w, TOKEN_CHARS, ""))
    return F.filter(clean, lambda w: w != "")
