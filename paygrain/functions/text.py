"""String expressions: match keys, trigram sets, multiset tokens, label rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) gives Java the Unicode meaning of \w and \s.
_EDGE_SPACE = r"(?U)^\s+|\s+$"
_SPACE_RUN = r"(?U)\s+"
_NOT_WORD = r"(?U)[^\w\s]"
# str.isspace() of Python also covers the four ASCII separators 1C-1F.
_PY_SPACE = r"\s\x1c-\x1f"
_NOT_ALNUM = rf"(?U)[^\p{{L}}\p{{N}}{_PY_SPACE}]"


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` only removes blanks)."""
    return F.regexp_replace(col, _EDGE_SPACE, "")


def _clean(col: Column) -> Column:
    return strip(F.lower(col))


def _underscore(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, _NOT_WORD, ""), _SPACE_RUN, "_")


def match_key(agency: Column, title: Column) -> Column:
    """``agency_title`` in lower case without punctuation; null if either part is null."""
    return _underscore(F.concat(_clean(agency), F.lit("_"), _clean(title)))


def title_key_regex(title: Column) -> Column:
    """Like :func:`match_key` for one column; underscores stay."""
    return _underscore(_clean(title))


def title_key_alnum(title: Column) -> Column:
    """Letters, digits and single underscores between the words; underscores of the input go."""
    kept = F.regexp_replace(F.lower(title), _NOT_ALNUM, "")
    trimmed = F.regexp_replace(kept, rf"(?U)^[{_PY_SPACE}]+|[{_PY_SPACE}]+$", "")
    return F.regexp_replace(trimmed, rf"(?U)[{_PY_SPACE}]+", "_")


def sheet_slug(name: Column, prefix: str = "lighthouse_") -> Column:
    plain = F.regexp_replace(F.lower(name), r"(?U)[^\w\s-]", "")
    return F.concat(F.lit(prefix), F.regexp_replace(plain, r"(?U)[-\s]+", "_"))


def header_or_default(value: Column, position: Column) -> Column:
    text = strip(value)
    return F.when(F.length(text) > 0, text).otherwise(
        F.concat(F.lit("col_"), position.cast("string"))
    )


def upper_like_any(col: Column, patterns: Sequence[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.upper(col).like(pattern)
    return hit


def label_by_patterns(col: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """First rule with a matching LIKE pattern gives the label, otherwise the value stays."""
    chain = F
    for patterns, label in rules:
        chain = chain.when(upper_like_any(col, patterns), F.lit(label))
    return chain.otherwise(col)


# Agency labels and their patterns, in order of precedence.
AGENCY_RULES = (
    (("%POLICE%",), "Police Department"),
    (("%FIRE%",), "Fire Department"),
    (("%EDUCATION%", "%DOE%"), "Department of Education"),
    (("%HEALTH%",), "Department of Health"),
)


def standardize_agency(col: Column, rules=AGENCY_RULES) -> Column:
    return label_by_patterns(col, rules)


def _code_point(text: Column, index: Column) -> Column:
    return F.ascii(F.substring(text, index, F.lit(1))).cast("long")


def trigram_tokens(text: Column) -> Column:
    """Set of three-letter sequences of all words, each padded with two blanks before and one
    after it; a trigram is stored as one number made of its three code points."""
    words = F.filter(
        F.split(F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}]+", " "), " "),
        lambda w: F.length(w) > 0,
    )
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.flatten(
        F.transform(
            padded,
            lambda p: F.transform(
                F.sequence(F.lit(1), F.length(p) - 2),
                lambda i: _code_point(p, i) * F.lit(1 << 42)
                + _code_point(p, i + 1) * F.lit(1 << 21)
                + _code_point(p, i + 2),
            ),
        )
    )
    return F.array_distinct(grams)


def trigram_ratio(shared: Column, left_size: Column, right_size: Column) -> Column:
    """Shared / total trigrams in single precision, the precision of the SQL ``similarity()``."""
    total = left_size + right_size - shared
    return F.when((left_size > 0) & (right_size > 0), shared.cast("double") / total).otherwise(
        F.lit(0.0)
    ).cast("float")


def trigram_similarity(a: Column, b: Column) -> Column:
    left, right = trigram_tokens(a), trigram_tokens(b)
    value = trigram_ratio(F.size(F.array_intersect(left, right)), F.size(left), F.size(right))
    return F.when(a.isNotNull() & b.isNotNull(), value)
