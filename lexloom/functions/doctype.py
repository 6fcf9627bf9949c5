"""Document type from a title or from free text."""

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions.text import capitalise, col, nonblank

_CAPS = r"^((?:[A-ZÀ-ÜÇÏ]+(?:['\-][A-ZÀ-ÜÇÏ]+)*[,.:;()\[\]\"]*\s+)*[A-ZÀ-ÜÇÏ]+(?:['\-][A-ZÀ-ÜÇÏ]+)*)(?=[,.:;()\[\]\"]*(?:\s|$))"


def type_from_title(c, types=rules.TITLE_TYPES):
    """PRJ16: known leading type (of ``types``), else the leading run of capitals, else 'Other'."""
    c, leading = col(c), rf"(?iU)^({rules.longest_first(types)})\b"
    t = F.regexp_replace(F.trim(c), "^[ '\"\\-]+", "")
    known = F.upper(F.regexp_extract(t, leading, 1))
    caps = F.trim(F.regexp_replace(F.regexp_extract(t, _CAPS, 1), r"[,.:;()\[\]\"]+(\s|$)", "$1"))
    return (F.when(nonblank(c).isNull(), "Unknown").when(known != "", known)
            .when(caps != "", F.upper(F.regexp_replace(caps, r"\s+", " "))).otherwise("Other"))


def filled_type(type_col, title, force=False):
    """Keep a usable type; infer the rest (or all, when forced) from the title."""
    keep = F.coalesce(~col(type_col).isin("", "Unknown", "Other"), F.lit(False)) & F.lit(not force)
    return F.when(keep, col(type_col)).otherwise(type_from_title(title))


def type_from_text(c, kinds=rules.TEXT_TYPE_RULES):
    """PRJ17: first matching rule (pattern, type) over free text, NULL when none matches."""
    c, out = col(c), None
    for pattern, name in kinds:
        hit = c.rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def type_from_prefix(c, kinds=rules.PREFIX_TYPE_RULES):
    """PRJ18: archived rules (beginnings, type) on how the title starts, first word otherwise."""
    c = col(c)
    t = F.upper(F.trim(c))
    out = F.when(nonblank(c).isNull(), "Unknown")
    for starts, name in kinds:
        hit = F.lit(False)
        for s in starts:
            hit = hit | t.startswith(s)
        if name == "Decret":
            head20, head25 = F.substring(t, 1, 20), F.substring(t, 1, 25)
            out = out.when(hit & (head20.contains("LLEI") | head20.contains("LEY")), "Decret llei")
            out = out.when(hit & (head25.contains("LEGISLATIU") | head25.contains("LEGISLATIVO")),
                           "Decret legislatiu")
        out = out.when(hit, name)
    word = F.regexp_replace(F.regexp_extract(c, r"(?U)(\S+)", 1), "^[,.:;()\\[\\]'\"]+|[,.:;()\\[\\]'\"]+$", "")
    return out.when(F.length(word) > 2, capitalise(word)).otherwise("Other")
