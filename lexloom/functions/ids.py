"""Dates, years, issue numbers and identifier paths."""

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions.text import col, first_nonblank, nonblank


def _part(c, pattern, group):
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def date_parts(c, mode="anchored"):
    """PRJ10: (year, month, day) strings, '0000'/'00' for what is unknown.

    ``anchored`` wants the whole value to be a date; ``anywhere`` searches inside it.
    """
    c = F.trim(F.coalesce(col(c).cast("string"), F.lit("")))
    if mode == "anchored":
        dmy, ymd, yr = r"^(\d{1,2})/(\d{1,2})/(\d{4})$", r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"(?U)\b(\d{4})\b"
    else:
        dmy, ymd = r"(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})", r"(\d{4})[/\-](\d{1,2})[/\-](\d{1,2})"
        yr = r"(?U)\b(19\d\d|20\d\d)\b"
    two = lambda x: F.lpad(x, 2, "0")
    year = F.coalesce(_part(c, dmy, 3), _part(c, ymd, 1), _part(c, yr, 1), F.lit("0000"))
    month = F.coalesce(two(_part(c, dmy, 2)), two(_part(c, ymd, 2)), F.lit("00"))
    day = F.coalesce(two(_part(c, dmy, 1)), two(_part(c, ymd, 3)), F.lit("00"))
    return year, month, day


def iso_date(c):
    """PRJ11: cut at 'T'; 'D/M/YYYY' to ISO; otherwise unchanged."""
    c = F.split_part(F.trim(col(c)), F.lit("T"), F.lit(1))
    p = F.split(c, "/")
    slashed = (F.size(p) == 3) & (F.length(F.get(p, F.lit(2))) == 4)
    pad = lambda x: F.when(F.length(x) >= 2, x).otherwise(F.lpad(x, 2, "0"))
    return F.when(slashed, F.concat_ws("-", F.get(p, F.lit(2)), pad(F.get(p, F.lit(1))),
                                       pad(F.get(p, F.lit(0))))).otherwise(c)


def publication_year(date, url):
    """PRJ12: year of the date, else of a '/YYYY/MM/DD/' URL, else 0."""
    y = F.coalesce(_part(F.coalesce(col(date), F.lit("")), r"^(\d{4})", 1),
                   _part(F.coalesce(col(url), F.lit("")), r"/(\d{4})/\d{2}/\d{2}/", 1))
    return F.coalesce(y.try_cast("int"), F.lit(0))


def leading_year(c):
    """First four characters as a year, 0 when they are not digits."""
    return F.coalesce(_part(F.coalesce(col(c), F.lit("")), r"^(\d{4})", 1).try_cast("int"), F.lit(0))


def url_doc_id(c):
    """PRJ13: documentId query parameter."""
    return F.nullif(F.try_parse_url(F.trim(col(c)), F.lit("QUERY"), F.lit("documentId")), F.lit(""))


def issue_number(url, fallback):
    """PRJ14: numeric fallback, else the number in one of three URL shapes."""
    u, f = F.coalesce(col(url), F.lit("")), col(fallback).cast("string")
    return F.coalesce(F.when(f.rlike(r"^\d+$"), f), _part(u, r"/PDF/(\d+)/", 1),
                      _part(u, r"numDOGC=(\d+)", 1),
                      F.nullif(F.regexp_replace(F.regexp_extract(u, r"DOGC_\d{8}_(\d+)_", 1),
                                                r"^0+(?=\d)", ""), F.lit("")))


def module_prefix(c):
    """PRJ21: short identifier prefix of a local-index module."""
    t = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    clean = F.regexp_replace(F.substring(t, 1, 8), "[^a-z0-9]", "")
    out = F.when(t == "", "cido-doc")
    for mark, prefix in rules.MODULE_PREFIXES:
        out = out.when(t.contains(mark), prefix)
    return out.when(clean == "", "cido-doc").otherwise(F.concat(F.lit("cido-"), clean))


def language_twin(c):
    """PRJ26: address of the Spanish version of a Catalan page."""
    c = col(c)
    return (F.when(c.contains("/ca/"), F.replace(c, F.lit("/ca/"), F.lit("/es/")))
            .when(c.contains("/cat/"), F.replace(c, F.lit("/cat/"), F.lit("/spa/"))).otherwise(c))


def eli_path(kind, parts, ident, given=None):
    """PRJ20: identifier path 'eli/es-cat/<kind>/Y/M/D/<id>'; a given identifier wins."""
    path = F.concat_ws("/", F.lit("eli/es-cat"), *([kind] if not isinstance(kind, str) else [F.lit(kind)]),
                       *parts, col(ident).cast("string"))
    return path if given is None else F.coalesce(nonblank(given), path)


def issue_year(date, year):
    """Date parts of a document, the year column standing in when the date has none."""
    y, m, d = date_parts(date)
    return F.when(y == "0000", F.coalesce(first_nonblank(year), F.lit("0000"))).otherwise(y), m, d
