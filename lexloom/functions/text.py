"""Column expressions for missing values and match keys."""

from pyspark.sql import Column, functions as F

from lexloom import rules


def col(c):
    return c if isinstance(c, Column) else F.col(c)


def bind(value, use):
    """``use(value)`` with the value computed once however often it is mentioned."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def nonblank(c):
    """NULL for a missing or blank string; anything else unchanged."""
    c = col(c).cast("string")
    return F.when(F.trim(c) != "", c)


def present(c):
    """``nonblank`` that also treats the literal 'None'/'Unknown' as missing."""
    c = nonblank(c)
    return F.when(~F.trim(c).isin(rules.SENTINELS), c)


def first_nonblank(*cols):
    return F.coalesce(*[nonblank(c) for c in cols])


def or_empty(c):
    return F.coalesce(nonblank(c), F.lit(""))


def squeeze(c):
    """Collapse runs of whitespace to one space and trim."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def fold_accents(c):
    """Latin letters to their ASCII base; every other non-ASCII character dropped."""
    return F.regexp_replace(F.translate(col(c), rules.ACCENTED, rules.UNACCENTED), r"[^\x00-\x7F]", "")


def capitalise(c):
    """First character upper, the rest lower (unlike ``initcap``, one word only)."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def text_key(c):
    """PRJ2: lower case, punctuation to spaces, single spaces."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"(?U)[^\w\s]", " "))


def _strip_prefixes(c, prefixes):
    for p in prefixes:
        c = F.trim(F.regexp_replace(c, "^" + p, ""))
    return c


def title_key(c):
    """PRJ1: ``text_key`` then leading type words removed in sequence, no word boundary."""
    return _strip_prefixes(text_key(c), rules.TITLE_PREFIXES)


def org_key(c):
    """PRJ15: ``title_key`` then institution prefixes removed."""
    return _strip_prefixes(title_key(c), rules.ORG_PREFIXES)


def alnum_key(c):
    """PRJ3: lower case letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), r"[^a-z0-9à-üçï]", "")


def entity_key(c):
    """PRJ4: lower case, punctuation other than '/' dropped, single spaces."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(col(c).cast("string"), F.lit(""))),
                                    r"(?U)[^\w\s/]", ""))


def eli_key(c):
    """PRJ5: identifier path without scheme, host, leading 'eli/' and trailing '/dof…'."""
    c = F.trim(F.lower(F.coalesce(col(c), F.lit(""))))
    c = F.regexp_replace(c, rules.PATH_HOST, "")
    c = F.regexp_replace(c, rules.PATH_LEAD, "")
    c = F.regexp_replace(c, rules.PATH_TAIL, "")
    return F.regexp_replace(c, r"^/+|/+$", "")


def section_key(c):
    """PRJ6: compact section title, e.g. 'Artículo 1' and 'Article 1' -> 'article1'."""
    c = F.lower(F.coalesce(col(c), F.lit("")))
    for word in rules.ARTICLE_SPELLINGS:
        c = F.replace(c, F.lit(word), F.lit("article"))
    return F.regexp_replace(fold_accents(c), "[^a-z0-9]", "")


def section_words(c):
    """PRJ7: section title as words, with synonyms reduced to art / sec / annex."""
    c = F.trim(F.lower(F.coalesce(col(c), F.lit(""))))
    for pattern, word in rules.SECTION_SYNONYMS:
        c = F.regexp_replace(c, pattern, word)
    return squeeze(F.regexp_replace(c, r"(?U)[^\w\s]", ""))


def label_name(c):
    """PRJ8: CamelCase label; 'Other' when missing, 'Type_' before a digit."""
    c = col(c)
    words = F.filter(F.split(fold_accents(c), "[^a-zA-Z0-9]+"), lambda w: w != "")
    camel = F.array_join(F.transform(words, capitalise), "")
    known = c.isNotNull() & ~F.lower(c).isin("unknown", "other", "none", "")
    return (F.when(~F.coalesce(known, F.lit(False)) | (camel == ""), "Other")
            .when(camel.rlike("^[0-9]"), F.concat(F.lit("Type_"), camel)).otherwise(camel))


def slug(c):
    """PRJ9: ASCII words joined by '_'."""
    c = F.lower(fold_accents(F.coalesce(col(c).cast("string"), F.lit(""))))
    return F.regexp_replace(F.regexp_replace(c, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def article_number(c):
    """PRJ23: ordinal words one to five become digits, 'únic' stays a word."""
    words = {**rules.ARTICLE_NUMBERS, "únic": "Únic", "único": "Únic"}
    known = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
    return bind(F.lower(F.trim(F.coalesce(col(c), F.lit("")))), lambda n: F.coalesce(
        F.try_element_at(known, n), F.when(n.rlike(r"(?U)^[\p{L}\p{N}]+$"), F.upper(n)).otherwise(n)))


def article_from_title(c):
    """PRJ24: article token of a section title."""
    return capitalise(F.nullif(F.regexp_extract(
        col(c), r"(?iU)\b(?:article|artículo|art\.?)\s+([0-9a-zA-Z\-]+)", 1), F.lit("")))


def descriptor_name(c):
    """PRJ25: name without a trailing '(digits)' id."""
    return F.trim(F.regexp_replace(col(c), r"\s*\(\d+\)\s*$", ""))


def clean_cited_title(title, article=None):
    """PRJ27: drop a leading 'article N of the …' phrase from a cited title."""
    s = F.trim(F.regexp_replace(F.trim(F.coalesce(col(title), F.lit(""))), rules.LEAD_PHRASE, ""))
    if article is None:
        return s
    art = F.coalesce(col(article), F.lit(""))
    art_words = section_words(art)
    rest = F.substring(s, F.length(art) + 1, F.length(s))
    hit = ((art_words != "") & F.startswith(section_words(s), art_words)
           & (F.lower(F.substring(s, F.lit(1), F.length(art))) == F.lower(art))
           & rest.rlike(rules.LEAD_CONNECTOR))
    return F.when(hit, F.trim(F.regexp_replace(rest, rules.LEAD_CONNECTOR, ""))).otherwise(s)


def bilingual(*cols):
    """PRJ34: first language version that is not blank."""
    return first_nonblank(*cols)


def link_to_text(html, pdf, fallback=None):
    """PRJ22: first non-blank link, trimmed."""
    cs = [html, pdf] + ([fallback] if fallback is not None else [])
    return F.trim(first_nonblank(*cs))
