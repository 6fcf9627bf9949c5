"""HTML, markdown and model-answer text as column expressions."""

from pyspark.sql import functions as F

from lexloom.functions.text import col, squeeze


def html_to_text(c):
    """PRJ29: tags to spaces, script and style bodies dropped."""
    c = F.regexp_replace(col(c), r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    return squeeze(F.regexp_replace(c, "<[^>]+>", " "))


def unescape(c):
    """The character entities that gazette pages use."""
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def inner_text(c):
    """Text of an HTML fragment: tags removed, entities resolved."""
    return unescape(F.regexp_replace(col(c), r"(?s)<!--.*?-->|<[^>]*>", ""))


def table_to_markdown(c):
    """PRJ30: one HTML table as markdown, rows padded to the widest, rule after row one."""
    rows = F.regexp_extract_all(col(c), F.lit(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr>|</table>|$)"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(
        F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</t[dh]>|$)"), F.lit(1)),
        lambda x: F.trim(F.replace(inner_text(x), F.lit("\n"), F.lit(" ")))))
    width = F.array_max(F.transform(cells, F.size))
    line = lambda xs: F.concat(F.lit("| "), F.array_join(xs, " | "), F.lit(" |"))
    body = F.transform(cells, lambda r: line(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))
    rule = F.array(line(F.array_repeat(F.lit("---"), width)))
    return F.when(width > 0, F.array_join(F.concat(F.slice(body, 1, 1), rule,
                                                   F.slice(body, F.lit(2), F.size(body))), "\n")).otherwise("")


def answer_body(c):
    """Model answer without reasoning and code fence."""
    c = F.trim(F.regexp_replace(col(c), r"(?s)<think>.*?</think>", ""))
    fenced = F.regexp_extract(c, r"(?is)```(?:json)?\s*(.*?)\s*```", 1)
    return F.trim(F.when(c.rlike(r"(?is)```(?:json)?\s*(.*?)\s*```"), fenced).otherwise(c))


def answer_items(c, item_schema):
    """PRJ32: array of items out of a model answer.

    Accepted in turn: a JSON list; an object whose first list value holds the items;
    a single object; a list embedded in other text.
    """
    body = answer_body(c)
    as_list = F.from_json(body, f"array<{item_schema}>", {"mode": "PERMISSIVE"})
    whole = F.try_parse_json(body)
    kind = F.schema_of_variant(whole)
    values = F.map_values(F.from_json(body, "map<string,string>"))
    inner = F.get(F.filter(values, lambda v: F.ltrim(v).startswith("[")), F.lit(0))
    embedded = F.regexp_extract(body, r"(?s)(\[\s*\{.*\}\s*\])", 1)
    one = F.array(F.from_json(body, item_schema))
    return (F.when(whole.isNull(), F.when(embedded != "", F.from_json(embedded, f"array<{item_schema}>")))
            .when(F.startswith(kind, F.lit("ARRAY")), as_list)
            .when(inner.isNotNull(), F.from_json(inner, f"array<{item_schema}>"))
            .when(F.startswith(kind, F.lit("OBJECT")), one))


def affectation_text(aff):
    """PRJ28: sentence from an editorial link.

    ``aff`` is a struct of type, conj, title, desc_text (string form) and
    desc_list (array of struct<description, titles>), either may be NULL.
    """
    e = lambda c: F.coalesce(c, F.lit(""))
    listed = F.transform(F.filter(aff["desc_list"], lambda d: F.size(F.filter(
        d["titles"], lambda t: e(t) != "")) > 0), lambda d: F.concat_ws(
            " ", e(d["description"]), F.array_join(F.transform(
                F.filter(d["titles"], lambda t: e(t) != ""), lambda t: F.trim(t)), " ")))
    desc = F.coalesce(F.trim(aff["desc_text"]), F.array_join(listed, " "), F.lit(""))
    return squeeze(F.concat_ws(" ", e(aff["type"]), desc, e(aff["conj"]), e(aff["title"])))


def body_html(body_attr, text, main_body, api_text):
    """PRJ33: attribute when it holds markup, else text, main body, API text."""
    blank = lambda c: F.nullif(F.trim(col(c)), F.lit(""))
    return F.coalesce(F.when(col(body_attr).contains("<"), col(body_attr)), blank(text),
                      blank(main_body), blank(api_text))
