"""Fill-in-the-middle: texts cut in three and put together in another order, by one counted regular expression.

A text is a sequence of units. `regexp_count` gives their number; two hash values of the id choose the cuts a <= b; the
row's own pattern takes unit{a}, unit{b - a} and the rest as three groups of one match, whose replacement writes the
output. Possessive counts never give a unit back, so a match is one pass without a stack, whatever the text's length.
"""

import re

from pyspark.sql import functions as F

from lexloom.llm.base import digest, own_name, table
from lexloom.session import tune

UNIT = "[A-Za-z]++|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, SPM = 10, 20  # percent of the documents; of the others, percent with the suffix first
SALT = "1:"


def _hash(doc_id, salt):
    """The first four 32-bit numbers of the SHA-256 of salt and id; a NULL id counts as an empty one."""
    hexes = F.sha2(F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.transform(F.array(*map(F.lit, (1, 9, 17, 25))), lambda i: F.conv(hexes.substr(i, F.lit(8)), 16, 10).cast("long"))


def _order(form, marks):
    """Marks and groups of the output, in its order: mark, group."""
    p, s, m = marks
    return {"psm": [(p, 1), (s, 3), (m, 2)], "spm": [(s, 3), (p, 1), (m, 2)]}[form]


def _replacement(form, marks):
    return "".join(re.sub(r"([\\$])", r"\\\1", mark) + f"${group}" for mark, group in _order(form, marks))


def transform(docs, output="output", form="form", n="n", prefix="prefix_chars", middle="middle_chars", unit=UNIT, marks=MARKS, plain=PLAIN, spm=SPM, salt=SALT):
    """docs (doc_id, text, ...) with the columns named: output, form, number of units, code points of prefix and middle.

    Form is `plain` (output is the text, no lengths) for empty texts, texts that hold a mark, and `plain` percent of the
    ids; else `spm` for `spm` percent, else `psm`. `unit` is a Java pattern that matches any text piece by piece. NULL
    texts count as empty. The choice follows the id alone: repeated rows get the same output, NULL ids count as an empty
    id. Other columns stay, but for one that has a new column's name in any case: it is replaced. No rows give no rows.
    """
    tune(docs.sparkSession)
    new = [output, form, n, prefix, middle]
    stay = [c for c in docs.columns if c.lower() not in {x.lower() for x in new}]
    text, h, cuts = (own_name(docs, c) for c in ("fim_text", "fim_hash", "fim_cuts"))
    rows = docs.withColumns({text: F.coalesce("text", F.lit("")), h: _hash(F.col("doc_id"), salt)})
    rows = rows.withColumn(n, F.regexp_count(text, F.lit(unit)).cast("long"))
    at = lambda i: F.pmod(F.col(h)[i], F.col(n) + 1)
    held = F.lit(False)
    for mark in marks:
        held |= F.contains(text, F.lit(mark))
    kind = F.when((F.col(text) == "") | held | (F.col(h)[2] % 100 >= 100 - plain), "plain").when(F.col(h)[3] % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumns({cuts: F.sort_array(F.array(at(0), at(1))), form: kind})
    a, b = F.col(cuts)[0], F.col(cuts)[1]
    pattern = F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), a, F.lit(rf"}}+)((?:{unit}){{"), b - a, F.lit(r"}+)(.*)\z"))
    replacement = F.when(F.col(form) == "spm", _replacement("spm", marks)).otherwise(_replacement("psm", marks))
    rows = rows.withColumn(output, F.when(F.col(form) == "plain", F.col(text)).otherwise(F.regexp_replace(text, pattern, replacement)))
    first, second, third = (F.instr(output, F.lit(mark)) for mark in marks)
    ends = F.when(F.col(form) == "spm", third).otherwise(second)  # the mark after the prefix
    rows = rows.withColumns({
        prefix: F.when(F.col(form) != "plain", ends - first - len(marks[0])).cast("long"),
        middle: F.when(F.col(form) != "plain", F.length(output) - third - len(marks[2]) + 1).cast("long")})
    return rows.select(*stay, *new)


def restore(output, form, marks=MARKS):
    """The text that transform made `output` of; every mark stands once in it, unless the form is plain."""
    back = output
    for kind in ("psm", "spm"):
        order = _order(kind, marks)
        pattern = r"(?s)\A" + "".join(rf"{re.escape(mark)}(.*)" for mark, _ in order) + r"\z"
        groups = [g for _, g in order]
        back = F.when(form == kind, F.regexp_replace(output, F.lit(pattern), F.lit("".join(f"${groups.index(g) + 1}" for g in (1, 2, 3))))).otherwise(back)
    return back


def op13_fill_in_middle(spark, sf_dir):
    out = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                      digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
             list_transform([1, 9, 17, 25], lambda i: ('0x' || h[i:i + 7])::BIGINT) AS h FROM d),
c AS (SELECT *, len(t) AS n, least(h[1] % (len(t) + 1), h[2] % (len(t) + 1)) AS a, greatest(h[1] % (len(t) + 1), h[2] % (len(t) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(t[1:a], ''), '') AS pre, coalesce(array_to_string(t[a + 1:b], ''), '') AS mid, coalesce(array_to_string(t[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
