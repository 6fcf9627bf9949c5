"""Line dedup: repeated runs of lines by distributed prefix doubling.

Every position of every document's line sequence is named by the first position of the corpus where the same line starts;
then by the first position of the same two lines, four, eight and so on, from the names of both halves. A name that
several positions share is an interval of the suffix order whose common prefix has that many lines at least. Positions
whose run is unique drop out, so later rounds hold repeated suffixes only. The names of a run's first and last 2^k lines
name runs of every length; the rounds end with the longest run that needs a name. Native column expressions only.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.llm.base import digest, own_name, table
from lexloom.session import cut, tune

MIN_CHARS = 30  # of a run, without white space at the ends of its lines


def _position(doc_id, line):
    """Corpus order as one number, so that the first position is a plain minimum. A NULL doc_id comes first."""
    return (F.coalesce(doc_id.cast("decimal(20,0)"), F.lit("-99999999999999999999").cast("decimal(20,0)")) * F.lit(10 ** 10).cast("decimal(11,0)") + line.cast("decimal(10,0)")).cast("decimal(38,0)")


def _repeated(rows, keys):
    """Rows whose keys occur more than once, with the first position of their class instead of the keys."""
    classes = rows.groupBy(*keys).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return rows.join(classes, keys)


def _windows(level, min_chars):
    """The shortest runs of min_chars or more characters from each line on, and up to each line: doc_id, text_key, s, n.

    Only runs of neighbouring repeated lines count. Any longer run is covered by these inside it: a line before which it
    has enough characters ends such a run, and the others lie in the one that starts it.
    """
    doc = ["doc_id", "text_key"]
    order = Window.partitionBy(*doc).orderBy("i")
    rows = level.select(*doc, "i", "chars").distinct().withColumn("island", F.col("i") - F.row_number().over(order))
    rows = rows.withColumn("after", F.sum("chars").over(Window.partitionBy(*doc, "island").orderBy("i"))).withColumn("before", F.col("after") - F.col("chars"))
    event = lambda way, value, entry, asks: F.struct(F.lit(way).alias("way"), value.alias("value"), entry.alias("entry"), asks.alias("asks"))
    none, need = F.lit(None).cast("int"), F.lit(min_chars)
    events = rows.select(*doc, "island", F.inline(F.array(
        event(0, -F.col("after"), -F.col("i"), none), event(0, -(F.col("before") + need), none, F.col("i")),
        event(1, F.col("before"), F.col("i"), none), event(1, F.col("after") - need, none, F.col("i")))))
    reach = F.max("entry").over(Window.partitionBy(*doc, "island", "way").orderBy("value", F.col("asks").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    found = events.withColumn("at", reach).filter("asks IS NOT NULL AND at IS NOT NULL")
    forward = F.col("way") == 0
    start = F.when(forward, F.col("asks")).otherwise(F.least("at", "asks"))
    end = F.when(forward, F.greatest(-F.col("at"), F.col("asks"))).otherwise(F.col("asks")) + 1
    return found.select(*doc, start.alias("s"), (end - start).alias("n")).distinct()


def repeated_runs(docs, min_chars=MIN_CHARS):
    """Maximal runs of lines to delete: doc_id, text_key, run_start, run_end (line numbers from 0, end excluded).

    A line goes if it lies in a run of any number of lines that holds at least min_chars characters and also starts at an
    earlier position: in a document with a smaller doc_id, or higher up in the same. Lines count as equal without blanks,
    tabs and carriage returns at their ends. Names are exact but for lines with equal 128-bit hashes. Documents that share
    a doc_id are not earlier than each other. Empty lines are lines; NULL texts have none; an empty table gives none.

    Runs of n lines are equal where the names of their first and last 2^k lines are, 2^k the largest power up to n.
    """
    tune(docs.sparkSession)
    line = F.btrim(F.col("line"), F.lit(" \t\r"))
    lines = cut(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
                .select("doc_id", "text_key", "i", F.xxhash64(line).alias("h"), F.xxhash64(F.lit(7), line).alias("h2"), F.length(line).cast("long").alias("chars"), _position(F.col("doc_id"), F.col("i")).alias("pos")))
    keep = ["doc_id", "text_key", "i", "pos", "h", "first"]
    level = cut(_repeated(lines, ["h", "h2"]).select(*keep, "chars"))
    windows = cut(_windows(level, min_chars))
    longest, size, spans = windows.agg(F.max("n")).first()[0] or 0, 1, []
    while size <= longest and not level.isEmpty():
        name = lambda c: level.select("doc_id", "text_key", F.col("i").alias(c), F.struct("first", "h").alias(f"{c}_name"), *([F.col("pos")] if c == "s" else [])).distinct()
        same = lambda x, y, c: x["doc_id"].eqNullSafe(y["doc_id"]) & (x["text_key"] == y["text_key"]) & (x[c] == y[c])
        asked, heads, tails = windows.filter((F.col("n") >= size) & (F.col("n") < size * 2)).withColumn("t", F.col("s") + F.col("n") - size), name("s"), name("t")
        runs = asked.join(heads, same(asked, heads, "s")).select(*[asked[c] for c in asked.columns], "s_name", "pos")
        runs = runs.join(tails, same(runs, tails, "t")).select(*[runs[c] for c in runs.columns], "t_name")
        runs = _repeated(runs.drop("t").withColumnsRenamed({"s_name": "a", "t_name": "b"}), ["n", "a", "b"])
        spans.append(cut(runs.filter(F.col("first") < F.col("pos")).select("doc_id", "text_key", "s", (F.col("s") + F.col("n")).alias("e"))))
        ahead = Window.partitionBy("doc_id", "text_key").orderBy("i").rangeBetween(size, size)
        if size * 2 <= longest:
            pairs = (level.select("*", *[F.first_value(c).over(ahead).alias(f"{c}2") for c in ("first", "h")]).filter("first2 IS NOT NULL")
                     .select("doc_id", "text_key", "i", "pos", F.xxhash64("h", "h2").alias("h"), F.col("first").alias("a"), F.col("first2").alias("b")))
            level = cut(_repeated(pairs, ["a", "b", "h"]).select(*keep))
        size *= 2
    if not spans:
        return lines.select("doc_id", "text_key", F.col("i").alias("run_start"), F.col("i").alias("run_end")).limit(0)
    marks = spans[0]
    for m in spans[1:]:
        marks = marks.unionByName(m)
    spans = marks.groupBy("doc_id", "text_key", "s").agg(F.max("e").alias("e"))
    order = Window.partitionBy("doc_id", "text_key").orderBy("s")
    spans = spans.withColumn("reach", F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("run", F.sum(F.when(F.col("s") <= F.col("reach"), 0).otherwise(1)).over(order))
    return spans.groupBy("doc_id", "text_key", "run").agg(F.min("s").alias("run_start"), F.max("e").alias("run_end")).drop("run")


def dedup(docs, min_chars=MIN_CHARS, n_lines=None, n_removed=None, n_runs=None):
    """docs with the deleted runs cut out of `text`; all other columns and rows stay. Counts are added under the names given.

    A text of which nothing is left becomes empty; a NULL text stays NULL and has no lines. Repeated rows lose the same lines.
    """
    runs = repeated_runs(docs.select("doc_id", "text"), min_chars)
    names = [own_name(docs, c) for c in ("line_doc", "line_key", "line_runs")]
    per = runs.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("run_start", "run_end"))).alias("r")).toDF(*names)
    doc, key, held = (F.col(n) for n in names)
    out = docs.join(per, F.col("doc_id").cast("long").eqNullSafe(doc) & (F.xxhash64("text") == key), "left")
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda x, i: ~F.exists(held, lambda r: (r["run_start"] <= i) & (i < r["run_end"])))
    text = F.when(held.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    gone = F.coalesce(F.aggregate(held, F.lit(0), lambda a, r: a + r["run_end"] - r["run_start"]), F.lit(0))
    more = {n_lines: F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)), n_removed: gone, n_runs: F.when(held.isNull(), 0).otherwise(F.size(held))}
    return out.select(*[text.alias(c) if c == "text" else c for c in docs.columns], *[v.alias(n) for n, v in more.items() if n])


def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup(docs, n_lines="n_lines", n_removed="n_removed", n_runs="n_runs")
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", digest(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS raw FROM documents),
t AS (SELECT doc_id, raw, list_transform(raw, lambda x: trim(x, ' ' || chr(9) || chr(13))) AS l FROM d),
p AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM t),
k AS (SELECT doc_id, i, hash(line) AS h, length(line) AS c, count(*) OVER (PARTITION BY line) > 1 AS again FROM p),
island AS (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g, i, h, c FROM k WHERE again),
y AS (SELECT doc_id, min(i) AS low, list(h ORDER BY i) AS h, list(c ORDER BY i) AS c FROM island GROUP BY doc_id, g),
s AS (SELECT *, unnest(range(1, len(h) + 1)) AS a FROM y),
w AS (SELECT doc_id, low + a - 1 AS i, size, h[a:a + size - 1] AS run, list_sum(c[a:a + size - 1]) AS chars FROM (SELECT *, unnest(range(1, len(h) - a + 2)) AS size FROM s)),
f AS (SELECT doc_id, i, size, chars, min({'d': doc_id, 'i': i}) OVER (PARTITION BY run) AS first FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM f WHERE chars >= 30 AND first < {'d': doc_id, 'i': i}),
lines AS (SELECT doc_id, unnest(raw) AS line, unnest(range(1, len(raw) + 1)) AS i FROM d),
m AS (SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS gone FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens FROM m),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_runs,
             string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::INT AS n_lines, coalesce(n_removed, 0)::INT AS n_removed, coalesce(n_runs, 0)::INT AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""
