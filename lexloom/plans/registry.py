"""Query registry and the views over the given tables that the queries read."""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom import session
from lexloom.operators import ordered

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_RN_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"

# What the views take of the numbered table.
_RN_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]

# Views written so that Spark and the SQL check read the same text. The two numbered ones
# are windows in the SQL check and a chunked numbering in Spark.
VIEWS = {
    "lineitem_rn": f"""SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_RN_ORDER}) AS INT) AS rn FROM lineitem""",
    "orders_pos": """SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS pos FROM orders""",
    "legal_docs": """SELECT o_orderkey AS document_id, o_orderkey AS ingest_ord,
  concat(t.typ, ' ', t.num, ', de disposicions de C', CAST(o_custkey % 40 AS STRING)) AS title,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE t.typ END AS type, t.num AS document_number,
  CAST(year(o_orderdate)*1000 + dayofyear(o_orderdate) AS STRING) AS dogc_number,
  concat(lpad(CAST(day(o_orderdate) AS STRING),2,'0'),'/',lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'/',CAST(year(o_orderdate) AS STRING)) AS date_dogc,
  CAST(year(o_orderdate) AS INT) AS year,
  CASE WHEN o_orderstatus = 'F' THEN 'DISPOSICIONS' WHEN o_orderstatus = 'O' THEN 'ANUNCIS' ELSE '' END AS section,
  concat('Ajuntament de C', CAST(o_custkey % 40 AS STRING)) AS organisme,
  concat('https://gazette.example/ca/doc?documentId=', CAST(o_orderkey AS STRING)) AS html_url,
  CASE WHEN o_orderkey % 11 = 0 THEN 'None' ELSE concat('https://gazette.example/pdf/', CAST(o_orderkey AS STRING), '.pdf') END AS pdf_url
FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 'LLEI' WHEN 1 THEN 'DECRET' WHEN 2 THEN 'ORDRE' WHEN 3 THEN 'ACORD' ELSE 'ANUNCI' END AS typ,
  concat(CAST(o_orderkey % 97 + 1 AS STRING), '/', CAST(year(o_orderdate) AS STRING)) AS num FROM orders) t""",
    "legal_paras": """SELECT l_orderkey AS document_id, rn*10 AS ord, concat('Article ', CAST(rn AS STRING), '. Objecte ', CAST(l_partkey AS STRING)) AS text FROM lineitem_rn
UNION ALL SELECT l_orderkey, rn*10+1, concat('D''acord amb l''article ', CAST(rn AS STRING), ' de la Llei ', CAST(l_partkey % 120 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING), '; vist el Decret ', CAST(l_suppkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING), '. Text amb paraules') FROM lineitem_rn
UNION ALL SELECT o_orderkey, 0, concat('Atesa la proposta ', CAST(o_custkey AS STRING)) FROM orders
UNION ALL SELECT o_orderkey, 5, concat('Capítol ', CAST(o_orderkey % 9 + 1 AS STRING)) FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 7, concat('Barcelona, ', CAST(day(o_orderdate) AS STRING), ' de maig de ', CAST(year(o_orderdate) AS STRING)) FROM orders""",
    "legal_sections": """SELECT l_orderkey AS document_id, rn AS ord, concat(CAST(l_orderkey AS STRING), '_sec_', CAST(rn - 1 AS STRING)) AS section_id,
  CASE WHEN rn % 4 = 0 THEN 'annex' ELSE 'article' END AS type,
  concat(CASE WHEN rn % 4 = 0 THEN 'Annex ' ELSE 'Article ' END, CAST(rn AS STRING)) AS title,
  CASE WHEN l_partkey % 7 = 0 THEN '' ELSE concat('Objecte ', CAST(l_partkey AS STRING)) END AS heading,
  concat('De conformitat amb l''article ', CAST(rn AS STRING), ' de la Llei ', CAST(l_partkey % 120 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING), '; vist el Decret ', CAST(l_suppkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING)) AS text
  FROM lineitem_rn""",
    "legal_affs": """SELECT l_orderkey AS document_id, rn AS ord,
 CASE WHEN l_linestatus = 'F' THEN 'active' ELSE 'passive' END AS direction,
 CASE WHEN l_partkey % 8 = 0 THEN l_partkey + 1000000 ELSE l_partkey END AS target_document_id,
 concat(CASE l_returnflag WHEN 'R' THEN 'Deroga' WHEN 'A' THEN 'Modifica' ELSE 'Veure' END, ' l''article ', CAST(rn % 5 + 1 AS STRING), ' de la Llei ', CAST(l_partkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING)) AS text FROM lineitem_rn""",
    "publications": """SELECT o_custkey AS record_id, pos, o_orderkey AS ingest_ord,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'normatives-locals' WHEN 'MACHINERY' THEN 'subvencions' WHEN 'AUTOMOBILE' THEN 'contractacions' WHEN 'HOUSEHOLD' THEN 'oposicions' ELSE 'convenis' END AS type,
 CASE o_orderkey % 6 WHEN 0 THEN 'DOGC' WHEN 1 THEN 'BOPB' WHEN 2 THEN 'BOPG' WHEN 3 THEN 'BOPL' WHEN 4 THEN 'TA' ELSE NULL END AS butlleti,
 o_orderstatus AS fase, concat('Ajuntament de C', CAST(o_custkey % 40 AS STRING)) AS institucio,
 concat('Aprovacio definitiva expedient ', CAST(o_custkey % 7 AS STRING), ' lot ', CAST(o_orderkey % 3 AS STRING)) AS descripcio,
 concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING),2,'0'), '-', lpad(CAST(day(o_orderdate) AS STRING),2,'0')) AS data_publicacio,
 CASE WHEN o_orderkey % 6 = 0 AND o_orderkey % 4 <> 0 THEN concat('https://gazette.example/pdf?documentId=', CAST(o_orderkey AS STRING)) WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('https://portal.example/', CAST(o_orderkey AS STRING), '.pdf') END AS url_pdf
FROM orders_pos JOIN customer ON o_custkey = c_custkey""",
    "records": """SELECT c_custkey AS record_id, c_custkey AS ingest_ord, CASE c_mktsegment WHEN 'BUILDING' THEN 'normatives-locals' WHEN 'MACHINERY' THEN 'subvencions' WHEN 'AUTOMOBILE' THEN 'contractacions' WHEN 'HOUSEHOLD' THEN 'oposicions' ELSE 'convenis' END AS type,
 concat(CASE c_custkey % 5 WHEN 0 THEN 'LLEI' WHEN 1 THEN 'DECRET' WHEN 2 THEN 'ORDRE' WHEN 3 THEN 'ACORD' ELSE 'ANUNCI' END, ' ', CAST(c_custkey % 97 + 1 AS STRING), '/1997, de disposicions de C', CAST(c_nationkey AS STRING)) AS title,
 concat('https://records.example/', CAST(c_custkey AS STRING)) AS url_record,
 concat('Ajuntament de C', CAST(c_custkey % 40 AS STRING)) AS institucio,
 CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal > 5000 END AS es_vigent,
 concat('1997-01-', lpad(CAST(c_custkey % 28 + 1 AS STRING),2,'0')) AS date FROM customer""",
    "bulletin_feed": """SELECT concat('feed_', CAST(o_orderkey AS STRING)) AS id, o_orderkey AS ingest_ord, CASE WHEN o_orderkey % 9 = 0 THEN o_custkey ELSE NULL END AS cido_id,
 CASE WHEN o_orderkey % 7 = 0 THEN 'Document sense parella' ELSE concat(CASE o_orderkey % 5 WHEN 0 THEN 'Llei' WHEN 1 THEN 'DECRET' WHEN 2 THEN 'Ordre' WHEN 3 THEN 'Acord' ELSE 'Anunci' END, '  ', CAST(o_orderkey % 97 + 1 AS STRING), '/', CAST(year(o_orderdate) AS STRING), ', de disposicions de C', CAST(o_custkey % 40 AS STRING), '.') END AS title,
 concat(lpad(CAST(day(o_orderdate) AS STRING),2,'0'),'/',lpad(CAST(month(o_orderdate) AS STRING),2,'0'),'/',CAST(year(o_orderdate) AS STRING)) AS date,
 CASE WHEN o_orderkey % 3 = 0 THEN concat(' https://gazette.example/ca/doc?documentId=', CAST(o_orderkey AS STRING), ' ') ELSE NULL END AS link_to_text, o_orderpriority AS category FROM orders""",
    "spans": """SELECT CAST(event_id AS STRING) AS annotation_id, event_id AS ingest_ord, user_id AS doc_id, event_id * 37 % 400 AS start_offset, event_id * 37 % 400 + 20 AS end_offset, event_type AS category, props AS key_values_json FROM events""",
    "llm_answers": """SELECT conv_id, turn, concat('<think>', role, '</think> ```json [{"document_number": "', CAST(conv_id % 97 + 1 AS STRING), '/2020", "doc_type": "', CASE WHEN turn % 3 = 0 THEN 'DOGC' ELSE 'Llei' END, '", "article_or_section": "article ', CAST(turn AS STRING), '"}] ```') AS answer FROM conversations""",
    "items": """SELECT l_orderkey AS source_id, rn AS item_no, concat('Article ', CAST(rn % 5 + 1 AS STRING)) AS article_or_section,
 CASE WHEN rn % 6 = 0 THEN '' ELSE concat(CAST(l_partkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING)) END AS document_number,
 CASE WHEN rn % 3 = 0 THEN 'DOGC' ELSE 'Llei' END AS doc_type, CAST(year(l_shipdate) AS STRING) AS year,
 CASE WHEN rn % 3 = 0 THEN CAST(year(l_shipdate)*1000 + dayofyear(l_shipdate) AS STRING) ELSE '' END AS dogc_number,
 CASE WHEN rn % 2 = 0 THEN '' ELSE concat('Llei ', CAST(l_partkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING), ', de disposicions de C', CAST(l_suppkey % 40 AS STRING)) END AS cited_title,
 CASE WHEN rn % 3 = 0 THEN concat('DOGC num. ', CAST(l_partkey AS STRING)) ELSE concat('Llei ', CAST(l_partkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING)) END AS raw_text,
 rn % 4 = 0 AS is_general FROM lineitem_rn""",
    "graph_nodes": """SELECT concat('d', CAST(document_id AS STRING)) AS id, 'Document' AS label, type AS extra_label, title, document_number, dogc_number, document_id FROM legal_docs
UNION ALL SELECT concat('s', section_id), 'DocumentSection', CASE WHEN type = 'article' THEN 'Article' END, title, '', '', document_id FROM legal_sections""",
    "graph_edges": """SELECT concat('d', CAST(document_id AS STRING)) AS src, concat('s', section_id) AS dst, 'HAS_SECTION' AS type FROM legal_sections
UNION ALL SELECT concat('s', CAST(l_orderkey AS STRING), '_sec_', CAST(rn - 1 AS STRING)), CASE WHEN l_linestatus = 'F' THEN concat('s', CAST(l_partkey AS STRING), '_sec_0') ELSE concat('d', CAST(l_partkey AS STRING)) END,
 CASE l_returnflag WHEN 'R' THEN 'ABROGATES' WHEN 'A' THEN 'MODIFIES' ELSE 'CITES' END FROM lineitem_rn""",
}


class Inputs:
    """The tables of one folder, and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self._made = session.tune(spark), sf_dir.rstrip("/"), {}

    def __getattr__(self, name) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
            self._made[name].createOrReplaceTempView(name)
        return self._made[name]

    def _make(self, name):
        if name in TABLES:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        if name == "lineitem_rn":
            cols = [c.strip() for c in _RN_ORDER.split(",")]
            # numbered once per query: its views read it many times
            return session.stored(ordered.split_row_number(
                self.lineitem.select(*_RN_COLUMNS), ["l_orderkey"], [F.col("l_linenumber"), F.floor(F.col("l_partkey") / 1024)],
                cols).withColumn("rn", F.col("rn").cast("int")), "numbered")
        if name == "orders_pos":
            return ordered.split_row_number(
                self.orders, ["o_custkey"], [F.floor(F.col("o_orderkey") / ordered.CHUNK)],
                ["o_orderkey"], "pos").withColumn("pos", (F.col("pos") - 1).cast("int"))
        if name == "legal_paras":
            return self._legal_paras()
        return self.sql(VIEWS[name])

    def _legal_paras(self):
        """Rows of the ``legal_paras`` view, with one pass over each input table."""
        body = self.sql("""SELECT l_orderkey AS document_id, inline(array(
            struct(rn*10 AS ord, concat('Article ', CAST(rn AS STRING), '. Objecte ', CAST(l_partkey AS STRING)) AS text),
            struct(rn*10+1 AS ord, concat('D''acord amb l''article ', CAST(rn AS STRING), ' de la Llei ', CAST(l_partkey % 120 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING),
              '; vist el Decret ', CAST(l_suppkey % 97 + 1 AS STRING), '/', CAST(year(l_shipdate) AS STRING), '. Text amb paraules') AS text))) FROM lineitem_rn""")
        frame = self.sql("""SELECT o_orderkey AS document_id, inline(array_compact(array(
            struct(0 AS ord, concat('Atesa la proposta ', CAST(o_custkey AS STRING)) AS text),
            CASE WHEN o_orderkey % 3 = 0 THEN struct(5 AS ord, concat('Capítol ', CAST(o_orderkey % 9 + 1 AS STRING)) AS text) END,
            struct(7 AS ord, concat('Barcelona, ', CAST(day(o_orderdate) AS STRING), ' de maig de ', CAST(year(o_orderdate) AS STRING)) AS text)))) FROM orders""")
        return body.unionByName(frame)

    def sql(self, text) -> DataFrame:
        for used in names_in(text):
            getattr(self, used)
        return self.spark.sql(text)


def names_in(text):
    return [n for n in TABLES + list(VIEWS) if re.search(rf"\b(?:FROM|JOIN|from|join|,)\s+{n}\b", text)]


def with_views(text: str) -> str:
    """Prefix a DuckDB query with the views it needs, in dependency order."""
    need, todo = set(), [text]
    while todo:
        for n in names_in(todo.pop()):
            if n in VIEWS and n not in need:
                need.add(n)
                todo.append(VIEWS[n])
    if not need:
        return text
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in VIEWS if n in need)
    body = text.strip()
    low = body.lower()
    if low.startswith("with recursive"):
        return f"WITH RECURSIVE {ctes},\n{body[len('with recursive'):]}"
    if low.startswith("with"):
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"


QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    """Register a query: a function of ``Inputs``; ``oracle`` is its SQL check."""

    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return wrap
