"""Word lists, patterns and weights that decide results.

Everything here is data. Patterns are Java regexes; ``(?iU)`` makes letters,
``\\w`` and ``\\b`` Unicode-aware, which accented Catalan and Spanish need.
"""

# ---- fixed values: missing-value sentinels -------------------------------------------
SENTINELS = ["None", "Unknown"]

# ---- fixed values: prefixes dropped from match keys, applied in this order ------------
TITLE_PREFIXES = ["ordre", "orden", "resolució", "resolución", "anunci", "anuncio",
                  "edicte", "edicto", "decret", "decreto", "llei", "ley"]
ORG_PREFIXES = ["ajuntament de", "ajuntament d", "consell comarcal de", "consell comarcal d",
                "consorci del", "consorci de", "consorci d"]

# ---- fixed values: document types that may lead a title -------------------------------
TITLE_TYPES = ["RESOLUCIÓ", "RESOLUCION", "EDICTE", "EDICTO", "ANUNCI", "ANUNCIO",
               "ORDRE", "ORDEN", "DECRET", "DECRETO", "ACORD", "ACUERDO", "LLEI", "LEY",
               "DECRET LLEI", "DECRETO LEY", "DECRET LEGISLATIU", "DECRETO LEGISLATIVO",
               "REIAL DECRET", "REAL DECRETO", "NOMENAMENT", "NOMBRAMIENTO",
               "CORRECCIÓ D'ERRADA", "CORRECCIÓ D'ERRADES",
               "CORRECCIÓN DE ERRATA", "CORRECCIÓN DE ERRATAS",
               "DICTAMEN", "CIRCULAR", "INSTRUCCIÓ", "INSTRUCCION",
               "ANUNCIS", "EDICTES", "ORDRES", "DECRETS", "LLEIS", "LEIS", "ORDE"]

# ---- fixed values: type classifier over free text, first hit wins ---------------------
TEXT_TYPE_RULES = [
    (r"(?iU)\bdecret\s+legislatiu\b|\bdecreto\s+legislativo\b", "Decret legislatiu"),
    (r"(?iU)\bdecret\b|\bdecreto\b", "Decret"),
    (r"(?iU)\bresoluci[óo]\b|\bresoluci[oó]n\b", "Resolució"),
    (r"(?iU)\bedicte\b|\bedicto\b", "Edicte"),
    (r"(?iU)\banunci\b|\banuncio\b", "Anunci"),
    (r"(?iU)\bordre\b|\borden\b", "Ordre"),
    (r"(?iU)\bllei\b|\bley\b", "Llei"),
    (r"(?iU)\bacord\b|\bacuerdo\b", "Acord"),
    (r"(?iU)\binstrucci[óo]\b|\binstrucci[oó]n\b", "Instrucció"),
    (r"(?iU)\bconvenis?\b|\bconvenios?\b", "Convenis"),
    (r"(?iU)\bnotificaci[óo]\b|\bnotificaci[oó]n\b", "Notificació"),
]

# ---- fixed values: archived classifier by leading word(s) -----------------------------
PREFIX_TYPE_RULES = [
    (["RESOLUCIÓ", "RESOLUCION"], "Resolució"),
    (["EDICTE", "EDICTO"], "Edicte"),
    (["ANUNCI", "ANUNCIO"], "Anunci"),
    (["ORDRE", "ORDEN"], "Ordre"),
    (["DECRET", "DECRETO"], "Decret"),
    (["LLEI", "LEY"], "Llei"),
    (["CORRECCIÓ D'ERRADES", "CORRECCIONS D'ERRADES"], "Correcció d'errades"),
    (["NOTIFICACIÓ", "NOTIFICACION"], "Notificació"),
    (["ACORD", "ACUERDO"], "Acord"),
    (["CONVENI", "CONVENIO"], "Conveni"),
    (["CONVOCATÒRIA", "CONVOCATORIA"], "Convocatòria"),
]

# ---- fixed values: local-index modules and their identifier prefixes ------------------
MODULE_PREFIXES = [("contracta", "cido-cont"), ("oposici", "cido-opos"),
                   ("normativ", "cido-norm"), ("subvenci", "cido-subv"),
                   ("conveni", "cido-conv")]
MODULE_DETAILS = {
    "convenis": ["codi", "ambit"],
    "oposicions": ["numPlaces", "grupTitulacio", "sistemaSeleccio", "borsaTreball"],
    "contractacions": ["tipusContracte", "procediment", "importIvaExclos", "expedient"],
    "subvencions": ["tipusSubvencio", "expedient", "dataFinalitzacio"],
}
NORMATIVE_MODULE = "normatives-locals"

# ---- fixed values: reference patterns -------------------------------------------------
CITED_TYPES = ["llei", "ley", "decret", "decreto", "ordre", "orden", "acord", "acuerdo",
               "resolució", "resolución", "resolucion", "edicte", "edicto", "anunci", "anuncio",
               "reial decret", "real decreto", "decret legislatiu", "decreto legislativo",
               "decret llei", "decreto ley"]
DOC_REF_TYPES = ["llei", "decret", "ordre", "acord", "resolució", "resolucion", "edicte",
                 "anunci", "reial decret"]
REF_STOPWORDS = ["amb", "de", "la", "el", "per", "i", "y", "en", "les", "els", "un", "una",
                 "del", "dels", "al", "als", "d", "l", "s", "a", "estat", "estatut",
                 "generalitat", "catalunya", "ministeri", "govern"]
SIMPLE_CITATION = (r"(?iU)\b(Llei|Ley|Decret|Decreto|Ordre|Orden|Resolució|Resolución|"
                   r"Reial\s+Decret|Real\s+Decreto)\s+([A-Z0-9/\-.]+)\b")
CLAUSE_BREAK = r"[;.\n\r]+"
REF_NUMBER = r"\d+/\d+"

# ---- fixed values: actions of an editorial link, first hit wins -----------------------
ACTION_WORDS = [
    ("Abrogate", ["deroga", "abroga", "suprimeix", "suprimida", "elimina", "anul·la",
                  "anulada", "suspèn", "suspesa"]),
    ("Modify", ["modifica", "reforma", "esmena", "afegeix", "redacta"]),
    ("Consolidate", ["refosa", "refon", "consolida"]),
]
ACTION_EDGE = {"Abrogate": "ABROGATES", "Modify": "MODIFIES", "Consolidate": "CONSOLIDATES",
               "Other": "AFFECTS"}
ARTICLE_ORDINALS = ["unic", "unico", "primer", "primero", "segon", "segundo", "tercer",
                    "tercero", "quart", "cuarto"]
ARTICLE_LIST = (r"(?U)(?=art)\b(article|articles|artículo|artículos|art\b\.?)\s+([0-9a-zA-Z\s,i\-.]+?)"
                r"(?=\s+(?:de|la|el|d'|l'|en|per|\b[A-Z]{2,}\b|\b\d{4}\b)|$)")
ARTICLE_TOKEN_BREAK = r"[\s,iy]+"
ARTICLE_WORD_BREAK = r"(?U)[\s,]+(?:(?:i|y)\b[\s,]*)?"
ARTICLE_SINGLE = (r"(?U)(?=art)\b(?:article|articles|artículo|artículos|art\.?)\s+(únic|único|primer|"
                  r"primero|segon|segundo|tercer|tercero|quart|cuarto|\d+[\w\-]*)\b")
ANNEX_MENTION = r"(?U)(?=an)\b(?:annex|anexo)\s*(\d*|\w*)\b"
DISPOSITION_MENTION = r"(?U)(?=disposici)\b(?:disposició|disposición)\s+(\w+)\b"
OTHER_LAW_WORDS = ["constitució", "constitucion", "estatut", "estatuto", "tribunal", "sentència",
                   "sentencia", "reial decret llei", "real decreto ley", "reial decret 17/1977"]
PREAMBLE_WORDS = ["part expositiva", "exposició de motius", "preàmbul", "preámbulo",
                  "parte expositiva"]
SIGNATURE_WORDS = ["signatures", "signatura", "firmas"]
ANNEX_WORDS = ["annex", "anexo"]
PENALISED_TITLES = ["preamble", "preambulo", "introduccio", "introduction", "signatures"]

# ---- fixed values: national-gazette reference patterns --------------------------------
NATIONAL_ARTICLE = (r"(?iU)\b(?:art(?:ículos?|ículo|\.)?|apartados?|disposici(?:ón|ones)\s+"
                    r"adicional(?:es)?)\s+([0-9a-zA-ZáéíóúÁÉÍÓÚñÑ.()\s,y\-]+?)"
                    r"(?=\s+(?:de|del|en|para|por)\b|$)")
NATIONAL_ARTICLE_BEFORE = (r"(?iU)\b(?:art(?:ículos?|ículo|\.)?|apartados?|disposici(?:ón|ones)\s+"
                           r"adicional(?:es)?)\s+([0-9a-zA-ZáéíóúÁÉÍÓÚñÑ.()\s,y\-]+?)"
                           r"\s+(?:de\s+la|de\s+lo|del|de|en|para)\s+$")
NATIONAL_LAW_NUMBER = r"(?U)\b\d+/\d{4}\b"
REFERENCE_NUMBER = r"(\b\d+/\d{4}\b)"
BLOCK_NUMBER = r"(\d+/\d{4})"
NATIONAL_SIGNATURE = (r"(?=[LRDO])\b(Ley\s+Orgánica|Ley|Real\s+Decreto-ley|Real\s+Decreto|Decreto-ley|Decreto|"
                      r"Orden\s+[A-Z]+(?:/[A-Z0-9]+)?|Orden|Resolución)\s+(?:n.º\s+)?(\d+/\d{4})\b")
NAMED_CODES = [("Constitución", ["Constitución", "C.E."]),
               ("Código Civil", ["Código Civil"]),
               ("Código Penal", ["Código Penal"])]

# ---- fixed values: section headers ----------------------------------------------------
ORDINALS_CA = ["primer", "segon", "tercer", "quart", "cinquè", "sisè", "setè", "vuitè", "novè",
               "desè", "onzè", "dotzè", "tretzè", "catorzè", "quinzè", "setzè", "dissetè",
               "divuitè", "dinovè", "vintè", "vint-i-unè", "vint-i-dosè", "vint-i-tresè",
               "vint-i-quart", "vint-i-cinquè", "vint-i-sisè", "vint-i-setè", "vint-i-vuitè",
               "vint-i-novè", "trentè"]
ORDINALS_ES = ["primero", "primer", "segundo", "tercero", "tercer", "cuarto", "quinto", "sexto",
               "séptimo", "octavo", "noveno", "décimo", "undécimo", "duodécimo", "decimotercero",
               "decimocuarto", "decimoquinto"]


def longest_first(words):
    """Regex alternation of literal words, longer ones tried first."""
    uniq = sorted(set(words), key=lambda w: (-len(w), w))
    return "|".join("".join("\\" + ch if ch in ".-'()[]" else ch for ch in w) for w in uniq)


def starts(words):
    """Lookahead for the first character of any of the words: a search leaves most places without trying the words."""
    return "(?=[" + "".join(sorted({w[0] for w in words})) + "])"


ORDINALS = longest_first(ORDINALS_CA + ORDINALS_ES)
CITED_REF = rf"(?iU){starts(CITED_TYPES)}\b({longest_first(CITED_TYPES)})\s+([a-zA-Z0-9/\-.]+)"
DOC_REF = rf"(?iU){starts(DOC_REF_TYPES)}\b(?:{longest_first(DOC_REF_TYPES)})\s+[a-zA-Z0-9/\-.]+"

CHAPTER_HEADER = (r"(?iU)^\s*(Capítol|Capítulo|Títol|Título|Secció|Sección)\s+"
                  r"(preliminar|[I|V|X|L|C]+|\d+[\w\-]*)\.?\s*(.*)")
ARTICLE_HEADER = (r"(?iU)^\s*(Article|Artículo|Art\.)\s+\b(\d+[\w\-]*|único|únic|" + ORDINALS +
                  r")\b\.?\s*(.*)")
DISPOSITION_HEADER = (r"(?iU)^\s*(Disposició|Disposición)\s+(adicional|addicional|transitòria|"
                      r"transitoria|derogatòria|derogatoria|final)\s*(\w*)\.?\s*(.*)")
ANNEX_HEADER = r"(?iU)^\s*(Annex|Anexo)\s*(\d*|\b[I|V|X|L|C]+\b)?\.?\s*(.*)"
SIGNATURE_HEADER = (r"(?iU)^\s*(Barcelona|Palau de la Generalitat|Palacio de la Generalitat|Madrid|"
                    r"Girona|Lleida|Tarragona)\b.*,\s*[^0-9]*\d+\s+(?:de\s+|d')?\w+\s+de(?:l)?\s+\d{4}")
SIGNATURE_HEADER_HTML = (r"(?iU)^\s*(Barcelona|Palau de la Generalitat|Palacio de la Generalidad|Palacio de la Generalitat|Madrid|"
                         r"Girona|Lleida|Tarragona)\b.*,\s*[^0-9]*\d+\s+(?:de\s+|d')?\w+\s+de(?:l)?\s+\d{4}")
ARTICLE_HEADER_HTML = (r"(?iU)^\s*(Article|Artículo|Art\.)\s+(único|únic|" + ORDINALS +
                       r"|\d+[\w\-]*)\.?\s*(.*)")
RESOLUTION_HEADER = r"(?iU)^\s*(" + ORDINALS + r")\s*[.\-:]\s*(.*)"
ARTICLE_NUMBERS = {"primer": "1", "primero": "1", "segon": "2", "segundo": "2", "tercer": "3",
                   "tercero": "3", "quart": "4", "cuarto": "4", "cinquè": "5", "quinto": "5"}
SECTION_TYPES = {"introduction": "Introduction", "article": "Article", "disposition": "Disposition",
                 "annex": "Annex", "signature": "Signature"}

# ---- fixed values: header patterns of the span annotator (Python regexes) -------------
SPAN_HEADERS = [
    ("preamble", r"(?:^|\n)\s*((?:Preàmbul|Preámbulo|Exposició\s+de\s+motius|"
                 r"Exposición\s+de\s+motivos)\b[^\n]*)"),
    ("chapter", r"(?:^|\n)\s*((?:Capítol|Capítulo|Títol|Título|Secció|Sección)\s+"
                r"(?:preliminar|[I|V|X|L|C]+|\d+[\w\-]*)[^\n]*)"),
    ("article", r"(?:^|\n)\s*((?:Article|Artículo|Art\.)\s+(?:únic|único|primer|segon|tercer|quart|"
                r"cinquè|sisè|setè|vuitè|novè|desè|\d+[\w\-]*)[^\n]*)"),
    ("disposition", r"(?:^|\n)\s*((?:Disposició|Disposición)\s+(?:adicional|addicional|transitòria|"
                    r"transitoria|derogatòria|derogatoria|final)[^\n]*)"),
    ("annex", r"(?:^|\n)\s*((?:Annex|Anexo)\s*(?:\d*|\b[I|V|X|L|C]+\b)?[^\n]*)"),
    ("signature", r"(?:^|\n)\s*((?:Barcelona|Palau de la Generalitat|Palacio de la Generalidad|Madrid|"
                  r"Girona|Lleida|Tarragona|Firma|Signatura|En\s+cumplimiento|Por\s+tanto)\b[^\n]*,"
                  r"\s*.*?\d{4})"),
]
SPAN_TITLE_CUT, SPAN_SIGNATURE_CUT = 80, 40

# ---- fixed values: whole-issue isolation ----------------------------------------------
ISSUE_TITLE_STOPWORDS = ["ley", "decreto", "orden", "parcial", "modificación"]
# characters before and after a number that are searched for title words; span start before it; least length of a span
ISSUE_WINDOW = (200, 500, 100, 800)
ISSUE_NEXT_HEADER = r"\n\s*#*\s*(?:LEY|DECRETO|ORDEN|RESOLUCIÓN|EDICTO|ANUNCIO|CVE|SUMARIO)\b"

CVE_CODE = r"(CVE-DOGC-[A-Z]-\d+-\d+)"

# ---- fixed values: candidate scoring --------------------------------------------------
PLAIN_NUMBER = r"^\d{1,4}/\d{4}$"
TEXT_NUMBER = r"(?U)\b(\d{1,4}/\d{4})\b"
MARKED_NUMBER = r"(?U)([\w/.\-]*\d[\w/.\-]*)"
DIGITS = r"(\d+)"
NAMED_GAZETTE = r"(?U)\bdogc\s*(?:nº|n\.º|number)?\s*(\d+)\b"
TEXT_YEAR = r"(?U)\b(19\d\d|20\d\d)\b"
CANDIDATE_STOPWORDS = ["de", "del", "la", "el", "los", "las", "en", "por", "para", "con", "sin",
                       "sobre", "a", "i", "les", "dels", "un", "una", "ley", "llei", "decreto",
                       "decret", "orden", "ordre", "resolucion", "resolucio", "real", "reial"]
SPECIFIC_LAW_TYPES = ["llei", "decret", "ordre", "resolució", "resolucio", "decret llei",
                      "reial decret", "ley", "decreto", "orden", "acord", "acuerdo"]

# ---- fixed values: graph ----------------------------------------------------------------
CITATION_TYPES = ["CITES", "AFFECTS", "ABROGATES", "MODIFIES", "CONSOLIDATES", "MODIFY", "ABROGATE"]
AFFECTATION_TYPES = ["AFFECTS", "ABROGATES", "MODIFIES", "CONSOLIDATES", "MODIFY", "ABROGATE"]
STRUCTURAL_TYPES = ["HAS_SECTION", "HAS_DOCUMENT", "PART_OF", "PUBLISHED_IN", "CONTAINS"]
PARENT_TYPES = ["HAS_SECTION", "HAS_DOCUMENT", "PART_OF"]
TOPIC_TYPES = ["HAS_TOPIC", "HAS_DESCRIPTOR"]
DOCUMENT_LABELS = ["Document", "Law", "Decree", "DOGC"]
ACTIVE_STATUS_CODES = [200, 301, 302, 303, 307, 308]
AUDIT_FIELDS = ["document_id", "html_url", "pdf_url", "title", "organisme", "section", "date_dogc",
                "year"]
ANNOTATION_COLUMNS = ["doc_id", "doc_title", "doc_source", "annotation_id", "target_property",
                      "selected_text", "start_offset", "end_offset", "section_title",
                      "section_type", "category", "comment", "key_values_json", "created_at",
                      "doc_metadata_json"]
LEGACY_NOTICE_MARKS = ["PDF", "pdf"]
LEGACY_NOTICE_LOWER = "versió catalana"

# ---- fixed values: size estimates of the budgeted subgraph ------------------------------
SECTION_BYTES = (1.1, 600)
DOCUMENT_BYTES = (1.3, 400)
EDGE_BYTES = 250

# ---- fixed values: metadata list of a published document page ---------------------------
METADATA_KEYS = {"Tipus de document": "typeOfLaw", "Data del document": "documentDate",
                 "Número del document": "documentNumber", "Número de control": "controlNumber",
                 "Organisme emissor": "emittingOrganism", "CVE": "cve",
                 "Número del DOGC": "dogcNumber", "Data del DOGC": "dogcDate",
                 "Secció del DOGC": "dogcSection"}

# ---- fixed values: accent folding (letters whose base form is ASCII) --------------------
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝºª"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYoa"

# ---- fixed values: identifier paths, section titles, lead phrases of cited titles, annex numbers ------
PATH_HOST = r"^https?://[^/]+/"
PATH_LEAD = r"^/?(?:eli/)?"
PATH_TAIL = r"/dof(?:/.*)?$"
ARTICLE_SPELLINGS = ["artículo", "articulo", "art."]
SECTION_SYNONYMS = [(r"(?U)\b(artículo|articulo|article|art|art\.)\b", "art"),
                    (r"(?U)\b(sección|seccion|section|sec|sec\.)\b", "sec"),
                    (r"(?U)\b(anexo|annex|an\.)\b", "annex")]
LEAD_PHRASE = (r"(?iU)^(?:artículos?|articulo|article|art\.|arts\.|sección|seccion|sec\.|"
               r"disposición\s+[\wªº]+|disposicio\s+[\wªº]+|anexo|annex)\s*[\d\w\s.,/\-ªº]*"
               r"\s+(?:del|de\s+la|de\s+los|de\s+las|de|d'|d’)\s*")
LEAD_CONNECTOR = r"(?iU)^\s+(?:del|de\s+la|de\s+los|de\s+las|de|d'|d’)\s*"
ANNEX_NUMBER = r"(?U)\b(?:annex|anexo)\s*(\d+)\b"
