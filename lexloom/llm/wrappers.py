"""Main text of web pages by wrappers: union-free regular expressions over tokens, inferred for each host.

A page is a balanced stream of element tokens and text slots. A host's wrapper starts as the stream of one page and is
aligned with the next, again and again: equal tokens match, a mismatch becomes a repeated group if neighbours repeat it and
an optional one otherwise, and texts that differ make a slot variable. Wrappers of page groups are aligned in the same way,
so a host's pages are folded where they lie and only wrappers travel. A page is then read by its host's wrapper: the slots
of the article, or, on pages without an article element, what neither furniture, nor template text, nor link lists hold.

An expression is a list of items [token, quantifier, items, statistics]. Tokens are `#` for text, an element's name, with
`!` for furniture (its content doesn't count) or `*` for an article, and `(` with the tokens of a group. Quantifiers are
as in regular expressions: none, ?, + and *. Statistics of a text slot: texts, hash of the text if all are equal (else 0),
characters, characters in links.
"""

import functools
import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lexloom.llm.base import own_name, small_batches, table
from lexloom.llm.urlfilter import url_host
from lexloom.session import scratch_path

HELD = 512  # hosts whose wrappers a task holds before it passes them on
SALTS = 64  # a host's wrappers are aligned in so many groups first
DEPTH = 100  # elements nested deeper count as children of that depth
UNIT = 4  # tokens of a repeated group at most
RUN = 8  # more neighbours with one token on a page are a repeated group
CELLS = 250_000  # of an alignment table; longer lists are aligned greedily
TEMPLATE_PAGES = 3  # equal texts on so many pages, while others vary, are template text
MENU, LINKS = 3, 0.8  # so many neighbours, or a repeated item, with this share of characters in links are a link list

# fixed values: elements by their kind in HTML
BLOCK = set("""address article aside blockquote button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr iframe legend li main menu nav noscript object ol optgroup option p pre
    search section select summary svg table tbody td template tfoot th thead tr ul""".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
OUTER = {"html", "head", "body"}
EMPTY = {"hr", "col", "input", "img", "br", "wbr", "meta", "link", "base", "area", "embed", "param", "source", "track"}
FURNITURE = set("nav footer aside form noscript template svg canvas object select button dialog menu search".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
# fixed values: words of class and id names
NAMES = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social sidebar aside menu nav navbar
    navigation breadcrumb breadcrumbs masthead header footer comment comments commentlist disqus reply replies respond related recommended
    widget widgets pagination pager toolbar""".split())
TALK = set("comment comments commentlist disqus reply replies respond".split())

# a tag's attributes may hold `>` in quotes; nothing is tried twice
TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>=]++|=)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# an element of the first kind ends an open one of the second, unless one of the third stands between
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"})}
ENDS |= {name: ({"tbody", "thead", "tfoot"}, {"table"}) for name in ("tbody", "thead", "tfoot")}


class Element:
    __slots__ = ("name", "drop", "article", "talk", "kids")

    def __init__(self, name, drop=False, article=False, talk=False):
        self.name, self.drop, self.article, self.talk, self.kids = name, drop, article, talk, []


def _element(name, attributes, in_article):
    """drop: `tag` for furniture by the element's name or role, `name` by its class or id."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    role = found.get("role", "").strip().lower()
    words = {w.lower() for w in NAME.findall(f"{found.get('class', '')} {found.get('id', '')}")} if found else set()
    article = name in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    drop = "tag" if name in FURNITURE or role in ROLES or name == "header" and not in_article else None
    if not drop and words & NAMES and not (name == "main" or name == "header" and in_article):
        drop = "name"
    return Element(name, drop, article and not drop, bool(words & TALK))


def parse(text):
    """Tree of a page: block elements, furniture, and texts as (text, characters in links). Any string is a page.

    Inline tags vanish, line breaks are white space, missing end tags are implied as in HTML. Character references are
    decoded, white space in a block becomes one space. Inline furniture is silent up to its end or its block's.
    """
    root = Element("html")
    stack, buffer, open_, over = [root], [], Counter(), Counter()
    linked = articles = drops = at = silent = 0  # silent: open inline elements since the furniture, in the block `level`
    link, quiet, level = False, "", 0

    def flush():
        nonlocal linked
        if buffer:
            if block := " ".join("".join(buffer).split()):
                stack[-1].kids.append((block, linked))
            buffer.clear()
        linked = 0

    def pop(n):
        nonlocal articles, drops, silent
        while len(stack) > n:
            e = stack.pop()
            open_[e.name] -= 1
            articles -= e.article
            drops -= e.drop is not None
        if len(stack) < level:
            silent = 0

    def say(piece):
        nonlocal linked
        if piece and not silent:
            piece = entities.unescape(piece) if "&" in piece else piece
            buffer.append(piece)
            linked += len(piece.strip()) if link else 0

    while m := TAG.search(text, at):
        say(text[at:m.start()])
        at = m.end()
        closing, name, attributes = m.groups()
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            link = not closing
        if closing:
            silent -= silent > 0 and name == quiet
            if name not in BLOCK:
                continue
            flush()
            if over[name]:
                over[name] -= 1
            elif open_[name]:
                pop(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name))
        elif name in RAW:
            end = END[name].search(text, at)
            at = end.start() if end else len(text)
        elif name == "br":
            buffer.append(" ")
        elif name in EMPTY:
            if name in BLOCK:
                flush()
        elif name not in BLOCK:
            if silent:
                silent += name == quiet
            elif "=" in attributes and name not in OUTER and _element(name, attributes, articles).drop:
                silent, quiet, level = 1, name, len(stack)
        else:
            flush()
            if open_["p"]:
                held = [i for i in range(max(1, len(stack) - 3), len(stack)) if stack[i].name == "p"]
                pop(held[0] if held else len(stack))
            if name in ENDS:
                ends, stops = ENDS[name]
                for i in range(len(stack) - 1, max(0, len(stack) - DEPTH), -1):
                    if stack[i].name in ends:
                        pop(i)
                        break
                    if stack[i].name in stops:
                        break
            if name in ENDS or name == "p":
                link = False
            e = _element(name, attributes, articles)
            if attributes.endswith("/") and name in ("svg", "object"):
                continue
            if len(stack) >= DEPTH and (drops or not e.drop):
                over[name] += 1
                continue
            stack[-1].kids.append(e)
            stack.append(e)
            open_[name] += 1
            articles += e.article
            drops += e.drop is not None
    say(text[at:])
    flush()
    return root


def _articles(e, shown=True):
    """Article elements of a tree outside furniture; with shown=False those that only names call furniture count too."""
    for k in e.kids:
        if isinstance(k, Element) and k.drop != "tag" and not (k.talk and k.drop):
            if k.article and not k.drop:
                yield k
            elif not k.drop or not shown:
                yield from _articles(k, shown)


def _settle(root):
    """A name can't make furniture of what holds a page's only articles."""
    if next(_articles(root), None) is None and next(_articles(root, False), None):
        todo = [root]
        while todo:
            for k in todo.pop().kids:
                if isinstance(k, Element) and k.drop != "tag" and not k.talk and (k.drop is None or next(_articles(k, False), None)):
                    k.drop = None
                    todo.append(k)
    return root


def expression(root):
    """A page's expression and its texts. A text slot's fifth statistic is its place in the texts, or a pair of such for several."""
    texts = []

    def items(e):
        out = []
        for k in e.kids:
            if isinstance(k, tuple):
                out.append(["#", "", [], [1, xxhash.xxh64_intdigest(k[0]) | 1, len(k[0]), min(k[1], len(k[0])), len(texts)]])
                texts.append(k[0])
            elif k.drop:
                out.append([f"{k.name}!", "", [], []])
            else:
                out.append([f"{k.name}*" if k.article else k.name, "", items(k), []])
        return _squared(_runs(out))

    return items(_settle(root)), texts


def _flat(runs):
    return [item for _, held in runs for item in held]


def _runs(items):
    """Neighbours with one token: [(token, items)]. Long runs are one repeated item."""
    out = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1][1].append(item)
        else:
            out.append((item[0], [item]))
    return [(t, [_repeated(held)] if len(held) > RUN else held) for t, held in out]


def _repeated(items, empty=False):
    """One repeated item for several; `empty` if it may be missing."""
    one = functools.reduce(_merged, items)
    return [one[0], "*" if empty or _may_miss(items) else "+", one[2], one[3]]


def _may_miss(items):
    return all(i[1] in ("?", "*") for i in items)


def _squared(runs):
    """Items of runs, in which several neighbours that repeat, such as heading and paragraphs, become one repeated group."""
    out, i = [], 0
    while i < len(runs):
        for p in range(2, UNIT + 1):
            unit, n = [t for t, _ in runs[i:i + p]], 1
            while len(unit) == p and [t for t, _ in runs[i + n * p:i + (n + 1) * p]] == unit:
                n += 1
            if n > 1:
                out.append(_repeated([_unit(runs[i + j * p:i + (j + 1) * p]) for j in range(n)]))
                i += n * p
                break
        else:
            out += runs[i][1]
            i += 1
    return out


def _unit(runs):
    return ["(" + " ".join(t for t, _ in runs), "", _flat(runs), []]


def _grouped(runs, units):
    """Runs in which what a group of the other side would match once stands as that group."""
    out, i = [], 0
    while i < len(runs):
        for unit in units:
            if [t for t, _ in runs[i:i + len(unit)]] == unit:
                group = _unit(runs[i:i + len(unit)])
                if out and out[-1][0] == group[0]:
                    out[-1][1].append(group)
                else:
                    out.append((group[0], [group]))
                i += len(unit)
                break
        else:
            if out and out[-1][0] == runs[i][0]:
                out[-1] = (runs[i][0], out[-1][1] + runs[i][1])
            else:
                out.append(runs[i])
            i += 1
    return out


def _aligned(a, b):
    """Matching pairs (i, j) of two lists of tokens in order: the longest common ones, greedily if the lists are long."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    pairs = [(i, i) for i in range(n)]
    x, y = a[n:], b[n:]
    if len(x) * len(y) > CELLS:
        places, low = defaultdict(list), 0
        for i, t in enumerate(x):
            places[t].append(i)
        for j, t in enumerate(y):
            k = bisect_left(places[t], low)
            if k < len(places[t]):
                pairs.append((n + places[t][k], n + j))
                low = places[t][k] + 1
        return pairs
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            pairs.append((n + i, n + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _both(a, b):
    """The runs of two lists of items, with the groups of both, and their matching pairs."""
    a, b = _runs(a), _runs(b)
    units = [t[1:].split(" ") for t in dict.fromkeys(t for t, _ in a + b) if t[0] == "("]
    if units:
        a, b = _grouped(a, units), _grouped(b, units)
    return a, b, _aligned([t for t, _ in a], [t for t, _ in b])


def _equal(x, y):
    """Whether two items hold the same texts throughout, with at least one."""
    if x[0] != y[0] or x[1] in "+*" and x[1] or y[1] in "+*" and y[1]:
        return False
    if x[0] == "#":
        return x[3][1] == y[3][1] != 0
    return len(x[2]) == len(y[2]) > 0 and all(map(_equal, x[2], y[2]))


def _sides(a, b):
    """How many items at the start and at the end of two runs hold equal texts."""
    n = 0
    while n < min(len(a), len(b)) and _equal(a[n], b[n]):
        n += 1
    m = 0
    while m < min(len(a), len(b)) - n and _equal(a[-1 - m], b[-1 - m]):
        m += 1
    return n, m


def _repeats(items):
    return any(i[1] in ("+", "*") for i in items)


def _optional(item):
    return [item[0], {"": "?", "+": "*"}.get(item[1], item[1]), *item[2:]]


def _merged(x, y):
    """One item that matches whatever either matches; both have the same token."""
    optional, repeated = x[1] in ("?", "*") or y[1] in ("?", "*"), _repeats([x, y])
    quantifier = ("*" if repeated else "?") if optional else "+" if repeated else ""
    if x[0] == "#":
        (n, h, c, k, *p), (o, i, d, l, *q) = x[3], y[3]
        return ["#", quantifier, [], [n + o, h if h == i else 0, c + d, k + l, *([(p[0], q[0])] if p and q else [])]]
    return [x[0], quantifier, align(x[2], y[2]), []]


def align(a, b):
    """The expression of two expressions: what either matches. Empty lists are the expression of an empty page."""
    if len(a) == len(b) == 1 and a[0][0] == b[0][0] == "#":
        return [_merged(a[0], b[0])]
    a, b, pairs = _both(a, b)
    out, i, j = [], 0, 0
    for p, q in [*pairs, (len(a), len(b))]:
        out += [_optional(x) for x in _flat(a[i:p]) + _flat(b[j:q])]
        if p < len(a):
            x, y = a[p][1], b[q][1]
            if len(x) == len(y) and not _repeats(x + y):
                out += map(_merged, x, y)
            else:
                n, m = _sides(x, y)
                left, right = x[n:len(x) - m], y[n:len(y) - m]
                out += map(_merged, x[:n], y[:n])
                if left or right:
                    out.append(_repeated(left + right, empty=_may_miss(left) or _may_miss(right)))
                out += map(_merged, x[len(x) - m:], y[len(y) - m:])
        i, j = p + 1, q + 1
    return out


def _located(wrapper, page, place, article=False, repeated=False):
    """Calls place(slot of the page, slot of the wrapper, in an article, in a repeated item) for every text slot of a page."""
    a, b, pairs = _both(wrapper, page)
    partner = {q: p for p, q in pairs}
    for q, (_, held) in enumerate(b):
        slots = a[partner[q]][1] if q in partner else []
        if len(slots) == len(held) and not _repeats(slots):
            at = slots
        else:
            n, m = _sides(slots, held)
            middle = slots[n:len(slots) - m]
            fill = next((x for x in middle if x[1] in ("+", "*")), middle[0] if middle else None)
            at = slots[:n] + [fill] * (len(held) - n - m) + slots[len(slots) - m:]
        for x, y in zip(at, held):
            again = repeated or len(held) >= MENU or _repeats([x, y] if x else [y])
            if y[0] == "#":
                place(y, x, article, again)
            elif y[2]:
                _located(x[2] if x else [], y[2], place, article or y[0][-1] == "*", again)


def _slots(items):
    for item in items:
        if item[0] == "#":
            yield item
        yield from _slots(item[2])


@functools.lru_cache(64)
def _wrapper(text):
    """Pages, expression, and whether any slot varies."""
    pages, items = json.loads(text) if text else (0, [])
    return pages, items, any(x[3][1] == 0 for x in _slots(items))


def main_text(html, wrapper=None):
    """Main text of a page by its host's wrapper (as infer gives it); None: by the page alone. NULL or empty pages have none.

    With article elements (`article`, `main`, their roles) outside furniture these are the main text, else the whole page;
    furniture is left out, and without article elements template texts and link lists as the wrapper shows them.
    """
    page, texts = expression(parse(html or ""))
    pages, items, varies = _wrapper(wrapper)
    found = [None] * len(texts)

    def place(slot, by, article, repeated):
        n, h, c, k = by[3][:4] if by else (0, 0, 1, 0)
        template = varies and h != 0 and n >= TEMPLATE_PAGES and n * 2 >= pages
        todo = [slot[3][4]]
        while todo:
            p = todo.pop()
            if isinstance(p, tuple):
                todo += p
            else:
                found[p] = article, not (template or repeated and k >= LINKS * c)

    _located(items, page, place)
    inside = any(article for article, _ in found)
    return "\n\n".join(t for t, (article, good) in zip(texts, found) if (article if inside else good))


def _bare(items):
    """An expression without places."""
    return [[t, q, _bare(held), stat[:4]] for t, q, held, stat in items]


def _dump(pages, items):
    return json.dumps([pages, items], separators=(",", ":"))


def infer(pages, html="html"):
    """host and wrapper of every host (urlfilter.url_host) in pages (url, html): aligned over all of its pages.

    Pages are folded by host where they are read, then the parts' wrappers within salted groups, then over the host.
    Which of several equally long alignments is taken can depend on how pages are dealt to tasks. NULL or malformed URLs
    are pages of the host "". An empty table gives none.
    """
    small_batches(pages.sparkSession, rows=500)

    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([_dump(*x) for x in held.values()], pa.string())], names=["host", "wrapper"])

    def fold(batches):
        held = {}
        for b in batches:
            for host, text in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                items = _bare(expression(parse(text or ""))[0])
                n, now = held.get(host, (0, items))
                held[host] = n + 1, align(now, items) if n else items
                if len(held) > HELD:
                    yield rows(held)
                    held = {}
        yield rows(held)

    def join(batches):
        host, now = None, None
        for b in batches:
            for h, text in zip(b.column("host").to_pylist(), b.column("wrapper").to_pylist()):
                n, items = json.loads(text)
                if now and h == host:
                    now = now[0] + n, align(now[1], items)
                else:
                    if now:
                        yield rows({host: now})
                    host, now = h, (n, items)
        if now:
            yield rows({host: now})

    out = pages.select(url_host(F.col("url")).alias("host"), F.col(html).alias("html")).mapInArrow(fold, "host string, wrapper string")
    out = out.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["host", "salt"], ["host"]):
        out = out.repartition(*keys).sortWithinPartitions(*keys, "wrapper").select("host", "wrapper").mapInArrow(join, "host string, wrapper string")
    path = scratch_path(pages.sparkSession, "wrappers")
    out.write.parquet(path)
    return pages.sparkSession.read.parquet(path)


def extract(pages, wrappers=None, html="html", text="text", n_chars="n_chars"):
    """pages (url, html, ...) without html, with main text and its code points under the names given.

    Main text is what main_text gives by the wrapper of the page's host; wrappers are inferred from these pages if none
    are given, and a host without one is read by its page alone. Blocks are joined by an empty line. NULL and empty pages
    have an empty text. Repeated rows stay. A column that has a new column's name, in any case, is replaced.
    """
    small_batches(pages.sparkSession, rows=500)
    wrappers = infer(pages, html) if wrappers is None else wrappers
    stay = [c for c in pages.columns if c.lower() not in {text.lower(), n_chars.lower(), html.lower()}]
    host, wrapper, body = (own_name(pages, c) for c in ("host", "wrapper", "html"))
    rows = pages.select(*stay, F.col(html).alias(body), url_host(F.col("url")).alias(host))
    rows = rows.join(wrappers.select(F.col("host").alias(host), F.col("wrapper").alias(wrapper)), host, "left").select(*stay, body, wrapper)

    def task(batches):
        for b in batches:
            found = [main_text(t, w) for t, w in zip(b.column(body).to_pylist(), b.column(wrapper).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in stay), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=[*stay, text, n_chars])

    return rows.mapInArrow(task, rows.select(*stay, F.lit("").alias(text), F.lit(0).cast("long").alias(n_chars)).schema)


def op12_html_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# For pages of the tables' layout: blocks of the article element between tags of paragraphs and headings.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:p|h1)>'), lambda x: regexp_replace(x, '<[^>]*>', ' ', 'g')) AS parts FROM a),
c AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(replace(x, '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM b),
d AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM c)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM d
"""
