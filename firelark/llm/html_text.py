"""Main text of HTML pages by template deduction from equivalence classes.

Method. The tokens of a page are its tags (with their path, class and id) and its text blocks. Over the pages of a host each token has
an occurrence vector: how often it occurs on each page. Tokens with the same vector form an equivalence class. A class is valid if it
is large and frequent (`min_class` tokens on `min_pages` pages and a `min_share` of the host's), ordered and nested. Ordered: its
tokens come in the same order on all its pages, those of a class that occurs several times a page in rounds of the same order,
however far content moves them. Nested: the class of single tokens on the most pages is the frame, whose tokens bound slots; the tokens
of other single classes keep their slots, and a round lies within one slot.
Text that is itself a token of a valid class is template, not content, unless it stands in an <article>
or <main>; all other text fills slots. Tags decide which slots are content: those in menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles or comments are dropped, by tag name, role or the words of class and id; the rest, within <article> and <main>
where these hold any of it, is the main text. So on pages with such an <article> or <main> tags alone decide. An <article> that its class
marks as a comment or teaser is dropped like other elements; one that nothing marks is taken at its word. A <header> within an article is
the article's own. Classes of a layout on an element around an article don't count against it if it is longer than all that is kept, nor does
a layout's word within a name (search-algorithms) if nothing else is kept.

Scale. An occurrence vector is never built: each (host, token) sums, over its pages, a hash of (page, count), so equal vectors have
equal sums; order is the hash of a class's tokens on a page, the least and greatest of which must be equal. Both are
made per map task first, so a host with a third of all pages is no task of its own. Pages are read
twice and never moved if the templates are counted to be under `MAX_TEMPLATE` tokens (they are then broadcast); beyond that
pages are joined with their host's template. Between, only 8 bytes a token of a page are kept.

Results of main_text: page_id, url, text, n_chars. Character references are decoded, white space inside a block is one space, blocks
are joined by a newline. Null html gives an empty text; a null url is a host of its own, without a template. Rows are kept as they are,
repeated page_ids included (their vectors add up); other columns are ignored, whatever their names. Pages are read in linear time, malformed
ones and very long or deep ones too. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared

MAX_TEMPLATE = 200_000  # rows of about 60 bytes that are broadcast
# an unquoted < ends a tag that was not closed, and possessive repeats never go back, so the scan is linear
TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
# HTML's raw text, void and block elements, and elements that never hold main text.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
DROP = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "head", "title", "button", "select", "option", "iframe", "svg", "menu", "dialog", "textarea", "object", "label", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
# Words of class and id names that mark what is not main text.
WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promoted", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside", "widget", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments", "disqus", "reply", "replies", "respond", "pagination", "pager", "toolbar", "search", "form", "skip", "tracking"}
# Those of them that name what is no part of a page's layout, whatever is in it.
ASIDE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promoted", "cookie", "cookies", "consent", "gdpr", "notice", "newsletter", "subscribe", "subscription", "signup", "related", "recommended", "comment", "comments", "disqus", "reply", "replies", "respond"}
# The same for <article> alone, and first words of its classes that are passed over.
TEASERS = {"teaser", "teasers"}
TOPICS = {"category", "cat", "tag", "tags", "topic", "has", "no", "format", "status", "type"}
# p, li, td, ... end when one of these begins
ENDS = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
ENDING = set().union(*ENDS.values())
SCOPE = {"article", "main", "div", "section", "td", "ul", "ol", "table", "nav", "footer", "aside", "header", "form", "body", "html"}
_NAME = re.compile(r"[a-zA-Z]+")
_SPACE = re.compile(r"\s+")
KEPT, WEAK, LAYOUT, OUT = range(4)  # what speaks against a block: nothing, a word of a class, a class for parts of a layout, its tag or kind


def boilerplate(tag: str, attrs: dict) -> int:
    """What an element's tag and attributes say of what is in it. WEAK: a name of class or id has a layout's word, but ends in another
    (search-algorithms); LAYOUT: it ends in one (site-footer)."""
    if tag in DROP or attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return OUT
    if tag in ("main", "body", "html"):
        return KEPT
    # names that begin so tell of topics, formats or what a page has elsewhere (category-social, has-sidebar), not of what the element is
    names = [n for x in ("class", "id") for v in attrs.get(x, "").split() if (n := _NAME.findall(v.lower())) and n[0] not in TOPICS]
    if tag == "article":
        return OUT if any(w in WORDS or w in TEASERS for n in names for w in n) else KEPT
    if any(w in ASIDE for n in names for w in n):
        return OUT
    return LAYOUT if any(n[-1] in WORDS for n in names) else WEAK if any(w in WORDS for n in names for w in n) else KEPT


class Block:
    """A text block: its text, why it goes, whether it is in an <article> and in <main>, why it goes by that article or main and what is in it
    alone, and its token."""

    __slots__ = ("text", "why", "article", "main", "inner", "token")

    def __init__(self, text, why, article, main, inner, token):
        self.text, self.why, self.article, self.main, self.inner, self.token = text, why, article, main, inner, token


def _digest(text: str) -> str:
    import xxhash

    return xxhash.xxh64_hexdigest(text)


def blocks(page: str | None):
    """(tokens, text blocks) of a page. Tokens: tags with their path (a chain of hashes, as long for any depth), in order."""
    page = page or ""
    # open elements: tag, why, in article, in main, inner, path, path of the nearest block
    stack: list[tuple] = []
    count: dict[str, int] = {}
    tokens: list[str] = []
    out: list[Block] = []
    text: list[str] = []
    root = ("", KEPT, False, False, KEPT, "", "")

    def flush():
        if text:
            t = _SPACE.sub(" ", "".join(text)).strip()
            text.clear()
            if t:
                _, why, article, main, inner, _, path = stack[-1] if stack else root
                tokens.append(f"{path}#{t}")
                out.append(Block(t, why, article, main, inner, tokens[-1]))

    def close(to: int):
        for x in stack[to:]:
            count[x[0]] -= 1
        del stack[to:]

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        m = TAG.search(page, at) if at <= last or page.find("<!", at) >= 0 else None
        if m is None or m.start() > at:
            text.append(entities.unescape(page[at : m.start() if m else n]))
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCK:
                flush()
            # the end tag of an open element closes those within, but inline ones close no block
            if count.get(tag):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if tag not in BLOCK and stack[i][0] in BLOCK or stack[i][0] in SCOPE and tag not in SCOPE:
                        break
            continue
        if tag in RAW and tag != "svg":
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        attrs = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(m[3])} if m[3] else {}
        if "hidden" not in attrs and m[3] and re.search(r"(?:^|\s)hidden(?:\s|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", m[3])):
            attrs["hidden"] = ""
        if tag in BLOCK:
            flush()
            if tag in ENDING:
                for i in range(len(stack) - 1, -1, -1):
                    if tag in ENDS.get(stack[i][0], ()):
                        close(i)
                        break
                    if stack[i][0] in SCOPE or stack[i][0] in ("table", "ul", "ol", "dl"):
                        break
        if tag in ("article", "main", "section", "footer", "nav", "aside", "header", "div"):
            i = len(stack)
            while i and stack[i - 1][0] not in BLOCK:
                i -= 1
            close(i)
        _, why, article, main, inner, path, nearest = stack[-1] if stack else root
        path = _digest(path + "/" + tag + "".join(f".{x}" for a in ("class", "id") for x in _NAME.findall(attrs.get(a, ""))))
        tokens.append(path)
        if tag not in VOID and not m[3].endswith("/"):
            own = boilerplate(tag, attrs)
            if tag == "header" and (article or main):
                own = KEPT  # of the article, not of the page
            starts = tag in ("article", "main") and not (article or main)
            stack.append((tag, max(why, own), article or tag == "article", main or tag == "main", own if starts else max(inner, own), path, path if tag in BLOCK else nearest))
            count[tag] = count.get(tag, 0) + 1
    flush()
    return tokens, out


def extract(page: str | None, template: frozenset | set = frozenset()) -> str:
    """template: hashes of the text tokens of the host's valid classes."""
    _, found = blocks(page)
    kept = [b for b in found if b.why == KEPT]
    # an article that only the layout of an element around it speaks against is the page's, if it is longer than all that is kept
    within = [b for b in found if b.why in (WEAK, LAYOUT) and (b.article or b.main) and b.inner == KEPT]
    if within and not any(b.article or b.main for b in kept) and _size(within) > _size(kept):
        kept = within
    kept = kept or [b for b in found if b.why == WEAK]
    inside = [b for b in kept if b.article or b.main] or kept
    # what a page itself marks as its article stays, even a line that all pages of the host have
    return "\n".join(b.text for b in inside if b.article or b.main or not template or _hash(b.token) not in template)


def _size(found: list[Block]) -> int:
    return sum(len(b.text) for b in found)


def _hash(token: str, text: bool = True) -> int:
    """A hash that is odd for a text block and even for a tag."""
    import xxhash

    return (xxhash.xxh64_intdigest(token) - (1 << 63)) & -2 | text


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def _sequences(pages: DataFrame) -> DataFrame:
    """(page_id, host, seq) of the pages of a host; seq: their tokens in order, as packed hashes."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, hosts, seqs = [], [], []
            for page_id, host, page in zip(*(c.to_pylist() for c in b.columns)):
                if host:
                    tokens, found = blocks(page)
                    texts = {f.token for f in found}
                    ids.append(page_id or 0)
                    hosts.append(host)
                    seqs.append(np.array([_hash(t, t in texts) for t in tokens], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hosts, pa.string()), pa.array(seqs, pa.binary())], names=["page_id", "host", "seq"])

    return pages.select(F.col("page_id").cast("long"), "host", F.col("html").cast("string")).mapInArrow(run, "page_id long, host string, seq binary")


def _vectors(seqs: DataFrame) -> DataFrame:
    """(host, token, sig, pages, most): partial sums of the occurrence vectors."""

    def run(batches):
        import pandas as pd

        for b in batches:
            pdf = b.to_pandas()
            if not len(pdf):
                continue
            host, names = pd.factorize(pdf["host"])
            arrays = [np.frombuffer(x, np.int64) for x in pdf["seq"]]
            row = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])
            got = pd.DataFrame({"row": row, "token": np.concatenate(arrays)}).groupby(["row", "token"], sort=False).size().reset_index(name="c")
            row, c = got["row"].to_numpy(), got["c"].to_numpy()
            key = pdf["page_id"].to_numpy().astype(np.int64).view(np.uint64)[row]
            got["sig"] = shared.mix64(key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
            got["host"] = host[row]
            out = got.groupby(["host", "token"], sort=False).agg(sig=("sig", "sum"), pages=("c", "size"), most=("c", "max")).reset_index()  # the sums wrap around
            out["host"] = np.asarray(names)[out["host"].to_numpy()]
            yield from pa_batches(out)

    def pa_batches(pdf):
        import pyarrow as pa

        return pa.Table.from_pandas(pdf, pa.schema([("host", pa.string()), ("token", pa.int64()), ("sig", pa.int64()), ("pages", pa.int64()), ("most", pa.int64())]), preserve_index=False).to_batches()

    return seqs.mapInArrow(run, "host string, token long, sig long, pages long, most long")


def _with_rows(df: DataFrame, table: DataFrame):
    """df with the host's rows of table as its last column, and how to read that of (host, column): broadcast if table is
    counted to be under MAX_TEMPLATE rows, else joined."""
    if table.limit(MAX_TEMPLATE + 1).count() <= MAX_TEMPLATE:
        by_host: dict[str, list] = {}
        for r in table.collect():  # counted: MAX_TEMPLATE rows at most
            by_host.setdefault(r["host"], []).append({k: v for k, v in r.asDict().items() if k != "host"})
        held = df.sparkSession.sparkContext.broadcast(by_host)
        return df.withColumn("_rows", F.lit(None).cast("int")), lambda host, _: held.value.get(host, [])
    packed = table.groupBy("host").agg(F.collect_list(F.struct(*[c for c in table.columns if c != "host"])).alias("_rows"))
    return df.join(packed, "host", "left").select(*df.columns, "_rows"), lambda _, rows: rows or []


def placed(seq: np.ndarray, token: np.ndarray, of: np.ndarray, sizes: np.ndarray, once: np.ndarray, frame: int):
    """(class, order, slots, ordered, nested) of the classes of a page. token (sorted), of: tokens of the host's classes; frame: the class
    on the most pages, or -1. order: hash of the class's tokens in the order of a round; slots: with their slot in the frame."""
    import xxhash

    if not len(token):
        return
    at = np.searchsorted(token, seq).clip(max=len(token) - 1)
    where = np.flatnonzero(token[at] == seq)
    cls = of[at[where]]
    of_frame = where[cls == frame]
    for c in np.unique(cls):
        pos = where[cls == c]
        toks, m = seq[pos], int(sizes[c])
        slot = np.searchsorted(of_frame, pos)
        ordered, nested = len(pos) % m == 0, True
        if once[c]:
            # once on each page: a token keeps its slot of the frame
            places = slot if c != frame else np.zeros(len(pos), np.int64)
        else:
            # rounds of the same order, each within one slot of the frame
            rounds = toks.reshape(-1, m) if ordered else toks[None, :]
            ordered = ordered and bool((rounds == rounds[0]).all())
            nested = ordered and bool((slot.reshape(-1, m) == slot.reshape(-1, m)[:, :1]).all())
            toks, places = rounds[0], np.zeros(0, np.int64)
        order = xxhash.xxh64_intdigest(toks.tobytes()) - (1 << 63)
        yield int(c), order, xxhash.xxh64_intdigest(toks.tobytes() + places.tobytes()) - (1 << 63), ordered, nested


def _orders(seqs: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, sig, frame, low, high, slot_low, slot_high, unordered, crossed) of map tasks. classes: host, token, sig, most, pages."""
    source, rows_of = _with_rows(seqs.select("host", "seq"), classes)

    def run(batches):
        import pyarrow as pa

        kinds: dict = {}
        sums: dict[tuple[str, str], list] = {}

        def known(host, rows):
            rows = sorted(rows_of(host, rows), key=lambda r: r["token"])
            sigs = sorted({r["sig"] for r in rows}, key=str)
            number = {s: i for i, s in enumerate(sigs)}
            of = np.array([number[r["sig"]] for r in rows], np.int64)
            sizes = np.bincount(of, minlength=len(sigs))
            once, pages = np.zeros(len(sigs), bool), np.zeros(len(sigs), np.int64)
            for r in rows:
                once[number[r["sig"]]], pages[number[r["sig"]]] = r["most"] == 1, r["pages"]
            frame = max((i for i in range(len(sigs)) if once[i]), key=lambda i: (pages[i], sizes[i], i), default=-1)
            return sigs, np.array([r["token"] for r in rows], np.int64), of, sizes, once, frame

        for b in batches:
            for host, seq, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if host not in kinds:
                    if len(kinds) > 1000:
                        kinds.clear()
                    kinds[host] = known(host, rows)
                sigs, *rest = kinds[host]
                for c, order, slots, ordered, nested in placed(np.frombuffer(seq, np.int64), *rest):
                    v = sums.setdefault((host, sigs[c]), [int(c == rest[-1]), order, order, slots, slots, 0, 0])
                    v[1], v[2], v[3], v[4] = min(v[1], order), max(v[2], order), min(v[3], slots), max(v[4], slots)
                    v[5], v[6] = v[5] | (not ordered), v[6] | (not nested)
        cols = list(zip(*((h, s, *map(int, v)) for (h, s), v in sums.items()))) or [()] * 9
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.string(), pa.string(), *[pa.int64()] * 7))], names=["host", "sig", "frame", "low", "high", "slot_low", "slot_high", "unordered", "crossed"])

    return source.mapInArrow(run, "host string, sig string, frame long, low long, high long, slot_low long, slot_high long, unordered long, crossed long")


def templates(pages: DataFrame, min_pages: int = 5, min_share: float = 0.5, min_class: int = 3) -> DataFrame:
    """(host, token) of the text tokens of valid classes; pages: page_id, host, html."""
    seqs = shared.written(_sequences(pages), "sequences")
    # sums wrap around, so parts of a vector can be added in any order
    total = F.expr("CAST(pmod(sum(CAST(sig AS DECIMAL(20,0))), CAST(18446744073709551616 AS DECIMAL(20,0))) AS STRING)")
    tokens = _vectors(seqs).groupBy("host", "token").agg(total.alias("sig"), F.sum("pages").alias("pages"), F.max("most").alias("most"))
    of_host = seqs.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    frequent = shared.written(tokens.where(F.col("pages") >= min_pages).join(of_host, "host").where(F.col("pages") >= min_share * F.col("n")).drop("n"), "tokens")
    large = frequent.groupBy("host", "sig").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= min_class).select("host", "sig")
    classes = shared.written(frequent.join(large, ["host", "sig"]).select("host", "token", "sig", "most", "pages"), "classes")
    low, high = (lambda *c: [F.min(x).alias(x) for x in c]), (lambda *c: [F.max(x).alias(x) for x in c])
    placed_ = _orders(seqs, classes).groupBy("host", "sig").agg(*low("low", "slot_low"), *high("high", "slot_high", "frame", "unordered", "crossed"))
    ordered = shared.written(placed_.where("unordered = 0 AND low = high"), "orders")
    # a class nests if its tokens keep their slots of the frame, where that is valid itself
    framed = ordered.where("frame = 1").select("host", F.lit(1).alias("framed"))
    valid = ordered.join(framed, "host", "left").where("framed IS NULL OR (crossed = 0 AND slot_low = slot_high)")
    return classes.join(valid.select("host", "sig"), ["host", "sig"]).where("token % 2 <> 0").select("host", "token")


def main_text(pages: DataFrame, **options) -> DataFrame:
    shared.small_batches(pages.sparkSession)
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host_of(F.col("url")).alias("host"))
    found = shared.written(templates(p, **options), "template")
    source, rows_of = _with_rows(p, found)

    def run(batches):
        import pyarrow as pa

        known: dict[str, set] = {}
        for b in batches:
            marks = []
            for host, rows in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = {r["token"] for r in rows_of(host, rows)}
                marks.append(known[host])
            texts = [extract(page, m) for page, m in zip(b.column(2).to_pylist(), marks)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
