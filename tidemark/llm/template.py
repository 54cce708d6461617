"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from few templates.  A page is a sequence of tokens:
tags and texts, each in its role (the path of elements around it).  Tokens
that occur equally often on the same pages of a host share an occurrence
vector and form an equivalence class; large and frequent classes make up the
template, nested by their paths.  A text is in it where nearly all text of its
role is: a paragraph alike on all pages among others that vary stays.  What
stands between template tokens are slots.  A host's main slot is the deepest
that holds all other slots that are not set apart; its texts are the page's
text, without what a boilerplate element inside encloses.

Occurrence vectors are never built: a vector's hash is a sum over the pages,
so it is aggregated map-side like a count, also for a host that has a third
of all pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import importable, read, written

MIN_CLASS = 3      # tokens of a template class at least
MIN_PAGES = 3      # pages that a template class spans at least
MIN_SHARE = 0.5    # share of its host's pages that it spans at least
MAIN_SHARE = 0.8   # share of its host's text that an element around the main slot has at least
ALIKE_SHARE = 0.8  # share of a role's text on its host that the template's texts have at least
SALTS = 16         # parts a host's pages are dealt into when templates are joined

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea xmp noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp "
                   "rt ruby s samp small span strike strong sub sup time tt u var".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr thead tbody tfoot option figcaption pre "
                   "caption".split())
# Elements that never hold the article's text; a header does
# inside an article, and a form may be around the whole page.
APART = frozenset("nav header footer aside button select menu dialog head title object".split())
CONTENT = frozenset(("article", "main"))
# Names in class, id or role of such parts.
APART_WORDS = frozenset(
    "ad ads adbox advert advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side widget footer header masthead cookie cookies consent notice alert "
    "popup modal newsletter subscribe signup login share sharing social related recommended comment comments "
    "disqus respond reply replies pagination pager toolbar copyright legal disclaimer skip hidden "
    "contentinfo complementary search".split())
# Those that also begin the name of such a part ("sidebar-left"), unless it ends as a state ("menu-open").
STEMS = frozenset(
    "ad ads adbox advert advertisement advertising sponsor sponsored banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar widget footer masthead cookie cookies popup modal newsletter comment comments disqus "
    "pagination pager toolbar".split())
# Those that say so as any word of a name ("user-comments", "post-related").
ANYWHERE = frozenset(
    "advert advertisement advertising sponsored promo banner navbar navigation breadcrumb breadcrumbs sidebar cookie "
    "cookies newsletter share sharing related recommended disqus replies respond pagination masthead".split())
COMMENTS = re.compile(r"comments?(list|area|form|section|box|thread|wrap|wrapper|body|author|meta|text|count)?")
# Teasers of other articles: these words side by side.
TEASERS = frozenset(((a, b) for a in ("more", "other", "latest", "read", "see") for b in
                     ("stories", "articles", "posts", "news", "next", "also", "reading")))
# Words before which a name says the contrary or what is around it.
DENIALS = frozenset("no not non without has with is hide overflow".split())
STATES = frozenset("open opened closed enabled disabled on off active inactive visible none fixed sticky collapsed "
                   "expanded free".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
NAMES = re.compile(r"(?<![\w-])(class|id|role|aria-hidden|hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPACE = re.compile(r"\s+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, attributes) of a page: kind is open, close or text.
    Comments, declarations and the insides of raw elements are left out; a
    tag that the page's end cuts off is none."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        m = TOKEN.match(page, lt) if lt >= 0 else None
        while lt >= 0 and m is None:  # a < that begins no tag is text
            lt = page.find("<", lt + 1)
            m = TOKEN.match(page, lt) if lt >= 0 else None
        if lt < 0:
            # a tag's first letters at the very end stay text only if no tag can begin there
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if not m[0].endswith(">"):
            return
        if m[1] or m[4]:
            yield "close", name, ""
            continue
        yield "open", name, m[3] or m[6] or ""
        if name in RAW and not m[0].endswith("/>"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            yield "close", name, ""


def labels(attributes: str) -> str:
    """Names in class, id and role, lower-cased and in order; ``hidden`` for
    an element that is not shown."""
    out = []
    for m in NAMES.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("hidden", "aria-hidden"):
            if key == "hidden" or value.lower() == "true":
                out.append("hidden")
        elif key == "style":
            if UNSHOWN.search(value):
                out.append("hidden")
        else:
            out += value.lower().split()
    return ".".join(out)


@lru_cache(1 << 14)
def worded(step: str) -> bool:
    """Whether a step of a path is set apart by what it is called in class, id
    or role, is not shown, or is a form.  Names of articles, body and html
    don't count.  Whatever is found here gives way where the element is
    around most of the text."""
    name, _, names = step.partition(".")
    if name == "form":
        return True
    if not names or name in CONTENT or name in ("body", "html"):
        return "hidden" in names.split(".") and name in CONTENT
    for one in names.split("."):
        words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"\d+", "", one)) if w]
        if not words or one == name:
            continue
        if len(words) == 1:
            if words[0] in APART_WORDS or COMMENTS.fullmatch(words[0]):
                return True
            continue
        if words[-1] in STATES or words[0] in DENIALS:
            continue
        if words[0] in STEMS or any(w in ANYWHERE or COMMENTS.fullmatch(w) for w in words):
            return True
        if any(pair in TEASERS for pair in zip(words, words[1:], strict=False)):
            return True
    return False


def apart(step: str) -> bool:
    """Whether a step of a path looks set apart, by its element or its names."""
    name = step.partition(".")[0]
    return name in APART or name in RAW or worded(step)


@lru_cache(1 << 14)
def standing(path: str) -> tuple[str, ...] | None:
    """Elements around a block that are set apart by names, outermost first;
    None if one is by its element, so that it never holds the article's text."""
    steps, inside = path.split("/"), False
    for s in steps:
        name = s.partition(".")[0]
        if name in RAW or (name in APART and not (inside and name == "header")):
            return None
        inside = inside or name in CONTENT
    return tuple("/".join(steps[:i + 1]) for i, s in enumerate(steps) if worded(s))


def parse(page: str) -> tuple[list[str], list[tuple[str, str]]]:
    """(tag roles in page order, blocks).  A role is a path of structural
    elements, ``name.class...`` each; a block is (path, text)."""
    roles: list[str] = []
    blocks: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # (element, path)
    buffer: list[str] = []

    def end_block() -> None:
        if buffer:
            text = SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
            if text:
                blocks.append((stack[-1][1] if stack else "", text))
            buffer.clear()

    for kind, name, attributes in tokens(page):
        if kind == "text":
            if not (stack and stack[-1][0] in RAW):
                buffer.append(name)
            continue
        if name in INLINE and not (kind == "open" and apart(f"{name}.{labels(attributes)}")) and not any(
                e == name for e, _ in stack):
            continue
        if name in ("br", "wbr", "hr"):
            buffer.append(" " if name != "wbr" else "")
            if name == "hr":
                end_block()
            continue
        if name in VOID:
            continue
        end_block()
        if kind == "open":
            if name in LEAVES and stack and (stack[-1][0] == name or stack[-1][0] == "p"):
                stack.pop()
            elif stack and stack[-1][0] == "p" and name not in INLINE:
                stack.pop()
            names = labels(attributes)
            step = f"{name}.{names}" if names else name
            path = f"{stack[-1][1]}/{step}" if stack else step
            roles.append(path)
            stack.append((name, path))
        else:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                roles.append(f"{stack[at][1]}/")
                del stack[at:]
    end_block()
    return roles, blocks


def host_of(url) -> F.Column:
    """Lower-cased host of a URL; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]*:?//([^/?#]*)", 1))


def content_slots(path: str) -> list[str]:
    """Elements around a block that can be its slot: none if one of them never
    holds the article, none deeper than the outermost article element, and
    none that only marks a block."""
    out, steps = [], path.split("/")
    if standing(path) is None:
        return out
    for i, step in enumerate(steps):
        name = step.partition(".")[0]
        if name not in LEAVES:
            out.append("/".join(steps[:i + 1]))
        if name in CONTENT:
            break
    return out


def text_key(path: str, text: str) -> int:
    """64-bit hash of a block."""
    return int.from_bytes(hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "replace"), digest_size=8).digest(),
                          "little", signed=True)


def named_lengths(blocks: list[tuple[str, str]]) -> dict[str, int]:
    """Text length of each element that is set apart by its names, and of the
    whole page as ""."""
    out: dict[str, int] = {}
    for p, t in blocks:
        names = standing(p)
        for e in ("", *names) if names is not None else ():
            out[e] = out.get(e, 0) + len(t)
    return out


def extract(blocks: list[tuple[str, str]], main: str | None, around: set[str] | None = None,
            alike: frozenset[int] = frozenset()) -> str:
    """Texts of the main slot, in page order.  Without one: of the article
    elements, or else of all that is not set apart.  ``around`` are elements
    that are not set apart whatever their names; without it, those that have
    MAIN_SHARE of the page's text.  ``alike`` are keys of the template's texts,
    which are left out unless the page has no other text."""
    if around is None:
        size = named_lengths(blocks)
        around = {e for e, n in size.items() if e and n >= MAIN_SHARE * size[""]}
    kept = [(p, t) for p, t in blocks if (e := standing(p)) is not None and (not e or e[-1] in around)]
    if alike:
        kept = [(p, t) for p, t in kept if text_key(p, t) not in alike] or kept
    if main is not None:
        chosen = [t for p, t in kept if p == main or p.startswith(main + "/")]
    else:
        chosen = [t for p, t in kept if CONTENT.intersection(s.partition(".")[0] for s in p.split("/"))]
    return "\n\n".join(chosen or [t for _, t in kept])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``pages`` without ``html`` and with ``text``, ``n_chars`` and
    ``n_template`` (tag roles of the page's template), one row per row.
    Columns with these names are replaced.

    NULL and empty html give the empty text.  A page without a host, or whose
    host has fewer than MIN_PAGES pages, has no template; elements alone
    decide there.  Repeated rows are pages of their own.  Whole pages are
    parsed.  An empty table gives no rows.

    A text counts by the distinct pages that hold it, so copies of a page make
    no template.

    Of a page only its distinct tag roles, hashes of its texts and text slots
    are aggregated; a template has no more roles than MIN_SHARE of a host's
    pages can share.
    Pages are dealt over SALTS parts of their host when they meet it.
    """
    spark = pages.sparkSession
    importable(spark)
    gone = {"text", "n_chars", "n_template", html_col.lower()}
    keep = [c for c in pages.columns if c.lower() not in gone]
    host = host_of(F.col(url_col))
    src = pages.select(F.struct(*keep).alias("row"), host.alias("host"), F.col(html_col).alias("html"))

    def read_roles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, page, kinds, role, within, text, copy, count, chars = ([] for _ in range(9))
            for url, row, same, doc in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                roles, blocks = parse(doc or "")
                seen: dict[tuple[int, str, str, int], int] = {}
                sizes: dict[tuple[int, str, str, int], int] = {}
                for r in roles:
                    seen[0, r, "", 0] = seen.get((0, r, "", 0), 0) + 1
                for p, t in blocks:
                    names = standing(p)
                    if names is None:
                        continue
                    inner = (names or ("",))[-1]
                    for slot in content_slots(p):
                        seen[1, slot, inner, 0] = seen.get((1, slot, inner, 0), 0) + len(t)
                    token = (2, p, inner, text_key(p, t))
                    seen[token] = seen.get(token, 0) + 1
                    sizes[token] = sizes.get(token, 0) + len(t)
                for e, n in named_lengths(blocks).items():
                    seen[3, e, "", 0] = n
                for token, n in seen.items():
                    hosts.append(url)
                    page.append(row)
                    kinds.append(token[0])
                    role.append(token[1])
                    within.append(token[2])
                    text.append(token[3])
                    copy.append(same if token[0] == 2 or token[:2] == (3, "") else 0)
                    count.append(n)
                    chars.append(sizes.get(token, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(page, pa.int64()), pa.array(kinds, pa.int32()),
                 pa.array(role, pa.string()), pa.array(within, pa.string()), pa.array(text, pa.int64()),
                 pa.array(copy, pa.int64()), pa.array(count, pa.int64()), pa.array(chars, pa.int64())],
                names=["host", "page", "kind", "role", "within", "text", "copy", "count", "chars"])

    # a page is known by its content and place; copies of a page have one vector entry each
    named = src.where("host <> ''").select(
        "host", F.xxhash64("row", F.monotonically_increasing_id()).alias("page"), F.xxhash64("html").alias("copy"), "html")
    counted = (named.mapInArrow(read_roles, "host string, page long, kind int, role string, within string, text long, "
                               "copy long, count long, chars long")
               .groupBy("host", "kind", "role", "within", "text", "copy")
               .agg(F.count(F.lit(1)).alias("pages"), F.sum("count").alias("count"), F.sum("chars").alias("chars"),
                    F.sum((F.xxhash64("page", "count") % F.lit(1 << 40))).alias("vector")))
    counted = written(counted, "roles")
    tags = counted.where("kind = 0")
    named = counted.where("kind = 3")
    whole = named.where("role = ''").groupBy("host").agg(F.sum("count").alias("of"), F.count(F.lit(1)).alias("all_copies"))
    # texts on several pages that are not copies of each other
    texts = (counted.where("kind = 2").groupBy("host", "role", "within", "text")
             .agg(F.sum("pages").alias("pages"), F.sum("vector").alias("vector"), F.sum("chars").alias("chars"),
                  F.count(F.lit(1)).alias("copies"))
             .where(F.col("copies") >= MIN_PAGES))
    members = ["host", "pages", "vector"]
    classes = (tags.select(members).unionAll(texts.select(members)).groupBy(members).agg(F.count(F.lit(1)).alias("n"))
               .where((F.col("n") >= MIN_CLASS) & (F.col("pages") >= MIN_PAGES)))
    of_host = tags.groupBy("host").agg(F.max("pages").alias("all_pages"))
    valid = (tags.join(classes, members).join(of_host, "host")
             .where(F.col("pages") >= MIN_SHARE * F.col("all_pages")))
    # nested: a role whose enclosing role is in the template, or that has none
    own = valid.select("host", "role")
    outer = F.regexp_extract("role", r"^(.*)/[^/]+/?$", 1)
    nested = (own.withColumn("outer", outer)
              .join(own.select("host", F.col("role").alias("outer"), F.lit(1).alias("there")),
                    ["host", "outer"], "left")
              .where("there = 1 OR outer = ''"))
    # elements around the main slot: they have MAIN_SHARE of the host's text, whatever their names
    around = (named.where("role <> ''").join(whole, "host")
              .where(F.col("count") >= MAIN_SHARE * F.col("of")).select("host", F.col("role").alias("within")))
    open_ = around.union(of_host.select("host", F.lit("")))
    # the template's texts, where little other text stands in their role
    alike = (texts.join(classes, members).join(of_host, "host").join(whole, "host")
             .where((F.col("pages") >= MIN_SHARE * F.col("all_pages"))
                    & (F.col("copies") >= MIN_SHARE * F.col("all_copies")))
             .join(own, ["host", "role"]).select("host", "role", "within", "text", "chars"))
    full = alike.groupBy("host", "role").agg(F.sum("chars").alias("held"))
    full = (counted.where("kind = 2").groupBy("host", "role").agg(F.sum("chars").alias("of")).join(full, ["host", "role"])
            .where(F.col("held") >= ALIKE_SHARE * F.col("of")).select("host", "role"))
    alike = written(alike.join(full, ["host", "role"]), "alike")
    steps = F.split("role", "/")
    taken = (alike.join(open_, ["host", "within"])
             .select("host", "chars", F.explode(F.transform(
                 F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))).alias("role"))
             .groupBy("host", "role").agg(F.sum("chars").alias("taken")))
    # the main slot: the deepest that holds all text that is not set apart and not the template's
    slots = (counted.where("kind = 1").join(open_, ["host", "within"])
             .groupBy("host", "role").agg(F.sum("count").alias("count"))
             .join(nested.select("host", "role"), ["host", "role"]).join(taken, ["host", "role"], "left")
             .withColumn("count", F.col("count") - F.coalesce("taken", F.lit(0))))
    most = slots.groupBy("host").agg(F.max("count").alias("most"))
    slots = (slots.join(most, "host").where((F.col("count") == F.col("most")) & (F.col("most") > 0))
             .groupBy("host").agg(F.max(F.struct(F.size(F.split("role", "/")).alias("depth"), "count", "role"))
                                  .alias("main")))
    templates = (nested.groupBy("host").agg(F.sort_array(F.collect_set("role")).alias("template"))
                 .join(slots.select("host", F.col("main.role").alias("main")), "host", "left")
                 .join(around.groupBy("host").agg(F.collect_set("within").alias("around")), "host", "left")
                 .join(alike.groupBy("host").agg(F.collect_set("text").alias("alike")), "host", "left"))
    templates = written(templates, "templates")

    dealt = src.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    copies = templates.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    # hosts that have a template meet it; the rest needs no shuffle partner
    met = dealt.join(copies, ["host", "salt"], "left").select("row", "html", "template", "main", "around", "alike")

    def slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, sizes = [], []
            for doc, template, main, around, alike in zip(*(b.column(i).to_pylist() for i in range(1, 6)), strict=True):
                roles, blocks = parse(doc or "")
                known = set(template or ()).intersection(roles)
                sizes.append(len(known))
                texts.append(extract(blocks, main if main in known else None,
                                     None if template is None else set(around or ()), frozenset(alike or ()))
                             .encode("utf-8", "replace").decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(sizes, pa.int64())], names=["row", "text", "n_chars", "n_template"])

    schema = T.StructType([met.schema["row"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType()),
                           T.StructField("n_template", T.LongType())])
    return met.mapInArrow(slots_of, schema).select("row.*", "text", "n_chars", "n_template")


def op6_html_text(spark, sf_dir):
    return main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
