"""Main-text extraction by template deduction with equivalence classes.

A page is a series of tokens: its container elements, each known by its path of enclosing
containers with classes and ids, and its runs of text. Over the pages of one host every
token has an occurrence vector, how often it occurs in each page. Tokens with the same
vector form an equivalence class; classes of enough tokens and pages are valid. Vectors are
compared by two numbers that tasks add up independently: the pages with the token, and the
exclusive or of a hash of (page, count).

The containers of the valid classes, nested by their paths, are the host's template; what
the pages hold between them are its slots. Texts that most of a host's pages repeat in the
same place are template too, inside an article or main element as well (its place is counted
from that element, whose own path may differ by page). A page's article and main elements are
its main slot if they hold text that is not template, or else the template's main slot is, or
the container whose slots hold most such text. Menus, headers, footers, sidebars, notices,
adverts, forms, comments and such inside it are slots of their own and left out. Hosts with too
few pages for classes use each page's own containers by the same rules.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import cut, map_rows, no_clash

#: A class is valid from so many tokens and pages on.
MIN_TOKENS, MIN_PAGES = 2, 3
#: A text is template if it is in this share of the host's pages (inside article and main: of those with such an element).
COMMON = 0.6
#: Stands for the path of the article or main element around a text.
INSIDE = "main()"
#: Templates of so many hosts at most are broadcast; more are joined by host.
BROADCAST_HOSTS = 20_000
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|textarea|select|iframe|object|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Element names by what they do.
CONTAINERS = frozenset("html head body div section article main nav header footer aside form ul ol dl table fieldset dialog menu center figure".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre address hr figcaption details summary".split())
NOT_MAIN = frozenset("head nav footer aside form fieldset dialog menu button".split())
HINTS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies
disqus footer login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted reply replies respond
related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
#: Words that say how a part is placed or built, not what it is.
PLAIN = frozenset("""area bar block body bottom box card col column container content feed global group grid head header icon inner item items left links
list main outer page panel parent post posts primary right row section secondary site slot stories sub tags thread top unit wrap wrapper zone""".split())
#: Words that turn the next one round.
NEGATIONS = frozenset("no non not without hide".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
SPACE = re.compile(r"\s+")


def hinted(names: str) -> bool:
    """Whether a class or id says that the content isn't main text: a word of it does, and the others say nothing else.

    So ``related-posts`` and ``ad-728x90`` do, ``related-work``, ``notice-board`` and ``no-comments`` don't.
    """
    for name in names.lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if not HINTS.isdisjoint(words) and NEGATIONS.isdisjoint(words) and all(w in HINTS or w in PLAIN or len(w) < 3 for w in words):
            return True
    return False


@lru_cache(8192)
def container(name: str, attributes: str) -> tuple[str, bool, bool]:
    """(path step, whether its content can't be main text, whether it names the main slot)."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    role = found.get("role", "").lower()
    words = "" if name in ("html", "body", "main", "article") else found.get("class", "") + " " + found.get("id", "")
    out = name in NOT_MAIN or role in ROLES or hinted(words)
    step = name + "".join(f".{c}" for c in sorted(found.get("class", "").split())) + (f"#{found['id']}" if found.get("id") else "")
    return step, out, name in ("article", "main") or role == "main"


@dataclass
class Page:
    """Blocks of text with the path of containers around each."""

    blocks: list[tuple[str, str]] = field(default_factory=list)  # (path, text)
    paths: Counter = field(default_factory=Counter)  # containers, by path
    barred: set[str] = field(default_factory=set)  # paths whose content is not main text
    main: list[str] = field(default_factory=list)  # outermost article and main elements, by path


def parse(source: str) -> Page:
    page = Page()
    stack: list[tuple[str, str]] = []  # (element name, path)
    text: list[str] = []
    path = ""

    def flush():
        if text:
            block = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if block:
                page.blocks.append((path, block))
            text.clear()

    at = 0
    for m in TOKEN.finditer(source):
        if m.start() > at:
            text.append(source[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if name not in BLOCKS:
            if name == "br" or name == "button" or name == "img":
                text.append(" ")
            continue
        flush()
        if name not in CONTAINERS:
            continue
        if m[2]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
                path = stack[-1][1] if stack else ""
        elif not m[4].endswith("/"):
            step, out, main = container(name, m[4])
            inside = path in page.barred
            if name == "header" and not any(p == path or path.startswith(p + "/") for p in page.main):
                out = True
            path = f"{path}/{step}"
            stack.append((name, path))
            page.paths[path] += 1
            if out or inside:
                page.barred.add(path)
            elif main and not any(path.startswith(p + "/") for p in page.main):
                page.main.append(path)
    if at < len(source):
        rest = source[at:]
        text.append(rest)
    flush()
    return page


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", url or "", re.I)
    return m[1].rpartition("@")[2].lower() if m else ""


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def text_token(path: str, text: str, roots: list[str]) -> str:
    """A text and its place: the path around it, from the article or main element on if it is in one of ``roots``."""
    root = next((r for r in roots if path == r or path.startswith(r + "/")), None)
    return f"{path if root is None else INSIDE + path[len(root):]}\n{_hash(text)}"


def occurrences(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, token, kind, main, pages, vector, chars, low, high) with each task's share added up.

    Kinds: 0 a container, 1 a text, 2 that a page has an article or main element. ``low`` and ``high``
    are the extremes of a hash of all the page's text that may be main text, so they are equal if
    only copies have the token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0, 1 << 63, -(1 << 63)])
            for url, source in zip(batch.column(0), batch.column(1)):
                host, source = host_of(url.as_py()), source.as_py() or ""
                page, key = parse(source), xxhash.xxh64_intdigest(source)
                chars: Counter = Counter()
                texts: Counter = Counter()
                lengths: Counter = Counter()
                for path, text in page.blocks:
                    chars[path] += len(text)
                    token = text_token(path, text, page.main)
                    texts[token] += 1
                    lengths[token] += len(text)
                main = set(page.main)
                whole = _hash("\n".join(text for path, text in page.blocks if path not in page.barred))
                for token, n, kind in [*((p, n, 0) for p, n in page.paths.items()), *((t, n, 1) for t, n in texts.items()), *([(INSIDE, 1, 2)] if main else [])]:
                    row = total[host, token, kind, token in main]
                    row[0] += 1
                    row[1] ^= _hash(f"{key} {n}")
                    row[2] += 0 if token in page.barred else chars[token] if kind == 0 else lengths[token]
                    row[3], row[4] = min(row[3], whole), max(row[4], whole)
            keys = list(zip(*total)) or [[]] * 4
            sums = list(zip(*total.values())) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(keys[0], pa.string()), pa.array(keys[1], pa.string()), pa.array(keys[2], pa.int32()), pa.array(keys[3], pa.bool_()),
                                              *[pa.array(s, pa.int64()) for s in sums]], names=names)

    names = ["host", "token", "kind", "main", "pages", "vector", "chars", "low", "high"]
    return (pages.select(F.col(url_col).cast("string"), F.col(html_col).cast("string"))
            .mapInArrow(run, "host string, token string, kind int, main boolean, pages long, vector long, chars long, low long, high long")
            .groupBy("host", "token", "kind").agg(F.max("main").alias("main"), F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("chars").alias("chars"),
                                                  F.min("low").alias("low"), F.max("high").alias("high")))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths, main, texts): each host's template containers, its main slot, and its common texts.

    ``paths`` are the containers of the valid equivalence classes; hosts without any have no row.
    Texts inside article and main elements that only copies of one page share are not template.
    """
    seen = cut(occurrences(pages, url_col, html_col).where(F.col("pages") >= MIN_PAGES))
    tags = seen.where("kind = 0")
    sizes = tags.groupBy("host").agg(F.max("pages").alias("host_pages"))
    classes = tags.groupBy("host", "pages", "vector").agg(F.count("*").alias("tokens"), F.collect_list(F.struct("token", "main", "chars")).alias("members")).where(F.col("tokens") >= MIN_TOKENS)
    mains = seen.where("kind = 2").select("host", F.col("pages").alias("main_pages"))
    inside = F.col("token").startswith(INSIDE)
    common = (seen.where("kind = 1").join(sizes, "host").join(mains, "host", "left")
              .where(F.when(inside, (F.col("pages") >= COMMON * F.col("main_pages")) & (F.col("low") < F.col("high")))
                     .otherwise(F.col("pages") >= COMMON * F.col("host_pages"))))
    fixed = common.groupBy("host", F.substring_index("token", "\n", 1).alias("token")).agg(F.sum("chars").alias("fixed"))
    member = (classes.select("host", "pages", F.explode("members").alias("m")).select("host", "pages", "m.*").join(fixed, ["host", "token"], "left")
              .select("host", "pages", F.struct("token", "main", (F.col("chars") - F.coalesce("fixed", F.lit(0))).alias("chars")).alias("m")))
    best = F.max(F.struct(F.col("m.main").cast("int"), F.when(F.col("m.main"), F.col("pages")).otherwise(F.col("m.chars")), F.col("m.token"))).alias("best")
    skeleton = member.groupBy("host").agg(F.collect_set("m.token").alias("paths"), best)
    texts = common.groupBy("host").agg(F.collect_set("token").alias("texts"))
    return skeleton.join(texts, "host", "left").select("host", "paths", F.col("best.token").alias("main"), F.coalesce("texts", F.array().cast("array<string>")).alias("texts"))


def main_text(source: str | None, paths: frozenset[str] | None = None, main: str | None = None, texts: frozenset[str] = frozenset()) -> str:
    """The main slot's blocks that are not template, one a line. Without a template the page's own containers decide.

    An article or main element of nothing but template stays whole if the page has no other text
    (the page is like most others of its host).
    """
    page = parse(source or "")
    inside = lambda p, roots: any(p == r or p.startswith(r + "/") for r in roots)
    usable = [(p, t) for p, t in page.blocks if p not in page.barred and text_token(p, t, page.main) not in texts]
    for roots in (page.main, [main] if main is not None and main in page.paths else []):
        found = [t for p, t in usable if inside(p, roots)]
        if found or (roots and not page.main):
            return "\n".join(found)
    # text outside the template's containers belongs to the slot of the nearest one above
    chars: Counter = Counter()
    for p, t in usable:
        while paths is not None and p and p not in paths and p not in page.paths:
            p = p.rpartition("/")[0]
        chars[p] += len(t)
    if chars:
        root = max(chars, key=lambda p: (chars[p], -len(p)))
        return "\n".join(t for p, t in usable if inside(p, [root]))
    return "\n".join(t for p, t in page.blocks if p not in page.barred and inside(p, page.main))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` plus ``text``: the main text, empty if there is none.

    Null pages are empty; a null url is a host of its own. Repeated rows stay (pages that are
    repeated an even number of times leave the vectors as they were). Templates are broadcast
    up to ``BROADCAST_HOSTS`` hosts and joined by host beyond. A column ``text`` of ``pages`` is an error.
    """
    no_clash(pages, ["text"])
    found = cut(templates(pages, url_col, html_col))
    host = F.udf(host_of, "string")
    many = found.limit(BROADCAST_HOSTS + 1).count() > BROADCAST_HOSTS
    at = [pages.columns.index(c) for c in (url_col, html_col)]
    schema = T.StructType([*[f for f in pages.schema.fields], T.StructField("text", T.StringType())])

    def parts(row):
        return frozenset(row["paths"]), row["main"], frozenset(row["texts"])

    if not many:
        shared = pages.sparkSession.sparkContext.broadcast({r["host"]: parts(r) for r in found.collect()})

        def run(batches):
            for batch in batches:
                texts = [main_text(s.as_py(), *shared.value.get(host_of(u.as_py()), ())) for u, s in zip(batch.column(at[0]), batch.column(at[1]))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

        return map_rows(pages, run, schema)
    keyed = pages.withColumn("__host", host(F.col(url_col))).join(found.withColumnRenamed("host", "__host"), "__host", "left").select(*pages.columns, "paths", "main", "texts")

    def run_joined(batches):
        n = len(schema) - 1
        for batch in batches:
            rows = zip(batch.column(at[1]), *(batch.column(n + i) for i in range(3)))
            texts = [main_text(s.as_py(), *((frozenset(p.as_py()), m.as_py(), frozenset(t.as_py())) if p.is_valid else ())) for s, p, m, t in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], names=schema.names)

    return keyed.mapInArrow(run_joined, schema)
