"""Main text of web pages by deducing the template of each host.

Tokens (tags, words outside of articles, stretches of text inside) that occur equally often on every page of a host share
an occurrence vector and form an equivalence class. A class is valid if its tokens come in one order on all
pages and it nests in one gap of the class that occurs once a page; that class is the host's template. The
gaps are the slots, told apart by the role of the container too: its elements, and the class and id words that
the host's pages share. The text of a page is that of the slots whose prose varies over the host's pages, without
the blocks made of template tokens only; where a page has an article or main element, of the slots in it.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, map_batches
from tamiz.session import materialise

#: Words are part of a template only on hosts with this many pages: on fewer, words of the text coincide.
PAGES_FOR_WORDS = 8
LEAST_SHARE = 0.5
#: On fewer different pages nothing is said to recur.
PAGES_TO_RECUR = 3
PAGE = 0  # the token that every page has once
#: Sums of vectors that a worker holds before it passes them on.
TOKENS_HELD = 50_000

# Fixed values of HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "select", "title")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset(
    "html head body header footer nav aside main article section div form ul ol dl table menu dialog figure fieldset details button".split()
)
# Parts of a page that are not its article, by element or by words of their class, id or role.
ASIDE_ELEMENTS = frozenset("head nav footer aside menu dialog button".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription "
    "share sharing social related recommended comment comments commentlist respond replies disqus widget toolbar pagination pager login "
    "signup search toc copyright disclaimer".split()
)
#: Of these, the ones that are subjects or parts of articles too: alone they say little.
UNSURE_WORDS = frozenset(
    "adv banner promotion sponsor navigation menu header masthead consent notice notices share sharing social related recommended replies "
    "respond toolbar widget login search toc disclaimer modal subscription".split()
)
#: Words beside a sure one that do not change what it says.
GENERIC_WORDS = frozenset("area body block box container content entry form inner item list main outer page post reader section site thread top user wrap wrapper".split())
ARTICLE_WORDS = frozenset("reply teaser preview".split())  # what article elements are marked with besides, if not the article
MAIN_ELEMENTS = frozenset({"article", "main"})

# What a stretch of text is in. On a page with an article the text outside it is left out.
LEFT_OUT, PLAIN, ARTICLE, ARTICLE_UNSURE, UNSURE, MARKED, PAGE_WITH, PAGE_WITHOUT = range(-1, 7)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAMED_CONTAINER = re.compile(r"<(" + "|".join(sorted(CONTAINERS)) + r")\s((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.I)
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


@dataclass(slots=True)
class Piece:
    """A tag or a stretch of text, with the containers it is in."""

    tag: str  # "" for text
    closing: bool
    text: str
    path: str
    main: bool
    link: bool
    part: int  # of text
    unsure: str  # the path of the innermost container with an unsure mark


def marked(words: list[str], article: bool) -> bool | None:
    """Whether class words say that a container is no part of the article: True, None for unsure, or False."""
    unsure = False
    for word in words:
        parts = set(re.findall("[a-z]+", word))
        aside = parts & ASIDE_WORDS | (parts & ARTICLE_WORDS if article else set())
        if aside - UNSURE_WORDS and not parts - aside - GENERIC_WORDS:
            return True
        unsure |= bool(aside)
    return None if unsure else False


@dataclass(slots=True)
class Main:
    """An article or main element that is in no other one."""

    marks: tuple[int, ...]  # marked containers around it, itself included
    clean: int = 0  # text outside marked containers in it
    chars: int = 0


def pieces(page: str, names: frozenset[str] = frozenset()) -> list[Piece]:
    """The tags and texts of a page. ``names`` are the words (``element.word``) that tell containers of its host apart.

    Class words do not remove what encloses the article, nor all of its text."""
    out: list[Piece] = []
    held: list[tuple[Piece, int, tuple[int, ...]]] = []  # texts with their article and marked containers
    mains: list[Main] = []
    # element, path, article, marked containers, unsure container, whether an element says it is aside
    stack: list[tuple[str, str, int, tuple[int, ...], str, bool]] = [("", "", -1, (), "", False)]
    link, at, marks_made = False, 0, 0

    def text(end: int) -> None:
        _, path, main, marks, unsure, aside = stack[-1]
        piece = Piece("", False, page[at:end], path, main >= 0, link, LEFT_OUT, unsure)
        out.append(piece)
        if not aside and (size := len(piece.text.strip())):
            held.append((piece, main, marks))
            if main >= 0:
                mains[main].chars += size
                mains[main].clean += size * (marks == mains[main].marks)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            text(m.start())
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing = bool(m[2])
        if tag == "a":
            link = not closing
        _, path, main, marks, unsure, aside = stack[-1]
        if tag in CONTAINERS and not closing:
            words = " ".join("".join(x) for x in NAMED.findall(m[4] or "")).lower().split() if m[4] else []
            shared = sorted({w for w in words if f"{tag}.{w}" in names})
            path = f"{path}/{'.'.join([tag, *shared])}"
            # a header inside the article holds its title
            aside = aside or tag in ASIDE_ELEMENTS or tag == "header" and main < 0
            mark = tag == "form" or words and tag not in ("html", "body", "main") and marked(words, tag == "article")
            if mark:
                marks, marks_made = (*marks, marks_made), marks_made + 1
            elif mark is None and tag != "article":
                unsure = path
            if main < 0 and (tag in MAIN_ELEMENTS or "main" in words):
                main, unsure = len(mains), ""
                mains.append(Main(marks))
            stack.append((tag, path, main, marks, unsure, aside))
        out.append(Piece(tag, closing, "", path, main >= 0, link, LEFT_OUT, unsure))
        if closing and tag in CONTAINERS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
    if at < len(page):
        text(len(page))
    best = max(mains, key=lambda x: (x.chars > 0, x.clean > 0, not x.marks, x.chars), default=None)
    if best and best.chars:
        lifted = set(best.marks)
        for piece, main, marks in held:
            if main >= 0 and (lifted.issuperset(marks) or not best.clean and mains[main] is best):
                piece.part = ARTICLE_UNSURE if piece.unsure else ARTICLE
    else:
        for piece, _, marks in held:
            piece.part = MARKED if marks else UNSURE if piece.unsure else PLAIN
    return out


def _named(batches: Batches) -> Batches:
    for batch in batches:
        seen: Counter[tuple[str, str]] = Counter()
        for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html"))):
            words = {""}
            for m in NAMED_CONTAINER.finditer(page):
                words.update(f"{m[1].lower()}.{w}" for x in NAMED.findall(m[2]) for w in "".join(x).lower().split())
            seen.update((host, w) for w in words)
        columns = [pa.array([k[i] for k in seen], pa.string()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(seen.values(), pa.int64())], ["host", "name", "support"])


def shared_names(pages: DataFrame) -> DataFrame:
    """(host, names): class, id and role words of containers on more than half of the host's pages, as ``element.word``.

    With them a container has the same path on all pages, whatever else its class and id say on each."""
    support = map_batches(pages, _named, "host string, name string, support long").groupBy("host", "name").agg(F.sum("support").alias("support"))
    support = materialise(support, "names")
    of_host = support.where("name = ''").select("host", F.col("support").alias("pages"))
    shared = support.where("name != ''").join(of_host, "host").where(F.col("support") > LEAST_SHARE * F.col("pages"))
    return shared.groupBy("host").agg(F.sort_array(F.collect_list("name")).alias("names"))


#: What a page's row says about its host.
OF_HOST = ("names", "classes", "template", "fixed", "slots")


def _rows(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """Values of the named columns, then the page and its pieces.

    Lists of a host come with each of its pages; they are made Python objects once for a run of pages, as sets but for
    ``classes``."""
    wanted = [c for c in OF_HOST if c in batch.schema.names]
    hosts, pages = batch.column("host").to_pylist(), batch.column("html")
    own = [batch.column(c).to_pylist() if c not in OF_HOST else None for c in columns]
    of_host: dict = {}
    for i, host in enumerate(hosts):
        if not i or host != hosts[i - 1]:
            of_host = {c: batch.column(c)[i].as_py() or () for c in wanted}
            of_host |= {c: frozenset(v) for c, v in of_host.items() if c != "classes"}
        page = pages[i].as_py()
        yield *(of_host[c] if values is None else values[i] for c, values in zip(columns, own)), page, pieces(page, of_host.get("names", frozenset()))


@lru_cache(1 << 16)
def token(kind: str, name: str, path: str) -> int:
    """A tag, a word, or a stretch of text in an article; the last kind alone has odd numbers."""
    return xxhash.xxh64_intdigest(f"{kind}\0{name}\0{path}") >> 2 << 1 or 2


def text_token(words: list[str], path: str) -> int:
    return token.__wrapped__("t", " ".join(words), path) | 1


def has_texts(some: Iterable[int]) -> bool:
    return any(t & 1 for t in some)


def unescaped(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def tokens(page: list[Piece], with_words: bool = True, with_texts: bool = True) -> Iterator[tuple[int, int]]:
    """(index of the piece, token): the role of a token is its place among the containers.

    In an article words coincide for other reasons, whole stretches of text do not."""
    for i, p in enumerate(page):
        if p.tag:
            yield i, token("/" if p.closing else "<", p.tag, p.path)
        elif not with_words or p.main and not with_texts:
            continue
        elif not p.main:
            for word in unescaped(p.text).split():
                yield i, token("w", word, p.path)
        elif words := unescaped(p.text).split():
            yield i, text_token(words, p.path)


def _vectors(batches: Batches) -> Batches:
    def summed(seen: dict[tuple[str, int, bool], list[int]]) -> pa.RecordBatch:
        # stretches of text belong to the class that every page has once or to none, so one that a page lacks goes at once
        keys = [k for k in seen if not k[1] & 1 or seen[k][2] == seen[k[0], PAGE, False][2] == seen[k][3]]
        columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.bool_()))]
        columns += [pa.array([seen[k][i] for k in keys], pa.int64()) for i in range(6)]
        return pa.RecordBatch.from_arrays(columns, ["host", "token", "word", "v1", "v2", "support", "total", "low", "high"])

    for batch in batches:
        seen: dict[tuple[str, int, bool], list[int]] = defaultdict(lambda: [0, 0, 0, 0, 1 << 62, 0])
        for host, row, page, found in _rows(batch, "host", "row"):
            if len(seen) > TOKENS_HELD:
                yield summed(seen)
                seen.clear()
            copy = xxhash.xxh64_intdigest(page) >> 2
            counts = Counter((t, not found[i].tag) for i, t in tokens(found))
            counts[PAGE, False] = 1
            hashes = {n: xxhash.xxh64_intdigest(f"{row} {n}") for n in set(counts.values())}
            for (t, word), n in counts.items():
                h = hashes[n]
                sums = seen[host, t, word]
                sums[0] += h & 0x7FFFFFFF
                sums[1] += h >> 33
                sums[2] += 1
                sums[3] += n
                sums[4], sums[5] = min(sums[4], copy), max(sums[5], copy)
        yield summed(seen)


def occurrence_classes(pages: DataFrame) -> DataFrame:
    """(host, class, once, tokens): tokens that share an occurrence vector, at least two of them, on at
    least half of the host's pages. ``once``: the class occurs once on every page, as stretches of text in articles have to.

    A vector is held as two sums over pages of a hash of page and count, so it is built by partial sums
    whatever the number of pages. Words that only copies of one page have are no template words."""
    vectors = map_batches(pages, _vectors, "host string, token long, word boolean, v1 long, v2 long, support long, total long, low long, high long")
    vectors = vectors.groupBy("host", "token").agg(
        F.min("word").alias("word"), *(F.sum(c).alias(c) for c in ("v1", "v2", "support", "total")),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    vectors = materialise(vectors, "occurrence-vectors")
    is_text, whole = F.col("token") % 2 == 1, (F.col("support") == F.col("pages")) & (F.col("total") == F.col("pages"))
    of_host = vectors.where(F.col("token") == PAGE).select("host", F.col("support").alias("pages"))
    frequent = vectors.where(F.col("token") != PAGE).join(of_host, "host").where(
        (F.col("support") >= LEAST_SHARE * F.col("pages")) & (~F.col("word") | (F.col("pages") >= PAGES_FOR_WORDS) & (F.col("low") != F.col("high")))
    ).where(~is_text | whole)
    classes = frequent.groupBy("host", F.xxhash64("v1", "v2", "support", "total").alias("class"), whole.alias("once"))
    return classes.agg(F.sort_array(F.collect_list("token")).alias("tokens")).where(F.size("tokens") > 1)


def _layouts(batches: Batches) -> Batches:
    """Per page and class: the order of its tokens, whether it is broken, and the gap of the once-class it is in."""
    names = ["host", "class", "sequence", "broken", "gap"]
    for batch in batches:
        rows = []
        for host, classes, _, found in _rows(batch, "host", "classes"):
            of = {t: c["class"] for c in classes for t in c["tokens"]}
            base = next((c["class"] for c in classes if c["once"]), None)
            orders, gaps, gap = defaultdict(list), {}, 0
            for _, t in tokens(found, with_texts=has_texts(of)):
                if (c := of.get(t)) is None:
                    continue
                orders[c].append(t)
                if c == base:
                    gap += 1
                else:
                    low, high = gaps.get(c, (gap, gap))
                    gaps[c] = min(low, gap), max(high, gap)
            for c, order in orders.items():
                cycle = len(set(order))
                broken = any(order[i] != order[i % cycle] for i in range(len(order)))
                low, high = gaps.get(c, (0, 0))
                rows.append((host, c, xxhash.xxh64_intdigest(repr(order[:cycle])) >> 1, broken or low != high, low))
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def valid_classes(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes whose tokens keep one order on all pages and, unless once a page, lie in one gap."""
    listed = classes.groupBy("host").agg(F.collect_list(F.struct("class", "once", "tokens")).alias("classes"))
    seen = map_batches(
        pages.join(materialise(listed, "host-classes"), "host").select(*pages.drop("row").columns, "classes"), _layouts,
        "host string, class long, sequence long, broken boolean, gap long",
    )
    checked = seen.groupBy("host", "class").agg(
        F.max("broken").alias("broken"), *(f(c).alias(f"{c}_{n}") for c in ("sequence", "gap") for n, f in (("low", F.min), ("high", F.max)))
    )
    whole = checked.where(
        ~F.col("broken") & (F.col("sequence_low") == F.col("sequence_high")) & (F.col("gap_low") == F.col("gap_high"))
    )
    return classes.join(whole.select("host", "class"), ["host", "class"], "left_semi")


def _gaps(page: list[Piece], template: frozenset[int]) -> Iterator[tuple[int, Piece]]:
    """Pieces with the gap of the template they are in."""
    marks: dict[int, int] = {}
    for i, t in tokens(page, with_texts=has_texts(template)) if template else ():
        if t in template:
            marks[i] = marks.get(i, 0) + 1
    gap = 0
    for i, p in enumerate(page):
        if p.tag and i in marks:
            gap += 1
        yield gap, p
        if not p.tag:
            gap += marks.get(i, 0)


def _key(gap: int, piece: Piece) -> str:
    return f"{gap}|{piece.part}|{piece.unsure}|{piece.path}"


def _slots(batches: Batches) -> Batches:
    """By page and slot: how much text there is, how much in links, and its hash."""
    kinds = {"host": pa.string(), "slot": pa.string(), "path": pa.string(), "unsure": pa.string()}
    kinds |= dict.fromkeys(("part", "chars", "links", "text", "page"), pa.int64())
    for batch in batches:
        rows = []
        for host, template, page, found in _rows(batch, "host", "template"):
            copy = xxhash.xxh64_intdigest(page) >> 1
            has_article = any(p.part in (ARTICLE, ARTICLE_UNSURE) for p in found)
            rows.append((host, "", "", "", PAGE_WITH if has_article else PAGE_WITHOUT, 0, 0, 0, copy))
            sums: dict[str, list] = {}
            for gap, p in _gaps(found, template):
                if p.part != LEFT_OUT and (text := p.text.strip()):
                    total = sums.setdefault(_key(gap, p), [p, 0, 0, xxhash.xxh64()])
                    if p.part != ARTICLE:
                        words = text.split()
                        text, size = " ".join([*words, ""]), sum(map(len, words))
                        total[1] += size
                        total[2] += size * p.link
                    total[3].update(text)
            rows += [(host, k, p.path, p.unsure, p.part, n, links, h.intdigest() >> 1, copy) for k, (p, n, links, h) in sums.items()]
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


def content_slots(pages: DataFrame) -> DataFrame:
    """(host, slots): the slots that hold the article.

    A slot is constant if its text is the same on half of its pages or more. In articles a slot goes only if it
    recurs on the host's pages and has one text on all of them. Of pages without an article element, the root is the container with most prose
    (mostly not links, not constant), of containers without a mark if any has some. Slots in the root and slots with
    prose are kept, unless constant. A container with an unsure mark counts as one without if it encloses the root; in
    the root or in an article it goes if it recurs on the host's pages and is constant or mostly links; else it goes."""
    kind = "host string, slot string, path string, unsure string, part long, chars long, links long, text long, page long"
    sums = (*(F.sum(c).alias(c) for c in ("chars", "links")), F.approx_count_distinct("text").alias("texts"), F.approx_count_distinct("page").alias("pages"))
    sized = materialise(map_batches(pages, _slots, kind).groupBy("host", "slot", "path", "unsure", "part").agg(*sums), "slots")
    part, root, path, unsure = F.col("part"), F.col("root"), F.col("path"), F.col("unsure")
    of_host = sized.where(part >= PAGE_WITH).groupBy("host").agg(
        *(F.coalesce(F.max(F.when(part == n, F.col("pages"))), F.lit(0)).alias(c) for c, n in (("with", PAGE_WITH), ("without", PAGE_WITHOUT)))
    )
    constant = (F.col("pages") >= PAGES_TO_RECUR) & (2 * F.col("texts") <= F.col("pages"))
    links = 2 * F.col("links") >= F.col("chars")
    sized = sized.where(part < PAGE_WITH).select("*", constant.alias("constant"), F.when(~links & ~constant, F.col("chars")).otherwise(0).alias("prose"))
    clean = lambda c: F.sum(F.when(part != MARKED, F.col(c)).otherwise(0))
    containers = sized.where(~part.isin(ARTICLE, ARTICLE_UNSURE)).groupBy("host", "path").agg(
        F.struct(clean("prose").alias("clean"), F.sum("prose").alias("prose"), clean("chars").alias("chars"), path).alias("size")
    )
    best = containers.groupBy("host").agg(F.max("size").alias("best"))
    best = best.select("host", F.col("best.path").alias("root"), F.col("best.clean").alias("clean"), F.col("best.prose").alias("most"), F.col("best.chars").alias("unmarked"))
    within = lambda inner, outer: (inner == outer) | inner.startswith(F.concat(outer, F.lit("/")))
    recurs = (F.col("pages") >= PAGES_TO_RECUR) & (2 * F.col("pages") >= F.when(part.isin(ARTICLE, ARTICLE_UNSURE), F.col("with")).otherwise(F.col("without")))
    template = recurs & (F.col("constant") | links)
    plain = (F.col("prose") > 0) | within(path, root) & ~(F.col("constant") & (F.col("most") > 0))
    kept = (
        F.when(part == ARTICLE, ~(recurs & (F.col("texts") == 1)))
        .when(part == ARTICLE_UNSURE, ~template)
        .when(part == PLAIN, plain)
        .when(part == UNSURE, F.when(within(root, unsure), plain).otherwise(within(path, root) & ~template))
        .otherwise((F.col("clean") == 0) & ((F.col("most") > 0) | (F.col("unmarked") == 0)) & within(path, root))
    )
    return sized.join(of_host, "host").join(best, "host", "left").where(kept).groupBy("host").agg(F.collect_set("slot").alias("slots"))


def article_text(found: list[Piece], template: frozenset[int], fixed: frozenset[int], slots: frozenset[str]) -> str:
    """The blocks of text in the given slots, one to a line, without those that are part of the template: outside of
    articles, all of their words are ``fixed``, inside, each stretch of text is in the ``template``.

    A page whose article would lose half of its text or more is not what its host's other pages are; its article stays whole."""
    blocks: list[str] = []
    whole: list[str] = []  # of the article, whatever the slots
    open_block: list[str] = []
    open_whole: list[str] = []
    varied, texts_known = False, has_texts(template)

    def close() -> None:
        nonlocal varied
        if open_block or open_whole:
            text = " ".join(unescaped("".join(open_block)).split())
            full = text if open_whole == open_block else " ".join(unescaped("".join(open_whole)).split())
            if text and varied:
                blocks.append(text)
            if full:
                whole.append(full)
        open_block.clear()
        open_whole.clear()
        varied = False

    for gap, p in _gaps(found, template):
        if p.tag:
            if p.tag in BLOCKS:
                close()
            elif p.tag == "br":
                open_block.append(" ")
                open_whole.append(" ")
            continue
        blank = not p.text or p.text.isspace()
        if blank or p.part == ARTICLE:
            open_whole.append(p.text)
        if blank:
            open_block.append(p.text)
        elif p.part != LEFT_OUT and _key(gap, p) in slots:
            open_block.append(p.text)
            if not varied and p.main:
                varied = not texts_known or text_token(unescaped(p.text).split(), p.path) not in template
            elif not varied:
                varied = not fixed or any(token("w", w, p.path) not in fixed for w in unescaped(p.text).split())
    close()
    if whole and 2 * sum(map(len, blocks)) <= sum(map(len, whole)):
        return "\n".join(whole)
    return "\n".join(blocks)


def _extract(batches: Batches) -> Batches:
    for batch in batches:
        texts = [article_text(found, *lists) for *lists, _, found in _rows(batch, "template", "fixed", "slots")]
        kept = [batch.column(c) for c in ("page_id", "url")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_articles(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of ``pages`` (page_id, url, html).

    A NULL html is an empty page and has the text ''. Pages without a usable url count as one host. Rows
    repeated as a whole, or by page_id, are pages of their own. A host without a valid template, such as one of a single
    unusual page, has the whole page as its one slot."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    names = materialise(shared_names(rows.select("host", "html")), "shared-names")
    rows = rows.join(names, "host", "left")
    named = rows.select("host", F.xxhash64("page_id", "url", "html").alias("row"), "html", "names")
    classes = materialise(occurrence_classes(named), "token-classes")
    valid = valid_classes(named.drop("row"), classes)
    # of several classes that occur once a page there is one vector only, hence one class
    templates = valid.groupBy("host").agg(
        F.flatten(F.collect_list(F.when(F.col("once"), F.col("tokens")))).alias("template"), F.flatten(F.collect_list("tokens")).alias("fixed")
    )
    slotted = rows.join(materialise(templates, "templates"), "host", "left")
    slots = materialise(content_slots(slotted.select("host", "html", "names", "template")), "content-slots")
    return map_batches(
        slotted.join(slots, "host", "left").select("page_id", "url", "host", "html", "names", "template", "fixed", "slots"), _extract,
        "page_id long, url string, text string, n_chars long",
    )
