"""Main text of web pages by wrappers inferred from the pages of a host.

A page's token stream is read into nested blocks. A host's wrapper is a union-free regular
expression over such blocks, found by aligning page after page with it: neighbours of the same kind
become a repeated group, blocks that one side lacks become optional, and texts that differ become
slots; a text that never differs is the template's. Wrappers align with wrappers too, so every
partition folds its own pages and only wrappers travel: one per host and partition, in two rounds,
however many pages a host has. They hold digests in place of texts.

Every page is read by its host's wrapper. Of the articles a page marks, those with text in slots
are the main text; one that the host repeats unchanged is template. Pages that mark no article lose
their template texts, and the block with most text in slots is taken.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelscope.llm.text import own_name
from parcelscope.llm.url_rules import address
from parcelscope.settings import staged

# Hosts whose wrappers a task folds at a time, and tasks that share a host's wrappers in round one.
HOSTS = 2_000
SHARES = 64
# Blocks inside each other that are kept apart. Below that depth a block only starts a new line, in the
# deepest block kept; articles and parts beside the article are kept apart for some levels more.
DEPTH, MORE = 120, 40

# Kinds of elements.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe select object xmp annotation annotation-xml desc metadata".split())
_BLOCKS = set(
    "html head body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article "
    "main header footer nav aside form fieldset figure figcaption blockquote pre address details summary menu dialog "
    "center button label legend hgroup search".split()
)
_IN_LINE = {"button", "label"}
_PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption".split())
_CLOSES_P = _BLOCKS - {"button", "label", "legend", "summary", "td", "th", "tr", "li", "dt", "dd", "caption"} | {"hr"}
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_LEFT_OUT = _RAW | set("head nav footer aside form menu dialog button".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Words in class and id that mark parts beside the article.
_MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "sidebar aside footer masthead topbar breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations trending widget comment comments commentlist discussion disqus replies reply respond "
    "feedback toolbar skip search copyright disclaimer".split()
)
# Inside an article a class marks a block only if the whole of it does, with these words at most beside.
_FILL = set("slot box unit area section list block container wrapper wrap inner item items bar links link buttons button form count".split())
_PLACES = set("in inline article content text body page top middle bottom left right side mid".split())
# Words that also name content: such a block of an article is left out only if the host repeats it.
_SOFT = set("notice notices alert banner promotion menu overlay search feedback discussion copyright disclaimer".split())
# Ids that mark a part of an article; others may be slugs of its headings.
_PARTS = set("comments commentlist disqus respond replies sidebar navbar masthead topbar breadcrumb breadcrumbs pagination pager".split())
# Inside an article, a class token or id that begins or ends with one of these names reader comments,
# and a class token that does so with one of those an advert (``ad-hoc`` is neither).
_COMMENTS = set("comment comments".split())
_ADVERTS = set("ad ads advert adverts advertisement advertisements sponsored sponsor".split())
# First words of class tokens that state what a box has, not what it is.
_STATES = set("has with without no is not js".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|</?[A-Za-z][^>]*(?:>|\Z)", re.S)
_LEAD = re.compile("h[1-6]|p|hgroup")
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""\s(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?(?=[\s/>])""", re.I)


class Block:
    """A block of a page: name, kind (name, id and classes without digits), children that are blocks
    or texts, whether it is beside the article, and whether it is so only if it is the template's."""

    __slots__ = ("name", "kind", "children", "aside", "article", "soft", "depth", "shared")

    def __init__(self, name: str, kind: str, aside: bool = False, article: bool = False, soft: bool = False):
        self.name, self.kind, self.children, self.aside, self.article, self.soft = name, kind, [], aside, article, soft
        self.depth, self.shared = 0, False

    def open_in(self, around: Block) -> None:
        """Become a child, or below the greatest depth a line of the block around."""
        self.depth = around.depth + 1
        special = self.aside or self.article
        if self.depth <= DEPTH or special and self.depth <= DEPTH + MORE:
            around.children.append(self)
            return
        self.depth = around.depth
        if not self.aside:  # else what it holds goes nowhere
            self.shared, self.children = True, around.children
            self.children.append(Block("hr", "hr"))


class Text:
    __slots__ = ("value",)

    def __init__(self, value: str):
        self.value = value


def _attributes(tag: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(tag)} if " " in tag or "\n" in tag else {}


def _marked(attributes: dict[str, str]) -> set[str]:
    spelt = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{attributes.get('class', '')} {attributes.get('id', '')}")
    return set(re.findall(r"[a-z]+", spelt.lower()))


def _token_words(value: str) -> list[list[str]]:
    """The words of each class token or id."""
    spelt = [re.sub(r"([a-z])([A-Z])", r"\1 \2", token) for token in value.split()]
    return [words for words in (re.findall(r"[a-z]+", token.lower()) for token in spelt) if words]


def _side_marks(name: str, attributes: dict[str, str], inside: bool) -> set[str]:
    """The words of class and id that mark a block as beside the article. Inside an article they are
    those of whole class tokens, and of ids that name parts."""
    if "class" not in attributes and "id" not in attributes:
        return set()
    classes, ids = _token_words(attributes.get("class", "")), _token_words(attributes.get("id", ""))
    classes = [t for t in classes if t[0] not in _STATES]
    if not inside:
        tokens = [t for t in classes + ids if t[0] not in _STATES]
        return {w for t in tokens for w in t if w in _MARKS or w == "header"}
    whole = [t for t in classes if all(w in _MARKS or w in _FILL for w in t)]
    found = {w for t in whole for w in t if w in _MARKS}
    if not re.fullmatch("h[1-6]|p|li", name):
        found |= {t[0] for t in ids if len(t) == 1 and t[0] in _PARTS}
        found |= {w for t in classes + ids for w in (t[0], t[-1]) if w in _COMMENTS}
    named = [t for t in classes if t[1:2] != ["hoc"]]
    return found | {w for t in named for w in (t[0], t[-1]) if w in _ADVERTS} | _in_between(named)


def _in_between(classes: list[list[str]]) -> set[str]:
    """Adverts named in the middle, of tokens that otherwise only say what kind of box it is."""
    return {w for t in classes for w in t if w in _ADVERTS and all(x in _ADVERTS or x in _FILL or x in _PLACES for x in t)}


def read(page: str) -> Block:
    """The nested blocks of a page. Inline elements are markup only, unless they are marked as beside
    the article. Missing end tags are supplied, stray ones ignored."""
    root = Block("html", "html")
    stack, at, low = [root], 0, None
    # open blocks by name, and open articles, so that no tag needs a look through a deep stack
    names: dict[str, int] = {}
    articles = 0

    def add(text: str) -> None:
        if text:
            stack[-1].children.append(Text(text))

    def shut(n: int) -> None:
        nonlocal articles
        for block in stack[n:]:
            names[block.name] -= 1
            articles -= block.article
        if stack[n].shared:  # what follows is a new line
            stack[n].children.append(Block("hr", "hr"))
        del stack[n:]

    def any_open(of: set[str]) -> bool:
        return any(names.get(name) for name in of)

    while at < len(page):
        tag = _TOKEN.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at, raw = tag.end(), tag.group()
        found = _NAME.match(raw)
        if found is None:
            if raw.startswith("<![CDATA["):
                add(entities.escape(raw[9:].removesuffix("]]>")))
            continue
        name = found.group(1).lower()
        if raw[1] == "/":
            for n in range(len(stack) - 1, 0, -1) if names.get(name) else ():
                if stack[n].name == name:
                    shut(n)
                    break
            continue
        if name in _VOID:
            if name in ("br", "wbr", "hr", "img", "input"):
                add(" " if name != "wbr" else "")
            if name == "hr":
                stack[-1].children.append(Block("hr", "hr"))
            continue
        if name in _RAW and not raw.endswith("/>"):
            low = page.lower() if low is None else low
            end = low.find(f"</{name}", at)
            if end < 0 and name not in ("script", "style"):
                continue
            close = -1 if end < 0 else page.find(">", end)
            at = len(page) if close < 0 else close + 1
            continue
        attributes = _attributes(raw)
        marks = _marked(attributes)
        if name in ("html", "body"):
            continue
        inside = articles > 0
        side = _side_marks(name, attributes, inside)
        soft = inside and bool(side) and side <= _SOFT
        article = name in ("article", "main") or attributes.get("role", "").lower() in ("main", "article") or attributes.get("itemprop") == "articleBody"
        beside = (
            name in _LEFT_OUT
            or bool(side) and not soft
            or attributes.get("role", "").lower() in _ROLES
            or not inside and (name == "header" or _hidden(attributes))
        )
        if name not in _BLOCKS and not beside or raw.endswith("/>"):
            continue
        if name in _CLOSES_P:
            for n in range(len(stack) - 1, 0, -1) if names.get("p") else ():
                if stack[n].name == "p":
                    shut(n)
                    break
                if stack[n].name in _BLOCKS:
                    break
        elif name in _SELF_CLOSING and any_open(_SELF_CLOSING[name]):
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].name in _HOLDS[name]:
                    break
                if stack[n].name in _SELF_CLOSING[name]:
                    shut(n)
                    break
        kind = ".".join([name, *sorted(marks)])
        block = Block(name, kind, beside, article, soft)
        block.open_in(stack[-1])
        stack.append(block)
        names[name] = names.get(name, 0) + 1
        articles += article
    return root


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")) is not None
    )


# --- wrappers: {"k": kind, "o": optional, "r": repeated, "c": children}, texts {"k": "#", "t": digest},
# where digest is null for a slot


def _digest(text: str) -> str:
    return xxhash.xxh64_hexdigest(" ".join(entities.unescape(text).split()))


def wrapper_of(block: Block) -> dict:
    """The wrapper of one page: all texts are the template's so far."""
    children = []
    for child in block.children:
        if isinstance(child, Block):
            children.append(wrapper_of(child))
        elif child.value.strip():
            children.append({"k": "#", "t": _digest(child.value)})
    return {"k": block.kind, "c": _repeats(children)}


def _repeats(children: list[dict]) -> list[dict]:
    """Squares, that is a run of one to three kinds that follows itself, become one repeated run."""
    for period in (1, 2, 3):
        out: list[dict] = []
        for child in children:
            out.append(child)
            if len(out) >= 2 * period and all(
                out[-i]["k"] == out[-i - period]["k"] and (period > 1 or out[-i]["k"] != "#") for i in range(1, period + 1)
            ):
                tail = out[-period:]
                del out[-period:]
                for i in range(period):
                    out[i - period] = {**align(out[i - period], tail[i]), "r": 1}
        children = out
    return children


def align(a: dict, b: dict) -> dict:
    """The wrapper that fits what either of two wrappers of the same kind fits."""
    if a["k"] == "#":
        return {"k": "#", "t": a["t"] if a["t"] == b["t"] else None, **_flags(a, b)}
    return {"k": a["k"], "c": _align_lists(a["c"], b["c"]), **_flags(a, b)}


def _flags(a: dict, b: dict) -> dict:
    return {f: 1 for f in ("o", "r") if a.get(f) or b.get(f)}


def matches(left: list[str], right: list[str]) -> list[tuple[int | None, int | None]]:
    """Places of both lists in order, paired where the kinds agree: at a mismatch each side looks
    for the other's kind ahead, and the nearer find decides what was skipped."""
    pairs: list[tuple[int | None, int | None]] = []
    ahead: dict[str, list[int]] = {}
    for j in range(len(right) - 1, -1, -1):
        ahead.setdefault(right[j], []).append(j)
    behind: dict[str, list[int]] = {}
    for i in range(len(left) - 1, -1, -1):
        behind.setdefault(left[i], []).append(i)

    def following(places: dict[str, list[int]], kind: str, start: int) -> int | None:
        own = places.get(kind, [])
        while own and own[-1] < start:
            own.pop()
        return own[-1] if own else None

    i = j = 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
            continue
        there, here = following(ahead, left[i], j), following(behind, right[j], i)
        if there is None and here is None:
            pairs += [(i, None), (None, j)]
            i, j = i + 1, j + 1
        elif here is None or there is not None and there - j <= here - i:
            pairs += [(None, n) for n in range(j, there)]
            j = there
        else:
            pairs += [(n, None) for n in range(i, here)]
            i = here
    return pairs + [(n, None) for n in range(i, len(left))] + [(None, n) for n in range(j, len(right))]


def _align_lists(left: list[dict], right: list[dict]) -> list[dict]:
    out = []
    for i, j in matches([x["k"] for x in left], [x["k"] for x in right]):
        if i is None or j is None:
            out.append({**(right[j] if i is None else left[i]), "o": 1})
        else:
            out.append(align(left[i], right[j]))
    return _repeats(out)


def template_texts(block: Block, wrapper: dict) -> set[int]:
    """Identities of the page's texts that are the template's."""
    found: set[int] = set()
    children = [c for c in block.children if isinstance(c, Block) or c.value.strip()]
    kinds = [c.kind if isinstance(c, Block) else "#" for c in children]
    nodes = wrapper["c"]
    at = 0
    for child, kind in zip(children, kinds):
        here = next((n for n in range(at, len(nodes)) if nodes[n]["k"] == kind), None)
        if here is None:
            continue
        node = nodes[here]
        if isinstance(child, Block):
            found |= template_texts(child, node)
        elif node["t"] is not None and node["t"] == _digest(child.value):
            found.add(id(child))
        at = here if node.get("r") else here + 1
    return found


# --- text


def _main_articles(block: Block, found: list[Block], beside: bool = False) -> list[Block]:
    """The outermost articles, with those in blocks beside if ``beside``."""
    for child in block.children:
        if isinstance(child, Block) and (beside or not child.aside):
            if child.article:
                found.append(child)
            else:
                _main_articles(child, found, beside)
    return found


def _inner_article(block: Block, template: set[int]) -> list[Block]:
    """``main`` may hold more than the article: if it has articles, they are the text, with the headings
    and paragraphs right before the first of them, unless they are the template's."""
    inner = _main_articles(block, [])
    if block.name != "main" or not inner:
        return [block]
    lead = []
    for child in block.children:
        if isinstance(child, Block):
            if child.article or _main_articles(child, []):
                break
            if _LEAD.fullmatch(child.name) and not child.aside and not _constant(child, template):
                lead.append(child)
    return lead + [b for x in inner for b in _inner_article(x, template)]


def _length(block: Block, template: set[int], deep: bool) -> int:
    total = 0
    for child in block.children:
        if isinstance(child, Text):
            total += 0 if id(child) in template else len(child.value.strip())
        elif not child.aside and (deep or child.name in _PARAGRAPHS or not _has_blocks(child)):
            total += _length(child, template, deep)
    return total


def _has_blocks(block: Block) -> bool:
    return any(isinstance(c, Block) and c.name not in _PARAGRAPHS for c in block.children)


def _densest(root: Block, template: set[int]) -> Block:
    best, most = root, -1
    waiting = [root]
    while waiting:
        block = waiting.pop()
        own = _length(block, template, False)
        if own > most:
            best, most = block, own
        waiting += [c for c in reversed(block.children) if isinstance(c, Block) and not c.aside and c.name not in _PARAGRAPHS and _has_blocks_or_text(c)]
    return best


def _has_blocks_or_text(block: Block) -> bool:
    return bool(block.children)


def _constant(block: Block, template: set[int]) -> bool:
    """Whether all of a block's texts are the template's."""
    return all(
        _constant(c, template) if isinstance(c, Block) else id(c) in template or not c.value.strip() for c in block.children
    )


def _blocks(block: Block, template: set[int], out: list[list[str]]) -> None:
    out.append([])
    for child in block.children:
        if isinstance(child, Text):
            if id(child) not in template:
                out[-1].append(child.value)
        elif not child.aside:
            _blocks(child, template, out)
            out.append([])
        elif child.name in _BLOCKS - _IN_LINE:  # what is left out still parts the texts around it
            out.append([])


def _drop_soft(blocks: list[Block], template: set[int]) -> None:
    for block in blocks:
        block.aside = block.aside or block.soft and bool(template) and _constant(block, template)
        _drop_soft([c for c in block.children if isinstance(c, Block)], template)


def main_text(page: str, wrapper: dict | None = None) -> str:
    """The page's main text: blocks in page order, one per line."""
    root = read(page)
    template: set[int] = set()
    if wrapper is not None and not wrapper.get("one"):
        template = template_texts(root, wrapper)
        if not _length(root, template, True):
            template = set()  # a page that others repeat in full
    # a mark does not take away a page's only article: neither its own nor that of a box around it
    articles = _main_articles(root, []) or _main_articles(root, [], True)
    chosen = [b for x in articles for b in _inner_article(x, template)]
    if chosen:
        _drop_soft(chosen, template)
        chosen = [b for b in chosen if _length(b, template, True)] or chosen
        template = set()  # a marked article keeps the texts it shares with other pages
    else:
        chosen = [_densest(root, template)]
    found: list[list[str]] = []
    for block in chosen:
        _blocks(block, template, found)
    lines = [" ".join(entities.unescape("".join(parts)).split()) for parts in found]
    return "\n".join([line for line in lines if line])


def fold(known: dict | None, page: dict) -> dict:
    """A host's wrapper and one more; ``one`` marks a wrapper of which all pages were the same."""
    if known is None:
        return page
    if known == page:
        return known
    return {k: v for k, v in align(known, page).items() if k != "one"}


def _folded(batches: Iterator[pa.RecordBatch], load) -> Iterator[pa.RecordBatch]:
    """(host, wrapper) per host of the rows, in runs of at most ``HOSTS`` hosts."""
    known: dict[str, dict] = {}

    def out() -> pa.RecordBatch:
        texts = [json.dumps(w, separators=(",", ":")) for w in known.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(texts, pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for host, given in zip(batch.column(0).to_pylist(), batch.column(1)):
            if host not in known and len(known) >= HOSTS:
                yield out()
                known = {}
            known[host] = fold(known.get(host), load(given.as_py()))
    yield out()


def _folded_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _folded(batches, json.loads)


def _folded_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _folded(batches, _from_page)


def _from_page(page: str | None) -> dict:
    return {**wrapper_of(read(page or "")), "one": 1}


def wrappers(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(host, wrapper as JSON) per host."""
    given = pages.select(F.coalesce(F.col(f"`{host}`"), F.lit("")).alias("host"), F.col(f"`{html}`").alias("html"))
    parts = given.mapInArrow(_folded_pages, "host string, wrapper string")
    parts = parts.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(SHARES)))
    for keys in (["host", "share"], ["host"]):
        # sorted, so that a task folds one host after the other
        dealt = parts.repartition(*keys).sortWithinPartitions("host", "wrapper").select("host", "wrapper")
        parts = dealt.mapInArrow(_folded_wrappers, "host string, wrapper string").withColumn("share", F.lit(0))
    return parts.select("host", "wrapper")


def with_main_text(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns of ``pages`` (all by default) and the main text ``out`` of each page.

    A null or empty page has an empty text. Pages without a host share one wrapper. Repeated pages
    are read each; a column called like ``out`` is replaced.
    """
    kept = [c for c in (pages.columns if carry is None else carry) if c != out]
    host_name = own_name(pages, "_host")
    body = own_name(pages, "_html")
    hosted = pages.select(*[F.col(f"`{c}`") for c in kept], address(F.col(f"`{url}`"))[0].alias(host_name), F.col(f"`{html}`").alias(body))
    known = staged(wrappers(hosted, host_name, body), "wrappers").withColumnRenamed("host", f"{host_name}_w").withColumnRenamed("wrapper", f"{host_name}_j")
    joined = hosted.join(known, F.col(host_name) == F.col(f"{host_name}_w"), "left").select(*[F.col(f"`{c}`") for c in kept], body, f"{host_name}_j")
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()):
                if wrapper is not None and wrapper not in loaded:
                    if len(loaded) >= HOSTS:
                        loaded.clear()
                    loaded[wrapper] = json.loads(wrapper)
                texts.append(main_text(page or "", loaded.get(wrapper)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], names=[*kept, out])

    fields = [pages.schema[c] for c in kept]
    return joined.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))
