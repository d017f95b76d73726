"""Main text of web pages by the consensus of their host.

Every page scores its containers by the text of the blocks in them and names the best by
its path, of tags and classes without their numbers. The best is widened to the article
element around it, and to containers that add text of their own. The pages of a host vote
on the path; each page's text is then taken from the elements of its host's winning path,
or, if it has none, from its own best. The work on a page is linear in its length and depth.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import written

#: A comment, a declaration, or a tag; in a tag a quote opens a value only after an equals sign.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*+(?>"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+|[^>=])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
SPACES = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe template svg".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section table tbody td tfoot th thead tr ul summary".split())
CONTAINERS = frozenset("article body div html main section td".split())
#: Elements that are never part of an article, by tag, role, and words of class or id.
SKIPPED_TAGS = frozenset("nav footer aside button select option dialog menu head header".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
SKIPPED_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus dropdown footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar widget".split())
#: Of these words, those that name text of others: an element with one is kept only if the page's title is in it.
OTHERS = frozenset("ad ads advert advertisement adverts comment comments consent cookie cookies disqus gdpr promo promoted promotion recommended related replies reply sponsor sponsored".split())
#: A class or id with one of these tells what an element has or lacks, not what it is.
MODIFIERS = frozenset("has with no without".split())
#: Never skipped for the words of class or id.
NAMED = frozenset("html body main article".split())
#: An open element is closed by the start of one of these.
CLOSED_BY = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: A block's score of an outer container, a level out.
OUTER = 0.5
#: Whether an element is in one that is looked for, or can hold none.
IN, OFF = -1, -2


class Gate:
    """A form, or an element that is skipped for the words of its class or id, unless it turns out to hold the article."""

    __slots__ = ("outer", "others", "inside", "titled", "closed")

    def __init__(self, outer: Gate | None, others: bool):
        self.outer, self.others, self.inside, self.titled, self.closed = outer, others, 0, False, True


class Element:
    __slots__ = ("tag", "step", "parent", "skipped", "gate", "depth", "block", "container", "score", "direct", "whole", "titled")

    def __init__(self, tag: str, step: str, parent: Element | None, skipped: bool = False, gate: Gate | None = None):
        self.tag, self.step, self.parent, self.skipped, self.gate = tag, step, parent, skipped, gate
        self.depth = parent.depth + 1 if parent else 0
        self.block = self if parent is None or tag in BLOCKS else parent.block
        self.container = self if parent is None or tag in CONTAINERS else parent.container
        self.score, self.direct, self.whole, self.titled = 0.0, 0, 0, False

    def path(self) -> str:
        steps, element = [], self
        while element is not None:
            steps.append(element.step)
            element = element.parent
        return ">".join(reversed(steps))


Block = tuple[Element, str, int]


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        value = m[2] or ""
        quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'"
        out.setdefault(m[1].lower(), entities.unescape(value[1:-1] if quoted else value))
    return out


def _element(tag: str, attributes: str, parent: Element, gates: list[Gate]) -> Element:
    own = _attributes(attributes) if attributes.strip(" /\n\t") else {}
    classes = sorted({c for c in (re.sub(r"\d+", "", c).strip("-_").lower() for c in own.get("class", "").split()) if c})
    named: set[str] = set()
    if tag not in NAMED:
        for name in f"{own.get('class', '')} {own.get('id', '')}".split():
            words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
            named |= set() if words & MODIFIERS else words & SKIPPED_WORDS
    skipped = parent.skipped or tag not in ("body", "html") and (
        tag in SKIPPED_TAGS or own.get("role", "").lower() in SKIPPED_ROLES
        or "hidden" in own or own.get("aria-hidden") == "true")
    gate = parent.gate
    if not skipped and (named or tag == "form"):
        gate = Gate(gate, not OTHERS.isdisjoint(named))
        gates.append(gate)
    return Element(tag, ".".join([tag, *classes]), parent, skipped, gate)


def _kept(found: list[Block], gates: list[Gate]) -> list[Block]:
    """The blocks outside of closed gates.

    A gate opens if it holds most of the page's unlinked text and either the page's title is in it or its words don't
    name text of others. If nothing were left, all open.
    """
    total = 0
    for element, text, linked in found:
        total += len(text) - linked
        if element.gate is not None:
            element.gate.inside += len(text) - linked
            element.gate.titled |= element.tag == "h1"
    for gate in reversed(gates):
        if gate.outer is not None:
            gate.outer.inside += gate.inside
            gate.outer.titled |= gate.titled
    for gate in gates:
        gate.closed = not (gate.inside * 2 > total and (gate.titled or not gate.others)) or gate.outer is not None and gate.outer.closed
    return [b for b in found if b[0].gate is None or not b[0].gate.closed] or found


def blocks(page: str | None) -> list[Block]:
    """(element, text, characters within links) of each block of text, in order, without what is no article."""
    out: list[Block] = []
    if not page:
        return out
    root = owner = Element("html", "html", None)
    stack, opened, gates = [root], Counter(), []
    texts: list[str] = []
    linked, at, last = 0, 0, page.rfind(">")

    def close_block():
        nonlocal texts, linked
        text = SPACES.sub(" ", entities.unescape("".join(texts))).strip()
        if text and not owner.skipped:
            out.append((owner, text, min(linked, len(text))))
        texts, linked = [], 0

    def say(text: str):
        nonlocal owner, linked
        if not texts and not text.strip():
            return
        if not texts:
            owner = stack[-1].block
        if not owner.skipped and (stack[-1].skipped or stack[-1].gate is not owner.gate):
            return
        texts.append(text)
        linked += len(text) if opened["a"] else 0

    def pop():
        opened[stack.pop().tag] -= 1

    while at < len(page):
        m = TOKEN.search(page, at) if at <= last else None
        if m is None:
            say(page[at:].split("<!--", 1)[0])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCKS:
                close_block()
            if opened[tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            close_block()
            if any(opened[t] for t, closers in CLOSED_BY.items() if tag in closers):
                for i in range(len(stack) - 1, 0, -1):
                    if tag in CLOSED_BY.get(stack[i].tag, ()):
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i].tag in CONTAINERS or stack[i].tag in ("table", "ul", "ol", "dl"):
                        break
        if tag == "html":
            continue
        if tag not in VOID:
            stack.append(_element(tag, m[3], stack[-1], gates))
            opened[tag] += 1
    close_block()
    return _kept(out, gates)


def _outer(container: Element) -> Element | None:
    return container.parent.container if container.parent is not None else None


def best_container(found: list[Block]) -> Element | None:
    """The container with the highest score, the outer of equals, widened to what belongs with it.

    That is the article element around it, and then each container out whose own blocks hold more unlinked text than
    there is in all else that it adds; the body only if the page's title is among them.
    """
    best: dict[int, Element] = {}
    around: dict[int, Element] = {}
    for element, text, linked in found:
        worth = (len(text) - linked) * (1 - linked / len(text))
        container, share = element.container, 1.0
        container.direct += len(text) - linked
        container.whole += len(text)
        container.titled |= element.tag == "h1"
        while container is not None and id(container) not in around:
            around[id(container)] = container
            container = _outer(container)
        container = element.container
        for _ in range(3):
            if container is None:
                break
            container.score += worth * share
            best[id(container)] = container
            container, share = _outer(container), share * OUTER
    chosen = max(best.values(), key=lambda e: (e.score, -e.depth), default=None)
    if chosen is None:
        return None
    for container in sorted(around.values(), key=lambda e: -e.depth):
        if _outer(container) is not None:
            _outer(container).whole += container.whole
    wider = chosen
    while wider is not None and wider.tag != "article":
        wider = _outer(wider)
    score, chosen = chosen.score, wider or chosen
    while (wider := _outer(chosen)) is not None and wider.direct * 2 > wider.whole - chosen.whole:
        if not wider.direct or chosen.tag == "article" or wider.tag in ("body", "html") and not wider.titled:
            break
        chosen = wider
    chosen.score = max(score, chosen.score)
    return chosen


def _within(found: list[Block], is_one: Callable[[Element, int], int]) -> list[str]:
    """Texts of blocks in an element for which ``is_one``, told what it gave for the parent, gives IN."""
    known: dict[int, int] = {}
    texts = []
    for element, text, _ in found:
        chain = []
        while element is not None and id(element) not in known:
            chain.append(element)
            element = element.parent
        state = known[id(element)] if element is not None else 0
        for e in reversed(chain):
            state = state if state == IN else is_one(e, state)
            known[id(e)] = state
        if state == IN:
            texts.append(text)
    return texts


def page_text(found: list[Block], path: str | None) -> str:
    """The blocks within elements of the path, or else within the page's own best container."""
    steps = path.split(">") if path else []

    def on_path(element: Element, matched: int) -> int:
        if matched != element.depth or matched >= len(steps) or element.step != steps[matched]:
            return OFF
        return IN if matched + 1 == len(steps) else matched + 1

    own = _within(found, on_path)
    if not own:
        best = best_container(found)
        own = _within(found, lambda e, _: IN if e is best else 0)
    return "\n\n".join(own)


def _scored(found: list[Block]) -> tuple[str | None, float]:
    best = best_container(found)
    return (best.path(), min(best.score, 2000.0)) if best is not None and best.score > 0 else (None, 0.0)


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][\w+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path that most pages of a host vote for; ties by the score behind it, then by path."""
    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))

    def vote(batches):
        for batch in batches:
            found = [_scored(blocks(page)) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["host", "path", "score"])

    votes = rows.mapInArrow(vote, "host string, path string, score double").where("path is not null")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("n", F.round("score", 3), "path")).alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) for every row.

    A null or empty page, and one without article text, has the empty text. Of containers with equal scores the outer and
    then the earlier counts, of paths with equal votes and scores the last by name. Very long, deep or broken
    pages take time and memory in proportion to their length. A null url, or one without a
    host, votes with the others that have none. Repeated rows vote and get a row each. Hosts' paths meet
    the pages in a join on the host, one row a host, which adaptive skew handling may split.
    """
    winners = written(host_paths(pages, url_col, html_col), "host-paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("host"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def take(batches):
        for batch in batches:
            texts = [page_text(blocks(page), path) for page, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    met = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return met.mapInArrow(take, f"page_id {kind}, url string, text string")
