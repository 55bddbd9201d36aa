"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser turns a page into lines: runs of text
between block elements, with the number of tags met on the way, the containers
they lie in and the elements around them that look like page furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments).  The ratio of
text to tags, smoothed over neighbouring lines with a Gaussian, splits the lines
into two clusters by the threshold that separates them best.  The mass of dense
lines then selects:

* the region: article and main elements if they hold the dense text of the page,
  else the way down from the page to where its blocks part; sparse blocks at
  either end, far below the threshold on average, and lists of links are left out;
* what is furniture: an element that looks like it stays if it holds an article
  or most of the dense text, as a form or an unclosed menu around a page does.

Inside the region every line is returned that isn't furniture, short ones too: a
ratio alone would drop one-word paragraphs.  A compound name such as
user-comments is only a hint; form controls, dates or repeated blocks of one
kind inside the element confirm it.

Edge cases: null, empty and text-free pages give an empty text; unclosed and
stray tags are tolerated; a comment or tag that never ends hides the rest, as in
browsers; plain text without tags is one line; repeated pages give equal
results; page_id and url are carried as they are, nulls included; an empty table
gives an empty result.  The work grows in proportion to a page's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nextbest.llm.common import column, slices

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title "
    "tr ul".split())
HIDDEN = frozenset(
    "head script style noscript template button select textarea iframe object svg canvas audio video "
    "datalist".split())
#: Elements inside a formula that say it again; they hide their text without ending the line.
MUTED = frozenset("annotation annotation-xml".split())
#: Elements that are furniture unless they hold the article.
STRUCTURE = frozenset("nav footer aside form menu dialog search".split())
CONTROLS = frozenset("form button input textarea select".split())
#: Elements that a page's regions are made of.
REGIONS = frozenset("article body div main section td".split())
#: Starting one of these ends an open <p>; the others end an open one of their kind.
ENDS_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"},
               "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

#: Class and id names that mark page furniture.
FURNITURE = frozenset(
    "menu menubar nav navbar navigation breadcrumb breadcrumbs footer sidebar ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion cookie cookies consent popup modal "
    "overlay comment comments disqus newsletter subscribe signup login pagination pager toolbar "
    "masthead copyright".split())
#: Names that articles use as well: what they hold decides.
DOUBTFUL = frozenset(
    "banner notice notification alert reply replies respond discussion share sharing social related "
    "recommended search widget widgets skip".split())
#: Words that a furniture name may be made up with; any other makes it a different name.
BESIDE = frozenset(
    "box list bar area block section link links button buttons form site page top bottom left right "
    "main global primary secondary slot unit placeholder".split())
ADS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored".split())
#: Words that make any compound name a hint.
HINTS = frozenset("comment comments commentlist respond replies gdpr cookie cookies consent popup "
                  "newsletter subscribe".split())
#: Parts of names that say who wrote something, or when.
SIGNED = frozenset("author byline date time timestamp posted published user username".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog "
                  "dialog menu menubar toolbar".split())
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def furniture_words(value: str | None) -> set[str]:
    """The furniture words of the names in a class or id that consist of nothing else.

    sideBar, side-bar and primary_sidebar give sidebar; has-sidebar, related-work
    and content-sidebar-wrap give nothing.
    """
    out: set[str] = set()
    for token in (value or "").split():
        parts = _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", token).lower())
        words, at = [], 0
        while at < len(parts):
            both = "".join(parts[at:at + 2])
            pair = at + 1 < len(parts) and (both in FURNITURE or both in DOUBTFUL)
            words.append(both if pair else parts[at])
            at += 1 + pair
        marks = {w for w in words if w in FURNITURE or w in DOUBTFUL or w == "header"}
        if all(w in marks or w in BESIDE for w in words):
            out |= marks
    return out


def name_parts(value: str | None) -> set[str]:
    """The words that names in a class or id are made of."""
    return set(_NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", value or "").lower()))


class _Element:
    __slots__ = ("tag", "skip", "region", "name", "link", "article")

    def __init__(self, tag: str, skip: bool, region: int, name: int, link: bool, article: int) -> None:
        self.tag, self.skip, self.region, self.name, self.link = tag, skip, region, name, link
        self.article = article  # the outermost article or main region around, -1: none


class _Named:
    """An element that looks like page furniture: by its tag or role (part), by its name for
    sure or in doubt, or by a hint."""

    __slots__ = ("parent", "kind", "article", "region", "holds_article", "holds_main", "controls",
                 "signed", "blocks")

    def __init__(self, parent: int, kind: str, article: int, region: int) -> None:
        self.parent, self.kind, self.article, self.region = parent, kind, article, region
        self.holds_article = self.holds_main = False
        self.controls = self.signed = 0
        self.blocks: dict[tuple, int] = {}


class _Line:
    __slots__ = ("text", "tags", "skip", "region", "name", "links")

    def __init__(self, text: str, tags: int, skip: bool, region: int, name: int, links: int) -> None:
        self.text, self.tags, self.skip = text, tags, skip
        self.region, self.name, self.links = region, name, links


class PageLines(HTMLParser):
    """Collects lines, the tree of regions and the elements that look like furniture."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.counts: dict[str, int] = {}          # open elements by tag
        self.frames: list[dict[str, int]] = [{}]  # those in each open region, itself included
        self.lines: list[_Line] = []
        self.parents, self.kinds = [-1], ["page"]  # of regions; 0 is the page
        self.named: list[_Named] = []
        self.free: list[int] = []  # outermost article and main regions in no named element
        self._text: list[str] = []
        self._tags = self._links = self._muted = 0

    def _here(self) -> tuple[bool, int, int, bool, int]:
        e = self.open[-1] if self.open else None
        return (e.skip, e.region, e.name, e.link, e.article) if e else (False, 0, -1, False, -1)

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            skip, region, name, _, _ = self._here()
            self.lines.append(_Line(text, self._tags, skip, region, name, self._links))
            self._tags = 0
        self._text.clear()
        self._links = 0

    def _hidden(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return True
        if tag not in ("a", "article"):
            return False
        names = furniture_words(attrs.get("class")) | furniture_words(attrs.get("id"))
        if tag == "article":
            return bool(names & {"comment", "comments", "reply"})
        return "skip" in names and (attrs.get("href") or "").startswith("#")

    def _named_as(self, tag: str, attrs: dict[str, str | None], inside: bool) -> str | None:
        if tag in ("html", "body", "main"):
            return None
        if tag in STRUCTURE or (tag == "header" and not inside) or (
                (attrs.get("role") or "").lower() in ROLES):
            return "part"
        if tag == "article" or tag in HEADINGS:
            return None
        names = furniture_words(attrs.get("class")) | furniture_words(attrs.get("id"))
        if tag not in BLOCKS:  # words of a sentence
            return "sure" if names & ADS else None
        if names & FURNITURE or ("header" in names and not inside):
            return "sure"
        if names & DOUBTFUL:
            return "doubt"
        parts = name_parts(attrs.get("class")) | name_parts(attrs.get("id"))
        return "hint" if parts & HINTS else None

    def _push(self, e: _Element) -> None:
        self.open.append(e)
        self.counts[e.tag] = self.counts.get(e.tag, 0) + 1
        self._muted += e.tag in MUTED
        if e.tag in REGIONS:
            self.frames.append({e.tag: 1})
        else:
            self.frames[-1][e.tag] = self.frames[-1].get(e.tag, 0) + 1

    def _drop(self, at: int) -> None:
        while len(self.open) > at:
            tag = self.open.pop().tag
            self.counts[tag] -= 1
            self._muted -= tag in MUTED
            if tag in REGIONS:
                self.frames.pop()
            else:
                self.frames[-1][tag] -= 1

    def _close(self, at: int) -> None:
        self._flush()
        self._drop(at)

    def _evidence(self, tag: str, attrs: dict[str, str | None], name: int) -> None:
        n = self.named[name]
        n.controls += tag in CONTROLS
        given = attrs.get("class")
        if tag == "time" or (given and name_parts(given) & SIGNED):
            n.signed += 1
        if given and tag in BLOCKS:
            n.blocks[tag, given] = n.blocks.get((tag, given), 0) + 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._tags += 1
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag in ("br", "wbr"):
                self._text.append(" " if tag == "br" else "")
            elif tag == "input" and self.open and self.open[-1].name >= 0:
                self.named[self.open[-1].name].controls += 1
            return
        if tag in BLOCKS:
            frame = self.frames[-1]
            if frame.get("p") or (tag in ENDS_ITSELF and frame.get(tag)):
                for at in range(len(self.open) - 1, -1, -1):
                    name = self.open[at].tag
                    if name == "p" or (tag in ENDS_ITSELF and name == tag):
                        self._close(at)
                        break
                    if name in REGIONS or name in ENDS_ITSELF.get(tag, ()):
                        break
            self._flush()
        skip, region, name, link, article = self._here()
        if not skip and (attrs or tag in HIDDEN or tag in STRUCTURE or tag == "header"):
            given = dict(attrs)
            if name >= 0:
                self._evidence(tag, given, name)
            skip = self._hidden(tag, given)
            kind = None if skip else self._named_as(tag, given, article >= 0)
            if skip or kind is not None:
                self._flush()
            if kind is not None:
                self.named.append(_Named(name, kind, article, region))
                name = len(self.named) - 1
                if tag in CONTROLS:
                    self.named[name].controls += 1
            link = link or (tag == "a" and "href" in given)
        if tag in REGIONS and not skip:
            self.parents.append(region)
            self.kinds.append(tag)
            region = len(self.kinds) - 1
            if tag in ("article", "main"):
                at, main = name, tag == "main"
                while at >= 0:
                    n = self.named[at]
                    if n.holds_article and (n.holds_main or not main):
                        break  # and so do those around it
                    n.holds_article, n.holds_main = True, n.holds_main or main
                    at = n.parent
                if name < 0 and article < 0:
                    self.free.append(region)
                article = region if article < 0 else article
        self._push(_Element(tag, skip, region, name, link, article))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self._tags += 1

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        # a stray end tag closes nothing, nor does an inline one around its region
        if not (self.counts if tag in BLOCKS else self.frames[-1]).get(tag):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag == tag:
                before = self.open[at - 1] if at else None
                outside = (before.skip, before.name) if before else (False, -1)
                if any(e.tag in BLOCKS or (e.skip, e.name) != outside for e in self.open[at:]):
                    self._close(at)
                else:
                    self._drop(at)
                return

    def handle_data(self, data: str) -> None:
        if self._muted:
            return
        self._text.append(data)
        if self.open and self.open[-1].link:
            self._links += len(_SPACE.sub(" ", data).strip())

    def close(self) -> None:
        super().close()
        self._flush()


def smooth(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the ends repeat."""
    r = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, r, mode="edge"), weights / weights.sum(), mode="valid")


def threshold(ratios: np.ndarray) -> float:
    """Where the variance between the lines below and above is largest (all alike: -1)."""
    order = np.sort(ratios)
    n = len(order)
    if n < 2 or order[0] == order[-1]:
        return -1.0
    low = np.cumsum(order)[:-1]
    k = np.arange(1, n)
    between = k * (n - k) * (low / k - (order.sum() - low) / (n - k)) ** 2
    between[order[1:] == order[:-1]] = -1
    at = int(between.argmax())
    return float(order[at] + order[at + 1]) / 2


def dense(ratios: np.ndarray) -> np.ndarray:
    """The upper of the two clusters."""
    return ratios > threshold(ratios)


def _up(mass: np.ndarray, parents: list[int]) -> np.ndarray:
    """Every node's own mass and that of its children, which come after their parents."""
    for i in range(len(mass) - 1, -1, -1):
        if parents[i] >= 0:
            mass[parents[i]] += mass[i]
    return mass


def _skip_named(page: PageLines, picked: np.ndarray, free: list[int], parted: bool) -> None:
    """Marks the lines of the named elements that are furniture indeed.

    None is that holds an article or main (other than one beside which there is
    a free one), or more than half of the dense text, not links, of the article
    it lies in, or of a page without a free one (if the lines part into clusters
    at all, for a tag or role).  A doubtful name counts if most
    of its text is links, if it has form controls, or outside articles if none of
    its text is dense; a hint if there are controls, two signs of an author or a
    date, or two blocks of one kind.
    """
    k = len(page.named)
    chars, links, rich = np.zeros(k), np.zeros(k), np.zeros(k)
    by_region = np.zeros(len(page.kinds))
    for line, yes in zip(page.lines, picked):
        if line.skip:
            continue
        if yes:
            by_region[line.region] += len(line.text)
        if line.name >= 0:
            chars[line.name] += len(line.text)
            links[line.name] += line.links
            rich[line.name] += len(line.text) if yes else 0
    parents = [n.parent for n in page.named]
    controls = np.array([n.controls for n in page.named], dtype=float)
    signed = np.array([n.signed for n in page.named], dtype=float)
    chars, links, rich, controls, signed = (
        _up(x, parents) for x in (chars, links, rich, controls, signed))
    dense_text = _up(by_region, page.parents)
    off = np.zeros(k, dtype=bool)
    for i, n in enumerate(page.named):
        if n.parent >= 0 and off[n.parent]:
            off[i] = True
            continue
        if n.holds_main or (n.holds_article and not free):
            continue
        scope = n.article if n.article >= 0 else 0
        listed = 2 * links[i] > chars[i]
        if (n.article >= 0 or not free) and 2 * rich[i] > dense_text[scope] and not listed and (
                parted or n.kind != "part"):
            continue
        if n.kind == "hint":
            off[i] = bool(controls[i]) or signed[i] > 1 or max(n.blocks.values(), default=0) > 1
        else:
            off[i] = (n.kind in ("part", "sure") or listed or bool(controls[i])
                      or (n.article < 0 and not rich[i]))
    for line in page.lines:
        if line.name >= 0 and off[line.name]:
            line.skip = True


def _link_runs(lines: list[_Line], own: list[int]) -> set[int]:
    """Of a region's own lines, those in runs of at least two neighbours that are links."""
    out: set[int] = set()
    run: list[int] = []
    for i in [*own, -1]:
        if i >= 0 and (not run or i == run[-1] + 1) and 2 * lines[i].links > len(lines[i].text):
            run.append(i)
            continue
        if len(run) > 1:
            out.update(run)
        run = [i] if i >= 0 and 2 * lines[i].links > len(lines[i].text) else []
    return out


#: A block at an end of the region is sparse below this share of the threshold on average.
SPARSE = 0.25


def _region(page: PageLines, smoothed: np.ndarray, cut: float, share: float) -> list[bool]:
    """Which lines lie in the main region, by the mass of dense lines that aren't links.

    The outermost article and main elements are it, all together, if they hold
    ``share`` of that mass.  Else the way goes down from the page as long as all
    text lies in one child, or beside it only in lists of links and in sparse
    blocks before the first or behind the last dense child; where it ends
    everything else is kept.  A list of links is mostly links and has no other
    dense line.
    """
    lines, k = page.lines, len(page.kinds)
    picked = smoothed > cut
    chars, links, rich = np.zeros(k), np.zeros(k), np.zeros(k)
    ratio, count = np.zeros(k), np.zeros(k)
    first, last = np.full(k, len(lines)), np.full(k, -1)
    own: list[list[int]] = [[] for _ in range(k)]
    for i, x in enumerate(lines):
        if not x.skip:
            r = x.region
            own[r].append(i)
            chars[r] += len(x.text)
            links[r] += min(x.links, len(x.text))
            if picked[i] and 2 * x.links <= len(x.text):
                rich[r] += len(x.text)
            ratio[r], count[r] = ratio[r] + smoothed[i], count[r] + 1
            first[r], last[r] = min(first[r], i), i
    chars, links, rich, ratio, count = (
        _up(x, page.parents) for x in (chars, links, rich, ratio, count))
    children: list[list[int]] = [[] for _ in range(k)]
    for r in range(k - 1, 0, -1):
        p = page.parents[r]
        children[p].append(r)
        first[p], last[p] = min(first[p], first[r]), max(last[p], last[r])
    plain = chars - links

    def below(roots: list[int]) -> np.ndarray:
        inside = np.zeros(k, dtype=bool)
        inside[roots] = True
        for r in range(1, k):
            inside[r] |= inside[page.parents[r]]
        return inside

    top = [r for r in range(1, k) if page.kinds[r] in ("article", "main")]
    outer = below(top)
    top = [r for r in top if not outer[page.parents[r]]]
    mass = rich if rich[0] else plain
    if chars[top].sum() > 0 and mass[top].sum() >= share * mass[0]:
        inside = below(top)
        return [bool(inside[x.region]) for x in lines]
    at = 0
    while True:
        dropped = _link_runs(lines, own[at])
        real = [i for i in own[at] if i not in dropped]
        kids = [r for r in children[at] if chars[r] > 0 and (2 * links[r] <= chars[r] or rich[r])]
        full = [r for r in kids if rich[r]]
        if full:
            begin, end = min(first[r] for r in full), max(last[r] for r in full)
            kids = [r for r in kids if rich[r] or begin < first[r] < end
                    or ratio[r] >= SPARSE * cut * count[r]]
        if real or len(kids) != 1:
            break
        at = kids[0]
    said = sum(len(lines[i].text) for i in real)
    inside = below([at])
    if not (real or kids) or 2 * said >= plain[at]:  # nothing but links; an article's own text
        return [bool(inside[x.region]) for x in lines]
    inside = below(kids)
    wanted = set(real)
    return [bool(inside[x.region]) or i in wanted for i, x in enumerate(lines)]


_UNENDED = re.compile(r"<(?:!--|(script|style|textarea|title)\b)", re.IGNORECASE)
_TAG = re.compile(r"<[A-Za-z/!?]")


def ended(html: str) -> str:
    """The page up to a comment or tag that never ends; one pass."""
    tail = _TAG.search(html, html.rfind(">") + 1)
    if tail:
        html = html[:tail.start()]
    at = 0
    while True:
        found = _UNENDED.search(html, at)
        if not found:
            return html
        if found[1] is None:
            end = html.find("-->", found.start() + 2)  # <!--> is a whole one
            if end < 0:
                return html[:found.start()]
            at = end + 3
        else:
            close = re.compile(f"</{found[1]}", re.IGNORECASE).search(html, found.end())
            if not close:
                return html
            at = close.end()


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.8) -> str:
    """The lines of the main region that aren't furniture, joined by newlines."""
    if not html:
        return ""
    page = PageLines()
    page.feed(ended(html))
    page.close()
    lines = page.lines
    if not lines:
        return ""
    smoothed = smooth(np.array([len(x.text) / max(1, x.tags) for x in lines]), sigma)
    cut = threshold(smoothed)
    spoken = {x.region for x in lines if not x.skip}
    for r in range(len(page.kinds) - 1, 0, -1):
        if r in spoken:
            spoken.add(page.parents[r])
    _skip_named(page, smoothed > cut, [r for r in page.free if r in spoken],
                cut >= 0)
    kept = _region(page, smoothed, cut, share)
    return "\n".join(x.text for x, yes in zip(lines, kept) if yes and not x.skip)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")
            ) -> DataFrame:
    """``keep`` columns, text, n_chars."""
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            texts = [main_text(h) for h in column(batch, html)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])

    return pages.select(*dict.fromkeys([*keep, html])).mapInArrow(run, schema)
