"""Main text of web pages by consensus host paths.

Every page scores its containers by the text of their blocks, less what is linked, and passes part of it on to the
container outside. Pages vote on the generalised tag-class paths of their best containers; Spark sums the votes per
host, and every page is read again at the winning path of its host, widened to the article around it. A page that lacks
this path, or has only a part of its text there, keeps to its own best container. Menus, headers and footers of the page,
sidebars, notices, adverts, forms and reader comments are left out by tag, role, class or id wherever they stand, but
nothing that holds the page's articles or most of its text, reader comments excepted. Pages are read by one forward scan,
with parent indexes in place of paths, so the time grows with the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import written

#: Part of a container's score that the container outside gets.
PASSED_ON = 0.85
#: Containers of a page that get votes.
VOTES = 3
#: Winning paths are broadcast up to this many hosts (about 50 MB), else joined by a shuffle.
BROADCAST_HOSTS = 200_000

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul noscript".split()
)
#: Elements whose content is no markup: they run to their closing tag or the end of the page.
RAW = "script|style|title|textarea|iframe"
#: Left out inside a block; the closing tag of an element around ends them too.
DROPPED = frozenset("template select button object svg math foreignobject canvas audio video".split())
FOREIGN = frozenset("svg math".split())

CONTAINERS = frozenset("article body div main section td blockquote center html details".split())
LEFT_OUT = frozenset("nav aside footer form head dialog menu search fieldset noscript".split())
#: Text in these is never judged by a class or id.
NEVER_BY_NAME = frozenset("html body article main h1 h2 h3 h4 h5 h6 p li td th tr dd dt pre blockquote figcaption caption summary".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"),
}
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form alertdialog".split())
# Words of a class or id token: those that name what is left out as the whole token or before a word for a part of the page,
# those that do so as the last word too, and tokens that do so only as a whole.
NOISE_WORD = re.compile(
    r"nav|navbar|navigation|menu|breadcrumbs?|footer|masthead|topbar|sidebar|widgets?|ads?|advert\w*|adsense|banner|sponsor\w*|promos?|promoted|cookies?"
    r"|consent|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|comments?|disqus|related|recommend\w*|share|sharing|social"
    r"|pagination|pager|toolbar"
)
NOISE_LAST = re.compile(
    r"nav|navbar|navigation|menu|breadcrumbs?|footer|masthead|topbar|sidebar|ads?|advert\w*|adsense|banner|popup|modal|newsletter|comments|disqus|pagination|pager|toolbar"
)
PART_OF_PAGE = frozenset(
    "post posts article articles story stories news link links list lists item items button buttons icon icons bar box block area areas container wrapper wrap "
    "inner outer section sections form panel notice notices banner popup modal overlay widget widgets menu header footer top bottom left right mobile desktop "
    "primary secondary main content media text message dialog policy thread reply nav toggle slot unit space placeholder".split()
)
NOISE_ALONE = re.compile(
    r"(?:site|page|main|global|top)-?header|header|side-bar|aside|notices?|alert|discussion|replies|responses|sign-up|(?:site-?)?search(?:-?(?:form|box|bar))?"
    r"|form|skip-link|copyright"
)
HEADER_NAME = re.compile(r"(?:\w+-)*?\w*header")
SAYS_WHETHER = frozenset("no not non without with has have is hide show enable disable format".split())
TALK = re.compile(r"(?:^|[-_ ])(?:comments?|disqus|discussion|replies|responses)(?:$|[-_ ])")
#: Notices that stay left out however long they are.
NOTICE = re.compile(r"(?:^|[-_ ])(?:cookies?|consent|gdpr|newsletter)(?:$|[-_ ])")
#: What would be left out and has more than this share of the page's unlinked text is the text.
MOST = 0.5

CUT = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
OPENING = re.compile(r"<(/?)([a-zA-Z][\w:-]*)|<[!?/][^>]*>")
#: The rest of a tag, quotes regarded, and so many tags may take more than SCAN characters to find out that quotes don't close.
REST = re.compile(r"""(?:[^"'<>]+|"[^"]*"|'[^']*')*+""")
SCAN, LONG_SCANS = 4096, 64
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
DIGITS = re.compile(r"\d+")


@dataclass
class Page:
    """Containers in page order and blocks of text with the container each stands in."""

    #: Of each container: the number of its path, the container around it and its tag.
    path_of: list[int] = field(default_factory=list)
    outer: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    #: For each container, how many elements right inside it (no container between) are left out.
    gaps: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    #: Paths as (number of the path around, last step) to their numbers, and back.
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)
    steps: list[tuple[int, str]] = field(default_factory=list)

    def add(self, container: int, tag: str, step: str) -> int:
        """A container inside another one (or -1); returns its place."""
        key = (self.path_of[container] if container >= 0 else -1, step)
        if key not in self.numbers:
            self.numbers[key] = len(self.steps)
            self.steps.append(key)
        self.path_of.append(self.numbers[key])
        self.outer.append(container)
        self.tags.append(tag)
        self.gaps.append(0)
        return len(self.outer) - 1

    def path(self, number: int) -> str:
        parts = []
        while number >= 0:
            number, step = self.steps[number]
            parts.append(step)
        return "".join(f"/{p}" for p in reversed(parts))

    def number(self, path: str | None) -> int | None:
        """The number of a path, None if the page lacks it."""
        at: int | None = None if path is None else -1
        for step in path.split("/")[1:] if path else ():
            at = self.numbers.get((at, step)) if at is not None else None
        return at if at is not None and at >= 0 else None


def noise_name(value: str, inside: bool) -> bool:
    """Whether a whole token of a class or id names what is left out; ``inside`` an article or main, headers are kept."""
    for token in value.replace("_", "-").split():
        parts = [p for p in token.split("-") if p]
        if not parts or parts[0] in SAYS_WHETHER or (inside and HEADER_NAME.fullmatch(token)):
            continue
        if NOISE_ALONE.fullmatch(token) or NOISE_LAST.fullmatch(parts[-1]):
            return True
        if NOISE_WORD.fullmatch(parts[0].rstrip("0123456789")) and all(p in PART_OF_PAGE or p[0].isdigit() or NOISE_WORD.fullmatch(p) for p in parts[1:]):
            return True
    return False


@dataclass
class _LeftOut:
    """Elements that would be left out: their places, the one around each, whether they can be kept, and what they hold."""

    places: list[int] = field(default_factory=list)
    outer: list[int] = field(default_factory=list)
    strict: list[bool] = field(default_factory=list)
    talk: list[bool] = field(default_factory=list)
    #: Unlinked characters and articles right inside; the last cell is for those in none.
    chars: list[int] = field(default_factory=lambda: [0])
    articles: list[int] = field(default_factory=lambda: [0])

    def add(self, place: int, outer: int, strict: bool, talk: bool) -> int:
        self.places.append(place)
        self.outer.append(outer)
        self.strict.append(strict)
        self.talk.append(talk or (outer >= 0 and self.talk[outer]))
        self.chars.insert(-1, 0)
        self.articles.insert(-1, 0)
        return len(self.places) - 1

    def kept(self) -> frozenset[int]:
        """Places of those that hold all articles of the page, or most of the text of one without; reader comments don't count."""
        chars, articles = ([0 if self.talk[i] else v for i, v in enumerate(x[:-1])] for x in (self.chars, self.articles))
        all_chars, all_articles = sum(chars) + self.chars[-1], sum(articles) + self.articles[-1]
        for i in range(len(self.places) - 1, -1, -1):
            if self.outer[i] >= 0:
                chars[self.outer[i]] += chars[i]
                articles[self.outer[i]] += articles[i]
        return frozenset(
            place for place, talk, strict, n, held in zip(self.places, self.talk, self.strict, chars, articles, strict=True)
            if not talk and held == all_articles and (held or (not strict and n > MOST * all_chars))
        )


def read_page(source: str) -> Page:
    """Blocks that are not left out, white space collapsed, with the number of their characters inside links."""
    source = _without_raw(source)
    page, left_out = _read(source, frozenset())
    kept = left_out.kept()
    return _read(source, kept)[0] if kept else page


def _without_raw(source: str) -> str:
    """The page without comments and raw elements; one that isn't closed runs to the end of the page."""
    end = source.rfind(">") + 1  # no tag begins behind it
    closed = True

    def cut(m: re.Match) -> str:
        nonlocal closed
        closed = m.end() < end or m[0].endswith("-->") or bool(m[1] and re.search(rf"</{m[1]}\s*>\Z", m[0][-64 - len(m[1]) :], re.I))
        return " "

    head = CUT.sub(cut, source[:end])
    return head + source[end:].split("<!--", 1)[0] if closed else head


def _tags(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" or "", name, rest) of every tag in one forward scan; comments and the like have no name."""
    at, last, long_scans = 0, source.rfind(">"), 0
    while m := OPENING.search(source, at, last + 1):
        if not m[2]:
            at = m.end()
            yield m.start(), at, "", "", ""
            continue
        end = -1
        if long_scans < LONG_SCANS:
            end = REST.match(source, m.end()).end()
            if source[end : end + 1] != ">":
                # a quote that doesn't close, or a tag inside a tag: the tag ends at the next bracket
                long_scans += end - m.end() > SCAN or source[end : end + 1] in ("", '"', "'")
                end = -1
        if end < 0:
            end = source.find(">", m.end())
        at = end + 1
        yield m.start(), at, m[1], m[2].lower(), source[m.end() : end]


def _read(source: str, kept: frozenset[int]) -> tuple[Page, _LeftOut]:
    """The page without what is left out, but for the ``kept`` places, and what that holds."""
    page, lost = Page(), _LeftOut()
    # an open element: tag, innermost container, left out, innermost element that would be left out, in an article, in a foreign object
    stack: list[tuple[str, int, bool, int, bool, bool]] = [("", -1, False, -1, False, False)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked, in_link, at = 0, False, 0

    def push(*element) -> None:
        stack.append(element)
        opened[element[0]] += 1

    def pop(down_to: int) -> None:
        while len(stack) > down_to:
            opened[stack.pop()[0]] -= 1

    def end_block() -> None:
        nonlocal linked
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                page.blocks.append((stack[-1][1], words, linked))
            text.clear()
        linked = 0

    def take(piece: str) -> None:
        nonlocal linked
        size = len(piece) if not piece.isspace() else 0
        if not in_link and stack[-1][0] not in DROPPED:
            lost.chars[stack[-1][3]] += size
        if not stack[-1][2]:
            text.append(piece)
            if in_link:
                linked += len(piece.strip())

    for start, end, closing, tag, rest in _tags(source):
        if start > at:
            take(source[at:start])
        at = end
        if not tag:
            continue
        if tag in DROPPED:
            if not closing and not (tag in FOREIGN and rest.rstrip().endswith("/")):
                text.append(" ")
                top = stack[-1]
                push(tag, top[1], True, top[3], top[4], top[5] or tag == "foreignobject")
            elif closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        pop(i)
                        break
                    if stack[i][0] not in DROPPED or not opened[tag]:
                        break
            continue
        if tag == "a" and stack[-1][0] in DROPPED:
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCKS:
            if tag == "hr":
                end_block()
            continue
        if closing:
            if opened[tag]:
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                if not stack[i][2]:
                    end_block()
                pop(i)
            elif not stack[-1][2]:
                end_block()
            in_link = in_link and stack[-1][2]
            continue
        if not stack[-1][5] and any(opened[f] for f in FOREIGN):
            i = 0
            while stack[i][0] not in FOREIGN:
                i += 1
            pop(i)  # HTML inside them ends them
        if not stack[-1][2]:
            end_block()
            in_link = False
        if stack[-1][0] in CLOSED_BY_BLOCK:
            pop(len(stack) - 1)
        same = CLOSED_BY_SAME.get(tag, ())
        while stack[-1][0] in same:
            pop(len(stack) - 1)
        if tag == "body" or (stack[-1][0] == "head" and tag not in ("head", "html")):
            while opened["head"]:
                pop(len(stack) - 1)
        _, container, out, around, inside, foreign = stack[-1]
        names, noisy, strict, talk = "", False, False, False
        if rest and not rest.isspace():
            for name, *values in ATTRIBUTE.findall(rest):
                value = "".join(values).lower()
                if name.lower() == "role":
                    noisy = noisy or value in NOISE_ROLES
                else:
                    if tag not in NEVER_BY_NAME and noise_name(value, inside):
                        noisy, strict, talk = True, strict or bool(NOTICE.search(value)), talk or bool(TALK.search(value))
                    if name.lower() == "class":
                        names = ".".join(sorted(set(DIGITS.sub("#", value).replace("/", "|").split())))
        noisy = noisy or tag in LEFT_OUT or (tag == "header" and not inside)
        if tag in ("article", "main"):
            lost.articles[around] += 1
            inside = True
        if noisy:
            around = lost.add(start, around, strict, talk)
            out = out or start not in kept
        if tag in CONTAINERS and not out:
            container = page.add(container, tag, f"{tag}{'.' if names else ''}{names}")
        elif out and not stack[-1][2] and container >= 0:
            page.gaps[container] += 1
        push(tag, container, out, around, inside, foreign)
    take(source[at:])
    end_block()
    return page, lost


def container_scores(page: Page) -> list[float]:
    own = [0.0] * len(page.outer)
    for container, words, linked in page.blocks:
        if container >= 0:
            own[container] += max(0, len(words) - 2 * linked)
    for i in range(len(own) - 1, -1, -1):
        if page.outer[i] >= 0:
            own[page.outer[i]] += PASSED_ON * own[i]
    return own


def best_paths(page: Page) -> list[tuple[str, float]]:
    """Up to VOTES paths, best first, with the page's votes for them: one, a half, a quarter."""
    by_path: dict[int, float] = {}
    for path, score in zip(page.path_of, container_scores(page), strict=True):
        if score > 0:
            by_path[path] = max(by_path.get(path, 0.0), score)
    if not by_path:
        return []
    # only paths that may be among the best are written out
    least = sorted(by_path.values(), reverse=True)[: VOTES][-1]
    best = sorted((-score, page.path(path)) for path, score in by_path.items() if score >= least)[:VOTES]
    return [(p, 0.5**i) for i, (_, p) in enumerate(best)]


def _below(page: Page, top: set[int]) -> list[bool]:
    """For each container, whether it is one of ``top`` or below one."""
    inside: list[bool] = []
    for i, outer in enumerate(page.outer):
        inside.append(i in top or (outer >= 0 and inside[outer]))
    return inside


def _around(page: Page, i: int) -> Iterator[int]:
    while i >= 0:
        yield i
        i = page.outer[i]


def widened(page: Page, top: set[int]) -> set[int]:
    """Every container of ``top`` widened to the outermost article around it, or main without an article, or else as far as
    the blocks that this adds aren't linked and nothing beside them is left out, but never to the body."""
    sums: list[list[int]] | None = None
    out = set()
    for i in top:
        for tag in ("article", "main"):
            found = [c for c in _around(page, i) if page.tags[c] == tag]
            if found:
                out.add(found[-1])
                break
        else:
            if sums is None:
                # of each container with all below: blocks that are mostly links, elements left out
                sums = [[0, n] for n in page.gaps]
                for c, words, linked in page.blocks:
                    if c >= 0 and 2 * linked > len(words):
                        sums[c][0] += 1
                for c in range(len(sums) - 1, -1, -1):
                    if page.outer[c] >= 0:
                        sums[page.outer[c]][0] += sums[c][0]
                        sums[page.outer[c]][1] += sums[c][1]
            while (o := page.outer[i]) >= 0 and page.tags[o] not in ("body", "html") and sums[o] == sums[i]:
                i = o
            out.add(i)
    return out


def main_text(page: Page, path: str | None) -> str:
    """Blocks in or below the widened containers of ``path``; all blocks of a page without containers.

    The page's own best path takes its place where the page lacks it, where it has no text here, or where it is only a part,
    less than half, of what the page's own one around it holds.
    """
    texts = lambda inside: [words for container, words, _ in page.blocks if container >= 0 and inside[container]]
    def of(path: str) -> set[int]:
        number = page.number(path)
        return {i for i, x in enumerate(page.path_of) if x == number}

    own = next((p for p, _ in best_paths(page)), None)
    kept: list[str] = []
    top: set[int] = set()
    if page.number(path) is not None:
        top = of(path)
        kept = texts(_below(page, widened(page, top)))
    if own is not None and own != path:
        inside, more = _below(page, of(own)), texts(_below(page, widened(page, of(own))))
        if not kept or (all(inside[i] for i in top) and 2 * sum(map(len, kept)) < sum(map(len, more))):
            kept = more
    if own is None and not top:
        return "\n".join(b[1] for b in page.blocks)
    return "\n".join(kept)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _sources(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    for low in range(0, batch.num_rows, 64):
        for value in batch.column(column).slice(low, 64):
            yield value.as_py() or ""


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of every host, ties to the path that sorts first."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, source in zip(batch.column(0).to_pylist(), _sources(batch, 1), strict=True):
                rows += [(host, path, part) for path, part in best_paths(read_page(source))]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.float64())], names=["host", "path", "votes"]
            )

    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(vote, "host string, path string, votes double")
    # rounded, so that the order of adding doesn't decide
    totals = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    return totals.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path")).alias("best")).select("host", "best.path")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page: null or empty html gives an empty text; null urls are one host.

    Blocks are joined by one line feed in page order. Repeated rows are read each; other columns are ignored.
    """
    paths = written(host_paths(pages), "host_paths").withColumnRenamed("host", "_host")
    if paths.count() <= BROADCAST_HOSTS:
        paths = F.broadcast(paths)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(read_page(s), p) for s, p in zip(_sources(batch, 3), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_at")).join(paths, F.col("_at") == F.col("_host"), "left")
    return rows.select(F.col("page_id").cast("long").alias("page_id"), "url", "path", "html").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )
