"""Main text of web pages by consensus host paths (operator 13).

Each page's containers are scored by their own text, without link text and what menus, adverts and the like hold.
The best one votes for its generalised path, the tags and classes from the root with digits made alike, and so
does, for less, one beside it that comes near; votes add up per host in Spark. Pages are then read again: the text of a page is
that of its elements under the first of its host's winning paths that it has, or of its own best container if it
has none of them, without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments.

A host's votes are added before the shuffle, so a large host does not fill a task, and its ``PATHS`` winning paths
are of bounded size; they are broadcast while all together are at most ``BROADCAST_CHARS``, beyond that joined
with the hosts of many pages spread. Pages are parsed in one pass that only moves forward.

Null or empty html gives an empty text. A null url, or one without a host, has no host: such pages are judged each
by itself. Null ids stay; repeated rows vote and are returned each; ties go to the path that sorts first; an empty
table gives no rows. Other columns of the pages are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.common import decoded, in_arrow, only, slices
from siftlake.operators.attach import attach
from siftlake.session import checkpointed

#: Winning paths of a host at most; pages with none of them fall back on their own best container.
PATHS = 8
#: A container beside the best one votes if it has this share, in hundredths, of the best score.
NEAR = 50
#: Characters of all hosts' paths that are sent to every executor.
BROADCAST_CHARS = 16_000_000
#: Characters of a path; a longer one is replaced by its hash.
PATH_CHARS = 400

# Fixed values of the markup language: which elements are empty, hold text only, break lines, or end others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("title meta link style script base noscript template head html".split())
#: A start tag ends the last open one of these, unless an element of the second set was opened since.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th caption", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "tbody": ("tr td th tbody thead tfoot caption", "table"), "tfoot": ("tr td th tbody thead tfoot caption", "table"),
    "thead": ("tr td th tbody thead tfoot caption", "table"), "option": ("option", "select optgroup"), "optgroup": ("option optgroup", "select"),
}
ENDS = {tag: (ended.split(), within.split()) for tag, (ended, within) in ENDS.items()}
#: An end tag does not reach an element opened before the last of these.
SCOPE = frozenset("table td th caption button template object".split())

# What is no main text: elements, words in class or id, and roles.
DROPPED = frozenset("aside audio button canvas datalist dialog embed footer form head iframe input label map menu nav noembed noframes noscript object script select style svg template "
                    "textarea title video".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar topbar footer footers colophon copyright sidebar sidebars rail widget widgets "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay disclaimer announcement newsletter subscribe subscription signup login register search "
    "share sharing social related recommended recommendations trending masthead skip".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies responses discussion".split())
HEADERS = frozenset("header headers masthead".split())
CONTENT = frozenset("article post entry content story body text main page".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

MARKUP = re.compile(r"<(?=[A-Za-z/!?])")
PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*+)\s*+>")
NAME = re.compile(r"[^\s/>]++")
ATTRIBUTE = re.compile(r"[\s/]*+(=?[^\s=/>]*+)(\s*+=\s*+)?")
UNQUOTED = re.compile(r"[^\s>]*+")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
KEPT_ATTRIBUTES = frozenset("class id role hidden style aria-hidden".split())


def step_of(tag: str, classes: str) -> str:
    """A tag with its classes, digits made alike."""
    if not classes:
        return tag
    names = sorted({re.sub(r"\d+", "#", c)[:32] for c in classes.split()})[:4]
    return ".".join([tag, *names])


class Page:
    """The elements of a page in order, and its texts, each with its element; a text of None is a line break.

    Every element comes after its parent, so that sums go up in one backward pass.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.path, self.own, self.first, self.last = [""], [-1], [""], [{}], [0], [0]
        self.texts: list[tuple[int, str | None]] = []
        self.open, self.places, self.blocks, self.scopes = [0], {}, [], [0]
        self._read(source)
        self._close(1)
        self.last[0] = len(self.texts)
        self._weigh()

    # Reading

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            found = MARKUP.search(source, at)
            start = found.start() if found else size
            if start != at:
                self._text(source[at:start])
            at = self._markup(source, start) if found else size

    def _text(self, text: str) -> None:
        if self.places.get("head") and not text.isspace():
            self._close(self.places["head"][-1])
        self.texts.append((self.open[-1], decoded(text)))

    def _markup(self, source: str, at: int) -> int:
        """Takes what begins at a ``<`` and returns the place after it; what does not end goes on to the end."""
        if plain := PLAIN_TAG.match(source, at):
            self._end(plain[2].lower()) if plain[1] else self._start(plain[2].lower(), {})
            return self._raw(source, plain.end(), plain[2].lower()) if not plain[1] else plain.end()
        if source.startswith("<!--", at):
            if source.startswith((">", "->"), at + 4):
                return source.index(">", at) + 1
            found = COMMENT_END.search(source, at + 4)
            return found.end() if found else len(source)
        closing = source.startswith("/", at + 1)
        name_at = at + 1 + closing
        letter = source[name_at:name_at + 1]
        if not (letter.isascii() and letter.isalpha()):
            if letter:  # a declaration or a broken end tag
                end = source.find(">", name_at)
                return end + 1 if end >= 0 else len(source)
            self._text(source[at:name_at])
            return name_at
        name = NAME.match(source, name_at)
        attributes, at = self._attributes(source, name.end())
        if at < 0:
            return len(source)
        tag = name[0].lower()
        if closing:
            self._end(tag)
            return at
        self._start(tag, attributes)
        return self._raw(source, at, tag)

    def _attributes(self, source: str, at: int) -> tuple[dict[str, str], int]:
        """Attributes that matter, and the place after the tag; -1 if it does not end."""
        found: dict[str, str] = {}
        while True:
            part = ATTRIBUTE.match(source, at)
            name, at = part[1].lower(), part.end()
            value = ""
            if part[2]:
                quote = source[at:at + 1]
                if quote in ("'", '"'):
                    end = source.find(quote, at + 1)
                    if end < 0:
                        return found, -1
                    value, at = source[at + 1:end], end + 1
                else:
                    rest = UNQUOTED.match(source, at)
                    value, at = rest[0], rest.end()
            if name in KEPT_ATTRIBUTES:
                found.setdefault(name, decoded(value))
            if at >= len(source):
                return found, -1
            if source[at] == ">":
                return found, at + 1

    def _raw(self, source: str, at: int, tag: str) -> int:
        if tag not in RAW:
            return at
        found = RAW_END[tag].search(source, at)
        end = found.start() if found else len(source)
        self.texts.append((self.open[-1], source[at:end]))  # its element is dropped with it
        return end

    def _close(self, depth: int) -> None:
        """End all open elements from a depth on."""
        while len(self.open) > depth:
            node = self.open.pop()
            tag = self.tag[node]
            place = self.places[tag].pop()
            if self.scopes[-1] == place:
                self.scopes.pop()
            if tag in BLOCK:
                self.blocks.pop()
                self.texts.append((node, None))
            self.last[node] = len(self.texts)

    def _deepest(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _start(self, tag: str, own: dict[str, str]) -> None:
        if self.places.get("head") and tag not in HEAD_ONLY:
            self._close(self.places["head"][-1])
        if tag in ("html", "body") and self.places.get(tag):
            return
        block = tag in BLOCK
        if block and (p := self.places.get("p")) and p[-1] > self.scopes[-1]:
            self._close(p[-1])
        if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
            self._close(len(self.open) - 1)
        if tag in ENDS:
            ended, within = ENDS[tag]
            limit = self._deepest(within)
            if places := [self.places[t][-1] for t in ended if self.places.get(t) and self.places[t][-1] > limit]:
                self._close(min(places))
        if tag in VOID:
            if tag == "br":
                self.texts.append((self.open[-1], " "))
            elif block:
                self.texts.append((self.open[-1], None))
            return
        parent, node = self.open[-1], len(self.tag)
        path = self.path[parent] + ">" + step_of(tag, own.get("class", "")) if block and tag not in ("html", "body") else self.path[parent]
        if len(path) > PATH_CHARS:
            path = "#" + blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest()
        if block:
            self.texts.append((node, None))
            self.blocks.append(len(self.open))
        for values, value in ((self.tag, tag), (self.parent, parent), (self.path, path), (self.own, own), (self.first, len(self.texts)), (self.last, 0)):
            values.append(value)
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in SCOPE:
            self.scopes.append(len(self.open))
        self.open.append(node)

    def _end(self, tag: str) -> None:
        if not self.places.get(tag):
            return
        place = self.places[tag][-1]
        if tag in BLOCK:
            if place >= self.scopes[-1] or tag in ("table", "body", "html"):
                self._close(place)
        elif not self.blocks or place > self.blocks[-1]:  # an inline end tag leaves open blocks alone
            self._close(place)

    # Judging

    def _weigh(self) -> None:
        count = len(self.tag)
        sizes, self.heading = [0] * count, [t == "h1" for t in self.tag]
        lengths = [len(t.strip()) if t else 0 for _, t in self.texts]
        for (node, _), n in zip(self.texts, lengths, strict=True):
            sizes[node] += n if self.tag[node] not in RAW else 0
        for node in range(count - 1, 0, -1):
            up = self.parent[node]
            sizes[up] += sizes[node]
            self.heading[up] |= self.heading[node]
        self.state, self.link = [0] * count, [False] * count
        semantic = [False] * count
        for node in range(1, count):
            up = self.parent[node]
            semantic[node] = semantic[up] or self.tag[node] in ("article", "main")
            self.link[node] = self.link[up] or self.tag[node] == "a"
            state = self.state[up]
            if state == 2 and self.tag[node] in HEADINGS:
                state = 0  # the title in an article's header
            self.state[node] = state if state == 1 else max(state, self._dropped(node, 2 * sizes[node] > sizes[0], semantic[up]))
        self.clean, self.links, self.cut = [0] * count, [0] * count, [0] * count
        for (node, _), n in zip(self.texts, lengths, strict=True):
            (self.cut if self.state[node] else self.links if self.link[node] else self.clean)[node] += n if self.tag[node] not in RAW else 0
        for node in range(count - 1, 0, -1):
            for sums in (self.clean, self.links, self.cut):
                sums[self.parent[node]] += sums[node]

    def _dropped(self, node: int, most: bool, inside: bool) -> int:
        """0: main text, 1: not, 2: only its headings. ``most``: it holds most of the page's text."""
        tag, own = self.tag[node], self.own[node]
        if tag in ("html", "body"):
            return 0
        holds_page = most and (self.heading[node] or tag in ("article", "main"))
        if tag in DROPPED:
            return 0 if tag == "form" and holds_page else 1
        if not own and tag != "header":
            return 0
        words = {w.lower() for w in WORD.findall(own.get("class", "") + " " + own.get("id", ""))}
        if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or HIDDEN.search(own.get("style", "")):
            return 1
        if words & COMMENTS and not (holds_page and tag in ("article", "main")):
            return 1
        if holds_page:
            return 0
        if own.get("role", "").lower() in ROLES or words & (WORDS - HEADERS) and tag not in HEADINGS:
            return 1
        if tag == "header" or words & HEADERS and tag not in HEADINGS:
            return 2 if inside or words & CONTENT else 1
        return 0

    def score(self, node: int) -> int:
        tag, own = self.tag[node], self.own[node]
        words = {w.lower() for w in WORD.findall(own.get("class", "") + " " + own.get("id", ""))} if own else set()
        weight = 160 if tag == "article" else 130 if tag == "main" or own.get("role") == "main" else 90 if tag in ("body", "html", "") else 125 if words & CONTENT else 100
        return (self.clean[node] - self.links[node] - self.cut[node] // 10) * weight // 100

    def scores(self) -> list[tuple[int, int]]:
        """(score, element) of the containers that have a score, the root among them."""
        found = [(self.score(i), i) for i, t in enumerate(self.tag) if not self.state[i] and (t in CONTAINERS or i == 0)]
        return [x for x in found if x[0] > 0]

    def best(self, scored: list[tuple[int, int]]) -> int:
        """The best container, or one inside it that has nearly all of its score and no heading less."""
        at = max(scored, key=lambda x: (x[0], x[1]))[1]
        for score, node in sorted(scored, key=lambda x: x[1]):
            if node > at and self.first[node] < self.last[at] and self.tag[at] not in ("article", "main") and \
                    10 * score >= 8 * self.score(at) and self.heading[node] == self.heading[at]:
                at = node
        return at

    def votes(self) -> dict[str, int]:
        """Per path that gets a vote, its container's share of the best score in thousandths."""
        scored = self.scores()
        if not scored:
            return {}
        best = self.best(scored)
        top, found = self.score(best), {}
        for score, node in scored:
            apart = self.first[node] >= self.last[best] or self.last[node] <= self.first[best]
            if apart and 100 * score >= NEAR * top:
                found[self.path[node]] = max(found.get(self.path[node], 0), min(999, 1000 * score // top))
        return {**found, self.path[best]: 1000}

    def text_of(self, nodes: list[int]) -> str:
        """The blocks of elements in page order."""
        blocks, held, upto = [], [], 0
        for at in nodes:
            for node, text in self.texts[max(upto, self.first[at]):self.last[at]]:
                if text is None:
                    blocks.append("".join(held))
                    held = []
                elif not self.state[node] and self.tag[node] not in RAW:
                    held.append(text)
            blocks.append("".join(held))
            held, upto = [], max(upto, self.last[at])
        return "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)

    def main_text(self, paths: list[str]) -> str:
        """The text under the first of the paths that the page has, else of its own best container."""
        here = {}
        for node, path in enumerate(self.path):
            if (self.tag[node] in CONTAINERS or node == 0) and not self.state[node]:
                here.setdefault(path, []).append(node)
        for path in paths:
            if path in here and (text := self.text_of(here[path])):
                return text
        scored = self.scores()
        return self.text_of([self.best(scored)] if scored else [0])


CONTAINERS = BLOCK - HEADINGS - frozenset("p li dt dd hr head title option optgroup tr thead tbody tfoot caption legend summary".split())


def host_of(url: Column) -> Column:
    """A-Z lower-cased, null without one."""
    host = F.regexp_extract(url, r"^.*?://([^/?#]*)", 1)
    return F.nullif(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _pages(pages: DataFrame) -> DataFrame:
    return only(pages, page_id="long", url="string", html="string").withColumn("host", host_of(F.col("url")))


def host_paths(pages: DataFrame, paths: int = PATHS) -> DataFrame:
    """Per host its pages and its winning paths, most votes first."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                hosts, found, votes = [], [], []
                for host, source in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    own = Page(source or "").votes() or {"": 0}
                    hosts += [host] * len(own)
                    found += own
                    votes += own.values()
                yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "path": pa.array(found, pa.string()), "votes": pa.array(votes, pa.int64())})

    each = in_arrow(_pages(pages).filter("host IS NOT NULL").select("host", "html"), task, "host string, path string, votes long")
    counts = each.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.count_if(F.col("votes") % 1000 == 0).alias("pages"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))).filter(F.col("rank") <= paths)
    lists = ranked.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path", "votes"))).alias("x"), F.sum("pages").alias("pages"))
    return lists.select("host", "pages", F.transform(F.filter("x", lambda x: x["votes"] > 0), lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows, facts = _pages(pages), checkpointed(host_paths(pages))
    size = facts.agg(F.sum(F.length("host") + F.aggregate("paths", F.lit(0), lambda a, x: a + F.length(x) + 8))).first()[0] or 0
    if size <= BROADCAST_CHARS:
        rows = rows.join(F.broadcast(facts.select("host", "paths")), "host", "left")
    else:
        rows = attach(rows.withColumn("seq", F.xxhash64("page_id", "url", "html")), facts, "host", "pages")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [Page(source or "").main_text(paths or []) for source, paths in zip(part.column("html").to_pylist(), part.column("paths").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return in_arrow(rows.select("page_id", "url", "html", "paths"), task, "page_id long, url string, text string, n_chars long")
