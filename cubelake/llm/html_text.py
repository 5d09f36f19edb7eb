"""Main text of web pages by differencing with the nearest page of the same host.

A page is read into lines (its blocks of text), each with the path of the
elements it stands in. Pages of a host are sorted by URL path, and each is
paired with the neighbour that shares the longer beginning of its path. The
two pages' lines are aligned by longest common subsequence and shared lines
are deleted.

What two pages of a template share is often not the words (menus, adverts and
footers vary from page to page) but the place; and what they share in words is
often true text (copies, quoted passages). So lines outside the page's article
are aligned by the path of their elements, lines of a page that marks no
article by their words, and the running text of an article is never deleted
for being shared. What stands in boxes of an article (elements with a class, id
or role, lines that are links, articles after the first) is aligned by place
and words: where all that a page has at a place is shared, the place is the
template's and its lines are deleted, whatever its name. Running text is
aligned by its words, to know a copy, of which nothing is deleted. Elements
that are never main text by their tag or role (see the fixed values; a role is
a whole word of a class, id or role) are dropped while reading, and what is
left outside an article goes too. An article is read for itself, whatever it
stands in.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate
from math import isqrt

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelake.llm.common import following, numbered, ordered, ship

# Element and role names.
_RAW = "script style noscript template iframe svg textarea title"
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
_NEVER = set("nav footer aside form button select option dialog menu head object applet canvas audio video".split())
_ROLES = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice notices popup "
    "modal menu nav navbar navigation breadcrumb breadcrumbs sidebar footer comment comments disqus share sharing "
    "social related newsletter subscribe subscription widget pagination login search masthead alert contentinfo "
    "complementary dialog form toolbar skip".split()
)
_CONTAINERS = {"article", "main"}
_WHOLE = {"html", "body", "article", "main"}  # whatever their roles, they hold the page or its text
_IMPLIED = {"p", "li", "tr", "td", "th", "dt", "dd"}
_ENDS_P = set(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup main menu nav ol p pre section summary table ul".split()
)

#: Parts of class names, between hyphens, underscores and capitals, that name a role at either end of the class, and
#: first parts that say the opposite or speak of another element.
_PARTS = set(
    "ads advert adverts advertisement sponsor sponsored promo cookie cookies consent popup nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer comment comments disqus newsletter masthead".split()
)
_NOT_ITSELF = set("has have with without no not is after before under above below beside main".split())
_SLOTS = set("ad slot slots unit units box block banner container wrapper area frame zone label".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_TEXT = _HEADINGS | set("p li td th dt dd blockquote pre".split())
_QUOTES = {"blockquote", "pre", "table"}  # running text, whatever stands in them
#: Characters of a line of running text from which on it tells whether an article is a copy.
_LONG = 20

_START = re.compile(rf"(?P<raw>(?:{'|'.join(_RAW.split())})\b)|(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)|[!?/]", re.I)
_END_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in _RAW.split()}
_STOP = re.compile("[>\"']")
#: Times that a quote may stay open to the end of a page before its quotes are ignored.
_OPEN_QUOTES = 8
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: A line: text, whether it stands in an article, whether in an element that is never main text, a hash of its path, the
#: place of the box it stands in (0: running text of the article, or outside) and whether it is a heading.
Line = tuple[str, bool, bool, int, int, bool]


def tags_of(source: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """The tags of a page: (start, end, whether it closes, name, attributes).

    Comments, declarations and raw elements (with what they hold) come as one
    tag without a name; the latter with " " for attributes, as a word ends
    there. One pass over the page, whatever is broken in it: a tag ends at the
    first ``>`` outside quotes or, if some quote is never closed, at the first
    ``>`` at all; what is open at the end of the page is text.
    """
    at, open_quotes = 0, 0
    while (start := source.find("<", at)) >= 0:
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = len(source) if end < 0 else end + 3
            yield start, at, False, None, ""
            continue
        found = _START.match(source, start + 1)
        if not found:
            at = start + 1
            continue
        first = source.find(">", found.end())
        if first < 0:
            return  # nor does any other tag end
        if found["raw"]:
            after = _END_OF[found["raw"].lower()].search(source, first + 1)
            at = after.end() if after else len(source)
            yield start, at, False, None, " "
        elif found["name"] is None:
            at = first + 1
            yield start, at, False, None, ""
        else:
            end = None if open_quotes > _OPEN_QUOTES else _quoted_end(source, found.end())
            if end is None:
                open_quotes += 1
                end = first
            at = end + 1
            yield start, at, bool(found["close"]), found["name"].lower(), source[found.end() : end]


def _quoted_end(source: str, at: int) -> int | None:
    """Place of the first ``>`` outside quotes; None if there is none."""
    while stop := _STOP.search(source, at):
        if stop[0] == ">":
            return stop.start()
        at = source.find(stop[0], stop.end()) + 1
        if not at:
            return None
    return None


def _names_role(token: str) -> bool:
    """Whether a class name of several parts names a role of its element: ``site-footer``, ``adSlot``."""
    parts = [p.lower() for p in _PART.findall(token)]
    if len(parts) < 2 or parts[0] in _NOT_ITSELF:
        return False
    return parts[0] in _PARTS or parts[-1] in _PARTS or (parts[0] == "ad" and parts[1] in _SLOTS)


def lines_of(page: str | None) -> tuple[list[Line], bool]:
    """The page's lines in order (scripts, styles and comments are none), and whether it marks an article.

    An article starts afresh: what it stands in drops none of its lines, as
    that may be the frame of the page or an element whose end tag is missing.
    Only if elements that do close hold some articles deeper than others
    (comments and teasers are articles too), the deeper ones go. The place of
    the first article that is left is running text, others are boxes.
    """
    source = page or ""
    lines: list[Line] = []
    # open elements: name, whether never main text, path, first line, box (None: running text, as are boxes in it)
    stack: list[tuple[str, bool, int, int, int | None]] = []
    blocks: list[int] = []  # which of them are no inline elements
    links: list[int] = []  # and which are links
    opened: dict[str, int] = {}  # how many of them have a name
    never = inside = 0
    outside: list[int] = []  # ``never`` where the open article stands
    around: list[tuple[int, int]] = []  # lines between the tags of elements that are never main text
    marked = False
    articles = [0]  # the places of the open ones
    standing: list[int] = []  # for each line, the last of them
    pending: list[str] = []
    unlinked = False  # whether some of it stands in no link

    def end_line() -> None:
        nonlocal unlinked
        if pending:
            text = " ".join(entities.unescape("".join(pending)).split())
            pending.clear()
            if text:
                path = box = 0
                heading = False
                if stack:
                    path = stack[-1][2]
                    if inside:
                        heading = stack[blocks[-1]][0] in _HEADINGS
                        box = stack[-1][4]
                        if box is not None and not unlinked and not heading:
                            box = xxhash.xxh64_intdigest("/a", seed=stack[blocks[-1]][2])
                lines.append((text, inside > 0, never > 0, path, box or 0, heading))
                standing.append(articles[-1])
        unlinked = False

    def linked() -> bool:
        """Whether a link of the open block is open; one around blocks may lack its end tag."""
        return bool(links) and links[-1] > blocks[-1]

    def pop() -> None:
        nonlocal never, inside
        name, drop, *_ = stack.pop()
        opened[name] -= 1
        if name not in _INLINE:
            blocks.pop()
        elif name == "a":
            links.pop()
        never -= drop
        if name in _CONTAINERS:
            if name == "article":
                articles.pop()
            inside -= 1
            if not inside:
                never = outside.pop()

    at = 0
    for start, end, closes, name, attrs in tags_of(source):
        if start > at:
            pending.append(source[at:start])
            if inside and not unlinked and not linked():
                unlinked = not pending[-1].isspace()
        at = end
        if name is None:
            pending.append(attrs)
            continue
        if name not in _INLINE:
            end_line()
        if closes:
            if opened.get(name):
                while stack[-1][0] != name:
                    pop()
                _, drop, _, first, _ = stack[-1]
                pop()
                if drop and not inside:
                    around.append((first, len(lines)))
            continue
        if name in _VOID or attrs.endswith("/"):
            continue
        if blocks:
            # The end tag may be missing: another of its kind, or a block after a p, ends it, unless a block stands between.
            open_block = stack[blocks[-1]][0]
            if name in _ENDS_P if open_block == "p" else open_block == name and name in _IMPLIED:
                down = blocks[-1]
                while len(stack) > down:
                    pop()
        if name in _CONTAINERS:
            marked = True
            if not inside:
                outside.append(never)
                never = 0
            inside += 1
        path, box = (stack[-1][2], stack[-1][4]) if stack else (0, 0)
        drop = name in _NEVER or (name == "header" and not inside)
        step = plain = "" if name in _INLINE else f"/{name}"
        if attrs and name not in _WHOLE:
            for kind, value in _ATTR.findall(attrs):
                tokens = value.strip("\"'").split()
                value = value.lower()
                step = f"{step}.{'.'.join(_WORD.findall(value))}"
                drop = drop or not _ROLES.isdisjoint(value.strip("\"'").split())
                # ids inside an article are mostly made from headings
                if not drop and name not in _TEXT and (kind.lower() == "class" or not inside):
                    drop = any(map(_names_role, tokens))
        if step:
            path = xxhash.xxh64_intdigest(step, seed=path)
        if name in _QUOTES:
            box = None
        elif name == "article":
            box = path
            articles.append(path)
        elif inside and box is not None and step != plain and plain and name not in _TEXT:
            box = path
        opened[name] = opened.get(name, 0) + 1
        if name not in _INLINE:
            blocks.append(len(stack))
        elif name == "a":
            links.append(len(stack))
        stack.append((name, drop, path, len(lines), box))
        never += drop
    if at < len(source):
        pending.append(source[at:])
        unlinked = unlinked or not inside or not linked()
    end_line()
    if marked and around:
        change = [0] * (len(lines) + 1)
        for first, end in around:
            change[first] += 1
            change[end] -= 1
        depth = list(accumulate(change))
        least = min((d for d, x in zip(depth, lines, strict=False) if x[1] and not x[2]), default=0)
        lines = [(t, i, n or (i and d > least), *rest) for d, (t, i, n, *rest) in zip(depth, lines, strict=False)]
    first = next((place for place, x in zip(standing, lines, strict=True) if place and not x[2]), 0)
    if first:
        lines = [(*x[:4], 0, x[5]) if x[4] == first else x for x in lines]
    return lines, marked


def keys_of(lines: list[Line], marked: bool) -> list[int | None]:
    """What each line is aligned by: its path, its words, its box and words, or (None) nothing."""
    keys: list[int | None] = []
    for text, inside, never, path, box, heading in lines:
        if never or (marked and not inside):
            keys.append(path >> 1)
        elif marked:
            tells = box or (len(text) >= _LONG and not heading)
            keys.append(xxhash.xxh64_intdigest(text, seed=box) >> 1 if tells else None)
        else:
            keys.append(xxhash.xxh64_intdigest(text, seed=1) >> 1)
    return keys


def template_of(lines: list[Line], shared: set[int]) -> set[int]:
    """The lines of articles that are the template's, of those shared with another page.

    A place is the template's if every line there is shared. If the page has
    less text of its own (headings aside) than it shares, it is a copy and no
    place is.
    """
    both = [k for k in shared if lines[k][1] and not lines[k][2]]
    places = {lines[k][4] for k in both} - {0}
    if not places:
        return places
    own = [x for k, x in enumerate(lines) if x[1] and not x[2] and k not in shared]
    if sum(len(lines[k][0]) for k in both) > sum(len(x[0]) for x in own if not x[5] and (x[4] or len(x[0]) >= _LONG)):
        return set()
    places -= {x[4] for x in own}
    return {k for k in both if lines[k][4] in places}


def aligned(own: list[int | None], other: list[int]) -> set[int]:
    """Places of ``own`` in a longest common subsequence of both.

    Lines that both begin and end with are shared as they are. What is left is
    followed match by match if matches are few, and otherwise bit-parallel: a
    row is one big integer. For the way back a row is kept
    for every block of lines only, and those of a block are made again, so
    memory grows with lines times the square root of lines (in bits).
    """
    there = set(other)
    mine = [k for k, key in enumerate(own) if key is not None and key in there]
    here = {own[k] for k in mine}
    theirs = [key for key in other if key in here]
    head = 0
    while head < min(len(mine), len(theirs)) and own[mine[head]] == theirs[head]:
        head += 1
    tail = 0
    while tail < min(len(mine), len(theirs)) - head and own[mine[-1 - tail]] == theirs[-1 - tail]:
        tail += 1
    ends = {*mine[:head], *mine[len(mine) - tail :]}
    mine, theirs = mine[head : len(mine) - tail], theirs[head : len(theirs) - tail]
    places: dict[int, list[int]] = {}
    for j, key in enumerate(theirs):
        places.setdefault(key, []).append(j)
    matches = sum(len(places.get(own[k], ())) for k in mine)
    if matches <= 8 * (len(mine) + len(theirs)):
        return ends | _by_matches([(k, places.get(own[k], [])) for k in mine])
    common = {key: sum(1 << j for j in js) for key, js in places.items() if len(js) > 64}  # few can be so common
    full = (1 << len(theirs)) - 1

    def next_row(v: int, k: int) -> int:
        key = own[k]
        u = v & (common[key] if key in common else sum(1 << j for j in places.get(key, ())))
        return ((v + u) | (v - u)) & full

    block = max(1, isqrt(len(mine)))
    kept, v = [], full  # the row before each block
    for i, k in enumerate(mine):
        if i % block == 0:
            kept.append(v)
        v = next_row(v, k)
    found, j = set(), len(theirs)
    for b in reversed(range(len(kept))):
        rows = [kept[b]]
        for k in mine[b * block : (b + 1) * block]:
            rows.append(next_row(rows[-1], k))
        i = len(rows) - 1
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif rows[i - 1] >> (j - 1) & 1:
                i -= 1
                found.add(mine[b * block + i])
                j -= 1
            else:
                i -= 1
    return found | ends


def _by_matches(lines: list[tuple[int, list[int]]]) -> set[int]:
    """The lines of a longest common subsequence, given each line's places in the other page."""
    last: list[int] = []  # of the subsequences of each length, the least last place
    chains: list[tuple] = []  # and that subsequence: (line, the one before)
    for line, places in lines:
        for j in reversed(places):
            n = bisect_left(last, j)
            chain = (line, chains[n - 1] if n else None)
            if n == len(last):
                last.append(j)
                chains.append(chain)
            else:
                last[n], chains[n] = j, chain
    found, chain = set(), chains[-1] if chains else None
    while chain:
        found.add(chain[0])
        chain = chain[1]
    return found


def main_text(page: str | None, neighbour: list[int] | None) -> str:
    """The page's main text, given the keys of the page it is paired with (None: of no page)."""
    lines, marked = lines_of(page)
    shared = aligned(keys_of(lines, marked), neighbour) if neighbour else set()
    if marked:
        shared = template_of(lines, shared)
    elif len(shared) == len(lines):
        shared = set()  # a copy of its neighbour: what they share tells nothing
    return " ".join(
        text
        for k, (text, inside, never, *_) in enumerate(lines)
        if k not in shared and not never and (inside or not marked)
    )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    Null html counts as empty and gives an empty text; html of any length or
    brokenness is read in one pass. An empty table gives no rows. Pages without url or
    host are one host; a host's only page is paired with none. Pages of equal
    host and path follow in the order of page_id, then of the table; repeated
    rows are pages of their own. Other columns are not read.

    Only hashes of lines are sorted and sent to neighbours; the html is
    shuffled once, to meet its partner's hashes.
    """
    spark = pages.sparkSession
    ship(spark)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    columns = [
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host_of(url).alias("__host"),
        path_of(url).alias("__path"),
        F.col("html").cast("string").alias("__html"),
    ]
    rows = numbered(pages, columns, "page-rows")

    def page_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [[k for k in keys_of(*lines_of(x.as_py())) if k is not None] for x in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(keys, pa.list_(pa.int64()))],
                names=["__row", "page_id", "__host", "__path", "__keys"],
            )

    slim = rows.select("__row", "page_id", "__host", "__path", "__html").mapInArrow(
        page_keys, "__row long, page_id long, __host string, __path string, __keys array<long>"
    )
    order = ordered(slim, ["__host", "__path", "page_id", "__row"], "pages")
    order = order.withColumn("__me", F.struct("__host", "__path", "__keys"))
    order = following(order, "__me", "__after")
    order = following(order, "__me", "__before", back=True)

    def common(side: str) -> Column:
        """Length of the common beginning of the two paths; -1 for another host or none."""
        other = F.concat(F.col(f"{side}.__path"), F.lit("\0"))
        lengths = F.sequence(F.lit(1), F.least(F.char_length("__path"), F.char_length(f"{side}.__path")) + 1)
        same = F.transform(
            lengths, lambda n: F.substring(F.col("__path"), F.lit(1), n) != F.substring(other, F.lit(1), n)
        )
        first_off = F.array_position(same, True)
        return F.when(F.col(f"{side}.__host") == F.col("__host"), first_off).otherwise(F.lit(-1))

    order = order.withColumn("__b", F.coalesce(common("__before"), F.lit(-1)))
    order = order.withColumn("__a", F.coalesce(common("__after"), F.lit(-1)))
    partner = order.select(
        "__row",
        F.when(F.greatest("__a", "__b") < 0, None)
        .when(F.col("__b") >= F.col("__a"), F.col("__before.__keys"))
        .otherwise(F.col("__after.__keys"))
        .alias("__partner"),
    )

    @F.udf("string", useArrow=True)
    def text_of(page, keys):
        return main_text(page, None if keys is None else [int(k) for k in keys])

    found = rows.select("__row", "page_id", "url", "__html").join(partner, "__row")
    found = found.select("page_id", "url", text_of("__html", "__partner").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
