"""Main-text extraction with site style trees.

The DOMs of a site are merged into one tree whose nodes are element paths (tag and classes,
long numbers in them aside, runs of equal siblings joined). A leaf is important when its pages
differ: presentation importance is the entropy of the child sequences seen at its parent,
content importance is one less the mean entropy of its texts over the pages. The composite
importance of an inner node adds its own presentation to that of the text below it, which
counts less the deeper it lies. Menus, adverts and footers repeat and score low; articles
score high. The same tree over all sites serves sites with few pages. A page loses its leaves
and its whole branches of low importance. What varies from page to page is important to the
trees even in an advert, so among the blocks that are left markup is a prior: branches that it
declares to be apart (navigation, forms, asides, comments and the like) or that are outside a
declared article give way, unless the site's tree shows that they hold most of its text.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import batches, dealt, hot_keys, in_parts, staged

#: Weight of presentation against content in a leaf's importance.
PRESENTATION = 0.1
#: Least importance of a node, and of one inside a declared article, where only what nearly all pages of its own site share goes.
LEAST, LEAST_INSIDE = 0.55, 0.2
#: A branch of less composite importance goes whole, with what varies in it, if it holds less than this share of its site's important text.
LEAST_BRANCH, SHARE = 0.3, 0.3
#: What text counts for an inner node, for each level that it lies deeper.
DEPTH = 0.9
#: A node on fewer distinct pages has no evidence against it.
LEAST_PAGES = 8
ALL_SITES = "*"
#: Branches of a page by their markup: plain, outside a declared article, inside one. One that is apart has its own path.
PLAIN, OUTSIDE, INSIDE = 0, 1, 2

#: Comments, declarations and tags as browsers read them: quotes count after an equals sign, and what is left open goes on to the end. Every alternative
#: that begins ends, so a page is read in time that grows with its length.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)", re.S)
#: Elements lie no deeper in a page's tree, as in browsers; deeper ones are read as their ancestor's.
DEEPEST = 512
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s\"'>]+))?")
#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
RAW = frozenset("script style noscript template iframe svg math textarea title object audio video canvas select".split())
APART = frozenset("nav footer aside form header menu dialog button head fieldset".split())
ROOTS = frozenset("article main".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "body": ("head",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES_APART = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?\w*|consent|gdpr|notice|notification|alert|sidebar|side-bar|nav|navbar|navigation|menu|breadcrumbs?|foot|footer|masthead|header|comments?|comment-\w+|commentlist|disqus\w*|respond|replies|reply|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|popup|modal|overlay|widget|login|search|searchform|pagination|pager|tags|byline-share|copyright|skip-link|toolbar|discussion)(?:$|[\s_-])",
    re.I,
)
NAMES_ROOT = re.compile(r"(?:^|[\s_-])(?:article|article-?body|post-?body|post-?content|entry-?content|main-?content|story-?body|articlebody)(?:$|[\s_-])", re.I)
#: Names that tell what an element has or is near, not what it is; and headers that belong to a text.
NAMES_OF_STATE = re.compile(r"^(?:has|with|without|no|is|show|hide)[-_]", re.I)
NAMES_OF_TEXT_HEAD = re.compile(r"^(?:article|post|entry|story|content)[-_]*(?:header|head)$", re.I)
BLANK = re.compile(r"\s+")
NUMBER = re.compile(r"\d{3,}")


def named_apart(names: list[str], inside: bool) -> bool:
    """Whether class names or an id say that an element isn't text; inside an article a header is."""
    for name in names:
        if NAMES_OF_STATE.match(name) or NAMES_OF_TEXT_HEAD.match(name) or NAMES_ROOT.search(name):
            continue
        found = NAMES_APART.search(name)
        if found and not (inside and "header" in found[0].lower()):
            return True
    return False


class Block:
    """A text block of a page with its place in the tree.

    line: paths of the elements around it, from the outermost to its own. apart: path of the
    outermost element that markup calls apart, or 0.
    """

    __slots__ = ("apart", "inside", "line", "text")

    def __init__(self, line: tuple[int, ...], inside: bool, apart: int, text: str):
        self.line, self.inside, self.apart, self.text = line, inside, apart, text

    @property
    def path(self) -> int:
        return self.line[-1]

    @property
    def parent(self) -> int:
        return self.line[-2] if len(self.line) > 1 else ROOT


@lru_cache(maxsize=1 << 16)
def _path_hash(text: str) -> int:
    return _hash(text)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


#: The path of what holds a page's outermost elements.
ROOT = _hash("")


def read_page(page: str) -> tuple[list[Block], Counter]:
    """The text blocks of a page in order, and its (path, child sequence) pairs, which are style nodes."""
    blocks: list[Block] = []
    styles: Counter = Counter()
    # open elements: tag, path, inside a root, apart, children seen, previous child, path's hash
    stack = [["#", "", False, 0, [], None, ROOT]]
    lines: dict[int, tuple[int, ...]] = {ROOT: (ROOT,)}
    deeper: Counter = Counter()
    pending: list[str] = []
    place = 0
    size = len(page)

    def end_block() -> None:
        if pending:
            text = BLANK.sub(" ", html_lib.unescape("".join(pending))).strip()
            pending.clear()
            if text:
                top = stack[-1]
                blocks.append(Block(lines[top[6]], top[2], top[3], text))

    def close(depth: int) -> None:
        """Close all open elements from `depth` on."""
        end_block()
        while len(stack) > depth:
            _, _, _, _, children, _, path = stack.pop()
            if children:
                styles[path, _path_hash(">".join(children))] += 1

    while place < size:
        m = TOKEN.search(page, place)
        if m is None:
            pending.append(page[place:])
            break
        if m.start() > place:
            pending.append(page[place : m.start()])
        place = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "p" and all(x[0] != "p" for x in stack):
                end_block()
            elif tag in INLINE:
                continue
            elif deeper[tag]:
                deeper[tag] -= 1
                end_block()
            else:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
                else:
                    end_block()
            continue
        if tag == "br":
            pending.append(" ")
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, place)
                place = end.end() if end else size
            if tag not in INLINE:
                end_block()
            continue
        if tag in INLINE:
            continue
        end_block()
        shut = CLOSES.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            name = stack[depth][0]
            if name in shut or name == "p" and tag in CLOSES_P:
                close(depth)
            elif name in STOPS.get(tag, ()) or name not in ("p", *shut):
                break
        if tag in VOID:
            continue
        if len(stack) > DEEPEST:
            deeper[tag] += 1
            continue
        top = stack[-1]
        named, apart, root = "", bool(top[3]), tag in ROOTS
        if m[3]:
            found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m[3])}
            named = ".".join(sorted(set(NUMBER.sub("0", found.get("class", "")).split())))
            words = f"{found.get('class', '')} {found.get('id', '')}"
            apart |= tag not in ("html", "body", *ROOTS) and named_apart(words.split(), top[2])
            apart |= tag in ROOTS and bool(re.search(r"comment|teaser|related", words, re.I))
            apart |= found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
            apart |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I))
            root |= bool(NAMES_ROOT.search(words)) or found.get("role") == "main" or found.get("itemprop") == "articleBody"
        apart |= tag in APART and not (tag == "header" and top[2])
        name = f"{tag}.{named}" if named else tag
        if top[5] != name:
            top[4].append(name)
            top[5] = name
        path = f"{top[1]}/{name}"
        place_in_tree = _path_hash(path)
        if place_in_tree not in lines:
            lines[place_in_tree] = (*(lines[top[6]] if top[6] != ROOT else ()), place_in_tree)
        stack.append([tag, path, top[2] or root, top[3] or (place_in_tree if apart else 0), [], None, place_in_tree])
    close(1)
    end_block()
    if stack[0][4]:
        styles[ROOT, _path_hash(">".join(stack[0][4]))] += 1
    return blocks, styles


def branches(blocks: list[Block]) -> list[int]:
    """The branch of each block by markup alone."""
    rooted = any(b.inside and not b.apart for b in blocks)
    return [b.apart or (INSIDE if b.inside else OUTSIDE if rooted else PLAIN) for b in blocks]


def host_of(url: str) -> "F.Column":
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def page_features(pages: DataFrame) -> DataFrame:
    """(site, kind, path, parent, what, c, s) of the trees of `pages` (host, html); s is the sum of c log c.

    ALL_SITES names the tree of all pages. Copies of a page count once in a tree: features
    carry a hash of their page until it is known which are distinct. Of kind mass, c is the
    characters of a leaf by the branch (parent) that markup puts it in; of kind below, what is
    a leaf below path and parent its distance; both for sites alone.
    """

    def features(frames):
        columns = ["site", "kind", "path", "parent", "what", "body", "c"]
        for frame in batches(frames, 400):
            out, seen, below = [], set(), set()
            for host, body, page in zip(frame["host"], frame["body"], frame["html"]):
                if (host, body) in seen:
                    continue
                seen.add((host, body))
                blocks, styles = read_page(page)
                mass: Counter = Counter()
                for b, branch in zip(blocks, branches(blocks)):
                    mass[b.path, branch] += len(b.text)
                out += [(host, "mass", path, branch, 0, body, c) for (path, branch), c in mass.items()]
                below |= {(host, line) for line in {b.line for b in blocks}}
                texts = Counter((b.path, b.parent, _hash(b.text)) for b in blocks)
                paths = {b.path for b in blocks} | {p for p, _ in styles}
                for site in {host, ALL_SITES}:
                    out += [(site, "text", path, parent, what, body, c) for (path, parent, what), c in texts.items()]
                    out += [(site, "style", path, 0, what, body, c) for (path, what), c in styles.items()]
                    out += [(site, "page", path, 0, 0, body, 1) for path in paths]
            out += [(host, "below", path, len(line) - i, line[-1], 0, 1) for host, line in below for i, path in enumerate((ROOT, *line))]
            yield pd.DataFrame(out, columns=columns)

    keys = ["site", "kind", "path", "parent", "what"]
    raw = pages.select("host", F.xxhash64("html").alias("body"), "html").mapInPandas(features, "site string, kind string, path long, parent long, what long, body long, c long")
    c = F.col("c")
    once = raw.groupBy(*keys, "body").agg(F.max("c").alias("c"))
    return staged(once.groupBy(*keys).agg(F.sum(c).alias("c"), F.sum(c * F.log(c.cast("double"))).alias("s")), "features")


def node_importance(sums: DataFrame) -> DataFrame:
    """(site, path, parent, importance, presentation, pages) of the nodes of the trees of page_features(): leaves have an importance.

    A feature's entropy over a node's pages comes from the sums of its counts and of their
    c log c, and a node's mean from sums of those, so counts combine before each shuffle and a
    host with a third of all pages meets in no task.
    """
    of = ["site", "path"]
    seen = sums.where("kind = 'page'").select(*of, F.col("c").alias("pages"))
    over = F.greatest(F.log(F.col("pages").cast("double")), F.lit(1e-9))
    c = F.col("c").cast("double")
    share = lambda h: F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))
    text = sums.where("kind = 'text'").groupBy(*of).agg(F.sum(F.log(c) - F.col("s") / c).alias("h"), F.count("*").alias("n"), F.min("parent").alias("parent"))
    # entropy of the styles of a node: log n - sum(c log c) / n, over log pages
    style = sums.where("kind = 'style'").groupBy(*of).agg(F.sum("c").cast("double").alias("m"), F.sum(c * F.log(c)).alias("t"))
    nodes = seen.join(text, of, "left").join(style, of, "left").select(
        *of, "parent", "pages", F.when(F.col("h").isNotNull(), 1 - share(F.col("h") / F.col("n") / over)).alias("content"), F.coalesce(share((F.log("m") - F.col("t") / F.col("m")) / over), F.lit(0.0)).alias("presentation"),
    )
    above = nodes.select("site", F.col("path").alias("parent"), F.col("presentation").alias("around"))
    leaf = PRESENTATION * F.coalesce("around", F.lit(0.0)) + (1 - PRESENTATION) * F.col("content")
    return nodes.join(above, ["site", "parent"], "left").select("site", "path", "parent", leaf.alias("importance"), "presentation", "pages")


def low_branches(sums: DataFrame, nodes: DataFrame) -> DataFrame:
    """(site, branch) of the branches that go whole: inner nodes of a site's tree of low composite importance.

    That is the node's presentation importance with the mean importance of the text below,
    which weighs its characters, and less for each level. A node on few pages stays, and so
    does one that holds SHARE of the site's important text, as all do that are around it.
    """
    mass = sums.where("kind = 'mass'").groupBy("site", "path").agg(F.sum("c").alias("chars"))
    leaves = nodes.where(F.col("importance").isNotNull()).join(mass, ["site", "path"]).select("site", F.col("path").alias("what"), "importance", "chars", trusted("importance").alias("kept"))
    heavy = F.when(F.col("kept") >= LEAST, F.col("chars")).otherwise(0)
    total = leaves.groupBy("site").agg(F.sum(heavy).alias("total"))
    weight = F.col("chars") * F.pow(F.lit(DEPTH), F.col("distance"))
    held = (
        sums.where("kind = 'below'").select("site", "path", F.col("parent").alias("distance"), "what").join(leaves, ["site", "what"])
        .groupBy("site", "path").agg((F.sum(weight * F.col("importance")) / F.sum(weight)).alias("mean"), F.sum(heavy).alias("important"))
    )
    inner = held.join(nodes.select("site", "path", "presentation", "pages"), ["site", "path"]).join(total, "site")
    composite = PRESENTATION * F.col("presentation") + (1 - PRESENTATION) * F.col("mean")
    return inner.where((F.col("pages") >= LEAST_PAGES) & (composite < LEAST_BRANCH) & (F.col("important") < SHARE * F.col("total"))).select("site", F.col("path").alias("branch"))


def trusted(importance: str) -> "F.Column":
    """An importance, or 1 without evidence."""
    return F.when(F.col("pages") >= LEAST_PAGES, F.col(importance)).otherwise(1.0)


def heavy_branches(sums: DataFrame, own: DataFrame) -> DataFrame:
    """(site, branch) that markup puts aside though the site's own tree finds most of its text there.

    Only nodes with evidence of their importance count for such a branch; against it stands
    all other text that counts, of plain branches all that the tree doesn't remove. own: site,
    path, own, proved.
    """
    mass = sums.where("kind = 'mass'").select("site", "path", F.col("parent").alias("branch"), F.col("c").alias("chars")).join(own, ["site", "path"])
    aside = ~F.col("branch").isin(PLAIN, INSIDE)
    counts = F.when(aside, F.col("proved") & (F.col("own") >= LEAST)).otherwise(F.col("own") >= F.when(F.col("branch") == INSIDE, LEAST_INSIDE).otherwise(LEAST))
    by = mass.where(counts).groupBy("site", F.when(aside, F.col("branch")).alias("branch")).agg(F.sum("chars").alias("chars"))
    total = by.groupBy("site").agg(F.sum("chars").alias("total"))
    return by.where("branch is not null").join(total, "site").where(2 * F.col("chars") > F.col("total")).select("site", "branch")


def main_text(blocks: list[Block], importance: dict[int, tuple[float, float]], heavy: frozenset | set = frozenset(), low: frozenset | set = frozenset()) -> str:
    """Text of a page's important blocks, one a line. A node without evidence is important.

    The trees judge every block: `low` branches go whole. Of the blocks that they leave,
    markup decides as a prior: what is apart or outside the article goes, unless its branch is
    in `heavy`. Markup counts as declaring an article only if the trees leave something of it.
    """
    left, stays = [], {}
    for b in blocks:
        if b.line not in stays:
            stays[b.line] = low.isdisjoint(b.line)
        own, everywhere = importance.get(b.path, (1.0, 1.0))
        if not (own < LEAST_INSIDE if b.inside else min(own, everywhere) < LEAST) and stays[b.line]:
            left.append(b)
    return "\n".join(b.text for b, branch in zip(left, branches(left)) if branch in (PLAIN, INSIDE) or branch in heavy)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html).

    Null html is empty and gives an empty text, as does a page without important blocks.
    Pages without a host share a tree. Repeated rows repeat; an empty table gives none.
    Broken markup is read as far as it goes: open elements end with their parents, and a tag that
    never ends takes the rest of the page with it, as in browsers.

    Only features and the sites' lists of low nodes are shuffled before the lists meet the
    pages. If they are too many for Spark to send to every task, pages move once, those of a
    host with very many of them dealt to several tasks.
    """
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of("url").alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sums = page_features(known)
    nodes = staged(node_importance(sums), "nodes")
    leaves = nodes.where(F.col("importance").isNotNull())
    own = leaves.where(F.col("site") != ALL_SITES).select("site", "path", trusted("importance").alias("own"), (F.col("pages") >= LEAST_PAGES).alias("proved"))
    all_sites = leaves.where(F.col("site") == ALL_SITES).select("path", trusted("importance").alias("everywhere"))
    low = own.join(all_sites, "path").where(F.least("own", "everywhere") < LEAST)
    # one row a site: its low nodes, at most one for each LEAST_PAGES pages that have it or that are like it
    lists = low.groupBy("site").agg(F.collect_list(F.struct("path", "own", "everywhere")).alias("low"))
    heavy = heavy_branches(sums, own).groupBy("site").agg(F.collect_list("branch").alias("heavy"))
    cut = low_branches(sums, nodes).groupBy("site").agg(F.collect_list("branch").alias("cut"))

    hot = hot_keys(known.groupBy(F.col("host").alias("site")).agg(F.count("*").alias("n")), "site")
    lists = staged(in_parts(lists.join(heavy, "site", "full").join(cut, "site", "full"), hot, "site"), "low")
    joined = dealt(known.withColumnRenamed("host", "site"), hot, "site", "page_id", "url").join(lists, ["site", "part"], "left")

    @F.pandas_udf("string")
    def text(html: pd.Series, low: pd.Series, heavy: pd.Series, cut: pd.Series) -> pd.Series:
        of = lambda x: set() if x is None else set(x)
        return pd.Series([
            main_text(read_page(h)[0], {} if x is None else {r["path"]: (r["own"], r["everywhere"]) for r in x}, of(y), of(z)) for h, x, y, z in zip(html, low, heavy, cut)
        ], dtype=object)

    out = joined.select("page_id", "url", text("html", "low", "heavy", "cut").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
