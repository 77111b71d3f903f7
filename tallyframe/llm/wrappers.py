"""Pages as trees, and union-free regular expressions inferred from them.

An expression is a list [label, optional, repeated, content]: content is a list of
expressions, or for text ("#") its fixed value, the list of the values that neighbours of
one page have, or None for a slot, whose values differ between pages. Labels are tag names
with their class, id and role, without digits; elements are aligned by their `key`.
"""

from __future__ import annotations

import hashlib
import re
from difflib import SequenceMatcher
from html import unescape

# HTML's own element groups.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title template noscript iframe svg select".split())
#: Those of them that take the rest of a page when their end tag is missing.
ENDLESS = set("script style textarea".split())
#: Elements whose own class, id and role say nothing about the article in them.
WHOLE = set("html body main article".split())
BOILERPLATE = set(
    "nav header footer aside form button menu dialog fieldset legend option script style".split())
#: Open elements that a tag ends without an end tag of their own, beside p.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}}
#: Parts of class, id and role names that mark, outside main elements, what is not the article.
MARKED = re.compile(
    r"(?:^|[._#-])(?:ads?|adverts?|advertisements?|advertising|banner|promos?|promotions?|sponsor(?:s|ed)?|"
    r"cookies?|consent|notices?|alerts?|comments?|replies|respond|disqus|sidebar|menu|nav|navbar|"
    r"navigation|breadcrumbs?|footer|masthead|share|sharing|social|related|recommend(?:ed|ations?)|"
    r"newsletter|subscribe|signup|login|search|popup|modal|widget|copyright|toolbar|pagination|"
    r"complementary|contentinfo)(?=$|[._#-])")
#: Whole names that mark it inside main elements too; a part of a name says nothing there.
NAMED = set(
    "ad ads advert adverts advertisement comments comment-list comments-area disqus_thread respond sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer cookie-banner cookie-notice "
    "newsletter-signup share-buttons complementary contentinfo".split())
MAIN = re.compile(r"^(?:article|main)(?:$|[.#])|[.#](?:main|articlebody|article-body|post-content|entry-content)(?=$|[.#])")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CLOSERS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
#: Elements that hold one block, not an article.
_SMALL = re.compile(r"(?:p|li|td|h\d)(?:$|[.#])")
#: Elements nested deeper belong, for the template, to the one at this depth; their texts stay.
DEPTH = 100
#: Texts over this length stand in a template as their digest and length.
FIXED_LENGTH = 40
#: Pages that have more of their text in common are copies, unless their headings differ.
COPIES = 0.8


def label_of(name: str, attributes: str) -> str:
    if not attributes or "=" not in attributes:
        return name
    words = []
    for kind, *values in _NAMED.findall(attributes):
        words += [("#" if kind.lower() == "id" else ".") + w for w in "".join(values).lower().split()]
    return re.sub(r"[\d/]+", "", name + "".join(sorted(set(words))))


def value_of(text: str) -> str:
    """The text, or of a long one a 128-bit digest and its length."""
    if len(text) <= FIXED_LENGTH and not text.startswith("\0"):
        return text
    digest = hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()
    return f"\0{digest}{len(text)}"


def length_of(value: str) -> int:
    return int(value[33:]) if value.startswith("\0") else len(value)


def boilerplate(label: str, in_main: bool) -> bool:
    name = re.split(r"[.#]", label, maxsplit=1)[0]
    if name == "header" and in_main:
        return False
    if name in BOILERPLATE:
        return True
    if name in WHOLE:
        return False
    if in_main:
        return not NAMED.isdisjoint(re.split(r"[.#]", label[len(name):]))
    return MARKED.search(label[len(name):]) is not None


def common(paths: list[str]) -> str:
    """The path of the lowest element above all."""
    first = paths[0].split("/") if paths else []
    for path in paths[1:]:
        parts = path.split("/")
        first = first[:next((i for i, (x, y) in enumerate(zip(first, parts)) if x != y), min(len(first), len(parts)))]
    return "/".join(first)


class Page:
    """The tree of a page, and its text blocks as (path, text, kept).

    Kept are the blocks in main elements outside boilerplate; without any, all outside it;
    without any of these, all outside elements that are boilerplate by their tag.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, str, bool]] = []
        self.mains: set[str] = set()
        self._in_main: list[bool] = []
        self._by_tag: list[bool] = []
        self._no_end: set[str] = set()
        root = ["", 0, 0, []]
        # open elements: name, node, path, outside boilerplate, path of the main element,
        # outside boilerplate by tags alone
        self.stack = [("", root, "", True, None, True)]
        self.text: list[str] = []
        at, n = 0, len(html)
        while at < n:
            token = _TOKEN.search(html, at)
            end = token.start() if token else n
            if end > at:
                self.text.append(html[at:end])
            if not token:
                break
            at = token.end()
            if token[2]:
                at = self._tag(html, token, at)
        self._flush()
        self.tree = root
        if self.mains:
            self.blocks = [(path, text, kept and main)
                           for (path, text, kept), main in zip(self.blocks, self._in_main, strict=True)]
        elif not any(kept for _, _, kept in self.blocks):
            self.blocks = [(path, text, by_tag)
                           for (path, text, _), by_tag in zip(self.blocks, self._by_tag, strict=True)]

    def _tag(self, html: str, token: re.Match, at: int) -> int:
        closing, name = token[1], token[2].lower()
        if name in INLINE:
            if name == "br":
                self.text.append(" ")
            return at
        self._flush()
        if closing:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == name:
                    del self.stack[k:]
                    break
            return at
        ended = ENDS.get(name, ())
        while self.stack[-1][0] == "p" or self.stack[-1][0] in ended:
            self.stack.pop()
        if name in RAW:
            if name == "svg" and token[3].endswith("/"):
                return at
            close = None if name in self._no_end else _CLOSERS[name].search(html, at)
            if close:
                return close.start()
            self._no_end.add(name)
            return len(html) if name in ENDLESS else at
        label = label_of(name, token[3])
        _, parent, path, kept, main, by_tag = self.stack[-1]
        if len(self.stack) < DEPTH:
            node, path = [label, 0, 0, []], f"{path}/{label}"
            parent[3].append(node)
        else:
            node = parent
        kept = kept and name != "head" and not boilerplate(label, main is not None)
        by_tag = by_tag and name != "head" and not boilerplate(name, main is not None)
        if MAIN.search(label) and kept and main is None:
            main = path
        if name not in VOID:
            self.stack.append((name, node, path, kept, main, by_tag))
        return at

    def _flush(self) -> None:
        if self.text:
            text = " ".join(unescape("".join(self.text)).split())
            self.text = []
            if text:
                _, node, path, kept, main, by_tag = self.stack[-1]
                node[3].append(["#", 0, 0, value_of(text)])
                self.blocks.append((path, text, kept))
                self._in_main.append(main is not None)
                self._by_tag.append(by_tag)
                if kept and main is not None:
                    self.mains.add(main)

    def region(self) -> str:
        """Path of the lowest element that holds all kept blocks, or all main elements with text."""
        if self.mains:
            return common(sorted(self.mains))
        path = common(sorted({path for path, _, kept in self.blocks if kept}))
        while _SMALL.match(path.rpartition("/")[2]):
            path = path.rpartition("/")[0]
        return path

    def article(self, fixed: set | frozenset = frozenset(), left_out: set | frozenset = frozenset()) -> str:
        """The kept blocks, without the texts that are fixed parts of the template and those numbered `left_out`."""
        return "\n".join(
            text for k, (path, text, kept) in enumerate(self.blocks)
            if kept and k not in left_out and (not fixed or (path, value_of(text)) not in fixed))

    def numbered(self) -> list:
        """The tree as an expression whose texts are the lists of the numbers of their blocks."""
        count = iter(range(len(self.blocks)))

        def copy(node: list) -> list:
            return ["#", 0, 0, [next(count)]] if node[0] == "#" else [*node[:3], [copy(x) for x in node[3]]]

        return shape(copy(self.tree))


def key(node: list) -> str:
    """What is aligned: the label; of an element without a name of its own also that of its first child."""
    return f"{node[0]}>{node[3][0][0]}" if node[0] in ("div", "section") and node[3] else node[0]


def fold(items: list) -> list:
    """Merge neighbours of equal label, then neighbouring groups of two and three, into repeats."""
    out: list = []
    for item in items:
        if out and key(out[-1]) == key(item):
            out[-1] = merge(out[-1], item, one_page=True)
            out[-1][2] = 1
        else:
            out.append(item)
    for width in (2, 3):
        at = 0
        while at + 2 * width <= len(out):
            one, two = out[at:at + width], out[at + width:at + 2 * width]
            if [key(x) for x in one] == [key(x) for x in two]:
                both = [merge(a, b, one_page=True) for a, b in zip(one, two, strict=True)]
                for x in both:
                    x[2] = 1
                out[at:at + 2 * width] = both
            else:
                at += 1
    return out


def merge(a: list, b: list, one_page: bool = False) -> list:
    """The expression of both, which have one label: a text that differs between pages becomes a slot."""
    if a[0] != "#":
        return [a[0], a[1] | b[1], a[2] | b[2], align(a[3], b[3], one_page)]
    one, two = a[3], b[3]
    if one_page and one is not None and two is not None:
        both = [*(one if isinstance(one, list) else [one]), *(two if isinstance(two, list) else [two])]
    else:
        both = one if one == two else None
    return ["#", a[1] | b[1], a[2] | b[2], both]


def align(one: list, two: list, one_page: bool = False) -> list:
    """Align two sequences; what only one of them has becomes optional."""
    names = [key(x) for x in one], [key(x) for x in two]
    if names[0] == names[1]:
        return fold([merge(x, y, one_page) for x, y in zip(one, two, strict=True)])
    out = []
    matcher = SequenceMatcher(None, *names, autojunk=False)
    for kind, a, b, c, d in matcher.get_opcodes():
        if kind == "equal":
            out += [merge(x, y, one_page) for x, y in zip(one[a:b], two[c:d], strict=True)]
        else:
            out += [[x[0], 1, x[2], x[3]] for x in one[a:b] + two[c:d]]
    return fold(out)


def shape(node: list) -> list:
    """A page's tree as an expression, with its repeats folded."""
    if node[0] == "#":
        return node
    return [node[0], node[1], node[2], fold([shape(child) for child in node[3]])]


def fixed_texts(wrapper: list, region: str, size: float) -> list[tuple[str, str]]:
    """(path, value) of the required texts of a template inside its article region.

    None if nothing there varies between pages, or, under equal headings, little of the
    `size` characters that a page has on average: then the pages are copies, not a template.
    """
    found: list[tuple[str, str]] = []
    slots, titles, equal = [0], [0], [0]

    def walk(node: list, path: str, required: bool, main: bool) -> None:
        for child in node[3]:
            needed = required and not child[1]
            if child[0] != "#":
                if not boilerplate(child[0], main):
                    walk(child, f"{path}/{child[0]}", needed, main or MAIN.search(child[0]) is not None)
            elif path == region or path.startswith(region + "/"):
                heading = re.match(r"h\d", path.rpartition("/")[2])
                if child[3] is None:
                    slots[0] += 1
                    titles[0] += bool(heading)
                elif needed:
                    values = child[3] if isinstance(child[3], list) else [child[3]]
                    equal[0] += sum(map(length_of, values))
                    if not heading:
                        found.extend((path, value) for value in values)

    walk(wrapper, "", True, False)
    return found if titles[0] or slots[0] and equal[0] <= COPIES * size else []


def number(wrapper: list) -> dict[int, int]:
    """Numbers of a wrapper's expressions in document order, by identity."""
    found: dict[int, int] = {}

    def walk(node: list) -> None:
        found[id(node)] = len(found)
        if node[0] != "#":
            for child in node[3]:
                walk(child)

    walk(wrapper)
    return found


def read_page(wrapper: list, page: list, numbers: dict[int, int]) -> list[tuple[int, list]]:
    """Match the expression of a page with its wrapper: (number of the slot, texts) of each text."""
    found: list[tuple[int, list]] = []

    def walk(one: list, two: list) -> None:
        if one[0] == "#":
            found.append((numbers[id(one)], two[3] if isinstance(two[3], list) else [two[3]]))
            return
        names = [key(x) for x in one[3]], [key(x) for x in two[3]]
        if names[0] == names[1]:
            same = [(0, 0, len(names[0]))]
        else:
            same = SequenceMatcher(None, *names, autojunk=False).get_matching_blocks()
        for a, b, n in same:
            for x, y in zip(one[3][a:a + n], two[3][b:b + n], strict=True):
                walk(x, y)

    walk(wrapper, page)
    return found


def template_slots(wrapper: list, sizes: dict[int, tuple[int, int]]) -> list[int]:
    """Slots of the elements beside the article that are template for the most part.

    `sizes` has, per slot, the characters of all pages and those of template texts. The
    article's element is the lowest one, above paragraphs and the like, with over half of the text
    that varies. Outside it an element that is template by over half of its text is template
    as a whole, with the few texts that vary in it, such as a date or the current page.
    """
    numbers = number(wrapper)
    total: dict[int, tuple[int, int]] = {}

    def add(node: list) -> tuple[int, int]:
        if node[0] == "#":
            chars, known = sizes.get(numbers[id(node)], (0, 0))
        else:
            parts = [add(child) for child in node[3]]
            chars, known = sum(x for x, _ in parts), sum(x for _, x in parts)
        total[id(node)] = chars, known
        return chars, known

    def varying(node: list) -> int:
        return total[id(node)][0] - total[id(node)][1]

    add(wrapper)
    home, inside = wrapper, {id(wrapper)}
    while True:
        next_home = next((
            x for x in home[3] if x[0] != "#" and 2 * varying(x) > varying(wrapper) and not _SMALL.match(x[0])), None)
        if next_home is None:
            break
        home = next_home
        inside.add(id(home))
    found: list[int] = []

    def leave(node: list, whole: bool) -> None:
        if node[0] == "#":
            if whole:
                found.append(numbers[id(node)])
            return
        chars, known = total[id(node)]
        whole = whole or id(node) not in inside and 2 * known > chars and not re.match(r"h\d", node[0])
        if node is not home:
            for child in node[3]:
                leave(child, whole)

    leave(wrapper, False)
    return found


def template_blocks(page: Page, wrapper: list, slots: set[int], values: set[tuple[int, str]]) -> set[int]:
    """Numbers of a page's blocks that its wrapper holds for template.

    None if they are over COPIES of the page's text: then the page is a copy of others. A
    heading stays unless its whole element is template.
    """
    left_out: set[int] = set()
    for slot, blocks in read_page(wrapper, page.numbered(), number(wrapper)):
        for k in blocks:
            path, text, _ = page.blocks[k]
            heading = re.match(r"h\d", path.rpartition("/")[2])
            if slot in slots or not heading and (slot, value_of(text)) in values:
                left_out.add(k)
    kept = sum(len(text) for _, text, stays in page.blocks if stays)
    gone = sum(len(page.blocks[k][1]) for k in left_out if page.blocks[k][2])
    return left_out if gone <= COPIES * kept else set()
