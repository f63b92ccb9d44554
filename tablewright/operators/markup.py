"""Elements of a web page, each up to its own end, with the text that a reader sees.

A page is read once from left to right. Open elements stand on a stack, so an
element ends with its own closing tag, with that of an element around it, or
where HTML implies its end (a paragraph at the next one, a list item at the
next). Comments, scripts and styles hold no text and no elements.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, functions as F

# The rules of HTML for elements without content, hidden ones, and ends that are implied.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(["script", "style"])
BLOCKS = (
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul"
).split()
# start tag: what it ends, and the elements beyond which it ends nothing
IMPLIED = {
    **{tag: (frozenset(["p"]), frozenset(["button", "td", "th", "table", "caption"])) for tag in BLOCKS},
    "li": (frozenset(["li"]), frozenset(["ul", "ol"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "a": (frozenset(["a"]), frozenset(["td", "th", "table"])),
}

# a comment, a declaration, or a tag; possessive throughout, so nothing is tried twice
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<rest>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
ENDS_OF = {tag: re.compile(rf"</{tag}\b[^>]*+>", re.IGNORECASE) for tag in HIDDEN}

ELEMENTS = "array<struct<rule:string,position:int,text:string,value:string>>"


class Rule(NamedTuple):
    """Elements to find: those whose tag fits ``tag`` (a pattern) and whose ``attribute`` is there and, with ``word``,
    has it among its words. ``value`` names an attribute to read."""

    name: str
    tag: str = ".*"
    attribute: str | None = None
    word: str | None = None
    value: str | None = None


def attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(rest):
        out.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return out


def find_elements(page: str, rules: Sequence[Rule]) -> list[tuple[str, str, str | None]]:
    """Rule, visible text and read attribute of all elements that fit a rule, in the order of their start tags.

    An element counts for the first rule it fits. Blanks at both ends of the
    text are cut off.
    """
    texts: list[str] = []
    length = 0
    stack: list[tuple[str, int]] = []  # tag and number of the found element, or -1
    open_: Counter = Counter()
    found: list[list] = []  # rule, value, where the text begins and ends
    fits: dict[str, list[Rule]] = {}

    def close(count: int) -> None:
        for tag, number in stack[len(stack) - count:]:
            open_[tag] -= 1
            if number >= 0:
                found[number][3] = length
        del stack[len(stack) - count:]

    at = 0
    for_text = page.find("<")
    while for_text >= 0:
        m = TOKEN.match(page, for_text)
        if m is None:  # a bare character
            for_text = page.find("<", for_text + 1)
            continue
        if for_text > at:
            texts.append(entities.unescape(page[at:for_text]))
            length += len(texts[-1])
        at = m.end()
        if m["tag"]:
            tag = m["tag"].lower()
            if m["end"]:
                if open_[tag]:
                    depth = 1
                    while stack[-depth][0] != tag:
                        depth += 1
                    close(depth)
            else:
                ended, barrier = IMPLIED.get(tag, (frozenset(), frozenset()))
                if any(open_[t] for t in ended):
                    for depth in range(1, len(stack) + 1):
                        if stack[-depth][0] in ended:
                            close(depth)
                            break
                        if stack[-depth][0] in barrier:
                            break
                if tag not in fits:
                    fits[tag] = [r for r in rules if re.fullmatch(r.tag, tag, re.IGNORECASE)]
                number = -1
                if fits[tag]:
                    own = attributes(m["rest"])
                    for rule in fits[tag]:
                        if rule.attribute is None or (rule.attribute in own and (rule.word is None or rule.word in own[rule.attribute].split())):
                            number = len(found)
                            found.append([rule.name, own.get(rule.value) if rule.value else None, length, length])
                            break
                if tag in HIDDEN:
                    end = ENDS_OF[tag].search(page, at)
                    at = end.end() if end else len(page)
                elif tag not in VOID and not m["rest"].endswith("/"):
                    stack.append((tag, number))
                    open_[tag] += 1
        for_text = page.find("<", at)
    if at < len(page):
        texts.append(entities.unescape(page[at:]))
        length += len(texts[-1])
    close(len(stack))
    whole = "".join(texts)
    return [(rule, whole[a:b].strip(), value) for rule, value, a, b in found]


def elements(html: Column | str, rules: Sequence[Rule]) -> Column:
    """Elements of a page as an array of rule, position (from 0), text and value; none for a missing page."""
    rules = list(rules)

    @F.arrow_udf(ELEMENTS)
    def found(pages: pa.Array) -> pa.Array:
        kind = pa.struct([("rule", pa.string()), ("position", pa.int32()), ("text", pa.string()), ("value", pa.string())])
        offsets, columns = [0], ([], [], [], [])
        for page in pages:
            for position, (rule, text, value) in enumerate(find_elements(page.as_py() or "", rules)):
                for column, cell in zip(columns, (rule, position, text, value)):
                    column.append(cell)
            offsets.append(len(columns[0]))
        cells = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)

    return found(F.col(html) if isinstance(html, str) else html)
