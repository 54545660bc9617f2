"""Elements of a page: a lexer, a running depth that pairs tags, and selection by tag, class and attribute.

``tokens`` cuts markup in one pass into comments, declarations, raw elements (script, style, textarea, title: whole, since tags inside are text),
tags (a ``>`` inside a quoted value does not end one) and texts. ``select`` pairs the opening and closing tags of one name: an element ends at the closing
tag that brings the depth of its name back to where it began, whatever lies between; without one it ends with the page. What it gives are
elements with their inner tokens, in which ``select`` can look again.

A selector is a tag, classes and attributes: ``div``, ``div.row.wide``, ``span[data-id="price"]``, ``a[href]``. Everything is a column expression
over one row, so no text is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from parcelflow.functions.text import as_col, let, strip

# Elements whose content is text alone, elements without content, and elements that hold none of their own name.
RAW = ("script", "style", "textarea", "title")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
FLAT = ("a", "button", "option", "p", "td", "th", "tr", "h1", "h2", "h3", "h4", "h5", "h6")
# Named character references that are decoded; others stay as they are.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "middot": "·", "amp": "&"}

_INSIDE = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)" + rf"|<({'|'.join(RAW)})(?=[\s/>]){_INSIDE}>.*?(?:</\1\s*+>|\z)" + rf"|</?[a-z]{_INSIDE}>" + r"|<[!?][^>]*+>" + r"|[^<]++|<"
)
ATTRIBUTE = r"""([^\s"'<>/=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?"""
#: Tags of one name whose depth is folded at a time.
CHUNK = 256


@dataclass(frozen=True)
class Selector:
    tag: str
    classes: tuple[str, ...]
    attributes: tuple[tuple[str, str | None], ...]


def parse(selector: str) -> Selector:
    """``tag.class[name=value]`` with any number of classes and attributes."""
    whole = re.fullmatch(r"""([A-Za-z][\w-]*)((?:\.[\w-]+|\[[\w:-]+(?:=(?:"[^"]*"|'[^']*'|[^\]"']*))?\])*)""", selector.strip())
    if not whole:
        raise ValueError(f"a selector is tag.class[name=value], not {selector!r}")
    classes = re.findall(r"\.([\w-]+)", re.sub(r"\[[^\]]*\]", "", whole[2]))
    found = re.findall(r"""\[([\w:-]+)(?:=("[^"]*"|'[^']*'|[^\]"']*))?\]""", whole[2])
    named = [(n.lower(), v.strip("\"'") if f"[{n}=" in whole[2] else None) for n, v in found]
    return Selector(whole[1].lower(), tuple(classes), tuple(named))


def decoded(c: Column | str) -> Column:
    """Named and decimal character references as characters; ``&amp;`` last, so that it opens no new one."""

    def part(p: Column, i: Column) -> Column:
        code = F.regexp_extract(p, r"^([0-9]{1,7});", 1).try_cast("int")
        known = (i > 0) & code.isNotNull() & (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(known, F.concat(char, F.regexp_replace(p, r"^[0-9]+;", ""))).when(i > 0, F.concat(F.lit("&#"), p)).otherwise(p)

    text = F.array_join(F.transform(F.split(as_col(c), "&#", -1), part), "")
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return text


def tokens(html: Column | str) -> Column:
    """The tokens of a page in order; together they are the page."""
    return F.regexp_extract_all(as_col(html), F.lit(TOKEN), F.lit(0))


def _is_text(token: Column) -> Column:
    return ~token.startswith("<") | (token == "<")


def text_of(inside: Column) -> Column:
    """The text among tokens, references decoded, trimmed; null where there is none."""
    return F.nullif(strip(decoded(F.array_join(F.filter(inside, _is_text), ""))), F.lit(""))


def _raw_attribute(opening: Column, name: str) -> Column:
    """An attribute without its quotes; empty where it has no value, null where the tag does not have it."""

    def named(inside: Column) -> Column:
        at = F.array_position(F.regexp_extract_all(F.lower(inside), F.lit(ATTRIBUTE), F.lit(1)), name.lower())
        return F.get(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(2)), F.nullif(at, F.lit(0)).cast("int") - 1)

    raw = let(F.regexp_extract(opening, rf"(?is)^<[a-z][^\s/>]*+({_INSIDE})>", 1), named)
    return F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")


def attribute(opening: Column, name: str) -> Column:
    """An attribute of an opening tag, decoded; empty where it has no value, null where the tag does not have it.

    Attributes are read in order, so a name inside another one's value is not taken for one.
    """
    return strip(decoded(_raw_attribute(opening, name)))


def _fits(opening: Column, selector: Selector) -> Column:
    """Whether an opening tag fits. Attributes are cut only from a tag that holds the wanted value somewhere."""
    fits = F.lit(True)
    for name in selector.classes:
        fits &= F.contains(opening, F.lit(name))
    for _, value in selector.attributes:
        fits &= F.contains(opening, F.lit(value or ""))
    for name in selector.classes:
        fits &= F.coalesce(F.array_contains(F.split(_raw_attribute(opening, "class"), r"\s+"), name), F.lit(False))
    for name, value in selector.attributes:
        own = _raw_attribute(opening, name)
        fits &= own.isNotNull() if value is None else F.coalesce(own == value, F.lit(False))
    return fits


def _depths(steps: Column) -> Column:
    """The depth before each step of +1 or -1, never below zero.

    Folded a chunk at a time: a fold that appends to an array copies it at every step. Over a chunk with sum s that ends at e when it begins at
    zero, a depth x becomes max(x + s, e).
    """
    none, zero = F.array().cast("array<int>"), F.lit(0)
    down = lambda x, k: F.greatest(x + k, zero)

    def fold(values: Column, start: Column, step) -> Column:
        """The state before each value."""
        begin = F.struct(start.alias("x"), none.alias("seen"))
        return F.aggregate(
            values, begin, lambda a, v: F.struct(step(a["x"], v).alias("x"), F.concat(a["seen"], F.array(a["x"])).alias("seen")), lambda a: a["seen"]
        )

    def of_chunks(chunks: Column) -> Column:
        over = lambda x, c: F.greatest(x + F.aggregate(c, zero, lambda a, k: a + k), F.aggregate(c, zero, down))
        starts = fold(chunks, zero, over)
        return F.flatten(F.zip_with(chunks, starts, lambda c, x: fold(c, x, down)))

    def of_steps(ks: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.size(ks), F.lit(CHUNK)), lambda at: F.slice(ks, at, F.lit(CHUNK)))
        return F.when(F.size(ks) > CHUNK, let(cut, of_chunks)).otherwise(fold(ks, zero, down))

    return let(steps, of_steps)


def spans(found: Column | str, tag: str) -> Column:
    """(at, end) of the opening tags of one name, from tokens of all; both are places among them, from 0. Null gives null.

    They serve every selector of that name: kept in a column, they are worked out once for a page.
    """
    found = as_col(found)
    size = F.size(found)
    if tag in RAW or tag in VOID:
        opens = rf"(?i)^<{tag}(?=[\s/>])"
        marks = F.transform(found, lambda t, i: F.when(t.rlike(opens), F.struct(i.alias("at"), (i + 1).alias("end"))))
        return F.array_compact(marks)
    either = rf"(?i)^</?{tag}(?=[\s/>])"
    step = lambda t: F.when(t.startswith("<") & t.rlike(either), F.when(t.startswith("</"), -1).otherwise(1)).otherwise(0)
    marks = F.filter(F.transform(found, lambda t, i: F.struct(i.alias("at"), step(t).alias("step"))), lambda m: m["step"] != 0)

    def ended(order: Column) -> Column:
        """An opening tag ends at what follows it among the tags of its level, if this closes it; a flat one ends at what follows."""
        def span(m: Column, k: Column) -> Column:
            behind = F.get(order, k + 1)
            fits = (behind["level"] == m["level"]) & (F.lit(True) if tag in FLAT else behind["step"] == -1)
            return F.struct(m["at"].alias("at"), F.when(fits, behind["at"]).otherwise(size).alias("end"), m["step"].alias("step"))

        opened = F.filter(F.transform(order, span), lambda s: s["step"] == 1)
        # Not array_sort, which calls a comparing lambda for every pair.
        return F.sort_array(F.transform(opened, lambda s: F.struct(s["at"].alias("at"), s["end"].alias("end"))))

    def levelled(ms: Column) -> Column:
        if tag in FLAT:
            return F.transform(ms, lambda m: F.struct(F.lit(1).alias("level"), m["at"].alias("at"), m["step"].alias("step")))
        depth = _depths(F.transform(ms, lambda m: m["step"]))
        # An opening tag is one level deeper than what it stands in; a closing tag outside any has level 0.
        level = lambda m, d: F.struct(F.when(m["step"] == 1, d + 1).otherwise(d).alias("level"), m["at"].alias("at"), m["step"].alias("step"))
        return F.sort_array(F.filter(F.zip_with(ms, depth, level), lambda m: m["level"] > 0))

    return let(let(marks, levelled), ended)


def select(found: Column | str, selector: str, at: Column | str | None = None) -> Column:
    """Elements that fit a selector, in page order: (opening, inside), the opening tag and the tokens up to its end.

    ``found`` is a column of tokens: a whole page's, or the inside of an element. Null gives null. ``at`` is a column with the ``spans`` of the
    selector's tag, for those who look for many selectors of one.
    """
    what = parse(selector)

    def elements(ts: Column) -> Column:
        def element(s: Column) -> Column:
            opening = F.get(ts, s["at"])
            if what.tag in RAW:
                inside = F.array(F.regexp_extract(opening, rf"(?is)^<[a-z]{_INSIDE}>(.*?)(?:</{what.tag}\s*+>)?\z", 1))
            else:
                inside = F.slice(ts, s["at"] + 2, s["end"] - s["at"] - 1)
            return F.struct(opening.alias("opening"), inside.alias("inside"))

        every = spans(ts, what.tag) if at is None else as_col(at)
        fitting = F.filter(every, lambda s: _fits(F.get(ts, s["at"]), what))
        return F.transform(fitting, element)

    return let(as_col(found), elements)


def _content(element: Column, selector: str) -> Column:
    """The text of an element; that of a raw element is its whole content."""
    if parse(selector).tag in RAW:
        return F.nullif(strip(decoded(F.get(element["inside"], 0))), F.lit(""))
    return text_of(element["inside"])


def select_text(found: Column | str, selector: str, at: Column | str | None = None) -> Column:
    """The text of the first element that fits; null without one, or where it has none."""
    return _content(F.get(select(found, selector, at), 0), selector)


def select_texts(found: Column | str, selector: str, at: Column | str | None = None) -> Column:
    """The texts of all elements that fit, in page order; null for one without text."""
    return F.transform(select(found, selector, at), lambda e: _content(e, selector))


def value_beside(found: Column | str, row: str, header: str, content: str, label: str) -> Column:
    """The content of the first row whose header holds ``label``; null without one."""
    rows = F.filter(select(found, row), lambda r: F.coalesce(F.contains(select_text(r["inside"], header), F.lit(label)), F.lit(False)))
    return select_text(F.get(rows, 0)["inside"], content)
