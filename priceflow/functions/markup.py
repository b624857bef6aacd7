"""Elements of HTML by nesting depth: Column -> Column, built-in expressions.

A regular expression cannot tell which closing tag ends an element that holds
others of its name.  ``elements`` cuts the markup before every tag of that
name, and one fold over the pieces keeps the running depth: an element ends
where its depth closes, or with the markup.  One pass, in the task that read
the page; nothing is shuffled.  It serves the known containers of the sites;
it is not a parser.

The fold costs many interpreted steps per tag, so markup is first cut by one
possessive pattern, which counts up to ``NESTING`` levels of the name.  An element
that it cannot close (nested deeper, left open, cut off) shows in how its match ends;
then the fold judges that markup whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from priceflow.functions.text import col, text_nodes

OUTSIDE = -1 << 20  # a container level that no page comes back from
NESTING = 6  # levels of elements inside elements of their name that the pattern closes itself
END = r"(?=[\s/>])"  # what ends a tag's name


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def elements(markup: Column | str, name: str, opener: str = "", first: bool = False, keep_tag: bool = False) -> Column:
    """What the outermost ``name`` elements hold, in document order (array<string>).

    Only elements whose opening tag (and what follows it up to the next tag of the
    name) begins with the pattern ``opener`` (without groups) count.  ``first`` stops at the first one;
    ``keep_tag`` keeps the opening tags.
    """
    opener, close = opener or f"<{name}", "</" + name
    start = f"<{name}{END}(?={opener.removeprefix('<' + name)})"
    pattern = _element(start, name, name, keep_tag)

    def inside(m: Column) -> Column:
        start = F.lit(0) if keep_tag else F.instr(m, ">")
        return m.substr(start + 1, F.length(m) - start - len(close))

    def cut(whole: Column) -> Column:
        folded = _folded_elements(whole, name, opener, first, keep_tag)
        closed = _closed_by(whole, close)
        if first:
            return let(F.regexp_extract(whole, pattern, 0), lambda m: (
                F.when(m == "", F.array().cast("array<string>")).when(closed(m), F.array(inside(m))).otherwise(folded)))
        judged = let(F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)), lambda found: (
            F.when(F.forall(found, closed), F.transform(found, inside)).otherwise(folded)))
        # an empty text is an empty element or one that the pattern cannot close
        return let(F.regexp_extract_all(whole, F.lit(pattern), F.lit(1)), lambda found: (
            F.when(F.forall(found, lambda m: m != ""), found).otherwise(judged)))

    return let(col(markup), cut)


def _content(name: str, nesting: int = NESTING, skip: str = "", also: str = "") -> str:
    """Pattern of text, other tags and whole ``name`` elements, with nothing given back;
    ``skip``: names whose tags are not taken, ``also``: one more alternative."""
    inner = rf"|<{name}{END}{_content(name, nesting - 1)}</{name}{END}" if nesting else ""
    return rf"(?:[^<]++|<(?!/?(?:{skip or name})[\s/>]){inner}{also})*+"


def _element(start: str, name: str, stops: str, keep_tag: bool = False) -> str:
    """Pattern of an element from ``start`` (up to its opening tag's name) to '</name'; group 1 is what it
    holds (with its opening tag). Where '</name' does not come, the match ends otherwise, without a group 1.

    Without ``keep_tag`` the pattern begins with the plain text '<name', for which Java skips
    through the markup instead of trying the pattern at every character."""
    tag = rf"(?:[^<>]++|<(?!/?(?:{stops})[\s/>]))*+"
    inside, end = _content(name), f"</{name}{END}"
    if keep_tag:
        return f"(?:({start}{tag}>{inside}){end}|{start}{tag}(?:>{inside})?+<?)"
    return f"{start}{tag}(?:>({inside}){end}|(?:>{inside})?+<?)"


def _closed_by(markup: Column, close: str):
    """Whether a match ends with the closing tag (and not with markup that is cut off in it)."""
    return lambda m: m.endswith(close) & ~markup.endswith(close)


def _folded_elements(markup: Column, name: str, opener: str, first: bool, keep_tag: bool) -> Column:
    """``elements`` by the running depth, for any nesting."""
    # past the text before the first tag; the '<' of every piece is cut off
    pieces = F.split(markup, rf"<(?=/?{name}[\s/>])")

    def state(depth: Column, inner: Column, found: Column) -> Column:
        return F.struct(depth.alias("depth"), inner.alias("inner"), found.alias("found"))

    def step(s: Column, p: Column) -> Column:
        closes = p.startswith("/")
        within = (F.when(closes & (s["depth"] == 1), state(
                      F.lit(0), F.lit(""), F.concat(s["found"], F.array(s["inner"]))))
                  .otherwise(state(s["depth"] + F.when(closes, -1).otherwise(1),
                                   F.concat(s["inner"], F.lit("<"), p), s["found"])))
        begin = F.concat(F.lit("<"), p) if keep_tag else p.substr(F.instr(p, ">") + 1, F.length(p))
        begins = p.rlike("^" + opener[1:])
        if first:
            begins = (F.size(s["found"]) == 0) & begins
        return F.when(s["depth"] > 0, within).when(begins, state(F.lit(1), begin, s["found"])).otherwise(s)

    zero = state(F.lit(0), F.lit(""), F.array().cast("array<string>"))
    return F.aggregate(F.slice(pieces, 2, 1 << 30), zero, step, _closed)


def _closed(s: Column) -> Column:
    """The elements found; one that the markup does not close ends with it."""
    return F.when(s["depth"] > 0, F.concat(s["found"], F.array(s["inner"]))).otherwise(s["found"])


def grandchildren(markup: Column | str, opener: str, child: str, name: str) -> Column:
    """What the ``name`` elements hold that stand right inside a ``child`` of the first
    element that ``opener`` names (itself a ``child``): ``opener / child / name``.

    One fold over the tags of both names: the level counts the children that are
    open; inside an element only its own depth counts.  The pattern goes on where the
    last element ended: right inside a child, past whole children and on to the next one.
    """
    rest = F.coalesce(F.get(F.split(col(markup), opener, 2), F.lit(1)), F.lit(""))
    outside = _content(child, 0)
    right_inside = _content(child, skip=f"{child}|{name}", also=f"|</{name}{END}")
    pattern = (rf"(?:\A{outside}<{child}{END}|\G(?!\A)){right_inside}"
               rf"(?:</{child}{END}{outside}<{child}{END}{right_inside})*+"
               rf"({_element(f'<{name}{END}', name, f'{child}|{name}')}|<(?={child}[\s/>]))")
    close = "</" + name

    def inside(m: Column) -> Column:
        start = F.instr(m, ">")
        return m.substr(start + 1, F.length(m) - start - len(close))

    def judged(markup: Column) -> Column:
        return let(F.regexp_extract_all(markup, F.lit(pattern), F.lit(1)), lambda found: (
            F.when(F.forall(found, _closed_by(markup, close)), F.transform(found, inside))
            .otherwise(_folded_grandchildren(markup, child, name))))

    return let(rest, lambda markup: let(F.regexp_extract_all(markup, F.lit(pattern), F.lit(2)), lambda found: (
        F.when(F.forall(found, lambda m: m != ""), found).otherwise(judged(markup)))))


def _folded_grandchildren(rest: Column, child: str, name: str) -> Column:
    """``grandchildren`` by the running level and depth, for any nesting."""
    pieces = F.split(rest, rf"<(?=/?(?:{child}|{name})[\s/>])")

    def state(level: Column, depth: Column, inner: Column, found: Column) -> Column:
        return F.struct(level.alias("level"), depth.alias("depth"), inner.alias("inner"), found.alias("found"))

    def step(s: Column, p: Column) -> Column:
        longer = F.concat(s["inner"], F.lit("<"), p)
        closes, own = p.startswith("/" + name), p.startswith(name)
        within = (F.when(closes & (s["depth"] == 1), state(
                      s["level"], F.lit(0), F.lit(""), F.concat(s["found"], F.array(s["inner"]))))
                  .otherwise(state(s["level"], s["depth"] + F.when(closes, -1).when(own, 1).otherwise(0), longer,
                                   s["found"])))
        inner = p.substr(F.instr(p, ">") + 1, F.length(p))
        level = (F.when(p.startswith(child), s["level"] + 1)
                 .when(~p.startswith("/" + child), s["level"])
                 .otherwise(F.when(s["level"] == 0, F.lit(OUTSIDE)).otherwise(s["level"] - 1)))
        return (F.when(s["depth"] > 0, within)
                .when(own & (s["level"] == 1), state(s["level"], F.lit(1), inner, s["found"]))
                .otherwise(state(level, F.lit(0), F.lit(""), s["found"])))

    zero = state(F.lit(0), F.lit(0), F.lit(""), F.array().cast("array<string>"))
    return F.aggregate(F.slice(pieces, 2, 1 << 30), zero, step, _closed)


def first_element(markup: Column | str, name: str, opener: str = "") -> Column:
    """What the first such element holds; NULL when there is none."""
    return F.get(elements(markup, name, opener, first=True), F.lit(0))


def element_texts(markups: Column) -> Column:
    """All text nodes of several pieces of markup, in order."""
    return F.flatten(F.transform(markups, text_nodes))


def first_in(markups: Column, pattern: str) -> Column:
    """First match of a pattern's group 1 that is not empty; NULL when none."""
    texts = F.transform(markups, lambda m: F.regexp_extract(m, pattern, 1))
    return F.get(F.filter(texts, lambda t: t != ""), F.lit(0))
