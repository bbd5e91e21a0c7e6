"""Text cleaning as Column expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_all(c: ColumnLike, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, replacement)


def replace_first(c: ColumnLike, pattern: str, replacement: str) -> Column:
    """Replace only the first match. ``pattern`` must not hold capturing groups of its own."""
    return F.regexp_replace(as_col(c), rf"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def remove_all(c: ColumnLike, pattern: str) -> Column:
    return replace_all(c, pattern, "")


def recode_chain(c: ColumnLike, steps: Iterable[tuple[str, str]]) -> Column:
    """Substring replacements applied one after the other.

    A later step sees the text an earlier one made, so the order is part of the rule and this must
    not be turned into a map lookup.
    """
    out = as_col(c)
    for pattern, replacement in steps:
        out = replace_all(out, pattern, replacement)
    return out


def trim_text(c: ColumnLike, side: str = "both") -> Column:
    return {"both": F.trim, "left": F.ltrim, "right": F.rtrim}[side](as_col(c))


def squeeze(c: ColumnLike) -> Column:
    """Runs of white space become one blank; line breaks count as white space."""
    return replace_all(c, r"\s+", " ")


def strip_breaks(c: ColumnLike) -> Column:
    return remove_all(c, r"\r\n")


def sub_text(c: ColumnLike, start: int, end: int | None = None) -> Column:
    """Characters ``start``..``end``, counted from 1, both kept; a negative start counts from the end."""
    c = as_col(c)
    if start < 0:
        if end is not None:
            raise ValueError("an end position needs a positive start")
        return F.right(c, F.lit(-start))
    length = F.length(c) if end is None else F.lit(max(end - start + 1, 0))
    return F.substring(c, F.lit(start), length)


def concat_key(cols: Sequence[ColumnLike], sep: str = "_") -> Column:
    """Join values into one text key. A NULL part becomes the text ``nan`` so the key is never NULL."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("nan")) for c in cols])


def title_case(c: ColumnLike) -> Column:
    """Every word with a capital; a word starts after a blank and after a hyphen."""
    words = F.initcap(F.replace(F.lower(as_col(c)), F.lit("-"), F.lit("- ")))
    return F.replace(words, F.lit("- "), F.lit("-"))


def wrap_text(c: ColumnLike, width: int) -> Column:
    """Greedy line fill: a word goes to a new line when the current one would grow past ``width``."""

    def add(acc: Column, word: Column) -> Column:
        last = F.element_at(F.split(acc, "\n"), -1)
        fits = F.length(last) + 1 + F.length(word) <= width
        return F.concat(acc, F.when(fits, F.lit(" ")).otherwise(F.lit("\n")), word)

    words = F.split(F.trim(squeeze(c)), " ")
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.aggregate(rest, F.get(words, F.lit(0)), add)


def _given(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def wrap_balanced(c: ColumnLike, width: int) -> Column:
    """Lines of at most ``width`` characters that are as even as can be.

    Of all ways to break between words the one is taken whose lines but the last leave the least squared room; of equal
    ones that with fewer lines, then that whose last line, next to last line and so on begin earlier. A word longer than
    ``width`` is a line of its own. Blank runs count as one blank; NULL stays NULL, an empty text is empty.

    For every number of leading words the best last break is kept (``best``), from one word to all; then the breaks are
    followed back from the end. Labels are short, and the work grows with the square of their words.
    """
    words = F.split(F.trim(squeeze(c)), " ")
    start = F.array(F.struct(F.lit(0).alias("cost"), F.lit(0).alias("lines"), F.lit(0).alias("at")))

    def ends(w: Column) -> Column:
        """Where each word would end in one long line, each with a blank behind it."""
        return F.aggregate(w, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x) + 1)))

    def last_break(best: Column, upto: Column, i: Column) -> Column:
        def ending(before: Column, j: Column) -> Column:
            size = F.get(upto, i) - F.get(upto, j) - 1
            room = F.when(i == F.size(upto) - 1, 0).otherwise(F.greatest(F.lit(width) - size, F.lit(0)))
            step = F.struct((before["cost"] + room * room).alias("cost"), (before["lines"] + 1).alias("lines"), j.alias("at"))
            return F.when((size <= width) | (i - j == 1), step)

        return F.array_min(F.transform(best, ending))  # NULL is never the least

    def breaks(upto: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(upto) - 1)
        return F.aggregate(steps, start, lambda best, i: F.concat(best, F.array(last_break(best, upto, i))))

    def lines(w: Column, best: Column) -> Column:
        def back(state: Column, _: Column) -> Column:
            at = F.get(best, state["at"])["at"]
            line = F.array_join(F.slice(w, at + 1, state["at"] - at), " ")
            text = F.when(state["at"] == F.size(w), line).otherwise(F.concat(line, F.lit("\n"), state["text"]))
            return F.when(state["at"] > 0, F.struct(at.alias("at"), text.alias("text"))).otherwise(state)

        return F.aggregate(w, F.struct(F.size(w).alias("at"), F.lit("").alias("text")), back)["text"]

    return _given(words, lambda w: _given(_given(ends(w), breaks), lambda best: lines(w, best)))


def strip_part_suffix(c: ColumnLike) -> Column:
    """``Auburn (part)`` -> ``Auburn``: a place that lies in several areas."""
    return replace_first(c, r" \(part\)", "")


def matches_any(c: ColumnLike, patterns: Sequence[str]) -> Column:
    return as_col(c).rlike("|".join(f"(?:{p})" for p in patterns))
