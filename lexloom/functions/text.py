"""String columns: stripping, splitting, templates, lines, display forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.split() and str.strip() treat as space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The separators that Python's str.splitlines() breaks on.
LINE_BREAKS = r"[\n\r\x{b}\x{c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
# Java's Unicode white space lacks four of the characters above.
SPACE_RUN = r"(?U)[\s\x{1c}-\x{1f}]+"
LETTER_RUN = r"(\p{L}+)"
LEADING_SPACE_MARK = "Ġ"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Drop every kind of space at both ends (``trim`` would drop U+0020 only)."""
    return F.btrim(_col(c), F.lit(SPACE_CHARS))


def ws_tokens(c: Column | str) -> Column:
    """Whitespace-separated tokens; empty array for blank text, null for null."""
    return F.array_remove(F.split(strip(c), SPACE_RUN, -1), "")


def letter_tokens(c: Column | str) -> Column:
    """Runs of letters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(LETTER_RUN), F.lit(1))


def char_tokens(c: Column | str) -> Column:
    """One token per character, newlines included."""
    return F.regexp_extract_all(_col(c), F.lit(r"(?s)(.)"), F.lit(1))


def split_fields(c: Column | str, sep: str) -> Column:
    """Split on a literal separator; trailing empty fields stay."""
    return F.split(_col(c), r"\Q" + sep + r"\E", -1)


def fill_template(template: str, slots: dict[str, Column | str]) -> Column:
    """Put column values into a prompt template; slots are literal text, never patterns.

    The template is cut at the slot names first, so a value that itself contains a slot
    name is left alone.
    """
    parts: list[str | Column] = [template]
    for slot, value in slots.items():
        cut: list[str | Column] = []
        for part in parts:
            if not isinstance(part, str):
                cut.append(part)
                continue
            pieces = part.split(slot)
            cut.append(pieces[0])
            for piece in pieces[1:]:
                cut += [_col(value), piece]
        parts = cut
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def with_prefix(prefix: str, c: Column | str) -> Column:
    """Prompt text in front of a column; null text stays null."""
    return F.concat(F.lit(prefix), _col(c))


def drop_blank_lines(c: Column | str) -> Column:
    """Keep lines that show something, with their own indent, joined by newlines.

    Splitting a CRLF in two only adds a blank line, which is dropped.
    """
    lines = F.split(_col(c), LINE_BREAKS, -1)
    return F.array_join(F.filter(lines, lambda line: strip(line) != ""), "\n")


def clip_text(c: Column | str, n: int) -> Column:
    """The first ``n`` characters (not bytes)."""
    return F.substring(_col(c), 1, n)


def n_chars(c: Column | str) -> Column:
    return F.char_length(_col(c))


def mark_leading_space(tokens: Column | str) -> Column:
    """Show the space in front of every token but the first as a marker character."""
    mark = F.lit(LEADING_SPACE_MARK)
    return F.transform(_col(tokens), lambda t, i: F.when(i == 0, t).otherwise(F.concat(mark, t)))


def describe_item(key: Column | str, artist: Column | str, title: Column | str) -> Column:
    """One display line per item; a missing artist or title shows as empty text."""
    blank = F.lit("")
    return F.format_string(
        "id: %s - artist: %s - title: %s",
        _col(key),
        F.coalesce(_col(artist), blank),
        F.coalesce(_col(title), blank),
    )


def pick_field(c: Column | str, sep: str, index: int, inner: str = ": ") -> Column:
    """The value of the ``index``-th ``name: value`` field (0-based) of a display line.

    A value that itself holds a separator is cut there: use real columns where they exist.
    """
    field = F.split_part(_col(c), F.lit(sep), F.lit(index + 1))
    return F.split_part(field, F.lit(inner), F.lit(2))


def show_token(c: Column | str) -> Column:
    """A token between quotes with backslashes, newlines and tabs made visible."""
    raw = _col(c)
    body = F.replace(raw, F.lit("\\"), F.lit("\\\\"))
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(shown))
    has_single, has_double = F.contains(raw, F.lit("'")), F.contains(raw, F.lit('"'))
    single, double = F.lit("'"), F.lit('"')
    return (
        F.when(has_single & ~has_double, F.concat(double, body, double))
        .when(has_single, F.concat(single, F.replace(body, single, F.lit("\\'")), single))
        .otherwise(F.concat(single, body, single))
    )


def fmt_prob(c: Column | str) -> Column:
    """A probability as a percentage with two decimals."""
    return F.format_string("%.2f", _col(c) * 100)


def fmt_score(c: Column | str, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", _col(c))


def pad_right(c: Column | str, width: int) -> Column:
    """Left-aligned cell; longer values are kept whole, as ``rpad`` alone would not."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    return F.rpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def pad_left(c: Column | str, width: int) -> Column:
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))
