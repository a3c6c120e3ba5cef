"""Text functions that Spark's own expressions can state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the text format, as it states them: what stands for a secret and how
# secrets look; macros that show their argument, the cell that ends a text, other macros
# and the marks of the markup; what each rewriting rule finds and puts in its place.
HIDDEN = "[REDACTED]"
BEARER = r"""(?i)(Bearer\s+)[^\s"']+"""
AUTHORIZATION = r"(?i)(authorization\s*[:=]\s*(?:bearer\s+)?)[^\s,;]+"
KEY = r"\b(?:sk-|olp_)[A-Za-z0-9._-]{8,}"
SHOWN = ("textbf", "textit", "texttt", "emph", "mbox", "hbox", "underline")
LAST_CELL = r"\\multicolumn\s*\{[^{}]*\}\s*\{[^{}]*\}\s*\{(.*)\}\s*$"
MACRO = r"\\[a-zA-Z@]+\*?"
MARKS = "{}$&#_^~\\"
REGEX_RULES = (
    ("literal_newlines", r"\\n(?=[A-Z\u3400-\u9fff&]|\s*\z)", "\n"),
    ("numeric_backslashes", r"\\\\(?=\d)", r"\\textbackslash{}"),
    ("raw_superscripts", r"(\\handwritten\{[^${}\n]*)(?:\^|\\textasciicircum\{\})(?:\{([^{}\n]+)\}|([A-Za-z0-9]))", r"$1\\textsuperscript{$2$3}"),
    ("metadata_comments", r"(?m)^(\s*)\\%\s+(#(?:VALUE|FIELD)(?:\\)?_[A-Z]+:)", "$1% $2"),
    ("cjk_backslashes", r"\\{1,2}(?=[\u3400-\u9fff\uf900-\ufaff])", r"\\textbackslash{}"),
    ("standalone_newlines", r"(?m)^[ \t]*\\newline[ \t]*(?=$|%[^\n]*$)", r"\\par"),
)
_SPACES = " \t\n\r\f\x0b"


def redact(text: Column, secrets: Sequence[str] = ()) -> Column:
    """Known secrets hidden, longest first, and what follows the word bearer."""
    for secret in sorted(filter(None, secrets), key=len, reverse=True):
        text = F.replace(text, F.lit(secret), F.lit(HIDDEN))
    return F.regexp_replace(text, BEARER, f"$1{HIDDEN}")


def redact_sensitive(text: Column) -> Column:
    """Values of authorization headers hidden, and words that look like keys."""
    return F.regexp_replace(F.regexp_replace(text, AUTHORIZATION, f"$1{HIDDEN}"), KEY, HIDDEN)


def collapsed(text: Column) -> Column:
    """Runs of white space of any kind as one space, none at the ends."""
    return F.btrim(F.regexp_replace(text, r"(?U)\s+", " "))


def _without_shown_macros(text: Column) -> Column:
    """A text whose macros of ``SHOWN`` leave their arguments behind, if these hold no braces.

    Such an argument lies between the last opening and the end of what stands before a
    closing, so the text is taken apart at its closings.
    """
    parts = F.split(text, r"\}", -1)

    def left_of_closing(part: Column) -> Column:
        argument = F.substring_index(part, "{", -1)
        before = F.rtrim(F.left(part, F.length(part) - F.length(argument) - 1), F.lit(_SPACES))
        kept = F.concat(part, F.lit("}"))
        for name in SHOWN:
            macro = "\\" + name
            kept = F.when(F.contains(part, F.lit("{")) & before.endswith(macro), F.concat(F.left(before, F.length(before) - len(macro)), argument)).otherwise(kept)
        return kept

    closed = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), left_of_closing)
    return F.concat(F.array_join(closed, ""), F.element_at(parts, -1))


def tex_to_plain(text: Column) -> Column:
    """Visible words: arguments of text macros, the content of a multicolumn that ends the text, nothing of other macros."""
    shown = _without_shown_macros(F.replace(text, F.lit(r"\SA{}"), F.lit(" ")))
    visible = F.regexp_replace(F.regexp_replace(shown, LAST_CELL, "$1"), MACRO, " ")
    return collapsed(F.translate(visible, MARKS, " " * len(MARKS)))


def slug(plain: Column, longest: int = 40, named: Column | None = None) -> Column:
    """Lower-case ASCII words joined by ``_``, of at most ``longest`` characters.

    A text without such words is named by six digits of the SHA-1 of ``named`` (itself by
    default); an empty one is ``field``.
    """
    named = plain if named is None else named
    words = F.array_join(F.regexp_extract_all(F.lower(plain), F.lit("[a-z0-9]+"), F.lit(0)), "_")
    words = F.when((words == "") & (named != ""), F.concat(F.lit("x"), F.left(F.sha1(named), F.lit(6)))).otherwise(words)
    cut = F.rtrim(F.left(words, F.lit(longest)), F.lit("_"))
    return F.when(cut == "", "field").otherwise(cut)


def is_hashed_slug(name: Column) -> Column:
    """Whether every word of a slug is such a digest."""
    return F.forall(F.split(name, "_"), lambda word: word.rlike(r"\Ax[0-9a-f]{6}\z"))


def code_fence_removed(text: Column) -> Column:
    """The text inside a fence of three backquotes, whose first may name a language."""
    inner = F.btrim(text)
    inner = F.when(inner.startswith("```"), F.regexp_replace(F.substr(inner, F.lit(4)), r"\A[A-Za-z]*\s*", "")).otherwise(inner)
    return F.when(inner.endswith("```"), F.regexp_replace(F.left(inner, F.length(inner) - 3), r"\n\z", "")).otherwise(inner)


def last_chars(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.substr(text, F.length(text) - n + 1, F.lit(n))).otherwise(text)


def last_lines(text: Column, lines: int, chars: int) -> Column:
    """The last lines of a log, then its last characters."""
    parts = F.split(text, "\n", -1)
    return last_chars(F.array_join(F.slice(parts, F.greatest(F.size(parts) - lines + 1, F.lit(1)), lines), "\n"), chars)


def markdown_cell(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("|"), F.lit(r"\|")), F.lit("\n"), F.lit(" "))


def normalize(text: Column) -> tuple[Column, Column]:
    """The text after all rules, and how often each one's pattern was found as it ran."""
    counts = []
    for name, pattern, into in REGEX_RULES:
        counts += [F.lit(name), F.regexp_count(text, F.lit(pattern))]
        text = F.regexp_replace(text, pattern, into)
    return text, F.create_map(*counts)
