"""Question classification, choice splitting, answer extraction and parsing.

Per-line regexes run over ``split(strip(q), '\\n')`` with higher-order
functions; one multi-line regex would let ``\\s`` cross line breaks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, lines, py_strip

# Option-line pattern, answer marker, fallbacks.
OPTION_LINE = r"(?U)^\s*[1-9][0-9]?\s"
ANSWER_MARKER = "답변:"
NO_ANSWER = "미응답"
NO_CHOICE = "0"
MC_ANSWER = r"(?U)^\D*([1-9][0-9]?)"


def _is_option(line: Column) -> Column:
    return line.rlike(OPTION_LINE)


def option_count(question) -> Column:
    return F.size(F.filter(lines(question), _is_option))


def is_multiple_choice(question) -> Column:
    """At least two lines look like ``<1-99> <text>``."""
    return option_count(question) >= 2


def question_stem(question) -> Column:
    """Non-option lines, each stripped, joined by a space."""
    body = F.filter(lines(question), lambda x: ~_is_option(x))
    return F.array_join(F.transform(body, lambda x: py_strip(x)), " ")


def question_options(question) -> Column:
    """Option lines, each stripped."""
    return F.transform(F.filter(lines(question), _is_option), lambda x: py_strip(x))


def answer_text(generated) -> Column:
    """Text after the last answer marker (all text if none), stripped."""
    g = F.coalesce(_c(generated), F.lit(""))
    return py_strip(F.element_at(F.split(g, ANSWER_MARKER, -1), -1))


def extract_answer(generated, question) -> Column:
    """Final answer string: "미응답" when empty; for multiple choice the
    first 1-2 digit number after leading non-digits (or "0"); else the text."""
    t = answer_text(generated)
    num = F.regexp_extract(t, MC_ANSWER, 1)
    mc = F.when(num == "", F.lit(NO_CHOICE)).otherwise(num)
    return (F.when(t == "", F.lit(NO_ANSWER))
            .when(is_multiple_choice(question), mc)
            .otherwise(t))


def parse_verdict(text, mode: str = "tokens", n_docs: Column | int | None = None) -> Column:
    """0-based indices judged relevant ("T").

    ``tokens``: whitespace-separated tokens equal to "T" (the reference);
    ``chars``: every "T" character once whitespace is removed (``TFT``).
    Indices >= ``n_docs`` are dropped when ``n_docs`` is given.
    """
    t = F.upper(py_strip(F.coalesce(_c(text), F.lit(""))))
    if mode == "tokens":
        parts = F.split(t, r"(?U)\s+", -1)
    elif mode == "chars":
        parts = F.split(F.regexp_replace(t, r"(?U)\s+", ""), "", -1)
    else:
        raise ValueError("mode must be 'tokens' or 'chars'")
    idx = F.transform(parts, lambda x, i: F.when(x == "T", i).otherwise(F.lit(-1)))
    keep = F.filter(idx, lambda i: i >= 0)
    if n_docs is not None:
        n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
        keep = F.filter(keep, lambda i: i < n)
    return keep


def _numeric_order(a: Column, b: Column) -> Column:
    """Order canonical decimal strings numerically (length, then text)."""
    la, lb = F.length(a), F.length(b)
    return (F.when(la < lb, -1).when(la > lb, 1).when(a < b, -1).when(a > b, 1)
            .otherwise(0))


def parse_answer(answer) -> Column:
    """``struct(kind, vals)``: ``single``/``multi`` with the sorted distinct
    integers (canonical decimal strings), or ``str`` with null ``vals``."""
    s = py_strip(_c(answer).cast("string"))
    parts = F.transform(F.split(s, ",", -1), lambda p: py_strip(p))
    numeric = s.isNotNull() & (s != "") & F.forall(parts, lambda p: p.rlike(r"^[0-9]+$"))
    canon = F.transform(parts, lambda p: F.regexp_replace(p, r"^0+(?=[0-9])", ""))
    vals = F.array_sort(F.array_distinct(canon), _numeric_order)
    kind = F.when(~F.coalesce(numeric, F.lit(False)), F.lit("str")) \
            .when(F.size(vals) == 1, F.lit("single")).otherwise(F.lit("multi"))
    return F.struct(kind.alias("kind"),
                    F.when(kind == "str", F.lit(None)).otherwise(vals).alias("vals"))
