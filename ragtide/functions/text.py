"""Scalar text expressions (JVM-side, whole-stage codegen friendly).

Every function returns a ``Column`` so it composes in ``select``/``filter``
and inside other expressions. Python string semantics the reference relies on
(Unicode ``\\w``, ``str.strip``) are re-expressed with Java regex classes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Python's Unicode ``\w`` == letters, numbers and underscore.
WORD_PATTERN = r"([\p{L}\p{N}_]+)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (also inside lambdas,
    where an inlined expression would run again for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def runs(values: Column) -> Column:
    """``[(value, n), ...]``: distinct elements of an array with their counts, in
    order. One sort, then each element meets its left neighbour once."""
    def counted(s):
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                         lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(first, lambda at: F.transform(at, lambda a, k: F.struct(
            F.get(s, a).alias("value"), (F.coalesce(F.get(at, k + 1), F.size(s)) - a).alias("n"))))

    return let(F.sort_array(values), lambda s: F.when(F.size(s) > 0, counted(s)))


def tokenize(text) -> Column:
    """Lower-case, then every maximal run of Unicode word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))),
                                F.lit(WORD_PATTERN), 1)


def index_text(title, text) -> Column:
    """Text that gets indexed: ``title + " " + text`` (missing parts are "")."""
    return F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "),
                    F.coalesce(_c(text), F.lit("")))


def py_strip(text) -> Column:
    """``str.strip()``: drop leading and trailing Unicode whitespace."""
    return F.regexp_replace(F.regexp_replace(_c(text), r"(?U)^\s+", ""), r"(?U)\s+$", "")


def pick_text(*cols) -> Column:
    """First non-empty of the given fields, else ""."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols], F.lit(""))


def child_id(law_key, start, end) -> Column:
    """Composite child id ``law_key:start:end`` (a missing key prints as None)."""
    return F.concat_ws(":", F.coalesce(_c(law_key), F.lit("None")),
                       _c(start).cast("string"), _c(end).cast("string"))


def preview(text, n: int = 900) -> Column:
    """Newlines become spaces, then the first ``n`` characters."""
    return F.substring(F.translate(F.coalesce(_c(text), F.lit("")), "\n", " "), 1, n)


def format_query(text) -> Column:
    return F.concat(F.lit("Query: "), _c(text))


def format_doc(title, text) -> Column:
    return F.concat(F.lit("Title: "), _c(title), F.lit("\nText: "), _c(text))


def as_py_str(c) -> Column:
    """How an f-string prints a value: missing values print as ``None``."""
    return F.coalesce(_c(c).cast("string"), F.lit("None"))


def compose_question(question, options=("A", "B", "C", "D", "E")) -> Column:
    """Question followed by ``A. …`` … ``E. …`` lines."""
    parts = [as_py_str(question)]
    for o in options:
        parts.append(F.concat(F.lit(f"{o}. "), as_py_str(o)))
    return F.concat_ws("\n", *parts)


def lines(text) -> Column:
    """``text.strip().split("\\n")``."""
    return F.split(py_strip(F.coalesce(_c(text), F.lit(""))), "\n", -1)
