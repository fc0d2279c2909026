"""Secret scans: patterns, and windowed entropy over candidate strings.

Patterns find assignments to secret-like names, access keys and long hexadecimal
strings. The entropy scan takes every run of a character class (hexadecimal, base64)
of at least a window's length and slides the window over it: counts per character
are kept up to date as one character enters and one leaves, and the sum of n log2 n
with them, so a step costs no more than the class has characters. Parts that name themselves placeholders are
blanked first. A run whose best window reaches the class's bits is a finding, unless the
allow-list knows the shape of all of it (plain words, joined words, paths, UUIDs, rulers)
or a pattern's span holds it.

Only SQL functions work here. Offsets are code points, ends exclusive. Offsets, merged spans and
masked texts come from running sums and maxima over arrays, so a text with n secrets takes
n log n steps.

Defined results: a null or empty text has no spans; very long texts are scanned whole;
every row stands alone, so repeated rows and empty tables need nothing special; columns
of the input are kept, and a column named like the result replaces it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, and the least length of what they must find.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so shorter ones cannot hide longer ones
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

BASE_KINDS = ("assign", "access", "hex")
#: Class name, its runs, window, least bits in a window.
ENTROPY_CLASSES = (
    ("hex_entropy", r"[0-9A-Fa-f]{20,}", 20, 3.0),
    ("base64_entropy", r"[A-Za-z0-9+/=_-]{20,}", 20, 3.8),
)
ALLOWED = (
    r"^(?!.*[A-Za-z][A-Z])[^0-9]*$",  # lower-case or capitalised words, also joined ones and paths: no digit
    r"^[0-9=_+/-]*$",  # numbers, rulers
    r"^[a-z]+([-_/][a-z]+)*[-_/]?[0-9]{1,4}$",  # a slug that ends in a number
    r"^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",  # UUID
)
#: A part of a run, between = / _ -, that names itself a placeholder.
PLACEHOLDER = r"(?i)(?<![a-z0-9+])[a-z0-9+]*?(?:example|placeholder|changeme|xxxx)[a-z0-9+]*"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate once, use many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Every element combined with all before it, by doubling: each round reaches twice as far back."""
    reaches = F.transform(
        F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int")
    )
    further = lambda held, reach: F.transform(
        held, lambda x, i: F.when(i >= reach, combine(x, F.get(held, i - reach))).otherwise(x)
    )
    return F.when(F.size(values) > 1, F.aggregate(reaches, values, further)).otherwise(values)


def _spans(text: Column, pattern: str, kind: int, keep: Callable[[Column, Column], Column], group: int = 0) -> Column:
    """Spans of the matches that ``keep(match, group)`` accepts.

    The text between matches comes from splitting at the same pattern, so running sums
    of the lengths of gaps and matches give the offsets.
    """

    def located(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        wanted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

        def along(gap: Column, value: Column) -> Column:
            sizes = F.transform(found, lambda match, i: F.length(F.get(gap, i)) + F.length(match))

            def spans(ends: Column) -> Column:
                span = lambda match, i: F.struct(
                    (F.get(ends, i) - F.length(match)).alias("start"), F.lit(kind).alias("kind"), F.get(ends, i).alias("end")
                )
                kept = F.transform(found, lambda match, i: F.when(keep(match, F.get(value, i)), span(match, i)))
                return F.filter(kept, lambda s: s.isNotNull())

            return _let(sizes, lambda s: _let(_running(s, lambda a, b: a + b), spans))

        return F.when(F.size(found) == 0, F.array().cast(_SPAN)).otherwise(
            _let(F.struct(gaps.alias("g"), wanted.alias("w")), lambda pair: along(pair["g"], pair["w"]))
        )

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def best_window_bits(candidate: Column, window: int) -> Column:
    """Largest Shannon entropy, in bits per character, of any window of the candidate."""
    weight = lambda n: F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))

    def change(state: Column, char: Column, by: int) -> Column:
        count = F.coalesce(F.try_element_at(state["n"], char), F.lit(0))

        def apply(old: Column) -> Column:
            others = F.map_filter(state["n"], lambda k, _: k != char)
            return F.struct(
                F.map_concat(others, F.create_map(char, old + F.lit(by))).alias("n"),
                (state["s"] - weight(old) + weight(old + F.lit(by))).alias("s"),
                state["best"].alias("best"),
            )

        return _let(count, apply)

    def slide(chars: Column) -> Column:
        start = F.struct(
            F.create_map().cast("map<string,int>").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best")
        )

        def step(state: Column, i: Column) -> Column:
            entered = change(state, F.get(chars, i), 1)
            left = _let(entered, lambda e: F.when(i >= window, change(e, F.get(chars, i - window), -1)).otherwise(e))
            bits = lambda s: F.log2(F.lit(float(window))) - s["s"] / F.lit(float(window))
            return _let(
                left,
                lambda s: F.struct(
                    s["n"].alias("n"),
                    s["s"].alias("s"),
                    F.when(i >= window - 1, F.greatest(s["best"], bits(s))).otherwise(s["best"]).alias("best"),
                ),
            )

        slid = F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step, lambda s: s["best"])
        return F.when(F.size(chars) >= window, slid).otherwise(F.lit(0.0))

    return _let(F.filter(F.split(candidate, ""), lambda c: c != ""), slide)


def _is_allowed(candidate: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    return allowed


def _is_secret(candidate: Column, window: int, bits: float) -> Column:
    """Whether a window outside placeholders reaches the bits, in a run of no known shape.

    A blanked part is as long as a window, so no window spans it.
    """
    rest = F.regexp_replace(candidate, F.lit(PLACEHOLDER), F.lit("=" * window))
    return _let(rest, lambda r: ~_is_allowed(r) & (best_window_bits(r, window) >= F.lit(bits)))


def find_secrets(docs: DataFrame, text_column: str = "text", column: str = "secret_spans") -> DataFrame:
    """Add the spans of every text: array of (start, kind, end), ordered; kinds number BASE_KINDS, then the entropy classes."""
    true = lambda match, value: F.lit(True)

    def scan(text: Column) -> Column:
        return F.concat(
            _spans(text, ASSIGN, 0, lambda match, value: F.length(value) >= ASSIGN_VALUE, group=2),
            _spans(text, ACCESS, 1, lambda match, value: F.length(match) >= ACCESS_LENGTH),
            _spans(text, HEX, 2, true),
            *[
                _spans(text, runs, len(BASE_KINDS) + k, lambda match, value, w=window, b=bits: _is_secret(match, w, b))
                for k, (_, runs, window, bits) in enumerate(ENTROPY_CLASSES)
            ],
        )

    def without_inner(spans: Column) -> Column:
        """Base spans come first where starts are equal, so the furthest base end so far tells whether one holds a span."""
        ends = F.transform(spans, lambda s: F.when(s["kind"] < len(BASE_KINDS), s["end"]).otherwise(F.lit(0)))
        return _let(
            _running(ends, F.greatest),
            lambda furthest: F.filter(spans, lambda s, i: (s["kind"] < len(BASE_KINDS)) | (s["end"] > F.get(furthest, i))),
        )

    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    found = _let(text, lambda t: _let(F.array_sort(scan(t)), without_inner))
    return docs.select(*[docs[c] for c in docs.columns if c != column], found.alias(column))


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < len(BASE_KINDS))


def printed(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*[F.lit(n) for n in BASE_KINDS + tuple(n for n, *_ in ENTROPY_CLASSES)])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones merged, replaced by the mark; null stays null."""

    def cut(wide: Column) -> Column:
        """Code points are four bytes wide, so a piece is reached at once."""

        def piece(start: Column, size: Column) -> Column:
            return F.decode(F.substring(wide, start * 4 + 1, size * 4), "UTF-32")

        def pieces(furthest: Column) -> Column:
            """Before every span that starts behind all before it: what lies between, and the mark."""
            past = lambda i: F.when(i > 0, F.get(furthest, i - 1)).otherwise(F.lit(0))
            marked = lambda s, i: F.when(
                s["start"] >= past(i), F.concat(piece(past(i), s["start"] - past(i)), F.lit(mark))
            )
            last = F.element_at(furthest, -1)
            return F.concat(F.array_join(F.transform(spans, marked), ""), piece(last, F.octet_length(wide)))

        return _let(_running(F.transform(spans, lambda s: s["end"]), F.greatest), pieces)

    return F.when(F.size(spans) > 0, _let(F.encode(text, "UTF-32"), cut)).otherwise(text)
