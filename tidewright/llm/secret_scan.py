"""Secret scan: patterns, and the entropy of windows sliding over long strings of one character class.

Only DataFrame functions, and no shuffle: each text is scanned where it lies. Patterns give the base spans.
For the entropy spans, candidates are the runs of a character class that are at least a window long. The
window slides by one character; the counts of its characters and the sum of c * log2(c) change by the character
that enters and the one that leaves. The sums are integers (millionths of a bit), so no rounding decides. The parts of
a candidate between slashes and equals signs that an allow-list pattern matches are left out; the candidate
becomes a span if some window of what is left has enough entropy.

Spans are (start, kind, end) in code points, the end exclusive, ordered by start and then by kind. Defined
results: a null or empty text has no spans; a text of any length is scanned whole; repeated rows give repeated
results; spans of different kinds may overlap; extra columns are ignored (`find_secrets`) or kept (`redact`). The time for a
text grows with its length and its number of matches: places are summed up by blocks of BLOCK matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import free_names

MASK = "[SECRET]"


@dataclass(frozen=True)
class Pattern:
    """A kind of secret. A match counts if the given group has at least `least` characters. `some` matches
    wherever a counting match exists; texts without it are not taken apart."""

    kind: str
    regex: str
    group: int
    least: int
    some: str


#: Greedy runs are the same matches whether the length is asked for in the pattern or after it, so access and hex
#: ask in the pattern. A failing assignment uses up its text, so its length is tested after matching.
PATTERNS = (
    Pattern(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
    ),
    Pattern("access", r"AKIA[A-Z0-9]{14,}", 0, 18, r"AKIA[A-Z0-9]{14}"),
    Pattern("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
)


@dataclass(frozen=True)
class EntropyClass:
    """A character class: its letters, the window, and the bits per character that make a window suspicious.

    A string in which all of `mixed` are found needs `bits`; another one, which may be a path or a long word, needs the
    higher `plain` bits (None: numbers are no keys).
    """

    kind: str
    letters: str
    window: int
    bits: float
    mixed: tuple[str, ...]
    plain: float | None


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    EntropyClass("entropy_hex", _DIGITS + "abcdefABCDEF", 24, 3.0, ("[0-9]", "[A-Fa-f]"), None),
    EntropyClass("entropy_base64", _UPPER + _LOWER + _DIGITS + "+/_=-", 24, 3.75, ("[0-9]", "[A-Z]", "[a-z]"), 4.15),
    EntropyClass("entropy_lower", _LOWER + _DIGITS, 24, 3.75, ("[0-9]", "[g-z]"), 3.85),
    EntropyClass("entropy_upper", _UPPER + _DIGITS, 24, 3.75, ("[0-9]", "[G-Z]"), 3.85),
)

#: Strings of high entropy that are no secrets: UUIDs, runs of the alphabet, and words that mark an example. They are
#: sought in each part of a candidate between these separators.
SEPARATORS = "[/=]"
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)abcdefghijklmnop|0123456789abcdef",
    r"(?i)example|sample|dummy|placeholder|changeme|your_|xxxx",
)
#: Stands for a part that is left out.
_OUT = "~"
#: Matches whose places are summed up together.
BLOCK = 256


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _before(values: Column, combine, start: int = 0) -> Column:
    """For each of an array of ints what the values before it combine to, in blocks: within a block by copying what there
    is so far, between blocks by their totals."""

    def scan(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda x: F.aggregate(x, F.lit(start), combine))

        def placed(t: Column) -> Column:
            def inside(x: Column, b: Column) -> Column:
                base = F.aggregate(F.slice(t, F.lit(1), b), F.lit(start), combine)
                first = F.struct(base.alias("at"), F.array().cast("array<int>").alias("out"))
                step = lambda a, v: F.struct(combine(a["at"], v).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
                return F.aggregate(x, first, step)["out"]

            return F.flatten(F.transform(blocks, inside))

        return _let(totals, placed)

    def cut(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
        return F.when(F.size(v) > 0, _let(blocks, scan)).otherwise(F.array().cast("array<int>"))

    return _let(values, cut)


def _matches(text: Column, regex: str, kind: int, holds) -> Column:
    """Array of (start, kind, end, text) of the matches for which holds(match, position in the list) is true.

    The text between matches gives their places: each starts after all earlier matches and gaps.
    """
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    gaps = F.split(text, regex, -1)

    def place(m: Column) -> Column:
        lengths = F.zip_with(m, F.slice(gaps, F.lit(1), F.size(m)), lambda x, g: F.struct(F.length(g).alias("g"), F.length(x).alias("n"), x.alias("x")))

        def spans_of(v: Column) -> Column:
            ends = _before(F.transform(v, lambda s: s["g"] + s["n"]), lambda a, n: a + n)
            return F.zip_with(
                v,
                ends,
                lambda s, at: F.struct(
                    (at + s["g"]).alias("start"), F.lit(kind).alias("kind"), (at + s["g"] + s["n"]).alias("end"), s["x"].alias("x")
                ),
            )

        return _let(lengths, spans_of)

    return F.filter(_let(found, place), holds)


def _low_sum(codes: Column, letters: int, window: int) -> Column:
    """The least sum of c * log2(c), in millionths, over all windows: entropy is log2(window) minus it / window."""
    sums = F.array(*[F.lit(round(1e6 * c * math.log2(c)) if c else 0) for c in range(window + 2)])

    def put(counts: Column, at: Column, value: Column) -> Column:
        return F.concat(F.slice(counts, F.lit(1), at - 1), F.array(value), F.slice(counts, at + 1, letters))

    def step(a: Column, i: Column) -> Column:
        enters = F.get(codes, i)
        leaves = F.get(codes, i - window)

        def enter(n: Column) -> Column:
            counts = put(a["counts"], enters, n + 1)
            total = a["sum"] + F.get(sums, n + 1) - F.get(sums, n)

            def leave(c: Column) -> Column:
                m = F.get(c, leaves - 1)
                after = _let(m, lambda k: F.struct(put(c, leaves, k - 1).alias("c"), (total + F.get(sums, k - 1) - F.get(sums, k)).alias("s")))
                return F.when(i < window, F.struct(c.alias("c"), total.alias("s"))).otherwise(after)

            return _let(counts, leave)

        return _let(
            _let(F.get(a["counts"], enters - 1), enter),
            lambda b: F.struct(
                b["c"].alias("counts"),
                b["s"].alias("sum"),
                F.when(i >= window - 1, F.least(a["low"], b["s"])).otherwise(a["low"]).alias("low"),
            ),
        )

    start = F.struct(
        F.array_repeat(F.lit(0), letters).alias("counts"), F.lit(0).alias("sum"), F.lit(2**31 - 1).alias("low")
    )
    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)["low"]


def highest_sum(c: EntropyClass, mixed: bool = True) -> int:
    """A window is suspicious if its sum is at most this."""
    bits = c.bits if mixed else c.plain
    return -1 if bits is None else math.floor(1e6 * c.window * (math.log2(c.window) - bits))


def left_over(run: Column) -> Column:
    """The parts of a candidate around those that are allowed; separators become slashes."""

    def part(x: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | F.regexp_like(x, F.lit(pattern))
        return F.when(allowed, F.lit(_OUT)).otherwise(x)

    return F.split(F.array_join(F.transform(F.split(run, SEPARATORS), part), "/"), _OUT)


def _entropy_spans(text: Column, c: EntropyClass, kind: int) -> Column:
    run = "[" + c.letters.replace("-", "") + ("-" if "-" in c.letters else "") + f"]{{{c.window},}}"

    def dense(x: Column) -> Column:
        mixed = F.lit(True)
        for pattern in c.mixed:
            mixed = mixed & F.regexp_like(x, F.lit(pattern))
        most = F.when(mixed, F.lit(highest_sum(c))).otherwise(F.lit(highest_sum(c, False)))
        codes = F.transform(F.split(x, ""), lambda ch: F.instr(F.lit(c.letters), ch))
        low = lambda m: _let(codes, lambda k: F.when(m >= 0, _low_sum(k, len(c.letters), c.window) <= m).otherwise(F.lit(False)))
        return F.when(F.length(x) >= c.window, _let(most, low)).otherwise(F.lit(False))

    return F.when(F.regexp_like(text, F.lit(run)), _matches(text, run, kind, lambda s: F.exists(left_over(s["x"]), dense)))


KINDS = [*(p.kind for p in PATTERNS), *(c.kind for c in CLASSES)]


def _long_enough(p: Pattern):
    """The group that counts is the end of the match, after the first separator."""
    if p.group:
        return lambda s: F.length(F.regexp_extract(s["x"], r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$", 1)) >= p.least
    return lambda s: F.length(s["x"]) >= p.least


def spans(text: Column) -> Column:
    """Sorted array of (start, kind, end, x): kind is the place in KINDS, x the matched text."""
    parts = []
    for k, p in enumerate(PATTERNS):
        parts.append(F.when(F.regexp_like(text, F.lit(p.some)), _matches(text, p.regex, k, _long_enough(p))))
    parts += [_entropy_spans(text, c, len(PATTERNS) + i) for i, c in enumerate(CLASSES)]
    none = F.array().cast("array<struct<start:int,kind:int,end:int,x:string>>")
    return F.sort_array(F.flatten(F.array(*[F.coalesce(p, none) for p in parts])))


def _digest(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    item = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, item), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, found (the spans with their text), and per kind their number."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(id_col, spans(t).alias("found"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select(id_col, "found", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)])


def secret_scan(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The scan's digest: counts of base spans, hash of the base spans, all spans as text."""
    base = F.filter("found", lambda s: s["kind"] < len(PATTERNS))
    return find_secrets(docs, id_col).select(
        id_col,
        *[f"n_{p.kind}" for p in PATTERNS],
        F.sha2(_digest(base), 256).alias("base_sha256"),
        _digest(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns; overlapping spans are joined and each is replaced by MASK. The column with the
    length of the text, if there is one, follows. Texts without spans stay as they are, nulls too."""
    (out,) = free_names(docs, "found")
    t = F.col(text)
    found = docs.withColumn(out, spans(F.coalesce(t, F.lit(""))))
    # What is kept lies between the end that earlier spans reach and the start of a span behind it.
    def rebuilt(chars: Column) -> Column:
        piece = lambda a, b: F.array_join(F.slice(chars, a + 1, b - a), "")

        def joined(reached: Column) -> Column:
            gaps = F.zip_with(out, reached, lambda s, at: F.struct(at.alias("f"), s["start"].alias("t")))
            kept = F.filter(gaps, lambda g: g["t"] >= g["f"])
            end = F.greatest(F.array_max(reached), F.element_at(out, -1)["end"])
            masked = F.transform(kept, lambda k: F.concat(piece(k["f"], k["t"]), F.lit(MASK)))
            return F.concat(F.array_join(masked, ""), piece(end, F.size(chars)))

        return _let(_before(F.transform(out, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), joined)

    clean = F.when(F.size(out) > 0, _let(F.split(t, ""), rebuilt)).otherwise(t)
    found = found.withColumn(text, clean)
    if length and length in docs.columns:
        changed = F.when(F.size(out) > 0, F.length(text).cast(docs.schema[length].dataType))
        found = found.withColumn(length, F.coalesce(changed, F.col(length)))
    return found.drop(out)
