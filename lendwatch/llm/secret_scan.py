"""Secret scan: three fixed patterns plus sliding-window entropy, in SQL functions only.

Spans are found without Python: ``split`` by a pattern gives the gaps, ``regexp_extract_all``
the matches, and their running lengths the positions (in code points). Nothing is shuffled; a
document is one row from scan to result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three base patterns of the contract, in the order of their kinds.
ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
    "([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{14,}"  # a run from the first AKIA on; shorter runs fail wherever they start
HEX = "(?<![0-9a-f])[0-9a-f]{16,}"  # a whole run; equal to dropping short runs
ASSIGN_VALUE_CHARS = 12
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}"
# Never secrets by themselves: words, dates, numbers and what separators join of them (no letter beside
# a digit, no plus sign), UUIDs, and samples that say so at their end.
ALLOWED = (
    "^(?!.*(?:[A-Za-z][0-9]|[0-9][A-Za-z]|[+]))"
    "|^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$"
    "|(?i:example|sample|placeholder|dummy)$"
)
BLOCK = 256  # matches whose positions are summed at a time, so that many matches stay linear


@dataclass(frozen=True)
class EntropyRule:
    """A window slides over candidates; it is hot above the limit of its character class.

    ``classes`` are (pattern, bits), the first that matches a candidate counts; ``hex_bits`` and
    ``token_bits`` hold for candidates of no class.
    """

    window: int = 20
    hex_bits: float = 3.0
    token_bits: float = 3.9
    classes: tuple[tuple[str, float], ...] = ()


# What op4 and the pipeline use. A random string of the class is above the limit in 99 of 100
# windows: 1 % quantiles of 200,000 random windows of 16, 36, 32, 62 and 64 symbols, rounded down.
BY_CLASS = EntropyRule(
    classes=(
        ("^[0-9A-Fa-f]+$", 2.9),
        ("^[a-z0-9]+$", 3.4),
        ("^[A-Z0-9]+$", 3.34),
        ("^[A-Za-z0-9]+$", 3.64),
        ("^", 3.64),
    )
)


def _pieces(text: Column, pattern: str, groups: int) -> Column:
    """Gaps' lengths and matches of ``pattern``; ``v`` is the match or its group ``groups``."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(groups)) if groups else whole
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.transform(
        F.arrays_zip(gaps.alias("g"), whole.alias("m"), value.alias("v")),
        lambda x: F.struct(x["g"].alias("g"), F.length(x["m"]).alias("n"), x["v"].alias("v")),
    )
    none = F.array().cast("array<struct<g:int,n:int,v:string>>")
    return F.when(text.rlike(pattern), F.filter(found, lambda x: x["n"].isNotNull())).otherwise(none)


def _placed(pieces: str) -> str:
    """SQL: ``pieces`` (gap, length, value) to spans (s, e, v), block after block."""
    within = (
        "aggregate(b, named_struct('p', {at}, 'o', cast(array() as array<struct<s:bigint,e:bigint,v:string>>)), "
        "(a, x) -> named_struct('p', a.p + x.g + x.n, 'o', concat(a.o, array("
        "named_struct('s', a.p + x.g, 'e', a.p + x.g + x.n, 'v', x.v)))), a -> a.o)"
    )
    blocks = (
        f"transform(sequence(0, cast((size({pieces}) - 1) div {BLOCK} as int)), "
        f"i -> slice({pieces}, i * {BLOCK} + 1, {BLOCK}))"
    )
    total = "aggregate(b, 0L, (t, x) -> t + x.g + x.n)"
    folded = (
        f"aggregate({blocks}, named_struct('p', 0L, "
        "'o', cast(array() as array<array<struct<s:bigint,e:bigint,v:string>>>)), "
        f"(z, b) -> named_struct('p', z.p + {total}, 'o', concat(z.o, array({within.format(at='z.p')}))), "
        "z -> flatten(z.o))"
    )
    empty = "cast(array() as array<struct<s:bigint,e:bigint,v:string>>)"
    return f"case when size({pieces}) = 0 then {empty} else {folded} end"


def _hot_windows(rule: EntropyRule, candidates: str) -> str:
    """SQL: candidates (s, e, v) to the stretch their hot windows cover, NULL where none is hot.

    Counts change by one character in and one out a step. With ``f(c) = c log2 c`` the entropy of
    a window is ``log2 w - sum f(c) / w``, so each step only adds four terms. A state holds the
    steps so far, the counts, the sum, and the first start and last end of a hot window.
    """
    w = rule.window
    table = ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(w + 1))
    codes = f"transform(split(x.v, ''), c -> cast(instr('{ALPHABET}', c) as int))"
    steps = f"filter(arrays_zip({codes}, concat(array_repeat(0, {w}), {codes})), p -> p.`0` is not null)"

    def f(count: str) -> str:
        return f"element_at(array({table}), {count} + 1)"

    come, go = "element_at(t.k, p.`0`)", "element_at(t.k, p.`1`)"
    leaving = f"case when p.`1` = 0 then 0D else {f(go)} - {f(go + ' - 1')} end"
    new_sum = f"case when p.`0` = p.`1` then t.s else t.s + {f(come + ' + 1')} - {f(come)} - {leaving} end"
    counts = (
        "case when p.`0` = p.`1` then t.k else transform(t.k, (v, j) -> "
        "v + cast(j + 1 = p.`0` as int) - cast(j + 1 = p.`1` as int)) end"
    )
    classes = (*rule.classes, ("^[0-9A-Fa-f]+$", rule.hex_bits))
    limits = " ".join(f"when x.v rlike '{pattern}' then {bits!r}D" for pattern, bits in classes)
    limit = f"case {limits} else {rule.token_bits!r}D end"
    is_hot = f"t.n + 1 >= {w} and {math.log2(w)!r}D - s / {w} >= {limit} - 1e-9D"
    step = (
        f"named_struct('n', t.n + 1, 'k', {counts}, 's', s, "
        f"'a', case when t.a is null and {is_hot} then t.n + 1 - {w} else t.a end, "
        f"'z', case when {is_hot} then t.n + 1 else t.z end)"
    )
    start = (
        f"named_struct('n', 0, 'k', array_repeat(0, {len(ALPHABET)}), 's', 0D, "
        "'a', cast(null as int), 'z', cast(null as int))"
    )
    return (
        f"transform({candidates}, x -> aggregate({steps}, {start}, "
        # The inner transform of one element names the new sum, so that it is computed once.
        f"(t, p) -> element_at(transform(array({new_sum}), s -> {step}), 1), "
        "t -> case when t.a is not null then named_struct('s', x.s + t.a, 'e', x.s + t.z, 'v', x.v) end))"
    )


def find_secrets(docs: DataFrame, rule: EntropyRule = BY_CLASS) -> DataFrame:
    """Add ``base_spans`` and ``spans`` (kind ``k`` as its place in KINDS, start ``s``, end ``e``).

    Both are ordered by start, then kind; positions are code points, ends exclusive. A NULL or
    empty text has none. Every row is kept as it is, repeated ids included; the two added columns
    replace columns of the same name. Allow-listed candidates lose only their entropy span.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.struct(
        _pieces(text, ASSIGN, 2).alias("assign"),
        _pieces(text, ACCESS, 0).alias("access"),
        _pieces(text, HEX, 0).alias("hex"),
        _pieces(text, CANDIDATE % rule.window, 0).alias("token"),
    )
    kept = [c for c in docs.columns if c not in ("base_spans", "spans")]
    # A generator of one row: the patterns above it run once, whatever is read from them below.
    once = docs.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.array(found)).alias("__f"))

    def spans(kind: int, places: Column) -> Column:
        return F.transform(
            places, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e"))
        )

    placed = once.select(
        *[F.col(f"`{c}`") for c in kept],
        F.explode(
            F.array(F.struct(*[F.expr(_placed(f"__f.{n}")).alias(n) for n in ("assign", "access", "hex", "token")]))
        ).alias("__p"),
    )
    assign = F.filter("__p.assign", lambda x: F.length(x["v"]) >= ASSIGN_VALUE_CHARS)
    base = F.array_sort(F.concat(spans(0, assign), spans(1, F.col("__p.access")), spans(2, F.col("__p.hex"))))
    candidates = F.filter("__p.token", lambda x: ~x["v"].rlike(ALLOWED))
    told = placed.select(
        *[F.col(f"`{c}`") for c in kept],
        F.explode(F.array(F.struct(base.alias("b"), candidates.alias("c")))).alias("__t"),
    )
    hot = F.expr(f"filter({_hot_windows(rule, '__t.c')}, x -> x is not null)")
    return told.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__t.b").alias("base_spans"),
        F.array_sort(F.concat("__t.b", spans(3, hot))).alias("spans"),
    )


def span_string(spans: str) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))),
        ",",
    )


def redact(docs: DataFrame, rule: EntropyRule = BY_CLASS, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every span replaced by ``mark``; overlapping spans by one mark.

    ``n_chars`` follows the new text. Texts without a span, NULL included, are unchanged.
    """
    found = find_secrets(docs, rule)
    # The spans are ordered by start: the text up to a span, from the furthest end so far.
    rebuilt = F.expr(
        "aggregate(spans, named_struct('p', 0L, 'o', ''), (a, x) -> named_struct("
        "'p', greatest(a.p, x.e), 'o', case when x.s < a.p then a.o else "
        f"concat(a.o, substring(text, cast(a.p + 1 as int), cast(x.s - a.p as int)), '{mark}') end), "
        "a -> concat(a.o, substring(text, cast(a.p + 1 as int))))"
    )
    hit = F.size("spans") > 0
    changed = found.withColumn("text", F.when(hit, rebuilt).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn(
            "n_chars", F.when(hit, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
        )
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def scan_report(docs: DataFrame, rule: EntropyRule = BY_CLASS) -> DataFrame:
    """One row per document: counts by base kind, digest of the base spans, all spans."""
    found = find_secrets(docs.select("doc_id", "text"), rule)

    def count(kind: int) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["k"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(span_string("base_spans"), 256).alias("base_sha256"),
        span_string("spans").alias("spans"),
    )
