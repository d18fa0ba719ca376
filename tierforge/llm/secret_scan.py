"""Secret detection with multipart credential linking, in DataFrame expressions only.

Certain patterns are reported as they are. Weak candidates (an identifier, a short or oddly
named secret) are reported only where a complementary part lies within their scope: the
intervals, widened by ``reach`` code points, are joined by overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import bind, located, require, running, table, text_or_empty

# The base patterns.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}

# A run that is long enough is found at its start, so the lengths can be asked for at once.
_ACCESS_LONG, _HEX_LONG = r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}"

# Parts that count only together. Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "secret", "ident", "endpoint")
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
WEAK = {
    "secret": r"(?i)(?<![A-Za-z0-9_])(?:pwd|passphrase|pass|auth|credentials?|private_?key|signing_?key|signature|sig|pin|client_?secret)"
    + _VALUE + r"[A-Za-z0-9+/_.=~-]{6,}",
    "ident": r"(?i)(?<![A-Za-z0-9_])(?:access_?key(?:_?id)?|client_?id|user(?:_?(?:name|id))?|login|account(?:_?id)?|tenant_?id|app_?id)"
    + _VALUE + r"[A-Za-z0-9@._+-]{4,}",
    "endpoint": r"(?i)(?<![A-Za-z0-9_])(?:(?:https?|ftp|jdbc:[a-z0-9]+|mongodb(?:\+srv)?|postgres(?:ql)?|mysql|redis|amqps?|ldaps?|s3)"
    r"""://[^\s"'<>]+|(?:host|server|endpoint)""" + _VALUE + r"[A-Za-z0-9.:/_-]{3,})",
}

# Whether a weak part needs one of these kinds nearby; an endpoint is never reported itself.
PARTNERS = {
    "secret": ("access", "ident", "endpoint"),
    "ident": ("assign", "hex", "secret"),
}

_SPAN = "struct<start:bigint,rank:int,end:bigint>"
_SPANS = f"array<{_SPAN}>"


def _length(text: Column) -> Column:
    return F.length(text).cast("bigint")


def _found(text: Column, kind: str, regex: str, keep=None, gate: Column | None = None) -> Column:
    """Spans of ``kind``; the search for places runs only where the pattern occurs at all."""
    spans = located(text, F.lit(regex), _length)
    if keep is not None:
        spans = F.filter(spans, keep)
    rank = F.lit(KINDS.index(kind))
    spans = F.transform(spans, lambda s: F.struct(s.start.alias("start"), rank.alias("rank"), s.end.alias("end")))
    occurs = text.rlike(regex) if gate is None else gate & text.rlike(regex)
    return F.when(occurs, spans).otherwise(F.array().cast(_SPANS))


def _assigned(match: Column) -> Column:
    """Length of the value in an assignment."""
    return F.length(F.call_function("regexp_extract", match.text, F.lit(ASSIGN), F.lit(2)))


def _is(span: Column, kinds: tuple[str, ...]) -> Column:
    return span["rank"].isin([KINDS.index(kind) for kind in kinds])


def _of(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda span: _is(span, kinds))


def _distinct(spans: Column) -> Column:
    """Sorted, each once."""
    return bind(F.array_sort(spans), lambda s: F.filter(s, lambda span, i: (i == 0) | (span != F.get(s, i - 1))))


def _after(weak: Column, partners: Column, reach: int, place, edge) -> Column:
    """Weak parts whose ``edge`` lies less than ``reach`` after a partner's ``place``, or on it; one sweep over both, sorted."""
    event = lambda at, span: F.struct(at.alias("at"), span.isNotNull().alias("weak"), span.alias("span"))
    none = F.lit(None).cast(_SPAN)
    events = F.concat(
        F.transform(partners, lambda p: event(place(p), none)), F.transform(weak, lambda w: event(edge(w), w))
    )

    def swept(e: Column) -> Column:
        # The greatest of nulls and places is the last place so far.
        place_of = lambda one: F.when(~one.weak, one.at)
        last = running(e, place_of, lambda a, b: F.greatest(a, b), F.lit(None).cast("bigint"))
        close = lambda one, place: F.when(one.weak & (one.at - place < reach), one.span)
        return F.filter(F.zip_with(e, last, close), lambda span: span.isNotNull())

    return bind(F.array_sort(events), swept)


def _linked(parts: Column, reach: int) -> Column:
    """The weak parts with a partner that does not overlap them, less than ``reach`` before or behind."""
    near = []
    for kind, with_ in PARTNERS.items():
        weak, partners = _of(parts, (kind,)), _of(parts, with_)
        near.append(_after(weak, partners, reach, lambda p: p.end, lambda w: w.start))
        near.append(_after(weak, partners, reach, lambda p: -p.start, lambda w: -w.end))
    return F.flatten(F.array(*near))


def scan_secrets(docs: DataFrame, *, text_col: str = "text", reach: int = 200) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` added (columns of those names are replaced).

    Both are arrays of ``kind``, ``start``, ``end`` (code points, end exclusive) by start, then
    by ``KINDS``; ``spans`` also has the linked weak parts. Null counts as
    empty; such texts have no spans. Rows stay rows and nothing is shuffled, so repeated
    rows, null ids and hot keys need no care; whole texts are searched, whatever their length.
    A text's cost is in proportion to its length and its spans, up to the sorting of the spans.
    """
    require(docs, [text_col])

    text, none = F.col("__text"), F.array().cast(_SPANS)
    base = F.flatten(
        F.array(
            _found(text, "assign", ASSIGN, lambda m: _assigned(m) >= LEAST["assign"]),
            _found(text, "access", _ACCESS_LONG, gate=F.contains(text, F.lit("AKIA"))),
            _found(text, "hex", _HEX_LONG),
        )
    )
    short = _found(text, "secret", ASSIGN, lambda m: (_assigned(m) < LEAST["assign"]) & (_assigned(m) >= 6))
    weak = F.flatten(F.array(_found(text, "secret", WEAK["secret"]), short, _found(text, "ident", WEAK["ident"])))
    endpoints = F.when(F.size("__weak") > 0, _found(text, "endpoint", WEAK["endpoint"])).otherwise(none)
    links = F.when(F.size("__weak") > 0, _linked(F.col("__parts"), reach)).otherwise(none)
    scratch = ["__text", "__base", "__weak", "__parts", "__links"]
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    named = lambda s: F.struct(
        F.element_at(kinds, s["rank"] + 1).alias("kind"), s.start.alias("start"), s.end.alias("end")
    )
    # Columns one after another: each is computed once, and the analyzer's rounds suffice for what is nested in one.
    return (
        docs.drop("base_spans", "spans", *scratch)
        .withColumn("__text", text_or_empty(text_col))
        .withColumns({"__base": base, "__weak": weak})
        .withColumn("__parts", F.concat("__base", "__weak", endpoints))
        .withColumn("__links", links)
        .withColumns(
            {
                "base_spans": F.transform(F.array_sort("__base"), named),
                "spans": F.transform(_distinct(F.concat("__base", "__links")), named),
            }
        )
        .drop(*scratch)
    )


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s.kind == kind)).cast("bigint")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(_listed("base_spans"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )
