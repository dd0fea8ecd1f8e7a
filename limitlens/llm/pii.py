"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base rules find well-formed e-mail addresses, IP addresses, card and phone numbers. They are the
seeds: the one and two words before them are lexical patterns. What merely looks like an
identifier is an instance too. In the graph of patterns and instances a pattern's confidence
for a kind is the share of what it precedes that is of this kind; an unproven instance takes
the best confidence of its patterns, which counts for the patterns in the next round. In the end
patterns of high confidence and enough different seeds name the unproven instances that have the
outer form of the kind.

One pass reads the texts; everything after works on the places found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.llm.tables import answer_groups, keep, whole_text

KINDS = ("email", "ip", "card", "phone")

# The base forms. Possessive repeats and look-behinds change no match: they keep the search linear
# and off the stack in long runs of letters or digits.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What looks like an identifier, by form: x@y between any marks; digits with marks, brackets and
# blanks between them; and, as what a context may precede too, any other token with digits.
_MARK = r"\s\p{Z}@<>()\[\]{}\"'`,;:|=\u201c\u201d\u2018\u2019\u00ab\u00bb"
ADDRESS = rf"(?<![^{_MARK}])[^{_MARK}]++(?:@(?:\[[^\s@\]]++\]|[^{_MARK}]*[\p{{L}}\p{{N}}]))++"
_GROUP = r"(?:\([0-9]{1,5}\)|[0-9]++(?![\p{L}\p{N}]))"
_TIGHT = rf"\+?{_GROUP}(?:[^\s\p{{Z}}\p{{L}}\p{{N}}@\"'<>|;]{{0,2}}{_GROUP})*+"
NUMBERS = rf"(?<![\p{{L}}\p{{N}}]){_TIGHT}(?:[ \u00a0]{{1,2}}(?:-[ \u00a0])?{_TIGHT})*+"
_PART = r"[^ \u00a0]*[0-9][^ \u00a0]*"
TOKEN = r"(?<!\S)[(+]?[A-Za-z0-9][^\s]{5,}+"

ROUNDS, SMOOTHING = 3, 2.0
CONFIDENCE, LEAST_SEEDS = 0.8, 5
_CONTEXT, _LONG = 64, 4096
_WORD = r"[\p{L}\p{N}](?:[^\s\p{Z}]*[\p{L}\p{N}])?"
_TRIM = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = digit * 2
        counted = F.when((size - i) % 2 == 1, doubled - F.when(doubled > 9, 9).otherwise(0)).otherwise(digit)
        return total + counted

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _holds(kind: str, match: Column) -> Column:
    """Whether a match of the form is one of the kind."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(
            F.split(match, r"\."),
            lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.nullif(part(p), F.lit("")).cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str) -> Column:
    """Start, end (code points) and value of every match, leftmost first.

    Between the matches lie the parts that a split at them leaves; their lengths add up to the places.
    """
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("gap"), values.alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["value"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        spans = F.when(pair["value"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda state: state["spans"]
    )


def _overlaps(spans: Column | str, span: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))


def _numbers(text: Column, base: Column) -> Column:
    """Candidates (start, end, value, share) among the digits of a text.

    Of a run with blanks every part begins candidates: the part itself, and the most parts that
    phone and card numbers have digits for. They share the weight of one. Base spans end a run.
    """
    bar = F.lit(1000)

    def of_run(run: Column) -> Column:
        parts = F.transform(_spans(run["value"], _PART), lambda p: F.struct(
            (run["start"] + p["start"]).alias("start"), (run["start"] + p["end"]).alias("end"),
            F.length(_digits(p["value"])).alias("digits"),
        ))
        return F.transform(parts, lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"),
            F.when(_overlaps(base, p), bar).otherwise(p["digits"]).alias("digits"),
        ))

    def reach(parts: Column, at: Column, most: int) -> Column:
        def add(state: Column, part: Column) -> Column:
            total = state["digits"] + part["digits"]
            return F.when(total > most, F.struct(bar.alias("digits"), state["end"].alias("end"), state["held"].alias("held"))).otherwise(
                F.struct(total.alias("digits"), part["end"].alias("end"), total.alias("held"))
            )

        start = F.struct(F.lit(0).alias("digits"), F.lit(-1).alias("end"), F.lit(0).alias("held"))
        # Every part has a digit.
        return F.aggregate(F.slice(parts, at + 1, F.lit(most)), start, add, lambda s: F.struct(s["end"].alias("end"), s["held"].alias("held")))

    def of_part(parts: Column, part: Column, at: Column) -> Column:
        alone = F.when(
            (part["digits"] >= 4) & (part["digits"] < bar) & (part["end"] - part["start"] >= 6),
            F.struct(part["end"].alias("end"), part["digits"].alias("held")),
        )
        joined = [F.transform(F.array(reach(parts, at, most)), lambda r: F.when(r["held"] >= 7, r))[0] for most in (15, 19)]
        ends = F.array(F.array_distinct(F.array_compact(F.array(alone, *joined))))
        return F.transform(ends, lambda own: F.transform(own, lambda e: F.struct(
            part["start"].alias("start"), e["end"].alias("end"),
            F.substring(text, part["start"] + 1, e["end"] - part["start"]).alias("value"),
            (F.lit(1.0) / F.size(own)).alias("share"),
        )))[0]

    runs = F.transform(_spans(text, NUMBERS), of_run)
    return F.flatten(F.transform(runs, lambda parts: F.flatten(F.transform(parts, lambda p, i: of_part(parts, p, i)))))


def _candidates(text: Column, base: Column) -> Column:
    """What looks like an identifier and is no base span: start, end, value, share."""
    none = F.array().cast("array<struct<start:int,end:int,value:string,share:double>>")
    whole = lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "value")], F.lit(1.0).alias("share"))
    free = lambda spans: F.filter(spans, lambda s: ~_overlaps(base, s))
    addresses = F.when(F.contains(text, F.lit("@")), free(F.transform(_spans(text, ADDRESS), whole))).otherwise(none)
    numbers = F.when(text.rlike("[0-9]"), _numbers(text, base)).otherwise(none)
    return F.transform(F.array(F.struct(addresses.alias("a"), numbers.alias("n"))), lambda x: F.concat(
        x["a"], F.filter(x["n"], lambda s: ~_overlaps(x["a"], s))
    ))[0]


def _tokens(text: Column, base: Column, forms: Column) -> Column:
    """Other tokens with digits or an @: none at whose front a form begins."""
    return F.transform(
        F.filter(
            _spans(text, TOKEN),
            lambda s: s["value"].rlike("[0-9].*[0-9].*[0-9].*[0-9]|@")
            & ~_overlaps(base, s) & ~F.exists(forms, lambda c: c["start"].between(s["start"], s["start"] + 2)),
        ),
        lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "value")], F.lit(1.0).alias("share")),
    )


def _before(text: Column, start: Column) -> Column:
    """The last two words before a place: lower case, without marks at their ends.

    Marks alone and any white space between them and the place are passed over. Windows grow until
    they hold two whole words; of a word longer than _LONG characters its last ones stand for it.
    """

    def words(size: Column) -> Column:
        return F.regexp_extract_all(F.lower(F.substring(text, start - size + 1, size)), F.lit(_WORD), F.lit(0))

    size = F.least(start, F.lit(_CONTEXT))
    # One more than needed: the window may cut the first in half.
    near = F.transform(F.array(words(size)), lambda w: F.when((F.size(w) > 2) | (size == start), w))[0]
    far = F.transform(F.array(words(F.least(start, F.lit(_LONG)))), lambda w: F.when(F.size(w) > 0, w))[0]
    found = F.array(F.coalesce(near, far, words(start)))
    return F.transform(found, lambda w: F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), F.lit(2)))[0]


def find_base(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` as the struct ``_doc``; ``_base`` and ``_others``: spans with kind and words before."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), text.alias("_text"))
    marks = {"email": "@", "phone": "+"}
    for kind, pattern in BASE.items():
        found = _spans(F.col("_text"), pattern)
        if kind in marks:
            none = F.array().cast("array<struct<start:int,end:int,value:string>>")
            found = F.when(F.contains(F.col("_text"), F.lit(marks[kind])), found).otherwise(none)
        rows = rows.withColumn(f"_{kind}", found)

    def of_kind(rank: int, kind: str) -> Column:
        return F.transform(
            F.filter(F.col(f"_{kind}"), lambda s: _holds(kind, s["value"])),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("kind"), s["end"].alias("end"), s["value"].alias("value")
            ),
        )

    ranked = [of_kind(rank, kind) for rank, kind in enumerate(KINDS)]
    rows = rows.select("_doc", "_text", F.array_sort(F.concat(*ranked)).alias("_base"))
    none = F.array().cast("array<struct<start:int,end:int,value:string,share:double>>")
    some = F.col("_text").rlike("[0-9@]")
    forms = F.when(some, _candidates(F.col("_text"), F.col("_base"))).otherwise(none)
    rows = rows.select("_doc", "_text", "_base", forms.alias("_forms"))
    others = F.when(some, _tokens(F.col("_text"), F.col("_base"), F.col("_forms"))).otherwise(none)
    rows = rows.select("_doc", "_text", "_base", F.concat("_forms", others).alias("_looks"))
    with_words = lambda s, kind, share: F.struct(
        s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"), share.alias("share"),
        F.lower(F.regexp_replace(s["value"], _TRIM, "")).alias("value"), _before(F.col("_text"), s["start"]).alias("words"),
    )
    return rows.select(
        F.monotonically_increasing_id().alias("_row"),
        "_doc",
        F.transform("_base", lambda s: with_words(s, s["kind"], F.lit(1.0))).alias("_base"),
        F.transform("_looks", lambda s: with_words(s, F.lit(-1), s["share"])).alias("_others"),
    )


def _has_form(kind: str, value: Column) -> Column:
    """The outer form that an unproven instance of a kind must have."""
    digits = F.length(_digits(value))
    plain = ~value.rlike("[A-Za-z]")
    return {
        "email": value.rlike(r"[^@]@[^@]"),
        "ip": plain & value.rlike(r"^[0-9]{1,3}([.:-][0-9]{1,3}){3}$"),
        "card": plain & digits.between(12, 19),
        "phone": plain & digits.between(7, 15),
    }[kind]


def _mentions(found: DataFrame) -> DataFrame:
    """One row per place and pattern: the pattern is the last word, or the last two, before it."""
    every = found.select("_row", F.explode(F.concat("_base", "_others")).alias("s"))
    words = F.col("s.words")
    one = F.element_at(words, -1)
    patterns = F.filter(
        F.array(
            F.when(F.size(words) >= 1, one),
            F.when(F.size(words) >= 2, F.concat_ws(" ", words)),
        ),
        lambda p: p.isNotNull(),
    )
    return every.select(
        "_row", "s.start", "s.end", "s.kind", "s.share", "s.value", F.explode(patterns).alias("pattern")
    )


def confident_patterns(mentions: DataFrame) -> DataFrame:
    """(pattern, value, found): unproven instances that confident patterns name, with their kind.

    Patterns and instances of any frequency are combined before they meet, see ``answer_groups``.
    """
    numbers = range(len(KINDS))
    edges = mentions.groupBy("pattern", "value", "kind").agg(F.sum("share").alias("weight"))
    edges = edges.withColumn("spread", F.pmod(F.xxhash64("value", "pattern"), F.lit(64)))
    for i, kind in enumerate(KINDS):
        edges = edges.withColumn(f"seed{i}", (F.col("kind") == i).cast("double"))
        edges = edges.withColumn(f"sure{i}", F.col(f"seed{i}"))
        edges = edges.withColumn(f"form{i}", (F.col("kind") < 0) & _has_form(kind, F.col("value")))
    base = keep(edges, "pattern-edges")
    names = base.columns
    edges = base
    for last in [False] * (ROUNDS - 1) + [True]:
        sums = {"total": ("p_total", F.sum("weight"), "sum")}
        for i in numbers:
            sums[f"hits{i}"] = (f"p_hits{i}", F.sum(F.col("weight") * F.col(f"sure{i}")), "sum")
            sums[f"seeds{i}"] = (f"p_seeds{i}", F.sum(f"seed{i}"), "sum")
        scored = answer_groups(edges, ["pattern"], "spread", sums)
        for i in numbers:
            scored = scored.withColumn(f"trust{i}", F.col(f"hits{i}") / (F.col("total") + SMOOTHING))
        if last:
            break
        best = {f"best{i}": (f"p_best{i}", F.max(f"trust{i}"), "max") for i in numbers}
        scored = answer_groups(scored, ["value"], "spread", best)
        sure = [
            F.when(F.col("kind") >= 0, F.col(f"seed{i}")).when(F.col(f"form{i}"), F.col(f"best{i}")).otherwise(0.0)
            for i in numbers
        ]
        kept = [c for c in names if not c.startswith("sure")]
        edges = keep(scored.select(*kept, *[s.alias(f"sure{i}") for i, s in zip(numbers, sure, strict=True)]), "pattern-round")
    chosen = F.array_compact(F.array(*[
        F.when(
            F.col(f"form{i}") & (F.col(f"trust{i}") >= CONFIDENCE) & (F.col(f"seeds{i}") >= LEAST_SEEDS),
            F.struct(F.col(f"trust{i}").alias("trust"), F.lit(-i).alias("order"), F.lit(i).alias("kind")),
        )
        for i in numbers
    ]))
    return scored.withColumn("chosen", F.array_max(chosen)).where("chosen is not null").select(
        "pattern", "value", F.col("chosen.trust").alias("trust"), F.col("chosen.kind").alias("found")
    )


def detect(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``_doc`` (the given columns), ``_base`` and ``_all``: spans (start, kind, end), ordered.

    ``kind`` is the place in ``KINDS``. Rows are told apart by a number written with them, so
    repeated and missing ids are no matter.
    """
    found = keep(find_base(docs, whole_text() if text is None else text), "personal-data")
    mentions = _mentions(found)
    named = confident_patterns(mentions)
    best = F.max_by("found", F.struct("trust", -F.col("found"))).alias("found")
    added = (
        mentions.where("kind < 0").join(named, ["pattern", "value"])
        .groupBy("_row", "start", "end").agg(best)
        .groupBy("_row").agg(F.collect_list(F.struct("start", F.col("found").alias("kind"), "end")).alias("_added"))
    )
    bare = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = found.select("_row", "_doc", bare.alias("_base")).join(keep(added, "discovered"), "_row", "left")
    # Of overlapping additions the one that starts first stays, the longest of those that start together.
    first = F.array_sort(F.transform("_added", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))
    spans = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    apart = F.aggregate(
        first, F.struct(F.lit(0).alias("at"), spans.alias("spans")),
        lambda state, s: F.when(s["start"] < state["at"], state).otherwise(F.struct(
            (-s["minus_end"]).alias("at"),
            F.concat(state["spans"], F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (-s["minus_end"]).alias("end")))).alias("spans"),
        )),
        lambda state: state["spans"],
    )
    every = F.when(F.col("_added").isNull(), F.col("_base")).otherwise(F.array_sort(F.concat("_base", apart)))
    return joined.select("_doc", "_base", every.alias("_all"))


def _listed(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and digest are of the base spans, ``spans`` also lists discovered ones. Null text
    counts as empty: no spans, and the digest of the empty string. No documents give no rows.
    """
    found = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), F.coalesce("text", F.lit("")))

    def count(rank: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == rank)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(
        F.col("_doc.doc_id").alias("doc_id"), *counts, F.sha2(_listed("_base"), 256).alias("base_sha256"),
        _listed("_all").alias("spans"), (F.size("_all") - F.size("_base")).cast("long").alias("n_added"),
    )


def masked(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with every span of ``column`` replaced by its kind; null texts stay null.

    Of overlapping spans the one that starts first is replaced, the longest of those that start together.
    """
    found = detect(docs, whole_text(column))
    text = F.col("_doc").getField(column)
    ordered = F.array_sort(
        F.transform("_all", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind")))
    )
    labels = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def add(state: Column, span: Column) -> Column:
        part = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.when(span["start"] < state["at"], state).otherwise(F.struct(
            (-span["minus_end"]).alias("at"),
            F.concat(state["parts"], F.array(part, F.get(labels, span["kind"]))).alias("parts"),
        ))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    out = F.aggregate(ordered, start, add, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))
    ))
    new = F.when(F.size("_all") == 0, text).otherwise(out)
    return found.select(*[
        (new if c == column else F.col("_doc").getField(c)).alias(c) for c in docs.columns
    ])
