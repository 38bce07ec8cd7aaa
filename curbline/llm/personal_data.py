"""Personal data in texts, by weak supervision.

Base patterns are always reported. Weaker candidates (local phone numbers, identity numbers, masked addresses,
titled names) are put to a vote of four labelers: a strict pattern, a gazetteer of announcing words before the
span, the characters next to it, and other personal data nearby. Expectation-maximisation over the vote
patterns estimates how reliable each labeler is without labelled data, and its posteriors train a logistic
classifier of spans, which decides. The base spans take part as evidence of what real spans look like.

Texts are read once, into a table of spans without text. Only counts per vote pattern and feature combination come to
the driver; there are at most ``3**4`` patterns and a few hundred combinations, whatever the number of spans.

Positions come from the pieces between matches: the lengths of the pieces and matches before a match add up to its start.
Sums, neighbours and contexts are made chunk by chunk, so that a text with very many spans takes little more than its share.

Defined cases: a null text counts as empty and has no spans. Positions are code points. Repeated rows and null
identifiers each get their row. Without any candidate nothing is added. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.session import settle

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("local_phone", "identity", "masked_email", "name")
KINDS = BASE_KINDS + ADDED_KINDS
NEAR = 40  # code points of context

# Possessive forms where nothing could be given back, and starts only where a run starts or the last match ended:
# the same matches as the plain patterns, in time proportional to the text.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# whole chains of digits with single separators, of 14 to 19 digits
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

LOCAL_PHONE = r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
IDENTITY = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
MASKED = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++"
)
#: Forms of address before a name.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Sr Sra Señor Señora".split()
NAME = r"(?<![\p{L}0-9])(?:" + "|".join(TITLES) + r")\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?"
#: Words that announce personal data.
ANNOUNCING = (
    "phone tel telephone call mobile cell fax contact email mail e-mail ssn social security passport id name "
    "telefon handy anruf kontakt ausweis courriel appeler portable nom teléfono móvil correo llamar nombre"
).split()

SPAN = "array<struct<start:int,order:int,end:int,kind:string,text:string>>"
#: Matches whose lengths are added up together, and code points of a block of text.
CHUNK, BLOCK = 128, 512


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(pairs: Column) -> Column:
    return F.aggregate(pairs, F.lit(0), lambda total, p: total + p["gap"] + p["size"])


def _before_chunks(pairs: Column) -> Column:
    """The length of all that comes before each chunk of ``CHUNK`` matches."""
    chunks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, length: Column) -> Column:
        return F.struct((state["at"] + length).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    lengths = F.transform(chunks, lambda k: _total(F.slice(pairs, k * CHUNK + 1, F.lit(CHUNK))))
    return F.aggregate(lengths, start, step, lambda s: s["out"])


def _located(kind: str, matches: Column, pieces: Column) -> Column:
    """Matches with their positions. ``pieces`` are the texts between them, one more than there are matches.

    Lengths are added up by chunks, so the work grows with the number of matches, not with its square.
    """
    pairs = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("m")))

    def spans(pairs: Column, before: Column) -> Column:
        def span(pair: Column, i: Column) -> Column:
            chunk = F.floor(i / CHUNK).cast("int")
            earlier = _total(F.slice(pairs, chunk * CHUNK + 1, i % CHUNK))
            begin = F.get(before, chunk) + earlier + pair["gap"]
            return _let(begin, lambda at: F.struct(
                at.alias("start"), F.lit(KINDS.index(kind)).alias("order"), (at + pair["size"]).alias("end"),
                F.lit(kind).alias("kind"), pair["m"].alias("text")))

        return F.transform(pairs, span)

    found = _let(pairs, lambda ps: _let(_before_chunks(ps), lambda before: spans(ps, before)))
    return F.when(F.size(matches) == 0, F.array().cast(SPAN)).otherwise(found)


def _luhn(match: Column) -> Column:
    digits = F.filter(F.split(F.reverse(F.regexp_replace(match, "[^0-9]", "")), "", -1), lambda d: d != "")

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _digits(match: Column) -> Column:
    return F.length(F.regexp_replace(match, "[^0-9]", ""))


@dataclass(frozen=True)
class Pattern:
    kind: str
    regex: str
    guard: Column | None  # a cheap test that every text with a match passes
    valid: object = None  # of a match; matches that fail are dropped


def _patterns(text: Column) -> list[Pattern]:
    octets = "^" + r"\.".join([OCTETS] * 4) + "$"
    return [
        Pattern("email", EMAIL, F.contains(text, F.lit("@"))),
        Pattern("ip", IP, None, lambda m: m.rlike(octets)),
        Pattern("card", CARD, None, _luhn),
        Pattern("phone", PHONE, F.contains(text, F.lit("+")), lambda m: _digits(m).between(10, 15)),
        Pattern("local_phone", LOCAL_PHONE, None),
        Pattern("identity", IDENTITY, F.contains(text, F.lit("-"))),
        Pattern("masked_email", MASKED, F.contains(text, F.lit("at")) & text.rlike(r"[\[(]at[\])]")),
        Pattern("name", NAME, None),
    ]


def _spans(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, base, candidates): arrays of spans; a candidate that overlaps a base span is left out."""
    text = F.col("text")
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    none, patterns = F.array().cast("array<string>"), _patterns(text)
    found = rows.select("id", "text", *[
        (F.regexp_extract_all(text, F.lit(p.regex), F.lit(0)) if p.guard is None else
         F.when(p.guard, F.regexp_extract_all(text, F.lit(p.regex), F.lit(0))).otherwise(none)).alias(p.kind)
        for p in patterns
    ])
    located = found.select("id", "text", *[
        _located(p.kind, F.col(p.kind), F.when(F.size(p.kind) > 0, F.split(text, p.regex, -1)).otherwise(none)).alias(p.kind)
        for p in patterns
    ])
    valid = {p.kind: _valid(p) for p in patterns}
    spans = located.select("id", "text", F.array_sort(F.concat(*[valid[k] for k in BASE_KINDS])).alias("base"),
                           F.array_sort(F.concat(*ADDED_KINDS)).alias("weak"))
    clear = _beside("weak", 0, lambda part, near: F.filter(part, lambda s: ~F.exists(near, lambda b: _within(b, s, 0))))
    return spans.select("id", "text", "base", clear.alias("weak"))


def _within(a: Column, b: Column, reach: int) -> Column:
    """Whether there are fewer than ``reach`` code points between two spans, or they overlap."""
    return (a["start"] < b["end"] + reach) & (b["start"] < a["end"] + reach)


def _beside(spans: str, reach: int, body) -> Column:
    """``body`` of sorted spans, a chunk at a time, and of the base spans within reach of the chunk; its arrays joined.

    Chunks have about the square root of the number of spans, so that neither looking for a chunk's neighbours nor
    comparing with them takes long.
    """
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(spans)))).cast("int")
    chunks = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / width).cast("int"))

    def chunk(k: Column) -> Column:
        def with_part(part: Column) -> Column:
            hull = F.struct(
                F.array_min(F.transform(part, lambda s: s["start"])).alias("start"),
                F.array_max(F.transform(part, lambda s: s["end"])).alias("end"),
            )
            near = _let(hull, lambda h: F.filter("base", lambda b: _within(b, h, reach)))
            return _let(near, lambda found: body(part, found))

        return _let(F.slice(spans, k * width + 1, width), with_part)

    none = F.slice(body(F.col(spans), F.col("base")), 1, 0)  # of the same type
    return F.when(F.size(spans) == 0, none).otherwise(F.flatten(F.transform(chunks, chunk)))


def _valid(pattern: Pattern) -> Column:
    if pattern.valid is None:
        return F.col(pattern.kind)
    return F.filter(pattern.kind, lambda s: pattern.valid(s["text"]))


LABELERS = ("strict", "announced", "alone", "company")


def _context(blocks: Column, start: Column, end: Column) -> Column:
    """What stands before a span, up to ``NEAR`` code points, and the one behind it, read from two blocks of the text."""
    number = F.floor(start / BLOCK).cast("int")
    both = F.concat(F.coalesce(F.get(blocks, number - 1), F.lit("")), F.coalesce(F.get(blocks, number), F.lit("")))
    place = start - F.greatest(F.lit(0), number - 1) * BLOCK
    return F.struct(
        F.substring(both, F.greatest(F.lit(1), place - NEAR + 1), F.least(F.lit(NEAR), place)).alias("before"),
        F.substring(F.coalesce(F.get(blocks, F.floor(end / BLOCK).cast("int")), F.lit("")), end % BLOCK + 1, F.lit(1)).alias("after"),
    )


def _judged(span: Column, near: Column, trusted: bool) -> Column:
    """A span with its labelers' votes (1, 0, or null: no opinion) and its features. Uses the column blocks; ``near`` holds
    the base spans around."""
    return _let(_context(F.col("blocks"), span["start"], span["end"]), lambda c: _votes(span, near, c["before"], c["after"], trusted))


def _votes(span: Column, near: Column, before: Column, after: Column, trusted: bool) -> Column:
    kind, text = span["kind"], span["text"]
    strict = (
        F.when(kind == "local_phone", text.rlike(r"^\(?[2-9][0-9]{2}\)?([\x20.-])[2-9][0-9]{2}[.-][0-9]{4}$"))
        .when(kind == "identity", ~text.rlike(r"^(?:000|666|9)|-00-|-0000$"))
        .when(kind == "name", text.rlike(r"\x20\p{Lu}\p{Ll}+\x20\p{Lu}"))
        .otherwise(F.lit(True))
    )
    announced = before.rlike(r"(?i)(?<!\p{L})(?:" + "|".join(ANNOUNCING) + r")(?!\p{L})[^\p{L}]*(?:\p{L}+[^\p{L}]+)?$")
    alone = ((before == "") | before.rlike(r"[\s(:;,\"']$")) & ((after == "") | after.rlike(r"^[\s),;:.!?\"']"))
    company = F.exists(near, lambda b: _within(b, span, 8 * NEAR) & ((b["start"] != span["start"]) | (b["kind"] != kind)))
    return F.struct(
        span["start"].alias("start"), span["order"].alias("order"),
        span["end"].alias("end"), kind.alias("kind"), F.lit(trusted).alias("trusted"),
        strict.cast("int").alias("strict"),
        F.when(announced, F.lit(1)).alias("announced"),  # silence says nothing
        alone.cast("int").alias("alone"),
        F.when(company, F.lit(1)).alias("company"),
        F.least(F.lit(6), F.length(F.regexp_replace(text, "[^0-9]", "")).cast("int") / 4).cast("int").alias("digits"),
        F.least(F.lit(6), (span["end"] - span["start"]) / 8).cast("int").alias("width"),
    )


def reliabilities(patterns: dict[tuple, int], rounds: int = 60) -> tuple[float, list[tuple[float, float]], dict[tuple, float]]:
    """Expectation-maximisation over vote patterns (votes 1, 0 or None, with counts).

    Returns the share of real spans, each labeler's chance to say yes for real and for false spans, and the
    chance of being real per pattern. Labelers are taken as independent given the truth.
    """
    labelers = range(len(next(iter(patterns), ())))
    real = {}
    for votes in patterns:
        cast = [v for v in votes if v is not None]
        real[votes] = (sum(cast) + 0.5) / (len(cast) + 1.0)
    share, rates = 0.5, []
    for _ in range(rounds):
        total = sum(patterns.values())
        share = (1 + sum(n * real[v] for v, n in patterns.items())) / (2 + total)
        rates = []
        for k in labelers:
            sums = [[1.0, 2.0], [1.0, 2.0]]  # yes votes and votes, for real and for false spans
            for votes, n in patterns.items():
                if votes[k] is not None:
                    for side, p in ((0, real[votes]), (1, 1 - real[votes])):
                        sums[side][0] += n * p * votes[k]
                        sums[side][1] += n * p
            rates.append((sums[0][0] / sums[0][1], sums[1][0] / sums[1][1]))
        for votes in patterns:
            odds = math.log(share / (1 - share))
            for k, v in enumerate(votes):
                if v is not None:
                    yes, no = rates[k]
                    odds += math.log(yes / no) if v else math.log((1 - yes) / (1 - no))
            real[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, rates, real


FEATURES = ("strict", "announced", "alone", "company", "digits", "width")


def fit_logistic(rows: list[tuple[tuple, float, float]], steps: int = 400, decay: float = 0.01) -> dict[tuple, float]:
    """Weights per (feature, value) from rows (features, number of spans, expected number of real ones)."""
    keys = sorted({(f, v) for features, _, _ in rows for f, v in features}, key=repr)
    weights = dict.fromkeys([("bias", 1), *keys], 0.0)
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(steps):
        slopes = {k: decay * w for k, w in weights.items()}
        for features, n, real in rows:
            z = weights["bias", 1] + sum(weights[f] for f in features)
            error = n / (1 + math.exp(-max(-30.0, min(30.0, z)))) - real
            for f in (("bias", 1), *features):
                slopes[f] += error / total
        for k, slope in slopes.items():
            weights[k] -= 1.0 * slope
    return weights


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: identifier, base and spans, both arrays of (start, order, end, kind) in order."""
    spans = _spans(docs, id_column, text_column)
    plain = lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))
    # blocks of the text, so that reading around a span does not start from the text's beginning
    any_span = (F.size("weak") > 0) | (F.size("base") > 0)
    blocks = F.when(any_span, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    judge = lambda trusted: lambda part, near: F.transform(part, lambda s: _judged(s, near, trusted))
    judged = settle(spans.select("id", "weak", "base", blocks.alias("blocks")).select(
        "id", F.transform("base", plain).alias("shown"),
        F.concat(_beside("weak", 8 * NEAR, judge(False)), _beside("base", 8 * NEAR, judge(True))).alias("judged"),
    ), "spans").withColumnRenamed("shown", "base")
    votes = [F.when(F.col("trusted") & (F.lit(k) == "strict"), F.lit(1)).otherwise(F.col(k)).alias(f"vote_{k}") for k in LABELERS]
    counted = (
        judged.select(F.inline("judged"))
        .select(*votes, *FEATURES)
        .groupBy(*[f"vote_{k}" for k in LABELERS], *FEATURES).agg(F.count(F.lit(1)).alias("n"))
        .collect()  # bounded: combinations, not spans
    )
    patterns: dict[tuple, int] = {}
    for row in counted:
        key = tuple(row[f"vote_{k}"] for k in LABELERS)
        patterns[key] = patterns.get(key, 0) + row.n
    _, _, real = reliabilities(patterns)
    rows = [
        (tuple((f, row[f]) for f in FEATURES), float(row.n), row.n * real[tuple(row[f"vote_{k}"] for k in LABELERS)])
        for row in counted
    ]
    weights = fit_logistic(rows)

    def accepted(s: Column) -> Column:
        z = F.lit(weights["bias", 1])
        for (name, value), weight in weights.items():
            if name != "bias":
                z = z + F.when(s[name].eqNullSafe(F.lit(value)), F.lit(weight)).otherwise(0.0)
        return s["trusted"] | (F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) >= least)

    return judged.select(
        F.col("id").alias(id_column), "base",
        F.array_sort(F.transform(F.filter("judged", accepted), plain)).alias("spans"),
    )


def _digest(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def personal_data_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Identifier, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (as text)."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return find_personal_data(docs, id_column, text_column).select(
        id_column, *[count(k) for k in BASE_KINDS],
        F.sha2(_digest(F.col("base")), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"),
    )
