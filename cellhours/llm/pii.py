"""Personal data: base patterns, and a span classifier from weak supervision.

Everything is DataFrame and SQL expressions in the row of the text; only counts of label patterns
(a bounded number) come to the driver, where expectation-maximisation works on them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellhours.llm.arrays import let, prefix_sums
from cellhours.sources.scratch import materialise

KINDS = ("email", "ip", "card", "phone")

# The base patterns. The forms below match the same strings, but without nested
# repeats (Java's regex engine recurses on those) and without trying a run of characters again
# from each of its places. Marks of one character stand for a separator that joins two digits
# (MARK) or a dot that joins two domain characters (DOT), so places do not move.
MARK, DOT = "\x01", "\x02"
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+\x02-]))[A-Za-z0-9._%+\x02-]++@"
    r"[A-Za-z0-9-]++\x02[A-Za-z0-9\x02-]++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x01]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# What the labelers look at beyond the base patterns.
SPOKEN_EMAIL = (
    r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\(dot\)|\[dot\]|\{dot\}|\.)\x20?[A-Za-z0-9-]{1,63}){1,4}"
)
SPOKEN_IP = r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){3}(?![0-9])"
PLAIN_CARD = r"(?<![0-9])[0-9]{13,19}(?![0-9])"
PLAIN_PHONE = (
    r"(?<![0-9+.-])(?:\([0-9]{2,4}\)\x20?|00[1-9][0-9]{1,2}[\x20-]|[0-9]{3,4}[.-])"
    r"[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])"
)
# Gazetteers: endings of mail hosts, first digits of card issuers, longer country codes.
HOST_ENDINGS = "com|org|net|edu|gov|io|info|biz|co|eu|uk|de|fr|es|it|nl|at|ch|be|pt|us|ca|mx|ar"
CARD_HEADS = "4|5[1-5]|2[2-7]|3[4-7]|30|6011|62|64[4-9]|65"
COUNTRY_CODES = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
# Context words in front of a span, in the four languages of the corpus.
CUES = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel|write|adresse",
    "ip": "ip|host|server|address|servidor|serveur|login",
    "card": "card|visa|credit|karte|tarjeta|carte|payment|iban",
    "phone": "phone|tel|call|fax|mobile|handy|anruf|tel[eé]fono|t[eé]l[eé]phone|whatsapp",
}
LABELERS = ("pattern", "format", "gazetteer", "context", "border")
LONG = 24  # letters of the longest piece of text before a span that the context labeler sees


@dataclass(frozen=True)
class SpanModel:
    """Weights of the final classifier, by kind, and what they were learned from."""

    bias: dict[str, float]
    weights: dict[str, dict[str, float]]
    threshold: float
    reliability: dict[str, dict[str, tuple[float, float]]]


def spans_of(text: Column, pattern: str) -> Column:
    """Array of (s, e, m): start, exclusive end in code points and text of each match."""
    return let(
        F.struct(
            F.split(text, pattern).alias("gaps"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        ),
        lambda x: let(
            prefix_sums(
                F.zip_with(
                    F.slice(x["gaps"], 1, F.size(x["found"])),
                    x["found"],
                    lambda gap, m: F.char_length(gap) + F.char_length(m),
                )
            ),
            lambda ends: F.zip_with(
                ends,
                x["found"],
                lambda e, m: F.struct(
                    (e - F.char_length(m)).alias("s"), e.alias("e"), m.alias("m")
                ),
            ),
        ),
    )


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    return let(
        F.reverse(digits),
        lambda d: F.aggregate(
            F.sequence(F.lit(1), F.char_length(d)),
            F.lit(0),
            lambda a, i: a
            + let(
                F.substring(d, i, F.lit(1)).cast("int"),
                lambda v: F.when(i % 2 == 0, F.get(doubled, v)).otherwise(v),
            ),
            lambda a: a % 10 == 0,
        ),
    )


def _card_ok(m: Column) -> Column:
    return let(
        _digits(m), lambda d: F.when(F.char_length(d).between(12, 19), luhn(d)).otherwise(False)
    )


def _ip_ok(parts: Column) -> Column:
    return F.forall(
        F.transform(parts, lambda p: F.ltrim(p, F.lit("0"))),
        lambda p: (p == "")
        | F.when(F.char_length(p) <= 3, F.try_to_number(p, F.lit("999")) <= 255).otherwise(False),
    )


def _phone_ok(m: Column) -> Column:
    return F.char_length(_digits(m)).between(9, 15)


def _when_any(text: Column, test: Column, spans: Column) -> Column:
    """`spans`, or an empty array of the same type where a quick test rules them out."""
    return F.when(test, spans).otherwise(
        F.array().cast("array<struct<s:int,e:int,m:string>>")
    )


def base_spans(text: Column) -> dict[str, Column]:
    """The base matches by kind: arrays of (s, e, m). A NULL text has none."""
    dotted = F.regexp_replace(
        F.translate(text, DOT, "!"), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT
    )
    joined = F.regexp_replace(F.translate(text, MARK, "_"), r"(?<=[0-9])[\x20-](?=[0-9])", MARK)
    return {
        "email": _when_any(text, F.contains(text, F.lit("@")), spans_of(dotted, EMAIL)),
        "ip": F.filter(
            _when_any(text, text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), spans_of(text, IP)),
            lambda x: _ip_ok(F.split(x["m"], r"\.")),
        ),
        "card": F.filter(
            _when_any(text, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), spans_of(joined, CARD)),
            lambda x: _card_ok(x["m"]),
        ),
        "phone": F.filter(
            _when_any(text, text.rlike(r"\+[0-9]"), spans_of(text, PHONE)),
            lambda x: _phone_ok(x["m"]),
        ),
    }


def wider_spans(text: Column) -> dict[str, Column]:
    """Candidates that the base patterns may miss, by kind."""
    spoken = text.rlike(r"[(\[{](?:at|dot|\.)[)\]}]")
    many = text.rlike(r"[0-9]{13}")
    return {
        "email": _when_any(text, spoken, spans_of(text, SPOKEN_EMAIL)),
        "ip": _when_any(text, spoken, spans_of(text, SPOKEN_IP)),
        "card": _when_any(text, many, spans_of(text, PLAIN_CARD)),
        "phone": _when_any(
            text, text.rlike(r"[0-9]{3}[\x20.-][0-9]{3}"), spans_of(text, PLAIN_PHONE)
        ),
    }


def _votes(kind: str, text: Column, m: Column, s: Column, e: Column, base: bool) -> Column:
    """The labelers' votes as bits, pattern first, then the bits of the span's shape."""
    digits = _digits(m)
    if kind == "email":
        form = ~m.rlike(r"\.\.|^[.-]|@-|-$")
        known = m.rlike(rf"(?i)(?:[.\x02]|dot[)\]}}]\x20?)(?:{HOST_ENDINGS})$")
    elif kind == "ip":
        form = ~m.rlike(r"(?:^|[^0-9])0[0-9]")
        known = ~m.rlike(r"^(?:0|10|127|255)[^0-9]|^192[^0-9]+168[^0-9]|^169[^0-9]+254[^0-9]")
    elif kind == "card":
        form = F.when(F.char_length(digits).between(13, 19), luhn(digits)).otherwise(False)
        known = digits.rlike(f"^(?:{CARD_HEADS})")
    else:
        form = F.char_length(digits).between(9, 15)
        known = m.rlike(rf"^(?:\+|00)(?:{COUNTRY_CODES})")
    before = F.substring(text, F.greatest(s - LONG + 1, F.lit(1)), F.least(s, F.lit(LONG)))
    after = F.substring(text, e + 1, F.lit(1))
    votes = [
        F.lit(base),
        form,
        known,
        before.rlike(rf"(?i)(?<!\p{{L}})(?:{CUES[kind]})[\x20:.]"),
        ~(before.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9]")),
        # Shape: beside the labelers, only for the final classifier.
        F.char_length(m) >= 16,
        m.rlike(r"[\x20()\[\]{}-]"),
        m.rlike(r"^(.)\1*$|000000|123456"),
    ]
    bits = F.lit(0)
    for i, vote in enumerate(votes):
        bits = bits + F.when(F.coalesce(vote, F.lit(False)), 1 << i).otherwise(0)
    return bits


SHAPES = ("long", "separated", "dull")
FEATURES = (*LABELERS, *SHAPES)


def _candidate(text: Column, k: int, base: bool) -> Callable[[Column], Column]:
    return lambda x: F.struct(
        x["s"].alias("s"),
        F.lit(k).alias("k"),
        x["e"].alias("e"),
        F.lit(base).alias("base"),
        _votes(KINDS[k], text, x["m"], x["s"], x["e"], base).alias("bits"),
    )


def candidates(text: Column) -> Column:
    """All candidate spans of a text: array of (s, k, e, base, bits), k numbering KINDS."""
    parts = [
        F.transform(found[kind], _candidate(text, k, base))
        for k, kind in enumerate(KINDS)
        for base, found in ((True, base_spans(text)), (False, wider_spans(text)))
    ]
    return F.coalesce(F.concat(*parts), F.array().cast(
        "array<struct<s:int,k:int,e:int,base:boolean,bits:int>>"
    ))


def estimate_reliability(
    patterns: dict[int, int], rounds: int = 100
) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """Expectation-maximisation over label patterns {votes: count}.

    Each labeler votes independently given the truth. Returns the share of true spans, each
    labeler's rates of positive votes on true and on false spans, and the posterior by pattern.
    The first labeler is the base pattern, which is right by definition, so its rate on false
    spans starts near 0. A count of one of each kind keeps the rates off 0 and 1.
    """
    size = len(LABELERS)
    share, rates = 0.5, [(0.9, 0.05), *[(0.7, 0.3)] * (size - 1)]
    posterior: dict[int, float] = {}
    for _ in range(rounds):
        for votes in patterns:
            odds = math.log(share / (1 - share))
            for i, (yes, no) in enumerate(rates):
                odds += math.log(yes / no) if votes >> i & 1 else math.log((1 - yes) / (1 - no))
            posterior[votes] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        true = sum(n * posterior[v] for v, n in patterns.items())
        false = sum(patterns.values()) - true
        share = (true + 1) / (true + false + 2)
        rates = [
            (
                (sum(n * posterior[v] for v, n in patterns.items() if v >> i & 1) + 1) / (true + 2),
                (sum(n * (1 - posterior[v]) for v, n in patterns.items() if v >> i & 1) + 1)
                / (false + 2),
            )
            for i in range(size)
        ]
    return share, rates, posterior


def train_classifier(
    examples: dict[int, tuple[int, float]], rounds: int = 400, ridge: float = 1.0
) -> tuple[float, dict[str, float]]:
    """Logistic regression on {bits: (count, probability)} by gradient steps with momentum."""
    total = sum(n for n, _ in examples.values()) or 1
    weights, speed = [0.0] * (len(FEATURES) + 1), [0.0] * (len(FEATURES) + 1)
    rows = [([1, *(bits >> i & 1 for i in range(len(FEATURES)))], n, p) for bits, (n, p) in examples.items()]
    for _ in range(rounds):
        slope = [0.0, *(ridge * w / total for w in weights[1:])]
        for x, n, p in rows:
            score = sum(w * v for w, v in zip(weights, x, strict=True))
            miss = 1 / (1 + math.exp(-max(-500.0, min(500.0, score)))) - p
            for i, v in enumerate(x):
                slope[i] += n / total * miss * v
        speed = [0.9 * s - 0.5 * g for s, g in zip(speed, slope, strict=True)]
        weights = [w + s for w, s in zip(weights, speed, strict=True)]
    return weights[0], dict(zip(FEATURES, weights[1:], strict=True))


def fit_spans(found: DataFrame, column: str, threshold: float = 0.8) -> SpanModel:
    """Learn the span classifier from the candidates of all texts.

    `column` is an array of `candidates`. They are counted by kind and bits: at most 4 * 2**8
    rows come to the driver, whatever the table holds.
    """
    counts = (
        found.select(F.explode(column).alias("c"))
        .groupBy("c.k", "c.bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    labels = (1 << len(LABELERS)) - 1
    bias, weights, reliability = {}, {}, {}
    for k, kind in enumerate(KINDS):
        seen = {r.bits: r.n for r in counts if r.k == k}
        patterns: dict[int, int] = {}
        for bits, n in seen.items():
            patterns[bits & labels] = patterns.get(bits & labels, 0) + n
        _, rates, posterior = estimate_reliability(patterns)
        reliability[kind] = dict(zip(LABELERS, rates, strict=True))
        bias[kind], weights[kind] = train_classifier(
            {bits: (n, posterior[bits & labels]) for bits, n in seen.items()}
        )
    return SpanModel(bias, weights, threshold, reliability)


def _accepted(model: SpanModel, c: Column) -> Column:
    """Whether the classifier takes a candidate: a look-up by kind and bits."""
    limit = math.log(model.threshold / (1 - model.threshold))
    tables = []
    for kind in KINDS:
        scores = []
        for bits in itertools.product((0, 1), repeat=len(FEATURES)):
            score = model.bias[kind] + sum(
                model.weights[kind][f] * b for f, b in zip(FEATURES, reversed(bits), strict=True)
            )
            scores.append(score >= limit)
        tables.append("".join("1" if s else "0" for s in scores))
    return F.substring(F.lit("".join(tables)), c["k"] * (1 << len(FEATURES)) + c["bits"] + 1, F.lit(1)) == "1"


def chosen_spans(found: Column, model: SpanModel) -> Column:
    """Base spans and what the classifier adds, in order: array of (s, k, e, base, bits).

    An added span touches no base span and no added span that begins before it.
    """

    def pick(x: Column) -> Column:
        def clear(c: Column) -> Column:
            earlier = F.filter(
                x["more"],
                lambda o: (o["s"] < c["s"]) | ((o["s"] == c["s"]) & (o["k"] < c["k"])),
            )
            return ~F.exists(
                F.concat(x["base"], earlier), lambda o: (o["s"] < c["e"]) & (c["s"] < o["e"])
            )

        return F.sort_array(F.concat(x["base"], F.filter(x["more"], clear)))

    return let(
        F.struct(
            F.filter(found, lambda c: c["base"]).alias("base"),
            F.filter(found, lambda c: ~c["base"] & _accepted(model, c)).alias("more"),
        ),
        pick,
    )


def find_pii(
    docs: DataFrame, text: str = "text", out: str = "pii", with_text: bool = True
) -> DataFrame:
    """`docs` with an array column `out` of (s, k, e, base, bits): all spans of the whole text.

    Places are in code points, ends exclusive, `k` numbers KINDS, `bits` are the votes. The
    classifier is fitted on the whole table. A NULL or empty text has no spans. Rows are looked
    at one by one, so repeated rows and other columns do not matter; an input column called like
    `out` is replaced. Without `with_text` the text is left out, and texts are read once instead
    of twice.
    """
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    body = F.coalesce(F.col(text), F.lit(""))
    if with_text:
        found = materialise(docs.select(candidates(body).alias(out)), "pii-candidates")
        model = fit_spans(found, out)
        return docs.select(*kept, let(candidates(body), lambda c: chosen_spans(c, model)).alias(out))
    others = [c for c in kept if c != text]
    found = materialise(docs.select(*others, candidates(body).alias(out)), "pii-candidates")
    model = fit_spans(found, out)
    return found.select(*others, chosen_spans(F.col(out), model).alias(out))


def spans_text(spans: Column) -> Column:
    """kind:start:end of (s, k, e, ..) spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")
            ),
        ),
        ",",
    )


def mask(text: Column, spans: Column) -> Column:
    """`text` with each span replaced by its kind in brackets; where spans overlap, the first
    one gives the name and all of their characters go."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(
            spans,
            F.struct(F.lit("").alias("t"), F.lit(0).alias("at")),
            lambda a, x: F.struct(
                F.when(x["s"] < a["at"], a["t"])
                .otherwise(
                    F.concat(
                        a["t"],
                        F.substring(text, a["at"] + 1, x["s"] - a["at"]),
                        F.get(names, x["k"]),
                    )
                )
                .alias("t"),
                F.greatest(a["at"], x["e"]).alias("at"),
            ),
            lambda a: F.concat(a["t"], F.substring(text, a["at"] + 1, F.char_length(text))),
        )
    )
