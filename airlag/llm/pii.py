"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from exact and from looser patterns. Labelers vote for or
against each (pattern, checksum, gazetteer, context words, surroundings);
expectation-maximisation estimates from the counts of vote patterns how
reliable every labeler is; and a logistic classifier, trained on the estimated
labels, decides on the looser spans. Spans of the exact patterns always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import materialize

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["pattern", "checksum", "gazetteer", "context", "around"]
SHAPES = ["digits", "size", "marks"]

# The stated patterns. Possessive repeats and the guard on the left change no
# match: they only keep long runs of the same characters from being tried again
# at every place, and repeated groups from growing the stack.
EXACT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spellings that the exact patterns leave out.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]{1,63}+"
    r"(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[a-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+)(.-])\(?[0-9]{3}\)?[\x20.-]\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {
    "email": (lambda t: F.instr(t, "@") > 0, lambda t: t.rlike(r"(?i)[\[(]\x20?at\x20?[\])]")),
    "ip": (lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda t: t.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}+:")),
    "card": (lambda t: t.rlike(r"[0-9]{2}|[0-9][\x20-][0-9]"), lambda t: t.rlike(r"[0-9]{4}[._/][0-9]{4}")),
    "phone": (lambda t: F.instr(t, "+") > 0, lambda t: t.rlike(r"[0-9]{3}\)?[\x20.-]\x20?[0-9]{3}")),
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# Endings of mail hosts, generic ones and those of countries.
ENDINGS = (
    "com org net edu gov mil int info biz name pro mobi io ai app dev cloud online site store shop tech blog news "
    "ac ae al am ar at au az ba be bg bo br by ca cc ch ci cl cm cn co cr cu cy cz de dk do dz ec ee eg es et eu fi fr "
    "ge gh gr gt hk hn hr hu id ie il in iq ir is it jm jo jp ke kh kr kw kz lb li lk lt lu lv ly ma md me mk mn mo mt "
    "mu mx my na ng ni nl no np nz om pa pe ph pk pl pr ps pt py qa ro rs ru sa se sg si sk sn sv sy th tn tr tv tw tz "
    "ua ug uk us uy uz ve vn za zm zw"
).split()
#: Gazetteers, as patterns over a candidate's text: endings of mail hosts, card
#: issuers' first digits, calling codes, and address blocks that are in use.
KNOWN = {
    "email": rf"(?i)(?:\.|dot\x20?[\])]\x20?)(?:{'|'.join(ENDINGS)})$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.|:",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[045678]|6[045])",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}",
}
#: Words before a candidate that speak for its kind, and ones that speak against any.
NEAR = {
    "email": r"(?i)\b(?:e-?mail|mail|correo|courriel|contact|write to)\W*$",
    "ip": r"(?i)\b(?:ip|host|server|address|adresse|from|ssh)\W*$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|karte|tarjeta|carte|credit)\W*(?:no|number|nr)?\W*$",
    "phone": r"(?i)\b(?:phone|tel|call|fax|mobile|cell|telefon|teléfono|téléphone|handy)\W*$",
}
AGAINST = r"(?i)\b(?:version|v|isbn|doi|order|id|page|section|article|token|sha|md5|key|no\. of|=)\W*$"


def _matches(text: Column, pattern: str, needed: Column) -> tuple[Column, Column]:
    """(matches, text between them), both empty where nothing can match."""
    none = F.array().cast("array<string>")
    return (
        F.when(needed, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        F.when(needed, F.split(text, pattern, -1)).otherwise(none),
    )


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("tinyint")


def _votes(kind: str, exact: bool, value: Column, before: Column, after: Column) -> list[Column]:
    digits = F.regexp_replace(value, "[^0-9]", "")
    valid = _valid(kind, value)
    if kind == "email":
        sound = value.rlike(r"(?i)[a-z]{2,}$")
    elif kind == "card":
        sound = F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    elif kind == "ip" and not exact:
        sound = F.lit(True)
    else:
        sound = valid
    # A candidate cut out of a longer word or number is not a value of its own.
    joined = before.rlike(r"[\p{L}\p{N}_=./-]$") | after.rlike(r"^(?:[\p{L}\p{N}_]|[.:/-][0-9])")
    never = F.lit(False)
    return [
        _vote(valid if exact else never, ~valid if exact else never).alias("pattern"),
        _vote(sound, ~sound).alias("checksum"),
        _vote(value.rlike(KNOWN[kind]), ~value.rlike(KNOWN[kind])).alias("gazetteer"),
        _vote(before.rlike(NEAR[kind]), before.rlike(AGAINST)).alias("context"),
        _vote(~joined, joined).alias("around"),
    ]


#: Matches that are placed one after the other; their places follow from the
#: lengths of such stretches, so the work grows with the number of matches.
STRETCH = 64
SPAN = "array<struct<begin: int, end: int, value: string, before: string, after: string>>"


def _zipped(hits: str, gaps: str) -> Column:
    """Matches with the text before and after each."""
    count = F.size(hits)
    return F.arrays_zip(
        F.slice(gaps, 1, count).alias("0"), F.col(hits).alias("1"), F.slice(gaps, 2, count).alias("2")
    )


def _stretches(zipped: str) -> Column:
    """Stretches of matches, placed from the start of each, and their lengths."""

    def step(state: Column, at: Column) -> Column:
        begin = state["place"] + F.length(at["0"])
        end = begin + F.length(at["1"])
        span = F.struct(
            begin.alias("begin"), end.alias("end"), at["1"].alias("value"),
            F.right(at["0"], F.lit(32)).alias("before"), F.left(at["2"], F.lit(2)).alias("after"),
        )
        return F.struct(F.concat(state["spans"], F.array(span)).alias("spans"), end.alias("place"))

    start = F.struct(F.array().cast(SPAN).alias("spans"), F.lit(0).alias("place"))
    count = F.floor((F.size(zipped) + STRETCH - 1) / STRETCH).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda i: F.aggregate(F.slice(zipped, i * STRETCH + 1, STRETCH), start, step))


def _placed(parts: str) -> Column:
    """All matches with their places in the text."""
    start = F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("place"))
    begins = F.aggregate(
        parts, start,
        lambda s, p: F.struct(
            F.concat(s["at"], F.array(s["place"])).alias("at"), (s["place"] + p["place"]).alias("place")
        ),
        lambda s: s["at"],
    )

    def moved(part: Column, by: Column) -> Column:
        return F.transform(
            part["spans"],
            lambda s: F.struct(
                (s["begin"] + by).alias("begin"), (s["end"] + by).alias("end"),
                s["value"].alias("value"), s["before"].alias("before"), s["after"].alias("after"),
            ),
        )

    return F.flatten(F.zip_with(parts, begins, moved))


def _number_before(spans: str, bound: Column, field: str) -> Column:
    """How many of the spans, which are in order, have ``field`` below a bound:
    by halving, in as many steps as a number of spans can have bits."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(STEPS))])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: at + F.when(F.get(spans, at + step - 1)[field] < bound, step).otherwise(0),
    )


#: Bits of the largest number of spans of one kind in a text.
STEPS = 26


def _described(kind: str, exact: bool):
    """A function that turns a placed match into a candidate with its votes."""

    def describe(span: Column) -> Column:
        value = span["value"]
        digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
        marks = F.length(F.regexp_replace(value, r"[\p{L}\p{N}]", ""))
        base = _valid(kind, value) if exact else F.lit(False)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), span["begin"].alias("begin"),
            span["end"].alias("end"), F.lit(exact).alias("exact"), base.alias("base"),
            *_votes(kind, exact, value, span["before"], span["after"]),
            F.least(digits, F.lit(20)).alias("digits"),
            F.least(F.length(value), F.lit(40)).alias("size"),
            F.least(marks, F.lit(8)).alias("marks"),
        )

    return describe


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: every candidate of each text, with its votes.

    One row per input row, no shuffle; rows that repeat and null ids are rows
    like others, and only the two named columns are read. A span has kind (its
    number), begin, end (code points, end exclusive), ``exact`` (which of the two
    patterns), ``base`` (a valid match of an exact one), the labelers' votes (1,
    0 or -1) and its shape. Null and empty texts have none. Texts are read whole,
    and the work grows with the number of matches, however long a text is.
    """
    text = F.col("text")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    sources = [(k, e) for e in (True, False) for k in KINDS]
    found, zipped, parts, placed, spans = [["doc_id"] for _ in range(4)] + [[]]
    for kind, exact in sources:
        name = f"{kind}_{'exact' if exact else 'loose'}"
        hits, gaps = _matches(text, (EXACT if exact else LOOSE)[kind], NEEDS[kind][0 if exact else 1](text))
        found += [hits.alias(f"{name}_hits"), gaps.alias(f"{name}_gaps")]
        # A column for each step: an expression inside a lambda would be
        # evaluated again for every element.
        zipped.append(_zipped(f"{name}_hits", f"{name}_gaps").alias(name))
        parts.append(_stretches(name).alias(name))
        spot = _placed(name)
        if exact and kind == "card":
            # Short numbers are no candidates, only ones of a card's length are.
            spot = F.filter(
                spot, lambda s: F.length(F.regexp_replace(s["value"], "[^0-9]", "")).between(12, 19)
            )
        placed.append(spot.alias(name))
        spans.append(F.transform(name, _described(kind, exact)))
    for step in (found, zipped, parts, placed):
        rows = rows.select(*step)
    return rows.select("doc_id", F.concat(*spans).alias("spans"))


def clear_spans(stored: DataFrame) -> DataFrame:
    """The base spans, and of the others those that overlap none of them.

    Base spans of one kind are in order and do not overlap, so the last one that
    begins before a span's end is the only one of its kind to be looked at.
    """
    names = [f"base_{kind}" for kind in KINDS]

    def of_kind(kind: int) -> Column:
        return F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))

    sides = [of_kind(kind) for kind in range(len(KINDS))]
    split = stored.select("doc_id", "spans", *[side.alias(n) for n, side in zip(names, sides, strict=True)])

    def hit(span: Column, name: str) -> Column:
        last = F.get(name, _number_before(name, span["end"], "begin") - 1)
        return (F.size(name) > 0) & F.coalesce(last["end"] > span["begin"], F.lit(False))

    def clear(span: Column) -> Column:
        touched = reduce(lambda a, b: a | b, [hit(span, name) for name in names])
        return span["base"] | ~touched

    return split.select("doc_id", F.filter("spans", clear).alias("spans"))


@dataclass
class Reliability:
    """Per kind: the share of true spans, and for every labeler the chance of
    each vote given that a span is true, or false."""

    share: dict[int, float]
    chance: dict[int, list[dict[int, tuple[float, float]]]]

    def log_odds(self, kind: int) -> tuple[float, list[dict[int, float]]]:
        p = self.share[kind]
        ratios = [{v: math.log(t / f) for v, (t, f) in votes.items()} for votes in self.chance[kind]]
        return math.log(p / (1 - p)), ratios


def estimate(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> Reliability:
    """Expectation-maximisation over (kind, votes, count), at most 3 to the
    number of labelers rows per kind. It starts from the mean vote; counts are
    smoothed by one, so no labeler becomes certain."""
    share, chance = {}, {}
    for kind in sorted({k for k, _, _ in patterns}):
        own = [(votes, n) for k, votes, n in patterns if k == kind]
        truth = [1 / (1 + math.exp(-1.5 * sum(votes))) for votes, _ in own]
        for _ in range(rounds):
            total = sum(n for _, n in own)
            true = sum(t * n for t, (_, n) in zip(truth, own, strict=True))
            p = (true + 1) / (total + 2)
            table = []
            for i in range(len(LABELERS)):
                votes = {}
                for v in (-1, 0, 1):
                    yes = sum(t * n for t, (w, n) in zip(truth, own, strict=True) if w[i] == v)
                    all_ = sum(n for w, n in own if w[i] == v)
                    votes[v] = ((yes + 1) / (true + 3), (all_ - yes + 1) / (total - true + 3))
                table.append(votes)
            share[kind], chance[kind] = p, table
            truth = []
            for votes, _ in own:
                odds = math.log(p / (1 - p))
                odds += sum(math.log(table[i][v][0] / table[i][v][1]) for i, v in enumerate(votes))
                truth.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return Reliability(share, chance)


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _posterior(known: Reliability, at) -> Column:
    """Estimated chance that a span is true, as an expression over its votes."""
    odds = None
    for kind in known.share:
        prior, ratios = known.log_odds(kind)
        total = F.lit(prior)
        for name, ratio in zip(LABELERS, ratios, strict=True):
            total += F.when(at(name) == 1, ratio[1]).when(at(name) == -1, ratio[-1]).otherwise(ratio[0])
        odds = F.when(at("kind") == kind, total) if odds is None else odds.when(at("kind") == kind, total)
    return _sigmoid(odds)


def _features(at) -> list[Column]:
    """A constant and the votes for each kind apart, and the shape."""
    found = []
    for kind in range(len(KINDS)):
        of_kind = at("kind") == kind
        found.append(F.when(of_kind, 1.0).otherwise(0.0))
        found += [F.when(of_kind, at(name).cast("double")).otherwise(0.0) for name in LABELERS]
    return found + [at(name).cast("double") / 10 for name in SHAPES]


def train(stored: DataFrame):
    """The span classifier, as a function from a span to its probability.

    Candidates are counted by kind, votes and shape, all bounded, before they
    move. None where there are no candidates.
    """
    spans = stored.select(F.explode("spans").alias("s")).select("s.*")
    counted = materialize(spans.groupBy("kind", *LABELERS, *SHAPES).agg(F.count("*").alias("n")))
    rows = counted.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).collect()
    if not rows:
        return None
    known = estimate(sorted((r.kind, tuple(r[name] for name in LABELERS), r.n) for r in rows))
    truth = _posterior(known, F.col)
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * truth).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - truth)).alias("weight")),
    )
    rows = counted.select(F.array(*_features(F.col)).alias("x"), F.explode(sides).alias("side"))
    total = float(counted.agg(F.sum("n")).first()[0])
    examples = rows.select(
        array_to_vector("x").alias("features"), "side.label", (F.col("side.weight") / total).alias("weight")
    ).where("weight > 0")
    learner = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False)
    model = learner.fit(examples)
    weights, constant = list(model.coefficients), model.intercept

    def probability(span: Column) -> Column:
        terms = _features(lambda name: span[name])
        parts = (t * float(w) for t, w in zip(terms, weights, strict=True))
        return _sigmoid(sum(parts, F.lit(float(constant))))

    return probability


def find_pii(
    docs: DataFrame, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, base, added``: arrays of (begin, kind, end) by begin, then kind.

    ``base`` holds the valid matches of the exact patterns, ``added`` further
    spans that the classifier gives at least ``threshold`` and that overlap no
    base span (of added ones that overlap, the likelier stays). One row per
    input row; the texts are read once and not shuffled, candidates are stored
    in between. Texts without candidates, empty and null ones have empty arrays.
    """
    stored = materialize(clear_spans(candidates(docs, id_col, text_col)))
    probability = train(stored)

    def short(span: Column) -> Column:
        return F.struct(span["begin"].alias("begin"), span["kind"].alias("kind"), span["end"].alias("end"))

    base = F.filter("spans", lambda s: s["base"])
    if probability is None:
        split = stored.select("doc_id", base.alias("base"), F.filter("spans", lambda s: F.lit(False)).alias("added"))
    else:
        scored = F.transform(
            F.filter("spans", lambda s: ~s["base"]),
            lambda s: F.struct(
                probability(s).alias("p"), s["begin"].alias("begin"), s["end"].alias("end"),
                s["kind"].alias("kind"), s["exact"].alias("exact"),
            ),
        )
        likely = F.filter("scored", lambda s: s["p"] >= threshold)
        split = stored.select("doc_id", base.alias("base"), scored.alias("scored"))
        split = split.select("doc_id", "base", "scored", likely.alias("likely"))
        split = _best_of_overlapping(split)
    return split.select(
        "doc_id",
        F.array_sort(F.transform("base", short)).alias("base"),
        F.array_sort(F.transform("added", short)).alias("added"),
    )


def _best_of_overlapping(split: DataFrame) -> DataFrame:
    """Adds ``added``: the spans of ``likely`` that no likelier span overlaps.

    Spans of one pattern are in order and do not overlap, so those that touch a
    span are neighbours, and halving finds the first and the last of them.
    """
    names = {f"likely_{k}_{e}": (k, e) for k in range(len(KINDS)) for e in (True, False)}

    def of_pattern(kind: int, exact: bool) -> Column:
        return F.filter("likely", lambda s: (s["kind"] == kind) & (s["exact"] == F.lit(exact)))

    parts = [of_pattern(*pattern).alias(name) for name, pattern in names.items()]

    def beaten(a: Column, name: str) -> Column:
        first = _number_before(name, a["begin"] + 1, "end")
        touching = F.slice(name, first + 1, F.greatest(_number_before(name, a["end"], "begin") - first, F.lit(0)))
        # Of equals, the earlier is better, then the lower kind.
        return F.exists(
            touching,
            lambda b: (b["p"] > a["p"])
            | ((b["p"] == a["p"]) & (F.struct(b["begin"], b["kind"]) < F.struct(a["begin"], a["kind"]))),
        )

    def kept(a: Column) -> Column:
        return ~reduce(lambda x, y: x | y, [(F.size(n) > 0) & beaten(a, n) for n in names])

    return split.select("*", *parts).select(*split.columns, F.filter("likely", kept).alias("added"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def shown(s: Column) -> Column:
        return F.concat_ws(":", F.get(names, s["kind"]), s["begin"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, shown), ",")
