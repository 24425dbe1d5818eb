"""Personal data: fixed formats, and more spans from generators judged by boosted trees.

The base formats are found by patterns and checked (ranges, digit counts, Luhn). They miss what
stands next to other digits, as a pattern then takes both. High-recall generators propose spans of
any extent, overlapping ones too, and what a kind's check refuses is no proposal. Trees learn from
shape and context, never from what the checks look at: proposals that are base spans are positive;
negative are decoys, which look alike and are something else: numbers that a check refuses, and for
addresses a word before a dotted name with no at-sign at all. The other proposals get a probability. A
threshold per kind, calibrated on held-out proposals, selects what is added. All steps are column
expressions and MLlib.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import broadcast_if_light, hidden, or_empty, restored, set_checkpoint_dir, stored

KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"

#: The base formats. A match can only begin where its first run of characters begins or the match
#: before has ended, so each says so, and repeats do not give back what they took: the same
#: matches, in time that is linear in the text.
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text with a match passes.
HAS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}

#: Generators: kind, pattern, test.
GENERATORS = (
    ("email", rf"(?<!{LOCAL}){LOCAL}{{1,64}}@{LABEL}{{1,63}}(?:\.{LABEL}{{1,63}}){{1,8}}", "@"),
    ("email", rf"(?<!{LOCAL}){LOCAL}{{1,64}}+ ?[(\[]at[)\]] ?{LABEL}{{1,63}}+"
              rf"(?: ?(?:\.|[(\[]dot[)\]]) ?{LABEL}{{1,63}}){{0,3}} ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z]{{2,24}}(?!{LABEL})",
     r"[(\[]at[)\]]"),
    ("ip", r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?!\.?[0-9])", r"[0-9]\.[0-9]"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])", r"[0-9]{13}"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])", r"[0-9]{4}[\x20-][0-9]{4}"),
    ("card", r"(?<![0-9])[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])", r"[\x20-][0-9]{6}[\x20-]"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){2,3}(?![0-9])",
     r"\+[0-9]"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){2}(?![0-9])",
     r"\+[0-9]"),
    ("phone", r"(?<![0-9+(])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
     r"[0-9]{3}[\x20.-][0-9]{4}"),
)
#: Decoys: matches are negative examples of their kind, whatever they are.
DECOYS = (
    ("email", rf"(?<!{LOCAL}){LOCAL}{{1,64}}+ {LABEL}{{1,63}}+(?:\.{LABEL}{{1,63}}){{0,3}}\.[A-Za-z]{{2,24}}(?!{LABEL})",
     r"[A-Za-z0-9-]\.[A-Za-z]{2}"),
)
#: A wrong check digit is nine times as frequent as a right one among numbers that are no cards, so a
#: refused number stands for a ninth of one that passes by chance.
STANDS_FOR = {"card": 1 / 9}
#: Base addresses that make the last part of their names a known one.
KNOWN_ENDINGS = 5
#: Words before a span that speak for or against it.
FOR, AGAINST = "mail|phone|tel|call|fax|mobil|card|visa|credit|ip|addr|contact|server|host", \
    "token|key|secret|passw|hash|sha|md5|uuid|version|isbn|order|serial"
CONTEXT, BLOCK = 24, 256
#: Added spans of all texts that may be broadcast, each text counting for one at least.
BROADCAST_SPANS = 200_000

SPAN = "struct<start: int, kind: int, end: int, match: string>"
FOUND = SPAN[:-1] + ", before: string, after: string>"


@dataclass(frozen=True)
class Settings:
    """About ``max_rows`` labelled proposals at most train, dealt evenly over the kinds and labels;
    all others calibrate. A kind gets the lowest threshold at which ``precision`` of the held-out
    proposals are positive. Where the whole table has too few to prove any (16 at 0.98, all of them
    right), it gets ``unproven``, provided that none of them is wrong there and both labels of its
    kind were learnt from."""

    max_rows: int = 20_000
    trees: int = 20
    depth: int = 4
    precision: float = 0.98
    thresholds: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
    unproven: float = 0.95


def with_matches(df: DataFrame, text: str, name: str, kind: int, pattern: str, test: str) -> DataFrame:
    """``df`` with all matches of ``pattern`` in ``text`` as an array of spans in code points, each
    with the characters right ``before`` and ``after`` it, up to the next match.

    Offsets are running sums of the lengths of the matches and of what lies between them, taken per
    block so that texts with very many matches stay near linear. Each step is a column that the
    next one names twice, so that the optimiser does not move it into a loop.
    """
    has = F.contains(text, F.lit(test)) if test == "@" else F.rlike(text, F.lit(test))
    between, found, step, total, base = (f"_{name}_{s}" for s in ("between", "found", "step", "total", "base"))
    number = F.size(found)
    blocks = F.sequence(F.lit(0), F.floor((number - 1) / BLOCK).cast("int"))

    def added(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def some(of: str, value: Column) -> Column:
        return F.when(F.size(of) > 0, value)

    def span(i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        gap, match = F.get(between, i), F.get(found, i)
        start = F.get(base, block) + F.length(gap) + added(
            F.slice(step, block * BLOCK + 1, i - block * BLOCK))
        return F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(match)).alias("end"),
            match.alias("match"), F.right(gap, F.lit(CONTEXT)).alias("before"),
            F.left(F.get(between, i + 1), F.lit(2)).alias("after"))

    df = df.withColumns({
        between: F.when(has, F.split(text, pattern, -1)),
        found: F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))})
    df = df.withColumn(step, some(found, F.zip_with(
        F.slice(between, F.lit(1), F.size(found)), found, lambda a, b: F.length(a) + F.length(b))))
    df = df.withColumn(total, some(step, F.transform(
        blocks, lambda b: added(F.slice(step, b * BLOCK + 1, F.lit(BLOCK))))))
    df = df.withColumn(base, some(total, F.transform(blocks, lambda b: added(F.slice(total, F.lit(1), b)))))
    spans = some(base, F.transform(F.sequence(F.lit(0), number - 1), span))
    none = F.array().cast(f"array<{FOUND}>")
    return df.withColumn(name, F.coalesce(spans, none)).drop(between, found, step, total, base)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digit string passes the Luhn check."""
    turned = F.reverse(number)

    def add(total: Column, i: Column) -> Column:
        digit = F.coalesce(F.substring(turned, i, F.lit(1)).try_cast("int"), F.lit(0))
        d = digit * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    sum_ = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1))), F.lit(0), add)
    return F.coalesce(sum_ % 10 == 0, F.lit(False))


def in_range(match: Column) -> Column:
    """Whether all parts between dots are at most 255."""
    return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
        F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255))


def passes(kind: str, match: Column) -> Column:
    number = F.length(digits(match))
    if kind == "ip":
        return in_range(match)
    if kind == "card":
        return number.between(14, 19) & luhn(digits(match))
    if kind == "phone":
        return number.between(10, 15)
    return F.lit(True)


def passes_as(kind: str):
    return lambda span: passes(kind, span["match"])


def of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def plain(span: Column) -> Column:
    return F.struct(*[span[f].alias(f) for f in ("start", "kind", "end", "match")])


def with_base(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_base``, the spans of the base formats by start and kind."""
    names = [f"_b{i}" for i in range(len(KINDS))]
    for i, kind in enumerate(KINDS):
        df = with_matches(df, text, names[i], i, BASE[kind], HAS[kind])
    good = [F.transform(F.filter(n, passes_as(kind)), plain) for n, kind in zip(names, KINDS)]
    return df.withColumn("_base", F.array_sort(F.concat(*good))).drop(*names)


def proposals(docs: DataFrame) -> DataFrame:
    """Proposed spans ``s`` of the texts (``_key``, ``text``), once per distinct text, with features,
    ``label``: 1 for a base span, 0 for a decoy, null where the base formats say nothing and the check
    of the kind passes, and ``ending``, the last part of an address's name. Proposals that touch a
    base span without being one are left out."""
    def marked(spans: str, label, proposed: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(
            plain(s).alias("s"), s["before"].alias("before"), s["after"].alias("after"),
            label(s).alias("label"), F.lit(proposed).alias("proposed")))

    df, parts = docs, []
    for i, kind in enumerate(KINDS):
        df = with_matches(df, "text", f"_b{i}", i, BASE[kind], HAS[kind])
        parts.append(marked(f"_b{i}", lambda s, kind=kind: base_label(kind, s["match"]), False))
    for i, (kind, pattern, test) in enumerate(GENERATORS):
        df = with_matches(df, "text", f"_g{i}", KINDS.index(kind), pattern, test)
        parts.append(marked(f"_g{i}", lambda s: F.lit(None).cast("int"), True))
    for i, (kind, pattern, test) in enumerate(DECOYS):
        df = with_matches(df, "text", f"_d{i}", KINDS.index(kind), pattern, test)
        parts.append(marked(f"_d{i}", lambda s: F.lit(0), True))
    # An outer explode, as a filter derived from an inner one would compute the spans once more.
    rows = df.select("_key", F.inline_outer(F.concat(*parts))).where("s is not null")
    rows = rows.groupBy("_key", "s").agg(
        F.max("label").alias("label"), F.max("proposed").alias("proposed"),
        F.max("before").alias("_before"), F.max("after").alias("_after"))
    # Base spans before and after a span, over growing frames in either direction.
    text = Window.partitionBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    is_base = F.col("label") == 1
    rows = rows.withColumns({
        "_reach": F.max(F.when(is_base, F.col("s.end"))).over(text.orderBy("s")),
        "_ahead": F.min(F.when(is_base, F.col("s.start"))).over(text.orderBy(F.desc("s")))})
    touched = (F.coalesce("_reach", F.lit(0)) > F.col("s.start")) | F.coalesce(
        F.col("_ahead") < F.col("s.end"), F.lit(False))
    match, number = F.col("s.match"), digits(F.col("s.match"))
    checks = F.get(F.array(*[passes(kind, match) for kind in KINDS]), F.col("s.kind"))
    rows = rows.where(F.col("proposed") & (F.coalesce(is_base, F.lit(False)) | ~touched) & (
        F.col("label").isNotNull() | checks))
    name = F.regexp_replace(match, r" ?[(\[]dot[)\]] ?", ".")
    local, domain = F.regexp_extract(name, rf"^({LOCAL}+)", 1), F.regexp_extract(name, r"([A-Za-z0-9.-]+)$", 1)
    parts_ = F.split(domain, r"\.")
    is_kind = {k: F.col("s.kind") == i for i, k in enumerate(KINDS)}
    # What a kind's check looks at says nothing here: digits of phones, the numbers of an address.
    shaped = is_kind["card"]

    def address(value: Column) -> Column:
        return F.when(is_kind["email"], value)

    def share(pattern: str) -> Column:
        return F.length(match) - F.length(F.regexp_replace(match, pattern, ""))

    def true(test: Column) -> Column:
        return test.cast("int")

    columns = {
        **{f"is_{k}": true(F.col("s.kind") == i) for i, k in enumerate(KINDS)},
        "length": F.when(shaped, F.length(match)),
        "separators": F.when(shaped, share(r"[\x20.()-]")),
        "first": F.when(shaped, F.substring(number, 1, 1).try_cast("int")),
        "local_length": address(F.length(local)),
        "local_digits": address(F.length(digits(local))),
        "local_signs": address(F.length(F.regexp_replace(local, "[A-Za-z0-9]", ""))),
        "local_capital": address(true(F.rlike(local, F.lit("^[A-Z]")))),
        "name_parts": address(F.size(parts_)),
        "name_first": address(F.length(F.get(parts_, F.lit(0)))),
        "name_digits": address(F.length(digits(domain))),
        "letter_before": true(F.rlike("_before", F.lit(r"\p{L}$"))),
        "digit_before": true(F.rlike("_before", F.lit(r"[0-9][\x20.-]?$"))),
        "quote_before": true(F.rlike("_before", F.lit(r"[\"'=:/_]$"))),
        "letter_after": true(F.rlike("_after", F.lit(r"^\p{L}"))),
        "digit_after": true(F.rlike("_after", F.lit(r"^[\x20.-]?[0-9]"))),
        "words_for": true(F.rlike("_before", F.lit(rf"(?i)\b(?:{FOR})"))),
        "words_against": true(F.rlike("_before", F.lit(rf"(?i)(?:{AGAINST})"))),
    }
    ending = address(F.lower(F.element_at(parts_, -1))).alias("ending")
    return rows.select("_key", "s", "label", ending, *[
        F.coalesce(c, F.lit(0)).cast("double").alias(n) for n, c in columns.items()])


def base_label(kind: str, match: Column) -> Column:
    """1 for a base span, 0 for a match that the check refuses; null for numbers that are too short or
    too long for a card, as length alone would tell those."""
    good = passes(kind, match)
    if kind == "card":
        return F.when(F.length(digits(match)).between(14, 19), good.cast("int"))
    return good.cast("int")


def with_known_endings(rows: DataFrame) -> DataFrame:
    """``rows`` with ``known_ending``: 1 if at least KNOWN_ENDINGS base addresses of the whole table, so
    others than the row's own too, end in the same last part."""
    email = F.col("s.kind") == KINDS.index("email")
    known = rows.where(email & (F.col("label") == 1)).groupBy("ending").count().where(
        F.col("count") >= KNOWN_ENDINGS).select("ending", F.lit(1.0).alias("known_ending"))
    known = broadcast_if_light(stored(known), "1", BROADCAST_SPANS)
    addresses = rows.where(email).join(known, "ending", "left").fillna(0.0, ["known_ending"])
    return addresses.unionByName(rows.where(~email).withColumn("known_ending", F.lit(0.0)))


FEATURES = [
    *(f"is_{k}" for k in KINDS), "length", "separators", "first", "local_length", "local_digits",
    "local_signs", "local_capital", "name_parts", "name_first", "name_digits", "known_ending",
    "letter_before", "digit_before", "quote_before", "letter_after", "digit_after", "words_for",
    "words_against"]


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def probability(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(assembled(rows))
    return scored.withColumn("chance", vector_to_array("probability")[1])


def quotas(counts: dict, most: int) -> dict:
    """How many of each group's ``counts`` to take, ``most`` in all at most: small groups whole,
    the others alike."""
    out, left = {}, most
    for i, (group, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[group] = min(n, left // (len(counts) - i))
        left -= out[group]
    return out


def calibrated(counts: dict, weights: dict, learnt: set, settings: Settings) -> dict[int, float]:
    """The threshold of each kind that has one. ``counts`` holds per kind and threshold the held-out
    positives and negatives that reach it, ``weights`` how many rows a negative and a positive stand
    for, ``learnt`` the kinds with a positive to learn from."""
    chosen = {}
    for kind in learnt:
        of_kind = counts.get(kind, {})
        unit = max(weights[kind])
        for t in settings.thresholds:
            hits, wrong = of_kind.get(t, (0, 0))
            hits, wrong = hits * weights[kind][1] / unit, wrong * weights[kind][0] / unit
            # A third of a case on either side, so that few cases prove little.
            if (hits + 1 / 3) / (hits + wrong + 2 / 3) >= settings.precision:
                chosen[kind] = t
                break
        else:
            hits, wrong = of_kind.get(settings.unproven, (0, 0))
            # Too few to prove any threshold, and none of them is wrong.
            if not wrong and (hits + 1 / 3) / (hits + 2 / 3) < settings.precision:
                chosen[kind] = settings.unproven
    return chosen


def judge(rows: DataFrame, settings: Settings) -> tuple[GBTClassificationModel | None, dict[int, float]]:
    """Trees learnt from labelled proposals, and the threshold of each kind that has one.

    A quarter of the labelled proposals never trains. Of the others each kind and label trains with
    its quota, so that rare ones keep theirs. All that do not train calibrate, in one aggregate;
    there a row stands for as many as its kind and label lost to the training."""
    kind, draw = F.col("s.kind"), F.col("_draw")
    labelled = rows.where("label is not null").withColumn("_draw", F.xxhash64("_key", "s"))
    may_train = F.pmod(draw, F.lit(4)) > 0
    numbers = {(r[0], r[1]): r[2:] for r in labelled.groupBy(kind.alias("kind"), "label").agg(
        F.count("*"), F.count_if(may_train)).collect()}
    trainable = {group: n[1] for group, n in numbers.items() if n[1]}
    if len({label for _, label in trainable}) < 2:
        return None, {}
    part = {group: n / trainable[group] for group, n in quotas(trainable, settings.max_rows).items()}
    place = draw / F.lit(float(1 << 64)) + 0.5
    limit = F.lit(0.0)
    for (k, label), share in part.items():
        limit = F.when((kind == k) & (F.col("label") == label), F.lit(
            2.0 if share >= 1 else share)).otherwise(limit)
    trains = may_train & (place < limit)
    sample = stored(labelled.where(trains))
    taken = {(r[0], r[1]): r[2] for r in sample.groupBy(
        kind.alias("kind"), "label").agg(F.count("*")).collect()}
    if len({label for _, label in taken}) < 2:
        return None, {}
    model = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=settings.trees, maxDepth=settings.depth,
        stepSize=0.3, seed=4).fit(assembled(sample))
    levels = sorted({*settings.thresholds, settings.unproven})
    found = probability(model, labelled.where(~trains)).groupBy(kind.alias("kind")).agg(*[
        F.count_if((F.col("chance") >= t) & (F.col("label") == label))
        for t in levels for label in (1, 0)]).collect()
    counts = {r[0]: {t: (r[1 + 2 * i], r[2 + 2 * i]) for i, t in enumerate(levels)} for r in found}

    def weight(group: tuple[int, int]) -> float:
        n, held = numbers.get(group, (0, 0))[0], numbers.get(group, (0, 0))[0] - taken.get(group, 0)
        return n / held if held else 1.0

    learnt = {k for k, label in taken if label == 1 and (k, 0) in taken}
    weights = {k: (weight((k, 0)) * STANDS_FOR.get(KINDS[k], 1.0), weight((k, 1))) for k in learnt}
    return model, calibrated(counts, weights, learnt, settings)


def find_spans(
    docs: DataFrame, text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (base and added), arrays of (start, kind, end,
    match) by start and kind; kinds are indexes into KINDS, offsets count code points.

    Null texts count as empty. An added span touches no base span. Rows of one text get the same
    spans, whatever else they hold; columns of these two names are replaced, all others kept. Where
    there is too little to learn from, nothing is added. An empty table gives an empty one.
    """
    set_checkpoint_dir(docs.sparkSession)
    docs, at, names = hidden(docs, "base_spans", "spans")
    text = at[text]
    keyed = docs.withColumn("_key", F.md5(text))
    rows = with_known_endings(stored(proposals(keyed.where("_key is not null").select(
        "_key", F.col(text).alias("text")))))
    model, thresholds = judge(rows, settings)
    out = with_base(keyed.withColumn("_text", or_empty(F.col(text))), "_text").drop("_text")
    added = F.array().cast(f"array<{SPAN}>")
    if thresholds:
        least = F.get(F.array(*[F.lit(thresholds.get(k, 2.0)) for k in range(len(KINDS))]), F.col("s.kind"))
        # Of two added spans of a kind the one inside the other goes.
        line = Window.partitionBy("_key", "s.kind").orderBy("s.start", F.desc("s.end")).rowsBetween(
            Window.unboundedPreceding, -1)
        inside = F.max("s.end").over(line) >= F.col("s.end")
        more = (
            probability(model, rows.where("label is null")).where(F.col("chance") >= least)
            .withColumn("_inside", F.coalesce(inside, F.lit(False))).where("not _inside")
            .groupBy("_key").agg(F.collect_list("s").alias("_added")))
        more = broadcast_if_light(stored(more), "1 + size(_added)", BROADCAST_SPANS)
        out = out.join(more, "_key", "left")
        added = F.coalesce("_added", added)
    return restored(out, names, F.col("_base").alias("base_spans"),
                    F.array_sort(F.concat("_base", added)).alias("spans"))


def redact(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets. A span that
    begins inside another one is part of it."""
    docs, at, names = hidden(docs)
    text = at[text]
    found = find_spans(docs, text, settings)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        name = F.get(F.array(*[F.lit(f"<{k}>") for k in KINDS]), s["kind"])
        inside = s["start"] < acc["at"]
        return F.struct(
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], kept, name)).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"))

    cut = F.aggregate("spans", start, add, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return restored(found.withColumn(text, cut), names)


def as_text(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
