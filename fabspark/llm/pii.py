"""Personal data: checked formats, and look-alikes found by boosted trees.

Generators of high recall propose overlapping spans: words with an at sign, runs
of digits with and without spaces. Format and neighbourhood of a candidate are
written as a few small features, together one number, its code. A pass over the
corpus counts for each code and kind how many candidates are a checked span of
that kind; gradient-boosted trees are fitted to these counts (there are at most
``MAX_CODES`` of them, whatever the corpus), without the feature by which the
checked format itself is told, so that they learn what else marks such a span.
Thresholds are calibrated on held-out documents to a given precision. A second
pass adds the candidates with accepted codes that overlap no checked span.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.llm.spans import SPAN, apart, as_spans, joined, masked, ordered, with_matches
from fabspark.session import settled

KINDS = ["email", "ip", "card", "phone"]
MARKS = ["<EMAIL>", "<IP>", "<CARD>", "<PHONE>"]

LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: Generators: words with an at sign, digits with inner spaces, digits without.
WORD = r"(?<![^\x00-\x20])[^\x00-\x20@]++@[^\x00-\x20]++"
SPACED = r"\(?[0-9][\x20().0-9-]{5,}[0-9]"
COMPACT = r"[0-9][().0-9-]{5,}[0-9]"
GENERATORS = [WORD, SPACED, COMPACT]

CONTEXT = 24
PRECISION = 0.9  # of accepted codes on held-out documents
MIN_SEEN = 20  # candidates that a threshold must rest on
FOLDS = 5  # one of them calibrates
MAX_CODES = 3 * 6 * 2 ** 10

CUES = {
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|whatsapp|sms)[^A-Za-z]*$",
    "card": r"(?i)(?:card|visa|credit|pay|iban|account)[^A-Za-z]*$",
    "ip": r"(?i)(?:ip|server|host|address|addr)[^A-Za-z]*$",
    "mail": r"(?i)(?:mail|contact|write|to)[^A-Za-z]*$",
}
FEATURES = ["generator", "digits", "luhn", "octets", "parens", "hyphen", "space", "dot", "glued_before",
            "glued_after", "cue", "domain"]
#: What the trees of a kind do not see: the mark by which its checked format is told.
HIDDEN = {"email": ("domain",), "ip": (), "card": (), "phone": ()}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _with_digits(matches: str) -> Column:
    """Matches with their digits, which are then cut out once."""
    return F.transform(matches, lambda m: m.withField("digits", _digits(m["text"])))


def _is_card(digits: Column) -> Column:
    return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)


def _octets(text: Column) -> Column:
    """Whether all parts between dots are at most 255; parts may have any length."""
    bare = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(text, r"\."), lambda p: (F.length(bare(p)) < 3)
                    | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))


def _checked(df: DataFrame) -> DataFrame:
    """Adds ``base``: the spans of checked formats in ``_text``."""
    t = F.col("_text")
    digit = t.rlike("[0-9]")
    df = with_matches(df, "_text", {"_email": (EMAIL, t.contains("@")), "_ip": (IP, digit & t.contains(".")),
                                    "_card": (CARD, digit), "_phone": (PHONE, t.contains("+"))})
    for k in ("_card", "_phone"):
        df = df.withColumn(k, _with_digits(k))
    df = df.withColumn("_ip", F.filter("_ip", lambda m: _octets(m["text"]))) \
        .withColumn("_card", F.filter("_card", lambda m: _is_card(m["digits"]))) \
        .withColumn("_phone", F.filter("_phone", lambda m: F.length(m["digits"]).between(9, 15)))
    return df.withColumn("base", ordered(*(as_spans(f"_{k}", i) for i, k in enumerate(KINDS)))) \
        .drop(*(f"_{k}" for k in KINDS))


def _proposed(df: DataFrame) -> DataFrame:
    """Adds ``proposed``: candidates of all generators, with the code of their features and the checks they pass."""
    t = F.col("_text")
    digit = t.rlike("[0-9]")
    guards = [t.contains("@"), digit, digit]
    df = with_matches(df, "_text", {f"_g{g}": (p, guards[g]) for g, p in enumerate(GENERATORS)}, CONTEXT)

    def coded(g: int) -> Column:
        def one(m: Column) -> Column:
            text, n = m["text"], F.length(m["digits"])
            cue = F.lit(False)
            for p in CUES.values():
                cue = cue | m["before"].rlike(p)
            card, ip = _is_card(m["digits"]), text.rlike(r"^[0-9]+(\.[0-9]+){3}$") & _octets(text)
            domain = text.rlike(r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
            size = sum(((n >= x).cast("int") for x in (7, 9, 12, 16, 20)), F.lit(0))
            code = F.lit(g) * 6 + size
            for b in (card, ip, *(text.contains(c) for c in "(- ."), m["before"].rlike(r"[A-Za-z0-9_=\"'/:]$"),
                      m["after"].rlike(r"^[A-Za-z0-9_\"'/:]"), cue, domain):
                code = code * 2 + b.cast("int")
            checked = (domain, ip, card & text.rlike(r"^[0-9](?:[\x20-]?[0-9])++$"),
                       m["before"].endswith("+") & n.between(9, 15))
            return F.struct(m["start"].alias("start"), m["end"].alias("end"), code.alias("code"),
                            sum((c.cast("int") * 2 ** i for i, c in enumerate(checked)), F.lit(0)).alias("checked"))
        return F.transform(_with_digits(f"_g{g}"), one)

    return df.withColumn("proposed", F.concat(*(coded(g) for g in range(len(GENERATORS))))) \
        .drop(*(f"_g{g}" for g in range(len(GENERATORS))))


def _unpacked(code: str = "code") -> list[Column]:
    """The features of a code."""
    bits = len(FEATURES) - 2
    rest = F.shiftright(code, bits)
    return [F.floor(rest / 6).cast("double").alias("generator"), (rest % 6).cast("double").alias("digits")] \
        + [(F.shiftright(code, bits - 1 - i) % 2).cast("double").alias(f) for i, f in enumerate(FEATURES[2:])]


@dataclass
class Model:
    """For each kind, the codes whose candidates are taken for it, and the calibrated threshold."""

    codes: dict[str, list[int]] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=dict)


def _texts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return docs.select(*(F.col(f"`{c}`") for c in keep), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))


def fit(docs: DataFrame, *, text: str = "text", key: str = "doc_id", precision: float = PRECISION) -> Model:
    """Count the candidates of the whole corpus by code, fit the trees, calibrate the thresholds.

    What reaches the driver are the codes, at most ``MAX_CODES`` of them. Without
    enough candidates of a kind, no code is accepted for it.
    """
    found = _proposed(_texts(docs, text, [key]).where(F.col("_text").rlike("[@0-9]")))
    rows = found.select((F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(FOLDS)) == 0).alias("held"),
                        F.explode("proposed").alias("c"))
    counts = settled(rows.select("held", "c.code", *(F.shiftright("c.checked", i).bitwiseAND(1).alias(k)
                                                     for i, k in enumerate(KINDS)))
                     .groupBy("held", "code").agg(F.count("*").alias("n"), *(F.sum(k).alias(k) for k in KINDS)), "codes")
    model = Model()
    table = counts.select("held", "code", "n", *KINDS, *_unpacked())
    for kind in KINDS:
        model.codes[kind], model.thresholds[kind] = [], 1.0
        yes, no = counts.where("NOT held").agg(F.sum(kind), F.sum(F.col("n") - F.col(kind))).first()
        if not yes or yes < MIN_SEEN:
            continue
        used = [f for f in FEATURES if f not in HIDDEN[kind]]
        points = VectorAssembler(inputCols=used, outputCol="features").transform(table)
        both = points.where("NOT held").select("features", F.explode(F.array(
            F.struct(F.lit(1.0).alias("label"), F.col(kind).cast("double").alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col(kind)).cast("double").alias("weight")))).alias("x")) \
            .select("features", "x.label", "x.weight").where("weight > 0").coalesce(1)
        if not no:  # every candidate is one: nothing to tell apart
            continue
        trees = GBTClassifier(maxIter=8, maxDepth=3, stepSize=0.4, weightCol="weight", seed=7, minInstancesPerNode=1) \
            .fit(both)
        scored = trees.transform(points).select("held", "code", "n", kind, vector_to_array("probability")[1].alias("p")) \
            .toPandas()
        held = scored[scored["held"]].groupby("p")[["n", kind]].sum().sort_index(ascending=False).cumsum()
        good = held[(held["n"] >= MIN_SEEN) & (held[kind] >= precision * held["n"])]
        if len(good):
            model.thresholds[kind] = float(good.index[-1])
            model.codes[kind] = sorted({int(c) for c in scored["code"][scored["p"] >= model.thresholds[kind]]})
    return model


def scan(docs: DataFrame, model: Model, *, text: str = "text", key: str = "doc_id",
         keep: list[str] | None = None) -> DataFrame:
    """One row per document with the personal data in its whole text.

    Returns ``key`` and the columns ``keep`` as they are, ``base`` and ``found``
    (spans (start, kind, end) in code points, by start, then kind; ``kind`` is a
    place in ``KINDS``). ``base`` has the checked formats, which always stay;
    ``found`` adds accepted candidates that overlap none of them, of overlapping
    ones the first. A null or empty text has no spans; rows are judged one by one,
    so repeated rows and null keys do not matter. No shuffle, no join.
    """
    keep = [key] + [c for c in keep or [] if c != key]
    df = _proposed(_checked(_texts(docs, text, keep)))
    more = F.array().cast(SPAN)
    for i, kind in enumerate(KINDS):
        codes = model.codes.get(kind, [])
        if codes:
            accepted = F.array(*(F.lit(c) for c in codes))
            more = F.concat(more, as_spans(_accepted(accepted, i), i))
    df = df.withColumn("_more", apart(F.sort_array(more), F.col("base")))
    first = F.aggregate("_more", F.array().cast(SPAN), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]), acc).otherwise(F.array_append(acc, s)))
    return df.withColumn("found", ordered(F.col("base"), first)) \
        .select(*(F.col(f"`{c}`") for c in keep), "base", "found")


def _accepted(codes: Column, kind: int) -> Column:
    """Candidates with one of the codes that are not themselves checked spans of the kind."""
    return F.filter("proposed", lambda c: F.array_contains(codes, c["code"])
                    & (F.shiftright(c["checked"], kind).bitwiseAND(1) == 0))


def digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, digest and list of the spans of ``scan``."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return spans.select(F.col(f"`{key}`"), *(n(k) for k in range(len(KINDS))),
                        F.sha2(joined("base", KINDS), 256).alias("base_sha256"), joined("found", KINDS).alias("spans"))


def redacted(docs: DataFrame, model: Model, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows with every span found replaced by its kind's mark; a null text stays null."""
    df = scan(docs.withColumn("_row_text", F.col(f"`{text}`")), model, text="_row_text", key=key, keep=docs.columns)
    return df.select(*(masked(F.col(f"`{text}`"), "found", MARKS).alias(text) if c == text else F.col(f"`{c}`")
                       for c in docs.columns))
