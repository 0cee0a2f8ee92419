"""Secrets: fixed formats, and windows of high Shannon entropy.

Any run of 20 or more key characters with a digit is a candidate. A window of 20
characters slides over it; the counts of its characters are kept up as one
enters and one leaves, and with them the sum of c * log2(c), from which the
entropy follows. The entropy that counts as high depends on the run's character
class. Runs that match the allow list are not reported; fixed formats always are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.llm.spans import SPAN, apart, as_spans, joined, masked, ordered, with_matches

KINDS = ["assign", "access", "hex", "entropy"]

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Character class: pattern of the whole run, and the bits a window must have. The first that matches holds.
CLASSES = [
    ("digits", r"^[0-9]+$", float("inf")),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
]
#: Runs that are no secrets: placeholders, sequences, UUIDs, dates, one character again and again.
ALLOWED = [
    r"(?i)example|sample|placeholder|dummy|changeme|your[_-]",
    r"(?i)0123456789|abcdefgh|x{6,}|deadbeef",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]",
    r"^(.)\1+$",
]


def window_entropy(run: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of ``window`` characters in a row (of the whole if it is shorter)."""
    letters = F.lit(ALPHABET)
    code = lambda i: F.instr(letters, F.substring(run, i, F.lit(1))) - 1
    part = lambda c: F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def step(acc: Column, i: Column) -> Column:
        new = code(i)
        old = F.when(i > window, code(i - window)).otherwise(F.lit(-1))
        moved = F.struct(new.alias("new"), old.alias("old"))
        # Entering and leaving by the same character changes nothing.
        enters, leaves = F.get(acc["n"], moved["new"]), F.get(acc["n"], F.greatest(moved["old"], F.lit(0)))
        same = moved["new"] == moved["old"]
        gain = part(enters + 1) - part(enters)
        loss = F.when(moved["old"] >= 0, part(leaves) - part(leaves - 1)).otherwise(F.lit(0.0))
        total = acc["sum"] + F.when(same, F.lit(0.0)).otherwise(gain - loss)
        counts = F.transform(acc["n"], lambda c, k: c + (k == moved["new"]).cast("int") - (k == moved["old"]).cast("int"))
        size = F.least(i, F.lit(window)).cast("double")
        full = (i >= window) | (i == F.length(run))
        bits = F.when(full, F.log2(size) - total / size).otherwise(F.lit(0.0))
        return F.struct(counts.alias("n"), total.alias("sum"), F.greatest(acc["best"], bits).alias("best"))

    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
    return F.when(F.length(run) > 0, F.aggregate(F.sequence(F.lit(1), F.length(run)), start, step, lambda a: a["best"])) \
        .otherwise(F.lit(0.0))


def high_entropy(run: Column, window: int = WINDOW) -> Column:
    """Whether a run's class asks for no more bits than its best window has, and no allowed pattern matches."""
    bits = F.lit(math.inf)
    for _, pattern, least in reversed(CLASSES):
        bits = F.when(run.rlike(pattern), F.lit(least)).otherwise(bits)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(pattern)
    return run.rlike("[0-9]") & ~allowed & (window_entropy(run, window) >= bits)


def scan(docs: DataFrame, *, text: str = "text", key: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """One row per document with the secrets in its whole text.

    Returns ``key`` and the columns ``keep`` as they are, ``base`` and ``found``
    (spans (start, kind, end) in code points, by start, then kind; ``kind`` is a
    place in ``KINDS``). ``base`` has the fixed formats: an assignment to a name
    like ``token`` with six or more characters, an access id, 24 or more hex digits
    in a row. ``found`` adds runs of high entropy that overlap none of them. A null
    or empty text has no spans; rows are judged one by one, so repeated rows and
    null keys do not matter. No shuffle, no join.
    """
    keep = [key] + [c for c in keep or [] if c != key]
    df = docs.select(*(F.col(f"`{c}`") for c in keep), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    t = F.col("_text")
    signed = t.contains("=") | t.contains(":")
    df = with_matches(df, "_text", {
        "_assign": (ASSIGN, signed), "_access": (ACCESS, t.contains("AKIA")),
        "_hex": (HEX, t.rlike("[0-9a-f]{24}")), "_run": (RUN, t.rlike("[0-9]"))})
    df = df.withColumn("_assign", F.filter("_assign", lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 1)) >= 6))
    df = df.withColumn("base", ordered(as_spans("_assign", 0), as_spans("_access", 1), as_spans("_hex", 2))) \
        .withColumn("_run", F.filter("_run", lambda m: high_entropy(m["text"])))
    return df.withColumn("found", ordered(F.col("base"), apart(as_spans("_run", 3), F.col("base")).cast(SPAN))) \
        .select(*(F.col(f"`{c}`") for c in keep), "base", "found")


def digest(spans: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, digest and list of the spans of ``scan``."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return spans.select(F.col(f"`{key}`"), n(0), n(1), n(2), F.sha2(joined("base", KINDS), 256).alias("base_sha256"),
                        joined("found", KINDS).alias("spans"))


def redacted(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows with every secret found replaced by ``<SECRET>``; a null text stays null."""
    df = scan(docs.withColumn("_row_text", F.col(f"`{text}`")), text="_row_text", key="_row_text", keep=docs.columns)
    return df.select(*(masked(F.col(f"`{text}`"), "found", ["<SECRET>"] * len(KINDS)).alias(text) if c == text
                       else F.col(f"`{c}`") for c in docs.columns))
