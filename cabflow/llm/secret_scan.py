"""Secret scanning with sliding-window Shannon entropy, in DataFrame functions only.

Fixed formats (an assignment to a secret-like name, an access key id, a long hex
run) are matched by pattern. Beyond them every run of 20 or more token characters
is a candidate: the entropy of each window of 20 characters is computed from
counts that are updated as the window slides, and the highest is compared with the
threshold of the candidate's character class. Look-alikes on the allow-list
(digits only, one-case words, UUIDs, paths, repeated or placeholder text) and
runs inside a span already found are suppressed.

Defined results: a null text is empty and has no spans; offsets are code points,
the end exclusive; a repeated row is reported each time; an empty table gives an
empty result. Other columns are ignored. Whole texts are scanned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, native_spans, spans_text

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
# Least entropy (bits a character) of a window of 20, by character class.
THRESHOLDS = {"hex": 3.1, "alnum": 3.7, "base64": 3.8}
# Candidates that are no secrets although they look random. No pattern repeats a group
# without a bound: Java's matcher would recurse once for each round.
ALLOWED = (
    r"^[0-9+/_=-]+$",  # digits and rules
    r"^[A-Za-z]?[a-z]+$|^[A-Z]+$",  # words of one case
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|placeholder|changeme|xxxxxx|abcdef|012345|123456",
)
NOT_A_SECRET = "|".join(f"(?:{p})" for p in ALLOWED)

_SPAN = "array<struct<start:int,no:int,end:int,kind:string>>"


def _weight(c: Column) -> Column:
    """c * log2(c), 0 for 0: a window's entropy is log2(n) - sum(weights) / n."""
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def max_window_entropy(run: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of any ``window`` characters of an ASCII run.

    The sum of the weights of all counts is carried along the run. A step changes two
    counts only, that of the character that comes and that of the one that goes, and
    these two are counted in the window itself: its cost does not depend on the run.
    """
    weight_sum = F.lit(math.log2(window))

    def of(codes: Column) -> Column:
        moves = F.transform(
            codes,
            lambda c, k: F.struct(
                c.alias("come"), F.when(k >= window, F.element_at(codes, k - window + 1)).alias("gone"), k.alias("k")
            ),
        )

        def step(acc: Column, x: Column) -> Column:
            inside = F.slice(codes, F.greatest(x["k"] - window + 1, F.lit(1)), F.least(x["k"], F.lit(window)))
            times = lambda c: F.size(F.filter(inside, lambda y: y == c))
            return F.struct(
                acc["total"].alias("total"),
                acc["best"].alias("best"),
                times(x["come"]).alias("had"),
                F.when(x["gone"].isNotNull(), times(x["gone"])).alias("lost"),
                (x["come"] == x["gone"]).alias("same"),
                x["k"].alias("k"),
            )

        def added(s: Column) -> Column:
            more = s["total"] + _weight(s["had"] + 1) - _weight(s["had"])
            total = F.when(s["same"], s["total"]).when(s["lost"].isNull(), more)
            total = total.otherwise(more + _weight(s["lost"] - 1) - _weight(s["lost"]))
            return F.struct(total.alias("total"), s["best"].alias("best"), s["k"].alias("k"))

        def judged(s: Column) -> Column:
            entropy = weight_sum - s["total"] / F.lit(float(window))
            full = s["k"] >= window - 1
            return F.struct(
                s["total"].alias("total"),
                F.when(full, F.greatest(s["best"], entropy)).otherwise(s["best"]).alias("best"),
            )

        zero = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        bound = lambda value, then: F.element_at(F.transform(F.array(value), then), 1)
        follow = lambda acc, x: bound(bound(step(acc, x), added), judged)
        return F.aggregate(moves, zero, follow, lambda acc: acc["best"])

    # The codes are computed once: an expression inside a lambda would be at each of its steps.
    characters = F.filter(F.split(run, ""), lambda c: c != "")
    return F.element_at(F.transform(F.array(F.transform(characters, lambda c: F.ascii(c))), of), 1)


def is_path(run: Column) -> Column:
    """Segments of letters and rules, at least one of them closed by a slash."""
    inner = F.substring(run, F.lit(2), F.length(run))
    return run.rlike(r"^[A-Za-z_/-]+$") & ~run.contains("//") & inner.contains("/")


def is_joined(run: Column) -> Column:
    """Words joined by one rule each."""
    return run.rlike(r"^[A-Za-z][A-Za-z_-]*[A-Za-z]$") & run.rlike("[_-]") & ~run.rlike("[_-][_-]")


def is_random(run: Column) -> Column:
    """Whether a candidate's entropy reaches the threshold of its class."""
    least = (
        F.when(run.rlike(r"^[0-9a-fA-F]+$"), F.lit(THRESHOLDS["hex"]))
        .when(run.rlike(r"^[A-Za-z0-9]+$"), F.lit(THRESHOLDS["alnum"]))
        .otherwise(F.lit(THRESHOLDS["base64"]))
    )
    allowed = run.rlike(NOT_A_SECRET) | is_path(run) | is_joined(run)
    return F.when(allowed, F.lit(False)).otherwise(max_window_entropy(run) >= least)


def _of_kind(spans: Column, no: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"), F.lit(KINDS[no]).alias("kind")
        ),
    ).cast(_SPAN)


def with_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``secret_base`` and ``secret_added``: arrays of (start, no, end, kind)."""
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(_SPAN)
    # A text without any of these words has no assignment: most texts skip that pattern.
    low = F.lower(body)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    assign = F.filter(native_spans(body, ASSIGN, (1,)), lambda s: F.length(s["g1"]) >= 6)
    access = F.filter(native_spans(body, ACCESS), lambda s: s["end"] - s["start"] >= 20)
    out = docs.withColumn(
        "secret_base",
        F.concat(
            F.when(named, _of_kind(assign, 0)).otherwise(none),
            F.when(body.contains("AKIA"), _of_kind(access, 1)).otherwise(none),
            F.when(body.rlike(HEX), _of_kind(native_spans(body, HEX), 2)).otherwise(none),
        ),
    )
    outside = lambda s: ~F.exists(
        F.col("secret_base"), lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])
    )
    runs = F.filter(native_spans(body, RUN), lambda s: outside(s) & is_random(s["match"]))
    return out.withColumn("secret_added", F.when(body.rlike(RUN), _of_kind(runs, 3)).otherwise(none))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the fixed formats, all spans."""
    docs = with_secrets(load(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda no: F.size(F.filter("secret_base", lambda s: s["no"] == no)).cast("long")
    return docs.select(
        "doc_id",
        *[count(no).alias(f"n_{KINDS[no]}") for no in range(3)],
        F.sha2(spans_text(F.col("secret_base")), 256).alias("base_sha256"),
        spans_text(F.concat("secret_base", "secret_added")).alias("spans"),
        F.size("secret_added").cast("long").alias("n_entropy"),
    )
