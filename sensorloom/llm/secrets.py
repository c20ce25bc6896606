"""Secret scan: fixed patterns, and tokens that are random and no ordinary text.

A token is a long run of the characters that encodings use. Its encoding is inferred, its
characters become numbers, and three tests of "drawn evenly and independently from the alphabet"
give p-values: chi-squared over sixteen cells, runs above and below the middle, and serial
correlation. Fisher's method joins them; a token that fails the battery is no random key.

What passes is reported only where ordinary text is ruled out. Pairs of characters are counted in
all short words of the corpus; the ratio of a token's probability in that model to its probability
as an even draw is an upper bound of the p-value of "this is ordinary text". Tokens are sorted into
classes of length, and in every class the hypothesis is rejected with a controlled rate of false
discoveries (Benjamini-Hochberg). A token that is too short to rule text out is not reported.

Everything is made of DataFrame functions. Positions are code points from 0, ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import stored

# Patterns and smallest lengths of the contract. A run of [0-9a-f]+ or of
# AKIA[A-Z0-9]+ that is long enough is the same as a match of the bounded pattern.
ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

# A run that mixes both sorts of signs is looked at in parts, each of one sort.
TOKEN_LEAST = 20
TOKENS = (
    f"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{{{TOKEN_LEAST},}}",
    f"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{{{TOKEN_LEAST},}}",
)
LOWER, UPPER, DIGITS, SIGNS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_-"
# The alphabets of encodings, the narrowest first; a token has the first that holds its characters.
ALPHABETS = {
    "hex": DIGITS + LOWER[:6],
    "upper hex": DIGITS + UPPER[:6],
    "base32": UPPER + "234567",
    "lower base32": LOWER + "234567",
    "base36": DIGITS + LOWER,
    "upper base36": DIGITS + UPPER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "_-",
}
# Identifiers of the usual form are random by design, and public.
UUID = "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
CELLS = 16
FALSE_DISCOVERIES = 0.05
# A random key fails the battery this seldom.
BATTERY_LEAST = 1e-4
# p-values are rounded up to ten steps a decade, which keeps the control and bounds the counts.
STEPS, SMALLEST = 10, 40
BLOCK = 256

# How likely a lower-case letter, capital, digit or sign follows each of them in names and words:
# the model before any text is counted, with the weight of so many pairs per character.
FOLLOWS = {
    LOWER: {LOWER: 0.88, UPPER: 0.05, DIGITS: 0.03, SIGNS: 0.04},
    UPPER: {LOWER: 0.55, UPPER: 0.38, DIGITS: 0.03, SIGNS: 0.04},
    DIGITS: {LOWER: 0.05, UPPER: 0.04, DIGITS: 0.85, SIGNS: 0.06},
    SIGNS: {LOWER: 0.55, UPPER: 0.30, DIGITS: 0.14, SIGNS: 0.01},
}
PRIOR_PAIRS = 100.0

_SPAN = "struct<start:bigint,end:bigint,match:string>"


def _spans(gaps: Column, matches: Column) -> Column:
    """(start, end, match) of all matches of a pattern, given their texts and those between them.
    Lengths are summed in blocks, so that the work for n matches does not grow with n squared."""
    lengths = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    bigint = F.lit(0).cast("bigint")

    def total(part: Column) -> Column:
        return F.aggregate(part, bigint, lambda n, x: n + x["g"] + F.coalesce(x["m"], F.lit(0)))

    # The lengths are evaluated once by putting them into a one-element array.
    def placed(sizes: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int")),
            lambda b: total(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))),
        )
        begins = F.aggregate(
            blocks,
            F.array(bigint),
            lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
        )
        return F.transform(
            F.array(begins),
            lambda starts: F.transform(
                matches,
                lambda m, i: F.struct(
                    (
                        F.get(starts, F.floor(i / BLOCK).cast("int"))
                        + total(F.slice(sizes, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))
                        + F.get(sizes, i)["g"]
                    ).alias("start"),
                    m.alias("match"),
                ),
            ),
        )[0]

    found = F.flatten(F.transform(F.array(lengths), placed))
    ended = F.transform(
        found,
        lambda s: F.struct(
            s["start"].cast("bigint").alias("start"),
            (s["start"] + F.length(s["match"])).cast("bigint").alias("end"),
            s["match"].alias("match"),
        ),
    )
    return F.when(F.size(matches) > 0, ended).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it is used: plans, which the driver
    holds and rewrites, and the work would else grow with every use of a use."""
    return F.transform(F.array(value), then)[0]


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution for z >= 0 (a rational approximation, error < 1e-7)."""

    def tail(z: Column, t: Column) -> Column:
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly

    return _once(z, lambda z: _once(1 / (1 + 0.2316419 * z), lambda t: tail(z, t)))


def _two_sided(z: Column) -> Column:
    return F.greatest(F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0)), F.lit(1e-40))


def chi_squared_p(cells: Column, n: Column, size: Column) -> Column:
    """Of values in cells of as many characters as divide evenly: the statistic's upper tail by the
    cube-root approximation."""

    def part(c: Column) -> Column:
        observed = F.size(F.filter(cells, lambda x: x == c)).cast("double")
        expected = n * (F.ceil((c + 1) * size / CELLS) - F.ceil(c * size / CELLS)) / size
        return _once(expected, lambda e: _once(observed - e, lambda d: d * d / e))

    parts = F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), part)
    x = F.aggregate(parts, F.lit(0.0), lambda s, o: s + o)
    df = CELLS - 1
    z = (F.pow(x / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    upper = _once(z, lambda z: F.when(z >= 0, _upper_tail(z)).otherwise(1 - _upper_tail(-z)))
    return F.greatest(F.least(upper, F.lit(1.0)), F.lit(1e-40))


def runs_p(values: Column, n: Column, size: Column) -> Column:
    """Of the number of runs above and below the middle of the alphabet."""
    changes = F.size(
        F.filter(
            F.sequence(F.lit(1), n.cast("int") - 1),
            lambda i: (F.get(values, i) * 2 >= size) != (F.get(values, i - 1) * 2 >= size),
        )
    )
    return _two_sided((changes - (n - 1) / 2) / F.sqrt((n - 1) / 4))


def serial_p(values: Column, n: Column, size: Column) -> Column:
    """Of the correlation between neighbours, with the variance of an even draw."""
    middle, spread = (size - 1) / 2, (size * size - 1) / 12
    products = F.aggregate(
        F.sequence(F.lit(1), n.cast("int") - 1),
        F.lit(0.0),
        lambda s, i: s + (F.get(values, i) - middle) * (F.get(values, i - 1) - middle),
    )
    return _two_sided(products / spread / F.sqrt(n - 1))


def encoding_of(token: Column) -> Column:
    """The name of the narrowest alphabet that holds a token's characters, else NULL."""
    name = F.lit(None).cast("string")
    for encoding, alphabet in reversed(ALPHABETS.items()):
        name = F.when(token.rlike(f"^[{alphabet}]+$"), encoding).otherwise(name)
    return F.when(~token.rlike(UUID), name)


def _alphabet(encoding: Column) -> Column:
    alphabet = F.lit(None).cast("string")
    for name, letters in ALPHABETS.items():
        alphabet = F.when(encoding == name, letters).otherwise(alphabet)
    return alphabet


def battery(token: Column) -> Column:
    """(encoding, p) of a token by the numbers of its characters in the alphabet of its encoding;
    p is NULL where it has none. Each part is worked out once, as the one element of an array."""
    n = F.length(token).cast("double")

    def joint(name: Column, alphabet: Column) -> Column:
        size = F.length(alphabet).cast("double")
        numbers = F.transform(
            F.sequence(F.lit(1), F.length(token)),
            lambda i: F.instr(alphabet, F.substr(token, i, F.lit(1))) - 1,
        )

        def tested(values: Column) -> Column:
            cells = F.transform(values, lambda v: F.floor(v * CELLS / size))
            x = -(
                F.log(chi_squared_p(cells, n, size))
                + F.log(runs_p(values, n, size))
                + F.log(serial_p(values, n, size))
            )
            p = _once(x, lambda x: F.exp(-x) * (1 + x + x * x / 2))
            return F.struct(name.alias("encoding"), p.alias("p"))

        return F.transform(F.array(numbers), tested)[0]

    return F.transform(
        F.array(encoding_of(token)), lambda name: F.transform(F.array(_alphabet(name)), lambda a: joint(name, a))[0]
    )[0]


def _thousandths(value: Column) -> Column:
    """Whole numbers, whose sums do not depend on their order."""
    return F.round(value * 1000).cast("bigint")


def text_model(documents: DataFrame) -> DataFrame:
    """(pair, bits): for each pair of characters the logarithm to base 2 of the probability of the
    second after the first in ordinary text, in thousandths. At most as many rows as there are pairs.

    Words shorter than a token are counted in all whole texts, combined before the shuffle. A word
    counts by the logarithm of its number, so that neither a few words of every text nor the many
    odd ones of a single text make the model.
    """
    letters = LOWER + UPPER + DIGITS + SIGNS
    words = documents.select(F.explode(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z0-9+/_-]+")).alias("word"))
    counts = words.filter(F.length("word").between(2, TOKEN_LEAST - 1)).groupBy("word").count()
    pairs = counts.select(
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))
        ).alias("pair"),
        _thousandths(F.log2(F.col("count") + 1)).alias("weight"),
    ).groupBy("pair").agg(F.sum("weight").alias("n"))
    prior = F.lit(0.0)
    for before, after in FOLLOWS.items():
        for kind, share in after.items():
            fits = F.instr(F.lit(before), F.col("first")).cast("boolean") & F.instr(F.lit(kind), F.col("second")).cast("boolean")
            prior = F.when(fits, share / len(kind)).otherwise(prior)
    every = [F.lit(letter) for letter in letters]
    grid = documents.sparkSession.range(1, numPartitions=1).select(F.explode(F.array(*every)).alias("first"))
    grid = grid.select("first", F.explode(F.array(*every)).alias("second"))
    known = grid.withColumn("pair", F.concat("first", "second")).join(pairs, "pair", "left")
    total = known.groupBy("first").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    weight = 1000 * PRIOR_PAIRS
    share = (F.coalesce("n", F.lit(0)) + weight * prior) / (F.col("total") + weight)
    return known.join(total, "first").select("pair", _thousandths(F.log2(share)).alias("bits"))


def judged_tokens(tokens: DataFrame, model: DataFrame) -> DataFrame:
    """For each distinct ``match`` of tokens that has an encoding and passes the battery: the number
    ``n`` of its occurrences, its length_class and the step of its p-value as ordinary text.

    The model is a row per pair of characters, small enough to send to every task. A token without
    small letters is judged as if it had no capitals, as whole words may be written in those.
    """
    read = F.when(F.col("match").rlike("[a-z]"), F.col("match")).otherwise(F.lower("match"))
    tested = (
        tokens.groupBy("match").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("encoding", encoding_of(F.col("match")))
        .filter("encoding is not null")
        .withColumn("random_p", battery(F.col("match"))["p"])
        .filter(F.col("random_p") >= BATTERY_LEAST)
    )
    pairs = tested.select(
        "match",
        "n",
        F.length(_alphabet(F.col("encoding"))).alias("size"),
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("match") - 1), lambda i: F.substr(read, i, F.lit(2)))
        ).alias("pair"),
    )
    ratio = F.sum(F.col("bits") + _thousandths(F.log2(F.col("size").cast("double")))) / 1000
    return (
        pairs.join(F.broadcast(model), "pair")
        .groupBy("match", "n")
        .agg(ratio.alias("ratio"))
        .select(
            "match",
            "n",
            F.floor(F.log2(F.length("match").cast("double"))).cast("int").alias("length_class"),
            rounded_p(F.pow(F.lit(2.0), F.least("ratio", F.lit(0.0)))).alias("step"),
        )
    )


def rounded_p(p: Column) -> Column:
    """The step of a p-value: it stands for 10 ** (-step / STEPS), which is at least p."""
    return F.least(
        F.floor(-F.log10(F.greatest(p, F.lit(1e-38))) * STEPS + 1e-9), F.lit(SMALLEST * STEPS)
    ).cast("int")


def _marked(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns of every row as one, with a number, its base spans and its tokens."""
    row = F.struct(*[F.col(f"`{name}`") for name in keep])
    rows = documents.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    patterns = [ASSIGN, ACCESS, HEX, *TOKENS]
    found = [
        F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias(f"matches{i}") for i, pattern in enumerate(patterns)
    ]
    rows = rows.select("row", "text", *found)
    # A text is only cut at a pattern that it holds.
    parts = F.array(
        *[
            F.struct(
                F.when(F.size(f"matches{i}") > 0, F.split("text", pattern, -1)).alias("gaps"),
                F.col(f"matches{i}").alias("matches"),
            )
            for i, pattern in enumerate(patterns)
        ]
    )
    # One expression places the matches of every pattern.
    placed = rows.select("row", F.transform(parts, lambda p: _spans(p["gaps"], p["matches"])).alias("spans"))

    def named(kind: str, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lit(KINDS.index(kind)).alias("rank"),
                F.lit(kind).alias("kind"),
            ),
        )

    assign, access, hex_, *tokens = (F.get("spans", i) for i in range(len(patterns)))
    long_enough = F.filter(
        assign,
        lambda s: F.length(F.regexp_extract(s["match"], f"^{ASSIGN}", 2)) >= ASSIGN_LEAST,
    )
    base = F.concat(named("assign", long_enough), named("access", access), named("hex", hex_))
    return placed.select(
        "row",
        F.monotonically_increasing_id().alias("own"),
        base.alias("base"),
        F.array_distinct(F.concat(*tokens)).alias("tokens"),
    )


def rejected_steps(tokens: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """For each length class the least step at which the hypothesis of ordinary text is rejected.

    ``tokens`` has length_class and step, and n where a row stands for several tokens. Counts per
    class and step, at most a few hundred rows per class, are all that is gathered.
    """
    number = F.sum("n") if "n" in tokens.columns else F.count(F.lit(1))
    counts = tokens.groupBy("length_class", "step").agg(number.alias("count")).collect()
    result: dict[int, int] = {}
    for length_class in {row["length_class"] for row in counts}:
        own = sorted((r for r in counts if r["length_class"] == length_class), key=lambda r: -r["step"])
        total, below = sum(r["count"] for r in own), 0
        for row in own:
            below += row["count"]
            if 10 ** (-row["step"] / STEPS) <= rate * below / total:
                result[length_class] = row["step"]
    return result


def reported_tokens(tokens: DataFrame, documents: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """The distinct ``match`` of tokens that are random and, at the controlled rate, no ordinary
    text by the model of ``documents``. A token of which nothing can be said is not among them."""
    model = stored(text_model(documents), "text-model")
    judged = stored(judged_tokens(tokens, model), "judged-tokens")
    limits = rejected_steps(judged, rate)
    if not limits:
        return judged.select("match").limit(0)
    table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    limit = F.try_element_at(table, F.col("length_class"))
    return judged.filter(F.col("step") >= F.coalesce(limit, F.lit(1 << 20))).select("match")


def find_secrets(
    documents: DataFrame, keep: list[str] | None = None, rate: float = FALSE_DISCOVERIES
) -> DataFrame:
    """One row per row of ``documents``: the columns to keep, by default doc_id, as the fields of
    ``row``, and secrets, an array of (start, end, rank, kind) by start and kind. Random spans that
    overlap a base span are left out.

    A null text is empty and has no spans. Null ids and repeated rows give a row each. The marks
    of all rows are stored once, as what is reported depends on all of them; only rows that hold a
    token meet the reported ones again. Beside the base patterns nothing is covered that is shorter
    than ``TOKEN_LEAST``, in an encoding not in ``ALPHABETS``, a UUID, or made of words.
    """
    marked = stored(_marked(documents, keep or ["doc_id"]), "secrets")
    tokens = marked.select("own", F.explode("tokens").alias("t")).select("own", "t.start", "t.end", "t.match")
    reported = reported_tokens(tokens, documents, rate)
    span = F.struct(
        "start", "end", F.lit(KINDS.index("random")).alias("rank"), F.lit("random").alias("kind")
    )
    spans = (
        tokens.join(reported, "match", "left_semi")
        .groupBy(F.col("own").alias("of"))
        .agg(F.collect_list(span).alias("random"))
    )
    holds = F.size("tokens") > 0
    some = marked.filter(holds).join(spans, F.col("own") == F.col("of"), "left")
    apart = F.filter(
        F.coalesce("random", F.array().cast("array<struct<start:bigint,end:bigint,rank:int,kind:string>>")),
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    both = some.select("row", F.concat("base", apart).alias("secrets")).union(
        marked.filter(~holds).select("row", F.col("base").alias("secrets"))
    )
    return both.select(
        "row",
        F.array_sort(
            "secrets",
            lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
            .when(a["rank"] != b["rank"], F.when(a["rank"] < b["rank"], -1).otherwise(1))
            .when(a["end"] != b["end"], F.when(a["end"] < b["end"], -1).otherwise(1))
            .otherwise(F.lit(0)),
        ).alias("secrets"),
    )


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as text."""

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "row.doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        count("random").alias("n_random"),
    )


def redact(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """A text with each span, or run of overlapping spans, replaced by a mark. Null stays null."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")
    )

    def step(done: Column, span: Column) -> Column:
        gap = (span["start"] - done["at"]).cast("int")
        before = F.substr(text, (done["at"] + 1).cast("int"), gap)
        return F.struct(
            F.greatest(done["at"], span["end"]).cast("bigint").alias("at"),
            F.when(gap >= 0, F.concat(done["parts"], F.array(before, F.lit(mark))))
            .otherwise(done["parts"])
            .alias("parts"),
        )

    def finish(done: Column) -> Column:
        return F.concat(F.array_join(done["parts"], ""), F.substr(text, (done["at"] + 1).cast("int")))

    return F.when(F.size(secrets) > 0, F.aggregate(secrets, start, step, finish)).otherwise(text)
