"""Personal data by base patterns and weak supervision, in column expressions only.

Base spans are the matches of four patterns that pass their checks. A match's place comes from the text's
split at the same pattern: the lengths of the parts before it and of the matches before it add up.

Further candidates are everything that a loose pattern finds. Labelers vote on each: the shape (regex), lists
of known beginnings and endings (gazetteer), the words before it (context), its length, and what it
touches. Candidates are counted per pattern of votes and features, of which there are boundedly many;
expectation-maximisation on those counts estimates how far each labeler can be trusted, and a logistic
classifier of the features is trained on the posteriors. A candidate whose probability is at least
`SPAN_FROM` and that is no base span adds a span.

Edge cases: null text is empty and has no spans; places are code points; repeated rows, null ids and extra
columns get what any row gets; an empty table gives an empty table; nothing is retried after a failed check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import once
from folioflow.llm import weak
from folioflow.session import stored

SPAN_FROM = 0.5
KINDS = ("email", "ip", "card", "phone")
# Runs are taken whole and tried from their start only, which finds the same leftmost matches in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MAY_HOLD = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_CHECK = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
BLOCK = 256

# Shapes of candidates, first match wins; those marked True add spans.
SHAPES: list[tuple[str, str, bool]] = [
    ("email", "@", False),
    ("phone", r"^\+", False),
    ("secret", r"(?i)^(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]", True),
    ("secret", r"^(?:AKIA|ASIA)[0-9A-Z]{16}$", True),
    ("iban", r"^[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}$", True),
    ("ip", r"^[0-9]+(?:\.[0-9]+){3}$", False),
    ("ssn", r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", True),
    ("local_phone", r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$", True),
    ("secret", r"^(?=.*[0-9].*[0-9])(?=.*[A-Za-z].*[A-Za-z])[A-Za-z0-9]{20,}$", True),
    ("card", r"^[0-9][0-9 -]{10,}[0-9]$", False),
    ("number", "", False),
]
LOOSE = "|".join(
    [
        PATTERNS["email"],
        PATTERNS["phone"],
        r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)[\x20]?[=:][\x20]?\"?[A-Za-z0-9/+_-]{6,}+\"?",
        r"(?<![A-Za-z0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
        # A group of digits that a letter follows ends a run before it, so a run is never tried twice.
        r"(?<![0-9A-Za-z])[0-9]++(?![A-Za-z])(?:[\x20.-][0-9]++(?![A-Za-z]))*+",
        r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]++",
    ]
)
LOOSE_HOLD = r"[0-9@]|(?i:password|passwd|pwd|secret|token|api[_-]?key)[\x20]?[=:]"
# What addresses, keys and numbers of persons begin or end with.
GAZETTEER = (
    r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$|^(?:AKIA|ASIA|ghp_|xox[bp])"
    r"|^\+(?:1|33|34|39|44|49)[ (.-]|^(?:DE|FR|ES|GB|IT|NL|CH|AT)[0-9]{2}[0-9A-Z]{11,}$|^(?:3[47]|4|5[1-5]|6)[0-9 -]{11,}$"
)
NOT_PERSONAL = r"^(?:19|20)[0-9]{2}$|^[0-9]{1,2}\.[0-9]{1,2}(?:\.[0-9]{1,2})?$|^[0-9]{1,4}$"
CUES = r"(?:mail|e-mail|contact|tel|telephone|phone|call|fax|mobile|card|visa|ip|address|host|iban|account|ssn|key|password|token|secret|login)\W{0,3}$"
OTHER_CUES = r"(?:version|license|licence|lizenz|licencia|chapter|page|section|figure|year|by|by-nc|by-sa|v)\W{0,3}$"
VOTERS = ("by_shape", "by_list", "by_context", "by_length", "by_touch")


def located(text: Column, pattern: str, may_hold: str, field) -> Column:
    """Array of `field(match, start, end, part before, part after)` of a pattern's matches in order.

    Running sums go block by block, so that the work stays near linear in the number of matches.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(v: Column) -> Column:
        number = F.size(v.hits)
        size = F.transform(v.hits, lambda hit, i: F.length(v.parts[i]).cast("long") + F.length(hit))
        return once(F.struct(v.hits.alias("hits"), v.parts.alias("parts"), size.alias("size"), number.alias("n")), blocks)

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((v.n - 1) / BLOCK).cast("int"))
        sums = F.transform(starts, lambda b: F.aggregate(F.slice(v.size, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("long"), lambda a, x: a + x))
        ends = once(F.struct(v.size.alias("size"), _running(sums, F.lit(0).cast("long")).alias("upto")), lambda w: F.flatten(F.transform(w.upto, lambda upto, b: _running(F.slice(w.size, b * BLOCK + 1, F.lit(BLOCK)), upto, after=True))))
        return once(
            F.struct(v.hits.alias("hits"), v.parts.alias("parts"), ends.alias("ends")),
            lambda w: F.transform(w.hits, lambda hit, i: field(hit, w.ends[i] - F.length(hit), w.ends[i], w.parts[i], w.parts[i + 1])),
        )

    found = once(
        F.struct(hits.alias("hits"), F.split(text, pattern, -1).alias("parts")),
        lambda v: F.when(F.size(v.hits) > 0, place(v)),
    )
    return F.when(text.rlike(may_hold), found)


def _running(values: Column, start: Column, after: bool = False) -> Column:
    """Running sums before (or after) each value; for short arrays."""
    zero = F.struct(start.alias("at"), F.array().cast("array<long>").alias("out"))
    step = lambda a, x: F.struct((a.at + x).alias("at"), F.array_append(a.out, a.at + x if after else a.at).alias("out"))
    return F.aggregate(values, zero, step).out


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(i % 2 == 0, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_CHECK)
    if kind == "card":
        number = _digits(match)
        return F.when(F.length(number).between(12, 19), once(number, luhn)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _span(start: Column, kind: Column, order: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), order.alias("rank"), end.alias("end"), kind.alias("kind"))


NO_SPANS = "array<struct<start: bigint, rank: int, end: bigint, kind: string>>"


def base_spans(text: Column) -> Column:
    """Sorted base spans of a text without nulls."""
    arrays = []
    for rank, kind in enumerate(KINDS):
        field = lambda hit, start, end, _, __, kind=kind, rank=rank: F.when(passes(kind, hit), _span(start, F.lit(kind), F.lit(rank), end))
        found = F.filter(located(text, PATTERNS[kind], MAY_HOLD[kind], field), lambda s: s.isNotNull())
        arrays.append(F.coalesce(found, F.array().cast(NO_SPANS)))
    return F.array_sort(F.concat(*arrays))


def _shape(match: Column) -> Column:
    out = F.lit(len(SHAPES) - 1)
    for i in reversed(range(len(SHAPES) - 1)):
        out = F.when(match.rlike(SHAPES[i][1]), F.lit(i)).otherwise(out)
    return out


def _votes(match: Column, shape: Column, before: Column, after: Column) -> dict[str, Column]:
    number = len(SHAPES) - 1
    kind = F.element_at(F.array(*[F.lit(s[0]) for s in SHAPES]), shape + 1)
    fits = F.when(kind == "ip", match.rlike(IP_CHECK)).when(kind == "card", passes("card", match)).when(kind == "phone", passes("phone", match)).otherwise(shape != number)
    return {
        "by_shape": F.when(fits, 1).otherwise(-1),
        "by_list": F.when(match.rlike(GAZETTEER), 1).when(match.rlike(NOT_PERSONAL), -1).otherwise(0),
        "by_context": F.when(kind == "secret", F.when((before.rlike(CUES)) | match.rlike(SHAPES[2][1]), 1).otherwise(0)).when(before.rlike(CUES), 1).when(before.rlike(OTHER_CUES), -1).otherwise(0),
        "by_length": F.when(F.length(match) >= 11, 1).when(F.length(match) <= 6, -1).otherwise(0),
        "by_touch": F.when(before.rlike(r"[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"), -1).when((before.rlike(r"(?:^|[\s\"'(:=<])$")) & after.rlike(r"^(?:$|[\s\"'),.;:!?>])"), 1).otherwise(0),
    }


def candidates(text: Column) -> Column:
    """Array of (start, end, shape, votes) of everything the loose pattern finds."""

    def field(hit: Column, start: Column, end: Column, part: Column, rest: Column) -> Column:
        near = F.struct(F.lower(F.right(part, F.lit(24))).alias("before"), F.left(rest, F.lit(2)).alias("after"), _shape(hit).alias("shape"))

        def made(v: Column) -> Column:
            votes = _votes(hit, v["shape"], v["before"], v["after"])
            return F.struct(start.alias("start"), end.alias("end"), v["shape"].cast("int").alias("shape"), *[c.cast("int").alias(n) for n, c in votes.items()])

        return once(near, made)

    kind = "array<struct<start: bigint, end: bigint, shape: int, " + ", ".join(f"{v}: int" for v in VOTERS) + ">>"
    return F.coalesce(located(text, LOOSE, LOOSE_HOLD, field), F.array().cast(kind))


def _features(shape: int, votes: tuple[int, ...]) -> tuple[int, ...]:
    """0/1 features of the span classifier: the shape, and each labeler's vote for and against."""
    return (*[int(shape == i) for i in range(len(SHAPES))], *[int(v == s) for v in votes for s in (1, -1)])


def train(rows: DataFrame) -> dict[tuple[int, ...], float]:
    """(shape, votes) -> probability, for every combination that occurs in `cands` of the rows.

    There are at most shapes x 3^labelers combinations; their counts are what is collected.
    """
    keys = ["shape", *VOTERS]
    counted = rows.select(F.explode("cands").alias("c")).groupBy(*[F.col(f"c.{k}").alias(k) for k in keys]).count().collect()
    counted = sorted((tuple(r[:-1]), r[-1]) for r in counted)
    patterns: dict[tuple[int, ...], int] = {}
    for key, n in counted:
        patterns[key[1:]] = patterns.get(key[1:], 0) + n
    prior, weights = weak.fit(sorted(patterns.items()), (0.02, 0.28, 0.7), (0.6, 0.35, 0.05), 0.5)
    label = {votes: weak.sigmoid(prior + sum(w[v] for w, v in zip(weights, votes))) for votes in patterns}
    bias, slopes = weak.logistic([(_features(key[0], key[1:]), label[key[1:]], n) for key, n in counted])
    return {key: weak.sigmoid(bias + sum(w for w, f in zip(slopes, _features(key[0], key[1:])) if f)) for key, _ in counted}


def spans(rows: DataFrame, model: dict[tuple[int, ...], float]) -> Column:
    """All spans of rows with `base` and `cands`: base ones and those that the classifier adds."""
    added = sorted(k for k, p in model.items() if p >= SPAN_FROM and SHAPES[k[0]][2])
    if not added:
        return F.col("base")
    chosen = F.array(*[F.lit("/".join(map(str, k))) for k in added])
    code = lambda c: F.concat_ws("/", *[c[k].cast("string") for k in ("shape", *VOTERS)])
    kinds = F.array(*[F.lit(s[0]) for s in SHAPES])
    new = F.transform(
        F.filter("cands", lambda c: F.array_contains(chosen, code(c))),
        lambda c: _span(c.start, F.element_at(kinds, c["shape"] + 1), F.lit(len(KINDS)) + c["shape"], c.end),
    )
    return F.array_sort(F.concat(F.col("base"), new))  # kinds that add spans are no base kinds


def joined(found: Column) -> Column:
    one = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    return F.concat_ws(",", F.transform(found, one))


def detect(docs: DataFrame, carry: list[str]) -> DataFrame:
    """`carry`, then `base` and `spans`: arrays of (start, rank, end, kind) in code points, end exclusive."""
    plain = [f"d{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col("`" + c.replace("`", "``") + "`").alias(p) for c, p in zip(carry, plain)], F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    rows = stored(rows.select(*plain, base_spans(F.col("t")).alias("base"), candidates(F.col("t")).alias("cands")))
    model = train(rows)
    return rows.select(*plain, "base", spans(rows, model).alias("spans")).toDF(*carry, "base", "spans")


def _count(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s.kind == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans as text."""
    rows = detect(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"])
    counts = [_count("base", kind).alias(f"n_{kind}") for kind in KINDS]
    digest = F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, digest, joined(F.col("spans")).alias("spans"))


def masked(text: Column, found: Column) -> Column:
    """The text with each span, overlapping ones together, replaced by the kind of its first in angle brackets.

    Spans are sorted by start. Each gives what stands between the spans before it and itself, cut from the text of its block.
    """
    number = F.size(found)

    def blocks(v: Column) -> Column:
        """The text, the spans, the furthest end before each block and within it."""
        starts = F.sequence(F.lit(0), F.floor((v.n - 1) / BLOCK).cast("int"))
        most = F.transform(starts, lambda b: F.array_max(F.transform(F.slice(v.spans, b * BLOCK + 1, F.lit(BLOCK)), lambda s: s.end)))
        return once(F.struct(v.text.alias("text"), v.spans.alias("spans"), _furthest(most, F.lit(0).cast("long")).alias("upto"), starts.alias("starts")), pieces)

    def pieces(v: Column) -> Column:
        cut = F.transform(v.starts, lambda b: piece(v, F.slice(v.spans, b * BLOCK + 1, F.lit(BLOCK)), v.upto[b]))
        end = F.element_at(v.upto, F.lit(-1))
        return F.concat(F.array_join(cut, ""), F.substring(v.text, (end + 1).cast("int"), F.length(v.text)))

    def piece(v: Column, own: Column, base: Column) -> Column:
        last = F.element_at(own, F.lit(-1)).start
        part = F.substring(v.text, (base + 1).cast("int"), (last - base).cast("int"))
        upto = _furthest(F.transform(own, lambda s: s.end), base)

        def joined_up(w: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                between = F.substring(w.part, (w.upto[i] - w.base + 1).cast("int"), (s.start - w.upto[i]).cast("int"))
                return F.when(s.start >= w.upto[i], F.concat(between, F.lit("<"), s.kind, F.lit(">"))).otherwise("")

            return F.array_join(F.transform(w.own, one), "")

        return once(F.struct(own.alias("own"), part.alias("part"), upto.alias("upto"), base.alias("base")), joined_up)

    whole = once(F.struct(text.alias("text"), found.alias("spans"), number.alias("n")), blocks)
    return F.when(number == 0, text).otherwise(whole)


def _furthest(values: Column, start: Column) -> Column:
    """The greatest value before each place, and after the last; for short arrays."""
    step = lambda a, x: F.array_append(a, F.greatest(F.element_at(a, F.lit(-1)), x))
    return F.aggregate(values, F.array(start), step)


def mask(docs: DataFrame) -> DataFrame:
    """docs with spans masked in the text, and n_chars, where there is one, counted anew."""
    plain = docs.toDF(*[c if c == "text" else f"p{i}" for i, c in enumerate(docs.columns)])
    rows = detect(plain, plain.columns)
    text = masked(F.col("text"), F.col("spans"))
    out = rows.withColumn("text", F.when(F.col("text").isNotNull(), text)).drop("base", "spans").toDF(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out
