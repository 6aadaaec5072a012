"""Personal data, by built-in functions only.

Regular expressions propose spans. Validators confirm them: the Luhn sum for cards, mod 97
for bank accounts, ranges for addresses, digit counts for phones. Words nearby raise or lower
the score. The base kinds are always kept once they are valid; the further kinds are kept
from a score of 0.5.

Patterns are written so that no input makes them try again and again: runs are taken whole
(possessive), and a match begins where a run or the search begins.

Defined cases: null text is empty; texts without spans have zero counts and empty lists;
overlapping spans of different kinds are all kept; repeated rows are treated alike; other
columns are ignored by ``find`` and kept by ``mask``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import text_rows

#: Code points before a span in which context words count.
NEAR = 40
KEEP_FROM = 0.5


@dataclass(frozen=True)
class Kind:
    """A kind of span: pattern, validator, base score and context words."""

    name: str
    pattern: str
    score: float
    context: str
    base: bool = False
    #: Where the pattern finds only the heads of spans: what a span is, from a head on, and the
    #: most code points that are needed to tell.
    whole: str = ""
    reach: int = 0


def _start(run: str) -> str:
    return f"(?:(?<!{run})|\\G)"


# Lengths of account numbers by country: the IBAN registry, and the countries that use the form
# without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA YE", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """A whole account number by its country's length; of any other country, all that follows."""
    known = [f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
    other = f"(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11,30}}+"
    return f"^(?:{'|'.join([*known, other])})(?![A-Za-z0-9])"


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
KINDS = (
    Kind("email", f"{_start(_LOCAL)}{_LOCAL}++@{_LABEL}++(?:\\.{_LABEL}++)++", 0.9, "e-?mail|contact|courriel|correo", True),
    Kind("ip", f"{_start('[0-9]')}[0-9]++(?:\\.[0-9]++){{3}}", 0.7, "ip|server|host|address", True),
    Kind("card", f"{_start('[0-9]')}[0-9](?:[\\x20-]?[0-9])++", 0.8, "card|karte|carte|tarjeta|visa|credit", True),
    Kind("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", 0.7, "tel|phone|call|fax|mobile|telefon", True),
    # The head only, so that a number that is none does not take the beginning of the next one.
    Kind("iban", "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\\x20?[A-Z0-9]){11})", 0.6, "iban|account|bank|konto|compte|cuenta", whole=_iban(), reach=65),
    Kind("ssn", "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, "ssn|social|security"),
    Kind("local_phone", "(?<![0-9+.(-])(?<!\\+[0-9]{1,3}[\\x20-])\\(?[0-9]{3,4}\\)?[\\x20-][0-9]{3}[\\x20-]?[0-9]{4}(?![0-9.-])", 0.3, "tel|phone|call|fax|mobile|telefon"),
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right is doubled."""
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: F.when(i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)).otherwise(d.cast("int")),
        ),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number passes: country and check digits moved to the end, letters
    as 10 to 35, remainder 1."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: F.when(c == "", a)
        .when(c >= "A", (a * 100 + F.ascii(c) - 55) % 97)
        .otherwise((a * 10 + F.ascii(c) - 48) % 97),
    )
    return rest == 1


def valid(kind: Kind, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind.name == "ip":
        parts = F.transform(F.split(match, "\\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p.cast("int")).otherwise(F.lit(999)) <= 255))
    if kind.name == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    if kind.name == "iban":
        return mod_97(match)
    return F.lit(True)


def _running(lengths: Column, block: int = 256) -> Column:
    """Sums of what stands before each element, by blocks, so that long lists stay cheap."""

    def within(items: Column, start: Column) -> Column:
        state = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("before"))
        step = lambda s, x: F.struct((s["at"] + x).cast("int").alias("at"), F.array_append(s["before"], s["at"]).alias("before"))
        return F.aggregate(items, state, step)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")), lambda b: F.slice(lengths, b * block + 1, F.lit(block)))
    sums = F.transform(blocks, lambda items: F.aggregate(items, F.lit(0), lambda a, x: a + x))
    starts = within(sums, F.lit(0))["before"]
    return F.when(F.size(lengths) > 0, F.flatten(F.zip_with(blocks, starts, lambda items, start: within(items, start)["before"]))).otherwise(F.array().cast("array<int>"))


def with_spans(df: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """Add an array of (start, kind number, kind, end, score), code points, end exclusive, in
    text order. ``text`` must not be null."""
    kept = df.columns
    found = df.select(
        "*", *[F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias(f"__m{i}") for i, k in enumerate(KINDS)]
    )
    # The places of the matches follow from what stands between them.
    between = found.select(
        "*", *[F.when(F.size(f"__m{i}") > 0, F.transform(F.split(text, k.pattern, -1), lambda g: F.length(g))).alias(f"__g{i}") for i, k in enumerate(KINDS)]
    )
    steps = between.select(
        *kept, *[f"__m{i}" for i in range(len(KINDS))],
        *[F.when(F.col(f"__g{i}").isNotNull(), F.flatten(F.zip_with(F.slice(f"__g{i}", 1, F.size(f"__m{i}")), f"__m{i}", lambda g, m: F.array(g, F.length(m))))).alias(f"__l{i}") for i in range(len(KINDS))],
    )
    starts = steps.select(
        *kept, *[f"__m{i}" for i in range(len(KINDS))], *[F.when(F.col(f"__l{i}").isNotNull(), _running(F.col(f"__l{i}"))).alias(f"__b{i}") for i in range(len(KINDS))]
    )

    def spans_of(i: int, kind: Kind) -> Column:
        def span(match: Column, j: Column) -> Column:
            start = F.col(f"__b{i}")[2 * j + 1]
            if kind.whole:
                match = F.regexp_extract(F.substr(F.col(text), start + 1, F.lit(kind.reach)), kind.whole, 0)
            before = F.substr(F.col(text), F.greatest(start - NEAR, F.lit(0)) + 1, F.least(start, F.lit(NEAR)))
            score = F.lit(kind.score) + F.when(F.lower(before).rlike(f"\\b(?:{kind.context})"), F.lit(0.3)).otherwise(F.lit(0.0))
            return F.struct(
                start.alias("start"), F.lit(i).alias("rank"), F.lit(kind.name).alias("kind"), (start + F.length(match)).alias("end"),
                F.least(score, F.lit(1.0)).alias("score"), valid(kind, match).alias("valid"),
            )

        spans = F.filter(F.transform(f"__m{i}", span), lambda s: s["valid"] if kind.base else s["valid"] & (s["score"] >= KEEP_FROM))
        none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double,valid:boolean>>")
        return F.when(F.size(f"__m{i}") > 0, spans).otherwise(none)

    return starts.select(*kept, F.array_sort(F.concat(*[spans_of(i, k) for i, k in enumerate(KINDS)])).alias(name))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text and spans of each document."""
    return with_spans(text_rows(docs))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_table(docs: DataFrame) -> DataFrame:
    base = [k.name for k in KINDS if k.base]
    found = find(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets; overlapping spans
    become one, named by the first. Null texts stay null, other columns stay as they are."""
    spans = with_spans(docs.withColumn("__text", F.coalesce(text, F.lit(""))), "__text", "__spans")
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(s: Column, x: Column) -> Column:
        piece = F.concat(F.substr(F.col("__text"), s["at"] + 1, x["start"] - s["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.array_append(s["parts"], piece)).otherwise(s["parts"]).alias("parts"),
        )

    end = spans.withColumn("__end", F.when(F.size("__spans") > 0, F.aggregate("__spans", state, step)))
    clean = F.when(F.col("__end").isNull(), F.col(text)).otherwise(
        F.concat(F.array_join("__end.parts", ""), F.substr(F.col("__text"), F.col("__end.at") + 1, F.length("__text")))
    )
    return end.withColumn(text, clean).select(*docs.columns)
