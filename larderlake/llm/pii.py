"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only; one pass over the texts and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlake.llm.spans import MATCH, matches, no_matches, overlaps, splice
from larderlake.llm.tables import empty_or_null, free_name

#: Kinds that are reported whatever their score, in the order of reports.
BASE = ("email", "ip", "card", "phone")
#: Kinds the method adds, reported from MIN_SCORE on.
ADDED = ("iban", "local_phone", "ssn")

#: Patterns. Possessive repeats and look-behinds change no match: they keep a run of a million
#: digits or letters from being tried anew from each of its characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "local_phone": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}

#: Where an account number may begin, and all that may belong to it with the character after that. Only
#: the four characters are consumed, so that a number is found also right after another one.
IBAN_HEAD = rf"[A-Z]{{2}}[0-9]{{2}}(?![A-Z0-9]{{31}})(?=({PATTERNS['iban'].removeprefix('[A-Z]{2}[0-9]{2}')}[A-Za-z0-9]?))"
#: Letters and digits of an account number.
IBAN_LENGTHS = range(15, 35)

#: Score of a confirmed span without context.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.4, "ssn": 0.4}
#: Words near a span that make its kind likelier.
CONTEXT = {
    "email": r"(?i)mail|contact|kontakt|correo",
    "ip": r"(?i)host|server|address|adresse|login",
    "card": r"(?i)card|visa|credit|karte|carte|tarjeta",
    "phone": r"(?i)phone|call|mobile|fax|telefon",
    "iban": r"(?i)iban|account|bank|konto|compte|cuenta",
    "local_phone": r"(?i)phone|call|mobile|fax|telefon",
    "ssn": r"(?i)ssn|social|security|tax",
}
#: Code points looked at on either side of a span.
REACH = 40
#: What a context word adds; what a digit directly before or after takes away.
BONUS, MALUS = 0.3, 0.3
#: Added kinds below this are not reported.
MIN_SCORE = 0.6

_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
IP_PARTS = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"

SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the digits pass the Luhn check; at least one digit, digits only."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number's letters and digits leave 1 when divided by 97, its first four moved to the end."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    places = F.sequence(F.lit(1), F.length(turned))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(places, F.lit(0), add) == 1


def _confirmed(kind: str, span: Column) -> Column:
    found = span["found"]
    digits = F.length(digits_of(found))
    if kind == "ip":
        return found.rlike(IP_PARTS)
    if kind == "card":
        return digits.between(13, 19) & luhn(digits_of(found))
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def _account(found: Column) -> Column:
    """The account number that a string begins with, null if none does.

    Of those that end where a word does the longest that mod 97 confirms; else all that the pattern
    fits, if that is confirmed.
    """
    tries = []
    for n in reversed(IBAN_LENGTHS):
        fours, tail = divmod(n - 4, 4)
        end = rf"\x20?[A-Z0-9]{{{tail}}}" if tail else ""
        shape = rf"^[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{fours}}}{end}(?![A-Za-z0-9])"
        tries.append(F.regexp_extract(found, shape, 0))
    tries.append(F.regexp_extract(found, PATTERNS["iban"], 0))

    def good(x: Column) -> Column:
        account = F.replace(x, F.lit(" "), F.lit(""))
        return F.length(account).between(IBAN_LENGTHS[0], IBAN_LENGTHS[-1]) & mod97(account)

    return F.get(F.filter(F.array(*tries), good), F.lit(0))


def _accounts(text: Column, gate: Column) -> Column:
    """The account numbers in a text, as matches; of overlapping ones the first."""
    heads = matches(text, IBAN_HEAD, "iban", gate)
    rests = F.when(F.size(heads) > 0, F.regexp_extract_all(text, F.lit(IBAN_HEAD), F.lit(1)))
    every = F.transform(
        F.arrays_zip(heads.alias("head"), F.coalesce(rests, F.array().cast("array<string>")).alias("rest")),
        lambda x: F.struct(
            x["head"]["start"].alias("start"), _account(F.concat(x["head"]["found"], x["rest"])).alias("found")
        ),
    )
    found = F.transform(
        F.filter(every, lambda x: x["found"].isNotNull()),
        lambda x: F.struct(
            F.lit("iban").alias("kind"),
            x["start"].alias("start"),
            (x["start"] + F.length(x["found"])).alias("end"),
            x["found"].alias("found"),
        ),
    ).cast(MATCH)
    last = lambda out: F.coalesce(F.get(out, F.size(out) - 1)["end"], F.lit(0))
    add = lambda out, s: F.when(s["start"] >= last(out), F.concat(out, F.array(s))).otherwise(out).cast(MATCH)
    return F.aggregate(found, no_matches(), add)


def _score(text: Column, span: Column, kind: str) -> Column:
    left = F.greatest(span["start"] - REACH, F.lit(0))
    before = F.substr(text, left + 1, span["start"] - left)
    after = F.substr(text, span["end"] + 1, F.lit(REACH))
    context = F.concat_ws(" ", before, after).rlike(CONTEXT[kind])
    touching = before.rlike("[0-9]$") | after.rlike("^[0-9]")
    score = F.lit(PRIOR[kind]) + F.when(context, BONUS).otherwise(0.0) - F.when(touching, MALUS).otherwise(0.0)
    return F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))


def find_pii(docs: DataFrame, out: str = "pii", text: str = "text") -> DataFrame:
    """All columns of the table and ``out``: the spans of personal data with scores, sorted by place.

    Spans of BASE kinds are all reported; those of ADDED kinds if they score MIN_SCORE and lie on no
    base span. A null or empty text has none. Repeated rows are searched each on its own; other
    columns, nulls in them included, pass through untouched. If the table has a column named
    ``out`` it must be given another name.
    """
    source = empty_or_null(docs[f"`{text}`"])
    base, digit, account = (free_name(docs, name) for name in ("base", "has_digit", "account"))
    df = docs.withColumn(digit, source.rlike("[0-9]"))
    gates = {"email": F.contains(source, F.lit("@")), "phone": F.contains(source, F.lit("+")) & F.col(digit)}

    def proposals(kind: str) -> Column:
        if kind == "iban":
            return F.col(account)
        found = matches(source, PATTERNS[kind], kind, gates.get(kind, F.col(digit)))
        return F.filter(found, lambda s: _confirmed(kind, s))

    def scored(found: Column, kind: str) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                F.lit(kind).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                _score(source, s, kind).alias("score"),
            ),
        ).cast(SPAN)

    # Two steps, so that the added kinds see the base spans without finding them again.
    df = df.withColumns({base: F.concat(*(scored(proposals(k), k) for k in BASE)), account: _accounts(source, F.col(digit))})
    more = [
        F.filter(
            scored(F.filter(proposals(k), lambda s: ~overlaps(s, F.col(base))), k), lambda s: s["score"] >= MIN_SCORE
        )
        for k in ADDED
    ]
    every = F.when(F.col(digit), F.concat(F.col(base), *more)).otherwise(F.col(base))
    order = F.transform(
        every, lambda s: F.struct(s["start"], s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score"))
    )
    spans = F.transform(
        F.array_sort(order),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")),
    )
    return df.withColumn(out, spans).drop(base, digit, account)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows with each span of personal data replaced by its kind in angle brackets.

    A text without any, empty and null ones included, stays as it is.
    """
    spans = free_name(docs, "pii")
    df = find_pii(docs, spans, text)
    clean = splice(F.col(f"`{text}`"), F.col(spans), lambda s: F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
    return df.withColumn(text, clean).drop(spans)


