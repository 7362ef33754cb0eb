"""Secret scan that links the parts of a credential: identifiers, secrets and endpoints.

Strong parts are reported wherever they stand. Weak ones, which alone would be noise, are reported
when complementary parts stand near in the same document. Parts meet in an interval join on
(document, stretch of the text). DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlake.llm.spans import matches, overlaps
from larderlake.llm.tables import empty_or_null, keep

#: Strong kinds in the order of reports, then weak ones.
BASE = ("assign", "access", "hex")
WEAK = ("user", "blob", "endpoint")

PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    # Shorter runs fail whether they match here or are dropped later.
    "hex": r"[0-9a-f]{24,}",
    "user": r"""((?i:user|username|login|account|client_id|key_id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]+)""",
    "blob": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
    "endpoint": r"""(?:https?|wss?|ftp|ssh|amqp|mongodb|mysql|postgres|redis)://[^\x00-\x20"'<>]+""",
}

#: What a part contributes to a credential.
ROLE = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "user": "identifier",
    "blob": "secret",
    "endpoint": "endpoint",
}
ROLES = ("identifier", "secret", "endpoint")

#: Code points between two parts of one credential at most.
REACH = 200
#: Least lengths: value of an assignment, access identifier, name of a user.
MIN_VALUE, MIN_ACCESS, MIN_USER = 6, 20, 3

SPAN = "array<struct<kind:string,start:int,end:int>>"


def _valid(kind: str, span: Column) -> Column:
    found = span["found"]
    if kind in ("assign", "user"):
        least = MIN_VALUE if kind == "assign" else MIN_USER
        return F.length(F.regexp_extract(found, PATTERNS[kind], 2)) >= least
    if kind == "access":
        return F.length(found) >= MIN_ACCESS
    if kind == "blob":
        return found.rlike("[0-9]") & found.rlike("[A-Z]") & found.rlike("[a-z]")
    return F.lit(True)


def _parts(text: Column, kind: str, gate: Column | None = None) -> Column:
    good = F.filter(matches(text, PATTERNS[kind], kind, gate), lambda s: _valid(kind, s))
    return F.transform(good, lambda s: F.struct(s["kind"], s["start"].alias("start"), s["end"].alias("end"))).cast(SPAN)


def _role(kind: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in ROLE.items() for x in pair))[kind]


def _linked(parts: DataFrame) -> DataFrame:
    """(key, spans): the weak parts that complementary ones stand near to.

    ``parts`` are (key, kind, start, end). A weak part needs a strong one of another role within
    reach, or parts of both other roles. A part lies in every stretch of REACH code points that it
    touches; a weak one also looks at stretches within reach. A stretch holds only so many spans, as
    those of a kind don't overlap: the join grows with the number of parts.
    """
    parts = parts.withColumn("role", _role(F.col("kind"))).withColumn("strong", F.col("kind").isin(*BASE))

    def stretches(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / REACH).cast("long"), F.floor(end / REACH).cast("long")))

    weak = parts.where(~F.col("strong")).select(
        "key", "kind", "start", "end", "role", stretches(F.col("start") - REACH, F.col("end") + REACH).alias("stretch")
    )
    near = parts.select(
        "key",
        "strong",
        F.col("role").alias("other"),
        F.col("start").alias("from"),
        F.col("end").alias("to"),
        stretches(F.col("start"), F.col("end")).alias("stretch"),
    )
    pairs = weak.join(near, ["key", "stretch"]).where(
        (F.col("role") != F.col("other"))
        & (F.col("from") - F.col("end") <= REACH)
        & (F.col("start") - F.col("to") <= REACH)
    )
    seen = pairs.groupBy("key", "kind", "start", "end").agg(
        F.bool_or("strong").alias("strong"),
        *(F.bool_or(F.col("other") == r).cast("int").alias(r) for r in ROLES),
    )
    good = seen.where(F.col("strong") | (sum(F.col(r) for r in ROLES) >= 2))
    return good.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).cast(SPAN).alias("added"))


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): for each row the spans of credentials, sorted by start, then kind.

    Spans of BASE kinds are all reported, WEAK ones where complementary parts stand within REACH in
    the same text. A null or empty text has none, and keeps its row; so does a null id. Repeated
    rows each get the same spans. Other columns are not read.
    """
    rows = docs.select(docs[f"`{id}`"].alias("id"), empty_or_null(docs[f"`{text}`"]).alias("text"))
    text_, base = F.col("text"), F.col("base")
    digit = text_.rlike("[0-9]")
    gates = {
        "access": F.contains(text_, F.lit("AKIA")),
        "hex": None,
        "user": F.contains(text_, F.lit("=")) | F.contains(text_, F.lit(":")),
        "blob": digit,
        "endpoint": F.contains(text_, F.lit("://")),
    }
    # Equal rows share a key, and the spans that go with it.
    key = F.md5(F.concat_ws("|", F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("-")), text_))
    found = rows.select(
        "id", "text", key.alias("key"), F.concat(*(_parts(text_, k, gates.get(k)) for k in BASE)).alias("base")
    )
    weak = F.filter(
        F.concat(*(_parts(text_, k, gates[k]) for k in WEAK)), lambda s: ~((s["kind"] == "blob") & overlaps(s, base))
    )
    found = keep(found.select("id", "key", "base", weak.alias("weak")), "secrets")
    parts = (
        found.where(F.size("weak") > 0)
        .dropDuplicates(["key"])
        .select("key", F.inline(F.concat("base", "weak").cast(SPAN)))
    )
    every = F.concat(base, F.coalesce(F.col("added"), F.array().cast(SPAN)))
    order = F.array(*(F.lit(k) for k in (*BASE, *WEAK)))
    ordered = F.array_sort(
        F.transform(
            every,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(order, s["kind"]).alias("rank"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
            ),
        )
    )
    spans = F.transform(ordered, lambda s: F.struct(s["kind"], s["start"].alias("start"), s["end"].alias("end")))
    return found.join(_linked(parts), "key", "left").select(F.col("id").alias(id), spans.cast(SPAN).alias("spans"))
