"""Registered queries of the operators on training data, and the same results in SQL for DuckDB."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from larderlake.llm import (
    conversations,
    credentials,
    decontaminate,
    language,
    lm_difference,
    mixing,
    near_dedup,
    pii,
    quality,
    search,
    spelling,
    token_lengths,
    url_filter,
)
from larderlake.llm.spans import joined, of_kind
from larderlake.llm.tables import ship
from larderlake.llm.url_filter import Rule

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def sql_matches(text: str, pattern: str, kind: str) -> str:
    """DuckDB: all matches of a pattern as a list of structs kind, s, e, found; places in code points."""
    found = f"regexp_extract_all({text}, '{pattern}')"
    gaps = f"list_transform(string_split_regex({text}, '{pattern}'), lambda x: length(x))"
    return f"""(case when regexp_matches({text}, '{pattern}') then list_transform(
        list_zip({found}, range(len({found}))),
        lambda z: {{'kind': '{kind}', 'found': z[1],
          's': cast(list_sum(({gaps})[1:z[2] + 1])
            + coalesce(list_sum(list_transform(({found})[1:z[2]], lambda y: length(y))), 0) as bigint)
        }}) else [] end)"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of the benchmark."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    leaks = F.col("leaks")
    return found.select(
        "doc_id",
        leaks["n_words"].alias("n_words"),
        leaks["n_hit"].alias("n_hit"),
        F.size(leaks["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(leaks["items"]), ","), 256).alias("items_sha256"),
        (leaks["n_hit"] > 0).alias("contaminated"),
    )


ORACLE["op1_decontaminate"] = f"""
    with doc as (select doc_id, {{words}} w from documents),
    item as (select cast(item_id as varchar) item, {{words}} w from benchmark),
    item_win as (select distinct item, least(len(w), {decontaminate.WINDOW}) n,
        array_to_string(w[i:i + least(len(w), {decontaminate.WINDOW}) - 1], ' ') k
        from item, unnest(range(1, greatest(len(w) - {decontaminate.WINDOW}, 0) + 2)) u(i) where len(w) > 0),
    lengths as (select distinct n from item_win),
    doc_win as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') k
        from doc, lengths, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) u(i)),
    hit as (select doc_id, item, d.n, i from doc_win d join item_win using (n, k)),
    pos as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by 1),
    items as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) s
        from (select distinct doc_id, item from hit) group by 1)
    select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
      sha256(coalesce(s, '')) items_sha256, n_hit is not null contaminated
    from doc left join pos using (doc_id) left join items using (doc_id)
""".replace(
    "{words}",
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')",
)


@query
def op2_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of credentials in every document."""
    found = credentials.find_secrets(read(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(F.size(of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in credentials.BASE),
        F.sha2(joined(of_kind(spans, *credentials.BASE)), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def _credentials_sql() -> str:
    pattern = {k: p.replace("'", "''") for k, p in credentials.PATTERNS.items()}
    pattern["blob"] = "[A-Za-z0-9+/_=-]{20,}"
    ok = {
        "assign": f"length(regexp_extract(x.found, '{pattern['assign']}', 2)) >= {credentials.MIN_VALUE}",
        "access": f"length(x.found) >= {credentials.MIN_ACCESS}",
        "hex": "true",
        "user": f"length(regexp_extract(x.found, '{pattern['user']}', 2)) >= {credentials.MIN_USER}",
        "blob": "regexp_matches(x.found, '[0-9]') and regexp_matches(x.found, '[A-Z]') and regexp_matches(x.found, '[a-z]')",
        "endpoint": "true",
    }
    parts = "\nunion all by name\n".join(
        f"""select doc_id, '{k}' kind, {i} rank, '{credentials.ROLE[k]}' role, {str(k in credentials.BASE).lower()} strong,
        x.s s, x.s + length(x.found) e from (select doc_id, unnest({sql_matches("t", pattern[k], k)}) x from texts) where {ok[k]}"""
        for i, k in enumerate(pattern)
    )
    show = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, rank){}, '')"
    return f"""
    with texts as (select doc_id, coalesce(text, '') t from documents),
    raw as ({parts}),
    part as (select * from raw a where kind <> 'blob' or not exists (
        select 1 from raw b where b.doc_id = a.doc_id and b.strong and b.s < a.e and a.s < b.e)),
    near as (select a.doc_id, a.kind, a.s from part a join part b on a.doc_id = b.doc_id and a.role <> b.role
        and b.s - a.e <= {credentials.REACH} and a.s - b.e <= {credentials.REACH} where not a.strong
        group by all having bool_or(b.strong) or count(distinct b.role) >= 2),
    span as (select * from part where strong or (doc_id, kind, s) in (select (doc_id, kind, s) from near))
    select doc_id, {", ".join(f"count(*) filter (where kind = '{k}') n_{k}" for k in credentials.BASE)},
      sha256({show.format(" filter (where strong)")}) base_sha256, {show.format("")} spans
    from texts left join span using (doc_id) group by doc_id"""


ORACLE["op2_credentials"] = _credentials_sql()


#: Every document whose id is divisible by this asks for its likes.
QUERY_EVERY = 100
TOP = 10


@query
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best matches of every hundredth document among all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return search.top_k(docs, docs.where(F.col("doc_id") % QUERY_EVERY == 0), TOP)


ORACLE["op3_top_k"] = f"""
    with doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
    tf as (select doc_id, t, count(*)::double f from (select doc_id, unnest(w) t from doc) group by 1, 2),
    len as (select doc_id, len(w)::double dl from doc),
    total as (select count(*) n, avg(dl) mean from len),
    idf as (select t, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) idf from tf, total group by t),
    impact as (select tf.doc_id, t, cast(round(1e6 * idf * (f * ({search.K1} + 1))
        / (f + {search.K1} * (1 - {search.B} + {search.B} * dl / mean))) as bigint) v
        from tf join idf using (t) join len using (doc_id), total),
    score as (select q.doc_id query, i.doc_id, sum(v)::bigint s from tf q join impact i using (t)
        where q.doc_id % {QUERY_EVERY} = 0 group by 1, 2),
    ranked as (select *, row_number() over (partition by query order by s desc, doc_id) r from score)
    select query, cast(r as int) rank, doc_id, s / 1e6 score from ranked where r <= {TOP}
"""


@query
def op4_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more like texts of good quality every document is than like all texts."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    good = read(spark, sf_dir, "labels").where("quality = 1")
    found = lm_difference.score(docs, lm_difference.learn(docs, good))
    return found.select("doc_id", F.col("lm.tokens").alias("tokens"), F.col("lm.difference").alias("difference"))


@query
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words a mix to target weights takes of every document."""
    taken = mixing.mix(read(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: Rules for pages.
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    return url_filter.judge(read(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


#: The test pages declare no redirects and canonical links; equal normal forms are all aliases there.
ORACLE["op6_url_filter"] = f"""
    with rules(verdict, rhost, rpath) as (values {", ".join(str(tuple(r)) for r in URL_RULES)}),
    split as (select page_id, url, coalesce(case when contains(url, '://') then substr(url, instr(url, '://') + 3) end, '') rest
        from pages),
    part as (select page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from split),
    form as (select *, case when contains(url, '://') then
        regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '') || regexp_replace(path, '/+$', '')
        || regexp_replace(regexp_extract(regexp_replace(url, '(?i)([?&])(?:utm_[a-z]+|gclid|fbclid|mc_[a-z]+)=[^&#]*&?', '\\1', 'g'),
            '^[^?#]*(\\?[^#]*)', 1), '[?&]+$', '') else url end node from part),
    ruled as (select f.*, (select max(struct_pack(n := length(rhost || rpath), h := length(rhost), r := rhost || rpath, v := verdict))
        from rules where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)) best from form f),
    node as (select node, bool_or(best.v = 'allow') ok from ruled where best is not null group by 1)
    select page_id, host, path, best.r as rule,
      coalesce(best.v, case when ok = false then 'block' else 'allow' end) verdict
    from ruled left join node using (node)
"""


def held_out(id: str = "doc_id"):
    return F.crc32(F.col(id).cast("string")) % 4 == 2


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = read(spark, sf_dir, "documents")
    model = language.learn(docs.where(~held_out()))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


#: Where the public vocabulary files are; a parameter, as they are no part of this repository.
VOCABULARY = os.environ.get("TOKENIZER_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents have how many tokens, and what each context limit leaves of them."""
    docs = read(spark, sf_dir, "documents")
    return token_lengths.histogram(token_lengths.encoded_lengths(docs, token_lengths.read_vocabulary(VOCABULARY)))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    order = [*pii.BASE, *pii.ADDED]

    def by_kind(*kinds: str):
        return F.concat(*(of_kind(F.col("pii"), k) for k in kinds))

    return found.select(
        "doc_id",
        *(F.size(of_kind(F.col("pii"), k)).cast("long").alias(f"n_{k}") for k in pii.BASE),
        F.sha2(joined(by_kind(*pii.BASE)), 256).alias("base_sha256"),
        joined(by_kind(*order)).alias("spans"),
    )


def _pii_sql() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
    }
    found = ", ".join(f"{sql_matches('t', plain.get(k, p), k)} m_{k}" for k, p in pii.PATTERNS.items())
    digits = "regexp_replace(x.found, '[^0-9]', '', 'g')"
    ok = {
        "email": "true",
        "ip": f"regexp_matches(x.found, '{pii.IP_PARTS}')",
        "card": f"""length({digits}) between 13 and 19 and list_sum(list_transform(range(1, length({digits}) + 1),
            lambda i: (cast(substr({digits}, length({digits}) - i + 1, 1) as int) * (2 - i % 2)) // 10
            + (cast(substr({digits}, length({digits}) - i + 1, 1) as int) * (2 - i % 2)) % 10)) % 10 = 0""",
        "phone": f"length({digits}) between 9 and 15",
        "iban": """length(replace(x.found, ' ', '')) between 15 and 34 and list_reduce(
            list_transform(string_split(substr(replace(x.found, ' ', ''), 5) || substr(replace(x.found, ' ', ''), 1, 4), ''),
            lambda c: cast(case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end as bigint)),
            lambda a, d: (a * case when d < 10 then 10 else 100 end + d) % 97, 0::bigint) = 1""",
        "local_phone": "true",
        "ssn": "true",
    }
    near = f"substr(t, greatest(x.s - {pii.REACH}, 0) + 1, x.s - greatest(x.s - {pii.REACH}, 0))"
    after = f"substr(t, x.s + length(x.found) + 1, {pii.REACH})"
    kept = []
    for k in pii.PATTERNS:
        rule = ok[k]
        if k in pii.ADDED:
            rule += f""" and len(list_filter(base, lambda o: o.s < x.s + length(x.found) and x.s < o.s + length(o.found))) = 0
                and {pii.PRIOR[k]} + case when regexp_matches({near} || ' ' || {after}, '{pii.CONTEXT[k]}') then {pii.BONUS} else 0 end
                - case when regexp_matches({near}, '[0-9]$') or regexp_matches({after}, '^[0-9]') then {pii.MALUS} else 0 end
                >= {pii.MIN_SCORE}"""
        kept.append((k, f"list_filter(m_{k}, lambda x: {rule})"))
    show = "array_to_string(list_transform({}, lambda x: x.kind || ':' || x.s || ':' || (x.s + length(x.found))), ',')"
    base = " || ".join(f"k_{k}" for k in pii.BASE)
    every = " || ".join(f"k_{k}" for k in pii.PATTERNS)
    return f"""
    with texts as (select doc_id, coalesce(text, '') t from documents),
    raw as (select doc_id, t, {found} from texts),
    sure as (select *, {", ".join(f"{x} k_{k}" for k, x in kept if k in pii.BASE)} from raw),
    based as (select *, {base} base from sure),
    added as (select *, {", ".join(f"{x} k_{k}" for k, x in kept if k in pii.ADDED)} from based)
    select doc_id, {", ".join(f"cast(len(k_{k}) as bigint) n_{k}" for k in pii.BASE)},
      sha256(coalesce({show.format("base")}, '')) base_sha256, coalesce({show.format(every)}, '') spans
    from added"""


ORACLE["op9_pii"] = _pii_sql()


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents."""
    return near_dedup.link_components(read(spark, sf_dir, "documents"))


ORACLE["op10_near_dedup"] = f"""
    with recursive doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
    shingle as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') s
        from doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) u(i) where len(w) > 0),
    size as (select doc_id, count(*) n from shingle group by 1),
    common as (select a.doc_id a, b.doc_id b, count(*) c from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id
        group by 1, 2),
    link as (select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b
        where 100 * c >= {near_dedup.PERCENT} * (x.n + y.n - c)),
    edge as (select a, b from link union all select b, a from link),
    reach as (select doc_id a, doc_id b from documents union select r.a, e.b from reach r join edge e on r.b = e.a)
    select doc_id, coalesce(n, 0) n_shingles, min(r.b) component_id, doc_id = min(r.b) kept
    from documents d join reach r on r.a = d.doc_id left join size using (doc_id) group by doc_id, n
"""


#: DuckDB has no crc32: bytes run through the table that belongs to its polynomial.
CRC_TABLE = """(select list(list_reduce(range(9), lambda c, i: case when i = 0 then n else
    xor(c >> 1, (c & 1) * 3988292384) end, n) order by n) t from range(256) u(n))"""


def sql_crc32(text: str) -> str:
    """DuckDB: unsigned crc32 of a string's UTF-8; a column ``t`` holds the table."""
    data = f"hex(encode({text}))"
    bytes = f"list_transform(range(1, length({data}), 2), lambda k: cast('0x' || {data}[k:k + 1] as bigint))"
    return f"xor(list_reduce({bytes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as broken transcripts have them, by a hash of conversation and turn; a null counts as one space."""
    space = F.lit(" ")
    part = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    damage = F.crc32(F.concat_ws(":", *part)) % 20
    role, text = (F.coalesce(F.col(name), space) for name in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), damage.alias("damage"))
    return rows.where("damage <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    table = read(spark, sf_dir, "conversations")
    rows = damaged(table)
    found = conversations.repaired_digests(rows, conversations.plan_repairs(rows)).withColumnRenamed("conv_id", "found_id")
    every = table.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    return every.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).alias(name) for name in conversations.PLAN),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _repair_sql() -> str:
    """Edits from the last row to the first; a way is its cost in 12 digits and its letters, so the least string wins."""

    def way(cost: str, letter: str, rest: str) -> str:
        return f"lpad((substr({rest}, 1, 12)::bigint + {cost})::varchar, 12, '0') || '{letter}' || substr({rest}, 13)"

    due = {"n": "u", "s": "u", "u": "a", "a": "u"}
    kept = {"n": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    moves = []
    for q in due:
        keeps = " ".join(f"when initial = '{k}' then {way('more', 'K', f'p.{to}')}" for k, to in kept[q].items())
        moves.append(f"""least({way("2", "D", f"p.{q}")}, case when not forced then least({way("1 + more", "R", f"p.{due[q]}")},
            case {keeps} end) end) as {q}""")
    inserts = [f"least({q}, {way('5', 'I', due[q])}, {way('10', 'II', due[due[q]])}) as {q}" for q in due]
    return f"""
    with recursive crc as {CRC_TABLE},
    raw as (select conv_id, turn, coalesce(role, ' ') r, coalesce(text, ' ') x,
        {sql_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 d from conversations, crc),
    torn as (select conv_id, turn, case when d = 4 then 'user' else r end r,
        case d when 1 then '' when 2 then translate(x, '.!?', '') else x end x
        from raw, unnest(case when d = 3 then [0, 1] else [0] end) u(i) where d <> 0),
    placed as (select *, row_number() over (partition by conv_id order by turn nulls first, r, sha256(x)) i from torn),
    faulty as (select *, rtrim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') y,
        row_number() over (partition by conv_id, r, x order by i) > 1 again from placed),
    fault as (select conv_id, turn, i, r, x, substr(r, 1, 1) initial, case when y = '' then 'blank' when again then 'duplicate'
        when right(y, 1) not in ('.', '!', '?') then 'truncated' end f from faulty),
    steps as (select conv_id, i, initial, coalesce(f in ('blank', 'duplicate'), false) forced, case when f = 'truncated' then 5 else 0 end more
        from fault),
    summary as (select conv_id, max(i) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
        count(*) filter (where f = 'blank') blank, count(*) filter (where f = 'duplicate') duplicate,
        count(*) filter (where f = 'truncated') truncated from fault group by 1),
    pairs as (select conv_id, count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) illegal from (
        select conv_id, initial, lag(initial) over (partition by conv_id order by i) before from fault) group by 1),
    back as (
        select conv_id, n i, lpad('', 12, '0') n, lpad('10', 12, '0') || 'II' s, lpad('5', 12, '0') || 'I' u, lpad('', 12, '0') a from summary
        union all
        select conv_id, i, {", ".join(inserts)} from (
            select p.conv_id, p.i - 1 i, {", ".join(moves)}
            from back p join steps e on e.conv_id is not distinct from p.conv_id and e.i = p.i)),
    plan as (select conv_id, substr(n, 1, 12)::bigint cost, substr(n, 13) audit from back where i = 0),
    letters as (select conv_id, k, audit[k] letter from plan, unnest(range(1, length(audit) + 1)) u(k)),
    walked as (select conv_id, k, letter, count(*) filter (where letter <> 'I') over w i,
        count(*) filter (where letter <> 'D') over w j from letters window w as (partition by conv_id order by k)),
    edited as (select w.conv_id, k, j, letter, r, x, initial from walked w
        join fault e on e.conv_id is not distinct from w.conv_id and e.i = greatest(w.i, 1) where letter <> 'D'),
    begun as (select conv_id, max((j = 1 and letter = 'K' and initial = 's')::int) sys from edited group by 1),
    repaired as (select e.conv_id, sha256(string_agg(case when letter = 'K' then r when (j - sys) % 2 = 1 then 'user' else 'assistant' end
        || ':' || case when letter = 'I' then '' else x end, chr(10) order by k)) digest
        from edited e join begun b on e.conv_id is not distinct from b.conv_id group by 1)
    select c.conv_id, {", ".join(f"coalesce({x}, 0)::bigint {x}" for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
      coalesce(audit, '') audit, coalesce(digest, sha256('')) repaired_sha256
    from (select distinct conv_id from conversations) c
    left join summary s on s.conv_id is not distinct from c.conv_id left join pairs t on t.conv_id is not distinct from c.conv_id
    left join plan p on p.conv_id is not distinct from c.conv_id left join repaired d on d.conv_id is not distinct from c.conv_id
    """


ORACLE["op11_conversation_repair"] = _repair_sql()


#: Of so many hashes of a run in a document one means a slip of the pen: a letter is lost.
SLIPS = 97


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, slips of the pen among them, with the forms and roots they vary."""
    runs = spelling.runs(read(spark, sf_dir, "documents"))
    h, run = F.crc32(F.concat("id", F.lit(":"), "run")), F.col("run")
    lost = (h % F.length(run)).cast("int")
    torn = F.concat(F.substr(run, F.lit(1), lost), F.substr(run, lost + 2))
    return spelling.group_variants(spelling.count_words(runs, F.when(h % SLIPS == 0, torn).otherwise(run)))


ORACLE["op12_spelling_variants"] = f"""
    with recursive crc as {CRC_TABLE},
    run as (select id, w, count(*) c from (select coalesce(doc_id::varchar, '') id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}'), '[a-z\u00C0-\u00FF]+')) w from documents) group by all),
    hashed as (select w, c, {sql_crc32("id || ':' || w")} h from run, crc),
    torn as (select case when h % {SLIPS} = 0 then substr(w, 1, (h % length(w))::bigint) || substr(w, (h % length(w))::bigint + 2) else w end word, c from hashed),
    words as (select word, sum(c)::bigint n from torn where length(word) >= {spelling.MIN_LENGTH} group by 1 having n >= {spelling.MIN_COUNT}),
    less as (select distinct word, substr(word, 1, i - 1) || substr(word, i + 1) cut from words, unnest(range(1, length(word) + 1)) u(i)),
    hole as (select word, i, substr(word, 1, i - 1) || '?' || substr(word, i + 1) cut from words, unnest(range(1, length(word) + 1)) u(i)),
    half as (select a.word a, b.word b from less a join words b on a.cut = b.word),
    near as (select a, b from half union all select b, a from half
        union all select a.word, b.word from hole a join hole b on a.cut = b.cut and a.i = b.i and a.word <> b.word),
    ranked as (select a, b, n, count(*) over (partition by a) n_near,
        row_number() over (partition by a order by n desc, encode(b)) r from near join words on b = word),
    formed as (select w.word, case when r.n >= {spelling.TIMES} * w.n then b end form, w.n, coalesce(n_near, 0) n_near,
        case when r.n >= {spelling.TIMES} * w.n then r.n end form_n from words w left join ranked r on r.a = w.word and r.r = 1),
    road as (select word, word place, 0 step from words
        union all select road.word, form, step + 1 from road join formed f on f.word = road.place where form is not null)
    select word, form, arg_max(place, step) root, any_value(n)::bigint n, any_value(n_near)::bigint n_near, any_value(form_n)::bigint form_n
    from formed join road using (word) group by word, form
"""


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, the probability that it is good, and whether it is kept."""
    found = quality.judge(read(spark, sf_dir, "documents"), carry=["doc_id"])
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
    return found.select("doc_id", *(F.col(f"quality.{name}").alias(name) for name in base))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training corpus that all stages together make of the documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
