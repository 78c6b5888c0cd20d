"""Queries of the training-data operators: key -> callable(spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, hilbert, langid, multiset, packing, pages, quality, search, secrets, simhash, suffix, vectorcodes
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


@query("op3_language_id")
def _op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op8_packing")
def _op8(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op10_bpe")
def _op10(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"))


#: The extra conversation that op4 formats beside the table.
CONTROL_CASE = "</s>[INST] ok [/INST]"


@query("op1_secrets")
def _op1(spark, sf_dir):
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


#: The pattern of assigned secrets, as the contract has it, in the SQL engine's syntax.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"


def _secrets_sql(max_owners: int = secrets.MAX_OWNERS, max_repos: int = secrets.MAX_REPOS) -> str:
    """The scan as SQL: matches and the text between them give positions by running sums of lengths, and a value's bare
    places are where the text is split by it."""
    patterns = (ASSIGN, secrets.ACCESS, secrets.HEX)
    places = " UNION ALL ".join(f"""
        SELECT rid, {kind} AS kind, unnest(ms) AS s, unnest(gs[1:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i
        FROM (SELECT rid, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gs FROM d)"""
                                for kind, p in enumerate(patterns))
    digit = "regexp_matches({}, '[0-9]')".format
    parts = "regexp_extract_all(c, '[A-Za-z0-9]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
                  concat_ws('/', source, lang, doc_id // {secrets.BLOCK}) AS repo FROM documents),
m AS (SELECT *, sum(length(g) + length(s)) OVER (PARTITION BY rid, kind ORDER BY i) AS e FROM ({places})),
spans AS (SELECT rid, kind, CAST(e - length(s) AS BIGINT) AS b, CAST(e AS BIGINT) AS e,
                 CASE WHEN kind = 0 THEN regexp_extract(s, '{ASSIGN}', 2) ELSE s END AS v FROM m),
base AS (SELECT rid, kind, b, e, trim(v, '{secrets.EDGE}') AS c FROM spans WHERE kind > 0 OR length(v) >= 12),
cores AS (SELECT DISTINCT c,
                 {digit('c')} AND regexp_matches(c, '[A-Za-z]') AND len(list_distinct(string_split(c, ''))) >= 8
                 AND NOT regexp_matches(c, '(?i)example|sample|dummy|changeme|placeholder|xxxx|1234567890')
                 AND len(list_filter(range(1, length(c) - 4), lambda j: replace(substr(c, j, 6), substr(c, j, 1), '') = '')) = 0 AS live,
                 {parts} AS ps, string_split_regex(c, '[A-Za-z0-9]+') AS gs FROM base),
sought AS (SELECT c FROM cores WHERE length(c) BETWEEN {secrets.SINGLE} AND {secrets.LONGEST} AND CASE WHEN len(ps) = 1 THEN {digit('c')} ELSE
             len(list_filter(range(1, len(ps)), lambda i: length(ps[i] || gs[i + 1] || ps[i + 1]) >= {secrets.PAIR}
                             AND {digit('ps[i] || ps[i + 1]')})) > 0 END),
cut AS (SELECT rid, c, string_split(t, c) AS q FROM d JOIN sought ON contains(t, c)),
bare AS (SELECT rid, c, b, b + length(c) AS e FROM (
           SELECT rid, c, unnest(range(1, len(q))) AS k, q,
                  unnest(list_transform(range(1, len(q)), lambda k: list_sum(list_transform(q[1:k], lambda x: length(x))) + (k - 1) * length(c)))::BIGINT AS b
           FROM cut)
         WHERE NOT regexp_matches(q[k], '[A-Za-z0-9]$') AND NOT regexp_matches(q[k + 1], '^[A-Za-z0-9]')
           AND NOT (k > 1 AND q[k] = '') AND NOT (k < len(q) - 1 AND q[k + 1] = '')),
verdicts AS (
  SELECT c, count(DISTINCT owner) AS n_owners, count(DISTINCT repo) AS n_repos,
         CASE WHEN count(DISTINCT owner) > {max_owners} OR count(DISTINCT repo) > {max_repos} THEN 'copied'
              WHEN any_value(live) THEN 'live' ELSE 'weak' END AS verdict
  FROM (SELECT rid, c FROM base UNION ALL SELECT rid, c FROM bare) JOIN d USING (rid) JOIN cores USING (c) GROUP BY c),
judged AS (SELECT base.*, verdict, n_owners, n_repos FROM base JOIN verdicts USING (c)),
shown AS (
  SELECT rid, kind, b, e, verdict, n_owners, n_repos FROM judged
  UNION ALL
  SELECT DISTINCT rid, 3, b, e, NULL, NULL, NULL FROM bare JOIN verdicts USING (c)
  WHERE verdict = 'live' AND NOT EXISTS (SELECT 1 FROM base o WHERE o.rid = bare.rid AND o.b <= bare.b AND o.e >= bare.e)),
named AS (SELECT *, (['assign', 'access', 'hex', 'owned'])[kind + 1] || ':' || b || ':' || e AS span FROM shown)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY b, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY b, kind, e), '') AS spans,
       count(*) FILTER (kind < 3 AND verdict = 'live') AS n_live, count(*) FILTER (kind < 3 AND verdict = 'copied') AS n_copied,
       coalesce(max(n_owners), 0)::BIGINT AS n_owners, coalesce(max(n_repos), 0)::BIGINT AS n_repos
FROM d LEFT JOIN named USING (rid) GROUP BY d.rid, d.doc_id
"""


ORACLE["op1_secrets"] = _secrets_sql()


@query("op4_chat")
def _op4(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"""
        SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{CONTROL_CASE}' AS text
        UNION ALL SELECT -7L, 1L, 'assistant', '{CONTROL_CASE}'""")
    turns = turns.unionByName(extra)
    return chat.digests(chat.format_chats(turns.withColumn("parts", chat.text_parts(turns["text"]))))


ORACLE["op4_chat"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_CASE}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_CASE}'),
sized AS (
  SELECT *, length(role) + length(text)
         + length(regexp_replace(role || text, '[^\\\\<\\[]', '', 'g')) + {len(chat.TURN + chat.SAYS + chat.END)} AS n
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op9_multiset")
def _op9(spark, sf_dir):
    return multiset.compare_edited(table(spark, sf_dir, "documents"))


@query("op2_quality")
def _op2(spark, sf_dir):
    return quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), in_place=True)


@query("op7_html")
def _op7(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query("op6_simhash")
def _op6(spark, sf_dir):
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(simhash.F.col("fp")).alias("fingerprint"), "component_id")


@query("op5_suffix")
def _op5(spark, sf_dir):
    return suffix.dedup_digests(table(spark, sf_dir, "documents"))


@query("op13_hilbert")
def _op13(spark, sf_dir):
    return hilbert.shard(table(spark, sf_dir, "documents"))


def _hilbert_sql(shards: int = 16) -> str:
    """Shards of equal counts along the curve as SQL: checksum by its table, cells by a histogram, the curve level by level."""
    bits, fine, width = hilbert.BITS, hilbert.FINE, 2 * hilbert.IMAGE_BYTES
    checksum = """
        xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""

    def place(c: str) -> str:
        return f"('0x' || rpad(substr({c}, 2 * skip + 1, {width}), {width}, '0'))::BIGINT"

    ends = ", ".join(f"""
      {d}_ends AS (SELECT *, coalesce(list_min(list_filter(range(1, least(length(lo), length(hi)) // 2 + 1),
                     lambda i: substr(lo, 2 * i - 1, 2) <> substr(hi, 2 * i - 1, 2))) - 1, least(length(lo), length(hi)) // 2) AS skip
                   FROM (SELECT coalesce(hex(encode(min({d}))), '') AS lo, coalesce(hex(encode(max({d}))), '') AS hi FROM documents))"""
                     for d in ("lang", "source"))
    image = {d: place(f"hex(encode({d}))") for d in ("lang", "source")}
    slot = {d: f"""(SELECT CASE WHEN {d} IS NULL THEN 0 ELSE
                   ({image[d]} - {place('lo')}) * {fine - 1} // ({place('hi')} - {place('lo')} + 1) + 1 END FROM {d}_ends)"""
            for d in ("lang", "source")}
    key = {d: f"(SELECT CASE WHEN {d} IS NULL THEN 0 ELSE {image[d]} + 1 END FROM {d}_ends)" for d in ("lang", "source")} | {"size": "size"}
    m = hilbert.MANTISSA
    top = "(length(bin(size)) - 1)"
    slot["size"] = f"({top} * {1 << m} + (CASE WHEN {top} >= {m} THEN size >> ({top} - {m}) ELSE size << ({m} - {top}) END & {(1 << m) - 1}) + 1)"
    dims = list(hilbert.DIMENSIONS)
    names = [f"x{i}" for i in range(len(dims))]
    levels, last = [], "cells"
    for level in range(bits - 1, 0, -1):
        low, first, turned = (1 << level) - 1, "x0", []
        for i, a in enumerate(names):
            on = f"({a if i else 'x0'} & {1 << level}) <> 0"
            if i:
                swap = f"(xor({first}, {a}) & {low})"
                turned.append(f"CASE WHEN {on} THEN {a} ELSE xor({a}, {swap}) END AS {a}")
                first = f"CASE WHEN {on} THEN xor({first}, {low}) ELSE xor({first}, {swap}) END"
            else:
                first = f"CASE WHEN {on} THEN xor(x0, {low}) ELSE x0 END"
        levels.append(f"l{level} AS (SELECT rid, {first} AS x0, {', '.join(turned)} FROM {last})")
        last = f"l{level}"
    gray = ", ".join([f"{a} AS {a}" if i == 0 else f"{_xor(names[:i + 1])} AS {a}" for i, a in enumerate(names)])
    parity = _xor([f"({names[-1]} >> {k})" for k in range(1, bits)])
    index = " + ".join(f"(((xor({a}, t) >> {level}) & 1) << {level * len(names) + i})"
                       for level in range(bits) for i, a in enumerate(reversed(names)))
    return f"""
WITH RECURSIVE steps AS (SELECT range AS i, range::BIGINT AS v, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8), {ends},
d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
             octet_length(encode(coalesce(text, ''))) + 1 AS size FROM documents),
sized AS (SELECT rid, doc_id, size, {checksum} AS text_crc32, {', '.join(f'{slot[x]} AS s{i}, {key[x]} AS k{i}' for i, x in enumerate(dims))} FROM d, crc),
cells AS (SELECT rid, {', '.join(f"((rank() OVER (ORDER BY s{i}) - 1) * {1 << bits} // count(*) OVER ())::BIGINT AS x{i}" for i in range(len(dims)))} FROM sized),
{', '.join(levels)},
gray AS (SELECT rid, {gray} FROM {last}),
turned AS (SELECT rid, {', '.join(names)}, {parity} AS t FROM gray),
curve AS (SELECT rid, {index} AS curve FROM turned),
ranked AS (SELECT *, row_number() OVER (ORDER BY curve, {', '.join(f'k{i}' for i in range(len(dims)))}, text_crc32, size, doc_id NULLS FIRST) - 1 AS r, count(*) OVER () AS n
           FROM sized JOIN curve USING (rid))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (r * {shards} // n)::INT AS shard,
       (r - ((r * {shards} // n) * n + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INT AS grown_shard, curve::BIGINT AS curve
FROM ranked
"""


def _xor(terms: list[str]) -> str:
    return terms[0] if len(terms) == 1 else f"xor({_xor(terms[:-1])}, {terms[-1]})"


ORACLE["op13_hilbert"] = _hilbert_sql()


@query("op12_search")
def _op12(spark, sf_dir):
    return search.search(search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


#: Fixed value: the characters of a term.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE["op12_search"] = f"""
WITH terms AS (SELECT row_number() OVER () AS rid, doc_id,
                      regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{TERM}') AS ts
               FROM documents),
held AS (SELECT rid, doc_id, len(ts) AS n, unnest(ts) AS term FROM terms),
total AS (SELECT count(*) FILTER (len(ts) > 0)::BIGINT AS docs, sum(len(ts))::BIGINT AS size FROM terms),
postings AS (SELECT rid, any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n, term, count(*)::BIGINT AS tf FROM held GROUP BY rid, term),
asked AS (SELECT iid, item_id, term, count(*)::BIGINT AS times
          FROM (SELECT row_number() OVER () AS iid, item_id,
                       unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{TERM}')) AS term
                FROM benchmark) GROUP BY iid, item_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), total),
scores AS (SELECT iid, item_id, rid, doc_id,
                  sum(times * w * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * n * docs // size))))::BIGINT AS score
           FROM asked JOIN postings USING (term) JOIN weights USING (term), total GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""


@query("op11_vector_codes")
def _op11(spark, sf_dir):
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def _codes_sql(parts: int = vectorcodes.PARTS, entries: int = vectorcodes.ENTRIES, rounds: int = vectorcodes.ROUNDS) -> str:
    """Codebooks and codes as SQL: every part against every entry, round by round."""
    def assigned(r: int) -> str:
        return f"""a{r} AS (
  SELECT rid, part, any_value(v) AS v, min(struct_pack(d := d, e := entry)) AS best
  FROM (SELECT rid, part, v, entry, list_sum(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM pieces JOIN c{r} USING (part)) GROUP BY rid, part)"""

    def moved(r: int) -> str:
        return f"""c{r + 1} AS (
  SELECT part, entry, coalesce(moved, e) AS e FROM c{r} LEFT JOIN (
    SELECT part, entry, list(x ORDER BY i) AS moved FROM (
      SELECT part, entry, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
      FROM (SELECT part, best.e AS entry, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY part, entry, i)
    GROUP BY part, entry) USING (part, entry))"""

    steps = ", ".join(x for r in range(rounds) for x in (assigned(r), moved(r)))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor({vectorcodes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (SELECT rid, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v
           FROM kept, (SELECT unnest(range({parts})) AS part)),
c0 AS (SELECT part, rid - 1 AS entry, v AS e FROM pieces WHERE rid <= {entries}),
{steps}, {assigned(rounds)},
coded AS (SELECT rid, string_agg(lower(lpad(hex(best.e), 2, '0')), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
          FROM a{rounds} GROUP BY rid),
book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
         FROM (SELECT part, entry, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM c{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), book
"""


ORACLE["op11_vector_codes"] = _codes_sql()
