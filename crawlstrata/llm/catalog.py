"""Queries of the corpus operators over the given tables, with their DuckDB text where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.llm import chat, codes, exactdedup, jaccard, langid, licenses, linededup, mixing, packing, quality, spelling, toxicity, urlfilter
from crawlstrata.llm.common import table
from crawlstrata.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {SPACE_SQL}), '{linededup.UPPER}', '{linededup.LOWER}') AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op6_line_dedup(spark, d):
    """Lines of 40 characters in 5 documents or more, in all documents."""
    kept = linededup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query("""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
grouped AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN grouped USING (text_sha256)""")
def op8_exact_dedup(spark, d):
    """Equal texts up to white space, in all documents."""
    return exactdedup.exact_copies(table(spark, d, "documents"))


# The rules of the contract, and unwanted hosts, each name under each top domain and with any path.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
UNWANTED_NAMES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
UNWANTED_HOSTS = [f"{name}.example.{top}" for name in UNWANTED_NAMES for top in ("com", "net", "org")]


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


@query(f"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{linededup.UPPER}', '{linededup.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS (
  SELECT *, CASE {' '.join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1])))} END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE {' '.join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in URL_RULES)}
            WHEN {' OR '.join(_fits(h, '') for h in UNWANTED_HOSTS)} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""")
def op3_url_filter(spark, d):
    """The rules and the list of unwanted hosts over all pages."""
    entries = [(h, p, v, True) for h, p, v in URL_RULES] + [(h, "", "block", False) for h in UNWANTED_HOSTS]
    listed = spark.createDataFrame(entries, "host string, path string, verdict string, rule boolean")
    return urlfilter.judge_urls(table(spark, d, "pages"), listed).drop("entry")


@query()
def op10_quality_rules(spark, d):
    """Base rules and the isolation forest over all documents."""
    return quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))


@query()
def op9_packing(spark, d):
    """All documents in sequences of 1,024 tokens."""
    return packing.pack(table(spark, d, "documents"), with_ids=False)


@query()
def op1_license_scan(spark, d):
    """Licence phrases and templates in all documents."""
    return licenses.scan(table(spark, d, "documents")).drop("spans")


@query()
def op2_toxicity(spark, d):
    """Toxicity of all documents, learnt from the labelled ones that are not held out."""
    return toxicity.judge(table(spark, d, "documents"), table(spark, d, "labels"))


@query()
def op4_language_id(spark, d):
    """Language of all documents, learnt from those that are not held out."""
    return langid.identify(table(spark, d, "documents"))


@query()
def op5_jaccard_join(spark, d):
    """Documents linked by three-word shingles at 90 percent, in all documents."""
    return jaccard.link_documents(table(spark, d, "documents"))


# The production mixture.
MIX_ROUNDS = 10
MIX_BUDGET = 0.5
MIX_TARGETS = {
    "source": {"src0": 0.25, "src1": 0.04, "src2": 0.04, "src3": 0.04, "src4": 0.04, "other": 0.59},
    "lang": {"en": 0.5, "fr": 0.18, "de": 0.18, "es": 0.14, "other": 0.05},
    "topic": {"prose": 0.93, "tabular": 0.03, "contact": 0.04},
}


def mix_columns() -> dict:
    """How the target columns are taken from a document; the topic is told from the form of the text."""
    topic = F.when(F.contains("text", F.lit(" | ")), "tabular").when(F.contains("text", F.lit("@")), "contact").otherwise("prose")
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}


def mix_sql(documents: str) -> str:
    """DuckDB text of the mixture over a table: the rounds written out, one after another."""
    dims = list(MIX_TARGETS)
    value = {
        "source": "source", "lang": "lang",
        "topic": "CASE WHEN contains(text, ' | ') THEN 'tabular' WHEN contains(text, '@') THEN 'contact' ELSE 'prose' END",
    }
    known = {d: ", ".join(f"'{k}'" for k in MIX_TARGETS[d] if k != "other") for d in dims}
    group = ", ".join(f"CASE WHEN {value[d]} IN ({known[d]}) THEN {value[d]} ELSE 'other' END AS m_{d}" for d in dims)
    keys = ", ".join(f"m_{d}" for d in dims)
    goal = {d: "CASE m_{} {} ELSE 0.0::DOUBLE END".format(d, " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in MIX_TARGETS[d].items())) for d in dims}
    steps = [
        f"rows AS (SELECT *, {group}, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM {documents})",
        f"cells AS (SELECT {keys}, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS weight FROM rows GROUP BY ALL)",
        f"room AS (SELECT {MIX_BUDGET}::DOUBLE * sum(weight) AS room FROM cells)",
    ]

    def factor(ask: str, most: str, order: str, table: str) -> str:
        """The factor by which `ask` fills the room where no row gets more than its `most`."""
        by = f"ORDER BY CASE WHEN {ask} > 0 THEN {ask} / {most} ELSE 0 END DESC, {order} ROWS BETWEEN"
        ahead, left = f"sum({most}) OVER ({by} UNBOUNDED PRECEDING AND 1 PRECEDING)", f"sum({ask}) OVER ({by} CURRENT ROW AND UNBOUNDED FOLLOWING)"
        each = f"SELECT CASE WHEN {left} > 0 THEN (room - coalesce({ahead}, 0)) / {left} END AS f FROM {table}, room"
        return f"(SELECT coalesce(max(f), 0) FROM ({each}))"

    for d in dims:
        steps.append(
            f"asked_{d} AS (SELECT m_{d}, held, {goal[d]} AS target, CASE WHEN held > 0 THEN {goal[d]} ELSE 0 END AS ask "
            f"FROM (SELECT m_{d}, sum(weight) AS held FROM cells GROUP BY ALL))"
        )
        steps.append(f"goals_{d} AS (SELECT m_{d}, least(target * {factor('ask', 'held', f'm_{d}', f'asked_{d}')}, held) AS goal FROM asked_{d})")
    last = "cells"
    for i in range(MIX_ROUNDS):
        for d in dims:
            steps.append(
                f"r{i}_{d} AS (SELECT {keys}, tokens, CASE WHEN sum(weight) OVER (PARTITION BY m_{d}) > 0 THEN least(tokens::DOUBLE, weight * goal / "
                f"sum(weight) OVER (PARTITION BY m_{d})) ELSE 0 END AS weight FROM {last} JOIN goals_{d} USING (m_{d}))"
            )
            last = f"r{i}_{d}"
    made = f"least(tokens::DOUBLE, weight * {factor('weight', 'tokens', keys, last)})"
    steps.append(f"chances AS (SELECT {keys}, round(CASE WHEN tokens > 0 THEN {made} / tokens ELSE 0 END, 9) AS probability FROM {last})")
    steps.append(
        "rated AS (SELECT rows.*, probability, coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 0) < probability AS kept "
        f"FROM rows JOIN chances USING ({keys}))"
    )
    return ", ".join(steps)


@query(f"WITH {mix_sql('documents')} SELECT doc_id, m_source AS source, m_lang AS lang, m_topic AS topic, tokens, probability, kept FROM rated")
def op7_mixing(spark, d):
    """Token weights of all documents raked to source, language and topic within a budget, and the documents sampled."""
    return mixing.mix(table(spark, d, "documents"), mix_columns(), MIX_TARGETS, rounds=MIX_ROUNDS, budget=MIX_BUDGET)


# The conversation that the contract adds.
ADDED_CHAT = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def escape_sql(text: str) -> str:
    """DuckDB text of `chat.escape`."""
    for start in "<[":
        rests = "|".join(re.escape(c[1:]) for c in chat.CONTROLS if c[0] == start)
        text = f"regexp_replace({text}, '{re.escape(start)}(\\\\*(?:{rests}))', '{start}\\\\\\1', 'g')"
    return text


@query(f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES {', '.join(map(str, ADDED_CHAT))}),
said AS (
  SELECT *, length({escape_sql('text')}) + CASE role WHEN 'user' THEN {len(chat.ASK + chat.ASKED)} WHEN 'assistant' THEN {len(chat.DONE)}
            ELSE {len(chat.ROLE + chat.TEXT + chat.TURN)} + length({escape_sql('role')}) END AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       ({len(chat.BEGIN)} + sum(chars))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id""")
def op11_chat_format(spark, d):
    """All conversations and the added one, formatted, encoded and masked; read back from that."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED_CHAT, "conv_id long, turn long, role string, text string")
    return chat.digests(stage(chat.format_chats(rows.unionByName(added))))


# Parts of a vector, entries of a codebook, rounds and scale of the contract.
CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS, CODE_SCALE = 16, 64, 2, 256


def codes_sql() -> str:
    """DuckDB text of the codes: the rounds written out, one after another."""
    steps = [
        "kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, "
        f"list_transform(embedding, lambda x: floor({CODE_SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"cut AS (SELECT r, p, v[p * (len(v) // {CODE_PARTS}) + 1 : (p + 1) * (len(v) // {CODE_PARTS})] AS x FROM kept, range({CODE_PARTS}) t(p))",
        f"c0 AS (SELECT p, r - 1 AS j, x AS c FROM cut WHERE r <= {CODE_ENTRIES})",
    ]
    far = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT"
    for k in range(CODE_ROUNDS + 1):
        steps.append(f"a{k} AS (SELECT r, p, any_value(x) AS x, min({{'d': {far}, 'j': j}}) AS best FROM cut JOIN c{k} USING (p) GROUP BY r, p)")
        if k < CODE_ROUNDS:
            steps += [
                f"s{k} AS (SELECT p, j, i, sum(e)::BIGINT AS s, count(*) AS n FROM (SELECT p, best.j AS j, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY ALL)",
                f"m{k} AS (SELECT p, j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY p, j)",
                f"c{k + 1} AS (SELECT p, j, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (p, j))",
            ]
    last = CODE_ROUNDS
    steps += [
        f"coded AS (SELECT r, string_agg(lpad(to_hex(best.j), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{last} GROUP BY r)",
        f"books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{last})",
    ]
    return ", ".join(steps)


@query(f"""
WITH {codes_sql()}
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN books""")
def op12_vector_codes(spark, d):
    """All vectors by 16 codebooks of 64 entries, fitted in two rounds over all of them."""
    coded, history = codes.compress(
        table(spark, d, "embeddings"), carry=("label",), parts=CODE_PARTS, entries=CODE_ENTRIES, rounds=CODE_ROUNDS, scale=CODE_SCALE
    )
    told = codes.with_label_error(stage(coded))
    return told.select("vec_id", "code", "error", "label_error", F.lit(codes.codebook_digest(history[-1])).alias("codebooks_sha256"))


# Letters over ASCII as single bytes, as DuckDB counts edits in bytes.
WIDE = "".join(map(chr, range(0xC0, 0x100)))
NARROW = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c != "'")[: len(WIDE)]
CRC_TABLE = "(SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)))"


@query(f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
bytes AS (SELECT run, hex(encode(doc_id || ':' || run)) AS x FROM runs WHERE length(run) >= 6),
hashed AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::BIGINT)),
                  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM bytes, {CRC_TABLE}),
changed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
words AS (
  SELECT word, count(*) AS n, translate(word, '{WIDE}', '{NARROW}') AS k FROM changed WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM words a JOIN words b ON abs(length(a.k) - length(b.k)) <= 1 AND a.word <> b.word AND levenshtein(a.k, b.k) = 1),
best AS (SELECT word, count(*) AS n_near, min({{'less': -near_n, 'near': near}}) AS top FROM pairs GROUP BY word),
told AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 5 * n THEN top.near END AS form, CASE WHEN -top.less >= 5 * n THEN -top.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS place, 0 AS depth FROM told
  UNION ALL SELECT s.word, t.form, depth + 1 FROM steps s JOIN told t ON s.place = t.word WHERE t.form IS NOT NULL)
SELECT word, n, n_near, form, form_n, root FROM told JOIN (SELECT word, arg_max(place, depth) AS root FROM steps GROUP BY word) USING (word)""")
def op13_spelling_groups(spark, d):
    """Words of all documents, and the more frequent words that they are one letter away from."""
    return spelling.group_spellings(spelling.count_words(table(spark, d, "documents")))
