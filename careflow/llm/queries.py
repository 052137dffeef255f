"""The registered queries of the dealt operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from careflow.llm import (
    bpe, conversation_repair, embedding_dedup, filter_audit, html_text, language_id, line_dedup, minhash_dedup, packing,
    pii, quality, simhash, token_counts)
from careflow.llm.common import read_table

#: Vocabularies of public tokenizers, read where they are installed.
MERGE_FILE = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; learned from those that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = quality.held_out("doc_id", 4, 2)
    models = language_id.fit_on_table(docs, ~held_out)
    return language_id.identify(docs, models).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (5-word shingles, similarity 0.85)."""
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).drop("first")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.best_fit_packing(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MERGE_FILE))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors of one label (cosine 0.93)."""
    return embedding_dedup.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents and the bytes that they decode to, as digests."""
    return bpe.encode_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts; near ones counted
    for every document whose id is divisible by 20."""
    return simhash.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of all documents, each document encoded once."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MERGE_FILE))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_surrogates(docs, pii.session_secret(spark), count="n_replaced")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents; learned from labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = quality.held_out("doc_id", 5, 0)
    model = quality.fit_on_tables(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that stay in the first document only; the digest is
    of the text that a document's keep bitmap leaves."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_bitmaps(docs).select(
        "doc_id", "n_lines", "n_dropped", line_dedup.kept_sha256(F.col("text"), F.col("keep_bitmap")).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of all 120 orders of five filters over all documents, by language."""
    failures = filter_audit.document_failures(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return filter_audit.filter_interactions(failures, filter_audit.FILTERS, "part", "good", "toxic")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of all conversations after planted damage."""
    conversations = read_table(spark, sf_dir, "conversations")
    audits, rows = conversation_repair.repair(conversation_repair.damaged(conversations))
    digests = conversation_repair.repaired_digests(rows)
    named = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
             for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    every = conversations.select("conv_id").distinct().alias("e")
    same = [F.col("e.conv_id").eqNullSafe(F.col(f"{t}.conv_id")) for t in ("a", "d")]
    return (every.join(audits.alias("a"), same[0], "left").join(digests.alias("d"), same[1], "left")
            .select("e.conv_id", *named.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_minhash_dedup, op3_html_text, op4_best_fit_packing, op5_embedding_dedup, op6_byte_bpe,
        op7_simhash, op8_token_counts, op9_pii_surrogates, op10_quality, op11_line_dedup,
        op12_filter_audit, op13_conversation_repair)
}
#: Words and shingles of the contract, every pair with a common shingle, links on
#: full sets, and their transitive closure.
_OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3),
                        lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM pairs WHERE 100 * n_both >= 85 * (nx + ny - n_both)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
          UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.x
"""

#: Every pair of vectors of one label, compared in double precision.
_OP5_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings
          UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links, l.component_id,
       e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.x
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CASE = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Every line with its key, the smallest document of every key in several.
_OP11_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_CASE}) AS k FROM lines),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE first < doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE coalesce(first, doc_id) = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (k) GROUP BY doc_id
"""

#: Failure masks, every order of the letters by a join of letters with themselves.
_OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w,
             min(doc_id) OVER (PARTITION BY x) AS first FROM t),
f AS (
  SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN first < doc_id THEN 16 ELSE 0 END AS mask
  FROM w),
g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM f LEFT JOIN g USING (doc_id) GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l a
      JOIN l b ON b.c <> a.c JOIN l c ON c.c NOT IN (a.c, b.c) JOIN l d ON d.c NOT IN (a.c, b.c, c.c)
      JOIN l e ON e.c NOT IN (a.c, b.c, c.c, d.c)),
s AS (
  SELECT filter_order, step, l.bit,
         coalesce((SELECT sum(p.bit) FROM l p WHERE strpos(filter_order, p.c) < step), 0) AS before
  FROM o, range(1, 6) r(step), l WHERE l.c = substr(filter_order, step, 1)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (WHERE (mask & before::INT) = 0 AND (mask & bit) = 0) AS kept,
         sum(n) FILTER (WHERE (mask & before::INT) = 0 AND (mask & bit) > 0) AS removed,
         sum(n) FILTER (WHERE (mask & before::INT) > 0 AND (mask & bit) > 0) AS redundant,
         sum(n) FILTER (WHERE mask = bit) AS unique_fails,
         sum(good) FILTER (WHERE (mask & before::INT) = 0 AND (mask & bit) > 0) AS good_lost,
         sum(toxic) FILTER (WHERE (mask & before::INT) = 0 AND (mask & bit) > 0) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM r
"""


def _op13_sql() -> str:
    """The dynamic program as a fold over a conversation's rows.  A way is its cost
    in eight digits, then its letters, so that the least text is the best way; n,
    s, u, a are the best ways of the four states (null: none)."""

    def then(way: str, cost: str, letter: str) -> str:
        return f"(lpad(CAST(CAST(left({way}, 8) AS INT) + {cost} AS VARCHAR), 8, '0') || substr({way}, 9) || '{letter}')"

    with_u = "least({0}.u, " + ", ".join(then("{0}." + s, "2", "I") for s in "nsa") + ")"
    inserted = "struct_pack(i := {1}.i, f := {1}.f, n := {0}.n, s := {0}.s, u := " + with_u + ", a := {0}.a)"

    def fold(acc: str) -> str:
        """Accumulator after the row; inner lambdas stand for intermediate values."""
        x, y, z = "x", "y", "z"
        first = inserted.format(x, x)                                     # with inserts up to u
        second = (f"struct_pack(i := {y}.i, f := {y}.f, n := {y}.n, s := {y}.s, u := {y}.u, "
                  f"a := least({y}.a, {then(y + '.u', '2', 'I')}))")       # and up to a
        late = f"(CASE WHEN {z}.f = 't' THEN 1 ELSE 0 END)"
        rerole = f"(2 + {late})"

        def unless_gone(way: str) -> str:
            return f"CASE WHEN {z}.f NOT IN ('b', 'd') THEN {way} END"

        def kept(initial: str, way: str) -> str:
            return f"CASE WHEN {z}.f NOT IN ('b', 'd') AND {z}.i = '{initial}' THEN {way} END"

        new_u = ", ".join([then(f"{z}.u", "3", "D"), *(unless_gone(then(f"{z}.{s}", rerole, "R")) for s in "nsa"),
                           *(kept("u", then(f"{z}.{s}", late, "K")) for s in "nsa")])
        new_a = ", ".join([then(f"{z}.a", "3", "D"), unless_gone(then(f"{z}.u", rerole, "R")),
                           kept("a", then(f"{z}.u", late, "K"))])
        new_s = ", ".join([then(f"{z}.s", "3", "D"), kept("s", then(f"{z}.n", late, "K"))])
        third = (f"struct_pack(i := {z}.i, f := {z}.f, n := {then(z + '.n', '3', 'D')}, s := least({new_s}), "
                 f"u := least({new_u}), a := least({new_a}))")
        one = f"list_transform([{acc}], lambda x: {first})"
        two = f"list_transform({one}, lambda y: {second})"
        return f"list_transform({two}, lambda z: {third})[1]"

    none = "CAST(NULL AS VARCHAR)"
    crc_step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    for_byte = f"list_reduce([xor(p, q), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, j: {crc_step})"
    name = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({name}, ''), "
           f"lambda c: ord(c)::BIGINT)), lambda p, q: {for_byte}), 4294967295::BIGINT)")
    return rf"""
WITH drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS draw FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(CASE WHEN draw = 3 THEN 2 ELSE 1 END) WHERE draw <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r FROM damaged),
marked AS (
  SELECT *, left(role, 1) AS i, CASE
    WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
    WHEN r > min(r) OVER (PARTITION BY conv_id, role, text) THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '-' END AS f,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY r) AS before
  FROM placed),
convs AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE f = 'b') AS blank, count(*) FILTER (WHERE f = 'd') AS duplicate,
         count(*) FILTER (WHERE f = 't') AS truncated,
         count(*) FILTER (WHERE r > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
         list_prepend(struct_pack(i := '', f := '', n := '00000000', s := {none}, u := {none}, a := {none}),
                      list(struct_pack(i := i, f := f, n := {none}, s := {none}, u := {none}, a := {none}) ORDER BY r)) AS steps
  FROM marked GROUP BY conv_id),
folded AS (SELECT *, list_reduce(steps, lambda acc, row: {fold("struct_pack(i := row.i, f := row.f, n := acc.n, s := acc.s, u := acc.u, a := acc.a)")}) AS w FROM convs),
ended AS (SELECT *, {with_u.format("w")} AS u2 FROM folded),
best AS (SELECT *, least(w.n, w.a, {then("u2", "2", "I")}) AS way FROM ended),
audits AS (SELECT conv_id, gaps, blank, duplicate, truncated, illegal, CAST(left(way, 8) AS BIGINT) AS cost, substr(way, 9) AS audit
           FROM best),
letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS c, generate_subscripts(string_split(audit, ''), 1) AS place
  FROM audits WHERE audit <> ''),
edits AS (SELECT *, sum(CASE WHEN c = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY place) AS r FROM letters),
stay AS (
  SELECT e.conv_id, e.place, e.c, m.role, m.text, row_number() OVER (PARTITION BY e.conv_id ORDER BY e.place) AS k,
         first_value(CASE WHEN e.c = 'K' AND m.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id ORDER BY e.place) AS lead
  FROM edits e LEFT JOIN marked m ON e.conv_id IS NOT DISTINCT FROM m.conv_id AND e.r = m.r WHERE e.c <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN c = 'K' THEN role WHEN (k - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN c = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS body
  FROM stay GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM every v LEFT JOIN audits a ON v.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN texts t ON v.conv_id IS NOT DISTINCT FROM t.conv_id
"""


#: DuckDB SQL by query; what SQL can't express is tested in tests/llm/.
ORACLE: dict[str, str] = {"op2_minhash_dedup": _OP2_SQL, "op5_embedding_dedup": _OP5_SQL,
                          "op11_line_dedup": _OP11_SQL, "op12_filter_audit": _OP12_SQL,
                          "op13_conversation_repair": _op13_sql()}
