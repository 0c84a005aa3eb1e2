"""One query per operator over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, codes, decontam, merkle, mixing, neardup, pii, quality, secret_scan, tokens, topk, toxicity, warc
from tidemark.llm.common import hex_digest, joined_spans, table
from tidemark.session import materialize


def __getattr__(name: str) -> str:
    """``TOKENIZER``: the vocabulary file of the token queries, looked up by those that use it."""
    if name != "TOKENIZER":
        raise AttributeError(name)
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    found = warc.archived_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that saw no held-out label."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _counted(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base], hex_digest(joined_spans(of_base)).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans")
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return _counted(pii.find_pii(table(spark, sf_dir, "documents")), pii.BASE)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, read back from the files."""
    return tokens.token_records(table(spark, sf_dir, "documents"), __getattr__("TOKENIZER"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return _counted(secret_scan.find_secrets(table(spark, sf_dir, "documents")), secret_scan.KINDS[:3])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the items."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def mixing_nearness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source, whether the mix keeps to its target and to three copies, and no document is left that would still fit."""
    found = mixing.sources_mixed(table(spark, sf_dir, "documents"))
    missing = F.floor("target") - F.col("taken")
    return found.select(
        "source", "source_size", "target", (missing >= 0).alias("within_target"), (F.col("room").isNull() | (F.col("room") > missing)).alias("nothing_fits"),
        (F.col("most") <= 3).alias("at_most_three"),
    )


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every 50th."""
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, written, and read back. Conversation -1 comes in another layout, as a list of messages."""
    rows = table(spark, sf_dir, "conversations")
    message = '{{"role": "{}", "content": "</s>[INST] ok [/INST]"}}'
    extra = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(f'{{"messages": [{message.format("user")}, {message.format("assistant")}]}}').alias("record"))
    records = chat.turn_records(rows).union(extra)
    pieces = materialize(chat.format_turns(chat.canonical_turns(records, "conv_id", "record"), "conv_id"))
    return chat.read_conversations(pieces, "conv_id")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and what proofs say of documents that lost their line feeds."""
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and what it loses."""
    return codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a discriminant that saw no held-out label."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {q.__name__: q for q in (op1_warc, op2_toxicity, op3_pii, op4_token_files, op5_near_duplicates, op6_secrets, op7_decontamination, op8_mixing, mixing_nearness, op9_top_products, op10_chat, op11_manifest, op12_vector_codes, op13_quality)}
#: DuckDB's way to count words and to lower A-Z alone.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ASCII = f"translate({{}}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PAGES = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
best AS (SELECT h, max(page_id) AS m FROM d WHERE n >= 1000 GROUP BY h HAVING count(*) > 1)
SELECT page_id, n::BIGINT AS payload_bytes, d.h AS payload_digest,
  CASE WHEN m IS NOT NULL AND n >= 1000 AND page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM d LEFT JOIN best ON d.h = best.h"""

_NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _ASCII.format("coalesce(text, '')"))} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
same AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
items AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM same),
met AS (SELECT a.rep AS a, b.rep AS b, count(*) AS shared, any_value(a.n) AS n, any_value(b.n) AS m FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep GROUP BY 1, 2),
link AS (SELECT a, b FROM met WHERE 100 * shared >= 75 * (n + m - shared)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT rep, rep FROM same UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
label AS (SELECT a AS rep, min(b) AS comp FROM reach GROUP BY a)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(comp, doc_id) AS component_id, doc_id = coalesce(comp, doc_id) AS kept
FROM sets LEFT JOIN same ON list_sort(sets.s) = same.s LEFT JOIN label ON label.rep = same.rep"""

_GOAL = f"""
d AS (SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS}) AS size,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS h FROM documents),
named AS (SELECT source, sum(size)::BIGINT AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
ordered AS (SELECT *, sum(size) OVER () - coalesce(sum(3 * size) OVER o, 0) AS words, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS shares
  FROM named WINDOW o AS (ORDER BY 3 * size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, 3 * size * shares <= words * weight AS is_full FROM ordered),
rest AS (SELECT arg_min(words, 3 * size / weight) AS words, arg_min(shares, 3 * size / weight) AS shares FROM filled WHERE NOT is_full),
goal AS (SELECT source, size, CASE WHEN is_full THEN 3.0 * size ELSE (weight * rest.words)::DOUBLE / rest.shares::DOUBLE END::DOUBLE AS target FROM filled, rest
  UNION ALL SELECT source, size, 3.0 * size FROM filled WHERE (SELECT words FROM rest) IS NULL AND (SELECT count(*) FROM filled WHERE NOT is_full) > 0)"""

#: One more copy at a time, in rounds, until no document with fewer than three fits.
_MIX = f"""
WITH RECURSIVE {_GOAL},
plan AS (SELECT source, size, target, CASE WHEN size > 0 THEN least(3, floor(target)::BIGINT // size) ELSE 0 END AS copies FROM goal),
turn(n, r, source, size, h, copies, missing) AS (
  SELECT 0, r, d.source, d.size, h, CASE WHEN d.size > 0 THEN copies ELSE 3 END, floor(target)::BIGINT - copies * plan.size FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source
  UNION ALL
  SELECT n + 1, r, source, size, h, copies + (fits AND upto <= missing)::INT, missing - coalesce(sum(size) FILTER (fits AND upto <= missing) OVER (PARTITION BY source), 0)::BIGINT
  FROM (SELECT *, sum(CASE WHEN fits THEN size END) OVER (PARTITION BY source ORDER BY h) AS upto
    FROM (SELECT *, copies = level AND size <= CASE WHEN least <= missing // {mixing.PART} THEN missing // {mixing.PART} ELSE missing END AS fits
      FROM (SELECT *, min(CASE WHEN copies = level THEN size END) OVER (PARTITION BY source) AS least
        FROM (SELECT *, min(CASE WHEN copies < 3 AND size <= missing THEN copies END) OVER (PARTITION BY source) AS level FROM turn WHERE missing > 0)
        WHERE level IS NOT NULL)))),
done AS (SELECT r, arg_max(copies, n) AS copies FROM turn GROUP BY r)
SELECT doc_id, d.size::BIGINT AS size, plan.size AS source_size, target, (d.size * done.copies)::BIGINT AS taken
FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source JOIN done USING (r)"""

#: The contract alone: nothing of how documents are picked.
_NEARNESS = f"""
WITH {_GOAL}
SELECT source, size AS source_size, target, true AS within_target, true AS nothing_fits, true AS at_most_three FROM goal"""

_TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER o::INTEGER AS rank, vec_id, score FROM s
WINDOW o AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER o <= 5"""


def _escaped(text: str) -> str:
    for mark in ("\\", *chat.CONTROL):
        text = f"replace({text}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return text


_CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('{chat.BEGIN}' || replace({_escaped("role")}, chr(10), '\\n') || chr(10) || {_escaped("text")} || '{chat.END}' || chr(10)))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""

#: crc32 of an id as text, byte by byte, before its last inversion; then whether it is even after it.
_CRC = """list_reduce(flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [ascii(substr(doc_id::VARCHAR, i, 1)), 0, 0, 0, 0, 0, 0, 0]))::BIGINT[],
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT)"""


def _leaf_sql(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode({f}))::VARCHAR || ':' || {f} END" for f in fields) + ")"


_STEP = "array_to_string({r}.hs[1:{pos} % 3], '') || '|' || array_to_string({r}.hs[{pos} % 3 + 2:], '')"
_FOLD = "list_reduce({steps}, lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), {leaf})"
_MANIFEST = f"""
WITH RECURSIVE leaves AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN (xor({_CRC}, 4294967295) & 1) = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS now FROM documents),
trees AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM leaves GROUP BY source),
placed AS (SELECT leaves.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves JOIN trees ON leaves.source IS NOT DISTINCT FROM trees.source),
level(tree, l, pos, h, n) AS (SELECT tree, 0, pos, leaf, n FROM placed
  UNION ALL SELECT tree, l + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM level WHERE n > 1 GROUP BY tree, l, pos // 3, n),
subroots AS (SELECT tree, h FROM level WHERE n = 1),
above(l, pos, h, n) AS (SELECT 0, tree, h, (SELECT count(*) FROM subroots) FROM subroots
  UNION ALL SELECT l + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM above WHERE n > 1 GROUP BY l, pos // 3, n),
run AS (SELECT tree, l, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM level WHERE n > 1 GROUP BY ALL),
top_run AS (SELECT l, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM above WHERE n > 1 GROUP BY ALL),
steps AS (SELECT p.tree, p.pos, list({_STEP.format(r="r", pos="(p.pos // (3 ** r.l)::BIGINT)")} ORDER BY r.l) AS steps
  FROM placed p JOIN run r ON r.tree = p.tree AND r.run = p.pos // (3 ** (r.l + 1))::BIGINT GROUP BY p.tree, p.pos),
top_steps AS (SELECT s.tree, list({_STEP.format(r="r", pos="(s.tree // (3 ** r.l)::BIGINT)")} ORDER BY r.l) AS steps
  FROM subroots s JOIN top_run r ON r.run = s.tree // (3 ** (r.l + 1))::BIGINT GROUP BY s.tree),
whole AS (SELECT doc_id, leaf, now, s.h AS subroot, (SELECT h FROM above WHERE n = 1) AS root,
    list_concat(coalesce(steps.steps, []), coalesce(top_steps.steps, [])) AS steps
  FROM placed p JOIN subroots s USING (tree) LEFT JOIN steps ON steps.tree = p.tree AND steps.pos = p.pos LEFT JOIN top_steps ON top_steps.tree = p.tree),
found AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, {_FOLD.format(steps="steps", leaf="coalesce(now, leaf)")} AS folded_root FROM whole)
SELECT *, folded_root = root AS verified FROM found"""

_ROUND_OF_CODES = """
near{n} AS MATERIALIZED (SELECT r, p.p, arg_min(e, (list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x), e)) AS e
  FROM parts p JOIN book{n} c ON p.p = c.p GROUP BY r, p.p),
book{m} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM book{n} c LEFT JOIN (
    SELECT p, e, list(floor(s / n) ORDER BY i) AS x FROM (SELECT n.p, n.e, i, sum(p.x[i]) AS s, count(*) AS n
      FROM near{n} n JOIN parts p ON p.r = n.r AND p.p = n.p, range(1, len(p.x) + 1) t(i) GROUP BY n.p, n.e, i) GROUP BY p, e) m ON m.p = c.p AND m.e = c.e),"""
_CODES = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM kept, range(4) t(p)),
book0 AS MATERIALIZED (SELECT p, e, x FROM (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {codes.ENTRIES}) JOIN parts USING (r)),
{"".join(_ROUND_OF_CODES.format(n=n, m=n + 1) for n in range(codes.ROUNDS))}
last AS (SELECT r, p.p, min((list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x), e)) AS best
  FROM parts p JOIN book{codes.ROUNDS} c ON p.p = c.p GROUP BY r, p.p),
coded AS (SELECT vec_id, label, string_agg(lower(lpad(to_hex(best[2]), 2, '0')), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM last JOIN kept USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) FROM book{codes.ROUNDS} c, unnest(c.x) WITH ORDINALITY t(y, i)) AS codebooks_sha256 FROM coded"""

#: The others need a classifier, a tokenizer, entropy, or patterns that look back: brute-force tests stand in.
ORACLE: dict[str, str] = {
    "op1_warc": _PAGES, "op5_near_duplicates": _NEAR, "op8_mixing": _MIX, "mixing_nearness": _NEARNESS, "op9_top_products": _TOP, "op10_chat": _CHAT,
    "op11_manifest": _MANIFEST, "op12_vector_codes": _CODES,
}
