"""The operators of this subpackage over their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverload.llm import (
    chat_format, collocations, decontaminate, line_dedup, packing, pii, quality, secrets, simhash, token_counts, topk, url_filters, vector_codes,
)
from riverload.queries.registry import Registry

registry = Registry()

URL_RULES = "('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')"

#: Folder of the public tokenizers' files; not part of this repository.
TOKENIZERS = "/opt/tokenizers"

ODD_TURN = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registry.add("""
WITH turns AS (
 SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
 SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\\\'),
   '<s>', '<\\s>'), '[SYS]', '[\\SYS]'), '[/SYS]', '[\\/SYS]'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]'), '[OUT]', '[\\OUT]'),
   '</s>', '<\\/s>'), '[ROLE]', '[\\ROLE]'), '[/ROLE]', '[\\/ROLE]'), '[TEXT]', '[\\TEXT]') AS safe,
  lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS previous,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end FROM turns
)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
 CAST(3 + sum(length(safe) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 19 + length(role) END) AS BIGINT) AS formatted_chars,
 bool_and(CASE WHEN previous IS NULL OR previous = 'system' AND role <> 'system' THEN role IN ('system', 'user') AND (previous IS NULL OR role = 'user')
   WHEN previous = 'user' THEN role = 'assistant' WHEN previous = 'assistant' THEN role = 'user' ELSE false END)
  AND max(CASE WHEN from_end = 1 THEN role END) = 'assistant' AS valid
FROM escaped GROUP BY conv_id
""")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the conversations as read back from their formatted text."""
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TURN).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(odd)
    made = chat_format.format_chats(turns)
    read = made.select(
        "conv_id", "valid", "formatted", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


@registry.add(f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {URL_RULES}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
 SELECT row_number() OVER () AS n, page_id,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), best AS (
 SELECT n, max_by(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule, max_by(action, length(rule_host) + length(rule_path)) AS action
 FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
""")
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS rules(host, path, action)")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


@registry.add()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, plain and disguised."""
    found = table(spark, sf_dir, "documents").select("doc_id", pii.personal_spans("text").alias("found"))

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(told(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"))


@registry.add()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a unigram reading of a public vocabulary."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", token_counts.token_count(
            "text", token_counts.ranked_vocabulary, f"{TOKENIZERS}/piece_bpe_32k.model").alias("n_tokens"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))


GOOD_FROM = 0.3


@registry.add()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents")
    field = quality.fit_field(docs, quality.train_rows(table(spark, sf_dir, "labels")))
    return docs.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"),
        quality.quality_score("text", field).alias("score"),
    ).withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))


@registry.add("""
WITH lines AS (
 SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents
), trimmed AS (SELECT doc_id, source, line, pos, trim(line, ' ') AS bare FROM lines),
shared AS (SELECT bare FROM trimmed WHERE length(bare) > 0 GROUP BY bare HAVING count(DISTINCT source) >= 10),
marked AS (SELECT t.*, s.bare IS NOT NULL AS hit FROM trimmed t LEFT JOIN shared s USING (bare)),
judged AS (
 SELECT *, CAST(sum(CASE WHEN hit THEN length(bare) ELSE 0 END) OVER (PARTITION BY doc_id) AS BIGINT) AS chars,
  CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS BIGINT) AS n FROM marked
)
SELECT d.doc_id, CASE WHEN max(n) > 0 THEN coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hit), '') ELSE max(d.text) END AS text,
 max(n) AS shared_lines, max(n) AS removed_lines, max(chars) AS removed_chars
FROM documents d JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id
""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten sites share."""
    return line_dedup.drop_shared_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "shared_lines", "removed_lines", "removed_chars")


@registry.add()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def bpe_path() -> str:
    """The tokenizer of the packing."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@registry.add()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.Encoder, bpe_path())


@registry.add("""
WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
 SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@registry.add()
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test item that stands in a document."""
    hits = decontaminate.leaks("text", table(spark, sf_dir, "benchmark"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(hits).alias("hit")).select("doc_id", "hit.*")


def _codes_sql(rounds: int = 6) -> str:
    """Each round as two tables: where the parts go, and what becomes of the entries."""
    steps = [f"""
WITH v AS MATERIALIZED (
 SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
 SELECT n, p, e[p * (len(e) // 8) + 1 : (p + 1) * (len(e) // 8)] AS x FROM v, (SELECT unnest(range(8)) AS p)
), book0 AS MATERIALIZED (SELECT p, n - 1 AS entry, x FROM parts WHERE n <= 16)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
 SELECT n, p, min(CAST(list_sum(list_transform(list_zip(parts.x, book.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * 16 + entry) AS found
 FROM parts JOIN book{k} book USING (p) GROUP BY n, p)""")
        if k < rounds:
            steps.append(f"""sum{k} AS (
 SELECT p, found % 16 AS entry, j, CAST(sum(c) AS BIGINT) AS s, count(*) AS c
 FROM (SELECT p, found, unnest(x) AS c, unnest(range(len(x))) AS j FROM near{k} JOIN parts USING (n, p)) GROUP BY ALL
), mean{k} AS (SELECT p, entry, list((s - ((s % c) + c) % c) // c ORDER BY j) AS x FROM sum{k} GROUP BY p, entry),
book{k + 1} AS MATERIALIZED (SELECT p, entry, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (p, entry))""")
    return ",\n".join(steps) + f"""
, coded AS (
 SELECT n, string_agg(lpad(to_hex(found % 16), 2, '0'), '' ORDER BY p) AS code, CAST(sum(found // 16) AS BIGINT) AS error FROM near{rounds} GROUP BY n
), labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM v JOIN coded USING (n) GROUP BY label)
SELECT vec_id, lower(code) AS code, error, label_error,
 (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256
FROM v JOIN coded USING (n) JOIN labels ON v.label IS NOT DISTINCT FROM labels.label"""


@registry.add(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors and the digest of the codebooks."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.lit(",".join(str(c) for book in books for c in book.ravel().tolist())), 256)
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _secrets_sql() -> str:
    def found(name: str, pattern: str, where: str = "true") -> str:
        return f"""
{name} AS MATERIALIZED (
 SELECT * FROM (
  SELECT n, found, CAST(sum(length(gap) + length(found)) OVER (PARTITION BY n ORDER BY i) AS BIGINT) AS stop FROM (
   SELECT n, unnest(string_split_regex(text, $p${pattern}$p$)) AS gap, unnest(regexp_extract_all(text, $p${pattern}$p$)) AS found,
    unnest(range(len(regexp_extract_all(text, $p${pattern}$p$)))) AS i FROM d WHERE regexp_matches(text, $p${pattern}$p$)) WHERE i IS NOT NULL)
 WHERE {where})"""

    fits = " ".join(f"WHEN regexp_full_match(found, '{p}') THEN '{alphabet}'" for p, alphabet in secrets.ENCODINGS)
    return "WITH d AS MATERIALIZED (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents)," + ",".join([
        found("a", secrets.ASSIGN, f"length(regexp_extract(found, $p${secrets.ASSIGN}$p$, 1)) >= 6"), found("k", secrets.ACCESS), found("h", secrets.HEX),
        found("r", secrets.RUN)]) + f"""
, base AS (
 SELECT n, stop - length(found) AS start, 0 AS kind, stop FROM a UNION ALL SELECT n, stop - length(found), 1, stop FROM k
 UNION ALL SELECT n, stop - length(found), 2, stop FROM h
), runs AS (SELECT n, stop, found, CASE {fits} ELSE '' END AS alphabet FROM r
), symbols AS (
 SELECT *, CAST(strpos(alphabet, s) AS DOUBLE) AS v FROM (
  SELECT n, stop, alphabet, length(alphabet) AS m, length(found) AS size, unnest(string_split(found, '')) AS s, unnest(range(length(found))) AS i FROM runs WHERE alphabet <> '')
), means AS (SELECT n, stop, avg(v) AS mean FROM symbols GROUP BY n, stop
), near AS (
 SELECT *, v <= m // 2 AS low, lead(v) OVER w AS next FROM symbols JOIN means USING (n, stop) WINDOW w AS (PARTITION BY n, stop ORDER BY i)
), counted AS (SELECT n, stop, sum(c * c) AS squares FROM (SELECT n, stop, s, count(*) AS c FROM symbols GROUP BY n, stop, s) GROUP BY n, stop
), facts AS (
 SELECT n, stop, any_value(m) AS m, any_value(size) AS size, 2.0::DOUBLE * count(*) FILTER (WHERE low) * count(*) FILTER (WHERE NOT low) AS pairs,
  1 + count(*) FILTER (WHERE next IS NOT NULL AND low <> (next <= m // 2)) AS changes,
  least(0.999, abs(coalesce(sum((v - mean) * (next - mean)) / nullif(sum((v - mean) * (v - mean)), 0), 1))) AS r
 FROM near GROUP BY n, stop
), tests AS (
 SELECT n, stop, size, m, ((m - 1 + uneven) - (CAST(squares AS DOUBLE) * m / size - size)) / sqrt(2 * (m - 1 + 2 * uneven)) AS spread,
  CASE WHEN pairs = 0 THEN -10 ELSE (0.7::DOUBLE * (pairs / size + 1) - abs(changes - (pairs / size + 1))) / sqrt(pairs * (pairs - size) / (size * size * (size - 1.0::DOUBLE))) END AS clustered,
  (atanh(0.8::DOUBLE) - atanh(r)) * sqrt(size - 3) AS serial
 FROM (SELECT *, CASE WHEN m = 16 THEN 1.0::DOUBLE ELSE m * 0.065::DOUBLE - 1 END * size AS uneven FROM facts JOIN counted USING (n, stop))
), steps AS (
 SELECT n, stop, size, CAST(floor(log2(size * log2(m))) AS INTEGER) AS class, CAST(floor(greatest(0, least(10, spread, clustered, serial)) * 8) AS INTEGER) AS step FROM tests
), classes AS (
 SELECT class, min(step) AS least FROM (
  SELECT class, step, step / 8.0::DOUBLE AS z, sum(count(*)) OVER (PARTITION BY class ORDER BY step DESC) AS found, sum(count(*)) OVER (PARTITION BY class) AS every
  FROM steps GROUP BY class, step)
 WHERE CASE WHEN z < 1 THEN 0.5 * exp(-z * z / 2) ELSE exp(-z * z / 2) / (z * sqrt(2 * pi())) END * every <= 0.05::DOUBLE * found GROUP BY class
), every AS (
 SELECT * FROM base UNION ALL SELECT n, stop - size, 3, stop FROM steps JOIN classes USING (class)
 WHERE step >= least AND NOT EXISTS (SELECT 1 FROM base b WHERE b.n = steps.n AND b.start <= steps.stop - size AND steps.stop <= b.stop)
), told AS (SELECT n, start, kind, stop, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop AS span FROM every)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
 sha256(coalesce(string_agg(span, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 3), '')) AS base_sha256,
 coalesce(string_agg(span, ',' ORDER BY start, kind, stop), '') AS spans
FROM d LEFT JOIN told USING (n) GROUP BY n"""


@registry.add(_secrets_sql())
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by pattern and by randomness."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def told(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, ("assign", "access", "hex")),
                        F.sha2(told(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), told("spans").alias("spans"))


@registry.add(r"""
WITH pieces AS (
 SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
 FROM documents
), words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k)
), counts AS MATERIALIZED (
 SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS a FROM places GROUP BY ALL HAVING count(*) >= 100
), inner_phrases AS (
 SELECT lang, g[j:j + s - 1] AS g, max(a) AS most FROM counts, (SELECT unnest(range(2, 5)) AS s), (SELECT unnest(range(1, 5)) AS j) WHERE s < k AND j + s - 1 <= k GROUP BY ALL
), kept AS (SELECT c.* FROM counts c LEFT JOIN inner_phrases i USING (lang, g) WHERE k > 1 AND (most IS NULL OR most < a)
), cuts AS (
 SELECT kept.lang, kept.g, kept.a, l.k AS cut, l.a AS l, r.a AS r, n, (1000::HUGEINT * kept.a * n) // (l.a::HUGEINT * r.a) AS score
 FROM kept JOIN totals USING (lang) JOIN counts l ON l.lang = kept.lang AND l.k < kept.k AND l.g = kept.g[1:l.k]
 JOIN counts r ON r.lang = kept.lang AND r.k = kept.k - l.k AND r.g = kept.g[l.k + 1:]
), best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS nth FROM cuts
), ranked AS (
 SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
 FROM best WHERE nth = 1
)
SELECT * FROM ranked WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
