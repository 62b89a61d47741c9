"""One query per operator, over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import (
    codes,
    decontamination,
    language,
    line_dedup,
    mixing,
    neighbours,
    packing,
    periodic,
    perplexity,
    personal,
    repeats,
    simhash,
    toxicity,
)
from siltworks.llm.common import held_out, read, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_passages(docs, read(spark, sf_dir, "benchmark"), length=10)
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        sha256(F.array_join("hits.items", ",")).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = perplexity.judge(docs, read(spark, sf_dir, "labels"), carried=["doc_id", "lang"])
    return judged.select("doc_id", "lang", "quality.perplexity", "quality.low", "quality.high", "quality.keep")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path(), capacity=2048)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    base, spans = F.col("base"), F.col("spans")
    return personal.find(docs).select(
        F.col("id").alias("doc_id"),
        *(personal.count(base, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")),
        sha256(personal.listed(base)).alias("base_sha256"),
        personal.listed(spans).alias("spans"),
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, max_bits=2).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=2, min_chars=10).select(
        "doc_id", "lines.n_lines", "lines.n_dropped", sha256(F.col("lines.kept")).alias("kept_sha256")
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs)
    return language.identify(docs.select("doc_id", "text"), model, out="language").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs, length=50).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), sha256(F.col("kept")).alias("kept_sha256")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model, out="score").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"),
    )


def _made_periodic(doc_id: Column, text: Column, words: Column) -> Column:
    """The text; for one id in ten, words from some place on repeat the first few of them."""
    code = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(code / 10).cast("long"), F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    once = F.slice(words, a.cast("int") + 1, p)
    repeated = F.flatten(F.array_repeat(once, F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(repeated, F.lit(1), (n - a).cast("int")))
    return F.when(n > 0, F.array_join(made, " ")).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    made = docs.withColumn("words", words).select("doc_id", _made_periodic(F.col("doc_id"), F.col("text"), F.col("words")).alias("text"))
    found = periodic.collapse(made, out="periodic")
    line = F.transform("periodic.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = periodic.longest(F.col("periodic.runs"))
    return found.select(
        "doc_id",
        F.size("periodic.runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        sha256(F.array_join(line, "")).alias("runs_sha256"),
        sha256(F.col("periodic.kept")).alias("collapsed_sha256"),
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, weights=(1, 2, 3), most=3).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken"
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    model = codes.train(vectors, parts=4, entries=256, rounds=4, scale=1024)
    digits = F.array_join(F.transform("coded.code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    coded = codes.encode(vectors, model, out="coded").select(
        "vec_id", "label", digits.alias("code"), F.col("coded.error").alias("error")
    )
    summed = codes.with_label_error(stored(coded), label_col="label", error_col="error", out="label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(model.digest()).alias("codebooks_sha256"))


_QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_decontamination,
    op2_quality,
    op3_packing,
    op4_personal_data,
    op5_neighbours,
    op6_simhash,
    op7_line_dedup,
    op8_language,
    op9_repeats,
    op10_toxicity,
    op11_periodic_runs,
    op12_mixing,
    op13_vector_codes,
)



def _rounds_sql(rounds: int) -> str:
    """Common table expressions `near0`, `book1`, ... up to the assignment after the last round."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min({{'d': xx - 2 * list_inner_product(xs, cs) + cc, 'e': e}}) AS best
  FROM parts JOIN (SELECT *, list_inner_product(cs, cs) AS cc FROM book{r}) USING (p) GROUP BY vec_id, p
)""")
        if r < rounds:
            out.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(means, c) AS c, CAST(coalesce(means, c) AS DOUBLE[]) AS cs
  FROM book{r} LEFT JOIN (
    SELECT p, e, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS means
    FROM (SELECT p, best.e AS e, i, CAST(sum(x[i]) AS DOUBLE) AS total, count(*) AS n
          FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{r}) GROUP BY p, best.e, i)
    GROUP BY p, e) USING (p, e)
)""")
    return ", ".join(out)


_SQL = {
    "op1_decontamination": f"""
WITH item_words AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
         '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), []) AS w
  FROM documents
), doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, p, i.n, item FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.win = i.win
), hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",
    "op7_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         '{_UPPER}', '{_LOWER}') AS k
  FROM lines
), seen AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT doc_id, pos, line, first IS NOT NULL AND first <> doc_id AS dropped FROM keyed LEFT JOIN seen USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op12_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         substr(md5(concat_ws('/', CAST(doc_id AS VARCHAR), md5(text))), 1, 15) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER before, 0) AS cap_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size * CASE weight WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 2 END, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, weight * (total - cap_before) > cap * weight_left AS above FROM ordered
), shared AS (
  SELECT coalesce(sum(cap) FILTER (above), 0) AS capped, sum(weight) FILTER (NOT above) AS weights FROM judged
), wanted AS (
  SELECT source, source_size,
         CASE WHEN above THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * (total - capped) AS DOUBLE) / CAST(weights AS DOUBLE) END AS target
  FROM judged, shared
), budgets AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(target >= source_size AS INT)
         + CAST(target >= 2 * source_size AS INT) + CAST(target >= 3 * source_size AS INT) END AS every
  FROM wanted
), placed AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.every, b.target - b.every * b.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY place) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, place) AS here
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (every + CASE WHEN upto < rest OR (upto - here < rest AND upto - rest < rest - (upto - here))
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
""",
    "op13_vector_codes": f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT *, CAST(x AS DOUBLE[]) AS xs, list_inner_product(CAST(x AS DOUBLE[]), CAST(x AS DOUBLE[])) AS xx
  FROM (SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x
        FROM (SELECT vec_id, v, unnest(range(4)) AS p FROM kept))
), book0 AS MATERIALIZED (
  SELECT p, nth - 1 AS e, x AS c, xs AS cs
  FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS nth FROM kept) USING (vec_id) WHERE nth <= 256
), {_rounds_sql(4)}, coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY p) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM near4 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
