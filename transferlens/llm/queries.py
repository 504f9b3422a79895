"""One registered query per operator of this folder, each over its whole table, and checks in plain SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.llm import ctw, decontamination, licenses, packing, pii, quality, resampling, sharding, simhash, toxicity, urls, vafile, whitening
from transferlens.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# Parameters of the queries.
TOXIC_SCORE = 0.3
SHARDS = 16
SEARCHED, EACH = 5, 50
RULES = "block net/, allow example.net/en/, block example.com/de/, allow org/fr/"


def query(check: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if check is not None:
            CHECKS[run.__name__] = check.strip()
        return run

    return register


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.Model:
    """Of the labelled rows of the given tables that are not held out."""
    learn = table(spark, folder, "documents").filter(~held_out(F.col("doc_id"), 4))
    return toxicity.train(learn, table(spark, folder, "labels").select("doc_id", "toxic"))


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    model = toxicity_model(spark, folder)
    scored = toxicity.with_score(table(spark, folder, "documents"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 4).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
        (F.col("score") >= toxicity.threshold_of(model, F.col("lang"))).alias("rejected"),
    )


_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"


@query(rf"""WITH d AS (SELECT doc_id, {_WORDS} AS t FROM documents), i AS (SELECT item_id, {_WORDS} AS t FROM benchmark),
dp AS (SELECT doc_id, p, t[p + 1] AS a, t[p + 4] AS b, t[p + 7] AS c, t[p + 10] AS e FROM (SELECT doc_id, t, unnest(range(len(t) - 9)) AS p FROM d WHERE len(t) >= 10)),
ip AS (SELECT item_id, p AS q, t[p + 1] AS a, t[p + 4] AS b, t[p + 7] AS c, t[p + 10] AS e FROM (SELECT item_id, t, unnest(range(len(t) - 9)) AS p FROM i WHERE len(t) >= 10)),
hits AS (SELECT DISTINCT doc_id, item_id, p, q FROM dp JOIN ip USING (a, b, c, e)),
w AS (SELECT DISTINCT doc_id, item_id, p - back AS p, q - back AS q FROM hits, range(3) AS r(back)),
v AS (SELECT doc_id, item_id, p, len(list_filter(range(1, 13), lambda k: d.t[p + k] = i.t[q + k])) AS equal FROM w JOIN d USING (doc_id) JOIN i USING (item_id)
      WHERE p >= 0 AND q >= 0 AND p + 12 <= len(d.t) AND q + 12 <= len(i.t)),
g AS (SELECT doc_id, item_id, count(DISTINCT (p, equal)) AS n, min(p) AS p, max(equal) AS equal FROM v WHERE equal >= 10 GROUP BY 1, 2)
SELECT doc_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids, CAST(sum(n) AS BIGINT) AS n_windows,
       CAST(min(p) AS BIGINT) AS first_token, CAST(max(equal) AS BIGINT) AS matched_tokens FROM g GROUP BY 1""")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontamination.contaminated(documents, benchmark, least_item=decontamination.SHORT_ITEM)
    return found.select("doc_id", F.array_join("item_ids", ",").alias("item_ids"), "n_windows", "first_token", "matched_tokens")


@query()
def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 7)
    scored, model = ctw.language_model_scores(table(spark, folder, "documents"), ~out)
    return scored.select(
        "doc_id",
        out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "bits_per_byte",
    )


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query()
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    folders = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, folder, "documents"), folders)


@query()
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@query()
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", simhash.fingerprint_text(F.col("print")).alias("fingerprint"), "component_id")


@query()
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.with_verdict(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.drop("text", "in_band")


@query()
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shards(table(spark, folder, "documents"), leaves=SHARDS)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


@query()
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judged(table(spark, folder, "pages").select("page_id", "url"), urls.rules_of(RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", "ratio")


@query()
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"), components=8)


@query(f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EACH} = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {SEARCHED}""")
def op12_exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.search(table(spark, folder, "embeddings"), F.col("vec_id") % EACH == 0, k=SEARCHED)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


@query(rf"""WITH d AS (SELECT doc_id, {_RUNS} AS t FROM documents), i AS (SELECT {_RUNS} AS t FROM benchmark),
dw AS (SELECT doc_id, unnest(t) AS w FROM d), iw AS (SELECT unnest(t) AS w FROM i),
steps AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
coded AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM iw)),
b AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
      lambda c, x: xor(c >> 8, step[xor(c % 256, x) + 1])), 4294967295) % 10000 AS bucket FROM coded, steps),
cd AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (w) GROUP BY 1), ci AS (SELECT bucket, count(*) AS n FROM iw JOIN b USING (w) GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(ci.n, 0) + 1) * ((SELECT count(*) FROM dw) + 10000) AS DOUBLE)
      / CAST((cd.n + 1) * ((SELECT count(*) FROM iw) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM cd LEFT JOIN ci USING (bucket)),
dg AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY 1),
s AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
      + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN dg USING (doc_id)),
e AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM s WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM s LEFT JOIN (SELECT doc_id, rank, n FROM e) USING (doc_id)""")
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.importance(table(spark, folder, "documents"), table(spark, folder, "benchmark"), percent=10, least_words=20, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
