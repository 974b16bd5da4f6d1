"""The registered queries of the operators, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.chat import chat_digest, chat_examples
from sedimenta.llm.filteraudit import audit_filters, failure_masks, labelled
from sedimenta.llm.infill import fill_in_middle, restored
from sedimenta.llm.jaccard import similarity_classes
from sedimenta.llm.language import fit_language, language_predictions
from sedimenta.llm.mixing import mix_sources
from sedimenta.llm.neighbours import nearest_neighbours
from sedimenta.llm.packing import pack_documents
from sedimenta.llm.secrets import joined_spans, with_secret_spans
from sedimenta.llm.substrings import repeated_spans
from sedimenta.llm.tokenfiles import read_token_files, write_token_files
from sedimenta.llm.topk import exact_top_k
from sedimenta.llm.toxicity import ToxicityModel, fit_toxicity, toxicity_scores
from sedimenta.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out():
    """Whether a row's labels must not be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> ToxicityModel:
    labels = _table(spark, sf_dir, "labels").filter(~held_out())
    return fit_toxicity(docs.filter(~held_out()), labels)


#: Least score that counts as toxic.
TOXIC = 0.3


def _query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


@_query(
    r"""
    WITH s AS (
        SELECT doc_id, source, coalesce('s' || source, 'n') AS k, md5(CAST(doc_id AS VARCHAR)) AS h,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents
    ), src AS (
        SELECT k, source, CAST(sum(size) AS DOUBLE) AS source_size FROM s GROUP BY k, source
    ), w AS (
        SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS w
        FROM src
    ), l AS (
        SELECT *, CAST(2 AS DOUBLE) * source_size AS most, CAST(2 AS DOUBLE) * source_size / w AS stop FROM w
    ), lv AS (
        SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER ()
                   - coalesce(sum(most) OVER (ORDER BY stop, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(w) OVER (ORDER BY stop, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
        FROM l
    ), t AS (
        SELECT k, source_size,
               least(most, coalesce(w * (SELECT lvl FROM lv WHERE lvl < stop ORDER BY stop, k LIMIT 1), most)) AS target
        FROM lv
    ), e AS (
        SELECT *, CAST(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS DECIMAL(20, 12)) AS e,
               CAST(CAST('0x' || substr(md5('mix:' || k), 1, 7) AS BIGINT) / CAST(268435456 AS DOUBLE) AS DECIMAL(38, 12)) AS base
        FROM t
    ), u AS (
        SELECT s.*, e.source_size, e.target, e.e,
               e.base + sum(e.e) OVER (PARTITION BY s.k ORDER BY s.size, s.h ROWS UNBOUNDED PRECEDING) AS upto
        FROM s JOIN e ON s.k = e.k
    )
    SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
           CAST(floor(upto) - floor(upto - e) AS BIGINT) * size AS taken
    FROM u
    """
)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs, keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@_query(
    r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), l AS (
        SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
               16 + length(replace(regexp_replace(role, '([<\[])(\\*)(\|(?:turn|end|nl|im_start|im_end|endoftext|system|user|assistant)\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g'), chr(10), '<|nl|>'))
               + length(regexp_replace(text, '([<\[])(\\*)(\|(?:turn|end|nl|im_start|im_end|endoftext|system|user|assistant)\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')) AS len
        FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ), s AS (
        SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM l
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(CASE WHEN role = 'assistant' OR i = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
    FROM s GROUP BY conv_id
    """
)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = F.lit("</s>[INST] ok [/INST]")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        ok.alias("text"),
    )
    return chat_digest(chat_examples(conversations.unionByName(added)))


@_query(
    """
    WITH v AS (
        SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), p AS (
        SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v::DOUBLE[], r.v::DOUBLE[]) AS BIGINT) AS score
        FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 50 = 0
    ), o AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
    )
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM o WHERE rank <= 5
    """
)
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_secret_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def of(*kinds: str):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(joined_spans(of(*base)), 256).alias("base_sha256"),
        joined_spans(F.col("secrets")).alias("spans"),
    )


@_query()
def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@_query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted")
    )


@_query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language(docs.filter(~held_out()))
    named = language_predictions(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query()
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query()
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query()
def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query()
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = fresh_path(spark, "token-files")
    write_token_files(docs, tokenizer_path("word_bpe_49k.json"), folder)
    return read_token_files(spark, folder, docs.schema["doc_id"].dataType.simpleString())


@_query(
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
    ), w AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d
    ), f AS (
        SELECT doc_id, part,
               CAST(len(words) < 200 AS INT)
               + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
               + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
               + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
               + 16 * CAST(coalesce(first < doc_id, false) AS INT) AS mask
        FROM w
    ), l AS (
        SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
    ), c AS (
        SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
        FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask
    ), a AS (
        SELECT unnest(range(5)) AS i
    ), p AS (
        SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM a, a b, a c, a d, a e
        WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
    ), s AS (
        SELECT list_transform(o, lambda i: substr('ABCDE', CAST(i + 1 AS INT), 1)) AS letters, k AS step, o[k] AS i,
               CAST(list_sum(list_transform(o[1:k - 1], lambda j: 1 << j)) AS BIGINT) AS before
        FROM p, (SELECT CAST(unnest(range(1, 6)) AS INT) AS k)
    ), r AS (
        SELECT part, array_to_string(letters, '') AS filter_order, step, i,
               sum(n) FILTER (mask & (coalesce(before, 0) | (1 << i)) = 0) AS kept,
               sum(n) FILTER (mask & coalesce(before, 0) = 0 AND mask & (1 << i) <> 0) AS removed,
               sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND mask & (1 << i) <> 0) AS redundant,
               sum(n) FILTER (mask = 1 << i) AS unique_fails,
               sum(good) FILTER (mask & coalesce(before, 0) = 0 AND mask & (1 << i) <> 0) AS good_lost,
               sum(toxic) FILTER (mask & coalesce(before, 0) = 0 AND mask & (1 << i) <> 0) AS toxic_lost
        FROM c, s GROUP BY part, letters, step, i
    )
    SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
           CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
           CAST(coalesce(sum(removed) OVER (PARTITION BY part, i), 0) AS BIGINT) AS shapley
    FROM r
    """
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    masked = labelled(failure_masks(docs, F.col("lang")), _table(spark, sf_dir, "labels"))
    return audit_filters(masked, {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})


@_query(
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), u AS (
        SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
               CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
               CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
        FROM d
    ), c AS (
        SELECT *, CAST(len(lines) AS BIGINT) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
               greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
                    THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
        FROM u
    ), t AS (
        SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS p, coalesce(array_to_string(lines[a + 1:b], ''), '') AS m,
               coalesce(array_to_string(lines[b + 1:], ''), '') AS s
        FROM c
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM t
    """
)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    back = restored(F.col("output"), F.col("form"))
    digests = [F.sha2(c.cast("binary"), 256).alias(n) for c, n in ((F.col("output"), "output_sha256"), (back, "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
