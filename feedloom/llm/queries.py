"""The registered queries of the operators, over whole tables, and SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    bpe,
    budget,
    fertility,
    jaccard,
    lattice,
    licences,
    nbest,
    order,
    periods,
    permutation,
    phrases,
    pii,
    warc,
)
from feedloom.session import prepare


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_lattice_likelihood(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.lattice_scores(table(spark, sf, "documents"))


def op2_n_best_segmentation(spark: SparkSession, sf: str) -> DataFrame:
    return nbest.encode(table(spark, sf, "documents"))


def op3_semi_markov_pii(spark: SparkSession, sf: str) -> DataFrame:
    found, spans = pii.find_spans(table(spark, sf, "documents"), ["doc_id"])
    return pii_digest(found, spans)


def pii_digest(found: DataFrame, spans: str) -> DataFrame:
    def told(rows):
        """kind:start:end by start, then kind as listed."""
        listed = F.array_sort(
            F.transform(
                rows,
                lambda s: F.struct(
                    s["start"].alias("start"),
                    F.array_position(F.array(*map(F.lit, pii.KINDS)), s["kind"]).alias("place"),
                    s["end"].alias("end"),
                    s["kind"].alias("kind"),
                ),
            )
        )
        return F.array_join(
            F.transform(listed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of_kind(kind):
        return F.filter(base, lambda s: s["kind"] == kind)

    base = F.filter(spans, lambda s: s["base"])
    return found.select(
        "doc_id",
        *(
            F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
        ),
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col(spans)).alias("spans"),
    )


def op4_training_order(spark: SparkSession, sf: str) -> DataFrame:
    path, size = order.write_order(table(spark, sf, "documents"))
    return order.read_order(spark, path, size).select(
        "slot", "doc_id", "part", "n_tokens", F.xxhash64("ids").alias("ids_hash")
    )


def op5_tokeniser_fertility(spark: SparkSession, sf: str) -> DataFrame:
    found, name = fertility.fertility_rules(table(spark, sf, "documents"), ["doc_id"])
    own = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    more = "n_pieces n_ranks n_fallback entropy chars_a_piece chars_a_rank fallback_share".split()
    return found.select("doc_id", *(F.col(f"{name}.{c}").alias(c) for c in [*own, *more]))


#: Target weights of the registered mix; what is not named weighs 1.
WEIGHTS = {
    "domain": {"domain0": 3, "domain1": 2},
    "language": {"en": 4, "de": 2, "fr": 2},
    "origin": {"src0": 4, "src4": 2},
}


def levels() -> tuple:
    """Domain, language and source; sources are grouped in four domains by their number."""
    number = F.regexp_extract("source", "([0-9]{1,9})", 1)
    digits = F.when(number == "", F.lit(0)).otherwise(number.cast("int"))
    domain = F.concat(F.lit("domain"), F.coalesce(digits % 4, F.lit(0)).cast("string"))
    return domain, F.col("lang"), F.col("source")


def op6_hierarchical_budget(spark: SparkSession, sf: str) -> DataFrame:
    found = budget.mixed(table(spark, sf, "documents"), levels(), WEIGHTS, 80, max_epochs=2)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("domain"),
        F.col("language").alias("lang"),
        F.col("origin").alias("source"),
        "n_tokens",
        "epochs",
    )


def op7_licence_automaton(spark: SparkSession, sf: str) -> DataFrame:
    found = licences.scan_licences(table(spark, sf, "documents"))
    own = "n_words n_base first_word last_word".split()
    return found.select(
        "doc_id",
        *(F.col(f"licences.{c}").alias(c) for c in own),
        F.array_join("licences.base_labels", ",").alias("base_labels"),
        F.array_join("licences.labels", ",").alias("labels"),
        F.col("licences.score").alias("score"),
    )


def op8_permutation_index(spark: SparkSession, sf: str) -> DataFrame:
    return permutation.nearest(
        table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, vec_col="embedding"
    )


def op9_warc_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf, "pages"))
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents"))


def op11_byte_bpe_transducer(spark: SparkSession, sf: str) -> DataFrame:
    tokens, ids = bpe.encode(table(spark, sf, "documents"))
    decoded, text = bpe.decode(tokens, ("doc_id", ids), ids)
    return decoded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col(text).cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


def with_period(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the ids get a periodic end: word i from place a on is word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size("words").cast("long")
    a = F.col("g") % n
    p = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long")
    word = F.transform(
        F.sequence(F.lit(0), n.cast("int") - 1),
        lambda i: F.get(
            "words",
            F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"),
        ),
    )
    planted = (h % 10 == 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return (
        docs.select("doc_id", "text", F.when(planted, words).alias("words"), g.alias("g"))
        .withColumn("a", F.when(n > 0, a))
        .withColumn("p", F.when(n > 0, p))
        .select(
            "doc_id",
            F.when(F.col("words").isNull(), F.col("text"))
            .otherwise(F.array_join(word, " "))
            .alias("text"),
        )
    )


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found, name = periods.periodic_runs(with_period(table(spark, sf, "documents")))
    runs = F.col(f"{name}.runs")
    # Runs are in order of start and period: of equal exponents the first stays.
    best = F.reduce(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))),
        F.get(runs, F.lit(0)),
        lambda x, y: F.when(
            y["length"].cast("decimal(19,0)") * x["period"]
            > x["length"].cast("decimal(19,0)") * y["period"],
            y,
        ).otherwise(x),
    )
    told = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(told, lambda t: F.concat(t, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col(f"{name}.text").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    f.__name__: f
    for f in (
        op1_lattice_likelihood,
        op2_n_best_segmentation,
        op3_semi_markov_pii,
        op4_training_order,
        op5_tokeniser_fertility,
        op6_hierarchical_budget,
        op7_licence_automaton,
        op8_permutation_index,
        op9_warc_dictionary,
        op10_ngram_jaccard_join,
        op11_byte_bpe_transducer,
        op12_collocations,
        op13_periodic_runs,
        pipeline,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), lists AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
            FROM pieces
        ), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
        grams AS (
            SELECT lang, array_slice(w, i, i + k - 1) AS g, k, count(*)::BIGINT AS f
            FROM (
                SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM lists, (VALUES (1), (2), (3), (4)) AS ks(k)
            ) GROUP BY ALL HAVING count(*) >= 30
        ), cuts AS (
            SELECT c.lang, c.g, c.f AS a, x.f AS l, y.f AS r, i,
                ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, k)) AS i FROM grams WHERE k > 1) AS c
            JOIN grams AS x ON x.lang = c.lang AND x.g = array_slice(c.g, 1, i)
            JOIN grams AS y ON y.lang = c.lang AND y.g = array_slice(c.g, i + 1, c.k)
        ), scored AS (
            SELECT lang, g, any_value(a) AS a, arg_min(l, [score, i]) AS l, arg_min(r, [score, i]) AS r,
                min(score) AS score
            FROM cuts GROUP BY lang, g
        ), longer AS (
            SELECT lang, array_slice(g, i, i + m - 1) AS g, max(f) AS most
            FROM (
                SELECT *, unnest(range(1, k - m + 2)) AS i
                FROM grams, (VALUES (2), (3)) AS ms(m) WHERE m < k
            ) GROUP BY ALL
        ), best AS (
            SELECT s.lang, array_to_string(s.g, ' ') AS phrase, s.a, s.l, s.r, t.n, s.score,
                row_number() OVER (PARTITION BY s.lang
                    ORDER BY s.score DESC, s.a DESC, array_to_string(s.g, ' ')) AS rank
            FROM scored AS s JOIN totals AS t ON t.lang = s.lang
            LEFT JOIN longer AS o ON o.lang = s.lang AND o.g = s.g
            WHERE o.most IS NULL OR 100 * o.most < 80 * s.a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM best WHERE rank <= 2000""",
    # Five hex digits of the digest are four base32 digits.
    "op9_warc_dictionary": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages
        ), f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
        SELECT page_id,
            octet_length(encode(p.h))::BIGINT AS payload_bytes,
            list_aggregate(list_transform(range(32), lambda g: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(d, (5 * (g // 4) + 1)::INT, 5))::INT
                    >> (15 - 5 * (g % 4))::INT) & 31), 1)), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM p JOIN f ON p.h = f.h""",
}
