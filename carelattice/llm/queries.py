"""The operators' registered queries over the supplied tables, and the SQL they must agree with where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversations,
    decontamination,
    exact,
    jaccard,
    katz,
    langid,
    packing,
    periodic,
    quality,
    substrings,
    token_files,
    toxicity,
    warc,
)
from .common import documents, remainder
from .tokens import default_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(_table(spark, sf_dir, "documents")).withColumn("training", remainder("doc_id", 7) != 2)
    scored = katz.katz_scores(docs)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), default_path("word_bpe_49k.json"))


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scores.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    classifier, _ = toxicity.learn(docs, quality.training_labels(labels, "toxic"))
    return _scored(toxicity.score_toxicity(docs, classifier), 0.5)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _draw(modulus: int):
    """A number below `modulus` from the md5 of the page's id."""
    return F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % modulus


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against a replica in which some records are altered, lost or added."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    altered = F.when(_draw(31) == 3, F.concat(F.coalesce("html", F.lit("")), F.lit("~"))).otherwise(F.col("html"))
    kept = pages.where(~F.coalesce(_draw(37) == 5, F.lit(False))).select("page_id", "url", altered.alias("html"))
    top = pages.agg(F.max("page_id")).head()[0] or 0
    added = pages.where(_draw(41) == 7).select((F.col("page_id") + top + 1).alias("page_id"), "url", "html")
    return warc.audit(pages, kept.unionByName(added))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality.learn(docs, quality.training_labels(labels, "quality"))
    return _scored(quality.score_quality(docs, model), 0.3)


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(
        _table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"), end_id=2, vocabulary_size=50_257
    )
    return token_files.read_spans(files).drop("shard")


WHITE = r"[\x20\x09-\x0D]+"


def with_periods(docs: DataFrame) -> DataFrame:
    """`doc_id, text` where some texts (by crc32 of doc_id) go on periodically from one of their words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", WHITE), lambda w: w != "")
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    made = F.expr(
        "array_join(transform(sequence(0L, n - 1L), i -> get(words, cast(if(i < a, i, a + (i - a) % p) as int))), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_periods(_table(spark, sf_dir, "documents")))
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256)
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        listed.alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    trees = langid.learn(docs.where(remainder("doc_id", 4) != 2).select("text", "lang"))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return langid.predict(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits")


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` with faults planted by crc32 of `conv_id:turn`; a row that is dropped stays as not `present`."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
    fault = F.col("fault")
    changed = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        changed.alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.summaries(conversations.repair(damaged(_table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_katz,
        op2_packing,
        op3_toxicity,
        op4_decontamination,
        op5_substrings,
        op6_merkle,
        op7_quality,
        op8_exact,
        op9_jaccard,
        op10_token_files,
        op11_periodic,
        op12_langid,
        op13_conversations,
    )
}

#: Table of crc32 per byte as one list, and the crc32 of an ASCII text by it.
_CRC_TABLE = """crc AS (
            SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
            FROM range(256) r(i)
        )"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, len({text}) + 1),
                lambda i: ord(({text})[i])::BIGINT)), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"""


SQL: dict[str, str] = {
    "op5_substrings": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ),
        starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i0 FROM w WHERE len(words) >= 20),
        later AS (
            SELECT doc_id, i0, row_number() OVER (
                PARTITION BY list_aggregate(words[i0 : i0 + 19], 'string_agg', ' ') ORDER BY doc_id, i0
            ) > 1 AS again
            FROM starts
        ),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i0, i0 + 20)) AS place FROM later WHERE again),
        lost AS (SELECT doc_id, list(place) AS places, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
            sha256(coalesce(list_aggregate(list_filter(list_transform(range(1, len(words) + 1),
                lambda i: CASE WHEN list_contains(places, i) THEN NULL ELSE words[i] END), lambda x: x IS NOT NULL),
                'string_agg', ' '), '')) AS kept_sha256
        FROM w LEFT JOIN lost USING (doc_id)""",
    "op6_merkle": r"""
        WITH p AS (
            SELECT page_id, ('0x' || substr(md5(page_id::VARCHAR), 1, 4))::INTEGER AS draw,
                strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
                    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
                    || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
                    || chr(13) || chr(10) || chr(13) || chr(10)) AS length
            FROM pages
        ),
        o AS (
            SELECT *, (sum(length) OVER (PARTITION BY page_id >> 12 ORDER BY page_id) - length)::BIGINT AS "offset" FROM p
        )
        SELECT page_id AS number, page_id >> 12 AS file, "offset", length,
            CASE WHEN draw % 37 = 5 THEN 'missing' ELSE 'corrupt' END AS status
        FROM o WHERE draw % 37 = 5 OR draw % 31 = 3
        UNION ALL
        SELECT page_id + 1 + (SELECT max(page_id) FROM pages), (page_id + 1 + (SELECT max(page_id) FROM pages)) >> 12, NULL,
            length, 'extra'
        FROM p WHERE draw % 41 = 7""",
    "op8_exact": r"""
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, min(doc_id) OVER g = doc_id AS kept,
            text_sha256
        FROM (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_periodic": rf"""
        WITH {_CRC_TABLE},
        w AS (
            SELECT row_number() OVER () AS r, doc_id, {_crc("doc_id::VARCHAR")} AS h, list_filter(
                regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents, crc
        ),
        v AS (SELECT *, len(words)::BIGINT AS n, h // 10 AS g, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM w),
        own AS (
            SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: words[
                1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE words END AS words
            FROM v
        ),
        grams AS (
            SELECT r, n, i, array_to_string(words[i + 1 : i + 16], ' ') AS gram
            FROM (SELECT r, n, words, unnest(range(0, n - 15)) AS i FROM own WHERE n >= 24)
        ),
        pairs AS (
            SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i
            WHERE 3 * (y.i - x.i) <= x.n
        ),
        stretches AS (
            SELECT r, q, min(i) AS s, max(i) + 16 + q AS e
            FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs)
            GROUP BY r, q, island HAVING max(i) + 16 + q - min(i) >= greatest(24, 3 * q)
        ),
        runs AS (
            SELECT * FROM stretches x WHERE NOT EXISTS (
                SELECT 1 FROM stretches y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.e >= x.e)
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY (e - s) / q DESC, s, q) AS k FROM runs),
        listed AS (
            SELECT r, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines
            FROM runs GROUP BY r
        ),
        gone AS (SELECT DISTINCT r, unnest(range(s + q, e)) AS i FROM runs),
        places AS (SELECT r, words, unnest(range(0, n)) AS i FROM own SEMI JOIN runs USING (r)),
        kept AS (
            SELECT r, string_agg(words[i + 1], ' ' ORDER BY i) AS text FROM places ANTI JOIN gone USING (r, i) GROUP BY r
        )
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, (e - s)::BIGINT AS length, q::BIGINT AS period,
            (1000 * (e - s) // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
            sha256(coalesce(kept.text, array_to_string(words, ' '))) AS collapsed_sha256
        FROM own LEFT JOIN listed USING (r) LEFT JOIN ranked ON ranked.r = own.r AND k = 1 LEFT JOIN kept ON kept.r = own.r""",
    "op13_conversations": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        marked AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f
            FROM conversations, crc
        ),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
                CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM marked WHERE f <> 0
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS i,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
                substr(role, 1, 1) AS initial
            FROM damaged
        ),
        faults AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
            FROM placed
        ),
        totals AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id
        ),
        inserts(before, times, after, made) AS (
            VALUES (0, 0, 0, []::VARCHAR[]), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
                (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']),
                (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']), (2, 2, 2, ['assistant:', 'user:']),
                (3, 2, 3, ['user:', 'assistant:'])
        ),
        letters(letter) AS (VALUES ('D'), ('K'), ('R')),
        ways AS (
            SELECT conv_id, 0 AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': '', 'made': []::VARCHAR[]}} AS best FROM totals
            UNION ALL
            SELECT w.conv_id, w.i + 1, CASE WHEN letter = 'D' THEN after WHEN letter = 'K' AND initial = 's' THEN 1
                    WHEN after = 2 THEN 3 ELSE 2 END AS next,
                min({{'cost': w.best.cost + 2 * times + CASE letter WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END
                        + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END,
                    'audit': w.best.audit || repeat('I', times) || letter,
                    'made': w.best.made || p.made || CASE letter WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
                        ELSE [CASE WHEN after = 2 THEN 'assistant' ELSE 'user' END || ':' || text] END}})
            FROM ways w JOIN inserts p ON p.before = w.state
            JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i
            JOIN letters ON letter = 'D' OR (fault NOT IN ('blank', 'duplicate') AND CASE letter
                WHEN 'K' THEN initial = CASE WHEN after = 2 THEN 'a' ELSE 'u' END OR (initial = 's' AND after = 0)
                ELSE initial <> CASE WHEN after = 2 THEN 'a' ELSE 'u' END END)
            GROUP BY w.conv_id, w.i, next
        ),
        ends AS (
            SELECT w.conv_id, min({{'cost': w.best.cost + 2 * times, 'audit': w.best.audit || repeat('I', times),
                'made': w.best.made || p.made}}) AS best
            FROM ways w JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = t.n
            JOIN inserts p ON p.before = w.state AND p.after IN (0, 3)
            GROUP BY w.conv_id
        )
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
            coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
            coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
            sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
