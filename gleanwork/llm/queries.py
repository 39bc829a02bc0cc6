"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import (
    chat, exact_dedup, fill_in_middle, html_extract, line_dedup, minhash, mixing, periodic_runs, pieces, quality_classifier,
    quality_rules, token_files, url_filter,
)
from gleanwork.session import ensure_settings, scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's ids of every text, two sampled segmentations, and whether the text comes back."""
    docs = _table(spark, sf_dir, "documents")
    return pieces.encode_and_sample(docs, public_tokenizers.path("piece_bpe_32k.model"), checksums=True)


CALL_SCHEMAS = {"answer": {
    "properties": {"question": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["question", "turn"],
}}


def call_items(conversations: DataFrame) -> DataFrame:
    """Conversations as tool use: a user's turn calls `answer`, the assistant's next turn is the result.

    Seven sixteenths of the calls, told by the hash of conversation and turn, are faulty: torn arguments (0), a turn of the
    wrong type (1), an unknown tool (2), the id of an earlier call (3), a dependency on itself (5), on no call (6), or on a later
    call that depends on it (7). A sixteenth of the results (4) names a call that is not there.
    """
    turn, conv, body = F.col("turn"), F.col("conv_id").cast("string"), F.coalesce("text", F.lit("")).alias("question")
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    odd = F.expr("crc32(concat_ws('-', conv_id, turn)) % 16")

    def of(by: int) -> Column:
        return F.concat_ws("-", conv, (turn + by).cast("string"))

    call_id = F.when(user & (turn >= 2) & (odd == 3), of(-2)).when(user, of(0)).when(assistant & (odd == 4), F.concat(of(0), F.lit("-lost"))).when(assistant, of(-1))
    arguments = F.when(odd == 0, '{"question":').when(odd == 1, F.to_json(F.struct(body, turn.cast("string").alias("turn")))).otherwise(
        F.to_json(F.struct(body, turn.alias("turn"))))
    after = F.when(odd == 5, F.array(of(0))).when(odd == 6, F.array(F.concat(conv, F.lit("-none")))).when(odd == 7, F.array(of(2))).when(turn >= 2, F.array(of(-2)))
    return conversations.select(
        F.col("conv_id").alias("conv"), "turn",
        F.when(user, "call").when(assistant, "result").otherwise("message").alias("kind"), "role", "text", call_id.alias("call_id"),
        F.when(user & (odd == 2), "search").when(user, "answer").alias("name"), F.when(user, arguments).alias("arguments"),
        F.when(user, after).alias("after"),
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chat.format_chats(call_items(_table(spark, sf_dir, "conversations")), CALL_SCHEMAS)
    return made.select(
        F.col("conv").alias("conv_id"), "chat",
        F.array_sort(F.map_entries("faults")).cast("array<struct<fault:string,n:bigint>>").alias("faults"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.is_spam_host(F.col("host")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.quality_rules(docs).select("doc_id", "quality.*")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "n_removed_lines", "removed_chars")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no address: their source stands for the host, their language for the section."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_classifier.classify(docs, labels, F.col("source"), F.col("lang"))


def quality_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classifier over real sites: the text of every page, its host, and the first segment of its path."""
    pages, docs, labels = (_table(spark, sf_dir, t) for t in ("pages", "documents", "labels"))
    texts = url_filter.split_url(html_extract.extract_text(pages))
    section = F.regexp_extract("path", "^/([^/]*)/", 1)
    return quality_classifier.classify_other(texts, docs, labels, F.col("host"), section, "page_id")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "token-files")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    files = token_files.read_token_files(spark, path)
    sums = token_files.checksums(files)
    return token_files.starts(files).join(sums, ["file", "row"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.document_lines(_table(spark, sf_dir, "documents"))


def _planted(key: str, text: str) -> Column:
    """The text, for a tenth of the ids with its last words replaced by repetitions of earlier ones."""
    return F.expr(f"""
        CASE WHEN crc32(CAST({key} AS STRING)) % 10 = 0 THEN
            transform(array(named_struct('w', regexp_extract_all({text}, r'[^\\x20\\x09-\\x0D]+', 0), 'g', crc32(CAST({key} AS STRING)) DIV 10)), x ->
                if(size(x.w) = 0, '', transform(array(named_struct('w', x.w, 'a', x.g % size(x.w), 'p', 1 + (size(x.w) - x.g % size(x.w)) DIV (3 + x.g % 8))), y ->
                    array_join(transform(sequence(0, size(y.w) - 1), i -> y.w[CAST(if(i >= y.a, y.a + (i - y.a) % y.p, i) AS INT)]), ' '))[0]))[0]
        ELSE {text} END""")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", _planted("doc_id", "text").alias("text"))
    found = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.longest(F.col("runs")))
    shown = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(shown, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {
    "pipeline": pipeline,
    "op1_exact_dedup": op1_exact_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "quality_of_pages": quality_of_pages,
    "op7_near_dedup": op7_near_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_token_files": op9_token_files,
    "op10_line_dedup": op10_line_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_html_extraction": op12_html_extraction,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               coalesce(doc_id = max(doc_id) OVER same, false) AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op4_url_filter": rf"""
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        rules(rule, domain, prefix, verdict) AS (VALUES
            ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
        best AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM parts, rules
            WHERE (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)
            GROUP BY page_id)
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])(casino|pills|bets|ads)([.-]|$)')
                                      THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN best USING (page_id)""",
    "op7_near_dedup": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, {_WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
        n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
        e AS (SELECT doc_id, unnest(s) AS x FROM s),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * c >= 75 * (na.n + nb.n - c)),
        sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a)
        SELECT n.doc_id, n.n AS n_shingles, r.m AS component_id, n.doc_id = r.m AS kept
        FROM n JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = n.doc_id""",
    "op13_fill_in_middle": r"""
        WITH u AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   sha256('1:' || doc_id) AS h FROM documents),
        drawn AS (
            SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
                   ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM u),
        cut AS (
            SELECT doc_id, t, n, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
                   array_to_string(u[greatest(x, y) + 1:], '') AS s,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain'
                        WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM cut""",
}
# Lines removed by the method, and the words taken, are tested against brute force in tests/llm.
