"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import boosted_rules, bpe, katz, nbsvm, simhash, substring, token_files
from millrace.llm.decontaminate import contaminated
from millrace.llm.fill_in_middle import fill_in_middle, restore
from millrace.llm.fuzzy_lines import dedup_lines
from millrace.llm.labelled import remainder
from millrace.llm.preference import preference_rows
from millrace.llm.registry import query, table
from millrace.llm.resample import resample
from millrace.llm.url_rules import url_verdicts

#: Host, path and verdict of the url rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query()
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 4) == 2
    classifier = nbsvm.fit_quality_classifier(documents, labels, fits=~held_out)
    scored = nbsvm.quality_scores(documents, classifier)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query(
    f"""
    WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
    parts AS (
      SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.)*?://([^/?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.)*?://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    fitting AS (
      SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id, p.host, p.path
          ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
      FROM parts p LEFT JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1
    """
)
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = boosted_rules.fit_quality_trees(documents, labels, fits=F.lit(True))
    return boosted_rules.quality_rules(documents, trees, keep=("doc_id",))


@query()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


@query()
def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_WINDOW_WORDS = f"array_to_string(words[i:i + {substring.WINDOW - 1}], ' ')"


@query(
    f"""
    WITH split AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
      FROM documents),
    starts AS (
      SELECT doc_id, words, unnest(generate_series(1, len(words) - {substring.WINDOW - 1})) AS i FROM split),
    counted AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY {_WINDOW_WORDS}) AS n FROM starts),
    gone AS (
      SELECT DISTINCT doc_id, unnest(generate_series(i, i + {substring.WINDOW - 1})) AS place
      FROM counted WHERE n > 1),
    placed AS (
      SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM split),
    kept AS (
      SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
      FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
      sha256(coalesce(text, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id)
    """
)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op10_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(table(spark, sf_dir, "documents"), trains=remainder(F.col("doc_id"), 10) != 0, order=3)


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _sql_side(name: str) -> str:
    return f"""
      SELECT t.pair_id, string_agg(line, '' ORDER BY i) AS words,
        string_agg((stop - length(line) + length(head)) || ':' || (stop - 1), ',' ORDER BY i)
          FILTER (WHERE role = 'assistant') AS mask
      FROM (SELECT *, sum(length(line)) OVER (PARTITION BY t.pair_id ORDER BY i) AS stop
            FROM {name} t JOIN prompts USING (pair_id) WHERE i > n) t GROUP BY t.pair_id"""


@query(
    f"""
    WITH turns AS (
      SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
    other AS (
      SELECT * FROM turns WHERE turn < 1 + pair_id % 3
      UNION ALL
      SELECT xor(pair_id, 1), turn, role, text FROM turns WHERE turn >= 1 + xor(pair_id, 1) % 3),
    chosen AS (
      SELECT *, '<|' || role || '|>' || chr(10) AS head, head || text || '<|end|>' || chr(10) AS line,
        row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS i FROM turns),
    rejected AS (
      SELECT *, '<|' || role || '|>' || chr(10) AS head, head || text || '<|end|>' || chr(10) AS line,
        row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS i FROM other),
    prompts AS (
      SELECT pair_id, coalesce(min(i) FILTER (WHERE c.line IS DISTINCT FROM r.line) - 1, count(*)) AS n
      FROM chosen c FULL JOIN rejected r USING (pair_id, i) GROUP BY pair_id
      HAVING count(c.line) > 0 AND count(r.line) > 0),
    prompt AS (
      SELECT pair_id, string_agg(line, '' ORDER BY i) AS words
      FROM chosen JOIN prompts USING (pair_id) WHERE i <= n GROUP BY pair_id),
    c AS ({_sql_side("chosen")}),
    r AS ({_sql_side("rejected")})
    SELECT pair_id, n::INTEGER AS prompt_turns, coalesce(prompt.words, '') AS prompt,
      coalesce(c.words, '') AS chosen, coalesce(r.words, '') AS rejected,
      coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
    FROM prompts LEFT JOIN prompt USING (pair_id) LEFT JOIN c USING (pair_id) LEFT JOIN r USING (pair_id)
    """
)
def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen is each conversation; rejected begins like it and goes on like its neighbour."""
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "pair_id")
    own = 1 + F.col("pair_id") % 3
    neighbour = turns.withColumn("pair_id", F.col("pair_id").bitwiseXOR(F.lit(1).cast("long")))
    rejected = turns.where(F.col("turn") < own).unionByName(neighbour.where(F.col("turn") >= own))
    rows = preference_rows(turns, rejected)

    def written_out(mask: str) -> Column:
        spans = F.transform(mask, lambda s: F.concat_ws(":", s["start"], s["end"]))
        return F.array_join(spans, ",").alias(mask)

    return rows.select(
        "pair_id", "prompt_turns", "prompt", "chosen", "rejected", written_out("chosen_mask"), written_out("rejected_mask")
    )


def _draw_sql(i: int) -> str:
    return f"('0x' || substr(sha256('7:' || doc_id), {8 * i + 1}, 8))::BIGINT AS h{i + 1}"


@query(
    f"""
    WITH cut AS (
      SELECT doc_id, coalesce(text, '') AS words, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
        len(units)::BIGINT AS n, {", ".join(map(_draw_sql, range(4)))}
      FROM documents),
    placed AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN words = '' OR contains(words, '<P>') OR contains(words, '<S>') OR contains(words, '<M>') OR h3 % 100 >= 100
          THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
      FROM cut),
    parts AS (
      SELECT *, array_to_string(units[:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
        array_to_string(units[b + 1:], '') AS suffix
      FROM placed)
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN words
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(words) AS restored_sha256
    FROM parts
    """
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = fill_in_middle(table(spark, sf_dir, "documents"))
    return restore(changed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


@query()
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        files = token_files.write_token_files(table(spark, sf_dir, "documents"), definition.read(), end=2)
    read = token_files.read_token_files(files)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
