"""The registered queries of this subpackage: thin, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import bpe, collocations, common, cotrain, decontam, pii, ppm, rules, runs, shards, simhash, simple8b, suffix, warc
from tablework.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archives back."""
    folder = scratch_dir(spark, "warc")
    warc.write_deduplicated(warc.records(table(spark, sf_dir, "pages")), folder)
    read = warc.resolve_revisits(common.stored(warc.read_records(spark, folder), "warc-read"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into files of packed ids, read the files back."""
    folder = scratch_dir(spark, "token-ids")
    simple8b.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, added_tokens=True)
    read = simple8b.with_starts(simple8b.read_token_files(spark, folder))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge all documents by the base rule and the learned list."""
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of all documents; a fifth of them, by a checksum of the id, teaches nothing."""
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = ppm.fit(ppm.training_rows(docs.where(remainder != 0)))
    found = ppm.predict(docs, model)
    return found.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    counts = [F.size(F.filter("spans", pii.is_kind(k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op6_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, decode the ids."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents: one row per document and item that it holds."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start_word").cast("long"), F.col("n_words").cast("long"), F.round("similarity", 6).alias("similarity"))


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and verdict of all documents."""
    return cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that several documents share."""
    return suffix.repeated_passages(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language in all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of even size in bytes, equal texts together."""
    found = shards.shard_documents(table(spark, sf_dir, "documents"))
    return found.withColumn("grown_shard", F.lit(None).cast("int"))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text: in a tenth of the documents, by a checksum of the id, the words from some place on repeat."""
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    texts = docs.select("doc_id", "text", (F.coalesce(check, F.lit(1)) % 10 == 0).alias("chosen"), F.floor(check / 10).alias("g"))

    def repeated(words):
        n = F.size(words).cast("long")
        a = F.col("g") % n
        p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    changed = common.let(common.words_of(F.coalesce("text", F.lit(""))), repeated)
    return texts.select("doc_id", F.when(F.col("chosen"), changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, a tenth of which get repeats planted first."""
    found = runs.periodic_runs(with_planted_repeats(table(spark, sf_dir, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_revisits,
        op2_simple8b,
        op3_decision_list,
        op4_language_ppm,
        op5_pii_spans,
        op6_simhash_popcount,
        op7_byte_bpe,
        op8_decontaminate,
        op9_cotraining,
        op10_suffix_passages,
        op11_collocations,
        op12_label_shards,
        op13_periodic_runs,
    )
}

SQL: dict[str, str] = {
    "op1_warc_revisits": """WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
      d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
      f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
      SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to FROM f""",
    "op8_decontaminate": """WITH
      d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
      i AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
      ds AS (SELECT doc_id, len(w) AS doc_words, unnest(range(0, len(w) - 4)) AS pos, w FROM d WHERE len(w) >= 5),
      dsh AS (SELECT doc_id, doc_words, pos, array_to_string(w[pos + 1 : pos + 5], ' ') AS sh FROM ds),
      js AS (SELECT item_id, len(w) AS n, unnest(range(0, len(w) - 4)) AS pos, w FROM i WHERE len(w) >= 5),
      ish AS (SELECT item_id, n, pos, array_to_string(w[pos + 1 : pos + 5], ' ') AS sh FROM js),
      hit AS (SELECT DISTINCT doc_id, doc_words, item_id, n, dsh.pos AS pos FROM dsh JOIN ish USING (sh)),
      cand AS (SELECT DISTINCT doc_id, doc_words, item_id, n, pos - unnest(range(0, n - 4)) AS s FROM hit),
      win AS (SELECT DISTINCT doc_id, item_id, greatest(s, 0) AS a, least(s + n, doc_words) AS b FROM cand),
      wc AS (SELECT win.doc_id, win.item_id, win.a, win.b, sh, count(*) AS c FROM win
        JOIN dsh ON dsh.doc_id = win.doc_id AND dsh.pos >= win.a AND dsh.pos <= win.b - 5 GROUP BY ALL),
      ic AS (SELECT item_id, sh, count(*) AS c FROM ish GROUP BY ALL),
      inter AS (SELECT wc.doc_id, wc.item_id, a, b, sum(least(wc.c, ic.c)) AS x FROM wc JOIN ic ON ic.item_id = wc.item_id AND ic.sh = wc.sh GROUP BY ALL),
      scored AS (SELECT doc_id, inter.item_id, a, b, x / ((b - a - 4) + (n - 4) - x) AS similarity
        FROM inter JOIN (SELECT DISTINCT item_id, n FROM js) USING (item_id))
      SELECT doc_id, item_id, CAST(a AS BIGINT) AS start_word, CAST(b - a AS BIGINT) AS n_words, round(similarity, 6) AS similarity
      FROM scored WHERE similarity >= 0.8
      QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, a, b) = 1""",
    "op11_collocations": """WITH
      d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
      p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM d),
      w AS (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
      g AS (SELECT lang, k, w[i : i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) s(k))),
      f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL),
      often AS (SELECT * FROM f WHERE a >= 30),
      c AS (SELECT lang, k, g, a, unnest(range(1, k)) AS cut FROM often WHERE k >= 2),
      s AS (SELECT c.*, x.a AS l, y.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score FROM c
        JOIN often x ON x.lang = c.lang AND x.g = c.g[1 : cut] JOIN often y ON y.lang = c.lang AND y.g = c.g[cut + 1 : c.k]),
      b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
      inside AS (SELECT lang, g[i : i + m - 1] AS part, max(a) AS longer FROM
        (SELECT lang, g, a, k, m, unnest(range(1, k - m + 2)) AS i FROM often, (VALUES (2), (3)) s(m) WHERE k > m) GROUP BY ALL),
      kept AS (SELECT b.* FROM b LEFT JOIN inside ON inside.lang = b.lang AND inside.part = b.g WHERE longer IS NULL OR 100 * longer < 80 * a),
      n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
      o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept)
      SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
      FROM o JOIN n USING (lang) QUALIFY rank <= 2000""",
}
