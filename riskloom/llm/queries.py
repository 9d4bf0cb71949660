"""The registered queries of this package, one per operator, and the SQL that checks them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    decontaminate, exact_dedup, fill_middle, language_id, licences, line_dedup, lm_scoring, packing, phrases, pii, simhash_dedup, toxicity, warc,
)
from riskloom.llm.common import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target documents are those labelled as of good quality."""
    target = table(spark, sf_dir, "labels").where("quality = 1")
    found = lm_scoring.score(table(spark, sf_dir, "documents"), target)
    return found.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those that repeat an earlier line exactly or within two edits, and those with near texts."""
    found = line_dedup.repeated_lines(line_dedup.numbered(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", F.col("n_lines"), F.size("lines").cast("long").alias("n_dropped"), F.col("n_near").alias("n_near_lines"),
        F.array_join("lines", ",").alias("dropped_lines"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.decisions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and hash are of the plain spans; ``spans`` and ``n_added`` have those of the method too."""
    found = pii.find(table(spark, sf_dir, "documents"))
    plain = F.filter("spans", lambda s: ~s["added"])

    def count(kind: str):
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.listed(plain), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["added"])).cast("long").alias("n_added"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.find(table(spark, sf_dir, "documents"))
    base, more = F.col("phrases.label"), F.col("notices.label")

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, more)).alias("labels"), "score")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.rewrites(fill_middle.framed(table(spark, sf_dir, "documents")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the language, the spans as lang:start:end in code points, the end exclusive."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["lang"], s["start"], s["end"])), ",")
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", spans.alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_line_dedup, op3_exact_dedup, op4_pii, op5_toxicity, op6_decontaminate, op7_warc, op8_licences, op9_simhash_dedup,
    op10_packing, op11_phrases, op12_fill_middle, op13_language_id)}

_BLANKS = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _loss(kind: str) -> str:
    """Mean loss of a document; ``kind`` is t (target) or b (background)."""
    single = f"((w.{kind} + 1.0::DOUBLE) / (total.{kind} + total.types))"
    smooth = f"{lm_scoring.SMOOTHING}::DOUBLE"
    return f"avg(-ln((p.{kind} + {smooth} * {single}) / (c.{kind} + {smooth})))"


_GRAMS = (
    "SELECT lang, {k} AS k, array_to_string(words[i : i + {k} - 1], ' ') AS phrase"
    " FROM (SELECT lang, words, unnest(range(1, len(words) - {k} + 2)) AS i FROM pieces)")

ORACLE = {
    "op1_lm_scoring": rf"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws,
            doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS hit FROM documents),
        tokens AS (SELECT row, hit, generate_subscripts(ws, 1) AS place, unnest(ws) AS word FROM docs),
        pairs AS (SELECT row, hit, word, coalesce(lag(word) OVER (PARTITION BY row ORDER BY place), '') AS before FROM tokens),
        w AS (SELECT word, count(*) AS b, count_if(hit) AS t FROM pairs GROUP BY word),
        c AS (SELECT before, count(*) AS b, count_if(hit) AS t FROM pairs GROUP BY before),
        p AS (SELECT before, word, count(*) AS b, count_if(hit) AS t FROM pairs GROUP BY ALL),
        total AS (SELECT count(*) AS b, count_if(hit) AS t, count(DISTINCT word) AS types FROM pairs),
        losses AS (SELECT row, {_loss("t")} AS target_loss, {_loss("b")} AS background_loss
          FROM pairs JOIN w USING (word) JOIN c USING (before) JOIN p USING (before, word), total GROUP BY row)
        SELECT doc_id, len(ws) AS n_tokens, round(target_loss, 6) AS target_loss, round(background_loss, 6) AS background_loss,
               round(target_loss - background_loss, 6) AS score
        FROM docs LEFT JOIN losses USING (row)""",
    "op3_exact_dedup": rf"""
        WITH keyed AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 sha256(regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM keyed WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)""",
    "op7_warc": """
        WITH keyed AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        grouped AS (
          SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM keyed)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM grouped""",
    "op11_phrases": rf"""
        WITH lines AS (SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS line FROM documents),
        pieces AS (SELECT lang, regexp_extract_all(line, '[^\x20\x09]+') AS words FROM lines),
        total AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
        grams AS ({" UNION ALL ".join(_GRAMS.format(k=k) for k in range(1, phrases.LONGEST + 1))}),
        counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
        whole AS (SELECT *, string_split(phrase, ' ') AS words FROM counts),
        longer AS (SELECT w.lang, array_to_string(w.words[i : i + size - 1], ' ') AS phrase, max(w.a) AS most
          FROM whole w, range(2, {phrases.LONGEST}) s(size), range(1, {phrases.LONGEST} + 1) p(i) WHERE size < w.k AND i + size - 1 <= w.k GROUP BY ALL),
        alone AS (SELECT whole.* FROM whole LEFT JOIN longer USING (lang, phrase) WHERE k >= 2 AND (most IS NULL OR 100 * most < 100 * a)),
        cuts AS (SELECT lang, phrase, a, cut, array_to_string(words[:cut], ' ') AS first, array_to_string(words[cut + 1:], ' ') AS rest
          FROM alone, range(1, {phrases.LONGEST}) c(cut) WHERE cut < k),
        scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, f.a AS l, r.a AS r, n, cut, (1000::HUGEINT * cuts.a * n) // (f.a::HUGEINT * r.a) AS score
          FROM cuts JOIN counts f ON f.lang = cuts.lang AND f.phrase = first JOIN counts r ON r.lang = cuts.lang AND r.phrase = rest
          JOIN total ON total.lang = cuts.lang),
        least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
        FROM least QUALIFY rank <= {phrases.TOP}""",
    "op12_fill_middle": f"""
        WITH drawn AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{fill_middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS draw,
            regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
        numbers AS (SELECT *, len(units) AS n, {", ".join(f"('0x' || substr(draw, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))} FROM drawn),
        cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {fill_middle.REWRITTEN} THEN 'plain'
                 WHEN h4 % 100 < {fill_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM numbers),
        parts AS (SELECT *, array_to_string(units[:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
            array_to_string(units[b + 1:], '') AS suffix FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
        FROM parts""",
}
