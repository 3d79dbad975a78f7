"""The queries of the training-data problems and, where SQL can say them, their ANSI SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkweave.llm import alignment, boundaries, bpe, leakage, lookalikes, quality, scannoise, sentences, splitting, termcounts
from inkweave.sources.tables import corpus_rows, spread, table

#: Where the public tokenizers lie; a parameter, never copied into the repository.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    return corpus_rows(spark, d, "han_boxes", "chapter", "page", "box_idx", "bbox", "sinonom", costly=True)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    vi = scannoise.vi_noise(corpus_rows(spark, d, "vi_sentences", "text", costly=True)).withColumn("entity", F.lit("vi_sentences"))
    han = scannoise.box_noise(_boxes(spark, d)).withColumn("entity", F.lit("han_boxes"))
    return vi.unionByName(han).select("entity", "vol", "id", "kind")


def p1_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Every chapter of vi_sentences.text and of han_boxes.sinonom repaired into continuous paragraphs; entity is the table name."""
    rows = corpus_rows(spark, d, "vi_sentences", "chapter", "page", "sent_idx", "text", costly=True)
    repaired = scannoise.repaired_vi(rows).select("vol", "id", "repaired")
    vi = scannoise.paragraphs(rows.select("vol", "id", "chapter", "page", "sent_idx").join(repaired, ["vol", "id"])).withColumn("entity", F.lit("vi_sentences"))
    boxes = _boxes(spark, d)
    mended = boxes.select("vol", "id", "chapter", "page", "box_idx").join(scannoise.repaired_boxes(boxes), ["vol", "id"])
    han = scannoise.paragraphs(mended, "han", place="box_idx", glue="").withColumn("entity", F.lit("han_boxes"))
    return vi.unionByName(han).select("entity", "vol", "chapter", "paragraph_no", "paragraph")


def _gaps(spark: SparkSession, d: str) -> boundaries.Gaps:
    """What the punctuated Chinese rows say about bare ones; off the scan, as the sample is the top of an order."""
    return sentences.learn_boundaries(table(spark, d, "han_sentences"), "sinonom")


def _sentence_rows(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    place = ("chapter", "page", "sent_idx")
    return (
        corpus_rows(spark, d, "han_sentences", *place, "sinonom", "is_dbl", where="NOT coalesce(is_dbl, false)", costly=True),
        corpus_rows(spark, d, "vi_sentences", *place, "text", costly=True),
        table(spark, d, "hanviet"),
        table(spark, d, "s2_readings"),
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return alignment.aligned_rows(*_sentence_rows(spark, d), model=_gaps(spark, d))


def p2_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The linked sentences of every chapter with their scores."""
    return alignment.aligned_sentences(*_sentence_rows(spark, d), model=_gaps(spark, d))


def _both_texts(spark: SparkSession, d: str, find: Callable[..., DataFrame]) -> DataFrame:
    han = find(corpus_rows(spark, d, "han_sentences", "sinonom", costly=True), "sinonom", "han", "vol", "id", model=_gaps(spark, d))
    vi = find(corpus_rows(spark, d, "vi_sentences", "text", costly=True), "text", "vi", "vol", "id")
    return han.withColumn("entity", F.lit("han_sentences")).unionByName(vi.withColumn("entity", F.lit("vi_sentences")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _both_texts(spark, d, sentences.sentence_boundaries).select("entity", "vol", "id", "boundary_at")


def p3_units(spark: SparkSession, d: str) -> DataFrame:
    """Every sentence unit of every row."""
    return _both_texts(spark, d, sentences.sentence_units).select("entity", "vol", "id", "unit_no", "unit")


def _vi_terms(spark: SparkSession, d: str) -> DataFrame:
    return corpus_rows(spark, d, "vi_sentences", "text").select(termcounts.letter_runs(F.col("text")).alias("terms"))


def _vocab_terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "oov_vocab").select(termcounts.value_terms(F.col("token")).alias("terms"))


def p4_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every term of both fields with its count, its rows and its mark."""
    vi = termcounts.term_marks(_vi_terms(spark, d), "terms", rare=2, common=0.1).withColumn("field", F.lit("vi_sentences.text"))
    oov = termcounts.term_marks(_vocab_terms(spark, d), "terms", rare=1, common=0.01).withColumn("field", F.lit("oov_vocab.token"))
    return vi.unionByName(oov).select("field", "term", "n", "records", "mark")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_terms(spark, d).where("mark is not null").select("field", "term", "mark")


def p4_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """Every n-gram of up to three terms of vi_sentences.text."""
    counted = termcounts.count_ngrams(_vi_terms(spark, d), "terms", longest=3)
    return counted.select(F.concat_ws(" ", "ngram").alias("ngram"), F.size("ngram").alias("terms"), "n", "records")


def _columns_and_sentences(spark: SparkSession, d: str) -> DataFrame:
    both = [corpus_rows(spark, d, t, "chapter", "sinonom", costly=True).withColumn("entity", F.lit(t)) for t in ("han_boxes", "han_sentences")]
    return both[0].unionByName(both[1])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = lookalikes.read_alike_pairs(_columns_and_sentences(spark, d), ["entity", "vol", "chapter"], "id", "sinonom")
    return pairs.select("entity", "vol", "id_a", "id_b")


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every row of both tables in its one consistent form."""
    return lookalikes.consistent_form(_columns_and_sentences(spark, d), "sinonom").select("entity", "vol", "id", "form")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(_long_rows(spark, d), "sinonom", "vol", "id")


def _long_rows(spark: SparkSession, d: str) -> DataFrame:
    return corpus_rows(spark, d, "han_sentences", "sinonom", where=F.length("sinonom") > 120)


def p6_merged(spark: SparkSession, d: str) -> DataFrame:
    """The same rows in pieces merged over the whole text, cut where it pauses most."""
    return splitting.split_merged(_long_rows(spark, d), "sinonom", "vol", "id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_texts(spread(table(spark, d, "documents")), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.json")


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, from their ids."""
    return bpe.decode_ids(p7_ids(spark, d), "doc_id", "ids", f"{TOKENIZERS}/byte_bpe_50k.json")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(spread(table(spark, d, "documents")), table(spark, d, "eval_items"))


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    """The stretches of units to remove from each document concerned, with the items that leaked there."""
    spans = leakage.leaked_spans(spread(table(spark, d, "documents")), table(spark, d, "eval_items"))
    return spans.withColumn("item_ids", F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ","))


def p8_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Each document concerned without the leaked passages."""
    return leakage.cleaned_documents(spread(table(spark, d, "documents")), table(spark, d, "eval_items"))


def _prose_judge(spark: SparkSession, d: str) -> quality.ProseJudge:
    # Off the scans: the sample is the top of an order, so neither table is dealt out.
    prose = lambda name, text: table(spark, d, name).select(F.xxhash64("vol", "id").alias("o"), F.col(text).alias("t"))
    return quality.ProseJudge.fit(spark, {"vi": prose("vi_sentences", "text"), "han": prose("han_sentences", "sinonom")})


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.no_prose_documents(spread(table(spark, d, "documents")), _prose_judge(spark, d))


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Per-document statistics of documents.text."""
    return quality.text_statistics(spread(table(spark, d, "documents")), _prose_judge(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_paragraphs, p2_found, p2_sentences, p3_found, p3_units, p4_found, p4_terms, p4_ngrams, p5_found, p5_forms, p6_found, p6_merged, p7_ids, p7_decoded, p8_found, p8_spans, p8_cleaned, p9_found, p9_statistics)
}

_VI_ROWS = "SELECT DISTINCT ON (vol, id) text FROM vi_sentences"
_VI_TERMS = rf"SELECT row_number() OVER () AS r, regexp_extract_all(lower(nfc_normalize(text)), '\p{{L}}+') AS t FROM ({_VI_ROWS})"
_VOCAB = r"regexp_replace(nfc_normalize(token), '^[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+$', '', 'g')"
_TERMS = f"""
WITH vi AS ({_VI_TERMS}),
a AS (SELECT 'vi_sentences.text' AS field, term, count(*) AS n, count(DISTINCT r) AS records FROM (SELECT r, unnest(t) AS term FROM vi) GROUP BY term),
b AS (SELECT 'oov_vocab.token' AS field, lower({_VOCAB}) AS term, count(*) AS n, count(*) AS records FROM oov_vocab WHERE token IS NOT NULL GROUP BY 2 HAVING lower({_VOCAB}) <> ''),
m AS (
  SELECT *, CASE WHEN records <= 2 THEN 'rare' WHEN records > 0.1 * (SELECT count(*) FROM vi) THEN 'common' END AS mark FROM a
  UNION ALL
  SELECT *, CASE WHEN records <= 1 THEN 'rare' WHEN records > 0.01 * (SELECT count(*) FROM oov_vocab) THEN 'common' END AS mark FROM b)
"""
_WINDOW = "substr(t, s + 1, 120)"
_CUT = rf"""
CASE WHEN regexp_matches({_WINDOW}, '(?s)^.{{60,119}}[。！？；]') THEN length(regexp_extract({_WINDOW}, '(?s)^.{{60,119}}[。！？；][」』]*'))
     WHEN regexp_matches({_WINDOW}, '(?s)^.{{60,119}}[，、：]') THEN length(regexp_extract({_WINDOW}, '(?s)^.{{60,119}}[，、：][」』]*'))
     ELSE 120 END
"""
ORACLES: dict[str, str] = {
    "p4_terms": f"{_TERMS} SELECT field, term, n, records, mark FROM m",
    "p4_found": f"{_TERMS} SELECT field, term, mark FROM m WHERE mark IS NOT NULL",
    "p4_ngrams": f"""
WITH vi AS ({_VI_TERMS}),
g AS (SELECT r, k, unnest(list_transform(range(1, greatest(len(t) - k + 2, 1)), lambda i: array_to_string(t[i:i + k - 1], ' '))) AS ngram
      FROM vi, (SELECT unnest([1, 2, 3]) AS k))
SELECT ngram, CAST(k AS INTEGER) AS terms, count(*) AS n, count(DISTINCT r) AS records FROM g GROUP BY ngram, k""",
    "p6_found": f"""
WITH RECURSIVE h AS (SELECT DISTINCT ON (vol, id) vol, id, sinonom AS t FROM han_sentences),
p AS (
  SELECT vol, id, t, 1 AS piece_no, 0 AS s, CASE WHEN length(t) <= 120 THEN length(t) ELSE {_CUT.replace('s + 1', '1')} END AS e FROM h WHERE length(t) > 120
  UNION ALL
  SELECT vol, id, t, piece_no + 1, s, CASE WHEN length(t) - s <= 120 THEN length(t) ELSE s + {_CUT} END
  FROM (SELECT vol, id, t, piece_no, e - 15 AS s, e FROM p WHERE e < length(t)))
SELECT vol, id, CAST(piece_no AS INTEGER) AS piece_no, CAST(s AS INTEGER) AS start_pos, CAST(e AS INTEGER) AS end_pos FROM p""",
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
