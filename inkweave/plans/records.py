"""Queries of the Vietnamese chain, of files in the formats of others, and of small record operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkweave.functions import text as T
from inkweave.operators import consensus, layout, lexicon, metrics, sequences, stream
from inkweave.plans.queries import _CLEAN, _FORMS, _N, _VOCAB, _vocabulary
from inkweave.plans.registry import query
from inkweave.session import checkpoint_dir
from inkweave.sources import files
from inkweave.sources.tables import corpus_rows, table

# ---------------------------------------------------------------- the Vietnamese chain

_CLEANED = f"trim(regexp_replace(regexp_replace(t{_N}, '\\s{{2,}}', ' ', 'g'), '{T.SPACE_BEFORE_MARK}', '\\1', 'g'), ' ')"


@query(rf"""
WITH RECURSIVE $ONCE, o AS (SELECT vol, chapter, page, sent_idx, id, text, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY vol, chapter ORDER BY page, sent_idx, id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS r0 FROM v WHERE text IS NOT NULL),
t AS (SELECT vol, chapter, string_agg(text, ' ' ORDER BY page, sent_idx, id) AS t FROM o GROUP BY ALL),
s AS (SELECT vol, chapter, t, list_filter(list_transform(string_split(regexp_replace(t, '{T.SENTENCE_END}', E'\\1\x01\\2', 'g'), E'\x01'), lambda x: trim(x, ' ')), lambda x: x <> '') AS ss FROM t),
r AS (SELECT vol, chapter, t, ss, 0 AS k, 0 AS start, 0 AS stop FROM s
  UNION ALL SELECT vol, chapter, t, ss, k + 1, stop + greatest(strpos(substr(t, stop + 1), ss[k + 1]) - 1, 0), stop + greatest(strpos(substr(t, stop + 1), ss[k + 1]) - 1, 0) + length(ss[k + 1]) FROM r WHERE k < len(ss)),
e AS (SELECT vol, chapter, CAST(k AS INTEGER) AS sent_no, ss[k] AS sentence, CAST(start AS BIGINT) AS start_at, CAST(stop AS BIGINT) AS end_at FROM r WHERE k > 0),
p AS (SELECT e.vol, e.chapter, sent_no, arg_max(page, (r0, page)) AS page FROM e JOIN o ON e.vol = o.vol AND e.chapter = o.chapter AND r0 <= start_at GROUP BY ALL),
i AS (SELECT e.vol, e.chapter, sent_no, string_agg(id, ',' ORDER BY r0, id) AS ids FROM e JOIN o ON e.vol = o.vol AND e.chapter = o.chapter AND text <> '' AND r0 < end_at AND r0 + length(text) > start_at GROUP BY ALL)
SELECT e.vol, e.chapter, sent_no, sentence, start_at, end_at, page, ids FROM e JOIN p USING (vol, chapter, sent_no) LEFT JOIN i USING (vol, chapter, sent_no)""")
def restreamed_sentences(s: SparkSession, d: str) -> DataFrame:
    """A chapter's rows as one text cut into sentences, each with its page and the rows that it touches."""
    rows = corpus_rows(s, d, "vi_sentences", "chapter", "page", "sent_idx", "text", where="text is not null")
    made = stream.restreamed(rows, ["vol", "chapter"], ["page", "sent_idx", "id"], "text")
    return made.withColumn("ids", F.array_join("ids", ","))


@query(f"""
WITH $ONCE, {_CLEAN}, f AS (SELECT vol, id, t0, {_CLEANED} AS clean FROM (SELECT a.vol, a.id, a.t{_N}, x.t0 FROM c{_N - 1} a JOIN c x USING (vol, id))),
k AS (SELECT *, NOT regexp_matches(clean, '[A-Za-zÀ-ỹ]') OR regexp_matches(clean, '{T.DANGLING_FOLIO}') AS junk FROM f)
SELECT vol, count(*) AS rows_in, count(*) FILTER (NOT junk) AS rows_out, count(*) FILTER (NOT junk AND clean <> t0) AS rows_changed, count(*) FILTER (junk) AS rows_dropped FROM k GROUP BY vol""")
def cleaning_report(s: SparkSession, d: str) -> DataFrame:
    """Rows in, out, changed and dropped by the cleaning of each volume."""
    rows = corpus_rows(s, d, "vi_sentences", "text", where="text is not null").withColumn("clean", T.cleaned(F.col("text"))[0])
    judged = rows.withColumn("junk", T.is_junk(F.col("clean")))
    return judged.groupBy("vol").agg(
        F.count("*").alias("rows_in"), F.count_if(~F.col("junk")).alias("rows_out"), F.count_if(~F.col("junk") & (F.col("clean") != F.col("text"))).alias("rows_changed"), F.count_if("junk").alias("rows_dropped")
    )


@query(f"""
WITH $ONCE, {_VOCAB}, t AS (SELECT vol, id, unnest(regexp_extract_all(lower(text), '[$VI]+')) AS token FROM v WHERE n_tokens IS NULL OR oov_rate IS NULL),
n AS (SELECT vol, id, count(*) AS n, count(*) FILTER (voc.token IS NULL) AS k FROM t LEFT JOIN voc USING (token) GROUP BY ALL),
x AS (SELECT v.vol, v.id, coalesce(n_tokens, n.n, 0) AS n, coalesce(oov_rate, round(CASE WHEN n.n > 0 THEN n.k / n.n ELSE 0.0 END, 3), 0.0) AS r FROM v LEFT JOIN n USING (vol, id))
SELECT vol, id, CAST(n AS BIGINT) AS n_tokens, r AS oov_rate FROM x WHERE n >= 4 AND r >= 0.2""")
def unknown_rows(s: SparkSession, d: str) -> DataFrame:
    """Rows with many unknown tokens by their stored figures, counted anew where those are missing."""
    rows = corpus_rows(s, d, "vi_sentences", "text", "n_tokens", "oov_rate")
    missing = rows.where("n_tokens is null or oov_rate is null")
    counted = lexicon.oov_rates(missing, ["vol", "id"], T.vi_tokens(F.col("text")), _vocabulary(s, d)).select("vol", "id", F.col("n_tokens").alias("n"), F.col("oov_rate").alias("r"))
    met = rows.join(counted, ["vol", "id"], "left")
    told = met.select("vol", "id", F.coalesce(F.col("n_tokens").cast("bigint"), "n").alias("n_tokens"), F.coalesce("oov_rate", "r").alias("oov_rate"))
    return told.where("n_tokens >= 4 AND oov_rate >= 0.2")


@query(f"SELECT rule, n FROM (WITH $ONCE, {_CLEAN} " + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n FROM c{_N - 1} WHERE f{k}" for k, (n, *_) in enumerate(T.CLEANING)) + ") WHERE n > 0 ORDER BY n DESC, rule")
def rules_by_hits(s: SparkSession, d: str) -> DataFrame:
    """The cleaning rules, the most used first."""
    fired = corpus_rows(s, d, "vi_sentences", "text", where="text is not null").withColumn("fired", T.cleaned(F.col("text"))[1])
    return metrics.rule_hits(fired, "fired").orderBy(F.desc("n"), "rule")


# ---------------------------------------------------------------- boxes and readers


@query("""WITH $ONCE SELECT vol, id, bbox[1] AS x0, bbox[2] AS y0, bbox[3] AS x1, bbox[4] AS y1, 1600 - 1 - bbox[4] AS tx0, bbox[1] AS ty0, 1600 - 1 - bbox[2] AS tx1, bbox[3] AS ty1 FROM b WHERE len(bbox) = 4""")
def turned_boxes(s: SparkSession, d: str) -> DataFrame:
    """Each box from its corners, and turned back as if read on a page of 1600 pixels lying on its side."""
    boxes = corpus_rows(s, d, "han_boxes", "bbox", where=F.size("bbox") == 4)
    c = F.col("bbox")
    corners = F.array(F.array(c[0], c[1]), F.array(c[2], c[1]), F.array(c[2], c[3]), F.array(c[0], c[3]))
    made = boxes.select("vol", "id", layout.polygon_box(corners).alias("p"), layout.unrotated_box(c, F.lit(1600)).alias("t"))
    return made.select("vol", "id", *(F.col("p")[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))), *(F.col("t")[k].alias(f"t{n}") for k, n in enumerate(("x0", "y0", "x1", "y1"))))


_GATE = "(conf IS NULL OR conf < 0.9) AND NOT coalesce(is_dbl, false)"


@query(f"""WITH $ONCE SELECT vol, id, CASE WHEN {_GATE} THEN translate(sinonom, '{"".join(p[0] for p in _FORMS.split())}', '{"".join(p[1] for p in _FORMS.split())}') ELSE sinonom END AS reading FROM b WHERE sinonom IS NOT NULL""")
def gated_consensus(s: SparkSession, d: str) -> DataFrame:
    """Only columns that the gate lets through have a second reading; the others stand as they are."""
    rows = corpus_rows(s, d, "han_boxes", "sinonom", "conf", "is_dbl", where="sinonom is not null")
    second = F.when(F.expr(_GATE), sequences.mapped_characters(F.col("sinonom"), _FORMS)[0])
    return consensus.consensus(rows.withColumn("second", second), "sinonom", "second").select("vol", "id", "reading")


@query("""WITH $ONCE SELECT vol, id, round(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / octet_length(encode(text)), 6) AS share FROM v WHERE text <> ''""")
def ink_shares(s: SparkSession, d: str) -> DataFrame:
    """The share of dark bytes, here of the bytes of a text."""
    rows = corpus_rows(s, d, "vi_sentences", "text", where="text <> ''")
    return rows.select("vol", "id", F.round(files.ink_share(F.encode("text", "UTF-8")), 6).alias("share"))


# ---------------------------------------------------------------- formats of others, written as they write them and read


def _folder(s: SparkSession) -> str:
    return f"{checkpoint_dir(s)}/files-{uuid.uuid4()}"


def _toned(text: str) -> str:
    for a, b in T.TONE_PLACES:
        text = f"replace({text}, '{a}', '{b}')"
    return text


@query(f"SELECT sinonom_char AS char, {_toned('lower(trim(min(am_han_viet)))')} AS readings FROM hanviet WHERE am_han_viet <> '' AND sinonom_char IS NOT NULL GROUP BY 1")
def code_point_readings(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    rows = table(s, d, "hanviet").where("am_han_viet <> '' and sinonom_char is not null").groupBy("sinonom_char").agg(F.min("am_han_viet").alias("r"))
    line = F.concat(F.lit("U+"), F.hex(F.ascii("sinonom_char")), F.lit("\tkVietnamese\t"), F.col("r"))
    other = F.concat(F.lit("U+"), F.hex(F.ascii("sinonom_char")), F.lit("\tkOther\tx"))
    rows.select(F.explode(F.array(F.lit("# a comment"), line, other)).alias("value")).write.text(path)
    return files.unihan_readings(s, path).withColumn("readings", F.array_join("readings", " "))


@query(f"SELECT sinonom_char AS char, {_toned('lower(trim(min(am_han_viet)))')} AS readings FROM hanviet WHERE am_han_viet <> '' AND sinonom_char IS NOT NULL GROUP BY 1")
def bank_readings(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    rows = table(s, d, "hanviet").where("am_han_viet <> '' and sinonom_char is not null").groupBy("sinonom_char").agg(F.min("am_han_viet").alias("r"))
    empty = F.array("sinonom_char", F.lit(""), F.lit(""))
    entries = rows.select(F.array(empty, F.array("sinonom_char", F.lit(""), F.upper("r")), F.array("sinonom_char", F.lit("later"), F.lit("x"))).alias("e"))
    entries.agg(F.to_json(F.flatten(F.collect_list("e"))).alias("value")).coalesce(1).write.text(path)
    return files.kanji_readings(s, f"{path}/*.txt").withColumn("readings", F.array_join("readings", " "))


@query("SELECT lower(trim(r)) AS key, string_agg(DISTINCT c, ' ' ORDER BY c) AS values FROM (SELECT sinonom_char AS c, unnest(string_split(all_readings, ' ')) AS r FROM hanviet WHERE sinonom_char IS NOT NULL) WHERE trim(r) <> '' GROUP BY 1")
def listed_readings(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    rows = table(s, d, "hanviet").where("sinonom_char is not null and all_readings <> ''")
    shown = F.concat(F.lit("['"), F.array_join(F.split("all_readings", " "), "', '"), F.lit("']"))
    rows.select(F.col("sinonom_char").alias("char"), shown.alias("hanviet")).write.option("header", True).csv(path)
    return files.listed_readings(s, path).withColumn("values", F.array_join("values", " "))


@query("""WITH g AS (SELECT am_han_viet AS r, list(DISTINCT sinonom_char) AS cs FROM hanviet WHERE am_han_viet IS NOT NULL AND sinonom_char IS NOT NULL GROUP BY 1),
w AS (SELECT DISTINCT sinonom_char AS char, unnest(cs) AS v FROM hanviet JOIN g ON am_han_viet = r WHERE sinonom_char IS NOT NULL),
t AS (SELECT v AS char, list(DISTINCT key ORDER BY key) AS rs FROM (SELECT key, unnest(values) AS v FROM s2_readings WHERE key IS NOT NULL) GROUP BY v)
SELECT w.char, arg_min(t.rs[1], w.v) AS reading FROM w JOIN t ON t.char = w.v WHERE w.v <> w.char GROUP BY w.char""")
def borrowed_readings(s: SparkSession, d: str) -> DataFrame:
    """A reading for each character from the first other one that sounds like it and is in the word table."""
    hv = table(s, d, "hanviet").where("sinonom_char is not null and am_han_viet is not null").select(F.col("sinonom_char").alias("char"), F.col("am_han_viet").alias("r")).distinct()
    variants = hv.join(hv.withColumnRenamed("char", "v"), "r").where("v <> char").groupBy("char").agg(F.collect_set("v").alias("variants"))
    taught = lexicon.inverted(table(s, d, "s2_readings"), "key", "values", "char", "readings")
    return lexicon.variant_reading(variants, [taught])


@query("""SELECT value, string_agg(key, ' ' ORDER BY n DESC, key) AS keys FROM (SELECT DISTINCT value, key, n FROM (SELECT key, length(key) AS n, unnest(values) AS value FROM s2_readings WHERE key IS NOT NULL)) WHERE value IS NOT NULL GROUP BY value""")
def ordered_inversion(s: SparkSession, d: str) -> DataFrame:
    """Every word with its readings, the longest first."""
    rows = table(s, d, "s2_readings").withColumn("o", F.struct((-F.length("key")).alias("n"), "key"))
    return lexicon.inverted_in_order(rows, "key", "values", "o").withColumn("keys", F.array_join("keys", " "))
