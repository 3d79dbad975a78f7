"""The corpus queries over the given tables, each with the ANSI SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkweave.functions import text as T
from inkweave.operators import furniture, layout, lexicon, metrics, pages, patching, sequences, stream, vectors
from inkweave.plans.registry import CJK_SQL as _CJK_SQL
from inkweave.plans.registry import query
from inkweave.sources.tables import corpus_rows, spread, table

_VI = T.VI_LETTERS


def _vocabulary(s: SparkSession, d: str) -> DataFrame:
    """Known syllables: the words of s2_readings and the readings of hanviet."""
    words = table(s, d, "s2_readings").select(F.explode(T.vi_tokens(F.col("key"))).alias("token"))
    return words.union(table(s, d, "hanviet").select(F.explode(T.vi_tokens(F.col("all_readings"))))).distinct()


_VOCAB = """
voc AS (SELECT DISTINCT unnest(regexp_extract_all(lower(k), '[$VI]+')) AS token
        FROM (SELECT key AS k FROM s2_readings UNION ALL SELECT all_readings FROM hanviet))"""

# ---------------------------------------------------------------- tokens and vocabulary


@query(f"""
WITH $ONCE, {_VOCAB},
t AS (SELECT vol || '/' || id AS id, unnest(list_distinct(regexp_extract_all(lower(text), '[$VI]+'))) AS token FROM v)
SELECT token, count(*) AS count, min(id) AS example_id FROM t WHERE token NOT IN (SELECT token FROM voc) GROUP BY token""")
def oov_vocabulary(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "text").withColumn("key", F.concat_ws("/", "vol", "id"))
    return lexicon.oov_vocabulary(rows, T.vi_tokens(F.col("text")), _vocabulary(s, d), "key")


@query(f"""
WITH $ONCE, {_VOCAB},
t AS (SELECT vol, id, unnest(regexp_extract_all(lower(text), '[$VI]+')) AS token FROM v),
n AS (SELECT vol, id, count(*) AS n, count(*) FILTER (voc.token IS NULL) AS k FROM t LEFT JOIN voc USING (token) GROUP BY ALL)
SELECT v.vol, v.id, coalesce(n.n, 0) AS n_tokens, round(CASE WHEN n.n > 0 THEN n.k / n.n ELSE 0.0 END, 3) AS oov_rate FROM v LEFT JOIN n USING (vol, id)""")
def oov_rates(s: SparkSession, d: str) -> DataFrame:
    return lexicon.oov_rates(corpus_rows(s, d, "vi_sentences", "text"), ["vol", "id"], T.vi_tokens(F.col("text")), _vocabulary(s, d))


@query("""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[$VI]+') AS ts, 0.0 AS ink FROM documents),
m AS (SELECT doc_id, ink, CAST(len(ts) AS INTEGER) AS tokens,
  round(CASE WHEN len(ts) > 0 THEN len(list_filter(ts, lambda x: regexp_matches(x, '[$MARKED]'))) / len(ts) ELSE 0.0 END, 3) AS diac_ratio FROM t)
SELECT doc_id, tokens, diac_ratio,
  CASE WHEN tokens < 10 THEN CASE WHEN ink >= 0.02 THEN 'PLATE' ELSE 'BLANK' END WHEN diac_ratio >= 0.65 THEN 'VI' ELSE 'HAN' END AS label
FROM m""")
def page_classes(s: SparkSession, d: str) -> DataFrame:
    docs = spread(table(s, d, "documents")).select("doc_id", "text", F.lit(0.0).alias("ink"))
    return pages.classified_pages(docs, "text", "ink").select("doc_id", "tokens", "diac_ratio", "label")


# ---------------------------------------------------------------- cleaning and sentences

# The same rules without looking around: what stands beside a match is matched and put back, and a rule whose
# matches may share such a sign is applied twice.
_BESIDE, _BEHIND = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def _as_sql(pattern: str, to: str) -> tuple[str, str]:
    if pattern.startswith("(?<=\\s)"):
        return r"(\s)[*•](\s|$)", r"\1 \2"
    if pattern.endswith("(?=[A-Za-zÀ-ỹ«])"):
        return r"^\s*[0-9]{1,3}\s+([A-Za-zÀ-ỹ«])", r"\1"
    if pattern.startswith("(?:" + T._AT):
        return pattern.replace(T._AT, r"\b").removesuffix(T._END) + _BEHIND, to + r"\1"
    if pattern.startswith(T._AT):
        return _BESIDE + pattern.removeprefix(T._AT).removesuffix(T._END) + _BEHIND, r"\1" + to + r"\2"
    return pattern, to


def _rule_sql(text: str, pattern: str, to: str) -> str:
    p, t = _as_sql(pattern, to)
    once = f"regexp_replace({text}, '{p}', '{t}', 'g')"
    return f"regexp_replace({once}, '{p}', '{t}', 'g')" if p != pattern else once


_STEPS = ", ".join(
    f"c{k} AS (SELECT vol, id, t{k}, {_rule_sql(f't{k}', p, to)} AS t{k + 1}{''.join(f', f{j}' for j in range(k))}, t{k} <> {_rule_sql(f't{k}', p, to)} AS f{k} FROM {'c' + str(k - 1) if k else 'c'})"
    for k, (_, p, to) in enumerate(T.CLEANING)
)
_N = len(T.CLEANING)
_CLEAN = f"c AS (SELECT vol, id, text AS t0 FROM v WHERE text IS NOT NULL), {_STEPS}"


def _cleaned(s: SparkSession, d: str) -> DataFrame:
    text, fired = T.cleaned(F.col("text"))
    return corpus_rows(s, d, "vi_sentences", "text", where="text is not null").select("vol", "id", "text", text.alias("clean"), fired.alias("fired"))


@query(f"""
WITH $ONCE, {_CLEAN}
SELECT vol, id, trim(regexp_replace(regexp_replace(t{_N}, '\\s{{2,}}', ' ', 'g'), '{T.SPACE_BEFORE_MARK}', '\\1', 'g'), ' ') AS clean FROM c{_N - 1}""")
def cleaned_text(s: SparkSession, d: str) -> DataFrame:
    return _cleaned(s, d).select("vol", "id", "clean")


@query(f"WITH $ONCE, {_CLEAN} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n FROM c{_N - 1} WHERE f{k}" for k, (n, *_) in enumerate(T.CLEANING)) + ") WHERE n > 0")
def cleaning_hits(s: SparkSession, d: str) -> DataFrame:
    return metrics.rule_hits(_cleaned(s, d), "fired")


@query(rf"""
WITH $ONCE SELECT vol, id FROM v WHERE text IS NOT NULL AND (NOT regexp_matches(text, '[A-Za-zÀ-ỹ]') OR regexp_matches(text, '{T.DANGLING_FOLIO}'))""")
def junk_rows(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "vi_sentences", where=T.is_junk(F.col("text")))


@query(f"""
WITH $ONCE, {_VOCAB}, t AS (SELECT vol, id, unnest(regexp_extract_all(lower(text), '[$VI]+')) AS token FROM v),
n AS (SELECT vol, id, count(*) AS n, count(*) FILTER (token IN (SELECT token FROM voc)) AS k FROM t GROUP BY ALL)
SELECT vol, id, n, round(k / n, 3) AS known FROM n WHERE n >= 2 AND k / n >= 0.5""")
def known_rows(s: SparkSession, d: str) -> DataFrame:
    return lexicon.known_rows(corpus_rows(s, d, "vi_sentences", "text"), ["vol", "id"], T.vi_tokens(F.col("text")), _vocabulary(s, d))


_BLOCK = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '-\s*\n\s*', '', 'g'), '\s*\n\s*', ' ', 'g'), '[ \t]{2,}', ' ', 'g'), ' ')"


@query(rf"""
WITH $ONCE, n AS (SELECT vol, id, {_BLOCK} AS t FROM v WHERE text IS NOT NULL),
s AS (SELECT vol, id, list_filter(list_transform(string_split(regexp_replace(t, '{T.SENTENCE_END}', E'\\1\x01\\2', 'g'), E'\x01'), lambda x: trim(x, ' ')), lambda x: x <> '') AS ss FROM n)
SELECT vol, id, CAST(unnest(range(1, len(ss) + 1)) AS INTEGER) AS sent_no, unnest(ss) AS sentence FROM s""")
def plain_sentences(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "text", where="text is not null")
    split = rows.select("vol", "id", F.posexplode(T.sentences(T.normal_block(F.col("text")))).alias("k", "sentence"))
    return split.select("vol", "id", (F.col("k") + 1).alias("sent_no"), "sentence")


@query(r"""
WITH m AS (SELECT vol, pair_idx, list_distinct(regexp_extract_all(lower(coalesce(am_han_viet, '')), '[$VI]+')) AS a,
  list_distinct(regexp_extract_all(lower(coalesce(vietnamese, '')), '[$VI]+')) AS b FROM alignment)
SELECT vol, pair_idx, CASE WHEN len(a) > 0 AND len(b) > 0 THEN round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 3) ELSE 0.0 END AS lexical FROM m""")
def lexical_similarity(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "alignment").select("vol", "pair_idx", T.lexical_similarity(F.col("am_han_viet"), F.col("vietnamese")).alias("lexical"))


# ---------------------------------------------------------------- streams of rows

_OFFSETS = """
o AS (SELECT vol, chapter, page, id, text, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY vol, chapter ORDER BY page, sent_idx, id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_at FROM v WHERE text IS NOT NULL)"""


def _offsets(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "chapter", "page", "sent_idx", "text", where="text is not null")
    return stream.with_offsets(rows, ["vol", "chapter"], ["page", "sent_idx", "id"], F.length("text"))


@query(f"WITH $ONCE, {_OFFSETS} SELECT vol, id, start_at, start_at + length(text) AS end_at FROM o")
def stream_offsets(s: SparkSession, d: str) -> DataFrame:
    return _offsets(s, d).select("vol", "id", "start_at", "end_at")


@query(f"""
WITH $ONCE, {_OFFSETS}, e AS (SELECT vol, chapter, max(start_at + length(text)) AS last FROM o GROUP BY ALL),
m AS (SELECT vol, chapter, CAST(unnest(range(0, last, 200)) AS BIGINT) AS at FROM e),
r AS (SELECT vol, chapter, start_at, max(page) AS page FROM o GROUP BY ALL)
SELECT m.vol, m.chapter, m.at, r.page FROM m ASOF JOIN r ON m.vol = r.vol AND m.chapter = r.chapter AND m.at >= r.start_at""")
def page_at(s: SparkSession, d: str) -> DataFrame:
    rows = _offsets(s, d)
    ends = rows.groupBy("vol", "chapter").agg(F.max("end_at").alias("last")).where("last > 0")
    marks = ends.select("vol", "chapter", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last") - 1, F.lit(200).cast("bigint"))).alias("at"))
    return stream.as_of(marks, rows.select("vol", "chapter", "start_at", "page"), ["vol", "chapter"], "at", "start_at", "page")


_SPANS = r"""
hb AS (SELECT vol, chapter, id, CAST(coalesce(sum(n) OVER w, 0) AS BIGINT) AS s, n FROM
  (SELECT *, length(regexp_replace(coalesce(sinonom, ''), '[^\x{4E00}-\x{9FFF}]', '', 'g')) AS n FROM b WHERE NOT is_dbl)
  WINDOW w AS (PARTITION BY vol, chapter ORDER BY page, box_idx, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
hs AS (SELECT vol, chapter, id, CAST(coalesce(sum(n) OVER w, 0) AS BIGINT) AS s, n FROM
  (SELECT *, length(regexp_replace(sinonom, '[^\x{4E00}-\x{9FFF}]', '', 'g')) AS n FROM h WHERE NOT is_dbl)
  WINDOW w AS (PARTITION BY vol, chapter ORDER BY page, sent_idx, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _spans(s: SparkSession, d: str, name: str, idx: str) -> DataFrame:
    n = F.length(F.regexp_replace(F.coalesce("sinonom", F.lit("")), r"[^\x{4E00}-\x{9FFF}]", ""))
    rows = corpus_rows(s, d, name, "chapter", "page", idx, "sinonom", where="NOT is_dbl")
    return stream.with_offsets(rows, ["vol", "chapter"], ["page", idx, "id"], n, separator=0).select("vol", "chapter", "id", "start_at", "end_at")


@query(f"""
WITH $ONCE, {_SPANS}
SELECT hs.vol, hs.id AS sentence_id, hb.id AS box_id FROM hs JOIN hb ON hs.vol = hb.vol AND hs.chapter = hb.chapter
  AND hs.n > 0 AND hb.n > 0 AND hs.s < hb.s + hb.n AND hb.s < hs.s + hs.n""")
def box_overlaps(s: SparkSession, d: str) -> DataFrame:
    sent = _spans(s, d, "han_sentences", "sent_idx").toDF("vol", "chapter", "sentence_id", "s0", "s1")
    box = _spans(s, d, "han_boxes", "box_idx").toDF("vol", "chapter", "box_id", "b0", "b1")
    return stream.overlaps(sent, box, ["vol", "chapter"], "s0", "s1", "b0", "b1").select("vol", "sentence_id", "box_id")


@query(f"""
WITH $ONCE,
c AS (SELECT vol, chapter, page, sent_idx, id, unnest(string_split(sinonom, '')) AS ch, unnest(range(length(sinonom))) AS k FROM h WHERE NOT is_dbl AND sinonom <> ''),
n AS (SELECT *, row_number() OVER w AS n, coalesce(sum(CASE WHEN contains('{T.FINAL_MARKS}', ch) THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM c WINDOW w AS (PARTITION BY vol, chapter ORDER BY page, sent_idx, id, k)),
f AS (SELECT * FROM n WHERE NOT contains('{T.MARKS}', ch)),
i AS (SELECT vol, chapter, seg, string_agg(id, ',' ORDER BY k) AS sources FROM (SELECT vol, chapter, seg, id, min(n) AS k FROM f GROUP BY ALL) GROUP BY ALL),
g AS (SELECT vol, chapter, seg, string_agg(ch, '' ORDER BY n) AS segment, min(n) AS first FROM f GROUP BY ALL)
SELECT vol, chapter, CAST(row_number() OVER (PARTITION BY vol, chapter ORDER BY first) AS INTEGER) AS seg_no, segment, sources FROM g JOIN i USING (vol, chapter, seg)""")
def resegmented(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "han_sentences", "chapter", "page", "sent_idx", "sinonom", where="NOT is_dbl")
    cut = stream.resegmented(rows, ["vol", "chapter"], ["page", "sent_idx", "id"], "sinonom", "id", T.FINAL_MARKS, T.MARKS)
    return cut.select("vol", "chapter", "seg_no", "segment", F.array_join("source_ids", ",").alias("sources"))


@query(r"""
WITH x AS (SELECT doc_id, CAST(n_chars AS INTEGER) AS n FROM documents WHERE n_chars > 0),
w AS (SELECT doc_id, n, CAST(unnest(range(0, greatest(CAST(ceil((n - 32) / 428.0) AS INTEGER), 1))) AS INTEGER) AS win_no FROM x)
SELECT doc_id, win_no, win_no * 428 AS win_start, least(win_no * 428 + 460, n) AS win_end, CASE WHEN win_no = 0 THEN 0 ELSE win_no * 428 + 32 END AS trusted_from FROM w""")
def model_windows(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", F.col("n_chars").cast("int").alias("n"))
    return pages.windows_of(docs.where("n > 0"), F.col("n")).drop("n")


@query("""
WITH $ONCE SELECT vol, id, page, CAST(row_number() OVER (PARTITION BY vol, chapter, page ORDER BY sent_idx, id) AS INTEGER) AS ordinal,
  printf('HVH_001.%03d.%03d.%02d', chapter, page, CAST(row_number() OVER (PARTITION BY vol, chapter, page ORDER BY sent_idx, id) AS INTEGER)) AS new_id
FROM v WHERE text IS NOT NULL AND regexp_matches(text, '[A-Za-zÀ-ỹ]')""")
def renumbered(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "chapter", "page", "sent_idx", "text", where=F.col("text").rlike("[A-Za-zÀ-ỹ]"))
    return pages.numbered(rows, ["vol", "chapter", "page"], ["sent_idx", "id"]).select(
        "vol", "id", "page", "ordinal", T.make_id(F.col("chapter"), F.col("page"), F.col("ordinal")).alias("new_id")
    )


# ---------------------------------------------------------------- lexicons


@query(r"""
WITH $ONCE, lex AS (SELECT sinonom_char AS c, min(am_han_viet) AS r FROM hanviet WHERE sinonom_char IS NOT NULL AND am_han_viet IS NOT NULL GROUP BY 1),
c AS (SELECT vol, id, unnest(chars) AS c, unnest(range(len(chars))) AS k
  FROM (SELECT vol, id, regexp_extract_all(sinonom, '[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2EBEF}\x{2F800}-\x{2FA1F}]') AS chars FROM h)),
j AS (SELECT vol, id, string_agg(coalesce(lex.r, '?'), ' ' ORDER BY k) AS readings FROM c LEFT JOIN lex USING (c) GROUP BY vol, id)
SELECT h.vol, h.id, coalesce(j.readings, '') AS readings FROM h LEFT JOIN j USING (vol, id)""")
def transliterated(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "han_sentences", "sinonom")
    return lexicon.transliterated(rows, ["vol", "id"], "sinonom", table(s, d, "hanviet"), "sinonom_char", "am_han_viet")


@query("SELECT value, list_sort(list(DISTINCT key)) AS keys FROM (SELECT key, unnest(values) AS value FROM s2_readings WHERE key IS NOT NULL) WHERE value IS NOT NULL GROUP BY value")
def inverted_words(s: SparkSession, d: str) -> DataFrame:
    return lexicon.inverted(table(s, d, "s2_readings"), "key", "values")


@query("""
WITH r AS (SELECT 0 AS rank, 'table' AS source, sinonom_char AS key, am_han_viet AS value FROM hanviet
  UNION ALL SELECT 1, 'words', v, key FROM (SELECT key, unnest(values) AS v FROM s2_readings)
  UNION ALL SELECT 2, 'all', sinonom_char, unnest(string_split(all_readings, ' ')) FROM hanviet),
d AS (SELECT DISTINCT * FROM r WHERE key IS NOT NULL AND value IS NOT NULL AND value <> ''),
m AS (SELECT key, min(rank) AS rank FROM d GROUP BY key),
t AS (SELECT d.key, d.rank, min(d.value) AS value FROM d JOIN m ON d.key = m.key AND d.rank = m.rank GROUP BY d.key, d.rank)
SELECT t.key, t.value, CASE t.rank WHEN 0 THEN 'table' WHEN 1 THEN 'words' ELSE 'all' END AS source,
  (SELECT string_agg(value, '|' ORDER BY r, value) FROM (SELECT value, min(rank) AS r FROM d WHERE d.key = t.key GROUP BY value)) AS readings FROM t""")
def merged_readings(s: SparkSession, d: str) -> DataFrame:
    hv, s2 = table(s, d, "hanviet"), table(s, d, "s2_readings")
    words = s2.select("key", F.explode("values").alias("v")).select(F.col("v").alias("k"), F.col("key").alias("r"))
    every = hv.select(F.col("sinonom_char").alias("k"), F.explode(F.split("all_readings", " ")).alias("r"))
    merged = lexicon.merged_by_priority([("table", hv.select(F.col("sinonom_char").alias("k"), F.col("am_han_viet").alias("r"))), ("words", words), ("all", every)], "k", "r")
    return merged.select("key", "value", "source", F.array_join("all_values", "|").alias("readings"))


@query("SELECT source, count(*) AS n FROM (SELECT CASE WHEN am_han_viet IS NOT NULL THEN 'primary' WHEN all_readings IS NOT NULL THEN 'other' ELSE 'none' END AS source FROM hanviet) GROUP BY source")
def reading_sources(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("am_han_viet").isNotNull(), "primary").when(F.col("all_readings").isNotNull(), "other").otherwise("none")
    return table(s, d, "hanviet").groupBy(kind.alias("source")).agg(F.count("*").alias("n"))


def _similar(s: SparkSession, d: str) -> DataFrame:
    """key, values: the characters that share a reading."""
    hv = table(s, d, "hanviet").where("sinonom_char is not null")
    groups = hv.where("am_han_viet is not null").groupBy("am_han_viet").agg(F.sort_array(F.collect_list("sinonom_char")).alias("values"))
    return hv.join(groups, "am_han_viet").groupBy(F.col("sinonom_char").alias("key")).agg(F.min("values").alias("values"))


@query("""
WITH alike AS (SELECT am_han_viet AS r, list(sinonom_char ORDER BY sinonom_char) AS cs FROM hanviet WHERE am_han_viet IS NOT NULL AND sinonom_char IS NOT NULL GROUP BY 1),
s1 AS (SELECT sinonom_char AS sn, min(cs) AS s1 FROM hanviet JOIN alike ON am_han_viet = r GROUP BY 1),
s2 AS (SELECT lower(trim(key)) AS q, flatten(list(values)) AS s2 FROM s2_readings GROUP BY 1),
p AS (SELECT DISTINCT sinonom_char AS sn, unnest(string_split(coalesce(all_readings, am_han_viet), ' ')) AS qn FROM hanviet WHERE sinonom_char IS NOT NULL),
m AS (SELECT sn, qn, coalesce(s2, []) AS s2, coalesce(s1, [sn]) AS s1 FROM p LEFT JOIN s2 ON lower(trim(qn)) = q LEFT JOIN s1 USING (sn)),
f AS (SELECT *, list_filter(s1, lambda c: list_contains(s2, c)) AS hit FROM m)
SELECT sn, qn, CASE WHEN list_contains(s2, sn) THEN 'BLACK' WHEN len(hit) > 0 THEN 'GREEN' ELSE 'RED' END AS status,
  CASE WHEN NOT list_contains(s2, sn) AND len(hit) > 0 THEN hit[1] END AS corrected FROM f""")
def validated_pairs(s: SparkSession, d: str) -> DataFrame:
    hv = table(s, d, "hanviet").where("sinonom_char is not null")
    pairs = hv.select(F.col("sinonom_char").alias("sn"), F.explode(F.split(F.coalesce("all_readings", "am_han_viet"), " ")).alias("qn")).distinct()
    return lexicon.validated_pairs(pairs, _similar(s, d), table(s, d, "s2_readings")).select("sn", "qn", "status", "corrected")


# ---------------------------------------------------------------- boxes

_WHOLE = "len(bbox) = 4"


@query(f"""
WITH $ONCE SELECT vol, id, CASE WHEN {_WHOLE} THEN (bbox[1] + bbox[3]) / 2 END AS cx, CASE WHEN {_WHOLE} THEN (bbox[2] + bbox[4]) / 2 END AS cy,
  CASE WHEN {_WHOLE} THEN bbox[3] - bbox[1] END AS bw, CASE WHEN {_WHOLE} THEN bbox[4] - bbox[2] END AS bh,
  CASE WHEN {_WHOLE} THEN CAST(bbox[3] - bbox[1] AS BIGINT) * (bbox[4] - bbox[2]) END AS area FROM b""")
def box_geometry(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "han_boxes", "bbox").select("vol", "id", *(c.alias(k) for k, c in layout.geometry(F.col("bbox")).items()))


@query(f"""
WITH $ONCE, a AS (SELECT vol, page, id, CAST(bbox[3] - bbox[1] AS BIGINT) * (bbox[4] - bbox[2]) AS area FROM b),
m AS (SELECT vol, page, median(area) AS med FROM a GROUP BY ALL)
SELECT a.vol, a.id FROM a JOIN m USING (vol, page) WHERE area IS NULL OR area >= 0.06 * med""")
def sized_boxes(s: SparkSession, d: str) -> DataFrame:
    return layout.without_tiny(corpus_rows(s, d, "han_boxes", "page", "bbox"), ["vol", "page"]).select("vol", "id")


@query("""
WITH $ONCE, x AS (SELECT vol, bbox[3] AS x1 FROM b WHERE len(bbox) = 4 AND bbox[3] IS NOT NULL),
r AS (SELECT vol, x1, row_number() OVER (PARTITION BY vol ORDER BY x1) - 1 AS k, count(*) OVER (PARTITION BY vol) AS n FROM x)
SELECT vol, n, x1 AS ranked FROM r WHERE k = least(n - 1, (n * 95) // 100)""")
def right_edges(s: SparkSession, d: str) -> DataFrame:
    boxes = corpus_rows(s, d, "han_boxes", "bbox").select("vol", F.when(F.size("bbox") == 4, F.col("bbox")[2]).alias("x1"))
    return metrics.rank_value(boxes, ["vol"], "x1", 0.95)


_TITLE, _FOLD = "瑞康政要卷之第葉", "瑞康政要卷之第葉一二三四五六七八九十百"


@query(f"""
WITH $ONCE, x AS (SELECT vol, bbox[3] AS x1 FROM b WHERE len(bbox) = 4 AND bbox[3] IS NOT NULL),
r AS (SELECT vol, x1, row_number() OVER (PARTITION BY vol ORDER BY x1) - 1 AS k, count(*) OVER (PARTITION BY vol) AS n FROM x),
e AS (SELECT vol, x1 AS w FROM r WHERE k = least(n - 1, (n * 95) // 100)),
m AS (SELECT b.vol, b.id, coalesce(sinonom, '') AS t, coalesce(conf, 1.0) AS c, CASE WHEN len(bbox) = 4 THEN bbox[1] END AS x, w,
  CASE WHEN length(coalesce(sinonom, '')) > 0 THEN (length(sinonom) - length(regexp_replace(sinonom, '[{_TITLE}]', '', 'g'))) / length(sinonom) ELSE 0.0 END AS tr,
  CASE WHEN length(coalesce(sinonom, '')) > 0 THEN (length(sinonom) - length(regexp_replace(sinonom, '[{_FOLD}]', '', 'g'))) / length(sinonom) ELSE 0.0 END AS fr
  FROM b LEFT JOIN e USING (vol))
SELECT vol, id, coalesce(NOT (length(t) = 0 OR length(t) > 12 OR regexp_matches(t, '{furniture.ERA_YEAR}'))
  AND ((x <= w * CASE WHEN length(t) = 1 THEN 0.10 ELSE 0.15 END AND tr >= 0.6) OR (x >= w * 0.97 AND (fr >= 0.6 OR c < 0.75)) OR (x >= w * 0.9 AND fr >= 0.6 AND c < 0.75)), false) AS dropped
FROM m""")
def edge_boxes(s: SparkSession, d: str) -> DataFrame:
    boxes = corpus_rows(s, d, "han_boxes", "bbox", "sinonom", "conf")
    return furniture.edge_boxes(boxes, "vol", _TITLE, _FOLD).select("vol", "id", "dropped")


# ---------------------------------------------------------------- review and figures


@query("""
WITH $ONCE SELECT 'han' AS side, 'box' AS level, vol, id, conf AS score FROM b WHERE conf < 0.5
UNION ALL SELECT 'vi', 'high_oov', vol, id, oov_rate FROM v WHERE n_tokens >= 4 AND oov_rate >= 0.2""")
def review_queue(s: SparkSession, d: str) -> DataFrame:
    han = corpus_rows(s, d, "han_boxes", "conf", where="conf < 0.5").select(F.lit("han").alias("side"), F.lit("box").alias("level"), "vol", "id", F.col("conf").alias("score"))
    vi = corpus_rows(s, d, "vi_sentences", "n_tokens", "oov_rate", where="n_tokens >= 4 AND oov_rate >= 0.2")
    return han.unionByName(vi.select(F.lit("vi").alias("side"), F.lit("high_oov").alias("level"), "vol", "id", F.col("oov_rate").alias("score")))


@query("WITH $ONCE SELECT vol, id FROM b WHERE (conf IS NULL OR conf < 0.9) AND NOT coalesce(is_dbl, false)")
def second_reading_gate(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "han_boxes", where="(conf IS NULL OR conf < 0.9) AND NOT coalesce(is_dbl, false)")


def _histogram_sql(source: str, value: str, edges: list[float]) -> str:
    bins = ", ".join(f"({k}, {a}, {b})" for k, (a, b) in enumerate(zip(edges, edges[1:])))
    return f"""
WITH $ONCE, e(bin, lo, hi) AS (VALUES {bins})
SELECT CAST(e.bin AS INTEGER) AS bin, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count(x.v) AS n
FROM e LEFT JOIN (SELECT {value} AS v FROM {source}) x ON x.v >= lo AND (x.v < hi OR (e.bin = {len(edges) - 2} AND x.v <= hi)) GROUP BY ALL"""


@query(_histogram_sql("b", "conf", metrics.CONF_EDGES))
def confidence_histogram(s: SparkSession, d: str) -> DataFrame:
    return metrics.histogram(corpus_rows(s, d, "han_boxes", "conf"), "conf", metrics.CONF_EDGES)


@query(_histogram_sql("alignment", "similarity", metrics.SIM_EDGES))
def similarity_histogram(s: SparkSession, d: str) -> DataFrame:
    return metrics.histogram(table(s, d, "alignment"), "similarity", metrics.SIM_EDGES)


@query("""
WITH t AS (SELECT vol, round(quantile_cont(bge_sparse, 0.1) FILTER (bge_sparse > 0 AND coalesce(vietnamese, '') <> ''), 3) AS p10 FROM alignment GROUP BY vol)
SELECT a.vol, pair_idx, coalesce(similarity < 0.45 AND lexical < 0.05, false) AS suspect_now, coalesce(similarity < 0.45 AND bge_sparse < coalesce(p10, 0.0), false) AS suspect_sparse
FROM alignment a JOIN t USING (vol)""")
def suspect_pairs(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "alignment").select("vol", "pair_idx", "similarity", "lexical", "bge_sparse", F.coalesce("vietnamese", F.lit("")).alias("vi"))
    limit = a.groupBy("vol").agg(F.round(F.percentile(F.when((F.col("bge_sparse") > 0) & (F.col("vi") != ""), F.col("bge_sparse")), 0.1), 3).alias("p10"))
    return a.join(limit, "vol").select(
        "vol", "pair_idx", F.coalesce(F.expr("similarity < 0.45 AND lexical < 0.05"), F.lit(False)).alias("suspect_now"),
        F.coalesce(F.expr("similarity < 0.45 AND bge_sparse < coalesce(p10, 0.0)"), F.lit(False)).alias("suspect_sparse"),
    )


@query("""
WITH $ONCE, x AS (SELECT vol, count(*) AS boxes, sum(length(coalesce(sinonom, ''))) AS chars, count(*) FILTER (conf < 0.5) AS low, count(DISTINCT page) AS pages,
  median(conf) AS median_conf, count(*) FILTER (is_dbl) AS dbl FROM b GROUP BY vol)
SELECT vol, boxes, CAST(chars AS BIGINT) AS chars, low, pages, round(median_conf, 4) AS median_conf, dbl, round(100.0 * low / greatest(boxes, 1), 2) AS low_percent FROM x""")
def volume_figures(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "han_boxes", "page", "sinonom", "conf", "is_dbl")
    agg = rows.groupBy("vol").agg(
        F.count("*").alias("boxes"), F.sum(F.length(F.coalesce("sinonom", F.lit("")))).alias("chars"), F.count_if(F.col("conf") < 0.5).alias("low"),
        F.count_distinct("page").alias("pages"), F.round(F.median("conf"), 4).alias("median_conf"), F.count_if("is_dbl").alias("dbl"),
    )
    return agg.withColumn("low_percent", metrics.percent(F.col("low"), F.col("boxes")))


@query("""
WITH $ONCE SELECT vol, chapter, count(*) AS n, round(sum(CAST(round(oov_rate * 1000) AS BIGINT)) / (1000.0 * count(oov_rate)), 6) AS mean_oov, count(*) FILTER (oov_rate > 0.3) AS above,
  count(*) FILTER (text <> raw_text) AS cleaned, count(*) FILTER (text IS NULL OR text = '') AS without, count(*) FILTER (contains(text, '<b>')) AS bold FROM v GROUP BY vol, chapter""")
def chapter_figures(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "chapter", "text", "raw_text", "oov_rate")
    return rows.groupBy("vol", "chapter").agg(
        F.count("*").alias("n"), F.round(F.sum(F.round(F.col("oov_rate") * 1000).cast("bigint")) / (1000.0 * F.count("oov_rate")), 6).alias("mean_oov"), F.count_if(F.col("oov_rate") > 0.3).alias("above"),
        F.count_if(F.col("text") != F.col("raw_text")).alias("cleaned"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("without"), F.count_if(F.col("text").contains("<b>")).alias("bold"),
    )


# ---------------------------------------------------------------- two readings, chains, patches


@query("""
WITH $ONCE, p AS (SELECT vol, pair_idx, unnest(han_ids) AS id FROM alignment),
sb AS (SELECT p.vol, p.pair_idx, unnest(h.box_ids) AS box_id FROM p JOIN h ON p.vol = h.vol AND p.id = h.id)
SELECT sb.vol, sb.pair_idx, b.page, b.id AS box_id, CAST(sb.pair_idx % 12 AS INTEGER) AS colour FROM sb JOIN b ON sb.vol = b.vol AND sb.box_id = b.id""")
def aligned_boxes(s: SparkSession, d: str) -> DataFrame:
    pairs = table(s, d, "alignment").select("vol", "pair_idx", F.explode("han_ids").alias("id"))
    sent = corpus_rows(s, d, "han_sentences", "box_ids")
    boxes = corpus_rows(s, d, "han_boxes", "page").withColumnRenamed("id", "box_id")
    met = pairs.join(sent, ["vol", "id"]).select("vol", "pair_idx", F.explode("box_ids").alias("box_id")).join(boxes, ["vol", "box_id"])
    return met.select("vol", "pair_idx", "page", "box_id", F.pmod("pair_idx", F.lit(12)).cast("int").alias("colour"))


@query("""
WITH $ONCE, p AS (SELECT vol, pair_idx, vietnamese, unnest(han_ids) AS id FROM alignment WHERE vietnamese IS NOT NULL),
m AS (SELECT vol, id, arg_max(vietnamese, pair_idx) AS meaning FROM p GROUP BY ALL)
SELECT h.vol, h.id, m.meaning FROM h LEFT JOIN m USING (vol, id)""")
def sentence_meanings(s: SparkSession, d: str) -> DataFrame:
    pairs = table(s, d, "alignment").where("vietnamese is not null").select("vol", "pair_idx", "vietnamese", F.explode("han_ids").alias("id"))
    last = pairs.groupBy("vol", "id").agg(F.max_by("vietnamese", "pair_idx").alias("meaning"))
    return corpus_rows(s, d, "han_sentences").join(last, ["vol", "id"], "left").select("vol", "id", "meaning")


@query("""
WITH $ONCE, t AS (SELECT vol, pair_idx, coalesce(suspect, false) AS suspect, coalesce(suspect_bge, false) AS suspect_bge, han_ids, vie_ids, similarity FROM alignment)
SELECT vol, pair_idx, array_to_string(han_ids, ', ') AS han, array_to_string(vie_ids, ', ') AS vie, similarity,
  CASE WHEN suspect THEN 'x' ELSE '' END AS lexical_flag, CASE WHEN suspect_bge THEN 'x' ELSE '' END AS sparse_flag FROM t""")
def alignment_sheet(s: SparkSession, d: str) -> DataFrame:
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), "x").otherwise("")
    return table(s, d, "alignment").select(
        "vol", "pair_idx", F.array_join("han_ids", ", ").alias("han"), F.array_join("vie_ids", ", ").alias("vie"), "similarity",
        flag("suspect").alias("lexical_flag"), flag("suspect_bge").alias("sparse_flag"),
    )


@query("""
WITH $ONCE, e AS (SELECT vol, id, raw_text AS correct, CASE WHEN text = '' THEN 'drop' ELSE 'edit' END AS fix_type FROM v WHERE raw_text IS NOT NULL AND (text <> raw_text OR text = ''))
SELECT v.vol, v.id, coalesce(e.correct, v.text) AS text, e.vol IS NOT NULL AS reviewed FROM v LEFT JOIN e USING (vol, id) WHERE coalesce(e.fix_type, '') <> 'drop'""")
def overlaid_rows(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "vi_sentences", "text", "raw_text")
    edits = rows.where("raw_text is not null and (text <> raw_text or text = '')").select(
        "vol", "id", F.col("raw_text").alias("correct"), F.when(F.col("text") == "", "drop").otherwise("edit").alias("fix_type")
    )
    return patching.overlaid(rows.drop("raw_text"), edits, ["vol", "id"], "text").select("vol", "id", "text", "reviewed")


@query("""
WITH $ONCE, m AS (SELECT vol, id AS old_id, printf('HVH_001.%03d.%03d.%02d', chapter, page, sent_idx + 1) AS new_id FROM h WHERE sent_idx > 3),
x AS (SELECT vol, pair_idx, unnest(han_ids) AS i, unnest(range(len(han_ids))) AS k FROM alignment),
y AS (SELECT x.vol, pair_idx, list(coalesce(new_id, i) ORDER BY k) AS ids FROM x LEFT JOIN m ON x.vol = m.vol AND x.i = m.old_id GROUP BY ALL)
SELECT a.vol, a.pair_idx, CASE WHEN a.han_ids IS NOT NULL THEN coalesce(y.ids, []) END AS han_ids FROM alignment a LEFT JOIN y USING (vol, pair_idx)""")
def remapped_pairs(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "han_sentences", "chapter", "page", "sent_idx", where="sent_idx > 3")
    mapping = rows.select("vol", F.col("id").alias("old_id"), T.make_id(F.col("chapter"), F.col("page"), F.col("sent_idx") + 1).alias("new_id"))
    return patching.remapped(table(s, d, "alignment").select("vol", "pair_idx", "han_ids"), ["vol", "pair_idx"], ["vol"], "han_ids", mapping)


# ---------------------------------------------------------------- vectors


@query("""
WITH x AS (SELECT vec_id, label, vec_id // 512 AS run, embedding, lead(embedding) OVER (PARTITION BY label, vec_id // 512 ORDER BY vec_id) AS nxt FROM embeddings),
g AS (SELECT label, run, vec_id, list_transform(list_zip(embedding, nxt), lambda p: CAST(p[1] AS DOUBLE) + CAST(p[2] AS DOUBLE)) AS s FROM x WHERE nxt IS NOT NULL),
n AS (SELECT label, vec_id, s, lead(s) OVER (PARTITION BY label, run ORDER BY vec_id) AS t FROM g)
SELECT label, vec_id, round(list_cosine_similarity(s, t), 6) AS cosine FROM n WHERE t IS NOT NULL""")
def neighbour_similarity(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "embeddings").withColumn("run", F.floor(F.col("vec_id") / 512))  # a run, as a chapter, is of bounded size
    made = vectors.neighbour_units(rows, ["label", "run"], ["vec_id"], "embedding", 2)
    nxt = F.lead("group_unit").over(W.partitionBy("label", "run").orderBy("vec_id"))
    pairs = made.withColumn("nxt", nxt).where("nxt is not null and group_unit is not null")
    return pairs.select("label", "vec_id", F.round(vectors.dot(F.col("group_unit"), F.col("nxt")), 6).alias("cosine"))


@query("SELECT user_id, event_type AS token, round(sum(value), 4) AS weight FROM events GROUP BY ALL")
def merged_weights(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "events").select("user_id", F.create_map("event_type", "value").alias("weights"))
    merged = vectors.merged_weights(rows, ["user_id"], "weights")
    return merged.select("user_id", F.explode("weights").alias("token", "weight")).withColumn("weight", F.round("weight", 4))


# ---------------------------------------------------------------- sequences within rows



@query(f"""
WITH $ONCE, s2 AS (SELECT lower(trim(key)) AS q, flatten(list(values)) AS s2 FROM s2_readings GROUP BY 1),
r AS (SELECT vol, id, regexp_extract_all(sinonom, '{_CJK_SQL}') AS c, list_filter(regexp_split_to_array(lower(trim(coalesce(am_han_viet, ''))), '\\s+'), lambda x: x <> '') AS q FROM h),
p AS (SELECT vol, id, unnest(range(1, len(c) + 1)) AS k, c, q FROM r WHERE len(c) > 0),
x AS (SELECT vol, id, c[k] AS sn, CASE WHEN k + len(q) - len(c) >= 1 THEN q[k + len(q) - len(c)] END AS qn FROM p),
alike AS (SELECT am_han_viet AS r, list(sinonom_char ORDER BY sinonom_char) AS cs FROM hanviet WHERE am_han_viet IS NOT NULL AND sinonom_char IS NOT NULL GROUP BY 1),
s1 AS (SELECT sinonom_char AS sn, min(cs) AS s1 FROM hanviet JOIN alike ON am_han_viet = r GROUP BY 1),
m AS (SELECT vol, id, list_contains(coalesce(s2, []), sn) AS ok, len(list_intersect(coalesce(s1, [sn]), coalesce(s2, []))) > 0 AS near FROM x LEFT JOIN s2 ON lower(trim(qn)) = q LEFT JOIN s1 USING (sn))
SELECT vol, id, count(*) AS n, count(*) FILTER (ok) AS black, count(*) FILTER (NOT ok AND near) AS green, count(*) FILTER (NOT ok AND NOT near) AS red,
  round(count(*) FILTER (ok OR near) / count(*), 4) AS accuracy FROM m GROUP BY vol, id""")
def sequence_accuracy(s: SparkSession, d: str) -> DataFrame:
    rows = corpus_rows(s, d, "han_sentences", "sinonom", "am_han_viet")
    return sequences.sequence_accuracy(rows, ["vol", "id"], "sinonom", "am_han_viet", _similar(s, d), table(s, d, "s2_readings"))


# Some simplified forms and the traditional ones.
_FORMS = "节節 龙龍 书書 养養 岁歲 东東 铁鐵 县縣 义義 达達 闻聞 实實 鱼魚 军軍 爱愛 盐鹽 对對 赏賞 银銀 马馬 问問 边邊 读讀 学學"
_FROM, _TO = ("".join(p[k] for p in _FORMS.split()) for k in (0, 1))


@query(f"""
WITH $ONCE SELECT vol, id, translate(sinonom, '{_FROM}', '{_TO}') AS traditional, CAST(length(sinonom) - length(regexp_replace(sinonom, '[{_FROM}]', '', 'g')) AS INTEGER) AS changed
FROM b WHERE sinonom IS NOT NULL""")
def traditional_forms(s: SparkSession, d: str) -> DataFrame:
    text, changed = sequences.mapped_characters(F.col("sinonom"), _FORMS)
    return corpus_rows(s, d, "han_boxes", "sinonom", where="sinonom is not null").select("vol", "id", text.alias("traditional"), changed.alias("changed"))


@query(r"""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, E'\n'), lambda x: trim(x, ' ')), lambda x: x <> '') AS ls FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(len(ls) AS INTEGER) AS n_lines,
  round(CASE WHEN len(ls) > 0 THEN len(list_filter(ls, lambda x: regexp_matches(x, '[^\s:：]+\s*[:：]\s*[0-9]'))) / len(ls) ELSE 0.0 END, 3) AS index_share,
  round(CASE WHEN len(ls) > 0 THEN len(list_filter(ls, lambda x: len(string_split(x, ' ')) <= 4)) / len(ls) ELSE 0.0 END, 3) AS short_share FROM l""")
def line_shares(s: SparkSession, d: str) -> DataFrame:
    """Shares of index-like and of short lines, as back matter shows them."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    docs = table(s, d, "documents").where("text is not null").select("doc_id", lines.alias("ls"))
    part = lambda f: T.share(F.size(F.filter("ls", f)), F.size("ls"))
    return docs.select(
        "doc_id", F.size("ls").alias("n_lines"), part(lambda x: x.rlike(r"[^\s:：]+\s*[:：]\s*[0-9]")).alias("index_share"),
        part(lambda x: F.size(F.split(x, " ")) <= 4).alias("short_share"),
    )


@query(f"""
WITH $ONCE SELECT vol, id FROM b WHERE sinonom IS NOT NULL AND regexp_matches(sinonom, '{_CJK_SQL}')""")
def han_boxes_only(s: SparkSession, d: str) -> DataFrame:
    return corpus_rows(s, d, "han_boxes", where=F.col("sinonom").rlike(T.CJK))


@query(f"""
WITH $ONCE, {_CLEAN}, {_VOCAB},
f AS (SELECT c.vol, c.id, v.chapter, v.page, v.sent_idx, c.t0, trim(regexp_replace(regexp_replace(t{_N}, '\\s{{2,}}', ' ', 'g'), '{T.SPACE_BEFORE_MARK}', '\\1', 'g'), ' ') AS clean
  FROM (SELECT a.vol, a.id, a.t{_N}, x.t0 FROM c{_N - 1} a JOIN c x USING (vol, id)) c JOIN v USING (vol, id)),
k AS (SELECT * FROM f WHERE regexp_matches(clean, '[A-Za-zÀ-ỹ]') AND NOT regexp_matches(clean, '{T.DANGLING_FOLIO}')),
t AS (SELECT vol, id, unnest(regexp_extract_all(lower(clean), '[$VI]+')) AS token FROM k),
n AS (SELECT vol, id, count(*) AS n, count(*) FILTER (voc.token IS NULL) AS o FROM t LEFT JOIN voc USING (token) GROUP BY ALL)
SELECT k.vol, k.id, CAST(row_number() OVER (PARTITION BY k.vol, k.chapter, k.page ORDER BY k.sent_idx, k.id) AS INTEGER) AS ordinal, clean, clean <> t0 AS changed,
  coalesce(n.n, 0) AS n_tokens, round(CASE WHEN n.n > 0 THEN n.o / n.n ELSE 0.0 END, 3) AS oov_rate FROM k LEFT JOIN n ON k.vol = n.vol AND k.id = n.id""")
def cleaned_sentences(s: SparkSession, d: str) -> DataFrame:
    """The Vietnamese side end to end: clean, drop junk, renumber, rate against the vocabulary."""
    rows = corpus_rows(s, d, "vi_sentences", "chapter", "page", "sent_idx", "text", where="text is not null")
    kept = rows.withColumn("clean", T.cleaned(F.col("text"))[0]).where(~T.is_junk(F.col("clean")))
    rates = lexicon.oov_rates(kept, ["vol", "id"], T.vi_tokens(F.col("clean")), _vocabulary(s, d))
    placed = pages.numbered(kept, ["vol", "chapter", "page"], ["sent_idx", "id"]).withColumn("changed", F.col("clean") != F.col("text"))
    return placed.join(rates, ["vol", "id"]).select("vol", "id", "ordinal", "clean", "changed", "n_tokens", "oov_rate")
